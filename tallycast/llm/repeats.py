"""Removes every byte that a string of LENGTH bytes covers which also starts earlier in the corpus, exactly.

Each window of LENGTH bytes names an anchor: of its runs of ANCHOR bytes the one with the least hash. Equal windows have equal anchors at equal
offsets, so only places with the same anchor need to be compared. Neighbouring windows with one anchor make a stretch, a few dozen bytes
longer than a window. Stretches are dealt out by their anchor's hash.

1. Stretches equal to an earlier one are repeats as a whole; they are taken out in the task that reads the texts, and once
   more after the shuffle, so however often a passage is copied, a task gets one stretch of it from each batch read.
2. Different stretches of one anchor may share windows, at the borders of copies. Their texts are fetched, and a run-length
   index is built over those of a set of anchors; it tells for each place the longest match elsewhere (see ``runindex``). A place that
   matches LENGTH bytes or more is a repeat unless it is the first of its equals.
3. An anchor with more than CROWD different stretches (a passage in very many surroundings) would make too large an
   index: its windows are dealt out by a hash of all their bytes instead. The result is the same.

Positions are counted in UTF-8 bytes. Documents follow each other by id; null ids come first, and texts of one id by the
text's digest; a row that repeats id and text has the same result as the row it repeats. A null text counts as empty. Texts shorter
than LENGTH have no repeats. What is left of a character that was cut is dropped from the kept text, but counted in the digests' bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallycast.llm.runindex import RunIndex
from tallycast.llm.text import BYTE_VALUES, GOLDEN, WORD_BASE, column_bytes, mix, pieces, powers, spread
from tallycast.session import materialize

LENGTH = 100
ANCHOR = 32
CROWD = 4096
INDEX_BYTES = 1 << 18
SPAN, STRETCH, CROWDED = 0, 1, 2

# What the steps hand on: a found span (kind SPAN), a stretch to look into, or one of a crowded anchor. ``place`` is the
# first window's start, ``count`` the number of windows.
ROWS = "kind int, anchor bigint, content bigint, id bigint, tie bigint, tie2 bigint, place bigint, count int"
ROW_NAMES = [part.split()[0] for part in ROWS.split(", ")]
ROW_TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]

#: What tells rows apart: the id, and 128 bits of the text's digest where ids repeat.
PLACED = ["id", "tie", "tie2"]

_inverse = np.ones(1, np.uint64)


def inverse_powers(count: int) -> np.ndarray:
    """Powers of the inverse of the hash's base modulo 2**64."""
    global _inverse
    if len(_inverse) < count:
        grown = np.full(max(count, 256), pow(WORD_BASE, -1, 2**64), np.uint64)
        grown[0] = 1
        _inverse = np.multiply.accumulate(grown)
    return _inverse


class Rolling:
    """Hashes of any stretch of a batch's bytes, from running sums."""

    def __init__(self, data: np.ndarray) -> None:
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE_VALUES[data] * powers(len(data))[: len(data)], out=self.sums[1:])
        self.back = inverse_powers(len(data) + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.back[starts])


def least_ahead(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each place's next ``width`` values."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    if span < width:
        values = np.minimum(values[: len(values) - (width - span)], values[width - span :])
    return values


def stretches(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> dict[str, np.ndarray]:
    """The stretches of a batch's texts: row, place, count of windows, and the hashes of anchor and content."""
    empty = {"row": np.zeros(0, np.int64), "place": np.zeros(0, np.int64), "count": np.zeros(0, np.int64)}
    empty |= {"anchor": np.zeros(0, np.uint64), "content": np.zeros(0, np.uint64)}
    sizes = np.diff(offsets)
    windows = np.maximum(sizes - length + 1, 0)
    if not windows.any():
        return empty
    rolling = Rolling(data)
    grams = np.arange(len(data) - ANCHOR + 1)
    high = rolling.of(grams, grams + ANCHOR) >> np.uint64(32)
    least = least_ahead(high << np.uint64(32) | grams.astype(np.uint64), length - ANCHOR + 1)
    starts = spread(offsets[:-1], windows)
    anchor = (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(starts)))
    begin = starts[at]
    row = np.searchsorted(offsets, begin, "right") - 1
    return {
        "row": row,
        "place": begin - offsets[row],
        "count": count,
        "anchor": rolling.of(anchor[at], anchor[at] + ANCHOR),
        "content": rolling.of(begin, begin + count + length - 1),
    }


def row_batch(kind: np.ndarray, **columns: np.ndarray) -> pa.RecordBatch:
    values = [kind, *(columns[name] for name in ROW_NAMES[1:])]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, ROW_TYPES, strict=True)], names=ROW_NAMES)


def first_of_each(found: dict[str, np.ndarray], kind: int) -> pa.RecordBatch:
    """Keeps a batch's earliest row of each anchor and content; the others become spans, dealt out by their place."""
    order = np.lexsort(tuple(found[name] for name in ("place", "tie2", "tie", "id", "content", "anchor")))
    found = {name: x[order] for name, x in found.items()}
    new = np.ones(len(order), bool)
    new[1:] = (found["anchor"][1:] != found["anchor"][:-1]) | (found["content"][1:] != found["content"][:-1])
    keep = new.copy()
    keep[1:] |= ~_same_place(found)
    kinds = np.where(new, kind, SPAN)
    elsewhere = mix(found["place"].astype(np.uint64) * GOLDEN + found["id"].view(np.uint64)).view(np.int64)
    anchor = np.where(new, found["anchor"].view(np.int64), elsewhere)
    columns = found | {"anchor": anchor, "content": found["content"].view(np.int64)}
    return row_batch(kinds[keep], **{name: columns[name][keep] for name in ROW_NAMES[1:]})


def _same_place(found: dict[str, np.ndarray]) -> np.ndarray:
    """Whether a sorted row has the id, ties and place of the row before it: a repeated row of the input."""
    return np.logical_and.reduce([found[name][1:] == found[name][:-1] for name in (*PLACED, "place")])


def found_stretches(docs: DataFrame, length: int) -> DataFrame:
    """Step 1: the stretches of all texts, less those that a batch holds before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            found = stretches(*column_bytes(batch.column("text")), length)
            row = found.pop("row")
            found |= {name: batch.column(name).to_numpy()[row] for name in PLACED}
            yield first_of_each(found, STRETCH)

    return docs.mapInArrow(run, ROWS)


def sift(rows: DataFrame) -> DataFrame:
    """After the shuffle: stretches that have an equal before them become spans; those alone with their anchor go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] | None = None  # first stretches of the anchor at hand, CROWD at most
        last: dict[str, np.ndarray] | None = None  # the last row seen
        crowded = False  # the anchor at hand has more than CROWD contents; what was held is handed on

        for batch in batches:
            got = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in ROW_NAMES}
            spans = got["kind"] == SPAN
            if spans.any():
                yield batch.filter(pa.array(spans))
                got = {name: x[~spans] for name, x in got.items()}
            if not len(got["kind"]):
                continue
            joined = got if last is None else {name: np.concatenate([last[name], x]) for name, x in got.items()}
            skip = 0 if last is None else 1
            new_anchor = np.ones(len(joined["anchor"]), bool)
            new_anchor[1:] = joined["anchor"][1:] != joined["anchor"][:-1]
            new = new_anchor.copy()
            new[1:] |= joined["content"][1:] != joined["content"][:-1]
            same = np.zeros(len(new), bool)
            same[1:] = _same_place(joined)
            new_anchor, new, same = new_anchor[skip:], new[skip:], same[skip:]
            again = ~new & ~same
            if again.any():
                yield row_batch(np.full(int(again.sum()), SPAN), **{name: got[name][again] for name in ROW_NAMES[1:]})
            firsts = {name: x[new] for name, x in got.items()}
            opens = np.flatnonzero(new_anchor[new])
            last = {name: x[-1:] for name, x in got.items()}
            # The anchor at hand may go on at the head of this batch.
            head = int(opens[0]) if len(opens) else len(firsts["kind"])
            if head:
                more = {name: x[:head] for name, x in firsts.items()}
                if crowded:
                    yield row_batch(np.full(head, CROWDED), **{name: more[name] for name in ROW_NAMES[1:]})
                else:
                    held = more if held is None else {name: np.concatenate([held[name], x]) for name, x in more.items()}
                    if len(held["kind"]) > CROWD:
                        yield row_batch(np.full(len(held["kind"]), CROWDED), **{name: held[name] for name in ROW_NAMES[1:]})
                        held, crowded = None, True
            if not len(opens):
                continue
            ends = np.append(opens[1:], len(firsts["kind"]))
            if held is not None and len(held["kind"]) > 1:
                yield row_batch(np.full(len(held["kind"]), STRETCH), **{name: held[name] for name in ROW_NAMES[1:]})
            sizes = ends - opens
            kinds = np.repeat(np.where(sizes > CROWD, CROWDED, STRETCH), sizes)
            keep = np.repeat(sizes > 1, sizes)
            tail = int(opens[-1]) - int(opens[0])
            keep[tail:] = False  # the last anchor may go on in the next batch
            closed = {name: x[opens[0] :][keep] for name, x in firsts.items()}
            if keep.any():
                yield row_batch(kinds[keep], **{name: closed[name] for name in ROW_NAMES[1:]})
            held, crowded = {name: x[opens[-1] :] for name, x in firsts.items()}, False
            if len(held["kind"]) > CROWD:
                yield row_batch(np.full(len(held["kind"]), CROWDED), **{name: held[name] for name in ROW_NAMES[1:]})
                held, crowded = None, True
        if held is not None and len(held["kind"]) > 1:
            yield row_batch(np.full(len(held["kind"]), STRETCH), **{name: held[name] for name in ROW_NAMES[1:]})

    return (
        rows.repartition("anchor")
        .sortWithinPartitions("kind", "anchor", "content", *PLACED, "place")
        .mapInArrow(run, ROWS)
    )


def small_texts(docs: DataFrame) -> DataFrame:
    """The same rows with each text compressed, for a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in pieces(batches, "text"):
            data, offsets = column_bytes(batch.column("text"))
            raw = data.tobytes()
            small = [press.compress(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, "text", pa.array(small, pa.binary()))

    fields = [T.StructField("text", T.BinaryType()) if f.name == "text" else f for f in docs.schema.fields]
    return docs.mapInArrow(run, T.StructType(fields))


def fetched(wanted: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """Step 2 and 3: the bytes of stretches to index, and the windows of crowded ones by their hash."""
    each = wanted.groupBy(*PLACED).agg(F.collect_list(F.struct("kind", "anchor", "place", "count")).alias("wanted"))
    schema = ROWS + ", bytes binary"
    names = [*ROW_NAMES, "bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor()
        for batch in pieces(batches, "text", 1 << 18):
            texts = [expand.decompress(x) for x in batch.column("text").to_pylist()]
            sizes = np.array([len(x) for x in texts], np.int64)
            data = np.frombuffer(b"".join(texts), np.uint8)
            begin = np.cumsum(sizes) - sizes
            lists = batch.column("wanted")
            flat = lists.flatten()
            kind, anchor, place, count = (flat.field(i).to_numpy() for i in range(4))
            row = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
            placed = {name: batch.column(name).to_numpy()[row] for name in PLACED}
            at = begin[row] + place
            whole = np.flatnonzero(kind == STRETCH)
            if len(whole):
                raw = data.tobytes()
                ends = at + count + length - 1
                made = row_batch(
                    kind[whole], anchor=anchor[whole], content=np.zeros(len(whole), np.int64),
                    place=place[whole], count=count[whole], **{name: x[whole] for name, x in placed.items()},
                )
                some = pa.array([raw[a:b] for a, b in zip(at[whole].tolist(), ends[whole].tolist(), strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([*made.columns, some], names=names)
            crowd = np.flatnonzero(kind == CROWDED)
            if len(crowd):
                counts = count[crowd].astype(np.int64)
                starts = spread(at[crowd], counts)
                owner = np.repeat(crowd, counts)
                rolling = Rolling(data)
                middle = starts + length // 2
                found = {
                    "anchor": rolling.of(starts, starts + length),
                    "content": rolling.of(starts, middle),  # a second hash, of a part
                    **{name: x[owner] for name, x in placed.items()},
                    "place": starts - begin[row[owner]], "count": np.ones(len(starts), np.int64),
                }
                made = first_of_each(found, CROWDED)
                yield pa.RecordBatch.from_arrays([*made.columns, pa.nulls(made.num_rows, pa.binary())], names=names)

    return each.join(small_texts(docs), PLACED).select(*PLACED, "wanted", "text").mapInArrow(run, schema)


def spans_among(rows: DataFrame, length: int) -> DataFrame:
    """Spans of the fetched stretches, by run-length indexes over whole anchors, and of windows equal to earlier ones."""

    def index(parts: list[tuple]) -> pa.RecordBatch:
        sizes = np.array([len(x[0]) for x in parts], np.int64)
        made = RunIndex(np.frombuffer(b"".join(x[0] for x in parts), np.uint8), sizes)
        at = made.repeated(length)
        part = np.searchsorted(made.starts, at, "right") - 1
        offset = at - made.starts[part]
        new = np.ones(len(at), bool)
        new[1:] = at[1:] != at[:-1] + 1
        new[1:] |= part[1:] != part[:-1]
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(at)))
        part, offset = part[first], offset[first]
        take = lambda i: np.array([parts[j][i] for j in part.tolist()], np.int64)
        zero = np.zeros(len(part), np.int64)
        return row_batch(zero, anchor=zero, content=zero, id=take(1), tie=take(2), tie2=take(3), place=take(4) + offset, count=count)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, anchor, last = 0, None, None
        for batch in batches:
            kinds = batch.column("kind").to_numpy()
            spans = batch.filter(pa.array(kinds == SPAN))
            if spans.num_rows:
                yield spans.select(ROW_NAMES)
            part = batch.filter(pa.array(kinds == STRETCH)).to_pydict()
            for key, raw, *where in zip(*(part[name] for name in ("anchor", "bytes", *PLACED, "place")), strict=True):
                if key == anchor and held and held[-1][1:] == tuple(where):
                    continue  # a repeated row of the input
                if key != anchor and size > INDEX_BYTES:
                    yield index(held)
                    held, size = [], 0
                anchor = key
                held.append((raw, *where))
                size += len(raw)
            crowd = batch.filter(pa.array(kinds == CROWDED))
            if crowd.num_rows:
                got = {name: crowd.column(name).to_numpy() for name in ROW_NAMES}
                joined = got if last is None else {name: np.concatenate([last[name], x]) for name, x in got.items()}
                again = np.zeros(len(joined["kind"]), bool)
                again[1:] = (joined["anchor"][1:] == joined["anchor"][:-1]) & (joined["content"][1:] == joined["content"][:-1])
                again[1:] &= ~_same_place(joined)
                again = again[0 if last is None else 1 :]
                last = {name: x[-1:] for name, x in got.items()}
                yield row_batch(np.full(int(again.sum()), SPAN), **{name: got[name][again] for name in ROW_NAMES[1:]})
        if held:
            yield index(held)

    return (
        rows.repartition("anchor")
        .sortWithinPartitions("kind", "anchor", "content", *PLACED, "place")
        .mapInArrow(run, ROWS)
    )


def with_spans(docs: DataFrame, key: str, text: str, length: int) -> DataFrame:
    """All columns of ``docs``, the text compressed, as structs ``row``, with ``text`` and the spans found in it."""
    number = F.coalesce(F.col(key).cast("bigint"), F.lit(-(1 << 63)))
    # Only where an id repeats do rows need telling apart; else the ties would swell the shuffles for nothing.
    unique = docs.groupBy(number.alias("id")).count().filter("count > 1").isEmpty()
    digest = F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    half = lambda at: F.lit(0).cast("bigint") if unique else F.conv(F.substring(digest, at, 16), 16, -10).cast("bigint")
    rows = docs.select(
        number.alias("id"),
        half(1).alias("tie"),
        half(17).alias("tie2"),
        F.col(text).alias("text"),
        F.struct(*(docs[name] for name in docs.columns if name != text)).alias("row"),
    )
    texts = rows.select(*PLACED, "text")
    sifted = materialize(sift(found_stretches(texts, length)), "stretches")
    wanted = sifted.filter(F.col("kind") != SPAN)
    spans = sifted.filter(F.col("kind") == SPAN).unionByName(spans_among(fetched(wanted, texts, length), length))
    each = spans.groupBy(*PLACED).agg(F.collect_list(F.struct("place", "count")).alias("spans"))
    return small_texts(rows).join(each, PLACED, "left").select("row", "text", "spans")


def cut(raw: bytes, places: np.ndarray, counts: np.ndarray, length: int) -> tuple[bytes, int, int]:
    """What is left of a text, the bytes removed, and the number of maximal removed runs."""
    change = np.zeros(len(raw) + 1, np.int64)
    np.add.at(change, places, 1)
    np.add.at(change, places + counts + length - 1, -1)
    gone = np.cumsum(change[:-1]) > 0
    runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
    return np.frombuffer(raw, np.uint8)[~gone].tobytes(), int(gone.sum()), runs


def _mapped(found: DataFrame, names: list[str], schema: T.StructType, make: Callable, length: int) -> DataFrame:
    """Cut every text and build the result's columns from the row's struct and the cut texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor()
        for batch in pieces(batches, "text", 1 << 18):
            lists = batch.column("spans")
            flat = lists.flatten()
            place, count = flat.field(0).to_numpy(), flat.field(1).to_numpy()
            sizes = lists.value_lengths().fill_null(0).to_numpy()
            ends = np.cumsum(sizes)
            done = []
            for raw, a, b in zip(batch.column("text").to_pylist(), (ends - sizes).tolist(), ends.tolist(), strict=True):
                raw = expand.decompress(raw)
                done.append((raw, *(cut(raw, place[a:b], count[a:b], length) if b > a else (raw, 0, 0))))
            row = batch.column("row")
            yield pa.RecordBatch.from_arrays(make({f.name: row.field(i) for i, f in enumerate(row.type)}, done), names=names)

    return found.mapInArrow(run, schema)


def repeat_digests(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """A row per document: the key, n_bytes, n_removed, n_spans, kept_sha256."""
    found = with_spans(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), "key", "text", length)

    def make(row: dict[str, pa.Array], done: list[tuple]) -> list[pa.Array]:
        return [
            row["key"],
            pa.array([len(x[0]) for x in done], pa.int64()),
            pa.array([x[2] for x in done], pa.int64()),
            pa.array([x[3] for x in done], pa.int64()),
            pa.array([hashlib.sha256(x[1]).hexdigest() for x in done], pa.string()),
        ]

    names = ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    kinds = [docs.schema[key].dataType, T.LongType(), T.LongType(), T.LongType(), T.StringType()]
    schema = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds, strict=True)])
    return _mapped(found, names, schema, make, length).withColumnRenamed("key", key)


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """The documents with the repeats cut out of their texts; a column n_chars, if there is one, is counted anew."""
    found = with_spans(docs, key, text, length)
    fields = [T.StructField(f.name, f.dataType) for f in docs.schema.fields]

    def make(row: dict[str, pa.Array], done: list[tuple]) -> list[pa.Array]:
        kept = [x[1].decode("utf-8", "ignore") for x in done]
        made = row | {text: pa.array(kept, pa.string())}
        if "n_chars" in row:
            made["n_chars"] = pa.array([len(x) for x in kept], pa.int64()).cast(row["n_chars"].type)
        return [made[f.name] for f in fields]

    return _mapped(found, [f.name for f in fields], T.StructType(fields), make, length)
