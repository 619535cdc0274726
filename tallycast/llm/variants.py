"""Spelling variants: words that differ by one inserted, deleted or replaced letter, and the frequent form each is a variant of.

Candidates come from an index of variable-length grams. A gram of a word starts with LEAST_GRAM letters and goes on as long as it is one of
the frequent grams, so common beginnings lead to long grams with short lists; the dictionary of frequent grams is pruned by a share of
all grams, which bounds it whatever the vocabulary, and is broadcast. A gram that lies within an earlier one is left out.

For each word the grams that one edit can affect are counted, at each place where it may happen: those whose choice read the place, and
those behind it that a gram from before it could now cover. With the most for any place as bound, two near words share all but that many
grams, at the same distance from the start (before the edit) or from the end (behind it). So the lists of the bound plus one rarest grams of
both words meet (rarest in one order for all words). Lists are merged by these keys and every candidate is verified.

With grams of up to Q letters, words of 2 Q letters or more always keep a gram. Pairs are found with the Q of the shorter word, up to
MOST_GRAM; a word takes part with its own Q and with that of words one letter shorter.

A list of more than CROWD words isn't compared pair by pair: its words are listed again by what is left when one letter is taken out, within
the list, and words that agree there are compared. Such a list has no more words than the alphabet has letters, for each place. Words of over
WIDE letters are listed by their halves.

Defined cases: a null text has no words and a null id is written as the empty text; repeated rows count again; ties for a form go to the
smallest word; words may be of any length; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast.llm.table import Table
from tallycast.llm.text import BYTE_VALUES, GOLDEN, WORD_BASE, column_bytes, mix, powers, spread
from tallycast.session import materialize

LEAST_LENGTH = 7
LEAST_COUNT = 2
SLIP = 31  # of so many (document, word) pairs one loses a letter
RATIO = 10  # a form is so many times as frequent
LEAST_GRAM, MOST_GRAM = 2, 6
FREQUENT_SHARE = 1 << 16  # a frequent gram is more than this part of all places
FREQUENT_LEAST = 32
CROWD = 4096
FEW = 48  # lists up to this size are compared together
WORDS_AT_ONCE = 1 << 16
PAIRS_AT_ONCE = 1 << 16
WIDE = 64  # letters; longer words are compared one by one
LATIN = "ISO-8859-1"  # a byte for each letter, in the order of code points
LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def corpus_words(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The words of all texts with a slip in one of SLIP (document, word) pairs: (word, n), of LEAST_LENGTH letters and LEAST_COUNT places."""
    # A shorter run can't make a word: a slip only takes a letter away.
    runs = F.regexp_extract_all(F.translate(F.col(text), UPPER, LOWER), F.lit(f"[{LETTERS}]{{{LEAST_LENGTH},}}"), F.lit(0))
    plain = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.explode(runs).alias("run"))
    hashed = plain.withColumn("hash", F.crc32(F.concat_ws(":", "key", "run").cast("binary")))
    gone = (F.col("hash") % F.length("run")).cast("int")
    slipped = F.concat(F.substring("run", F.lit(1), gone), F.substring("run", gone + 2, F.length("run")))
    word = F.when(F.col("hash") % SLIP == 0, slipped).otherwise(F.col("run"))
    return (
        hashed.select(word.alias("word"))
        .filter(F.length("word") >= LEAST_LENGTH)
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") >= LEAST_COUNT)
    )


def gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Batches put together to tables of about so many rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) >= rows:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


def gram_codes(letters: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The codes of the grams of 1, 2, ... MOST_GRAM letters at each place; a letter is a byte."""
    code = letters.astype(np.uint64)
    yield 1, code
    for size in range(2, MOST_GRAM + 1):
        code = code[:-1] << np.uint64(8) | letters[size - 1 :].astype(np.uint64)
        yield size, code


def frequent_grams(words: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of the grams that are more than a share of all places: at most FREQUENT_SHARE of each size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in gathered(batches, WORDS_AT_ONCE):
            letters, offsets = column_bytes(table.column("letters"))
            ends = np.repeat(offsets[1:], np.diff(offsets))
            for size, code in gram_codes(letters):
                if size >= LEAST_GRAM:
                    inside = np.arange(len(code)) + size <= ends[: len(code)]
                    codes, counts = np.unique(code[inside], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(codes.view(np.int64)), pa.array(counts)], names=["gram", "n"])

    places = words.agg(F.sum(F.length("letters"))).first()[0] or 0
    least = max(FREQUENT_LEAST, places // FREQUENT_SHARE)
    found = words.select("letters").mapInArrow(run, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    rows = found.filter(F.col("n") > least).toPandas()
    return rows["gram"].to_numpy(np.int64).view(np.uint64), rows["n"].to_numpy(np.int64)


class Grams:
    """The kept grams of words, by place, and for each word the most of them that one edit affects."""

    def __init__(self, letters: np.ndarray, offsets: np.ndarray, most: int, frequent: Table) -> None:
        ends = np.repeat(offsets[1:], np.diff(offsets))
        at = np.flatnonzero(np.arange(len(letters)) + LEAST_GRAM <= ends)
        size = np.full(len(at), LEAST_GRAM)
        code = letters[at].astype(np.uint64) << np.uint64(8) | letters[at + 1].astype(np.uint64)
        growing, cut = np.arange(len(at)), np.zeros(len(at), bool)
        for grown in range(LEAST_GRAM, most):
            growing = growing[frequent.get(code[growing]) >= 0]
            over = at[growing] + grown >= ends[at[growing]]
            cut[growing[over]] = True  # the choice saw the word's end: a further letter would change it
            growing = growing[~over]
            code[growing] = code[growing] << np.uint64(8) | letters[at[growing] + grown].astype(np.uint64)
            size[growing] = grown + 1
        end = at + size
        # Words follow each other, so running maxima never carry from one word into the next.
        read = np.maximum.accumulate(np.where(cut, end, end - 1))
        keep = np.ones(len(at), bool)
        keep[1:] = end[1:] > np.maximum.accumulate(end)[:-1]
        self.at, self.end, self.code, read = at[keep], end[keep], code[keep], read[keep]
        self.word = np.searchsorted(offsets, self.at, "right") - 1
        self.first = np.searchsorted(self.at, offsets)
        self.affected = self._affected(offsets, most, read)

    def _affected(self, offsets: np.ndarray, most: int, read: np.ndarray) -> np.ndarray:
        sizes = np.diff(offsets) + 1  # places to edit: each letter, and behind the last
        place = spread(offsets[:-1], sizes)
        word = np.repeat(np.arange(len(sizes)), sizes)
        low = np.maximum(np.searchsorted(read, place, "left"), self.first[:-1][word])
        before = np.searchsorted(self.at, place, "right") - 1
        covered = np.searchsorted(self.end, place + most, "right") - 1
        high = np.minimum(np.maximum(before, covered), self.first[1:][word] - 1)
        return np.maximum.reduceat(np.maximum(high - low + 1, 0), np.cumsum(sizes) - sizes)


def gram_size(length: np.ndarray) -> np.ndarray:
    """The longest gram for pairs whose shorter word has this length."""
    return np.minimum(length // 2, MOST_GRAM)


def list_key(code: np.ndarray, size: int, side: int, distance: np.ndarray) -> np.ndarray:
    """The list of a gram at a distance from the word's start (side 0) or end (1); the side is the key's last bit."""
    salt = (distance.astype(np.uint64) * np.uint64(16) + np.uint64(2 * size + side)) * GOLDEN
    return (mix(mix(code) + salt) & ~np.uint64(1) | np.uint64(side)).view(np.int64)


POSTING = "list bigint, letters binary, n bigint"


def postings(words: DataFrame, codes: np.ndarray, counts: np.ndarray) -> DataFrame:
    """Each word under the lists of its bound plus one rarest grams: (list, letters, n)."""
    shared = words.sparkSession.sparkContext.broadcast((codes, counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = Table.of(*shared.value)
        for table in gathered(batches, WORDS_AT_ONCE):
            table = table.combine_chunks()
            lengths = np.diff(column_bytes(table.column("letters"))[1])
            for most in np.unique(np.concatenate([gram_size(lengths), gram_size(np.maximum(lengths - 1, LEAST_LENGTH))])).tolist():
                takes_part = (gram_size(lengths) == most) | (gram_size(np.maximum(lengths - 1, LEAST_LENGTH)) == most)
                some = table.filter(pa.array(takes_part))
                letters, offsets = column_bytes(some.column("letters"))
                grams = Grams(letters, offsets, most, frequent)
                rarity = np.maximum(frequent.get(grams.code), 0)
                order = np.lexsort((grams.at, mix(grams.code), rarity, grams.word))
                word = grams.word[order]
                order = order[np.arange(len(order)) - grams.first[word] <= grams.affected[word]]
                word, code = grams.word[order], grams.code[order]
                lists = [
                    list_key(code, most, 0, grams.at[order] - offsets[word]),
                    list_key(code, most, 1, offsets[word + 1] - grams.at[order]),
                ]
                taken = some.take(pa.array(np.tile(word, 2)))
                yield from pa.table(
                    {"list": pa.array(np.concatenate(lists)), "letters": taken.column("letters"), "n": taken.column("n")}
                ).combine_chunks().to_batches(max_chunksize=WORDS_AT_ONCE)

    return words.mapInArrow(run, POSTING)


def relisted(crowded: DataFrame) -> DataFrame:
    """The words of crowded lists under what is left of them without one letter, within their list.

    Words of one length meet where the same letter is taken out (side 0); a word meets those one letter longer whose rest it is (side 1).
    Words of over WIDE letters meet by their first or last half instead, one of which an edit leaves alone.
    """

    def listed(lists: np.ndarray, rest: np.ndarray, place: np.ndarray | int, side: int) -> np.ndarray:
        salt = (np.asarray(place).astype(np.uint64) * np.uint64(2) + np.uint64(side)) * GOLDEN
        return (mix(lists.view(np.uint64) + mix(rest + salt)) & ~np.uint64(1) | np.uint64(side)).view(np.int64)

    def rests(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = column_bytes(table.column("letters"))
        lists, sizes = table.column("list").to_numpy(), np.diff(offsets)
        row = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(data)) - offsets[row]
        until = np.cumsum(BYTE_VALUES[data] * powers(int(sizes.max(initial=0)) + 1)[place])
        before = until - BYTE_VALUES[data] * powers(1 + int(place.max(initial=0)))[place]
        base = np.append(np.uint64(0), until)[offsets[:-1]]
        whole = until[offsets[1:] - 1] - base
        rest = before - base[row] + (whole[row] - (until - base[row])) * np.uint64(pow(WORD_BASE, -1, 2**64))
        replaced = np.flatnonzero(lists[row] & 1 == 0)
        new = np.ones(len(data), bool)
        new[1:] = (data[1:] != data[:-1]) | (place[1:] == 0)  # of a run of one letter each leaves the same
        shorter = np.flatnonzero(new)
        rows = [row[replaced], row[shorter], np.arange(len(sizes))]
        keys = [
            listed(lists[row[replaced]], rest[replaced], place[replaced], 0),
            listed(lists[row[shorter]], rest[shorter], 0, 1),
            listed(lists, whole, 0, 1),
        ]
        return np.concatenate(rows), np.concatenate(keys)

    def halves(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        rows, keys = [], []
        for i, (key, word) in enumerate(zip(table.column("list").to_pylist(), table.column("letters").to_pylist(), strict=True)):
            for size in {len(word) // 2, (len(word) - 1) // 2}:
                for end, part in enumerate((word[:size], word[-size:])):
                    name = b"%d:%d:%d:" % (key, size, end)
                    made = int.from_bytes(hashlib.blake2b(name + part, digest_size=8).digest(), "big", signed=True)
                    rows.append(i)
                    keys.append(made & ~1 | (end | key & 1))
        return np.array(rows, np.int64), np.array(keys, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pa.compute.binary_length(batch.column("letters")).to_numpy()
            for some, way in ((sizes <= WIDE + 1, rests), (sizes >= WIDE, halves)):
                if some.any():
                    table = pa.Table.from_batches([batch]).filter(pa.array(some)).combine_chunks()
                    rows, keys = way(table)
                    taken = table.take(pa.array(rows)).set_column(0, "list", pa.array(keys))
                    yield from taken.combine_chunks().to_batches(max_chunksize=WORDS_AT_ONCE)

    return crowded.select("list", "letters", "n").mapInArrow(run, POSTING)


def one_apart(a: bytes, b: bytes) -> bool:
    """Whether two words differ by one inserted, deleted or replaced letter."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    first = next((i for i, x in enumerate(a) if x != b[i]), len(a))
    return a[first + (len(a) == len(b)) :] == b[first + 1 :]


class Verifier:
    """Compares pairs of a table's words; their letters are laid out side by side once."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        self.data, self.offsets, self.sizes = data, offsets, np.diff(offsets)
        short = np.flatnonzero(self.sizes <= WIDE)
        sizes = self.sizes[short]
        self.padded = np.zeros((len(self.sizes), int(sizes.max(initial=0)) + 1), np.uint8)
        self.padded[np.repeat(short, sizes), spread(np.zeros(len(short), np.int64), sizes)] = data[spread(offsets[short], sizes)]

    def good(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Which pairs are one apart; the left word of a pair is the shorter one if they differ in length."""
        good = np.zeros(len(left), bool)
        wide = self.sizes[right] > WIDE
        for i in np.flatnonzero(wide).tolist():
            a, b = (self.data[self.offsets[x] : self.offsets[x + 1]].tobytes() for x in (left[i], right[i]))
            good[i] = one_apart(a, b)
        at = np.flatnonzero(~wide)
        a, b = self.padded[left[at]], self.padded[right[at]]
        apart = a != b
        same = self.sizes[left[at]] == self.sizes[right[at]]
        good[at[same]] = apart[same].sum(1) == 1
        longer = np.flatnonzero(~same)
        if len(longer):
            a, b, apart, column = a[longer], b[longer], apart[longer], np.arange(self.padded.shape[1] - 1)
            moved = (a[:, :-1] != b[:, 1:]) & (column >= apart.argmax(1)[:, None]) & (column < self.sizes[left[at[longer]]][:, None])
            good[at[longer]] = ~moved.any(1)
        return good


def met(keys: np.ndarray, sizes: np.ndarray, marks: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one list that can be near: lengths at most one apart, on side 1 exactly one, and few different letters.

    Rows are sorted by list and length.
    """
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    begins = np.flatnonzero(new)
    counts = np.diff(np.append(begins, len(keys)))
    near = lambda i, j: np.bitwise_count(marks[i] ^ marks[j]) <= 2

    # All short lists at once: each row with the next, the next but one, ...
    for step in range(1, min(FEW, int(counts.max(initial=0)))):
        some = begins[(counts > step) & (counts <= FEW)]
        i = spread(some, counts[(counts > step) & (counts <= FEW)] - step)
        j = i + step
        gap = sizes[j] - sizes[i]
        keep = (gap <= 1) & ((gap == 1) | (keys[i] & 1 == 0))
        i, j = i[keep], j[keep]
        keep = near(i, j)
        yield i[keep], j[keep]
    # Long lists: each length with itself and with the next.
    for begin, count in zip(begins[counts > FEW].tolist(), counts[counts > FEW].tolist(), strict=True):
        cuts = begin + np.append(np.flatnonzero(np.diff(sizes[begin : begin + count], prepend=-1)), count)
        for a, b, c in zip(cuts[:-1].tolist(), cuts[1:].tolist(), np.append(cuts[2:], -1).tolist(), strict=True):
            others = range(b, c) if c >= 0 and sizes[b] == sizes[a] + 1 else range(b, b)
            start = a if keys[begin] & 1 == 0 else b
            end = others.stop
            if end <= start:
                continue
            for low in range(a, b, 512):
                high = min(low + 512, b)
                i, j = np.nonzero(np.bitwise_count(marks[low:high, None] ^ marks[None, start:end]) <= 2)
                i, j = i + low, j + start
                yield i[i < j], j[i < j]


LINK = "letters binary, n bigint, other binary, other_n bigint"


def links(lists: DataFrame) -> DataFrame:
    """Near words of one list, each pair once per list: (letters, n, other, other_n)."""

    def answer(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        data, offsets = column_bytes(table.column("letters"))
        keys, sizes, n = table.column("list").to_numpy(), np.diff(offsets), table.column("n").to_numpy()
        order = np.lexsort((sizes, keys))
        begin = offsets[:-1][order]
        keys, sizes, n = keys[order], sizes[order], n[order]
        data = data[spread(begin, sizes)]
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        marks = np.bitwise_or.reduceat(np.uint64(1) << ((data.astype(np.uint64) - np.uint64(97)) & np.uint64(63)), offsets[:-1])
        verifier = Verifier(data, offsets)
        found, held, waiting = [], [], 0

        def settle() -> None:
            if held:
                i, j = np.concatenate(held, axis=1)
                good = verifier.good(i, j)
                found.append((i[good], j[good]))
                held.clear()

        for i, j in met(keys, sizes, marks):
            for low in range(0, len(i), PAIRS_AT_ONCE):
                held.append((i[low : low + PAIRS_AT_ONCE], j[low : low + PAIRS_AT_ONCE]))
                waiting += len(held[-1][0])
                if waiting >= PAIRS_AT_ONCE:
                    settle()
                    waiting = 0
        settle()
        left, right = np.concatenate(found, axis=1) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        raw = data.tobytes()
        spelt = lambda rows: pa.array([raw[a:b] for a, b in zip(offsets[rows].tolist(), offsets[rows + 1].tolist(), strict=True)], pa.binary())
        return pa.RecordBatch.from_arrays(
            [spelt(left), pa.array(n[left]), spelt(right), pa.array(n[right])], names=["letters", "n", "other", "other_n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(x.num_rows for x in held) < WORDS_AT_ONCE:
                continue
            table = pa.Table.from_batches(held)
            # The last list may go on in the next batch.
            lists = table.column("list").to_numpy()
            whole = int(np.searchsorted(lists, lists[-1]))
            if whole:
                yield answer(table.slice(0, whole))
            held = table.slice(whole).combine_chunks().to_batches()
        if held:
            yield answer(pa.Table.from_batches(held))

    return lists.repartition("list").sortWithinPartitions("list").mapInArrow(run, LINK)


def near_words(words: DataFrame) -> DataFrame:
    """All pairs of near words, both ways round: (letters, n, other, other_n) of ``(letters, n)`` rows, ``letters`` in Latin-1.

    Runs Spark jobs; ``words`` is read several times: pass a materialized table.
    """
    listed = materialize(postings(words, *frequent_grams(words)), "lists")
    crowded = materialize(listed.groupBy("list").count().filter(F.col("count") > CROWD).select("list"), "crowded")
    if not crowded.isEmpty():
        listed = listed.join(crowded, "list", "left_anti").unionByName(relisted(listed.join(crowded, "list", "left_semi")))
    # Both words of a pair are in the order of their letters, so that a pair found in several lists is one row.
    found = links(listed)
    first = F.col("letters") < F.col("other")
    ordered = found.select(
        F.when(first, F.struct("letters", "n")).otherwise(F.struct(F.col("other").alias("letters"), F.col("other_n").alias("n"))).alias("a"),
        F.when(first, F.struct(F.col("other").alias("letters"), F.col("other_n").alias("n"))).otherwise(F.struct("letters", "n")).alias("b"),
    ).distinct()
    way = lambda a, b: F.struct(
        F.col(f"{a}.letters").alias("letters"), F.col(f"{a}.n").alias("n"),
        F.col(f"{b}.letters").alias("other"), F.col(f"{b}.n").alias("other_n"),
    )
    return ordered.select(F.explode(F.array(way("a", "b"), way("b", "a"))).alias("link")).select("link.*")


def roots(forms: DataFrame) -> DataFrame:
    """(letters, root): where the forms lead in the end, of ``(letters, form)`` rows. Each round doubles the way; counts grow along it, so it ends."""
    reached = forms.select("letters", F.col("form").alias("root"))
    while True:
        ahead = reached.select(F.col("letters").alias("root"), F.col("root").alias("further"))
        reached = materialize(
            reached.join(ahead, "root", "left").select("letters", F.coalesce("further", "root").alias("root"), F.col("further").alias("moved")),
            "roots",
        )
        if reached.filter("moved IS NOT NULL").isEmpty():
            return reached.drop("moved")
        reached = reached.drop("moved")


def variants(words: DataFrame) -> DataFrame:
    """Of ``(word, n)`` rows, each word with its form and root: word, n, n_near, form, form_n, root.

    Words are lower-case letters up to U+00FF, LEAST_LENGTH or more, each given once.
    """
    words = materialize(words.select(F.encode("word", LATIN).alias("letters"), "n"), "words")
    best = F.min(F.struct((-F.col("other_n")).alias("rank"), F.col("other").alias("form")))
    near = near_words(words).groupBy("letters", "n").agg(F.count("*").alias("n_near"), best.alias("best"))
    common = -F.col("best.rank") >= RATIO * F.col("n")
    near = materialize(
        near.select(
            "letters", "n_near", F.when(common, F.col("best.form")).alias("form"), F.when(common, -F.col("best.rank")).alias("form_n")
        ),
        "near",
    )
    leading = roots(near.filter("form IS NOT NULL").select("letters", "form"))
    spelt = lambda name: F.decode(F.col(name), LATIN).alias(name)
    return (
        words.join(near.join(leading, "letters", "left"), "letters", "left")
        .withColumn("root", F.coalesce("root", "letters"))
        .select(
            F.decode("letters", LATIN).alias("word"), "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
            spelt("form"), "form_n", spelt("root"),
        )
    )


def spelling_variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The corpus's words, slips included, each with its form and root."""
    return variants(corpus_words(docs, key, text))


def _crc_table() -> list[int]:
    """What four bits shifted out of a CRC-32 leave behind."""
    out = list(range(16))
    for _ in range(4):
        out = [x >> 1 ^ (0xEDB88320 if x & 1 else 0) for x in out]
    return out


_CHAIN = math.ceil(math.log(2**63, RATIO))  # a form is RATIO times as frequent, so no chain is longer
SQL = f"""
WITH RECURSIVE runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS key,
    unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[{LETTERS}]{{{LEAST_LENGTH},}}')) AS run FROM documents),
used AS (SELECT key, run, count(*) AS c, hex(encode(key || ':' || run)) AS h FROM runs GROUP BY key, run),
halves AS (SELECT *, list_transform(range(length(h)), lambda i: CAST(instr('0123456789ABCDEF',
    substr(h, CAST(i + CASE WHEN i % 2 = 0 THEN 2 ELSE 0 END AS INT), 1)) - 1 AS BIGINT)) AS bits FROM used),
hashed AS (SELECT run, c, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bits),
    lambda c, x: xor(c >> 4, CAST({_crc_table()} AS BIGINT[])[1 + (xor(c, x) & 15)]))) AS hash FROM halves),
slipped AS (SELECT c, CASE WHEN hash % {SLIP} = 0
    THEN substr(run, 1, hash % length(run)) || substr(run, hash % length(run) + 2) ELSE run END AS word FROM hashed),
words AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM slipped WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(c) >= {LEAST_COUNT}),
rests AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM words, unnest(range(length(word))) AS u(i)),
link AS (SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n FROM rests a JOIN rests b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word),
longer AS (SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n FROM rests a JOIN words b ON a.rest = b.word),
links AS (SELECT * FROM link UNION ALL SELECT * FROM longer UNION ALL SELECT other, other_n, word, n FROM longer),
best AS (SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n FROM links GROUP BY word),
formed AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= {RATIO} * w.n THEN other END AS form,
    CASE WHEN other_n >= {RATIO} * w.n THEN other_n END AS form_n FROM words w LEFT JOIN best USING (word)),
walk AS (SELECT word, word AS here, 0 AS steps FROM formed
    UNION ALL SELECT walk.word, formed.form, steps + 1 FROM walk JOIN formed ON formed.word = walk.here WHERE formed.form IS NOT NULL AND steps < {_CHAIN}),
ends AS (SELECT word, arg_max(here, steps) AS root FROM walk GROUP BY word)
SELECT word, n, n_near, form, form_n, root FROM formed JOIN ends USING (word)
"""
