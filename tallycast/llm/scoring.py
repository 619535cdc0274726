"""Language-model scores from a log-frequency Bloom filter, and exact unigram scores beside them.

Texts are read in blocks. A block's different tokens are sent to segments of the hash space, where the counts of all training
texts are added up and sent back to the blocks that asked, so no table of the whole vocabulary is ever in one place. Pairs of
tokens are counted the same way; a pair's count, quantised on a logarithmic scale, goes into its segment's Bloom filter as
that many entries: (pair, 1), (pair, 2), ... A filter stays with its segment: a count is read back there by probing until an
entry is missing, and the entries found are sent back to the blocks that asked. A pair's probability mixes its share of its first token's count with the smoothed unigram probability; the shares of
a token's followers sum to 1 at most. Pairs met once are left to the unigram part.

A filter takes at least BITS_PER_ENTRY bits for each entry whatever the corpus, so probes err equally often at every size.

Tokens are runs of bytes other than white space with A-Z lower-cased, then one end per text. A text is for training unless the CRC-32 of its
id as text is 0 modulo FOLDS.

Defined cases: a null or empty text has the end token alone; a null id counts as the empty text; without training texts N and V are 0,
known counts 0 and every token has the same probability 1; repeated rows count and are returned each.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast.llm.text import GOLDEN, SHINGLE_BASE, SPACED, column_bytes, mix, pieces, words

FOLDS = 10
BLOCK_BYTES = 3 << 21
LEAST_SEGMENTS = 64
PRIOR = 0.1  # added to every token's count
PAIR_SHARE = 0.5
STEP = 1.5  # of the logarithmic scale
LEAST_PAIR = 2
PROBES = 4
BITS_PER_ENTRY = 12
PAIR_SHIFT = np.uint64(16)  # 48 bits tell pairs apart well enough for a filter
PAIR_BITS = ~np.uint64(0xFFFF)
END = np.uint64(0x6A09E667F3BCC909)
BEGIN = np.uint64(0xBB67AE8584CAA73B)
REPLY, STREAM = 1, 2


def pack(values: np.ndarray) -> bytes:
    """Numbers with their first bytes together, then their second bytes and so on, compressed."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(blob: bytes, dtype: type) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, each closed by the end, and the index of each text's first token."""
    found = words(data, offsets, SPACED)
    first = found.first + np.arange(len(found.first))
    out = np.full(first[-1], END, np.uint64)
    out[np.arange(len(found.hashes)) + found.rows] = found.hashes
    return out, first


def pairs(stream: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hashes of each token together with the one before it, or with the text's begin."""
    before = np.empty_like(stream)
    before[1:] = stream[:-1]
    before[first[:-1]] = BEGIN
    return mix(before * SHINGLE_BASE + stream)


def training(keys: list) -> np.ndarray:
    return np.array([zlib.crc32(str("" if key is None else key).encode()) % FOLDS != 0 for key in keys], bool)


def segment_of(hashes: np.ndarray, segments: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)).astype(np.int64)


def parted(hashes: np.ndarray, segments: int) -> np.ndarray:
    """Where each segment begins among sorted hashes, and their number at the end."""
    return np.searchsorted(segment_of(hashes, segments), np.arange(segments + 1))


# --- pair counts to Bloom filters


def quantised(counts: np.ndarray) -> np.ndarray:
    """The number of entries for a count: 1 from LEAST_PAIR on, and one more for each further STEP-fold."""
    return 1 + np.floor(np.log(counts / LEAST_PAIR) / np.log(STEP) + 1e-9).astype(np.int64)


def read_back(entries: np.ndarray) -> np.ndarray:
    """The middle of the counts that have this many entries; 0 for none."""
    low = LEAST_PAIR * STEP ** np.maximum(entries - 1, 0)
    return np.where(entries > 0, (low + low * STEP) / 2, 0)


def places(keys: np.ndarray, entry: int, probe: int, bits: np.ndarray | int) -> np.ndarray:
    """The bit that a probe of an entry looks at; ``bits`` are powers of two."""
    salt = np.array([(int(entry) * PROBES + probe) * int(GOLDEN) % 2**64], np.uint64)
    return (mix(keys + salt) & np.asarray(bits - 1, np.uint64)).astype(np.int64)


def bloom(keys: np.ndarray, counts: np.ndarray, most_bits: int | None = None) -> np.ndarray:
    """One segment's filter as bytes of eight bits; ``most_bits`` bounds it if given."""
    keep = counts >= LEAST_PAIR
    keys, entries = keys[keep], quantised(counts[keep])
    wanted = max(int(entries.sum()) * BITS_PER_ENTRY, 64)
    bits = 1 << (wanted - 1).bit_length()
    if most_bits is not None:
        bits = min(bits, 1 << (most_bits.bit_length() - 1))
    data = np.zeros(bits >> 3, np.uint8)
    for entry in range(1, int(entries.max(initial=0)) + 1):
        among = keys[entries >= entry]
        for probe in range(PROBES):
            place = places(among, entry, probe, bits)
            for bit in range(8):
                data[place[place & 7 == bit] >> 3] |= np.uint8(1 << bit)
    return data


class Filters:
    """The filters of some segments in a row."""

    def __init__(self, blobs: list[bytes]) -> None:
        parts = [np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8) for blob in blobs]
        sizes = np.array([len(x) for x in parts], np.int64)
        self.bits, self.start = sizes * 8, np.cumsum(sizes) - sizes
        self.data = np.concatenate(parts) if parts else np.zeros(0, np.uint8)

    def entries(self, keys: np.ndarray) -> np.ndarray:
        """How many entries each key has: probes until one is missing."""
        out = np.zeros(len(keys), np.int64)
        if not len(self.bits):
            return out
        at = np.arange(len(keys))
        segment = segment_of(keys, len(self.bits))
        bits, start = self.bits[segment], self.start[segment]
        entry = 1
        while len(at):
            held = np.arange(len(at))
            for probe in range(PROBES):
                place = places(keys[at[held]], entry, probe, bits[held])
                byte = self.data[start[held] + (place >> 3)]
                held = held[(byte >> (place & 7).astype(np.uint8)) & 1 == 1]
            at, bits, start = at[held], bits[held], start[held]
            out[at] = entry
            entry += 1
            if entry > 64:
                break
        return out


def grouped(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[int, list[dict]]]:
    """Rows of a sorted stream that share a value, as dictionaries."""
    held, value = [], None
    for batch in batches:
        for at in range(batch.num_rows):
            row = {name: batch.column(name)[at].as_py() for name in batch.schema.names}
            if held and row[column] != value:
                yield value, held
                held = []
            value = row[column]
            held.append(row)
    if held:
        yield value, held


# --- unigram counts and pair entries for each block, and the scores

MESSAGE = (
    "route bigint, kind int, block bigint, segment bigint, a binary, b binary, keys array<bigint>, sizes array<bigint>"
)


def message(**columns: list) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    names = [part.split()[0] for part in MESSAGE.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(columns[n], k) for n, k in zip(names, kinds, strict=True)], names=names)


def counted(stream: np.ndarray, use: np.ndarray, segments: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Different hashes and how often they are used, cut by segment, and the number of each place's hash."""
    found, numbers = np.unique(stream, return_inverse=True)
    counts = np.bincount(numbers[use], minlength=len(found)).astype(np.uint32)
    cuts = parted(found, segments).tolist()
    return [(found[a:b], counts[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], numbers


def ask(docs: DataFrame, segments: int) -> DataFrame:
    """A block's different tokens with their training counts, a row for each segment, then its different pairs, and its texts as token numbers.

    The segments of pairs are numbered after those of tokens.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 24
        for batch in pieces(batches, "text", BLOCK_BYTES):
            keys = batch.column("key").to_pylist()
            stream, first = tokens(*column_bytes(batch.column("text")))
            use = np.repeat(training(keys), np.diff(first))
            single, numbers = counted(stream, use, segments)
            double, _ = counted(pairs(stream, first) & PAIR_BITS, use, segments)
            hashes = [x for x, _ in single] + [x >> PAIR_SHIFT for x, _ in double]
            yield message(
                route=[*range(2 * segments), block],
                kind=[REPLY] * 2 * segments + [STREAM],
                block=[block] * (2 * segments + 1),
                segment=[*range(2 * segments), -1],
                a=[*map(pack, hashes), pack(numbers.astype(np.uint32))],
                b=[*(pack(x) for _, x in single + double), None],
                keys=[*[None] * 2 * segments, keys],
                sizes=[*[None] * 2 * segments, np.diff(first).tolist()],
            )
            block += 1

    return docs.mapInArrow(run, MESSAGE)


def answer(asked: DataFrame, segments: int) -> DataFrame:
    """Replace each block's counts: tokens get those of all blocks, with the segment's N and V; pairs get their entries in the segment's filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kinds = batch.column("kind").to_numpy()
                streams = int(np.searchsorted(kinds, STREAM))  # sorted by kind: these come last
                if streams:
                    yield batch.slice(0, streams)
                if streams < batch.num_rows:
                    passed.append(batch.slice(streams))
                    return

        passed: list[pa.RecordBatch] = []
        for segment, asked in grouped(rows(), "segment"):
            parts = [unpack(row["a"], np.uint64) for row in asked]
            ends = np.cumsum([len(part) for part in parts])
            found, at = np.unique(np.concatenate(parts), return_inverse=True)
            weights = np.concatenate([unpack(row["b"], np.uint32) for row in asked])
            counts = np.bincount(at, weights=weights, minlength=len(found)).astype(np.uint64)
            totals = [int(counts.sum()), int((counts > 0).sum())] if segment < segments else None
            if totals is None:
                found = found << PAIR_SHIFT
                made = bloom(found, counts).tobytes()
                counts = Filters([zstandard.ZstdCompressor(level=1).compress(made)]).entries(found).astype(np.uint8)
            for row, part, end in zip(asked, parts, ends, strict=True):
                yield message(
                    route=[row["block"]], kind=[REPLY], block=[row["block"]], segment=[segment], a=[row["a"] if totals else None],
                    b=[pack(counts[at[end - len(part) : end]])], keys=[totals], sizes=[None],
                )
        for batch in passed:
            yield batch
        for batch in batches:
            yield batch

    return asked.repartition("route").sortWithinPartitions("kind", "segment").mapInArrow(run, MESSAGE)


def scores(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every text's exact unigram score and its score by the pair model, both as log10 probabilities.

    Columns: the key (a bigint), held_out, n_tokens, n_known, train_tokens, base_score, score.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    segments = max(LEAST_SEGMENTS, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in grouped(batches, "block"):
            replies, of_pairs, stream = rows[:segments], rows[segments:-1], rows[-1]
            found = np.concatenate([unpack(row["a"], np.uint64) for row in replies])
            counts = np.concatenate([unpack(row["b"], np.uint64) for row in replies]).astype(float)
            total, kinds = (sum(row["keys"][i] for row in replies) for i in (0, 1))
            numbers = unpack(stream["a"], np.uint32)
            sizes = np.array(stream["sizes"], np.int64)
            first = np.concatenate([[0], np.cumsum(sizes)])
            single = (counts + PRIOR) / (total + PRIOR * (kinds + 1))
            base = np.log10(single)[numbers]
            count = counts[numbers]
            before = np.empty_like(count)
            before[1:] = count[:-1]
            before[first[:-1]] = count[first[1:] - 1]  # as many texts begin as end
            # The block asked for its pairs in ascending order.
            double = np.unique(pairs(found[numbers], first) & PAIR_BITS, return_inverse=True)[1]
            entries = np.concatenate([unpack(row["b"], np.uint8) for row in of_pairs])[double].astype(np.int64)
            share = np.minimum(read_back(entries) / np.maximum(before, 1), 1)
            model = np.log10(np.where(before > 0, PAIR_SHARE * share + (1 - PAIR_SHARE) * single[numbers], single[numbers]))
            known = np.add.reduceat((count > 0).astype(np.int64), first[:-1])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(stream["keys"], pa.int64()),
                    pa.array(~training(stream["keys"])),
                    pa.array(sizes),
                    pa.array(known),
                    pa.array(np.full(len(sizes), total, np.int64)),
                    pa.array(np.add.reduceat(base, first[:-1])),
                    pa.array(np.add.reduceat(model, first[:-1])),
                ],
                names=["key", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return (
        answer(ask(docs, segments), segments)
        .repartition("block")
        .sortWithinPartitions("block", "kind", "segment")
        .mapInArrow(
            run,
            "key bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
            "base_score double, score double",
        )
        .withColumnRenamed("key", key)
    )
