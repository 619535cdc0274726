"""Words, shingles and hashes of Arrow string columns, computed for a whole batch at once.

Texts are handled as UTF-8 bytes. A null text counts as empty. Hashes are 64 bits wide.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

from tallycast.session import ship

#: Rows that Spark hands to a Python worker at once; texts are long, and the default of 10 000 rows is tens of MB on either side.
ARROW_ROWS = 2000
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
SHINGLE_BASE = np.uint64(0xD6E8FEB86659FD93)
WORD_BASE = 0x2545F4914F6CDD1D
PAD_WORD = np.uint64(0x5851F42D4C957F2D)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * GOLDEN)


def byte_class(members: bytes | range, lower: bool = True) -> np.ndarray:
    """A table over the 256 byte values: 0 outside the class, else one more than the (lower-cased) byte."""
    table = np.zeros(256, np.uint16)
    for value in members:
        low = value + 32 if lower and 65 <= value <= 90 else value
        table[value] = low + 1
    return table


WHITE = b" \t\n\x0b\x0c\r"
#: White space separates words; A-Z are lower-cased.
SPACED = byte_class([b for b in range(256) if b not in WHITE])
#: Letters, digits and every byte beyond ASCII make words; A-Z are lower-cased.
ALNUM = byte_class([b for b in range(256) if chr(b).isalnum() and b < 128 or b >= 128])


@dataclass
class Words:
    """The words of a batch of texts in order."""

    starts: np.ndarray  # byte positions in the batch's data
    lengths: np.ndarray
    hashes: np.ndarray
    first: np.ndarray  # index of each text's first word, and the number of words at the end

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def bound_arrow_batches(spark: SparkSession) -> None:
    """Set the session's Arrow batches to ARROW_ROWS rows and ship the package; the registered queries and stages do so, the operators leave it alone."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and the offsets of its rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    binary = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = binary.buffers()
    ends = np.frombuffer(offsets, np.int64)[binary.offset : binary.offset + len(binary) + 1] if len(binary) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None and ends[-1] > ends[0] else np.zeros(0, np.uint8)
    return raw, ends - ends[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows with about ``limit`` bytes of text; a longer text stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = column_bytes(batch.column(column))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


_powers = np.ones(1, np.uint64)
_multipliers = np.ones(0, np.uint64)


def powers(count: int) -> np.ndarray:
    """The first ``count`` powers of the base of rolling hashes."""
    global _powers
    if len(_powers) < count:
        grown = np.full(max(count, 256), WORD_BASE, np.uint64)
        grown[0] = 1
        _powers = np.multiply.accumulate(grown)
    return _powers


def multipliers(count: int) -> np.ndarray:
    """An odd number for each place in a word. They don't follow a rule that structured words could share, as powers of one base would."""
    global _multipliers
    if len(_multipliers) < count:
        _multipliers = mix(np.arange(1, max(2 * count, 256) + 1, dtype=np.uint64) * GOLDEN + PAD_WORD) | np.uint64(1)
    return _multipliers


def words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray = SPACED) -> Words:
    """Maximal runs of the class's bytes; none reaches over the end of its text."""
    codes = kind[data]
    inside = codes > 0
    before = np.empty(len(inside), bool)
    before[1:] = inside[:-1]
    begins = offsets[:-1][offsets[:-1] < len(data)]
    before[begins] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(len(inside), bool)
    after[:-1] = inside[1:]
    ends = offsets[1:][offsets[1:] > 0] - 1
    after[ends] = False
    lengths = np.flatnonzero(inside & ~after) + 1 - starts
    first = np.searchsorted(starts, offsets)
    if not len(starts):
        return Words(starts, lengths, np.zeros(0, np.uint64), first)
    return Words(starts, lengths, run_hashes(codes[inside], lengths), first)


def run_hashes(codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hashes of runs that lie one after the other in ``codes`` (class codes, all above 0; no run is empty)."""
    from_run = np.cumsum(lengths) - lengths
    place = np.arange(len(codes)) - np.repeat(from_run, lengths)
    table = multipliers(int(lengths.max()))
    return mix(np.add.reduceat(BYTE_VALUES[codes - 1] * table[place], from_run))


def prefix_hashes(data: np.ndarray, found: Words, size: int, kind: np.ndarray) -> np.ndarray:
    """Hashes of the first ``size`` bytes of each word, or of all if it has fewer."""
    if not len(found.starts):
        return found.hashes
    lengths = np.minimum(found.lengths, size)
    return run_hashes(kind[data[spread(found.starts, lengths)]], lengths)


def shingles(found: Words, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``width`` words, and each text's first one.

    A text of fewer words has one shingle: its words and as many blanks as are missing.
    """
    counts = found.counts
    padded = np.maximum(counts, width)
    first = np.concatenate([[0], np.cumsum(padded)])
    full = np.full(first[-1], PAD_WORD, np.uint64)
    full[np.arange(len(found.hashes)) + np.repeat(first[:-1] - found.first[:-1], counts)] = found.hashes
    total = np.zeros(max(len(full) - width + 1, 0), np.uint64)
    for j in range(width):
        total = total * SHINGLE_BASE + full[j : j + len(total)]
    each = padded - width + 1
    out = np.concatenate([[0], np.cumsum(each)])
    keep = np.arange(out[-1]) + np.repeat(first[:-1] - out[:-1], each)
    return mix(total[keep]), out


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices of ragged slices: for each i the ``counts[i]`` numbers from ``starts[i]`` on."""
    ends = np.cumsum(counts)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)
