"""How far each source's vocabulary lies from that of its language and of the language's other sources.

Chunk factorization: white-space chunks are counted per document and gathered per (language, source, chunk) in the task that reads the
texts; each globally distinct chunk is cut into terms once, the terms are joined back to the counts, and occurrences and distinct documents
are aggregated per (language, source, term). Terms have no white space in them, so no term is lost between chunks.

A document may hold a term in several chunks, so documents can't be added up over chunks. As only ``min_docs`` of them matter, a chunk of
a language in fewer documents carries their numbers, and another one a mark; these are united per term. Whether a term is in that many
documents is exact, and what a count carries is bounded.

All arithmetic is in whole numbers. A pair's value is a sum over all kept terms, of which most are in neither source or in one: with p0 for a
count of zero, it is the constant of (p0, q0) times the kept terms, plus what a term of one source alone adds, worked out once per different
p of the source, plus a correction for the terms of both, which are met term by term. A term of very many sources is dealt out in slices of
SLICE sources.

Defined cases: null text, language and source are ''; every row is a document, also repeated rows and those of equal or null ids; a group
without terms has pair values like any other; a language without kept terms has values 0; an empty table gives no rows; other columns are
not read. Texts may be of any length: a task holds the chunks of one text, or of HELD_BYTES of them.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallycast.llm.text import Words, byte_class, column_bytes, pieces, spread, words
from tallycast.session import materialize

MIN_DOCS = 3
SCALE = 1_000_000_000
PRIOR = 1
TOP_TERMS = 200
HELD_BYTES = 1 << 23  # texts whose chunks a task gathers before it hands them on
HELD = 1 << 16  # chunk counts whose terms a task gathers before it hands them on
HANDED_ON = 1 << 14  # rows of a batch
SLICE = 1024  # sources of a term that meet the others in one task
BLOCK = 1 << 13  # counts that meet in one task, about
MEETINGS = 1 << 20  # pairs of sources worked on at once
TERM_BYTES = re.compile(rb"[A-Za-z\x80-\xff]+")
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
CHUNK = byte_class([b for b in range(256) if b not in b" \t\n\x0b\x0c\r"], lower=False)
LETTER = np.array([b >= 128 or chr(b).isalpha() for b in range(256)])
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def gathered(batches: Iterator[pa.RecordBatch], size: Callable[[pa.RecordBatch], int], most: int) -> Iterator[pa.Table]:
    """Batches put together until their sizes reach ``most``."""
    held, so_far = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            so_far += size(batch)
        if so_far >= most:
            yield pa.Table.from_batches(held).combine_chunks()
            held, so_far = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def codes_of(column: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    """Small numbers for a column's values, and the values."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    coded = column.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def begins(*columns: np.ndarray) -> np.ndarray:
    """Where a run of equal rows begins."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in columns])
    return np.flatnonzero(new)


def lists(values: pa.Array, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def numbered_chunks(data: np.ndarray, found: Words) -> tuple[np.ndarray, np.ndarray]:
    """A number for each different chunk, and an occurrence of each. Hashes only find candidates: all bytes are compared."""
    _, first, number = np.unique(found.hashes, return_index=True, return_inverse=True)
    example = first[number]
    differ = found.lengths != found.lengths[example]
    at = np.flatnonzero(~differ)
    if len(at):
        sizes = found.lengths[at]
        same = data[spread(found.starts[at], sizes)] == data[spread(found.starts[example[at]], sizes)]
        differ[at] = ~np.logical_and.reduceat(same, np.cumsum(sizes) - sizes)
    others: dict[bytes, int] = {}
    more = []
    for i in np.flatnonzero(differ).tolist():  # another chunk of the same hash
        chunk = data[found.starts[i] : found.starts[i] + found.lengths[i]].tobytes()
        if chunk not in others:
            others[chunk] = len(first) + len(more)
            more.append(i)
        number[i] = others[chunk]
    return number, np.concatenate([first, np.array(more, np.int64)])


COUNT = np.dtype([("source", "<i8"), ("n", "<u4")])
CHUNKS = "chunk string, lang bigint, docs binary, counts binary"


def packed(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Slices of an array as binary values."""
    return pa.Array.from_buffers(
        pa.binary(), len(offsets) - 1, [None, pa.py_buffer((offsets * values.itemsize).astype(np.int32)), pa.py_buffer(values.tobytes())]
    )


def unpacked(column: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """The values of packed slices in a row, and the size of each."""
    data, offsets = column_bytes(column)
    return np.frombuffer(data.tobytes(), kind), np.diff(offsets) // kind.itemsize


def chunk_counts(docs: DataFrame, least: int) -> DataFrame:
    """Of ``(lang, source, doc, text)`` rows the chunks with a letter: per language and chunk the occurrences by source, and the documents.

    Chunks are counted per document, then gathered over the texts of a task. ``counts`` packs a number for each source, ``docs`` the documents if
    they are fewer than ``least``; else it is empty. ``lang`` and ``source`` are numbers.
    """

    def gather(table: pa.Table) -> pa.RecordBatch:
        data, offsets = column_bytes(table.column("text"))
        lang, source, doc = (table.column(name).to_numpy() for name in ("lang", "source", "doc"))
        order = np.lexsort((source, lang))
        rank = np.argsort(order)
        lang, source, doc = lang[order], source[order], doc[order]
        found = words(data, offsets, CHUNK)
        letters = np.concatenate([[0], np.cumsum(LETTER[data], dtype=np.int32)])
        use = letters[found.starts + found.lengths] > letters[found.starts]
        del letters
        row = rank[found.rows[use]]
        found = Words(found.starts[use], found.lengths[use], found.hashes[use], found.first)
        number, example = numbered_chunks(data, found)
        number *= len(order)
        number += row
        pairs, times = np.unique(number, return_counts=True)  # by chunk, language, source and document
        del number, row
        chunk, row = pairs // len(order), pairs % len(order)
        line = begins(chunk, lang[row]) if len(pairs) else np.zeros(0, np.int64)
        entry = begins(chunk, lang[row], source[row]) if len(pairs) else line
        sizes = np.diff(np.append(line, len(pairs)))
        listed = np.where(sizes >= least, 0, sizes)
        which = example[chunk[line]]
        counts = np.zeros(len(entry), COUNT)
        counts["source"] = source[row[entry]]
        counts["n"] = np.add.reduceat(times, entry) if len(entry) else 0
        spelt = packed(data[spread(found.starts[which], found.lengths[which])], np.concatenate([[0], np.cumsum(found.lengths[which])]))
        return pa.RecordBatch.from_arrays(
            [
                spelt.cast(pa.string()),
                pa.array(lang[row[line]], pa.int64()),
                packed(doc[row[spread(line, listed)]].astype("<i8"), np.concatenate([[0], np.cumsum(listed)])),
                packed(counts, np.searchsorted(entry, np.append(line, len(pairs)))),
            ],
            names=["chunk", "lang", "docs", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in gathered(pieces(batches, "text"), lambda batch: batch.column("text").nbytes, HELD_BYTES):
            yield from _in_parts(gather(table))

    return docs.mapInArrow(run, CHUNKS)


TERMS = "lang bigint, term string, source bigint, n bigint, full boolean, docs array<bigint>"


def chunk_terms(chunks: DataFrame, least: int) -> DataFrame:
    """The chunks' terms: their occurrences, a row per language, term and source, and their documents, a row without source.

    The shuffle brings all counts of a chunk together, in order; so each distinct chunk is cut into terms once, and these are joined back to its
    counts and gathered with those of the task's other chunks.
    """

    def gather(table: pa.Table) -> Iterator[pa.RecordBatch]:
        table = table.combine_chunks()
        coded, distinct = codes_of(table.column("chunk"))
        cut = [TERM_BYTES.findall(chunk.encode().lower()) for chunk in distinct.to_pylist()]  # A-Z only, as these are bytes
        sizes = np.array([len(x) for x in cut], np.int64)
        term, terms = codes_of(pa.array([x for found in cut for x in found], pa.binary()).cast(pa.string()))
        each = sizes[coded]
        row = np.repeat(np.arange(len(each)), each)
        if not len(row):
            return
        term = term[spread((np.cumsum(sizes) - sizes)[coded], each)]
        lang, langs = codes_of(table.column("lang"))
        keys, item = np.unique(lang[row] * len(terms) + term, return_inverse=True)
        key_lang, key_term = langs.take(pa.array(keys // len(terms))), terms.take(pa.array(keys % len(terms)))

        counts, sizes = unpacked(table.column("counts"), COUNT)
        at = spread((np.cumsum(sizes) - sizes)[row], sizes[row])
        sources, source = np.unique(counts["source"], return_inverse=True)
        code = np.repeat(item, sizes[row]) * len(sources) + source[at]
        order = np.argsort(code, kind="stable")
        code = code[order]
        first = begins(code)
        numbers = np.add.reduceat(counts["n"][at[order]].astype(np.int64), first)
        code = code[first]
        where = pa.array(code // len(sources))
        yield pa.RecordBatch.from_arrays(
            [
                key_lang.take(where), key_term.take(where), pa.array(sources[code % len(sources)]), pa.array(numbers),
                pa.nulls(len(code), pa.bool_()), pa.nulls(len(code), pa.list_(pa.int64())),
            ],
            names=["lang", "term", "source", "n", "full", "docs"],
        )

        docs, sizes = unpacked(table.column("docs"), np.dtype("<i8"))
        full = np.zeros(len(keys), bool)
        full[item[sizes[row] == 0]] = True
        doc = docs[spread((np.cumsum(sizes) - sizes)[row], sizes[row])]
        item = np.repeat(item, sizes[row])
        use = ~full[item]
        item, doc = item[use], doc[use]
        order = np.lexsort((doc, item))
        item, doc = item[order], doc[order]
        new = begins(item, doc) if len(item) else np.zeros(0, np.int64)
        item, doc = item[new], doc[new]
        sizes = np.bincount(item, minlength=len(keys))
        full |= sizes >= least
        use = ~full[item]
        sizes[full] = 0
        yield pa.RecordBatch.from_arrays(
            [
                key_lang, key_term, pa.nulls(len(keys), pa.int64()), pa.array(np.zeros(len(keys), np.int64)), pa.array(full),
                lists(pa.array(doc[use], pa.int64()), np.concatenate([[0], np.cumsum(sizes)])),
            ],
            names=["lang", "term", "source", "n", "full", "docs"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for table in gathered(batches, lambda batch: batch.num_rows, HELD):
            table = table if held is None else pa.concat_tables([held, table])
            # The last chunk may go on in the next table.
            chunk = table.column("chunk")
            last = chunk[-1].as_py()
            whole = table.num_rows
            while whole and chunk[whole - 1].as_py() == last:
                whole -= 1
            if not whole and table.num_rows > HELD:  # very many counts of one chunk
                whole = table.num_rows
            held = table.slice(whole)
            if whole:
                for made in gather(table.slice(0, whole)):
                    yield from _in_parts(made)
        if held is not None and held.num_rows:
            for made in gather(held):
                yield from _in_parts(made)

    return chunks.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(run, TERMS)


def _in_parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, HANDED_ON):
        yield batch.slice(at, HANDED_ON)


def numbered_groups(docs: DataFrame, lang: str, source: str) -> tuple[DataFrame, Column, Column]:
    """The table's languages and sources with a number for each language and group, and these numbers as columns over the documents.

    Numbers are hashes; a seed is taken under which no two of the table's share one.
    """
    plain = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    named = materialize(docs.select(plain(lang).alias("lang"), plain(source).alias("source")).distinct(), "groups")
    seed = 0
    while True:
        number = lambda *columns: F.xxhash64(F.lit(seed), *columns)  # noqa: B023, E731
        tried = named.withColumns({"lang_number": number(F.col("lang")), "number": number(F.col("lang"), F.col("source"))})
        sizes = tried.agg(*(F.count_distinct(c) for c in ("lang", "lang_number", "number")), F.count("*")).first()
        if sizes[0] == sizes[1] and sizes[2] == sizes[3]:
            return tried, number(plain(lang)), number(plain(lang), plain(source))
        seed += 1


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = MIN_DOCS) -> DataFrame:
    """Occurrences by language and source of the terms in at least ``min_docs`` documents of the language.

    Columns lang, term, source, n, and over the term's sources all_n and their number. Runs Spark jobs: groups and term counts are read
    twice and so written first.
    """
    groups, lang_number, number = numbered_groups(docs, lang, source)
    rows = docs.select(
        lang_number.alias("lang"), number.alias("source"), F.monotonically_increasing_id().alias("doc"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    terms = materialize(chunk_terms(chunk_counts(rows, min_docs), min_docs), "terms")
    # A task hands on a term a few times at most, with fewer than min_docs documents or none: the lists are bounded by the tasks.
    some = F.size(F.array_distinct(F.flatten(F.collect_list("docs"))))
    kept = (
        terms.filter("source IS NULL")
        .groupBy("lang", "term")
        .agg((F.max("full") | (some >= min_docs)).alias("kept"))
        .filter("kept")
        .drop("kept")
    )
    counts = terms.filter("source IS NOT NULL").select("lang", "term", "source", "n").join(kept, ["lang", "term"])
    of_term = W.partitionBy("lang", "term")
    summed = counts.groupBy("lang", "term", "source").agg(F.sum("n").alias("n")).withColumns(
        {"all_n": F.sum("n").over(of_term), "sources": F.count("*").over(of_term)}
    )
    return (
        summed.withColumnRenamed("source", "number")
        .drop("lang")
        .join(groups.select("number", "lang", "source"), "number")
        .select("lang", "term", "source", "n", "all_n", "sources")
    )


def _share(count: Column, total: Column, kinds: Column) -> Column:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * kinds)), exact: the product is a decimal of 38 digits."""
    wide = (count + PRIOR).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(18,0)")
    below = F.greatest(total + PRIOR * kinds, F.lit(1)).cast("decimal(20,0)")
    return F.call_function("div", wide, below) + 1


def _apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def met_sums(counts: DataFrame) -> DataFrame:
    """For terms of both sources of a pair, what the pair's value has beyond the two sources' own sums.

    Of ``(lang, source, term, p, p0, sources)`` rows; (lang, source, item, value), a few rows for each pair.
    """
    blocks = max(counts.count() // BLOCK, 1)
    slices = F.ceil(F.col("sources") / SLICE).cast("bigint")
    dealt = (
        counts.filter("sources > 1")
        .withColumn("block", F.pmod(F.xxhash64("term"), F.lit(blocks)))
        .withColumn("own", F.pmod(F.xxhash64("source"), slices))
        .withColumn("slice", F.explode(F.sequence(F.lit(0).cast("bigint"), slices - 1)))
    )

    def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (p - q) * (p - q) // q

    def run(table: pa.Table) -> pa.Table:
        lang = table.column("lang")[0]
        sources = table.column("source").combine_chunks().dictionary_encode()
        terms = table.column("term").combine_chunks().dictionary_encode().indices.to_numpy()
        order = np.argsort(terms, kind="stable")
        terms = terms[order]
        source = sources.indices.to_numpy()[order].astype(np.int64)
        p, p0 = (table.column(name).to_numpy()[order] for name in ("p", "p0"))
        left = np.flatnonzero((table.column("own").to_numpy() == table.column("slice").to_numpy())[order])
        first = np.searchsorted(terms, terms[left])
        sizes = np.searchsorted(terms, terms[left], "right") - first
        kinds = len(sources.dictionary)
        codes, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
        until = np.cumsum(sizes)
        at = 0
        while at < len(left):
            end = max(int(np.searchsorted(until, (until[at - 1] if at else 0) + MEETINGS, "right")), at + 1)
            a = np.repeat(left[at:end], sizes[at:end])
            b = spread(first[at:end], sizes[at:end])
            value = apart(p[a], p[b]) - apart(p[a], p0[b]) - apart(p0[a], p[b]) + apart(p0[a], p0[b])
            code = np.concatenate([codes, source[a] * kinds + source[b]])
            codes, where = np.unique(code, return_inverse=True)
            merged = np.zeros(len(codes), np.int64)
            np.add.at(merged, where, np.concatenate([sums, value]))
            sums, at = merged, end
        other = codes // kinds != codes % kinds
        codes, sums = codes[other], sums[other]
        return pa.table(
            {
                "lang": pa.repeat(lang, len(codes)),
                "source": sources.dictionary.take(pa.array(codes // kinds)),
                "item": sources.dictionary.take(pa.array(codes % kinds)),
                "value": pa.array(sums),
            }
        )

    return dealt.groupBy("lang", "block", "slice").applyInArrow(run, "lang string, source string, item string, value bigint")


def divergence(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = MIN_DOCS, top: int = TOP_TERMS
) -> DataFrame:
    """For each group its other sources by distance (part ``pair``, all) and its most typical terms (part ``term``, to rank ``top``).

    Columns lang, source, part, item, value, rank.
    """
    counts = materialize(term_counts(docs, text, lang, source, min_docs), "kept")
    plain = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    named = docs.select(plain(lang).alias("lang"), plain(source).alias("source")).distinct()
    own = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    # Each term once, however many sources have it.
    langs = counts.groupBy("lang", "term").agg(F.first("all_n").alias("all_n")).groupBy("lang").agg(
        F.count("*").alias("kinds"), F.sum("all_n").alias("lang_total")
    )
    zero = lambda name: F.coalesce(name, F.lit(0).cast("bigint")).alias(name)
    groups = materialize(
        named.join(own, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .select("lang", "source", zero("total"), zero("kinds"), zero("lang_total"))
        .withColumn("p0", _share(F.lit(0).cast("bigint"), F.col("total"), F.col("kinds"))),
        "groups",
    )
    shares = materialize(
        counts.join(groups, ["lang", "source"])
        .withColumn("p", _share(F.col("n"), F.col("total"), F.col("kinds")))
        .withColumn("q", _share(F.col("all_n"), F.col("lang_total"), F.col("kinds")))
        .select("lang", "source", "term", "sources", "p", "q", "p0"),
        "shares",
    )
    typical = shares.filter("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _apart(F.col("p"), F.col("q")).alias("value")
    )
    # As many rows as the answer has.
    pairs = groups.select("lang", "source", "p0", "kinds").join(
        groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0")), "lang"
    ).filter("source <> item")
    p0, q0, p = F.col("p0"), F.col("q0"), F.col("p")
    # Worked out once for each different p of a source.
    levels = shares.groupBy("lang", "source", "p").agg(F.count("*").alias("times"))
    of_source = pairs.join(levels, ["lang", "source"]).select(
        "lang", "source", "item", (F.col("times") * (_apart(p, q0) - _apart(p0, q0))).alias("value")
    )
    of_item = pairs.join(levels.withColumnRenamed("source", "item"), ["lang", "item"]).select(
        "lang", "source", "item", (F.col("times") * (_apart(p0, p) - _apart(p0, q0))).alias("value")
    )
    neither = pairs.select("lang", "source", "item", (F.col("kinds") * _apart(p0, q0)).alias("value"))
    distances = (
        neither.unionByName(of_source)
        .unionByName(of_item)
        .unionByName(met_sums(shares.select("lang", "source", "term", "sources", "p", "p0")))
        .groupBy("lang", "source", "item")
        .agg(F.sum("value").alias("value"))
        .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    )
    by_value = W.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    rank = F.row_number().over(by_value).cast("int")
    return distances.withColumn("rank", rank).unionByName(typical.withColumn("rank", rank).filter(F.col("rank") <= top))


SQL = rf"""
WITH docs AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
used AS (SELECT row, lang, source, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM docs),
kept AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS c FROM used GROUP BY 1, 2 HAVING count(DISTINCT row) >= {MIN_DOCS}),
langs AS (SELECT lang, count(*) AS v, sum(c) AS n FROM kept GROUP BY 1),
own AS (SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS c FROM used JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
groups AS (SELECT g.lang, g.source, coalesce(sum(c), 0) AS n FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN own USING (lang, source) GROUP BY 1, 2),
grid AS (SELECT g.lang, g.source, k.term, coalesce(o.c, 0) AS c, 1 + {SCALE} * (coalesce(o.c, 0) + {PRIOR}) // (g.n + {PRIOR} * l.v) AS p,
    1 + {SCALE} * (k.c + {PRIOR}) // (l.n + {PRIOR} * l.v) AS q
    FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN own o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term),
typical AS (SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // q AS BIGINT) AS value FROM grid WHERE c > 0 AND p > q),
apart AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM grid a JOIN grid b USING (lang, term) WHERE a.source <> b.source GROUP BY 1, 2, 3),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM typical))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""
