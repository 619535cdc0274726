import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallycast.llm import divergence
from tallycast.llm.text import column_bytes
from tests.llm.helpers import SCHEMA, empty_documents, lowered, odd_documents

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"


def brute(rows, least=3, top=200):
    """(lang, source, part, item, value, rank) of (lang, source, text) rows, in whole numbers."""
    docs, used, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = Counter(re.findall(TERM, lowered(text)))
        used[lang, source].update(terms)
        docs[lang].update(terms.keys())
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        sources = sorted(s for a, s in groups if a == lang)
        share = lambda count, total: 1 + 10**9 * (count + 1) // (total + len(kept))  # noqa: E731, B023
        total = {s: sum(used[lang, s][t] for t in kept) for s in sources}
        p = {s: {t: share(used[lang, s][t], total[s]) for t in kept} for s in sources}
        whole = {t: sum(used[lang, s][t] for s in sources) for t in kept}
        q = {t: share(whole[t], sum(whole.values())) for t in kept}
        for s in sources:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in sources if o != s]
            typical = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if used[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", typical)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(ranked) if part == "pair" or i < top]
    return sorted(out)


def rows(df):
    return sorted((r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in df.collect())


def made(spark, rng, n=120):
    words = ["".join(rng.choices("abcdéß", k=rng.randint(1, 3))) for _ in range(60)] + ["Ab", "aB", "漢", "x1y", "\xa0z", "ÀB"]
    joints = [" ", " ", "\n", ",", ", ", "-", "\t", "\x00", "1", "　"]
    data = []
    for i in range(n):
        text = "".join(rng.choice(words) + rng.choice(joints) for _ in range(rng.choice([0, 3, 10, 60])))
        lang = rng.choice(["en", "en", "en", "de", None])
        source = "lone" if lang == "de" and i < 60 else rng.choice(["s1", "s1", "s1", "s2", "s3", "Ω", None])
        data.append((i // 2, rng.choice([text, None, text]), lang, source, 0))
    data += [(1, None, "none", "a", 0), (2, "once only", "none", "b", 0), (3, "!!! 123", "solo", "x", 0)]
    return spark.createDataFrame(data, SCHEMA).repartition(5)


@pytest.mark.parametrize("held,slice_,block,meetings", [(1 << 24, 1024, 1 << 16, 1 << 20), (5, 2, 30, 3)])
def test_follows_the_definition(spark, held, slice_, block, meetings, monkeypatch):
    for name, value in (("HELD", held), ("HELD_BYTES", held), ("SLICE", slice_), ("BLOCK", block), ("MEETINGS", meetings)):
        monkeypatch.setattr(divergence, name, value)
    docs = made(spark, random.Random(held))
    want = brute([(r.lang, r.source, r.text) for r in docs.collect()], top=4)
    assert rows(divergence.divergence(docs, top=4)) == want
    assert {r[2] for r in want} == {"pair", "term"} and {r[0] for r in want} >= {"", "en", "de", "none"}


def test_a_document_counts_once_for_a_term_of_several_chunks(spark):
    data = [(i, text, "en", "s", 0) for i, text in enumerate(["cat cat, (cat) Cat", "cat! dog. dog", "dog? cow", "cow"])]
    docs = spark.createDataFrame(data, SCHEMA).repartition(3)
    found = divergence.term_counts(docs, min_docs=2)
    assert sorted((r.term, r.n, r.all_n, r.sources) for r in found.collect()) == [("cat", 5, 5, 1), ("cow", 2, 2, 1), ("dog", 3, 3, 1)]
    assert divergence.term_counts(docs, min_docs=3).count() == 0


def test_chunks_of_one_hash_are_told_apart():
    def colliding(data, offsets, kind):
        found = divergence_words(data, offsets, kind)
        found.hashes &= np.uint64(3)
        return found

    divergence_words = divergence.words
    data, offsets = column_bytes(pa.array(["a bb a cc", "cc a b1 dd", "", "bb"]))
    found = colliding(data, offsets, divergence.CHUNK)
    number, example = divergence.numbered_chunks(data, found)
    spelt = [data[s : s + n].tobytes() for s, n in zip(found.starts, found.lengths)]
    assert [spelt[example[i]] for i in number] == spelt and len(example) == len(set(spelt))


def test_large_counts_stay_exact(spark):
    share = spark.range(1).select(divergence._share(F.lit(9 * 10**17), F.lit(10**18), F.lit(7)).alias("x")).first().x
    assert share == 1 + 10**9 * (9 * 10**17 + 1) // (10**18 + 7)


def test_odd_rows(spark):
    docs = odd_documents(spark).withColumns({"term": F.lit(1), "item": F.lit("x"), "value": F.lit(2), "p": F.lit(3), "docs": F.lit(0)})
    assert rows(divergence.divergence(docs)) == brute([(r.lang, r.source, r.text) for r in docs.collect()])
    assert divergence.divergence(empty_documents(spark)).count() == 0
