import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tallycast.llm import scoring
from tests.llm.helpers import documents, empty_documents, lowered, odd_documents, remainder

WORD = re.compile("[^\\x20\\x09-\\x0D]+")


def brute(rows):
    split = [(k, WORD.findall(lowered(t)) + [None]) for k, t in rows]
    counts = Counter()
    for k, found in split:
        if remainder("" if k is None else k, 10):
            counts.update(found)
    total, kinds = sum(counts.values()), len(counts)
    out = []
    for k, found in split:
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in found)
        held = remainder("" if k is None else k, 10) == 0
        out.append((k or -1, held, len(found), sum(counts[w] > 0 for w in found), total, round(base, 6)))
    return sorted(out)


def rows_of(df):
    return sorted((r.doc_id or -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in df.collect())


def test_given_documents_follow_the_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(5)
    made = scoring.scores(docs)
    assert rows_of(made) == brute([(r.doc_id, r.text) for r in docs.collect()])
    held = [r for r in made.collect() if r.held_out]
    assert all(r.score <= 0 for r in held)


def test_the_pair_model_is_better_on_held_out_texts(spark):
    rng = random.Random(3)
    follow = {i: rng.choices(range(300), k=4) for i in range(300)}
    texts = []
    for _ in range(600):
        at, out = rng.randrange(300), []
        for _ in range(60):
            out.append(f"w{at}")
            at = rng.choice(follow[at])
        texts.append(" ".join(out))
    rows = scoring.scores(documents(spark, texts).repartition(4)).filter("held_out").collect()
    assert sum(r.score for r in rows) > 0.6 * sum(r.base_score for r in rows)


@pytest.mark.parametrize("block", [50, 1 << 21])
def test_odd_rows(spark, block, monkeypatch):
    monkeypatch.setattr(scoring, "BLOCK_BYTES", block)
    docs = odd_documents(spark)
    assert rows_of(scoring.scores(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert scoring.scores(empty_documents(spark)).count() == 0


def test_filters_hold_quantised_counts():
    rng = np.random.default_rng(1)
    keys = np.sort(rng.integers(0, 2**63, 20_000, dtype=np.int64).astype(np.uint64) << np.uint64(1))
    counts = rng.geometric(0.2, len(keys)).astype(float)
    cuts = scoring.parted(keys, 8)
    import zstandard

    made = [scoring.bloom(keys[a:b], counts[a:b], 1 << 20) for a, b in zip(cuts[:-1], cuts[1:])]
    filters = scoring.Filters([zstandard.ZstdCompressor().compress(x.tobytes()) for x in made])
    entries = filters.entries(keys)
    want = np.where(counts >= 2, scoring.quantised(np.maximum(counts, 2)), 0)
    assert (entries >= want).all()  # an entry that was put in is never missing
    assert (entries != want).mean() < 0.03
    other = filters.entries(rng.integers(0, 2**63, 20_000, dtype=np.int64).astype(np.uint64))
    assert (other > 0).mean() < 0.03
    back = scoring.read_back(want[counts >= 2])
    assert (np.abs(np.log(back / counts[counts >= 2])) < np.log(scoring.STEP)).all()


def test_packing_round_trip():
    for dtype in (np.uint32, np.uint64):
        x = np.arange(1000, dtype=dtype) * dtype(977)
        assert (scoring.unpack(scoring.pack(x), dtype) == x).all()
        assert len(scoring.unpack(scoring.pack(x[:0]), dtype)) == 0


def test_no_total_bounds_the_filters(spark, monkeypatch):
    monkeypatch.setattr(scoring, "MAX_BITS", 1 << 12, raising=False)  # a total there once was
    rng = random.Random(7)
    made = [" ".join(f"w{rng.randrange(150)}" for _ in range(80)) for _ in range(400)]
    split = [(i, t.split() + [None]) for i, t in enumerate(made)]
    single, double = Counter(), Counter()
    for i, found in split:
        if remainder(i, 10):
            single.update(found)
            double.update(zip([""] + found, found))
    single[""] = single[None]  # as many texts begin as end
    total, kinds = sum(single.values()) - single[""], len(single) - 1
    off = []
    for r in scoring.scores(documents(spark, made).repartition(3)).collect():
        want, found = 0, split[r.doc_id][1]
        for a, b in zip([""] + found, found):
            n = double[a, b]
            back = float(scoring.read_back(scoring.quantised(np.array(n)))) if n >= scoring.LEAST_PAIR else 0
            alone = (single[b] + 0.1) / (total + 0.1 * (kinds + 1))
            want += math.log10(0.5 * min(back / single[a], 1) + 0.5 * alone)
        off.append(abs(r.score - want) / len(found))
    assert len(off) == 400 and np.mean(off) < 0.01
