import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tallycast.llm import near
from tallycast.llm.components import components
from tests.llm.helpers import documents, empty_documents, odd_documents, shingle_list


def brute_similarity(a, b):
    a, b = Counter(shingle_list(a)), Counter(shingle_list(b))
    p, q = ({k: n / sum(x.values()) for k, n in x.items()} for x in (a, b))
    return sum(
        1 / sum(max(p.get(e, 0) / p[d], q.get(e, 0) / q[d]) for e in p.keys() | q.keys()) for d in p.keys() & q.keys()
    )


def classes(texts, threshold=0.8):
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if texts[i] == texts[j] or brute_similarity(texts[i], texts[j]) >= threshold:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(i) for i in range(len(texts))]


def prose(rng, n):
    return [f"w{rng.randint(0, 500)}" for _ in range(n)]


def edited(rng, found, edits):
    found = list(found)
    for _ in range(edits):
        found[rng.randrange(len(found))] = f"new{rng.randint(0, 10**6)}"
    return found


def group_texts(rng):
    """Singles, chains, large groups about a base that the copies are near to but not to each other, repeated lines."""
    texts = [prose(rng, rng.randint(1, 120)) for _ in range(60)]
    base = prose(rng, 150)
    texts += [edited(rng, base, rng.randint(0, 5)) for _ in range(60)] + [base]
    chain = prose(rng, 200)
    for _ in range(12):
        chain = edited(rng, chain, 3)
        texts.append(chain)
    line = prose(rng, 12)
    texts += [line * k + prose(rng, 20) for k in (3, 4, 9, 10, 11)] + [line * 10, line * 12]
    shared = prose(rng, 50)
    texts += [prose(rng, 25) + shared + prose(rng, 25) for _ in range(40)]
    return [" ".join(x) for x in texts]


@pytest.mark.parametrize("block", [16, 512])
def test_classes_follow_the_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", block)
    rng = random.Random(8)
    texts = group_texts(rng)
    texts += [texts[3], texts[3], texts[70], texts[5].upper(), " " + texts[6].replace(" ", "\n")]
    order = list(range(len(texts)))
    rng.shuffle(order)
    texts = [texts[i] for i in order]
    rows = near.near_classes(documents(spark, texts).repartition(6)).orderBy("doc_id").collect()
    want = classes(texts)
    assert [r.class_id for r in rows] == want
    sizes = Counter(want)
    assert [r.class_size for r in rows] == [sizes[c] for c in want]
    assert [r.kept for r in rows] == [i == c for i, c in enumerate(want)]


def test_similarity_is_exact():
    rng = random.Random(2)
    texts = [" ".join(rng.choices("abcd", k=rng.randint(0, 40))) for _ in range(40)] + ["", "x"]
    sets = near.weighted(pa.array(texts))
    cut = lambda i: (sets[0][sets[2][i] : sets[2][i + 1]], sets[1][sets[2][i] : sets[2][i + 1]])
    for i in range(len(texts)):
        many = near.similarities(sets, i, np.arange(len(texts)))
        for j in range(len(texts)):
            want = brute_similarity(texts[i], texts[j])
            assert near.similarity(cut(i), cut(j)) == pytest.approx(want)
            assert many[j] == pytest.approx(want)


def test_sketches_estimate_the_similarity():
    rng = random.Random(6)
    pairs = []
    for _ in range(150):
        base = prose(rng, rng.randint(30, 200)) * rng.choice([1, 1, 3])
        pairs.append((" ".join(base), " ".join(edited(rng, base, rng.randint(0, 12)))))
    made = [near.sketch(*near.weighted(pa.array([p[i] for p in pairs]))) for i in (0, 1)]
    errors = [(a == b).mean() - brute_similarity(*pair) for a, b, pair in zip(*made, pairs, strict=True)]
    assert abs(np.mean(errors)) < 0.012 and np.std(errors) < 0.05


def test_early_termination_changes_nothing():
    hashes, counts, first = near.weighted(pa.array(["a b c d e f g h a b c d e f", "x"]))
    whole = near.sketch(hashes, counts, first)
    alone = near.sketch(hashes[first[1] :], counts[first[1] :], np.array([0, 1]))
    assert (whole[1] == alone[0]).all() and len(set(alone[0].tolist())) == 1


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = near.near_classes(docs).collect()
    assert len(rows) == docs.count()
    by = {r.doc_id: r for r in rows}
    assert by[1].class_id == by[2].class_id == by[7].class_id == 1  # null, empty, and white space alone
    assert by[3].class_size == 2 and by[None].class_id is None and by[None].kept
    assert near.near_classes(empty_documents(spark)).count() == 0
    with_nulls = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (4, "a b c")], "doc_id bigint, text string")
    assert {r.class_id for r in near.near_classes(with_nulls).collect()} == {4}


def test_components(spark):
    rng = random.Random(1)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(300, 300), (7, 7)]
    pairs += [(rng.randint(400, 500), rng.randint(400, 500)) for _ in range(60)]
    rng.shuffle(pairs)
    want = {}
    for n in {x for p in pairs for x in p}:
        want[n] = n
    for _ in range(200):
        for a, b in pairs:
            want[a] = want[b] = min(want[a], want[b])
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "u bigint, v bigint")).collect()}
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {n: c for n, c in want.items() if n in linked}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_a_chance_agreement_in_low_bytes_hides_no_pair(spark):
    rng = random.Random(4)
    base = prose(rng, 200)
    texts = [" ".join(base), " ".join(edited(rng, base, 1))]
    winners = near.sketch(*near.weighted(pa.array(texts)))
    own = near.buckets(winners).view(np.int64)
    band = int(np.flatnonzero(own[0] == own[1])[-1])
    own[1, :band] = own[0, :band] + 1  # no earlier bucket in common, though all low bytes agree
    press = near.zstandard.ZstdCompressor().compress
    members = [
        (int(own[0, band]), band, 3, bytes([i]), bytes([i]), False, bytes(near.REGISTERS), own[i].tolist(), press(t.encode()))
        for i, t in enumerate(texts)
    ]
    names = "bucket bigint, band int, size bigint, node binary, component binary, is_hub boolean, low binary, buckets array<bigint>, small binary"
    assert band > 0
    assert near.links_apart(spark.createDataFrame(members, names), 0.8).count() == 1
    own[1, 0] = own[0, 0]  # compared there
    members[1] = (*members[1][:7], own[1].tolist(), members[1][8])
    assert near.links_apart(spark.createDataFrame(members, names), 0.8).count() == 0
