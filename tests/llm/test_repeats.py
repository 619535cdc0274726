import hashlib
import random

import numpy as np
import pytest

from tallycast.llm import repeats
from tallycast.llm.runindex import RunIndex
from tests.llm.helpers import documents, empty_documents, odd_documents, sha


def brute(rows, length=100):
    """Digests of distinct (id, text) rows with ascending ids."""
    seen, out = set(), []
    for key, text in sorted(rows, key=lambda r: r[0]):
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for s in range(len(raw) - length + 1):
            window = raw[s : s + length]
            if window in seen:
                gone[s : s + length] = True
            seen.add(window)
        kept = bytes(x for x, g in zip(raw, gone, strict=True) if not g)
        runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((key, len(raw), int(gone.sum()), runs, sha(kept)))
    return sorted(out)


def digests(df):
    return sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def corpus(rng):
    letters = "abcdé "
    make = lambda n: "".join(rng.choices(letters, k=n))
    passages = [make(rng.randint(60, 300)) for _ in range(6)]
    texts = []
    for _ in range(120):
        parts = [rng.choice([make(rng.randint(0, 80)), rng.choice(passages)]) for _ in range(rng.randint(0, 5))]
        texts.append("".join(parts))
    texts += ["ab" * 150, "x" * 400, "x" * 99, "x" * 100, None, "", texts[5], texts[5], make(5000)]
    texts += [texts[-1][1000:1500] + "!" + texts[-1][2000:2100]]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("crowd,index_bytes", [(4096, 1 << 20), (2, 1 << 20), (5, 300), (0, 1)])
def test_digests_follow_the_brute_force(spark, crowd, index_bytes, monkeypatch):
    monkeypatch.setattr(repeats, "CROWD", crowd)
    monkeypatch.setattr(repeats, "INDEX_BYTES", index_bytes)
    texts = corpus(random.Random(crowd))
    docs = documents(spark, texts).repartition(5)
    assert digests(repeats.repeat_digests(docs)) == brute(list(enumerate(texts)))


def test_small_batches_change_nothing(spark):
    texts = corpus(random.Random(9))
    docs = documents(spark, texts).repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = digests(repeats.repeat_digests(docs))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == brute(list(enumerate(texts)))


def test_given_documents_follow_the_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert digests(repeats.repeat_digests(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_other_lengths(spark):
    texts = corpus(random.Random(4))
    got = digests(repeats.repeat_digests(documents(spark, texts), length=60))
    assert got == brute(list(enumerate(texts)), 60)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = repeats.repeat_digests(docs).collect()
    assert len(rows) == docs.count()
    by = {r.doc_id: r for r in rows}
    assert (by[1].n_bytes, by[1].n_removed, by[1].kept_sha256) == (0, 0, sha(b""))
    assert by[4].n_removed == 49_999 and by[4].n_spans == 1  # the first string stays only where nothing earlier covers it
    kept = repeats.without_repeats(docs)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    assert {r.key for r in kept.collect()} == {7}
    assert repeats.repeat_digests(empty_documents(spark)).count() == 0


def test_repeated_rows_and_ids(spark):
    long = "".join(random.Random(1).choices("abcdef ", k=500))
    rows = [(1, long), (1, long), (1, "other " + long), (None, long), (None, long)]
    got = repeats.repeat_digests(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    removed = sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in got)
    # Null ids come first and keep theirs; repeated rows have one result.
    assert removed == [(0, 500, 0), (0, 500, 0), (1, 500, 500), (1, 500, 500), (1, 506, 500)]


def test_kept_texts_are_the_kept_bytes(spark):
    texts = corpus(random.Random(3))
    docs = documents(spark, texts)
    kept = {r.doc_id: r for r in repeats.without_repeats(docs).collect()}
    for key, size, removed, _, digest in brute(list(enumerate(texts))):
        if all(ord(c) < 128 for c in texts[key] or ""):
            assert sha(kept[key].text) == digest and kept[key].n_chars == size - removed


def test_index_finds_every_repeat():
    rng = random.Random(5)
    for length in (3, 8, 20):
        parts = [bytes(rng.choices(b"ab", k=rng.randint(1, 60))) for _ in range(40)] + [b"a" * 80, b"ab" * 30]
        index = RunIndex(np.frombuffer(b"".join(parts), np.uint8), np.array([len(p) for p in parts]))
        seen, want = set(), []
        for p, start in zip(parts, index.starts.tolist(), strict=True):
            for s in range(len(p) - length + 1):
                if p[s : s + length] in seen:
                    want.append(start + s)
                seen.add(p[s : s + length])
        assert index.repeated(length).tolist() == want


def test_index_is_small_on_repetitive_data():
    part = bytes(random.Random(1).choices(b"abcdefgh", k=300))
    index = RunIndex(np.frombuffer(part * 50, np.uint8), np.full(50, 300))
    assert index.runs < 1000 and len(index.kept) < 1000 and index.size == 301 * 50


def test_rows_of_one_id_are_told_apart_by_their_whole_texts(spark):
    rng = random.Random(12)
    start = "".join(rng.choices("abcdefg", k=150))
    rows = [(key, start + "".join(rng.choices("hijk", k=rng.randint(0, 60)))) for key in [None] * 40 + [5] * 40 + [6]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)

    def place(row):
        digest = hashlib.md5(row[1].encode()).digest()
        halves = [int.from_bytes(digest[i : i + 8], "big", signed=True) for i in (0, 8)]
        return (-1 if row[0] is None else row[0], *halves)

    order = sorted(set(rows), key=place)
    want = {order[i]: x[1:] for i, x in enumerate(brute([(i, text) for i, (_, text) in enumerate(order)]))}
    got = sorted((r.doc_id or -1, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.repeat_digests(docs).collect())
    assert got == sorted((key or -1, *want[key, text]) for key, text in rows)
    assert sum(x[2] == 0 for x in got) == sum(row == order[0] for row in rows)
