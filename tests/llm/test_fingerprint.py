import random

import pyarrow as pa

from tallycast.llm import fingerprint
from tests.llm.helpers import documents, empty_documents, odd_documents, sha, shingle_list


def jaccard(a, b):
    a, b = set(shingle_list(a)), set(shingle_list(b))
    return len(a & b) / len(a | b)


def prose(rng, n):
    return " ".join(rng.choice("the of and to in is was he for it with as his on be".split()) + str(rng.randint(0, 30)) for _ in range(n))


def brute(rows):
    rows = sorted(rows, key=lambda r: r[0])
    out = []
    for i, (key, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        out.append((key, len(text), sha(edited), jaccard(text, edited), jaccard(text, following)))
    return out


def test_edited_texts_and_likeness_follow_the_brute_force(spark):
    rng = random.Random(1)
    texts = [prose(rng, rng.choice([0, 3, 40, 300, 900])) for _ in range(120)]
    texts += [texts[0], None, "", "é" * 9, prose(rng, 20000)]
    texts += [t + " more words at the end" for t in texts[:20] if t]
    docs = documents(spark, texts).repartition(7)
    got = {r.doc_id: r for r in fingerprint.edited_likeness(docs).collect()}
    assert len(got) == len(texts)
    errors = []
    for key, n, digest, near_edited, near_next in brute(list(enumerate(texts))):
        assert (got[key].n_chars, got[key].edited_sha256) == (n, digest)
        errors += [abs(got[key].near_edited - near_edited), abs(got[key].near_next - near_next)]
    assert max(errors) < 0.25 and sum(errors) / len(errors) < 0.03


def test_equal_texts_have_equal_fingerprints_that_unpack(spark):
    made = fingerprint.sketches(pa.array(["a b c d e f", "x", "a b c d e f", "", "A B C D E F"]))
    prints = fingerprint.packed(made)
    assert prints[0] == prints[2] == prints[4] and len(set(prints)) == 3
    assert (fingerprint.unpacked(prints[1]) == made[1]).all()
    assert fingerprint.likeness(made[0], made[2]) == 1
    docs = documents(spark, ["p q", "p q", None])
    rows = fingerprint.fingerprints(docs, out="print").collect()
    assert rows[0]["print"] == rows[1]["print"] != rows[2]["print"]


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = fingerprint.edited_likeness(docs).collect()
    assert len(rows) == docs.count()
    by = {r.doc_id: r for r in rows}
    assert by[None].edited_sha256 == sha("no id here at all my friend"[:21])  # the next text, of id 1, is null: nothing to take
    assert by[1].near_next == 1  # null and empty
    assert all(0 <= r.near_edited <= 1 for r in rows)
    assert fingerprint.edited_likeness(empty_documents(spark)).count() == 0
    one = fingerprint.edited_likeness(documents(spark, ["abcdefgh"])).collect()
    assert one[0].edited_sha256 == sha("abcdefab")


def test_densification_is_the_same_for_equal_bins():
    import numpy as np

    minima = np.full((3, fingerprint.BINS), fingerprint.EMPTY, np.uint64)
    minima[0, [3, 77, 400]] = [5, 6, 7]
    minima[1] = minima[0]
    minima[2, 9] = 4
    full = fingerprint.densify(minima)
    assert (full[0] == full[1]).all() and (full[2] == 4).all() and set(full[0].tolist()) == {5, 6, 7}
