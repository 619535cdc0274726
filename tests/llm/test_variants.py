import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallycast.llm import variants
from tallycast.llm.table import Table
from tallycast.llm.text import column_bytes
from tests.llm.helpers import documents, empty_documents, lowered, odd_documents


def brute_words(rows):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def apart(a, b):
    """Edit distance one, by the textbook table."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], min(last + (x != y), row[j] + 1, row[j + 1] + 1)
    return row[-1] == 1


def brute(words):
    near = {w: [v for v in words if v != w and abs(len(v) - len(w)) <= 1 and apart(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, words[w], len(near[w]), form[w] or "", words.get(form[w], 0), root))
    return sorted(out)


def rows(df):
    return sorted((r.word, r.n, r.n_near, r.form or "", r.form_n or 0, r.root) for r in df.collect())


def edited(rng, word, letters):
    i = rng.randint(0, len(word))
    return rng.choice([word[:i] + rng.choice(letters) + word[i:], word[:i] + word[i + 1 :], word[:i] + rng.choice(letters) + word[i + 1 :]])


def vocabulary(rng, n=260):
    letters = "abcdéÿ"
    syllables = ["ba", "dé", "caa", "ab", "d", "aaaa"]
    words = set()
    while len(words) < n:
        word = "".join(rng.choices(syllables, k=rng.randint(3, 8)))
        for _ in range(rng.randint(1, 4)):
            words.add(word)
            word = edited(rng, word, letters)
    words |= {"a" * k for k in range(7, 14)} | {"a" * 6 + "b", "b" + "a" * 6, "abababa", "bababab"}
    long = "".join(rng.choices(letters, k=300))
    words |= {long, long[:7] + long[8:], long[:200] + "z" + long[200:], "q" * 64, "q" * 65, "q" * 66, "q" * 30 + "é" + "q" * 34}
    return sorted(w for w in words if len(w) >= 7)


@pytest.mark.parametrize("least,crowd,at_once", [(32, 4096, 1 << 16), (2, 4096, 50), (3, 4, 30), (0, 1, 1 << 16)])
def test_all_near_words_are_found(spark, least, crowd, at_once, monkeypatch):
    monkeypatch.setattr(variants, "FREQUENT_LEAST", least)
    monkeypatch.setattr(variants, "CROWD", crowd)
    monkeypatch.setattr(variants, "WORDS_AT_ONCE", at_once)
    monkeypatch.setattr(variants, "FEW", 5 if crowd > 4 else 48)
    rng = random.Random(least)
    words = {w: rng.choice([1, 2, 9, 10, 25, 100, 300, 2500]) for w in vocabulary(rng)} | {"chainab": 3, "chainac": 30, "cheinac": 300}
    df = spark.createDataFrame(list(words.items()), "word string, n bigint").repartition(4)
    got = rows(variants.variants(df))
    assert got == brute(words)
    assert ("chainab", 3, 1, "chainac", 30, "cheinac") in got


@pytest.mark.parametrize("least", [1, 3, 10, 1000])
def test_bounds_leave_a_shared_gram(least):
    """Near words share all but the bounded number of grams, and one at least, at one distance from the start or the end."""
    rng = random.Random(least)
    letters = "abé"
    counts = Counter()
    words = ["".join(rng.choices(letters, k=rng.randint(7, 16))) for _ in range(400)]
    for w in words:
        raw = w.encode("latin-1")
        counts.update(int.from_bytes(raw[i : i + q], "big") for q in range(2, 7) for i in range(len(raw) - q + 1))
    frequent = [c for c, n in counts.items() if n > least]
    table = Table.of(frequent, [counts[c] for c in frequent])
    for w in words:
        v = edited(rng, w, letters + "z")
        if len(v) < 7 or v == w:
            continue
        most = int(variants.gram_size(np.array(min(len(v), len(w)))))
        grams = [variants.Grams(*column_bytes(pa.array([x.encode("latin-1")])), most, table) for x in (w, v)]
        left = [set(zip(g.code.tolist(), g.at.tolist())) for g in grams]
        right = [{(c, len(x) - p) for c, p in zip(g.code.tolist(), g.at.tolist())} for x, g in zip((w, v), grams)]
        for own in (0, 1):
            bound = len(grams[own].code) - int(grams[own].affected[0])
            shared = {c for c in left[own] if c in left[1 - own]} | {
                (c, len((w, v)[own]) - e) for c, e in right[own] if (c, e) in right[1 - own]
            }
            assert len(shared) >= bound >= 1, (w, v, bound)


def test_words_of_texts(spark):
    rng = random.Random(2)
    words = vocabulary(rng, 60) + ["Abcdefg", "ÀBCDEFGH", "×÷×÷×÷×", "abcdef", "ﬁabcdefg"]
    texts = [rng.choice([" ", "-", "1"]).join(rng.choices(words, k=rng.randint(0, 60))) for _ in range(120)] + [None, ""]
    docs = documents(spark, texts, first=-3).repartition(3)
    want = brute_words([(i - 3, t) for i, t in enumerate(texts)])
    assert sorted((r.word, r.n) for r in variants.corpus_words(docs).collect()) == sorted(want.items())
    assert rows(variants.spelling_variants(docs)) == brute(want)


def test_odd_rows(spark):
    docs = odd_documents(spark).withColumns({"word": F.lit(1), "letters": F.lit("x"), "list": F.lit(2), "n": F.lit(3), "run": F.lit(0)})
    docs = docs.unionByName(docs.filter("doc_id = 4"))
    assert rows(variants.spelling_variants(docs)) == brute(brute_words([(r.doc_id, r.text) for r in docs.collect()]))
    assert variants.spelling_variants(empty_documents(spark)).count() == 0
