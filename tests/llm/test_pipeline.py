import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tallycast.llm import stages, toxicity
from tests.llm.helpers import documents, empty_documents
from tests.llm.test_near import classes
from tests.llm.test_repeats import brute as brute_repeats


@pytest.fixture
def folder(spark, tmp_path):
    """A small corpus with toxic documents, exact and near copies, and passages that repeat."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choices(["ba", "do", "ri", "mu", "te", "lo", "sha"], k=rng.randint(1, 3)))
    passage = [word() for _ in range(40)]
    texts, toxic = [], []
    for i in range(260):
        found = [word() for _ in range(rng.randint(5, 90))]
        toxic.append(int(i % 6 == 0))
        if toxic[-1]:
            found.insert(rng.randint(0, len(found)), "grobz" + rng.choice(["ba", "do", "ri"]))
        elif i % 5 == 1:
            found = found[:20] + passage + found[20:]
        texts.append(" ".join(found))
    for i in range(20):
        source = texts[3 + 6 * i].split()
        if i % 2 and len(source) > 40:
            source[len(source) // 2] = "changed"
        texts.append(" ".join(source))
        toxic.append(0)
    texts += ["", None, "ba"]
    docs = documents(spark, texts)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, t) for i, t in enumerate(toxic) if i % 7]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path), texts, toxic


def test_rows_follow_the_brute_force(spark, folder):
    path, texts, toxic = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = {r.doc_id: r.text for r in stages.drop_toxic(spark, docs, path).collect()}
    assert [i for i in range(len(toxic)) if (i not in kept) != bool(toxic[i])] == []  # the stage learns labels only

    ids = sorted(kept)
    group = classes([kept[i] or "" for i in ids])
    firsts = [i for at, i in enumerate(ids) if group[at] == at]
    left = {}
    rows = [(i, kept[i]) for i in firsts]
    for key, raw in cut_by_brute_force(rows).items():
        left[key] = raw.decode("utf-8", "ignore")

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for key, text in left.items():
        tokens = [*library.encode(text, add_special_tokens=False).ids, 1]
        for start in range(0, len(tokens), 4096):
            part = tokens[start : start + 4096]
            want.append((key, start // 4096, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    made = corpus_pipeline.run(spark, path).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in made) == sorted(want)
    assert len({r.sequence_id for r in made}) <= -(-sum(w[3] for w in want) // 4096) + 1


def cut_by_brute_force(rows, length=100):
    seen, out = set(), {}
    for key, text in sorted(rows):
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for s in range(len(raw) - length + 1):
            if raw[s : s + length] in seen:
                gone[s : s + length] = True
            seen.add(raw[s : s + length])
        out[key] = bytes(x for x, g in zip(raw, gone, strict=True) if not g)
    assert len(brute_repeats(rows)) == len(out)
    return out


def test_stages_keep_the_columns(spark, folder):
    path, _, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, path).schema.names == docs.schema.names
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "suffix_dedup", "packing"]


def test_odd_rows(spark, folder):
    path, _, _ = folder
    extra = "doc_id bigint, text string, lang string, source string, n_chars bigint, node int, kept string, _id int"
    rows = [(1, None), (1, None), (None, "x y"), (None, "x y"), (2, ""), (3, "a " * 9000), (3, "other"), (4, "grobzba")]
    docs = spark.createDataFrame([(*r, None, None, None, 1, "k", 2) for r in rows], extra)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, path)
    assert {r.doc_id for r in docs.collect()} == {1, None, 3, 4}  # too few labelled rows to know the word
    docs = empty_documents(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, path)
    assert docs.count() == 0


def test_equal_rows_stay_once(spark, folder):
    path, _, _ = folder
    rows = [(5, "a b c d e f g"), (5, "a b c d e f g"), (5, "quite another text of seven words"), (6, "a b c d e f g")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((r.doc_id, r.text) for r in stages.drop_near_copies(spark, docs, path).collect())
    assert got == [(5, "a b c d e f g"), (5, "quite another text of seven words")]
    assert toxicity.FOLDS == 5
