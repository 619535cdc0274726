import re

from tallycast.llm import licenses
from tests.llm.helpers import documents, empty_documents, lowered, odd_documents

WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")


def brute(text):
    found = WORD.findall(lowered(text))
    places, labels = [], set()
    for phrase, label in licenses.PHRASES.items():
        parts = phrase.split()
        for i in range(len(found) - len(parts) + 1):
            if found[i : i + len(parts)] == parts:
                places.append(i)
                labels.add(label)
    return len(found), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


TEXTS = [
    "Released under the MIT License. Licensed under CC BY-NC 4.0.",
    "GNU General Public License gnu general public\nlicense; GNU general public thing license",
    "mit mit license license apache_license apacheé license",
    "the of the to in " * 50,
    "This work is licenced under the GNU General, and Public License, version 3. cc cc by by",
    "Permission is hereby granted, free of charge, to any kind person obtaining a copy of this software and associated "
    "documentation files (the software), to deal in the software without restriction",
    "MIT License " * 400,
]


def test_places_follow_the_brute_force(spark):
    docs = documents(spark, TEXTS).repartition(3)
    rows = {r.doc_id: r for r in licenses.scan(docs).collect()}
    for i, text in enumerate(TEXTS):
        r = rows[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(text)
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) | {""}
        assert 0 <= r.score <= 1
    assert rows[0].labels == "cc-by,cc-by-nc-4.0,mit,mit-notice" and rows[0].score == 1
    assert rows[3].labels == "" and rows[3].score < 0.3
    assert rows[5].labels == "mit-text" and rows[5].base_labels == ""


def test_given_documents_follow_the_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {r.doc_id: brute(r.text) for r in docs.collect()}
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in licenses.scan(docs).collect()}
    assert got == want


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = licenses.scan(docs).collect()
    assert len(rows) == docs.count()
    by = {r.doc_id: r for r in rows}
    assert (by[1].n_words, by[1].n_base, by[1].first_word, by[1].labels, by[1].score) == (0, 0, None, "", 0)
    assert by[6].n_words == brute("été 漢字 \U0001f600")[0]
    assert licenses.scan(empty_documents(spark)).count() == 0


def test_own_templates(spark):
    docs = documents(spark, ["free as in beer and more", "x"])
    rows = licenses.scan(docs, phrases={"as in": "as"}, notices={"free as in beer": "beer"}).orderBy("doc_id").collect()
    assert [r.labels for r in rows] == ["as,beer", ""]


def test_words_of_a_template_beside_its_notice_hide_nothing(spark):
    texts = ["released under the mit license" + " mit license" * n for n in range(12)] + ["mit license " * 9]
    rows = {r.doc_id: r for r in licenses.scan(documents(spark, texts)).collect()}
    assert all(rows[i].labels == "mit,mit-notice" and rows[i].n_base == i + 1 for i in range(12))
    assert rows[12].labels == "mit"
