import random

import numpy as np

from tallycast.llm import toxicity
from tests.llm.helpers import documents, empty_documents, odd_documents, remainder

FOLDER = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{name}.parquet") for name in ("documents", "labels"))
    rows = toxicity.classify(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (remainder(r.doc_id, 5) == 0) for r in rows)
    toxic = [r for r in held if r.toxic]
    clean = [r for r in held if not r.toxic]
    assert np.mean([r.predicted for r in toxic]) > 0.85
    assert np.mean([r.predicted for r in clean]) < 0.02
    assert all(r.predicted == (r.score >= 0.5) for r in rows)


def made(spark, n=400):
    rng = random.Random(4)
    syllables = ["ba", "do", "ri", "mu", "te", "lo"]
    texts, labels = [], []
    for i in range(n):
        found = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(rng.randint(1, 60))]
        toxic = int(i % 5 == 0)
        if toxic:
            found.insert(rng.randint(0, len(found)), "grobz" + rng.choice(syllables) + rng.choice(syllables))
        texts.append(" ".join(found))
        labels.append((i, 1, toxic))
    return documents(spark, texts), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_rare_forms_are_judged_by_their_beginning(spark):
    docs, labels = made(spark)
    model = toxicity.fit(docs, labels)
    more = documents(spark, ["ba do grobzunseen ri mu", "badori temu lo", "", None])
    scores = [r.score for r in toxicity.score(more, model).orderBy("doc_id").collect()]
    assert scores[0] >= 0.5 and max(scores[1:]) < 0.5


def test_labels_of_the_held_out_fold_are_not_read(spark):
    docs, labels = made(spark)
    changed = labels.withColumn("toxic", (1 - labels.toxic) * (toxicity.fold() == 0).cast("int") + labels.toxic * (toxicity.fold() != 0).cast("int"))
    a, b = (sorted((r.doc_id, r.score) for r in toxicity.classify(docs, x).collect()) for x in (labels, changed))
    assert a == b


def test_odd_rows_and_labels(spark):
    docs, labels = made(spark, 200)
    bad = spark.createDataFrame([(None, 1, 1), (5, 1, None), (10**9, 0, 1), (7, 1, 0), (7, 1, 0)], labels.schema)
    odd = odd_documents(spark)
    rows = toxicity.classify(odd.unionByName(docs, allowMissingColumns=True).drop("score"), labels.union(bad)).collect()
    assert len(rows) == odd.count() + 200 and all(0 <= r.score <= 1 for r in rows)
    nothing = labels.limit(0)
    assert {r.score for r in toxicity.classify(odd, nothing).collect()} <= {r.score for r in rows} | {toxicity_floor()}
    assert toxicity.classify(empty_documents(spark), labels).count() == 0
    # Labelled ids of one class have no documents.
    away = labels.withColumn("doc_id", labels.doc_id + labels.toxic * 10**9)
    assert {r.predicted for r in toxicity.classify(docs, away).collect()} == {0}
    one_class = labels.filter("toxic = 0")
    assert {r.predicted for r in toxicity.classify(docs, one_class).collect()} == {0}


def toxicity_floor():
    return 1 / (1 + np.exp(30.0))
