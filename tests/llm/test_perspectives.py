import random

import pytest

from tallycast.llm import perspectives, queries
from tallycast.operators import prefix
from tests import oracle


def brute(rows):
    talks = {}
    for conv, turn, role, text in rows:
        if conv is not None and turn is not None:
            talks.setdefault(conv, []).append((turn, role or "unknown", text or ""))
    out = []
    for conv, turns in talks.items():
        for speaker in {role for _, role, _ in turns} - {"system"}:
            whole = ""
            for turn, role, text in sorted(turns, key=lambda t: (t[0], t[1].encode(), t[2].encode())):
                name = "assistant" if role == speaker else role if role == "system" else f"user name={role}"
                head = f"<|im_start|>{name}\n"
                segment = f"{head}{text}<|im_end|>\n"
                at = len(whole) + len(head)
                mask = (at, at + len(text) + len("<|im_end|>")) if role == speaker else (None, None)
                out.append((conv, speaker, turn, role, segment, len(whole), *mask))
                whole += segment
    return sorted(out, key=repr)


def result(df):
    names = ["conv_id", "speaker", "turn", "role", "segment", "start", "train_from", "train_to"]
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


@pytest.mark.parametrize("bits", [2, 20])
def test_renderings_follow_the_brute_force(spark, bits, monkeypatch):
    monkeypatch.setitem(prefix.prefix_sums.__kwdefaults__ or {}, "bits", bits)
    rng = random.Random(bits)
    roles = ["user", "assistant", "system", "Ann", "Bob é", None]
    rows = [
        (rng.choice([1, 2, 3, None]), rng.choice([*range(12), -3, 10**6, None]), rng.choice(roles), rng.choice(["", "hi", None, "漢字 \U0001f600", "x" * 300]))
        for _ in range(150)
    ]
    rows += [(9, 0, "system", "alone"), (10, 0, "user", "x"), (10, 0, "user", "x")]
    extra = [(*r, 1, "s") for r in rows]
    turns = spark.createDataFrame(extra, "conv_id bigint, turn int, role string, text string, salt int, speaker string")
    got = perspectives.perspectives(turns)
    assert result(got) == brute(rows)
    assert "Python" not in got._jdf.queryExecution().toString()
    assert perspectives.perspectives(turns.limit(0)).count() == 0


def test_masks_cover_the_speakers_words(spark):
    rows = [(1, 0, "Ann", "hello"), (1, 1, "Bob", "hi Ann"), (1, 2, "Ann", "bye")]
    made = perspectives.perspectives(spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")).collect()
    for speaker, said in (("Ann", ["hello", "bye"]), ("Bob", ["hi Ann"])):
        mine = sorted((r for r in made if r.speaker == speaker), key=lambda r: r.turn)
        whole = "".join(r.segment for r in mine)
        assert [whole[r.train_from : r.train_to] for r in mine if r.train_from is not None] == [x + "<|im_end|>" for x in said]


def test_query_equals_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    name = "op5_perspectives"
    assert oracle.compare(queries.QUERIES[name](spark, folder), oracle.connect(folder), queries.ORACLES[name]) is None
