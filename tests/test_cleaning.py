from datetime import datetime

from tallycast.operators import cleaning, slots

RAW = [
    ("Voter_id", "Candidate_id", "Vote_Time"),
    ("v1", "a", "2024-13-01 00:00:00"),
    ("v2", "a", "2024-01-01 8:00:00"),
    ("v3", "a", None),
    ("v4", "a", "2024-01-01 08:00:00"),
    ("v4", "a", "2024-01-01 08:00:00"),
]


def test_only_parsed_times_stay_and_duplicates_count(spark):
    raw = spark.createDataFrame(RAW, "entity string, key string, event_time string")
    assert [r.ts for r in cleaning.clean_events(raw).collect()] == [datetime(2024, 1, 1, 8)] * 2
    assert cleaning.rejected_events(raw).count() == 4


def test_parsing_ignores_the_session_zone(spark):
    raw = spark.createDataFrame([("v", "a", "2024-03-31 02:30:00")], "entity string, key string, event_time string")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")  # 02:30 does not exist there that day
    try:
        clean = cleaning.clean_events(raw)
        assert clean.collect()[0].ts == datetime(2024, 3, 31, 2, 30)
        assert [(r.hour, r.minute) for r in slots.slot_counts(clean).collect()] == [(2, 30)]
        assert slots.cumulative_slots(clean, slot="minute").collect()[0].ts == datetime(2024, 3, 31, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_unknown_keys_are_rejected_and_the_rest_unaffected(spark, make_events):
    events = make_events([("a", "2024-01-01 08:00:00"), ("x", "2024-01-01 08:00:01"), (None, "2024-01-01 08:00:02")])
    keys = spark.sql("SELECT * FROM VALUES ('a', 1), ('b', 2) AS t(key, rank)")
    assert [(r.key, r.rank) for r in cleaning.known_events(events, keys).collect()] == [("a", 1)]
    assert {r.key for r in cleaning.unknown_events(events, keys).collect()} == {"x", None}


def test_json_defaults(spark):
    df = spark.createDataFrame([('{"k": 3}',), ("{}",), ("broken",), (None,)], "props string")
    out = cleaning.json_field(df, "props", "k int, s string", {"k": -1, "s": "Unknown"}).collect()
    assert [(r.k, r.s) for r in out] == [(3, "Unknown"), (-1, "Unknown"), (-1, "Unknown"), (-1, "Unknown")]


def test_two_days_fold_into_one_slot_or_stay_two_minutes(make_events):
    events = make_events([("a", "2024-01-01 08:00:05"), ("a", "2024-01-02 08:00:10")])
    folded = slots.cumulative_slots(events).collect()
    assert [(r.hour, r.minute, r.votes, r.cumulative_votes) for r in folded] == [(8, 0, 2, 2)]
    minutes = slots.cumulative_slots(events, slot="minute").orderBy("ts").collect()
    assert [(r.ts, r.votes, r.cumulative_votes) for r in minutes] == [
        (datetime(2024, 1, 1, 8), 1, 1), (datetime(2024, 1, 2, 8), 1, 2)
    ]
