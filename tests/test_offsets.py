import json

from quarry.streaming import offsets as O


def held(spark, rows):
    return spark.createDataFrame(rows, "topic string, partition int, earliest bigint, latest bigint")


def stored(spark, rows):
    return spark.createDataFrame(rows, "topic string, partition int, until bigint")


def got(df):
    return {(r.topic, r.partition): (r.start, r.until, r.skipped, r.why) for r in df.collect()}


def test_resume_clamp_and_reset(spark):
    h = held(spark, [("a", 0, 5, 20), ("a", 1, 5, 20), ("a", 2, 5, 20), ("b", 0, 3, 9), ("c", 0, 1, 4), ("c", 1, 2, 4)])
    s = stored(spark, [("a", 0, 12), ("a", 1, 2), ("a", 1, 1), ("a", 2, 50), ("c", 0, 3), ("gone", 0, 7), ("b", 0, None)])
    want = {("a", 0): (12, 20, 0, "resumed"), ("a", 1): (5, 20, 3, "clamped"), ("a", 2): (50, 20, 0, "resumed"),
            ("b", 0): (3, 9, 0, "reset"), ("c", 0): (1, 4, 0, "reset"), ("c", 1): (2, 4, 0, "reset")}
    assert got(O.start_offsets(s, h)) == want
    late = got(O.start_offsets(s, h, reset="largest"))
    assert late["b", 0] == (9, 9, 0, "reset") and late["c", 0][0] == 4 and late["a", 1] == want["a", 1]
    each = got(O.start_offsets(s, h, whole_topic=False))
    assert each["c", 0] == (3, 4, 0, "resumed") and each["c", 1] == (2, 4, 0, "reset")
    assert json.loads(O.starting_json(O.start_offsets(s, h))) == {
        "a": {"0": 12, "1": 5, "2": 50}, "b": {"0": 3}, "c": {"0": 1, "1": 2}}


def test_commits_are_idempotent_and_resumed_from(spark, tmp_path):
    path = f"file://{tmp_path}/offsets"
    assert O.stored_offsets(spark, path).collect() == []
    log = [("a", 0, 0, 10), ("a", 1, 0, 10)]
    for batch, end in enumerate((10, 25)):
        h = held(spark, [(t, p, e, end) for t, p, e, _ in log])
        starts = O.start_offsets(O.stored_offsets(spark, path), h)
        assert {r.start for r in starts.collect()} == ({0} if batch == 0 else {10})
        for _ in range(2):  # a replay writes the same again
            O.commit_offsets(starts, path, batch)
    assert got(O.start_offsets(O.stored_offsets(spark, path), held(spark, [("a", 0, 30, 40), ("a", 1, 0, 40)]))) == {
        ("a", 0): (30, 40, 5, "clamped"), ("a", 1): (25, 40, 0, "resumed")}


def test_empty(spark):
    assert O.start_offsets(stored(spark, []), held(spark, [])).collect() == []
    assert O.starting_json(O.start_offsets(stored(spark, []), held(spark, []))) == "{}"
