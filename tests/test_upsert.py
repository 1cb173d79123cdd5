"""Keyed tables merged with changes: equal to a full recomputation, without moving the stored side."""

import random

from panelkit.operators.upsert import upsert, upserted, write_keyed
from panelkit.operators.windows import keep_last

SCHEMA = "k int, g string, at int, v double"


def rows(seed, n, low=0):
    rng = random.Random(seed)
    return [(rng.randrange(low, low + 40), rng.choice("ab"), rng.choice([None, *range(50)]), rng.random()) for _ in range(n)]


def expected(*sheets):
    best = {}
    for sheet in sheets:
        for k, g, at, v in sheet:
            now = best.get((k, g))
            if now is None or (at is not None, at or 0) >= (now[0] is not None, now[0] or 0):
                best[k, g] = (at, v)
    return sorted((k, g, at) for (k, g), (at, _) in best.items())


def test_sheets_in_turn_equal_all_at_once(spark):
    sheets = [rows(1, 60), rows(2, 30, 20), rows(3, 30)]
    frames = [spark.createDataFrame(s, SCHEMA) for s in sheets]
    name = write_keyed(keep_last(frames[0], ["k", "g"], ["at", "v"]), ["k", "g"], buckets=4)
    for f in frames[1:]:
        name = upsert(spark, name, f, ["k", "g"], ["at", "v"], buckets=4)
    got = spark.table(name)
    assert sorted((r.k, r.g, r.at) for r in got.collect()) == expected(*sheets)
    full = keep_last(frames[0].union(frames[1]).union(frames[2]).na.fill(-1, ["at"]), ["k", "g"], ["at", "v"])
    assert sorted(tuple(r) for r in got.na.fill(-1, ["at"]).collect()) == sorted(tuple(r) for r in full.collect())


def test_unknown_keys_stay_out_and_empty_changes_change_nothing(spark):
    old = spark.createDataFrame([(1, "a", 1, 1.0), (None, "a", 1, 2.0)], SCHEMA)
    name = write_keyed(old, ["k", "g"], buckets=4)
    same = upserted(spark.table(name), old.limit(0), ["k", "g"], ["at"], 4)
    assert [tuple(r) for r in same.collect()] == [(1, "a", 1, 1.0)]
    tie = spark.createDataFrame([(1, "a", 1, 7.0), (None, "b", 2, 3.0), (2, "a", None, 4.0)], SCHEMA)
    assert sorted(tuple(r) for r in upserted(spark.table(name), tie, ["k", "g"], ["at"], 4).collect()) == [(1, "a", 1, 7.0), (2, "a", None, 4.0)]


def test_the_stored_side_is_not_shuffled(spark):
    old = spark.createDataFrame(rows(5, 200), SCHEMA)
    name = write_keyed(keep_last(old, ["k", "g"], ["at", "v"]), ["k", "g"], buckets=4)
    plan = upserted(spark.table(name), old.limit(20), ["k", "g"], ["at", "v"], 4)._jdf.queryExecution().executedPlan().toString()
    join = plan.index("SortMergeJoin")
    left = plan[join:plan.index(name)]  # from the join down to the scan of the stored table
    assert "Exchange" not in left, plan
    assert "Exchange" in plan[plan.index(name):]
