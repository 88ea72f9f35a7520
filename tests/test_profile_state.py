"""Summaries of loads against the profile of all rows."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sparkmart.operators import profile, profile_state

DDL = "k string, n int, x double, big double, empty double"


def rows(seed, n=4000, shift=0.0):
    draw = random.Random(seed)
    value = lambda: None if draw.random() < 0.1 else draw.choice([draw.gauss(shift, 3), 7.0, float("nan")] if draw.random() < 0.2 else [draw.gauss(shift, 3)])
    return [(f"v{min(draw.randrange(40), draw.randrange(40))}", None if draw.random() < 0.3 else draw.randrange(3000), value(), 1e9 + draw.random(), None) for _ in range(n)]


@pytest.fixture
def loads(spark, tmp_path):
    parts = {"1": rows(1), "2": rows(2, 1000), "3": []}
    for name, part in parts.items():
        profile_state.save(spark.createDataFrame(part, DDL).repartition(3), f"file://{tmp_path}", name)
    return parts, f"file://{tmp_path}"


def test_merged_profile_equals_the_direct_one(spark, loads):
    parts, folder = loads
    every = sum(parts.values(), [])
    df = spark.createDataFrame(every, DDL)
    got = {r.column: r for r in profile_state.profile(profile_state.saved(spark, folder)).collect()}
    assert {(r.column, r.nulls, r.pct) for r in profile.nulls(df).collect()} == {(c, r.nulls, r.null_pct) for c, r in got.items()}
    known = df.select("k", "n", F.nanvl("x", F.lit(None)).alias("x"), "big", "empty")
    for r in profile.numeric(known).collect():
        mine = got[r.column]
        assert (mine.min, mine.max, mine.avg, mine.stddev) == (r.min, r.max, r.avg, r.stddev)
    assert got["empty"].avg is None and got["empty"].quantiles is None and got["k"].quantiles is None
    numbers = sorted(r[1] for r in every if r[1] is not None)
    for p, q in zip((0.25, 0.5, 0.75), got["n"].quantiles):
        rank = sum(x <= q for x in numbers) / len(numbers)
        assert abs(rank - p) < 0.0165 + 1 / len(numbers) + 0.003
    assert abs(got["n"].distinct / len(set(numbers)) - 1) < 4 * 0.0163
    counts = Counter(r[0] for r in every)
    listed = {x["value"]: x["count"] for x in got["k"].frequent}
    assert {v for v, c in counts.items() if c > len(every) / 64} <= set(listed)
    assert all(counts[v] - len(every) / 64 <= c <= counts[v] for v, c in listed.items())


def test_a_load_that_comes_again_replaces_its_summary(spark, loads):
    _, folder = loads
    profile_state.save(spark.createDataFrame([("only", 1, 2.0, 3.0, None)], DDL), folder, "1")
    one = profile_state.profile(profile_state.saved(spark, folder, ["1"])).where("column = 'x'").first()
    assert (one.rows, one.min, one.avg, one.stddev) == (1, 2.0, 2.0, None)


def test_drift_from_summaries(spark, tmp_path):
    folder = f"file://{tmp_path}"
    for name, part in (("a", rows(5)), ("same", rows(6)), ("moved", [(k, n, x, b, 1.0) for k, n, x, b, _ in rows(7, shift=9.0)])):
        profile_state.save(spark.createDataFrame(part, DDL), folder, name)
    of = lambda name: profile_state.saved(spark, folder, [name])
    same = {r.column: r for r in profile_state.drift(of("a"), of("same")).collect()}
    moved = {r.column: r for r in profile_state.drift(of("a"), of("moved")).collect()}
    assert abs(same["x"].mean_shift) < 0.15 and same["x"].rank_distance < 0.1 and same["k"].frequent_change < 0.1
    assert moved["x"].mean_shift > 2 and moved["x"].rank_distance > 0.5
    assert moved["empty"].null_share_change == -1.0 and same["empty"].null_share_change == 0.0 and same["empty"].rank_distance is None


def counted(spark, data, ddl):
    """The rows as a frame, and how often one of them has been read."""
    seen = spark.sparkContext.accumulator(0)

    def see(row):
        seen.add(1)
        return row

    return spark.createDataFrame(spark.sparkContext.parallelize(data, 3).map(see), ddl), seen


def test_a_load_is_read_twice(spark, tmp_path):
    data = rows(8, 500)
    df, seen = counted(spark, data, DDL)
    profile_state.save(df, f"file://{tmp_path}", "1")
    assert seen.value == 2 * len(data)
    listed = {r["column"]: {x["value"]: x["count"] for x in r.frequent} for r in profile_state.saved(spark, f"file://{tmp_path}").collect()}
    for k, c in enumerate(("k", "n")):
        counts = Counter(str(r[k]) for r in data if r[k] is not None)
        assert listed[c] == {v: n for v, n in counts.items() if n * profile_state.FREQUENT > len(data)}


def test_several_loads_are_read_twice_together(spark, tmp_path):
    folder = f"file://{tmp_path}"
    # Far more values than the sketch of frequent ones tracks, one of them just frequent and one just not.
    long = [("a", f"x{i}") for i in range(40_000)] + [("a", "often")] * 660 + [("a", "seldom")] * 600 + [("b", "b"), ("b", None), ("c", "c"), (None, "d")]
    random.Random(9).shuffle(long)
    df, seen = counted(spark, long, "load string, v string")
    profile_state.save_loads(df, f"{folder}/one", "load", ["a", "b", "none"])
    assert seen.value == 2 * len(long)
    for name in ("a", "b", "none"):
        profile_state.save(df.where(F.col("load") == name).drop("load"), f"{folder}/each", name)
    plain = ["load", "column", "rows", "nulls", "values", "least", "mean", "squares", "frequent", F.hll_sketch_estimate("distinct").alias("n")]
    one, each = (profile_state.saved(spark, f"{folder}/{x}").select(*plain).orderBy("load").collect() for x in ("one", "each"))
    assert one == each and [(r.load, r.rows, r.nulls) for r in one] == [("a", 41_260, 0), ("b", 2, 1), ("none", 0, 0)]
    assert [[tuple(x) for x in r.frequent] for r in one] == [[("often", 660)], [("b", 1)], []]


def test_frequent_values_that_are_no_utf8(spark, tmp_path):
    df = spark.createDataFrame([(bytes([254 + i % 3 % 2]),) for i in range(300)] + [(None,)], "b binary")
    profile_state.save(df, f"file://{tmp_path}", "1")
    rows = profile_state.saved(spark, f"file://{tmp_path}").select(F.inline("frequent")).select(F.hex("value"), "count").collect()
    assert sorted(map(tuple, rows)) == [("FE", 200), ("FF", 100)]
