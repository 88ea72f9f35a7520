"""Loads merged one after the other against cleaning the whole history, and quarantined lines."""

import random

import pytest
from pyspark.sql import functions as F

from sparkmart import schemas
from sparkmart.plans import build, incremental, silver
from sparkmart.sources import io
from sparkmart.sources.buckets import BucketStore

DATES = ["2024-01-01", "2024-01-02", "2024-01-03"]


def history(name, seed=3):
    """Rows of three loads with repeated keys, ties, NULL keys, NULL and odd values."""
    draw = random.Random(seed)
    fields = schemas.raw(name).fields
    rows = []
    for date in DATES:
        for k in range(60):
            row = []
            for f in fields:
                kind = f.dataType.simpleString()
                if f.name == silver.RECIPES[name].key:
                    value = draw.choice([None, *(f"k{i}" for i in range(40))])
                elif draw.random() < 0.15:
                    value = None
                elif kind == "double":
                    value = float(draw.choice([1, 2, 3.25, 4.5, 900.125]))
                elif kind == "int":
                    value = draw.randint(0, 9)
                elif kind == "boolean":
                    value = draw.random() < 0.3
                elif "date" in f.name or f.name == "timestamp":
                    value = draw.choice(["2024-01-05", "01/06/2024", "2024/01/07", "n/a", "2024-01-08 10:00:00"])
                else:
                    value = draw.choice(["Direct", "EMAIL", "west", "approved", "x"])
                row.append(value)
            rows.append((*row, date))
    return rows


def frame(spark, name, rows):
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.raw(name).fields) + ", load_date string"
    return spark.createDataFrame(rows, ddl)


def same(left, right):
    assert left.columns == right.columns
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, left.collect()), key=key) == sorted(map(tuple, right.collect()), key=key)


@pytest.mark.parametrize("name", ["customers", "loan_applications", "product_inventory", "events_raw"])
def test_three_loads_equal_a_full_rebuild(spark, tmp_path, name):
    raw = frame(spark, name, history(name))
    state = incremental.store(spark, f"file://{tmp_path}", name, raw, buckets=4)
    of_date = lambda date: raw.where(F.col("load_date") == date)
    for date in DATES:
        incremental.merge(state, of_date(date), name, date)
    for date in DATES:  # every version can still be read
        same(incremental.cleaned(state, name, date), silver.entity(name, raw.where(F.col("load_date") <= date), date))


def test_late_and_repeated_loads(spark, tmp_path):
    name = "transactions"
    rows = history(name)
    raw = frame(spark, name, rows)
    state = incremental.store(spark, f"file://{tmp_path}", name, raw, buckets=4)
    of_date = lambda date: raw.where(F.col("load_date") == date)
    for date in (DATES[0], DATES[2]):
        incremental.advance(state, of_date, name, date)
    assert incremental.advance(state, of_date, name, DATES[1]) == DATES[1:]
    same(incremental.cleaned(state, name, DATES[2]), silver.entity(name, raw, DATES[2]))
    fewer = frame(spark, name, [r for i, r in enumerate(rows) if r[-1] != DATES[1] or i % 2])  # the load comes again, shorter
    incremental.advance(state, lambda date: fewer.where(F.col("load_date") == date), name, DATES[1])
    same(incremental.cleaned(state, name, DATES[2]), silver.entity(name, fewer, DATES[2]))


def test_only_touched_buckets_are_read_and_written(spark, tmp_path):
    name = "transactions"
    keys = [(f"k{i}", "c", 1.0 * i, "p", "s", "2024-01-05", "m") for i in range(300)]
    raw = frame(spark, name, [(*k, DATES[0]) for k in keys] + [(*keys[7], DATES[1])])
    state = incremental.store(spark, f"file://{tmp_path}", name, raw, buckets=16)
    of_date = lambda date: raw.where(F.col("load_date") == date)
    first = incremental.merge(state, of_date(DATES[0]), name, DATES[0])
    second = incremental.merge(state, of_date(DATES[1]), name, DATES[1])
    changed = [b for b in second if second[b] != first[b]]
    assert len(first) == 16 and len(changed) == 1 and second[changed[0]].version == DATES[1]
    files = state.read({b: first[b] for b in changed}).inputFiles()
    assert files and all(f"_bucket={changed[0]}/" in f for f in files)
    written = spark.read.parquet(f"file://{tmp_path}/{name}/data/version={DATES[1]}")
    assert {r[0] for r in written.select("_bucket").distinct().collect()} == set(changed)
    out = incremental.cleaned(state, name, DATES[1])
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString() and out.count() == 300


def test_a_version_that_was_not_committed_changes_nothing(spark, tmp_path):
    schema = spark.createDataFrame([], "k long, v string").schema
    store = BucketStore(spark, f"file://{tmp_path}", schema, ["k"], 4)
    assert store.versions() == [] and store.entries() == {} and store.read({}).count() == 0
    rows, touched = store.incoming(spark.createDataFrame([(k, "a") for k in range(20)], schema), "1")
    store.commit("1", rows, touched, {})
    rows, touched = store.incoming(spark.createDataFrame([(3, "b")], schema), "2")  # lost before its manifest
    rows.drop("_bucket").write.parquet(f"file://{tmp_path}/data/version=2/_bucket={touched[0]}")
    assert store.versions() == ["1"] and store.read(store.entries()).where("v = 'b'").count() == 0
    store.commit("2", rows, touched, {})
    assert store.versions() == ["1", "2"] and store.read(store.entries()).where("v = 'b'").count() == 1
    empty, none = store.incoming(spark.createDataFrame([], schema), "3")
    assert none == [] and store.commit("3", empty, none, store.entries(before="3")).keys() == store.entries(upto="2").keys()


def test_good_rows_and_rejects_add_up_to_the_lines(spark, tmp_path):
    head = ",".join(schemas.raw("transactions").names)
    good = [f'T{i},C1,{i}.5,card,completed,2024-01-10 10:00:00,"food, drink"' for i in range(5)]
    bad = ["T8,C1,oops,card,completed,2024-01-10 10:00:00,x", "T9,C1,1.0,card", "T10,C1,1.0,card,completed,2024-01-10 10:00:00,x,more"]
    (tmp_path / "t.csv").write_text("\n".join([head, *good, *bad]) + "\n")
    folder = f"{tmp_path}/bronze"
    counts = build.bronze(spark, {"transactions": f"{tmp_path}/t.csv"}, folder, "2024-01-31")
    assert counts == {"transactions": len(good) + len(bad)}
    left = {r.line: (r.reason, r.source_file, r.load_date) for r in build.rejects(spark, folder, "transactions").collect()}
    assert set(left) == set(bad) and {v[1:] for v in left.values()} == {("t.csv", "2024-01-31")}
    assert left[bad[0]][0] == "amount is not double" and left[bad[1]][0] == left[bad[2]][0] == "wrong number of fields"
    spark.sql("CREATE DATABASE IF NOT EXISTS quarantined")
    kept = build.silver_tables(spark, folder, "2024-01-31", "quarantined", ["transactions"], quarantine=True)
    assert kept == {"transactions": len(good)}
    (tmp_path / "t.csv").write_text("\n".join([head, *good]) + "\n")  # the load comes again, mended
    raw = io.with_rejects(io.stamp_load(io.read_raw(spark, f"{tmp_path}/t.csv", schemas.raw("transactions")), "2024-01-31"), schemas.raw("transactions"))
    assert io.write_split(raw, f"{folder}/transactions", "2024-01-31") == (len(good), 0)
    assert build.rejects(spark, folder, "transactions").count() == 0
