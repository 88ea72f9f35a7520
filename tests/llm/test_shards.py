import zlib

from pyspark.sql import functions as F

from sparkmart.llm import shards
from tests_llm_helpers import corpus, docs, no_docs  # noqa: F401


def test_columns_and_slots(docs, corpus, monkeypatch):
    monkeypatch.setattr(shards, "BLOCK_ROWS", 5)
    rows = shards.assign(docs).collect()
    assert len(rows) == len(corpus)
    want = sorted((str(r[0]), len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in corpus)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in rows) == want
    slots = {}
    for r in rows:
        assert r.law == "key" and 0 <= r.shard < 16
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, set()).add((r.shard, r.grown_shard))
    assert all(len(x) == 1 for x in by_id.values())


def test_one_more_shard_takes_rows_only_into_itself(spark):
    ids = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    for n in (16, 17, 20):
        rows = shards.assign(ids, n).groupBy("shard", "grown_shard").count().collect()
        assert all(r.grown_shard in (r.shard, n) for r in rows)
        moved = sum(r["count"] for r in rows if r.grown_shard != r.shard)
        assert abs(moved - 20_000 / (n + 1)) < 200
        sizes = [sum(r["count"] for r in rows if r.shard == s) for s in range(n)]
        assert min(sizes) > 0.8 * 20_000 / n and max(sizes) < 1.2 * 20_000 / n


def test_weights_move_rows_only_between_changed_subtrees(spark):
    ids = spark.range(20_000).select(F.col("id").cast("string").alias("k"))
    before, after = shards.tree(16), shards.tree(16, weights={0: 3.0})
    rows = shards.place(shards.place(ids, F.col("k"), before, "a"), F.col("k"), after, "b").groupBy("a", "b").count().collect()
    region, rack = ({s: x[i] for x in before for s in [x[2]]} for i in (0, 1))
    for r in rows:
        if region[r.a] != region[r.b]:
            assert region[r.b] == region[0]
        elif rack[r.a] != rack[r.b]:
            assert rack[r.b] == rack[0]
        elif r.a != r.b:
            assert r.b == 0
    share = sum(r["count"] for r in rows if r.b == 0) / 20_000
    assert abs(share - 3 / 18) < 0.015


def test_empty(no_docs):
    assert shards.assign(no_docs).collect() == []
