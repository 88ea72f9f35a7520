"""Sharding by a hierarchical weighted hash tree.

A row descends region, rack and shard. At each level every child draws ``-ln(u) / weight`` with a
``u`` in (0, 1) hashed from the key and the child's path, and the smallest draw wins, so a child is
chosen in proportion to its weight and a change of weights moves rows only into or out of the
subtrees whose weights change. The first ``base`` shards form the tree given as a parameter; every
later shard opens a region of its own. Adding one therefore changes no draw of the others, and the
new shard takes rows only into itself, at any shard count.

DataFrame functions only. Slots count a shard's rows from 0 without gaps: rows fall into hash blocks
of bounded size, blocks are counted, and ranks within a block start at the rows before it.

NULL texts have no bytes and the checksum of an empty text. A NULL doc_id is a key like any other.
Repeated rows get slots of their own. Empty tables give no rows; further columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Tree = list[tuple[str, str, int, float]]  # region, rack, shard, weight
BLOCK_ROWS = 50_000
_SPAN = 16**12


def tree(shards: int, base: int = 16, racks: int = 2, per_rack: int = 4, weights: dict[int, float] | None = None) -> Tree:
    """Region, rack and weight of each shard. Shards from ``base`` on have a region of their own."""
    out = []
    for s in range(shards):
        weight = (weights or {}).get(s, 1.0)
        if s < base:
            rack = s // per_rack
            out.append((f"r{rack // racks}", f"k{rack}", s, weight))
        else:
            out.append((f"x{s}", f"x{s}", s, weight))
    return out


def _uniform(key: Column, path: str) -> Column:
    """A number in (0, 1) from the first 12 hexadecimal digits of an MD5 sum."""
    digits = F.substring(F.md5(F.concat_ws("|", key, F.lit(path))), 1, 12)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(_SPAN)


def _choose(key: Column, level: str, children: dict[str, float]) -> Column:
    """Name of the child with the smallest draw; ties go to the smaller name."""
    draws = [
        F.struct((-F.log(_uniform(key, f"{level}/{name}")) / w).alias("draw"), F.lit(name).alias("name"))
        for name, w in sorted(children.items())
        if w > 0
    ]
    return (F.least(*draws) if len(draws) > 1 else draws[0])["name"]


def place(df: DataFrame, key: Column, layout: Tree, to: str) -> DataFrame:
    """Add the shard of ``key`` as column ``to``."""
    regions: dict[str, float] = defaultdict(float)
    racks: dict[str, dict[str, float]] = defaultdict(lambda: defaultdict(float))
    shards: dict[str, dict[str, float]] = defaultdict(dict)
    for region, rack, shard, weight in layout:
        regions[region] += weight
        racks[region][rack] += weight
        shards[rack][f"{shard:06d}"] = weight

    def descend(at: Column, level: str, below: dict[str, dict[str, float]]) -> Column:
        out = F.lit(None).cast("string")
        for parent, children in below.items():
            if any(w > 0 for w in children.values()):
                out = F.when(at == parent, _choose(key, f"{level}/{parent}", children)).otherwise(out)
        return out

    df = df.withColumn("_region", _choose(key, "region", regions))
    df = df.withColumn("_rack", descend(F.col("_region"), "rack", racks))
    df = df.withColumn(to, descend(F.col("_rack"), "shard", shards).cast("int"))
    return df.drop("_region", "_rack")


def assign(docs: DataFrame, shards: int = 16, base: int = 16) -> DataFrame:
    """Shard of each row of ``docs`` (doc_id, text), its slot there, and its shard with one more."""
    raw = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    blocks = max(1, -(-docs.count() // BLOCK_ROWS))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        key.alias("_key"),
        (F.conv(F.substring(F.md5(F.concat_ws("|", key, F.lit("slot"))), 1, 12), 16, 10).cast("long") % blocks).alias("_block"),
    )
    rows = place(rows, F.col("_key"), tree(shards, base), "shard")
    rows = place(rows, F.col("_key"), tree(shards + 1, base), "grown_shard")
    before = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("shard", "_block").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.select("shard", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    rank = Window.partitionBy("shard", "_block").orderBy("doc_id", "text_crc32", "size")
    ranked = rows.withColumn("_rank", F.row_number().over(rank) - 1)
    return ranked.join(counts, ["shard", "_block"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("_before") + F.col("_rank")).cast("long").alias("slot"), "grown_shard",
    )


def op3_hash_tree_shards(spark, sf_dir: str) -> DataFrame:
    """All documents in 16 shards, and where they would be in 17."""
    return assign(spark.read.parquet(f"{sf_dir}/documents.parquet"), shards=16)


def _sql() -> str:
    """The same in DuckDB; a checksum is one step of a table for each byte."""

    def crc_table() -> list[int]:
        out = []
        for n in range(256):
            for _ in range(8):
                n = n >> 1 ^ (0xEDB88320 if n & 1 else 0)
            out.append(n)
        return out

    def digits(path: str) -> str:
        return f"('0x' || substr(md5(k || '|{path}'), 1, 12))::BIGINT"

    def chosen(level: str, children: dict[str, float]) -> str:
        draws = [
            f"{{'d': -ln(({digits(f'{level}/{name}')} + 0.5::DOUBLE) / {_SPAN}::DOUBLE) / {w}::DOUBLE, 'n': '{name}'}}"
            for name, w in children.items()
        ]
        return f"list_min([{', '.join(draws)}]).n"

    def placed(layout: Tree, source: str, to: str) -> str:
        regions = {r: sum(w for q, _, _, w in layout if q == r) for r, _, _, _ in layout}
        racks = {r: {k: sum(w for _, q, _, w in layout if q == k) for p, k, _, _ in layout if p == r} for r in regions}
        shards = {k: {f"{s:06d}": w for _, q, s, w in layout if q == k} for _, k, _, _ in layout}
        case = lambda at, level, below: f"CASE {at} " + " ".join(
            f"WHEN '{p}' THEN {chosen(f'{level}/{p}', c)}" for p, c in below.items()
        ) + " END"
        return (
            f"SELECT * EXCLUDE (region, rack), CAST({case('rack', 'shard', shards)} AS INTEGER) AS {to} FROM ("
            f"SELECT *, {case('region', 'rack', racks)} AS rack FROM ("
            f"SELECT *, {chosen('region', regions)} AS region FROM {source}))"
        )

    return f"""
WITH t AS (SELECT {crc_table()}::BIGINT[] AS t),
d AS (
  SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), 'null') AS k, coalesce(text, '') AS x,
    hex(encode(coalesce(text, ''))) AS h, greatest(1, CAST(ceil(count(*) OVER () / {BLOCK_ROWS}) AS BIGINT)) AS blocks
  FROM documents
), c AS (
  SELECT doc_id, k, octet_length(encode(x)) + 1 AS size, {digits('slot')} % blocks AS block,
    xor(4294967295, list_reduce(
      list_transform(range(0, octet_length(encode(x))), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT),
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295)) AS text_crc32
  FROM d, t
), p AS ({placed(tree(16), 'c', 'shard')}), g AS ({placed(tree(17), 'p', 'grown_shard')})
SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY block, doc_id, text_crc32, size) - 1 AS slot, grown_shard
FROM g
"""


OP3_SQL = _sql()
