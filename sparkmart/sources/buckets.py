"""A keyed table in versions: every load rewrites only the buckets of keys that it touches.

Rows are dealt into a fixed number of buckets by a hash of their key. A version holds whole buckets::

    folder/data/version=V/_bucket=B/*.parquet     rows of bucket B after version V
    folder/manifests/version=V/*.parquet          for each bucket: the version that holds it, rows, statistics

The manifest names every live bucket, so a reader opens the live files only, and a writer of version V
reads just the buckets it changes as they were before V. It is written last: a run that is lost before
leaves the earlier version as it was and can be repeated, and so can a version that was committed.
Versions are texts in their order (ISO dates, padded numbers). There is one writer at a time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = "bucket int, data_version string, rows long, stats map<string,string>"


@dataclass(frozen=True)
class Entry:
    """One live bucket: the version that holds its rows, how many, and statistics as text."""

    version: str
    rows: int
    stats: Mapping[str, str]


class BucketStore:
    """``schema``: columns of the rows; ``keys``: those that choose a bucket."""

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType, keys: Sequence[str], buckets: int = 64):
        self.spark, self.folder, self.schema = spark, folder.rstrip("/"), schema
        self.keys, self.buckets = list(keys), buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def with_bucket(self, df: DataFrame) -> DataFrame:
        return df.withColumn("_bucket", self.bucket())

    def versions(self) -> list[str]:
        """Committed versions in order; their names come from the folder alone."""
        try:
            found = self.spark.read.schema(MANIFEST + ", version string").parquet(f"{self.folder}/manifests")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return sorted(r.version for r in found.select("version").distinct().collect())

    def entries(self, upto: str | None = None, before: str | None = None) -> dict[int, Entry]:
        """Live buckets after the last version up to ``upto`` or before ``before``: one row a bucket."""
        held = [v for v in self.versions() if (upto is None or v <= upto) and (before is None or v < before)]
        if not held:
            return {}
        rows = self.spark.read.schema(MANIFEST).parquet(f"{self.folder}/manifests/version={held[-1]}").collect()
        return {r.bucket: Entry(r.data_version, r.rows, r.stats or {}) for r in rows}

    def read(self, entries: Mapping[int, Entry]) -> DataFrame:
        """Rows of the given buckets, and of no other file."""
        paths = [f"{self.folder}/data/version={e.version}/_bucket={b}" for b, e in sorted(entries.items())]
        reader = self.spark.read.schema(self.schema)
        return reader.parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def incoming(self, df: DataFrame, version: str) -> tuple[DataFrame, list[int]]:
        """Write the rows that a version brings, dealt by bucket; they and the buckets they touch."""
        path = f"{self.folder}/incoming/version={version}"
        names = [f.name for f in self.schema]
        self.with_bucket(df.select(names)).repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(path)
        schema = T.StructType([*self.schema, T.StructField("_bucket", T.IntegerType())])
        rows = self.spark.read.schema(schema).parquet(path)
        return rows, sorted(r[0] for r in rows.select("_bucket").distinct().collect())

    def commit(
        self,
        version: str,
        df: DataFrame,
        touched: Sequence[int],
        before: Mapping[int, Entry],
        stats: Mapping[str, Column] | None = None,
    ) -> dict[int, Entry]:
        """Write the touched buckets as ``df`` has them, with aggregates of each; carry the others over."""
        entries = {b: e for b, e in before.items() if b not in set(touched)}
        names = [f.name for f in self.schema]
        path = f"{self.folder}/data/version={version}"
        if touched:
            self.with_bucket(df.select(names)).write.mode("overwrite").partitionBy("_bucket").parquet(path)
            schema = T.StructType([*self.schema, T.StructField("_bucket", T.IntegerType())])
            written = self.spark.read.schema(schema).parquet(path).groupBy("_bucket")
            aggregates = [c.cast("string").alias(name) for name, c in (stats or {}).items()]
            for r in written.agg(F.count(F.lit(1)).alias("_rows"), *aggregates).collect():
                known = {name: r[name] for name in stats or {} if r[name] is not None}
                entries[r["_bucket"]] = Entry(version, r["_rows"], known)
        rows = [(b, e.version, e.rows, dict(e.stats)) for b, e in sorted(entries.items())]
        table = self.spark.createDataFrame(rows, MANIFEST).coalesce(1)
        table.write.mode("overwrite").parquet(f"{self.folder}/manifests/version={version}")
        return entries
