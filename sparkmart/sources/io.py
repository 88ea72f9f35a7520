"""Readers and writers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_raw(
    spark: SparkSession, path: str, schema: T.StructType, corrupt_col: str | None = "_corrupt"
) -> DataFrame:
    """CSV with a header and a fixed schema; malformed lines are kept in ``corrupt_col``."""
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if corrupt_col:
        schema = T.StructType([*schema.fields, T.StructField(corrupt_col, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_col)
    return reader.schema(schema).csv(path)


def stamp_load(df: DataFrame, load_date: str, source: str | None = None) -> DataFrame:
    """Add ``load_date`` and ``source_file`` (the scanned file's own name unless given)."""
    origin = F.lit(source) if source else F.col("_metadata.file_name")
    return df.withColumns({"load_date": F.lit(load_date), "source_file": origin})


def write_bronze(df: DataFrame, path: str, partition: str = "load_date", fmt: str = "parquet") -> int:
    """Replace only the partitions present in ``df``, earlier loads stay readable; row count."""
    frame, seen = with_metrics(df, "written")
    (
        frame.write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .save(path)
    )
    return int(seen.get["rows"])


def with_rejects(df: DataFrame, schema: T.StructType, corrupt_col: str = "_corrupt") -> DataFrame:
    """Mark malformed rows of ``read_raw``: adds ``rejected`` and ``reject_reason``.

    The reason is the number of fields, or the columns whose text does not have the column's type;
    both are read from the line again, which only malformed rows have.
    """
    line = F.col(corrupt_col)
    texts = ", ".join(f"`{f.name}` string" for f in schema) + ", `_line` string"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_line"}
    parsed = F.from_csv(line, texts, options)
    typed = [f for f in schema if not isinstance(f.dataType, T.StringType)]
    wrong = [
        F.when(parsed.getField(f.name).isNotNull() & F.col(f"`{f.name}`").isNull(), F.lit(f"{f.name} is not {f.dataType.simpleString()}"))
        for f in typed
    ]
    reason = F.when(parsed.getField("_line").isNotNull(), F.lit("wrong number of fields")).otherwise(F.concat_ws(", ", *wrong))
    return df.withColumns({"reject_reason": F.when(line.isNotNull(), reason), "rejected": line.isNotNull()})


def write_split(df: DataFrame, path: str, load_date: str, fmt: str = "parquet") -> tuple[int, int]:
    """Write one load of ``with_rejects`` below ``path``, good rows and rejects in partitions of their
    own, in one scan of the source; rows and rejects among them, counted while they are written.

    The load's folder is replaced as a whole, so that no rejects of an earlier try stay.
    """
    seen = Observation("written")
    frame = df.drop("load_date").observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if("rejected").alias("rejected"))
    writer = frame.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy("rejected").save(f"{path}/load_date={load_date}")
    return int(seen.get["rows"]), int(seen.get["rejected"])


def read_table(spark: SparkSession, source: str, fmt: str = "parquet") -> DataFrame:
    """A path (anything with a slash) or a catalog table."""
    return spark.read.format(fmt).load(source) if "/" in source else spark.read.table(source)


def stamp_silver(df: DataFrame, load_date: str | None) -> DataFrame:
    """Add ``silver_load_date`` if a load date is given."""
    return df.withColumn("silver_load_date", F.lit(load_date)) if load_date else df


def write_table(
    df: DataFrame,
    name: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    dynamic: bool = False,
    bucket_by: tuple[int, Sequence[str]] | None = None,
) -> int:
    """Write a catalog table and return its row count, taken while writing.

    ``partition_by`` lets later scans skip what a filter on these columns leaves out. ``dynamic``
    replaces only the partitions present in ``df`` of a table that exists. ``bucket_by`` (number, columns)
    deals the rows into sorted files by a hash of the columns, so that joins and groups on them need no
    shuffle; each task writes one bucket, so a bucket is one file for each partition. Skewed columns need
    a slice among them (``plans.colocated``).
    """
    if bucket_by:
        df = df.repartition(bucket_by[0], *bucket_by[1])
    frame, seen = with_metrics(df, "written")
    spark = df.sparkSession
    if dynamic and partition_by and spark.catalog.tableExists(name):
        columns = spark.read.table(name).columns
        before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        try:
            frame.select(columns).write.insertInto(name, overwrite=True)
        finally:
            spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    else:
        writer = frame.write.format(fmt).mode("overwrite").option("overwriteSchema", "true")
        if bucket_by:
            writer = writer.bucketBy(bucket_by[0], *bucket_by[1]).sortBy(*bucket_by[1])
        (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(name)
    return int(seen.get["rows"])


def with_metrics(
    df: DataFrame, name: str, not_null: Mapping[str, str] | None = None
) -> tuple[DataFrame, Observation]:
    """Count rows (and NULLs of given columns) while the frame is written, without a second scan."""
    seen = Observation(name)
    nulls = [F.count_if(F.col(c).isNull()).alias(alias) for c, alias in (not_null or {}).items()]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *nulls), seen
