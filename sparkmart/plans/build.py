"""From raw files to gold tables: bronze, silver, then the models of ``models.gold``.

Malformed lines stay in the bronze tables, in a partition of their own with the line, its file and the
reason (``rejects``); ``quarantine`` keeps them out of silver, else they enter with what could be read.
Silver is merged load by load (``plans.incremental``): a load is read once, and only the key buckets
that it touches are read and written.

Each stage reads what the stage before wrote, so a lost executor costs a task, not the lineage, and
cleaning runs once. Every write counts its rows while it writes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart import schemas
from sparkmart.plans import incremental, models
from sparkmart.sources import io

ENTITIES = tuple(schemas.RAW_DDL)

# Partition columns of tables whose reads are bounded by date; more are given by the caller.
SILVER_PARTITIONS = ("silver_load_date",)


def bronze(
    spark: SparkSession, files: Mapping[str, str], folder: str, load_date: str, fmt: str = "parquet"
) -> dict[str, int]:
    """Raw CSV files (entity -> path) to ``folder/entity``, partitioned by load date and rejection;
    rows of each, rejects included."""
    counts = {}
    for entity, path in files.items():
        raw = io.with_rejects(io.stamp_load(io.read_raw(spark, path, schemas.raw(entity)), load_date), schemas.raw(entity))
        counts[entity], _ = io.write_split(raw, f"{folder}/{entity}", load_date, fmt)
    return counts


def _bronze_rows(spark: SparkSession, folder: str, entity: str, fmt: str) -> DataFrame:
    """Good rows and rejects of all loads."""
    df = io.read_table(spark, f"{folder}/{entity}", fmt)
    # Partition columns would otherwise come back as a date and as text.
    return df.withColumns({"load_date": F.col("load_date").cast("string"), "rejected": F.col("rejected").cast("boolean")})


def rejects(spark: SparkSession, folder: str, entity: str, load_date: str | None = None, fmt: str = "parquet") -> DataFrame:
    """load_date, source_file, reason and raw line of the malformed lines."""
    df = _bronze_rows(spark, folder, entity, fmt).where("rejected")
    df = df.where(F.col("load_date") == load_date) if load_date else df
    return df.select("load_date", "source_file", F.col("reject_reason").alias("reason"), F.col("_corrupt").alias("line"))


def silver_tables(
    spark: SparkSession,
    folder: str,
    load_date: str,
    database: str = "default",
    entities: Sequence[str] = ENTITIES,
    fmt: str = "parquet",
    state: str | None = None,
    quarantine: bool = False,
    buckets: int = 64,
) -> dict[str, int]:
    """Merge the load of ``load_date`` (and earlier ones that were never merged) into the state below
    ``state`` (default: beside ``folder``) and write ``database.silver_entity`` from it.

    The rows are those of the whole history, deduplicated; the table keeps earlier load dates as
    partitions, so a load can be repeated or compared. Loads after a repeated or late one are merged
    anew; their tables are those of their own calls.
    """
    counts = {}
    for entity in entities:
        df = _bronze_rows(spark, folder, entity, fmt)
        df = df.where(~F.col("rejected")) if quarantine else df
        df = df.select(*schemas.raw(entity).names, "load_date")
        held = incremental.store(spark, state or f"{folder.rstrip('/')}-state", entity, df, buckets)
        of_date = lambda date, df=df: df.where(F.col("load_date") == date)
        known = set(held.versions())
        dates = sorted(r[0] for r in df.select("load_date").distinct().collect())
        for date in [d for d in dates if d < load_date and d not in known]:
            incremental.advance(held, of_date, entity, date)
        incremental.advance(held, of_date, entity, load_date)
        cleaned = incremental.cleaned(held, entity, load_date)
        counts[entity] = io.write_table(
            cleaned, f"{database}.silver_{entity}", fmt, SILVER_PARTITIONS, dynamic=True
        )
    return counts


def entities(
    spark: SparkSession, load_date: str, database: str = "default"
) -> dict[str, DataFrame]:
    """The silver tables of one load date; the filter prunes all other partitions."""
    return {
        e: spark.read.table(f"{database}.silver_{e}").where(F.col("silver_load_date") == load_date)
        for e in ENTITIES
    }


def run(
    spark: SparkSession,
    files: Mapping[str, str],
    folder: str,
    load_date: str,
    gold: Mapping[str, models.Model],
    database: str = "default",
    fmt: str = "parquet",
    partitions: Mapping[str, Sequence[str]] | None = None,
    quarantine: bool = False,
) -> dict[str, dict[str, int]]:
    """All stages for one load date; the rows written by each, by table."""
    counts = {"bronze": bronze(spark, files, folder, load_date, fmt)}
    counts["silver"] = silver_tables(spark, folder, load_date, database, fmt=fmt, quarantine=quarantine)
    counts["gold"] = {}
    models.refresh(spark, entities(spark, load_date, database), gold, database, fmt, partitions, counts["gold"])
    models.publish_staging(spark, database)
    models.publish_views(spark, database=database)
    return counts
