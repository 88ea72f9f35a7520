"""Write, audit, publish: readers see a version of the gold layer only after its checks have passed.

A version is written to a database of its own (``database__version``), where nobody reads it. The suite
runs on those tables, its report is kept beside them, and only if every check passed are the views of
the served database pointed at the version. A failing check leaves all served views as they are. Every
step replaces what an earlier try left, so a lost run is simply repeated; a run that is lost between two
views is finished by ``publish`` of the same version, and going back is ``publish`` of an earlier one.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from sparkmart.operators import dq
from sparkmart.plans import models as gold_models
from sparkmart.sources import io

REPORT = "audit_report"


@dataclass(frozen=True)
class Audit:
    """What a run did: the version's database, rows by table, failed checks as (model, column, check, failures)."""

    database: str
    counts: Mapping[str, int]
    failed: tuple[tuple[str, str, str, int], ...]

    @property
    def passed(self) -> bool:
        return not self.failed


def database_of(database: str, version: str) -> str:
    return f"{database}__{re.sub('[^0-9A-Za-z]', '_', version)}"


def write(
    spark: SparkSession,
    entities: Mapping[str, DataFrame],
    models: Mapping[str, gold_models.Model],
    database: str,
    version: str,
    fmt: str = "parquet",
    partitions: Mapping[str, Sequence[str]] | None = None,
) -> dict[str, int]:
    """Write all models of a version aside; rows by table."""
    aside = database_of(database, version)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {aside}")
    counts: dict[str, int] = {}
    gold_models.refresh(spark, entities, models, aside, fmt, partitions, counts)
    return counts


def audit(spark: SparkSession, database: str, version: str, suite: Sequence[dq.Check]) -> list[tuple[str, str, str, int]]:
    """Run the suite on the tables of a version and keep its report there; the checks that failed.

    The report has one row for each declared check, which is what reaches the driver.
    """
    aside = database_of(database, version)
    names = {k.model for k in suite} | {k.args[0] for k in suite if k.kind == "relationships"}
    io.write_table(dq.run({name: spark.read.table(f"{aside}.{name}") for name in names}, suite), f"{aside}.{REPORT}")
    failed = spark.read.table(f"{aside}.{REPORT}").where("NOT passed").orderBy("model", "column", "check")
    return [(r.model, r.column, r.check, r.failures) for r in failed.collect()]


def publish(spark: SparkSession, database: str, version: str, tables: Sequence[str], views: Mapping[str, tuple[str, str]] | None = None) -> None:
    """Point the served views at a version: one for each table, and ``views`` (name -> table, comment) over them."""
    aside = database_of(database, version)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in tables:
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT * FROM {aside}.{name}")
    if views:
        gold_models.publish_views(spark, {v: s for v, s in views.items() if s[0] in tables}, database)


def run(
    spark: SparkSession,
    entities: Mapping[str, DataFrame],
    models: Mapping[str, gold_models.Model],
    suite: Sequence[dq.Check],
    database: str,
    version: str,
    fmt: str = "parquet",
    partitions: Mapping[str, Sequence[str]] | None = None,
    views: Mapping[str, tuple[str, str]] | None = gold_models.SERVING,
) -> Audit:
    """Write a version, run the suite on it, and publish it only if every check passed."""
    counts = write(spark, entities, models, database, version, fmt, partitions)
    failed = audit(spark, database, version, suite)
    if not failed:
        publish(spark, database, version, list(counts), views)
    return Audit(database_of(database, version), counts, tuple(failed))
