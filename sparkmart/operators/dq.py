"""Declarative data-quality checks: single checks and a suite runner."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULL is not a value."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    return counts.where(F.col("rows") > 1)


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, failures) for all columns from one aggregate."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return row.unpivot([], list(columns), "column", "failures")


def accepted(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    """Values outside the list with their row counts; NULL passes."""
    bad = df.where(~F.col(column).isin(*values))
    return bad.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def relationship(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Foreign keys without a parent, with their row counts; NULL passes.

    The child is counted per key first, so a hot key crosses the join as one row.
    """
    keys = child.where(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("rows"))
    return keys.join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    kind: str  # unique | not_null | accepted_values | relationships
    args: tuple = field(default=())  # accepted values, or (parent model, parent column)


def _row_failure(check: Check) -> Column:
    c = F.col(check.column)
    if check.kind == "not_null":
        return c.isNull()
    return ~c.isin(*check.args)


def _label(check: Check) -> str:
    return f"{check.column}|{check.kind}"


def _report(row: DataFrame, model: str) -> DataFrame:
    """Turn a one-row frame whose columns are check labels into report rows."""
    label = F.split("label", "\\|")
    return (
        row.select([F.col(c).cast("bigint").alias(c) for c in row.columns])
        .unpivot([], row.columns, "label", "failures")
        .select(
            F.lit(model).alias("model"),
            label[0].alias("column"),
            label[1].alias("check"),
            F.coalesce("failures", F.lit(0).cast("bigint")).alias("failures"),
        )
    )


def _check_model(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All row checks and the uniqueness of one key in a single pass over the model."""
    model = checks[0].model
    rows = [k for k in checks if k.kind in ("not_null", "accepted_values")]
    keys = [k for k in checks if k.kind == "unique"]
    bad = [F.count_if(_row_failure(k)).alias(_label(k)) for k in rows]
    if not keys:
        return _report(df.agg(*bad), model)
    key = keys[0].column
    per_key = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"), *bad)
    repeated = F.count_if((F.col("_n") > 1) & F.col("_key").isNotNull())
    totals = [F.sum(F.col(f"`{_label(k)}`")).alias(_label(k)) for k in rows]
    out = _report(per_key.agg(repeated.alias(_label(keys[0])), *totals), model)
    for extra in keys[1:]:
        counts = unique(df, extra.column).agg(F.count(F.lit(1)).alias(_label(extra)))
        out = out.unionByName(_report(counts, model))
    return out


def _foreign_keys(df: DataFrame, model: str, checks: Sequence[Check]) -> DataFrame:
    """(model, label, key, rows): how often each foreign key occurs, for all keys in one pass."""
    pairs = F.array(
        *[F.struct(F.lit(_label(k)).alias("label"), F.col(k.column).cast("string").alias("key")) for k in checks]
    )
    return (
        df.select(F.inline(pairs))
        .where(F.col("key").isNotNull())
        .groupBy("label", "key")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(model).alias("model"), "label", "key", "rows")
    )


def _constants(like: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """(model, label) of the checks, so that those without any key are reported too."""
    rows = F.array(*[F.struct(F.lit(k.model).alias("model"), F.lit(_label(k)).alias("label")) for k in checks])
    return like.sparkSession.range(1).select(F.inline(rows))


def run(models: Mapping[str, DataFrame], suite: Sequence[Check]) -> DataFrame:
    """(model, column, check, failures, passed): one row per declared check.

    ``failures`` counts repeated values for ``unique`` and failing rows for the other kinds. A model
    is read once for its row checks and once for all of its foreign keys; a parent is read once for
    all keys that point to it. Over tables that is all; over lazy frames, each reading builds them.
    """
    parts = []
    links: dict[tuple[str, str], list[DataFrame]] = {}
    for name in dict.fromkeys(k.model for k in suite):
        own = [k for k in suite if k.model == name]
        local = [k for k in own if k.kind != "relationships"]
        if local:
            parts.append(_check_model(models[name], local))
        if keys := [k for k in own if k.kind == "relationships"]:
            counts = _foreign_keys(models[name], name, keys)
            for parent in dict.fromkeys(k.args for k in keys):
                labels = [_label(k) for k in keys if k.args == parent]
                links.setdefault(parent, []).append(counts.where(F.col("label").isin(labels)))
    for (parent, pk), counts in links.items():
        every = reduce(DataFrame.unionByName, counts)
        known = models[parent].select(F.col(pk).cast("string").alias("key"), F.lit(1).alias("_known"))
        missing = F.sum(F.when(F.col("_known").isNull(), F.col("rows")).otherwise(F.lit(0)))
        found = every.join(known.distinct(), "key", "left").groupBy("model", "label").agg(missing.alias("failures"))
        wanted = [k for k in suite if k.kind == "relationships" and k.args == (parent, pk)]
        listed = _constants(found, wanted)
        parts.append(
            listed.join(found, ["model", "label"], "left").select(
                "model",
                F.split("label", "\\|")[0].alias("column"),
                F.split("label", "\\|")[1].alias("check"),
                F.coalesce("failures", F.lit(0)).cast("bigint").alias("failures"),
            )
        )
    report = reduce(DataFrame.unionByName, parts)
    return report.withColumn("passed", F.col("failures") == 0)
