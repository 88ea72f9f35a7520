"""Sessions kept up load by load: the events of a load extend, open or join sessions of their visitors.

The state is a ``BucketStore`` with one row for each session: its visitor, number, first and last second,
and the parts of the roll-up that can be merged (counts, first and last event, flags). A load is first
rolled up by itself; these partial sessions are then put in one row with those that their visitors have,
and stretches that are no further apart than the timeout become one session. So it does not matter how
events are split into loads, or in what order these come: an event that arrives late joins the sessions
before and after it, and later numbers move up. Only visitors of the load are decided anew, and only
their buckets are read and written.

A visitor's sessions are more than the timeout apart, so their number is bounded by time, not by traffic;
no window holds more than the sessions of one visitor.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.functions import expr
from sparkmart.operators import sessions
from sparkmart.sources import io
from sparkmart.sources.buckets import BucketStore, Entry

# Merged by these; the order of loads plays no part in any of them.
_MERGED = {
    "_from": F.min, "_to": F.max, "_rows": F.sum, "event_count": F.sum, "session_start": F.min, "session_end": F.max,
    "_first": F.min, "_last": F.max, "converted": F.bool_or,
}


def partial(
    events: DataFrame,
    key: str = "customer_id",
    ts: str = "timestamp",
    tie: str = "event_id",
    conversion: str = "conversion",
    timeout_s: int = 1800,
    anonymous: str = "drop",
) -> DataFrame:
    """Sessions of some events by themselves. Events without a readable time are one row with no seconds."""
    numbered = sessions.assign(events, key, ts, timeout_s, anonymous=anonymous)
    rows = sessions.visitors(numbered, key, anonymous)
    second = expr.epoch_seconds(rows, ts)
    order = [F.col(ts).alias("ts"), F.col(tie).alias("tie")]
    return rows.groupBy("_visitor", "session_number").agg(
        F.max(key).alias(key),
        F.min(second).alias("_from"),
        F.max(second).alias("_to"),
        F.count(F.lit(1)).alias("_rows"),
        F.count(tie).alias("event_count"),
        F.min(ts).alias("session_start"),
        F.max(ts).alias("session_end"),
        F.min(F.struct(*order, "page", "device", "utm_source", "utm_campaign")).alias("_first"),
        F.max(F.struct(*order, "page")).alias("_last"),
        F.bool_or(F.coalesce(F.col("event_type") == conversion, F.lit(False))).alias("converted"),
    )


def joined(parts: DataFrame, key: str = "customer_id", timeout_s: int = 1800) -> DataFrame:
    """Partial sessions of any loads as the sessions of one run, numbered."""
    by_visitor = Window.partitionBy("_visitor").orderBy(F.col("_from").asc_nulls_first(), "_to")
    earlier = by_visitor.rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max("_to").over(earlier)
    opens = F.col("_from").isNotNull() & (reach.isNull() | (F.col("_from") - reach > timeout_s))
    rows = parts.withColumn("_opens", opens.cast("long"))
    rows = rows.withColumn("_place", F.sum("_opens").over(by_visitor.rowsBetween(Window.unboundedPreceding, 0)))
    # Rows without seconds come first and open nothing: place 0.
    out = rows.groupBy("_visitor", "_place").agg(F.max(key).alias(key), *(how(c).alias(c) for c, how in _MERGED.items()))
    # Each event without a time counts as a session of its own before all others; they share the last number.
    untimed = F.coalesce(F.sum(F.when(F.col("_place") == 0, F.col("_rows"))).over(Window.partitionBy("_visitor")), F.lit(0))
    return out.withColumn("session_number", (F.col("_place") + untimed).cast("long")).drop("_place")


def store(spark: SparkSession, folder: str, events: DataFrame, key: str = "customer_id", buckets: int = 64, **options) -> BucketStore:
    """The state; ``events`` (of any load) give its types."""
    schema = joined(partial(events.limit(0), key, **options), key).schema
    order = ["_visitor", "session_number", key, *_MERGED]
    return BucketStore(spark, folder, T.StructType([T.StructField(c, schema[c].dataType) for c in order]), ["_visitor"], buckets)


def merge(state: BucketStore, events: DataFrame, version: str, key: str = "customer_id", timeout_s: int = 1800, **options) -> dict[int, Entry]:
    """Merge the events of one load into the sessions as they were before ``version``.

    A version that is merged again replaces itself; those after it must then be merged anew.
    """
    rows, touched = state.incoming(partial(events, key, timeout_s=timeout_s, **options), version)
    before = state.entries(before=version)
    old = state.read({b: before[b] for b in touched if b in before})
    names = rows.select("_visitor").distinct()
    same = old.join(names, "_visitor", "left_anti")
    again = old.join(names, "_visitor", "left_semi").unionByName(rows.drop("_bucket"))
    out = same.unionByName(joined(again, key, timeout_s).select(old.columns))
    return state.commit(version, out, touched, before, {"to": F.max("_to")})


def rollup(state: BucketStore, entries: Mapping[int, Entry] | None = None, key: str = "customer_id", load_date: str | None = None, separator: str = "") -> DataFrame:
    """One row per session, as ``sessions.rollup`` gives it; a scan of the live buckets."""
    rows = state.read(state.entries() if entries is None else entries)
    out = rows.select(
        sessions.session_id(key, separator).alias("true_session_id"), key, "session_start", "session_end", "event_count",
        F.col("_first.page").alias("entry_page"), F.col("_last.page").alias("exit_page"), "converted",
        F.col("_first.device").alias("device"), F.col("_first.utm_source").alias("utm_source"), F.col("_first.utm_campaign").alias("utm_campaign"),
        (F.col("_to") - F.col("_from")).alias("session_duration_seconds"),
    )
    return io.stamp_silver(out, load_date)


def assign(
    events: DataFrame,
    state: BucketStore,
    entries: Mapping[int, Entry] | None = None,
    key: str = "customer_id",
    ts: str = "timestamp",
    anonymous: str = "drop",
    separator: str = "",
    bucket_s: int = 86400,
) -> DataFrame:
    """Add the session of the state to any events that it holds.

    Sessions are listed for each visitor and day that they reach, so an event finds its own among the few
    of its day; a flooded day is split by adaptive execution.
    """
    rows = state.read(state.entries() if entries is None else entries)
    day = lambda c: F.floor(F.col(c) / bucket_s)
    days = F.when(F.col("_from").isNull(), F.array(F.lit(None).cast("long"))).otherwise(F.sequence(day("_from"), day("_to")))
    listed = rows.select("_visitor", "_from", "session_number", F.explode(days).alias("_day"))
    listed = listed.groupBy("_visitor", "_day").agg(F.sort_array(F.collect_list(F.struct("_from", "session_number"))).alias("_sessions"))
    known = sessions.visitors(events, key, anonymous).withColumn("_second", expr.epoch_seconds(events, ts))
    known = known.withColumn("_day", day("_second"))
    found = known.join(
        listed.withColumnsRenamed({"_visitor": "_whose", "_day": "_when"}),
        (F.col("_visitor") == F.col("_whose")) & F.col("_day").eqNullSafe(F.col("_when")),
    )
    begun = F.filter("_sessions", lambda s: s["_from"].isNull() | (s["_from"] <= F.col("_second")))
    out = found.withColumn("session_number", F.element_at(begun, -1)["session_number"])
    out = out.withColumn("true_session_id", sessions.session_id(key, separator))
    return out.drop("_visitor", "_second", "_day", "_whose", "_when", "_sessions")

