"""Sessions from event streams, safe for a customer that owns a third of all events.

Only whole seconds decide a session boundary, so events are first reduced to one row per customer
and second. Boundaries are found inside time buckets of one customer (at most ``bucket_s`` rows
each, whatever the traffic) and carried forward from bucket to bucket. What comes back to the
events is one row per customer and bucket with the few seconds at which sessions open: a small
table, broadcast if it measures small, else joined on (customer, bucket) where AQE can split a
bucket that is flooded with events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.functions import expr
from sparkmart.operators import skew
from sparkmart.sources import io


# Sessions that one bucket of a customer may open at most.
MOST_STARTS = 100_000
# Stands for an unreadable time; sorts before any real second.
_NO_TIME = -(2**62)


def visitors(df: DataFrame, key: str, anonymous: str) -> DataFrame:
    """Add a non-NULL ``_visitor`` for every event that takes part."""
    known = F.concat(F.lit("c"), F.col(key).cast("string"))
    if anonymous == "drop":
        df = df.where(F.col(key).isNotNull())
        return df.withColumn("_visitor", F.coalesce(known, F.lit("")))
    if anonymous == "by_client_session":
        client = F.concat(F.lit("a"), F.col("session_id"))
        return df.withColumn("_visitor", F.coalesce(known, client, F.lit("")))
    if anonymous == "keep":
        return df.withColumn("_visitor", F.coalesce(known, F.lit("")))
    raise ValueError(f"anonymous must be drop, by_client_session or keep, not {anonymous!r}")


def _session_label(key: str) -> Column:
    """Prefix of a session id; NULL for events that belong to nobody."""
    name = F.substr("_visitor", F.lit(2))
    anonymous = F.when(F.col("_visitor").startswith("a"), F.concat(F.lit("anonymous-"), name))
    return F.coalesce(F.col(key).cast("string"), anonymous)


def session_id(key: str, separator: str = "") -> Column:
    """Id from ``_visitor`` and ``session_number``: four digits; longer numbers follow a dash."""
    digits = F.col("session_number").cast("string")
    number = F.when(F.col("session_number") < 10000, F.lpad(digits, 4, "0"))
    number = number.otherwise(digits if separator else F.concat(F.lit("-"), digits))
    return F.concat(_session_label(key), F.lit(separator), number)


def _bucket_of(second: Column, bucket_s: int) -> Column:
    return F.coalesce(F.floor(second / bucket_s), F.lit(0))


def _session_starts(events: DataFrame, timeout_s: int, bucket_s: int) -> DataFrame:
    """(visitor, bucket, offset, starts): sessions opened before the bucket and inside it.

    ``starts`` holds the seconds at which sessions open. They are more than ``timeout_s`` apart, so
    a bucket has at most ``bucket_s / timeout_s + 1`` of them.
    """
    second, timed = F.col("_second"), F.col("_second") > _NO_TIME
    by_bucket = Window.partitionBy("_visitor", "_bucket").orderBy("_second")
    gap = second - F.lag("_second").over(by_bucket)
    # One row per visitor and bucket. Its first second opens a session unless the visitor's
    # previous bucket ended within the timeout; the others were compared inside the bucket.
    by_visitor = Window.partitionBy("_visitor").orderBy("_bucket")
    previous = F.lag("_last").over(by_visitor)
    apart = previous.isNull() | (previous == _NO_TIME) | (F.col("_first") - previous > timeout_s)
    opening = F.when((F.col("_first") > _NO_TIME) & apart, F.array("_first")).otherwise(F.array())
    return (
        events.groupBy("_visitor", "_second")
        .agg(F.count(F.lit(1)).alias("_events"))
        .withColumn("_bucket", _bucket_of(second, bucket_s))
        .withColumn("_opens", timed & (gap > timeout_s))
        .groupBy("_visitor", "_bucket")
        .agg(
            F.min("_second").alias("_first"),
            F.max("_second").alias("_last"),
            F.collect_list(F.when(F.col("_opens"), second)).alias("_inner"),
            F.sum(F.when(~timed, F.col("_events")).otherwise(F.lit(0))).alias("_untimed"),
        )
        .withColumn("_starts", F.concat(opening, "_inner"))
        # Events without a readable time each open a session, sort first and share the last number.
        .withColumn("_total", F.size("_starts") + F.col("_untimed"))
        .withColumn("_before", skew.earlier_total("_total", ["_visitor"], ["_bucket"]))
        .select(
            "_visitor", "_bucket", (F.col("_before") + F.col("_untimed")).alias("_offset"), "_starts"
        )
    )


def assign(
    df: DataFrame,
    key: str = "customer_id",
    ts: str = "timestamp",
    timeout_s: int = 1800,
    bucket_s: int = 86400,
    anonymous: str = "drop",
    separator: str = "",
) -> DataFrame:
    """Add ``session_number`` and ``true_session_id`` to every event.

    A session ends when the next event of the same customer comes more than ``timeout_s`` whole
    seconds later. Events without a customer are dropped, sessionised by the client's own
    ``session_id``, or kept as one unidentified visitor (``anonymous="keep"``).

    Ids are the customer and a number of four digits; longer numbers follow a dash, so that they
    cannot be read as another customer's. A ``separator`` is put before every number.
    """
    if timeout_s < 0 or bucket_s < 1 or bucket_s > MOST_STARTS * max(1, timeout_s):
        raise ValueError(f"a bucket of {bucket_s} s would hold too many sessions of {timeout_s} s")
    second = F.coalesce(expr.epoch_seconds(df, ts), F.lit(_NO_TIME))
    events = visitors(df, key, anonymous).withColumn("_second", second)
    starts = _session_starts(events.select("_visitor", "_second"), timeout_s, bucket_s)
    opened = F.size(F.filter("_starts", lambda start: start <= F.col("_second")))
    return (
        events.withColumn("_bucket", _bucket_of(F.col("_second"), bucket_s))
        .join(starts, ["_visitor", "_bucket"])
        .withColumn("session_number", F.col("_offset") + opened)
        .withColumn("true_session_id", session_id(key, separator))
        .drop("_visitor", "_second", "_bucket", "_offset", "_starts")
    )


def rollup(
    df: DataFrame,
    key: str = "customer_id",
    ts: str = "timestamp",
    tie: str = "event_id",
    conversion: str = "conversion",
    load_date: str | None = None,
) -> DataFrame:
    """One row per session. Entry, exit and first-seen attributes follow time, then ``tie``."""
    order = [F.col(ts).alias("ts"), F.col(tie).alias("tie")]
    first = F.min(F.struct(*order, "page", "device", "utm_source", "utm_campaign"))
    last = F.max(F.struct(*order, "page"))
    seconds = expr.epoch_seconds(df, ts)
    out = (
        df.groupBy("true_session_id", key)
        .agg(
            F.min(ts).alias("session_start"),
            F.max(ts).alias("session_end"),
            (F.max(seconds) - F.min(seconds)).alias("session_duration_seconds"),
            F.count(tie).alias("event_count"),
            first.alias("_first"),
            last.alias("_last"),
            F.bool_or(F.coalesce(F.col("event_type") == conversion, F.lit(False))).alias("converted"),
        )
        .select(
            "true_session_id",
            key,
            "session_start",
            "session_end",
            "event_count",
            F.col("_first.page").alias("entry_page"),
            F.col("_last.page").alias("exit_page"),
            "converted",
            F.col("_first.device").alias("device"),
            F.col("_first.utm_source").alias("utm_source"),
            F.col("_first.utm_campaign").alias("utm_campaign"),
            "session_duration_seconds",
        )
    )
    return io.stamp_silver(out, load_date)
