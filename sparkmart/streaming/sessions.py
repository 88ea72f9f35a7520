"""Sessions from a stream of event files, as Structured Streaming feeds them in micro-batches.

Each micro-batch is merged into the keyed state of ``operators.session_state`` as a version named after
its batch number. A batch that Spark runs again after a failure replaces its own version, and reads the
state as it was before it, so every event counts once, whatever was lost in between. With the
``availableNow`` trigger a run takes all files that are new since the checkpoint and ends.

The watermark is the latest second of the batches before, less ``lateness_s``. Rows older than that are
late: they are not merged but written to ``folder/late``, so none is lost unseen; without a
``lateness_s`` no row is late, as the state can take rows in any order. Rows without a readable time are
never late. The sessions at any moment are those that one batch run gives for the rows merged so far.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sparkmart.functions import expr
from sparkmart.operators import session_state
from sparkmart.sources.buckets import BucketStore, Entry


def version_of(batch: int) -> str:
    return f"{batch:012d}"


def watermark(state: BucketStore, version: str, lateness_s: int) -> int | None:
    """Seconds before which rows of a version are late; None while nothing was merged."""
    seen = [int(e.stats["to"]) for e in state.entries(before=version).values() if "to" in e.stats]
    return max(seen) - lateness_s if seen else None


def step(
    state: BucketStore,
    events: DataFrame,
    version: str,
    ts: str = "timestamp",
    lateness_s: int | None = None,
    **options,
) -> dict[int, Entry]:
    """Merge one micro-batch; late rows go to their own folder."""
    if lateness_s is not None:
        border = watermark(state, version, lateness_s)
        if border is not None:
            late = F.coalesce(expr.epoch_seconds(events, ts) < border, F.lit(False))
            events.where(late).write.mode("overwrite").parquet(f"{state.folder}/late/version={version}")
            events = events.where(~late)
    return session_state.merge(state, events, version, ts=ts, **options)


def start(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    state: BucketStore,
    checkpoint: str,
    fmt: str = "parquet",
    files_per_batch: int | None = None,
    lateness_s: int | None = None,
    **options,
) -> StreamingQuery:
    """A query over the files of ``source`` that are new since the checkpoint."""
    reader = spark.readStream.schema(schema).format(fmt)
    reader = reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader

    def merge(batch: DataFrame, number: int) -> None:
        step(state, batch, version_of(number), lateness_s=lateness_s, **options)

    writer = reader.load(source).writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def run(*arguments, **options) -> None:
    """Take what is new and return when it is merged; a failure of the query is raised."""
    start(*arguments, **options).awaitTermination()


def late_rows(spark: SparkSession, state: BucketStore, schema: T.StructType) -> DataFrame:
    """Rows that came too late, with the version that saw them; only of a state that has any."""
    wide = T.StructType([*schema, T.StructField("version", T.StringType())])
    return spark.read.schema(wide).parquet(f"{state.folder}/late")
