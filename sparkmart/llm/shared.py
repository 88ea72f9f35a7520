"""Helpers of the subpackage: the shared work folder, staged tables and files in it."""

from __future__ import annotations

import gc
import tempfile
import uuid
import zipfile
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

BATCH_KEY, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20
PACKAGE = Path(__file__).resolve().parent.parent


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once for each Spark application.

    Also bounds the bytes of a batch that tasks hand to Python: batches are counted in rows else, and
    long texts would make them large on both sides.
    """
    if int((spark.conf.get(BATCH_KEY) or "0").rstrip("b")) > BATCH_BYTES:
        spark.conf.set(BATCH_KEY, str(BATCH_BYTES))
    context = spark.sparkContext
    if getattr(context, "_sparkmart_shipped", False):
        return
    name = Path(tempfile.mkdtemp(prefix="sparkmart-code-")) / "sparkmart_code.zip"
    with zipfile.ZipFile(name, "w") as out:
        for file in sorted(PACKAGE.rglob("*.py")):
            out.write(file, Path(PACKAGE.name) / file.relative_to(PACKAGE))
    context.addPyFile(str(name))
    context._sparkmart_shipped = True  # type: ignore[attr-defined]


def workspace(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, which driver and executors share.

    Only a session on one machine without that setting (as in tests) gets a folder of its own.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or getattr(context, "_sparkmart_root", None)
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="sparkmart-")
        context._sparkmart_root = root  # type: ignore[attr-defined]
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write ``df`` as Parquet and read it back: cuts the lineage, survives lost executors."""
    df.write.mode("overwrite").parquet(f"{folder}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")


def drop(folder: str, *names: str) -> None:
    """Delete staged tables that no later step reads, to bound the disk in use."""
    for name in names:
        system, path = filesystem(f"{folder}/{name}")
        system.delete_dir(path)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove shuffle files of finished steps now, not at its next collection."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()  # type: ignore[union-attr]


def filesystem(uri: str):
    """pyarrow file system and path of a URI; a bare path is local."""
    from pyarrow import fs

    if uri.startswith("file:/") and not uri.startswith("file:///"):
        uri = "file:///" + uri[6:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def put(uri: str, blob: bytes) -> None:
    """Write a whole file: a private attempt first, then one rename.

    A repeated task writes the same bytes, so it does not matter which attempt wins.
    """
    system, path = filesystem(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    attempt = f"{path}.{uuid.uuid4().hex}.tmp"
    with system.open_output_stream(attempt, compression=None) as out:
        out.write(blob)
    system.move(attempt, path)


def texts_of(column) -> Iterator[str]:
    """Strings of an Arrow column, NULL as empty."""
    return (x or "" for x in column.to_pylist())


def clear_of(spans: list[tuple[int, str, int]], more: list[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
    """Those of ``more`` that overlap none of ``spans`` (start, kind, end), which are in order of start."""
    starts = [s for s, _, _ in spans]
    reach = list(accumulate((e for _, _, e in spans), max))
    at = [bisect_left(starts, end) for _, _, end in more]
    return [x for x, k in zip(more, at) if not k or reach[k - 1] <= x[0]]
