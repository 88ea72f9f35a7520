"""Packing of documents into sequences of a fixed length by best-fit decreasing.

Documents are encoded where they lie; only pieces (document, start, length, checksum) move. Every
document is first cut into full windows, and what is left over of it is one piece. Pieces are dealt
by a hash into groups of a bounded number of pieces; within a group they are placed from the longest
to the shortest, each into the open window with the least room that still suffices, which a segment
tree over the remaining capacities finds. Sequence numbers run on over the groups without gaps.

NULL texts are empty; a document without tokens still has its end id. Repeated rows are packed each
on its own. Rows are told apart by doc_id and a row number within their input partition, so groups
depend on the input's layout; any grouping is a valid packing. An empty table gives no sequence.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm import shared
from sparkmart.llm.encode import closed, encoder, slices, tokenizer_path

WINDOW = 2048
GROUP_PIECES = 200_000
PIECES = "doc_id long, row long, start long, length long, ids_crc32 long, doc_tokens long"


class Capacities:
    """Segment tree over remaining capacities 0 to ``size``: which of them open windows have."""

    def __init__(self, size: int):
        self.width = 1 << size.bit_length()
        self.tree = np.zeros(2 * self.width, np.int64).tolist()
        self.windows: list[list[int]] = [[] for _ in range(size + 1)]

    def add(self, window: int, room: int) -> None:
        self.windows[room].append(window)
        self._count(room, 1)

    def _count(self, room: int, by: int) -> None:
        node = room + self.width
        while node:
            self.tree[node] += by
            node >>= 1

    def tightest(self, need: int) -> int:
        """Least capacity of at least ``need`` that a window has, or -1."""
        node = need + self.width
        if self.tree[node]:
            return need
        while node > 1:
            if not node & 1 and self.tree[node + 1]:
                node += 1
                while node < self.width:
                    node = 2 * node if self.tree[2 * node] else 2 * node + 1
                return node - self.width
            node >>= 1
        return -1

    def take(self, room: int) -> int:
        self._count(room, -1)
        return self.windows[room].pop()


def best_fit(lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, int]:
    """Window and offset of each piece, and the number of windows; longest pieces first."""
    place, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_, n = Capacities(window), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        room = open_.tightest(need)
        if room < 0:
            at, room, n = n, window, n + 1
        else:
            at = open_.take(room)
        place[i], offset[i] = at, window - room
        if room > need:
            open_.add(at, room - need)
    return place, offset, n


def pieces(docs: DataFrame, tokenizer: str, end_id: int, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """Full windows and the rest of every document; ``with_ids`` adds the ids themselves."""

    def task(batches) -> Iterator:
        encode = encoder(tokenizer_path(tokenizer), True).column
        for batch in batches:
            for some in slices(batch, "text"):
                ids, ends = closed(*encode(some.column("text")), end_id)
                ids = ids.astype("<u4", copy=False)
                n = np.diff(np.concatenate([[0], ends]))
                windows = -(-n // window)
                owner = np.repeat(np.arange(len(n)), windows)
                start = window * (np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows))
                length = np.minimum(window, n[owner] - start)
                begin = (ends - n)[owner] + start
                parts = [ids[i : i + k] for i, k in zip(begin.tolist(), length.tolist())]
                sums = [zlib.crc32(x) for x in parts]
                at = pa.array(owner)
                columns = [some.column("doc_id").take(at), some.column("row").take(at), pa.array(start), pa.array(length), pa.array(sums, pa.int64()), pa.array(n[owner])]
                columns += [pa.array([x.tobytes() for x in parts], pa.binary())] * with_ids
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "row", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        F.col("text").cast("string").alias("text"),
    )
    return rows.mapInArrow(task, PIECES + ", ids binary" * with_ids)


def pack(cut: DataFrame, folder: str, window: int = WINDOW, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Give every piece a sequence and an offset. ``cut`` must be a written table."""
    groups = max(1, -(-cut.count() // group_pieces))
    group = F.pmod(F.xxhash64("doc_id", "row", "start"), F.lit(groups)).cast("int")

    def task(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "row", "start"], ignore_index=True)
        pdf["place"], pdf["offset"], n = best_fit(pdf["length"].to_numpy(), window)
        return pdf.assign(windows=n)

    names = [f.name for f in cut.schema]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema)
    placed = (
        cut.withColumn("part", group)
        .groupBy("part")
        .applyInPandas(task, f"{fields}, part int, place long, offset long, windows long")
    )
    placed = shared.staged(placed, folder, "placed")
    bases, total = {}, 0  # one row for each group
    for row in placed.groupBy("part").agg(F.max("windows").alias("n")).orderBy("part").collect():
        bases[row.part], total = total, total + row.n
    if len(bases) > 1:
        steps = placed.sparkSession.createDataFrame(list(bases.items()), "part int, base long")
        placed = placed.join(F.broadcast(steps), "part")
    else:
        placed = placed.withColumn("base", F.lit(0))
    return placed.select(*names, (F.col("base") + F.col("place")).alias("sequence_id"), "offset")


def sequences(packed: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """Padded sequences from packed pieces that carry their ids: one row for each sequence."""

    def task(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("offset")
        ids = np.frombuffer(b"".join(pdf["ids"]), "<u4")
        padded = np.pad(ids, (0, window - len(ids)), constant_values=pad_id)
        return pd.DataFrame({"sequence_id": [key[0]], "n_tokens": [len(ids)], "input_ids": [padded.tolist()]})

    schema = "sequence_id long, n_tokens long, input_ids array<long>"
    return packed.groupBy("sequence_id").applyInPandas(task, schema)


def packed_documents(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> DataFrame:
    return pack(shared.staged(pieces(docs, tokenizer, end_id), folder, "pieces"), folder).drop("row")


def op6_packing(spark, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences of 2048 tokens; one row for each piece."""
    folder = shared.workspace(spark, "packing")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return packed_documents(docs, folder, "byte_bpe_50k.json", end_id=1)
