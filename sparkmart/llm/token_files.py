"""Token ids in binary files of patched frame-of-reference blocks.

Layout of a file (all integers little-endian)::

    magic | blocks | doc_id int64[n_docs] | n_tokens int64[n_docs] | block start uint64[n_blocks]
    | footer: n_docs, n_blocks, n_ids uint64, place of the doc_ids uint64 | magic

A block holds 4096 ids (the last one is padded with its minimum): the minimum, a bit width taken
from a percentile of the differences, the differences packed at that width, and a list of the
positions and whole differences that do not fit. The index of block starts gives random access.

Documents are range-partitioned and sorted by doc_id; each task writes its ids to files of a bounded
size. A file is written under a private name and renamed, and its name follows from the partition
alone, so a repeated task replaces it by the same bytes.

NULL doc_ids come first, NULL texts are empty, repeated rows are kept, a document without tokens
still has its end id, an empty table gives no file. Columns other than the two named are ignored.
The folder must be one that pyarrow can open (file, hdfs, s3, gs) and that all executors share.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm import shared
from sparkmart.llm.encode import closed, encoder, slices, tokenizer_path

MAGIC = b"PFORIDS1"
BLOCK = 4096
FILE_IDS = 2_000_000
TASK_IDS = 3 * FILE_IDS  # ids that one task reads back
PERCENTILE = 90
_HEAD = struct.Struct("<IBxHI")  # minimum, width, exceptions, bytes of the packed part
_FOOT = struct.Struct("<QQQQ8s")
NULL_ID = -(2**63)  # how a NULL doc_id is stored


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of 64 values as rows of ``width`` 64-bit words."""
    out = np.zeros((len(values), width), np.uint64)
    for j in range(64 if width else 0):
        word, shift = divmod(j * width, 64)
        out[:, word] |= values[:, j] << np.uint64(shift)
        if shift + width > 64:
            out[:, word + 1] |= values[:, j] >> np.uint64(64 - shift)
    return out


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(words), 64), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for j in range(64 if width else 0):
        word, shift = divmod(j * width, 64)
        out[:, j] = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            out[:, j] |= words[:, word + 1] << np.uint64(64 - shift)
        out[:, j] &= mask
    return out


def encode_blocks(ids: np.ndarray, percentile: float = PERCENTILE) -> list[bytes]:
    """Blocks of a run of unsigned 32-bit ids."""
    n = -(-len(ids) // BLOCK)
    if not n:
        return []
    whole = np.empty(n * BLOCK, np.uint32)
    whole[: len(ids)] = ids
    whole[len(ids) :] = ids[(n - 1) * BLOCK :].min()
    rows = whole.reshape(n, BLOCK)
    lows = rows.min(axis=1)
    rows = rows - lows[:, None]
    k = min(BLOCK - 1, int(BLOCK * percentile / 100))
    tops = np.partition(rows, k, axis=1)[:, k]
    widths = np.array([int(x).bit_length() for x in tops])
    out = [b""] * n
    for width in sorted(set(widths.tolist())):  # blocks of one width are packed together
        at = np.flatnonzero(widths == width)
        values = rows[at].astype(np.uint64)
        large = values >> np.uint64(width) > 0
        kept = np.where(large, np.uint64(0), values).reshape(-1, 64)
        packed = _pack(kept, width).astype("<u8").reshape(len(at), -1)
        for i, b in enumerate(at.tolist()):
            where = np.flatnonzero(large[i])
            extra = where.astype("<u2").tobytes() + rows[b][where].astype("<u4").tobytes()
            out[b] = _HEAD.pack(int(lows[b]), width, len(where), 8 * packed.shape[1]) + packed[i].tobytes() + extra
    return out


def decode_blocks(blobs: list[bytes]) -> np.ndarray:
    """Ids of some blocks, padding included."""
    out = np.empty((len(blobs), BLOCK), np.uint32)
    heads = [_HEAD.unpack_from(b) for b in blobs]
    for width in {h[1] for h in heads}:  # blocks of one width are unpacked together
        at = [i for i, h in enumerate(heads) if h[1] == width]
        words = np.concatenate([np.frombuffer(blobs[i], "<u8", heads[i][3] // 8, _HEAD.size) for i in at])
        rows = len(at) * BLOCK // 64
        out[at] = _unpack(words.reshape(rows, width), width).reshape(len(at), BLOCK)
    for i, (low, _, n, size) in enumerate(heads):
        where = np.frombuffer(blobs[i], "<u2", n, _HEAD.size + size)
        out[i, where] = np.frombuffer(blobs[i], "<u4", n, _HEAD.size + size + 2 * n)
        out[i] += np.uint32(low)
    return out.ravel()


def encode_file(doc_ids: list[int], counts: list[int], ids: np.ndarray) -> bytes:
    blocks = encode_blocks(ids)
    starts = len(MAGIC) + np.cumsum([0, *map(len, blocks)])
    tables = [np.array(doc_ids, "<i8"), np.array(counts, "<i8"), starts[:-1].astype("<u8")]
    foot = _FOOT.pack(len(doc_ids), len(blocks), len(ids), int(starts[-1]), MAGIC)
    return b"".join([MAGIC, *blocks, *(t.tobytes() for t in tables), foot])


class TokenFile:
    """Reads a file by ranges: the footer, the tables, then the blocks that are asked for."""

    def __init__(self, uri: str):
        system, path = shared.filesystem(uri)
        self.file = system.open_input_file(path)
        size = self.file.size()
        if size < len(MAGIC) + _FOOT.size:
            raise ValueError(f"{uri}: too short for a token file")
        foot = self.file.read_at(_FOOT.size, size - _FOOT.size)
        n_docs, n_blocks, self.n_ids, self.end, magic = _FOOT.unpack(foot)
        if magic != MAGIC:
            raise ValueError(f"{uri}: not a token file")
        tables = self.file.read_at(8 * (2 * n_docs + n_blocks), self.end)
        self.doc_ids = np.frombuffer(tables, "<i8", n_docs)
        self.counts = np.frombuffer(tables, "<i8", n_docs, 8 * n_docs)
        self.starts = [*map(int, np.frombuffer(tables, "<u8", n_blocks, 16 * n_docs)), self.end]

    def ids(self, start: int, length: int) -> np.ndarray:
        """Ids ``start`` to ``start + length`` of the file, from their blocks alone."""
        if not length:
            return np.zeros(0, "<u4")
        first, last = start // BLOCK, (start + length - 1) // BLOCK
        blob = self.file.read_at(self.starts[last + 1] - self.starts[first], self.starts[first])
        at = self.starts[first]
        parts = [blob[self.starts[b] - at : self.starts[b + 1] - at] for b in range(first, last + 1)]
        return decode_blocks(parts)[start - first * BLOCK :][:length].astype("<u4")


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into files below ``folder``; one row for each file."""

    def task(batches) -> Iterator:
        import pyarrow as pa

        part, made = TaskContext.get().partitionId(), 0
        encode = encoder(tokenizer_path(tokenizer), False).column
        doc_ids: list[int] = []
        counts: list[int] = []
        held: list[np.ndarray] = []
        total = 0

        def flush():
            nonlocal made, total
            uri = f"{folder}/ids-{part:06d}-{made:05d}.pfor"
            shared.put(uri, encode_file(doc_ids, counts, np.concatenate(held)))
            row = {"uri": [uri], "part": [part], "piece": [made], "n_docs": [len(doc_ids)], "n_ids": [total]}
            made, total = made + 1, 0
            for x in (doc_ids, counts, held):
                x.clear()
            return pa.RecordBatch.from_pydict(row, schema=schema)

        schema = pa.schema([("uri", pa.string()), *((c, pa.int64()) for c in ("part", "piece", "n_docs", "n_ids"))])
        for batch in batches:
            for some in slices(batch, "text"):
                ids, ends = closed(*encode(some.column("text")), end_id)
                keys = some.column("doc_id").fill_null(NULL_ID).to_pylist()
                at = 0
                while at < len(keys):  # as many documents as the file still takes
                    begin = int(ends[at - 1]) if at else 0
                    to = min(len(keys), int(np.searchsorted(ends, begin + FILE_IDS - total)) + 1)
                    doc_ids += keys[at:to]
                    counts += np.diff(np.concatenate([[begin], ends[at:to]])).tolist()
                    held.append(ids[begin : ends[to - 1]])
                    total += len(held[-1])
                    at = to
                    if total >= FILE_IDS:
                        yield flush()
        if doc_ids:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return rows.mapInArrow(task, "uri string, part long, piece long, n_docs long, n_ids long")


def read(files: DataFrame) -> DataFrame:
    """Documents of written files, in file order: doc_id, start, n_tokens and the checksum of ids."""
    order = Window.orderBy("part", "piece").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("n_ids").over(order), F.lit(0))  # one row for each file, not document
    placed = files.select("uri", base.alias("base"))

    def task(batches) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for uri, base in zip(batch.column("uri").to_pylist(), batch.column("base").to_pylist()):
                file = TokenFile(uri)
                ends = np.cumsum(file.counts)
                starts = ends - file.counts
                sums = np.zeros(len(ends), np.int64)
                i = 0
                while i < len(ends):  # about a megabyte of ids at a time
                    j = max(i + 1, int(np.searchsorted(ends, starts[i] + 64 * BLOCK)))
                    blob = memoryview(file.ids(int(starts[i]), int(ends[j - 1] - starts[i])).tobytes())
                    for k in range(i, j):
                        sums[k] = zlib.crc32(blob[4 * int(starts[k] - starts[i]) : 4 * int(ends[k] - starts[i])])
                    i = j
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(file.doc_ids, mask=file.doc_ids == NULL_ID),
                        pa.array(starts + base),
                        pa.array(file.counts),
                        pa.array(sums),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    # A number of tasks is given, as adaptive execution would put the few short rows into one.
    total = files.agg(F.sum("n_ids")).first()[0] or 0
    spread = placed.repartition(max(1, -(-total // TASK_IDS)))
    return spread.mapInArrow(task, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op2_token_files(spark, sf_dir: str) -> DataFrame:
    """Encode all documents into token files and return what reading the files back gives."""
    folder = shared.workspace(spark, "token-files")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    files = write(docs, folder, "word_bpe_49k.json", end_id=2)
    return read(shared.staged(files, folder, "manifest"))
