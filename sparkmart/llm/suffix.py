"""Repeated passages by suffix arrays: every byte covered by a string of ``LENGTH`` bytes that also
starts anywhere else, in the same text or another, is removed.

A suffix array of the whole corpus cannot be held by one task, so the strings to be sorted are dealt
out first, such that equal strings meet:

1. Every string of 200 bytes is filed under its anchor, the run of ``GRAM`` bytes in it with the
   smallest hash (the leftmost of equal ones). Neighbouring strings share an anchor, so a text falls
   into stretches of about 85 strings each. An anchor that occurs once in the corpus files strings
   that occur once; its stretches are done with.
2. Equal stretches of the other anchors are counted (with map-side combine) and go on as one unit.
3. Units are dealt out by anchor; a task takes whole anchors, up to ``TASK_BYTES`` at a time, and
   builds a suffix array in two stages: suffixes smaller than their successors are sorted directly,
   the others are induced by a scan over the buckets of first bytes. Adjacent suffixes are then
   compared; strings with a common prefix of 200 bytes or more, counted with the units' numbers of
   copies, are repeated.
4. Repeated strings are brought back to the stretches of all documents.

An anchor with more than ``HOT_UNITS`` units (a passage that very many documents share, each with
other neighbours) would be too much for a task. Its strings become units of their own, dealt out by
a 128-bit hash of all their bytes and counted before the shuffle; such a unit is one string, and is
repeated if it has two copies. Nothing is dropped, capped or sampled.

Texts are taken as UTF-8; NULL is empty. A row stands for itself even where doc_id and text repeat:
its copies make all its strings repeated. NULL doc_ids are kept. Texts shorter than 200 bytes lose
nothing. An empty table gives no rows. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm import shared
from sparkmart.llm.words import _VALUE, bytes_of, chunks, mix, powers

LENGTH = 200
GRAM = 32
TASK_BYTES = 2 << 20
HOT_UNITS = 24_000  # about 7 MB of strings


def gram_hashes(data: np.ndarray, size: int = GRAM) -> np.ndarray:
    """Hash of the ``size`` bytes from each position on."""
    n = len(data) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, _ = powers(len(data))
    value = _VALUE[data]
    value *= up
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(value, out=sums[1:])
    _, down = powers(len(data) + 1)
    return mix((sums[size:] - sums[:n]) * down[:n])


def stretches(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Anchor hash, first string and number of strings of each stretch of the texts."""
    grams = gram_hashes(data, gram)
    if len(data) < length:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    # The upper half of the hash, then the position: the minimum is the leftmost smallest one.
    low = (grams >> np.uint64(32) << np.uint64(32)) | np.arange(len(grams), dtype=np.uint64)
    width, reach = length - gram + 1, 1
    while reach < width:
        step = min(reach, width - reach)
        low = np.minimum(low[:-step], low[step:])
        reach += step
    anchor = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)  # of the string that starts here
    inside = np.zeros(len(anchor) + 1, np.int32)
    long = np.flatnonzero(np.diff(offsets) >= length)
    inside[offsets[long]] += 1
    np.subtract.at(inside, offsets[long + 1] - length + 1, 1)
    starts = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = anchor[starts]
    new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)]))
    return grams[at[new]], starts[new], np.diff(np.append(new, len(starts)))


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number; zeros stand behind the end."""
    out = np.zeros(len(text), np.uint64)
    padded = np.concatenate([text, np.zeros(8, text.dtype)])
    for k in range(8):
        out <<= np.uint64(8)
        out |= padded[k : k + len(text)]
    return out


def _sort_directly(which: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Positions ``which`` in order of their first ``depth`` bytes, eight at a time.

    Groups that agree in the next eight bytes stay as they are; only the others are sorted on.
    """
    at = lambda p: words[np.minimum(p, len(words) - 1)] * (p < len(words))
    order = which[np.argsort(words[which], kind="stable")]
    first = words[order]
    same = first[1:] == first[:-1]  # with the one before
    live = np.flatnonzero(np.concatenate([same, [False]]) | np.concatenate([[False], same]))
    joined = np.concatenate([[False], same])
    for k in range(8, depth, 8):
        if not len(live):
            break
        key = at(order[live] + k)
        tied = joined[live]
        group = np.cumsum(~tied)
        changed = np.zeros(len(live), bool)
        changed[1:] = tied[1:] & (key[1:] != key[:-1])
        if changed.any():
            hit = np.isin(group, group[changed]) if changed.sum() < 64 else np.bincount(group, changed, minlength=group[-1] + 1)[group] > 0
            some = np.flatnonzero(hit)
            by = np.lexsort((key[some], group[some]))
            order[live[some]] = order[live[some]][by]
            key[some] = key[some][by]
        joined[live[1:]] = tied[1:] & (key[1:] == key[:-1])
        now = joined[live]
        live = live[now | np.concatenate([now[1:], [False]])]
    return order


def suffix_order(text: np.ndarray, needed: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """The needed positions in order of the ``depth`` bytes from each on.

    ``text`` ends every unit with a zero and has none elsewhere. With a position that is larger than
    its successor, the successor must be needed too.
    """
    n = len(text)
    changes = np.flatnonzero(text[1:] != text[:-1])
    following = np.append(text[changes + 1], 0)  # the first byte that differs, by run
    runs = np.diff(np.concatenate([[0], changes + 1, [n]]))
    smaller = np.repeat(following, runs) > text  # smaller than the successor
    smaller[-1] = True
    direct = np.flatnonzero(smaller & needed)
    direct = _sort_directly(direct, _words(text), depth)
    induce = needed & ~smaller
    heads = text[direct]
    edges = np.searchsorted(heads, np.arange(258))
    pending: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []
    for c in range(256):
        placed = []
        level = np.concatenate(pending[c]) if pending[c] else np.zeros(0, np.int64)
        while len(level):
            placed.append(level)
            before = level[level > 0] - 1
            level = before[induce[before] & (text[before] == c)]
        placed.append(direct[edges[c] : edges[c + 1]])
        bucket = np.concatenate(placed)
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[induce[before] & (text[before] > c)]
        if len(before):
            byte = text[before]
            by = np.argsort(byte, kind="stable")
            cuts = np.flatnonzero(np.diff(byte[by])) + 1
            for part in np.split(before[by], cuts):
                pending[text[part[0]]].append(part)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def common_prefix(text: np.ndarray, order: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Common prefix of each position in ``order`` with the one before it, up to ``depth`` bytes."""
    out = np.zeros(len(order), np.int64)
    words = _words(text)
    live = np.arange(1, len(order))
    for k in range(0, depth, 8):
        a, b = order[live - 1] + k, order[live] + k
        inside = (a < len(text)) & (b < len(text))
        live, a, b = live[inside], a[inside], b[inside]
        differ = words[a] ^ words[b]
        same = differ == 0
        rest = differ[~same]
        out[live[~same]] = k + (7 - np.floor(np.log2(rest.astype(np.float64))).astype(np.int64) // 8).clip(0, 7) if len(rest) else 0
        live = live[same]
        out[live] = k + 8
    return np.minimum(out, depth)


def repeated_strings(units: list[bytes], counts: np.ndarray, copies: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """For each unit, which of its first ``counts`` strings start anywhere else among all units,
    each of which stands for ``copies`` equal ones."""
    sizes = np.array([len(u) + 1 for u in units])
    at = np.concatenate([[0], np.cumsum(sizes)])
    text = np.frombuffer(b"\xff".join(units) + b"\xff", np.uint8) + np.uint8(1)  # UTF-8 has no 0xFF
    first = np.zeros(len(text) + 1, np.int32)
    np.add.at(first, at[:-1], 1)
    np.subtract.at(first, at[:-1] + counts, 1)
    strings = np.cumsum(first[:-1]) > 0
    # Those after a unit's last string down to the next suffix that is sorted directly are needed.
    needed = strings.copy()
    edge = at[:-1] + counts - 1
    falling = np.ones(len(edge), bool)
    while falling.any():
        here = edge[falling]
        falls = text[here] >= text[np.minimum(here + 1, len(text) - 1)]
        falls &= text[here] > 0
        edge[falling] = here + falls
        needed[edge[falling]] = True
        falling[np.flatnonzero(falling)[~falls]] = False
    order = suffix_order(text, needed, length)
    order = order[strings[order]]
    same = common_prefix(text, order, length) >= length
    begins = np.flatnonzero(~same)
    owner = np.searchsorted(at, order, side="right") - 1
    total = np.add.reduceat(copies[owner], begins) if len(begins) else np.zeros(0, np.int64)
    hit = np.zeros(len(text), bool)
    hit[order] = np.repeat(total, np.diff(np.append(begins, len(order)))) > 1
    return [hit[a : a + n] for a, n in zip(at[:-1].tolist(), counts.tolist())]


def runs_of(flags: np.ndarray) -> list[int]:
    """First positions and lengths of the runs of True, in turn."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return np.stack([edges[::2], edges[1::2] - edges[::2]], 1).ravel().tolist()


def _keyed(docs: DataFrame, *more: str) -> DataFrame:
    """Rows with ``rid``, a hash of doc_id and text that stands for the row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rid = F.xxhash64(F.col("doc_id").cast("string"), text)
    return docs.select(rid.alias("rid"), text.alias("text"), *(F.col(c).cast("long").alias(c) for c in more))


def members(docs: DataFrame) -> DataFrame:
    """Stretches of all rows: anchor ``h``, hash ``seg`` of the bytes, rid, and ``place``, which is
    256 times the first string plus the number of strings."""
    import pyarrow as pa

    def task(batches) -> Iterator:
        from xxhash import xxh3_64_intdigest

        names = ["h", "seg", "rid", "place"]
        for batch in batches:
            data, offsets = bytes_of(batch.column("text"))
            rids = batch.column("rid").to_numpy()
            for i, j in chunks(offsets):
                part, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                h, start, n = stretches(part, at)
                view = memoryview(part)
                spans = zip(start.tolist(), (start + n + LENGTH - 1).tolist())
                seg = np.array([xxh3_64_intdigest(view[a:b]) for a, b in spans], np.uint64)
                row = np.searchsorted(at, start, side="right") - 1
                place = (start - at[row]) * 256 + n
                columns = [h.view(np.int64), seg.view(np.int64), rids[i + row], place]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names)

    return _keyed(docs).mapInArrow(task, "h long, seg long, rid long, place long")


def _lists(column) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Bounds and fields of an Arrow list of structs."""
    lists = column
    flat = lists.flatten()
    sizes = np.array(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), np.int64)
    fields = {f.name: flat.field(k) for k, f in enumerate(flat.type)}
    return np.concatenate([[0], np.cumsum(sizes)]), fields


def unit_bytes(docs: DataFrame, units: DataFrame) -> DataFrame:
    """Units (h, seg, copies, rid, place) with their bytes, cut from the row that stands for each."""
    import pyarrow as pa

    def task(batches) -> Iterator:
        for batch in batches:
            data, offsets = bytes_of(batch.column("text"))
            view = memoryview(data)
            at, fields = _lists(batch.column("units"))
            place = fields["place"].to_numpy()
            start = place // 256 + np.repeat(offsets[:-1], np.diff(at))
            n = place % 256
            body = [view[a:b].tobytes() for a, b in zip(start.tolist(), (start + n + LENGTH - 1).tolist())]
            columns = [fields["h"], fields["seg"], fields["copies"], pa.array(n, pa.int64()), pa.array(body, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["h", "seg", "copies", "n", "body"])

    lists = units.groupBy("rid").agg(F.collect_list(F.struct("h", "seg", "copies", "place")).alias("units"))
    rows = _keyed(docs).join(lists, "rid").select("text", "units")
    return rows.mapInArrow(task, "h long, seg long, copies long, n long, body binary")


def repeated_units(bodies: DataFrame) -> DataFrame:
    """Units with repeated strings: h, seg and the runs of such strings (first, length in turn)."""
    import pyarrow as pa

    schema = pa.schema([("h", pa.int64()), ("seg", pa.int64()), ("runs", pa.list_(pa.int32()))])

    def solve(held: list[tuple]):
        h, seg, copies, n, body = (list(x) for x in zip(*held))
        flags = repeated_strings(body, np.array(n), np.array(copies))
        runs = [runs_of(f) for f in flags]
        kept = [i for i, r in enumerate(runs) if r]
        columns = [[x[i] for i in kept] for x in (h, seg, runs)]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def task(batches) -> Iterator:
        held: list[tuple] = []  # whole anchors, and the last one as far as it has come
        size, begin = 0, 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("h", "seg", "copies", "n", "body"))):
                if held and row[:2] == held[-1][:2]:
                    continue  # a repeated row brings its units again
                if held and row[0] != held[-1][0]:
                    if size >= TASK_BYTES:
                        yield solve(held)
                        held, size = [], 0
                held.append(row)
                size += len(row[4])
        if held:
            yield solve(held)

    dealt = bodies.repartition("h").sortWithinPartitions("h", "seg")
    return dealt.mapInArrow(task, "h long, seg long, runs array<int>")


def hot_strings(docs: DataFrame, hot: DataFrame) -> DataFrame:
    """The single strings of stretches (rid, place): a 128-bit hash, rid and place."""
    import pyarrow as pa

    def task(batches) -> Iterator:
        from xxhash import xxh3_128_digest

        for batch in batches:
            data, offsets = bytes_of(batch.column("text"))
            view = memoryview(data)
            rids = batch.column("rid").to_pylist()
            at, fields = _lists(batch.column("units"))
            place = fields["place"].to_numpy()
            for row, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
                base = int(offsets[row])
                found = [(s, rids[row]) for p in place[a:b].tolist() for s in range(p // 256, p // 256 + p % 256)]
                digests = [xxh3_128_digest(view[base + s : base + s + LENGTH]) for s, _ in found]
                columns = [pa.array(digests, pa.binary()), pa.array([r for _, r in found], pa.int64()),
                           pa.array([256 * s + 1 for s, _ in found], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["string", "rid", "place"])

    lists = hot.groupBy("rid").agg(F.collect_list(F.struct("place")).alias("units"))
    return _keyed(docs).join(lists, "rid").select("text", "rid", "units").mapInArrow(task, "string binary, rid long, place long")


def repeated_runs(docs: DataFrame, folder: str, hot_units: int = HOT_UNITS) -> DataFrame:
    """Repeated strings of all rows: rid, place of a stretch, and the runs in it."""
    spark = docs.sparkSession
    every = shared.staged(members(docs), folder, "members")
    shared_anchors = every.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    # Written before it is joined, so that Spark can split a hot anchor on the other side.
    shared_anchors = shared.staged(shared_anchors, folder, "anchors")
    found = shared.staged(every.join(shared_anchors, "h", "left_semi"), folder, "shared")
    shared.drop(folder, "members", "anchors")
    shared.release(spark)
    units = found.groupBy("h", "seg").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("rid", "place")).alias("first"))
    units = shared.staged(units.select("h", "seg", "copies", "first.rid", "first.place"), folder, "units")
    hot = units.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_units).select("h")
    hot = shared.staged(hot, folder, "hot")
    none_hot = hot.isEmpty()
    cold = units if none_hot else units.join(hot, "h", "left_anti")
    runs = shared.staged(repeated_units(unit_bytes(docs, cold)), folder, "runs")
    shared.drop(folder, "units")
    shared.release(spark)
    spans = found.join(runs, ["h", "seg"]).select("rid", "place", "runs")
    if none_hot:
        return spans
    strings = shared.staged(hot_strings(docs, found.join(hot, "h", "left_semi")), folder, "strings")
    often = strings.groupBy("string").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("string")
    single = strings.join(often, "string", "left_semi")
    return spans.unionByName(single.select("rid", "place", F.array(F.lit(0), F.lit(1)).alias("runs")))


def without_repeats(docs: DataFrame, folder: str, with_bytes: bool = False) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256; with
    ``with_bytes`` also the remaining bytes, which may end or begin inside a character."""
    import pyarrow as pa

    def task(batches) -> Iterator:
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_bytes
        for batch in batches:
            data, offsets = bytes_of(batch.column("text"))
            at, fields = _lists(batch.column("spans"))
            place = fields["place"].to_numpy() if len(fields["place"]) else np.zeros(0, np.int64)
            runs = fields["runs"].to_pylist()
            removed, spans, digests, kept = [], [], [], []
            for row in range(batch.num_rows):
                text = data[offsets[row] : offsets[row + 1]]
                cover = np.zeros(len(text) + 1, np.int32)
                for k in range(at[row], at[row + 1]):
                    first = int(place[k]) // 256
                    for a, n in zip(runs[k][::2], runs[k][1::2]):
                        cover[first + a] += 1
                        cover[first + a + n - 1 + LENGTH] -= 1
                gone = np.cumsum(cover[:-1]) > 0
                rest = text[~gone].tobytes()
                removed.append(len(text) - len(rest))
                spans.append(int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1)))
                digests.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest)
            columns = [batch.column("doc_id"), pa.array(np.diff(offsets), pa.int64()), pa.array(removed, pa.int64()),
                       pa.array(spans, pa.int64()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(kept, pa.binary())] * with_bytes, names)

    # Equal rows have equal stretches; a set holds them once.
    lists = repeated_runs(docs, folder).groupBy("rid").agg(F.collect_set(F.struct("place", "runs")).alias("spans"))
    rows = _keyed(docs, "doc_id").join(lists, "rid", "left").select("doc_id", "text", "spans")
    declared = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return rows.mapInArrow(task, declared + ", kept binary" * with_bytes)


def op5_suffix_array(spark, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated strings of 200 bytes."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return without_repeats(docs, shared.workspace(spark, "suffix"))
