"""Trie of conversation prefixes: what turns do conversations share, and what would sharing save.

A conversation borrows the first few turns of another one and goes on with its own. Every distinct
sequence of its first d turns is a node; totals over subtrees are wanted for all nodes at once.

*Keys.* A prefix is known by two 64-bit polynomials over hashes of its turns. Turns are dealt out by
ranges of (conversation, turn), so the longest conversation is spread over many tasks; a task sums
inside its range and the state at its end (one small row for each task) is carried into the next.

*Owners.* A node's owner is the smallest conversation through it. A conversation that owns a node
owns all deeper ones on its path, so (owner, depth) names a node and paths need no keys.

*Depth bands.* Depths are cut into bands of a fixed height. A node's weight goes to its ancestors
within its band only. The first nodes of the bands form a tree of their own, less deep by the band's
height, which is rolled up in the same way; its completed totals then go to the ancestors in the
band above. So a node is copied at most ``height`` times for each level, and there are as many
levels as the greatest depth has digits to that base. Weights of one path are summed from below
before they are sent, so a path of a band sends one row for each of its nodes.

Turns are ordered by turn (NULL first); ties go by hashes of role and text, so equal rows stay next
to each other and are turns of their own. NULL roles and texts are empty. Rows without a
conversation id belong to no conversation and are left out. Without conversations there is no node.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm import shared

FAMILY = 20  # conversations that share a base: c - c % FAMILY
HEADS = 4  # crc32(c) % HEADS turns are borrowed
HEIGHT = 32
WORD = r"[^\x20\x09-\x0D]+"
CHUNK = 1 << 20
EMPTY = hashlib.sha256(b"").hexdigest()

_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))  # odd, so they have inverses
_INVERSES = tuple(np.uint64(pow(int(b), -1, 1 << 64)) for b in _BASES)


def _powers(base: np.uint64, exponents: np.ndarray) -> np.ndarray:
    """``base`` to each of the exponents, modulo 2**64, by squaring."""
    out = np.ones(len(exponents), np.uint64)
    left, square = exponents.copy(), base
    with np.errstate(over="ignore"):
        while left.any():
            odd = (left & 1).astype(bool)
            out[odd] *= square
            square = square * square
            left >>= 1
    return out


def turns(conversations: DataFrame, folder: str) -> DataFrame:
    """conv_id, rank from 1, polynomials (s1, s2) of the turns so far, words of the turn; a written table."""
    import pyarrow as pa

    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        F.xxhash64(F.lit(1), role, text).alias("x1"),
        F.xxhash64(F.lit(2), role, text).alias("x2"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
        F.xxhash64(F.monotonically_increasing_id()).alias("tie"),  # parts equal rows only
    )
    order = ["conv_id", "turn", "x1", "x2", "tie"]
    names = ["conv_id", "rank", "s1", "s2", "words", "part"]

    def local(batches) -> Iterator:
        part = TaskContext.get().partitionId()
        last, rank, held = None, 0, [np.uint64(0), np.uint64(0)]
        for batch in batches:
            conv = batch.column("conv_id").to_numpy(zero_copy_only=False)
            n = len(conv)
            if not n:
                continue
            begins = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
            sizes = np.diff(np.concatenate([begins, [n]]))
            goes_on = last is not None and conv[0] == last
            first = np.repeat(begins, sizes)
            ranks = np.arange(n) - first + 1
            if goes_on:
                ranks[: sizes[0]] += rank
            sums = []
            with np.errstate(over="ignore"):
                for k, base in enumerate(_BASES):
                    x = batch.column(f"x{k + 1}").to_numpy(zero_copy_only=False).view(np.uint64)
                    run = np.concatenate([[np.uint64(0)], np.cumsum(x * _powers(base, ranks), dtype=np.uint64)])
                    total = run[1:] - run[first]
                    if goes_on:
                        total[: sizes[0]] += held[k]
                    sums.append(total)
            last, rank, held = conv[-1], int(ranks[-1]), [s[-1] for s in sums]
            columns = [pa.array(c) for c in (conv, ranks, *(s.view(np.int64) for s in sums))]
            yield pa.RecordBatch.from_arrays([*columns, batch.column("words"), pa.array(np.full(n, part, np.int64))], names)

    schema = ", ".join(f"{c} long" for c in names)
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    parts = shared.staged(dealt.mapInArrow(local, schema), folder, "turns")
    carried = _carried(parts)

    def whole(batches) -> Iterator:
        for batch in batches:
            conv, ranks, part = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("conv_id", "rank", "part"))
            sums = [batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("s1", "s2")]
            for p in np.unique(part).tolist():
                if p in carried:
                    owner, base_rank, *bases = carried[p]
                    hit = (part == p) & (conv == owner)
                    ranks = np.where(hit, ranks + base_rank, ranks)
                    with np.errstate(over="ignore"):
                        for k in (0, 1):
                            shift = _powers(_BASES[k], np.array([base_rank]))[0]
                            sums[k] = np.where(hit, sums[k] * shift + np.uint64(bases[k]), sums[k])
            columns = [pa.array(c) for c in (conv, ranks, *(s.view(np.int64) for s in sums))]
            yield pa.RecordBatch.from_arrays([*columns, batch.column("words")], names[:5])

    if not carried:
        return parts.drop("part")
    return shared.staged(parts.mapInArrow(whole, ", ".join(f"{c} long" for c in names[:5])), folder, "ranked")


def _carried(parts: DataFrame) -> dict[int, tuple[int, int, int, int]]:
    """For each task whose first conversation began in an earlier one: its id, rank and sums there.

    One row for each task reaches the driver.
    """
    ends = parts.groupBy("part").agg(F.min("conv_id").alias("first"), F.max(F.struct("conv_id", "rank", "s1", "s2")).alias("last"))
    out: dict[int, tuple[int, int, int, int]] = {}
    state = None
    for row in ends.orderBy("part").collect():
        last = (row["last"].conv_id, row["last"].rank, row["last"].s1 % 2**64, row["last"].s2 % 2**64)
        if state is not None and state[0] == row["first"]:
            out[row.part] = state
            if last[0] == state[0]:
                shifts = [pow(int(b), state[1], 1 << 64) for b in _BASES]
                last = (last[0], last[1] + state[1], *((last[2 + k] * shifts[k] + state[2 + k]) % 2**64 for k in (0, 1)))
        state = last
    return out


def rebuilt(own: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations (conv_id, depth, k1, k2, words, last), and conversations
    (conv_id, depth of the last turn). ``own`` must be a written table."""
    import pyarrow as pa

    at = lambda r, c: F.max(F.when(F.col("rank") == r, F.col(c))).alias(f"{c}_{r}")
    heads = own.groupBy("conv_id").agg(F.max("rank").alias("n"), *(at(r, c) for r in range(1, HEADS) for c in ("s1", "s2", "words")))
    heads = shared.staged(heads, folder, "heads")
    base = heads.select(*(F.col(c).alias(f"b_{c}") for c in heads.columns))
    convs = heads.withColumn("b", F.col("conv_id") - F.col("conv_id") % FAMILY)
    convs = convs.withColumn("h", F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(HEADS)))
    convs = convs.join(base, F.col("b") == F.col("b_conv_id"), "left")
    convs = convs.withColumn("k", F.least("h", F.coalesce("b_n", F.lit(0))))

    def chosen(prefix: str, number: str, column: str) -> Column:
        out = F.lit(0).cast("long")
        for r in range(1, HEADS):
            out = F.when(F.col(number) == r, F.coalesce(f"{prefix}{column}_{r}", F.lit(0))).otherwise(out)
        return out

    depth = F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    heads_of = [F.struct(F.lit(r).cast("long").alias("depth"), *(F.col(f"b_{c}_{r}").alias(c) for c in ("s1", "s2", "words"))) for r in range(1, HEADS)]
    convs = convs.select(
        "conv_id", "h", "k", depth.alias("deepest"),
        *(chosen("", "h", c).alias(f"o{c}") for c in ("s1", "s2")),
        *(chosen("b_", "k", c).alias(f"b{c}") for c in ("s1", "s2")),
        F.slice(F.array(*heads_of), F.lit(1), F.col("k").cast("int")).alias("heads"),
    )
    convs = shared.staged(convs, folder, "conversations")
    borrowed = convs.select("conv_id", "deepest", F.explode("heads").alias("t")).select(
        "conv_id", "t.depth", F.col("t.s1").alias("k1"), F.col("t.s2").alias("k2"), "t.words", (F.col("t.depth") == F.col("deepest")).alias("last")
    )
    names = ["conv_id", "depth", "k1", "k2", "words", "last"]

    def task(batches) -> Iterator:
        for batch in batches:
            get = lambda c: batch.column(c).to_numpy(zero_copy_only=False)  # noqa: B023, E731
            h, k = get("h"), get("k")
            depth, keys = get("rank") - h + k, []
            with np.errstate(over="ignore"):
                for i, c in enumerate(("s1", "s2")):
                    s, o, b = (get(p + c).view(np.uint64) for p in ("", "o", "b"))
                    keys.append(((s - o) * _powers(_INVERSES[i], h - k) + b).view(np.int64))
            columns = [batch.column("conv_id"), *map(pa.array, (depth, *keys)), batch.column("words"), pa.array(depth == get("deepest"))]
            yield pa.RecordBatch.from_arrays(columns, names)

    small = convs.drop("heads")
    rest = own.join(small, "conv_id").where(F.col("rank") > F.col("h"))
    rest = rest.mapInArrow(task, "conv_id long, depth long, k1 long, k2 long, words long, last boolean")
    return shared.staged(rest.unionByName(borrowed), folder, "rebuilt"), convs.select("conv_id", "deepest")


def path_groups(paths: DataFrame, height: int, root: int) -> DataFrame:
    """Owners on the path of each conversation through each band, from the band's first depth to the
    first depth of the next one; only of paths whose end the conversation owns."""
    band = F.floor(F.col("depth") / height)
    ends = (F.col("depth") % height == 0) & (F.col("depth") > 0)
    bands = F.when(ends, F.array(band, band - 1)).otherwise(F.array(band))
    rows = paths.select("conv_id", "depth", "owner", F.explode(bands).alias("band"))
    path = F.transform(F.sort_array(F.collect_list(F.struct("depth", "owner"))), lambda x: x["owner"])
    path = F.when(F.col("band") == 0, F.concat(F.array(F.lit(root).cast("long")), path)).otherwise(path)
    groups = rows.groupBy("conv_id", "band").agg(path.alias("owners"))
    return groups.where(F.element_at("owners", -1) == F.col("conv_id"))


def rollup(paths: DataFrame, groups: DataFrame, weights: DataFrame, deepest: int, height: int, root: int, folder: str, level: int = 0) -> DataFrame:
    """Sums of the weights (saved, leaves) over every subtree: conv_id (owner), depth and the sums.

    ``paths``: conv_id, depth from 1, owner; ``groups``: their bands; ``weights``: conv_id (owner), depth.
    """
    import pyarrow as pa

    sums = ("saved", "leaves")
    listed = F.sort_array(F.collect_list(F.struct("depth", *sums)))
    held = weights.groupBy("conv_id", F.floor(F.col("depth") / height).alias("band")).agg(listed.alias("_w"))
    held = held.select("conv_id", "band", *(F.col(f"_w.{c}").alias(c) for c in sums))
    bands = groups.join(held, ["conv_id", "band"], "left")
    if deepest >= height:
        add = lambda c: F.aggregate(F.coalesce(c, F.array()), F.lit(0).cast("long"), lambda a, x: a + x)
        bands = shared.staged(bands, folder, f"bands-{level}")
        own = bands.where(F.col("band") > 0).groupBy(F.element_at("owners", 1).alias("conv_id"), F.col("band").alias("depth"))
        own = shared.staged(own.agg(*(F.sum(add(F.col(c))).alias(c) for c in sums)), folder, f"roots-{level}")
        above = paths.where(F.col("depth") % height == 0).withColumn("depth", F.floor(F.col("depth") / height))
        above = shared.staged(above, folder, f"paths-{level}")
        above_groups = shared.staged(path_groups(above, height, root), folder, f"groups-{level}")
        done = rollup(above, above_groups, own, deepest // height, height, root, folder, level + 1)
        done = shared.staged(done, folder, f"totals-{level}")
        done = done.select("conv_id", (F.col("depth") - 1).alias("band"), *(F.col(c).alias(f"next_{c}") for c in sums))
        bands = bands.join(done, ["conv_id", "band"], "left")
    else:
        bands = bands.select("*", *(F.lit(0).cast("long").alias(f"next_{c}") for c in sums))
    names = ["conv_id", "depth", *sums]

    def task(batches) -> Iterator:
        for batch in batches:
            owners = batch.column("owners")
            at = owners.offsets.to_numpy().astype(np.int64)
            flat = owners.values.to_numpy(zero_copy_only=False)[at[0] : at[-1]]
            at = at - at[0]
            sizes = np.diff(at)
            inside = np.arange(len(flat)) - np.repeat(at[:-1], sizes)
            band = batch.column("band").to_numpy(zero_copy_only=False)
            further = sizes == height + 1  # the last one is the first node of the next band
            out = [flat, np.repeat(band * height, sizes) + inside]
            for c in sums:
                weight = np.zeros(len(flat), np.int64)
                lists = batch.column(c)
                counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                values = lists.flatten().to_numpy(zero_copy_only=False)
                starts = at[1:] - further - counts  # what a conversation owns is the end of its path
                weight[np.repeat(starts - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(len(values))] = values
                after = batch.column(f"next_{c}").fill_null(0).to_numpy(zero_copy_only=False)
                weight[(at[1:] - 1)[further]] = after[further]
                run = np.concatenate([[0], np.cumsum(weight)])
                out.append(np.repeat(run[at[1:]], sizes) - run[:-1])
            core = ~np.repeat(further, sizes) | (inside < height)
            yield pa.RecordBatch.from_arrays([pa.array(c[core]) for c in out], names)

    sent = bands.mapInArrow(task, ", ".join(f"{c} long" for c in names))
    return sent.groupBy("conv_id", "depth").agg(*(F.sum(c).alias(c) for c in sums))


def end_digests(ends: DataFrame, folder: str) -> DataFrame:
    """SHA-256 of the sorted, comma-joined ids that end at each node: conv_id (owner), depth, digest.

    ``ends``: owner, depth, conv_id; must be a written table. Ids are dealt out by ranges, so that the
    ids of one node are sorted and written as text by many tasks; one task then feeds these pieces,
    of a megabyte at most, to the digest, whose state cannot be split.
    """
    import pyarrow as pa

    order = ["owner", "depth", "conv_id"]
    names = ["owner", "depth", "first", "text"]

    def texts(batches) -> Iterator:
        node, first, held, size = None, 0, [], 0
        out: list[tuple] = []
        for batch in batches:
            for owner, depth, conv in zip(*(batch.column(c).to_pylist() for c in order)):
                if node != (owner, depth) or size >= CHUNK:
                    if held:
                        out.append((*node, first, ",".join(held)))
                    node, first, held, size = (owner, depth), conv, [], 0
                held.append(str(conv))
                size += len(held[-1]) + 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)
                out = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, first, ",".join(held))], names)

    def digests(batches) -> Iterator:
        node, state = None, None
        for batch in batches:
            out: list[tuple] = []
            for owner, depth, text in zip(*(batch.column(c).to_pylist() for c in ("owner", "depth", "text"))):
                if node == (owner, depth):
                    state.update(b",")
                else:
                    if node:
                        out.append((*node, state.hexdigest()))
                    node, state = (owner, depth), hashlib.sha256()
                state.update(text.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["conv_id", "depth", "ends_sha256"])
        if node:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, state.hexdigest())], ["conv_id", "depth", "ends_sha256"])

    dealt = ends.repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = dealt.mapInArrow(texts, "owner long, depth long, first long, text string")
    pieces = shared.staged(pieces, folder, "ends-text")
    pieces = pieces.repartition("owner", "depth").sortWithinPartitions("owner", "depth", "first")
    return pieces.mapInArrow(digests, "conv_id long, depth long, ends_sha256 string")


def trie(conversations: DataFrame, folder: str, height: int = HEIGHT) -> DataFrame:
    """All nodes with their members, children and subtree totals."""
    rows, convs = rebuilt(turns(conversations, folder), folder)
    top = convs.agg(F.min("conv_id").alias("first"), F.count(F.lit(1)).alias("n"), F.max("deepest").alias("deepest")).first()
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    if not top.n:
        return conversations.sparkSession.createDataFrame([], ", ".join(f"{c} {'string' if c == names[-1] else 'long'}" for c in names))
    key = ["depth", "k1", "k2"]
    nodes = rows.groupBy(*key).agg(F.min("conv_id").alias("owner"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"))
    nodes = shared.staged(nodes, folder, "nodes")
    # A prefix that a third of the conversations share is one hot key; both sides are plain scans, so
    # adaptive execution splits it.
    paths = rows.select("conv_id", *key, "last").join(nodes.select(*key, "owner"), key).select("conv_id", "depth", "owner", "last")
    paths = shared.staged(paths, folder, "paths")
    groups = shared.staged(path_groups(paths, height, top["first"]), folder, "groups")
    # Every node but the root is the end of a step on its owner's path.
    steps = F.transform(
        F.slice("owners", 2, height + 1),
        lambda down, i: F.struct(F.get("owners", i).alias("up"), down.alias("down"), (i + 1).alias("at")),
    )
    links = groups.select("conv_id", "band", F.explode(F.filter(steps, lambda x: x["down"] == F.col("conv_id"))).alias("s"))
    links = links.select("conv_id", (F.col("band") * height + F.col("s.at")).alias("depth"), F.col("s.up").alias("parent_conv_id"))
    links = shared.staged(links, folder, "links")
    children = links.groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    children = shared.staged(children, folder, "children")
    nodes = nodes.select(F.col("owner").alias("conv_id"), "depth", "n_convs", ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    nodes = nodes.join(children, ["conv_id", "depth"], "left").fillna(0, ["n_children"])
    nodes = nodes.withColumn("leaves", (F.col("n_children") == 0).cast("long"))
    nodes = shared.staged(nodes, folder, "weighted")
    totals = rollup(paths.drop("last"), groups, nodes.select("conv_id", "depth", "saved", "leaves"), top.deepest, height, top["first"], folder)
    ends = paths.where("last").select("owner", "depth", "conv_id")
    ends = ends.union(convs.where(F.col("deepest") == 0).select(F.lit(top["first"]).cast("long"), F.lit(0).cast("long"), "conv_id"))
    digests = end_digests(shared.staged(ends, folder, "ends"), folder)
    root = F.struct(F.lit(top["first"]).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("depth"))
    root = conversations.sparkSession.range(1).select(root.alias("r")).select("r.*", F.lit(top.n).cast("long").alias("n_convs"))
    root = root.join(children, ["conv_id", "depth"], "left").fillna(0, ["n_children"])
    at = ["conv_id", "depth"]
    all_nodes = nodes.select(*at, "n_convs", "n_children").unionByName(root.select(*at, "n_convs", "n_children"))
    out = all_nodes.join(totals, at, "left").join(links, at, "left").join(digests, at, "left")
    return out.select(
        *at, "parent_conv_id", "n_convs", "n_children",
        F.when(F.col("n_children") == 0, F.lit(1).cast("long")).otherwise(F.col("leaves")).alias("n_leaves"),
        F.coalesce("saved", F.lit(0).cast("long")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
    )


def op11_prefix_trie(spark, sf_dir: str) -> DataFrame:
    """All nodes of the trie of rebuilt conversations."""
    return trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"), shared.workspace(spark, "prefix-trie"))


def _sql() -> str:
    """The same in DuckDB: prefixes as lists of hashes, subtrees by joining nodes with their ancestors."""

    def crc_table() -> list[int]:
        out = []
        for n in range(256):
            for _ in range(8):
                n = n >> 1 ^ (0xEDB88320 if n & 1 else 0)
            out.append(n)
        return out

    return f"""
WITH o AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS r
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, n, xor(4294967295, list_reduce(list_transform(range(1, length(s) + 1), lambda i: ascii(s[i])::BIGINT),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295)) % 4 AS h
  FROM (SELECT conv_id, conv_id::VARCHAR AS s, count(*) AS n FROM o GROUP BY conv_id), (SELECT {crc_table()}::BIGINT[] AS t)
), k AS (
  SELECT c.conv_id, c.h, least(c.h, coalesce(b.n, 0)) AS k FROM c LEFT JOIN c AS b ON b.conv_id = c.conv_id - c.conv_id % 20
), t AS (
  SELECT k.conv_id, o.r AS d, o.role, o.text FROM k JOIN o ON o.conv_id = k.conv_id - k.conv_id % 20 AND o.r <= k.h
  UNION ALL
  SELECT k.conv_id, o.r - k.h + k.k, o.role, o.text FROM k JOIN o ON o.conv_id = k.conv_id AND o.r > k.h
), p AS (
  SELECT conv_id, d, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS w,
    list(md5(length(role) || ':' || role || text)) OVER (PARTITION BY conv_id ORDER BY d) AS path
  FROM t
  UNION ALL
  SELECT conv_id, 0, 0, []::VARCHAR[] FROM k
), q AS (SELECT *, md5(array_to_string(path, ',')) AS id, max(d) OVER (PARTITION BY conv_id) = d AS at_end FROM p
), n AS (
  SELECT id, d, min(conv_id) AS conv_id, count(*) AS n_convs, max(w) AS w, any_value(path) AS path,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (at_end), '') AS ends
  FROM q GROUP BY id, d
), e AS (
  SELECT n.*, u.id AS up, u.conv_id AS up_conv FROM n LEFT JOIN n AS u ON u.d = n.d - 1 AND u.id = md5(array_to_string(n.path[1:n.d - 1], ','))
), f AS (SELECT up, count(*) AS n_children FROM e WHERE up IS NOT NULL GROUP BY up
), x AS (
  SELECT n.id, n.d, unnest(range(0, n.d + 1)) AS a, n.path, (n.n_convs - 1) * n.w AS saved, (f.up IS NULL)::BIGINT AS leaf
  FROM n LEFT JOIN f ON f.up = n.id
), s AS (
  SELECT md5(array_to_string(path[1:a], ',')) AS id, a AS d, sum(saved) AS saved, sum(leaf) AS leaves FROM x GROUP BY 1, 2
)
SELECT e.conv_id, e.d::BIGINT AS depth, e.up_conv AS parent_conv_id, e.n_convs, coalesce(f.n_children, 0) AS n_children,
  s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, sha256(e.ends) AS ends_sha256
FROM e JOIN s USING (id, d) LEFT JOIN f ON f.up = e.id
"""


OP11_SQL = _sql()
