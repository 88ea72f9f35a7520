"""Near-duplicate documents by SetSketch registers.

A document is the set of its runs of five lower-cased words. Register i keeps, of independent
exponential draws of all elements, the smallest one on a scale of powers of ``BASE``, truncated to
16 bits: ``floor(1 - log_BASE(min))``. Sketches merge by the maximum of each register.

1. Equal sets form one class, of which one document goes on (grouped with map-side combine).
2. Registers are cut into bands; classes that agree on a band meet. Each band's classes are tied to
   the one with the smallest id, and the connected components of these ties are clusters: all pairs
   that share any band lie within a cluster.
3. A cluster is cut into blocks of bounded size. A task takes a block, estimates the similarity of
   its pairs by joint maximum likelihood (from the numbers of registers that are larger, smaller and
   equal, and the set sizes), and verifies on the full sets, from the most similar pair on, those
   that are not yet connected. It returns the links of a spanning forest, never pairs.
4. Clusters of one block are done with. Larger ones are cut anew a few times, which connects what is
   alike; at last all members outside a cluster's largest component are compared with all blocks. So
   every pair of a cluster is either connected or has been compared: no link is lost, nothing capped.

With ``BANDS`` bands of ``ROWS`` registers a pair at the threshold of 0.75 misses all bands with
probability 3e-8, and the estimate's cut lies six standard errors below the threshold. Elements are
compared by 64-bit hashes, sets of a class by two sums of them. Step 4 compares members that are
alike but unlinked with all of their cluster; this work, though not what is written or sent, grows
with the number of such members times the size of the cluster.

NULL and empty texts have an empty set and are linked with nothing. Rows with a NULL doc_id take no
part and keep a NULL component. Repeated rows are equal sets. An empty table gives no rows. Further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm import shared
from sparkmart.llm.words import Words, bytes_of, chunks, mix

SHINGLE = 5
BANDS, ROWS = 64, 5
REGISTERS = BANDS * ROWS
BASE, RATE, TOP = 1.001, 20.0, 65534
PERCENT = 75  # 100 * intersection >= PERCENT * union
FLOOR = 0.6  # pairs with smaller estimates are not verified
BLOCK_SETS, BLOCK_ELEMENTS = 400, 1_000_000
TASK_LINKS = 400_000  # that a task contracts
CUTS = 3  # of a cluster into blocks before the last comparison
_rng = np.random.default_rng(4711)
_TIMES = _rng.integers(1, 2**62, REGISTERS // 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _rng.integers(1, 2**63, REGISTERS // 2, dtype=np.uint64)


def registers(elements: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Registers of the sets that begin at ``starts`` (none empty): one row of 16-bit values each.

    Each 64-bit product of an element gives two draws of 32 bits.
    """
    low = np.full((len(starts), REGISTERS), 2**32 - 1, np.uint32)
    ends = np.append(starts[1:], len(elements))
    for row, (a, b) in enumerate(zip(starts.tolist(), ends.tolist())):
        for at in range(a, b, 256):
            draws = elements[at : min(b, at + 256), None] * _TIMES
            draws += _PLUS
            np.minimum(low[row], draws.view(np.uint32).min(axis=0), out=low[row])
    smallest = -np.log1p(-(low + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(smallest) / np.log(BASE)), 0, TOP + 1).astype("<u2")


def merge(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Sketch of the union."""
    return np.maximum(one, other)


def joint_estimate(larger: np.ndarray, smaller: np.ndarray, n1: np.ndarray, n2: np.ndarray, steps: int = 100) -> np.ndarray:
    """Maximum-likelihood similarity from the numbers of registers in which the first sketch is
    larger or smaller than the second, and the set sizes."""
    larger, smaller = (np.asarray(x, float)[:, None] for x in (larger, smaller))
    equal = REGISTERS - larger - smaller
    u = (np.asarray(n1, float) / (np.asarray(n1, float) + np.asarray(n2, float)))[:, None]
    v = 1 - u
    most = np.minimum(u / v, v / u)
    j = most * np.linspace(0, 1, steps + 1)[None, :]

    def p(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    a, b = p(u - v * j), p(v - u * j)
    tiny = 1e-12
    score = larger * np.log(np.maximum(a, tiny)) + smaller * np.log(np.maximum(b, tiny)) + equal * np.log(np.maximum(1 - a - b, tiny))
    return j[np.arange(len(j)), score.argmax(axis=1)]


def _sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct elements of each text, and the bounds of the texts in them."""
    words = Words(data, offsets)
    runs, at = words.shingles(words.hashes(), SHINGLE)
    parts = [np.unique(runs[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64)
    return (np.concatenate(parts) if parts else runs), bounds


def sketches(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_shingles, two sums that stand for the set, and the registers."""
    names = ["doc_id", "n_shingles", "s1", "s2", "sketch"]

    def task(batches) -> Iterator:
        for batch in batches:
            data, offsets = bytes_of(batch.column("text"))
            size, one, two, sketch = [], [], [], []
            for i, j in chunks(offsets):
                elements, at = _sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                n = np.diff(at)
                sums = np.zeros((2, j - i), np.uint64)
                full = np.flatnonzero(n)
                rows: list[bytes | None] = [None] * (j - i)
                if len(full):
                    starts = at[:-1][full]
                    sums[0, full] = np.add.reduceat(elements, starts)
                    sums[1, full] = np.add.reduceat(mix(elements ^ np.uint64(0x5DEECE66D)), starts)
                    made = registers(elements, starts)
                    for k, row in enumerate(full.tolist()):
                        rows[row] = made[k].tobytes()
                size.append(n)
                one.append(sums[0].view(np.int64))
                two.append(sums[1].view(np.int64))
                sketch += rows
            join = lambda x: pa.array(np.concatenate([np.zeros(0, np.int64), *x]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), join(size), join(one), join(two), pa.array(sketch, pa.binary())], names
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(task, "doc_id long, n_shingles long, s1 long, s2 long, sketch binary")


def full_sets(docs: DataFrame) -> DataFrame:
    """Per row: doc_id as ``cls`` and its elements."""
    def task(batches) -> Iterator:
        for batch in batches:
            data, offsets = bytes_of(batch.column("text"))
            for i, j in chunks(offsets):
                elements, at = _sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                items = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(elements.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column("cls").slice(i, j - i), items], ["cls", "items"])

    return docs.mapInArrow(task, "cls long, items array<long>")


def likely_pairs(sketch: np.ndarray, n: np.ndarray, ones: np.ndarray, others: np.ndarray) -> list[tuple[int, int]]:
    """Pairs (one, other) whose estimate reaches ``FLOOR``, from the most similar on."""
    found, scores = [], []
    for i in ones.tolist():
        rest = others[others != i]
        rest = rest[100 * np.minimum(n[rest], n[i]) >= PERCENT * np.maximum(n[rest], n[i])]  # no more alike
        if not len(rest):
            continue
        larger = (sketch[i] > sketch[rest]).sum(axis=1)
        smaller = (sketch[i] < sketch[rest]).sum(axis=1)
        # Registers are equal at least as often as the sets are similar; saves most estimates.
        near = REGISTERS - larger - smaller >= REGISTERS * (FLOOR - 0.1)
        rest, larger, smaller = rest[near], larger[near], smaller[near]
        if len(rest):
            j = joint_estimate(larger, smaller, np.full(len(rest), n[i]), n[rest])
            keep = j >= FLOOR
            found.append(np.stack([np.full(keep.sum(), i), rest[keep]], 1))
            scores.append(j[keep])
    if not found:
        return []
    pairs, score = np.concatenate(found), np.concatenate(scores)
    return [tuple(p) for p in pairs[np.argsort(-score, kind="stable")].tolist()]


def verified_links(sets: list[np.ndarray], labels: list[int], pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Pairs at or above the threshold on the full sets that connect different labels; a spanning
    forest, as pairs that are connected already are passed over."""
    parent = {x: x for x in labels}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links = []
    for a, b in pairs:
        x, y = root(labels[a]), root(labels[b])
        if x == y:
            continue
        one, other = (sets[a], sets[b]) if len(sets[a]) <= len(sets[b]) else (sets[b], sets[a])
        at = np.minimum(np.searchsorted(other, one), len(other) - 1)
        both = int((other[at] == one).sum())
        if 100 * both >= PERCENT * (len(one) + len(other) - both):
            parent[max(x, y)] = min(x, y)
            links.append((a, b))
    return links


def block_links(table: pa.Table) -> pa.Table:
    """Links within a block of rows (cls, label, sketch, items). Rows with ``side`` 0 and 1 are
    compared across sides only, rows without a side with all others."""
    table = table.combine_chunks()
    column = lambda c: table.column(c).combine_chunks()
    cls, labels = column("cls").to_numpy(), column("label").to_numpy().tolist()
    sketch = np.frombuffer(b"".join(column("sketch").to_pylist()), "<u2").reshape(-1, REGISTERS)
    items = column("items")
    values = items.flatten().to_numpy().view(np.uint64)
    ends = np.cumsum(items.value_lengths().to_numpy())
    sets = np.split(values, ends[:-1])
    n = np.array([len(x) for x in sets])
    side = column("side").to_numpy()
    ones, others = np.flatnonzero(side <= 0), np.flatnonzero(side != 0)
    links = verified_links(sets, labels, likely_pairs(sketch, n, ones, others))
    return pa.table({"a": pa.array([cls[a] for a, _ in links], pa.int64()), "b": pa.array([cls[b] for _, b in links], pa.int64())})


def _contracted(edges: DataFrame) -> DataFrame:
    """The same components from fewer and shorter edges (u, v): every task, of about ``TASK_LINKS``
    edges, ties each of their nodes to the smallest one it is connected with there."""

    def task(batches) -> Iterator:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        def ties():
            nodes = [x for x in parent if root(x) != x]
            columns = [pa.array(nodes, pa.int64()), pa.array([root(x) for x in nodes], pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["u", "v"])

        for batch in batches:
            for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
                x, y = root(u), root(v)
                if x != y:
                    parent[max(x, y)] = min(x, y)
        yield ties()

    return edges.mapInArrow(task, "u long, v long")


def components(links: DataFrame, folder: str, name: str) -> DataFrame:
    """Smallest node of each component, for every node of a link (a, b): node, label.

    Tasks of bounded size contract the links they read; where that takes several tasks, a step joins
    larger neighbours to the smallest one (large star) and smaller ones (small star), and so on in
    turn, on written tables, until every node has one neighbour, the smallest of its component.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v")
    edges = shared.staged(edges, folder, f"{name}-0")
    step = 0
    while True:
        step += 1
        tasks = max(1, -(-edges.count() // TASK_LINKS))
        edges = shared.staged(_contracted(edges.coalesce(tasks)), folder, f"{name}-tied-{step}")
        if tasks == 1:  # the task has seen all of them
            break
        roots = edges.select(F.col("v").alias("u")).distinct()
        unsettled = edges.groupBy("u").agg(F.count("v").alias("n")).where("n > 1").select("u")
        if unsettled.unionByName(edges.select("u").join(roots, "u", "left_semi")).isEmpty():
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = shared.staged(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), folder, f"{name}-low-{step}")
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = shared.staged(large, folder, f"{name}-large-{step}")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        pairs = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        edges = shared.staged(pairs.where("u <> v").distinct(), folder, f"{name}-{step}")
    labels = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return labels.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


def _block_count(n: str, elements: str):
    return F.greatest(F.ceil(F.col(n) / BLOCK_SETS), F.ceil(F.col(elements) / BLOCK_ELEMENTS)).cast("int")


def _links(members: DataFrame, folder: str) -> DataFrame:
    """Links (a, b) of members (cls, cluster, n_shingles, sketch, items) that connect as all links do."""
    sizes = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("elements"))
    sizes = sizes.select("cluster", _block_count("n", "elements").alias("blocks"))
    sizes = shared.staged(sizes, folder, "sizes")

    def solve(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
        columns = rows.select(*keys, "cls", "label", "side", "sketch", "items")
        return shared.staged(columns.groupBy(*keys).applyInArrow(lambda t: block_links(t), "a long, b long"), folder, name)

    def block(step: int, count: str = "blocks"):
        return F.pmod(F.xxhash64(F.lit(step), "cls"), F.col(count)).cast("int")

    def labelled(rows: DataFrame, links: DataFrame, name: str) -> DataFrame:
        labels = shared.staged(components(links, folder, f"{name}-steps"), folder, name)
        joined = rows.join(labels, rows["cls"] == labels["node"], "left").drop("node")
        return joined.withColumn("label", F.coalesce("label", "cls"))

    alone = F.lit(-1).alias("side")
    rows = members.join(sizes, "cluster").withColumns({"label": F.col("cls"), "block": block(0)})
    links = solve(rows.select("*", alone), ["cluster", "block"], "links-0")
    large = members.join(sizes.where("blocks > 1"), "cluster")
    if large.isEmpty():
        return links
    large = shared.staged(large, folder, "large")
    for step in range(1, CUTS):
        now = labelled(large, links, f"labels-{step}").withColumn("block", block(step))
        more = solve(now.select("*", alone), ["cluster", "block"], f"links-{step}")
        links = links.unionByName(more)
        if more.isEmpty():
            break
    # Whoever stands outside the largest component of a cluster meets every block of it.
    now = shared.staged(labelled(large, links, "labels-last"), folder, "now")
    parts = now.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("elements"))
    total = parts.groupBy("cluster").agg(
        F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("n"), F.sum("elements").alias("elements")
    )
    total = total.where(F.col("n") > F.col("top.n")).select("cluster", F.col("top.label").alias("top"))
    outside = parts.join(total, "cluster").where("label <> top").groupBy("cluster", "top")
    outside = outside.agg(F.sum("n").alias("n"), F.sum("elements").alias("elements"))
    outside = shared.staged(outside.select("cluster", "top", _block_count("n", "elements").alias("others")), folder, "outside")
    last = now.join(outside, "cluster")
    each = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    one = last.where("label <> top").select("*", block(8, "others").alias("i"), each("blocks").alias("j"), F.lit(0).alias("side"))
    other = last.select("*", each("others").alias("i"), block(9).alias("j"), F.lit(1).alias("side"))
    return links.unionByName(solve(one.unionByName(other), ["cluster", "i", "j"], "links-last"))


def near_duplicates(docs: DataFrame, folder: str) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id and kept."""
    made = shared.staged(sketches(docs), folder, "sketches")
    filled = made.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = filled.groupBy("s1", "s2").agg(F.min("doc_id").alias("cls"))
    classes = shared.staged(classes, folder, "classes")
    # A doc_id repeated with different texts may stand for two classes; the smaller set sum is taken.
    reps = filled.join(classes.select("cls", F.col("s1").alias("c1"), F.col("s2").alias("c2")), filled["doc_id"] == F.col("cls"))
    reps = reps.where("s1 = c1 AND s2 = c2").select("cls", "n_shingles", "sketch").dropDuplicates(["cls"])
    reps = shared.staged(reps, folder, "representatives")

    band = lambda i: F.xxhash64(i, F.substring(F.col("sketch"), i * 2 * ROWS + 1, F.lit(2 * ROWS)))
    keys = reps.select("cls", F.explode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), band)).alias("key"))
    centers = keys.groupBy("key").agg(F.min("cls").alias("center"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # Written before it is joined, so that Spark can split a hot key on the other side.
    centers = shared.staged(centers.select("key", "center"), folder, "centers")
    ties = keys.join(centers, "key").where("cls <> center").select(F.col("center").alias("a"), F.col("cls").alias("b")).distinct()
    clusters = shared.staged(components(ties, folder, "clusters-steps"), folder, "clusters")
    clusters = clusters.select(F.col("node").alias("cls"), F.col("label").alias("cluster"))
    texts = docs.select(F.col("doc_id").cast("long").alias("cls"), F.col("text").cast("string").alias("text"))
    sets = full_sets(texts.join(clusters, "cls", "left_semi"))
    members = clusters.join(reps, "cls").join(sets, "cls").dropDuplicates(["cls"])
    shared.release(docs.sparkSession)
    links = _links(shared.staged(members, folder, "members"), folder)
    labels = shared.staged(components(links, folder, "labels-steps"), folder, "labels")

    named = classes.join(labels, classes["cls"] == labels["node"], "left")
    named = named.select("s1", "s2", F.coalesce("label", "cls").alias("label"))
    joined = made.select("doc_id", "n_shingles", "s1", "s2").join(named, ["s1", "s2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("label", "doc_id")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return joined.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def op4_setsketch(spark, sf_dir: str) -> DataFrame:
    """Component of near-duplicates of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs, shared.workspace(spark, "setsketch"))
