"""Source divergence audit: how far is the wording of a source from the others of its language?

Terms are runs of letters, A-Z lower-cased, and of characters beyond ASCII; a language keeps those in
at least ``LEAST_DOCS`` of its documents. Groups (language, source) and languages give each kept term
the smoothed weight p = 1 + floor(SCALE * (count + 1) / (N + V)). The divergence of p from q is the sum
of floor((p - q)^2 / q), all in integers.

*Counting.* Tasks count terms and the documents that have them for each group, with a bounded table,
and send the sums; one shuffle by (language, term) gives counts in groups and in the language.

*Terms of a group: dominance skyband.* Among terms with p > q the value rises with the count in the
group and falls with that in the language, and ties go to the earlier term. So a term that k others
beat or equal in all three (higher or equal group count, lower or equal language count, earlier in
UTF-8) is not among the first k. Each task keeps, for each group, the terms that fewer than k others
of its own rows dominate; what is left is dealt out by group and merged the same way (large groups in
parts); the rest is ranked by exact values.

*Pairs of sources.* Most terms occur in few sources, so a pair's sum is taken apart: what neither
has is one product, what one of them has depends on its count alone and is summed over a histogram
of counts, and terms in both correct for that. The last part is summed inside blocks of terms and tiles of
sources, so that a task sends one number for each pair of sources, not for each term.

NULL text, language and source are empty strings. Repeated rows are documents of their own; a group
without terms has pairs; a language with one source has none; an empty table gives no rows. Columns
other than those three are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm import shared

SCALE = 1_000_000_000
LEAST_DOCS = 3
TOP = 200
TABLE = 300_000  # distinct (group, term) that a task counts before it sends them
PIECE = 1 << 20  # bytes of a long text that are split at once
BUFFER = 40_000  # rows of a group that a task holds before it thins them out
MERGED = 200_000  # rows of a group that one task merges
TILE = 256  # sources in a tile
BLOCK_ROWS = 100_000
SALTS = 16

_TERMS = bytearray(b" " * 256)
for _b in range(256):
    if 97 <= _b <= 122 or _b >= 128:
        _TERMS[_b] = _b
    elif 65 <= _b <= 90:
        _TERMS[_b] = _b + 32
_TERMS = bytes(_TERMS)


def _pieces(raw: bytes) -> Iterator[bytes]:
    """Parts of a text in which blanks part the terms, cut at blanks."""
    at = 0
    while len(raw) - at > PIECE:
        end = raw.find(b" ", at + PIECE)
        if end < 0:
            break
        yield raw[at:end]
        at = end
    yield raw[at:] if at else raw


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs: partial sums, to be added up."""
    import pyarrow as pa

    names = ["lang", "source", "term", "n", "docs"]

    def flush(table: dict) -> Iterator:
        for (lang, source), (count, seen) in table.items():
            if count:
                terms = list(count)
                rows = len(terms)
                columns = [pa.array([lang] * rows), pa.array([source] * rows), pa.array(terms, pa.binary()).cast(pa.string())]
                columns += [pa.array(list(count.values()), pa.int64()), pa.array([seen[t] for t in terms], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names)

    def task(batches) -> Iterator:
        table: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for batch in batches:
            for lang, source, text in zip(*(batch.column(c) for c in ("lang", "source", "text"))):
                key = (lang.as_py(), source.as_py())
                if key not in table:
                    table[key] = (Counter(), Counter())
                count, seen = table[key]
                before = len(count)
                raw = (text.as_py() or "").encode().translate(_TERMS)
                words: set[bytes] = set()
                for piece in _pieces(raw):
                    found = piece.split()
                    count.update(found)
                    words.update(found)
                seen.update(words)
                size += len(count) - before
                if size > TABLE:
                    yield from flush(table)
                    table, size = {}, 0
        yield from flush(table)

    return _texts(docs).mapInArrow(task, "lang string, source string, term string, n long, docs long")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))


def kept_terms(docs: DataFrame, folder: str) -> DataFrame:
    """lang, source, term, n, n_lang of kept terms; ``once`` marks one row of each (lang, term). Written."""
    # Rows of a term in a language: one for each source that has it.
    term = Window.partitionBy("lang", "term")
    sums = term_counts(docs).repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    wide = sums.select(
        "lang", "source", "term", "n",
        F.sum("n").over(term).alias("n_lang"), F.sum("docs").over(term).alias("in_docs"),
        (F.min("source").over(term) == F.col("source")).alias("once"),
    )
    return shared.staged(wide.where(F.col("in_docs") >= LEAST_DOCS).drop("in_docs"), folder, "kept")


def group_totals(docs: DataFrame, kept: DataFrame, folder: str) -> DataFrame:
    """One row for each occurring group: N, its number of kept terms, V and N of its language, the
    weight of a term that it lacks (p0), and the number of groups and of kept rows of the language."""
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("terms"), F.count_if("once").alias("v"))
    groups = _texts(docs).select("lang", "source").distinct().join(sums, ["lang", "source"], "left")
    groups = shared.staged(groups.fillna(0, ["total", "terms", "v"]), folder, "totals")
    by_lang = groups.groupBy("lang").agg(
        F.sum("v").alias("vocabulary"), F.sum("total").alias("lang_total"), F.count(F.lit(1)).alias("sources"), F.sum("terms").alias("lang_rows")
    )
    out = groups.drop("v").join(by_lang, "lang")
    return shared.staged(out.withColumn("p0", weight(F.lit(0).cast("long"), "total")), folder, "groups")


def weight(count: Column, total: str) -> Column:
    """p of a count; NULL in a language without kept terms."""
    size = F.nullif(F.col(total) + F.col("vocabulary"), F.lit(0).cast("long"))
    wide = (F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")).cast("decimal(38,0)")
    return F.call_function("div", wide, size.cast("decimal(20,0)")) + 1


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def skyband(group_count: np.ndarray, lang_count: np.ndarray, rank: np.ndarray, k: int) -> np.ndarray:
    """Which points fewer than ``k`` others dominate: group count not lower, language count not higher,
    rank lower. Ranks are distinct.

    Points come in order of falling group count, so all possible dominators of a point are before it; it
    is enough to count those that are kept, because the first k dominators of any point are. Points of
    equal counts form a cell, in which the first k can stay at most.
    """
    if not len(rank):
        return np.zeros(0, np.int64)
    order = np.lexsort((rank, lang_count, -group_count))
    g, c, r = group_count[order], lang_count[order], rank[order]
    new = np.concatenate([[True], (g[1:] != g[:-1]) | (c[1:] != c[:-1])])
    begins = np.flatnonzero(new)
    ends = np.concatenate([begins[1:], [len(g)]])
    kept_c, kept_r = np.empty(len(g), c.dtype), np.empty(len(g), r.dtype)
    n, chosen = 0, []
    for b, e in zip(begins.tolist(), ends.tolist()):
        e = min(e, b + k)
        before = np.sort(kept_r[:n][kept_c[:n] <= c[b]])
        beaten = np.searchsorted(before, r[b:e]) + np.arange(e - b)
        more = int(np.searchsorted(beaten, k))  # rises within the cell
        kept_c[n : n + more], kept_r[n : n + more] = c[b], r[b : b + more]
        chosen.append(order[b : b + more])
        n += more
    return np.concatenate(chosen)


def thinned(rows: DataFrame, k: int) -> DataFrame:
    """Of the rows (lang, source, term, n, n_lang) of each task, the skyband of each group."""
    import pyarrow as pa
    import pyarrow.compute as pc

    def prune(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        rank = np.empty(len(table), np.int64)
        rank[pc.sort_indices(table["term"]).to_numpy()] = np.arange(len(table))
        return table.take(pa.array(np.sort(skyband(table["n"].to_numpy(), table["n_lang"].to_numpy(), rank, k))))

    def task(batches) -> Iterator:
        held: dict[tuple, list] = {}
        sizes: Counter = Counter()
        kept: Counter = Counter()
        schema = None
        for batch in batches:
            schema = batch.schema
            keys = pa.StructArray.from_arrays([batch.column("lang"), batch.column("source")], ["l", "s"]).to_pylist()
            rows: dict[tuple, list[int]] = {}
            for i, x in enumerate(keys):
                rows.setdefault((x["l"], x["s"]), []).append(i)
            for key, at in rows.items():
                held.setdefault(key, []).append(batch.take(pa.array(at)))
                sizes[key] += len(at)
                if sizes[key] > 2 * kept[key] + BUFFER:
                    table = prune(pa.Table.from_batches(held[key]))
                    held[key], sizes[key], kept[key] = table.to_batches(), len(table), len(table)
        for parts in held.values():
            yield from prune(pa.Table.from_batches(parts, schema)).to_batches()

    rows = rows.select("lang", "source", "term", "n", "n_lang")
    return rows.mapInArrow(task, "lang string, source string, term string, n long, n_lang long")


def top_terms(kept: DataFrame, groups: DataFrame, folder: str, k: int = TOP) -> DataFrame:
    """The first ``k`` terms of every group with p > q, by value and then term."""
    left = shared.staged(thinned(kept, k), folder, "skybands")
    parts = left.groupBy("lang", "source").agg(F.ceil(F.count(F.lit(1)) / MERGED).alias("parts"))
    parts = shared.staged(parts, folder, "parts")
    left = left.join(parts, ["lang", "source"]).withColumn("part", F.pmod(F.xxhash64("term"), F.col("parts")))
    left = thinned(left.repartition("lang", "source", "part"), k)
    both = left.join(groups, ["lang", "source"])
    p, q = weight(F.col("n"), "total"), weight(F.col("n_lang"), "lang_total")
    valued = both.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
    valued = valued.select("lang", "source", "item", divergence(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return valued.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def shared_terms(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item (another source), value: over the terms that both have, the difference of
    the divergence to what the two histograms account for. Partial sums."""
    import pyarrow as pa

    def task(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        term = table["term"].combine_chunks().dictionary_encode().indices.to_numpy()
        order = np.argsort(term, kind="stable")
        names = table["source"].combine_chunks().dictionary_encode()
        source, tile, p, z = (x[order] for x in (names.indices.to_numpy(), table["tile"].to_numpy(), table["p"].to_numpy(), table["p0"].to_numpy()))
        term, width = term[order], len(names.dictionary)
        begins = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]]))
        sizes = np.diff(np.concatenate([begins, [len(term)]]))
        sums, reached = np.zeros(width * width, np.int64), np.zeros(width * width, bool)
        crossed = table["u"][0].as_py() != table["v"][0].as_py()
        pairs = np.cumsum(sizes**2)
        at = 0
        while at < len(begins):  # about a million pairs at a time
            end = max(at + 1, int(np.searchsorted(pairs, (pairs[at - 1] if at else 0) + 1_000_000, side="right")))
            rows = np.arange(begins[at], begins[end - 1] + sizes[end - 1])
            size = np.repeat(sizes[at:end], sizes[at:end])
            i = np.repeat(rows, size)
            inside = np.arange(len(i)) - np.repeat(np.cumsum(size) - size, size)
            j = np.repeat(np.repeat(begins[at:end], sizes[at:end]), size) + inside
            use = (tile[i] != tile[j]) if crossed else (i != j)
            i, j = i[use], j[use]
            cell = source[i].astype(np.int64) * width + source[j]
            np.add.at(sums, cell, _f(p[i], p[j]) - _f(p[i], z[j]) - _f(z[i], p[j]) + _f(z[i], z[j]))
            reached[cell] = True
            at = end
        cells = np.flatnonzero(reached)
        lang = pa.array([table["lang"][0].as_py()] * len(cells), pa.string())
        pick = lambda k: names.dictionary.take(pa.array(k))
        return pa.Table.from_arrays([lang, pick(cells // width), pick(cells % width), pa.array(sums[cells])], ["lang", "source", "item", "value"])

    rows = kept.join(groups.select("lang", "source", "total", "vocabulary", "p0", "sources", "lang_rows"), ["lang", "source"])
    tiles = F.ceil(F.col("sources") / TILE)
    tile = F.pmod(F.xxhash64("source"), tiles)
    blocks = F.greatest(F.ceil(2 * F.col("lang_rows") / (tiles * BLOCK_ROWS)), F.lit(1))
    rows = rows.where(F.col("sources") > 1).select(
        "lang", "source", "term", weight(F.col("n"), "total").alias("p"), "p0", tile.alias("tile"),
        F.pmod(F.xxhash64(F.lit(1), "term"), blocks).alias("block"), F.explode(F.sequence(F.lit(0).cast("long"), tiles - 1)).alias("other"),
    )
    rows = rows.select("*", F.least("tile", "other").alias("u"), F.greatest("tile", "other").alias("v")).drop("other")
    return rows.groupBy("lang", "u", "v", "block").applyInArrow(task, "lang string, source string, item string, value long")


def source_pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """All ordered pairs of sources of a language with the divergence of the first from the second."""
    # Groups of one language meet each other: that is the result. Salts spread them over tasks.
    salt = F.pmod(F.xxhash64("source", "total"), F.lit(SALTS))
    copies = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    others = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("z"), copies.alias("salt"))
    wide = lambda c: c.cast("decimal(38,0)")
    mine = groups.select("lang", "source", "p0", "vocabulary", salt.cast("int").alias("salt"))
    base = mine.join(others, ["lang", "salt"]).where(F.col("source") != F.col("item"))
    neither = wide(divergence(F.col("p0"), F.col("z"))) * F.col("vocabulary")
    base = base.select("lang", "source", "item", F.coalesce(wide(neither), wide(F.lit(0))).alias("value"))
    counts = kept.groupBy("lang", "source", "n").agg(F.count(F.lit(1)).alias("m"))
    counts = counts.join(groups.select("lang", "source", "total", "vocabulary", "p0"), ["lang", "source"])
    salt = F.pmod(F.xxhash64("source", "n"), F.lit(SALTS))
    counts = counts.select("lang", "source", "p0", "m", weight(F.col("n"), "total").alias("p"), salt.cast("int").alias("salt"))
    met = counts.join(others, ["lang", "salt"]).where(F.col("source") != F.col("item"))
    out = F.col("m") * wide(divergence(F.col("p"), F.col("z")) - divergence(F.col("p0"), F.col("z")))
    back = F.col("m") * wide(divergence(F.col("z"), F.col("p")) - divergence(F.col("z"), F.col("p0")))
    met = met.groupBy("lang", "source", "item").agg(F.sum(wide(out)).alias("out"), F.sum(wide(back)).alias("back"))
    ways = F.array(F.struct("source", "item", F.col("out").alias("value")), F.struct(F.col("item").alias("source"), F.col("source").alias("item"), F.col("back").alias("value")))
    met = met.select("lang", F.explode(ways).alias("w")).select("lang", "w.source", "w.item", "w.value")
    both = shared_terms(kept, groups).withColumn("value", wide(F.col("value")))
    sums = base.unionByName(met).unionByName(both).groupBy("lang", "source", "item").agg(F.sum("value").cast("long").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return sums.withColumn("rank", F.row_number().over(order))


def audit(docs: DataFrame, folder: str, k: int = TOP) -> DataFrame:
    """Pairs of sources, and the first ``k`` terms of each source, with values and ranks."""
    kept = kept_terms(docs, folder)
    groups = group_totals(docs, kept, folder)
    pairs = source_pairs(kept, groups).withColumn("part", F.lit("pair"))
    terms = top_terms(kept, groups, folder, k).withColumn("part", F.lit("term"))
    return pairs.unionByName(terms).select("lang", "source", "part", "item", "value", "rank")


def op13_divergence_audit(spark, sf_dir: str) -> DataFrame:
    """Divergence of every source from the others of its language, and its 200 most distinctive terms."""
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"), shared.workspace(spark, "divergence"))


OP13_SQL = """
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS doc,
    unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM documents
), v AS (
  SELECT lang, term, count(*)::HUGEINT AS n FROM d GROUP BY lang, term HAVING count(DISTINCT doc) >= 3
), l AS (
  SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS n FROM v GROUP BY lang
), c AS (
  SELECT d.lang, d.source, d.term, count(*)::HUGEINT AS n FROM d JOIN v USING (lang, term) GROUP BY ALL
), g AS (
  SELECT o.lang, o.source, coalesce(l.v, 0) AS v, coalesce(s.n, 0)::HUGEINT AS n
  FROM (SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents) AS o
  LEFT JOIN l USING (lang) LEFT JOIN (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL) AS s USING (lang, source)
), w AS (
  SELECT g.lang, g.source, v.term, coalesce(c.n, 0) AS n,
    1 + 1000000000 * (coalesce(c.n, 0) + 1) // (g.n + g.v) AS p, 1 + 1000000000 * (v.n + 1) // (l.n + l.v) AS q
  FROM g JOIN v USING (lang) JOIN l USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = v.term
), r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM w AS a JOIN w AS b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY ALL
  UNION ALL
  SELECT a.lang, a.source, 'pair', b.source, 0 FROM g AS a JOIN g AS b ON b.lang = a.lang AND b.source <> a.source WHERE a.v = 0
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM w WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value,
  row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM r QUALIFY part = 'pair' OR rank <= 200
"""
