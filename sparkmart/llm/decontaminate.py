"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask that looks at some positions of a short run of tokens and ignores the others,
so it still hits where a token in between was exchanged. Seeds of all benchmark items are hashed and
joined with those of all documents. Every hit fixes an alignment of an item with a document, and
that alignment is verified token by token: it counts as an overlap if, in some stretch of
``STRETCH`` tokens of the item (the whole item where that is shorter), at least ``SHARE`` of the
tokens equal those of the document. Exchanged tokens are tolerated, inserted or dropped ones end a
stretch.

Items shorter than a stretch also have seeds without gaps. An item of n tokens in which e may differ
keeps a run of n // (e + 1) tokens whole, wherever the e are, so its runs of that length miss no
overlap. Documents have such seeds for the lengths that the benchmark needs (at most four tokens).

DataFrame functions only. Benchmark seeds are the broadcast side; their number is counted first, and
a benchmark with more than ``BLOCK_SEEDS`` of them is taken in blocks of items, each in a pass of
its own. Only hits, as (document, item, shift), leave that pass; they are made distinct and joined
with the texts of their documents to be verified.

Tokens are the maximal runs of letters and digits of the lower-cased text. Texts or items without
tokens have no seeds and thus no overlaps; an item of one token overlaps every text with it. Repeated documents are
grouped by doc_id, repeated items by item_id; a NULL id is an id like any other. An empty table
gives no rows. Columns other than the ids and the texts are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm import shared

# Fixed masks: positions that a seed looks at; eight tokens long, weight five.
MASKS = ((0, 1, 2, 4, 7), (0, 3, 5, 6, 7))
SPAN = 8
STRETCH = 20
SHARE = 0.8
BLOCK_SEEDS = 500_000
LEAK_KEYS = 2_000_000  # keys of leaking rows that may be broadcast


def tokens(text: Column) -> Column:
    """Hashes of the runs of letters and digits of the lower-cased text."""
    parts = F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.array_remove(parts, ""), lambda x: F.xxhash64(x))


def seeds(words: Column, masks: tuple[tuple[int, ...], ...] = MASKS) -> Column:
    """Seed hashes of all starts by the first mask, then by the second."""
    span = max(map(max, masks)) + 1

    def by(number: int, mask: tuple[int, ...]) -> Column:
        starts = F.sequence(F.lit(0), F.size(words) - span)
        return F.transform(starts, lambda i: F.xxhash64(F.lit(number), *[F.get(words, i + k) for k in mask]))

    return F.concat(*[by(number, mask) for number, mask in enumerate(masks)])


def run_length(size: Column, share: float) -> Column:
    """Length of the run that an item of ``size`` tokens keeps in every overlap, if it is a short one."""
    spare = size - F.ceil(size * F.lit(share))
    return F.floor(size / (spare + 1)).cast("int")


def _rows(df: DataFrame, key: str, words: str, at: str, masks: tuple[tuple[int, ...], ...] = MASKS) -> DataFrame:
    """(key, at, seed) of every seed of texts with as many tokens as a seed has.

    Hashes are made in a projection of their own, so that only narrow rows leave the generator. It
    is an outer one on purpose: for others Spark infers a filter on the size of the array, and moves
    it, with all that makes up the array, to where the tokens would be made anew for each element.
    Texts without seeds give a row without a seed, which no join keeps.
    """
    size, span = F.size(words), max(map(max, masks)) + 1
    made = df.select(key, (size - span + 1).alias("_starts"), F.when(size >= span, seeds(F.col(words), masks)).alias("_seeds"))
    each = made.select(key, "_starts", F.posexplode_outer("_seeds").alias("_at", "seed"))
    return each.select(key, (F.col("_at") % F.col("_starts")).alias(at), "seed")


def matches(doc: Column, item: Column, shift: Column) -> Column:
    """1 where the item's token equals the document's at ``shift`` further on, else 0."""
    places = F.sequence(F.lit(0), F.size(item) - 1)

    def same(i: Column) -> Column:
        j = i + shift
        inside = (j >= 0) & (j < F.size(doc))
        return F.when(inside & (F.get(doc, F.greatest(j, F.lit(0))) == F.get(item, i)), 1).otherwise(0)

    return F.transform(places, same)


def best_stretch(same: Column, stretch: int = STRETCH) -> Column:
    """Largest number of matches in any run of ``stretch`` tokens, or in all if there are fewer."""
    size = F.least(F.lit(stretch), F.size(same))
    starts = F.sequence(F.lit(0), F.size(same) - size)
    total = lambda s: F.aggregate(F.slice(same, s + 1, size), F.lit(0), lambda a, b: a + b)
    return F.array_max(F.transform(starts, total))


def overlaps(
    docs: DataFrame, benchmark: DataFrame, folder: str, share: float = SHARE, stretch: int = STRETCH
) -> DataFrame:
    """Verified overlaps: doc_id, item_id, the number of alignments, where the first one puts the
    item in the document (in tokens), and the best number of matches of an alignment."""
    items = benchmark.select("item_id", tokens(F.col("text")).alias("item"))
    short = F.size("item").between(1, stretch - 1)
    run = F.when(short, run_length(F.size("item"), share))
    kinds = [(MASKS, items, SPAN)]
    runs = items.select(run.alias("run")).where("run IS NOT NULL").distinct().collect()
    for n in sorted(r.run for r in runs):
        kinds.append(((tuple(range(n)),), items.where(run == n), n))
    words = docs.select("doc_id", tokens(F.col("text")).alias("doc"))
    found = []
    for masks, its, span in kinds:
        n_seeds = its.agg(F.sum(F.greatest(F.size("item") - span + 1, F.lit(0)))).head()[0] or 0
        blocks = max(1, -(-int(n_seeds) * len(masks) // BLOCK_SEEDS))
        rows = _rows(words, "doc_id", "doc", "doc_at", masks)
        for block in range(blocks):
            some = its.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block) if blocks > 1 else its
            places = _rows(some, "item_id", "item", "item_at", masks)  # at most about BLOCK_SEEDS rows
            hits = rows.join(F.broadcast(places), "seed")
            shift = (F.col("doc_at") - F.col("item_at")).alias("shift")
            hits = hits.select("doc_id", "item_id", shift).distinct()
            found.append(shared.staged(hits, folder, f"hits-{len(found)}"))
    hits = reduce(DataFrame.unionByName, found).distinct().select(F.col("doc_id").alias("_doc_id"), "item_id", "shift")
    texts = docs.select("doc_id", "text")
    both = texts.join(hits, texts["doc_id"].eqNullSafe(hits["_doc_id"])).select("doc_id", "text", F.col("item_id").alias("_item_id"), "shift")
    both = both.join(items, both["_item_id"].eqNullSafe(items["item_id"]))
    pairs = both.select("doc_id", "item_id", "shift", "item", tokens(F.col("text")).alias("doc"))
    same = pairs.select(
        "doc_id", "item_id", "shift",
        F.size("item").alias("item_tokens"),
        matches(F.col("doc"), F.col("item"), F.col("shift")).alias("same"),
    )
    scored = same.select(
        "doc_id", "item_id", "shift", "item_tokens",
        F.aggregate("same", F.lit(0), lambda a, b: a + b).alias("matched"),
        best_stretch(F.col("same"), stretch).alias("best"),
    )
    # Written first: a filter on it would be moved below the projections, with all they compute inside
    # of it, and the tokens would be made anew for each element.
    scored = shared.staged(scored, folder, "scored")
    every = scored.where(F.col("best") >= F.least(F.lit(stretch), F.col("item_tokens")) * F.lit(share))
    return every.groupBy("doc_id", "item_id").agg(
        F.count_distinct("shift").alias("alignments"),
        F.min("shift").cast("long").alias("first_token"),
        F.max("matched").cast("long").alias("matched"),
        F.max("item_tokens").cast("long").alias("item_tokens"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, folder: str) -> DataFrame:
    """Rows without an overlap, unchanged. The join sees keys only, once for each document.

    A row's key is two hashes of its id and text, so rows with one id or none but other texts are judged
    each by its own. The keys of leaking rows are counted: up to ``LEAK_KEYS`` of them (16 bytes each)
    are broadcast, so that texts stay where they are; more are joined by a shuffle.
    """
    text = docs["text"].cast("string")
    one, two = (F.xxhash64(F.lit(k), docs["doc_id"], text) for k in (1, 2))
    key = F.struct(one.alias("one"), two.alias("two"))
    leaks = overlaps(docs.select(key.alias("doc_id"), text.alias("text")), benchmark, folder)
    leaks = shared.staged(leaks.select("doc_id.one", "doc_id.two").distinct(), folder, "leaks")
    few = leaks.count() <= LEAK_KEYS
    return docs.join(leaks.hint("broadcast" if few else "merge"), (one == leaks["one"]) & (two == leaks["two"]), "left_anti")


def op1_spaced_seeds(spark, sf_dir: str) -> DataFrame:
    """Overlaps of all documents with all benchmark items."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return overlaps(docs, items, shared.workspace(spark, "decontaminate"))


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
  FROM documents
), i AS (
  SELECT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
  FROM benchmark
), m AS (SELECT * FROM (VALUES (1, 2, 4, 7), (3, 5, 6, 7)) t(a, b, c, e)),
dp AS (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS p FROM d WHERE len(w) >= 8),
ip AS (SELECT item_id, w, unnest(range(1, len(w) - 6)) AS q FROM i WHERE len(w) >= 8),
ds AS (SELECT doc_id, p, a, concat_ws(' ', w[p], w[p + a], w[p + b], w[p + c], w[p + e]) AS seed FROM dp, m),
r AS (
  SELECT item_id, w, CAST(floor(len(w) / (len(w) - ceil(len(w) * 0.8::DOUBLE) + 1)) AS INTEGER) AS run
  FROM i WHERE len(w) BETWEEN 1 AND 19
), rp AS (SELECT item_id, w, run, unnest(range(1, len(w) - run + 2)) AS q FROM r),
dr AS (SELECT doc_id, w, run, unnest(range(1, len(w) - run + 2)) AS p FROM d, (SELECT DISTINCT run FROM r) WHERE len(w) >= run),
hits AS (
  SELECT DISTINCT doc_id, item_id, p - q AS shift FROM ds JOIN (
    SELECT item_id, q, a, concat_ws(' ', w[q], w[q + a], w[q + b], w[q + c], w[q + e]) AS seed FROM ip, m
  ) s USING (a, seed)
  UNION
  SELECT doc_id, item_id, p - q FROM (SELECT doc_id, p, run, array_to_string(w[p:p + run - 1], ' ') AS seed FROM dr)
  JOIN (SELECT item_id, q, run, array_to_string(w[q:q + run - 1], ' ') AS seed FROM rp) USING (run, seed)
), eq AS (
  SELECT doc_id, item_id, shift, len(i.w) AS n,
    list_transform(range(1, len(i.w) + 1),
      lambda k: CASE WHEN k + shift >= 1 AND k + shift <= len(d.w) AND d.w[k + shift] = i.w[k] THEN 1 ELSE 0 END) AS same
  FROM hits JOIN d USING (doc_id) JOIN i USING (item_id)
), scored AS (
  SELECT doc_id, item_id, shift, n, list_sum(same) AS matched,
    list_max(list_transform(range(1, n - least(20, n) + 2), lambda s: list_sum(same[s:s + least(20, n) - 1]))) AS best
  FROM eq
)
SELECT doc_id, item_id, count(*) AS alignments, min(shift)::BIGINT AS first_token,
  max(matched)::BIGINT AS matched, max(n)::BIGINT AS item_tokens
FROM scored WHERE best >= least(20, n) * 0.8 GROUP BY ALL
"""
