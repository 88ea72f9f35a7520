"""Quality rules with risk-controlled thresholds.

Each rule is a number per document and a ladder of cutoffs from lenient to strict; a document at or
beyond the chosen cutoff is rejected. Cutoffs are chosen per stratum on documents labelled as good:
along a ladder, a cutoff is accepted while the exact binomial test rejects "more than ``risk`` of
the good documents of this stratum are lost" at the level ``alpha`` divided by the number of rules
and strata. Testing in this fixed order up to the first failure needs no further correction along
the ladder (Bonferroni covers rules and strata), so with probability 1 - ``alpha`` every rule loses
at most ``risk`` of the good documents of every stratum. Among the accepted cutoffs the one that
separates bad from good documents best is used. A stratum with too few labels accepts no cutoff (at
least about 280 good documents are needed), and keeps all that the base rule keeps.

The counts behind the test come from all labelled documents, grouped by stratum, rule and rung: at
most strata x rules x rungs rows, so thresholds are literals of the final plan. Documents may be
given as rows of ``documents`` with labels joined by doc_id.

NULL texts have no words and fail the base rule. NULL or unlisted languages form the stratum
"other". NULL labels are no labels; conflicting repeated labels all count. Empty tables of labels
give no thresholds. Repeated documents are rows of their own. Further columns pass through
``features`` only where the caller names them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm import shared
from sparkmart.llm.words import Words, bytes_of, chunks, mix, powers

STRATA = ("en", "fr", "de", "es")
RISK = 0.02
ALPHA = 0.1
# Rungs of each rule from lenient to strict; a value at or above a rung is rejected.
LADDERS: dict[str, tuple[float, ...]] = {
    "symbol_share": tuple(x / 100 for x in (200, 150, 100, 80, 60, 50, 40, 30, 25, 20, 15, 12, 10, 8, 6, 5, 4, 3, 2)),
    "shout_share": tuple(x / 100 for x in (90, 80, 70, 60, 50, 45, 40, 35, 30, 25, 20, 15, 12, 10, 8, 6, 5, 4)),
    "exclaim_share": tuple(x / 100 for x in (90, 80, 70, 60, 50, 40, 30, 25, 20, 15, 12, 10, 8, 6, 5, 4, 3, 2)),
    "dup_line_share": tuple(x / 100 for x in (95, 90, 80, 70, 60, 50, 45, 40, 35, 30, 25, 20, 15, 12, 10, 8)),
    "repeat_share": tuple(x / 100 for x in (95, 90, 80, 70, 60, 50, 40, 30, 25, 20, 18, 16, 14, 12, 10, 8, 6, 5, 4, 3)),
    "long_word": (80, 60, 50, 40, 35, 30, 25, 22, 20, 18, 16, 15, 14, 13, 12, 11, 10),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_lines", "n_upper", "n_letters", "n_exclaim")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _seen_before(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: whether an equal one comes earlier, and whether any other is equal."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    later, shared_ = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:]] = same
    shared_[order[1:]] = same
    shared_[order[:-1]] |= same
    return later, shared_


def text_counts(data: np.ndarray, offsets: np.ndarray, window: int = 5) -> dict[str, np.ndarray]:
    """Counts of each text of a chunk of UTF-8 bytes."""
    n = len(offsets) - 1
    words = Words(data, offsets)
    first = (data & 0xC0) != 0x80  # one for each code point
    inside = np.zeros(len(data) + 1, np.int8)
    inside[words.starts] += 1
    np.subtract.at(inside, words.ends, 1)
    inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    out = {
        "n_words": np.diff(words.at),
        "word_chars": _per_text(first & inside, offsets),
        "n_symbols": _per_text(_SYMBOL[data], offsets),
        "n_upper": _per_text((data >= 65) & (data <= 90), offsets),
        "n_letters": _per_text(((data | 32) >= 97) & ((data | 32) <= 122), offsets),
        "n_exclaim": _per_text(data == 33, offsets),
    }
    salt = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)

    # Lines: from a text's start or a newline to the next newline or the text's end. A newline that
    # ends a text adds an empty line, which has no words and drops out, whichever text it is given.
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    text = np.searchsorted(offsets[:-1], starts, side="right") - 1
    ends = np.sort(np.concatenate([offsets[1:], breaks]))
    filled = np.searchsorted(words.starts, starts) < np.searchsorted(words.starts, ends)
    starts, ends = starts[filled], ends[filled]
    text = text[filled]
    sums = words.prefix(False)
    _, down = powers(len(data) + 1)
    lines = mix((sums[ends] - sums[starts]) * down[starts])
    later, _ = _seen_before(lines ^ salt[text])
    out["n_lines"] = np.bincount(text, minlength=n)
    out["n_dup_lines"] = np.bincount(text, weights=later, minlength=n).astype(np.int64)

    hashes = words.hashes(lower=False)
    runs, at = words.shingles(hashes, window)
    owner = np.repeat(np.arange(n), np.diff(at))
    _, found = _seen_before(runs ^ salt[owner])
    found &= np.repeat(np.diff(words.at) >= window, np.diff(at))
    place = np.flatnonzero(found) - at[owner[found]] + words.at[owner[found]]
    cover = np.zeros(len(words) + 1, np.int32)
    np.add.at(cover, place, 1)
    np.subtract.at(cover, place + window, 1)
    out["n_repeat_words"] = _per_text(np.cumsum(cover[:-1]) > 0, words.at)
    return out


def features(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Counts of each document's whole text beside the columns of ``keep``."""
    import pyarrow as pa

    names = [*COUNTS, *EXTRA]

    def task(batches) -> Iterator:
        for batch in batches:
            data, offsets = bytes_of(batch.column("_text"))
            found: dict[str, list[np.ndarray]] = {x: [np.zeros(0, np.int64)] for x in names}
            for i, j in chunks(offsets):
                part = text_counts(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                for x in names:
                    found[x].append(part[x])
            kept = [batch.column(c) for c in keep]
            made = [pa.array(np.concatenate(found[x]).astype(np.int64)) for x in names]
            yield pa.RecordBatch.from_arrays(kept + made, keep + names)

    rows = docs.select(*keep, F.col("text").cast("string").alias("_text"))
    declared = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "_text")
    return rows.mapInArrow(task, declared + "".join(f", {x} long" for x in names))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def rule_values() -> dict[str, Column]:
    words, letters = F.col("n_words").cast("double"), F.col("n_letters").cast("double")
    share = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    return {
        "symbol_share": share(F.col("n_symbols"), words),
        "shout_share": share(F.col("n_upper"), letters),
        "exclaim_share": share(F.col("n_exclaim"), words),
        "dup_line_share": share(F.col("n_dup_lines"), F.col("n_lines").cast("double")),
        "repeat_share": share(F.col("n_repeat_words"), words),
        "long_word": share(F.col("word_chars"), words),
    }


def stratum(lang: Column, strata: tuple[str, ...] = STRATA) -> Column:
    return F.when(lang.isin(*strata), lang).otherwise(F.lit("other"))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for a binomial X, summed in logarithms."""
    if k >= n:
        return 1.0
    base = math.lgamma(n + 1)
    return math.fsum(
        math.exp(base - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p))
        for i in range(k + 1)
    )


def choose(good: list[int], bad: list[int], tests: int, risk: float = RISK, alpha: float = ALPHA) -> int:
    """Rung of one rule in one stratum, -1 for none.

    ``good`` and ``bad`` count the documents that each rung is the first to reject. Of the accepted
    rungs, the one with the largest share of bad less share of good documents rejected is taken, the
    most lenient of equal ones, so that a rule that finds nothing rejects nothing.
    """
    n_good, n_bad = sum(good), sum(bad)
    if not n_good or not n_bad:
        return -1
    lost = caught = 0
    best, gain = -1, 0.0
    for rung, (g, b) in enumerate(zip(good[:-1], bad[:-1])):
        lost, caught = lost + g, caught + b
        if binomial_tail(lost, n_good, risk) > alpha / tests:
            break
        if (now := caught / n_bad - lost / n_good) > gain:
            best, gain = rung, now
    return best


def thresholds(labelled: DataFrame, risk: float = RISK, alpha: float = ALPHA) -> dict[tuple[str, str], float]:
    """Cutoff by (stratum, rule), from labelled features (lang, quality and the counts)."""
    values = rule_values()
    # Rung at which a document is lost first: rungs descend, so count those above its value.
    rung = lambda rule: sum((F.when(values[rule] < x, 1).otherwise(0) for x in LADDERS[rule]), F.lit(0))
    passed = labelled.where(F.col("quality").isin(0, 1) & ~base_failed())
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), rung(r).alias("rung")) for r in LADDERS]))
    found = passed.select(stratum(F.col("lang")).alias("stratum"), "quality", each.alias("x"))
    counted = found.groupBy("stratum", "quality", "x.rule", "x.rung").agg(F.count(F.lit(1)).alias("n")).collect()
    tests = len(LADDERS) * (len(STRATA) + 1)
    out = {}
    for s in (*STRATA, "other"):
        for rule, ladder in LADDERS.items():
            by_rung = ([0] * (len(ladder) + 1), [0] * (len(ladder) + 1))
            for x in counted:
                if (x.stratum, x.rule) == (s, rule):
                    by_rung[x.quality][x.rung] += x.n
            best = choose(by_rung[1], by_rung[0], tests, risk, alpha)
            if best >= 0:
                out[s, rule] = ladder[best]
    return out


def verdict(cutoffs: dict[tuple[str, str], float]) -> Column:
    """True where a document passes the base rule and every threshold of its stratum."""
    values, failed = rule_values(), base_failed()
    for (s, rule), cutoff in cutoffs.items():
        failed = failed | ((stratum(F.col("lang")) == s) & (values[rule] >= cutoff))
    return ~failed


def _labelled(counted: DataFrame, labels: DataFrame) -> DataFrame:
    known = labels.where(F.col("quality").isNotNull()).select(F.col("doc_id").alias("_id"), "quality")
    return counted.join(known, counted["doc_id"] == known["_id"]).drop("_id")


def judged(docs: DataFrame, labels: DataFrame, folder: str) -> DataFrame:
    """Counts, base_failed and kept of every document."""
    counted = shared.staged(features(docs, ["doc_id", "lang"]), folder, "features")
    cutoffs = thresholds(_labelled(counted, labels))
    return counted.withColumns({"base_failed": base_failed(), "kept": verdict(cutoffs)})


def kept_rows(docs: DataFrame, labels: DataFrame, folder: str) -> DataFrame:
    """The rows of ``docs`` that pass, each judged by its own text; no row is found again by its id.

    Texts are counted twice, for the thresholds and for the verdict, but never shuffled: only the counts
    meet the labels.
    """
    counted = shared.staged(features(docs, ["doc_id", "lang"]), folder, "features")
    cutoffs = thresholds(_labelled(counted, labels))
    # Rows travel in a struct, so that no name of theirs can clash.
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), "lang", "text")
    return features(rows, ["_row", "lang"]).where(verdict(cutoffs)).select(*(F.col(f"_row.`{c}`").alias(c) for c in docs.columns))


def op7_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document, thresholds fitted on the labels."""
    folder = shared.workspace(spark, "quality")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return judged(docs, labels, folder).select("doc_id", *COUNTS, "base_failed", "kept")
