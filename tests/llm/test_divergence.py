"""Source divergence audit against plain counting over all terms and pairs."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from sparkmart.llm import divergence, shared
from tests_llm_helpers import DOCS, folder, invented, lowered  # noqa: F401

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(rows, top):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for row in rows:
        lang, source = row[2] or "", row[3] or ""
        terms = TERM.findall(lowered(row[1]))
        groups[lang].add(source)
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= 3]
        share = lambda c, n: 1 + 10**9 * (c + 1) // (n + len(kept))  # noqa: B023, E731
        weights = {}
        for s in sources:
            n = sum(counts[lang, s][t] for t in kept)
            weights[s] = {t: share(counts[lang, s][t], n) for t in kept}
        whole = {t: sum(counts[lang, s][t] for s in sources) for t in kept}
        q = {t: share(whole[t], sum(whole.values())) for t in kept}
        f = lambda a, b: (a - b) ** 2 // b
        for s in sources:
            pairs = [(-sum(f(weights[s][t], weights[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(-f(weights[s][t], q[t]), t) for t in kept if counts[lang, s][t] and weights[s][t] > q[t]]
            for part, ranked in (("pair", sorted(pairs, key=lambda x: (x[0], x[1].encode()))), ("term", sorted(terms, key=lambda x: (x[0], x[1].encode()))[:top])):
                out += [(lang, s, part, item, -v, r + 1) for r, (v, item) in enumerate(ranked)]
    return sorted(out)


def rows():
    extra = ("e",) * 12
    out = []
    for k in range(60):
        text = invented(k, 80) + " " + invented(1000 + k % 5, 30).upper() + f" S{k % 4}_x9é日 don't"
        out.append((k, text, ("en", "fr", None, "")[k % 4], (f"s{k % 7}", None)[k % 11 == 0], 1, *extra))
    out += [out[3], out[3], (None, None, "en", "only-null", None, *extra), (70, "", "de", "a", 0, *extra), (71, "1 2 3", "de", "b", 0, *extra)]
    out += [(72, "one lonely text", "xx", "alone", 0, *extra), (73, "ab " * 3000 + "ç" * 500, "en", "s1", 0, *extra)]
    return out


@pytest.mark.parametrize("small", [False, True])
def test_whole_audit(spark, folder, monkeypatch, small):
    shared.ship(spark)
    if small:  # several tiles, blocks, parts and flushes
        monkeypatch.setattr(divergence, "TILE", 3)
        monkeypatch.setattr(divergence, "BLOCK_ROWS", 40)
        monkeypatch.setattr(divergence, "MERGED", 30)
        monkeypatch.setattr(divergence, "BUFFER", 15)
    df = spark.createDataFrame(rows(), DOCS).repartition(4)
    got = sorted(tuple(r) for r in divergence.audit(df, folder, 10 if small else 200).collect())
    assert got == plain(rows(), 10 if small else 200)


def test_no_documents(spark, folder):
    shared.ship(spark)
    assert divergence.audit(spark.createDataFrame([], DOCS), folder).collect() == []


@pytest.mark.parametrize("k", [1, 4, 30])
def test_skyband_is_that_of_all_comparisons(k):
    draw = np.random.default_rng(k)
    for n in (0, 1, 7, 300):
        g, c = draw.integers(1, 9, n), draw.integers(3, 15, n)
        r = draw.permutation(n)
        above = (g[None, :] >= g[:, None]) & (c[None, :] <= c[:, None]) & (r[None, :] < r[:, None])
        assert sorted(divergence.skyband(g, c, r, k).tolist()) == np.flatnonzero(above.sum(axis=1) < k).tolist()


def test_thinning_drops_what_cannot_rank(spark):
    shared.ship(spark)
    rows = [("en", "a", f"t{i:05d}", 1 + i % 3, 5 + i % 2) for i in range(3000)]
    df = spark.createDataFrame(rows, "lang string, source string, term string, n long, n_lang long").coalesce(1)
    left = divergence.thinned(df, 20)
    assert left.count() < 200
    best = {r.term for r in df.orderBy("n_lang", "term").where("n = 3").limit(20).collect()}
    assert best <= {r.term for r in left.collect()}


def test_long_texts_are_cut_at_blanks(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 50)
    raw = (" ".join(invented(4, 300).split()) + " " + "x" * 400).encode().translate(divergence._TERMS)
    assert [w for p in divergence._pieces(raw) for w in p.split()] == raw.split()
    assert list(divergence._pieces(b"")) == [b""]
