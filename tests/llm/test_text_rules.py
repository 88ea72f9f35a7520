import hashlib
import math
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkmart.llm import bilinear, decontaminate, quality, secrets_crf
from tests_llm_helpers import WORD, corpus, docs, folder, lowered, no_docs, tables  # noqa: F401


def base_counts(text):
    text = text or ""
    words, seen, dup = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    runs = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    repeated = {j for k in range(len(words) - 4) if runs[tuple(words[k : k + 5])] > 1 for j in range(k, k + 5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated)


def test_counts_equal_brute_force(docs, corpus):
    got = quality.features(docs, ["doc_id"]).select("doc_id", *quality.COUNTS).collect()
    assert sorted(map(tuple, got), key=str) == sorted(((r[0], *base_counts(r[1])) for r in corpus), key=str)


def test_binomial_tail_is_exact():
    for n, p in ((1, 0.3), (10, 0.02), (50, 0.5)):
        for k in range(n + 1):
            want = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
            assert quality.binomial_tail(k, n, p) == pytest.approx(want)


def test_thresholds_hold_their_risk():
    """Over many draws of labels, the true loss of the chosen rung exceeds the risk rarely."""
    draw = np.random.default_rng(0)
    shares = np.array([0.001, 0.004, 0.01, 0.015, 0.02, 0.05, 0.9])  # of good documents, by first rung
    lost, bad = np.cumsum(shares)[:-1], [50, 50, 50, 50, 50, 50, 0]
    over = 0
    for _ in range(400):
        good = draw.multinomial(1000, shares / shares.sum()).tolist()
        rung = quality.choose(good, bad, tests=1, risk=0.02, alpha=0.1)
        over += rung >= 0 and lost[rung] / shares.sum() > 0.02
    assert over / 400 < 0.1
    assert quality.choose([0, 5000], [9, 0], tests=30) == 0  # catches, loses nothing
    assert quality.choose([0, 5000], [0, 9], tests=30) == -1  # catches nothing
    assert quality.choose([0, 100], [9, 0], tests=30) == -1  # too few labels
    assert quality.choose([0, 0], [0, 0], tests=30) == -1


def test_quality_finds_junk_and_keeps_good(spark, folder):
    from tests_llm_helpers import invented

    rows = [(i, invented(i, 60), "en") for i in range(400)] + [(1000 + i, invented(i, 60).replace(" ", "### "), "en") for i in range(60)]
    rows += [(5000, "### " * 3, None), (5001, None, "en"), (5002, invented(3, 60).replace(" ", "### "), "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i < 1000)) for i, *_ in rows if i < 1060] + [(2, None)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.judged(docs, labels, folder).collect()}
    assert all(got[i].kept for i in range(400)) and not any(got[1000 + i].kept for i in range(60))
    assert got[5000].base_failed and got[5001].base_failed and not got[5001].kept
    assert got[5002].kept  # no labels in that stratum, so no cutoff there


def spans_by_hand(text):
    text, out = text or "", []
    for kind, pattern, least, group in (
        (0, r"(?ai)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 6, 2),
        (1, r"AKIA[A-Z0-9]+", 20, 0),
        (2, r"[0-9a-f]+", 24, 0),
    ):
        out += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if len(m[group]) >= least]
    return [(s, secrets_crf.KINDS[k], e) for s, k, e in sorted(out)]


def test_fixed_patterns(corpus):
    for row in corpus:
        assert secrets_crf.base_spans(row[1] or "") == spans_by_hand(row[1])


def trained():
    from tests_llm_helpers import invented

    draw = np.random.default_rng(9)
    texts = []
    for i in range(300):
        words = invented(i, 40).split(" ")
        if i % 2:
            code = "".join(draw.choice(list("ABCDEFGHJK0123456789"), 16))
            words[10:10] = ["AKIA" + code] if i % 4 == 1 else [f"password={code.lower()}"]
        texts.append(" ".join(words))
    return secrets_crf.fit(texts), texts


def test_field_learns_and_decodes_exactly():
    field, texts = trained()
    hits = total = wrong = 0
    for text in texts[150:]:
        raw = np.frombuffer(text.encode(), np.uint8)
        tokens = secrets_crf.Tokens(raw, np.array([0, len(raw)]))
        tags = field.decode(tokens.features, tokens.words.at)
        assert tags.tolist() == secrets_crf.viterbi(field.scores(tokens.features), field.pairs).tolist()
        gold = secrets_crf.gold_tags(text, tokens.words)
        hits += ((tags > 0) & (gold > 0)).sum()
        wrong += ((tags > 0) & (gold == 0)).sum()
        total += (gold > 0).sum()
    assert hits > 0.9 * total and wrong <= 0.05 * total
    draw = np.random.default_rng(4)
    for _ in range(50):  # pruning is exact for any scores
        scores = draw.normal(0, 3, (30, 3))
        some = secrets_crf.Field()
        some.pairs = draw.normal(0, 1, (3, 3))
        some.scores = lambda f, s=scores: s
        at = np.array([0, 7, 7, 30])
        want = [t for a, b in ((0, 7), (7, 30)) for t in secrets_crf.viterbi(scores[a:b], some.pairs).tolist()]
        assert some.decode(np.zeros((30, 4), int), at).tolist() == want


HIDDEN = ("bearer {k}", "ghp_{k}", "password is {p}", "secret {c}", "PASSWORD -> {p}", "credential {k}", "the token was '{k}'", "AUTH => {k}.")
HARMLESS = ("https://a.org/{h}", "the password is required", "token ring", "v10.4.2", "/usr/lib/{w}/x.py", "{w}_{w}_{w}()", "ABC-20931", "{w}@{w}.com", "secret of {w}", "20240115", "9781234567890")


def test_field_adds_secrets_that_no_pattern_has(spark):
    """Forms that the fixed patterns miss, planted in texts that the field has not seen."""
    import random

    from sparkmart.llm import shared
    from tests_llm_helpers import invented

    shared.ship(spark)
    draw = random.Random(41)
    of = lambda letters, n: "".join(draw.choice(letters) for _ in range(n))
    every = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    rows, want = [], {}
    for n, (form, planted) in enumerate([(f, True) for f in HIDDEN for _ in range(15)] + [(f, False) for f in HARMLESS for _ in range(15)]):
        words = {"k": of(every, 24), "p": of(every, 14), "c": of(every + "+/", 40), "h": of("0123456789abcdef", 12), "w": invented(n + 5000, 1)}
        item = form.format(**words)
        head, tail = invented(n + 6000, 60) + " é ", " " + invented(n + 7000, 60)
        rows.append((n, head + item + tail))
        if planted:
            value = next(words[k] for k in "kpc" if "{" + k + "}" in form)
            begin = len(head) + item.index(value) - (4 if form.startswith("ghp_") else 0)
            want[n] = (begin, len(head) + item.index(value) + len(value))
    field = secrets_crf.fit([invented(k, 120) for k in range(9000, 9600)])
    got = {r.doc_id: [(s.start, s.end) for s in r.spans if s.kind == "crf"] for r in secrets_crf.scan(spark.createDataFrame(rows, "doc_id long, text string"), field, ["doc_id"]).collect()}
    added = sum(map(len, got.values()))
    hit = sum(want.get(n) == x for n, v in got.items() for x in v)
    print("recall", hit / len(want), "precision", hit / added)
    assert hit / len(want) >= 0.85 and hit / added >= 0.9


def test_marginals_equal_enumeration():
    from itertools import product

    draw = np.random.default_rng(6)
    emit, pairs = draw.normal(0, 1, (1, 4, 3)), draw.normal(0, 1, (3, 3))
    unary, joint, norm = secrets_crf._marginals(emit, pairs, np.ones((1, 4), bool))
    ways = list(product(range(3), repeat=4))
    weight = np.array([np.exp(sum(emit[0, t, w[t]] for t in range(4)) + sum(pairs[w[t], w[t + 1]] for t in range(3))) for w in ways])
    assert norm == pytest.approx(np.log(weight.sum()))
    for t in range(4):
        for y in range(3):
            assert unary[0, t, y] == pytest.approx(sum(x for w, x in zip(ways, weight) if w[t] == y) / weight.sum())
    assert joint.sum() == pytest.approx(3)


def test_scan_keeps_fixed_spans_and_masks(docs, corpus, no_docs):
    field, _ = trained()
    got = secrets_crf.scan(docs, field, ["doc_id", "text"], with_text=True).collect()
    assert len(got) == len(corpus)
    for r in got:
        spans = [(x.start, x.kind, x.end) for x in r.spans]
        assert [s for s in spans if s[1] != "crf"] == spans_by_hand(r.text)
        for start, kind, end in spans:
            assert 0 <= start < end <= len(r.text or "")
        assert (r.masked == (r.text or "")) == (not spans)
    assert secrets_crf.scan(no_docs, field, ["doc_id"]).collect() == []
    assert secrets_crf.mask("abcdef", [(1, "hex", 3), (2, "crf", 4)]) == "a[SECRET]ef"


def test_queries_over_odd_tables(spark, tables, corpus):
    from sparkmart.llm.queries import QUERIES

    got = QUERIES["op8_secret_crf"](spark, tables).collect()
    want = {}
    for r in corpus:
        line = ",".join(f"{k}:{s}:{e}" for s, k, e in spans_by_hand(r[1]))
        want[r[0]] = hashlib.sha256(line.encode()).hexdigest()
    assert {r.doc_id: r.base_sha256 for r in got} == want
    rows = QUERIES["op7_quality_rules"](spark, tables).collect()
    for r in rows:
        counts = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert counts == base_counts(next(x[1] for x in corpus if x[0] == r.doc_id))
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)


def overlaps_by_hand(docs, items):
    """All alignments of all items with all documents, without seeds."""
    split = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    out = set()
    for i, a in docs:
        for j, b in items:
            x, y = split(a), split(b)
            if len(y) < decontaminate.SPAN or len(x) < decontaminate.SPAN:
                continue
            for shift in range(-len(y) + 1, len(x)):
                same = [int(0 <= k + shift < len(x) and x[k + shift] == y[k]) for k in range(len(y))]
                size = min(decontaminate.STRETCH, len(y))
                best = max(sum(same[s : s + size]) for s in range(len(y) - size + 1))
                if best >= size * decontaminate.SHARE:
                    out.add((i, j))
    return out


def test_seeds_find_every_pattern_of_four_changes():
    masks = decontaminate.MASKS
    starts = range(decontaminate.STRETCH - decontaminate.SPAN + 1)
    for n in range(1, 5):
        for changed in combinations(range(decontaminate.STRETCH), n):
            assert any(all(s + k not in changed for k in m) for m in masks for s in starts)


def test_overlaps_equal_brute_force(spark, monkeypatch, folder):
    from tests_llm_helpers import invented

    draw = np.random.default_rng(8)
    items = [(k, invented(2000 + k, 12 + 5 * k)) for k in range(8)] + [(8, None), (9, ""), (10, "too short"), (11, invented(2002, 22))]
    docs = [(None, invented(1, 50)), (1, None), (2, ""), (3, "a b c")]
    for k in range(40):
        words = items[k % 8][1].split(" ")
        for at in draw.choice(len(words), int(draw.integers(0, 6)), replace=False):
            words[at] = f"q{k}x{at}"
        docs.append((10 + k, (invented(k, 30) + " " + " ".join(words) + ", " + invented(k + 77, 9)).title()))
    docs.append(docs[5])
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    want = overlaps_by_hand(docs, items)
    got = decontaminate.overlaps(d, b, f"{folder}/1").collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want)
    monkeypatch.setattr(decontaminate, "BLOCK_SEEDS", 50)  # the benchmark in several blocks
    assert {(r.doc_id, r.item_id) for r in decontaminate.overlaps(d, b, f"{folder}/2").collect()} == want
    left = decontaminate.clean(d, b, folder)
    assert left.columns == d.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(i) for i, _ in docs if i not in {x for x, _ in want})
    assert decontaminate.overlaps(d.limit(0), b, f"{folder}/3").collect() == []
    assert decontaminate.overlaps(d, b.limit(0), f"{folder}/4").collect() == []


def test_decontamination_runs_in_the_jvm(spark, tables):
    from sparkmart.llm.queries import QUERIES

    plan = QUERIES["op1_spaced_seeds"](spark, tables)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian", plan)


def test_language_model_counts_and_gain(spark, docs, corpus, folder, monkeypatch):
    for share in (bilinear.HEAD_SHARE, 0.01):  # with and without rare words beyond the head
        monkeypatch.setattr(bilinear, "HEAD_SHARE", share)
        rows = bilinear.score(docs, *bilinear.fit(docs, f"{folder}/{share}"), f"{folder}/{share}").collect()
        counts, tokens = Counter(), {}
        for r in corpus:
            words = [*WORD.findall(lowered(r[1])), None]
            tokens[r[0]] = words
            if zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 7 != 2:
                counts.update(words)
        n, v = sum(counts.values()), len(counts)
        assert len(rows) == len(corpus)
        for r in rows:
            words = tokens[r.doc_id]
            assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(counts[w] > 0 for w in words), n)
            assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words))
            assert r.score < 0


def test_language_model_is_normalised_and_learns(no_docs, folder):
    draw = np.random.default_rng(0)
    counts = np.zeros(bilinear.CLASSES, np.int64)
    counts[1:5] = 1000
    model = bilinear.Model(counts)
    walk = [1]
    for _ in range(60_000):  # mostly 1 2 3 4 1 2 ...
        walk.append(walk[-1] % 4 + 1 if draw.random() < 0.9 else int(draw.integers(1, 5)))
    walk = np.array(walk, np.int32)
    one, two = np.append(bilinear.START, walk[:-1]), np.append([bilinear.START] * 2, walk[:-2])
    before = model.scorer()(walk, one, two).mean()
    learn = model.trainer(1)
    for at in range(0, len(walk) - bilinear.BATCH, bilinear.BATCH):
        learn(*(x[at : at + bilinear.BATCH] for x in (walk, one, two)))
    score = model.scorer()
    assert score(walk, one, two).mean() > before + 0.1
    every = np.arange(bilinear.CLASSES)
    total = np.exp(score(every, np.full_like(every, 3), np.full_like(every, 2))).sum()
    assert total == pytest.approx(1, abs=1e-4)
    assert bilinear.score(no_docs, *bilinear.fit(no_docs, folder), folder).collect() == []


def test_rare_words_of_one_length_are_told_apart(spark, folder):
    """152 words of one length, rarer than 448 others, follow each other in pairs."""
    from sparkmart.llm import shared

    shared.ship(spark)
    draw = np.random.default_rng(3)
    out = [i for i in range(60_000) if zlib.crc32(str(i).encode()) % 7 == 2][:2]
    word = [f"w{i:03d}" for i in range(600)]
    rows = []
    for i in (i for i in range(4000) if i not in out):
        pairs = draw.integers(224, 300, 6) if i % 2 else draw.integers(0, 224, 30)
        rows.append((i, " ".join(f"{word[2 * j]} {word[2 * j + 1]}" for j in pairs)))
    tried = draw.permutation(np.arange(224, 300))
    right = " ".join(f"{word[2 * j]} {word[2 * j + 1]}" for j in tried)
    wrong = " ".join(f"{word[2 * j]} {word[2 * k + 1]}" for j, k in zip(tried, np.roll(tried, 1)))
    docs = spark.createDataFrame([*rows, (out[0], right), (out[1], wrong)], "doc_id long, text string").coalesce(2)
    vocabulary, counts, model = bilinear.fit(docs, folder)
    assert len(set(vocabulary.cls.tolist())) == 600
    got = {r.doc_id: r for r in bilinear.score(docs, vocabulary, counts, model, folder).collect()}
    assert got[out[0]].base_score == pytest.approx(got[out[1]].base_score)
    assert got[out[0]].score > got[out[1]].score + 5


def test_all_steps_of_the_language_model_are_normalised():
    draw = np.random.default_rng(1)
    model = bilinear.Model(draw.integers(0, 50, bilinear.CLASSES), draw.integers(1, 90, 3000))
    every = np.delete(np.arange(bilinear.CLASSES + 3001), bilinear.START)
    learn = model.trainer(2)
    for _ in range(20):
        learn(*(draw.choice(every, bilinear.BATCH) for _ in range(3)))
    for one, two in ((bilinear.START, bilinear.START), (every[-1], 3), (700, 2900)):
        total = np.exp(model.scorer()(every, np.full_like(every, one), np.full_like(every, two))).sum()
        assert total == pytest.approx(1, abs=1e-4)


def test_short_items_are_found_at_every_length(spark, folder):
    """All patterns with the most exchanges that the rule allows, for items of every length under 20."""
    items, docs, want = [], [], set()
    draw = np.random.default_rng(5)
    for n in range(1, decontaminate.STRETCH):
        words = [f"w{n}x{k}" for k in range(n)]
        items.append((n, " ".join(words)))
        most = n - math.ceil(n * decontaminate.SHARE)
        patterns = list(combinations(range(n), most))
        for at in draw.permutation(len(patterns))[:150]:
            text = ["other" if k in patterns[at] else w for k, w in enumerate(words)]
            docs += [(len(docs), " ".join(text)), (len(docs) + 1, "before " + " ".join(text) + " after")]
            want |= {(len(docs) - 2, n), (len(docs) - 1, n)}
        if n > most + 1:
            docs.append((len(docs), " ".join(["other"] * (most + 1) + words[most + 1 :])))  # one too many
        if most:
            docs.append((len(docs), " ".join(words[most:])))  # the text begins inside the item
            want.add((len(docs) - 1, n))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.overlaps(d, b, folder).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want)


def test_sql_of_overlaps_knows_short_items(spark, folder):
    import duckdb

    from tests_llm_helpers import invented

    whole = [invented(k + 400, n).split() for k, n in enumerate((1, 2, 3, 5, 7, 8, 11, 15, 19, 20, 30))]
    items = [(k, " ".join(w)) for k, w in enumerate(whole)] + [(90, None), (91, "")]
    rows = []
    for k, w in enumerate(whole):
        changed = list(w)
        for at in range(len(w) // 2, len(w), 6):
            changed[at] = "changed"
        rows += [(3 * k, "before " + " ".join(w) + " after"), (3 * k + 1, " ".join(changed)), (3 * k + 2, invented(k + 900, 40))]
    con = duckdb.connect()
    for name, key, table in (("benchmark", "item_id", items), ("documents", "doc_id", rows)):
        con.execute(f"CREATE TABLE {name} ({key} BIGINT, text VARCHAR)")
        con.executemany(f"INSERT INTO {name} VALUES (?, ?)", table)
    want = con.execute(decontaminate.OP1_SQL).fetchall()
    docs, benchmark = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.overlaps(docs, benchmark, folder).collect()
    assert sorted(map(tuple, got)) == sorted(want) and {r.item_id for r in got} == set(range(len(whole)))
