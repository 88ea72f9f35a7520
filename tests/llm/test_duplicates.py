import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from sparkmart.llm import setsketch, suffix
from tests_llm_helpers import corpus, docs, folder, no_docs, word_sets  # noqa: F401


def components_of(rows):
    """Brute force over all pairs: smallest reachable id by id."""
    sets = word_sets(rows)
    ids = [i for i in sets if i is not None]
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and sets[a] and sets[b] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return sets, {i: find(i) for i in ids}


def check(spark, docs, rows, folder):
    sets, want = components_of(rows)
    got = setsketch.near_duplicates(docs, folder).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.n_shingles == len(sets[r.doc_id])
        assert r.component_id == (want[r.doc_id] if r.doc_id is not None else None)
        assert r.kept == (r.doc_id is None or r.doc_id == want[r.doc_id])


def test_near_duplicates_equal_brute_force(spark, docs, corpus, folder):
    check(spark, docs, corpus, folder)


@pytest.mark.parametrize("block", [400, 7])
def test_chains_and_groups_around_the_threshold(spark, folder, block, monkeypatch):
    """Copies with growing numbers of changes: some link only through others, clusters hold several
    components, and with small blocks all cuts and the last comparison are needed."""
    monkeypatch.setattr(setsketch, "BLOCK_SETS", block)
    monkeypatch.setattr(setsketch, "TASK_LINKS", block)
    from tests_llm_helpers import invented

    draw = np.random.default_rng(5)
    rows = []
    for g in range(3):
        words = invented(1000 + g, 150).split(" ")
        for k in range(25):
            out = list(words)
            for at in draw.choice(150, int(draw.integers(0, 9)), replace=False):
                out[at] = f"w{g}x{k}x{at}"
            rows.append((100 * g + k, " ".join(out)))
    check(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(4), rows, folder)


def test_components_of_chains_and_stars(spark, folder, monkeypatch):
    """Links in several tasks, so that star steps are needed."""
    monkeypatch.setattr(setsketch, "TASK_LINKS", 20)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(300, 160 + 1000), (160 + 1000, 159), (7, 7)]
    df = spark.createDataFrame(links, "a long, b long").repartition(5)
    got = {r.node: r.label for r in setsketch.components(df, folder, "x").collect()}
    want = {i: 0 for i in range(61)} | {i: 100 for i in [*range(100, 160), 300, 1160]}
    assert got == want


def test_empty_tables(no_docs, folder):
    assert setsketch.near_duplicates(no_docs, folder).collect() == []
    assert suffix.without_repeats(no_docs, folder).collect() == []


def test_registers_merge_and_estimate():
    draw = np.random.default_rng(1)
    every = draw.integers(0, 2**63, 3000).astype(np.uint64)
    for overlap in (0.2, 0.5, 0.75, 0.95):
        n = int(2000 * overlap / (1 + overlap))
        one, other = every[:1000], np.concatenate([every[:n], every[1000 : 2000 - n]])
        a, b = (setsketch.registers(x, np.array([0]))[0] for x in (one, other))
        union = setsketch.registers(np.concatenate([one, other]), np.array([0]))[0]
        assert (setsketch.merge(a, b) == union).all()
        j = setsketch.joint_estimate(np.array([(a > b).sum()]), np.array([(a < b).sum()]), np.array([1000]), np.array([1000]))[0]
        assert abs(j - overlap) < 0.2


def removed_by_brute_force(rows):
    texts = [(r[1] or "").encode() for r in rows]
    seen = Counter(t[k : k + 200] for t in texts for k in range(len(t) - 199))
    out = []
    for row, t in zip(rows, texts):
        gone = bytearray(len(t))
        for k in range(len(t) - 199):
            if seen[t[k : k + 200]] > 1:
                gone[k : k + 200] = b"\1" * 200
        kept = bytes(x for x, g in zip(t, gone) if not g)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((row[0], len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [suffix.HOT_UNITS, 1])
def test_repeated_strings_equal_brute_force(spark, docs, corpus, folder, hot, monkeypatch):
    whole = suffix.repeated_runs
    monkeypatch.setattr(suffix, "repeated_runs", lambda d, f: whole(d, f, hot))
    few = [r for r in corpus if len(r[1] or "") < 100_000]  # brute force holds all strings
    rows = docs.where("text IS NULL OR length(text) < 100000")
    got = sorted((tuple(r) for r in suffix.without_repeats(rows, folder).collect()), key=str)
    assert got == removed_by_brute_force(few)


def test_long_texts(spark, docs, corpus, folder):
    got = suffix.without_repeats(docs, folder, with_bytes=True).where("n_bytes > 200000").collect()
    assert len(got) == 2 and all(r.n_removed == r.n_bytes and r.n_spans == 1 and bytes(r.kept) == b"" for r in got)


def test_two_stage_order_is_the_suffix_order():
    draw = np.random.default_rng(2)
    for letters in (2, 4, 26):
        units = [bytes(draw.integers(97, 97 + letters, int(n)).astype(np.uint8)) for n in draw.integers(1, 80, 30)]
        text = np.frombuffer(b"\xff".join(units) + b"\xff", np.uint8) + np.uint8(1)
        order = suffix.suffix_order(text, np.ones(len(text), bool), len(text))
        raw = text.tobytes()
        assert order.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:] + b"") or [raw[i:] for i in order] == sorted(raw[i:] for i in range(len(raw)))
        same = suffix.common_prefix(text, order, 200)
        for k in range(1, len(order)):
            a, b = raw[order[k - 1] :], raw[order[k] :]
            n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert same[k] == min(n, 200)
