"""Prefix trie against a plain version that walks every path."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import types as T

from sparkmart.llm import prefix_trie, shared
from tests_llm_helpers import folder  # noqa: F401

CONVERSATIONS = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("conv_id", "turn")]
    + [T.StructField(c, T.StringType()) for c in ("role", "text", "owner", "depth", "s1", "band", "rank")]
)


def plain(rows):
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        built[c] = tuple(own.get(base, [])[:h] + v[h:])
    members, ends = defaultdict(set), defaultdict(list)
    for c, v in built.items():
        for d in range(len(v) + 1):
            members[v[:d]].add(c)
        ends[v].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node in members:
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for a in range(len(node) + 1):
            saved[node[:a]] += (len(members[node]) - 1) * words
            leaves[node[:a]] += children[node] == 0
    return sorted(
        (
            min(m), len(node), min(members[node[:-1]]) if node else None, len(m), children[node], leaves[node], saved[node],
            hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
        )
        for node, m in members.items()
    )


def sample(seed: int) -> list[tuple]:
    draw = random.Random(seed)
    extra = ("x",) * 5
    rows = []
    for conv in [*range(0, 90), 10**12, 10**12 + 7, -3, -20, -41]:
        kind = draw.choice("abc")
        for turn in range(draw.randint(1, 9)):
            rows.append((conv, turn, draw.choice(["user", None, ""]), f"{kind} {draw.choice('xyz')} w", *extra))
    rows += [(200, t, "user", f"t {t % 3}", *extra) for t in range(700)]  # one long conversation
    rows += [(220 + k, t, "user", f"t {t % 3}", *extra) for k in range(9) for t in range(40)]  # copies
    rows += [(301, 5, "a", "b", *extra)] * 4  # repeated rows
    rows += [(None, 1, "a", "b", *extra), (302, None, None, None, *extra), (302, None, None, None, *extra), (302, 1, "r", "é　ü \t x", *extra)]
    rows += [(303, 1, "ab", "c", *extra), (304, 1, "a", "bc", *extra)]
    return rows


def found(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("height", [3, 32])
def test_all_nodes(spark, folder, height):
    shared.ship(spark)
    rows = sample(height)
    df = spark.createDataFrame(rows, CONVERSATIONS).repartition(5)
    assert found(prefix_trie.trie(df, folder, height)) == plain(rows)


def test_turns_of_one_conversation_are_spread_over_tasks(spark, folder):
    shared.ship(spark)
    rows = [(7, t, "user", f"t {t}") for t in range(5000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        own = prefix_trie.turns(df, folder)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = spark.read.parquet(f"{folder}/turns").groupBy("part").count().collect()
    assert len(parts) > 1 and max(p["count"] for p in parts) < 4000
    assert sorted(r["rank"] for r in own.select("rank").collect()) == list(range(1, 5001))
    # Carried sums equal those of a single run.
    x, mod = 0, 1 << 64
    hashed = {r.t: r.x % mod for r in df.selectExpr("turn t", "xxhash64(1, role, text) x").collect()}
    for t in range(5000):
        x = (x + hashed[t] * pow(int(prefix_trie._BASES[0]), t + 1, mod)) % mod
    assert own.where("rank = 5000").first().s1 % mod == x


def test_ids_that_end_at_one_node_in_several_texts(spark, folder, monkeypatch):
    shared.ship(spark)
    monkeypatch.setattr(prefix_trie, "CHUNK", 50)
    ends = spark.createDataFrame([(0, 3, k * 7) for k in range(400)] + [(1, 3, 5)], "owner long, depth long, conv_id long").repartition(3)
    got = {r.conv_id: r.ends_sha256 for r in prefix_trie.end_digests(ends, folder).collect()}
    want = hashlib.sha256(",".join(str(k * 7) for k in range(400)).encode()).hexdigest()
    assert got == {0: want, 1: hashlib.sha256(b"5").hexdigest()}


def test_no_conversations(spark, folder):
    shared.ship(spark)
    assert found(prefix_trie.trie(spark.createDataFrame([], CONVERSATIONS), folder)) == []
    none = spark.createDataFrame([(None, 1, "a", "b", *"vwxyz")], CONVERSATIONS)
    assert found(prefix_trie.trie(none, f"{folder}/2")) == []


def test_only_conversations_without_turns(spark, folder):
    shared.ship(spark)
    conv = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4)
    df = spark.createDataFrame([(conv, 1, "a", "b", *"vwxyz")], CONVERSATIONS)
    assert found(prefix_trie.trie(df, folder)) == plain([(conv, 1, "a", "b")])
