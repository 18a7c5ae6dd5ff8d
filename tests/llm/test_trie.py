"""The prefix trie against a version that builds every prefix as a tuple."""

import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from brevetlake.llm import queries, ranks, trie

SCHEMA = "conv_id long, turn long, role string, text string"


def content(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def brute(rows):
    """(conv_id, depth) to parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256."""
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, content(role or "", text or ""), (role or "", text or "")))
    turns = {c: [t[3] for t in sorted(ts)] for c, ts in turns.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = tuple(turns.get(c - int(math.fmod(c, 20)), [])[:h] + own[h:])  # as in SQL, the rest of a negative id is negative
    members = {}
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    children = {p: [] for p in members}
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        leaves[p] = sum(leaves[c] for c in children[p]) or 1
        saved[p] = (len(members[p]) - 1) * words + sum(saved[c] for c in children[p])
    sha = lambda p: hashlib.sha256(",".join(str(c) for c in sorted(members[p]) if len(rebuilt[c]) == len(p)).encode()).hexdigest()
    return {(min(m), len(p)): (min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p], sha(p)) for p, m in members.items()}


def found(spark, rows, extra=False):
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        for name in ("depth", "content", "words", "at", "n", "base", "rep", "block", "a", "dealt_to"):
            df = df.withColumn(name, F.lit("clash"))
    got = trie.trie(*trie.rebuild(trie.turns_of(df))).collect()
    out = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in got}
    assert len(out) == len(got)
    return out


def conversations(rng, n, ids=400, vocabulary=3, longest=9):
    """Few different turns, so that prefixes are shared; nulls, ties and gaps among the turns."""
    rows = []
    for c in rng.sample(range(-40, ids), n):
        for k in range(rng.randrange(1, longest)):
            turn = rng.choice([k, k, k, k, 0, None])
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice([None, "", *(f"word {j} " * (j + 1) for j in range(vocabulary))])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_trie(spark, seed, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK_BITS", 3)
    monkeypatch.setattr(trie, "RUN_BITS", 2 if seed == 1 else 10)
    rows = conversations(random.Random(seed), 220)
    rows += [(None, 1, "user", "nobody's"), (7000, 1, "user", "x"), (7000, 1, "user", "x"), (7001, None, None, None)]
    assert found(spark, rows, extra=True) == brute(rows)


def test_copies_and_a_long_conversation(spark, monkeypatch):
    """Many conversations that end at one node in several blocks of ids, one that has a third of all rows, and its snapshots after each turn."""
    monkeypatch.setattr(trie, "BLOCK_BITS", 4)
    monkeypatch.setattr(trie, "RUN_BITS", 5)
    rng = random.Random(3)
    rows = [(c, k, "user", f"same {k}") for c in range(20, 320) for k in range(3)]
    rows += [(1000, k, "user", f"turn {k} " + "word " * rng.randrange(5)) for k in range(500)]
    rows += [(2000 + c, k, "user", f"shot {k}") for c in range(40) for k in range(c + 4)]
    assert found(spark, rows) == brute(rows)


def test_rounds_grow_slowly(spark, monkeypatch):
    """A conversation's snapshots hang on each other, one turn after the other: rounds follow their logarithm."""
    rows = [(c, k, "user", f"turn {k}") for c in range(0, 2400, 20) for k in range(c // 20 + 4)]
    rounds = []
    monkeypatch.setattr(trie, "discard", rounds.append)
    assert found(spark, rows) == brute(rows)
    assert len(rounds) <= 16


def test_no_conversation(spark):
    assert found(spark, []) == {}
    assert found(spark, [(None, 1, "user", "x")]) == {}


def test_a_conversation_without_turns_of_its_own(spark):
    rows = [(c, 0, "user", "only") for c in range(21, 40)]
    got = found(spark, rows)
    assert got == brute(rows)
    assert len({d for _, d in got}) == 2 and got[21, 0][1] == 19


def test_very_long_text(spark):
    rows = [(40, 0, "user", "w " * 300_000), (41, 0, "user", "w " * 300_000), (42, 0, "user", "w " * 300_000 + "x")]
    assert found(spark, rows) == brute(rows)


def test_query_reads_the_whole_table(spark):
    df = queries.op11_prefix_trie(spark, "/root/testdata/sf0.001")
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect()} == brute(rows)


def test_ranks(spark):
    rng = random.Random(5)
    rows = [(rng.choice("aaaab"), rng.randrange(50), k) for k in range(900)]
    df = ranks.ranked(spark.createDataFrame(rows, "g string, x long, k long"), ["g"], [F.col("x").desc(), "k"], "rank")
    want = {}
    for g in "ab":
        for i, r in enumerate(sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2])), 1):
            want[r[2]] = i
    assert {r.k: r["rank"] for r in df.collect()} == want
