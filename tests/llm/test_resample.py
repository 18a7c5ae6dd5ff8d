"""Importance resampling against a plain version."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

from brute import LOWER
from pyspark.sql import functions as F

from brevetlake.llm import queries, resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def buckets(text):
    w = WORD.findall((text or "").translate(LOWER))
    grams = [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]
    return len(w), [zlib.crc32(g.encode()) % 10_000 for g in grams]


def brute(docs, target):
    """doc_id to n_features, weight, score and rank."""
    own = {d: buckets(t) for d, t in docs}
    s, t = Counter(b for _, bs in own.values() for b in bs), Counter(b for _, x in target for b in buckets(x)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + 10_000) / ((s[b] + 1) * (t_all + 10_000)))) for b in range(10_000)]
    out = {}
    for d, (n, bs) in own.items():
        h = int(hashlib.sha256(f"42:{d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in bs)
        out[d] = [n, len(bs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None]
    fit = sorted((d for d in out if out[d][0] >= 20), key=lambda d: (-out[d][3], d))
    for rank, d in enumerate(fit[: 5 * len(fit) // 100], 1):
        out[d][4] = rank
    return {d: tuple(x[1:]) for d, x in out.items()}


def found(spark, docs, target, extra=False):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    if extra:
        for name in ("row", "words", "w1", "b1", "bucket", "gain", "weight", "score", "rank", "n_words", "dealt_to"):
            df = df.withColumn(name, F.lit("clash"))
    got = resample.resample(df, spark.createDataFrame(target, "item_id long, text string")).collect()
    assert len(got) == len(docs)
    return {r.doc_id: (r.n_features, r.weight, r.score, r["rank"]) for r in got}


def texts(seed, n):
    rng = random.Random(seed)
    word = lambda: rng.choice(["Ab", "ÉTÉ", "x1", "a-b", "don't", "日本", "w\x00v", "the", "THE"]) + str(rng.randrange(30))
    return [" ".join(word() for _ in range(rng.randrange(60))) for _ in range(n)]


def test_resample(spark):
    docs = list(enumerate([None, "", " ", "...", "one", "one two", "one two three", "é" * 3000, "same " * 40, "same " * 40, "w " * 60_000, *texts(1, 300)]))
    target = list(enumerate([None, "", *texts(2, 30)]))
    assert found(spark, docs, target, extra=True) == brute(docs, target)


def test_no_documents_and_no_target(spark):
    docs = list(enumerate(texts(3, 50)))
    assert found(spark, [], [(1, "a b c")]) == {}
    assert found(spark, docs, []) == brute(docs, [])


def test_repeated_and_missing_ids(spark):
    text = " ".join(f"w{k}" for k in range(25))
    rows = [(1, text), (1, text), (None, text), (2, "short")] + [(k, text) for k in range(3, 40)]
    got = resample.resample(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, text)], "item_id long, text string")).collect()
    assert len(got) == len(rows)
    assert len({(r.n_features, r.weight) for r in got}) == 2
    assert sorted(r["rank"] for r in got if r["rank"] is not None) == [1, 2]  # 5 % of 40


def test_the_sample_comes_nearer_to_the_target(spark):
    rng = random.Random(4)
    near, far = [f"n{k}" for k in range(40)], [f"f{k}" for k in range(400)]
    docs = [(d, " ".join(rng.choice(near if d % 10 == 0 else far) for _ in range(30))) for d in range(800)]
    got = found(spark, docs, [(k, " ".join(rng.choice(near) for _ in range(30))) for k in range(20)])
    drawn = [d for d, x in got.items() if x[3] is not None]
    assert len(drawn) == 40 and all(d % 10 == 0 for d in drawn)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = lambda name, key: [(r[key], r.text) for r in spark.read.parquet(f"{folder}/{name}.parquet").collect()]
    got = {r.doc_id: (r.n_features, r.weight, r.score, r["rank"]) for r in queries.op13_resample(spark, folder).collect()}
    assert got == brute(rows("documents", "doc_id"), rows("benchmark", "item_id"))
