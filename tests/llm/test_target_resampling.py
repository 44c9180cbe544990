"""Resampling against counts and sorting in plain Python."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter

import pytest

from outledger.llm import target_resampling as tr

FOLDER = "/root/testdata/sf0.001"
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def features(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(w), [zlib.crc32(f.encode()) % 10000 for f in w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]]


def brute(docs, target, percent=25, least=20):
    s = Counter(b for _, t in docs for b in features(t)[1])
    t = Counter(b for x in target for b in features(x)[1])
    n, m = sum(s.values()) + 10000, sum(t.values()) + 10000
    rows = []
    for doc, text in docs:
        words, found = features(text)
        weight = 0
        if found:
            weight = sum(math.floor(1000 * math.log((t[b] + 1) * n / ((s[b] + 1) * m))) for b in found) // len(found)
        score = None
        if doc is not None:
            h = int(hashlib.sha256(f"7:{doc}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc, len(found), weight, score, None, words])
    able = sorted((r for r in rows if r[3] is not None and r[5] >= least), key=lambda r: (-r[3], r[0]))
    for k, row in enumerate(able[: percent * len(able) // 100]):
        row[4] = k + 1
    return sorted((tuple(r[:5]) for r in rows), key=str)


def result(spark, docs, target, **how):
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as score", "2 as low", "3 as pos")
    rows = tr.resampled(df, spark.createDataFrame([(x,) for x in target], "text string"), **how).collect()
    return sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in rows), key=str)


def made(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Éa", "ß", "A-b", "x_y"]
    docs = [(i, " ".join(rng.choices(words, k=rng.choice([0, 1, 19, 20, 60])))) for i in range(-3, 400)]
    docs += [(None, None), (None, docs[9][1]), (500, None), (501, ""), (502, "!!! ..."), docs[8], docs[8], docs[8]]
    return docs, [" ".join(rng.choices(words[:20], k=30)) for _ in range(8)] + [None, ""]


@pytest.mark.parametrize("seed", range(2))
def test_made_documents(spark, monkeypatch, seed):
    if seed:  # coarse sketch, narrow bracket, small parts
        for name, value in (("ACCURACY", 5), ("HALF_WIDTH", 1e-6), ("CHUNK_BYTES", 100)):
            monkeypatch.setattr(tr, name, value)
    docs, target = made(seed)
    assert result(spark, docs, target) == brute(docs, target)


@pytest.mark.parametrize("percent", [0, 1, 99, 100])
def test_shares(spark, percent):
    docs, target = made(7)
    assert result(spark, docs, target, percent=percent) == brute(docs, target, percent)


def test_equal_rows_at_the_cutoff(spark):
    docs = [(1, "a " * 30)] * 8
    assert Counter(r[4] for r in result(spark, docs, [])) == Counter([1, 2] + [None] * 6)


def test_given_documents(spark):
    if not os.path.isdir(FOLDER):
        pytest.skip("no test data")
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    assert result(spark, docs, target) == brute(docs, target)


def test_drawn_documents_and_empty_tables(spark):
    docs, target = made(3)
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as row")
    targets = spark.createDataFrame([(x,) for x in target], "text string")
    drawn = tr.drawn_documents(df, targets)
    ranks = {r[0] for r in brute(docs, target) if r[4]}
    assert drawn.columns == ["doc_id", "text", "row"] and {r.doc_id for r in drawn.collect()} == ranks
    assert result(spark, [], target) == [] and len(result(spark, docs, [])) == len(docs)
