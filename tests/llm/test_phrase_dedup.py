"""Removal of repeated passages against a dictionary of all 13-word windows."""

import hashlib
import os
import random
import re

import pytest

from outledger.llm import phrase_dedup as pd_

FOLDER = "/root/testdata/sf0.001"


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(docs):
    least = {}
    for doc, text in docs:
        w = split(text)
        for i in range(len(w) - 12):
            if doc is not None:
                k = tuple(w[i : i + 13])
                least[k] = min(least.get(k, doc), doc)
    out = []
    for doc, text in docs:
        w = split(text)
        gone = [False] * len(w)
        for i in range(len(w) - 12):
            if doc is not None and least[tuple(w[i : i + 13])] < doc:
                gone[i : i + 13] = [True] * 13
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((doc, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    rows = pd_.without_repeats(df).collect()
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rows), key=str)


def made(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "b"] if seed == 0 else [f"w{i}" for i in range(300)] + ["É", "ß"]
    text = lambda n: rng.choices(vocabulary, k=n)
    docs = [(None, None), (1, ""), (2, " \n"), (3, "x " * 12), (4, "y " * 13), (5, "y " * 40), (-6, "z " * 30)]
    passages = [text(n) for n in (12, 13, 14, 30, 90, 400)]
    for d in range(10, 70):
        words = text(rng.choice([0, 3, 20, 90]))
        for _ in range(rng.choice([0, 1, 2, 4])):
            p = rng.choice(passages)
            p = p[rng.randint(0, len(p) // 2) :][: rng.randint(10, len(p))]
            if rng.random() < 0.4:
                p = [*p[:-3], "#", *p[-2:]]
            words += p + text(rng.choice([0, 0, 1, 30]))
        docs.append((d, rng.choice([" ", "\t\n", "  "]).join(words)))
    docs += [(80, docs[30][1]), (80, docs[31][1]), (80, docs[30][1]), docs[40], docs[40], (None, docs[33][1])]
    return docs


@pytest.mark.parametrize("seed", range(4))
def test_made_documents(spark, monkeypatch, seed):
    if seed >= 2:  # many shards, owners in parts, several tasks a shard, many chunks and segments
        for name, value in (("PATTERNS", 40), ("OWNER_ANCHORS", 5), ("STREAM_ROWS", 3), ("CHUNK_BYTES", 300), ("SEGMENT", 7)):
            monkeypatch.setattr(pd_, name, value)
    docs = made(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    df = df.selectExpr("*", "1 as shard", "'x' as anchors", "2 as text_key", "3 as ranges", "4 as owner")
    assert result(df) == brute(docs)


def test_given_documents(spark):
    if not os.path.isdir(FOLDER):
        pytest.skip("no test data")
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert result(rows) == brute([(r.doc_id, r.text) for r in rows.collect()])


def test_smallest_holder_is_not_streamed(spark):
    words = " ".join(f"k{i}" for i in range(40))
    docs = [(5, words), (7, "a " + words), (9, words + " b"), (11, "c " * 40)]
    df = pd_.texts(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text")
    df = df.withColumn("text_key", pd_.text_key())
    held = pd_.pin(pd_.suspects(df, pd_.anchor_lists(df, pd_.pin(pd_.anchor_owners(df)))))
    assert {r.doc_id for r in held.collect()} == {5, 7, 9}
    assert {r.doc_id for r in pd_.stretches(held).collect()} == {7, 9}


def test_kept_texts(spark):
    words = [f"k{i}" for i in range(20)]
    docs = [(1, " ".join(words)), (2, "a " + " ".join(words[:14]) + " b"), (3, None)]
    rows = pd_.kept_texts(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.text) for r in rows) == [(1, " ".join(words)), (2, "a b"), (3, None)]


def test_empty_table(spark):
    assert result(spark.createDataFrame([], "doc_id long, text string")) == []
