"""Removal of repeated strings against a dictionary of all 200-byte strings."""

import hashlib
import os
import random
from collections import Counter

import pytest

from outledger.llm import substring_dedup as sd

FOLDER = "/root/testdata/sf0.001"


def brute(docs):
    data = [(t or "").encode() for _, t in docs]
    seen = Counter(b[i : i + 200] for b in data for i in range(len(b) - 199))
    out = []
    for (doc, _), b in zip(docs, data, strict=True):
        gone = bytearray(len(b))
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        rest = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc, len(b), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=str)


def result(df):
    rows = sd.without_repeats(df).collect()
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows), key=str)


def made(seed):
    rng = random.Random(seed)
    letters = "abcdefghij klmnop\n" if seed else "ab"
    text = lambda n: "".join(rng.choices(letters, k=n))
    docs = [(None, None), (1, ""), (2, "x" * 199), (3, "y" * 200), (4, "z" * 1000), (5, "é" * 150), (6, "z" * 450)]
    passages = [text(n) for n in (199, 200, 201, 230, 360, 700, 2500)]
    for d in range(10, 90):
        parts = [text(rng.choice([0, 3, 50, 400]))]
        for _ in range(rng.choice([0, 1, 2, 4])):
            p = rng.choice(passages)
            cut = rng.randint(0, len(p) // 2)
            p = p[cut : cut + rng.randint(150, len(p))]
            if rng.random() < 0.4 and p:
                at = rng.randrange(len(p))
                p = p[:at] + "#" + p[at + 1 :]
            parts += [p, text(rng.choice([0, 0, 1, 60]))]
        docs.append((d, "".join(parts)))
    period = text(37) * 30
    docs += [(100, period), (101, text(90) + period[5:700]), (102, docs[30][1]), (102, docs[31][1])]
    return docs + [docs[40], (None, passages[5])]


@pytest.mark.parametrize("seed", range(3))
def test_made_documents(spark, monkeypatch, seed):
    if seed == 2:
        monkeypatch.setattr(sd, "PIECE", 300)  # texts split in many pieces
    docs = made(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as place", "'x' as inner")
    assert result(df) == brute(docs)


def test_given_documents(spark):
    if not os.path.isdir(FOLDER):
        pytest.skip("no test data")
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert result(rows) == brute([(r.doc_id, r.text) for r in rows.collect()])


def test_empty_table(spark):
    assert result(spark.createDataFrame([], "doc_id long, text string")) == []


def test_cover_samples_equal_strings_at_equal_offsets():
    rng = random.Random(8)
    core = bytes(rng.choices(range(97, 103), k=330))
    x = sd.np.frombuffer(bytes(rng.choices(range(97, 103), k=77)) + core + b"x" * 50, sd.np.uint8)
    y = sd.np.frombuffer(b"q" * 9 + core + bytes(rng.choices(range(97, 103), k=90)), sd.np.uint8)
    found = []
    for data, begin in ((x, 77), (y, 9)):
        h = sd.Prints(data).of(sd.np.arange(len(data) - sd.ANCHOR + 1), sd.ANCHOR)
        for p in range(begin, begin + len(core) - sd.LENGTH + 1):
            found.append(int(sd.np.argmin(h[p : p + sd.LENGTH - sd.ANCHOR + 1])))
    half = len(found) // 2
    assert found[:half] == found[half:]
