"""The n-gram join and connected components against brute force."""

import os
import random
import re

import pytest

from outledger.llm import ngram_join
from outledger.llm.components import components

FOLDER = "/root/testdata/sf0.01"


def shingles(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not w:
        return set()
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))}


def brute(docs):
    sets = [(d, shingles(t)) for d, t in docs]
    up = list(range(len(sets)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, (_, x) in enumerate(sets):
        for j in range(i):
            y = sets[j][1]
            n = len(x & y)
            if x and y and 100 * n >= 75 * (len(x) + len(y) - n):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return sorted(((d, len(x), least.get(root(i)) if x else d) for i, (d, x) in enumerate(sets)), key=str)


def result(df, **more):
    rows = ngram_join.jaccard_components(df, **more).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=str)


def made(seed, n=260):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = rng.choices(vocabulary, k=70)
    docs = [(None, None), (-1, ""), (-2, " \n"), (-3, "one"), (-4, "ONE"), (-5, "one two"), (None, "one")]
    pool = []
    for d in range(n):
        kind = rng.random()
        if kind < 0.35 or not pool:
            words = rng.choices(vocabulary, k=rng.choice([3, 5, 6, 9, 40, 120, 400]))
            if kind < 0.15:
                at = rng.randint(0, len(words))
                words[at:at] = passage
        else:
            words = list(rng.choice(pool[-40:]))
            for _ in range(rng.choice([0, 1, 1, 2, 3, len(words) // 40])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        pool.append(words)
        docs.append((d, " ".join(words).upper() if rng.random() < 0.2 else "\t".join(words)))
    return docs + docs[20:30]


@pytest.mark.parametrize("seed", range(2))
def test_components_of_made_documents(spark, monkeypatch, seed):
    if seed:  # small chunks, all shared shingles noted, many tiles
        monkeypatch.setattr(ngram_join, "HOT_IN_CHUNK", 2)
    docs = made(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as set_id", "'x' as size")
    assert result(df, block=4 if seed else 1024) == brute(docs)


def test_components_of_given_documents(spark):
    if not os.path.isdir(FOLDER):
        pytest.skip("no test data")
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(500)
    assert result(rows) == brute([(r.doc_id, r.text) for r in rows.collect()])


def family(n, edits, seed=3):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(5000)]
    first = rng.choices(vocabulary, k=300)
    docs = []
    for d in range(n):
        words = list(first)
        for at in rng.sample(range(300), edits):
            words[at] = rng.choice(vocabulary)
        docs.append((d, " ".join(words)))
    return docs


@pytest.mark.parametrize("edits", [4, 5, 6])
def test_rows_of_tiles_grow_with_members(spark, monkeypatch, edits):
    made_by, counts = ngram_join.tile_pairs, []

    def counted(*args, **more):
        rows = ngram_join.pin(made_by(*args, **more))
        counts.append(rows.where("a is not null").count())
        return rows

    monkeypatch.setattr(ngram_join, "tile_pairs", counted)
    totals = {}
    for n in (100, 300):
        counts.clear()
        docs = family(n, edits)
        got = result(spark.createDataFrame(docs, "doc_id long, text string"))
        totals[n] = sum(counts)
        if n == 100:
            assert got == brute(docs)
    assert totals[300] <= 5 * 300  # four tasks, each at most once a component and round


@pytest.mark.parametrize("large", [3])
def test_groups_in_parts(spark, monkeypatch, large):
    monkeypatch.setattr(ngram_join, "GROUP_ROWS", 2)
    monkeypatch.setattr(ngram_join, "LARGE_GROUP", large)
    monkeypatch.setattr(ngram_join, "REMEMBERED", 5)
    monkeypatch.setattr(ngram_join, "TILE_BYTES", 9000)
    docs = made(9, 150) + [(1000 + d, t) for d, t in family(30, 4)]
    assert result(spark.createDataFrame(docs, "doc_id long, text string")) == brute(docs)


def test_one_row_of_repeated_ones(spark):
    df = spark.createDataFrame([(1, "a b c", "y"), (1, "a b c", "x"), (2, "A B C", "a"), (3, None, "n")], "doc_id long, text string, row string")
    assert sorted(map(tuple, ngram_join.one_per_component(df).collect())) == [(1, "a b c", "x"), (3, None, "n")]


def test_empty_table(spark):
    assert result(spark.createDataFrame([], "doc_id long, text string")) == []


def test_signatures_bound_the_overlap():
    rng = random.Random(4)
    words = [f"a{i}" for i in range(60)]
    for _ in range(300):
        x = [rng.choice(words) for _ in range(rng.randint(5, 200))]
        y = [w if rng.random() < 0.97 else rng.choice(words) for w in x] + x[: rng.randint(0, 30)]
        p, q = ngram_join.shingle_sets([" ".join(x).encode(), " ".join(y).encode()])
        m, n = ngram_join.signature(p), ngram_join.signature(q)
        k = min(len(m), len(n))
        bits = int(ngram_join.np.bitwise_count(ngram_join.fold(m, k) ^ ngram_join.fold(n, k)).sum())
        both = len(set(p.tolist()) & set(q.tolist()))
        assert 2 * both <= len(p) + len(q) - bits
        assert len(p) == len(shingles(" ".join(x)))


def test_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201)]
    rng = random.Random(1)
    rng.shuffle(chain)
    df = spark.createDataFrame(chain, "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    want = {i: 0 for i in range(61)} | {i: 100 for i in range(100, 160)} | {200: 200, 201: 200}
    assert got == want
