"""Prefix trie against a dictionary of all prefixes."""

import hashlib
import os
import random
import re
import zlib
from collections import defaultdict

import pytest

from outledger.llm import conversation_trie as ct

FOLDER = "/root/testdata/sf0.001"
COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def brute(rows, group=20, heads=4):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            turns[conv].append(((turn is not None, turn or 0, tie), (role, text)))
    said = {c: [t for _, t in sorted(v)] for c, v in turns.items()}
    convs = {}
    for c, own in said.items():
        h = zlib.crc32(str(c).encode()) % heads
        base = c - (abs(c) % group) * (1 if c >= 0 else -1)
        convs[c] = said.get(base, [])[:h] + own[h:]
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    children = defaultdict(list)
    for k in members:
        if k:
            children[k[:-1]].append(k)
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in children[k]) or 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        saved[k] = (len(members[k]) - 1) * words + sum(saved[x] for x in children[k])
    out = []
    for k, m in members.items():
        ends = ",".join(str(c) for c in m if len(convs[c]) == len(k))
        parent = members[k[:-1]][0] if k else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        out.append((m[0], len(k), parent, len(m), len(children[k]), leaves[k], saved[k], sha))
    return sorted(out, key=str)


def result(df, **how):
    return sorted((tuple(r[c] for c in COLUMNS) for r in ct.prefix_trie(df, **how).collect()), key=str)


SCHEMA = "conv_id long, turn long, role string, text string"


def made(seed):
    rng = random.Random(seed)
    say = lambda: rng.choice(["a b", "a  b", "", None, "é\tß c", "d"])
    rows = [(None, 0, "user", "x"), (7, None, "user", "first"), (7, None, None, None), (7, -1, "user", "second")]
    rows += [(7, 0, "user", "tie"), (7, 0, "bot", "tie"), (7, 0, "bot", "tie")]
    pool = [[("user" if i % 2 else "bot", say()) for i in range(rng.choice([1, 2, 3, 5, 40]))] for _ in range(12)]
    for c in [*range(-25, 90), 10**12, 10**12 + 1]:
        talk = list(rng.choice(pool))[: rng.choice([1, 2, 4, 50])]
        if rng.random() < 0.3:
            talk += [(rng.choice([None, "user"]), say()) for _ in range(rng.choice([1, 2, 60]))]
        order = list(enumerate(talk))
        rng.shuffle(order)
        rows += [(c, 3 * i, *t) for i, t in order]
    return rows


@pytest.mark.parametrize(("top", "band", "least", "piece"), [(8, 200_000, 64, 4096), (1, 30, 1, 2), (3, 300, 2, 3)])
def test_made_conversations(spark, monkeypatch, top, band, least, piece):
    for name, value in (("TOP", top), ("BAND_ROWS", band), ("LEAST_HEAVY", least), ("PIECE_IDS", piece)):
        monkeypatch.setattr(ct, name, value)
    rows = made(top)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as path", "2 as i", "3 as key", "4 as depth")
    assert result(df) == brute(rows)


def test_conversations_as_they_are(spark):
    rows = made(5)
    assert result(spark.createDataFrame(rows, SCHEMA), heads=1) == brute(rows, heads=1)


def test_turnless_conversation(spark):
    # Find one whose only turn is replaced by that of an absent conversation.
    c = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 > 0)
    rows = [(c, 0, "user", "gone")]
    found = result(spark.createDataFrame(rows, SCHEMA))
    assert found == brute(rows) and len(found) == 1 and found[0][:5] == (c, 0, None, 1, 0)


def test_given_conversations(spark):
    if not os.path.isdir(FOLDER):
        pytest.skip("no test data")
    df = spark.read.parquet(f"{FOLDER}/conversations.parquet")
    assert result(df) == brute([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def test_empty_table(spark):
    assert result(spark.createDataFrame([], SCHEMA)) == []


def test_bands_cover_every_depth_once(monkeypatch):
    monkeypatch.setattr(ct, "BAND_ROWS", 10)
    got = ct.bands({0: 3, 5: 50, 9: 20, 12: 3, 400: 2})
    assert [d for low, high in got for d in range(high, low, -1)] == list(range(400, -1, -1))
    assert len(got) < 100
