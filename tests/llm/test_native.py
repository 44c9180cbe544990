"""Decontamination and personal data against brute force in plain Python."""

import functools
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from outledger.llm import decontamination, pii

FOLDER = "/root/testdata/sf0.001"


def real_texts(n=200):
    if not os.path.isdir(FOLDER):
        return []
    import pyarrow.parquet as pq

    return pq.read_table(f"{FOLDER}/documents.parquet", columns=["text"])["text"].to_pylist()[:n]


@functools.cache
def shingles(text, width=5):
    w = [x for x in re.split(r"[\W_]+", (text or "").lower()) if x]
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}, len(w)


def contained(docs, items):
    out = set()
    for d, text in docs:
        for i, item in items:
            n = shingles(item)[1]
            if text is None or not n:
                continue
            width = min(n, 5)
            own, want = shingles(text, width)[0], shingles(item, width)[0]
            if 100 * len(own & want) >= 75 * len(want):
                out.add((d, i, len(want), len(own & want)))
    return out


def test_containment_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 70)))) for i in range(60)]
    items += [(90, "One"), (91, "two words"), (92, None), (93, ""), (94, "?!"), (95, items[0][1])]
    docs = [(None, None), (1, ""), (2, "?"), (3, "one"), (4, "TWO   words, three")]
    for d in range(10, 160):
        words = rng.choices(vocabulary, k=rng.choice([0, 5, 50, 2000]))
        for _, item in rng.sample(items[:60], 2):
            piece = item.split()
            for _ in range(rng.choice([0, 1, 1, 2, 3, 6])):
                piece[rng.randrange(len(piece))] = "changed"
            at = rng.randint(0, len(words))
            words[at:at] = piece
        docs.append((d, " ".join(words).title()))
    docs.append((None, docs[20][1]))
    left = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n", F.lit("x"))
    right = spark.createDataFrame(items, "item_id long, text string").withColumn("h", F.lit(1))
    got = decontamination.contaminated(left, right)
    found = {(r.doc_id, r.item_id, r.n_shingles, r.n_found) for r in got.collect()}
    want = contained(docs, items)
    assert found == want and len(want) > 50
    assert decontamination.contaminated(left, right.limit(0)).count() == 0
    assert decontamination.contaminated(left.limit(0), right).count() == 0


def test_texts_of_one_id_and_null_ids(spark):
    # Each text is an item of its own: as a union, the ten would ask for 15 of 65 sketch hashes.
    texts = [" ".join(f"t{i}w{j}" for j in range(24)) for i in range(20)]
    items = [(7, t) for t in texts[:10]] + [(None, t) for t in texts[10:]] + [(7, texts[0]), (8, "")]
    docs = [(i, f"before {t} after") for i, t in enumerate(texts)] + [(90, "none of them")]
    left = spark.createDataFrame(docs, "doc_id long, text string")
    right = spark.createDataFrame(items, "item_id long, text string")
    got = [(r.doc_id, r.item_id, r.n_shingles, r.n_found) for r in decontamination.contaminated(left, right).collect()]
    assert len(got) == 20 and set(got) == contained(docs, items)
    assert [r.doc_id for r in decontamination.clean_documents(left, right).collect()] == [90]


def test_candidates_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", 0)
    item = " ".join(f"a{i}" for i in range(30))
    docs = spark.createDataFrame([(1, "x " + item), (2, item[:40])], "doc_id long, text string")
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    assert [r.doc_id for r in decontamination.contaminated(docs, items).collect()] == [1]


def test_leaks_are_found(spark):
    if not os.path.isdir(FOLDER):
        pytest.skip("no test data")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    a = [(r.doc_id, r.text) for r in docs.collect()]
    b = [(r.item_id, r.text) for r in items.collect()]
    rows = decontamination.contaminated(docs, items).collect()
    found = {(r.doc_id, r.item_id, r.n_shingles, r.n_found) for r in rows}
    assert found == contained(a, b)


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes_luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def holds(kind, match):
    number = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 14 <= len(number) <= 19 and passes_luhn(number)
    return kind == "email" or 10 <= len(number) <= 15


def base_spans(text):
    out = []
    for k, kind in enumerate(pii.KINDS):
        for m in re.finditer(PLAIN[kind], text or ""):
            if holds(kind, m.group()):
                out.append((m.start(), k, m.end()))
    return sorted(out)


def pii_texts():
    rng = random.Random(11)
    texts = [
        None, "", "no data", "a@b.c", "x..y@a-b.co.uk, a@b", "é a@b.cc,_d@e.fg@h.ij \U0001f600 +1 (499) 555-6503",
        "1.2.3.4.5.6.7.8 300.1.1.1 0001.002.03.255 1.2.3", "4111 1111 1111 1111 and 4111-1111-1111-1112",
        "4111  1111 1111 1111", "+49 30 1234567890 +1 +12345 +123456789012345678", "+1.2.3.4 +10.0.0.1",
        "call 499-555-6503 or (499) 555-6503 now", "name at example dot com",
        "1 " * 20_000, "a." * 20_000 + "a@b" + ".c" * 20_000, "7" * 30_000, "1.2.3.4 " * 800, "x" * 50_000 + "@y.zz",
        "fe80:0:0:0:1:2:3:4 host", "4111.1111.1111.1111 card: 4111.1111.1111.1111",
    ]
    for _ in range(300):
        texts.append("".join(rng.choices("0123456789 -.+()@a_%b\n", k=rng.randint(1, 80))))
    return texts + real_texts()


def test_base_spans_brute_force(spark):
    texts = pii_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.personal_data(df.withColumn("spans", F.lit(1))).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        want = base_spans(text)
        assert [(s.start, s.kind, s.end) for s in got[i].base] == want, text
        spans = [(s.start, s.kind, s.end) for s in got[i].spans]
        assert set(want) <= set(spans) and spans == sorted(spans)
    assert pii.personal_data(df.limit(0)).count() == 0


def test_model_adds_cued_loose_spans(spark):
    texts = [f"call me at 499-555-{1000 + i}" for i in range(200)]
    texts += [f"part 499-555-{1000 + i} of" for i in range(200)]
    texts += [f"mail a{i}@b.com or +1 499 555 {1000 + i}" for i in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.personal_data(df).collect()}
    assert all(len(got[i].spans) == 1 for i in range(200))
    assert all(len(got[i].spans) == 0 for i in range(200, 400))
    assert all(len(got[i].spans) == 2 for i in range(400, 600))


WIDE = {
    "phone": [
        "0301234567", "030 1234567", "06 12 34 56 78", "4995556503", "(030) 123-4567", "555-6503",
        "0049 30 1234567", "030/123 45 67", "91 555 12 34", "06.12.34.56.78", "(0)30 123456",
    ],
    "ip": ["2001:db8::1", "fe80::1ff:fe23:4567:890a", "2001:db8:0:0:0:0:2:1", "::ffff:192.168.7.9", "2001:DB8:85a3::8a2e"],
    "card": ["3782.822463.10005", "3782_822463_10005", "4111  1111 1111 1111", "4111 - 1111 - 1111 - 1111", "4111/1111.1111 1111"],
    "email": ["jane at example dot com", "jane (at) example (dot) com", "jane[AT]example[DOT]com", "jane at mail dot example dot com"],
}
LEADS = {"phone": "Telefon: ", "ip": "server ", "card": "tarjeta n\u00famero ", "email": "courriel: "}


def covers(spans, kind, start, end):
    return any(s.kind == pii.KINDS.index(kind) and s.start <= start and s.end >= end for s in spans)


def test_recall_on_planted_forms(spark):
    # 30 copies a form with a cue word right before it, and 30 without any; counted: proposed, selected.
    rows, planted = [], []
    for kind, forms in WIDE.items():
        for form in forms:
            for lead in (LEADS[kind], "und dann "):
                for _ in range(30):
                    planted.append((kind, form, lead, len(lead) + 4))
                    rows.append((len(rows), f"eh, {lead}{form} zu sehen."))
    rows += [(len(rows) + i, t) for i, t in enumerate(real_texts())]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    proposed = {r.doc_id: r.spans for r in pii.candidates(df).collect()}
    selected = {r.doc_id: r.spans for r in pii.personal_data(df).collect()}
    got = {}
    for i, (kind, form, lead, at) in enumerate(planted):
        n = got.setdefault((kind, lead == LEADS[kind]), [0, 0, 0])
        n[0] += 1
        n[1] += covers(proposed[i], kind, at, at + len(form))
        n[2] += covers(selected[i], kind, at, at + len(form))
    print({f"{k} {'cue' if cue else 'no cue'}": n for (k, cue), n in got.items()})
    assert all(n[1] == n[0] for n in got.values()), got
    assert all(n[2] == n[0] for (_, cue), n in got.items() if cue), got
    assert all(got[kind, False][2] == got[kind, False][0] for kind in ("ip", "card")), got


def test_no_selected_span_is_lost_to_one_left_out(spark):
    bits = [1 << pii.FEATURES.index(name) for name in ("cue", "plus", "at")]
    spans = [(0, 3, 10, False, False, bits[0]), (8, 3, 18, False, False, bits[1]), (16, 3, 26, False, False, bits[2])]
    schema = "doc_id long, spans array<struct<start:int,kind:int,end:int,strict:boolean,label:boolean,bits:int>>"
    found = spark.createDataFrame([(1, spans)], schema)
    model = pii.Boosted(threshold=0.5)
    for name, value in (("cue", 3.0), ("plus", 2.0), ("at", 1.0)):
        model.trees.append((pii.FEATURES.index(name), pii.FEATURES.index(name), [0.0, 0.0, 0.0, value]))
    got = pii.select(found, [pii.Boosted()] * 3 + [model]).first().spans
    assert [(s.start, s.end) for s in got] == [(0, 10), (16, 26)]


def test_redaction(spark):
    text = "é a@b.cc or +1 499 555 6503."
    spans = "array(named_struct('start',2,'kind',0,'end',8), named_struct('start',4,'kind',1,'end',9), named_struct('start',12,'kind',3,'end',27))"
    df = spark.createDataFrame([(text,)], "text string").withColumn("spans", F.expr(spans))
    out = df.select(pii.redacted(F.col("text"), F.col("spans")).alias("x")).first().x
    assert out == "é [EMAIL]or [PHONE]."
    empty = df.select(pii.redacted(F.col("text"), F.slice("spans", 1, 0)).alias("x")).first().x
    assert empty == text


def test_boosting_learns_and_calibrates():
    rng = random.Random(2)
    halves = []
    for _ in range(2):
        rows = {}
        for _ in range(4000):
            bits = rng.getrandbits(len(pii.FEATURES))
            y = rng.random() < (0.97 if bits & 1 and not bits & 4 else 0.05)
            rows[bits, y] = rows.get((bits, y), 0) + 1
        halves.append([(b, y, n) for (b, y), n in rows.items()])
    model = pii.fit(halves[0])
    pii.calibrate(model, halves[1], 0.9)
    assert model.probability(1) > 0.85 and model.probability(5) < 0.2 and model.probability(0) < 0.2
    assert 0.5 <= model.threshold <= model.probability(1)


def test_many_matches_in_one_text_and_clashing_names(spark):
    text = " ".join(f"a{i}@b.example" for i in range(3000))
    df = spark.createDataFrame([(1, text, "x", "y")], "doc_id long, text string, `clean text` string, clean string")
    [row] = pii.redacted_documents(df).collect()
    assert row.text == " ".join(["[EMAIL]"] * 3000) and row["clean text"] == "x" and row.clean == "y"
    spans = spark.range(1).select(pii.spans_of(F.lit(text), pii.STRICT["email"]).alias("s")).first().s
    assert [text[s.start : s.end] for s in spans] == text.split() and len(spans) == 3000
    assert spark.range(1).select(pii.spans_of(F.lit(""), pii.STRICT["email"]).alias("s")).first().s == []


def test_rules_keep_a_column_named_like_their_own(spark):
    from outledger.llm import quality_rules

    rng = random.Random(6)
    good = " ".join("".join(rng.choices("aeinorst", k=rng.randint(3, 8))) for _ in range(120)) + "."
    df = spark.createDataFrame([(1, good, "h", "mine"), (2, "short", "h", "b")], "doc_id long, text string, source string, `row host` string")
    assert [(r.doc_id, r["row host"]) for r in quality_rules.kept_documents(df).collect()] == [(1, "mine")]
