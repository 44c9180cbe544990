"""Token counts, SentencePiece, licence scans, quality rules and archives against brute force."""

import gzip
import hashlib
import os
import random
import re
import uuid
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece

from outledger.llm import license_scan, piece_codec, quality_rules, token_counts, warc
from outledger.session import scratch_dir

FOLDER = "/root/testdata/sf0.001"
MODEL = str(public_tokenizers.path("piece_bpe_32k.model"))

ODD = [
    None, "", " ", "\n", "a", "  two  blanks ", "\u2581mark\u2581 in text", "a\x00b", "日本\U0001f600x",
    "x" * 3000, "ab " * 2000, "<s> a</s> <0x0A>", "\t tab\r\n line\x0b\x0c", "ÀÉ ß ǅ", "1234567 0 0.5",
]


def rows_of(spark, texts):
    data = [(i, t, f"src{i % 3}", "x", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(
        data, "doc_id long, text string, source string, host string, n_words int"
    )


def real_texts(n=120):
    if not os.path.isdir(FOLDER):
        return []
    import pyarrow.parquet as pq

    return pq.read_table(f"{FOLDER}/documents.parquet", columns=["text"])["text"].to_pylist()[:n]


@pytest.fixture(scope="module")
def sample():
    return ODD + ODD[:3] + real_texts()


def test_sentencepiece_is_the_library(spark, sample):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = {r.doc_id: r for r in piece_codec.round_trip(rows_of(spark, sample), MODEL).collect()}
    assert len(got) == len(sample)
    for i, text in enumerate(sample):
        ids = library.encode(text or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_sentencepiece_ids_and_texts(spark, sample):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    ids = piece_codec.encode(rows_of(spark, sample), MODEL)
    for r in ids.collect():
        assert r.ids == library.encode(sample[r.doc_id] or "")
    for r in piece_codec.decode(ids, MODEL).collect():
        assert r.text == library.decode(library.encode(sample[r.doc_id] or ""))


def test_segment_long_and_short_agree():
    v = piece_codec.Vocabulary.load(MODEL)
    rng = random.Random(3)
    for _ in range(300):
        chunk = "".join(rng.choice("▁abethnioréß12 ") for _ in range(rng.randint(1, 60)))
        assert v.segment(chunk) == v._segment_long(list(chunk))


def test_chunks_are_cut_where_no_merge_crosses_and_words_segmented_once():
    v = piece_codec.Vocabulary.load(MODEL)
    rng = random.Random(5)
    for _ in range(300):
        chunk = "▁" + "".join(rng.choice("▁abethnion.,;\n\"(12\U0001f600ß") for _ in range(rng.randint(0, 40)))
        parts = v.parts(chunk)
        assert "".join(parts) == chunk and all(parts)
        assert [p for part in parts for p in v.segment(part)] == v._segment_long(list(chunk))
    table = piece_codec.ChunkTable(v, 100)
    segmented = []
    encode = v.encode_chunk
    object.__setattr__(v, "encode_chunk", lambda chunk: segmented.append(chunk) or encode(chunk))
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for text in ("one\nword two\nwords", "two\nwords one\nwords", " one  two\nwords", "words ", "▁one word", "one\n\n"):
        rows = table.look_up(text)
        assert [i for r in rows for i in r[0]] == library.encode(text)
        assert "".join(r[2] for r in rows)[1:] == library.decode(library.encode(text))
    # Each word once, with and without a marker before it, however it stands beside line ends.
    assert len(segmented) == len(set(segmented)) and "words" in segmented
    assert not any("\n" in part and part != "\n" for part in segmented)
    for i in range(300):
        table.look_up(f"w{i} one")
        assert len(table) <= 102 and len(table.parts) <= 102


def test_runs_are_kept_without_the_punctuation_around_them():
    v = piece_codec.Vocabulary.load(MODEL)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    words = [a + b for a in ("wor", "thin", "na\u00efv", "\u0434\u043e") for b in ("der", "ing", "X", "\u00df")]
    ends = ["", ".", ",", "!", ".\n", "...", ")", "\u201d", "%", "1", "\t", "\U0001f600", "\u2014", "_", "^]"]
    table = piece_codec.ChunkTable(v, 10_000)
    for word in words:
        for end in ends:
            for text in (f"{word}{end}", f"{end}{word}", f" {word}{end}{word}  {end} ", f"\u2581{end} \u2581{word}"):
                rows, ids = table.look_up(text), library.encode(text)
                assert [i for r in rows for i in r[0]] == ids
                assert ",".join(r[1] for r in rows) == ",".join(map(str, ids))
                assert "".join(r[2] for r in rows)[1:] == library.decode(ids)
    # Words and punctuation add up, they are not multiplied by each other.
    assert len(table) + len(table.parts) < len(words) * len(ends)

    rng = random.Random(11)
    for _ in range(300):
        text = " " + "".join(rng.choice("  abzE\u00e9\u0436.,;\n\"^]-\\(12\u65e5\U0001f600") for _ in range(rng.randint(0, 30)))
        runs = v.runs.findall(text)
        assert "".join(runs) == text
        for left, right in zip(runs, runs[1:], strict=False):
            assert right[0] == " " or left[-1] + right[0] not in v.neighbours
    # Pieces decide what a run is: an apostrophe that they link to a letter stays with the word.
    linked = piece_codec.runs_pattern(["ab", "b'", "'s", "-]", "\u2581a"])
    assert linked.findall(" ab's-] b  'c^") == [" ab's", "-]", " b", "  '", "c", "^"]
    assert piece_codec.runs_pattern([]).findall(" ab ") == [" a", "b", " "]


def greedy(word, pieces):
    """Longest match first, by trying every length."""
    n, at, first = 0, 0, True
    while at < len(word) or first:
        for end in range(len(word), at - (1 if first else 0), -1):
            piece = ("▁" if first else "") + word[at:end]
            if piece in pieces and (first or not piece.startswith("▁")):
                break
        else:
            return 0
        n, at, first = n + 1, end, False
        if at >= len(word):
            break
    return n


def test_token_counts_brute_force(spark, sample):
    pieces = set(token_counts.pieces_of(MODEL))
    got = {r.doc_id: r for r in token_counts.token_counts(rows_of(spark, sample), MODEL).collect()}
    for i, text in enumerate(sample):
        words = [w.decode() for w in (text or "").encode().split()]
        counts = [greedy(w, pieces) for w in words]
        assert got[i].n_words == len(words)
        assert got[i].n_unknown == counts.count(0)
        assert got[i].n_tokens == sum(c or 1 for c in counts)


@pytest.mark.parametrize("seed", range(5))
def test_piece_counter_small_vocabularies(seed):
    rng = random.Random(seed)
    pieces = {"▁" * rng.randint(0, 1) + "".join(rng.choices("ab", k=rng.randint(1, 4))) for _ in range(9)}
    if seed % 2:
        pieces.add("▁")
    counter = token_counts.PieceCounter(sorted(pieces))
    for _ in range(400):
        word = "".join(rng.choices("abc" if rng.random() < 0.1 else "ab", k=rng.randint(1, 9)))
        assert counter.count(word) == greedy(word, pieces), (word, pieces)


def base_of(text):
    words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())
    places = []
    for phrase, label in license_scan.BASE_PHRASES.items():
        p = phrase.encode().split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    return len(words), sorted(places)


def test_license_base_and_templates(spark, sample):
    mit = license_scan.TEMPLATES[0][1]
    more = [
        "Foo. " + mit.title() + ". Bar", "MIT License, mit-license; CC BY-NC 4.0",
        "Licensed under CC BY-NC 4.0.", mit.replace("any", "each") + " x", mit[:40],
        "This work is licensed under the GNU General Public License, version 3.",
        "the software and the software to deal " * 300, "cc0 1.0 universal, public domain dedication",
    ]
    texts = sample + more
    got = {r.doc_id: r for r in license_scan.scan(rows_of(spark, texts)).collect()}
    for i, text in enumerate(texts):
        n, places = base_of(text)
        assert (got[i].n_words, got[i].n_base) == (n, len(places))
        assert got[i].first_word == (places[0][0] if places else None)
        assert got[i].last_word == (places[-1][0] if places else None)
        assert got[i].base_labels == sorted({label for _, label in places})
    labels = [{m.label for m in got[len(sample) + i].matches} for i in range(len(more))]
    assert labels[0] == {"mit"} and labels[2] == {"cc-by-nc"} and labels[3] == {"mit"}
    assert labels[4] == set() and labels[5] == {"gpl"} and labels[6] == set() and labels[7] == {"cc0"}


def measures_of(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = Counter(windows)
    marked = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(3)}
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(marked),
    )


def test_quality_measures_and_verdicts(spark, sample):
    texts = sample + ["a b c a b c d " * 20, "x\nx\n \n \ny\nx", "1 1 1 1", "# $ " * 40]
    got = {r.doc_id: r for r in quality_rules.quality(rows_of(spark, texts)).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        m, r = measures_of(text), got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == m
        assert r.base_failed == (m[0] < 50 or 100 * m[4] > 50 * m[0])
        assert not (r.base_failed and r.kept)
        if not r.base_failed and not r.strong and not r.weak:
            assert r.kept


def test_quality_hosts(spark):
    good = " ".join(f"word{i}" for i in range(80))
    odd = " ".join(f"w{i}-{i}-{i}" for i in range(80))  # one weak failure
    bad = "### " * 100
    rows = [(i, good, "clean") for i in range(40)] + [(100, odd, "clean")]
    rows += [(200 + i, bad, "bad") for i in range(40)] + [(300, odd, "bad"), (301, good, "bad")]
    rows += [(400, good, None), (None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.kept for r in quality_rules.quality(df).collect()}
    assert got[0] and got[100] and got[301] and got[400]
    assert not got[300] and not got[200] and not got[None]
    assert quality_rules.quality(df.limit(0)).count() == 0


PAGES = [
    (1, "http://a", "same"), (2, "http://b", "same"), (3, None, "é\U0001f600"), (4, "u\r\nx: y", None),
    (5, "http://c", ""), (6, "http://d", "x" * 200_000), (7, "http://e", "same"), (None, "n", "null id"),
    (8, "http://f", "twice"), (8, "http://f", "twice"), (None, "n", "same"),
]


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_warc_round_trip(spark, min_bytes):
    uri = f"{scratch_dir(spark)}/warc-{uuid.uuid4().hex}"
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    manifest = warc.write_archives(df.withColumn("key", df.url), uri, 3, 1000, min_bytes)
    got = warc.read_archives(spark, uri).collect()
    assert len(got) == len(PAGES) == sum(r.n_records for r in manifest.collect())
    assert Counter(r.page_id for r in got) == Counter(p[0] for p in PAGES)
    for r in got:
        page = [p for p in PAGES if p[0] == r.page_id and warc.digest((p[2] or "").encode()) == r.payload_digest]
        payload = (page[0][2] or "").encode()
        assert r.payload_bytes == len(payload)
        if r.record_type == "response":
            assert bytes(r.payload) == payload and r.refers_to is None
    kinds = {(r.page_id, r.payload_digest): (r.record_type, r.refers_to) for r in got}
    same, empty = warc.digest(b"same"), warc.digest(b"")
    assert kinds[7, same] == ("response", None)
    assert kinds[1, same] == (("revisit", 7) if min_bytes == 0 else ("response", None))
    assert kinds[4, empty] == (("revisit", 5) if min_bytes == 0 else ("response", None))
    if min_bytes == 0:
        twice = [(r.record_type, r.refers_to) for r in got if r.page_id == 8]
        assert sorted(twice) == [("response", None), ("revisit", 8)]


def test_warc_is_deterministic_and_standard(spark):
    df = spark.createDataFrame(PAGES[:7], "page_id long, url string, html string")
    found = []
    for _ in range(2):
        uri = f"{scratch_dir(spark)}/warc-{uuid.uuid4().hex}"
        warc.write_archives(df, uri, 2, 1 << 20)
        fs, root = warc.store(uri)
        names = sorted(r.name for r in spark.read.parquet(f"{uri}/_manifest").collect())
        found.append([fs.open_input_stream(f"{root}/{n}", compression=None).read() for n in names])
    assert found[0] == found[1]
    text = b"".join(gzip.decompress(x) for x in found[0])
    assert text.count(b"WARC/1.1\r\n") == 7 and text.count(b"WARC-Type: revisit") == 3


def test_warc_empty_and_uncommitted(spark):
    uri = f"{scratch_dir(spark)}/warc-{uuid.uuid4().hex}"
    df = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archives(df, uri, 2)
    assert warc.read_archives(spark, uri).count() == 0
    with pytest.raises(FileNotFoundError):
        warc.read_archives(spark, uri + "-none")
