"""Removal of passages that earlier documents hold, found by sharded Aho-Corasick automata.

A window is ``WINDOW`` consecutive words of one document. Every word covered by a window whose words
also stand in a document with a smaller id is removed; windows are judged on the input.

1. Anchors. Each window is named by the smallest hash of its ``ANCHOR``-word phrases, so equal windows
   have equal anchors and neighbouring windows mostly share one: about one anchor in four words. An
   anchor recurs if several ids hold it. Only documents with a recurring anchor can hold a repeat;
   the others are done.
2. Confirmed passages. Windows under recurring anchors are counted by a 128-bit hash; those of several
   ids are patterns, owned by the smallest id. Consecutive patterns of an owner make a passage, cut
   from its text.
3. Shards. An anchor belongs to a shard by the smallest id that holds it, so the passages of a document
   stay together; owners with very many anchors are spread. There are as many shards as keep an
   automaton at about ``PATTERNS`` windows. The stretches of a document under recurring anchors go to
   the shards of these anchors, which hold every pattern they can contain; the rest of its text cannot
   match. Nor can windows under anchors whose smallest id is the document's own: no smaller id holds them. Shards with many stretches are dealt to several tasks, each with a copy of the patterns.
4. Automata. A task reads the passages of a shard, numbers their words, compiles one automaton
   (pyahocorasick over word numbers) with every window and its owner, and streams the shard's
   stretches through it. A hit of a smaller owner marks its words. Matches compare whole words,
   no hashes; a hash collision could at worst hide a pattern (word hashes have 64 bits).

Words lie between ASCII white space and are compared as UTF-8 bytes (lone surrogates count as '?').
Null and empty texts have no words; texts under ``WINDOW`` words keep all. Null ids are neither smaller
nor larger than another: their documents remove nothing and lose nothing. Rows of one id never remove
from each other, so repeated rows get equal results. An empty table gives an empty result. Very long
texts are hashed in segments; a document is held by one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outledger.llm.common import arrow_schema, byte_words, encoded, text_key, texts
from outledger.llm.ngram_join import WORD_BASE, mix, powers, word_hashes
from outledger.llm.substring_dedup import sliding_least
from outledger.session import pin, unpin

WINDOW = 13
ANCHOR = 7
#: Windows in an automaton, about; anchors of one owner in a shard; bytes and stretches that a task
#: streams through one automaton.
PATTERNS = 5_000
OWNER_ANCHORS = PATTERNS // 4
STREAM_BYTES = 4 << 20
STREAM_ROWS = 10_000
#: Bytes of text that are hashed at a time, and windows of one segment.
CHUNK_BYTES = 8 << 20
SEGMENT = 1 << 20

U64 = np.uint64
OTHER_BASE = U64(0xC2B2AE3D27D4EB4F)


def grams(words: np.ndarray, n: int, base: np.uint64) -> np.ndarray:
    """Hash of every run of ``n`` word hashes."""
    weights = powers(base, n)
    total = np.zeros(max(len(words) - n + 1, 0), U64)
    for k in range(n):
        total += words[k : k + len(total)] * weights[k]
    return mix(total)


def chunks(batches: Iterator[pa.RecordBatch], text_at: int = 1) -> Iterator[tuple[list[tuple], list[bytes]]]:
    """The other columns as rows, and the texts, a few megabytes at a time."""
    rows, found, held = [], [], 0
    for batch in batches:
        rest = [c.to_pylist() for i, c in enumerate(batch.columns) if i != text_at]
        for row, text in zip(zip(*rest, strict=True), batch.column(text_at), strict=True):
            rows.append(row)
            found.append(encoded(text.as_py()))
            held += len(found[-1])
            if held >= CHUNK_BYTES:
                yield rows, found
                rows, found, held = [], [], 0
    if rows:
        yield rows, found


def windows(found: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of the texts' windows, a segment at a time: text, start (in words), anchor, word hashes from there."""
    words, first = word_hashes(found)
    of_word = np.repeat(np.arange(len(found)), np.diff(first))
    for a in range(0, len(words) - WINDOW + 1, SEGMENT):
        part = words[a : a + SEGMENT + WINDOW - 1]
        anchor = sliding_least(grams(part, ANCHOR, WORD_BASE), WINDOW - ANCHOR + 1)
        of = of_word[a : a + len(anchor)]
        whole = of == of_word[a + WINDOW - 1 : a + WINDOW - 1 + len(anchor)]
        start = np.flatnonzero(whole)
        yield of[start], start + a - first[of[start]], anchor[start], (part, start)


def differing(low: np.ndarray, high: np.ndarray) -> pa.Array:
    """``high``, null where it says nothing: such rows are smaller."""
    return pa.array(high, mask=low == high)


def rows_of(*columns: np.ndarray | pa.Array, names: str) -> pa.RecordBatch:
    arrays = [pa.array(c.view(np.int64)) if isinstance(c, np.ndarray) else c for c in columns]
    return pa.RecordBatch.from_arrays(arrays, names=names.split())


def fresh(*columns: np.ndarray) -> np.ndarray:
    """Places where a row of sorted columns differs from the one before."""
    out = np.ones(len(columns[0]), bool)
    out[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(out)


def doc_anchors(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of text and anchor."""
    texts_, anchors = [np.zeros(0, np.int64)], [np.zeros(0, U64)]
    for of, _, anchor, _ in windows(found):
        first = fresh(of, anchor)
        texts_.append(of[first])
        anchors.append(anchor[first])
    of, anchor = np.concatenate(texts_), np.concatenate(anchors)
    order = np.lexsort((anchor, of))
    of, anchor = of[order], anchor[order]
    first = fresh(of, anchor)
    return of[first], anchor[first]


def anchor_rows(docs: DataFrame) -> DataFrame:
    """``anchor, doc_id``: the distinct anchors of every document."""

    def run(batches):
        for rows, found in chunks(batches):
            of, anchor = doc_anchors(found)
            ids = np.array([r[0] for r in rows], np.int64)
            yield rows_of(anchor, ids[of], names="anchor doc_id")

    return docs.select("doc_id", "text").mapInArrow(run, "anchor long, doc_id long")


def anchor_owners(docs: DataFrame) -> DataFrame:
    """``anchor, owner`` of the anchors that several ids hold."""

    def run(batches):
        for rows, found in chunks(batches):
            of, anchor = doc_anchors(found)
            ids = np.array([r[0] for r in rows], np.int64)[of]
            order = np.argsort(anchor, kind="stable")
            anchor, ids = anchor[order], ids[order]
            start = fresh(anchor)
            if len(start):
                low, high = np.minimum.reduceat(ids, start), np.maximum.reduceat(ids, start)
                yield rows_of(anchor[start], low, differing(low, high), names="anchor low high")

    made = docs.select("doc_id", "text").mapInArrow(run, "anchor long, low long, high long")
    last = F.coalesce("high", "low")
    counted = made.groupBy("anchor").agg(F.min("low").alias("owner"), F.max(last).alias("high"))
    return counted.where("owner < high").select("anchor", "owner")


def homes(owners: DataFrame) -> DataFrame:
    """``anchor, owner, shard``: anchors of one owner together, unless they are very many."""
    shards = max(1, -(-owners.count() * (WINDOW - ANCHOR + 2) // (2 * PATTERNS)))
    heavy = owners.groupBy("owner").agg(F.ceil(F.count("*") / OWNER_ANCHORS).cast("int").alias("parts"))
    heavy = heavy.where("parts > 1")
    part = F.pmod("anchor", F.coalesce("parts", F.lit(1)))
    shard = F.pmod(F.xxhash64("owner", part), F.lit(shards)).cast("int")
    return owners.join(heavy, "owner", "left").select("anchor", "owner", shard.alias("shard"))


def anchor_lists(docs: DataFrame, owners: DataFrame) -> DataFrame:
    """``doc_id, a``: the recurring anchors of every id with their shards, and whether a smaller id holds them."""
    held = anchor_rows(docs).join(homes(owners), "anchor")
    later = (F.col("owner") < F.col("doc_id")).alias("later")
    return held.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("anchor", "shard", later))).alias("a"))


def suspects(docs: DataFrame, lists: DataFrame) -> DataFrame:
    """Distinct documents with a recurring anchor: ``doc_id, text_key, text, anchors, homes, later``.

    ``homes`` holds the shard of each of the anchors, ``later`` whether a smaller id holds it; documents
    of one first shard lie together.
    """
    found = docs.join(lists, "doc_id").dropDuplicates(["doc_id", "text_key"])
    out = found.select(
        "doc_id", "text_key", "text",
        F.col("a.anchor").alias("anchors"), F.col("a.shard").alias("homes"), F.col("a.later").alias("later"),
    )
    first = F.array_min("homes")
    spread = F.pmod(F.col("text_key"), F.lit(16))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return out.repartition(parts, first, spread).sortWithinPartitions(first)


def marked(found: list[bytes], anchors: list[np.ndarray], homes_: list[np.ndarray]):
    """``windows`` under the given anchors of each text, with their shard and two hashes."""
    for of, start, anchor, (part, at) in windows(found):
        cuts = np.searchsorted(of, np.arange(len(found) + 1))
        keep, shard = np.zeros(len(of), bool), np.zeros(len(of), np.int32)
        for i in np.unique(of).tolist():
            own, piece = anchors[i], slice(cuts[i], cuts[i + 1])
            if len(own):
                place = np.minimum(np.searchsorted(own, anchor[piece]), len(own) - 1)
                keep[piece] = own[place] == anchor[piece]
                shard[piece] = homes_[i][place]
        at = at[keep]
        h = (grams(part, WINDOW, base)[at] for base in (WORD_BASE, OTHER_BASE))
        yield of[keep], start[keep], shard[keep], *h


def sorted_anchors(anchors: list[int], homes_: list[int]) -> tuple[np.ndarray, np.ndarray]:
    own = np.array(anchors, np.int64).view(U64)
    order = np.argsort(own)
    return own[order], np.array(homes_, np.int32)[order]


def patterns(held: DataFrame) -> DataFrame:
    """``owner, windows``: hashes of the windows that several ids hold, by the smallest."""

    def run(batches):
        for rows, found in chunks(batches):
            own = [sorted_anchors(r[1], r[2]) for r in rows]
            ids = np.array([r[0] for r in rows], np.int64)
            got = [(h, g, ids[of]) for of, _, _, h, g in marked(found, [o[0] for o in own], [o[1] for o in own])]
            if not got:
                continue
            h, g, doc = (np.concatenate(c) for c in zip(*got, strict=True))
            order = np.lexsort((g, h))
            h, g, doc = h[order], g[order], doc[order]
            start = fresh(h, g)
            if len(start):
                low, high = np.minimum.reduceat(doc, start), np.maximum.reduceat(doc, start)
                yield rows_of(h[start], g[start], low, differing(low, high), names="h g low high")

    made = held.select("doc_id", "text", "anchors", "homes").mapInArrow(run, "h long, g long, low long, high long")
    last = F.coalesce("high", "low")
    counted = made.groupBy("h", "g").agg(F.min("low").alias("owner"), F.max(last).alias("high"))
    return counted.where("owner < high").groupBy("owner").agg(F.collect_list("h").alias("windows"))


def cut_runs(
    texts_: list[bytes], own: list[tuple[np.ndarray, np.ndarray]], wanted: list[np.ndarray] | None = None
) -> Iterator[tuple[int, int, int, str]]:
    """Text, shard, first word and words of every run of consecutive windows of one shard.

    Windows are those under the given anchors, or only those whose hash is wanted.
    """
    for of, start, shard, h, _ in marked(texts_, [o[0] for o in own], [o[1] for o in own]):
        cuts = np.searchsorted(of, np.arange(len(texts_) + 1))
        for i in np.unique(of).tolist():
            piece = slice(cuts[i], cuts[i + 1])
            s, home = start[piece], shard[piece]
            if wanted is not None:
                mine = h[piece].view(np.int64)
                place = np.minimum(np.searchsorted(wanted[i], mine), len(wanted[i]) - 1)
                ok = wanted[i][place] == mine
                s, home = s[ok], home[ok]
            if not len(s):
                continue
            cut = np.flatnonzero((np.diff(s) != 1) | (np.diff(home) != 0)) + 1
            words = texts_[i].split()
            for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(s)], strict=True):
                text = b" ".join(words[s[a] : s[b - 1] + WINDOW]).decode("utf-8")
                yield i, int(home[a]), int(s[a]), text


def passages(held: DataFrame, found: DataFrame) -> DataFrame:
    """``shard, owner, text``: runs of consecutive patterns in their owner's text, words joined by a blank."""
    schema = arrow_schema(held.sparkSession, "shard int, owner long, text string")

    def run(batches):
        for rows, texts_ in chunks(batches):
            own = [sorted_anchors(r[1], r[2]) for r in rows]
            wanted = [np.sort(np.array(r[3], np.int64)) for r in rows]
            out = [(home, rows[i][0], text) for i, home, _, text in cut_runs(texts_, own, wanted)]
            yield batch_of(out, schema)

    joined = held.join(found.withColumnRenamed("owner", "doc_id"), "doc_id")
    columns = joined.select("doc_id", "text", "anchors", "homes", "windows")
    return columns.mapInArrow(run, "shard int, owner long, text string")


STRETCH = "shard int, doc_id long, text_key long, at int, text string"


def stretches(held: DataFrame) -> DataFrame:
    """``STRETCH``: the parts of every document that a shard's patterns can match, and their first word."""
    schema = arrow_schema(held.sparkSession, STRETCH)

    def run(batches):
        for every, found in chunks(batches):
            rows = [r for r in every if any(r[4])]
            texts_ = [text for r, text in zip(every, found, strict=True) if any(r[4])]
            own = [sorted_anchors(list(compress(r[1], r[4])), list(compress(r[2], r[4]))) for r in rows]
            out = [(home, rows[i][0], rows[i][3], at, text) for i, home, at, text in cut_runs(texts_, own)]
            yield batch_of(out, schema)

    return held.select("doc_id", "text", "anchors", "homes", "text_key", "later").mapInArrow(run, STRETCH)


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


class Shard:
    """One automaton over the windows of a shard's passages.

    A word is two letters, a page and a place of its number, so no state has more than a few hundred
    followers (the library looks through them one by one).
    """

    PLACES = 128

    def __init__(self):
        self.numbers: dict[bytes, tuple[int, int]] = {}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        self.ready = False

    def letters(self, word: bytes) -> tuple[int, int]:
        found = self.numbers.get(word)
        if found is None:
            n = len(self.numbers)
            found = self.numbers[word] = (self.PLACES + 1 + n // self.PLACES, 1 + n % self.PLACES)
        return found

    def add(self, owner: int, text: str) -> None:
        key = tuple([x for word in byte_words(text) for x in self.letters(word)])
        for i in range(0, len(key) - 2 * WINDOW + 1, 2):
            self.automaton.add_word(key[i : i + 2 * WINDOW], owner)

    def ranges(self, doc: int, at: int, text: str) -> list[int]:
        """Starts and ends of the runs of words that windows of smaller owners cover."""
        if not len(self.automaton):
            return []
        if not self.ready:
            self.automaton.make_automaton()
            self.ready = True
        number, unknown = self.numbers.get, (0, 0)
        key = tuple([x for word in byte_words(text) for x in number(word, unknown)])
        out: list[int] = []
        for last, owner in self.automaton.iter(key):
            if owner < doc:
                end = at + last // 2 + 1
                if out and out[-1] >= end - WINDOW:
                    out[-1] = end
                else:
                    out += (end - WINDOW, end)
        return out


def located(visits: DataFrame, found: DataFrame) -> DataFrame:
    """``doc_id, text_key, ranges``: removed runs of words, one row per stretch that has some."""
    spark = visits.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = F.greatest(F.ceil(F.sum(F.octet_length("text")) / STREAM_BYTES), F.ceil(F.count("*") / STREAM_ROWS))
    dealt = pin(visits.groupBy("shard").agg(tasks.cast("int").alias("tasks")))
    copies = found.join(dealt, "shard").select(
        "shard", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("task"), F.lit(0).alias("kind"),
        F.col("owner").alias("doc_id"), F.lit(0).cast("long").alias("text_key"), F.lit(0).alias("at"), "text",
    )
    task = F.pmod(F.xxhash64("doc_id", "text_key", "at"), F.col("tasks")).cast("int")
    streamed = visits.join(dealt, "shard").select(
        "shard", task.alias("task"), F.lit(1).alias("kind"), "doc_id", "text_key", "at", "text"
    )
    schema = arrow_schema(spark, "doc_id long, text_key long, ranges array<int>")

    def run(batches):
        now, shard = None, Shard()
        for batch in batches:
            out = []
            for home, part, kind, doc, key, at, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (home, part) != now:
                    now, shard = (home, part), Shard()
                if kind == 0:
                    shard.add(doc, text)
                elif runs := shard.ranges(doc, at, text):
                    out.append((doc, key, runs))
            yield batch_of(out, schema)

    rows = copies.unionByName(streamed).repartition(parts, "shard", "task")
    ordered = rows.sortWithinPartitions("shard", "task", "kind")
    return ordered.mapInArrow(run, "doc_id long, text_key long, ranges array<int>")


def without(text: str | None, ranges: list[int]) -> tuple[int, bytes]:
    """Number of removed words, and the kept ones joined by a blank."""
    words = byte_words(text)
    gone = np.zeros(len(words), bool)
    for a, b in zip(ranges[::2], ranges[1::2], strict=True):
        gone[a:b] = True
    return int(gone.sum()), b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])


SUMS = "doc_id long, text_key long, n_words long, n_removed long, kept_sha256 string"


def summed(rows: DataFrame) -> DataFrame:
    """``SUMS`` of ``doc_id, text_key, text, ranges``."""
    schema = arrow_schema(rows.sparkSession, SUMS)

    def run(batches):
        for batch in batches:
            out = []
            for doc, key, text, ranges in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                removed, kept = without(text, ranges or [])
                out.append((doc, key, len(byte_words(text)), removed, hashlib.sha256(kept).hexdigest()))
            yield batch_of(out, schema)

    return rows.select("doc_id", "text_key", "text", "ranges").mapInArrow(run, SUMS)


def repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text_key, text, ranges`` of the distinct documents that lose words.

    ``ranges`` holds start and end of every located run, in words; runs may overlap.
    """
    docs = texts(df, doc_id, text).where("doc_id is not null").withColumn("text_key", text_key())
    # Each shuffle ends with a written table, so its files are gone before the next one begins.
    owners = pin(anchor_owners(docs))
    lists = pin(anchor_lists(docs, owners))
    held = pin(suspects(docs, lists))
    unpin(owners, lists)
    owned = pin(patterns(held))
    found = pin(passages(held, owned))
    unpin(owned)
    visits = pin(stretches(held))
    runs = pin(located(visits, found))
    unpin(found, visits)
    lists = runs.groupBy("doc_id", "text_key").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))
    return held.select("doc_id", "text_key", "text").join(lists, ["doc_id", "text_key"])


def without_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` per row of ``df``."""
    every = texts(df, doc_id, text).withColumn("text_key", text_key())
    whole = summed(every.withColumn("ranges", F.lit(None).cast("array<int>")))
    cut = summed(repeats(df, doc_id, text)).select(
        F.col("doc_id").alias("of_doc"), F.col("text_key").alias("of_key"),
        F.col("n_removed").alias("removed"), F.col("kept_sha256").alias("kept"),
    )
    joined = whole.join(cut, (F.col("doc_id") == F.col("of_doc")) & (F.col("text_key") == F.col("of_key")), "left")
    return joined.select(
        "doc_id", "n_words", F.coalesce("removed", "n_removed").alias("n_removed"),
        F.coalesce("kept", "kept_sha256").alias("kept_sha256"),
    )


def kept_texts(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text`` per row: the words that stay, joined by a blank; null stays null."""
    every = texts(df, doc_id, text).withColumn("text_key", text_key())
    lists = repeats(df, doc_id, text).select(
        F.col("doc_id").alias("of_doc"), F.col("text_key").alias("of_key"), "ranges"
    )
    joined = every.join(lists, (F.col("doc_id") == F.col("of_doc")) & (F.col("text_key") == F.col("of_key")), "left")

    def run(batches):
        for batch in batches:
            rows = batch.to_pydict()
            kept = [
                None if t is None else without(t, r or [])[1].decode("utf-8")
                for t, r in zip(rows["text"], rows["ranges"], strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.string())], names=["doc_id", "text"])

    return joined.select("doc_id", "text", "ranges").mapInArrow(run, "doc_id long, text string")
