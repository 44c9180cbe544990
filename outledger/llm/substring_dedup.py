"""Removal of repeated 200-byte strings by fingerprint counts over a cover sample.

A suffix array of the corpus would put equal 200-byte strings side by side. None is built here: no
suffix is ordered and no rank computed. Equal 64-bit fingerprints of blocks, cut at a cover sample of
positions, are counted by key instead, and refined only as far as repeats need it:

* Cover. Of every 200-byte string, the leftmost ``ANCHOR``-byte string with the smallest hash is
  sampled. Two equal 200-byte strings are therefore sampled at the same offset, which is what a
  difference cover gives; this content-defined cover holds about 1 position in 80, while the
  smallest residue cover that leaves an anchor of such a length (12 residues modulo 133) holds 1 in
  11. Consecutive strings with one sample form a block.
* Buckets. Suffixes that start with the same anchor are one bucket. A bucket of one cannot repeat.
* Ties. Within a bucket, blocks are compared by precomputed fingerprints of the whole stretch they
  span. Equal stretches are ties that the fingerprint resolves at once: all their strings repeat.
* Refinement. What is left is cut into blocks of 16 and then of single strings, each time bucketed
  by the bytes that all strings of the block share, with one representative of every tie kept in
  for comparison. Each level is a count by key with map-side combine, so neither a bucket that holds
  a third of the corpus nor a long repeat is ever gathered in one task.

Fingerprints are 64-bit hashes. Texts are UTF-8 bytes, nulls are empty; matches never cross
documents. Repeated rows repeat each other's strings; rows are told apart by id and text, so equal
ids do no harm. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outledger.llm.common import encoded, slices, texts
from outledger.llm.ngram_join import mix
from outledger.session import pin

LENGTH = 200
ANCHOR = 40
GRID = 16
PIECE = 1 << 19

U64 = np.uint64
BYTES = np.random.default_rng(30).integers(1, 2**63, 256, dtype=U64) * U64(2) + U64(1)
STEP = U64(0x9E3779B97F4A7C15)
STEP_INVERSE = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
PLACE_BITS = 22  # a chunk is shorter than 2 ** PLACE_BITS bytes

# place: start of the first string, then number of strings and offset of the anchor, a byte each
BLOCK = "doc_id long, text_key long, place long, inner long, outer long"
KEY = ["doc_id", "text_key"]


class Prints:
    """Fingerprints of all stretches of one byte array by running sums of weighted bytes."""

    up = np.ones(1, U64)
    down = np.ones(1, U64)

    def __init__(self, data: np.ndarray):
        n = len(data)
        if len(Prints.up) <= n:
            size = 1 << n.bit_length()
            for name, step in (("up", STEP), ("down", STEP_INVERSE)):
                values = np.full(size, step, U64)
                values[0] = 1
                setattr(Prints, name, np.multiply.accumulate(values))
        self.sums = np.zeros(n + 1, U64)
        np.cumsum(BYTES[data] * Prints.up[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, length, salt=0) -> np.ndarray:
        """Hashes of the stretches; ``salt`` tells stretches of different roles apart."""
        raw = (self.sums[start + length] - self.sums[start]) * Prints.down[start]
        return mix(raw + np.asarray(length).astype(U64) * STEP + np.asarray(salt).astype(U64) * STEP_INVERSE)


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int | None, int, int, bytes]]]:
    """(id, text key, offset, bytes) in chunks of about PIECE bytes; each string start is in one."""
    out, held = [], 0
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            data = encoded(text.as_py())
            key = zlib.crc32(data)
            for at in range(0, len(data) - LENGTH + 1, PIECE):
                out.append((doc, key, at, data[at : at + PIECE + LENGTH - 1]))
                held += len(out[-1][3])
                if held >= PIECE:
                    yield out
                    out, held = [], 0
    if out:
        yield out


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values, by doubling."""
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def packed(start, n, offset):
    return (start << 16) | (n << 8) | offset


def unpacked(place):
    return place >> 16, (place >> 8) & 255, place & 255


def cover_blocks(docs: DataFrame) -> DataFrame:
    """``BLOCK`` rows: every maximal run of string starts that share their sampled anchor."""

    def run(batches):
        for chunk in pieces(batches):
            sizes = np.array([len(p[3]) for p in chunk])
            begins = np.cumsum(sizes) - sizes
            data = np.frombuffer(b"".join(p[3] for p in chunk), np.uint8)
            prints = Prints(data)
            anchors = prints.of(np.arange(len(data) - ANCHOR + 1), ANCHOR)
            keys = (anchors >> U64(PLACE_BITS) << U64(PLACE_BITS)) | np.arange(len(anchors), dtype=U64)
            least = sliding_least(keys, LENGTH - ANCHOR + 1) & U64((1 << PLACE_BITS) - 1)
            counts = sizes - LENGTH + 1
            of = np.repeat(np.arange(len(chunk)), counts)
            inner_at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            start = begins[of] + inner_at
            anchor = least[start].astype(np.int64)
            fresh = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (of[1:] != of[:-1])))
            first = np.flatnonzero(fresh)
            n = np.diff(np.concatenate((first, [len(start)])))
            start, anchor, of = start[first], anchor[first], of[first]
            offset = anchor - start
            outer = prints.of(start, n + LENGTH - 1, packed(0, n, offset))
            absolute = start - begins[of] + np.array([p[2] for p in chunk])[of]
            ids = pa.array([p[0] for p in chunk], pa.int64()).take(pa.array(of))
            text_keys = np.array([p[1] for p in chunk], np.int64)[of]
            yield pa.RecordBatch.from_arrays(
                [
                    ids, pa.array(text_keys), pa.array(packed(absolute, n, offset)),
                    pa.array(anchors[anchor].view(np.int64)), pa.array(outer.view(np.int64)),
                ],
                names=["doc_id", "text_key", "place", "inner", "outer"],
            )

    return docs.mapInArrow(run, BLOCK)


def resolve(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split blocks (``BLOCK`` and ``known``, whether a tie elsewhere settled them already).

    Returns the rows whose stretch stands at two or more places, and for every bucket in which a
    block is still open its open blocks and one representative of each tie (``known`` true).
    """
    buckets = blocks.groupBy("inner").agg(F.count("*").alias("n")).where("n > 1").select("inner")
    rows = pin(blocks.join(buckets, "inner", "left_semi"))
    ties = pin(
        rows.groupBy("inner", "outer").agg(
            F.count("*").alias("n"), F.min("known").alias("known"),
            F.min(F.struct("doc_id", "text_key", "place")).alias("one"),
        )
    )
    repeated = rows.where("not known").join(
        ties.where("n > 1").select("inner", "outer"), ["inner", "outer"], "left_semi"
    )
    open_in = ties.where("n = 1 and not known").select("inner").distinct()
    left = ties.join(open_in, "inner", "left_semi")
    return repeated, left.select("one.*", (F.col("known") | (F.col("n") > 1)).alias("known"))


def with_stretches(left: DataFrame, docs: DataFrame) -> DataFrame:
    """``left`` with the bytes that each block spans, read from the documents once per document."""
    lists = left.groupBy(*KEY).agg(F.collect_list(F.struct("place", "known")).alias("blocks"))
    joined = join_documents(docs, lists, "inner").select("doc_id", "text_key", "text", "blocks")

    def run(batches):
        for batch in slices(batches):
            out = []
            for doc, key, text, blocks in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = encoded(text)
                for b in blocks:
                    start, n, _ = unpacked(b["place"])
                    out.append((doc, key, b["place"], b["known"], data[start : start + n + LENGTH - 1]))
            columns = zip(*out, strict=True) if out else [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["doc_id", "text_key", "place", "known", "stretch"],
            )

    schema = "doc_id long, text_key long, place long, known boolean, stretch binary"
    rows = joined.mapInArrow(run, schema)
    # Repeated rows of equal id and text give the same stretches: one of them is enough.
    return rows.dropDuplicates(["doc_id", "text_key", "place"])


def join_documents(docs: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """Documents with ``rows`` of the same id and text."""
    key = F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8"))
    other = rows.withColumnsRenamed({"doc_id": "of_doc", "text_key": "of_key"})
    same = F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("text_key") == F.col("of_key"))
    return docs.withColumn("text_key", key).join(other, same, how)


def finer_blocks(stretches: DataFrame, grid: int, only: bool = False) -> DataFrame:
    """``BLOCK`` rows and ``known`` of the blocks cut at anchor offsets that ``grid`` divides.

    With ``only``, ``cuts`` lists the places of the blocks of the coarser grid to cut.
    """

    def run(batches):
        for batch in slices(batches):
            if not batch.num_rows:
                continue
            rows = batch.to_pydict()
            parts = []  # row, first string within the stretch, number, anchor offset of the first
            for i, place in enumerate(rows["place"]):
                start, n, offset = unpacked(place)
                for at, count in [(0, n)] if not only else [
                    (unpacked(c)[0] - start, unpacked(c)[1]) for c in rows["cuts"][i]
                ]:
                    high, end = offset - at, offset - at - count  # anchor offsets high .. end + 1
                    while high > end:
                        low = max(high - high % grid, end + 1)
                        parts.append((i, offset - high, high - low + 1, high))
                        high = low - 1
            row, first, n, high = (np.array(x, np.int64) for x in zip(*parts, strict=True))
            sizes = np.array([len(x) for x in rows["stretch"]])
            begins = np.cumsum(sizes) - sizes
            prints = Prints(np.frombuffer(b"".join(rows["stretch"]), np.uint8))
            outer = prints.of(begins[row] + first, n + LENGTH - 1, packed(0, n, high))
            # Bytes shared by all strings of the grid block, also by those beyond the cut.
            anchor = begins[row] + first + high
            low = high - high % grid
            inner = prints.of(anchor - low, LENGTH - grid + 1, low)
            places = np.array(rows["place"], np.int64)[row]
            place = packed((places >> 16) + first, n, high)
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rows["doc_id"], pa.int64()).take(take),
                    pa.array(rows["text_key"], pa.int64()).take(take), pa.array(place),
                    pa.array(inner.view(np.int64)), pa.array(outer.view(np.int64)),
                    pa.array(rows["known"], pa.bool_()).take(take), pa.array(places),
                ],
                names=["doc_id", "text_key", "place", "inner", "outer", "known", "of_place"],
            )

    return stretches.mapInArrow(run, f"{BLOCK}, known boolean, of_place long")


def owned(left: DataFrame, blocks: DataFrame) -> DataFrame:
    """``left`` of a finer level grouped by the stretch it is cut from: ``cuts`` lists its places."""
    of = blocks.select(*KEY, "place", "of_place")
    other = left.withColumnsRenamed({"doc_id": "of_doc", "text_key": "of_key", "place": "at"})
    same = (
        F.col("doc_id").eqNullSafe(F.col("of_doc"))
        & (F.col("text_key") == F.col("of_key"))
        & (F.col("place") == F.col("at"))
    )
    return of.join(other, same).select(*KEY, "place", "of_place", other["known"])


def repeated_places(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, place`` of blocks all of whose strings stand somewhere else as well."""
    full, left = resolve(cover_blocks(docs).withColumn("known", F.lit(False)))
    stretches = pin(with_stretches(left, docs))
    coarse = pin(finer_blocks(stretches, GRID))
    more, left = resolve(coarse.drop("of_place"))

    cut = owned(left, coarse)
    lists = cut.groupBy(*KEY, "of_place", "known").agg(F.collect_list("place").alias("cuts"))
    other = lists.withColumnsRenamed({"doc_id": "of_doc", "text_key": "of_key", "known": "settled"})
    same = (
        F.col("doc_id").eqNullSafe(F.col("of_doc"))
        & (F.col("text_key") == F.col("of_key"))
        & (F.col("place") == F.col("of_place"))
    )
    chosen = stretches.drop("known").join(other, same).withColumnRenamed("settled", "known")
    single = finer_blocks(chosen.select(*KEY, "place", "known", "stretch", "cuts"), 1, only=True)
    last, _ = resolve(pin(single.drop("of_place")))
    names = [*KEY, "place"]
    return full.select(*names).unionByName(more.select(*names)).unionByName(last.select(*names))


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def merged(places: list[int] | None) -> list[tuple[int, int]]:
    """Maximal (start, end) runs of bytes that the blocks cover."""
    out: list[tuple[int, int]] = []
    for start, n, _ in map(unpacked, sorted(places or [])):
        end = start + n + LENGTH - 1
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def removal_spans(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text, places`` per row: the repeated blocks of every document (null for none)."""
    docs = texts(df, doc_id, text)
    lists = repeated_places(docs).groupBy(*KEY).agg(F.collect_set("place").alias("places"))
    return join_documents(docs, lists, "left").select("doc_id", "text", "places")


def without_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``RESULT`` and ``kept`` (the remaining bytes) per row of ``df``."""

    def run(batches):
        for batch in slices(batches):
            out = []
            for doc, text, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data, spans = encoded(text), merged(places)
                kept, at = [], 0
                for start, end in spans:
                    kept.append(data[at:start])
                    at = end
                rest = b"".join([*kept, data[at:]])
                sha = hashlib.sha256(rest).hexdigest()
                out.append((doc, len(data), len(data) - len(rest), len(spans), sha, rest))
            columns = zip(*out, strict=True) if out else [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
            )

    return removal_spans(df, doc_id, text).mapInArrow(run, f"{RESULT}, kept binary")
