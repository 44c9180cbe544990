"""Importance resampling of documents towards a target distribution of hashed word features.

A feature is a run of one or two consecutive words; its bucket is a checksum modulo ``BUCKETS``. A
bucket's gain is the scaled log ratio of its smoothed shares in the target and in the corpus, a
document's weight the mean gain of its features, and its score the weight plus Gumbel noise that only
depends on seed and id. The highest scores are drawn: sampling without replacement in proportion to
exp(weight / scale).

1. Two passes over all texts: counts of every bucket (one array a task, summed by bucket), then
   weights by looking up the array of gains, which is the same size for every corpus.
2. The cutoff score is bracketed by two values of a quantile sketch. Exact counts of the scores above
   and inside tell whether the wanted rank lies in the bracket; while it does not, the bracket is
   widened, at last to all scores. Only rows inside it are sorted, by ranges, to find the cutoff row.
3. Rows up to the cutoff get ranks from one range sort.

Words are runs of letters, digits and non-ASCII characters after A-Z became a-z (lone surrogates count
as '?', hence as no word). Nulls and texts without words have no feature and weight 0. A null id has no
noise: its score is null, it is never drawn and not among the documents that the share is taken of. Ties
in score go to the smaller id, then to the smaller hash of the text; rows that are equal in all are
drawn one after the other. An empty table gives an empty result, an empty target equal shares for all
buckets. A very long text is held by one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outledger.llm.common import encoded, filtered, text_key, texts
from outledger.operators.batching import with_position
from outledger.session import pin

BUCKETS = 10_000
SCALE = 1000
PERCENT = 25
LEAST_WORDS = 20
SEED = 7
#: Accuracy of the quantile sketch, the first half width of the bracket as a share of all ranks, and
#: the factor by which it widens.
ACCURACY = 10_000
HALF_WIDTH = 0.0005
WIDER = 8
#: Bytes of text whose features are counted at a time.
CHUNK_BYTES = 4 << 20

WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return encoded(text).translate(WORD_BYTES).split(b" ")


def feature_buckets(text: str | None, buckets: int = BUCKETS) -> np.ndarray:
    """Buckets of all features of a text: first those of words, then those of pairs."""
    words = [w for w in words_of(text) if w]
    ones = list(map(crc32, words))
    twos = [crc32(b" " + w, c) for w, c in zip(words[1:], ones, strict=False)]
    return np.array(ones + twos, np.int64) % buckets


def bucket_counts(rows: DataFrame, buckets: int) -> np.ndarray:
    """Features in every bucket over all rows of ``text``; tasks send sums of parts, never texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some, held = np.zeros(buckets, np.int64), [], 0
        for batch in batches:
            for text in batch.column(0):
                some.append(feature_buckets(text.as_py(), buckets))
                held += some[-1].nbytes
                if held >= CHUNK_BYTES:
                    total += np.bincount(np.concatenate(some), minlength=buckets)
                    some, held = [], 0
        if some:
            total += np.bincount(np.concatenate(some), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    counted = rows.select("text").mapInArrow(run, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Floored scaled log ratio of smoothed shares."""
    n, m = int(corpus.sum()) + len(corpus), int(target.sum()) + len(target)
    ratios = ((t + 1) * n / ((s + 1) * m) for s, t in zip(corpus.tolist(), target.tolist(), strict=True))
    return np.array([math.floor(scale * math.log(r)) for r in ratios], np.int64)


def weighted(docs: DataFrame, gains: np.ndarray) -> DataFrame:
    """``doc_id, text_key, n_words, n_features, weight`` per row."""
    shared = docs.sparkSession.sparkContext.broadcast(gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = shared.value
            n, weights = [], []
            for text in batch.column(2):
                found = feature_buckets(text.as_py(), len(table))
                n.append(len(found))
                weights.append(int(table[found].sum()) // len(found) if len(found) else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([(x + 1) // 2 for x in n], pa.int64()),
                 pa.array(n, pa.int64()), pa.array(weights, pa.int64())],
                names=["doc_id", "text_key", "n_words", "n_features", "weight"],
            )

    columns = "doc_id long, text_key long, n_words long, n_features long, weight long"
    return docs.select("doc_id", "text_key", "text").mapInArrow(run, columns)


def noise(seed: int, scale: int = SCALE):
    """Floored scaled Gumbel noise of the column ``doc_id``; null for a null id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-float(scale)) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


ORDER = ["low", "doc_id", "text_key"]  # low: the score with its sign changed


def bracket(able: DataFrame, wanted: int, total: int) -> tuple[int, int, int]:
    """Bounds of ``low`` between which the row of rank ``wanted`` lies, and the rows before them."""
    half = HALF_WIDTH
    while True:
        share = (wanted - 0.5) / total
        ends = [max(0.0, share - half), min(1.0, share + half)]
        first, last = able.agg(F.percentile_approx("low", ends, ACCURACY).alias("q")).head()["q"]
        counts = able.agg(
            F.count_if(F.col("low") < first).alias("before"), F.count_if(F.col("low") <= last).alias("until")
        ).head()
        if counts["before"] < wanted <= counts["until"]:
            return first, last, counts["before"]
        if half >= 1:  # the sketch's ends are rounded too: take all
            ends = able.agg(F.min("low").alias("a"), F.max("low").alias("b")).head()
            return ends["a"], ends["b"], 0
        half *= WIDER


def resampled(
    df: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, text_key, n_words, n_features, weight, score, rank`` per row of ``df``.

    ``target`` holds a column ``text``. ``rank`` counts the drawn rows from 1, null elsewhere.
    """
    docs = texts(df, doc_id, text).withColumn("text_key", text_key())
    wanted_texts = target.select(F.col("text").cast("string").alias("text"))
    gains = bucket_gains(bucket_counts(docs, buckets), bucket_counts(wanted_texts, buckets))
    scores = weighted(docs, gains).withColumn("score", F.col("weight") + noise(seed))
    rows = pin(scores.withColumn("low", -F.col("score")))
    fits = F.col("score").isNotNull() & (F.col("n_words") >= least_words)
    able = rows.where(fits)
    total = able.count()
    n = percent * total // 100
    out = rows.drop("low")
    if n == 0:
        return out.withColumn("rank", F.lit(None).cast("long"))
    first, last, before = bracket(able, n, total)
    inside = with_position(able.where(F.col("low").between(first, last)).select(*ORDER), ORDER)
    cut = inside.where(F.col("pos") == n - before - 1).head()
    place = F.struct(*ORDER)
    early = place <= F.struct(*(F.lit(cut[c]).cast("long") for c in ORDER))
    drawn = with_position(able.where(early), ORDER)
    rank = F.when(F.col("pos") < n, F.col("pos") + 1).cast("long").alias("rank")
    rest = rows.where(~(fits & early) | F.col("score").isNull())
    return drawn.select(*out.columns, rank).unionByName(
        rest.select(*out.columns, F.lit(None).cast("long").alias("rank"))
    )


def drawn_documents(
    df: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", **how: int
) -> DataFrame:
    """The drawn rows of ``df``, all columns; of repeated rows that the cutoff parts, all are kept."""
    keys = pin(
        resampled(df, target, doc_id, text, **how).where("rank is not null").select("doc_id", "text_key").distinct()
    )
    return filtered(df, keys, "left_semi", doc_id, text).select("row.*")
