"""Benchmark decontamination: short test items inside long documents.

A size-partitioned MinHash containment search finds candidates, exact shingle containment verifies
them. Items are partitioned by the number n of their distinct shingles, into bands that double.
The sketch of an item holds its k smallest shingle hashes, where k is set by the upper end u of its
band: k = u - ceil(t u) + 1 (at most n). A document that holds at least ceil(t n) of the n shingles
misses at most n - ceil(t n) of them, so it must hold at least k - (n - ceil(t n)) >= 1 sketch
hashes: the search loses no pair, at any document length. Only sketches, not whole items, meet the
shingle stream of the corpus; only candidates are verified, on the shingle texts themselves.

Words are runs of letters and digits after lower-casing; shingles have five words. An item with
fewer words is one shingle of its own width. All steps are DataFrame functions.

Nulls: a null or empty text has no shingles and neither matches nor is matched. Repeated document
rows give repeated result rows. Every distinct pair of item id and text is an item of its own, with
its own sketch, count and result rows: several texts of one id are searched one by one, a null id is
an id like others, and rows of equal id and text count once. Empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outledger.llm.common import filtered, text_key, texts
from outledger.session import pin

SHINGLE_WORDS = 5
PERCENT = 75
#: Sketch rows (16 bytes each) up to which the sketch table is broadcast; beyond it is shuffled.
BROADCAST_ROWS = 1_000_000


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def needed(n: Column, percent: int) -> Column:
    """Smallest number of shingles that is at least ``percent`` of n."""
    return F.ceil(n * F.lit(percent) / F.lit(100)).cast("long")


def shingles(w: Column, width: int) -> Column:
    """The shingles of ``width`` words as structs: shifted slices side by side, in linear time."""
    n = F.greatest(F.size(w) - F.lit(width - 1), F.lit(0))
    return F.arrays_zip(*(F.slice(w, F.lit(k + 1), n).alias(f"s{k}") for k in range(width)))


def shingle_hashes(df: DataFrame, width: int, keep: list[str]) -> DataFrame:
    """``keep`` and ``h`` for every shingle of ``width`` words of the array column ``w``."""
    rows = df.where(F.size("w") >= width)
    rows = rows.select(*keep, F.explode(shingles(F.col("w"), width)).alias("s"))
    return rows.select(*keep, F.xxhash64(*(F.col(f"s.s{k}") for k in range(width))).alias("h"))


def shingle_texts(w: Column, width: int) -> Column:
    """Distinct shingles of the word array ``w`` as texts."""

    def joined(s: Column) -> Column:
        return F.concat_ws(" ", *(s[f"s{k}"] for k in range(width)))

    return F.array_distinct(F.transform(shingles(w, width), joined))


def item_key() -> Column:
    """Hash of ``item_id`` and ``text``: the name of one item, also where ids repeat or are null."""
    return F.xxhash64("item_id", F.col("item_id").isNull(), "text")


def sketches(items: DataFrame, percent: int) -> DataFrame:
    """``item_key, width, n, hits, h``: the bottom-k sketch rows of ``item_key, width, w``."""
    n, u = F.col("n"), F.pow(F.lit(2.0), F.ceil(F.log2(F.col("n").cast("double")))).cast("long")
    k = F.least(n, u - needed(u, percent) + 1)
    parts = [
        shingle_hashes(items.where(F.col("width") == width), width, ["item_key", "width"])
        for width in range(1, SHINGLE_WORDS + 1)
    ]
    hashes = parts[0]
    for part in parts[1:]:
        hashes = hashes.unionByName(part)
    lists = hashes.groupBy("item_key", "width").agg(F.array_sort(F.collect_set("h")).alias("hs"))
    sized = lists.withColumn("n", F.size("hs").cast("long"))
    return sized.select(
        "item_key", "width", "n",
        (k - (n - needed(n, percent))).alias("hits"),
        F.explode(F.slice("hs", F.lit(1), k.cast("int"))).alias("h"),
    )


def contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    percent: int = PERCENT,
) -> DataFrame:
    """``doc_id, text_key, item_id, n_shingles, n_found, containment`` of the pairs that reach ``percent``.

    The corpus is read once for candidates; candidate documents are read again by key. No key of a
    shuffle is shared by documents: candidates are grouped by document and item.
    """
    items = texts(benchmark, item_id, item_text).withColumnRenamed("doc_id", "item_id")
    items = items.dropDuplicates().withColumn("w", words(F.col("text"))).where(F.size("w") > 0)
    items = pin(
        items.select(
            item_key().alias("item_key"), "item_id", "w",
            F.least(F.size("w"), F.lit(SHINGLE_WORDS)).alias("width"),
        )
    )
    sketch = pin(sketches(items, percent))
    small = sketch.count() <= BROADCAST_ROWS
    widths = [r["width"] for r in items.select("width").distinct().collect()]

    docs = texts(documents, doc_id, text).where(F.col("text").isNotNull())
    docs = docs.withColumn("text_key", text_key())
    worded = docs.select("doc_id", "text_key", words(F.col("text")).alias("w"))
    found = None
    for width in sorted(widths):
        rows = sketch.where(F.col("width") == width).drop("width")
        stream = shingle_hashes(worded, width, ["doc_id", "text_key"])
        hit = stream.join(F.broadcast(rows) if small else rows, "h")
        hit = hit.groupBy("doc_id", "text_key", "item_key", "n", "hits").agg(
            F.countDistinct("h").alias("got")
        )
        hit = hit.where(F.col("got") >= F.col("hits")).select("doc_id", "text_key", "item_key")
        found = hit if found is None else found.unionByName(hit)
    if found is None:
        found = docs.where("false").selectExpr("doc_id", "text_key", "0L item_key")

    candidates = pin(found.distinct().withColumnRenamed("doc_id", "of_doc"))
    paired = docs.join(
        candidates.withColumnRenamed("text_key", "of_key"),
        F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("text_key") == F.col("of_key")),
    ).select("doc_id", "text_key", "item_key", words(F.col("text")).alias("w"))
    counted = None
    for width in sorted(widths):
        own = shingle_texts(F.col("w"), width)
        rows = items.where(F.col("width") == width).select("item_key", "item_id", own.alias("wanted"))
        part = paired.join(rows, "item_key").select(
            "doc_id", "text_key", "item_id",
            F.size("wanted").cast("long").alias("n_shingles"),
            F.size(F.array_intersect(own, "wanted")).cast("long").alias("n_found"),
        )
        counted = part if counted is None else counted.unionByName(part)
    if counted is None:
        none = ("doc_id", "text_key", "0L item_id", "0L n_shingles", "0L n_found")
        counted = paired.selectExpr(*none)
    return counted.where(F.col("n_found") * 100 >= F.col("n_shingles") * percent).withColumn(
        "containment", F.col("n_found") / F.col("n_shingles")
    )


def clean_documents(
    documents: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    percent: int = PERCENT,
) -> DataFrame:
    """The rows of ``documents``, all columns, that hold no item."""
    hits = contaminated(documents, benchmark, doc_id, text, percent=percent)
    keys = pin(hits.select("doc_id", "text_key").distinct())
    return filtered(documents, keys, "left_anti", doc_id, text).select("row.*")
