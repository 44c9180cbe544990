"""Prefix trie of conversations, peeled from the deepest turn to the root.

A conversation is a path: one chained 128-bit hash and one word count a turn. Equal paths are merged
first (a third of all conversations may be copies). Then, from the maximum depth on, the paths that end
at a depth are merged with the nodes that deeper ones have left there, the merged nodes are finished
and counted, their last turn is stripped, and what is left is regrouped one depth higher. Members,
children, leaves and savings of a subtree are sums carried along, so each node is touched once.

* Depths up to ``TOP``, and any depth with more than half of ``BAND_ROWS`` paths, are one grouping in
  Spark each, with map-side combine: a first turn that all conversations share is no hot key.
* Deeper and thinner depths are peeled several at a time: bands of at most ``BAND_ROWS`` path turns in
  all, dealt by the subtree they belong to and peeled inside tasks. Jobs grow with the rows of the
  deep depths over ``BAND_ROWS``, not with the longest conversation.
* The ids that end at a node are sorted by ranges, joined to pieces of text in tasks, and digested
  piece by piece, so a node at which a third of all conversations end is a short list of pieces.
* A node gets its parent's id by a join; parents of more children than a ten-thousandth of all nodes
  (so fewer than ``HEAVY`` of them) are broadcast, the others are joined by key.

Turns are ordered by turn number, null first, equal ones by a hash of role and text; null roles and texts
are empty. Rows of a null conversation id belong to no conversation. Repeated rows are turns of their
own. An empty table has no node, not even a root. Only hashes and counts of very long texts are shuffled;
the path of one conversation (24 bytes a turn) is held by one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outledger.llm.common import arrow_schema
from outledger.session import pin

TOP = 8
BAND_ROWS = 200_000
HEAVY = 10_000
#: Least number of children of a broadcast parent, and ids in a piece of text.
LEAST_HEAVY = 64
PIECE_IDS = 4096

PATH = "path array<struct<key: binary, words: long>>"
PARTIAL = f"{PATH}, depth int, conv_id long, n long, children long, leaves long, saved long"
COUNTS = ["n", "children", "leaves", "saved"]


def hashed_turns(
    df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``conv_id, i, digest, words`` of every turn; ``i`` counts from 0 within a conversation."""
    said = {name: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for name, c in (("r", role), ("t", text))}
    rows = df.select(F.col(f"`{conv_id}`").cast("long").alias("conv_id"), F.col(f"`{turn}`").cast("long").alias("turn"),
                     *(c.alias(name) for name, c in said.items())).where("conv_id is not null")
    whole = F.concat(F.octet_length("r").cast("string"), F.lit(":"), "r", "t").cast("binary")
    words = F.regexp_count("t", F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    narrow = rows.select("conv_id", "turn", F.unhex(F.sha2(whole, 256)).alias("digest"), words.alias("words"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "digest")
    return narrow.select("conv_id", (F.row_number().over(order) - 1).alias("i"), "digest", "words")


def rebuilt(turns: DataFrame, group: int, heads: int) -> DataFrame:
    """``conv_id, i, digest, words``: every conversation starts with the first turns of its group's first.

    Conversation c takes h = crc32(c) mod ``heads`` turns from conversation c - c mod ``group``, then its
    own from the (h + 1)th on. A row without a digest stands for each conversation, also a turnless one.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    every = turns.select("conv_id").distinct()
    own = turns.where(F.col("i") >= h)
    first = turns.where(F.col("i") < heads - 1).withColumnRenamed("conv_id", "base")
    start = every.withColumn("base", F.col("conv_id") - F.col("conv_id") % group).join(first, "base")
    start = start.where(F.col("i") < h).select("conv_id", "i", "digest", "words")
    marks = every.select(
        "conv_id", F.lit(-1).alias("i"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("words")
    )
    return own.unionByName(start).unionByName(marks)


def paths(turns: DataFrame) -> DataFrame:
    """``conv_id`` and ``path``: the chained hash and the words of each of its turns."""
    turn = F.when(F.col("digest").isNotNull(), F.struct("i", "digest", "words"))
    listed = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    columns = listed.select("conv_id", F.col("turns.digest").alias("digests"), F.col("turns.words").alias("words"))
    schema = arrow_schema(turns.sparkSession, f"conv_id long, {PATH}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for digests, words in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                key, path = b"", []
                for digest, n in zip(digests, words, strict=True):
                    key = hashlib.blake2b(key + digest, digest_size=16).digest()
                    path.append((key, n))
                out.append(path)
            kinds = schema.field("path").type
            listed_ = [[{"key": k, "words": n} for k, n in path] for path in out]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(listed_, kinds)], schema=schema)

    return columns.mapInArrow(run, f"conv_id long, {PATH}")


def key_at(depth: Column | int) -> Column:
    """The hash that names the prefix of that many turns, empty for the root."""
    at = F.lit(depth) if isinstance(depth, int) else depth
    return F.when(at > 0, F.try_element_at("path", at)["key"]).otherwise(F.lit(b""))


def finished(partial: DataFrame) -> DataFrame:
    """Merged rows of one depth as nodes: a childless node is a leaf, and its own savings are added."""
    words = F.coalesce(F.try_element_at("path", F.greatest("depth", F.lit(1)))["words"], F.lit(0).cast("long"))
    return partial.withColumns({
        "leaves": F.when(F.col("children") > 0, F.col("leaves")).otherwise(F.lit(1).cast("long")),
        "saved": F.col("saved") + (F.col("n") - 1) * words,
    })


def stripped(nodes: DataFrame) -> DataFrame:
    """Nodes without their last turn: what they add to their parent."""
    return nodes.withColumns({
        "depth": F.col("depth") - 1,
        "path": F.slice("path", F.lit(1), F.col("depth") - 1),
        "children": F.lit(1).cast("long"),
    })


def merged(rows: DataFrame) -> DataFrame:
    """One row a prefix."""
    sums = (F.sum(c).alias(c) for c in COUNTS)
    return rows.groupBy("path", "depth").agg(F.min("conv_id").alias("conv_id"), *sums)


def peeled_in_tasks(rows: DataFrame, low: int) -> DataFrame:
    """Rows of one band deeper than ``low``: its nodes, and rows of depth ``low`` that are left of them."""
    schema = arrow_schema(rows.sparkSession, PARTIAL)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        depths: dict[int, dict[bytes, list]] = {}

        def add(path: list, depth: int, conv: int, *counts: int) -> None:
            key = path[depth - 1]["key"] if depth else b""
            node = depths.setdefault(depth, {}).get(key)
            if node is None:
                depths[depth][key] = [path, conv, *counts]
            else:
                node[1] = min(node[1], conv)
                node[2:] = [a + b for a, b in zip(node[2:], counts, strict=True)]

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                add(*row)
        for depth in range(max(depths, default=low), low, -1):
            out = []
            for path, conv, n, children, leaves, saved in depths.pop(depth, {}).values():
                leaves, saved = leaves if children else 1, saved + (n - 1) * path[depth - 1]["words"]
                out.append((path[:depth], depth, conv, n, children, leaves, saved))
                add(path, depth - 1, conv, n, 1, leaves, saved)
            yield from batches_of(out)
        left = depths.pop(low, {}).values()
        yield from batches_of([(path[:low], low, *rest) for path, *rest in left])

    def batches_of(out: list[tuple]) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(out), 1000):
            columns = zip(*out[at : at + 1000], strict=True)
            arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    names = [f.name for f in schema]
    dealt = rows.select(*names).repartition(parts, key_at(low + 1))
    return dealt.mapInArrow(run, PARTIAL)


def bands(lengths: dict[int, int]) -> list[tuple[int, int]]:
    """Depths in the order of peeling, as (low, high]; a band of one depth is grouped by Spark."""
    deepest = max(lengths)
    at_least, above = [0] * (deepest + 2), 0
    for d in range(deepest, -1, -1):
        above += lengths.get(d, 0)
        at_least[d] = above
    out, high = [], deepest
    while high >= 0:
        low, rows = high, 0
        while low > TOP and at_least[low] <= BAND_ROWS // 2 and rows + at_least[low] <= BAND_ROWS:
            rows += at_least[low]
            low -= 1
        low = min(low, high - 1)
        out.append((low, high))
        high = low
    return out


def peeled(ended: DataFrame) -> DataFrame:
    """All nodes (``PARTIAL`` columns, finished) from the distinct paths and their counts."""
    lengths = {r["depth"]: r["n"] for r in ended.groupBy("depth").agg(F.count("*").alias("n")).collect()}
    found, left = [], None
    for low, high in bands(lengths) if lengths else []:
        rows = ended.where((F.col("depth") > low) & (F.col("depth") <= high))
        if left is not None:
            rows = rows.unionByName(left)
        if high <= TOP or high - low == 1:
            nodes = pin(finished(merged(rows)))
            left = stripped(nodes)
        else:
            both = pin(peeled_in_tasks(rows, low))
            nodes, left = both.where(F.col("depth") > low), both.where(F.col("depth") == low)
        found.append(nodes)
    out = ended.limit(0) if not found else found[0]
    for nodes in found[1:]:
        out = out.unionByName(nodes)
    return out


def end_digests(ends: DataFrame) -> DataFrame:
    """``key, ends_sha256``: digest of the ids in order, joined by commas, for every ``key``."""
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids = None, []

        def piece() -> pa.RecordBatch:
            columns = [pa.array([key], pa.binary()), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])]
            return pa.RecordBatch.from_arrays(columns, names=["key", "first", "ids"])

        for batch in batches:
            for of, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if ids and (of != key or len(ids) == PIECE_IDS):
                    yield piece()
                    ids = []
                key = of
                ids.append(conv)
        if ids:
            yield piece()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None

        def digest() -> pa.RecordBatch:
            columns = [pa.array([key], pa.binary()), pa.array([sha.hexdigest()])]
            return pa.RecordBatch.from_arrays(columns, names=["key", "ends_sha256"])

        for batch in batches:
            for of, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if sha is not None and of == key:
                    sha.update(b",")
                else:
                    if sha is not None:
                        yield digest()
                    key, sha = of, hashlib.sha256()
                sha.update(ids.encode())
        if sha is not None:
            yield digest()

    ranged = ends.select("key", "conv_id").repartitionByRange(parts, "key", "conv_id")
    made = ranged.sortWithinPartitions("key", "conv_id").mapInArrow(pieces, "key binary, first long, ids string")
    dealt = made.repartition(parts, "key").sortWithinPartitions("key", "first")
    return dealt.select("key", "ids").mapInArrow(digests, "key binary, ends_sha256 string")


def with_parents(nodes: DataFrame) -> DataFrame:
    """``parent_conv_id`` beside ``key, parent_key, conv_id, depth, n_children``."""
    limit = max(LEAST_HEAVY, nodes.count() // HEAVY)
    parent = nodes.where("n_children > 0").select(
        F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"), "n_children"
    )
    heavy = parent.where(F.col("n_children") > limit).drop("n_children")
    light = parent.where(F.col("n_children") <= limit).drop("n_children")
    rows = nodes.join(F.broadcast(heavy), "parent_key", "left")  # fewer than HEAVY rows, or nodes / LEAST_HEAVY
    done = rows.where(F.col("parent_conv_id").isNotNull() | (F.col("depth") == 0))
    open_ = rows.where(F.col("parent_conv_id").isNull() & (F.col("depth") > 0)).drop("parent_conv_id")
    return done.unionByName(open_.join(light, "parent_key"))


def prefix_trie(
    df: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    group: int = 20,
    heads: int = 4,
) -> DataFrame:
    """One row a distinct prefix of the rebuilt conversations.

    Columns ``key, parent_key`` (hashes that name prefixes), ``conv_id`` (smallest member), ``depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``. With ``heads`` 1 the
    conversations are taken as they are.
    """
    turns = pin(hashed_turns(df, conv_id, turn, role, text))
    whole = pin(paths(rebuilt(turns, group, heads)).withColumn("depth", F.size("path")))
    zero = F.lit(0).cast("long")
    ended = whole.groupBy("path", "depth").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n"))
    ended = pin(ended.select("path", "depth", "conv_id", "n", *(zero.alias(c) for c in COUNTS[1:])))
    nodes = peeled(ended).select(
        key_at(F.col("depth")).alias("key"),
        F.when(F.col("depth") > 0, key_at(F.col("depth") - 1)).alias("parent_key"), "conv_id",
        F.col("depth").cast("long").alias("depth"), F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
    )
    ends = end_digests(whole.select(key_at(F.col("depth")).alias("key"), "conv_id"))
    none = F.lit(hashlib.sha256().hexdigest())
    joined = with_parents(pin(nodes)).join(ends, "key", "left")
    return joined.withColumn("ends_sha256", F.coalesce("ends_sha256", none))
