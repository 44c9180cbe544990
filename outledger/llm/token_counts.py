"""Word-piece lengths by a linear longest-match automaton.

A vocabulary trie gets failure links as in linear MaxMatch: when no edge fits, the node's link
leads to the node that the rest of its string stands for once its greedy pieces are popped, and
the link carries how many pieces that pops. A word is read once, character by character, and only
counts are added; no piece is ever built.

Words lie between ASCII white space. A word starts with the marker; pieces that start with the
marker fit only there, other pieces only later. A word that cannot be covered is one unknown piece.
Null and empty texts have 0 words and 0 pieces.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outledger.llm.common import BLANKS, map_rows, texts

MARK = "▁"
COUNTS = "doc_id long, n_words long, n_tokens long, n_unknown long"
SPLIT = str.maketrans({c: " " for c in BLANKS.decode()})


def pieces_of(model_path: str) -> list[str]:
    """Ordinary pieces of a vocabulary file of the sentencepiece library."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(model_path, "rb") as file:
        model.ParseFromString(file.read())
    return [p.piece for p in model.pieces if p.type == p.NORMAL]


class PieceCounter:
    """The automaton. Nodes are numbered; node 0 is the word start, node 1 the root of later pieces."""

    def __init__(self, pieces: list[str]):
        self.edges: list[dict[str, int]] = [{}, {}]
        final = [False, False]
        for piece in pieces:
            if piece.startswith(MARK):
                node, rest = 0, piece[len(MARK) :]
            else:
                node, rest = 1, piece
            for c in rest:
                step = self.edges[node].get(c)
                if step is None:
                    step = self.edges[node][c] = len(self.edges)
                    self.edges.append({})
                    final.append(False)
                node = step
            final[node] = final[node] or bool(rest)
        bare = MARK in pieces  # the marker alone is a piece: a word may start with any later piece
        self.link: list[int | None] = [None] * len(self.edges)
        self.popped = [0] * len(self.edges)
        if bare:
            self.link[0], self.popped[0] = 1, 1
        queue = deque([0, 1])
        while queue:
            node = queue.popleft()
            for c, child in self.edges[node].items():
                if final[child]:
                    self.link[child], self.popped[child] = 1, 1
                else:
                    at, n = self.link[node], self.popped[node]
                    while at is not None and c not in self.edges[at]:
                        n += self.popped[at]
                        at = self.link[at]
                    if at is not None:
                        self.link[child], self.popped[child] = self.edges[at][c], n
                queue.append(child)

    def count(self, word: str) -> int:
        """Pieces of one word without its marker; 0 if no cover exists."""
        node, n = 0, 0
        for c in word:
            while c not in self.edges[node]:
                if self.link[node] is None:
                    return 0
                n += self.popped[node]
                node = self.link[node]
            node = self.edges[node][c]
        while node != 1:
            if self.link[node] is None:
                return 0
            n += self.popped[node]
            node = self.link[node]
        return n


def token_counts(
    df: DataFrame,
    model_path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    remembered: int = 300_000,
) -> DataFrame:
    """``COUNTS`` per row. A task reads each distinct word once, up to ``remembered`` at a time.

    The vocabulary (bounded by its file) goes to tasks as a broadcast variable.
    """
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(PieceCounter(pieces_of(model_path)))
    known: dict[str, int] = {}

    def run(rows):
        counter, out = shared.value, {"n_words": [], "n_tokens": [], "n_unknown": []}
        for text in rows["text"]:
            words = [w for w in (text or "").translate(SPLIT).split(" ") if w]
            if len(known) > remembered:
                known.clear()
            for word in set(words).difference(known):
                known[word] = counter.count(word)
            counts = [known[w] for w in words]
            unknown = counts.count(0)
            out["n_words"].append(len(words))
            out["n_tokens"].append(sum(counts) + unknown)
            out["n_unknown"].append(unknown)
        return {"doc_id": rows["doc_id"]} | out

    return map_rows(texts(df, doc_id, text), run, COUNTS)


def corpus_total(counts: DataFrame) -> DataFrame:
    """One row: documents, words, tokens of all counted documents."""
    return counts.agg(
        F.count("*").alias("n_docs"),
        F.sum("n_words").alias("n_words"),
        F.sum("n_tokens").alias("n_tokens"),
    )
