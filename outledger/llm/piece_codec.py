"""SentencePiece BPE encoding and decoding over a table of distinct chunks.

In a vocabulary whose pieces never hold the marker after another character, no merge crosses from
one marked word to the next, so a text is a sequence of independent chunks: markers followed by
other characters. Nor does a merge cross a place whose two neighbours stand side by side in no piece,
so chunks are cut there too: first, by one pattern, into runs of characters that pieces link, which
leaves words without the punctuation around them. Each distinct run is segmented once and its ids are
joined back by position. A vocabulary whose pieces hold the marker after another character is refused.

Segmentation is the library's: all characters are symbols, the adjacent pair whose merged piece
has the best score is merged first (the leftmost of equals), and a symbol without a piece becomes
its UTF-8 bytes. Decoding concatenates pieces, turns byte pieces back into characters, markers
into blanks, and drops the first blank.

Null texts are empty; an empty text has no ids. Very long chunks use a heap, so that the work is
n log n.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterable
from dataclasses import dataclass
from itertools import chain, repeat
from operator import add

from pyspark.sql import DataFrame

from outledger.llm.common import encoded, map_rows, texts

MARK = "▁"
NO_PAIR = float("-inf")
ENCODED = "doc_id long, ids array<int>"
DECODED = "doc_id long, text string"
BOTH = "doc_id long, n_tokens long, ids array<int>, text string"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
Row = tuple[tuple[int, ...], str, str]


def runs_pattern(neighbours: Iterable[str]) -> re.Pattern[str]:
    """Blanks and then one character, or several that pieces link, directly or by way of others.

    Such groups of characters share no piece, so no merge crosses from one run to the next.
    """
    groups: dict[str, set[str]] = {}
    for pair in neighbours:
        if MARK not in pair and " " not in pair:
            one, other = sorted((groups.setdefault(c, {c}) for c in pair), key=len)
            if one is not other:
                other |= one
                groups.update(dict.fromkeys(one, other))
    largest = sorted({id(g): g for g in groups.values()}.values(), key=lambda g: (-len(g), min(g)))
    several = "".join(f"[{''.join(map(re.escape, sorted(g)))}]+|" for g in largest)
    return re.compile(f" *(?:{several}[^ ])| +", re.DOTALL)


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with ids and scores, the 256 byte pieces both ways, the pieces by id, all pairs of
    characters that are neighbours in a piece, the pattern of a chunk's runs, and what each id but
    those of bytes decodes to."""

    ids: dict[str, int]
    scores: dict[str, float]
    bytes_: dict[int, int]
    byte_of: dict[int, int]
    pieces: list[str]
    neighbours: frozenset[str]
    runs: re.Pattern[str]
    shown: dict[int, str]

    @classmethod
    def load(cls, model_path: str) -> Vocabulary:
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(model_path, "rb") as file:
            model.ParseFromString(file.read())
        rules = model.normalizer_spec
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.add_dummy_prefix:
            raise ValueError("only vocabularies that leave texts as they are can be used")
        if not model.trainer_spec.byte_fallback or model.trainer_spec.model_type != 2:
            raise ValueError("a BPE vocabulary with byte pieces is needed")
        ids, scores, bytes_ = {}, {}, {}
        for i, p in enumerate(model.pieces):
            if p.type == p.NORMAL:
                if MARK in p.piece.lstrip(MARK):
                    raise ValueError(f"piece {p.piece!r} crosses a word boundary")
                ids[p.piece], scores[p.piece] = i, p.score
            elif p.type == p.BYTE:
                bytes_[int(p.piece[3:-1], 16)] = i
        byte_of = {i: b for b, i in bytes_.items()}
        neighbours = frozenset(pair for piece in ids for pair in map(add, piece, piece[1:]))
        pieces = [p.piece for p in model.pieces]
        shown = {
            i: p.replace(MARK, " ") if p in ids else "" for i, p in enumerate(pieces) if i not in byte_of
        }
        return cls(ids, scores, bytes_, byte_of, pieces, neighbours, runs_pattern(neighbours), shown)

    def parts(self, chunk: str) -> list[str]:
        """The chunk cut wherever no merge can join what stands left and right."""
        held = self.neighbours
        cuts = [at for at, pair in enumerate(map(add, chunk, chunk[1:]), 1) if pair not in held]
        if not cuts:
            return [chunk]
        return [chunk[start:end] for start, end in zip([0, *cuts], [*cuts, None], strict=True)]

    def segment(self, chunk: str) -> list[str]:
        """Pieces of one chunk; short chunks by the scores of their pairs, long ones by a heap."""
        parts, score = list(chunk), self.scores.get
        if len(parts) > 64:
            return self._segment_long(parts)
        pairs = list(map(score, map(add, chunk, chunk[1:]), repeat(NO_PAIR)))
        while pairs and (best := max(pairs)) > NO_PAIR:
            at = pairs.index(best)
            merged = parts[at] = parts[at] + parts.pop(at + 1)
            del pairs[at]
            if at:
                pairs[at - 1] = score(parts[at - 1] + merged, NO_PAIR)
            if at < len(pairs):
                pairs[at] = score(merged + parts[at + 1], NO_PAIR)
        return parts

    def _segment_long(self, parts: list[str]) -> list[str]:
        scores, n = self.scores, len(parts)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap: list[tuple[float, int, int, str]] = []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right >= 0:
                merged = parts[left] + parts[right]
                if merged in scores:
                    heapq.heappush(heap, (-scores[merged], left, right, merged))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, left, right, merged = heapq.heappop(heap)
            if after[left] != right or parts[left] + parts[right] != merged or not parts[left]:
                continue
            parts[left], parts[right] = merged, ""
            after[left] = after[right]
            if after[right] >= 0:
                before[after[right]] = left
            offer(before[left], left)
            offer(left, after[left])
        return [p for p in parts if p]

    def encode_chunk(self, chunk: str) -> list[int]:
        """Ids of one chunk, with byte pieces where a symbol has no piece."""
        parts = self.segment(chunk)
        found = list(map(self.ids.get, parts))
        if None not in found:
            return found
        out: list[int] = []
        for part in parts:
            known = self.ids.get(part)
            if known is None:
                out.extend(self.bytes_[b] for b in part.encode("utf-8", "replace"))
            else:
                out.append(known)
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of ids without the blank that the encoding puts in front."""
        text = self.decode_chunk(ids)
        return text[1:] if text.startswith(" ") else text

    def decode_chunk(self, ids: list[int]) -> str:
        """Text of the ids of whole chunks, marker as blank; control ids are silent."""
        found = list(map(self.shown.get, ids))
        if None not in found:
            return "".join(found)
        byte_of = self.byte_of
        out, pending = [], bytearray()
        for i in ids:
            if i in byte_of:
                pending.append(byte_of[i])
                continue
            if pending:
                out.append(pending.decode("utf-8", "replace"))
                pending.clear()
            piece = self.pieces[i]
            if piece in self.ids:
                out.append(piece)
        if pending:
            out.append(pending.decode("utf-8", "replace"))
        return "".join(out).replace(MARK, " ")


class ChunkTable(dict):
    """Distinct runs of a task's chunks: ids, their text form and their decoding.

    A run is kept as it stands in the text, with the blanks before it for markers: a word is one run,
    segmented once, whatever punctuation stands around it. ``parts`` holds the parts of the runs that
    can be cut further. ``most`` bounds the runs and the parts, each table by itself; a full one is
    cleared, and its rows are made again as they are asked for.
    """

    def __init__(self, vocabulary: Vocabulary, most: int):
        super().__init__()
        self.vocabulary, self.most, self.parts = vocabulary, most, {}

    def __missing__(self, run: str) -> Row:
        # Cutting is never needed for the result: letters alone are left whole.
        if run.lstrip(" ").isalpha():
            row = self._segmented(run.replace(" ", MARK))
        else:
            rows = list(map(self._part, self.vocabulary.parts(run.replace(" ", MARK))))
            row = rows[0]
            if len(rows) > 1:
                ids, forms, texts = zip(*rows, strict=True)
                row = (tuple(chain.from_iterable(ids)), ",".join(forms), "".join(texts))
        self[run] = row
        return row

    def _part(self, part: str) -> Row:
        row = self.parts.get(part)
        if row is None:
            if len(self.parts) > self.most:
                self.parts.clear()
            row = self.parts[part] = self._segmented(part)
        return row

    def _segmented(self, part: str) -> Row:
        # Tuples, which the garbage collector need not look into again.
        ids = tuple(self.vocabulary.encode_chunk(part))
        return ids, ",".join(map(str, ids)), self.vocabulary.decode_chunk(ids)

    def look_up(self, text: str | None) -> list[Row]:
        """Table rows of a text's runs, in order of position."""
        if not text:
            return []
        if len(self) > self.most:
            self.clear()
        runs = self.vocabulary.runs.findall(" " + text.replace(MARK, " "))
        return list(map(self.__getitem__, runs))


def _table(df: DataFrame, model_path: str, remembered: int):
    shared = df.sparkSession.sparkContext.broadcast(Vocabulary.load(model_path))
    held: list[ChunkTable] = []

    def get() -> ChunkTable:
        if not held:
            held.append(ChunkTable(shared.value, remembered))
        return held[0]

    return get


def encode(
    df: DataFrame,
    model_path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    remembered: int = 400_000,
) -> DataFrame:
    """``ids`` of each row's text. A task keeps at most about ``remembered`` distinct runs of its
    chunks, and as many parts of them."""
    get = _table(df, model_path, remembered)

    def run(rows):
        ids = [[i for row in get().look_up(text) for i in row[0]] for text in rows["text"]]
        return {"doc_id": rows["doc_id"], "ids": ids}

    return map_rows(texts(df, doc_id, text), run, ENCODED)


def decode(df: DataFrame, model_path: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``text`` of each row's ids; null ids give an empty text."""
    shared = df.sparkSession.sparkContext.broadcast(Vocabulary.load(model_path))

    def run(rows):
        return {
            "doc_id": rows["doc_id"],
            "text": [shared.value.decode(x or []) for x in rows["ids"]],
        }

    chosen = df.selectExpr(f"cast(`{doc_id}` as long) doc_id", f"`{ids}` ids")
    return map_rows(chosen, run, DECODED)


def round_trip(
    df: DataFrame,
    model_path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    remembered: int = 400_000,
) -> DataFrame:
    """``DIGESTS`` of encoding and then decoding each row, without holding ids of a batch."""
    get = _table(df, model_path, remembered)

    def run(rows):
        n, of_ids, of_text = [], [], []
        for text in rows["text"]:
            found = get().look_up(text)
            back = "".join([row[2] for row in found])
            joined = ",".join([row[1] for row in found])
            n.append(joined.count(",") + 1 if found else 0)
            of_ids.append(hashlib.sha256(joined.encode()).hexdigest())
            back = back[1:] if back.startswith(" ") else back
            of_text.append(hashlib.sha256(encoded(back)).hexdigest())
        return {
            "doc_id": rows["doc_id"],
            "n_tokens": n,
            "ids_sha256": of_ids,
            "decoded_sha256": of_text,
        }

    return map_rows(texts(df, doc_id, text), run, DIGESTS)


def encoded_and_decoded(
    df: DataFrame,
    model_path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    remembered: int = 400_000,
) -> DataFrame:
    """``BOTH``: the ids of each row's text and the text that they decode to."""
    get = _table(df, model_path, remembered)

    def run(rows):
        n, ids, back = [], [], []
        for text in rows["text"]:
            found = get().look_up(text)
            ids.append([i for row in found for i in row[0]])
            n.append(len(ids[-1]))
            restored = "".join([row[2] for row in found])
            back.append(restored[1:] if restored.startswith(" ") else restored)
        return {"doc_id": rows["doc_id"], "n_tokens": n, "ids": ids, "text": back}

    return map_rows(texts(df, doc_id, text), run, BOTH)
