"""Licence scans by a positional index of rare licence words.

Templates are short standard notices. Each word of a template has postings (template, position) and
an inverse document frequency over the templates. Of a file, the licence words of the highest
frequencies (those in at most ``max_df`` templates) are looked up; postings are intersected by
relative position: every hit votes for (template, offset of the template in the file). An offset
with enough weighted votes is verified: the template's mandatory phrases must stand at their places
(up to ``slack`` words away), and its score is the weight of template words found in place.

Base labels come from four phrases found anywhere; the templates add labels, never remove one.
Words are runs of ASCII letters, digits and non-ASCII characters after lower-casing A-Z. Null texts
are empty; an empty text has no words, no labels and score 0. Every hit of every file is used.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import DataFrame

from outledger.llm.common import encoded, map_rows, texts

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

# Base phrases and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Standard licence notices (label, notice, mandatory phrases).
TEMPLATES = (
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files the software to deal in the software "
        "without restriction",
        ("permission is hereby granted free of charge", "deal in the software without restriction"),
    ),
    ("mit", "released under the mit license", ("mit license",)),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or "
        "without fee is hereby granted provided that the above copyright notice and this "
        "permission notice appear in all copies",
        ("with or without fee is hereby granted",),
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
        ("redistribution and use in source and binary forms",),
    ),
    ("apache", "licensed under the apache license version 2 0", ("apache license",)),
    (
        "apache",
        "you may not use this file except in compliance with the license you may obtain a copy "
        "of the license at http www apache org licenses license 2 0",
        ("except in compliance with the license", "www apache org licenses"),
    ),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms "
        "of the gnu general public license as published by the free software foundation",
        ("gnu general public license",),
    ),
    (
        "gpl",
        "this work is licensed under the gnu general public license version 3",
        ("gnu general public license",),
    ),
    (
        "lgpl",
        "this library is free software you can redistribute it and or modify it under the terms "
        "of the gnu lesser general public license as published by the free software foundation",
        ("gnu lesser general public license",),
    ),
    (
        "agpl",
        "it under the terms of the gnu affero general public license as published by the free "
        "software foundation",
        ("gnu affero general public license",),
    ),
    (
        "mpl",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        ("mozilla public license",),
    ),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        ("unencumbered software released into the public domain",),
    ),
    (
        "cc-by-sa",
        "this work is licensed under a creative commons attribution sharealike 4 0 international "
        "license",
        ("creative commons attribution sharealike",),
    ),
    (
        "cc-by",
        "this work is licensed under a creative commons attribution 4 0 international license",
        ("creative commons attribution 4 0",),
    ),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("cc-by-nd", "licensed under cc by nd 4 0", ("cc by nd",)),
    ("cc0", "cc0 1 0 universal public domain dedication", ("cc0 1 0", "public domain dedication")),
)

SCAN = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, "
    "base_labels array<string>, matches array<struct<label:string,start:long,score:double>>"
)


@dataclass(frozen=True)
class Index:
    """Word lists, weights, postings of rare words and placed mandatory phrases of templates."""

    labels: list[str]
    words: list[list[bytes]]
    weight: dict[bytes, float]
    postings: dict[bytes, list[tuple[int, int]]]
    rare_weight: list[float]
    phrases: list[list[tuple[int, list[bytes]]]]
    slack: int
    least: float

    @classmethod
    def build(cls, templates=TEMPLATES, max_df: int = 3, slack: int = 3, least: float = 0.6):
        words = [notice.encode().split() for _, notice, _ in templates]
        df = defaultdict(int)
        for each in words:
            for word in set(each):
                df[word] += 1
        weight = {word: math.log(1 + len(words) / n) for word, n in df.items()}
        postings, rare = defaultdict(list), []
        for t, each in enumerate(words):
            chosen = [(p, w) for p, w in enumerate(each) if df[w] <= max_df]
            rare.append(sum(weight[w] for _, w in chosen))
            for p, w in chosen:
                postings[w].append((t, p))
        phrases = []
        for each, (_, _, mandatory) in zip(words, templates, strict=True):
            placed = [phrase.encode().split() for phrase in mandatory]
            phrases.append([(_find(each, phrase), phrase) for phrase in placed])
        labels = [label for label, _, _ in templates]
        return cls(labels, words, weight, dict(postings), rare, phrases, slack, least)

    def matches(self, file: list[bytes]) -> list[tuple[str, int, float]]:
        """Verified (label, start word, score), best per place and label, by start."""
        votes: dict[tuple[int, int], float] = defaultdict(float)
        postings = self.postings
        for at, word in enumerate(file):
            if word in postings:
                for t, p in postings[word]:
                    votes[t, at - p] += self.weight[word]
        found: dict[tuple[str, int], float] = {}
        for (t, start), got in votes.items():
            # Inserted or lost words shift later votes; those within the slack count together.
            near = sum(
                votes.get((t, start + d), 0.0) for d in range(-self.slack, self.slack + 1) if d
            )
            if got + near < self.least * self.rare_weight[t] or not self._has_phrases(file, t, start):
                continue
            score = self._score(file, t, start)
            key = (self.labels[t], max(start, 0))
            if score >= self.least:
                found[key] = max(found.get(key, 0.0), score)
        return [(label, start, score) for (label, start), score in sorted(found.items())]

    def _has_phrases(self, file: list[bytes], t: int, start: int) -> bool:
        for place, phrase in self.phrases[t]:
            places = range(max(start + place - self.slack, 0), start + place + self.slack + 1)
            if not any(file[i : i + len(phrase)] == phrase for i in places):
                return False
        return True

    def _score(self, file: list[bytes], t: int, start: int) -> float:
        """Weight of the template's words that stand within the slack of their places."""
        got = total = 0.0
        for p, word in enumerate(self.words[t]):
            total += self.weight[word]
            low = max(start + p - self.slack, 0)
            if word in file[low : max(start + p + self.slack + 1, 0)]:
                got += self.weight[word]
        return got / total


def _find(words: list[bytes], phrase: list[bytes]) -> int:
    n = len(phrase)
    for i in range(len(words) - n + 1):
        if words[i : i + n] == phrase:
            return i
    raise ValueError(f"phrase {phrase} is not in its template")


BASE = {tuple(phrase.encode().split()): label for phrase, label in BASE_PHRASES.items()}
BASE_STARTS = {phrase[0]: [p for p in BASE if p[0] == phrase[0]] for phrase in BASE}


def base_places(file: list[bytes]) -> list[tuple[int, str]]:
    """(start word, label) of every base phrase."""
    out = []
    for at, word in enumerate(file):
        if word in BASE_STARTS:
            for phrase in BASE_STARTS[word]:
                if tuple(file[at : at + len(phrase)]) == phrase:
                    out.append((at, BASE[phrase]))
    return out


def scan(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", index: Index | None = None
) -> DataFrame:
    """``SCAN`` per row: base places and verified template matches. One pass, no shuffle."""
    shared = df.sparkSession.sparkContext.broadcast(index or Index.build())

    def run(rows):
        out = {name: [] for name in ("n_words", "n_base", "first_word", "last_word")}
        labels, matches = [], []
        for text in rows["text"]:
            file = WORD.findall(encoded(text).lower())
            places = base_places(file)
            out["n_words"].append(len(file))
            out["n_base"].append(len(places))
            out["first_word"].append(places[0][0] if places else None)
            out["last_word"].append(places[-1][0] if places else None)
            labels.append(sorted({label for _, label in places}))
            matches.append(
                [
                    {"label": label, "start": start, "score": score}
                    for label, start, score in shared.value.matches(file)
                ]
            )
        return {"doc_id": rows["doc_id"]} | out | {"base_labels": labels, "matches": matches}

    return map_rows(texts(df, doc_id, text), run, SCAN)
