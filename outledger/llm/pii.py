"""Personal data by candidate gradient boosting.

High-recall generators propose overlapping spans: the strict patterns before validation and loose
forms of the same kinds (7 to 15 digits in any grouping, cards with any separators, IPv6 written out
or compressed, addresses spelled out). Each candidate gets format features (digits, separators,
checksum, parts) and context features (cue words right before it, borders). Boosted depth-two trees, one model per kind, are fitted to the
counts of feature vectors over all candidates of the corpus: half of the documents fit the trees,
the other half calibrates them (Platt) and sets each kind's threshold, the lowest probability at
which the selection is right in at least ``precision`` of the calibration candidates. Validated
strict matches are always redacted; other candidates only above their threshold.

Labels of the fit: a validated strict match is 1; a strict match that fails its check is 0. A loose
candidate is 1 if its format holds (checksum, IPv6 groups, no date) and it either has a form that no
other number has (card groups, three groups of IPv6) or a cue word of its kind within ``NEAR``
characters. The cue feature sees only the words right before the candidate, so for phones and
addresses the label is no function of the features. A loose candidate that overlaps a validated
strict match is kept only if it reaches beyond it and holds all of it (06.12.34.56.78 holds an IP).

The driver sees only counts by feature vector (at most 4 x 2 x 2^17 rows); everything on rows is
DataFrame functions. Offsets are code points, ends exclusive. Null texts are empty and have no
spans; equal rows get equal spans; an empty table fits no tree and gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outledger.llm.common import texts
from outledger.session import pin

KINDS = ("email", "ip", "card", "phone")

# Strict patterns. Possessive loops and look-behinds match what the plain forms match, in linear
# time and without recursion: a run is only tried from its start or from the end of a match.
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
BETWEEN = r"[\x20\u00a0./_\u2011\u2013-]{0,3}"
GAP = r"[\x20\u00a0./_\u2011\u2013-]{1,3}"
CARD_GROUPS = rf"[0-9]{{4}}(?:{GAP}[0-9]{{4}}{GAP}[0-9]{{4}}{GAP}[0-9]{{1,7}}|{GAP}[0-9]{{6}}{GAP}[0-9]{{4,5}})"
# Several patterns of a kind may propose overlapping spans; equal spans count once.
LOOSE = {
    "email": (
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?(?i:\(at\)|\[at\]|\x20at\x20)\x20?"
        r"[A-Za-z0-9-]{1,63}\x20?(?i:\(dot\)|\[dot\]|\x20dot\x20|\.)\x20?[A-Za-z]{2,24}",
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?(?i:\(at\)|\[at\]|\x20at\x20)\x20?[A-Za-z0-9-]{1,63}"
        r"(?:\x20?(?i:\(dot\)|\[dot\]|\x20dot\x20|\.)\x20?[A-Za-z0-9-]{2,63}){2,4}",
    ),
    "ip": (
        r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{0,4}:){2,7}(?:[0-9]{1,3}(?:\.[0-9]{1,3}){3}|[0-9A-Fa-f]{0,4})(?![0-9A-Za-z:])",
    ),
    "card": (
        rf"(?<![0-9])[0-9](?:{BETWEEN}[0-9]){{11,18}}(?![0-9])",
        rf"(?<![0-9]){CARD_GROUPS}(?![0-9])",
        r"(?<![0-9])[0-9]{12,19}(?![0-9])",
    ),
    "phone": (
        r"(?<![0-9A-Za-z+])\+?\(?[0-9](?:[\x20\u00a0()./\u2011\u2013-]{0,3}[0-9]){6,14}(?![0-9A-Za-z])",
        r"(?<![0-9A-Za-z+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z])",
        r"(?<![0-9A-Za-z+])[0-9]{7,15}(?![0-9A-Za-z])",
        # From a trunk zero or an area code in brackets on, whatever digits stand before.
        r"(?<![0-9A-Za-z+])(?:\(0?|0)[0-9](?:[\x20\u00a0()./\u2011\u2013-]{0,3}[0-9]){5,13}(?![0-9A-Za-z])",
    ),
}
# A cheap test that must hold before a pattern is tried on a text.
GUARDS = {
    "email": "@", "ip": r"[0-9]\.[0-9]++\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){13}", "phone": r"\+[0-9]",
}
LOOSE_GUARDS = {
    "email": r"(?i)[\x20(\[]at[\x20)\]]", "ip": r":[0-9A-Fa-f]{0,4}:",
    "card": rf"[0-9](?:{BETWEEN}[0-9]){{11}}", "phone": r"[0-9](?:[\x20\u00a0()./\u2011\u2013-]{0,3}[0-9]){6}",
}
# Cue words in English, German, French and Spanish.
CUES = {
    "email": r"e-?mail|contact|write to|reach|mail|kontakt|courriel|correo|contacto",
    "ip": r"\bip|ipv6|host|server|login|address|adresse|serveur|servidor",
    "card": r"card|visa|mastercard|amex|credit|iban|karte|kartennummer|carte|tarjeta",
    "phone": (
        r"\btel|phone|call|mobile|cell|fax|telefon|telefono|tel\u00e9fono|t\u00e9l|t\u00e9l\u00e9phone|handy|mobil"
        r"|rufnummer|anruf|portable|appelez|m\u00f3vil|llame|llama"
    ),
}
FILLERS = {
    "email": r"is|at|me|ist|est|es", "ip": r"is|from|at|ist|est|es",
    "card": r"no|number|is|nr|nummer|num\u00e9ro|n\u00famero|ist|est|es",
    "phone": r"no|number|is|me at|at|us at|nr|nummer|num\u00e9ro|n\u00famero|ist|est|es|unter|au|al",
}
DATE = (
    r"^(?:(?:19|20)[0-9]{2}([./\x20-])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([./\x20-])[0-9]{1,2}\2(?:19|20)[0-9]{2}"
    r"|(?:19|20)[0-9]{2}(?:0[1-9]|1[0-2])(?:0[1-9]|[12][0-9]|3[01]))(?![0-9])"
)
FEATURES = (
    "strict", "plus", "digits_10_15", "digits_14_19", "checksum", "at", "grouped", "form",
    "cue", "left_free", "right_free", "letters", "ends_in_name", "trunk", "date", "pieces", "digits_7",
)
CONTEXT = 32
#: Characters before and after a loose candidate in which a cue word counts for its label.
NEAR = 64


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the checksum over a text of 12 to 19 digits, the lengths of cards, holds."""
    n = F.length(number)

    def value(i: Column) -> Column:
        d = F.substring(number, n - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    total = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda a, i: a + value(i))
    return F.when(n.between(12, 19), total % 10 == 0).otherwise(F.lit(False))


def valid(kind: str, match: Column) -> Column:
    """The check of a strict match."""
    if kind == "ip":
        parts = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        small = F.transform(parts, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255))
        return F.forall(small, lambda x: x)
    if kind == "card":
        number = digits(match)
        return F.when(F.length(number).between(14, 19), luhn(number)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits(match)).between(10, 15)
    return F.lit(True)


def ipv6(match: Column) -> Column:
    """Whether a text of hex groups and colons is an IPv6 address, written out or compressed."""
    tail = match.contains(".")
    groups = F.size(F.array_remove(F.split(match, ":"), "")) + F.when(tail, 1).otherwise(0)
    gaps = F.size(F.split(match, "::")) - 1
    loose_end = match.rlike("^:[^:]|[^:]:$") | match.contains(":::")
    octets = F.when(tail, valid("ip", F.regexp_extract(match, "[0-9.]+$", 0))).otherwise(F.lit(True))
    sized = F.when(gaps == 0, groups == 8).otherwise((gaps == 1) & groups.between(1, 7))
    return sized & ~loose_end & octets


def form(kind: str, match: Column) -> Column:
    """Whether a loose match has the form of its kind: IPv6 groups, card groups, no date."""
    if kind == "ip":
        return F.when(match.contains(":"), ipv6(match)).otherwise(valid("ip", match))
    if kind == "card":
        return match.rlike(f"^{CARD_GROUPS}$")
    if kind == "phone":
        return ~match.rlike(DATE)
    return F.lit(True)


BLOCK = 256
SPAN = "array<struct<start:int,end:int,match:string>>"


def bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def spans_of(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches with offsets: lengths of the pieces between them add up.

    A fold copies its array with every element, so pieces are folded in blocks of ``BLOCK`` and the
    blocks then joined: a text with very many matches takes time in proportion to them.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    pairs = F.arrays_zip(pieces.alias("p"), matches.alias("m"))  # the last piece has no match

    def step(state: Column, pair: Column) -> Column:
        begin = state["at"] + F.length(pair["p"])
        end = begin + F.length(pair["m"])
        span = F.struct(begin.alias("start"), end.alias("end"), pair["m"].alias("match"))
        more = F.struct(end.alias("at"), F.concat(state["out"], F.array(span)).alias("out"))
        return F.when(pair["m"].isNull(), state).otherwise(more)

    def block(state: Column, part: Column) -> Column:
        empty = F.struct(state["at"].alias("at"), F.array().cast(SPAN).alias("out"))
        return bound(
            F.aggregate(part, empty, step),
            lambda x: F.struct(x["at"].alias("at"), F.concat(state["out"], F.array(x["out"])).alias("out")),
        )

    def whole(all_: Column) -> Column:
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / BLOCK).cast("int")),
            lambda k: F.slice(all_, k * BLOCK + 1, F.lit(BLOCK)),
        )
        start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))
        return F.flatten(F.aggregate(blocks, start, block, lambda state: state["out"]))

    return bound(pairs, whole)


def guarded(text: Column, pattern: str, guard: str) -> Column:
    test = F.instr(text, guard) > 0 if guard == "@" else text.rlike(guard)
    return F.when(test, spans_of(text, pattern)).otherwise(F.array().cast(SPAN))


def cue_near(text: Column, span: Column, kind: str) -> Column:
    """Whether a cue word stands within ``NEAR`` characters before or after the span."""
    low = F.greatest(span["start"] - NEAR, F.lit(0))
    before = F.lower(F.substring(text, low + 1, span["start"] - low))
    after = F.lower(F.substring(text, span["end"] + 1, F.lit(NEAR)))
    return before.rlike(CUES[kind]) | after.rlike(CUES[kind])


def feature_bits(text: Column, span: Column, kind: str, strict: bool) -> Column:
    """Features of one candidate as the bits of an int, in the order of ``FEATURES``."""
    match, n = span["match"], F.length(digits(span["match"]))
    low = F.greatest(span["start"] - CONTEXT, F.lit(0))
    before = F.lower(F.substring(text, low + 1, span["start"] - low))
    after = F.substring(text, span["end"] + 1, F.lit(1))
    found = (
        F.lit(strict), match.startswith("+"), n.between(10, 15), n.between(14, 19),
        luhn(digits(match)), match.contains("@"), match.rlike(r"[0-9][\x20./_-]+[0-9]"),
        form(kind, match) if kind in ("ip", "card") else F.lit(False),
        before.rlike(rf"(?:{CUES[kind]})[^a-z]*(?:{FILLERS[kind]})?[^a-z]*$"),
        ~before.rlike(r"[\p{L}\p{N}_]$"), ~after.rlike(r"^[\p{L}\p{N}_]"),
        match.rlike("[A-Za-z]"), match.rlike(r"\.[A-Za-z]{2,}$"),
        match.rlike(r"^\+?\(?0|^\("), match.rlike(DATE), match.rlike(r"[0-9A-Fa-f]+[^0-9A-Fa-f]+[0-9A-Fa-f]+[^0-9A-Fa-f]+[0-9A-Fa-f]"),
        n == 7,
    )
    return sum((F.when(x, 1 << i).otherwise(0) for i, x in enumerate(found)), F.lit(0))


def candidates(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", whole: bool = False
) -> DataFrame:
    """``doc_id`` and ``spans``: every candidate with kind, strictness, label and feature bits.

    With ``whole``, also all columns of ``df`` as the struct ``row``.
    """
    if whole:
        kept = F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row")
        rows = df.select(kept, F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    else:
        rows = texts(df, doc_id, text)
    rows = rows.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    parts = [
        F.transform(guarded(F.col("text"), pattern, guard), described(F.col("text"), kind, strict))
        for kind in KINDS
        for strict, pattern, guard in (
            (True, STRICT[kind], GUARDS[kind]),
            *((False, loose, LOOSE_GUARDS[kind]) for loose in LOOSE[kind]),
        )
    ]
    more = ["row"] if whole else []
    rows = rows.select("doc_id", F.array_sort(F.array_distinct(F.concat(*parts))).alias("spans"), *more)
    base = F.filter("spans", lambda s: s["strict"] & s["label"])
    rows = rows.select("doc_id", "spans", base.alias("base"), *more)
    free = F.filter(
        "spans",
        lambda s: (s["strict"] & s["label"])
        | ~F.exists("base", lambda b: overlaps(s, b) & ~holds_more(s, b)),
    )
    return rows.select("doc_id", free.alias("spans"), *more)


def overlaps(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def holds_more(a: Column, b: Column) -> Column:
    """Whether a holds b and is longer."""
    inside = (a["start"] <= b["start"]) & (b["end"] <= a["end"])
    return inside & (a["end"] - a["start"] > b["end"] - b["start"])


def described(text: Column, kind: str, strict: bool):
    """A function from a span to its candidate: kind, strictness, label and feature bits."""

    def of(span: Column) -> Column:
        bits = feature_bits(text, span, kind, strict)
        if strict:
            label = valid(kind, span["match"])
        else:
            match = span["match"]
            label = form(kind, match) & cue_near(text, span, kind)
            if kind == "card":
                alone = form(kind, match) & F.length(digits(match)).between(14, 19)
                label = luhn(digits(match)) & (alone | cue_near(text, span, kind))
            if kind == "ip":
                groups = F.size(F.array_remove(F.split(match, ":"), ""))
                alone = (groups >= 3) | match.contains(".")
                label = form(kind, match) & (alone | cue_near(text, span, kind))
        return F.struct(
            span["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"),
            span["end"].alias("end"), F.lit(strict).alias("strict"),
            label.alias("label"), bits.alias("bits"),
        )

    return of


@dataclass
class Boosted:
    """Trees of one kind: (bit a, bit b, values by the two bits), calibration and threshold."""

    bias: float = 0.0
    trees: list[tuple[int, int, list[float]]] = field(default_factory=list)
    slope: float = 1.0
    shift: float = 0.0
    threshold: float = 2.0

    def margin(self, bits: int) -> float:
        return self.bias + sum(v[2 * (bits >> a & 1) + (bits >> b & 1)] for a, b, v in self.trees)

    def probability(self, bits: int) -> float:
        return sigmoid(self.slope * self.margin(bits) + self.shift)

    def column(self, bits: Column) -> Column:
        """The probability as a column of the feature bits."""

        def on(bit: int) -> Column:
            return bits.bitwiseAND(F.lit(1 << bit)) > 0

        total = F.lit(self.bias)
        for a, b, v in self.trees:
            low = F.when(on(b), v[1]).otherwise(v[0])
            total = total + F.when(on(a), F.when(on(b), v[3]).otherwise(v[2])).otherwise(low)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-(total * self.slope + self.shift)))


def sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(min(x, 30.0), -30.0)))


def fit(counts: list[tuple[int, bool, int]], rounds: int = 24, rate: float = 0.4) -> Boosted:
    """Newton boosting of depth-two trees on (bits, label, number) counts."""
    model = Boosted()
    total, right = sum(n for *_, n in counts), sum(n for _, y, n in counts if y)
    if not right or right == total:
        model.bias = 4.0 if total and right == total else -4.0
        return model
    model.bias = math.log(right / (total - right))
    margins = [model.bias] * len(counts)
    pairs = [(a, b) for a in range(len(FEATURES)) for b in range(a + 1, len(FEATURES))]
    for _ in range(rounds):
        slopes = []
        for (bits, y, n), m in zip(counts, margins, strict=True):
            p = sigmoid(m)
            slopes.append((bits, n * (y - p), n * p * (1 - p)))
        best, tree = 1e-9, None
        for a, b in pairs:
            g, h = [0.0] * 4, [1.0] * 4
            for bits, gradient, curve in slopes:
                leaf = 2 * (bits >> a & 1) + (bits >> b & 1)
                g[leaf] += gradient
                h[leaf] += curve
            gain = sum(x * x / y for x, y in zip(g, h, strict=True))
            if gain > best:
                best, tree = gain, (a, b, [rate * x / y for x, y in zip(g, h, strict=True)])
        if tree is None:
            break
        model.trees.append(tree)
        a, b, v = tree
        margins = [
            m + v[2 * (bits >> a & 1) + (bits >> b & 1)]
            for (bits, *_), m in zip(counts, margins, strict=True)
        ]
    return model


def calibrate(model: Boosted, counts: list[tuple[int, bool, int]], precision: float) -> None:
    """Platt scaling by Newton steps, then the lowest threshold that reaches the precision."""
    points = [(model.margin(bits), y, n) for bits, y, n in counts]
    for _ in range(20):
        g0 = g1 = 0.0
        h00, h01, h11 = 1.0, 0.0, 1.0
        for m, y, n in points:
            p = sigmoid(model.slope * m + model.shift)
            w = n * p * (1 - p)
            g0, g1 = g0 + n * (p - y), g1 + n * (p - y) * m
            h00, h01, h11 = h00 + w, h01 + w * m, h11 + w * m * m
        det = h00 * h11 - h01 * h01
        model.shift -= (h11 * g0 - h01 * g1) / det
        model.slope = max(model.slope - (h00 * g1 - h01 * g0) / det, 0.05)
    right = wrong = 0
    by_score: dict[float, list[int]] = {}
    for bits, y, n in counts:
        by_score.setdefault(model.probability(bits), [0, 0])[bool(y)] += n
    for p in sorted(by_score, reverse=True):
        wrong, right = wrong + by_score[p][0], right + by_score[p][1]
        if right >= precision * (right + wrong):
            model.threshold = max(p - 1e-9, 0.5)


def trained(found: DataFrame, precision: float = 0.98) -> list[Boosted]:
    """One calibrated model per kind from the candidates of all documents."""
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(2)).alias("fold")
    counts = (
        found.select(fold, F.explode("spans").alias("s"))
        .groupBy("fold", "s.kind", "s.bits", "s.label")
        .agg(F.count("*").alias("n"))
        .orderBy("fold", "kind", "bits", "label")
        .collect()
    )
    models = []
    for number in range(len(KINDS)):
        halves = [
            [(r["bits"], bool(r["label"]), r["n"]) for r in counts if (r["kind"], r["fold"]) == (number, f)]
            for f in (0, 1)
        ]
        model = fit(halves[0])
        calibrate(model, halves[1], precision)
        models.append(model)
    return models


def select(found: DataFrame, models: list[Boosted]) -> DataFrame:
    """``base`` (validated strict spans) and ``spans`` (with the selected others) per row.

    Selected candidates are taken from the likeliest down, the longer first among equals; one that
    overlaps a taken one is left out.
    """

    def scored(s: Column) -> Column:
        p = F.lit(0.0)
        for number, model in enumerate(models):
            p = F.when(s["kind"] == number, model.column(s["bits"]) - model.threshold).otherwise(p)
        return F.struct(
            (-p).alias("under"), (s["start"] - s["end"]).alias("longest"), s["start"], s["kind"], s["end"]
        )

    base = F.filter("spans", lambda s: s["strict"] & s["label"])
    extra = F.filter(
        F.transform(F.filter("spans", lambda s: ~(s["strict"] & s["label"])), scored),
        lambda s: s["under"] <= 0,
    )
    more = [c for c in found.columns if c == "row"]
    rows = found.select("doc_id", *more, base.alias("base"), F.array_sort(extra).alias("extra"))
    none = F.filter("extra", lambda s: F.lit(False))
    best = F.aggregate(
        "extra", none,
        lambda taken, s: F.when(F.exists(taken, lambda o: overlaps(s, o)), taken).otherwise(
            F.concat(taken, F.array(s))
        ),
    )
    plain = lambda s: F.struct(s["start"], s["kind"], s["end"])
    merged = F.array_sort(F.concat(F.transform("base", plain), F.transform(best, plain)))
    bare = F.transform("base", plain).alias("base")
    return rows.select("doc_id", *more, bare, merged.alias("spans"))


def personal_data(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``base`` and ``spans`` (arrays of start, kind number, end) per row of ``df``."""
    found = pin(candidates(df, doc_id, text))
    return select(found, trained(found))


def listed(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined in their order."""
    names = F.array(*map(F.lit, KINDS))
    one = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])
    return F.array_join(F.transform(spans, one), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans merge."""
    names = F.array(*(F.lit(f"[{kind.upper()}]") for kind in KINDS))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        gap = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        told = F.concat(state["out"], gap, F.element_at(names, s["kind"] + 1))
        out = F.when(s["start"] >= state["at"], told).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), out.alias("out"))

    tail = lambda state: F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text)))
    return F.aggregate(spans, start, step, tail)


def redacted_documents(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", length: str | None = None
) -> DataFrame:
    """The rows of ``df`` with redacted texts, and their new lengths in the column ``length``.

    The texts are read twice, for the models and for the redaction, and never shuffled.
    """
    models = trained(candidates(df, doc_id, text))
    rows = select(candidates(df, doc_id, text, whole=True), models)
    clean = rows.select("row", redacted(F.col("row")[text], F.col("spans")).alias("clean"))
    new = {text: F.col("clean")}
    if length is not None:
        new[length] = F.length("clean").cast(df.schema[length].dataType)
    return clean.select(*(new.get(c, F.col("row")[c]).alias(c) for c in df.columns))
