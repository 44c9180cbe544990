"""Host-level quality rules.

Every document is measured once. Its rule failures are counted by host; a host's failure rate is
shrunk towards the rate of all hosts by a beta prior fitted to the hosts (method of moments), and
the host's verdict is joined back to its documents.

* A document that fails a base rule is rejected.
* A document that fails a strong rule (symbols, capitals, repeated lines) is rejected.
* Weak rules (odd word length, few letters) only count together with the host: on
  a host whose shrunk failure rate exceeds ``strict_rate`` one weak failure rejects, elsewhere two.
* A document without any failure is kept, whatever its host.

Nulls: a null text has no words and fails; documents without a host share the host null. Repeated
rows count as often as they stand. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outledger.llm.common import BLANKS, byte_words, filtered, map_rows, text_key, texts
from outledger.session import pin

# Fixed value: the characters that count as symbols.
SYMBOLS = "#*$%&|<>"

MEASURES = (
    "doc_id long, text_key long, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, n_lines long, n_letters long, n_capitals long"
)


@dataclass(frozen=True)
class Limits:
    """Limits of the rules; shares are of word characters unless said otherwise."""

    min_words: int = 50
    max_repeat_percent: int = 50
    max_symbols: float = 0.05
    max_capitals: float = 0.5
    max_dup_lines: float = 0.5
    min_word_length: float = 2.0
    max_word_length: float = 16.0
    min_letters: float = 0.6
    strict_rate: float = 0.5


def measure(text: str | None) -> tuple[int, ...]:
    """The measures of one text, in the order of ``MEASURES`` without keys."""
    text = text or ""
    words = byte_words(text)
    found = Counter(zip(words, words[1:], words[2:], strict=False))
    repeated = 0
    if len(found) < len(words) - 2:
        end = 0  # words before it are counted
        for i, window in enumerate(zip(words, words[1:], words[2:], strict=False)):
            if found[window] > 1:
                repeated += i + 3 - max(end, i)
                end = i + 3
    blanks = BLANKS.decode()
    lines = [line for line in text.split("\n") if line.strip(blanks)]
    return (
        len(words),
        len(text) - sum(text.count(c) for c in blanks),
        sum(text.count(c) for c in SYMBOLS),
        len(lines) - len(set(lines)),
        repeated,
        len(lines),
        sum(map(str.isalpha, text)),
        sum(map(str.isupper, text)),
    )


def measured(df: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source"):
    """One row of ``MEASURES`` per row of ``df``."""
    names = [part.split()[0] for part in MEASURES.split(", ")]

    def run(rows):
        columns = zip(*map(measure, rows["text"]), strict=True)
        known = [rows["doc_id"], rows["text_key"], rows["host"]]
        return dict(zip(names, [*known, *columns], strict=True))

    chosen = texts(df, doc_id, text, host=host).withColumn("host", F.col("host").cast("string"))
    chosen = chosen.withColumn("text_key", text_key())
    return map_rows(chosen, run, MEASURES)


def judged(measures: DataFrame, limits: Limits) -> DataFrame:
    """``base_failed``, ``strong`` and ``weak`` (number of failed rules) beside the measures."""
    c = F.col
    chars, lines = F.greatest(c("word_chars"), F.lit(1)), F.greatest(c("n_lines"), F.lit(1))
    length = c("word_chars") / F.greatest(c("n_words"), F.lit(1))
    base = (c("n_words") < limits.min_words) | (
        100 * c("n_repeat_words") > limits.max_repeat_percent * c("n_words")
    )
    strong = [
        c("n_symbols") > limits.max_symbols * chars,
        c("n_capitals") > limits.max_capitals * F.greatest(c("n_letters"), F.lit(1)),
        c("n_dup_lines") > limits.max_dup_lines * lines,
    ]
    weak = [
        (length < limits.min_word_length) | (length > limits.max_word_length),
        c("n_letters") < limits.min_letters * chars,
    ]
    return (
        measures.withColumn("base_failed", base)
        .withColumn("strong", sum((x.cast("int") for x in strong), F.lit(0)))
        .withColumn("weak", sum((x.cast("int") for x in weak), F.lit(0)))
    )


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """Method-of-moments beta prior of the hosts' failure rates: one row of sums reaches the driver.

    Mean m and spread v are weighted by documents; a + b = m (1 - m) / v - 1, held between 1 and
    1000 so that few hosts, or hosts that all agree, still give a proper prior.
    """
    rate = F.col("failed") / F.col("n")
    row = hosts.agg(
        F.sum("failed").alias("failed"),
        F.sum("n").alias("n"),
        F.sum(F.col("n") * rate * rate).alias("squares"),
    ).first()
    if not row["n"]:
        return 0.5, 0.5
    mean = row["failed"] / row["n"]
    spread = max(row["squares"] / row["n"] - mean * mean, 0.0)
    weight = min(max(mean * (1 - mean) / spread - 1, 1.0), 1000.0) if spread > 0 else 1000.0
    return max(mean * weight, 1e-3), max((1 - mean) * weight, 1e-3)


def host_verdicts(rows: DataFrame, limits: Limits) -> DataFrame:
    """``host``, ``n``, ``failed``, ``rate`` (shrunk) and ``strict`` of each host."""
    failed = F.col("base_failed") | (F.col("strong") > 0) | (F.col("weak") > 0)
    hosts = rows.groupBy("host").agg(
        F.count("*").alias("n"), F.sum(failed.cast("long")).alias("failed")
    )
    a, b = beta_prior(hosts)
    rate = (F.col("failed") + F.lit(a)) / (F.col("n") + F.lit(a + b))
    return hosts.withColumn("rate", rate).withColumn("strict", F.col("rate") > limits.strict_rate)


def quality(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    limits: Limits = Limits(),
) -> DataFrame:
    """Measures, rule failures, the host's shrunk rate and ``kept`` per row of ``df``.

    The measures are written once; host counts are pre-aggregated before their shuffle, and hosts
    are joined back without a hint, so that Spark splits a hot host or broadcasts few hosts.
    """
    rows = judged(pin(measured(df, doc_id, text, host)), limits)
    hosts = host_verdicts(rows, limits).select(F.col("host").alias("of_host"), "rate", "strict")
    joined = rows.join(hosts, F.col("host").eqNullSafe(F.col("of_host")), "left")
    allowed = F.when(F.col("strict"), 0).otherwise(1)
    kept = ~F.col("base_failed") & (F.col("strong") == 0) & (F.col("weak") <= allowed)
    return joined.drop("of_host").withColumn("kept", kept)


def kept_documents(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    limits: Limits = Limits(),
) -> DataFrame:
    """The rows of ``df`` that the rules keep, with all columns."""
    rows = quality(df, doc_id, text, host, limits)
    hosted = rows.where("kept").select("doc_id", F.xxhash64("text_key", "host").alias("text_key"))
    found = filtered(df, hosted, "left_semi", doc_id, text, host)
    return found.select("row.*")
