"""Quality rules with host verdicts.

Every text is measured and held against rules. The failures are summed by host, and each host's
failure rate is shrunk with a beta prior fitted to the rates of all hosts, so that a few failures
don't condemn a host with few documents. Documents of hosts whose shrunk rate passes a limit must
pass the rules in a stricter form. DataFrame functions only.

Defined cases: a null text holds no word (and fails, as any text with few words); a null host is a
host of its own; rows that repeat a ``doc_id`` are judged like any others; an empty table gives an
empty result; extra columns are not read, or handed on by ``keep_good``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.text import let
from newsloom.lineage import materialize
from newsloom.llm.hosts import host_key
from newsloom.operators.joins import lookup

SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 5

#: Limits of the base rules (fixed by the contract).
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20

#: Own rules, in percent: symbols by words, equal lines by lines, ASCII capitals by characters in words.
MAX_SYMBOLS, MAX_EQUAL_LINES, MAX_CAPITALS = 60, 40, 60

#: On hosts with a bad verdict the limits of the own rules are divided by this.
STRICTER = 2

#: A host's verdict is bad above this shrunk failure rate.
MAX_HOST_RATE = 0.5

#: Weight of the prior, in documents, where the hosts' rates don't spread.
PLAIN_WEIGHT = 20.0

METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(grams: Column) -> Column:
    """How many words stand in windows that occur twice or more, from the hashes of all windows."""

    def starts(by_hash: Column) -> Column:
        """The positions of windows that have an equal one beside them when sorted by hash."""
        again = F.filter(
            by_hash,
            lambda g, i: F.coalesce(g["hash"] == F.get(by_hash, i - 1)["hash"], F.lit(False))
            | F.coalesce(g["hash"] == F.get(by_hash, i + 1)["hash"], F.lit(False)),
        )
        return F.sort_array(F.transform(again, lambda g: g["at"]))

    def covered(at: Column) -> Column:
        """Words that windows beginning at these positions cover together."""
        ends = F.transform(
            at, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW)))
        )
        return F.aggregate(ends, F.lit(0), lambda total, n: total + n)

    by_hash = F.sort_array(
        F.transform(grams, lambda g, i: F.struct(g.alias("hash"), i.alias("at")))
    )
    heavy = let(by_hash, lambda s: let(starts(s), covered))
    return F.when(F.size(F.array_distinct(grams)) == F.size(grams), 0).otherwise(heavy)


def measured(docs: DataFrame, host: str = "source", row: Column | str = "doc_id") -> DataFrame:
    """``row, host``, the metrics, and the numbers of lines with a word and of ASCII capitals."""
    text = F.coalesce(F.col("text"), F.lit(""))
    cut = docs.select(
        row,
        host_key(F.col(f"`{host}`")).alias("host"),
        F.array_remove(F.split(text, SPACE), "").alias("_words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).alias("n_symbols"),
        F.regexp_count(text, F.lit("[A-Z]")).alias("n_capitals"),
    )
    first = F.slice("_words", F.lit(1), F.greatest(F.size("_words") - (WINDOW - 1), F.lit(0)))
    grams = F.transform(
        first, lambda w, i: F.xxhash64(w, *[F.get(F.col("_words"), i + k) for k in range(1, WINDOW)])
    )
    counted = cut.select(
        "*",
        F.size("_words").alias("n_words"),
        F.length(F.array_join("_words", "")).alias("word_chars"),
        F.size("_lines").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
        grams.alias("_grams"),
    )
    result = counted.withColumn("n_repeat_words", repeated_words(F.col("_grams")))
    return result.select(
        cut.columns[0], "host", *[F.col(c).cast("bigint").alias(c) for c in (*METRICS, "n_lines", "n_capitals")]
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )


def own_failed(stricter: int = 1) -> Column:
    def above(part: str, whole: str, percent: int) -> Column:
        return 100 * stricter * F.col(part) > percent * F.col(whole)

    return (
        above("n_symbols", "n_words", MAX_SYMBOLS)
        | above("n_dup_lines", "n_lines", MAX_EQUAL_LINES)
        | above("n_capitals", "word_chars", MAX_CAPITALS)
    )


def host_rates(metrics: DataFrame) -> DataFrame:
    """``host, n_docs, n_failed, rate``: failure rates, shrunk with a beta prior fitted by moments."""
    failed = (base_failed() | own_failed()).cast("bigint")
    hosts = materialize(
        metrics.groupBy("host").agg(F.count(F.lit(1)).alias("n_docs"), F.sum(failed).alias("n_failed")), "hosts"
    )
    rate = F.col("n_failed") / F.col("n_docs")
    moments = hosts.agg(F.avg(rate).alias("mean"), F.var_pop(rate).alias("spread")).first()
    mean, spread = moments["mean"] or 0.0, moments["spread"] or 0.0
    # Of a beta distribution with this mean and variance, a + b; never less than one document.
    weight = max(1.0, mean * (1 - mean) / spread - 1) if spread > 0 else PLAIN_WEIGHT
    shrunk = (F.col("n_failed") + mean * weight) / (F.col("n_docs") + weight)
    return hosts.withColumn("rate", shrunk)


def judge(docs: DataFrame, *, host: str = "source", max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """``doc_id``, the metrics, ``base_failed`` and ``kept`` for every row of ``docs``.

    Texts are measured once; the measures, a few numbers a row, are written and read back for the
    hosts' sums and for the verdicts.
    """
    metrics = materialize(measured(docs, host), "metrics")
    bad = host_rates(metrics).select("host", (F.col("rate") > max_host_rate).alias("_bad"))
    return judged(metrics, bad).select("doc_id", *METRICS, "base_failed", "kept")


def judged(metrics: DataFrame, bad: DataFrame) -> DataFrame:
    """``metrics`` with ``base_failed`` and ``kept``, by the hosts' verdicts ``bad (host, _bad)``.

    The verdicts are broadcast if measured to be small; else large hosts are joined in parts.
    """
    failed = F.when(F.col("_bad"), own_failed(STRICTER)).otherwise(own_failed())
    return (
        lookup(metrics, bad, "host", "left")
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & ~failed)
    )


def keep_good(docs: DataFrame, *, host: str = "source", max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns.

    Every text is measured once: rows are written with their measures, from which only the measures
    are read for the hosts' sums. No text is shuffled unless the hosts are too many to be broadcast.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = materialize(measured(docs, host, row), "measured-rows")
    bad = host_rates(rows).select("host", (F.col("rate") > max_host_rate).alias("_bad"))
    return judged(rows, bad).where(F.col("kept")).select("_row.*")
