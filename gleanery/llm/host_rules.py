"""Host-level quality rules: rule failures per document, pooled over hosts.

A document fails by itself when it is too short or repeats itself. The failures are
counted per host; each host's failure rate is shrunk towards the mean of all hosts
by a beta prior whose strength is fitted to the spread of the rates beyond that of samples. Documents of
a host whose shrunk rate is too high go as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import bind, let, words
from gleanery.session import materialise

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 0.30

# A prior fitted to hosts that all fail alike would be infinitely strong.
STRONGEST = 1e6


def _repeated_words(grams: Column) -> Column:
    """Words covered by windows that occur more than once.

    Only a text with a repeated window is sorted, by (window, position); equal
    windows are then neighbours. The covered words are the union of the
    intervals at their positions.
    """

    def covered(pairs: Column) -> Column:
        last = F.size(pairs) - 1
        same = F.filter(
            pairs,
            lambda p, i: ((i > 0) & (pairs[F.greatest(i - 1, F.lit(0))]["g"] == p["g"]))
            | ((i < last) & (pairs[F.least(i + 1, last)]["g"] == p["g"])),
        )
        return F.aggregate(
            F.array_sort(F.transform(same, lambda p: p["i"])),
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
            lambda acc, p: F.struct(
                (acc["n"] + p + WINDOW - F.greatest(acc["end"], p)).alias("n"), (p + WINDOW).alias("end")
            ),
            lambda acc: acc["n"],
        )

    pairs = F.array_sort(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    repeats = F.size(F.array_distinct(grams)) < F.size(grams)
    return F.when(repeats, let(pairs, covered)).otherwise(F.lit(0).cast("long"))


def base_rules(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, source, text): the counts and the verdict of the base rules.

    Null and empty texts have no words and fail. Windows are compared by a 64-bit
    hash of their words. Repeated rows are judged each; other columns are ignored.
    """
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(" \t\n\x0b\f\r")) != "")
    split = bind(docs.select("doc_id", "source", text.alias("text")), words=words(F.col("text")), lines=lines)
    n = F.size("words")
    windows = F.sequence(F.lit(1), F.greatest(n - (WINDOW - 1), F.lit(1)))
    hashed = F.transform(windows, lambda i: F.xxhash64(F.slice("words", i, WINDOW)))
    counted = bind(split, grams=hashed).select(
        "doc_id",
        "source",
        n.cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeated_words(F.col("grams")).alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * int(100 * MOST_REPEATED))
    return counted.withColumn("base_failed", failed)


def host_rates(judged: DataFrame) -> DataFrame:
    """Documents and failures of each host (``source``); null is a host."""
    failures = F.sum(F.col("base_failed").cast("long"))
    return judged.groupBy("source").agg(F.count("*").alias("n"), failures.alias("failures"))


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """Mean and strength of the beta prior, by moments weighted with the hosts' documents.

    The rates of hosts that do not differ still vary, as samples do. Only what their variance has beyond that speaks
    of the hosts: as a share of the variance of single documents it is 1 / (strength + 1).
    """
    n, f = F.col("n").cast("double"), F.col("failures").cast("double")
    sums = hosts.agg(F.count("*").alias("hosts"), F.sum(n).alias("n"), F.sum(f).alias("f"), F.sum(f * f / n).alias("ff"), F.sum(n * n).alias("nn")).first()
    if not sums.n or not sums.f:
        return 0.0, STRONGEST
    mean = sums.f / sums.n
    single = mean * (1 - mean)
    spread, sampling = sums.ff / sums.n - mean * mean, (sums.hosts - 1) / sums.n
    weight = 1 - sums.nn / (sums.n * sums.n) - sampling
    share = (spread - single * sampling) / (single * weight) if single > 0 and weight > 0 else 0.0
    return mean, min(max(1 / share - 1, 1.0), STRONGEST) if share > 0 else STRONGEST


def judge(docs: DataFrame, most_failures: float = 0.5) -> DataFrame:
    """``base_rules`` and ``kept``: false if the document fails or its host does.

    A host fails when (failures + strength * mean) / (documents + strength) exceeds
    ``most_failures``. The counts are written once as a scratch table without texts
    when this is called; the driver receives the two numbers of the prior. Counts of
    a host are combined in each task before they are shuffled. The join back to
    the documents carries no texts; Spark splits a host that is too large for one
    task. An empty table gives an empty result.
    """
    judged = materialise(base_rules(docs))
    hosts = host_rates(judged)
    mean, strength = beta_prior(hosts)
    rate = (F.col("failures") + mean * strength) / (F.col("n") + strength)
    verdicts = hosts.select(F.col("source").alias("host"), (rate > most_failures).alias("host_failed"))
    return judged.join(verdicts, F.col("source").eqNullSafe(F.col("host")), "left").select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & ~F.coalesce("host_failed", F.lit(False))).alias("kept"),
    )
