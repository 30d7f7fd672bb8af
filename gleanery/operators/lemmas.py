"""Base forms learned from pairs of form and lemma.

A pair says which ending the form loses and which one it gets instead. Every suffix of the form that holds the ending
votes for this rewrite; the most frequent rewrite of each suffix is kept. A new word is rewritten by its
longest suffix that has enough votes: one lemma for each word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.session import materialise

# Letters of a suffix beyond the ending that changes.
CONTEXT = 4
# Different forms that a suffix must have been seen with; a form that was seen itself needs no others.
LEAST_FORMS = 2

# Stands before a word, so that a suffix that begins with it is a whole word.
_EDGE = "^"


def _shared(a: Column, b: Column) -> Column:
    """Length of the longest common prefix."""
    same = F.transform(F.sequence(F.lit(1), F.greatest(F.least(F.length(a), F.length(b)), F.lit(1))), lambda i: F.left(a, i) == F.left(b, i))
    first_off = F.array_position(same, False)
    return F.when((a == "") | (b == ""), 0).when(first_off > 0, first_off - 1).otherwise(F.least(F.length(a), F.length(b))).cast("int")


def suffix_rules(pairs: DataFrame) -> DataFrame:
    """(suffix, cut, ending, n): the rewrite of each suffix, from distinct ``pairs`` (form, lemma) in lower case.

    Null and empty forms or lemmas teach nothing. Of equally frequent rewrites the one that cuts least counts, then the first ending by name.
    """
    known = pairs.filter("form != '' and lemma != ''").select("form", "lemma").distinct()
    kept = _shared(F.col("form"), F.col("lemma"))
    cut = known.select("form", (F.length("form") - kept).alias("cut"), F.substr("lemma", kept + 1).alias("ending"))
    edged = F.concat(F.lit(_EDGE), F.col("form"))
    sizes = F.sequence(F.col("cut"), F.least(F.col("cut") + CONTEXT, F.length(edged)))
    suffixes = F.array_distinct(F.concat(F.transform(sizes, lambda n: F.right(edged, n)), F.array(edged)))
    votes = cut.select(F.explode(suffixes).alias("suffix"), "cut", "ending").groupBy("suffix", "cut", "ending").agg(F.count("*").alias("n"))
    best = votes.groupBy("suffix").agg(
        F.min(F.struct((-F.col("n")).alias("n"), "cut", "ending")).alias("best"), F.sum("n").alias("forms")
    )
    enough = (F.col("forms") >= LEAST_FORMS) | F.startswith("suffix", F.lit(_EDGE))
    return best.filter(enough).select("suffix", "best.cut", "best.ending", (-F.col("best.n")).alias("n"))


def lemmas(words: DataFrame, rules: DataFrame) -> DataFrame:
    """(word, lemma) of distinct ``words`` (word): rewritten by the rule of the longest suffix, or as they are.

    Each word meets as many rules as its suffixes are long, by equality. A rewrite that would leave nothing is none.
    """
    longest = rules.agg(F.max(F.length("suffix"))).first()[0] or 0
    edged = F.concat(F.lit(_EDGE), F.col("word"))
    sizes = F.sequence(F.lit(0), F.least(F.length(edged), F.lit(longest)))
    suffixes = words.select("word", F.explode(F.transform(sizes, lambda n: F.right(edged, n))).alias("suffix"))
    rule = F.max_by(F.struct("cut", "ending"), F.length("suffix"))
    chosen = suffixes.join(rules, "suffix").groupBy("word").agg(rule.alias("rule"))
    rewritten = F.concat(F.left("word", F.length("word") - F.col("rule.cut")), F.col("rule.ending"))
    lemma = F.when(F.col("rule.cut") <= F.length("word"), F.nullif(rewritten, F.lit("")))
    return words.join(chosen, "word", "left").select("word", F.coalesce(lemma, F.col("word")).alias("lemma"))


def fit(pairs: DataFrame) -> DataFrame:
    """``suffix_rules`` as a written table, for use on many corpora."""
    return materialise(suffix_rules(pairs))
