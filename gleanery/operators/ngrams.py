"""Which language a word looks like, by its letters.

For each language the texts' distinct words are counted in runs of up to three letters. A letter costs
what its run is worth in a language; a run that was never seen is shortened, at a price. Costs are
whole numbers and are looked up by joins for distinct words only, whatever the number of their uses.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.functions.words import alpha_words
from gleanery.session import materialise

ORDER = 3
# Costs are negative logarithms in thousandths. Price of a shorter run; cost of a letter that a language never uses.
SCALE = 1000
SHORTENED = 1200
NEVER = 9000

# A word looks foreign if another language is cheaper than the own one by so much for each letter ...
MARGIN = 250
# ... and is not too dear itself: names and slips of the pen look like no language.
DEAREST = 3600

_EDGE = "_"


@dataclass
class LetterModel:
    """Languages in order, and (run, costs) with the cost of the run's last letter in each language, null where the run was never seen."""

    languages: list[str]
    runs: DataFrame


def _runs(words: DataFrame) -> DataFrame:
    """``words`` and one row per letter and length: (..., place, run); a letter's runs end with it."""
    edged = F.concat(F.lit(_EDGE), F.col("word"), F.lit(_EDGE))
    # the first sign is the edge, which is only ever a neighbour
    ends = F.sequence(F.lit(2), F.length(edged))
    runs = F.flatten(
        F.transform(ends, lambda e: F.transform(F.sequence(F.lit(1), F.least(e, F.lit(ORDER))), lambda n: F.struct(e.alias("place"), F.substr(edged, e - n + 1, n).alias("run"))))
    )
    return words.select(*words.columns, F.inline(runs))


def run_counts(df: DataFrame, text: str = "text", language: str = "lang") -> DataFrame:
    """(lang, run, n): how many distinct words' letters end each run, by language; words and languages are taken in lower case."""
    words = df.filter(F.col(language).isNotNull()).select(F.lower(F.col(language)).alias("lang"), F.explode(F.array_distinct(F.transform(alpha_words(F.col(text)), F.lower))).alias("word"))
    return _runs(words.distinct()).groupBy("lang", "run").agg(F.count("*").alias("n"))


def fit(df: DataFrame, text: str = "text", language: str = "lang") -> LetterModel:
    """A model of the languages of ``df`` (text, lang), at most 50, whose names come to the driver."""
    counts = materialise(run_counts(df, text, language))
    languages = [r.lang for r in counts.select("lang").distinct().orderBy("lang").limit(51).collect()]
    if not 0 < len(languages) <= 50:
        raise ValueError(f"{len(languages)} languages")
    before = F.left("run", F.length("run") - 1)
    of = counts.groupBy("lang", before.alias("before")).agg(F.sum("n").alias("of"))
    costs = counts.withColumn("before", before).join(of, ["lang", "before"]).withColumn("cost", F.floor(-SCALE * F.ln(F.col("n") / F.col("of"))).cast("int"))
    table = costs.groupBy("run").pivot("lang", languages).agg(F.min("cost"))
    return LetterModel(languages, materialise(table.select("run", F.array(*[F.col(f"`{x}`") for x in languages]).alias("costs"))))


def word_costs(words: DataFrame, model: LetterModel) -> DataFrame:
    """(word, costs): for distinct ``words`` (word, in lower case) the cost of all letters and the end, by language."""
    found = _runs(words.select("word")).join(model.runs, "run", "left")
    sizes = {n: F.max(F.when(F.length("run") == n, F.col("costs"))).alias(f"n{n}") for n in range(1, ORDER + 1)}
    letters = found.groupBy("word", "place").agg(*sizes.values())

    def cost(i: int):
        seen = [F.col(f"n{n}")[i] + (ORDER - n) * SHORTENED for n in range(ORDER, 0, -1)]
        # the second sign of a word has no longer run than two
        short = F.when(F.col("place") == 2, SHORTENED).otherwise(0)
        return F.coalesce(*[s - short for s in seen], F.lit(NEVER))

    each = letters.select("word", *[cost(i).alias(f"c{i}") for i in range(len(model.languages))])
    return each.groupBy("word").agg(F.array(*[F.sum(f"c{i}") for i in range(len(model.languages))]).alias("costs"))


def languages_of(words: DataFrame, model: LetterModel, own: str = "en", margin: int = MARGIN, dearest: int = DEAREST) -> DataFrame:
    """(word, language, foreign): the cheapest language of each word, the first of equally cheap ones, and whether the word looks foreign.

    ``own`` is the language that words are expected to be in. A word in no language (dearer than
    ``dearest`` for each letter) is not foreign.
    """
    own_at = model.languages.index(own)
    costs = word_costs(words, model)
    best = F.array_min("costs")
    language = F.element_at(F.array(*[F.lit(x) for x in model.languages]), F.array_position("costs", best).cast("int"))
    letters = F.length("word") + 1
    foreign = (F.col("costs")[own_at] - best >= margin * letters) & (best <= dearest * letters)
    return costs.select("word", language.alias("language"), foreign.alias("foreign"))
