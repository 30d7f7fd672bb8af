"""Labels of words by a hidden Markov model: proper-noun labels, parts of speech, or any others.

Nothing but counts is learned, from sentences whose words are labelled or from texts marked by a
gazetteer. Costs are whole numbers, so that a sentence has the same labels on every engine. Sentences are decoded
by a fold over their words, each with its costs looked up once per distinct word of a sentence.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.spans import spans
from gleanery.functions.text import let
from gleanery.operators.entities import LABELS
from gleanery.operators.skew import hot_keys, salted_join
from gleanery.schema import ID
from gleanery.session import materialise

OUTSIDE = "O"

# A word with marks inside it, or any other sign by itself; line breaks end sentences.
TOKEN = r"[\p{L}\p{M}\p{N}_]+(?:['’.-][\p{L}\p{M}\p{N}_]+)*+|\n|[^\p{L}\p{M}\p{N}_\s]"
_ENDS = [".", "!", "?", "\n"]
# A longer sentence is labelled in pieces of so many words.
PIECE = 200

# Words seen less often are counted by their shape, as unknown words will be.
LEAST_SEEN = 2
# What is added to each count of a word with a label, and to each count of two labels that follow each other.
WORD_SMOOTHING, LABEL_SMOOTHING = 0.1, 1.0
# Costs are negative logarithms in thousandths, rounded down.
SCALE = 1000


def tokens(c: Column) -> Column:
    """All words and signs of a text with their offsets."""
    return spans(c, TOKEN)


def sentences(df: DataFrame, text: str = "text") -> DataFrame:
    """(record_id, sentence, words): the words of each sentence with offsets; one longer than ``PIECE`` is several."""

    def cut(found: Column) -> Column:
        last = F.size(found)
        marks = F.transform(found, lambda t, i: F.when(t["text"].isin(_ENDS) | (i == last - 1), i + 1))
        ends = F.array_compact(marks)
        starts = F.concat(F.array(F.lit(0)), F.slice(ends, 1, F.greatest(F.size(ends) - 1, F.lit(0))))
        pieces = F.flatten(
            F.zip_with(starts, ends, lambda a, b: F.transform(F.sequence(a, b - 1, F.lit(PIECE)), lambda s: F.struct(s.alias("a"), F.least(s + PIECE, b).alias("b"))))
        )
        return F.when(last > 0, F.transform(pieces, lambda p: F.slice(found, p["a"] + 1, p["b"] - p["a"])))

    return df.select(ID, F.posexplode(let(tokens(F.col(text)), cut)).alias("sentence", "words"))


def shape(word: Column, opens: Column) -> Column:
    """What stands for a word that is not known: a mark that no word is equal to."""
    return (
        F.when(word.rlike(r"^\p{N}"), "<digits>")
        .when(word.rlike(r"^\p{Lu}.*\p{Lu}"), "<capitals>")
        .when(word.rlike(r"^\p{Lu}"), F.when(opens, "<opening>").otherwise("<name>"))
        .when(word.rlike(r"^\p{L}"), "<word>")
        .otherwise("<sign>")
    )


@dataclass
class Tagger:
    """Labels in order, what it costs to begin with and to go on to each, and (word, costs) of known words and shapes."""

    labels: list[str]
    first: list[int]
    following: list[list[int]]  # by label, then by the label before it
    words: DataFrame
    unseen: list[int]  # costs of a shape that was never seen

    def letter(self, i: int) -> str:
        return chr(ord("a") + i)


def _cost(n: Column, of: Column) -> Column:
    return F.floor(-SCALE * F.ln(n / of)).cast("int")


def _counted(labelled: DataFrame) -> DataFrame:
    """(word, shape, label, before): one row per labelled word."""
    rows = labelled.select(F.posexplode("sentence").alias("i", "w"), "sentence")
    before = F.when(F.col("i") > 0, F.try_element_at(F.transform("sentence", lambda w: w["label"]), F.col("i")))
    return rows.select(F.col("w.word").alias("word"), shape(F.col("w.word"), F.col("i") == 0).alias("shape"), F.col("w.label").alias("label"), before.alias("before"))


def fit(labelled: DataFrame) -> Tagger:
    """A tagger from ``labelled`` (sentence: array of (word, label)), by counts only.

    Labels, their frequencies and their successions come to the driver, at most 26 labels; words stay a table.
    """
    rows = _counted(labelled)
    pairs = rows.groupBy("before", "label").agg(F.count("*").alias("n")).collect()
    labels = sorted({r.label for r in pairs})
    if not 0 < len(labels) <= 26:
        raise ValueError(f"{len(labels)} labels")
    seen = {(r.before, r.label): r.n for r in pairs}
    total = {t: sum(n for (_, label), n in seen.items() if label == t) for t in labels}

    def costs(before: str | None) -> list[int]:
        of = sum(seen.get((before, t), 0) for t in labels)
        spark = labelled.sparkSession
        row = [F.lit(seen.get((before, t), 0) + LABEL_SMOOTHING) / F.lit(of + LABEL_SMOOTHING * len(labels)) for t in labels]
        return list(spark.range(1).select(*[_cost(c, F.lit(1.0)).alias(f"c{i}") for i, c in enumerate(row)]).first())

    counted = rows.groupBy("word", "shape", "label").agg(F.count("*").alias("n"))
    often = counted.groupBy("word").agg((F.sum("n") >= LEAST_SEEN).alias("often"))
    named = counted.join(often, "word").select(F.when(F.col("often"), F.col("word")).otherwise(F.col("shape")).alias("word"), "label", "n")
    by_word = materialise(named.groupBy("word").pivot("label", labels).agg(F.sum("n")))
    size = by_word.count() + 1

    def emitted(n: Column, label: str) -> Column:
        return _cost(n + WORD_SMOOTHING, F.lit(total[label] + WORD_SMOOTHING * size))

    words = by_word.select("word", F.array(*[emitted(F.coalesce(F.col(f"`{t}`"), F.lit(0)), t) for t in labels]).alias("costs"))
    spark = labelled.sparkSession
    unseen = list(spark.range(1).select(*[emitted(F.lit(0), t).alias(f"c{i}") for i, t in enumerate(labels)]).first())
    by_before = [costs(t) for t in labels]
    following = [[by_before[i][j] for i in range(len(labels))] for j in range(len(labels))]
    return Tagger(labels, costs(None), following, materialise(words), unseen)


def _looked_up(found: DataFrame, tagger: Tagger) -> DataFrame:
    """(record_id, sentence, found): the words of each sentence in order, each with its costs.

    The rows of a record are in one partition already, so that its words come together again without a shuffle
    if Spark broadcasts the known words, which are a written table of known size.
    """
    each = found.select(ID, "sentence", F.posexplode("words").alias("i", "w"))
    word = F.col("w.text")
    # a word is looked up as it is, and by its shape if it is not known
    known = tagger.words.select(F.col("word").alias("known"), "costs")
    shapes = {r["known"]: r["costs"] for r in known.filter(F.col("known").rlike("^<[a-z]+>$")).collect()}  # at most six rows
    of_shape = shape(word, F.col("i") == 0)
    fallback = F.lit(tagger.unseen)
    for name, row in shapes.items():
        fallback = F.when(of_shape == name, F.lit(row)).otherwise(fallback)
    counts = materialise(each.groupBy(word.alias("known")).agg(F.count("*").alias("n")))
    hot = hot_keys(counts, "known")
    joined = salted_join(each.withColumn("known", word), known, "known", hot, "left")
    costs = F.coalesce("costs", fallback)
    return joined.groupBy(ID, "sentence").agg(F.array_sort(F.collect_list(F.struct("i", "w", costs.alias("costs")))).alias("found"))


def decode(costs: Column, tagger: Tagger) -> Column:
    """The cheapest labels of a sentence as letters, from the costs of its words; of equally cheap ones the first.

    A fold that keeps, for every label, the cheapest labels that end with it.
    """
    n = len(tagger.labels)
    following = F.lit(tagger.following)
    letters = F.lit([tagger.letter(i) for i in range(n)])

    def path(cost: Column, labels: Column) -> Column:
        return F.struct(cost.cast("long").alias("cost"), labels.alias("labels"))

    def step(ends: Column, word: Column) -> Column:
        def best(j: Column) -> Column:
            before = F.transform(ends, lambda e, i: path(e["cost"] + following[j][i], e["labels"]))
            return let(F.array_min(before), lambda b: path(b["cost"] + word[j], F.concat(b["labels"], letters[j])))

        return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), best)

    first = F.transform(F.lit(tagger.first), lambda c, j: path(c + costs[0][j], letters[j]))
    ends = F.aggregate(F.slice(costs, 2, F.size(costs)), first, step)
    return F.array_min(ends)["labels"]


def label_words(df: DataFrame, tagger: Tagger, text: str = "text") -> DataFrame:
    """(record_id, sentence, words, labels): the words of each sentence and a letter for the label of each.

    A null or empty text has no sentence. Texts are shuffled once by record, if they are not so already.
    """
    found = sentences(df.select(ID, F.col(text).alias("text")).repartition(ID))
    labels = decode(F.transform("found", lambda w: w["costs"]), tagger)
    return _looked_up(found, tagger).select(ID, "sentence", F.transform("found", lambda w: w["w"]).alias("words"), labels.alias("labels"))


def labelled_spans(found: DataFrame, tagger: Tagger, outside: str | None = OUTSIDE) -> DataFrame:
    """(record_id, label, mention, start, end): neighbouring words of one label, by ``label_words``; ``outside`` is no label."""
    runs = "|".join(f"{tagger.letter(i)}+" for i, t in enumerate(tagger.labels) if t != outside)
    names = F.create_map(*[F.lit(x) for i, t in enumerate(tagger.labels) for x in (tagger.letter(i), t)])
    each = found.select(ID, "words", F.inline(spans(F.col("labels"), runs or "[^a-z]")))
    inside = F.slice("words", F.col("start") + 1, F.col("end") - F.col("start"))
    return each.select(
        ID,
        names[F.left("text", F.lit(1))].alias("label"),
        F.array_join(inside["text"], " ").alias("mention"),
        inside[0]["start"].alias("start"),
        F.element_at(inside, -1)["end"].alias("end"),
    )


def mark(df: DataFrame, gazetteer: DataFrame, text: str = "text") -> DataFrame:
    """Sentences labelled by a ``gazetteer`` (entity, label), to ``fit`` on: (record_id, sentence_number, sentence).

    Entities are runs of words in lower case. Of entities that begin at one word the longest counts, and none begins inside
    another; an entity with several labels has the first by name. The join is by the first word of an entity, so that a
    word is only compared with entities that begin with it.
    """
    name = F.transform(tokens(F.lower("entity")), lambda t: t["text"])
    listed = gazetteer.filter(F.col("label").isin(LABELS)).groupBy("entity").agg(F.min("label").alias("label"))
    entities = materialise(listed.select(name.alias("name"), "label").filter(F.size("name") > 0))
    openers = entities.groupBy(F.col("name")[0].alias("first")).agg(F.array_sort(F.collect_list(F.struct(F.size("name").alias("size"), "name", "label"))).alias("options"))
    found = sentences(df.select(ID, F.col(text).alias("text")).repartition(ID))
    each = found.select(ID, "sentence", F.posexplode("words").alias("i", "w"), "words")
    lowered = F.transform("words", lambda w: F.lower(w["text"]))
    first = each.withColumn("first", F.lower("w.text"))
    fits = F.filter("options", lambda o: F.slice(lowered, F.col("i") + 1, o["size"]) == o["name"])
    hits = (
        first.join(openers, "first")
        .select(ID, "sentence", "i", F.try_element_at(F.array_sort(fits), F.lit(-1)).alias("hit"))
        .filter("hit is not null")
        .groupBy(ID, "sentence")
        .agg(F.array_sort(F.collect_list(F.struct("i", F.col("hit.size").alias("size"), F.col("hit.label").alias("label")))).alias("hits"))
    )

    def taken(hits: Column) -> Column:
        """Hits from left to right that do not begin inside the one before."""
        zero = F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<i:int,size:int,label:string>>").alias("kept"))
        return F.aggregate(
            hits,
            zero,
            lambda acc, h: F.when(h["i"] >= acc["end"], F.struct((h["i"] + h["size"]).alias("end"), F.concat(acc["kept"], F.array(h)).alias("kept"))).otherwise(acc),
            lambda acc: acc["kept"],
        )

    kept = taken(F.coalesce("hits", F.array().cast("array<struct<i:int,size:int,label:string>>")))

    def label(i: Column, hits: Column) -> Column:
        over = F.filter(hits, lambda h: (h["i"] <= i) & (i < h["i"] + h["size"]))
        return F.coalesce(F.try_element_at(over, F.lit(1))["label"], F.lit(OUTSIDE))

    marked = let(kept, lambda hits: F.transform("words", lambda w, i: F.struct(w["text"].alias("word"), label(i, hits).alias("label"))))
    return found.join(hits, [ID, "sentence"], "left").select(ID, F.col("sentence").alias("sentence_number"), marked.alias("sentence"))


def entity_mentions(df: DataFrame, tagger: Tagger, text: str = "text", labels: list[str] = LABELS) -> DataFrame:
    """Mentions with their labels, as a mention table: (record_id, mention, entity, dropped, label, start, end)."""
    found = labelled_spans(label_words(df, tagger, text), tagger).filter(F.col("label").isin(labels))
    return found.select(ID, "mention", F.lower("mention").alias("entity"), F.lit(False).alias("dropped"), "label", "start", "end")
