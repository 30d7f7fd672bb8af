"""Proper nouns by frequency and the records that hold rare ones.

Mentions come from capitalisation (``gleanery.functions.names``) or from any table
(record_id, entity) a user's own model has filled; see ``model_mentions``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.functions.names import lower_words, mentions
from gleanery.functions.text import let
from gleanery.operators.profile import percent
from gleanery.operators.scan import Strings, found_in, listed, packed, read_strings
from gleanery.operators.skew import bounded, hot_keys, merged, salted_join
from gleanery.operators.substring import by_chance, contained_strings
from gleanery.schema import ID
from gleanery.session import materialise

# Labels that count as proper nouns where mentions carry labels.
LABELS = ["PERSON", "ORG", "GPE", "PRODUCT", "WORK_OF_ART", "LOC"]

# Fixed value: an entity seen at most this often is rare.
THRESHOLD = 3

# A word that opens a sentence is an ordinary word when at least this share of its uses, counted
# once per record in lower case, is in lower case. One odd spelling in a large corpus changes nothing.
LOWER_SHARE = 0.1


def _ordinary(capitalised: DataFrame, df: DataFrame, text: str) -> DataFrame:
    """(entity) of the words that are mostly not names; ``capitalised``: (entity, n), mentions of single words."""
    lower = df.select(F.explode(lower_words(F.col(text))).alias("entity")).groupBy("entity").agg(F.count("*").alias("lower"))
    both = capitalised.join(merged(lower), "entity")
    return both.filter(F.col("lower") >= LOWER_SHARE * (F.col("lower") + F.col("n"))).select("entity")


def entity_mentions(df: DataFrame, text: str = "text", gazetteer: DataFrame | None = None) -> DataFrame:
    """One row per mention: record_id, mention, entity (lower-cased), dropped.

    A single capitalised word that opens a sentence is ``dropped`` when the corpus
    writes it in lower case often enough (``LOWER_SHARE``). With a ``gazetteer`` (entity, label) only listed
    entities with a proper-noun label are kept. The entities are counted when this is called.
    """
    found = df.select(ID, F.inline(mentions(F.col(text)))).withColumn("entity", F.lower("mention"))
    counts = materialise(found.groupBy("entity").agg(F.count("*").alias("n"), F.bool_or("initial").alias("opens")))
    hot = hot_keys(counts, "entity")
    doubtful = materialise(_ordinary(counts.filter("opens").select("entity", "n"), df, text)).withColumn("common", F.lit(True))
    out = salted_join(found, doubtful, "entity", hot, "left").select(
        ID, "mention", "entity", (F.col("initial") & F.coalesce("common", F.lit(False))).alias("dropped")
    )
    if gazetteer is not None:
        listed = gazetteer.filter(F.col("label").isin(LABELS)).select("entity").distinct()
        out = salted_join(out, listed, "entity", hot, "left_semi")
    return out


def model_mentions(
    df: DataFrame,
    load: Callable[[], Callable[[str], list[tuple[str, str]]]],
    text: str = "text",
    labels: list[str] = LABELS,
) -> DataFrame:
    """Mentions from a user's own model, which ``load`` builds once per partition.

    The model maps a text to (mention, label) pairs; pairs with other labels are
    left out.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for batch in batches:
            rows = [
                (key, mention, mention.lower().strip(), False)
                for key, body in zip(batch[ID], batch["text"], strict=True)
                for mention, label in model(body)
                if label in labels and mention.strip()
            ]
            yield pd.DataFrame(rows, columns=[ID, "mention", "entity", "dropped"])

    texts = df.select(ID, F.coalesce(F.col(text), F.lit("")).alias("text"))
    return texts.mapInPandas(run, f"{ID} long, mention string, entity string, dropped boolean")


def entity_frequencies(df: DataFrame, text: str = "text") -> DataFrame:
    """Mentions per entity over the corpus: (entity, freq).

    Mentions are counted before the lookup of sentence-opening words, so the join
    sees one row per entity. They are counted once, when this is called.
    """
    counts = materialise(
        df.select(F.inline(mentions(F.col(text))))
        .groupBy(F.lower("mention").alias("entity"))
        .agg(F.count("*").alias("n"), F.count_if("initial").alias("opening"))
    )
    ordinary = _ordinary(counts.filter("opening > 0"), df, text).withColumn("ordinary", F.lit(True))
    freq = F.when(F.col("ordinary").isNull(), F.col("n")).otherwise(F.col("n") - F.col("opening"))
    return counts.join(merged(ordinary), "entity", "left").select("entity", freq.alias("freq")).filter("freq > 0")


def partial_frequencies(df: DataFrame, text: str = "text") -> DataFrame:
    """(entity, n, opening, lower): mentions, mentions as a word that opens a sentence, and records with the word in lower case.

    The sums over parts of a corpus are those of the corpus; ``merged_frequencies`` makes frequencies of them.
    """
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    named = df.select(F.inline(mentions(F.col(text)))).select(
        F.lower("mention").alias("entity"), one.alias("n"), F.col("initial").cast("long").alias("opening"), none.alias("lower")
    )
    words = df.select(F.explode(lower_words(F.col(text))).alias("entity"), none.alias("n"), none.alias("opening"), one.alias("lower"))
    return named.unionByName(words).groupBy("entity").agg(*[F.sum(c).alias(c) for c in ("n", "opening", "lower")])


def merged_frequency(n: Column, opening: Column, lower: Column) -> Column:
    """The frequency of an entity from the sums of ``partial_frequencies``; 0 if it is none."""
    ordinary = (lower > 0) & (lower >= LOWER_SHARE * (lower + n))
    return F.when(ordinary, n - opening).otherwise(n)


def merged_frequencies(counts: DataFrame) -> DataFrame:
    """``entity_frequencies`` from the sums of ``partial_frequencies``."""
    freq = merged_frequency(F.col("n"), F.col("opening"), F.col("lower"))
    return counts.select("entity", freq.alias("freq")).filter("freq > 0")


def frequencies_of(found: DataFrame) -> DataFrame:
    """(entity, freq) of a given mention table."""
    return found.filter(~F.col("dropped")).groupBy("entity").agg(F.count("*").alias("freq"))


def rare_entities(freq: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    return freq.filter(F.col("freq") <= threshold)


def frequency_totals(freq: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Distinct entities, how many are rare, and their share."""
    return freq.agg(
        F.count("*").alias("total_unique_entities"),
        F.count_if(F.col("freq") <= threshold).alias("unusual_entities_count"),
    ).withColumn("unusual_pct", percent(F.col("unusual_entities_count"), F.col("total_unique_entities")))


def _banded(freq: DataFrame) -> DataFrame:
    n = F.col("freq")
    band = F.when(n == 1, "very_rare").when(n <= 3, "rare").when(n <= 10, "uncommon").otherwise("common")
    return freq.withColumn("band", band)


def frequency_bands(freq: DataFrame) -> DataFrame:
    """Entities per frequency band (1, 2-3, 4-10, more) and their share."""
    bands = _banded(freq).groupBy("band").agg(F.count("*").alias("entities"))
    # At most four rows reach the window.
    return bands.withColumn("percentage", percent(F.col("entities"), F.sum("entities").over(Window.partitionBy())))


def band_examples(freq: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` entities of each band by name; ranks are cut in every task before the shuffle."""
    rank = F.row_number().over(Window.partitionBy("band").orderBy("entity"))
    return _banded(freq).withColumn("rank", rank).filter(F.col("rank") <= n)


def top_entities(freq: DataFrame, n: int = 20) -> DataFrame:
    return freq.orderBy(F.desc("freq"), "entity").limit(n)


def rare_sample(freq: DataFrame, threshold: int = THRESHOLD, n: int = 20) -> DataFrame:
    return rare_entities(freq, threshold).orderBy("entity").limit(n)


def lowered(df: DataFrame, text: str) -> DataFrame:
    return df.select(ID, F.lower(F.coalesce(F.col(text), F.lit(""))).alias("text"))


def _own_mentions(c: Column) -> Column:
    """Lower-cased mentions of a text that its lower-cased form contains.

    Nearly all do, but lower-casing a part of a text can differ from that part of
    the lower-cased text. Words the text also writes in lower case are left out:
    mostly sentence openers, which would be the frequent keys of the join.
    """
    names = F.transform(mentions(c), lambda m: F.lower(m["mention"]))
    return let(F.lower(c), lambda t: F.filter(F.array_except(names, lower_words(c)), lambda e: t.contains(e)))


def rare_entity_ids(df: DataFrame, freq: DataFrame, threshold: int = THRESHOLD, text: str = "text") -> DataFrame:
    """Ids of records whose lower-cased text contains a rare entity, word boundaries or not.

    Most records that qualify mention a rare entity themselves, and an equi-join
    tells; only the others are searched for rare entities within their words. Which
    mentions the first step looks at changes the speed, never the result. ``freq``
    should be a written table. All steps but the last run when this is called.
    """
    rare = materialise(rare_entities(freq, threshold).select("entity"))
    named = materialise(df.select(ID, F.explode(_own_mentions(F.col(text))).alias("entity")))  # read twice
    # The keys of this join are counted as they are: words that open sentences are among them.
    hot = hot_keys(materialise(named.groupBy("entity").agg(F.count("*").alias("n"))), "entity")
    own = materialise(salted_join(named, rare, "entity", hot, "left_semi").select(ID).distinct())
    rest = materialise(lowered(df, text).join(bounded(own), ID, "left_anti"))
    return own.union(contained_strings(rest, rare.select(F.col("entity").alias("string")), ids_only=True))


_FOUND = "unusual_entities_found array<struct<text:string,frequency:bigint,positions:array<int>>>"


def starts(text: str, needle: str) -> list[int]:
    """0-based starts of the non-overlapping occurrences of ``needle``, left to right; see ``functions.spans.positions``."""
    found, at = [], text.find(needle)
    while at >= 0:
        found.append(at)
        at = text.find(needle, at + len(needle))
    return found


def _apart(places: list[int], size: int) -> list[int]:
    """Of the places of a string in a text those that ``starts`` gives."""
    out, end = [], 0
    for place in places:
        if place >= end:
            out.append(place)
            end = place + size
    return out


def _located(strings: Strings, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, record_id, text) to what the text may hold, in order, with its positions."""
    for batch in batches:
        for row, texts, held in found_in(strings, batch.column("text")):
            sizes, places, lengths = [], [], []
            found = [sorted(h.items()) for h in held]
            for text, hits in zip(texts, found, strict=True):
                # bytes that begin a character
                counted = None if text.isascii() else np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
                lengths.append(len(text) if counted is None else int(counted[-1]))
                for (entity, _), at in hits:
                    at = at if len(at) == 1 else _apart(at, len(entity))
                    sizes.append(len(at))
                    places += at if counted is None else (counted[at] - 1).tolist()
            names = packed([entity for hits in found for (entity, _), _ in hits])
            freqs = pa.array([freq for hits in found for (_, freq), _ in hits], pa.int64())
            each = pa.StructArray.from_arrays([names, freqs, listed(sizes, pa.array(places, pa.int32()))], ["text", "frequency", "positions"])
            part = batch.slice(row, len(texts))
            columns = [part.column("row"), part.column(ID), listed([len(hits) for hits in found], each), pa.array(lengths, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["row", ID, "unusual_entities_found", "text_length"])


def rare_entity_details(df: DataFrame, freq: DataFrame, threshold: int = THRESHOLD, text: str = "text") -> DataFrame:
    """Per record: every rare entity its text contains, with frequency and 0-based positions.

    Columns: has_unusual, unusual_count, unusual_entities_found and text_length;
    records without a hit get an empty list. Records of one id list what any of them contains, those without an id nothing. The texts
    are read once, when this is called, and are neither written nor shuffled: what was found in them goes on (see ``substring``).
    """
    rare = materialise(rare_entities(freq, threshold).select("entity", "freq"))
    shared = df.sparkSession.sparkContext.broadcast(read_strings(rare.select(F.col("entity").alias("string"), F.col("freq").alias("label"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _located(shared.value, batches)

    texts = lowered(df, text).select(F.monotonically_increasing_id().alias("row"), ID, "text")
    located = materialise(texts.mapInArrow(run, f"row long, {ID} {dict(texts.dtypes)[ID]}, {_FOUND}, text_length int"), "zstd")
    shared.unpersist()
    hits = F.col("unusual_entities_found")
    named = located.select("row", ID, F.explode(hits).alias("e")).select("row", ID, F.col("e.text").alias("entity"), F.col("e.frequency").alias("freq"))
    false = by_chance(named.select("entity", "freq"), rare)
    if not false.isEmpty():
        theirs = named.join(bounded(false), ["entity", "freq"], "left_semi").groupBy("row").agg(F.collect_set(F.struct("entity", "freq")).alias("false"))
        located = located.join(bounded(materialise(theirs)), "row", "left")
        is_false = lambda e: F.array_contains("false", F.struct(e["text"].alias("entity"), e["frequency"].alias("freq")))
        hits = F.when(F.col("false").isNull(), hits).otherwise(F.filter(hits, lambda e: ~is_false(e)))
        located = located.select("row", ID, hits.alias("unusual_entities_found"), "text_length")
    repeated = materialise(located.groupBy(ID).agg(F.count("*").alias("n")).filter(F.col("n") > 1).select(ID))
    if not repeated.isEmpty():
        located = _shared_hits(located, repeated)
    out = F.when(F.col(ID).isNotNull(), F.col("unusual_entities_found")).otherwise(F.expr(f"cast(array() as {_FOUND.partition(' ')[2]})"))
    located = located.select(ID, out.alias("unusual_entities_found"), "text_length")
    return located.withColumn("unusual_count", F.size("unusual_entities_found")).withColumn("has_unusual", F.col("unusual_count") > 0)


def _shared_hits(located: DataFrame, repeated: DataFrame) -> DataFrame:
    """Records of the ``repeated`` ids list the entities of all records of their id, without positions where their own text has none."""
    own = F.col("unusual_entities_found")
    theirs = located.join(bounded(repeated), ID, "left_semi").select(ID, F.explode(own).alias("e"))
    every = theirs.groupBy(ID).agg(F.collect_set(F.struct("e.text", "e.frequency")).alias("every"))
    absent = F.filter("every", lambda e: ~F.array_contains(own["text"], e["text"]))
    added = F.transform(absent, lambda e: F.struct(e["text"].alias("text"), e["frequency"].alias("frequency"), F.array().cast("array<int>").alias("positions")))
    hits = F.when(F.col("every").isNull(), own).otherwise(F.array_sort(F.concat(own, added)))
    return located.join(bounded(materialise(every)), ID, "left").select("row", ID, hits.alias("unusual_entities_found"), "text_length")
