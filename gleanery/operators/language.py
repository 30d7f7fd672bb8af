"""Words outside an English dictionary.

Words are tested once per distinct word, not once per token: the corpus is
reduced to its vocabulary, the vocabulary is matched with the dictionary, and only
the words that fail go back to the records. A word counts as a proper
noun when the corpus hardly ever writes it in lower case. Base forms come from suffix
rules, listed or learned, not from a language model, so hit rates differ from one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.spans import spans
from gleanery.functions.words import ALPHA_WORD, ARTIFACTS, alpha_words, base_forms, has_non_ascii, non_ascii_chars
from gleanery.operators import lemmas, ngrams
from gleanery.operators.ngrams import LetterModel
from gleanery.operators.skew import SENT_ROWS, hot_keys, merged, salted_join
from gleanery.schema import ID
from gleanery.session import materialise

_CAPITALISED = r"^\p{Lu}"

# A word is a proper noun when less than this share of its records' spellings is in lower
# case. One odd spelling in a large corpus changes nothing.
LOWER_SHARE = 0.1


def word_list(words: DataFrame) -> DataFrame:
    """A dictionary table from a one-column table of words: lowered and distinct."""
    return words.select(F.lower(F.col(words.columns[0])).alias("word")).distinct()


def corpus_dictionary(df: DataFrame, text: str = "text", min_records: int = 5) -> DataFrame:
    """Dictionary from English texts: words that occur in at least ``min_records`` of them."""
    words = F.array_distinct(F.transform(alpha_words(F.col(text)), F.lower))
    counts = df.select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("records"))
    return counts.filter(F.col("records") >= min_records)


def vocabulary(df: DataFrame, text: str = "text") -> DataFrame:
    """Distinct lower-cased words, their spellings in the records (``n``) and whether it is mostly capitalised."""
    # Each spelling is kept once per record, so tokens are thinned before the shuffle.
    spelling = F.explode(F.array_distinct(alpha_words(F.col(text)))).alias("spelling")
    lower = F.count_if(~F.col("spelling").rlike(_CAPITALISED))
    return (
        df.select(spelling)
        .groupBy(F.lower("spelling").alias("word"))
        .agg(F.count("*").alias("n"), (lower < LOWER_SHARE * F.count("*")).alias("capitalised"))
    )


def unknown_words(
    vocab: DataFrame,
    dictionary: DataFrame,
    irregular: DataFrame | None = None,
    min_length: int = 3,
    artifacts: bool = True,
    rules: DataFrame | None = None,
    letters: LetterModel | None = None,
) -> DataFrame:
    """Vocabulary words none of whose base forms is in the dictionary.

    ``irregular`` adds base forms by table (form, lemma). ``min_length`` and
    ``artifacts`` (skip the informal words) can be switched off. With learned ``rules`` (``lemmas.fit``) a word has
    the one lemma they give it instead of the listed endings' candidates. With a model of ``letters`` (``ngrams.fit``)
    only words that look foreign by their letters, too, are left, so that names and misspellings are not.
    """
    candidates = vocab.filter(~F.col("capitalised") & (F.length("word") >= min_length))
    if artifacts:
        candidates = candidates.filter(~F.col("word").isin(ARTIFACTS))
    if rules is None:
        forms = candidates.select("word", F.explode(base_forms(F.col("word"))).alias("form"))
    else:
        own = candidates.select("word", F.col("word").alias("form"))
        forms = own.union(lemmas.lemmas(candidates.select("word"), rules))
    if irregular is not None:
        special = candidates.join(irregular, candidates["word"] == irregular["form"])
        forms = forms.union(special.select(candidates["word"], F.col("lemma")))
    known = forms.join(dictionary.select(F.col("word").alias("form")), "form", "left_semi").select("word").distinct()
    unknown = candidates.join(known, "word", "left_anti").select("word", "n")
    if letters is not None:
        foreign = ngrams.languages_of(unknown, letters).filter("foreign").select("word")
        unknown = unknown.join(foreign, "word", "left_semi")
    return unknown


@dataclass
class Lexicon:
    """The words of a corpus that its dictionary lacks, the corpus' most frequent words, and the others that are still
    frequent enough to be sent to all tasks: few words make up most of a text, and most of those pass."""

    unknown: DataFrame
    frequent: list
    familiar: DataFrame | None = None

    def doubtful(self, tokens: DataFrame) -> DataFrame:
        """``tokens`` (word, ...) without those of familiar words, which need no join with all unknown ones."""
        return tokens if self.familiar is None else tokens.join(F.broadcast(self.familiar), "word", "left_anti")


def _familiar(vocab: DataFrame, unknown: DataFrame) -> DataFrame:
    """(word) of the words with more than their share of a table of ``SENT_ROWS`` rows, so no more than that, that are not unknown."""
    total = vocab.agg(F.sum("n")).first()[0] or 0
    often = vocab.filter(F.col("n") * SENT_ROWS > total).select("word")
    return materialise(often.join(merged(unknown), "word", "left_anti"))


def lexicon(
    df: DataFrame,
    dictionary: DataFrame,
    text: str = "text",
    irregular: DataFrame | None = None,
    min_length: int = 3,
    artifacts: bool = True,
    rules: DataFrame | None = None,
    letters: LetterModel | None = None,
    keep: Callable[[str, Callable[[], DataFrame]], DataFrame] = lambda name, make: materialise(make()),
) -> Lexicon:
    """Judge the vocabulary of a corpus once, for use on it or any part of it. ``keep`` says where the tables for it go."""
    vocab = keep("vocabulary", lambda: vocabulary(df, text))
    unknown = keep("unknown", lambda: unknown_words(vocab, dictionary, irregular, min_length, artifacts, rules, letters).select("word"))
    return Lexicon(unknown, hot_keys(vocab, "word"), _familiar(vocab, unknown))


def non_english_ids(df: DataFrame, words: Lexicon, text: str = "text") -> DataFrame:
    """Ids of records with a non-ASCII letter or a word outside the dictionary."""
    accented = has_non_ascii(F.col(text))
    spelling = F.explode(F.array_distinct(alpha_words(F.col(text)))).alias("spelling")
    rest = df.filter(~accented).select(ID, spelling).select(ID, F.lower("spelling").alias("word"))
    by_word = salted_join(words.doubtful(rest), words.unknown, "word", words.frequent, "left_semi")
    return df.filter(accented).select(ID).union(by_word.select(ID).distinct())


def non_english_words(df: DataFrame, words: Lexicon, text: str = "text") -> DataFrame:
    """One row per occurrence of a word outside the dictionary, with offsets."""
    tokens = df.select(ID, F.inline(spans(F.col(text), ALPHA_WORD))).withColumn("word", F.lower("text"))
    hits = salted_join(words.doubtful(tokens), words.unknown, "word", words.frequent)
    return hits.select(ID, F.col("text").alias("token"), "word", "start", "end")


def non_english_details(df: DataFrame, words: Lexicon, text: str = "text") -> DataFrame:
    """Per record: the words outside the dictionary in order, and its non-ASCII letters."""
    per_record = non_english_words(df, words, text).groupBy(ID).agg(
        F.array_sort(F.collect_list(F.struct("start", "end", "token", "word"))).alias("non_english_words")
    )
    chars = df.select(ID, non_ascii_chars(F.col(text)).alias("non_ascii_chars"))
    nothing = F.array().cast("array<struct<start:int,end:int,token:string,word:string>>")
    return chars.join(per_record, ID, "left").withColumn(
        "non_english_words", F.coalesce("non_english_words", nothing)
    )


def phrase_check(
    df: DataFrame, dictionary: DataFrame, text: str = "text", irregular: DataFrame | None = None
) -> DataFrame:
    """Words of each phrase that the dictionary lacks, in order and with repeats.

    Unlike the detector it has no length rule, no informal-word list and no
    non-ASCII shortcut. Phrases without such words get an empty list.
    """
    words = lexicon(df, dictionary, text, irregular, min_length=1, artifacts=False)
    tokens = df.select(ID, F.posexplode(alpha_words(F.col(text))).alias("pos", "token"))
    hits = salted_join(words.doubtful(tokens.withColumn("word", F.lower("token"))), words.unknown, "word", words.frequent, "left_semi")
    per_phrase = hits.groupBy(ID).agg(F.array_sort(F.collect_list(F.struct("pos", "token"))).alias("hits"))
    found: Column = F.transform("hits", lambda h: h["token"])
    return (
        df.select(ID)
        .join(per_phrase, ID, "left")
        .select(ID, F.coalesce(found, F.array().cast("array<string>")).alias("non_english_words"))
    )
