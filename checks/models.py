"""Registered queries of what is learned from the tables: labels of words, base forms, languages of words, spellings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.functions.words import alpha_words
from gleanery.operators import lemmas, ngrams, spelling, tagging
from gleanery.schema import ID
from gleanery.session import materialise


def _syllables(key: str) -> str:
    return f"substr('BDFGKLMNPR', cast({key} % 10 as int) + 1, 1) || translate(cast({key} as string), '0123456789', 'alorinesut')"


def _capital(word: str) -> str:
    return f"upper(substr({word}, 1, 1)) || lower(substr({word}, 2))"


# A sentence about every order, each word with its label: names of customers, firms and works look alike, so that
# only their neighbours tell them apart. Valid in Spark SQL and DuckDB.
TAGGED_SQL = f"""
with named as (
  select o_orderkey as record_id, {_syllables("o_custkey")} as f, {_syllables("(o_orderkey + 7)")} as l, {_syllables("(o_custkey + 31)")} as o, {_syllables("(o_orderkey + 100013)")} as x,
    {_capital("split_part(p_name, ' ', 1)")} as p1, {_capital("split_part(p_name, ' ', 2)")} as p2,
    {_syllables("(n_nationkey + 300)")} as g, {_capital("split_part(r_name, ' ', 1)")} as r
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
  join part on p_partkey = o_custkey)
select record_id, case record_id % 3
  when 0 then f || '/PERSON ' || l || '/PERSON of/O ' || o || '/ORG Brothers/ORG sent/O a/O ' || p1 || '/PRODUCT ' || p2 || '/PRODUCT to/O ' || g || '/GPE ./O'
  when 1 then 'In/O ' || g || '/GPE ,/O ' || f || '/PERSON ' || l || '/PERSON sang/O Song/WORK_OF_ART of/WORK_OF_ART ' || x || '/WORK_OF_ART for/O '
    || o || '/ORG Works/ORG ./O'
  else 'The/O ' || p1 || '/PRODUCT ' || p2 || '/PRODUCT crossed/O the/O ' || r || '/LOC Sea/LOC near/O ' || g || '/GPE ;/O ' || f || '/PERSON wept/O ./O'
  end as tagged from named
"""
# Every fifth order is left out of the counts, and labelled.
FOLDS = 5


def _tagged(spark: SparkSession, sf: str) -> DataFrame:
    tables = {t: spark.read.parquet(f"{sf}/{t}.parquet") for t in ("orders", "customer", "nation", "region", "part")}
    sql = TAGGED_SQL
    for t in ("orders join customer", "join nation", "join region", "join part"):
        sql = sql.replace(t, " ".join(f"{{{w}}}" if w in tables else w for w in t.split()))
    rows = spark.sql(sql, **tables)
    word = F.transform(F.split("tagged", " "), lambda w: F.struct(F.split_part(w, F.lit("/"), F.lit(1)).alias("word"), F.split_part(w, F.lit("/"), F.lit(2)).alias("label")))
    return materialise(rows.select(ID, word.alias("sentence")))


def _tagger(rows: DataFrame) -> tagging.Tagger:
    return tagging.fit(rows.filter(F.col(ID) % FOLDS != 0))


def tag_words(spark, sf):
    """What the labels of known words and shapes cost."""
    return _tagger(_tagged(spark, sf)).words.select("word", F.array_join("costs", ",").alias("costs"))


def tag_sentences(spark, sf):
    """Labels found in sentences that were not counted, beside the right ones."""
    rows = _tagged(spark, sf)
    tagger = _tagger(rows)
    rest = rows.filter(F.col(ID) % FOLDS == 0)
    texts = rest.select(ID, F.array_join(F.transform("sentence", lambda w: w["word"]), " ").alias("text"))
    found = tagging.label_words(texts, tagger).select(ID, "labels")
    letters = F.create_map(*[F.lit(x) for i, t in enumerate(tagger.labels) for x in (t, tagger.letter(i))])
    right = F.array_join(F.transform("sentence", lambda w: letters[w["label"]]), "").alias("gold")
    return rest.select(ID, right).join(found, ID)


def tag_accuracy(spark, sf):
    """Words of each label and how many of them got it, over sentences that were not counted."""
    pairs = F.arrays_zip(F.split("gold", "").alias("gold"), F.split("labels", "").alias("found"))
    each = tag_sentences(spark, sf).select(F.inline(pairs)).filter("gold != ''")
    return each.groupBy("gold").agg(F.count("*").alias("words"), F.count_if(F.col("gold") == F.col("found")).alias("right"))


# Every word's plural, present and past, valid in Spark SQL and DuckDB.
_DOUBLES = """right(word, 1) in ('b', 'd', 'g', 'm', 'n', 'p', 't') and substr(word, length(word) - 1, 1) in ('a', 'e', 'i', 'o', 'u')
  and substr(word, length(word) - 2, 1) not in ('a', 'e', 'i', 'o', 'u')"""
INFLECTED_SQL = f"""
select word as form, word as lemma from words union
select case when right(word, 1) = 'y' then left(word, length(word) - 1) || 'ies'
  when right(word, 1) in ('s', 'x', 'z') or right(word, 2) in ('ch', 'sh') then word || 'es' else word || 's' end, word from words union
select case when right(word, 1) = 'e' then left(word, length(word) - 1) || 'ing' when {_DOUBLES} then word || right(word, 1) || 'ing'
  else word || 'ing' end, word from words union
select case when right(word, 1) = 'e' then word || 'd' when right(word, 1) = 'y' then left(word, length(word) - 1) || 'ied'
  when {_DOUBLES} then word || right(word, 1) || 'ed' else word || 'ed' end, word from words
"""
# Lemmas that are left out of the rules.
HELD_OUT = "substr(md5(lemma), 1, 1) in ('0', '1', '2')"
WORDS = "[a-z]{4,9}"


def _pairs(spark, sf) -> DataFrame:
    """(form, lemma) for words of the English documents."""
    english = spark.read.parquet(f"{sf}/documents.parquet").filter("lang = 'en'")
    words = english.select(F.explode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORDS), 0)).alias("word")).distinct()
    return materialise(spark.sql(INFLECTED_SQL.replace("from words", "from {words}"), words=words))


def lemma_rules(spark, sf):
    return lemmas.suffix_rules(_pairs(spark, sf).filter(f"not ({HELD_OUT})"))


def lemmas_found(spark, sf):
    """The lemma of every form whose own lemma taught nothing."""
    pairs = _pairs(spark, sf)
    rules = lemmas.fit(pairs.filter(f"not ({HELD_OUT})"))
    return lemmas.lemmas(pairs.filter(HELD_OUT).select(F.col("form").alias("word")).distinct(), rules)


def lemma_accuracy(spark, sf):
    """Forms that taught nothing, and how many of their lemmas are right."""
    pairs = _pairs(spark, sf).filter(HELD_OUT)
    found = lemmas_found(spark, sf).select(F.col("word").alias("form"), F.col("lemma").alias("found"))
    return pairs.join(found, "form").agg(F.count("*").alias("forms"), F.count_if(F.col("lemma") == F.col("found")).alias("right"))


def _texts(spark, sf) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet").select(F.col("doc_id").alias(ID), "text", "lang")


def letter_runs(spark, sf):
    return ngrams.run_counts(_texts(spark, sf))


def word_languages(spark, sf):
    """The language of each word of documents that were not counted, by its letters."""
    texts = _texts(spark, sf)
    model = ngrams.fit(texts.filter(F.col(ID) % FOLDS != 0))
    words = texts.filter(F.col(ID) % FOLDS == 0).select(F.explode(F.array_distinct(F.transform(alpha_words(F.col("text")), F.lower))).alias("word"))
    return ngrams.languages_of(words.distinct(), model)


def language_accuracy(spark, sf):
    """Words of each language that were not counted, by the language they look like."""
    texts = _texts(spark, sf).filter(F.col(ID) % FOLDS == 0)
    spelt = F.explode(F.array_distinct(F.transform(alpha_words(F.col("text")), F.lower))).alias("word")
    pairs = texts.select("lang", spelt).distinct()
    found = word_languages(spark, sf)
    return pairs.join(found, "word").groupBy("lang", "language").agg(F.count("*").alias("words"), F.count_if("foreign").alias("foreign"))


def _english(spark, sf) -> DataFrame:
    return _texts(spark, sf).filter("lang = 'en'")


def clean_dictionary(spark, sf):
    return spelling.clean_dictionary(_english(spark, sf))


def slips(spark, sf):
    return spelling.slips(materialise(spelling.word_counts(_english(spark, sf))))


QUERIES = {
    "lemma_rules": lemma_rules,
    "lemmas_found": lemmas_found,
    "lemma_accuracy": lemma_accuracy,
    "letter_runs": letter_runs,
    "word_languages": word_languages,
    "language_accuracy": language_accuracy,
    "clean_dictionary": clean_dictionary,
    "slips": slips,
    "tag_words": tag_words,
    "tag_sentences": tag_sentences,
    "tag_accuracy": tag_accuracy,
}
