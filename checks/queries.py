"""The registered queries: every operator over whole tables.

Array and map columns are joined to text, so that results compare by value.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import models
from gleanery.functions import numbers as N
from gleanery.functions import tables
from gleanery.functions import text as X
from gleanery.functions import words as W
from gleanery.functions.rules import validate_metadata_field
from gleanery.operators import detectors as D
from gleanery.operators import entities as E
from gleanery.operators import language as L
from gleanery.operators import load, profile, sample, sketches, validate
from gleanery.operators.numbers import number_details, number_mentions
from gleanery.plans.clean import Cleaned, clean_and_validate, debug_if_low
from gleanery.plans.curate import check, curate
from gleanery.plans.entity_log import EntityLog
from gleanery.plans.report import field_figures, run_report
from gleanery.plans.subsets import Subset, build_subset, sample_results
from gleanery.schema import ID, RECORD_COLUMNS
from gleanery.session import materialise, scratch_dir
from gleanery.sources.records import read_records
from gleanery.sources.sinks import before_after, write_jsonl

# Records made from the documents table: one per document, whole text as the
# question, with every kind of fault the validator has to find. The text is valid
# in Spark SQL and DuckDB alike.
RECORDS_SQL = """
select doc_id as record_id,
 case when doc_id%17=0 then '   ' when doc_id%19=0 then null else lang||' ('||source||')' end as category,
 case when doc_id%11=0 then null when doc_id%13=0 then '$' when doc_id%7=0 then '$2,000'
      else '$'||cast((doc_id%5+1)*200 as string) end as value,
 case when doc_id%23=0 then null when doc_id%29=0 then ' '
      when doc_id%3=0 then 'Daily Double: <i>seen here</i> &amp; http://a.b/c_d?e=1 ____ ?! '||text
      else text end as question,
 case when doc_id%31=0 then null when doc_id%37=0 then ''
      else ' the '||source||'’s “'||lang||'” – ... ' end as answer,
 case when doc_id%43=0 then null when doc_id%10=0 then 'Final Jeopardy!' when doc_id%10=1 then 'Tiebreaker'
      when doc_id%10=2 then 'Bonus' when doc_id%2=0 then 'Double Jeopardy!' else 'Jeopardy!' end as round,
 case when doc_id%47=0 then 'n/a' else cast(doc_id+1 as string) end as show_number,
 case when doc_id%41=0 then '' else '2004-12-'||lpad(cast(doc_id%28+1 as string),2,'0') end as air_date
from {documents}
"""

# More turns than a conversation has.
TURNS = 1 << 32

# Words in at least this many English documents make up the dictionary.
DICTIONARY_RECORDS = 5
SAMPLE_SIZE = 100


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark, sf_dir) -> DataFrame:
    """(record_id, text, lang)"""
    df = table(spark, sf_dir, "documents")
    return df.select(F.col("doc_id").alias(ID), "text", "lang")


def pages(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "pages").select(F.col("page_id").alias(ID), "html")


def phrases(spark, sf_dir) -> DataFrame:
    """Turns of conversations as phrases."""
    df = table(spark, sf_dir, "conversations")
    return df.select((F.col("conv_id") * TURNS + F.col("turn")).alias(ID), "text")


def raw_records(spark, sf_dir) -> DataFrame:
    df = table(spark, sf_dir, "documents")
    return spark.sql(RECORDS_SQL.format(documents="{documents}"), documents=df)


def records(spark, sf_dir) -> DataFrame:
    return load.normalise(raw_records(spark, sf_dir))


def flagged(spark, sf_dir) -> DataFrame:
    return validate.flag(records(spark, sf_dir))


def cleaned(spark, sf_dir) -> DataFrame:
    return Cleaned(flagged(spark, sf_dir)).records


def dictionary(spark, sf_dir) -> DataFrame:
    english = documents(spark, sf_dir).filter(F.col("lang") == "en")
    return L.corpus_dictionary(english, min_records=DICTIONARY_RECORDS)


def frequencies(spark, sf_dir) -> DataFrame:
    return E.entity_frequencies(documents(spark, sf_dir))


def _long(c) -> F.Column:
    return F.length(c).cast("long")


def _joined(c, sep="; ") -> F.Column:
    return F.array_join(c, sep)


# ------------------------------------------------------------------ text


def _page(fn):
    return lambda spark, sf: pages(spark, sf).select(ID, fn(F.col("html")).alias("out"))


def _field(fn, field):
    return lambda spark, sf: raw_records(spark, sf).select(ID, fn(F.col(field)).alias("out"))


def _document(fn):
    return lambda spark, sf: documents(spark, sf).select(ID, fn(F.col("text")).alias("out"))


def cleaning_preview(spark, sf):
    df = records(spark, sf)
    parts = [
        validate.cleaning_preview(df, f, limit=None).select(
            ID, F.lit(f).alias("field"), F.col(f).alias("original"), F.col(f"{f}_cleaned").alias("cleaned"), "changed"
        )
        for f in ("question", "answer", "category")
    ]
    return reduce(DataFrame.union, parts)


# ------------------------------------------------------------ validation


def validate_metadata(spark, sf):
    errors = validate.metadata_errors(records(spark, sf))
    return records(spark, sf).select(ID, (F.size(errors) == 0).alias("valid"), _joined(errors).alias("errors"))


def validate_text(spark, sf):
    df = flagged(spark, sf).filter(F.size("meta_errors") == 0)
    return df.select(ID, "question_clean", "answer_clean", _joined("text_errors").alias("errors"))


def rejects(spark, sf):
    shown = ["category", "value", "round", "show_number", "question_cleaned", "answer_cleaned"]
    return validate.rejects(flagged(spark, sf)).select(
        ID, "stage", "reason", _joined("errors").alias("errors"), *[F.col("sample")[k].alias(k) for k in shown]
    )


def reject_examples(spark, sf):
    out = validate.reject_examples(validate.rejects(flagged(spark, sf)))
    return out.select(ID, "reason", "rank", _joined("errors").alias("errors"))


def validation_debug(spark, sf):
    out = validate.debug(records(spark, sf))
    return out.withColumns({c: _joined(c) for c in ("errors", "warnings")})


def round_trip(spark, sf):
    """Cleaned records written as JSON lines and read back."""
    path = f"{scratch_dir(spark)}/{uuid.uuid4().hex}"
    write_jsonl(cleaned(spark, sf), path)
    return read_records(spark, path, "jsonl").select(ID, *RECORD_COLUMNS)


# --------------------------------------------------------------- numbers


def numbers_details(spark, sf):
    out = number_details(documents(spark, sf))
    sizes = [F.size(c).cast("long").alias(c) for c in ("number_tokens", "roman_numerals")]
    return out.select(ID, *sizes, F.col("total_numbers_found").cast("long"))


def number_function(spark, sf):
    """The mentions by a table function in SQL."""
    tables.register(spark)
    return spark.sql("select record_id, m.* from {texts}, lateral number_mentions(text) m", texts=documents(spark, sf))


# -------------------------------------------------------------- language


def vocabulary(spark, sf):
    return L.vocabulary(documents(spark, sf))


def base_forms(spark, sf):
    words = L.vocabulary(documents(spark, sf)).select("word")
    return words.select("word", F.explode(W.base_forms(F.col("word"))).alias("form"))


def unknown_words(spark, sf):
    return L.unknown_words(materialise(vocabulary(spark, sf)), dictionary(spark, sf))


def _lexicon(spark, sf):
    return L.lexicon(documents(spark, sf), dictionary(spark, sf))


def non_english_detect(spark, sf):
    return L.non_english_ids(documents(spark, sf), _lexicon(spark, sf))


def non_english_words(spark, sf):
    return L.non_english_words(documents(spark, sf), _lexicon(spark, sf))


def non_english_details(spark, sf):
    out = L.non_english_details(documents(spark, sf), _lexicon(spark, sf))
    return out.select(
        ID,
        _joined("non_english_words.token", " ").alias("words"),
        _joined("non_ascii_chars", "").alias("chars"),
    )


def phrase_check(spark, sf):
    out = L.phrase_check(phrases(spark, sf), dictionary(spark, sf))
    return out.select(ID, _joined("non_english_words", " ").alias("words"))


# -------------------------------------------------------------- entities


def rare_detect(spark, sf):
    return E.rare_entity_ids(documents(spark, sf), materialise(frequencies(spark, sf)))


def rare_details(spark, sf):
    out = E.rare_entity_details(documents(spark, sf), materialise(frequencies(spark, sf)))
    hits = out.select(ID, F.explode("unusual_entities_found").alias("e"), "unusual_count", "text_length")
    return hits.select(
        ID,
        F.col("e.text").alias("entity"),
        F.col("e.frequency").alias("freq"),
        _joined("e.positions", ",").alias("positions"),
        F.col("unusual_count").cast("long"),
        F.col("text_length").cast("long"),
    )


# Batches that the log of entities is given.
BATCHES = 3


def _logged(spark, sf) -> EntityLog:
    log, df = EntityLog(spark, _scratch(spark)), documents(spark, sf)
    for i in range(BATCHES):
        log.add(df.filter(F.col(ID) % BATCHES == i))
    return log


# -------------------------------------------------- subsets and reports


def _subsets(spark, sf) -> tuple[DataFrame, list[Subset]]:
    judged = materialise(flagged(spark, sf))
    clean = Cleaned(judged).records
    detectors = [D.number_detector(), D.LanguageDetector(dictionary(spark, sf)), D.EntityDetector()]
    return judged, [build_subset(clean, d, SAMPLE_SIZE) for d in detectors]


def _sampled(detector):
    def run(spark, sf):
        clean = materialise(cleaned(spark, sf))
        d = detector(spark, sf)
        return sample.sample_records(clean, d.hits(D.texts(clean, d)), SAMPLE_SIZE)

    return run


def detection_stats(spark, sf):
    _, subsets = _subsets(spark, sf)
    return reduce(DataFrame.union, [s.stats.select(F.lit(s.name).alias("name"), *s.stats.columns) for s in subsets])


def run_figures(spark, sf):
    judged, subsets = _subsets(spark, sf)
    return run_report(Cleaned(judged), subsets, subsets[2].detector.freq)


def detected_samples(spark, sf):
    _, subsets = _subsets(spark, sf)
    out = reduce(DataFrame.union, [sample_results(s) for s in subsets])
    return out.withColumn("detected", _joined("detected"))


def _scratch(spark) -> str:
    return f"{scratch_dir(spark)}/{uuid.uuid4().hex}"


def _raw_lines(spark, sf) -> str:
    """The raw records as JSON lines with late and partial columns but all keys."""
    path = _scratch(spark)
    raw_records(spark, sf).sortWithinPartitions(F.desc(ID)).write.json(path)
    return path


def curated(part):
    """What the whole job writes below its output folder, read back."""

    def run(spark, sf):
        out = _scratch(spark)
        curate(spark, _raw_lines(spark, sf), out, "jsonl", size=SAMPLE_SIZE, detectors=[D.number_detector()])
        return part(spark, out)

    return run


def _curated_records(spark, out):
    return read_records(spark, f"{out}/cleaned", "jsonl").select(ID, *RECORD_COLUMNS)


def _curated_subset(spark, out):
    return spark.read.json(f"{out}/subsets/numbers").select(*RECORD_COLUMNS)


def _curated_rejects(spark, out):
    rows = spark.read.json(f"{out}/validation/removed_records")
    return rows.select(ID, "stage", "reason", _joined("errors").alias("errors"))


def checked_table(spark, sf):
    """The comparison that the check run writes as CSV, read back."""
    out = _scratch(spark)
    check(spark, _raw_lines(spark, sf), out, SAMPLE_SIZE, "jsonl")
    rows = spark.read.csv(f"{out}/before_after", header=True, multiLine=True)
    return rows.select(F.col("record_index").cast("long"), "original_round", "cleaned_round")


def parquet_records(spark, sf):
    """Raw records written as a table with keys and read back."""
    path = _scratch(spark)
    raw_records(spark, sf).write.parquet(path)
    return read_records(spark, path, "parquet").select(ID, *RECORD_COLUMNS)


# Records of one file of those that the reader of arrays and of keyless lines is given.
FILE_RECORDS = 2000


def _files(spark, sf, form, keyed=True) -> str:
    """The raw records as many files, in order of their keys over all files; ``form`` makes a file's text from its objects."""
    path = _scratch(spark)
    block = F.lpad(F.floor(F.col(ID) / FILE_RECORDS).cast("string"), 9, "0").alias("block")
    shown = [ID, *RECORD_COLUMNS] if keyed else RECORD_COLUMNS
    line = F.to_json(F.struct(*shown), {"ignoreNullFields": "false"}).alias("line")
    files = raw_records(spark, sf).select(block, F.struct(ID, line).alias("row")).groupBy("block").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    files.select("block", form(F.col("rows.line")).alias("value")).write.partitionBy("block").text(path)
    return path


def json_array(spark, sf):
    """Array files read in ranges."""
    path = _files(spark, sf, lambda lines: F.concat(F.lit("[\n"), F.array_join(lines, ",\n"), F.lit("\n]")))
    return read_records(spark, path).select(ID, *RECORD_COLUMNS)


def numbered_rows(kind):
    """Files without keys: every record by its number in the input."""

    def run(spark, sf):
        forms = {
            "json": lambda lines: F.concat(F.lit("["), F.array_join(lines, ","), F.lit("]")),
            "jsonl": lambda lines: F.array_join(lines, "\n"),
        }
        return read_records(spark, _files(spark, sf, forms[kind], keyed=False), kind).select(ID, *RECORD_COLUMNS)

    return run


def first_of_input(spark, sf):
    """The first records of files without keys."""
    path = _files(spark, sf, lambda lines: F.array_join(lines, "\n"), keyed=False)
    return read_records(spark, path, "jsonl", limit=SAMPLE_SIZE).select(ID, *RECORD_COLUMNS)


def sketched_categories(spark, sf):
    """Categories over all loads, by one sketch a load: within three standard errors of the exact number."""
    path, df = _scratch(spark), records(spark, sf)
    for i in range(BATCHES):
        sketches.add_load(df.filter(F.col(ID) % BATCHES == i), ["category"], f"load{i}", path)
    exact = profile.distinct_categories(df).first().unique_count
    within = F.abs(F.col("unique_count") - exact) <= 3 * sketches.STANDARD_ERROR * exact
    return sketches.merged_counts(spark, path).select("column", F.lit(exact).cast("long").alias("unique_count"), within.alias("within"))


def rejects_without(column):
    def run(spark, sf):
        out = validate.rejects(validate.flag(records(spark, sf).drop(column)))
        return out.select(ID, "stage", F.col("sample")[column].alias("shown"))

    return run


def missing_columns(spark, sf):
    """What the reader says of JSON lines without two of the columns."""
    path = _scratch(spark)
    raw_records(spark, sf).drop("value", "air_date").write.json(path)
    try:
        read_records(spark, path, "jsonl")
    except ValueError as e:
        return spark.range(1).select(F.lit(str(e)).alias("message"))


def unknown_field(spark, sf):
    """The verdict on a field that no rule knows, here the language of each document."""
    verdict = validate_metadata_field(F.col("lang"), "lang")
    return documents(spark, sf).select(ID, verdict["valid"].alias("valid"), _joined(verdict["errors"]).alias("errors"), _joined(verdict["warnings"]).alias("warnings"))


def low_retention(spark, sf):
    """Whether so few records are left that the first five are explained: of the records, and of those with most values spoilt."""
    parts = []
    df = records(spark, sf)
    spoilt = df.withColumn("value", F.when(F.col(ID) % 3 > 0, "bad").otherwise(F.col("value")))
    for name, rows in (("given", df), ("spoilt", spoilt)):
        cleaned_rows = clean_and_validate(rows)
        shown = debug_if_low(rows, cleaned_rows)
        parts.append(spark.range(1).select(F.lit(name).alias("rows"), F.lit(shown is not None).alias("low"), F.lit(0 if shown is None else shown.count()).cast("long").alias("shown")))
    return parts[0].union(parts[1])


def checked_records(spark, sf):
    """The clean records that the check run writes, read back."""
    out = _scratch(spark)
    check(spark, _raw_lines(spark, sf), out, SAMPLE_SIZE, "jsonl")
    return _curated_records(spark, out)


def _curated_report(spark, out):
    rows = spark.read.json(f"{out}/report/run").select("section", "metric", "value")
    return rows.filter(~F.col("metric").isin("processing_time", "total_processing_time", "average_speed_records_per_second"))


def _curated_frame(name, columns):
    return lambda spark, out: spark.read.json(f"{out}/validation/{name}").select(*columns)


def curated_by_all(spark, sf):
    """The third subset of a run with all detectors that need no dictionary, on its own resumable intermediates."""
    out = _scratch(spark)
    curate(spark, _raw_lines(spark, sf), out, "jsonl", size=SAMPLE_SIZE, resume=_scratch(spark))
    return spark.read.json(f"{out}/subsets/proper_nouns").select(*RECORD_COLUMNS)


def gazetteer_mentions(spark, sf):
    """Mentions of listed entities with a label that counts: here those of an even number of letters, the others are dates."""
    label = F.when(F.length("entity") % 2 == 0, "GPE").otherwise("DATE")
    listed = materialise(frequencies(spark, sf).select("entity", label.alias("label")))
    return E.entity_mentions(documents(spark, sf), gazetteer=listed)


def number_lists(spark, sf):
    out = number_details(documents(spark, sf))
    return out.select(ID, _joined(F.col("number_tokens.text"), " ").alias("tokens"), _joined(F.col("roman_numerals.text"), " ").alias("romans"))


def flag_column(spark, sf):
    clean = cleaned(spark, sf)
    return D.flag_column(clean, D.number_detector()).select(ID, "has_numbers")


def combined_text(spark, sf):
    clean = cleaned(spark, sf)
    return clean.select(ID, D.combined_text(clean, ["question", "answer", "category", "absent"]).alias("text"))


def _over(fn, source):
    return lambda spark, sf: fn(source(spark, sf))


def _rounded(query):
    """Doubles to six digits: sums depend on the order of addition."""

    def run(spark, sf):
        df = query(spark, sf)
        return df.withColumns({c: F.round(c, 6) for c, t in df.dtypes if t == "double"})

    return run


# Columns rounded to six digits, here and in the SQL.
DOUBLES = {
    "null_profile": ["null_pct"],
    "field_stats": ["error_rate"],
    "cleaning_summary": ["original_avg_length", "cleaned_avg_length", "avg_reduction"],
    "totals": ["removal_rate"],
    "summary": ["avg_question_length", "avg_answer_length"],
    "text_lengths": ["avg_question_length", "avg_answer_length"],
    "frequency_totals": ["unusual_pct"],
    "frequency_bands": ["percentage"],
    "detection_stats": ["detection_rate", "sampling_ratio"],
    "run_report": ["value"],
    "report_fields": ["value"],
    "curate_report": ["value"],
    "curate_totals": ["removal_rate"],
}

QUERIES = {
    # text
    "html_to_text": _page(lambda c: X.squeeze_space(X.html_to_text(c))),
    "strip_tags": _page(X.strip_tags),
    "decode_entities": _page(X.decode_entities),
    "drop_references": _page(X.drop_references),
    "link_blank_markers": _field(lambda c: X.mark_links(X.mark_blanks(c)), "question"),
    "drop_markers": _field(X.drop_markers, "question"),
    "straighten": _field(lambda c: X.straighten_dashes(X.straighten_apostrophes(c)), "answer"),
    "straighten_quotes": _field(X.straighten_quotes, "answer"),
    "unescape_quotes": _page(lambda c: X.unescape_quotes(F.replace(c, F.lit('"'), F.lit('\\\\"')))),
    "drop_bracketed": _field(X.drop_bracketed, "category"),
    "collapse_punctuation": _document(X.collapse_punctuation),
    "squeeze_space": _document(X.squeeze_space),
    "clean_question": _field(lambda c: X.clean_text(c, "question"), "question"),
    "clean_answer": _field(lambda c: X.clean_text(c, "answer"), "answer"),
    "clean_category": _field(lambda c: X.clean_text(c, "category"), "category"),
    "clean_general": _document(lambda c: X.clean_text(c, "general")),
    "cleaning_preview": cleaning_preview,
    # load
    "load_normalise": records,
    "load_counts": _over(load.load_counts, raw_records),
    "null_profile": _over(load.null_profile, records),
    "first_rows": lambda spark, sf: load.first_rows(raw_records(spark, sf), SAMPLE_SIZE),
    "json_round_trip": round_trip,
    "word_list": lambda spark, sf: L.word_list(
        documents(spark, sf).select(F.explode(F.split("text", r"[^\p{L}]+")).alias("w"))
    ),
    # validation
    "validate_metadata": validate_metadata,
    "validate_text": validate_text,
    "accepted": cleaned,
    "rejects": rejects,
    "reject_examples": reject_examples,
    "validation_debug": validation_debug,
    "field_stats": _over(profile.field_stats, flagged),
    "cleaning_summary": _over(profile.cleaning_summary, flagged),
    "totals": _over(profile.totals, flagged),
    "before_after": lambda spark, sf: before_after(records(spark, sf), cleaned(spark, sf), limit=None),
    # profile
    "summary": _over(profile.summary, records),
    "date_range": _over(profile.date_range, records),
    "round_distribution": _over(profile.round_distribution, records),
    "distinct_categories": _over(profile.distinct_categories, records),
    "top_categories": _over(profile.top_categories, records),
    "sketched_categories": sketched_categories,
    "text_lengths": _over(profile.text_lengths, records),
    "first_record": _over(profile.first_record, records),
    # numbers
    "any_digit": _document(N.any_digit),
    "number_regex": _document(N.has_basic_number),
    "roman": _document(N.has_roman),
    "roman_strict": _document(lambda c: N.has_roman(c, strict=True)),
    "numbers_detect": _document(N.has_number),
    "number_mentions": _over(number_mentions, documents),
    "number_details": numbers_details,
    "number_function": number_function,
    # language
    "non_ascii": _document(W.has_non_ascii),
    "dictionary_build": dictionary,
    "vocabulary": vocabulary,
    "base_forms": base_forms,
    "unknown_words": unknown_words,
    "non_english_detect": non_english_detect,
    "non_english_words": non_english_words,
    "non_english_details": non_english_details,
    "phrase_check": phrase_check,
    # entities
    "entity_mentions": _over(E.entity_mentions, documents),
    "entity_frequency": frequencies,
    "rare_entities": _over(E.rare_entities, frequencies),
    "frequency_totals": _over(E.frequency_totals, frequencies),
    "frequency_bands": _over(E.frequency_bands, frequencies),
    "band_examples": _over(E.band_examples, frequencies),
    "top_entities": _over(E.top_entities, frequencies),
    "rare_sample": _over(E.rare_sample, frequencies),
    "rare_detect": rare_detect,
    "rare_details": rare_details,
    "logged_frequency": lambda spark, sf: _logged(spark, sf).frequencies(),
    "logged_rare": lambda spark, sf: _logged(spark, sf).rare_ids(),
    # subsets
    "combined_text": combined_text,
    "flag_column": flag_column,
    "sample_numbers": _sampled(lambda spark, sf: D.number_detector()),
    "sample_non_english": _sampled(lambda spark, sf: D.LanguageDetector(dictionary(spark, sf))),
    "sample_proper_nouns": _sampled(lambda spark, sf: D.EntityDetector()),
    "detection_stats": detection_stats,
    "run_report": run_figures,
    "detected_samples": detected_samples,
    # jobs and files
    "curate_cleaned": curated(_curated_records),
    "curate_subset": curated(_curated_subset),
    "curate_rejects": curated(_curated_rejects),
    "check_before_after": checked_table,
    "parquet_records": parquet_records,
    "json_array": json_array,
    "numbered_array": numbered_rows("json"),
    "numbered_lines": numbered_rows("jsonl"),
    "first_of_input": first_of_input,
    "report_fields": lambda spark, sf: field_figures(Cleaned(flagged(spark, sf)).report),
    "rejects_without_value": rejects_without("value"),
    "rejects_without_category": rejects_without("category"),
    "missing_columns": missing_columns,
    "unknown_field": unknown_field,
    "low_retention": low_retention,
    "checked_records": checked_records,
    "curate_report": curated(_curated_report),
    "curate_totals": curated(_curated_frame("totals", ["processed_records", "valid_records", "removed_count", "removal_rate"])),
    "curate_proper_nouns": curated_by_all,
    "gazetteer_mentions": gazetteer_mentions,
    "number_lists": number_lists,
}

QUERIES |= models.QUERIES

for _name in DOUBLES:
    QUERIES[_name] = _rounded(QUERIES[_name])
