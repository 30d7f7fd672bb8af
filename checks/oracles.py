r"""DuckDB SQL for the registered queries.

RE2 has no look-around and an ASCII-only ``\b``, so word tests are phrased over
word tokens here instead of repeating the library's patterns.
"""

from __future__ import annotations

from checks import model_oracles
from checks.queries import DICTIONARY_RECORDS, DOUBLES, RECORDS_SQL, SAMPLE_SIZE
from checks.sql_words import CHUNK as _CHUNK
from checks.sql_words import tokens_of, uncontracted
from gleanery.functions.patterns import DIGIT

# Word rules of the contract, written out here so that a slip in the library shows.
ARTIFACTS = "gon na wan ta ok okay yeah yep nope hmm".split()
ENDINGS = [e.split(":") for e in "s: es: ies:y ed: ed:e ied:y ing: ing:e er: er:e ier:y est: est:e iest:y ly: ly:le ily:y".split()]
DOUBLING = "ed ing er est".split()
SHORTEST_STEM = 2

WS = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sub(x: str, pattern: str, by: str) -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(by)}, 'g')"


def strip(x: str) -> str:
    return sub(x, f"^{WS}+|{WS}+$", "")


def squeeze(x: str) -> str:
    return f"trim({sub(x, WS + '+', ' ')})"


def untag(x: str) -> str:
    for pattern in (r"(?is)<script[^>]*>.*?</script\s*>", r"(?is)<style[^>]*>.*?</style\s*>", r"(?s)<!--.*?-->", "<[^>]+>"):
        x = sub(x, pattern, " ")
    return strip(x)


def decode(x: str) -> str:
    # The closing semicolon of these old names may be missing.
    for name, char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("amp", "&")):
        x = sub(x, f"&{name};?", char)
    return x


def unescape(x: str) -> str:
    x = f"""replace(replace({x}, '\\"', '"'), '\\''', '''')"""
    return sub(x, r"""\\(['"])""", r"\1")


MARKERS = r"(?i)\b(?:audio|video|seen here|heard here|daily double|dd)\b"


def straighten(x: str) -> str:
    return sub(sub(x, "[‘’‚‛′‵]", "'"), "[–—―]", "-")


def clean(x: str, kind: str) -> str:
    x = f"coalesce({x}, '')"
    has_tags = f"contains({x}, '<') and contains({x}, '>')"
    tagless = decode(untag(x)) if kind in ("question", "answer") else sub(x, "<[^>]+>", "")
    x = unescape(decode(f"case when {has_tags} then {tagless} else {x} end"))
    if kind == "question":
        x = sub(sub(x, MARKERS, ""), "_+", "[BLANK]")
    if kind in ("question", "answer"):
        x = sub(x, "https?://[a-z!$-_]+", "[LINK]")
    if kind == "category":
        x = f"upper({sub(x, r'\[[^\n\]]*\]|\([^\n)]*\)', '')})"
    x = sub(straighten(x), r"[.!?]+([.!?])", r"\1")
    return squeeze(sub(x, r"&[#\p{L}\p{N}_]+;", ""))


RAW = RECORDS_SQL.format(documents="documents")
NORM = f"""
select record_id, nullif({strip("coalesce(category, 'None')")}, '') as category, coalesce(value, 'None') as value,
 nullif({strip('question')}, '') as question, nullif({strip('answer')}, '') as answer, round,
 coalesce(show_number, 'None') as show_number, coalesce(air_date, 'None') as air_date
from raw where question is not null and answer is not null"""

ROUNDS = ["Jeopardy!", "Double Jeopardy!", "Final Jeopardy!", "Tiebreaker"]
ROUND_LIST = ", ".join(q(r) for r in ROUNDS)
PLAIN = {
    "category": "case when category is null then 'category field is missing' end",
    "air_date": "case when trim(air_date) = '' then 'air_date is empty' end",
    "value": f"""case when value <> 'None' and not regexp_full_match(value, {q(rf'\$,*{DIGIT}[0-9,]*')})
        then 'Invalid value format: "' || value || '" (expected $<number> or "None")' end""",
    "round": f"""case when round is null then 'round field is missing' when round not in ({ROUND_LIST})
        then 'Invalid round: "' || round || {q(f'" (must be one of: {ROUNDS})')} end""",
    "show_number": f"""case when not regexp_full_match(show_number, {q(DIGIT + '+')})
        then 'Show number must be a number: "' || show_number || '"' end""",
}
META = "concat_ws('; ', " + ", ".join(f"'{f}: ' || {e}" for f, e in PLAIN.items()) + ")"
TEXT_PLAIN = {
    "question": "case when qc = '' then 'Empty after cleaning' when length(qc) < 2 then 'Too short after cleaning' end",
    "answer": "case when ac = '' then 'Empty after cleaning' end",
}
TEXT = "concat_ws('; ', " + ", ".join(f"'{f}: ' || {e}" for f, e in TEXT_PLAIN.items()) + ")"

BASE = f"""raw as ({RAW}),
norm as ({NORM}),
judged as materialized (select *, {META} as meta from norm),
washed as materialized (select *, case when meta = '' then {clean('question', 'question')} end as qc,
  case when meta = '' then {clean('answer', 'answer')} end as ac from judged),
flagged as materialized (select *, case when meta = '' then {TEXT} else '' end as txt from washed),
clean as materialized (select record_id, category, value, qc as question, ac as answer, round, show_number, air_date
  from flagged where meta = '' and txt = '')"""


def over_records(sql: str) -> str:
    return f"with {BASE}\n{sql}"


def page(expr: str) -> str:
    return f"select page_id as record_id, {expr} as out from pages"


def field(expr: str) -> str:
    return f"with raw as ({RAW}) select record_id, {expr} as out from raw"


def document(expr: str) -> str:
    return f"select doc_id as record_id, {expr} as out from documents"


ORACLES: dict[str, str] = {
    "html_to_text": page(squeeze(decode(untag("html")))),
    "strip_tags": page(sub("html", "<[^>]+>", "")),
    "decode_entities": page(decode("html")),
    "drop_references": page(sub("html", r"&[#\p{L}\p{N}_]+;", "")),
    "link_blank_markers": field(sub(sub("question", "_+", "[BLANK]"), "https?://[a-z!$-_]+", "[LINK]")),
    "drop_markers": field(sub("question", MARKERS, "")),
    "straighten": field(straighten("answer")),
    "straighten_quotes": field("""replace(replace(answer, '“', '"'), '”', '"')"""),
    "unescape_quotes": page("html"),
    "drop_bracketed": field(sub("category", r"\[[^\n\]]*\]|\([^\n)]*\)", "")),
    "collapse_punctuation": document(sub("text", r"[.!?]+([.!?])", r"\1")),
    "squeeze_space": document(squeeze("text")),
    "clean_question": field(clean("question", "question")),
    "clean_answer": field(clean("answer", "answer")),
    "clean_category": field(clean("category", "category")),
    "clean_general": document(clean("text", "general")),
    "cleaning_preview": over_records(
        "select *, original is distinct from cleaned as changed from ("
        + " union all ".join(
            f"select record_id, '{f}' as field, {f} as original, {clean(f, f)} as cleaned from norm"
            for f in ("question", "answer", "category")
        )
        + ")"
    ),
    "load_normalise": over_records("select * from norm"),
    "load_counts": over_records("""select count(*) as loaded,
        count(*) filter (question is not null and answer is not null) as kept,
        count(*) filter (question is null or answer is null) as removed from raw"""),
    "null_profile": over_records(
        " union all ".join(
            f"""select '{c}' as "column", count(*) filter ({c} is null) as null_count,
            count(*) filter ({c} is null) * 100 / count(*)::double as null_pct from norm"""
            for c in ("category", "value", "question", "answer", "round", "show_number", "air_date")
        )
    ),
    "first_rows": over_records(f"select * from raw order by record_id limit {SAMPLE_SIZE}"),
    "json_round_trip": over_records("select * from clean"),
    "word_list": r"select distinct lower(unnest(string_split_regex(text, '[^\p{L}]+'))) as word from documents",
    "validate_metadata": over_records("select record_id, meta = '' as valid, meta as errors from judged"),
    "validate_text": over_records(
        "select record_id, qc as question_clean, ac as answer_clean, txt as errors from flagged where meta = ''"
    ),
    "accepted": over_records("select * from clean"),
    "rejects": over_records("""select record_id,
        case when meta <> '' then 'metadata' else 'text' end as stage,
        case when meta <> '' then 'Invalid metadata fields' else 'Invalid text fields after cleaning' end as reason,
        case when meta <> '' then meta else txt end as errors,
        substring(coalesce(category, '<NA>'), 1, 50) as category,
        case when meta <> '' then value end as value,
        case when meta <> '' then coalesce(round, 'None') end as round,
        case when meta <> '' then show_number end as show_number,
        case when meta = '' then substring(qc, 1, 50) end as question_cleaned,
        case when meta = '' then substring(ac, 1, 50) end as answer_cleaned
        from flagged where meta <> '' or txt <> ''"""),
    "reject_examples": over_records("""select record_id, reason, rank::int as rank,
        array_to_string(string_split(errors, '; ')[1:2], '; ') as errors from (
          select *, row_number() over (partition by reason order by record_id) as rank from (
            select record_id, case when meta <> '' then 'Invalid metadata fields'
              else 'Invalid text fields after cleaning' end as reason,
              case when meta <> '' then meta else txt end as errors
            from flagged where meta <> '' or txt <> '')) where rank <= 3"""),
    "field_stats": over_records(
        "select *, total_records - non_empty_records as empty_records, total_records - error_records as valid_records,"
        " error_records * 100.0::double / total_records as error_rate from ("
        + " union all ".join(
            f"""select '{f}' as field, '{kind}' as validation_type, count(*) as total_records,
            count({f}) as non_empty_records, count(*) filter ({test}) as error_records from flagged"""
            for f, kind, test in [(f, "strict_metadata", f"({e}) is not null") for f, e in PLAIN.items()]
            + [(f, "cleaned_text", f"meta = '' and ({e}) is not null") for f, e in TEXT_PLAIN.items()]
        )
        + ")"
    ),
    "cleaning_summary": over_records(
        " union all ".join(
            f"""select '{f}' as field, avg(length(coalesce({f}, ''))) as original_avg_length,
            avg(length({c})) as cleaned_avg_length, avg(length(coalesce({f}, '')) - length({c})) as avg_reduction,
            count(*) filter (length({c}) = 0) as empty_after_cleaning,
            count(*) filter (length(coalesce({f}, '')) - length({c}) > 20) as significantly_reduced
            from flagged where meta = ''"""
            for f, c in (("question", "qc"), ("answer", "ac"))
        )
    ),
    "totals": over_records("""select count(*) as processed_records,
        count(*) filter (meta = '' and txt = '') as valid_records,
        count(*) filter (meta <> '' or txt <> '') as removed_count,
        count(*) filter (meta <> '' or txt <> '') * 100.0::double / count(*) as removal_rate from flagged"""),
    "summary": over_records("""select count(*) as total_records,
        'category, value, question, answer, round, show_number, air_date' as columns,
        min(air_date) as earliest, max(air_date) as latest, count(distinct category) as unique_categories,
        round(avg(length(question)), 1) as avg_question_length, round(avg(length(answer)), 1) as avg_answer_length
        from norm"""),
    "date_range": over_records("select min(air_date) as earliest, max(air_date) as latest from norm"),
    "round_distribution": over_records("select round, count(*) as records from norm where round is not null group by 1"),
    "distinct_categories": over_records("select count(distinct category) as unique_count from norm"),
    "top_categories": over_records("""select category, count(*) as records from norm where category is not null
        group by 1 order by 2 desc, 1 limit 5"""),
    "text_lengths": over_records("""select round(avg(length(question)), 1) as avg_question_length,
        round(avg(length(answer)), 1) as avg_answer_length from norm"""),
    "first_record": over_records("select * from norm order by record_id limit 1"),
}


def shown(x: str) -> str:
    return f"substring(coalesce({x}, 'None'), 1, 50)"


_DEBUG = [
    f"select record_id, '{f}' as field, 'metadata' as field_type, {shown(f)} as value, null as cleaned, {e} as errors"
    " from norm"
    for f, e in PLAIN.items()
] + [
    f"select record_id, '{f}' as field, 'text' as field_type, {shown(f)} as value, {shown(c)} as cleaned, {e} as errors"
    f" from (select *, {clean('question', 'question')} as qc, {clean('answer', 'answer')} as ac from norm)"
    for (f, e), c in zip(TEXT_PLAIN.items(), ("qc", "ac"), strict=True)
]
ORACLES["validation_debug"] = over_records(f"""select record_id,
    bool_and(errors is null) over (partition by record_id) as overall_valid,
    coalesce(bool_and(errors is null) filter (field_type = 'metadata') over (partition by record_id), true) as metadata_valid,
    coalesce(bool_and(errors is null) filter (field_type = 'text') over (partition by record_id), true) as text_valid,
    field, field_type, value, cleaned, errors is null as valid, coalesce(errors, '') as errors, '' as warnings
    from ({' union all '.join(_DEBUG)})""")

_CUTS = {"category": 100, "question": 200, "answer": 100, "value": 1000, "round": 1000}
ORACLES["before_after"] = over_records(
    "select n.record_id as record_index, "
    + ", ".join(
        f"substring(coalesce(n.{c}, 'None'), 1, {k}) as original_{c}, case when c.record_id is null then 'REMOVED'"
        f" else substring(coalesce(c.{c}, 'None'), 1, {k}) end as cleaned_{c}"
        for c, k in _CUTS.items()
    )
    + " from norm n left join clean c using (record_id)"
)

# ------------------------------------------------------------- numbers

CARDINALS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen"
    " eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion trillion"
).split()
ORDINALS = (
    "first second third fourth fifth sixth seventh eighth ninth tenth eleventh twelfth thirteenth fourteenth fifteenth"
    " sixteenth seventeenth eighteenth nineteenth twentieth thirtieth fortieth fiftieth sixtieth seventieth eightieth"
    " ninetieth hundredth thousandth millionth billionth"
).split()
BASIC = [w for w in CARDINALS if w not in ("zero", "trillion")] + ORDINALS[:10]


def any_token(test: str, text: str = "text") -> str:
    return rf"len(list_filter(regexp_extract_all(lower({text}), '[\p{{L}}\p{{N}}_]+'), lambda t: {test})) > 0"


def listed(words: list[str]) -> str:
    return f"t in ({', '.join(q(w) for w in words)})"


ROMAN = "regexp_full_match(t, '[mdclxvi]+')"
CANONICAL = "M{0,3}(CM|CD|D?C{0,3})(XC|XL|L?X{0,3})(IX|IV|V?I{0,3})"
NUMBER = rf"{ROMAN} or regexp_full_match(t, '\p{{Nd}}+(s|st|nd|rd|th|am|pm)?') or {listed(CARDINALS + ORDINALS)}"
ORACLES |= {
    "any_digit": document(f"regexp_matches(text, {q(DIGIT)})"),
    "number_regex": document(
        any_token(rf"{ROMAN} or regexp_full_match(t, '\p{{Nd}}+') or {listed(BASIC)}")
        + r" or regexp_matches(text, '\$[\p{Nd},]')"
    ),
    "roman": document(any_token(ROMAN)),
    "roman_strict": document(
        r"len(list_filter(regexp_extract_all(text, '[\p{L}\p{N}_]+'),"
        f" lambda t: regexp_full_match(t, '{CANONICAL}'))) > 0"
    ),
    "numbers_detect": document(any_token(NUMBER)),
}

# Tokens with offsets: the text is cut into word and non-word pieces, their lengths are summed up.
PIECES = r"""pieces as materialized (
  select record_id, i, piece, sum(length(piece)) over (partition by record_id order by i) - length(piece) as start
  from (select doc_id as record_id, unnest(l) as piece, unnest(range(1, len(l) + 1)) as i
        from (select doc_id, regexp_extract_all(text, '{pattern}') as l from documents)))"""
_SPAN = r"[$€£¥]?\b\p{Nd}+(?:[.,]\p{Nd}+)*(?:(?i:s|st|nd|rd|th|am|pm)\b|\b)%?"
_MENTIONS = f"""with {PIECES.format(pattern=r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+")},
found as (select doc_id as record_id, string_split_regex(text, {q(_SPAN)}) as gaps,
    regexp_extract_all(text, {q(_SPAN)}) as hits from documents),
digits as (select record_id, hits[i] as mention,
    list_sum(list_transform(gaps[1:i], lambda x: length(x)))
      + coalesce(list_sum(list_transform(hits[1:i-1], lambda x: length(x))), 0) as start
    from found, unnest(range(1, len(hits) + 1)) as u(i)),
tokens as (
  select record_id, mention, start from digits
  union all
  select record_id, piece, start from pieces where lower(piece) in ({', '.join(q(w) for w in CARDINALS + ORDINALS)}))
select record_id, 'token' as kind,
  case when regexp_matches(mention, '^[$€£¥]') then 'MONEY' when mention like '%\\%' escape '\\' then 'PERCENT'
    when regexp_matches(lower(mention), '\\p{{Nd}}(st|nd|rd|th)$')
      or lower(mention) in ({', '.join(q(w) for w in ORDINALS)}) then 'ORDINAL'
    when regexp_matches(lower(mention), '^[12][0-9]{{3}}s?$') then 'DATE' else 'CARDINAL' end as label,
  mention, start::int as start, (start + length(mention))::int as end from tokens
union all
select record_id, 'roman', 'ROMAN', piece, start::int, (start + length(piece))::int
from pieces where regexp_full_match(piece, '(?i)[mdclxvi]+')"""
ORACLES["number_mentions"] = _MENTIONS
ORACLES["number_details"] = f"""select doc_id as record_id, count(*) filter (kind = 'token') as number_tokens,
    count(*) filter (kind = 'roman') as roman_numerals, count(kind) as total_numbers_found
    from documents left join ({_MENTIONS}) on doc_id = record_id group by 1"""

# ------------------------------------------------------------ language

NON_ASCII = "[à-ÿÀ-ßĀ-žА-я]"

TOKENS = f"""tokens as materialized (
  select record_id, i, start, {uncontracted('piece')} as token from pieces
  where regexp_full_match({uncontracted('piece')}, '\\p{{L}}+'))"""


DOCS = "docs as (select doc_id as record_id, text, lang from documents)"
DICT = f"""dict as materialized (select lower(token) as word, count(distinct record_id) as records
  from ({tokens_of("(select * from docs where lang = 'en')")}) group by 1 having count(distinct record_id) >= {DICTIONARY_RECORDS})"""


def vocab_of(tokens: str) -> str:
    return f"""select lower(token) as word, count(distinct (record_id, token)) as n,
      count(distinct (record_id, token)) filter (not regexp_matches(token, '^\\p{{Lu}}')) < 0.1::double * count(distinct (record_id, token))
        as capitalised from {tokens} group by 1"""


_STEM = SHORTEST_STEM
FORMS = " union ".join(
    ["select word, word as form from vocab"]
    + [
        f"select word, substring(word, 1, length(word) - {len(e)}) || '{r}' from vocab"
        f" where suffix(word, '{e}') and length(word) >= {len(e) + _STEM}"
        for e, r in ENDINGS
    ]
    + [
        f"select word, substring(word, 1, length(word) - {len(e) + 1}) from vocab where suffix(word, '{e}')"
        f" and length(word) > {len(e) + _STEM} and substring(word, length(word) - {len(e)}, 1) not in"
        f" ('a','e','i','o','u') and substring(word, length(word) - {len(e)}, 1)"
        f" = substring(word, length(word) - {len(e) + 1}, 1)"
        for e in DOUBLING
    ]
)


def unknown(strict: bool = True) -> str:
    rule = f"and length(word) > 2 and word not in ({', '.join(q(a) for a in ARTIFACTS)})" if strict else ""
    return f"""unknown as materialized (select word, n from vocab where not capitalised {rule}
      and word not in (select f.word from forms f join dict d on f.form = d.word))"""


LANGUAGE = f"""with {DOCS},
{PIECES.format(pattern=_CHUNK + r"|[^\p{L}\p{M}\p{N}_]")},
{TOKENS},
{DICT},
vocab as materialized ({vocab_of('tokens')}),
forms as materialized ({FORMS}),
{unknown()}
"""
_FOUND = """select t.record_id, t.token, lower(t.token) as word, t.start::int as start,
    (t.start + length(t.token))::int as end from tokens t join unknown u on lower(t.token) = u.word"""
ORACLES |= {
    "non_ascii": document(f"regexp_matches(text, '{NON_ASCII}')"),
    "dictionary_build": LANGUAGE + "select word, records from dict",
    "vocabulary": LANGUAGE + "select * from vocab",
    "base_forms": LANGUAGE + "select * from forms",
    "unknown_words": LANGUAGE + "select * from unknown",
    "non_english_detect": LANGUAGE
    + f"""select record_id from docs where regexp_matches(text, '{NON_ASCII}')
      or record_id in (select t.record_id from tokens t join unknown u on lower(t.token) = u.word)""",
    "non_english_words": LANGUAGE + _FOUND,
    "non_english_details": LANGUAGE
    + f"""select d.record_id, coalesce(string_agg(token, ' ' order by start), '') as words,
      array_to_string(list_sort(list_distinct(regexp_extract_all(any_value(text), '{NON_ASCII}'))), '') as chars
      from docs d left join ({_FOUND}) f on f.record_id = d.record_id group by 1""",
    "phrase_check": f"""with {DOCS},
      turns as (select conv_id * 4294967296 + turn as record_id, text from conversations),
      {DICT},
      tokens as materialized ({tokens_of('turns')}),
      vocab as materialized ({vocab_of('tokens')}),
      forms as materialized ({FORMS}),
      {unknown(strict=False)}
      select p.record_id, coalesce(string_agg(token, ' ' order by i), '') as words
      from turns p left join (select t.* from tokens t join unknown u on lower(t.token) = u.word) f
        on f.record_id = p.record_id group by 1""",
}

# ------------------------------------------------------------ entities

_NAME = r"\p{Lu}[\p{L}''’-]+"
_RUN = rf"(?:[.!?]\s+|[\p{{L}}\p{{N}}_])?{_NAME}(?: {_NAME})*"


def entities_of(table: str) -> str:
    """CTEs mentions, dropped words and frequencies over a table (record_id, text)."""
    return f"""runs as (select record_id, unnest(regexp_extract_all('. ' || text, '{_RUN}')) as run from {table}),
    split as (select record_id, regexp_matches(run, '^[.!?]') as opens, regexp_replace(run, '^[.!?]\\s+', '') as body
      from runs where regexp_matches(run, '^(?:[.!?]|\\p{{Lu}})')),
    names as materialized (select record_id, opens and not contains(body, ' ') as initial,
      regexp_replace(body, '(?:[''’]s)?[''’-]*$', '') as mention from split),
    lowers as (select word, count(distinct record_id) as lower from (
      select record_id, unnest(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_''’-]+')) as word from {table})
      where regexp_matches(word, '^\\p{{Ll}}') group by 1),
    ordinary as materialized (select entity from lowers join (
      select lower(mention) as entity, count(*) as n from names where length(mention) > 1 group by 1) on entity = word
      where lower >= 0.1::double * (lower + n)),
    mentions as materialized (select record_id, mention, lower(mention) as entity,
      initial and lower(mention) in (select entity from ordinary) as dropped from names where length(mention) > 1),
    freqs as materialized (select entity, count(*) as freq from mentions where not dropped group by 1)"""


ENTITIES = f"with {DOCS}, {entities_of('docs')}\n"
_BANDED = """banded as (select *, case when freq = 1 then 'very_rare' when freq <= 3 then 'rare'
    when freq <= 10 then 'uncommon' else 'common' end as band from freqs)"""
_POSITIONS = """pairs as (select record_id, entity, freq, length(text) as text_length, string_split(text, entity) as gaps
      from (select record_id, lower(text) as text from docs) join freqs on freq <= 3 and contains(text, entity))"""
ORACLES |= {
    "entity_mentions": ENTITIES + "select * from mentions",
    "entity_frequency": ENTITIES + "select * from freqs",
    "rare_entities": ENTITIES + "select * from freqs where freq <= 3",
    "frequency_totals": ENTITIES
    + """select count(*) as total_unique_entities, count(*) filter (freq <= 3) as unusual_entities_count,
      count(*) filter (freq <= 3) * 100.0::double / count(*) as unusual_pct from freqs""",
    "frequency_bands": ENTITIES
    + f""", {_BANDED} select band, count(*) as entities,
      count(*) * 100.0::double / sum(count(*)) over () as percentage from banded group by 1""",
    "band_examples": ENTITIES
    + f""", {_BANDED} select entity, freq, band, rank::int as rank from (
      select *, row_number() over (partition by band order by entity) as rank from banded) where rank <= 10""",
    "top_entities": ENTITIES + "select * from freqs order by freq desc, entity limit 20",
    "rare_sample": ENTITIES + "select * from freqs where freq <= 3 order by entity limit 20",
    "rare_detect": ENTITIES
    + """select record_id from docs d
      where exists (select 1 from freqs f where f.freq <= 3 and contains(lower(d.text), f.entity))""",
    "rare_details": ENTITIES
    + f""", {_POSITIONS} select record_id, entity, freq,
      array_to_string(list_transform(range(1, len(gaps)), lambda i:
        list_sum(list_transform(gaps[1:i], lambda x: length(x))) + (i - 1) * length(entity)), ',') as positions,
      count(*) over (partition by record_id) as unusual_count, text_length from pairs""",
}

# ------------------------------------------------------------- subsets

SUBSETS = f"""with {BASE},
{DOCS},
three as (select record_id, concat_ws(' ', question, answer, category) as text from clean),
two as materialized (select record_id, concat_ws(' ', question, answer) as text from clean),
numbers as (select record_id from three where {any_token(NUMBER)}),
{DICT},
tokens as materialized ({tokens_of('two')}),
vocab as materialized ({vocab_of('tokens')}),
forms as materialized ({FORMS}),
{unknown()},
non_english as materialized (select record_id from two where regexp_matches(text, '{NON_ASCII}')
  or record_id in (select t.record_id from tokens t join unknown u on lower(t.token) = u.word)),
{entities_of('two')},
proper_nouns as materialized (select record_id from two d
  where exists (select 1 from freqs f where f.freq <= 3 and contains(lower(d.text), f.entity)))
"""


def sampled(name: str) -> str:
    return f"""{SUBSETS} select c.* from clean c join {name} using (record_id)
      order by md5('42:' || record_id), record_id limit {SAMPLE_SIZE}"""


def stats(name: str) -> str:
    return f"""select '{name}' as name, (select count(*) from clean) as total_records, count(*) as detected_records,
      count(*) * 100.0::double / (select count(*) from clean) as detection_rate,
      least({SAMPLE_SIZE}, count(*)) as subset_size,
      least({SAMPLE_SIZE}, count(*)) / greatest(1, count(*))::double as sampling_ratio from {name}"""


_NAMES = ("numbers", "non_english", "proper_nouns")


def metric(section: str, name: str, value: str) -> str:
    return f"select '{section}' as section, '{name}' as metric, ({value})::double as value"


def first_two(name: str, found: str) -> str:
    """The first two sampled records of a subset with what ``found`` (record_id, rank, token) lists first."""
    return f"""select c.record_id, '{name}' as subset, any_value(c.category) as category,
        any_value(substring(c.question, 1, 80)) as question, any_value(c.answer) as answer,
        coalesce(array_to_string(list(f.token order by f.rank) filter (f.token is not null)[1:3], '; '), '') as detected
      from (select * from (select c.* from clean c join {name} using (record_id)
              order by md5('42:' || record_id), record_id limit {SAMPLE_SIZE}) order by record_id limit 2) c
      left join ({found}) f on f.record_id = c.record_id group by 1"""


_NUMBERS_FOUND = f"""select record_id, start as rank, mention as token
    from ({_MENTIONS.replace('from documents', 'from (select record_id as doc_id, text from two)')}) where kind = 'token'"""
_WORDS_FOUND = "select t.record_id, t.i as rank, t.token from tokens t join unknown u on lower(t.token) = u.word"
_NAMES_FOUND = """select d.record_id, f.entity as rank, f.entity as token
    from two d join freqs f on f.freq <= 3 and contains(lower(d.text), f.entity)"""
_REMOVED = "count(*) filter (meta <> '' or txt <> '')"
ORACLES |= {
    "combined_text": SUBSETS + "select * from three",
    "flag_column": SUBSETS
    + "select record_id, record_id in (select record_id from numbers) as has_numbers from clean",
    **{f"sample_{n}": sampled(n) for n in _NAMES},
    "detection_stats": SUBSETS + " union all ".join(stats(n) for n in _NAMES),
    "run_report": SUBSETS
    + " union all ".join(
        [
            metric("generation", "original_records", "select count(*) from norm"),
            metric("generation", "cleaned_records", "select count(*) from clean"),
            metric("cleaning", "records_removed", f"select {_REMOVED} from flagged"),
            metric(
                "cleaning",
                "removal_rate_percent",
                f"select round({_REMOVED} * 100.0::double / count(*), 2) from flagged",
            ),
            metric("proper_nouns", "total_entities_analyzed", "select count(*) from freqs"),
            metric("proper_nouns", "unusual_entities_found", "select count(*) from freqs where freq <= 3"),
        ]
        + [
            m
            for n in _NAMES
            for m in (
                metric(n, "candidates_found", f"select count(*) from {n}"),
                metric(
                    n,
                    "detection_rate",
                    f"select round(count(*) * 100.0::double / (select count(*) from clean), 2) from {n}",
                ),
                metric(n, "subset_size", f"select least({SAMPLE_SIZE}, count(*)) from {n}"),
            )
        ]
    ),
}

ORACLES["detected_samples"] = SUBSETS + " union all ".join(
    f"select * from ({first_two(n, f)})"
    for n, f in zip(_NAMES, (_NUMBERS_FOUND, _WORDS_FOUND, _NAMES_FOUND), strict=True)
)

# Keyless records are numbered from 0 in the order in which they were written.
NUMBERED = "select * replace (row_number() over (order by record_id) - 1 as record_id) from raw"

ORACLES |= {
    "number_function": ORACLES["number_mentions"],
    "sketched_categories": over_records("select 'category' as column, count(distinct category) as unique_count, true as within from norm"),
    "logged_frequency": ORACLES["entity_frequency"],
    "logged_rare": ORACLES["rare_detect"],
    "curate_cleaned": ORACLES["accepted"],
    "curate_subset": f"select * exclude (record_id) from ({ORACLES['sample_numbers']})",
    "curate_rejects": f"select record_id, stage, reason, errors from ({ORACLES['rejects']})",
    "check_before_after": over_records("""select n.record_id as record_index, coalesce(n.round, 'None') as original_round,
      case when c.record_id is null then 'REMOVED' else coalesce(c.round, 'None') end as cleaned_round
      from (select * from norm order by record_id limit 10) n left join clean c using (record_id)"""),
    "parquet_records": over_records("select * from raw"),
    "json_array": over_records("select * from raw"),
    "numbered_array": over_records(NUMBERED),
    "numbered_lines": over_records(NUMBERED),
    "first_of_input": over_records(f"select * from ({NUMBERED}) where record_id < {SAMPLE_SIZE}"),
    "report_fields": " union all ".join(
        f"""select '{t}' as section, field || '.' || metric as metric, value from (
          unpivot (select field, try_cast(columns(* exclude field) as double) from ({ORACLES[t]})) on columns(* exclude field) into name metric value value)"""
        for t in ("field_stats", "cleaning_summary")
    ),
    "rejects_without_category": over_records("select record_id, 'metadata' as stage, 'N/A' as shown from norm"),
    "missing_columns": "select 'Missing required columns: [''value'', ''air_date'']' as message",
    "unknown_field": """select doc_id as record_id, lang is not null as valid, case when lang is null then 'lang field is missing' else '' end as errors,
      'Unknown metadata field: lang' as warnings from documents""",
    "low_retention": over_records("""select r as rows, kept < 0.5 * whole as low, case when kept < 0.5 * whole then 35 else 0 end::bigint as shown from (
      select 'given' as r, (select count(*) from clean) as kept, (select count(*) from norm) as whole
      union all select 'spoilt', (select count(*) from clean where record_id % 3 = 0), (select count(*) from norm))"""),
    "checked_records": over_records(f"select * from clean where record_id in (select record_id from raw order by record_id limit {SAMPLE_SIZE})"),
    "curate_totals": ORACLES["totals"],
    "curate_proper_nouns": f"select * exclude (record_id) from ({ORACLES['sample_proper_nouns']})",
    "gazetteer_mentions": ENTITIES + "select * from mentions where entity in (select entity from freqs where length(entity) % 2 = 0)",
    "number_lists": f"""select doc_id as record_id, coalesce(string_agg(mention, ' ' order by start) filter (kind = 'token'), '') as tokens,
      coalesce(string_agg(mention, ' ' order by start) filter (kind = 'roman'), '') as romans
      from documents left join ({_MENTIONS}) on doc_id = record_id group by 1""",
    "rejects_without_value": over_records("select record_id, 'metadata' as stage, 'N/A' as shown from norm"),
}

ORACLES["curate_report"] = f"""select * from ({ORACLES['run_report']}) where section in ('generation', 'cleaning', 'numbers')
  union all select * from ({ORACLES['report_fields']})"""

ORACLES |= model_oracles.ORACLES

for _name, _columns in DOUBLES.items():
    _rounding = ", ".join(f"round({c}, 6) as {c}" for c in _columns)
    ORACLES[_name] = f"select * replace ({_rounding}) from ({ORACLES[_name]})"
