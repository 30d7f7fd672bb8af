"""DuckDB SQL for the queries of ``checks.models``."""

from __future__ import annotations

from checks.models import FOLDS, HELD_OUT, INFLECTED_SQL, TAGGED_SQL, WORDS
from checks.sql_words import tokens_of

LABELS = ["GPE", "LOC", "O", "ORG", "PERSON", "PRODUCT", "WORK_OF_ART"]
LETTERS = "abcdefg"

_TAGGER = f"""
with recursive tagged as materialized (select record_id, string_split(tagged, ' ') as ws from ({TAGGED_SQL.replace(" as string)", " as varchar)")})),
each as (
  select record_id, i, split_part(w, '/', 1) as word, list_position({LABELS}, split_part(w, '/', 2)) as label,
    case when regexp_matches(w, '^[0-9]') then '<digits>' when regexp_matches(split_part(w, '/', 1), '^[A-Z].*[A-Z]') then '<capitals>'
      when regexp_matches(w, '^[A-Z]') then case when i = 1 then '<opening>' else '<name>' end
      when regexp_matches(w, '^[a-z]') then '<word>' else '<sign>' end as shape
  from (select record_id, unnest(ws) as w, unnest(range(1, len(ws) + 1)) as i from tagged)),
train as (select * from each where record_id % {FOLDS} <> 0),
often as (select word from train group by word having count(*) >= 2),
named as (select case when o.word is null then shape else t.word end as word, label from train t left join often o on t.word = o.word),
size as (select count(distinct word) + 1 as v from named),
totals as (select label, count(*) as n from train group by label),
counts as (select word, label, count(*) as n from named group by word, label),
costs as (
  select word, list(cast(floor(-1000 * ln((coalesce(n, 0) + 0.1) / (total + 0.1 * v))) as int) order by label) as costs
  from (
    select w.word, t.label, c.n, t.n as total, v from (select distinct word from named union all select '') w cross join totals t cross join size
    left join counts c on c.word = w.word and c.label = t.label)
  group by word),
followed as (
  select label, lag(label) over (partition by record_id order by i) as before from train),
moves as (
  select b.label as before, t.label, cast(floor(-1000 * ln((coalesce(f.n, 0) + 1.0) / (sum(coalesce(f.n, 0)) over (partition by b.label) + 7.0))) as int) as c
  from (select unnest(range(0, 8)) as label) b cross join totals t
  left join (select coalesce(before, 0) as before, label, count(*) as n from followed group by all) f on f.before = b.label and f.label = t.label),
following as (select list(row order by label) as following from (select label, list(c order by before) as row from moves where before > 0 group by label)),
first as (select list(c order by label) as first from moves where before = 0)
"""


def _cost(text: str, more: str) -> str:
    return f"lpad(cast(left({text}, 9)::int + {more} as varchar), 9, '0') || substr({text}, 10)"


_SENTENCES = (
    _TAGGER
    + f""",
test as (
  select record_id, i, label, coalesce(k.costs, s.costs, u.costs) as costs from each e
  left join costs k on k.word = e.word left join costs s on s.word = e.shape left join costs u on u.word = ''
  where record_id % {FOLDS} = 0),
ends as (
  select record_id, 1::bigint as i, list_transform(range(1, 8), lambda j: lpad(cast(first[j] + costs[j] as varchar), 9, '0') || '{LETTERS}'[j]) as best
  from test, first where i = 1
  union all
  select e.record_id, t.i, list_transform(range(1, 8), lambda j:
    {_cost(f"list_min(list_transform(range(1, 8), lambda b: {_cost('e.best[b]', 'f.following[j][b]')}))", "t.costs[j]")} || '{LETTERS}'[j])
  from ends e join test t on t.record_id = e.record_id and t.i = e.i + 1 cross join following f),
sentences as (
  select record_id, gold, substr(list_min(best), 10) as labels
  from ends join (select record_id, count(*) as n, string_agg('{LETTERS}'[label], '' order by i) as gold from test group by record_id) using (record_id)
  where i = n)
"""
)

_PAIRS = f"""
with words as (select distinct unnest(regexp_extract_all(coalesce(text, ''), '{WORDS}')) as word from documents where lang = 'en'),
pairs as materialized ({INFLECTED_SQL}),
taught as (
  select *, '^' || form as edged, list_max(list_filter(range(0, least(length(form), length(lemma)) + 1), lambda i: form[:i] = lemma[:i])) as kept
  from pairs where not ({HELD_OUT})),
cuts as (select edged, length(form) - kept as cut, substr(lemma, kept + 1) as ending from taught),
suffixes as (
  select distinct edged, right(edged, unnest(range(cut, least(cut + 4, length(edged)) + 1) || [length(edged)])) as suffix, cut, ending from cuts),
votes as (select suffix, cut, ending, count(*) as n from suffixes group by all),
rules as (
  select suffix, cut::int as cut, ending, n from (
    select *, row_number() over (partition by suffix order by n desc, cut, ending) as place, sum(n) over (partition by suffix) as forms from votes)
  where place = 1 and (forms >= 2 or suffix[1] = '^')),
forms as (select distinct form as word from pairs where {HELD_OUT}),
fits as (
  select word, cut, ending, length(suffix) as size from (
    select word, right('^' || word, unnest(range(0, length(word) + 2))) as suffix from forms) join rules using (suffix)),
found as (
  select word, coalesce(case when cut <= length(word) then nullif(left(word, length(word) - cut) || ending, '') end, word) as lemma
  from forms left join (select word, arg_max(cut, size) as cut, arg_max(ending, size) as ending from fits group by word) using (word))
"""

# Words of the language contract: runs of letters with nothing but a contraction's ending glued to them.
_SPELT = f"""select record_id as doc_id, lang, token
  from ({tokens_of("(select doc_id as record_id, text from documents)")}) join documents on doc_id = record_id"""


def _runs(words: str) -> str:
    return f"""select *, e as place, unnest(range(1, least(e, 3) + 1)) as n from (
      select *, unnest(range(2, length(word) + 3)) as e from {words})"""


_LETTERS = f"""
with spelt as materialized (select distinct doc_id, lang, lower(token) as word from ({_SPELT})),
"""


def _model(where: str) -> str:
    return f"""
counted as (
  select lang, substr('_' || word || '_', (e - n + 1)::bigint, n) as run, count(*) as n from (
    {_runs(f"(select distinct lang, word from spelt where {where})")}) group by all)"""


_LANGUAGES = (
    _LETTERS
    + _model(f"doc_id % {FOLDS} <> 0")
    + f""",
costs as (
  select run, lang, cast(floor(-1000 * ln(n / sum(n) over (partition by lang, left(run, length(run) - 1)))) as int) as cost from counted),
letters as (
  select word, e, n, lang, cost from (select *, substr('_' || word || '_', (e - n + 1)::bigint, n) as run from (
    {_runs(f"(select distinct word from spelt where doc_id % {FOLDS} = 0)")})) cross join (select distinct lang from costs) l
  left join costs using (run, lang)),
each as (
  select word, lang, e, arg_max(cost + (3 - n) * 1200, n) as seen from letters where cost is not null group by all),
whole as (
  select word, lang, sum(coalesce(seen - case when e = 2 then 1200 else 0 end, 9000)) as cost
  from (select distinct word, lang, e from letters) left join each using (word, lang, e) group by word, lang),
judged as (
  select word, arg_min(lang, cost * 1000 + k) as language,
    max(cost) filter (lang = 'en') - min(cost) >= 250 * (length(word) + 1) and min(cost) <= 3600 * (length(word) + 1) as foreign
  from (select *, dense_rank() over (order by lang) as k from whole) group by word)
"""
)

_SPELLINGS = f"""
with counts as materialized (select lower(token) as word, count(distinct doc_id) as records from ({_SPELT}) where lang = 'en' group by 1),
forms as (
  select distinct word, records, form from (
    select word, records, unnest([word] || list_transform(range(1, length(word) + 1), lambda i: word[:i - 1] || word[i + 1:])) as form
    from counts where length(word) >= 4)),
slips as (
  select word, arg_max(other, (more, other)) as meant from (
    select a.word, b.word as other, b.records as more from forms a join forms b using (form) where b.records >= 20 * a.records)
  group by word)
"""

ORACLES = {
    "lemma_rules": _PAIRS + "select * from rules",
    "lemmas_found": _PAIRS + "select * from found",
    "lemma_accuracy": _PAIRS
    + f"""select count(*) as forms, count(*) filter (p.lemma = f.lemma) as right from pairs p join found f on p.form = f.word where {HELD_OUT.replace("lemma", "p.lemma")}""",
    "letter_runs": _LETTERS + _model("true") + "select * from counted",
    "word_languages": _LANGUAGES + "select * from judged",
    "language_accuracy": _LANGUAGES
    + f"""select lang, language, count(*) as words, count(*) filter (judged.foreign) as foreign
      from (select distinct lang, word from spelt where doc_id % {FOLDS} = 0) join judged using (word) group by all""",
    "clean_dictionary": _SPELLINGS
    + """select * from counts where records >= 2 and records >= 0.0005 * (select count(*) from documents where lang = 'en')
      and word not in (select word from slips)""",
    "slips": _SPELLINGS + "select * from slips",
    "tag_words": _TAGGER + "select word, array_to_string(costs, ',') as costs from costs where word <> ''",
    "tag_sentences": _SENTENCES + "select * from sentences",
    "tag_accuracy": _SENTENCES
    + """select gold, count(*) as words, count(*) filter (gold = found) as right
      from (select unnest(string_split(gold, '')) as gold, unnest(string_split(labels, '')) as found from sentences) group by gold""",
}
