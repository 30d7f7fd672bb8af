"""Drop lines whose template recurs across documents.

Lines are parsed by a tree of fixed depth: their number of words, then their leading
words, with words that hold a digit replaced by ``<*>``. A leaf's template keeps the words
that most of its different lines have at a place, and a ``<*>`` elsewhere; a line that agrees
with it in few places is a template by itself. Lines of a template that occurs in several
documents are dropped, but for the first of these documents.

`A leaf has further templates for families of its other lines, which share enough words with each other. Lines of every
length count; the shorter a line is, the more documents it must be in, and more than chance gives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import bind, let
from gleanery.session import materialise

FIELD = "<*>"
DEPTH = 3
LEAST_WORDS = 6
LEAST_DOCS = 3
LEAST_ALIKE = 0.6

# Short lines must be in more documents than chance gives by so many times its spread.
SPREAD = 4

# Tasks that the lines of one template are dealt to when its documents are looked up.
PARTS = 32


def docs_for(n: Column) -> Column:
    """Documents that a template of ``n`` words must be in: two from 12 words on, three from 6, below twice as many for each word less."""
    return F.when(n >= 2 * LEAST_WORDS, 2).when(n >= LEAST_WORDS, LEAST_DOCS).otherwise(
        (F.lit(LEAST_DOCS) * F.pow(F.lit(2.0), F.lit(LEAST_WORDS) - n)).cast("int")
    )


_GAP = r"\x20\x09\x0B-\x0D"
# A word that holds a digit; matches begin at word starts only, so the search is linear.
_VARIABLE = rf"(?<![^\n{_GAP}])[^\n{_GAP}0-9]*+[0-9][^\n{_GAP}]*+"


# White space that is not a single blank already: most lines have none.
_WIDE = rf" [{_GAP}]+|[{_GAP}&&[^ ]][{_GAP}]*+"


def _masked(line: Column) -> Column:
    """A line with single spaces and without variable words; most lines are neither searched nor copied."""
    spaced = F.trim(F.regexp_replace(line, _WIDE, " "))
    return F.when(line.rlike("[0-9]"), F.regexp_replace(spaced, _VARIABLE, FIELD)).otherwise(spaced)


def _keys(line: Column) -> dict[str, Column]:
    """Number of words, leaf, and the line itself as two hashes, which together do not collide."""
    n = F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1
    return {
        "n": n,
        "leaf": F.xxhash64(n, F.substring_index(line, " ", DEPTH)),
        "t": F.xxhash64(line),
        "u": F.hash(line),
    }


def _lines(docs: DataFrame) -> DataFrame:
    """(h, g, doc_id, line_no, line): all lines but empty ones; h and g stand for id and text of the document."""
    lines = docs.select(
        F.xxhash64("doc_id", "text").alias("h"), F.hash("text", "doc_id").alias("g"), "doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line_no", "raw")
    )
    masked = bind(lines, line=_masked(F.col("raw"))).drop("raw")
    return bind(masked, **_keys(F.col("line"))).filter(F.col("line") != "")


def _families(lines: DataFrame, general: DataFrame, docs_of: DataFrame) -> DataFrame:
    """(t, u, template): the lines outside the template of their leaf that share enough words with others.

    The support of a word at a place of a leaf is the number of documents of the lines that have it there. A line's constant words
    have at least half the support that enough of its words for a template (``LEAST_ALIKE``) reach; its other words are fields.
    """
    named = lines.select("leaf", "line", F.xxhash64("line").alias("t"), F.hash("line").alias("u"))
    known = materialise(named.join(docs_of, ["t", "u"]))
    at = known.select("leaf", "docs", F.posexplode(F.split("line", " ")).alias("place", "word"))
    support = at.groupBy("leaf", "place", "word").agg(F.sum("docs").alias("support")).filter(F.col("support") >= LEAST_DOCS)
    rest = known.join(general, ["t", "u"], "left_anti")
    words = rest.select("t", "u", "leaf", F.size(F.split("line", " ")).alias("n"), F.posexplode(F.split("line", " ")).alias("place", "word"))
    held = words.join(support, ["leaf", "place", "word"])
    of_line = held.groupBy("t", "u", "leaf", "n").agg(F.collect_list(F.struct("place", "word", "support")).alias("held"))
    enough = F.ceil(LEAST_ALIKE * F.col("n")).cast("int")
    least = F.try_element_at(F.sort_array(F.col("held.support"), asc=False), enough)
    constant = bind(of_line.filter(F.size("held") >= enough), least=least)
    kept = F.filter("held", lambda h: h.support * 2 >= F.col("least"))
    places = F.array_sort(F.transform(kept, lambda h: F.struct(h.place, h.word)))
    return constant.select("t", "u", F.xxhash64("leaf", "n", places).alias("template"))


def _templates(table: DataFrame) -> DataFrame:
    """(t, u, template): the lines that belong to a template of their leaf, that of most of its lines or that of a family."""
    long = table.filter(F.col("n") >= LEAST_WORDS)  # of shorter ones the leading words alone would be a template
    forms = long.groupBy("leaf", "t", "u").agg(F.count("*").alias("n"))
    leaves = forms.groupBy("leaf").agg(F.sum("n").alias("n"), F.count("*").alias("forms"))
    # written, so that Spark knows its size when it chooses the join
    wide = materialise(leaves.filter((F.col("n") >= LEAST_DOCS) & (F.col("forms") > 1)).select("leaf", "forms"))
    lines = materialise(long.select("leaf", "line").join(wide, "leaf").distinct())
    at = lines.select("leaf", "forms", F.posexplode(F.split("line", " ")).alias("place", "word"))
    common = at.groupBy("leaf", "forms", "place", "word").agg(F.count("*").alias("n")).filter(F.col("n") * 2 > F.col("forms"))
    constant = common.groupBy("leaf").agg(F.map_from_entries(F.collect_list(F.struct("place", "word"))).alias("constant"))
    words = F.split("line", " ")
    template = F.transform(words, lambda _, i: F.coalesce(F.try_element_at("constant", i), F.lit(FIELD)))
    compared = lines.join(constant, "leaf").select("line", words.alias("words"), template.alias("template"))
    alike = F.size(F.filter(F.zip_with("words", "template", lambda w, t: w == t), lambda same: same))
    same = compared.filter(alike >= LEAST_ALIKE * F.size("words")).select(
        F.xxhash64("line").alias("t"), F.hash("line").alias("u"), F.xxhash64("template").alias("template")
    )
    general = materialise(same)
    docs_of = long.select("t", "u", "h", "g").distinct().groupBy("t", "u").agg(F.count("*").alias("docs"))
    return general.unionByName(_families(lines, general, docs_of))


def _by_chance(table: DataFrame, candidates: DataFrame) -> DataFrame:
    """(t, u, chance): how many of the short lines would be one of ``candidates`` (t, u) if their words came together by chance.

    Words are counted in the lines of the same length, for lines of one word in all short ones; the number of lines by length comes to the driver.
    """
    short = materialise(table.filter(F.col("n") < LEAST_WORDS).groupBy("t", "u", "n").agg(F.count("*").alias("uses"), F.min("line").alias("line")))
    lines = {r.n: r.uses for r in short.groupBy("n").agg(F.sum("uses").alias("uses")).collect()}
    within = {n: n * lines.get(n, 0) for n in range(1, LEAST_WORDS)}
    within[1] = sum(within.values())
    word = F.explode(F.split("line", " ")).alias("word")
    counts = short.select("n", word, "uses").groupBy("n", "word").agg(F.sum("uses").alias("uses"))
    alone = counts.groupBy(F.lit(1).alias("n"), "word").agg(F.sum("uses").alias("uses"))
    uses = counts.filter("n > 1").unionByName(alone)
    words = short.join(candidates, ["t", "u"], "left_semi").select("t", "u", "n", word)

    def by_length(values: dict[int, int]) -> Column:
        return F.element_at(F.array(*[F.lit(float(values.get(n, 0))) for n in range(1, LEAST_WORDS)]), F.col("n"))

    share = F.sum(F.ln(F.col("uses") / by_length(within)))
    return words.join(uses, ["n", "word"]).groupBy("t", "u", "n").agg(share.alias("share")).select("t", "u", (by_length(lines) * F.exp("share")).alias("chance"))


def recurring_lines(docs: DataFrame) -> DataFrame:
    """(h, g, gone): for each document that loses lines, by the hashes of its id and text, their numbers from 0."""
    table = materialise(_lines(docs), compression="zstd")
    template = F.when(F.col("template").isNull(), F.struct(F.col("t").alias("a"), F.col("u").alias("b"))).otherwise(
        F.struct(F.col("template").alias("a"), F.lit(0).alias("b"))
    )
    document = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h", "g")
    named = materialise(
        table.join(_templates(table), ["t", "u"], "left").select(
            "line_no", "n", document.alias("document"), template.alias("template")
        )
    )
    # counted per document first, so that a template of very many lines is combined in each task
    documents = named.select("template", "n", "document").distinct()
    frequent = materialise(
        documents.groupBy("template", "n")  # a template has lines of one length only
        .agg(F.count("*").alias("documents"), F.min("document").alias("first"))
        .filter(F.col("documents") >= docs_for(F.col("n")))
    )
    # a short line is its own template
    short = frequent.filter(F.col("n") < LEAST_WORDS).select(F.col("template.a").alias("t"), F.col("template.b").alias("u"), "template", "first", "documents")
    chance = _by_chance(table, short.select("t", "u"))
    beyond = F.col("documents") > F.col("chance") + SPREAD * F.sqrt("chance")
    recurring = frequent.filter(F.col("n") >= LEAST_WORDS).select("template", "first").union(short.join(chance, ["t", "u"]).filter(beyond).select("template", "first"))
    # lines of one template are dealt to several tasks by their document, as copies of its only row on the right
    parts = recurring.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    dealt = named.withColumn("part", F.pmod(F.xxhash64("document"), F.lit(PARTS)).cast("int"))
    gone = dealt.join(parts, ["template", "part"]).filter(F.col("document") != F.col("first"))
    h, g = F.col("document.h").alias("h"), F.col("document.g").alias("g")
    return gone.groupBy(h, g).agg(F.collect_set("line_no").alias("gone"))


def drop_recurring_lines(docs: DataFrame) -> DataFrame:
    """(row, text, n_lines, n_dropped) of each row of ``docs`` (doc_id, text): the row as it was, and its text without recurring lines.

    A line is dropped when its template occurs in enough documents (``docs_for``; one of fewer than six words also in more than
    chance gives) and this is not the first of them, by id (null last). Rows of the same id and text are one document and lose the same lines. A null text
    stays null; an empty table gives an empty result. Scratch tables are written when this is called. Texts are
    shuffled once, to meet the numbers of their dropped lines.
    """
    keyed = docs.select(F.struct("*").alias("row"), F.xxhash64("doc_id", "text").alias("h"), F.hash("text", "doc_id").alias("g"))
    joined = keyed.join(recurring_lines(docs), ["h", "g"], "left")
    lines = F.split("row.text", "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
    text = F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(
        F.array_join(let(lines, lambda ls: F.transform(kept, lambda i: ls[i])), "\n")
    )
    return joined.select(
        "row",
        text.alias("text"),
        F.coalesce(F.size(lines), F.lit(0)).alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).alias("n_dropped"),
    )
