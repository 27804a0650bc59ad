"""Quality rules by distribution divergence, in DataFrame functions alone.

Language references are gathered from all documents: for each language the
histogram of character classes, of each the share in the median document, so that
junk does not move it, and the histogram of its ``TOP`` most common words with all
others as one more cell.  A document is compared with the reference of its language
by the Jensen-Shannon divergence (bits, 0 to 1; the distance is its root) of both
histograms.  Short texts are guarded: a histogram of too few characters or words is
not judged at all, and above that the limit is raised by what chance alone gives a
sample of that size.  Before the method stand four plain
counts: characters in words, symbols, repeated lines, words in repeated windows.

References: words and steps of shares are counted per task before they move, and
the most common words picked per task before they are ranked, so a language of a
third of all rows sends no more than another.  What is broadcast is one row for each language, up to
``MOST_LANGUAGES`` of them; more are joined by a shuffle.  Judging is a
projection over whole texts, without a shuffle.

Windows are compared by XXH64 over those of their words: a text of a million words
has a false repeat with odds under one in ten million.

Defined results: null and empty texts have no words and fail; a language with
fewer than ``MIN_REFERENCE`` words in all, an unknown and a null one are
compared with the reference of all documents; ties among common words go to the
first in code-point order; a histogram that is not judged has a null divergence;
repeated rows each return; an empty table is empty; other columns may have any name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, if_small, let_go, named
from .fim import let

#: A word is what stands between blanks; common words are runs of letters, lower-cased.
WORD, LETTERS, SYMBOL = r"[^\x20\x09-\x0D]+", r"\p{L}+", "[#*$%&|<>]"
#: Character classes; whatever else stands in words is one more.
CLASSES = {"lower": "[a-z]", "upper": "[A-Z]", "digit": "[0-9]", "stop": "[.,;:!?'\"()-]", "symbol": SYMBOL, "wide": r"[^\x00-\x7F]"}
#: Words of a window, and base rules: fewest words, most of them in repeated windows (percent).
WINDOW, MIN_WORDS, MOST_REPEATED = 8, 20, 30
#: Common words of a reference, and words that a language needs for one of its own.
TOP, MIN_REFERENCE = 50, 10_000
#: Steps in which shares of character classes are counted for their medians.
STEPS = 2000
#: Guards: characters and words below which a histogram is not judged.
MIN_CLASS_CHARS, MIN_COMMON_WORDS = 200, 50
#: Divergences fail that exceed these by more than chance; characters come in runs, of which so many count as one.
CLASS_LIMIT, COMMON_LIMIT, RUN = 0.035, 0.05, 12
#: Languages whose references are broadcast at most.
MOST_LANGUAGES = 10_000


def _text(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def _matched(text: Column, pattern: str) -> Column:
    """Characters that a class matches."""
    return F.length(text) - F.length(F.regexp_replace(text, F.lit(pattern + "+"), F.lit("")))


def _common(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(LETTERS), F.lit(0))


def class_counts(text: Column, word_chars: Column) -> Column:
    """Characters of each class, those of no class last; lower-case letters, the bulk of a text, are taken out in one pass."""

    def counted(rest: Column) -> Column:
        others = [_matched(rest, p) for name, p in CLASSES.items() if name != "lower"]
        return let(F.array(word_chars.cast("int") - F.length(rest), *others), lambda c: F.array_append(c, word_chars.cast("int") - F.aggregate(c, F.lit(0), lambda a, x: a + x)))

    return let(F.regexp_replace(text, F.lit(r"[a-z\x20\x09-\x0D]+"), F.lit("")), counted)


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words that stand in windows found twice or more in the list, the first ones included."""

    def covered(h: Column) -> Column:
        """From the places of repeated windows in order: each covers its words, less those the next one covers."""
        same = lambda s, i, j: s[i]["h"] == s[j]["h"]
        again = lambda s: F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda j: F.when(j > 0, same(s, j, j - 1)).otherwise(False) | F.when(j < F.size(s) - 1, same(s, j, j + 1)).otherwise(False))
        places = let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), lambda s: F.sort_array(F.transform(again(s), lambda j: s[j]["i"])))
        return let(places, lambda p: window + F.aggregate(F.sequence(F.lit(1), F.size(p) - 1), F.lit(0), lambda a, k: a + F.least(F.lit(window), p[k] - p[k - 1])))

    of_words = F.transform(words, lambda w: F.xxhash64(w))
    hashes = let(of_words, lambda h: F.transform(F.sequence(F.lit(0), F.size(h) - window), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(window)])))
    some = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h)))
    return F.when(F.size(words) > window, some).otherwise(0)


#: Counts of the base.
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def base_counts(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words (long) of a text that is not null."""
    return let(all_counts(text), lambda c: F.struct(*[c[n].alias(n) for n in BASE]))


def all_counts(text: Column) -> Column:
    """The same with the classes' counts: symbols are one of them, so the text is not searched for symbols again."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
    dup = let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    of_words = let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: let(F.length(F.array_join(w, "")), lambda c: F.struct(F.size(w).alias("n"), c.alias("c"), class_counts(text, c).alias("k"), repeated_words(w).alias("r"))))
    return let(of_words, lambda w: F.struct(w["n"].cast("bigint").alias("n_words"), w["c"].cast("bigint").alias("word_chars"), w["k"][list(CLASSES).index("symbol")].cast("bigint").alias("n_symbols"), dup.cast("bigint").alias("n_dup_lines"), w["r"].cast("bigint").alias("n_repeat_words"), w["k"].alias("classes")))


def references(docs: DataFrame, text: str = "text", lang: str = "lang", top: int = TOP, least: int = MIN_REFERENCE) -> DataFrame:
    """lang, classes (shares, in the order of CLASSES), words and shares (one more than words: all others).

    One row for each language with ``least`` words or more, and one with the
    language null over all documents.
    """
    rows = docs.select(named(lang).cast("string").alias("lang"), _text(named(text)).alias("text"))
    counts = rows.select("lang", F.explode(_common(F.col("text"))).alias("word")).groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    counts = cut(counts)  # the texts are split once for what is made of it below

    def common(counted: DataFrame) -> DataFrame:
        total = counted.groupBy("lang").agg(F.sum("n").alias("total"))
        rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
        first = counted.withColumn("rank", rank).where(F.col("rank") <= top).groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("rank", "word", "n"))).alias("t"))
        shares = F.transform("t.n", lambda n: n / F.col("total"))
        joined = first.join(total.withColumnRenamed("lang", "of"), F.col("lang").eqNullSafe(F.col("of")))
        rest = (F.col("total") - F.aggregate("t.n", F.lit(0).cast("bigint"), lambda a, n: a + n)) / F.col("total")
        return joined.select("lang", "total", F.col("t.word").alias("words"), F.array_append(shares, rest).alias("shares"))

    own = common(counts.where("lang is not null")).where(F.col("total") >= least)
    every = common(counts.groupBy("word").agg(F.sum("n").alias("n")).select(F.lit(None).cast("string").alias("lang"), "word", "n"))
    word_chars = F.length("text") - _matched(F.col("text"), r"[\x20\x09-\x0D]")
    # no filter, which would count the characters a second time: short texts have no cells
    in_steps = let(word_chars, lambda n: F.when(n >= MIN_CLASS_CHARS, F.transform(class_counts(F.col("text"), n), lambda c: F.floor(STEPS * c.cast("bigint") / n))))
    cells = rows.select("lang", F.posexplode(in_steps).alias("cell", "step"))
    steps = cut(cells.groupBy("lang", "cell", "step").agg(F.count(F.lit(1)).alias("docs")))

    def middle(counted: DataFrame) -> DataFrame:
        """The median document's share of each class, in steps, and all scaled to 1."""
        over = Window.partitionBy("lang", "cell")
        seen = counted.withColumn("below", F.sum("docs").over(over.orderBy("step"))).withColumn("all", F.sum("docs").over(over))
        share = seen.where(2 * F.col("below") >= F.col("all")).groupBy("lang", "cell").agg((F.min("step") + 0.5).alias("share"))
        each = share.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("cell", "share"))).alias("s"))
        return each.select(F.col("lang").alias("of"), let(F.aggregate("s.share", F.lit(0.0), lambda a, x: a + x), lambda n: F.transform("s.share", lambda x: x / n)).alias("classes"))

    classes = middle(steps.where("lang is not null")).unionByName(middle(steps.groupBy("cell", "step").agg(F.sum("docs").alias("docs")).select(F.lit(None).cast("string").alias("lang"), "cell", "step", "docs")))
    found = own.unionByName(every).join(classes, F.col("lang").eqNullSafe(F.col("of")))
    done = cut(found.select("lang", "classes", "words", "shares"))
    let_go(counts)
    let_go(steps)
    return done


def _divergence(p: Column, q: Column) -> Column:
    """A cell's part of twice the Jensen-Shannon divergence (bits)."""
    part = lambda x: F.when(x > 0, x * F.log2(2 * x / (p + q))).otherwise(0.0)
    return part(p) + part(q)


def class_divergence(counts: Column, n: Column, shares: Column) -> Column:
    """Of counts whose sum is ``n`` from the shares of a reference."""
    return F.aggregate(F.zip_with(counts, shares, lambda c, q: _divergence(c / n, q)), F.lit(0.0), lambda a, x: a + x) / 2


def by_length(words: Column) -> Column:
    """For each length, from 0 on, the words of that length as one text with commas, after as many commas as keep their places in the list.

    Words are letters alone.  A text is searched faster than an array, and most of the list is not searched for a word.
    """
    longest = F.aggregate(words, F.lit(0), lambda a, w: F.greatest(a, F.length(w)))
    return F.transform(F.sequence(F.lit(0), longest), lambda size: F.array_join(F.transform(words, lambda w: F.when(F.length(w) == size, w).otherwise("")), ","))


def common_divergence(words: Column, n: Column, common: Column, shares: Column) -> Column:
    """Of a list of ``n`` words from the shares of common words (given ``by_length``) and all others.

    The places of a text's common words, sorted, are runs of one word each: linear
    in the text but for the sort.  Cells without words add their share.
    """

    def total(at: Column) -> Column:
        ends = F.filter(F.sequence(F.lit(1), F.size(at)), lambda i: F.when(i == F.size(at), True).otherwise(F.get(at, i) != F.get(at, i - 1)))
        cell = lambda e, k: let(F.get(e, k), lambda stop: F.struct((stop - F.when(k > 0, F.get(e, k - 1)).otherwise(0)).alias("c"), F.get(shares, (F.get(at, stop - 1) - 1).cast("int")).alias("q")))
        cells = let(ends, lambda e: F.transform(F.sequence(F.lit(0), F.size(e) - 1), lambda k: cell(e, k)))
        return F.aggregate(cells, F.struct(F.lit(0.0).alias("d"), F.lit(0.0).alias("q")), lambda a, x: F.struct((a["d"] + _divergence(x["c"] / n, x["q"])).alias("d"), (a["q"] + x["q"]).alias("q")))

    def whole(at: Column) -> Column:
        other, rest = _divergence((n - F.size(at)) / n, F.element_at(shares, -1)), F.element_at(shares, -1)
        none = F.struct(F.lit(0.0).alias("d"), F.lit(0.0).alias("q"))
        return let(F.when(F.size(at) > 0, total(at)).otherwise(none), lambda x: (x["d"] + other + 1 - rest - x["q"]) / 2)

    found = F.transform(words, lambda w: F.find_in_set(w, F.get(common, F.length(w))))
    return let(F.sort_array(F.filter(found, lambda i: i > 0)), whole)


def limit(most: float, cells: Column | int, n: Column) -> Column:
    """The limit on the divergence of a sample of ``n``: ``most``, and the mean that chance gives, (cells - 1) / (8 n ln 2) bits, twice."""
    return most + (cells - 1) / (n * (4 * math.log(2)))


def judge(docs: DataFrame, refs: DataFrame, text: str = "text", lang: str = "lang", class_limit: float = CLASS_LIMIT, common_limit: float = COMMON_LIMIT) -> DataFrame:
    """row (struct of the table's columns), the counts of ``base_counts``, class_divergence and common_divergence (null if not judged), base_failed and kept."""
    named_refs = refs.select(F.col("lang").alias("of"), F.struct("classes", by_length(F.col("words")).alias("words"), "shares").alias("ref"))
    every = named_refs.where("of is null").select(F.col("ref").alias("every"))
    rows = docs.select(F.struct(*[named(c) for c in docs.columns]).alias("row"), named(lang).cast("string").alias("lang"), _text(named(text)).alias("text"))
    own = rows.join(if_small(named_refs.where("of is not null"), MOST_LANGUAGES), F.col("lang") == F.col("of"), "left")
    met = own.join(F.broadcast(every), how="left").withColumn("ref", F.coalesce("ref", "every"))  # one row: all documents
    base = met.withColumn("b", all_counts(F.col("text"))).select("row", "text", "ref", "b.*")
    shown = base.withColumn("class_divergence", F.when(F.col("word_chars") >= MIN_CLASS_CHARS, class_divergence(F.col("classes"), F.col("word_chars"), F.col("ref.classes"))))
    common = let(_common(F.col("text")), lambda w: F.struct(F.size(w).alias("n"), F.when(F.size(w) >= MIN_COMMON_WORDS, common_divergence(w, F.size(w), F.col("ref.words"), F.col("ref.shares"))).alias("d")))
    shown = shown.withColumn("common", common)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    far = lambda d, most: F.coalesce(d > most, F.lit(False))
    off = far(F.col("class_divergence"), limit(class_limit, len(CLASSES) + 1, F.col("word_chars") / RUN)) | far(F.col("common.d"), limit(common_limit, F.size("ref.shares"), F.col("common.n")))
    return shown.select("row", *BASE, "class_divergence", F.col("common.d").alias("common_divergence"), failed.alias("base_failed"), (~failed & ~off).alias("kept"))


def keep_good(docs: DataFrame, refs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` that all rules let stay, all columns as they are."""
    return judge(docs, refs, text, lang).where("kept").select("row.*")


def _cell(p: str, q: str) -> str:
    return f"(CASE WHEN {p} > 0 THEN {p} * log2(2 * {p} / ({p} + {q})) ELSE 0.0 END + CASE WHEN {q} > 0 THEN {q} * log2(2 * {q} / ({p} + {q})) ELSE 0.0 END)"


_CLASS_COUNTS = ", ".join("length(t) - length(regexp_replace(t, '{}+', '', 'g'))".format(p.replace("'", "''")) for p in CLASSES.values())
#: What DuckDB makes of the query over documents.
SQL = rf"""
WITH d AS (
  SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w, regexp_extract_all(lower(coalesce(text, '')), '{LETTERS}') AS c
  FROM documents
), m AS (SELECT *, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, [{_CLASS_COUNTS}] AS k0 FROM d
), k AS (SELECT *, list_append(k0, word_chars - list_sum(k0)) AS k FROM m
), lw AS (SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(c) AS word FROM d) GROUP BY lang, word
), lall AS (SELECT lang, word, n FROM lw WHERE lang IS NOT NULL UNION ALL SELECT NULL, word, sum(n) FROM lw GROUP BY word
), ranked AS (
  SELECT lang, word, n, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS r, sum(n) OVER (PARTITION BY lang) AS total FROM lall
), steps AS (
  SELECT lang, cell, {STEPS} * c // word_chars AS step, count(*) AS docs
  FROM (SELECT lang, word_chars, unnest(k) AS c, unnest(range(0, {len(CLASSES) + 1})) AS cell FROM k WHERE word_chars >= {MIN_CLASS_CHARS}) GROUP BY ALL
), sall AS (SELECT * FROM steps WHERE lang IS NOT NULL UNION ALL SELECT NULL, cell, step, sum(docs) FROM steps GROUP BY cell, step
), seen AS (
  SELECT lang, cell, step, sum(docs) OVER (PARTITION BY lang, cell ORDER BY step) AS below, sum(docs) OVER (PARTITION BY lang, cell) AS every FROM sall
), middle AS (SELECT lang, cell, min(step) + 0.5::DOUBLE AS share FROM seen WHERE 2 * below >= every GROUP BY lang, cell
), classes AS (SELECT lang, cell, share / sum(share) OVER (PARTITION BY lang) AS q FROM middle
), langs AS (SELECT DISTINCT lang FROM ranked WHERE lang IS NOT NULL AND total >= {MIN_REFERENCE} AND lang IN (SELECT lang FROM classes WHERE lang IS NOT NULL)
), common AS (SELECT coalesce('=' || lang, '') AS g, word, n / total::DOUBLE AS q FROM ranked WHERE r <= {TOP} AND (lang IS NULL OR lang IN (SELECT lang FROM langs))
), rest AS (SELECT g, 1 - sum(q) AS rest, count(*) AS cells FROM common GROUP BY g
), doc AS (SELECT *, CASE WHEN lang IN (SELECT lang FROM langs) THEN '=' || lang ELSE '' END AS g, len(c) AS nc FROM k
), cd AS (
  SELECT doc_id, sum({_cell("(x / word_chars::DOUBLE)", "q")}) / 2 AS class_divergence
  FROM (SELECT doc_id, g, word_chars, unnest(k) AS x, unnest(range(0, {len(CLASSES) + 1})) AS cell FROM doc WHERE word_chars >= {MIN_CLASS_CHARS}) x
  JOIN classes ON x.g = coalesce('=' || classes.lang, '') AND x.cell = classes.cell GROUP BY doc_id
), dw AS (SELECT doc_id, g, nc, word, count(*) AS n FROM (SELECT doc_id, g, nc, unnest(c) AS word FROM doc WHERE nc >= {MIN_COMMON_WORDS}) GROUP BY ALL
), here AS (
  SELECT doc_id, sum({_cell("(n / nc::DOUBLE)", "q")}) AS s, sum(n) AS n, sum(q) AS q FROM dw JOIN common ON dw.g = common.g AND dw.word = common.word GROUP BY doc_id
), wd AS (
  SELECT doc.doc_id, rest.cells, (coalesce(s, 0.0) + {_cell("((nc - coalesce(here.n, 0)) / nc::DOUBLE)", "rest.rest")} + 1 - rest.rest - coalesce(here.q, 0.0)) / 2 AS common_divergence
  FROM doc JOIN rest ON doc.g = rest.g LEFT JOIN here ON doc.doc_id = here.doc_id WHERE nc >= {MIN_COMMON_WORDS}
), win AS (SELECT doc_id, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS x FROM (SELECT doc_id, w, unnest(range(1, n_words - {WINDOW - 2})) AS i FROM m WHERE n_words >= {WINDOW})
), again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS c FROM win) WHERE c > 1
), rep AS (SELECT doc_id, sum(covered) AS n FROM (SELECT doc_id, least({WINDOW}, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i), {WINDOW})) AS covered FROM again) GROUP BY doc_id
), lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d
), dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '{WORD}') GROUP BY doc_id
), f AS (
  SELECT doc.doc_id, n_words, word_chars, length(t) - length(regexp_replace(t, '{SYMBOL}', '', 'g')) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
         class_divergence, common_divergence, nc, cells
  FROM doc LEFT JOIN rep ON doc.doc_id = rep.doc_id LEFT JOIN dup ON doc.doc_id = dup.doc_id LEFT JOIN cd ON doc.doc_id = cd.doc_id LEFT JOIN wd ON doc.doc_id = wd.doc_id
), j AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed,
         coalesce(class_divergence > {CLASS_LIMIT} + {len(CLASSES)} / (word_chars / {float(RUN)} * (4 * ln(2))), false) OR coalesce(common_divergence > {COMMON_LIMIT} + cells / (nc * (4 * ln(2))), false) AS off
  FROM f
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       base_failed, NOT base_failed AND NOT off AS kept, round(class_divergence, 6) AS class_divergence, round(common_divergence, 6) AS common_divergence
FROM j
"""
