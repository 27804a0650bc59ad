"""Fill-in-middle transformation in Spark SQL functions alone.

A text is cut into units (words of ASCII letters, every other character by
itself) by ``regexp_extract_all``; ``sha2`` of seed and id, read by ``conv``, gives
two cuts and two draws; ``slice`` and ``array_join`` build prefix, middle and
suffix, which are laid out with sentinels.  ``restored`` reads the text back from
layout and form.  A projection: no shuffle, no state, no Python.

A text that holds a sentinel stays plain, so each sentinel occurs once in the
other layouts: a false one would have to begin inside a part and reach into the
next sentinel, whose first character is ``<``, and none has a second ``<``.

Defined results: null text counts as empty; an empty text is plain; a null id
counts as an empty one; equal ids have equal draws (ties and repeated rows each
return); texts are taken whole; an empty table is empty; other columns may have
any name and are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import named

#: Sentinels before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = SENTINELS = ("<P>", "<S>", "<M>")
UNIT = "[A-Za-z]+|[^A-Za-z]"
#: Percent of texts that are transformed, and percent of those that get the suffix first.
RATE, SPM_RATE = 90, 20


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once a row, as the one element of an array."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def draws(key: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers of seed and id, from the first 32 hex digits of their SHA-256."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 1, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """id, n (units), form (plain, psm or spm), prefix, middle, suffix (null if plain) and output: one row per input row."""
    named_draws = [d.alias(f"h{i}") for i, d in enumerate(draws(named(key), seed), 1)]
    base = docs.select(named(key).alias("id"), F.coalesce(named(text).cast("string"), F.lit("")).alias("text"), *named_draws)
    plain = (F.col("text") == "") | F.col("text").contains(PREFIX) | F.col("text").contains(SUFFIX) | F.col("text").contains(MIDDLE) | (F.col("h3") % 100 >= rate)
    form = F.when(plain, "plain").when(F.col("h4") % 100 < spm_rate, "spm").otherwise("psm")

    def parts(units: Column) -> Column:
        n = F.size(units)
        a, b = F.least(F.col("h1") % (n + 1), F.col("h2") % (n + 1)).cast("int"), F.greatest(F.col("h1") % (n + 1), F.col("h2") % (n + 1)).cast("int")
        part = lambda start, stop: F.when(F.col("form") != "plain", F.array_join(F.slice(units, start + 1, stop - start), ""))
        return F.struct(n.cast("bigint").alias("n"), part(F.lit(0), a).alias("prefix"), part(a, b).alias("middle"), part(b, n).alias("suffix"))

    cut = base.withColumn("form", form).withColumn("p", let(F.regexp_extract_all("text", F.lit(UNIT), F.lit(0)), parts))
    psm = F.concat(F.lit(PREFIX), "p.prefix", F.lit(SUFFIX), "p.suffix", F.lit(MIDDLE), "p.middle")
    spm = F.concat(F.lit(SUFFIX), "p.suffix", F.lit(PREFIX), "p.prefix", F.lit(MIDDLE), "p.middle")
    output = F.when(F.col("form") == "plain", F.col("text")).when(F.col("form") == "psm", psm).otherwise(spm)
    return cut.select("id", "p.n", "form", "p.prefix", "p.middle", "p.suffix", output.alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text from its layout alone: the sentinels are parsed, the parts put back in order."""

    def after(sentinel: str, stop: str | None) -> Column:
        start = F.locate(sentinel, output) + len(sentinel)
        return F.substr(output, start) if stop is None else F.substr(output, start, F.locate(stop, output) - start)

    psm = F.concat(after(PREFIX, SUFFIX), after(MIDDLE, None), after(SUFFIX, MIDDLE))
    spm = F.concat(after(PREFIX, MIDDLE), after(MIDDLE, None), after(SUFFIX, PREFIX))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


#: What DuckDB makes of the query over documents.
SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         sha256('1:' || doc_id::VARCHAR) AS x
  FROM documents
), h AS (
  SELECT doc_id, t, u, len(u)::BIGINT AS n, ('0x' || substr(x, 1, 8))::BIGINT AS h1, ('0x' || substr(x, 9, 8))::BIGINT AS h2,
         ('0x' || substr(x, 17, 8))::BIGINT AS h3, ('0x' || substr(x, 25, 8))::BIGINT AS h4
  FROM d
), c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM h
), p AS (
  SELECT doc_id, t, n, form, coalesce(array_to_string(u[1:a], ''), '') AS pre, coalesce(array_to_string(u[a + 1:b], ''), '') AS mid,
         coalesce(array_to_string(u[b + 1:n], ''), '') AS suf
  FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""
