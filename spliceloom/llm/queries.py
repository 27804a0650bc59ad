"""The contract queries opN_<name>: thin digests over the operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, fim, langid, line_spread, ogg, ppm, quality, secrets, simhash, spelling, suffix_match, token_count, toxicity
from .common import crc_mod, table


def op1_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from the rows whose crc32(doc_id) mod 7 is not 2 and scores every row."""
    docs = table(spark, sf_dir, "documents")
    found = ppm.score(docs, crc_mod("doc_id", 7) != 2)
    return found.select("doc_id", (crc_mod("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte")


def op2_ogg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ogg.media(table(spark, sf_dir, "documents"))


def op3_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines counted and removed in each document, and the digest of the text that stays (null: empty)."""
    found = line_spread.spread(table(spark, sf_dir, "documents"))
    digest = F.sha2(F.coalesce("row.text", F.lit("")).cast("binary"), 256)
    return found.select("row.doc_id", "n_lines", "n_removed", digest.alias("text_sha256"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.scan(docs, secrets.fit(docs))


def op5_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.counts(table(spark, sf_dir, "documents"))


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from the rows whose crc32(doc_id) mod 3 is not 1 and predicts every row."""
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs, learn=crc_mod("doc_id", 3) != 1)
    found = langid.predict(docs, model)
    return found.select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "n_letters")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from labels of rows whose crc32(doc_id) mod 3 is not 1 and scores every row."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), learn=crc_mod("doc_id", 3) != 1)
    found = toxicity.score(docs, model)
    return found.select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "score", "predicted", "n_fired")


def op8_suffix_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_match.digest(suffix_match.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded(table(spark, sf_dir, "documents"))


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and the verdict of divergence from the references of all documents."""
    docs = table(spark, sf_dir, "documents")
    found = quality.judge(docs, quality.references(docs))
    shown = [F.round(c, 6).alias(c) for c in ("class_divergence", "common_divergence")]
    return found.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", *shown)


def op12_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layout of every text with the seed 1, and the digest of what is read back from it."""
    found = fim.transform(table(spark, sf_dir, "documents"))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    chars = [F.length(part).cast("bigint").alias(f"{part}_chars") for part in ("prefix", "middle")]
    return found.select(F.col("id").alias("doc_id"), "n", "form", *chars, sha(F.col("output")).alias("output_sha256"), sha(fim.restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of all words, some of which lose a character by a hash of id and word."""

    def slipped(key: Column, word: Column) -> Column:
        h = F.crc32(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), word).cast("binary"))
        at = (h % F.length(word)).cast("int")
        return F.when(h % 199 == 0, F.concat(F.left(word, at), F.substr(word, at + 2))).otherwise(word)

    return spelling.group(spelling.word_counts(table(spark, sf_dir, "documents"), changed=slipped))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ppm": op1_ppm,
    "op2_ogg": op2_ogg,
    "op3_line_spread": op3_line_spread,
    "op4_secrets": op4_secrets,
    "op5_token_count": op5_token_count,
    "op6_langid": op6_langid,
    "op7_toxicity": op7_toxicity,
    "op8_suffix_match": op8_suffix_match,
    "op9_simhash": op9_simhash,
    "op10_bpe": op10_bpe,
    "op11_quality": op11_quality,
    "op12_fim": op12_fim,
    "op13_spelling": op13_spelling,
}

#: DuckDB SQL for the queries that SQL can express.
ORACLE_SQL: dict[str, str] = {"op3_line_spread": line_spread.SQL.replace("SITES", str(line_spread.MIN_SITES)), "op11_quality": quality.SQL, "op12_fim": fim.SQL}
