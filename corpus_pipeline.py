"""A training-corpus pipeline over ``documents``: each stage takes its predecessor's rows and filters or rewrites them.

Of every stage: texts of any length are taken whole; an empty table gives an empty
one; other columns may have any name, and all but the last stage return them as
they are; a null id counts as one more id, which comes after all others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spliceloom.llm import bpe, langid, line_spread, simhash, suffix_match
from spliceloom.llm.common import crc_mod, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a recognisable language; learns from the rows not held out (6).

    A null text, or one without letters, has none and goes; rows without a language
    teach nothing; without any to learn from, all go; of equal posteriors the first
    language by name counts; repeated rows are judged alike.
    """
    return langid.keep_known(docs, langid.fit(docs, learn=crc_mod("doc_id", 3) != 1))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes cross-site boilerplate lines out of the texts (3); drops no row.

    A null text stays null; one of which nothing stays is empty; a null site counts as
    one; a line stays in the document with the smallest id; repeated rows of one id are
    one document and all return.
    """
    return line_spread.remove_boilerplate(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies: five-word shingles, fingerprints within the radius or similarity 0.8 or more (9).

    Null texts and texts without words are copies of each other; the document with the
    smallest id stays, one without an id only where its group has no other; of rows with
    one id and text the one with the smallest hash over all columns.
    """
    return simhash.keep_one(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item (8).

    A null text has no words and stays; items without words match nothing; with an empty
    benchmark all stay; repeated rows are judged alike.
    """
    return suffix_match.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every kept document, with the digests of ids and decoded text (10).

    A null text counts as empty and has no tokens; repeated rows get a row each.
    """
    return bpe.encoded(docs)


STAGES = [("language ID", language), ("line dedup", lines), ("SimHash near-dedup", near_copies), ("benchmark decontamination", benchmark_leaks), ("BPE encoding", encode)]

#: SQL cannot express the language model, the fingerprints or the encoder; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
