"""Cleaning pipeline over ``documents``: five stages, each one corpus operator."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.staging import stage
from shelfwise.llm import byte_bpe, exact_dedup, language, minhash, mixing
from shelfwise.llm.queries import RANKS
from shelfwise.llm.tables import filed, fresh, keep_rows, read


#: Keys that a task of the last stage remembers. Its workers live beside executors whose
#: heap the earlier stages have filled.
REMEMBERED = 40_000


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in no language: null, empty or without a letter, whether or not
    any document is labelled."""
    name = fresh(docs.columns, "language")
    judged = language.predict(docs, language.fit(docs), out=name)
    return judged.where(f"{name}.letters").drop(name)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest id stays."""
    docs = filed(docs)
    return keep_rows(docs, exact_dedup.exact_duplicates(docs).where("kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at 0.8, the one with the smallest id stays."""
    docs = filed(docs)
    return keep_rows(docs, minhash.near_duplicates(docs, shingle_words=5).where("stays"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document once per epoch in which the mix takes words of it."""
    docs = filed(docs)
    mixed = mixing.mix(docs)
    copies = mixed.pieces.select("row", "epoch").distinct().join(mixed.documents, "row")
    return keep_rows(docs, copies)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document and the digests that prove the round trip."""
    ranks = byte_bpe.read_ranks(public_tokenizers.path(RANKS))
    return byte_bpe.token_digests(docs, ranks, public_tokenizers.PATTERN, memo=REMEMBERED)


STAGES = [
    ("language_id", keep_languages),
    ("exact_dedup", drop_copies),
    ("minhash", drop_near_copies),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]

#: The language model and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = read(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
