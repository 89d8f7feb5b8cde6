"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns the documents that it keeps, with the columns of documents; the last
returns the pieces of packed sequences. A stage's docs are its predecessor's result, written and read again.

1. language_id: documents without a language (no text or no letter) go, and only those, also where no document has a language to learn from.
2. near_dedup: of each group of near duplicates (five-word shingles, similarity 0.8 or more) the smallest doc_id stays.
3. suffix_dedup: passages of 100 bytes or more that occurred before are cut out, whole characters only. Rows stay, even if nothing is left of their text.
4. secrets: secrets in texts are masked. The ledger of what was scanned is kept by sf_dir, in the shared folder; without one it serves this run alone.
5. packing: texts are encoded and packed into windows of 1024 tokens.

Nulls: a row without text goes in the first stage; one without a doc_id is a document like any other, after all that have one. Very long texts are read whole. Ties and
repeated rows: of rows that repeat an id and its text one stays; different texts under one id are different documents. Extra columns pass through the first four stages
as they are, whatever their names. Tables without rows give none at any stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loomgraph.llm import langid, minhash, packing, secrets, suffixdedup
from loomgraph.llm.common import materialize
from loomgraph.llm.queries import documents, ledger_path, tokenizer_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_known(docs, langid.train(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_first(docs, width=5, percent=80, without_id=True)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffixdedup.cut(docs, without_id=True)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs, at=ledger_path(spark, sf_dir) if sf_dir else None)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("secrets", mask_secrets),
    ("packing", pack),
]
#: Mixture inference, near-duplicate groups and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
