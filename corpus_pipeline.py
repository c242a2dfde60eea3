"""The corpus pipeline: toxic, near-duplicate and contaminated text goes, the rest is packed.

Every stage takes the rows that the one before kept, and its decisions take effect on them.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattspan.llm.common import free_name, keep_rows, stage, table
from wattspan.llm.decontamination import scan
from wattspan.llm.jaccard_join import jaccard_join
from wattspan.llm.packing import pack, token_pieces
from wattspan.llm.substring_dedup import remove_repeats, repeated_passages
from wattspan.llm.toxicity import scored_once


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below the threshold of their language."""
    names = free_name(docs.columns, "toxicity"), free_name(docs.columns, "toxic")
    judged = scored_once(docs, table(spark, sf_dir, "labels"), docs.columns, names)
    return judged.where(~F.col(names[1])).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, that of the least id."""
    first = jaccard_join(docs).where("is_first")
    return keep_rows(docs, first, once=True)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has."""
    return remove_repeats(docs, repeated_passages(docs))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    found = scan(docs, table(spark, sf_dir, "benchmark"))
    return keep_rows(docs, found.where("size(spans) > 0"), "left_anti")


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of at most 1,024 tokens."""
    pieces = token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("jaccard_join", drop_near_copies),
    ("substring_dedup", drop_repeats),
    ("decontamination", drop_contaminated),
    ("packing", pack_tokens),
]

# SQL can express neither the trained classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
