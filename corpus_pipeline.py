"""From raw documents to token ids: rules, near-dedup, decontamination, masking, encoding.

Every stage but the last returns the columns it was given, whatever their names, with the rows it
keeps; masking changes ``text`` and, where it is there, ``n_chars``. The last returns doc_id,
n_bytes, n_tokens, ids, their digest, and whether decoding them gives the text again.

A missing text is empty and fails the rules. A missing language has a reference of its own; a
missing doc_id is linked with nothing and contains no benchmark item. Near-dedup takes a doc_id for
one document: of a group the smallest stays, repeated rows of it too. Texts are processed whole,
whatever their length. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from airloom.llm import decontaminate, near_dedup, pieces, pii, quality
from airloom.llm.common import materialize, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality.stage),
    ("minhash_near_dedup", near_dedup.stage),
    ("benchmark_decontamination", decontaminate.stage),
    ("pii", pii.stage),
    ("sentencepiece", pieces.stage),
]

#: SQL can express neither hashing by bands nor token pieces; tests hold the stages to brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
