"""The corpus pipeline: language ID, SimHash near-dedup, benchmark decontamination, PII redaction, best-fit packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each as Parquet in the shared folder and
reads it again as the next stage's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarnbeck.llm import decontaminate, langid, packing, pii, simhash
from tarnbeck.llm.common import materialise, table

STAGES = [
    ("language_id", langid.keep_identified),
    ("near_dedup", simhash.keep_one),
    ("decontamination", decontaminate.keep_clean),
    ("pii_redaction", pii.redact_stage),
    ("packing", packing.pack_stage),
]

#: The stages learn models, hash and tokenise, which SQL cannot express; tests hold their rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
