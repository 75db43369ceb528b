"""Corpus pipeline: filter, deduplicate, decontaminate and pack documents.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from raincheck.llm import best_fit, decontaminate, line_dedup, quality_gam, simhash_dedup
from raincheck.llm.common import ready, stored, table

#: (name, function). What each decides:
#: documents below the quality threshold go; repeated lines leave their texts;
#: one document of each near-duplicate component stays; documents with a
#: benchmark hit go; the rest is packed into training sequences.
STAGES = [
    ("quality_classifier", quality_gam.stage),
    ("line_dedup", line_dedup.stage),
    ("simhash_near_dedup", simhash_dedup.stage),
    ("benchmark_decontamination", decontaminate.stage),
    ("best_fit_packing", best_fit.stage),
]

#: The first stage is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of the last one."""
    ready(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
