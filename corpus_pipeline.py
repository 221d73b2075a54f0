"""From raw documents to packed token sequences, in stages that are written and read again.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept;
all but the last return the columns of ``documents``:

1. quality: documents that boosted trees, trained on labelled rows, score below 0.3 go;
2. near_copies: of each component of the Jaccard join one document stays;
3. decontamination: documents that hold a benchmark item go;
4. mixing: documents are repeated so that the sources' volumes are tempered, and shuffled;
5. packing: token ids in rows of fixed length.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docrecords.llm import decontamination, jaccard_join, mixing, packing, quality_model
from docrecords.llm.common import stored, table

LEAST_QUALITY = 0.3
#: Near copies share this percentage of their shingles of so many words.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of good quality; labels of held-out documents are not used."""
    labels = table(spark, sf_dir, "labels").filter(~quality_model.held_out())
    forest = quality_model.fit(docs.select("doc_id", "text"), labels)
    return quality_model.score(docs, forest).filter(f"score >= {LEAST_QUALITY}").select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard_join.drop_near_copies(docs, words=NEAR_WORDS, percent=NEAR_PERCENT, by_rarest=True)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without benchmark items."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents repeated to the target weights of their sources."""
    return mixing.mix(docs).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of packed token ids."""
    return packing.pack(spark, docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("packing", packed),
]

#: No stage is plain SQL; tests/llm holds the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
