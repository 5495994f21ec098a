"""Documents to training data in five stages, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import decontaminate, mixing, neardup, tokens, toxicity
from ledgerlens.llm.common import read
from ledgerlens.plans import scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the toxicity chain rejects. It is fitted on the labelled ones of the input."""
    return toxicity.without_toxic(docs, read(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles agree in four fifths or more."""
    return neardup.deduplicate(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark passage, substitutions included."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"), least=1)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target weight says; the columns of documents. The order is random here, but write_tokens sorts by id."""
    return mixing.mix(docs).select(docs.columns)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token records and their index, as read back: doc_id, start, n_tokens, ids_crc32."""
    return tokens.digest(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("tokens", write_tokens),
]

#: A fitted classifier has no SQL form; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to the documents. A stage's intermediate tables are removed once its result is written."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before = docs
        with scratch.scope() as inner:
            docs = inner.release(scratch.keep(stage(spark, docs, sf_dir), f"stage-{name}"))
        scratch.drop(before)
    return docs


def queries():
    return {"pipeline": run}


def oracle_sql():
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
