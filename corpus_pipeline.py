"""The corpus pipeline: quality rules, SimHash near-dedup, benchmark decontamination, mixing, token output.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet in the shared folder and read back as the next stage's docs. All but
the last return the columns of documents, and further columns of docs, whatever their
names, pass through them unchanged.

Defined results, in every stage: an empty table gives an empty one; a row whose doc_id is
null, or repeats, is a row like any other and is judged by its own text; null texts count as
empty; texts of any length are handled whole; ties and repeated rows are stated by stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewake.llm import decontamination, mixing, quality_rules, simhash, token_output
from tidewake.llm.shared import materialize
from tidewake.llm.token_counts import vocabulary_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    Null, empty and wordless texts fail. Repeated rows are kept or dropped alike.
    Without usable labels the counting rules alone decide.
    """
    field = quality_rules.train(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_rules.keep_good(spark, docs, field)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints: of its least doc_id, null last, then of the least text hash.

    Rows equal in id and text are one document. Null and empty texts are one group.
    """
    return simhash.one_of_each_group(spark, docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage.

    Null and wordless texts are clean. An empty benchmark, or one of null texts, takes none away.
    """
    return decontamination.remove_contaminated(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix draws: a row a piece, by shard, in the shard's own order.

    A piece is a whole document, or the part of it that lies in drawn blocks; a document
    comes up to twice. Texts without words are never drawn. A null source is a source.
    """
    return mixing.mixed_rows(spark, docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place, length and checksum of each row's ids in the token shards, in order of doc_id, null first, then of text.

    Rows that repeat an id follow one another; an empty text has the end id alone.
    """
    return token_output.token_output(spark, docs, vocabulary_path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("source_mixing", mixing_stage),
    ("token_output", token_stage),
]

#: The stages fit a model, follow links and tokenize; SQL cannot express them. tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
