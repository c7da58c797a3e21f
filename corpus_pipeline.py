"""From raw documents to sharded training data, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from nudgelab.llm import decontamination, mixing, rule_ensemble, sharding
from nudgelab.llm import near_duplicates as near
from nudgelab.llm.common import labelled_sample
from nudgelab.session import materialize

LEAST_QUALITY = 0.7
SHARDS = 8
#: Whole rows pass through Python workers; smaller batches keep those workers small.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"


def small_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches for the rows that a stage hands to Python; ``run`` puts it back."""
    spark.conf.set(BATCH_SETTING, BATCH_BYTES)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble, learnt on all training labels, does not reject.

    Null and empty texts are scored by their (zero) statistics like any others; null ids and
    repeated rows are judged one by one; an empty table gives no rows. All columns are kept,
    whatever their names. Without usable labels every score is one half, so no row is kept at a
    least score above that.
    """
    small_batches(spark)
    whole = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    sample = labelled_sample(whole, labels, "quality", 4, 2, rule_ensemble.TRAINING_ROWS)
    return rule_ensemble.accepted(docs, rule_ensemble.learn(sample), LEAST_QUALITY)


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, 0.8).

    The smallest id of a group stays. Texts without words are in no group and stay, and so do rows
    without an id; of rows that repeat an id one stays. An empty table gives no rows. All columns are
    kept, whatever their names.
    """
    small_batches(spark)
    return near.deduplicated(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages they share with the benchmark.

    A row goes only if a cut leaves it without a word. Null and empty texts stay as they are; repeated
    rows are cut alike; benchmark items without an id count, those without a text do not; an empty
    table or benchmark changes nothing. ``n_chars`` follows the cut text; other columns are kept.
    """
    small_batches(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.decontaminated(docs, benchmark)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target shares: all documents once, small sources again for more epochs.

    Further epochs are repeated rows; no row is lost. A null source is a source of its own; rows
    without an id are ordered by their text; an empty table gives no rows. All columns are kept,
    whatever their names. Shards are dealt by hash, so of the schedule only the copies of each row
    reach the pipeline's result, not the order.
    """
    return mixing.mix_of(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with size, text_crc32, law, shard, slot and grown_shard.

    Shards are one row apart at most and slots gapless; repeated rows have slots of their own, rows
    without an id are dealt by their text and place. An empty table gives no rows. Input columns
    are kept, but for those with the names above, which are replaced.
    """
    return sharding.sharded(docs, SHARDS)


STAGES = [
    ("quality_filter", quality_filter),
    ("near_deduplication", near_deduplication),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mix", source_mix),
    ("shards", shards),
]

#: Stages with a fitted model, sketches or a schedule have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again."""
    docs, given = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.conf.get(BATCH_SETTING, None)
    try:
        for _, stage in STAGES[:-1]:
            docs = materialize(stage(spark, docs, sf_dir))
    finally:
        if given is None:
            spark.conf.unset(BATCH_SETTING)
        else:
            spark.conf.set(BATCH_SETTING, given)
    return STAGES[-1][1](spark, docs, sf_dir)
