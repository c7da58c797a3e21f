"""The queries of this package and their SQL, as ``__spark_entry__`` registers them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nudgelab.llm import (
    chat,
    class_ngrams,
    decontamination,
    filter_audit,
    mixing,
    quality_rules,
    rule_ensemble,
    sharding,
    simhash,
    token_counts,
    toxicity,
    whitening,
)
from nudgelab.llm import near_duplicates as near
from nudgelab.llm.common import held_out, labelled_sample
from nudgelab.llm.oracles import SQL

#: The vocabulary file that the token counts of the query use.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: A score from here on means label 1.
LEAST_SCORE = 0.7


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity scores of all documents by the learnt lexicon."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    sample = labelled_sample(docs, labels, "toxic", 3, 1, toxicity.TRAINING_ROWS)
    return toxicity.scored(docs, toxicity.learn(sample)).select(
        "doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score",
        (F.col("score") >= LEAST_SCORE).cast("int").alias("predicted"), "n_words", "n_hits",
    )


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Word-piece token counts of all documents."""
    vocabulary = token_counts.load_vocabulary(VOCABULARY)
    return token_counts.token_counts(table(spark, folder, "documents"), vocabulary)


def op3_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in eight shards of the ring, sizes at most one row apart."""
    return sharding.sharded(table(spark, folder, "documents"), shards=8, keep=False)


def op4_class_ngrams(spark: SparkSession, folder: str) -> DataFrame:
    """Class-bigram and unigram scores of all documents."""
    return class_ngrams.scored(table(spark, folder, "documents"))


def op5_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate groups of all documents by 2-word shingles at a similarity of 0.8."""
    return near.near_duplicates(table(spark, folder, "documents"), width=2)


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """The mix of all documents' sources to size-smoothed target weights."""
    return mixing.mixed(table(spark, folder, "documents")).select(
        "doc_id", "mix_source", "mix_epoch", "mix_slot", "mix_position"
    )


def op7_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    """What can be read back from the examples of all conversations and of conversation -1."""
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    return chat.digest(chat.examples(chat.conversations(rows.unionByName(more))))


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality scores of all documents by the learnt rules."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    sample = labelled_sample(docs, labels, "quality", 4, 2, rule_ensemble.TRAINING_ROWS)
    return rule_ensemble.scored(docs, rule_ensemble.learn(sample)).select(
        "doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score",
        (F.col("score") >= LEAST_SCORE).cast("int").alias("predicted"),
    )


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark passages in all documents."""
    found = decontamination.matches(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Base counts of all documents, and whether their language's and source's fences hold."""
    return quality_rules.judged(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Whitened coordinates of all embeddings on their first eight principal directions."""
    return whitening.whitened(table(spark, folder, "embeddings")).select(
        "vec_id", "component", "n", F.col("deviation").try_cast("long").alias("deviation"),
        "whitened", "explained", "identity_error",
    )


def op12_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of all documents and their groups at three differing bits."""
    return simhash.simhash_groups(table(spark, folder, "documents"))


def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    """What five filters remove from all documents at every step of every order, by language."""
    cells = filter_audit.mask_cells(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return filter_audit.audit(cells).drop("letter")


QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_token_counts, op3_sharding, op4_class_ngrams, op5_near_duplicates,
        op6_mixing, op7_chat_formatting, op8_quality, op9_decontamination, op10_quality_rules,
        op11_whitening, op12_simhash, op13_filter_audit,
    )
}

__all__ = ["QUERIES", "SQL"]
