"""What the operators of this folder share: column hygiene and decision joins."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` less the columns that an operator is about to write, whatever their case."""
    taken = {x.lower() for x in names}
    return df.select(*[df[quoted(c)] for c in df.columns if c.lower() not in taken])


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns a text operator reads, under fixed names."""
    return docs.select(
        F.col(quoted(id_col)).cast("long").alias("doc_id"),
        F.col(quoted(text_col)).cast("string").alias("text"),
    )


def held_out(id_column: Column, parts: int, part: int) -> Column:
    """True for ids whose crc32 (of the id as text) falls into ``part``; null ids are held out."""
    return F.coalesce(F.crc32(id_column.cast("string")) % parts == part, F.lit(True))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, parts: int, part: int, most: int
) -> DataFrame:
    """About ``most`` labelled training rows (text, label), drawn by a hash of the id.

    Rows held out by crc32, null labels and labels other than 0 and 1 are left out; an id
    with several label rows takes the largest label. With fewer rows than ``most`` all are
    taken.
    """
    marks = (
        labels.where(F.col(label).isin(0, 1) & ~held_out(F.col("doc_id"), parts, part))
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
    )
    total = marks.count()
    if total > most:
        share = int(most / total * (1 << 30))
        marks = marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share)
    return id_and_text(docs).join(marks, "doc_id").select("doc_id", "text", "label")


def as_batch(columns: dict[str, object], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [x if isinstance(x, pa.Array) else pa.array(x, schema.field(k).type)
         for k, x in columns.items()],
        schema=schema,
    )


@contextmanager
def arrow_batches(spark: SparkSession, most: str) -> Iterator[None]:
    """Arrow batches of at most ``most`` bytes for the jobs that run inside; then as before.

    Rows that hold whole texts or packed blocks would otherwise fill batches of 64 MB, which the
    executor and its Python worker both hold.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, most)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
