"""Latency over time: event-time windows of the request log as its files land.

A window's state is a count, a sum, the extremes and a mergeable quantile sketch (KLL), so it is
bounded whatever the number of requests in the window, and partial states of many tasks, micro-
batches and windows add up. Windows are written once, when the watermark has passed their end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from nudgelab.sources import schemas
from nudgelab.sources.scorelog import timed_requests

WINDOW, LATE = "1 hour", "30 minutes"
#: Size parameter of the sketch. A value at rank q has a true rank of q +- about 1.65 / k^0.9, and
#: windows of up to k requests are exact.
SKETCH_K = 800
SHARES = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
_SECONDS = "processing_time"


def window_states(log: DataFrame, length: str = WINDOW, k: int = SKETCH_K) -> DataFrame:
    """(window_start, window_end, n, total, least, most, sketch) of the measured requests.

    Works on a table and on a stream alike. Requests without a time stamp or a measured time are
    left out, as in the overall statistics; windows without requests have no row.
    """
    timed = timed_requests(log).where("ts IS NOT NULL")
    return (
        timed.groupBy(F.window("ts", length).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(_SECONDS).alias("total"),
            F.min(_SECONDS).alias("least"),
            F.max(_SECONDS).alias("most"),
            F.kll_sketch_agg_double(_SECONDS, F.lit(k)).alias("sketch"),
        )
        .select(
            F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
            "n", "total", "least", "most", "sketch",
        )
    )


def longer_windows(states: DataFrame, length: str, k: int = SKETCH_K) -> DataFrame:
    """States of longer windows from those of shorter ones; the log is not read again.

    ``length`` must be a multiple of the length of the given windows.
    """
    return (
        states.groupBy(F.window("window_start", length).alias("w"))
        .agg(
            F.sum("n").alias("n"),
            F.sum("total").alias("total"),
            F.min("least").alias("least"),
            F.max("most").alias("most"),
            F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"),
        )
        .select(
            F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
            "n", "total", "least", "most", "sketch",
        )
    )


def readings(states: DataFrame, shares: dict[str, float] = SHARES) -> DataFrame:
    """Mean and quantiles of window states.

    A quantile is a request's own time: the smallest whose estimated share of requests at or below
    it reaches the wanted share.
    """
    return states.select(
        "window_start", "window_end", "n", "total", (F.col("total") / F.col("n")).alias("mean"),
        "least", "most", *[_quantile(share).alias(name) for name, share in shares.items()],
    )


def _quantile(share: float) -> Column:
    return F.kll_sketch_get_quantile_double("sketch", F.lit(share))


def start_windows(
    spark: SparkSession, landing: str, target: str, checkpoint: str, length: str = WINDOW,
    late: str = LATE, k: int = SKETCH_K, files_at_once: int | None = None,
) -> StreamingQuery:
    """Fold the log files that have landed into windows, then stop when none is left.

    ``landing`` holds parquet files of the score log's columns. A window is appended to ``target``
    (parquet, each window once) when the latest time stamp seen is ``late`` beyond its end; a
    request that comes after that is dropped. Windows still open stay in the state below
    ``checkpoint`` and go on with the next start.
    """
    log = T.StructType([f for f in schemas.SCORE_LOG.fields if f.name in ("id", "ts", _SECONDS)])
    source = spark.readStream.schema(log).option("recursiveFileLookup", "true")
    if files_at_once:
        source = source.option("maxFilesPerTrigger", files_at_once)
    rows = source.parquet(landing).withColumn("ts", F.col("ts").cast("timestamp"))
    states = window_states(rows.withWatermark("ts", late), length, k)
    return (
        states.writeStream.format("parquet")
        .outputMode("append")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_windows(spark: SparkSession, target: str) -> DataFrame:
    """The windows written so far; none before the first one has closed."""
    kinds = (
        "window_start timestamp, window_end timestamp, n bigint, total double, least double, "
        "most double, sketch binary"
    )
    return spark.read.schema(kinds).parquet(target)
