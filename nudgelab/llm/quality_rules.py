"""Quality rules with thresholds learnt per language and source.

The base counts of a text come from one pass over its bytes. Every metric feeds a mergeable
quantile sketch (logarithmic buckets of relative width ``ACCURACY``; merging adds counts, so any
order and any split of the rows gives the same sketch). A group's quantiles count as many times as it
has rows, those of the merged sketch of its language ``PRIOR`` times, and so do, for a language, those
of all rows: a small group is close to its language, a large one speaks for itself, and nothing
switches in between. Fences lie outside the bulk of the values, as far as its own spread says.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nudgelab.llm.common import as_batch, quoted
from nudgelab.llm.words import edges, mix, pieces, split, text_bytes, windows
from nudgelab.llm.words import _SPACE as WORD_BYTES
from nudgelab.session import materialize

ACCURACY = 0.01
#: Rows that the next coarser sketch counts for.
PRIOR = 200
#: A fence is this many times the spread beyond it: the distance from the median to the first of the
#: upper (lower) quantiles that differs from it.
FENCE = 3.0
UPPER = {"u1": 0.9, "u2": 0.95, "u3": 0.99, "u4": 0.999}
LOWER = {"l1": 0.1, "l2": 0.05, "l3": 0.01, "l4": 0.001}
#: metric -> whether low values fail too
METRICS = {"symbol_share": False, "duplicate_line_share": False, "repeat_share": False, "word_length": True}
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
_BASE = "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in _COUNTS)


def base_counts(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words).

    Words end at white space; ``n_lines`` counts the lines with a word. Null and empty texts
    count nothing. ``lang`` and ``source`` may be missing from ``docs`` and are null then.
    """
    there = {c.lower() for c in docs.columns}
    column = lambda c, kind: (F.col(quoted(c)) if c in there else F.lit(None)).cast(kind).alias(c)
    rows = docs.select(
        column("doc_id", "long"), column("lang", "string"), column("source", "string"),
        column("text", "string"),
    )
    return rows.mapInArrow(_count_batches, _BASE)


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("doc_id", pa.int64()), ("lang", pa.string()), ("source", pa.string())]
        + [(c, pa.int64()) for c in _COUNTS]
    )
    for piece in pieces(batches, "text"):
        texts = piece.column("text")
        counts = dict(zip(_COUNTS, count_texts(texts), strict=True))
        kept = {c: piece.column(c) for c in ("doc_id", "lang", "source")}
        yield as_batch(kept | counts, schema)


def count_texts(texts: pa.Array) -> list[np.ndarray]:
    """The counts of ``_COUNTS`` for every text."""
    data, offsets = text_bytes(texts)
    total = lambda mask: np.concatenate([[0], np.cumsum(mask)])[offsets]
    mask = WORD_BYTES[data]
    chars = np.diff(total(mask & ((data & 0xC0) != 0x80)))
    symbols = np.diff(total(_SYMBOLS[data]))
    words = split(texts, lower=False)
    n_words = np.diff(words.bounds)
    starts, ends = edges(data != 10, offsets)
    inside = np.concatenate([[0], np.cumsum(mask)])
    full = inside[ends] > inside[starts]
    starts, ends = starts[full], ends[full]
    owner = np.searchsorted(offsets, starts, side="right") - 1
    in_lines = np.zeros(len(data) + 1, dtype=np.int8)
    in_lines[starts] += 1
    np.add.at(in_lines, ends, -1)
    at = np.concatenate([[0], np.cumsum(ends - starts)])
    lines = pa.Array.from_buffers(
        pa.large_binary(), len(starts),
        [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data[np.cumsum(in_lines[:-1]) > 0])],
    ).dictionary_encode()
    n_lines = np.bincount(owner, minlength=len(n_words))
    different = np.unique(owner * (len(lines.dictionary) + 1) + lines.indices.to_numpy())
    distinct = np.bincount(different // (len(lines.dictionary) + 1), minlength=len(n_words))
    return [n_words, chars, symbols, n_lines, n_lines - distinct, repeated_words(words)]


def repeated_words(words, width: int = 5) -> np.ndarray:
    """Words inside ``width``-word windows that a text holds at least twice."""
    hashed, at = windows(words.hashes(), words.bounds, width)
    owner = np.searchsorted(words.bounds, at, side="right") - 1
    keys = mix(hashed + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keys)
    keys = keys[order]
    same = keys[1:] == keys[:-1]
    again = np.zeros(len(keys), dtype=bool)
    again[1:] |= same
    again[:-1] |= same
    first = at[order[again]]
    depth = np.zeros(len(words.codes) + 1, dtype=np.int64)
    depth[first] += 1
    np.add.at(depth, first + width, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(depth)[:-1] > 0)])
    return np.diff(covered[words.bounds])


def with_metrics(counts: DataFrame) -> DataFrame:
    over = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    return counts.withColumns({
        "symbol_share": over("n_symbols", "n_words"),
        "duplicate_line_share": over("n_dup_lines", "n_lines"),
        "repeat_share": over("n_repeat_words", "n_words"),
        "word_length": over("word_chars", "n_words"),
    })


_GAMMA = (1 + ACCURACY) / (1 - ACCURACY)


def bucket(value: Column) -> Column:
    """The sketch bucket of a value: null for 0, else the power of gamma at or above it."""
    return F.when(value > 0, F.ceil(F.log(value) / F.lit(math.log(_GAMMA))).cast("int"))


def bucket_value(number: Column) -> Column:
    power = F.pow(F.lit(_GAMMA), number.cast("double"))
    return F.coalesce(power * F.lit(2 / (_GAMMA + 1)), F.lit(0.0))


def sketches(metrics: DataFrame, by: list[str]) -> DataFrame:
    """(``by``, metric, bucket, n): the sketch of every metric in every group."""
    pairs = F.array(*[
        F.struct(F.lit(m).alias("metric"), bucket(F.col(m)).alias("bucket")) for m in METRICS
    ])
    rows = metrics.select(*by, F.inline(pairs))
    return rows.groupBy(*by, "metric", "bucket").agg(F.count(F.lit(1)).alias("n"))


def merged(parts: DataFrame, by: list[str]) -> DataFrame:
    """Sketches of coarser groups, by adding the counts of finer ones."""
    return parts.groupBy(*by, "metric", "bucket").agg(F.sum("n").alias("n"))


def quantiles(parts: DataFrame, by: list[str], wanted: dict[str, float]) -> DataFrame:
    """(``by``, metric, rows, one column per wanted quantile), within ACCURACY of the value."""
    whole = Window.partitionBy(*by, "metric")
    upto = F.sum("n").over(whole.orderBy(F.col("bucket").asc_nulls_first()))
    ranked = parts.withColumn("upto", upto).withColumn("rows", F.sum("n").over(whole))
    picks = [
        F.min(F.when(F.col("upto") > q * (F.col("rows") - 1), F.struct(
            F.col("upto"), bucket_value(F.col("bucket")).alias("value"))))["value"].alias(name)
        for name, q in wanted.items()
    ]
    return ranked.groupBy(*by, "metric").agg(F.max("rows").alias("rows"), *picks)


def blended(own: Column, rows: Column, coarser: Column) -> Column:
    """A quantile of ``rows`` values drawn towards that of the coarser group."""
    return (own * rows + coarser * PRIOR) / (rows + PRIOR)


def thresholds(metrics: DataFrame) -> DataFrame:
    """(lang, source, metric, low, high) for every language and source that occurs.

    ``low`` is null for metrics that only fail high; a side without any spread has no fence (null).
    """
    groups, fine = ["lang", "source"], materialize(sketches(metrics, ["lang", "source"]))
    wanted = {"median": 0.5} | UPPER | LOWER
    own = quantiles(fine, groups, wanted)
    of_lang = quantiles(merged(fine, ["lang"]), ["lang"], wanted)
    of_all = quantiles(merged(fine, []), [], wanted)
    rename = lambda df, tag: df.select(
        *[F.col(c).alias(f"{tag}_{c}") for c in df.columns]
    )
    a, b, c = rename(own, "own"), rename(of_lang, "lang"), rename(of_all, "all")
    joined = a.join(
        b, F.col("own_lang").eqNullSafe(F.col("lang_lang"))
        & (F.col("own_metric") == F.col("lang_metric")),
    ).join(c, F.col("own_metric") == F.col("all_metric"))
    of_language = lambda q: blended(F.col(f"lang_{q}"), F.col("lang_rows"), F.col(f"all_{q}"))
    drawn = joined.select(
        F.col("own_lang").alias("lang"), F.col("own_source").alias("source"),
        F.col("own_metric").alias("metric"),
        *[blended(F.col(f"own_{q}"), F.col("own_rows"), of_language(q)).alias(q) for q in wanted],
    )
    middle = F.col("median")
    first = lambda names, differs: F.coalesce(*[F.when(differs(F.col(q)), F.col(q)) for q in names])
    upper, lower = first(UPPER, lambda q: q > middle), first(LOWER, lambda q: q < middle)
    two_sided = F.col("metric").isin([m for m, both in METRICS.items() if both])
    return drawn.select(
        "lang", "source", "metric",
        F.when(two_sided, lower - FENCE * (middle - lower)).alias("low"),
        (upper + FENCE * (upper - middle)).alias("high"),
    )


def judged(docs: DataFrame) -> DataFrame:
    """Return the base counts with base_failed, failed (names of broken fences) and kept.

    ``base_failed``: fewer than 10 words, or more than 20 % of the words in repeated windows.
    ``kept`` is false for those and for rows outside any fence of their language and source.
    Null ids, languages and sources are values of their own; repeated rows count each; an empty
    table gives no rows; columns other than doc_id, lang, source and text are not read.
    """
    rows = materialize(with_metrics(base_counts(docs)))
    fences = thresholds(rows).groupBy("lang", "source").agg(
        *[F.max(F.when(F.col("metric") == m, F.col(end))).alias(f"{m}_{end}")
          for m in METRICS for end in ("low", "high")]
    ).withColumnsRenamed({"lang": "its_lang", "source": "its_source"})
    joined = rows.join(
        fences, rows["lang"].eqNullSafe(fences["its_lang"])
        & rows["source"].eqNullSafe(fences["its_source"]), "left",
    )
    broken = F.array_compact(F.array(*[
        F.when(F.coalesce(F.col(m) > F.col(f"{m}_high"), F.lit(False))
               | F.coalesce(F.col(m) < F.col(f"{m}_low"), F.lit(False)), F.lit(m)) for m in METRICS
    ]))
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return joined.select(
        "doc_id", "lang", "source", *_COUNTS, base_failed.alias("base_failed"),
        broken.alias("failed"), (~base_failed & (F.size(broken) == 0)).alias("kept"),
    )
