"""Quality by a sparse rule ensemble over text statistics.

Trees grown on labelled texts give candidate rules: every path from a root to a node is a
conjunction of thresholds on statistics. A logistic model with an L1 penalty keeps few of them.
What is left is compiled to one Spark column expression over the statistics, so scoring is a
plain projection.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from nudgelab.llm.common import as_batch, id_and_text, quoted
from nudgelab.llm.quality_rules import count_texts
from nudgelab.llm.words import give_back, pieces, split, text_bytes
from nudgelab.session import materialize

#: Labelled texts the rules are learnt from, about.
TRAINING_ROWS = 20_000
TREES, DEPTH = 24, 4
PENALTY = 0.002
SEED = 7
STATISTICS = (
    "n_words", "n_lines", "mean_word_chars", "symbol_share", "bar_share", "dup_line_share",
    "repeat_share", "distinct_share", "upper_share", "digit_share", "stop_share", "exclaim_share",
    "words_per_line", "non_ascii_share", "same_next_share",
)


def text_statistics(texts: pa.Array) -> dict[str, np.ndarray]:
    """Every statistic of every text; all are 0 for texts without words."""
    data, offsets = text_bytes(texts)
    n_words, chars, symbols, lines, dup_lines, repeats = count_texts(texts)
    count = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[offsets])
    words = split(texts)
    owner = words.owners()
    pairs = np.unique(owner * (len(words.vocabulary) + 1) + words.codes)
    distinct = np.bincount(pairs // (len(words.vocabulary) + 1), minlength=len(n_words))
    same = np.zeros(len(words.codes), dtype=bool)
    same[1:] = (words.codes[1:] == words.codes[:-1]) & (owner[1:] == owner[:-1])
    repeated = np.bincount(owner[same], minlength=len(n_words))
    upper = count((data >= 0x41) & (data <= 0x5A))
    letters = upper + count((data >= 0x61) & (data <= 0x7A))
    of = lambda a, b: np.divide(a, b, out=np.zeros(len(a)), where=np.asarray(b) > 0)
    values = (
        n_words, lines, of(chars, n_words), of(symbols, n_words), of(count(data == 0x7C), n_words),
        of(dup_lines, lines), of(repeats, n_words), of(distinct, n_words), of(upper, letters),
        of(count((data >= 0x30) & (data <= 0x39)), n_words), of(count(data == 0x2E), n_words),
        of(count(data == 0x21), n_words), of(n_words, lines), of(count(data >= 0x80), chars),
        of(repeated, n_words),
    )
    return {k: np.asarray(v, dtype=np.float64) for k, v in zip(STATISTICS, values, strict=True)}


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, one column per statistic), one row per row of ``docs``; null texts are empty."""
    kinds = "doc_id long, " + ", ".join(f"{c} double" for c in STATISTICS)
    schema = pa.schema([("doc_id", pa.int64()), *((c, pa.float64()) for c in STATISTICS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            found = text_statistics(piece.column("text"))
            yield as_batch({"doc_id": piece.column("doc_id")} | found, schema)

    return id_and_text(docs).mapInArrow(run, kinds)


@dataclass(frozen=True, order=True)
class Rule:
    """A conjunction: per statistic the open lower and the closed upper bound."""

    bounds: tuple[tuple[str, float, float], ...]

    def column(self) -> Column:
        found = F.lit(True)
        for name, above, upto in self.bounds:
            if above > -math.inf:
                found = found & (F.col(name) > above)
            if upto < math.inf:
                found = found & (F.col(name) <= upto)
        return found


@dataclass(frozen=True)
class RuleEnsemble:
    """Weighted rules and a bias; ``score`` is the probability of label 1 as a column."""

    rules: tuple[tuple[Rule, float], ...]
    bias: float

    def score(self) -> Column:
        margin = F.lit(self.bias)
        for rule, weight in self.rules:
            margin = margin + F.when(rule.column(), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-margin))


def paths(tree, names: tuple[str, ...]) -> set[Rule]:
    """All paths from the root of a fitted tree to its other nodes."""
    found: set[Rule] = set()

    def walk(node, bounds: dict[str, tuple[float, float]]) -> None:
        if bounds:
            found.add(Rule(tuple((k, *v) for k, v in sorted(bounds.items()))))
        if node.getClass().getSimpleName() != "InternalNode":
            return
        name, cut = names[node.split().featureIndex()], float(node.split().threshold())
        above, upto = bounds.get(name, (-math.inf, math.inf))
        walk(node.leftChild(), bounds | {name: (above, min(upto, cut))})
        walk(node.rightChild(), bounds | {name: (max(above, cut), upto)})

    walk(tree._call_java("rootNode"), {})
    return found


def learn(sample: DataFrame) -> RuleEnsemble:
    """Grow trees on (text, label) rows, turn their paths into rules and weigh them.

    Without rows of both labels there are no rules, and the score is the smoothed share of label 1.
    """
    marks = sample.select("doc_id", F.col("label").cast("double").alias("label"))
    rows = statistics(sample).join(marks.distinct(), "doc_id")
    rows = materialize(rows)
    sizes = {int(r["label"]): r["count"] for r in rows.groupBy("label").count().collect()}
    good, poor = sizes.get(1, 0), sizes.get(0, 0)
    if not good or not poor:
        share = (good + 0.5) / (good + poor + 1)
        return RuleEnsemble((), math.log(share / (1 - share)))
    frame = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(rows)
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, subsamplingRate=0.5, featureSubsetStrategy="onethird",
        minInstancesPerNode=5, seed=SEED,
    ).fit(frame)
    rules = sorted(set().union(*(paths(t, STATISTICS) for t in forest.trees)))
    if not rules:
        share = good / (good + poor)
        return RuleEnsemble((), math.log(share / (1 - share)))
    named = rows.select(
        "label", *[r.column().cast("double").alias(f"r{i}") for i, r in enumerate(rules)]
    )
    assembled = VectorAssembler(
        inputCols=[f"r{i}" for i in range(len(rules))], outputCol="features"
    ).transform(named)
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=PENALTY, maxIter=60)
    fit = lasso.fit(materialize(assembled.select("label", "features")))
    kept = tuple(
        (r, float(w)) for r, w in zip(rules, fit.coefficients.toArray(), strict=True) if w != 0.0
    )
    return RuleEnsemble(kept, float(fit.intercept))


def scored(docs: DataFrame, model: RuleEnsemble) -> DataFrame:
    """(doc_id, score) for every row; score is between 0 and 1, empty texts included.

    Null ids and repeated rows are answered like any other; other columns are not read.
    """
    return statistics(docs).select("doc_id", model.score().alias("score"))


def accepted(docs: DataFrame, model: RuleEnsemble, least: float = 0.7) -> DataFrame:
    """The rows of ``docs`` whose texts score ``least`` or more, all columns as they were."""
    names = [c.lower() for c in docs.columns]
    row = F.struct(*[docs[quoted(c)] for c in docs.columns]).alias("row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The text is read inside the row, so it travels once.
        both = (
            pa.RecordBatch.from_arrays(
                [b.column(0), b.column(0).field(names.index("text"))], names=["row", "text"]
            )
            for b in batches
        )
        for piece in pieces(both, "text"):
            found = text_statistics(piece.column("text"))
            give_back()
            yield pa.RecordBatch.from_arrays(
                [piece.column("row"), *(pa.array(found[c]) for c in STATISTICS)],
                names=["row", *STATISTICS],
            )

    kinds = StructType([
        StructField("row", docs.schema, False), *(StructField(c, DoubleType()) for c in STATISTICS)
    ])
    return docs.select(row).mapInArrow(run, kinds).where(model.score() >= least).select("row.*")
