"""Toxicity by a weighted lexicon, matched with one Aho-Corasick automaton.

Texts are folded first: lower case, accents dropped, look-alike letters of other scripts and digits
or signs that stand for letters replaced, punctuation inside words removed. Signs at the ends of a
word are punctuation, unless the word is in the lexicon with them read as letters. The lexicon holds
words and word beginnings with log-odds weights learnt from labelled texts; hits inside an exception
phrase (a word pair around a hit that clean texts hold) do not count. The sum of weights, per 100
words and as such, goes through a logistic curve fitted on the same sample.
"""

from __future__ import annotations

import bisect
import itertools
import math
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Matrices
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nudgelab.llm.common import as_batch, id_and_text
from nudgelab.llm.words import pieces, split
from nudgelab.session import materialize

#: Labelled texts the lexicon and the curve are learnt from, about.
TRAINING_ROWS = 12_000
#: A term needs this many toxic training texts and this log-odds weight. Its texts must also be no
#: work of chance: were labels given at random, at most so many terms are to be expected in all.
MIN_TOXIC, MIN_WEIGHT, CHANCE = 3, 3.5, 5.0
PREFIXES = (4, 5, 6)
#: An exception phrase needs this many clean training texts.
MIN_CLEAN = 3
NEUTRAL = 0.5

# Letters of other scripts that look like Latin ones, and digits and signs that
# stand for letters.
_LOOKALIKES = dict(zip("абвгдеёкмнорстухіјѕԁԛԝαβεηικνορτυχω", "a6brdeekmhopctyxijsdqwabenikvoptuxw", strict=True))
_SUBSTITUTES = dict(zip("01345789@$!|+", "oieastbgasiit", strict=True))
_TRIMMED = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_PUNCTUATION = "".join(c for c in _TRIMMED if c not in _SUBSTITUTES)


def _folding() -> dict[int, str]:
    table = {}
    for code in itertools.chain(range(0xC0, 0x250), range(0x1E00, 0x1F00), range(0xFF21, 0xFF5B)):
        base = unicodedata.normalize("NFKD", chr(code))[0].lower()
        if base.isascii() and base.isalpha():
            table[code] = base
    table |= {ord(a): b for a, b in (_LOOKALIKES | _SUBSTITUTES).items()}
    table |= {ord(c): None for c in _TRIMMED if c not in _SUBSTITUTES}
    # Zero-width characters and soft hyphens inside words.
    return table | dict.fromkeys((0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF))


FOLDING = _folding()


def folded(word: str) -> str:
    """A word as the lexicon sees it; a number is left alone."""
    core = word.strip(_TRIMMED).lower()
    return core if core.isdigit() else core.translate(FOLDING)


def spelled_out(word: str) -> str:
    """The word with the signs at its ends read as letters too (``$tupid``, ``a$$``)."""
    core = word.strip(_PUNCTUATION).lower()
    return folded(word) if core.isdigit() else core.translate(FOLDING)


def folded_words(texts: pa.Array) -> tuple[list[str], list[str], np.ndarray, np.ndarray]:
    """Both foldings of the distinct words, the word numbers of all texts, and where each begins."""
    words = split(texts, lower=False)
    spelled = [w.decode() for w in words.vocabulary.to_pylist()]
    return [folded(w) for w in spelled], [spelled_out(w) for w in spelled], words.codes, words.bounds


@dataclass(frozen=True)
class Lexicon:
    """Terms with weights (a trailing blank: whole words, else beginnings) and exception phrases."""

    terms: dict[str, float]
    exceptions: frozenset[str]
    slopes: tuple[float, float]
    bias: float

    def automaton(self) -> ahocorasick.Automaton | None:
        found = ahocorasick.Automaton()
        for term, weight in self.terms.items():
            found.add_word(f" {term}", (len(term.rstrip()) + 1, weight))
        for phrase in self.exceptions:
            found.add_word(f" {phrase} ", (len(phrase) + 1, None))
        if not len(found):
            return None
        found.make_automaton()
        return found


def hits(automaton, text: str) -> list[tuple[int, int, float]]:
    """(start, end, weight) of the lexicon's hits in a folded text outside exception phrases."""
    found, excused = [], []
    for end, (size, weight) in automaton.iter(text):
        stop = end if text[end] == " " and end else end + 1
        (found if weight is not None else excused).append((stop - size, stop, weight))
    if not excused:
        return found
    # The furthest end of the exceptions that begin at or before a place.
    excused.sort()
    begins = [a for a, _, _ in excused]
    furthest = list(itertools.accumulate((b for _, b, _ in excused), max))

    def counts(hit: tuple[int, int, float]) -> bool:
        at = bisect.bisect_right(begins, hit[0])
        return not at or furthest[at - 1] < hit[1]

    return [h for h in found if counts(h)]


def texts_of(texts: pa.Array, automaton=None) -> tuple[list[str], np.ndarray]:
    """Folded texts (blank-separated, blanks at both ends) and their numbers of words.

    A word with signs at its ends is read with them as letters if only that reading is a hit.
    """
    plain, spelled, codes, bounds = folded_words(texts)
    if automaton:
        hit = lambda word: next((w for _, (_, w) in automaton.iter(f" {word} ") if w is not None), None)
        plain = [b if a != b and hit(a) is None and hit(b) is not None else a
                 for a, b in zip(plain, spelled, strict=True)]
    listed = pa.ListArray.from_arrays(
        pa.array(bounds.astype(np.int32)), pa.array(plain, pa.string()).take(pa.array(codes))
    )
    joined = pa.compute.binary_join(listed, " ").to_pylist()
    return [f" {t} " for t in joined], np.diff(bounds)


def _loads(lexicon: Lexicon):
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hits", pa.int64()),
        ("weight", pa.float64()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for piece in pieces(batches, "text"):
            texts, n_words = texts_of(piece.column("text"), automaton)
            found = [hits(automaton, t) if automaton else [] for t in texts]
            yield as_batch(
                {
                    "doc_id": piece.column("doc_id"), "n_words": n_words,
                    "n_hits": [len(x) for x in found],
                    "weight": [sum(w for _, _, w in x) for x in found],
                },
                schema,
            )

    return run


def loads(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(doc_id, n_words, n_hits, weight): the lexicon's hits in every whole text."""
    kinds = "doc_id long, n_words long, n_hits long, weight double"
    return id_and_text(docs).mapInArrow(_loads(lexicon), kinds)


def density(weight="weight", n_words="n_words"):
    """Weight per 100 words, on a log scale; 0 without hits."""
    return F.log1p(F.col(weight) * 100 / F.greatest(F.col(n_words), F.lit(1)))


def scored(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(doc_id, n_words, n_hits, weight, score) for every row; score is between 0 and 1.

    Null and empty texts have no hits and the score of a clean text. Null ids and repeated rows
    are answered like any other; other columns are not read.
    """
    per_length, total = lexicon.slopes
    margin = density() * per_length + F.log1p("weight") * total + lexicon.bias
    curve = 1 / (1 + F.exp(-margin))
    return loads(docs, lexicon).withColumn("score", curve)


def learn(sample: DataFrame) -> Lexicon:
    """Learn terms, exception phrases and the curve from (text, label) rows.

    Equal texts count once. Without rows of both labels the lexicon is empty and scores are 0.5
    (no labels) or the smoothed share of label 1.
    """
    rows = sample.groupBy(F.sha2("text", 256).alias("key")).agg(
        F.first("text").alias("text"), F.max("label").alias("label"), F.min("doc_id").alias("doc_id")
    )
    rows = materialize(rows)
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    bad, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not bad or not clean:
        share = (bad + 0.5) / (bad + clean + 1)
        return Lexicon({}, frozenset(), (0.0, 0.0), float(np.log(share / (1 - share))))
    terms = _terms(rows, bad, clean)
    found = Lexicon(terms, frozenset(), (0.0, 0.0), 0.0)
    found = Lexicon(terms, _exceptions(rows, found), (0.0, 0.0), 0.0)
    marks = loads(rows, found).join(rows.select("doc_id", "label"), "doc_id")
    frame = VectorAssembler(inputCols=["density", "total"], outputCol="features").transform(
        marks.select(
            density().alias("density"), F.log1p("weight").alias("total"),
            F.col("label").cast("double").alias("label"),
        )
    )
    curve = LogisticRegression(
        regParam=1e-4, maxIter=50, lowerBoundsOnCoefficients=Matrices.dense(1, 2, [0.0, 0.0])
    ).fit(materialize(frame))
    slopes = (float(curve.coefficients[0]), float(curve.coefficients[1]))
    return Lexicon(terms, found.exceptions, slopes, float(curve.intercept))


def _forms(word: str) -> set[str]:
    """The terms that a word is an instance of."""
    return {f"{word} ", *(word[:n] for n in PREFIXES if len(word) > n)} if word else set()


def _terms(rows: DataFrame, bad: int, clean: int) -> dict[str, float]:
    """Words and beginnings that tell toxic from clean texts, each covered by one term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = (Counter(), Counter())
        for piece in pieces(batches, "text"):
            plain, spelled, codes, bounds = folded_words(piece.column("text"))
            forms = [_forms(a) | (_forms(b) if a != b else set()) for a, b in zip(plain, spelled, strict=True)]
            for i, label in enumerate(piece.column("label").to_pylist()):
                own = np.unique(codes[bounds[i] : bounds[i + 1]])
                both[label].update(set().union(*(forms[c] for c in own)))
        terms = list(both[0].keys() | both[1].keys())
        yield pa.RecordBatch.from_pydict(
            {"term": terms, "toxic": [both[1][t] for t in terms], "clean": [both[0][t] for t in terms]},
            schema=pa.schema([("term", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())]),
        )

    counted = (
        rows.select("text", "label")
        .mapInArrow(count, "term string, toxic long, clean long")
        .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )
    weight = F.log((F.col("toxic") + 0.5) / (bad + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    candidates = materialize(counted.where(F.col("toxic") >= MIN_TOXIC))
    share = bad / (bad + clean)
    own = F.col("toxic") / (F.col("toxic") + F.col("clean"))
    # Chernoff's bound on as many toxic texts among the term's texts, by natural logarithm.
    apart = own * F.log(own / share) + F.when(
        own < 1, (1 - own) * F.log((1 - own) / (1 - share))
    ).otherwise(0.0)
    chance = -(F.col("toxic") + F.col("clean")) * apart
    least = math.log(CHANCE / max(1, candidates.count()))
    kept = (
        candidates.withColumn("weight", weight)
        .where((F.col("weight") >= MIN_WEIGHT) & (own > share) & (chance <= least))
        .collect()
    )
    found = {r["term"]: (r["toxic"], r["weight"]) for r in kept}
    return _disjoint(found)


def _disjoint(found: dict[str, tuple[int, float]]) -> dict[str, float]:
    """Of a beginning and its longer forms keep the longer one if it covers nearly as many texts."""
    terms: dict[str, float] = {}
    dropped = set()
    for term in sorted(found, key=len):
        for n in PREFIXES:
            short = term[:n]
            if short == term or short.endswith(" ") or short not in found:
                continue
            if found[term][0] >= 0.9 * found[short][0]:
                dropped.add(short)
    for term, (_, weight) in found.items():
        shorter = [term[:n] for n in PREFIXES if term[:n] != term]
        if term not in dropped and not any(s in found and s not in dropped for s in shorter):
            terms[term] = weight
    return terms


def _exceptions(rows: DataFrame, lexicon: Lexicon) -> frozenset[str]:
    """Word pairs around a hit that clean texts hold, and more often than toxic ones."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        out: dict[str, list] = {"phrase": [], "label": []}
        for piece in pieces(batches, "text"):
            texts, _ = texts_of(piece.column("text"), automaton)
            for text, label in zip(texts, piece.column("label").to_pylist(), strict=True):
                around = set()
                for start, stop, _ in hits(automaton, text) if automaton else ():
                    stop = text.index(" ", stop)
                    left = text.rfind(" ", 0, max(0, start))
                    right = text.find(" ", stop + 1)
                    if left >= 0:
                        around.add(text[left + 1 : stop])
                    if right > 0:
                        around.add(text[start + 1 : right])
                out["phrase"] += around
                out["label"] += [label] * len(around)
        yield pa.RecordBatch.from_pydict(
            out, schema=pa.schema([("phrase", pa.string()), ("label", pa.int32())])
        )

    found = rows.select("text", "label").mapInArrow(pairs, "phrase string, label int")
    kept = (
        found.groupBy("phrase").agg(
            F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean")
        )
        .where((F.col("clean") >= MIN_CLEAN) & (F.col("clean") > F.col("toxic"))).collect()
    )
    return frozenset(r["phrase"] for r in kept)
