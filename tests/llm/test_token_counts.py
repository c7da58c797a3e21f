"""The automaton against greedy longest match, and the operator's odd rows."""

from __future__ import annotations

import random
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from nudgelab.llm.registry import VOCABULARY  # noqa: E402
from nudgelab.llm.token_counts import Automaton, load_vocabulary, token_counts, total_tokens  # noqa: E402


def greedy(word, starts, others):
    found, at = 0, 0
    while at < len(word):
        pieces = starts if at == 0 else others
        stop = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
        if stop is None:
            return 0
        found, at = found + 1, stop
    return found


def test_random_vocabularies():
    rng = random.Random(5)
    draw = lambda most: "".join(rng.choice("abc") for _ in range(rng.randrange(1, most)))
    for _ in range(60):
        starts, others = {draw(6) for _ in range(12)}, {draw(6) for _ in range(12)}
        automaton = Automaton.of(sorted(starts), sorted(others))
        for _ in range(200):
            word = draw(14)
            assert automaton.count(word) == greedy(word, starts, others), (word, starts, others)


def test_public_vocabulary_and_odd_rows(spark, folder):
    starts, others = load_vocabulary(VOCABULARY)
    rows = [(-1, "the theory of everything"), (-2, None), (-3, ""), (None, "a  b"),
            (-5, "x" * 70_000), (-6, "the 一丁힣zz")]
    docs = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, n_words int")
    real = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").limit(40)
    rows += [tuple(r) for r in real.collect()]
    docs = docs.select("doc_id", "text").unionByName(real)
    fast, slow = (set(starts), set(others)), {}
    for i, text in rows:
        words = brute.WORD.findall(text or "")
        if i == -5:
            continue
        found = [greedy(w, *fast) for w in words]
        slow[i] = (len(words), sum(x or 1 for x in found), sum(not x for x in found))
    got = {r.doc_id: tuple(r)[1:] for r in token_counts(docs, (starts, others)).collect()}
    assert got.pop(-5)[0] == 1
    assert got == slow


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts(docs, (["a"], ["b"])).count() == 0
    assert tuple(total_tokens(token_counts(docs, (["a"], ["b"]))).first()) == (0, 0, 0)
