"""The lexicon's matcher and its learning against plain versions."""

from __future__ import annotations

import math
import random
import sys
import time
from pathlib import Path

import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from nudgelab.llm import toxicity  # noqa: E402

DOCS = "doc_id long, text string, weight double, label string"


def plain_hits(text, terms, exceptions):
    """Weights of all hits: every term at every word, less words inside an exception phrase."""
    words = []
    for word in brute.WORD.findall(text or ""):
        a, b = toxicity.folded(word), toxicity.spelled_out(word)
        is_hit = lambda w: any(w == t[:-1] if t.endswith(" ") else w.startswith(t) for t in terms)
        words.append(b if is_hit(b) and not is_hit(a) else a)
    excused = set()
    for phrase in exceptions:
        parts = phrase.split(" ")
        for i in range(len(words) - len(parts) + 1):
            if words[i : i + len(parts)] == parts:
                excused.update(range(i, i + len(parts)))
    return [
        w for i, word in enumerate(words) if i not in excused for t, w in terms.items()
        if (word == t[:-1] if t.endswith(" ") else word.startswith(t))
    ]


def test_hits_equal_a_plain_search(spark):
    rng = random.Random(6)
    bits = ["ba", "b4", "bad", "b@d", "bade", "go", "g0od", "good", "$oo", "boo", "b0o!", "(bad)", "é", "2024", "a$$", "x"]
    terms = {"bad ": 2.0, "boo": 1.5, "good ": 0.5, "ass ": 4.0, "soo ": 1.0, "ba": 0.25}
    exceptions = frozenset(["bad good", "good boo", "x bad"])
    lexicon = toxicity.Lexicon(terms, exceptions, (1.0, 0.5), -1.0)
    rows = [(i, " ".join(rng.choice(bits) for _ in range(rng.randrange(0, 40)))) for i in range(120)]
    rows += [(500, None), (501, ""), (None, "bad"), (502, "bad " * 3000), (7, "bad"), (7, "bad")]
    docs = spark.createDataFrame([(*r, 0.0, "") for r in rows], DOCS)
    got = toxicity.scored(docs, lexicon).collect()
    want = []
    for i, text in rows:
        found = plain_hits(text, terms, exceptions)
        n = len(brute.WORD.findall(text or ""))
        margin = math.log1p(sum(found) * 100 / max(n, 1)) + 0.5 * math.log1p(sum(found)) - 1
        want.append((i or -1, n, len(found), round(sum(found), 9), round(1 / (1 + math.exp(-margin)), 9)))
    assert sorted((r.doc_id or -1, r.n_words, r.n_hits, round(r.weight, 9), round(r.score, 9)) for r in got) == sorted(want)


@pytest.mark.parametrize(
    ("word", "read"), [("$tupid", "stupid"), ("@sshole", "asshole"), ("a$$", "ass"), ("(h4te!", "hatei"), ("2024", "2024")]
)
def test_signs_at_word_ends_may_be_letters(word, read):
    assert toxicity.spelled_out(word) == read
    automaton = toxicity.Lexicon({"stupid ": 1.0, "ass": 1.0, "hate ": 1.0}, frozenset(), (1.0, 0.0), 0.0).automaton()
    texts, _ = toxicity.texts_of(pa.array([word, "hello!", "hate!"]), automaton)
    assert texts[1:] == [" hello ", " hate "]  # plain punctuation stays punctuation
    assert texts[0].strip() == {"(h4te!": "hate"}.get(word, read)


def test_many_hits_and_exceptions_in_one_text():
    lexicon = toxicity.Lexicon({"bad ": 1.0}, frozenset(["bad luck"]), (1.0, 0.0), 0.0)
    text = " " + "bad luck bad day " * 20_000
    began = time.perf_counter()
    assert len(toxicity.hits(lexicon.automaton(), text)) == 20_000
    assert time.perf_counter() - began < 5


def learnt(spark, rare, toxic_rows, clean_rows):
    rng = random.Random(1)
    rows = [(i, f"insult word{rng.randrange(400)} word{rng.randrange(400)} {'ko' if i < rare else 'so'}", 1)
            for i in range(toxic_rows)]
    rows += [(10_000 + i, f"plain word{rng.randrange(400)} word{rng.randrange(400)} so {i}", 0) for i in range(clean_rows)]
    return toxicity.learn(spark.createDataFrame(rows, "doc_id long, text string, label int"))


@pytest.mark.parametrize(("toxic", "clean"), [(30, 300), (400, 4000)])
def test_rare_terms_count_by_evidence_not_by_share(spark, toxic, clean):
    """Eight texts with a two-letter word are a term, however many other toxic texts there are."""
    lexicon = learnt(spark, 8, toxic, clean)
    assert "ko " in lexicon.terms and any(t.startswith("insu") for t in lexicon.terms)
    assert not any(t.startswith("word") for t in lexicon.terms)


def test_learning_without_labels_or_hits(spark):
    none = toxicity.learn(spark.createDataFrame([], "doc_id long, text string, label int"))
    docs = spark.createDataFrame([(1, "any text", 0.0, "")], DOCS)
    assert none.terms == {} and toxicity.scored(docs, none).first().score == 0.5
    same = spark.createDataFrame([(i, f"t{i}", i % 2) for i in range(40)], "doc_id long, text string, label int")
    assert toxicity.learn(same).terms == {}
