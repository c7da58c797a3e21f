"""Near-duplicates against all pairs: border similarities, hot groups, odd rows."""

from __future__ import annotations

import random
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from nudgelab.llm import near_duplicates as near  # noqa: E402
from nudgelab.llm.components import components  # noqa: E402
from nudgelab.llm.sketches import shingle_sets, sketch  # noqa: E402
from nudgelab.llm.words import split  # noqa: E402

SCHEMA = "doc_id long, text string"


def answers(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def expected(rows, width):
    sets = {i: brute.shingles(t, width) for i, t in rows}
    tops = brute.components(sets)
    return {i: (len(sets[i]), tops[i], tops[i] == i) for i in sets}


@pytest.fixture(scope="module")
def variants():
    """Variants of one text whose similarities lie on both sides of the threshold."""
    rng = random.Random(3)
    base = [f"w{rng.randrange(900)}" for _ in range(120)]
    rows = []
    for i in range(260):
        words = list(base)
        for _ in range(rng.randrange(0, 14)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        rows.append((1000 - i, " ".join(words)))
    rows += [(2000 + i, " ".join(f"y{rng.randrange(10**6)}" for _ in range(60))) for i in range(40)]
    return rows


@pytest.mark.parametrize("block", [16, near.BLOCK])
@pytest.mark.parametrize("width", [2, 5])
def test_variants_of_one_text(spark, variants, width, block, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", block)
    docs = spark.createDataFrame(variants, SCHEMA)
    assert answers(near.near_duplicates(docs, width=width)) == expected(variants, width)


def test_odd_rows(spark):
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "a b c"),
        (8, "A  B\nC"), (9, "é É"), (10, "x " * 5000), (11, "x " * 4000),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert answers(near.near_duplicates(docs, width=2)) == expected(rows, 2)


def test_repeated_and_null_ids(spark):
    rows = [(7, "a b c d"), (7, "a b c d"), (7, "k l m n"), (3, "k l m n"), (None, "a b c d"),
            (9, "q r s t")]
    out = near.near_duplicates(spark.createDataFrame(rows, SCHEMA), width=2).collect()
    assert len(out) == 6
    assert {(r.doc_id, r.component_id, r.kept) for r in out} == {
        (7, 3, False), (3, 3, True), (None, None, True), (9, 9, True)
    }


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert near.near_duplicates(docs).count() == 0
    assert near.deduplicated(docs).count() == 0


def test_deduplicated_keeps_columns_and_one_of_each(spark):
    rows = [(1, "a b c d e f", "x"), (2, "A b c d e f", "y"), (3, "q r s t u v", None),
            (4, None, "z"), (4, None, "z"), (None, "a b c d e f", "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    out = near.deduplicated(docs)
    assert out.columns == docs.columns
    assert sorted(out.select("doc_id").collect(), key=str) == sorted(
        [(1,), (3,), (4,), (None,)], key=str
    )


def test_names_of_other_columns_do_not_matter(spark):
    names = ["__id", "__kept", "__rows", "__row", "doc_id", "TEXT", "stays", "row", "c0", "kept", "node"]
    rows = [[f"{n}{i}" for n in names] for i in range(6)]
    for i, r in enumerate(rows):
        r[4], r[5] = [1, 2, 3, 3, 4, None][i], ["a b c d e f", "a b c d e f", "x y z", "x y", "u v w", "u v w"][i]
    kinds = ", ".join(f"`{n}` {'long' if n == 'doc_id' else 'string'}" for n in names)
    docs = spark.createDataFrame([tuple(r) for r in rows], kinds)
    out = near.deduplicated(docs)
    assert out.columns == names
    got = sorted((r["doc_id"] or 0, r["__id"], r["stays"]) for r in out.collect())
    assert [g[0] for g in got] == [0, 1, 3, 4] and all(a[4:] == b[5:] for _, a, b in got)
    assert near.deduplicated(docs.where("false")).count() == 0


def test_repeated_ids_in_a_bucket_of_several_components(spark):
    """Two families of similar texts under the same twelve ids, so buckets hold foreign texts' ids."""
    rng, rows = random.Random(5), []
    base = [f"w{i}" for i in range(400)]
    shared = [f"s{i}" for i in range(200)]
    for i in range(100, 112):
        text = list(base)
        for at in rng.sample(range(400), 60):
            text[at] = f"r{rng.random()}"
        rows.append((i, " ".join(text)))
        rows.append((i, " ".join(shared + [f"t{i}-{k}" for k in range(60)])))
    rows += [(200 + i, " ".join(base[: 390 - i])) for i in range(6)]
    got = near.near_duplicates(spark.createDataFrame(rows, SCHEMA), width=2).collect()
    assert len(got) == len(rows)
    sets = [brute.shingles(t, 2) for _, t in rows]
    top = {i: i for i, _ in rows}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for j, (b, _) in enumerate(rows):
        for i, (a, _) in enumerate(rows[:j]):
            both = len(sets[i] & sets[j])
            if 100 * both >= 80 * len(sets[i] | sets[j]):
                x, y = root(a), root(b)
                top[max(x, y)] = min(x, y)
    assert {r.doc_id: r.component_id for r in got} == {i: root(i) for i, _ in rows}


@pytest.mark.parametrize(("few_links", "few_nodes"), [(0, 1), (0, 100), (100_000, 1)])
def test_components_of_random_links(spark, monkeypatch, few_links, few_nodes):
    """Minima joined by shuffle, those of nodes with several links by broadcast, and all by broadcast."""
    from nudgelab.llm import components as module

    monkeypatch.setattr(module, "FEW_LINKS", few_links)
    monkeypatch.setattr(module, "FEW_NODES", few_nodes)
    rng = random.Random(few_nodes)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(230)]
    links += [(7, 1000 + i) for i in range(80)]
    top = list(range(1100))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for u, v in links:
        a, b = root(u), root(v)
        top[max(a, b)] = min(a, b)
    got = dict(components(spark.createDataFrame(links, "u long, v long")).collect())
    linked = {x for u, v in links if u != v for x in (u, v)}
    assert got == {i: root(i) for i in linked}


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(5, 5)]
    got = dict(components(spark.createDataFrame(links, "u long, v long")).collect())
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}


def test_sketch_fills_and_estimates():
    rng = random.Random(1)
    words = [f"a{i}" for i in range(400)]
    other = words[:300] + [f"b{i}" for i in range(100)]
    texts = [" ".join(words), " ".join(other), "single", ""]
    rng.shuffle(texts[:0])
    sets = shingle_sets(split(pa.array(texts)), 2)
    made = sketch(sets, 392)
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    assert (made[:3] != empty).all() and (made[3] == empty).all()
    real = len(brute.shingles(texts[0], 2) & brute.shingles(texts[1], 2)) / len(
        brute.shingles(texts[0], 2) | brute.shingles(texts[1], 2)
    )
    assert abs((made[0] == made[1]).mean() - real) < 0.1
