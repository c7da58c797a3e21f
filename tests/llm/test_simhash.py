"""Fingerprints, anchors and links against plain versions."""

from __future__ import annotations

import random
import sys
from itertools import combinations
from pathlib import Path

import numpy as np
import pytest
import xxhash

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from nudgelab.llm import simhash  # noqa: E402
from nudgelab.llm.components import components  # noqa: E402
from nudgelab.llm.covering import GOLAY, HAMMING, Anchors, CyclicCode  # noqa: E402

DOCS = "doc_id long, text string, fingerprint string, component_id int, node int"


def plain_anchors(word, anchors):
    """The nearest anchors of all words within reach, tried one by one."""
    used = sum(c.length for c in anchors.codes)
    found = set()
    for f in range(anchors.reach + 1):
        for bits in combinations(range(used), f):
            moved, start, number = word ^ sum(1 << b for b in bits), 0, 0
            for code in anchors.codes:
                part = np.array([(moved >> start) & ((1 << code.length) - 1)])
                nearest = int(part[0] ^ code.leaders[code.syndromes(part)[0]])
                number = number << (code.length - code.checks) | nearest >> code.checks
                start += code.length
            found.add(number)
    return found


def plain_fingerprint(text):
    words = brute.WORD.findall(brute.lower(text))
    runs = [words[k : k + 3] for k in range(len(words) - 2)] if len(words) >= 3 else [words] * bool(words)
    hashes = [xxhash.xxh64_intdigest(" ".join(r).encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(marks, ids, threshold=3):
    """Smallest id reachable, for rows of (fingerprint, id)."""
    top = list(range(len(marks)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i, j in combinations(range(len(marks)), 2):
        if (marks[i] ^ marks[j]).bit_count() <= threshold or ids[i] == ids[j]:
            a, b = root(i), root(j)
            top[max(a, b)] = min(a, b)
    least = {}
    for i, x in enumerate(ids):
        least[root(i)] = min(x, least.get(root(i), x))
    return [least[root(i)] for i in range(len(marks))]


@pytest.mark.parametrize("code", [GOLAY, HAMMING])
def test_codes_are_perfect(code):
    """Every word lies within the radius of exactly one codeword: the balls fill the space."""
    weights = [x.bit_count() for x in code.leaders.tolist()]
    assert max(weights) == code.radius and len(set(code.leaders.tolist())) == 1 << code.checks


def test_other_polynomials_are_refused():
    with pytest.raises(ValueError, match="not perfect"):
        _ = CyclicCode(7, 0b11111, 1).leaders


def test_anchors_are_the_nearest_of_all_words_in_reach():
    rng = random.Random(3)
    anchors = Anchors(3)
    words = [rng.getrandbits(64) for _ in range(12)] + [0, 2**64 - 1]
    places, numbers = anchors.of(np.array(words, dtype=np.uint64))
    for k, word in enumerate(words):
        mine = numbers[places == k].tolist()
        assert len(mine) == len(set(mine)) and set(mine) == plain_anchors(word, anchors)


@pytest.mark.parametrize("threshold", [0, 1, 2, 3, 4])
def test_any_two_words_within_the_threshold_share_an_anchor(threshold):
    rng = random.Random(threshold)
    anchors = Anchors(threshold)
    for _ in range(300):
        x = rng.getrandbits(64)
        y = x ^ sum(1 << b for b in rng.sample(range(64), threshold))
        places, numbers = anchors.of(np.array([x, y], dtype=np.uint64))
        assert set(numbers[places == 0].tolist()) & set(numbers[places == 1].tolist())


def test_fingerprints_and_groups_of_odd_rows(spark):
    long = " ".join(f"w{i % 977}" for i in range(90_000))
    rows = [
        (1, None), (2, ""), (3, " \n\t"), (4, "One two THREE four"), (5, "one two three four"),
        (5, "one two three four"), (6, "É\x0bé x"), (7, "two words"), (8, "w" * 200_000), (9, long),
        (None, "one two three four"), (None, None), (10, "a b c a b c a b c"), (7, "another text"),
        (11, "another text"), (12, long + " more"),
    ]
    docs = spark.createDataFrame([(*r, "f", 0, 0) for r in rows], DOCS)
    got = simhash.simhash_groups(docs).collect()
    assert len(got) == len(rows)
    marks = [plain_fingerprint(t) for _, t in rows]
    known = [(m, i) for m, (i, _) in zip(marks, rows, strict=True) if i is not None]
    tops = plain_components([m for m, _ in known], [i for _, i in known])
    want = sorted((i, f"{m:016x}", top) for (m, i), top in zip(known, tops, strict=True))
    assert sorted(tuple(r) for r in got if r.doc_id is not None) == want
    without = sorted((r.fingerprint, r.component_id) for r in got if r.doc_id is None)
    assert without == sorted(
        (f"{m:016x}", None) for m, (i, _) in zip(marks, rows, strict=True) if i is None
    )
    assert simhash.simhash_groups(docs.where("false")).collect() == []


@pytest.mark.parametrize(("block", "sample"), [(4096, 64), (8, 1), (3, 2)])
def test_links_of_dense_clusters(spark, block, sample):
    """Chains and clouds of fingerprints, also with every crowded anchor cut into chunks."""
    rng = random.Random(block)
    marks = {rng.getrandbits(64) for _ in range(150)}
    for centre in [rng.getrandbits(64) for _ in range(6)]:
        for _ in range(70):
            marks.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))))
        for _ in range(30):
            centre ^= sum(1 << b for b in rng.sample(range(64), 3))
            marks.add(centre)
    marks = sorted(marks)
    rng.shuffle(marks)
    signed = [m - (1 << 64) if m >> 63 else m for m in marks]
    classes = spark.createDataFrame(list(zip(signed, range(len(marks)), strict=True)),
                                    "fingerprint long, node long")
    none = spark.createDataFrame([], "u long, v long")
    found = components(simhash._links(classes, none, 3, block, sample)).collect()
    got = {r.node: r.component for r in found}
    want = plain_components(marks, list(range(len(marks))))
    assert [got.get(i, i) for i in range(len(marks))] == want
    assert len(set(want)) < len(marks)


def test_spanning_links_are_fewer_than_members():
    marks = np.array([1 << k for k in range(60)], dtype=np.uint64)
    links = simhash.spanning_links(marks, np.arange(60), np.arange(60), 3)
    assert len(links) == 59
