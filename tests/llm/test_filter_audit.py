"""The filter audit against a plain loop over all orders, on odd rows."""

from __future__ import annotations

import re
import sys
from itertools import permutations
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from nudgelab.llm import filter_audit  # noqa: E402

DOCS = "doc_id long, text string, lang string, mask int, part int, digest string"
LABELS = "doc_id long, quality int, toxic int"


def failures(rows, row):
    i, text, _ = row
    text = text or ""
    words = brute.WORD.findall(text)
    return [
        len(words) < 200,
        100 * len(set(words)) < 50 * len(words),
        100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
        bool(re.search(r"[#$%&*|]", text)),
        i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in rows),
    ]


def plain(rows, labels):
    out = {}
    for part in {p or "" for _, _, p in rows}:
        own = [(failures(rows, r), r[0]) for r in rows if (r[2] or "") == part]
        good = {i for i, q, _ in labels if q == 1 and i is not None}
        toxic = {i for i, _, t in labels if t == 1 and i is not None}
        shapley = dict.fromkeys("ABCDE", 0)
        lines = {}
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, letter in enumerate(order, 1):
                k = "ABCDE".index(letter)
                gone = [x for x in left if x[0][k]]
                kept = [x for x in left if not x[0][k]]
                lines[order, step] = [
                    len(kept), len(gone), sum(f[k] for f, _ in own) - len(gone),
                    sum(f[k] and sum(f) == 1 for f, _ in own),
                    sum(i in good for _, i in gone), sum(i in toxic for _, i in gone),
                ]
                shapley[letter] += len(gone)
                left = kept
        for (order, step), line in lines.items():
            out[part, order, step] = (*line, shapley[order[step - 1]])
    return out


def test_all_orders_match_a_plain_loop(spark):
    long = " ".join(f"w{i}" for i in range(250))
    rows = [
        (1, None, "en"), (2, "", None), (3, long, "en"), (4, long, "de"), (4, long, "en"),
        (5, long + " $", "en"), (None, long, "en"), (None, None, None), (6, "A B " * 300, ""),
        (7, "a b\x0bc " * 100, "de"), (8, long, None), (9, long + " $", "en"), (10, "É" * 50_000, "de"),
        (11, "ab CD\n" * 20, "en"), (3, "other text", "en"),
    ]
    labels = [(3, 1, 0), (3, 0, 1), (5, None, 1), (9, 1, None), (None, 1, 1), (8, 1, 1), (99, 1, 1)]
    docs = spark.createDataFrame([(*r, 0, 0, "x") for r in rows], DOCS)
    marks = spark.createDataFrame(labels, LABELS)
    got = filter_audit.audit(filter_audit.mask_cells(docs, marks)).collect()
    counts = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    result = {(r.part, r.filter_order, r.step): tuple(r[c] for c in counts) for r in got}
    assert len(result) == len(got) == 600 * 3
    assert result == plain(rows, labels)
    for r in got:
        assert r.letter == r.filter_order[r.step - 1]


def test_empty_tables(spark):
    docs, marks = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert filter_audit.audit(filter_audit.mask_cells(docs, marks)).collect() == []
    one = spark.createDataFrame([(1, "x", "en", 0, 0, "")], DOCS)
    rows = filter_audit.audit(filter_audit.mask_cells(one, marks)).collect()
    assert len(rows) == 600 and {r.shapley for r in rows if r.letter == "A"} == {120}


def test_copies_of_one_text_fold_before_they_meet(spark):
    """A text that is a third of the table meets as one row a part, not as its copies."""
    copies = spark.range(30_000).selectExpr(
        "id doc_id", "if(id % 3 = 0, 'same text', concat('text ', id)) text", "'en' lang",
        "0 mask", "0 part", "'' digest",
    )
    cells = filter_audit.mask_cells(copies, spark.createDataFrame([], LABELS)).collect()
    assert {(r.mask, r.n) for r in cells if r.n} == {(1, 20_001), (17, 9_999)}
