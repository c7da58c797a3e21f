"""All five stages against plain versions, on a small folder with odd rows."""

from __future__ import annotations

import collections
import heapq
import math
import random
import re
import sys
import zlib
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from nudgelab.llm import mixing, rule_ensemble  # noqa: E402
from nudgelab.llm.common import labelled_sample  # noqa: E402

corpus_pipeline = pytest.importorskip("corpus_pipeline")
STAGES = dict(corpus_pipeline.STAGES)


# -- plain versions


def plain_statistics(text):
    """Every statistic by its definition."""
    text = text or ""
    words, lower = brute.WORD.findall(text), brute.WORD.findall(brute.lower(text))
    lines = [x for x in text.split("\n") if brute.WORD.search(x)]
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often, hit = collections.Counter(runs), set()
    for i, r in enumerate(runs):
        if often[r] > 1:
            hit.update(range(i, i + 5))
    n, chars = len(words), sum(map(len, words))
    upper, letters = len(re.findall("[A-Z]", text)), len(re.findall("[A-Za-z]", text))
    high = sum(b >= 0x80 for b in text.encode())
    over = lambda a, b: a / b if b else 0.0
    return (
        n, len(lines), over(chars, n), over(sum(c in "#*$%&|<>" for c in text), n), over(text.count("|"), n),
        over(len(lines) - len(set(lines)), len(lines)), over(len(hit), n), over(len(set(lower)), n),
        over(upper, letters), over(len(re.findall("[0-9]", text)), n), over(text.count("."), n),
        over(text.count("!"), n), over(n, len(lines)), over(high, chars),
        over(sum(a == b for a, b in zip(lower, lower[1:], strict=False)), n),
    )


def plain_score(model, text):
    found = dict(zip(rule_ensemble.STATISTICS, plain_statistics(text), strict=True))
    margin = model.bias + sum(
        w for rule, w in model.rules if all(above < found[k] <= upto for k, above, upto in rule.bounds)
    )
    return 1 / (1 + math.exp(-margin))


def plain_deduplicated(rows):
    """The rows' numbers that stay: rows of one id are one document, the first by hash stays."""
    sets = [brute.shingles(r["text"], 5) for r in rows]
    top = list(range(len(rows)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for j, b in enumerate(rows):
        for i, a in enumerate(rows[:j]):
            if a["doc_id"] is None or b["doc_id"] is None:
                continue
            both = len(sets[i] & sets[j])
            if a["doc_id"] == b["doc_id"] or both and 100 * both >= 80 * len(sets[i] | sets[j]):
                top[root(i)] = root(j)
    least = {}
    for i, r in enumerate(rows):
        if r["doc_id"] is not None:
            least[root(i)] = min(r["doc_id"], least.get(root(i), r["doc_id"]))
    return collections.Counter({x: 1 for x in least.values()} | {None: sum(r["doc_id"] is None for r in rows)})


def plain_cut(text, windows):
    """The text without hit words, from the first to the last of each run; None if no word is left."""
    if text is None:
        return text
    spots = [m.span() for m in brute.ALNUM.finditer(brute.lower(text))]
    words = [brute.lower(text)[a:b] for a, b in spots]
    hit = [False] * len(words)
    for n in {len(w) for w in windows}:
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in windows:
                hit[i : i + n] = [True] * n
    if not any(hit):
        return text
    if all(hit):
        return None
    out, at, i = [], 0, 0
    while i < len(words):
        if hit[i]:
            j = i
            while j + 1 < len(words) and hit[j + 1]:
                j += 1
            out.append(text[at : spots[i][0]])
            at, i = spots[j][1], j
        i += 1
    return "".join(out) + text[at:]


def plain_schedule(weights, slots):
    """Earliest deadline first, one block a slot, block by block over any number of slots."""
    period = sum(weights.values())
    given, out = dict.fromkeys(weights, 0), []
    for slot in range(slots):
        ready = [
            (-(-(given[s] + 1) * period // w), s) for s, w in weights.items() if given[s] * period // w <= slot
        ]
        due, source = min(ready)
        assert slot < due
        out.append(source)
        given[source] += 1
    return out


# -- tests


def test_statistics_equal_their_definitions(spark):
    rng = random.Random(3)
    bits = ["Word", "word", "a.b", "|", "##", "x!", "é", "ÀB", "12", "\n", "\n\n", "\x0b", " ", "same same", "..."]
    texts = [None, "", " \n ", "one"] + [
        "".join(rng.choice(bits) + rng.choice([" ", "", "\n", "  "]) for _ in range(rng.randrange(60))) for _ in range(200)
    ]
    found = rule_ensemble.text_statistics(pa.array(texts))
    for i, text in enumerate(texts):
        got = [found[c][i] for c in rule_ensemble.STATISTICS]
        assert got == pytest.approx(list(plain_statistics(text)))


@pytest.mark.parametrize("weights", [{"a": 1, "b": 1}, {"a": 7, "b": 2, "c": 1}, {"x": 13, "y": 5, "z": 5, "q": 2}])
def test_schedule_is_the_plain_earliest_deadline_first(weights):
    """Over three hyperperiods, the one table gives what block after block would."""
    period = sum(weights.values())
    table = sorted(mixing.schedule(weights), key=lambda r: r[2])
    assert [s for s, _, _ in table] * 3 == plain_schedule(weights, 3 * period)
    assert heapq.nsmallest(1, [slot for *_, slot in table]) == [0]


@pytest.fixture(scope="module")
def small(spark, folder, tmp_path_factory):
    """A folder of documents with odd rows, their labels and a benchmark."""
    path = tmp_path_factory.mktemp("corpus")
    given = pq.read_table(f"{folder}/documents.parquet").slice(0, 90).to_pylist()
    rng = random.Random(4)
    line = [f"bench{i}" for i in range(14)]
    base = [f"prose{i}" for i in range(120)]
    near = base[:60] + ["other"] + base[61:]

    def row(i, text, source="web"):
        return {"doc_id": i, "text": text, "lang": "en", "source": source, "n_chars": len(text or "")}

    rows = given + [
        row(9001, None), row(9002, ""), row(None, "no id here at all but some words"), row(None, None),
        row(9003, " ".join(base)), row(9004, " ".join(near)), row(9005, " ".join(base)), row(9003, " ".join(base)),
        row(9006, "A start. " + " ".join(line) + " the rest of it", None), row(9007, " ".join(line[:10]), "tiny"),
        row(9008, "Short Item"), row(9009, "word " * 4000), row(9010, " ".join(rng.sample(base, 50)) + " end."),
    ]
    kinds = pq.read_schema(f"{folder}/documents.parquet")
    pq.write_table(pa.Table.from_pylist(rows, schema=kinds), path / "documents.parquet")
    pq.write_table(pq.read_table(f"{folder}/labels.parquet"), path / "labels.parquet")
    items = pa.table({"item_id": pa.array([1, None, 3], pa.int64()), "text": [" ".join(line), "short item", None]})
    pq.write_table(items, path / "benchmark.parquet")
    return str(path), rows


def table(spark, rows, kinds):
    return spark.createDataFrame([tuple(r[c] for c in kinds.names) for r in rows], kinds)


def key(rows):
    return collections.Counter(str(sorted((k, str(v)) for k, v in r.items())) for r in rows)


def test_quality_filter(spark, small):
    path, rows = small
    docs = spark.read.parquet(f"{path}/documents.parquet")
    labels = spark.read.parquet(f"{path}/labels.parquet")
    got = [r.asDict() for r in STAGES["quality_filter"](spark, docs, path).collect()]
    model = rule_ensemble.learn(labelled_sample(docs, labels, "quality", 4, 2, rule_ensemble.TRAINING_ROWS))
    assert key(got) == key([r for r in rows if plain_score(model, r["text"]) >= corpus_pipeline.LEAST_QUALITY])
    assert 0 < len(got) < len(rows)


def test_near_deduplication(spark, small):
    path, rows = small
    got = STAGES["near_deduplication"](spark, spark.read.parquet(f"{path}/documents.parquet"), path).collect()
    assert collections.Counter(r.doc_id for r in got) == plain_deduplicated(rows)
    assert key([r.asDict() for r in got]).keys() <= key(rows).keys()
    assert 9004 not in {r.doc_id for r in got} and 9005 not in {r.doc_id for r in got}


def test_benchmark_decontamination(spark, small):
    path, rows = small
    docs = spark.read.parquet(f"{path}/documents.parquet")
    got = [r.asDict() for r in STAGES["benchmark_decontamination"](spark, docs, path).collect()]
    line = [f"bench{i}" for i in range(14)]
    windows = {tuple(line[i : i + 10]) for i in range(5)} | {("short", "item")}
    want = []
    for r in rows:
        cut = plain_cut(r["text"], windows)
        if cut is not None or r["text"] is None:
            want.append(r if cut == r["text"] else r | {"text": cut, "n_chars": len(cut)})
    assert key(got) == key(want) and len(rows) - len(got) == 2


def test_source_mix(spark, small):
    path, rows = small
    docs = spark.read.parquet(f"{path}/documents.parquet")
    got = [r.asDict() for r in STAGES["source_mix"](spark, docs, path).collect()]
    sizes = collections.Counter(r["source"] or "(none)" for r in rows)
    weights = mixing.whole_weights({s: n**mixing.EXPONENT for s, n in sizes.items()})
    left, given, slot = dict(sizes), collections.Counter(), 0
    order = plain_schedule(weights, sum(weights.values()) * 60)
    while any(n > 0 for n in left.values()):
        given[order[slot]] += mixing.BLOCK_ROWS
        left[order[slot]] -= mixing.BLOCK_ROWS
        slot += 1
    mixed = collections.Counter(r["source"] or "(none)" for r in got)
    assert mixed == given
    copies = key(got)
    for k, n in key(rows).items():
        assert copies[k] >= n  # nothing is lost
    for s, n in sizes.items():
        mine = {k: c / key(rows)[k] for k, c in copies.items() if f"('source', '{None if s == '(none)' else s}')" in k}
        assert max(mine.values()) - min(mine.values()) <= 1 and sum(
            c for k, c in copies.items() if k in mine
        ) == mixed[s] and n  # epochs are read evenly


def test_shards(spark, small):
    path, rows = small
    docs = spark.read.parquet(f"{path}/documents.parquet")
    got = STAGES["shards"](spark, docs, path).collect()
    assert key([{c: r[c] for c in docs.columns} for r in got]) == key(rows)
    counts = collections.Counter(r.shard for r in got)
    assert set(counts) == set(range(8)) and max(counts.values()) - min(counts.values()) <= 1
    for shard, n in counts.items():
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(n))
    for r in got:
        assert r.size == len((r.text or "").encode()) + 1 and r.text_crc32 == zlib.crc32((r.text or "").encode())


def test_run_is_the_stages_one_after_another(spark, small):
    """Every stage judges what the one before it kept, and the session is left as it was."""
    path, rows = small
    setting = corpus_pipeline.BATCH_SETTING
    before = spark.conf.get(setting, None)
    got = corpus_pipeline.run(spark, path).collect()
    assert spark.conf.get(setting, None) == before
    ids = {r.doc_id for r in got}
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = [r.asDict() for r in STAGES["quality_filter"](spark, docs, path).collect()]
    stay = plain_deduplicated(kept)
    line = [f"bench{i}" for i in range(14)]
    windows = {tuple(line[i : i + 10]) for i in range(5)} | {("short", "item")}
    whole = {r["doc_id"] for r in kept if r["doc_id"] in stay
             and (r["text"] is None or plain_cut(r["text"], windows) is not None)}
    assert ids == whole and None not in [r.shard for r in got]
    counts = collections.Counter(r.shard for r in got)
    assert max(counts.values()) - min(counts.values()) <= 1


@pytest.mark.parametrize("name", STAGES)
def test_empty_tables_and_clashing_names(spark, small, name):
    path, _ = small
    docs = spark.read.parquet(f"{path}/documents.parquet")
    assert STAGES[name](spark, docs.where("false"), path).count() == 0
    extra = ["row", "place", "slice", "rank", "kept", "component", "weight", "copies", "number"]
    wide = docs.selectExpr("*", *[f"'{c}' as `{c}`" for c in extra])
    out = STAGES[name](spark, wide, path)
    assert out.columns[: len(wide.columns)] == wide.columns
    assert out.select(*extra).distinct().collect() == [tuple(extra)]
