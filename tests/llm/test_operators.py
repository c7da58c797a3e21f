"""Every operator on odd rows, ties, repeats and empty tables, and against plain versions."""

from __future__ import annotations

import collections
import hashlib
import math
import sys
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from nudgelab.llm import (  # noqa: E402
    chat,
    class_ngrams,
    decontamination,
    mixing,
    quality_rules,
    rule_ensemble,
    sharding,
    toxicity,
)
from nudgelab.llm.fmindex import FMIndex  # noqa: E402
from nudgelab.llm.positions import slice_of, spread_point  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars int, Shard string, rank int"
ODD = [
    (1, None, "en", "a", None, "x", 1), (2, "", None, None, 0, None, None),
    (3, "one two three", "en", "a", 13, "x", 1), (3, "one two three", "en", "a", 13, "x", 1),
    (None, "no id at all", "de", None, 12, None, 2), (None, None, None, None, None, None, None),
    (7, "w" * 200_000, "en", "b", 200_000, "x", 3), (8, "é \n\n é\n é", "fr", "b", 9, "x", 4),
    (9, "long " * 30_000, "fr", "b", 150_000, "x", 4),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def docs(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark, folder):
    return spark.read.parquet(f"{folder}/labels.parquet")


def auc(rows):
    """Chance that a row of label 1 scores above a row of label 0."""
    ones, zeros = ([s for s, y in rows if y == k] for k in (1, 0))
    wins = sum((a > b) + 0.5 * (a == b) for a in ones for b in zeros)
    return wins / (len(ones) * len(zeros))


# -- decontamination


def test_fm_index_counts_and_locates():
    rng = np.random.default_rng(4)
    codes = rng.integers(0, 3, 600).astype(np.int32)
    bounds = np.array([0, 0, 150, 151, 400, 400, 600])
    index = FMIndex(codes, bounds, 3)
    texts = [codes[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    phrases = rng.integers(0, 3, (200, 4)).astype(np.int32)
    lengths = rng.integers(1, 5, 200)
    low, high = index.search(phrases, lengths)
    for p, n, a, b in zip(phrases, lengths, low, high, strict=True):
        real = [
            start + i
            for start, t in zip(index.starts, texts, strict=True)
            for i in range(len(t) - n + 1)
            if (t[i : i + n] == p[:n]).all()
        ]
        assert sorted(index.locate(np.arange(a, b))) == real


def plain_hits(rows, items, window=10):
    wanted = collections.defaultdict(set)
    for item, text in items:
        words = brute.ALNUM.findall(brute.lower(text))
        for i in range(max(1, len(words) - window + 1) if words else 0):
            wanted[tuple(words[i : i + window])].add(str(item))
    out = []
    for doc_id, text in rows:
        words = brute.ALNUM.findall(brute.lower(text))
        hit, found = set(), set()
        for n in {len(w) for w in wanted}:
            for i in range(len(words) - n + 1):
                if tuple(words[i : i + n]) in wanted:
                    found |= wanted[tuple(words[i : i + n])]
                    hit.update(range(i, i + n))
        out.append((doc_id, len(words), len(hit), sorted(found)))
    return sorted(out, key=str)


def test_matches_equal_a_plain_search(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "SHARD_BYTES", 300)
    monkeypatch.setattr(decontamination, "BLOCK_ITEMS", 2)
    line = [f"t{i}" for i in range(14)]
    items = [(1, " ".join(line)), (2, "Short-item here"), (3, None), (4, ""), (5, "t0 t1 t0 t1 t0"),
             (None, "x y"), (2, "again this")]
    rows = [(1, "a " + " ".join(line[:12]).upper() + " b"), (2, "short; ITEM (here) short item here"),
            (3, None), (4, ""), (5, "t0 t1 t0 t1 t0 t1 t0"), (6, " ".join(line * 3)),
            (None, "again this"), (6, " ".join(line * 3)), (8, " ".join(line[:9]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontamination.matches(docs, bench).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in out), key=str)
    want = plain_hits(rows, items)
    assert got == [(i, n, h, [x for x in found if x != "None"]) for i, n, h, found in want]
    for r in out:
        assert sum(s["last"] - s["first"] + 1 for s in r.spans) == r.n_hit


def test_items_without_an_id_are_searched_and_cut(spark):
    """Their words are hit and cut like any others; only the list of items leaves them out."""
    line = " ".join(f"t{i}" for i in range(10))
    bench = spark.createDataFrame([(None, line), (4, "other words")], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"a {line} b other words")], "doc_id long, text string")
    row = decontamination.matches(docs, bench).first()
    assert (row.n_hit, list(row["items"])) == (12, ["4"])
    assert decontamination.decontaminated(docs, bench).first().text == "a  b "


def test_decontaminated_cuts_spans_only(spark, odd):
    bench = spark.createDataFrame([(1, "one two three"), (2, "é é")], "item_id long, text string")
    out = decontamination.decontaminated(odd, bench)
    assert out.schema == odd.schema
    left = [(r.doc_id, r.text) for r in out.collect()]
    assert 3 not in [i for i, _ in left]  # nothing but the passage
    assert (1, None) in left and (2, "") in left and (None, "no id at all") in left
    assert 8 not in [i for i, _ in left]  # its three words are two overlapping passages
    more = spark.createDataFrame([(11, "Keep One, two\tthree. é é; end", 28)], "doc_id long, text string, n_chars int")
    row = decontamination.decontaminated(more, bench).first()
    assert (row.text, row.n_chars) == ("Keep ; end", 10)  # touching passages are one span
    none = bench.limit(0)
    assert decontamination.decontaminated(odd, none).exceptAll(odd).count() == 0
    assert decontamination.matches(odd.limit(0), bench).count() == 0


# -- sharding


def test_shards_are_even_gapless_and_whole(odd, empty):
    out = sharding.sharded(odd, shards=4).collect()
    assert len(out) == len(ODD)
    slots = collections.defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
        assert r.size == len((r.text or "").encode()) + 1
        assert r.text_crc32 == zlib.crc32((r.text or "").encode())
        assert r.law == "rows" and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots[s]) for s in range(4)]
    assert max(counts) - min(counts) <= 1
    assert sharding.sharded(empty).count() == 0


def test_shards_keep_columns_of_any_name(spark):
    """Also those of the working columns; only the answers' own names are replaced."""
    names = ["slice", "place", "inside", "base", "its_slice", "from_rank", "to_rank", "c0", "DOC_ID", "text", "SLOT", "id"]
    rows = [tuple(f"{n}{i}" for n in names[:8]) + (i, f"t{i}", "old", "k") for i in range(40)]
    docs = spark.createDataFrame(rows, ", ".join(f"`{n}` {'long' if n == 'DOC_ID' else 'string'}" for n in names))
    out = sharding.sharded(docs, shards=3)
    assert out.columns == [n for n in names if n != "SLOT"] + list(sharding.ADDED)
    assert sorted(tuple(r)[:9] for r in out.collect()) == sorted(r[:9] for r in rows)


def test_rows_without_an_id_are_no_hot_slice(spark):
    """Thousands of equal rows without an id are dealt over the whole ring, and all are kept."""
    docs = spark.range(6000, numPartitions=8).selectExpr("if(id < 5000, null, id) doc_id", "'same text' text")
    out = sharding.sharded(docs, shards=8)
    counts = {r["shard"]: r["count"] for r in out.groupBy("shard").count().collect()}
    assert sum(counts.values()) == 6000 and set(counts.values()) == {750}
    shuffled = sharding.sharded(docs.repartition(5), shards=8)
    assert shuffled.count() == 6000 and shuffled.select("shard", "slot").distinct().count() == 6000
    place = spread_point(F.col("doc_id"), F.col("text"))
    slices = docs.select(slice_of(place, sharding.SLICE_BITS).alias("s")).groupBy("s").count()
    assert slices.agg(F.max("count")).first()[0] < 10


def test_even_shards_move_a_bounded_share_when_one_is_added(spark):
    """The registered law: sizes one row apart. Filling up costs some movement beyond the new shard."""
    docs = spark.range(40_000).selectExpr("id doc_id", "'t' text")
    before, after = (
        sharding.sharded(docs, shards=n, keep=False).select("doc_id", F.col("shard").alias(f"s{n}")) for n in (8, 9)
    )
    moved = before.join(after, "doc_id").where("s8 <> s9").count() / 40_000
    assert 1 / 9 <= moved < 0.4


def test_ring_follows_the_clockwise_rule():
    sizes = {5: 40, 900: 3, 40_000: 25, 65_535: 30}
    pieces = sharding.allotted(sizes, 4, 0.0)
    per_shard = collections.Counter()
    for _, a, b, shard, base in pieces:
        assert base == per_shard[shard]
        per_shard[shard] += b - a
    assert sum(per_shard.values()) == 98 and max(per_shard.values()) - min(per_shard.values()) <= 1
    orders = sharding.clockwise(sharding.ring(4), 4)
    for spot in sizes:
        own = sorted((a, b, shard) for s, a, b, shard, _ in pieces if s == spot)
        assert own[0][0] == 0 and own[-1][1] == sizes[spot]
        assert all(x[1] == y[0] for x, y in zip(own[:-1], own[1:], strict=True))
        places = [orders[spot].index(shard) for *_, shard in own]
        assert places == sorted(places)


def test_growth_moves_few_rows():
    """With slack, one more shard moves little more than its own share."""
    sizes = dict.fromkeys(range(0, 65_536, 8), 1)

    def owner(shards):
        return {s: shard for s, a, b, shard, _ in sharding.allotted(sizes, shards, 0.25)}

    before, after = owner(8), owner(9)
    moved = sum(before[s] != after[s] for s in sizes)
    assert moved < 0.25 * len(sizes)


# -- mixing


def test_mix_deviates_by_less_than_a_block(spark):
    rows = [(i, f"t{i}", "hot" if i % 3 else f"s{i % 7}") for i in range(900)]
    rows += [(None, None, None), (1, "t1", "hot")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mixed(docs, block_rows=4).collect()
    place = {r.mix_position: r for r in out}
    assert sorted(place) == list(range(len(out)))
    first = [r for r in out if r.mix_epoch == 0]
    assert sorted((str(r.doc_id), str(r.text)) for r in first) == sorted(
        (str(a), str(b)) for a, b, _ in rows
    )
    sizes = collections.Counter("(none)" if s is None else s for _, _, s in rows)
    weights = mixing.whole_weights({s: n**mixing.EXPONENT for s, n in sizes.items()})
    total, given = sum(weights.values()), collections.Counter()
    for slot in range(len(out) // 4):
        block = {place[slot * 4 + k].mix_source for k in range(4)}
        assert len(block) == 1
        given[block.pop()] += 1
        for s, w in weights.items():
            assert abs(given[s] - w * (slot + 1) / total) < 1


def test_mix_settings_and_columns(spark, odd, empty):
    out = mixing.mix_of(odd)
    assert out.columns == odd.columns and out.dtypes == odd.dtypes
    assert out.distinct().count() == odd.distinct().count()
    assert mixing.mix_of(empty).count() == 0
    with pytest.raises(ValueError):
        mixing.mixed(odd, weights={"a": 1.0})
    even = mixing.mixed(odd.where("source is not null"), weights={"a": 1.0, "b": 3.0}, block_rows=1)
    share = {r.mix_source: r["count"] for r in even.groupBy("mix_source").count().collect()}
    assert abs(share["b"] - 3 * share["a"]) <= 3


# -- chat


def test_chat_reads_back_everything(spark):
    said = "</s>[INST] ok [/INST]"
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "yo~1<|end|>|>~"), (1, 2, "user", None),
        (1, 3, "assistant", ""), (1, 4, "user", "bye<"), (2, 0, None, None), (3, 1, "a|>b", "<"),
        (3, 0, "assistant", "é\n<|user|>"), (-1, 0, "user", said), (-1, 1, "assistant", said),
        (4, None, "user", "x"), (4, 2, "assistant", "z"), (4, 2, "assistant", "z"),
        (None, 0, "user", "no id"),
    ] + [(5, i, ("user", "assistant")[i % 2], f"turn {i}") for i in range(150)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    made = chat.examples(chat.conversations(df))
    got = {r.conv_id: r for r in chat.digest(made).collect()}
    groups = collections.defaultdict(list)
    for c, turn, role, text in rows:
        groups[c].append((-1 if turn is None else turn, role or "", text or ""))
    assert set(got) == set(groups)
    for c, turns in groups.items():
        turns.sort()
        told = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert got[c].loss_chars == len(loss)
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    one = made.where("conv_id = 1").orderBy("example").collect()
    assert [r.loss_chars is None for r in one] == [False, False, True]
    assert one[1].formatted.startswith(one[0].formatted)
    assert chat.digest(chat.examples(chat.conversations(df.limit(0)))).count() == 0
    plan = made._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# -- quality rules


def test_counts_and_sketch(odd, empty, docs):
    rows = quality_rules.base_counts(odd.unionByName(docs.limit(60), allowMissingColumns=True))
    texts = [r[1] for r in ODD] + [r.text for r in docs.limit(60).collect()]

    def plain(text):
        words = brute.WORD.findall(text or "")
        runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        often, hit = collections.Counter(runs), set()
        for i, r in enumerate(runs):
            if often[r] > 1:
                hit.update(range(i, i + 5))
        lines = [x for x in (text or "").split("\n") if brute.WORD.search(x)]
        return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
                len(lines), len(lines) - len(set(lines)), len(hit))

    got = sorted(tuple(r)[3:] for r in rows.collect())
    assert got == sorted(plain(t) for t in texts)
    assert quality_rules.judged(empty).count() == 0
    judged = quality_rules.judged(odd)
    assert judged.count() == len(ODD) and judged.where("kept and n_words < 10").count() == 0


def test_sketch_merges_and_is_accurate(spark):
    values = [(("en", "de")[i % 2], float(i * i % 977)) for i in range(4000)]
    df = spark.createDataFrame(values, "lang string, v double").select(
        "lang", *[F.col("v").alias(m) for m in quality_rules.METRICS]
    )
    whole = quality_rules.sketches(df, [])
    parts = quality_rules.merged(quality_rules.sketches(df, ["lang"]), [])
    assert whole.exceptAll(parts).count() == 0 and whole.count() == parts.count()
    wanted = {"a": 0.25, "b": 0.5, "c": 0.9}
    ranked = sorted(v for _, v in values)
    for r in quality_rules.quantiles(whole, [], wanted).collect():
        for name, q in wanted.items():
            real = ranked[math.floor(q * (len(ranked) - 1))]
            assert abs(r[name] - real) <= 0.011 * real + 1e-9


# -- learnt scores


def test_quality_rules_learn_on_held_out_rows(spark, docs, labels, odd, empty, folder):
    big = folder.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{big}/{t}.parquet") for t in ("documents", "labels"))
    from nudgelab.llm.common import held_out, labelled_sample

    # Some toxic labels of this small table mark texts without any telling word.
    for kind, module, parts, part, least in (
        ("quality", rule_ensemble, 4, 2, 0.97), ("toxic", toxicity, 3, 1, 0.85)
    ):
        model = module.learn(labelled_sample(docs, labels, kind, parts, part, 5000))
        scores = module.scored(docs, model).join(labels, "doc_id")
        held = scores.where(held_out(F.col("doc_id"), parts, part)).select("score", kind).collect()
        assert auc([tuple(r) for r in held]) > least
        strange = module.scored(odd, model).collect()
        assert len(strange) == len(ODD) and all(0 <= r.score <= 1 for r in strange)
        assert module.scored(empty, model).count() == 0
        nothing = module.learn(labelled_sample(docs, labels.limit(0), kind, parts, part, 100))
        assert {r.score for r in module.scored(odd, nothing).collect()} == {0.5}
    kept = rule_ensemble.accepted(odd, rule_ensemble.RuleEnsemble((), 9.0))
    assert kept.schema == odd.schema and kept.count() == len(ODD)


def test_rules_hold_exactly_on_their_paths(spark):
    rule = rule_ensemble.Rule((("a", 1.0, 3.0), ("b", -math.inf, 0.5)))
    model = rule_ensemble.RuleEnsemble(((rule, 2.0),), -1.0)
    rows = [(1.0, 0.0), (1.5, 0.5), (3.0, 0.6), (3.0, -7.0)]
    out = spark.createDataFrame(rows, "a double, b double").select("a", "b", model.score().alias("s"))
    for a, b, s in out.collect():
        inside = 1 < a <= 3 and b <= 0.5
        assert abs(s - 1 / (1 + math.exp(1.0 - 2.0 * inside))) < 1e-12


def test_toxic_folding_and_exceptions():
    assert toxicity.folded("1D10T!!") == "idiot"
    assert toxicity.folded("іdіоt") == toxicity.folded("ïdíòt,") == toxicity.folded("i.d-iot") == "idiot"
    assert toxicity.folded("2024") == "2024"
    lexicon = toxicity.Lexicon({"idiot ": 5.0, "scu": 2.0}, frozenset(["idiot savant"]), (1.0, 0.0), 0.0)
    texts, n = toxicity.texts_of(pa.array(["An 1d10t, scum!", "idiot savant", None, "idiotic"]))
    found = [toxicity.hits(lexicon.automaton(), t) for t in texts]
    assert [sum(w for *_, w in x) for x in found] == [7.0, 0, 0, 0]
    assert n.tolist() == [3, 2, 0, 1]


# -- class n-grams


def test_class_scores_form_a_distribution(spark, odd, empty):
    rows = [(i, f"the cat {('sat', 'ran', 'hid')[i % 3]} on x{i}") for i in range(90)]
    extra = [(1000, None), (1001, ""), (None, "the"), (5, "the cat")]
    docs = spark.createDataFrame(rows + extra, "doc_id long, text string")
    out = class_ngrams.scored(docs).collect()
    assert len(out) == len(rows) + len(extra)
    counts = collections.Counter()
    for i, text in rows + extra:
        if i is not None and zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update([*brute.WORD.findall(brute.lower(text)), None])
    total, kinds = sum(counts.values()), len(counts)
    texts = collections.defaultdict(list)
    for i, text in rows + extra:
        words = [*brute.WORD.findall(brute.lower(text)), None]
        base = sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in words)
        texts[i].append((len(words), sum(w in counts for w in words), round(base, 6)))
    got = collections.defaultdict(list)
    for r in out:
        got[r.doc_id].append((r.n_tokens, r.n_known, round(r.base_score, 6)))
        assert r.train_tokens == total and r.score < 0
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in texts.items()}
    assert class_ngrams.scored(odd).count() == len(ODD)
    assert class_ngrams.scored(empty).count() == 0


def test_model_sums_to_one_and_exchange_helps(spark):
    rows = [(i, " ".join(f"{'ab'[k % 2]}{(i * k + k) % 5}" for k in range(40))) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("train", F.lit(True))
    coded = class_ngrams.coded_texts(docs)
    model = class_ngrams.fit(coded)
    assert np.allclose((10.0**model.moves).sum(axis=1), 1)
    assert model.history == sorted(model.history)
    words = model.symbols.frequent
    mass = np.zeros(len(model.emission_base))
    np.add.at(mass, model.classes[words],
              (model.frequent_n[words] + class_ngrams.ADDED) / 10.0 ** model.emission_base[model.classes[words]])
    used = mass > 0
    assert np.allclose(mass[used], 1)


def test_exchange_gain_is_the_likelihood_change():
    rng = np.random.default_rng(2)
    n, movable, total = 12, 3, 5
    counts = rng.integers(0, 6, (n, n)).astype(float)
    classes = np.array([*rng.integers(0, movable, n - 2), 3, 4])

    def pairs_of(c):
        out = np.zeros((total, total))
        np.add.at(out, (c[:, None].repeat(n, 1), c[None].repeat(n, 0)), counts)
        return out

    for word in range(n - 2):
        others = np.delete(np.arange(n), word)
        after = np.bincount(classes[others], weights=counts[word, others], minlength=total)
        before = np.bincount(classes[others], weights=counts[others, word], minlength=total)
        pairs = pairs_of(classes)
        moved = class_ngrams.exchange(
            [word], after[None], before[None], np.array([counts[word, word]]), classes, pairs, movable
        )
        best = max(
            class_ngrams.likelihood(pairs_of(np.where(np.arange(n) == word, c, classes)))
            for c in range(movable)
        )
        for symbol, c in moved:
            classes[symbol] = c
        assert np.allclose(pairs, pairs_of(classes))
        assert np.isclose(class_ngrams.likelihood(pairs_of(classes)), best)


def test_batched_exchange_finds_the_same_classes():
    rng = np.random.default_rng(5)
    n, movable, total = 14, 4, 6
    counts = rng.integers(0, 5, (n, n)).astype(float)
    classes = np.array([*rng.integers(0, movable, n - 2), 4, 5])
    pairs = np.zeros((total, total))
    np.add.at(pairs, (classes[:, None].repeat(n, 1), classes[None].repeat(n, 0)), counts)
    words, alone = np.arange(n - 2), []
    sides = [np.zeros((n - 2, total)), np.zeros((n - 2, total))]
    for word in words:
        others = np.delete(np.arange(n), word)
        for side, seen in zip(sides, (counts[word, others], counts[others, word]), strict=True):
            side[word] = np.bincount(classes[others], weights=seen, minlength=total)
        moved = class_ngrams.exchange(
            [word], sides[0][[word]], sides[1][[word]], counts[word, word][None], classes, pairs.copy(), movable
        )
        alone.append(moved[0][1] if moved else classes[word])
    sparse = [(*np.nonzero(side), side[np.nonzero(side)]) for side in sides]
    loops = np.diagonal(counts)[: n - 2]
    found = class_ngrams.best_classes(*sparse, loops, classes[: n - 2], pairs, movable)
    assert found.tolist() == alone


def test_every_word_seen_five_times_is_clustered(spark):
    """Also far below a share of 1/20,000 of the tokens, where words had no class of their own."""
    fill = [(i, "the cat sat on the mat " * 5_000) for i in range(20)]
    rare = [(100 + i, f"{'xy'[i % 2]} rare{i % 200} {'xy'[i % 2]}") for i in range(1400)]
    docs = spark.createDataFrame(fill + rare, "doc_id long, text string").withColumn("train", F.lit(True))
    coded = class_ngrams.coded_texts(docs)
    counts = class_ngrams.word_counts(coded)
    model = class_ngrams.fit(coded)
    table = {r["word"]: (r["class"], r["n"]) for r in class_ngrams.class_table(model).collect()}
    expected = {r["word"].decode(): r["n"] for r in counts.collect() if r["n"] >= class_ngrams.LEAST_COUNT}
    assert {w: n for w, (_, n) in table.items()} == expected and len(expected) == 207
    classes = [{table[f"rare{i}"][0] for i in range(odd, 200, 2)} for odd in (0, 1)]
    assert not classes[0] & classes[1]  # words between x are in other classes than words between y


def test_held_out_perplexity_is_that_of_the_scores(spark, docs):
    out = class_ngrams.scored(docs).toPandas()
    held = out[out.held_out]
    whole = 10 ** (-held.score.sum() / held.n_tokens.sum())
    assert np.allclose(out.held_out_perplexity, whole) and 1 < whole
    assert np.allclose(np.log10(out.perplexity), -out.score / out.n_tokens)
