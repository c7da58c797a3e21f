"""Every query with a SQL twin gives the same rows."""

from __future__ import annotations

import pytest

import __spark_entry__ as registry
from checks.compare import difference, open_tables
from checks.queries import _comparison, _models
from test_ranking import brute_force

QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def tables(folder):
    return open_tables(folder)


LEARNERS = ("t_learner", "s_learner", "x_learner", "baseline")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, folder, tables, name):
    if name in ("baseline_response", *LEARNERS):
        _models(spark, folder, *LEARNERS)  # side by side, which is faster than one by one
    df = QUERIES[name](spark, folder)
    got = [tuple(row) for row in df.collect()]
    result = tables.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    rows = result.fetchall()
    assert rows, "the SQL check returned nothing"
    assert difference(df.columns, got, columns, rows) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_the_contract_columns(spark):
    from nudgelab.plans.features import LABELS, MODEL_FEATURES

    assert len(MODEL_FEATURES) == 32
    assert set(registry.entry(spark).columns) == {"client_id", *MODEL_FEATURES, *LABELS}


def plain_metrics(rows):
    """All seven metrics of (client, score, arm, response) rows, client by client."""
    ranked = sorted(rows, key=lambda r: (-r[1], r[0]))
    out = {kind: brute_force(ranked, kind) for kind in ("auuc", "qini")}

    def gap(part):
        arms = [[r[3] for r in part if r[2] == arm] for arm in (1, 0)]
        return sum(arms[0]) / len(arms[0]) - sum(arms[1]) / len(arms[1]) if all(arms) else None

    for share in (0.1, 0.2, 0.3, 0.5):
        out[f"uplift_at_{round(share * 100)}"] = gap(ranked[: int(len(ranked) * share)])
    n, bins, start = len(ranked), [], 0
    for i in range(10):
        stop = start + n // 10 + (i < n % 10)
        bins.append(ranked[start:stop])
        start = stop
    gaps = [gap(b) for b in bins]
    treated = [sum(r[2] for r in b) for b in bins]
    out["wau"] = None if None in gaps else sum(g * t for g, t in zip(gaps, treated, strict=True)) / sum(treated)
    return out


def test_model_metrics_equal_a_plain_recomputation(spark, folder):
    """Seven numbers for each of the four learners, from their scores on the test clients."""
    found = {(r["model"], r["metric"]): r["value"] for r in QUERIES["model_metrics"](spark, folder).collect()}
    scored = _comparison(spark, folder).scored.collect()
    assert len(found) == 28
    for model in {r["model"] for r in scored}:
        rows = [(r["client_id"], r["uplift"], r["treatment_flg"], r["target"]) for r in scored if r["model"] == model]
        assert len({r[1] for r in rows}) > 1
        for metric, value in plain_metrics(rows).items():
            got = found[model, metric]
            assert got is None if value is None else got == pytest.approx(value, abs=1e-9), (model, metric)
