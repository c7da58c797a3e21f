"""Score log storage and scoring of landed request files."""

from __future__ import annotations

import json
import os
import re

import pytest
from pyspark.sql import functions as F

from checks import queries
from nudgelab.operators import learners as M
from nudgelab.operators.age import AgeImputer
from nudgelab.plans import modelling as jobs
from nudgelab.session import checkpoint_root
from nudgelab.sources import driver_tables as D
from nudgelab.sources import files, schemas, scorelog
from nudgelab.streaming import scoring

def test_append_read_truncate(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = spark.sql(
        "SELECT id, TIMESTAMP_NTZ'2024-01-01 10:00:00' + INTERVAL '1' DAY * CAST(id AS INT) AS ts, "
        "0.5D AS processing_time, 10L AS input_size, 2L AS input_tokens, 200 AS status_code, "
        "'{\"a\": 1}' AS input_data, 'plain text' AS output_data FROM range(3)"
    )
    scorelog.append_log(rows, path)
    scorelog.append_log(rows.withColumn("id", F.col("id") + 10), path)
    log = scorelog.read_log(spark, path)
    assert log.count() == 6 and log.where("dt = DATE'2024-01-02'").count() == 2
    newest = scorelog.latest_first(log).first()
    assert newest["id"] == 12
    assert newest["input_data"] == '{"a":1}' and newest["output_data"] == "plain text"
    scorelog.truncate_log(spark, path)
    assert scorelog.read_log(spark, path).count() == 0


def test_latency_ignores_unmeasured_requests(spark):
    rows = [(i, t) for i, t in enumerate([1.0, 2.0, 4.0, 0.0, None, -1.0])]
    log = spark.createDataFrame(rows, "id long, processing_time double")
    got = scorelog.latency_stats(log).first()
    assert got["n"] == 3 and got["total"] == 7.0 and got["p50"] == 2.0
    assert got["p95"] == pytest.approx(3.8)


def test_input_statistics_ignore_zero(spark):
    rows = [(1.0, 10, 0), (1.0, None, 4), (None, 50, 9)]
    log = spark.createDataFrame(rows, "processing_time double, input_size long, input_tokens long")
    got = {r["measure"]: (r["mean"], r["total"], r["n"]) for r in scorelog.input_stats(log).collect()}
    assert got == {"input_size": (10.0, 10.0, 1), "input_tokens": (4.0, 4.0, 1)}


def test_csv_columns_match_by_name(spark, tmp_path):
    (tmp_path / "c.csv").write_text(
        "gender,client_id,age,first_issue_date\nF,7,33,2022-01-10 00:00:00\n,8,,\n"
    )
    rows = files.read_csv(spark, str(tmp_path / "c.csv"), schemas.CLIENTS).collect()
    assert [(r["client_id"], r["age"], r["gender"]) for r in rows] == [(7, 33, "F"), (8, None, None)]
    assert rows[0]["first_redeem_date"] is None and rows[0]["first_issue_date"].year == 2022
    (tmp_path / "bad.csv").write_text("id,age\n1,2\n")
    with pytest.raises(ValueError, match="client_id"):
        files.read_csv(spark, str(tmp_path / "bad.csv"), schemas.CLIENTS)


def test_csv_orders(spark, tmp_path):
    """Paths with other column orders are read right; a folder that mixes them raises."""
    (tmp_path / "a.csv").write_text("client_id,treatment_flg,target\n77,1,0\n")
    (tmp_path / "b.csv").write_text("treatment_flg,client_id,target\n1,78,0\n")
    both = [str(tmp_path / n) for n in ("a.csv", "b.csv")]
    rows = files.read_csv(spark, both, schemas.CAMPAIGN).orderBy("client_id").collect()
    assert [(r["client_id"], r["treatment_flg"]) for r in rows] == [(77, 1), (78, 1)]
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv(spark, str(tmp_path), schemas.CAMPAIGN).collect()


@pytest.mark.parametrize("document", [
    {"a": 1, "b": 2}, {"t": "x, y: z \" \\ \n end", "l": [1, "two", {"k": []}]}, [], {},
    {"é": "ü  ß", "n": None, "b": True}, {"long": "word, " * 4000},
])
def test_request_size_of_the_document_written_anew(spark, document):
    shown = json.dumps(document, ensure_ascii=False)
    odd = json.dumps(document, separators=(",", ":")).replace("[", "[\n ")
    rows = [(1, shown), (2, odd if "long" not in document else shown), (3, "{broken")]
    df = spark.createDataFrame(rows, "id int, input_data string")
    got = {r.id: (r.input_size, r.input_tokens) for r in files.request_size(df).collect()}
    expected = (len(shown.encode()), len(shown.split()))
    assert got == {1: expected, 2: expected, 3: (0, 0)}


def test_request_size_without_writing_it(spark, monkeypatch):
    """The rewritten text used to be made, matched and split for its size."""
    odd = ["{}", '""', '" "', '"a b\\tc"', '"\\u0020 \\n x"', '{"a": 1.50, "b":[1,2 , 3]}', '{"a,b:c":"x:y, z\\"q\\\\"}',
           "null", "", None, '{"é":"ü  ü\\u2003x"}', '{"a":1,"a":2}', "  5 ", '["\\\\\\"",","]', "[1,2", '"  at  ends  "']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(odd)], "id int, input_data string")
    shown = df.select("id", files.spaced_json(F.col("input_data")).alias("shown")).collect()
    monkeypatch.setattr(files, "spaced_json", None)
    got = {r.id: (r.input_size, r.input_tokens) for r in files.request_size(df).collect()}
    ascii_space = re.compile(r"[ \t\n\x0b\f\r]+")
    for r in shown:
        text = r.shown or ""
        assert got[r.id] == (len(text.encode()), len([w for w in ascii_space.split(text) if w])), odd[r.id]


def test_landed_files_are_many(spark, folder, monkeypatch):
    """A packed file is one task's: a few large ones left most of the cores idle."""
    before = set(os.listdir(checkpoint_root(spark).removeprefix("file:")))
    monkeypatch.setattr(queries, "REQUESTS_A_FILE", 700)
    scored = queries.score_stream(spark, folder)
    root = checkpoint_root(spark).removeprefix("file:")
    (landing,) = [n for n in set(os.listdir(root)) - before if n.startswith("stream-in-")]
    counts = spark.read.json(os.path.join(root, landing)).groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in counts) <= 700 and len(counts) > 1
    assert scored.count() == sum(r["count"] for r in counts) == D.purchases(spark, folder).count()


def test_landed_requests_are_scored(spark, folder, tmp_path, request_rows):
    frame = jobs.training_frame(
        D.clients(spark, folder), D.campaign(spark, folder), D.purchases(spark, folder)
    )
    model = M.t_learner(frame).fit(frame)
    ages = AgeImputer().fit(D.clients(spark, folder))
    landing = tmp_path / "in"
    landing.mkdir()
    paths = [str(tmp_path / n) for n in ("scores", "log", "state")]

    def land(name, *requests):
        (landing / name).write_text("\n".join(
            json.dumps({"id": i, "ts": "2024-03-01T09:00:00", "input_data": text})
            for i, text in requests
        ))
        query = scoring.start_scoring(spark, str(landing), model, ages, *paths)
        query.awaitTermination(120)
        assert query.exception() is None

    good = json.dumps(request_rows)
    # Text keys, a row without a key, and one purchase only.
    only_first = json.dumps({
        "client": [request_rows["client"][0] | {"client_id": "123"}, {"age": 5}],
        "purchases": [request_rows["purchases"][0] | {"client_id": "123"}],
    })
    land("a.json", (1, good), (2, "broken"), (3, only_first))
    land("b.json", (4, good))

    scores = spark.read.parquet(paths[0]).collect()
    by_request = {}
    for r in scores:
        by_request.setdefault(r["id"], {})[r["client_id"]] = r["uplift"]
    assert {k: set(v) for k, v in by_request.items()} == {1: {123, 555}, 3: {123}, 4: {123, 555}}
    assert by_request[1] == pytest.approx(by_request[4])
    assert by_request[1][123] != by_request[3][123]  # scored on its own purchases

    # A repeated micro-batch replaces its own output.
    again = spark.createDataFrame([(4, None, good)], "id long, ts timestamp_ntz, input_data string")
    again = again.withColumn("ts", F.expr("TIMESTAMP_NTZ'2024-03-01 09:00:00'"))
    scoring.score_batch(again, 1, model, ages, paths[0], paths[1])
    assert spark.read.parquet(paths[0]).count() == len(scores)

    log = {r["id"]: r for r in scorelog.read_log(spark, paths[1]).collect()}
    assert {i: r["status_code"] for i, r in log.items()} == {1: 200, 2: 400, 3: 200, 4: 200}
    answer = json.loads(log[1]["output_data"])["uplift"]
    assert [a["client_id"] for a in answer] == [123, 555]
    assert log[1]["input_size"] == len(good.encode()) and log[1]["input_tokens"] == len(good.split())
    assert log[1]["processing_time"] > 0


def test_requests_are_parsed_once(spark, request_rows):
    """Conditions on the payload used to parse the text again, one by one."""
    df = spark.createDataFrame([(1, json.dumps(request_rows)), (2, "{broken")], "id int, input_data string")
    lines = files.request_purchases(files.parse_requests(df), "id")
    assert lines._jdf.queryExecution().executedPlan().toString().count("from_json(") == 1
    assert lines.count() == 3


def test_a_batch_leaves_no_parsed_requests(spark, monkeypatch):
    """They used to stay in the checkpoint folder, uncompressed, for every batch."""
    kept, gone = [], []
    requests = spark.createDataFrame([(1, "2024-03-01", "{}")], "id long, ts string, input_data string")
    real, drop = scoring.materialize, scoring.discard
    monkeypatch.setattr(scoring, "materialize", lambda df: kept.append(real(df)) or kept[-1])
    monkeypatch.setattr(scoring, "discard", lambda df: gone.append(df.inputFiles()) or drop(df))
    scores = spark.createDataFrame([], "id long, client_id long, uplift double")

    def scored(rows, model, ages):
        return scoring.materialize(files.parse_requests(files.request_size(rows))), scores

    monkeypatch.setattr(scoring, "score_requests", scored)
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    scoring.score_batch(requests, 0, None, None, f"{root}/batch-scores", f"{root}/batch-log")
    assert len(kept) == len(gone) == 1 and gone[0]
    with pytest.raises(Exception, match="(?i)not.?exist|not.?found"):
        kept[0].collect()
    assert scorelog.read_log(spark, f"{root}/batch-log").first()["status_code"] == 400
