"""One callable per capability: (spark, folder) -> DataFrame.

Doubles are rounded half-even so the SQL checks can compare values.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nudgelab.operators import age as A
from nudgelab.operators import association as L
from nudgelab.operators import clean as C
from nudgelab.operators import client_aggregates as G
from nudgelab.operators import experiment as E
from nudgelab.operators import importance as I
from nudgelab.operators import learners as M
from nudgelab.operators import profiling as Q
from nudgelab.operators import ranking as R
from nudgelab.operators import segments, split
from nudgelab.operators.business import BUSINESS_FEATURES
from nudgelab.plans import features as P
from nudgelab.plans import modelling as jobs
from nudgelab.session import materialize, scratch_path
from nudgelab.sources import artifacts
from nudgelab.sources import driver_tables as D
from nudgelab.sources import files, schemas, scorelog
from nudgelab.streaming import latency, scoring

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}

PROFILED = (
    "regular_points_received",
    "express_points_received",
    "regular_points_spent",
    "express_points_spent",
    "purchase_sum",
    "product_quantity",
    "trn_sum_from_iss",
    "trn_sum_from_red",
)
CRAMER_FEATURES = (
    "gender",
    "first_transaction_quarter",
    "is_activated",
    "is_super_loyal",
    "treatment_flg",
    "target",
)
AUDIT_NUMERIC = tuple(
    c for c in P.AUDIT_FEATURES if c not in ("gender", "first_transaction_quarter")
)


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double half-even, by way of 9 places."""
    return df.selectExpr(
        *(
            f"bround(bround(`{f.name}`, 9), {digits}) AS `{f.name}`"
            if isinstance(f.dataType, T.DoubleType)
            else f"`{f.name}`"
            for f in df.schema.fields
        )
    )


def _labelled(spark: SparkSession, d: str) -> DataFrame:
    return C.labelled_clients(D.clients(spark, d), D.campaign(spark, d))


def _tables(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return D.clients(spark, d), D.campaign(spark, d), D.purchases(spark, d)


def _cleaned(spark: SparkSession, d: str) -> DataFrame:
    return C.clean_purchases(D.purchases(spark, d))


def _audit(spark: SparkSession, d: str) -> DataFrame:
    """The audit frame, materialised: its readers make several passes."""
    return materialize(P.audit_features(*_tables(spark, d)))


def _log(spark: SparkSession, d: str) -> DataFrame:
    sized = files.request_size(D.request_log(spark, d).drop("input_size"))
    return sized.withColumn("status_code", F.col("status_code").cast("int"))


# --- sources and sinks -----------------------------------------------------------------


@query
def scan_purchases(spark: SparkSession, d: str) -> DataFrame:
    return rounded(D.purchases(spark, d))


@query
def csv_scan(spark: SparkSession, d: str) -> DataFrame:
    lines = D.purchases(spark, d)
    odd, paths = F.col("transaction_id") % 2 == 1, []
    for rows, names in ((lines.where(~odd), lines.columns), (lines.where(odd), lines.columns[::-1])):
        paths.append(scratch_path(spark, "purchases-csv"))
        rows.select(*names).write.option("header", True).csv(paths[-1])
    return rounded(files.read_csv(spark, paths, schemas.PURCHASES))


def _requests(spark: SparkSession, d: str) -> DataFrame:
    """One scoring request per purchase line, with its client."""
    lines, people = D.purchases(spark, d), D.clients(spark, d)
    person = F.struct(*(F.col(f"p.{c}") for c in people.columns))
    line = F.struct(*(F.col(f"l.{c}") for c in lines.columns))
    return lines.alias("l").join(people.alias("p"), "client_id").select(
        F.to_json(
            F.struct(F.array(person).alias("client"), F.array(line).alias("purchases"))
        ).alias("input_data")
    )


@query
def payload_explode(spark: SparkSession, d: str) -> DataFrame:
    exploded = files.request_purchases(files.parse_requests(_requests(spark, d)))
    return rounded(
        exploded.select(
            *(F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.PURCHASES.fields)
        )
    )


@query
def quarantine_bad_rows(spark: SparkSession, d: str) -> DataFrame:
    submitted = D.clients(spark, d).selectExpr(
        "CASE WHEN client_id % 13 = 0 THEN NULL "
        "WHEN client_id % 17 = 0 THEN concat('x', CAST(client_id AS STRING)) "
        "ELSE CAST(client_id AS STRING) END AS client_id",
        "age",
        "gender",
    )
    return C.quarantine(submitted)


@query
def labelled_clients(spark: SparkSession, d: str) -> DataFrame:
    return _labelled(spark, d)


@query
def score_log_append(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "score-log")
    log = _log(spark, d).withColumn("output_data", F.lit(None).cast("string"))
    scorelog.append_log(log.where("status_code = 200"), path)
    scorelog.append_log(log.where("status_code <> 200"), path)
    return rounded(scorelog.read_log(spark, path).drop(scorelog.DAY, "output_data"))


@query
def score_log_truncate(spark: SparkSession, d: str) -> DataFrame:
    """What is left of a log that was emptied between two appends."""
    path = scratch_path(spark, "log")
    rows = _log(spark, d).withColumn("output_data", F.lit(None).cast("string"))
    scorelog.append_log(rows, path)
    scorelog.truncate_log(spark, path)
    scorelog.append_log(rows.where("id % 2 = 0"), path)
    return rounded(scorelog.read_log(spark, path).select("id", "ts", "processing_time", "input_size"))


@query
def score_log_latest(spark: SparkSession, d: str) -> DataFrame:
    return scorelog.latest_first(_log(spark, d))


@query
def request_size(spark: SparkSession, d: str) -> DataFrame:
    return _log(spark, d).select("id", "input_size", "input_tokens")


@query
def latency_stats(spark: SparkSession, d: str) -> DataFrame:
    return rounded(scorelog.latency_stats(_log(spark, d)))


#: Batches in which the request log lands: six days each, every 13th request one batch late and
#: every 29th three, with a watermark of two days.
LANDINGS = 5
ARRIVAL = (
    "least(4, CAST(floor((day(ts) - 1) / 6) AS INT) "
    "+ CASE WHEN id % 29 = 0 THEN 3 WHEN id % 13 = 0 THEN 1 ELSE 0 END)"
)


@query
def latency_windows(spark: SparkSession, d: str) -> DataFrame:
    """Hourly latency of a log that lands in five parts, out of order and partly too late.

    Each landing is followed by a start of the stream, which goes on from its checkpoint.
    """
    landing, target, state = (scratch_path(spark, n) for n in ("landing", "windows", "state"))
    rows = D.request_log(spark, d).select("id", "ts", "processing_time")
    arrived = rows.withColumn("arrival", F.expr(ARRIVAL))
    for part in range(LANDINGS):
        landed = arrived.where(F.col("arrival") == part).drop("arrival")
        landed.write.mode("append").parquet(landing)
        latency.start_windows(spark, landing, target, state, "1 hour", "2 days").awaitTermination()
    found = latency.readings(latency.read_windows(spark, target))
    return rounded(found.withColumns({
        c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")
    }))


@query
def input_stats(spark: SparkSession, d: str) -> DataFrame:
    return rounded(scorelog.input_stats(_log(spark, d)))


@query
def status_counts(spark: SparkSession, d: str) -> DataFrame:
    return scorelog.status_counts(_log(spark, d))


# --- features --------------------------------------------------------------------------


@query
def clean_purchases(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_cleaned(spark, d))


@query
def tx_dedup(spark: SparkSession, d: str) -> DataFrame:
    return rounded(G.transactions(_cleaned(spark, d)))


@query
def first_client_row(spark: SparkSession, d: str) -> DataFrame:
    people = D.clients(spark, d)
    copies = people.selectExpr(
        "client_id",
        "first_issue_date + INTERVAL '1' DAY AS first_issue_date",
        "first_redeem_date",
        "age + 1 AS age",
        "gender",
    )
    return C.first_client_row(copies.unionByName(people))


@query
def client_static(spark: SparkSession, d: str) -> DataFrame:
    return C.add_static(D.clients(spark, d)).drop(
        "age", "gender", "first_issue_date", "first_redeem_date"
    )


@query
def age_stats(spark: SparkSession, d: str) -> DataFrame:
    return rounded(A.age_stats(_labelled(spark, d)))


@query
def age_impute(spark: SparkSession, d: str) -> DataFrame:
    people = _labelled(spark, d)
    return rounded(A.impute_age(people, A.age_stats(people)).select("client_id", "age"))


def _transaction_columns(*names: str, habits: bool = False) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        tx = G.transactions(_cleaned(spark, d))
        return rounded(G.transaction_features(tx, habits).select("client_id", *names))

    return run


@query
def client_tx(spark: SparkSession, d: str) -> DataFrame:
    names = (
        "total_transactions",
        "total_purchase_sum",
        "avg_transaction_amount",
        "max_transaction_amount",
        "min_transaction_amount",
    )
    tx = G.transactions(_cleaned(spark, d))
    totals = G.transaction_features(tx).select("client_id", *names)
    return rounded(totals.join(G.amount_spread(tx), "client_id"))


@query
def client_quantiles(spark: SparkSession, d: str) -> DataFrame:
    return rounded(G.amount_quantiles(materialize(G.transactions(_cleaned(spark, d)))))


POINT_COLUMNS = (
    *(f"total_{c}" for c in G.POINTS),
    "avg_regular_points_per_transaction",
    "avg_express_points_per_transaction",
    "points_earned_to_spent_ratio",
)
TIME_COLUMNS = (
    "first_transaction_date",
    "last_transaction_date",
    "transaction_period_days",
    "first_transaction_quarter",
    "first_transaction_year_quarter_idx",
    "transactions_per_day",
)
STORE_COLUMNS = ("unique_stores_visited", "store_loyalty_ratio")
HABIT_COLUMNS = ("most_frequent_weekday", "most_frequent_hour", "most_frequent_store")

REGISTRY["client_points"] = _transaction_columns(*POINT_COLUMNS)
REGISTRY["client_time"] = _transaction_columns(*TIME_COLUMNS)
REGISTRY["client_stores"] = _transaction_columns(*STORE_COLUMNS)
REGISTRY["client_modes"] = _transaction_columns(*HABIT_COLUMNS, habits=True)


@query
def client_products(spark: SparkSession, d: str) -> DataFrame:
    return rounded(G.product_features(_cleaned(spark, d)))


@query
def client_business(spark: SparkSession, d: str) -> DataFrame:
    return rounded(P.business_features(*_tables(spark, d), names=BUSINESS_FEATURES))


@query
def client_final(spark: SparkSession, d: str) -> DataFrame:
    return P.audit_features(*_tables(spark, d))


@query
def client_final_scoring(spark: SparkSession, d: str) -> DataFrame:
    return P.client_features(*_tables(spark, d), na_fill=0.0)


@query
def client_features(spark: SparkSession, d: str) -> DataFrame:
    return P.client_features(*_tables(spark, d))


@query
def client_features_wide(spark: SparkSession, d: str) -> DataFrame:
    return P.client_features(*_tables(spark, d), drop_redundant=False)


@query
def client_features_scoring(spark: SparkSession, d: str) -> DataFrame:
    people, labels, lines = _tables(spark, d)
    fitted = A.age_stats(C.labelled_clients(people, labels))
    return P.scoring_features(people, lines, fitted)


# --- profiling -------------------------------------------------------------------------


@query
def profile_numeric(spark: SparkSession, d: str) -> DataFrame:
    return rounded(Q.profile_numeric(D.purchases(spark, d), PROFILED))


@query
def profile_numeric_clients(spark: SparkSession, d: str) -> DataFrame:
    people = D.clients(spark, d).drop(P.KEY)
    numbers = [f.name for f in people.schema.fields if isinstance(f.dataType, T.NumericType)]
    return rounded(Q.profile_numeric(people, numbers))


@query
def profile_categorical(spark: SparkSession, d: str) -> DataFrame:
    return Q.profile_categorical(D.purchases(spark, d), ("store_id", "product_id"))


@query
def null_counts(spark: SparkSession, d: str) -> DataFrame:
    return Q.null_counts(D.purchases(spark, d))


@query
def null_counts_clients(spark: SparkSession, d: str) -> DataFrame:
    return Q.null_counts(D.clients(spark, d))


@query
def profile_gender(spark: SparkSession, d: str) -> DataFrame:
    return Q.profile_categorical(D.clients(spark, d), ("gender",))


@query
def profile_distinct(spark: SparkSession, d: str) -> DataFrame:
    static = C.add_static(_labelled(spark, d))
    names = (
        "gender",
        "first_issue_quarter",
        "first_issue_month",
        "is_activated",
        "treatment_flg",
        "target",
    )
    return Q.profile_distinct(static.select(*names))


@query
def rare_levels(spark: SparkSession, d: str) -> DataFrame:
    static = C.add_static(_labelled(spark, d))
    return C.rare_levels(static, "first_issue_quarter", 0.02)


@query
def target_encode(spark: SparkSession, d: str) -> DataFrame:
    static = C.add_static(_labelled(spark, d))
    encoded = C.target_encode(static, "first_issue_quarter", "target")
    return rounded(encoded.select("client_id", "level", "encoded"))


@query
def score_summary(spark: SparkSession, d: str) -> DataFrame:
    return rounded(Q.score_summary(D.scores(spark, d), "uplift"))


@query
def score_histogram(spark: SparkSession, d: str) -> DataFrame:
    return rounded(Q.histogram(D.scores(spark, d), "uplift", 50))


@query
def confusion_matrix(spark: SparkSession, d: str) -> DataFrame:
    return rounded(Q.confusion_matrix(D.scores(spark, d), "uplift", "target"))


@query
def classification_report(spark: SparkSession, d: str) -> DataFrame:
    return rounded(Q.classification_report(D.scores(spark, d), "uplift", "target"))


# --- experiment ------------------------------------------------------------------------


@query
def target_distribution(spark: SparkSession, d: str) -> DataFrame:
    return rounded(E.target_distribution(D.campaign(spark, d)))


@query
def crosstab_treatment_target(spark: SparkSession, d: str) -> DataFrame:
    return rounded(E.crosstab(D.campaign(spark, d)))


@query
def ate_summary(spark: SparkSession, d: str) -> DataFrame:
    return rounded(E.arm_summary(D.campaign(spark, d)))


@query
def ztest(spark: SparkSession, d: str) -> DataFrame:
    return rounded(E.z_test(D.campaign(spark, d)))


@query
def ttest(spark: SparkSession, d: str) -> DataFrame:
    return rounded(E.t_test(D.campaign(spark, d)))


@query
def conversion_ci(spark: SparkSession, d: str) -> DataFrame:
    return rounded(E.conversion_intervals(D.campaign(spark, d)))


@query
def smd_balance(spark: SparkSession, d: str) -> DataFrame:
    return rounded(E.balance(_audit(spark, d), exclude=("client_id", "target")))


# --- association -----------------------------------------------------------------------


@query
def corr_matrix(spark: SparkSession, d: str) -> DataFrame:
    return rounded(L.correlation_matrix(_audit(spark, d), AUDIT_NUMERIC))


@query
def corr_pairs(spark: SparkSession, d: str) -> DataFrame:
    return rounded(L.strong_pairs(_audit(spark, d).select(*AUDIT_NUMERIC)))


@query
def cramers_v(spark: SparkSession, d: str) -> DataFrame:
    return rounded(L.cramers_v(_audit(spark, d), CRAMER_FEATURES))


@query
def cramers_v_detected(spark: SparkSession, d: str) -> DataFrame:
    """All columns that the detector finds on the audit frame with its first issue quarter."""
    frame = materialize(P.audit_features(*_tables(spark, d), extra=("first_issue_quarter",)))
    names = Q.categorical_columns(frame, [c for c in frame.columns if c != P.KEY])
    pairs = rounded(L.cramers_v(frame, names))
    return pairs.orderBy(F.col("v_cramer").desc_nulls_last(), "feature_1", "feature_2")


@query
def association(spark: SparkSession, d: str) -> DataFrame:
    skip = ("client_id", "treatment_flg")
    return rounded(L.association(_audit(spark, d), "target", exclude=skip))


@query
def association_cat(spark: SparkSession, d: str) -> DataFrame:
    texts = ("gender", "first_transaction_quarter")
    table = L.categorical_association(_audit(spark, d), "target", texts)
    return rounded(table.select("feature", "eta2", "auc"))


@query
def association_by_arm(spark: SparkSession, d: str) -> DataFrame:
    audit = _audit(spark, d)
    return rounded(L.association_by_arm(audit, "target", "treatment_flg", ("client_id",)))


@query
def top_features(spark: SparkSession, d: str) -> DataFrame:
    audit = _audit(spark, d)
    compared = L.association_by_arm(audit, "target", "treatment_flg", ("client_id",))
    return rounded(L.strongest_changes(compared))


# --- ranking ---------------------------------------------------------------------------


@query
def rank_clients(spark: SparkSession, d: str) -> DataFrame:
    ranked = R.rank_clients(D.scores(spark, d))
    return ranked.select("client_id", "uplift", "position")


@query
def auuc(spark: SparkSession, d: str) -> DataFrame:
    return rounded(R.gain_areas(D.scores(spark, d)).select("auuc"), 9)


@query
def qini_auc(spark: SparkSession, d: str) -> DataFrame:
    return rounded(R.gain_areas(D.scores(spark, d)).select("qini"), 9)


@query
def uplift_at_k(spark: SparkSession, d: str) -> DataFrame:
    return rounded(R.uplift_at_k(R.rank_clients(D.scores(spark, d))))


@query
def uplift_deciles(spark: SparkSession, d: str) -> DataFrame:
    return rounded(R.uplift_deciles(R.rank_clients(D.scores(spark, d))))


@query
def weighted_avg_uplift(spark: SparkSession, d: str) -> DataFrame:
    return rounded(R.weighted_avg_uplift(R.rank_clients(D.scores(spark, d))))


@query
def qini_curve(spark: SparkSession, d: str) -> DataFrame:
    return rounded(R.qini_curve(R.rank_clients(D.scores(spark, d))))


@query
def uplift_curve(spark: SparkSession, d: str) -> DataFrame:
    return rounded(R.uplift_curve(R.rank_clients(D.scores(spark, d))))


@query
def perfect_curve(spark: SparkSession, d: str) -> DataFrame:
    return rounded(R.perfect_curve(D.scores(spark, d)))


@query
def roc_auc(spark: SparkSession, d: str) -> DataFrame:
    return rounded(R.roc_auc(D.scores(spark, d), "uplift", "target"), 9)


@query
def roc_curve(spark: SparkSession, d: str) -> DataFrame:
    return rounded(R.roc_curve(D.scores(spark, d), "uplift", "target"))


@query
def uplift_by_segment(spark: SparkSession, d: str) -> DataFrame:
    people = D.clients(spark, d)
    return segments.uplift_by_segment(
        people, D.scores(spark, d).select("client_id", "uplift"), ["gender"]
    )


# --- splits ----------------------------------------------------------------------------


@query
def stratified_split(spark: SparkSession, d: str) -> DataFrame:
    return split.holdout_split(D.campaign(spark, d))


@query
def stratified_split_3way(spark: SparkSession, d: str) -> DataFrame:
    return split.three_way_split(D.campaign(spark, d))


@query
def kfold_assign(spark: SparkSession, d: str) -> DataFrame:
    return split.assign_folds(D.campaign(spark, d))


# --- models ----------------------------------------------------------------------------
# SQL cannot fit these models, so the queries return what SQL can state about their results.

#: Clients for each feature that the tight bound of the propensity check needs.
CLIENTS_PER_FEATURE = 20

#: What a session has fitted so far, by folder; each learner is fitted by the first query that needs it.
_FITTED: dict[tuple[str, str], dict[str, M.EffectModel]] = {}
_PARTS: dict[tuple[str, str], tuple[DataFrame, DataFrame]] = {}


def _training(spark: SparkSession, d: str) -> DataFrame:
    return jobs.training_frame(*_tables(spark, d))


def _parts(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    train, test = jobs.with_parts(_training(spark, d))
    return materialize(train), test


def _models(spark: SparkSession, d: str, *names: str) -> tuple[dict[str, M.EffectModel], DataFrame]:
    """The named learners in full, and the test rows."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _PARTS:
        _PARTS[key] = _parts(spark, d)
    train, test = _PARTS[key]
    known = _FITTED.setdefault(key, {})
    if lacking := [n for n in names if n not in known]:
        estimators = jobs.learners(train)
        fitted = M.side_by_side([partial(estimators[n].fit, train) for n in lacking])
        known.update(zip(lacking, fitted, strict=True))
    return {n: known[n] for n in names}, test


def _comparison(spark: SparkSession, d: str) -> jobs.Comparison:
    """The four learners side by side."""
    return jobs.compared(*_models(spark, d, "t_learner", "s_learner", "x_learner", "baseline"))


def _scored(spark: SparkSession, d: str, name: str) -> DataFrame:
    """The test clients' scores by one learner."""
    models, test = _models(spark, d, name)
    return jobs.score_all(models, test)


def _facts(scored: DataFrame) -> DataFrame:
    """Every scored client with its labels, whether its score is usable, and whether scores vary."""
    scored = materialize(scored)
    vary = scored.groupBy("model").agg((F.countDistinct(M.SCORE) > 1).alias("scores_vary"))
    usable = F.coalesce(F.col(M.SCORE).between(-2, 2), F.lit(False))
    return scored.join(F.broadcast(vary), "model").select(
        "client_id", "model", "treatment_flg", "target", usable.alias("usable"), "scores_vary"
    )


def _weights(table: DataFrame, column: str = "importance") -> DataFrame:
    """Features whose weights are finite and not negative, and whether the weights sum to 1."""
    whole = table.agg((F.abs(F.sum(column) - 1) < 1e-6).alias("sums_to_one"))
    fine = F.coalesce(F.col(column).between(0, 1e9), F.lit(False))
    return table.join(F.broadcast(whole)).select("feature", fine.alias("fine"), "sums_to_one")


@query
def propensity(spark: SparkSession, d: str) -> DataFrame:
    frame = materialize(_audit(spark, d))
    scores = materialize(jobs.propensity_scores(frame))
    check = jobs.propensity_check(frame)
    usable = F.col(M.SCORE).between(0, 1)
    # In-sample: on few clients for many features even random arms separate somewhat.
    random_arms = F.col("auc").between(0.5, F.when(F.col("enough_clients"), 0.7).otherwise(0.9))
    enough = F.count(F.lit(1)) >= CLIENTS_PER_FEATURE * len(P.AUDIT_FEATURES)
    return (
        scores.agg(
            F.count(F.lit(1)).alias("n"),
            F.bround(F.avg(M.SCORE), 3).alias("mean_score"),
            F.every(usable).alias("usable"),
            enough.alias("enough_clients"),
        )
        .join(F.broadcast(check.select("auc")))
        .withColumn("arms_look_random", random_arms)
        .drop("auc")
    )


@query
def propensity_histogram(spark: SparkSession, d: str) -> DataFrame:
    """Counts of all clients over fixed borders 0, 0.05 .. 1; the sum is what SQL can check."""
    scores = jobs.propensity_scores(materialize(_audit(spark, d)))
    bins = scores.select(F.least(F.floor(F.col(M.SCORE) * 20), F.lit(19)).alias("bin"))
    counts = bins.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.sum("n").alias("n"), F.every(F.col("bin").between(0, 19)).alias("inside"))


@query
def t_learner(spark: SparkSession, d: str) -> DataFrame:
    train, test = _parts(spark, d)
    return _facts(M.scored_columns(M.t_learner(train).fit(train).transform(test), "t_learner"))


@query
def s_learner(spark: SparkSession, d: str) -> DataFrame:
    return _facts(_scored(spark, d, "s_learner"))


@query
def x_learner(spark: SparkSession, d: str) -> DataFrame:
    return _facts(_scored(spark, d, "x_learner"))


@query
def baseline_response(spark: SparkSession, d: str) -> DataFrame:
    return _facts(_scored(spark, d, "baseline"))


@query
def t_learner_candidates(spark: SparkSession, d: str) -> DataFrame:
    train, test = _parts(spark, d)
    numbers, texts = M.split_kinds(train, with_gender=False)
    bases = {
        "logreg": M.RidgeLogistic(numbers, texts),
        "forest": M.forest_classifier(numbers, texts, numTrees=100, seed=42),
        "boosted": M.boosted_classifier(numbers, texts, maxIter=100, seed=42),
    }
    models = {name: M.TLearner(base).fit(train) for name, base in bases.items()}
    return _facts(jobs.score_all(models, test))


@query
def tune_t_learner(spark: SparkSession, d: str) -> DataFrame:
    """All ten trials of the logistic family, and its best on the test rows."""
    train, test = _parts(spark, d)
    study = jobs.tune_t_learner(train, families=("logreg",))
    rows = [
        (i, t.family, 1e-3 <= t.params["c"] <= 1e2, t.error is None and abs(t.auuc) < 2)
        for i, t in enumerate(study.trials)
    ]
    refit = jobs.refit_best(train, test, study).select("model", F.col("auuc").isNotNull().alias("ok"))
    table = spark.createDataFrame(rows, "trial int, family string, in_range boolean, measured boolean")
    return table.join(F.broadcast(refit), F.col("family") == F.col("model")).select(
        "trial", "family", "in_range", "measured", F.col("ok").alias("refitted")
    )


@query
def tune_x_learner(spark: SparkSession, d: str) -> DataFrame:
    """The first drawn trial with all its rounds, and the final fit; for 80 trials see the README."""
    frame = _training(spark, d)
    study = jobs.tune_x_learner(frame, trials=1)
    rows = [
        (i, 4 <= t.params["maxDepth"] <= 7 and 0.03 <= t.params["stepSize"] <= 0.2
         and 100 <= t.params["maxIter"] <= 400, t.error is None and abs(t.auuc) < 2)
        for i, t in enumerate(study.trials)
    ]
    table = spark.createDataFrame(rows, "trial int, in_range boolean, measured boolean")
    final = jobs.refit_x_learner(frame, study)
    fine = (F.abs("auuc") < 1e9) & (F.abs("qini") < 1e9)
    return table.join(F.broadcast(final.select(F.coalesce(fine, F.lit(False)).alias("refitted"))))


@query
def model_comparison(spark: SparkSession, d: str) -> DataFrame:
    found = _comparison(spark, d)
    rows = found.scored.groupBy("model").agg(
        F.count(F.lit(1)).alias("n"), (F.countDistinct(M.SCORE) > 1).alias("scores_vary")
    )
    finite = [F.coalesce(F.abs(F.col(c)) < 1e9, F.lit(False))
              for c in found.metrics.columns if c in ("auuc", "qini")]
    metrics = found.metrics.select("model", reduce(lambda a, b: a & b, finite).alias("measured"))
    return rows.join(metrics, "model")


@query
def model_metrics(spark: SparkSession, d: str) -> DataFrame:
    """The seven metrics of the four learners; a test recomputes them client by client."""
    metrics = _comparison(spark, d).metrics
    return metrics.unpivot(["model"], [c for c in metrics.columns if c != "model"], "metric", "value")


@query
def importance_t(spark: SparkSession, d: str) -> DataFrame:
    gap = I.coefficient_gap(spark, _models(spark, d, "t_learner")[0]["t_learner"])
    usable = F.col("gap").isNotNull() & ~F.isnan("gap") & (F.abs("gap") == F.col("size"))
    return gap.groupBy("feature").agg(F.every(usable).alias("usable"))


@query
def importance_tree(spark: SparkSession, d: str) -> DataFrame:
    return _weights(I.learner_importance(spark, _models(spark, d, "baseline")[0]["baseline"]))


@query
def importance_x(spark: SparkSession, d: str) -> DataFrame:
    return _weights(I.learner_importance(spark, _models(spark, d, "x_learner")[0]["x_learner"]))


@query
def importance_table(spark: SparkSession, d: str) -> DataFrame:
    models, _ = _models(spark, d, "t_learner", "s_learner", "x_learner", "baseline")
    table = I.importance_table(spark, models)
    columns = [*models, "mean_importance"]
    sums = table.agg(*[(F.abs(F.sum(c) - 1) < 1e-6).alias(f"{c}_sums_to_one") for c in columns])
    return table.select("feature").join(F.broadcast(sums))


@query
def train_job(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "learner")
    made = jobs.train_job(*_tables(spark, d), path)
    model, _ = artifacts.load_learner(spark, path)
    was = I.coefficient_importance(spark, made).withColumnRenamed("importance", "was")
    same = (F.col("importance") == F.col("was")).alias("survives_saving")
    return I.coefficient_importance(spark, model).join(was, "feature").select("feature", same)


@query
def score_batch(spark: SparkSession, d: str) -> DataFrame:
    people, labels, lines = _tables(spark, d)
    path = scratch_path(spark, "learner")
    made = jobs.train_job(people, labels, lines, path)
    model, _ = artifacts.load_learner(spark, path)
    ages = artifacts.load_ages(path)
    was = jobs.score_clients(people, lines, made, ages).withColumnRenamed(M.SCORE, "was")
    scores = jobs.score_clients(people, lines, model, ages)
    return scores.join(was, "client_id").select(
        "client_id", F.col(M.SCORE).between(-1, 1).alias("usable"),
        (F.col(M.SCORE) == F.col("was")).alias("survives_saving"),
    )


@query
def stratified_split_target(spark: SparkSession, d: str) -> DataFrame:
    """80 / 20 by the response alone."""
    return split.holdout_split(D.campaign(spark, d), strata=("target",), test_share=0.2)


#: A packed file is read by one task.
REQUESTS_A_FILE = 50_000


@query
def score_stream(spark: SparkSession, d: str) -> DataFrame:
    landing, scores, log, state = (
        scratch_path(spark, f"stream-{part}") for part in ("in", "scores", "log", "state")
    )
    _requests(spark, d).select(
        F.monotonically_increasing_id().alias("id"),
        F.lit("2024-03-01T09:00:00").alias("ts"),
        "input_data",
    ).write.option("maxRecordsPerFile", REQUESTS_A_FILE).json(landing, compression="gzip")
    frame = _training(spark, d)
    ages = A.AgeImputer().fit(_labelled(spark, d))
    model = M.t_learner(frame).fit(frame)
    scoring.start_scoring(spark, landing, model, ages, scores, log, state).awaitTermination()
    told = scorelog.read_log(spark, log).select("id", "status_code", "input_data", "output_data")
    client = F.get_json_object("input_data", "$.client[0].client_id").cast("long")
    answer = F.get_json_object("output_data", "$.uplift[0].uplift").cast("double")
    # A request holds one client, whose score stands in the score table and in the answer.
    return (
        spark.read.parquet(scores)
        .withColumnRenamed("client_id", "scored_client")
        .join(told.withColumn("client_id", client).withColumn("answer", answer), "id")
        .select(
            "client_id", "status_code", (F.col("scored_client") == F.col("client_id")).alias("own"),
            F.col(M.SCORE).between(-1, 1).alias("usable"),
            (F.abs(F.col(M.SCORE) - F.col("answer")) < 1e-9).alias("told"),
        )
    )
