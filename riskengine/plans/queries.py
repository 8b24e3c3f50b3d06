"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator or pipeline.

Every query reads the driver's tables (through :mod:`riskengine.sources.testdata`)
over their whole extent; SQL twins live in :mod:`riskengine.plans.oracle`.
Queries that exercise a file sink write into a fresh folder under the
session's checkpoint directory and read the result back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import FEATURE_COLUMNS, REG_PARAMS, SPLIT_SEED
from ..operators import aggregates as agg
from ..operators import evaluation as ev
from ..operators import features as feat
from ..operators import learning as ml
from ..operators import newton
from ..operators import prepare as prep
from ..operators import sampling
from ..session import drop_scratch, materialize, scratch_path
from ..sources import bucketed, io
from ..sources import testdata as td
from ..streaming import scoring as stream
from . import incremental as inc
from . import pipelines as pl

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def _places(df: DataFrame, places: int = 6) -> DataFrame:
    """Sums of doubles to ``places`` decimals, as SQL adds them in another order."""
    return df.withColumn("amount_velocity", F.round("amount_velocity", places))


# --- window features (W1-W4, D1) ---------------------------------------------

@register("transaction_velocity")
def q_transaction_velocity(spark, sf_dir):
    """Count of ids per customer in the trailing 7 days."""
    return feat.transaction_velocity(td.transactions(spark, sf_dir))


@register("amount_velocity")
def q_amount_velocity(spark, sf_dir):
    """Sum of amounts per customer in the trailing 7 days."""
    return _places(feat.amount_velocity(td.transactions(spark, sf_dir)))


@register("velocity_features")
def q_velocity_features(spark, sf_dir):
    """W1 + W2 from one windowed pass and one join back."""
    return _places(feat.velocity_features(td.transactions(spark, sf_dir)))


@register("velocity_bucketed")
def q_velocity_bucketed(spark, sf_dir):
    """W1 + W2 through the bucketed plan where one customer holds a third of all rows."""
    tx = td.transactions(spark, sf_dir)
    hot = F.when(F.col("transaction_id") % 3 == 0, F.lit(-1)).otherwise(F.col("customer_id"))
    return _places(feat.velocity_features(tx.withColumn("customer_id", hot.cast("long")), method="bucketed"))


@register("feature_engineering_heavy")
def q_feature_engineering_heavy(spark, sf_dir):
    """W4 where one customer holds a third of all rows and is heavy: both plans, each its rows."""
    tx = td.transactions(spark, sf_dir)
    hot = F.when(F.col("transaction_id") % 3 == 0, F.lit(-1)).otherwise(F.col("customer_id"))
    return _places(feat.full_feature_engineering(tx.withColumn("customer_id", hot.cast("long")), heavy_rows=200))


def _far_amounts(spark, sf_dir) -> DataFrame:
    """Transactions of which every 40th is of 1e21 and every 40th other of 3e18, some negative."""
    i = F.col("transaction_id")
    far = (F.when(i % 40 == 0, F.when(i % 80 == 0, F.lit(1e21)).otherwise(F.lit(-1e21)))
           .when(i % 40 == 1, F.lit(3e18)).otherwise(F.col("amount")))
    return td.transactions(spark, sf_dir).withColumn("amount", far)


def _far_places(df: DataFrame) -> DataFrame:
    """Sums to 6 places, those of 1e15 and more to the next 1e12, as SQL rounds large ones twice."""
    v = F.col("amount_velocity")
    return df.withColumn("amount_velocity", F.when(F.abs(v) < 1e15, F.round(v, 6)).otherwise(F.round(v / 1e12) * 1e12))


@register("amount_velocity_30_days")
def q_amount_velocity_30_days(spark, sf_dir):
    """W2 over 30 days, with amounts of 1e18 and more among the others."""
    out = feat.amount_velocity(_far_amounts(spark, sf_dir), window_seconds=30 * 86400)
    return _far_places(out)


@register("amount_velocity_365_days")
def q_amount_velocity_365_days(spark, sf_dir):
    """W2 over 365 days through the bucketed plan, with amounts of 1e18 and more among the others."""
    out = feat.amount_velocity(_far_amounts(spark, sf_dir), window_seconds=365 * 86400, method="bucketed")
    return _far_places(out)


@register("category_profile")
def q_category_profile(spark, sf_dir):
    """Transactions per (customer, category), on every row."""
    return feat.merchant_category_profiling(td.transactions(spark, sf_dir))


@register("category_profile_running")
def q_category_profile_running(spark, sf_dir):
    """W3 with the running frame: transactions per (customer, category) so far."""
    return feat.merchant_category_profiling(td.transactions(spark, sf_dir), running=True)


@register("time_patterns")
def q_time_patterns(spark, sf_dir):
    """Hour of day and day of week (1 = Sunday)."""
    return feat.time_based_patterns(td.transactions(spark, sf_dir))


@register("feature_engineering")
def q_feature_engineering(spark, sf_dir):
    """All features in the reference's order (the flagship query)."""
    return _places(feat.full_feature_engineering(td.transactions(spark, sf_dir)))


# --- projections and casts (P1, P3, P4) --------------------------------------

@register("preprocess")
def q_preprocess(spark, sf_dir):
    """P1 on the text form of the raw table (amount and timestamp as strings)."""
    raw = td.transactions(spark, sf_dir)
    text = raw.withColumns({"amount": F.col("amount").cast("string"),
                            "timestamp": F.col("timestamp").cast("string")})
    return prep.preprocess(text)


@register("label_to_int")
def q_label_to_int(spark, sf_dir):
    """The label as an int."""
    return prep.label_to_int(td.transactions(spark, sf_dir))


@register("label_to_double")
def q_label_to_double(spark, sf_dir):
    """The label as 1.0 / 0.0 from its text form."""
    return prep.label_to_double(td.transactions(spark, sf_dir)).select(
        "transaction_id", "is_fraud")


@register("label_slice")
def q_label_slice(spark, sf_dir):
    """The fraud rows only."""
    return prep.label_slice(td.transactions(spark, sf_dir), 1)


# --- sampling (X1, X2) -------------------------------------------------------

@register("stable_split")
def q_stable_split(spark, sf_dir):
    """The layout-independent 80/20 split by transaction, as a label column."""
    return sampling.stable_split(td.transactions(spark, sf_dir), "transaction_id", 80,
                                 SPLIT_SEED, label_col="split")


@register("stable_split_by_customer")
def q_stable_split_by_customer(spark, sf_dir):
    """X2 keyed by customer: each customer's history on one side."""
    return sampling.stable_split(td.transactions(spark, sf_dir), "customer_id", 80,
                                 SPLIT_SEED, label_col="split")


@register("train_features")
def q_train_features(spark, sf_dir):
    """Split first (stable, by transaction), then features on the training side only."""
    train, _ = sampling.stable_split(td.transactions(spark, sf_dir))
    return _places(feat.full_feature_engineering(train))


@register("inference_features")
def q_inference_features(spark, sf_dir):
    """Split first, then features on the inference side only (the inference notebook)."""
    _, inference = sampling.stable_split(td.transactions(spark, sf_dir))
    return _places(feat.full_feature_engineering(inference))


@register("random_split")
def q_random_split(spark, sf_dir):
    """Both sides of the 80/20 Bernoulli split, tagged (rows-only check)."""
    train, inference = sampling.random_split(td.transactions(spark, sf_dir))
    return (train.withColumn("split", F.lit("train"))
            .unionByName(inference.withColumn("split", F.lit("inference"))))


@register("random_split_via_files")
def q_random_split_via_files(spark, sf_dir):
    """Q2 with the random split (X1): CSV -> two CSVs, read back; each id with the number of
    sides that hold it, and whether the first side's share is within 4 standard deviations."""
    raw_path = scratch_path(spark, "raw-csv")
    train_path, inf_path = scratch_path(spark, "train-csv"), scratch_path(spark, "inf-csv")
    io.write_csv(td.transactions(spark, sf_dir), raw_path)
    pl.split_pipeline(spark, raw_path, train_path, inf_path)
    train = io.read_transactions(spark, train_path).select("transaction_id", F.lit(1).alias("first"))
    inference = io.read_transactions(spark, inf_path).select("transaction_id", F.lit(0).alias("first"))
    both = train.unionByName(inference)
    near = both.agg(F.abs(F.avg("first") - 0.8) <= 4 * F.sqrt(F.lit(0.8 * 0.2) / F.count(F.lit(1)))).scalar()
    sides = both.groupBy("transaction_id").agg(F.count(F.lit(1)).alias("sides"))
    return sides.withColumn("share_ok", near)


# --- class balance (A1, A2) --------------------------------------------------

@register("class_counts")
def q_class_counts(spark, sf_dir):
    """A1: total, positive and negative rows in one job."""
    return agg.class_counts(td.transactions(spark, sf_dir))


@register("class_weight")
def q_class_weight(spark, sf_dir):
    """A2: the per-row class weight total / (2 * n_class)."""
    tx = prep.label_to_int(td.transactions(spark, sf_dir))
    return agg.add_class_weight(tx).select("transaction_id", "is_fraud", "class_weight")


# --- summaries and distributions (A3, A4, A5, A8) ----------------------------

@register("describe")
def q_describe(spark, sf_dir):
    """A3: count, mean, stddev, min, max of the raw columns (text min/max too)."""
    return agg.describe(td.transactions(spark, sf_dir),
                        ["transaction_id", "customer_id", "amount", "merchant_category"],
                        digits=6)


@register("describe_exact")
def q_describe_exact(spark, sf_dir):
    """A3 on ids beyond 2^53, which a double can't tell apart: exact extremes as text."""
    tx = td.transactions(spark, sf_dir)
    far = tx.select((F.col("transaction_id") * 2 + F.lit(2 ** 53 + 1)).alias("far_id"))
    return agg.describe(far, ["far_id"]).select("column", "count", "min_text", "max_text")


@register("describe_features")
def q_describe_features(spark, sf_dir):
    """A3 on the feature table (as the training and scoring steps inspect it)."""
    features = feat.full_feature_engineering(td.transactions(spark, sf_dir))
    return agg.describe(features, list(FEATURE_COLUMNS) + ["merchant_category"], digits=6)


@register("feature_distribution")
def q_feature_distribution(spark, sf_dir):
    """A4: mean, stddev and count of the five model features."""
    features = feat.full_feature_engineering(td.transactions(spark, sf_dir))
    return agg.feature_distribution(features, list(FEATURE_COLUMNS), digits=6)


def _joined(spark, sf_dir) -> DataFrame:
    return ev.join_truth(td.scored(spark, sf_dir).select("transaction_id", "prob_1", "prediction"),
                         td.truth(spark, sf_dir))


@register("prediction_distribution")
def q_prediction_distribution(spark, sf_dir):
    """A5: rows per predicted class of the joined scores."""
    return agg.prediction_distribution(_joined(spark, sf_dir))


@register("probability_histogram")
def q_probability_histogram(spark, sf_dir):
    """The 20-bin histogram of the joined probabilities, from their written counts."""
    seen = materialize(ev.outcome_counts(_joined(spark, sf_dir)))
    return agg.probability_histogram(seen, "prob_1", count_col="n")


@register("histogram_continuous")
def q_histogram_continuous(spark, sf_dir):
    """A8 on about as many distinct scores as rows."""
    return agg.probability_histogram(_continuous(spark, sf_dir), "prob_1")


def _continuous(spark, sf_dir) -> DataFrame:
    """Labels with a score of their own for nearly every id: 32 bits of its md5."""
    bits = F.conv(F.substring(F.md5(F.col("transaction_id").cast("string")), 1, 8), 16, 10).cast("double")
    return td.truth(spark, sf_dir).withColumn("prob_1", bits / F.lit(2.0 ** 32))


# --- evaluation (J1, A6, A7, L6, O1) -----------------------------------------

@register("join_truth")
def q_join_truth(spark, sf_dir):
    """Scores joined with the truth on the transaction id."""
    return _joined(spark, sf_dir)


@register("confusion_matrix")
def q_confusion_matrix(spark, sf_dir):
    """Tp, fp, tn, fn of the joined scores."""
    return ev.confusion_matrix(_joined(spark, sf_dir))


@register("classification_metrics")
def q_classification_metrics(spark, sf_dir):
    """A6 + A7: confusion counts with accuracy, precision, recall, F1."""
    return ev.evaluate_predictions(_joined(spark, sf_dir))


@register("auc_exact")
def q_auc_exact(spark, sf_dir):
    """Exact area under ROC of the joined scores."""
    return ev.auc_exact(_joined(spark, sf_dir))


@register("auc_continuous")
def q_auc_continuous(spark, sf_dir):
    """L6 on about as many distinct scores as rows."""
    return ev.auc_exact(_continuous(spark, sf_dir))


@register("auc_binned")
def q_auc_binned(spark, sf_dir):
    """L6 as the reference runs it: MLlib's evaluator (1,000-bin ROC), one row.

    Rounded to 9 places: the evaluator's trapezoid sum differs from the exact
    rank form only by floating-point error when scores have fewer distinct
    values than bins, as here."""
    auc = ev.auc_binned(_joined(spark, sf_dir))
    return spark.createDataFrame([(round(auc, 9),)], "auc double")


@register("top_risk")
def q_top_risk(spark, sf_dir):
    """O1: the 100 highest-risk transactions."""
    return ev.top_risk(td.scored(spark, sf_dir), 100)


# --- sources and sinks (S1-S5) through files ---------------------------------

@register("csv_round_trip")
def q_csv_round_trip(spark, sf_dir):
    """S4 then S1: raw transactions to CSV and back with the explicit schema."""
    path = scratch_path(spark, "raw-csv")
    io.write_csv(td.transactions(spark, sf_dir), path)
    return io.read_transactions(spark, path)


@register("read_with_casts")
def q_read_with_casts(spark, sf_dir):
    """S4 then S2: the scored table to CSV, read back as text and cast by a dict."""
    path = scratch_path(spark, "scored-csv")
    io.write_csv(td.scored(spark, sf_dir), path)
    return io.read_with_casts(spark, path, pl.SCORED_CASTS)


def _damaged_lines(spark, sf_dir) -> DataFrame:
    """The transactions as CSV lines, some of them damaged: a field that is no number, a line cut
    short, one with a field too many; and some with an empty amount, which is none."""
    i = F.col("transaction_id")
    amount = F.when(i % 7 == 0, F.lit("12.5x")).when(i % 5 == 0, F.lit("")).otherwise(F.col("amount").cast("string"))
    stamp = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    fields = [F.col(c).cast("string") for c in ("transaction_id", "customer_id")] + [stamp, amount, F.col("merchant_category"),
                                                                                      F.col("is_fraud").cast("string")]
    line = (F.when(i % 11 == 0, F.concat_ws(",", *fields[:3])).when(i % 13 == 0, F.concat_ws(",", *fields, F.lit("more")))
            .otherwise(F.concat_ws(",", *fields)))
    return td.transactions(spark, sf_dir).select(line.alias("value"))


def _checked(spark, sf_dir) -> io.CheckedRows:
    path = scratch_path(spark, "damaged-csv")
    _damaged_lines(spark, sf_dir).write.text(path)
    return io.read_checked(spark, path, header=False, quarantine=scratch_path(spark, "quarantine"))


@register("csv_checked")
def q_csv_checked(spark, sf_dir):
    """S1 on a damaged file: the rows that could be read, every value."""
    return _checked(spark, sf_dir).good


@register("csv_quarantine")
def q_csv_quarantine(spark, sf_dir):
    """S1 on a damaged file: the lines that could not, as they were, from the quarantine table."""
    return _checked(spark, sf_dir).bad.select("line")


@register("casts_checked")
def q_casts_checked(spark, sf_dir):
    """S2 on scored rows of which some hold text that is no number: rows by what failed."""
    i, path = F.col("transaction_id"), scratch_path(spark, "scored-csv")
    broken = td.scored(spark, sf_dir).withColumns({
        "prob_1": F.when(i % 9 == 0, F.lit("n/a")).otherwise(F.col("prob_1").cast("string")),
        "prediction": F.when(i % 6 == 0, F.lit("yes")).when(i % 10 == 1, F.lit(None)).otherwise(F.col("prediction").cast("string"))})
    io.write_csv(broken, path)
    checked = io.read_with_casts_checked(spark, path, pl.SCORED_CASTS)
    good = checked.good.select(F.lit("").alias("failed"), "prob_1", "prediction")
    return (good.unionByName(checked.bad.select("failed", F.lit(None).cast("double").alias("prob_1"), F.lit(None).cast("double").alias("prediction")))
            .groupBy("failed").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("prob_1"), 6).alias("prob_1"), F.count("prediction").alias("predictions")))


@register("features_via_files")
def q_features_via_files(spark, sf_dir):
    """Q1 end to end: CSV -> preprocess -> features -> parquet, read back (S3)."""
    raw_path = scratch_path(spark, "raw-csv")
    out_path = scratch_path(spark, "features")
    io.write_csv(td.transactions(spark, sf_dir), raw_path)
    pl.feature_pipeline(spark, raw_path, out_path)
    drop_scratch(spark, raw_path)
    return _places(io.read_features(spark, out_path))


def _in_batches(tx: DataFrame) -> list[DataFrame]:
    """Thirds of the covered time; every tenth row, by its id, comes a batch late."""
    seconds = F.unix_micros(F.col("timestamp").cast("timestamp"))
    span = tx.agg(F.min(seconds).alias("first"), F.max(seconds).alias("last")).first()
    cut = [span.first + (span.last - span.first) * i // 3 for i in (1, 2)]
    due = F.when(seconds < cut[0], 0).when(seconds < cut[1], 1).otherwise(2) + F.when(F.col("transaction_id") % 10 == 0, 1).otherwise(0)
    return [tx.where(F.least(due, F.lit(2)) == i) for i in range(3)]


@register("features_by_batches")
def q_features_by_batches(spark, sf_dir):
    """Q1 batch by batch: three batches, some rows late, the second one given twice."""
    store = scratch_path(spark, "feature-store")
    batches = _in_batches(td.transactions(spark, sf_dir))
    for i in (0, 1, 1, 2):
        inc.apply_batch(spark, store, batches[i], f"batch {i}")
    return _places(inc.feature_table(spark, store))


@register("incremental_via_files")
def q_incremental_via_files(spark, sf_dir):
    """Q1 for new CSV files: each is parsed and added to the store."""
    store = scratch_path(spark, "feature-store")
    for i, batch in enumerate(_in_batches(td.transactions(spark, sf_dir))):
        path = scratch_path(spark, "raw-csv")
        io.write_csv(batch, path)
        inc.incremental_feature_pipeline(spark, path, store, str(i))
        drop_scratch(spark, path)
    return _places(inc.feature_table(spark, store))


def _table_name(path: str) -> str:
    return path.rsplit("/", 1)[1].replace("-", "_")


@register("features_bucketed_table")
def q_features_bucketed_table(spark, sf_dir):
    """S5 + W4: transactions bucketed by customer (some heavy, kept apart), features without an exchange of the ordinary."""
    path = scratch_path(spark, "customers")
    table = bucketed.write_customer_table(td.transactions(spark, sf_dir), _table_name(path), path, heavy_rows=70)
    return _places(feat.table_features(table.ordinary, table.heavy))


@register("join_truth_bucketed")
def q_join_truth_bucketed(spark, sf_dir):
    """S5 + J1: scores and truth bucketed by transaction, joined bucket by bucket."""
    sides = []
    for df in (td.scored(spark, sf_dir).select("transaction_id", "prob_1", "prediction"), td.truth(spark, sf_dir)):
        path = scratch_path(spark, "bucketed")
        sides.append(bucketed.write_bucketed(df, _table_name(path), path, ["transaction_id"]))
    return ev.join_truth(*sides)


@register("feature_round_trip")
def q_feature_round_trip(spark, sf_dir):
    """S5 then S3: the feature table written as parquet and read back."""
    path = scratch_path(spark, "features")
    io.write_features(feat.full_feature_engineering(td.transactions(spark, sf_dir)), path)
    return _places(io.read_features(spark, path))


@register("split_via_files")
def q_split_via_files(spark, sf_dir):
    """Q2 with the stable split: CSV -> two CSVs, read back and tagged."""
    raw_path = scratch_path(spark, "raw-csv")
    train_path, inf_path = scratch_path(spark, "train-csv"), scratch_path(spark, "inf-csv")
    io.write_csv(td.transactions(spark, sf_dir), raw_path)
    pl.split_pipeline(spark, raw_path, train_path, inf_path, stable_key="transaction_id")
    return (io.read_transactions(spark, train_path).withColumn("split", F.lit("train"))
            .unionByName(io.read_transactions(spark, inf_path)
                         .withColumn("split", F.lit("inference"))))


@register("labels_via_files")
def q_labels_via_files(spark, sf_dir):
    """Q5: feature table -> text labels as 1.0 / 0.0 -> CSV, read back."""
    feat_path, out_path = scratch_path(spark, "features"), scratch_path(spark, "labels-csv")
    io.write_features(td.transactions(spark, sf_dir), feat_path)
    pl.label_pipeline(spark, feat_path, out_path)
    drop_scratch(spark, feat_path)
    return io.read_with_casts(spark, out_path, {"transaction_id": "bigint", **pl.LABEL_CASTS})


def _scored_and_label_files(spark, sf_dir) -> tuple[str, str]:
    scored_path, labels_path = scratch_path(spark, "scored-csv"), scratch_path(spark, "labels-csv")
    io.write_csv(td.scored(spark, sf_dir), scored_path)
    io.write_csv(td.truth(spark, sf_dir), labels_path)
    return scored_path, labels_path


@register("monitoring_auc")
def q_monitoring_auc(spark, sf_dir):
    """Q6 from files: exact AUC of the joined scores."""
    auc, _ = pl.monitoring_pipeline(spark, *_scored_and_label_files(spark, sf_dir))
    return auc


@register("monitoring_distribution")
def q_monitoring_distribution(spark, sf_dir):
    """Q6 from files: prediction counts of the joined scores."""
    _, dist = pl.monitoring_pipeline(spark, *_scored_and_label_files(spark, sf_dir))
    return dist


@register("evaluation_metrics")
def q_evaluation_metrics(spark, sf_dir):
    """Q7 from files: confusion counts and metrics."""
    return pl.evaluation_pipeline(spark, *_scored_and_label_files(spark, sf_dir)).metrics


@register("evaluation_histogram")
def q_evaluation_histogram(spark, sf_dir):
    """Q7 from files: histogram of the joined probabilities."""
    return pl.evaluation_pipeline(spark, *_scored_and_label_files(spark, sf_dir)).histogram


# --- learning and scoring (L1-L5, P7, P9, S6, S7, Q3, Q4) ----------------------
#
# MLlib's ten iterations have no closed form, so the queries that show them get a rows-only check.
# The same operators are checked value by value where one is known:
# * one indicator a category with one left out saturates the model: without a penalty each
#   row's probability is its category's weighted fraud rate;
# * a single feature ranks as itself whatever the penalty: every AUC is the feature's own;
# * a converged fit of the five features is the only optimum, which SQL finds by Newton's method.

def _train_and_inference(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Split the raw rows (stable, by transaction) and build features on each side,
    in the reference's order (split first, then features).  The training side
    feeds the class counts and every fit, so it is materialised once."""
    train_raw, inf_raw = sampling.stable_split(td.transactions(spark, sf_dir))
    return (materialize(feat.full_feature_engineering(train_raw)),
            feat.full_feature_engineering(inf_raw))


@register("train_cv_metrics")
def q_train_cv_metrics(spark, sf_dir):
    """Q3's cross-validation: average AUC per regParam (3 rows)."""
    train, _ = _train_and_inference(spark, sf_dir)
    result = ml.train_with_cv(pl.training_frame(train))
    return result.metrics(spark)


@register("score_batch")
def q_score_batch(spark, sf_dir):
    """Q3 -> S6 -> S7 -> Q4: fit, save, load, score the inference side (flattened)."""
    train, inference = _train_and_inference(spark, sf_dir)
    model = ml.fit_logistic(pl.training_frame(train), reg_param=REG_PARAMS[0])
    path = scratch_path(spark, "model")
    io.save_model(model, path)
    loaded = io.load_model(path)
    return ml.score(loaded, prep.assemble_features(inference))


@register("training_via_files")
def q_training_via_files(spark, sf_dir):
    """Q3 end to end: training features written as a table (S5), then read (S3) ->
    assemble + int label (L1) -> class weights (A2) -> CV (L3) -> model AUC (L5) ->
    saved model (S6).  Returns the grid metrics with the model's training AUC."""
    train, _ = _train_and_inference(spark, sf_dir)
    feat_path, model_path = scratch_path(spark, "train-features"), scratch_path(spark, "model")
    io.write_features(train, feat_path)
    result = pl.training_pipeline(spark, feat_path, model_path)
    return result.cv.metrics(spark).withColumn("model_auc", F.lit(float(result.auc)))


@register("scoring_via_files")
def q_scoring_via_files(spark, sf_dir):
    """Q4 end to end: inference features as a table + a saved model -> assemble (P9) ->
    score (L4) -> flatten (P7) -> scored CSV (S4), read back with casts (S2)."""
    train, inference = _train_and_inference(spark, sf_dir)
    model = ml.fit_logistic(pl.training_frame(train), reg_param=REG_PARAMS[0])
    feat_path, model_path = scratch_path(spark, "inf-features"), scratch_path(spark, "model")
    out_path = scratch_path(spark, "scored-csv")
    io.write_features(inference, feat_path)
    io.save_model(model, model_path)
    pl.scoring_pipeline(spark, feat_path, model_path, out_path)
    return io.read_with_casts(spark, out_path, pl.SCORED_CASTS)


def _indicators(df: DataFrame, levels: list[str]) -> tuple[DataFrame, list[str]]:
    names = [f"is_{i}" for i in range(1, len(levels))]
    return df.withColumns({n: (F.col("merchant_category") == F.lit(x)).cast("double")
                           for n, x in zip(names, levels[1:])}), names


def _saturated_model(spark, sf_dir) -> tuple[str, DataFrame, list[str]]:
    """The path of a model saved after a fit on category indicators, the inference rows
    with their indicators, and the indicators' names."""
    train, inference = sampling.stable_split(td.transactions(spark, sf_dir))
    levels = sorted(r[0] for r in train.select("merchant_category").distinct().collect())
    train, names = _indicators(train, levels)
    model = ml.fit_logistic(pl.training_frame(train, names), reg_param=0.0, max_iter=100, tol=1e-9)
    path = scratch_path(spark, "model")
    io.save_model(model, path)
    return path, _indicators(inference, levels)[0], names


@register("score_saturated")
def q_score_saturated(spark, sf_dir):
    """Probabilities of every inference row, to 5 places."""
    path, inference, names = _saturated_model(spark, sf_dir)
    scored = ml.score(io.load_model(path), prep.assemble_features(inference, names))
    return scored.withColumns({c: F.round(c, 5) for c in ("prob_0", "prob_1")})


@register("scoring_saturated_via_files")
def q_scoring_saturated_via_files(spark, sf_dir):
    """Q4 on the saturated model: feature table and saved model -> scored CSV, read back."""
    path, inference, names = _saturated_model(spark, sf_dir)
    feat_path, out_path = scratch_path(spark, "inf-features"), scratch_path(spark, "scored-csv")
    io.write_features(inference, feat_path)
    pl.scoring_pipeline(spark, feat_path, path, out_path, feature_columns=names)
    scored = io.read_with_casts(spark, out_path, {**pl.SCORED_CASTS, "transaction_id": "bigint", "customer_id": "bigint"})
    return scored.withColumns({c: F.round(c, 5) for c in ("prob_0", "prob_1")})


def _one_feature(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Training and inference rows with one noisy feature of under 1,000 values (so that the
    evaluator's curve is exact) and a fold from the id's md5."""
    bits = F.conv(F.substring(F.md5(F.col("transaction_id").cast("string")), 1, 8), 16, 10).cast("long")
    tx = td.transactions(spark, sf_dir).withColumns({
        "noisy_amount": F.floor(F.col("amount") / 20) + F.pmod(bits, F.lit(10)),
        "fold": F.pmod(F.floor(bits / 16), F.lit(3)).cast("int")})
    return sampling.stable_split(tx)


@register("cv_one_feature")
def q_cv_one_feature(spark, sf_dir):
    """L3 with given folds on one feature: the mean of the folds' AUC for every penalty."""
    train, _ = _one_feature(spark, sf_dir)
    result = ml.train_with_cv(pl.training_frame(train, ["noisy_amount"]), fold_col="fold")
    return result.metrics(spark).withColumn("avg_auc", F.round("avg_auc", 9))


@register("training_one_feature_via_files")
def q_training_one_feature_via_files(spark, sf_dir):
    """Q3 from a table with given folds on one feature: grid metrics and the model's AUC."""
    train, _ = _one_feature(spark, sf_dir)
    feat_path, model_path = scratch_path(spark, "train-features"), scratch_path(spark, "model")
    io.write_features(train, feat_path)
    result = pl.training_pipeline(spark, feat_path, model_path, feature_columns=["noisy_amount"], fold_col="fold")
    return (result.cv.metrics(spark).withColumn("avg_auc", F.round("avg_auc", 9))
            .withColumn("model_auc", F.lit(round(float(result.auc), 9))))


@register("model_auc_one_feature")
def q_model_auc_one_feature(spark, sf_dir):
    """The one-feature model's AUC on training and on held-out rows."""
    train, inference = _one_feature(spark, sf_dir)
    data = pl.training_frame(train, ["noisy_amount"])
    model = ml.fit_logistic(data, reg_param=REG_PARAMS[0])
    rows = [(side, round(ml.auc_model(model, x), 9)) for side, x in
            (("train", data), ("inference", ml.prepare_training(inference, ["noisy_amount"])))]
    return spark.createDataFrame(rows, "rows string, auc double")


# The optimum on the five features is unique: a converged fit is checked against Newton's steps in SQL.
CONVERGED = {"max_iter": 1000, "tol": 1e-13}


def _five_features(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Training and inference features, the training rows with a fold from the id's md5."""
    train, inference = _train_and_inference(spark, sf_dir)
    bits = F.conv(F.substring(F.md5(F.col("transaction_id").cast("string")), 1, 8), 16, 10).cast("long")
    return train.withColumn("fold", F.pmod(F.floor(bits / 16), F.lit(3)).cast("int")), inference


@register("cv_five_features")
def q_cv_five_features(spark, sf_dir):
    """L3 with given folds on the five features: every penalty's mean AUC, the best one told."""
    train, _ = _five_features(spark, sf_dir)
    result = ml.train_with_cv(pl.training_frame(train), fold_col="fold")
    return result.metrics(spark).withColumn("avg_auc", F.round("avg_auc", 6))


@register("training_five_features_via_files")
def q_training_five_features_via_files(spark, sf_dir):
    """Q3 from a table with given folds on the five features: grid metrics of the pipeline."""
    train, _ = _five_features(spark, sf_dir)
    feat_path, model_path = scratch_path(spark, "train-features"), scratch_path(spark, "model")
    io.write_features(train, feat_path)
    result = pl.training_pipeline(spark, feat_path, model_path, fold_col="fold")
    return result.cv.metrics(spark).withColumn("avg_auc", F.round("avg_auc", 6))


@register("fit_five_features")
def q_fit_five_features(spark, sf_dir):
    """L2 for every penalty: coefficients of MLlib's converged fits and of the shared passes."""
    train, _ = _train_and_inference(spark, sf_dir)
    data, d = pl.training_frame(train), len(FEATURE_COLUMNS)
    found = [("mllib", reg, m.intercept, m.coefficients.toArray()) for reg in REG_PARAMS
             for m in [ml.fit_logistic(data, reg_param=reg, **CONVERGED)]]
    found += [("shared", f.reg_param, f.intercept, f.coefficients)
              for f in newton.fit_grid(newton.narrow(data), [(None, reg) for reg in REG_PARAMS], d)]
    rows = [(solver, reg, term, round(float(b), 6)) for solver, reg, b0, b in found
            for term, b in zip(("intercept", *FEATURE_COLUMNS), (b0, *b))]
    return spark.createDataFrame(rows, "solver string, reg_param double, term string, coefficient double")


@register("fit_certificate")
def q_fit_certificate(spark, sf_dir):
    """L2: the loss of the reference's ten iterations and of converged fits, each certified to be
    within 1e-8 of its optimum by the gradient and Hessian at its coefficients."""
    train, _ = _train_and_inference(spark, sf_dir)
    data, rows = pl.training_frame(train), []
    for reg in REG_PARAMS:
        for name, kw in (("reference", {}), ("converged", CONVERGED)):
            told = ml.fit_certificate(data, ml.fit_logistic(data, reg_param=reg, **kw), reg)
            rows.append((reg, name, round(told["loss"], 8), 0 <= told["gap"] + 1e-15 < 1e-8 and told["norm"] < 1e-4))
    return spark.createDataFrame(rows, "reg_param double, model string, loss double, near_optimum boolean")


@register("score_five_features")
def q_score_five_features(spark, sf_dir):
    """L2, S6, S7, P9, L4, P7 on the five features: converged probabilities of every inference row, to 3
    places: a quasi-Newton fit is within 1e-8 of the optimum, so finer ones would tell luck."""
    train, inference = _train_and_inference(spark, sf_dir)
    path = scratch_path(spark, "model")
    io.save_model(ml.fit_logistic(pl.training_frame(train), reg_param=REG_PARAMS[0], **CONVERGED), path)
    scored = ml.score(io.load_model(path), prep.assemble_features(inference))
    return scored.withColumns({c: F.round(c, 3) for c in ("prob_0", "prob_1")})


@register("scoring_five_features_via_files")
def q_scoring_five_features_via_files(spark, sf_dir):
    """Q4 on the five features: feature table and saved model -> scored CSV, read back."""
    train, inference = _train_and_inference(spark, sf_dir)
    feat_path, model_path, out_path = (scratch_path(spark, n) for n in ("inf-features", "model", "scored-csv"))
    io.write_features(inference, feat_path)
    io.save_model(ml.fit_logistic(pl.training_frame(train), reg_param=REG_PARAMS[0], **CONVERGED), model_path)
    pl.scoring_pipeline(spark, feat_path, model_path, out_path)
    scored = io.read_with_casts(spark, out_path, {**pl.SCORED_CASTS, "transaction_id": "bigint", "customer_id": "bigint"})
    return scored.withColumns({c: F.round(c, 3) for c in ("prob_0", "prob_1")})


@register("model_auc_five_features")
def q_model_auc_five_features(spark, sf_dir):
    """L5 on the five features: exact AUC of the converged model's scores on both sides, and
    whether MLlib's evaluator, with its 1,000 bins, is within a thousandth."""
    train, inference = _train_and_inference(spark, sf_dir)
    data, rows = pl.training_frame(train), []
    model = ml.fit_logistic(data, reg_param=REG_PARAMS[0], **CONVERGED)
    for side, x in (("train", data), ("inference", ml.prepare_training(inference))):
        exact = ev.auc_exact(ml.score(model, x, ("is_fraud",))).first()["auc"]
        rows.append((side, round(exact, 6), abs(ml.auc_model(model, x) - exact) < 1e-3))
    return spark.createDataFrame(rows, "rows string, auc double, evaluator_agrees boolean")


@register("distinct_weights")
def q_distinct_weights(spark, sf_dir):
    """A10: the distinct (label, weight) pairs of the training rows."""
    train, _ = sampling.stable_split(td.transactions(spark, sf_dir))
    return agg.add_class_weight(prep.label_to_int(train)).select("is_fraud", "class_weight").distinct()


@register("training_weights")
def q_training_weights(spark, sf_dir):
    """L1 + A2 on the training side: the int label and class weight of every training row."""
    train, _ = _train_and_inference(spark, sf_dir)
    return pl.training_frame(train).select("transaction_id", "is_fraud", "class_weight")


@register("scored_rows")
def q_scored_rows(spark, sf_dir):
    """L4 keeps every inference row exactly once: the scored ids, with a valid prediction."""
    train, inference = _train_and_inference(spark, sf_dir)
    model = ml.fit_logistic(pl.training_frame(train), reg_param=REG_PARAMS[0])
    scored = ml.score(model, prep.assemble_features(inference))
    return scored.select("transaction_id", "customer_id",
                         F.col("prediction").isin(0.0, 1.0).alias("has_prediction"))


@register("model_auc")
def q_model_auc(spark, sf_dir):
    """Model AUC on its training rows and on the held-out rows (2 rows)."""
    train, inference = _train_and_inference(spark, sf_dir)
    data = pl.training_frame(train)
    model = ml.fit_logistic(data, reg_param=REG_PARAMS[0])
    held_out = ml.prepare_training(inference)
    rows = [("train", ml.auc_model(model, data)), ("inference", ml.auc_model(model, held_out))]
    return spark.createDataFrame(rows, "rows string, auc double")


# --- the same operators run incrementally (Structured Streaming) --------------

@register("stream_prediction_counts")
def q_stream_prediction_counts(spark, sf_dir):
    """A5 as a running aggregate: scored files arrive as a stream (one file per
    trigger); the counts table is rewritten per micro-batch; read back when done."""
    source, out = scratch_path(spark, "scored-files"), scratch_path(spark, "counts")
    scored = td.scored(spark, sf_dir)
    scored.write.parquet(source)
    incoming = spark.readStream.schema(scored.schema).option("maxFilesPerTrigger", 1) \
        .parquet(source)
    stream.run_to_end(stream.start_table_sink(stream.prediction_counts_stream(incoming), out))
    return stream.read_table_sink(spark, out)


@register("stream_scoring")
def q_stream_scoring(spark, sf_dir):
    """L4 + P7 on inference feature files arriving as a stream, with a model fitted on
    the training side; the scored rows are appended to files and read back."""
    train, inference = _train_and_inference(spark, sf_dir)
    model = ml.fit_logistic(pl.training_frame(train), reg_param=REG_PARAMS[0])
    source, out = scratch_path(spark, "feature-files"), scratch_path(spark, "scored")
    inference.write.parquet(source)
    incoming = stream.read_feature_stream(spark, source, inference.schema)
    stream.run_to_end(stream.start_file_sink(stream.score_stream(model, incoming), out))
    return spark.read.parquet(out)
