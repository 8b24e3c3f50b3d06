"""DuckDB SQL twins of the registered queries (same column names and types).

Rules that keep the two engines bit-equal:
* epoch seconds are ``CAST(floor(epoch(ts)) AS BIGINT)`` (a bare cast rounds);
* ``dayofweek`` is ``extract(dow) + 1`` (1 = Sunday);
* amounts are summed as doubles and rounded to 6 places on both sides.
"""

from __future__ import annotations

from ..constants import VELOCITY_WINDOW_SECONDS as W
from ..sources.testdata import SQL_SCORED, SQL_TRANSACTIONS, SQL_TRUTH

ORACLE: dict[str, str] = {}

_RAW = 'transaction_id, customer_id, "timestamp", amount, merchant_category, is_fraud'
_SECS = 'CAST(floor(epoch("timestamp")) AS BIGINT)'
_FRAME = (f"PARTITION BY customer_id ORDER BY timestamp_seconds "
          f"RANGE BETWEEN {W} PRECEDING AND CURRENT ROW")
_WITH_SECS = f"""WITH {SQL_TRANSACTIONS},
with_secs AS (SELECT *, {_SECS} AS timestamp_seconds FROM transactions)"""

# --- window features -----------------------------------------------------------

ORACLE["transaction_velocity"] = f"""{_WITH_SECS}
SELECT {_RAW}, timestamp_seconds,
       COUNT(transaction_id) OVER ({_FRAME}) AS transaction_velocity
FROM with_secs"""

ORACLE["amount_velocity"] = f"""{_WITH_SECS}
SELECT {_RAW}, timestamp_seconds,
       round(SUM(amount) OVER ({_FRAME}), 6) AS amount_velocity
FROM with_secs"""

ORACLE["velocity_features"] = f"""{_WITH_SECS}
SELECT {_RAW}, timestamp_seconds,
       COUNT(transaction_id) OVER ({_FRAME}) AS transaction_velocity,
       round(SUM(amount) OVER ({_FRAME}), 6) AS amount_velocity
FROM with_secs"""

ORACLE["category_profile"] = f"""WITH {SQL_TRANSACTIONS}
SELECT {_RAW},
       COUNT(transaction_id) OVER (PARTITION BY customer_id, merchant_category)
         AS merchant_category_count
FROM transactions"""

ORACLE["category_profile_running"] = f"""{_WITH_SECS}
SELECT {_RAW}, timestamp_seconds,
       COUNT(transaction_id) OVER (PARTITION BY customer_id, merchant_category ORDER BY timestamp_seconds
                                   RANGE UNBOUNDED PRECEDING) AS merchant_category_count
FROM with_secs"""

_TIME = ('CAST(hour("timestamp") AS INTEGER) AS hour_of_day, '
         'CAST(extract(dow FROM "timestamp") + 1 AS INTEGER) AS day_of_week')

ORACLE["time_patterns"] = f"""WITH {SQL_TRANSACTIONS}
SELECT {_RAW}, {_TIME} FROM transactions"""

def _features_sql(source_where: str | None = None) -> str:
    """The feature table over ``transactions`` (optionally only rows matching a filter)."""
    rows = "transactions" if source_where is None else (
        f"(SELECT * FROM transactions WHERE {source_where})")
    return f"""WITH {SQL_TRANSACTIONS},
with_secs AS (SELECT *, {_SECS} AS timestamp_seconds FROM {rows}),
features AS (
  SELECT {_RAW}, timestamp_seconds,
         COUNT(transaction_id) OVER ({_FRAME}) AS transaction_velocity,
         round(SUM(amount) OVER ({_FRAME}), 6) AS amount_velocity,
         COUNT(transaction_id) OVER (PARTITION BY customer_id, merchant_category)
           AS merchant_category_count,
         {_TIME}
  FROM with_secs)"""


_FEATURES_SQL = _features_sql()

ORACLE["feature_engineering"] = f"""{_FEATURES_SQL}
SELECT * FROM features"""

# --- projections and casts ----------------------------------------------------

# Text -> value round trips are the identity on these tables.
ORACLE["preprocess"] = f"""WITH {SQL_TRANSACTIONS}
SELECT {_RAW} FROM transactions"""

ORACLE["label_to_int"] = f"""WITH {SQL_TRANSACTIONS}
SELECT transaction_id, customer_id, "timestamp", amount, merchant_category,
       CAST(is_fraud AS INTEGER) AS is_fraud
FROM transactions"""

ORACLE["label_to_double"] = f"""WITH {SQL_TRANSACTIONS}
SELECT transaction_id,
       CASE WHEN CAST(is_fraud AS VARCHAR) = 'true' THEN 1.0::DOUBLE
            WHEN CAST(is_fraud AS VARCHAR) = 'false' THEN 0.0::DOUBLE END AS is_fraud
FROM transactions"""

ORACLE["label_slice"] = f"""WITH {SQL_TRANSACTIONS}
SELECT {_RAW} FROM transactions WHERE CAST(is_fraud AS INTEGER) = 1"""

# --- sampling -----------------------------------------------------------------


def _in_first_side(key: str, seed: int = 42, percent: int = 80) -> str:
    bucket = (f"CAST(('0x' || substr(md5(CAST({key} AS VARCHAR) || ':{seed}'), 1, 8)) AS BIGINT)"
              " % 1000000")
    return f"coalesce({bucket} < {percent * 10000}, false)"


def _split_sql(key: str, seed: int = 42, percent: int = 80) -> str:
    return f"""WITH {SQL_TRANSACTIONS}
SELECT {_RAW},
       CASE WHEN {_in_first_side(key, seed, percent)} THEN 'train' ELSE 'inference' END AS split
FROM transactions"""


ORACLE["stable_split"] = _split_sql("transaction_id")
ORACLE["stable_split_by_customer"] = _split_sql("customer_id")

# Split first, then features on each side (the reference's order).
ORACLE["train_features"] = f"""{_features_sql(_in_first_side('transaction_id'))}
SELECT * FROM features"""
ORACLE["inference_features"] = f"""{_features_sql(f"NOT {_in_first_side('transaction_id')}")}
SELECT * FROM features"""

# --- class balance ---------------------------------------------------------------

_COUNTS = """SELECT count(*) AS total,
       count(*) FILTER (WHERE CAST(is_fraud AS INTEGER) = 1) AS positive,
       count(*) FILTER (WHERE CAST(is_fraud AS INTEGER) = 0) AS negative
FROM transactions"""

ORACLE["class_counts"] = f"""WITH {SQL_TRANSACTIONS}
{_COUNTS}"""

ORACLE["class_weight"] = f"""WITH {SQL_TRANSACTIONS}, c AS ({_COUNTS})
SELECT transaction_id, CAST(is_fraud AS INTEGER) AS is_fraud,
       CASE WHEN CAST(is_fraud AS INTEGER) = 1
            THEN CAST(total AS DOUBLE) / CAST(2 * positive AS DOUBLE)
            ELSE CAST(total AS DOUBLE) / CAST(2 * negative AS DOUBLE) END AS class_weight
FROM transactions, c"""

# --- summaries --------------------------------------------------------------------


def _describe_part(c: str, text: bool = False) -> str:
    if text:
        return (f"SELECT '{c}' AS \"column\", count({c}) AS count, NULL::DOUBLE AS mean, "
                f"NULL::DOUBLE AS stddev, NULL::DOUBLE AS min, NULL::DOUBLE AS max, "
                f"min({c}) AS min_text, max({c}) AS max_text FROM transactions")
    x = f"CAST({c} AS DOUBLE)"
    return (f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({x}), 6) AS mean, "
            f"round(stddev_samp({x}), 6) AS stddev, min({x}) AS min, max({x}) AS max, "
            f"{_exact_text(c, 'min')} AS min_text, {_exact_text(c, 'max')} AS max_text FROM transactions")


def _exact_text(c: str, which: str) -> str:
    """The extreme's text for integer columns, null for the two columns of doubles."""
    return "NULL::VARCHAR" if c in ("amount", "amount_velocity") else f"CAST({which}({c}) AS VARCHAR)"


ORACLE["describe"] = f"""WITH {SQL_TRANSACTIONS}
{' UNION ALL '.join([_describe_part(c) for c in ('transaction_id', 'customer_id', 'amount')]
                    + [_describe_part('merchant_category', text=True)])}"""


def _describe_features_part(c: str, text: bool = False) -> str:
    return _describe_part(c, text).replace("FROM transactions", "FROM features")


ORACLE["describe_features"] = f"""{_FEATURES_SQL}
{' UNION ALL '.join([_describe_features_part(c) for c in (
    'transaction_velocity', 'amount_velocity', 'merchant_category_count', 'hour_of_day',
    'day_of_week')] + [_describe_features_part('merchant_category', text=True)])}"""


def _distribution_part(c: str) -> str:
    x = f"CAST({c} AS DOUBLE)"
    return (f"SELECT '{c}' AS feature, round(avg({x}), 6) AS mean, "
            f"round(stddev_samp({x}), 6) AS stddev, count({c}) AS count FROM features")


ORACLE["feature_distribution"] = f"""{_FEATURES_SQL}
{' UNION ALL '.join(_distribution_part(c) for c in (
    'transaction_velocity', 'amount_velocity', 'merchant_category_count',
    'hour_of_day', 'day_of_week'))}"""

_JOINED = f"""WITH {SQL_SCORED}, {SQL_TRUTH},
joined AS (SELECT s.transaction_id, s.prob_1, s.prediction, t.is_fraud
           FROM scored s JOIN truth t ON s.transaction_id = t.transaction_id)"""

ORACLE["join_truth"] = f"""{_JOINED}
SELECT * FROM joined"""

ORACLE["prediction_distribution"] = f"""{_JOINED}
SELECT prediction, count(*) AS count FROM joined GROUP BY prediction"""


def _histogram_sql(source: str, bins: int = 20) -> str:
    def edge(i: str) -> str:
        return f"(CASE WHEN {i} >= {bins} THEN hi ELSE CAST({i} AS DOUBLE) * step + lo END)"
    return f"""{source},
mm AS (SELECT min(prob_1) AS mn, max(prob_1) AS mx FROM joined),
rng AS (SELECT CASE WHEN mn IS NULL THEN 0.0 WHEN mn = mx THEN mn - 0.5 ELSE mn END AS lo,
               CASE WHEN mn IS NULL THEN 1.0 WHEN mn = mx THEN mx + 0.5 ELSE mx END AS hi
        FROM mm),
p AS (SELECT lo, hi, (hi - lo) / {bins} AS step FROM rng),
g AS (SELECT prob_1 AS v, lo, hi, step,
             least(greatest(CAST(floor((prob_1 - lo) / (hi - lo) * {float(bins)}) AS BIGINT), 0),
                   {bins - 1}) AS guess
      FROM joined, p WHERE prob_1 IS NOT NULL AND prob_1 >= lo AND prob_1 <= hi),
b AS (SELECT CASE WHEN v < {edge('guess')} THEN guess - 1
                  WHEN v >= {edge('guess + 1')} AND guess <> {bins - 1} THEN guess + 1
                  ELSE guess END AS bin FROM g),
c AS (SELECT bin, count(*) AS cnt FROM b GROUP BY bin),
allb AS (SELECT CAST(range AS INTEGER) AS bin FROM range({bins}))
SELECT allb.bin AS bin, {edge('allb.bin')} AS lower, {edge('allb.bin + 1')} AS upper,
       coalesce(c.cnt, 0) AS count
FROM allb LEFT JOIN c ON allb.bin = c.bin, p"""


ORACLE["probability_histogram"] = _histogram_sql(_JOINED)

_CONFUSION = """SELECT count(*) FILTER (WHERE prediction = 1.0 AND is_fraud = 1.0) AS tp,
       count(*) FILTER (WHERE prediction = 1.0 AND is_fraud = 0.0) AS fp,
       count(*) FILTER (WHERE prediction = 0.0 AND is_fraud = 0.0) AS tn,
       count(*) FILTER (WHERE prediction = 0.0 AND is_fraud = 1.0) AS fn
FROM joined"""

ORACLE["confusion_matrix"] = f"""{_JOINED}
{_CONFUSION}"""

_METRICS = f"""cm AS ({_CONFUSION}),
pr AS (SELECT *,
  CASE WHEN tp + fp + tn + fn > 0
       THEN CAST(tp + tn AS DOUBLE) / CAST(tp + tn + fp + fn AS DOUBLE) END AS accuracy,
  CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) ELSE 0.0 END
    AS "precision",
  CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / CAST(tp + fn AS DOUBLE) ELSE 0.0 END
    AS recall
  FROM cm)
SELECT tp, fp, tn, fn, accuracy, "precision", recall,
       CASE WHEN "precision" + recall > 0
            THEN 2.0::DOUBLE * "precision" * recall / ("precision" + recall) ELSE 0.0 END
         AS f1_score
FROM pr"""

ORACLE["classification_metrics"] = f"""{_JOINED},
{_METRICS}"""

_AUC = """d AS (SELECT CAST(prob_1 AS DOUBLE) AS score,
                  count(*) FILTER (WHERE is_fraud = 1.0) AS pos,
                  count(*) FILTER (WHERE is_fraud = 0.0) AS neg
           FROM joined WHERE prob_1 IS NOT NULL AND is_fraud IN (0.0, 1.0) GROUP BY 1),
c AS (SELECT pos, neg,
             coalesce(sum(neg) OVER (ORDER BY score
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
               AS nb
      FROM d)
SELECT CASE WHEN sum(pos) > 0 AND sum(neg) > 0
            THEN CAST(sum(CAST(pos AS HUGEINT) * CAST(2 * nb + neg AS HUGEINT)) AS DOUBLE)
                 / (2.0::DOUBLE * CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) END AS auc
FROM c"""

ORACLE["auc_exact"] = f"""{_JOINED},
{_AUC}"""

ORACLE["auc_binned"] = f"""WITH auc_row AS ({_JOINED},
{_AUC})
SELECT round(auc, 9) AS auc FROM auc_row"""

ORACLE["top_risk"] = f"""WITH {SQL_SCORED}
SELECT * FROM scored ORDER BY prob_1 DESC NULLS LAST, transaction_id LIMIT 100"""

# --- through files -------------------------------------------------------------------

ORACLE["csv_round_trip"] = ORACLE["preprocess"]

ORACLE["read_with_casts"] = f"""WITH {SQL_SCORED}
SELECT CAST(transaction_id AS VARCHAR) AS transaction_id,
       CAST(customer_id AS VARCHAR) AS customer_id, prob_0, prob_1, prediction
FROM scored"""

ORACLE["features_via_files"] = ORACLE["feature_engineering"]
ORACLE["features_by_batches"] = ORACLE["feature_engineering"]
ORACLE["incremental_via_files"] = ORACLE["feature_engineering"]
ORACLE["features_bucketed_table"] = ORACLE["feature_engineering"]
ORACLE["join_truth_bucketed"] = ORACLE["join_truth"]

ORACLE["split_via_files"] = ORACLE["stable_split"]

ORACLE["labels_via_files"] = ORACLE["label_to_double"]

_FILES_JOINED = f"""WITH {SQL_SCORED}, {SQL_TRUTH},
joined AS (SELECT CAST(s.transaction_id AS VARCHAR) AS transaction_id, s.customer_id,
                  s.prob_0, s.prob_1, s.prediction, t.is_fraud
           FROM scored s JOIN truth t ON s.transaction_id = t.transaction_id)"""

ORACLE["monitoring_auc"] = f"""{_FILES_JOINED},
{_AUC}"""

ORACLE["monitoring_distribution"] = f"""{_FILES_JOINED}
SELECT prediction, count(*) AS count FROM joined GROUP BY prediction"""

ORACLE["evaluation_metrics"] = f"""{_FILES_JOINED},
{_METRICS}"""

ORACLE["evaluation_histogram"] = _histogram_sql(_FILES_JOINED)

# --- streaming -------------------------------------------------------------------

ORACLE["stream_prediction_counts"] = f"""WITH {SQL_SCORED}
SELECT prediction, count(*) AS count FROM scored GROUP BY prediction"""

# --- names from the survey's plan ---------------------------------------------------

ORACLE["velocity_bucketed"] = ORACLE["velocity_features"].replace(
    "with_secs AS (SELECT *,", "with_secs AS (SELECT * REPLACE (CAST(CASE WHEN transaction_id % 3 = 0 THEN -1 "
    "ELSE customer_id END AS BIGINT) AS customer_id),")
ORACLE["feature_round_trip"] = ORACLE["feature_engineering"]

# --- the deterministic parts of the learning queries ---------------------------------

_TRAIN_SIDE = f"""WITH {SQL_TRANSACTIONS},
train AS (SELECT * FROM transactions WHERE {_in_first_side('transaction_id')}),
c AS (SELECT count(*) AS total,
             count(*) FILTER (WHERE CAST(is_fraud AS INTEGER) = 1) AS positive,
             count(*) FILTER (WHERE CAST(is_fraud AS INTEGER) = 0) AS negative FROM train)"""

ORACLE["training_weights"] = f"""{_TRAIN_SIDE}
SELECT transaction_id, CAST(is_fraud AS INTEGER) AS is_fraud,
       CASE WHEN CAST(is_fraud AS INTEGER) = 1
            THEN CAST(total AS DOUBLE) / CAST(2 * positive AS DOUBLE)
            ELSE CAST(total AS DOUBLE) / CAST(2 * negative AS DOUBLE) END AS class_weight
FROM train, c"""

ORACLE["scored_rows"] = f"""WITH {SQL_TRANSACTIONS}
SELECT transaction_id, customer_id, true AS has_prediction
FROM transactions WHERE NOT {_in_first_side('transaction_id')}"""

# Saturated model: a row's probability is its category's weighted fraud rate.
ORACLE["score_saturated"] = f"""{_TRAIN_SIDE},
weighted AS (SELECT merchant_category, CAST(is_fraud AS INTEGER) AS y,
                    CASE WHEN is_fraud THEN CAST(total AS DOUBLE) / (2 * positive)
                         ELSE CAST(total AS DOUBLE) / (2 * negative) END AS w FROM train, c),
rate AS (SELECT merchant_category, sum(w * y) / sum(w) AS p FROM weighted GROUP BY merchant_category)
SELECT transaction_id, customer_id, round(1 - p, 5) AS prob_0, round(p, 5) AS prob_1,
       CAST(p > 0.5 AS DOUBLE) AS prediction
FROM transactions JOIN rate USING (merchant_category) WHERE NOT {_in_first_side('transaction_id')}"""
ORACLE["scoring_saturated_via_files"] = ORACLE["score_saturated"]

_BITS = "CAST(('0x' || substr(md5(CAST(transaction_id AS VARCHAR)), 1, 8)) AS BIGINT)"


def _auc_of(source: str, by: str = "") -> str:
    """AUC of ``noisy_amount`` for ``is_fraud`` in ``source`` (by a column): ties count half."""
    part, keep = (f"PARTITION BY {by}", f"{by},") if by else ("", "")
    return f"""SELECT {keep} sum(pos * (coalesce(below, 0) + neg / 2.0)) / (sum(pos) * sum(neg)) AS auc
  FROM (SELECT {keep} pos, neg, sum(neg) OVER ({part} ORDER BY noisy_amount
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS below
        FROM (SELECT {keep} noisy_amount, CAST(count(*) FILTER (WHERE is_fraud) AS DOUBLE) AS pos,
                     CAST(count(*) FILTER (WHERE NOT is_fraud) AS DOUBLE) AS neg
              FROM {source} GROUP BY ALL)) {f"GROUP BY {by}" if by else ""}"""


_ONE_FEATURE = f"""WITH {SQL_TRANSACTIONS},
noisy AS (SELECT *, floor(amount / 20) + {_BITS} % 10 AS noisy_amount, ({_BITS} // 16) % 3 AS fold,
                 {_in_first_side('transaction_id')} AS first_side FROM transactions),
train AS (SELECT * FROM noisy WHERE first_side), inference AS (SELECT * FROM noisy WHERE NOT first_side),
cv AS (SELECT round(avg(auc), 9) AS avg_auc FROM ({_auc_of('train', 'fold')})),
grid AS (SELECT * FROM (VALUES (0.01::DOUBLE, true), (0.1::DOUBLE, false), (1.0::DOUBLE, false)) g(reg_param, is_best))"""

ORACLE["cv_one_feature"] = f"""{_ONE_FEATURE}
SELECT reg_param, avg_auc, is_best FROM grid, cv"""
ORACLE["training_one_feature_via_files"] = f"""{_ONE_FEATURE}
SELECT reg_param, avg_auc, is_best, round(auc, 9) AS model_auc FROM grid, cv, ({_auc_of('train')})"""
ORACLE["model_auc_one_feature"] = f"""{_ONE_FEATURE}
SELECT 'train' AS rows, round(auc, 9) AS auc FROM ({_auc_of('train')})
UNION ALL SELECT 'inference', round(auc, 9) FROM ({_auc_of('inference')})"""

ORACLE["distinct_weights"] = f"""WITH w AS ({ORACLE["training_weights"]})
SELECT DISTINCT is_fraud, class_weight FROM w"""

# The random split's rows are its own; that each id is on one side, and the share, are not.
ORACLE["random_split_via_files"] = f"""WITH {SQL_TRANSACTIONS}
SELECT transaction_id, CAST(1 AS BIGINT) AS sides, true AS share_ok FROM transactions"""

ORACLE["describe_exact"] = f"""WITH {SQL_TRANSACTIONS}, far AS (
SELECT transaction_id * 2 + 9007199254740993 AS far_id FROM transactions)
SELECT 'far_id' AS "column", count(far_id) AS count, CAST(min(far_id) AS VARCHAR) AS min_text,
       CAST(max(far_id) AS VARCHAR) AS max_text FROM far"""

_CONTINUOUS = f"""WITH {SQL_TRUTH},
joined AS (SELECT is_fraud, CAST({_BITS} AS DOUBLE) / 4294967296.0::DOUBLE AS prob_1 FROM truth)"""
ORACLE["histogram_continuous"] = _histogram_sql(_CONTINUOUS)
ORACLE["auc_continuous"] = f"""{_CONTINUOUS},
{_AUC}"""

# --- five-feature models: Newton's method in SQL ---------------------------------------
#
# The optimum of the penalised, weighted log loss is unique, so a converged fit of any solver
# must agree with these steps: sums of gradient and Hessian by fit, then Gauss-Jordan
# elimination over lists.  Penalties are on standardised coefficients, as MLlib's.

_X = range(1, 6)
_REGS = (0.01, 0.1, 1.0)


def _solve(m: str, n: int) -> str:
    """The solution of an ``n`` x ``n`` system given as a list of rows with the right side last."""
    pivots = ", ".join(f"[[{k}.0::DOUBLE]]" for k in range(1, n + 1))
    k = "CAST(kk[1][1] AS BIGINT)"
    return (f"list_transform(list_reduce([{m}, {pivots}], lambda m, kk: [CASE WHEN a = {k} THEN [c / m[a][a] FOR c IN m[a]] "
            f"ELSE [m[a][b] - m[a][{k}] * m[{k}][b] / m[{k}][{k}] FOR b IN range(1, {n + 2})] END FOR a IN range(1, {n + 1})]), "
            f"lambda row: row[{n + 1}])")


def _five_features_sql(fits: list[tuple[int, float]], steps: int = 9) -> str:
    """CTEs up to ``model`` (fit, fold_out, reg, loss, b0 ... b5) for fits (fold left out or -1, penalty)."""
    side = "PARTITION BY first_side, customer_id"
    frame = f"{side} ORDER BY timestamp_seconds RANGE BETWEEN {W} PRECEDING AND CURRENT ROW"
    z = [f"z{j}" for j in range(6)]
    values = ", ".join(f"({i}, {out}, {reg}::DOUBLE)" for i, (out, reg) in enumerate(fits))
    eta = " + ".join(f"beta[{j + 1}] * {c}" for j, c in enumerate(z))
    hess = ", ".join("[" + ", ".join(f"sum(v * {a} * {b})" for b in z) + "]" for a in z)
    system = ("[list_concat([hh[a][b] / sw + CASE WHEN a = b THEN reg * pen[a] ELSE 0 END FOR b IN range(1, 7)], "
              "[gg[a] / sw + reg * pen[a] * beta[a]]) FOR a IN range(1, 7)]")
    spread = "(sum(w * {0} * {0}) - sum(w * {0}) ** 2 / sum(w)) / (sum(w) - sum(w * w) / sum(w))"
    return f"""WITH RECURSIVE {SQL_TRANSACTIONS},
sided AS (SELECT *, {_SECS} AS timestamp_seconds, {_in_first_side('transaction_id')} AS first_side, ({_BITS} // 16) % 3 AS fold FROM transactions),
feats AS MATERIALIZED (
  SELECT transaction_id, customer_id, first_side, fold, is_fraud, CAST(CAST(is_fraud AS INTEGER) AS DOUBLE) AS y,
         CAST(COUNT(transaction_id) OVER ({frame}) AS DOUBLE) AS x1, SUM(amount) OVER ({frame}) AS x2,
         CAST(COUNT(transaction_id) OVER ({side}, merchant_category) AS DOUBLE) AS x3,
         CAST(hour("timestamp") AS DOUBLE) AS x4, CAST(extract(dow FROM "timestamp") + 1 AS DOUBLE) AS x5 FROM sided),
balance AS (SELECT CAST(count(*) AS DOUBLE) AS total, sum(y) AS pos FROM feats WHERE first_side),
weighted AS MATERIALIZED (SELECT feats.*, total / (2 * CASE WHEN y = 1 THEN pos ELSE total - pos END) AS w FROM feats, balance WHERE first_side),
mean AS (SELECT {", ".join(f"sum(w * x{j}) / sum(w) AS m{j}, sqrt({spread.format(f'x{j}')}) AS s{j}" for j in _X)} FROM weighted),
f AS MATERIALIZED (SELECT weighted.*, 1.0::DOUBLE AS z0, {", ".join(f"(x{j} - m{j}) / s{j} AS z{j}" for j in _X)} FROM weighted, mean),
fits AS (SELECT * FROM (VALUES {values}) t(fit, fold_out, reg)),
ready AS (SELECT fit, fold_out, reg, [0.0::DOUBLE, {", ".join(spread.format(f"z{j}") for j in _X)}] AS pen
          FROM fits JOIN f ON fold <> fold_out GROUP BY fit, fold_out, reg),
it AS (
  SELECT 0 AS i, fit, fold_out, reg, pen, [0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE] AS beta, 0.0::DOUBLE AS loss FROM ready
  UNION ALL
  SELECT i + 1, fit, fold_out, reg, pen, [beta[j] - x FOR x, j IN {_solve(system, 6)}],
         loss + reg / 2 * list_sum([pen[j] * beta[j] ** 2 FOR j IN range(1, 7)])
  FROM (SELECT i, fit, fold_out, reg, pen, beta, sum(w) AS sw, [{", ".join(f"sum(r * {c})" for c in z)}] AS gg, [{hess}] AS hh,
               sum(w * (greatest(eta, 0) + ln(1 + exp(-abs(eta))) - y * eta)) / sum(w) AS loss
        FROM (SELECT *, w * (p - y) AS r, w * p * (1 - p) AS v
              FROM (SELECT *, 1 / (1 + exp(-eta)) AS p FROM (SELECT *, {eta} AS eta FROM it JOIN f ON f.fold <> it.fold_out WHERE i < {steps})))
        GROUP BY i, fit, fold_out, reg, pen, beta)),
model AS MATERIALIZED (SELECT fit, fold_out, reg, loss, {", ".join(f"beta[{j + 1}] / s{j} AS b{j}" for j in _X)},
                 beta[1] - {" - ".join(f"beta[{j + 1}] * m{j} / s{j}" for j in _X)} AS b0 FROM it, mean WHERE i = {steps})"""


_MARGIN = "b0 + " + " + ".join(f"b{j} * x{j}" for j in _X)


def _auc_by(source: str, by: str) -> str:
    """(by, auc) of ``score`` for ``y`` in ``source``: ties count half."""
    return f"""SELECT {by}, sum(pos * (coalesce(below, 0) + neg / 2.0)) / (sum(pos) * sum(neg)) AS auc
  FROM (SELECT *, sum(neg) OVER (PARTITION BY {by} ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS below
        FROM (SELECT {by}, score, sum(y) AS pos, sum(1 - y) AS neg FROM {source} GROUP BY ALL)) GROUP BY {by}"""


_CV_FIVE = f"""{_five_features_sql([(k, reg) for reg in _REGS for k in range(3)])},
judged AS (SELECT fit, reg, y, {_MARGIN} AS score FROM f JOIN model ON fold = fold_out),
areas AS (SELECT reg, avg(auc) AS auc FROM ({_auc_by('judged', 'fit')}) JOIN model USING (fit) GROUP BY reg),
grid AS (SELECT reg AS reg_param, round(auc, 6) AS avg_auc, row_number() OVER (ORDER BY auc DESC, reg) = 1 AS is_best FROM areas)"""
ORACLE["cv_five_features"] = f"""{_CV_FIVE}
SELECT * FROM grid"""
ORACLE["training_five_features_via_files"] = ORACLE["cv_five_features"]

_ALL_FIVE = _five_features_sql([(-1, reg) for reg in _REGS])
_TERMS = ("intercept", "transaction_velocity", "amount_velocity", "merchant_category_count", "hour_of_day", "day_of_week")
_COEFFICIENTS = " UNION ALL ".join(f"SELECT reg AS reg_param, '{t}' AS term, round(b{j}, 6) AS coefficient FROM model" for j, t in enumerate(_TERMS))
ORACLE["fit_five_features"] = f"""{_ALL_FIVE}
SELECT * FROM (SELECT unnest(['mllib', 'shared']) AS solver) CROSS JOIN ({_COEFFICIENTS})"""
ORACLE["fit_certificate"] = f"""{_ALL_FIVE}
SELECT reg AS reg_param, model_name AS model, round(loss, 8) AS loss, true AS near_optimum
FROM model CROSS JOIN (SELECT unnest(['reference', 'converged']) AS model_name)"""

_BEST_FIVE = f"""{_five_features_sql([(-1, _REGS[0])])},
told AS (SELECT feats.*, 1 / (1 + exp(-({_MARGIN}))) AS p FROM feats, model)"""
ORACLE["score_five_features"] = f"""{_BEST_FIVE}
SELECT transaction_id, customer_id, round(1 - p, 3) AS prob_0, round(p, 3) AS prob_1, CAST(p > 0.5 AS DOUBLE) AS prediction
FROM told WHERE NOT first_side"""
ORACLE["scoring_five_features_via_files"] = ORACLE["score_five_features"]
ORACLE["model_auc_five_features"] = f"""{_BEST_FIVE}, both_sides AS (SELECT first_side, y, p AS score FROM told)
SELECT CASE WHEN first_side THEN 'train' ELSE 'inference' END AS rows, round(auc, 6) AS auc, true AS evaluator_agrees
FROM ({_auc_by('both_sides', 'first_side')})"""


# --- heavy customers, long windows, large amounts ---------------------------------------

ORACLE["feature_engineering_heavy"] = ORACLE["feature_engineering"].replace(
    "FROM transactions)", "FROM (SELECT * REPLACE (CAST(CASE WHEN transaction_id % 3 = 0 THEN -1 ELSE customer_id END AS BIGINT) "
    "AS customer_id) FROM transactions))", 1)


def _far_amounts_sql(days: int) -> str:
    frame = f"PARTITION BY customer_id ORDER BY timestamp_seconds RANGE BETWEEN {days * 86400} PRECEDING AND CURRENT ROW"
    return f"""WITH {SQL_TRANSACTIONS},
far AS (SELECT * REPLACE (CASE WHEN transaction_id % 80 = 0 THEN 1e21::DOUBLE WHEN transaction_id % 40 = 0 THEN -1e21::DOUBLE
                               WHEN transaction_id % 40 = 1 THEN 3e18::DOUBLE ELSE amount END AS amount),
               {_SECS} AS timestamp_seconds FROM transactions),
summed AS (SELECT {_RAW}, timestamp_seconds, CAST(SUM(CAST(amount AS DECIMAL(38, 10))) OVER ({frame}) AS DOUBLE) AS v FROM far)
SELECT {_RAW}, timestamp_seconds, CASE WHEN abs(v) < 1e15 THEN round(v, 6) ELSE round(v / 1e12) * 1e12 END AS amount_velocity FROM summed"""


ORACLE["amount_velocity_30_days"] = _far_amounts_sql(30)
ORACLE["amount_velocity_365_days"] = _far_amounts_sql(365)


# --- damaged files ---------------------------------------------------------------------

_INTACT = "transaction_id % 7 <> 0 AND transaction_id % 11 <> 0 AND transaction_id % 13 <> 0"
ORACLE["csv_checked"] = f"""WITH {SQL_TRANSACTIONS}
SELECT transaction_id, customer_id, "timestamp", CASE WHEN transaction_id % 5 <> 0 THEN amount END AS amount,
       merchant_category, is_fraud FROM transactions WHERE {_INTACT}"""

_AMOUNT_TEXT = ("CASE WHEN transaction_id % 7 = 0 THEN '12.5x' WHEN transaction_id % 5 = 0 THEN '' "
                "ELSE CAST(amount AS VARCHAR) END")
_SHORT = "concat_ws(',', transaction_id, customer_id, strftime(\"timestamp\", '%Y-%m-%dT%H:%M:%S.%f'))"
_LINE = f"concat_ws(',', {_SHORT}, {_AMOUNT_TEXT}, merchant_category, CAST(is_fraud AS VARCHAR))"
ORACLE["csv_quarantine"] = f"""WITH {SQL_TRANSACTIONS}
SELECT CASE WHEN transaction_id % 11 = 0 THEN {_SHORT} WHEN transaction_id % 13 = 0 THEN {_LINE} || ',more' ELSE {_LINE} END AS line
FROM transactions WHERE NOT ({_INTACT})"""

ORACLE["casts_checked"] = f"""WITH {SQL_SCORED},
told AS (SELECT *, concat_ws(',', CASE WHEN transaction_id % 6 = 0 THEN 'prediction' END, CASE WHEN transaction_id % 9 = 0 THEN 'prob_1' END) AS failed
         FROM scored)
SELECT failed, count(*) AS n, CASE WHEN failed = '' THEN round(sum(prob_1), 6) END AS prob_1,
       count(*) FILTER (WHERE failed = '' AND transaction_id % 10 <> 1) AS predictions FROM told GROUP BY failed"""
