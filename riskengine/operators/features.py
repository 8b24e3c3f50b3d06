"""Per-customer window features: trailing 7-day velocity, category profile, time of day.

Semantics are those of the reference's window functions:

* ``transaction_velocity`` = ``count(transaction_id)`` over
  ``partitionBy(customer).orderBy(timestamp_seconds).rangeBetween(-W, 0)``:
  whole seconds, inclusive at both ends, rows of the same second are peers;
* ``amount_velocity`` = ``sum(amount)`` over the same frame;
* ``merchant_category_count`` = ``count(transaction_id)`` over
  ``partitionBy(customer, merchant_category)`` (whole partition, future rows included);
* null seconds form one peer group seen only by each other; a null customer is a group.

Physical plan (``method="split"``, the default).  A plain customer window puts every row of one
customer into one task, so a customer holding a third of the data would hold a third of the data
in one task; and Spark's sliding range frame adds up the whole frame for every row.  Instead:

1. customers with more than ``heavy_rows`` rows, and more than a ``HEAVY_CUSTOMERS``-th of all rows,
   are *heavy*: a grouped count tells them, at most ``HEAVY_CUSTOMERS`` of them, so that their list
   is broadcast with that bound;
2. the others' rows go once to their customer's partition, which is that small.  A frame total is
   the difference of two growing frames there, all up to ``s`` and all before ``s - W``: O(1) work
   per row.  Category counts are a window of the same partitioning;
3. heavy customers take the bucketed plan (``method="bucketed"``):

   a. rows are pre-aggregated per (customer, second) -- a partial/final hash aggregate, so a hot
      customer spreads over many shuffle keys and peers collapse to one row;
   b. each per-second row goes to its week bucket ``b = floor(s / W)`` and is copied once into
      ``b + 1`` as history; every frame ``[s - W, s]`` lies inside buckets ``b - 1`` and ``b``.  A
      partition holds at most ``2 * W`` rows (two weeks of distinct seconds), whatever the data
      size or the skew;
   c. the same two growing frames inside the bucket give the per-second answers, which are
      equi-joined back (null-safe) to the rows.  The answer table has one row per key, so AQE's
      skew-join split of the big side stays correct.  Category counts are a grouped count joined
      back; AQE turns that join into a broadcast when the measured aggregate is under the broadcast
      threshold, and otherwise splits the partitions of a hot (customer, category) key.

Amounts are summed as ``decimal(38, 10)``: exact for amounts up to 18 integer digits and ten
decimals, so differences of running sums don't drift; finite amounts from 1e18 up to 1e30 are summed
apart, as whole numbers.  NaN, and infinities or amounts of 1e30 and beyond, are counted: a frame
that holds a NaN sums to NaN, one that holds an infinity is infinite (NaN where both signs meet).
Windows may have any length.

``method="direct"`` runs the reference's plain window (used in tests as the
equivalence oracle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import HEAVY_CUSTOMERS, HEAVY_ROWS, VELOCITY_WINDOW_SECONDS
from ..functions.columns import epoch_seconds, exact_amount, large_amount, null_safe_keys, odd_amount

CUSTOMER = "customer_id"
SECONDS = "timestamp_seconds"
TXN_ID = "transaction_id"
AMOUNT = "amount"
CATEGORY = "merchant_category"
TIMESTAMP = "timestamp"
ODD = ("nan", "high", "low")


def with_timestamp_seconds(df: DataFrame, timestamp_col: str = TIMESTAMP,
                           seconds_col: str = SECONDS) -> DataFrame:
    """Add ``timestamp_seconds`` (whole epoch seconds) unless it is already there."""
    if seconds_col in df.columns:
        return df
    return df.withColumn(seconds_col, epoch_seconds(timestamp_col))


def _attach(df: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Left equi-join of a one-row-per-key answer table, null-safe on every key."""
    left, right = df.alias("_rows"), table.alias("_answer")
    extra = [c for c in table.columns if c not in keys]
    return (left.join(right, null_safe_keys(left, right, keys), "left")
            .select("_rows.*", *[F.col(f"_answer.`{c}`") for c in extra]))


def _measures(id_col: str, amount_col: str, amount_scale: int | None, count_out: str | None,
              sum_out: str | None) -> dict[str, Column]:
    """What a row adds to its frames, by name; only what is asked for."""
    if count_out is None and sum_out is None:
        raise ValueError("ask for at least one of count_out, sum_out")
    out = {}
    if count_out is not None:
        out["_n"] = F.col(id_col).isNotNull().cast("long")
    if sum_out is not None:
        out["_s"] = exact_amount(amount_col, amount_scale)
        out["_large"] = large_amount(amount_col)
        out["_nn"] = F.col(amount_col).isNotNull().cast("long")
        out |= {f"_{kind}": F.coalesce(odd_amount(amount_col, kind), F.lit(False)).cast("long") for kind in ODD}
    return out


def _frame_totals(partition: list[str], seconds_col: str, window_seconds: int, names) -> dict[str, Column]:
    """Each measure's total over the trailing window: what lies in the partition up to the second
    ``s``, less what lies before ``s - W``.  Rows with null seconds are one peer group that only
    sees itself, so nothing is subtracted there."""
    growing = Window.partitionBy(*partition).orderBy(seconds_col)
    upto = growing.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    before = growing.rangeBetween(Window.unboundedPreceding, -(window_seconds + 1))
    known = F.col(seconds_col).isNotNull()
    zero = F.lit(0)
    return {m: F.coalesce(F.sum(m).over(upto), zero) - F.when(known, F.coalesce(F.sum(m).over(before), zero)).otherwise(zero)
            for m in names}


def _answers(total: dict[str, Column], count_out: str | None, sum_out: str | None) -> dict[str, Column]:
    """The outputs from the measures' frame totals."""
    out = {}
    if count_out is not None:
        out[count_out] = total["_n"]
    if sum_out is not None:
        nan, high, low = (total[f"_{kind}"] > 0 for kind in ODD)
        plain = F.when(total["_nn"] > 0, total["_s"].cast("double") + total["_large"].cast("double"))
        out[sum_out] = (F.when(nan | (high & low), F.lit(float("nan"))).when(high, F.lit(float("inf")))
                        .when(low, F.lit(float("-inf"))).otherwise(plain))
    return out


def trailing_window_stats(
    df: DataFrame,
    *,
    customer_col: str = CUSTOMER,
    seconds_col: str = SECONDS,
    id_col: str = TXN_ID,
    amount_col: str = AMOUNT,
    window_seconds: int = VELOCITY_WINDOW_SECONDS,
    count_out: str | None = "transaction_velocity",
    sum_out: str | None = "amount_velocity",
    amount_scale: int | None = None,
) -> DataFrame:
    """One row per distinct (customer, second) with the trailing-window count and sum, bucketed."""
    measures = _measures(id_col, amount_col, amount_scale, count_out, sum_out)
    per_second = df.groupBy(customer_col, seconds_col).agg(*[F.sum(e).alias(name) for name, e in measures.items()])

    secs = F.col(seconds_col)
    home = F.floor(secs / F.lit(window_seconds))

    def role(bucket, out: bool):
        return F.struct(bucket.alias("_bucket"), F.lit(out).alias("_out"))

    roles = F.when(secs.isNull(), F.array(role(home, True))).otherwise(
        F.array(role(home, True), role(home + F.lit(1), False)))  # itself; history for next week
    spread = per_second.select(customer_col, seconds_col, *measures, F.inline(roles))
    total = _frame_totals([customer_col, "_bucket"], seconds_col, window_seconds, measures)
    totals = spread.select(customer_col, seconds_col, "_out", *[e.alias(m) for m, e in total.items()]).where("_out")
    answers = _answers({m: F.col(m) for m in measures}, count_out, sum_out)
    return totals.select(customer_col, seconds_col, *[e.alias(out) for out, e in answers.items()])


def heavy_customers(df: DataFrame, customer_col: str = CUSTOMER, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """Customers with more than ``heavy_rows`` rows and more than a ``HEAVY_CUSTOMERS``-th of all rows.

    Fewer than ``HEAVY_CUSTOMERS`` can have so many: the bound of the list's broadcasts.
    """
    counts = df.groupBy(customer_col).agg(F.count(F.lit(1)).alias("_rows"))
    share = counts.agg((F.sum("_rows") / F.lit(HEAVY_CUSTOMERS)).alias("share")).scalar()
    return counts.where(F.col("_rows") > F.greatest(F.lit(float(heavy_rows)), F.coalesce(share, F.lit(0.0)))).select(customer_col)


def _split(df: DataFrame, customer_col: str, heavy_rows: int) -> tuple[DataFrame, DataFrame]:
    """The rows of ordinary and of heavy customers (a null customer is one too)."""
    heavy = F.broadcast(heavy_customers(df, customer_col, heavy_rows).withColumnRenamed(customer_col, "_heavy"))
    same = F.col(customer_col).eqNullSafe(F.col("_heavy"))
    return df.join(heavy, same, "left_anti"), df.join(heavy, same, "left_semi")


def _whole_velocity(df: DataFrame, *, customer_col, seconds_col, id_col, amount_col, window_seconds,
                    count_out, sum_out, amount_scale) -> DataFrame:
    """Growing frames over a customer's rows: for customers of a bounded number of rows."""
    measures = _measures(id_col, amount_col, amount_scale, count_out, sum_out)
    kept = df.columns
    total = _frame_totals([customer_col], seconds_col, window_seconds, measures)
    rows = df.withColumns(measures).select(*[F.col(f"`{c}`") for c in kept], *[e.alias(f"_total{m}") for m, e in total.items()])
    answers = _answers({m: F.col(f"_total{m}") for m in measures}, count_out, sum_out)
    return rows.select(*[F.col(f"`{c}`") for c in kept], *[e.alias(out) for out, e in answers.items()])


def _direct_velocity(df: DataFrame, *, customer_col, seconds_col, id_col, amount_col,
                     window_seconds, count_out, sum_out, amount_scale) -> DataFrame:
    frame = (Window.partitionBy(customer_col).orderBy(seconds_col)
             .rangeBetween(-window_seconds, 0))
    if count_out is not None:
        df = df.withColumn(count_out, F.count(id_col).over(frame))
    if sum_out is not None:
        amount = F.col(amount_col).cast("double") if amount_scale is None else exact_amount(amount_col, amount_scale)
        df = df.withColumn(sum_out, F.sum(amount).over(frame).cast("double"))
    return df


def _velocity(df: DataFrame, method: str, heavy_rows: int, **kw) -> DataFrame:
    df = with_timestamp_seconds(df, seconds_col=kw["seconds_col"])
    if method == "direct":
        return _direct_velocity(df, **kw)
    if method == "split":
        ordinary, heavy = _split(df, kw["customer_col"], heavy_rows)
        return _whole_velocity(ordinary, **kw).unionByName(_velocity(heavy, "bucketed", heavy_rows, **kw))
    if method != "bucketed":
        raise ValueError(f"unknown method {method!r}")
    stats = trailing_window_stats(df, **kw)
    return _attach(df, stats, [kw["customer_col"], kw["seconds_col"]])


def transaction_velocity(df: DataFrame, *, customer_col: str = CUSTOMER,
                         seconds_col: str = SECONDS, id_col: str = TXN_ID,
                         window_seconds: int = VELOCITY_WINDOW_SECONDS,
                         out: str = "transaction_velocity",
                         method: str = "split", heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """Count of ``id_col`` per customer in the trailing window (adds ``timestamp_seconds``)."""
    return _velocity(df, method, heavy_rows, customer_col=customer_col, seconds_col=seconds_col,
                     id_col=id_col, amount_col=AMOUNT, window_seconds=window_seconds,
                     count_out=out, sum_out=None, amount_scale=None)


def amount_velocity(df: DataFrame, *, customer_col: str = CUSTOMER,
                    seconds_col: str = SECONDS, amount_col: str = AMOUNT,
                    window_seconds: int = VELOCITY_WINDOW_SECONDS,
                    out: str = "amount_velocity", amount_scale: int | None = None,
                    method: str = "split", heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """Sum of ``amount_col`` per customer in the trailing window."""
    return _velocity(df, method, heavy_rows, customer_col=customer_col, seconds_col=seconds_col,
                     id_col=TXN_ID, amount_col=amount_col, window_seconds=window_seconds,
                     count_out=None, sum_out=out, amount_scale=amount_scale)


def velocity_features(df: DataFrame, *, customer_col: str = CUSTOMER,
                      seconds_col: str = SECONDS, id_col: str = TXN_ID,
                      amount_col: str = AMOUNT,
                      window_seconds: int = VELOCITY_WINDOW_SECONDS,
                      amount_scale: int | None = None,
                      method: str = "split", heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """W1 + W2 in one pass: both come from the same window."""
    return _velocity(df, method, heavy_rows, customer_col=customer_col, seconds_col=seconds_col,
                     id_col=id_col, amount_col=amount_col, window_seconds=window_seconds,
                     count_out="transaction_velocity", sum_out="amount_velocity",
                     amount_scale=amount_scale)


def category_counts(df: DataFrame, *, customer_col: str = CUSTOMER,
                    category_col: str = CATEGORY, id_col: str = TXN_ID,
                    out: str = "merchant_category_count") -> DataFrame:
    """One row per (customer, category) with ``count(id_col)``; partial + final aggregate."""
    return df.groupBy(customer_col, category_col).agg(F.count(id_col).alias(out))


def running_category_counts(df: DataFrame, *, customer_col: str = CUSTOMER, category_col: str = CATEGORY,
                            id_col: str = TXN_ID, out: str = "merchant_category_count",
                            seconds_col: str = SECONDS, part_seconds: int = VELOCITY_WINDOW_SECONDS) -> DataFrame:
    """One row per (customer, category, second) with the count up to that second.

    A running count inside each week, plus the weeks before it (one row a week): no task
    holds more than a week's seconds, or the weeks, of a customer and category.
    """
    keys = [customer_col, category_col]
    per_second = df.groupBy(*keys, seconds_col).agg(F.count(id_col).alias("_n"))
    per_second = per_second.withColumn("_week", F.floor(F.col(seconds_col) / F.lit(part_seconds)))
    weeks = per_second.groupBy(*keys, "_week").agg(F.sum("_n").alias("_all"))
    earlier = Window.partitionBy(*keys).orderBy("_week").rowsBetween(Window.unboundedPreceding, -1)
    weeks = weeks.select(*keys, "_week", F.coalesce(F.sum("_all").over(earlier), F.lit(0)).alias("_before"))
    inside = (Window.partitionBy(*keys, "_week").orderBy(seconds_col)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    own = per_second.withColumn("_upto", F.sum("_n").over(inside))
    return _attach(own, weeks, [*keys, "_week"]).select(
        *keys, seconds_col, (F.col("_upto") + F.col("_before")).alias(out))


def merchant_category_profiling(df: DataFrame, *, customer_col: str = CUSTOMER,
                                category_col: str = CATEGORY, id_col: str = TXN_ID,
                                out: str = "merchant_category_count",
                                method: str = "grouped", running: bool = False,
                                seconds_col: str = SECONDS) -> DataFrame:
    """Count of ``id_col`` per (customer, category) over the whole group, on every row.

    The whole group includes later rows.  With ``running=True`` a row counts only what its
    customer and category had up to its own second (rows of one second are peers, null
    seconds come first); this adds ``timestamp_seconds``.
    """
    if running:
        df = with_timestamp_seconds(df, seconds_col=seconds_col)
        counts = running_category_counts(df, customer_col=customer_col, category_col=category_col,
                                         id_col=id_col, out=out, seconds_col=seconds_col)
        return _attach(df, counts, [customer_col, category_col, seconds_col])
    if method == "direct":
        return df.withColumn(
            out, F.count(id_col).over(Window.partitionBy(customer_col, category_col)))
    if method != "grouped":
        raise ValueError(f"unknown method {method!r}")
    counts = category_counts(df, customer_col=customer_col, category_col=category_col,
                             id_col=id_col, out=out)
    return _attach(df, counts, [customer_col, category_col])


def time_based_patterns(df: DataFrame, *, timestamp_col: str = TIMESTAMP) -> DataFrame:
    """``hour_of_day`` (0-23) and ``day_of_week`` (1 = Sunday ... 7 = Saturday)."""
    ts = F.col(timestamp_col)
    return df.withColumns({"hour_of_day": F.hour(ts), "day_of_week": F.dayofweek(ts)})


def full_feature_engineering(df: DataFrame, *, customer_col: str = CUSTOMER,
                             timestamp_col: str = TIMESTAMP, id_col: str = TXN_ID,
                             amount_col: str = AMOUNT, category_col: str = CATEGORY,
                             window_seconds: int = VELOCITY_WINDOW_SECONDS,
                             amount_scale: int | None = None,
                             method: str = "split", heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """Seconds, both velocities, category profile, time patterns -- in the reference's order.

    Ordinary customers' rows are shuffled once, for all windows.  For heavy ones (and with
    ``method="bucketed"``) both answer tables (per second, per category) are aggregated from the
    raw rows and joined back, so the input is scanned, not re-joined, for each.
    """
    df = with_timestamp_seconds(df, timestamp_col)
    kw = dict(customer_col=customer_col, seconds_col=SECONDS, id_col=id_col, amount_col=amount_col,
              window_seconds=window_seconds, amount_scale=amount_scale,
              count_out="transaction_velocity", sum_out="amount_velocity")
    profile = dict(customer_col=customer_col, category_col=category_col, id_col=id_col)
    if method == "direct":
        df = merchant_category_profiling(_direct_velocity(df, **kw), method="direct", **profile)
    elif method == "split":
        ordinary, heavy = _split(df, customer_col, heavy_rows)
        df = _ordinary_features(ordinary, kw, profile).unionByName(_heavy_features(heavy, kw, profile))
    elif method == "bucketed":
        df = _heavy_features(df, kw, profile)
    else:
        raise ValueError(f"unknown method {method!r}")
    return time_based_patterns(df, timestamp_col=timestamp_col)


def _ordinary_features(rows: DataFrame, kw: dict, profile: dict) -> DataFrame:
    """Velocities and category profile as windows of a customer's rows: one partitioning for all."""
    return merchant_category_profiling(_whole_velocity(rows, **kw), method="direct", **profile)


def _heavy_features(rows: DataFrame, kw: dict, profile: dict) -> DataFrame:
    """The same from answer tables by (customer, second) and (customer, category), joined back."""
    stats, counts = trailing_window_stats(rows, **kw), category_counts(rows, **profile)
    back = _attach(rows, stats, [kw["customer_col"], kw["seconds_col"]])
    return _attach(back, counts, [profile["customer_col"], profile["category_col"]])


def table_features(ordinary: DataFrame, heavy: DataFrame, *, window_seconds: int = VELOCITY_WINDOW_SECONDS) -> DataFrame:
    """W4 over rows that are already told apart (``sources.bucketed.CustomerTable``), seconds included.

    Nothing is counted again to find heavy customers, and where ``ordinary`` is bucketed by customer its
    windows read the buckets as they are.
    """
    kw = dict(customer_col=CUSTOMER, seconds_col=SECONDS, id_col=TXN_ID, amount_col=AMOUNT, window_seconds=window_seconds,
              amount_scale=None, count_out="transaction_velocity", sum_out="amount_velocity")
    profile = dict(customer_col=CUSTOMER, category_col=CATEGORY, id_col=TXN_ID)
    return time_based_patterns(_ordinary_features(ordinary, kw, profile).unionByName(_heavy_features(heavy, kw, profile)))
