"""Many weighted logistic regressions from shared passes, and a certificate of optimality.

The model is MLlib's: the weighted mean of the log loss plus ``reg_param / 2`` times the squared
coefficients of the standardised features (intercept free, elastic net 0); a feature that is
constant on a fit's rows gets coefficient 0.  MLlib runs one fit after another, each with its own
passes.  Here all fits of a grid share them:

1. one aggregate by fold gives counts, means and spreads; each fit's own are sums over its folds;
2. one aggregate a Newton step gives, for every fit, the loss, the gradient and the Hessian.  A row
   goes to the fits whose rows it is one of; tasks send one row a fit;
3. the driver solves one small system a fit (it holds fits x features numbers) and halves a step
   that did not lower the loss.

Newton's steps don't depend on the features' scales; they are centred and scaled by literals so
that the sums don't lose digits.  The optimum is unique for ``reg_param > 0``, so results depend
on the rows alone.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import LABEL_COLUMN, WEIGHT_COLUMN

MAX_FEATURES = 24      # (d + 1)(d + 2) / 2 sums of a Hessian are one aggregate's columns
MAX_STEPS = 60
TOLERANCE = 1e-13      # of the Newton decrement, against the loss


@dataclass
class Spread:
    """Weighted moments of the features on some rows; those of disjoint rows add up."""

    n: int
    weight: float
    weight2: float
    mean: np.ndarray
    m2: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def __add__(self, other: Spread) -> Spread:
        w = self.weight + other.weight
        if not w:
            return self
        gap = other.mean - self.mean
        return Spread(self.n + other.n, w, self.weight2 + other.weight2, self.mean + gap * (other.weight / w),
                      self.m2 + other.m2 + gap * gap * (self.weight * other.weight / w),
                      np.minimum(self.low, other.low), np.maximum(self.high, other.high))

    @property
    def deviation(self) -> np.ndarray:
        """MLlib's standard deviations (weights as reliabilities); 0 of a constant feature."""
        den = self.weight - self.weight2 / self.weight if self.weight else 0.0
        with np.errstate(invalid="ignore"):
            out = np.sqrt(np.maximum(self.m2, 0) / den) if den > 0 else np.zeros_like(self.m2)
        return np.where(self.low == self.high, 0.0, out)


@dataclass
class Fit:
    """A regression of the grid: which fold is left out (None: no one), its penalty, its state."""

    fold: int | None
    reg_param: float
    beta: np.ndarray | None = None          # intercept first, of the centred and scaled features
    loss: float = math.inf
    decrement: float = math.inf
    steps: int = 0
    done: bool = False
    step: np.ndarray | None = None
    coefficients: np.ndarray | None = None  # of the features as they are
    intercept: float = 0.0
    # at the last but one step
    gradient: np.ndarray = field(default_factory=lambda: np.zeros(0))


def _columns(d: int) -> list[str]:
    return [f"_x{j}" for j in range(d)]


def narrow(df: DataFrame, label_col: str = LABEL_COLUMN, weight_col: str | None = WEIGHT_COLUMN,
           fold: Column | None = None, features_col: str = "features", keep: Sequence[str] = ()) -> DataFrame:
    """``_x0 ... _x{d-1}, _y, _w, _fold`` of the assembled rows, and the columns to keep."""
    d = width(df, features_col)
    x = vector_to_array(features_col)
    w = F.col(weight_col).cast("double") if weight_col else F.lit(1.0)
    return (df.withColumn("_x", x).select(*keep, *[F.col("_x")[j].alias(c) for j, c in enumerate(_columns(d))],
                                          F.col(label_col).cast("double").alias("_y"), w.alias("_w"),
                                          (fold if fold is not None else F.lit(0)).cast("int").alias("_fold")))


def width(df: DataFrame, features_col: str = "features") -> int:
    """Features of the assembled vectors: from the column's metadata, or its first row."""
    meta = df.schema[features_col].metadata.get("ml_attr", {})
    if "num_attrs" in meta:
        return int(meta["num_attrs"])
    first = df.select(F.size(vector_to_array(features_col)).alias("d")).first()
    return int(first["d"]) if first else 0


def spreads(rows: DataFrame, d: int) -> dict[int, Spread]:
    """The moments of every fold, by two aggregates (the second about the first's means).

    A label that is not 0 or 1, or a null feature, label or weight, is an error, as in MLlib.
    """
    xs = _columns(d)
    first = rows.agg(*map(F.expr, [f"count_if({' OR '.join(f'{c} IS NULL' for c in [*xs, '_w', '_fold'])} OR _y IS NULL OR _y NOT IN (0.0D, 1.0D)) AS bad",
                                   *[f"sum(_w * {c}) / sum(_w) AS {c}" for c in xs]])).first()
    if first["bad"]:
        raise ValueError(f"{first['bad']} rows have a null, or a label other than 0 and 1")
    about = [float(first[c]) if first[c] is not None else 0.0 for c in xs]
    sums = ["count(1) AS n", "sum(_w) AS w", "sum(_w * _w) AS w2"]
    for c, a in zip(xs, about):
        gap = f"({c} - {_number(a)})"
        sums += [f"sum(_w * {gap}) AS s{c}", f"sum(_w * {gap} * {gap}) AS q{c}", f"min({c}) AS l{c}", f"max({c}) AS h{c}"]
    out = {}
    for r in rows.groupBy("_fold").agg(*map(F.expr, sums)).collect():  # one row a fold
        take = lambda p: np.array([r[f"{p}{c}"] for c in xs], float)  # noqa: E731, B023
        s, wt = take("s"), float(r["w"])
        out[int(r["_fold"])] = Spread(int(r["n"]), wt, float(r["w2"]), np.array(about) + s / wt, take("q") - s * s / wt, take("l"), take("h"))
    return out


def _number(x: float) -> str:
    """A double as SQL text, every bit of it."""
    return f"double('{float(x)!r}')"


def _grid(fits: Sequence[Fit], values: Sequence[Sequence[float]], own: str) -> str:
    """Rows go to the fits for which ``own`` holds, with the fit's numbers ``_b0, _b1, ...``.

    The text of every pass is one expression: a column built part by part would cost more
    calls to the JVM than the pass itself takes on a small table.
    """
    structs = ", ".join("named_struct('_fit', {}, '_out', {}, {})".format(
        i, -1 if f.fold is None else f.fold, ", ".join(f"'_b{j}', {_number(b)}" for j, b in enumerate(v)))
        for i, (f, v) in enumerate(zip(fits, values)))
    return f"inline(filter(array({structs}), m -> {own}))"


def sums_by_fit(rows: DataFrame, fits: Sequence[Fit], d: int, centre: np.ndarray, scale: np.ndarray,
                betas: Sequence[np.ndarray]) -> dict[int, tuple[float, float, np.ndarray, np.ndarray]]:
    """Weight, loss, gradient and Hessian sums of every fit at its ``beta``: one grouped aggregate."""
    z = [f"_z{j}" for j in range(d + 1)]
    design = ["1.0D AS _z0"] + [f"({c} - {_number(m)}) / {_number(s)} AS {t}" for c, m, s, t in zip(_columns(d), centre, scale, z[1:])]
    keep = ["_fit", "_w", *z]
    wide = (rows.selectExpr("_y", "_w", *design, _grid(fits, betas, "m._out <> _fold"))
            .selectExpr(*keep, "_y", " + ".join(f"_b{j} * {c}" for j, c in enumerate(z)) + " AS _eta")
            .selectExpr(*keep, "_y", "_w * (greatest(_eta, 0.0D) + log1p(exp(-abs(_eta))) - _y * _eta) AS _loss", "1.0D / (1.0D + exp(-_eta)) AS _p")
            .selectExpr(*keep, "_loss", "_w * (_p - _y) AS _r", "_w * _p * (1.0D - _p) AS _v"))
    pairs = [(j, k) for j in range(d + 1) for k in range(j, d + 1)]
    sums = ["sum(_w) AS w", "sum(_loss) AS loss", *[f"sum(_r * {c}) AS g{j}" for j, c in enumerate(z)],
            *[f"sum(_v * {z[j]} * {z[k]}) AS h{j}_{k}" for j, k in pairs]]
    out = {}
    for r in wide.groupBy("_fit").agg(*map(F.expr, sums)).collect():  # one row a fit
        hess = np.zeros((d + 1, d + 1))
        for j, k in pairs:
            hess[j, k] = hess[k, j] = r[f"h{j}_{k}"]
        out[int(r["_fit"])] = float(r["w"]), float(r["loss"]), np.array([r[f"g{j}"] for j in range(d + 1)]), hess
    return out


def _penalty(fit: Fit, deviation: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.r_[0.0, fit.reg_param * (deviation / scale) ** 2]


def fit_grid(rows: DataFrame, grid: Sequence[tuple[int | None, float]], d: int) -> list[Fit]:
    """A converged regression for every (fold left out, penalty), from shared passes over ``rows``.

    ``rows`` comes from :func:`narrow` and is read once a step: keep it written or persisted.
    """
    if d > MAX_FEATURES:
        raise ValueError(f"{d} features: shared passes take {MAX_FEATURES} at most")
    fits = [Fit(fold, float(reg)) for fold, reg in grid]
    by_fold = spreads(rows, d)
    if not by_fold:
        raise ValueError("no rows to fit")

    def spread_of(fit: Fit) -> Spread:
        own = [s for f, s in sorted(by_fold.items()) if f != fit.fold]
        if not own:
            raise ValueError(f"fold {fit.fold} holds all rows")
        total = own[0]
        for s in own[1:]:
            total = total + s
        return total

    own = [spread_of(f) for f in fits]
    every = spread_of(Fit(None, 0.0))
    centre, scale = every.mean, np.where(every.deviation > 0, every.deviation, 1.0)
    # a feature that is constant on a fit's rows is left out of it
    free = [np.r_[True, s.deviation > 0] for s in own]
    tried = [np.zeros(d + 1) for _ in fits]
    for f in fits:
        f.beta = np.zeros(d + 1)
    for _ in range(MAX_STEPS):
        live = [i for i, f in enumerate(fits) if not f.done]
        if not live:
            break
        sums = sums_by_fit(rows, [fits[i] for i in live], d, centre, scale, [tried[i] for i in live])
        for at, i in enumerate(live):
            f, (w, loss, g, h) = fits[i], sums[at]
            pen, use = _penalty(f, own[i].deviation, scale), free[i]
            value = loss / w + 0.5 * float(pen @ (tried[i] * tried[i]))
            f.steps += 1
            if value > f.loss + 1e-12 * (1 + abs(f.loss)):  # went too far: half the step
                f.step = f.step / 2
                tried[i] = f.beta + f.step
                continue
            f.beta, f.loss = tried[i], value
            grad, hess = g / w + pen * f.beta, h / w + np.diag(pen)
            f.gradient = np.where(use, grad, 0.0)
            step = np.zeros(d + 1)
            step[use] = -np.linalg.lstsq(hess[np.ix_(use, use)], grad[use], rcond=None)[0]
            f.decrement = float(-grad @ step) / 2
            if f.decrement <= TOLERANCE * (1 + abs(value)):
                f.beta, f.done = f.beta + step, True  # so near, a step squares the distance
            else:
                f.step, tried[i] = step, f.beta + step
    for f in fits:
        f.coefficients = f.beta[1:] / scale
        f.intercept = float(f.beta[0] - f.coefficients @ centre)
    return fits


def margins(rows: DataFrame, fits: Sequence[Fit], d: int) -> DataFrame:
    """(fit, y, margin): the rows of each fit's left-out fold with its linear predictor."""
    values = [[f.intercept, *f.coefficients] for f in fits]
    wide = rows.selectExpr("_y", *_columns(d), _grid(fits, values, "m._out = _fold"))
    return wide.selectExpr("_fit AS fit", "_y AS y", " + ".join(["_b0", *[f"_b{j + 1} * {c}" for j, c in enumerate(_columns(d))]]) + " AS margin")


def certificate(rows: DataFrame, coefficients: Sequence[float], intercept: float, reg_param: float, d: int) -> dict:
    """How far a model is from the optimum of its rows: one aggregate beside the moments.

    ``loss`` with the penalty, ``gradient`` by standardised coefficient (intercept first), its
    largest ``norm``, and ``gap``: the Newton decrement, what a full step would lower the loss by.
    At the optimum the norm and the gap are 0.
    """
    by_fold = spreads(rows, d)
    total = None
    for _, s in sorted(by_fold.items()):
        total = s if total is None else total + s
    centre, scale = total.mean, np.where(total.deviation > 0, total.deviation, 1.0)
    coefficients = np.asarray(coefficients, float)
    beta = np.r_[intercept + coefficients @ centre, coefficients * scale]
    fit, use = Fit(None, float(reg_param)), np.r_[True, total.deviation > 0]
    w, loss, g, h = sums_by_fit(rows, [fit], d, centre, scale, [beta])[0]
    pen = _penalty(fit, total.deviation, scale)
    grad, hess = np.where(use, g / w + pen * beta, 0.0), h / w + np.diag(pen)
    step = np.linalg.lstsq(hess[np.ix_(use, use)], grad[use], rcond=None)[0]
    return {"loss": loss / w + 0.5 * float(pen @ (beta * beta)), "gradient": grad, "norm": float(np.abs(grad).max()),
            "gap": float(grad[use] @ step) / 2}
