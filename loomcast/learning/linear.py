"""Linear models from sums of products: one pass over the rows, however many targets and penalties.

A task adds up the products of all features and targets of its rows, one matrix per Arrow batch
and group (fold), and gives one row per cell. What reaches the driver are features x features
cells; every fit, penalty path and cross-validation is solved from them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Moments:
    """Sums of products of (1, features, target) over a set of rows, around ``shift``."""

    products: np.ndarray
    shift: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.products + other.products, self.shift)

    def __sub__(self, other: Moments) -> Moments:
        return Moments(self.products - other.products, self.shift)

    @property
    def n(self) -> int:
        return int(round(self.products[0, 0]))

    @property
    def means(self) -> np.ndarray:
        """Means of the features and the target, around the shift."""
        return self.products[0, 1:] / self.n

    def covariance(self) -> np.ndarray:
        """Covariances of the features and, last, the target, over n."""
        m = self.means
        return self.products[1:, 1:] / self.n - np.outer(m, m)

    def squared_error(self, weights: np.ndarray, intercept: float) -> float:
        """Mean squared error of a model of shifted features on these rows."""
        v = np.concatenate(([-intercept], -weights, [1.0]))
        return float(v @ self.products @ v) / self.n

    def intercept(self, weights: np.ndarray) -> float:
        """Intercept of a model of shifted features that has no mean error."""
        m = self.means
        return float(m[-1] - m[:-1] @ weights)

    def unshifted(self, weights: np.ndarray) -> float:
        """Intercept of the same model for features and target as they are."""
        return self.intercept(weights) + float(self.shift[-1] - self.shift[:-1] @ weights)


def _products(features: int, targets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Cells (group, target, i, j): of target -1 over the rows that have all targets, of each
    target over the rows that have it but not all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}

        def add(group: int, target: int, rows: np.ndarray) -> None:
            product = rows.T @ rows
            held[group, target] = held[group, target] + product if (group, target) in held else product

        for batch in batches:
            groups = batch.column(0).to_numpy(zero_copy_only=False)
            has = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns[1 + features :]])
            values = np.column_stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in batch.columns[1:]])
            rows = np.column_stack([np.ones(len(values)), values])
            whole = has.all(axis=1)
            for g in np.unique(groups):
                mine = groups == g
                add(int(g), -1, rows[mine & whole])
                part = rows[mine & ~whole]
                known = has[mine & ~whole]
                for t in range(targets):
                    if known[:, t].any():
                        add(int(g), t, part[known[:, t]][:, [*range(1 + features), 1 + features + t]])
        for (g, t), product in held.items():
            i, j = np.triu_indices(len(product))
            arrays = [np.full(len(i), g, np.int32), np.full(len(i), t, np.int32), i.astype(np.int32), j.astype(np.int32), product[i, j]]
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=["g", "t", "i", "j", "v"])

    return run


def _value(column: str) -> Column:
    return F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))


def gather_moments(
    df: DataFrame, features: Sequence[str], targets: Sequence[str], group: str | None = None
) -> dict[str, dict[int, Moments]]:
    """Moments per target and group of rows, over the rows that have all features and the target.

    One pass for the means, so that products are small, and one for the products of all targets
    and groups. Without ``group`` all rows are group 0.
    """
    features, targets = list(features), list(targets)
    columns = [*features, *targets]
    means = df.agg(*[F.avg(_value(c)).alias(f"m{k}") for k, c in enumerate(columns)]).first()
    shift = np.array([m or 0.0 for m in means])
    named = [(_value(c) - F.lit(float(s))).alias(f"x{k}") for k, (c, s) in enumerate(zip(columns, shift, strict=True))]
    number = F.col(group).cast("int") if group else F.lit(0)
    rows = df.select(number.alias("g"), *named).dropna(subset=[f"x{k}" for k in range(len(features))])
    cells = rows.mapInArrow(_products(len(features), len(targets)), "g int, t int, i int, j int, v double")
    p, found = len(features), {}
    for r in cells.groupBy("g", "t", "i", "j").agg(F.sum("v").alias("v")).collect():
        size = 1 + p + (len(targets) if r["t"] < 0 else 1)
        matrix = found.setdefault((r["g"], r["t"]), np.zeros((size, size)))
        matrix[r["i"], r["j"]] = matrix[r["j"], r["i"]] = r["v"]
    out: dict[str, dict[int, Moments]] = {}
    for t, target in enumerate(targets):
        own = [*range(1 + p), 1 + p + t]
        around = np.array([*shift[:p], shift[p + t]])
        for g in sorted({g for g, _ in found}):
            products = found.get((g, t), np.zeros((p + 2, p + 2)))
            if (g, -1) in found:
                products = products + found[g, -1][np.ix_(own, own)]
            if products[0, 0]:
                out.setdefault(target, {})[g] = Moments(products, around)
    return out


def soft(value: float, by: float) -> float:
    return float(np.sign(value) * max(abs(value) - by, 0.0))


def descend(
    gram: np.ndarray, right: np.ndarray, l1: float, l2: float, start: np.ndarray, tolerance: float = 1e-10, rounds: int = 10_000
) -> np.ndarray:
    """Weights that minimise w'Gw / 2 - w'r + l1 |w| + l2 w'w / 2, by coordinate descent.

    A feature without spread has weight 0.
    """
    weights, spread = start.copy(), np.diag(gram)
    scale = np.sqrt(np.maximum(spread, 0.0))
    slope = right - gram @ weights
    largest = max(float(np.abs(right / np.where(scale > 0, scale, 1.0)).max(initial=0.0)), 1e-300)
    for _ in range(rounds):
        moved = 0.0
        for k in range(len(weights)):
            if spread[k] <= 1e-14 * max(1.0, float(spread.max())):
                weights[k] = 0.0
                continue
            new = soft(slope[k] + spread[k] * weights[k], l1) / (spread[k] + l2)
            step = new - weights[k]
            if step:
                slope -= gram[:, k] * step
                weights[k] = new
                moved = max(moved, abs(step) * scale[k])
        if moved <= tolerance * largest:
            break
    return weights


def penalty_path(moments: Moments, length: int = 100, ratio: float = 1e-3) -> np.ndarray:
    """Penalties from the least that leaves no weight, down to ``ratio`` of it, evenly in the logarithm."""
    most = float(np.abs(moments.covariance()[:-1, -1]).max(initial=0.0))
    return most * ratio ** (np.arange(length) / max(length - 1, 1))


def lasso_path(moments: Moments, penalties: Sequence[float]) -> list[np.ndarray]:
    """Weights for falling penalties, each starting from the one before."""
    covariance = moments.covariance()
    gram, right = covariance[:-1, :-1], covariance[:-1, -1]
    weights, out = np.zeros(len(right)), []
    for penalty in penalties:
        weights = descend(gram, right, float(penalty), 0.0, weights)
        out.append(weights)
    return out


@dataclass(frozen=True)
class Lasso:
    """Chosen penalty, its weights, and the mean error over the folds of every penalty."""

    penalty: float
    weights: np.ndarray
    intercept: float
    penalties: np.ndarray
    errors: np.ndarray


def cross_validated_lasso(folds: Mapping[int, Moments], length: int = 100, ratio: float = 1e-3) -> Lasso:
    """The penalty of least mean squared error over the folds; ties go to the larger one."""
    parts = list(folds.values())
    total = sum(parts[1:], parts[0])
    penalties = penalty_path(total, length, ratio)
    errors = np.zeros(len(penalties))
    tested = [f for f in parts if len(parts) > 1 and total.n > f.n]
    for fold in tested:
        rest = total - fold
        for k, weights in enumerate(lasso_path(rest, penalties)):
            errors[k] += fold.squared_error(weights, rest.intercept(weights)) / len(tested)
    best = int(np.argmin(errors))
    weights = lasso_path(total, penalties[: best + 1])[-1]
    return Lasso(float(penalties[best]), weights, total.unshifted(weights), penalties, errors)


def elastic_net(moments: Moments, penalty: float = 0.0, l1_share: float = 0.0) -> tuple[np.ndarray, float]:
    """Weights and intercept of least squares with a penalty on the weights of standardised features.

    The ridge part is relative to the deviation of the target, as in Spark ML's linear regression.
    """
    covariance = moments.covariance()
    deviation = np.sqrt(np.maximum(np.diag(covariance), 0.0))
    scale = np.where(deviation[:-1] > 1e-12 * max(1.0, float(np.abs(moments.shift).max())), deviation[:-1], 0.0)
    used = scale > 0
    weights = np.zeros(len(scale))
    if used.any() and deviation[-1] > 0:
        gram = covariance[:-1, :-1][np.ix_(used, used)] / np.outer(scale[used], scale[used])
        right = covariance[:-1, -1][used] / scale[used]
        l1, l2 = penalty * l1_share, penalty * (1 - l1_share) / deviation[-1]
        if l1 == 0:
            solved = np.linalg.lstsq(gram + l2 * np.eye(len(gram)), right, rcond=1e-12)[0]
        else:
            solved = descend(gram, right, l1, l2, np.zeros(len(right)))
        weights[used] = solved / scale[used]
    return weights, moments.unshifted(weights)


class LinearForecast(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the weighted sum of some columns; null where one of them is missing."""

    features = Param(Params._dummy(), "features", "columns of the sum", TypeConverters.toListString)
    weights = Param(Params._dummy(), "weights", "one weight per column", TypeConverters.toListFloat)
    intercept = Param(Params._dummy(), "intercept", "constant of the sum", TypeConverters.toFloat)
    outputCol = Param(Params._dummy(), "outputCol", "name of the sum", TypeConverters.toString)

    @keyword_only
    def __init__(
        self,
        *,
        features: Sequence[str] | None = None,
        weights: Sequence[float] | None = None,
        intercept: float = 0.0,
        outputCol: str = "yhat",
    ) -> None:
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        total = F.lit(self.getOrDefault("intercept"))
        for name, weight in zip(self.getOrDefault("features"), self.getOrDefault("weights"), strict=True):
            total = total + F.lit(float(weight)) * F.col(f"`{name}`").cast("double")
        return dataset.withColumn(self.getOrDefault("outputCol"), total)


def fit_horizons(
    df: DataFrame, features: Sequence[str], targets: Mapping[int, str], penalties: Mapping[int, tuple[float, float]]
) -> dict[int, tuple[LinearForecast, int]]:
    """A linear model per horizon with the number of its rows, all horizons from one pass.

    ``penalties`` has the penalty and its L1 share per horizon.
    """
    moments = gather_moments(df, features, [targets[h] for h in penalties])
    out = {}
    for h, (penalty, l1_share) in penalties.items():
        if targets[h] not in moments:
            raise ValueError(f"horizon {h} has no complete row to fit on")
        own = moments[targets[h]][0]
        weights, intercept = elastic_net(own, penalty, l1_share)
        model = LinearForecast(
            features=list(features), weights=[float(w) for w in weights], intercept=float(intercept), outputCol=f"yhat_{h}"
        )
        out[h] = (model, own.n)
    return out
