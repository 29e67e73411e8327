"""Linear models from one pass over the rows: counts, means and co-moments per part.

What least squares, ridge, lasso and elastic net need of the rows is the matrix of
co-moments of features and label. It is summed up once for every part (split or
time block) in a single aggregate; parts are then added up, penalties searched by
coordinate descent and errors worked out on matrices of features squared, without
another look at the rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from headway.operators.modeling import ELASTIC_NET, LASSO_ALPHA, RIDGE_ALPHA

MOST_FEATURES = 100  # co-moments are one aggregate each
MOST_PARTS = 10_000  # rows that come to the driver
SWEEPS, CLOSE = 10_000, 1e-12


@dataclass(frozen=True)
class Moments:
    """Rows, means and sums of centred products of some columns, the label last."""

    n: int
    mean: np.ndarray
    product: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        if not self.n or not other.n:
            return self if self.n else other
        n, apart = self.n + other.n, other.mean - self.mean
        return Moments(
            n, self.mean + apart * (other.n / n), self.product + other.product + np.outer(apart, apart) * (self.n * other.n / n)
        )

    def spread(self) -> np.ndarray:
        """Sample standard deviation of each column."""
        return np.sqrt(np.clip(np.diag(self.product), 0, None) / max(self.n - 1, 1))

    def scaled(self, mean: np.ndarray, spread: np.ndarray) -> Moments:
        """Moments of the features centred and divided by a spread; a column without one becomes 0."""
        by = np.append(np.divide(1.0, spread, out=np.zeros_like(spread), where=spread > 0), 1.0)
        return Moments(self.n, (self.mean - np.append(mean, 0.0)) * by, self.product * np.outer(by, by))


def moments(df: DataFrame, columns: Sequence[str], label: str, part: str | Column) -> dict:
    """Moments of each part, from one aggregate; rows with a missing value are left out."""
    if len(columns) > MOST_FEATURES:
        raise ValueError(f"{len(columns)} features are more than {MOST_FEATURES}")
    names = [*columns, label]
    values = [F.col(f"`{c}`").cast("double") for c in names]
    rows = df.select((F.col(part) if isinstance(part, str) else part).alias("part"), *[v.alias(f"v{i}") for i, v in enumerate(values)]).dropna()
    v = [F.col(f"v{i}") for i in range(len(names))]
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    found = rows.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(x).alias(f"s{i}") for i, x in enumerate(v)],
        *[F.sum(v[i] * v[j]).alias(f"p{i}_{j}") for i, j in pairs],
    ).limit(MOST_PARTS + 1).collect()
    if len(found) > MOST_PARTS:
        raise ValueError(f"over {MOST_PARTS} parts")
    out = {}
    for row in found:
        n, total = row["n"], np.array([row[f"s{i}"] for i in range(len(names))])
        product = np.zeros((len(names), len(names)))
        for i, j in pairs:
            product[i, j] = product[j, i] = row[f"p{i}_{j}"] - total[i] * total[j] / n
        out[row["part"]] = Moments(n, total / n, product)
    return out


@dataclass(frozen=True)
class LinearFit:
    """Weights of the features and intercept; ``params`` are the setting it was fitted with."""

    weights: np.ndarray
    intercept: float
    params: Mapping[str, float]
    rmse: float | None = None

    def error(self, part: Moments) -> float:
        """Sum of squared errors over the rows of a part."""
        w = np.append(self.weights, -1.0)
        miss = float(part.mean @ w) + self.intercept
        return float(max(w @ part.product @ w, 0.0) + part.n * miss * miss)

    def column(self, columns: Sequence[str]) -> Column:
        return sum((F.lit(float(w)) * F.col(f"`{c}`") for w, c in zip(self.weights, columns)), F.lit(float(self.intercept)))


def _descend(product: np.ndarray, target: np.ndarray, l1: np.ndarray, l2: np.ndarray) -> np.ndarray:
    """Minimise w'Aw/2 - t'w + l1'|w| + l2'w^2/2 by coordinate descent."""
    w = np.zeros(len(target))
    diagonal = np.diag(product) + l2
    for _ in range(SWEEPS):
        moved = 0.0
        for j in np.flatnonzero(diagonal > 0):
            pull = target[j] - product[j] @ w + product[j, j] * w[j]
            new = np.sign(pull) * max(abs(pull) - l1[j], 0.0) / diagonal[j]
            moved = max(moved, abs(new - w[j]) * np.sqrt(diagonal[j]))
            w[j] = new
        if moved <= CLOSE * np.sqrt(max(float(np.abs(target).max(initial=0.0)), 1.0)):
            break
    return w


def _fitted(train: Moments, l1: np.ndarray, l2: np.ndarray, params: Mapping[str, float]) -> LinearFit:
    n = max(train.n, 1)
    product, target = train.product[:-1, :-1] / n, train.product[:-1, -1] / n
    if l1.any():
        w = _descend(product, target, l1, l2)
    else:
        w = np.linalg.lstsq(product + np.diag(l2), target, rcond=None)[0]
    return LinearFit(w, float(train.mean[-1] - w @ train.mean[:-1]), dict(params))


def least_squares(train: Moments) -> LinearFit:
    none = np.zeros(len(train.mean) - 1)
    return _fitted(train, none, none, {})


def ridge(train: Moments, alpha: float = RIDGE_ALPHA) -> LinearFit:
    """Minimise |y - Xw|^2 + alpha*|w|^2."""
    none = np.zeros(len(train.mean) - 1)
    return _fitted(train, none, none + alpha / max(train.n, 1), {"alpha": alpha})


def lasso(train: Moments, alpha: float = LASSO_ALPHA) -> LinearFit:
    """Minimise |y - Xw|^2 / (2n) + alpha*|w|_1."""
    none = np.zeros(len(train.mean) - 1)
    return _fitted(train, none + alpha, none, {"alpha": alpha})


def elastic_net(
    train: Moments, regParam: float = ELASTIC_NET["regParam"], elasticNetParam: float = ELASTIC_NET["elasticNetParam"]
) -> LinearFit:
    """Spark's elastic net: penalties weigh standardised weights, the squared one over the label's deviation."""
    spread = train.spread()
    own, label = spread[:-1], spread[-1] or 1.0
    return _fitted(
        train, regParam * elasticNetParam * own, regParam * (1 - elasticNetParam) * own * own / label,
        {"regParam": regParam, "elasticNetParam": elasticNetParam},
    )


def search(fit, grid: Iterable[Mapping[str, float]], train: Moments, val: Moments) -> list[LinearFit]:
    """Fit every setting and rank by the error on the validation part; the first of equal ones leads."""
    found = []
    for setting in grid:
        model = fit(train, **setting)
        rmse = np.sqrt(model.error(val) / val.n) if val.n else float("nan")
        found.append(replace(model, params=dict(setting), rmse=float(rmse)))
    return sorted(found, key=lambda m: m.rmse)


@dataclass(frozen=True)
class Fold:
    """What a setting reached on one block after all blocks before it."""

    params: Mapping[str, float]
    block: object
    n_train: int
    n: int
    rmse: float


def rolling(fit, grid: Sequence[Mapping[str, float]], blocks: Mapping[object, Moments], first: int = 1) -> list[Fold]:
    """Rolling-origin validation: each block from the ``first`` on is scored by a fit on all blocks before it.

    Training sets are running sums of the blocks' moments, so a fold costs no pass.
    """
    order, folds = sorted(blocks), []
    train = sum((blocks[b] for b in order[1:first]), blocks[order[0]]) if order else None
    for block in order[first:]:
        part = blocks[block]
        for setting in grid:
            model = fit(train, **setting)
            folds.append(Fold(dict(setting), block, train.n, part.n, float(np.sqrt(model.error(part) / part.n))))
        train = train + part
    return folds


def rolling_search(fit, grid: Sequence[Mapping[str, float]], blocks: Mapping[object, Moments], first: int = 1) -> list[tuple[dict, float]]:
    """Settings and their error over the rows of all folds, the best first."""
    folds, found = rolling(fit, grid, blocks, first), []
    for setting in grid:
        own = [f for f in folds if f.params == dict(setting)]
        rows = sum(f.n for f in own)
        found.append((dict(setting), float(np.sqrt(sum(f.rmse**2 * f.n for f in own) / rows)) if rows else float("nan")))
    return sorted(found, key=lambda x: x[1])
