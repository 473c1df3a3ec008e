"""Linear models from one pass over the rows.

Everything a linear fit needs is a sum over rows: how often two categories meet, the sum of each number per category, and the products
of any two numbers. Each row gives one head per number, per category and per pair of categories, and every head sums all numbers of its
row; that is one aggregate, combined before its shuffle, and its result is as large as the model's square, whatever the rows. Missing
values need no pass of their own: a missing number counts as 0 and has a flag that is summed too, a missing category is one of its own. Means and
modes come out of the same sums and are put in afterwards, by adding up rows and columns of the matrix.

From that matrix the driver solves least squares, ridge and elastic net, and tells R2 on any split that was summed with it.
A fitted model is a short table of coefficients, and its prediction one column expression.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.session import cut_lineage

#: Categories that one fit may have; the driver holds the square of this many numbers.
MOST_LEVELS = 4096
SWEEPS = 20_000
#: A sweep of coordinate descent that moves no coefficient by more, relative to the largest, is the last.
STILL = 1e-13
_SCHEMA = "kind string, name string, level string, coefficient double, fill string"


def _number(name: str) -> Column:
    value = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(value), value)


@dataclass(frozen=True)
class LinearModel:
    """Coefficients by category and number, with the values that stand in for missing ones."""

    intercept: float
    levels: dict[str, dict[str, float]]
    modes: dict[str, str]
    numbers: dict[str, float]
    means: dict[str, float]

    def prediction(self) -> Column:
        """The model as one expression; a category it does not know adds nothing."""
        total = F.lit(self.intercept)
        for name, of in self.levels.items():
            told = [F.lit(x) for level, w in of.items() if w for x in (level, w)]
            if told:
                value = F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(self.modes[name]))
                total = total + F.coalesce(F.try_element_at(F.create_map(*told), value), F.lit(0.0))
        for name, w in self.numbers.items():
            if w:
                total = total + F.coalesce(_number(name), F.lit(self.means[name])) * w
        return total

    def table(self, spark: SparkSession) -> DataFrame:
        """``kind``, ``name``, ``level``, ``coefficient`` and ``fill``, one row per term."""
        rows = [("intercept", None, None, self.intercept, None)]
        rows += [("level", c, level, w, self.modes[c]) for c, of in self.levels.items() for level, w in of.items()]
        rows += [("number", c, None, w, repr(self.means[c])) for c, w in self.numbers.items()]
        return spark.createDataFrame(rows, _SCHEMA)

    def save(self, spark: SparkSession, path: str) -> None:
        self.table(spark).coalesce(1).write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> LinearModel:
    rows = spark.read.schema(_SCHEMA).parquet(path).collect()
    levels: dict[str, dict[str, float]] = {}
    for r in sorted((r for r in rows if r.kind == "level"), key=lambda r: (r.name, r.level)):
        levels.setdefault(r.name, {})[r.level] = r.coefficient
    numbers = [r for r in rows if r.kind == "number"]
    return LinearModel(
        next(r.coefficient for r in rows if r.kind == "intercept"), levels, {r.name: r.fill for r in rows if r.kind == "level"},
        {r.name: r.coefficient for r in numbers}, {r.name: float(r.fill) for r in numbers},
    )


class Moments:
    """The sums of the rows, one matrix per split."""

    def __init__(self, rows: DataFrame, categorical: list[str], numeric: list[str], label: str, split: str | None = None):
        """One pass over ``rows``; those without a label are left out. ``split`` names a column that parts the sums."""
        self.categorical, self.numeric = list(categorical), list(numeric)
        self.sums = ["1", "y", *numeric, *(f"missing {c}" for c in numeric)]
        known = [_number(c) for c in numeric]
        values = [F.lit(1.0), _number(label), *[F.coalesce(x, F.lit(0.0)) for x in known], *[x.isNull().cast("double") for x in known]]
        v = [f"v{k}" for k in range(len(values))]
        level = [f"c{k}" for k in range(len(categorical))]
        part = F.lit("all") if split is None else F.col(f"`{split}`").cast("string")
        narrow = rows.where(_number(label).isNotNull()).select(
            part.alias("part"), *[x.alias(n) for x, n in zip(values, v)],
            *[F.col(f"`{c}`").cast("string").alias(n) for c, n in zip(categorical, level)],
        )

        def head(block: str, weight: Column, one: str | None = None, other: str | None = None) -> Column:
            told = [F.col(c) if c else F.lit(None).cast("string") for c in (one, other)]
            return F.struct(F.lit(block).alias("block"), told[0].alias("one"), told[1].alias("other"), weight.alias("w"))

        heads = [head(n, F.col(n)) for n in v] + [head(c, F.lit(1.0), c) for c in level]
        heads += [head(f"{a} {b}", F.lit(1.0), a, b) for a, b in combinations(level, 2)]
        each = narrow.select("part", *v, F.explode(F.array(*heads)).alias("head"))
        summed = each.groupBy("part", "head.block", "head.one", "head.other").agg(*[F.sum(F.col("head.w") * F.col(n)).alias(n) for n in v])
        stored = cut_lineage(summed)
        known_levels = stored.where(F.col("block").isin(level)).select("block", "one").distinct().count() if level else 0
        if known_levels > MOST_LEVELS:
            raise ValueError(f"{known_levels} categories: fit with pyspark.ml beyond {MOST_LEVELS}")
        self._read(stored.collect(), v, level)

    def _read(self, rows: list, v: list[str], level: list[str]) -> None:
        singles = sorted({(r.block, r.one is None, r.one or "") for r in rows if r.block in level})
        self.at = {(b, None if none else name): len(v) + i for i, (b, none, name) in enumerate(singles)}
        self.level = level
        size = len(v) + len(singles)
        self.raw: dict[str, np.ndarray] = {}
        for r in rows:
            matrix = self.raw.setdefault(r.part, np.zeros((size, size)))
            told = np.array([r[n] for n in v], dtype=float)
            if r.block in v:
                matrix[v.index(r.block), : len(v)] = told
            elif r.block in level:
                i = self.at[(r.block, r.one)]
                matrix[i, : len(v)] = matrix[: len(v), i] = told
                matrix[i, i] = told[0]
            else:
                a, b = r.block.split()
                i, j = self.at[(a, r.one)], self.at[(b, r.other)]
                matrix[i, j] = matrix[j, i] = told[0]

    def design(self, part: str, drop_first: bool = False) -> Design:
        """The features as ``part`` defines them: its categories, modes and means."""
        raw = self.raw.get(part)
        if raw is None:
            raise ValueError(f"no rows with a label in split {part!r}")
        columns, names = [], []
        size, n = len(raw), raw[0, 0]
        modes: dict[str, str] = {}

        def unit(*places: int) -> np.ndarray:
            column = np.zeros(size)
            column[list(places)] = 1.0
            return column

        for block, name in zip(self.level, self.categorical):
            held = {lv: i for (b, lv), i in self.at.items() if b == block and lv is not None and raw[i, i] > 0}
            missing = self.at.get((block, None))
            modes[name] = min(held, key=lambda lv: (-raw[held[lv], held[lv]], lv), default="")
            for lv in sorted(held)[1 if drop_first else 0 :]:
                filled = missing is not None and lv == modes[name]
                columns.append(unit(held[lv], missing) if filled else unit(held[lv]))
                names.append((name, lv))
        means = {}
        for k, name in enumerate(self.numeric):
            at, flag = 2 + k, 2 + len(self.numeric) + k
            known = n - raw[0, flag]
            if known:
                means[name] = float(raw[0, at] / known)
                columns.append(unit(at) + means[name] * unit(flag))
                names.append((name, None))
        return Design(self, names, np.array(columns).reshape(len(names), size), modes, means, part)


@dataclass(frozen=True)
class Design:
    """Features as combinations of what was summed."""

    moments: Moments
    names: list[tuple[str, str | None]]
    columns: np.ndarray
    modes: dict[str, str]
    means: dict[str, float]
    part: str

    def centred(self, part: str) -> tuple[np.ndarray, np.ndarray, float, np.ndarray, float, float]:
        """X'X, X'y and y'y about the means; the means of X and y; the number of rows."""
        raw = self.moments.raw[part]
        n, mean_y = raw[0, 0], raw[0, 1] / raw[0, 0]
        mean = self.columns @ raw[:, 0] / n
        gram = self.columns @ raw @ self.columns.T - n * np.outer(mean, mean)
        return gram, self.columns @ raw[:, 1] - n * mean * mean_y, raw[1, 1] - n * mean_y**2, mean, mean_y, n

    def _spread(self, gram: np.ndarray) -> np.ndarray:
        """Which columns vary; rounding alone leaves a column about this much of its squares."""
        squares = np.einsum("ij,jk,ik->i", self.columns, self.moments.raw[self.part], self.columns)
        return np.diag(gram) > 1e-12 * squares

    def least_squares(self) -> LinearModel:
        """Minimises ``|y - Xw|^2``; of several solutions the shortest."""
        gram, xy, *_ = self.centred(self.part)
        # Solved for columns of equal spread, because their squares may differ by many powers of ten.
        unit = np.where(self._spread(gram), 1.0 / np.sqrt(np.maximum(np.diag(gram), 1e-300)), 0.0)
        values, vectors = np.linalg.eigh(gram * np.outer(unit, unit))
        told = values > 1e-11 * values.max(initial=0.0)
        w = unit * (vectors[:, told] @ ((vectors[:, told].T @ (unit * xy)) / values[told]))
        free, _ = np.linalg.qr(unit[:, None] * vectors[:, ~told])
        return self._model(w - free @ (free.T @ w))

    def ridge(self, alpha: float) -> LinearModel:
        """Minimises ``|y - Xw|^2 + alpha * |w|^2``."""
        gram, xy, *_ = self.centred(self.part)
        return self._model(np.linalg.solve(gram + alpha * np.eye(len(xy)), xy))

    def elastic_net(self, alpha: float, l1_ratio: float) -> LinearModel:
        """Minimises ``|y - Xw|^2 / 2n + alpha * l1_ratio * |w|_1 + alpha * (1 - l1_ratio) / 2 * |w|^2`` by coordinate descent."""
        gram, xy, *_, n = self.centred(self.part)
        lasso, quadratic = n * alpha * l1_ratio, n * alpha * (1.0 - l1_ratio)
        usable = np.flatnonzero(self._spread(gram))
        w, left = np.zeros(len(xy)), xy.copy()
        for _ in range(SWEEPS):
            moved = 0.0
            for j in usable:
                rho = left[j] + gram[j, j] * w[j]
                new = np.sign(rho) * max(abs(rho) - lasso, 0.0) / (gram[j, j] + quadratic)
                if new != w[j]:
                    left -= gram[:, j] * (new - w[j])
                    moved = max(moved, abs(new - w[j]))
                    w[j] = new
            if moved <= STILL * max(1.0, np.abs(w).max(initial=0.0)):
                break
        return self._model(w)

    def _model(self, w: np.ndarray) -> LinearModel:
        *_, mean, mean_y, _ = self.centred(self.part)
        levels: dict[str, dict[str, float]] = {}
        for (name, lv), x in zip(self.names, w):
            if lv is not None:
                levels.setdefault(name, {})[lv] = float(x)
        numbers = {name: float(x) for (name, lv), x in zip(self.names, w) if lv is None}
        return LinearModel(float(mean_y - mean @ w), levels, self.modes, numbers, self.means)

    def r2(self, model: LinearModel, part: str) -> tuple[float | None, int]:
        """R2 of the model on a split, and its rows; a label without spread gives 1.0 if every prediction is right, else 0.0."""
        if part not in self.moments.raw:
            return None, 0
        gram, xy, yy, mean, mean_y, n = self.centred(part)
        w = np.array([model.numbers[c] if lv is None else model.levels[c][lv] for c, lv in self.names])
        off = mean_y - model.intercept - mean @ w
        wrong = yy - 2 * w @ xy + w @ gram @ w + n * off**2
        if yy <= 1e-12 * max(1.0, n * mean_y**2):
            return (1.0 if wrong <= 1e-12 * max(1.0, n * mean_y**2) else 0.0), int(n)
        return float(1.0 - wrong / yy), int(n)


def score(model: LinearModel, rows: DataFrame) -> DataFrame:
    """``rows`` with ``prediction``."""
    return rows.withColumn("prediction", model.prediction())


def compare(moments: Moments, candidates: Iterable[str], train: str = "train", drop_first: bool = True, **options) -> list[tuple]:
    """(model, split, r2, rows) of ``linear_regression``, ``ridge`` and ``elastic_net`` on every split that was summed."""
    design = moments.design(train, drop_first)
    fits = {
        "linear_regression": lambda: design.least_squares(),
        "ridge": lambda: design.ridge(options["ridge"]),
        "elastic_net": lambda: design.elastic_net(**options["elastic_net"]),
    }
    found = []
    for name in candidates:
        model = fits[name]()
        found += [(name, part, *design.r2(model, part)) for part in sorted(moments.raw)]
    return found
