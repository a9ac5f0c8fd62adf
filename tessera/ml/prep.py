"""Feature preparation estimators (inventory M1-M13).

Semantics follow the scikit-learn stages the reference uses:
imputation ignores missing values (NULL or NaN) when fitting and fills both;
standardisation uses the population standard deviation and leaves constant
columns unscaled; the power transform is Yeo-Johnson with lambda by maximum
likelihood, then standardised.
"""

from __future__ import annotations

import math
import os
from collections.abc import Sequence

import numpy as np
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter,
                             MLReader, MLWriter)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.ml.base import ColumnsEstimator, ColumnsModel, SelectColumns
from tessera.operators import stats as S
from tessera.operators.comoments import moments_by_column


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def _missing(df: DataFrame, c: str) -> Column:
    m = _q(c).isNull()
    if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
        m = m | F.isnan(_q(c))
    return m


def _present(df: DataFrame, c: str) -> Column:
    return F.when(~_missing(df, c), _q(c))


def _one_row(df: DataFrame, aggs: list) -> dict:
    """Run one aggregation (a single result row) and return it as a dict."""
    return df.agg(*aggs).collect()[0].asDict()


# ------------------------------------------------------------------ M1, M2
class ImputerModel(ColumnsModel):
    strategy = Param(Params._dummy(), "strategy", "mean | median | most_frequent", TypeConverters.toString)

    def _exprs(self, df, cols, state):
        wide = self.getOrDefault(self.strategy) in ("mean", "median")  # a mean of whole numbers is no whole number

        def kind(c):
            return T.DoubleType() if wide and isinstance(df.schema[c].dataType, T.IntegralType) else df.schema[c].dataType
        return {c: F.when(_missing(df, c), F.lit(state[c]).cast(kind(c))).otherwise(_q(c).cast(kind(c)))
                if state.get(c) is not None else _q(c) for c in cols}


class Imputer(ColumnsEstimator):
    """``SimpleImputer``: ``mean`` / ``median`` (exact, linear interpolation)
    for numbers, ``most_frequent`` (ties to the smallest value) for anything."""

    strategy = Param(Params._dummy(), "strategy", "mean | median | most_frequent", TypeConverters.toString)
    model_class = ImputerModel

    def __init__(self, inputCols=None, strategy="mean"):
        super().__init__(inputCols=inputCols, strategy=strategy)

    def _stats(self, df, cols):
        s = self.getOrDefault(self.strategy)
        if s == "mean":
            row = _one_row(df, [F.avg(_present(df, c)).alias(c) for c in cols])
            return {c: row[c] for c in cols}
        if s == "median":
            clean = df.select(*[_present(df, c).alias(c) for c in cols])
            qs = S.quantiles(clean, cols, (0.5,)).collect()
            out = {c: None for c in cols}
            out.update({r["column"]: r["value"] for r in qs})
            return out
        if s == "most_frequent":
            long = df.select(*[_present(df, c).cast("string").alias(c) for c in cols]).unpivot(
                [], list(cols), "column", "value").where(F.col("value").isNotNull())
            freq = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
            numeric = [c for c in cols if isinstance(df.schema[c].dataType, T.NumericType)]
            number = F.when(F.col("column").isin(numeric), F.col("value").try_cast("double"))  # of equal doubles the smaller text
            top = freq.groupBy("column").agg(
                F.min_by("value", F.struct(-F.col("n"), number, F.col("value"))).alias("top")).collect()
            out = {c: None for c in cols}
            for r in top:
                v = r["top"]
                dt = df.schema[r["column"]].dataType
                # a decimal keeps its text, which the cast to the column's type reads in full
                out[r["column"]] = int(v) if isinstance(dt, T.IntegralType) else float(v) if isinstance(dt, (T.DoubleType, T.FloatType)) else v
            return out
        raise ValueError(s)


# ------------------------------------------------------------------ M4
class StandardizerModel(ColumnsModel):
    def _exprs(self, df, cols, state):
        return {c: ((_q(c).cast("double") - F.lit(state[c][0])) / F.lit(state[c][1])) for c in cols}


class Standardizer(ColumnsEstimator):
    """scikit-learn ``StandardScaler``: centre on the mean, divide by the
    population sd; a zero sd is replaced by 1."""

    model_class = StandardizerModel

    def _stats(self, df, cols):
        row = _one_row(df, [F.avg(_present(df, c)).alias(f"m{i}") for i, c in enumerate(cols)] +
                       [F.stddev_pop(_present(df, c)).alias(f"s{i}") for i, c in enumerate(cols)])
        out = {}
        for i, c in enumerate(cols):
            sd = row[f"s{i}"]
            out[c] = [row[f"m{i}"] or 0.0, sd if sd else 1.0]
        return out


# ------------------------------------------------------------------ M6
class MinMaxModel(ColumnsModel):
    def _exprs(self, df, cols, state):
        out = {}
        for c in cols:
            lo, hi = state[c]
            rng = (hi - lo) if (hi is not None and lo is not None and hi != lo) else 1.0
            out[c] = (_q(c).cast("double") - F.lit(lo)) / F.lit(rng)
        return out


class MinMaxScaler(ColumnsEstimator):
    """Scale to [0, 1] with the fitted min and max (constant column -> 0)."""

    model_class = MinMaxModel

    def _stats(self, df, cols):
        row = _one_row(df, [F.min(_present(df, c)).alias(f"lo{i}") for i, c in enumerate(cols)] +
                       [F.max(_present(df, c)).alias(f"hi{i}") for i, c in enumerate(cols)])
        return {c: [row[f"lo{i}"], row[f"hi{i}"]] for i, c in enumerate(cols)}


# ------------------------------------------------------------------ M7, M8
def yeo_johnson(x: Column, lam: float) -> Column:
    """Yeo-Johnson transform of a column for a fixed lambda."""
    pos = F.log1p(x) if abs(lam) < 1e-12 else (F.pow(x + 1.0, lam) - 1.0) / lam
    neg = -F.log1p(-x) if abs(lam - 2.0) < 1e-12 else -(F.pow(1.0 - x, 2.0 - lam) - 1.0) / (2.0 - lam)
    return F.when(x >= 0, pos).otherwise(neg)


def _power_and_slope(size: np.ndarray, power: float) -> tuple[np.ndarray, np.ndarray]:
    """(exp(power * size) - 1) / power and its derivative by ``power``."""
    value = np.expm1(size * power) / power if power else size
    if abs(power) < 1e-5:
        return value, size * size / 2 + size * size * size * (power / 3)
    return value, (size * (1 + power * value) - value) / power


def yeo_johnson_points(lams: Sequence[float]):
    """Function of present values that gives, for each lambda, a column of the
    Yeo-Johnson transform and one of its derivative by lambda."""
    def make(x: np.ndarray) -> np.ndarray:
        size, up = np.log1p(np.abs(x)), x >= 0
        every = bool(up.all())
        out = np.empty((len(x), 2 * len(lams)))
        for k, lam in enumerate(lams):
            y, dy = _power_and_slope(size, lam)
            if not every:  # below 0 the power is 2 - lambda, and both signs of the transform turn
                z, dz = _power_and_slope(size, 2.0 - lam)
                y, dy = np.where(up, y, -z), np.where(up, dy, dz)
            out[:, 2 * k], out[:, 2 * k + 1] = y, dy
        return out
    return make


def fit_yeo_johnson(df: DataFrame, cols: Sequence[str], resolution: float = 1e-5, max_rounds: int = 100) -> dict:
    """Maximum-likelihood lambda per column, as the root of the derivative of
    the log-likelihood ``-n/2 log var(y) + (lambda-1) sum sign(x) log1p|x|``,
    which is ``-n cov(y, dy/dlambda) / var(y) + sum sign(x) log1p|x|``.

    A round evaluates the derivative at a few lambdas of every column - all in
    one pass that makes a matrix of moments per column -
    and keeps the two between which it changes sign: first on a fixed grid that
    moves outward fourfold while there is no such change, then around the point
    where the line between both ends meets zero. It ends when a bracket is
    ``resolution`` wide (relative to a lambda beyond 1). A column without
    variation keeps lambda 1; a column without values has none.
    """
    cols = list(cols)
    if not cols:
        return {}
    clean = df.select(*[F.nanvl(_q(c).cast("double"), F.lit(None)).alias(f"x{i}") for i, c in enumerate(cols)]).cache()
    try:
        x = [F.col(f"x{i}") for i in range(len(cols))]
        base = _one_row(clean, [F.count(c).alias(f"n{i}") for i, c in enumerate(x)] + [(F.max(c) > F.min(c)).alias(f"v{i}") for i, c in enumerate(x)]
                        + [F.avg(F.signum(c) * F.log1p(F.abs(c))).alias(f"l{i}") for i, c in enumerate(x)])
        best = {i: 1.0 for i in range(len(cols)) if base[f"n{i}"]}
        points = {i: [-2.0, 0.0, 1.0, 2.0, 4.0] for i in best if base[f"v{i}"]}
        ends: dict[int, list] = {i: [(-math.inf, math.inf), (math.inf, -math.inf)] for i in points}  # (lambda, slope)
        for _ in range(max_rounds):
            if not points:
                break
            most = max(map(len, points.values()))
            # a transform beyond the range of doubles gives no number: the lambda is too far out
            held = moments_by_column(clean, {i: yeo_johnson_points([*lams, *lams[-1:] * (most - len(lams))]) for i, lams in points.items()}, 2 * most)
            for i, lams in list(points.items()):
                for k, lam in enumerate(lams):
                    n, c = held[i].n, held[i].c
                    var, cov = float(c[2 * k, 2 * k] / n), float(c[2 * k, 2 * k + 1] / n)
                    usable = 0 < var < math.inf and math.isfinite(cov)
                    slope = base[f"l{i}"] - cov / var if usable else math.copysign(math.inf, 1 - lam)
                    low, high = ends[i]
                    if slope >= 0 and lam > low[0]:
                        ends[i][0] = (lam, slope)
                    if slope <= 0 and lam < high[0]:
                        ends[i][1] = (lam, slope)
                (a, fa), (b, fb) = ends[i]
                if math.isinf(a) or math.isinf(b):  # no change of sign yet
                    edge = b if math.isinf(a) else a
                    step = -max(4.0, 3 * abs(edge)) if math.isinf(a) else max(4.0, 3 * abs(edge))
                    points[i] = [edge + step, edge + 4 * step]
                    continue
                middle = (a + b) / 2
                guess = (a * fb - b * fa) / (fb - fa) if math.isfinite(fa) and math.isfinite(fb) and fb != fa else middle
                best[i] = guess
                if b - a <= resolution * max(1.0, abs(guess)):
                    del points[i]
                    continue
                near = max((b - a) / 50, resolution / 4)
                points[i] = sorted({p for p in (guess - near, guess, guess + near, middle) if a < p < b})
                if not points[i]:
                    del points[i]
        return {cols[i]: float(lam) for i, lam in best.items()}
    finally:
        clean.unpersist()


class PowerTransformerModel(ColumnsModel):
    def _exprs(self, df, cols, state):
        out = {}
        for c in cols:
            if c not in state:
                continue
            lam, mean, sd = state[c]
            out[c] = (yeo_johnson(_q(c).cast("double"), lam) - F.lit(mean)) / F.lit(sd)
        return out


def _standardise_after(df, lambdas: dict) -> dict:
    if not lambdas:
        return {}
    cols = list(lambdas)
    clean = df.select(*[_present(df, c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    held = moments_by_column(clean, {i: yeo_johnson_points([lambdas[c]]) for i, c in enumerate(cols)}, 2)
    sds = {i: float(np.sqrt(m.c[0, 0] / m.n)) for i, m in held.items()}
    return {c: [lambdas[c], float(held[i].mean[0]) if i in held else 0.0, sds.get(i) or 1.0] for i, c in enumerate(cols)}


class PowerTransformer(ColumnsEstimator):
    """scikit-learn ``PowerTransformer()``: Yeo-Johnson, then standardised (M7)."""

    model_class = PowerTransformerModel

    def _stats(self, df, cols):
        return _standardise_after(df, fit_yeo_johnson(df, cols))


class ConditionalSymmetrizer(ColumnsEstimator):
    """Power-transform only the columns whose |skewness| exceeds ``threshold``
    (M8). The skewness and the lambdas are fixed at fit time (the reference
    recomputes them on every transform)."""

    threshold = Param(Params._dummy(), "threshold", "skewness threshold", TypeConverters.toFloat)
    model_class = PowerTransformerModel

    def __init__(self, inputCols=None, threshold=0.5):
        super().__init__(inputCols=inputCols, threshold=threshold)

    def _stats(self, df, cols):
        t = self.getOrDefault(self.threshold)
        skews = {r["column"]: r["skew"] for r in S.skewness(df, cols).collect()}
        chosen = [c for c in cols if skews.get(c) is not None and abs(skews[c]) > t]
        return _standardise_after(df, fit_yeo_johnson(df, chosen)) if chosen else {}


# ------------------------------------------------------------------ M9, M10
class OneHotEncoder(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """One 0/1 DOUBLE column per category in a fixed order, optionally without
    the first category (M9). A value outside the categories is an error, as
    with scikit-learn's default; NULL is an error too."""

    inputCol = Param(Params._dummy(), "inputCol", "column", TypeConverters.toString)
    categories = Param(Params._dummy(), "categories", "ordered categories", TypeConverters.toListString)
    dropFirst = Param(Params._dummy(), "dropFirst", "drop the first category", TypeConverters.toBoolean)

    def __init__(self, inputCol=None, categories=None, dropFirst=True):
        super().__init__()
        self._set(inputCol=inputCol, categories=categories, dropFirst=dropFirst)

    def _transform(self, df):
        c = self.getOrDefault(self.inputCol)
        cats = self.getOrDefault(self.categories)
        keep = cats[1:] if self.getOrDefault(self.dropFirst) else cats
        x = _q(c)
        checked = F.when(x.isin(*cats), x).otherwise(
            F.raise_error(F.concat(F.lit(f"unknown category in {c}: "), F.coalesce(x.cast("string"), F.lit("NULL")))))
        out = df.withColumn(c, checked)
        out = out.withColumns({f"{c}_{v}": (_q(c) == F.lit(v)).cast("double") for v in keep})
        return out.drop(c)


class OrdinalEncoder(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Category -> its position (0, 1, ...) in a fixed order, as DOUBLE."""

    inputCols = Param(Params._dummy(), "inputCols", "columns", TypeConverters.toListString)
    categories = Param(Params._dummy(), "categories", "ordered categories", TypeConverters.toListString)

    def __init__(self, inputCols=None, categories=None):
        super().__init__()
        self._set(inputCols=inputCols, categories=categories)

    def _transform(self, df):
        cats = self.getOrDefault(self.categories)
        out = {}
        for c in self.getOrDefault(self.inputCols):
            e = F.raise_error(F.concat(F.lit(f"unknown category in {c}: "), F.coalesce(_q(c).cast("string"), F.lit("NULL"))))
            for i, v in reversed(list(enumerate(cats))):
                e = F.when(_q(c) == F.lit(v), F.lit(float(i))).otherwise(e)
            out[c] = e
        return df.withColumns(out)


# ------------------------------------------------------------------ M11
def uniform_edges(lo: float, hi: float, bins: int) -> list[float]:
    return list(np.linspace(lo, hi, bins + 1))


def _passed(x: Column, edges: list[float]) -> Column:
    """Number of edges that are <= x (numpy digitize, right=False)."""
    return F.size(F.filter(F.lit(edges), lambda e: x >= e)).cast("double")


class BinnerModel(ColumnsModel):
    def _exprs(self, df, cols, state):
        out = {}
        for c in cols:
            edges = state[c]
            x = F.nanvl(_q(c).cast("double"), F.lit(None))
            if edges is None:  # no value at the fit
                out[c] = F.lit(None).cast("double")
                continue
            b = _passed(x, edges[1:-1])
            out[c] = F.when(x.isNotNull(), b)
        return out


class UniformBinner(ColumnsEstimator):
    """``KBinsDiscretizer(n_bins, strategy='uniform', encode='ordinal')``.
    A missing value (NULL or NaN) has no bin, nor has any value of a column
    that was all missing at the fit."""

    numBins = Param(Params._dummy(), "numBins", "number of bins", TypeConverters.toInt)
    model_class = BinnerModel

    def __init__(self, inputCols=None, numBins=20):
        super().__init__(inputCols=inputCols, numBins=numBins)

    def _stats(self, df, cols):
        k = self.getOrDefault(self.numBins)
        row = _one_row(df, [F.min(_present(df, c)).alias(f"lo{i}") for i, c in enumerate(cols)] +
                       [F.max(_present(df, c)).alias(f"hi{i}") for i, c in enumerate(cols)])
        return {c: None if row[f"lo{i}"] is None else uniform_edges(float(row[f"lo{i}"]), float(row[f"hi{i}"]), k) for i, c in enumerate(cols)}


# ------------------------------------------------------------------ M12
def chi2_scores(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """scikit-learn ``chi2``: per feature, sum over classes of (O-E)^2/E with
    O = feature total in the class, E = class share x feature total.
    One grouped aggregation by class (partial, tiny output)."""
    per_class = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"),
                                      *[F.sum(_q(c).cast("double")).alias(c) for c in cols])
    w = _all()
    tot = per_class.select("n_c", *[_q(c) for c in cols], F.sum("n_c").over(w).alias("__n"),
                           *[F.sum(_q(c)).over(w).alias(f"__t{i}") for i, c in enumerate(cols)])
    out = []
    for i, c in enumerate(cols):
        exp = F.col("n_c") / F.col("__n") * F.col(f"__t{i}")
        out.append(F.struct(F.lit(c).alias("column"), F.try_divide(F.pow(_q(c) - exp, 2), exp).alias("part")))
    long = tot.select(F.explode(F.array(*out)).alias("x")).select("x.*")
    return long.groupBy("column").agg(F.sum("part").alias("chi2"))


def _all():
    from pyspark.sql import Window
    return Window.partitionBy()


class ChiSquareSelector(ColumnsEstimator):
    """``SelectKBest(chi2, k)``: keep the ``k`` features with the largest
    score (ties to the earlier column), drop the others (M12)."""

    k = Param(Params._dummy(), "k", "features to keep", TypeConverters.toInt)
    labelCol = Param(Params._dummy(), "labelCol", "class label", TypeConverters.toString)
    model_class = None

    def __init__(self, inputCols=None, k=5, labelCol="label"):
        super().__init__(inputCols=inputCols, k=k, labelCol=labelCol)

    def _fit(self, df):
        cols = self.getInputCols()
        scores = {r["column"]: r["chi2"] for r in chi2_scores(df, cols, self.getOrDefault(self.labelCol)).collect()}
        order = sorted(cols, key=lambda c: (-(scores[c] if scores[c] is not None else -1), cols.index(c)))
        keep = set(order[: self.getOrDefault(self.k)])
        return SelectColumns(drop=[c for c in cols if c not in keep])


# ------------------------------------------------------------------ M13
class PCAModel(ColumnsModel):
    def _transform(self, df):
        st = self.getState()
        cols, mean, comps = self.getInputCols(), st["mean"], st["components"]
        outs = {}
        for j, w in enumerate(comps):
            e = F.lit(0.0)
            for c, m, wc in zip(cols, mean, w):
                e = e + (_q(c).cast("double") - F.lit(m)) * F.lit(wc)
            outs[f"pc_{j + 1}"] = e
        return df.withColumns(outs).drop(*cols)


class VariancePCA(ColumnsEstimator):
    """``PCA(n_components=share)``: the fewest components whose cumulative
    explained variance is strictly above ``share`` (M13). Fitted with
    ``ml.feature.PCA`` (distributed covariance, d x d on the driver, d =
    number of inputs); signs fixed so the largest loading of each component
    is positive; output is centred, like scikit-learn."""

    share = Param(Params._dummy(), "share", "variance share", TypeConverters.toFloat)
    model_class = PCAModel

    def __init__(self, inputCols=None, share=0.8):
        super().__init__(inputCols=inputCols, share=share)

    def _stats(self, df, cols):
        from pyspark.ml.feature import PCA, VectorAssembler
        d = len(cols)
        vec = VectorAssembler(inputCols=cols, outputCol="__v", handleInvalid="skip").transform(df.select(*cols))
        pca = PCA(k=d, inputCol="__v", outputCol="__p").fit(vec)
        ev = pca.explainedVariance.toArray()
        cum = np.cumsum(ev)
        k = int(np.searchsorted(cum, self.getOrDefault(self.share), side="right") + 1)
        k = min(k, d)
        pc = np.array(pca.pc.toArray()[:, :k].T, copy=True)
        for row in pc:
            if row[np.argmax(np.abs(row))] < 0:
                row *= -1
        means = _one_row(df, [F.avg(_q(c).cast("double")).alias(c) for c in cols])
        return {"mean": [means[c] for c in cols], "components": pc.tolist(), "explained": ev[:k].tolist()}


# ------------------------------------------------------------------ M3
class KNNImputerModel(ColumnsModel):
    idCol = Param(Params._dummy(), "idCol", "unique row key", TypeConverters.toString)
    k = Param(Params._dummy(), "k", "neighbours", TypeConverters.toInt)
    blockRows = Param(Params._dummy(), "blockRows", "rows per block", TypeConverters.toInt)

    def _transform(self, df):
        from tessera.ml.knn import knn_impute
        st = self.getState()
        return knn_impute(df, st["donors_path"], self.getInputCols(), self.getOrDefault(self.idCol),
                          self.getOrDefault(self.k), st["means"], self.getOrDefault(self.blockRows))

    def write(self) -> MLWriter:
        return _KNNWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _KNNReader()


class _KNNWriter(MLWriter):
    """Saves the donors with the model, so that it outlives the scratch folder."""

    def __init__(self, instance: KNNImputerModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.sparkSession.read.parquet(self.instance.getState()["donors_path"]).write.parquet(os.path.join(path, "donors"))


class _KNNReader(MLReader):
    def load(self, path: str) -> KNNImputerModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = KNNImputerModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        model._set_state({**model.getState(), "donors_path": os.path.join(path, "donors")})
        return model


class KNNImputer(ColumnsEstimator):
    """``KNNImputer(n_neighbors=k, weights='distance')`` (M3), exact.

    Fitting stores the donor rows (the fit data) as a table in the shared
    checkpoint folder plus the column means (the fallback when no donor
    shares a coordinate). Transforming runs the search of
    :mod:`tessera.ml.knn`: a receiver meets only the blocks of donors whose
    box comes as near as its k-th distance so far.
    """

    idCol = Param(Params._dummy(), "idCol", "unique row key", TypeConverters.toString)
    k = Param(Params._dummy(), "k", "neighbours", TypeConverters.toInt)
    blockRows = Param(Params._dummy(), "blockRows", "rows per block", TypeConverters.toInt)
    model_class = KNNImputerModel

    def __init__(self, inputCols=None, idCol="id", k=5, blockRows=5000):
        super().__init__(inputCols=inputCols, idCol=idCol, k=k, blockRows=blockRows)

    def _stats(self, df, cols):
        import uuid

        from tessera.session import scratch_path
        path = scratch_path(df.sparkSession, f"knn-donors-{uuid.uuid4().hex[:12]}")
        df.select(*[_present(df, c).cast("double").alias(c) for c in cols]).write.mode("overwrite").parquet(path)
        row = _one_row(df, [F.avg(_present(df, c)).alias(c) for c in cols])
        return {"donors_path": path, "means": {c: row[c] for c in cols}}
