"""Text classification and regularised regression on Spark ML (inventory
M17-M36).

* Splits and folds come from a hash of a row key (stable under any
  partitioning or file layout) and the global index (W4) for equal folds;
* regression fits and scores on any parts of the rows come from one pass that
  makes a small matrix of moments per part; classification is scored by an
  aggregation of confusion counts, never a collect of predictions;
* the result tables are long-form DataFrames built from bounded numbers
  (scores, coefficients).
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import (CountVectorizer, PolynomialExpansion, StandardScaler, StopWordsRemover,
                                StringIndexer, Tokenizer, VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.stopwords import ENGLISH
from tessera.ml.prep import Standardizer
from tessera.operators.comoments import Moments, moments_by_cell
from tessera.operators.windows import global_index


def _q(c):
    return F.col(f"`{c}`")


def _uniq(*groups) -> list[str]:
    """Column names of several lists, each once, in first-seen order."""
    out = []
    for g in groups:
        for c in ([g] if isinstance(g, str) else g):
            if c not in out:
                out.append(c)
    return out


# ------------------------------------------------------------------ M17
def index_labels(df: DataFrame, inputCol: str, outputCol: str = "target"):
    """``StringIndexer``: most frequent first, ties alphabetical. Returns the
    fitted model and the indexed frame."""
    model = StringIndexer(inputCol=inputCol, outputCol=outputCol, stringOrderType="frequencyDesc").fit(df)
    return model, model.transform(df)


# ------------------------------------------------------------------ M21
def key_hash(keys: Sequence[str], seed: int = 0) -> Column:
    """First 8 hex digits of the MD5 of the key's columns and the seed, joined
    by ``|`` (a NULL is an empty field): the same in any engine."""
    text = F.concat_ws("|", *[F.coalesce(_q(k).cast("string"), F.lit("")) for k in keys], F.lit(str(seed)))
    return F.substring(F.md5(text.cast("binary")), 1, 8)


def hash_fraction(keys: Sequence[str], seed: int = 0) -> Column:
    """A number in [0, 1) from a hash of the row key: stable across runs,
    partitionings and file layouts."""
    return F.conv(key_hash(keys, seed), 16, 10).cast("double") / 4294967296.0


def hash_split(df: DataFrame, keys: Sequence[str], test_fraction: float = 0.2, seed: int = 0):
    """(train, test) by hashed key (M21); ``df.randomSplit`` is the option
    when no key exists."""
    u = hash_fraction(keys, seed)
    return df.where(u >= test_fraction), df.where(u < test_fraction)


# ------------------------------------------------------------------ M28
def assign_folds(df: DataFrame, keys: Sequence[str], k: int = 5, seed: int = 0,
                 fold_col: str = "fold", rank_col: str = "__rank") -> DataFrame:
    """Equal-sized folds: rank rows by (hash, key) with the global index and
    take the rank modulo ``k``. Keeps the rank for learning-curve prefixes."""
    h = key_hash(keys, seed)
    # order by the hash, the keys, then every other column: rows tied on all
    # of them are identical, so a recomputation gives the same folds
    order = ["__h", *_uniq(keys, df.columns)]
    ranked = global_index(df.withColumn("__h", h), order, out=rank_col, start=0).drop("__h")
    return ranked.withColumn(fold_col, (F.col(rank_col) % k).cast("int"))


# ------------------------------------------------------------------ M18-M20, M5, M22
VOCABULARY_LIMIT = 1 << 24


def whole_vocabulary(model, limit: int = VOCABULARY_LIMIT) -> int:
    """Number of terms of a fitted pipeline's term counter. Terms beyond the
    counter's limit would vanish, so a full vocabulary is an error."""
    n = max(len(s.vocabulary) for s in model.stages if hasattr(s, "vocabulary"))
    if n >= limit:
        raise ValueError(f"the vocabulary reached its limit of {limit} terms; raise vocabulary_limit")
    return n


def text_pipeline(inputCol: str, labelCol: str = "target", model=None,
                  stop_words: Sequence[str] = ENGLISH, vocabulary_limit: int = VOCABULARY_LIMIT) -> Pipeline:
    """Tokenise, drop stop words, count terms, scale to unit sd, classify.
    :func:`whole_vocabulary` fails on a fitted pipeline that met the limit."""
    return Pipeline(stages=[
        Tokenizer(inputCol=inputCol, outputCol="tokens"),
        StopWordsRemover(inputCol="tokens", outputCol="filtered_tokens", stopWords=list(stop_words)),
        CountVectorizer(inputCol="filtered_tokens", outputCol="counter_features", vocabSize=vocabulary_limit),
        StandardScaler(inputCol="counter_features", outputCol="scaled_features"),
        model or LogisticRegression(featuresCol="scaled_features", labelCol=labelCol),
    ])


# ------------------------------------------------------------------ M23
def classification_metrics(pred: DataFrame, label: str = "target", prediction: str = "prediction",
                           digits: int = 4) -> DataFrame:
    """One row ``(accuracy, f1)``: accuracy and label-frequency-weighted F1
    (the Spark evaluator's ``f1``), from one confusion-count aggregation."""
    conf = pred.groupBy(F.col(label).alias("y"), F.col(prediction).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    tp = conf.where(F.col("y") == F.col("p")).select(F.col("y").alias("c"), F.col("n").alias("tp"))
    sup = conf.groupBy(F.col("y").alias("c")).agg(F.sum("n").alias("support"))
    predn = conf.groupBy(F.col("p").alias("c")).agg(F.sum("n").alias("predicted"))
    per = sup.join(predn, "c", "full").join(tp, "c", "left").fillna(0, ["tp", "support", "predicted"])
    f1 = F.when(F.col("support") + F.col("predicted") > 0,
                2 * F.col("tp") / (F.col("support") + F.col("predicted"))).otherwise(F.lit(0.0))
    return per.agg((F.sum("tp") / F.sum("support")).alias("accuracy"),
                   (F.sum(F.col("support") * f1) / F.sum("support")).alias("f1")).select(
        F.round("accuracy", digits).alias("accuracy"), F.round("f1", digits).alias("f1"))


def evaluator_metrics(pred: DataFrame, label: str = "target", prediction: str = "prediction") -> dict:
    """The same two numbers from ``MulticlassClassificationEvaluator``."""
    return {m: round(MulticlassClassificationEvaluator(labelCol=label, predictionCol=prediction,
                                                       metricName=m).evaluate(pred), 4)
            for m in ("accuracy", "f1")}


# ------------------------------------------------------------------ M24
def compare_text_fields(train: DataFrame, test: DataFrame, text_cols: Sequence[str],
                        label: str = "target") -> DataFrame:
    """Fit the text pipeline once per text column; long form
    ``(field, split, accuracy, f1)``."""
    out = None
    for col in text_cols:
        model = text_pipeline(col, label).fit(train)
        whole_vocabulary(model)
        for split, frame in (("train", train), ("test", test)):
            m = classification_metrics(model.transform(frame), label).select(
                F.lit(col).alias("field"), F.lit(split).alias("split"), "accuracy", "f1")
            out = m if out is None else out.unionByName(m)
    return out


# ------------------------------------------------------------------ M25, M29
def assemble(df: DataFrame, features: Sequence[str], out: str = "features", degree: int = 1) -> DataFrame:
    v = VectorAssembler(inputCols=list(features), outputCol=out if degree == 1 else "__raw",
                        handleInvalid="skip").transform(df)
    if degree > 1:
        v = PolynomialExpansion(degree=degree, inputCol="__raw", outputCol=out).transform(v).drop("__raw")
    return v


def polynomial_features(df: DataFrame, features: Sequence[str], degree: int = 2, include_bias: bool = False,
                        prefix: str = "poly") -> DataFrame:
    """``PolynomialFeatures`` (M29) as plain columns: Spark's expansion (its
    own term order), plus a constant 1 column when ``include_bias``."""
    v = assemble(df.select(*features), features, "__p", degree)
    arr = vector_to_array("__p")
    n = len(v.select("__p").schema["__p"].metadata.get("ml_attr", {}).get("attrs", {}).get("numeric", [])) or None
    cols = v.select(arr.alias("__a"))
    size = n or _poly_size(len(features), degree)
    out = cols.select(*[F.col("__a")[i].alias(f"{prefix}_{i}") for i in range(size)])
    return out.withColumn(f"{prefix}_bias", F.lit(1.0)) if include_bias else out


def _poly_size(d: int, degree: int) -> int:
    from math import comb
    return comb(d + degree, degree) - 1


def linear_regression(reg_param: float = 0.0, elastic_net: float = 0.0, solver: str = "normal") -> LinearRegression:
    """OLS (M25) when ``reg_param`` is 0; features are standardised by the
    caller, so ``standardization`` is off."""
    return LinearRegression(featuresCol="features", labelCol="label", regParam=reg_param,
                            elasticNetParam=elastic_net, solver=solver, standardization=False,
                            maxIter=1000, tol=1e-10)


# ------------------------------------------------------------------ M26
def r2_score(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> Column:
    """Aggregate expression ``1 - SSE/SST`` (centred sums; NULL for a constant label)."""
    y, p = F.col(label).cast("double"), F.col(prediction)
    return F.lit(1.0) - F.try_divide(F.sum((y - p) ** 2), F.var_pop(y) * F.count(y))


def gap(train_r2: float | None, test_r2: float | None) -> float | None:
    """1 - test / train; None where a score is undefined or training's is 0."""
    return 1 - test_r2 / train_r2 if train_r2 and test_r2 is not None else None


# ------------------------------------------------------------------ fold engine
@dataclass(frozen=True)
class Penalty:
    """Objective 1/(2n) SSE + ``l1`` |w| + (``l2`` + ``total_l2`` / n) / 2 |w|^2
    on standardised features; all 0 is least squares."""

    l1: float = 0.0
    l2: float = 0.0
    total_l2: float = 0.0


def ridge(alpha: float) -> Penalty:
    """scikit-learn ``Ridge(alpha)``."""
    return Penalty(total_l2=alpha)


def elastic_net(alpha: float, l1_ratio: float = 1.0) -> Penalty:
    """scikit-learn ``ElasticNet(alpha, l1_ratio)``; ratio 1 is ``Lasso(alpha)``."""
    return Penalty(l1=alpha * l1_ratio, l2=alpha * (1 - l1_ratio))


def solve(gram: np.ndarray, target: np.ndarray, n: float, penalty: Penalty) -> np.ndarray:
    """Weights from the mean products of the centred features (``gram``) and of
    these with the centred label (``target``): a linear system, or coordinate
    descent on the Gram matrix where there is an L1 part."""
    weight = penalty.l2 + penalty.total_l2 / n
    if not penalty.l1:
        return np.linalg.lstsq(gram + weight * np.eye(len(gram)), target, rcond=1e-13)[0]
    w = np.zeros(len(target))
    for _ in range(100_000):
        step = 0.0
        for j in range(len(w)):
            curve = gram[j, j] + weight
            if not curve:
                continue
            pull = target[j] - gram[j] @ w + gram[j, j] * w[j]
            new = np.sign(pull) * max(abs(pull) - penalty.l1, 0.0) / curve
            step, w[j] = max(step, abs(new - w[j]) * np.sqrt(curve)), new
        if step <= 1e-13 * max(1.0, float(np.abs(target).max())):
            break
    return w


def monomials(d: int, degree: int) -> list[tuple[int, ...]]:
    """Exponents of all products of ``d`` features up to ``degree``, the features first."""
    found = [e for e in itertools.product(range(degree + 1), repeat=d) if 0 < sum(e) <= degree]
    return sorted(found, key=lambda e: (sum(e), tuple(-x for x in e)))


def _powers(degree: int, d: int, centre: np.ndarray, scale: np.ndarray):
    """Function of a row matrix (features, label) that gives the monomials of
    the scaled features and the label."""
    exponents = np.array(monomials(d, degree))

    def expand(x: np.ndarray) -> np.ndarray:
        z = (x[:, :d] - centre) / scale
        return np.column_stack([*(np.prod(z ** e, axis=1) for e in exponents), x[:, d]])
    return expand, len(exponents) + 1


def _shifted_basis(d: int, degree: int, centre: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Matrix and constants that turn monomials of x into those of (x - centre) / scale."""
    exponents = monomials(d, degree)
    place = {e: i for i, e in enumerate(exponents)}
    matrix, constant = np.zeros((len(exponents), len(exponents))), np.zeros(len(exponents))
    for row, e in enumerate(exponents):
        for lower in itertools.product(*(range(x + 1) for x in e)):
            c = math.prod(math.comb(x, k) * (-centre[j]) ** (x - k) / scale[j] ** x for j, (x, k) in enumerate(zip(e, lower)))
            if lower in place:
                matrix[row, place[lower]] += c
            else:
                constant[row] += c
    return matrix, constant


@dataclass
class FoldFit:
    """Result of one fit: weights of the standardised features (or of their
    monomials), intercept, and R^2 on both parts - None where a part is empty
    or its label constant."""

    r2_train: float | None
    r2_test: float | None
    weights: np.ndarray
    intercept: float


class CellMoments:
    """Moments of (features, label) per cell of the rows: everything that fits
    and scores on unions of cells need, from one pass over the data.

    Cells are disjoint parts of the rows (folds, ranges of a split number);
    a training part is the merged moments of its cells. Features are
    standardised with the training part's own statistics - a linear map of the
    moments, also for polynomials, whose monomials are expanded anew. Rows with
    a NULL or NaN in a feature or the label take no part.
    """

    def __init__(self, frame: DataFrame, features: Sequence[str], label: str, cell: str, degree: int = 1):
        self.features, self.degree, d = list(features), degree, len(features)
        columns = [*features, label]
        if degree == 1:
            self.cells = moments_by_cell(frame, columns, cell)
        else:  # monomials of features near 0 and 1, for their sums to keep their digits
            scale = frame.select(*[F.avg(F.nanvl(_q(c).cast("double"), F.lit(None))).alias(f"m{i}") for i, c in enumerate(features)],
                                 *[F.stddev_pop(F.nanvl(_q(c).cast("double"), F.lit(None))).alias(f"s{i}") for i, c in enumerate(features)]).first()
            expand, width = _powers(degree, d, np.array([scale[f"m{i}"] or 0.0 for i in range(d)]),
                                    np.array([scale[f"s{i}"] or 1.0 for i in range(d)]))
            self.cells = moments_by_cell(frame, columns, cell, expand, width)

    def part(self, cells) -> Moments | None:
        found = [self.cells[c] for c in cells if c in self.cells]
        return functools.reduce(Moments.merged, found) if found else None

    def fit(self, train, test, penalty: Penalty = Penalty(), features: Sequence[str] | None = None) -> FoldFit:
        """Fit on the cells ``train``, score on these and on the cells ``test``;
        with ``features``, some of them only (degree 1)."""
        own, other = self.part(train), self.part(test)
        d, last = len(self.features), [-1]
        if own is None or not own.n:
            return FoldFit(None, None, np.zeros(0), math.nan)
        if features is not None:
            index = [self.features.index(c) for c in features] + [d]
            own, other, d = own.at(index), other and other.at(index), len(features)
        sd = np.sqrt(np.diag(own.c)[:d] / own.n)
        sd[sd <= 1e-12 * np.maximum(np.abs(own.mean[:d]), 1e-300)] = 1.0  # constant features are not scaled
        matrix, constant = _shifted_basis(d, self.degree, own.mean[:d], sd)
        whole = np.zeros((len(matrix) + 1, len(matrix) + 1))
        whole[:-1, :-1], whole[-1, -1] = matrix, 1.0
        own = own.mapped(whole, np.append(constant, 0.0))
        other = other and other.mapped(whole, np.append(constant, 0.0))
        w = solve(own.c[:-1, :-1] / own.n, own.c[:-1, last].ravel() / own.n, own.n, penalty)
        intercept = float(own.mean[-1] - own.mean[:-1] @ w)
        return FoldFit(self._r2(own, w, intercept), self._r2(other, w, intercept), w, intercept)

    @staticmethod
    def _r2(m: Moments | None, w: np.ndarray, intercept: float) -> float | None:
        if m is None or not m.n or m.c[-1, -1] <= 1e-14 * m.n * m.mean[-1] ** 2:
            return None
        off = m.mean[-1] - intercept - m.mean[:-1] @ w
        error = m.c[-1, -1] - 2 * w @ m.c[:-1, -1] + w @ m.c[:-1, :-1] @ w + m.n * off * off
        return float(1.0 - error / m.c[-1, -1])


def _mean(scores: Sequence[float | None]) -> float | None:
    """Mean of the scores that are defined."""
    known = [s for s in scores if s is not None]
    return sum(known) / len(known) if known else None


def _folds(k: int) -> list[tuple[list[int], list[int]]]:
    """(training cells, test cells) of each of ``k`` folds."""
    return [([c for c in range(k) if c != i], [i]) for i in range(k)]


def ridge_factory(alpha: float):
    """scikit-learn ``Ridge(alpha)`` on standardised features: Spark
    ``regParam = alpha * sd(y) / n`` with the population sd of the training label."""
    return lambda n, sd_y: linear_regression(alpha * sd_y / n, 0.0)


def lasso_factory(alpha: float):
    """scikit-learn ``Lasso(alpha)``: ``regParam = alpha``, pure L1."""
    return lambda n, sd_y: linear_regression(alpha, 1.0)


def elastic_net_factory(alpha: float, l1_ratio: float):
    """scikit-learn ``ElasticNet(alpha, l1_ratio)``: L1 = alpha*r,
    L2 = alpha*(1-r)*sd(y); ``regParam = L1 + L2``, mixing = L1 / regParam."""
    def make(n, sd_y):
        l1, l2 = alpha * l1_ratio, alpha * (1 - l1_ratio) * sd_y
        reg = l1 + l2
        return linear_regression(reg, (l1 / reg) if reg else 0.0)
    return make


def _prepare(train: DataFrame, test: DataFrame, features: Sequence[str], label: str, degree: int = 1):
    """Standardise on the training rows only, then assemble ``features``
    (and the label as ``label``) - for single fits outside the fold engine."""
    sc = Standardizer(inputCols=list(features)).fit(train)

    def prep(frame):
        f = sc.transform(frame.select(*features, F.col(label).cast("double").alias("label")))
        return assemble(f, features, "features", degree)
    return prep(train), prep(test)


# ------------------------------------------------------------------ M27
def holdout_evaluation(df: DataFrame, features: Sequence[str], label: str, keys: Sequence[str],
                       test_sizes: Sequence[float] = (0.2, 0.3), seed: int = 0, penalty: Penalty = Penalty()) -> DataFrame:
    """R^2 train / test and gap for each hold-out size (long form); all sizes
    come from one pass: a cell is a range of the split number between two sizes."""
    cuts, u = sorted(set(test_sizes)), hash_fraction(keys, seed)
    cell = sum((u >= c).cast("int") for c in cuts)
    held = CellMoments(df.select(*features, label, cell.alias("__cell")), features, label, "__cell")
    rows = []
    for size in test_sizes:
        below = cuts.index(size)
        f = held.fit(range(below + 1, len(cuts) + 1), range(below + 1), penalty)
        rows.append((float(size), f.r2_train, f.r2_test, gap(f.r2_train, f.r2_test)))
    return df.sparkSession.createDataFrame(rows, "test_size double, r2_train double, r2_test double, gap double")


# ------------------------------------------------------------------ M28
def fold_moments(df: DataFrame, features: Sequence[str], label: str, keys: Sequence[str], k: int = 5, seed: int = 0,
                 degree: int = 1) -> CellMoments:
    """Moments per fold, for any number of cross-validations on these folds."""
    folded = assign_folds(df.select(*_uniq(keys, features, label)), keys, k, seed)
    return CellMoments(folded, features, label, "fold", degree)


def cross_validate(df: DataFrame, features: Sequence[str], label: str, keys: Sequence[str], k: int = 5,
                   seed: int = 0, penalty: Penalty = Penalty(), degree: int = 1) -> DataFrame:
    """k-fold CV with the scaler refit on each training part; one row per
    fold ``(fold, r2_train, r2_test)``; NULL for a constant label."""
    held = fold_moments(df, features, label, keys, k, seed, degree)
    fits = [held.fit(tr, te, penalty) for tr, te in _folds(k)]
    return df.sparkSession.createDataFrame([(i, f.r2_train, f.r2_test) for i, f in enumerate(fits)],
                                           "fold int, r2_train double, r2_test double")


def cv_summary(folds: DataFrame) -> DataFrame:
    """Mean train / test R^2 and gap ``1 - test/train`` (evaluate_cv)."""
    return folds.agg(F.avg("r2_train").alias("mean_train"), F.avg("r2_test").alias("mean_test")).withColumn(
        "gap", F.lit(1.0) - F.try_divide(F.col("mean_test"), F.col("mean_train")))


def _scores(held: CellMoments, k: int, penalty: Penalty = Penalty(), features: Sequence[str] | None = None):
    """(mean train, mean test, gap) over the folds."""
    fits = [held.fit(tr, te, penalty, features) for tr, te in _folds(k)]
    train, test = _mean([f.r2_train for f in fits]), _mean([f.r2_test for f in fits])
    return train, test, gap(train, test)


# ------------------------------------------------------------------ M30, M31
def regularization_sweep(df: DataFrame, features: Sequence[str], label: str, keys: Sequence[str],
                         candidates: Sequence[tuple[str, Penalty]], k: int = 5, seed: int = 0,
                         base_train: float | None = None, base_test: float | None = None,
                         tolerance: float = 0.05) -> DataFrame:
    """Cross-validate each candidate ``(name, penalty)``; flag the chosen one
    by the reference rule: accepted when both mean scores are within
    ``tolerance`` of the unregularised ones and the gap beats the best so far;
    without a baseline every candidate is accepted, so the last wins. A
    candidate without scores (constant label) has NULLs and is never chosen.
    All candidates share one pass over the data."""
    held = fold_moments(df, features, label, keys, k, seed)
    rows, best, best_gap = [], None, None
    for name, penalty in candidates:
        mt, ms, g = _scores(held, k, penalty)
        ok = g is not None and (base_train is None or base_test is None or
                                (mt >= base_train - tolerance and ms >= base_test - tolerance and
                                 (best_gap is None or g < best_gap)))
        if ok:
            best, best_gap = name, g
        rows.append((name, mt, ms, g))
    out = df.sparkSession.createDataFrame(rows, "candidate string, mean_train double, mean_test double, gap double")
    return out.withColumn("chosen", F.col("candidate").eqNullSafe(F.lit(best)))


def ridge_lasso_candidates(kind: str, alphas: Sequence[float]):
    make = {"ridge": ridge, "lasso": elastic_net}[kind]
    return [(f"{kind} alpha={a:g}", make(a)) for a in alphas]


def elastic_net_candidates(alphas: Sequence[float], l1_ratios: Sequence[float]):
    return [(f"elasticnet alpha={a:g} l1_ratio={r:g}", elastic_net(a, r)) for a in alphas for r in l1_ratios]


# ------------------------------------------------------------------ M32
def feature_ablation(df: DataFrame, features: Sequence[str], label: str, keys: Sequence[str],
                     drops: Sequence[Sequence[str]], k: int = 5, seed: int = 0) -> DataFrame:
    """CV summary with all features and with each listed subset removed: rows
    and columns of the same moments, one pass for every variant. Rows with a
    missing value in any of ``features`` take no part in any variant."""
    held = fold_moments(df, features, label, keys, k, seed)
    rows = [("all" if not drop else "without " + ", ".join(drop), *_scores(held, k, features=[c for c in features if c not in drop]))
            for drop in [()] + [tuple(x) for x in drops]]
    return df.sparkSession.createDataFrame(rows, "variant string, mean_train double, mean_test double, gap double")


# ------------------------------------------------------------------ M34
def learning_curve(df: DataFrame, features: Sequence[str], label: str, keys: Sequence[str],
                   sizes: Sequence[float] = (0.1, 0.325, 0.55, 0.775, 1.0), k: int = 5, seed: int = 0,
                   penalty: Penalty = Penalty()) -> DataFrame:
    """Mean train / test R^2 over ``k`` folds at growing shares of each
    training part (nested prefixes of the hashed order). A cell is a fold and a
    range of ranks between two prefix ends, so all sizes and folds come from
    one pass of moments."""
    folded = assign_folds(df.select(*_uniq(keys, features, label)), keys, k, seed)
    n = folded.count()
    ends = {}
    for s, share in enumerate(sizes):
        for i in range(k):
            wanted = max(int(share * (n - (n - i + k - 1) // k)), 2)
            low, high = 0, n  # the first rank before which the training part has so many rows
            while low < high:
                mid = (low + high) // 2
                low, high = (mid + 1, high) if mid - (mid - i + k - 1) // k < wanted else (low, mid)
            ends[s, i] = low
    cuts = sorted(set(ends.values()))
    piece = F.size(F.filter(F.lit(cuts), lambda c: c <= F.col("__rank"))) if cuts else F.lit(0)
    cell = (piece * k + F.col("fold")).alias("__cell")
    held = CellMoments(folded.select(*_uniq(features, label), cell), features, label, "__cell")
    rows = []
    for s, share in enumerate(sizes):
        fits = []
        for i in range(k):
            train = [p * k + f for p in range(cuts.index(ends[s, i]) + 1) for f in range(k) if f != i]
            fits.append(held.fit(train, [p * k + i for p in range(len(cuts) + 1)], penalty))
        rows.append((float(share), _mean([f.r2_train for f in fits]), _mean([f.r2_test for f in fits])))
    return df.sparkSession.createDataFrame(rows, "train_share double, mean_train double, mean_test double")


# ------------------------------------------------------------------ M35, M36
def coefficient_table(spark: SparkSession, model, names: Sequence[str]) -> DataFrame:
    """``(feature, coefficient)`` plus the intercept."""
    rows = [(n, float(c)) for n, c in zip(names, model.coefficients.toArray())]
    rows.append(("intercept", float(model.intercept)))
    return spark.createDataFrame(rows, "feature string, coefficient double")


def comparison_table(results: DataFrame, digits: int = 3) -> DataFrame:
    """Long rows ``(model, metric, value)`` -> one row per model, one column
    per metric, values rounded to ``digits``."""
    return (results.withColumn("value", F.round("value", digits))
            .groupBy("model").pivot("metric").agg(F.first("value")))
