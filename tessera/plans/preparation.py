"""The whole feature preparation as one pipeline (inventory M15).

Pipe 1 makes the columns numeric and comparable, pipe 2 bins them and keeps
the most informative, pipe 3 fills what is missing, reduces the dimensions and
scales the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel

from tessera.ml import prep as PR
from tessera.ml.compose import Branch, Columns, ColumnTransformer


def preparation_pipeline(keep: Sequence[str], label: str, id_col: str, skew_threshold: float = 1.0,
                         categories: Sequence[str] = ("C", "B", "A"), ordinals: Sequence[str] = ("A", "B", "C"),
                         bins: int = 20, best: int = 5, neighbours: int = 5, share: float = 0.8,
                         pca_skew_threshold: float = 0.25) -> Pipeline:
    """Unfitted pipeline over a frame with numeric and categorical features.

    ``keep`` are columns that are no features (row keys, ``label``), ``id_col``
    a unique row key. All choices of columns - by type and by skewness - are
    made when a pipe is fitted, on what the pipe before it made. The
    categorical branch of pipe 2 is empty where pipe 1 has encoded all
    categories. The result has the kept columns and ``pc_1``, ``pc_2``, ...
    """
    kept = list(dict.fromkeys([*keep, label, id_col]))
    pipe1 = ColumnTransformer([
        Branch("asymmetric", Columns(kind="numeric", skew_at_least=skew_threshold),
               [lambda c: PR.Imputer(inputCols=c, strategy="median"), lambda c: PR.PowerTransformer(inputCols=c), lambda c: PR.Standardizer(inputCols=c)]),
        Branch("symmetric", Columns(kind="numeric", skew_below=skew_threshold),
               [lambda c: PR.Imputer(inputCols=c, strategy="mean"), lambda c: PR.Standardizer(inputCols=c)]),
        Branch("categorical", Columns(kind="categorical"),
               [lambda c: PR.Imputer(inputCols=c, strategy="most_frequent"),
                lambda c: PipelineModel([PR.OneHotEncoder(inputCol=x, categories=list(categories)) for x in c])]),
    ], keep=kept)
    pipe2 = ColumnTransformer([
        Branch("numerical", Columns(kind="numeric"),
               [lambda c: PR.Imputer(inputCols=c, strategy="median"), lambda c: PR.UniformBinner(inputCols=c, numBins=bins)]),
        Branch("categorical", Columns(kind="categorical"),
               [lambda c: PR.Imputer(inputCols=c, strategy="most_frequent"), lambda c: PR.OrdinalEncoder(inputCols=c, categories=list(ordinals))]),
    ], keep=kept)
    selector = ColumnTransformer([Branch("selector", Columns(kind="any"), [lambda c: PR.ChiSquareSelector(inputCols=c, k=best, labelCol=label)])], keep=kept)
    pipe3 = ColumnTransformer([
        Branch("reduced", Columns(kind="numeric"),
               [lambda c: PR.KNNImputer(inputCols=c, idCol=id_col, k=neighbours), lambda c: PR.Standardizer(inputCols=c),
                lambda c: PR.VariancePCA(inputCols=c, share=share), lambda c: PR.ConditionalSymmetrizer(inputCols=c, threshold=pca_skew_threshold),
                lambda c: PR.MinMaxScaler(inputCols=c)]),
    ], keep=kept, remainder="passthrough")
    return Pipeline(stages=[pipe1, pipe2, selector, pipe3])
