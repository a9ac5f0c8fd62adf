"""Shared base for the column-wise estimators.

Fitted state lives in a JSON Param, so ``DefaultParamsWritable`` persists
a fitted stage - and a ``PipelineModel`` holding it - with no extra code (M16).
"""

from __future__ import annotations

import json

from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame


class HasState(Params):
    state = Param(Params._dummy(), "state", "fitted statistics as JSON", TypeConverters.toString)

    def getState(self) -> dict:
        return json.loads(self.getOrDefault(self.state)) if self.isDefined(self.state) else {}

    def _set_state(self, value: dict):
        return self._set(state=json.dumps(value))


class ColumnsEstimator(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Estimator over ``inputCols``; subclasses implement ``_stats(df, cols)``
    returning a JSON-able dict and name their ``model_class``."""

    model_class: type = None

    def __init__(self, inputCols=None, **kw):
        super().__init__()
        self._init_params(inputCols=inputCols, **kw)

    def _init_params(self, **kw):
        for k, v in kw.items():
            if v is not None:
                self._set(**{k: v})

    def _fit(self, df: DataFrame):
        cols = self.getInputCols()
        model = self.model_class()
        model._set(inputCols=cols)
        for p in self.params:
            if self.isSet(p) and model.hasParam(p.name):
                model._set(**{p.name: self.getOrDefault(p)})
        model._set_state(self._stats(df, cols))
        return model

    def _stats(self, df: DataFrame, cols):
        raise NotImplementedError


class ColumnsModel(Model, HasInputCols, HasState, DefaultParamsReadable, DefaultParamsWritable):
    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(self._exprs(df, self.getInputCols(), self.getState()))

    def _exprs(self, df, cols, state) -> dict:
        raise NotImplementedError


class SelectColumns(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Keep (or drop) a list of columns: the remainder policy of a column
    transformer and the cut of a feature selector."""

    keep = Param(Params._dummy(), "keep", "columns to keep", TypeConverters.toListString)
    drop = Param(Params._dummy(), "drop", "columns to drop", TypeConverters.toListString)

    def __init__(self, keep=None, drop=None):
        super().__init__()
        if keep is not None:
            self._set(keep=keep)
        if drop is not None:
            self._set(drop=drop)

    def _transform(self, df: DataFrame) -> DataFrame:
        if self.isSet(self.keep):
            return df.select(*[f"`{c}`" for c in self.getOrDefault(self.keep)])
        return df.drop(*self.getOrDefault(self.drop)) if self.isSet(self.drop) else df
