"""Column-wise composition of preparation stages (inventory M14-M16, U3).

:class:`ColumnTransformer` runs branches side by side: every branch reads the
*original* columns it selects - by name, by type or by skewness, decided when
it is fitted - through copies of its own, so two branches can use one column
and no branch sees what another made. Columns outside the branches pass
through or are dropped.

Fitted transformers are saved with their stages in sub-folders, and
:class:`FunctionStep` refers to its function by import name, so a whole
preparation pipeline can be loaded in another process.
"""

from __future__ import annotations

import importlib
import json
import os
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Estimator, Model, PipelineModel, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter,
                             MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tessera.operators import stats as S
from tessera.session import write_table


@dataclass
class Columns:
    """Which columns a branch reads. ``names`` fixes them; else ``kind`` picks
    by type (``numeric``, ``categorical`` - text and booleans - or ``any``),
    and ``skew_at_least`` / ``skew_below`` keep those numeric columns whose
    absolute skewness in the fit data is on that side (unknown skewness of a
    constant or empty column counts as 0)."""

    names: Sequence[str] | None = None
    kind: str = "any"
    skew_at_least: float | None = None
    skew_below: float | None = None

    def resolve(self, df: DataFrame, without: Sequence[str]) -> list[str]:
        if self.names is not None:
            absent = [c for c in self.names if c not in df.columns]
            if absent:
                raise ValueError(f"columns not found: {absent}")
            return list(self.names)
        text = (T.StringType, T.CharType, T.VarcharType, T.BooleanType)
        wanted = {"numeric": lambda t: isinstance(t, T.NumericType), "categorical": lambda t: isinstance(t, text), "any": lambda t: True}[self.kind]
        found = [f.name for f in df.schema.fields if f.name not in without and wanted(f.dataType)]
        if self.skew_at_least is None and self.skew_below is None:
            return found
        found = [c for c in found if isinstance(df.schema[c].dataType, T.NumericType)]
        skew = {r["column"]: abs(r["skew"] or 0.0) for r in S.skewness(df, found).collect()} if found else {}
        return [c for c in found if (self.skew_at_least is None or skew.get(c, 0.0) >= self.skew_at_least)
                and (self.skew_below is None or skew.get(c, 0.0) < self.skew_below)]


@dataclass
class Branch:
    """A named chain of stages over selected columns. Each of ``stages`` is a
    function of the branch's present columns that returns the next stage."""

    name: str
    columns: Columns
    stages: Sequence[Callable[[list[str]], Transformer | Estimator]] = field(default_factory=list)


def _copy_name(branch: str, column: str) -> str:
    return f"{branch}__{column}"


class ColumnTransformer(Estimator):
    """Runs ``branches`` in parallel on the original columns.

    ``keep`` are columns that always pass and are never selected by type (row
    keys, the label). ``remainder`` is ``"passthrough"`` or ``"drop"`` for
    columns that no branch reads. The result has the kept columns, the
    remainder, then each branch's columns; those keep their plain name unless
    two branches (or a passed column) share it - then they are prefixed with
    ``<branch>__``. A branch that selects nothing is left out.
    """

    def __init__(self, branches: Sequence[Branch] = (), keep: Sequence[str] = (), remainder: str = "drop"):
        super().__init__()
        if remainder not in ("drop", "passthrough"):
            raise ValueError(remainder)
        if len({b.name for b in branches}) < len(branches):
            raise ValueError("branch names must differ")
        self.branches, self.keep, self.remainder = list(branches), list(keep), remainder

    def _fit(self, df: DataFrame) -> ColumnTransformerModel:
        # every stage is fitted with passes of its own over the input: written once, not made again for each
        df = write_table(df, "fit-input")
        fitted, read = [], []
        for b in self.branches:
            cols = b.columns.resolve(df, self.keep)
            if not cols:
                continue
            read += cols
            copies = [_copy_name(b.name, c) for c in cols]
            frame = df.select(*[f"`{c}`" for c in self.keep], *[df[f"`{c}`"].alias(n) for c, n in zip(cols, copies)])
            present, models = copies, []
            for make in b.stages:
                stage = make(present)
                model = stage.fit(frame) if isinstance(stage, Estimator) else stage
                before, frame = set(frame.columns), model.transform(frame)
                present = [c for c in frame.columns if c in present or c not in before]
                models.append(model)
            fitted.append({"name": b.name, "columns": cols, "outputs": present, "model": PipelineModel(models)})
        made = [c for b in fitted for c in b["outputs"]]
        if len(set(made)) < len(made):
            raise ValueError(f"two branches make columns of one name: {sorted(c for c in set(made) if made.count(c) > 1)}")
        rest = [c for c in df.columns if c not in self.keep and c not in read] if self.remainder == "passthrough" else []
        return ColumnTransformerModel(fitted, self.keep + rest)


class ColumnTransformerModel(Model, MLReadable, MLWritable):
    """The fitted branches; ``passed`` are the columns that go through as they are."""

    def __init__(self, branches: list[dict] | None = None, passed: Sequence[str] = ()):
        super().__init__()
        self.branches, self.passed = branches or [], list(passed)

    def output_names(self) -> dict[str, str]:
        """Name inside the branches -> name in the result."""
        inner = [(b["name"], c) for b in self.branches for c in b["outputs"]]
        plain = {c: c.removeprefix(f"{b}__") for b, c in inner}
        taken = [*self.passed, *plain.values()]
        return {c: plain[c] if taken.count(plain[c]) == 1 else _copy_name(b, plain[c]) for b, c in inner}

    def _transform(self, df: DataFrame) -> DataFrame:
        copies = [df[f"`{c}`"].alias(_copy_name(b["name"], c)) for b in self.branches for c in b["columns"]]
        out = df.select(*[f"`{c}`" for c in self.passed], *copies)
        for b in self.branches:
            out = b["model"].transform(out)
        return out.select(*[f"`{c}`" for c in self.passed], *[out[f"`{c}`"].alias(n) for c, n in self.output_names().items()])

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, instance: ColumnTransformerModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        held = [{k: b[k] for k in ("name", "columns", "outputs")} for b in self.instance.branches]
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession, {"branches": held, "passed": self.instance.passed})
        for i, b in enumerate(self.instance.branches):
            b["model"].write().save(os.path.join(path, f"branch-{i}"))


class _Reader(MLReader):
    def load(self, path: str) -> ColumnTransformerModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        branches = [{**b, "model": PipelineModel.load(os.path.join(path, f"branch-{i}"))} for i, b in enumerate(metadata["branches"])]
        model = ColumnTransformerModel(branches, metadata["passed"])
        model._resetUid(metadata["uid"])
        return model


# ------------------------------------------------------------------ U3
def import_name(fn: Callable) -> str:
    """``module:name`` under which a function can be imported again."""
    name = f"{fn.__module__}:{fn.__qualname__}"
    try:
        if imported(name) is fn:
            return name
    except (ImportError, AttributeError):
        pass
    raise ValueError(f"{name} cannot be imported by name; define the function at the top of a module")


def imported(name: str) -> Callable:
    module, _, path = name.partition(":")
    found = importlib.import_module(module)
    for part in path.split("."):
        found = getattr(found, part)
    return found


class FunctionStep(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A function ``fn(df, **arguments) -> DataFrame`` of a module as a pipeline
    step that can be saved (U3): stored are its import name and its arguments,
    which must be JSON values."""

    function = Param(Params._dummy(), "function", "import name, module:name", TypeConverters.toString)
    arguments = Param(Params._dummy(), "arguments", "keyword arguments as JSON", TypeConverters.toString)

    def __init__(self, fn: Callable | str | None = None, **arguments):
        super().__init__()
        if fn is not None:
            self._set(function=fn if isinstance(fn, str) else import_name(fn), arguments=json.dumps(arguments))

    def _transform(self, df: DataFrame) -> DataFrame:
        return imported(self.getOrDefault(self.function))(df, **json.loads(self.getOrDefault(self.arguments)))
