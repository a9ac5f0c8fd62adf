"""Parallel branches on the original input, saved pipelines, function steps
and the binner's missing values."""

import json
import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from tessera.ml import prep as PR
from tessera.ml.compose import Branch, Columns, ColumnTransformer, FunctionStep, import_name
from tessera.plans.preparation import preparation_pipeline

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def shifted(df, column, by):
    return df.withColumn(column, F.col(column) + by)


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(4)
    rows = [(i, int(rng.integers(0, 2)), float(rng.normal()), float(rng.exponential()) if i % 9 else None, float(rng.normal(5, 2)) if i % 7 else None,
             "ABC"[i % 3] if i % 11 else None) for i in range(400)]
    return spark.createDataFrame(rows, "id long, target int, a double, b double, c double, grade string")


def test_branches_read_the_original_columns(spark, frame):
    ct = ColumnTransformer([
        Branch("scaled", Columns(kind="numeric"), [lambda c: PR.MinMaxScaler(inputCols=c)]),
        Branch("binned", Columns(names=["a", "b"]), [lambda c: PR.UniformBinner(inputCols=c, numBins=4)]),
        Branch("nothing", Columns(kind="numeric", skew_at_least=99.0), [lambda c: PR.Standardizer(inputCols=c)])],
        keep=["id"], remainder="passthrough")
    out = ct.fit(frame.drop("target")).transform(frame.drop("target"))
    assert out.columns == ["id", "grade", "scaled__a", "scaled__b", "c", "binned__a", "binned__b"]
    pdf, src = out.orderBy("id").toPandas(), frame.orderBy("id").toPandas()
    assert np.allclose(pdf["scaled__a"], (src.a - src.a.min()) / (src.a.max() - src.a.min()))
    edges = np.linspace(src.a.min(), src.a.max(), 5)[1:-1]
    assert (pdf["binned__a"] == np.digitize(src.a, edges)).all()  # of the original values, not of the scaled ones
    assert (pdf["binned__b"].isna() == src.b.isna()).all()


def test_columns_are_picked_when_fitted(frame):
    skew = Columns(kind="numeric", skew_at_least=1.0).resolve(frame, ["id", "target"])
    assert skew == ["b"] and Columns(kind="numeric", skew_below=1.0).resolve(frame, ["id", "target"]) == ["a", "c"]
    assert Columns(kind="categorical").resolve(frame, []) == ["grade"]
    with pytest.raises(ValueError, match="not found"):
        Columns(names=["zz"]).resolve(frame, [])


def test_whole_preparation_loads_in_another_process(spark, frame, tmp_path):
    """Branches, function step, KNN donors: the model folder is all that the
    other process gets; its scratch folder is another."""
    knn = Pipeline(stages=[FunctionStep("test_compose:shifted", column="a", by=2.5), PR.KNNImputer(inputCols=["a", "b", "c"], idCol="id", k=3)])
    models = {"whole": preparation_pipeline(["id"], "target", "id", best=4).fit(frame), "knn": knn.fit(frame)}
    frame.write.parquet(str(tmp_path / "data"))
    want = {}
    for name, model in models.items():
        model.write().overwrite().save(str(tmp_path / name))
        out = model.transform(frame).orderBy("id")
        want[name] = [[round(x, 9) if isinstance(x, float) else x for x in r] for r in out.collect()]
        assert not out.where(" OR ".join(f"{c} IS NULL" for c in out.columns if c != "grade")).count()
    donors = PipelineModel.load(str(tmp_path / "knn")).stages[1].getState()["donors_path"]
    assert donors.startswith(str(tmp_path))
    code = f"""
import json, sys
sys.path[:0] = [{ROOT!r}, {os.path.dirname(os.path.abspath(__file__))!r}]
from pyspark.ml import PipelineModel
from tessera.session import get_session
spark = get_session("local[2]", 2)
df = spark.read.parquet({str(tmp_path / 'data')!r})
out = {{}}
for name in ("whole", "knn"):
    rows = PipelineModel.load({str(tmp_path)!r} + "/" + name).transform(df).orderBy("id").collect()
    out[name] = [[round(x, 9) if isinstance(x, float) else x for x in r] for r in rows]
print("RESULT" + json.dumps(out))
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    got = json.loads(next(line for line in done.stdout.splitlines() if line.startswith("RESULT"))[6:])
    for name in want:
        assert len(got[name]) == 400
        for g, w in zip(got[name], want[name]):
            assert all((a is None and b is None) or a == pytest.approx(b, abs=1e-6) for a, b in zip(g, w))


def test_function_steps_need_a_name(spark, frame):
    with pytest.raises(ValueError, match="imported by name"):
        import_name(lambda df: df)
    assert FunctionStep(shifted, column="a", by=1).transform(frame).where("id = 3").first()["a"] == frame.where("id = 3").first()["a"] + 1


def test_binner_without_values(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), None), (3.0, None), (None, None)], "x double, y double")
    out = PR.UniformBinner(inputCols=["x", "y"], numBins=2).fit(df).transform(df).collect()
    assert [r["x"] for r in out] == [0.0, None, 1.0, None] and all(r["y"] is None for r in out)


def test_decimal_mode_is_exact(spark):
    from decimal import Decimal
    big = Decimal("12345678901234567890.123456789")
    df = spark.createDataFrame([(big,), (big,), (None,), (Decimal(1),)], "d decimal(38,9)")
    out = PR.Imputer(inputCols=["d"], strategy="most_frequent").fit(df).transform(df).collect()
    assert [r["d"] for r in out][:3] == [big] * 3
