"""Pair classifiers of MLlib: a scaled logistic regression and boosted trees, with their metadata."""

from __future__ import annotations

import json
import resource
import time
from pathlib import Path

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.records import write_json

#: Boosted variants: trees, depth, step, fewest rows of a leaf.
VARIANTS = {"boosted": (250, 5, 0.08, 10), "depth5_long": (1400, 5, 0.05, 5), "depth7": (1000, 7, 0.05, 5), "depth9": (800, 9, 0.06, 10)}


def check(data: DataFrame, names: list[str]) -> None:
    """Labels must be 0 and 1, both there, and features finite."""
    labels = {r[0] for r in data.select("label").distinct().limit(3).collect()}
    if labels != {0, 1}:
        raise ValueError(f"labels are {labels}")
    odd = [F.count_if(F.col(n).isNull() | F.isnan(n) | (F.abs(n) == float("inf"))).alias(n) for n in names]
    bad = [n for n, k in data.agg(*odd).first().asDict().items() if k]
    if bad:
        raise ValueError(f"not finite: {bad}")


def estimator(kind: str, n: int, names: list[str], trees: int | None = None, seed: int = 42) -> Pipeline:
    gather = VectorAssembler(inputCols=names, outputCol="raw")
    if kind == "linear":
        return Pipeline(stages=[gather, StandardScaler(inputCol="raw", outputCol="features", withMean=True), LogisticRegression(regParam=1 / max(1, n), maxIter=500, standardization=False)])
    count, depth, step, leaf = VARIANTS[kind]
    return Pipeline(stages=[gather, GBTClassifier(featuresCol="raw", maxIter=trees or count, maxDepth=depth, stepSize=step, minInstancesPerNode=leaf, subsamplingRate=0.9, featureSubsetStrategy="0.9", seed=seed)])


def fit(data: DataFrame, names: list[str], out: str, kind: str = "linear", trees: int | None = None) -> PipelineModel:
    """Trains and saves under out/kind, with metadata that says RUNNING, then COMPLETE or FAILED. An existing folder is refused."""
    folder = Path(out, kind)
    folder.mkdir(parents=True, exist_ok=False)
    about = {"kind": kind, "features": names, "status": "RUNNING", "spark": data.sparkSession.version}
    write_json(folder / "metadata.json", about)
    began = time.time()
    try:
        check(data, names)
        n = data.count()
        model = estimator(kind, n, names, trees).fit(data.select(*names, F.col("label").cast("double").alias("label")))
        model.save(str(folder / "model"))
        about |= {"status": "COMPLETE", "rows": n, "importances": importances(model, names)}
        return model
    except Exception as e:
        about |= {"status": "FAILED", "error": str(e)[:500]}
        raise
    finally:
        about |= {"seconds": round(time.time() - began, 1), "peak_mb": resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024}
        write_json(folder / "metadata.json", about)


def load(folder: str) -> tuple[PipelineModel, list[str]]:
    about = json.loads(Path(folder, "metadata.json").read_text())
    if about["status"] != "COMPLETE":
        raise ValueError(f"{folder} is {about['status']}")
    return PipelineModel.load(str(Path(folder, "model"))), about["features"]


def predict(model: PipelineModel, data: DataFrame, names: list[str]) -> DataFrame:
    """data with score, the probability of a match."""
    missing = [n for n in names if n not in data.columns]
    if missing:
        raise ValueError(f"features are missing: {missing}")
    plain = data.drop("label") if "label" in data.columns else data
    scored = model.transform(plain).withColumn("score", vector_to_array("probability")[1])
    return scored.drop("raw", "features", "rawPrediction", "probability", "prediction")


def importances(model: PipelineModel, names: list[str]) -> list[dict]:
    """Largest first; of a linear model by size, with the signed coefficient."""
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        rows = [{"name": n, "importance": float(v)} for n, v in zip(names, last.featureImportances.toArray(), strict=True)]
    else:
        rows = [{"name": n, "importance": abs(float(v)), "coefficient": float(v)} for n, v in zip(names, last.coefficients.toArray(), strict=True)]
    return sorted(rows, key=lambda r: -r["importance"])
