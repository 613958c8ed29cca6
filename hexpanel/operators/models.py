"""Forecast models over the panel with Spark's own learners."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import Imputer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexpanel.operators import metrics
from hexpanel.operators.overlay import half_even
from hexpanel.operators.panel import with_percentile_rank
from hexpanel.schema import union_all
from hexpanel.sinks import write_text


def temporal_split(df: DataFrame, year: str = "year", train_to: int = 2022, valid: Sequence[int] = (2023, 2024)) -> tuple[DataFrame, DataFrame]:
    if min(valid) <= train_to:
        raise ValueError("validation years overlap training")
    return df.where(F.col(year) <= train_to), df.where(F.col(year).isin(*valid))


def horizon_window(horizon: int, last_train: int = 2022) -> tuple[int, int, int]:
    """Last training year, validation year and test year of a horizon."""
    end = last_train - (horizon - 1)
    return end, end + 1, end + 2


def hash_split(df: DataFrame, key: Sequence[str], share: float = 0.15, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Training rows and a held-out share, by a hash of the key."""
    held = F.pmod(F.xxhash64(*key, F.lit(seed)), F.lit(10_000)) < int(share * 10_000)
    return df.where(~held), df.where(held)


def feature_columns(df: DataFrame, label: str, also_drop: Iterable[str] = ("hex_id", "geometry")) -> list[str]:
    """All columns but keys and labels: no label of any horizon may be a feature."""
    gone = {label, *also_drop}
    return [c for c in df.columns if c not in gone and not c.startswith(("y_next", "split_y", "conv_y"))]


def balanced_weights(df: DataFrame, label: str) -> dict[int, float]:
    n = {int(r[0]): r[1] for r in df.groupBy(F.col(label).cast("int")).count().collect() if r[0] is not None}
    if set(n) != {0, 1}:
        raise ValueError("a class is missing")
    return {0: 1.0, 1: n[0] / n[1]}


def weighted(df: DataFrame, label: str, weights: dict[int, float]) -> DataFrame:
    return df.withColumn("_label", F.col(label).cast("double")).withColumn("_weight", F.when(F.col("_label") == 1, weights[1]).otherwise(weights[0]))


def _stages(numeric: Sequence[str], categories: Sequence[str], scale: bool) -> list:
    index = [StringIndexer(inputCols=list(categories), outputCols=[f"_{c}_i" for c in categories], handleInvalid="keep")] if categories else []
    fill = Imputer(strategy="median", inputCols=list(numeric), outputCols=[f"_{c}_f" for c in numeric])
    join = VectorAssembler(inputCols=[f"_{c}_f" for c in numeric] + [f"_{c}_i" for c in categories], outputCol="_x")
    return [*index, fill, join] + ([StandardScaler(inputCol="_x", outputCol="_z", withMean=True)] if scale else [])


def logistic_baseline(numeric: Sequence[str], categories: Sequence[str] = (), c: float = 1.0, rows: int = 1000) -> Pipeline:
    """Median imputation, standardisation, weighted logistic regression with a quadratic penalty."""
    return Pipeline(stages=[*_stages(numeric, categories, True), LogisticRegression(featuresCol="_z", labelCol="_label", weightCol="_weight", regParam=1.0 / (c * rows), elasticNetParam=0.0)])


def boosted_trees(numeric: Sequence[str], categories: Sequence[str] = (), valid: str | None = None, **params) -> Pipeline:
    """Gradient boosting; valid: a boolean column of rows on which training stops early."""
    tree = GBTClassifier(featuresCol="_x", labelCol="_label", weightCol="_weight", maxBins=128, seed=42, **({"maxIter": 40, "maxDepth": 4, "stepSize": 0.1} | params))
    return Pipeline(stages=[*_stages(numeric, categories, False), tree.setValidationIndicatorCol(valid) if valid else tree])


def score(model, df: DataFrame, out: str = "p_hat") -> DataFrame:
    made = model.transform(df)
    return made.withColumn(out, vector_to_array("probability")[1]).select(*df.columns, out)


def calibrate(df: DataFrame, score_col: str, label: str):
    """Isotonic regression of labels on scores; beyond the scores seen it stays level."""
    pairs = df.select(F.col(score_col).alias("_s"), F.col(label).cast("double").alias("_l"))
    return IsotonicRegression(featuresCol="_s", labelCol="_l").fit(pairs)


def apply_calibration(model, df: DataFrame, score_col: str, out: str = "p_hat_cal") -> DataFrame:
    return model.transform(df.withColumn("_s", F.col(score_col))).withColumn(out, F.col("prediction")).drop("_s", "prediction")


def tune(evaluate: Callable[[dict], float], start: dict, grid: dict[str, Sequence]) -> tuple[dict, float]:
    """Coordinate descent: each parameter in turn takes the best value that is no worse than what stands."""
    best, value = dict(start), evaluate(start)
    for name, options in grid.items():
        tried = [(evaluate(best | {name: o}), i, o) for i, o in enumerate(options) if o != best.get(name)]
        if tried and (top := max(tried, key=lambda t: (t[0], -t[1])))[0] >= value:
            best, value = best | {name: top[2]}, top[0]
    return best, value


def persistence(df: DataFrame, proxy: str, out: str = "p_hat") -> DataFrame:
    """The forecast that nothing changes: 1 where the proxy holds, else 0."""
    return df.withColumn(out, F.coalesce(F.col(proxy).cast("double"), F.lit(0.0)))


def tune_logistic(train: DataFrame, valid: DataFrame, label: str, numeric: Sequence[str], categories: Sequence[str] = (), grid: Sequence[float] = (0.01, 0.1, 1.0, 10.0)) -> tuple[float, float]:
    """The penalty of best average precision on the validation rows, the first of equals, and that precision."""
    ready = weighted(train, label, balanced_weights(train, label)).persist()
    n, best = ready.count(), (0.0, -1.0)
    for c in grid:
        found = score(logistic_baseline(numeric, categories, c, n).fit(ready), valid)
        value = metrics.average_precision(found, "p_hat", label).first()[0] or 0.0
        best = (c, value) if value > best[1] else best
    ready.unpersist()
    return best


def compare_lift(df: DataFrame, label: str, key: str, scores: Sequence[str] = ("p_hat", "p_hat_cal"), fraction: float = 0.1) -> DataFrame:
    """Lift and capture of the best-scored rows, a row for each score."""
    rows = [metrics.lift_at_k(df, s, label, key, fraction).withColumn("score", F.lit(s)) for s in scores]
    return union_all(rows)


def predictions(df: DataFrame, *, base_year: int, horizon: int, task: str, raw: str = "p_hat", calibrated: str | None = "p_hat_cal", geometry: str = "geometry") -> DataFrame:
    """What is exported of a scored panel: hex_id, base_year, target_year, horizon, task, probability, prob_calibrated (the
    probability, where nothing is calibrated), risk_percentile, and the geometry where there is one."""
    rows = with_percentile_rank(df.withColumn("probability", half_even(F.col(raw), 4)), "probability", "risk_percentile")
    sure = half_even(F.col(calibrated), 4) if calibrated and calibrated in df.columns else F.col("probability")
    said = [F.lit(base_year).cast("long").alias("base_year"), F.lit(base_year + horizon).cast("long").alias("target_year"), F.lit(horizon).cast("long").alias("horizon"), F.lit(task).alias("task")]
    return rows.select("hex_id", *said, "probability", sure.alias("prob_calibrated"), "risk_percentile", *([geometry] if geometry in df.columns else []))


def numbers_or_categories(df: DataFrame, columns: Sequence[str], most_lost: float = 0.01) -> tuple[DataFrame, list[str]]:
    """Booleans become 0 and 1; text becomes numbers where that loses no more than a share of all rows, else it is a
    category, however many values it has. Also the categories."""
    types = dict(df.dtypes)
    df = df.withColumns({c: F.col(c).cast("int") for c in columns if types[c] == "boolean"})
    text = [c for c in columns if types[c] == "string"]
    if not text:
        return df, []
    lost = df.agg(*((F.avg(F.col(c).isNotNull().cast("double")) - F.avg(F.col(c).try_cast("double").isNotNull().cast("double"))).alias(c) for c in text)).first()
    numbers = [c for c in text if (lost[c] or 0.0) <= most_lost]
    return df.withColumns({c: F.col(c).try_cast("double") for c in numbers}), [c for c in text if c not in numbers]


def save_bundle(path: str, model, features: Sequence[str], categories: Sequence[str], metrics: dict | None = None) -> None:
    """A fitted pipeline and what it was fitted on, both by Spark's file system, so any store will do."""
    model.write().overwrite().save(f"{path}/model")
    told = json.dumps({"features": list(features), "categoricals": list(categories), "metrics": metrics or {}}, indent=1)
    write_text(SparkSession.active(), f"{path}/meta.json", told)


def load_meta(path: str) -> dict:
    return json.loads(SparkSession.active().read.text(f"{path}/meta.json", wholetext=True).first()[0])


def load_bundle(path: str) -> tuple[PipelineModel, dict]:
    return PipelineModel.load(f"{path}/model"), load_meta(path)


def require_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """df; a KeyError where it lacks features of a model."""
    gone = [c for c in features if c not in df.columns]
    if gone:
        raise KeyError(f"features that the table lacks: {gone[:5]}")
    return df
