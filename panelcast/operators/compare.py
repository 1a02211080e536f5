"""Predictions of several fitted models side by side, on the rows they share."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.operators.stats import best_by, regression_metrics


def align_predictions(models: dict[str, DataFrame], on: list[str], label: str = "y_real",
                      prediction: str = "y_pred", group: str = "split") -> DataFrame:
    """One row for each model and each row that any model predicts: (on, model, y_real,
    y_pred, common). ``y_pred`` is NULL where the model has no prediction there; ``common``
    says that all models have one, of those that predict anything in the row's ``group``.
    Real values come from the models' own rows.

    One shuffle by ``on``: a group holds at most one row for each model."""
    names = sorted(models)
    long = reduce(DataFrame.unionByName, [
        m.select(*on, F.lit(n).alias("model"), F.col(label).cast("double").alias("y_real"), F.col(prediction).cast("double").alias("y_pred"))
        for n, m in ((n, models[n]) for n in names)])
    wide = long.groupBy(*on).agg(F.max("y_real").alias("y_real"), F.map_from_entries(F.collect_list(
        F.when(F.col("y_pred").isNotNull(), F.struct("model", "y_pred")))).alias("_by"))
    # models that take part in a group: one row for each group
    active = wide.groupBy(group).agg(*[F.max(F.map_contains_key("_by", n)).cast("int").alias(f"_{i}") for i, n in enumerate(names)])
    active = active.select(group, reduce(lambda a, c: a + c, [F.col(f"_{i}") for i in range(len(names))]).alias("_active"))
    rows = wide.join(active, group).select(*on, "y_real", "_by", "_active", F.explode(F.array(*[F.lit(n) for n in names])).alias("model"))
    return rows.select(*on, "model", "y_real", F.try_element_at("_by", F.col("model")).alias("y_pred"),
                       ((F.size("_by") == F.col("_active")) & (F.col("_active") > 0)).alias("common"))


def coverage(aligned: DataFrame, group: list[str] | None = None) -> DataFrame:
    """Per model and group: rows any model predicts, rows this one does, those it lacks, and
    those all have."""
    g = list(group or ["split"])
    return aligned.groupBy("model", *g).agg(
        F.count(F.lit(1)).alias("n_support"), F.count("y_pred").alias("n_predicted"),
        (F.count(F.lit(1)) - F.count("y_pred")).alias("n_missing"), F.count(F.when(F.col("common"), F.lit(1))).alias("n_common"))


def compare_models(aligned: DataFrame, group: list[str] | None = None) -> DataFrame:
    """Metrics of every model and group on the common rows, with coverage and the winners by
    MAPE and by R²: (model, group, r2, mse, mae, mape, best_mape, best_r2, n_common, n_missing).
    A model that predicts nothing in a group keeps a row without metrics."""
    g = list(group or ["split"])
    metrics = regression_metrics(aligned.filter(F.col("common") & F.col("y_pred").isNotNull()), group=["model", *g])
    least = F.min("mape").over(Window.partitionBy(*g))
    most = F.max("r2").over(Window.partitionBy(*g))
    return (metrics.withColumn("best_mape", F.col("mape") == least).withColumn("best_r2", F.col("r2") == most)
            .join(coverage(aligned, g).select("model", *g, "n_common", "n_missing"), ["model", *g], "right"))


def winners(comparison: DataFrame, group: list[str] | None = None) -> DataFrame:
    """Per group the model with the lowest MAPE and the one with the highest R²."""
    g = list(group or ["split"])
    by_mape = best_by(comparison, "model", "mape", group=g).select(*g, F.col("best_low").alias("best_mape_model"))
    by_r2 = best_by(comparison, "model", "r2", group=g).select(*g, F.col("best_high").alias("best_r2_model"))
    return by_mape.join(by_r2, g)
