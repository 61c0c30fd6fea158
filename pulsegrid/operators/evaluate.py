"""Scores of forecasts, flat, by horizon and by step."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEAST = 1e-10


def pair_steps(windows: DataFrame, horizons: tuple[int, ...], keys: tuple[str, ...] = ("metric_name", "container_name", "window_id"), directions: bool = False) -> DataFrame:
    """Arrays ``y_<h>`` and ``pred_<h>`` as rows (keys, horizon, step, y_true, y_pred), in place.

    All horizons come out of one pass, so what made the windows runs once.  ``directions`` adds
    ``same_direction``: 1 where both moved alike since the step before, else 0, null at first steps.
    """

    def one(h: int) -> Column:
        y, p = F.col(f"y_{h}"), F.col(f"pred_{h}")

        def step(r: Column, i: Column) -> Column:
            fields = [F.lit(h).alias("horizon"), i.alias("step"), r["y"].alias("y_true"), r["p"].alias("y_pred")]
            if directions:
                moved, foretold = F.signum(r["y"] - F.get(y, i - 1)), F.signum(r["p"] - F.get(p, i - 1))
                fields.append(F.when(moved.isNotNull(), F.when(moved == foretold, 1.0).otherwise(0.0)).alias("same_direction"))
            return F.struct(*fields)

        return F.transform(F.arrays_zip(y.alias("y"), p.alias("p")), step)

    rows = F.flatten(F.array_compact(F.array(*map(one, horizons))))
    return windows.select(*keys, F.inline(rows))


def pair_rows(actual: DataFrame, predicted: DataFrame) -> DataFrame:
    """Join long actuals (y_true) and predictions (y_pred) on series, window, horizon and step."""
    return actual.join(predicted, ["metric_name", "container_name", "window_id", "horizon", "step"])


def _scores() -> dict[str, Column]:
    e, y = F.col("y_true") - F.col("y_pred"), F.col("y_true")
    sse, sst = F.sum(e * e), F.var_pop("y_true") * F.count("y_true")
    share = F.when(F.abs(y) > LEAST, F.abs(e / F.when(F.abs(y) > LEAST, y)))
    r2 = F.when(sst > 0, 1 - F.try_divide(sse, sst)).when(sse == 0, 1.0).otherwise(0.0)
    return {"n": F.count(F.lit(1)), "rmse": F.sqrt(F.avg(e * e)), "mae": F.avg(F.abs(e)), "mape": F.coalesce(100 * F.avg(share), F.lit(0.0)), "r2": r2}


def score(predictions: DataFrame, by: tuple[str, ...] = ("metric_name", "container_name", "horizon")) -> DataFrame:
    """RMSE, MAE, MAPE (where actuals are not 0; else 0) and R² over all windows and steps.

    R² of actuals that do not vary is 1 without errors and 0 with errors.
    """
    return predictions.groupBy(*by).agg(*[c.alias(n) for n, c in _scores().items()])


def directional_accuracy(predictions: DataFrame, by: tuple[str, ...] = ("metric_name", "container_name", "horizon")) -> DataFrame:
    """Percentage of step-to-step changes of equal sign (0 is a sign of its own); horizons over 1."""
    w = Window.partitionBy("metric_name", "container_name", "window_id", "horizon").orderBy("step")
    moves = predictions.filter("horizon > 1").withColumns({"_t": F.signum(F.col("y_true") - F.lag("y_true").over(w)), "_p": F.signum(F.col("y_pred") - F.lag("y_pred").over(w))})
    return moves.filter("_t is not null").groupBy(*by).agg((100.0 * F.avg(F.when(F.col("_t") == F.col("_p"), 1.0).otherwise(0.0))).alias("directional_accuracy"))


def horizon_analysis(predictions: DataFrame, by: tuple[str, ...] = ("metric_name", "container_name"), per_minute: int = 4) -> DataFrame:
    """Scores of each horizon, with the horizon in minutes; ``directional_accuracy``, too, of rows with ``same_direction``."""
    more = {"directional_accuracy": 100.0 * F.avg("same_direction")} if "same_direction" in predictions.columns else {}
    scores = predictions.groupBy(*by, "horizon").agg(*[c.alias(n) for n, c in (_scores() | more).items()])
    return scores.withColumn("minutes", F.floor(F.col("horizon") / per_minute).cast("int"))


def degradation(by_horizon: DataFrame, by: tuple[str, ...] = ("metric_name", "container_name")) -> DataFrame:
    """RMSE and MAE in order of the horizons, and their growth a minute from first to last."""
    ordered = F.array_sort(F.collect_list(F.struct("horizon", "minutes", "rmse", "mae")))
    out = by_horizon.groupBy(*by).agg(ordered.alias("h"))
    first, last = F.col("h")[0], F.element_at("h", -1)
    span = last["minutes"] - first["minutes"]
    return out.select(
        *by,
        F.transform("h", lambda x: x["rmse"]).alias("rmse_progression"),
        F.transform("h", lambda x: x["mae"]).alias("mae_progression"),
        F.try_divide(last["rmse"] - first["rmse"], span).alias("rmse_per_minute"),
        F.try_divide(last["mae"] - first["mae"], span).alias("mae_per_minute"),
    )


def step_errors(predictions: DataFrame, by: tuple[str, ...] = ("metric_name", "horizon")) -> DataFrame:
    """MAE of each step."""
    return predictions.groupBy(*by, "step").agg(F.avg(F.abs(F.col("y_true") - F.col("y_pred"))).alias("mae"))


def loss(predictions: DataFrame, kind: str = "mse", weights: dict[int, float] | None = None, delta: float = 1.0) -> DataFrame:
    """Mean loss over horizons, by their weights (1 where none is given), as one row.

    Kinds: mse, mae (or l1), huber.
    """
    e = F.col("y_true") - F.col("y_pred")
    size = F.abs(e)
    kinds = {"mse": e * e, "mae": size, "l1": size, "huber": F.when(size <= delta, e * e / 2).otherwise(delta * (size - delta / 2))}
    if kind not in kinds:
        raise ValueError(f"unknown loss: {kind}")
    weight = F.lit(1.0)
    for h, w in (weights or {}).items():
        weight = F.when(F.col("horizon") == h, F.lit(float(w))).otherwise(weight)
    each = predictions.groupBy("horizon").agg(F.avg(kinds[kind]).alias("loss")).withColumn("w", weight)
    return each.agg((F.sum(F.col("loss") * F.col("w")) / F.sum("w")).alias("loss"))


def decayed_mse(predictions: DataFrame, decay: float = 0.95) -> DataFrame:
    """By horizon: MSE with step weights decay^step that sum to the horizon."""
    weight = F.pow(F.lit(decay), F.col("step"))
    e = F.col("y_true") - F.col("y_pred")
    steps = predictions.groupBy("horizon", "step").agg(F.avg(e * e).alias("mse"))
    return steps.groupBy("horizon").agg((F.sum(weight * F.col("mse")) / F.sum(weight)).alias("loss"))
