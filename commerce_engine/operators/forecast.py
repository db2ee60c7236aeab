"""Seasonal-naive forecasts with a growth factor, for any number of series at once.

Positions are counted from the newest point of each series. Before any window is
applied the input is one row per (series, month), so a series is as long as its
calendar, however many order lines stand behind it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import mean, ratio

SEASON = 12


def last_complete_month(lines: DataFrame) -> Column:
    """Month (yyyy-MM) of the newest order if that is its month's last day, else the month before."""
    newest = F.max("order_date")
    month = F.when(newest == F.last_day(newest), newest).otherwise(F.add_months(newest, -1))
    return lines.agg(F.date_format(month, "yyyy-MM")).scalar()


def monthly_series(lines: DataFrame, keys: Sequence[str] = (), value: str = "sales", complete: bool = False) -> DataFrame:
    """Σ value per (keys, year_month); with ``complete`` only up to the last complete month (needs order_date)."""
    by = lines.groupBy(*keys, "year_month").agg(F.sum(value).alias("value"))
    return by.where(F.col("year_month") <= last_complete_month(lines)) if complete else by


def _positions(series: DataFrame, keys: Sequence[str]) -> DataFrame:
    newest_first = Window.partitionBy(*keys).orderBy(F.desc("year_month"))
    return series.withColumn("pos", F.row_number().over(newest_first))


def _fit(positioned: DataFrame, keys: Sequence[str], skip: int) -> DataFrame:
    """Per series: growth, last season by position, held-out points by position."""
    pos = F.col("pos") - skip
    value = F.col("value")

    def by_position(condition: Column, index: Column) -> Column:
        return F.map_from_entries(F.collect_list(F.when(condition, F.struct(index, value.cast("double")))))

    fit = positioned.groupBy(*keys).agg(
        F.count_if(pos > 0).alias("points"),
        F.sum(F.when(pos.between(1, SEASON), value)).alias("last_season"),
        F.sum(F.when(pos.between(SEASON + 1, 2 * SEASON), value)).alias("previous_season"),
        F.max(F.when(pos > 0, F.col("year_month"))).alias("last_month"),
        by_position(pos.between(1, SEASON), pos).alias("season"),
        by_position(F.col("pos") <= skip, F.col("pos")).alias("held_out"),
    )
    growth = F.when(F.col("points") >= 2 * SEASON, ratio(F.col("last_season"), F.col("previous_season"))).otherwise(1.0)
    return fit.withColumn("growth", growth)


def _project(fit: DataFrame, horizon: int) -> DataFrame:
    """One row per step ahead; a series shorter than the step's place gives no row."""
    place = F.least("points", F.lit(SEASON)) - F.col("step") % SEASON
    steps = fit.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(horizon - 1))))
    start = F.to_date(F.concat("last_month", F.lit("-01")))
    return (
        steps.where(place > 0)
        .withColumn("date", F.add_months(start, F.col("step") + 1))
        .withColumn("forecast", F.try_element_at("season", place.cast("int")) * F.col("growth"))
    )


def seasonal_naive(series: DataFrame, keys: Sequence[str] = (), horizon: int = 3) -> DataFrame:
    """(keys, date, forecast, growth): same month last year times the growth of the last year."""
    fit = _fit(_positions(series, keys), keys, 0)
    return _project(fit, horizon).select(*keys, "date", "forecast", "growth")


def backtest(series: DataFrame, keys: Sequence[str] = (), holdout: int = 6) -> DataFrame:
    """(keys, growth, mape, mae) of forecasting the last ``holdout`` points from the rest."""
    fit = _fit(_positions(series, keys), keys, holdout)
    steps = _project(fit, holdout)
    actual = F.try_element_at("held_out", (F.lit(holdout) - F.col("step")).cast("int"))
    error = F.abs(F.col("forecast") - actual)
    scored = steps.withColumns({"err": error, "rel": F.try_divide(error, actual)})
    fixed = [F.col(c).cast("decimal(28,12)") for c in ("rel", "err")]
    return scored.groupBy(*keys).agg(
        F.first("growth").alias("growth"), (mean(fixed[0]) * 100).alias("mape"), mean(fixed[1]).alias("mae")
    )


def forecast_with_band(series: DataFrame, keys: Sequence[str] = (), horizon: int = 3, holdout: int = 6) -> DataFrame:
    """Forecast with the backtest error as an empirical band."""
    future = seasonal_naive(series, keys, horizon)
    errors = backtest(series, keys, holdout).select(*keys, (F.col("mape") / 100).alias("band"))
    if keys:
        joined = future.join(errors, list(keys), "left")
    else:
        joined = future.withColumn("band", errors.scalar())
    return joined.select(
        *keys,
        "date",
        "forecast",
        (F.col("forecast") * (1 - F.col("band"))).alias("lower"),
        (F.col("forecast") * (1 + F.col("band"))).alias("upper"),
    )
