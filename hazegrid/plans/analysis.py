"""The five analyses of the daily table, and the chart tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from hazegrid import catalog
from hazegrid.functions.numeric import round_even
from hazegrid.operators import chunks, sinks, stats, windows


def _present(df: DataFrame, names) -> list[str]:
    return [c for c in names if c in df.columns]


def index_trend(df: DataFrame) -> dict[str, DataFrame]:
    yearly = stats.yearly_index(df)
    return {"yearly_trend": yearly, "change": stats.first_to_last(yearly), "decade_trend": stats.decade_index(df)}


def pollutant_importance(df: DataFrame) -> dict[str, DataFrame]:
    corr = stats.correlations(df, _present(df, catalog.COMPONENTS), labelled=False)
    return {
        "pollutant_aqi_avg": stats.mean_indices(df), "dominant": stats.dominant_counts(df),
        "correlations": corr, "most_important": stats.strongest(corr)}


def weather_impact(df: DataFrame) -> dict[str, DataFrame]:
    drivers = _present(df, catalog.WEATHER_DRIVERS)
    binned = _present(df, ("temperature_mean", "humidity", "wind_speed"))
    bins = stats.quantile_bins(df.select(*binned, "aqi", "PM2_5"), binned, {
        "aqi_mean": round_even(F.avg("aqi")), "PM2_5_mean": round_even(F.avg("PM2_5"))})
    return {"correlations": stats.correlations(df, drivers), "bins": bins}


def seasonal_patterns(df: DataFrame) -> dict[str, DataFrame]:
    seasons, months = stats.season_stats(df), stats.month_stats(df)
    return {
        "seasonal_stats": seasons, "monthly_stats": months, "weekday_stats": stats.weekday_stats(df),
        "season_extremes": stats.extremes(seasons, "season", "aqi_mean"),
        "month_extremes": stats.extremes(months, "month", "aqi")}


def pollutant_correlations(df: DataFrame) -> dict[str, DataFrame]:
    columns = _present(df, catalog.POLLUTANTS)
    pairs = stats.correlation_pairs(df, columns)
    return {
        "correlation_matrix": stats.correlation_matrix(df, columns),
        "high_correlation_pairs": stats.strong_pairs(pairs),
        "groups": stats.group_correlations(pairs, {"pm": catalog.PM_GROUP, "gas": catalog.GAS_GROUP})}


ANALYSES = {
    "Query_1_AQI_Trend": index_trend,
    "Query_2_Most_Important_Pollutant": pollutant_importance,
    "Query_3_Weather_Impact": weather_impact,
    "Query_4_Seasonal_Patterns": seasonal_patterns,
    "Query_5_Pollutant_Correlations": pollutant_correlations,
}


def result_row(parts: dict[str, DataFrame], kind: str, summary: Column | None = None) -> DataFrame:
    """One row with all parts of an analysis as JSON; every part is a short table."""
    lists = {
        name: part.agg(F.array_sort(F.collect_list(F.struct(*part.columns))).alias("rows"))
        for name, part in parts.items()}
    (first, base), *others = lists.items()
    whole = sinks.as_json({
        first: F.col("rows"), **{name: part.scalar() for name, part in others}})
    return sinks.analysis_row(
        base.select(whole.alias("results_json")), kind, F.lit("") if summary is None else summary)


def all_results(df: DataFrame) -> DataFrame:
    """(analysis_type, analysis_date, results_json, summary), one row per analysis."""
    rows = [result_row(analysis(df), kind) for kind, analysis in ANALYSES.items()]
    return reduce(DataFrame.unionByName, rows)


def save(df: DataFrame, folder: str) -> None:
    """Append the result of every analysis, and replace the yearly trends."""
    sinks.append_result(all_results(df), f"{folder}/results")
    sinks.reload_trends(df, f"{folder}/trends")


def charts(df: DataFrame, keys=("station",)) -> dict[str, DataFrame]:
    """The table behind each chart."""
    keys = list(keys)
    day = chunks.day(F.col("date"))
    components = _present(df, catalog.COMPONENTS)
    weather = _present(df, ("temperature_mean", "humidity", "wind_speed"))
    yearly = stats.yearly_index(df)
    by_year, by_month = (stats.component_means(df, by, components) for by in ("year", "month"))
    lines = [stats.fitted_line(df, w, "aqi").withColumn("variable", F.lit(w)) for w in weather]
    yesterday = windows.with_lags(df.select(*keys, "date", "aqi"), keys, day, ["aqi"], (1,))
    return {
        "1_aqi_trend_over_time": yearly,
        "2_pollutant_importance": stats.correlations(df, components, labelled=False),
        "3_seasonal_patterns": stats.season_stats(df),
        "4_weather_impact": reduce(DataFrame.unionByName, lines),
        "5_pollutant_correlations": stats.correlation_matrix(df, _present(df, catalog.POLLUTANTS)),
        "6_pollutants_timeseries": by_year,
        "7_aqi_distribution": stats.category_counts(df),
        "7_aqi_boxes": stats.box_plot(df),
        "8_calendar_heatmap": stats.calendar_heatmap(df),
        "9_pm25_vs_pm10": df.select("PM2_5", "PM10", "aqi").dropna(),
        "10_lag_features": stats.fitted_line(yesterday, "aqi_lag1", "aqi"),
        "11_rolling_statistics": windows.rolling_band(df.select(*keys, "date", "aqi"), keys, day),
        "12_monthly_pollutants": by_month,
        "13_pollution_vs_normal": stats.status_counts(df),
    }
