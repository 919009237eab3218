"""Aggregates behind the reports and charts.

All are one grouped pass with map-side combine over keys of small, known
cardinality (years, months, categories); what follows works on those few rows.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

from hazegrid import catalog
from hazegrid.functions import air, labels
from hazegrid.functions.calendar import decade, season_name
from hazegrid.functions.numeric import percent, round_even
from hazegrid.operators import index
from hazegrid.operators.quantiles import exact_quantiles


def grouped_stats(df: DataFrame, by, measures: dict[str, Column], digits: int | None = 2) -> DataFrame:
    """Named aggregates per group, rounded half to even."""
    return df.groupBy(*([by] if isinstance(by, str) else by)).agg(*[
        (m if digits is None else round_even(m, digits)).alias(name) for name, m in measures.items()])


def yearly_index(df: DataFrame, value: str = "aqi") -> DataFrame:
    return grouped_stats(df, "year", {
        "mean": F.avg(value), "min": F.min(value), "max": F.max(value), "std": F.stddev_samp(value)})


def first_to_last(yearly: DataFrame, value: str = "mean", year: str = "year") -> DataFrame:
    """Change from first to last year, taken from the (rounded) yearly values."""
    ends = yearly.agg(
        F.min(year).alias("first_year"), F.max(year).alias("last_year"),
        F.min_by(value, year).alias("first_value"), F.max_by(value, year).alias("last_value"))
    change = F.col("last_value") - F.col("first_value")
    return ends.select(
        "*", change.alias("change"), percent(change, F.col("first_value")).alias("change_pct"),
        labels.trend_verdict(change).alias("verdict"))


def decade_index(df: DataFrame, value: str = "aqi") -> DataFrame:
    return grouped_stats(df, [decade(F.col("year")).alias("decade")], {"mean": F.avg(value)})


def yearly_trends(df: DataFrame) -> DataFrame:
    """The stored trends table."""
    measures = {"aqi_avg": F.avg("aqi"), "aqi_max": F.max("aqi"), "aqi_min": F.min("aqi")}
    for name, column in (
        ("pm2_5_avg", "PM2_5"), ("pm10_avg", "PM10"), ("temperature_avg", "temperature_mean"),
        ("humidity_avg", "humidity"), ("wind_speed_avg", "wind_speed"),
    ):
        measures[name] = F.avg(column)
    return grouped_stats(df, "year", measures)


def season_stats(df: DataFrame) -> DataFrame:
    stats = grouped_stats(df, "season", {
        "aqi_mean": F.avg("aqi"), "aqi_std": F.stddev_samp("aqi"),
        "aqi_min": F.min("aqi"), "aqi_max": F.max("aqi"),
        "PM2_5_mean": F.avg("PM2_5"), "temperature_mean_mean": F.avg("temperature_mean"),
        "humidity_mean": F.avg("humidity"), "wind_speed_mean": F.avg("wind_speed"),
    })
    return stats.withColumn("season_name", season_name(F.col("season")))


def month_stats(df: DataFrame) -> DataFrame:
    return grouped_stats(df, "month", {"aqi": F.avg("aqi"), "PM2_5": F.avg("PM2_5")})


def weekday_stats(df: DataFrame) -> DataFrame:
    return grouped_stats(df, "weekday", {"aqi": F.avg("aqi")})


def extremes(stats: DataFrame, key: str, value: str, by=()) -> DataFrame:
    """Key with the largest (`worst`) and smallest (`best`) value; the lowest key wins ties."""
    order = F.struct(F.col(value).alias("v"), F.negative(F.col(key)).alias("k"))
    lowest = F.struct(F.col(value).alias("v"), F.col(key).alias("k"))
    present = stats.filter(F.col(value).isNotNull())
    return present.groupBy(*by).agg(
        F.max_by(key, order).alias(f"worst_{key}"), F.max(value).alias("worst_value"),
        F.min_by(key, lowest).alias(f"best_{key}"), F.min(value).alias("best_value"))


def mean_indices(df: DataFrame) -> DataFrame:
    """Mean sub-index per component and the overall mean index, largest first."""
    present = index.components(df.columns)
    means = index.with_sub_indices(df).agg(
        F.avg("aqi").alias("actual_aqi"), *[F.avg(air.index_name(c)).alias(c) for c in present])
    return means.unpivot(["actual_aqi"], present, "component", "mean_index").orderBy(
        F.desc_nulls_last("mean_index"), "component")


def dominant_components(df: DataFrame) -> DataFrame:
    """Add `component`: the first one whose sub-index is the largest of the row."""
    present = index.components(df.columns)
    parts = {c: air.index_name(c) for c in present}
    tops = index.with_sub_indices(df).select("*", air.overall(parts.values()).alias("_top"))
    return tops.select(*df.columns, air.dominant(parts, "_top").alias("component"))


def dominant_counts(df: DataFrame, k: int = 5) -> DataFrame:
    """How often each component decides the index, with its share of all rows."""
    return counted(dominant_components(df), "component").orderBy(
        F.desc("n"), "component").limit(k)


def counted(df: DataFrame, key: str) -> DataFrame:
    """Rows and share of all rows for each name; rows without a name only count towards the total."""
    each = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    # One row for each name of the catalog; the window also keeps the filter above the aggregate, and so the names from being computed twice.
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return each.select(key, "n", percent(F.col("n"), total).alias("pct")).filter(F.col(key).isNotNull())


def category_counts(df: DataFrame, key: str = "aqi_category") -> DataFrame:
    return counted(df, key)


def status_counts(df: DataFrame, category: str = "aqi_category") -> DataFrame:
    return counted(df.select(air.status(F.col(category)).alias("status")), "status")


def correlation(x, y) -> Column:
    """Pearson correlation over the pairs both present; missing where either side is constant or there is no pair."""
    x, y = (F.col(c) if isinstance(c, str) else c for c in (x, y))
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x), F.when(both, y)
    return F.covar_pop(x, y) / F.nullif(F.stddev_pop(x) * F.stddev_pop(y), F.lit(0.0))


def correlations(df: DataFrame, columns, target: str = "aqi", labelled: bool = True) -> DataFrame:
    """Pearson correlation with the target over the pairs both present, strongest first."""
    row = df.agg(*[correlation(c, target).alias(c) for c in columns])
    tall = row.unpivot([], list(columns), "variable", "r")
    if labelled:
        tall = tall.select(
            "*", labels.strength(F.col("r")).alias("strength"), labels.direction(F.col("r")).alias("direction"))
    return tall.orderBy(F.desc_nulls_last(F.abs("r")), "variable")


def strongest(corr: DataFrame) -> DataFrame:
    """The variable most correlated with the target, the first name on ties."""
    return corr.filter("r IS NOT NULL").orderBy(F.desc(F.abs("r")), "variable").limit(1)


def correlation_pairs(df: DataFrame, columns) -> DataFrame:
    """Upper triangle (first, second, r) of the correlation matrix, pairwise complete.

    Every row is spread over the pairs and aggregated per pair: a short
    aggregate over n(n-1)/2 groups is much faster than a single one with that
    many correlations, and combines map-side all the same.
    """
    pairs = list(combinations(columns, 2))
    spread = F.inline(F.array(*[
        F.struct(F.lit(i).alias("pair"), F.col(a).alias("x"), F.col(b).alias("y"))
        for i, (a, b) in enumerate(pairs)]))
    each = df.select(spread).groupBy("pair").agg(correlation("x", "y").alias("r"))
    names = F.array(*[F.struct(F.lit(a).alias("first"), F.lit(b).alias("second")) for a, b in pairs])
    return each.select(names[F.col("pair")].alias("names"), "r").select("names.*", "r")


def correlation_matrix(df: DataFrame, columns) -> DataFrame:
    """All ordered pairs; each correlation is computed once, a column that varies is 1 with itself."""
    row = df.agg(*[(F.min(c) < F.max(c)).alias(c) for c in columns])
    own = row.unpivot([], list(columns), "first", "varies").select(
        "first", F.col("first").alias("second"), F.when(F.col("varies"), F.lit(1.0)).alias("r"))
    both = correlation_pairs(df, columns).select(F.inline(F.array(
        F.struct("first", "second", "r"),
        F.struct(F.col("second").alias("first"), F.col("first").alias("second"), "r"))))
    return both.unionByName(own)


def strong_pairs(pairs: DataFrame, above: float = 0.5, k: int = 10) -> DataFrame:
    return pairs.filter(F.abs("r") > above).orderBy(F.desc(F.abs("r")), "first", "second").limit(k)


def group_correlations(pairs: DataFrame, groups: dict[str, tuple[str, ...]]) -> DataFrame:
    """Mean correlation inside each group of columns."""
    inside = F.lit(None).cast("string")
    for name, members in groups.items():
        both = F.col("first").isin(*members) & F.col("second").isin(*members)
        inside = F.when(both, F.lit(name)).otherwise(inside)
    return pairs.withColumn("group", inside).filter("group IS NOT NULL").groupBy("group").agg(
        F.avg("r").alias("mean_r"))


def correlations_of(pairs: DataFrame, column: str) -> DataFrame:
    """One row of the matrix without its diagonal."""
    other = F.when(F.col("first") == column, F.col("second")).when(
        F.col("second") == column, F.col("first"))
    return pairs.select(other.alias("variable"), "r").filter("variable IS NOT NULL")


def quantile_bins(df: DataFrame, variables, measures: dict[str, Column], bins: int = 5) -> DataFrame:
    """Aggregates per quantile bin (low, high] of each variable, the first bin closed.

    Equal edges are merged, empty bins are kept with a count of zero.
    """
    probs = [i / bins for i in range(bins + 1)]
    tall = df.unpivot([c for c in df.columns if c not in variables], list(variables), "variable", "x").filter(
        "x IS NOT NULL")
    edges = exact_quantiles(tall, ["variable"], "x", probs, few_groups=True).select(
        "variable", F.array_distinct("q").alias("edges"))
    # One edge only: a constant variable, whose single bin is [x, x].
    edges = edges.select("variable", F.when(F.size("edges") == 1, F.concat("edges", "edges"))
                         .otherwise(F.col("edges")).alias("edges"))
    # Inner edges as columns, as their comparisons are compiled; null where merged bins leave fewer.
    inner = edges.select("variable", *[
        F.when(F.size("edges") > i + 1, F.get("edges", F.lit(i))).alias(f"_edge{i}") for i in range(1, bins)])
    bin_no = F.expr(" + ".join(["1", *(f"coalesce(CAST(x > _edge{i} AS INT), 0)" for i in range(1, bins))]))
    stats = tall.join(F.broadcast(inner), "variable").groupBy("variable", bin_no.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), *[m.alias(name) for name, m in measures.items()])
    frame = edges.select("variable", "edges", F.explode(
        F.sequence(F.lit(1), F.size("edges") - 1)).alias("bin")).select(
        "variable", "bin", F.col("edges")[F.col("bin") - 1].alias("low"),
        F.col("edges")[F.col("bin")].alias("high"))
    return frame.join(stats, ["variable", "bin"], "left").fillna(0, ["n"])


def box_plot(df: DataFrame, key: str = "aqi_category", value: str = "aqi") -> DataFrame:
    """Quartiles and whiskers (extreme values within 1.5 IQR) per category."""
    box = exact_quantiles(df, [key], value, (0.25, 0.5, 0.75), few_groups=True).select(
        key, F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))
    reach = (F.col("q3") - F.col("q1")) * 1.5
    low, high = F.col("q1") - reach, F.col("q3") + reach
    v = F.col(value)
    return df.join(F.broadcast(box), key).groupBy(key, "q1", "median", "q3").agg(
        F.min(F.when(v >= low, v)).alias("whisker_low"), F.max(F.when(v <= high, v)).alias("whisker_high"),
        F.count(v).alias("n"), F.count_if((v < low) | (v > high)).alias("outliers"))


def component_means(df: DataFrame, by: str, columns=catalog.COMPONENTS,
                    no2_scale: float = catalog.NO2_DISPLAY_SCALE) -> DataFrame:
    """Mean concentrations per year or month, NO2 on its display scale."""
    return df.groupBy(by).agg(*[
        (F.avg(c) * F.lit(no2_scale) if c == "NO2_trop" else F.avg(c)).alias(c) for c in columns])


def component_change(yearly: DataFrame, columns=catalog.COMPONENTS) -> DataFrame:
    """First and last yearly mean per component; percent is 0 if the first is not positive."""
    tall = yearly.unpivot(["year"], list(columns), "component", "mean")
    ends = tall.groupBy("component").agg(
        F.min_by("mean", "year").alias("first_mean"), F.max_by("mean", "year").alias("last_mean"))
    change = F.col("last_mean") - F.col("first_mean")
    pct = F.when(F.col("first_mean") > 0, percent(change, F.col("first_mean"))).otherwise(F.lit(0.0))
    return ends.select("*", change.alias("change"), pct.alias("change_pct"))


def peak_months(monthly: DataFrame, columns=catalog.COMPONENTS) -> DataFrame:
    tall = monthly.unpivot(["month"], list(columns), "component", "mean")
    return extremes(tall, "month", "mean", by=("component",))


def calendar_heatmap(df: DataFrame, value: str = "aqi") -> DataFrame:
    """Years by months 1..12 of the mean."""
    return df.groupBy("year").pivot("month", list(range(1, 13))).agg(F.avg(value))


def extreme_months(df: DataFrame, value: str = "aqi") -> DataFrame:
    """Worst and best (year, month) by mean; the earliest wins ties."""
    means = df.groupBy("year", "month").agg(F.avg(value).alias(value)).withColumn(
        "year_month", F.col("year") * 100 + F.col("month"))
    return extremes(means, "year_month", value)


def fitted_line(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line and correlation over the complete pairs."""
    return df.select(F.col(x).alias("x"), F.col(y).alias("y")).dropna().agg(
        F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("intercept"),
        correlation("x", "y").alias("r"), F.count(F.lit(1)).alias("n"))


def scatter_facts(df: DataFrame, x: str, y: str) -> DataFrame:
    """What stands beside a scatter chart: the correlation and the largest x."""
    return df.agg(correlation(x, y).alias("r"), F.max(x).alias("max_x"))


def summary(df: DataFrame, date: str = "date", value: str = "aqi") -> DataFrame:
    """Rows, date range, span in years and the range of the index."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(date).alias("first_date"), F.max(date).alias("last_date"),
        (F.year(F.max(date)) - F.year(F.min(date))).alias("years"),
        F.min(value).alias("min_index"), F.max(value).alias("max_index"), F.avg(value).alias("mean_index"))


def column_profile(df: DataFrame, columns) -> DataFrame:
    """Mean, missing count and missing percentage per column, in one pass."""
    columns = list(columns)
    row = df.agg(F.count(F.lit(1)).alias("total"), *[
        F.struct(F.avg(c).alias("mean"), F.count_if(F.col(c).isNull()).alias("missing")).alias(c)
        for c in columns])
    return row.unpivot(["total"], columns, "column", "s").select(
        "column", "s.mean", "s.missing", percent(F.col("s.missing"), F.col("total")).alias("missing_pct"))


def column_groups(columns) -> dict[str, list[str]]:
    """Lag and rolling columns by name."""
    return {
        "lag": [c for c in columns if "_lag" in c],
        "rolling": [c for c in columns if "_rolling" in c],
    }


def sample(df: DataFrame, key, n: int = 1000, seed: int = 42) -> DataFrame:
    """At most n rows, chosen by a hash of their key: random, but repeatable."""
    keys = [key] if isinstance(key, str) else list(key)
    token = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    return df.orderBy(token, *keys).limit(n)


def top_per_group(df: DataFrame, by, order, k: int) -> DataFrame:
    """First k rows per group of a small result table, with their rank."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("rank", rank).filter(F.col("rank") <= k)


