import json

import pytest
from pyspark.sql import functions as F

from hazegrid import session
from hazegrid.operators import sinks, stats
from hazegrid.plans import analysis, preprocess
from checks.storage import write_series
from hazegrid.sources import series_files, tables
from tests.util import frame


def write(folder, name, rows, fill="1000000000000000", variable="mean_X"):
    head = [
        'Title:,"Something, by area (monthly)"', "User Start Date:,1999-05-05T00:00:00Z",
        "User End Date:,2020-02-02T23:59:59Z", 'User Bounding Box:,"1,2,3,4"', 'Data Bounding Box:,"1.5,2,3,4"',
        'URL:,"https://example.org/#a=1999-05-05T00:00:00Z&box=1,2"',
        f"Fill Value ({variable}):, {fill}" if fill else "No fill", "", f"time, {variable}"]
    (folder / name).write_text("\n".join(head + [f"{t},{v}" for t, v in rows]) + "\n")


DEW = "g4.areaAvgTimeSeries.M2TMNXSLV_5_12_4_T2MDEW.20000101-20251031.102E_8N_110E_24N.csv"
PM = "g4.areaAvgTimeSeries.M2T1NXAER_5_12_4_TOTSMASS25.%s.csv"


def test_reads_values_and_fill_values_of_all_files(spark, tmp_path):
    write(tmp_path, DEW, [("2000-01-01 00:00:00", "290.099243"), ("2000-02-01 00:00:00", "1000000000000000")])
    write(tmp_path, PM % "2001", [("2001-01-01 00:30:00", "-999"), ("2001-01-01 01:30:00", "2e-8")], fill="-999")
    write(tmp_path, PM % "2002", [("2002-01-01 00:30:00", "7")])
    write(tmp_path, "area.precipitation.csv", [("2001-01-01 00:00:00", "3.5")], fill=None)
    write(tmp_path, "other.csv", [("2001-01-01 00:00:00", "1")])
    raw = series_files.read_series(spark, str(tmp_path))
    got = {(r["feature"], str(r["ts"])): (r["value"], r["fill_value"]) for r in raw.collect()}
    assert got == {
        ("dew_point", "2000-01-01 00:00:00"): (290.099243, 1e15),
        ("dew_point", "2000-02-01 00:00:00"): (1e15, 1e15),
        ("PM2_5", "2001-01-01 00:30:00"): (-999.0, -999.0),
        ("PM2_5", "2001-01-01 01:30:00"): (2e-8, -999.0),
        ("PM2_5", "2002-01-01 00:30:00"): (7.0, 1e15),
        ("precipitation", "2001-01-01 00:00:00"): (3.5, None)}
    clean = {(r["feature"], str(r["ts"])): r["value"] for r in series_files.read_clean_series(spark, str(tmp_path)).collect()}
    assert clean[("dew_point", "2000-02-01 00:00:00")] is None and clean[("PM2_5", "2001-01-01 00:30:00")] is None
    kinds = {r["feature"]: r["resolution"] for r in series_files.cadence(raw).collect()}
    assert kinds == {"dew_point": "monthly", "PM2_5": "hourly", "precipitation": "daily"}


def test_written_series_read_back(spark, tmp_path):
    rows = [(PM % "x", "v", "2001-01-01 00:00:00", 1.5), (PM % "x", "v", "2001-01-01 01:00:00", None)]
    df = spark.createDataFrame(rows, "file string, variable string, t string, value double").select(
        "file", "variable", F.to_timestamp_ntz("t").alias("ts"), "value")
    write_series(df, str(tmp_path / "out"))
    got = [r["value"] for r in series_files.read_clean_series(spark, str(tmp_path / "out")).orderBy("ts").collect()]
    assert got == [1.5, None]


@pytest.mark.parametrize("n", [5, 1500])
def test_rain_is_hourly_by_its_stamps(spark, n):
    for step, kind in (("1 day", "daily"), ("1 hour", "hourly")):
        ts = F.expr(f"timestamp_ntz '2001-01-01' + id * interval {step}").alias("ts")
        df = spark.range(n).select(F.lit("precipitation").alias("feature"), ts)
        assert series_files.cadence(df).first()["resolution"] == kind


def test_overlapping_files_and_equal_names(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "b").mkdir()
    write(tmp_path / "b", PM % "1", [("2001-01-01 00:30:00", "-999"), ("2001-01-03 00:30:00", "3")], fill="-999")
    write(tmp_path / "a", PM % "1", [("2001-01-01 00:30:00", "1"), ("2001-01-02 00:30:00", "-999")], fill="-5")
    write(tmp_path, PM % "2", [("2001-01-03 00:30:00", "8"), ("2001-01-04 00:30:00", "9")])
    rows = {str(r["ts"])[:10]: (r["value"], r["fill_value"]) for r in series_files.read_series(spark, str(tmp_path)).collect()}
    assert rows == {"2001-01-01": (1.0, -5.0), "2001-01-02": (-999.0, -5.0), "2001-01-03": (3.0, -999.0), "2001-01-04": (9.0, 1e15)}


def test_text_that_is_no_number_is_missing(spark, tmp_path):
    write(tmp_path, PM % "1", [(f"2001-01-01 0{k}:30:00", v) for k, v in enumerate(("NaN", "inf", "-Infinity", "x", "", "2.5"))])
    values = [r["value"] for r in series_files.read_clean_series(spark, str(tmp_path)).orderBy("ts").collect()]
    assert values == [None] * 5 + [2.5]


def test_saved_results_keep_missing_values_as_null(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5), ("b", None)], "k string, v double")
    path = str(tmp_path / "r")
    for _ in range(2):
        sinks.append_result(sinks.analysis_row(sinks.records_json(df, "k"), "kind", F.lit("s")), path)
    saved = spark.read.parquet(path).collect()
    assert len(saved) == 2
    assert json.loads(saved[0]["results_json"]) == {"a": {"v": 1.5}, "b": {"v": None}}


def test_table_replacement_drops_old_columns(spark, tmp_path):
    first, second = spark.range(3), spark.range(5).select(F.col("id").alias("n"))
    spark.sql("DROP TABLE IF EXISTS hazegrid_t")
    for df in (first, second):
        sinks.replace_table(df, "hazegrid_t", str(tmp_path / df.columns[0]))
    assert spark.table("hazegrid_t").columns == ["n"] and spark.table("hazegrid_t").count() == 5


def test_a_failed_replacement_changes_nothing(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS hazegrid_f")
    sinks.replace_table(spark.range(5), "hazegrid_f", str(tmp_path / "f"))
    broken = spark.table("hazegrid_f").select(F.when(F.col("id") < 3, F.col("id")).otherwise(F.raise_error(F.lit("broken")).cast("long")).alias("other"))
    with pytest.raises(Exception, match="broken"):
        sinks.replace_table(broken, "hazegrid_f", str(tmp_path / "f"))
    assert sorted(r.id for r in spark.table("hazegrid_f").collect()) == list(range(5))
    sinks.replace_table(spark.table("hazegrid_f").filter("id > 2"), "hazegrid_f", str(tmp_path / "f"))
    sinks.replace_table(spark.table("hazegrid_f").selectExpr("id", "id * 2 AS twice"), "hazegrid_f", str(tmp_path / "f"))
    assert sorted(map(tuple, spark.table("hazegrid_f").collect())) == [(3, 6), (4, 8)]
    sinks.replace_table(spark.range(0), "hazegrid_f", str(tmp_path / "f"))
    assert spark.table("hazegrid_f").count() == 0 and spark.table("hazegrid_f").columns == ["id"]


def test_only_refreshed_years_change(spark, tmp_path):
    columns = ["aqi", "PM2_5", "PM10", "temperature_mean", "humidity", "wind_speed"]
    df = spark.createDataFrame([(y, *[float(y - 2000 + k) for k in range(6)]) for y in (2001, 2002, 2003)], "year int, " + ", ".join(f"{c} double" for c in columns))
    path = str(tmp_path / "trends")
    sinks.refresh_trends(df, path)
    sinks.refresh_trends(df.filter("year = 2002").withColumn("aqi", F.lit(50.0)), path)
    broken = df.withColumn("aqi", F.when(F.col("year") < 2003, 7.0).otherwise(F.raise_error(F.lit("broken")).cast("double")))
    with pytest.raises(Exception, match="broken"):
        sinks.refresh_trends(broken, path)
    assert sorted((r.year, r.aqi_avg) for r in spark.read.parquet(path).collect()) == [(2001, 1.0), (2002, 50.0), (2003, 3.0)]


def test_csv_tables_are_read_with_types(spark, tmp_path):
    df = frame(spark, {"PM2_5": [1.0, None]}).drop("series").withColumn("year", F.year("date"))
    sinks.write_table(df, str(tmp_path / "c"), "csv")
    back = tables.read_daily(spark, str(tmp_path / "c"), df.columns)
    assert back.dtypes == [("date", "date"), ("PM2_5", "double"), ("year", "int")]
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_cluster_needs_a_named_shared_folder(spark, monkeypatch):
    class Context:
        master, applicationId = "yarn", "x"

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())


def test_code_limit_is_put_back_after_staging(spark):
    before = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    assert session.stage(spark.range(3)).count() == 3
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == before
