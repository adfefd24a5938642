import datetime as dt
import os

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import BARS, day, rows, series
from pyspark.sql import functions as F

from barwright.operators import shape
from barwright.operators.filters import between_days, day_before, in_universe, lookback
from barwright.schema import RAW_COLUMNS, RAW_LONG_SCHEMA, RAW_PARTITION
from barwright.sinks.files import land_raw, save_partitioned
from barwright.sources import manifest
from barwright.sources.manifest import manifest_path, refresh_manifest, types_to_groups
from barwright.sources.raw import raw_frames, read_bars, scan_files


def write(folder, name, data, unit="us", tz=None, **columns):
    pdf = pd.DataFrame(data, columns=["Date", "Ticker", "Open", "High", "Low", "Close", "Volume"]).assign(**columns)
    pdf["Date"] = pd.to_datetime(pdf["Date"]).astype(f"datetime64[{unit}]")
    if tz:
        pdf["Date"] = pdf["Date"].dt.tz_localize(tz)
    path = f"{folder}/{name}"
    os.makedirs(path, exist_ok=True)
    pq.write_table(pa.Table.from_pandas(pdf, preserve_index=False), f"{path}/data.parquet")


def test_both_directory_layouts(spark, folder):
    data = series("A", 4)
    write(folder, "raw/2024-01-01", data[:2])
    write(folder, "raw/execution_date=2024-01-05/run_1/data_particao=2024-01-03", data[2:])
    open(f"{folder}/raw/_SUCCESS", "w").close()
    df = scan_files(spark, f"{folder}/raw/")
    assert df.count() == 4 and "data_particao" not in df.columns
    assert rows(read_bars(spark, f"{folder}/raw")) == rows(spark.createDataFrame(data, BARS))


def test_no_files_is_an_error(spark, folder):
    with pytest.raises(Exception, match="infer|PATH_NOT_FOUND"):
        scan_files(spark, f"{folder}/nothing").count()


@pytest.mark.parametrize("unit, tz", [("us", None), ("ns", None), ("ms", None), ("us", "UTC"), ("ns", "UTC")])
def test_timestamp_kinds(spark, folder, unit, tz):
    write(folder, "raw/x", series("A", 3), unit, tz)
    assert [r[0] for r in rows(read_bars(spark, f"{folder}/raw"), "Date")] == [str(day(i)) for i in range(3)]


def test_zoned_days_follow_the_market(spark, folder):
    write(folder, "raw/x", series("A", 3), "us", "America/Sao_Paulo")
    found = read_bars(spark, f"{folder}/raw", market_tz="America/Sao_Paulo")
    assert [r[0] for r in rows(found, "Date")] == [str(day(i)) for i in range(3)]


def test_extra_columns_are_carried(spark, folder):
    write(folder, "raw/x", series("A", 2), Dividends=0.0)
    write(folder, "raw/y", series("B", 2))
    df = read_bars(spark, f"{folder}/raw")
    assert df.columns == [*RAW_COLUMNS, "Dividends"]
    assert df.where("Dividends IS NULL").count() == 2


def foreign(frame, path):
    """As other producers write: with the types that the frame has."""
    save_partitioned(frame.withColumn(RAW_PARTITION, F.col("Date")), path, RAW_PARTITION)


def mixed_tree(spark, root):
    """Wide files with different columns, volumes as double and as bigint, one folder with both, and long files."""
    a, b, c = series("A.SA", 6), series("B.SA", 6), series("C", 3, start=20)
    first = spark.createDataFrame(a[:3] + b[:3], BARS).withColumn("Volume", F.col("Volume").cast("double"))
    foreign(shape.long_to_wide(first, ["A.SA", "B.SA"]), f"{root}/older")
    foreign(shape.long_to_wide(spark.createDataFrame(a[3:], BARS), ["A.SA"]), f"{root}/newer")
    foreign(shape.long_to_wide(spark.createDataFrame(b[3:], BARS), ["B.SA"]), f"{root}/later")
    foreign(spark.createDataFrame(c, BARS).withColumn("extra", F.lit(1)), f"{root}/long")
    moved = f"{root}/older/{RAW_PARTITION}={day(1)}"
    name = next(n for n in os.listdir(moved) if n.endswith(".parquet"))
    os.rename(f"{moved}/{name}", f"{root}/newer/{RAW_PARTITION}={day(4)}/moved.parquet")
    return rows(spark.createDataFrame(a + b + c, BARS))


def test_wide_files_with_different_columns_and_types(spark, folder):
    expected = mixed_tree(spark, f"{folder}/raw")
    frames = raw_frames(spark, f"{folder}/raw")
    assert len(frames) == 2
    assert rows(read_bars(spark, f"{folder}/raw")) == expected


def test_manifest_knows_the_files(spark, folder):
    root = f"{folder}/raw"
    expected = mixed_tree(spark, root)
    before = refresh_manifest(spark, root)
    n = before.count()
    assert n == spark.read.parquet(manifest_path(root)).count()
    # Known files are not opened again: broken ones are listed with the types they had.
    path = before.where(F.col("path").contains("long")).first()["path"].removeprefix("file:")
    stat, body = os.stat(path), open(path, "rb").read()
    with open(path, "wb") as file:
        file.write(b"x" * len(body))
    os.utime(path, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    assert rows(refresh_manifest(spark, root), "path") == rows(before, "path")
    with open(path, "wb") as file:
        file.write(body)
    os.utime(path, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    assert rows(read_bars(spark, root)) == expected


def test_manifest_follows_landings(spark, folder):
    root = f"{folder}/raw"
    data = series("A", 6)
    land_raw(spark.createDataFrame(data, BARS), root)
    refresh_manifest(spark, root)
    foreign(spark.createDataFrame([(*data[1][:6], 5)], BARS).withColumn("Volume", F.lit(5.0)), root)
    assert len(raw_frames(spark, root)) == 2  # the new file's footer is read, the others' are known
    refresh_manifest(spark, root)
    assert spark.read.parquet(manifest_path(root)).count() == 7
    for _ in range(3):  # stale rows go when they are the most
        land_raw(spark.createDataFrame(data, BARS), root)
        files = refresh_manifest(spark, root).count()
        assert files <= spark.read.parquet(manifest_path(root)).count() <= 2 * files + 7
    assert len(raw_frames(spark, root)) == 1
    assert rows(read_bars(spark, root)) == rows(spark.createDataFrame(data, BARS))


def test_files_that_only_hadoop_opens(spark, folder, monkeypatch):
    expected = mixed_tree(spark, f"{folder}/raw")
    monkeypatch.setattr(manifest, "_reachable", lambda path: False)
    assert rows(read_bars(spark, f"{folder}/raw")) == expected


def test_types_to_groups():
    files = {
        1: {"Date": "d", "V_A": "double"},
        2: {"Date": "d", "V_A": "int64", "V_B": "int64"},
        3: {"Date": "d", "V_B": "int64"},
        4: {"Date": "d", "V_A": "double", "V_C": "int64"},
    }

    def groups(chosen):
        group_of = types_to_groups(chosen)
        return sorted(sorted(k for k in group_of if group_of[k] == g) for g in set(group_of.values()))

    assert groups(files) == [[1, 3, 4], [2]]
    assert groups({k: f for k, f in files.items() if k != 2}) == [[1, 3, 4]]
    assert types_to_groups({}) == {}


def test_known_schema_needs_no_footers(spark, folder):
    write(folder, "raw/x", series("A", 3))
    assert rows(read_bars(spark, f"{folder}/raw", RAW_LONG_SCHEMA)) == rows(spark.createDataFrame(series("A", 3), BARS))


def test_landing_again_replaces_the_day_only(spark, folder):
    data = series("A", 4)
    land_raw(spark.createDataFrame(data, BARS), f"{folder}/raw")
    land_raw(spark.createDataFrame([(*data[1][:6], 5)], BARS), f"{folder}/raw")
    expected = [data[0], (*data[1][:6], 5), *data[2:]]
    assert rows(read_bars(spark, f"{folder}/raw")) == rows(spark.createDataFrame(expected, BARS))


def test_landing_parses_text_dates(spark, folder):
    text = spark.createDataFrame(series("A", 3), BARS).withColumn("Date", F.concat(F.col("Date"), F.lit(" 10:00:00")))
    land_raw(text, f"{folder}/raw")
    assert dict(scan_files(spark, f"{folder}/raw").dtypes)["Date"] == "timestamp_ntz"
    assert rows(read_bars(spark, f"{folder}/raw")) == rows(spark.createDataFrame(series("A", 3), BARS))
    with pytest.raises(Exception, match="not a date: soon"):
        land_raw(text.withColumn("Date", F.lit("soon")), f"{folder}/broken")


@pytest.mark.parametrize("kind", ["date", "timestamp_ntz", "timestamp", "string"])
def test_day_filters(spark, kind):
    bars = spark.createDataFrame(series("A", 300), BARS).withColumn("Date", F.col("Date").cast(kind))
    as_of = day(250)

    def days(df):
        return [r[0] for r in df.select(F.col("Date").cast("date")).orderBy("Date").collect()]

    assert days(day_before(bars, as_of)) == [day(249)]
    assert days(lookback(bars, as_of)) == [day(i) for i in range(69, 250)]
    assert days(lookback(bars, as_of, include_last=False)) == [day(i) for i in range(69, 249)]
    assert days(between_days(bars, None, day(1))) == [day(0), day(1)]
    assert days(between_days(bars, day(299), None)) == [day(299)]


def test_day_filter_reaches_the_scan(spark, folder):
    write(folder, "raw/x", series("A", 300))
    plan = between_days(scan_files(spark, f"{folder}/raw"), day(10), None)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(Date," in plan.split("PushedFilters")[-1]
    assert dt.date(2024, 1, 11) == day(10)


def test_universe(spark):
    bars = spark.createDataFrame(series("A", 2) + series("B", 3) + series("C", 1), BARS)
    listed = spark.createDataFrame([("A",), ("C",), ("A",)], "name string")
    assert rows(in_universe(bars, ["A", "C"])) == rows(in_universe(bars, listed))
    assert in_universe(bars, listed).count() == 3
