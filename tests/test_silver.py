import math
import random
import statistics

import pytest
from conftest import BARS, day, rows, series
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barwright.config import FeatureSpec
from barwright.operators.clean import clean_bars
from barwright.operators.rolling import handed_on, piece_count
from barwright.operators.silver import silver
from barwright.schema import SILVER_COLUMNS, SILVER_SCHEMA

NAN = float("nan")


def frame(spark, data):
    return spark.createDataFrame(data, BARS)


def brute_force(data, depth=29):
    """Refined rows of plain tuples, straight from the definitions; prices are whole numbers."""
    found = []
    for ticker in {r[1] for r in data}:
        ordered = sorted((r for r in data if r[1] == ticker), key=lambda r: (r[0], r[5], r[2], r[3], r[4], r[6]))
        closes = [r[5] for r in ordered]
        for i in range(depth, len(ordered)):
            date, _, o, h, low, c, v = ordered[i]

            def mean(n, i=i):
                return round(sum(closes[i - n + 1 : i + 1]) / n * 100) / 100

            found.append(
                (date, ticker.lower(), o, c, h, low, v, round((c - o) / o * 100 * 100) / 100, h - low, mean(7),
                 mean(14), mean(30), round(statistics.stdev(closes[i - 6 : i + 1]) * 100) / 100,
                 closes[i - 1], closes[i - 2], closes[i - 3])
            )
    return sorted(tuple(str(v) for v in r) for r in found)


def test_schema_and_order_of_columns(spark):
    df = silver(frame(spark, series("A", 31)))
    assert df.columns == list(SILVER_COLUMNS)
    assert [f.dataType for f in df.schema] == [f.dataType for f in SILVER_SCHEMA]


def test_warm_up(spark):
    data = series("A", 29) + series("B", 30) + series("C", 31) + series("D", 45, step=3)
    df = silver(frame(spark, data))
    counts = {r["nome_acao"]: r["count"] for r in df.groupBy("nome_acao").count().collect()}
    assert counts == {"b": 1, "c": 2, "d": 16}
    assert rows(df) == brute_force(data)


def test_windows_count_rows_not_calendar_days(spark):
    data = series("A", 40, step=5)
    assert rows(silver(frame(spark, data), one_bar_per_day=True)) == brute_force(data)


def test_nulls_and_nans(spark):
    data = series("A", 33)
    data[31] = (*data[31][:2], None, *data[31][3:])  # no open: the row goes, its close still counts
    data[32] = (*data[32][:5], NAN, data[32][6])  # NaN close: the row stays
    df = silver(clean_bars(frame(spark, data)))
    found = {r["data_pregao"]: r for r in df.collect()}
    assert set(found) == {day(29), day(30), day(32)}
    assert math.isnan(found[day(32)]["media_movel_7d"]) and math.isnan(found[day(32)]["fechamento"])
    assert found[day(32)]["lag_1d"] == data[31][5]


def test_zero_open_keeps_the_row(spark):
    data = series("A", 30)
    data[29] = (day(29), "A", 0.0, 1.0, 0.0, 5.0, 7)
    row = silver(frame(spark, data)).first()
    assert row["variacao_pct_dia"] == float("inf")


def test_null_scope(spark):
    bars = frame(spark, series("A", 32)).withColumn(
        "Dividends", F.when(F.col("Date") != day(30), F.lit(0.0))
    )
    assert [r[0] for r in rows(silver(bars), "data_pregao")] == [str(day(29)), str(day(31))]
    relaxed = silver(bars, FeatureSpec(null_scope="features"))
    assert relaxed.count() == 3


def test_other_windows_and_lags(spark):
    spec = FeatureSpec(mean_windows=(2, 5), std_window=3, lags=(1, 6))
    df = silver(frame(spark, series("A", 10)), spec)
    assert df.columns[9:] == ["media_movel_2d", "media_movel_5d", "volatilidade_3d", "lag_1d", "lag_6d"]
    assert spec.depth == 6 and df.count() == 4
    with pytest.raises(ValueError):
        FeatureSpec(null_scope="none")


def skewed(seed, n_copies):
    """One ticker with most rows, days with many bars, and one bar that is copied many times."""
    r = random.Random(seed)
    data = [
        (day(r.randrange(8)), "HOT", 1.0 + r.randrange(3), 9.0, 1.0, 1.0 + r.randrange(4), r.randrange(3))
        for _ in range(300)
    ]
    data += [(day(3), "HOT", 2.0, 9.0, 1.0, 3.0, 1)] * n_copies
    data += series("COLD", 35) + series("FEW", 5)
    r.shuffle(data)
    return data


@pytest.mark.parametrize("pieces", [70, 12, 5, 1, None])
def test_pieces_of_tickers_give_the_same_rows(spark, pieces):
    data = skewed(pieces or 3, 200)
    df = silver(frame(spark, data), FeatureSpec(pieces=pieces))
    assert rows(df) == brute_force(data)


def test_copies_are_spread_over_pieces(spark):
    data = skewed(2, 500)
    assert rows(silver(frame(spark, data), FeatureSpec(pieces=17))) == brute_force(data)


def test_oversized_ticker_with_extra_columns(spark):
    bars = frame(spark, skewed(3, 100)).withColumn("note", F.when(F.col("Volume") != 2, "x"))
    plain, cut = silver(bars, FeatureSpec(pieces=1)), silver(bars, FeatureSpec(pieces=9))
    assert plain.count() > 0 and rows(plain) == rows(cut)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.integers(0, 45), min_size=1, max_size=4),
    st.integers(3, 60),
    st.randoms(use_true_random=False),
)
def test_rows_per_ticker(spark, sizes, pieces, r):
    data = [bar for k, n in enumerate(sizes) for bar in series(f"T{k}", n, step=r.choice([0, 1, 4]))]
    if not data:
        return
    df = silver(frame(spark, data), FeatureSpec(pieces=pieces))
    assert rows(df) == brute_force(data)
    assert df.count() == sum(max(0, n - 29) for n in sizes)


def test_what_pieces_hand_on(spark):
    """Pieces of 1 to 3 rows: rows reach beyond their successor, and stop after `depth` rows."""
    rng = random.Random(4)
    data, piece, at = [], 0, 0
    for ticker, n in (("A", 40), ("B", 2), ("C", 9)):
        for _ in range(n):
            if rng.random() < 0.5:
                piece += rng.randint(1, 3)  # some pieces are empty
            data.append((ticker, at, piece))
            at += 1
    found = handed_on(spark.createDataFrame(data, "Ticker string, at int, _piece int"), 5, ["at"])
    expected = set()
    for ticker, group in {(t, p) for t, _, p in data}:
        before = sorted(a for t, a, p in data if t == ticker and p < group)[-5:]
        expected |= {(ticker, a, group) for a in before}
    got = [(r["Ticker"], r["at"], r["_piece"]) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == expected


def test_pieces_meet_by_equality_only(spark, sf_dir):
    from barwright.plans.queries import QUERIES

    plan = QUERIES["silver_hot_ticker"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert not any(sign in line for line in joins for sign in ("<=", ">=", " < ", " > "))


def test_piece_count_follows_the_bytes(spark, folder, monkeypatch):
    spark.range(500_000).write.parquet(f"{folder}/some")
    frame = spark.read.parquet(f"{folder}/some")
    assert piece_count(frame) == spark.sparkContext.defaultParallelism
    monkeypatch.setattr("barwright.operators.rolling._PIECE_BYTES", 1 << 16)
    few = piece_count(frame)
    assert spark.sparkContext.defaultParallelism < few < piece_count(frame.union(frame)) <= 2 * few
