import datetime as dt

from conftest import BARS, day, rows, series

from barwright.operators.gold import monthly
from barwright.operators.silver import silver
from barwright.schema import GOLD_COLUMNS, GOLD_SCHEMA, SILVER_SCHEMA

NAN = float("nan")


def refined(spark, *bars):
    """(day, ticker, close, volume, pct, std) to refined rows."""
    data = [(d, t, 1.0, c, 1.0, 1.0, v, p, 1.0, 1.0, 1.0, 1.0, s, 1.0, 1.0, 1.0) for d, t, c, v, p, s in bars]
    return spark.createDataFrame(data, SILVER_SCHEMA)


def test_monthly_values(spark):
    df = monthly(
        refined(
            spark,
            (dt.date(2024, 1, 30), "a", 10.01, 100, 1.0, 0.5),
            (dt.date(2024, 1, 31), "a", 10.02, 101, -2.0, 0.25),
            (dt.date(2024, 1, 31), "a", 10.02, 101, -2.0, 0.25),  # same day twice
            (dt.date(2024, 2, 1), "a", 7.0, 5, 0.0, 0.0),
        )
    )
    assert df.columns == list(GOLD_COLUMNS)
    assert [f.dataType for f in df.schema] == [f.dataType for f in GOLD_SCHEMA]
    jan, feb = df.orderBy("mes_referencia").collect()
    assert tuple(jan) == ("a", dt.date(2024, 1, 1), 10.02, 10.01, 10.02, 302, 100.67, -1.0, 0.33, 2)
    assert tuple(feb) == ("a", dt.date(2024, 2, 1), 7.0, 7.0, 7.0, 5, 5.0, 0.0, 0.0, 1)


def test_nan_closes(spark):
    row = monthly(refined(spark, (day(0), "a", NAN, 1, 1.0, 1.0), (day(1), "a", 3.0, 1, 1.0, 1.0))).first()
    assert row["preco_minimo_mensal"] == 3.0 and row["preco_maximo_mensal"] == 3.0
    assert row["preco_medio_mensal"] != row["preco_medio_mensal"]
    assert row["dias_negociacao"] == 2


def test_all_days_of_a_month(spark):
    days = [(day(i), "a", 1.0, 1, 0.0, 0.0) for i in range(31)]
    assert monthly(refined(spark, *days, *days)).first()["dias_negociacao"] == 31


def test_windows_by_raw_ticker_months_by_normalised_one(spark):
    df = silver(spark.createDataFrame(series("ITUB4.SA", 31) + series("itub4.SA", 31), BARS))
    assert df.count() == 4
    row = monthly(df).orderBy("mes_referencia").collect()
    assert [(r["nome_acao"], r["dias_negociacao"], r["volume_total_mensal"]) for r in row] == [
        ("itub4", 2, 2 * (1029 + 1030))
    ]


def test_text_days_are_accepted(spark):
    df = refined(spark, (day(0), "a", 1.0, 1, 0.0, 0.0))
    text = df.withColumn("data_pregao", df["data_pregao"].cast("string"))
    assert rows(monthly(text)) == rows(monthly(df))
