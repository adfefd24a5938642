"""Column names, table schemas and other fixed values of the data model."""

from pyspark.sql import types as T

# Names, layouts and defaults that other systems rely on.
RAW_KEYS = ("Date", "Ticker")
RAW_SERIES = ("Close", "Open", "High", "Low", "Volume")
RAW_COLUMNS = ("Date", "Ticker", "Open", "High", "Low", "Close", "Volume")
BAR_TYPES = {
    "Date": "date",
    "Ticker": "string",
    "Open": "double",
    "High": "double",
    "Low": "double",
    "Close": "double",
    "Volume": "bigint",
}
RAW_PARTITION = "data_particao"
SILVER_TABLE = "refined_stocks"
SILVER_PARTITION = "data_pregao"
GOLD_TABLE = "aggregated_stocks_monthly"
GOLD_PARTITION = "mes_referencia"
DATABASE = "default"
TICKER_SUFFIX_PATTERN = ".SA"
MEAN_WINDOWS = (7, 14, 30)
STD_WINDOW = 7
LAGS = (1, 2, 3)
DECIMALS = 2
LOOKBACK_DAYS = 180
DAY_FORMAT = "yyyy-MM-dd"
RAW_TO_SILVER = {
    "Date": "data_pregao",
    "Ticker": "nome_acao",
    "Open": "abertura",
    "Close": "fechamento",
    "High": "max",
    "Low": "min",
    "Volume": "volume_negociado",
}
# End of fixed values.

RAW_LONG_SCHEMA = T.StructType(
    [
        T.StructField("Date", T.TimestampNTZType()),
        T.StructField("Ticker", T.StringType()),
        T.StructField("Open", T.DoubleType()),
        T.StructField("High", T.DoubleType()),
        T.StructField("Low", T.DoubleType()),
        T.StructField("Close", T.DoubleType()),
        T.StructField("Volume", T.LongType()),
    ]
)


def silver_schema(mean_windows=MEAN_WINDOWS, std_window=STD_WINDOW, lags=LAGS) -> T.StructType:
    """Schema of the refined table; window and lag columns follow the parameters."""
    doubles = ["variacao_pct_dia", "amplitude_dia"]
    doubles += [f"media_movel_{n}d" for n in mean_windows]
    doubles += [f"volatilidade_{std_window}d"]
    doubles += [f"lag_{k}d" for k in lags]
    return T.StructType(
        [
            T.StructField("data_pregao", T.DateType()),
            T.StructField("nome_acao", T.StringType()),
            T.StructField("abertura", T.DoubleType()),
            T.StructField("fechamento", T.DoubleType()),
            T.StructField("max", T.DoubleType()),
            T.StructField("min", T.DoubleType()),
            T.StructField("volume_negociado", T.LongType()),
        ]
        + [T.StructField(name, T.DoubleType()) for name in doubles]
    )


GOLD_SCHEMA = T.StructType(
    [
        T.StructField("nome_acao", T.StringType()),
        T.StructField("mes_referencia", T.DateType()),
        T.StructField("preco_medio_mensal", T.DoubleType()),
        T.StructField("preco_minimo_mensal", T.DoubleType()),
        T.StructField("preco_maximo_mensal", T.DoubleType()),
        T.StructField("volume_total_mensal", T.LongType()),
        T.StructField("volume_medio_diario", T.DoubleType()),
        T.StructField("variacao_media_diaria_pct", T.DoubleType()),
        T.StructField("volatilidade_media_mensal", T.DoubleType()),
        T.StructField("dias_negociacao", T.LongType()),
    ]
)

SILVER_SCHEMA = silver_schema()
SILVER_COLUMNS = tuple(SILVER_SCHEMA.fieldNames())
GOLD_COLUMNS = tuple(GOLD_SCHEMA.fieldNames())
