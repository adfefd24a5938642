"""The registered queries once more, as SQL over the given tables for an independent engine."""

from __future__ import annotations

from barwright.plans.queries import AS_OF, NEWEST, SINCE, TICKER, UNIVERSE

LINE_TICKER = "concat(l_returnflag, l_linestatus, '4.SA')"
SUPPLIER_TICKER = "concat('SUP', cast(l_suppkey AS varchar), '.SA')"
BAR = '"Date", "Ticker", "Open", "High", "Low", "Close", "Volume"'


def _bars(ticker: str, name: str = "bars", where: str = "true") -> str:
    return f"""{name} AS (
  SELECT cast(l_shipdate AS date) AS "Date", {ticker} AS "Ticker",
    arg_min(floor(l_extendedprice), row(l_orderkey, floor(l_extendedprice))) AS "Open",
    max(floor(l_extendedprice)) AS "High", min(floor(l_extendedprice)) AS "Low",
    arg_max(floor(l_extendedprice), row(l_orderkey, floor(l_extendedprice))) AS "Close",
    cast(sum(l_quantity) AS bigint) AS "Volume"
  FROM lineitem WHERE {where} GROUP BY 1, 2)"""


DENSE, SCALE = _bars(LINE_TICKER), _bars(SUPPLIER_TICKER)
TRADES = f"""bars AS (
  SELECT cast(l_shipdate AS date) AS "Date", {LINE_TICKER} AS "Ticker", floor(l_extendedprice) AS "Open",
    floor(l_extendedprice) AS "High", floor(l_extendedprice) AS "Low", floor(l_extendedprice) AS "Close",
    cast(l_quantity AS bigint) AS "Volume"
  FROM lineitem)"""

_ORDER = '"Date", "Close", "Open", "High", "Low", "Volume"'
_PCT = """CASE WHEN "Open" <> 0 THEN ("Close" - "Open") / "Open" * 100
      WHEN "Close" > "Open" THEN 'Infinity'::double WHEN "Close" < "Open" THEN '-Infinity'::double
      WHEN "Close" = "Open" THEN 'NaN'::double END"""


def _full(function: str, n: int) -> str:
    return f'CASE WHEN count("Close") OVER w{n} >= {n} THEN {function}("Close") OVER w{n} END'


FEATURES = f"""features AS (
  SELECT "Date" AS data_pregao, lower(regexp_replace("Ticker", '.SA', '')) AS nome_acao,
    "Open" AS abertura, "Close" AS fechamento, "High" AS "max", "Low" AS "min", "Volume" AS volume_negociado,
    {_PCT} AS variacao_pct_dia, "High" - "Low" AS amplitude_dia,
    {_full("avg", 7)} AS media_movel_7d, {_full("avg", 14)} AS media_movel_14d, {_full("avg", 30)} AS media_movel_30d,
    {_full("stddev_samp", 7)} AS volatilidade_7d,
    lag("Close", 1) OVER w AS lag_1d, lag("Close", 2) OVER w AS lag_2d, lag("Close", 3) OVER w AS lag_3d
  FROM bars
  WINDOW w AS (PARTITION BY "Ticker" ORDER BY {_ORDER}),
    w7 AS (PARTITION BY "Ticker" ORDER BY {_ORDER} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
    w14 AS (PARTITION BY "Ticker" ORDER BY {_ORDER} ROWS BETWEEN 13 PRECEDING AND CURRENT ROW),
    w30 AS (PARTITION BY "Ticker" ORDER BY {_ORDER} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))"""

_DOUBLES = (
    "abertura fechamento max min variacao_pct_dia amplitude_dia media_movel_7d media_movel_14d "
    "media_movel_30d volatilidade_7d lag_1d lag_2d lag_3d"
).split()
_ROUNDED = ", ".join(f'round_even("{c}", 2) AS "{c}"' for c in _DOUBLES)
SILVER = f"""{FEATURES},
silver AS (SELECT data_pregao, nome_acao, volume_negociado, {_ROUNDED} FROM features
  WHERE media_movel_30d IS NOT NULL AND volatilidade_7d IS NOT NULL AND lag_3d IS NOT NULL
    AND variacao_pct_dia IS NOT NULL AND amplitude_dia IS NOT NULL AND volume_negociado IS NOT NULL)"""


def _mean2(column: str) -> str:
    return f"round_even(sum(cast(round_even({column} * 100, 0) AS bigint)) / count({column}), 0) / 100"


GOLD = f"""{SILVER},
gold AS (SELECT nome_acao, cast(date_trunc('month', data_pregao) AS date) AS mes_referencia,
    {_mean2("fechamento")} AS preco_medio_mensal,
    min(fechamento) AS preco_minimo_mensal, max(fechamento) AS preco_maximo_mensal,
    cast(sum(volume_negociado) AS bigint) AS volume_total_mensal,
    round_even(avg(volume_negociado), 2) AS volume_medio_diario,
    {_mean2("variacao_pct_dia")} AS variacao_media_diaria_pct,
    {_mean2("volatilidade_7d")} AS volatilidade_media_mensal,
    count(DISTINCT data_pregao) AS dias_negociacao
  FROM silver GROUP BY 1, 2)"""

_SILVER_TEXT_DAY = "* REPLACE (cast(data_pregao AS varchar) AS data_pregao)"
_GOLD_TEXT_MONTH = "* REPLACE (cast(mes_referencia AS varchar) AS mes_referencia)"
_LATEST = "data_pregao, nome_acao, fechamento, media_movel_7d, volatilidade_7d"
_REPORT = "mes_referencia, nome_acao, preco_medio_mensal, volume_total_mensal, dias_negociacao"
_NEWEST = "data_pregao, nome_acao, fechamento, media_movel_7d"
_DAY = "strftime(\"Date\", '%Y-%m-%d')"
_WIDE_TICKERS = ("af4", "ao4", "nf4", "no4", "rf4", "ro4")


def _rolling(*columns: str) -> str:
    rounded = ", ".join(f"round_even({c}, 2) AS {c}" for c in columns)
    return f"WITH {SCALE}, {FEATURES} SELECT nome_acao, data_pregao, {rounded} FROM features"


def _gold(columns: str) -> str:
    return f"WITH {SCALE}, {GOLD} SELECT nome_acao, mes_referencia, {columns} FROM gold"


def _wide() -> str:
    name = "lower(regexp_replace(\"Ticker\", '.SA', ''))"
    columns = ", ".join(
        f'max("{s}") FILTER ({name} = \'{t}\') AS "{s}_{t}"'
        for t in _WIDE_TICKERS
        for s in ("Close", "Open", "High", "Low", "Volume")
    )
    return f'WITH {DENSE} SELECT "Date", {columns} FROM bars GROUP BY "Date"'


_COUNTS_PER_DAY = f"WITH {DENSE} SELECT {_DAY} AS data_particao, count(*) AS n_rows FROM bars GROUP BY 1"
_ALL_DENSE = f"WITH {DENSE} SELECT {BAR} FROM bars"
_LISTED = ", ".join(f"'{t}'" for t in UNIVERSE)

ORACLES: dict[str, str] = {
    "scan_raw_count": f"WITH {DENSE} SELECT count(*) AS n_rows FROM bars",
    "bars_head": f'{_ALL_DENSE} ORDER BY "Ticker", "Date" LIMIT 5',
    "clean_bars": f"""SELECT cast(l_shipdate AS date) AS "Date", {LINE_TICKER} AS "Ticker",
        l_extendedprice AS "Open", l_extendedprice AS "High", l_extendedprice AS "Low",
        l_extendedprice AS "Close", cast(l_quantity AS bigint) AS "Volume"
      FROM lineitem WHERE l_linenumber NOT IN (5, 6, 7) AND l_extendedprice IS NOT NULL AND l_shipdate IS NOT NULL""",
    "normalize_ticker": f"""SELECT t AS "Ticker", lower(regexp_replace(t, '.SA', '')) AS nome_acao
      FROM (SELECT DISTINCT {LINE_TICKER} AS t FROM lineitem
        UNION ALL SELECT DISTINCT {SUPPLIER_TICKER} AS t FROM lineitem)""",
    "intraday_pct": f'WITH {DENSE} SELECT "Ticker", "Date", round_even({_PCT}, 2) AS variacao_pct_dia FROM bars',
    "amplitude": f'WITH {DENSE} SELECT "Ticker", "Date", "High" - "Low" AS amplitude_dia FROM bars',
    "ma_7": _rolling("media_movel_7d"),
    "ma_14": _rolling("media_movel_14d"),
    "ma_30": _rolling("media_movel_30d"),
    "vol_7": _rolling("volatilidade_7d"),
    "lags": _rolling("lag_1d", "lag_2d", "lag_3d"),
    "silver_warmup": f"WITH {SCALE}, {SILVER} SELECT nome_acao, count(*) AS n_rows FROM silver GROUP BY 1",
    "silver_round": f"WITH {DENSE}, {SILVER} SELECT * EXCLUDE (volume_negociado) FROM silver",
    "silver_full": f"WITH {SCALE}, {SILVER} SELECT * FROM silver",
    "silver_dense": f"WITH {DENSE}, {SILVER} SELECT * FROM silver",
    "silver_hot_ticker": f"WITH {TRADES}, {SILVER} SELECT * FROM silver",
    "gold_price": _gold("preco_medio_mensal, preco_minimo_mensal, preco_maximo_mensal"),
    "gold_volume": _gold("volume_total_mensal, volume_medio_diario"),
    "gold_risk": _gold("variacao_media_diaria_pct, volatilidade_media_mensal"),
    "gold_days": _gold("dias_negociacao"),
    "gold_full": f"WITH {SCALE}, {GOLD} SELECT * FROM gold ORDER BY nome_acao, mes_referencia",
    "gold_dense": f"WITH {DENSE}, {GOLD} SELECT * FROM gold",
    "gold_hot_ticker": f"WITH {TRADES}, {GOLD} SELECT * FROM gold",
    "wide_to_long": _ALL_DENSE,
    "long_to_wide": _wide(),
    "long_to_wide_roundtrip": _ALL_DENSE,
    "union_by_name": f"""WITH {DENSE}, {_bars(SUPPLIER_TICKER, "others")}
      SELECT "Date", "Ticker", "Open", "Close" FROM bars
      UNION ALL BY NAME SELECT "Ticker", "Date", "Close", "Volume" FROM others""",
    "tag_and_combine": _ALL_DENSE,
    "distinct_dates": f'WITH {DENSE} SELECT DISTINCT "Date" FROM bars ORDER BY "Date"',
    "raw_partition_counts": _COUNTS_PER_DAY,
    "landed_partition_counts": _COUNTS_PER_DAY,
    "d1_slice": f"WITH {SCALE} SELECT {BAR} FROM bars WHERE \"Date\" = DATE '{AS_OF}' - 1",
    "lookback_180d": f"""WITH {SCALE} SELECT {BAR} FROM bars
      WHERE "Date" BETWEEN DATE '{AS_OF}' - 181 AND DATE '{AS_OF}' - 1""",
    "universe_filter": f'{_ALL_DENSE} WHERE "Ticker" IN ({_LISTED})',
    "universe_table": f"""WITH {_bars(SUPPLIER_TICKER,
        where="l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)")} SELECT {BAR} FROM bars""",
    "q_latest_days": f"""WITH {DENSE}, {SILVER} SELECT {_LATEST} FROM silver
      WHERE nome_acao = '{TICKER}' AND data_pregao >= DATE '{AS_OF}' - 10 ORDER BY data_pregao DESC""",
    "q_monthly_all": f"WITH {DENSE}, {GOLD} SELECT {_REPORT} FROM gold ORDER BY mes_referencia DESC, nome_acao",
    "q_since_topn": f"""WITH {SCALE}, {SILVER} SELECT {_NEWEST} FROM silver
      WHERE data_pregao >= DATE '{SINCE}' ORDER BY data_pregao DESC, nome_acao LIMIT 10""",
    "q_ticker_since": f"""WITH {DENSE}, {SILVER} SELECT * FROM silver
      WHERE nome_acao = '{TICKER}' AND data_pregao >= DATE '{SINCE}' ORDER BY data_pregao LIMIT 10""",
    "table_latest_days": f"""WITH {DENSE}, {SILVER}
      SELECT {_LATEST.replace("data_pregao", "cast(data_pregao AS varchar) AS data_pregao", 1)} FROM silver
      WHERE nome_acao = '{TICKER}' AND silver.data_pregao >= DATE '{AS_OF}' - 10 ORDER BY 1 DESC""",
    "table_monthly_all": f"""WITH {DENSE}, {GOLD}
      SELECT {_REPORT.replace("mes_referencia", "cast(mes_referencia AS varchar) AS mes_referencia", 1)} FROM gold
      ORDER BY 1 DESC, nome_acao""",
    "table_since_topn": f"""WITH {DENSE}, {SILVER}
      SELECT {_NEWEST.replace("data_pregao", "cast(data_pregao AS varchar) AS data_pregao", 1)} FROM silver
      WHERE silver.data_pregao >= DATE '{SINCE}' ORDER BY 1 DESC, nome_acao LIMIT 10""",
    "table_ticker_since": f"""WITH {DENSE}, {SILVER} SELECT {_SILVER_TEXT_DAY} FROM silver
      WHERE nome_acao = '{TICKER}' AND silver.data_pregao >= DATE '{SINCE}' ORDER BY silver.data_pregao LIMIT 10""",
    "lake_silver": f"WITH {DENSE}, {SILVER} SELECT {_SILVER_TEXT_DAY} FROM silver",
    "lake_gold": f"WITH {DENSE}, {GOLD} SELECT {_GOLD_TEXT_MONTH} FROM gold",
    "lake_partitions": f"""WITH {DENSE}, {GOLD}
      SELECT DISTINCT concat('data_pregao=', cast(data_pregao AS varchar)) AS partition FROM silver
      UNION ALL SELECT DISTINCT concat('mes_referencia=', cast(mes_referencia AS varchar)) AS partition FROM gold""",
    "partition_overwrite": f"""WITH {DENSE}
      SELECT "Date", cast(sum(CASE WHEN "Date" >= DATE '{SINCE}' THEN 2 ELSE 1 END * "Volume") AS bigint) AS volume
      FROM bars GROUP BY 1""",
    "run_stats": f"""WITH {DENSE}, {GOLD}
      SELECT 'raw' AS table_name, count(*) AS n_rows, count(DISTINCT "Ticker") AS n_tickers,
        cast(7 AS integer) AS n_columns FROM bars
      UNION ALL SELECT 'refined', count(*), count(DISTINCT nome_acao), 16 FROM silver
      UNION ALL SELECT 'monthly', count(*), count(DISTINCT nome_acao), 10 FROM gold""",
    "dry_run_counts": f"""WITH {DENSE}
      SELECT count(*) AS n_rows, count(DISTINCT "Ticker") AS n_tickers, true AS dry_run FROM bars""",
    "table_recreated": f"WITH {DENSE}, {SILVER} SELECT {_SILVER_TEXT_DAY} FROM silver",
    "table_dropped": f"WITH {DENSE}, {GOLD} SELECT false AS has_entry, count(*) AS n_rows FROM gold",
    "partitions_added": f"""WITH {DENSE}, {SILVER} SELECT {_SILVER_TEXT_DAY} FROM silver
      WHERE data_pregao >= DATE '{NEWEST}'""",
    "catalog_failure": f"""WITH {DENSE}, {SILVER}
      SELECT 'ok' AS status, false AS catalog_ok, count(*) AS n_rows FROM silver""",
    "landing_marker": f"WITH {DENSE} SELECT count(*) AS n_rows, true AS complete FROM bars",
    "empty_batch": f"WITH {DENSE} SELECT count(*) AS n_raw, 'no_data' AS status, false AS written FROM bars",
    "flattened_header": _wide(),
    "parsed_timestamps": "SELECT cast(l_shipdate AS date) AS day, count(*) AS n_rows FROM lineitem GROUP BY 1",
    "plain_layout": _ALL_DENSE,
    "tied_newest": f"""WITH {_bars(LINE_TICKER, "single")}, bars AS (
      SELECT * FROM single UNION ALL SELECT * FROM single
      UNION ALL SELECT * REPLACE (replace("Ticker", '.SA', '') AS "Ticker", "Volume" + 1 AS "Volume") FROM single), {SILVER}
      SELECT data_pregao, nome_acao, fechamento, media_movel_7d FROM silver WHERE data_pregao >= DATE '{SINCE}'
      ORDER BY data_pregao DESC, data_pregao, nome_acao, fechamento, media_movel_7d LIMIT 25""",
    "stream_equals_batch": f"WITH {DENSE}, {SILVER} SELECT {_SILVER_TEXT_DAY} FROM silver",
    "stream_gold_equals_batch": f"WITH {DENSE}, {GOLD} SELECT {_GOLD_TEXT_MONTH} FROM gold",
}
