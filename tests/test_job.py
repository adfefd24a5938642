import datetime as dt
import os
import random

import pytest
from conftest import BARS, day, rows, series
from pyspark.sql import functions as F

from barwright import FeatureSpec, PipelineConfig, configure_session
from barwright.operators.gold import monthly
from barwright.operators.silver import silver
from barwright.plans import serve
from barwright.plans.job import run, run_changed
from barwright.schema import GOLD_SCHEMA, RAW_COLUMNS, SILVER_SCHEMA
from barwright.sinks import catalog
from barwright.sinks.files import land_raw, save_partitioned
from barwright.sources.folders import Tree
from barwright.sources.raw import read_bars
from barwright.sources.tables import read_partitions
from barwright.streaming.refresh import refresh_on_new_files


def config(folder, name, **changes):
    return PipelineConfig(
        raw_path=f"{folder}/raw",
        silver_path=f"{folder}/{name}/refined",
        gold_path=f"{folder}/{name}/agg",
        silver_table=f"refined_{abs(hash((folder, name)))}",
        gold_table=f"agg_{abs(hash((folder, name)))}",
        **changes,
    )


def stored(spark, cfg):
    refined = read_partitions(spark, cfg.silver_path, cfg.features.silver_schema, "data_pregao")
    agg = read_partitions(spark, cfg.gold_path, GOLD_SCHEMA, "mes_referencia")
    return rows(refined), rows(agg)


def test_smoke_scenario(spark, folder):
    """Thirty days of two tickers, landed by day, give one refined row and one month each."""
    configure_session(spark)
    end = dt.datetime(2024, 6, 10, 15, 30)
    data = []
    for k, ticker in enumerate(["PETR4.SA", "VALE3.SA"]):
        for i in range(30):
            h = (7 * i + 3 * k) % 10
            data.append((end - dt.timedelta(days=29 - i), ticker, 30.0 + h, 32.0 + h, 28.0 + h, 31.0 + h, 10**6 + h))
    raw = spark.createDataFrame(data, BARS.replace("Date date", "Date timestamp_ntz"))
    land_raw(raw, f"{folder}/raw")
    assert len([d for d in os.listdir(f"{folder}/raw") if d.startswith("data_particao=2024-")]) == 30
    assert os.path.exists(f"{folder}/raw/_SUCCESS")
    cfg = config(folder, "lake")
    result = run(spark, cfg)
    assert (result.status, result.raw_rows, result.raw_tickers) == ("ok", 60, 2)
    assert (result.silver_rows, result.gold_rows, result.tickers, result.features) == (2, 2, 2, 16)
    assert result.catalog_ok and result.catalog_error is None
    table = spark.table(f"{cfg.database}.{cfg.silver_table}")
    assert rows(table, "nome_acao", "data_pregao") == [("petr4", "2024-06-10"), ("vale3", "2024-06-10")]
    assert dict(table.dtypes)["data_pregao"] == "string"
    gold = spark.table(f"{cfg.database}.{cfg.gold_table}").collect()
    assert {(r["nome_acao"], r["mes_referencia"], r["dias_negociacao"]) for r in gold} == {
        ("petr4", "2024-06-01", 1),
        ("vale3", "2024-06-01", 1),
    }
    assert serve.ticker_since(table, "petr4", dt.date(2024, 6, 10)).count() == 1
    assert serve.latest_days(table, "petr4", dt.date(2024, 6, 21)).count() == 0
    # again: nothing changes
    before = stored(spark, cfg)
    assert run(spark, cfg) == result and stored(spark, cfg) == before


def test_dry_run_and_empty_input_write_nothing(spark, folder):
    land_raw(spark.createDataFrame(series("A", 40), BARS), f"{folder}/raw")
    cfg = config(folder, "lake")
    result = run(spark, cfg, dry_run=True)
    assert (result.status, result.raw_rows, result.raw_tickers) == ("dry_run", 40, 1)
    nobody = config(folder, "lake", universe=("NOBODY",))
    assert run(spark, nobody).status == "no_data"
    assert not os.path.exists(f"{folder}/lake")


def test_too_short_history(spark, folder):
    land_raw(spark.createDataFrame(series("A", 29), BARS), f"{folder}/raw")
    result = run(spark, config(folder, "lake"))
    assert (result.status, result.raw_rows, result.silver_rows) == ("ok", 29, 0)


def test_universe_and_oversized_ticker(spark, folder):
    data = series("A", 50) + series("B", 50) + series("B", 40)
    land_raw(spark.createDataFrame(data, BARS), f"{folder}/raw")
    cfg = config(folder, "lake", universe=("B",), features=FeatureSpec(pieces=4), register=False)
    result = run(spark, cfg)
    assert (result.tickers, result.silver_rows, result.catalog_ok) == (1, 61, None)
    expected = silver(spark.createDataFrame([r for r in data if r[1] == "B"], BARS))
    assert stored(spark, cfg) == (rows(expected), rows(monthly(expected)))


def test_catalog_failure_keeps_the_data(spark, folder):
    land_raw(spark.createDataFrame(series("A", 31), BARS), f"{folder}/raw")
    cfg = config(folder, "lake", database="no_such_database")
    result = run(spark, cfg)
    assert result.status == "ok" and result.catalog_ok is False and "no_such_database" in result.catalog_error
    assert len(stored(spark, cfg)[0]) == 2


def test_partitions_absent_from_a_run_stay(spark, folder):
    old = spark.createDataFrame([(day(0), 1), (day(1), 1)], "d date, x int")
    save_partitioned(old, f"{folder}/t", "d")
    save_partitioned(spark.createDataFrame([(day(1), 2)], "d date, x int"), f"{folder}/t", "d")
    assert rows(spark.read.parquet(f"{folder}/t"), "d", "x") == [(str(day(0)), "1"), (str(day(1)), "2")]
    files = [f for f in os.listdir(f"{folder}/t/d={day(0)}") if f.endswith(".parquet")]
    assert "d" not in spark.read.parquet(f"{folder}/t/d={day(0)}/{files[0]}").columns


def test_files_per_day_can_be_bounded(spark, folder):
    save_partitioned(spark.range(10).withColumn("d", F.lit(day(0))), f"{folder}/t", "d", max_records_per_file=4)
    assert len([f for f in os.listdir(f"{folder}/t/d={day(0)}") if f.endswith(".parquet")]) == 3


def test_catalog(spark, folder, monkeypatch):
    name, path = f"default.t_{abs(hash(folder))}", f"{folder}/t"
    df = silver(spark.createDataFrame(series("A", 33), BARS))
    save_partitioned(df, path, "data_pregao")
    catalog.create_table(spark, name, SILVER_SCHEMA, "data_pregao", path)
    assert spark.table(name).count() == 0
    catalog.add_partitions(spark, name, "data_pregao", [str(day(30)), str(day(29))])
    catalog.add_partitions(spark, name, "data_pregao", [str(day(30))])
    assert spark.table(name).count() == 2
    catalog.repair(spark, name)
    assert spark.table(name).count() == 4
    assert [r[0] for r in catalog.list_partitions(spark, name).collect()] == [
        f"data_pregao={day(i)}" for i in range(29, 33)
    ]
    plan = spark.table(name).where(F.col("data_pregao") >= str(day(31)))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(data_pregao" in plan
    # an unchanged table is kept with its partitions, a changed one is made anew over the same files
    catalog.ensure_table(spark, name, SILVER_SCHEMA, "data_pregao", path)
    assert spark.table(name).count() == 4
    catalog.ensure_table(spark, name, GOLD_SCHEMA, "mes_referencia", path)
    assert "mes_referencia" in spark.table(name).columns

    def fail(*_):
        raise RuntimeError("no discovery")

    monkeypatch.setattr(catalog, "repair", fail)
    catalog.publish(spark, name, SILVER_SCHEMA, "data_pregao", path, [str(day(32))])
    assert spark.table(name).count() == 1
    catalog.drop_table(spark, name)
    assert not spark.catalog.tableExists(name) and spark.read.parquet(path).count() == 4


def test_serving_accepts_dates_and_text(spark):
    df = silver(spark.createDataFrame(series("A", 60) + series("B", 45), BARS))
    text = df.withColumn("data_pregao", F.col("data_pregao").cast("string"))
    for ask in (
        lambda t: serve.latest_days(t, "a", day(58)),
        lambda t: serve.newest_since(t, day(40)),
        lambda t: serve.ticker_since(t, "b", day(40)),
    ):
        assert [tuple(map(str, r)) for r in ask(df).collect()] == [tuple(map(str, r)) for r in ask(text).collect()]
    newest = serve.newest_since(df, day(40), 3).collect()
    assert [(r["data_pregao"], r["nome_acao"]) for r in newest] == [(day(59), "a"), (day(58), "a"), (day(57), "a")]


@pytest.mark.parametrize("seed", [1, 2])
def test_changed_days_give_the_result_of_a_full_run(spark, folder, seed):
    """Daily, thin and new tickers; the arrivals are late, repeated or the newest days."""
    r = random.Random(seed)
    data = series("A", 150) + series("THIN", 40, step=4) + series("NEW", 33, start=117) + series("GONE", 35)
    data += [b for b in series("GAPS", 150) if r.random() < 0.6] + series("A", 3, start=90)
    cut = sorted(r.sample(range(30, 150), 3))

    def between(a, b):
        return [b_ for b_ in data if day(a) <= b_[0] < day(b)]

    arrivals = [between(0, cut[0]) + between(cut[1], cut[2]), between(cut[0], cut[1]), between(cut[2], 400)]
    cfg, full = config(folder, "step", register=False), config(folder, "full", register=False)
    for bars in arrivals:
        new = spark.createDataFrame(bars, BARS)
        land_raw(new, f"{folder}/raw")
        run_changed(spark, cfg, new)
    run(spark, full)
    assert stored(spark, cfg) == stored(spark, full)
    assert len(stored(spark, cfg)[0]) > 100
    # a day is corrected: one ticker's bar is gone, another one's has a new price
    d = day(cut[0])
    fixed = [(*b[:5], 99.0, b[6]) for b in data if b[0] == d and b[1] == "A"]
    land_raw(spark.createDataFrame(fixed, BARS), f"{folder}/raw")
    run_changed(spark, cfg, spark.createDataFrame(fixed, BARS))
    rebuilt = config(folder, "rebuilt", register=False)
    run(spark, rebuilt)
    assert stored(spark, cfg) == stored(spark, rebuilt)


def test_incremental_run_leaves_other_days_alone(spark, folder):
    land_raw(spark.createDataFrame(series("A", 100), BARS), f"{folder}/raw")
    cfg = config(folder, "lake", register=False)
    run(spark, cfg)

    def names():
        root = cfg.silver_path
        return {d: os.listdir(f"{root}/{d}") for d in os.listdir(root) if d.startswith("data_pregao")}

    before, late = names(), spark.createDataFrame([(day(40), "B", 1.0, 1.0, 1.0, 1.0, 1)], BARS)
    land_raw(late.unionByName(spark.createDataFrame([series("A", 41)[40]], BARS)), f"{folder}/raw")
    run_changed(spark, cfg, late)
    changed = {d for d, files in names().items() if files != before[d]}
    assert changed == {f"data_pregao={day(i)}" for i in range(40, 70)}


@pytest.mark.parametrize("full", [False, True])
def test_stream_equals_batch(spark, folder, full):
    cfg, batch = config(folder, "stream"), config(folder, "batch", register=False)
    wide = spark.createDataFrame(series("A", 45) + series("B", 45), BARS)
    from barwright.operators.shape import long_to_wide

    results = []

    def arrive(df):
        land_raw(df, f"{folder}/raw")
        query = refresh_on_new_files(
            spark, cfg, f"{folder}/checkpoint", full, on_result=lambda i, result: results.append(result)
        )
        query.awaitTermination()

    arrive(long_to_wide(wide.where(F.col("Date") < day(35)), ["A", "B"]))
    last_days = wide.where(F.col("Date") >= day(35)).withColumn("Volume", F.col("Volume").cast("double"))
    arrive(long_to_wide(last_days.where("Ticker = 'A'"), ["A"]))
    refresh_on_new_files(spark, cfg, f"{folder}/checkpoint", full,
                         on_result=lambda i, result: results.append(result)).awaitTermination()
    assert [r.status for r in results] == ["ok", "ok"]
    run(spark, batch)
    assert stored(spark, cfg) == stored(spark, batch)
    assert spark.table(f"{cfg.database}.{cfg.silver_table}").count() == 16 + 6
    assert rows(read_bars(spark, cfg.raw_path), *RAW_COLUMNS)[0][1] == "A"


def test_withdrawn_bars(spark, folder):
    """A null close on one day, another price later, a whole day withdrawn, and a landing of withdrawn bars only."""
    cfg, fresh = config(folder, "step", register=False), config(folder, "fresh", register=False)
    data = series("A", 80) + series("B", 80) + [(day(200), "LONE", *[1.0] * 4, 1)] + series("GONE", 31, start=300)

    def landed(bars, **changed):
        land_raw(spark.createDataFrame(bars, BARS), f"{folder}/raw")

    landed(data)
    run(spark, cfg)
    assert any(r[1] == "gone" for r in stored(spark, cfg)[0])
    missing = [(*b[:5], None, b[6]) for b in data if b[0] == day(40)]
    new_price = [(*b[:5], 77.0, b[6]) for b in data if b[0] == day(45)]
    landed(missing + new_price)
    run_changed(spark, cfg, [day(40), day(45)])
    run(spark, fresh)
    assert stored(spark, cfg) == stored(spark, fresh)
    assert not any(r[0] == str(day(40)) for r in stored(spark, cfg)[0])
    gone = [(*b[:5], None, b[6]) for b in data if b[1] == "GONE"]
    landed(gone)
    result = run_changed(spark, cfg, [b[0] for b in gone])
    assert result.status == "ok"
    again = config(folder, "again", register=False)
    run(spark, again)
    assert stored(spark, cfg) == stored(spark, again)
    assert not any(r[1] == "gone" for table in stored(spark, cfg) for r in table)


@pytest.mark.parametrize("dies_at", ["log", "first move", "removal", "cleanup"])
def test_a_run_that_dies_is_completed_by_the_next(spark, folder, monkeypatch, dies_at):
    """Days written and days removed take effect together, wherever the writer stops."""
    cfg, fresh = config(folder, "step", register=False), config(folder, "fresh", register=False)
    b, gone = series("B", 40, start=300), series("GONE", 40, start=310)
    land_raw(spark.createDataFrame(series("A", 40) + b + gone, BARS), f"{folder}/raw")
    run(spark, cfg)
    before = stored(spark, cfg)
    assert str(day(349)) in {r[0] for r in before[0]}
    withdrawn = [(*bar[:5], None, bar[6]) for bar in gone]
    changed = [(*bar[:5], 50.0 if bar[0] >= day(335) else bar[5], bar[6]) for bar in b if bar[0] >= day(310)]
    land_raw(spark.createDataFrame(withdrawn + changed, BARS), f"{folder}/raw")
    days = sorted({bar[0] for bar in withdrawn})
    run(spark, fresh)

    class Killed(Exception):
        pass

    move, remove, seen = Tree.move, Tree.remove, []

    def dying_move(self, source, target):
        if dies_at == "log" and source.endswith(".new"):
            raise Killed
        if dies_at == "first move" and "_staged-" in source and seen:
            raise Killed
        seen.append(source)
        move(self, source, target)

    def dying_remove(self, path):
        if dies_at == "removal" and "=" in path or dies_at == "cleanup" and path.endswith(".json"):
            raise Killed
        remove(self, path)

    with monkeypatch.context() as patched:
        patched.setattr(Tree, "move", dying_move)
        patched.setattr(Tree, "remove", dying_remove)
        with pytest.raises(Killed):
            run_changed(spark, cfg, days)
    if dies_at == "log":  # not decided: nothing has changed
        assert stored(spark, cfg) == before
        run_changed(spark, cfg, days)
    else:  # decided: the next call completes it, without the days being named again
        assert run_changed(spark, cfg, []).status == "no_data"
    assert stored(spark, cfg) == stored(spark, fresh)
    for table in (cfg.silver_path, cfg.gold_path):
        assert not [n for n in os.listdir(table) if n.startswith("_staged-")]
    assert os.listdir(f"{cfg.silver_path}/_commits") == []


def test_a_refresh_opens_only_the_folders_of_its_range(spark, folder, monkeypatch):
    from barwright.plans import job

    land_raw(spark.createDataFrame(series("A", 400), BARS), f"{folder}/raw")
    cfg = config(folder, "lake", register=False)
    run(spark, cfg)
    land_raw(spark.createDataFrame(series("A", 401)[-1:], BARS), f"{folder}/raw")
    opened, frames = [], job.raw_frames
    monkeypatch.setattr(job, "raw_frames", lambda spark, paths, schema=None: opened.append(paths) or frames(spark, paths, schema))
    run_changed(spark, cfg, [day(400)])
    names = {p.rsplit("=", 1)[1] for paths in opened for p in paths}
    assert min(names) >= str(day(400 - 87)) and max(names) == str(day(400))
    fresh = config(folder, "fresh", register=False)
    run(spark, fresh)
    assert stored(spark, cfg) == stored(spark, fresh)


def test_plain_day_folders_are_refreshed_too(spark, folder):
    cfg, fresh = config(folder, "lake", register=False), config(folder, "fresh", register=False)
    land_raw(spark.createDataFrame(series("A", 60), BARS), f"{folder}/raw", plain=True)
    assert str(day(3)) in os.listdir(f"{folder}/raw")
    run(spark, cfg)
    land_raw(spark.createDataFrame([(*b[:5], 50.0, b[6]) for b in series("A", 60)[50:51]], BARS), f"{folder}/raw", plain=True)
    run_changed(spark, cfg, [day(50)])
    run(spark, fresh)
    assert stored(spark, cfg) == stored(spark, fresh)


def test_a_new_extra_column_concerns_all_rows(spark, folder):
    cfg, fresh = config(folder, "lake", register=False), config(folder, "fresh", register=False)
    land_raw(spark.createDataFrame(series("A", 60), BARS), f"{folder}/raw")
    run(spark, cfg)
    extra = spark.createDataFrame(series("A", 61)[-1:], BARS).withColumn("note", F.lit("x"))
    land_raw(extra, f"{folder}/raw")
    run_changed(spark, cfg, [day(60)])
    run(spark, fresh)
    assert stored(spark, fresh)[0] == [r for r in stored(spark, cfg)[0] if r[0] == str(day(60))] != []


def test_no_refresh_while_a_landing_is_under_way(spark, folder):
    cfg = config(folder, "lake", register=False)
    land_raw(spark.createDataFrame(series("A", 40), BARS), f"{folder}/raw")
    os.remove(f"{folder}/raw/_SUCCESS")
    assert refresh_on_new_files(spark, cfg, f"{folder}/checkpoint") is None
    open(f"{folder}/raw/_SUCCESS", "w").close()
    refresh_on_new_files(spark, cfg, f"{folder}/checkpoint").awaitTermination()
    assert len(stored(spark, cfg)[0]) == 11


def test_a_managed_table_is_never_dropped(spark, folder):
    name = f"default.managed_{abs(hash(folder))}"
    spark.range(5).write.saveAsTable(name)
    with pytest.raises(ValueError, match="not an external table"):
        catalog.ensure_table(spark, name, SILVER_SCHEMA, "data_pregao", f"{folder}/t")
    with pytest.raises(ValueError, match="not an external table"):
        catalog.drop_table(spark, name)
    assert spark.table(name).count() == 5
    spark.sql(f"DROP TABLE {name}")


def test_top_rows_do_not_depend_on_the_partitions(spark):
    bars = spark.createDataFrame(series("A.SA", 60) + series("A.SA", 60), BARS)
    alike = bars.withColumn("Ticker", F.lit("A")).withColumn("Close", F.col("Close") + 1)
    refined = silver(bars.unionByName(alike)).persist()
    asks = (
        lambda t: serve.latest_days(t, "a", day(58)),
        lambda t: serve.newest_since(t, day(40), 7),
        lambda t: serve.ticker_since(t, "a", day(40), 7),
    )
    for ask in asks:
        assert len({str(ask(refined.repartition(n)).collect()) for n in (1, 2, 5, 9)}) == 1


def test_the_newest_rows_open_few_days(spark, folder):
    rng = random.Random(3)
    data = [(day(k), f"T{t}", *[float(k + t)] * 5, t) for k in range(30) for t in range(rng.choice([0, 1, 2, 5]))]
    per_day = spark.createDataFrame(data, "data_pregao date, nome_acao string, a double, b double, c double, d double, fechamento double, x int")
    per_day = per_day.select("data_pregao", "nome_acao", "fechamento", F.col("a").alias("media_movel_7d"))
    path = f"{folder}/table"
    save_partitioned(per_day, path, "data_pregao")
    whole = read_partitions(spark, path, per_day.schema, "data_pregao")
    for since in (day(0), day(20), day(28), day(99)):
        for n in (1, 3, 10, 1000):
            bound = serve.newest_bound(spark, path, per_day.schema, "data_pregao", since, n)
            later = [d for d, *_ in data if d >= bound]
            assert bound >= since
            if len(later) >= n:
                present = sorted({d for d in later}, reverse=True)
                least = next(k for k in range(1, len(present) + 1) if sum(d >= present[k - 1] for d in later) >= n)
                assert len(present) <= 2 * least + 1
            else:
                assert bound == since
            few = serve.newest_since(whole.where(F.col("data_pregao") >= bound), since, n)
            assert [tuple(r) for r in few.collect()] == [tuple(r) for r in serve.newest_since(whole, since, n).collect()]
