from datetime import datetime

import pytest
from conftest import candle_rows
from pyspark.sql import functions as F

from wickframe.operators import clean as c
from wickframe.plans.ingest import clean_and_engineer
from wickframe.sources import klines, store

COLS = "symbol string, timeframe string, seq long, open_time timestamp, open double, high double, low double, close double, volume double"


def row(day=1, seq=1, o=100.0, h=110.0, low=90.0, cl=105.0, v=1000.0):
    t = datetime(2023, 1, day) if day else None
    return ("A", "1d", seq, t, o, h, low, cl, v)


def report(spark, rows):
    df = spark.createDataFrame(rows, COLS)
    return c.cleaning_report(df).first().asDict(), c.clean_candles(df).collect()


def test_valid_rows_are_kept(spark):
    rep, rows = report(spark, [row(1), row(2, 2)])
    assert rep["rows_in"] == rep["rows_out"] == len(rows) == 2 and rep["notes"] == ""


def test_last_duplicate_wins(spark):
    rep, rows = report(spark, [row(1, 1, cl=101.0), row(1, 2, cl=102.0)])
    assert rep["dropped_duplicates"] == 1 and [r.close for r in rows] == [102.0]


@pytest.mark.parametrize(
    "bad, counter",
    [
        (dict(h=80.0), "dropped_invalid_ohlc"),
        (dict(cl=0.0), "dropped_non_positive"),
        (dict(v=-1.0), "dropped_non_positive"),
        (dict(cl=float("inf")), "dropped_inf"),
        (dict(o=None), "dropped_nulls"),
        (dict(day=None), "dropped_nulls"),
    ],
)
def test_bad_rows_are_counted(spark, bad, counter):
    rep, rows = report(spark, [row(1), row(**{"day": 2, "seq": 2, **bad})])
    assert rep[counter] == 1 and rep["rows_removed"] == 1 and len(rows) == 1


def test_bad_late_duplicate_evicts_good_row(spark):
    rep, rows = report(spark, [row(1, 1), row(2, 2), row(1, 3, h=80.0)])
    assert (rep["dropped_duplicates"], rep["dropped_invalid_ohlc"], len(rows)) == (1, 1, 1)


def test_gap(spark):
    rep, _ = report(spark, [row(1), row(3, 2)])
    assert rep["gap_count"] == 1 and rep["notes"] == "Detected 1 missing candle interval(s)"


def test_empty(spark):
    df = spark.createDataFrame([], COLS)
    assert c.clean_candles(df).count() == 0 and c.cleaning_report(df).count() == 0


def test_missing_column(spark):
    with pytest.raises(ValueError, match="Missing required OHLCV columns"):
        c.normalize_columns(spark.createDataFrame([(1,)], "open int"))


def test_strings_are_coerced(spark):
    df = spark.createDataFrame([("A", "1d", "2023-01-01", "1", "2", "0.5", "x", "NaN")], "symbol string, timeframe string, open_time string, open string, high string, low string, close string, volume string")
    r = c.coerce_types(df).first()
    assert (r.open, r.close, r.volume, r.open_time) == (1.0, None, None, datetime(2023, 1, 1))


def test_clean_and_engineer_with_bad_row(spark):
    pdf = candle_rows(120)
    df = spark.createDataFrame(pdf).withColumn("seq", F.monotonically_increasing_id())
    bad = df.orderBy("open_time").limit(1).withColumns({"high": F.lit(1.0), "seq": F.lit(1 << 60)})
    features, rep = clean_and_engineer(df.unionByName(bad))
    assert rep.first().dropped_invalid_ohlc == 1
    assert 0 < features.count() <= 119 - 19 and len(features.columns) == 48


def test_klines(spark):
    k = '[[1672531200000,"1","2","0.5","1.5","10",0,"0",1,"0","0","0"]]'
    df = spark.createDataFrame([("A", "1d", 1, k), ("A", "1d", 2, k.replace('"1.5"', '"9"'))], "symbol string, timeframe string, batch int, payload string")
    rows = klines.parse_klines(df).collect()
    assert [(r.open_time, r.close) for r in rows] == [(datetime(2023, 1, 1), 1.5)]
    with pytest.raises(ValueError, match="Unknown timeframe"):
        klines.plan_fetch_ranges(df, "99x")


def test_merge_into_store(spark, tmp_path):
    path = str(tmp_path / "table")
    store.init_store(spark, path)
    first = spark.createDataFrame(candle_rows(60))
    a = store.merge_into_store(spark, path, first, F.lit(datetime(2024, 1, 1)), str(tmp_path / "s1")).first()
    assert (a.rows_inserted, a.rows_updated) == (60, 0)
    later = spark.createDataFrame(candle_rows(70)).filter("open_time >= '2023-02-20'").withColumn("close", F.lit(1.0))
    b = store.merge_into_store(spark, path, later, F.lit(datetime(2024, 1, 2)), str(tmp_path / "s2")).first()
    assert (b.rows_inserted, b.rows_updated) == (10, 10)
    t = store.read_store(spark, path)
    assert t.count() == 70 and t.filter("close = 1").count() == 20
    fresh = later.select("symbol", "timeframe", F.date_format("open_time", "yyyy-MM").alias("month"))
    pruned = store.touched_partitions(t, fresh)
    assert {r[0] for r in pruned.select(F.date_format("open_time", "yyyy-MM")).distinct().collect()} == {"2023-02", "2023-03"}
    spark.conf.set("spark.sql.maxMetadataStringLength", 2_000)
    scan = next(x for x in pruned._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in x)
    assert "2023-02" in scan.split("PartitionFilters")[1]
    assert store.touched_partitions(t, fresh.filter("false")).count() == 0
    assert dict(spark.read.parquet(path).dtypes)["close"] == "decimal(24,8)"
    old = t.filter("open_time = '2023-02-25'").first()
    assert (old.created_at, old.updated_at) == (datetime(2024, 1, 1), datetime(2024, 1, 2))


def test_records_round_trip(spark, tmp_path):
    df = spark.createDataFrame(candle_rows(40))
    meta = store.export_dataset(df, str(tmp_path / "x")).first()
    assert (meta.total_rows, meta.train_rows, meta.test_rows) == (40, 34, 6)
    schema = "symbol string, close double"
    assert store.load_records(spark, str(tmp_path / "x/records/split=test"), schema, lines=True).count() == 6
    (tmp_path / "a.json").write_text('[{"symbol": "A", "close": 1}, {"symbol": "B", "close": 2}]')
    (tmp_path / "b.json").write_text('{"train": [{"symbol": "C", "close": 3}]}')
    assert store.load_records(spark, str(tmp_path / "a.json"), schema).count() == 2
    assert store.load_records(spark, str(tmp_path / "b.json"), schema).first().symbol == "C"
