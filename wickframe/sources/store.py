"""The stored candle table: reads, high-water marks, merge, run log, splits and export."""

from __future__ import annotations

import json
import uuid
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wickframe.operators.blocks import DEFAULT, Layout, drop_index, index_series, top_per_series
from wickframe.schema import OHLCV, SERIES, STORED_CANDLE, TIME

PARTITIONS = ("timeframe", "symbol", "month")
MONTH = "yyyy-MM"


def read_candles(df: DataFrame, symbol: str, timeframe: str, since=None, until=None) -> DataFrame:
    """One series between two inclusive instants, in time order. Of a stored table only the months between them are read."""
    out = df.filter((F.col("symbol") == symbol) & (F.col("timeframe") == timeframe))
    if since is not None:
        out = out.filter(F.col(TIME) >= F.lit(since))
        if "month" in df.columns:
            out = out.filter(F.col("month") >= F.date_format(F.lit(since), MONTH))
    if until is not None:
        out = out.filter(F.col(TIME) <= F.lit(until))
        if "month" in df.columns:
            out = out.filter(F.col("month") <= F.date_format(F.lit(until), MONTH))
    return out.select(TIME, *OHLCV).orderBy(TIME)


def lookback_filter(df: DataFrame, asof: datetime, days: int = 730) -> DataFrame:
    return df.filter(F.col(TIME) >= F.lit(asof) - F.expr(f"interval {int(days)} days"))


def latest_n(df: DataFrame, n: int = 200) -> DataFrame:
    """Newest ``n`` candles of every series."""
    return top_per_series(df, n, [F.col(TIME).desc()]).drop("_r")


def latest_price(df: DataFrame) -> DataFrame:
    """Newest candle of every series."""
    return df.groupBy(*SERIES).agg(F.max(TIME).alias(TIME), *[F.max_by(c, TIME).alias(c) for c in OHLCV])


def data_summary(df: DataFrame) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("total_rows"), F.min(TIME).alias("earliest"), F.max(TIME).alias("latest")]
    if "updated_at" in df.columns:
        aggs.append(F.max("updated_at").alias("last_updated"))
    return df.groupBy(*SERIES).agg(*aggs)


def latest_timestamp(df: DataFrame) -> DataFrame:
    return df.groupBy(*SERIES).agg(F.max(TIME).alias("latest"))


def upsert_candles(stored: DataFrame, incoming: DataFrame, now: Column) -> DataFrame:
    """Merged table with an ``action`` per row: insert, update or keep.

    Incoming rows win; ``created_at`` of an updated row is kept and ``updated_at`` refreshed. The
    incoming rows must be unique per key (cleaned candles are).
    """
    key = [*SERIES, TIME]
    old = stored.select(*key, *[F.col(c).alias(f"_o_{c}") for c in (*OHLCV, "created_at", "updated_at")], F.lit(True).alias("_old"))
    new = incoming.select(*key, *OHLCV, F.lit(True).alias("_new"))
    both = old.join(new, key, "full_outer")
    has_old, has_new = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    return both.select(
        *key,
        *[F.when(has_new, F.col(c)).otherwise(F.col(f"_o_{c}")).alias(c) for c in OHLCV],
        F.coalesce("_o_created_at", now).alias("created_at"),
        F.when(has_new, now).otherwise(F.col("_o_updated_at")).alias("updated_at"),
        F.when(has_old & has_new, "update").when(has_new, "insert").otherwise("keep").alias("action"),
    )


def upsert_counts(merged: DataFrame) -> DataFrame:
    """Rows inserted and updated per series."""
    return merged.groupBy(*SERIES).agg(
        F.count_if(F.col("action") == "insert").alias("rows_inserted"),
        F.count_if(F.col("action") == "update").alias("rows_updated"),
    )


def _month(t: str = TIME) -> Column:
    return F.date_format(t, MONTH)


def write_candles(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write candles with the decimal types of ``STORED_CANDLE``."""
    stored = {f.name: F.col(f.name).cast(f.dataType) for f in STORED_CANDLE.fields if f.name in OHLCV}
    (
        df.withColumns(stored)
        .withColumn("month", _month())
        .repartition(*PARTITIONS)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITIONS)
        .parquet(path)
    )


STORE_SCHEMA = T.StructType([f for f in STORED_CANDLE.fields if f.name not in PARTITIONS] + [T.StructField(c, T.StringType()) for c in PARTITIONS])


def init_store(spark: SparkSession, path: str) -> None:
    """Create an empty table folder."""
    write_candles(spark.createDataFrame([], STORE_SCHEMA).drop("month"), path, "append")


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """The table as doubles; its files hold decimals."""
    return spark.read.schema(STORE_SCHEMA).parquet(path).withColumns({c: F.col(c).cast("double") for c in OHLCV})


LISTED = 500  # values of a partition column that are listed one by one
COUNTS = "symbol string, timeframe string, rows_inserted bigint, rows_updated bigint"


def touched_partitions(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Rows of ``stored`` in the partitions that ``fresh`` (written, so it is cheap to read twice) has rows in.

    The values of each partition column come as literals, which prune the listing of files: one by one up to ``LISTED``
    different ones, so a bar from years ago adds its own month only, and as a range beyond that. The semi join
    keeps the exact partitions. The driver sees ``LISTED`` values a column at most.
    """
    for c in PARTITIONS:
        values = [r[0] for r in fresh.select(c).filter(F.col(c).isNotNull()).distinct().limit(LISTED + 1).collect()]
        if not values:
            return stored.filter(F.lit(False))
        if len(values) <= LISTED:
            stored = stored.filter(F.col(c).isin(values))
        else:
            edges = fresh.agg(F.min(c), F.max(c)).first()
            stored = stored.filter(F.col(c).between(F.lit(edges[0]), F.lit(edges[1])))
    return stored.join(fresh.select(*PARTITIONS).distinct(), list(PARTITIONS), "left_semi")


def _earlier_counts(spark: SparkSession, scratch: str) -> DataFrame | None:
    """Counts that a complete merge left in its folder; they are written last, so the merged rows are there too."""
    try:
        return spark.read.schema(COUNTS).parquet(f"{scratch}/counts")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def merge_into_store(spark: SparkSession, path: str, incoming: DataFrame, now: Column, scratch: str, repeatable: bool = False) -> DataFrame:
    """Upsert into the table at ``path`` and return the counts per series.

    The incoming rows are written to ``scratch`` (a shared folder, one per call) first; their range of
    partitions prunes the table. Only months that receive rows are rewritten. The merged months go to ``scratch``
    too before they replace the old ones, so a lost executor cannot make the job read half-replaced
    partitions. One writer at a time.

    With ``repeatable`` the call may be made again with the same ``scratch``, after a success or a failure, as long as no
    other merge came between: if the merged rows are complete there, they are written again and the counts are those of the first call.
    """
    if repeatable and (counts := _earlier_counts(spark, scratch)) is not None:
        write_candles(spark.read.parquet(f"{scratch}/merged").drop("action"), path)
        return counts
    mode = "overwrite" if repeatable else "errorifexists"
    incoming.select(*SERIES, TIME, *OHLCV).withColumn("month", _month()).write.mode(mode).parquet(f"{scratch}/fresh")
    fresh = spark.read.parquet(f"{scratch}/fresh")
    stored = touched_partitions(read_store(spark, path), fresh)
    merged = upsert_candles(stored.drop("month"), fresh.drop("month"), now)
    merged.write.mode(mode).parquet(f"{scratch}/merged")
    merged = spark.read.parquet(f"{scratch}/merged")
    upsert_counts(merged).write.mode(mode).parquet(f"{scratch}/counts")
    write_candles(merged.drop("action"), path)
    return spark.read.schema(COUNTS).parquet(f"{scratch}/counts")


def incremental_slice(fetched: DataFrame, stored: DataFrame, refresh_last: bool = False) -> DataFrame:
    """Fetched rows beyond the stored high-water mark (+ 1 s), with the mode of each series."""
    marks = latest_timestamp(stored)
    start = F.col("latest") if refresh_last else F.col("latest") + F.expr("interval 1 second")
    return (
        fetched.join(marks, list(SERIES), "left")
        .filter(F.col("latest").isNull() | (F.col(TIME) >= start))
        .withColumn("mode", F.when(F.col("latest").isNull(), "initial").otherwise("incremental"))
        .drop("latest")
    )


LOG_COLUMNS = ("run_id", *SERIES, "mode", "rows_inserted", "rows_updated", "at", "status", "error_message")


def log_start(series: DataFrame, mode: str, at: Column, run_id: str | None = None) -> DataFrame:
    """One ``running`` event per series, to be appended to the run log."""
    return series.select(
        F.lit(run_id or str(uuid.uuid4())).alias("run_id"),
        *SERIES,
        F.lit(mode).alias("mode"),
        F.lit(0).cast("bigint").alias("rows_inserted"),
        F.lit(0).cast("bigint").alias("rows_updated"),
        at.alias("at"),
        F.lit("running").alias("status"),
        F.lit(None).cast("string").alias("error_message"),
    )


def log_finish(started: DataFrame, counts: DataFrame | None, at: Column, error: str | None = None) -> DataFrame:
    """Closing event of every started series: ``success`` with counts, or ``error``."""
    base = started.drop("rows_inserted", "rows_updated", "at", "status", "error_message")
    if counts is None:
        base = base.withColumns({"rows_inserted": F.lit(0), "rows_updated": F.lit(0)})
    else:
        base = base.join(counts, list(SERIES), "left").fillna(0, ["rows_inserted", "rows_updated"])
    return base.select(
        "run_id",
        *SERIES,
        "mode",
        F.col("rows_inserted").cast("bigint"),
        F.col("rows_updated").cast("bigint"),
        at.alias("at"),
        F.lit("success" if error is None else "error").alias("status"),
        F.lit(error).cast("string").alias("error_message"),
    )


def audit_log(events: DataFrame) -> DataFrame:
    """State of every run: first event gives the start, the last one the result."""
    done = F.col("status") != "running"
    order = F.struct("at", done)
    cols = ["rows_inserted", "rows_updated", "status", "error_message"]
    return events.groupBy("run_id", *SERIES, "mode").agg(
        F.min("at").alias("started_at"),
        F.max(F.when(done, F.col("at"))).alias("finished_at"),
        *[F.max_by(c, order).alias(c) for c in cols],
    )


def union_series(frames: dict[str, DataFrame]) -> DataFrame:
    """Frames of single symbols as one table."""
    parts = [df.withColumn("symbol", F.lit(s)) for s, df in frames.items()]
    if not parts:
        raise ValueError("no series given")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def chrono_split(df: DataFrame, test_ratio: float = 0.15, layout: Layout = DEFAULT) -> DataFrame:
    """Label the first ``int(n * (1 - ratio))`` rows of every series train and the rest test."""
    cut = F.floor(F.col("_total") * F.lit(1 - test_ratio))
    out = index_series(df, layout=layout).withColumn("split", F.when(F.col("_rn") < cut, "train").otherwise("test"))
    return drop_index(out)


def three_way_split(df: DataFrame, test_ratio: float = 0.15, calibration_ratio: float = 0.15, layout: Layout = DEFAULT) -> DataFrame:
    """Train, calibration (the last part of the training rows) and test rows per series."""
    cut = F.floor(F.col("_total") * F.lit(1 - test_ratio))
    cal = F.floor(cut * F.lit(1 - calibration_ratio))
    label = F.when(F.col("_rn") < cal, "train").when(F.col("_rn") < cut, "calibration").otherwise("test")
    return drop_index(index_series(df, layout=layout).withColumn("split", label))


def dataset_metadata(split: DataFrame) -> DataFrame:
    """Row counts and date range of a split table, per series."""
    train, test = F.col("split") == "train", F.col("split") == "test"
    n = len([c for c in split.columns if c != "split"])
    return split.groupBy(*SERIES).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(train).alias("train_rows"),
        F.count_if(test).alias("test_rows"),
        F.lit(n).cast("bigint").alias("n_features"),
        F.min(TIME).alias("start"),
        F.max(TIME).alias("end"),
        F.max(F.when(train, F.col(TIME))).alias("train_end"),
        F.min(F.when(test, F.col(TIME))).alias("test_start"),
    )


def export_dataset(df: DataFrame, path: str, test_ratio: float = 0.15, layout: Layout = DEFAULT) -> DataFrame:
    """Write train and test records as JSON and the metadata beside them; returns the metadata."""
    split = chrono_split(df, test_ratio, layout)
    meta = dataset_metadata(split).withColumn("columns", F.lit(json.dumps(df.columns)))
    split.write.mode("overwrite").partitionBy("split").json(f"{path}/records")
    meta.write.mode("overwrite").json(f"{path}/metadata")
    return meta


def load_records(spark: SparkSession, path: str, schema: str, lines: bool = False) -> DataFrame:
    """JSON records: an array per file, or an object that holds the array.

    Of the keys data, records, train and test the first present one is taken. ``lines`` reads one
    record per line, as ``export_dataset`` writes them; only this form is read in splits, so large
    sets should use it.
    """
    if lines:
        return spark.read.schema(schema).json(path)
    row = f"struct<{schema}>"
    keys = ("data", "records", "train", "test")
    nested = ", ".join(f"{k} array<{row}>" for k in keys)
    doc = spark.read.option("multiLine", True).schema(f"{nested}, {schema}").json(path)
    fields = [f.strip().split()[0] for f in schema.split(",")]
    records = F.coalesce(*keys, F.array(F.struct(*fields)))
    return doc.select(F.explode(records).alias("_r")).select("_r.*")
