"""Time the headline operators over the supplier bars of ``$BENCH_SF_DIR`` and print one JSON line.

The candle table is written once before the clock starts, as a stored table would be. Every query
runs once unmeasured and once measured, each time over all rows, into a sink that discards them.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wickframe.operators import clean, eda, features, stats, supervised  # noqa: E402
from wickframe.sources import store  # noqa: E402
from wickframe.sources.adapters import bars_supp, dirty_bars  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    work = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    bars_supp(spark, sf_dir).write.parquet(f"{work}/bars")
    dirty_bars(spark, sf_dir).write.parquet(f"{work}/raw")
    bars, raw = spark.read.parquet(f"{work}/bars"), spark.read.parquet(f"{work}/raw")
    features.returns(bars).write.parquet(f"{work}/returns")
    returns = spark.read.parquet(f"{work}/returns")
    stored = bars.withColumns({"created_at": F.lit(datetime(2024, 1, 1)), "updated_at": F.lit(datetime(2024, 1, 1))})
    incoming = bars.filter(F.year("open_time") >= 1999)

    queries = {
        "clean_candles": lambda: clean.clean_candles(raw),
        "cleaning_report": lambda: clean.cleaning_report(raw),
        "upsert_candles": lambda: store.upsert_candles(stored, incoming, F.lit(datetime(2024, 2, 1))),
        "returns": lambda: features.returns(bars),
        "drawdown": lambda: features.drawdown(bars),
        "engineer_features": lambda: features.engineer_features(bars),
        "build_lag_features": lambda: supervised.build_lag_features(bars),
        "return_stats": lambda: stats.return_stats(returns),
        "value_at_risk": lambda: stats.value_at_risk(returns),
        "ljung_box": lambda: stats.ljung_box(returns),
        "hurst_rs": lambda: stats.hurst_rs(bars),
        "seasonality_dow": lambda: eda.seasonality_dow(returns),
    }
    seconds = {}
    for name, make in queries.items():
        for _ in range(2):
            start = time.time()
            make().write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.time() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total time of the headline operators",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "rows": {"bars": bars.count(), "raw": raw.count()},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
