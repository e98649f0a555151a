"""Scaling and upsert cost on generated data.

Usage: python tools/scale.py [factor ...]   (multiples of the default sizes)
Writes each size to a fresh temporary folder, times the daily models on it,
and times an upsert touching 1, 5 and 30 of 30 dates. Prints JSON lines.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from datetime import date, datetime, timedelta, timezone

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def timed(fn) -> float:
    start = time.perf_counter()
    fn()
    return round(time.perf_counter() - start, 2)


def main() -> None:
    from pyspark.sql import functions as F

    from marketloom.datagen import Generator, Sizes
    from marketloom.operators.upsert import upsert
    from marketloom.plans import daily, staging
    from marketloom.session import build_session, release_work

    factors = [int(a) for a in sys.argv[1:]] or [100, 1000]
    spark = build_session("scale", "local[8]", spark__sql__shuffle__partitions="16", spark__ui__enabled="false",
                          spark__driver__memory="16g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    root = tempfile.mkdtemp(prefix="scale-")
    now = datetime(2026, 9, 12, tzinfo=timezone.utc)
    for factor in factors:
        gen = Generator(spark, now, Sizes().scaled(factor))
        path = f"{root}/{factor}"
        made = timed(lambda: [df.write.parquet(f"{path}/{n}") for n, df in
                              (("orders", gen.orders()), ("trades", gen.trades()), ("user_events", gen.user_events()))])
        orders, trades = spark.read.parquet(f"{path}/orders"), spark.read.parquet(f"{path}/trades")
        events = staging.stage_user_events(spark.read.parquet(f"{path}/user_events"))
        models = {
            "daily_trading": daily.daily_trading(orders, trades),
            "orders_trades": daily.orders_trades(orders, trades),
            "user_events_daily": daily.user_events_daily(events),
            "user_trading_activity": daily.user_trading_activity(orders, trades, events),
        }
        times = {}
        for name, df in models.items():
            run = lambda: df.write.format("noop").mode("overwrite").save()
            run()
            times[name] = min(timed(run), timed(run))
        print(json.dumps({"factor": factor, "trades": gen.sizes.trades, "generate": made, **times}), flush=True)

    days = [date(2026, 1, 1) + timedelta(days=i) for i in range(30)]
    rows = spark.range(300_000).select(
        F.date_add(F.lit(days[0]), (F.col("id") % 30).cast("int")).alias("date"),
        F.col("id").cast("string").alias("symbol"), F.rand(1).alias("v"))
    path = f"{root}/mart"
    upsert(spark, path, rows, ["date", "symbol"])

    def stamps() -> dict:
        return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
                for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}

    for touched in (1, 5, 30):
        before = stamps()
        batch = rows.where(F.col("date").isin(days[:touched]))
        seconds = timed(lambda: upsert(spark, path, batch, ["date", "symbol"]))
        rewritten = sum(1 for f, t in stamps().items() if before.get(f) != t)
        print(json.dumps({"upsert_dates": touched, "seconds": seconds, "files_written": rewritten,
                          "files": len(stamps())}), flush=True)
    release_work(spark)
    spark.stop()


if __name__ == "__main__":
    main()
