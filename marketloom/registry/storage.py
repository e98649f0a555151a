"""Registered queries that write tables and read them back."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from marketloom import schemas
from marketloom.context import RunContext
from marketloom.jobs.increments import load_activity, load_slice
from marketloom.jobs.ingest import DOCUMENTS, RELATIONAL, run_ingestion
from marketloom.jobs.quotes import load_quotes
from marketloom.jobs.trading import load_trading
from marketloom.operators.state import MarkStore
from marketloom.plans import daily, marts
from marketloom.plans.star import load_market_snapshot, row_counts
from marketloom.registry import inputs as src
from marketloom.registry import sqltext as q
from marketloom.registry.catalog import register
from marketloom.registry.market import rounded, wide
from marketloom.registry.snapshot import SILVER_BY_DAY, _gold_by_type, event_documents, silver_by_day
from marketloom.session import work_path
from marketloom.sinks.bronze import write_bronze
from marketloom.sinks.lake import SILVER, write_silver
from marketloom.sinks.tables import TableStore, mart_path
from marketloom.sources.documents import newer_documents, read_documents
from marketloom.sources.landing import dataset_root, latest_run, read_runs, read_snapshots
from marketloom.sources.tables import RELATIONAL_MARKS, read_table
from marketloom.storage import children, delete, make_dirs
from marketloom.streaming.incremental import read_landing, stream_daily_market, stream_user_activity

FIRST_LOAD_UNTIL = "2024-01-20 12:00:00"


def _instant(text):
    return F.lit(text).cast("timestamp_ntz")


def _slices(at, n):
    """Conditions of three slices of rows: early ones, late days' even rows last, and the rest between."""
    late = (at >= _instant("2024-01-10")) & (at < _instant("2024-01-13")) & (F.col(n) % 2 == 0)
    early = at < _instant(FIRST_LOAD_UNTIL)
    return [early & ~late, ~early & ~late, late]


def _load_in_slices(spark, sf_dir, label):
    """Quotes loaded in three slices, the last one late, and that one twice."""
    ticks, root = src.ticks(spark, sf_dir), work_path(spark, label)
    slices = _slices(F.col("captured_at"), "event_id")
    for batch in (0, 1, 2, 2):
        load_quotes(spark, root, ticks.where(slices[batch]), batch, "event_id")
    return root


@register("upsert_market", q.with_ctes(q.DAILY_MARKET, "SELECT * FROM daily_market"))
def upsert_market(spark, sf_dir):
    root = _load_in_slices(spark, sf_dir, "upsert-market")
    return wide(spark.read.parquet(f"{root}/daily_market"), "volume_idr", "volume_asset")


@register("upsert_market_mart", q.with_ctes(q.MARKET_DAILY, "SELECT * FROM market_daily"))
def upsert_market_mart(spark, sf_dir):
    """The mart with its day-over-day change equals the one made in one go."""
    root = _load_in_slices(spark, sf_dir, "upsert-mart")
    return wide(spark.read.parquet(mart_path(root, "market_daily")), "volume_idr", "volume_asset")


@register("upsert_trading_mart", q.with_ctes(
    q.DAILY_TRADING.replace("o_orderdate AS updated_at", "date_trunc('month', o_orderdate) AS updated_at"),
    "SELECT * FROM daily_trading"))
def upsert_trading_mart(spark, sf_dir):
    """Orders and trades in three slices: trades before their orders, with them and after, and one slice twice.

    Every trade is dated apart from its order, so days change long after their
    orders came. Orders count on the first of their month: the test table has
    very few a day over seven years.
    """
    orders, trades, root = src.orders(spark, sf_dir), src.trades(spark, sf_dir), work_path(spark, "upsert-trading")
    orders = orders.withColumn("updated_at", F.date_trunc("month", "updated_at").cast("timestamp_ntz"))
    for batch in (0, 1, 2, 2):
        load_trading(spark, root, batch, orders.where(F.col("order_id") % 3 == batch),
                     trades.where(F.col("trade_id") % 7 % 3 == batch))
    return rounded(wide(spark.read.parquet(mart_path(root, "trading_daily")), "buy_volume", "sell_volume", "trading_volume"),
                   "avg_trade_size")


@register("upsert_activity_mart", q.with_ctes(q.EVENTS_DAILY, "SELECT * FROM events_daily"))
def upsert_activity_mart(spark, sf_dir):
    """User events in three slices that share days and users, and the late one twice."""
    events, root = src.user_events(spark, sf_dir), work_path(spark, "upsert-activity")
    slices = _slices(F.col("ingested_at"), "event_id")
    for batch in (0, 1, 2, 2):
        load_activity(spark, root, events.where(slices[batch]), batch)
    return spark.read.parquet(mart_path(root, "user_activity_daily"))


@register("upsert_business_mart", q.with_ctes(q.EVENT_BUSINESS, f"""
SELECT m.date, m.symbol, {q.BUSINESS_COLUMNS}
FROM market_daily m
LEFT JOIN event_trading t ON m.date = t.date AND m.symbol = t.symbol
LEFT JOIN events_daily u ON m.date = u.date"""))
def upsert_business_mart(spark, sf_dir):
    """All sources in three slices, the last one late and loaded twice; each mart hands on what it changed."""
    root = work_path(spark, "upsert-business")
    slices = _slices(F.col("ts"), "event_id")
    for batch in (0, 1, 2, 2):
        events = src.table(spark, sf_dir, "events").where(slices[batch])
        orders, fills = src.event_orders(events)
        load_slice(spark, root, {"summaries": src.ticks_from(events), "orders": orders, "trades": fills,
                                 "user_events": src.user_events_from(events)}, batch, tie_break="event_id")
    return rounded(wide(spark.read.parquet(mart_path(root, "business_metrics")), "market_volume", "trading_volume"),
                   "price_change_pct")


@register("documents_incremental", """
SELECT event_id FROM events WHERE ts > TIMESTAMP '2024-01-15 12:00:00.5'""")
def documents_incremental(spark, sf_dir):
    """Events as documents whose times come with and without fractions, with Z and offsets."""
    ts = F.col("ts")
    form = F.expr("case pmod(event_id, 3) when 0 then date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\")"
                  " when 1 then date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'\")"
                  " else date_format(ts + interval 7 hours, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+07:00'\") end")
    whole = F.regexp_replace(form, r"\.000000", "")
    path = work_path(spark, "documents")
    src.table(spark, sf_dir, "events").where(ts.isNotNull()).select(
        F.col("event_id").cast("string").alias("_id"), F.col("event_type").alias("event"),
        F.lit("{}").alias("context"), whole.alias("ingested_at")).write.json(path)
    mark = datetime(2024, 1, 15, 12, 0, 0, 500_000, tzinfo=timezone.utc)
    found = newer_documents(read_documents(spark, path), mark)
    return found.select(F.col("_id").cast("bigint").alias("event_id"))


#: Up to where each source of the ingestion run has rows when it first runs.
_HAD = {"orders": "1998-06-30 00:00:00", "trades": "1999-01-31 12:00:00", "user_events": FIRST_LOAD_UNTIL}


@register("ingestion_run", f"""
WITH stamped AS (
  SELECT 'orders' AS name, o_orderdate AS stamp, TIMESTAMP '{_HAD["orders"]}' AS had FROM orders
  UNION ALL SELECT 'trades', l_shipdate, TIMESTAMP '{_HAD["trades"]}' FROM lineitem
  UNION ALL SELECT 'user_events', date_trunc('second', ts), TIMESTAMP '{_HAD["user_events"]}' FROM events),
runs AS (
  SELECT name, 1 AS batch, count(*) FILTER (WHERE stamp <= had) AS n, NULL AS mark_before, max(stamp) FILTER (WHERE stamp <= had) AS mark_after
  FROM stamped GROUP BY name
  UNION ALL
  SELECT name, 2, count(*) FILTER (WHERE stamp > had), max(stamp) FILTER (WHERE stamp <= had), max(stamp) FROM stamped GROUP BY name
  UNION ALL
  SELECT name, 3, 0, max(stamp), max(stamp) FROM stamped GROUP BY name)
SELECT name, batch, n AS extracted, n AS landed, strftime(mark_before, '%Y-%m-%d %H:%M:%S.%f') AS mark_before,
       strftime(mark_after, '%Y-%m-%d %H:%M:%S.%f') AS mark_after, 'success' AS status FROM runs""")
def ingestion_run(spark, sf_dir):
    """Relational extracts and documents brought to Bronze by three runs: what was there, what came since, nothing.

    One row per dataset and run: rows by its audit record, rows found in Bronze
    and the mark before and after.
    """
    root = work_path(spark, "ingestion")
    marks = MarkStore(spark, f"{root}/marks")
    for name, rows in (("orders", src.orders(spark, sf_dir)), ("trades", src.trades(spark, sf_dir))):
        declared = schemas.struct(schemas.RELATIONAL[name])
        rows.select(*[F.col(f.name).cast(f.dataType) for f in declared]).write.parquet(f"{root}/extracts/{name}")
    event_documents(spark, sf_dir).write.json(f"{root}/documents/user_events")

    def relational(until):
        def read(name):
            rows = read_table(spark, name, f"{root}/extracts")
            return rows.where(F.col(RELATIONAL_MARKS[name]) <= F.lit(until[name]).cast("timestamp")) if until else rows
        return read

    def collections(until):
        def read(name):
            rows = read_documents(spark, f"{root}/documents/{name}")
            return rows.where(F.col("ingested_at").cast("timestamp") <= F.lit(until[name]).cast("timestamp")) if until else rows
        return read

    chosen = [d for d in RELATIONAL if d.name in _HAD], [d for d in DOCUMENTS if d.name in _HAD]
    runs = []
    for hour, until in ((1, _HAD), (2, None), (3, None)):
        ctx = RunContext.create(datetime(2026, 9, 12, hour, tzinfo=timezone.utc))
        sources = {"relational": (chosen[0], relational(until)), "documents": (chosen[1], collections(until))}
        run_ingestion(spark, sources, f"{root}/bronze", marks, ctx, f"{root}/audit")
        runs.append(ctx.run_id)
    landed = None
    for d in (*chosen[0], *chosen[1]):
        found = read_runs(spark, f"{root}/bronze", d.bronze_source, d.name, "ingested_at string").groupBy(
            F.substring_index("run_id", "_", -1).alias("run_id")).agg(F.count(F.lit(1)).alias("landed"))
        found = found.select(F.lit(d.name).alias("dataset"), "run_id", "landed")
        landed = found if landed is None else landed.union(found)
    form = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return spark.read.schema(schemas.struct(schemas.RUN_AUDIT)).parquet(f"{root}/audit").join(
        landed, ["dataset", "run_id"], "left").select(
        F.col("dataset").alias("name"), F.array_position(F.lit(runs), F.col("run_id")).cast("int").alias("batch"),
        F.col("rows_extracted").cast("bigint").alias("extracted"), F.coalesce("landed", F.lit(0).cast("bigint")).alias("landed"),
        form("watermark_before").alias("mark_before"), form("watermark_after").alias("mark_after"), "status")


@register("bronze_roundtrip", """
SELECT CAST(ts AS DATE) AS date, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total,
       max(user_id) AS max_user, '2026-09-12' AS ingestion_date, '14' AS hour, 'events_20260912T140000Z' AS run_id
FROM events GROUP BY 1, 2""")
def bronze_roundtrip(spark, sf_dir):
    """Events written as a JSON Bronze run and read back with its partitions."""
    ctx = RunContext.create(datetime(2026, 9, 12, 14, tzinfo=timezone.utc))
    root = work_path(spark, "bronze")
    events = src.table(spark, sf_dir, "events")
    write_bronze(events, root, "events", ctx, "mongodb")
    back = read_runs(spark, root, "mongodb", "events",
                     "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string")
    return back.groupBy(F.to_date("ts").alias("date"), "event_type", "ingestion_date", "hour", "run_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("value").cast("decimal(18,2)")).cast("decimal(38,2)").alias("total"),
        F.max("user_id").alias("max_user"),
    )


_RUN_SUMS = """
SELECT event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total
FROM events WHERE event_id % 3 = {part} GROUP BY 1"""


def _landed_runs(spark, sf_dir, order):
    """The events as three Bronze runs of consecutive hours, around midnight, written in some order."""
    root, events = work_path(spark, "runs"), src.table(spark, sf_dir, "events")
    for part in order:
        ctx = RunContext.create(datetime(2026, 9, 12, 22, tzinfo=timezone.utc) + timedelta(hours=part))
        write_bronze(events.where(F.col("event_id") % 3 == part), root, "events", ctx, "mongodb")
    return dataset_root(root, "mongodb", "events")


def _run_sums(spark, path):
    run = spark.read.schema("event_id bigint, event_type string, value double").json(path)
    return run.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).cast("decimal(38,2)").alias("total"))


@register("latest_run_path", _RUN_SUMS.format(part=2))
def latest_run_path(spark, sf_dir):
    """The run of the highest date and hour, though it was written first."""
    return _run_sums(spark, latest_run(spark, [_landed_runs(spark, sf_dir, (2, 0, 1))]))


@register("latest_run_modified", _RUN_SUMS.format(part=1))
def latest_run_modified(spark, sf_dir):
    """The run written last, though another has a later hour."""
    return _run_sums(spark, latest_run(spark, [_landed_runs(spark, sf_dir, (2, 0, 1))], by="modified"))


@register("latest_run_fallback", _RUN_SUMS.format(part=2))
def latest_run_fallback(spark, sf_dir):
    """The first root is missing, the second holds no run."""
    empty = work_path(spark, "no-runs")
    make_dirs(spark, f"{empty}/ingestion_date=2026-12-31/hour=23")
    return _run_sums(spark, latest_run(spark, [f"{empty}-gone", empty, _landed_runs(spark, sf_dir, (0, 1, 2))]))


@register("lake_roundtrip", q.with_ctes(SILVER_BY_DAY, """
SELECT pair_id, ticker_id, last_price, volume_idr, date_trunc('day', captured_at) AS captured_at, run_id
FROM silver WHERE run_id = '2024-01-10'"""))
def lake_roundtrip(spark, sf_dir):
    """Silver written twice (a re-run) and one date read back by partition."""
    root = work_path(spark, "silver")
    silver = silver_by_day(spark, sf_dir).withColumn(
        "captured_at", F.date_trunc("day", "captured_at").cast("timestamp_ntz"))
    write_silver(silver, root)
    write_silver(silver, root)
    ddl = silver.schema.toDDL()
    return read_snapshots(spark, root, SILVER, ddl, ingestion_date="2024-01-10").select(
        "pair_id", "ticker_id", "last_price", "volume_idr", "captured_at", "run_id")


@register("star_load", """
SELECT 'dim_market' AS table_name, count(DISTINCT event_type) AS row_count FROM events
UNION ALL SELECT 'dim_date', count(DISTINCT CAST(ts AS DATE)) FROM events
UNION ALL SELECT 'fact_market_snapshot', count(*) FROM events""")
def star_load(spark, sf_dir):
    """Star schema loaded up to a cut-off, then with everything."""
    store = TableStore(spark, work_path(spark, "star"))
    gold = _gold_by_type(spark, sf_dir)
    until = F.lit(FIRST_LOAD_UNTIL).cast("timestamp_ntz")
    load_market_snapshot(spark, gold.where(F.col("captured_at") < until), store)
    load_market_snapshot(spark, gold, store, on_missing="raise")
    return row_counts({t: store.read(t) for t in ("dim_market", "dim_date", "fact_market_snapshot")})


def _event_stream(spark, sf_dir, label):
    """The events as five landed files, each a batch of its own: every file holds rows of every day.

    So all but the first bring late rows.
    """
    events, landed = src.table(spark, sf_dir, "events"), work_path(spark, label)
    for k in range(5):
        events.where(F.pmod(F.hash("event_id"), F.lit(5)) == k).coalesce(1).write.parquet(f"{landed}/part={k}")
    return read_landing(spark, f"{landed}/*", events.schema, "parquet", max_files=1)


def _again(spark, root):
    """Forget that the last batch was finished, as after a failure just before the commit."""
    commits = f"{root}/checkpoint/commits"
    last = max(children(spark, commits), key=int)
    for name in (last, f".{last}.crc"):
        delete(spark, f"{commits}/{name}")


@register("streaming_daily_market", q.with_ctes(q.DAILY_MARKET, "SELECT * FROM daily_market"))
def streaming_daily_market(spark, sf_dir):
    """The daily market kept by an available-now stream over the events, the last batch repeated."""
    stream, root = _event_stream(spark, sf_dir, "landed-market"), work_path(spark, "stream-market")
    stream_daily_market(spark, stream, root, src.ticks_from, "event_id")
    _again(spark, root)
    out = stream_daily_market(spark, stream, root, src.ticks_from, "event_id")
    return wide(out, "volume_idr", "volume_asset")


@register("streaming_user_activity", q.with_ctes(q.EVENTS_DAILY, "SELECT * FROM events_daily"))
def streaming_user_activity(spark, sf_dir):
    """Daily user activity kept by an available-now stream over the events, the last batch repeated."""
    stream, root = _event_stream(spark, sf_dir, "landed-activity"), work_path(spark, "stream-activity")
    stream_user_activity(spark, stream, root, src.user_events_from)
    _again(spark, root)
    return stream_user_activity(spark, stream, root, src.user_events_from)
