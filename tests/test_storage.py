import json
import logging
import os
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from marketloom import schemas
from marketloom.audit import ExtractionRecord
from marketloom.context import RunContext, new_run_id
from marketloom.jobs.ingest import DOCUMENTS, RELATIONAL, Dataset, run_ingestion
from marketloom.operators.dedup import absent_from, keep_first, latest_only, orphans
from marketloom.operators.ranking import dense_rank_desc, with_row_index
from marketloom.operators.state import MarkStore
from marketloom.operators.upsert import upsert
from marketloom.plans import star
from marketloom.registry import snapshot as registered
from marketloom.session import release_work, shared_dir
from marketloom.sinks.bronze import bronze_path, json_ready, write_bronze, write_bronze_parquet, write_many
from marketloom.sinks.lake import write_snapshot
from marketloom.sinks.tables import TableStore, conform, route_schema, save_table
from marketloom.sources import catalog, documents, landing, tables
from marketloom.storage import create_new

UTC = timezone.utc
CTX = RunContext.create(datetime(2026, 9, 12, 14, tzinfo=UTC))


# --- Bronze -------------------------------------------------------------------
def test_bronze_path_is_deterministic():
    assert bronze_path("", "postgresql", "orders", CTX).lstrip("/") == (
        "source=postgresql/dataset=orders/ingestion_date=2026-09-12/hour=14/orders_20260912T140000Z.json")
    assert bronze_path("b/dataset=orders", None, "orders", CTX) == (
        "b/dataset=orders/ingestion_date=2026-09-12/hour=14/orders_20260912T140000Z.json")
    assert bronze_path("b/source=x", "x", "orders", CTX).startswith("b/source=x/dataset=orders/")


def test_json_encoding(spark, tmp_path):
    df = spark.createDataFrame(
        [(datetime(2026, 1, 1, tzinfo=UTC), D("1.5"), date(2026, 1, 2), {"k": D("2.5")}, "é")],
        "at timestamp, d decimal(18,8), day date, m map<string,decimal(4,1)>, s string")
    path = write_bronze(df.coalesce(1), str(tmp_path), "x", CTX, "src")
    line = next(open(os.path.join(path, f), encoding="utf-8").read() for f in os.listdir(path) if f.endswith(".json"))
    assert json.loads(line) == {"at": "2026-01-01T00:00:00+00:00", "d": 1.5, "day": "2026-01-02", "m": {"k": 2.5}, "s": "é"}
    assert "é" in line
    with pytest.raises(TypeError, match="not JSON serializable"):
        json_ready(spark.createDataFrame([(b"x",)], "b binary"))


def test_bronze_rerun_replaces_its_run(spark, tmp_path):
    df = spark.createDataFrame([(1,), (2,)], "n int")
    for _ in range(2):
        write_bronze(df, str(tmp_path), "x", CTX, "src")
    later = RunContext.create(datetime(2026, 9, 12, 15, tzinfo=UTC))
    write_bronze(df, str(tmp_path), "x", later, "src")
    back = landing.read_runs(spark, str(tmp_path), "src", "x", "n int")
    assert sorted((r.n, r.hour, r.run_id) for r in back.collect()) == [
        (n, h, f"x_20260912T{h}0000Z") for n in (1, 2) for h in ("14", "15")] or back.count() == 4
    assert back.where("hour = '15'").count() == 2


def test_write_many(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "n int")
    assert write_many({}, str(tmp_path), CTX) == {}
    paths = write_many({"a": df, "b": df}, str(tmp_path), CTX)
    assert set(paths) == {"a", "b"} and all(os.path.isdir(p) for p in paths.values())


def test_bronze_parquet(spark, tmp_path):
    df = spark.createDataFrame([(1, datetime(2026, 1, 1, 3, tzinfo=UTC))], "n int, ingested_at timestamp")
    path = write_bronze_parquet(df, str(tmp_path), "x", "src")
    assert os.path.isdir(f"{path}/ingestion_date=2026-01-01/hour=03")


# --- landing --------------------------------------------------------------------
def put(root, name, value, mtime=None):
    os.makedirs(root, exist_ok=True)
    path = os.path.join(root, name)
    with open(path, "w", encoding="utf-8") as f:
        json.dump(value, f, indent=1)
    if mtime:
        os.utime(path, (mtime, mtime))
    return path


def pair(pid):
    return {"id": pid, "ticker_id": f"{pid}_t", "traded_currency_unit": pid.upper(), "base_currency": "idr",
            "traded_currency": pid, "description": "d"}


def test_latest_run_by_path_by_time_and_fallback(spark, tmp_path):
    root = str(tmp_path / "dataset=pairs")
    put(f"{root}/ingestion_date=2026-01-01/hour=05", "pairs_20260101T050000Z.json", [pair("old")], 2_000_000_000)
    put(f"{root}/ingestion_date=2026-01-02/hour=04", "pairs_20260102T040000Z.json", [pair("new")], 1_000_000_000)
    put(f"{root}/ingestion_date=2026-01-03", "notes.txt", {})
    assert landing.latest_run(spark, ["/nowhere", root]).endswith("pairs_20260102T040000Z.json")
    assert landing.latest_run(spark, [root], by="modified").endswith("pairs_20260101T050000Z.json")
    rows = landing.read_latest(spark, "pairs", ["/nowhere", root]).collect()
    assert [(r.id, r.run_id) for r in rows] == [("new", "20260102T040000Z")]
    assert rows[0].captured_at.replace(tzinfo=None) == datetime.fromtimestamp(
        datetime(2026, 1, 2, 4, tzinfo=UTC).timestamp())
    assert landing.read_payload(spark, "pairs", root).count() == 2
    with pytest.raises(landing.NoRunsError):
        landing.latest_run(spark, [str(tmp_path / "empty")])


def test_latest_run_lists_one_folder_per_level(spark, tmp_path, monkeypatch):
    """Forty days of hourly runs, and a last hour without one: four listings."""
    for day in range(1, 41):
        for hour in ("00", "23"):
            folder = tmp_path / f"ingestion_date=2026-{1 + day // 28:02d}-{1 + day % 28:02d}" / f"hour={hour}"
            folder.mkdir(parents=True)
            if (day, hour) != (40, "23"):
                (folder / f"x_{day:02d}{hour}.json").write_text("{}")
    listed, real = [], landing.entries
    monkeypatch.setattr(landing, "entries", lambda s, p: listed.append(p) or real(s, p))
    assert landing.latest_run(spark, [str(tmp_path)]).endswith("hour=00/x_4000.json")
    assert len(listed) == 4


def test_latest_run_of_spark_written_run(spark, tmp_path):
    path = write_bronze(spark.createDataFrame([(1,)], "n int"), str(tmp_path), "x", CTX, "src")
    assert landing.latest_run(spark, [landing.dataset_root(str(tmp_path), "src", "x")]).endswith(path.split("/")[-1])


def test_payload_checks(spark, tmp_path):
    ok = put(str(tmp_path / "a"), "summaries_20260101T000000Z.json", {"tickers": {"a": {"last": 1}}, "prices_24h": {"a": 2}})
    bad = put(str(tmp_path / "b"), "summaries_20260101T000000Z.json", {"prices_24h": {}})
    df = landing.read_payload(spark, "summaries", ok)
    landing.check_payload("summaries", df)
    assert df.first().tickers == {"a": {"last": "1"}} and df.first().prices_7d is None
    with pytest.raises(ValueError, match="tickers"):
        landing.check_payload("summaries", landing.read_payload(spark, "summaries", bad))
    with pytest.raises(ValueError, match="list of pair"):
        landing.check_payload("pairs", landing.read_payload(spark, "pairs", put(str(tmp_path / "c"), "pairs_20260101T000000Z.json", {"x": 1})))


# --- relational and document sources --------------------------------------------
def test_read_table_and_marks(spark, tmp_path):
    rows = [("t1", "o", D(1), D(1), "buy", datetime(2026, 1, d, tzinfo=UTC)) for d in (1, 2, 3)]
    spark.createDataFrame(rows, schemas.RELATIONAL["trades"]).write.parquet(f"{tmp_path}/trades")
    df = tables.read_table(spark, "trades", str(tmp_path))
    mark = datetime(2026, 1, 2, tzinfo=UTC)
    assert tables.newer_than(df, "executed_at", None).count() == 3
    assert tables.newer_than(df, "executed_at", mark).count() == 1
    assert tables.newer_than(df, "executed_at", mark, strict=False).count() == 2
    plan = tables.newer_than(df, "executed_at", mark)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(executed_at" in plan
    assert tables.max_mark(df.limit(0), "executed_at") is None


def test_jdbc_options():
    o = tables.jdbc_options("jdbc:x", "orders", "id", 0, 100, 8, user="u")
    assert (o["partitionColumn"], o["numPartitions"], o["user"]) == ("id", "8", "u")
    assert "partitionColumn" not in tables.jdbc_options("jdbc:x", "orders")


def doc(i, event="login", context='{"user_id":"u"}', at="2026-01-01T00:00:00Z"):
    return (f"d{i}", event, event, context, at)


def test_documents(spark, tmp_path):
    lines = [{"_id": {"$oid": "abc"}, "event": "login", "context": {"a": {"b": 1}}, "ingested_at": "2026-01-01T00:00:00Z"},
             {"_id": "d2", "event": "login", "ingested_at": "2026-01-02T00:00:00Z"}]
    with open(tmp_path / "x.json", "w") as f:
        f.write("\n".join(json.dumps(x) for x in lines))
    df = documents.read_documents(spark, str(tmp_path))
    rows = {r._id: r for r in documents.tabular(df).collect()}
    assert json.loads(rows["abc"].context) == {"a": {"b": 1}} and rows["d2"].context == "{}"
    assert documents.newer_documents(df, datetime(2026, 1, 1, tzinfo=UTC)).count() == 1
    assert documents.max_ingested(df).day == 2
    with pytest.raises(documents.EnvelopeError, match="context"):
        documents.require_envelope(df)
    with pytest.raises(Exception, match="Document missing required fields: context"):
        documents.enforce_envelope(df).collect()


def test_document_warnings(spark):
    df = spark.createDataFrame([doc(1), doc(2, context="[]"), doc(3, at="2026-01-01"), doc(4, event=None)], schemas.DOCUMENT)
    got = sorted((r.event_id, r.warning) for r in documents.document_warnings(df, "tickers").collect())
    assert got == [("d2", "context must be an object"), ("d3", "ingested_at must be ISO-8601"), ("d4", "event is required")]


def test_catalog_views(spark):
    catalog.register_views({"orders": spark.range(1), "pairs": spark.range(2)})
    assert {"bronze_orders", "bronze_pairs"} <= set(catalog.list_views(spark))
    assert spark.table("bronze_pairs").count() == 2
    with pytest.raises(KeyError):
        catalog.register_views({"nope": spark.range(1)})


# --- marks and ingestion ---------------------------------------------------------
def test_mark_store(spark, tmp_path):
    store = MarkStore(spark, str(tmp_path / "marks"))
    assert store.all() == {} and store.get("a") is None
    t1, t2 = datetime(2026, 1, 1, tzinfo=UTC), datetime(2026, 1, 2, 3, 4, 5, 678901, tzinfo=UTC)
    store.commit({"a": t1, "b": t1}, "postgres")
    store.update("a", "postgres", t2)
    store.commit({}, "postgres")
    assert store.all() == {"a": t2, "b": t1}
    # A commit that never finished leaves no trace.
    os.makedirs(tmp_path / "marks" / "version=3")
    assert store.get("a") == t2


def test_racing_commits_lose_no_mark(spark, tmp_path, monkeypatch):
    root, t = str(tmp_path / "marks"), datetime(2026, 1, 1, tzinfo=UTC)
    one, other = MarkStore(spark, root), MarkStore(spark, root)
    other.update("old", "s", t)
    plain, once = {m: getattr(one, m) for m in ("_numbers", "table")}, set()

    def raced(method, name, taken):
        def call():
            found = taken(plain[method]())
            if name not in once:
                once.add(name)
                other.update(name, "s", t)
            return found

        return call

    # The other takes the number that this one is about to claim.
    monkeypatch.setattr(one, "_numbers", raced("_numbers", "b", list))
    # This one builds on a state from before the other's commit.
    monkeypatch.setattr(one, "table", raced(
        "table", "c", lambda df: spark.createDataFrame(df.collect(), schemas.struct(schemas.WATERMARK))))
    one.update("a", "s", t)
    assert once == {"b", "c"} and set(other.all()) == {"old", "a", "b", "c"}


def test_a_dead_writers_claim_holds_nobody_up(spark, tmp_path):
    store, t = MarkStore(spark, str(tmp_path / "marks")), datetime(2026, 1, 1, tzinfo=UTC)
    store.update("a", "s", t)
    assert create_new(spark, f"{store.root}/version=2/_claim") and not create_new(spark, f"{store.root}/version=2/_claim")
    assert set(store.all()) == {"a"}
    store.update("b", "s", t)
    assert set(store.all()) == {"a", "b"}


ORDERS = Dataset("orders", "postgres", "postgresql", "postgresql.orders", "updated_at")
EVENTS = Dataset("user_events", "mongodb", "mongodb", "mongodb.user_events", "ingested_at", is_document=True)


def run(spark, tmp_path, orders, events, hour=14):
    ctx = RunContext.create(datetime(2026, 9, 12, hour, tzinfo=UTC))
    marks = MarkStore(spark, str(tmp_path / "marks"))
    sources = {"pg": ([ORDERS], lambda _: orders), "mongo": ([EVENTS], lambda _: events)}
    return marks, lambda: run_ingestion(spark, sources, str(tmp_path / "bronze"), marks, ctx, str(tmp_path / "audit"))


def frames(spark, *days):
    orders = spark.createDataFrame([(f"o{d}", datetime(2026, 1, d, tzinfo=UTC)) for d in days], "order_id string, updated_at timestamp")
    events = spark.createDataFrame([doc(d, at=f"2026-01-0{d}T00:00:00Z") for d in days], schemas.DOCUMENT)
    return orders, events


def test_ingestion_moves_marks_only_with_data(spark, tmp_path):
    marks, go = run(spark, tmp_path, *frames(spark, 1, 2))
    assert set(go()) == {"postgresql.orders", "mongodb.user_events"}
    want = {n: datetime(2026, 1, 2, tzinfo=UTC) for n in ("postgresql.orders", "mongodb.user_events")}
    assert marks.all() == want
    assert go() == {} and marks.all() == want
    _, later = run(spark, tmp_path, *frames(spark, 1, 2, 3), hour=15)
    assert len(later()) == 2
    assert marks.get("postgresql.orders").day == 3
    back = landing.read_runs(spark, str(tmp_path / "bronze"), "postgresql", "orders", "order_id string, updated_at string")
    assert sorted(r.order_id for r in back.collect()) == ["o1", "o2", "o3"]
    audit = spark.read.parquet(str(tmp_path / "audit"))
    assert sorted(r.rows_extracted for r in audit.collect()) == [0, 0, 1, 1, 2, 2]


def test_failed_source_moves_no_mark(spark, tmp_path):
    orders, _ = frames(spark, 1)
    broken = spark.createDataFrame([doc(1, event=None)], schemas.DOCUMENT)
    marks, go = run(spark, tmp_path, orders, broken)
    with pytest.raises(Exception, match="Document missing required fields: event"):
        go()
    assert marks.all() == {}


def test_failed_write_moves_no_mark(spark, tmp_path, monkeypatch):
    marks, go = run(spark, tmp_path, *frames(spark, 1))

    def fail(*_, **__):
        raise OSError("disk full")

    monkeypatch.setattr("marketloom.jobs.ingest.write_bronze", fail)
    with pytest.raises(OSError, match="disk full"):
        go()
    assert marks.all() == {}


def test_registries():
    assert [d.namespace for d in RELATIONAL][:2] == ["postgresql.users", "postgresql.accounts"] and len(RELATIONAL) == 6
    assert [d.name for d in DOCUMENTS] == ["tickers", "orderbooks", "user_events"]


def test_audit_record(caplog):
    t0 = datetime(2026, 1, 1, tzinfo=UTC)
    r = ExtractionRecord(source="postgres", dataset="orders", watermark_before=t0)
    assert r.status == "pending" and len(r.run_id) == 12 and r.run_id != new_run_id()
    r.finish("success", 50, t0 + timedelta(days=1))
    assert (r.rows_extracted, r.watermark_before, r.watermark_after.day, r.error) == (50, t0, 2, None)
    assert r.duration_s >= 0
    with caplog.at_level(logging.INFO, "marketloom"):
        r.log()
        ExtractionRecord(dataset="x").finish("failed", error="boom").log()
    assert "rows=50" in caplog.text and "status=success" in caplog.text and "error=boom" in caplog.text


# --- upsert -----------------------------------------------------------------------
MART = "date date, symbol string, v int"


def mart(spark, *rows):
    return spark.createDataFrame([(d and date(2026, 1, d), s, v) for d, s, v in rows], MART)


def content(spark, path):
    return sorted((r.date.day if r.date else 0, r.symbol or "", r.v)
                  for r in spark.read.schema(MART).parquet(path).collect())


def test_upsert(spark, tmp_path):
    path, keys = str(tmp_path / "mart"), ["date", "symbol"]
    upsert(spark, path, mart(spark, (1, "a", 1), (1, "b", 1), (2, "a", 1)), keys)
    untouched = {f: os.stat(f"{path}/date=2026-01-02/{f}").st_mtime_ns for f in os.listdir(f"{path}/date=2026-01-02")}
    update = mart(spark, (1, "a", 2), (3, "c", 2), (1, None, 5), (None, "n", 6))
    for _ in range(2):
        touched = upsert(spark, path, update, keys)
        assert content(spark, path) == [(0, "n", 6), (1, "", 5), (1, "a", 2), (1, "b", 1), (2, "a", 1), (3, "c", 2)]
    assert set(touched) == {date(2026, 1, 1), date(2026, 1, 3), None}
    assert untouched == {f: os.stat(f"{path}/date=2026-01-02/{f}").st_mtime_ns for f in os.listdir(f"{path}/date=2026-01-02")}
    assert upsert(spark, path, update.limit(0), keys) == []


def test_upsert_refuses_double_keys(spark, tmp_path):
    with pytest.raises(ValueError, match="2 times"):
        upsert(spark, str(tmp_path / "mart"), mart(spark, (2, "a", 1), (2, "a", 3)), ["date", "symbol"])


# --- star -----------------------------------------------------------------------
def gold(spark, rows):
    names = schemas.columns(schemas.MARKET_METRICS)
    full = [tuple({"pair_id": p, "ticker_id": f"{p}_t", "asset_name": a, "captured_at": at, "run_id": "r",
                   "last_price": 1.0, "volume_rank": 1}.get(n) for n in names) for p, a, at in rows]
    return spark.createDataFrame(full, schemas.MARKET_METRICS)


NOON = datetime(2026, 8, 26, 12, tzinfo=UTC)


def test_dim_head_counts_markets_of_both_loads(spark, tmp_path):
    lines = [(k, "F", datetime(1997, 1, 1)) for k in (30, 40)] + [(k, "O", datetime(1998, 6, 1)) for k in (40, 10, 20)]
    spark.createDataFrame(lines, "l_partkey long, l_linestatus string, l_shipdate timestamp_ntz").write.parquet(
        str(tmp_path / "lineitem.parquet"))
    head = registered.star_dim_head(spark, str(tmp_path)).collect()
    assert [(r.market_key, r.pair_id, r.asset_name) for r in head] == [
        (1, "30", "F"), (2, "40", "F"), (3, "10", "O"), (4, "20", "O")]


def test_star_load_is_idempotent(spark, tmp_path):
    store = TableStore(spark, str(tmp_path), "warehouse")
    g = gold(spark, [("btc", "Bitcoin", NOON), ("eth", "Ether", NOON)])
    first = star.load_market_snapshot(spark, g, store, on_missing="raise")
    assert (first.markets, first.dates, first.facts) == (2, 1, 2)
    again = star.load_market_snapshot(spark, g, store)
    assert (again.markets, again.dates, again.facts) == (0, 0, 0)
    more = gold(spark, [("ada", "Cardano", NOON), ("btc", "Renamed", NOON + timedelta(days=1))])
    third = star.load_market_snapshot(spark, more, store)
    assert (third.markets, third.dates, third.facts) == (1, 1, 2)
    dim = {r.pair_id: (r.market_key, r.asset_name) for r in store.read("dim_market").collect()}
    assert dim == {"btc": (1, "Bitcoin"), "eth": (2, "Ether"), "ada": (3, "Cardano")}
    dates = [(r.date_key, r.full_date, r.year, r.month, r.day) for r in star.dim_date_listing(store.read("dim_date")).collect()]
    assert dates == [(20260826, date(2026, 8, 26), 2026, 8, 26), (20260827, date(2026, 8, 27), 2026, 8, 27)]
    top = star.latest_facts(store.read("fact_market_snapshot"), store.read("dim_market"), 2).collect()
    assert [(r.pair_id, r.date_key) for r in top] == [("btc", 20260827), ("btc", 20260826)]
    counts = star.row_counts({t: store.read(t) for t in schemas.STAR})
    assert {r.table_name: r.row_count for r in counts.collect()} == {"dim_market": 3, "dim_date": 2, "fact_market_snapshot": 4}


def test_unknown_market_drops_or_raises(spark):
    dim = spark.createDataFrame([(1, "btc", "t", None)], schemas.DIM_MARKET)
    fact = spark.createDataFrame([], schemas.FACT_SNAPSHOT)
    g = gold(spark, [("btc", None, NOON), ("zzz", None, NOON)])
    assert star.new_facts(g, dim, fact).count() == 1
    with pytest.raises(star.MissingMarketError, match="zzz"):
        star.new_facts(g, dim, fact, on_missing="raise")


def test_market_keeps_first_row(spark):
    g = gold(spark, [("btc", "Later", NOON + timedelta(hours=1)), ("btc", "First", NOON)])
    assert star.new_markets(g, spark.createDataFrame([], schemas.DIM_MARKET)).first().asset_name == "First"


# --- operators -------------------------------------------------------------------
def test_row_index_and_dense_rank_over_many_partitions(spark):
    df = spark.range(0, 5000, 1, 16).select((F.col("id") * 7919 % 5003).alias("k"), (F.col("id") % 3).alias("g"))
    rows = sorted((r.k, r.n) for r in with_row_index(df, ["k"], "n").collect())
    assert [n for _, n in rows] == list(range(1, 5001))
    vals = df.select("g", (F.col("k") % 100).cast("double").alias("v"))
    got = {(r.g, r.v): r.r for r in dense_rank_desc(vals, ["g"], "v", "r").collect()}
    for g in range(3):
        ordered = sorted({v for gg, v in got if gg == g}, reverse=True)
        assert [got[g, v] for v in ordered] == list(range(1, len(ordered) + 1))


def test_dense_rank_keeps_every_row(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("a", None), (None, 2.0), (None, 3.0)], "g string, v double")
    got = sorted((r.g or "", r.v or 0, r.r or 0) for r in dense_rank_desc(df, ["g"], "v", "r").collect())
    assert got == [("", 2.0, 2), ("", 3.0, 1), ("a", 0, 0), ("a", 1.0, 1), ("a", 1.0, 1)]


def test_rank_sets_missing_values_apart(spark):
    """A fifth of the rows without a value: they meet no join."""
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.when(F.col("id") % 5 > 0, F.col("id") % 40).cast("double").alias("v"))
    out = dense_rank_desc(df, ["g"], "v", "r")
    rows = out.collect()
    assert len(rows) == 1000 and sum(r.r is None for r in rows) == 200 and max(r.r or 0 for r in rows) == 32
    joined = out._jdf.queryExecution().optimizedPlan().toString().split("Join")
    assert "isnotnull(v" in joined[1] and "LeftOuter" not in joined[1]


def test_keep_first_limits_groups_below_the_exchange(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    out = keep_first(df, ["k"], ["id"])
    assert sorted(r.id for r in out.collect()) == [0, 1, 2]
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_anti_joins(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert [r.k for r in absent_from(left, right, ["k"]).collect()] == [2]
    assert sorted(str(r.k) for r in orphans(left, right, "k", "k").collect()) == ["2", "None"]


def test_latest_only(spark):
    df = spark.createDataFrame([("r1", 1), ("r2", 2), ("r2", 3)], "run string, v int")
    assert sorted(r.v for r in latest_only(df, "run").collect()) == [2, 3]
    assert latest_only(df.limit(0), "run").count() == 0


# --- tables ------------------------------------------------------------------------
def test_table_store_and_schema_routing(spark, tmp_path):
    assert route_schema(" marts ", "main") == "marts" and route_schema(None, "main") == "main"
    store = TableStore(spark, str(tmp_path))
    store.replace(spark.createDataFrame([("1", "2.5")], "a string, b string"), "t", "a int, b decimal(18,8)")
    assert dict(store.read("t").dtypes) == {"a": "int", "b": "decimal(18,8)"}
    store.replace(store.spark.createDataFrame([("9", "1")], "a string, b string"), "t", "a int, b decimal(18,8)")
    assert [r.a for r in store.read("t").collect()] == [9]
    assert store.append(conform(spark.createDataFrame([(5, 1)], "a int, b int"), "a int, b decimal(18,8)"), "t") == 1
    save_table(spark.range(3), "saved_numbers", "id int")
    assert dict(spark.table("saved_numbers").dtypes) == {"id": "int"}


def test_snapshot_runs_of_one_hour_coexist(spark, tmp_path):
    ddl = "pair_id string, ingestion_date string, captured_at timestamp, run_id string"
    rows = lambda run: spark.createDataFrame([("p", "2026-01-01", datetime(2026, 1, 1, 4, tzinfo=UTC), run)], ddl)
    for r in ("r1", "r2", "r1"):
        write_snapshot(rows(r), str(tmp_path), "market_snapshot")
    back = landing.read_snapshots(spark, str(tmp_path), "market_snapshot", ddl, "2026-01-01", "04")
    assert sorted(r.run_id for r in back.collect()) == ["r1", "r2"]
    assert landing.read_snapshots(spark, str(tmp_path), "market_snapshot", ddl, "2026-01-02").count() == 0


def test_work_is_released(spark):
    from marketloom.session import materialize

    df = materialize(spark.range(3), "x")
    root = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}"
    assert df.count() == 3 and os.path.isdir(root)
    release_work(spark)
    assert not os.path.exists(root)


def test_shuffle_is_only_ever_raised(spark, tmp_path):
    from marketloom.session import fit_shuffle

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.range(200_000).select(F.md5(F.col("id").cast("string")).alias("x")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    try:
        assert fit_shuffle(spark, df, df) == int(before)
        # Neither a join's product estimate nor an unknown size counts.
        unknown = spark.createDataFrame(spark.sparkContext.parallelize([(1,)]), "x int")
        assert fit_shuffle(spark, df.join(df.withColumnRenamed("x", "y"), F.col("x") == F.col("y")), unknown) == int(before)
        assert fit_shuffle(spark, df, target_mb=1) > int(before)
        assert fit_shuffle(spark, df) == int(spark.conf.get("spark.sql.shuffle.partitions")) > int(before)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_old_mark_versions_are_dropped(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("marketloom.operators.state.KEPT_VERSIONS", 2)
    store = MarkStore(spark, str(tmp_path / "marks"))
    for day in range(1, 6):
        store.update("a", "s", datetime(2026, 1, day, tzinfo=UTC))
    assert store.get("a").day == 5 and len(os.listdir(tmp_path / "marks")) <= 3
