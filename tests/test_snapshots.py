"""Published snapshots, partials per day, sketches and distributed numbers."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from martwright.operators import partials
from martwright.operators.features import DailyMetrics, merchant_daily_metrics
from martwright.operators.joins import id_list
from martwright.operators.numbering import numbered, running_totals
from martwright.operators.partials import DayStore, LastDays, Measure, days_of
from martwright.session import list_folder
from martwright.snapshots import SnapshotTable

SCHEMA = "k long"


def values(df):
    return sorted(r[0] for r in df.collect())


def test_replace_read_and_retire(spark, tmp_path):
    table = SnapshotTable(spark, f"{tmp_path}/t")
    assert values(table.read(SCHEMA)) == [] and table.versions() == []
    assert [table.replace(spark.range(n).toDF("k")) for n in (1, 2, 3, 0)] == [1, 2, 3, 4]
    assert values(table.read(SCHEMA)) == [] and values(table.read(SCHEMA, version=3)) == [0, 1, 2]
    held = table.read(SCHEMA, version=3)
    table.retire(keep=2)
    assert table.versions() == [3, 4] and len(list_folder(spark, f"{table.root}/data")) == 2
    assert values(held) == [0, 1, 2]


def test_failed_write_leaves_the_old_snapshot(spark, tmp_path):
    table = SnapshotTable(spark, f"{tmp_path}/t")
    table.replace(spark.range(5).toDF("k"))
    broken = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long").alias("k"))
    with pytest.raises(Exception, match="broken"):
        table.replace(broken)
    (tmp_path / "t" / "manifests" / "0000000002").mkdir()  # a manifest whose writer was lost
    assert table.versions() == [1] and values(table.read(SCHEMA)) == list(range(5))


def test_two_writers(spark, tmp_path):
    table = SnapshotTable(spark, f"{tmp_path}/t")
    table.replace(spark.range(1).toDF("k"))
    table.replace(spark.range(2).toDF("k"))
    with pytest.raises(RuntimeError, match="after version 1"):
        table.publish({"x": "data/none"}, since=1)
    assert values(table.read(SCHEMA)) == [0, 1]


def test_parts(spark, tmp_path):
    table = SnapshotTable(spark, f"{tmp_path}/t")
    for name, n in (("a", 1), ("b", 5)):
        spark.range(n, n + 1).toDF("k").write.parquet(f"{table.root}/data/{name}")
        table.publish({name: f"data/{name}"})
    assert values(table.read(SCHEMA)) == [1, 5] and values(table.read(SCHEMA, ["b", "z"])) == [5]
    table.publish({"a": None, "b": None})
    assert table.parts() == {} and values(table.read(SCHEMA)) == []


DAY0 = dt.datetime(2026, 5, 1)
FACTS = "id long, shop_id long, ts timestamp, v decimal(12,2), ip string"


def facts(spark, g, n):
    rows = [
        (i, g.choice([1, 1, 1, 2, 3, None]), DAY0 + dt.timedelta(hours=g.randrange(24 * 40)) if g.random() < 0.95 else None,
         None if g.random() < 0.1 else g.randrange(-500, 9000) / 100, f"ip{g.randrange(200)}")
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "id long, shop_id long, ts timestamp, v double, ip string").withColumn("v", F.col("v").cast("decimal(12,2)"))


MEASURES = [Measure("v", "avg", "v"), Measure("top", "max", "v"), Measure("low", "min", "v"),
            Measure("total", "sum", "v"), Measure("rows", "count", "id"), Measure("ips", "distinct", "ip")]
WANTED = [LastDays(f"{m.name}_{n}", m.name, n) for m in MEASURES for n in (2, 9, 30)]


def single_pass(df, as_of):
    at = F.col("ts")
    inside = lambda n: (at >= F.lit(as_of - dt.timedelta(days=n + 1))) & (at < F.lit(as_of))
    build = {"avg": lambda v: F.sum(v).cast("double") / F.nullif(F.count(v), F.lit(0)), "max": F.max, "min": F.min, "sum": F.sum, "count": F.count,
             "distinct": lambda v: F.hll_sketch_estimate(F.hll_sketch_agg(v, partials.SKETCH_BITS))}
    kinds = {m.name: m for m in MEASURES}
    out = [build[kinds[w.measure].kind](F.when(inside(w.days), F.col(kinds[w.measure].value))).alias(w.name) for w in WANTED]
    return df.filter(inside(30)).groupBy("shop_id").agg(*out)


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_partials_equal_a_single_pass_after_late_and_deleted_rows(spark, tmp_path):
    """Unions of stored sketches estimate just what one sketch over all rows does."""
    df = facts(spark, random.Random(1), 3000)
    store = DayStore(spark, f"{tmp_path}/s", ["shop_id"], "ts", MEASURES)
    as_of = (DAY0 + dt.timedelta(days=35)).date()
    early = df.filter("id % 50 <> 7 or shop_id is null")
    store.refresh(early, days_of(early, "ts"))
    late = df.filter("id % 50 = 7 and shop_id is not null")
    store.refresh(df, days_of(late, "ts"))
    assert rows_of(store.windows(store.schema(df), as_of, WANTED)) == rows_of(single_pass(df, as_of))
    gone = (DAY0 + dt.timedelta(days=20)).date()
    less = df.filter(F.col("ts").cast("date") != F.lit(gone))
    store.refresh(less, [gone])
    assert str(gone) not in store.table.parts()
    assert rows_of(store.windows(store.schema(df), as_of, WANTED)) == rows_of(single_pass(less, as_of))
    store.refresh(df, [])
    store.table.retire(keep=1)
    assert rows_of(store.windows(store.schema(df), as_of, WANTED)) == rows_of(single_pass(less, as_of))
    assert store.windows(store.schema(df), dt.date(1990, 1, 1), WANTED).count() == 0


def test_refresh_scans_changed_days_alone(spark, tmp_path):
    df = facts(spark, random.Random(2), 500)
    df.withColumn("d", F.col("ts").cast("date")).write.parquet(f"{tmp_path}/facts")
    stored = spark.read.parquet(f"{tmp_path}/facts")
    store = DayStore(spark, f"{tmp_path}/s", ["shop_id"], "ts", MEASURES)
    plan = store.changed(stored, [dt.date(2026, 5, 3), dt.date(2026, 5, 4)])._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2026-05-03" in plan and "LessThan(ts,2026-05-05" in plan
    store.refresh(stored, days_of(stored, "ts"))
    window = store.windows(store.schema(stored), dt.date(2026, 5, 20), [LastDays("n", "rows", 3)])
    files = window.inputFiles()
    assert files and {f.split("part=")[1][:10] for f in files} <= {f"2026-05-{d}" for d in (16, 17, 18, 19)}


def test_error_of_sketches(spark):
    """The stated error, over many sets: about 1.6 % (one standard deviation), and none for small sets."""
    df = spark.range(40 * 20_000).selectExpr("id % 40 as k", "id as v")
    got = df.groupBy("k").agg(F.hll_sketch_estimate(F.hll_sketch_agg("v", partials.SKETCH_BITS)).alias("n")).collect()
    errors = [r.n / 20_000 - 1 for r in got]
    assert max(map(abs, errors)) < 4 * 0.0163 and (sum(e * e for e in errors) / len(errors)) ** 0.5 < 1.5 * 0.0163
    small = spark.range(50 * 30).selectExpr("id % 50 as k", "id as v").groupBy("k")
    assert {r.n for r in small.agg(F.hll_sketch_estimate(F.hll_sketch_agg("v", partials.SKETCH_BITS)).alias("n")).collect()} == {30}


def test_daily_metrics_after_a_late_batch(spark, tmp_path):
    g = random.Random(5)
    day = lambda: DAY0 + dt.timedelta(hours=g.randrange(24 * 33))
    orders = spark.createDataFrame(
        [(i, g.randrange(4), day(), g.choice([" Direct", "", "facebook", None, "x"]), g.randrange(999), g.randrange(999), g.randrange(99)) for i in range(400)],
        "id int, shop_id int, order_created_at timestamp, order_traffic_source string, gmv int, merchant_profit int, max_raw_price_lineitem int",
    )
    events = spark.createDataFrame([(g.randrange(5), day(), g.choice(["view", "purchase", "x"])) for _ in range(300)], "shop_id int, created_at timestamp, event_name string")
    store = DailyMetrics(spark, f"{tmp_path}/d", orders.schema, events.schema)
    early, late = orders.filter("id % 30 <> 1"), orders.filter("id % 30 = 1")
    store.refresh_orders(early, days_of(early, "order_created_at"))
    store.refresh_events(events, days_of(events, "created_at"))
    store.refresh_orders(orders, days_of(late, "order_created_at"))
    as_of = (DAY0 + dt.timedelta(days=33)).date()
    assert rows_of(store.metrics(as_of)) == rows_of(merchant_daily_metrics(orders, events, as_of))


def test_numbers_equal_a_window(spark):
    g = random.Random(9)
    rows = [(g.choice([None, "hot", "hot", "hot", "a", "b"]), g.choice([None, *range(60)]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "grp string, t int, id int").repartition(7).withColumn("_g0", F.lit(1))
    for within in (["grp"], []):
        expected = df.withColumn("n", F.row_number().over(Window.partitionBy(*(within or [F.lit(1)])).orderBy("t", "id")))
        got = numbered(df.drop("_g0"), ["t", "id"], within, "n")
        assert {(r.id, r.n) for r in got.collect()} == {(r.id, r.n) for r in expected.collect()}
    assert numbered(df.limit(0).drop("_g0"), ["t"], ["grp"]).count() == 0


def test_a_hot_page_is_spread_over_tasks(spark):
    """A single page is sorted in many ranges, and its text is cut as before."""
    df = spark.range(20_000, numPartitions=6).selectExpr("0 as page", "cast(19999 - id as string) as shown", "id as at")
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.adaptive.coalescePartitions.enabled",)}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranges = numbered(df, ["at"], ["page"], "n").inputFiles()
        parts = id_list(df, "shown", ["page"], ["at"]).orderBy("page_part").collect()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(ranges) >= 3
    assert [r.id_count for r in parts] == [1000] * 20
    assert ", ".join(r.id_text for r in parts) == ", ".join(str(19999 - i) for i in range(20_000))


def test_running_totals_equal_a_window(spark):
    g = random.Random(3)
    rows = [(g.choice([1, 1, 1, 2, None]), g.choice([None, *(DAY0 + dt.timedelta(hours=h) for h in range(300))]), g.choice([None, *range(-50, 50)])) for _ in range(2000)]
    df = spark.createDataFrame(rows, "k long, at timestamp, v long").repartition(5)
    got = {(r.k, r["at"]): r.total for r in running_totals(df, ["k"], "at", {"total": F.col("v")}).collect()}
    known = [(k, t, v or 0) for k, t, v in rows if None not in (k, t)]
    assert got == {(k, t): sum(x for m, u, x in known if m == k and u <= t) for k, t, _ in known}
    assert running_totals(df.limit(0), ["k"], "at", {"total": F.col("v")}).count() == 0
