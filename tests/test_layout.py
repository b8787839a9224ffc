import contextlib
import io
import uuid
from pathlib import Path
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from martwright.catalog.queries import CONSOLIDATED
from martwright.plans import consolidated_merchant
from martwright.sources import KeyedLayout, SampleStar

ROLES = ("merchants", "orders", "web_sessions", "disputes")


@pytest.fixture
def layout(spark, tmp_path):
    made = []

    def build(key="k", buckets=4, **more):
        made.append(KeyedLayout(spark, f"{tmp_path}/{len(made)}", f"t{uuid.uuid4().hex}", key, buckets, **more))
        return made[-1]

    return build


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def plan_of(df, mode="simple"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def test_mart_on_the_layout_needs_no_shuffle(spark, sf_dir, layout, no_broadcast):
    star, stored = SampleStar(spark, sf_dir), layout("shop_id")
    stored.write(star.only(*ROLES))
    even = consolidated_merchant(stored.part("even", ROLES), CONSOLIDATED)
    assert "Exchange" not in plan_of(even) and plan_of(even).count("Bucketed: true") == 4
    assert "Exchange" in plan_of(consolidated_merchant(star, CONSOLIDATED))
    both = stored.per_key(lambda t: consolidated_merchant(t, CONSOLIDATED), ROLES)
    want = consolidated_merchant(star, CONSOLIDATED)
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, want.collect()))


def test_hot_key_is_stored_apart_in_every_table(spark, layout):
    stored = layout(buckets=8)
    facts = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    names = spark.range(0, 9000, 5).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))
    names = names.unionByName(spark.range(1).select(F.lit(7).cast("bigint").alias("k"), F.lit("seven").alias("name")))
    assert stored.write({"facts": facts, "names": names}) == [7]
    hot, even = stored.part("hot", ["facts", "names"]), stored.part("even", ["facts", "names"])
    assert hot["facts"].count() == 3001 and {r.k for r in hot["facts"].select("k").distinct().collect()} == {7}
    assert [tuple(r) for r in hot["names"].collect()] == [(7, "seven")]
    assert even["facts"].filter("k = 7").count() == 0 and even["facts"].count() == 5999
    per_bucket = [r.n for r in even["facts"].groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(per_bucket) == 8 and max(per_bucket) < 2 * 5999 / 8  # one file a bucket, none overfull

    def build(t):
        return t["names"].join(t["facts"].groupBy("k").agg(F.sum("v").alias("s")), "k", "left")

    want = build({"facts": facts, "names": names})
    assert sorted(stored.per_key(build, ["facts", "names"]).collect()) == sorted(want.collect())


def test_given_keys_open_their_buckets_only(spark, table, layout):
    stored = layout()
    rows = [(i, f"v{i}") for i in range(40)] + [(None, "none"), (None, "none"), (3, "v3")]
    stored.write({"facts": table("k int, v string", rows)})
    found = stored.rows_of("facts", [3, None, 99])
    assert sorted(map(str, found.collect())) == sorted(
        ["Row(k=3, v='v3')"] * 2 + ["Row(k=None, v='none')"] * 2
    )
    files = stored.part("even", ["facts"])["facts"].select(F.input_file_name().alias("file"), "k").collect()
    wanted = {r.file for r in files if r.k == 3}
    for other in {r.file for r in files} - wanted:  # whoever opens one of these fails
        Path(urlparse(other).path).write_bytes(b"no parquet" * 50)
    spark.catalog.refreshTable(f"{stored.name}_facts_even")
    assert len(wanted) == 1 and stored.rows_of("facts", [3]).count() == 2
    with pytest.raises(Exception, match="(?i)parquet|corrupt"):
        stored.part("even", ["facts"])["facts"].collect()


def test_layout_opens_in_another_catalog_and_tables_may_be_empty(spark, table, layout, no_broadcast):
    stored = layout()
    tables = {"a": table("k int, v decimal(5,2)", [(1, "1.50"), (2, None)]), "b": table("k int, w int", [])}
    stored.write(tables)
    stored.forget("ab")
    assert not spark.catalog.tableExists(f"{stored.name}_a_even")
    stored.open({role: df.schema for role, df in tables.items()})
    joined = stored.per_key(lambda t: t["a"].join(t["b"], "k", "left"), "ab")
    assert sorted(map(str, joined.collect())) == ["Row(k=1, v=Decimal('1.50'), w=None)", "Row(k=2, v=None, w=None)"]
    even = stored.part("even", "ab")
    assert "Exchange" not in plan_of(even["a"].join(even["b"], "k", "left"))


def test_no_name_is_written_twice_and_arguments_are_checked(table, layout):
    stored, rows = layout(), table("k int", [(1,)])
    stored.write({"a": rows})
    with pytest.raises(Exception, match="already exists"):
        stored.write({"a": rows})
    with pytest.raises(ValueError):
        layout(buckets=0)
