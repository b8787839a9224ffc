import math

import pytest
from pyspark.sql import functions as F

from martwright import functions as fn
from martwright.operators.joins import literal_rows, with_config
from martwright.config import BillingConfig


def values(df):
    return [r[0] for r in df.collect()]


def test_norm_key_trims_spaces_only(table):
    df = table("t string", [("  Do Not HONOR ",), ("a\t",), (None,)])
    assert values(df.select(fn.norm_key("t"))) == ["do not honor", "a\t", None]


def test_safe_div_and_ratio_or_zero(table):
    df = table("a int, b int", [(1, 4), (1, 0), (None, 2), (3, None)])
    assert values(df.select(fn.safe_div("a", "b"))) == [0.25, None, None, None]
    assert values(df.select(fn.ratio_or_zero("a", "b"))) == [0.25, 0.0, None, 0.0]


@pytest.mark.parametrize(
    ("ratio", "text"),
    [
        (None, None), (0.0, "   0.00%"), (-0.015, "  -1.50%"), (0.5, "  50.00%"), (1.5, " 150.00%"),
        (-1.5, "-150.00%"), (9.9999, " 999.99%"), (12.0, " ###.##%"), (-12.0, "-###.##%"), (1 / 32, "   3.13%"),
        (1e30, " ###.##%"),
    ],
)
def test_pct_text(table, ratio, text):
    assert values(table("r double", [(ratio,)]).select(fn.pct_text("r"))) == [text]


def test_delimiter_tier(table):
    df = table("t string", [("a",), ("a,b",), ("a,b,c",), ("a,b,c,d",), ("a,b,c,d,e",), (None,), ("",)])
    assert values(df.select(fn.delimiter_tier("t"))) == ["1", "2", "3", ">=4", ">=4", ">=4", "1"]


def test_regex_flag_and_contains_flag(table):
    df = table("t string", [("x stolen_card y",), ("STOLEN_CARD",), (None,), ("pickup_card pickup_card",)])
    assert values(df.select(fn.regex_flag("t", "stolen_card|pickup_card"))) == [1, 0, 0, 1]
    assert values(df.select(fn.contains_flag("t", ["stolen"]))) == [1, 1, 0, 0]


def test_map_code_passes_unknown_through(table):
    df = table("c string", [("USA",), ("BRA",), (None,)])
    assert values(df.select(fn.map_code("c", {"USA": "United States"}, "UNKNOWN"))) == ["United States", "BRA", "UNKNOWN"]


def test_pair(table):
    df = table("a string, b string", [("x", "y"), (None, "y"), (None, None)])
    assert values(df.select(fn.pair("a", "b"))) == ["x-y", "-y", "-"]


def test_days_between_counts_boundaries(table):
    df = table("a timestamp, b timestamp", [("2026-01-02 00:01:00", "2026-01-01 23:59:00")])
    assert values(df.select(fn.days_between(F.col("a"), F.col("b")))) == [1]


def test_week_of_year_is_iso(table):
    df = table("d date", [("2027-01-01",), ("2026-01-01",)])
    assert values(df.select(F.weekofyear("d"))) == [53, 1]


def test_code_list(table):
    df = table("k int, c string", [(1, "b"), (1, "a"), (1, "b"), (2, None)])
    both = df.groupBy("k").agg(fn.code_list("c").alias("d"), fn.code_list("c", ",", distinct=False).alias("a"))
    assert {tuple(r) for r in both.collect()} == {(1, "a, b", "a,b,b"), (2, None, None)}


def test_conditional_aggregates(table):
    df = table("k int, v decimal(18,2), ok int", [(1, "1.00", 1), (1, "2.00", 1), (1, "9.00", 0), (2, "5.00", 0)])
    ok = F.col("ok") == 1
    got = df.groupBy("k").agg(
        fn.cond_count(ok, "v"), fn.cond_avg(ok, "v"), fn.cond_max(ok, "v"), fn.cond_count_distinct(ok, "v"),
        fn.any_flag(ok), fn.ratio_of_sums("ok", "v"),
    ).orderBy("k").collect()
    assert tuple(got[0][1:]) == (2, 1.5, 2, 2, 1, 2 / 12)
    assert tuple(got[1][1:]) == (0, None, None, 0, 0, 0.0)


def test_emails(table):
    df = table("e string", [("A@B.example",), ("no-at",), ("x@mail",), (None,)])
    got = df.select(fn.email_domain("e"), fn.is_valid_email("e")).collect()
    assert [tuple(r) for r in got] == [("b.example", True), (None, False), ("mail", False), (None, None)]


def test_haversine(table):
    df = table("a double, b double, c double, d double", [(40.64, -73.78, 51.47, -0.45), (1.0, 2.0, 1.0, 2.0)])
    far, near = values(df.select(fn.haversine_miles(*(F.col(c) for c in "abcd"))))
    a, b, c, d = (math.radians(x) for x in (40.64, -73.78, 51.47, -0.45))
    arc = math.acos(math.sin(a) * math.sin(c) + math.cos(a) * math.cos(c) * math.cos(d - b))
    assert math.isclose(far, 3958.8 * arc, rel_tol=1e-9) and near == 0.0


def test_literal_rows_escape_and_type(spark):
    rows = [(1, "it's \\ fine"), (2, None)]
    df = literal_rows(spark, "k bigint, t string", rows)
    assert [tuple(r) for r in df.orderBy("k").collect()] == rows
    assert dict(df.dtypes) == {"k": "bigint", "t": "string"}


def test_with_config_adds_literals(table):
    row = with_config(table("k int", [(1,)]), BillingConfig()).first()
    assert (row.cfg_max_pending_amount, row.cfg_tenured_days, row.cfg_tenured_orders) == (200.0, 30, 100)
