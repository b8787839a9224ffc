"""Order, buyer, shop and network features that the marts read as ready-made columns.

Counts over a buyer, card or tracking number are aggregated (map-side first) and joined back; a
window over the raw rows would bring a hot value's rows into one task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import (
    as_of_day,
    cond_count,
    email_domain,
    haversine_miles,
    is_valid_email,
    norm_key,
    safe_div,
)
from .joins import attach
from .numbering import numbered
from .partials import DayStore, LastDays, Measure
from .temporal import Rolling, as_of_join, rolling_as_of


def buyer_velocity(
    orders: DataFrame, buyer: str = "buyer_email", ts: str = "order_created_at",
    name: str = "no_order_customer_email_per_day", spread: int = 1, counted: DataFrame | None = None,
) -> DataFrame:
    """Add the number of orders the same buyer placed that calendar day (0 for an unknown buyer).

    ``counted`` is a narrower table of the same orders, where counting on it is cheaper.
    """
    known = F.col("_buyer").isNotNull()
    key = {"_buyer": norm_key(buyer), "_day": F.col(ts).cast("date")}
    keyed = orders.withColumns(key)
    totals = (orders if counted is None else counted).withColumns(key).filter(known).groupBy("_buyer", "_day").agg(F.count(F.lit(1)).alias(name))
    return attach(keyed, totals, ["_buyer", "_day"], spread=spread).fillna(0, [name]).drop("_buyer", "_day")


def buyer_velocity_at_order(
    orders: DataFrame, order_id: str = "order_id", buyer: str = "buyer_email", ts: str = "order_created_at",
    name: str = "buyer_orders_so_far_that_day",
) -> DataFrame:
    """Add how many orders the same buyer had placed that calendar day up to each order, itself included.

    What is known when an order comes in: later orders of the day don't count. Orders of one instant follow by id. Unknown
    buyers and orders without a time have 0. A buyer's day is numbered by ranges, so a buyer who places very many orders is
    spread over tasks.
    """
    keyed = orders.select(order_id, F.col(ts).alias("_ts"), norm_key(buyer).alias("_buyer"), F.col(ts).cast("date").alias("_day"))
    placed = keyed.filter(F.col("_buyer").isNotNull() & F.col("_ts").isNotNull())
    counted = numbered(placed, ["_ts", order_id], ["_buyer", "_day"], name).select(order_id, name)
    return orders.join(counted, order_id, "left").fillna(0, [name])


def buyer_history(
    orders: DataFrame, buyer: str = "buyer_email", status: str = "order_status",
    returned: Sequence[str] = ("cancelled", "refunded"), spread: int = 1, counted: DataFrame | None = None,
) -> DataFrame:
    """Add the buyer's order count and cancelled/refunded order count over the whole table.

    ``counted`` is a narrower table of the same orders, where counting on it is cheaper.
    """
    names = ["count_order_of_customer", "count_order_cancel_refund_by_buyer_email"]
    keyed = orders.withColumn("_buyer", norm_key(buyer))
    totals = (
        (orders if counted is None else counted)
        .withColumn("_buyer", norm_key(buyer))
        .filter("_buyer is not null")
        .groupBy("_buyer")
        .agg(
            F.count(F.lit(1)).alias(names[0]),
            cond_count(F.lower(status).isin(*returned), F.lit(1)).alias(names[1]),
        )
    )
    return attach(keyed, totals, "_buyer", spread=spread).fillna(0, names).drop("_buyer")


def card_features(
    orders: DataFrame, card: str = "card_token", customer: str = "buyer_email", ts: str = "order_created_at"
) -> DataFrame:
    """Per card: customers that used it, and mean payment intents per active day.

    Two chained groupings, by (card, customer) and by (card, day): each is aggregated map-side, and
    no row is multiplied for a second distinct count.
    """
    known = orders.filter(F.col(card).isNotNull()).select(card, F.col(customer).alias("_by"), F.col(ts).cast("date").alias("_day"))
    customers = known.filter("_by is not null").groupBy(card, "_by").agg(F.lit(1).alias("_one"))
    customers = customers.groupBy(card).agg(F.count(F.lit(1)).alias("count_customer_by_card"))
    days = known.groupBy(card, "_day").agg(F.count(F.lit(1)).alias("_intents"))
    days = days.groupBy(card).agg(
        safe_div(F.sum("_intents"), F.count("_day")).alias("avg_payment_intent_by_card_per_day")
    )
    return days.join(customers, card, "left").select(
        card, F.coalesce("count_customer_by_card", F.lit(0)).cast("bigint").alias("count_customer_by_card"),
        "avg_payment_intent_by_card_per_day",
    )


def order_card_features(
    orders: DataFrame, card: str = "card_token", customer: str = "buyer_email", ts: str = "order_created_at",
    spread: int = 1,
) -> DataFrame:
    """Add the card features to each order; NULL for an order without a card."""
    return attach(orders, card_features(orders, card, customer, ts), card, spread=spread)


def tracking_reuse(
    shipments: DataFrame, tracking: str = "tracking_number", customer: str = "customer_id",
    name: str = "distinct_customers_same_tracking", spread: int = 1,
) -> DataFrame:
    """Add how many customers share the row's tracking number (NULL without a number)."""
    totals = (
        shipments.filter(F.col(tracking).isNotNull())
        .groupBy(tracking)
        .agg(F.count_distinct(customer).cast("int").alias(name))
    )
    return attach(shipments, totals, tracking, spread=spread)


def match_text(left: Column, right: Column) -> Column:
    """'match' / 'not match', empty when a side is unknown."""
    known = left.isNotNull() & right.isNotNull()
    return F.when(known & (left == right), "match").when(known, "not match").otherwise("")


def geo_features(
    orders: DataFrame, shipping: str = "shipping_country", ip: str = "ip_country", card: str = "card_country",
    billing: str = "billing_country",
) -> DataFrame:
    """Add the country comparison texts and the billing-to-shipping distance in miles."""
    ship, net, pay, bill = (F.col(c) for c in (shipping, ip, card, billing))
    return orders.withColumns({
        "shipping_match_ip_country": match_text(ship, net),
        "shipping_match_card_country": match_text(ship, pay),
        "ip_match_card_country": match_text(net, pay),
        "billing_match_card_country": F.when(bill != pay, "billing country doesn't match card").when(
            bill == pay, "match"
        ).otherwise(""),
        "billing_shipping_match": match_text(bill, ship),
        "distance_billing_to_shipment": haversine_miles(
            F.col("billing_lat"), F.col("billing_lon"), F.col("shipping_lat"), F.col("shipping_lon")
        ),
    })


def email_quality(
    orders: DataFrame, disposable_domains: DataFrame, shop: str = "shop_id", email: str = "buyer_email"
) -> DataFrame:
    """Per shop: share of orders with a disposable and with a malformed buyer e-mail."""
    listed = disposable_domains.select(norm_key(disposable_domains.columns[0]).alias("_domain")).distinct()
    listed = listed.withColumn("_listed", F.lit(True))
    mails = (
        orders.filter(F.col(email).isNotNull())
        .select(shop, email_domain(email).alias("_domain"), (~is_valid_email(email)).alias("_bad"))
        .groupBy(shop, "_domain")
        .agg(F.count(F.lit(1)).alias("_n"), F.count_if("_bad").alias("_bad"))
    )
    mails = attach(mails, listed, "_domain")
    return mails.groupBy(shop).agg(
        safe_div(F.sum(F.when(F.col("_listed"), F.col("_n")).otherwise(0)), F.sum("_n")).alias("disposable_email_rate"),
        safe_div(F.sum("_bad"), F.sum("_n")).alias("invalid_email_rate"),
    )


def multi_store_rate(
    orders: DataFrame, shop: str = "shop_id", buyer: str = "buyer_email", min_shops: int = 2
) -> DataFrame:
    """Per shop: share of its buyers that buy in at least ``min_shops`` shops."""
    visits = (
        orders.select(shop, norm_key(buyer).alias("_buyer")).filter(f"{shop} is not null and _buyer is not null").distinct()
    )
    roams = F.when(F.count(F.lit(1)) >= min_shops, 1).otherwise(0)
    roaming = visits.groupBy("_buyer").agg(roams.alias("_roams"))
    return (
        attach(visits, roaming, "_buyer", "inner")
        .groupBy(shop)
        .agg(
            F.count(F.lit(1)).alias("buyer_count"),
            F.sum("_roams").alias("multi_store_buyers"),
            safe_div(F.sum("_roams"), F.count(F.lit(1))).alias("multi_store_buyer_rate"),
        )
    )


def ip_footprint(
    sessions: DataFrame, shop: str = "shop_id", ip: str = "ip_address", relative_error: float | None = None
) -> DataFrame:
    """Per shop: distinct session addresses, exact unless a relative error is allowed."""
    count = F.count_distinct(ip) if relative_error is None else F.approx_count_distinct(ip, relative_error)
    return sessions.groupBy(shop).agg(count.alias("unique_ip_location_count"))


def session_ip_mismatch(
    orders: DataFrame, sessions: DataFrame, key: str, order_ts: str, session_ts: str, within: str,
    order_ip: str = "order_ip", session_ip: str = "ip_address", tie: str = "session_id",
    piece: str = "day",
) -> DataFrame:
    """Compare each order's address with the latest session at most ``within`` earlier.

    Sessions are read only in the pieces of time that some order of the same key reaches back to.
    """
    seen = as_of_join(
        orders, sessions.withColumns({"_seen": F.col(session_ts), "_ip": F.col(session_ip)}),
        key, order_ts, session_ts, ["_seen", "_ip"], tie=tie, piece=piece, within=within,
    )
    recent = F.col("_seen") >= F.col(order_ts) - F.expr(f"interval {within}")
    return (
        seen.withColumn("session_ip", F.when(recent, F.col("_ip")))
        .withColumn("sig_order_session_ip_mismatch", F.when(F.col("session_ip") != F.col(order_ip), 1).otherwise(0))
        .drop("_seen", "_ip")
    )


# Windows in days and the text of unattributed traffic.
DIRECT_SOURCES = ("direct", "")
SOCIAL_SOURCES = ("facebook", "tiktok")


def _sales() -> tuple[list[Measure], list[LastDays]]:
    source = F.lower(F.trim("order_traffic_source"))
    measures = [
        Measure("profit", "avg", F.col("merchant_profit")),
        Measure("gmv", "avg", F.col("gmv")),
        Measure("top_line", "max", F.col("max_raw_price_lineitem")),
        Measure("orders", "count", F.lit(1)),
        Measure("direct", "count", F.when(source.isin(*DIRECT_SOURCES), 1)),
        Measure("social", "count", F.when(source.isin(*SOCIAL_SOURCES), 1)),
    ]
    windows = [
        *(LastDays(f"avg_profit_l{n}d", "profit", n) for n in (3, 7, 30)),
        *(LastDays(f"avg_gmv_l{n}d", "gmv", n) for n in (3, 7, 30)),
        *(LastDays(f"max_lineitem_gmv_l{n}d", "top_line", n) for n in (3, 7)),
        *(LastDays(f"_{m}_l{n}d", m, n) for m in ("orders", "direct") for n in (3, 7, 30)),
        LastDays("_social_l30d", "social", 30),
    ]
    return measures, windows


def _funnel() -> tuple[list[Measure], list[LastDays]]:
    name = F.col("event_name")
    measures = [Measure("views", "count", F.when(name == "view", 1)), Measure("buys", "count", F.when(name == "purchase", 1))]
    return measures, [LastDays(f"_{m.name}_l{n}d", m.name, n) for m in measures for n in (3, 7, 30)]


def _in_one_pass(df: DataFrame, key: str, ts: str, day: Column, stated: tuple[list[Measure], list[LastDays]], extra_days: int) -> DataFrame:
    of = {m.name: m for m in stated[0]}
    specs = [Rolling(w.name, of[w.measure].kind, of[w.measure].value, w.days, extra_days) for w in stated[1]]
    return rolling_as_of(df, [key], ts, day, specs)


def merchant_daily_metrics(
    orders: DataFrame, events: DataFrame, as_of, shop: str = "shop_id", extra_days: int = 1, events_as_of=None
) -> DataFrame:
    """Windowed metrics per shop: one pass over orders and one over funnel events.

    Both passes read only the last 30 days; the results are joined per shop. ``events_as_of`` is the
    events' own anchor day where their calendar differs.
    """
    day = as_of_day(as_of)
    sales = _in_one_pass(orders, shop, "order_created_at", day, _sales(), extra_days)
    funnel = _in_one_pass(events, shop, "created_at", day if events_as_of is None else as_of_day(events_as_of), _funnel(), extra_days)
    return _daily_metrics(sales, funnel, shop)


def _daily_metrics(sales: DataFrame, funnel: DataFrame, shop: str) -> DataFrame:
    return sales.join(funnel, shop, "full").select(
        shop,
        *(f"avg_profit_l{n}d" for n in (3, 7, 30)),
        *(f"avg_gmv_l{n}d" for n in (3, 7, 30)),
        *(f"max_lineitem_gmv_l{n}d" for n in (3, 7)),
        *(safe_div(f"_buys_l{n}d", f"_views_l{n}d").alias(f"cr_view_to_purchase_l{n}d") for n in (3, 7, 30)),
        *(safe_div(f"_direct_l{n}d", f"_orders_l{n}d").alias(f"pct_direct_traffic_l{n}d") for n in (3, 7, 30)),
        safe_div("_social_l30d", "_orders_l30d").alias("pct_social_traffic_l30d"),
    )


class DailyMetrics:
    """:func:`merchant_daily_metrics` from partials per shop and day that are kept in a folder.

    ``refresh_orders`` and ``refresh_events`` compute given days anew (those of a late batch, or yesterday); ``metrics``
    merges the days of its windows and reads no order or event.
    """

    def __init__(self, spark: SparkSession, root: str, orders: StructType, events: StructType, shop: str = "shop_id"):
        empty = lambda schema: spark.createDataFrame([], schema)
        self.shop = shop
        self.orders = DayStore(spark, f"{root}/orders", [shop], "order_created_at", _sales()[0])
        self.events = DayStore(spark, f"{root}/events", [shop], "created_at", _funnel()[0])
        self._schemas = self.orders.schema(empty(orders)), self.events.schema(empty(events))

    def refresh_orders(self, orders: DataFrame, days: Sequence[dt.date]) -> None:
        self.orders.refresh(orders, days)

    def refresh_events(self, events: DataFrame, days: Sequence[dt.date]) -> None:
        self.events.refresh(events, days)

    def metrics(self, as_of: dt.date, events_as_of: dt.date | None = None, extra_days: int = 1) -> DataFrame:
        sales = self.orders.windows(self._schemas[0], as_of, _sales()[1], extra_days)
        funnel = self.events.windows(self._schemas[1], events_as_of or as_of, _funnel()[1], extra_days)
        return _daily_metrics(sales, funnel, self.shop)


__all__ = [
    "DailyMetrics", "buyer_history", "buyer_velocity", "buyer_velocity_at_order", "card_features", "email_quality", "geo_features",
    "ip_footprint", "match_text", "merchant_daily_metrics", "multi_store_rate", "order_card_features",
    "session_ip_mismatch", "tracking_reuse",
]
