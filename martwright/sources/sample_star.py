"""Role tables derived from the sample star schema (region, nation, customer, supplier, part,
orders, lineitem, events).

Every derivation is a plain projection, join or grouping over the whole source tables. Amounts
are cut to whole cents with integer arithmetic, so they are exact decimals in any engine.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.features import (
    buyer_history,
    buyer_velocity,
    email_quality,
    ip_footprint,
    merchant_daily_metrics,
    multi_store_rate,
    tracking_reuse,
)
from ..operators.joins import literal_rows

ORDERS_AS_OF = dt.date(2001, 8, 2)
EVENTS_AS_OF = dt.date(2024, 1, 31)

# Literal side tables of the sample: response texts, registries, mail domains, country names.
GATEWAY_A_CODES = (
    (" Deliver In Person ", "DECLINE_INSUFFICIENT"), ("collect cod", "RETRY_LATER"),
    ("COLLECT COD", "SOFT_FAILURE"), ("none", "DO_NOT_HONOR"),
)
GATEWAY_B_CODES = (
    ("Return Requested", "SOFT_FAILURE"), ("return requested ", "RETRY_LATER"), ("Accepted", "OK"),
    ("Not Returned", "HARD_DECLINE"),
)
PAYPAL_CODES = (("open  line", "INSTRUMENT_OPEN"), ("OPEN LINE", "PENDING"), ("filled line", "SETTLED"))
STRIPE_CODES = (("card_declined", "CARD_DECLINE"), ("Expired_Card ", "EXPIRED"), ("incorrect_cvc", "CVC"))
RESTRICTED_MAILS = (" Nation_5@Payout.Example", "nation_17@payout.example", "extra@payout.example",
                    "Shared@Payout.example")
DISPOSABLE_DOMAINS = ("mailinator.example", "tempmail.example")
DISPUTE_KEYWORDS = ("blue", "green")
PENDING = "P"  # the sample's status of open orders, requests and invoices


def cents(price: str) -> str:
    return f"cast(round({price} * 100) as bigint)"


def scaled(price: str, divisor: int) -> str:
    """``price / divisor`` in whole cents, as SQL text."""
    return f"cast(floor({cents(price)} / {divisor}) as bigint)"


def money(whole_cents: str) -> str:
    return f"cast(({whole_cents}) * 0.01 as decimal(18,2))"


EVENT_K = "get_json_object(props, '$.k')"  # the k property of an event, as text
TRAFFIC = (
    "case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'direct' when o_orderpriority = '5-LOW' then '' "
    "when o_orderpriority = '3-MEDIUM' then 'facebook' else 'google' end"
)
IS_TEST = "case when o_totalprice < 2000 then 1 else 0 end"  # sandbox-sized orders count as tests
# Mixed case; some domains are disposable, some addresses malformed. Four customers in ten order as guests, under
# another name each time; an agent orders for three in ten, and so often in a day.
BUYER_EMAIL = (
    "concat(case when o_custkey % 10 < 4 then concat('Guest', ORDER_KEY) when o_custkey % 10 < 7 then 'Agent' "
    "else concat('Buyer', o_custkey) end, case o_orderpriority when '1-URGENT' then '@Mailinator.example' "
    "when '2-HIGH' then '@mail' else '@Buyers.example' end)"
)

ORDER_STATUS = "case o_orderstatus when 'F' then 'cancelled' when 'P' then 'refunded' else 'completed' end"


class SampleStar:
    """Role tables over one folder of sample parquet files. Mapping access: ``star["dim_order"]``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        """A source table, opened once."""
        if name not in self._raw:
            path = f"{self.folder}/{name}.parquet"
            self._raw[name] = self.spark.read.parquet(path)
        return self._raw[name]

    def __getitem__(self, role: str) -> DataFrame:
        return getattr(self, role)

    def only(self, *roles: str) -> dict[str, DataFrame]:
        return {role: self[role] for role in roles}

    # ---- benchmark star -------------------------------------------------------------------

    @cached_property
    def merchants(self) -> DataFrame:
        country = self.raw("nation").selectExpr("n_nationkey as c_nationkey", "n_name as country")
        return self.raw("customer").join(country, "c_nationkey", "left").selectExpr(
            "c_custkey as shop_id",
            "cast(1000 + c_nationkey as bigint) as user_id",
            "case c_mktsegment when 'MACHINERY' then 0 else 1 end as is_public_domain",
            "country",
        )

    @cached_property
    def orders(self) -> DataFrame:
        return self.raw("orders").selectExpr("*", f"{scaled('o_totalprice', 400)} as g").selectExpr(
            "o_orderkey as order_id",
            "o_custkey as shop_id",
            "o_orderdate as order_created_at",
            f"{money('g')} as gmv",
            f"{money('g - cast(floor(g * (103 - dayofmonth(o_orderdate)) / 100) as bigint)')} as merchant_profit",
            f"{TRAFFIC} as traffic_source",
            "'US' as shipping_country",
            "case weekday(o_orderdate) when 6 then 'VN' when 5 then null else 'US' end as card_country",
            "case when month(o_orderdate) in (11, 12, 1) then 3 else 1 end as payment_attempts",
        )

    @cached_property
    def web_sessions(self) -> DataFrame:
        return self.raw("events").selectExpr(
            "event_id as session_id", "user_id as shop_id", f"concat('10.0.0.', {EVENT_K}) as ip_address",
            "event_type as event_name", "ts as created_at",
        )

    def _disputed_lines(self) -> DataFrame:
        return self.raw("lineitem").filter("l_returnflag = 'R' and l_discount >= 0.1D and l_tax >= 0.07D")

    @cached_property
    def disputes(self) -> DataFrame:
        shops = self.raw("orders").selectExpr("o_orderkey as l_orderkey", "o_custkey as shop_id")
        return self._disputed_lines().join(shops, "l_orderkey").selectExpr(
            "l_orderkey * 10 + l_linenumber as dispute_id", "l_orderkey as order_id", "shop_id",
            f"{money(scaled('l_extendedprice', 400))} as amount",
        )

    # ---- checkout -------------------------------------------------------------------------

    @cached_property
    def order_lines(self) -> DataFrame:
        """Line totals per order: shop, quantity, margins, prices, shipping."""
        totals = (
            "min(l_suppkey) as shop_id", "cast(sum(l_quantity) as int) as total_quantity",
            "cast(count(*) as int) as line_item_count", "max(l_discount + l_tax) as base_cost_margin",
            "cast(max(floor(l_extendedprice)) as bigint) as top_price",
            f"max({scaled('l_extendedprice', 8)}) as top_line_cents", "max(l_shipdate) as last_ship",
            "max(case l_returnflag when 'R' then 1 else 0 end) as has_return",
        )
        return self.raw("lineitem").groupBy(F.col("l_orderkey").alias("order_id")).agg(*map(F.expr, totals))

    def _orders_with_lines(self) -> DataFrame:
        return self.raw("orders").withColumnRenamed("o_orderkey", "order_id").join(
            self.order_lines, "order_id", "left"
        )

    @cached_property
    def dim_order(self) -> DataFrame:
        """Orders with the columns the routing rules read; buyer features are not included."""
        return self._dim_order(400)

    @cached_property
    def dim_order_large(self) -> DataFrame:
        """The same with amounts on the merchant-tier scale."""
        return self._dim_order(8)

    def _dim_order(self, divisor: int) -> DataFrame:
        stores = self.raw("supplier").selectExpr("s_suppkey as shop_id", "cast(s_nationkey as bigint) as merchant_id")
        day = "weekday(o_orderdate)"
        return self._orders_with_lines().join(stores, "shop_id", "left").selectExpr(
            "*", f"{scaled('o_totalprice', divisor)} as g"
        ).selectExpr(
            "order_id",
            "concat('#', order_id) as order_name",
            "shop_id",
            "merchant_id",
            "order_id as checkout_id",
            "o_orderdate as order_created_at",
            f"{IS_TEST} as is_test",
            f"{BUYER_EMAIL.replace('ORDER_KEY', 'order_id')} as buyer_email",
            "case o_orderpriority when '1-URGENT' then 'Stripe' when '2-HIGH' then 'PayPal' else 'Airwallex' end "
            "as payment_gateway",
            f"case o_orderstatus when 'P' then concat(' ', initcap({TRAFFIC})) else {TRAFFIC} end as order_traffic_source",
            f"case when o_orderpriority <> '3-MEDIUM' or o_orderstatus <> 'P' then {money('g')} end as gmv",
            f"case when {day} <> 6 then "
            f"{money('g - cast(floor(g * (103 - dayofmonth(o_orderdate) * 3) / 100) as bigint)')} end as merchant_profit",
            "base_cost_margin",
            "total_quantity",
            "line_item_count",
            "line_item_count as payment_attempt",
            "cast(floor(total_quantity / 2) as int) as gateway_latency_ms",
            "case o_orderpriority when '4-NOT SPECIFIED' then 'n/a' "
            "else cast(cast(floor(top_price / 60) as bigint) as string) end as distance_billing_to_shipment",
            f"case {day} when 0 then 'not match' else 'match' end as shipping_match_ip_country",
            f"case {day} when 1 then 'not match' when 2 then '' else 'match' end as shipping_match_card_country",
            f"case {day} when 3 then 'billing country doesn\\'t match card' when 4 then '' else 'match' end "
            "as billing_match_card_country",
            f"case {day} when 2 then '' else 'match' end as ip_match_card_country",
            "case o_orderstatus when 'F' then 'not match' else 'match' end as billing_shipping_match",
            "case o_orderpriority when '5-LOW' then 0 when '2-HIGH' then 1 end as is_same_store_public_domain",
            f"{money('top_line_cents')} as max_raw_price_lineitem",
            "case o_orderstatus when 'F' then last_ship end as account_tier_updated_at",
            f"{TRAFFIC} as referring_site_label",
            f"{ORDER_STATUS} as order_status",
        )

    @cached_property
    def dim_order_with_features(self) -> DataFrame:
        buyers = self.raw("orders").selectExpr(
            f"{BUYER_EMAIL.replace('ORDER_KEY', 'o_orderkey')} as buyer_email", "o_orderdate as order_created_at", f"{ORDER_STATUS} as order_status"
        )
        counted = buyer_velocity(self.dim_order, counted=buyers)
        return buyer_history(counted, counted=buyers).drop("order_status")

    @cached_property
    def dim_merchant(self) -> DataFrame:
        key, name = F.col("n_nationkey"), F.lower("n_name")
        email = (
            F.when(F.col("n_name") == "NATION_3", F.concat(name, F.lit("@internal-testing.com")))
            .when(F.col("n_name") != "NATION_7", F.concat(name, F.lit("@merchant.example")))
        )
        return self.raw("nation").select(
            key.cast("bigint").alias("id"),
            email.alias("email"),
            F.date_sub(F.lit(EVENTS_AS_OF), key * 3).alias("created_at"),
        )

    @cached_property
    def dim_store(self) -> DataFrame:
        lines = self.raw("lineitem").groupBy(F.col("l_suppkey").alias("shop_id")).agg(
            F.count(F.lit(1)).alias("total_order_count"),
            F.count_if((F.col("l_returnflag") == "R") & (F.col("l_discount") >= 0.09) & (F.col("l_tax") >= 0.03)).alias(
                "total_disputed_orders"
            ),
        )
        return self.raw("supplier").withColumnRenamed("s_suppkey", "shop_id").join(lines, "shop_id", "left").select(
            "shop_id",
            F.col("s_nationkey").cast("bigint").alias("merchant_id"),
            F.concat(F.lit(" "), F.upper("s_name"), F.lit(".Shop")).alias("domain"),
            F.when(F.col("s_acctbal") >= 5000, "enterprise").otherwise("standard").alias("store_segment"),
            "total_order_count",
            "total_disputed_orders",
        )

    def _line_texts(self, condition: Column, text: Column, name: str) -> DataFrame:
        return self.raw("lineitem").filter(condition).select(F.col("l_orderkey").alias("checkout_id"), text.alias(name))

    @cached_property
    def dim_gateway_a_transaction(self) -> DataFrame:
        text = F.when(F.col("l_tax") >= 0.08, "deliver in person").when(F.col("l_tax") >= 0.02, " Collect COD")
        return self._line_texts(F.col("l_returnflag") == "A", text, "response_reason")

    @cached_property
    def dim_gateway_b_transaction(self) -> DataFrame:
        text = F.when(F.col("l_tax") >= 0.08, "NOT RETURNED").when(F.col("l_tax") >= 0.03, " Return Requested").otherwise(
            "unmapped"
        )
        return self._line_texts(F.col("l_returnflag") == "R", text, "response_reason")

    @cached_property
    def map_paypal_checkout(self) -> DataFrame:
        text = F.when(F.col("l_linestatus") == "O", "Open Line ").otherwise("FILLED LINE")
        return self._line_texts(F.col("l_returnflag") == "N", text, "response_message")

    @cached_property
    def dim_stripe_payment_intent(self) -> DataFrame:
        text = F.when(F.col("l_discount") >= 0.1, "Card_Declined").when(F.col("l_discount") >= 0.05, "expired_card").otherwise(
            "incorrect_cvc"
        )
        return self._line_texts(F.col("l_linestatus") == "F", text, "failed_reason")

    def _literal(self, columns: str, rows) -> DataFrame:
        return literal_rows(self.spark, columns, rows)

    @cached_property
    def ref_gateway_a_response_mapping(self) -> DataFrame:
        return self._literal("description string, signal_code string", GATEWAY_A_CODES)

    @cached_property
    def ref_gateway_b_response_mapping(self) -> DataFrame:
        return self._literal("description string, signal_code string", GATEWAY_B_CODES)

    @cached_property
    def ref_paypal_response_mapping(self) -> DataFrame:
        return self._literal("response_message string, signal_code string", PAYPAL_CODES)

    @cached_property
    def ref_stripe_response_mapping(self) -> DataFrame:
        return self._literal("error_message string, signal_code string", STRIPE_CODES)

    # ---- merchant 360 ---------------------------------------------------------------------

    @cached_property
    def funnel_events(self) -> DataFrame:
        """Events on their own calendar, whose last day is EVENTS_AS_OF."""
        return self.raw("events").select(
            F.col("user_id").alias("shop_id"),
            F.col("event_type").alias("event_name"),
            F.col("ts").alias("created_at"),
        )

    @cached_property
    def windowed_metrics(self) -> DataFrame:
        return merchant_daily_metrics(
            self.dim_order_large, self.funnel_events, ORDERS_AS_OF, events_as_of=EVENTS_AS_OF
        )

    @cached_property
    def disposable_domains(self) -> DataFrame:
        return self._literal("domain string", [(d,) for d in DISPOSABLE_DOMAINS])

    @cached_property
    def fact_merchant_daily_metrics(self) -> DataFrame:
        orders = self.dim_order
        totals = orders.groupBy("shop_id").agg(
            F.count(F.lit(1)).alias("total_order_count"),
            F.count_if((F.col("order_status") == "refunded") | (F.col("shop_id") % 9 == 0)).alias("total_refunded_orders"),
        )
        declined = (F.col("event_name") == "error") | ((F.col("shop_id") % 7 == 0) & F.col("event_name").isin("signup", "click"))
        failures = self.funnel_events.groupBy("shop_id").agg(
            (F.count_if(declined).cast("double") / F.count(F.lit(1))).alias("payment_failure_rate_primary_gateway"),
            (F.count_if(F.col("event_name") == "signup").cast("double") / F.count(F.lit(1))).alias(
                "payment_failure_rate_secondary_gateway"
            ),
        )
        place = (
            self.raw("nation").join(
                self.raw("region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey", "left"
            ).select(
                F.col("n_nationkey").cast("bigint").alias("merchant_id"),
                F.col("r_name").alias("merchant_country"),
                F.col("n_name").alias("merchant_city"),
            )
        )
        stores = self.dim_store.select("shop_id", "merchant_id", "total_disputed_orders")
        return (
            stores.join(totals, "shop_id", "left")
            .join(email_quality(orders, self.disposable_domains), "shop_id", "left")
            .join(multi_store_rate(orders).select("shop_id", "multi_store_buyer_rate"), "shop_id", "left")
            .join(ip_footprint(self.web_sessions), "shop_id", "left")
            .join(failures, "shop_id", "left")
            .join(self.windowed_metrics, "shop_id", "left")
            .join(place, "merchant_id", "left")
            .withColumn(
                "dispute_order_ratio",
                F.col("total_refunded_orders").cast("double")
                / F.nullif(F.col("total_order_count").cast("double"), F.lit(0.0)),
            )
        )

    # ---- settlement -----------------------------------------------------------------------

    @cached_property
    def fact_settlement_request(self) -> DataFrame:
        merchants = self.raw("customer").selectExpr(
            "c_custkey as o_custkey", "cast(c_nationkey as bigint) as merchant_id", "lower(c_mktsegment) as store_segment"
        )
        return self.raw("orders").join(merchants, "o_custkey", "left").selectExpr(
            "o_orderkey as settlement_id", "merchant_id", "store_segment",
            f"{money(scaled('o_totalprice', 30))} as requested_amount",
            f"{money(scaled('o_totalprice', 300))} as reserve_hold_amount",
            "o_orderdate as created_at", "o_orderstatus as status",
        )

    @cached_property
    def fact_merchant_payout_setting(self) -> DataFrame:
        own = F.concat(F.col("n_name"), F.lit("@Payout.Example "))
        shared = F.when(F.col("n_name").isin("NATION_5", "NATION_9"), "shared@payout.example")
        return self.raw("nation").select(
            F.col("n_nationkey").cast("bigint").alias("merchant_id"),
            F.explode(F.array(own, shared)).alias("payout_destination_email"),
        )

    @cached_property
    def ref_restricted_account_registry(self) -> DataFrame:
        return self._literal("restricted_email string", [(m,) for m in RESTRICTED_MAILS])

    @cached_property
    def fact_merchant_payout_change(self) -> DataFrame:
        """Change log of payout settings: the own account, for some the shared one later on, for some none in the end."""
        key = F.col("n_nationkey")
        change = lambda no, mail, at, when=F.lit(True): F.when(
            when, F.struct(F.lit(no).alias("no"), mail.alias("mail"), at.cast("timestamp").alias("at"))
        )
        own = F.concat(F.col("n_name"), F.lit("@Payout.Example "))
        steps = F.array(
            change(0, own, F.lit("1990-01-01")),
            change(1, F.lit("shared@payout.example"), F.date_add(F.lit("1994-06-01").cast("date"), key * 45), key % 3 == 2),
            change(2, own, F.date_add(F.lit("1996-01-01").cast("date"), key * 45), key % 6 == 5),
            change(3, F.lit(None).cast("string"), F.date_add(F.lit("1998-01-01").cast("date"), key * 7), key % 4 == 1),
        )
        return self.raw("nation").select(key.cast("bigint").alias("merchant_id"), F.explode(F.array_compact(steps)).alias("s")).select(
            "merchant_id", F.lit(1).alias("setting_id"), F.col("s.no").alias("change_id"),
            F.col("s.mail").alias("payout_destination_email"), F.col("s.at").alias("changed_at"),
        )

    @cached_property
    def ref_restricted_account_change(self) -> DataFrame:
        """Change log of the registry: all listed at first, the shared account off and on again."""
        rows = [(m, k, True, "1993-01-01") for k, m in enumerate(RESTRICTED_MAILS)]
        shared = RESTRICTED_MAILS[-1]
        rows += [(shared, 10, False, "1995-07-01"), (shared.lower(), 11, True, "1996-10-01")]
        raw = self._literal("restricted_email string, change_id int, is_listed boolean, changed_on string", rows)
        return raw.withColumn("changed_at", F.col("changed_on").cast("timestamp")).drop("changed_on")

    @cached_property
    def account_address(self) -> DataFrame:
        """Business addresses of customers, spelled in two ways."""
        parts = [F.floor(F.col("c_acctbal") / 100).cast("string"), F.initcap("c_mktsegment"), F.lit("St"), F.col("c_nationkey").cast("string")]
        return self.raw("customer").select(
            F.col("c_custkey").alias("account_id"),
            F.when(F.col("c_custkey") % 2 == 0, F.concat_ws(" ", *parts)).otherwise(F.upper(F.concat_ws("., ", *parts))).alias("address"),
        )

    @cached_property
    def account_session(self) -> DataFrame:
        """Addresses that accounts were used from: twelve offices, of a hundred subnets each."""
        host = F.col("event_id") % 250
        return self.raw("events").select(
            "event_id", F.col("user_id").alias("account_id"),
            F.concat_ws(".", F.lit("10"), F.col("user_id") % 12, F.expr(EVENT_K), host).alias("ip_address"),
        )

    @cached_property
    def ref_network_prefix(self) -> DataFrame:
        """Known networks: one of 16 bits for each nation, in it four of 24 bits, in one of these one of 28 bits."""
        at = lambda rest: F.concat(F.lit("10."), F.col("n_nationkey"), F.lit(rest))
        nets = [".0.0/16", *(f".{k}.0/24" for k in (0, 25, 50, 75)), ".50.16/28"]
        return self.raw("nation").select(F.explode(F.array(*(at(n) for n in nets))).alias("prefix"))

    @cached_property
    def fact_merchant_account_balance(self) -> DataFrame:
        """Balance: what the merchant's finished orders brought, in the requests' scale."""
        requests = self.fact_settlement_request
        return requests.filter("status = 'F'").groupBy("merchant_id").agg(
            (F.sum("requested_amount") + F.max("requested_amount") * 12).cast("decimal(18,2)").alias("available_balance"),
            F.max("reserve_hold_amount").alias("rolling_reserve_balance"),
        )

    @cached_property
    def fact_merchant_balance_history(self) -> DataFrame:
        """A ledger snapshot at each finished order of a merchant."""
        return self.fact_settlement_request.filter("status = 'F'").selectExpr(
            "merchant_id", "settlement_id as balance_id", "created_at as recorded_at",
            "cast(requested_amount * 40 as decimal(18,2)) as available_balance",
            "reserve_hold_amount as rolling_reserve_balance",
        )

    @cached_property
    def shipments_by_customer(self) -> DataFrame:
        """One row per order with its tracking number and customer."""
        number = "concat('T', floor(o_totalprice / 1000), '-', date_format(o_orderdate, 'yyyyMM'))"
        return self.raw("orders").selectExpr(
            "o_orderkey as order_id", "o_custkey as customer_id",
            f"case when o_orderpriority <> '5-LOW' then {number} end as tracking_number",
            "o_orderdate", "o_orderstatus", "o_totalprice",
        )

    @cached_property
    def fact_order_daily(self) -> DataFrame:
        amount = money(scaled("o_totalprice", 2000))
        return tracking_reuse(self.shipments_by_customer).join(self.order_lines, "order_id", "left").selectExpr(
            "order_id", "shop_id",
            f"{amount} as order_amount",
            "o_orderdate as order_created_at",
            "case when has_return = 1 and line_item_count <= 2 then order_id end as dispute_id",
            f"case o_orderstatus when 'F' then {amount} end as refund_amount",
            "tracking_number", "distinct_customers_same_tracking",
            "case when line_item_count >= 7 then 'Vietnam' when o_orderstatus = 'O' then 'United States' end "
            "as tracking_dest_country",
            "'United States' as shipping_country_name",
        )

    @cached_property
    def fact_order_shipment(self) -> DataFrame:
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("order_id"), F.col("l_shipdate").alias("first_carrier_scan_at")
        )

    @cached_property
    def fact_chargebacks(self) -> DataFrame:
        return self._disputed_lines().selectExpr(
            "l_suppkey as shop_id", "l_orderkey as order_id",
            f"{money(scaled('l_extendedprice', 40))} as dispute_amount_usd",
            "case l_linestatus when 'O' then 'Pending_Arbitration' else 'won' end as status",
        )

    # ---- billing --------------------------------------------------------------------------

    @cached_property
    def billing_merchant(self) -> DataFrame:
        return self.dim_merchant.withColumn("id", F.col("id") + 10000000)

    @cached_property
    def billing_order(self) -> DataFrame:
        """Orders under the billing ids of their customers' merchants."""
        return self.raw("orders").join(self._customer_merchant(), "o_custkey", "left").selectExpr(
            "o_orderkey as order_id", "merchant_id", "o_orderdate as order_created_at", f"{IS_TEST} as is_test"
        )

    def _customer_merchant(self) -> DataFrame:
        return self.raw("customer").selectExpr(
            "c_custkey as o_custkey", "cast(c_nationkey as bigint) + 10000000 as merchant_id", "c_mktsegment"
        )

    @cached_property
    def fact_subscription_invoice(self) -> DataFrame:
        return self.raw("orders").join(self._customer_merchant(), "o_custkey", "left").selectExpr(
            "o_orderkey as invoice_id", "merchant_id", f"{money(scaled('o_totalprice', 255000))} as invoice_amount",
            "o_orderstatus as payment_status", "lower(o_orderpriority) as plan_type", "o_orderdate as created_at",
        )

    @cached_property
    def fact_billing_charge_event(self) -> DataFrame:
        merchants = self._customer_merchant().withColumnRenamed("o_custkey", "user_id")
        events = self.raw("events").selectExpr("*", f"cast({EVENT_K} as int) as k")
        return events.join(merchants, "user_id", "left").selectExpr(
            "event_id as billing_event_id", "merchant_id",
            "case when event_type <> 'signup' then user_id * 100 + k end as payment_instrument_id",
            "event_id as invoice_id", "ts as billing_event_timestamp",
            "case c_mktsegment when 'MACHINERY' then 'Vietnam' when 'BUILDING' then 'Canada' when 'HOUSEHOLD' then null "
            "else 'United States' end as merchant_country",
            f"{money(cents('value'))} as billing_amount",
            "case when k < 30 then 'USA' when k < 45 then 'VNM' when k < 55 then 'GBR' when k < 65 then 'CAN' "
            "when k < 75 then 'BRA' when k < 85 then 'JPN' when k < 93 then 'DEU' end as card_issuing_country_code",
            "case when event_type = 'error' and k >= 80 then 'processor: stolen_card' "
            "when event_type = 'error' and k >= 50 then 'soft: insufficient_funds; card_declined' "
            "when event_type = 'error' then 'expired_card' when event_type = 'view' then 'approved' end "
            "as gateway_error_message",
        )

    # ---- metric dictionary ----------------------------------------------------------------

    @cached_property
    def store_profile(self) -> DataFrame:
        parts = self.raw("part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
        returned = F.col("l_returnflag") == "R"
        keyword = F.lit(False)
        for word in DISPUTE_KEYWORDS:
            keyword = keyword | F.coalesce(F.lower("p_name").contains(word), F.lit(False))
        return self.raw("lineitem").join(parts, "l_partkey", "left").groupBy(
            F.col("l_suppkey").alias("shop_id"), F.col("l_orderkey").alias("order_id")
        ).agg(
            F.count(F.lit(1)).alias("total_order"),
            F.count_if(returned & (F.col("l_discount") >= 0.09)).alias("count_disputed_order_total"),
            F.count_if((F.col("l_linestatus") == "F") & (F.col("l_tax") >= 0.07)).alias("count_failed_gateway_secondary"),
            F.count_if(returned & keyword).alias("dispute_contain_restricted_keywords_count"),
        )

    @cached_property
    def support_tickets(self) -> DataFrame:
        kind = F.col("event_type")
        return self.raw("events").select(
            F.col("event_id").alias("order_id"),
            F.col("user_id").alias("shop_id"),
            F.when(kind == "error", "Please CANCEL ORDER now").when(kind == "signup", "cancel order").otherwise(kind).alias(
                "ticket_type"
            ),
        )

    @cached_property
    def event_product(self) -> DataFrame:
        """Funnel counts of the last 3 days per shop and day."""
        recent = self.raw("events").filter(
            (F.col("ts") >= F.date_sub(F.lit(EVENTS_AS_OF), 4)) & (F.col("ts") < F.lit(EVENTS_AS_OF))
        )
        return recent.groupBy(F.col("user_id").alias("shop_id"), F.col("ts").cast("date").alias("event_day")).agg(
            F.count_if(F.col("event_type") == "purchase").alias("total_session_purchase_l3d"),
            F.count_if(F.col("event_type") == "view").alias("total_session_view_content_l3d"),
        )

    @cached_property
    def user_profile(self) -> DataFrame:
        """Distinct addresses of a user's non-signup events per day, as comma-separated text."""
        address = F.when(F.col("event_type") != "signup", F.concat(F.lit("10.0.0."), F.expr(EVENT_K)))
        return (
            self.raw("events").select("user_id", F.col("ts").cast("date").alias("event_day"), address.alias("ip"))
            .groupBy("user_id", "event_day")
            .agg(F.expr("listagg(distinct ip, ',') within group (order by ip)").alias("ip_location"))
        )
