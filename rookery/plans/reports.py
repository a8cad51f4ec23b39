"""The operators applied straight to the star-schema and text tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rookery.functions import text
from rookery.operators import tables
from rookery.operators.carry import carry_forward
from rookery.operators.checks import Check, duplicate_excess, measure
from rookery.operators.extremes import value_at_first, value_at_last
from rookery.operators.labels import most_frequent_label
from rookery.operators.latest import latest_per_key
from rookery.operators.regrain import stack_rows
from rookery.operators.trend import week_of, whole_weeks, with_previous
from rookery.plans.events import explode_moves
from rookery.session import scratch_path
from rookery.sources import landing


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def rows() -> Column:
    return F.count(F.lit(1))


def latest_line_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest line item of every order line, ties broken by all measures."""
    lines = _table(spark, sf_dir, "lineitem")
    order = [F.desc("l_shipdate"), F.asc("l_partkey"), F.asc("l_suppkey"),
             F.asc("l_extendedprice"), F.asc("l_quantity"), F.asc("l_discount"), F.asc("l_tax")]
    return latest_per_key(lines, ["l_orderkey", "l_linenumber"], order)


def daily_user_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user, day and event type: counts, first and last value, distinct keys."""
    order = (F.col("ts"), F.col("event_id"))
    return (
        _events(spark, sf_dir)
        .withColumn("k", text.json_field(F.col("props"), "$.k").cast("bigint"))
        .groupBy(F.to_date("ts").alias("day"), "user_id", "event_type")
        .agg(
            rows().alias("events"),
            F.count_if(F.col("value") > 10).alias("large"),
            text.share(F.col("value") > 10).alias("large_rate"),
            value_at_first(F.col("value"), *order).alias("value_first"),
            value_at_last(F.col("value"), *order).alias("value_last"),
            F.count_distinct("k").alias("distinct_keys"),
        )
        .withColumn("value_delta", F.round(F.col("value_last") - F.col("value_first"), 6))
    )


def weekly_user_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly closing value per user and type, against the previous active week."""
    order = (F.col("ts"), F.col("event_id"))
    weekly = (
        _events(spark, sf_dir)
        .withColumn("day", F.to_date("ts"))
        .withColumn("week", week_of("day"))
        .groupBy("week", "user_id", "event_type")
        .agg(
            rows().alias("events"),
            F.min("value").alias("min_value"),
            F.max("value").alias("max_value"),
            value_at_first(F.col("value"), *order).alias("opening"),
            value_at_last(F.col("value"), *order).alias("closing"),
        )
    )
    lagged = with_previous(
        weekly,
        ["user_id", "event_type"],
        "week",
        {"previous_closing": "closing", "previous_week": "week"},
    )
    return lagged.select(
        "week", "user_id", "event_type", "events", "min_value", "max_value", "opening", "closing",
        "previous_closing",
        F.round(F.col("closing") - F.col("previous_closing"), 6).alias("change"),
        whole_weeks("week", "previous_week").alias("weeks_since_previous"),
    )


def return_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Return shares per part and line status, labelled by brand.

    Lines are aggregated first; the join meets one row per part and status.
    """
    counted = (
        _table(spark, sf_dir, "lineitem")
        .groupBy("l_partkey", "l_linestatus")
        .agg(
            rows().alias("lines"),
            F.count_if(F.col("l_returnflag") == "R").alias("returned"),
            F.count_if(F.col("l_returnflag") == "A").alias("accepted"),
            text.share(F.col("l_returnflag") == "N").alias("open_rate"),
        )
    )
    parts = _table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("brand")
    )
    return counted.join(parts, "l_partkey", "left").select(
        "l_partkey",
        "l_linestatus",
        F.coalesce("brand", F.lit("Unknown")).alias("brand"),
        "lines",
        "returned",
        text.rate(F.col("returned"), F.col("lines")).alias("return_rate"),
        text.rate(F.col("returned") + 0.5 * F.col("accepted"), F.col("lines")).alias(
            "weighted_rate"
        ),
        "open_rate",
        (F.col("lines") >= 30).alias("is_significant"),
    )


def value_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median and 90th percentile of the value per event type."""
    return (
        _events(spark, sf_dir)
        .groupBy("event_type")
        .agg(
            rows().alias("events"),
            F.percentile_approx("value", 0.5).alias("median_value"),
            F.percentile_approx("value", 0.9).alias("p90_value"),
            F.avg(F.when(F.col("value") > 10, F.dayofmonth("ts"))).alias("mean_day_large"),
        )
    )


def nation_cohorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers per nation by their ordering behaviour: two levels of aggregates."""
    per_customer = (
        _table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(
            rows().alias("orders"),
            F.min("o_orderdate").alias("first_order"),
            F.max("o_orderdate").alias("last_order"),
        )
    )
    customers = _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_nationkey"
    )
    return (
        per_customer.join(customers, "o_custkey")
        .groupBy("c_nationkey")
        .agg(
            rows().alias("customers"),
            F.sum("orders").alias("total_orders"),
            F.avg("orders").alias("avg_orders"),
            F.percentile_approx("orders", 0.5).alias("median_orders"),
            F.avg(F.datediff("last_order", "first_order")).alias("avg_span_days"),
            text.share(F.col("last_order") >= F.lit(dt.datetime(2001, 7, 1))).alias("active_rate"),
        )
    )


def line_parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items re-grained to one row per party, then summed per party."""
    lines = _table(spark, sf_dir, "lineitem")
    parties = stack_rows(
        lines,
        ["l_quantity"],
        [
            {"role": F.lit("part"), "party": F.col("l_partkey")},
            {"role": F.lit("supplier"), "party": F.col("l_suppkey")},
        ],
    )
    return parties.groupBy("role", "party").agg(
        rows().alias("lines"), F.sum("l_quantity").alias("quantity")
    )


def brand_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The commonest part type of every brand."""
    return most_frequent_label(_table(spark, sf_dir, "part"), "p_brand", "p_type")


def line_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data-quality checks over the line items."""
    lines = _table(spark, sf_dir, "lineitem").withColumn(
        "line", F.struct("l_orderkey", "l_linenumber")
    )
    failed, col = F.count_if, F.col
    checks = [
        Check("key_not_null", "error", failed(col("l_orderkey").isNull()), 0.0, "key set"),
        Check("key_unique", "error", col("duplicate_rows"), 0.0, "key unique", from_side=True),
        Check("quantity_in_range", "error", failed(~col("l_quantity").between(2, 49)), 5.0,
              "quantity between 2 and 49"),
        Check("flag_known", "error", failed(~col("l_returnflag").isin("A", "N", "R")), 0.0,
              "flag known"),
        Check("discounted", "warn", failed(col("l_discount") <= 0), 1.0, "discount given"),
        Check("taxed_or_open", "warn",
              failed((col("l_tax") == 0) & (col("l_linestatus") != "O")), 3.0, "tax or open"),
        Check("rows_present", "error", F.when(rows() == 0, 1).otherwise(0), 0.0, "rows exist",
              at_least_one=True),
    ]
    return measure(lines, checks, side=duplicate_excess(lines, "line"))


def page_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URL parts of every page."""
    url = F.regexp_replace("url", r"[?#].*\z", "")
    return _table(spark, sf_dir, "pages").select(
        "page_id",
        text.first_group(F.col("url"), r"^\w+://([^/?#]+)").alias("host"),
        text.last_segment(url).alias("slug"),
        text.to_long(text.first_group(url, r"/(\d+)/?\z")).alias("number"),
        F.replace(text.last_segment(url), F.lit("-"), F.lit(" ")).alias("title"),
        F.startswith("url", F.lit("https://")).alias("is_secure"),
    )


def text_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Largest dotted number of every document, bracketed remarks left out."""
    plain = F.regexp_replace("text", r"\{[^}]*\}", " ")
    return _table(spark, sf_dir, "documents").select(
        "doc_id",
        text.greatest_number(plain, r"(\d++)\.").alias("greatest"),
        F.size(text.all_groups(plain, r"(\d+)")).cast("bigint").alias("numbers"),
    )


def event_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON field ``k`` and the JSON keys of every event."""
    return _table(spark, sf_dir, "events").select(
        "event_id",
        text.json_field(F.col("props"), "$.k").cast("bigint").alias("k"),
        F.array_join(F.json_object_keys("props"), ",").alias("keys"),
    )


def user_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity sessions per user with a six-hour gap."""
    order = F.struct("ts", "event_id")
    return (
        _events(spark, sf_dir)
        .groupBy(F.session_window("ts", "6 hours").alias("window"), "user_id")
        .agg(
            rows().alias("events"),
            F.count_if(F.col("event_type") == "purchase").alias("purchases"),
            F.min_by("event_type", order).alias("first_type"),
            F.max("value").alias("max_value"),
        )
        .select(
            F.col("window.start").alias("session_start"),
            F.col("window.end").alias("session_end"),
            "user_id", "events", "purchases", "first_type", "max_value",
        )
    )


def hourly_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per hour and type."""
    return (
        _events(spark, sf_dir)
        .groupBy(F.window("ts", "1 hour").alias("window"), "event_type")
        .agg(rows().alias("events"), F.min("value").alias("min_value"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "event_type", "events", "min_value",
            F.bround(F.col("events") / 60, 3).alias("events_per_minute"),
        )
    )


def last_known_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per event: the user's last purchase and last click value so far."""
    events = _events(spark, sf_dir).select("event_id", "ts", "user_id", "event_type", "value")
    observed = {
        f"last_{kind}": F.when(F.col("event_type") == kind, F.col("value"))
        for kind in ("purchase", "click")
    }
    return carry_forward(events, ["user_id"], ["ts", "event_id"], observed, F.to_date("ts"))


def document_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents cut into numbered, coloured tokens, summed per side."""
    documents = _table(spark, sf_dir, "documents")
    return (
        explode_moves(documents, ["doc_id"], F.col("text"))
        .groupBy("doc_id", "color")
        .agg(
            rows().alias("tokens"),
            F.max("ply").cast("bigint").alias("last_ply"),
            F.max("move_number").cast("bigint").alias("last_move"),
            F.sum(F.length("san")).alias("letters"),
        )
    )


def role_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List documents flattened to a row per entry: words by speaker role."""
    turns = _table(spark, sf_dir, "conversations").select(
        F.col("role").alias("title"), F.split("text", " ").alias("players")
    )
    return (
        landing.flatten_titles(turns)
        .groupBy("title", "username")
        .agg(rows().alias("entries"))
    )


def monthly_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month documents flattened to a row per record; empty months vanish."""
    lists = F.expr(
        """CASE WHEN o_orderstatus = 'P' THEN NULL
                WHEN o_orderpriority = '5-LOW' THEN slice(array(named_struct(
                  'order_key', o_orderkey, 'price', o_totalprice)), 1, 0)
                ELSE array(named_struct('order_key', o_orderkey, 'price', o_totalprice),
                           named_struct('order_key', -o_orderkey, 'price', -o_totalprice)) END"""
    )
    archives = _table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("player"),
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        lists.alias("games"),
    )
    return landing.flatten_months(archives)


def recent_order_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three newest archive months of every customer."""
    index = (
        _table(spark, sf_dir, "orders")
        .select(
            F.concat(F.lit("Player"), "o_custkey").alias("player"),
            F.concat(
                F.lit("https://games.example.org/player/"),
                "o_custkey",
                F.date_format("o_orderdate", "'/games/'yyyy'/'MM"),
            ).alias("url"),
        )
        .distinct()
    )
    return landing.recent_months(index, 3)


_PRICES = ["order_key", "month", "status", "price"]


def _priced(orders: DataFrame, factor: float) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("order_key"),
        F.date_trunc("month", "o_orderdate").cast("date").alias("month"),
        F.col("o_orderstatus").alias("status"),
        (F.col("o_totalprice") * factor).alias("price"),
    ).select(*_PRICES)


def upserted_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of closed orders after an upsert of all orders of two years."""
    orders = _table(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders")
    closed = _priced(orders.filter(F.col("o_orderstatus").isin("F", "P")), 1.0)
    tables.rebuild(closed, path, "month", ["order_key"])
    start, end = dt.date(1997, 1, 1), dt.date(1998, 12, 31)
    batch = _priced(orders, 2.0).filter(F.col("month").between(F.lit(start), F.lit(end)))
    tables.upsert_window(batch, path, "order_key", "month", start, end, ["order_key"])
    return tables.read_table(spark, path, closed.schema)


def replaced_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly totals after a window was replaced; months without rows are gone."""
    orders = _table(spark, sf_dir, "orders")
    path = scratch_path(spark, "months")

    def totals(source: DataFrame) -> DataFrame:
        return _priced(source, 1.0).groupBy("month", "status").agg(
            rows().alias("orders"), F.max("price").alias("max_price")
        )

    everything = totals(orders)
    tables.rebuild(everything, path, "month")
    start, end = dt.date(1996, 1, 1), dt.date(1999, 12, 31)
    in_window = (F.col("o_orderdate") >= F.lit(start)) & (
        F.col("o_orderdate") < F.lit(end + dt.timedelta(days=1))
    )
    open_summers = orders.filter(
        in_window & F.month("o_orderdate").between(4, 9) & (F.col("o_orderstatus") == "O")
    )
    tables.replace_window(totals(open_summers), path, "month", start, end, ["status"])
    return tables.read_table(spark, path, everything.schema)
