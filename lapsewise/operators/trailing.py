"""Trailing-window features from change points.

A customer's windowed counts and sums only change on a few days: on an order
day, and when that day leaves a window.  So each fact is turned into signed
changes (``+x`` on its day, ``-x`` when it expires), the changes are summed per
customer and day, and a running sum gives the values between two change days.
Only the last step expands to one row per day.

Why this holds for hot customers: raw rows are reduced by map-side aggregation
before every shuffle, and each window runs over rows already unique per key and
day, so no group outgrows the calendar.  Distinct counts need no sets: a product
enters with a purchase that finds it expired or new, and leaves one window after
a purchase that no other follows within it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapsewise.config import BuildConfig
from lapsewise.functions import from_cents, midnight, round_half_up, to_cents

# Facts of a customer's day: orders, items, revenue, and how many products and
# categories enter that day, or leave one long window after it.
FACTS = (
    "n_orders",
    "n_items",
    "cents",
    "products_in",
    "products_out",
    "categories_in",
    "categories_out",
)
# Running values: windowed orders and revenue (short and long), distinct counts.
RUNNING = ("orders_s", "orders_l", "cents_s", "cents_l", "products", "categories")
# Totals over the whole lookback that the fan-out needs.
_TOTALS = ("n_orders", "n_items")

_KNOWN = "customer_id IS NOT NULL AND order_date IS NOT NULL"


def order_facts(orders: DataFrame) -> DataFrame:
    """One row per order; ``orders(customer_id, order_date)``."""
    return orders.where(_KNOWN).selectExpr(
        "customer_id",
        "order_date AS day",
        "1L AS n_orders",
        *(f"0L AS {c}" for c in FACTS[1:]),
    )


def item_facts(items: DataFrame, products: DataFrame, cfg: BuildConfig) -> DataFrame:
    """Revenue, and changes of the distinct counts over the long window.

    ``items(customer_id, product_id, sale_price, order_date)``,
    ``products(id, category)`` with unique ids.
    """
    # One row per customer, product and day: the map-side combine keeps a hot
    # customer or product from reaching one task as raw rows.
    bought = (
        items.where(_KNOWN)
        .groupBy("customer_id", "product_id", F.col("order_date").alias("day"))
        .agg(
            F.coalesce(F.sum(to_cents(F.col("sale_price"))), F.lit(0)).alias("cents"),
            F.count(F.lit(1)).alias("n_items"),
        )
    )
    held = entering_and_leaving(bought, "products", "product_id", cfg)
    categories = products.select(F.col("id").alias("product_id"), "category")
    by_category = (
        held.join(categories, "product_id", "left")
        .groupBy("customer_id", "category", "day")
        .agg(*(F.sum(c).alias(c) for c in ("cents", "n_items", "products_in", "products_out")))
    )
    held = entering_and_leaving(by_category, "categories", "category", cfg)
    return held.selectExpr("customer_id", "day", "0L AS n_orders", *FACTS[1:])


def entering_and_leaving(df: DataFrame, name: str, key: str, cfg: BuildConfig) -> DataFrame:
    """Adds ``<name>_in`` and ``<name>_out`` (0 or 1); ``df`` is unique by customer, key and day."""
    w = Window.partitionBy("customer_id", key).orderBy("day")
    window = cfg.long_days
    return (
        df.withColumns({"before": F.lag("day").over(w), "again": F.lead("day").over(w)})
        .withColumns(
            {
                f"{name}_in": F.expr(
                    f"bigint({key} IS NOT NULL AND (before IS NULL OR date_add(before, {window}) <= day))"
                ),
                f"{name}_out": F.expr(
                    f"bigint({key} IS NOT NULL AND (again IS NULL OR again >= date_add(day, {window})))"
                ),
            }
        )
        .drop("before", "again")
    )


def _expiring(cfg: BuildConfig) -> str:
    """SQL that turns a day's facts into changes: in on the day, out of each window later."""

    def row(day: str, **values: str) -> str:
        order_day = values.pop("order_day", "DATE(NULL)")
        amounts = (f"{values.get(c, '0L')} AS {c}" for c in (*RUNNING, *_TOTALS))
        return f"struct({day} AS day, {order_day} AS order_day, {', '.join(amounts)})"

    on_day = row(
        "day",
        order_day="order_day",
        orders_s="n_orders",
        orders_l="n_orders",
        cents_s="cents",
        cents_l="cents",
        products="products_in",
        categories="categories_in",
        **{c: c for c in _TOTALS},
    )
    out_s = row(f"date_add(day, {cfg.short_days})", orders_s="-n_orders", cents_s="-cents")
    out_l = row(
        f"date_add(day, {cfg.long_days})",
        orders_l="-n_orders",
        cents_l="-cents",
        products="-products_out",
        categories="-categories_out",
    )
    return f"inline(array({on_day}, {out_s}, {out_l}))"


def daily_changes(facts: DataFrame, cfg: BuildConfig, in_reach: str = "true") -> DataFrame:
    """Signed changes of the running values, one row per customer and day.

    ``in_reach`` is a condition on the day, and in fan-out mode on the totals.
    """
    totals = _TOTALS if cfg.fanout == "reference" else ()
    daily = (
        facts.where(in_reach)
        .groupBy("customer_id", "day")
        .agg(
            *(F.sum(c).alias(c) for c in FACTS),
            F.max(F.when(F.col("n_orders") > 0, F.col("day"))).alias("order_day"),
        )
    )
    # At most three rows per customer and day from here on, so the customer alone
    # can be the partition; the sums per day and the windows below share it.
    return (
        daily.selectExpr("customer_id", _expiring(cfg))
        .where(in_reach)
        .repartition("customer_id")
        .groupBy("customer_id", "day")
        .agg(
            *(F.sum(c).alias(c) for c in RUNNING),
            *(F.sum(c).alias(c) for c in totals),
            F.max("order_day").alias("order_day"),
        )
    )


def snapshots_between(changes: DataFrame, cfg: BuildConfig, start: str, end: str) -> DataFrame:
    """Feature rows per customer and snapshot day, from the first order day on.

    ``start`` and ``end`` are SQL dates; the snapshots lie every ``step_days`` from the start on.
    """
    totals = _TOTALS if cfg.fanout == "reference" else ()
    whole = "OVER (PARTITION BY customer_id)"
    ordered = "PARTITION BY customer_id ORDER BY day"
    so_far = f"OVER ({ordered} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    state = changes.selectExpr(
        "customer_id",
        "day",
        f"lead(day) OVER ({ordered}) AS next_day",
        f"max(order_day) {so_far} AS last_order",
        *(f"sum({c}) {so_far} AS {c}" for c in RUNNING),
        *(f"sum({c}) {whole} AS {c}" for c in totals),
    ).where("last_order IS NOT NULL")

    # Each state holds until the day before the next change; its first snapshot
    # is the first multiple of the step from the start on.
    low = f"greatest(day, {start})"
    if cfg.step_days > 1:
        low = f"date_add({low}, pmod(-datediff({low}, {start}), {cfg.step_days}))"
    spans = (
        state.withColumn("low", F.expr(low))
        .withColumn("high", F.expr(f"least(date_sub(next_day, 1), {end})"))
        .where("low <= high")
    )
    rows = spans.selectExpr(
        "*", f"explode_outer(sequence(0, datediff(high, low) div {cfg.step_days})) AS i"
    ).withColumn("snapshot", F.expr(f"date_add(low, int(i * {cfg.step_days}))"))
    return rows.select(*_feature_columns(cfg))


def daily_snapshots(facts: DataFrame, cfg: BuildConfig) -> DataFrame:
    """Feature rows per customer and snapshot day of the lookback, from the first order day on."""
    end = f"DATE '{cfg.as_of}'"
    start = f"add_months({end}, {-cfg.lookback_months})"
    # Facts after the last snapshot matter to the fan-out totals only.
    in_reach = f"day <= {end}" + (" OR n_orders > 0 OR n_items > 0" if cfg.fanout == "reference" else "")
    return snapshots_between(daily_changes(facts, cfg, in_reach), cfg, start, end)


def _feature_columns(cfg: BuildConfig):
    orders_s, orders_l = F.col("orders_s"), F.col("orders_l")
    cents_s, cents_l = F.col("cents_s"), F.col("cents_l")
    if cfg.fanout == "reference":
        # Every order pairs with every item of the customer; without items the
        # outer join still leaves one row per order.  Products of two totals can
        # outgrow a bigint, hence the wide decimal for money.
        per_order = F.greatest(F.col("n_items"), F.lit(1))
        orders_s, orders_l = orders_s * per_order, orders_l * per_order
        wide = F.col("n_orders").cast("decimal(19,0)")
        cents_s = cents_s.cast("decimal(19,0)") * wide
        cents_l = cents_l.cast("decimal(19,0)") * wide
    values = [
        orders_s,
        orders_l,
        from_cents(cents_s),
        from_cents(cents_l),
        from_cents(round_half_up(cents_l, orders_l)),
        F.col("products"),
        F.col("categories"),
        F.coalesce(F.datediff("snapshot", "last_order").cast("bigint"), F.lit(999)),
    ]
    return [
        F.col("customer_id"),
        midnight(F.col("snapshot")).alias("feature_timestamp"),
        *(v.alias(name) for v, name in zip(values, cfg.feature_columns)),
    ]
