"""Small hand-made shops, and the definitions of the operators in plain Python."""

from __future__ import annotations

from collections import defaultdict
from datetime import date, datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

from local import frame

DAY = timedelta(days=1)

ORDERS = (
    "order_id bigint, user_id bigint, status string, created_at timestamp_ntz, num_of_item bigint"
)
ITEMS = (
    "id bigint, order_id bigint, user_id bigint, product_id bigint, sale_price double, created_at timestamp_ntz"
)
PRODUCTS = "id bigint, category string"


def at(day: date, hour: int = 0) -> datetime:
    return datetime(day.year, day.month, day.day, hour)


class Shop:
    """Rows of the source tables; orders default to complete, items to their order's day."""

    def __init__(self, products=((1, "a"), (2, "a"), (3, "b"), (4, None))):
        self.orders, self.items, self.products = [], [], list(products)

    def order(self, user, day, status="Complete", items=(), hour=9):
        order_id = len(self.orders) + 1
        self.orders.append((order_id, user, status, at(day, hour), len(items)))
        for item in items:
            product, price, *own = item
            item_day = own[0] if own else day
            self.items.append(
                (len(self.items) + 1, order_id, user, product, price, at(item_day, hour))
            )
        return self

    def frames(self, spark):
        return (
            frame(spark, self.orders, ORDERS),
            frame(spark, self.items, ITEMS),
            frame(spark, self.products, PRODUCTS),
        )


def months_back(day: date, months: int) -> date:
    index = day.year * 12 + day.month - 1 - months
    year, month = divmod(index, 12)
    for last in (day.day, 30, 29, 28):
        try:
            return date(year, month + 1, min(day.day, last))
        except ValueError:
            continue
    raise AssertionError


def views(shop, cfg):
    low = months_back(cfg.as_of, cfg.lookback_months)
    status = {o[0]: o[2] for o in shop.orders}
    orders = [
        (o[1], o[3].date()) for o in shop.orders if o[2] == cfg.complete_status and o[3].date() >= low
    ]
    items = [
        (i[2], i[3], i[4], i[5].date())
        for i in shop.items
        if status.get(i[1]) == cfg.complete_status and i[5].date() >= low
    ]
    return low, orders, items


def cents(price) -> int:
    return 0 if price is None else int((Decimal(str(price)) * 100).to_integral_value(ROUND_HALF_UP))


def features(shop, cfg):
    """Set of feature rows by the definition: a scan of all facts per customer and day."""
    low, orders, items = views(shop, cfg)
    category = dict(shop.products)
    rows = set()
    for user in {o[0] for o in orders if o[0] is not None}:
        days = [d for u, d in orders if u == user]
        bought = [i for i in items if i[0] == user]
        scale_orders = max(len(bought), 1) if cfg.fanout == "reference" else 1
        scale_money = len(days) if cfg.fanout == "reference" else 1
        day = low
        while day <= cfg.as_of:
            past = [d for d in days if d <= day]
            if past:

                def window(n, when):
                    return day - n * DAY < when <= day

                short, long = cfg.short_days, cfg.long_days
                n_s = sum(window(short, d) for d in days) * scale_orders
                n_l = sum(window(long, d) for d in days) * scale_orders
                c_s = sum(cents(i[2]) for i in bought if window(short, i[3])) * scale_money
                c_l = sum(cents(i[2]) for i in bought if window(long, i[3])) * scale_money
                held = {i[1] for i in bought if window(long, i[3]) and i[1] is not None}
                kinds = {category.get(p) for p in held} - {None}
                average = None
                if n_l:
                    average = float(
                        (Decimal(c_l) / Decimal(n_l)).to_integral_value(ROUND_HALF_UP)
                    ) / 100
                rows.add(
                    (user, at(day), n_s, n_l, c_s / 100, c_l / 100, average, len(held), len(kinds),
                     (day - max(past)).days)
                )
            day += cfg.step_days * DAY
    return rows


def labels(shop, cfg):
    _, orders, _ = views(shop, cfg)
    rows = set()
    if not orders:
        return rows
    last = max(d for _, d in orders) - cfg.churn_days * DAY
    by_user = defaultdict(list)
    for user, day in orders:
        if user is not None:
            by_user[user].append(day)
    for user, days in by_user.items():
        day = min(days)
        while day <= last:
            soon = any(day < d <= day + cfg.churn_days * DAY for d in days)
            rows.add((user, at(day), 0 if soon else 1))
            day += DAY
    return rows


def training(label_rows, feature_rows):
    history = defaultdict(list)
    for row in feature_rows:
        history[row[0]].append(row)
    rows = set()
    for user, when, label in label_rows:
        earlier = [r for r in history[user] if r[1] <= when]
        if earlier:
            f = max(earlier, key=lambda r: r[1])
            if f[3] > 0:
                rows.add((user, when, f[1], *f[2:6], f[6] or 0.0, *f[7:], label))
    return rows


def rows_of(df) -> set:
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows)), "duplicate rows"
    return set(rows)
