"""The refreshed mart equals a rebuilt one, and months out of reach keep their files."""

from dataclasses import replace
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderflow.plans.catalog import before_the_news
from orderflow.plans.mart import build_layers, order_features
from orderflow.plans.refresh import affected_months, affected_orders, changed_keys, changes_between, refresh_layers, refreshed
from orderflow.sources.roles import Roles, load_roles

ORDER = "order_id long, customer_id long, order_priority string, purchase_ts timestamp, delivered_at timestamp, estimated_at timestamp"
ITEM = "order_id long, seller_id long, product_id long, price long"


def world(seed=0, n=60, sellers=6):
    """Rows of a small shop over ten months; a third of the items is of one seller."""
    rng = np.random.default_rng(seed)
    orders, items = [], []
    for i in range(n):
        bought = datetime(2024, 1, 1) + timedelta(hours=int(rng.integers(0, 300 * 24)))
        got = bought + timedelta(days=int(rng.integers(1, 40))) if rng.random() < 0.8 else None
        orders.append([i, int(rng.integers(0, 8)), "p", bought, got, bought + timedelta(days=20)])
        for _ in range(int(rng.integers(0, 4))):
            seller = 0 if rng.random() < 0.33 else int(rng.integers(0, sellers))
            items.append([i, seller, int(rng.integers(0, 9)), int(rng.integers(1, 1000))])
    return {
        "orders": orders,
        "items": items,
        "products": [[p, f"b{p % 3}", p, 100 * p] for p in range(8)],
        "sellers": [[s, s % 3] for s in range(sellers)],
        "customers": [[c, c % 3, "s", 10 * c] for c in range(7)],
    }


def typed(spark, rows):
    frame = spark.createDataFrame
    return Roles(
        orders=frame(rows["orders"], ORDER),
        items=frame(rows["items"], ITEM).withColumns({c: F.lit(100).cast("long") for c in ("quantity", "discount", "tax")}),
        products=frame(rows["products"], "product_id long, brand string, size int, retail_price long"),
        sellers=frame(rows["sellers"], "seller_id long, seller_nation int"),
        customers=frame(rows["customers"], "customer_id long, customer_nation int, customer_segment string, customer_acctbal long"),
    )


def deliver(rows, which=min):
    """The earliest open order arrives, or the latest."""
    order = which((o for o in rows["orders"] if o[4] is None), key=lambda o: o[3])
    order[4] = order[3] + timedelta(days=3)


def withdraw(rows):
    gone = rows["orders"][7][0]
    rows["orders"] = [o for o in rows["orders"] if o[0] != gone]
    rows["items"] = [i for i in rows["items"] if i[0] != gone]


def move(rows):
    """An order turns out to be of another month, another of another seller."""
    rows["orders"][3][3] += timedelta(days=45)
    rows["items"][5][1] = 5


def reprice(rows):
    rows["products"][2][3] += 50
    rows["sellers"][4][1] += 1
    rows["customers"][1][2] = "t"


def grow(rows):
    bought = datetime(2024, 11, 20)
    rows["orders"].append([900, 99, "q", bought, None, bought + timedelta(days=20)])
    rows["items"] += [[900, 0, 3, 10], [900, 0, 3, 10], [900, 77, 999, 5]]


def empty_month(rows):
    """The last month loses all its orders."""
    last = max(o[3] for o in rows["orders"]).replace(day=1, hour=0)
    rows["orders"] = [o for o in rows["orders"] if o[3] < last]


@pytest.mark.parametrize("change", [deliver, withdraw, move, reprice, grow, empty_month])
def test_refresh_equals_a_rebuild(spark, tmp_path, change):
    before, after = world(), world()
    change(after)
    old, new = typed(spark, before), typed(spark, after)
    build_layers(old, str(tmp_path))
    months = refresh_layers(old, new, str(tmp_path))
    expected = order_features(new)
    got = refreshed(new, str(tmp_path)).select(*expected.columns)
    assert months and sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
    # Rows that differ from those before lie in months that were written.
    was = {r["order_id"]: r for r in order_features(old).collect()}
    now = {r["order_id"]: r for r in expected.collect()}
    differ = {r["month"] for k in was.keys() | now.keys() if was.get(k) != now.get(k) for r in (was.get(k), now.get(k)) if r}
    assert differ <= set(months)


def files(root):
    return {p: p.stat().st_mtime_ns for p in root.glob("marts/order_features/month=*/*.parquet")}


def test_other_months_keep_their_files_and_a_repeat_gives_the_same(spark, tmp_path):
    before, after = world(), world()
    deliver(after, max)
    old, new = typed(spark, before), typed(spark, after)
    build_layers(old, str(tmp_path))
    had = files(tmp_path)
    months = refresh_layers(old, new, str(tmp_path))
    kept = {p for p in had if date.fromisoformat(p.parent.name.split("=")[1]) not in months}
    assert kept and all(files(tmp_path)[p] == had[p] for p in kept)
    once = sorted(map(str, refreshed(new, str(tmp_path)).collect()))
    assert refresh_layers(old, new, str(tmp_path)) == months  # as after a run that broke off
    assert sorted(map(str, refreshed(new, str(tmp_path)).collect())) == once
    had = files(tmp_path)
    assert refresh_layers(new, new, str(tmp_path)) == [] and files(tmp_path) == had


def test_a_delivery_reaches_later_orders_of_its_sellers_only(spark):
    day = lambda n: datetime(2024, n, 1)
    rows = {
        "orders": [[1, 1, "a", day(1), None, day(3)], [2, 1, "a", day(2), None, day(9)], [3, 1, "a", day(4), None, day(9)], [4, 1, "a", day(5), None, day(9)]],
        "items": [[1, 10, 1, 5], [2, 10, 1, 5], [3, 10, 1, 5], [4, 11, 1, 5]],
        "products": [[1, "x", 1, 1]], "sellers": [[10, 1], [11, 1]], "customers": [[1, 1, "s", 1]],
    }
    old = typed(spark, rows)
    rows["orders"][0][4] = day(2)
    new = typed(spark, rows)
    affected = affected_orders(old, new, changes_between(old, new))
    # Order 2 was bought at the very time of the delivery, order 4 of another seller.
    assert sorted(tuple(r) for r in affected.collect()) == [(1, "order"), (3, "history")]
    months = affected_months(old, new, affected.select("order_id").distinct()).collect()
    assert sorted((r["month"].month, r["n_orders"]) for r in months) == [(1, 1), (4, 1)]


def test_changed_keys_count_copies_and_nulls(spark):
    old = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c"), (None, "d")], "k long, v string")
    new = spark.createDataFrame([(1, "a"), (2, None), (3, "x"), (4, "e")], "k long, v string")
    assert sorted(r["k"] for r in changed_keys(old, new, "k").collect()) == [1, 3, 4]
    assert changed_keys(old, old, "k").count() == 0
    assert changed_keys(old.limit(0), old.limit(0), "k").count() == 0


def test_an_order_without_purchase_time_is_refused(spark, tmp_path):
    rows = world()
    old = typed(spark, rows)
    rows["orders"][0][3] = None
    with pytest.raises(ValueError, match="no month"):
        refresh_layers(old, typed(spark, rows), str(tmp_path))


def test_no_side_is_sorted_or_crossed_whole(spark, sf_dir):
    new = load_roles(spark, sf_dir)
    old = before_the_news(new)
    plan = affected_orders(old, new, changes_between(old, new))._jdf.queryExecution().optimizedPlan().toString()
    assert "Cartesian" not in plan and "Window" not in plan and "Cross" not in plan
    same = replace(new, orders=new.orders)
    assert changed_keys(new.products, same.products, "product_id").count() == 0


def test_a_refresh_leaves_neither_its_parts_nor_the_shuffles_of_its_collected_steps(spark, sf_dir, tmp_path, monkeypatch):
    import orderflow.plans.refresh as module

    before, after = world(), world()
    deliver(after, max)
    old, new = typed(spark, before), typed(spark, after)
    build_layers(old, str(tmp_path))
    made, dropped, drop = [], [], module.drop_folder
    given = module.run_dir
    monkeypatch.setattr(module, "run_dir", lambda s, label: made.append(given(s, label)) or made[-1])
    monkeypatch.setattr(module, "drop_folder", lambda s, path: dropped.append(path) or drop(s, path))
    assert refresh_layers(old, new, str(tmp_path))
    names = {path.rsplit("/", 1)[1].rsplit("-", 1)[0] for path in made}
    assert {"refresh-orders", "refresh-item_totals", "refresh-seller_record", "refresh-seller_totals"} <= names
    assert sorted(dropped) == sorted(made)

    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        every = files.getAllFiles()
        return sum("shuffle_" in every.apply(i).getName() for i in range(every.size()))

    held = shuffles()
    before_the_news(load_roles(spark, sf_dir))
    assert shuffles() <= held
