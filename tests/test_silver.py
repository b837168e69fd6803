import datetime

import pytest

from tests import frames as fr
from tests.frames import item, make, order, ts
from tradeloom.operators.history import apply_changes
from tradeloom.plans import silver


def review(review_id, order_id, created, answered, score=5):
    return (review_id, order_id, score, None, None, ts(created), ts(answered))


def test_review_ties_and_missing_times(spark):
    day = "2018-01-01 00:00:00"
    df = make(
        spark, fr.REVIEWS,
        review("1", "tie", day, day), review("2", "tie", day, day),
        review("3", "null", day, None), review("4", "null", day, day),
        review("5", "created", day, day), review("6", "created", "2018-01-02 00:00:00", day),
        review("7", "onlynull", None, None),
        review(None, "noid", day, day), review("8", None, day, day),
    )
    got = {r.order_id: r.review_id for r in silver.reviews_latest(df).collect()}
    assert got == {"tie": "2", "null": "4", "created": "6", "onlynull": "7"}


def test_payments_dominant_part(spark):
    df = make(
        spark, fr.PAYMENTS,
        ("tie", 2, "voucher", 1, 5.0), ("tie", 1, "card", 3, 5.0),
        ("null", 1, "voucher", 1, None), ("null", 2, "card", 8, 5.0),
        ("allnull", 2, "voucher", 1, None), ("allnull", 1, "boleto", 2, None),
        ("one", 1, "card", None, 0.1), ("one", 2, "voucher", 1, 0.05),
        (None, 1, "card", 1, 9.0),
    )
    got = {r.order_id: tuple(r)[1:] for r in silver.payments_by_order(df).collect()}
    assert got == {
        "tie": (10.0, 2, "card", 3),
        "null": (5.0, 2, "card", 8),
        "allnull": (None, 2, "boleto", 2),
        "one": (0.15, 2, "card", None),
    }


def test_dim_customers_first_order_and_default(spark):
    customers = make(spark, fr.CUSTOMERS, ("c1", "u1", "01", " sao paulo ", " sp"),
                     ("c2", "u1", None, None, None))
    orders = make(spark, fr.ORDERS, order("o1", bought="2018-03-01 00:00:00"),
                  order("o2", bought="2017-03-01 23:59:59"), order("o3", bought=None))
    rows = {r.customer_id: r for r in silver.dim_customers(customers, orders).collect()}
    assert rows["c1"].valid_from == datetime.date(2017, 3, 1)
    assert (rows["c1"].customer_city, rows["c1"].customer_state) == ("Sao Paulo", "SP")
    assert rows["c2"].valid_from == datetime.date(2016, 1, 1)
    assert all(r.is_current and r.valid_to is None for r in rows.values())


def test_dim_products_category_fallback(spark):
    products = make(spark, fr.PRODUCTS, ("p1", "brinquedos", 1, 2, 3, 4, 2, 3, 4),
                    ("p2", "sem_traducao", 1, 2, 3, 4, 2, None, 4),
                    ("p3", None, None, None, None, None, None, None, None))
    translation = make(spark, fr.TRANSLATION, ("brinquedos", "toys"))
    rows = {r.product_id: r for r in silver.dim_products(products, translation).collect()}
    assert [rows[p].category_english for p in ("p1", "p2", "p3")] == ["toys", "sem_traducao", None]
    assert [rows[p].volume_cm3 for p in ("p1", "p2", "p3")] == [24, None, None]
    assert (rows["p1"].product_name_length, rows["p1"].product_description_length) == (1, 2)


def shop(spark):
    orders = make(
        spark, fr.ORDERS,
        order("o1"), order("o2", "gone", "shipped", delivered=None),
        order("late", promised="2018-01-05 00:00:00"), order("no_items"),
        order("no_date", bought=None), order(None),
    )
    items = make(
        spark, fr.ITEMS,
        item("o1"), item("o1", 2, "p2", "gone", 2.5), item("o2"), item("late", product=None),
        item("no_date"), item(None), item("orphan"),
    )
    customers = make(spark, fr.CUSTOMERS, ("c1", "u1", "01", "sao paulo", "sp"))
    lookups = {
        "payments": silver.payments_by_order(
            make(spark, fr.PAYMENTS, ("o1", 1, "card", 2, 12.0), ("o1", 2, "voucher", 1, 0.5))),
        "reviews": silver.reviews_latest(
            make(spark, fr.REVIEWS, ("r1", "o1", 4, None, "fine", None, None))),
        "customers": silver.dim_customers(customers, orders),
        "products": silver.dim_products(
            make(spark, fr.PRODUCTS, ("p1", "a", 1, 1, 1, 100, 1, 1, 1)),
            make(spark, fr.TRANSLATION, ("a", "A"))),
        "sellers": silver.dim_sellers(make(spark, fr.SELLERS, ("s1", "02", "rio", "rj"))),
    }
    return orders, items, lookups


def test_enriched_rows_and_measures(spark):
    wide = silver.enrich_orders(*shop(spark))
    assert tuple(wide.columns) == silver.ENRICHED_COLUMNS
    rows = {(r.order_id, r.order_item_id): r for r in wide.collect()}
    assert set(rows) == {("o1", 1), ("o1", 2), ("o2", 1), ("late", 1)}
    first = rows["o1", 1]
    assert (first.total_payment_value, first.payment_type, first.payment_installments) == (
        12.5, "card", 2)
    assert (first.review_score, first.category_english, first.seller_city) == (4, "A", "Rio")
    assert (first.delivery_days, first.estimated_days, first.delivery_delay_days) == (4, 9, -5)
    assert (first.purchase_year, first.purchase_month, first.purchase_quarter,
            first.year_month) == (2018, 1, 1, "2018-01")
    assert rows["o1", 2].seller_city is None and rows["o1", 2].category_english is None
    open_order = rows["o2", 1]
    assert (open_order.delivery_days, open_order.delivery_delay_days) == (None, None)
    assert open_order.is_late_delivery is False and open_order.customer_city is None
    assert rows["late", 1].is_late_delivery is True
    assert rows["late", 1].delivery_delay_days == 0


def test_fewer_columns_same_rows(spark):
    tables = shop(spark)
    whole = silver.enrich_orders(*tables)
    for keep in (["item_price"], ["review_score", "order_id"], ["seller_state", "category_english"],
                 ["customer_state", "year_month"]):
        narrow = silver.enrich_orders(*tables, keep)
        assert sorted(map(str, narrow.collect())) == sorted(
            map(str, whole.select(*narrow.columns).collect()))
    assert silver.lookups_for(["item_price"]) == []


def test_old_versions_of_customers_are_not_joined(spark):
    orders, items, lookups = shop(spark)
    current = lookups["customers"]
    moved = current.withColumns({"customer_city": current.customer_state})
    history = apply_changes(current, moved.drop("valid_from", "valid_to", "is_current"),
                            "customer_id", ["customer_city"], datetime.date(2019, 1, 1))
    assert history.count() == 2
    wide = silver.enrich_orders(orders, items, {**lookups, "customers": history})
    assert wide.count() == 4
    assert {r.customer_city for r in wide.collect()} == {"SP", None}


def test_apply_changes(spark):
    ddl = "id INT, city STRING, note STRING, valid_from DATE, valid_to DATE, is_current BOOLEAN"
    d1, d2, d3 = (datetime.date(2018, m, 1) for m in (1, 2, 3))
    old = make(
        spark, ddl,
        (1, "A", "x", d1, d2, False), (1, "B", "x", d2, None, True),
        (2, "A", "x", d1, None, True), (3, None, "x", d1, None, True), (4, "A", "x", d1, None, True),
        (None, "A", "x", d1, None, True),
    )
    snapshot = make(spark, "id INT, city STRING, note STRING",
                    (1, "C", "x"), (2, "A", "changed"), (3, None, "x"), (5, "N", "x"),
                    (None, "A", "x"))
    got = sorted(map(tuple, apply_changes(old, snapshot, "id", ["city"], d3).collect()), key=str)
    assert got == sorted([
        (1, "A", "x", d1, d2, False), (1, "B", "x", d2, d3, False), (1, "C", "x", d3, None, True),
        (2, "A", "x", d1, None, True), (3, None, "x", d1, None, True), (4, "A", "x", d1, None, True),
        (5, "N", "x", d3, None, True), (None, "A", "x", d1, None, True),
    ], key=str)


def test_items_added_up_per_order(spark):
    tables = shop(spark)
    keep = ["order_id", "item_price", "freight_value", "review_score", "delivery_days"]
    rows = silver.enrich_orders(*tables, keep, per_order=True).collect()
    assert {tuple(r) for r in rows} == {
        ("o1", 12.5, 2.0, 4, 4, 2), ("o2", 10.0, 1.0, None, None, 1), ("late", 10.0, 1.0, None, 4, 1)}
    for column in ("seller_id", "category_english"):
        with pytest.raises(ValueError):
            silver.enrich_orders(*tables, [column], per_order=True)
