from __future__ import annotations

from datetime import datetime

import pytest

from bazaar.plans import partials
from bazaar.plans.marts import MARTS
from bazaar.plans.registry import refreshed_marts
from bazaar.plans.warehouse import Warehouse
from bazaar.schemas import CONTRACTS, ROW_ORDER, TABLES
from bazaar.sources.storage import PartitionedTable
from bazaar.sources.tables import raw_table
from conftest import TESTDATA


def frame(spark, table, data):
    columns = ", ".join(f"{c} string" for c in CONTRACTS[table])
    return spark.createDataFrame([(*r, i) for i, r in enumerate(data)], f"{columns}, {ROW_ORDER} int")


def order(name, customer, bought, delivered=None):
    return (name, customer, "sent", bought, None, None, delivered, None)


def items(*rows):
    """Items as (order, item, product, seller, price)."""
    place = {c: i for i, c in enumerate(["order_id", "order_item_id", "product_id", "seller_id", "price"])}
    return [
        tuple(r[place[c]] if c in place else ("1.00" if c == "freight_value" else None) for c in CONTRACTS["order_items"])
        for r in rows
    ]


def named(table, **values):
    return tuple(values.get(c) for c in CONTRACTS[table])


def house_with_dimensions(spark, path):
    raw = {
        "geography": [
            named("geography", geolocation_zip_code_prefix=z, geolocation_lat="1", geolocation_lng="2",
                  geolocation_city=f"city {z}", geolocation_state=s)
            for z, s in (("11111", "SP"), ("22222", "RJ"))
        ],
        "customers": [
            named("customers", customer_id=c, customer_unique_id=c, customer_zip_code_prefix=z)
            for c, z in (("c1", "11111"), ("c2", "22222"))
        ],
        "sellers": [
            named("sellers", seller_id=s, seller_zip_code_prefix=z) for s, z in (("s1", "11111"), ("s2", "22222"))
        ],
        "products": [named("products", product_id="p1", product_category_name="beleza")],
        "category_translation": [("beleza", "beauty")],
        "orders": [order("o0", "c1", f"{day}") for day in ("2018-01-05", "2018-02-05", "2018-03-05")],
    }
    house = Warehouse(spark, str(path), datetime(2024, 1, 1))
    dimensions = [name for name, table in TABLES.items() if table.partition is None]
    return house.load_only({name: frame(spark, name, data) for name, data in raw.items()}, dimensions)


def send(house, orders, sold):
    raw = {
        "orders": frame(house.spark, "orders", orders),
        "order_items": frame(house.spark, "order_items", items(*sold)),
        "order_payments": frame(house.spark, "order_payments", [(o[0], "card", "1", "3.00") for o in orders]),
    }
    loads = [name for name, given in (("fact_orders", orders), ("fact_order_items", sold)) if given]
    house.load_only(raw, loads)


def check(house, rows):
    house.refresh_marts()
    star = house.star()
    for name, mart in MARTS.items():
        assert rows(house.mart(name)) == rows(mart(star)), name


def test_marts_follow_loads_and_read_changed_months_alone(spark, tmp_path, rows):
    house = house_with_dimensions(spark, tmp_path)
    send(
        house,
        [order("o1", "c1", "2018-01-05", "2018-01-20"), order("o2", "c2", "2018-02-05", "2018-02-07")],
        [("o1", "1", "p1", "s1", "5.00"), ("o2", "1", "p1", "s1", "6.00"), ("o2", "2", "p2", "s2", "7.00")],
    )
    check(house, rows)
    assert partials.refresh(house, "seller_products") == []

    # A later month, and an order without a date: no month of before is read again.
    send(house, [order("o3", "c1", "2018-03-05", "2018-03-06"), order("o4", "c1", None)], [("o3", "1", "p1", "s2", "1.00")])
    assert partials.refresh(house, "customers") == [0, 201803]
    assert partials.refresh(house, "seller_products") == [201803]

    # The longest delay of a month goes: its minima and maxima are made anew.
    send(house, [order("o1", "c1", "2018-01-05", "2018-01-06")], [])
    assert partials.refresh(house, "customers") == [201801]

    # A product that was unknown: only the month that has its items is made again.
    raw = {
        "products": frame(spark, "products", [named("products", product_id="p2", product_category_name="beleza")]),
        "category_translation": frame(spark, "category_translation", [("beleza", "beauty")]),
    }
    house.load_only(raw, ["dim_products"])
    assert partials.refresh(house, "seller_products") == [201802]

    # Items before their order, then more of the same order with it: one order for the seller.
    send(house, [], [("o5", "1", "p1", "s1", "2.00"), ("o6", "1", "p1", "s1", "2.00")])
    send(house, [order("o5", "c2", "2018-02-05")], [("o5", "2", "p2", "s1", "3.00"), ("o5", "3", "p1", "s2", "3.00")])

    # A customer moves: the marts follow.
    moved = [named("customers", customer_id="c1", customer_unique_id="c1", customer_zip_code_prefix="22222")]
    house.load_only({"customers": frame(spark, "customers", moved)}, ["dim_customers"])
    partials.refresh(house, "customers")
    house.expire(1)
    check(house, rows)


def test_items_of_complete_months_do_not_meet_products(spark, tmp_path, rows, monkeypatch):
    house = house_with_dimensions(spark, tmp_path)
    plans, looked_up = {}, []
    write, staged = PartitionedTable.write_as_dealt, partials.stage

    def noted(table, df):
        plans[table.root.rsplit("/", 1)[1]] = df._jdf.queryExecution().executedPlan().toString()
        write(table, df)

    monkeypatch.setattr(PartitionedTable, "write_as_dealt", noted)
    monkeypatch.setattr(partials, "stage", lambda df, label: looked_up.append(label) or staged(df, label))
    send(
        house,
        [order("o1", "c1", "2018-01-05"), order("o2", "c2", "2018-02-05")],
        [("o1", "1", "p1", "s1", "5.00"), ("o2", "1", "p1", "s1", "6.00")],
    )
    check(house, rows)
    assert looked_up == ["unknown"]
    assert not any("Join" in plans[name] for name in ("seller_products", "seller_orders"))

    # An unknown product and a missing one: their month alone is brought down to known products.
    send(house, [order("o3", "c1", "2018-03-05")], [("o3", "1", "p2", "s2", "1.00"), ("o3", "2", "p1", "s2", "2.00")])
    send(house, [order("o4", "c1", "2018-02-06")], [("o4", "1", None, "s1", "9.00")])
    check(house, rows)
    assert looked_up == ["unknown"] * 2
    assert all("LeftSemi" in plans[name] for name in ("seller_products", "seller_orders"))


def test_parts_of_items_meet_their_orders_once(spark, monkeypatch):
    loads = []

    def load_only(house, raw, tables):
        if "fact_order_items" in tables:
            sold, sent = raw["order_items"], raw["orders"].select("order_id")
            text = sold._jdf.queryExecution().executedPlan().toString()
            loads.append(("Join" in text, sold.count(), sold.columns, sent))

    monkeypatch.setattr(Warehouse, "load_only", load_only)
    monkeypatch.setattr(Warehouse, "refresh_marts", lambda house: None)
    with pytest.raises(LookupError):  # nothing was refreshed
        refreshed_marts(spark, TESTDATA)
    items = raw_table(spark, TESTDATA, "order_items")
    assert len(loads) == 2
    for joins, n, columns, sent in loads:
        assert not joins and columns == items.columns
        assert n == items.join(sent, "order_id", "left_semi").count()
