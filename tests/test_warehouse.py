from __future__ import annotations

from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from bazaar.plans import catalog, explorations, marts
from bazaar.plans.daily import run_daily
from bazaar.plans.warehouse import Warehouse, independent_groups, with_needs
from bazaar.schemas import CONTRACTS, ROW_ORDER, TABLES
from bazaar.sources.storage import PartitionedTable, VersionedTable, shared_folder
from bazaar.sources.tables import raw_tables
from conftest import TESTDATA

FIRST, SECOND = datetime(2024, 1, 1), datetime(2024, 1, 2)


def raw_frame(spark, table: str, data: list[tuple]):
    columns = CONTRACTS[table]
    schema = ", ".join(f"{c} string" for c in columns) + f", {ROW_ORDER} int"
    return spark.createDataFrame([(*row, i) for i, row in enumerate(data)], schema)


def order(key: str, customer: str, bought: str | None, delivered: str | None, status="delivered"):
    return (key, customer, status, bought, bought, None, delivered, "2018-02-01")


def small_raw(spark, **changes):
    data = {
        "geography": [
            ("1151", "-23.5", "-46.6", " São Paulo ", "sp"),
            ("1151", "0", "0", "other", "xx"),
            ("22222", "bad", None, "Rio", "rj"),
            ("33333", "12345.5", "1", "far", "rj"),
            ("4444444", "1", "1", "long", "rj"),
            (None, "1", "1", "none", "rj"),
        ],
        "customers": [
            ("c1", "u1", "01151", "x", "SP"),
            ("c1", "u9", "22222", "x", "SP"),
            ("c2", "u2", None, "x", "SP"),
            ("c3", "u3", "22222", "x", "SP"),
        ],
        "products": [
            ("p1", "beleza", "5", "5", "1", "100.9", "2", "3", "4"),
            ("p2", "sem_nome", "5", "5", None, None, None, None, None),
            ("p3", None, "5", "5", "x", "1", "1", "1", "1"),
        ],
        "category_translation": [("beleza", "beauty")],
        "sellers": [("s1", "1151"), ("s2", "99999"), ("s1", "22222")],
        "orders": [
            order("o1", "c1", "2018-01-05 10:00:00", "2018-01-15 22:00:00"),
            order("o2", "c2", "2018-01-06", None, "shipped"),
            order("o3", "c3", "invalid", "2018-01-07"),
            order("o4", "c3", "2018-02-01", "2018-02-03"),
        ],
        "order_payments": [
            ("o1", None, "2", "10.10"),
            ("o1", "boleto", "5", "0.20"),
            ("o2", "voucher", "x", None),
            (None, "boleto", "1", "99"),
        ],
        "order_items": [
            ("o1", "1", "p1", "s1", "7.50", None),
            ("o1", "2", "p9", "s1", "1.00", "0.5"),
            ("o9", "1", "p1", "s2", "bad", "1"),
        ],
    }
    data.update(changes)
    return {table: raw_frame(spark, table, values) for table, values in data.items()}


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    house = Warehouse(spark, str(tmp_path_factory.mktemp("small")), FIRST)
    return house.load(small_raw(spark))


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    house = Warehouse(spark, str(tmp_path_factory.mktemp("loaded")), FIRST)
    return house.load(raw_tables(spark, TESTDATA))


def by_key(df, *columns):
    return {row[0]: tuple(row)[1:] for row in df.select(*columns).collect()}


def test_geography(small):
    got = by_key(
        small.table("dim_geography"), "zip_code_prefix", "geography_id", "city", "state", "latitude"
    )
    assert got == {
        "01151": (1, "são paulo", "SP", Decimal("-23.500000")),
        "22222": (2, "rio", "RJ", None),
    }


def test_bad_rows_are_set_apart(small):
    got = {(r.column_name, r.raw_value, r.reason) for r in small.quarantine("dim_geography").collect()}
    assert got == {
        ("latitude", "12345.5", "out of range"),
        ("zip_code_prefix", "4444444", "longer than 5"),
        ("zip_code_prefix", None, "missing key"),
    }
    products = small.quarantine("dim_products").collect()
    assert [(r.row_key, r.column_name, r.raw_value) for r in products] == [
        ("p3", "product_photos_qty", "x")
    ]
    assert small.quarantine("dim_customers") is None


def test_lookups_find_the_id_by_the_natural_key(small):
    customers = by_key(small.table("dim_customers"), "customer_id", "zip_code_prefix", "geography_id")
    assert customers == {"c1": ("01151", 1), "c2": ("None", None), "c3": ("22222", 2)}
    orders = small.table("fact_orders").join(small.table("dim_time"), "date_id")
    assert {r.order_id: str(r.date_actual) for r in orders.collect()} == {
        "o1": "2018-01-05",
        "o2": "2018-01-06",
        "o4": "2018-02-01",
    }


def test_products(small):
    got = by_key(
        small.table("dim_products"),
        "product_id",
        "category_name",
        "category_name_english",
        "product_weight_g",
        "product_length_cm",
        "product_photos_qty",
    )
    assert got == {
        "p1": ("beleza", "beauty", 100, 2.0, 1),
        "p2": ("sem_nome", None, 0, 0.0, 0),
    }


def test_sellers_take_the_last_row(small):
    got = by_key(small.table("dim_sellers"), "seller_id", "zip_code_prefix", "geography_id")
    assert got == {"s1": ("22222", 2), "s2": ("99999", None)}


def test_orders(small):
    got = by_key(
        small.table("fact_orders"),
        "order_id",
        "total_amount",
        "payment_type",
        "payment_installments",
        "delivery_delay",
        "purchase_month",
    )
    assert got == {
        "o1": (Decimal("10.30"), None, 5, 10.5, 201801),
        "o2": (Decimal("0.00"), None, None, None, 201801),
        "o3": (Decimal("0.00"), None, None, None, 0),
        "o4": (Decimal("0.00"), None, None, 2.0, 201802),
    }


def test_items(small):
    got = {
        (r.order_id, r.order_item_id): (r.price, r.freight_value, r.purchase_month)
        for r in small.table("fact_order_items").collect()
    }
    assert got == {
        ("o1", "1"): (Decimal("7.50"), Decimal("0.00"), 201801),
        ("o1", "2"): (Decimal("1.00"), Decimal("0.50"), 201801),
    }


def test_bad_fact_values_are_set_apart(small):
    def apart(name):
        return {tuple(r)[1:] for r in small.quarantine(name).collect()}

    assert apart("fact_order_items") == {("o9|1", "price", "bad", "not a number")}
    assert apart("order_payments") == {
        ("o2", "payment_installments", "x", "not a number"),
        ("", "order_id", None, "missing key"),
    }
    # A bad date is noted, and its order loaded without it.
    assert apart("fact_orders") == {
        ("o3", column, "invalid", "not a date") for column in ("purchase_timestamp", "approved_at")
    }


def test_marts_drop_rows_without_a_dimension(small):
    star = small.star()
    days = marts.daily_revenue(star).collect()
    assert [str(r.date_actual) for r in days] == ["2018-01-05", "2018-01-06", "2018-02-01"]
    sellers = marts.seller_performance(star).collect()
    assert [(r.seller_id, r.total_orders, r.total_revenue) for r in sellers] == [
        ("s1", 1, Decimal("7.50"))
    ]
    # Item grain: both items of the one delivered order count.
    delays = explorations.delivery_by_seller(star).collect()
    assert [(r.seller_id, r.avg_delivery_days, r.total_orders) for r in delays] == [("s1", 10.5, 2)]


def test_delay_of_seven_days_is_not_over_a_week(spark, tmp_path):
    raw = small_raw(
        spark,
        orders=[
            order("o1", "c1", "2018-01-01", "2018-01-08"),
            order("o2", "c1", "2018-01-01", "2018-01-08 00:00:01"),
        ],
    )
    star = Warehouse(spark, str(tmp_path), FIRST).load(raw).star()
    assert marts.delivery_performance(star).first().deliveries_over_week == 1


def test_growth_after_a_year_without_revenue(spark):
    star = {
        "fact_orders": spark.createDataFrame(
            [("a", 1, Decimal(0)), ("b", 2, Decimal(50)), ("c", 3, Decimal(75))],
            "order_id string, date_id int, total_amount decimal(18,2)",
        ),
        "dim_time": spark.createDataFrame([(1, 2016), (2, 2017), (3, 2018)], "date_id int, year int"),
    }
    growth = [r.growth_rate for r in explorations.yearly_growth(star).collect()]
    assert growth == [None, None, Decimal("50.00")]


def test_reload_changes_nothing(spark, tmp_path, rows):
    raw = small_raw(spark)
    Warehouse(spark, str(tmp_path), FIRST).load(raw)
    before = {name: rows(df) for name, df in Warehouse(spark, str(tmp_path)).star().items()}
    shuffled = {name: df.repartition(3) for name, df in raw.items()}
    Warehouse(spark, str(tmp_path), SECOND).load(shuffled)
    after = {name: rows(df) for name, df in Warehouse(spark, str(tmp_path)).star().items()}
    assert after == before and set(after) == set(TABLES)


def test_second_batch_updates_only_listed_columns(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path), FIRST).load(small_raw(spark))
    time_before = by_key(house.table("dim_time"), "date_actual", "date_id")
    changed = small_raw(
        spark,
        geography=[
            ("11111", "1", "1", "new", "mg"),
            ("22222", "2", "2", "Niterói", "rj"),
        ],
        orders=[
            # The same order in another month and status, and an earlier day for the calendar.
            order("o1", "c3", "2018-03-09", None, "canceled"),
            order("o5", "c1", "2017-12-31", "2018-01-02"),
        ],
        order_payments=[("o1", "voucher", "9", "4.00")],
        order_items=[("o1", "2", "pX", "sX", "9.99", "1.11"), ("o9", "1", "p1", "s2", "3", "4")],
    )
    house = Warehouse(spark, str(tmp_path), SECOND).load(changed)
    assert by_key(house.table("dim_geography"), "zip_code_prefix", "geography_id", "city", "created_at") == {
        "01151": (1, "são paulo", FIRST),
        "22222": (2, "niterói", FIRST),
        "11111": (3, "new", SECOND),
    }
    time_after = by_key(house.table("dim_time"), "date_actual", "date_id")
    assert time_before.items() <= time_after.items()
    assert len(set(time_after.values())) == len(time_after)
    got = by_key(
        house.table("fact_orders"),
        "order_id",
        "customer_id",
        "order_status",
        "purchase_timestamp",
        "total_amount",
        "payment_type",
        "payment_installments",
        "delivery_delay",
        "created_at",
        "purchase_month",
    )
    bought = datetime(2018, 1, 5, 10)
    assert got["o1"] == (
        # 10.30 were paid in the first batch, 4.00 in the second.
        "c3", "canceled", bought, Decimal("14.30"), None, 5, None, FIRST, 201801,
    )
    assert got["o5"][7:] == (SECOND, 201712) and set(got) == {"o1", "o2", "o3", "o4", "o5"}
    items = {
        (r.order_id, r.order_item_id): (r.product_id, r.price, r.freight_value, r.purchase_month)
        for r in house.table("fact_order_items").collect()
    }
    assert items == {
        ("o1", "1"): ("p1", Decimal("7.50"), Decimal("0.00"), 201801),
        ("o1", "2"): ("p9", Decimal("9.99"), Decimal("1.11"), 201801),
        ("o9", "1"): ("p1", Decimal("3.00"), Decimal("4.00"), 0),
    }


def test_second_batch_leaves_other_months_alone(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path), FIRST).load(small_raw(spark))
    folder = house.months("fact_orders").folders
    january, february = folder()[201801], folder()[201802]
    raw = small_raw(spark, orders=[order("o2", "c2", "2018-01-06", "2018-01-09")])
    house.load_only(raw, ["fact_orders"])
    assert folder()[201802] == february and folder()[201801] != january
    assert house.table("fact_orders").count() == 4


def test_a_small_batch_opens_the_months_of_its_orders(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path), FIRST).load(small_raw(spark))
    months = {r.order_id: r.purchase_month for r in house.table("fact_orders").collect()}
    assert len(set(months.values())) > 1
    for name in ("fact_orders", "fact_order_items"):
        for row in house.table(name).select("order_id", "purchase_month").distinct().collect():
            wanted = spark.createDataFrame([(row.order_id,)], "order_id string")
            assert row.purchase_month in house.months_of(name, wanted)
    wanted = spark.createDataFrame([("o1",), ("none",)], "order_id string")
    assert house.months_of("fact_orders", wanted) == {months["o1"]}
    read = house.rows_of("fact_orders", wanted)
    assert {f"purchase_month={months['o1']}" in file for file in read.inputFiles()} == {True}
    assert house.rows_of("fact_orders", wanted.limit(0)).isEmpty()


def test_places_grow_with_new_orders_alone(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path), FIRST).load(small_raw(spark))

    def places():
        return sorted(tuple(r)[:2] for r in house.places("fact_orders").read().collect())

    before, folders = places(), house.places("fact_orders").folders()
    house.load_only(small_raw(spark, orders=[order("o2", "c2", "2018-01-06", "2018-01-09")]), ["fact_orders"])
    assert places() == before and house.places("fact_orders").folders() == folders
    house.load_only(small_raw(spark, orders=[order("o8", "c2", "2018-03-06", None)]), ["fact_orders"])
    assert places() == sorted([*before, ("o8", 201803)])


def test_a_fact_without_places_gets_them(spark, tmp_path, monkeypatch):
    house = Warehouse(spark, str(tmp_path), FIRST)
    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "_keep_places", lambda *_: None)
        house.load(small_raw(spark))
    assert house.months_of("fact_orders", house.table("fact_orders")) == set(house.months("fact_orders").folders())
    house.load_only(small_raw(spark, orders=[order("o8", "c2", "2018-03-06", None)]), ["fact_orders"])
    stored = sorted(tuple(r) for r in house.table("fact_orders").select("order_id", "purchase_month").collect())
    assert stored == sorted(tuple(r)[:2] for r in house.places("fact_orders").read().collect())


def test_empty_tables_stop_the_load_or_are_skipped(spark, tmp_path):
    raw = small_raw(spark, orders=[])
    house = Warehouse(spark, str(tmp_path), FIRST)
    with pytest.raises(ValueError, match="orders"):
        house.load(raw)
    assert not house.star()
    house.load(raw, ["dim_geography", "dim_time"], require_non_empty=False)
    assert set(house.star()) == {"dim_geography"}
    with pytest.raises(LookupError, match="dim_time"):
        house.table("dim_time")


def test_failed_load_raises_and_keeps_the_table(spark, tmp_path, rows):
    house = Warehouse(spark, str(tmp_path), FIRST).load(small_raw(spark), ["dim_sellers"])
    before = rows(house.table("dim_sellers"))
    raw = small_raw(spark, sellers=[("s3", "1151")])
    raw["sellers"] = raw["sellers"].withColumn(
        "seller_id", F.raise_error(F.lit("broken source")).cast("string")
    )
    with pytest.raises(Exception, match="broken source"):
        house.load_only(raw, ["dim_sellers"])
    assert rows(Warehouse(spark, str(tmp_path)).table("dim_sellers")) == before


def test_failed_fact_load_keeps_every_month(spark, tmp_path, rows, monkeypatch):
    house = Warehouse(spark, str(tmp_path), FIRST).load(small_raw(spark))
    before = rows(house.table("fact_orders"))
    raw = small_raw(
        spark,
        orders=[order("o1", "c1", "2018-01-05", None, "lost"), order("o4", "c3", "2018-02-01", None, "lost")],
    )
    write = VersionedTable.write

    def fail(self, df, version=None):
        if self.root.endswith("/folders"):  # all months are written, the commit is not
            raise OSError("driver lost")
        return write(self, df, version)

    monkeypatch.setattr(VersionedTable, "write", fail)
    with pytest.raises(OSError):
        house.load_only(raw, ["fact_orders"])
    assert rows(Warehouse(spark, str(tmp_path)).table("fact_orders")) == before
    monkeypatch.undo()
    again = Warehouse(spark, str(tmp_path), SECOND).load_only(raw, ["fact_orders"])
    status = by_key(again.table("fact_orders"), "order_id", "order_status")
    assert (status["o1"], status["o2"], status["o4"]) == (("lost",), ("shipped",), ("lost",))


def test_expired_months_are_deleted(spark, tmp_path, rows):
    house = Warehouse(spark, str(tmp_path), FIRST).load(small_raw(spark))
    for _ in range(3):
        house.load_only(small_raw(spark), ["fact_orders"])
    before = rows(house.table("fact_orders"))
    house.expire(1)
    assert len(list((tmp_path / "fact_orders").glob("data=*"))) == 1
    assert rows(Warehouse(spark, str(tmp_path)).table("fact_orders")) == before


def test_landed_tables_load_alike(spark, small, tmp_path, rows):
    house = Warehouse(spark, str(tmp_path), FIRST)
    house.load(house.land(small_raw(spark)))
    for name, df in house.star().items():
        assert rows(df) == rows(small.table(name))


def test_measures_that_do_not_fit_are_set_apart(spark, tmp_path):
    raw = small_raw(spark, products=[("p1", "beleza", "5", "5", "1", "1e12", "2", "3", "inf")])
    house = Warehouse(spark, str(tmp_path), FIRST).load(raw, ["dim_products"])
    assert [tuple(r)[2:] for r in house.quarantine("dim_products").collect()] == [
        ("product_weight_g", "1e12", "out of range")
    ]
    assert house.table("dim_products").isEmpty()


def test_nothing_stays_staged_after_a_load(spark, loaded):
    folder = Path(f"{shared_folder(spark)}/bazaar-stage/{spark.sparkContext.applicationId}")
    before = set(folder.iterdir()) if folder.exists() else set()
    house = Warehouse(spark, loaded.root + "-again", FIRST).load(small_raw(spark))
    house.load(small_raw(spark))
    assert (set(folder.iterdir()) if folder.exists() else set()) == before


def test_needs():
    assert independent_groups(list(TABLES)) == [
        ["dim_geography", "dim_products", "dim_time"],
        ["dim_customers", "dim_sellers", "fact_orders"],
        ["fact_order_items"],
    ]
    assert with_needs(["fact_order_items"]) == ["dim_time", "fact_orders", "fact_order_items"]


def test_loaded_rows_are_reported(loaded):
    assert loaded.loaded_rows["fact_order_items"] == 6000
    assert loaded.loaded_rows["dim_customers"] == 150


def test_revenue_agrees_across_grains(loaded):
    star = loaded.star()
    total = lambda df: df.agg(F.sum("total_revenue")).first()[0]
    totals = {
        total(marts.daily_revenue(star)),
        total(marts.monthly_revenue(star)),
        total(explorations.quarterly_revenue(star)),
        total(explorations.yearly_growth(star)),
    }
    assert totals == {Decimal("301270840.87")}


def test_trusted_keys_give_the_distinct_counts(loaded, rows):
    star = loaded.star()
    for mart in (marts.daily_revenue, marts.monthly_revenue, marts.orders_by_region):
        assert rows(mart(star)) == rows(mart(star, trust_keys=False))


def test_untrusted_keys_count_a_repeated_order_once(loaded):
    star = loaded.star()
    star["fact_orders"] = star["fact_orders"].union(star["fact_orders"])
    once, twice = (marts.monthly_revenue(star, trust_keys=t) for t in (False, True))
    count = lambda df: df.agg(F.sum("number_of_orders")).first()[0]
    assert 2 * count(once) == count(twice) == 3000


def test_views_and_refreshed_marts(spark, loaded, rows):
    names = marts.create_analysis_views(loaded.star())
    loaded.refresh_marts()
    assert names == list(marts.MARTS)
    for name in names:
        assert rows(spark.table(name)) == rows(loaded.mart(name))
    top = spark.sql("SELECT seller_id FROM seller_performance ORDER BY total_revenue DESC LIMIT 10")
    assert top.collect() == explorations.top_sellers(loaded.star()).select("seller_id").collect()


def test_catalog_tables_and_statistics(spark, loaded):
    catalog.create_tables(spark, "shop", loaded)
    catalog.create_tables(spark, "shop", loaded)
    catalog.publish(spark, "shop", loaded)
    catalog.analyze_tables(spark, "shop")
    for name, df in loaded.star().items():
        assert spark.table(f"shop.{name}").count() == df.count()
    stats = spark.sql("DESCRIBE EXTENDED shop.fact_orders").where("col_name = 'Statistics'").first()
    assert "1500 rows" in stats.data_type


def test_daily_run_from_csv_files(spark, small, tmp_path, rows):
    folder = tmp_path / "raw"
    folder.mkdir()
    names = {
        "geography": "geolocation_dataset.csv",
        "category_translation": "product_category_name_translation.csv",
    }
    for table, df in small_raw(spark).items():
        file = folder / names.get(table, f"{table}_dataset.csv")
        df.drop(ROW_ORDER).toPandas().to_csv(file, index=False, encoding="utf-8-sig")
    counts = [
        run_daily(spark, str(folder), str(tmp_path / "shop"), "daily", run_ts)
        for run_ts in (FIRST, SECOND, SECOND)
    ]
    assert counts[0] == counts[1] == counts[2] == {n: df.count() for n, df in small.star().items()}
    house = Warehouse(spark, str(tmp_path / "shop"))
    for name, df in house.star().items():
        assert rows(df) == rows(small.table(name))
        assert spark.table(f"daily.{name}").count() == df.count()
    assert len(list((tmp_path / "shop" / "dim_sellers").glob("version=*"))) == 2
    assert rows(house.mart("daily_revenue")) == rows(marts.daily_revenue(small.star()))


def test_facts_are_not_moved_again_to_be_written(spark, tmp_path, monkeypatch):
    moved = []
    put = PartitionedTable.put
    monkeypatch.setattr(PartitionedTable, "put", lambda table, df: moved.append(table.root) or put(table, df))
    shop = Warehouse(spark, str(tmp_path / "shop"), FIRST).load(small_raw(spark))
    shop.load(small_raw(spark), ["fact_orders", "fact_order_items"])
    assert {root.rsplit("/", 1)[1] for root in moved} == {"fact_orders_places", "fact_order_items_places"}
    assert shop.table("fact_orders").count() == 4


def test_new_orders_are_added_without_a_join(spark, tmp_path, monkeypatch):
    house = Warehouse(spark, str(tmp_path / "shop"), FIRST).load(small_raw(spark))
    stored = {name: house.table(name).count() for name in ("fact_orders", "fact_order_items")}
    plans = {}
    put = PartitionedTable.put_as_dealt

    def noted(table, df):  # the batch is written first, then orders that were paid for
        plan = df._jdf.queryExecution().executedPlan().toString()
        plans.setdefault(table.root.rsplit("/", 1)[1], plan)
        return put(table, df)

    monkeypatch.setattr(PartitionedTable, "put_as_dealt", noted)
    tables = ["fact_orders", "fact_order_items"]
    raw = small_raw(spark, orders=[order("n1", "c1", "2018-01-07", None), order("n2", "c1", "2018-05-07", None)])
    raw["order_items"] = raw["order_items"].where("order_id = 'o1'").withColumn("order_id", F.lit("n1"))
    new = raw["order_items"].select("order_item_id").distinct().count()
    house.load_only(raw, tables)
    for name in tables:
        assert "Join" not in plans[name] and "Exchange" not in plans[name]
    assert house.table("fact_orders").count() == stored["fact_orders"] + 2
    assert house.table("fact_order_items").count() == stored["fact_order_items"] + new

    # One that is stored and one that is new, in a month of others: the first is updated in place.
    plans.clear()
    known = [order("n1", "c2", "2018-01-07", None, "sent"), order("n3", "c1", "2018-05-08", None)]
    house.load_only(small_raw(spark, orders=known), ["fact_orders"])
    assert "Join" in plans["fact_orders"]
    found = by_key(house.table("fact_orders"), "order_id", "customer_id", "order_status", "purchase_month")
    assert len(found) == house.table("fact_orders").count() == stored["fact_orders"] + 3
    assert found["n1"] == ("c2", "sent", 201801) and found["n2"][2] == found["n3"][2] == 201805
