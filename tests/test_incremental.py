from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from bazaar.operators.upsert import reduce_batch
from bazaar.plans.warehouse import Warehouse
from bazaar.schemas import CONTRACTS, ROW_ORDER
from bazaar.sources.storage import VersionedTable
from bazaar.sources.tables import raw_table, read_table
from bazaar.streaming.incremental import ingest_payments, ingest_raw_files, upsert_new_files
from conftest import TESTDATA


def _events(spark):
    return read_table(spark, TESTDATA, "events").drop("props")


def _run(spark, root, events):
    return upsert_new_files(
        spark,
        f"{root}/landing",
        events.schema,
        VersionedTable(spark, f"{root}/users", events.schema),
        ["user_id"],
        ["event_type", "value"],
        ["ts", "event_id"],
        f"{root}/checkpoint",
    )


def test_slices_give_the_result_of_one_batch(spark, tmp_path, rows):
    events = _events(spark)
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    for part in (events.where(F.col("ts") < cut), events.where(F.col("ts") >= cut)):
        part.write.mode("append").parquet(f"{tmp_path}/landing")
        users = _run(spark, tmp_path, events)
    whole = reduce_batch(
        events.withColumn(ROW_ORDER, F.struct("ts", "event_id")), ["user_id"], ["event_type", "value"]
    )
    assert rows(users.select(whole.columns)) == rows(whole)
    again = _run(spark, tmp_path, events)  # nothing new arrived
    assert rows(again) == rows(users)
    assert VersionedTable(spark, f"{tmp_path}/users").versions() == [1, 2]


def test_a_repeated_batch_changes_nothing(spark, tmp_path, rows):
    events = _events(spark)
    events.write.parquet(f"{tmp_path}/landing")
    once = rows(_run(spark, tmp_path, events))
    # The commit record of the batch is lost: the stream repeats it under the same id.
    for lost in (tmp_path / "checkpoint" / "commits").glob("*0*"):
        lost.unlink()
    assert rows(_run(spark, tmp_path, events)) == once


def test_a_lost_checkpoint_loses_no_rows(spark, tmp_path):
    schema = "user_id long, event_id long, ts timestamp_ntz, event_type string, value double"
    ts = datetime(2024, 1, 1)

    def run(checkpoint, *data):
        rows = spark.createDataFrame([(u, e, ts, "a", 1.0) for u, e in data], schema)
        rows.write.mode("append").parquet(f"{tmp_path}/landing")
        users = upsert_new_files(
            spark, f"{tmp_path}/landing", rows.schema, VersionedTable(spark, f"{tmp_path}/users", rows.schema),
            ["user_id"], ["event_type", "value"], ["ts", "event_id"], f"{tmp_path}/{checkpoint}",
        )
        return sorted(r.user_id for r in users.collect())

    assert run("one", (1, 1), (2, 2), (None, 3)) == [1, 2]
    assert run("one", (3, 4)) == [1, 2, 3]
    assert run("two", (4, 5)) == [1, 2, 3, 4]
    rejected = VersionedTable(spark, f"{tmp_path}/users/rejected").read()
    assert [r.event_id for r in rejected.collect()] == [3]


def test_new_payments_add_to_their_orders_alone(spark, tmp_path):
    def frame(table, data):
        columns = ", ".join(f"{c} string" for c in CONTRACTS[table])
        return spark.createDataFrame([(*r, i) for i, r in enumerate(data)], f"{columns}, {ROW_ORDER} int")

    raw = {
        "orders": frame("orders", [(o, "c", "x", "2018-01-05", None, None, None, None) for o in ("o1", "o2", "o3")]),
        "order_payments": frame("order_payments", [("o1", "boleto", "1", "5.00"), ("o2", "card", "2", "7.00")]),
    }
    house = Warehouse(spark, f"{tmp_path}/house", datetime(2024, 1, 1)).load_only(raw, ["dim_time", "fact_orders"])
    landing = tmp_path / "landing"
    landing.mkdir()

    def run(checkpoint, name, *lines):
        (landing / name).write_text("\n".join([",".join(CONTRACTS["order_payments"]), *lines]) + "\n")
        ingest_payments(house, str(landing), f"{tmp_path}/{checkpoint}")
        return {
            r.order_id: (float(r.total_amount), r.payment_type, r.payment_installments)
            for r in house.table("fact_orders").collect()
        }

    want = {"o1": (8.0, "boleto", 4), "o2": (7.0, "card", 2), "o3": (0.0, None, None)}
    assert run("one", "1.csv", "o1,voucher,4,3.00", "o9,voucher,1,1.00", "o2,voucher,1,bad") == want
    assert {(r.row_key, r.reason) for r in house.quarantine("order_payments").collect()} == {
        ("o9", "unknown order"), ("o2", "not a number"),
    }
    want["o3"] = (2.5, "card", 1)
    assert run("one", "2.csv", "o3,card,1,2.50") == want
    kept = house.stored_payments().where("NOT lead").count()
    assert run("lost", "3.csv", "o2,card,1,1.00") == want | {"o2": (8.0, "card", 2)}
    assert house.stored_payments().where("NOT lead").count() == kept + 1
    # A run that is lost before it notes its files is repeated.
    noted = VersionedTable(spark, f"{house.root}/ingested/order_payments")
    assert noted.read_all().count() == 3
    spark.range(0).selectExpr("string(id) AS path").write.mode("overwrite").parquet(noted.path(noted.versions()[-1]))
    assert run("lost again", "3.csv", "o2,card,1,1.00") == want | {"o2": (8.0, "card", 2)}
    assert run("lost again", "3.csv", "o2,card,1,1.00") == want | {"o2": (8.0, "card", 2)}
    with pytest.raises(ValueError, match="fact_orders"):
        ingest_raw_files(house, "order_payments", str(landing), f"{tmp_path}/c", ["fact_orders"])


def test_totals_keep_all_payments(spark, tmp_path):
    """Orders that are sent again, payments that come before their order, twice or in parts."""
    def frame(table, data):
        columns = ", ".join(f"{c} string" for c in CONTRACTS[table])
        return spark.createDataFrame([(*r, i) for i, r in enumerate(data)], f"{columns}, {ROW_ORDER} int")

    def orders(*ids, status="created"):
        return frame("orders", [(o, "c", status, "2018-01-05", None, None, None, None) for o in ids])

    house = Warehouse(spark, f"{tmp_path}/house", datetime(2024, 1, 1))

    def send(orders, *payments):
        raw = {"orders": orders, "order_payments": frame("order_payments", payments)}
        house.load_only(raw, ["dim_time", "fact_orders"])
        return totals()

    def totals():
        return {
            r.order_id: (float(r.total_amount), r.payment_type, r.order_status)
            for r in house.table("fact_orders").collect()
        }

    first = ("o1", "boleto", "1", "5.00")
    assert send(orders("o1"), first) == {"o1": (5.0, "boleto", "created")}
    house.add_payments(frame("order_payments", [("o1", "voucher", "4", "3.00"), ("o2", "card", "1", "4.00")]), ["b"])
    assert totals() == {"o1": (8.0, "boleto", "created")}
    assert send(orders("o1", status="shipped")) == {"o1": (8.0, "boleto", "shipped")}
    assert send(orders("o1", status="sent"), first) == {"o1": (8.0, "boleto", "sent")}
    # The order of a payment that came before it; a source read again; equal payments in one batch.
    assert send(orders("o2"))["o2"] == (4.0, "card", "created")
    house.add_payments(frame("order_payments", [("o2", "card", "1", "4.00"), ("o1", "voucher", "4", "3.00")]), ["b"])
    assert totals()["o2"] == (4.0, "card", "created") and totals()["o1"][0] == 8.0
    assert send(orders("o3"), ("o3", "card", "1", "2.00"), ("o3", "card", "1", "2.00"))["o3"][0] == 4.0
    # A payment in a load for an order that the load does not have.
    assert send(orders("o4"), ("o2", "voucher", "1", "1.00"))["o2"] == (5.0, "card", "created")


def test_csv_files_are_folded_into_the_warehouse(spark, tmp_path, rows):
    def orders(name: str, *lines: str) -> None:
        folder = tmp_path / "landing"
        folder.mkdir(exist_ok=True)
        text = "\n".join([",".join(CONTRACTS["orders"]), *lines]) + "\n"
        (folder / name).write_text(text)

    payments = spark.createDataFrame(
        [("o1", "boleto", "1", "5.00", 0)],
        "order_id string, payment_type string, payment_installments string, "
        f"payment_value string, {ROW_ORDER} int",
    )
    house = Warehouse(spark, f"{tmp_path}/house", datetime(2024, 1, 1))

    def run():
        ingest_raw_files(
            house,
            "orders",
            f"{tmp_path}/landing",
            f"{tmp_path}/checkpoint",
            ["dim_time", "fact_orders"],
            {"order_payments": payments},
        )
        return rows(house.table("fact_orders"), "order_id", "order_status", "delivery_delay")

    orders("1.csv", "o1,c1,shipped,2018-01-05,NA,,,2018-01-20", "o2,c1,shipped,2018-01-06,,,,")
    assert run() == [("o1", "shipped", None), ("o2", "shipped", None)]
    orders("2.csv", "o1,c1,delivered,2018-01-05,,,2018-01-07 12:00:00,2018-01-20")
    assert run() == [("o1", "delivered", 2.5), ("o2", "shipped", None)]
    assert run() == [("o1", "delivered", 2.5), ("o2", "shipped", None)]
    assert house.table("fact_orders").where("date_id IS NULL").isEmpty()


def test_raw_tables_stream_like_files(spark):
    # The adapter's frames carry the order column every load relies on.
    assert ROW_ORDER in raw_table(spark, TESTDATA, "orders").columns
