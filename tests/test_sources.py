from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from bazaar.plans.dimensions import translated_products
from bazaar.schemas import CONTRACTS, ROW_ORDER
from bazaar.sources.contracts import missing_columns, require_schema, validate_schema
from bazaar.sources.files import broken_lines, extract, parse_csv, read_csv
from bazaar.sources.storage import PartitionedTable, VersionedTable, shared_folder, stage


def write(path, text: str, encoding: str = "utf-8") -> str:
    path.write_text(text, encoding=encoding, newline="")
    return str(path)


def test_csv_with_bom_crlf_quotes_and_missing_values(spark, tmp_path):
    path = write(
        tmp_path / "c.csv",
        'zip,city,n\r\n01151,"a, ""b"" ",NA\r\n2,,nan\r\n3,x,7',
        "utf-8-sig",
    )
    df = read_csv(spark, path)
    assert df.columns == ["zip", "city", "n", ROW_ORDER]
    got = [tuple(r)[:3] for r in df.orderBy(ROW_ORDER).collect()]
    assert got == [("01151", 'a, "b" ', None), ("2", None, None), ("3", "x", "7")]


def test_broken_lines_are_set_apart(spark, tmp_path):
    text = 'a,b\n1,2\n3,4,5\n6\n"7,8\n9,"x,y"\n'
    path = write(tmp_path / "lines.csv", text)
    df = read_csv(spark, path)
    assert [tuple(r)[:2] for r in df.orderBy(ROW_ORDER).collect()] == [("1", "2"), ("9", "x,y")]
    assert df.count() == 2 and not df.isEmpty()
    assert [r.b for r in df.select("b").collect()] == ["2", "x,y"]
    assert parse_csv(spark, path).columns == ["a", "b", "_broken_line"]
    for table, columns in CONTRACTS.items():
        write(tmp_path / f"{table}.csv", ",".join(columns) + "\n" + ("1\n" if table == "orders" else ""))
    files = {table: f"{table}.csv" for table in CONTRACTS}
    apart = broken_lines(spark, str(tmp_path), files).collect()
    assert [(r.table_name, r.path.split("/")[-1], r.line) for r in apart] == [("orders", "orders.csv", "1")]


def test_row_order_is_file_order_across_splits(spark, tmp_path):
    path = write(tmp_path / "n.csv", "n\n" + "\n".join(f"{i:06d}" for i in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        df = read_csv(spark, path)
        assert df.rdd.getNumPartitions() > 3
        ordered = [r.n for r in df.orderBy(ROW_ORDER).select("n").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert ordered == sorted(ordered) and len(ordered) == 20_000


def test_contract(spark):
    good = spark.createDataFrame([], "customer_state string, extra int, customer_city string, "
                                     "customer_id string, customer_unique_id string, "
                                     "customer_zip_code_prefix string")
    assert validate_schema(good, "customers")
    bad = good.drop("customer_id").withColumnRenamed("customer_city", "Customer_City")
    assert missing_columns(bad, "customers") == ["customer_city", "customer_id"]
    assert not validate_schema(bad, "customers")
    assert validate_schema(bad, "no such table")
    with pytest.raises(ValueError, match="customer_id"):
        require_schema(bad, "customers")


def test_extract_reads_every_contracted_file(spark, tmp_path):
    names = {
        "geography": "geolocation",
        "category_translation": None,
    }
    for table, columns in CONTRACTS.items():
        stem = names.get(table, table)
        file = (
            f"shop_{stem}_dataset.csv" if stem else "product_category_name_translation.csv"
        )
        values = ",".join(f"v{i}" for i in range(len(columns)))
        write(tmp_path / file, ",".join(columns) + "\n" + values + "\n")
    raw = extract(spark, str(tmp_path))
    assert set(raw) == set(CONTRACTS)
    assert all(df.count() == 1 for df in raw.values())
    products = translated_products(raw["products"], raw["category_translation"])
    assert "product_category_name_english" in products.columns
    assert products.count() == 1


def test_extract_refuses_a_file_without_its_columns(spark, tmp_path):
    for table, columns in CONTRACTS.items():
        write(tmp_path / f"{table}.csv", ",".join(columns) + "\n")
    write(tmp_path / "orders.csv", "order_id\n1\n")
    with pytest.raises(ValueError, match="orders"):
        extract(spark, str(tmp_path), {table: f"{table}.csv" for table in CONTRACTS})


def test_stage_fixes_random_values(spark):
    staged = stage(spark.range(50).withColumn("r", F.rand()), "test")
    assert staged.collect() == staged.collect()


def test_versions_count_only_when_committed(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    assert table.read() is None
    table.write(spark.range(3))
    table.write(spark.range(5))
    (tmp_path / "t" / "version=000000003").mkdir()  # a write that never finished
    assert table.versions() == [1, 2]
    assert table.read().count() == 5 and table.read(below=2).count() == 3
    table.write(spark.range(7))
    assert table.versions() == [1, 2, 3] and table.read().count() == 7
    table.expire(keep=1)
    assert table.versions() == [3]


def test_version_can_be_written_from_the_one_before(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.write(spark.range(3))
    table.write(table.read().union(spark.range(10, 12)))
    assert table.read().count() == 5


def test_shared_folder_is_the_named_one(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_folder(spark)
    assert folder == shared_folder(spark)
    assert named is None or folder == named.rstrip("/")


def test_rows_are_written_by_value_as_they_were_dealt(spark, tmp_path):
    rows = spark.range(40).select("id", (F.col("id") % 2).cast("int").alias("part"))
    table = PartitionedTable(spark, str(tmp_path / "t"), rows.schema, "part")
    put = table.put_as_dealt(rows.repartition(3))
    assert sorted(put) == [0, 1] and table.read() is None
    table.commit(put)
    assert table.read().select(F.input_file_name()).distinct().count() == 6
    table.write_as_dealt(rows.where("part = 1 AND id < 9"))
    assert sorted(r.id for r in table.read().where("part = 1").collect()) == [1, 3, 5, 7]
    assert table.read().count() == 24


def test_a_filter_reads_only_the_staged_folders_it_wants(spark):
    data = [(1, True, "a"), (2, False, "b"), (3, None, "c"), (4, True, "d")]
    rows = spark.createDataFrame(data, "id int, mark boolean, name string")
    staged = stage(rows, "by-mark", ["mark"])
    assert staged.columns == rows.columns
    assert sorted(tuple(r) for r in staged.collect()) == data
    marked = staged.where("mark")
    assert sorted(r.id for r in marked.collect()) == [1, 4]
    assert "PartitionFilters: [isnotnull(mark" in marked._jdf.queryExecution().toString()
