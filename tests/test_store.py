"""Loads that are published as one, and key buckets that spare reading the stored keys."""

import os

import pytest
from pyspark.sql import functions as F

from orderlens import schemas
from orderlens.plans import etl
from orderlens.sources import tables
from orderlens.sources.versions import ConcurrentLoad
from test_etl import GOOD, inputs  # noqa: F401


def customers(spark, first, n):
    ids = spark.range(first, first + n).select(F.format_string("c%09d", "id").alias("customer_id"))
    return ids.withColumns({"customer_unique_id": F.col("customer_id"), "customer_zip_code_prefix": F.lit("01"),
                            "customer_city": F.lit("x"), "customer_state": F.lit("SP")})


def files(folder):
    return {os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if not f.endswith(".crc")}


def test_a_failed_run_leaves_all_tables(spark, inputs, tmp_path):  # noqa: F811
    store = tables.TableStore(spark, str(tmp_path / "out"))
    assert all(r["published"] for r in etl.run_etl(spark, inputs(), store).collect())
    before = {t: store.scan(t).collect() for t in schemas.TABLES}
    kept = files(tmp_path / "out")
    other = {name.split(".")[0]: text.replace("c1,", "c2,").replace("o1,", "o2,").replace("p1,", "p3,").replace("p2,", "p4,")
             for name, text in GOOD.items()}
    other["shop_order_items_dataset"] = GOOD["shop_order_items_dataset.csv"].replace("o1,", "nowhere,")
    status = etl.run_etl(spark, inputs(**other), store).collect()
    assert [r["ok"] for r in status] == [True] * 4 + [False], status[-1]["error"][:500]
    assert not any(r["published"] for r in status)
    assert status[-1]["table_name"] == "order_items" and "foreign_key_exists" in status[-1]["error"]
    assert {t: store.scan(t).collect() for t in schemas.TABLES} == before
    assert files(tmp_path / "out") == kept


def test_readers_see_old_or_new(spark, tmp_path):
    store = tables.TableStore(spark, str(tmp_path / "out"))
    store.append(customers(spark, 0, 10), "customers")
    load = store.begin()
    load.append(customers(spark, 10, 5), "customers")
    old = store.scan("customers")
    assert old.count() == 10
    with pytest.raises(tables.ConstraintViolation, match="primary_key_unique"):
        load.append(customers(spark, 12, 1), "customers")  # its own rows count
    load.publish()
    assert (old.count(), store.scan("customers").count()) == (10, 15)


def test_two_loads_at_once(spark, tmp_path):
    """The second to publish is refused: its keys were checked against the older tables."""
    store = tables.TableStore(spark, str(tmp_path / "out"))
    first, second = store.begin(), store.begin()
    for load in (first, second):
        load.append(customers(spark, 0, 3), "customers")
    first.publish()
    with pytest.raises(ConcurrentLoad):
        second.publish()
    second.abort()
    assert store.scan("customers").count() == 3 and len(store.loads("customers")) == 1


def test_a_retried_append_changes_nothing(spark, tmp_path):
    store = tables.TableStore(spark, str(tmp_path / "out"))
    for _ in range(2):
        assert store.append(customers(spark, 0, 7), "customers", load_id="day-1") == 7
    assert store.append(customers(spark, 7, 2), "customers", load_id="day-2") == 2
    assert store.scan("customers").count() == 9
    with pytest.raises(tables.ConstraintViolation):
        store.append(customers(spark, 8, 1), "customers", load_id="day-3")


def test_a_small_append_reads_few_key_files(spark, tmp_path, monkeypatch):
    """Two new keys read at most two buckets of each load, whatever the number of its buckets."""
    store = tables.TableStore(spark, str(tmp_path / "out"))
    store.append(customers(spark, 0, 2000), "customers")
    monkeypatch.setattr(tables, "KEYS_OF_A_BUCKET", 20)
    store.append(customers(spark, 2000, 2000), "customers")
    assert [x["buckets"] for x in store.loads("customers")] == [16, 128]
    stored = sum(len([f for f in files(x["keys"]) if f.endswith("parquet")]) for x in store.loads("customers"))
    assert stored > 100
    wanted = customers(spark, 1999, 2).select("customer_id")
    found = store.begin().stored_keys("customers", wanted)
    assert found.select(F.input_file_name()).distinct().count() <= 4
    assert found.join(wanted, "customer_id").count() == 2
    assert "PartitionFilters: [bucket" in found._jdf.queryExecution().toString().replace("isnotnull(bucket", "bucket")
    with pytest.raises(tables.ConstraintViolation, match="x2"):
        store.append(customers(spark, 1999, 2), "customers")
    assert store.append(customers(spark, 4000, 2), "customers") == 2


def test_unchecked_rows_count_for_later_checks(spark, tmp_path):
    store = tables.TableStore(spark, str(tmp_path / "out"))
    twice = customers(spark, 0, 3).union(customers(spark, 0, 3))
    assert store.append(twice, "customers", enforce=False) == 6
    assert store.append(customers(spark, 3, 2), "customers") == 2
    for first in (2, 4):
        with pytest.raises(tables.ConstraintViolation, match="x1"):
            store.append(customers(spark, first, 1), "customers")


def test_references_use_the_index(spark, tmp_path):
    store = tables.TableStore(spark, str(tmp_path / "out"))
    store.append(customers(spark, 0, 50), "customers")
    orders = customers(spark, 45, 10).select("customer_id", F.col("customer_id").alias("order_id"))
    with pytest.raises(tables.ConstraintViolation, match=r"foreign_key_exists\(customer_id\) x5"):
        store.append(orders, "orders")
    assert store.append(orders.limit(0), "orders") == 0 and store.scan("orders").count() == 0
    assert store.append(orders.where("customer_id < 'c000000050'"), "orders") == 5
