from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from orderlens.functions import expressions
from pyspark.sql import functions as F

from orderlens import queries, schemas
from orderlens.operators import audit, cleanup
from orderlens.plans import etl
from orderlens.plans import feature_view as fv
from orderlens.sources import csv_files, tables
from shop import item, order, product, relations, review

GOOD = {
    "shop_customers_dataset.csv": "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
    "c1,u1,01234,SÃO Paulo,SP\n",
    "shop_products_dataset.csv": "product_id,product_category_name,product_name_lenght,product_description_lenght,"
    "product_photos_qty,product_weight_g,product_length_cm,product_height_cm,product_width_cm\n"
    "p1,,10,20,1,500,10,10,10\np2,toys,,,,,10,10.0,10\n",
    "shop_orders_dataset.csv": "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
    "order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date\n"
    "o1,c1,delivered,2018-01-01 10:00:00,2018-01-01 11:00:00,2018-01-02 10:00:00,2018-01-05 10:00:00,2018-01-09\n",
    "shop_order_reviews_dataset.csv": "review_id,order_id,review_score,review_comment_title,review_comment_message,"
    "review_creation_date,review_answer_timestamp\n"
    'r1,o1,4,,"two\nlines, a ""quote"" ",2018-01-06 00:00:00,2018-01-07 00:00:00\n',
    "shop_order_items_dataset.csv": "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
    "o1,1,p1,s1,2018-01-03 10:00:00,10.50,2.00\n",
    "product_category_name_translation.csv": "﻿product_category_name,product_category_name_english\ntoys,toys_en\n",
}


@pytest.fixture
def inputs(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()

    def write(**changed):
        for name, text in GOOD.items():
            (folder / name).write_text(changed.get(name.split(".")[0], text), encoding="utf-8")
        return str(folder)

    return write


def test_load_and_view(spark, inputs, tmp_path):
    store = tables.TableStore(spark, str(tmp_path / "out"))
    status = etl.run_etl(spark, inputs(), store).collect()
    assert [(r["table_name"], r["n_rows"], r["ok"]) for r in status] == [
        (t, 2 if t == "products" else 1, True) for t in schemas.TABLES
    ]
    customer = store.scan("customers").first()
    assert customer["customer_zip_code_prefix"] == "01234" and customer["customer_city"] == "são paulo"
    assert [r[0] for r in store.scan("products").orderBy("product_id").select("product_category_name").collect()] == ["unknown", "toys"]
    text = store.scan("reviews").first()
    assert text["review_comment_message"] == 'two lines, a "quote"' and text["review_comment_title"] == ""
    assert store.scan("orders").first()["order_estimated_delivery_date"] is None
    row = fv.feature_view(etl.stored_relations(store)).first()
    assert row["total_price"] == Decimal("10.50") and row["category"] == "unknown"


def test_first_failure_stops_the_run(spark, inputs, tmp_path):
    bad = GOOD["shop_orders_dataset.csv"].replace(",c1,", ",nobody,")
    store = tables.TableStore(spark, str(tmp_path / "out"))
    status = etl.run_etl(spark, inputs(shop_orders_dataset=bad), store).collect()
    assert [(r["table_name"], r["ok"]) for r in status] == [("customers", True), ("products", True), ("orders", False)]
    assert "foreign_key_exists" in status[-1]["error"]
    with pytest.raises(AnalysisException, match="orders"):
        store.scan("orders")  # never loaded
    assert store.scan_or_empty("orders").count() == 0


def test_second_load_of_the_same_keys_is_refused(spark, inputs, tmp_path):
    store = tables.TableStore(spark, str(tmp_path / "out"))
    etl.run_etl(spark, inputs(), store).collect()
    again = etl.run_etl(spark, inputs(), store).collect()
    assert [r["ok"] for r in again] == [False] and store.scan("customers").count() == 1


def test_malformed_number_fails(spark, inputs, tmp_path):
    bad = GOOD["shop_products_dataset.csv"].replace(",500,", ",heavy,")
    store = tables.TableStore(spark, str(tmp_path / "out"))
    status = etl.run_etl(spark, inputs(shop_products_dataset=bad), store).collect()
    assert status[-1]["table_name"] == "products" and not status[-1]["ok"]


def test_absent_column_and_column_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("b,a\n1,NA\n2,x\n")
    df = csv_files.csv_scan(spark, str(tmp_path / "a.csv"), {"a": schemas.TEXT, "b": schemas.INT})
    assert [tuple(r) for r in df.orderBy("b").collect()] == [(None, 1), ("x", 2)]
    with pytest.raises(ValueError, match="lacks"):
        csv_files.csv_scan(spark, str(tmp_path / "a.csv"), {"c": schemas.TEXT})


def test_audit_finds_planted_faults(spark):
    planted = relations(
        spark,
        orders=[order("o1"), order("o1"), order(None), order("o9", status="x" * 16)],
        items=[item("o1"), item("ghost"), item("ghost", 2)],
        products=[product()],
        reviews=[review("o1")],
    )
    found = {(r["table_name"], r["rule"], r["column_name"]): r["n_bad"] for r in audit.constraint_audit(dict(planted.items())).collect()}
    bad = {k: v for k, v in found.items() if v}
    assert bad == {
        ("orders", "primary_key_not_null", "order_id"): 1,
        ("orders", "primary_key_unique", "order_id"): 1,
        ("orders", "length_at_most_15", "order_status"): 1,
        ("order_items", "foreign_key_exists", "order_id"): 2,
    }
    assert len(found) == 21


def test_key_clashes_count_new_rows(spark):
    rows = spark.createDataFrame([("a", "A"), ("a", "A"), ("b", "B"), ("c", "C")], schemas.CATEGORY_NAMES.schema)
    stored = spark.createDataFrame([("a", "A"), ("a", "A"), ("b", "B"), ("z", "Z")], schemas.CATEGORY_NAMES.schema)

    def repeated(*known):
        found = audit.table_violations(rows, schemas.CATEGORY_NAMES, {}, *known)
        return found.where("rule = 'primary_key_unique'").first()["n_bad"]

    assert repeated() == 1 and repeated(stored) == 3


def test_cleanup_leaves_other_columns_alone(spark):
    names = spark.createDataFrame([("a", "A")], "product_category_name string, product_category_name_english string")
    assert cleanup.clean_category_names(names).collect() == names.collect()
    items = spark.createDataFrame([("o", "x")], "order_id string, shipping_limit_date string")
    assert cleanup.clean_order_items(items).first()["shipping_limit_date"] is None


def test_create_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop_test")
    try:
        names = tables.create_tables(spark, "shop_test")
        assert len(names) == 6 and tables.create_tables(spark, "shop_test") == names
        planted = relations(spark)
        with pytest.raises(tables.ConstraintViolation, match="customer_id"):
            tables.append_table(planted.orders, "orders", "shop_test")
        tables.append_table(planted.customers, "customers", "shop_test")
        tables.append_table(planted.orders, "orders", "shop_test")
        with pytest.raises(tables.ConstraintViolation, match="primary_key_unique"):
            tables.append_table(planted.orders, "orders", "shop_test")
        assert spark.table("shop_test.orders").select(F.count("*")).first()[0] == 1
    finally:
        spark.sql("DROP DATABASE shop_test CASCADE")


def test_inferred_types_with_overrides(spark, tmp_path):
    (tmp_path / "a.csv").write_text("zip,n,x,day\n01234,1,1.5,2018-01-01\n04321,,2,2018-01-02\n")
    df = csv_files.csv_scan(spark, str(tmp_path / "a.csv"), {"zip": schemas.TEXT}, infer=True)
    assert dict(df.dtypes) == {"zip": "string", "n": "int", "x": "double", "day": "string"}
    assert [tuple(r) for r in df.orderBy("zip").collect()] == [("01234", 1, 1.5, "2018-01-01"), ("04321", None, 2.0, "2018-01-02")]
    assert set(dict(csv_files.csv_scan(spark, str(tmp_path / "a.csv")).dtypes).values()) == {"string"}


def test_files_of_different_headers_and_rows_of_other_lengths_fail(spark, tmp_path):
    for name, texts in {"order": ["a,b\n1,2\n", "b,a\n30,40\n"], "surplus": ["a,b\n2,y,EXTRA\n"], "short": ["a,b\n2\n"]}.items():
        for breaks in (False, True):
            folder = tmp_path / f"{name}-{breaks}"
            folder.mkdir()
            for i, text in enumerate(texts):
                (folder / f"{i}.csv").write_text(text)
            with pytest.raises(Exception):
                csv_files.csv_scan(spark, f"{folder}/*.csv", line_breaks_in_fields=breaks).select("a").collect()


def test_times_of_one_digit_parse_and_trailing_breaks_do_not(spark):
    rows = [("2018-1-1 1:1:1",), ("2018-01-01 01:01:01\n",), ("2018-02-30 00:00:00",), ("2018-01-01",)]
    got = spark.createDataFrame(rows, "t string").select(expressions.parse_timestamp(F.col("t")).alias("t")).collect()
    assert [str(r["t"]) for r in got] == ["2018-01-01 01:01:01", "None", "None", "None"]


def test_an_append_leaves_other_models_usable(spark, tmp_path):
    """A stock pipeline, whose forest keeps its training summary, scores after a load as before."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    spark = spark.newSession()  # other tests may observe in theirs
    rows = spark.range(60).selectExpr("cast(id % 7 as double) a", "cast(id % 2 as int) y")
    stages = [VectorAssembler(inputCols=["a"], outputCol="v"), RandomForestClassifier(numTrees=2, featuresCol="v", labelCol="y")]
    store = tables.TableStore(spark, str(tmp_path / "store"))
    names = spark.createDataFrame([("casa", "home"), ("arte", "art")], list(schemas.CATEGORY_NAMES.columns))
    for enforce in (True, False):
        assert store.append(names if enforce else names.limit(0), "category_names", enforce) == (2 if enforce else 0)
        assert Pipeline(stages=stages).fit(rows).transform(rows).select("probability").collect()


def test_exported_inputs_are_compressed_files_of_bounded_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "ROWS_OF_A_FILE", 10)
    rows = [(i, f"c{i}", "01", "a\"b, c", "X") for i in range(35)]
    df = spark.createDataFrame(rows, schemas.TABLES["customers"].schema).coalesce(1)
    queries._export_csv(df, str(tmp_path), "customers")
    assert len(list(tmp_path.glob("*customers_dataset.csv/*.csv.gz"))) == 4
    assert sorted(csv_files.scan_dataset(spark, str(tmp_path), "customers").collect()) == sorted(df.collect())
