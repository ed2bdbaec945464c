from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from orderlens.functions import expressions as E
from orderlens.operators import cleaning
from orderlens.plans import feature_view as fv
from shop import BOUGHT, item, order, product, relations, review


def one(view):
    rows = view.collect()
    assert len(rows) == 1
    return rows[0]


def view_of(spark, **tables):
    return fv.feature_view(relations(spark, **tables))


def test_day_difference_truncates_toward_zero(spark):
    rows = [(i, BOUGHT + timedelta(hours=h), BOUGHT) for i, h in enumerate([-36, -23, 23, 60])]
    df = spark.createDataFrame(rows, "i int, a timestamp_ntz, b timestamp_ntz")
    got = df.select(E.days_between(F.col("a"), F.col("b")).alias("d"), "i").orderBy("i").collect()
    assert [r["d"] for r in got] == [-1, 0, 0, 2]


def test_lateness_by_date_and_by_time(spark):
    # same day, 23:00 against 00:00: not late; 01:00 against 23:00 of the day before: late by 0 days
    same_day = one(view_of(spark, orders=[order(delivered=37, estimated=14)]))
    assert (same_day["is_delivery_late"], same_day["estimated_delivery_diff"]) == (0, 0)
    early = one(view_of(spark, orders=[order(delivered=13, estimated=0)]))  # 23:00 and 10:00 of one day
    assert (early["is_delivery_late"], early["estimated_delivery_diff"]) == (0, 0)
    next_day = one(view_of(spark, orders=[order(delivered=15, estimated=13)]))  # 01:00 and 23:00
    assert (next_day["is_delivery_late"], next_day["estimated_delivery_diff"]) == (1, 0)
    seller = one(view_of(spark, orders=[order(carrier=49)], items=[item(limit=48)]))
    assert (seller["is_seller_late"], seller["seller_disp_diff"]) == (1, 0)


def test_unknown_time_is_not_late(spark):
    row = one(view_of(spark, orders=[order(carrier=None)]))
    assert row["is_seller_late"] == 0 and row["seller_disp_diff"] is None
    assert cleaning.clean_data(view_of(spark, orders=[order(carrier=None)])).count() == 0


def test_most_important_product(spark):
    both = [product("A"), product("B")]

    def chosen(*items):
        tables = relations(spark, items=list(items), products=both)
        return one(fv.order_items_agg(tables.order_items))["most_imp_product_id"]

    assert chosen(item(number=1, product="A"), item(number=2, product="B")) == "A"
    assert chosen(item(number=2, product="A"), item(number=1, product="B")) == "B"
    assert chosen(item(number=1, product="B"), item(number=1, product="A")) == "A"
    assert chosen(item(number=1, product="A"), item(number=2, product="B", price="11.00")) == "B"
    assert chosen(item(number=1, product="A", price=None), item(number=2, product="B", price="0.01")) == "B"


def test_item_count_is_the_highest_number(spark):
    row = one(view_of(spark, items=[item(number=1), item(number=3)]))
    assert row["num_items"] == 3 and float(row["total_price"]) == 20.0 and float(row["total_freight"]) == 4.0


@pytest.mark.parametrize(
    "freight, price, ratio", [("1.00", "3.00", 0.3333), ("0.01", "200.00", 0.0001), ("2.00", "0.00", None)]
)
def test_freight_ratio(spark, freight, price, ratio):
    row = one(view_of(spark, items=[item(price=price, freight=freight)]))
    assert (row["freight_ratio"] is None) if ratio is None else float(row["freight_ratio"]) == ratio


def test_zero_price_row_is_dropped_by_cleaning(spark):
    assert cleaning.clean_data(view_of(spark, items=[item(price="0.00")])).count() == 0


@pytest.mark.parametrize(
    "size, litres", [((105, 16, 22), 36.96), ((5, 1, 1), 0.01), ((10, 10, None), 0.0), ((60000, 60000, 60000), 2.16e11)]
)
def test_volume(spark, size, litres):
    length, height, width = size
    row = one(view_of(spark, products=[product(length=length, height=height, width=width)]))
    assert float(row["volume_l"]) == litres


def test_category_fallback(spark):
    assert one(view_of(spark))["category"] == "toys_en"
    assert one(view_of(spark, products=[product(category="art")]))["category"] == "art"
    assert one(view_of(spark, products=[product(category="unknown")]))["category"] == "unknown"


def test_missing_details_ignore_dimensions(spark):
    assert one(view_of(spark, products=[product(width=None)]))["has_missing_details"] == 0
    row = one(view_of(spark, products=[product(photos=None)]))
    assert row["has_missing_details"] == 1 and row["prod_photos"] == 0


def test_only_delivered_orders_with_items_and_reviews(spark):
    orders = [order("o1"), order("o2", status="shipped"), order("o3", delivered=None), order("o4")]
    view = view_of(spark, orders=orders, items=[item(o) for o in ("o1", "o2", "o3")], reviews=[review("o1"), review("o4")])
    assert [r["order_id"] for r in view.collect()] == ["o1"]


def test_reviews_fan_out_and_last_one_is_kept(spark):
    reviews = [review(review_id="a", score=1, answered=300), review(review_id="b", score=5, answered=400)]
    view = view_of(spark, reviews=reviews)
    assert view.count() == 2
    assert one(cleaning.clean_data(view))["review_score"] == 5


def test_nulls_go_before_duplicates(spark):
    reviews = [review(review_id="a", score=1, answered=300), review(review_id="b", score=None, answered=400)]
    tables = relations(spark, reviews=reviews)
    assert one(cleaning.clean_data(fv.feature_view(tables)))["review_score"] == 1
    assert one(cleaning.cleaned_orders(tables))["review_score"] == 1
    assert one(cleaning.dedup_keep_last(fv.feature_view(tables)))["review_score"] is None


def test_negative_processing_becomes_zero(spark):
    tables = relations(spark, orders=[order(approved=80, carrier=24)])
    assert one(fv.feature_view(tables))["processing_days"] == -2
    assert one(cleaning.clean_data(fv.feature_view(tables)))["processing_days"] == 0


def test_view_columns_and_registered_view(spark):
    tables = relations(spark)
    view = fv.create_feature_view(tables)
    assert len(view.columns) == 22 and "order_id" in view.columns
    assert fv.view_scan(spark).count() == 1
    assert fv.view_scan(spark, 0).count() == 0


def test_timestamps_are_read_strictly(spark):
    df = spark.createDataFrame([("2017-10-02 10:56:33",), ("2017-10-02",), ("bad",), (None,), ("2017-02-30 00:00:00",)], "t string")
    got = [r[0] for r in df.select(E.parse_timestamp(F.col("t"))).collect()]
    assert got == [datetime(2017, 10, 2, 10, 56, 33), None, None, None, None]


def test_text_is_tidied(spark):
    df = spark.createDataFrame([("\n a\rb \t",), (None,), (" x　",)], "t string")
    assert [r[0] for r in df.select(E.tidy_text(F.col("t"))).collect()] == ["a b", "", "x"]
