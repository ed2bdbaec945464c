"""Plans and results when one key holds a third of the rows."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from orderlens.operators import cleaning
from orderlens.plans import feature_view as fv
from orderlens.sources import star_schema
from shop import item, order, product, relations, review


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def skewed(spark):
    """300 orders; one product is in a third of them, one order has a third of items and reviews."""
    rng = random.Random(5)
    ids = [f"o{i}" for i in range(300)]
    orders = [order(o, delivered=rng.randint(50, 400)) for o in ids]
    items = [item(o, 1, "hot" if i % 3 == 0 else f"p{i % 50}", f"{rng.randint(1, 99)}.00") for i, o in enumerate(ids)]
    items += [item("o7", n, f"p{n % 50}", f"{n % 90 + 1}.50") for n in range(2, 150)]
    reviews = [review(o, f"r{i}", rng.randint(1, 5), 300 + i) for i, o in enumerate(ids)]
    reviews += [review("o7", f"x{i}", i % 5 + 1, 300 + i) for i in range(150)]
    products = [product("hot"), *[product(f"p{i}", "art") for i in range(50)]]
    return relations(spark, orders, items, products, reviews)


def test_skewed_keys_give_the_same_rows_however_joins_run(spark):
    tables = skewed(spark)
    expected = sorted(map(str, fv.feature_view(tables).collect()))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1b",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        view = fv.feature_view(tables)
        assert sorted(map(str, view.collect())) == expected
        assert "skew=true" in plan_of(view)
        a, b = cleaning.clean_data(view), cleaning.cleaned_orders(tables)
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
        assert a.count() == 300
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_plans_have_no_cross_join_and_limit_before_the_exchange(spark):
    tables = star_schema.relations(spark, SMALL)
    for df in (fv.feature_view(tables), cleaning.cleaned_orders(tables)):
        plan = plan_of(df)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert plan_of(cleaning.latest_reviews(tables.reviews)).count("WindowGroupLimit") == 2


def test_scans_read_only_what_is_used(spark):
    tables = star_schema.relations(spark, SMALL)
    plan = plan_of(fv.feature_view(tables).select("order_id", "weight_g"))
    assert "l_quantity" not in plan and "documents" not in plan
    assert "PushedFilters: [IsNotNull(o_orderkey)" in plan or "DataFilters: [" in plan


def test_result_does_not_depend_on_partitions(spark):
    tables = skewed(spark)
    view = fv.feature_view(tables)
    few, many = (cleaning.clean_data(view.repartition(n)) for n in (1, 13))
    assert few.exceptAll(many).count() == 0 and few.count() == many.count()
    assert few.agg(F.countDistinct("order_id")).first()[0] == 300


def test_a_cluster_needs_a_shared_folder(spark):
    from types import SimpleNamespace

    from orderlens.session import shared_folder

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    conf = SimpleNamespace(get=lambda key, *default: default[0] if default else "/somewhere")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(SimpleNamespace(sparkContext=context, conf=conf))
    context.master = "local[4]"
    assert shared_folder(SimpleNamespace(sparkContext=context, conf=conf)) == "/somewhere/_scratch"
