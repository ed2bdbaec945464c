"""Hand-made relations: one delivered order with one item and one review, varied per test."""

from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from orderlens import schemas

BOUGHT = datetime(2018, 1, 1, 10, 0)


def at(hours):
    return None if hours is None else BOUGHT + timedelta(hours=hours)


def order(order_id="o1", status="delivered", approved=1, carrier=24, delivered=100, estimated=200, bought=0):
    return (order_id, "c1", status, at(bought), at(approved), at(carrier), at(delivered), at(estimated))


def item(order_id="o1", number=1, product="p1", price="10.00", freight="2.00", limit=48):
    money = None if price is None else Decimal(price)
    return (order_id, number, product, "s1", at(limit), money, Decimal(freight))


def product(product_id="p1", category="toys", name=10, desc=20, photos=1, weight=500, length=10, height=10, width=10):
    return (product_id, category, name, desc, photos, weight, length, height, width)


def review(order_id="o1", review_id="r1", score=5, answered=300):
    return (review_id, order_id, score, "", "", at(250), at(answered))


def relations(spark, orders=None, items=None, products=None, reviews=None, names=(("toys", "toys_en"),)):
    rows = {
        "customers": [("c1", "u1", "01234", "rio", "RJ")],
        "products": products or [product()],
        "orders": orders or [order()],
        "reviews": reviews or [review()],
        "order_items": items or [item()],
        "category_names": list(names),
    }
    return schemas.Relations(
        **{t: spark.createDataFrame(r, schemas.TABLES[t].schema).select(F.col("*")) for t, r in rows.items()}
    )
