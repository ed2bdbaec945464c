import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlens.functions.quantiles import exact_quantiles
from orderlens.operators import profile, transform


def quantiles(spark, values, shares, accuracy=10_000, partitions=5):
    df = spark.createDataFrame([(float(v) if v is not None else None,) for v in values], "v double").repartition(partitions)
    found = exact_quantiles(df, ["v"], shares, accuracy).collect()
    return {r["share"]: r["value"] for r in found}


def test_interpolated_quantiles(spark):
    assert quantiles(spark, [1, 2, 3, 10, None], [0.01, 0.99]) == {0.01: pytest.approx(1.03), 0.99: pytest.approx(9.79)}


@pytest.mark.parametrize("kind", ["uniform", "ties", "heavy", "hot"])
def test_quantiles_beyond_the_sketch_size_are_exact(spark, kind):
    rng = np.random.default_rng(3)
    values = {
        "uniform": rng.random(6000),
        "ties": rng.integers(0, 7, 6000),
        "heavy": np.exp(rng.normal(0, 4, 6000)),
        "hot": np.concatenate([np.zeros(2500), rng.random(3500)]),
    }[kind]
    shares = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    found = quantiles(spark, values.tolist(), shares, accuracy=100)
    for s in shares:
        assert found[s] == pytest.approx(np.quantile(values, s), rel=1e-12)


def scored(spark):
    rows = [(f"o{i}", s, int(s <= 3), d, d, d) for i, (s, d) in enumerate([(5, 1), (5, 2), (4, 3), (1, 4), (1, 50)])]
    return spark.createDataFrame(
        rows, "order_id string, review_score int, bad_score int, delivery_days int, estimated_delivery_diff int, processing_days int"
    ).withColumn("seller_disp_diff", F.col("delivery_days"))


def test_score_ratios_and_share(spark):
    ratios = [tuple(r) for r in profile.review_score_ratios(scored(spark)).collect()]
    assert ratios == [(5, 0.4), (4, 0.2), (1, 0.4)]
    assert profile.bad_score_share(scored(spark)).first()[0] == 40.0


def test_box_stats(spark):
    df = spark.createDataFrame([(1, v) for v in [1, 2, 3, 4, 5, 100, None]], "review_score int, d int")
    row = profile.box_stats(df, ["d"]).first()
    assert (row["n"], row["q1"], row["median"], row["q3"]) == (6, 2.25, 3.5, 4.75)
    assert (row["whisker_low"], row["whisker_high"], row["n_outliers"]) == (1.0, 5.0, 1)


def test_whisker_reaches_the_box(spark):
    df = spark.createDataFrame([(1, v) for v in [1, 2, 3, 100]], "review_score int, d int")
    row = profile.box_stats(df, ["d"]).first()
    assert (row["q3"], row["whisker_low"], row["whisker_high"], row["n_outliers"]) == (27.25, 1.0, 27.25, 1)


def test_histogram_counts_every_row_once(spark):
    values = [0.0, 0.5, 1.0, 1.0, 10.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    rows = profile.histogram(df, {"v": 10}).orderBy("bin").collect()
    assert [r["n"] for r in rows] == np.histogram(values, 10)[0].tolist()
    flat = profile.histogram(spark.createDataFrame([(2.0,), (2.0,)], "v double"), {"v": 4}).orderBy("bin").collect()
    assert [r["n"] for r in flat] == np.histogram([2.0, 2.0], 4)[0].tolist()


def test_tail_mix_follows_each_comparison(spark):
    rows = {}
    for r in profile.tail_score_mix(scored(spark)).collect():
        rows.setdefault(r["bound_name"], {})[r["review_score"]] = r["n"]
    assert rows["upper_delivery"] == {1: 1} and sum(rows["upper_seller"].values()) == 4
    other = profile.tail_score_mix(scored(spark), {"upper_seller": ">="}).where("bound_name = 'upper_seller'")
    assert [r["n"] for r in other.collect()] == [1]


def test_correlation(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3))
    x[:, 1] += x[:, 0]
    df = spark.createDataFrame([(*map(float, r), 7.0) for r in x], "a double, b double, c double, fixed double")
    found = {(r[0], r[1]): r[2] for r in profile.correlation_matrix(df).collect()}
    expected = np.corrcoef(x.T)
    for i, a in enumerate("abc"):
        for j, b in enumerate("abc"):
            assert found[a, b] == pytest.approx(expected[i, j])
    assert found["a", "fixed"] is None


def test_describe(spark):
    df = spark.createDataFrame([(v, None) for v in [1, 2, 3, 10]] + [(None, None)], "a int, empty int")
    rows = {r["column_name"]: r for r in profile.describe_numeric(df, ["a", "empty"]).collect()}
    a = rows["a"]
    assert (a["n"], a["mean"], a["p25"], a["p50"], a["p75"], a["maximum"]) == (4, 4.0, 1.75, 2.5, 4.75, 10.0)
    assert a["std"] == pytest.approx(np.std([1, 2, 3, 10], ddof=1))
    assert rows["empty"]["n"] == 0 and rows["empty"]["p50"] is None


def test_counts(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", None)], "order_id string, v int")
    assert profile.duplicate_count(df).first()[0] == 1
    assert {r[0]: r[1] for r in profile.null_counts(df).collect()} == {"order_id": 0, "v": 2}
    assert [tuple(r) for r in profile.feature_view_grain(df).orderBy("rows_per_order").collect()] == [(1, 1), (2, 1)]
    assert [r["data_type"] for r in profile.shape_and_types(df).orderBy("position").collect()] == ["string", "int"]


def test_clip_keeps_nulls_and_is_idempotent(spark):
    df = spark.createDataFrame([(None, 1, 5, -9), (7, 8, 9, 99)], "delivery_days int, estimated_delivery_diff int, processing_days int, seller_disp_diff int")
    bounds = dict.fromkeys(transform.BOUNDS, 5.0) | {"lower_seller": -1.0, "lower_estimated": 2.0}
    once = transform.clip_outliers(df, bounds)
    assert [tuple(r) for r in once.collect()] == [(None, 2.0, 5.0, -1.0), (5.0, 5.0, 5.0, 5.0)]
    assert transform.clip_outliers(once, bounds).collect() == once.collect()


def test_quantiles_of_skewed_short_and_equal_columns_through_brackets(spark):
    data = [(float(i % 1000), 5.0 if i % 10 else float(i), 7.0, float(i) if i < 3 else None, None) for i in range(3000)]
    names = ["even", "skewed", "equal", "short", "none"]
    df = spark.createDataFrame(data, ", ".join(f"{c} double" for c in names))
    shares = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]
    for accuracy in (100, 10_000):
        got = {(r["column_name"], r["share"]): r["value"] for r in exact_quantiles(df, names, shares, accuracy).collect()}
        assert {c for c, _ in got} == set(names) - {"none"}
        for (column, share), value in got.items():
            known = [row[names.index(column)] for row in data if row[names.index(column)] is not None]
            assert value == pytest.approx(float(np.quantile(known, share)))


def test_quantiles_are_refined_until_few_values_are_left(spark, monkeypatch):
    """With brackets of at most three values, whatever the spread, hot values and the sketch's error."""
    import numpy as np

    from orderlens.functions import quantiles

    rng = np.random.default_rng(8)
    n = 4000
    data = {
        "even": rng.random(n),
        "tails": np.exp(rng.normal(0, 60, n)) * rng.choice([-1, 1], n),
        "hot": np.where(rng.random(n) < 0.4, 7.0, rng.integers(0, 30, n)),
        "two": np.where(np.arange(n) < n // 2, -1.0, 1.0),
    }
    rows = [tuple(None if (i + k) % 50 == 0 and k else float(v[i]) for k, v in enumerate(data.values())) for i in range(n)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in data)).withColumn("none", F.lit(None).cast("double"))
    shares = [0.0, 0.01, 0.25, 0.5, 0.3333, 0.99, 1.0]
    brought = []
    plain = quantiles._row
    monkeypatch.setattr(quantiles, "MOST_VALUES", 3)
    monkeypatch.setattr(quantiles, "_row", lambda d, a: brought.append(len(a)) or plain(d, a))
    for accuracy in (100, 30):
        got = {(r[0], r[1]): r[2] for r in quantiles.exact_quantiles(df, [*data, "none"], shares, accuracy).collect()}
        assert len(got) == 4 * len(shares)
        for k, (c, _) in enumerate(data.items()):
            kept = [r[k] for r in rows if r[k] is not None]
            for s in shares:
                assert got[c, s] == pytest.approx(float(np.quantile(kept, s)), rel=1e-12, abs=1e-12)
    assert len(brought) < 40  # passes over the rows


def test_correlation_of_rows_with_nulls(spark):
    """Each pair uses the rows that have both values, as the independent engine does."""
    import duckdb

    rng = np.random.default_rng(2)
    names = ["a", "b", "c", "same", "none"]
    rows = []
    for i in range(300):
        a = float(rng.normal(1e6, 3))
        values = [a, a * 2 + float(rng.normal()), float(rng.normal()), 4.0]
        rows.append((*[None if (i * 7 + k) % 5 == 0 else v for k, v in enumerate(values)], None))
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names))
    got = {(r[0], r[1]): r[2] for r in profile.correlation_matrix(df.repartition(6), names).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t (a DOUBLE, b DOUBLE, c DOUBLE, same DOUBLE, none DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?, ?, ?)", rows)
    for x in ["a", "b", "c"]:
        for y in ["a", "b", "c"]:
            assert got[x, y] == pytest.approx(con.execute(f"SELECT corr({x}, {y}) FROM t").fetchone()[0], abs=1e-9)
        assert got[x, "same"] is None and got["none", x] is None
    assert got["same", "same"] == 1.0 and got["none", "none"] is None
