"""Splittable reading of quoted line breaks against Spark's own reader of whole files."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from orderlens.sources.csv_files import csv_scan
from orderlens.sources.quoted_records import quoted_records

NAMES = ["id", "text", "note"]


@pytest.fixture
def small_splits(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.openCostInBytes", "1")

    def size(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))

    yield size
    for k, v in kept.items():
        spark.conf.set(k, v)


def write(path, n, seed, end="\n"):
    rng = random.Random(seed)
    parts = ["plain", "a,b", 'say "x"', "two\nlines", '"', "\n", "", "é", '""\n""', "long " * 40, "line\n" * 30]
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f, lineterminator=end)
        out.writerow(NAMES)
        for i in range(n):
            out.writerow([i, "".join(rng.choices(parts, k=rng.randint(1, 3))), rng.choice(parts)])


def whole(spark, path):
    return spark.read.csv(str(path), header=True, multiLine=True, quote='"', escape='"', mode="FAILFAST")


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("size", [37, 200, 1500])
def test_equals_the_reader_of_whole_files(spark, tmp_path, small_splits, size):
    """Breaks and doubled quotes lie across borders; with the smallest splits whole splits lie inside a field."""
    for k in range(3):
        write(tmp_path / f"p{k}.csv", 60, k)
    want = rows(whole(spark, tmp_path))
    assert len(want) == 180
    small_splits(size)
    found = quoted_records(spark, str(tmp_path))
    assert found.columns == NAMES and rows(found) == want


def test_a_file_is_read_by_several_tasks(spark, tmp_path, small_splits):
    write(tmp_path / "p.csv", 400, 9)
    assert whole(spark, tmp_path).rdd.getNumPartitions() == 1
    small_splits(4000)
    found = quoted_records(spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()
    assert len(found) > 5 and sum(r["count"] for r in found) == 400


def test_line_ends_of_two_characters_and_empty_lines(spark, tmp_path, small_splits):
    text = '﻿id,text,note\r\n1,"a\r\nb",\r\n\r\n2,"c""\r\n",""\r\n3,d,e'
    (tmp_path / "p.csv").write_bytes(text.encode())
    want = rows(whole(spark, tmp_path))
    small_splits(5)
    found = quoted_records(spark, str(tmp_path))
    assert rows(found) == want and len(want) == 3
    assert [r.text for r in found.orderBy("id").collect()] == ["a\nb", 'c"\n', "d"]


def test_faults_are_told(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,text\n1,x\n")
    (tmp_path / "b.csv").write_text("text,id\nx,1\n")
    with pytest.raises(ValueError, match="differ"):
        quoted_records(spark, str(tmp_path))
    (tmp_path / "b.csv").write_text('id,text\n1,"x\n",3\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        quoted_records(spark, str(tmp_path)).collect()
    (tmp_path / "b.csv").write_text("id,text\n")
    assert quoted_records(spark, str(tmp_path / "b.csv")).collect() == []
    assert csv_scan(spark, str(tmp_path / "a.csv"), line_breaks_in_fields=True).collect() == [("1", "x")]
