"""The hash tree against plain Python, on odd rows and sizes around the fanout."""

import hashlib
import os
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from conftest import SMALL
from orderlens.llm import manifest
from orderlens.llm.common import prepare
from orderlens.llm.positions import numbered, ranked

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, grp string, h int, pos int, path string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    values = [row[0], row[3], row[2], row[4], row[1]]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes):
    """(root, siblings of each node from its own level to the root)."""
    paths, members = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(i, min(i + 8, len(nodes))) for i in range(0, len(nodes), 8)]
        for run in runs:
            for j in run:
                for i in members[j]:
                    paths[i].append((j - run[0], [nodes[k] for k in run if k != j]))
        members = [[i for j in run for i in members[j]] for run in runs]
        nodes = [sha("".join(nodes[j] for j in run)) for run in runs]
    return nodes[0], paths


def expected(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    done, subroots = [], []
    for g in order:
        mine = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        root, paths = climb([leaf(r) for r in mine])
        subroots.append(root)
        done.append((mine, paths))
    root, upper = climb(subroots)
    out = []
    for (mine, paths), subroot, above in zip(done, subroots, upper):
        for row, path in zip(mine, paths):
            digest = sha("".join(h for _, s in path + above for h in s))
            changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[1] is not None
            text = "".join(c.lower() if "A" <= c <= "Z" else c for c in row[1]) if changed else row[1]
            at = leaf((row[0], text, *row[2:]))
            for slot, siblings in path + above:
                at = sha("".join(siblings[:slot] + [at] + siblings[slot:]))
            out.append((row[0], leaf(row), subroot, root, digest, at, at == root))
    return out


def result(docs):
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    text = F.when(hit, F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.col("text"))
    other = manifest.row_hash([text if c == "text" else F.col(c) for c in COLUMNS])
    found = manifest.merkle_manifest(docs, COLUMNS, "lang", "doc_id", carried={"h": F.when(hit, other)})
    up = manifest.fold(F.coalesce("h", "leaf"), F.col("path"))
    rows = found.select("doc_id", "leaf", "subroot", "root", manifest.proof_digest(F.col("path")), up, up == F.col("root"))
    return sorted(map(str, (tuple(r) for r in rows.collect())))


def test_odd_rows(spark):
    """Nulls in every column, empty and long texts, equal ids, repeated rows, clashing names."""
    prepare(spark)
    rows = [(i, f"Text {i} É", "en", "s", i) for i in range(75)]
    rows += [(i, "AB" * i, "de", None, None) for i in range(9)] + [(5, "Same", "fr", "s", 1)] * 11
    rows += [(None, None, None, None, None), (None, "X", None, "s", 2), (3, "", "é", "s", 0), (4, "Long " * 50_000, "", "s", 1)]
    rows += [(100 + i, "A", f"l{i}", "s", 1) for i in range(9)]
    docs = spark.createDataFrame([(*r, "g", 1, 2, "p") for r in rows], SCHEMA)
    assert result(docs) == sorted(map(str, expected(rows)))


def test_no_rows_and_one_row(spark):
    prepare(spark)
    one = spark.createDataFrame([(1, "A", None, "s", 1, "g", 1, 2, "p")], SCHEMA)
    assert result(one) == [str(r) for r in expected([(1, "A", None, "s", 1)])]
    assert result(one.limit(0)) == []


def test_places_split_a_group_of_equal_rows(spark):
    """One key with nearly all rows lies in several ranges and is still numbered without gaps."""
    prepare(spark)
    rows = spark.range(5000).selectExpr("if(id < 4900, 'hot', 'rest') g", "if(id % 2 = 0, 1, 2) k")
    found = ranked(numbered(rows, "test-rows"), "g", ["k", "rid"], "test-places")
    assert found.select(F.spark_partition_id()).distinct().count() > 2
    for group, n in (("hot", 4900), ("rest", 100)):
        got = found.where(F.col("g") == group).orderBy("pos").select("pos", "k", "n").collect()
        assert [r.pos for r in got] == list(range(n)) and {r.n for r in got} == {n}
        assert [r.k for r in got] == sorted(r.k for r in got)


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{os.path.join(SMALL, 'documents.parquet')}'")
    found = contract.queries()["op11_manifest"](spark, SMALL)
    want = con.execute(contract.oracle_sql()["op11_manifest"])
    assert [d[0] for d in want.description] == found.columns
    assert sorted(map(str, (tuple(r) for r in found.collect()))) == sorted(map(str, want.fetchall()))


@pytest.mark.parametrize("change", ["text", "source"])
def test_any_change_is_seen(spark, change):
    prepare(spark)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    other = manifest.row_hash([F.concat(c, F.lit("x")) if c == change else F.col(c) for c in COLUMNS])
    found = manifest.merkle_manifest(docs, COLUMNS, "lang", "doc_id", carried={"other": other})
    assert found.where(manifest.fold(F.col("other"), F.col("path")) == F.col("root")).count() == 0
    assert found.where(manifest.fold(F.col("leaf"), F.col("path")) != F.col("root")).count() == 0
