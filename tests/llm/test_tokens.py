"""Token counts and packing against the tokenizer library itself."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SMALL
from orderlens.llm import packing, queries, tokens
from orderlens.llm.common import prepare

FILES = queries.vocabulary_files()
ODD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "it's 'tis  don't\n\n x", "tab\there", "\n lead", "trail \n",
    "zero <|endoftext|> special", "<|endoftext|>", "naïve Ünï çé", "日本語 テキスト 1234", "emoji 😀 👩‍👩‍👧 x",
    "a b  c", "mix\x1cfs \x85nel", "123 456,789.0 $%^ &*()", "x" * 5000, "word " * 3000, "same", "same",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILES["vocabulary"])


@pytest.fixture(scope="module")
def odd(spark):
    prepare(spark)
    rows = [(i if i % 7 else None, t, "clash", 1) for i, t in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, sequence_id int")


def test_counts_of_odd_texts(spark, odd, library):
    got = sorted(map(str, tokens.token_counts(odd, limit=4, table_size=3, **FILES).collect()))
    want = []
    for i, t in enumerate(ODD):
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append(f"Row(doc_id={i if i % 7 else None}, n_bytes={len((t or '').encode())}, n_tokens={n}, over_limit={n > 4})")
    assert got == sorted(want)


def test_plain_characters_agree_in_both_libraries(library):
    enc = tokens.encoder(**FILES)
    for c in map(chr, range(0x250)):
        for part in (f" a{c}b", f" {c}{c}1", f"{c}", f" 'x{c}"):
            assert enc.ids(part) == library.encode(part, add_special_tokens=False).ids


def test_counts_of_the_given_table(spark, library):
    got = {r["doc_id"]: r["n_tokens"] for r in queries.op1_token_counts(spark, SMALL).collect()}
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    assert got == {r["doc_id"]: len(library.encode(r["text"] or "", add_special_tokens=False).ids) for r in rows}


def check_packing(docs, pieces, library, capacity):
    want = defaultdict(list)
    for doc_id, text in docs:
        want[doc_id].append(library.encode(text or "", add_special_tokens=False).ids + [0])
    spans = defaultdict(list)
    for p in pieces:
        assert 0 < p["length"] <= capacity
        spans[p["sequence_id"]].append((p["offset"], p["length"]))
    for parts in spans.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
    assert set(by_doc) == set(want)
    for doc_id, versions in want.items():
        if len(versions) > 1:  # several rows without a name: only the tokens can be compared
            assert sum(p["length"] for p in by_doc[doc_id]) == sum(map(len, versions))
            continue
        ids, at = versions[0], 0
        for p in sorted(by_doc[doc_id], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            part = np.array(ids[at : at + p["length"]], dtype="<u4").tobytes()
            assert p["ids_crc32"] == zlib.crc32(part)
            at += p["length"]
        assert at == len(ids)
    return len(spans), sum(len(v) for vs in want.values() for v in vs)


def test_packing_of_odd_texts(spark, odd, library):
    got = packing.pack(odd.coalesce(1), capacity=100, block_tokens=500, **FILES).collect()
    check_packing([(i if i % 7 else None, t) for i, t in enumerate(ODD)], got, library, 100)


def test_packing_of_the_given_table(spark, library):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    n, total = check_packing(docs, queries.op10_packing(spark, SMALL).collect(), library, 1024)
    assert n * 1024 - total < 1024 * 8  # less than one sequence per task


def test_assignment_balances_cost():
    lengths = np.array([700, 500, 400, 300, 148])
    placed = packing.assign(lengths, 1024, 1 / 1024)
    assert len({p[3] for p in placed}) == 2 and sum(p[2] for p in placed) == 2048
    assert [p[3] for p in placed[:2]] == [0, 1]  # the two longest lie apart


def test_no_rows(spark, odd):
    none = odd.where(F.lit(False))
    assert tokens.token_counts(none, **FILES).count() == 0
    assert packing.pack(none, **FILES).count() == 0
