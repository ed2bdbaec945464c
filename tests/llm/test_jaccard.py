"""The near-duplicate operator against a comparison of all pairs on the smallest table."""

from __future__ import annotations

import itertools
import random
import re

import numpy as np

from orderlens.llm import jaccard, queries

DATA = "/root/testdata/sf0.001"


def shingles(text: str | None) -> set:
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def all_pairs(docs: list[tuple[int, str | None]]) -> dict[int, tuple[int, int]]:
    """(set size, component) of each document, by comparing all of them."""
    sets = {d: shingles(text) for d, text in docs}
    label = {d: d for d in sets}

    def root(d: int) -> int:
        while label[d] != d:
            d = label[d]
        return d

    for (a, x), (b, y) in itertools.combinations(sorted(sets.items()), 2):
        if x and y and 100 * len(x & y) >= 80 * len(x | y):
            low, high = sorted((root(a), root(b)))
            label[high] = low
    return {d: (len(x), root(d)) for d, x in sets.items()}


def test_components_are_those_of_all_pairs(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    expected = all_pairs([tuple(r) for r in docs])
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in queries.op7_jaccard(spark, DATA).collect()}
    assert found == expected
    assert len({c for _, c in expected.values()}) < len(expected)


def test_a_hot_group_and_a_common_passage_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_TOKENS", 1500)  # the group of 150 copies takes several blocks
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    base, passage = rng.choices(words, k=60), rng.choices(words, k=40)
    docs = []
    for i in range(150):  # edited copies, some of them out of reach of all others
        copy = list(base)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(60)] = f"x{rng.random()}"
        docs.append((i, " ".join(copy)))
    for i in range(150, 270):  # a common passage that fills a half to nearly all of a text
        docs.append((i, " ".join(passage + [f"y{rng.random()}" for _ in range(rng.randint(1, 40))])))
    docs += [(270, None), (271, ""), (272, "one two"), (273, "One  two"), (274, docs[0][1])]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(table).collect()}
    assert found == all_pairs(docs)
    assert len({c for d, (_, c) in found.items() if d < 150}) > 1 and found[273][1] == 272


def test_sorting_by_owner_keeps_the_order_within():
    rng = np.random.default_rng(7)
    for most in (3, 1 << 20):  # one that fits 16 bits and one that does not
        owner = np.append(rng.integers(0, most, 5000), most)
        order = rng.permutation(len(owner))
        again = jaccard.by_owner(order, owner)
        assert again.tolist() == sorted(order.tolist(), key=lambda i: owner[i])
    assert jaccard.by_owner(np.zeros(0, np.int64), np.zeros(0, np.int64)).tolist() == []
