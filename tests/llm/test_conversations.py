"""Conversation repair against a search over all edits."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

import __spark_entry__ as contract
from conftest import SMALL
from orderlens.llm import conversations
from orderlens.llm import hirschberg as H
from orderlens.llm.common import prepare


def search(turns):
    """(cost, least audit, repaired turns) of (role, text, fault), by best-first search."""
    heap, best, found = [(0, "", 0, "")], None, []
    while heap:
        cost, audit, i, roles = heapq.heappop(heap)
        if best is not None and cost > best:
            break
        if i == len(turns) and re.fullmatch("(s?(ua)+)?", roles):
            best = cost
            found.append((audit, roles))
            continue
        options = [(cost + 3, audit + "I", i, roles + x) for x in "ua"]
        if i < len(turns):
            role, _, fault = turns[i]
            options.append((cost + 4, audit + "D", i + 1, roles))
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                options += [(cost + 3 + more, audit + "R", i + 1, roles + x) for x in "ua"]
                options.append((cost + more, audit + "K", i + 1, roles + (role[:1] or " ")))
        for option in options:
            if re.fullmatch("s?(ua)*u?", option[3]):
                heapq.heappush(heap, option)
    audit, roles = min(found)
    out, i, j = [], 0, 0
    for letter in audit:
        if letter == "D":
            i += 1
            continue
        name = {"u": "user", "a": "assistant"}.get(roles[j])
        out.append((name, "") if letter == "I" else (turns[i][0] if letter == "K" else name, turns[i][1]))
        i, j = i + (letter != "I"), j + 1
    return best, audit, out


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        ink = re.sub("[\x20\x09-\x0d]", "", text)
        fault = "blank" if not ink else "duplicate" if (role, text) in seen else None
        out.append((role, text, fault or (None if ink[-1] in ".!?" else "truncated")))
        seen.add((role, text))
    return out


def expected(rows):
    every, kept = set(), {}
    for conv, turn, role, text in rows:
        every.add(conv)
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        kept.setdefault(conv, []).extend([(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1))
    out = []
    for conv in every:
        mine = kept.get(conv, [])
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        turns = {r[0] for r in mine if r[0] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        marked = faults(mine)
        n = [sum(f == x for *_, f in marked) for x in ("blank", "duplicate", "truncated")]
        firsts = [r[:1] for r, _, _ in marked]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:]))
        cost, audit, repaired = search(marked)
        lines = "\n".join(f"{r}:{t}" for r, t in repaired)
        out.append((conv, gaps, *n, illegal, cost, audit, hashlib.sha256(lines.encode()).hexdigest()))
    return out


def test_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = contract.queries()["op12_conversations"](spark, SMALL)
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, expected(rows)))


def odd_rows():
    rng = random.Random(5)
    rows = [(1, t, None, None) for t in range(4)] + [(None, t, "user", "Hi.") for t in (None, 0, 1, 1)]
    rows += [(2, None, "system", "a?"), (2, None, "", ""), (3, 10**15, "user", "x" * 200_000), (3, -5, "assistant", "y. \n")]
    rows += [(4, t, "user", "same.") for t in (1, 1, 2, 2)] + [(5, 7, "tool", "é!")] + [(6, 3, "user", "Q.")] * 4
    for conv in range(7, 60):
        for t in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "ärger"])
            rows.append((conv, t - 2, role, rng.choice(["a.", "b", "c! ", "", " \t", f"{t}?"])))
    return rows


@pytest.mark.parametrize("block", [conversations.BLOCK, 2])
def test_odd_rows(spark, tmp_path_factory, block, monkeypatch):
    """Nulls everywhere, one long text, ties, repeats, clashing names; with blocks of two rows, five levels of them."""
    prepare(spark)
    folder = str(tmp_path_factory.mktemp("odd"))
    rows = odd_rows()
    given = spark.createDataFrame(
        [(*r, "k", 1, 2, "d") for r in rows],
        "conv_id long, turn long, role string, text string, c string, pos int, rid long, digest string",
    )
    given.write.parquet(f"{folder}/conversations.parquet")
    whole = conversations.repair
    monkeypatch.setattr(conversations, "repair", lambda damaged: whole(damaged, block))
    got = contract.queries()["op12_conversations"](spark, folder)
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, expected(rows)))


def test_empty_table(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("none"))
    spark.read.parquet(f"{SMALL}/conversations.parquet").limit(0).write.parquet(f"{folder}/conversations.parquet")
    assert contract.queries()["op12_conversations"](spark, folder).collect() == []


def test_blocks_do_not_change_a_long_conversation():
    rng = random.Random(2)
    codes = [rng.randrange(12) for _ in range(3000)]
    whole = H.crossings(codes, 0, None)
    for size in (7, 100):
        stretches = [codes[i : i + size] for i in range(0, len(codes), size)]
        ends = H.crossings([H.product(s) for s in stretches], 0, None)
        parts = [H.crossings(s, b, e) for s, b, e in zip(stretches, [0, *ends], ends)]
        assert [x for part in parts for x in part] == whole
