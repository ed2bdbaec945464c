"""Secrets in texts, found through a trigram index; DataFrame functions only.

From each rule's regular expression a Boolean query over trigrams is derived: an OR of ANDs of
trigrams that any match must hold.  The index has postings (trigram, document) for the trigrams
that some rule asks for, in lower case.  Intersecting postings gives each rule's candidates, and
only those are searched with the expression.  A rule without mandatory trigrams searches all texts.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from re import _constants as op
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import texts
from orderlens.session import small_table


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The base kinds first, in the order in which spans of equal start are listed.
BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]+", 0, 16),
)
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{20,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[sr]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("bearer", r"(?i)bearer\x20+[A-Za-z0-9._~+/-]{16,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE + MORE

# Alternatives of literal text followed at once in a pattern; beyond that nothing is derived.
MOST_ALTERNATIVES = 64
PART = 256  # entries of an array that are gathered by appending
BLOCK = 1024  # code points of a text that are cut at together


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """An OR of ANDs of lower-case trigrams that every match holds; [frozenset()] if none is mandatory."""

    def join(a: list[frozenset[str]], b: list[frozenset[str]]) -> list[frozenset[str]]:
        if len(a) * len(b) > MOST_ALTERNATIVES:
            return min(a, b, key=lambda q: (frozenset() in q, len(q)))
        return list(dict.fromkeys(x | y for x in a for y in b))

    def grams(literals: list[str]) -> list[frozenset[str]]:
        return list(dict.fromkeys(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in literals))

    def exact(item) -> list[str] | None:
        """All texts an element can match, if they are few."""
        kind, value = item
        if kind is op.LITERAL:
            return [chr(value).lower()]
        if kind is op.IN and all(k in (op.LITERAL, op.RANGE) for k, _ in value):
            codes = [c for k, v in value for c in ([v] if k is op.LITERAL else range(v[0], v[1] + 1))]
            return sorted({chr(c).lower() for c in codes}) if len(codes) <= 8 else None
        if kind is op.SUBPATTERN:
            return exact_all(value[3])
        if kind is op.BRANCH:
            found = [exact_all(x) for x in value[1]]
            return None if None in found else [s for x in found for s in x]
        if kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[1] == 1:
            found = exact_all(value[2])
            return None if found is None else [""] * (value[0] == 0) + found
        return None

    def exact_all(items) -> list[str] | None:
        out = [""]
        for item in items:
            more = exact(item)
            if more is None or len(out) * len(more) > MOST_ALTERNATIVES:
                return None
            out = [a + b for a in out for b in more]
        return out

    def query(items) -> list[frozenset[str]]:
        found, run = [frozenset()], [""]
        for item in items:
            more = exact(item)
            if more is not None and len(run) * len(more) <= MOST_ALTERNATIVES:
                run = [a + b for a in run for b in more]
                continue
            found, run = join(found, grams(run)), more or [""]
            kind, value = item
            if more is None and kind is op.SUBPATTERN:
                found = join(found, query(value[3]))
            elif more is None and kind is op.BRANCH:
                found = join(found, [q for x in value[1] for q in query(x)])
            elif more is None and kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[0] > 0:
                found = join(found, query(value[2]))
        return join(found, grams(run))

    found = query(_parser.parse(pattern))
    return [c for c in found if not any(other < c for other in found)]


def postings(docs: DataFrame, grams: list[str]) -> DataFrame:
    """The index: one (gram, doc_id) for each of the grams that the lower-cased text holds."""
    asked = F.array(*map(F.lit, grams))
    held = F.transform(F.array(F.lower("text")), lambda t: F.filter(asked, lambda g: t.contains(g)))[0]
    return docs.where(F.col("text").isNotNull()).select("doc_id", F.explode(held).alias("gram"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(doc_id, rules): for each document the numbers of the rules whose query its postings meet."""
    queries = {i: q for i, r in enumerate(rules) if frozenset() not in (q := trigram_query(r.pattern))}
    rows = [(i, k, g, len(c)) for i, q in queries.items() for k, c in enumerate(q) for g in sorted(c)]
    clauses = small_table(docs.sparkSession, rows, "rule int, clause int, gram string, need int")
    grams = sorted({r[2] for r in rows})
    return (
        postings(docs, grams)
        .join(F.broadcast(clauses), "gram")  # a few rows for each rule
        .groupBy("doc_id", "rule", "clause", "need")
        .agg(F.collect_set("gram").alias("grams"))  # at most the grams of one clause
        .where(F.size("grams") == F.col("need"))
        .groupBy("doc_id")
        .agg(F.collect_set("rule").alias("rules"))
    )


def java(pattern: str) -> str:
    """The pattern so that flags at its start hold for it alone."""
    return re.sub(r"^\(\?i\)(.*)$", r"(?i:\1)", pattern, flags=re.S)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once."""
    return F.transform(F.array(value), use)[0]


def running(items: Column, kind: str, step: Callable[[Column, Column], Column]) -> Column:
    """(at, out) after ``step`` over the items, from at 0 and an empty array ``out`` of ``kind``.

    ``step`` gives (at, out) with at most one entry more.  Entries are gathered in parts of
    ``PART`` items, so the work grows with the items and not with their square.
    """
    none = F.array().cast(f"array<{kind}>")

    def over(whole: Column) -> Column:
        def part(acc: Column, i: Column) -> Column:
            start = F.struct(acc["at"].alias("at"), none.alias("out"))
            inner = F.aggregate(F.slice(whole, i * PART + 1, F.lit(PART)), start, step)
            return bound(inner, lambda x: F.struct(x["at"].alias("at"), F.concat(acc["outs"], F.array(x["out"])).alias("outs")))

        numbers = F.sequence(F.lit(0), F.floor((F.greatest(F.size(whole), F.lit(1)) - 1) / PART).cast("int"))
        start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{kind}>>").alias("outs"))
        return F.aggregate(numbers, start, part, lambda x: F.struct(x["at"].alias("at"), F.flatten(x["outs"]).alias("out")))

    return bound(items, over)


def rule_spans(text: Column, number: int, rule: Rule) -> Column:
    """Sorted array of (start, kind, end), in code points, of the rule's matches long enough.

    The text is cut into pieces that each end with a match or at the end of the text; places
    are sums of lengths of pieces.
    """
    # group 1 is the match; groups of the rule move up by one
    cutter = F.lit(f"(?s:.*?)({java(rule.pattern)}|\\z)")
    whole, match, held = (
        F.transform(F.regexp_extract_all(text, cutter, F.lit(i)), F.length) for i in (0, 1, rule.group + 1)
    )

    def step(acc: Column, z: Column) -> Column:
        end = acc["at"] + z["whole"]
        span = F.struct((end - z["match"]).alias("start"), F.lit(number).alias("kind"), end.alias("end"))
        keep = z["held"] >= rule.least
        return F.struct(end.alias("at"), F.when(keep, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    zipped = F.arrays_zip(whole.alias("whole"), match.alias("match"), held.alias("held"))
    return running(zipped, "struct<start:int,kind:int,end:int>", step)["out"]


def secret_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, text, spans, row) of every row; spans is a sorted array of (start, kind, end), row the input row.

    ``kind`` is the number of the rule; places are code points, ends exclusive.  A null text
    counts as empty and has no spans.  Rows keep their number: repeated rows and null ids are
    each searched.  An empty table gives no rows; other columns are ignored.
    """
    rows = texts(docs)
    found = candidates(rows, rules).select(F.col("doc_id").alias("cand_id"), "rules")
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.struct("*").alias("row"))
    joined = whole.join(found, F.col("doc_id").eqNullSafe(F.col("cand_id")), "left")
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")

    def spans(i: int, r: Rule) -> Column:
        if frozenset() in trigram_query(r.pattern):
            asked = F.col("text").rlike(java(r.pattern) if r.least == 1 else least_match(r))
        else:
            asked = F.array_contains("rules", F.lit(i))
        return F.when(asked, rule_spans(F.col("text"), i, r)).otherwise(none)

    every = F.concat(*[spans(i, r) for i, r in enumerate(rules)])
    return joined.select("doc_id", "text", "row", F.inline(F.array(F.struct(F.array_sort(every).alias("spans")))))


def least_match(rule: Rule) -> str:
    """A cheap necessary pattern: the shortest match that is kept, where the rule is one repeated class."""
    return rf"{java(rule.pattern)[:-1]}{{{rule.least}}}" if re.fullmatch(r"\[[^\]]+\]\+", rule.pattern) else java(rule.pattern)


def named(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """'kind:start:end', comma-joined."""
    names = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span, overlapping ones together, replaced by ``mark``."""

    def step(acc: Column, s: Column) -> Column:
        gap = F.struct(acc["at"].alias("start"), s["start"].alias("end"))
        out = F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.array(gap))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    def kept(blocks: Column, gap: Column) -> Column:
        """The text of a gap, from the blocks that it meets."""

        def piece(k: Column) -> Column:
            low = F.greatest(gap["start"] - k * BLOCK, F.lit(0))
            return F.substring(blocks[k], low + 1, F.least(gap["end"] - k * BLOCK, F.lit(BLOCK)) - low)

        numbers = F.sequence(F.floor(gap["start"] / BLOCK).cast("int"), F.floor((gap["end"] - 1) / BLOCK).cast("int"))
        return F.when(gap["start"] < gap["end"], F.array_join(F.transform(numbers, piece), "")).otherwise("")

    def joined(found: Column, blocks: Column) -> Column:
        last = F.array(F.struct(found["at"].alias("start"), F.length(text).alias("end")))
        return F.array_join(F.transform(F.concat(found["out"], last), lambda gap: kept(blocks, gap)), mark)

    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    found = running(spans, "struct<start:int,end:int>", step)
    return F.when(F.size(spans) > 0, bound(found, lambda x: bound(cut, lambda blocks: joined(x, blocks)))).otherwise(text)


def mask(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """The rows of ``docs``, all columns, with ``mark`` in place of secrets; n_chars, if there, follows the text."""
    found = secret_spans(docs, rules).withColumn("masked", redacted(F.col("text"), F.col("spans"), mark))
    columns = []
    for c in docs.columns:
        value = F.col("row").getField(c)
        if c == "text":
            value = F.col("masked")
        elif c == "n_chars":
            value = F.when(F.size("spans") > 0, F.length("masked").cast(docs.schema[c].dataType)).otherwise(value)
        columns.append(value.alias(c))
    return found.select(*columns)
