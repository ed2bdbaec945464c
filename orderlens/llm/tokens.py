"""Token counts by a two-tier lookup on the map side, and the encoder that token packing shares.

A text is cut at single spaces between two characters that are no white space.  No pre-token of a
byte-level vocabulary crosses such a place, so the parts can be encoded apart.  A broadcast table
holds the lengths of the most frequent parts; other parts are encoded once per worker and cached.
No part is ever shuffled; only each task's bounded list of frequent parts is.
"""

from __future__ import annotations

import base64
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import pieces, release, texts, utf8
from orderlens.session import materialize

# Entries of the broadcast table, and the longest part (characters) that may enter it: 2 MB at most.
TABLE_SIZE = 16_384
LONGEST_ENTRY = 32
# Parts a worker caches before it starts anew, and the longest (characters) that it keeps; bounds of
# memory, not of what is counted.
CACHE_SIZE = 400_000
LONGEST_CACHED = 64
# Characters of texts counted before the parts that are too long for the table are let go.
HELD_CHARACTERS = 32 << 20

# A space next to other white space; such texts are cut more carefully.
_LOOSE = re.compile(r" (?:\s|(?<=\s ))")
_SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")
# Code points up to Latin Extended-B, on which the classes of both pre-tokenizers are tested to agree.
_PLAIN = re.compile(r"[\x00-ɏ]*\Z")


def cut(text: str) -> list[str]:
    """Parts between the spaces that may be cut at; joined by one space they are the text again."""
    return _SAFE_SPACE.split(text) if _LOOSE.search(text) else text.split(" ")


class Encoder:
    """Token ids of parts of texts as ``tokenizers`` gives them, special strings included.

    ``ranks`` may name the same vocabulary as ranks for ``tiktoken``, which encodes plain parts
    faster; whatever holds unusual characters or a special string goes to ``tokenizers``.
    """

    def __init__(self, vocabulary: str, ranks: str | None = None, pattern: str | None = None):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(vocabulary)
        self.special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._fast = None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self._fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def whole(self, text: str) -> list[int]:
        """Ids of a text by ``tokenizers`` alone."""
        return self._tokenizer.encode(text, add_special_tokens=False).ids

    def ids(self, part: str) -> list[int]:
        """Ids of a part without special strings."""
        if self._fast is not None and _PLAIN.match(part):
            return self._fast.encode_ordinary(part)
        return self.whole(part)

    def has_special(self, text: str) -> bool:
        return any(s in text for s in self.special)


class Cache(dict):
    """What ``make`` gives for each part that follows a space; begins anew when it is full, keeps no long part."""

    def __init__(self, make, size: int = CACHE_SIZE):
        self._make, self._size = make, size

    def __missing__(self, part: str):
        value = self._make(" " + part)
        if len(part) > LONGEST_CACHED:
            return value
        if len(self) >= self._size:
            self.clear()
        self[part] = value
        return value


_encoders: dict[tuple, Encoder] = {}
_counts: dict[tuple, tuple[str, dict[str, int], Cache]] = {}


def encoder(vocabulary: str, ranks: str | None = None, pattern: str | None = None) -> Encoder:
    """The worker's encoder for these files."""
    key = (vocabulary, ranks, pattern)
    if key not in _encoders:
        _encoders[key] = Encoder(*key)
    return _encoders[key]


def frequent_parts(docs: DataFrame, size: int = TABLE_SIZE) -> list[str]:
    """The parts most frequent over all texts, at most ``size`` of at most 32 characters.

    Every task counts all its texts and hands on its own ``size`` most frequent parts; the best of
    all are brought together on an executor, so the driver gets ``size`` parts at any number of
    tasks.  The list decides only what is looked up first; counts of tokens don't depend on it.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        held = 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    seen.update(text.split(" ")[1:])
                    held += len(text)
                    if held > HELD_CHARACTERS:
                        seen = Counter({p: n for p, n in seen.items() if len(p) <= LONGEST_ENTRY})
                        held = 0
            if len(seen) > 16 * size:
                seen = Counter(dict(seen.most_common(4 * size)))
        top = [(p, n) for p, n in seen.most_common(size) if len(p) <= LONGEST_ENTRY]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], ["part", "n"]
        )

    top = (
        texts(docs)
        .select("text")
        .mapInArrow(count, "part string, n long")
        .groupBy("part")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "part")
        .limit(size)
    )
    stored = materialize(top, "frequent-parts")
    parts = [r["part"] for r in stored.orderBy(F.desc("n"), "part").collect()]  # at most ``size`` short strings
    release(stored)
    return parts


def token_counts(
    docs: DataFrame,
    vocabulary: str,
    ranks: str | None = None,
    pattern: str | None = None,
    limit: int = 1024,
    table_size: int = TABLE_SIZE,
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of ``docs``, in whole texts.

    A null text counts as empty: no bytes, no tokens.  Rows are never merged, so repeated rows
    and null ids come out as they went in; an empty table gives no rows.  Columns of ``docs``
    other than doc_id and text are ignored.  ``limit`` is what over_limit compares with.
    """
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(frequent_parts(docs, table_size))
    files, run = (vocabulary, ranks, pattern), uuid.uuid4().hex

    def caches() -> tuple[dict[str, int], Cache]:
        if _counts.get(files, ("",))[0] != run:
            enc = encoder(*files)
            _counts[files] = (run, {p: len(enc.ids(" " + p)) for p in table.value}, Cache(lambda p: len(enc.ids(p))))
        return _counts[files][1:]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, (first, second) = encoder(*files), caches()

        def length(text: str | None) -> int:
            if not text:
                return 0
            if enc.has_special(text):
                return len(enc.whole(text))
            parts = cut(text)
            n = len(enc.ids(parts[0]))
            found = list(map(first.get, parts[1:]))
            if None in found:
                n += sum(second[p] if x is None else x for p, x in zip(parts[1:], found))
            else:
                n += sum(found)
            return n

        for batch in pieces(batches):
            column = batch.column(1)
            n_tokens = np.array([length(t) for t in column.to_pylist()], dtype=np.int64)
            n_bytes = np.diff(utf8(column)[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_bytes), pa.array(n_tokens), pa.array(n_tokens > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return texts(docs).mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")

