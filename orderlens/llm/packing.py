"""Packing token sequences with balanced attention cost.

Every text is encoded where it is read.  Full sequences are cut off at once; what remains of
the texts is packed in blocks inside the same task, so nothing is shuffled.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from orderlens.llm.common import pieces, texts
from orderlens.llm.tokens import Cache, cut, encoder

# Tokens of remainders packed together: bounds a task's memory, and the padding to one
# sequence in so many tokens.
BLOCK_TOKENS = 4 << 20
WIDTH = 32  # rooms of sequences looked at together
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, cost double"
)
_ids: dict[tuple, Cache] = {}


def attention_cost(tokens: np.ndarray | int, quadratic: float) -> np.ndarray | float:
    """Linear plus quadratic cost of one run of tokens that attends within itself."""
    return tokens + quadratic * tokens * tokens


def assign(lengths: np.ndarray, capacity: int, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """(item, start in the item, length, sequence, offset) with as few sequences as can hold all.

    Items go in descending order of length to the sequence of lowest cost among those with room
    for the whole item.  An item that fits nowhere whole is cut over the sequences with the most
    room.  Only the last tokens of one block stay unfilled: less than one sequence.
    """
    total = int(lengths.sum())
    n = -(-total // capacity)
    room = [capacity] * n
    cost = [0.0] * n
    # Sequences by room, each a heap by cost: the lowest cost with room for x is the least top
    # over rooms >= x.  ``tops`` holds the tops, ``least`` the least one of each ``WIDTH`` rooms.
    nothing = (np.inf, -1, -1)
    heaps: list[list[tuple[float, int, int]]] = [[] for _ in range(capacity + 1)]
    heaps[capacity] = [(0.0, s, capacity) for s in range(n)]
    tops = [nothing] * (capacity + 1)
    least = [nothing] * (capacity // WIDTH + 1)
    out: list[tuple[int, int, int, int, int]] = []

    def renew(r: int) -> None:
        tops[r] = heaps[r][0] if heaps[r] else nothing
        k = r // WIDTH
        least[k] = min(tops[k * WIDTH : (k + 1) * WIDTH])

    def place(item: int, start: int, length: int, s: int) -> None:
        heapq.heappop(heaps[room[s]])
        renew(room[s])
        out.append((item, start, length, s, capacity - room[s]))
        room[s] -= length
        cost[s] += attention_cost(length, quadratic)
        if room[s]:
            heapq.heappush(heaps[room[s]], (cost[s], s, room[s]))
            renew(room[s])

    if n:
        renew(capacity)
    for item in np.lexsort((np.arange(len(lengths)), -lengths)).tolist():
        length = int(lengths[item])
        k = length // WIDTH
        best = min(min(tops[length : (k + 1) * WIDTH]), min(least[k + 1 :], default=nothing))
        if best is not nothing:
            place(item, 0, length, best[1])
            continue
        start = 0
        while start < length:  # cut over those with the most room
            k = max(k for k in range(len(least)) if least[k] is not nothing)
            r = max(r for r in range(k * WIDTH, min((k + 1) * WIDTH, capacity + 1)) if heaps[r])
            size = min(r, length - start)
            place(item, start, size, tops[r][1])
            start += size
    return out


def pack(
    docs: DataFrame,
    vocabulary: str,
    ranks: str | None = None,
    pattern: str | None = None,
    end_id: int = 0,
    capacity: int = 1024,
    quadratic: float = 1 / 1024,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """One row per piece of a document's ids (``end_id`` last), placed in sequences of ``capacity``.

    doc_id, start (ids of the document before the piece), length, ids_crc32 of the ids as
    little-endian unsigned 32-bit values, doc_tokens (ids of the document), sequence_id, offset
    in it, and cost, the estimate for the piece.  Every id lies in exactly one piece and the
    pieces of a sequence leave no gap.

    A null or empty text is one end id.  Each row is a document of its own, whatever its id;
    an empty table gives no rows; other columns are ignored.  Texts of any length are cut into
    full sequences first, so no block grows with a text.  Only the packing depends on how rows
    meet in tasks; what the pieces hold doesn't.
    """
    files = (vocabulary, ranks, pattern)
    end = np.array([end_id], dtype="<u4").tobytes()

    def encode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(*files)
        if files not in _ids:

            def as_bytes(part: str) -> bytes:
                return np.array(enc.ids(part), dtype="<u4").tobytes()

            _ids[files] = Cache(as_bytes)
        cache = _ids[files]

        def encode(text: str | None) -> bytes:
            if not text:
                return end
            if enc.has_special(text):
                return np.array(enc.whole(text), dtype="<u4").tobytes() + end
            parts = cut(text)
            head = np.array(enc.ids(parts[0]), dtype="<u4").tobytes()
            return head + b"".join(map(cache.__getitem__, parts[1:])) + end

        task = TaskContext.get()
        sequence = (task.partitionId() if task else 0) << 36
        rows: list[tuple] = []
        rest: list[tuple] = []  # (doc_id, start, ids, tokens of the document)
        held = 0

        def close() -> None:
            nonlocal sequence, held
            lengths = np.array([len(x[2]) >> 2 for x in rest], dtype=np.int64)
            last = -1
            for item, start, length, s, offset in assign(lengths, capacity, quadratic):
                doc_id, at, ids, n = rest[item]
                crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                rows.append((doc_id, at + start, length, crc, n, sequence + s, offset, attention_cost(length, quadratic)))
                last = max(last, s)
            sequence += last + 1
            rest.clear()
            held = 0

        def out() -> pa.RecordBatch:
            names = [c.split()[0] for c in SCHEMA.split(", ")]
            columns = list(zip(*rows)) or [()] * len(names)
            kinds = [pa.int64()] * 7 + [pa.float64()]
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
            rows.clear()
            return batch

        for batch in pieces(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(text)
                n = len(ids) >> 2
                full = n // capacity
                for k in range(full):
                    crc = zlib.crc32(ids[4 * k * capacity : 4 * (k + 1) * capacity])
                    rows.append((doc_id, k * capacity, capacity, crc, n, sequence, 0, attention_cost(capacity, quadratic)))
                    sequence += 1
                if n % capacity:
                    rest.append((doc_id, full * capacity, ids[4 * full * capacity :], n))
                    held += n % capacity
                if held >= block_tokens:
                    close()
            yield out()
        if rest:
            close()
        yield out()

    return texts(docs).mapInArrow(encode_batches, SCHEMA)
