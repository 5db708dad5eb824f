"""Hierarchical multi-length packing of tokenized documents.

Documents are routed to context-size tiers (powers of two up to the window), each tier
is packed, the gaps of long windows are filled from shorter tiers, and sequences are
dealt to step groups of nearly equal token counts.

* A document longer than the window gives whole windows; what is left over is routed to
  the smallest tier that holds it.
* Tiers are packed from the longest down.  A window starts with the longest document of
  its tier; its gap takes the longest shorter document that fits, again and again, and
  at last a cut from the shortest one left, whose rest stays in the pool.  So every
  window is exactly full while documents are left.
* What remains at the end of a group is cut into power-of-two sequences: no padding.

The work streams through the input partitions: a task buffers ``group_tokens`` tokens (or
one longer document), packs them and goes on, so memory is bounded, there is no shuffle
and a lost executor's tasks are simply run again.

Defined results: null text counts as empty; every document ends with ``end_id``, so an
empty one is a piece of one token; repeated rows are packed each on their own; a null id
stays null; an empty table gives no pieces.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW = 2048
TIERS = (256, 512, 1024, 2048)
# Tokens that a task packs at a time, and tokens of a step group.
GROUP_TOKENS = 4_000_000
STEP_TOKENS = 131_072
# Sequence ids: the task's partition number above, its own count below.
TASK_BITS = 36

PIECES = T.StructType([
    T.StructField("doc", T.LongType()), T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("doc_tokens", T.LongType()),
    T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
    T.StructField("tier", T.IntegerType()), T.StructField("step_group", T.LongType()),
    T.StructField("ids", T.BinaryType()),
])


def _powers(n: int) -> list[int]:
    """``n`` as a sum of distinct powers of two, largest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def pack_lengths(lengths: list[int], window: int = WINDOW, tiers=TIERS) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length) pieces that hold every token of every
    document once.  Each sequence's total is a power of two of at most ``window``."""
    tiers = sorted(tiers, reverse=True)
    if tiers[0] != window or any(t & (t - 1) for t in tiers):
        raise ValueError("tiers must be powers of two and the longest must be the window")
    sequences, pool = [], []
    for doc, n in enumerate(lengths):
        whole = n - n % window
        sequences += [[(doc, at, window)] for at in range(0, whole, window)]
        if n > whole:
            pool.append((n - whole, doc, whole))
    pool.sort()
    for tier, below in zip(tiers, [*tiers[1:], 0], strict=True):
        while pool and pool[-1][0] > below:
            size, doc, at = pool.pop()
            pieces, gap = [(doc, at, size)], tier - size
            while gap and pool:
                fits = bisect_right(pool, (gap + 1,)) - 1
                if fits >= 0:
                    size, doc, at = pool.pop(fits)
                else:
                    rest, doc, at = pool.pop(0)
                    size = gap
                    insort(pool, (rest - size, doc, at + size))
                pieces.append((doc, at, size))
                gap -= size
            sequences += [pieces] if not gap else _split(pieces, _powers(tier - gap))
    return sequences


def _split(pieces: list[tuple[int, int, int]], sizes: list[int]) -> list[list[tuple[int, int, int]]]:
    """``pieces`` one after another, cut into sequences of these sizes."""
    out, left = [], list(reversed(pieces))
    for size in sizes:
        sequence = []
        while size:
            doc, at, n = left.pop()
            take = min(n, size)
            sequence.append((doc, at, take))
            if take < n:
                left.append((doc, at + take, n - take))
            size -= take
        out.append(sequence)
    return out


def step_groups(sizes: list[int], step_tokens: int) -> list[int]:
    """A step group for each sequence: the longest first, each to the lightest group."""
    heap = [(0, g) for g in range(max(1, -(-sum(sizes) // step_tokens)))]
    of = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        load, g = heapq.heappop(heap)
        of[i] = g
        heapq.heappush(heap, (load + sizes[i], g))
    return of


def _pack_task(tokenizer: str, end_id: int, window: int, tiers, group_tokens: int, step_tokens: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        from loadsmith.llm._tokens import encoder, text_batches

        tokenize = encoder(tokenizer)
        base = TaskContext.get().partitionId() << TASK_BITS
        end = np.asarray([end_id], "<u4").tobytes()
        given = {"sequences": 0, "steps": 0}

        def packed(docs: list, ids: list[bytes]):
            lengths = [len(x) // 4 for x in ids]
            sequences = pack_lengths(lengths, window, tiers)
            sizes = [sum(n for *_, n in s) for s in sequences]
            step = step_groups(sizes, step_tokens)
            cols: list[list] = [[] for _ in PIECES]
            for s, (pieces, size) in enumerate(zip(sequences, sizes, strict=True)):
                offset = 0
                for doc, at, n in pieces:
                    for col, v in zip(cols, (docs[doc], at, n, lengths[doc], base + given["sequences"] + s, offset,
                                             size, base + given["steps"] + step[s], ids[doc][4 * at:4 * (at + n)]),
                                      strict=True):
                        col.append(v)
                    offset += n
            given["sequences"] += len(sequences)
            given["steps"] += max(step, default=-1) + 1
            kinds = [pa.int64()] * 6 + [pa.int32(), pa.int64(), pa.binary()]
            for at in range(0, len(cols[0]), 20_000):
                yield pa.RecordBatch.from_arrays([pa.array(c[at:at + 20_000], k) for c, k in zip(cols, kinds, strict=True)],
                                                 names=PIECES.names)

        docs, ids, tokens = [], [], 0
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            keys = batch.column("doc").to_pylist()
            for a, b in text_batches(texts):
                for key, x in zip(keys[a:b], tokenize.encode(texts[a:b]), strict=True):
                    docs.append(key)
                    ids.append(x + end)
                    tokens += len(x) // 4 + 1
                if tokens >= group_tokens:
                    yield from packed(docs, ids)
                    docs, ids, tokens = [], [], 0
        if docs:
            yield from packed(docs, ids)
        tokenize.clear()

    return run


def pack(docs: DataFrame, tokenizer: str, end_id: int, *, id_col: str = "doc_id", text_col: str = "text",
         window: int = WINDOW, tiers=TIERS, group_tokens: int = GROUP_TOKENS,
         step_tokens: int = STEP_TOKENS) -> DataFrame:
    """One row per piece: the document's id, ``start`` and ``length`` in its ids,
    ``doc_tokens``, ``sequence_id``, ``offset`` there, ``tier`` (the sequence's length),
    ``step_group`` and ``ids`` (little-endian unsigned 32-bit)."""
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.col(f"`{text_col}`").alias("text"))
    out = src.mapInArrow(_pack_task(tokenizer, end_id, window, tuple(tiers), group_tokens, step_tokens), PIECES)
    return out.withColumnRenamed("doc", id_col)
