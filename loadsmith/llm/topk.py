"""Exact top-k inner products by MaxScore over shards of dense or sparse integer vectors.

A vector is a document, a dimension is a term, a component a posting.  Each shard keeps its
postings by dimension, with the smallest and largest value there.  For a query, every
dimension's contribution is counted from its least possible value in the shard, so
contributions are not negative and have an upper bound, and a vector's score is a constant
plus their sum.  With dimensions in ascending order of bound:

* the leading ones whose bounds together cannot reach the query's threshold (its k-th best
  score so far) are non-essential; the others are essential;
* the postings of the essential ones are traversed and added up;
* the non-essential ones are probed, largest bound first, only for vectors that are still
  competitive: partial sum plus the bounds left is not below the threshold.

The threshold rises from block to block of a shard.  Each query first searches one shard, which
the hash of its row picks; the k-th best score there is the threshold that it takes to all
other shards.  Shards' results are merged by a ranked window.  Ties go to the smaller id, so a
vector that equals the threshold stays in.

Shards stay in place: a task gets the vectors of a shard, once, and then the queries stream past
them in Arrow batches.  So what is shuffled is the table twice (for the first shards, and for the
others) and the queries once for each shard; nothing is broadcast.

Defined results: vectors that are null, or hold a null, NaN or infinite component, take no part,
nor do null ids; vectors of different lengths compare over the dimensions that both have (missing
ones count 0); a query with fewer than k candidates gets them all; repeated rows are candidates
each on their own, and a query row is never its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadsmith.scratch import materialize

SCALE = 1024
SHARD_ROWS = 32_768
# A small table is cut into as many shards as there are cores, but not into smaller ones than this.
LEAST_ROWS = 4_096
# Vectors of a shard that are scored between two rises of the threshold.
BLOCK = 4_096

RESULT = "query_id long, vec_id long, score long, row long"


def quantized(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v array<long>) of the vectors that take part."""
    x = F.col(f"`{vector_col}`")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    return vectors.where(x.isNotNull() & F.col(f"`{id_col}`").isNotNull() & finite).select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"),
        F.transform(x, lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double"))).alias("v"))


class Shard:
    """Postings of some vectors: a column of values for each dimension, and its bounds."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, vectors: list):
        order = np.lexsort((rows, ids))
        self.ids, self.rows = ids[order], rows[order]
        width = max((len(v) for v in vectors), default=0)
        self.columns = np.zeros((width, len(ids)), np.int64)
        for at, i in enumerate(order.tolist()):
            self.columns[:len(vectors[i]), at] = vectors[i]
        self.low = self.columns.min(1) if len(ids) else np.zeros(width, np.int64)
        self.high = self.columns.max(1) if len(ids) else np.zeros(width, np.int64)

    def search(self, query: np.ndarray, own_row: int, k: int, least_score: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(positions, scores) of the shard's best k, best first; without the query's own row, nor any
        below ``least_score``."""
        q = query[:len(self.columns)]
        ends = np.stack([q * self.low[:len(q)], q * self.high[:len(q)]])
        least, bound = ends.min(0), ends.max(0) - ends.min(0)
        base, order = int(least.sum()), np.argsort(bound, kind="stable")
        reach = np.concatenate(([0], np.cumsum(bound[order])))          # what the first i can add together
        best_at, best = np.empty(0, np.int64), np.empty(0, np.int64)
        for a in range(0, len(self.ids), BLOCK):
            rows = self.columns[:, a:a + BLOCK]
            reached = [int(best[-1])] if len(best) == k else []
            floor = max([s - base for s in reached + ([] if least_score is None else [least_score])], default=0)
            floor = max(floor, 0)                                       # a total below this is out
            split = min(int(np.searchsorted(reach, floor, "left")), len(order)) - 1 if floor > 0 else 0
            at = np.arange(rows.shape[1])
            total = np.zeros(len(at), np.int64)
            for d in order[max(split, 0):]:                             # essential: all postings
                total += q[d] * rows[d] - least[d]
            for i in range(max(split, 0) - 1, -1, -1):                  # the others, while competitive
                near = total + reach[i + 1] >= floor
                if not near.all():
                    at, total = at[near], total[near]
                if not len(at):
                    break
                total = total + q[order[i]] * rows[order[i], at] - least[order[i]]
            near = (total >= floor) & (self.rows[a + at] != own_row)
            best_at, best = np.concatenate([best_at, at[near] + a]), np.concatenate([best, total[near] + base])
            keep = np.lexsort((best_at, -best))[:k]                     # positions are in order of id
            best_at, best = best_at[keep], best[keep]
        return best_at, best


def _search_task(k: int):
    """Answers of a shard: its vectors come first (kind 0), then the queries (kind 1)."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        current, held, shard = None, [], None
        for batch in batches:
            names, kinds = batch.column("shard").to_numpy(), batch.column("kind").to_numpy()
            edges = [0, *(np.flatnonzero((np.diff(names) != 0) | (np.diff(kinds) != 0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:], strict=False):
                part = batch.slice(a, b - a)
                if names[a] != current:
                    current, held, shard = names[a], [], None
                if kinds[a] == 0:
                    held.append(part)
                    continue
                if shard is None:                   # all its vectors have come
                    shard = Shard(*(np.concatenate([p.column(c).to_numpy() for p in held]) if held else np.empty(0, np.int64)
                                    for c in ("vec_id", "row")), [v for p in held for v in p.column("v").to_pylist()])
                    held = []
                out: list[list] = [[], [], [], []]
                for query_id, row, v, least in zip(*(part.column(c).to_pylist() for c in ("vec_id", "row", "v", "least")), strict=True):
                    at, score = shard.search(np.asarray(v, np.int64), row, k, least)
                    for col, x in zip(out, ([query_id] * len(at), shard.ids[at].tolist(), score.tolist(), [row] * len(at)), strict=True):
                        col.extend(x)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["query_id", "vec_id", "score", "row"])

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int, *, id_col: str = "vec_id", vector_col: str = "embedding",
          shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row where ``is_query`` (a condition on
    ``vec_id``) holds, its k best of all other rows."""
    rows = materialize(quantized(vectors, id_col=id_col, vector_col=vector_col)
                       .withColumn("row", F.monotonically_increasing_id()), "vectors")
    n, cores = rows.count(), vectors.sparkSession.sparkContext.defaultParallelism
    shards = max(1, -(-n // shard_rows), min(cores, n // LEAST_ROWS))
    # Hashing the unique row numbers deals rows out evenly, whatever the ids are.
    none = F.lit(None).cast("long")
    held = rows.select(F.pmod(F.xxhash64("row"), F.lit(shards)).alias("shard"), F.lit(0).alias("kind"), "vec_id", "row", "v", none.alias("least"))
    queries = rows.where(is_query).withColumn("first", F.pmod(F.xxhash64("row", F.lit(3)), F.lit(shards)))

    def answers(asked: DataFrame) -> DataFrame:
        both = held.unionByName(asked.select("shard", F.lit(1).alias("kind"), "vec_id", "row", "v", "least"))
        dealt = both.repartition(shards, "shard").sortWithinPartitions("shard", "kind")
        return dealt.mapInArrow(_search_task(k), RESULT)

    found = materialize(answers(queries.select(F.col("first").alias("shard"), "vec_id", "row", "v", none.alias("least"))), "first")
    if shards > 1:
        reached = found.groupBy(F.col("row").alias("of")).agg(F.count("*").alias("n"), F.min("score").alias("least"))
        others = F.filter(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")), lambda s: s != F.col("first"))
        asked = queries.join(reached, F.col("row") == F.col("of"), "left").select(
            F.explode(others).alias("shard"), "vec_id", "row", "v", F.when(F.col("n") == k, F.col("least")).alias("least"))
        found = found.unionByName(answers(asked))
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
