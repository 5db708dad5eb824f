"""SimHash near-duplicates: tiled exact comparison of 64-bit fingerprints.

A text's fingerprint has a bit set where more than half of its shingles' hashes have it.
Two fingerprints link when they differ in at most ``radius`` bits; classes are the
connected components.

* Equal fingerprints are one node, so copies cost one row.
* Tiles: the 64 bits are cut into blocks; fingerprints within the radius agree on at
  least ``blocks - radius`` of them, so each choice of that many blocks is a table, and
  only fingerprints that share a table's bits meet in a tile.  The number of blocks grows
  with the number of fingerprints (it changes how many meet, never which links are found).
* A bucket larger than ``TILE`` rows is cut into tiles by bit count and hash.  Pairs of
  tiles whose bit counts differ by more than the radius are skipped; the others are
  compared with numpy exclusive-or and bit counts, again in sub-tiles sorted by bit count
  that are skipped the same way.
* A tile pair returns a spanning forest of its links, so a group of thousands of near
  copies gives no more edges than members.

Defined results: null text counts as empty; texts without a word have fingerprint zero
and link like any other; fewer words than a shingle are one shingle; a class's id is its
smallest document id (null where all are null); repeated rows are all returned.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadsmith.llm.components import components
from loadsmith.scratch import materialize

SHINGLE = 4
RADIUS = 4
SEED = 42
# Rows of a tile, and of the sub-tiles that numpy compares at once.
TILE = 4_096
SUB_TILE = 512
# Hashes whose bits are counted at once.
COUNT_BLOCK = 16_384


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint of a UTF-8 text (A-Z lower-cased, ASCII white space)."""
    from xxhash import xxh64_intdigest

    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxh64_intdigest(joined, SEED)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    n = len(words) - shingle + 1
    first, last, ones = starts[:n].tolist(), ends[shingle - 1:].tolist(), np.zeros(64, np.int64)
    for at in range(0, n, COUNT_BLOCK):
        hashes = np.array([xxh64_intdigest(joined[a:b], SEED)
                           for a, b in zip(first[at:at + COUNT_BLOCK], last[at:at + COUNT_BLOCK], strict=True)], "<u8")
        ones += np.unpackbits(hashes.view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc, text_hash, fp): the fingerprint as a signed long; ``text_hash`` tells apart rows of one id."""
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.xxhash64(f"`{text_col}`").alias("text_hash"),
                      F.col(f"`{text_col}`").cast("binary").alias("text"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            made = np.array([fingerprint(t.as_py(), shingle) for t in batch.column("text")], "<u8")
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("text_hash"), pa.array(made.view("<i8"))],
                                             names=["doc", "text_hash", "fp"])

    return src.mapInArrow(run, "doc long, text_hash long, fp long")


def block_masks(blocks: int, radius: int) -> list[int]:
    """Signed masks of every choice of ``blocks - radius`` of the blocks."""
    cut = [round(64 * i / blocks) for i in range(blocks + 1)]
    each = [sum(1 << bit for bit in range(a, b)) for a, b in zip(cut, cut[1:], strict=False)]
    sums = [sum(c) for c in itertools.combinations(each, blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in sums]


def blocks_for(n: int, radius: int) -> int:
    """Blocks such that a bucket of ``n`` evenly spread fingerprints fits into a tile."""
    blocks = radius + 1
    while blocks < 2 * radius and n >> (64 * (blocks - radius) // blocks) > TILE // 4:
        blocks += 1
    return blocks


def _forest(fps: np.ndarray, side: np.ndarray, radius: int) -> np.ndarray:
    """Rows (fingerprint, root) that connect what is linked; a link counts if both ends are
    on one side 0, or on sides 0 and 1 where side 1 occurs."""
    pops = np.bitwise_count(fps).astype(np.int16)
    order = np.lexsort((fps, pops))
    fps, pops, side = fps[order], pops[order], side[order]
    crossed = bool(side.any())
    parent = np.arange(len(fps))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    tiles = range(0, len(fps), SUB_TILE)
    for i in tiles:
        for j in tiles[i // SUB_TILE:]:
            x, y = slice(i, i + SUB_TILE), slice(j, j + SUB_TILE)
            if pops[j] - pops[x][-1] > radius:
                break                               # sorted by bit count: no later tile can link
            near = np.bitwise_count(fps[x, None] ^ fps[None, y]) <= radius
            if crossed:
                near &= side[x, None] != side[None, y]
            elif i == j:
                near = np.triu(near, 1)
            p, q = np.nonzero(near)
            if not len(p):
                continue
            # One union for each pair of trees, not for each link.
            label = {k: root(k) for k in {*(p + i).tolist(), *(q + j).tolist()}}
            at = np.fromiter((label.get(k, 0) for k in range(i, min(i + SUB_TILE, len(fps)))), np.int64)
            to = np.fromiter((label.get(k, 0) for k in range(j, min(j + SUB_TILE, len(fps)))), np.int64)
            pairs = at[p] * len(fps) + to[q]
            for pair in np.unique(pairs[at[p] != to[q]]).tolist():
                s, t = root(pair // len(fps)), root(pair % len(fps))
                if s != t:
                    parent[max(s, t)] = min(s, t)
    roots = np.fromiter((root(k) for k in range(len(fps))), np.int64, len(fps))
    own = roots != np.arange(len(fps))
    return np.column_stack([fps[own], fps[roots[own]]])


def links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) that connect exactly the distinct fingerprints ``nodes.fp`` within ``radius`` bits."""
    n = nodes.count()
    blocks = blocks_for(n, radius)
    masks = block_masks(blocks, radius)
    buckets = max(1, 2 * n * len(masks) // TILE)
    tables = F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits"))
                                 for t, m in enumerate(masks)]))
    rows = nodes.select("fp", tables.alias("k")).select(
        "fp", F.pmod(F.xxhash64("k.t", "k.bits"), F.lit(buckets)).alias("g"), F.bit_count("fp").alias("pop"))
    sizes = rows.groupBy("g", "pop").agg(F.count("*").alias("n"))
    totals = sizes.groupBy("g").agg(F.sum("n").alias("total")).where(F.col("total") > TILE)
    # Tiles of the large buckets: (bucket, bit count, part), and the pairs worth comparing.
    large = materialize(sizes.join(totals, "g").select(
        "g", "pop", F.ceil(F.col("n") / F.lit(TILE // 2)).cast("int").alias("parts")), "tiles")
    tile = large.select("g", "pop", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    left, right = (tile.select("g", F.struct("pop", "part").alias(x)) for x in "xy")
    pairs = left.join(right, "g").where((F.col("x") <= F.col("y")) & (F.abs(F.col("x.pop") - F.col("y.pop")) <= radius))
    known = large.withColumnRenamed("pop", "p").select("g", "p", "parts")
    placed = rows.join(known, (rows.g == known.g) & (rows.pop == known.p), "left").select(rows.g, "fp", "pop", "parts")
    nothing = F.struct(F.lit(-1).alias("pop"), F.lit(-1).alias("part"))
    small = placed.where("parts is null").select("g", nothing.alias("x"), nothing.alias("y"), "fp", F.lit(0).alias("side"))
    cut = placed.where("parts is not null").select(
        "g", "fp", F.struct("pop", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int").alias("part")).alias("tile"))
    first = cut.withColumnRenamed("tile", "x").join(pairs, ["g", "x"]).select("g", "x", "y", "fp", F.lit(0).alias("side"))
    second = cut.withColumnRenamed("tile", "y").join(pairs.where("x != y"), ["g", "y"]) \
        .select("g", "x", "y", "fp", F.lit(1).alias("side"))

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        found = _forest(part["fp"].to_numpy().view("<u8"), part["side"].to_numpy(), radius)
        return pd.DataFrame({"a": found[:, 0].astype("<u8").view("<i8"), "b": found[:, 1].astype("<u8").view("<i8")})

    return small.unionByName(first).unionByName(second).groupBy("g", "x", "y") \
        .applyInPandas(compare, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS) -> DataFrame:
    """(id, text_hash, fingerprint, component_id, stays) of every row.

    ``stays`` marks the row of each class with the smallest id (an id before none, ties by
    the hash of the text); it is true for every copy of that row.
    """
    prints = materialize(fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle), "prints")
    nodes = materialize(prints.groupBy("fp").agg(
        F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", "text_hash")).alias("least")), "nodes")
    found = components(links(nodes.select("fp"), radius))
    named = nodes.join(found, nodes.fp == found.node, "left") \
        .select("fp", "least", F.coalesce("root", "fp").alias("root"))
    classes = named.groupBy("root").agg(F.min("least").alias("keeper"))
    of = named.join(classes, "root").select("fp", "keeper")
    out = prints.join(of, "fp", "left")
    return out.select(
        F.col("doc").alias(id_col), "text_hash", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("keeper.doc").alias("component_id"),
        (F.col("doc").eqNullSafe(F.col("keeper.doc")) & (F.col("text_hash") == F.col("keeper.text_hash"))).alias("stays"))


def drop_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each class: all columns, repeated rows once."""
    keepers = near_duplicates(docs, id_col=id_col, text_col=text_col, **options).where("stays")
    keepers = materialize(keepers.groupBy(F.col(id_col).alias("_keeper"), F.col("text_hash").alias("_hash"))
                          .agg(F.count("*").alias("_copies")), "keepers")
    same = docs[id_col].cast("long").eqNullSafe(keepers["_keeper"]) & (F.xxhash64(docs[text_col]) == keepers["_hash"])
    columns = [docs[c] for c in docs.columns]
    repeated = keepers.where("_copies > 1")
    if repeated.isEmpty():
        return docs.join(keepers, same, "left_semi")
    once = docs.join(keepers.where("_copies = 1"), same, "left_semi")
    again = docs.join(repeated, same).dropDuplicates(["_keeper", "_hash"]).select(*columns)
    return once.unionByName(again)
