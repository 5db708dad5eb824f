"""Prefix trie of conversations, its subtree figures by the Euler-tour technique.

Every distinct sequence of first turns is a node; conversations that begin with it are its
members.  The trie is never walked from the root; all work is joins, sorts and sums:

* turns are ordered by one global sort, so a conversation of any length is spread over tasks;
* the first ``d`` turns are named by two 64-bit exclusive-ors of hashes of (turn, depth), which
  are prefix sums by blocks of ``BLOCK`` turns; a node's parent has its name less the last turn;
* nodes are numbered by (smallest member, depth); each gets an enter and an exit arc, and each
  arc its successor on the tour (children by number);
* list ranking: chains inside a chunk of ``CHUNK`` arcs are ranked in a task (a path of one
  conversation is mostly inside a chunk) and become one weighted element each; elements are
  then removed by coin tosses, about a quarter a round, until ``FINAL`` are left, which one task
  ranks; removed elements and arcs get their places back in reverse order;
* prefix sums over the arcs' places, again by blocks, give each subtree's leaves and savings as
  the difference between a node's exit and enter arcs.

The SHA-256 of the members that end at a node needs their ids in order: a global sort, ids
joined to blobs of ``BLOB_IDS`` in its tasks, and one running digest over a node's few blobs.

Defined results: rows with a null conversation take no part; null role or text is empty; a
null turn comes first, equal turns are ordered by the MD5 of role, then of text; an empty
table has no node, not even a root.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadsmith.scratch import materialize

BLOCK = 1_024
# Nodes of a chunk (each has two arcs), and list elements that one task may rank in the end.
CHUNK = 8_192
FINAL = 65_536
# Ids joined to one text on the way to a digest.
BLOB_IDS = 8_192
# Rows of one task are numbered in these low bits by monotonically_increasing_id.
ROW_BITS = 33


def _before(order: str, *group: str):
    return Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def globally_sorted(df: DataFrame, *order: str) -> DataFrame:
    """``df`` sorted over all tasks, stored, with ``part`` and ``idx``: the task and the row in it.

    The row number ends the sort key, so rows equal in ``order`` can't fill a task."""
    keys = [F.col(c).asc_nulls_first() for c in (*order, "tie")]
    out = df.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    out = materialize(out.drop("tie").withColumn("at", F.monotonically_increasing_id()), "sorted")
    low = F.lit((1 << ROW_BITS) - 1)
    return out.select(*df.columns, F.shiftright("at", ROW_BITS).alias("part"), F.col("at").bitwiseAND(low).alias("idx"))


def numbered(ordered: DataFrame, name: str) -> DataFrame:
    """Rows of ``globally_sorted`` numbered from 0 over all tasks: one row a task is summed up and broadcast."""
    sizes = ordered.groupBy("part").agg(F.count("*").alias("n"))
    starts = sizes.select("part", F.coalesce(F.sum("n").over(_before("part")), F.lit(0)).alias("base"))
    return ordered.join(F.broadcast(starts), "part").withColumn(name, F.col("base") + F.col("idx")).drop("part", "idx", "base")


def ranked(ordered: DataFrame, group: str, name: str) -> DataFrame:
    """Rows of ``globally_sorted`` numbered from 1 within ``group``, the first sort column.  A group is
    joined by (task, group), so one that spans many tasks stays spread."""
    runs = ordered.groupBy("part", group).agg(F.min("idx").alias("first"), F.count("*").alias("n"))
    runs = runs.select("part", group, (F.coalesce(F.sum("n").over(_before("part", group)), F.lit(0)) - F.col("first") + 1).alias("shift"))
    return ordered.join(runs, ["part", group]).withColumn(name, F.col("idx") + F.col("shift")).drop("part", "idx", "shift")


def ordered_turns(conversations: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """(conv, pos, role, digest, chars) of every turn: its place from 1, MD5 of role and text, code points."""
    role, text = (F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in (role_col, text_col))
    src = conversations.select(F.col(f"`{conv_col}`").cast("long").alias("conv"), F.col(f"`{turn_col}`").alias("turn"),
                               F.md5(role).alias("role"), F.md5(text).alias("digest"), F.length(text).cast("long").alias("chars"))
    ordered = globally_sorted(src.where("conv is not null"), "conv", "turn", "role", "digest")
    return ranked(ordered, "conv", "pos").drop("turn")


def rebuilt(turns: DataFrame, heads: Column, base: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first ``heads`` turns (an expression of ``conv``, at most ``most``) are replaced by
    those of the conversation ``base``: (conv, depth, role, digest, chars) and all ids (conv)."""
    convs = turns.select("conv").distinct()
    given = turns.where((F.col("conv") == base) & (F.col("pos") <= most)).withColumnRenamed("conv", "base")
    copies = convs.select("conv", base.alias("base"), heads.alias("heads")).join(given, "base").where("pos <= heads") \
        .select("conv", F.col("pos").alias("depth"), "role", "digest", "chars")
    # Where the base is shorter than asked for, or absent, the own turns move up.
    had = copies.groupBy("conv").agg(F.count("*").alias("had"))
    short = convs.join(had, "conv", "left").select(F.col("conv").alias("of"), (F.coalesce("had", F.lit(0)) - heads).alias("move")) \
        .where("move < 0")
    own = turns.where(F.col("pos") > heads).join(short, F.col("conv") == F.col("of"), "left") \
        .select("conv", (F.col("pos") + F.coalesce("move", F.lit(0))).alias("depth"), "role", "digest", "chars")
    return copies.unionByName(own), convs


def _prefixes(turns: DataFrame) -> DataFrame:
    """(conv, depth, chars, x1, x2, p1, p2): the name of the first ``depth`` turns, and of those before the last."""
    rows = turns.select("conv", "depth", "chars", F.floor((F.col("depth") - 1) / BLOCK).alias("block"),
                        F.xxhash64("role", "digest", "depth").alias("h1"), F.xxhash64("depth", "digest", "role", F.lit(7)).alias("h2"))
    run = Window.partitionBy("conv", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    rows = materialize(rows.select("conv", "block", "depth", "chars", "h1", "h2", F.expr("bit_xor(h1)").over(run).alias("r1"),
                                   F.expr("bit_xor(h2)").over(run).alias("r2")), "prefixes")
    # The last row of a full block has the block's value; the blocks before are added to the next one's.
    upto = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    carry = rows.where(F.col("depth") % BLOCK == 0).select(
        F.col("conv").alias("of"), (F.col("block") + 1).alias("to"), F.expr("bit_xor(r1)").over(upto).alias("c1"),
        F.expr("bit_xor(r2)").over(upto).alias("c2"))
    rows = rows.join(carry, (F.col("conv") == F.col("of")) & (F.col("block") == F.col("to")), "left")
    x = [F.col(f"r{i}").bitwiseXOR(F.coalesce(f"c{i}", F.lit(0).cast("long"))) for i in (1, 2)]
    return rows.select("conv", "depth", "chars", x[0].alias("x1"), x[1].alias("x2"),
                       x[0].bitwiseXOR(F.col("h1")).alias("p1"), x[1].bitwiseXOR(F.col("h2")).alias("p2"))


def _tree(prefixes: DataFrame, convs: DataFrame) -> DataFrame:
    """(node, depth, x1, x2, conv, n, saving, parent, parent_conv): nodes numbered by (conv, depth)."""
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    nodes = prefixes.groupBy("depth", "x1", "x2").agg(
        F.min("conv").alias("conv"), F.count("*").alias("n"), F.max("chars").alias("chars"), F.max("p1").alias("p1"), F.max("p2").alias("p2"))
    root = convs.agg(F.min("conv").alias("conv"), F.count("*").alias("n")).where("n > 0").select(
        zero.alias("depth"), zero.alias("x1"), zero.alias("x2"), "conv", "n", zero.alias("chars"), none.alias("p1"), none.alias("p2"))
    nodes = nodes.withColumn("depth", F.col("depth").cast("long")).unionByName(root)
    nodes = numbered(globally_sorted(nodes, "conv", "depth"), "node")
    above = nodes.select((F.col("depth") + 1).alias("below"), F.col("x1").alias("a1"), F.col("x2").alias("a2"),
                         F.col("node").alias("parent"), F.col("conv").alias("parent_conv"))
    same = (F.col("depth") == F.col("below")) & (F.col("p1") == F.col("a1")) & (F.col("p2") == F.col("a2"))
    return materialize(nodes.join(above, same, "left").select(
        "node", "depth", "x1", "x2", "conv", "n", ((F.col("n") - 1) * F.col("chars")).alias("saving"), "parent", "parent_conv"), "tree")


def _children(tree: DataFrame) -> DataFrame:
    return tree.where("parent is not null").groupBy(F.col("parent").alias("of")).agg(
        F.min("node").alias("first_child"), F.count("*").alias("n_children"))


def _arcs(tree: DataFrame) -> DataFrame:
    """(arc, next, leaf, saving): node v's enter arc is 2v, its exit arc 2v + 1."""
    line = numbered(globally_sorted(tree.where("parent is not null").select("parent", "node"), "parent", "node"), "i")
    after = line.select((F.col("i") - 1).alias("i"), F.col("parent").alias("shared"), F.col("node").alias("sibling"))
    siblings = line.join(after, "i").where("parent = shared").select(F.col("node").alias("left"), "sibling")
    all_of = tree.select("node", "parent", "saving").join(_children(tree), F.col("node") == F.col("of"), "left") \
        .join(siblings, F.col("node") == F.col("left"), "left")
    own = 2 * F.col("node")
    enter = F.struct(own.alias("arc"), F.coalesce(2 * F.col("first_child"), own + 1).alias("next"),
                     F.col("first_child").isNull().cast("long").alias("leaf"), F.col("saving").alias("saving"))
    zero = F.lit(0).cast("long")
    leave = F.struct((own + 1).alias("arc"), F.coalesce(2 * F.col("sibling"), 2 * F.col("parent") + 1).alias("next"),
                     zero.alias("leaf"), zero.alias("saving"))
    return all_of.select(F.explode(F.array(enter, leave)).alias("a")).select("a.*")


def chains(arcs: np.ndarray, following: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of list elements and their successors (negative: none): the head of each one's chain within
    ``arcs``, its place in the chain, and whether it is the last there."""
    order = np.argsort(arcs)
    at = np.searchsorted(arcs, following, sorter=order)
    found = order[np.minimum(at, len(arcs) - 1)]
    to = np.where((following >= 0) & (arcs[found] == following), found, -1).tolist()
    heads = np.ones(len(arcs), bool)
    heads[[t for t in to if t >= 0]] = False
    head, place = np.empty(len(arcs), np.int64), np.empty(len(arcs), np.int64)
    for first in np.flatnonzero(heads).tolist():
        i, n, name = first, 0, arcs[first]
        while i >= 0:
            head[i], place[i] = name, n
            i, n = to[i], n + 1
    return head, place, np.asarray(to) < 0


def _chain_task(key, table):
    import pyarrow as pa

    following = table.column("next").fill_null(-1).to_numpy()
    head, place, last = chains(table.column("arc").to_numpy(), following)
    return pa.table([table.column("arc"), table.column("next"), table.column("leaf"), table.column("saving"),
                     pa.array(head), pa.array(place), pa.array(last)],
                    names=["arc", "next", "leaf", "saving", "head", "place", "last"])


def _walk(batches: Iterator) -> Iterator:
    """Ranks of a whole list of at most FINAL elements: the weights before each."""
    import pyarrow as pa

    after, weight = {}, {}
    for batch in batches:
        for e, t, w in zip(*(batch.column(c).to_pylist() for c in ("id", "next", "w")), strict=True):
            after[e], weight[e] = t, w
    begin = after.keys() - {t for t in after.values() if t is not None}
    ids, ranks, rank = [], [], 0
    e = begin.pop() if begin else None
    while e is not None:
        ids.append(e)
        ranks.append(rank)
        rank, e = rank + weight[e], after[e]
    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(ranks, pa.int64())], names=["id", "rank"])


def list_ranks(elements: DataFrame, final: int = FINAL) -> DataFrame:
    """(id, rank) of one linked list (id, next, w), ``next`` null at its end: the weights before each element."""
    now, removed, toss = materialize(elements, "list"), [], 0
    while now.count() > final:
        toss += 1

        def coin(c: str, seed: int = toss) -> Column:
            return F.pmod(F.xxhash64(c, F.lit(seed)), F.lit(2))

        # Who tosses 1 is taken out by a predecessor that tosses 0; no two neighbours go together.
        ahead = now.where((coin("id") == 0) & (coin("next") == 1)).select(F.col("id").alias("p"), F.col("next").alias("x"), F.col("w").alias("pw"))
        gone = materialize(now.join(ahead, F.col("id") == F.col("x")).select("id", "next", "w", "p", "pw"), "removed")
        skip = gone.select("p", F.col("next").alias("skip"), F.col("w").alias("more"))
        now = materialize(now.join(gone.select("id"), "id", "left_anti").join(skip, F.col("id") == F.col("p"), "left").select(
            "id", F.when(F.col("p").isNull(), F.col("next")).otherwise(F.col("skip")).alias("next"),
            (F.col("w") + F.coalesce("more", F.lit(0))).alias("w")), "list")
        removed.append(gone)
    ranks = now.coalesce(1).mapInArrow(_walk, "id long, rank long")
    for gone in reversed(removed):
        ranks = materialize(ranks, "ranks")
        back = gone.join(ranks.withColumnRenamed("id", "of"), F.col("p") == F.col("of")).select("id", (F.col("rank") + F.col("pw")).alias("rank"))
        ranks = ranks.unionByName(back)
    return ranks


def tour_places(arcs: DataFrame, *, chunk: int = CHUNK, final: int = FINAL) -> DataFrame:
    """(arc, place, leaf, saving): where each arc stands on the tour, from 0."""
    shape = "arc long, next long, leaf long, saving long, head long, place long, last boolean"
    local = materialize(arcs.withColumn("chunk", F.floor(F.col("arc") / (2 * chunk))).groupBy("chunk").applyInArrow(_chain_task, shape), "arcs")
    # An arc whose predecessor is in another chunk is a head there, so chains link to heads.
    ranks = list_ranks(local.where("last").select(F.col("head").alias("id"), "next", (F.col("place") + 1).alias("w")), final)
    return local.join(ranks, F.col("head") == F.col("id")).select("arc", (F.col("rank") + F.col("place")).alias("place"), "leaf", "saving")


def _subtree_sums(places: DataFrame, chunk: int) -> DataFrame:
    """(node, n_leaves, saved, enter, exit) from prefix sums at the places of a node's arcs."""
    rows = places.withColumn("block", F.floor(F.col("place") / (2 * chunk)))
    run = Window.partitionBy("block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    values = ("leaf", "saving")
    rows = materialize(rows.select("arc", "place", "block", *values, *[F.sum(v).over(run).alias(f"{v}_run") for v in values]), "sums")
    totals = rows.groupBy("block").agg(*[F.sum(v).alias(v) for v in values])
    before = totals.select(F.col("block").alias("of"), *[F.coalesce(F.sum(v).over(_before("block")), F.lit(0)).alias(f"{v}_before") for v in values])
    rows = rows.join(before, F.col("block") == F.col("of"))
    leaving = F.col("arc") % 2 == 1

    def within(v: str) -> Column:
        upto = F.col(f"{v}_run") + F.col(f"{v}_before")
        return F.sum(F.when(leaving, upto).otherwise(F.col(v) - upto))

    return rows.groupBy(F.floor(F.col("arc") / 2).alias("in_node")).agg(
        within("leaf").alias("n_leaves"), within("saving").alias("saved"),
        F.max(F.when(~leaving, F.col("place"))).alias("enter"), F.max(F.when(leaving, F.col("place"))).alias("exit"))


def _blob_batches(batches: Iterator) -> Iterator:
    """Ids of consecutive rows of a node joined by commas, at most BLOB_IDS in each."""
    import pyarrow as pa

    for batch in batches:
        names = [batch.column(c).to_numpy() for c in ("depth", "x1", "x2")]
        ids = batch.column("conv").to_numpy()
        new = np.ones(len(ids), bool)
        new[1:] = np.any([n[1:] != n[:-1] for n in names], axis=0)
        starts = sorted({*np.flatnonzero(new).tolist(), *range(0, len(ids), BLOB_IDS)})
        blobs = [",".join(map(str, ids[a:b].tolist())) for a, b in zip(starts, [*starts[1:], len(ids)], strict=True)]
        yield pa.RecordBatch.from_arrays([*[pa.array(n[starts]) for n in names], pa.array(ids[starts]), pa.array(blobs, pa.string())],
                                         names=["depth", "x1", "x2", "first", "blob"])


def _digest_batches(batches: Iterator) -> Iterator:
    """SHA-256 of each node's blobs, which come in order: only the running digest is kept."""
    import hashlib

    import pyarrow as pa

    shape = pa.schema([("depth", pa.int64()), ("x1", pa.int64()), ("x2", pa.int64()), ("sha", pa.string())])
    current, digest = None, None
    for batch in batches:
        out: list[tuple] = []
        for *name, blob in zip(*(batch.column(c).to_pylist() for c in ("depth", "x1", "x2", "blob")), strict=True):
            if name != current:
                if current is not None:
                    out.append((*current, digest.hexdigest()))
                current, digest = name, hashlib.sha256(blob.encode())
            else:
                digest.update(b"," + blob.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), shape, strict=True)], schema=shape)
    if current is not None:
        yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip((*current, digest.hexdigest()), shape, strict=True)], schema=shape)


def _end_digests(prefixes: DataFrame, convs: DataFrame) -> DataFrame:
    """(depth, x1, x2, sha) of the nodes at which conversations end."""
    last = prefixes.groupBy(F.col("conv").alias("of")).agg(F.max(F.struct(F.col("depth").cast("long").alias("depth"), "x1", "x2")).alias("end"))
    zero = F.lit(0).cast("long")
    ends = convs.join(last, F.col("conv") == F.col("of"), "left").select(
        *[F.coalesce(f"end.{c}", zero).alias(c) for c in ("depth", "x1", "x2")], "conv")
    keys = ["depth", "x1", "x2", "conv"]
    blobs = ends.repartitionByRange(*keys).sortWithinPartitions(*keys) \
        .mapInArrow(_blob_batches, "depth long, x1 long, x2 long, first long, blob string")
    return blobs.repartition("depth", "x1", "x2").sortWithinPartitions("depth", "x1", "x2", "first") \
        .select("depth", "x1", "x2", "blob").mapInArrow(_digest_batches, "depth long, x1 long, x2 long, sha string")


# SHA-256 of nothing.
NO_ENDS = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def prefix_trie(turns: DataFrame, convs: DataFrame, *, chunk: int = CHUNK, final: int = FINAL) -> DataFrame:
    """One row per node of the trie of ``turns`` (conv, depth, role, digest, chars), whose conversations, those
    without a turn too, are ``convs`` (conv): conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256; and node, parent (numbers), enter, exit (places on the tour)."""
    convs = materialize(convs, "convs")
    prefixes = materialize(_prefixes(turns), "named")
    tree = _tree(prefixes, convs)
    sums = _subtree_sums(tour_places(_arcs(tree), chunk=chunk, final=final), chunk)
    ends = _end_digests(prefixes, convs).select("sha", *[F.col(c).alias(f"e_{c}") for c in ("depth", "x1", "x2")])
    here = (F.col("depth") == F.col("e_depth")) & (F.col("x1") == F.col("e_x1")) & (F.col("x2") == F.col("e_x2"))
    out = tree.join(sums, F.col("node") == F.col("in_node")).join(_children(tree), F.col("node") == F.col("of"), "left") \
        .join(ends, here, "left")
    return out.select(F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), F.col("n").alias("n_convs"),
                      F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"), "n_leaves",
                      F.col("saved").alias("saved_tokens"), F.coalesce("sha", F.lit(NO_ENDS)).alias("ends_sha256"),
                      "node", "parent", "enter", "exit")
