"""Token ids in binary blocks: one shared zstandard dictionary, one frame per document.

A dictionary is trained on the serialized ids of a bounded sample of documents; every
document is compressed by itself with it, so a short document still compresses well and
can be read alone.  Files are written in ascending id order.

The container (all of it written and read by Spark, so any file system that Spark knows
will do) has two Parquet tables, ``dictionary`` (hash, bytes) and ``blocks``.  A row of
``blocks`` is one binary block with its place (shard, start of its tokens in the shard)
and the ids it spans, so a reader of one document skips all other blocks by their
min/max statistics.  A block is, little-endian:

    8 bytes   magic "TOKBLK01"
    32 bytes  SHA-256 of the dictionary
    u32       documents n;  u32  bytes of an id on disk (2 or 4)
    n u8      1 where the document id is null
    n i64     document ids
    n u64     ids in each document
    (n+1) u64 offset index: where each document's frame begins in the payload
    payload   zstandard frames

Defined results: null text counts as empty and holds only the end id; a null document id
sorts first; repeated rows are kept each on their own, in an order given by a hash of
their text; an empty table gives empty files.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadsmith.scratch import materialize

MAGIC = b"TOKBLK01"
HEAD = struct.Struct("<8s32sII")
# The dictionary: its bytes, and the sample it is trained on (documents of at most so many
# characters, picked by a hash of their ids and texts).
DICT_BYTES = 64 * 1024
SAMPLE_DOCS = 1_000
SAMPLE_CHARS = 20_000
RATE_STEPS = 10_000_000
LEVEL = 3
# A block closes at so many compressed bytes or documents.
BLOCK_BYTES = 2_000_000
BLOCK_DOCS = 4_096
# Starts of so many shards (16 bytes each) are sent to the readers; more are joined by a shuffle.
BROADCAST_SHARDS = 1_000_000

BLOCKS = T.StructType([
    T.StructField("shard", T.IntegerType()), T.StructField("shard_start", T.LongType()),
    T.StructField("first_id", T.LongType()), T.StructField("last_id", T.LongType()),
    T.StructField("n_docs", T.IntegerType()), T.StructField("n_tokens", T.LongType()),
    T.StructField("block", T.BinaryType()),
])
DOCS = T.StructType([
    T.StructField("doc", T.LongType()), T.StructField("start", T.LongType()),
    T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()),
])


def id_width(tokenizer: str) -> int:
    from tokenizers import Tokenizer

    return 2 if Tokenizer.from_file(tokenizer).get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4


def train_dictionary(docs: DataFrame, tokenizer: str, end_id: int, *, id_col: str, text_col: str) -> bytes:
    """Dictionary from a bounded sample; b"" where the sample is too small to train on."""
    import zstandard

    from loadsmith.llm._tokens import SegmentEncoder

    src = docs.select(F.col(f"`{text_col}`").alias("text"), F.xxhash64(f"`{id_col}`", f"`{text_col}`", F.lit(17)).alias("h"))
    # About SAMPLE_DOCS documents: a share of the hashes, known from the number of rows.
    share = min(RATE_STEPS, max(1, round(RATE_STEPS * SAMPLE_DOCS / max(1, docs.count()))))
    sample = src.where((F.pmod("h", F.lit(RATE_STEPS)) < share) & F.length("text").between(1, SAMPLE_CHARS))
    # Equal rows are picked together but taken once, and never more than twice the number wanted.
    texts = sorted(r.text for r in sample.dropDuplicates(["h"]).orderBy("h").limit(2 * SAMPLE_DOCS).collect())
    if len(texts) < 16:
        return b""
    kind = f"<u{id_width(tokenizer)}"
    parts = [(np.frombuffer(x, "<u4").astype(kind).tobytes()) for x in SegmentEncoder(tokenizer).encode(texts)]
    try:
        return zstandard.train_dictionary(min(DICT_BYTES, sum(map(len, parts)) // 8), parts, level=LEVEL).as_bytes()
    except zstandard.ZstdError:                     # too little text
        return b""


def _codec(dictionary: bytes):
    import zstandard

    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return (zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_checksum=False),
            zstandard.ZstdDecompressor(dict_data=shared))


def pack_block(dictionary_hash: bytes, width: int, docs: list, counts: list[int], frames: list[bytes]) -> bytes:
    n = len(docs)
    return b"".join([
        HEAD.pack(MAGIC, dictionary_hash, n, width),
        np.asarray([d is None for d in docs], "u1").tobytes(),
        np.asarray([d or 0 for d in docs], "<i8").tobytes(), np.asarray(counts, "<u8").tobytes(),
        np.concatenate(([0], np.cumsum([len(f) for f in frames]))).astype("<u8").tobytes(), *frames])


def open_block(block: bytes, dictionary_hash: bytes):
    """(document ids, ids in each, offsets of the frames in ``block``, bytes of an id)."""
    magic, shared, n, width = HEAD.unpack_from(block)
    if magic != MAGIC or shared != dictionary_hash:
        raise ValueError("not a token block, or written with another dictionary")
    at = HEAD.size
    null = np.frombuffer(block, "u1", n, at)
    ids = np.frombuffer(block, "<i8", n, at + n)
    counts = np.frombuffer(block, "<u8", n, at + 9 * n)
    index = np.frombuffer(block, "<u8", n + 1, at + 17 * n).astype(np.int64) + at + 17 * n + 8 * (n + 1)
    return [None if x else i for x, i in zip(null.tolist(), ids.tolist(), strict=True)], counts.tolist(), index, width


def _write_task(tokenizer: str, end_id: int, dictionary: bytes, width: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        from loadsmith.llm._tokens import encoder, text_batches

        tokens, shard = encoder(tokenizer), TaskContext.get().partitionId()
        compress, digest = _codec(dictionary)[0].compress, hashlib.sha256(dictionary).digest()
        end, start = np.asarray([end_id], "<u4").tobytes(), 0
        docs, counts, frames, size = [], [], [], 0

        def closed():
            block = pack_block(digest, width, docs, counts, frames)
            known = [d for d in docs if d is not None]
            row = [shard, start, known[0] if known else None, known[-1] if known else None, len(docs), sum(counts), block]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(row, [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(),
                                                        pa.int64(), pa.binary()], strict=True)], names=BLOCKS.names)

        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            keys = batch.column("doc").to_pylist()
            for a, b in text_batches(texts):
                for key, x in zip(keys[a:b], tokens.encode(texts[a:b]), strict=True):
                    ids = np.frombuffer(x + end, "<u4")
                    frame = compress(ids.astype(f"<u{width}").tobytes())
                    docs.append(key)
                    counts.append(len(ids))
                    frames.append(frame)
                    size += len(frame)
                    if size >= BLOCK_BYTES or len(docs) >= BLOCK_DOCS:
                        yield closed()
                        start += sum(counts)
                        docs, counts, frames, size = [], [], [], 0
        if docs:
            yield closed()
        tokens.clear()

    return run


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int, *, id_col: str = "doc_id",
                      text_col: str = "text") -> str:
    """Encode whole texts and write the container at ``path``, documents in ascending order."""
    spark = docs.sparkSession
    dictionary = train_dictionary(docs, tokenizer, end_id, id_col=id_col, text_col=text_col)
    spark.createDataFrame([(hashlib.sha256(dictionary).hexdigest(), dictionary)], "hash string, bytes binary") \
        .coalesce(1).write.parquet(f"{path}/dictionary")
    # Range partitions of (id, hash of the text, row): ordered, and neither one id nor equal rows can fill a task.
    order = ["doc", "tie", "row"]
    src = (docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.col(f"`{text_col}`").alias("text"))
           .withColumns({"tie": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
           .repartitionByRange(*order).sortWithinPartitions(*order).select("doc", "text"))
    blocks = src.mapInArrow(_write_task(tokenizer, end_id, dictionary, id_width(tokenizer)), BLOCKS)
    blocks.write.option("compression", "none").parquet(f"{path}/blocks")
    return path


def _dictionary(spark: SparkSession, path: str) -> bytes:
    row = spark.read.parquet(f"{path}/dictionary").first()      # one row of at most DICT_BYTES
    if hashlib.sha256(bytes(row["bytes"])).hexdigest() != row["hash"]:
        raise ValueError(f"the dictionary in {path} is damaged")
    return bytes(row["bytes"])


def _read_task(dictionary: bytes, wanted: frozenset | None):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        decompress, digest = _codec(dictionary)[1].decompress, hashlib.sha256(dictionary).digest()
        for batch in batches:
            for base, block in zip(batch.column("start").to_pylist(), batch.column("block").to_pylist(), strict=True):
                docs, counts, index, width = open_block(block, digest)
                starts = np.concatenate(([0], np.cumsum(counts)[:-1])) + base
                take = [i for i, d in enumerate(docs) if wanted is None or d in wanted]
                for at in range(0, len(take), 512):
                    part = take[at:at + 512]
                    ids = [np.frombuffer(decompress(block[index[i]:index[i + 1]]), f"<u{width}").astype("<u4").tobytes()
                           for i in part]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([docs[i] for i in part], pa.int64()), pa.array([starts[i] for i in part], pa.int64()),
                         pa.array([counts[i] for i in part], pa.int64()), pa.array(ids, pa.binary())], names=DOCS.names)

    return run


def read_token_files(spark: SparkSession, path: str, doc_ids=None) -> DataFrame:
    """(doc, start, n_tokens, ids) of all documents, or of the few named ones: then only the
    blocks that span them are read and only their frames decompressed."""
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    # A shard's start: the tokens of all shards before it (one row per written shard).
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n")) \
        .select("shard", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base"))
    shards = materialize(shards, "shards")
    if shards.count() <= BROADCAST_SHARDS:
        shards = F.broadcast(shards)
    wanted = None
    if doc_ids is not None:
        wanted = frozenset(doc_ids)
        spans = [(F.col("first_id") <= d) & (F.col("last_id") >= d) for d in sorted(wanted)]
        blocks = blocks.where(reduce(or_, spans, F.lit(False)))
    placed = blocks.join(shards, "shard").select((F.col("base") + F.col("shard_start")).alias("start"), "block")
    return placed.mapInArrow(_read_task(_dictionary(spark, path), wanted), DOCS)
