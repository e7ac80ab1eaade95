"""Token ids in training order as fixed-stride shards.

Texts are tokenised and packed, task by task, into sequences of ``length`` ids, an end
mark after each document; the last sequence of a task is filled up with end marks. The
sequences get dense numbers 0..N-1, and a keyed Feistel permutation with cycle-walking
maps each to its global slot. Shard k holds the slots from k * rows on, sorted, so a
reader goes on at any slot by one division.

Defined cases: a null text counts as empty (its end mark only); repeated rows are packed
each; an empty table gives no sequences; texts longer than a sequence run on in the next.
Numbers follow the input's partitions, so the same files and split settings give the same
order; the staged sequences stay in the shared folder, and a lost task reads them again.
"""

from __future__ import annotations

import base64
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import tiktoken
from pyspark import SparkFiles, TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hubcast.session import ensure_checkpoint_dir

ROUNDS, WALKS = 6, 256
BROADCAST_PARTS = 100_000  # rows of 16 bytes up to which the tasks' offsets are broadcast; joined beyond


def feistel(x: Column, half: int, key: int) -> Column:
    """A keyed permutation of the numbers below 2^(2 * half)."""
    mask = F.lit((1 << half) - 1)

    def turn(at: Column, r: Column) -> Column:  # the halves change places, one of them mixed
        right = at.bitwiseAND(mask)
        mixed = F.shiftright(at, half).bitwiseXOR(F.xxhash64(right, F.lit(key), r).bitwiseAND(mask))
        return F.shiftleft(right, half).bitwiseOR(mixed)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), x, turn)


def slot(number: Column, total: int, key: int) -> Column:
    """Where sequence ``number`` of ``total`` goes: the permutation is walked on until it falls below ``total``.

    A step misses with a chance under three quarters, so a walk of 256 steps is not left open in practice; one
    that is raises an error.
    """
    half = max(1, math.ceil(math.log2(max(total, 2)) / 2))
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), feistel(number.cast("long"), half, key),
                         lambda at, _: F.when(at < total, at).otherwise(feistel(at, half, key)))
    return F.when(walked < total, walked).otherwise(F.raise_error(F.lit("cycle walk not closed")).cast("long"))


def _encoding(path: str, pattern: str) -> tiktoken.Encoding:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("shards", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pack(docs: DataFrame, ranks_file: str, pattern: str, end_mark: int, length: int = 2048) -> DataFrame:
    """Rows (part, local, first_doc, n_ids, ids): ``ids`` are little-endian 16-bit, ``length`` of them."""
    docs.sparkSession.sparkContext.addFile(ranks_file)
    name = ranks_file.rsplit("/", 1)[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, local = _encoding(SparkFiles.get(name), pattern).encode_ordinary, TaskContext.get().partitionId(), 0
        held, held_n, starts = [], 0, []  # ids not sent yet, and (place, doc_id) of the documents in them

        def send(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, held_n, starts, local
            ids = np.concatenate(held) if held else np.empty(0, "<u2")
            k = -(-len(ids) // length) if last else len(ids) // length
            if k:
                real = np.minimum(length, len(ids) - np.arange(k) * length)
                full = np.concatenate([ids, np.full(max(0, k * length - len(ids)), end_mark, "<u2")])[:k * length]
                of = np.searchsorted([s for s, _ in starts], np.arange(k) * length, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(k, part, np.int32)), pa.array(np.arange(local, local + k)),
                     pa.array([starts[i][1] for i in of], pa.int64()), pa.array(real.astype(np.int32)),
                     pa.array([full[i * length:(i + 1) * length].tobytes() for i in range(k)], pa.binary())],
                    names=["part", "local", "first_doc", "n_ids", "ids"])
                cut = k * length
                starts = [(max(0, s - cut), d) for i, (s, d) in enumerate(starts)
                          if s >= cut or i + 1 == len(starts) or starts[i + 1][0] > cut]
                held, held_n, local = [ids[cut:]], max(0, len(ids) - cut), local + k

        for b in batches:
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                ids = np.array([*encode(text or ""), end_mark], "<u2")
                starts.append((held_n, doc))
                held.append(ids)
                held_n += len(ids)
                if held_n >= 256 * length:
                    yield from send(False)
        yield from send(True)

    return docs.select("doc_id", "text").mapInArrow(
        run, "part int, local bigint, first_doc bigint, n_ids int, ids binary")


def training_order(packed: DataFrame, rows: int = 4096, key: int = 20240229) -> DataFrame:
    """slot, shard, row, first_doc, n_ids, ids; partition k is the slot range of shard k, in order.

    Slots are dense, so the ranges are known and no sample has to find them.

    The packed sequences are staged in the shared folder, as their number must be
    known before the first of them has a slot; one count per task goes into the offsets.
    """
    spark = packed.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/sequences-{uuid.uuid4().hex}"
    packed.write.option("compression", "zstd").parquet(path)
    staged = spark.read.parquet(path)
    counts = staged.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    total, parts = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    if parts <= BROADCAST_PARTS:
        offsets = F.broadcast(offsets)
    placed = staged.join(offsets, "part").withColumn("slot", slot(F.col("offset") + F.col("local"), total, key))
    shards = max(1, -(-total // rows))
    return (placed.withColumn("shard", F.floor(F.col("slot") / rows).cast("int"))
            .repartitionById(shards, F.col("shard")).sortWithinPartitions("slot")
            .select("slot", "shard", (F.col("slot") % rows).cast("int").alias("row"), "first_doc", "n_ids", "ids"))


def write_shards(ordered: DataFrame, uri: str) -> DataFrame:
    """Writes ``uri/shard-NNNNNN.bin``, the ids of a shard's rows one after the other; returns (shard, rows).

    ``uri`` is any folder that pyarrow's file systems reach from all executors. A file is
    written under a name of its own and then moved, so a repeated task does no harm.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pyarrow.fs.FileSystem.from_uri(uri)
        fs.create_dir(root, recursive=True)
        out, at, n, own = None, None, 0, ""

        def close() -> pa.RecordBatch:
            out.close()
            fs.move(own, f"{root}/shard-{at:06d}.bin")
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([n], pa.int64())], names=["shard", "rows"])

        for b in batches:
            for shard, ids in zip(b.column("shard").to_pylist(), b.column("ids").to_pylist()):
                if shard != at:
                    if out is not None:
                        yield close()
                    at, n, own = shard, 0, f"{root}/.shard-{shard:06d}-{uuid.uuid4().hex}"
                    out = fs.open_output_stream(own)
                out.write(ids)
                n += 1
        if out is not None:
            yield close()

    return ordered.select("shard", "ids").mapInArrow(run, "shard int, rows bigint")


def read_from(uri: str, start: int, rows: int, length: int) -> Iterator[np.ndarray]:
    """The sequences from global slot ``start`` on, in training order."""
    fs, root = pyarrow.fs.FileSystem.from_uri(uri)
    shard, skip = divmod(start, rows)
    while fs.get_file_info(f"{root}/shard-{shard:06d}.bin").type == pyarrow.fs.FileType.File:
        with fs.open_input_file(f"{root}/shard-{shard:06d}.bin") as f:
            f.seek(skip * length * 2)
            while piece := f.read(length * 2):
                yield np.frombuffer(piece, "<u2")
        shard, skip = shard + 1, 0
