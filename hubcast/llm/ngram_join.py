"""N-gram Jaccard join: documents whose sets of word shingles are similar.

Token-combination prefixes. A counting sketch over all documents sets apart frequent
shingles. In the order rare before frequent, a document's prefix is one longer than the
number of shingles that a partner may lack; rare shingles of the prefix are signatures
of their own. A document whose rare shingles don't fill the prefix is extended over all
its shingles: its frequent ones are dealt to more groups than a partner can differ in,
and the combination in each group is a signature. Similar documents share a signature:

* if both prefixes are rare, by the usual prefix argument;
* if one is extended, it lists all its rare shingles, and the other's prefix holds one of them;
* if both are, either a rare shingle is common, or all differences outnumbered by the groups.

The first rare shingle that two similar documents share stands early in the order of both: what comes before it in
one is lacking in the other. So a short list gives only pairs for which its shingle may be that first one.

Documents with equal sets are one node from the start. Short lists of a signature give
pairs, long ones are compared in place by parity bitmaps (the bits that differ never
exceed the shingles that do) and give the edges of a spanning forest. Every edge is
verified on the texts. A node counts in its largest list at first, so a group that shares many
signatures gives its edges once; then lists whose nodes are still in several classes give
edges between the classes, and a list with a failed edge gives all its open pairs. So each
link is either verified or inside a class that is joined already.

Lists that hold almost the same nodes share the node of the smallest hash, as a rule, and are
merged by it into one list of all their nodes, unless that were longer than a block or had
far more pairs than the lists by themselves. So near copies, which share most of their signatures,
come once and not once for each signature; no pair that shares a signature is lost by it. Lists that meet
in one bucket are merged there, before they are written.

A list of many nodes is cut, in order of size, into blocks of bounded length that overlap
a little; the above holds for each block, and near copies of one text come out as one
class. Then only nodes outside the largest class of their list are compared with its
other blocks, each block a step of its own.

Defined cases: a text without words, or null, has an empty set and is linked with nothing;
fewer words than a shingle make one shingle of all; sets of five or fewer link only
when equal; rows that repeat a doc_id are each a member; a row with null doc_id joins
only documents of equal set; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hubcast.llm import common
from hubcast.llm.components import components

U = np.uint64
MUL, SHIFT = U(0x9E3779B97F4A7C15), U(29)
SKETCH_BITS, CHUNK_BITS = 23, 17
STEPS = 8  # codes of a count for each power of two
COUNTS = 2.0 ** (np.arange(256) / STEPS) - 1  # what the codes stand for
SHORT = 8  # nodes up to which a signature's list gives its pairs
BLOCK = 1024  # nodes of a block of a list, on average; four times as many at most
ROW_PAIRS = 64  # pairs compared in the time that one row of a list takes, about
OVERLAP = 32  # nodes of the next block that a block sees too
CHUNK_BYTES = 8192  # about what a row of nodes that go to another block holds


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> SHIFT)) * MUL
    return x ^ (x >> U(32))


def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct n-word shingles, A-Z lower-cased."""
    w = text.encode().lower().split() if text else []
    if not w:
        return np.empty(0, U)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, w), U, len(w))
    k = min(n, len(h))
    out = np.full(len(h) - k + 1, U(k))
    for i in range(k):
        out = mix(out) + h[i:len(h) - k + 1 + i]
    return np.unique(mix(out))


def set_hash(s: np.ndarray) -> int:
    return int(np.frombuffer(xxhash.xxh3_64_digest(s.tobytes()), ">i8")[0])


def parity(s: np.ndarray) -> np.ndarray:
    """Parity bitmap of twice as many bits as shingles, rounded up to a power of two (64 at least)."""
    bits = max(64, 1 << int(2 * len(s) - 1).bit_length())
    odd = np.bincount((s & U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(U)


def fold(rows: np.ndarray) -> np.ndarray:
    half = rows.shape[1] // 2
    return rows[:, :half] ^ rows[:, half:]


def sketch(docs: DataFrame, n: int) -> tuple[np.ndarray, float]:
    """How many documents hold a shingle of each hash class, over all documents, as codes of COUNTS; the mean count.

    2^SKETCH_BITS codes of a byte (8 MB) at any input size: a task sends its own counts in compressed
    chunks, which are added up chunk by chunk; only the codes of the sums come to the driver.
    """
    size, chunk = 1 << SKETCH_BITS, 1 << CHUNK_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(size, "<u4")
        for b in batches:
            for t in b.column(0).to_pylist():
                own[(shingles(t, n) >> U(64 - SKETCH_BITS)).astype(np.int64)] += 1  # once for a document
        for i, part in enumerate(own.reshape(-1, chunk)):
            if part.any():  # the lowest bytes by themselves, as the others are nearly all zero
                packed = zlib.compress(part.astype(np.uint8).tobytes() + (part >> 8).tobytes(), 1)
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([packed], pa.binary())], names=["chunk", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for c, x in zip(b.column("chunk").to_pylist(), b.column("counts").to_pylist()):
                x = zlib.decompress(x)
                sums[c] = sums.get(c, 0) + np.frombuffer(x, np.uint8, chunk) + (np.frombuffer(x, "<u4", offset=chunk).astype(np.int64) << 8)
        codes = [np.minimum(STEPS * np.log2(v + 1.0), 255).astype(np.uint8).tobytes() for v in sums.values()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array(codes, pa.binary()), pa.array([int(v.sum()) for v in sums.values()], pa.int64())],
            names=["chunk", "codes", "total"])

    got = (docs.select("text").mapInArrow(count, "chunk int, counts binary").repartition(size // chunk, "chunk")
           .mapInArrow(add, "chunk int, codes binary, total bigint").collect())
    out = np.zeros(size, np.uint8)
    for r in got:
        out[r["chunk"] * chunk:(r["chunk"] + 1) * chunk] = np.frombuffer(r["codes"], np.uint8)
    return out, sum(r["total"] for r in got) / size


def signatures(s: np.ndarray, seen: np.ndarray, percent: int, frequent: float, noise: float = 0.0) -> np.ndarray:
    """The signatures of a set, first the rare shingles in their order; ``seen`` is the sketch's count of each of its shingles.

    The order is by the count itself, which is never too low: also below ``noise``, which takes no
    part, the smallest counts are those of shingles that few documents hold.
    """
    n = len(s)
    lacking = n - -(-percent * n // 100)  # shingles that a partner may lack
    if lacking == 0 and 100 * n < percent * (n + 1):
        return np.empty(0, U)  # links only to its equal
    rare = seen < frequent
    ranked = np.lexsort((s, seen))
    ranked = s[ranked[rare[ranked]]]
    if len(ranked) > lacking:
        return ranked[:lacking + 1]
    out, often, ratio = [], s[~rare], 100 / percent
    band = int(np.log(n) / np.log(ratio) + 1e-9)
    for scheme in (band, band + 1):  # two similar sets lie in one band or in neighbours
        differ = int((100 - percent) / percent * ratio ** (scheme + 1)) + 1
        groups = int(1.1 * (differ + 1)) + 1
        while True:
            of = (mix(often ^ U(groups)) % U(groups)).astype(np.int64)
            order = np.lexsort((often, of))
            first = np.flatnonzero(np.diff(of[order], prepend=-1))
            token = mix(often[order])
            combined = np.add.reduceat(token, first) + MUL * of[order][first].astype(U)
            out.append(mix(mix(combined) + mix(np.array([scheme << 32 | groups], U))))
            if len(first) > differ or groups > 64 * n:
                break
            groups = groups * 3 // 2 + 1
    return np.concatenate([ranked, np.unique(np.concatenate(out))])


def describe(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, node (hash of the set), parity and signatures, written to the shared folder.

    ``ranked`` is how many of the signatures, the first ones, are rare shingles in their order.
    """
    codes, mean = sketch(docs, n)
    frequent = max(256.0, 8 * mean)
    shared = docs.sparkSession.sparkContext.broadcast(codes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = shared.value
        for b in batches:
            for part in (b.slice(i, 1024) for i in range(0, b.num_rows, 1024)):
                rows = []
                for t in part.column("text").to_pylist():
                    s = shingles(t, n)
                    if not len(s):
                        rows.append((0, None, b"", b"", 0))
                        continue
                    often = COUNTS[seen[(s >> U(64 - SKETCH_BITS)).astype(np.int64)]]
                    sig = signatures(s, often, percent, frequent)
                    ranked = min(len(sig), int((often < frequent).sum()))
                    rows.append((len(s), set_hash(s), parity(s).tobytes() if len(sig) else b"", sig.tobytes(), ranked))
                cols = list(zip(*rows))
                kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int32())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(list(c), k) for c, k in zip(cols, kinds))],
                                                 names=["doc_id", "n_shingles", "node", "parity", "signatures", "ranked"])

    return common.cut(docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, n_shingles bigint, node bigint, parity binary, signatures binary, ranked int"))


def _sorted_rows(rows: np.ndarray) -> np.ndarray:
    """Distinct (sig, n, node) rows in that order."""
    rows = rows[np.lexsort((rows["node"], rows["n"], rows["sig"]))]
    if not len(rows):
        return rows
    new = (rows["sig"][1:] != rows["sig"][:-1]) | (rows["node"][1:] != rows["node"][:-1])
    return rows[np.concatenate([[True], new])]


def _united(rows: np.ndarray, block: int) -> np.ndarray:
    """Whole long lists in order of (sig, n, node), those of one block with the same smallest node hash as one list, of
    their smallest sig, if it is of one block too and its pairs cost no more than the rows and pairs of the lists apart."""
    if not len(rows):
        return rows
    begin = np.flatnonzero(np.diff(rows["sig"], prepend=~rows["sig"][:1]))
    length = np.diff(np.append(begin, len(rows)))
    hashed = mix(rows["node"].astype(U))
    keys, of = np.unique(np.minimum.reduceat(hashed, begin), return_inverse=True)
    one = length <= 2 * block
    member = np.stack([np.repeat(of, length), hashed.view(np.int64)], 1)[np.repeat(one, length)]
    nodes = np.bincount(np.unique(member, axis=0)[:, 0], minlength=len(keys))
    cost = np.bincount(of, one * length * (length + ROW_PAIRS), len(keys))
    fits = (nodes <= 2 * block) & (nodes * nodes <= cost)
    least = np.full(len(keys), ~U(0))
    np.minimum.at(least, of[one], rows["sig"][begin[one]])
    rows = rows.copy()
    rows["sig"] = np.repeat(np.where(one & fits[of], least[of], rows["sig"][begin]), length)
    return _sorted_rows(rows)


def _blocks(rows: np.ndarray, block: int) -> np.ndarray:
    """The number of the block of each row in its list, for whole lists in order of (sig, n, node).

    Blocks begin at nodes of certain hashes, so lists of almost the same nodes have almost the same blocks.
    """
    at = np.arange(len(rows))
    first = np.diff(rows["sig"], prepend=~rows["sig"][:1]) != 0
    begin = np.flatnonzero(first)
    length = np.diff(np.append(begin, len(rows)))
    cut = first | ((mix(rows["node"].astype(U)) % U(block) == 0) & np.repeat(length > 2 * block, length))
    within = at - np.maximum.accumulate(np.where(cut, at, 0))
    number = np.cumsum(cut | (within % (4 * block) == 0))
    return (number - np.repeat(number[begin], length)).astype(np.int32)


def _lists(described: DataFrame, percent: int, block: int = BLOCK) -> DataFrame:
    """(long, x, y, block, home, key, size): pairs of nodes from short lists (long false), (signature, node) of
    long ones by block; the nodes that the block before sees too are there again, with home false.
    ``key`` is the smallest hash of a block's own nodes, ``size`` its number of rows. Long lists of almost the same
    nodes that meet in a bucket are one already.

    Signatures travel packed, a row for each batch and bucket; a node is sent once
    for a signature and batch, however many copies it has there.
    """
    buckets = common.partitions(described.sparkSession)
    kind = np.dtype([("sig", "<u8"), ("n", "<i4"), ("rank", "<i4"), ("node", "<i8")])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sigs = [np.frombuffer(x, U) for x in b.column("signatures").to_pylist()]
            rows = np.zeros(sum(map(len, sigs)), kind)
            if not len(rows):
                continue
            times = [len(x) for x in sigs]
            rows["sig"] = np.concatenate(sigs)
            rows["n"] = np.repeat(b.column("n_shingles").to_numpy(zero_copy_only=False), times)
            place = np.arange(len(rows)) - np.repeat(np.cumsum(times) - times, times)
            rows["rank"] = np.where(place < np.repeat(b.column("ranked").to_numpy(zero_copy_only=False), times), place, 0)
            rows["node"] = np.repeat(np.array([x or 0 for x in b.column("node").to_pylist()], np.int64), times)
            rows = _sorted_rows(rows)
            to = (mix(rows["sig"]) % U(buckets)).astype(np.int64)
            rows = rows[np.argsort(to, kind="stable")]
            at = np.searchsorted(np.sort(to), np.arange(buckets + 1))
            full = np.flatnonzero(np.diff(at))
            yield pa.RecordBatch.from_arrays(
                [pa.array(full.astype(np.int32)), pa.array([rows[at[i]:at[i + 1]].tobytes() for i in full], pa.binary())],
                names=["bucket", "rows"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by: dict[int, list[np.ndarray]] = {}
        for b in batches:
            for k, x in zip(b.column("bucket").to_pylist(), b.column("rows").to_pylist()):
                by.setdefault(k, []).append(np.frombuffer(x, kind))
        for k in list(by):
            rows = _sorted_rows(np.concatenate(by.pop(k)))
            first = np.flatnonzero(np.diff(rows["sig"], prepend=~rows["sig"][:1]))
            length = np.diff(np.append(first, len(rows)))
            pairs = []
            for size in range(2, SHORT + 1):
                at = first[length == size][:, None] + np.arange(size)
                for i in range(size):
                    for j in range(i + 1, size):
                        a, b2 = rows[at[:, i]], rows[at[:, j]]  # n is in order
                        na, nb = a["n"].astype(np.int64), b2["n"].astype(np.int64)
                        both = -(-percent * (na + nb) // (100 + percent))  # shingles that similar sets share
                        ok = (100 * na >= percent * nb) & (a["rank"] <= na - both) & (b2["rank"] <= nb - both) & (a["node"] != b2["node"])
                        pairs.append(np.stack([np.minimum(a["node"], b2["node"])[ok], np.maximum(a["node"], b2["node"])[ok]], 1))
            p = np.unique(np.concatenate(pairs), axis=0)
            long = _united(rows[np.repeat(length > SHORT, length)], block)
            of = _blocks(long, block)
            begins = np.flatnonzero((np.diff(of, prepend=-1) != 0) | (np.diff(long["sig"], prepend=~long["sig"][:1]) != 0))
            within = np.arange(len(of)) - np.repeat(begins, np.diff(np.append(begins, len(of))))
            seen = (of > 0) & (within < OVERLAP)
            at = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(of))))  # its block's place among all
            at = np.concatenate([at, at[seen] - 1])
            keys = np.minimum.reduceat(mix(long["node"].astype(U)), begins) if len(begins) else np.empty(0, U)
            key, in_block = keys.view(np.int64)[at], np.bincount(at, minlength=len(begins))[at]
            long, of, home = np.concatenate([long, long[seen]]), np.concatenate([of, of[seen] - 1]), np.arange(len(of) + seen.sum()) < len(of)
            for lo in range(0, len(p) + len(long), 100_000):
                ps, ls = p[lo:lo + 100_000], slice(max(0, lo - len(p)), max(0, lo + 100_000 - len(p)))
                pad = lambda x, fill: np.concatenate([np.full(len(ps), fill, x.dtype), x[ls]])  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pad(np.ones(len(long), bool), False)),
                     pa.array(np.concatenate([ps[:, 0], long["sig"].view(np.int64)[ls]])),
                     pa.array(np.concatenate([ps[:, 1], long["node"][ls]])),
                     pa.array(pad(of, 0)), pa.array(pad(home, True)), pa.array(pad(key, 0)), pa.array(pad(in_block, 0))],
                    names=["long", "x", "y", "block", "home", "key", "size"])

    dealt = described.filter("length(signatures) > 0").select("n_shingles", "node", "signatures", "ranked").mapInArrow(
        deal, "bucket int, rows binary")
    return common.cut(dealt.repartition(buckets, "bucket").mapInArrow(
        meet, "long boolean, x bigint, y bigint, block int, home boolean, key bigint, size bigint"))


def _merged(lists: DataFrame, block: int = BLOCK) -> DataFrame:
    """(sig, block, node) of the long lists; those with the same key are one, of block -1, where they fit together.

    They fit if all their nodes are no more than a block holds and the pairs of these cost no more than
    the rows and pairs of the lists apart.
    """
    long = lists.filter("long").select(F.col("x").alias("sig"), "block", F.col("y").alias("node"), "key", "size")
    members = common.cut(long.groupBy("key", "node").agg(F.sum(F.col("size") + ROW_PAIRS).alias("cost")))
    whole = members.groupBy("key").agg(F.count(F.lit(1)).alias("nodes"), F.sum("cost").alias("cost"))
    alone = common.small(common.cut(whole.filter(
        (F.col("nodes") > 4 * block + OVERLAP) | (F.col("nodes") * F.col("nodes") > F.col("cost"))).select("key")))
    return members.join(alone, "key", "left_anti").select(F.col("key").alias("sig"), F.lit(-1).alias("block"), "node").unionByName(
        long.join(alone, "key", "left_semi").select("sig", "block", "node"))


def _close(na: np.ndarray, nb: np.ndarray, differ: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of these sizes whose bitmaps differ in so many bits may be similar."""
    return differ * (100 + percent) <= (100 - percent) * (na + nb)


def _filter_pairs(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, na, nb, pa, pb) whose bitmaps allow the link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for na, nb, x, y in zip(*(b.column(c).to_pylist() for c in ("na", "nb", "pa", "pb"))):
                x, y = np.frombuffer(x, U), np.frombuffer(y, U)
                while len(x) > len(y):
                    x = fold(x[None])[0]
                while len(y) > len(x):
                    y = fold(y[None])[0]
                keep.append(_close(na, nb, int(np.bitwise_count(x ^ y).sum()), percent))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.mapInArrow(run, "a bigint, b bigint")


class _Forest:
    def __init__(self, size: int):
        self.up = list(range(size))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def _compare(node: np.ndarray, n: np.ndarray, bitmaps: list[bytes], percent: int, group: np.ndarray, every: bool,
             hubs: bool = False, block: int = 256) -> list[tuple[int, int]]:
    """Edges among the nodes of one list, in order of size: pairs of different groups that may be similar.

    ``every`` one of them, or a spanning forest of the groups: of the closest pairs, or of those
    with the nodes that are close to most (``hubs``), for groups that their closest pairs left apart.
    """
    width = np.array([len(x) // 8 for x in bitmaps])
    forest, edges = _Forest(len(node)), []
    _, first, of = np.unique(group, return_index=True, return_inverse=True)
    for i, j in enumerate(first[of]):
        forest.join(i, int(j))
    for w in np.unique(width):
        own = np.flatnonzero(width == w)
        more = np.flatnonzero(width == 2 * w)
        at = np.concatenate([own, more])
        rows = np.frombuffer(b"".join(bitmaps[i] for i in own), U).reshape(len(own), w)
        if len(more):
            rows = np.concatenate([rows, fold(np.frombuffer(b"".join(bitmaps[i] for i in more), U).reshape(len(more), 2 * w))])
        for lo in range(0, len(own), block):
            hi = min(lo + block, len(own))
            end = int(np.searchsorted(n[at], 100 * n[at[hi - 1]] // percent, "right"))  # wider bitmaps: larger sets
            differ = np.zeros((hi - lo, end - lo), np.int64)
            for k in range(w):
                differ += np.bitwise_count(rows[lo:hi, k, None] ^ rows[None, lo:end, k])
            ok = np.triu(_close(n[at[lo:hi], None], n[at[lo:end]][None], differ, percent), 1)
            i, j = np.nonzero(ok)
            near = np.lexsort((differ[i, j], -np.maximum(ok.sum(1)[i], ok.sum(0)[j]) * hubs))
            for i, j in zip(at[lo + i[near]], at[lo + j[near]]):
                if every:
                    if group[i] != group[j]:
                        edges.append((node[i], node[j]))
                elif forest.join(int(i), int(j)):
                    edges.append((node[i], node[j]))
    return edges


def _long_edges(entries: DataFrame, percent: int, every: bool, hubs: bool = False) -> DataFrame:
    """(sig, block, a, b) from rows (sig, block, node, n, parity, grp), one block at a time in order of size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def done() -> Iterator[pa.RecordBatch]:
            node, n, bitmaps, group = zip(*(r[2:] for r in held))
            e = _compare(np.array(node), np.array(n), list(bitmaps), percent, np.array(group), every, hubs)
            if e:
                a, b = (pa.array(list(map(int, x)), pa.int64()) for x in zip(*e))
                yield pa.RecordBatch.from_arrays([pa.array([held[0][0]] * len(e), pa.int64()), pa.array([held[0][1]] * len(e), pa.int32()), a, b],
                                                 names=["sig", "block", "a", "b"])

        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in ("sig", "block", "node", "n", "parity", "grp"))):
                if held and held[0][:2] != r[:2]:
                    yield from done()
                    held = []
                held.append(r)
        if held:
            yield from done()

    n = common.partitions(entries.sparkSession)
    return entries.repartition(n, "sig", "block").sortWithinPartitions("sig", "block", "n", "node").mapInArrow(
        run, "sig bigint, block int, a bigint, b bigint")


def _classed(entries: DataFrame, links: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """``entries`` (sig, block, node) with the class (grp) of their nodes, of those blocks whose nodes lie in several classes.

    ``only`` (sig, block) names the blocks to look at, else all. Of blocks of the same nodes (by 128 bits of their hashes) one stays; they would give the same edges.
    """
    grouped = entries.join(components(links), "node", "left").withColumn("grp", F.coalesce("component", "node")).drop("component")
    several = grouped.groupBy("sig", "block").agg(
        F.min("grp").alias("least"), F.max("grp").alias("most"), F.count(F.lit(1)).alias("k"),
        F.bit_xor(F.xxhash64("node")).alias("h1"), F.bit_xor(F.xxhash64("node", F.lit(7))).alias("h2")).filter("least < most")
    if only is not None:
        several = several.join(only, ["sig", "block"], "left_semi")
    one = several.groupBy("k", "h1", "h2").agg(F.min(F.struct("sig", "block")).alias("of")).select("of.sig", "of.block")
    return common.cut(grouped.join(one, ["sig", "block"], "left_semi"))


def _apart(entries: DataFrame, links: DataFrame) -> DataFrame:
    """``entries`` (sig, block, node) of lists whose nodes lie in several classes, with the class (grp) and whether it is not the list's largest."""
    grouped = entries.join(components(links), "node", "left").select("sig", "block", "node", F.coalesce("component", "node").alias("grp"))
    sizes = grouped.groupBy("sig", "grp").agg(F.count(F.lit(1)).alias("k"))
    main = sizes.groupBy("sig").agg(F.max(F.struct("k", "grp"))["grp"].alias("main"), F.count(F.lit(1)).alias("classes"))
    return grouped.join(main.filter("classes > 1"), "sig").select(*grouped.columns, (F.col("grp") != F.col("main")).alias("minor"))


def _cross_edges(apart: DataFrame, percent: int, every: bool) -> DataFrame:
    """(sig, a, b): pairs that may be similar, from different blocks of a list and different classes.

    The nodes outside the largest class go, some to a row, to each block whose sizes fit; a
    task holds one block. A block gives a spanning forest of the classes, or ``every`` pair.
    """
    lists = "nodes array<bigint>, ns array<bigint>, grps array<bigint>, bitmaps array<binary>"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig, block, n, bitmaps = (batch.column(c).to_pylist() for c in ("sig", "block", "n", "parity"))
            cuts, held = [0], 0
            for i in range(batch.num_rows):
                if i and ((sig[i], block[i]) != (sig[i - 1], block[i - 1]) or held > CHUNK_BYTES):
                    cuts.append(i)
                    held = 0
                held += len(bitmaps[i]) + 24
            ends = pa.array([*cuts, batch.num_rows], pa.int32())
            cuts = cuts if batch.num_rows else []
            ends = ends if cuts else pa.array([0], pa.int32())
            cols = [pa.ListArray.from_arrays(ends, batch.column(c)) for c in ("node", "n", "grp", "parity")]
            last = [*cuts[1:], batch.num_rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array([sig[i] for i in cuts], pa.int64()), pa.array([block[i] for i in cuts], pa.int32()),
                 pa.array([min(n[i:j]) for i, j in zip(cuts, last)], pa.int64()), pa.array([max(n[i:j]) for i, j in zip(cuts, last)], pa.int64()), *cols],
                names=["sig", "home", "low", "high", "nodes", "ns", "grps", "bitmaps"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own, by, up = None, [], None, {}

        def root(x: int) -> int:
            while up.get(x, x) != x:
                x = up[x]
            return x

        for batch in batches:
            out = []
            for sig, block, home, minor, *member in zip(*(batch.column(c).to_pylist() for c in (
                    "sig", "block", "home", "minor", "nodes", "ns", "grps", "bitmaps"))):
                if at != (sig, block):
                    at, own, by, up = (sig, block), [], None, {}
                if home < 0:
                    own.append((member[0][0], member[1][0], member[2][0], member[3][0], minor))
                    continue
                if by is None:
                    by = _by_width(*zip(*own)) if own else []
                for c in _by_width(*member, [True] * len(member[0])):
                    for o in by:
                        x, y = c[-1], o[-1]
                        if x.shape[1] == 2 * y.shape[1]:
                            x = fold(x)
                        elif 2 * x.shape[1] == y.shape[1]:
                            y = fold(y)
                        if x.shape[1] != y.shape[1]:
                            continue
                        differ = np.zeros((len(x), len(y)), np.int32)
                        for k in range(x.shape[1]):
                            differ += np.bitwise_count(x[:, k, None] ^ y[None, :, k])
                        ok = _close(c[1][:, None], o[1][None], differ, percent) & (c[2][:, None] != o[2][None])
                        if block < home:
                            ok &= ~o[3][None]  # pairs of two such nodes meet in the later block
                        i, j = np.nonzero(ok)
                        if every:
                            out += [(sig, a, b) for a, b in zip(c[0][i].tolist(), o[0][j].tolist())]
                            continue
                        near = np.argsort(differ[i, j], kind="stable")
                        i, j = i[near], j[near]
                        first = np.unique(np.stack([c[2][i], o[2][j]], 1), axis=0, return_index=True)[1]
                        for f in np.sort(first):
                            a, b = root(int(c[2][i[f]])), root(int(o[2][j[f]]))
                            if a != b:
                                up[max(a, b)] = min(a, b)
                                out.append((sig, int(c[0][i[f]]), int(o[0][j[f]])))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in range(3)], names=["sig", "a", "b"])

    parts = common.partitions(apart.sparkSession)
    chunks = apart.filter("minor").repartition(parts, "sig", "block").sortWithinPartitions("sig", "block", "n", "node").mapInArrow(
        pack, f"sig bigint, home int, low bigint, high bigint, {lists}")
    ranges = apart.groupBy("sig", "block").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.bool_and("minor").alias("only"))
    sent = chunks.join(ranges, "sig").filter(
        (F.col("block") > F.col("home")) | ((F.col("block") < F.col("home")) & ~F.col("only"))).filter(
        (percent * F.col("low") <= 100 * F.col("most")) & (percent * F.col("least") <= 100 * F.col("high")))
    cols = ["sig", "block", "home", "minor", "nodes", "ns", "grps", "bitmaps"]
    own = apart.select("sig", "block", F.lit(-1).alias("home"), "minor", F.array("node").alias("nodes"), F.array("n").alias("ns"),
                       F.array("grp").alias("grps"), F.array("parity").alias("bitmaps"))
    rows = own.unionByName(sent.withColumn("minor", F.lit(True)).select(*cols)).repartition(parts, "sig", "block")
    return rows.sortWithinPartitions("sig", "block", "home").mapInArrow(run, "sig bigint, a bigint, b bigint").select(
        "sig", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _by_width(node, n, group, bitmaps, minor) -> list[tuple[np.ndarray, ...]]:
    """(node, n, group, minor, bitmaps) of some nodes for each width of bitmaps."""
    width = np.array([len(x) // 8 for x in bitmaps])
    out = []
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        out.append((*(np.array(x)[at] for x in (node, n, group, minor)),
                    np.frombuffer(b"".join(bitmaps[i] for i in at), U).reshape(len(at), w)))
    return out


def _verify(edges: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The edges (a, b) that are links, from the texts (node, text) of their nodes.

    A node's text arrives before those of its partners, so a task holds two sets at a time.
    """
    t = texts.select("node", "text")
    first = edges.select(F.col("a").alias("node")).distinct().join(t, "node").select(
        F.col("node").alias("a"), F.col("node").alias("b"), "text")
    rest = edges.join(t, edges["b"] == t["node"]).select("a", "b", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, own = None, np.empty(0, U)
        for batch in batches:
            out = []
            for a, b, text in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "text"))):
                s = shingles(text, n)
                if set_hash(s) != b:  # another row that repeats the doc_id
                    continue
                if a == b:
                    of, own = a, s
                elif of == a:
                    common_n = len(np.intersect1d(own, s, assume_unique=True))
                    if 100 * common_n >= percent * (len(own) + len(s) - common_n):
                        out.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

    rows = first.unionByName(rest).repartition(common.partitions(texts.sparkSession), "a")
    return rows.sortWithinPartitions("a", F.col("a") != F.col("b")).mapInArrow(run, "a bigint, b bigint").distinct()


def link(docs: DataFrame, n: int = 4, percent: int = 85, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(members, links): members has doc_id, n_shingles and node (one set) for every row;
    links are verified pairs of nodes that connect whatever similar sets connect."""
    described = describe(docs, n, percent)
    nodes = common.cut(described.filter("length(signatures) > 0").groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("parity").alias("parity")))
    lists = _lists(described, percent, block)

    pairs = lists.filter("NOT long").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()
    left = nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("parity").alias("pa"))
    right = nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("parity").alias("pb"))
    short = _filter_pairs(pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "pa", "pb"), percent)
    entries = common.cut(_merged(lists, block))
    sizes = entries.groupBy("sig", "block").agg(F.count(F.lit(1)).alias("k"))
    home = entries.join(sizes, ["sig", "block"]).groupBy("node").agg(F.max(F.struct("k", "sig", "block")).alias("of"))
    begin = home.select("of.sig", "of.block", "node", F.col("node").alias("grp"))

    def with_bitmaps(entries: DataFrame) -> DataFrame:  # bitmaps join only rows that are compared next, lists are sorted out without
        return entries.join(nodes.select("node", "n", "parity"), "node")

    def ordered(edges: DataFrame) -> DataFrame:
        return edges.withColumns({"a": F.least("a", "b"), "b": F.greatest("a", "b")})

    def texts_of(pairs: DataFrame) -> DataFrame:  # only the texts asked for are sent, if the ids that ask fit a broadcast
        ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        reps = common.cut(ends.join(nodes.select("node", "rep"), "node").filter("rep IS NOT NULL"))
        asked = docs.select("doc_id", "text").join(common.small(reps.select(F.col("rep").alias("asked"))), F.col("doc_id") == F.col("asked"), "left_semi")
        return common.cut(asked.join(reps, F.col("doc_id") == F.col("rep")).select("node", "text"))

    def more(links: DataFrame, pairs: DataFrame) -> DataFrame:
        return links if pairs.isEmpty() else common.cut(links.unionByName(_verify(pairs, texts_of(pairs), n, percent)))

    # each node in its largest list only, so a group that many lists hold gives its edges once
    first = ordered(_long_edges(with_bitmaps(begin), percent, False)).select("a", "b")
    tried = common.cut(short.unionByName(first).distinct())
    links = common.cut(_verify(tried, texts_of(tried), n, percent))

    # then the classes that a list still holds apart
    apart = _classed(entries, links)
    between = common.cut(ordered(_long_edges(with_bitmaps(apart), percent, False, True)))
    links = more(links, common.cut(between.select("a", "b").distinct().join(tried, ["a", "b"], "left_anti")))

    # where an edge failed, all pairs that are still open
    failed = between.join(links, ["a", "b"], "left_anti").select("sig", "block").distinct()
    rest = _classed(apart.drop("grp"), links, failed)
    pairs = ordered(_long_edges(with_bitmaps(common.small(rest)), percent, True)).select("a", "b").distinct()
    links = more(links, common.cut(pairs.join(tried.unionByName(between.select("a", "b")), ["a", "b"], "left_anti")))

    wide = common.cut(lists.filter("long AND block > 0").select(F.col("x").alias("sig")).distinct())
    if not wide.isEmpty():  # lists of several blocks: a forest of their classes first, then the open pairs
        own = lists.filter("long AND home").select(F.col("x").alias("sig"), "block", F.col("y").alias("node"))
        whole = common.cut(own.join(wide, "sig", "left_semi"))
        for every in (False, True):
            cross = common.cut(_cross_edges(common.cut(with_bitmaps(_apart(whole, links))), percent, every))
            new = common.cut(cross.select("a", "b").distinct().join(links, ["a", "b"], "left_anti"))
            if new.isEmpty():
                break
            links = common.cut(links.unionByName(_verify(new, texts_of(new), n, percent)))
            failed = cross.join(links, ["a", "b"], "left_anti").select("sig").distinct()
            whole = common.cut(whole.join(failed, "sig", "left_semi"))
    return described.select("doc_id", "n_shingles", "node"), links


def classes(docs: DataFrame, n: int = 4, percent: int = 85, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) for every row."""
    members, links = link(docs, n, percent, block)
    found = components(links)
    of_node = members.filter("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("first"))
    labelled = of_node.join(found, "node", "left").select("node", "first", F.coalesce("component", "node").alias("component"))
    smallest = labelled.groupBy("component").agg(F.min("first").alias("component_id"))
    known = common.cut(labelled.join(smallest, "component").select("node", "component_id"))
    return members.join(known, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def representatives(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """The rows of ``docs`` that stay, one of each class (the smallest doc_id), all columns.

    Rows that repeat a doc_id stay or go together. The ids that go are few next to those that stay.
    """
    stays = F.bool_or(F.col("doc_id").eqNullSafe(F.col("component_id")))
    gone = classes(docs, n, percent).groupBy("doc_id").agg(stays.alias("stays")).filter("NOT stays")
    gone = common.small(common.cut(gone.select(F.col("doc_id").alias("__gone"))))
    return docs.join(gone, docs["doc_id"].eqNullSafe(F.col("__gone")), "left_anti")
