"""Substring deduplication: word passages that occur earlier in the corpus are removed.

The suffixes that start at the words of all texts are grouped by a hash of their first
``length`` words; no tree is built. A suffix is dealt by the five-word prefix that has the
least hash among those inside its first ``length`` words (the same one wherever the same
words occur), and carries the hash of ``length`` words as the name of its node. The prefix
always has five words: all suffixes of a frequent one come to one bucket, whose arrays are
made whole, so memory grows with it. Only the sort of a large bucket goes in parts, by the
hash. Consecutive suffixes below repeated nodes are chained to maximal repeats.

Every part of a batch finds its own repeats first and sends one leaf for each node, so a
passage that very many documents share is sent a few times only.

A window is ``length`` consecutive words of one document. It goes when the same words
start earlier: in a smaller doc_id, or earlier in the document. Windows are judged on the
input. Defined cases: a null text has no words; a document with fewer words than a window
stays whole; null doc_id sorts first; rows that repeat a doc_id and its text are one
document and lose the same words; an empty table gives no rows; texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hubcast.llm import common

U = np.uint64
MUL = U(0x9E3779B97F4A7C15)
PREFIX = 5  # words of a tree's prefix
PART = 4 << 20  # characters of text whose windows a task holds at a time
MEMORY = 4 << 20  # suffixes sorted at a time, on average; the arrays of the whole bucket exist by then
NO_ID = -(1 << 63)
RUN = np.dtype([("prefix", "<u8"), ("doc", "<i8"), ("start", "<i4"), ("n", "u1")])  # suffixes in a row of one tree
SPAN = np.dtype([("doc", "<i8"), ("start", "<i4"), ("n", "<i4")])  # starts of repeated windows in a row
RUN_MAX = 255  # suffixes that a run's n can count; a longer row goes on in the next run
NODE = 6  # bytes of a node's name inside a tree


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(31))) * MUL
    return x ^ (x >> U(29))


def rolling(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all n-word sequences from the words' hashes, by doubling."""
    if len(h) < n:
        return np.empty(0, U)
    out, done, power, width = None, 0, h, 1
    while True:
        if n & width:
            piece = power[done:]
            out = mix(piece) if out is None else mix(out[:len(piece)] * MUL + piece[:len(out)])
            done += width
        width *= 2
        if width > n:
            return out[:len(h) - n + 1]
        power = mix(power[:-(width // 2)] * MUL + power[width // 2:])


def chains(doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """SPAN rows from windows in order of document and start."""
    if not len(doc):
        return np.empty(0, SPAN)
    first = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1)]))
    out = np.empty(len(first), SPAN)
    out["doc"], out["start"] = doc[first], start[first]
    out["n"] = np.diff(np.append(first, len(doc)))
    return out


def later(key: np.ndarray, doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, later): masks of the leaves that come first at their node, and of those that
    start elsewhere. Leaves are in order of document and start."""
    order = np.argsort(key, kind="stable")
    head = np.concatenate([[True], key[order][1:] != key[order][:-1]]) if len(key) else np.empty(0, bool)
    of = order[head][np.cumsum(head) - 1] if len(key) else order
    first, after = np.zeros(len(key), bool), np.zeros(len(key), bool)
    first[order[head]] = True
    after[order] = (doc[order] != doc[of]) | (start[order] != start[of])
    return first, after


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[list[int], list[str]]]:
    ids, texts, held = [], [], 0
    for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
        ids.append(NO_ID if d is None else d)
        texts.append(t or "")
        held += len(t or "")
        if held >= PART:
            yield ids, texts
            ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def _leaves(ids: list[int], texts: list[str], length: int) -> tuple[np.ndarray, ...]:
    """(prefix, node, doc, start) of every window of some documents, in order of document and start."""
    order = np.argsort(np.array(ids, np.int64), kind="stable")
    split = [common.words(texts[i]) for i in order]
    n = np.array([len(w) for w in split], np.int64)
    total = int(n.sum())
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, chain.from_iterable(split)), U, total)
    node = rolling(h, length)
    if not len(node):
        return np.empty(0, U), np.empty(0, U), np.empty(0, np.int64), np.empty(0, np.int32)
    prefix = rolling(h, PREFIX)
    begin = np.repeat(np.cumsum(n) - n, n)
    start = np.arange(total) - begin
    whole = np.flatnonzero((start + length <= np.repeat(n, n))[:len(node)])
    least = np.lib.stride_tricks.sliding_window_view(prefix, length - PREFIX + 1)[whole].argmin(1)
    doc = np.repeat(np.array(ids, np.int64)[order], n)
    return prefix[whole + least], node[whole], doc[whole], start[whole].astype(np.int32)


def _names(node: np.ndarray) -> bytes:
    return np.ascontiguousarray(node.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :NODE]).tobytes()


def _plant(docs: DataFrame, length: int, buckets: int) -> DataFrame:
    """Rows (bucket, spans, runs, nodes): a part's own repeats, and leaves for the trees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in chain.from_iterable(map(_pieces, batches)):
            prefix, node, doc, start = _leaves(ids, texts, length)
            first, after = later(node, doc, start)
            own = chains(doc[after], start[after])
            own_to = (mix(own["doc"].astype(U)) % U(buckets)).astype(np.int64)
            prefix, node, doc, start = prefix[first], node[first], doc[first], start[first]
            new = np.concatenate([[True], (prefix[1:] != prefix[:-1]) | (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1)]) \
                if len(doc) else np.empty(0, bool)
            head = np.flatnonzero(new)
            step = np.arange(len(doc)) - np.repeat(head, np.diff(np.append(head, len(doc))))
            head = np.flatnonzero(step % RUN_MAX == 0)
            runs = np.empty(len(head), RUN)
            runs["prefix"], runs["doc"], runs["start"] = prefix[head], doc[head], start[head]
            runs["n"] = np.diff(np.append(head, len(doc)))
            to = (mix(runs["prefix"]) % U(buckets)).astype(np.int64)
            of = np.repeat(to, runs["n"])
            run_order, node_order = np.argsort(to, kind="stable"), np.argsort(of, kind="stable")
            runs, node, own = runs[run_order], node[node_order], own[np.argsort(own_to, kind="stable")]
            cuts = [np.searchsorted(np.sort(x), np.arange(buckets + 1)) for x in (own_to, to, of)]
            full = np.flatnonzero((np.diff(cuts[0]) > 0) | (np.diff(cuts[1]) > 0))
            part = lambda x, c, k: x[c[k]:c[k + 1]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(full.astype(np.int32)),
                 pa.array([part(own, cuts[0], k).tobytes() for k in full], pa.binary()),
                 pa.array([part(runs, cuts[1], k).tobytes() for k in full], pa.binary()),
                 pa.array([_names(part(node, cuts[2], k)) for k in full], pa.binary())],
                names=["bucket", "spans", "runs", "nodes"])

    return docs.select("doc_id", "text").mapInArrow(run, "bucket int, spans binary, runs binary, nodes binary")


def _tree_repeats(runs: np.ndarray, names: np.ndarray) -> np.ndarray:
    """SPAN rows of the windows below repeated nodes of a bucket's trees, but for the first leaf of each node."""
    at = np.cumsum(runs["n"].astype(np.int64)) - runs["n"]
    order = np.lexsort((runs["start"], runs["doc"]))
    runs, at = runs[order], at[order]
    times = runs["n"].astype(np.int64)
    step = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
    full = np.zeros((len(names) // NODE, 8), np.uint8)
    full[:, :NODE] = np.frombuffer(names, np.uint8).reshape(-1, NODE)
    key = mix(np.repeat(mix(runs["prefix"]), times) + full.view("<u8")[:, 0][np.repeat(at, times) + step])
    doc = np.repeat(runs["doc"], times)
    start = (np.repeat(runs["start"], times) + step).astype(np.int32)
    parts = max(1, -(-len(key) // MEMORY))
    after = np.zeros(len(key), bool)
    for p in range(parts):  # by hash: a part holds whole nodes
        mine = np.flatnonzero(key % U(parts) == p) if parts > 1 else slice(None)
        after[mine] = later(key[mine], doc[mine], start[mine])[1]
    return chains(doc[after], start[after])


def repeats(docs: DataFrame, length: int = 20) -> DataFrame:
    """(doc_id, spans): packed SPAN rows of repeated windows, some rows for each document."""
    buckets = common.partitions(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by: dict[int, list[tuple[bytes, bytes, bytes]]] = {}
        for b in batches:
            for k, *rest in zip(*(b.column(c).to_pylist() for c in ("bucket", "spans", "runs", "nodes"))):
                by.setdefault(k, []).append(tuple(rest))
        for k in list(by):
            spans, runs, names = (b"".join(x) for x in zip(*by.pop(k)))
            found = np.concatenate([np.frombuffer(spans, SPAN), _tree_repeats(np.frombuffer(runs, RUN), names)])
            found = found[np.argsort(found["doc"], kind="stable")]
            if len(found):
                head = np.flatnonzero(np.diff(found["doc"], prepend=~found["doc"][:1]))
                raw, size = found.tobytes(), SPAN.itemsize
                ends = np.append(head[1:], len(found))
                for i in range(0, len(head), 10_000):
                    pick = range(i, min(i + 10_000, len(head)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found["doc"][head[pick.start:pick.stop]]),
                         pa.array([raw[head[j] * size:ends[j] * size] for j in pick], pa.binary())], names=["doc_id", "spans"])

    planted = _plant(docs, length, buckets)
    return planted.repartition(buckets, "bucket").mapInArrow(run, "doc_id bigint, spans binary")


def passages(docs: DataFrame, length: int = 20) -> DataFrame:
    """(doc_id, start, n_words): the repeated passages, in words, merged to their full extent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for d, parts in zip(b.column("doc_id").to_pylist(), b.column("parts").to_pylist()):
                s = np.sort(np.frombuffer(b"".join(parts), SPAN), order="start")
                start, end = None, None
                for x, n in zip(s["start"].tolist(), s["n"].tolist()):
                    if start is not None and x <= end:
                        end = max(end, x + n + length - 1)
                        continue
                    if start is not None:
                        out.append((d, start, end - start))
                    start, end = x, x + n + length - 1
                out.append((d, start, end - start))
            cols = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array([None if x == NO_ID else x for x in cols[0]], pa.int64()),
                                              *(pa.array(list(c), pa.int64()) for c in cols[1:])],
                                             names=["doc_id", "start", "n_words"])

    grouped = repeats(docs, length).groupBy("doc_id").agg(F.collect_list("spans").alias("parts"))
    return grouped.mapInArrow(run, "doc_id bigint, start bigint, n_words bigint")


def strip(docs: DataFrame, length: int = 20, with_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, if asked for, kept_text for every row of ``docs``.

    The kept words are joined by one space. A document's spans are bounded by its words.
    """
    spans = repeats(docs, length).groupBy(F.col("doc_id").alias("__of")).agg(F.collect_list("spans").alias("parts"))
    keyed = docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(NO_ID)).alias("__id"))
    joined = keyed.join(spans, F.col("__id") == F.col("__of"), "left").select("doc_id", "text", "parts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text, parts in zip(b.column("text").to_pylist(), b.column("parts").to_pylist()):
                w = kept = common.words(text)
                if parts:
                    gone = np.zeros(len(w) + 1, bool)
                    for s in np.frombuffer(b"".join(parts), SPAN):
                        gone[s["start"]:s["start"] + s["n"] + length - 1] = True
                    kept = [x for x, g in zip(w, gone.tolist()) if not g]
                joined_words = b" ".join(kept)
                out.append((len(w), len(w) - len(kept), sha256(joined_words).hexdigest(), joined_words.decode()))
            cols = list(zip(*out)) or [()] * 4
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()][:3 + with_text]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(list(c), k) for c, k in zip(cols, kinds))],
                                             names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"][:4 + with_text])

    return joined.mapInArrow(run, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
                             + ", kept_text string" * with_text)
