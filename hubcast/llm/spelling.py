"""Spelling variants of a vocabulary by dense prefix-suffix tiling.

Two words of which the longer has m code points are one edit apart if and only if they
differ and the lengths of their common prefix and common suffix reach m - 1 together. For
each m the words of m and of m - 1 code points meet. If the common prefix ends in the j-th of
PIECES parts of the word, both words agree before that part and behind it: these two
strings are a key, so words meet only under PIECES keys, and each pair counts under one.
Rows in key order are cut into blocks; a block is compared with itself and with the blocks
that go on with its last key, as matrices of code points padded to m, aligned left for
prefixes and right for suffixes. A task gives, for each word, the number of its near words
and the best of them, never the pairs.

A key of more than HOT words (or HOT_CHARS code points) is cut into parts by a hash, and every two parts meet in a step
of their own, so no task holds more than two parts.

Defined cases: words are distinct and hold no null character; a null text has no words; an
empty vocabulary gives no rows; very long words take smaller blocks; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hubcast.llm import common

PIECES = 4
TILE = 64  # words of a block
TILE_CELLS = 4 << 20  # code points that two blocks compare at most
SLAB, SLAB_CELLS = 8192, 1 << 20  # rows and code points that a task looks at together, beyond the end of a step
HOT, HOT_CHARS = 2048, 1 << 20  # words and code points of a key that meet in one step


def keyed(words: DataFrame) -> DataFrame:
    """(word, n, m, piece, key): every word under its keys, as the longer and as the shorter one."""
    m = F.length("word") + F.col("x") % 2
    piece = F.floor(F.col("x") / 2).cast("int")
    head, tail = F.floor(piece * m / PIECES).cast("int"), (m - F.floor((piece + 1) * m / PIECES)).cast("int")
    rows = words.select("word", "n", F.explode(F.array([F.lit(i) for i in range(2 * PIECES)])).alias("x"))
    rows = rows.select("word", "n", m.alias("m"), piece.alias("piece"), head.alias("head"), tail.alias("tail"))
    return rows.select("word", "n", "m", "piece", F.xxhash64(
        "m", "piece", F.substring("word", F.lit(1), F.col("head")),
        F.substring("word", F.length("word") - F.col("tail") + 1, F.col("tail"))).alias("key"))


def _met(rows: DataFrame) -> DataFrame:
    """``rows`` with the step (x, y) of their key in which they meet and the part that they are of."""
    rows = common.cut(rows)
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("k"), F.sum("m").alias("chars"))
    parts = F.least("k", F.greatest(F.ceil(F.col("k") / HOT), F.ceil(F.col("chars") / HOT_CHARS)))
    hot = common.cut(sizes.select("key", parts.cast("int").alias("parts")).filter("parts > 1"))
    if hot.isEmpty():
        return rows.select("*", F.lit(0).alias("x"), F.lit(0).alias("y"), F.lit(0).alias("part"))
    dealt = rows.join(common.small(hot), "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn(
        "part", F.pmod(F.xxhash64("word", F.lit(11)), "parts").cast("int"))
    return dealt.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        *rows.columns, F.least("part", "o").alias("x"), F.greatest("part", "o").alias("y"), "part")


def _leading(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many leading code points the rows of two matrices share."""
    run = np.ones((len(a), len(b)), bool)
    out = np.zeros(run.shape, np.int32)
    for k in range(a.shape[1]):
        run &= a[:, k, None] == b[None, :, k]
        if not run.any():
            break
        out += run
    return out


def compare(m: int, words: list[str], n: np.ndarray, piece: np.ndarray, step: np.ndarray, cross: np.ndarray,
            part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of near words, index of the best) of each row; -1 where there is none.

    Rows of a step are neighbours; where ``cross`` holds, only rows of different parts meet.
    """
    text = np.array(words, f"U{m}")
    left = text.view(np.uint32).reshape(-1, m)
    right = np.array([w[::-1] for w in words], f"U{m}").view(np.uint32).reshape(-1, m)
    full = np.array([len(w) == m for w in words])
    low, high = piece * m // PIECES, (piece + 1) * m // PIECES
    order = np.lexsort((text, -n))
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    count, best = np.zeros(len(words), np.int64), np.full(len(words), len(words))
    width = int(max(1, min(TILE, (TILE_CELLS / m) ** 0.5)))
    for a in range(0, len(words), width):
        x = slice(a, min(a + width, len(words)))
        for b in range(a, len(words), width):
            if step[b] != step[x.stop - 1] and b > a:
                break
            y = slice(b, min(b + width, len(words)))
            ok = (step[x, None] == step[None, y]) & (full[x, None] | full[None, y])
            ok &= ~cross[x, None] | (part[x, None] != part[None, y])
            if a == b:
                ok = np.triu(ok, 1)
            if not ok.any():
                continue
            prefix = _leading(left[x], left[y])
            ok &= (prefix >= low[x, None]) & (prefix < high[x, None])
            ok &= prefix + _leading(right[x], right[y]) >= m - 1
            count[x] += ok.sum(1)
            count[y] += ok.sum(0)
            best[x] = np.minimum(best[x], np.where(ok, rank[None, y], len(words)).min(1))
            best[y] = np.minimum(best[y], np.where(ok, rank[x, None], len(words)).min(0))
    return count, np.where(best < len(words), order[np.minimum(best, len(words) - 1)], -1)


def near(words: DataFrame) -> DataFrame:
    """(word, n_near, near_n, near): the number of near words and the most frequent one; only words that have any.

    ``words``: distinct word and its count n. Ties go to the smallest in code-point order.
    """
    columns = ("m", "key", "x", "y", "word", "n", "piece", "part")

    def slab(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        m, key, x, y, word, n, piece, part = zip(*rows)
        m, n = np.array(m), np.array(n)
        at = np.array([key, x, y])
        step = np.cumsum(np.append(True, (at[:, 1:] != at[:, :-1]).any(0)))
        cross, piece, part = np.array(x) != np.array(y), np.array(piece), np.array(part)
        for begin in np.flatnonzero(np.diff(m, prepend=-1)):
            end = begin + np.argmax(np.append(m[begin:] != m[begin], True))
            s = slice(begin, end)
            own = word[begin:end]
            count, best = compare(int(m[begin]), own, n[s], piece[s], step[s], cross[s], part[s])
            has = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array([own[i] for i in has], pa.string()), pa.array(count[has]), pa.array(n[s][best[has]]),
                 pa.array([own[i] for i in best[has]], pa.string())], names=["word", "k", "near_n", "near"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        cells = 0
        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in columns)):
                if (len(held) >= SLAB or cells >= SLAB_CELLS) and row[:4] != held[-1][:4]:
                    yield from slab(held)
                    held, cells = [], 0
                held.append(row)
                cells += row[0]
        if held:
            yield from slab(held)

    met = _met(keyed(words)).select(*columns)
    found = met.repartition(common.partitions(words.sparkSession), "key", "x", "y").sortWithinPartitions(
        "m", "key", "x", "y").mapInArrow(run, "word string, k bigint, near_n bigint, near string")
    best = F.min(F.struct((-F.col("near_n")).alias("near_n"), "near")).alias("best")
    return found.groupBy("word").agg(F.sum("k").alias("n_near"), best).select(
        "word", "n_near", (-F.col("best.near_n")).alias("near_n"), "best.near")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of the chain of forms; pointers double their reach at each round.

    Counts at least double along a chain, so it has few steps and no cycle.
    """
    at = common.cut(forms.select("word", F.col("form").alias("root")))
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = common.cut(at.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        at = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return at


def variants(words: DataFrame, ratio: int = 2) -> DataFrame:
    """word, n, n_near, form, form_n and root for every row of ``words`` (word, n).

    The form of a word is its most frequent near word if that is ``ratio`` times as frequent (null else).
    """
    words = common.cut(words.select("word", F.col("n").cast("long").alias("n")))
    frequent = F.col("near_n") >= ratio * F.col("n")
    formed = common.cut(words.join(near(words), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(frequent, F.col("near")).alias("form"), F.when(frequent, F.col("near_n")).alias("form_n")))
    ends = roots(formed.filter("form IS NOT NULL"))
    return formed.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
