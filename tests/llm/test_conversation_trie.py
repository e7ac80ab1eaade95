import hashlib
import random

import pytest
from llm_cases import SMALL
from pyspark.sql import functions as F

from hubcast.llm import conversation_trie as T, queries
from oracle_check import compare, duck

TURNS = "conv_id long, turn long, role string, text string"
COLS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def test_matches_sql(spark):
    n = "op12_conversation_trie"
    got = compare(spark, duck(SMALL), n, queries.QUERIES[n], queries.ORACLE_SQL[n], SMALL)
    assert got["exact"] and got["spark_rows"] == got["duck_rows"]


def brute(convs):
    """convs: conv_id -> tuple of turns (role, text)"""
    nodes = {}
    for c, s in convs.items():
        for d in range(len(s) + 1):
            nodes.setdefault(s[:d], []).append(c)
    children = {p: sum(1 for q in nodes if len(q) == len(p) + 1 and q[:-1] == p) for p in nodes}
    out = set()
    for p, members in nodes.items():
        below = [q for q in nodes if q[:len(p)] == p]
        saved = sum((len(nodes[q]) - 1) * len(q[-1][1]) for q in below if q)
        ends = ",".join(map(str, sorted(c for c in members if convs[c] == p)))
        out.add((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), children[p],
                 sum(children[q] == 0 for q in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def ordered(rows):
    convs = {}
    for c, t, ro, tx in rows:
        if c is not None:
            convs.setdefault(c, []).append((t is not None, t or 0, ro or "", tx or ""))
    return {c: tuple((r, x) for _, _, r, x in sorted(v)) for c, v in convs.items()}


def got(df):
    return {tuple(r[c] for c in COLS) for r in df.collect()}


def random_rows(seed, n):
    r = random.Random(seed)
    return [(c, t, r.choice(["user", "assistant"]), r.choice(["a", "bb", "é🙂", "", "x" * 300]))
            for c in r.sample(range(-500, 12_000), n) for t in range(r.choice([1, 2, 3, 5, 9]))]


@pytest.mark.parametrize("turns_of_a_shard", [T.SHARD_TURNS, 20])
def test_as_brute_force(spark, monkeypatch, turns_of_a_shard):
    monkeypatch.setattr(T, "SHARD_TURNS", turns_of_a_shard)
    rows = random_rows(1, 150)
    df = spark.createDataFrame(rows, TURNS).repartition(5).withColumns({c: F.lit("x") for c in ("path", "key", "pos", "chars", "part")})
    assert got(T.trie(T.whole(T.turns_of(df)))) == brute(ordered(rows))


def test_heads(spark):
    rows = random_rows(2, 120) + [(c, t, "user", f"t{t}") for c in (300, 304, 310) for t in range(7)]
    own = ordered(rows)
    h = lambda c: (7 * c) % 4
    want = {c: own.get(c - c % 50, ())[:h(c)] + s[h(c):] for c, s in own.items()}
    df = spark.createDataFrame(rows, TURNS).repartition(5)
    c = F.col("conv_id")
    heads = T.with_heads(T.turns_of(df), c - F.pmod(c, F.lit(50)), F.pmod(7 * c, F.lit(4)).cast("int"), most=3)
    assert got(T.trie(heads)) == brute(want)


def test_edge_rows(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", "x" * 100_000), (1, None, None, "first"), (2, 5, "user", "a"),
            (2, 5, "user", "a"), (2, 5, "assistant", "b"), (None, 1, "assistant", "n"), (3, None, None, "first"), (4, 1, "", "first")]
    assert got(T.trie(T.whole(T.turns_of(spark.createDataFrame(rows, TURNS))))) == brute(ordered(rows))
    assert T.trie(T.whole(T.turns_of(spark.createDataFrame([], TURNS)))).collect() == []


def test_long_conversation_and_equal_ones_over_shards(spark):
    rows = [(1, t, "user", str(t % 3)) for t in range(700)] + [(c, 0, "user", "hi") for c in range(2, 9000, 7)]
    out = got(T.trie(T.whole(T.turns_of(spark.createDataFrame(rows, TURNS)))))
    ends = ",".join(map(str, range(2, 9000, 7)))
    assert len(out) == 702 and (2, 1, 1, len(range(2, 9000, 7)), 0, 1, 2 * (len(range(2, 9000, 7)) - 1),
                                hashlib.sha256(ends.encode()).hexdigest()) in out
