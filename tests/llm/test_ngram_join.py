import random

import numpy as np
import pytest
from llm_cases import SMALL, edge, empty  # noqa: F401

from hubcast.llm import ngram_join as J, queries


def shingle_set(text, n):
    w = (text or "").encode().lower().split()
    k = min(n, len(w))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if w else frozenset()


def brute(rows, n, percent):
    sets = [shingle_set(t, n) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    first = {}
    for i, (d, _) in enumerate(rows):
        first.setdefault(root(i), []).append(d)
    return {d: (len(s), min(x for x in first[root(i)] if x is not None) if d is not None else None)
            for i, ((d, _), s) in enumerate(zip(rows, sets))}


def check(df, n, percent):
    rows = sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=lambda r: (r[0] is None, r[0]))
    got = J.classes(df, n, percent).collect()
    assert len(got) == len(rows)
    want = brute(rows, n, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    return want


def copies(seed, groups, size, words, edits):
    """Groups of near copies with up to ``edits`` changed words."""
    r, rows = random.Random(seed), []
    for g in range(groups):
        base = [f"w{r.randint(0, 4000)}" for _ in range(words)]
        for _ in range(size):
            w = list(base)
            for _ in range(r.randint(0, edits)):
                w[r.randrange(words)] = f"e{r.randint(0, 10 ** 6)}"
            rows.append((len(rows), " ".join(w)))
    return rows


def test_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want = brute(sorted((r.doc_id, r.text) for r in docs.collect()), 4, 85)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op7_ngram_jaccard(spark, SMALL).collect()}
    assert got == want and any(c != d for d, (_, c) in want.items())


def test_edge_rows_and_empty_table(spark, edge, empty):
    check(edge, 4, 85)
    assert J.classes(empty).collect() == []
    kept = J.representatives(edge, 5, 80)
    assert kept.columns == edge.columns
    assert {r.doc_id for r in kept.collect()} == {1, 2, 3, 4, 5, 7, 8, 9, None}


@pytest.mark.parametrize("words,edits", [(8, 1), (40, 3), (160, 9)])
def test_near_copies(spark, words, edits):
    rows = copies(words, 6, 40, words, edits)
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 4, 85)


def test_large_group_of_near_copies_and_a_common_passage(spark):
    """Frequent shingles: more than 256 documents share them, so their combinations are used."""
    r = random.Random(9)
    rows = copies(1, 1, 420, 60, 6)
    passage = " ".join(f"p{i}" for i in range(25))
    rows += [(1000 + i, " ".join(f"q{r.randint(0, 9999)}" for _ in range(12)) + " " + passage) for i in range(330)]
    rows += [(2000 + i, passage + f" z{i}") for i in range(20)]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 4, 85)


@pytest.mark.parametrize("seed", range(4))
def test_similar_sets_share_a_signature(seed):
    """The guarantee itself, for any split into rare and frequent shingles."""
    r = np.random.default_rng(seed)
    for n in [6, 7, 9, 14, 40, 150, 700]:
        for _ in range(40):
            pool = np.unique(r.integers(0, 2**63, 2 * n).astype(np.uint64))
            x = np.sort(r.choice(pool, n, replace=False))
            y = x.copy()
            for _ in range(int(r.integers(0, max(2, n // 10)))):
                y = np.union1d(y, r.choice(pool, 1)) if r.random() < 0.5 else np.delete(y, r.integers(len(y)))
            both = len(np.intersect1d(x, y))
            if 100 * both < 85 * (len(x) + len(y) - both) or (len(x) == len(y) == both):
                continue
            share = r.choice([0.0, 0.1, 0.5, 0.9, 1.0])
            seen = {int(v): (1000 if r.random() < share else 1) for v in pool}
            sig = [J.signatures(s, np.array([seen[int(v)] for v in s]), 85, 256.0, 2.0) for s in (x, y)]
            assert len(np.intersect1d(*sig)), (n, both, share)
            a, b = J.parity(x), J.parity(y)
            while len(a) != len(b):
                a, b = (J.fold(a[None])[0], b) if len(a) > len(b) else (a, J.fold(b[None])[0])
            differ = int(np.bitwise_count(a ^ b).sum())
            assert differ <= len(x) + len(y) - 2 * both and J._close(len(x), len(y), differ, 85)


def test_components_of_long_chains(spark):
    from hubcast.llm.components import components
    links = [(i, i + 1) for i in range(0, 200)] + [(500 + i, 500) for i in range(1, 60)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long").repartition(3)).collect()}
    assert got == {i: 0 for i in range(201)} | {i: 500 for i in range(500, 560)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_long_lists_go_in_bounded_blocks(spark):
    """Near copies of two texts and rows that only share a passage, in lists of many blocks."""
    r = random.Random(4)
    rows = copies(1, 1, 400, 60, 6)
    other = rows[0][1].split()
    for i in range(300):  # around a text at some distance, so lists hold classes that link rarely or not at all
        w = list(other)
        for k in range(0, 12, 4):
            w[k] = "v"
        for _ in range(r.randint(0, 4)):
            w[r.randrange(60)] = f"e{r.randint(0, 10 ** 6)}"
        rows.append((1000 + i, " ".join(w[:r.randint(52, 60)])))
    passage = " ".join(f"p{i}" for i in range(40))
    rows += [(2000 + i, passage + " " + " ".join(f"q{r.randint(0, 9999)}" for _ in range(r.randint(1, 6)))) for i in range(330)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    lists = J._lists(J.describe(df, 4, 85), 85, block=16).filter("long")
    sizes = [x["count"] for x in lists.groupBy("x", "block").count().collect()]
    assert max(sizes) <= 4 * 16 + J.OVERLAP < max(x["count"] for x in lists.filter("home").groupBy("x").count().collect())
    want = brute(rows, 4, 85)
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in J.classes(df, 4, 85, block=16).collect()} == want
    assert len({c for _, c in want.values()}) > 1


def test_a_group_in_many_lists_gives_its_edges_once(spark, monkeypatch):
    rows = copies(1, 1, 800, 60, 1)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    made, plain = [], J._long_edges

    def counted(*args):
        out = J.common.cut(plain(*args))
        made.append(out.count())
        return out

    monkeypatch.setattr(J, "_long_edges", counted)
    check(df, 5, 80)
    entries = J._lists(J.describe(df, 5, 80), 80).filter("long").count()
    assert sum(made) <= 2 * len(rows) < entries


def test_lists_of_almost_the_same_nodes_are_compared_as_one(spark, monkeypatch):
    """Near copies at the threshold, whose classes stay apart: their rows don't come once for each signature."""
    rows = copies(1, 1, 300, 60, 4)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    made, plain = [], J._classed

    def counted(*args):
        out = plain(*args)
        made.append(out.count())
        return out

    monkeypatch.setattr(J, "_classed", counted)
    check(df, 5, 80)
    entries = J._lists(J.describe(df, 5, 80), 80).filter("long").count()
    assert 0 < max(made) < entries / 2


def test_merged_lists_hold_every_pair_of_the_lists(spark):
    rows = copies(3, 3, 60, 40, 3) + copies(1, 1, 300, 60, 6)
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string").repartition(4)
    for block in (8, J.BLOCK):
        lists = J._lists(J.describe(df, 4, 85), 85, block).cache()
        merged = J._merged(lists, block)

        def pairs(members):
            by = {}
            for *of, node in members:
                by.setdefault(tuple(of), set()).add(node)
            return by, {(a, b) for s in by.values() for a in s for b in s}

        apart, wanted = pairs((r.x, r.block, r.y) for r in lists.filter("long").collect())
        whole, held = pairs((r.sig, r.block, r.node) for r in merged.collect())
        assert wanted <= held and len(whole) < len(apart)
        assert max(map(len, whole.values())) <= 4 * block + J.OVERLAP
        assert sum(map(len, whole.values())) < sum(map(len, apart.values()))


def test_only_texts_that_are_compared_are_sent(spark, monkeypatch):
    """No shuffle of the whole documents: those without a partner stay where they are read."""
    r = random.Random(5)
    rows = copies(1, 6, 10, 60, 3)
    rows += [(1000 + i, " ".join(f"q{r.randint(0, 99999)}" for _ in range(60))) for i in range(400)]
    rows += [(3, rows[30][1]), (None, rows[2][1]), (None, rows[2][1]), (2000, None), (2000, rows[40][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    plans, plain, small = [], J.common.cut, J.common.small

    def cut(df):
        if df.columns == ["node", "text"]:
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return plain(df)

    monkeypatch.setattr(J.common, "cut", cut)
    kept = J.representatives(docs, 4, 85)
    assert plans and all("BroadcastHashJoin" in p and "LeftSemi" in p for p in plans)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    classes = J.classes(docs, 4, 85).collect()
    stay = {x.doc_id for x in classes if x.doc_id == x.component_id}
    want = sorted((x for x in rows if x[0] in stay), key=str)
    assert sorted(map(tuple, kept.collect()), key=str) == want and 400 < len(want) < len(rows)
    monkeypatch.setattr(J.common, "small", lambda df: small(df, 0))  # beyond the limit of a broadcast
    assert sorted(map(tuple, J.representatives(docs, 4, 85).collect()), key=str) == want


def test_lists_are_sorted_out_without_bitmaps(spark, monkeypatch):
    """Bitmaps join a list's rows only where they are compared; before, every step on the lists sent them along."""
    seen, plain = [], J._classed

    def classed(entries, *args):
        out = plain(entries, *args)
        seen.extend([entries.columns, out.columns])
        return out

    monkeypatch.setattr(J, "_classed", classed)
    df = spark.createDataFrame(copies(1, 1, 300, 60, 4), "doc_id long, text string").repartition(4)
    check(df, 5, 80)
    assert len(seen) == 4 and all("parity" not in c and "n" not in c for c in seen)


def test_sketch_tells_rare_shingles_from_others(spark):
    """Two million shingles of one document each and a passage of 40: the cells of a smaller sketch hold two each."""
    r = np.random.default_rng(2)
    passage = " ".join(f"p{i}" for i in range(12))
    rows = [(i, " ".join(map(str, r.integers(0, 10 ** 9, 5000))) + (" " + passage if i < 40 else "")) for i in range(400)]
    df = spark.createDataFrame(rows + [(-1, None), (-2, "")], "doc_id long, text string").repartition(3)
    codes, mean = J.sketch(df, 4)
    held = [J.COUNTS[codes[(J.shingles(t, 4) >> np.uint64(64 - J.SKETCH_BITS)).astype(np.int64)]] for _, t in rows]
    whole = sum(map(len, held))
    assert 0.99 * whole <= mean * len(codes) <= whole and mean < 0.5 and codes.nbytes <= 8 << 20
    assert np.median(np.concatenate(held)) == 1
    often = J.COUNTS[codes[(J.shingles(passage, 4) >> np.uint64(64 - J.SKETCH_BITS)).astype(np.int64)]]
    assert often.min() >= 36 and often.max() <= 50


def test_prefix_takes_the_smallest_counts_below_the_noise_too():
    r = np.random.default_rng(1)
    s = np.unique(r.integers(0, 2**63, 300).astype(np.uint64))
    seen = r.integers(1, 14, len(s)).astype(float)
    of = dict(zip(s.tolist(), seen))
    got = [of[x] for x in J.signatures(s, seen, 80, 256.0, 14.0).tolist()]
    assert got == sorted(seen)[:61]
    wide = J.signatures(s, np.where(seen > 2, 1000.0, seen), 80, 256.0)  # extended: all rare ones in their order, then combinations
    rare = int((seen <= 2).sum())
    assert [of[x] for x in wide[:rare].tolist()] == sorted(seen)[:rare] and not set(wide[rare:].tolist()) & set(s.tolist())


def test_short_lists_give_pairs_whose_first_common_shingle_they_may_be(spark):
    """Two sets of 300 are similar if they share 267, so at most 33 of either come before the first they share."""
    for place, ranked, want in [(33, 61, 1), (34, 61, 0), (60, 61, 0), (60, 40, 1)]:  # the last: a combination has no place
        x, y = np.arange(1, 62, dtype=np.uint64), np.arange(101, 162, dtype=np.uint64)
        y[place] = x[place]
        df = spark.createDataFrame([(300, 7, x.tobytes(), ranked), (300, 8, y.tobytes(), ranked)],
                                   "n_shingles long, node long, signatures binary, ranked int")
        assert [(r.x, r.y) for r in J._lists(df, 80).collect()] == [(7, 8)] * want


def test_lists_that_meet_in_a_bucket_are_one(spark):
    """Copies share most signatures: a bucket's lists come as fewer rows, with every pair of theirs."""
    docs = spark.createDataFrame(copies(2, 4, 150, 60, 2), "doc_id long, text string").repartition(4)
    described = J.describe(docs, 5, 80)
    apart = {}
    for x in described.collect():
        for sig in np.frombuffer(x.signatures, np.uint64):
            apart.setdefault(int(sig), set()).add(x.node)
    apart = [v for v in apart.values() if len(v) > J.SHORT]
    whole = {}
    for x in J._lists(described, 80).filter("long").collect():
        whole.setdefault(x.x, set()).add(x.y)
    pairs = lambda lists: {(a, b) for v in lists for a in v for b in v}
    assert pairs(apart) <= pairs(whole.values())
    assert 0 < sum(map(len, whole.values())) < sum(map(len, apart))
