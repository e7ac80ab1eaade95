import hashlib
import random

import numpy as np
import pytest
from llm_cases import SMALL, edge, empty  # noqa: F401

from hubcast.llm import queries, substring_dedup as S


def brute(rows, length):
    """Kept words per doc_id, windows judged on the input."""
    key = lambda d: (d is not None, d or 0)
    first, out = {}, {}
    docs = {d: (t or "").encode().split() for d, t in sorted(rows, key=lambda r: key(r[0]))}
    for d, w in docs.items():
        for i in range(len(w) - length + 1):
            first.setdefault(tuple(w[i:i + length]), (d, i))
    for d, w in docs.items():
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if first[tuple(w[i:i + length])] != (d, i):
                gone[i:i + length] = [True] * length
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out[d] = (len(w), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def check(df, length):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    got = S.strip(df, length).collect()
    assert len(got) == len(rows)
    want = brute(rows, length)
    for r in got:
        assert (r.n_words, r.n_removed, r.kept_sha256) == want[r.doc_id], r.doc_id
        assert hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256


def test_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], 20)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.op3_substring_dedup(spark, SMALL).collect()}
    assert got == want and sum(v[1] for v in want.values()) > 0


def test_edge_rows_and_empty_table(spark, edge, empty):
    check(edge, 20)
    assert S.strip(empty, 20).collect() == [] and S.passages(empty).collect() == []


@pytest.mark.parametrize("length", [6, 20])
def test_few_words_many_repeats(spark, length):
    r = random.Random(length)
    rows = [(i, " ".join(r.choice("ab") for _ in range(r.randint(0, 90)))) for i in range(120)]
    rows += [(500 + i, "x " * 200) for i in range(5)]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), length)


def test_parts_and_memory_bound_change_nothing(spark, monkeypatch):
    """Small parts in the tasks; the trees' parts are tested on the function itself."""
    r = random.Random(3)
    ids, texts = list(range(60)), [" ".join(r.choice("abc") for _ in range(80)) for _ in range(60)]
    prefix, node, doc, start = S._leaves(ids, texts, 8)
    runs = np.zeros(len(node), S.RUN)
    runs["prefix"], runs["doc"], runs["start"], runs["n"] = prefix, doc, start, 1
    whole = S._tree_repeats(runs, S._names(node))
    monkeypatch.setattr(S, "MEMORY", 100)
    assert (S._tree_repeats(runs, S._names(node)) == whole).all() and len(whole)


def test_passages_are_maximal(spark):
    p = " ".join(f"w{i}" for i in range(35))
    rows = [(1, "a b " + p + " c"), (2, "d " + p + " e f"), (3, "g")]
    got = S.passages(spark.createDataFrame(rows, "doc_id long, text string"), 20).collect()
    assert [tuple(r) for r in got] == [(2, 1, 35)]


def test_rows_of_one_tree_longer_than_a_run(spark):
    """Lines of 12 to 15 words in which a counter changes: one prefix leads over 256 windows and more."""
    def lines(lead, words, count):
        return " ".join(" ".join(f"{lead}{j}" for j in range(words - 1)) + f" {i}" for i in range(count))

    def longest(text):
        prefix = S._leaves([0], [text], 20)[0]
        return max(np.diff(np.flatnonzero(np.diff(prefix, prepend=~prefix[:1], append=~prefix[-1:]))))

    r = random.Random(5)
    other = [" ".join(f"v{r.randint(0, 10 ** 6)}" for _ in range(60)) for _ in range(40)]
    logs = [next(t for t in (lines(f"{a}q{k}x", words, 120) for k in range(500)) if longest(t) > 512)
            for words, a in ((12, "a"), (13, "b"), (14, "c"), (15, "d"))]
    texts = [logs[0], *other[:20], logs[1], *other[20:], logs[2], logs[3]]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, "y " + t) for i, t in enumerate(reversed(texts))]
    check(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), 20)
    check(spark.createDataFrame(rows, "doc_id long, text string").repartitionByRange(4, "doc_id"), 20)
