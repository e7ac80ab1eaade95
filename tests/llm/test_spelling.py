import random

import pytest
from llm_cases import SMALL
from pyspark.sql import functions as F

from hubcast.llm import queries, spelling as S
from oracle_check import compare, duck

WORDS = "word string, n long"


def test_matches_sql(spark):
    n = "op11_spelling_variants"
    got = compare(spark, duck(SMALL), n, queries.QUERIES[n], queries.ORACLE_SQL[n], SMALL)
    assert got["exact"] and got["spark_rows"] == got["duck_rows"] > 2000


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(words, ratio=2):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    best = {w: min(vs, key=lambda v: (-words[v], v)) for w, vs in near.items() if vs}
    form = {w: v for w, v in best.items() if words[v] >= ratio * words[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, n, len(near[w]), form.get(w), words[form[w]] if w in form else None, root(w)) for w, n in words.items()}


def got(spark, words):
    df = spark.createDataFrame(list(words.items()), WORDS).repartition(4).withColumns({c: F.lit("x") for c in ("key", "m", "part", "root")})
    return {(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in S.variants(df).collect()}


def vocabulary(seed, size, letters, low=1, high=9):
    r = random.Random(seed)
    return {"".join(r.choice(letters) for _ in range(r.randint(low, high))): r.choice([3, 3, 4, 6, 12, 40, 900]) for _ in range(size)}


@pytest.mark.parametrize("letters, low, high", [("ab", 1, 8), ("aé漢🙂", 2, 6), ("abcdefgh", 5, 7)])
def test_as_brute_force(spark, letters, low, high):
    words = vocabulary(7, 700, letters, low, high)
    assert got(spark, words) == brute(words)


def test_parts_of_hot_keys_meet_in_steps(spark, monkeypatch):
    monkeypatch.setattr(S, "HOT", 16)
    monkeypatch.setattr(S, "TILE", 5)
    monkeypatch.setattr(S, "SLAB", 50)
    words = {f"prefix{i:03d}": 1 + i % 50 for i in range(400)} | vocabulary(3, 200, "ab")
    assert got(spark, words) == brute(words)


def test_long_words_chains_and_no_words(spark):
    long = "é" * 30_000
    words = {long: 9, long[1:]: 4, long[:-1] + "x": 1, "abcde": 1, "abcdf": 2, "abcgf": 5, "abhgf": 5, "zzzzz": 3}
    out = got(spark, words)
    assert out == brute(words)
    assert ("abcde", 1, 1, "abcdf", 2, "abcgf") in out
    assert S.variants(spark.createDataFrame([], WORDS)).collect() == []


def test_runs_of_the_query(spark, tmp_path):
    rows = [(1, "Hello hello HELLO, helo! x1hello2"), (2, None), (3, ""), (None, "hello÷hello Ärger ärger"), (4, "a" * 40_000)] * 3
    spark.createDataFrame(rows, "doc_id long, text string").withColumn("run", F.lit(1)).write.parquet(f"{tmp_path}/documents.parquet")
    out = {r.word: r.n for r in queries.op11_spelling_variants(spark, str(tmp_path)).collect()}
    assert out["hello"] >= 9 and "HELLO" not in out and "hello÷hello" in out and "Ärger" in out and "ärger" in out
