import hashlib
import random
import re
import time

import pytest
from llm_cases import CLASHING, EDGE, SMALL
from pyspark.sql import functions as F

from hubcast.llm import common, decontamination as D, queries
from oracle_check import compare, duck

ITEMS = "item_id string, text string"
DOCS = "doc_id long, text string"
LOW = str.maketrans(common.UPPER, common.LOWER)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(text.translate(LOW)) if text else []


def test_matches_sql(spark):
    n = "op13_decontaminate"
    got = compare(spark, duck(SMALL), n, queries.QUERIES[n], queries.ORACLE_SQL[n], SMALL)
    assert got["exact"] and got["spark_rows"] == got["duck_rows"]


def brute(docs, items, length):
    windows = {}
    for i, text in items:
        w = words(text)
        size = min(length, len(w))
        for s in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[s:s + size]), set()).add(i or "")
    sizes = {len(x) for x in windows}
    out = []
    for d, text in docs:
        w, hit, ids = words(text), set(), set()
        for size in sizes:
            for s in range(len(w) - size + 1):
                if (found := windows.get(tuple(w[s:s + size]))):
                    hit.update(range(s, s + size))
                    ids |= found
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids, key=str.encode)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def got(spark, docs, items, length, extra=()):
    d = spark.createDataFrame(docs, DOCS).repartition(4).withColumns({c: F.lit("x") for c in extra})
    i = spark.createDataFrame(items, ITEMS).withColumns({c: F.lit("y") for c in extra})
    index = D.PositionalIndex.fresh(spark).add(d)
    out = D.flag(d, i, index, length)
    assert out.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    return sorted(map(tuple, out.collect()), key=str)


@pytest.fixture(params=[32 << 20, 0], ids=["broadcast", "shuffled"])
def limit(request, monkeypatch):
    small = common.small
    monkeypatch.setattr(common, "small", lambda df: small(df, request.param))


def test_as_brute_force(spark, limit):
    r = random.Random(4)
    letters = "a b c d e".split() + ["the"] * 6
    text = lambda n: " ".join(r.choice(letters) for _ in range(n))
    items = [(str(i), text(r.choice([1, 2, 4, 9, 30]))) for i in range(25)]
    docs = [(i, text(r.randint(0, 120))) for i in range(40)]
    assert got(spark, docs, items, 4) == brute(docs, items, 4)


def test_edge_rows(spark, limit):
    passage = "One, two THREE four; five six seven eight nine ten eleven"
    items = [("a", passage), ("b", "short ÉCOLE"), ("b", "other short"), (None, "lonely"), ("c", None), ("d", " .,; "), ("a", passage),
             ("long", " ".join(f"w{i}" for i in range(400)))]
    docs = [(r[0], r[1]) for r in EDGE] + [
        (20, f"x {passage.upper()}!! y"), (20, f"another text, {passage}"), (21, "one two three four five six seven eight nine"),
        (None, f"lonely {passage} lonely"), (22, "a short ÉCOLE and a short école"), (23, "othershort other-short"),
        (24, " ".join(f"w{i}" for i in range(500))), (25, (passage + " ") * 300), (25, (passage + " ") * 300)]
    assert got(spark, docs, items, 10, CLASHING + ["pos", "term", "item", "words", "sig", "p"]) == brute(docs, items, 10)


def test_empty_tables(spark):
    assert got(spark, [], [("a", "one two")], 10) == []
    assert got(spark, [(1, "one two"), (2, None)], [], 10) == brute([(1, "one two"), (2, None)], [], 10)


def test_index_grows_and_finds_terms_that_are_close(spark):
    docs = spark.createDataFrame([(1, "alpha x x beta x gamma"), (2, "gamma beta " + "x " * 30 + "alpha")], DOCS)
    index = D.PositionalIndex.fresh(spark).add(docs).add(spark.createDataFrame([(3, "Gamma, alpha beta x")], DOCS))
    items = D.prepare(spark.createDataFrame([("i", "alpha beta gamma x x x unseen")], ITEMS))
    assert {(r.doc_id, r.first, r.last) for r in D.proximity(index, items, terms=3, within=8).collect()} == {(1, 0, 5), (3, 0, 2)}
    assert {(r.doc_id, r["first"], r.n) for r in D.phrases(index, D.prepare(spark.createDataFrame([("j", "alpha beta")], ITEMS))).collect()} == {(3, 1, 2)}


def test_lengths_come_from_the_index(spark, monkeypatch):
    """Texts are split into words once, for the index."""
    docs = spark.createDataFrame([(1, "One two, three"), (1, "four"), (1, "four"), (2, None), (3, " .,; "), (None, "É 5")], DOCS)
    index = D.PositionalIndex.fresh(spark).add(docs).add(spark.createDataFrame([(4, "not asked for")], DOCS))
    monkeypatch.setattr(D, "WORD", "no such word")
    items = spark.createDataFrame([], ITEMS)
    assert sorted(((r.doc_id, r.n_words) for r in D.flag(docs, items, index).collect()), key=str) == [
        (1, 1), (1, 1), (1, 3), (2, 0), (3, 0), (None, 2)]
    assert {r.term for r in index.postings().collect() if r.doc_id in (2, 3)} == {""}


RANGES = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def test_words_of_every_code_point(spark):
    points = [i for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    texts = [" a".join(map(chr, points[i:i + 4096])) + "b" for i in range(0, len(points), 4096)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], DOCS)
    for r in df.select("text", D._words(F.col("text")).alias("words"),
                       F.regexp_extract_all("text", F.lit(RANGES), F.lit(0)).alias("plain")).collect():
        assert r["words"] == r["plain"] == re.findall(RANGES, r["text"])


def test_words_are_found_by_a_table_of_characters(spark):
    """Taking the words is most of what building the index costs; ranges take several times as long."""
    prose = spark.range(0, 2000, 1, 2).select(F.concat_ws(" ", F.lit("Éa, the words of THE prose 42 " * 200), F.col("id").cast("string")).alias("text"))

    def seconds(pattern):
        def once():
            began = time.perf_counter()
            prose.agg(F.sum(F.regexp_count("text", F.lit(pattern)))).collect()
            return time.perf_counter() - began
        return min(once() for _ in range(4))

    assert seconds(D.WORD) < 0.7 * seconds(RANGES)
