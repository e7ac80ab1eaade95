import hashlib
import random

from llm_cases import SMALL  # noqa: F401
from pyspark.sql import functions as F

from hubcast.llm import chat_format as C, queries
from oracle_check import compare, duck

TURNS = "conv_id long, turn long, role string, text string"


def test_matches_sql(spark):
    n = "op10_chat_format"
    got = compare(spark, duck(SMALL), n, queries.QUERIES[n], queries.ORACLE_SQL[n], SMALL)
    assert got["exact"] and got["spark_rows"] == got["duck_rows"]


def formatted(spark, rows, **settings):
    df = C.conversations(C.messages_of(spark.createDataFrame(rows, TURNS).repartition(3)), **settings)
    return df.withColumn("back", C.read_back(F.col("formatted"))).withColumn(
        "loss", C.loss_text(F.col("formatted"), F.col("loss_spans"))).collect()


def test_any_text_comes_back(spark):
    r = random.Random(2)
    bits = ["\\", "<", ">", "\\b", "\\l", "<turn ", "</turn>\n", "\n", "é", "🙂", "### Assistant:", " ", "x", "$1", ""]
    text = lambda: "".join(r.choice(bits) for _ in range(r.randint(0, 12)))
    rows = [(c, t, r.choice(["user", "assistant", "a>b\n"]), text()) for c in range(60) for t in range(r.randint(1, 9))]
    for row in formatted(spark, rows):
        want = sorted((t, ro, tx) for c, t, ro, tx in rows if c == row.conv_id)
        assert [tuple(b) for b in row.back] == [(ro, tx) for _, ro, tx in want]
        assert row.loss == "".join(tx for _, ro, tx in want if ro == "assistant")
        assert row.n_turns == len(want)


def test_edge_rows(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", "x" * 200_000), (1, None, None, "first"), (2, 5, "user", "a"),
            (2, 5, "user", "a"), (2, 5, "assistant", "b"), (None, 1, "assistant", "n"), (3, 0, "assistant", "")]
    got = {r.conv_id: r for r in formatted(spark, rows)}
    assert [tuple(b) for b in got[1].back] == [("", "first"), ("user", ""), ("assistant", "x" * 200_000)]
    assert [tuple(b) for b in got[2].back] == [("assistant", "b"), ("user", "a"), ("user", "a")]
    assert got[None].loss == "n" and got[3].loss == "" and len(got) == 4
    assert C.conversations(C.messages_of(spark.createDataFrame([], TURNS))).collect() == []


def test_trees_give_their_best_branches(spark):
    #      a(0) -> b(1) -> d(5);  a -> c(2) -> e(0), c -> f(3);  g alone; h answers a message that is not there
    rows = [(1, "a", None, "user", "A", 0.0), (1, "b", "a", "assistant", "B", 1.0), (1, "d", "b", "user", "D", 5.0),
            (1, "c", "a", "assistant", "C", 2.0), (1, "e", "c", "user", "E", 0.0), (1, "f", "c", "user", "F", 4.0),
            (2, "g", None, "user", "G", None), (3, "h", "lost", "user", "H", 1.0)]
    m = spark.createDataFrame(rows, "conv_id long, message_id string, parent_id string, role string, text string, score double")
    paths = {}
    for r in C.paths(m).collect():
        paths.setdefault(r.leaf, {})[r.above] = r.message_id
    assert {k: [v[i] for i in sorted(v, reverse=True)] for k, v in paths.items()} == {
        "d": ["a", "b", "d"], "e": ["a", "c", "e"], "f": ["a", "c", "f"], "g": ["g"], "h": ["h"]}
    best = {(r.leaf, r["rank"]) for r in C.conversations(m, per_tree=2).collect()}
    assert best == {("d", 1), ("f", 2), ("g", 1), ("h", 1)}  # d and f tie at a mean of 2: the smaller id first


def test_long_chain_takes_few_rounds(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(300)]
    (r,) = formatted(spark, rows)
    assert r.n_turns == 300 and r.loss == "".join(f"t{i}" for i in range(1, 300, 2))
    assert hashlib.sha256(r.formatted.encode()).hexdigest()


MESSAGES = "conv_id long, message_id string, parent_id string, role string, text string, score double"


def test_cycles_end_and_keep_every_message(spark):
    rows = [(1, "a", "b", "user", "A", 0.0), (1, "b", "a", "assistant", "B", 1.0), (1, "c", "b", "user", "C", 0.0),
            (2, "s", "s", "user", "S", 0.0), (3, "r", None, "user", "R", 0.0)]
    rows += [(3, f"r{i}", f"r{i - 1}" if i else "r", "assistant", str(i), 0.0) for i in range(9)]
    got = {r.leaf: [t.text for t in r.turns] for r in C.conversations(spark.createDataFrame(rows, MESSAGES), per_tree=9)
           .select("leaf", C.read_back(F.col("formatted")).alias("turns")).collect()}
    assert got == {"a": ["A"], "b": ["B"], "c": ["C"], "s": ["S"], "r8": ["R", *map(str, range(9))]}


def test_repeated_ids_are_one_message_and_other_columns_take_no_part(spark):
    rows = [(1, "a", None, "user", "A", 0.0), (1, "b", "a", "assistant", "B", 1.0)] * 3
    rows += [(1, "b", "x", "assistant", "later", 0.0), (1, None, "a", "user", "no id", 9.0), (1, "a", None, "user", None, 0.5)]
    clashing = ["leaf", "rank", "above", "mid", "head", "body", "block", "start", "nth", "root", "path_score"]
    df = spark.createDataFrame(rows, MESSAGES).withColumns({c: F.lit("x") for c in clashing}).repartition(4)
    (r,) = C.conversations(df).collect()
    assert (r.conv_id, r.leaf, r["rank"], r.n_turns) == (1, "b", 1, 2)
    assert r.formatted == "<turn user>A</turn>\n<turn assistant>B</turn>\n"
