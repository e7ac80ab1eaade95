import hashlib
import re

import pytest
from llm_cases import EDGE, SMALL, edge, empty  # noqa: F401

from hubcast.llm import exact_dedup as E
from oracle_check import compare, duck
from hubcast.llm import queries


def test_matches_sql(spark):
    n = "op2_exact_dedup"
    got = compare(spark, duck(SMALL), n, queries.QUERIES[n], queries.ORACLE_SQL[n], SMALL)
    assert got["exact"] and got["spark_rows"] == got["duck_rows"]


def test_edge_rows(spark, edge, empty):
    rows = E.decide(edge, E.fresh_index(spark)).collect()
    assert len(rows) == edge.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert [(r.keep_id, r.group_size, r.kept) for r in by[6]] == [(1, 3, False)] * 2
    assert (by[3][0].keep_id, by[2][0].group_size, by[2][0].kept) == (2, 2, True)
    assert by[4][0].keep_id == 4  # one space is not the empty text
    one_space = re.sub(r"[\x20\x09-\x0D]+", " ", EDGE[5][1])
    assert by[6][0].text_sha256 == by[1][0].text_sha256 == hashlib.sha256(one_space.encode()).hexdigest()
    assert E.decide(empty, E.fresh_index(spark)).collect() == []
    assert E.unique(empty, E.fresh_index(spark)).collect() == []


def test_unique_returns_one_row_for_each_text(spark, edge):
    got = E.unique(edge.unionByName(edge), E.fresh_index(spark))
    assert got.columns == edge.columns
    assert sorted((r.doc_id or 0) for r in got.collect()) == [0, 1, 2, 4, 5, 7, 8, 9]


def test_index_persists_and_second_batch_is_checked_against_it(spark, tmp_path):
    schema = "doc_id long, text string"
    index = E.DigestIndex(spark, "digests_a", str(tmp_path / "index"), buckets=4)
    first = spark.createDataFrame([(10, "x y"), (11, "x  y"), (12, "z")], schema)
    assert {(r.doc_id, r.kept) for r in E.decide(first, index).collect()} == {(10, True), (11, False), (12, True)}
    spark.sql("DROP TABLE digests_a")  # an external table: the files stay
    again = E.DigestIndex(spark, "digests_a", str(tmp_path / "index"), buckets=4)
    second = spark.createDataFrame([(1, "x\ny"), (2, "new")], schema)
    assert {(r.doc_id, r.keep_id, r.kept) for r in E.decide(second, again).collect()} == {(1, 10, False), (2, 2, True)}
    before = again.rows().count()
    again.add(second.select("doc_id", E.digest(second["text"]).alias("text_digest")))
    assert again.rows().count() == before == 3
    plan = again.rows()._jdf.queryExecution().toString()
    assert "text_digest" in plan
    again.drop()


def test_index_keeps_its_buckets_under_another_shuffle_setting(spark, tmp_path):
    path, before = str(tmp_path / "index"), spark.conf.get("spark.sql.shuffle.partitions")
    seen = spark.range(200).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        assert E.decide(seen, E.DigestIndex(spark, "digests_b", path)).filter("kept").count() == 200
        spark.sql("DROP TABLE digests_b")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        again = E.DigestIndex(spark, "digests_b", path)
        assert again.buckets == 8
        more = seen.selectExpr("doc_id + 1000 AS doc_id", "text").unionByName(
            spark.createDataFrame([(5000, "other")], seen.schema))
        got = E.decide(more, again).collect()
        assert len(got) == 201 and [r.doc_id for r in got if r.kept] == [5000]
        assert again.rows().count() == 201
        with pytest.raises(ValueError, match="8 buckets"):
            E.DigestIndex(spark, "digests_b", path, buckets=4)
        for n in (4, 8):
            one = again.copy(f"digests_b{n}", str(tmp_path / f"copy{n}"), n)
            assert one.rows().count() == 201 and len(list((tmp_path / f"copy{n}").glob("*.parquet"))) <= n
            assert E.decide(more, one).filter("kept").count() == 1
            one.drop()
        again.drop()
        with pytest.raises(ValueError, match="no stored number"):
            (tmp_path / "index.buckets").rename(tmp_path / "elsewhere")
            E.DigestIndex(spark, "digests_b", path)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
