import re
from collections import Counter

import numpy as np
import pytest
from llm_cases import MEDIUM, SMALL, edge, empty  # noqa: F401

from hubcast.llm import queries, quality_rules as Q


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    counts = Counter(windows)
    inside = {j for i, g in enumerate(windows) if counts[g] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(inside))


def test_statistics_match_brute_force(spark):
    got = queries.op1_quality_rules(spark, SMALL).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert len(got) == len(texts)
    for r in got:
        stats = brute(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == stats
        assert r.base_failed == (stats[0] < 10 or 100 * stats[4] > 20 * stats[0])
        assert r.kept == (not r.base_failed and r.rule is None)


def test_rules_find_the_bad_and_keep_the_good(spark):
    got = {r.doc_id: r.kept for r in queries.op1_quality_rules(spark, MEDIUM).collect()}
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()
    good = [got[r.doc_id] for r in labels if r.quality == 1]
    bad = [got[r.doc_id] for r in labels if r.quality == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.1


@pytest.mark.parametrize("text", ["a b c d e a b c d e", "a a a a a a a", "x\nx\n \nx", "a b c d", "a b c d e f a b c d e g"])
def test_hand_made_texts(text):
    assert Q.text_stats(text)[:5] == brute(text)


def test_covering_learns_a_conjunction():
    r = np.random.default_rng(0)
    x = {"a": r.random(900), "b": r.random(900)}
    bad = (x["a"] > 0.6) & (x["b"] <= 0.5)
    rules = Q.learn(x, bad, thresholds=40)
    hit = np.zeros(900, bool)
    for rule in rules.rules:
        hit |= Q.covers(rule, x)
    assert (hit & ~bad).sum() <= 0.05 * hit.sum() and (hit & bad).sum() > 0.8 * bad.sum()


def test_no_labels_leave_the_base_rules(spark, edge, empty):
    labels = spark.createDataFrame([(1, None), (None, 0)], "doc_id long, quality int")
    rules = Q.fit(edge, labels)
    assert rules.rules == []
    kept = {r.doc_id for r in Q.keep(edge, rules).collect()}
    assert kept == {1, 5, 6, None} and Q.keep(edge, rules).columns == edge.columns
    assert len(Q.judge(edge, rules).collect()) == edge.count()
    assert Q.judge(empty, Q.fit(empty, labels)).collect() == []
