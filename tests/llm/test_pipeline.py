import hashlib
import re

import numpy as np
from llm_cases import SMALL, edge, empty  # noqa: F401
from test_bpe import library  # noqa: F401
from test_ngram_join import brute

import corpus_pipeline as P
from hubcast.llm import mixing, quality_rules


def test_stages_do_what_brute_force_does(spark, library):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rules = quality_rules.fit(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    good = {r.doc_id for r in quality_rules.judge(docs, rules).collect() if r.kept}
    rows = sorted((r.doc_id, r.text, r.source) for r in docs.collect() if r.doc_id in good)
    seen, left = set(), []
    for d, t, s in rows:
        key = re.sub(r"[\x20\x09-\x0D]+", " ", t)
        if key not in seen:
            seen.add(key)
            left.append((d, t, s))
    classes = brute([(d, t) for d, t, _ in left], 5, 80)
    left = [x for x in left if classes[x[0]][1] == x[0]]
    plan = mixing.repetitions(spark.createDataFrame(left, "doc_id long, text string, source string")).collect()
    times = {r.doc_id: r["repeats"] for r in plan}
    want = []
    for d, t, _ in left:
        ids = np.array(library.encode(t, add_special_tokens=False).ids, "<u4")
        want += [(d, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())] * times[d]
    got = sorted(tuple(r) for r in P.run(spark, SMALL).collect())
    assert got == sorted(want) and len({r[0] for r in got}) < docs.count()


def test_stages_on_edge_rows(spark, edge, empty):
    for docs in (edge, empty):
        columns = docs.columns
        for i, (_, stage) in enumerate(P.STAGES):
            out = stage(spark, docs, SMALL)
            if i < len(P.STAGES) - 1:
                assert out.columns == columns
            docs = out
        rows = docs.collect()
        assert bool(rows) == (columns == edge.columns)


def test_clean_documents_stay(spark):
    """Documents labelled good, without equal or similar others, survive the filtering stages."""
    sf = SMALL.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = P.quality(spark, docs, sf)
    good = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r.quality == 1}
    assert len(good - {r.doc_id for r in kept.collect()}) <= 0.03 * len(good)
