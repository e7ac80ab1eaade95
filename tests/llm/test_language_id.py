import numpy as np
from llm_cases import MEDIUM, SMALL, edge, empty  # noqa: F401

from hubcast.llm import language_id as L, queries


def test_held_out_accuracy(spark):
    sf = MEDIUM
    got = queries.op4_language_id(spark, sf).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(got) == len(lang)
    held = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_edge_rows(spark, edge, empty):
    model = L.fit(edge)
    got = {}
    for r in L.predict(edge, model).collect():
        got.setdefault(r.doc_id, set()).add((r.lang_pred, r.score))
    assert got[2] == got[3] == got[4] == got[7] == {("und", 0.0)}
    assert len(got[6]) == 1 and all(len(v) == 1 for v in got.values())
    assert {x[0] for v in got.values() for x in v} <= {"en", "de", "fr", "und"}
    none = L.fit(empty)
    assert {r.lang_pred for r in L.predict(edge, none).collect()} == {"und"}
    assert L.predict(empty, model).collect() == []


def test_pieces_of_long_texts_add_up(monkeypatch):
    text = "Der Hund läuft über die Straße und bellt " * 30
    whole = L.gram_counts(text)
    monkeypatch.setattr(L, "PIECE", 17)
    assert (L.gram_counts(text) == whole).all()


def test_weights_are_sparse_and_scores_calibrated():
    r = np.random.default_rng(1)
    model = L.LanguageModel(["a", "b"], np.ones(L.DIM))
    rows = []
    for i in range(300):
        y = i % 2
        at = np.unique(r.integers(0, 200, 20) + 300 * (y if r.random() < 0.8 else 1 - y))
        rows.append((at, np.full(len(at), len(at) ** -0.5), y))
    L.train(rows, model)
    assert (model.weights == 0).mean() > 0.99
    L.calibrate(rows, model)
    p = L.softmax(np.array([v @ model.weights[at] + model.bias for at, v, _ in rows]) / model.temperature)
    right = p.argmax(1) == [y for _, _, y in rows]
    assert abs(p.max(1).mean() - right.mean()) < 0.06
