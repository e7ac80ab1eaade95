import numpy as np
import public_tokenizers
import pytest
import tiktoken
from llm_cases import SMALL, edge, empty  # noqa: F401
from pyspark.sql import functions as F

from hubcast.llm import queries, token_shards as T

RANKS, END = queries.RANKS, queries.END_MARK


@pytest.mark.parametrize("total", [1, 2, 3, 7, 64, 65, 1000])
def test_slots_are_a_permutation(spark, total):
    got = [r.s for r in spark.range(total).select(T.slot(F.col("id"), total, 5).alias("s")).collect()]
    assert sorted(got) == list(range(total))
    other = [r.s for r in spark.range(total).select(T.slot(F.col("id"), total, 6).alias("s")).collect()]
    assert total < 64 or got != other


def ids_of(texts):
    e = T._encoding(RANKS, public_tokenizers.PATTERN)
    return [[*e.encode_ordinary(t or ""), END] for t in texts]


def check(packed, rows, texts, length):
    ordered = T.training_order(packed, rows=rows).collect()
    assert [r.slot for r in sorted(ordered, key=lambda r: r.slot)] == list(range(len(ordered)))
    assert all((r.shard, r.row) == divmod(r.slot, rows) and len(r.ids) == 2 * length for r in ordered)
    streams = {}
    for r in packed.collect():
        streams.setdefault(r.part, {})[r.local] = np.frombuffer(r.ids, "<u2")[:r.n_ids]
    got = []
    for parts in streams.values():
        one = np.concatenate([parts[i] for i in sorted(parts)])
        got += [tuple(x) + (END,) for x in np.split(one, np.flatnonzero(one == END) + 1)[:-1] for x in [x[:-1].tolist()]]
    assert sorted(got) == sorted(map(tuple, ids_of(texts)))
    assert sorted(bytes(r.ids) for r in ordered) == sorted(bytes(r.ids) for r in packed.collect())


def test_every_id_of_every_document_is_there(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = [r.text for r in docs.collect()]
    check(T.pack(docs.repartition(5), RANKS, public_tokenizers.PATTERN, END, 128), 50, texts, 128)
    whole = queries.op6_token_shards(spark, SMALL).collect()
    assert sum(r.n_ids for r in whole) == sum(map(len, ids_of(texts)))


def test_edge_rows(edge, empty):
    texts = [r.text for r in edge.collect()]
    packed = T.pack(edge, RANKS, public_tokenizers.PATTERN, END, 64)
    check(packed, 7, texts, 64)
    assert T.training_order(T.pack(empty, RANKS, public_tokenizers.PATTERN, END)).collect() == []


def test_binary_shards_read_on_from_any_slot(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    ordered = T.training_order(T.pack(docs, RANKS, public_tokenizers.PATTERN, END, 64), rows=30)
    uri = f"file://{tmp_path}/shards"
    written = T.write_shards(ordered, uri).collect()
    want = {r.slot: bytes(r.ids) for r in ordered.collect()}
    assert sum(r["rows"] for r in written) == len(want)
    for start in (0, 29, 30, 77, len(want) - 1):
        got = [x.astype("<u2").tobytes() for x in T.read_from(uri, start, 30, 64)]
        assert got == [want[i] for i in range(start, len(want))]
    assert isinstance(T._encoding(RANKS, public_tokenizers.PATTERN), tiktoken.Encoding)
