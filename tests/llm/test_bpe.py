import hashlib
import random
from itertools import product

import numpy as np
import public_tokenizers
import pytest
from llm_cases import SMALL, edge, empty  # noqa: F401
from tokenizers import Tokenizer

from hubcast.llm import bpe, queries

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(FILE)
    t.no_truncation()
    t.no_padding()
    return t


def digests(t, text):
    ids = t.encode(text or "", add_special_tokens=False).ids
    decoded = t.decode(ids, skip_special_tokens=False)
    return (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())


def test_query_matches_the_library(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r)[1:] for r in queries.op5_bpe_codec(spark, SMALL).collect()}
    assert got == {d: digests(library, t) for d, t in texts.items()}


def test_edge_rows(spark, edge, empty, library):
    rows = bpe.encode(edge, FILE, with_ids=True).collect()
    texts = {r.doc_id: r.text for r in edge.collect()}
    assert len(rows) == edge.count()
    for r in rows:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == digests(library, texts[r.doc_id])
        assert r.decoded == (texts[r.doc_id] or "") and len(r.ids) == r.n_tokens
    assert bpe.encode(empty, FILE).collect() == []


def test_odd_characters(library):
    c, r = bpe.Codec(FILE), random.Random(5)
    pool = "aabcdef  \n\t\r\x0b\x1c\x1f\x85\xa0'stvemld.,!?#$*éü漢字🙂​ 　0123½²Ⅷ"
    for _ in range(3000):
        s = "".join(r.choice(pool) for _ in range(r.randint(0, 40))) + r.choice(["", "<|endoftext|>", "####", "....."])
        ids = list(memoryview(c.encode(s)).cast("I"))
        assert ids == library.encode(s, add_special_tokens=False).ids, repr(s)
        assert c.decode(c.encode(s)) == s


def naive(word, merges):
    parts = list(word)
    for u, v in merges:
        i = 0
        while i < len(parts) - 1:
            if parts[i] == u and parts[i + 1] == v:
                parts[i:i + 2] = [u + v]
            i += 1
    return parts


@pytest.mark.parametrize("seed", range(25))
def test_automaton_accepts_one_path_the_merges_give(seed):
    r = random.Random(seed)
    tokens, merges = ["a", "b", "c"], []
    while len(merges) < 9:
        u, v = r.choice(tokens), r.choice(tokens)
        if u + v not in tokens:
            merges.append((u, v))
            tokens.append(u + v)
    ids = {t.encode(): i for i, t in enumerate(tokens)}
    a = bpe.Automaton({i: t for t, i in ids.items()}, [(ids[u.encode()], ids[v.encode()]) for u, v in merges], ids)
    for n in range(1, 8):
        for w in product("abc", repeat=n):
            word = "".join(w)
            want = naive(word, merges)
            assert [tokens[t] for t in a.encode(word.encode())] == want, (merges, word)
            states = {(0, -1): 1}  # (end, last token) -> accepted paths
            for at in range(n):
                for (p, last), count in list(states.items()):
                    if p == at:
                        for end in range(at + 1, n + 1):
                            t = a.ids.get(word[at:end].encode())
                            if t is not None and (last < 0 or a.arc(last, t)):
                                states[end, t] = states.get((end, t), 0) + count
            assert sum(c for (p, _), c in states.items() if p == n) == 1, (merges, word)


def test_the_longest_label_is_bounded_by_four_bytes():
    a = bpe.Codec(FILE).automaton
    longest = {}
    for label in a.ids:
        if len(label) > 3:
            longest[label[:4]] = max(longest.get(label[:4], 0), len(label))
    assert longest and all(a.reach[k] == v for k, v in longest.items())
