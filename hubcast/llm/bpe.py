"""Byte-pair encoding as a deterministic tokenization automaton.

The automaton starts with one state that loops on every byte. Each merge (u, v) in
order of rank adds a gadget: the state that arcs labelled u lead to is split, the copy
for u loses its arc v, and every state with an arc u gets an arc uv to the state
after v. What is accepted in the end are exactly the tokenizations that byte-pair
encoding yields, one for each byte string. A word is encoded by following arcs from
the start and taking back those from which the word's end can't be reached; decoding
joins the arc labels.

The state after an arc depends on its label alone, so a state is named by the token
that was read last. Spelled out, 50,000 states with thousands of arcs each would not
fit in memory; the gadgets are kept in the order of construction instead, and an arc
is looked up in them once and then kept in a bounded table.

Defined cases: a null text counts as empty and gives no ids; the special token's string
inside a text becomes its id, as the tokenizers library does; repeated rows are encoded
alike, one row each; whole texts are read, however long.
"""

from __future__ import annotations

import json
import sys
from array import array
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame

# Fixed value: the published pattern that splits a text before byte-level merging. Its \s is the
# Unicode property; \s of the regex module also matches the separators U+001C to U+001F.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPACE_AS_PROPERTY = [(r"[^\s", r"[^\p{White_Space}"), (r"\S", r"\P{White_Space}"), (r"\s", r"\p{White_Space}")]
KEPT = 1 << 18  # entries of each table kept in a task
assert array("I").itemsize == 4 and sys.byteorder == "little"


def byte_letters() -> dict[str, int]:
    """The published byte-level alphabet: printable bytes stand for themselves, the rest follow from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Automaton:
    """Arc labels and merge gadgets, compiled from (left id, right id) merges in order of rank."""

    def __init__(self, labels: dict[int, bytes], merges: list[tuple[int, int]], ids: dict[bytes, int]):
        self.labels = labels
        size = max(labels, default=-1) + 1
        self.born = [-1] * size  # number of the merge that made the token; -1: a byte
        self.left, self.right = [-1] * size, [-1] * size
        self.cut: dict[tuple[int, int], int] = {}  # the gadget that took arc v from the state after u
        self.arcs: dict[int, bool] = {}  # state << 32 | arc: one number is looked up faster than a pair
        self.ids: dict[bytes, int] = {labels[t]: t for t in labels if len(labels[t]) == 1}
        self.reach: dict[bytes, int] = {}  # the longest label that starts with these four bytes
        for k, (u, v) in enumerate(merges):
            self._gadget(k, u, v, ids[labels[u] + labels[v]])

    def _gadget(self, k: int, u: int, v: int, uv: int) -> None:
        live = self.labels[u] in self.ids and self.labels[v] in self.ids and self._arc(u, v, k)
        self.cut[u, v] = k
        if live:  # otherwise no state has an arc u to a state with an arc v
            self.born[uv], self.left[uv], self.right[uv] = k, u, v
            self.ids[self.labels[uv]] = uv
            label = self.labels[uv]
            self.reach[label[:4]] = max(self.reach.get(label[:4], 3), len(label))

    def _arc(self, s: int, t: int, at: int) -> bool:
        """Whether the state after s has an arc t once the merges before number ``at`` are in."""
        while True:
            if self.cut.get((s, t), at) < at:
                return False
            if self.born[s] < 0 and self.born[t] < 0:
                return True
            if self.born[s] > self.born[t]:  # s came with the state that followed its right part
                at, s = self.born[s], self.right[s]
            else:  # t was added where its left part was an arc, after its own gadget's split
                at, t = self.born[t] + 1, self.left[t]

    def arc(self, s: int, t: int) -> bool:
        got = self.arcs.get(s << 32 | t)
        if got is None:
            if len(self.arcs) >= KEPT:
                self.arcs.clear()
            got = self.arcs[s << 32 | t] = self._arc(s, t, len(self.cut) + 1)
        return got

    def encode(self, word: bytes) -> list[int]:
        """The one accepted path over ``word``."""
        n, ids, arc, known, reach = len(word), self.ids, self.arc, self.arcs.get, self.reach
        path: list[tuple[int, int, int]] = []  # (start, end, token)
        at, last, end, dead = 0, -1, min(n, reach.get(word[:4], 3)), set()
        while at < n:
            while end > at:
                if end not in dead:
                    t = ids.get(word[at:end])
                    if t is not None:
                        if last < 0:
                            break
                        ok = known(last << 32 | t)
                        if ok or ok is None and arc(last, t):
                            break
                end -= 1
            if end > at:
                path.append((at, end, t))
                at, last, end = end, t, min(n, end + reach.get(word[end:end + 4], 3))
            else:  # a position from which no arc goes on is dead: its last token is fixed by what precedes it
                dead.add(at)
                start, stop, _ = path.pop()
                at, end, last = start, stop - 1, path[-1][2] if path else -1
        return [t for _, _, t in path]


class Words(dict):
    """Pre-split word -> its ids as little-endian 32-bit integers; a bounded table that fills itself."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: str) -> bytes:
        if len(self) >= KEPT:
            self.clear()
        got = self[word] = array("I", self.automaton.encode(word.encode())).tobytes()
        return got


class Codec:
    """Splits texts, encodes their words by the automaton, and decodes ids."""

    def __init__(self, tokenizer_file: str):
        with open(tokenizer_file, encoding="utf-8") as f:
            spec = json.load(f)
        letters, vocab = byte_letters(), spec["model"]["vocab"]
        labels = {i: bytes(letters[c] for c in s) for s, i in vocab.items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.automaton = Automaton(labels, [(vocab[a], vocab[b]) for a, b in pairs], {b: i for i, b in labels.items()})
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.labels = labels | {i: s.encode() for s, i in self.special.items()}
        self.parts = regex.compile("(" + ("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))
                                          or r"(?!)") + ")")
        pattern = PATTERN
        for short, full in SPACE_AS_PROPERTY:
            pattern = pattern.replace(short, full)
        self.split = regex.compile(pattern).findall
        self.known = Words(self.automaton)

    def encode(self, text: str | None) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        out = []
        for part in self.parts.split(text or ""):
            if part in self.special:
                out.append(array("I", [self.special[part]]).tobytes())
            else:
                out += map(self.known.__getitem__, self.split(part))
        return b"".join(out)

    def forget(self) -> None:
        """Drops the tables that filled themselves; workers outlive their tasks."""
        self.known.clear()
        self.automaton.arcs.clear()

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.labels.__getitem__, array("I", ids))).decode("utf-8", "replace")


_CODECS: dict[str, Codec] = {}


def codec(tokenizer_file: str) -> Codec:
    """One codec for each file and Python worker: compiling the gadgets takes a second."""
    if tokenizer_file not in _CODECS:
        _CODECS[tokenizer_file] = Codec(tokenizer_file)
    return _CODECS[tokenizer_file]


def encode(docs: DataFrame, tokenizer_file: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for every row of ``docs``; with_ids: also ids, decoded.

    The vocabulary is shipped to the executors as a job file.
    """
    docs.sparkSession.sparkContext.addFile(tokenizer_file)
    name = tokenizer_file.rsplit("/", 1)[-1]
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>, decoded string" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(SparkFiles.get(name))
        for b in batches:
            for part in (b.slice(i, 512) for i in range(0, b.num_rows, 512)):
                rows = []
                for t in part.column("text").to_pylist():
                    ids = c.encode(t)
                    decoded = c.decode(ids)
                    rows.append((len(ids) // 4, sha256(ids).hexdigest(), sha256(decoded.encode()).hexdigest(),
                                 *((np.frombuffer(ids, "<i4"), decoded) if with_ids else ())))
                columns = [list(x) for x in zip(*rows)]
                kinds = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(x, k) for x, k in zip(columns, kinds))],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"][:len(columns) + 1])
        c.forget()

    return docs.select("doc_id", "text").mapInArrow(run, schema)
