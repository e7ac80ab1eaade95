"""Quality rules: learned decision lists over text statistics.

Statistics of labelled documents go through sequential covering: a rule is grown
as a conjunction of thresholds by information gain, pruned on held-back rows, kept
when it is precise enough, and the rows that it covers leave before the next rule.
The list becomes one ordered Spark conditional expression. Two fixed rules come
first: fewer than 10 words, or over a fifth of the words in repeated 5-word windows.

Defined cases: a null or blank text has 0 for every statistic and fails the base
rules; a document labelled more than once counts as bad if any label says so; with
no labels the list is empty and the base rules decide alone; repeated rows are
judged alike, one row each; further columns pass through (statistics travel in one
struct, ``__stats``).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hubcast.llm import common

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct",
         "n_upper", "n_digits", "n_marks"]
# The character classes of the statistics.
WHITE, SYMBOLS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"
UPPER, DIGITS, MARKS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"!?;:\"'(){}[]@^~_=+/\\"
WINDOW = 5

# Features of the rules, as SQL over the statistics.
FEATURES = {
    "n_words": "n_words",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "repeated_lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeated_words": "n_repeat_words / greatest(n_words, 1)",
    "distinct_words": "n_distinct / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
    "marks_per_word": "n_marks / greatest(n_words, 1)",
    "words_per_line": "n_words / greatest(n_lines, 1)",
}


def repeated_words(w: list[bytes]) -> int:
    """Words inside WINDOW-word windows that occur twice or more, the first included."""
    windows = list(zip(*(w[i:] for i in range(WINDOW))))
    if len(set(windows)) == len(windows):
        return 0
    counts, covered, end = Counter(windows), 0, 0
    for i, g in enumerate(windows):
        if counts[g] > 1:
            covered += i + WINDOW - max(end, i)
            end = i + WINDOW
    return covered


def text_stats(text: str | None) -> tuple[int, ...]:
    """The STATS of one text."""
    if not text:
        return (0,) * len(STATS)
    raw, w = text.encode(), common.words(text)
    count = lambda chars: len(raw) - len(raw.translate(None, chars))
    lines = [x for x in raw.split(b"\n") if x.strip(WHITE)]
    return (len(w), len(text) - count(WHITE), count(SYMBOLS), len(lines) - len(set(lines)), repeated_words(w),
            len(lines), len(set(w)), count(UPPER), count(DIGITS), count(MARKS))


def with_stats(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the struct ``__stats``; ``keep`` names the columns to carry on (all)."""
    keep = docs.columns if keep is None else keep
    stats = T.StructType([T.StructField(s, T.LongType()) for s in STATS])
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("__stats", stats)])
    arrow = pa.struct([(s, pa.int64()) for s in STATS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [text_stats(t) for t in b.column("text").to_pylist()]
            columns = [pa.array(np.array(c, np.int64)) for c in zip(*found)] or [pa.array([], pa.int64())] * len(STATS)
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in keep] + [pa.StructArray.from_arrays(columns, fields=list(arrow))],
                names=[*keep, "__stats"])

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, schema)


def feature(name: str) -> Column:
    return F.expr(re.sub(rf"\b({'|'.join(STATS)})\b", r"__stats.\1", FEATURES[name])).cast("double")


def base_failed() -> Column:
    n, r = F.col("__stats.n_words"), F.col("__stats.n_repeat_words")
    return (n < 10) | (100 * r > 20 * n)


def _gain(pos: np.ndarray, neg: np.ndarray, mask: np.ndarray, p0: int, n0: int) -> float:
    p, n = int((pos & mask).sum()), int((neg & mask).sum())
    if p == 0:
        return -1.0
    return p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))


class DecisionList:
    """Ordered rules, each a list of (feature, ``<=`` or ``>``, threshold)."""

    def __init__(self, rules: list[list[tuple[str, str, float]]]):
        self.rules = rules

    def expression(self) -> Column:
        """The number of the first rule that holds, null if none does."""
        out = None
        for i, rule in enumerate(self.rules):
            test = F.lit(True)
            for name, op, cut in rule:
                test = test & (feature(name) <= cut if op == "<=" else feature(name) > cut)
            out = F.when(test, i) if out is None else out.when(test, i)
        return F.lit(None).cast("int") if out is None else out


def covers(rule: list[tuple[str, str, float]], x: dict[str, np.ndarray]) -> np.ndarray:
    mask = np.ones(len(next(iter(x.values()))), bool)
    for name, op, cut in rule:
        mask &= x[name] <= cut if op == "<=" else x[name] > cut
    return mask


def learn(x: dict[str, np.ndarray], bad: np.ndarray, max_rules: int = 16, max_tests: int = 4,
          precision: float = 0.95, least: int = 3, thresholds: int = 48) -> DecisionList:
    """Sequential covering of the bad rows; every third row is held back for pruning."""
    rules: list[list[tuple[str, str, float]]] = []
    left, held = np.ones(len(bad), bool), np.arange(len(bad)) % 3 == 2
    cuts = {f: np.unique(np.quantile(v, np.linspace(0, 1, thresholds + 1)[:-1])) for f, v in x.items() if len(v)}
    while len(rules) < max_rules and (left & bad).sum() >= least:
        pos, neg = left & bad & ~held, left & ~bad & ~held
        rule: list[tuple[str, str, float]] = []
        inside = np.ones(len(bad), bool)
        while len(rule) < max_tests and (neg & inside).any() and (pos & inside).any():
            p0, n0 = int((pos & inside).sum()), int((neg & inside).sum())
            best = max(((_gain(pos, neg, inside & (v <= c if op == "<=" else v > c), p0, n0), f, op, float(c))
                        for f, v in x.items() for c in cuts[f] for op in ("<=", ">")), default=(0.0,))
            if best[0] <= 1e-9:
                break
            rule.append(best[1:])
            inside &= covers([best[1:]], x)
        if not rule:
            break

        def worth(r: list[tuple[str, str, float]]) -> float:
            m = covers(r, x) & left & held
            p, n = int((m & bad).sum()), int((m & ~bad).sum())
            return (p + 1) / (p + n + 2)

        rule = max((rule[:k] for k in range(len(rule), 0, -1)), key=worth)
        hit = covers(rule, x) & left
        if (hit & bad).sum() < least or (hit & bad).sum() < precision * hit.sum():
            break
        rules.append(rule)
        left &= ~hit
    return DecisionList(rules)


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000) -> DecisionList:
    """Learns from at most ``max_rows`` labelled documents, those with the lowest hash of doc_id.

    The bound keeps the joined label rows and what the driver receives (ten numbers
    a row) to a fixed size at any corpus size.
    """
    chosen = (labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id")
              .agg((F.min("quality") == 0).alias("__bad"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    seen = with_stats(joined, ["doc_id", "__bad"]).filter(~base_failed())
    rows = (seen.select(F.xxhash64("doc_id").alias("h"), "doc_id", "__bad", *[feature(f).alias(f) for f in FEATURES])
            .toPandas().sort_values(["h", "doc_id"], kind="stable"))
    return learn({f: rows[f].to_numpy(float) for f in FEATURES}, rows["__bad"].to_numpy(bool))


def judge(docs: DataFrame, rules: DecisionList) -> DataFrame:
    """doc_id, the statistics, base_failed, rule (number, null: none) and kept, one row per row."""
    out = with_stats(docs, ["doc_id"]).withColumn("base_failed", base_failed())
    return out.withColumn("rule", rules.expression()).select(
        "doc_id", "__stats.*", "base_failed", "rule", (~F.col("base_failed") & F.col("rule").isNull()).alias("kept"))


def keep(docs: DataFrame, rules: DecisionList) -> DataFrame:
    """The rows of ``docs`` that pass, all columns."""
    return with_stats(docs).filter(~base_failed() & rules.expression().isNull()).select(*docs.columns)
