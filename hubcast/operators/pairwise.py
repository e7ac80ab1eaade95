"""Pairwise relative skill.

Per comparison cell, for each ordered pair of models (A, B) the mean score
ratio is sum of A's scores over the units both forecast / the same for B;
theta_A is the geometric mean of A's ratios over all B (itself included,
ratio 1, undefined ratios skipped) and the relative skill is
theta_A / theta_baseline. Cells with a single model give no rows; a cell
without the baseline gives NULL relative skill.

The sums of a pair come from ``pair_changes``: score rows meet by cell, and a task
adds the vectors of each forecast unit (values, zero where a model has none, and counts)
to dense matrices of the cell and day, both metrics at once. A matrix is sent once,
however many units it holds. Reports take running sums of those, and the
"Overall" cell is the sum over locations, since its units are theirs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import log_ratio, ordered_mean, safe_div, settle
from . import history

OPEN = 8  # matrices of a cell that a task holds at once
SALTS = 8  # tasks that the units of one cell are dealt to, so a cell that holds most rows is shared


class _Block:
    """Sums over the units of one cell and day for every two members, by their numbers.

    ``both`` counts the matches, ``sums[k][i, j]`` adds what i scored by metric k where j has a score too,
    ``counts[k][i, j]`` counts those.
    """

    def __init__(self, metrics: int):
        self.both, self.sums, self.counts = np.zeros((0, 0)), np.zeros((metrics, 0, 0)), np.zeros((metrics, 0, 0))

    def grow(self, size: int) -> None:
        if size > len(self.both):
            more = max(8, 2 * size) - len(self.both)
            self.both = np.pad(self.both, (0, more))
            self.sums, self.counts = (np.pad(x, ((0, 0), (0, more), (0, more))) for x in (self.sums, self.counts))

    def add(self, x: tuple, y: tuple) -> None:
        """Members (numbers, matches, sums, counts) of a unit against members of the same unit."""
        at = np.ix_(x[0], y[0])
        self.both[at] += np.outer(x[1], y[1])
        for k in range(len(self.sums)):
            self.sums[k][at] += np.outer(x[2][k], y[3][k])
            self.counts[k][at] += np.outer(x[3][k], y[3][k])


def _members(rows: list[tuple], number: dict[str, int], metrics: int) -> tuple:
    """(numbers, matches, sums, counts) of the rows (model, values) of a unit, a model once."""
    of: dict[int, list[tuple]] = {}
    for model, *values in rows:
        of.setdefault(number.setdefault(model, len(number)), []).append(values)
    at = np.array(list(of))
    values = [[[v[k] for v in vs if v[k] is not None] for vs in of.values()] for k in range(metrics)]
    return (at, np.array([len(vs) for vs in of.values()], float),
            [np.array([sum(v) for v in x], float) for x in values], [np.array([len(v) for v in x], float) for x in values])


def pair_changes(rows: DataFrame, cell: list[str], unit: list[str],
                 metrics: dict[str, Column]) -> DataFrame:
    """(cell, a, b, day, sums): for a <= b and each metric, ``name_a`` and ``name_b`` are the sums
    over shared units and ``name_n`` their number. Rows carry ``enter`` and ``leave``; a unit
    that a model forecast twice counts once for each match.

    Units arrive in order of ``unit``, whose first column should go with time: a task holds
    the matrices of the few days around it.
    """
    names = list(metrics)
    values = [F.when(~F.isnan(c), c.cast("double")).alias(f"_{n}") for n, c in metrics.items()]
    flat = rows.filter(F.col("model").isNotNull()).select(
        *[F.col(c).alias(f"_c{i}") for i, c in enumerate(cell)], *[F.col(c).alias(f"_u{i}") for i, c in enumerate(unit)],
        "enter", "leave", "model", *values)
    n_cell, n_unit = len(cell), len(unit)
    keys = [f"_c{i}" for i in range(n_cell)]
    units = [f"_u{i}" for i in range(n_unit)]
    schema = T.StructType([*flat.select(*keys).schema.fields, T.StructField("a", T.StringType()), T.StructField("b", T.StringType()),
                           T.StructField("enter", T.DateType()), T.StructField("leave", T.DateType()),
                           *[T.StructField(f"_{c}", T.DoubleType()) for c in sum_names(names)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, number, blocks, held = None, {}, {}, []
        kinds = None

        def close() -> None:
            """Adds the unit that is held to its matrices."""
            days: dict[tuple, list] = {}
            for r in held:
                days.setdefault(r[n_cell + n_unit:n_cell + n_unit + 2], []).append(r[n_cell + n_unit + 2:])
            parts = [(d, _members(x, number, len(names))) for d, x in days.items()]
            for (enter, leave), x in parts:
                for (enter2, leave2), y in parts:
                    day = (max(enter, enter2), min((d for d in (leave, leave2) if d), default=None))
                    if day[1] is None or day[0] < day[1]:
                        block = blocks.setdefault(day, _Block(len(names)))
                        block.grow(len(number))
                        block.add(x, y)

        def send() -> Iterator[pa.RecordBatch]:
            order = sorted(number, key=number.get)
            for (enter, leave), block in blocks.items():
                i, j = np.nonzero(block.both)
                keep = np.array([order[x] <= order[y] for x, y in zip(i, j)], bool)
                i, j = i[keep], j[keep]
                sums = [c for k in range(len(names)) for c in (block.sums[k][i, j], block.sums[k][j, i], block.counts[k][i, j])]
                own = [pa.array([v] * len(i), t) for v, t in zip((*at, enter, leave), (*kinds[:n_cell], pa.date32(), pa.date32()))]
                yield pa.RecordBatch.from_arrays(
                    [*own[:n_cell], pa.array([order[x] for x in i], pa.string()), pa.array([order[x] for x in j], pa.string()),
                     *own[n_cell:], *map(pa.array, sums)], names=[f.name for f in schema.fields])
            blocks.clear()

        for b in batches:
            kinds = [c.type for c in b.columns]
            for r in zip(*(c.to_pylist() for c in b.columns)):
                if held and r[:n_cell + n_unit] != held[0][:n_cell + n_unit]:
                    close()
                    held = []
                    if r[:n_cell] != at or len(blocks) >= OPEN:
                        yield from send()
                    if r[:n_cell] != at:
                        number = {}
                at = r[:n_cell]
                held.append(r)
        if held:
            close()
            yield from send()

    salt = F.pmod(F.xxhash64(*units), F.lit(SALTS))
    summed = flat.repartition(*keys, salt).sortWithinPartitions(*keys, *units).mapInArrow(run, schema)
    summed = summed.select(*[F.col(k).alias(c) for k, c in zip(keys, cell)], "a", "b", "enter", "leave",
                           *[f"_{c}" for c in sum_names(names)])
    return history.changes(summed, [*cell, "a", "b"], {c: F.col(f"_{c}") for c in sum_names(names)})


def sum_names(metrics) -> list[str]:
    return [f"{n}_{s}" for n in metrics for s in "abn"]


def relative_skill(pairs: DataFrame, cell: list[str], metrics, baseline: str) -> DataFrame:
    """(cell, model, ``rel_<metric>``, ``msr_<metric>``) from pair sums, one aggregate for all metrics.

    Logarithms are averaged in the order of the partners' names, so the result does not
    depend on how rows arrive.
    """
    def side(model: str, other: str, own: str, theirs: str) -> Column:
        return F.struct(F.col(model).alias("model"), F.col(other).alias("other"), *[
            c for n in metrics for c in (F.col(f"{n}_{own}").alias(f"{n}_own"),
                                         F.col(f"{n}_{theirs}").alias(f"{n}_their"), F.col(f"{n}_n").alias(f"{n}_n"))])

    one = F.array(side("a", "b", "a", "b"))
    both = F.when(F.col("a") == F.col("b"), one).otherwise(F.concat(one, F.array(side("b", "a", "b", "a"))))
    d = pairs.select(*cell, F.explode(both).alias("_d")).select(*cell, "_d.*")
    same = F.col("model") == F.col("other")
    aggregates = []
    for n in metrics:
        shared = F.col(f"{n}_n") > 0
        log = F.when(shared, F.when(same, F.lit(0.0)).otherwise(log_ratio(f"{n}_own", f"{n}_their")))
        ratio = F.when(shared, F.when(same, F.lit(1.0)).otherwise(safe_div(f"{n}_own", f"{n}_their")))
        aggregates += [F.exp(ordered_mean(log, "other")).alias(f"_theta_{n}"),
                       F.max(F.when(same, F.col(f"{n}_n"))).alias(f"_own_{n}"),
                       F.max(F.when(F.col("other") == baseline, ratio)).alias(f"msr_{n}")]
    theta = d.groupBy(*cell, "model").agg(*aggregates)
    w = Window.partitionBy(*cell)
    out = [*cell, "model"]
    for n in metrics:
        present = F.col(f"_own_{n}") > 0
        compared = present & (F.count(F.when(present, 1)).over(w) >= 2)
        base = F.max(F.when((F.col("model") == baseline) & present, F.col(f"_theta_{n}"))).over(w)
        out += [F.when(compared, settle(safe_div(f"_theta_{n}", base))).alias(f"rel_{n}"),
                F.when(compared, F.col(f"msr_{n}")).alias(f"msr_{n}")]
    return theta.select(*out)
