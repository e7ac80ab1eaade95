"""Weighted quantiles of a sorted array of members, as Catalyst expressions.

A member takes the part [lo, hi] of the weight distribution, and an estimate is the mean of
the members' values, each weighted with the mass of a distribution on its part.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numeric import safe_div

# Gauss-Legendre nodes and weights of [-1, 1].
NODES = [tuple(map(float, t)) for t in zip(*np.polynomial.legendre.leggauss(10))]
# Exponent of the substitution that makes the beta density smooth at 0 and 1, and pieces of [0, 1] that it is integrated in.
BEND, PANELS = 6, 8


def _bent(u: Column) -> Column:
    """s with u = s^k / (s^k + (1 - s)^k), k = BEND."""
    x, y = F.pow(u, F.lit(1 / BEND)), F.pow(1 - u, F.lit(1 / BEND))
    return x / (x + y)


def with_panels(df: DataFrame, members: str, total: str, name: str) -> DataFrame:
    """Adds ``name``: for each member the panels (middle, half) that cover its part, in s.

    A part has as many panels as its length in s asks for, one at least; none without weight.
    """
    sums = F.aggregate(members, F.array(F.lit(0.0)), lambda c, m: F.concat(c, F.array(F.element_at(c, -1) + m["w"])))
    ends = F.transform(sums, lambda c: F.least(safe_div(c, total), F.lit(1.0)))  # no weight at all: no length
    df = df.withColumn(f"{name}_u", ends).withColumn(f"{name}_s", F.transform(f"{name}_u", _bent))
    at = F.sequence(F.lit(0), F.size(members) - 1)
    parts = F.transform(at, lambda i: F.struct(
        F.get(f"{name}_s", i).alias("left"),
        F.ceil((F.get(f"{name}_s", i + 1) - F.get(f"{name}_s", i)) * PANELS).cast("int").alias("k"),
        (F.get(f"{name}_s", i + 1) - F.get(f"{name}_s", i)).alias("length")))
    df = df.withColumn(f"{name}_p", parts)
    none = F.array().cast("array<struct<middle:double,half:double>>")
    panels = F.transform(f"{name}_p", lambda p: F.when(p["k"] > 0, F.transform(
        F.sequence(F.lit(0), p["k"] - 1), lambda j: F.struct((p["left"] + p["length"] * (2 * j + 1) / (2 * p["k"])).alias("middle"),
                                                            (p["length"] / (2 * p["k"])).alias("half")))).otherwise(none))
    return df.withColumn(name, panels).drop(f"{name}_u", f"{name}_s", f"{name}_p")


def beta_mass(panels: Column, a: Column, b: Column) -> Column:
    """The integral of u^(a-1) (1-u)^(b-1) over panels in s, times 2^(a+b-2).

    In s the density is k s^(ka-1) (1-s)^(kb-1) / (s^k + (1-s)^k)^(a+b); the constant k is left out.
    """
    nodes = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(w).alias("w")) for x, w in NODES])

    def density(s: Column) -> Column:
        power = F.pow(s, F.lit(float(BEND))) + F.pow(1 - s, F.lit(float(BEND)))
        return F.exp((BEND * a - 1) * F.ln(s) + (BEND * b - 1) * F.ln(1 - s) - (a + b) * F.ln(power)
                     + (a + b - 2) * float(np.log(2)))

    return F.aggregate(panels, F.lit(0.0), lambda sum_, p: sum_ + p["half"] * F.aggregate(
        nodes, F.lit(0.0), lambda part, n: part + n["w"] * density(p["middle"] + p["half"] * n["x"])))


def harrell_davis(df: DataFrame, members: str, total: str, size: str, p: float) -> DataFrame:
    """Adds ``estimate``: Beta(p (size + 1), (1 - p)(size + 1)) masses, by quadrature with fixed
    nodes, normalised by their sum instead of the beta function."""
    a, b = F.lit(p) * (F.col(size) + 1), F.lit(1 - p) * (F.col(size) + 1)
    df = with_panels(df, members, total, "_panels")
    df = df.withColumn("_masses", F.transform("_panels", lambda x: beta_mass(x, a, b)))
    sums = F.aggregate(F.zip_with(members, "_masses", lambda m, mass: m["x"] * mass), F.lit(0.0), lambda s, x: s + x)
    mass = F.aggregate("_masses", F.lit(0.0), lambda s, x: s + x)
    return df.withColumn("estimate", safe_div(sums, mass)).drop("_panels", "_masses")


def type7(df: DataFrame, members: str, total: str, size: str, p: float) -> DataFrame:
    """Adds ``estimate``: masses of the uniform distribution on the part of length 1 / size that type 7 interpolates in."""
    n, whole = F.col(size), F.col(total)
    h = F.lit(p) * (n - 1) + 1

    def cdf(c: Column) -> Column:
        return F.least(F.greatest(c * n - h + 1, F.lit(0.0)), F.lit(1.0))

    def step(s: Column, m: Column) -> Column:
        upto = s["upto"] + m["w"]
        mass = cdf(upto / whole) - cdf((upto - m["w"]) / whole)
        return F.struct(upto.alias("upto"), (s["sum"] + m["x"] * mass).alias("sum"))

    zero = F.struct(F.lit(0.0).alias("upto"), F.lit(0.0).alias("sum"))
    return df.withColumn("estimate", F.when(whole > 0, F.aggregate(members, zero, step)["sum"]))
