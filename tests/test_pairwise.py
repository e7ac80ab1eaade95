import datetime as dt
import random

import numpy as np
from pyspark.sql import functions as F

from hubcast.operators import pairwise

DAY = dt.date(2021, 3, 8)
SCHEMA = "loc string, date date, unit string, model string, enter date, leave date, ae double, wis double"


def brute(rows, metrics=(6, 7)):
    out = {}
    for x in rows:
        for y in rows:
            if x[:3] != y[:3] or x[3] > y[3]:
                continue
            enter, leave = max(x[4], y[4]), min((d for d in (x[5], y[5]) if d), default=None)
            if leave and enter >= leave:
                continue
            for day, sign in ((enter, 1), (leave, -1)):
                if day:
                    sums = out.setdefault((x[0], x[3], y[3], day), [0.0] * 6)
                    for k, m in enumerate(metrics):
                        if x[m] is not None and y[m] is not None and x[m] == x[m] and y[m] == y[m]:
                            for i, v in enumerate((x[m], y[m], 1)):
                                sums[3 * k + i] += sign * v
    return out


def got(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = pairwise.pair_changes(df, ["loc"], ["date", "unit"], {"ae": F.col("ae"), "wis": F.col("wis")})
    return {(r["loc"], r.a, r.b, r.day): [r[c] for c in pairwise.sum_names(("ae", "wis"))] for r in found.collect()}


def same(a, b):
    return a.keys() == b.keys() and all(np.allclose(a[k], b[k]) for k in a)


def test_as_brute_force(spark):
    r = random.Random(5)
    rows = []
    for loc in ("A", "B", None):
        for week in range(30):
            for unit in ("u", "v"):
                for m in r.choices("abcdefg", k=r.randint(0, 9)):  # some twice, some never
                    enter = DAY + dt.timedelta(7 * (week + r.choice([0, 0, 0, 1])))
                    leave = r.choice([None, None, enter + dt.timedelta(7 * r.randint(1, 3))])
                    rows.append((loc, DAY + dt.timedelta(7 * week), unit, m, enter, leave,
                                 r.choice([None, float("nan"), 0.0, 2.5, 7.0]), r.choice([None, 1.0, 3.0])))
    # a null location is a cell, as groups have null keys
    assert same(got(spark, rows), brute(rows))
    assert got(spark, []) == {}


def test_many_members_send_a_matrix_once(spark):
    """200 members and 40 units of one report day: rows as many as pairs and tasks of the cell, not as units."""
    members, units = 200, 40
    rows = [("A", DAY + dt.timedelta(u), "u", f"m{m:03d}", DAY, None, float(m % 7 + u % 3), 1.0 + m)
            for u in range(units) for m in range(members) if (m + u) % 5]
    df = spark.createDataFrame(rows, SCHEMA)
    found = pairwise.pair_changes(df, ["loc"], ["date", "unit"], {"ae": F.col("ae"), "wis": F.col("wis")})
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "collect_list" not in plan
    pairs = members * (members + 1) // 2
    sent = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in sent.split("MapInArrow")[1]
    out = found.collect()
    assert len(out) == pairs
    one = next(r for r in out if (r.a, r.b) == ("m001", "m007"))
    shared = [u for u in range(units) if (1 + u) % 5 and (7 + u) % 5]
    assert one.ae_n == len(shared) and one.ae_a == sum(1 + u % 3 for u in shared) and one.wis_b == 8.0 * len(shared)
