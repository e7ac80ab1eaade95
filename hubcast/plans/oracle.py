"""DuckDB oracle: the registered queries re-derived in plain SQL.

The SQL is written independently of the Spark plans and, where possible, with
a different formulation:

* WIS by the pinball-loss identity wis = 2/N * sum pinball (in thousandths,
  so sums are exact), its parts from an explicit interval pivot;
* the pairwise comparison by a direct self join on the forecast unit, summed by week
  and then carried forward (all history) or joined to the weeks it covers (limited);
* continuous weeks from the latest gap at every report day;
* criteria by joins to the required levels and COUNT(DISTINCT) instead of bit masks;
* run windows by range joins instead of bounded explodes;
* the incomplete beta of the Harrell-Davis medians as a power series.

Tables region nation supplier lineitem orders events pages are the driver's views.
"""

from __future__ import annotations

from ..config import HUB_QUANTILES, HubConfig
from ..sources.hubdata import DESIGNATIONS, LINK_PREFIX, MODELS, PREVIEW_URL
from .catalog import (FEWER_HORIZONS, HD_DIGITS, LEFT_OUT, MIN_NMODELS, REL_WIS_CUTOFF, STEADY_WEEKS, SUBSET,
                      WINDOW_WEEKS)

BASE, OWN = HubConfig().baseline_model, HubConfig().ensemble_pattern
NQ = len(HUB_QUANTILES)


def _sat(d: str) -> str:
    """Saturday ending the week of date expression ``d``."""
    return f"({d} + CAST(((6 - isodow({d})) % 7 + 7) % 7 AS INTEGER))"


def _weekday_end(d: str, e: int) -> str:
    return f"({d} + CAST((({e} - isodow({d})) % 7 + 7) % 7 AS INTEGER))"


def _values(rows) -> str:
    def lit(v):
        return f"'{v}'" if isinstance(v, str) else repr(v)
    return ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


_LEVELS = ", ".join(repr(q) for q in HUB_QUANTILES)

TRUTH = f"""
geo AS (
  SELECT n.n_nationkey, 'R' || CAST(r.r_regionkey AS VARCHAR) AS location, r.r_name AS location_name
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey),
li AS (
  SELECT l_suppkey, l_returnflag, l_linestatus, {_sat('CAST(l_shipdate AS DATE)')} AS target_end_date
  FROM lineitem),
obs AS (
  SELECT g.location, g.location_name,
         CASE l.l_returnflag WHEN 'A' THEN 'inc case' WHEN 'N' THEN 'inc death'
                             WHEN 'R' THEN 'inc hosp' END AS target_variable,
         l.target_end_date, COUNT(*) AS n,
         COUNT(*) FILTER (WHERE l.l_linestatus = 'O') AS n_open
  FROM li l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN geo g ON s.s_nationkey = g.n_nationkey
  WHERE l.l_returnflag IN ('A', 'N', 'R')
  GROUP BY 1, 2, 3, 4),
span AS (
  SELECT location, location_name, target_variable,
         MIN(target_end_date) AS lo, MAX(target_end_date) AS hi
  FROM obs GROUP BY 1, 2, 3),
weeks AS (
  SELECT location, location_name, target_variable, CAST(t AS DATE) AS target_end_date
  FROM (SELECT location, location_name, target_variable,
               unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 7 DAY)) AS t
        FROM span)),
truth AS (
  SELECT w.location, w.location_name, w.target_variable, w.target_end_date,
         CAST(COALESCE(o.n, 0) AS DOUBLE) AS value
  FROM weeks w LEFT JOIN obs o
    ON o.location = w.location AND o.target_variable = w.target_variable
   AND o.target_end_date = w.target_end_date)"""

FORECASTS = f"""
models(model, a, b) AS (VALUES {_values(MODELS)}),
levels AS (
  SELECT CAST(q AS DOUBLE) AS quantile, i AS qidx
  FROM (SELECT unnest([{_LEVELS}]) AS q, unnest(range(1, {NQ + 1})) AS i)),
horizons AS (SELECT CAST(unnest([1, 2, 3, 4]) AS INTEGER) AS horizon),
fc AS (
  SELECT m.model, t.target_end_date + 2 AS forecast_date, t.target_variable, h.horizon,
         'wk' AS temporal_resolution, t.target_end_date + 7 * h.horizon AS target_end_date,
         t.location, t.location_name,
         CASE WHEN m.model = 'T-m5' AND t.location = 'R3' AND q.quantile = 0.5
              THEN 'point' ELSE 'quantile' END AS type,
         CASE WHEN m.model = 'T-m5' AND t.location = 'R3' AND q.quantile = 0.5
              THEN CAST(NULL AS DOUBLE) ELSE q.quantile END AS quantile,
         CAST(floor(t.value * (CAST(m.a AS DOUBLE) / 8)) + (q.qidx - 12) * (1 + h.horizon) * m.b
              AS DOUBLE) AS value
  FROM truth t CROSS JOIN models m CROSS JOIN horizons h CROSS JOIN levels q
  WHERE NOT ((m.model = 'T-m3' AND ((t.target_end_date - DATE '1970-01-03') // 7) % 5 = 0)
          OR (m.model = 'T-m4' AND t.location = 'R2' AND q.quantile = 0.01)
          OR (m.model = 'T-m6' AND t.location = 'R4' AND h.horizon > 2)
          OR (m.model = 'T-m2' AND t.target_variable = 'inc hosp'
              AND t.location NOT IN ('R0', 'R1')))),
designations(model, designation) AS (VALUES {_values(DESIGNATIONS)}),
exclusions AS (
  SELECT DISTINCT 'T-m1' AS model, target_end_date + 2 AS forecast_date
  FROM truth WHERE ((target_end_date - DATE '1970-01-03') // 7) % 7 = 3),
run_dates AS (SELECT DISTINCT forecast_date AS run_date FROM fc),
win AS (
  SELECT f.*, r.run_date FROM fc f JOIN run_dates r
    ON f.forecast_date BETWEEN r.run_date - 5 AND r.run_date)"""

SCORES = f"""
fct AS (
  SELECT f.model, f.forecast_date, f.target_variable, f.horizon, f.target_end_date, f.location,
         f.location_name, f.type, f.quantile, f.value AS prediction, t.value AS true_value
  FROM fc f LEFT JOIN truth t
    ON t.target_variable = f.target_variable AND t.location = f.location
   AND t.target_end_date = f.target_end_date),
g2 AS (
  SELECT model, forecast_date, target_variable, horizon, target_end_date, location, location_name,
         true_value, CASE WHEN type = 'point' THEN 0.5 ELSE quantile END AS quantile,
         COALESCE(MAX(prediction) FILTER (WHERE type = 'quantile'),
                  MAX(prediction) FILTER (WHERE type = 'point')) AS prediction
  FROM fct WHERE true_value IS NOT NULL AND type IN ('quantile', 'point')
  GROUP BY ALL),
pin AS (SELECT *, round_even(abs(1 - 2 * quantile) * 100, 0) AS rng FROM g2),
unit_pb AS (
  SELECT model, target_variable, forecast_date, target_end_date, horizon, location,
         MAX(true_value) AS y,
         SUM((CASE WHEN true_value < prediction THEN 1000 ELSE 0 END - round(quantile * 1000))
             * (prediction - true_value)) AS pb1000,
         COUNT(*) AS nrows,
         COUNT(DISTINCT quantile) AS n_quantiles,
         MAX(prediction) FILTER (WHERE rng = 0) AS m,
         MAX(quantile) FILTER (WHERE prediction <= true_value) AS q_below,
         MIN(quantile) FILTER (WHERE prediction >= true_value) AS q_above
  FROM pin GROUP BY ALL),
ivl AS (
  SELECT model, target_variable, forecast_date, target_end_date, horizon, location, rng,
         MAX(true_value) AS y,
         MAX(prediction) FILTER (WHERE quantile <= 0.5) AS l,
         MAX(prediction) FILTER (WHERE quantile >= 0.5) AS u,
         COUNT(*) AS k
  FROM pin GROUP BY ALL),
unit_iv AS (
  SELECT model, target_variable, forecast_date, target_end_date, horizon, location,
         COUNT(*) FILTER (WHERE l IS NULL OR u IS NULL) AS n_open,
         SUM(k * (100 - rng) * (u - l)) / 2 AS disp100,
         SUM(k * 100 * greatest(l - y, 0)) AS over100,
         SUM(k * 100 * greatest(y - u, 0)) AS under100,
         SUM(k) AS nk,
         MAX(CASE WHEN l IS NULL OR u IS NULL THEN NULL WHEN l <= y AND y <= u THEN 1.0
                  ELSE 0.0 END) FILTER (WHERE rng = 50) AS cov_50,
         MAX(CASE WHEN l IS NULL OR u IS NULL THEN NULL WHEN l <= y AND y <= u THEN 1.0
                  ELSE 0.0 END) FILTER (WHERE rng = 95) AS cov_95
  FROM ivl GROUP BY ALL),
locs AS (SELECT DISTINCT location, location_name FROM fc),
sc_raw AS (
  SELECT p.model, p.target_variable, p.forecast_date, p.target_end_date, p.horizon, p.location,
         CASE WHEN i.n_open = 0 THEN p.pb1000 / (500.0 * p.nrows) END AS wis,
         CASE WHEN i.n_open = 0 THEN i.disp100 / (100.0 * i.nk) END AS sharpness,
         CASE WHEN i.n_open = 0 THEN i.under100 / (100.0 * i.nk) END AS underprediction,
         CASE WHEN i.n_open = 0 THEN i.over100 / (100.0 * i.nk) END AS overprediction,
         abs(p.m - p.y) AS ae_median,
         CASE WHEN p.y = p.m THEN 0.0
              WHEN p.y < p.m THEN 1 - 2 * COALESCE(p.q_below, 0.0)
              ELSE 1 - 2 * COALESCE(p.q_above, 1.0) END AS bias,
         i.cov_50, i.cov_95, CAST(p.n_quantiles AS BIGINT) AS n_quantiles
  FROM unit_pb p JOIN unit_iv i USING (model, target_variable, forecast_date, target_end_date,
                                       horizon, location)),
sc AS (
  SELECT s.model, s.target_variable, s.forecast_date, s.target_end_date, s.horizon, s.location,
         l.location_name,
         round_even(s.wis, 0) + 0.0 AS wis, round_even(s.sharpness, 0) + 0.0 AS sharpness,
         round_even(s.underprediction, 0) + 0.0 AS underprediction,
         round_even(s.overprediction, 0) + 0.0 AS overprediction,
         s.ae_median, round_even(s.bias, 1) + 0.0 AS bias, s.cov_50, s.cov_95, s.n_quantiles
  FROM sc_raw s LEFT JOIN locs l USING (location))"""

_CELL = "report_date, target_variable, horizon, location"


def _rd(x: str, d: int) -> str:
    """Half-even on the scaled value; a tie has a fractional part of exactly one half."""
    y = f"(CAST({x} AS DOUBLE) * {10 ** d})"
    return (f"(CASE WHEN NOT (abs({y}) < 1e15) OR {y} IS NULL THEN CAST({x} AS DOUBLE) ELSE "
            f"(CASE WHEN {y} - floor({y}) = 0.5 THEN "
            f"(CASE WHEN CAST(floor({y}) AS BIGINT) % 2 = 0 THEN floor({y}) ELSE floor({y}) + 1 END) "
            f"WHEN {y} - floor({y}) < 0.5 THEN floor({y}) ELSE floor({y}) + 1 END) "
            f"/ CAST({10 ** d} AS DOUBLE) + 0.0 END)")


def _r2(x: str) -> str:
    return _rd(x, 2)


def _carried(name: str, src: str, keys: str, sums: dict[str, str], weeks: int | None) -> str:
    """CTE ``name``: sums of ``src`` rows (with ``seen`` and ``ted``) at every report day."""
    inner = ", ".join(f"SUM({e}) AS {n}" for n, e in sums.items())
    if weeks:
        return f"""
{name} AS (
  SELECT r.run_date AS report_date, {keys}, {inner}
  FROM {src} s JOIN run_dates r ON s.seen <= r.run_date AND s.ted > r.run_date - {7 * weeks}
  GROUP BY ALL)"""
    upto = ", ".join(f"SUM({n}) OVER w AS {n}" for n in sums)
    return f"""
{name}_w AS (SELECT seen, {keys}, {inner} FROM {src} GROUP BY ALL),
{name}_c AS (
  SELECT seen, {keys}, {upto}, lead(seen) OVER w AS nxt FROM {name}_w
  WINDOW w AS (PARTITION BY {keys} ORDER BY seen)),
{name} AS (
  SELECT r.run_date AS report_date, {keys}, {", ".join(sums)}
  FROM {name}_c c JOIN run_dates r ON r.run_date >= c.seen AND (c.nxt IS NULL OR r.run_date < c.nxt))"""


def _relative(name: str, metric: str) -> str:
    """Ratio of sums, geometric mean in the order of the partners, scaled by the baseline."""
    return f"""
{name}_theta AS (
  SELECT {_CELL}, model,
         exp(SUM(CASE WHEN model = other THEN 0.0
                      WHEN {metric}_a = 0 AND {metric}_b = 0 THEN NULL
                      WHEN {metric}_a = 0 THEN CAST('-inf' AS DOUBLE)
                      WHEN {metric}_b = 0 THEN CAST('inf' AS DOUBLE)
                      ELSE ln({metric}_a / {metric}_b) END ORDER BY other)
             / COUNT(CASE WHEN model = other OR {metric}_a <> 0 OR {metric}_b <> 0 THEN 1 END)) AS theta,
         MAX(CASE WHEN other = '{BASE}' THEN CASE WHEN model = other THEN 1.0
                                                   ELSE {metric}_a / NULLIF({metric}_b, 0) END END) AS msr
  FROM pairs WHERE {metric}_n > 0 GROUP BY {_CELL}, model),
{name}_cells AS (
  SELECT {_CELL}, COUNT(*) AS models, MAX(theta) FILTER (WHERE model = '{BASE}') AS base
  FROM {name}_theta GROUP BY ALL),
{name}_rel AS (
  SELECT t.report_date, t.target_variable, t.horizon, t.location, t.model,
         CASE WHEN t.theta / NULLIF(c.base, 0) < 1e3 THEN floor(t.theta / NULLIF(c.base, 0) * 1e12 + 0.5) / 1e12
              ELSE t.theta / NULLIF(c.base, 0) END AS rel, t.msr
  FROM {name}_theta t JOIN {name}_cells c USING ({_CELL})
  WHERE c.models >= 2)"""


def _summary(weeks: int | None = None, steady: int = 0) -> str:
    """Scores summarised for every report day: all history, or the last ``weeks`` weeks."""
    cell = "model, target_variable, horizon, location"
    base = {"n": "1", "wis_s": "coalesce(wis, 0)", "wis_n": "CASE WHEN wis IS NULL THEN 0 ELSE 1 END",
            "c50": "coalesce(cov_50, 0)", "n50": "CASE WHEN cov_50 IS NULL THEN 0 ELSE 1 END",
            "c95": "coalesce(cov_95, 0)", "n95": "CASE WHEN cov_95 IS NULL THEN 0 ELSE 1 END",
            "nf": f"CASE WHEN n_quantiles = {NQ} THEN 1 ELSE 0 END",
            "nb": f"CASE WHEN n_quantiles = {NQ} AND bias IS NOT NULL THEN 1 ELSE 0 END",
            "b10": f"CASE WHEN n_quantiles = {NQ} THEN coalesce(round(bias * 10), 0) ELSE 0 END"}
    both = "(a.{m} IS NOT NULL AND b.{m} IS NOT NULL)"
    pair = {f"{n}_{x}": f"CASE WHEN {both.format(m=m)} THEN {v} ELSE 0 END"
            for n, m in (("ae", "ae_median"), ("wi", "wis23")) for x, v in (("a", f"a.{m}"), ("b", f"b.{m}"), ("n", "1"))}
    pair_sums = ", ".join(f"SUM({e}) AS {n}" for n, e in pair.items())
    window = f"AND s.ted > r.run_date - {7 * weeks}" if weeks else ""
    enough = "" if not steady else f"""
steady AS (SELECT * FROM cw WHERE continuous_weeks >= {steady}),
sdf AS (SELECT b.* FROM sdf0 b SEMI JOIN steady USING (report_date, {cell})),
pairs AS (
  SELECT p.* FROM pairs0 p
  SEMI JOIN steady a ON a.report_date = p.report_date AND a.target_variable = p.target_variable
    AND a.horizon = p.horizon AND a.location = p.location AND a.model = p.model
  SEMI JOIN steady b ON b.report_date = p.report_date AND b.target_variable = p.target_variable
    AND b.horizon = p.horizon AND b.location = p.location AND b.model = p.other),"""
    plain = "" if steady else "\nsdf AS (SELECT * FROM sdf0), pairs AS (SELECT * FROM pairs0),"
    total = ", ".join(f"SUM({n}) AS {n}" for n in base)
    psum = ", ".join(f"SUM({n}) AS {n}" for n in pair)
    return f"""
vis AS (
  SELECT *, greatest(forecast_date + 7, target_end_date) AS seen, target_end_date AS ted,
         CASE WHEN n_quantiles = {NQ} THEN wis END AS wis23
  FROM sc),
{_carried("rep", "vis", cell, base, weeks).strip()},
allrep AS (
  SELECT * FROM rep
  UNION ALL
  SELECT report_date, model, target_variable, horizon, 'Overall', {total} FROM rep
  GROUP BY report_date, model, target_variable, horizon),
places AS (SELECT DISTINCT {cell}, location_name, seen, ted FROM vis),
seen_places AS (
  SELECT DISTINCT r.run_date AS report_date, {cell}, location_name
  FROM (SELECT {cell}, location_name, seen, ted FROM places) s
  JOIN run_dates r ON s.seen <= r.run_date {window}),
nloc AS (
  SELECT report_date, {cell}, COUNT(DISTINCT location_name) AS n_loc FROM seen_places GROUP BY ALL
  UNION ALL
  SELECT report_date, model, target_variable, horizon, 'Overall', COUNT(DISTINCT location_name)
  FROM seen_places GROUP BY report_date, model, target_variable, horizon),
nall AS (
  SELECT report_date, target_variable, COUNT(DISTINCT location_name) AS nall FROM seen_places GROUP BY ALL),
keeps AS (
  SELECT n.report_date, n.model, n.target_variable, n.horizon
  FROM nloc n JOIN nall a USING (report_date, target_variable)
  WHERE n.location = 'Overall' AND n.n_loc >= a.nall / 2.0),
sdf0 AS (
  SELECT b.* FROM allrep b LEFT JOIN keeps k USING (report_date, model, target_variable, horizon)
  WHERE b.location <> 'Overall' OR k.model IS NOT NULL),
units AS (
  SELECT a.target_variable, a.horizon, a.location, a.model, b.model AS other,
         greatest(a.seen, b.seen) AS seen, least(a.ted, b.ted) AS ted, {pair_sums}
  FROM vis a JOIN vis b
    ON a.target_variable = b.target_variable AND a.horizon = b.horizon AND a.location = b.location
   AND a.location_name IS NOT DISTINCT FROM b.location_name AND a.forecast_date = b.forecast_date
  GROUP BY ALL),
{_carried("pr", "units", "target_variable, horizon, location, model, other", {n: n for n in pair}, weeks).strip()},
allpairs AS (
  SELECT * FROM pr
  UNION ALL
  SELECT report_date, target_variable, horizon, 'Overall', model, other, {psum} FROM pr
  GROUP BY report_date, target_variable, horizon, model, other),
pairs0 AS (
  SELECT p.* FROM allpairs p
  LEFT JOIN keeps a ON a.report_date = p.report_date AND a.target_variable = p.target_variable
    AND a.horizon = p.horizon AND a.model = p.model
  LEFT JOIN keeps b ON b.report_date = p.report_date AND b.target_variable = p.target_variable
    AND b.horizon = p.horizon AND b.model = p.other
  WHERE p.location <> 'Overall' OR (a.model IS NOT NULL AND b.model IS NOT NULL)),
mdates AS (SELECT DISTINCT {cell}, forecast_date, seen, ted FROM vis),
md AS (
  SELECT r.run_date AS report_date, s.model, s.target_variable, s.horizon, s.location, s.forecast_date
  FROM mdates s JOIN run_dates r ON s.seen <= r.run_date {window}),
md_all AS (
  SELECT DISTINCT m.report_date, m.model, m.target_variable, m.horizon, 'Overall' AS location, m.forecast_date
  FROM md m JOIN keeps k USING (report_date, model, target_variable, horizon)),
present AS (SELECT * FROM md UNION ALL SELECT * FROM md_all),
cdates AS (SELECT DISTINCT report_date, target_variable, horizon, location, forecast_date FROM present),
mcells AS (SELECT DISTINCT report_date, {cell} FROM present),
gaps AS (
  SELECT m.report_date, m.model, m.target_variable, m.horizon, m.location, MAX(c.forecast_date) AS last_gap
  FROM mcells m JOIN cdates c USING (report_date, target_variable, horizon, location)
  ANTI JOIN present x ON x.report_date = c.report_date AND x.model = m.model
    AND x.target_variable = c.target_variable AND x.horizon = c.horizon AND x.location = c.location
    AND x.forecast_date = c.forecast_date
  GROUP BY ALL),
cw AS (
  SELECT m.report_date, m.model, m.target_variable, m.horizon, m.location,
         CAST(COUNT(*) FILTER (WHERE g.last_gap IS NULL OR p.forecast_date > g.last_gap) AS INTEGER)
           AS continuous_weeks
  FROM mcells m JOIN present p USING (report_date, {cell})
  LEFT JOIN gaps g USING (report_date, {cell})
  GROUP BY ALL),{enough}{plain}
{_relative("ae", "ae").strip()},
{_relative("wi", "wi").strip()},
summ AS (
  SELECT b.report_date, b.model, b.target_variable, b.horizon, b.location,
         {_r2('ae.rel')} AS rel_ae, {_r2('wi.rel')} AS rel_wis, {_r2('wi.msr')} AS msr_baseline,
         {_r2('CAST(b.c50 AS DOUBLE) / NULLIF(b.n50, 0)')} AS cov_50,
         {_r2('CAST(b.c95 AS DOUBLE) / NULLIF(b.n95, 0)')} AS cov_95,
         {_r2('CASE WHEN b.nf > 0 AND b.nb = b.nf THEN CAST(b.b10 AS DOUBLE) / (10.0::DOUBLE * b.nf) END')} AS bias,
         CAST(b.n AS BIGINT) AS n, n.n_loc, l.location_name
  FROM sdf b
  LEFT JOIN ae_rel ae USING (report_date, model, target_variable, horizon, location)
  LEFT JOIN wi_rel wi USING (report_date, model, target_variable, horizon, location)
  LEFT JOIN nloc n USING (report_date, model, target_variable, horizon, location)
  LEFT JOIN (SELECT DISTINCT location, location_name FROM sc) l USING (location)),
evaluation AS (
  SELECT s.*, COALESCE(c.continuous_weeks, 0) AS continuous_weeks, '{weeks or "All"}' AS weeks_included
  FROM summ s LEFT JOIN cw c USING (report_date, model, location, target_variable, horizon))"""


_GRID_KEYS = "run_date, model, target_variable, location"


def _criteria(cutoff: bool, manual: str | None = None, horizons=(1, 2, 3, 4)) -> str:
    if cutoff:
        rel = f"""
ev_dates AS (
  SELECT run_date, MAX(forecast_date) AS report_date FROM fq WHERE horizon IN (1, 2, 3, 4)
  GROUP BY run_date),
has_eval AS (
  SELECT DISTINCT d.run_date FROM ev_dates d JOIN evaluation e ON e.report_date = d.report_date),
ev_flag AS (
  SELECT d.run_date, e.model, e.target_variable, e.location,
         bool_and(e.rel_wis < {REL_WIS_CUTOFF}) AS below
  FROM evaluation e JOIN ev_dates d ON e.report_date = d.report_date
  WHERE e.rel_wis IS NOT NULL GROUP BY ALL),
grid AS (
  SELECT g.*, CASE WHEN h.run_date IS NULL THEN TRUE ELSE COALESCE(f.below, FALSE) END AS rel_wis
  FROM grid1 g LEFT JOIN has_eval h USING (run_date)
  LEFT JOIN ev_flag f USING (run_date, model, target_variable, location))"""
    else:
        rel = "\ngrid AS (SELECT g.*, TRUE AS rel_wis FROM grid1 g)"
    by_date = """NOT EXISTS (SELECT 1 FROM exclusions e
                     WHERE e.model = q.model AND e.forecast_date = q.run_date)"""
    wanted = ", ".join(map(str, horizons))
    return f"""
fq AS (SELECT * FROM win WHERE type = 'quantile'),
q_date AS (
  SELECT f.run_date, f.model, f.target_variable, f.location, f.target_end_date,
         COUNT(DISTINCT l.quantile) = {NQ} AS ok
  FROM fq f LEFT JOIN levels l ON f.quantile = l.quantile GROUP BY ALL),
crit_q AS (
  SELECT {_GRID_KEYS}, bool_and(ok) AS all_quantiles_all_horizons FROM q_date GROUP BY ALL),
crit_h AS (
  SELECT f.run_date, f.model, f.target_variable, f.location,
         COUNT(DISTINCT f.horizon) FILTER (WHERE f.horizon IN ({wanted})) = {len(horizons)} AS all_horizons
  FROM fq f GROUP BY ALL),
grid1 AS (
  SELECT q.*, h.all_horizons,
         {manual or by_date} AS not_excluded_manually
  FROM crit_q q JOIN crit_h h USING ({_GRID_KEYS})
  WHERE NOT regexp_matches(q.model, '{OWN}')
    AND q.model IN (SELECT model FROM designations WHERE designation <> 'other')),{rel},
crit AS (
  SELECT {_GRID_KEYS}, all_quantiles_all_horizons, all_horizons, not_excluded_manually, rel_wis,
         COALESCE(all_quantiles_all_horizons AND all_horizons AND not_excluded_manually
                  AND rel_wis, FALSE) AS included_in_ensemble
  FROM grid),
inc AS (
  SELECT f.*, TRUE AS included_in_ensemble FROM fq f
  JOIN crit c USING ({_GRID_KEYS})
  WHERE c.included_in_ensemble AND f.horizon IN ({wanted})),
norm AS (
  SELECT run_date, model, forecast_date, target_variable, horizon, temporal_resolution,
         target_end_date, location, type, round_even(quantile, 3) AS quantile, value
  FROM inc)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(p.strip().rstrip(",") + "\n" for p in parts).rstrip().rstrip(",")


def _q(parts, select: str) -> str:
    return _with(*parts) + "\n" + select.strip()


ENS_KEYS = "target_variable, horizon, temporal_resolution, target_end_date, location, type, quantile"


def _ens_avg(fn: str) -> str:
    return f"""
SELECT run_date, {ENS_KEYS}, COUNT(*) AS forecasts, {fn} AS value
FROM norm GROUP BY ALL"""


def _skill(by_horizon: bool, sfx: str = "") -> str:
    """Relative-skill weights and weighted forecasts; CTE names get ``sfx``."""
    grp = "run_date, target_variable, location" + (", horizon" if by_horizon else "")
    if by_horizon:
        sk = f"""
sk{sfx} AS (
  SELECT run_date, model, location, target_variable, horizon, relative_skill FROM sk0{sfx})"""
    else:
        sk = f"""
sk{sfx} AS (
  SELECT run_date, model, location, target_variable,
         SUM(relative_skill ORDER BY horizon) / COUNT(*) AS relative_skill
  FROM sk0{sfx} GROUP BY run_date, model, location, target_variable)"""
    return f"""
ev_dates{sfx} AS (SELECT run_date, MAX(forecast_date) AS report_date FROM norm GROUP BY run_date),
sk0{sfx} AS (
  SELECT d.run_date, e.model, e.target_variable, e.location, e.horizon,
         CAST(e.rel_wis AS DOUBLE) AS relative_skill
  FROM evaluation e JOIN ev_dates{sfx} d ON e.report_date = d.report_date
  WHERE e.weeks_included = 'All' AND e.continuous_weeks >= 4 AND e.rel_wis IS NOT NULL
    AND EXISTS (SELECT 1 FROM norm n WHERE n.run_date = d.run_date AND n.model = e.model)),{sk},
inv{sfx} AS (
  SELECT *, CASE WHEN relative_skill > 0 THEN 1 / relative_skill ELSE 0.0 END AS inv_skill
  FROM sk{sfx}),
inv_sum{sfx} AS (SELECT {grp}, SUM(inv_skill ORDER BY model) AS total FROM inv{sfx} GROUP BY {grp}),
weights{sfx} AS (
  SELECT i.*, i.inv_skill / NULLIF(t.total, 0) AS weight FROM inv{sfx} i JOIN inv_sum{sfx} t USING ({grp})),
wf{sfx} AS (
  SELECT n.run_date, n.quantile, n.target_variable, n.location, n.horizon, n.value, w.weight
  FROM norm n JOIN weights{sfx} w
    ON w.run_date = n.run_date AND w.model = n.model AND w.target_variable = n.target_variable
   AND w.location = n.location {"AND w.horizon = n.horizon" if by_horizon else ""}
  WHERE w.weight IS NOT NULL AND NOT isnan(w.weight))"""


_WCELL = "run_date, quantile, target_variable, location, horizon"


def _spread(sfx: str = "") -> str:
    """Members of every cell in order of value with the limits of their weight."""
    return f"""
wl{sfx} AS (
  SELECT {_WCELL}, list({{'v': value, 'w': weight}} ORDER BY value, weight) AS ms,
         SUM(weight ORDER BY value, weight) AS w_all, SUM(weight * weight ORDER BY value, weight) AS w2
  FROM wf{sfx} GROUP BY {_WCELL}),
wm{sfx} AS (
  SELECT {_WCELL}, w_all, w2, len(ms) AS n_models, unnest(range(1, len(ms) + 1)) AS i, ms FROM wl{sfx}),
wc{sfx} AS (
  SELECT {_WCELL}, w_all * w_all / w2 AS ns, n_models, i, ms[i].v AS value, ms[i].w AS weight,
         list_sum(list_transform(ms[:i], lambda m: m.w)) / w_all AS hi,
         (list_sum(list_transform(ms[:i], lambda m: m.w)) - ms[i].w) / w_all AS lo
  FROM wm{sfx} WHERE w_all > 0)"""


def _type7(sfx: str = "") -> str:
    cdf = "least(greatest({c} * ns - (0.5 * (ns - 1) + 1) + 1, 0.0), 1.0)"
    return _spread(sfx) + f""",
t7{sfx} AS (
  SELECT {_WCELL}, SUM(value * ({cdf.format(c='hi')} - {cdf.format(c='lo')}) ORDER BY i) AS value,
         COUNT(*) AS n_models
  FROM wc{sfx} GROUP BY {_WCELL})"""


def _harrell_davis(sfx: str = "") -> str:
    """I_x(a, a) with a = (ns + 1) / 2 by its power series at the smaller of x and 1 - x."""
    return _spread(sfx) + f""",
hx AS (
  SELECT DISTINCT ns, x, least(x, 1 - x) AS z, (ns + 1) / 2 AS a
  FROM (SELECT ns, hi AS x FROM wc{sfx} UNION SELECT ns, lo FROM wc{sfx}) q),
hseries AS (
  SELECT ns, x,
         CASE WHEN z <= 0 THEN 0.0
              ELSE exp(a * ln(z) + a * ln(1 - z) + lgamma(2 * a) - 2 * lgamma(a)) / a
                   * (1 + list_sum(list_transform(range(1, 120), lambda n: exp(lgamma(2 * a + n) - lgamma(2 * a)
                                   + lgamma(a + 1) - lgamma(a + 1 + n) + n * ln(z))))) END AS low
  FROM hx),
hbeta AS (SELECT ns, x, CASE WHEN x <= 0.5 THEN low ELSE 1 - low END AS mass FROM hseries),
hd AS (
  SELECT {", ".join("c." + k for k in _WCELL.split(", "))},
         SUM(c.value * (u.mass - l.mass) ORDER BY c.i) AS value, COUNT(*) AS n_models
  FROM wc{sfx} c JOIN hbeta u ON u.ns = c.ns AND u.x = c.hi JOIN hbeta l ON l.ns = c.ns AND l.x = c.lo
  GROUP BY {", ".join("c." + k for k in _WCELL.split(", "))})"""


_MEAN = ("SUM(value * weight ORDER BY value, weight) / NULLIF(SUM(weight ORDER BY value, weight), 0)")


def _fmt(src: str, ted: str = "target_end_date", res: str = "temporal_resolution") -> str:
    return f"""
fmt AS (
  SELECT run_date AS forecast_date,
         CAST(horizon AS VARCHAR) || ' ' || {res} || ' ahead ' || target_variable AS target,
         {ted} AS target_end_date, location, type, quantile,
         {_rd('value', 0)} AS value
  FROM {src}),
sub AS (
  SELECT * FROM fmt
  UNION ALL
  SELECT * REPLACE ('point' AS type, CAST(NULL AS DOUBLE) AS quantile) FROM fmt
  WHERE quantile = 0.5)"""


def _d11(fd: str, h: str) -> str:
    return f"({fd} - CAST(dayofweek({fd}) AS INTEGER) - 1 + 7 * {h})"


def oracle_sql() -> dict[str, str]:
    T, FC, S, SU = TRUTH, FORECASTS, SCORES, _summary()
    C0, C1 = _criteria(False), _criteria(True)
    q: dict[str, str] = {}
    q["week_end_target"] = f"""
SELECT DISTINCT CAST(l_shipdate AS DATE) AS date, {_sat('CAST(l_shipdate AS DATE)')} AS week_end
FROM lineitem"""
    q["week_end_forecast"] = f"""
SELECT DISTINCT CAST(l_shipdate AS DATE) AS date,
       {_weekday_end('CAST(l_shipdate AS DATE)', 1)} AS week_end
FROM lineitem"""
    q["default_target_end"] = f"""
WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS forecast_date FROM orders)
SELECT forecast_date, h.horizon, {_d11('forecast_date', 'h.horizon')} AS target_end_date
FROM d CROSS JOIN (SELECT CAST(unnest([1, 2, 3, 4]) AS INTEGER) AS horizon) h"""
    events = """
  SELECT event_type AS location, 'inc case' AS target_variable, CAST(ts AS DATE) AS date,
         CAST(COUNT(*) AS DOUBLE) AS value
  FROM events GROUP BY 1, 2, 3"""
    weekly = f"""
dw AS (SELECT *, {_sat('date')} AS sat_date FROM daily),
dn AS (SELECT *, COUNT(*) OVER (PARTITION BY location, target_variable, sat_date) AS n FROM dw),
dfq AS (
  SELECT *, CASE WHEN MAX(n) OVER (PARTITION BY location, target_variable) = 1
                 THEN 'weekly' ELSE 'daily' END AS frequency
  FROM dn),
drn AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY location
                               ORDER BY date DESC, location DESC, target_variable DESC) AS rn
  FROM dfq),
dtail AS (
  SELECT *, MAX(CASE WHEN rn <= 7 THEN n END) OVER (PARTITION BY location) AS tailmax FROM drn),
dmove AS (
  SELECT location, target_variable, value, sat_date,
         CASE WHEN frequency = 'weekly' AND date + 6 = sat_date THEN date + 6 ELSE date END AS date
  FROM dtail WHERE n = tailmax OR frequency = 'weekly'),
dlast AS (
  SELECT *, MAX(date) OVER (PARTITION BY location, target_variable, sat_date) AS last_date
  FROM dmove)"""
    last = f"SELECT location, target_variable, {_sat('date')} AS date, value FROM dlast WHERE date = last_date"
    q["weekly_truth"] = _q([f"daily AS ({events})", weekly], last)
    q["weekly_truth_mixed"] = _q([T, f"""
daily AS ({events}
  UNION ALL SELECT location, target_variable, target_end_date - 6, value FROM truth)""", weekly], last)
    q["truth_status"] = _q([T, """
status AS (
  SELECT target_variable, location, target_end_date,
         CASE WHEN n_open > n - n_open THEN 'near-final' END AS status
  FROM obs WHERE n_open >= n - n_open)"""], """
SELECT t.location, t.location_name, t.target_variable, t.target_end_date, t.value,
       COALESCE(s.status, 'final') AS status
FROM truth t LEFT JOIN status s USING (target_variable, location, target_end_date)""")
    q["csv_submissions"] = _q([T, FC], """
SELECT model, forecast_date, target_variable, horizon, temporal_resolution, target_end_date, location, COUNT(*) AS n_rows,
       string_agg(concat_ws(':', type, CAST(CAST(quantile AS DECIMAL(4, 3)) AS VARCHAR), CAST(CAST(value AS BIGINT) AS VARCHAR)), ','
                  ORDER BY type, quantile) AS "values"
FROM fc GROUP BY ALL""")
    q["csv_status"] = _q([T], """
SELECT target_variable, location, target_end_date,
       CASE WHEN n_open > n - n_open THEN '"open",' || chr(10) || 'near-final' END AS status
FROM obs WHERE n_open >= n - n_open""")
    q["ensemble_mean"] = _q([T, FC, C0], _ens_avg("SUM(value) / COUNT(value)"))
    q["ensemble_median"] = _q([T, FC, C0], _ens_avg("median(value)"))
    q["point_rows"] = _q([T, FC, C0, "ens AS (" + _ens_avg("SUM(value) / COUNT(value)") + ")"], """
SELECT * FROM ens
UNION ALL
SELECT * REPLACE ('point' AS type, CAST(NULL AS DOUBLE) AS quantile) FROM ens WHERE quantile = 0.5""")
    q["submission_format"] = _q([T, FC, C0, "ens AS (" + _ens_avg("median(value)") + ")",
                                 _fmt("ens")], "SELECT * FROM sub")
    q["mean_submission"] = _q([T, FC, C0, "ens AS (" + _ens_avg("SUM(value) / COUNT(value)") + ")",
                               _fmt("ens")], "SELECT * FROM sub")
    q["single_run"] = _q([T, FC, C0, "ens AS (" + _ens_avg("median(value)") + ")", _fmt("ens")], """
SELECT * FROM sub WHERE forecast_date = (SELECT MAX(run_date) FROM run_dates)""")
    q["stored_reruns"] = _q([T, FC, C0, f"""
ens AS (
  SELECT 'mean' AS method, * FROM ({_ens_avg("SUM(value) / COUNT(value)")}) a
  UNION ALL SELECT 'median' AS method, * FROM ({_ens_avg("median(value)")}) b),
chosen AS (SELECT * FROM ens WHERE run_date IN (SELECT forecast_date FROM exclusions)),
fmt AS (
  SELECT method, run_date AS forecast_date,
         CAST(horizon AS VARCHAR) || ' ' || temporal_resolution || ' ahead ' || target_variable AS target,
         target_end_date, location, type, quantile, {_rd('value', 0)} AS value
  FROM chosen)"""], """
SELECT * FROM fmt
UNION ALL
SELECT * REPLACE ('point' AS type, CAST(NULL AS DOUBLE) AS quantile) FROM fmt WHERE quantile = 0.5""")
    q["min_models"] = _q([T, FC, C0, f"""
ok AS (
  SELECT run_date, location, horizon, temporal_resolution, target_variable, target_end_date
  FROM norm GROUP BY ALL HAVING COUNT(DISTINCT model) >= {MIN_NMODELS})"""], """
SELECT n.run_date, n.location, n.horizon, n.temporal_resolution, n.target_variable,
       n.target_end_date, COUNT(DISTINCT n.model) AS n_models, COUNT(*) AS n_rows
FROM norm n JOIN ok USING (run_date, location, horizon, temporal_resolution, target_variable,
                           target_end_date)
GROUP BY ALL""")
    q["equal_weights"] = _q([T, FC, C0, """
m AS (SELECT DISTINCT run_date, target_variable, location, model FROM norm)"""], """
SELECT run_date, target_variable, location, model,
       1.0 / COUNT(*) OVER (PARTITION BY run_date, target_variable, location) AS weight
FROM m""")
    q["criteria_quantiles"] = _q([T, FC, C0], f"SELECT {_GRID_KEYS}, all_quantiles_all_horizons FROM crit_q")
    q["criteria_horizons"] = _q([T, FC, C0], f"SELECT {_GRID_KEYS}, all_horizons FROM crit_h")
    q["criteria_grid"] = _q([T, FC, S, SU, C1], "SELECT * FROM crit")
    q["criteria_rel_wis"] = _q([T, FC, S, SU, C1], f"SELECT {_GRID_KEYS}, rel_wis FROM crit")
    q["manual_exclusions_by_date"] = _q([T, FC, C0],
                                        f"SELECT {_GRID_KEYS}, not_excluded_manually FROM crit")
    q["included_forecasts"] = _q([T, FC, S, SU, C1], """
SELECT run_date, model, forecast_date, target_variable, horizon, target_end_date, location, quantile,
       value, included_in_ensemble FROM inc""")
    named = ", ".join(f"'{m}'" for m in LEFT_OUT)
    q["criteria_left_out_by_name"] = _q([T, FC, _criteria(False, manual=f"q.model NOT IN ({named})")],
                                        "SELECT * FROM crit")
    q["included_fewer_horizons"] = _q([T, FC, _criteria(False, horizons=FEWER_HORIZONS)], """
SELECT run_date, model, target_variable, horizon, location, quantile, value FROM inc""")
    q["point_to_median"] = _q([T, FC, """
fct AS (
  SELECT f.model, f.forecast_date, f.target_variable, f.horizon, f.target_end_date, f.location,
         f.location_name, f.type, f.quantile, f.value AS prediction, t.value AS true_value
  FROM fc f LEFT JOIN truth t
    ON t.target_variable = f.target_variable AND t.location = f.location
   AND t.target_end_date = f.target_end_date),
qrow AS (SELECT * EXCLUDE (type, quantile) FROM fct WHERE type = 'quantile' AND quantile = 0.5),
prow AS (SELECT * EXCLUDE (type, quantile) RENAME (prediction AS point_prediction)
         FROM fct WHERE type = 'point')"""], """
SELECT model, target_variable, forecast_date, target_end_date, horizon, location, location_name,
       COALESCE(q.prediction, p.point_prediction) AS prediction, true_value
FROM qrow q FULL JOIN prow p
  USING (model, forecast_date, target_variable, horizon, target_end_date, location, location_name,
         true_value)""")
    unit = "model, target_variable, forecast_date, target_end_date, horizon, location"
    q["interval_coverage"] = _q([T, FC, S], f"SELECT {unit}, cov_50, cov_95 FROM sc_raw")
    q["wis_components"] = _q([T, FC, S], f"""
SELECT {unit}, wis, sharpness, underprediction, overprediction FROM sc_raw""")
    q["ae_median"] = _q([T, FC, S], f"SELECT {unit}, ae_median FROM sc_raw")
    q["bias"] = _q([T, FC, S], f"SELECT {unit}, bias FROM sc_raw")
    q["n_quantiles"] = _q([T, FC, S], f"SELECT {unit}, n_quantiles FROM sc_raw")
    q["n_quantiles_off_list"] = _q([T, FC, S, f"""
lv AS (SELECT {unit}, CASE WHEN type = 'point' THEN 0.5::DOUBLE ELSE quantile END
              + unnest(CASE WHEN quantile < 0.5 THEN [0.0::DOUBLE, 1.0::DOUBLE / 1024, 1.0::DOUBLE / 512] ELSE [0.0::DOUBLE] END) AS level
       FROM fct WHERE true_value IS NOT NULL AND type IN ('quantile', 'point'))"""],
                                   f"SELECT {unit}, COUNT(DISTINCT level) AS n_quantiles FROM lv GROUP BY {unit}")
    q["score_table"] = _q([T, FC, S], "SELECT * FROM sc")
    subset = S.replace("WHERE true_value IS NOT NULL AND type IN ('quantile', 'point')",
                       "WHERE true_value IS NOT NULL AND type IN ('quantile', 'point')"
                       f" AND CASE WHEN type = 'point' THEN 0.5 ELSE quantile END IN ({', '.join(map(repr, SUBSET))})")
    q["score_quantile_subset"] = _q([T, FC, subset], f"""
SELECT {unit}, wis, ae_median, cov_50, cov_95, n_quantiles FROM sc_raw""")
    q["overall_rollup"] = _q([T, FC, S, SU], """
SELECT report_date, location, target_variable, CAST(SUM(n) AS BIGINT) AS n_rows,
       CASE WHEN SUM(wis_n) > 0 THEN SUM(wis_s) END AS sum_wis
FROM allrep GROUP BY ALL""")
    q["overall_half_locations"] = _q([T, FC, S, SU], """
SELECT report_date, model, target_variable, location, horizon, CAST(n AS BIGINT) AS n_rows
FROM sdf WHERE location = 'Overall'""")
    q["continuous_weeks"] = _q([T, FC, S, SU], "SELECT * FROM cw")
    q["rel_ae"] = _q([T, FC, S, SU], """
SELECT report_date, model, target_variable, horizon, location, rel_ae FROM summ""")
    q["rel_wis"] = _q([T, FC, S, SU], """
SELECT report_date, model, target_variable, horizon, location, rel_wis FROM summ""")
    q["msr_baseline"] = _q([T, FC, S, SU], """
SELECT report_date, model, target_variable, horizon, location, msr_baseline FROM summ""")
    q["summary_table"] = _q([T, FC, S, SU], "SELECT * FROM summ")
    q["summary_window"] = _q([T, FC, S, _summary(WINDOW_WEEKS)], "SELECT * FROM summ")
    q["summary_steady_models"] = _q([T, FC, S, _summary(steady=STEADY_WEEKS)], "SELECT * FROM summ")
    q["evaluation_table"] = q["evaluation_upkeep"] = _q([T, FC, S, SU], "SELECT * FROM evaluation")
    q["skill_weights"] = _q([T, FC, S, SU, C0, _skill(False)], """
SELECT run_date, model, target_variable, location, weight FROM weights""")
    q["skill_weights_by_horizon"] = _q([T, FC, S, SU, C0, _skill(True)], """
SELECT run_date, model, target_variable, location, horizon, weight FROM weights""")
    out = f"SELECT {_WCELL}, {{value}} AS value, COUNT(*) AS n_models FROM wf GROUP BY {_WCELL}"
    q["ensemble_skill_mean"] = _q([T, FC, S, SU, C0, _skill(False)], out.format(value=_MEAN))
    q["ensemble_skill_mean_by_horizon"] = _q([T, FC, S, SU, C0, _skill(True)], out.format(value=_MEAN))
    q["ensemble_skill_type7_median"] = _q([T, FC, S, SU, C0, _skill(False), _type7()], "SELECT * FROM t7")
    for name, by_horizon in (("ensemble_skill_hd_median", False), ("ensemble_skill_hd_median_by_horizon", True)):
        q[name] = _q([T, FC, S, SU, C0, _skill(by_horizon), _harrell_davis()], f"""
SELECT {_WCELL}, {_rd('value', HD_DIGITS)} AS value, n_models FROM hd""")
    q["skill_submission"] = _q([T, FC, S, SU, C0, _skill(False), f"""
ens AS (
  SELECT run_date, quantile, target_variable, location, horizon, {_MEAN} AS value,
         COUNT(*) AS n_models
  FROM wf GROUP BY run_date, quantile, target_variable, location, horizon),
ens2 AS (SELECT *, 'quantile' AS type, {_d11('run_date', 'horizon')} AS target_end_date FROM ens)""",
                                _fmt("ens2", res="'wk'")], "SELECT * FROM sub")
    q |= _batch(T, FC, S, SU, C0)
    q["submission_links"] = f"""
WITH p AS (
  SELECT page_id, 'team' || CAST(page_id % 13 AS VARCHAR) AS team,
         'm' || CAST(page_id % 4 AS VARCHAR) AS mdl
  FROM pages),
u AS (
  SELECT page_id,
         '{LINK_PREFIX}'
         || CASE WHEN page_id % 6 = 0 THEN 'data-raw' ELSE 'data-processed' END || '/'
         || team || '-' || mdl || '/'
         || strftime(DATE '2021-03-08' + CAST(7 * (page_id % 40) AS INTEGER), '%Y-%m-%d') || '-'
         || CASE WHEN page_id % 5 = 0 THEN team || '-x' ELSE team || '-' || mdl END || '.csv' AS url
  FROM p),
m AS (
  SELECT page_id, url,
         regexp_extract(url, 'data-processed/([a-zA-Z0-9_+]+-[a-zA-Z0-9_+]+)/[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}-(.+).csv$', 1) AS folder,
         regexp_extract(url, 'data-processed/([a-zA-Z0-9_+]+-[a-zA-Z0-9_+]+)/[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}-(.+).csv$', 2) AS file_model
  FROM u)
SELECT page_id, url, '{PREVIEW_URL}' || url AS link
FROM m WHERE folder <> '' AND folder = file_model"""
    return {k: v.strip() for k, v in q.items()}


def _batch(T, FC, S, SU, C0) -> dict[str, str]:
    """Ensembles, criteria and weights of the six methods."""
    skills = [T, FC, S, SU, C0, _skill(False), _skill(True, "_h")]

    def mean(sfx: str) -> str:
        return f"SELECT {_WCELL}, {_MEAN} AS value FROM wf{sfx} GROUP BY {_WCELL}"

    flat = "horizon, temporal_resolution, target_variable, target_end_date, location, type, quantile, value"
    weighted = " UNION ALL ".join(
        f"SELECT '{m}' AS method, run_date, horizon, 'wk', target_variable, {_d11('run_date', 'horizon')},"
        f" location, 'quantile', quantile, value FROM ({src}) x"
        for m, src in (("relative_skill", mean("")), ("relative_skill_by_horizon", mean("_h")),
                       ("relative_skill_median", "SELECT * FROM t7"),
                       ("relative_skill_by_horizon_median", "SELECT * FROM t7_h")))
    ensembles = _q([*skills, _type7(), _type7("_h"), f"""
e_mean AS (SELECT run_date, {ENS_KEYS}, SUM(value) / COUNT(value) AS value FROM norm GROUP BY ALL),
e_median AS (SELECT run_date, {ENS_KEYS}, median(value) AS value FROM norm GROUP BY ALL),
allf AS (
  SELECT 'mean' AS method, run_date, {flat} FROM e_mean
  UNION ALL SELECT 'median', run_date, {flat} FROM e_median
  UNION ALL {weighted}),
fmt AS (
  SELECT method, run_date AS forecast_date,
         CAST(horizon AS VARCHAR) || ' ' || temporal_resolution || ' ahead ' || target_variable AS target,
         target_end_date, location, type, quantile, {_rd('value', 0)} AS value
  FROM allf),
sub AS (
  SELECT * FROM fmt
  UNION ALL
  SELECT * REPLACE ('point' AS type, CAST(NULL AS DOUBLE) AS quantile) FROM fmt
  WHERE quantile = 0.5)"""], """
SELECT method, forecast_date, target, target_end_date, location, COUNT(*) AS n_rows,
       string_agg(coalesce(CAST(CAST(value AS BIGINT) AS VARCHAR), 'NA'), ',' ORDER BY type, quantile) AS "values"
FROM sub GROUP BY method, forecast_date, target, target_end_date, location""")
    keys = f"{_GRID_KEYS}, all_quantiles_all_horizons, all_horizons, not_excluded_manually, rel_wis"
    labels = lambda *m: "unnest([" + ", ".join(f"'{x}'" for x in m) + "])"
    flat_m, horizon_m = ("relative_skill", "relative_skill_median"), ("relative_skill_by_horizon",
                                                                     "relative_skill_by_horizon_median")
    by_method = " UNION ALL ".join(
        f"SELECT {labels(*ms)} AS method, {keys}, included_in_ensemble AND EXISTS (SELECT 1 FROM {w} w"
        f" WHERE w.run_date = c.run_date AND w.model = c.model) AS included_in_ensemble FROM crit c"
        for ms, w in ((flat_m, "weights"), (horizon_m, "weights_h")))
    found = _q(skills, f"""
SELECT {labels("mean", "median")} AS method, {keys}, included_in_ensemble FROM crit
UNION ALL {by_method}""")
    weights = _q([*skills, """
m AS (SELECT DISTINCT run_date, target_variable, location, model FROM norm)"""], f"""
SELECT {labels("mean", "median")} AS method, run_date, target_variable, location, model,
       0 AS horizon,
       1.0 / COUNT(*) OVER (PARTITION BY run_date, target_variable, location) AS weight FROM m
UNION ALL SELECT {labels(*flat_m)}, run_date, target_variable, location, model, 0, weight FROM weights
UNION ALL SELECT {labels(*horizon_m)}, run_date, target_variable, location, model, horizon, weight FROM weights_h""")
    return {"batch_runs": ensembles, "batch_criteria": found, "batch_weights": weights}
