"""Hub tables derived from the driver's star-schema test tables.

Everything here is a deterministic Spark derivation of the given parquet
tables, so its work grows with them, and the DuckDB oracle
(``hubcast.plans.oracle``) rebuilds the same tables in SQL.

* truth: weekly counts of lineitems per region (location) and return flag
  (target variable), week ending Saturday; missing weeks inside a series are 0.
* forecasts: every truth week is a forecast origin; each hub member submits
  23 quantiles for horizons 1-4 on the Monday after the origin. Values are
  integers so sums are exact in every engine. Irregularities are planted so
  that each criterion, the point fallback and the Overall filter have work.
* daily truth: events counted per day and event type.
* status: weeks where open lineitems outnumber finished ones are "near-final";
  ties give a status row with a missing status.
* links: submission-like paths built from page ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import HubConfig
from ..functions.dates import week_end, weeks_since_epoch

# Target variable per lineitem return flag.
RETURNFLAG_TARGETS = (("A", "inc case"), ("N", "inc death"), ("R", "inc hosp"))

# Hub members as (model, scale in eighths, quantile step).
MODELS = (
    ("hub-baseline", 8, 2),
    ("T-m1", 9, 1),
    ("T-m2", 7, 1),
    ("T-m3", 10, 2),
    ("T-m4", 6, 1),
    ("T-m5", 8, 3),
    ("T-m6", 12, 1),
    ("hub-ensemble", 8, 1),
)

# Metadata designation per model.
DESIGNATIONS = (
    ("hub-baseline", "secondary"),
    ("T-m1", "primary"),
    ("T-m2", "secondary"),
    ("T-m3", "primary"),
    ("T-m4", "primary"),
    ("T-m5", "other"),
    ("T-m6", "primary"),
    ("hub-ensemble", "secondary"),
)

# Prefix and folder names of the synthetic changed-file links.
LINK_PREFIX = "https://raw.example.org/hub/main/"
PREVIEW_URL = "https://preview.example.org/?file="


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _flag_to_target(flag: Column) -> Column:
    expr = None
    for f, tv in RETURNFLAG_TARGETS:
        expr = (F.when(flag == f, tv) if expr is None else expr.when(flag == f, tv))
    return expr


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation -> (location, location_name); 25 rows by the TPC-H definition."""
    nation = _read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = _read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
            .select("n_nationkey",
                    F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("location"),
                    F.col("r_name").alias("location_name")))


def _lineitem_weeks(spark: SparkSession, sf_dir: str, cfg: HubConfig) -> DataFrame:
    """Lineitems counted per (supplier, flag, week, status) before any join.

    Pre-aggregating on the supplier key shrinks the fact side to
    suppliers x weeks before it meets the supplier table, whose size grows
    with the data and is therefore left to AQE (broadcast only if small).
    """
    li = _read(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus",
                                                 "l_shipdate")
    return (li.withColumn("target_end_date", week_end(F.to_date("l_shipdate"), cfg.week_end_day))
              .groupBy("l_suppkey", "l_returnflag", "target_end_date")
              .agg(F.count(F.lit(1)).alias("n"),
                   F.count(F.when(F.col("l_linestatus") == "O", 1)).alias("n_open")))


def _by_location(spark: SparkSession, sf_dir: str, cfg: HubConfig) -> DataFrame:
    weeks = _lineitem_weeks(spark, sf_dir, cfg)
    supplier = _read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    geo = regions(spark, sf_dir)
    return (weeks.join(supplier, weeks.l_suppkey == supplier.s_suppkey)
            .join(F.broadcast(geo), F.col("s_nationkey") == geo.n_nationkey)
            .withColumn("target_variable", _flag_to_target(F.col("l_returnflag")))
            .filter(F.col("target_variable").isNotNull())
            .groupBy("location", "location_name", "target_variable", "target_end_date")
            .agg(F.sum("n").alias("n"), F.sum("n_open").alias("n_open")))


def truth(spark: SparkSession, sf_dir: str, cfg: HubConfig = HubConfig()) -> DataFrame:
    """Weekly truth (F3), densified with zeros between each series' first and last week."""
    obs = _by_location(spark, sf_dir, cfg)
    series = ["location", "location_name", "target_variable"]
    span = obs.groupBy(*series).agg(F.min("target_end_date").alias("lo"),
                                    F.max("target_end_date").alias("hi"))
    grid = span.select(*series, F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 7 DAYS")))
                       .alias("target_end_date"))
    return (grid.join(obs.select(*series, "target_end_date", "n"), series + ["target_end_date"], "left")
            .select(*series, "target_end_date",
                    F.coalesce(F.col("n"), F.lit(0)).cast("double").alias("value")))


def status(spark: SparkSession, sf_dir: str, cfg: HubConfig = HubConfig()) -> DataFrame:
    """Status rows (target_variable, location, target_end_date, status) as stacked by S4."""
    obs = _by_location(spark, sf_dir, cfg)
    closed = F.col("n") - F.col("n_open")
    return (obs.filter(F.col("n_open") >= closed)
            .select("target_variable", "location", "target_end_date",
                    F.when(F.col("n_open") > closed, F.lit("near-final")).alias("status")))


def daily_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily series: events per day and event type (location)."""
    ev = _read(spark, sf_dir, "events").select("ts", "event_type")
    return (ev.groupBy(F.col("event_type").alias("location"), F.to_date("ts").alias("date"))
            .agg(F.count(F.lit(1)).cast("double").alias("value"))
            .withColumn("target_variable", F.lit("inc case"))
            .select("location", "target_variable", "date", "value"))


def _models_array() -> Column:
    return F.array(*[F.struct(F.lit(m).alias("model"), F.lit(a / 8.0).alias("a"),
                              F.lit(b).alias("b")) for m, a, b in MODELS])


def forecasts(spark: SparkSession, sf_dir: str, cfg: HubConfig = HubConfig(),
              truth_df: DataFrame | None = None) -> DataFrame:
    """Forecast table (F2) for every origin week of the truth.

    Rows are generated by ``explode`` (models x horizons x quantiles per
    origin), never by a join, so generation stays inside one stage.
    """
    t = truth_df if truth_df is not None else truth(spark, sf_dir, cfg)
    g = (t.select("location", "location_name", "target_variable",
                  F.col("target_end_date").alias("origin"), F.col("value").alias("v"))
         .withColumn("m", F.explode(_models_array()))
         .withColumn("horizon", F.explode(F.array(*[F.lit(h) for h in cfg.horizons])))
         .select("*", F.posexplode(F.array(*[F.lit(q) for q in cfg.quantiles]))
                 .alias("qpos", "quantile")))
    model, loc, tv, h, q = F.col("m.model"), F.col("location"), F.col("target_variable"), \
        F.col("horizon"), F.col("quantile")
    dropped = (((model == "T-m3") & (F.pmod(weeks_since_epoch("origin"), F.lit(5)) == 0))
               | ((model == "T-m4") & (loc == "R2") & (q == 0.01))
               | ((model == "T-m6") & (loc == "R4") & (h > 2))
               | ((model == "T-m2") & (tv == "inc hosp") & ~loc.isin("R0", "R1")))
    as_point = (model == "T-m5") & (loc == "R3") & (q == 0.5)
    value = (F.floor(F.col("v") * F.col("m.a"))
             + (F.col("qpos") + 1 - 12) * (F.lit(1) + h) * F.col("m.b")).cast("double")
    return (g.filter(~dropped)
            .select(model.alias("model"),
                    F.date_add("origin", 2).alias("forecast_date"),
                    tv.alias("target_variable"),
                    h.cast("int").alias("horizon"),
                    F.lit(cfg.temporal_resolution).alias("temporal_resolution"),
                    F.date_add("origin", F.lit(7) * h).alias("target_end_date"),
                    loc.alias("location"), "location_name",
                    F.when(as_point, "point").otherwise("quantile").alias("type"),
                    F.when(as_point, F.lit(None).cast("double")).otherwise(q).alias("quantile"),
                    value.alias("value")))


def designations(spark: SparkSession) -> DataFrame:
    """Model designations (F9) as a metadata folder would give them."""
    return spark.createDataFrame(list(DESIGNATIONS), "model string, designation string")


def exclusions(spark: SparkSession, sf_dir: str, cfg: HubConfig = HubConfig(),
               truth_df: DataFrame | None = None) -> DataFrame:
    """Manual exclusions (F10): T-m1 on the forecast dates of every 7th week (offset 3)."""
    t = truth_df if truth_df is not None else truth(spark, sf_dir, cfg)
    weeks = t.select("target_end_date").distinct()
    return (weeks.filter(F.pmod(weeks_since_epoch("target_end_date"), F.lit(7)) == 3)
            .select(F.lit("T-m1").alias("model"),
                    F.date_add("target_end_date", 2).alias("forecast_date")))


def changed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Submission-like URLs built from page ids (input of S7)."""
    p = _read(spark, sf_dir, "pages").select("page_id")
    pid = F.col("page_id")
    team = F.concat(F.lit("team"), F.pmod(pid, F.lit(13)).cast("string"))
    mdl = F.concat(F.lit("m"), F.pmod(pid, F.lit(4)).cast("string"))
    folder = F.concat_ws("-", team, mdl)
    file_model = F.when(F.pmod(pid, F.lit(5)) == 0, F.concat_ws("-", team, F.lit("x"))).otherwise(folder)
    data_folder = F.when(F.pmod(pid, F.lit(6)) == 0, F.lit("data-raw")).otherwise(F.lit("data-processed"))
    day = F.date_format(F.date_add(F.lit("2021-03-08").cast("date"),
                                   (F.pmod(pid, F.lit(40)) * 7).cast("int")), "yyyy-MM-dd")
    url = F.concat(F.lit(LINK_PREFIX), data_folder, F.lit("/"), folder, F.lit("/"), day,
                   F.lit("-"), file_model, F.lit(".csv"))
    return p.select("page_id", url.alias("url"))
