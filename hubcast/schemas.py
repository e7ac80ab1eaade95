"""Explicit schemas for every hub table (no inference at scale)."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, DT, I, L, B = T.StringType(), T.DoubleType(), T.DateType(), T.IntegerType(), T.LongType(), T.BooleanType()


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# one row of a submission file.
SUBMISSION = _st(("forecast_date", DT), ("target", S), ("target_end_date", DT),
                 ("location", S), ("type", S), ("quantile", D), ("value", D))

# parsed forecast (submission + model + parsed target).
FORECAST = _st(("model", S), ("forecast_date", DT), ("target_variable", S), ("horizon", I),
               ("temporal_resolution", S), ("target_end_date", DT), ("location", S),
               ("location_name", S), ("type", S), ("quantile", D), ("value", D))

# truth series.
TRUTH = _st(("location", S), ("location_name", S), ("target_variable", S),
            ("target_end_date", DT), ("value", D))

# One status file (target_variable is added when files are stacked).
STATUS_FILE = _st(("location", S), ("date", DT), ("status", S))

# score table.
SCORES = _st(("model", S), ("target_variable", S), ("forecast_date", DT), ("target_end_date", DT),
             ("horizon", I), ("location", S), ("location_name", S), ("wis", D), ("sharpness", D),
             ("underprediction", D), ("overprediction", D), ("ae_median", D), ("bias", D),
             ("cov_50", D), ("cov_95", D), ("n_quantiles", L))

# evaluation table as read back for weighting (CSV files per report date).
EVALUATION = _st(("model", S), ("target_variable", S), ("horizon", I), ("location", S),
                 ("rel_ae", D), ("rel_wis", D), ("msr_baseline", D), ("cov_50", D), ("cov_95", D),
                 ("bias", D), ("n", L), ("n_loc", L), ("location_name", S),
                 ("continuous_weeks", I), ("weeks_included", S))

# model designations; F10: manual exclusions.
DESIGNATIONS = _st(("model", S), ("designation", S))
EXCLUSIONS = _st(("model", S), ("forecast_date", DT))

GROUP_KEYS_AVERAGE = ("target_variable", "horizon", "temporal_resolution",
                      "target_end_date", "location", "type", "quantile")
UNIT_KEYS = ("model", "target_variable", "forecast_date", "target_end_date", "horizon", "location")
SUMMARY_KEYS = ("model", "target_variable", "horizon", "location")
