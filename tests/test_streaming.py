import os
import tempfile

from conftest import rows
from hubcast.streaming import start_intake


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def test_intake_appends_valid_files_and_rejects_others(spark):
    src, out = tempfile.mkdtemp(prefix="hubcast-in-"), tempfile.mkdtemp(prefix="hubcast-out-")
    head = "forecast_date,target,target_end_date,location,type,quantile,value\n"
    _write(f"{src}/T-m/2021-03-08-T-m.csv", head + "2021-03-08,1 wk ahead inc case,2021-03-13,DE,quantile,0.5,10\n")
    _write(f"{src}/T-m/2021-03-08-T-x.csv", head + "2021-03-08,1 wk ahead inc case,2021-03-13,DE,quantile,0.5,99\n")
    q = start_intake(spark, src, out, name=f"t{os.getpid()}", available_now=True)
    q.awaitTermination(120)
    good = spark.read.parquet(os.path.join(out, "forecasts"))
    assert rows(good, "model", "horizon", "target_variable", "value") == [("T-m", 1, "inc case", 10.0)]
    assert spark.read.parquet(os.path.join(out, "rejects")).count() == 1

    # a second start reads only what is new; columns by name, a file without one is rejected
    _write(f"{src}/U-n/2021-03-15-U-n.csv", "value,quantile,type,location,target_end_date,target,forecast_date\n"
                                            "7,0.5,quantile,FR,2021-03-20,1 wk ahead inc case,2021-03-15\n")
    _write(f"{src}/U-n/2021-03-22-U-n.csv", "forecast_date,value\n2021-03-22,1\n")
    start_intake(spark, src, out, name=f"u{os.getpid()}", available_now=True).awaitTermination(120)
    good = spark.read.parquet(os.path.join(out, "forecasts"))
    assert rows(good, "model", "value") == [("T-m", 10.0), ("U-n", 7.0)]
    assert spark.read.parquet(os.path.join(out, "rejects")).count() == 2
