import datetime as dt
import os
import tempfile

import pytest
from pyspark.errors import AnalysisException

from conftest import rows
from hubcast import schemas
from hubcast.sources import csvscan
from hubcast.sources.files import (preview_links, read_designations, read_evaluation, read_status,
                                   read_submissions, rows_by_name)

D = dt.date


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def test_read_submissions_prunes_dates_and_parses_target(spark):
    root = tempfile.mkdtemp(prefix="hubcast-sub-")
    head = "forecast_date,target,target_end_date,location,type,quantile,value\n"
    _write(f"{root}/T-m/2021-03-08-T-m.csv",
           head + "2021-03-08,1 wk ahead inc case,2021-03-13,DE,quantile,0.5,10\n"
                  "2021-03-08,2 wk ahead inc death,2021-03-20,DE,point,NA,3\n")
    _write(f"{root}/U-n/2021-03-01-U-n.csv", head + "2021-03-01,1 wk ahead inc case,2021-03-06,DE,quantile,0.5,7\n")
    df = read_submissions(spark, root, dates=["2021-03-08", "2021-03-07"])
    assert rows(df, "model", "horizon", "temporal_resolution", "target_variable", "quantile", "value") == [
        ("T-m", 1, "wk", "inc case", 0.5, 10.0), ("T-m", 2, "wk", "inc death", None, 3.0)]


def test_read_status_uses_three_files(spark):
    root = tempfile.mkdtemp(prefix="hubcast-st-")
    for name, st in (("hosp", "near-final"), ("case", "final"), ("death", "provisional")):
        _write(f"{root}/{name}.csv", f"location,date,status\nDE,2021-03-06,{st}\n")
    df = read_status(spark, f"{root}/hosp.csv", f"{root}/case.csv", f"{root}/death.csv")
    assert rows(df, "target_variable", "status") == [
        ("inc case", "final"), ("inc death", "provisional"), ("inc hosp", "near-final")]


def test_read_designations_from_yaml(spark):
    root = tempfile.mkdtemp(prefix="hubcast-meta-")
    _write(f"{root}/a.yml", "team_name: A\nmodel_abbr: \"T-a\"\nteam_model_designation: primary\n")
    _write(f"{root}/b.yml", "model_abbr: T-b  # comment\nteam_model_designation: 'other'\n")
    assert rows(read_designations(spark, root), "model", "designation") == [
        ("T-a", "primary"), ("T-b", "other")]


def test_read_evaluation_casts_and_dates(spark):
    root = tempfile.mkdtemp(prefix="hubcast-ev-")
    _write(f"{root}/evaluation-2021-03-08.csv",
           "model,target_variable,horizon,location,rel_wis,continuous_weeks,weeks_included\n"
           "A,inc case,1,DE,0.8,5,All\nB,inc case,1,DE,x,5,All\n")
    df = read_evaluation(spark, root)
    assert rows(df, "model", "rel_wis", "report_date") == [
        ("A", 0.8, D(2021, 3, 8)), ("B", None, D(2021, 3, 8))]


def test_preview_links(spark):  # fixture 31
    urls = spark.createDataFrame(
        [("https://x/raw/data-processed/T-m/2021-03-08-T-m.csv",),
         ("https://x/raw/data-processed/T-m/2021-03-08-T-x.csv",)], "url string")
    out = rows(preview_links(urls, "https://p.example.org/?file="), "link")
    assert len(out) == 1 and out[0][0].endswith("?file=https://x/raw/data-processed/T-m/2021-03-08-T-m.csv")


def test_columns_are_found_by_name(spark):
    """Shuffled and extra columns, quotes, a byte-order mark, Windows line ends; one layout per file."""
    root = tempfile.mkdtemp(prefix="hubcast-names-")
    _write(f"{root}/T-m/2021-03-08-T-m.csv",
           "\ufeffvalue,type,note,target_end_date,location,target,quantile,forecast_date\r\n"
           '10,quantile,"a, ""b""",2021-03-13,"DE",1 wk ahead inc case,0.5,2021-03-08\r\n\r\n')
    _write(f"{root}/U-n/2021-03-08-U-n.csv",
           "forecast_date,target,target_end_date,location,type,quantile,value\n"
           "2021-03-08,2 wk ahead inc death,2021-03-20,FR,point,NA,x\n")
    got = rows(read_submissions(spark, root), "model", "target_variable", "target_end_date", "location", "quantile", "value")
    assert got == [("T-m", "inc case", D(2021, 3, 13), "DE", 0.5, 10.0),
                   ("U-n", "inc death", D(2021, 3, 20), "FR", None, None)]
    _write(f"{root}/s.csv", "status,extra,date,location\nfinal,1,2021-03-06,DE\n")
    st = rows(read_status(spark, *[f"{root}/s.csv"] * 3), "target_variable", "location", "target_end_date", "status")
    assert st[0] == ("inc case", "DE", D(2021, 3, 6), "final") and len(st) == 3
    _write(f"{root}/ev/evaluation-2021-03-08.csv", "rel_wis,model,location,horizon,target_variable\n0.8,A,DE,1,inc case\n")
    _write(f"{root}/ev/evaluation-2021-03-15.csv",
           "model,target_variable,horizon,location,n,rel_wis\nA,inc case,1,DE,4,0.9\n")
    ev = rows(read_evaluation(spark, f"{root}/ev"), "report_date", "model", "rel_wis", "n")
    assert ev == [(D(2021, 3, 8), "A", 0.8, None), (D(2021, 3, 15), "A", 0.9, 4)]


def test_missing_columns_and_folders_are_errors(spark):
    root = tempfile.mkdtemp(prefix="hubcast-bad-")
    _write(f"{root}/T-m/2021-03-08-T-m.csv", "forecast_date,target,location,type,quantile,value\n2021-03-08,x,DE,point,NA,1\n")
    with pytest.raises(Exception, match="has no column target_end_date"):
        read_submissions(spark, root).collect()
    with pytest.raises(AnalysisException):
        read_submissions(spark, f"{root}/nowhere", dates=["2021-03-08"])
    assert read_submissions(spark, root, dates=["1999-01-01"]).collect() == []


def test_cells_with_line_breaks_and_repeated_names(spark):
    """A torn cell stays one cell; files of the same header without one are a scan of their own."""
    root = tempfile.mkdtemp(prefix="hubcast-torn-")
    for name in "abc":
        _write(f"{root}/{name}.csv", f"date,location,status,status\n2021-03-06,{name},final,x\n\n2021-03-13, {name} ,NA,\n")
    _write(f"{root}/d d.csv", 'date,location,status,status\r\n2021-03-06,"A",\"near\nfinal, ""or"" not",y\r\n2021-03-13,B,"","z"\r\n')
    _write(f"{root}/e.csv", "location,status\nE,final\n")
    _write(f"{root}/empty.csv", "")
    _write(f"{root}/f.csv", "status,location,date\n")
    layouts = csvscan.census(spark, f"{root}/*.csv")
    assert sorted((x.names, x.torn, len(x.files)) for x in layouts) == [
        (["date", "location", "status", "status"], False, 3), (["date", "location", "status", "status"], True, 1),
        (["location", "status"], False, 1), (["status", "location", "date"], False, 1)]
    with pytest.raises(ValueError, match="e.csv has no column date"):
        csvscan.read_by_name(spark, f"{root}/*.csv", schemas.STATUS_FILE)
    df = csvscan.read_by_name(spark, f"{root}/*.csv", schemas.STATUS_FILE, required=["location"])
    first, second = D(2021, 3, 6), D(2021, 3, 13)
    assert rows(df, "location", "date", "status") == sorted(
        [(n, first, "final") for n in "abc"] + [(n, second, None) for n in "abc"]
        + [("A", first, 'near\nfinal, "or" not'), ("B", second, None), ("E", None, "final")], key=lambda t: tuple((x is not None, x) for x in t))
    plan = df.select("location")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<c1:string>" in plan and "c3:string" not in plan


def test_stream_rows_keep_torn_cells(spark):
    text = "﻿status,date,location\r\n\"near\nfinal\",2021-03-06,\"A,B\"\r\nfinal,x,C\n"
    df = rows_by_name(spark.createDataFrame([("p", text)], "_path string, value string"), schemas.STATUS_FILE)
    assert rows(df, "location", "date", "status") == [("A,B", D(2021, 3, 6), "near\nfinal"), ("C", None, "final")]
