import json
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from bankmetrics import schemas
from bankmetrics.operators import funding
from bankmetrics.operators.checks import null_keys
from bankmetrics.plans import benchmarks, ratios
from bankmetrics.sinks import files
from bankmetrics.sources.files import read_financials, read_input, read_inputs, read_staged_metrics

ASSETS_CSV = """asset_id,branch_id,asset_type,balance,risk_weight,hqla_level,loan_status
A1,B1,Cash,10.005,0.0,Level 1,N/A
A2,B1,Corporate Loan,bad,1.0,Non-HQLA,Performing
,B2,Corporate Bonds,7.5,0.5,Level 2A,N/A
"""


def test_declared_schema(spark, tmp_path):
    (tmp_path / "assets.csv").write_text(ASSETS_CSV)
    assets = read_input(spark, str(tmp_path), "assets")
    rows = {r.asset_type: r for r in assets.collect()}
    assert rows["Cash"].balance == D("10.01")
    assert rows["Corporate Loan"].balance is None
    assert rows["Corporate Bonds"].risk_weight == D("0.50")
    found = {r.column_name: r.null_rows for r in null_keys(assets, *schemas.REQUIRED["assets"]).collect()}
    assert found == {"asset_id": 1, "branch_id": 0}


def test_inferred_schema(spark, tmp_path):
    (tmp_path / "assets.csv").write_text(ASSETS_CSV)
    types = dict(read_input(spark, str(tmp_path), "assets", infer=True).dtypes)
    assert types["balance"] == "string" and types["risk_weight"] == "double"


def test_csv_scan_reads_needed_columns_and_filters(spark, tmp_path):
    (tmp_path / "assets.csv").write_text(ASSETS_CSV)
    plan = ratios.npl_bank(read_input(spark, str(tmp_path), "assets"))._jdf.queryExecution().toString()
    assert "ReadSchema: struct<balance:decimal(18,2),loan_status:string>" in plan
    assert "IsNotNull(loan_status), Not(EqualTo(loan_status,N/A))" in plan


def test_parquet_inputs_round_trip(spark, tmp_path):
    rows = [("C1", "Tier 1 Capital", D("500.00"))]
    capital = spark.createDataFrame(rows, schemas.CAPITAL)
    for fmt in ("csv", "parquet", "orc"):
        files.write_inputs({"capital": capital}, str(tmp_path / fmt), fmt)
        assert read_input(spark, str(tmp_path / fmt), "capital", fmt).collect() == capital.collect()


def test_all_inputs(spark, tmp_path):
    for table, ddl in schemas.INPUTS.items():
        names = [part.split()[0] for part in ddl.replace("(18,2)", "").replace("(5,2)", "").split(", ")]
        (tmp_path / f"{table}.csv").write_text(",".join(names) + "\n")
    inputs = read_inputs(spark, str(tmp_path))
    assert set(inputs) == {"branches", "assets", "liabilities", "capital"}
    assert all(df.count() == 0 for df in inputs.values())


def test_staged_metrics(spark, tmp_path):
    assert read_staged_metrics(spark, str(tmp_path)).count() == 0
    for name, value in (("CAR", 0.5), ("NPL", 2.97)):
        files.stage_metric(spark.createDataFrame([(name, value)], schemas.STAGED_METRIC), str(tmp_path), name)
    staged = read_staged_metrics(spark, str(tmp_path))
    assert {tuple(r) for r in staged.collect()} == {("CAR", 0.5), ("NPL", 2.97)}
    assert len(list((tmp_path / "car_result").glob("*.csv"))) == 1


def financials_json(*entries):
    return {"data": [{"data": entry, "score": 0} for entry in entries]}


ENTRIES = (
    {"REPDTE": "20231231", "CERT": 1, "NAME": "One", "EQVWCOR": 10.5, "ASSET": 2e8},
    {"REPDTE": "20231231", "CERT": 2, "NAME": "Two", "EQVWCOR": None, "ASSET": 2e8},
    {"REPDTE": 20231231, "CERT": "3", "NAME": "Three", "EQVWCOR": "12", "ASSET": "100000000"},
    {"REPDTE": "20231231", "CERT": 5, "NAME": "Text", "EQVWCOR": "n/a", "ASSET": 3e8},
    {"REPDTE": "20231231", "CERT": 4, "NAME": "Small", "EQVWCOR": 99, "ASSET": 5},
)


def test_financials_document(spark, tmp_path):
    (tmp_path / "one.json").write_text(json.dumps(financials_json(*ENTRIES), indent=1))
    financials = read_financials(spark, str(tmp_path / "one.json"), multi_line=True)
    assert financials.columns == ["REPDTE", "CERT", "NAME", "EQVWCOR", "ASSET"]
    row = benchmarks.average_of(benchmarks.observations(financials)).first()
    assert (row.CAR, row.institutions) == (11.25, 2)


def test_financials_lines(spark, tmp_path):
    lines = [json.dumps(financials_json(entry)) for entry in ENTRIES]
    (tmp_path / "many.json").write_text("\n".join(lines))
    financials = read_financials(spark, str(tmp_path / "many.json"))
    assert financials.agg(F.count("*"), F.sum("CERT")).first()[:] == (5, 15)


def test_financials_without_entries(spark, tmp_path):
    (tmp_path / "none.json").write_text("{}")
    assert read_financials(spark, str(tmp_path / "none.json")).count() == 0


def test_broken_financials_fail(spark, tmp_path):
    (tmp_path / "broken.json").write_text('{"data": [')
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILFAST"):
        read_financials(spark, str(tmp_path / "broken.json")).collect()


def test_liabilities_with_their_own_maturity(spark, tmp_path):
    (tmp_path / "liabilities.csv").write_text("a,b,c,d,e,maturity_days\nL1,B1,Retail Savings,5.00,0.05,12\n")
    drawn = funding.with_maturity(read_input(spark, str(tmp_path), "liabilities"))
    own = read_input(spark, str(tmp_path), "liabilities", schema=schemas.LIABILITIES_WITH_MATURITY)
    assert drawn.columns == own.columns
    assert funding.with_maturity(own).first()["maturity_days"] == 12
