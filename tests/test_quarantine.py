"""Rows that do not fit their schema: put aside with their line, and out of all sums."""

import json
import shutil
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from bankmetrics import __main__ as command_line
from bankmetrics import monthly, schemas
from bankmetrics.functions import rules
from bankmetrics.plans import benchmarks, ratios
from bankmetrics.sinks import files, tables
from bankmetrics.sources import quarantine, synthetic
from bankmetrics.sources.files import read_input

HEADER = "asset_id,branch_id,asset_type,balance,risk_weight,hqla_level,loan_status\n"
GOOD = ["A1,B1,Cash,10.005,0.0,Level 1,N/A", "A2,B1,Corporate Loan,200.20,1,Non-HQLA,Performing", "A3,,Consumer Loan,,0.75,,"]
BROKEN = {
    "B1,B1,Corporate Loan,12x,1.0,Non-HQLA,Performing": "balance: 12x is no DECIMAL(18,2)",
    "B2,B1,Corporate Loan,1e17,1000,Non-HQLA,Performing": "balance: 1e17 is no DECIMAL(18,2); risk_weight: 1000 is no DECIMAL(5,2)",
    "B3,B1,Corporate Loan": "number of fields: B3,B1,Corporate Loan is no row of 7",
    "B4,B1,Cash,1.00,0.0,Level 1,N/A,one more": "number of fields: B4,B1,Cash,1.00,0.0,Level 1,N/A,one more is no row of 7",
}


@pytest.fixture
def broken(tmp_path):
    """Assets in two files of a folder, good and broken lines mixed."""
    folder = tmp_path / "data"
    (folder / "assets.csv").mkdir(parents=True)
    lines = [*GOOD, *BROKEN]
    for i in range(2):
        (folder / "assets.csv" / f"part-{i}.csv").write_text(HEADER + "\n".join(lines[i::2]) + "\n")
    return str(folder)


def check_assets(checked):
    rows = {r["asset_id"]: r for r in checked.rows.collect()}
    assert set(rows) == {"A1", "A2", "A3"} and checked.rows.columns == [f.split()[0] for f in schemas.ASSETS.split(", ")]
    assert (rows["A1"]["balance"], rows["A2"]["risk_weight"], rows["A3"]["balance"]) == (D("10.01"), D("1.00"), None)
    assert {(r["line"], r["reasons"]) for r in checked.rejected.collect()} == set(BROKEN.items())
    assert {r["file"].rsplit("/", 1)[1] for r in checked.rejected.collect()} == {"part-0.csv", "part-1.csv"}
    # What is selected does not decide which rows are good.
    assert [checked.rows.select(c).count() for c in ("asset_id", "balance", "loan_status")] == [3, 3, 3]
    assert checked.rejected.select("table_name").distinct().collect() == [("assets",)]


def test_good_and_rejected_rows(spark, broken):
    check_assets(quarantine.split(quarantine.read_marked(spark, broken, "assets"), "assets"))


def test_one_read_for_both(spark, broken, tmp_path):
    checked = quarantine.split_once(quarantine.read_marked(spark, broken, "assets"), "assets", f"{tmp_path}/kept")
    shutil.rmtree(broken)  # the source is not read again
    check_assets(checked)
    plan = checked.rejected._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_fits" in plan and "FileScan csv" not in plan


def test_the_plain_reader_takes_a_broken_amount_as_null(spark, broken):
    assert read_input(spark, broken, "assets").where("asset_id = 'B1'").first()["balance"] is None


def test_own_schema_empty_files_and_columnar_tables(spark, tmp_path):
    (tmp_path / "liabilities.csv").write_text("a,b,c,d,e,maturity_days\nL1,B1,Retail Savings,5.00,0.05,12\nL2,B1,x,5,0.05,soon\n")
    found = quarantine.split(
        quarantine.read_marked(spark, str(tmp_path), "liabilities", schema=schemas.LIABILITIES_WITH_MATURITY), "liabilities"
    )
    assert [r["maturity_days"] for r in found.rows.collect()] == [12]
    assert [r["reasons"] for r in found.rejected.collect()] == ["maturity_days: soon is no INT"]
    (tmp_path / "capital.csv").write_text("capital_id,capital_type,balance\n")
    none = quarantine.split(quarantine.read_marked(spark, str(tmp_path), "capital"), "capital")
    assert none.rows.count() == 0 and none.rejected.count() == 0
    files.write_inputs({"capital": spark.createDataFrame([("C", "Tier 1 Capital", D("1.00"))], schemas.CAPITAL)}, str(tmp_path), "parquet")
    stored = quarantine.split_once(quarantine.read_marked(spark, str(tmp_path), "capital", "parquet"), "capital", f"{tmp_path}/kept")
    assert stored.rows.collect() == [("C", "Tier 1 Capital", D("1.00"))] and stored.rejected.count() == 0


ENTRY = {"REPDTE": "20231231", "CERT": 1, "NAME": "One", "EQVWCOR": 10.5, "ASSET": 2e8}


def test_broken_envelopes_are_put_aside(spark, tmp_path):
    def envelope(*entries):
        return json.dumps({"data": [{"data": e} for e in entries]})

    good = [envelope(ENTRY, ENTRY | {"EQVWCOR": "12"}), envelope(ENTRY | {"EQVWCOR": "n/a"}), "{}", '{"data":[null,{"data":null}]}']
    bad = [envelope(ENTRY)[:-1], "not json", '{"data": ["x'] 
    (tmp_path / "many.json").write_text("\n".join([good[0], bad[0], "", good[1], bad[1], "   ", *good[2:], bad[2]]) + "\n")
    found = quarantine.read_checked_financials(spark, f"{tmp_path}/many.json")
    assert {(r["line"], r["reasons"]) for r in found.rejected.collect()} == {(line, "not JSON") for line in bad}
    assert sorted(r["EQVWCOR"] or 0 for r in found.rows.collect()) == [0, 10.5, 12.0]
    row = benchmarks.average_of(benchmarks.observations(found.rows)).first()
    assert (row["CAR"], row["institutions"]) == (11.25, 2)


def test_whole_documents(spark, tmp_path):
    folder = tmp_path / "docs"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps({"data": [{"data": ENTRY}] * 3}, indent=1))
    (folder / "b.json").write_text('{"data": [\n{"data": ')
    found = quarantine.read_checked_financials(spark, str(folder), multi_line=True)
    assert found.rows.count() == 3
    assert [r["file"].rsplit("/", 1)[1] for r in found.rejected.collect()] == ["b.json"]


@pytest.fixture
def database(spark, tmp_path, request):
    name = f"db_{abs(hash(request.node.name))}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/{name}'")
    tables.create_tables(spark, name)
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_a_run_leaves_rejected_rows_out_and_says_so(spark, database, tmp_path, capsys):
    sheet = synthetic.balance_sheet(spark, 400, 400, 4, 3)
    clean, dirty = str(tmp_path / "clean"), str(tmp_path / "dirty")
    for folder in (clean, dirty):
        files.write_inputs(sheet, folder)
    with open(f"{dirty}/assets.csv/more.csv", "w") as out:
        out.write(HEADER + "X1,B1,Corporate Loan,1 000 000,1.0,Non-HQLA,Non-Performing\nX2,B1\n")
    monthly.run(spark, clean, database=database, run_id="clean", seed=1)
    common = ["--data", dirty, "--database", database]
    command_line.main(["run", *common, "--seed", "1", "--run-id", "dirty", "--rejected", str(tmp_path / "aside")], spark)
    stored = tables.read(spark, tables.METRICS, database)
    assert stored.select("metric_name", "metric_value").distinct().count() == 3 and stored.count() == 6
    audit = tables.read(spark, tables.AUDIT, database).where("run_id = 'dirty'")
    assert {(r["pipeline_step"], r["status"]): r["message"] for r in audit.collect()}[("Input Check", "REJECTED")] == (
        "Rejected branches:0, assets:2, liabilities:0, capital:0"
    )
    kept = list((tmp_path / "aside" / "dirty").iterdir())
    assert len(kept) == 1 and {p.name for p in kept[0].iterdir()} == set(schemas.INPUTS)
    command_line.main(["check", *common, "--out", str(tmp_path / "out")], spark)
    assert "assets_rejected: 2" in capsys.readouterr().out
    lines = spark.read.option("header", True).csv(f"{tmp_path}/out/assets_rejected")
    assert {r["line"] for r in lines.collect()} == {"X1,B1,Corporate Loan,1 000 000,1.0,Non-HQLA,Non-Performing", "X2,B1"}


def test_a_run_without_rejected_rows(spark, database, tmp_path):
    files.write_inputs(synthetic.balance_sheet(spark, 100, 100, 4, 3), str(tmp_path / "data"), "parquet")
    monthly.run(spark, str(tmp_path / "data"), "parquet", database, "r1", 1, rejected=str(tmp_path / "aside"))
    wide = monthly.bank_ratios(spark, str(tmp_path / "data"), "parquet", 1).first()
    stored = {r["metric_name"]: r["metric_value"] for r in tables.read(spark, tables.METRICS, database).collect()}
    assert all(abs(float(stored[m]) - wide[m]) < 1e-4 for m in rules.METRICS)
    audit = tables.read(spark, tables.AUDIT, database)
    assert {(r["pipeline_step"], r["status"]) for r in audit.collect()} == {("Metrics Load", "SUCCESS"), ("Input Check", "SUCCESS")}


def test_benchmarks_from_lines_some_of_which_are_broken(spark, database, tmp_path):
    path = tmp_path / "fin.json"
    path.write_text(json.dumps({"data": [{"data": ENTRY}]}) + "\n{broken\n")
    words = ["benchmarks", "--json", str(path), "--database", database]
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILFAST"):
        command_line.main(words, spark)
    command_line.main([*words, "--rejected", str(tmp_path / "bad")], spark)
    stored = {r["metric_name"]: r["industry_average"] for r in tables.read(spark, tables.BENCHMARKS, database).collect()}
    assert stored["CAR"] == D("10.5000")
    assert [r["line"] for r in spark.read.option("header", True).csv(f"{tmp_path}/bad").collect()] == ["{broken"]


def test_sums_over_good_rows(spark, broken):
    checked = quarantine.read_checked_inputs(spark, broken, tables=["assets"])["assets"]
    measured = ratios.total_rwa(checked.rows, rules.risk_config(spark)).first()
    assert measured["total_rwa"] == D("200.20")
    assert quarantine.all_rejected([checked, checked]).count() == 2 * len(BROKEN)
    assert checked.rejected.agg(F.count_if(F.col("line").isNull())).first()[0] == 0
