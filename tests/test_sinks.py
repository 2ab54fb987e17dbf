import datetime as dt
import json
from decimal import Decimal as D

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from bankmetrics import __main__ as command_line
from bankmetrics import monthly, schemas
from bankmetrics.functions import rules
from bankmetrics.operators import funding
from bankmetrics.plans import history, ratios
from bankmetrics.sinks import files, tables
from bankmetrics.sources import synthetic

NOW = dt.datetime(2024, 1, 1)
WIDE = "CAR DOUBLE, LCR DOUBLE, NPL DOUBLE"


@pytest.fixture
def database(spark, tmp_path, request):
    name = f"db_{abs(hash(request.node.name))}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/{name}'")
    tables.create_tables(spark, name)
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def snapshot(spark, run_id, car=1.0, lcr=2.0, npl=3.0, at=NOW):
    return history.snapshot(spark.createDataFrame([(car, lcr, npl)], WIDE), run_id, at)


def test_creation_is_repeatable(spark, database, tmp_path):
    tables.create_tables(spark, database)
    found = {r.tableName for r in spark.sql(f"SHOW TABLES IN {database}").collect()}
    assert found == {"regulatory_metrics", "fdic_benchmarks", "audit_log"}


def test_append_and_audit(spark, database):
    monthly.store(snapshot(spark, "r1"), "r1", database)
    monthly.store(snapshot(spark, "r2", lcr=None), "r2", database)
    rows = spark.table(f"{database}.regulatory_metrics").collect()
    assert {(r.run_id, r.metric_name, r.metric_value) for r in rows} == {
        ("r1", "CAR", D(1)), ("r1", "LCR", D(2)), ("r1", "NPL", D(3)), ("r2", "CAR", D(1)), ("r2", "NPL", D(3)),
    }
    audit = {r.run_id: r for r in spark.table(f"{database}.audit_log").collect()}
    assert (audit["r1"].status, audit["r1"].pipeline_step) == ("SUCCESS", "Metrics Load")
    assert audit["r1"].message == "Loaded CAR:1.0000, LCR:2.0000, NPL:3.0000"
    assert (audit["r2"].status, audit["r2"].message) == ("FAILED", "Missing LCR")
    assert audit["r1"].log_timestamp is not None and audit["r1"].log_id != audit["r2"].log_id


def test_a_run_is_stored_once(spark, database):
    tables.append_metrics(snapshot(spark, "r1"), database)
    with pytest.raises(tables.DuplicateKey):
        tables.append_metrics(snapshot(spark, "r1", car=9.0), database)
    with pytest.raises(tables.DuplicateKey):
        tables.append_metrics(snapshot(spark, "r3").unionAll(snapshot(spark, "r3")), database)
    assert spark.table(f"{database}.regulatory_metrics").count() == 3


def test_column_limits(spark, database):
    tables.append_metrics(snapshot(spark, "r1", car=1.23455), database)
    stored = spark.table(f"{database}.regulatory_metrics")
    assert stored.where("metric_name = 'CAR'").first().metric_value == D("1.2346")
    with pytest.raises(PySparkException):
        tables.append_metrics(snapshot(spark, "r2", car=1e9), database)
    with pytest.raises(PySparkException):
        tables.append_metrics(snapshot(spark, "x" * 51), database)


BENCHMARK_ROWS = "report_period STRING, metric_name STRING, industry_average DECIMAL(10,4), fetched_at TIMESTAMP"


def test_benchmarks_are_replaced(spark, database):
    first = spark.createDataFrame([("20230930", "CAR", D(1), NOW), ("20230930", "NPL", D(2), NOW)], BENCHMARK_ROWS)
    tables.replace_benchmarks(first, database)
    # Even from the table's own rows.
    own = spark.table(f"{database}.fdic_benchmarks").where("metric_name = 'CAR'")
    tables.replace_benchmarks(own.withColumn("report_period", F.lit("20231231")), database)
    rows = spark.table(f"{database}.fdic_benchmarks").collect()
    assert [(r.report_period, r.metric_name, r.industry_average) for r in rows] == [("20231231", "CAR", D(1))]
    with pytest.raises(tables.DuplicateKey):
        tables.replace_benchmarks(first.unionAll(first), database)
    failing = F.raise_error(F.lit("lost")).cast("decimal(10,4)")
    with pytest.raises(PySparkException):
        tables.replace_benchmarks(first.withColumn("industry_average", failing), database)
    with pytest.raises(PySparkException):
        tables.replace_benchmarks(first.withColumn("report_period", F.lit("9" * 21)), database)
    assert spark.table(f"{database}.fdic_benchmarks").count() == 1
    assert spark.sql(f"SHOW TABLES IN {database}").count() == 3


def test_a_rerun_replaces_its_run_alone(spark, database):
    for run_id in ("r1", "r2"):
        monthly.store(snapshot(spark, run_id), run_id, database)
    files_of = lambda run_id: {
        r[0] for r in spark.table(f"{database}.regulatory_metrics").where(F.col("run_id") == run_id).select("_metadata.file_path").collect()
    }
    untouched = files_of("r1")
    monthly.store(snapshot(spark, "r2", car=9.0, npl=None), "r2", database, again=True)
    rows = spark.table(f"{database}.regulatory_metrics").collect()
    assert {(r.run_id, r.metric_name, r.metric_value) for r in rows} == {
        ("r1", "CAR", D(1)), ("r1", "LCR", D(2)), ("r1", "NPL", D(3)), ("r2", "CAR", D(9)), ("r2", "LCR", D(2)),
    }
    assert files_of("r1") == untouched
    audit = spark.table(f"{database}.audit_log").where("run_id = 'r2'").collect()
    assert {(r.status, r.message) for r in audit} == {
        ("SUCCESS", "Loaded CAR:1.0000, LCR:2.0000, NPL:3.0000"), ("FAILED", "Missing NPL"),
    }
    # A first run by the same way.
    tables.replace_metrics(snapshot(spark, "r3"), database)
    assert spark.table(f"{database}.regulatory_metrics").count() == 8


def test_a_failed_rerun_leaves_the_old_rows(spark, database):
    tables.append_metrics(snapshot(spark, "r1"), database)
    mode = spark.conf.get(tables.OVERWRITE_MODE)
    lost = snapshot(spark, "r1", car=5.0).withColumn("metric_value", F.raise_error(F.lit("lost")).cast("decimal(10,4)"))
    with pytest.raises(PySparkException):
        tables.replace_metrics(lost, database)
    with pytest.raises(tables.DuplicateKey):
        tables.replace_metrics(snapshot(spark, "r1").unionAll(snapshot(spark, "r1")), database)
    with pytest.raises(tables.ColumnLimit):
        tables.replace_metrics(snapshot(spark, "r1").withColumn("metric_value", F.lit(10**7)), database)
    with pytest.raises(tables.EmptyRun):
        tables.replace_metrics(snapshot(spark, "r1", None, None, None), database)
    rows = spark.table(f"{database}.regulatory_metrics").collect()
    assert {(r.metric_name, r.metric_value) for r in rows} == {("CAR", D(1)), ("LCR", D(2)), ("NPL", D(3))}
    assert spark.conf.get(tables.OVERWRITE_MODE) == mode and spark.sql(f"SHOW TABLES IN {database}").count() == 3


def test_all_values_over_a_limit_are_named(spark, database):
    rows = snapshot(spark, "x" * 51).withColumn("metric_value", F.when(F.col("metric_name") == "NPL", 1e9).otherwise(1.0))
    with pytest.raises(tables.ColumnLimit) as error:
        tables.append_metrics(rows, database)
    assert str(error.value).count("over VARCHAR(50)") == 3 and str(error.value).count("over DECIMAL(10,4)") == 1
    assert spark.table(f"{database}.regulatory_metrics").count() == 0


def test_a_period_of_benchmarks_is_replaced_and_old_folders_go(spark, database, tmp_path):
    def rows(period, *values):
        return spark.createDataFrame([(period, m, D(v), NOW) for m, v in zip(rules.METRICS, values)], BENCHMARK_ROWS)

    folders = lambda: [p.name for p in (tmp_path / database).iterdir() if p.name.startswith("fdic_benchmarks-")]
    for i in range(4):
        tables.replace_benchmarks(rows("20230930", i, i, i), database)
    assert len(folders()) == 2  # the one in use, and the one before for who still reads it
    tables.replace_benchmarks(rows("20231231", 7, 8), database, other_periods=True)
    tables.replace_benchmarks(rows("20231231", 9), database, other_periods=True)
    stored = spark.table(f"{database}.fdic_benchmarks").collect()
    assert {(r.report_period, r.metric_name, r.industry_average) for r in stored} == {
        ("20230930", "CAR", D(3)), ("20230930", "LCR", D(3)), ("20230930", "NPL", D(3)), ("20231231", "CAR", D(9)),
    }
    before = folders()
    with pytest.raises(tables.ColumnLimit):
        tables.replace_benchmarks(rows("9" * 21, 1), database, other_periods=True)
    assert folders() == before and spark.table(f"{database}.fdic_benchmarks").count() == 4


def test_monthly_run_equals_the_staged_path(spark, database, tmp_path):
    data = str(tmp_path / "data")
    common = ["--data", data, "--database", database]
    run = lambda *words: command_line.main(list(words), spark)
    run("generate", *common, "--assets", "3000", "--liabilities", "3000", "--branches", "5", "--seed", "3")
    for name in ("car", "lcr", "npl"):
        run(name, *common, "--seed", "3")
    run("load", *common)
    run("run", *common, "--seed", "3")
    stored = spark.table(f"{database}.regulatory_metrics")
    assert stored.select("metric_name", "metric_value").distinct().count() == 3
    assert stored.select("run_id").distinct().count() == 2

    (tmp_path / "fin.json").write_text(
        json.dumps({"data": [{"data": {"REPDTE": "20231231", "CERT": 1, "NAME": "x", "EQVWCOR": 9.25, "ASSET": 3e8}}]})
    )
    run("benchmarks", "--database", database, "--json", str(tmp_path / "fin.json"), "--copy", data)
    report = {r.metric_name: r for r in monthly.report(spark, database).collect()}
    assert set(report) == {"CAR", "LCR", "NPL"}
    assert report["CAR"].benchmark == D("9.2500") and report["LCR"].benchmark == D("100.0000")
    assert report["CAR"].delta == report["CAR"].bank_metric - D("9.25")
    copy = spark.read.option("header", True).csv(f"{data}/fdic_benchmarks.csv")
    assert copy.count() == 3
    run("rolling", *common, "--out", str(tmp_path / "rolled"))
    assert spark.read.parquet(str(tmp_path / "rolled")).count() == 3000
    run("worst-branches", *common)
    run("check", *common, "--out", str(tmp_path / "checked"))
    assert spark.read.option("header", True).csv(str(tmp_path / "checked/assets_duplicate_keys"), schema="asset_id STRING, copies LONG").count() == 0
    run("report", "--database", database)
    run("create-tables", "--database", database)


def test_checks_are_written_whole(spark, tmp_path, capsys):
    names = [f"asset-with-a-very-long-identifier-{i:04d}" for i in range(100)]
    rows = [(name, None, "Crypto", D(1), None, None, "N/A") for name in names for _ in range(2)]
    sheet = {"assets": spark.createDataFrame(rows, schemas.ASSETS)}
    for table, ddl in schemas.INPUTS.items():
        sheet.setdefault(table, spark.createDataFrame([], ddl))
    files.write_inputs(sheet, str(tmp_path / "data"))
    command_line.main(["check", "--data", str(tmp_path / "data"), "--out", str(tmp_path / "out")], spark)
    found = spark.read.option("header", True).csv(str(tmp_path / "out/assets_duplicate_keys")).collect()
    assert sorted(r.asset_id for r in found) == names
    printed = capsys.readouterr().out
    assert "assets_duplicate_keys: 100" in printed and "assets_unmapped_types: 1" in printed
    assert "assets_null_keys: 1" in printed


def test_the_audit_row_can_be_added_after_a_failure(spark, database, monkeypatch):
    def failing(*words):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(tables, "append_audit", failing)
        with pytest.raises(OSError):
            monthly.store(snapshot(spark, "r1"), "r1", database)
    audit = spark.table(f"{database}.audit_log")
    assert audit.count() == 0 and spark.table(f"{database}.regulatory_metrics").count() == 3
    for _ in range(2):
        command_line.main(["audit", "--run-id", "r1", "--database", database], spark)
        spark.catalog.refreshTable(f"{database}.audit_log")
    assert [(r.run_id, r.status) for r in spark.table(f"{database}.audit_log").collect()] == [("r1", "SUCCESS")]
    assert spark.sql(f"SHOW TABLES IN {database}").count() == 3


def test_loading_with_a_metric_not_staged(spark, database, tmp_path):
    files.stage_metric(spark.createDataFrame([("CAR", 0.5)], schemas.STAGED_METRIC), str(tmp_path), "CAR")
    empty = spark.createDataFrame([("LCR", None)], schemas.STAGED_METRIC)
    files.stage_metric(empty, str(tmp_path), "LCR")
    command_line.main(["load", "--data", str(tmp_path), "--database", database], spark)
    command_line.main(["load", "--data", str(tmp_path), "--database", database, "--missing", "0"], spark)
    audit = {r.status: r.message for r in spark.table(f"{database}.audit_log").collect()}
    assert audit == {"FAILED": "Missing LCR, NPL", "SUCCESS": "Loaded CAR:0.5000, LCR:0.0000, NPL:0.0000"}


def test_generated_ratios_are_where_the_parameters_put_them(spark):
    sheet = synthetic.balance_sheet(spark, 100_000, 100_000, seed=1)
    liabilities = funding.with_maturity(sheet["liabilities"], 1)
    row = ratios.ratios_of(sheet["assets"], liabilities, sheet["capital"], rules.risk_config(spark)).first()
    # A fifth of the default rows, so CAR is five times the default's 0.078 to 0.155.
    assert 0.35 < row.CAR < 0.8
    assert 95 < row.LCR < 115
    assert 2.6 < row.NPL < 3.4
