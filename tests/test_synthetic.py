from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from bankmetrics import schemas
from bankmetrics.functions import rules
from bankmetrics.operators import funding
from bankmetrics.sources import synthetic

ROWS = 20_000


@pytest.fixture(scope="module")
def sheet(spark):
    return synthetic.balance_sheet(spark, ROWS, ROWS, branch_count=50, seed=7)


def digest(df):
    return df.agg(F.count("*"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first()[:]


@pytest.mark.parametrize("table", ["branches", "assets", "liabilities", "capital"])
def test_rows_do_not_depend_on_tasks_but_on_the_seed(spark, sheet, table, monkeypatch):
    monkeypatch.setattr(synthetic, "ROWS_PER_TASK", 900)
    again = synthetic.balance_sheet(spark, ROWS, ROWS, branch_count=50, seed=7)
    assert digest(again[table]) == digest(sheet[table])
    assert digest(synthetic.balance_sheet(spark, ROWS, ROWS, branch_count=50, seed=8)[table]) != digest(sheet[table])


def test_schemas(spark, sheet):
    for name, df in sheet.items():
        assert df.dtypes == spark.createDataFrame([], schemas.INPUTS[name]).dtypes


def test_asset_rules_hold(sheet):
    kinds = sheet["assets"].select("asset_type", "risk_weight", "hqla_level").distinct().collect()
    assert {tuple(r) for r in kinds} == {(k, D(w), level) for k, w, level in rules.ASSET_RULES}


def test_asset_distributions(sheet):
    assets = sheet["assets"]
    low, high, kinds, ids = assets.agg(
        F.min("balance"), F.max("balance"), F.count_distinct("asset_type"), F.count_distinct("asset_id")
    ).first()
    assert D(10_000) <= low < D(20_000) and D(4_990_000) < high <= D(5_000_000)
    assert (kinds, ids) == (7, ROWS)
    statuses = {r.loan_status: r["count"] for r in assets.groupBy("loan_status").count().collect()}
    loans = statuses["Performing"] + statuses["Non-Performing"]
    assert abs(loans / ROWS - 3 / 7) < 0.02
    assert abs(statuses["Non-Performing"] / loans - 0.03) < 0.007
    wrong = assets.where((F.col("loan_status") == "N/A") == F.col("asset_type").rlike("Loan|Mortgage"))
    assert wrong.count() == 0


def test_every_row_has_a_known_branch(sheet):
    for name in ("assets", "liabilities"):
        orphans = sheet[name].join(sheet["branches"], "branch_id", "left_anti")
        assert orphans.count() == 0
        assert sheet[name].select("branch_id").distinct().count() == 50


def test_liability_rules_hold(sheet):
    kinds = sheet["liabilities"].select("liability_type", "outflow_rate").distinct().collect()
    assert {tuple(r) for r in kinds} == {(k, D(rate)) for k, rate in rules.LIABILITY_RULES}


def test_capital_is_one_tier_1_row(sheet):
    (row,) = sheet["capital"].collect()
    assert row.capital_type == "Tier 1 Capital" and D("5e8") <= row.balance <= D("1e9")


def test_drawn_maturity(spark, sheet):
    drawn = funding.with_maturity(sheet["liabilities"], seed=1)
    low, high, early = drawn.agg(
        F.min("maturity_days"), F.max("maturity_days"), F.avg((F.col("maturity_days") <= 30).cast("double"))
    ).first()
    assert (low, high) == (0, 59) and abs(early - 31 / 60) < 0.02
    assert digest(drawn) == digest(funding.with_maturity(sheet["liabilities"].repartition(5), seed=1))
    assert funding.with_maturity(drawn, seed=2) is drawn
