"""Small inputs with results worked out by hand."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from bankmetrics import schemas
from bankmetrics.functions import measures, rules
from bankmetrics.operators import checks, funding, positions, ranking
from bankmetrics.plans import benchmarks, history, ratios



def make_assets(spark, *rows):
    """Rows of (branch, type, balance, level, status)."""
    full = [
        (f"A{i}", branch, kind, None if balance is None else D(balance), None, level, status)
        for i, (branch, kind, balance, level, status) in enumerate(rows)
    ]
    return spark.createDataFrame(full, schemas.ASSETS)


def make_liabilities(spark, *rows):
    """Rows of (branch, maturity, outflow); the rate is 1."""
    full = [(f"L{i}", b, "Wholesale Funding", D(o), D("1.00"), m) for i, (b, m, o) in enumerate(rows)]
    return spark.createDataFrame(full, schemas.LIABILITIES_WITH_MATURITY)


def make_capital(spark, *rows):
    return spark.createDataFrame([(f"C{i}", kind, D(b)) for i, (kind, b) in enumerate(rows)], schemas.CAPITAL)


def test_car_of_one_loan(spark):
    assets = make_assets(spark, ("B01", "Corporate Loan", "4000.00", "Non-HQLA", "Performing"))
    capital = make_capital(spark, ("Tier 1 Capital", "500.00"))
    row = ratios.car(assets, capital, rules.risk_config(spark)).first()
    assert row["CAR"] == 12.5
    assert (row["total_rwa"], row["tier1_capital"]) == (D("4000.0000"), D("500.00"))


def test_rwa_from_own_weights(spark):
    rows = [("A1", "B", "x", D("4000.00"), D("1.00"), None, None), ("A2", "B", "y", D("10.01"), D("0.35"), None, None)]
    assets = spark.createDataFrame(rows, schemas.ASSETS)
    assert ratios.own_weight_rwa(assets).first()["total_rwa"] == D("4003.5035")


def test_only_tier_1_counts(spark):
    capital = make_capital(spark, ("Tier 1 Capital", "1.10"), ("Tier 2 Capital", "5.00"), ("Tier 1 Capital", "2.20"))
    assert ratios.tier1_capital(capital).first()[0] == D("3.30")


@pytest.fixture(scope="module")
def partly_mapped(spark):
    return make_assets(
        spark,
        ("B1", "Cash", "100.10", "Level 1", "N/A"),
        ("B1", "Corporate Loan", "200.20", "Non-HQLA", "Performing"),
        ("B1", "Consumer Loan", "300.30", "Non-HQLA", "Non-Performing"),
        ("B1", "Crypto", "50.00", "Non-HQLA", None),
        ("B1", "Corporate Bonds", "10.01", "Level 2A", "N/A"),
        ("B1", None, "7.00", None, None),
    )


def test_unmatched_type_adds_no_rwa(spark, partly_mapped):
    assert ratios.total_rwa(partly_mapped, rules.risk_config(spark)).first()[0] == D("430.430")
    per_row = positions.with_rwa(partly_mapped, rules.risk_config(spark))
    assert per_row.agg(F.sum("risk_weighted_balance")).first()[0] == D("430.430")
    assert per_row.count() == 6


def test_unmatched_types_are_reported(spark, partly_mapped):
    unmapped = checks.unmapped_types(partly_mapped, rules.risk_config(spark))
    assert {(r.asset_type, r.balance, r.positions) for r in unmapped.collect()} == {
        ("Crypto", D("50.00"), 1),
        (None, D("7.00"), 1),
    }


def test_loan_filter_drops_null_status(spark, partly_mapped):
    row = ratios.npl_bank(partly_mapped).first()
    assert (row.total_loan_balance, row.npl_balance, row.npl_ratio_percent, row.entity) == (
        D("500.50"),
        D("300.30"),
        60.00,
        1,
    )


def test_no_loans_gives_null_ratio(spark):
    empty = make_assets(spark)
    row = ratios.npl_bank(empty).first()
    assert (row.total_loan_balance, row.npl_ratio_percent, row.entity) == (None, None, None)
    assert ratios.npl_by_branch(empty).count() == 0


def test_zero_denominators_give_null(spark):
    assets = make_assets(spark, ("B1", "Cash", "0.00", "Level 1", "Performing"))
    assert ratios.npl_by_branch(assets).first()["npl_ratio_percent"] is None
    capital = make_capital(spark, ("Tier 1 Capital", "1.00"))
    assert ratios.car(assets, capital, rules.risk_config(spark)).first()["CAR"] is None
    assert ratios.lcr(assets, make_liabilities(spark)).first()["LCR"] is None


def test_haircuts(spark):
    assets = make_assets(
        spark,
        *[("B1", "t", "100.00", level, "N/A") for level in ("Level 1", "Level 2A", "Non-HQLA", None)],
    )
    assert ratios.total_hqla(assets).first()[0] == D("185")
    per_row = positions.with_hqla(assets)
    assert [r.hqla_value for r in per_row.orderBy("asset_id").collect()] == [D(100), D(85), D(0), D(0)]


def test_horizon_includes_its_last_day(spark):
    liabilities = make_liabilities(spark, ("B1", 0, "1.00"), ("B1", 30, "2.00"), ("B1", 31, "4.00"))
    assert funding.horizon_outflow(liabilities).first()[0] == D("3.00")


def test_lcr(spark):
    assets = make_assets(spark, ("B1", "Cash", "300.00", "Level 1", "N/A"))
    liabilities = make_liabilities(spark, ("B1", 3, "150.00"), ("B2", 45, "1000.00"))
    assert ratios.lcr(assets, liabilities).first()["LCR"] == 200.0


WINDOW = [("B1", 0, "1"), ("B1", 0, "2"), ("B1", 30, "4"), ("B1", 31, "8"), ("B1", 59, "16")]


def test_rolling_window_includes_peers_and_both_ends(spark):
    rolled = funding.rolling_outflow(make_liabilities(spark, *WINDOW))
    rows = rolled.orderBy("liability_id").collect()
    assert [int(r.rolling_30d_outflow) for r in rows] == [7, 7, 28, 24, 16]


def test_due_within_keeps_overdue(spark):
    now = dt.datetime(2024, 3, 1, 12)
    days = [15, 45, 30, -400]
    rows = [(f"TXN{i}", 1000 * i, now + dt.timedelta(days=d)) for i, d in enumerate(days, 1)]
    cash_flows = spark.createDataFrame(rows, "id STRING, amount INT, due_date TIMESTAMP")
    kept = ratios.due_within(cash_flows, "due_date", now, 30)
    assert [r.id for r in kept.orderBy("id").collect()] == ["TXN1", "TXN3", "TXN4"]


def test_worst_branches_break_ties_by_branch(spark):
    rows = [(f"B{i}", 5.0 if i < 4 else float(i)) for i in range(9)] + [("B9", None)]
    by_branch = spark.createDataFrame(rows, "branch_id STRING, npl_ratio_percent DOUBLE")
    worst = ratios.worst_branches(by_branch)
    assert [r.branch_id for r in worst.collect()] == ["B8", "B7", "B6", "B0", "B1"]


def test_sums_beyond_the_digits_of_a_double(spark):
    loans = [("B1", "Corporate Loan", "9999999999999999.99", "Non-HQLA", "Performing")] * 300
    row = ratios.npl_by_branch(make_assets(spark, *loans)).first()
    assert row.total_loan_balance == D("2999999999999999997.00") and row.npl_balance == 0


def test_npl_rounds_to_two_digits(spark):
    assets = make_assets(
        spark,
        ("B1", "Corporate Loan", "2.00", "Non-HQLA", "Performing"),
        ("B1", "Corporate Loan", "1.00", "Non-HQLA", "Non-Performing"),
    )
    assert ratios.npl_by_branch(assets).first()["npl_ratio_percent"] == 33.33


def observed(spark, *values):
    rows = [("20231231", i, value) for i, value in enumerate(values)]
    return spark.createDataFrame(rows, "REPDTE STRING, CERT LONG, EQVWCOR DOUBLE")


def test_benchmark_average_skips_nulls(spark):
    row = benchmarks.average_of(observed(spark, 10.5, None, 12.555)).first()
    assert (row.CAR, row.institutions) == (11.53, 2)


def test_benchmark_average_of_nothing_is_zero(spark):
    table = benchmarks.benchmark_table(benchmarks.average_of(observed(spark)))
    found = {r.metric_name: r.industry_average for r in table.collect()}
    assert found == {"CAR": D("0.0000"), "LCR": D("100.0000"), "NPL": D("1.5000")}


def test_benchmark_choice_of_institutions(spark):
    rows = [
        ("20231231", 3, "c", 1.0, 1e8),
        ("20231231", 1, "a", 2.0, 99_999_999.0),
        ("20231231", 2, "b", 3.0, 2e8),
        ("20230930", 4, "d", 4.0, 2e8),
    ]
    financials = spark.createDataFrame(rows, "REPDTE STRING, CERT LONG, NAME STRING, EQVWCOR DOUBLE, ASSET DOUBLE")
    chosen = benchmarks.observations(financials)
    assert {r.CERT for r in chosen.collect()} == {2, 3}
    assert chosen.columns == ["REPDTE", "CERT", "NAME", "EQVWCOR"]
    assert benchmarks.observations(financials, report_date=None).count() == 3


def test_delta_and_status(spark):
    rows = [("CAR", D("12.50"), D("11.00")), ("LCR", D("100.00"), D("100.00")), ("NPL", D("1.00"), D("1.50"))]
    compared = spark.createDataFrame(rows, "metric_name STRING, bank_metric DECIMAL(10,4), benchmark DECIMAL(10,4)")
    found = {r.metric_name: (r.delta, r.status) for r in benchmarks.with_delta(compared).collect()}
    assert found["CAR"] == (D("1.50"), "Above Benchmark")
    assert found["LCR"] == (D("0"), "Not Above Benchmark")
    assert found["NPL"] == (D("-0.50"), "Not Above Benchmark")


METRIC_ROWS = "run_id STRING, metric_name STRING, metric_value DECIMAL(10,4), computation_date TIMESTAMP"


def test_latest_run_ignores_null_dates_and_breaks_ties(spark):
    first, second = dt.datetime(2024, 1, 1), dt.datetime(2024, 3, 1)
    rows = [
        ("r1", "CAR", D(1), first),
        ("r2", "CAR", D(2), second),
        ("r2", "NPL", D(3), first),
        ("r0", "CAR", D(4), None),
        ("r1b", "CAR", D(5), second),
    ]
    latest = ranking.latest_run(spark.createDataFrame(rows, METRIC_ROWS))
    assert {(r.run_id, r.metric_name) for r in latest.collect()} == {("r2", "CAR"), ("r2", "NPL")}


def test_latest_period(spark):
    rows = [("20230930", "CAR", D(1)), ("20231231", "CAR", D(2)), ("20231231", "NPL", D(3))]
    table = spark.createDataFrame(rows, "report_period STRING, metric_name STRING, industry_average DECIMAL(10,4)")
    assert {r.metric_name for r in ranking.latest_period(table).collect()} == {"CAR", "NPL"}


def test_comparison_keeps_common_metrics(spark):
    bank = spark.createDataFrame([("CAR", 1.0), ("XYZ", 2.0), (None, 3.0)], "metric_name STRING, metric_value DOUBLE")
    industry = spark.createDataFrame([("CAR", 4.0), ("LCR", 5.0)], "metric_name STRING, industry_average DOUBLE")
    assert [tuple(r) for r in benchmarks.compare(bank, industry).collect()] == [("CAR", 1.0, 4.0)]


def test_snapshot_leaves_out_missing_metrics(spark):
    wide = spark.createDataFrame([(1.23455, None, 2.0)], "CAR DOUBLE, LCR DOUBLE, NPL DOUBLE")
    rows = history.snapshot(wide, "r", dt.datetime(2024, 1, 1)).collect()
    assert {(r.run_id, r.metric_name, r.metric_value) for r in rows} == {
        ("r", "CAR", D("1.2346")),
        ("r", "NPL", D("2.0000")),
    }


def test_staged_snapshot_can_fill_missing_metrics(spark):
    staged = spark.createDataFrame([("CAR", 1.5)], schemas.STAGED_METRIC)
    assert history.staged_snapshot(staged, "r").count() == 1
    filled = history.staged_snapshot(staged, "r", missing=0.0)
    assert {(r.metric_name, r.metric_value) for r in filled.collect()} == {("CAR", D("1.5")), ("LCR", 0), ("NPL", 0)}


def test_runs_keep_runs_known_to_one_table_only(spark):
    assets = make_assets(
        spark,
        ("B1", "Cash", "100.00", "Level 1", "N/A"),
        ("B1", "Corporate Loan", "50.00", "Non-HQLA", "Performing"),
    ).withColumns({"run_id": F.lit("r1"), "as_of": F.lit("2024-01-31").cast("date")})
    liabilities = make_liabilities(spark, ("B1", 1, "10.00")).withColumns(
        {"run_id": F.lit("r2"), "as_of": F.lit("2024-02-29").cast("date")}
    )
    capital = make_capital(spark, ("Tier 1 Capital", "5.00"))
    wide = history.runs(assets, liabilities, capital, rules.risk_config(spark))
    assert {(r.run_id, r.CAR, r.LCR) for r in wide.collect()} == {("r1", D("10"), None), ("r2", None, None)}
    newest = history.run_metrics(history.newest_run(wide)).collect()
    assert {(r.run_id, r.metric_name) for r in newest} == {("r1", "CAR"), ("r1", "NPL")}


def test_duplicate_keys(spark):
    rows = spark.createDataFrame([("r", "CAR"), ("r", "CAR"), ("r", "NPL")], "run_id STRING, metric_name STRING")
    assert [tuple(r) for r in checks.duplicate_keys(rows, "run_id", "metric_name").collect()] == [("r", "CAR", 2)]


def test_null_keys(spark):
    rows = spark.createDataFrame([("a", None), (None, None)], "x STRING, y STRING")
    assert {tuple(r) for r in checks.null_keys(rows, "x", "y").collect()} == {("x", 1), ("y", 2)}


def test_loan_types(spark):
    kinds = spark.createDataFrame([(kind,) for kind, _, _ in rules.ASSET_RULES], "t STRING")
    loans = {r.t for r in kinds.where(measures.is_loan_type(F.col("t"))).collect()}
    assert loans == {"Residential Mortgage", "Corporate Loan", "Consumer Loan"}
