"""Physical plans: what is scanned, shuffled, broadcast and split."""

import datetime as dt
import re
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bankmetrics.functions import rules
from bankmetrics.operators import funding, positions, ranking
from bankmetrics.plans import history, ratios, reports
from bankmetrics.sinks import tables
from bankmetrics.sources import star, synthetic
from bankmetrics.workload import queries

REGISTERED = queries.all_queries()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df, name):
    return len(re.findall(rf"FileScan parquet.*?/{name}\.parquet", plan_of(df)))


@pytest.fixture
def setting(spark):
    changed = {}

    def change(key, value):
        changed.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield change
    for key, value in changed.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("name", sorted(set(REGISTERED) - {"screened_duplicate_keys"}))
def test_no_python_and_no_cartesian_product(spark, star_folder, name):
    plan = plan_of(REGISTERED[name](spark, star_folder))
    assert "Python" not in plan and "ArrowEval" not in plan
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


@pytest.mark.parametrize("name", sorted(REGISTERED))
def test_single_partition_steps_are_global_aggregates(spark, star_folder, name):
    """One task only ever merges the one partial row per task of a global aggregate."""
    lines = plan_of(REGISTERED[name](spark, star_folder)).splitlines()
    for line, below in zip(lines, lines[1:]):
        if "SinglePartition" in line:
            assert re.search(r"Aggregate\(keys?=\[\]", below)


@pytest.mark.parametrize("name", ["scorecard", "metric_snapshot", "metric_history", "latest_run", "fused_bank_ratios"])
def test_all_ratios_from_one_scan_of_each_large_table(spark, star_folder, name):
    df = REGISTERED[name](spark, star_folder)
    assert scans(df, "lineitem") == 1 and scans(df, "orders") == 1


@pytest.mark.parametrize("name", ["car", "npl_bank", "lcr", "scorecard", "metric_history", "hqla_by_level"])
def test_bank_wide_queries_need_no_placement(spark, star_folder, name):
    assert scans(REGISTERED[name](spark, star_folder), "supplier") == 0


def test_scans_read_only_needed_columns(spark, star_folder):
    plan = REGISTERED["car"](spark, star_folder)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<l_partkey:bigint,l_extendedprice:double>" in plan
    assert "ReadSchema: struct<c_acctbal:double,c_mktsegment:string>" in plan


def test_due_date_reaches_the_scan(spark, star_folder):
    assert "LessThanOrEqual(o_orderdate" in plan_of(REGISTERED["due_within"](spark, star_folder))


def test_top_branches_without_a_full_sort(spark, star_folder):
    assert "TakeOrderedAndProject" in plan_of(REGISTERED["npl_top5"](spark, star_folder))


def test_rules_are_joined_after_aggregation(spark, star_folder):
    assets = star.assets(spark, star_folder, placed=False)
    lines = plan_of(positions.asset_measures(assets, rules.risk_config(spark))).splitlines()
    join = next(i for i, line in enumerate(lines) if "BroadcastHashJoin" in line)
    assert any("Exchange hashpartitioning(asset_type" in line for line in lines[join:])


@pytest.mark.parametrize("name", ["npl_by_branch", "npl_top5", "fused_branch_measures", "branch_report"])
def test_rows_are_summed_before_the_lookup(spark, star_folder, setting, name):
    query = REGISTERED[name]
    expected = sorted(query(spark, star_folder).collect())
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    summed = query(spark, star_folder)
    plan = plan_of(summed)
    join = plan.index("SortMergeJoin [site")
    assert plan.index("HashAggregate(keys=[site", join) > join
    assert sorted(summed.collect()) == expected


@pytest.mark.parametrize("name", sorted(set(REGISTERED) - set(queries.STORING)))
def test_no_job_runs_while_a_query_is_built(spark, star_folder, name):
    spark.sparkContext.setJobGroup(f"build {name}", "")
    try:
        REGISTERED[name](spark, star_folder)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup(f"build {name}")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize(
    "name, table",
    [(q, "events") for q in ("latest_benchmarks", "bank_vs_benchmark", "benchmark_delta", "scorecard")]
    + [("latest_run_balances", "lineitem")],
)
def test_latest_is_found_in_one_read(spark, star_folder, name, table):
    assert scans(REGISTERED[name](spark, star_folder), table) == 1


def test_the_day_of_a_benchmark_reaches_the_scan(spark, star_folder, setting):
    setting("spark.sql.maxMetadataStringLength", "1000")
    plan = plan_of(REGISTERED["benchmark_one_period"](spark, star_folder))
    assert "GreaterThanOrEqual(ts,2024-01-15" in plan and "LessThan(ts,2024-01-16" in plan


def test_fused_bank_ratios_and_null_keys_join_no_rows(spark, star_folder):
    assert scans(REGISTERED["fused_bank_ratios"](spark, star_folder), "supplier") == 0
    plan = plan_of(REGISTERED["null_keys"](spark, star_folder))
    assert plan.index("HashAggregate(keys=[site", plan.index("Join")) > 0


def test_lookup_is_broadcast_only_under_the_threshold(spark, star_folder, setting):
    assert "BroadcastHashJoin" in plan_of(ratios.npl_by_branch(star.assets(spark, star_folder)))
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = plan_of(ratios.npl_by_branch(star.assets(spark, star_folder)))
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def rows_of_tasks(df):
    """Rows of each partition after the last join."""
    return sorted((r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()), reverse=True)


def test_a_hot_day_of_a_branch_is_dealt_to_several_tasks(spark, setting):
    """Without adaptive execution and without a broadcast."""
    setting("spark.sql.adaptive.enabled", "false")
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = synthetic.liabilities(spark, 4000, 1).withColumn("maturity_days", F.lit(7))
    rolled = funding.rolling_outflow(rows)
    assert "SortMergeJoin" in plan_of(rolled)
    tasks = rows_of_tasks(rolled)
    assert sum(tasks) == 4000 and len(tasks) >= 4 and tasks[0] < 2500
    assert rolled.select("rolling_30d_outflow").distinct().count() == 1


def test_a_hot_supplier_comes_to_its_join_as_sums(spark, tmp_path, setting):
    setting("spark.sql.adaptive.enabled", "false")
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.range(0, 6000, 1, 6).select(
        F.col("id").alias("l_orderkey"), (F.col("id") % 70).alias("l_partkey"), F.lit(3).cast("long").alias("l_suppkey"),
        F.lit(1).alias("l_linenumber"), F.lit(2.5).alias("l_extendedprice"), F.lit("R").alias("l_returnflag"),
        F.lit("F").alias("l_linestatus"), F.lit("1998-01-01").cast("timestamp_ntz").alias("l_shipdate"),
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.range(5).select(F.col("id").alias("s_suppkey"), F.lit(4).alias("s_nationkey")).write.parquet(str(tmp_path / "supplier.parquet"))
    placed = star.asset_positions(spark, str(tmp_path), "loan_status")
    # One row for each supplier and trait, whatever the number of line items.
    assert placed.count() == 2 and placed.agg(F.sum("positions")).first()[0] == 6000
    assert REGISTERED["npl_by_branch"](spark, str(tmp_path)).collect()[0].branch_id == "4"


def split_hot_partitions(setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "32KB")
    setting("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    setting("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16KB")


def test_a_hot_lookup_key_is_split(spark, tmp_path, setting):
    """A third of all orders from one customer, with a lookup too large to broadcast."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 997).cast("long")
    spark.range(0, 120_000, 1, 6).select(
        key.alias("o_custkey"),
        F.col("id").alias("o_orderkey"),
        (F.col("id") % 1000 / 4).alias("o_totalprice"),
        F.lit("2-HIGH").alias("o_orderpriority"),
        F.date_add(F.lit("1998-01-01").cast("date"), (F.col("id") % 90).cast("int"))
        .cast("timestamp_ntz")
        .alias("o_orderdate"),
    ).write.parquet(str(tmp_path / "orders.parquet"))
    spark.range(997).select(
        F.col("id").alias("c_custkey"), (F.col("id") % 25).cast("int").alias("c_nationkey")
    ).write.parquet(str(tmp_path / "customer.parquet"))
    query = REGISTERED["rolling_ladder"]
    expected = sorted(query(spark, str(tmp_path)).collect())
    split_hot_partitions(setting)
    split = query(spark, str(tmp_path))
    assert sorted(split.collect()) == expected
    assert "skew=true" in plan_of(split)


def test_a_hot_branch_reaches_the_window_as_a_ladder(spark):
    """The window sorts one row per day, however many rows a branch has."""
    rows = synthetic.liabilities(spark, 20_000, 1)
    plan = plan_of(funding.rolling_outflow(funding.with_maturity(rows)))
    window = plan[plan.index("Window [") :]
    assert "HashAggregate" in window[: window.index(" Range (")]


def direct_window(rows):
    ahead = Window.partitionBy("branch_id").orderBy("maturity_days").rangeBetween(0, 30)
    outflow = F.col("balance") * F.col("outflow_rate")
    return rows.withColumn("projected_outflow", outflow).withColumn(
        "rolling_30d_outflow", F.sum("projected_outflow").over(ahead)
    )


@pytest.mark.parametrize("stored", [False, True])
def test_ladder_equals_the_direct_window(spark, stored):
    rows = funding.with_maturity(synthetic.liabilities(spark, 5000, 7)).withColumns(
        {
            "branch_id": F.when(F.rand(1) > 0.05, F.col("branch_id")),
            "maturity_days": F.when(F.rand(2) > 0.05, F.col("maturity_days")),
            "balance": F.when(F.rand(3) > 0.05, F.col("balance")),
        }
    )
    names = ["liability_id", "projected_outflow", "rolling_30d_outflow"]
    rows = rows.checkpoint()
    kept = funding.rolling_ladder(funding.outflow_ladder(rows)).checkpoint() if stored else None
    ladder = funding.rolling_outflow(rows, ladder=kept).select(*names)
    direct = direct_window(rows).select(*names)
    assert ladder.count() == 5000
    assert sorted(ladder.collect(), key=repr) == sorted(direct.collect(), key=repr)


@pytest.fixture(scope="module")
def patchy_assets(spark):
    """Assets with NULLs and types without a rule, one branch holding a third."""
    rows = synthetic.assets(spark, 6000, 9, seed=5)
    return rows.withColumns(
        {
            "branch_id": F.when(F.rand(9) < 1 / 3, F.lit("hot")).otherwise(F.col("branch_id")),
            "asset_type": F.when(F.rand(1) < 0.05, F.lit("Crypto")).when(F.rand(2) > 0.05, F.col("asset_type")),
            "balance": F.when(F.rand(3) > 0.05, F.col("balance")),
            "hqla_level": F.when(F.rand(4) > 0.05, F.col("hqla_level")),
            "loan_status": F.when(F.rand(5) > 0.05, F.col("loan_status")),
        }
    )


def test_fused_measures_equal_the_single_queries(spark, patchy_assets):
    config = rules.risk_config(spark)
    fused = {r.branch_id: r for r in ratios.branch_measures(patchy_assets, config).collect()}
    single = {r.branch_id: r for r in ratios.npl_by_branch(patchy_assets).collect()}
    assert set(single) == {branch for branch, row in fused.items() if row.loans > 0}
    for branch, row in single.items():
        assert (row.total_loan_balance, row.npl_balance, row.npl_ratio_percent) == (
            fused[branch].total_loan_balance,
            fused[branch].npl_balance,
            fused[branch].npl_ratio_percent,
        )
    per_row = positions.with_hqla(positions.with_rwa(patchy_assets, config)).agg(
        F.sum("risk_weighted_balance"), F.sum("hqla_value")
    )
    bank = positions.asset_measures(patchy_assets, config).first()
    assert per_row.first()[:] == (bank.total_rwa, bank.total_hqla)
    rolled = positions.roll_up(ratios.branch_measures(patchy_assets, config)).first()
    assert all(rolled[name] == bank[name] for name in rolled.asDict())


def test_results_do_not_depend_on_partitions(spark, patchy_assets):
    config = rules.risk_config(spark)
    once = ratios.branch_measures(patchy_assets.coalesce(1), config).collect()
    again = ratios.branch_measures(patchy_assets.coalesce(1).repartition(13), config).collect()
    assert sorted(once, key=repr) == sorted(again, key=repr)


def test_latest_run_of_a_stored_table_reads_one_partition(spark, tmp_path):
    spark.sql(f"CREATE DATABASE pruned LOCATION '{tmp_path}/pruned'")
    tables.create_tables(spark, "pruned")
    wide = spark.createDataFrame([(1.0, 2.0, 3.0)], "CAR DOUBLE, LCR DOUBLE, NPL DOUBLE")
    for month in (1, 2, 3):
        tables.append_metrics(history.snapshot(wide, f"r{month}", dt.datetime(2024, month, 1)), "pruned")
    latest = ranking.latest_run(spark.table("pruned.regulatory_metrics"))
    assert {(r.run_id, r.metric_value) for r in latest.collect()} == {("r3", D(1)), ("r3", D(2)), ("r3", D(3))}
    assert re.search(r"PartitionFilters: \[isnotnull\(run_id#\d+\), \(run_id#\d+ = Subquery", plan_of(latest))
    spark.sql("DROP DATABASE pruned CASCADE")


def test_history_can_be_taken_from_the_wide_or_the_stored_form(spark, star_folder):
    wide = history.runs(
        star.assets(spark, star_folder, placed=False),
        star.liabilities(spark, star_folder, placed=False),
        star.capital(spark, star_folder),
        rules.risk_config(spark),
    )
    from_wide = history.run_metrics(history.newest_run(wide)).collect()
    from_rows = ranking.latest_run(history.run_metrics(wide)).collect()
    assert sorted(from_wide) == sorted(from_rows)


def test_reports_prune_a_stored_history(spark, star_folder, tmp_path):
    metrics = reports.stored_runs(REGISTERED["metric_history"](spark, star_folder), str(tmp_path))
    latest = reports.report(spark, "latest_run", metrics=metrics)
    newest = max(r["run_id"] for r in metrics.select("run_id").distinct().collect())
    assert latest.count() == metrics.where(F.col("run_id") == newest).count() > 0
    plan = plan_of(latest)
    assert re.search(r"PartitionFilters: \[isnotnull\(run_id#\d+\), \(run_id#\d+ = .*Subquery", plan)
    one = reports.report(spark, "one_run", {"run_id": "1997"}, metrics=metrics)
    assert "(run_id" in plan_of(one).split("PartitionFilters")[1] and one.count() == 3
    some = reports.report(spark, "history", {"metric": "CAR", "first": "1996", "last": "1998"}, metrics=metrics)
    assert sorted(r["run_id"] for r in some.collect()) == ["1996", "1997", "1998"]
    with pytest.raises(Exception, match="UNBOUND_SQL_PARAMETER|parameter"):
        reports.report(spark, "one_run", metrics=metrics).collect()


def test_a_stored_ladder_meets_the_rows_without_a_shuffle(spark, tmp_path):
    amounts = [(f"L{i}", f"B{i % 3}" if i % 7 else None, "x", D(i), D("0.40"), i % 60 if i % 11 else None) for i in range(900)]
    kind = "liability_id STRING, branch_id STRING, liability_type STRING, balance DECIMAL(18,2), outflow_rate DECIMAL(5,2), maturity_days INT"
    rows = spark.createDataFrame(amounts, kind)
    rolling = funding.rolling_ladder(funding.outflow_ladder(rows))
    funding.branch_ladders(rolling).write.parquet(f"{tmp_path}/ladders")
    rows.write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    found = funding.with_rolling(rows, spark.read.parquet(f"{tmp_path}/ladders"))
    plan = plan_of(found)
    expected = funding.rolling_outflow(rows)
    assert found.columns == expected.columns and sorted(found.collect(), key=repr) == sorted(expected.collect(), key=repr)
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and plan.count("/rows]") == 1


def test_a_line_of_json_is_parsed_once(spark, star_folder):
    plan = plan_of(REGISTERED["envelope_averages"](spark, star_folder))
    assert plan.count("from_json(") == 1
