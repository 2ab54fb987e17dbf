"""Column limits of whole tables, and duplicate keys by a screen of hashes."""

import random
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from bankmetrics.operators import checks, keys, limits
from bankmetrics.sinks import tables, work


def test_columns_of_a_definition():
    assert limits.columns_of(tables.COLUMNS[tables.METRICS]) == {
        "run_id": "VARCHAR(50)",
        "metric_name": "VARCHAR(50)",
        "metric_value": "DECIMAL(10,4)",
        "computation_date": "TIMESTAMP",
    }
    assert limits.columns_of("a INT NOT NULL, b DECIMAL(3, 1) DEFAULT 1") == {"a": "INT NOT NULL", "b": "DECIMAL(3, 1)"}


def test_every_value_over_a_limit_is_found(spark):
    rows = [("k1", "short", "12.34", 7), ("k2", "far too long", "999.96", None), (None, None, "x", 1), ("k4", "é" * 6, None, 300)]
    table = spark.createDataFrame(rows, "id STRING, name STRING, amount STRING, small INT")
    wanted = {"id": "STRING NOT NULL", "name": "VARCHAR(6)", "amount": "DECIMAL(4,1)", "small": "TINYINT NOT NULL"}
    found = limits.over_limits(table, wanted, "id")
    assert found.columns == ["id", "column_name", "value", "column_limit"]
    assert {tuple(r) for r in found.collect()} == {
        ("k2", "name", "far too long", "VARCHAR(6)"),
        ("k2", "amount", "999.96", "DECIMAL(4,1)"),  # rounds to 1000.0
        ("k2", "small", None, "TINYINT NOT NULL"),
        (None, "id", None, "STRING NOT NULL"),
        (None, "amount", "x", "DECIMAL(4,1)"),
        ("k4", "small", "300", "TINYINT NOT NULL"),
    }
    assert limits.over_limits(table.limit(0), wanted, "id").count() == 0
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()


def test_all_violations_of_a_result_table(spark):
    rows = [("x" * 51, "CAR", D("1")), ("r", "m" * 60, D("1234567")), ("r", "NPL", D("1"))]
    table = spark.createDataFrame(rows, "run_id STRING, metric_name STRING, metric_value DECIMAL(20,2)")
    found = {(r["run_id"], r["column_name"]) for r in tables.violations(table, tables.METRICS).collect()}
    assert found == {("x" * 51, "run_id"), ("r", "metric_name"), ("r", "metric_value")}


def hot(draw, rows):
    """A third of all rows on one key, some NULL parts, some keys twice."""
    return [
        (1, "hot") if draw.random() < 1 / 3 else (draw.choice([None, draw.randrange(rows * 3)]), draw.choice(["a", "b", None, "é"]))
        for _ in range(rows)
    ]


@pytest.mark.parametrize("held", [None, 50])
@pytest.mark.parametrize("rows, parts", [(0, 1), (1, 1), (3000, 7), (40_000, 3)])
def test_the_screen_changes_nothing(spark, rows, parts, held, monkeypatch):
    if held:
        monkeypatch.setattr(keys, "HELD", held)
    table = spark.createDataFrame(hot(random.Random(rows), rows), "k BIGINT, s STRING").repartition(parts)
    found = keys.screened_duplicate_keys(table, "k", "s")
    plain = checks.duplicate_keys(table, "k", "s")
    assert found.columns == plain.columns and sorted(found.collect(), key=repr) == sorted(plain.collect(), key=repr)


def test_only_repeated_keys_reach_the_count(spark):
    table = spark.range(200_000).select((F.col("id") % 199_990).cast("string").alias("id"))
    marks = keys.repeated_marks(table, "id")
    assert marks.count() == marks.distinct().count() == 10
    sent = table.select(keys.key_mark("id").alias("mark"))
    assert sent.agg(F.max("mark") < F.lit(1 << 48), F.min("mark") >= 0).first()[:] == (True, True)
    found = keys.screened_duplicate_keys(table, "id")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and found.agg(F.count("*"), F.sum("copies")).first()[:] == (10, 20)


def test_hashes_that_meet_by_chance_are_left_out(spark, monkeypatch):
    monkeypatch.setattr(keys, "key_mark", lambda *names: F.pmod(F.xxhash64(*names), F.lit(97)))
    table = spark.range(1000).select((F.col("id") % 990).alias("id"))
    assert keys.repeated_marks(table, "id").count() == 97
    assert {tuple(r) for r in keys.screened_duplicate_keys(table, "id").collect()} == {(i, 2) for i in range(10)}


def test_work_folders(spark, tmp_path):
    folder = work.work_folder(spark, "some")
    table = work.kept(spark.range(3).toDF("n"), folder, "n")
    assert table.count() == 3 and [p.rsplit("/", 1)[1] for p in work.subfolders(spark, folder)] == ["n"]
    assert work.removed(spark, f"{folder}/n") and not work.removed(spark, f"{folder}/n")


def test_a_cluster_needs_a_shared_folder():
    class Session:
        class conf:
            get = staticmethod(lambda name, default=None: {"spark.sql.warehouse.dir": "file:/opt/warehouse"}.get(name, default))

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(work.NoSharedFolder):
        work.shared_folder(Session)
    Session.sparkContext.master = "local[4]"  # one machine: its own disk is shared
    assert work.shared_folder(Session) == "file:/opt/warehouse/_work"
    Session.conf.get = staticmethod(lambda name, default=None: {"spark.checkpoint.dir": "hdfs://n/c/"}.get(name, default))
    assert work.shared_folder(Session) == "hdfs://n/c"
