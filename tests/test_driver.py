import importlib

import pytest

import __spark_entry__ as driver
from bankmetrics.functions import rules


def test_entry_is_the_scorecard(spark):
    rows = {row.metric_name: row for row in driver.entry(spark).collect()}
    assert set(rows) == {"CAR", "LCR", "NPL"}
    assert all(row["status"] in ("Above Benchmark", "Not Above Benchmark") for row in rows.values())


def test_a_missing_package_costs_the_corpus_queries_alone(monkeypatch):
    def missing(name):
        raise ModuleNotFoundError(f"No module named '{name}'", name=absent)

    monkeypatch.setattr(importlib.util, "find_spec", lambda place: object())
    monkeypatch.setattr(importlib, "import_module", missing)
    absent = "tokenizers"
    assert "car" in driver.queries() and "car" in driver.oracle_sql() and "pipeline" not in driver.queries()
    absent = "bankmetrics.llm.jaccard"
    with pytest.raises(ModuleNotFoundError):
        driver.queries()


def test_a_long_list_of_rules_carries_no_hint(spark):
    hinted = lambda rows: "UnresolvedHint" in rows._jdf.queryExecution().logical().toString()
    long = [(f"type {i}", "0.50") for i in range(rules.MOST_RULES + 1)]
    assert hinted(rules.risk_config(spark)) and hinted(rules.risk_config(spark, iter(long[:-1])))
    assert not hinted(rules.risk_config(spark, long))
