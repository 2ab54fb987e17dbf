"""Table schemas as DDL strings, usable in ``spark.read.schema(...)``.

Money is DECIMAL(18,2) and rates are DECIMAL(5,2) everywhere, so sums are exact
and do not depend on how the data is partitioned.
"""

MONEY = "DECIMAL(18,2)"
RATE = "DECIMAL(5,2)"
STORED_METRIC = "DECIMAL(10,4)"

BRANCHES = "branch_id STRING, branch_name STRING, region STRING"

ASSETS = (
    f"asset_id STRING, branch_id STRING, asset_type STRING, balance {MONEY}, "
    f"risk_weight {RATE}, hqla_level STRING, loan_status STRING"
)

LIABILITIES = (
    f"liability_id STRING, branch_id STRING, liability_type STRING, "
    f"balance {MONEY}, outflow_rate {RATE}"
)

CAPITAL = f"capital_id STRING, capital_type STRING, balance {MONEY}"

STAGED_METRIC = "metric_name STRING, metric_value DOUBLE"

LIABILITIES_WITH_MATURITY = f"{LIABILITIES}, maturity_days INT"

# Fields arrive as JSON numbers or as quoted numbers, so they are read as text
# and then given the types of FINANCIALS: with a numeric type in the envelope,
# one quoted number would turn the whole document into NULL.
FINANCIALS_ENVELOPE = (
    "data ARRAY<STRUCT<data: STRUCT<REPDTE: STRING, CERT: STRING, NAME: STRING, EQVWCOR: STRING, ASSET: STRING>>>"
)
FINANCIALS = {"REPDTE": "string", "CERT": "bigint", "NAME": "string", "EQVWCOR": "double", "ASSET": "double"}

INPUTS = {
    "branches": BRANCHES,
    "assets": ASSETS,
    "liabilities": LIABILITIES,
    "capital": CAPITAL,
}

# Columns that identify a row and therefore must not be NULL. File sources
# read every column back as nullable, so this is checked by a query
# (operators.checks.null_keys), not by the schema.
REQUIRED = {
    "branches": ("branch_id",),
    "assets": ("asset_id", "branch_id"),
    "liabilities": ("liability_id", "branch_id"),
    "capital": ("capital_id",),
}
