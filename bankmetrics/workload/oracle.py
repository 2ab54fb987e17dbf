"""The registered queries as plain SQL, for a second engine on the same tables.

Written from the definitions, row by row: rule weights are joined to the rows,
the rolling window runs on the rows, and nothing is pre-aggregated.
"""

from __future__ import annotations

# Fixed values within: the risk weights, HQLA factors and outflow rates of bankmetrics/functions/rules.py, written out
# again so that the two sides share nothing.
VIEWS = {
    "risk_config": """
        SELECT * FROM (VALUES
            ('Cash', 0.00), ('Government Bonds', 0.00), ('Corporate Bonds', 0.50),
            ('Residential Mortgage', 0.35), ('Commercial Real Estate', 1.00),
            ('Corporate Loan', 1.00), ('Consumer Loan', 0.75)
        ) AS t(asset_type, rule_weight)""",
    "short_config": "SELECT * FROM risk_config WHERE asset_type <> 'Consumer Loan'",
    "assets": """
        SELECT l_orderkey || '-' || l_linenumber AS asset_id,
               CAST(s_nationkey AS VARCHAR) AS branch_id,
               CASE l_partkey % 7 WHEN 0 THEN 'Cash' WHEN 1 THEN 'Government Bonds'
                    WHEN 2 THEN 'Corporate Bonds' WHEN 3 THEN 'Residential Mortgage'
                    WHEN 4 THEN 'Commercial Real Estate' WHEN 5 THEN 'Corporate Loan'
                    WHEN 6 THEN 'Consumer Loan' END AS asset_type,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS balance,
               CAST(CASE l_partkey % 7 WHEN 0 THEN 0.00 WHEN 1 THEN 0.00 WHEN 2 THEN 0.50 WHEN 3 THEN 0.35
                    WHEN 4 THEN 1.00 WHEN 5 THEN 1.00 WHEN 6 THEN 0.75 END AS DECIMAL(5,2)) AS risk_weight,
               CASE WHEN l_partkey % 7 IN (0, 1) THEN 'Level 1' WHEN l_partkey % 7 = 2 THEN 'Level 2A'
                    WHEN l_partkey % 7 IN (3, 4, 5, 6) THEN 'Non-HQLA' END AS hqla_level,
               CASE WHEN l_partkey % 7 NOT IN (3, 5, 6) THEN 'N/A'
                    WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'Non-Performing'
                    ELSE 'Performing' END AS loan_status,
               CAST(year(l_shipdate) AS VARCHAR) AS run_id,
               CAST(l_shipdate AS DATE) AS as_of
        FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey""",
    "liabilities": """
        SELECT CAST(o_orderkey AS VARCHAR) AS liability_id,
               CAST(c_nationkey AS VARCHAR) AS branch_id,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'Wholesale Funding' WHEN '2-HIGH' THEN 'Corporate Deposit'
                    WHEN '3-MEDIUM' THEN 'Retail Savings' ELSE 'Retail Checking' END AS liability_type,
               CAST(o_totalprice AS DECIMAL(18,2)) AS balance,
               CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 1.00 WHEN '2-HIGH' THEN 0.40
                    ELSE 0.05 END AS DECIMAL(5,2)) AS outflow_rate,
               CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 60 AS INTEGER) AS maturity_days,
               o_orderdate AS due_date,
               CAST(year(o_orderdate) AS VARCHAR) AS run_id,
               CAST(o_orderdate AS DATE) AS as_of
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
    "capital": """
        SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN 'Tier 1 Capital' ELSE 'Tier 2 Capital' END AS capital_type,
               CAST(c_acctbal AS DECIMAL(18,2)) AS balance
        FROM customer""",
    "financials": """
        SELECT strftime(ts, '%Y%m%d') AS report_period, user_id AS cert, value AS asset_size,
               TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS eqvwcor
        FROM events WHERE event_type = 'purchase' AND value >= 10""",
    "hashed": """
        SELECT liability_id, balance, outflow_rate, CAST(CAST('0x' || substr(md5(
            '7|maturity|' || coalesce(liability_id, '')), 1, 15) AS BIGINT) % 60 AS INTEGER) AS maturity_days
        FROM liabilities""",
    "liability_text": """
        SELECT liability_id, liability_type,
               CASE WHEN CAST(liability_id AS BIGINT) % 10 = 3 THEN 'n/a' WHEN CAST(liability_id AS BIGINT) % 10 = 4 THEN ''
                    ELSE CAST(balance AS VARCHAR) END AS balance,
               CASE WHEN CAST(liability_id AS BIGINT) % 7 = 2 THEN '1000.00' ELSE CAST(outflow_rate AS VARCHAR) END
                    AS outflow_rate
        FROM liabilities""",
    "tried": """
        SELECT *, TRY_CAST(balance AS DECIMAL(18,2)) AS amount, TRY_CAST(outflow_rate AS DECIMAL(5,2)) AS rate,
               concat_ws(',', liability_id, liability_type, balance, outflow_rate) AS line,
               concat_ws('; ', CASE WHEN balance IS NOT NULL AND TRY_CAST(balance AS DECIMAL(18,2)) IS NULL
                       THEN 'balance: ' || balance || ' is no DECIMAL(18,2)' END,
                   CASE WHEN outflow_rate IS NOT NULL AND TRY_CAST(outflow_rate AS DECIMAL(5,2)) IS NULL
                       THEN 'outflow_rate: ' || outflow_rate || ' is no DECIMAL(5,2)' END) AS reasons
        FROM liability_text""",
    "whole_lines": """
        SELECT event_type, '{"data":[{"data":' || replace(left(p, length(p) - 1), '"k"', '"EQVWCOR"') || ',"REPDTE":'
               || coalesce('"' || strftime(ts, '%Y%m%d') || '"', 'null') || ',"CERT":'
               || coalesce(CAST(user_id AS VARCHAR), 'null') || ',"ASSET":'
               || coalesce(CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR), 'null') || '}},{"data":null},null]}' AS line
        FROM (SELECT *, coalesce(props, '{"j": 0}') AS p FROM events WHERE event_type IN ('purchase', 'view'))""",
    "lines": """
        SELECT CASE event_type WHEN 'purchase' THEN line ELSE left(line, length(line) - 2) END AS line FROM whole_lines""",
    "averages": """
        SELECT report_period, round(CAST(coalesce(avg(eqvwcor), 0.0) AS DECIMAL(18,9)), 2) AS car,
               count(eqvwcor) AS institutions
        FROM financials GROUP BY report_period""",
    "benchmarks": """
        SELECT report_period, 'CAR' AS metric_name, CAST(car AS DECIMAL(10,4)) AS industry_average FROM averages
        UNION ALL SELECT report_period, 'LCR', CAST(100.00 AS DECIMAL(10,4)) FROM averages
        UNION ALL SELECT report_period, 'NPL', CAST(1.50 AS DECIMAL(10,4)) FROM averages""",
    "last_benchmarks": """
        SELECT metric_name, industry_average FROM benchmarks
        WHERE report_period = (SELECT max(report_period) FROM benchmarks)""",
    "tier1": "SELECT sum(balance) AS tier1_capital FROM capital WHERE capital_type = 'Tier 1 Capital'",
    "bank": """
        SELECT sum(balance * rule_weight) AS total_rwa,
               sum(CASE hqla_level WHEN 'Level 1' THEN balance WHEN 'Level 2A' THEN balance * 0.85 ELSE 0 END)
                   AS total_hqla,
               sum(CASE WHEN loan_status <> 'N/A' THEN balance END) AS total_loan_balance,
               sum(CASE WHEN loan_status <> 'N/A' THEN
                   CASE loan_status WHEN 'Non-Performing' THEN balance ELSE 0 END END) AS npl_balance,
               count(CASE WHEN loan_status <> 'N/A' THEN 1 END) AS loans
        FROM assets LEFT JOIN risk_config USING (asset_type)""",
    "funding": """
        SELECT sum(balance * outflow_rate) AS net_outflow FROM liabilities WHERE maturity_days <= 30""",
    "ratios": """
        SELECT bank.*, net_outflow, tier1_capital,
               CAST(tier1_capital AS DOUBLE) / CAST(total_rwa AS DOUBLE) * 100 AS car,
               CAST(total_hqla AS DOUBLE) / CAST(net_outflow AS DOUBLE) * 100 AS lcr,
               round(CAST(CAST(npl_balance AS DOUBLE) / CAST(total_loan_balance AS DOUBLE) * 100
                   AS DECIMAL(18,9)), 2) AS npl
        FROM bank CROSS JOIN funding CROSS JOIN tier1""",
    "current_run": """
        SELECT 'CAR' AS metric_name, CAST(car AS DECIMAL(10,4)) AS metric_value FROM ratios
        UNION ALL SELECT 'LCR', CAST(lcr AS DECIMAL(10,4)) FROM ratios
        UNION ALL SELECT 'NPL', CAST(npl AS DECIMAL(10,4)) FROM ratios""",
    "year_assets": """
        SELECT run_id, max(as_of) AS asset_date, sum(balance * rule_weight) AS total_rwa,
               sum(CASE hqla_level WHEN 'Level 1' THEN balance WHEN 'Level 2A' THEN balance * 0.85 ELSE 0 END)
                   AS total_hqla,
               sum(CASE WHEN loan_status <> 'N/A' THEN balance END) AS total_loan_balance,
               sum(CASE loan_status WHEN 'Non-Performing' THEN balance ELSE 0 END) AS npl_balance
        FROM assets LEFT JOIN risk_config USING (asset_type) GROUP BY run_id""",
    "year_funding": """
        SELECT run_id, max(as_of) AS funding_date,
               sum(CASE WHEN maturity_days <= 30 THEN balance * outflow_rate END) AS net_outflow
        FROM liabilities GROUP BY run_id""",
    "years": """
        SELECT coalesce(a.run_id, f.run_id) AS run_id, greatest(asset_date, funding_date) AS computation_date,
               CAST(tier1_capital AS DOUBLE) / nullif(CAST(total_rwa AS DOUBLE), 0) * 100 AS car,
               CAST(total_hqla AS DOUBLE) / nullif(CAST(net_outflow AS DOUBLE), 0) * 100 AS lcr,
               round(CAST(CAST(npl_balance AS DOUBLE) / nullif(CAST(total_loan_balance AS DOUBLE), 0) * 100
                   AS DECIMAL(18,9)), 2) AS npl
        FROM year_assets a FULL JOIN year_funding f ON a.run_id IS NOT DISTINCT FROM f.run_id CROSS JOIN tier1""",
    "history": """
        SELECT * FROM (
            SELECT run_id, computation_date, 'CAR' AS metric_name, CAST(car AS DECIMAL(10,4)) AS metric_value
            FROM years
            UNION ALL SELECT run_id, computation_date, 'LCR', CAST(lcr AS DECIMAL(10,4)) FROM years
            UNION ALL SELECT run_id, computation_date, 'NPL', CAST(npl AS DECIMAL(10,4)) FROM years
        ) WHERE metric_value IS NOT NULL""",
    "last_run": """
        SELECT metric_name, metric_value FROM history
        WHERE run_id = (SELECT run_id FROM history ORDER BY computation_date DESC NULLS LAST, run_id DESC LIMIT 1)""",
    "compared": """
        SELECT metric_name, metric_value AS bank_metric, industry_average AS benchmark
        FROM last_run JOIN last_benchmarks USING (metric_name)""",
    "npl_branches": """
        SELECT branch_id, sum(balance) AS total_loan_balance,
               sum(CASE loan_status WHEN 'Non-Performing' THEN balance ELSE 0 END) AS npl_balance
        FROM assets WHERE loan_status <> 'N/A' GROUP BY branch_id""",
    "branch_loans": """
        SELECT branch_id, sum(CASE WHEN loan_status <> 'N/A' THEN balance END) AS total_loan_balance,
               sum(CASE WHEN loan_status <> 'N/A' THEN
                   CASE loan_status WHEN 'Non-Performing' THEN balance ELSE 0 END END) AS npl_balance
        FROM assets GROUP BY branch_id""",
}

# Views each view reads, so that a query carries only the ones it needs.
NEEDS = {
    "short_config": ["risk_config"],
    "averages": ["financials"],
    "hashed": ["liabilities"],
    "liability_text": ["liabilities"],
    "tried": ["liability_text"],
    "lines": ["whole_lines"],
    "benchmarks": ["averages"],
    "last_benchmarks": ["benchmarks"],
    "tier1": ["capital"],
    "bank": ["assets", "risk_config"],
    "funding": ["liabilities"],
    "ratios": ["bank", "funding", "tier1"],
    "current_run": ["ratios"],
    "year_assets": ["assets", "risk_config"],
    "year_funding": ["liabilities"],
    "years": ["year_assets", "year_funding", "tier1"],
    "history": ["years"],
    "last_run": ["history"],
    "compared": ["last_run", "last_benchmarks"],
    "npl_branches": ["assets"],
    "branch_loans": ["assets"],
}

NPL_RATIO = """round(CAST(CAST(npl_balance AS DOUBLE) / nullif(CAST(total_loan_balance AS DOUBLE), 0) * 100
                   AS DECIMAL(18,9)), 2)"""
NPL_COLUMNS = f"""CAST(total_loan_balance AS DOUBLE) AS total_loan_balance,
       CAST(npl_balance AS DOUBLE) AS npl_balance, CAST({NPL_RATIO} AS DOUBLE) AS npl_ratio_percent"""
DELTA_COLUMNS = """CAST(bank_metric AS DOUBLE) AS bank_metric, CAST(benchmark AS DOUBLE) AS benchmark,
       CAST(bank_metric - benchmark AS DOUBLE) AS delta,
       CASE WHEN bank_metric > benchmark THEN 'Above Benchmark' ELSE 'Not Above Benchmark' END AS status"""
CAR_COLUMNS = """CAST(total_rwa AS DOUBLE) AS total_rwa, CAST(tier1_capital AS DOUBLE) AS tier1_capital,
       round(CAST(tier1_capital AS DOUBLE) / CAST(total_rwa AS DOUBLE) * 100, 6) AS "CAR\""""

AUDITED = "CAST(max(CASE WHEN metric_name = '{}' THEN metric_value END) AS VARCHAR)"

# Query name: views it reads, then its text.
QUERIES = {
    "npl_by_branch": (["npl_branches"], f"SELECT branch_id, {NPL_COLUMNS} FROM npl_branches"),
    "npl_bank": (
        ["npl_branches"],
        f"""SELECT {NPL_COLUMNS}, 1 AS entity FROM (
            SELECT sum(total_loan_balance) AS total_loan_balance, sum(npl_balance) AS npl_balance
            FROM npl_branches)""",
    ),
    "npl_top5": (
        ["npl_branches"],
        f"""SELECT branch_id, {NPL_COLUMNS} FROM npl_branches
        ORDER BY {NPL_RATIO} DESC NULLS LAST, branch_id NULLS LAST LIMIT 5""",
    ),
    "asset_rwa": (
        ["assets", "risk_config"],
        """SELECT asset_id, asset_type, CAST(balance AS DOUBLE) AS balance,
               CAST(rule_weight AS DOUBLE) AS rule_weight,
               CAST(balance * rule_weight AS DOUBLE) AS risk_weighted_balance
        FROM assets LEFT JOIN risk_config USING (asset_type)""",
    ),
    "rwa_by_type": (
        ["assets", "risk_config"],
        """SELECT asset_type, CAST(sum(balance) AS DOUBLE) AS balance, count(*) AS positions,
               CAST(max(rule_weight) AS DOUBLE) AS rule_weight,
               CAST(sum(balance * rule_weight) AS DOUBLE) AS risk_weighted_balance
        FROM assets LEFT JOIN risk_config USING (asset_type) GROUP BY asset_type""",
    ),
    "rwa_own_weight": (["assets"], "SELECT CAST(sum(balance * risk_weight) AS DOUBLE) AS total_rwa FROM assets"),
    "tier1_capital": (["tier1"], "SELECT CAST(tier1_capital AS DOUBLE) AS tier1_capital FROM tier1"),
    "car": (
        ["assets", "risk_config", "tier1"],
        f"""SELECT {CAR_COLUMNS} FROM (
            SELECT sum(balance * rule_weight) AS total_rwa
            FROM assets LEFT JOIN risk_config USING (asset_type)) CROSS JOIN tier1""",
    ),
    "unmapped_types": (
        ["assets", "short_config"],
        """SELECT asset_type, CAST(sum(balance) AS DOUBLE) AS balance, count(*) AS positions FROM assets a
        WHERE NOT EXISTS (SELECT 1 FROM short_config c WHERE c.asset_type = a.asset_type) GROUP BY asset_type""",
    ),
    "car_one_type_unmapped": (
        ["assets", "short_config", "tier1"],
        f"""SELECT {CAR_COLUMNS} FROM (
            SELECT sum(balance * rule_weight) AS total_rwa
            FROM assets LEFT JOIN short_config USING (asset_type)) CROSS JOIN tier1""",
    ),
    "asset_hqla": (
        ["assets"],
        """SELECT asset_id, hqla_level, CAST(balance AS DOUBLE) AS balance,
               CAST(CASE hqla_level WHEN 'Level 1' THEN balance WHEN 'Level 2A' THEN balance * 0.85 ELSE 0 END
                   AS DOUBLE) AS hqla_value
        FROM assets""",
    ),
    "hqla_by_level": (
        ["assets"],
        """SELECT hqla_level, CAST(sum(balance) AS DOUBLE) AS balance, count(*) AS positions,
               CAST(sum(CASE hqla_level WHEN 'Level 1' THEN balance WHEN 'Level 2A' THEN balance * 0.85 ELSE 0 END)
                   AS DOUBLE) AS hqla_value
        FROM assets GROUP BY hqla_level""",
    ),
    "outflow_30d": (["funding"], "SELECT CAST(net_outflow AS DOUBLE) AS net_outflow FROM funding"),
    "lcr": (
        ["bank", "funding", "tier1", "ratios", "assets"],
        """SELECT CAST(total_hqla AS DOUBLE) AS total_hqla, CAST(net_outflow AS DOUBLE) AS net_outflow,
               round(lcr, 6) AS "LCR" FROM ratios""",
    ),
    "outflow_ladder": (
        ["liabilities"],
        """SELECT branch_id, maturity_days, CAST(sum(balance * outflow_rate) AS DOUBLE) AS projected_outflow
        FROM liabilities GROUP BY branch_id, maturity_days""",
    ),
    "rolling_ladder": (
        ["liabilities"],
        """SELECT branch_id, maturity_days, CAST(sum(outflow) AS DOUBLE) AS projected_outflow,
               CAST(any_value(rolling) AS DOUBLE) AS rolling_30d_outflow
        FROM (SELECT branch_id, maturity_days, balance * outflow_rate AS outflow,
                     sum(balance * outflow_rate) OVER (PARTITION BY branch_id ORDER BY maturity_days
                         RANGE BETWEEN CURRENT ROW AND 30 FOLLOWING) AS rolling
              FROM liabilities)
        GROUP BY branch_id, maturity_days""",
    ),
    "rolling_outflow": (
        ["liabilities"],
        """SELECT liability_id, branch_id, liability_type, CAST(balance AS DOUBLE) AS balance,
               CAST(outflow_rate AS DOUBLE) AS outflow_rate, maturity_days,
               CAST(balance * outflow_rate AS DOUBLE) AS projected_outflow,
               CAST(sum(balance * outflow_rate) OVER (PARTITION BY branch_id ORDER BY maturity_days
                   RANGE BETWEEN CURRENT ROW AND 30 FOLLOWING) AS DOUBLE) AS rolling_30d_outflow
        FROM liabilities""",
    ),
    "due_within": (
        ["liabilities"],
        """SELECT liability_id, CAST(balance AS DOUBLE) AS balance, strftime(due_date, '%Y-%m-%d') AS due_date
        FROM liabilities WHERE due_date <= TIMESTAMP '1998-01-01 00:00:00' + INTERVAL 30 DAY""",
    ),
    "fused_branch_measures": (
        ["assets", "risk_config"],
        f"""SELECT branch_id, CAST(total_rwa AS DOUBLE) AS total_rwa, CAST(total_hqla AS DOUBLE) AS total_hqla,
               loans, {NPL_COLUMNS} FROM (
            SELECT branch_id, sum(balance * rule_weight) AS total_rwa,
                   sum(CASE hqla_level WHEN 'Level 1' THEN balance WHEN 'Level 2A' THEN balance * 0.85 ELSE 0 END)
                       AS total_hqla,
                   sum(CASE WHEN loan_status <> 'N/A' THEN balance END) AS total_loan_balance,
                   sum(CASE WHEN loan_status <> 'N/A' THEN
                       CASE loan_status WHEN 'Non-Performing' THEN balance ELSE 0 END END) AS npl_balance,
                   count(CASE WHEN loan_status <> 'N/A' THEN 1 END) AS loans
            FROM assets LEFT JOIN risk_config USING (asset_type) GROUP BY branch_id)""",
    ),
    "fused_bank_ratios": (
        ["ratios"],
        """SELECT CAST(total_rwa AS DOUBLE) AS total_rwa, CAST(total_hqla AS DOUBLE) AS total_hqla,
               CAST(total_loan_balance AS DOUBLE) AS total_loan_balance, CAST(npl_balance AS DOUBLE) AS npl_balance,
               loans, CAST(net_outflow AS DOUBLE) AS net_outflow, CAST(tier1_capital AS DOUBLE) AS tier1_capital,
               round(car, 6) AS "CAR", round(lcr, 6) AS "LCR", CAST(npl AS DOUBLE) AS "NPL" FROM ratios""",
    ),
    "branch_report": (
        ["branch_loans"],
        f"""SELECT n_name AS branch_name, r_name AS region, {NPL_COLUMNS}
        FROM branch_loans LEFT JOIN nation ON branch_id = CAST(n_nationkey AS VARCHAR)
        LEFT JOIN region ON n_regionkey = r_regionkey""",
    ),
    "benchmark_avg": (
        ["averages"],
        'SELECT report_period, CAST(car AS DOUBLE) AS "CAR", institutions FROM averages',
    ),
    "benchmark_one_period": (
        ["financials"],
        """SELECT '20240115' AS report_period,
               CAST(round(CAST(coalesce(avg(eqvwcor), 0.0) AS DECIMAL(18,9)), 2) AS DOUBLE) AS "CAR",
               count(eqvwcor) AS institutions
        FROM financials WHERE report_period = '20240115'""",
    ),
    "benchmark_table": (
        ["benchmarks"],
        """SELECT report_period, '2024-02-01' AS fetched_at, metric_name,
               CAST(industry_average AS DOUBLE) AS industry_average FROM benchmarks""",
    ),
    "latest_benchmarks": (
        ["last_benchmarks"],
        "SELECT metric_name, CAST(industry_average AS DOUBLE) AS industry_average FROM last_benchmarks",
    ),
    "metric_snapshot": (
        ["current_run"],
        """SELECT 'run-0001' AS run_id, '2024-02-01' AS computation_date, metric_name,
               CAST(metric_value AS DOUBLE) AS metric_value FROM current_run""",
    ),
    "metric_history": (
        ["history"],
        """SELECT run_id, strftime(computation_date, '%Y-%m-%d') AS computation_date, metric_name,
               CAST(metric_value AS DOUBLE) AS metric_value FROM history""",
    ),
    "latest_run": (
        ["last_run"],
        "SELECT metric_name, CAST(metric_value AS DOUBLE) AS metric_value FROM last_run",
    ),
    "latest_run_balances": (
        ["assets"],
        """SELECT run_id, asset_type, CAST(sum(balance) AS DOUBLE) AS balance, count(*) AS positions FROM assets
        WHERE run_id = (SELECT run_id FROM assets ORDER BY as_of DESC NULLS LAST, run_id DESC LIMIT 1)
        GROUP BY run_id, asset_type""",
    ),
    "bank_vs_benchmark": (
        ["compared"],
        """SELECT metric_name, CAST(bank_metric AS DOUBLE) AS bank_metric,
               CAST(benchmark AS DOUBLE) AS benchmark FROM compared""",
    ),
    "benchmark_delta": (["compared"], f"SELECT metric_name, {DELTA_COLUMNS} FROM compared"),
    "scorecard": (
        ["current_run", "last_benchmarks"],
        f"""SELECT metric_name, {DELTA_COLUMNS} FROM (
            SELECT metric_name, metric_value AS bank_metric, industry_average AS benchmark
            FROM current_run JOIN last_benchmarks USING (metric_name))""",
    ),
    "duplicate_keys": (
        [],
        """SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    ),
    "null_keys": (
        ["assets"],
        """SELECT 'asset_id' AS column_name, count(*) - count(asset_id) AS null_rows FROM assets
        UNION ALL SELECT 'branch_id', count(*) - count(branch_id) FROM assets
        UNION ALL SELECT 'balance', count(*) - count(balance) FROM assets""",
    ),
    "loan_types": (
        ["assets"],
        """SELECT asset_type, count(*) AS positions, asset_type LIKE '%Loan%' OR asset_type LIKE '%Mortgage%' AS is_loan
        FROM assets GROUP BY asset_type""",
    ),
    "screened_duplicate_keys": (
        [],
        """SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    ),
    "limit_violations": (
        ["assets"],
        """SELECT asset_id, 'asset_id' AS column_name, asset_id AS value, 'VARCHAR(6) NOT NULL' AS column_limit FROM assets
        WHERE asset_id IS NULL OR length(asset_id) > 6
        UNION ALL SELECT asset_id, 'asset_type', asset_type, 'VARCHAR(14)' FROM assets WHERE length(asset_type) > 14
        UNION ALL SELECT asset_id, 'balance', CAST(balance AS VARCHAR), 'DECIMAL(6,1)' FROM assets
        WHERE balance IS NOT NULL AND abs(round(balance, 1)) >= 100000
        UNION ALL SELECT asset_id, 'loan_status', loan_status, 'VARCHAR(10)' FROM assets WHERE length(loan_status) > 10""",
    ),
    "rejected_amounts": (
        ["tried"],
        "SELECT 'liabilities' AS table_name, line, reasons FROM tried WHERE reasons <> ''",
    ),
    "accepted_outflow": (
        ["tried"],
        """SELECT liability_type, CAST(sum(amount * rate) AS DOUBLE) AS projected_outflow, count(*) AS rows
        FROM tried WHERE reasons = '' GROUP BY liability_type""",
    ),
    "envelope_averages": (
        ["lines"],
        """SELECT report_period, CAST(round(CAST(coalesce(avg(eqvwcor), 0.0) AS DECIMAL(18,9)), 2) AS DOUBLE) AS "CAR",
               count(eqvwcor) AS institutions
        FROM (SELECT json_extract_string(line, '$.data[0].data.REPDTE') AS report_period,
                  TRY_CAST(json_extract_string(line, '$.data[0].data.EQVWCOR') AS DOUBLE) AS eqvwcor,
                  TRY_CAST(json_extract_string(line, '$.data[0].data.ASSET') AS DOUBLE) AS asset_size
              FROM lines WHERE json_valid(line))
        WHERE asset_size >= 10 GROUP BY report_period""",
    ),
    "rejected_envelopes": (["lines"], "SELECT line FROM lines WHERE NOT json_valid(line)"),
    "hashed_maturity_days": (["hashed"], "SELECT liability_id, maturity_days FROM hashed"),
    "hashed_lcr": (
        ["bank", "hashed", "assets"],
        """SELECT CAST(total_hqla AS DOUBLE) AS total_hqla, CAST(net_outflow AS DOUBLE) AS net_outflow,
               round(CAST(total_hqla AS DOUBLE) / CAST(net_outflow AS DOUBLE) * 100, 6) AS "LCR"
        FROM bank CROSS JOIN (SELECT sum(balance * outflow_rate) AS net_outflow FROM hashed WHERE maturity_days <= 30)""",
    ),
    "stored_rolling_outflow": (
        ["liabilities"],
        """SELECT liability_id, branch_id, CAST(balance AS DOUBLE) AS balance, maturity_days,
               CAST(balance * outflow_rate AS DOUBLE) AS projected_outflow,
               CAST(sum(balance * outflow_rate) OVER (PARTITION BY branch_id ORDER BY maturity_days
                   RANGE BETWEEN CURRENT ROW AND 30 FOLLOWING) AS DOUBLE) AS rolling_30d_outflow
        FROM liabilities""",
    ),
    "stored_latest_run": (
        ["last_run"],
        "SELECT metric_name, CAST(metric_value AS DOUBLE) AS metric_value FROM last_run",
    ),
    "stored_latest_benchmarks": (
        ["last_benchmarks"],
        "SELECT metric_name, CAST(industry_average AS DOUBLE) AS industry_average FROM last_benchmarks",
    ),
    "stored_comparison": (
        ["compared"],
        """SELECT metric_name, CAST(bank_metric AS DOUBLE) AS bank_metric, CAST(benchmark AS DOUBLE) AS benchmark,
               CAST(bank_metric - benchmark AS DOUBLE) AS delta,
               CASE WHEN bank_metric > benchmark THEN 'Above Benchmark'
                    WHEN bank_metric <= benchmark THEN 'Not Above Benchmark' END AS status FROM compared""",
    ),
    "stored_history": (
        ["history"],
        """SELECT run_id, strftime(computation_date, '%Y-%m-%d') AS computation_date,
               CAST(metric_value AS DOUBLE) AS metric_value FROM history
        WHERE metric_name = 'NPL' AND run_id BETWEEN '1996' AND '1999'""",
    ),
    "staged_metrics": (
        ["current_run"],
        """SELECT 'run-0001' AS run_id, '2024-02-01' AS computation_date, metric_name,
               CAST(metric_value AS DOUBLE) AS metric_value FROM current_run WHERE metric_name <> 'LCR'""",
    ),
    "audit_entry": (
        ["current_run"],
        f"""SELECT 'run-0001' AS run_id, 'Metrics Load' AS pipeline_step, 'SUCCESS' AS status,
               'Loaded CAR:' || {AUDITED.format('CAR')} || ', LCR:' || {AUDITED.format('LCR')}
               || ', NPL:' || {AUDITED.format('NPL')} AS message FROM current_run""",
    ),
    "exact_branch_totals": (
        ["npl_branches"],
        f"""SELECT branch_id, CAST(total_loan_balance AS DECIMAL(38,2)) AS total_loan_balance,
               CAST(npl_balance AS DECIMAL(38,2)) AS npl_balance, CAST({NPL_RATIO} AS DOUBLE) AS npl_ratio_percent
        FROM npl_branches""",
    ),
}


def _with_needs(names: list[str]) -> set[str]:
    found = set(names)
    for name in names:
        found |= _with_needs(NEEDS.get(name, []))
    return found


def all_sql() -> dict[str, str]:
    texts = {}
    for name, (reads, body) in QUERIES.items():
        needed = _with_needs(reads)
        views = ",\n".join(f"{view} AS ({VIEWS[view]})" for view in VIEWS if view in needed)
        texts[name] = f"WITH {views}\n{body}" if views else body
    return texts
