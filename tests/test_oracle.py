"""Every registered query against its plain SQL on DuckDB."""

import datetime as dt
import math
import random

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from bankmetrics.workload import oracle, queries

REGISTERED = queries.all_queries()

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def views(folder, tables):
    connection = duckdb.connect()
    for table in tables:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


@pytest.fixture(scope="module")
def duck(star_folder):
    with views(star_folder, TABLES) as connection:
        yield connection


def test_every_query_has_sql():
    assert set(REGISTERED) == set(oracle.all_sql())


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([row[i] for i in order] for row in rows), key=repr)


TYPE_NAMES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}
TYPE_NAMES["DECIMAL(38,2)"] = "decimal(38,2)"


def _same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-9)
    return a == b and type(a) is type(b)


def compare(spark, duck, folder, name):
    frame = REGISTERED[name](spark, folder)
    actual = _sorted(frame.columns, [tuple(row) for row in frame.collect()])
    answer = duck.execute(oracle.all_sql()[name])
    columns = [column[0] for column in answer.description]
    expected = _sorted(columns, answer.fetchall())
    types = {column[0]: TYPE_NAMES[str(column[1])] for column in answer.description}
    assert dict(frame.dtypes) == types
    assert len(actual) == len(expected) > 0
    differing = [(a, e) for a, e in zip(actual, expected) if not all(map(_same, a, e))]
    assert not differing[:3]


@pytest.mark.parametrize("name", sorted(REGISTERED))
def test_same_result(spark, duck, star_folder, name):
    compare(spark, duck, star_folder, name)


def _maybe(draw, value, share=0.05):
    return None if draw.random() < share else value


def _money(draw):
    return _maybe(draw, draw.choice([0.0, -draw.randrange(10**6) / 100, draw.randrange(10**13) / 100]))


def _day(draw, first=dt.datetime(1997, 11, 1)):
    return _maybe(draw, first + dt.timedelta(days=draw.randrange(120)))


def _event_time(draw):
    """A third of all events on the day of the one-period benchmark query."""
    return dt.datetime(2024, 1, 15, 9) if draw.random() < 1 / 3 else _day(draw, dt.datetime(2023, 12, 1, 8))


def _hot(draw, count):
    """A third of all rows on one key; some keys unknown to the lookup, some NULL."""
    return 7 if draw.random() < 1 / 3 else _maybe(draw, draw.randrange(count))


@pytest.fixture(scope="module")
def dirty(tmp_path_factory):
    """Star tables with NULLs, keys without a lookup row, hot keys, negative and zero amounts."""
    draw = random.Random(20)
    tables = {
        "region": pa.table({"r_regionkey": pa.array([0, 1], pa.int32()), "r_name": ["R0", "R1"]}),
        "nation": pa.table(
            {
                "n_nationkey": pa.array(range(6), pa.int32()),
                "n_name": [f"N{i}" for i in range(6)],
                "n_regionkey": pa.array([0, 1, 9, None, 0, 1], pa.int32()),
            }
        ),
        "supplier": pa.table(
            {
                "s_suppkey": pa.array(range(0, 30), pa.int64()),
                "s_nationkey": pa.array([_maybe(draw, i % 8) for i in range(30)], pa.int32()),
            }
        ),
        "customer": pa.table(
            {
                "c_custkey": pa.array(range(0, 50), pa.int64()),
                "c_nationkey": pa.array([_maybe(draw, i % 8) for i in range(50)], pa.int32()),
                "c_acctbal": pa.array([_money(draw) for _ in range(50)], pa.float64()),
                "c_mktsegment": [_maybe(draw, draw.choice(["BUILDING", "MACHINERY"])) for _ in range(50)],
            }
        ),
    }
    lines, orders, events = range(3000), range(1500), range(2400)
    tables["lineitem"] = pa.table(
        {
            "l_orderkey": pa.array([_maybe(draw, i // 2) for i in lines], pa.int64()),
            "l_partkey": pa.array([_maybe(draw, draw.randrange(500)) for _ in lines], pa.int64()),
            "l_suppkey": pa.array([_hot(draw, 40) for _ in lines], pa.int64()),
            "l_linenumber": pa.array([draw.randrange(3) for _ in lines], pa.int32()),
            "l_extendedprice": pa.array([_money(draw) for _ in lines], pa.float64()),
            "l_returnflag": [_maybe(draw, draw.choice("RRA")) for _ in lines],
            "l_linestatus": [_maybe(draw, draw.choice("FO")) for _ in lines],
            "l_shipdate": pa.array([_day(draw) for _ in lines], pa.timestamp("us")),
        }
    )
    priorities = ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW", "other"]
    tables["orders"] = pa.table(
        {
            "o_orderkey": pa.array([_maybe(draw, i) for i in orders], pa.int64()),
            "o_custkey": pa.array([_hot(draw, 60) for _ in orders], pa.int64()),
            "o_totalprice": pa.array([_money(draw) for _ in orders], pa.float64()),
            "o_orderdate": pa.array([_day(draw) for _ in orders], pa.timestamp("us")),
            "o_orderpriority": [_maybe(draw, draw.choice(priorities)) for _ in orders],
        }
    )
    props = ['{"k": 12}', '{"k": 7.25}', '{"k": "x"}', '{"j": 1}', None]
    tables["events"] = pa.table(
        {
            "ts": pa.array([_event_time(draw) for _ in events], pa.timestamp("us")),
            "user_id": pa.array([_maybe(draw, draw.randrange(300)) for _ in events], pa.int64()),
            "event_type": [_maybe(draw, draw.choice(["purchase", "purchase", "view"])) for _ in events],
            "value": pa.array([_maybe(draw, draw.randrange(4000) / 100) for _ in events], pa.float64()),
            "props": pa.array([draw.choice(props) for _ in events], pa.string()),
        }
    )
    folder = tmp_path_factory.mktemp("dirty")
    for name, content in tables.items():
        pq.write_table(content, folder / f"{name}.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def dirty_duck(dirty):
    with views(dirty, "region nation supplier customer lineitem orders events".split()) as connection:
        yield connection


@pytest.mark.parametrize("name", sorted(REGISTERED))
def test_same_result_on_dirty_tables(spark, dirty, dirty_duck, name):
    compare(spark, dirty_duck, dirty, name)
