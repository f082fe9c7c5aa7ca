"""Every named query against DuckDB on the same tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from vulnloom.plans.catalog import QUERIES
from vulnloom.plans.oracles import ORACLES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
KINDS = {"string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    return round(value, 9) if isinstance(value, float) else value


def in_order(rows):
    return sorted((tuple(plain(v) for v in row) for row in rows), key=repr)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf_dir, duck, name):
    frame = contract.queries()[name](spark, sf_dir)
    columns = sorted(frame.columns)
    found = duck.execute(contract.oracle_sql()[name])
    kinds = {d[0]: str(d[1]) for d in found.description}
    assert {c: KINDS[t] for c, t in frame.dtypes} == kinds
    at = [list(kinds).index(c) for c in columns]
    want = in_order([row[i] for i in at] for row in found.fetchall())
    got = in_order([row[c] for c in columns] for row in frame.collect())
    assert got == want and got


def test_entry(spark, sf_dir):
    frame = contract.entry(spark)
    assert frame.columns == ["cwe_id", "n"] and frame.count() == 10


@pytest.mark.parametrize("name", ["advisory_fields", "typed_view", "monthly_trend", "index_ids"])
def test_session_zone_does_not_matter(spark, sf_dir, name):
    """Pages, times and months are the same where a day has 23 hours."""
    def rows():
        frame = contract.queries()[name](spark, sf_dir)
        return in_order(tuple(r) for r in frame.collect())

    old, here = spark.conf.get("spark.sql.session.timeZone"), rows()
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert rows() == here
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


@pytest.mark.parametrize("name, shrunk", [("ecosystem_counts", "part"), ("index_year_counts", "orders"), ("id_preview", "orders")])
def test_answers_follow_the_tables(spark, sf_dir, tmp_path, name, shrunk):
    """A query reads the given tables on every call."""
    for t in TABLES:
        (tmp_path / f"{t}.parquet").symlink_to(f"{sf_dir}/{t}.parquet")
    before = in_order(tuple(r) for r in QUERIES[name](spark, str(tmp_path)).collect())
    few = spark.read.parquet(f"{sf_dir}/{shrunk}.parquet").limit(20)
    (tmp_path / f"{shrunk}.parquet").unlink()
    few.write.parquet(str(tmp_path / f"{shrunk}.parquet"))
    assert in_order(tuple(r) for r in QUERIES[name](spark, str(tmp_path)).collect()) != before
