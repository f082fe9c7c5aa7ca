import random
from datetime import datetime, timedelta

import pytest

from vulnloom.operators.crawl_log import retry_frontier
from vulnloom.schema import FETCH_LOG

NOON = datetime(2024, 1, 1, 12)

# attempt, status, Retry-After -> outcome, wait
CASES = [
    (1, 200, None, "ok", 0),
    (8, 200, None, "ok", 0),
    (2, 429, "7", "retry", 7),
    (2, 429, "0", "retry", 0),
    (2, 429, "86400", "retry", 86400),
    (2, 429, " +1_0\n", "retry", 10),
    (2, 429, None, "retry", 120),
    (2, 429, "", "retry", 120),
    (6, 429, None, "retry", 300),
    (3, 429, "soon", "retry", 60),
    (3, 429, "7.5", "retry", 60),
    (3, 429, "Wed, 21 Oct 2026 07:28:00 GMT", "retry", 60),
    (3, 429, " ", "retry", 60),
    (1, 429, "-1", "permanent", 0),
    (8, 429, "-1", "permanent", 0),
    (1, 429, "99999999999999999999", "permanent", 0),
    (1, 429, "9" * 60, "permanent", 0),
    (8, 429, "7", "exhausted", 0),
    (1, 500, None, "retry", 30),
    (2, 503, "900", "retry", 60),
    (7, 599, None, "retry", 180),
    (1, None, None, "retry", 30),
    (7, None, None, "retry", 180),
    (8, 500, None, "exhausted", 0),
    (8, None, None, "exhausted", 0),
    (1, 404, None, "permanent", 0),
    (1, 301, None, "permanent", 0),
    (1, 204, None, "permanent", 0),
    (8, 404, None, "permanent", 0),
]


@pytest.fixture(scope="module")
def outcomes(spark):
    log = [(str(i), a, s, r, NOON) for i, (a, s, r, _, _) in enumerate(CASES)]
    rows = retry_frontier(spark.createDataFrame(log, FETCH_LOG)).collect()
    return {int(r.cve_id): (r.outcome, r.wait_seconds) for r in rows}


@pytest.mark.parametrize("i", range(len(CASES)), ids=[str(c[:3]) for c in CASES])
def test_outcome(outcomes, i):
    assert outcomes[i] == CASES[i][3:]


def test_latest_attempt_decides(spark):
    log = [
        ("a", 1, 503, None, NOON), ("a", 2, 200, None, NOON + timedelta(1)),
        ("b", 2, 200, None, NOON), ("b", 3, 503, None, NOON - timedelta(1)),
        ("c", 1, None, None, NOON), ("c", 1, 404, None, NOON + timedelta(1)),
    ]
    rows = retry_frontier(spark.createDataFrame(log, FETCH_LOG)).collect()
    assert {r.cve_id: (r.attempt, r.outcome) for r in rows} == {
        "a": (2, "ok"), "b": (3, "retry"), "c": (1, "permanent"),
    }


def test_hot_id(spark):
    """One id with most of the log comes out as any other."""
    rng = random.Random(7)
    log = [("hot", i, 503, None, NOON) for i in range(1, 4001)]
    log += [(f"c{i}", 1, 200, None, NOON) for i in range(1000)]
    rng.shuffle(log)
    rows = retry_frontier(spark.createDataFrame(log, FETCH_LOG).repartition(8), max_attempts=5000)
    got = {r.cve_id: (r.attempt, r.outcome, r.wait_seconds) for r in rows.collect()}
    assert got["hot"] == (4000, "retry", 180) and len(got) == 1001


def test_attempt_limit_is_a_parameter(spark):
    log = spark.createDataFrame([("a", 3, 503, None, NOON)], FETCH_LOG)
    assert retry_frontier(log, max_attempts=3).first().outcome == "exhausted"
