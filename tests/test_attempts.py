"""A log of attempts taken in as it grows, against the same log at once."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from vulnloom.operators import crawl_log
from vulnloom.schema import FETCH_LOG
from vulnloom.streaming import attempts

START = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)


@pytest.fixture(scope="module")
def log():
    rng = random.Random(5)
    rows = []
    for n in range(400):
        cve_id = None if n % 50 == 0 else "CVE-2024-0001" if n % 3 == 0 else f"CVE-2024-{rng.randrange(40):04d}"
        rows.append((cve_id, rng.randrange(1, 10), rng.choice([200, 429, 503, 404, None]),
                     rng.choice([None, "", "7", "soon", "-1", "99999999999999"]), START + datetime.timedelta(seconds=n)))
    return rows


def landed(spark, path, rows, seed):
    frame = spark.createDataFrame(rows, FETCH_LOG).orderBy(F.xxhash64("ts", F.lit(seed)))
    frame.coalesce(1).write.mode("append").parquet(path)


def follow(spark, path, **options):
    stream = attempts.attempt_stream(spark, f"{path}/landing", **options)
    attempts.follow(stream, f"{path}/kept", f"{path}/checkpoint").awaitTermination()


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_leaves_the_same_frontier(spark, tmp_path, log, seed):
    rng = random.Random(seed)
    rest, path = rng.sample(log, len(log)), str(tmp_path)
    while rest:
        n = rng.randrange(1, 200)
        landed(spark, f"{path}/landing", rest[:n], seed)
        rest = rest[n:]
        if rng.random() < 0.5:
            # The query ends and is started again from its checkpoint.
            follow(spark, path, maxFilesPerTrigger=1)
    landed(spark, f"{path}/landing", log[:50], seed)  # some arrive twice
    follow(spark, path)
    whole = crawl_log.frontier(spark.createDataFrame(log, FETCH_LOG))
    want = sorted(map(tuple, whole.collect()), key=repr)
    assert sorted(map(tuple, attempts.frontier(spark, f"{path}/kept").collect()), key=repr) == want and want


def test_a_batch_writes_the_ids_it_changed_only(spark, tmp_path):
    path = str(tmp_path)
    landed(spark, f"{path}/landing", [(f"CVE-2024-{n:04d}", 1, 503, None, START) for n in range(100)], 1)
    follow(spark, path)
    landed(spark, f"{path}/landing", [("CVE-2024-0007", 2, 200, None, START)], 1)
    follow(spark, path)
    kept = spark.read.parquet(f"{path}/kept/changes")
    assert {r.batch: r["count"] for r in kept.groupBy("batch").count().collect()} == {0: 100, 1: 1}
    # A new checkpoint takes everything in again, beside what is there.
    attempts.follow(attempts.attempt_stream(spark, f"{path}/landing"), f"{path}/kept", f"{path}/other").awaitTermination()
    got = {r.cve_id: r.outcome for r in attempts.frontier(spark, f"{path}/kept").collect()}
    assert len(got) == 100 and got["CVE-2024-0007"] == "ok" and got["CVE-2024-0008"] == "retry"


def test_ids_are_due_when_their_wait_is_over(spark):
    rows = [("a", 1, 429, "7", START), ("b", 1, 503, None, START), ("c", 1, 200, None, START), ("d", 8, 503, None, START),
            ("e", 1, 429, "9223372036", START)]
    frontier = crawl_log.frontier(spark.createDataFrame(rows, FETCH_LOG))

    def due(seconds):
        now = F.lit(START + datetime.timedelta(seconds=seconds))
        return sorted(r.cve_id for r in crawl_log.due(frontier, now).collect())

    assert [due(6), due(7), due(29), due(30), due(10**6)] == [[], ["a"], ["a"], ["a", "b"], ["a", "b"]]


def test_nothing_followed_yet(spark, tmp_path):
    assert attempts.frontier(spark, str(tmp_path / "none")).count() == 0
