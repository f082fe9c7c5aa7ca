import random

from pyspark.sql import functions as F

import pytest

from vulnloom.operators import index, merge
from vulnloom.operators.running import running_total


def test_blocks_give_the_plain_running_total(spark):
    rng = random.Random(6)
    rows = sorted({(rng.choice("ab"), rng.randrange(4), rng.randrange(5), rng.randrange(50)) for _ in range(600)})
    rows = [(*r, rng.randrange(10)) for r in rows]
    frame = spark.createDataFrame(rows, "k string, a int, b int, c int, v long").repartition(5).cache()
    for keys, blocks, order in (
        (["k"], [["a"], ["b"]], ["c"]), (["k"], [["a", "b"]], ["c"]), (["k"], [], ["a", "b", "c"]),
        ([], [["k"], ["a"], ["b"]], ["c"]), ([], [["k", "a"]], ["b", "c"]), ([], [], ["k", "a", "b", "c"]),
    ):
        got = running_total(frame, keys, blocks, order, F.col("v"), "t").collect()
        totals, want = {}, {}
        for *place, v in rows:
            key = place[0] if keys else ""
            totals[key] = totals.get(key, 0) + v
            want[tuple(place)] = totals[key]
        assert {(r.k, r.a, r.b, r.c): r.t for r in got} == want
        assert len(got) == len(rows)


@pytest.mark.parametrize("n", [0, 1, 3, 7, 20])
def test_both_ways_to_the_first_rows_agree_on_nulls_and_ties(spark, monkeypatch, n):
    ords = [None, 5, 5, 5, 1, None, 70_000, 2, 70_000, 3_000_000_000, None]
    rows = spark.createDataFrame([(o, f"id{i}") for i, o in enumerate(ords)], "ord long, cve_id string")
    ids = spark.createDataFrame(
        [(y, p, d, l, f"id{i}") for i, (y, p, d, l) in enumerate(
            [(None, 1, 1, 1), (2024, None, 1, 1), (2024, 1, None, 1), (2024, 1, 1, None), (2024, 1, 1, 5), (2024, 1, 1, 5), (2020, 2, 2, 2)])],
        "year int, page_no int, dir_pos int, link_pos int, cve_id string")
    sorted_way = [sorted(map(str, f.collect())) for f in (merge.first_in_order(rows, n), index.first_n(ids, n))]
    monkeypatch.setattr(merge, "SORTED_LIMIT", -1)
    monkeypatch.setattr(index, "SORTED_LIMIT", -1)
    totals_way = [sorted(map(str, f.collect())) for f in (merge.first_in_order(rows, n), index.first_n(ids, n))]
    assert sorted_way == totals_way
