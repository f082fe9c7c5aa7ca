"""An index that grows by batches of pages against that of all pages at once."""

import random

import pytest
from test_index import folder, links, listing

from vulnloom.operators import index
from vulnloom.plans import grow_index


def file(year, n):
    return f"/blob/CVE-{year}-{n:04d}.json"


@pytest.fixture(scope="module")
def rows():
    """Two years, directories linked by two year pages each, ids listed in two directories, a page twice."""
    out = []
    for year in (2021, 2022):
        dirs = [f"{d}xxx" for d in range(6)]
        out.append((year, None, 1, 200, links(*(folder(year, d) for d in reversed(dirs)))))
        out.append((year, None, 0, 200, links(*(folder(year, d) for d in dirs[3:5]))))
        for d in range(6):
            ids = [file(year, 1000 * d + n) for n in range(1, 8)] + [file(year, 1000 * (d + 1) + 1)]
            out.append((year, dirs[d], None, 500 if d == 2 else 200, links(*ids)))
        out.append((year, dirs[1], None, 200, links(file(year, 1777), file(year, 1002))))
    return out


def answers(ids, counts):
    place = ["cve_id", "year", "page_no", "dir_pos", "link_pos", "directory"]
    return (sorted(map(tuple, ids.select(*place).collect())), sorted(map(tuple, counts.collect())))


@pytest.mark.parametrize("seed", range(3))
def test_batches_make_the_index_of_the_whole(spark, tmp_path, rows, seed):
    rng = random.Random(seed)
    rest, path, batch = rng.sample(rows, len(rows)), str(tmp_path), 0
    while rest:
        n, batch = rng.randrange(1, 12), batch + 1
        for _ in range(rng.choice((1, 2))):  # some batches are run again
            grow_index.add_pages(listing(spark, rest[:n]), path, batch)
        rest = rest[n:]
    pages = index.listing_in_scope(listing(spark, rows))
    found = index.discovered(pages).cache()
    want = answers(found, index.running_counts(pages, found))
    assert answers(grow_index.ids_of(spark, path), grow_index.running_counts(spark, path)) == want and want[0]


def test_years_without_new_pages_are_left_alone(spark, tmp_path, rows):
    path = str(tmp_path)
    grow_index.add_pages(listing(spark, [r for r in rows if r[0] == 2021]), path, 1)
    before = sorted(tmp_path.glob("ids/year=2021/*.parquet")), sorted(tmp_path.glob("totals/year=2021/*.parquet"))
    grow_index.add_pages(listing(spark, [r for r in rows if r[0] == 2022]), path, 2)
    assert before[0] and before == (sorted(tmp_path.glob("ids/year=2021/*.parquet")), sorted(tmp_path.glob("totals/year=2021/*.parquet")))
    assert {r.year for r in grow_index.ids_of(spark, path).select("year").distinct().collect()} == {2021, 2022}


def test_no_pages(spark, tmp_path):
    path = str(tmp_path)
    assert grow_index.ids_of(spark, path).count() == 0
    grow_index.add_pages(listing(spark, []), path, 1)
    assert grow_index.ids_of(spark, path).count() == 0 and grow_index.running_counts(spark, path).count() == 0
