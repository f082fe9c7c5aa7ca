import csv
import io
import random
from pathlib import Path

import pytest
from golden import EXPECTED, FULL

from vulnloom.operators.extract import accepted, extract
from vulnloom.plans import collect
from vulnloom.schema import RAW, RAW_COLUMNS
from vulnloom.sources.dataset import read_csv_dataset, read_csv_leniently, write_csv_dataset
from vulnloom.sources.id_list import read_id_list, write_id_list
from vulnloom.sources.pages import read_listing_pages, read_page_files, read_pages


def lines_of(frame):
    return [(r.ord, r.cve_id) for r in frame.orderBy("ord").collect()]


# -- id lists


def test_id_list(spark, tmp_path):
    file = tmp_path / "ids.txt"
    file.write_bytes("b\n\n  a\t\r\nb\n\u00a0\n\u2003c d \x1c\nlast".encode())
    assert lines_of(read_id_list(spark, str(file))) == [
        (1, "b"), (2, "a"), (3, "b"), (4, "c d"), (5, "last"),
    ]


def test_missing_id_list(spark, path):
    frame = read_id_list(spark, path)
    assert frame.collect() == [] and frame.columns == ["ord", "cve_id"]


def test_empty_id_list(spark, tmp_path):
    (tmp_path / "ids.txt").write_text("\n \n")
    assert read_id_list(spark, str(tmp_path / "ids.txt")).count() == 0


def test_order_over_many_splits(spark, tmp_path):
    """File order is kept when a file is read by many tasks."""
    rng = random.Random(5)
    ids = [f"CVE-2024-{rng.randrange(10**6):07d}" for _ in range(20_000)]
    for name, part in (("a.txt", ids[:12_000]), ("b.txt", ids[12_000:])):
        (tmp_path / name).write_text("\n".join(part) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 16 * 1024)
    try:
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 10
        got = lines_of(read_id_list(spark, str(tmp_path)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == list(enumerate(ids, 1))


def test_id_list_is_written_in_number_order(spark, path):
    rng = random.Random(1)
    ids = [f"CVE-{y}-{n:04d}" for y in (2021, 2020) for n in rng.sample(range(1, 30_000), 500)]
    frame = spark.createDataFrame([(i,) for i in ids], "cve_id string").repartition(7)
    want = sorted(ids, key=lambda i: tuple(map(int, i.split("-")[1:])))
    for _ in range(2):  # the second run replaces the first
        write_id_list(frame, path)
        parts = sorted(Path(path).glob("part-*"))
        assert "".join(p.read_text() for p in parts) == "".join(i + "\n" for i in want)
    assert [i for _, i in lines_of(read_id_list(spark, path))] == want


# -- the CSV dataset

NASTY = {
    "summary": 'says "hi", twice', "details": " edge spaces ", "references": "a\nb\r\nc; d",
    "package": "\\", "repo": '"', "fixed": "é\u2028\U0001f600", "source": ",", "severity": "\\\"",
    "cwe_ids": "#x", "aliases": "\t",
}


def record(**changes):
    return {**{c: "" for c in RAW_COLUMNS}, **changes}


def rows_of(frame):
    return sorted((r.asDict() for r in frame.collect()), key=lambda r: r["cve_id"])


def test_csv_round_trip(spark, path):
    records = [record(cve_id="CVE-1", **NASTY), EXPECTED, record(cve_id="CVE-3")]
    frame = spark.createDataFrame([tuple(r[c] for c in RAW_COLUMNS) for r in records], RAW)
    write_csv_dataset(frame, path)
    assert rows_of(read_csv_dataset(spark, path)) == sorted(records, key=lambda r: r["cve_id"])


def test_csv_is_what_other_tools_read(spark, path):
    frame = spark.createDataFrame([tuple(record(cve_id="CVE-1", **NASTY).values()), tuple(EXPECTED.values())], RAW)
    write_csv_dataset(frame.coalesce(1), path)
    (part,) = Path(path).glob("*.csv")
    with open(part, newline="", encoding="utf-8") as f:
        reader = csv.DictReader(f)
        assert list(reader) == [record(cve_id="CVE-1", **NASTY), EXPECTED]
        assert reader.fieldnames == RAW_COLUMNS


def test_csv_other_tools_wrote(spark, tmp_path):
    """Rows end in CRLF here, so a CRLF inside a cell would come back as LF."""
    records = [
        record(cve_id="CVE-1", **{**NASTY, "references": "a\nb\n c; d"}), record(cve_id=" CVE-2\t"), EXPECTED,
        record(cve_id="", summary="no id"), record(cve_id=" \u00a0", summary="blank id"),
        record(cve_id="CVE-1"),
    ]
    with open(tmp_path / "set.csv", "w", newline="", encoding="utf-8") as f:
        writer = csv.DictWriter(f, fieldnames=RAW_COLUMNS)
        writer.writeheader()
        writer.writerows(records)
    got = read_csv_dataset(spark, str(tmp_path / "set.csv")).collect()
    assert [r.asDict() for r in got] == [r for r in records if r["cve_id"].strip()]


def test_missing_csv(spark, path):
    frame = read_csv_dataset(spark, path)
    assert frame.columns == RAW_COLUMNS and frame.count() == 0


@pytest.mark.parametrize("header", [RAW_COLUMNS[::-1], RAW_COLUMNS[:-1], RAW_COLUMNS + ["more"]])
def test_csv_of_other_columns_is_an_error(spark, tmp_path, header):
    (tmp_path / "set.csv").write_text(",".join(header) + "\n" + ",".join("x" for _ in header) + "\n")
    with pytest.raises(Exception, match="CSV header"):
        read_csv_dataset(spark, str(tmp_path / "set.csv")).collect()


def test_csv_files_are_bounded(spark, path):
    rows = spark.range(1000).coalesce(1).selectExpr(
        "concat('CVE-', id) cve_id", *[f"'' `{c}`" for c in RAW_COLUMNS[1:]]
    )
    write_csv_dataset(rows, path, rows_per_file=100)
    assert len(list(Path(path).glob("*.csv"))) == 10
    assert read_csv_dataset(spark, path).count() == 1000


# -- pages


def test_page_files(spark, tmp_path):
    (tmp_path / "CVE-2024-0001.html").write_text(FULL)
    (tmp_path / "CVE-2024-0002.htm").write_text("<p>not\nan advisory</p>")
    (tmp_path / "CVE-2024-0003").write_text("")
    rows = extract(read_page_files(spark, str(tmp_path)))
    assert accepted(rows).first().asDict() == EXPECTED
    assert {r.cve_id for r in rows.collect()} >= {"CVE-2024-0001", "CVE-2024-0002"}


def test_page_tables(spark, tmp_path):
    pages, listing = str(tmp_path / "pages"), str(tmp_path / "listing")
    spark.createDataFrame([("a", 200, "x")], "cve_id string, status int, html string").write.parquet(pages)
    assert read_pages(spark, pages).first() == ("a", 200, "x")
    spark.createDataFrame(
        [(2024, None, 0, 200, "x"), (2025, "1xxx", None, 200, "y")],
        "year int, directory string, page_no int, status int, html string",
    ).write.partitionBy("year").parquet(listing)
    from vulnloom.operators.index import listing_in_scope

    scope = listing_in_scope(read_listing_pages(spark, listing), 2025, 2025)
    assert [tuple(r) for r in scope.select("year", "html").collect()] == [(2025, "y")]


def test_bad_records_are_set_aside_whole(spark, tmp_path):
    path, lake = tmp_path / "old.csv", str(tmp_path / "lake")
    good = ["CVE-2024-0001", *["", 'a "b",\nc'], *["x"] * 19]
    out = io.StringIO()
    csv.writer(out).writerows([RAW_COLUMNS, good, ["CVE-2024-0002", *["y"] * 21], [" ", *["z"] * 21]])
    text = out.getvalue() + "CVE-2024-0003,cut\r\n" + ",".join(["CVE-2024-0004"] * 23) + "\r\n" + 'CVE-2024-0005,"open,\nrest\n'
    path.write_text(text, newline="")
    with pytest.raises(Exception):
        collect.import_csv(spark, str(path), lake)
    for _ in range(2):
        collect.import_csv(spark, str(path), lake, keep_bad=True)
    rows = {r.cve_id: r for r in collect.read_advisories(spark, lake).collect()}
    assert sorted(rows) == ["CVE-2024-0001", "CVE-2024-0002"] and rows["CVE-2024-0001"].json_data == "x"
    assert [rows["CVE-2024-0001"][c] for c in RAW_COLUMNS] == good
    bad = {r.record.strip() for r in spark.read.parquet(collect.bad_rows_path(lake)).collect()}
    assert bad == {"CVE-2024-0003,cut", 'CVE-2024-0005,"open,\nrest', ",".join(["CVE-2024-0004"] * 23)}
    assert path.read_text(newline="") == text


def test_no_csv_has_no_bad_records(spark, tmp_path):
    rows, bad = read_csv_leniently(spark, str(tmp_path / "none"), str(tmp_path / "work"))
    assert rows.count() == 0 and bad.count() == 0
