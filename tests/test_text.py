import sys
import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vulnloom.functions.text import (
    escape_html,
    id_sequence,
    id_year,
    listing_address,
    normalise,
    page_address,
    strip,
)
from vulnloom.schema import ADVISORY_BASE, LISTING_BASE

SPACES = [chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace()]


def both(spark, texts):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    rows = frame.select("i", normalise(F.col("t")).alias("n"), strip(F.col("t")).alias("s"))
    return [(r.n, r.s) for r in rows.orderBy("i").collect()]


def test_every_character(spark):
    texts = [
        f"{chr(c)}a{chr(c)}{chr(c)}b{chr(c)}" for c in range(0x10000) if not 0xD800 <= c <= 0xDFFF
    ]
    assert both(spark, texts) == [(" ".join(t.split()), t.strip()) for t in texts]


def test_mixed_text(spark):
    chars = st.sampled_from(SPACES + list("ab​́") + ["\U0001f600"])
    collected = []

    @settings(max_examples=300, database=None)
    @given(st.text(chars, max_size=12))
    def gather(text):
        collected.append(text)

    gather()
    assert both(spark, collected) == [(" ".join(t.split()), t.strip()) for t in collected]


def test_missing_text(spark):
    assert both(spark, [None, "", " \t "]) == [("", "")] * 3


def test_id_parts(spark):
    ids = ["CVE-2024-10000", "CVE-2024-9999", "CVE-2024-0007", "junk", "CVE-x-y", "CVE-2024-123456789012"]
    frame = spark.createDataFrame([(i,) for i in ids], "id string")
    got = frame.select(id_year(F.col("id")), id_sequence(F.col("id"))).collect()
    assert [tuple(r) for r in got] == [
        (2024, 10000), (2024, 9999), (2024, 7), (None, None), (None, None), (2024, 123456789012),
    ]


def test_addresses(spark):
    year, directory = F.lit(2024), F.lit("1xxx")
    row = spark.range(1).select(
        page_address(F.lit("CVE-2024-1"), "https://a.example/v/"),
        listing_address(year, base="https://l.example/cves"),
        listing_address(year, directory, "https://l.example/cves"),
        page_address(F.lit("CVE-2024-1")),
        listing_address(year, directory),
    ).first()
    assert tuple(row) == (
        "https://a.example/v/CVE-2024-1", "https://l.example/cves/2024", "https://l.example/cves/2024/1xxx",
        ADVISORY_BASE + "CVE-2024-1", LISTING_BASE + "/2024/1xxx",
    )


def test_escape(spark):
    row = spark.range(1).select(escape_html(F.lit('<a href="x">&amp;</a>'))).first()
    assert row[0] == "&lt;a href=&quot;x&quot;&gt;&amp;amp;&lt;/a&gt;"


def test_category_of_spaces():
    """The set the expressions must match has not grown."""
    assert len(SPACES) == 29 and all(unicodedata.category(c) in ("Zs", "Zl", "Zp", "Cc") for c in SPACES)
