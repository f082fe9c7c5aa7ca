"""Page lakes derived from the driver tables.

No driver table holds advisory pages, so they are rendered from whole tables:
one advisory per part or document, listing pages from orders, a crawl log from
events. Everything multi-valued on an advisory comes from its own row, so
rendering is a projection and no group is collected; a range page collects the
keys of one thousand-range, which are at most a thousand and the repeats.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vulnloom.functions.text import escape_html
from vulnloom.schema import LISTING_PREFIX, RAW_COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(rows: DataFrame, key: str) -> DataFrame:
    """Narrow rows dealt to all tasks before pages are rendered from them: a small table is one
    row group, and its pages would all be read by one task. Pages themselves are not moved."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def text(*parts) -> Column:
    """Concatenate strings and columns."""
    return F.concat(*[
        p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts
    ])


def id_text(year: Column, number: Column) -> Column:
    digits = number.cast("string")
    padded = F.when(F.length(digits) < 4, F.lpad(digits, 4, "0")).otherwise(digits)
    return text("CVE-", year, "-", padded)


def part_id(k: Column) -> Column:
    return id_text(2020 + k % 7, k)


def _entry(label, value: Column | str) -> Column:
    return text("<dt>", label, "</dt><dd>", value, "</dd>\n")


def _link(href: Column, shown: Column | str = "x") -> Column:
    return text('<a href="', href, '">', shown, "</a>")


def _repeat(last: Column, item) -> Column:
    """``item(j)`` for j = 0..last, run together; nothing when last < 0."""
    steps = F.when(last >= 0, F.sequence(F.lit(0).cast("bigint"), last))
    return F.coalesce(F.array_join(F.transform(steps, item), ""), F.lit(""))


def severity_cell(k: Column) -> Column:
    tenths, version = k % 101, 2 + k % 3
    band = (
        F.when(tenths == 0, "None").when(tenths < 40, "Low").when(tenths < 70, "Medium")
        .when(tenths < 90, "High").otherwise("Critical")
    )
    reach = F.substring(F.lit("NALP"), (k % 4 + 1).cast("int"), F.lit(1))
    vector = (
        F.when(version == 2, "AV:N/AC:L/Au:N/C:P/I:N/A:N")
        .when(version == 3, text("CVSS:3.1/AV:", reach, "/AC:L/PR:N/UI:N/S:U/C:H/I:H/A:H"))
        .otherwise(text("CVSS:4.0/AV:", reach, "/AC:L/AT:N/PR:N/UI:N"))
    )
    score = text(F.floor(tenths / 10), ".", tenths % 10)
    second = "<li>9.1 (Critical) <span>CVSS_V3</span> - CVSS:3.0/AV:L/AC:H</li>"
    return text(
        "<ul><li>", score, " (", band, ") <span>CVSS_V", version, "</span> - ", vector, "</li>",
        F.when(k % 19 == 0, second).otherwise(""), "</ul>",
    )


def _details(k: Column, name: Column, brand: Column, kind: Column, size: Column) -> Column:
    def alias(j):
        return text("<li>", _link(F.lit("/a"), text("GHSA-", k + j)), "</li>")

    published, modified = (
        F.replace(
            F.expr(f"timestamp_ntz'{day}' + make_dt_interval(0, cast(p_partkey % 40000 as int))").cast("string"),
            F.lit(" "), F.lit("T"),
        )
        for day in ("2024-01-01", "2024-01-02")
    )
    return text(
        F.when(k % 21 == 0, "<div><dt>Severity</dt></div>").otherwise(""),
        _entry("Source", _link(text("https://s.example/", k))),
        _entry(" import  SOURCE ", _link(text("https://i.example/", k))),
        _entry("JSON Data", _link(text("https://j.example/", k, ".json?a=1&amp;b=2"))),
        _entry("Aliases", text("<ul>", _repeat(k % 4 - 1, alias), "</ul>")),
        F.when(k % 13 == 0, "").otherwise(
            _entry("Published", text(published, "Z"))),
        _entry("Modified", text(modified, ".150Z")),
        F.when(k % 17 == 0, "").otherwise(_entry("Severity", severity_cell(k))),
        _entry("Summary", text(
            name, "<b>", brand, '</b>&nbsp;&amp; <!-- no --><script>var t="</p>";</script>', kind)),
        _entry("Details", text("<p>", name, " is affected.</p>\n<p>Size\t", size, "<br>only</p>")),
        _entry("References", text(
            _repeat(k % 6, lambda j: _link(text("https://r.example/", k * 7 + j % 3))),
            '<a href="">e</a><a>n</a>',
        )),
    )


def _packages(k: Column, name: Column, brand: Column, kind: Column) -> Column:
    cell = '<div class="mdc-layout-grid__cell mdc-layout-grid__cell--span-9">'
    start = k % 7

    def event(j):
        fixed = text(cell, "Fixed</div>", cell, j * 10 + start + 5, "</div>")
        return text(
            cell, " Introduced</div>", cell, j * 10 + start, "</div>",
            F.when(k % 5 == 0, "").otherwise(fixed),
        )

    return text(
        '<osv-tabs class="vulnerability-packages">\n<span class="vuln-ecosystem">', brand,
        '</span><span class="vuln-name">', name, "</span>",
        '<div class="vulnerability-package-subsection"><h3>',
        F.when(k % 14 == 0, "affected ranges").otherwise("Affected ranges"), "</h3>\n<dl>",
        _entry("Type", kind),
        _entry("Repo", _link(F.lit("https://x.example"), text("https://git.example/", k))),
        _entry("Events", _repeat(k % 3, event)),
        '</dl></div><span class="vuln-ecosystem">Other</span><span class="vuln-name">other</span>',
        "</osv-tabs>\n",
    )


def advisory_pages(spark: SparkSession, sf_dir: str, healed: bool = False) -> DataFrame:
    """One advisory page per part: cve_id, status, html.

    Some cannot be accepted: wrong status, page class or details list missing.
    ``healed`` is a later crawl in which every status is 200.
    """
    parts = dealt(
        table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size"), "p_partkey"
    )
    k = F.col("p_partkey")
    name, brand, kind = (escape_html(F.col(c)) for c in ("p_name", "p_brand", "p_type"))
    shown_id = F.when(k % 23 == 0, "CVE-1999-0001").otherwise(part_id(k))
    block = text(
        '{"cwe_ids": ["CWE-', F.col("p_size"), '", "CWE-', k % 20, '"], "cna_assigner" : "',
        F.col("p_brand"), '"}',
    )
    second = (
        F.when(k % 6 == 0, '<pre class="specific">{"cwe_ids":["CWE-20"]}</pre>')
        .when(k % 6 == 1, '<pre class="specific">{"cwe_ids":[]}</pre>')
        .otherwise("")
    )
    html = text(
        '<html><body><div class="x ', F.when(k % 10 == 0, "other").otherwise("vulnerability-page"),
        '">\n<h1 class="title">', shown_id, "</h1>\n<dl class=\"",
        F.when(k % 11 == 0, "other").otherwise("vulnerability-details"), '">\n',
        _details(k, name, brand, kind, F.col("p_size")), "</dl>\n",
        F.when(k % 15 == 0, "").otherwise(_packages(k, name, brand, kind)),
        '<pre class="specific">', escape_html(block), "</pre>", second, "</div></body></html>",
    )
    status = F.lit(200) if healed else F.when(k % 29 == 0, 404).otherwise(200)
    return parts.select(part_id(k).alias("cve_id"), status.alias("status"), html.alias("html"))


def document_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One advisory page per document, its whole text as the details."""
    docs = dealt(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    html = text(
        '<div class="vulnerability-page"><dl class="vulnerability-details">',
        _entry("Details", escape_html(F.coalesce("text", F.lit("")))), "</dl></div>",
    )
    return docs.select(
        "doc_id", id_text(F.lit(2024), F.col("doc_id")).alias("cve_id"),
        F.lit(200).alias("status"), html.alias("html"),
    )


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Year and range pages from orders, in the LISTING_PAGES layout.

    Directories are linked in falling order, ids too, so discovery order is
    not id order. Every hundredth id is listed in the next directory as well.
    """
    year = (F.year("o_orderdate") + 24).alias("year")
    keys = table(spark, sf_dir, "orders").select(year, F.col("o_orderkey").alias("key")).distinct()
    places = F.when(F.col("key") % 100 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    listed = keys.select("year", "key", F.explode(places).alias("_next")).select(
        "year", "key", (F.floor(F.col("key") / 1000) + F.col("_next")).alias("dir")
    )

    def file(k):
        name = text("/blob/", id_text(F.col("year"), k), ".json")
        return text(_link(name), F.when(k % 5 == 0, _link(text(name, ".bak"))).otherwise(""))

    def joined_links(column, item):
        return F.array_join(F.transform(F.sort_array(F.collect_list(column), asc=False), item), "\n")

    noise = text(
        _link(text("/blob/CVE-", F.col("year"), "-123.json")),
        _link(text("/blob/CVE-", F.col("year") - 1, "-5555.json")), "<a>none</a>\n",
    )
    ranges = listed.groupBy("year", "dir").agg(joined_links("key", file).alias("links")).select(
        "year",
        text(F.col("dir"), "xxx").alias("directory"),
        F.lit(None).cast("int").alias("page_no"),
        F.when((F.col("dir") + F.col("year")) % 7 == 0, 500).otherwise(200).alias("status"),
        text("<html><body>", noise, F.col("links"), "</body></html>").alias("html"),
    )

    def folder(d):
        return _link(text(LISTING_PREFIX, F.col("year"), "/", d, "xxx"))

    other = text(
        _link(text(LISTING_PREFIX, F.col("year"), "/readme")),
        _link(text(LISTING_PREFIX, F.col("year") - 1, "/1xxx")), "<a>none</a>\n",
    )
    chunk = F.floor(F.col("dir") / 1000).cast("int").alias("page_no")
    years = (
        listed.select("year", "dir", chunk).distinct().groupBy("year", "page_no")
        .agg(joined_links("dir", folder).alias("links"))
        .select(
            "year", F.lit(None).cast("string").alias("directory"), "page_no",
            F.lit(200).alias("status"),
            text("<html><body>", other, F.col("links"), "</body></html>").alias("html"),
        )
    )
    return years.unionByName(ranges)


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A crawl log from events: cve_id, attempt, status, retry_after, ts."""
    e, n = F.col("event_type"), F.col("event_id")
    status = (
        F.when(e == "view", 200).when(e == "click", 429).when(e == "purchase", 503)
        .when(e == "signup", 404)
    )
    retry_after = (
        F.when(n % 6 == 0, "7").when(n % 6 == 1, "soon").when(n % 6 == 2, "-1")
        .when(n % 6 == 3, "").when(n % 6 == 4, " 9_0 ")
    )
    return table(spark, sf_dir, "events").select(
        id_text(F.lit(2024), F.col("user_id")).alias("cve_id"),
        (1 + n % 9).cast("int").alias("attempt"),
        status.alias("status"),
        retry_after.alias("retry_after"),
        F.col("ts"),
    )


def csv_lines(spark: SparkSession, sf_dir: str, path: str) -> None:
    """CSV files with a header each, one per 100,000 parts: most records have 22 cells, some 3 or 23."""
    k = F.col("p_partkey")
    cells = F.concat(
        F.array(part_id(k)), F.array_repeat(F.lit(""), 10),
        F.array(F.concat(F.lit('"'), "p_name", F.lit(', ""new""\nsize '), F.col("p_size").cast("string"), F.lit('"'))),
        F.array_repeat(F.lit("x"), 9), F.array(F.concat(F.lit("https://r.example/"), k.cast("string"))),
    )
    short = F.array(part_id(k), F.col("p_name"), F.lit("cut"))
    line = F.array_join(
        F.when(k % 7 == 0, short).when(k % 11 == 0, F.array_append(cells, F.lit("more"))).otherwise(cells), ","
    )
    parts = table(spark, sf_dir, "part")
    rows = parts.select(F.floor(k / 100_000).alias("block"), k.alias("place"), line.alias("value"))
    header = rows.select("block").distinct().select("block", F.lit(-1).alias("place"), F.lit(",".join(RAW_COLUMNS)).alias("value"))
    (
        rows.unionByName(header).repartition("block").sortWithinPartitions("block", "place")
        .select("block", "value").write.partitionBy("block").text(path)
    )
