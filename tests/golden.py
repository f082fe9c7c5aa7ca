"""Hand-written pages: one complete advisory and small changes to it."""

FULL = """<div class="x vulnerability-page">
<h1 class="title">CVE-2024-0001</h1>
<dl class="vulnerability-details">
<dt>Source</dt><dd><a href="https://s.example/1">s</a></dd>
<dt>Import Source</dt><dd><a href="https://i.example/1">i</a></dd>
<dt>JSON Data</dt><dd><a href="https://j.example/1">j</a></dd>
<dt>Aliases</dt><dd><ul><li><a href="/a">GHSA-a</a></li><li><a href="/b">GHSA-b</a></li></ul></dd>
<dt>Published</dt><dd>2024-03-29T17:15:21Z</dd>
<dt>Modified</dt><dd>2024-04-01T00:00:00.150Z</dd>
<dt>Severity</dt><dd><ul><li>9.8 (Critical) <span>CVSS_V3</span> - CVSS:3.1/AV:N/AC:L/PR:N/UI:N/S:U/C:H/I:H/A:H</li></ul></dd>
<dt>Summary</dt><dd>foo<b>bar</b>&nbsp;&amp; baz<!-- no --><script>var t="</p>";</script></dd>
<dt>Details</dt><dd><p>line one</p>
<p>line two</p></dd>
<dt>References</dt><dd><a href="https://r/1">1</a><a href="https://r/2">2</a><a href="https://r/1">1</a><a href="">e</a><a>n</a></dd>
</dl>
<osv-tabs class="vulnerability-packages">
<span class="vuln-ecosystem">PyPI</span><span class="vuln-name">demo</span>
<div class="vulnerability-package-subsection"><h3>Affected ranges</h3>
<dl><dt>Type</dt><dd>GIT</dd><dt>Repo</dt><dd><a href="https://x">https://git.example/demo</a></dd>
<dt>Events</dt><dd>
<div class="mdc-layout-grid__cell--span-9">Introduced</div><div class="mdc-layout-grid__cell--span-9">0</div>
<div class="mdc-layout-grid__cell--span-9">Fixed</div><div class="mdc-layout-grid__cell--span-9">1.2</div>
<div class="mdc-layout-grid__cell--span-9">Introduced</div><div class="mdc-layout-grid__cell--span-9">2.0</div>
<div class="mdc-layout-grid__cell--span-9">Fixed</div><div class="mdc-layout-grid__cell--span-9">2.3</div>
</dd></dl></div></osv-tabs>
<pre class="specific">{"cwe_ids": ["CWE-79", "CWE-89", "CWE-79"], "cna_assigner": "acme"}</pre>
</div>
"""

VECTOR = "CVSS:3.1/AV:N/AC:L/PR:N/UI:N/S:U/C:H/I:H/A:H"
EXPECTED = {
    "cve_id": "CVE-2024-0001",
    "source": "https://s.example/1",
    "import_source": "https://i.example/1",
    "json_data": "https://j.example/1",
    "aliases": "GHSA-a GHSA-b",
    "published": "2024-03-29T17:15:21Z",
    "modified": "2024-04-01T00:00:00.150Z",
    "severity": f"9.8 (Critical) CVSS_V3 - {VECTOR}",
    "cvss_score": "9.8",
    "cvss_version": "CVSS_V3",
    "cvss_vector": VECTOR,
    "summary": "foo bar & baz",
    "details": "line one line two",
    "ecosystem": "PyPI",
    "package": "demo",
    "range_type": "GIT",
    "repo": "https://git.example/demo",
    "introduced": "2.0",
    "fixed": "2.3",
    "cwe_ids": "CWE-79; CWE-89; CWE-79",
    "cna_assigner": "acme",
    "references": "https://r/1; https://r/2",
}

SEVERITY_ENTRY = FULL[FULL.index("<dt>Severity"):FULL.index("<dt>Summary")]
DETAILS_END = "</dl>\n<osv-tabs"
PACKAGES = FULL[FULL.index("<osv-tabs"):FULL.index("<pre")]
RANGES_OFF = {c: "" for c in ("range_type", "repo", "introduced", "fixed")}
CVSS_OFF = {c: "" for c in ("cvss_score", "cvss_version", "cvss_vector")}


def cell(text):
    return f'<div class="mdc-layout-grid__cell--span-9">{text}</div>'


# name -> (text to replace, replacement, columns that change)
EDGES = {
    "unchanged": ("", "", {}),
    "title_differs": ("CVE-2024-0001", "CVE-2024-9999", {}),
    "no_title": ('<h1 class="title">CVE-2024-0001</h1>', "", {}),
    "no_packages": (PACKAGES, "", {"ecosystem": "", "package": "", **RANGES_OFF}),
    "packages_in_other_tag": ("osv-tabs", "div", {"ecosystem": "", "package": "", **RANGES_OFF}),
    "heading_in_lower_case": ("Affected ranges", "affected ranges", RANGES_OFF),
    "heading_with_more_text": ("Affected ranges", "All <i>Affected</i> ranges (2)", {}),
    "heading_outside_subsection": ("vulnerability-package-subsection", "other", RANGES_OFF),
    "label_case_and_space": ("<dt>Summary</dt>", "<dt> SUM&#77;ARY\n</dt>", {}),
    "label_with_markup": ("<dt>JSON Data</dt>", "<dt><b>JSON</b><i>Data</i></dt>", {}),
    "late_severity_without_value": (DETAILS_END, "<dt>Severity</dt>" + DETAILS_END, {}),
    "first_severity_without_value": (
        SEVERITY_ENTRY, "<div><dt>Severity</dt></div>" + SEVERITY_ENTRY, CVSS_OFF),
    "first_references_without_value": (
        "<dt>References", "<div><dt>References</dt></div><dt>References", {"references": ""}),
    "first_summary_without_value": (
        "<dt>Summary", "<div><dt>Summary</dt></div><dt>Summary", {}),
    "two_summaries": ("<dt>Summary", "<dt>Summary</dt><dd>one</dd><dt>Summary", {"summary": "one"}),
    "empty_summary_first": (
        "<dt>Summary", "<dt>Summary</dt><dd></dd><dt>Summary", {"summary": ""}),
    "value_not_adjacent": ("<dt>Source</dt><dd>", "<dt>Source</dt><p>x</p>y<dd>", {}),
    "source_first_link_without_target": (
        '<a href="https://s.example/1">s</a>', '<a>x</a><a href="/y">y</a>', {"source": ""}),
    "source_first_value_without_link": (
        "<dt>Source</dt>", "<dt>Source</dt><dd>plain</dd><dt>Source</dt>", {}),
    "link_target_is_not_normalised": (
        "https://s.example/1", " /a  b?x=1&amp;y=2 ", {"source": " /a  b?x=1&y=2 "}),
    "score_without_point": (
        "9.8 (Critical)", "10 (Critical)",
        {"severity": f"10 (Critical) CVSS_V3 - {VECTOR}", "cvss_score": ""}),
    "score_among_numbers": (
        "9.8 (Critical)", "1.10.2 (x)",
        {"severity": f"1.10.2 (x) CVSS_V3 - {VECTOR}", "cvss_score": "10.2"}),
    "two_cvss_entries": (
        f"9.8 (Critical) <span>CVSS_V3</span> - {VECTOR}",
        "5.0 (Medium) CVSS_V2 - AV:N/AC:L/Au:N/C:P/I:N/A:N 9.8 (Critical) CVSS_V3 - CVSS:3.1/AV:N",
        {
            "severity": "5.0 (Medium) CVSS_V2 - AV:N/AC:L/Au:N/C:P/I:N/A:N "
                        "9.8 (Critical) CVSS_V3 - CVSS:3.1/AV:N",
            "cvss_score": "5.0", "cvss_version": "CVSS_V2", "cvss_vector": "CVSS:3.1/AV:N",
        }),
    "unknown_cvss_version": (
        "CVSS_V3", "CVSS_V1",
        {"severity": f"9.8 (Critical) CVSS_V1 - {VECTOR}", "cvss_version": ""}),
    "last_block_wins": (
        "</pre>\n", '</pre><pre class="specific">{"cwe_ids":["CWE-20"]}</pre>', {"cwe_ids": "CWE-20"}),
    "block_without_ids": ("</pre>\n", '</pre><pre class="specific">{"cwe_ids":[]}</pre>', {}),
    "block_not_naming_the_key": ("</pre>\n", '</pre><pre class="specific">"CWE-1"</pre>', {}),
    "block_of_other_class": ("</pre>\n", '</pre><pre class="specifics">{"cwe_ids":["CWE-1"]}</pre>', {}),
    "second_assigner": (
        "</pre>\n", '</pre><pre class="a specific">{"cna_assigner"\n:\u00a0"b c"}</pre>',
        {"cna_assigner": "b c"}),
    "block_split_by_markup": (
        '"CWE-89"', '"CWE-<b> 89 </b>"', {"cwe_ids": "CWE-79; CWE-89; CWE-79"}),
    "unclosed_label": (
        "<dt>Summary</dt><dd>", "<dt>Summary<dd>", {"summary": ""}),
    "value_before_label_in_cells": (
        cell("Introduced") + cell("0"), cell("0") + cell("Introduced"), {}),
    "fixed_last_without_value": (
        cell("2.0"), cell("2.0") + cell("INTRODUCED") + cell("3.0"), {"introduced": "3.0"}),
    "word_after_word": (
        cell("2.3"), cell("Introduced"), {"fixed": "Introduced"}),
    "events_first_label_decides": (
        "<dt>Events</dt>", "<p><dt>Events</dt></p><dt>Events</dt>", {"introduced": "", "fixed": ""}),
    "second_package_is_ignored": (
        "</osv-tabs>", '<span class="vuln-name">two</span><span class="vuln-ecosystem">npm</span></osv-tabs>', {}),
    "heading_of_a_later_package": (
        '<div class="vulnerability-package-subsection"><h3>Affected ranges',
        '<div class="vulnerability-package-subsection"><h3>Versions</h3><dl><dt>Type</dt><dd>no</dd></dl>'
        '</div><div class="vulnerability-package-subsection"><h3>Affected ranges', {}),
    "nested_label": (
        "<dt>Published</dt>", "<dl><dt>Published</dt><dd>inner</dd></dl><dt>Published</dt>",
        {"published": "inner"}),
    "entities_in_classes": ('"vulnerability-details"', '"vulnerability&#45;details"', {}),
    "entity_in_page_class": ("vulnerability-page", "vulnerability&#x2d;page", {}),
    "upper_case_tags": ("<dt>Aliases</dt><dd>", "<DT>Aliases</DT><DD>", {}),
    "references_keep_order": (
        '<a href="https://r/1">1</a><a href="https://r/2">2</a>',
        '<a href="https://r/2">2</a><a href="https://r/1">1</a>',
        {"references": "https://r/2; https://r/1"}),
}

REFUSED = {
    "page_not_found": ("vulnerability-page", "vulnerability-pages"),
    "details_not_found": ('"vulnerability-details"', '"details"'),
}
