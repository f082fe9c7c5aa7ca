"""What DuckDB computes straight from the driver tables, without any page."""

from vulnloom.schema import ADVISORY_BASE, LISTING_BASE, RAW_COLUMNS

# The advisory a page of ``samples.advisory_pages`` stands for, from its part.
PARTS = r"""
WITH part_rows AS (
  SELECT p_partkey AS k, p_name, p_brand, p_type, p_size,
         p_partkey % 101 AS tenths, 2 + p_partkey % 3 AS v,
         substr('NALP', CAST(p_partkey % 4 + 1 AS INTEGER), 1) AS reach,
         TIMESTAMP '2024-01-01' + to_hours(CAST(p_partkey % 40000 AS INTEGER)) AS published_at,
         CASE WHEN p_partkey % 17 <> 0 THEN TRUE ELSE FALSE END AS has_severity,
         p_partkey % 15 <> 0 AS has_packages,
         p_partkey % 15 <> 0 AND p_partkey % 14 <> 0 AS has_ranges
  FROM part
), cells AS (
  SELECT *,
    CASE WHEN tenths = 0 THEN 'None' WHEN tenths < 40 THEN 'Low' WHEN tenths < 70 THEN 'Medium'
         WHEN tenths < 90 THEN 'High' ELSE 'Critical' END AS band,
    CAST(tenths // 10 AS VARCHAR) || '.' || CAST(tenths % 10 AS VARCHAR) AS score,
    CASE v WHEN 2 THEN 'AV:N/AC:L/Au:N/C:P/I:N/A:N'
           WHEN 3 THEN 'CVSS:3.1/AV:' || reach || '/AC:L/PR:N/UI:N/S:U/C:H/I:H/A:H'
           ELSE 'CVSS:4.0/AV:' || reach || '/AC:L/AT:N/PR:N/UI:N' END AS vector
  FROM part_rows
), pages_expected AS (
  SELECT k,
    'CVE-' || CAST(2020 + k % 7 AS VARCHAR) || '-' ||
      CASE WHEN length(CAST(k AS VARCHAR)) < 4 THEN lpad(CAST(k AS VARCHAR), 4, '0')
           ELSE CAST(k AS VARCHAR) END AS cve_id,
    'https://s.example/' || k AS source,
    'https://i.example/' || k AS import_source,
    'https://j.example/' || k || '.json?a=1&b=2' AS json_data,
    array_to_string(['GHSA-' || (k + j) FOR j IN range(0, k % 4)], ' ') AS aliases,
    CASE WHEN k % 13 = 0 THEN '' ELSE strftime(published_at, '%Y-%m-%dT%H:%M:%SZ') END AS published,
    strftime(published_at + to_days(1), '%Y-%m-%dT%H:%M:%S.150Z') AS modified,
    CASE WHEN NOT has_severity THEN ''
         ELSE score || ' (' || band || ') CVSS_V' || v || ' - ' || vector ||
              CASE WHEN k % 19 = 0 THEN ' 9.1 (Critical) CVSS_V3 - CVSS:3.0/AV:L/AC:H' ELSE '' END
    END AS severity,
    CASE WHEN has_severity AND k % 21 <> 0 THEN score ELSE '' END AS cvss_score,
    CASE WHEN has_severity AND k % 21 <> 0 THEN 'CVSS_V' || v ELSE '' END AS cvss_version,
    CASE WHEN NOT has_severity OR k % 21 = 0 THEN '' WHEN v <> 2 THEN vector
         WHEN k % 19 = 0 THEN 'CVSS:3.0/AV:L/AC:H' ELSE '' END AS cvss_vector,
    p_name || ' ' || p_brand || ' & ' || p_type AS summary,
    p_name || ' is affected. Size ' || p_size || ' only' AS details,
    CASE WHEN has_packages THEN p_brand ELSE '' END AS ecosystem,
    CASE WHEN has_packages THEN p_name ELSE '' END AS package,
    CASE WHEN has_ranges THEN p_type ELSE '' END AS range_type,
    CASE WHEN has_ranges THEN 'https://git.example/' || k ELSE '' END AS repo,
    CASE WHEN has_ranges THEN CAST((k % 3) * 10 + k % 7 AS VARCHAR) ELSE '' END AS introduced,
    CASE WHEN has_ranges AND k % 5 <> 0
         THEN CAST((k % 3) * 10 + k % 7 + 5 AS VARCHAR) ELSE '' END AS fixed,
    CASE WHEN k % 6 = 0 THEN 'CWE-20' ELSE 'CWE-' || p_size || '; CWE-' || (k % 20) END AS cwe_ids,
    p_brand AS cna_assigner,
    array_to_string(['https://r.example/' || (k * 7 + j) FOR j IN range(0, least(k % 6 + 1, 3))], '; ')
      AS "references",
    k % 23 = 0 AS id_mismatch,
    CASE WHEN k % 29 = 0 THEN 'http_error' WHEN k % 10 = 0 THEN 'page_not_found'
         WHEN k % 11 = 0 THEN 'details_not_found' END AS reject_reason
  FROM cells
), adv AS (
  SELECT * FROM pages_expected WHERE reject_reason IS NULL
)
"""

FIELDS = """cve_id, source, import_source, json_data, aliases, published, modified, severity,
  cvss_score, cvss_version, cvss_vector, summary, details, ecosystem, package, range_type, repo,
  introduced, fixed, cwe_ids, cna_assigner, "references\""""

# The ids of ``samples.listing_pages`` at the first place each is listed.
LISTED = r"""
WITH keys AS (
  SELECT DISTINCT CAST(year(o_orderdate) + 24 AS BIGINT) AS year, o_orderkey AS k FROM orders
), listed AS (
  SELECT year, k, k // 1000 AS dir FROM keys
  UNION ALL SELECT year, k, k // 1000 + 1 FROM keys WHERE k % 100 = 0
), readable AS (
  SELECT * FROM listed WHERE year BETWEEN 2020 AND 2026 AND (dir + year) % 7 <> 0
), chunks AS (
  SELECT year, dir, dir // 1000 AS page_no,
         row_number() OVER (PARTITION BY year, dir // 1000 ORDER BY dir DESC) AS dir_pos
  FROM (SELECT DISTINCT year, dir FROM listed WHERE year BETWEEN 2020 AND 2026) d
), found AS (
  SELECT year, k, dir, page_no, dir_pos,
         row_number() OVER (PARTITION BY year, k ORDER BY page_no, dir_pos) AS seen
  FROM readable JOIN chunks USING (year, dir)
), firsts AS (
  SELECT year, k, dir, page_no, dir_pos,
    row_number() OVER (ORDER BY year, page_no, dir_pos, k DESC) AS nth,
    'CVE-' || year || '-' ||
      CASE WHEN length(CAST(k AS VARCHAR)) < 4 THEN lpad(CAST(k AS VARCHAR), 4, '0')
           ELSE CAST(k AS VARCHAR) END AS cve_id
  FROM found WHERE seen = 1
)
"""

SPACES = (
    r"[\s\x{1c}-\x{1f}\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def _pad(number: str) -> str:
    return (
        f"CASE WHEN length(CAST({number} AS VARCHAR)) < 4 "
        f"THEN lpad(CAST({number} AS VARCHAR), 4, '0') ELSE CAST({number} AS VARCHAR) END"
    )


def _normal(text: str) -> str:
    return f"trim(regexp_replace({text}, '{SPACES}+', ' ', 'g'))"


CUSTOMER_IDS = f"""
WITH wanted AS (
  SELECT 'CVE-2024-' || {_pad('o_custkey')} AS cve_id, min(o_orderkey) AS ord
  FROM orders GROUP BY 1
), existing AS (
  SELECT CASE WHEN c_acctbal < 0 THEN 'CVE-2024-' ELSE 'CVE-2023-' END || {_pad('c_custkey')} AS cve_id FROM customer
), pending AS (
  SELECT * FROM wanted w WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE e.cve_id = w.cve_id)
)
"""

CRAWL = f"""
WITH log AS (
  SELECT 'CVE-2024-' || {_pad('user_id')} AS cve_id, CAST(1 + event_id % 9 AS BIGINT) AS attempt, ts,
    CASE event_type WHEN 'view' THEN 200 WHEN 'click' THEN 429 WHEN 'purchase' THEN 503
                    WHEN 'signup' THEN 404 END AS status,
    CASE event_id % 6 WHEN 0 THEN '7' WHEN 1 THEN 'soon' WHEN 2 THEN '-1' WHEN 3 THEN ''
                      WHEN 4 THEN ' 9_0 ' END AS retry_after
  FROM events
), classed AS (
  SELECT *, CASE WHEN status IS NULL THEN 'no_response' WHEN status = 200 THEN 'ok'
                 WHEN status = 429 THEN 'rate_limited' WHEN status >= 500 THEN 'server_error'
                 ELSE 'permanent' END AS response
  FROM log
)
"""

# Where the latest attempt leaves each id.
OUTCOMES = f"""{CRAWL},
latest AS (
  SELECT *, row_number() OVER (PARTITION BY cve_id ORDER BY attempt DESC, ts DESC) AS rn FROM classed
), waits AS (
  SELECT cve_id, attempt, ts, status, response,
    CASE WHEN response = 'rate_limited' THEN
           CASE WHEN coalesce(retry_after, '') = '' THEN least(60 * attempt, 300)
                WHEN retry_after = '7' THEN 7 WHEN retry_after = ' 9_0 ' THEN 90
                WHEN retry_after = 'soon' THEN 60 END
         WHEN response IN ('server_error', 'no_response') THEN least(30 * attempt, 180) END AS wait
  FROM latest WHERE rn = 1
), outcomes AS (
  SELECT *, CASE WHEN response = 'ok' THEN 'ok' WHEN wait IS NULL THEN 'permanent'
                 WHEN attempt >= 8 THEN 'exhausted' ELSE 'retry' END AS outcome FROM waits
)
"""

ORACLES = {
    # Sources and sinks
    "id_lines": rf"""
        WITH lines AS (
          SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS n
          FROM (SELECT doc_id, regexp_split_to_array(text, '\r\n|\r|\n') AS l FROM documents) d
        ), kept AS (
          SELECT doc_id, n, regexp_replace(line, '^{SPACES}+|{SPACES}+$', '', 'g') AS line FROM lines
        )
        SELECT row_number() OVER (ORDER BY doc_id, n) AS ord, md5(line) AS line_md5
        FROM kept WHERE line <> ''""",
    "id_list_file": f"""
        SELECT row_number() OVER (ORDER BY y, o_orderkey) AS ord, 'CVE-' || y || '-' || {_pad('o_orderkey')} AS cve_id
        FROM (SELECT DISTINCT year(o_orderdate) AS y, o_orderkey FROM orders) o""",
    "csv_dataset": f"{PARTS} SELECT {FIELDS} FROM adv",
    "page_addresses": f"""
        SELECT '{ADVISORY_BASE}CVE-' || (2020 + p_partkey % 7) || '-' || {_pad('p_partkey')} AS address,
               '{LISTING_BASE}/' || (2020 + p_partkey % 7) AS year_page,
               '{LISTING_BASE}/' || (2020 + p_partkey % 7) || '/' || (p_partkey // 1000) || 'xxx' AS range_page
        FROM part""",
    # Page structure
    "link_extract": """
        SELECT page_id, CAST(generate_subscripts(l, 1) - 1 AS BIGINT) AS link_pos, unnest(l) AS href
        FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS l FROM pages) p""",
    # Titles may be cut within an entity, which then lacks its semicolon.
    "page_title": r"""
        SELECT page_id, trim(regexp_replace(
                 regexp_replace(regexp_replace(regexp_replace(regexp_replace(
                   regexp_extract(html, '<h1>(.*?)</h1>', 1, 's'),
                   '&quot;?', '"', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&amp;?', '&', 'g'),
                 '\s+', ' ', 'g')) AS title FROM pages""",
    "text_normalise": f"SELECT doc_id, md5({_normal('text')}) AS text_md5 FROM documents",
    "details_text": f"""
        SELECT doc_id, length({_normal('text')}) AS n_chars, md5({_normal('text')}) AS details_md5
        FROM documents""",
    # Advisory fields
    "advisory_fields": f"{PARTS} SELECT {FIELDS} FROM adv",
    "severity_parse": f"""{PARTS}
        SELECT cve_id, severity, cvss_score, cvss_version, cvss_vector FROM adv""",
    "events_range": f"""{PARTS}
        SELECT cve_id, ecosystem, package, range_type, repo, introduced, fixed FROM adv""",
    "event_history": f"""{PARTS}
        SELECT cve_id, pos, kind, value FROM (
          SELECT a.cve_id, CAST(CASE WHEN c.k % 5 = 0 THEN 2 * j + 1 ELSE 4 * j + 1 END AS BIGINT) AS pos,
                 'introduced' AS kind, CAST(j * 10 + c.k % 7 AS VARCHAR) AS value
          FROM adv a JOIN cells c USING (k), range(0, 3) r(j) WHERE c.has_ranges AND j <= c.k % 3
          UNION ALL
          SELECT a.cve_id, CAST(4 * j + 3 AS BIGINT), 'fixed', CAST(j * 10 + c.k % 7 + 5 AS VARCHAR)
          FROM adv a JOIN cells c USING (k), range(0, 3) r(j)
          WHERE c.has_ranges AND j <= c.k % 3 AND c.k % 5 <> 0
        ) e""",
    "cwe_cna": f"{PARTS} SELECT cve_id, cwe_ids, cna_assigner FROM adv",
    "reference_links": f"""{PARTS}
        SELECT cve_id, CAST(j AS BIGINT) AS link_pos, 'https://r.example/' || (k * 7 + j) AS href
        FROM adv, range(0, 3) r(j) WHERE j <= k % 6""",
    "rejects": f"""{PARTS}
        SELECT cve_id, reject_reason FROM pages_expected WHERE reject_reason IS NOT NULL""",
    "id_mismatch": f"{PARTS} SELECT cve_id, id_mismatch FROM adv",
    # Index
    "index_directories": f"""{LISTED}
        SELECT year, dir || 'xxx' AS directory, page_no,
               dense_rank() OVER (PARTITION BY year, page_no ORDER BY dir_pos) AS nth FROM chunks""",
    "index_ids": f"{LISTED} SELECT cve_id, year, dir || 'xxx' AS directory FROM firsts",
    "index_first_n": f"{LISTED} SELECT cve_id FROM firsts WHERE nth <= 5000",
    "index_first_n_by_totals": f"""{LISTED}
        SELECT cve_id FROM firsts WHERE nth <= (SELECT count(*) // 2 FROM firsts)""",
    "index_year_counts": f"""{LISTED}
        SELECT year, CAST(sum(n) AS BIGINT) AS new_ids,
               CAST(sum(sum(n)) OVER (ORDER BY year) AS BIGINT) AS total
        FROM (SELECT DISTINCT year, 0 AS n FROM chunks UNION ALL
              SELECT year, count(*) FROM firsts GROUP BY year) y GROUP BY year""",
    "index_running_counts": f"""{LISTED}
        SELECT year, dir || 'xxx' AS directory, new_ids,
               CAST(sum(new_ids) OVER (PARTITION BY year ORDER BY page_no, dir_pos
                    ROWS UNBOUNDED PRECEDING) AS BIGINT) AS collected
        FROM (SELECT c.year, c.dir, c.page_no, c.dir_pos, count(f.k) AS new_ids
              FROM chunks c LEFT JOIN firsts f ON f.year = c.year AND f.dir = c.dir
              WHERE (c.dir + c.year) % 7 <> 0 GROUP BY ALL) n""",
    "index_totals": f"""{LISTED}
        SELECT count(*) AS discovered, least(count(*), 5000) AS saved FROM firsts""",
    "id_rank": f"""
        SELECT cve_id, row_number() OVER (ORDER BY y, k) AS position FROM (
          SELECT DISTINCT year(o_orderdate) AS y, o_orderkey AS k,
                 'CVE-' || year(o_orderdate) || '-' || {_pad('o_orderkey')} AS cve_id FROM orders) o""",
    "id_preview": f"""{LISTED},
        kept AS (SELECT cve_id, row_number() OVER (ORDER BY year, k) AS up,
                        row_number() OVER (ORDER BY year DESC, k DESC) AS down
                 FROM firsts WHERE nth <= 5000)
        SELECT 'first' AS part, cve_id FROM kept WHERE up <= 20
        UNION ALL SELECT 'last', cve_id FROM kept WHERE down <= 10""",
    # Joins, limits and set operations of a run
    "pending": f"{CUSTOMER_IDS} SELECT cve_id, ord FROM pending",
    "until_target": f"""{CUSTOMER_IDS}
        SELECT cve_id FROM existing
        UNION ALL
        SELECT cve_id FROM (SELECT cve_id, row_number() OVER (ORDER BY ord) AS n FROM pending) p
        WHERE n <= 2000 - (SELECT count(*) FROM existing)""",
    "run_counters": f"""{PARTS}
        SELECT (SELECT count(*) FROM part) AS ids_available, CAST(0 AS BIGINT) AS existing_rows,
               CAST(0 AS BIGINT) AS already_collected, (SELECT count(*) FROM adv) AS successes,
               (SELECT count(*) FROM pages_expected WHERE reject_reason IS NOT NULL) AS skipped,
               (SELECT count(*) FROM adv) AS final_rows""",
    "collect_runs": f"""{PARTS}
        SELECT cve_id, CAST(CASE WHEN reject_reason IS NULL THEN 1 ELSE 2 END AS BIGINT) AS run, k AS ord, package, cwe_ids
        FROM pages_expected WHERE reject_reason IS NULL
           OR (reject_reason = 'http_error' AND k % 10 <> 0 AND k % 11 <> 0)""",
    "csv_resume": f"""{PARTS}
        SELECT cve_id, CAST(CASE WHEN reject_reason IS NULL THEN 0 ELSE 1 END AS BIGINT) AS run, package, cwe_ids
        FROM pages_expected WHERE reject_reason IS NULL
           OR (reject_reason = 'http_error' AND k % 10 <> 0 AND k % 11 <> 0)""",
    "csv_bad_rows": f"""{PARTS}, given AS (
          SELECT k, cve_id, p_name || ', "new"' || chr(10) || 'size ' || p_size AS summary,
                 ',,,,,,,,,,,"' || p_name || ', ""new""' || chr(10) || 'size ' || p_size || '",x,x,x,x,x,x,x,x,x,https://r.example/' || k AS cells
          FROM (SELECT k, cve_id, details FROM pages_expected) JOIN part_rows USING (k)
        )
        SELECT 'row' AS kind, cve_id || '|' || summary || '|https://r.example/' || k AS content FROM given WHERE k % 7 <> 0 AND k % 11 <> 0
        UNION ALL SELECT 'bad', cve_id || ',' || p_name || ',cut' FROM given JOIN part_rows USING (k) WHERE k % 7 = 0
        UNION ALL SELECT 'bad', cve_id || cells || ',more' FROM given WHERE k % 7 <> 0 AND k % 11 = 0""",
    "profile_over_runs": f"""{PARTS}, kept AS (
          SELECT * FROM pages_expected WHERE reject_reason IS NULL
           OR (reject_reason = 'http_error' AND k % 10 <> 0 AND k % 11 <> 0)
        ) """ + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS rows, count(nullif("{c}", '')) AS filled, TRUE AS is_near FROM kept"""
        for c in RAW_COLUMNS
    ),
    "score_summary_over_runs": f"""{PARTS}
        SELECT nullif(ecosystem, '') AS ecosystem, CAST(count(*) AS BIGINT) AS scored, min(t) / 10 AS min_score,
               CAST(sum(t) AS DOUBLE) / (count(*) * 10) AS avg_score, max(t) / 10 AS max_score,
               quantile_cont(CAST(t AS DOUBLE), 0.5) / 10 AS median_score
        FROM (SELECT ecosystem, k % 101 AS t FROM pages_expected WHERE cvss_score <> '' AND (reject_reason IS NULL
           OR (reject_reason = 'http_error' AND k % 10 <> 0 AND k % 11 <> 0))) s
        GROUP BY 1""",
    "collect_to_target": f"""{PARTS}
        SELECT cve_id, k AS ord FROM (SELECT cve_id, k, row_number() OVER (ORDER BY k) AS n FROM adv) a
        WHERE n <= 2000""",
    "run_rejects": f"""{PARTS}
        SELECT cve_id, reject_reason,
               CASE WHEN reject_reason = 'http_error' THEN 'permanent' END AS reject_detail
        FROM pages_expected WHERE reject_reason IS NOT NULL
        UNION ALL
        SELECT 'CVE-2019-' || {_pad('s_suppkey')}, 'not_fetched', NULL FROM supplier""",
    "run_counters_to_target": f"""{PARTS},
        tried AS (
          SELECT *, coalesce(sum(CASE WHEN reject_reason IS NULL THEN 1 ELSE 0 END)
                     OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS had FROM pages_expected
        ), room AS (SELECT greatest(1, count(*) // 4) AS n FROM part),
        run AS (
          SELECT count(*) FILTER (WHERE reject_reason IS NULL) AS good, count(*) FILTER (WHERE reject_reason IS NOT NULL) AS bad
          FROM tried, room WHERE had < n
        )
        SELECT (SELECT count(*) FROM part) AS ids_available, CAST(0 AS BIGINT) AS existing_rows,
               CAST(0 AS BIGINT) AS already_collected, good AS successes, bad AS skipped, good AS final_rows FROM run""",
    "target_rejects": f"""{PARTS},
        tried AS (
          SELECT *, coalesce(sum(CASE WHEN reject_reason IS NULL THEN 1 ELSE 0 END)
                     OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS had FROM pages_expected
        ), room AS (SELECT greatest(1, count(*) // 4) AS n FROM part)
        SELECT cve_id, reject_reason, CASE WHEN reject_reason = 'http_error' THEN 'permanent' END AS reject_detail
        FROM tried, room WHERE reject_reason IS NOT NULL AND had < n""",
    "stream_ingest": f"""{PARTS}
        SELECT cve_id, CAST(1 AS BIGINT) AS copies, package, cwe_ids FROM pages_expected WHERE reject_reason IS NULL
           OR (reject_reason = 'http_error' AND k % 10 <> 0 AND k % 11 <> 0)""",
    # Crawl log
    "response_class": f"{CRAWL} SELECT response, count(*) AS n FROM classed GROUP BY response",
    "fetch_outcome": f"""{OUTCOMES}
        SELECT cve_id, attempt, CAST(status AS BIGINT) AS status, outcome,
               CAST(CASE WHEN outcome = 'retry' THEN wait ELSE 0 END AS BIGINT) AS wait_seconds
        FROM outcomes""",
    "live_frontier": f"""{OUTCOMES}
        SELECT cve_id, attempt, outcome, CAST(CASE WHEN outcome = 'retry' THEN wait ELSE 0 END AS BIGINT) AS wait_seconds,
               CASE WHEN outcome = 'retry' THEN epoch_ms(ts) + 1000 * wait END AS due_ms
        FROM outcomes""",
    # Analytics
    "typed_view": f"""{PARTS}
        SELECT cve_id, 2020 + k % 7 AS cve_year, k AS cve_seq,
          CASE WHEN k % 13 <> 0 THEN epoch_ms(TIMESTAMP '2024-01-01' + to_hours(CAST(k % 40000 AS INTEGER))) END AS published_ms,
          epoch_ms(TIMESTAMP '2024-01-02' + to_hours(CAST(k % 40000 AS INTEGER))) + 150 AS modified_ms,
          CAST(nullif(cvss_score, '') AS DOUBLE) AS cvss_score, nullif(cvss_version, '') AS cvss_version,
          CASE WHEN severity <> '' THEN regexp_extract(severity, '\\(([A-Za-z]+)\\)', 1) END AS severity_band,
          nullif(regexp_extract(cvss_vector, 'AV:([A-Z])', 1), '') AS attack_vector,
          nullif(fixed, '') AS fixed, CAST(k % 4 AS BIGINT) AS n_aliases,
          CAST(CASE WHEN k % 6 = 0 THEN 1 ELSE 2 END AS BIGINT) AS n_cwe, CAST(least(k % 6 + 1, 3) AS BIGINT) AS n_references
        FROM adv""",
    "column_profile": f"{PARTS} " + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS rows, count(nullif("{c}", '')) AS filled,
            count(DISTINCT nullif("{c}", '')) AS distinct_values FROM adv"""
        for c in FIELDS.replace('"', "").replace("\n", " ").replace(" ", "").split(",")
    ),
    "severity_dist": f"""{PARTS}
        SELECT severity_band, count(*) AS n, count(*) / CAST((SELECT count(*) FROM adv) AS DOUBLE) AS share
        FROM (SELECT CASE WHEN severity = '' THEN 'none'
                     ELSE regexp_extract(severity, '\\(([A-Za-z]+)\\)', 1) END AS severity_band FROM adv) b
        GROUP BY severity_band""",
    **{
        f"score_summary_by_{by.removeprefix('cvss_')}": f"""{PARTS}
        SELECT nullif({by}, '') AS {by}, count(*) AS scored, min(t) / 10 AS min_score,
               CAST(sum(t) AS DOUBLE) / (count(*) * 10) AS avg_score, max(t) / 10 AS max_score,
               quantile_cont(CAST(t AS DOUBLE), 0.5) / 10 AS median_score
        FROM (SELECT {by}, k % 101 AS t FROM adv WHERE cvss_score <> '') s GROUP BY 1"""
        for by in ("cvss_version", "ecosystem")
    },
    "score_histogram": f"""{PARTS}
        SELECT least(floor(CAST(cvss_score AS DOUBLE)), 9)::BIGINT AS bin, count(*) AS n
        FROM adv WHERE cvss_score <> '' GROUP BY 1""",
    "top_cwes": f"""{PARTS}
        SELECT cwe_id, count(*) AS n FROM (
          SELECT unnest(list_distinct(string_split(cwe_ids, '; '))) AS cwe_id FROM adv) c
        GROUP BY cwe_id ORDER BY n DESC, cwe_id LIMIT 10""",
    "ecosystem_counts": f"""{PARTS}
        SELECT nullif(ecosystem, '') AS ecosystem, count(*) AS n FROM adv GROUP BY 1""",
    "top_packages": f"""{PARTS}
        SELECT * FROM (
          SELECT ecosystem, package, n,
                 row_number() OVER (PARTITION BY ecosystem ORDER BY n DESC, package) AS place
          FROM (SELECT ecosystem, package, count(*) AS n FROM adv WHERE package <> '' GROUP BY ALL) g) r
        WHERE place <= 3""",
    "monthly_trend": f"""{PARTS}
        SELECT month, n, CAST(sum(n) OVER (ORDER BY month) AS BIGINT) AS running_total FROM (
          SELECT substr(published, 1, 7) AS month, count(*) AS n FROM adv WHERE published <> '' GROUP BY 1) m""",
    "vector_metrics": f"""{PARTS}
        SELECT split_part(p, ':', 1) AS metric, split_part(p, ':', 2) AS value, count(*) AS n FROM (
          SELECT unnest(string_split(regexp_replace(cvss_vector, '^CVSS:[^/]+/', ''), '/')) AS p
          FROM adv WHERE cvss_vector <> '') v GROUP BY ALL""",
    "fix_share": f"""{PARTS}
        SELECT nullif(ecosystem, '') AS ecosystem, count(*) AS n, count(nullif(fixed, '')) AS with_fix,
               count(nullif(fixed, '')) / CAST(count(*) AS DOUBLE) AS fix_share FROM adv GROUP BY 1""",
}
