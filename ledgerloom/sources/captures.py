"""Captured answers of web, DNS and mail servers as tables; there is no network code.

A live adapter writes tables of these columns. The SELECTs derive such tables from the
supplier table, in a form both Spark and DuckDB read alike, with the cases the facts know.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sources.tables import table

#: What a crawler calls itself.
AGENT = "ledgerloom"

_SITE = "concat('site', CAST(s_suppkey AS string), '.in')"
_HOME = """concat('<html><head><title> Site ', CAST(s_suppkey AS string), ' </title>', CASE WHEN s_suppkey % 2 = 0 THEN '<link rel="shortcut icon" href="/i/fav.png">' ELSE '' END,
 '</head><body><a href="mailto:about@x.in">about</a><a class="n" href="/about-us">Who we <b>are</b></a><a href="contact">Write</a><a href="https://other.in/careers">Jobs</a><a href="#team">Team</a><a href="/privacy">Privacy</a></body></html>')"""
RESPONSES_SQL = f"""
SELECT s_suppkey AS company_id, 'https' AS kind, concat('https://', {_SITE}) AS requested_url,
  CASE WHEN s_suppkey % 5 = 0 THEN CAST(NULL AS int) WHEN s_suppkey % 7 = 0 THEN 404 ELSE 200 END AS status,
  CASE WHEN s_suppkey % 5 = 0 THEN CAST(NULL AS string) WHEN s_suppkey % 3 = 0 THEN concat('https://', {_SITE}, '/') WHEN s_suppkey % 3 = 1 THEN concat('https://www.', {_SITE}, '/home/') ELSE concat('https://', {_SITE}) END AS final_url,
  CASE WHEN s_suppkey % 5 = 0 THEN CAST(NULL AS string) WHEN s_suppkey % 11 = 0 THEN 'application/json' ELSE 'text/HTML; charset=utf-8' END AS content_type,
  CASE WHEN s_suppkey % 5 = 0 THEN CAST(NULL AS string) WHEN s_suppkey % 13 = 0 THEN 'cloudflare' WHEN s_suppkey % 2 = 0 THEN 'nginx/1.18 (Ubuntu)' END AS server,
  CASE WHEN s_suppkey % 5 = 0 THEN CAST(NULL AS string) ELSE {_HOME} END AS body, CASE WHEN s_suppkey % 5 = 0 THEN 'ConnectError: refused' END AS error FROM supplier
UNION ALL SELECT s_suppkey, 'http', concat('http://', {_SITE}), CASE WHEN s_suppkey % 10 = 0 THEN CAST(NULL AS int) ELSE 200 END, CASE WHEN s_suppkey % 10 = 0 THEN CAST(NULL AS string) ELSE concat('http://', {_SITE}, '/') END,
  CASE WHEN s_suppkey % 10 = 0 THEN CAST(NULL AS string) ELSE 'text/html' END, CAST(NULL AS string), CASE WHEN s_suppkey % 10 = 0 THEN CAST(NULL AS string) ELSE {_HOME} END, CASE WHEN s_suppkey % 10 = 0 THEN 'ConnectTimeout: slow' END FROM supplier WHERE s_suppkey % 5 = 0
UNION ALL SELECT s_suppkey, 'robots', concat('https://', {_SITE}, '/robots.txt'), CASE WHEN s_suppkey % 3 = 1 THEN 404 ELSE 200 END, concat('https://', {_SITE}, '/robots.txt'), 'text/plain', CAST(NULL AS string),
  CASE WHEN s_suppkey % 3 = 0 THEN concat('User-agent: other', chr(10), 'Disallow: /', chr(10), chr(10), 'User-agent: *', chr(10), 'Disallow: /privacy') WHEN s_suppkey % 12 = 2 THEN concat('User-agent: *', chr(10), 'Disallow: /') ELSE ' ' END, CAST(NULL AS string) FROM supplier
UNION ALL SELECT s_suppkey, 'page', concat('https://', CASE WHEN s_suppkey % 3 = 1 THEN 'www.' ELSE '' END, {_SITE}, p.path), p.status, concat('https://', {_SITE}, p.path), p.kind, CAST(NULL AS string), '<p>page</p>', CAST(NULL AS string)
  FROM supplier CROSS JOIN (SELECT '/about-us' AS path, 200 AS status, 'text/html' AS kind UNION ALL SELECT '/contact', 404, 'text/html' UNION ALL SELECT '/home/contact', 200, 'application/pdf' UNION ALL SELECT '/privacy', 200, 'text/html') p
"""
ANSWERS_SQL = f"""
SELECT {_SITE} AS name, 'A' AS rtype, CASE WHEN s_suppkey % 6 = 0 THEN '185.199.108.153' ELSE concat('10.0.0.', CAST(s_suppkey % 250 AS string)) END AS value, 1 AS pos FROM supplier WHERE s_suppkey % 9 <> 0
UNION ALL SELECT {_SITE}, 'NS', CASE WHEN s_suppkey % 4 = 0 THEN 'kate.NS.cloudflare.com.' WHEN s_suppkey % 4 = 1 THEN 'ns1.domaincontrol.com.' ELSE concat('ns.', {_SITE}, '.') END, 1 FROM supplier
UNION ALL SELECT {_SITE}, 'MX', concat('20 mail.', {_SITE}, '.'), 1 FROM supplier WHERE s_suppkey % 3 <> 0
UNION ALL SELECT {_SITE}, 'MX', concat('5 alt.', {_SITE}, '.'), 2 FROM supplier WHERE s_suppkey % 3 = 1
UNION ALL SELECT {_SITE}, 'MX', 'mailonly', 3 FROM supplier WHERE s_suppkey % 8 = 1
UNION ALL SELECT {_SITE}, 'TXT', '"site-verification=1"', 1 FROM supplier
UNION ALL SELECT {_SITE}, 'TXT', '"V=spf1 include:x.in ~all"', 2 FROM supplier WHERE s_suppkey % 2 = 0
UNION ALL SELECT concat('_dmarc.', {_SITE}), 'TXT', '"v=DMARC1; p=none"', 1 FROM supplier WHERE s_suppkey % 5 = 0
UNION ALL SELECT {_SITE}, 'PTR', CASE WHEN s_suppkey % 7 = 0 THEN 'ec2.amazonaws.com' ELSE 'host.example' END, 1 FROM supplier WHERE s_suppkey % 9 <> 0
"""

#: The tables a run keeps, by name.
SCHEMAS = {
    "companies": "id bigint, startup_india_id string, name string, website string, domain string, industry string, sector string, stage string, city string, state string, registration_date string, cin string, dpiit_certified boolean, status string, phone string, role string, duplicate_count int, created_at timestamp, updated_at timestamp",
    "company_sources": "company_id bigint, startup_india_id string",
    "website_probes": "company_id bigint, domain string, input_url string, resolved boolean, alive boolean, http_status int, https_ok boolean, redirected boolean, final_url string, final_scheme string, title string, favicon_url string, has_robots boolean, robots_url string, server_header string, error string, checked_at timestamp",
    "dns_records": "company_id bigint, domain string, a_records array<string>, ns_records array<string>, mx_records array<string>, has_mx boolean, spf string, dmarc string, hosting_provider string, checked_at timestamp",
    "crawled_pages": "id bigint, company_id bigint, page_type string, url string, http_status int, content_type string, stored_path string, byte_size bigint, fetched_at timestamp",
    "company_enrichment": "company_id bigint, extracted_name string, description string, logo_url string, founded_year int, employee_count string, address string, updated_at timestamp",
    "company_emails": "company_id bigint, email string, source_page string",
    "company_phones": "company_id bigint, phone string, source_page string",
    "company_socials": "company_id bigint, platform string, url string",
    "company_tech": "company_id bigint, technology string, category string, evidence string",
    "company_contacts": "id bigint, company_id bigint, email string, contact_type string, name string, source string, confidence double, found_on string, verified string, last_checked timestamp",
}


def reset(spark: SparkSession, folder: str, names: tuple[str, ...] = tuple(SCHEMAS)) -> None:
    """Creates the tables below ``folder`` empty, in place of what was there."""
    for name in names:
        spark.createDataFrame([], SCHEMAS[name]).write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{name}.parquet")


def derived(spark: SparkSession, folder: str, select: str) -> DataFrame:
    text = select.replace("{", "{{").replace("}", "}}").replace("FROM supplier", "FROM {supplier}")
    return spark.sql(text, supplier=table(spark, folder, "supplier"))


def allowed(urls: DataFrame, robots: DataFrame, key: str, url: str, text: str, agent: str = AGENT) -> DataFrame:
    """Rows of ``urls`` that the robots text of their key allows; a key without text, and a null text, allow all."""
    kind = urls.schema

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from urllib.robotparser import RobotFileParser

        for b in batches:
            fine, parsed = [], {}
            for t, u in zip(b._robots, b[url]):
                if t not in parsed:
                    parsed[t] = RobotFileParser()
                    parsed[t].parse((t or "").splitlines())
                fine.append(not t or parsed[t].can_fetch(agent, u))
            yield b.loc[fine].drop(columns="_robots")

    return urls.join(robots.select(key, F.col(text).alias("_robots")), key, "left").mapInPandas(keep, kind)
