"""Queries over captured answers of web, DNS and mail servers, and over contacts made from them, with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.dictionaries import ANALYTICS_ID_PATTERN, DISPOSABLE_DOMAINS, EMAIL_PATTERN, GITHUB_PAGES_IPS, HOSTING_SIGNS, PAGE_WORDS, PATTERN_LOCALS, TECHNOLOGIES, USELESS_STATUSES
from ledgerloom.functions import completions, mail, records, urls, web
from ledgerloom.operators import merging
from ledgerloom.plans import sql
from ledgerloom.sources import captures, pages, raw
from ledgerloom.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]

RESPONSES = f"responses AS MATERIALIZED ({captures.RESPONSES_SQL})"
ANSWERS = f"answers AS MATERIALIZED ({captures.ANSWERS_SQL})"


def _is_html(kind: Column) -> Column:
    return F.coalesce(F.contains(F.lower(kind), F.lit("html")), F.lit(False))


def homes(responses: DataFrame) -> DataFrame:
    """The answer of each company's site, over https where there is one, else over http; ``failed`` tells why there is none."""
    part = responses.where("kind in ('https', 'http')")
    row = F.struct("requested_url", "status", "final_url", "content_type", "server", "body")
    sides = part.groupBy("company_id").agg(*(F.max(F.when((F.col("kind") == k) & F.col("error").isNull(), row)).alias(k) for k in ("https", "http")), F.max(F.when(F.col("kind") == "http", F.col("error"))).alias("late"), F.max("error").alias("any"))
    best = F.coalesce("https", "http")
    return sides.select("company_id", F.col("https").isNotNull().alias("https_ok"), best.alias("r"), F.when(best.isNull(), F.coalesce("late", "any", F.lit("unreachable"))).alias("failed"))


def probes(responses: DataFrame) -> DataFrame:
    """The probe record of each company from its captured answers."""
    found = homes(responses)
    robots = responses.where("kind = 'robots'").select("company_id", F.col("requested_url").alias("robots_at"), ((F.col("status") == 200) & (F.trim(F.coalesce("body", F.lit(""))) != "")).alias("robots_there"))
    r = F.col("r")
    read = _is_html(r.content_type) & (r.status < 400)
    bare = lambda x: F.regexp_replace(x, "/+$", "")
    there = r.isNotNull()
    return found.join(robots, "company_id", "left").select(
        "company_id", F.coalesce(r.status < 400, F.lit(False)).alias("alive"), r.status.alias("http_status"), "https_ok", F.coalesce(bare(r.final_url) != bare(r.requested_url), F.lit(False)).alias("redirected"), r.final_url.alias("final_url"),
        F.when(there, F.substring_index(r.final_url, ":", 1)).alias("final_scheme"), F.when(read, web.title(r.body)).alias("title"), F.when(read, web.favicon(r.body, r.final_url)).alias("favicon_url"),
        F.when(there, F.coalesce("robots_there", F.lit(False))).alias("has_robots"), F.when(there, F.col("robots_at")).alias("robots_url"), r.server.alias("server_header"), F.col("failed").alias("error"),
    )


_ORIGIN = lambda x: rf"regexp_extract({x}, '^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*', 0)"


def _join_sql(base: str, href: str) -> str:
    bare = f"regexp_replace({base}, '[?#].*$', '')"
    folder = f"CASE WHEN {bare} = {_ORIGIN(base)} THEN {_ORIGIN(base)} || '/' ELSE regexp_replace({bare}, '[^/]*$', '') END"
    return rf"CASE WHEN regexp_matches({href}, '^[a-zA-Z][a-zA-Z0-9+.\-]*:') THEN {href} WHEN starts_with({href}, '//') THEN split_part({_ORIGIN(base)}, '//', 1) || {href} WHEN starts_with({href}, '/') THEN {_ORIGIN(base)} || {href} ELSE {folder} || {href} END"


HOMES = f"""homes AS (SELECT company_id, https_ok, coalesce(s.requested_url, p.requested_url) AS requested_url, coalesce(s.status, p.status) AS status, coalesce(s.final_url, p.final_url) AS final_url, CASE WHEN https_ok THEN s.content_type ELSE p.content_type END AS content_type,
  CASE WHEN https_ok THEN s.server ELSE p.server END AS server, CASE WHEN https_ok THEN s.body ELSE p.body END AS body, CASE WHEN s.company_id IS NULL AND p.company_id IS NULL THEN coalesce(late, any_error, 'unreachable') END AS failed
  FROM (SELECT company_id, bool_or(kind = 'https' AND error IS NULL) AS https_ok, max(CASE WHEN kind = 'http' THEN error END) AS late, max(error) AS any_error FROM responses WHERE kind IN ('https', 'http') GROUP BY company_id)
  LEFT JOIN (SELECT * FROM responses WHERE kind = 'https' AND error IS NULL) s USING (company_id) LEFT JOIN (SELECT * FROM responses WHERE kind = 'http' AND error IS NULL) p USING (company_id))"""
_ICON = r"""regexp_extract(regexp_extract(body, '(?i)<link[^>]+rel=["'']?[^"''>]*icon[^"''>]*["'']?[^>]*>', 0), '(?i)href=["'']([^"'']+)["'']', 1)"""
PROBES_SQL = rf"""WITH {RESPONSES}, {HOMES},
rob AS (SELECT company_id, requested_url AS robots_at, status = 200 AND trim(coalesce(body, '')) <> '' AS there FROM responses WHERE kind = 'robots'),
x AS (SELECT *, status < 400 AND contains(lower(content_type), 'html') AS readable, coalesce(nullif({_ICON}, ''), '/favicon.ico') AS icon FROM homes LEFT JOIN rob USING (company_id))
SELECT company_id, coalesce(status < 400, false) AS alive, status AS http_status, https_ok, coalesce(rtrim(final_url, '/') <> rtrim(requested_url, '/'), false) AS redirected, final_url, split_part(final_url, ':', 1) AS final_scheme,
  CASE WHEN readable THEN nullif(substr(trim(regexp_replace(regexp_extract(body, '(?is)<title[^>]*>(.*?)</title>', 1), '\s+', ' ', 'g')), 1, 300), '') END AS title, CASE WHEN readable THEN {_join_sql('final_url', 'icon')} END AS favicon_url,
  CASE WHEN failed IS NULL THEN coalesce(there, false) END AS has_robots, CASE WHEN failed IS NULL THEN robots_at END AS robots_url, server AS server_header, failed AS error FROM x"""


def found_pages(responses: DataFrame) -> DataFrame:
    """(company_id, page_type, url) that the home pages lead to; a home page counts with any status if it is HTML."""
    rows = homes(responses).where(_is_html(F.col("r.content_type"))).select("company_id", F.col("r.body").alias("html"), F.col("r.final_url").alias("url"), F.regexp_replace(urls.domain(F.col("r.requested_url")), r"^www\.", "").alias("root"))
    return web.discovered(rows, "company_id", "html", "url", "root")


_HREF = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*"([^"]*)"[^>]*>(.*?)</a>"""


def _types_sql(hay: str, path: str) -> str:
    return ", ".join("CASE WHEN " + " OR ".join(f"contains({hay}, '{w}') OR contains({path}, '{w}')" for w in words) + f" THEN '{t}' END" for t, words in PAGE_WORDS.items())


def _found_sql(source: str) -> str:
    """CTEs links, kinds and found over ``source`` (key, html, base, root)."""
    return rf"""links AS (SELECT key, base, root, unnest(h) AS href, unnest(t) AS label, generate_subscripts(h, 1) AS pos FROM (SELECT key, base, root, list_transform(regexp_extract_all(html, '{_HREF}', 1), lambda x: trim(x)) AS h, list_transform(regexp_extract_all(html, '{_HREF}', 2), lambda x: {sql.collapse("regexp_replace(x, '<[^>]*>', ' ', 'g')")}) AS t FROM ({source}))),
joined AS (SELECT key, root, pos, {_join_sql('base', 'href')} AS url, lower(href || ' ' || label) AS hay FROM links WHERE href <> '' AND NOT regexp_matches(href, '^(?:mailto:|tel:|javascript:|#)')),
kinds AS (SELECT key, url, pos, unnest([{_types_sql('hay', 'path')}]) AS page_type FROM (SELECT *, lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*([^?#]*)', 1)) AS path, {sql.domain('url')} AS host FROM joined) WHERE host = root OR ends_with(host, '.' || root)),
found AS (SELECT key, page_type, first(url ORDER BY pos) AS url FROM kinds WHERE page_type IS NOT NULL GROUP BY key, page_type)"""


_HOME_PAGES = f"SELECT company_id AS key, body AS html, final_url AS base, {sql.domain('requested_url')} AS root FROM homes WHERE contains(lower(content_type), 'html')"
FOUND_SQL = f"WITH {RESPONSES}, {HOMES}, {_found_sql(_HOME_PAGES)} SELECT key AS company_id, page_type, url FROM found"


def crawl(responses: DataFrame) -> DataFrame:
    """The crawled_pages rows of each company that its robots text allows: its home, and if that is HTML the pages it leads to that were answered."""
    robots = responses.where("kind = 'robots' and status = 200 and body is not null").select("company_id", F.col("body").alias("robots"))
    home = homes(responses).where("r is not null").select("company_id", F.lit("home").alias("page_type"), F.col("r.requested_url").alias("asked"), F.col("r.final_url").alias("url"), F.col("r.status").alias("http_status"), F.col("r.content_type").alias("content_type"))
    home = captures.allowed(home, robots, "company_id", "asked", "robots")
    answers = responses.where("kind = 'page' and error is null").select("company_id", F.col("requested_url").alias("asked"), "final_url", "status", "content_type")
    rest = found_pages(responses).withColumnRenamed("url", "asked").join(home.select("company_id"), "company_id", "left_semi")
    rest = captures.allowed(rest, robots, "company_id", "asked", "robots").join(answers, ["company_id", "asked"]).select("company_id", "page_type", "asked", F.col("final_url").alias("url"), F.col("status").alias("http_status"), "content_type")
    every = home.unionByName(rest)
    path = pages.stored_path(F.regexp_replace(urls.domain(F.col("asked")), r"^www\.", ""), F.col("page_type"))
    return every.select("company_id", "page_type", "url", "http_status", "content_type", F.when(_is_html(F.col("content_type")) & (F.col("http_status") < 400), path).alias("stored_path"))


#: The robots texts of the captures forbid all of a site, or its /privacy.
_ALLOWED = lambda url: rf"(rules IS NULL OR NOT (ends_with(rules, 'User-agent: *' || chr(10) || 'Disallow: /') OR ends_with(rules, 'Disallow: /privacy') AND starts_with(regexp_extract({url}, '^https?://[^/]*(.*)$', 1), '/privacy')))"
CRAWL_SQL = rf"""WITH {RESPONSES}, {HOMES}, {_found_sql(_HOME_PAGES)}, rules AS (SELECT company_id, body AS rules FROM responses WHERE kind = 'robots' AND status = 200),
home AS (SELECT company_id, 'home' AS page_type, requested_url AS asked, final_url AS url, status AS http_status, content_type FROM homes LEFT JOIN rules USING (company_id) WHERE failed IS NULL AND {_ALLOWED('requested_url')}),
every AS (SELECT * FROM home UNION ALL SELECT f.key, f.page_type, f.url, r.final_url, r.status, r.content_type FROM found f JOIN home h ON h.company_id = f.key LEFT JOIN rules ON rules.company_id = f.key JOIN responses r ON r.company_id = f.key AND r.kind = 'page' AND r.requested_url = f.url WHERE {_ALLOWED('f.url')})
SELECT company_id, page_type, url, http_status, content_type, CASE WHEN contains(lower(content_type), 'html') AND http_status < 400 THEN concat_ws('/', substr(sha1(d), 1, 2), regexp_replace(d, '[^a-z0-9.\-]', '_', 'g'), page_type || '.html.gz') END AS stored_path
FROM (SELECT *, {sql.domain('asked')} AS d FROM every)"""


def dns_facts(answers: DataFrame) -> DataFrame:
    """Addresses, name servers, mail hosts, SPF, DMARC and hosting of each host from its DNS answers."""
    of = lambda kind: F.transform(F.array_sort(F.collect_list(F.when(F.col("rtype") == kind, F.struct("pos", "value")))), lambda x: x.value)
    own = answers.where(~F.col("name").startswith("_dmarc.")).groupBy(F.col("name").alias("domain")).agg(of("A").alias("a"), of("NS").alias("ns"), of("MX").alias("mx"), of("TXT").alias("txt"), of("PTR").alias("ptr"))
    policy = answers.where(F.col("name").startswith("_dmarc.") & (F.col("rtype") == "TXT")).groupBy(F.regexp_replace("name", r"^_dmarc\.", "").alias("domain")).agg(of("TXT").alias("dmarc_txt"))
    none = F.array().cast("array<string>")
    joined = own.join(policy, "domain", "left")
    return joined.select(
        "domain", F.array_join("a", " ").alias("a_records"), F.array_join(F.transform("ns", lambda x: F.regexp_replace(x, r"\.+$", "")), " ").alias("ns_records"), F.array_join(web.mail_hosts(F.col("mx")), " ").alias("mx_records"), (F.size("mx") > 0).alias("has_mx"),
        web.text_record(F.col("txt"), "v=spf1").alias("spf"), web.text_record(F.coalesce("dmarc_txt", none), "v=dmarc1").alias("dmarc"), web.hosting(F.col("a"), F.col("ns"), F.get("ptr", F.lit(0)), F.lit(None).cast("string")).alias("hosting_provider"),
    )


_SIGNS = " ".join(f"WHEN contains(hay, '{n}') THEN '{p}'" for n, p in HOSTING_SIGNS)
DNS_SQL = rf"""WITH {ANSWERS}, g AS (SELECT name AS domain, string_agg(value, ' ' ORDER BY pos) FILTER (WHERE rtype = 'A') AS a, string_agg(rtrim(value, '.'), ' ' ORDER BY pos) FILTER (WHERE rtype = 'NS') AS ns, string_agg(value, ' ' ORDER BY pos) FILTER (WHERE rtype = 'NS') AS ns_raw,
  string_agg(rtrim(coalesce(nullif(split_part(value, ' ', 2), ''), value), '.'), ' ' ORDER BY coalesce(try_cast(split_part(value, ' ', 1) AS INT), 999), pos) FILTER (WHERE rtype = 'MX') AS mx, first(trim(value, '"') ORDER BY pos) FILTER (WHERE rtype = 'TXT' AND contains(lower(value), 'v=spf1')) AS spf,
  first(value ORDER BY pos) FILTER (WHERE rtype = 'PTR') AS ptr, coalesce(bool_or(rtype = 'A' AND value IN ({sql.words(GITHUB_PAGES_IPS)})), false) AS github FROM answers WHERE NOT starts_with(name, '_dmarc.') GROUP BY name),
p AS (SELECT substr(name, 8) AS domain, first(trim(value, '"') ORDER BY pos) AS dmarc FROM answers WHERE starts_with(name, '_dmarc.') AND contains(lower(value), 'v=dmarc1') GROUP BY name)
SELECT domain, coalesce(a, '') AS a_records, coalesce(ns, '') AS ns_records, coalesce(mx, '') AS mx_records, mx IS NOT NULL AS has_mx, spf, dmarc, CASE WHEN github THEN 'GitHub Pages' {_SIGNS} END AS hosting_provider FROM (SELECT *, lower(concat_ws(' ', ns_raw, coalesce(ptr, ''))) AS hay FROM g LEFT JOIN p USING (domain))"""


def _mail_hosts(spark: SparkSession, folder: str) -> DataFrame:
    """The hosts that take a domain's mail: by MX, else the domain itself where it has an address. Each domain is looked up once, whatever its number of mailboxes."""
    facts = dns_facts(captures.derived(spark, folder, captures.ANSWERS_SQL))
    return facts.select("domain", F.when(F.col("has_mx"), F.col("mx_records")).when(F.col("a_records") != "", F.col("domain")).otherwise("").alias("mail_hosts"))


#: Snippets with analytics ids and links to write to and call, put behind captured pages by their length, for those have none.
LINKED = (
    '<a href="mailto:Sales.Team@Firm.in?subject=x">write</a><a href="tel:+91 98765 00003">call</a><script>gtag(1)</script><i>UA-1234-5</i>',
    "<a class=c href='mailto:bad@@firm.in'>no</a><a href='TEL:12345'>no</a><script src='gtm.js?id=GTM-AB12'></script><b>laravel</b>",
    '<a href="mailto:hr@firm.in">jobs</a> call 09876500004 <i>G-ABCDEF1</i> shopify.theme',
)


def _linked(spark: SparkSession, folder: str) -> DataFrame:
    """The last captured pages with a snippet, and their company's server header."""
    from ledgerloom.plans import catalogue

    snippet = F.element_at(F.array(*map(F.lit, LINKED)), F.length("html") % 3 + 1)
    servers = catalogue._probes(spark, folder).select("company_id", "server_header")
    return catalogue._joined_pages(spark, folder).withColumn("html", F.concat("html", snippet)).join(servers, "company_id", "left")


def _linked_cte() -> str:
    from ledgerloom.plans import catalogue

    return f"{catalogue.PAGES}, {catalogue.PROBES}, linked AS (SELECT p.company_id, page_type, id, server_header, html || [{sql.words(LINKED)}][length(html) % 3 + 1] AS html FROM pages p JOIN page_store USING (stored_path) LEFT JOIN probes q ON q.company_id = p.company_id)"


MAIL_LINK = r"""(?i)<a\s(?:[^>]*?\s)?href\s*=\s*(["']?)\s*mailto:([^"'>]*)"""
TEL_LINK = r"""(?i)<a\s(?:[^>]*?\s)?href\s*=\s*(["']?)\s*tel:([^"'>]*)"""


def _first_seen(found: DataFrame, value: str) -> DataFrame:
    """Each company's values with the page type they are first seen on, the home page first."""
    return found.groupBy("company_id", value).agg(F.min_by("page_type", F.struct((F.col("page_type") != "home").alias("later"), "id")).alias("source_page"))


def _linked_emails(spark: SparkSession, folder: str) -> DataFrame:
    """Addresses of links to write to and of the pages' text."""
    linked = F.transform(F.regexp_extract_all("html", F.lit(MAIL_LINK), 2), lambda x: F.lower(F.trim(F.substring_index(x, "?", 1))))
    every = F.array_distinct(F.concat(F.filter(linked, lambda x: x.rlike(f"^{EMAIL_PATTERN}$")), web.emails(F.col("html"))))
    return _first_seen(_linked(spark, folder).select("company_id", "page_type", "id", F.explode(every).alias("email")), "email")


def _linked_phones(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers of links to call and of the pages' visible text."""
    linked = F.regexp_extract_all("html", F.lit(TEL_LINK), 2)
    seen = F.regexp_extract_all(F.regexp_replace("html", "<[^>]*>", " "), F.lit(r"((?:\+?91[\- ]?)?0?[6-9]\d{9}\b)"), 1)
    found = _linked(spark, folder).select("company_id", "page_type", "id", F.explode(F.concat(linked, seen)).alias("n")).select("company_id", "page_type", "id", records.phone(F.col("n")).alias("phone")).where("phone is not null")
    return _first_seen(found, "phone")


def _q(pattern: str) -> str:
    return pattern.replace("'", "''")


def _linked_emails_sql() -> str:
    junk = f"NOT list_bool_or(list_transform([{sql.words(web.EMAIL_JUNK)}], lambda j: contains(email, j))) AND NOT list_bool_or(list_transform([{sql.words(web.EMAIL_JUNK_DOMAINS)}], lambda d: ends_with(email, '@' || d) OR ends_with(email, '.' || d))) AND length(email) <= 100"
    return f"""WITH {_linked_cte()}, a AS (SELECT company_id, page_type, id, lower(trim(split_part(unnest(regexp_extract_all(html, '{_q(MAIL_LINK)}', 2)), '?', 1))) AS email FROM linked),
b AS (SELECT company_id, page_type, id, trim(lower(unnest(regexp_extract_all(html, '{EMAIL_PATTERN}'))), '.') AS email FROM linked),
u AS (SELECT * FROM a WHERE regexp_full_match(email, '{EMAIL_PATTERN}') UNION ALL SELECT * FROM b WHERE {junk})
SELECT company_id, email, first(page_type ORDER BY page_type <> 'home', id) AS source_page FROM u GROUP BY company_id, email"""


def _linked_phones_sql() -> str:
    return rf"""WITH {_linked_cte()}, n AS (SELECT company_id, page_type, id, unnest(list_concat(regexp_extract_all(html, '{_q(TEL_LINK)}', 2), regexp_extract_all(regexp_replace(html, '<[^>]*>', ' ', 'g'), '(?:\+?91[\- ]?)?0?[6-9]\d{{9}}\b'))) AS n FROM linked), made AS (SELECT *, {sql.phone("n")} AS phone FROM n)
SELECT company_id, phone, first(page_type ORDER BY page_type <> 'home', id) AS source_page FROM made WHERE phone IS NOT NULL GROUP BY company_id, phone"""


def _tech_evidence(spark: SparkSession, folder: str) -> DataFrame:
    """Technologies of each company by page texts, analytics ids and headers, with category and evidence."""
    powered = F.when(F.col("company_id") % 3 == 0, "PHP/8.1").when(F.col("company_id") % 3 == 1, "Express")
    found = _linked(spark, folder).where("page_type = 'home'").select("company_id", F.inline(web.technologies(F.col("html"), F.col("server_header"), powered)))
    return found.distinct()


def _tech_evidence_sql() -> str:
    signs = ", ".join("('" + n + "', '" + c + "', [" + sql.words(x) + "])" for n, c, x in TECHNOLOGIES)
    return f"""WITH {_linked_cte()}, h AS (SELECT company_id, html, lower(html) AS low, server_header, regexp_extract(html, '{ANALYTICS_ID_PATTERN}', 0) AS gid, CASE WHEN company_id % 3 = 0 THEN 'php/8.1' WHEN company_id % 3 = 1 THEN 'express' END AS powered FROM linked WHERE page_type = 'home'),
hits AS (SELECT company_id, gid, server_header, s[1] AS technology, s[2] AS category, list_filter(s[3], lambda n: contains(low, n))[1] AS evidence FROM h, (SELECT unnest([{signs}]) AS s)),
sure AS (SELECT company_id, CASE WHEN starts_with(gid, 'GTM-') THEN 'Google Tag Manager' ELSE 'Google Analytics' END AS technology, 'analytics' AS category, gid AS evidence FROM h WHERE gid <> '' UNION SELECT company_id, 'Cloudflare', 'cdn', 'server: cloudflare' FROM h WHERE contains(lower(server_header), 'cloudflare'))
SELECT * FROM sure UNION SELECT company_id, technology, category, evidence FROM hits WHERE evidence IS NOT NULL AND (company_id, technology) NOT IN (SELECT (company_id, technology) FROM sure)
UNION SELECT company_id, 'PHP', 'backend', 'x-powered-by: ' || powered FROM h WHERE contains(powered, 'php') UNION SELECT company_id, 'Express', 'backend', 'x-powered-by: ' || powered FROM h WHERE contains(powered, 'express')"""


def _hosting_by_dns(spark: SparkSession, folder: str) -> DataFrame:
    """Hosting by address, name server, reverse name and server header together."""
    answers = captures.derived(spark, folder, captures.ANSWERS_SQL).where("rtype in ('A', 'NS', 'PTR')")
    of = lambda kind: F.collect_list(F.when(F.col("rtype") == kind, F.col("value")))
    found = answers.groupBy(F.col("name").alias("domain")).agg(of("A").alias("a"), of("NS").alias("ns"), F.max(F.when(F.col("rtype") == "PTR", F.col("value"))).alias("ptr"))
    servers = homes(captures.derived(spark, folder, captures.RESPONSES_SQL)).select(urls.domain(F.col("r.requested_url")).alias("domain"), F.col("r.server").alias("server"))
    return found.join(servers, "domain", "left").select("domain", web.hosting(F.col("a"), F.col("ns"), F.col("ptr"), F.col("server")).alias("hosting_provider"))


HOSTING_SQL = f"""WITH {RESPONSES}, {ANSWERS}, {HOMES}, s AS (SELECT {sql.domain('requested_url')} AS domain, server FROM homes), g AS (SELECT name AS domain, coalesce(bool_or(rtype = 'A' AND value IN ({sql.words(GITHUB_PAGES_IPS)})), false) AS github, lower(concat_ws(' ', max(CASE WHEN rtype = 'NS' THEN value END), coalesce(max(CASE WHEN rtype = 'PTR' THEN value END), ''))) AS h FROM answers WHERE rtype IN ('A', 'NS', 'PTR') GROUP BY name)
SELECT domain, CASE WHEN github THEN 'GitHub Pages' {_SIGNS} ELSE nullif(trim(split_part(split_part(server, '/', 1), '(', 1)), '') END AS hosting_provider FROM (SELECT g.domain, github, server, h || ' ' || lower(coalesce(server, '')) AS hay FROM g LEFT JOIN s USING (domain))"""

# contacts -------------------------------------------------------------------

#: Addresses as typed, from the companies' hosts and numbers.
TYPED_SQL = f"""SELECT id AS company_id, domain, CASE id % 6 WHEN 0 THEN concat('Info@', domain) WHEN 1 THEN concat('jane.doe', CAST(id AS string), '@', domain) WHEN 2 THEN 'not-an-email' WHEN 3 THEN concat('a@@', domain) WHEN 4 THEN 'x@Mailinator.com' ELSE concat('careers-pune7@', domain) END AS email,
  CASE id % 5 WHEN 0 THEN 'invalid' WHEN 1 THEN 'verified' WHEN 2 THEN 'disposable' WHEN 3 THEN 'unknown' END AS verified, CASE id % 7 WHEN 0 THEN 250 WHEN 1 THEN 550 WHEN 2 THEN 451 WHEN 3 THEN 251 END AS code, CASE WHEN id % 4 = 0 THEN created_at END AS last_checked
FROM {{companies}} WHERE domain IS NOT NULL AND regexp_like(domain, '^[a-z0-9.-]+$')"""
TYPED = "typed AS MATERIALIZED (" + TYPED_SQL.format(companies="companies").replace("regexp_like", "regexp_matches") + ")"


def _typed(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(TYPED_SQL, companies=table(spark, folder, "companies"))


def _email_checks(spark: SparkSession, folder: str) -> DataFrame:
    e = F.col("email")
    return _typed(spark, folder).select("company_id", mail.valid_syntax(e).alias("valid"), mail.is_disposable(mail.host(e)).alias("disposable"), mail.accepted(F.col("code")).alias("accepted"), F.arrays_overlap(mail.tokens(e), F.array(*map(F.lit, ("careers", "jobs", "hiring", "hr")))).alias("for_jobs"))


EMAIL_CHECKS_SQL = rf"""WITH {TYPED} SELECT company_id, regexp_full_match(email, '{EMAIL_PATTERN}') AND length(email) <= 254 AS valid, lower(coalesce(regexp_extract(email, '^[^@]*@(.*)$', 1), '')) IN ({sql.words(DISPOSABLE_DOMAINS)}) AS disposable, coalesce(code IN (250, 251), false) AS accepted,
  list_has_any(regexp_split_to_array(regexp_replace(lower(split_part(email, '@', 1)), '[0-9]+$', ''), '[._\-]+'), ['careers', 'jobs', 'hiring', 'hr']) AS for_jobs FROM typed"""


def _contacts(spark: SparkSession, folder: str) -> DataFrame:
    """Each company's addresses, seen ones and those tried at its host; the seen one wins where both are the same, and off its own host counts less."""
    rows = _typed(spark, folder).where(mail.valid_syntax(F.col("email")))
    own = urls.is_same_site(mail.host(F.col("email")), F.col("domain"))
    seen = rows.select("company_id", F.lower("email").alias("email"), F.lit("crawl").alias("source"), F.round(F.when(own, F.lit(0.6)).otherwise(F.greatest(F.lit(0.3), F.lit(0.6) - 0.3)), 2).alias("confidence"), F.lit(0).alias("rank"))
    tried = _typed(spark, folder).select("company_id", "domain", F.explode(F.array(*map(F.lit, PATTERN_LOCALS))).alias("local")).select("company_id", F.concat_ws("@", "local", "domain").alias("email"), F.lit("pattern").alias("source"), F.lit(0.4).alias("confidence"), F.lit(1).alias("rank"))
    return seen.unionByName(tried).groupBy("company_id", "email").agg(F.min_by("source", "rank").alias("source"), F.min_by("confidence", "rank").alias("confidence"))


CONTACTS_SQL = rf"""WITH {TYPED}, u AS (SELECT company_id, lower(email) AS email, 'crawl' AS source, CASE WHEN h = domain OR ends_with(h, '.' || domain) THEN 0.6 ELSE 0.3 END AS confidence, 0 AS rank FROM (SELECT *, lower(split_part(email, '@', 2)) AS h FROM typed WHERE regexp_full_match(email, '{EMAIL_PATTERN}') AND length(email) <= 254)
UNION ALL SELECT company_id, l || '@' || domain, 'pattern', 0.4, 1 FROM typed, (SELECT unnest([{sql.words(PATTERN_LOCALS)}]) AS l))
SELECT company_id, email, first(source ORDER BY rank) AS source, CAST(first(confidence ORDER BY rank) AS DOUBLE) AS confidence FROM u GROUP BY company_id, email"""


def _useful(spark: SparkSession, folder: str) -> DataFrame:
    """Whether a company has a useful, a verified and any address: child rows are aggregated before they are joined."""
    child = _typed(spark, folder).groupBy("company_id").agg(F.bool_or(F.coalesce(~F.col("verified").isin(*USELESS_STATUSES), F.lit(False))).alias("has_email"), F.bool_or(F.coalesce(F.col("verified") == "verified", F.lit(False))).alias("has_verified_email"))
    socials = table(spark, folder, "company_sources").where("startup_india_id is not null").select("company_id", F.lit(True).alias("listed")).distinct()
    joined = table(spark, folder, "companies").select(F.col("id").alias("company_id")).join(child, "company_id", "left").join(socials, "company_id", "left")
    return joined.select("company_id", *(F.coalesce(c, F.lit(False)).alias(c) for c in ("has_email", "has_verified_email", "listed")))


USEFUL_SQL = f"""WITH {TYPED} SELECT id AS company_id, EXISTS (SELECT 1 FROM typed t WHERE t.company_id = c.id AND t.verified NOT IN ({sql.words(USELESS_STATUSES)})) AS has_email, EXISTS (SELECT 1 FROM typed t WHERE t.company_id = c.id AND t.verified = 'verified') AS has_verified_email,
  EXISTS (SELECT 1 FROM company_sources s WHERE s.company_id = c.id AND s.startup_india_id IS NOT NULL) AS listed FROM companies c"""


def _tally(spark: SparkSession, folder: str) -> DataFrame:
    return _typed(spark, folder).groupBy(F.coalesce("verified", F.lit("none")).alias("verified")).agg(F.count("*").alias("n"))


def _check_worklist(spark: SparkSession, folder: str) -> DataFrame:
    """Addresses to verify next: those never checked first, then the longest ago, so that none starves."""
    return _typed(spark, folder).where("coalesce(verified, 'unknown') = 'unknown'").orderBy(F.asc_nulls_first("last_checked"), "company_id").limit(300).select("company_id", "email")


# texts ----------------------------------------------------------------------

#: Answers of a completion service as they come: fenced, with words around, and broken.
ANSWERED_SQL = """SELECT s_suppkey AS company_id, CASE s_suppkey % 5 WHEN 0 THEN concat('```json', chr(10), '{"industry": " Foods ', CAST(s_suppkey AS string), ' ", "icp": ""}', chr(10), '```') WHEN 1 THEN concat('Here it is: {"industry": "Tools", "icp": "Shops ', CAST(s_suppkey AS string), '"} as asked') WHEN 2 THEN 'I do not know' WHEN 3 THEN '{"industry": "Cut' ELSE '{"icp": "Mills"}' END AS text, CASE WHEN s_suppkey % 2 = 0 THEN 'Retail' END AS known FROM supplier"""


def _completions(spark: SparkSession, folder: str) -> DataFrame:
    """Fields of captured answers; what an answer lacks comes from what is known."""
    rows = captures.derived(spark, folder, ANSWERED_SQL).withColumn("json", completions.json_text(F.col("text")))
    return rows.select("company_id", F.col("json").isNotNull().alias("answered"), F.coalesce(completions.field(F.col("json"), "industry"), "known").alias("industry"), completions.field(F.col("json"), "icp").alias("icp"))


COMPLETIONS_SQL = rf"""WITH a AS ({ANSWERED_SQL}), j AS (SELECT *, CASE WHEN json_valid(regexp_extract(text, '(?s)\{{.*\}}', 0)) AND regexp_extract(text, '(?s)\{{.*\}}', 0) <> '' THEN regexp_extract(text, '(?s)\{{.*\}}', 0) END AS json FROM a)
SELECT company_id, json IS NOT NULL AS answered, coalesce(nullif(substr(trim(json_extract_string(json, '$.industry')), 1, 250), ''), known) AS industry, nullif(substr(trim(json_extract_string(json, '$.icp')), 1, 250), '') AS icp FROM j"""


def _described(spark: SparkSession, folder: str) -> DataFrame:
    """Companies beside the last description of each, and how many signs of trade it shows."""
    last = merging.latest(table(spark, folder, "company_enrichment").where("description is not null").select("company_id", "description", "updated_at"), ["company_id"], F.struct("updated_at", "description"))
    c = table(spark, folder, "companies").select(F.col("id").alias("company_id"), *(records.label(F.col(x)).alias(x) for x in ("name", "industry", "city", "stage"))).join(last.select("company_id", "description"), "company_id", "left")
    return c.select("company_id", completions.short_description(F.col("description"), *(F.col(x) for x in ("name", "industry", "city", "stage"))).alias("short_description"), completions.signs(F.coalesce("description", F.lit("")), ["shop", "store", "retail", "customers", "orders"]).alias("n_signs"))


DESCRIBED_SQL = rf"""WITH last AS (SELECT company_id, description FROM (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY updated_at DESC, description DESC) AS k FROM company_enrichment WHERE description IS NOT NULL) WHERE k = 1),
c AS (SELECT id AS company_id, {sql.label('name')} AS name, {sql.label('industry')} AS industry, {sql.label('city')} AS city, {sql.label('stage')} AS stage, description, {sql.collapse('description')} AS d FROM companies LEFT JOIN last ON last.company_id = id)
SELECT company_id, CASE WHEN description <> '' THEN CASE WHEN length(d) > 200 THEN CASE WHEN contains(left(d, 200), ' ') THEN regexp_replace(left(d, 200), ' [^ ]*$', '') ELSE left(d, 200) END ELSE d END
  ELSE replace(name || ' is a ' || coalesce(lower(stage) || '-stage ', '') || coalesce(industry, 'technology') || ' company' || coalesce(' based in ' || city, '') || '.', '  ', ' ') END AS short_description,
  CAST(list_sum(list_transform(['shop', 'store', 'retail', 'customers', 'orders'], lambda w: CAST(contains(lower(coalesce(description, '')), w) AS INT))) AS INT) AS n_signs FROM c"""

PAYLOAD = ("name", "industry", "sector", "stage", "city", "state", "website")


def _payloads(spark: SparkSession, folder: str) -> DataFrame:
    """What a completion service is told of each company: the fields it has, as JSON."""
    fields = [F.when(F.col(c) != "", F.col(c)).alias(c) for c in PAYLOAD]
    return table(spark, folder, "companies").select(F.col("id").alias("company_id"), F.to_json(F.struct(*fields)).alias("payload"))


PAYLOADS_SQL = "SELECT id AS company_id, '{' || concat_ws(',', " + ", ".join(f"""CASE WHEN {c} <> '' THEN '"{c}":' || CAST(to_json({c}) AS VARCHAR) END""" for c in PAYLOAD) + ") || '}' AS payload FROM companies"

# tables ---------------------------------------------------------------------


def _joined(spark: SparkSession, folder: str) -> DataFrame:
    """Companies with the last probe and the enrichment they have; those without either are left out."""
    from ledgerloom.plans import catalogue

    companies = table(spark, folder, "companies").select(F.col("id").alias("company_id"), "name")
    enriched = table(spark, folder, "company_enrichment").groupBy("company_id").agg(F.max("founded_year").alias("founded_year"))
    return companies.join(catalogue._probes(spark, folder).select("company_id", "final_url", "http_status"), "company_id").join(enriched, "company_id")


def _joined_sql() -> str:
    from ledgerloom.plans import catalogue

    return f"WITH {catalogue.PROBES} SELECT c.id AS company_id, c.name, p.final_url, p.http_status, e.founded_year FROM companies c JOIN probes p ON p.company_id = c.id JOIN (SELECT company_id, max(founded_year) AS founded_year FROM company_enrichment GROUP BY company_id) e ON e.company_id = c.id"


def _page_lists(spark: SparkSession, folder: str) -> DataFrame:
    """Each company's stored pages in one row, read with one join instead of a look-up a company; those without pages stay."""
    from ledgerloom.plans import catalogue

    stored = catalogue._pages(spark, folder).where("stored_path is not null").groupBy("company_id").agg(F.array_sort(F.collect_list("page_type")).alias("types"))
    rows = table(spark, folder, "companies").select(F.col("id").alias("company_id")).join(stored, "company_id", "left")
    return rows.select("company_id", F.coalesce(F.array_join("types", ","), F.lit("")).alias("page_types"))


def _page_lists_sql() -> str:
    from ledgerloom.plans import catalogue

    return f"WITH {catalogue.PAGES} SELECT c.id AS company_id, coalesce(string_agg(page_type, ',' ORDER BY page_type), '') AS page_types FROM companies c LEFT JOIN pages p ON p.company_id = c.id AND p.stored_path IS NOT NULL GROUP BY c.id"


def _dropped(spark: SparkSession, folder: str) -> DataFrame:
    """How many raw records came, were kept, and were dropped for want of a usable name."""
    rows = raw.derived(spark, folder)
    return rows.agg(F.count("*").alias("raw"), F.count(records.label(F.col("name"))).alias("kept")).withColumn("dropped", F.col("raw") - F.col("kept"))


def _csv_records(spark: SparkSession, folder: str) -> DataFrame:
    """Raw records written as CSV files and read again, in the order of file names and places in them."""
    from ledgerloom.session import Kept

    kept = Kept(spark)
    rows = raw.derived(spark, folder)
    names = {"registered_on": "registeredOn", "registration_date_raw": "registration date", "dipp_certified": "dippCertified", "company_status": "companyStatus", "contact_number": "contactNumber"}
    ordered = rows.repartitionByRange(3, "row_idx").sortWithinPartitions("row_idx").withColumnsRenamed(names).select(*raw.CSV_COLUMNS)
    ordered.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{kept.root}/raw.csv")
    return raw.read_csv(spark, f"{kept.root}/raw.csv")


_RAW = raw.DERIVED_SQL.replace(" AS string", " AS VARCHAR")
CSV_SQL = f"SELECT row_number() OVER (ORDER BY row_idx) - 1 AS row_idx, * EXCLUDE (row_idx) FROM ({_RAW})"


def _stored_again(spark: SparkSession, folder: str) -> DataFrame:
    """Captured pages written as gzip files to the shared folder and read again."""
    from ledgerloom.session import Kept

    kept = Kept(spark)
    pages.write_stored(table(spark, folder, "page_store"), f"{kept.root}/pages").agg(F.count("*")).collect()
    return pages.read_stored(spark, f"{kept.root}/pages").select("stored_path", F.length("html").alias("n_chars"))


def changed(before: dict[str, int], after: dict[str, int]) -> bool:
    """Whether a batch changed the number of rows of any table."""
    return any(after.get(k, 0) != n for k, n in before.items()) or bool(after.keys() - before.keys())


def guard_rebuild(spark: SparkSession, folder: str, force: bool = False, names: tuple[str, ...] = ("website_probes", "crawled_pages", "company_enrichment", "company_sources", "companies")) -> int:
    """The number of rows that a rebuild would destroy; an error if there are any and it isn't forced."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    there = [n for n in names if (p := path(f"{folder.rstrip('/')}/{n}.parquet")).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)]
    n = sum(table(spark, folder, t).count() for t in there)
    if n and not force:
        raise RuntimeError(f"{n} rows of enrichment would be lost; force the rebuild to go on")
    return n


def _batch_changed(spark: SparkSession, folder: str) -> DataFrame:
    """Row counts before and after a batch that adds the probes of 2026, and whether they differ; the counts stay two rows."""
    rows = table(spark, folder, "website_probes")
    counted = rows.agg(F.count_if(F.expr("checked_at < timestamp'2026-01-01'")).alias("before"), F.count("*").alias("after"))
    return counted.withColumn("changed", F.col("before") != F.col("after"))


def _new_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of hosts new to the master table, which go on behind its greatest."""
    hosts = table(spark, folder, "website_probes").where("domain is not null").select(F.col("domain").alias("cluster")).distinct()
    after = table(spark, folder, "companies").agg(F.coalesce(F.max("id"), F.lit(0)).alias("n")).first()["n"]
    return merging.with_dense_ids(hosts, after).select("id", F.col("cluster").alias("domain"))


def _from_supplier(query: Callable[[DataFrame], DataFrame], select: str) -> Query:
    return lambda spark, folder: query(captures.derived(spark, folder, select))


def catalogue() -> dict[str, tuple[Query, str | None]]:
    return {
        "probe_captures": (_from_supplier(probes, captures.RESPONSES_SQL), PROBES_SQL),
        "page_discovery": (_from_supplier(found_pages, captures.RESPONSES_SQL), FOUND_SQL),
        "crawl_captures": (_from_supplier(crawl, captures.RESPONSES_SQL), CRAWL_SQL),
        "dns_facts": (_from_supplier(dns_facts, captures.ANSWERS_SQL), DNS_SQL),
        "mail_hosts": (_mail_hosts, f"SELECT domain, CASE WHEN has_mx THEN mx_records WHEN a_records <> '' THEN domain ELSE '' END AS mail_hosts FROM ({DNS_SQL})"),
        "hosting_by_dns": (_hosting_by_dns, HOSTING_SQL),
        "linked_emails": (_linked_emails, _linked_emails_sql()),
        "linked_phones": (_linked_phones, _linked_phones_sql()),
        "tech_evidence": (_tech_evidence, _tech_evidence_sql()),
        "email_checks": (_email_checks, EMAIL_CHECKS_SQL),
        "contact_union": (_contacts, CONTACTS_SQL),
        "useful_contacts": (_useful, USEFUL_SQL),
        "verification_tally": (_tally, f"WITH {TYPED} SELECT coalesce(verified, 'none') AS verified, count(*) AS n FROM typed GROUP BY 1"),
        "verify_worklist": (_check_worklist, f"WITH {TYPED} SELECT company_id, email FROM typed WHERE coalesce(verified, 'unknown') = 'unknown' ORDER BY last_checked ASC NULLS FIRST, company_id LIMIT 300"),
        "completions": (_completions, COMPLETIONS_SQL),
        "short_descriptions": (_described, DESCRIBED_SQL),
        "probed_and_enriched": (_joined, _joined_sql()),
        "page_lists": (_page_lists, _page_lists_sql()),
        "dropped_records": (_dropped, f"SELECT count(*) AS raw, count(n) AS kept, count(*) - count(n) AS dropped FROM (SELECT {sql.label('name')} AS n FROM ({_RAW}))"),
        "csv_records": (_csv_records, CSV_SQL),
        "batch_changed": (_batch_changed, "SELECT *, before <> after AS changed FROM (SELECT count(*) FILTER (WHERE checked_at < TIMESTAMP '2026-01-01') AS before, count(*) AS after FROM website_probes)"),
        "stored_again": (_stored_again, "SELECT stored_path, length(html) AS n_chars FROM page_store WHERE html IS NOT NULL"),
        "prompt_payloads": (_payloads, PAYLOADS_SQL),
        "new_ids": (_new_ids, "SELECT (SELECT coalesce(max(id), 0) FROM companies) + row_number() OVER (ORDER BY domain) AS id, domain FROM (SELECT DISTINCT domain FROM website_probes WHERE domain IS NOT NULL)"),
    }
