"""Queries over the project's tables and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.dictionaries import HOSTING_SIGNS, PAGE_WORDS, PHONE_PATTERN, STOP_WORDS, TECHNOLOGIES
from ledgerloom.functions import names, places, records, urls, web
from ledgerloom.functions.text import collapse, is_blank
from ledgerloom.operators import linking, merging
from ledgerloom.plans import captured, sql
from ledgerloom.session import Kept
from ledgerloom.sources import pages, raw
from ledgerloom.sources.tables import table
from ledgerloom.streaming import incremental

FLAGSHIP = "merge_companies"
Query = Callable[[SparkSession, str], DataFrame]


def _each(name: str, key: str, columns: Callable[[], dict[str, Column]]) -> Query:
    """A query that gives a table's key and columns made from it."""
    return lambda spark, folder: table(spark, folder, name).select(key, *(c.alias(n) for n, c in columns().items()))


def as_double(query: Query, *columns: str) -> Query:
    """A query with whole numbers that may be null as doubles, which every reader of either engine shows alike."""
    return lambda spark, folder: query(spark, folder).withColumns({c: F.col(c).cast("double") for c in columns})


def _raw_each(columns: Callable[[], dict[str, Column]]) -> Query:
    return lambda spark, folder: raw.derived(spark, folder).select("row_idx", *(c.alias(n) for n, c in columns().items()))


def _records(spark: SparkSession, folder: str) -> DataFrame:
    """companies as records to link, in their order."""
    made = {
        "startup_india_id": records.source_id(F.col("startup_india_id")), "name": names.display_name(F.col("name")), "name_key": names.name_key(F.col("name")), "website": urls.website(F.col("website")),
        "domain": urls.domain(F.col("website")), "city": places.city(F.col("city")), "state": places.state(F.col("state")), "cin": records.cin(F.col("cin")), "phone": records.phone(F.col("phone")),
    } | {c: records.label(F.col(c)) for c in ("industry", "sector", "stage", "status", "role")}
    named = table(spark, folder, "companies").where(~is_blank(F.col("name")))
    return named.select(F.col("id").alias("row_idx"), "registration_date", F.col("dpiit_certified").alias("dpiit"), *(c.alias(n) for n, c in made.items()))


def _kept_records(spark: SparkSession, folder: str) -> DataFrame:
    """The records written once, for plans that read them several times."""
    return Kept(spark).keep(_records(spark, folder), "records")


def _clustered(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = _kept_records(spark, folder)
    return rows, Kept(spark).keep(linking.clusters(rows), "clusters")


RECORDS = f"""records AS MATERIALIZED (
  SELECT * FROM (SELECT id AS row_idx, registration_date, dpiit_certified AS dpiit, nullif({sql.strip("startup_india_id")}, '') AS startup_india_id,
    {sql.display_name("name")} AS name, {sql.name_key("name")} AS name_key, {sql.website("website")} AS website, {sql.domain("website")} AS domain, {sql.city("city")} AS city,
    {sql.state("state")} AS state, {sql.cin("cin")} AS cin, {sql.phone("phone")} AS phone, {", ".join(f"{sql.label(c)} AS {c}" for c in ("industry", "sector", "stage", "status", "role"))}
  FROM companies) WHERE name IS NOT NULL),
shared AS (
  SELECT domain, count(DISTINCT name_key) AS n_names, count(DISTINCT cin) AS n_cins FROM records
  WHERE domain IS NOT NULL AND NOT {sql.generic("domain")} GROUP BY domain HAVING count(DISTINCT name_key) >= 4 OR count(DISTINCT cin) >= 2),
usable AS (SELECT r.*, r.domain IS NOT NULL AND NOT {sql.generic("r.domain")} AND s.domain IS NULL AS usable FROM records r LEFT JOIN shared s ON r.domain = s.domain),
keys AS MATERIALIZED (
  SELECT row_idx, 'startup_india_id' AS kind, startup_india_id AS key FROM usable WHERE startup_india_id IS NOT NULL
  UNION ALL SELECT row_idx, 'cin', cin FROM usable WHERE cin IS NOT NULL
  UNION ALL SELECT row_idx, 'domain', domain FROM usable WHERE usable
  UNION ALL SELECT row_idx, 'website', website FROM usable WHERE usable AND website IS NOT NULL
  UNION ALL SELECT row_idx, 'name+state', name_key || chr(1) || coalesce(state, chr(2)) FROM usable WHERE NOT {sql.generic_key("name_key")})"""
CLUSTERS = f"""{RECORDS},
hubs AS (SELECT kind, key, min(row_idx) AS v FROM keys GROUP BY kind, key HAVING count(*) > 1),
links AS MATERIALIZED (SELECT DISTINCT row_idx AS u, v FROM keys JOIN hubs USING (kind, key) WHERE row_idx <> v),
both_ways AS MATERIALIZED (SELECT u, v FROM links UNION SELECT v, u FROM links),
reach AS (SELECT u AS a, u AS b FROM both_ways UNION SELECT reach.a, both_ways.v FROM reach JOIN both_ways ON both_ways.u = reach.b),
clusters AS MATERIALIZED (SELECT row_idx, coalesce(c, row_idx) AS cluster FROM records LEFT JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) ON a = row_idx)"""


def _merged(spark: SparkSession, folder: str) -> DataFrame:
    return merging.merge_clusters(*_clustered(spark, folder))


_FULL = " + ".join(f"CAST({c} IS NOT NULL AS INT)" for c in merging.FIELDS)
_BEST = ", ".join(f"coalesce(first(r.{c} ORDER BY full_n DESC, has_cin DESC, has_dpiit DESC, r.row_idx), first(r.{c} ORDER BY r.row_idx) FILTER (WHERE r.{c} IS NOT NULL)) AS {c}" for c in merging.FIELDS if c != "registration_date")
MERGED = f"""WITH RECURSIVE {CLUSTERS},
ranked AS (SELECT r.*, cluster, {_FULL} AS full_n, CAST(cin IS NOT NULL AS INT) AS has_cin, CAST(coalesce(dpiit, false) AS INT) AS has_dpiit FROM records r JOIN clusters USING (row_idx))
SELECT cluster, {_BEST}, min(registration_date) AS registration_date, bool_or(coalesce(dpiit, false)) AS dpiit_certified,
  count(startup_india_id) AS source_count, count(*) AS duplicate_count
FROM ranked r GROUP BY cluster"""


def _company_ids(spark: SparkSession, folder: str) -> DataFrame:
    rows, found = _clustered(spark, folder)
    return merging.with_dense_ids(found.select("cluster").distinct()).select("id", "cluster")


def _probes(spark: SparkSession, folder: str) -> DataFrame:
    """The last probe of each company; of probes at one time the one with the greatest title and domain."""
    rows = table(spark, folder, "website_probes").where("company_id is not null").select("company_id", "domain", "alive", "http_status", "https_ok", "redirected", "final_url", "title", "server_header", "checked_at")
    order = F.struct("checked_at", F.coalesce("final_url", F.lit("")), F.coalesce("title", F.lit("")), F.coalesce("http_status", F.lit(-1)), F.coalesce("domain", F.lit("")))
    return merging.latest(rows, ["company_id"], order)


PROBES = """probes AS (
  SELECT company_id, domain, alive, http_status, https_ok, redirected, final_url, title, server_header, checked_at FROM (
    SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY checked_at DESC, coalesce(final_url, '') DESC, coalesce(title, '') DESC, coalesce(http_status, -1) DESC, coalesce(domain, '') DESC) AS k
    FROM website_probes WHERE company_id IS NOT NULL) WHERE k = 1)"""


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    """The last capture of each company and page type."""
    rows = table(spark, folder, "crawled_pages").select("company_id", "page_type", "id", "http_status", "stored_path", "fetched_at")
    return merging.latest(rows, ["company_id", "page_type"], F.struct("fetched_at", "id"))


PAGES = "pages AS (SELECT company_id, page_type, id, http_status, stored_path, fetched_at FROM (SELECT *, row_number() OVER (PARTITION BY company_id, page_type ORDER BY fetched_at DESC, id DESC) AS k FROM crawled_pages) WHERE k = 1)"


def _facts(spark: SparkSession, folder: str) -> DataFrame:
    """What is known of each company, as flags; every child table is aggregated to one row a company before its join."""
    companies = table(spark, folder, "companies").select(F.col("id").alias("company_id"), F.col("website").isNotNull().alias("has_website"))
    probes = _probes(spark, folder).select("company_id", F.coalesce("alive", F.lit(False)).alias("alive"), F.coalesce("https_ok", F.lit(False)).alias("https"))
    enriched = table(spark, folder, "company_enrichment").groupBy("company_id").agg(F.bool_or(F.col("description").isNotNull()).alias("has_description"))
    contact = table(spark, folder, "crawled_pages").where("page_type = 'contact' and stored_path is not null").select("company_id", F.lit(True).alias("contact_page")).distinct()
    sources = table(spark, folder, "company_sources").groupBy("company_id").agg(F.count_distinct("startup_india_id").alias("n_sources"))
    joined = companies.join(probes, "company_id", "left").join(enriched, "company_id", "left").join(contact, "company_id", "left").join(sources, "company_id", "left")
    flags = ("alive", "https", "has_description", "contact_page")
    return joined.select("company_id", "has_website", *(F.coalesce(c, F.lit(False)).alias(c) for c in flags), F.coalesce("n_sources", F.lit(0)).alias("n_sources"))


def weighted_facts(facts: DataFrame, weights: dict[str, int], most: int = 100) -> DataFrame:
    """Facts with the weighted sum of the true ones, at most ``most``, and the map of the points that made it."""
    points = F.map_filter(F.create_map(*(x for f, w in weights.items() for x in (F.lit(f), F.when(F.col(f), w).otherwise(0)))), lambda _, n: n > 0)
    return facts.withColumn("breakdown", points).withColumn("score", F.least(F.lit(most), F.aggregate(F.map_values("breakdown"), F.lit(0), lambda a, n: a + n)))


EVEN = dict.fromkeys(("has_website", "alive", "https", "has_description", "contact_page"), 10)


def _counts(spark: SparkSession, folder: str) -> DataFrame:
    """One row of counts, as a batch takes before and after to see whether it changed anything."""
    one = None
    for name in ("website_probes", "crawled_pages", "company_enrichment", "company_sources", "companies"):
        row = table(spark, folder, name).agg(F.count("*").alias(name))
        one = row if one is None else one.crossJoin(row)
    return one


def _coverage(spark: SparkSession, folder: str) -> DataFrame:
    companies = table(spark, folder, "companies")
    counted = companies.agg(F.count("*").alias("total"), F.count_if(urls.domain(F.col("website")).isNotNull()).alias("with_domain"), F.count_if(records.cin(F.col("cin")).isNotNull()).alias("with_cin"), F.count_if(records.phone(F.col("phone")).isNotNull()).alias("with_phone"))
    return counted.select("*", *(F.when(F.col("total") > 0, F.round(100 * F.col(c) / F.col("total"), 1)).alias(f"{c}_share") for c in ("with_domain", "with_cin", "with_phone")))


def _page_type_tally(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "crawled_pages").groupBy("page_type").agg(F.count("*").alias("n"), F.count_if(F.col("stored_path").isNotNull()).alias("stored"), F.count_if((F.col("http_status") >= 400) | F.col("http_status").isNull()).alias("failed"))


def _work(spark: SparkSession, folder: str, left: str) -> DataFrame:
    """What a step has left to do: companies to probe whose site never answered, live sites to crawl, captures to extract from."""
    companies = table(spark, folder, "companies").select(F.col("id").alias("company_id"), urls.domain(F.col("website")).alias("domain"))
    probes = table(spark, folder, "website_probes")
    if left == "probe":
        return merging.work_list(companies.where("domain is not null"), probes.where("alive"), "company_id").select("company_id", "domain")
    if left == "crawl":
        alive = _probes(spark, folder).where("alive and final_url is not null").select("company_id", "final_url")
        return merging.work_list(alive, table(spark, folder, "crawled_pages"), "company_id")
    stored = table(spark, folder, "crawled_pages").where("stored_path is not null").select("company_id").distinct()
    return merging.work_list(stored, table(spark, folder, "company_enrichment"), "company_id")


#: Links and scripts that the captured pages lack, put behind them by their length so that the detectors have something to find.
SNIPPETS = (
    '<a href="/contact-us">Reach us</a><script src="/wp-content/themes/x.js"></script>',
    '<a href="https://www.facebook.com/acme?ref=1">f</a><a href="/careers/">Work with us</a><link href="https://cdn.shopify.com/s/x.css">',
    '<a href="https://twitter.com/share?u=1">t</a><a href="https://x.com/acme">x</a><script src="/_next/static/a.js"></script> 098765 43210 +91 9876500001',
)


def _wrapped(spark: SparkSession, folder: str) -> DataFrame:
    snippet = F.element_at(F.array(*map(F.lit, SNIPPETS)), F.length("html") % 3 + 1)
    return _joined_pages(spark, folder).withColumn("html", F.concat("html", snippet))


WRAPPED = f"{PAGES}, wrapped AS (SELECT company_id, page_type, id, stored_path, html || [{sql.words(SNIPPETS)}][length(html) % 3 + 1] AS html FROM pages JOIN page_store USING (stored_path))"


def _socials(spark: SparkSession, folder: str) -> DataFrame:
    """Each company's first profile link by platform, without query."""
    links = _wrapped(spark, folder).select("company_id", "page_type", "id", F.posexplode(F.regexp_extract_all("html", F.lit('href="([^"]+)"'), 1)).alias("pos", "href"))
    found = links.withColumn("platform", web.platform(F.col("href"))).where("platform is not null")
    first = F.struct((F.col("page_type") != "home").alias("later"), "id", "pos")
    return found.groupBy("company_id", "platform").agg(F.min_by(F.substring_index("href", "?", 1), first).alias("url"))


def _social_sql() -> str:
    any_of = lambda x, needles: " OR ".join(f"contains({x}, '{n}')" for n in needles)
    cases = " ".join(f"WHEN {any_of('low', hosts)} THEN '{name}'" for name, hosts in web.SOCIAL_HOSTS.items())
    path = r"regexp_replace(regexp_extract(low, '^(?:[a-z][a-z0-9+.\-]*:)?//[^/?#]*([^?#]*)', 1), '/+$', '')"
    return f"""WITH {WRAPPED}, hrefs AS (SELECT company_id, page_type, id, regexp_extract_all(html, 'href="([^"]+)"', 1) AS h FROM wrapped),
    links AS (SELECT company_id, page_type, id, unnest(h) AS href, generate_subscripts(h, 1) AS pos FROM hrefs),
    marked AS (SELECT *, CASE WHEN {any_of('low', web.SOCIAL_SKIP)} THEN NULL {cases} END AS platform FROM (SELECT *, lower(href) AS low FROM links))
    SELECT company_id, platform, first(split_part(href, '?', 1) ORDER BY page_type <> 'home', id, pos) AS url FROM marked
    WHERE platform IS NOT NULL AND {path} NOT IN ({sql.words(web.SOCIAL_NO_PROFILE)}) GROUP BY company_id, platform"""


#: The number of a link to call, in double, single or no quotes.
TEL_LINK = r"""(?i)<a\s(?:[^>]*?\s)?href\s*=\s*(["']?)\s*tel:([^"'>]*)"""


def _page_phones(spark: SparkSession, folder: str) -> DataFrame:
    """Each company's numbers with the page type they are first seen on, of links to call and of the visible text."""
    text = F.regexp_replace("html", "<[^>]*>", " ")
    linked = F.regexp_extract_all("html", F.lit(TEL_LINK), 2)
    raw_numbers = F.regexp_extract_all(text, F.lit(f"({PHONE_PATTERN})"), 1)
    found = _wrapped(spark, folder).select("company_id", "page_type", "id", F.explode(F.concat(linked, raw_numbers)).alias("n")).select("company_id", "page_type", "id", records.phone(F.col("n")).alias("phone")).where("phone is not null")
    return found.groupBy("company_id", "phone").agg(F.min_by("page_type", F.struct((F.col("page_type") != "home").alias("later"), "id")).alias("source_page"))


PHONES_SQL = rf"""WITH {WRAPPED}, found AS (SELECT company_id, page_type, id, unnest(regexp_extract_all(regexp_replace(html, '<[^>]*>', ' ', 'g'), '(?:\+?91[\- ]?)?0?[6-9]\d{{9}}\b')) AS n FROM wrapped),
made AS (SELECT company_id, page_type, id, {sql.phone("n")} AS phone FROM found)
SELECT company_id, phone, first(page_type ORDER BY page_type <> 'home', id) AS source_page FROM made WHERE phone IS NOT NULL GROUP BY company_id, phone"""


def _joined_pages(spark: SparkSession, folder: str) -> DataFrame:
    stored = _pages(spark, folder).where("stored_path is not null")
    return stored.join(table(spark, folder, "page_store"), "stored_path")


def _page_emails(spark: SparkSession, folder: str) -> DataFrame:
    """Each company's addresses with the page type they are first seen on, the home page first."""
    found = _joined_pages(spark, folder).select("company_id", "page_type", "id", F.explode(web.emails(F.col("html"))).alias("email"))
    first = F.struct((F.col("page_type") != "home").alias("later"), F.col("id"))
    return found.groupBy("company_id", "email").agg(F.min_by("page_type", first).alias("source_page"))


EMAILS_SQL = rf"""WITH {PAGES},
found AS (SELECT company_id, page_type, id, unnest(regexp_extract_all(html, '[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{{2,}}')) AS e FROM pages JOIN page_store USING (stored_path)),
clean AS (SELECT company_id, page_type, id, trim(lower(e), '.') AS email FROM found)
SELECT company_id, email, first(page_type ORDER BY page_type <> 'home', id) AS source_page FROM clean
WHERE length(email) <= 100 AND NOT list_bool_or(list_transform([{sql.words(web.EMAIL_JUNK)}], lambda j: contains(email, j)))
  AND NOT list_bool_or(list_transform([{sql.words(web.EMAIL_JUNK_DOMAINS)}], lambda d: ends_with(email, '@' || d) OR ends_with(email, '.' || d))) GROUP BY company_id, email"""


def _page_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Identity facts of each company, the home page's before the others'."""
    rows = _joined_pages(spark, folder).withColumn("url", F.concat(F.lit("https://"), F.element_at(F.split("stored_path", "/"), 2)))
    read = web.page_facts(rows.withColumn("key", F.struct("company_id", "page_type", "id")), "key", "html", "url")
    text = F.col("text")
    read = read.select("key.company_id", "key.page_type", "key.id", F.coalesce("site_name", "org_name").alias("extracted_name"), F.substring(collapse(F.col("description")), 1, 1000).alias("description"), "logo", F.coalesce("org_year", web.founded_year(text, 2026)).alias("founded_year"), web.staff_phrase(text).alias("employee_count"), F.coalesce("org_address", F.when(F.col("key.page_type") == "contact", web.address_near_pin(text))).alias("address"))
    order = F.struct((F.col("page_type") != "home").alias("later"), F.col("id"))
    facts = ("extracted_name", "description", "logo", "founded_year", "employee_count", "address")
    return read.groupBy("company_id").agg(*(F.min_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in facts))


def _page_links(spark: SparkSession, folder: str) -> DataFrame:
    """The pages of its own site that each captured home page leads to, the first of each type."""
    host = F.element_at(F.split("stored_path", "/"), 2)
    rows = _wrapped(spark, folder).where("page_type = 'home'").select(F.struct("company_id", "id").alias("key"), "html", F.concat(F.lit("https://"), host, F.lit("/")).alias("url"), F.regexp_replace(host, r"^www\.", "").alias("root"))
    return web.discovered(rows, "key", "html", "url", "root").select("key.company_id", "page_type", "url")


def _technologies(spark: SparkSession, folder: str) -> DataFrame:
    return _wrapped(spark, folder).select("company_id", F.inline(web.technologies(F.col("html")))).select("company_id", "technology", "evidence").distinct()


def _hosting(spark: SparkSession, folder: str) -> DataFrame:
    empty = F.array().cast("array<string>")
    return _probes(spark, folder).select("company_id", web.hosting(empty, empty, F.lit(None).cast("string"), F.col("server_header")).alias("hosting_provider"))


_HOSTING_CASES = " ".join(f"WHEN contains(hay, '{n}') THEN '{p}'" for n, p in HOSTING_SIGNS)


def _keywords(spark: SparkSession, folder: str, k: int = 8) -> DataFrame:
    """The k most frequent words of each company's last description; ties in the order of their first place."""
    rows = merging.latest(table(spark, folder, "company_enrichment").where("description is not null").select("company_id", "description", "updated_at"), ["company_id"], F.struct("updated_at", "description"))
    tokens = rows.select("company_id", F.posexplode(F.regexp_extract_all(F.lower("description"), F.lit(r"([a-z][a-z0-9\-]{3,})"), 1)).alias("pos", "word"))
    counts = tokens.groupBy("company_id", "word").agg(F.count("*").alias("n"), F.min("pos").alias("pos"))
    top = counts.groupBy("company_id").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "pos", "word"))), 1, k).alias("w"))
    return top.select("company_id", F.array_join(F.transform("w", lambda x: x.word), " ").alias("keywords"))


def _company_keywords(spark: SparkSession, folder: str, k: int = 8) -> DataFrame:
    """Up to k keywords of each company: industry, sector, its shop or blog system, then the most frequent words of its
    last description without stop words; ties in the order of their first place, words alike but for case once."""
    companies = table(spark, folder, "companies").select(F.col("id").alias("company_id"), *(records.label(F.col(c)).alias(c) for c in ("industry", "sector")))
    rows = merging.latest(table(spark, folder, "company_enrichment").where("description is not null").select("company_id", "description", "updated_at"), ["company_id"], F.struct("updated_at", "description"))
    tokens = rows.select("company_id", F.posexplode(F.regexp_extract_all(F.lower("description"), F.lit(r"([a-z][a-z0-9\-]{3,})"), 1)).alias("pos", "word"))
    counts = tokens.where(~F.col("word").isin(*STOP_WORDS)).groupBy("company_id", "word").agg(F.count("*").alias("n"), F.min("pos").alias("pos"))
    top = counts.groupBy("company_id").agg(F.transform(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "pos", "word"))), 1, k), lambda x: x.word).alias("words"))
    systems = _technologies(spark, folder).where(F.col("technology").isin("Shopify", "WordPress")).groupBy("company_id").agg(F.array_sort(F.collect_set("technology")).alias("systems"))
    joined = companies.join(systems, "company_id", "left").join(top, "company_id", "left")
    none = F.array().cast("array<string>")
    lead = F.array_compact(F.concat(F.array("industry", "sector"), F.coalesce("systems", none)))
    # a word is added before its number is looked at, so one stands even behind k leading labels
    room = F.greatest(F.lit(k) - F.size(lead), F.lit(1))
    every = F.concat(lead, F.slice(F.coalesce("words", none), F.lit(1), room))
    once = F.filter(every, lambda x, i: F.array_position(F.transform(every, lambda y: F.lower(y)), F.lower(x)) == i + 1)
    return joined.select("company_id", F.array_join(F.slice(once, 1, k), ",").alias("keywords"))


def _orphans(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of child tables whose company is unknown, by table."""
    ids = table(spark, folder, "companies").select(F.col("id").alias("company_id"))
    parts = [table(spark, folder, t).join(ids, "company_id", "left_anti").agg(F.lit(t).alias("child"), F.count("*").alias("orphans")) for t in ("company_sources", "website_probes", "company_enrichment", "crawled_pages")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def _sources_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """company_sources after its later half is inserted into its earlier half with existing pairs ignored."""
    rows = table(spark, folder, "company_sources")
    old = rows.where("company_id % 2 = 0").distinct()
    return merging.insert_absent(old, rows, ["company_id", "startup_india_id"], F.lit(0))


def _probe_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """The last probes of dead sites replaced by ones that say so."""
    old = _probes(spark, folder).select("company_id", "alive", "http_status", "title")
    new = old.where("not alive").select("company_id", F.lit(False).alias("alive"), F.lit(0).alias("http_status"), F.lit("gone").alias("title"))
    return merging.upsert(old, new, ["company_id"])


def _probe_status(spark: SparkSession, folder: str) -> DataFrame:
    """Single titles of probes changed by key, the rest as it was."""
    old = _probes(spark, folder).select("company_id", "http_status", "title")
    updates = old.where("http_status >= 400").select("company_id", F.lit("unreachable").alias("title"))
    return merging.set_status(old, updates, "company_id", ["title"])


def _sample_work(spark: SparkSession, folder: str) -> DataFrame:
    """A seeded sample of the work-list, the same on every run."""
    left = _work(spark, folder, "crawl")
    return left.orderBy(F.md5(F.concat(F.lit("7:"), F.col("company_id").cast("string")).cast("binary")), "company_id").limit(50)


_TECH = ", ".join("('" + n + "', [" + sql.words(needles) + "])" for n, _, needles in TECHNOLOGIES)

_NORMALIZED = f"""SELECT * FROM (SELECT row_idx, nullif({sql.strip("id")}, '') AS startup_india_id, {sql.display_name("name")} AS name, {sql.name_key("name")} AS name_key, {sql.website("website")} AS website, {sql.domain("website")} AS domain,
  {sql.label("industries")} AS industry, {sql.label("sectors")} AS sector, {sql.label("stages")} AS stage, {sql.city("city")} AS city, {sql.state("state")} AS state, {sql.registration_date("registration_date_raw", "registered_on")} AS registration_date, {sql.cin("cin")} AS cin,
  {sql.flag("dipp_certified")} AS dpiit, {sql.label("company_status")} AS status, {sql.phone("contact_number")} AS phone, {sql.label("role")} AS role FROM ({raw.DERIVED_SQL.replace(" AS string", " AS VARCHAR")})) WHERE name IS NOT NULL"""
_LINKS_SQL = f"""WITH {WRAPPED}, {captured._found_sql("SELECT {'company_id': company_id, 'id': id} AS key, html, 'https://' || split_part(stored_path, '/', 2) || '/' AS base, regexp_replace(split_part(stored_path, '/', 2), '^www\\.', '') AS root FROM wrapped WHERE page_type = 'home'")} SELECT key.company_id AS company_id, page_type, url FROM found"""

_KEYWORDS_SQL = rf"""WITH {WRAPPED}, last AS (SELECT company_id, description FROM (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY updated_at DESC, description DESC) AS k FROM company_enrichment WHERE description IS NOT NULL) WHERE k = 1),
t AS (SELECT company_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM (SELECT company_id, regexp_extract_all(lower(description), '[a-z][a-z0-9\-]{{3,}}') AS w FROM last)),
c AS (SELECT company_id, word, count(*) AS n, min(pos) AS pos FROM t WHERE word NOT IN ({sql.words(STOP_WORDS)}) GROUP BY company_id, word),
top AS (SELECT company_id, list(word ORDER BY n DESC, pos)[:8] AS words FROM c GROUP BY company_id),
sys AS (SELECT company_id, list_sort(list_distinct(list(s))) AS systems FROM (SELECT company_id, unnest(list_filter(['Shopify', 'WordPress'], lambda x: CASE WHEN x = 'Shopify' THEN {" OR ".join(f"contains(lower(html), '{w}')" for w in TECHNOLOGIES[1][2])} ELSE {" OR ".join(f"contains(lower(html), '{w}')" for w in TECHNOLOGIES[0][2])} END)) AS s FROM wrapped) GROUP BY company_id),
l AS (SELECT id AS company_id, list_filter(list_concat([{sql.label('industry')}, {sql.label('sector')}], coalesce(systems, [])), lambda x: x IS NOT NULL) AS lead, coalesce(words, []) AS words FROM companies LEFT JOIN sys ON sys.company_id = id LEFT JOIN top ON top.company_id = id),
e AS (SELECT company_id, list_concat(lead, words[:greatest(8 - len(lead), 1)]) AS every FROM l)
SELECT company_id, array_to_string(list_filter(every, lambda x, i: list_position(list_transform(every, lambda y: lower(y)), lower(x)) = i)[:8], ',') AS keywords FROM e"""

CATALOGUE: dict[str, tuple[Query, str | None]] = {
    "norm_website": (_each("companies", "id", lambda: dict(website=urls.website(F.col("website")))), f"SELECT id, {sql.website('website')} AS website FROM companies"),
    "extract_domain": (_each("companies", "id", lambda: dict(domain=urls.domain(F.col("website")))), f"SELECT id, {sql.domain('website')} AS domain FROM companies"),
    "norm_phone": (_each("companies", "id", lambda: dict(phone=records.phone(F.col("phone")))), f"SELECT id, {sql.phone('phone')} AS phone FROM companies"),
    "norm_cin": (_each("companies", "id", lambda: dict(cin=records.cin(F.col("cin")))), f"SELECT id, {sql.cin('cin')} AS cin FROM companies"),
    "norm_state": (_each("companies", "id", lambda: dict(state=places.state(F.col("state")))), f"SELECT id, {sql.state('state')} AS state FROM companies"),
    "norm_city": (_each("companies", "id", lambda: dict(city=places.city(F.col("city")))), f"SELECT id, {sql.city('city')} AS city FROM companies"),
    "name_key": (_each("companies", "id", lambda: dict(name_key=names.name_key(F.col("name")))), f"SELECT id, {sql.name_key('name')} AS name_key FROM companies"),
    "name_display": (_each("companies", "id", lambda: dict(name=names.display_name(F.col("name")))), f"SELECT id, {sql.display_name('name')} AS name FROM companies"),
    "norm_labels": (_each("companies", "id", lambda: dict(**{c: records.label(F.col(c)) for c in ("industry", "sector", "stage", "status", "role")})), "SELECT id, " + ", ".join(f"{sql.label(c)} AS {c}" for c in ("industry", "sector", "stage", "status", "role")) + " FROM companies"),
    "source_ids": (_each("companies", "id", lambda: dict(source_id=records.source_id(F.col("startup_india_id")))), f"SELECT id, nullif({sql.strip('startup_india_id')}, '') AS source_id FROM companies"),
    "generic_domain": (_raw_each(lambda: dict(domain=urls.domain(F.col("website")), generic=urls.is_generic_domain(urls.domain(F.col("website"))))), f"SELECT row_idx, domain, {sql.generic('domain')} AS generic FROM (SELECT row_idx, {sql.domain('website')} AS domain FROM ({raw.DERIVED_SQL.replace(' AS string', ' AS VARCHAR')}))"),
    "generic_name": (_each("companies", "id", lambda: dict(generic=names.is_generic_key(names.name_key(F.col("name"))))), f"SELECT id, {sql.generic_key(sql.name_key('name'))} AS generic FROM companies"),
    "norm_date": (_raw_each(lambda: dict(registration_date=records.registration_date(F.col("registration_date_raw"), F.col("registered_on")))), f"SELECT row_idx, {sql.registration_date('registration_date_raw', 'registered_on')} AS registration_date FROM ({raw.DERIVED_SQL.replace(' AS string', ' AS VARCHAR')})"),
    "norm_flag": (_raw_each(lambda: dict(certified=records.flag(F.col("dipp_certified")))), f"SELECT row_idx, {sql.flag('dipp_certified')} AS certified FROM ({raw.DERIVED_SQL.replace(' AS string', ' AS VARCHAR')})"),
    "normalize_records": (lambda s, d: raw.normalize(raw.derived(s, d)), _NORMALIZED),
    "startups_only": (lambda s, d: raw.normalize(raw.derived(s, d), startups_only=True).select("row_idx", "role"), f"SELECT row_idx, {sql.label('role')} AS role FROM ({raw.DERIVED_SQL.replace(' AS string', ' AS VARCHAR')}) WHERE {sql.label('name')} IS NOT NULL AND lower({sql.label('role')}) = 'startup'"),
    "shared_domains": (lambda s, d: linking.shared_domains(_kept_records(s, d)), f"WITH {RECORDS} SELECT domain, n_names, n_cins FROM shared"),
    "link_counts": (lambda s, d: linking.link_counts(_kept_records(s, d)), f"WITH {RECORDS} SELECT kind, CAST(sum(n - 1) AS BIGINT) AS links FROM (SELECT kind, key, count(*) AS n FROM keys GROUP BY kind, key) GROUP BY kind"),
    "dedup_clusters": (lambda s, d: _clustered(s, d)[1], f"WITH RECURSIVE {CLUSTERS} SELECT row_idx, cluster FROM clusters"),
    "dedup_stats": (lambda s, d: linking.cluster_stats(*_clustered(s, d)), f"WITH RECURSIVE {CLUSTERS}, sizes AS (SELECT cluster, count(*) AS n FROM clusters GROUP BY cluster) SELECT CAST(sum(n) AS BIGINT) AS total_records, count(*) AS unique_companies, CAST(sum(n) - count(*) AS BIGINT) AS duplicates_removed, max(n) AS largest_cluster, (SELECT count(*) FROM shared) AS shared_domains FROM sizes"),
    "merge_companies": (_merged, MERGED),
    "merged_sources": (lambda s, d: merging.cluster_sources(*_clustered(s, d)), f"WITH RECURSIVE {CLUSTERS} SELECT DISTINCT cluster, startup_india_id FROM records JOIN clusters USING (row_idx) WHERE startup_india_id IS NOT NULL"),
    "company_ids": (_company_ids, f"WITH RECURSIVE {CLUSTERS} SELECT row_number() OVER (ORDER BY cluster) AS id, cluster FROM (SELECT DISTINCT cluster FROM clusters)"),
    "latest_probes": (as_double(_probes, "http_status"), f"WITH {PROBES} SELECT * REPLACE (CAST(http_status AS DOUBLE) AS http_status) FROM probes"),
    "latest_pages": (as_double(_pages, "http_status"), f"WITH {PAGES} SELECT * REPLACE (CAST(http_status AS DOUBLE) AS http_status) FROM pages"),
    "probe_worklist": (lambda s, d: _work(s, d, "probe"), f"SELECT id AS company_id, domain FROM (SELECT id, {sql.domain('website')} AS domain FROM companies) WHERE domain IS NOT NULL AND id NOT IN (SELECT company_id FROM website_probes WHERE company_id IS NOT NULL AND alive)"),
    "crawl_worklist": (lambda s, d: _work(s, d, "crawl"), f"WITH {PROBES} SELECT company_id, final_url FROM probes WHERE alive AND final_url IS NOT NULL AND company_id NOT IN (SELECT company_id FROM crawled_pages WHERE company_id IS NOT NULL)"),
    "extract_worklist": (lambda s, d: _work(s, d, "extract"), "SELECT DISTINCT company_id FROM crawled_pages WHERE stored_path IS NOT NULL AND company_id NOT IN (SELECT company_id FROM company_enrichment WHERE company_id IS NOT NULL)"),
    "sampled_worklist": (_sample_work, f"WITH {PROBES} SELECT company_id, final_url FROM probes WHERE alive AND final_url IS NOT NULL AND company_id NOT IN (SELECT company_id FROM crawled_pages WHERE company_id IS NOT NULL) ORDER BY md5('7:' || company_id), company_id LIMIT 50"),
    "first_worklist": (lambda s, d: _work(s, d, "probe").orderBy("company_id").limit(500), f"SELECT id AS company_id, domain FROM (SELECT id, {sql.domain('website')} AS domain FROM companies) WHERE domain IS NOT NULL AND id NOT IN (SELECT company_id FROM website_probes WHERE company_id IS NOT NULL AND alive) ORDER BY id LIMIT 500"),
    "company_facts": (_facts, f"WITH {PROBES} SELECT c.id AS company_id, c.website IS NOT NULL AS has_website, coalesce(p.alive, false) AS alive, coalesce(p.https_ok, false) AS https, EXISTS (SELECT 1 FROM company_enrichment e WHERE e.company_id = c.id AND e.description IS NOT NULL) AS has_description, EXISTS (SELECT 1 FROM crawled_pages g WHERE g.company_id = c.id AND g.page_type = 'contact' AND g.stored_path IS NOT NULL) AS contact_page, (SELECT count(DISTINCT s.startup_india_id) FROM company_sources s WHERE s.company_id = c.id) AS n_sources FROM companies c LEFT JOIN probes p ON p.company_id = c.id"),
    "weighted_facts": (lambda s, d: weighted_facts(_facts(s, d), EVEN).select("company_id", "score", F.size("breakdown").alias("n_true")), f"WITH {PROBES}, f AS (SELECT c.id AS company_id, CAST(c.website IS NOT NULL AS INT) + CAST(coalesce(p.alive, false) AS INT) + CAST(coalesce(p.https_ok, false) AS INT) + CAST(EXISTS (SELECT 1 FROM company_enrichment e WHERE e.company_id = c.id AND e.description IS NOT NULL) AS INT) + CAST(EXISTS (SELECT 1 FROM crawled_pages g WHERE g.company_id = c.id AND g.page_type = 'contact' AND g.stored_path IS NOT NULL) AS INT) AS n FROM companies c LEFT JOIN probes p ON p.company_id = c.id) SELECT company_id, least(100, 10 * n) AS score, n AS n_true FROM f"),
    "row_counts": (_counts, "SELECT " + ", ".join(f"(SELECT count(*) FROM {t}) AS {t}" for t in ("website_probes", "crawled_pages", "company_enrichment", "company_sources", "companies"))),
    "coverage": (_coverage, f"SELECT total, with_domain, with_cin, with_phone, round(100 * with_domain / total, 1) AS with_domain_share, round(100 * with_cin / total, 1) AS with_cin_share, round(100 * with_phone / total, 1) AS with_phone_share FROM (SELECT count(*) AS total, count({sql.domain('website')}) AS with_domain, count({sql.cin('cin')}) AS with_cin, count({sql.phone('phone')}) AS with_phone FROM companies)"),
    "page_tally": (_page_type_tally, "SELECT page_type, count(*) AS n, count(stored_path) AS stored, count(*) FILTER (WHERE http_status >= 400 OR http_status IS NULL) AS failed FROM crawled_pages GROUP BY page_type"),
    "orphans": (_orphans, " UNION ALL ".join(f"SELECT '{t}' AS child, count(*) AS orphans FROM {t} WHERE company_id IS NULL OR company_id NOT IN (SELECT id FROM companies)" for t in ("company_sources", "website_probes", "company_enrichment", "crawled_pages"))),
    "insert_absent": (_sources_upsert, "SELECT DISTINCT company_id, startup_india_id FROM company_sources WHERE company_id % 2 = 0 OR startup_india_id IS NOT NULL UNION ALL SELECT DISTINCT company_id, startup_india_id FROM company_sources WHERE startup_india_id IS NULL"),
    "upsert_last": (as_double(_probe_upsert, "http_status"), f"WITH {PROBES} SELECT company_id, alive, CAST(CASE WHEN NOT alive THEN 0 ELSE http_status END AS DOUBLE) AS http_status, CASE WHEN NOT alive THEN 'gone' ELSE title END AS title FROM probes"),
    "update_status": (as_double(_probe_status, "http_status"), f"WITH {PROBES} SELECT company_id, CAST(http_status AS DOUBLE) AS http_status, CASE WHEN http_status >= 400 THEN 'unreachable' ELSE title END AS title FROM probes"),
    "page_titles": (lambda s, d: table(s, d, "page_store").select("stored_path", web.title(F.col("html")).alias("title")), r"SELECT stored_path, nullif(substr(trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\s+', ' ', 'g')), 1, 300), '') AS title FROM page_store"),
    "page_emails": (_page_emails, EMAILS_SQL),
    "page_facts": (_page_facts, None),
    "page_links": (_page_links, _LINKS_SQL),
    "technologies": (_technologies, f"WITH {WRAPPED}, signs AS (SELECT unnest([{_TECH}]) AS s), hits AS (SELECT company_id, s[1] AS technology, list_filter(s[2], lambda n: contains(lower(html), n)) AS found FROM wrapped, signs) SELECT DISTINCT company_id, technology, found[1] AS evidence FROM hits WHERE len(found) > 0"),
    "page_phones": (_page_phones, PHONES_SQL),
    "page_socials": (_socials, _social_sql()),
    "hosting": (_hosting, f"WITH {PROBES} SELECT company_id, CASE {_HOSTING_CASES} ELSE nullif(trim(split_part(split_part(server_header, '/', 1), '(', 1)), '') END AS hosting_provider FROM (SELECT *, lower(coalesce(server_header, '')) AS hay FROM probes)"),
    "shard_paths": (_each("companies", "id", lambda: dict(path=pages.stored_path(urls.domain(F.col("website")), F.lit("home")))), f"SELECT id, concat_ws('/', substr(sha1(d), 1, 2), regexp_replace(d, '[^a-z0-9.\\-]', '_', 'g'), 'home.html.gz') AS path FROM (SELECT id, {sql.domain('website')} AS d FROM companies)"),
    "founded_years": (as_double(_each("company_enrichment", "company_id", lambda: dict(year=web.founded_year(F.col("description"), 2026))), "year"), r"SELECT company_id, CAST(CASE WHEN y BETWEEN 1900 AND 2026 THEN y END AS DOUBLE) AS year FROM (SELECT company_id, try_cast(regexp_extract(description, '(?i)(?:founded|established|est\.?|since|inception|incorporated)[^0-9]{0,20}(19\d{2}|20\d{2})', 1) AS INT) AS y FROM company_enrichment)"),
    "staff_phrases": (_each("company_enrichment", "company_id", lambda: dict(phrase=web.staff_phrase(F.col("description")))), r"SELECT company_id, coalesce(nullif(trim(regexp_extract(description, '(?i)(?:\d{1,3}(?:,\d{3})*|\d+)\s*\+?\s*(?:employees|team members|people|professionals)', 0)), ''), nullif(trim(regexp_extract(description, '(?i)team of\s+(?:\d{1,3}(?:,\d{3})*|\d+)\+?', 0)), '')) AS phrase FROM company_enrichment"),
    "company_keywords": (_company_keywords, _KEYWORDS_SQL),
    "keywords": (_keywords, r"WITH last AS (SELECT company_id, description FROM (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY updated_at DESC, description DESC) AS k FROM company_enrichment WHERE description IS NOT NULL) WHERE k = 1), t AS (SELECT company_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM (SELECT company_id, regexp_extract_all(lower(description), '[a-z][a-z0-9\-]{3,}') AS w FROM last)), c AS (SELECT company_id, word, count(*) AS n, min(pos) AS pos FROM t GROUP BY company_id, word), r AS (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY n DESC, pos) AS k FROM c) SELECT company_id, string_agg(word, ' ' ORDER BY k) AS keywords FROM r WHERE k <= 8 GROUP BY company_id"),
    "incremental_domains": (incremental.domains_in_steps, f"SELECT id, {sql.domain('website')} AS domain FROM companies"),
}
CATALOGUE |= captured.catalogue()
for _name, _columns in {"probe_captures": ("http_status",), "crawl_captures": ("http_status",), "probed_and_enriched": ("http_status", "founded_year")}.items():
    _query, _text = CATALOGUE[_name]
    CATALOGUE[_name] = as_double(_query, *_columns), f"SELECT * REPLACE ({', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in _columns)}) FROM ({_text})"


def queries() -> dict[str, Query]:
    return {name: query for name, (query, _) in CATALOGUE.items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for name, (_, text) in CATALOGUE.items() if text}
