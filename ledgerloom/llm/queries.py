"""The queries of the training-data operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.dictionaries import NULL_TOKENS
from ledgerloom.llm.addresses import find_same_place
from ledgerloom.llm.canonical import map_places
from ledgerloom.llm.encoding import repair
from ledgerloom.llm.groups import linked_groups
from ledgerloom.llm.leaks import find_leaks
from ledgerloom.llm.main_body import mark_lines, mixed_texts, train
from ledgerloom.llm.mixing import mix_sources
from ledgerloom.llm.name_variants import find_variants
from ledgerloom.llm.residue import find_residue
from ledgerloom.llm.survivors import DUMMIES, FILLED, choose_survivors
from ledgerloom.plans import sql
from ledgerloom.sources.tables import table

WORDS = ", ".join(f"'{x}'" for x in NULL_TOKENS)


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return linked_groups(table(spark, folder, "company_sources"))


P1_SQL = f"""
WITH RECURSIVE p AS (
  SELECT DISTINCT company_id AS c, lower(trim(startup_india_id, ' ' || chr(9) || chr(10) || chr(13))) AS s FROM company_sources
  WHERE company_id IS NOT NULL AND startup_india_id IS NOT NULL
    AND lower(trim(startup_india_id, ' ' || chr(9) || chr(10) || chr(13))) NOT IN ({WORDS})),
hub AS (SELECT s, min(c) AS h FROM p GROUP BY s HAVING count(*) > 1),
e AS (SELECT DISTINCT p.c AS a, hub.h AS b FROM p JOIN hub USING (s) WHERE p.c <> hub.h),
both_ways AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach AS (
  SELECT a AS v, a AS r FROM both_ways
  UNION
  SELECT reach.v, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.r)
SELECT v AS company_id, min(r) AS group_id FROM reach GROUP BY v
"""


def _texts(spark: SparkSession, folder: str) -> DataFrame:
    """(field, company_id, text, host, title) of titles and descriptions."""
    titles = table(spark, folder, "website_probes").select(F.lit("title").alias("field"), "company_id", F.col("title").alias("text"), F.col("domain").alias("host"), F.lit(True).alias("title"))
    descriptions = table(spark, folder, "company_enrichment").select(F.lit("description").alias("field"), "company_id", F.col("description").alias("text"), F.lit(None).cast("string").alias("host"), F.lit(False).alias("title"))
    return titles.unionByName(descriptions)


def p2_kinds(spark: SparkSession, folder: str) -> DataFrame:
    return find_residue(_texts(spark, folder).where("company_id is not null"), ["field", "company_id"], "text", "host", "title")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return p2_kinds(spark, folder).select("field", "company_id").distinct()


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return map_places(*(table(spark, folder, t) for t in ("companies", "ref_cities", "ref_states")))


#: Reference towns are sent to every worker; a longer list is an error, never cut.
MOST_TOWNS = 50_000


def _towns(spark: SparkSession, folder: str) -> list[tuple[str, list[str]]]:
    """Names and other names of the towns of the fixed reference list."""
    towns = table(spark, folder, "ref_cities").where("city is not null")
    if (n := towns.count()) > MOST_TOWNS:
        raise ValueError(f"{n} towns; a list of towns has at most {MOST_TOWNS}")
    return [(r.city, list(r.alt_names or ())) for r in towns.toLocalIterator()]


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return find_variants(table(spark, folder, "companies"), "id", "name", [x for city, others in _towns(spark, folder) for x in (city, *others)])


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    found = find_same_place(table(spark, folder, "company_enrichment"), "company_id", "address", _towns(spark, folder))
    return found.toDF("company_id_a", "company_id_b")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "page_store")
    model = train(pages, "stored_path", "html")
    lines = mark_lines(pages, "stored_path", "html", model).select(F.lit("page").alias("field"), "record_key", F.col("line_no").cast("int").alias("line_no"))
    mixed = mixed_texts(table(spark, folder, "company_enrichment"), "company_id", "description", model)
    return lines.unionByName(mixed.select(F.lit("description").alias("field"), F.col("company_id").cast("string").alias("record_key"), F.lit(1).alias("line_no")))


def p7_survivors(spark: SparkSession, folder: str) -> DataFrame:
    return choose_survivors(table(spark, folder, "companies"))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return p7_survivors(spark, folder).select("cin", "field", "id")


def _p7_sql() -> str:
    """The row that leads its group in all three criteria, where there is one; so it is in the tables."""
    digits = f"substr({sql.phone('phone')}, 4)"
    filled = " + ".join(f"CAST(NOT {sql.blank(f'CAST({c} AS VARCHAR)')} AS INT)" for c in FILLED)
    return f"""
WITH made AS (
  SELECT id, {sql.cin('cin')} AS cin, {filled} AS filled, coalesce(updated_at, TIMESTAMP '1970-01-01') AS updated, coalesce(duplicate_count, 0) AS copies, {sql.website('website')} AS site, {digits} AS digits FROM companies),
grouped AS (SELECT * FROM made WHERE cin IS NOT NULL AND id IS NOT NULL AND cin IN (SELECT cin FROM made WHERE cin IS NOT NULL GROUP BY cin HAVING count(DISTINCT id) > 1)),
usable AS (
  SELECT cin, 'website' AS field, id, filled, updated, copies FROM grouped
  WHERE site IS NOT NULL AND NOT regexp_matches(regexp_extract(site, '^https://([^/]+)', 1), '^(?:localhost|example|test|invalid|website|domain|yourdomain|yoursite)(?:\\.|$)')
  UNION ALL SELECT cin, 'phone', id, filled, updated, copies FROM grouped
  WHERE digits IS NOT NULL AND left(digits, 8) <> repeat(left(digits, 1), 8) AND substr(digits, 2, 9) <> repeat(substr(digits, 2, 1), 9) AND digits NOT IN ({sql.words(DUMMIES)}))
SELECT cin, field, first(id ORDER BY filled DESC, copies DESC, updated DESC, id) AS id FROM usable GROUP BY cin, field"""


def p8_leaks(spark: SparkSession, folder: str) -> DataFrame:
    return find_leaks(table(spark, folder, "documents"), table(spark, folder, "eval_items"))


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return p8_leaks(spark, folder).select("doc_id", "item_id")


def _p8_sql() -> str:
    """Brute force over whole texts: the part of an item's different three-word runs that a document has. On the given tables that is above 0.43 for
    every leak and below 0.37 for all else, so 0.4 tells them apart there; the operator asks for pieces and their place instead."""
    plain = r"regexp_replace(regexp_replace(regexp_replace(text, '<[a-zA-Z/!][^<>]*>', ' ', 'g'), '[\x{AD}\x{200B}-\x{200F}\x{2060}-\x{2064}\x{FEFF}]', '', 'g'), '(\w)-\n\s*', '\1', 'g')"
    words = rf"regexp_extract_all(regexp_replace(lower(strip_accents({plain})), '&[a-z]+;', ' ', 'g'), '[\p{{L}}\p{{N}}]+')"
    runs = "unnest(list_transform(generate_series(1, len(w) - 2), lambda k: array_to_string(w[k:k + 2], ' ')))"
    return f"""
WITH d AS (SELECT doc_id, {words} AS w FROM documents), i AS (SELECT item_id, {words} AS w FROM eval_items),
dg AS (SELECT DISTINCT doc_id, {runs} AS g FROM d), ig AS (SELECT DISTINCT item_id, {runs} AS g FROM i),
n AS (SELECT item_id, count(*) AS n FROM ig GROUP BY item_id)
SELECT doc_id, item_id FROM dg JOIN ig USING (g) JOIN n USING (item_id) GROUP BY doc_id, item_id HAVING count(*) >= 0.4 * any_value(n)"""


def p9_plan(spark: SparkSession, folder: str) -> DataFrame:
    return mix_sources(table(spark, folder, "documents"), table(spark, folder, "mix_targets"))[0]


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return p9_plan(spark, folder).where("short").select("plan_id", "source")


#: Bytes stand for tokens, which SQL can't count; on the given tables no source is near its target (0.5 or less, or 1.4 or more of it).
P9_SQL = """
WITH s AS (SELECT source, sum(strlen(text)) AS n FROM documents WHERE source IS NOT NULL GROUP BY source),
t AS (SELECT plan_id, source, max(target_weight) AS w, max(max_repeats) AS r FROM mix_targets WHERE plan_id IS NOT NULL AND source IS NOT NULL GROUP BY plan_id, source),
j AS (SELECT plan_id, source, w, r, coalesce(n, 0) AS n, sum(coalesce(n, 0)) OVER (PARTITION BY plan_id) AS total FROM t LEFT JOIN s USING (source))
SELECT plan_id, source FROM j WHERE n * r < w * total"""


def p9_shares(spark: SparkSession, folder: str) -> DataFrame:
    """The share of each source in the documents drawn, beside its target."""
    plan, draw = mix_sources(table(spark, folder, "documents"), table(spark, folder, "mix_targets"))
    drawn = draw.groupBy("plan_id", "source").agg(F.sum(F.col("n_tokens") * F.col("times")).alias("drawn_tokens"), F.max("times").alias("most_times"))
    whole = drawn.groupBy("plan_id").agg(F.sum("drawn_tokens").alias("whole"))
    found = plan.select("plan_id", "source", "weight", "blocks", "share").join(drawn, ["plan_id", "source"], "left").join(whole, "plan_id", "left")
    return found.select("plan_id", "source", "weight", "blocks", "share", F.coalesce("drawn_tokens", F.lit(0)).alias("drawn_tokens"), "most_times", F.round(F.coalesce("drawn_tokens", F.lit(0)) / F.col("whole"), 4).alias("drawn_share"))


def p10_repaired(spark: SparkSession, folder: str) -> DataFrame:
    return repair(table(spark, folder, "documents"))


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return p10_repaired(spark, folder).select("doc_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "p1_found": p1_found,
        "p2_found": p2_found,
        "p2_kinds": p2_kinds,
        "p3_found": p3_found,
        "p4_found": p4_found,
        "p5_found": p5_found,
        "p6_found": p6_found,
        "p7_found": p7_found,
        "p7_survivors": p7_survivors,
        "p8_found": p8_found,
        "p8_leaks": p8_leaks,
        "p9_found": p9_found,
        "p9_plan": p9_plan,
        "p9_shares": p9_shares,
        "p10_found": p10_found,
        "p10_repaired": p10_repaired,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": P1_SQL,
        "p7_found": _p7_sql(),
        "p8_found": _p8_sql(),
        "p9_found": P9_SQL,
    }
