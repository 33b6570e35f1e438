"""Facts from captured pages, probes and DNS answers."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.dictionaries import ANALYTICS_ID_PATTERN, EMAIL_JUNK, EMAIL_JUNK_DOMAINS, EMAIL_PATTERN, FOUNDED_PATTERN, GITHUB_PAGES_IPS, HOSTING_SIGNS, PAGE_WORDS, SOCIAL_HOSTS, SOCIAL_NO_PROFILE, SOCIAL_SKIP, STAFF_PATTERN, TEAM_OF_PATTERN, TECHNOLOGIES
from ledgerloom.functions import urls
from ledgerloom.functions.text import collapse, or_null

def title(html: Column) -> Column:
    return or_null(F.substring(collapse(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)), 1, 300))


def founded_year(text: Column, this_year: int) -> Column:
    """The first year named as that of the foundation, unless it lies outside 1900 to this year."""
    year = F.regexp_extract(text, FOUNDED_PATTERN, 1).try_cast("int")
    return F.when(year.between(1900, this_year), year)


def staff_phrase(text: Column) -> Column:
    return F.coalesce(or_null(F.trim(F.regexp_extract(text, STAFF_PATTERN, 0))), or_null(F.trim(F.regexp_extract(text, TEAM_OF_PATTERN, 0))))


def address_near_pin(text: Column) -> Column:
    """The first six-digit number and up to 80 characters before it."""
    at = F.regexp_instr(text, F.lit(r"\b\d{6}\b"))
    return F.when(at > 0, or_null(collapse(F.substring(text, F.greatest(at - 80, F.lit(1)), at + 6 - F.greatest(at - 80, F.lit(1))))))


def emails(html: Column) -> Column:
    """Sorted different addresses in a page, without assets and placeholder hosts."""
    found = F.transform(F.regexp_extract_all(html, F.lit(f"({EMAIL_PATTERN})"), 1), lambda e: F.regexp_replace(F.lower(e), r"^\.+|\.+$", ""))

    def wanted(e: Column) -> Column:
        junk = F.lit(False)
        for part in EMAIL_JUNK:
            junk = junk | F.contains(e, F.lit(part))
        for host in EMAIL_JUNK_DOMAINS:
            junk = junk | F.endswith(e, F.lit("@" + host)) | F.endswith(e, F.lit("." + host))
        return ~junk & (F.length(e) <= 100)

    return F.array_sort(F.array_distinct(F.filter(found, wanted)))


SIGN = "struct<technology:string,category:string,evidence:string>"


def technologies(html: Column, server: Column | None = None, powered: Column | None = None) -> Column:
    """(technology, category, evidence) of each technology that the page or its headers give away.

    The first of a technology's texts that stands in the page is its evidence, and an analytics id goes before it. The page is lowered
    once, in the outer function's array, and searched for each text once.
    """
    signs = F.array(*(F.struct(F.lit(n).alias("technology"), F.lit(c).alias("category"), F.lit(x).alias("evidence")) for n, c, texts in TECHNOLOGIES for x in texts))
    seen = F.transform(F.array(F.lower(html)), lambda low: F.filter(signs, lambda s: F.contains(low, s.evidence)))
    found = F.transform(seen, lambda all_: F.filter(all_, lambda s, i: (i == 0) | (F.get(all_, i - 1).technology != s.technology)))[0]
    name = F.regexp_extract(html, ANALYTICS_ID_PATTERN, 0)
    sign = lambda when, tech, kind, evidence: F.when(when, F.struct(F.lit(tech).alias("technology"), F.lit(kind).alias("category"), evidence.alias("evidence")))
    sure = [sign(name.startswith("GTM-"), "Google Tag Manager", "analytics", name), sign((name != "") & ~name.startswith("GTM-"), "Google Analytics", "analytics", name)]
    more = []
    if server is not None:
        sure.append(sign(F.contains(F.lower(server), F.lit("cloudflare")), "Cloudflare", "cdn", F.lit("server: cloudflare")))
    if powered is not None:
        by = F.lower(powered)
        more = [sign(F.contains(by, F.lit(x.lower())), x, "backend", F.concat(F.lit("x-powered-by: "), by)) for x in ("PHP", "Express")]
    known = F.array_compact(F.array(*sure))
    return F.concat(known, F.filter(found, lambda s: ~F.exists(known, lambda k: k.technology == s.technology)), F.array_compact(F.array(*more)) if more else F.array().cast(f"array<{SIGN}>"))


def hosting(addresses: Column, names: Column, reverse: Column, server: Column) -> Column:
    """The provider that addresses, name servers, reverse name or server header give away, else the server's own name."""
    hay = F.lower(F.concat_ws(" ", F.array_join(names, " "), F.coalesce(reverse, F.lit("")), F.coalesce(server, F.lit(""))))
    found = F.when(F.coalesce(F.arrays_overlap(addresses, F.array(*map(F.lit, GITHUB_PAGES_IPS))), F.lit(False)), "GitHub Pages")
    for needle, provider in HOSTING_SIGNS:
        found = found.when(F.contains(hay, F.lit(needle)), provider)
    return found.otherwise(or_null(F.trim(F.substring_index(F.substring_index(server, "/", 1), "(", 1))))


def mail_hosts(answers: Column) -> Column:
    """Mail hosts of MX answers by priority (999 where it is no number), in their order within one."""

    def one(a: Column, i: Column) -> Column:
        parts = F.split(a, r"\s+")
        first = F.coalesce(F.get(parts, F.lit(0)).try_cast("int"), F.lit(999))
        return F.struct(first.alias("p"), i.alias("i"), F.regexp_replace(F.coalesce(F.get(parts, F.lit(1)), a), r"\.+$", "").alias("h"))

    return F.transform(F.array_sort(F.transform(answers, one)), lambda x: x.h)


def text_record(answers: Column, mark: str) -> Column:
    """The first TXT answer that holds the mark, without quotes."""
    return F.get(F.transform(F.filter(answers, lambda a: F.contains(F.lower(a), F.lit(mark))), lambda a: F.regexp_replace(a, '^"+|"+$', "")), F.lit(0))


def platform(url: Column) -> Column:
    """The social platform a link leads to a profile on."""
    low = F.lower(url)
    skip = F.lit(False)
    for part in SOCIAL_SKIP:
        skip = skip | F.contains(low, F.lit(part))
    found = F.when(skip, F.lit(None).cast("string"))
    for name, hosts in SOCIAL_HOSTS.items():
        hit = F.lit(False)
        for host in hosts:
            hit = hit | F.contains(low, F.lit(host))
        found = found.when(hit, name)
    path = F.regexp_replace(F.regexp_extract(low, r"^(?:[a-z][a-z0-9+.\-]*:)?//[^/?#]*([^?#]*)", 1), "/+$", "")
    return F.when(~path.isin(*SOCIAL_NO_PROFILE), found)


class _Reader(HTMLParser):
    """Visible text, links, metas, icon and linked data of one page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.text: list[str] = []
        self.links: list[list[str]] = []
        self.metas: dict[str, str] = {}
        self.icon, self.touch, self.data = None, None, []
        self._hidden, self._json, self._open = 0, None, None

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        if tag in ("script", "style"):
            self._hidden += 1
            if a.get("type") == "application/ld+json":
                self._json = []
        elif tag == "a" and "href" in a:
            self._open = [a["href"].strip(), ""]
            self.links.append(self._open)
        elif tag == "meta" and a.get("content"):
            for key in ("property", "name"):
                if a.get(key):
                    self.metas.setdefault(f"{key}:{a[key]}", a["content"].strip())
        elif tag == "link" and a.get("href"):
            if "apple-touch-icon" in a.get("rel", ""):
                self.touch = self.touch or a["href"]
            if "icon" in a.get("rel", "").lower():
                self.icon = self.icon or a["href"]

    def handle_endtag(self, tag):
        if tag in ("script", "style") and self._hidden:
            self._hidden -= 1
            if self._json is not None:
                self.data.append("".join(self._json))
                self._json = None
        elif tag == "a":
            self._open = None

    def handle_data(self, data):
        if self._json is not None:
            self._json.append(data)
        elif not self._hidden and data.strip():
            self.text.append(data.strip())
            if self._open:
                self._open[1] = f"{self._open[1]} {data.strip()}".strip()


def read_page(html: str | None) -> _Reader:
    reader = _Reader()
    reader.feed(html or "")
    reader.close()
    return reader


def _nodes(data) -> list[dict]:
    """The objects of a block of linked data: a list's, a graph's, or the block itself."""
    if isinstance(data, dict):
        data = data["@graph"] if isinstance(data.get("@graph"), list) else [data]
    return [x for x in data if isinstance(x, dict)] if isinstance(data, list) else []


def _of_organization(node: dict) -> dict:
    kinds = node.get("@type") or []
    if not {"Organization", "Corporation", "LocalBusiness"}.intersection([kinds] if isinstance(kinds, str) else kinds):
        return {}
    place = node["address"] if isinstance(node.get("address"), dict) else {}
    year = re.search(r"(?:19|20)\d{2}", str(node.get("foundingDate") or ""))
    made = {
        "name": str(node.get("name") or ""),
        "year": int(year[0]) if year else 0,
        "address": ", ".join(str(place[k]) for k in ("streetAddress", "addressLocality", "addressRegion", "postalCode", "addressCountry") if place.get(k)),
    }
    return {k: v for k, v in made.items() if v}


def _organization(blocks: list[str]) -> dict:
    """Name, year and address, each from the first organization in linked data that has it; broken blocks are skipped."""
    out: dict = {}
    for block in blocks:
        try:
            data = json.loads(block)
        except ValueError:
            continue
        for node in _nodes(data):
            out = _of_organization(node) | out
    return out


PAGE_FACTS = "text string, site_name string, description string, logo string, favicon string, org_name string, org_year int, org_address string, links array<struct<href:string,label:string>>"


def page_facts(pages: DataFrame, key: str, html: str, base: str) -> DataFrame:
    """(key, facts) of each page, read once; base: the page's address, which relative links are joined to."""
    schema = f"key {pages.schema[key].dataType.simpleString()}, {PAGE_FACTS}"

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for k, h, u in zip(b.key, b.html, b.base):
                r, u = read_page(h), u or ""
                org = _organization(r.data)
                links = []
                for href, label in r.links:
                    try:
                        links.append({"href": urljoin(u, href), "label": label})
                    except ValueError:
                        continue
                m = r.metas
                rows.append((k, " ".join(r.text), m.get("property:og:site_name"), m.get("property:og:description") or m.get("name:description"), m.get("property:og:image") or r.touch, urljoin(u, r.icon) if r.icon else urljoin(u, "/favicon.ico") if u else None, org.get("name"), org.get("year"), org.get("address"), links))
            yield pd.DataFrame(rows, columns=["key", "text", "site_name", "description", "logo", "favicon", "org_name", "org_year", "org_address", "links"])

    return pages.select(F.col(key).alias("key"), F.col(html).alias("html"), F.col(base).alias("base")).mapInPandas(read, schema).withColumnRenamed("key", key)


ANCHOR = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*"([^"]*)"[^>]*>(.*?)</a>"""


def anchors(html: Column) -> Column:
    """(href, label) of the links of a page, in their order."""
    hrefs, labels = (F.regexp_extract_all(html, F.lit(ANCHOR), i) for i in (1, 2))
    return F.zip_with(hrefs, labels, lambda h, t: F.struct(F.trim(h).alias("href"), collapse(F.regexp_replace(t, "<[^>]*>", " ")).alias("label")))


def page_types(href: Column, label: Column, address: Column) -> Column:
    """The page types that a link's words, or its address' path, name."""
    hay = F.lower(F.concat_ws(" ", href, label))
    path = F.lower(F.regexp_extract(address, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*([^?#]*)", 1))
    return F.array_compact(F.array(*(F.when(F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(hay, w) | F.contains(path, w)), t) for t, words in PAGE_WORDS.items())))


def discovered(homes: DataFrame, key: str, html: str, url: str, root: str) -> DataFrame:
    """(key, page_type, url) of the first link of each home page to each page type on its own site; mail, phone, script and in-page links lead nowhere."""
    links = homes.select(F.col(key), F.col(url).alias("_base"), F.col(root).alias("_root"), F.posexplode(anchors(F.col(html))).alias("_pos", "_a"))
    links = links.where((F.col("_a.href") != "") & ~F.col("_a.href").rlike("^(?:mailto:|tel:|javascript:|#)"))
    links = links.withColumn("url", urls.join(F.col("_base"), F.col("_a.href")))
    own = links.where(urls.is_same_site(urls.domain(F.col("url")), F.col("_root")))
    kinds = own.select(key, "url", "_pos", F.explode(page_types(F.col("_a.href"), F.col("_a.label"), F.col("url"))).alias("page_type"))
    return kinds.groupBy(key, "page_type").agg(F.min_by("url", "_pos").alias("url"))


def favicon(html: Column, base: Column) -> Column:
    """The address of the first icon a page links to, else the usual place on its host."""
    tag = F.regexp_extract(html, r"""(?i)<link[^>]+rel=["']?[^"'>]*icon[^"'>]*["']?[^>]*>""", 0)
    href = F.regexp_extract(tag, r"""(?i)href=["']([^"']+)["']""", 1)
    return urls.join(base, F.when(href != "", href).otherwise("/favicon.ico"))
