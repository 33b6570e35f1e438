"""Column functions against literal cases."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import completions, mail, names, places, records, urls, web


def one(spark, make, *values):
    row = spark.createDataFrame([values], ", ".join(f"c{i} string" for i in range(len(values))))
    return row.select(make(*(F.col(f"c{i}") for i in range(len(values)))).alias("x")).first().x


@pytest.mark.parametrize(
    "raw, site, host",
    [
        ("https://abc-x.com/", "https://abc-x.com", "abc-x.com"),
        ("www.abc-x.com", "https://abc-x.com", "abc-x.com"),
        ("http://abc-x.com/about/", "https://abc-x.com/about", "abc-x.com"),
        ("www.foo.co.", "https://foo.co", "foo.co"),
        ("CRSPORTS.IN", "https://crsports.in", "crsports.in"),
        (".abc-x.com", "https://abc-x.com", None),
        ("ftp://u@shop.co.in:8080/Path/", "https://shop.co.in/Path", "shop.co.in"),
        ("Not Available", None, None),
        ("", None, None),
        (None, None, None),
        ("localhost", None, None),
    ],
)
def test_website_and_domain(spark, raw, site, host):
    assert one(spark, urls.website, raw) == site
    assert one(spark, urls.domain, raw) == host


@pytest.mark.parametrize("host, generic", [("in.linkedin.com", True), ("linkedin.com", True), ("acme.com", False), ("notlinkedin.com", False), (None, False)])
def test_generic_domain(spark, host, generic):
    assert one(spark, urls.is_generic_domain, host) is generic


@pytest.mark.parametrize("raw, number", [("9555665293", "+919555665293"), ("09555665293", "+919555665293"), ("+91 98688 98764", "+919868898764"), ("123", None), ("", None), (None, None), ("9876543210 9123456780", "+919123456780"), ("5555555555", None)])
def test_phone(spark, raw, number):
    assert one(spark, records.phone, raw) == number


@pytest.mark.parametrize("raw, clean", [("u14201up2023ptc191848", "U14201UP2023PTC191848"), (" U14201 UP2023PTC191848", "U14201UP2023PTC191848"), ("ABZ-8755", None), (None, None)])
def test_cin(spark, raw, clean):
    assert one(spark, records.cin, raw) == clean


@pytest.mark.parametrize("raw, epoch, day", [("28-02-2024", None, "2024-02-28"), ("2021-7-4", None, "2021-07-04"), ("05/03/2019", None, "2019-03-05"), ("12/25/2018", None, "2018-12-25"), ("31-02-2020", None, None), (None, "1709083608634", "2024-02-28"), ("garbage", "x", None)])
def test_registration_date(spark, raw, epoch, day):
    got = one(spark, records.registration_date, raw, epoch)
    assert got == day and (got is None or date.fromisoformat(got))


@pytest.mark.parametrize("raw, yes", [("TRUE", True), (" y", True), ("FALSE", False), ("", False), (None, False)])
def test_flag(spark, raw, yes):
    assert one(spark, records.flag, raw) is yes


@pytest.mark.parametrize("raw, key", [("ABC Pvt Ltd", "abc private limited"), ("ABC Private Limited", "abc private limited"), ("ABC Pvt. Ltd.", "abc private limited"), ("A & B Co.", "a and b co"), ("--", None), (None, None)])
def test_name_key(spark, raw, key):
    assert one(spark, names.name_key, raw) == key


@pytest.mark.parametrize(
    "raw, shown",
    [
        ("HOSEENU BUILDERS PRIVATE LIMITED", "Hoseenu Builders Private Limited"),
        ("PredictML.ai", "PredictML.ai"),
        ("ABC Pvt. Ltd.", "ABC Private. Limited."),
        ("Foo Pvt.Ltd", "Foo PrivateLimited"),
        ("O'NEIL A.B.C 3D-WORKS", "O'Neil A.B.C 3D-Works"),
        ("  x   llp ", "x LLP"),
        ("n/a", None),
    ],
)
def test_display_name(spark, raw, shown):
    assert one(spark, names.display_name, raw) == shown


@pytest.mark.parametrize("raw, state", [("orissa", "Odisha"), ("TAMIL  NADU", "Tamil Nadu"), ("Pondicherry", "Puducherry"), ("Jammu & Kashmir", "Jammu and Kashmir"), ("atlantis of the sea", "Atlantis of the Sea"), ("na", None)])
def test_state(spark, raw, state):
    assert one(spark, places.state, raw) == state


@pytest.mark.parametrize("raw, city", [("bangalore", "Bengaluru"), ("GURGAON", "Gurugram"), ("Hosur-2", "Hosur"), ("-", None), ("12", None)])
def test_city(spark, raw, city):
    assert one(spark, places.city, raw) == city


def test_page_text_facts(spark):
    assert one(spark, lambda t: web.founded_year(t, 2026), "Since 2099. Founded in 2018.") is None
    assert one(spark, lambda t: web.founded_year(t, 2026), "Established: 2018") == 2018
    assert one(spark, web.staff_phrase, "We are 1,200+ employees") == "1,200+ employees"
    assert one(spark, web.staff_phrase, "a team of 45 in Pune") == "team of 45"
    assert one(spark, web.address_near_pin, "x " * 60 + "Main Road 560001 and 560002").endswith("Main Road 560001")
    assert one(spark, web.emails, "A@real.com b@example.com logo@2x.png .c@real.com.") == ["a@real.com", "c@real.com"]
    assert one(spark, web.title, "<TITLE a=1> Hi \n there </title>") == "Hi there"


def test_technologies_and_hosting(spark):
    assert one(spark, web.technologies, '<link href="/wp-content/x.css"><script src="/_next/static/a.js">') == [("WordPress", "cms", "/wp-content/"), ("Next.js", "js-framework", "/_next/static")]
    ids = lambda x: {t.technology: t.evidence for t in one(spark, web.technologies, x)}
    assert ids("gtag( UA-12345-1 GTM-ABCD") == {"Google Analytics": "UA-12345-1", "Google Tag Manager": "gtm-"} and ids("<i>GTM-ABCD</i>") == {"Google Tag Manager": "GTM-ABCD"} and ids("") == {}
    heads = spark.createDataFrame([("laravel", "cloudflare-x", "PHP/8 Express")], "h string, s string, p string").select(web.technologies(F.col("h"), F.col("s"), F.col("p")).alias("t")).first().t
    assert [tuple(x) for x in heads] == [("Cloudflare", "cdn", "server: cloudflare"), ("Laravel", "backend", "laravel"), ("PHP", "backend", "x-powered-by: php/8 express"), ("Express", "backend", "x-powered-by: php/8 express")]
    make = lambda s: web.hosting(F.array(F.lit("185.199.108.153")), F.array().cast("array<string>"), F.lit(None).cast("string"), s)
    assert one(spark, make, "nginx/1.18") == "GitHub Pages"
    make = lambda s: web.hosting(F.array().cast("array<string>"), F.array(F.lit("kate.ns.cloudflare.com")), F.lit(None).cast("string"), s)
    assert one(spark, make, None) == "Cloudflare"
    make = lambda s: web.hosting(F.array().cast("array<string>"), F.array().cast("array<string>"), F.lit(None).cast("string"), s)
    assert one(spark, make, "nginx/1.18 (Ubuntu)") == "nginx"


def test_dns_answers(spark):
    row = spark.createDataFrame([(["x mail.odd.", "20 b.example.", "10 a.example."], ["foo", '"V=SPF1 a"'])], "mx array<string>, txt array<string>")
    got = row.select(web.mail_hosts(F.col("mx")).alias("m"), web.text_record(F.col("txt"), "v=spf1").alias("s")).first()
    assert got.m == ["a.example", "b.example", "mail.odd"] and got.s == "V=SPF1 a"


@pytest.mark.parametrize("url, name", [("https://www.linkedin.com/company/acme", "linkedin"), ("https://x.com/acme", "twitter"), ("https://facebook.com/sharer.php?u=1", None), ("https://youtube.com/watch", None), ("https://fedex.com/track/1", "twitter"), ("https://acme.com/a", None)])
def test_platform(spark, url, name):
    assert one(spark, web.platform, url) == name


def test_read_page():
    html = """<head><meta property="og:site_name" content=" Acme "><meta name="description" content="d"><link rel="apple-touch-icon" href="/t.png">
    <script type="application/ld+json">{"@graph": [{"@type": ["Organization"], "name": "N", "foundingDate": "2018-01", "address": {"streetAddress": "S", "postalCode": 1}}]}</script>
    <script type="application/ld+json">{broken</script></head><body><a href="/about">About <b>us</b></a><script>var x</script><p>Hello</p>"""
    r = web.read_page(html)
    assert r.metas["property:og:site_name"] == "Acme" and r.touch == "/t.png" and r.links == [["/about", "About us"]] and r.text == ["About", "us", "Hello"]
    assert web._organization(r.data) == {"name": "N", "year": 2018, "address": "S, 1"}


def test_page_discovery(spark):
    html = """<a href="/about">Us</a> <a href='x'>no</a> <a class="b" href="https://www.acme.com/contact-us">Reach</a><a href="https://evil.com/careers">Jobs</a><a href="https://acme.com.evil.com/team">T</a>
    <a href="mailto:blog@acme.com">m</a><a href="#terms">t</a><a href="http://[bad">privacy</a><a href="news">n</a><a href="/about-2">About</a>"""
    homes = spark.createDataFrame([(1, html, "https://acme.com/", "acme.com"), (2, None, "https://b.in/", "b.in")], "k long, html string, url string, root string")
    assert {tuple(r) for r in web.discovered(homes, "k", "html", "url", "root").collect()} == {(1, "about", "https://acme.com/about"), (1, "contact", "https://www.acme.com/contact-us"), (1, "blog", "https://acme.com/news")}


@pytest.mark.parametrize("base, href, want", [("https://a.in", "b", "https://a.in/b"), ("https://a.in/x/y?z=/q", "b", "https://a.in/x/b"), ("https://a.in/x/", "/b", "https://a.in/b"), ("http://a.in/x", "//c.in/d", "http://c.in/d"), ("https://a.in", "tel:1", "tel:1")])
def test_links_are_joined(spark, base, href, want):
    assert one(spark, urls.join, base, href) == want


def test_addresses_and_answers(spark):
    assert [one(spark, mail.valid_syntax, x) for x in ("a@b.com", "not-an-email", "a@@b.com", None, "a" * 250 + "@b.com")] == [True, False, False, False, False]
    assert one(spark, lambda x: mail.is_disposable(mail.host(x)), "x@Mailinator.com") and not one(spark, lambda x: mail.is_disposable(mail.host(x)), "x@acme.com")
    assert one(spark, mail.tokens, "Careers.pune_7@x.in") == ["careers", "pune", ""] and one(spark, mail.tokens, "care12@x.in") == ["care"]
    codes = spark.createDataFrame([(250,), (251,), (550,), (451,), (None,)], "c int")
    assert [r[0] for r in codes.select(mail.accepted(F.col("c"))).collect()] == [True, True, False, False, False]


@pytest.mark.parametrize("text, want", [('```json\n{"a": 1}\n```', '{"a": 1}'), ('so {"a": {"b": 2}} it is', '{"a": {"b": 2}}'), ("none", None), ('{"a": ', None), ("}{", None), (None, None), ("", None)])
def test_json_of_answers(spark, text, want):
    assert one(spark, completions.json_text, text) == want


def test_short_descriptions(spark):
    make = lambda *x: one(spark, completions.short_description, *x)
    assert make(None, "Acme", None, "Pune", "Scaling") == "Acme is a scaling-stage technology company based in Pune." and make("", None, None, None, None) is None
    assert make("a  b", "x", None, None, None) == "a b" and make("word " * 60, "x", None, None, None) == ("word " * 40).strip() and make("y" * 300, "x", None, None, None) == "y" * 200
    assert one(spark, lambda t: completions.signs(t, ["shop", "b2c", "kirana"]), "Shop shop Kirana") == 2
