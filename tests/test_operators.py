"""Linking, merging, upserts and sources on small tables."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import linking, merging
from ledgerloom.operators.skew import join_by_key
from ledgerloom.sources import captures, pages, raw
from ledgerloom.streaming.incremental import work_off

SCHEMA = "row_idx long, startup_india_id string, name string, name_key string, website string, domain string, industry string, sector string, stage string, city string, state string, registration_date string, cin string, dpiit boolean, status string, phone string, role string"
BASE = dict.fromkeys(x.split()[0] for x in SCHEMA.split(", "))


def table(spark, *rows):
    return spark.createDataFrame([tuple((BASE | {"row_idx": i, "name": f"n{i}"} | r).values()) for i, r in enumerate(rows)], SCHEMA)


def groups(found):
    out = {}
    for r in found.collect():
        out.setdefault(r.cluster, set()).add(r.row_idx)
    return sorted(map(sorted, out.values()))


def test_links_are_transitive_across_kinds_and_null_states_merge(spark):
    rows = table(
        spark, {"cin": "C1", "domain": "a.in"}, {"domain": "a.in", "startup_india_id": "S1"}, {"startup_india_id": "S1"},
        {"name_key": "acme robotics private limited"}, {"name_key": "acme robotics private limited"}, {"name_key": "acme robotics private limited", "state": "Goa"}, {"name_key": "abc"}, {"name_key": "abc"},
    )
    assert groups(linking.clusters(rows)) == [[0, 1, 2], [3, 4], [5], [6], [7]]


def test_shared_and_generic_domains_do_not_link(spark):
    rows = table(spark, *({"domain": "dir.in", "cin": f"C{i}"} for i in range(3)), *({"domain": "in.linkedin.com"} for _ in range(2)))
    assert [tuple(r) for r in linking.shared_domains(rows).collect()] == [("dir.in", 0, 3)]
    assert len(groups(linking.clusters(rows))) == 5


def test_components_of_a_long_chain(spark):
    links = spark.range(400).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    got = linking.components(links)
    assert got.count() == 401 and got.select("cluster").distinct().collect()[0].cluster == 0


def test_merge_prefers_the_fullest_then_fills_gaps(spark):
    rows = table(
        spark, {"cin": "C1", "city": "Pune", "registration_date": "2020-01-01", "startup_india_id": "B"}, {"cin": "C1", "city": "Goa", "phone": "+919", "registration_date": "2019-01-01"},
        {"cin": "C1", "city": "Agra", "phone": "+918", "dpiit": True, "role": "x"},
    )
    got = merging.merge_clusters(rows, linking.clusters(rows)).collect()
    assert len(got) == 1
    m = got[0]
    assert (m.city, m.phone, m.role, m.registration_date, m.startup_india_id, m.dpiit_certified, m.source_count, m.duplicate_count) == ("Agra", "+918", "x", "2019-01-01", "B", True, 1, 3)
    assert [tuple(r) for r in merging.cluster_sources(rows, linking.clusters(rows)).collect()] == [(m.cluster, "B")]


def test_merge_tie_goes_to_the_first_record(spark):
    rows = table(spark, {"cin": "C1", "city": "Pune"}, {"cin": "C1", "city": "Goa"})
    assert merging.merge_clusters(rows, linking.clusters(rows)).first().city == "Pune"


def test_dense_ids(spark):
    ids = merging.with_dense_ids(spark.range(0, 1000, 3).select(F.col("id").alias("cluster")), after=10).orderBy("cluster").collect()
    assert [r.id for r in ids] == list(range(11, 11 + 334))


def test_upserts(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d"), (3, "e")], "k long, v string")
    assert sorted(map(tuple, merging.upsert(old, new, ["k"]).collect())) == [(1, "a"), (2, "c"), (3, "d"), (3, "e")]
    assert sorted(map(tuple, merging.insert_absent(old, new, ["k"], F.col("v")).collect())) == [(1, "a"), (2, "b"), (3, "d")]
    assert sorted(map(tuple, merging.latest(new, ["k"], F.col("v")).collect())) == [(2, "c"), (3, "e")]
    assert sorted(map(tuple, merging.set_status(old, new.where("k = 2"), "k", ["v"]).collect())) == [(1, "a"), (2, "c")]
    assert [r.k for r in merging.work_list(old, new, "k").collect()] == [1]


def test_join_by_key_keeps_hot_rows(spark, monkeypatch):
    rows = spark.range(200_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    per = rows.groupBy("k").agg(F.count("*").alias("n_rows"), F.lit(1).alias("one"))
    assert join_by_key(rows, per, "k").count() == 200_000


def test_csv_keeps_order_and_quoted_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text(",".join(raw.CSV_COLUMNS) + '\n"A ""X""\nLtd",1,Startup' + "," * 12 + "\nB Ltd,2,Mentor" + "," * 12 + "\n,3" + "," * 13 + "\n")
    rows = raw.read_csv(spark, str(tmp_path / "a.csv"))
    assert [(r.row_idx, r.name) for r in rows.orderBy("row_idx").collect()] == [(0, 'A "X"\nLtd'), (1, "B Ltd"), (2, None)]
    assert raw.read_csv(spark, str(tmp_path / "a.csv"), limit=1).count() == 1
    assert raw.normalize(rows).count() == 2 and raw.normalize(rows, startups_only=True).count() == 1


def test_csv_tells_empty_texts_from_nulls(spark, tmp_path):
    (tmp_path / "a.csv").write_text(",".join(raw.CSV_COLUMNS) + '\n"",1,' + "," * 12 + "\n,2,,\"\"" + "," * 11 + "\n N ,3, ," + "," * 11 + '""\n')
    rows = raw.read_csv(spark, str(tmp_path / "a.csv")).orderBy("row_idx").collect()
    assert [(r.name, r.id, r.role, r.state, r.contact_number) for r in rows] == [("", "1", None, None, None), (None, "2", None, "", None), (" N ", "3", " ", None, "")]


def test_csv_files_count_in_the_order_of_their_names(spark, tmp_path):
    head = ",".join(raw.CSV_COLUMNS) + "\n"
    for name, ids in (("c", range(4, 6)), ("a", range(0, 3)), ("b", range(3, 4))):
        (tmp_path / f"{name}.csv").write_text(head + "".join(f"N{i},{i}" + "," * 13 + "\n" for i in ids))
    assert [(r.row_idx, r.id) for r in raw.read_csv(spark, str(tmp_path)).orderBy("row_idx").collect()] == [(i, str(i)) for i in range(6)]


def test_robots_texts(spark):
    urls = spark.createDataFrame([(1, "https://a.in/"), (1, "https://a.in/privacy/x"), (2, "https://b.in/"), (3, "https://c.in/"), (4, "https://d.in/")], "k long, url string")
    robots = spark.createDataFrame([(1, "User-agent: *\nDisallow: /privacy"), (2, "User-agent: *\nDisallow: /"), (3, "User-agent: other\nDisallow: /\n\nUser-agent: *\nDisallow:"), (4, None)], "k long, robots string")
    assert sorted(r.url for r in captures.allowed(urls, robots, "k", "url", "robots").collect()) == ["https://a.in/", "https://c.in/", "https://d.in/"]


def test_tables_are_created_guarded_and_compared(spark, tmp_path):
    from ledgerloom.plans import captured

    assert captured.guard_rebuild(spark, str(tmp_path)) == 0
    captures.reset(spark, str(tmp_path))
    assert captured.guard_rebuild(spark, str(tmp_path)) == 0
    spark.createDataFrame([(1, "SI1")], captures.SCHEMAS["company_sources"]).write.mode("overwrite").parquet(f"{tmp_path}/company_sources.parquet")
    with pytest.raises(RuntimeError):
        captured.guard_rebuild(spark, str(tmp_path))
    assert captured.guard_rebuild(spark, str(tmp_path), force=True) == 1
    assert captured.changed({"a": 1}, {"a": 2}) and captured.changed({}, {"a": 0}) and not captured.changed({"a": 1}, {"a": 1})


def test_components_equal_union_find(spark):
    import random

    rng = random.Random(3)
    links = [(rng.randrange(150), rng.randrange(150)) for _ in range(90)] + [(500 + i, 501 + i) for i in range(60)]
    top = {}

    def find(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        top[b] = a
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert dict(map(tuple, linking.components(spark.createDataFrame(links, "u long, v long")).collect())) == {x: find(x) for x in linked}
    assert linking.components(spark.createDataFrame([(1, 1)], "u long, v long")).count() == 0


def test_refresh_and_drain(spark):
    from ledgerloom.streaming.incremental import drain

    old, new = spark.createDataFrame([(1, 10)], "k long, v long"), spark.createDataFrame([(1, 11), (2, 20)], "k long, v long")
    assert sorted(map(tuple, merging.refresh(old, new, ["k"]).collect())) == [(1, 10), (2, 20)]
    assert sorted(map(tuple, merging.refresh(old, new, ["k"], full=True).collect())) == [(1, 11), (2, 20)]
    left = [3, 5]

    def take(i):
        n = min(2, left[i])
        left[i] -= n
        return n

    assert drain([lambda: take(0), lambda: take(1)]) == 8 and left == [0, 0]
    with pytest.raises(RuntimeError):
        drain([lambda: 1], 3)


def test_stored_pages_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("acme.in", "<p>नमस्ते</p>"), ("b_c.in", "x")], "d string, html string").select(pages.stored_path(F.col("d"), F.lit("home")).alias("stored_path"), "html")
    assert pages.write_stored(rows, str(tmp_path)).count() == 2
    (tmp_path / "00" / "bad").mkdir(parents=True)
    (tmp_path / "00" / "bad" / "home.html.gz").write_bytes(b"no gzip")
    assert sorted(map(tuple, pages.read_stored(spark, str(tmp_path)).collect())) == sorted(map(tuple, rows.collect()))


def test_micro_batches_do_nothing_twice(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    spark.range(100).repartition(3).write.parquet(src)
    args = (spark, src, spark.range(1).schema, lambda b: b, out, ck)
    assert work_off(*args) == 100 and work_off(*args) == 0
    assert spark.read.parquet(out).count() == 100


def test_phones_of_links_to_call(spark, monkeypatch):
    from ledgerloom.plans import catalogue

    html = """<p>Call</p><a class="b" href="tel:+91-98765-43210">us</a><A HREF='tel:09123456780'>or</A><a data-href="tel:9000000001">no</a><a href="/tel">9888877776</a>"""
    pages = spark.createDataFrame([(1, "contact", 2, html), (1, "home", 3, '<a href="tel:9876543210">x</a>')], "company_id long, page_type string, id long, html string")
    monkeypatch.setattr(catalogue, "_wrapped", lambda *_: pages)
    found = catalogue._page_phones(spark, "")
    assert {tuple(r) for r in found.select("company_id", "phone", "source_page").collect()} == {(1, "+919876543210", "home"), (1, "+919123456780", "contact"), (1, "+919888877776", "contact")}


def test_company_keywords(spark, monkeypatch):
    from ledgerloom.plans import catalogue

    tables = {
        "companies": spark.createDataFrame([(1, "Logistics", "Freight"), (2, None, "n/a")], "id long, industry string, sector string"),
        "company_enrichment": spark.createDataFrame([(1, "With your freight we move cargo, and cargo this way. Solutions based on barges", None)], "company_id long, description string, updated_at timestamp"),
    }
    monkeypatch.setattr(catalogue, "table", lambda s, f, name: tables[name])
    monkeypatch.setattr(catalogue, "_technologies", lambda *_: spark.createDataFrame([(1, "WordPress"), (1, "jQuery")], "company_id long, technology string"))
    assert dict(map(tuple, catalogue._company_keywords(spark, "").collect())) == {1: "Logistics,Freight,WordPress,cargo,move,barges", 2: ""}
