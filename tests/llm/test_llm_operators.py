"""The training-data operators on small tables, beside brute force and on the odd cases."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import addresses, boosting, canonical, encoding, groups, leaks, main_body, mixing, name_variants, residue, strings, survivors

LONG = "lorem word " * 20_000


def rows(df):
    return sorted(map(tuple, df.collect()))


# groups ---------------------------------------------------------------------


def union_find(pairs):
    top = {}

    def find(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        top[b] = a
    return {x: find(x) for x in top}


@pytest.mark.parametrize("seed", range(3))
def test_hash_to_min_equals_union_find(spark, seed):
    rng = random.Random(seed)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(150)]
    got = groups.hash_to_min(spark.createDataFrame(pairs, "v long, u long"))
    assert dict(got.collect()) == union_find(pairs)


def test_linked_groups_odd_cases(spark):
    schema = "company_id long, startup_india_id string, v string, u int, n_rows int"
    data = [(5, " SI1", None, 1, 1), (3, "si1 ", "x", None, 1), (3, "si1 ", "x", None, 1), (9, "NA", None, None, None), (8, "na", None, None, None), (7, None, None, None, None), (None, "SI1", None, None, None), (6, "", None, None, None), (4, "SI2", None, None, None)]
    assert rows(groups.linked_groups(spark.createDataFrame(data, schema))) == [(3, 3), (5, 3)]
    assert rows(groups.linked_groups(spark.createDataFrame([], schema))) == []


def test_hot_key_makes_stars_not_pairs(spark):
    data = spark.range(3000).select(F.col("id").alias("company_id"), F.lit("hot").alias("startup_india_id"))
    assert groups.star_edges(data, "company_id", "startup_india_id").count() == 2999


# residue --------------------------------------------------------------------


RESIDUE = [
    ("Welcome to {{company.name}}", "slot"), ("Acme Foods | [Add Tagline]", "slot"), ("&lt;your business name&gt; – Acme", "slot"), ("Warning: undefined variable $title", "error"), ("404 Not Found | Acme", "error"), ("HTTP status 504 (gateway time-out)", "error"),
    ("Please enable JavaScript to continue", "script"), ("Just a second... verifying you are human", "script"), ("Dolor sit amet consectetur.", "filler"), ("Sample headline… as you like", "filler"), ("asdf asdf test", "filler"),
    ("Room 404 - Acme Cafe", None), ("Batch [A-89] left; Anna keeps {name, date, weight} for each crate.", None), ("We train JavaScript developers.", None), ("Acme helps web teams fix server errors.", None), ("Acme Ltd [Since 1997]", None), ("50% of A and 30% of B", None),
]


def test_residue_kinds(spark):
    got: dict[int, set] = {}
    for k, kind in residue.find_residue(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(RESIDUE)], "k long, t string"), ["k"], "t").collect():
        got.setdefault(k, set()).add(kind)
    for i, (text, kind) in enumerate(RESIDUE):
        assert kind in got[i] if kind else i not in got, text


def test_residue_odd_cases(spark):
    schema = "k long, t string, kind string, line long, leaf string, site string, first boolean"
    data = [(1, None, "a", 1, "x"), (2, "", None, None, None), (3, LONG, None, None, None), (4, "403 Forbidden", None, None, None), (4, "403 Forbidden", None, None, None), (None, "403 Forbidden", None, None, None), (5, "n/a", None, None, None)]
    df = spark.createDataFrame([(*d, None, None) for d in data], schema)
    for more in ((), ("site", "first")):
        got = residue.find_residue(df, ["k"], "t", *more)
        assert {r for r in map(tuple, got.collect()) if r[0] != 3} == {(4, "error"), (None, "error")}
        assert residue.find_residue(df.limit(0), ["k"], "t", *more).count() == 0


def test_residue_does_not_depend_on_the_other_lines(spark):
    messages = ["404 Not Found", "503 Service Unavailable", "502 Bad Gateway", "401 Authorization Required", "520 Unknown Error", "403 Forbidden nginx"]
    plain = ["dashboards", "monitors", "pages", "checks", "boards", "alerts", "feeds"]
    data = [(i, f"HTTP Status {m}") for i, m in enumerate(messages)] + [(100 + i, f"HTTP status {w}") for i, w in enumerate(plain)]
    got = residue.find_residue(spark.createDataFrame(data, "k long, t string"), ["k"], "t")
    assert rows(got) == [(i, "error") for i in range(len(messages))]


def test_messages_are_mined_from_titles_and_propagated(spark):
    """What stands alone as the title of many hosts is a message, in any language; own names and what repeats beside them are none."""
    data = [(i, "Ziel nicht erreichbar!", f"host{i}.example", True) for i in range(residue.SUPPORT)]
    data += [(50, "Ziel nicht erreichbar | Acme", "acme.example", True), (51, "Ziel nicht erreichbar. Versuchen Sie es später.", None, False), (52, "Das Ziel ist nicht immer erreichbar.", None, False)]
    data += [(60 + i, f"Acme{'xyzuvw'[i]} tool for cooperatives", f"h{i}.example", True) for i in range(6)] + [(70 + i, f"Solar planner | Firm{'abcdef'[i]}co", f"firm{'abcdef'[i]}co.test", True) for i in range(6)]
    data += [(80 + i, "Kalonim Foods", f"kalonim-{i}.example", True) for i in range(6)] + [(90 + i, "Seldom seen", f"s{i}.example", True) for i in range(residue.SUPPORT - 1)]
    data += [(100 + i, f"New page {i}", f"n{i}.example", True) for i in range(residue.SUPPORT)]
    got = rows(residue.find_residue(spark.createDataFrame(data, "k long, t string, site string, first boolean"), ["k"], "t", "site", "first"))
    assert {k for k, _ in got} == {*range(residue.SUPPORT), 50, 51, *range(100, 100 + residue.SUPPORT)}


def test_templates_mask_what_few_hosts_have(spark):
    from ledgerloom.session import Kept

    lines = [f"order for {x} is late".split() for x in ("anna", "bob", "cora", "dan", "eve", "fay", "gus")]
    for n in (3, 7):  # the same whatever the leaf's size
        df = spark.createDataFrame([(i, t, 1, 1, 0) for i, t in enumerate(lines[:n])] + [(50, "order for zoe is late".split(), 3, 3, 0)], "line long, tokens array<string>, hosts long, alone long, own long")
        got = residue.mine_templates(df, Kept(spark)).collect()
        assert {r.template for r in got if r.line < 50} == {"order for <*> is late"} and {r.template for r in got if r.line == 50} == {"order for zoe is late"}
        assert {r.alone for r in got if r.line < 50} == {n}


# canonical ------------------------------------------------------------------

CITIES = [(1, "Pune", 1, ["Poona"]), (2, "Aurangabad", 1, []), (3, "Aurangabad", 2, []), (4, "New Delhi", 3, None)]
STATES = [(1, "Maharashtra", "MH", []), (2, "Bihar", "BR", []), (3, "Delhi", "DL", ["National Capital Territory"])]


def brute(words, pattern, k):
    return {e: d for w, e in words if (d := strings.osa(pattern, w)) <= k}


def test_trie_search_equals_brute_force():
    rng = random.Random(1)
    words = [("".join(rng.choice("abcd") for _ in range(rng.randint(3, 8))), i) for i in range(200)]
    trie = canonical.Trie(words)
    for _ in range(60):
        pattern = "".join(rng.choice("abcd") for _ in range(rng.randint(2, 9)))
        for k in (0, 1, 2):
            assert trie.search(pattern, k) == brute(words, pattern, k)


def test_map_places(spark):
    data = [
        (1, "poona", "MH", None), (2, "AURANGABAD", "bihr", None), (3, "AURANGABAD", None, None), (4, "Aurangabad, Bihar", "na", None), (5, "Pune", "Maharashtra", None), (6, "Puen 411001", None, None), (7, "Delhi", "Bihar, India", None),
        (8, "Dorborgaon", "abroad", None), (9, "N e w  D e l h i", "D.L.", None), (10, None, "", None), (11, "x" * 300_000, "y " * 100_000, None), (None, "pune", "mh", None), (12, "AURANGABAD", None, "U12345BR2020PTC123456"),
    ]
    df = spark.createDataFrame([(*r, "clash") for r in data], "id long, city string, state string, cin string, value string")
    args = (spark.createDataFrame(CITIES, "city_id long, city string, state_id long, alt_names array<string>"), spark.createDataFrame(STATES, "state_id long, state string, short_code string, alt_names array<string>"))
    got = {(r.id, r.field): r.ref_id for r in canonical.map_places(df, *args).collect()}
    assert got == {
        (1, "city"): 1, (1, "state"): 1, (2, "city"): 3, (2, "state"): 2, (3, "city"): 0, (4, "city"): 3, (6, "city"): 1, (7, "city"): 0, (7, "state"): 2,
        (8, "city"): 0, (8, "state"): 0, (9, "city"): 4, (9, "state"): 3, (11, "city"): 0, (11, "state"): 0, (12, "city"): 3,
    }
    assert canonical.map_places(df.limit(0), *args).count() == 0


# names ----------------------------------------------------------------------


def test_bands_follow_the_collision_curve():
    meets = lambda n: 1 - (1 - 0.5**4) ** n - n * 0.5**4 * (1 - 0.5**4) ** (n - 1)
    n = name_variants.bands(4, 0.5, 0.985, 2)
    assert meets(n) >= 0.985 > meets(n - 1)
    assert name_variants.bands(4, 0.5, 0.985, 1) == math.ceil(math.log(0.015) / math.log(1 - 0.5**4))


def test_letters_bound_the_measure():
    """The bound before the measure loses no pair: similar brands share the letters it asks for."""
    rng = random.Random(6)
    for _ in range(3000):
        a, b = (["".join(rng.choice("abcdef") for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(1, 3))] for _ in range(2))
        if rng.random() < 0.5:
            b = ["".join(rng.sample(w, len(w))) for w in a]
        if name_variants.brands_agree(a, b) >= name_variants.SIMILAR:
            x, y = "".join(a), "".join(b)
            room = (1 - name_variants.SIMILAR) * max(len(x), len(y)) + 1e-9
            assert sum(c not in y for c in x) <= room and sum(c not in x for c in y) <= room


def test_osa_equals_the_table():
    rng = random.Random(9)
    for _ in range(500):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randint(0, 9))) for _ in range(2))
        t = {(i, j): max(i, j) for i in range(len(a) + 1) for j in range(len(b) + 1) if not i * j}
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                t[i, j] = min(t[i - 1, j] + 1, t[i, j - 1] + 1, t[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    t[i, j] = min(t[i, j], t[i - 2, j - 2] + 1)
        d = t[len(a), len(b)]
        assert strings.osa(a, b) == d and all((strings.osa(a, b, k) <= k) == (d <= k) for k in range(5))


def test_name_variants(spark):
    names = [
        "Vornazo Kosniddel Foods Private Limited", "KOSNIDDEL VORNAZO FOODS PVT LTD", "Vornszo Kosniddel Fds (P) Ltd", "Vornazo Kosniddel Textiles Limited", "M/s. Melvelhal Hallannel Indus. L.L.P.", "Melv Elhal Hallannel Industries LLP",
        "Robert Turnakerpilbahal", "Bob Turnakerpilbahal", "William Turnakerpilbahal", None, "", "n/a", "Robert Turnakerpilbahal", "x" * 50_000 + " Ltd",
    ]
    df = spark.createDataFrame([(i, n, "clash") for i, n in enumerate(names)], "id long, name string, brand string")
    got = rows(name_variants.find_variants(df, "id", "name"))
    assert {(0, 1), (0, 2), (1, 2), (4, 5), (6, 7), (7, 12)} == set(got)
    assert name_variants.find_variants(df.limit(0), "id", "name").count() == 0


def test_meetings_are_the_same_in_many_passes(spark, monkeypatch):
    from itertools import combinations

    from ledgerloom.session import Kept

    rng = random.Random(7)
    stems = ["".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(6)) for _ in range(30)]
    texts = sorted({s[:k] + rng.choice("aeioukmn") + s[k + 1 :] for s in stems for k in range(0, 12, 3)})
    df = spark.createDataFrame(list(enumerate(texts)), "n long, whole string")
    keys = name_variants._signatures(texts, name_variants.bands())
    alike = lambda a, b: all(sum(c not in y for c in x) <= 0.22 * max(len(a), len(b)) + 1e-9 for x, y in ((a, b), (b, a)))
    want = {(i, j) for i, j in combinations(range(len(texts)), 2) if (keys[i] == keys[j]).sum() >= name_variants.MEETINGS and alike(texts[i], texts[j])}
    assert len(want) > 30
    for pass_rows in (name_variants.PASS_ROWS, 10 * len(texts)):
        monkeypatch.setattr(name_variants, "PASS_ROWS", pass_rows)
        found = rows(name_variants.meetings(df, Kept(spark, tidy=True)))
        assert len(found) == len(set(found)) and set(found) == want


def test_a_tidy_stage_leaves_no_shuffle_files(spark):
    from pathlib import Path

    from ledgerloom.session import CLEANUP, Kept

    folders = [Path(x) for x in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()]
    files = lambda: {p for d in folders for p in d.rglob("shuffle_*")}
    before = files()
    made = Kept(spark, tidy=True).keep(spark.range(1000).repartition(3), "made")
    assert made.count() == 1000 and not {p for p in files() - before if p.stat().st_size > 1000}
    assert spark.conf.get(CLEANUP, None) is None


def test_star_clusters_members_touch_their_centre(spark):
    from ledgerloom.session import Kept

    rng = random.Random(5)
    edges = {(a, b) for _ in range(80) if (a := rng.randrange(40)) != (b := rng.randrange(40))}
    both = sorted(edges | {(b, a) for a, b in edges})
    got = dict(name_variants.star_clusters(spark.createDataFrame(both, "v long, u long"), Kept(spark)).collect())
    assert set(got) == {a for a, _ in both}
    assert all(v == c or (v, c) in both for v, c in got.items())


# addresses ------------------------------------------------------------------


def test_same_place(spark):
    data = [
        (1, "Shop No. 170, Ground Floor, Vinbortur Jojonel Road, Sufenhin Enclave, Pune, 410082"), (2, "SHOP # 170 - VINBORTUR JOJONEL RD - POONA"), (3, "Shop No. 170, Vinbortur Jojonel Road, Nagpur"), (4, "Shop No. 171, Vinbortur Jojonel Road, Pune"),
        (5, "Address on request"), (6, None), (1, "Shop No. 170, Ground Floor, Vinbortur Jojonel Road, Sufenhin Enclave, Pune, 410082"), (None, "Shop No. 170, Vinbortur Jojonel Road, Pune"), (7, "word " * 50_000), (8, ""),
    ]
    df = spark.createDataFrame([(*r, 1) for r in data], "company_id long, address string, a int")
    assert rows(addresses.find_same_place(df, "company_id", "address", [("Pune", ["Poona"]), ("Nagpur", [])])) == [(1, 2)]
    assert addresses.find_same_place(df.limit(0), "company_id", "address").count() == 0


def test_same_place_reads_doors_that_nothing_marks(spark):
    data = [
        (1, "Tisgolan Mudasen Street 804 Second Floor Sector 7 Pune"), (2, "Shop No. 804, Tisgolan Mudasen Street, Pune"), (3, "Pune 411082 K-12 Vinbortur Jojonel Road"), (4, "Office K-12 Vinbortur Jojonel Road"),
        (5, "Tisgolan Mudasen Street Sector 7 Pune"), (6, "Tisgolan Mudasen Street Sector 7 Pune"), (7, "Plot No. 10234, Vinbortur Jojonel Road"), (8, "vinbortur jojonel road 10234 2nd floor pune"),
        (9, "12, Kosniddelhaltowers"), (10, "12, Kosniddelhaltowers"), (11, "12, Pune"), (12, "12, Pune"), (13, "Pincode 411082"), (14, "Pincode 411082"),
    ]
    df = spark.createDataFrame(data, "company_id long, address string")
    assert rows(addresses.find_same_place(df, "company_id", "address", [("Pune", [])])) == [(1, 2), (3, 4), (7, 8), (9, 10)]


def test_rewrites_are_mined(spark):
    from ledgerloom.session import Kept

    rng = random.Random(2)
    data = []
    for i in range(60):
        own = " ".join("".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(4)) for _ in range(2))
        data += [(2 * i, f"{i + 10}", [*own.split(), "boulevard", "pune"]), (2 * i + 1, f"{i + 10}", [*own.split(), "blvd", "pune"])]
    df = spark.createDataFrame(data, "a long, door string, words array<string>")
    found, _ = addresses.mine_rewrites(df, {"pune": "pune"}, Kept(spark))
    assert found.get("blvd") == "boulevard"


def test_rewrites_are_never_cut(spark, monkeypatch):
    from ledgerloom.session import Kept

    chain = {f"w{i}": f"w{i + 1}" for i in range(12)}
    assert addresses.Reader(chain, {}, set()).words(["w0"]) == ["w12"]
    monkeypatch.setattr(addresses, "MAX_ROUNDS", 1)
    data = [(j * 60 + i, f"{i + 10}", [f"kalino{i}x", f"{i}borumes", w, "pune"]) for i in range(60) for j, w in enumerate(("boulevard", "blvd"))]
    with pytest.raises(RuntimeError):
        addresses.mine_rewrites(spark.createDataFrame(data, "a long, door string, words array<string>"), {"pune": "pune"}, Kept(spark))


def test_names_stay_names_in_large_tables(spark):
    words = F.array(F.when(F.col("id") % 300 == 0, "pilvinya").otherwise(F.concat(F.lit("w"), "id")), F.when(F.col("id") % 2 == 0, "floor").otherwise(F.concat(F.lit("x"), "id")))
    df = spark.range(20_000).select(F.col("id").alias("a"), (F.col("id") % 97).cast("string").alias("door"), words.alias("words"))
    assert addresses._common(df) == {"floor"}


# pages ----------------------------------------------------------------------


def page(i, kind="nav main footer", extra=""):
    head, middle, foot = kind.split()
    tag = lambda x: (x, x) if x in ("nav", "main", "footer") else (f'div class="{x}"', "div")
    (h, h_), (m, m_), (f, f_) = tag(head), tag(middle), tag(foot)
    body = "".join(f"<p>The team {w} in {i} built a machine for farmers, and it still works every day.</p>\n" for w in ("here", "there", "nearby", "again"))
    return f"<html><head>\n<title>t</title></head><body>\n<{h}>\n<li>Zuhause</li>\n<li>Wir</li>\n<li>Kontakt</li>\n</{h_}>\n<{m}>\n<h1>Welcome at X {i}</h1>\n{body}<p>Seite drucken</p>\n{extra}</{m_}>\n<{f}>\n<p>Besucher bisher: {i}</p>\n<p>Ganz nach oben</p>\n</{f_}>\n</body></html>"


MARKED = ["<li>Zuhause</li>", "<li>Wir</li>", "<li>Kontakt</li>", "<p>Seite drucken</p>", "<p>Besucher bisher: 3</p>", "<p>Ganz nach oben</p>"]


def test_main_body(spark):
    pages = [(f"p{i}", page(i), 1) for i in range(60)]
    df = spark.createDataFrame(pages + [("null", None, 1), ("empty", "", 1), (None, page(1), 1), ("long", LONG, 1)], "stored_path string, html string, line_no int")
    model = main_body.train(df, "stored_path", "html")
    got = main_body.mark_lines(df, "stored_path", "html", model)
    lines = page(3).split("\n")
    assert [lines[r.line_no - 1] for r in got.where("record_key = 'p3'").orderBy("line_no").collect()] == MARKED
    assert got.where("record_key in ('null', 'empty') or record_key is null").count() == 0
    texts = [(1, "Zuhause Wir Kontakt The machine still works every day in Pune."), (2, "We built a machine for farmers in Pune."), (3, "Ganz nach oben"), (4, None), (5, "  "), (6, LONG)]
    assert rows(main_body.mixed_texts(spark.createDataFrame([(*t, "x") for t in texts], "k long, t string, key string"), "k", "t", model)) == [(1,)]
    assert main_body.mark_lines(df.limit(0), "stored_path", "html", main_body.train(df.limit(0), "stored_path", "html")).count() == 0


def test_main_body_of_hosts_and_names_never_seen():
    """Wording that no list knows is learned, and holds on hosts whose elements have no telling names, or none."""
    model = main_body.fit([page(i) for i in range(60)], [f"h{i}" for i in range(60)])
    strange = page(3, "c7a c7b c7a")
    bare = "\n".join(main_body.TAG.sub("", x) for x in page(3).split("<body>")[1].split("\n"))
    for html in (strange, bare):
        own = main_body.Batch([main_body.Page(html)], model.weights, {})
        away = main_body.decode(model.in_page.log_odds(own.features()), own.inside, own.parent, own.depth)
        assert [own.texts[i][0] for i in range(len(away)) if away[i]] == [main_body.TAG.sub("", x) for x in MARKED]


def test_the_trees_decide():
    """Without trees nothing is marked, whatever the weights are."""
    model = main_body.fit([page(i) for i in range(60)], [f"h{i}" for i in range(60)])
    own = main_body.Batch([main_body.Page(page(3))], model.weights, {})
    model.in_page.trees, model.in_page.base = [], -1.0
    assert not main_body.decode(model.in_page.log_odds(own.features()), own.inside, own.parent, own.depth).any()


def test_decoding_has_no_main_line_below_boilerplate():
    import numpy as np

    rng = np.random.default_rng(3)
    parent, depth = np.array([-1, 0, 1, 0, 3]), np.array([0, 1, 2, 1, 2])
    for _ in range(50):
        inside, score = rng.integers(0, 5, 12), rng.normal(0, 2, 12)
        away = main_body.decode(score, inside, parent, depth, 0.7)
        best = -1e9
        for states in range(32):
            s = [bool(states >> c & 1) for c in range(5)]
            if s[0] or any(s[parent[c]] and not s[c] for c in range(1, 5)):
                continue
            total = -0.7 * sum(s[c] and not s[parent[c]] for c in range(1, 5)) + sum(v if s[c] else max(0, v - 0.7) for c, v in zip(inside, score))
            best = max(best, total)
        # the decoder's labelling reaches the best total of all labellings of the tree
        got = max(
            -0.7 * sum(s[c] and not s[parent[c]] for c in range(1, 5)) + sum((v if s[c] else v - 0.7) if a else (-1e9 if s[c] else 0) for c, v, a in zip(inside, score, away))
            for s in ([bool(k >> c & 1) for c in range(5)] for k in range(32)) if not s[0] and not any(s[parent[c]] and not s[c] for c in range(1, 5))
        )
        assert math.isclose(got, best, abs_tol=1e-9)


def test_boosting_learns_on_held_out_rows():
    import numpy as np

    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 5)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(int)
    model = boosting.Boosted().fit(x[:2000], y[:2000])
    assert ((boosting.Boosted.of(model.state()).log_odds(x[2000:]) > 0) == y[2000:]).mean() > 0.95


# survivors ------------------------------------------------------------------

COMPANY = "id long, startup_india_id string, name string, website string, domain string, industry string, sector string, stage string, city string, state string, registration_date string, cin string, dpiit_certified boolean, status string, phone string, role string, duplicate_count int, updated_at timestamp, value string"


def company(spark, *data):
    base = dict.fromkeys(x.split()[0] for x in COMPANY.split(", "))
    return spark.createDataFrame([tuple((base | d).values()) for d in data], COMPANY)


def test_survivors(spark):
    from datetime import datetime

    c, day = "U12345MH2020PTC123456", [datetime(2024, 1, d) for d in range(1, 9)]
    df = company(
        spark, dict(id=1, cin=c, website="www.a.example", phone="9999999999", duplicate_count=1, updated_at=day[0]), dict(id=2, cin=c.lower(), website="http://b.example/x", phone="Ph: 8000012345", duplicate_count=3, updated_at=day[2], city="Pune"),
        dict(id=3, cin=c, website="a.example", duplicate_count=2, updated_at=day[1]), dict(id=4, cin="bad", website="c.example"), dict(id=5, cin="U12345MH2020PTC000001", website="d.example"), dict(id=None, cin=c, website="z.example"),
        dict(id=6, cin="U12345MH2020PTC000002", website="e.in"), dict(id=7, cin="U12345MH2020PTC000002", website="e.in"), dict(id=8, cin="U12345MH2020PTC000002", website="f.in"), dict(id=9, cin="U12345MH2020PTC000003", phone="1"), dict(id=10, cin="U12345MH2020PTC000003"),
    )
    got = {(r.cin, r.field): r.id for r in survivors.choose_survivors(df).collect()}
    assert got == {(c, "website"): 2, (c, "phone"): 2, ("U12345MH2020PTC000002", "website"): 6}
    assert survivors.choose_survivors(df.limit(0)).count() == 0


def test_consensus_is_the_voted_value():
    profile = survivors.merge([[{t: w} for t in survivors.tokens(v, "website")] for v, w in (("https://acme.in", 2.0), ("https://acme.in/home", 1.0), ("https://acmee.in", 1.0))])
    assert survivors.consensus(profile) == ["in", "acme"]


def test_consensus_decides_where_no_row_leads(spark):
    """No row is ahead in all three; the numbers of most rows make the consensus, whoever is more complete, and the existing number nearest to it survives."""
    c = "U12345MH2020PTC123456"
    phones = ["9812345670", "9812345671", "9812345679", "9999012345"]
    df = company(spark, *(dict(id=i + 1, cin=c, phone=p, duplicate_count=i, city="Pune" if i == 3 else None) for i, p in enumerate(phones)), dict(id=9, cin=c, phone=phones[1], name="a", state="b", stage="c", sector="d"))
    assert [(r.id, r.value) for r in survivors.choose_survivors(df).collect()] == [(9, "+919812345671")]


def test_large_groups_are_aligned_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(survivors, "CHUNK", 4)
    c = "U12345MH2020PTC123456"
    df = company(spark, *(dict(id=i, cin=c, website=f"site{i % 9}.in" if i % 2 else "acme.in") for i in range(60)))
    assert [r.value for r in survivors.choose_survivors(df).collect()] == ["https://acme.in"]


# leaks ----------------------------------------------------------------------


def test_winnowing_keeps_a_print_of_every_long_shared_run():
    rng = random.Random(4)
    for _ in range(50):
        run = [f"w{rng.randrange(50)}" for _ in range(leaks.K + leaks.W - 1)]
        a, b = ([f"x{rng.randrange(99)}" for _ in range(9)] + run + [f"y{rng.randrange(99)}" for _ in range(7)] for _ in range(2))
        assert {h for h, _ in leaks.fingerprints(a)} & {h for h, _ in leaks.fingerprints(b)}


def test_leaks(spark):
    rng = random.Random(8)
    item = " ".join(f"word{rng.randrange(10_000)}" for _ in range(60))
    w = item.split()
    changed = [x if i % 9 else "other" for i, x in enumerate(w)]
    docs = {1: f"Intro. {item.upper()} End", 2: "<p>a " + "</p> <b>".join(w[10:40]) + "</b>", 3: " ".join(w[:6]) + " and so on", 4: " ".join(changed), 5: "", 6: None, 7: LONG, 8: "​".join(item), 1000: "nothing"}
    df = spark.createDataFrame([(k, v, "s") for k, v in docs.items()] + [(1, docs[1], "s"), (None, item, "s")], "doc_id long, text string, item string")
    items = spark.createDataFrame([(1, item, 1), (2, "short one", 1), (3, None, 1), (None, item, 1)], "item_id long, text string, doc int")
    assert {(r.doc_id, r.item_id) for r in leaks.find_leaks(df, items).collect()} == {(1, 1), (2, 1), (4, 1), (8, 1)}
    assert leaks.find_leaks(df.limit(0), items).count() == 0 and leaks.find_leaks(df, items.limit(0)).count() == 0


def test_many_runs_in_between_close_no_piece():
    """A document that repeats a phrase of the item again and again inside a leaked passage leaks all the same."""
    item = [f"a{i}" for i in range(12)] + [x for k in range(15) for x in ("t", "u", "v", f"q{k}")] + [f"b{i}" for i in range(12)]
    doc = item[:12] + ["t", "u", "v"] + item[12:]
    assert leaks.leaked_share(doc, item) > 0.9


# mixing ---------------------------------------------------------------------


def test_apportion_equals_the_quotient_rule():
    votes, caps = [5.0, 3.0, 1.0], [100, 4, 100]
    got, want = mixing.apportion(votes, 20, caps), [0, 0, 0]
    for _ in range(20):
        want[max((v / (2 * n + 1), -i) for i, (v, n) in enumerate(zip(votes, want)) if n < caps[i])[1] * -1] += 1
    assert got == want and mixing.apportion([1.0], 5, [2]) == [2]
    assert mixing.apportion([0.5, 0.3, 0.2], 10**12, [10**12, 10**10, 10**12])[1] == 10**10


def test_mix(spark):
    docs = [(i, "a" if i % 4 else "b", "some words of text " * (1 + i % 5)) for i in range(400)] + [(900, None, "x"), (901, "c", None), (902, "a", "")]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, source string, text string, n_tokens int")
    targets = spark.createDataFrame([(1, "a", 0.5, 1), (1, "b", 0.5, 1), (2, "b", 0.5, 3), (2, "missing", 0.5, 9), (None, "a", 1.0, 1)], "plan_id long, source string, target_weight double, max_repeats int")
    plan, draw = mixing.mix_sources(df, targets, blocks=100)
    short = {(r.plan_id, r.source) for r in plan.where("short").collect()}
    assert short == {(1, "b"), (2, "missing")}
    repeats = {(r.plan_id, r.source): r.most for r in draw.groupBy("plan_id", "source").agg(F.max("times").alias("most")).collect()}
    quotas = {(r.plan_id, r.source): r.blocks for r in plan.collect()}
    assert quotas[1, "b"] < 50 < quotas[1, "a"]  # what a cap keeps from a source goes to others
    assert repeats[1, "a"] == 1 and repeats[1, "b"] == 1 and repeats[2, "b"] <= 3
    assert rows(draw) == rows(mixing.mix_sources(df, targets, blocks=100)[1])
    assert mixing.mix_sources(df.limit(0), targets)[0].count() == 4


# encoding -------------------------------------------------------------------

CLEAN = ["La señal llegó tarde, pero el envío salió a tiempo.", "L’équipe répare les pièces abîmées – près de la forêt.", "Für Händler übernimmt das Büro die Zölle.", "“Don’t stop,” she said — twice.", "CAFÉ— closed. “ÂME ÉTÉ” in gold, Maß „groß“ here", "会社の窓口は二階です。", "Площадка открыта по средам."]
SWAPS = [("utf-8", "cp1252"), ("utf-8", "latin-1"), ("utf-8", "cp1251"), ("utf-8", "mac_roman"), ("utf-8", "cp437")]


def test_repair_round_trip(spark):
    data, want = [], {}
    n = 0
    for _ in range(12):
        for text in CLEAN:
            data.append((n, text, "s"))
            n += 1
    for a, b in SWAPS:
        for text in CLEAN[:4]:
            try:
                bad = text.encode(a).decode(b)
            except UnicodeError:
                continue
            for _ in range(3):
                data.append((n, bad, "s"))
                want[n] = text
                n += 1
    data += [(n, "lost � here", None), (n + 1, None, "s"), (n + 2, "", "s"), (n + 3, LONG + "é", "s"), (None, "Ã©", "s")]
    df = spark.createDataFrame([(*d, 1) for d in data], "doc_id long, text string, source string, n int")
    got = {r.doc_id: r for r in encoding.repair(df).collect()}
    assert set(got) == set(want) | {n}
    assert got[n].restored is None and got[n].n_lost == 1
    right = sum(got[k].restored == t for k, t in want.items())
    assert right >= 0.95 * len(want)
    assert encoding.repair(df.limit(0)).count() == 0


def test_readings_undo_swaps_exactly():
    assert ("cp1252*1", "é") in encoding.readings("Ã©")
    assert ("cp1252*2", "–") in encoding.readings("–".encode().decode("cp1252").encode().decode("cp1252"))
    assert ("utf-16-le", "Hi there") in encoding.readings("Hi there".encode().decode("utf-16-le"))
    assert not encoding.readings("ã") and not re.search("x", "".join(t for _, t in encoding.readings("Ω")))


def test_symbols_are_the_shortest_strings_that_stand_for_letters():
    cut = {swap: symbols for swap, _, symbols in encoding.spelled("áñ–".encode().decode("cp1252").encode().decode("cp1252"))}
    assert [x for _, x in cut["cp1252*2"]] == ["á", "ñ", "–"]
    assert [(s, x) for swap, _, symbols in encoding.spelled("鈥檚") if swap == "gb18030*1" for s, x in symbols] == [("鈥檚", "’s")]


def test_substitute_goes_through_the_table():
    symbols = [("Ã©", "é"), ("Ã", "Ã")]
    assert encoding.substitute(symbols[:1], "xÃ©Ã©y", {"Ã©": "é"}) == "xééy"
    assert encoding.substitute(symbols, "Ã©Ã", {"Ã©": "é", "Ã": "A"}) == "éA"


def test_the_table_decides_between_letters(spark):
    """A source's table is learned: with the counts of one source a symbol is read as that source's letters."""
    language = encoding.Language({}, {}, {("a", "X", "é"): 5.0, ("b", "X", "è"): 5.0, ("c", "X", "X"): 9.0}, {"é": 9.0, "è": 9.0})
    assert language.letters_of("a", [("X", "è")]) == {"X": "é"} and language.letters_of("b", [("X", "è")]) == {"X": "è"}
    assert language.odds("a", "X", "é") > 0 > language.odds("c", "X", "é")


def test_too_many_counts_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(encoding, "MOST_ENTRIES", 2)
    with pytest.raises(ValueError):
        encoding.repair(spark.createDataFrame([(i, t, "s") for i, t in enumerate(CLEAN)], "doc_id long, text string, source string"))


def test_long_values_have_the_same_measure(spark):
    """No length at which another measure, or a part of the value, takes over."""
    a = "kalonim" * 200
    assert strings.osa(a, a[:700] + "x" + a[701:]) == 1 and strings.closeness(a, a[1:]) == 1 - 1 / len(a)
    assert survivors.tokens("https://a.b.in/" + "p/" * 100 + "q", "website") == ["in", "b", "a", "/" + "p/" * 100 + "q"]
    df = spark.createDataFrame([(1, "Kalonim" * 80 + " Foods Ltd"), (2, "Kalonim" * 79 + "Kalonin Foods Limited"), (3, "Borgobu" * 80 + " Foods Ltd")], "id long, name string")
    assert rows(name_variants.find_variants(df, "id", "name")) == [(1, 2)]
