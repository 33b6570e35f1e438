"""Variant spellings of one organisation's or person's name.

A name is read as brand words (what is its own), kind words (a line of business or a
given name, both mined as words that very many names share) and initials. MinHash
bands over padded q-grams of the brand words give candidates; their number follows from
the collision curve for the wanted recall. Monge-Elkan similarity verifies them, and
star clustering makes groups in which every member is close to the centre.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.dictionaries import GENERIC_NAME_KEYS, NULL_TOKENS
from ledgerloom.llm.strings import monge_elkan, osa
from ledgerloom.session import Kept

Q = 3
ROWS = 4
#: Wanted recall of candidates whose brand words have this Jaccard similarity, and the bands a candidate must meet in.
AT_JACCARD, RECALL, MEETINGS = 0.5, 0.985, 2
#: Rows of bands, and of meetings, that a pass shuffles at once. A pass takes one band of every brand at least, and meetings are counted in MOST_SLICES passes at most.
PASS_ROWS, MOST_SLICES = 2_000_000, 8
SIMILAR = 0.78
#: A word in so large a part of all names is a kind word.
KIND_SHARE, KIND_LEAST = 0.003, 12
MAX_ROUNDS = 50

LEGAL = {"private", "pvt", "p", "limited", "ltd", "llp", "lp", "opc", "inc", "corp", "corporation", "co", "company", "plc", "liability", "partnership", "pvtltd", "privatelimited", "pltd", "limted", "privte", "lmtd", "prvt"}
TITLES = {"m", "messrs", "the", "shri", "sri", "smt", "mr", "mrs", "ms", "dr", "prof", "ca", "er", "adv", "miss", "kumari", "india", "bharat", "and", "of"}
#: Lines of business that are kind words even in tables too small to mine them.
BUSINESS = (
    "packaging exports biosciences enterprises mobility technologies healthcare foods consultancy international manufacturing motors services engineering "
    "textiles industries software analytics learning energy ceramics robotics ventures logistics pharma agritech solutions trading traders infotech systems "
    "chemicals constructions realty retail media studios labs holdings finance capital education hospitality"
).split()
SHORT = {
    "tech": "technologies", "techs": "technologies", "technology": "technologies", "agri": "agritech", "agro": "agritech", "engg": "engineering", "engrs": "engineering", "engineers": "engineering",
    "consulting": "consultancy", "consultants": "consultancy", "conslt": "consultancy", "pharmaceuticals": "pharma", "pharmaceutical": "pharma", "farma": "pharma", "bio": "biosciences", "tex": "textiles",
    "serv": "services", "intl": "international", "int": "international", "internatl": "international", "ent": "enterprises", "entp": "enterprises", "entpr": "enterprises", "ind": "industries", "inds": "industries",
    "indus": "industries", "industry": "industries", "exp": "exports", "soln": "solutions", "solns": "solutions", "sol": "solutions", "analytix": "analytics", "health": "healthcare", "log": "logistics", "mfg": "manufacturing",
    "soft": "software", "robo": "robotics", "edu": "education", "infra": "infrastructure", "mot": "motors", "pack": "packaging", "learn": "learning",
}
#: Given names that their short forms don't begin like.
NICKNAMES = {
    "bob": "robert", "rob": "robert", "bobby": "robert", "bert": "robert", "bill": "william", "billy": "william", "will": "william", "liz": "elizabeth", "beth": "elizabeth", "betty": "elizabeth", "eliza": "elizabeth",
    "kate": "katherine", "kathy": "katherine", "katie": "katherine", "kat": "katherine", "pinky": "priyanka", "priya": "priyanka", "vicky": "vikram", "subbu": "subramaniam", "subu": "subramaniam", "mohd": "mohammed",
    "md": "mohammed", "mohamed": "mohammed", "muhammad": "mohammed", "sid": "siddharth", "laxmi": "jayalakshmi", "lakshmi": "jayalakshmi", "prakash": "omprakash", "gops": "gopal", "harry": "harpreet", "preeti": "harpreet",
    "dick": "richard", "jim": "james", "mike": "michael", "tony": "anthony", "peggy": "margaret", "meg": "margaret", "ted": "edward", "chandu": "chandrasekhar", "shekhar": "chandrasekhar", "krishna": "balakrishna", "ram": "subramaniam",
}
SOUNDS = (("oo", "u"), ("ee", "i"), ("ou", "u"), ("au", "o"), ("ph", "f"), ("sh", "s"), ("th", "t"), ("dh", "d"), ("bh", "b"), ("kh", "k"), ("gh", "g"), ("ck", "k"), ("ch", "c"), ("w", "v"), ("z", "j"), ("y", "i"), ("q", "k"), ("c", "k"), ("x", "ks"))
DIGITS = str.maketrans("01358", "olesb")


def bands(rows: int = ROWS, jaccard: float = AT_JACCARD, recall: float = RECALL, meetings: int = MEETINGS) -> int:
    """The fewest bands at which the collision curve, the chance of ``meetings`` or more equal bands of which each is equal with jaccard ** rows, reaches the recall.

    Chance pairs meet once in most cases; to ask for two meetings and take more bands keeps the recall and leaves most of them out.
    """
    p, n = jaccard**rows, meetings
    while 1 - sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(meetings)) < recall:
        n += 1
    return n


def sounds(word: str) -> str:
    for a, b in SOUNDS:
        word = word.replace(a, b)
    return re.sub(r"(.)\1+", r"\1", word)


def words_of(name: str) -> tuple[list[str], bool]:
    """Words of a name without titles and legal forms, and whether it has a legal form."""
    text = unicodedata.normalize("NFKD", name).casefold()
    text = "".join(c for c in text if not unicodedata.combining(c))
    text = re.sub(r"\([^)]*\)", lambda m: " opc " if "opc" in m[0] else " p " if m[0] in ("(p)", "(pvt)") else " ", text)
    text = re.sub(r"\b(?:formerly|earlier|previously|erstwhile)\b.*", " ", text)
    text = re.sub(r"\bl\s*\.?\s*l\s*\.?\s*p\b", " llp ", re.sub(r"\bm\s*/\s*s\b", " ", text))
    words = [w.translate(DIGITS) if re.search("[^0-9]", w) else w for w in re.split(r"[\W_]+", text.replace("'", "").replace("’", "")) if w]
    legal = any(w in LEGAL for w in words)
    kept = [w for w in words if w not in LEGAL and w not in TITLES]
    return (kept or [w for w in words if w not in LEGAL] or words), legal


class Reader:
    """Names as brand words, kind words and initials. kinds: mined words, the most frequent first."""

    def __init__(self, kinds: list[str], places: list[str]):
        self.places = {w for p in places for w in ["".join(re.findall(r"\w+", p.casefold()))]}
        self.kinds: list[str] = []
        self.known: dict[str, str] = {w: w for w in [*BUSINESS, *NICKNAMES.values()]}
        for w in kinds:
            if len(w) > 2 and w not in LEGAL and w not in TITLES and w not in self.places and w not in self.known:
                self.known[w] = w
        self.kinds = list(dict.fromkeys(self.known))
        self.letters = [(k, frozenset(k)) for k in self.kinds]
        self.business = set(BUSINESS)
        self.given = [w for w in self.kinds if w not in self.business and w not in SHORT]
        self.by_sound = {w: sounds(w) for w in self.given}
        self.cache: dict[str, str | None] = {}

    def kind(self, word: str) -> str | None:
        """The kind word that a word is, is a typo of, or is short for."""
        if word not in self.cache:
            self.cache[word] = self._kind(word)
        return self.cache[word]

    def _kind(self, word: str) -> str | None:
        if word in SHORT:
            return SHORT[word]
        if word in self.known:
            return word
        if len(word) < 3:
            return None
        if not re.search("[aeiou]", word):
            hits = [k for k in self.business if k[0] == word[0] and re.match(".*".join(word), k)]
            return min(hits, key=lambda k: (len(k), k)) if hits else None
        most = 0 if len(word) < 4 else 1 if len(word) < 7 else 2
        # an edit takes away one letter of the kind word at most
        near = [(d, k) for k, own in self.letters if abs(len(k) - len(word)) <= most and len(own.difference(word)) <= most and (d := osa(word, k, most)) <= most]
        return min(near)[1] if near else None

    def nickname(self, word: str) -> str | None:
        if word in NICKNAMES:
            return NICKNAMES[word]
        s = sounds(word)
        hits = [k for k, t in self.by_sound.items() if len(s) < len(t) and len(s) >= 2 and (t.startswith(s) or len(s) >= 3 and t.startswith(s[:-1]))]
        return hits[0] if len(hits) == 1 else ("~" + s if hits else None)

    def read(self, name: str) -> tuple[list[str], list[str], str] | None:
        """(brand words, kind words, initials); None for a name that names nobody."""
        if name.strip().casefold() in NULL_TOKENS or name.strip().casefold() in GENERIC_NAME_KEYS:
            return None
        words, legal = words_of(name)
        words = [w for w in words if not w.isdigit()] or words
        for i in range(len(words) - 1, 0, -1):
            if words[i - 1] + words[i] in self.places and len(words) > 3:
                del words[i - 1 : i + 1]
                break
        joined: list[str] = []
        for w in words:
            if joined and joined[-1] + w in self.known:
                joined[-1] += w
            else:
                joined.append(w)
        brand, kinds, initials = [], [], []
        for w in joined:
            if len(w) == 1:
                initials.append(w)
            elif (k := self.kind(w)) and len(joined) > 1:
                kinds.append(k)
            else:
                brand.append(w)
        if len(brand) > 1:  # the branch's town
            brand = [w for w in brand if w not in self.places] or brand
        if not legal and not kinds and len(brand) == 2 and max(map(len, brand)) >= 8:
            short = min(brand, key=len)
            if len(short) <= 7 and (k := self.nickname(short)):
                kinds.append(k)
                brand.remove(short)
        if not brand:
            brand, kinds = kinds or joined, []
        return [sounds(w) for w in brand], sorted(set(kinds)), "".join(initials) if not kinds else ""


def kinds_agree(a: tuple[list[str], str], b: tuple[list[str], str]) -> bool:
    """Whether two readings' kind words and initials may belong to one name."""
    (ka, ia), (kb, ib) = a, b
    if ka and kb:
        for x in ka:
            for y in kb:
                if x == y or "~" in x + y and (sounds(y.strip("~")).startswith(x.strip("~")[:-1]) or sounds(x.strip("~")).startswith(y.strip("~")[:-1])):
                    return True
        return False
    if ia and ib:
        return ia[0] == ib[0]
    if ia and kb or ib and ka:
        return any(k.strip("~")[0] == (ia or ib)[0] for k in ka or kb)
    return True


def brands_agree(a: list[str], b: list[str]) -> float:
    """Monge-Elkan similarity of the words, or that of the joined words in one of their turns, for words may be cut differently."""
    whole, other = "".join(a), "".join(b)
    longest = max(len(whole), len(other))
    most = int((1 - SIMILAR) * longest)
    for text in dict.fromkeys((other, "".join(b[1:] + b[:1]), "".join(b[-1:] + b[:-1]))):
        if (d := osa(whole, text, most)) <= most:
            return 1 - d / longest
    return monge_elkan(a, b)


def _signatures(strings: list[str], n_bands: int, turn: range | None = None) -> np.ndarray:
    """Band keys of each string's padded q-grams, of all bands or those of ``turn``."""
    turn = turn or range(n_bands)
    rng = np.random.default_rng(20240)
    n = n_bands * ROWS
    a = rng.integers(1, 2**63 - 1, n, dtype=np.uint64) | np.uint64(1)
    b = rng.integers(0, 2**63 - 1, n, dtype=np.uint64)
    a, b = (x[turn.start * ROWS : turn.stop * ROWS] for x in (a, b))
    powers = np.array([1_000_003**k % 2**61 for k in range(ROWS)], dtype=np.uint64)
    salts = np.arange(turn.start, turn.stop, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    grams, first = [], []
    long = [i for i, s in enumerate(strings) if len(s) > 5_000]
    if long and len(strings) > 1:
        out = np.empty((len(strings), len(turn)), dtype=np.int64)
        short = [i for i in range(len(strings)) if len(strings[i]) <= 5_000]
        if short:
            out[short] = _signatures([strings[i] for i in short], n_bands, turn)
        for i in long:
            out[i] = _signatures([strings[i]], n_bands, turn)[0]
        return out
    if long:  # piece by piece, each gram once
        padded = strings[0] + strings[0][: Q - 1]
        seen = sorted({padded[j : j + Q] for j in range(len(padded) - Q + 1)})
        strings = ["".join(g) for g in seen]
    for s in strings:
        padded = s + s[: Q - 1] if len(s) >= Q else s + "$" * (Q - len(s))  # padded by its own beginning: turned word order keeps the grams
        first.append(len(grams))
        grams += [zlib.crc32(s.encode())] if long else [zlib.crc32(padded[j : j + Q].encode()) for j in range(len(padded) - Q + 1)]
    hashed = (np.array(grams, dtype=np.uint64)[:, None] + b) * a
    hashed ^= hashed >> np.uint64(29)
    hashed *= np.uint64(0xBF58476D1CE4E5B9)
    hashed >>= np.uint64(32)
    least = hashed.min(axis=0)[None] if long else np.minimum.reduceat(hashed, first, axis=0)
    least = least.reshape(-1, len(turn), ROWS)
    return ((least * powers).sum(axis=2) ^ salts).view(np.int64)


def meetings(lettered: DataFrame, kept: Kept) -> DataFrame:
    """(n1, n2), n1 < n2: the brands of ``lettered`` (n, whole) that meet in MEETINGS bands or more and whose letters are alike enough to be one.

    Bands are made, shuffled and joined a few at a time, and meetings are counted a slice of the brands at a time, so that disk
    never holds all of either shuffle. What is kept of a meeting is two numbers, and only where the letters allow a pair.
    """
    n_bands = bands()
    step = max(1, min(n_bands, PASS_ROWS // max(1, lettered.count())))
    # whatever the order and cut of the words, the measure is at most the part of either side's letters that the other side has too, so this loses no pair
    strange = lambda x, y: F.length(F.call_function("translate", F.col(x), F.col(y), F.lit(""))) <= (1 - SIMILAR) * F.greatest(F.length("x.whole"), F.length("y.whole")) + 1e-9
    parts = []
    for first in range(0, n_bands, step):

        def sign(batches: Iterator[pd.DataFrame], turn=range(first, min(first + step, n_bands))) -> Iterator[pd.DataFrame]:  # noqa: B008
            for b in batches:
                for k in range(0, len(b), 500):
                    part = b.iloc[k : k + 500]
                    keys = _signatures(list(part.whole), n_bands, turn)
                    yield pd.DataFrame({"band": keys.ravel(), "n": np.repeat(part.n.to_numpy(), len(turn)), "whole": np.repeat(part.whole.to_numpy(), len(turn))})

        banded = kept.keep(lettered.select("n", "whole").mapInPandas(sign, "band long, n long, whole string"), "banded")
        pairs = banded.alias("x").join(banded.alias("y"), (F.col("x.band") == F.col("y.band")) & (F.col("x.n") < F.col("y.n")))
        pairs = pairs.where(strange("x.whole", "y.whole") & strange("y.whole", "x.whole"))
        met = kept.keep(pairs.select(F.col("x.n").alias("n1"), F.col("y.n").alias("n2")), f"met{first}")
        parts.append(f"met{first}")
    met = kept.spark.read.schema(met.schema).parquet(*(kept.paths[x] for x in parts))
    slices = min(MOST_SLICES, 1 + met.count() // PASS_ROWS)
    found = None
    for s in range(slices):
        often = met.where(F.pmod("n1", F.lit(slices)) == s).groupBy("n1", "n2").agg(F.count("*").alias("n")).where(F.col("n") >= MEETINGS).select("n1", "n2")
        often = kept.keep(often, f"often{s}")
        found = often if found is None else found.unionByName(often)
    kept.drop("banded", *parts)
    return found


def mined_kinds(names: DataFrame) -> list[str]:
    """Words that at least KIND_SHARE of all distinct names share: at most (words a name) / KIND_SHARE words, whatever the data."""
    words = names.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("name"), F.lit(r"(\p{L}{3,})"), 1))).alias("w"))
    n = names.count()
    found = words.groupBy("w").agg(F.count("*").alias("n")).where(F.col("n") >= max(KIND_LEAST, KIND_SHARE * n))
    return [r.w for r in found.orderBy(F.desc("n"), "w").collect()]


def star_clusters(edges: DataFrame, kept: Kept) -> DataFrame:
    """(v, centre) of every vertex of ``edges`` (v, u, both directions): in each round, vertices with the
    highest (degree, -id) among their open neighbours become centres and take those neighbours."""
    edges = kept.keep(edges, "open")
    degree = kept.keep(edges.groupBy("v").agg(F.count("*").alias("d")), "degree")
    edges = kept.keep(edges.join(degree, "v").join(degree.select(F.col("v").alias("u"), F.col("d").alias("du")), "u"), "open")
    done = None
    for _ in range(MAX_ROUNDS):
        rank = edges.groupBy("v", "d").agg(F.max(F.struct("du", (-F.col("u")).alias("u"))).alias("m"))
        centres = rank.where(F.struct("d", (-F.col("v")).alias("u")) > F.col("m")).select(F.col("v").alias("centre"))
        taken = edges.join(centres, edges.u == centres.centre).groupBy("v").agg(F.max(F.struct("du", (-F.col("u")).alias("u"))).alias("c")).select("v", (-F.col("c.u")).alias("centre"))
        new = kept.keep(taken.unionByName(centres.select(F.col("centre").alias("v"), "centre")), f"stars{_}")
        done = new if done is None else done.unionByName(new)
        gone = new.select("v")
        edges = kept.keep(edges.join(gone, "v", "left_anti").join(gone.withColumnRenamed("v", "u"), "u", "left_anti"), "open")
        if edges.isEmpty():  # who is left alone is its own centre
            return degree.select("v").join(done, "v", "left").select("v", F.coalesce("centre", "v").alias("centre"))
    raise RuntimeError("star clustering did not settle")


def find_variants(rows: DataFrame, key: str, name: str, places: list[str] = ()) -> DataFrame:
    """(id_a, id_b), id_a < id_b: rows whose names mean one organisation or person and are written differently.

    Null, blank and placeholder names take no part, nor do null keys. Rows written alike give no pair among
    themselves, but each gives its pairs with other spellings. places: names of towns, which branches add.
    """
    spark = rows.sparkSession
    kept = Kept(spark, tidy=True)
    rows = rows.select(F.col(key).alias("id"), F.col(name).alias("name")).where("id is not null and name is not null").distinct()
    rows = kept.keep(rows, "rows")
    names = rows.select("name").distinct()
    reader = spark.sparkContext.broadcast((mined_kinds(names), list(places)))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Reader(*reader.value)
        for b in batches:
            out = [(n, " ".join(r[0]), " ".join(r[1]), r[2]) for n in b.name if (r := own.read(n))]
            yield pd.DataFrame(out, columns=["name", "brand", "kinds", "initials"])

    profile = F.xxhash64("brand", "kinds", "initials")
    read_names = kept.keep(names.mapInPandas(read, "name string, brand string, kinds string, initials string").withColumn("p", profile).withColumn("b", F.xxhash64("brand")), "read")
    profiles = kept.keep(read_names.groupBy("p").agg(F.first("b").alias("b"), F.first("brand").alias("brand"), F.first("kinds").alias("kinds"), F.first("initials").alias("initials")), "profiles")
    brands = profiles.groupBy("b").agg(F.first("brand").alias("brand"))
    lettered = kept.keep(brands.select("b", "brand", F.replace("brand", F.lit(" "), F.lit("")).alias("whole"), F.monotonically_increasing_id().alias("n")), "lettered")
    text = [lettered.select(F.col("n").alias(f"n{i}"), F.col("b").alias(f"b{i}"), F.col("brand").alias(f"brand{i}")) for i in (1, 2)]
    met = meetings(lettered, kept).join(text[0], "n1").join(text[1], "n2")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            turned = b.b1 > b.b2  # the measure turns the words of one side only
            x, y = b.brand1.where(~turned, b.brand2), b.brand2.where(~turned, b.brand1)
            ok = [brands_agree(x.split(), y.split()) >= SIMILAR for x, y in zip(x, y)]
            yield b.loc[ok, ["b1", "b2"]]

    close = kept.keep(met.mapInPandas(verify, "b1 long, b2 long"), "close")
    same = brands.select(F.col("b").alias("b1"), F.col("b").alias("b2"))
    links = close.unionByName(close.select(F.col("b2").alias("b1"), F.col("b1").alias("b2"))).unionByName(same)
    side = [profiles.select(F.col("p").alias(f"p{i}"), F.col("b").alias(f"b{i}"), F.col("kinds").alias(f"k{i}"), F.col("initials").alias(f"i{i}")) for i in (1, 2)]
    pairs = links.join(side[0], "b1").join(side[1], "b2").where("p1 <> p2")

    def agree(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ok = [kinds_agree((k1.split(), i1), (k2.split(), i2)) for k1, i1, k2, i2 in zip(b.k1, b.i1, b.k2, b.i2)]
            yield b.loc[ok, ["p1", "p2"]]

    edges = pairs.mapInPandas(agree, "p1 long, p2 long").select(F.col("p1").alias("v"), F.col("p2").alias("u"))
    stars = kept.keep(star_clusters(edges, kept), "stars")
    member = profiles.join(stars.withColumnRenamed("v", "p"), "p", "left").withColumn("centre", F.coalesce("centre", "p"))
    member = member.select("p", "centre", "kinds", "initials")
    tight = member.alias("x").join(member.alias("y"), (F.col("x.centre") == F.col("y.centre")) & (F.col("x.p") < F.col("y.p")))
    tight = tight.select(F.col("x.p").alias("p1"), F.col("y.p").alias("p2"), F.col("x.kinds").alias("k1"), F.col("y.kinds").alias("k2"), F.col("x.initials").alias("i1"), F.col("y.initials").alias("i2")).mapInPandas(agree, "p1 long, p2 long")
    tight = tight.unionByName(profiles.select(F.col("p").alias("p1"), F.col("p").alias("p2")))
    ids = kept.keep(rows.join(read_names.select("name", "p"), "name"), "ids")
    a, b = (ids.select(F.col("id").alias(f"id{i}"), F.col("name").alias(f"name{i}"), F.col("p").alias(f"p{i}")) for i in (1, 2))
    found = tight.join(a, "p1").join(b, "p2").where("name1 <> name2 and id1 <> id2")
    return found.select(F.least("id1", "id2").alias("id_a"), F.greatest("id1", "id2").alias("id_b")).distinct()
