"""Passages of held-out test items in a corpus, by winnowing.

Texts are words without case, markup and punctuation. Of the hashes of all K-grams in each
window of W neighbours the smallest is kept, so any shared run of K + W - 1 words shares a
fingerprint. Corpus and test fingerprints are joined, and each pair they meet in is
extended: words are compared along the diagonals of the hits, over changed, inserted and
left out words, into pieces, and the item's share in large pieces decides.
"""

from __future__ import annotations

import html
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import Kept

K, W = 4, 4
#: A piece counts from so many equal words on; words of the item that may differ in a row inside a piece.
PIECE, GAP = 14, 3
#: The share of the item's words from which a document leaks it.
SHARE = 1 / 3
#: More test fingerprints, or hits (pairs of a document and an item), than this are shuffled instead of broadcast.
BROADCAST_PRINTS, BROADCAST_HITS = 500_000, 1_000_000

HIDDEN = re.compile("[­​-‏ -‮⁠-⁤﻿]")
MARKUP = re.compile(r"<[a-zA-Z/!][^<>]*>")
LOOKALIKES = str.maketrans("аеорсхуіѕјһԁӏΑΒΕΖΗΙΚΜΝΟΡΤΥΧοαν", "aeopcxyisjhdlABEZHIKMNOPTYXoav")


def words_of(text: str) -> list[str]:
    text = HIDDEN.sub("", html.unescape(MARKUP.sub(" ", text)))
    text = re.sub(r"(?<=\w)-\n\s*(?=\w)", "", text)
    text = unicodedata.normalize("NFKD", text).casefold()
    words = re.findall(r"[^\W_]+", "".join(c for c in text if not unicodedata.combining(c)) if not text.isascii() else text)
    return [w if w.isascii() else w.translate(LOOKALIKES) for w in words]


def _kept(words: list[str], k: int, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-grams, and the positions that winnowing keeps."""
    n = len(words) - k + 1
    if n < 1:
        return np.zeros(0, np.uint64), np.zeros(0, int)
    codes = np.fromiter((zlib.crc32(x.encode()) for x in words), np.uint64, len(words))
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h = h * np.uint64(0x100000001B3) ^ codes[j : j + n]
    h ^= h >> np.uint64(29)
    h = h * np.uint64(0x9E3779B97F4A7C15) & np.uint64(0x7FFFFFFFFFFFFFFF)
    w = min(w, n)
    windows = np.lib.stride_tricks.sliding_window_view(h, w)
    return h, np.unique(np.arange(len(windows)) + w - 1 - windows[:, ::-1].argmin(axis=1))


def fingerprints(words: list[str], k: int = K, w: int = W) -> list[tuple[int, int]]:
    """(hash, position) kept by winnowing; of equal smallest hashes the last."""
    h, at = _kept(words, k, w)
    return list(zip(h[at].tolist(), at.tolist()))


def pieces(doc: list[str], item: list[str]) -> list[tuple[int, int, int, int]]:
    """(first, last + 1 in the item, first in the document, equal words) of each maximal piece of the item that reappears in the document."""
    where: dict[tuple[str, ...], list[int]] = {}
    for i in range(len(item) - 2):
        where.setdefault(tuple(item[i : i + 3]), []).append(i)
    runs: dict[int, list[list[int]]] = {}
    for d in range(len(doc) - 2):
        for i in where.get(tuple(doc[d : d + 3]), ()):
            on = runs.setdefault(d - i, [])
            if on and on[-1][1] >= i:
                on[-1][1] = i + 3
            else:
                on.append([i, i + 3])
    flat = sorted((d + i, i, j, d) for d, rs in runs.items() for i, j in rs)
    found: list[list[int]] = []  # first, end, diagonal at the end, equal words, first in the document
    open_: list[list[int]] = []  # pieces that a later run can still join: runs come in the order of the document
    for at, i, j, d in flat:
        open_ = [p for p in open_ if at - p[1] - p[2] <= GAP + 3]
        for p in reversed(open_):
            if 0 <= i - p[1] <= GAP + 1 and abs(d - p[2]) <= 2 or p[0] < i < p[1] < j and 0 < abs(d - p[2]) <= 2:
                p[3] += j - max(i, p[1])
                p[1], p[2] = j, d
                break
        else:
            found.append([i, j, d, j - i, at])
            open_.append(found[-1])
    return [(i, j, at, n) for i, j, _, n, at in found if n >= PIECE and n >= 0.5 * (j - i)]


def leaked_share(doc: list[str], item: list[str]) -> float:
    """The part of the item's words inside large pieces."""
    covered: set[int] = set()
    for i, j, _, _ in pieces(doc, item):
        covered.update(range(i, j))
    return len(covered) / len(item) if item else 0.0


def find_leaks(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id") -> DataFrame:
    """(doc_id, item_id, share) of each document that holds at least SHARE of an item in large pieces.

    Null and empty texts and null ids take no part; an item of fewer than PIECE words can't leak; repeated documents are found under each id,
    repeated rows once. Test fingerprints and hits are broadcast only if they are few.
    """
    kept = Kept(documents.sparkSession)
    docs = documents.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text")).where("doc is not null and text <> ''")
    tests = items.select(F.col(item_id).cast("long").alias("item"), F.col(text).alias("itext")).where("item is not null and itext <> ''").dropDuplicates(["item"])

    def print_of(name: str):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for at in range(0, len(b), 2000):
                    part = b.iloc[at : at + 2000]
                    prints = [np.unique(h[at]) for h, at in (_kept(words_of(t), K, W) for t in part.iloc[:, 1])]
                    yield pd.DataFrame({name: np.repeat(part.iloc[:, 0].to_numpy(), [len(p) for p in prints]), "print": np.concatenate(prints or [np.zeros(0, np.uint64)]).astype(np.int64)})

        return run

    test_prints = kept.keep(tests.mapInPandas(print_of("item"), "item long, print long"), "tests")
    small = test_prints.count() <= BROADCAST_PRINTS
    doc_prints = docs.mapInPandas(print_of("doc"), "doc long, print long")
    met = doc_prints.join(F.broadcast(test_prints) if small else test_prints, "print").select("doc", "item").distinct()
    met = kept.keep(met, "met")
    # few documents hit anything: with their hits sent to where the documents are, no text is shuffled
    few = met.count() <= BROADCAST_HITS
    pairs = docs.join(F.broadcast(met) if few else met, "doc").join(F.broadcast(tests) if small else tests, "item")

    def extend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of_item: dict[int, list[str]] = {}
        for b in batches:
            shares, last, words = [], None, []
            for i, t, it in zip(b.item, b.text, b.itext):
                if i not in of_item:
                    of_item[i] = words_of(it)
                if t is not last:
                    last, words = t, words_of(t)
                shares.append(leaked_share(words, of_item[i]))
            yield pd.DataFrame({"doc": b.doc, "item": b["item"], "share": shares})

    found = pairs.select("doc", "item", "text", "itext").mapInPandas(extend, "doc long, item long, share double").where(F.col("share") >= SHARE)
    return found.groupBy("doc", "item").agg(F.max("share").alias("share")).withColumnsRenamed({"doc": doc_id, "item": item_id})
