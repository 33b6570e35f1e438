"""Text that was decoded with the wrong character encoding.

Runs of characters outside ASCII are taken as cipher text. A cipher symbol is the shortest
string of garbled characters that stands for whole letters, and each source has a substitution
of its own: a table of how likely a symbol is each letter, or is itself. The letters a symbol
can be are those that some code page would make of its bytes. Expectation: each run's possible
readings are weighed by the bigrams of the language around it and by the source's table.
Maximization: the bigrams and the tables are counted anew from the readings, so garbled pairs
lose their weight and letters gain theirs. At the end each source has one letter for each
symbol, and runs that read better so are put through that table with ``translate``; what no
symbol explains stays.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import Kept

ROUNDS = 4
#: The tables of all sources and the bigrams are sent to every worker; more entries than this are an error, never cut.
MOST_ENTRIES = 5_000_000
#: What a symbol's count begins with, and the log-odds a symbol's table gives at most.
PRIOR, MOST_ODDS = 0.5, 4.0
#: Log-odds a reading needs over the run as it stands.
MARGIN = 1.0
#: A letter is known if it stands so often in runs that no swap explains.
KNOWN = 2

PAGES = ("cp1252", "latin_1", "cp1250", "cp1251", "cp1253", "cp1254", "cp1257", "iso8859_2", "iso8859_15", "mac_roman", "cp437", "cp850", "cp852", "koi8_r", "cp866", "gb18030", "big5", "shift_jis", "euc_kr")
RUN = re.compile(r"(?:[^\x00-\x7fऀ-ॿ​-‍﻿]|&[A-Za-z]{2,8}\d{0,2};|&#\d{2,5};|(?<=[^\x00-\x7f])[\x00-\x1f](?=[^\x00-\x7f]))+")
LOST = re.compile("[�\x80-\x9f]")
INDIC = range(0x900, 0x980)

_TABLES: dict[str, dict[str, bytes]] = {}


def _bytes(run: str, page: str) -> bytes | None:
    """The run's bytes under a code page; bytes that the page leaves open stand for themselves."""
    if page not in _TABLES:
        table = {}
        if page not in ("gb18030", "big5", "shift_jis", "euc_kr"):
            for b in range(256):
                try:
                    table[bytes([b]).decode(page)] = bytes([b])
                except UnicodeDecodeError:
                    table.setdefault(chr(b), bytes([b]))
        _TABLES[page] = table
    if table := _TABLES[page]:
        out = [table.get(c) for c in run]
        return None if None in out else b"".join(out)
    try:
        return run.encode(page)
    except UnicodeEncodeError:
        return None


def _once(run: str, page: str) -> str | None:
    raw = _bytes(run, page)
    if raw is None or raw.isascii():
        return None
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        return None


def _turned(text: str, page: str, turns: int) -> str | None:
    for _ in range(turns):
        text = _once(text, page)
        if text is None:
            return None
    return text


def _symbols(run: str, text: str, read) -> list[tuple[str, str]]:
    """The run cut into the shortest strings that ``read`` makes letters of: (symbol, letters)."""
    out, at = [], 0
    while at < len(run):
        for end in range(at + 1, len(run) + 1):
            letters = read(run[at:end])
            if letters:
                break
        else:
            return [(run, text)]
        out.append((run[at:end], letters))
        at = end
    return out if "".join(x for _, x in out) == text else [(run, text)]


def readings(run: str) -> list[tuple[str, str]]:
    """(swap, text) of what a run may have been; a swap may have happened any number of times, for each makes the text shorter."""
    return [(swap, text) for swap, text, _ in spelled(run)]


def spelled(run: str) -> list[tuple[str, str, list[tuple[str, str]]]]:
    """(swap, text, symbols) of what a run may have been."""
    plain = html.unescape(run) if "&" in run else run
    found: dict[str, tuple[str, list[tuple[str, str]]]] = {}

    def part(piece: str, page: str) -> str | None:
        """Characters that a swap leaves alone, which are ASCII, stand for themselves."""
        return piece if piece.isascii() else _once(piece, page)

    for page in PAGES:
        text, symbols, turn = plain, [(c, c) for c in plain], 0
        while True:
            last, text = text, _once(text, page)
            if text is None or text == last:
                break
            turn += 1
            # symbols of this turn, each joined with those of the turns before that it is made of
            now, pending, source, want = [], "", "", list(_symbols(last, text, lambda x: part(x, page)))
            before = iter(symbols)
            for piece, letters in want:
                while len(pending) < len(piece):
                    s, x = next(before)
                    pending, source = pending + x, source + s
                if pending == piece:
                    now.append((source, letters))
                    pending, source = "", ""
                else:  # symbols that cross are one
                    now = [(plain, text)]
                    break
            symbols = now
            if text not in found and all(c.isprintable() or c in "\n\r\t­\xa0​" for c in text):
                found[text] = f"{page}*{turn}", symbols
            if text.isascii() or len(symbols) == 1 and symbols[0] == (plain, text) and turn > 8:
                break
    if any("\x80" <= c <= "\x9f" for c in plain):
        try:
            symbols = [(c, c.encode("latin_1").decode("cp1252") if "\x80" <= c <= "\x9f" else c) for c in plain]
            found.setdefault("".join(x for _, x in symbols), ("cp1252 as latin_1", symbols))
        except UnicodeError:
            pass
    for page in ("utf-16-le", "utf-16-be"):
        if len(plain) > 1 and all(ord(c) > 0xFF for c in plain):
            raw = plain.encode(page, "surrogatepass")
            if raw.isascii() and all(32 <= b < 127 or b in (9, 10, 13) for b in raw):
                text = raw.decode("ascii")
                found.setdefault(text, (page, [(c, text[2 * i : 2 * i + 2]) for i, c in enumerate(plain)]))
    found.pop(plain, None)
    return [(swap, text, [x for x in symbols if x[0] != x[1]] or [(plain, text)]) for text, (swap, symbols) in found.items()]


class Language:
    """Bigram counts around characters outside ASCII, known letters, and the table of each source: (source, symbol, letters) to a count, a symbol as its own letters where it is none."""

    def __init__(self, pairs: dict[tuple[str, str], float], singles: dict[str, float], table: dict[tuple[str, str, str], float], letters: dict[str, float]):
        # a pair seen about once is no habit of the language
        self.pairs, self.singles, self.table, self.letters = {k: n - 0.9 for k, n in pairs.items()}, singles, table, letters
        self.whole = sum(singles.values()) or 1.0
        self.best: dict[tuple[str, str], tuple[float, str]] = {}
        for (source, symbol, text), n in table.items():
            if symbol != text and (n, text) > self.best.get((source, symbol), (0.0, "")):
                self.best[source, symbol] = n, text

    def odds(self, source: str, symbol: str, text: str) -> float:
        """How much likelier a symbol of the source is these letters than itself."""
        table = self.table.get
        return max(-MOST_ODDS, min(MOST_ODDS, math.log((table((source, symbol, text), 0.0) + PRIOR) / (table((source, symbol, symbol), 0.0) + PRIOR))))

    def letters_of(self, source: str, symbols: list[tuple[str, str]]) -> dict[str, str]:
        """The source's letters for symbols; of letters equally likely those given."""
        out = {}
        for symbol, text in symbols:
            n, best = self.best.get((source, symbol), (0.0, text))
            out[symbol] = best if n > 1.001 * self.table.get((source, symbol, text), 0.0) else text
        return out

    def score(self, before: str, text: str, after: str) -> float:
        """Log-likelihood of a reading between its neighbours, up to a constant of the left neighbour."""
        total, x = 0.0, before
        for c in text + after:
            if x.isascii() and c.isascii():
                total -= 1.8
            elif ord(x) in INDIC or ord(c) in INDIC:
                total -= 2.4
            elif x == before and x.isascii():
                total += math.log((self.pairs.get((x, c), 0.0) + 0.05) / self.whole)
            else:
                total += math.log((self.pairs.get((x, c), 0.0) + 0.05) / (self.singles.get(x, 0.0) + 5.0))
            x = c
        return total

    def weigh(self, source: str, before: str, run: str, after: str, options: list[tuple[str, str, list[tuple[str, str]]]]) -> list[float]:
        """Log-odds of each reading over the run as it stands."""
        plain, out = self.score(before, run, after), []
        for _, text, symbols in options:
            known = all(c.isascii() or ord(c) in INDIC or self.letters.get(c, 0.0) >= KNOWN for c in text)
            # a symbol that a run repeats tells no more than once
            out.append(self.score(before, text, after) - plain + sum(self.odds(source, s, x) for s, x in set(symbols)) if known else -99.0)
        return out


def learn(documents: DataFrame, text: str, source: str, kept: Kept) -> tuple[dict, dict, dict, dict]:
    """Bigram, letter and table counts after ROUNDS of expectation and maximization over all documents.

    The corpus stays distributed; only counts that matter come together, and more than MOST_ENTRIES of them are an error.
    """
    spark = documents.sparkSession

    def runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            seen: Counter = Counter()
            for s, t in zip(b.source, b.text):
                for m in RUN.finditer(t):
                    i, j = m.span()
                    seen[s or "", t[i - 1 : i].lower() or " ", m[0], t[j : j + 1].lower() or " "] += 1
            yield pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["g", "before", "run", "after", "n"])

    rows = documents.select(F.col(source).alias("source"), F.col(text).alias("text")).where(F.col("text").rlike(r"[^\x00-\x7f]|&[A-Za-z]{2,8};|&#\d"))
    table = rows.mapInPandas(runs, "g string, before string, run string, after string, n long").groupBy("g", "before", "run", "after").agg(F.sum("n").alias("n"))
    table = kept.keep(table, "runs")
    pairs: dict[tuple[str, str], float] = {}
    singles: dict[str, float] = {}
    tables: dict[tuple[str, str, str], float] = {}
    letters: dict[str, float] = {}
    for turn in range(ROUNDS):
        sent = spark.sparkContext.broadcast((pairs, singles, tables, letters))

        def expect(batches: Iterator[pd.DataFrame], sent=sent, turn=turn) -> Iterator[pd.DataFrame]:
            language = Language(*sent.value)
            for b in batches:
                seen: Counter = Counter()
                for g, before, run, after, n in zip(b.g, b.before, b.run, b.after, b.n):
                    options = spelled(run)
                    weights = language.weigh(g, before, run, after, options) if turn else [1.0] * len(options)
                    if not turn and not options:
                        for c in run:
                            seen["letter", "", c, ""] += n
                    top = max([0.0, *weights])
                    parts = [math.exp(-top), *(math.exp(w - top) for w in weights)]
                    whole = sum(parts)
                    for k, p in enumerate(parts):
                        p = p / whole * n
                        if k:
                            line = before + options[k - 1][1] + after
                            for symbol, letter in set(options[k - 1][2]):
                                seen["table", g, symbol, letter] += p
                        else:
                            line = before + run + after
                            for symbol in {s for _, _, symbols in options for s, _ in symbols}:
                                seen["table", g, symbol, symbol] += p
                        for x, y in zip(line, line[1:]):
                            if not (x.isascii() and y.isascii()):
                                seen["pair", "", x, y] += p
                                seen["single", "", x, ""] += p
                yield pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["what", "g", "x", "y", "n"])

        counts = table.mapInPandas(expect, "what string, g string, x string, y string, n double").groupBy("what", "g", "x", "y").agg(F.sum("n").alias("n"))
        least = F.when(F.col("what") == "pair", 0.9).when(F.col("what") == "table", 0.01).otherwise(0.0)
        counts = kept.keep(counts.where(F.col("n") > least), "counts")
        if (n := counts.count()) > MOST_ENTRIES:
            raise ValueError(f"{n} counts to learn from; at most {MOST_ENTRIES} are sent to workers")
        pairs, singles, tables = {}, {}, {}
        for r in counts.toLocalIterator():
            if r.what == "letter":
                letters[r.x] = r.n
            elif r.what == "pair":
                pairs[r.x, r.y] = r.n
            elif r.what == "single":
                singles[r.x] = r.n
            else:
                tables[r.g, r.x, r.y] = r.n
    return pairs, singles, tables, letters


def substitute(symbols: list[tuple[str, str]], plain: str, letters: dict[str, str]) -> str:
    """The run with each of its symbols replaced: symbols become single code points, which ``translate`` turns into letters."""
    codes = {s: chr(0xF0000 + k) for k, s in enumerate(dict.fromkeys(s for s, _ in symbols))}
    coded = re.sub("|".join(re.escape(s) for s in sorted(codes, key=len, reverse=True)), lambda m: codes[m[0]], plain)
    return coded.translate({ord(c): letters[s] for s, c in codes.items()})


def repair(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, restored, n_runs, n_lost) of each document with wrongly decoded characters.

    ``restored`` is the text with all runs read; it is null where nothing could be read. ``n_lost`` counts characters whose original is gone.
    Null and empty texts and null ids give no row; repeated rows give one. A null source is a source of its own.
    """
    kept = Kept(documents.sparkSession)
    sent = documents.sparkSession.sparkContext.broadcast(learn(documents, text, source, kept))

    def mend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        language = Language(*sent.value)
        memo: dict[tuple, str | None] = {}
        for b in batches:
            out = []
            for i, s, t in zip(b.id, b.source, b.text):
                g, parts, at, n = s or "", [], 0, 0
                for m in RUN.finditer(t):
                    x, y = m.span()
                    key = (g, t[x - 1 : x].lower() or " ", m[0], t[y : y + 1].lower() or " ")
                    if key not in memo:
                        if len(memo) > 200_000:
                            memo.clear()
                        options = spelled(m[0])
                        weights = language.weigh(g, key[1], m[0], key[3], options)
                        best = max(range(len(options)), key=weights.__getitem__, default=None)
                        memo[key] = None
                        if best is not None and weights[best] > MARGIN:
                            symbols = options[best][2]
                            memo[key] = substitute(symbols, html.unescape(m[0]) if "&" in m[0] else m[0], language.letters_of(g, symbols))
                    if memo[key] is not None:
                        parts += [t[at:x], memo[key]]
                        at, n = y, n + 1
                fixed = "".join([*parts, t[at:]])
                lost = len(LOST.findall(fixed))
                if n or lost:
                    out.append((i, fixed if n else None, n, lost))
            yield pd.DataFrame(out, columns=["id", "restored", "n_runs", "n_lost"])

    rows = documents.select(F.col(doc_id).cast("long").alias("id"), F.col(source).alias("source"), F.col(text).alias("text")).where("id is not null").where(F.col("text").rlike(r"[^\x00-\x7f]|&[A-Za-z]{2,8};|&#\d"))
    return rows.mapInPandas(mend, "id long, restored string, n_runs int, n_lost int").dropDuplicates(["id"]).withColumnRenamed("id", doc_id)
