"""The main body of web pages, apart from menus, notices, side boxes and footers.

A page is a tree of containers with lines of text. Boosted trees score every line by its
words, its tag, the attribute tokens and depth of its containers, the density of the
containers' subtrees and its siblings. There are no labels and no lists of wordings: the
trees learn from pages that say by their structure what is what. Lines in elements named
for navigation, side boxes and footers are boilerplate, headings and running sentences in
the container that holds the text are main body, and a line that repeats over hosts in
boilerplate places is boilerplate wherever it stands. From these labels come the weights
of words, pairs of words and attribute tokens, and the first trees, which see no names of
elements; what they tell of unlabelled lines trains the final trees, which see everything.
Decoding over the tree then lets a container be boilerplate as a whole, or main text in
which single lines may be boilerplate at a price; nothing under a boilerplate container
stays main text.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.boosting import Boosted

#: The classifier is fitted on the lines of at most so many pages, those with the lowest hashes, and on at most so many lines of each.
TRAIN_PAGES, TRAIN_LINES = 900, 300
#: Log-odds that a boilerplate line in a main container, or a boilerplate container, must exceed.
PRICE = 0.7
#: Log-odds of the first trees from which an unlabelled line is a label for the final ones.
SURE = 1.5
#: A running sentence has so many words.
SENTENCE = 5
#: Words and pairs have weights if so many hosts have them, and a line that is no sentence is boilerplate if so many hosts have it letter for letter.
HOSTS, REPEATS = 3, 4
#: A container outside the main body's with a smaller part of the page's words than this is no second body.
SMALL = 0.15
#: The price of each change between boilerplate and own words inside one text, and the own words a mixed text has at least.
SEAM, OWN_WORDS = 3.0, 4
#: The weight of a word without one inside a text: boilerplate repeats its words, so what repeats nowhere is rather own.
UNSEEN = -1.0

CONTAINERS = {"div", "section", "header", "footer", "nav", "aside", "main", "article", "table", "tr", "tbody", "ul", "ol", "dl", "form", "body", "html"}
HIDDEN = {"head", "script", "style", "noscript", "template", "title"}
TAG_NO = {t: i for i, t in enumerate(("bare", "p", "div", "td", "li", "span", "a", "small", "h1", "h2", "h3", "button", "label"))}
#: Names that pages give to elements around the main body, and to the main body's own.
AWAY = {"nav", "navbar", "navigation", "menu", "header", "banner", "footer", "contentinfo", "aside", "sidebar", "complementary", "widget", "breadcrumb", "breadcrumbs", "cookie", "cookies", "consent", "social", "share", "related", "promo", "copyright"}
MAIN = {"main", "article", "content", "post", "story", "entry"}
ENDS = ".!?।”\"'"
SIMPLE = re.compile(r"<(p|li|a|span|td|small|h[1-6]|div|button|label|th|dt|dd)>([^<]*)</\1>$")
TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<!--.*?-->|<![^>]*>", re.S)
ATTRIBUTE = re.compile(r"(?:class|id|role|aria-label)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
NUMBER = re.compile(r"\d+")


def marks_of(tag: str, attributes: str) -> tuple[str, ...]:
    """The tag, and the words of class, id and role."""
    return (tag, *dict.fromkeys(w for a in ATTRIBUTE.findall(attributes) for w in re.findall(r"[a-z]+", a.lower()))) if attributes else (tag,)


def words_of(text: str) -> list[str]:
    """Words between blanks in lower case, each number a 0."""
    return NUMBER.sub("0", text.lower()).split()


class Weights:
    """Log-odds for boilerplate of words, pairs of neighbours, whole lines and marks of elements; what wasn't seen has none."""

    def __init__(self, words: dict, pairs: dict, lines: dict, marks: dict):
        self.words, self.pairs, self.lines, self.marks = words, pairs, lines, marks

    @classmethod
    def count(cls, lines: list[tuple[str, str]], y: np.ndarray, hosts: list[str], paths: list[tuple[str, ...]]) -> Weights:
        """From lines (text, tag) with labels: words and pairs by lines, where HOSTS have them (a host's own name has no weight), whole lines by hosts, marks by lines below them."""
        n = [Counter(), Counter()]
        seen: dict = {}
        pairs: list[Counter] = [Counter(), Counter()]
        marks: list[Counter] = [Counter(), Counter()]
        whole: list[dict[str, set]] = [{}, {}]
        total = [1.0, 1.0]
        for (text, _), label, host, path in zip(lines, y, hosts, paths):
            if label < 0:
                continue
            ws = words_of(text)
            total[label] += len(ws)
            n[label].update(ws)
            both = list(zip(["<", *ws], [*ws, ">"]))
            pairs[label].update(both)
            for w in (*ws, *both):
                if len(known := seen.setdefault(w, set())) < HOSTS:
                    known.add(host)
            marks[label].update(path)
            if len(ws) < 30:  # longer lines have enough words of their own
                whole[label].setdefault(" ".join(ws), set()).add(host)
        base = math.log(total[1] / total[0])

        def odds(c: list[Counter], least: int, shift: float) -> dict:
            return {k: max(-4.0, min(4.0, math.log((c[1][k] + 0.5) / (c[0][k] + 0.5)) - shift)) for k in c[0].keys() | c[1].keys() if c[0][k] + c[1][k] >= least and len(seen.get(k, "all")) >= HOSTS}

        sizes = [Counter({k: len(v) for k, v in w.items()}) for w in whole]
        return cls(odds(n, HOSTS, base), odds(pairs, HOSTS, base), odds(sizes, 2, 0.0), odds(marks, 5, math.log(max(1, sum(marks[1].values())) / max(1, sum(marks[0].values())))))

    def text_features(self, text: str) -> tuple:
        masked, numbers = NUMBER.subn("0", text.lower())
        ws = masked.split()
        n = len(ws)
        get, pair = self.words.get, self.pairs.get
        own = [get(w, 0.0) for w in ws]
        upper = len([1 for w in text.split() if w[0].isupper()])
        return (
            n, len(text), text[-1] in ENDS, text.count(","), numbers / n, upper / n, sum(own) / n, min(own), max(own), own[0], own[-1], own.count(0.0) / n,
            pair(("<", ws[0]), 0.0), pair((ws[0], ws[1] if n > 1 else ">"), 0.0), pair((ws[-1], ">"), 0.0), self.lines.get(" ".join(ws), 0.0) if n < 30 else 0.0, ws[0][-1] == ":" or n > 1 and ws[1][-1] == ":",
        )

    def mark(self, path: tuple[str, ...]) -> float:
        return sum(self.marks.get(m, 0.0) for m in path) / len(path)


NO_WEIGHTS = Weights({}, {}, {}, {})
N_TEXT = 17
MEAN = 6  # the place of the mean weight among them
#: Features that don't name elements, which the first trees see.
UNNAMED = [*range(N_TEXT), *range(N_TEXT + 4, N_TEXT + 24)]


class Page:
    """Lines (number, text, tag, container), and containers' parents, depths and marks."""

    def __init__(self, html: str):
        self.parent, self.depth, self.marks = [-1], [0], [("page",)]
        self.lines: list[tuple[int, str, str, int]] = []
        stack: list[tuple[str, int]] = []
        here, hidden, lines = 0, None, self.lines
        for number, line in enumerate(html.split("\n"), 1):
            line = line.strip()
            if not line:
                continue
            if hidden is None:
                if m := SIMPLE.match(line):
                    text = m[2].strip()
                    if text:
                        lines.append((number, entities.unescape(text) if "&" in text else text, m[1], here))
                    continue
                if "<" not in line:
                    lines.append((number, entities.unescape(line) if "&" in line else line, "bare", here))
                    continue
            at, out, leaf, own = 0, [], "bare", here
            for m in TAG.finditer(line):
                if hidden is None and m.start() > at:
                    part = line[at : m.start()]
                    if not part.isspace():
                        out.append(part)
                        own = here
                at = m.end()
                if not m[2]:
                    continue
                tag = m[2].lower()
                if m[1]:
                    if hidden is not None:
                        if tag == hidden:
                            hidden = None
                    elif tag in CONTAINERS:
                        for k in range(len(stack) - 1, -1, -1):
                            if stack[k][0] == tag:
                                here = stack[k][1]
                                del stack[k:]
                                break
                elif hidden is None:
                    if tag in HIDDEN:
                        hidden = tag
                    elif tag in CONTAINERS:
                        if tag in ("tr", "li", "td") and stack and stack[-1][0] == tag:
                            here = stack.pop()[1]
                        stack.append((tag, here))
                        self.parent.append(here)
                        self.depth.append(self.depth[here] + 1)
                        self.marks.append(marks_of(tag, m[3]))
                        here = len(self.parent) - 1
                        leaf = tag if tag == "div" else leaf
                    else:
                        leaf = tag
            if hidden is None and at < len(line):
                part = line[at:]
                if not part.isspace():
                    out.append(part)
                    own = here
            text = " ".join(x.strip() for x in out).strip()
            text = entities.unescape(text) if "&" in text else text
            if text.strip():
                lines.append((number, text, leaf, own))

    def flat(self) -> Page:
        """The page as bare text: its lines without tags and containers."""
        other = Page("")
        other.lines = [(no, text, "bare", 0) for no, text, _, _ in self.lines]
        return other

    def path(self, c: int) -> tuple[str, ...]:
        """The marks of a container and those around it."""
        out: list[str] = []
        while c > 0:
            out += self.marks[c]
            c = self.parent[c]
        return tuple(dict.fromkeys(out)) or ("page",)


class Batch:
    """The lines of many pages and their features."""

    def __init__(self, pages: list[Page], weights: Weights, memo: dict[str, tuple]):
        if len(memo) > 300_000:
            memo.clear()
        rows, page, number, inside, self.texts = [], [], [], [], []
        parent, depth, page_of, marks, first = [], [], [], [], 0
        odds: dict[tuple[str, ...], float] = {}
        for p, one in enumerate(pages):
            for no, text, tag, c in one.lines:
                f = memo.get(text)
                if f is None:
                    f = memo[text] = weights.text_features(text)
                rows.append(f)
                page.append(p)
                number.append(no)
                inside.append(first + c)
                self.texts.append((text, tag))
            for q, d, m in zip(one.parent, one.depth, one.marks):
                parent.append(first + q if q >= 0 else -1)
                depth.append(d)
                if m not in odds:
                    odds[m] = weights.mark(m)
                marks.append(odds[m])
            page_of += [p] * len(one.parent)
            first += len(one.parent)
        self.page, self.number, self.inside = np.array(page, int), np.array(number, int), np.array(inside, int)
        self.parent, self.depth, self.page_of = np.array(parent, int), np.array(depth, int), np.array(page_of, int)
        self.text = np.array(rows, dtype=np.float32).reshape(-1, N_TEXT)
        self.own_mark = np.array(marks, float)

    def features(self) -> np.ndarray:
        text, page, inside, parent, depth = self.text, self.page, self.inside, self.parent, self.depth
        n, k = len(text), len(parent)
        if not n:
            return np.zeros((0, N_TEXT + 24), np.float32)
        words, ends, mean = text[:, 0], text[:, 2], text[:, MEAN]
        own_n, own_words = np.bincount(inside, minlength=k), np.bincount(inside, words, k)
        own_ends, own_mean = np.bincount(inside, ends, k), np.bincount(inside, mean, k)
        sub_n, sub_words = own_n.astype(float), own_words.copy()
        path_most, path_least = self.own_mark.copy(), self.own_mark.copy()
        top = int(depth.max())
        for d in range(top, 0, -1):
            at = np.flatnonzero(depth == d)
            np.add.at(sub_n, parent[at], sub_n[at])
            np.add.at(sub_words, parent[at], sub_words[at])
        for d in range(1, top + 1):
            at = np.flatnonzero(depth == d)
            path_most[at] = np.maximum(path_most[at], path_most[parent[at]])
            path_least[at] = np.minimum(path_least[at], path_least[parent[at]])
        pages = page.max() + 1
        page_n, page_words = np.bincount(page, minlength=pages), np.bincount(page, words, pages)
        order = np.arange(n) - np.concatenate([[0], np.cumsum(page_n)])[page]
        around = np.full((n, 6), -9, np.float32)
        same = page[1:] == page[:-1]
        for j, col in enumerate((words, ends, mean)):
            around[1:, j][same] = col[:-1][same]
            around[:-1, 3 + j][same] = col[1:][same]
        biggest = np.zeros(pages)
        here = self.page_of < pages
        np.maximum.at(biggest, self.page_of[here], own_words[here])
        safe = np.maximum(1, own_n)
        up = np.where(parent[inside] >= 0, parent[inside], inside)
        node = np.stack([
            np.array([TAG_NO.get(t, 20) for _, t in self.texts]), self.own_mark[inside], path_most[inside], path_least[inside],
            depth[inside], own_n[inside], (own_words / safe)[inside], (own_ends / safe)[inside], (own_mean / safe)[inside], own_words[inside] / np.maximum(1, page_words[page]), own_words[inside] / np.maximum(1, biggest[page]),
            sub_words[inside] / np.maximum(1, sub_n[inside]), sub_words[up] / np.maximum(1, sub_n[up]), sub_words[up] / np.maximum(1, page_words[page]), order / np.maximum(1, page_n[page] - 1), np.minimum(order, 40), np.minimum(page_n[page] - order, 40), page_n[page],
        ], axis=1)
        return np.concatenate([text, node, around], axis=1).astype(np.float32)

    def share(self) -> np.ndarray:
        """The part of its page's words that the container of each line holds itself."""
        words = np.array([len(t.split()) for t, _ in self.texts], float)
        own = np.bincount(self.inside, words, len(self.parent))
        return own[self.inside] / np.maximum(1, np.bincount(self.page, words)[self.page]) if len(words) else words


def seeds(pages: list[Page], hosts: list[str], batch: Batch) -> np.ndarray:
    """1 boilerplate, 0 main body, -1 not clear.

    By the names of elements and by place: small containers outside the one that holds the main body are boilerplate. Then by repetition: what repeats
    over hosts in boilerplate places, or is no sentence and repeats over many hosts letter for letter, is boilerplate where it isn't main body somewhere.
    """
    share, y = batch.share(), []
    lines = [(p, *x) for p, one in enumerate(pages) for x in one.lines]
    paths: dict[tuple[int, int], tuple[bool, bool]] = {}
    body: dict[int, tuple[float, int]] = {}
    for i, (p, _, _, _, c) in enumerate(lines):
        if (p, c) not in paths:
            own = set(pages[p].path(c))
            paths[p, c] = bool(own & AWAY), bool(own & MAIN)
        if c and share[i] > 0.5 and not paths[p, c][0]:
            body[p] = max(body.get(p, (0.0, 0)), (share[i], c))
    for i, (p, _, text, tag, c) in enumerate(lines):
        away, main = paths[p, c]
        long = len(text.split()) >= SENTENCE and text[-1] in ENDS
        around, at = p in body, c
        while around and at >= 0:
            around, at = at != body[p][1], pages[p].parent[at]
        if tag in ("h1", "h2", "h3") and not away:
            y.append(0)
        elif away and not main and not (long and len(text) > 100) or around and share[i] < SMALL:
            y.append(1)
        else:
            y.append(0 if long and not away and c and (main and share[i] >= SMALL or share[i] > 0.5) else -1)
    known = np.array(y, int)
    places: dict[str, list[set]] = {}
    repeated: dict[str, set] = {}
    for k, (p, _, text, _, _) in zip(known, lines):
        repeated.setdefault(text, set()).add(hosts[p])
        if k >= 0:
            places.setdefault(" ".join(words_of(text)), [set(), set()])[k].add(hosts[p])
    for i in np.flatnonzero(known < 0):
        p, _, text, _, _ = lines[i]
        main, away = places.get(" ".join(words_of(text)), (set(), set()))
        if not main and (len(away - {hosts[p]}) >= 2 or len(repeated[text]) >= REPEATS and text[-1] not in ENDS):
            known[i] = 1
    return known


class Model:
    """Trees for lines in their page and for texts that stand in none, and the weights both use."""

    def __init__(self, weights: Weights, in_page: Boosted, alone: Boosted):
        self.weights, self.in_page, self.alone = weights, in_page, alone

    def state(self) -> dict:
        w = self.weights
        return {"weights": (w.words, w.pairs, w.lines, w.marks), "in_page": self.in_page.state(), "alone": self.alone.state()}

    @classmethod
    def of(cls, state: dict) -> Model:
        return cls(Weights(*state["weights"]), Boosted.of(state["in_page"]), Boosted.of(state["alone"]))


def fit(htmls: list[str], hosts: list[str]) -> Model:
    """A model of the pages given. Weights are never taken from the fold of hosts whose lines they describe to the trees."""
    pages = [Page(h) for h in htmls]
    for p in pages:
        p.lines = [x for x in p.lines if x[0] <= TRAIN_LINES]
    plain = Batch(pages, NO_WEIGHTS, {})
    y = seeds(pages, hosts, plain)
    names = [hosts[p] for p in plain.page]
    path = [[pages[p].path(c) for c in range(len(pages[p].parent))] for p in range(len(pages))]
    paths = [path[p][x[3]] for p, one in enumerate(pages) for x in one.lines]
    fold = np.array([sum(h.encode()) % 2 for h in hosts], int)
    own_fold = fold[plain.page] if len(plain.page) else np.zeros(0, int)
    # pages have structure or are bare text, and the trees must do with either: each page counts as both
    flat = [p.flat() for p in pages]

    def crossed(y: np.ndarray) -> np.ndarray:
        x = np.zeros((2 * len(y), N_TEXT + 24), np.float32)
        for f in (0, 1):
            weights, memo = Weights.count(plain.texts, np.where(own_fold == f, -1, y), names, paths), {}
            mine = own_fold == f
            for k, form in enumerate((pages, flat)):
                x[k * len(y) : (k + 1) * len(y)][mine] = Batch(form, weights, memo).features()[mine]
        return x

    x, both = crossed(y), np.concatenate([y, y])
    first = Boosted().fit(x[both >= 0][:, UNNAMED], both[both >= 0])
    score = first.log_odds(x[:, UNNAMED])
    score = (score[: len(y)] + score[len(y) :]) / 2
    y = np.where(y >= 0, y, np.where(score > SURE, 1, np.where(score < -SURE, 0, -1)))
    x, both = crossed(y), np.concatenate([y, y])
    in_page = Boosted().fit(x[both >= 0], both[both >= 0])
    return Model(Weights.count(plain.texts, y, names, paths), in_page, Boosted().fit(x[: len(y)][y >= 0][:, :N_TEXT], y[y >= 0]))


def train(pages: DataFrame, key: str, html: str) -> Model:
    """A model fitted on the lines of at most TRAIN_PAGES pages, the same ones on every run. The host of a page is the part of the key before its last slash."""
    n = pages.count()
    share = min(1.0, 1.3 * TRAIN_PAGES / max(1, n))
    some = pages.select(F.pmod(F.xxhash64(key), F.lit(1_000_000)).alias("h"), F.col(key).alias("key"), F.col(html).alias("html")).where(F.col("html").isNotNull() & F.col("key").isNotNull() & (F.col("h") < int(share * 1_000_000) + 1))
    got = some.orderBy("h", "key").limit(TRAIN_PAGES).select("key", F.substring_index("html", "\n", TRAIN_LINES).alias("html")).toPandas()
    return fit(list(got.html), [k.rpartition("/")[0] or k for k in got.key])


def decode(score: np.ndarray, inside: np.ndarray, parent: np.ndarray, depth: np.ndarray, price: float = PRICE) -> np.ndarray:
    """Which lines are boilerplate, in the labelling of the tree with the highest total score."""
    k = len(parent)
    whole = np.bincount(inside, score, k)
    mixed = np.bincount(inside, np.maximum(0, score - price), k)
    top = int(depth.max()) if k else 0
    levels = [np.flatnonzero(depth == d) for d in range(top + 1)]
    for d in range(top, 0, -1):
        at = levels[d]
        np.add.at(whole, parent[at], whole[at])
        np.add.at(mixed, parent[at], np.maximum(mixed[at], whole[at] - price))
    state = np.zeros(k, bool)
    for d in range(1, top + 1):
        at = levels[d]
        state[at] = state[parent[at]] | (whole[at] - price > mixed[at])
    return state[inside] | (score > price)


def mark_lines(pages: DataFrame, key: str, html: str, model: Model) -> DataFrame:
    """(record_key, line_no) of each visible line that is boilerplate; lines count from 1.

    Null and empty pages and null keys give no row. A page without a tag is bare text whose lines are siblings.
    """
    sent = pages.sparkSession.sparkContext.broadcast(model.state())

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, memo = Model.of(sent.value), {}
        for b in batches:
            for at in range(0, len(b), 1000):
                part = b.iloc[at : at + 1000]
                own = Batch([Page(h) for h in part.html], model.weights, memo)
                if not len(own.page):
                    continue
                away = decode(model.in_page.log_odds(own.features()), own.inside, own.parent, own.depth)
                page, number = own.page[away], own.number[away]
                ends = np.searchsorted(page, np.arange(len(part) + 1))
                yield pd.DataFrame({"record_key": part.record_key, "lines": [number[ends[i] : ends[i + 1]] for i in range(len(part))]})

    kept = pages.select(F.col(key).alias("record_key"), F.col(html).alias("html")).where("record_key is not null and html is not null")
    return kept.mapInPandas(mark, "record_key string, lines array<int>").select("record_key", F.explode("lines").alias("line_no"))


def pieces(text: str, weights: Weights) -> list[tuple[str, bool]]:
    """A text of one line cut where its words turn from boilerplate to own ones and back: (piece, whether its words are boilerplate's).

    The labelling of words with the highest total weight, each change at its price; it can change only before a word that may begin a line.
    """
    shown = text.split()
    ws = words_of(text)
    if len(ws) != len(shown):  # a letter whose lower case holds a blank
        ws = [NUMBER.sub("0", w.lower()) for w in shown]
    shouted = text.isupper()
    pair, one = weights.pairs.get, weights.words.get
    own, away = 0.0, -SEAM
    back: list[tuple[int, int]] = []
    for i, w in enumerate(ws):
        after_end = i == 0 or shown[i - 1][-1] in ENDS
        begins = after_end or not (shouted or shown[i][0].islower())
        single = one(w, UNSEEN)
        inner = pair((ws[i - 1], w), single) if i else single
        start = pair(("<", w), single)
        stay, turn = own - inner, away - SEAM - start
        next_own = (turn, 1) if begins and turn > stay else (stay, 0)
        stay, turn = away + inner, own - SEAM + start
        next_away = (turn, 0) if after_end and turn > stay else (stay, 1)
        own, away = next_own[0], next_away[0]
        back.append((next_own[1], next_away[1]))
    best = (own, away)
    state, states = int(best[1] > best[0]), []
    for i in range(len(ws) - 1, -1, -1):
        states.append(state)
        state = back[i][state]
    states.reverse()
    out: list[tuple[list[str], bool]] = []
    for w, s in zip(shown, states):
        if out and out[-1][1] == bool(s):
            out[-1][0].append(w)
        else:
            out.append(([w], bool(s)))
    return [(" ".join(p), s) for p, s in out]


def mixed_texts(texts: DataFrame, key: str, text: str, model: Model) -> DataFrame:
    """(key) of texts of one line in which boilerplate stands beside words of their own, each once.

    Texts are cut by ``pieces`` and the trees for lines alone judge every piece. Null and empty texts, texts all of boilerplate and texts without it give no row.
    """
    sent = texts.sparkSession.sparkContext.broadcast(model.state())

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = Model.of(sent.value)
        for b in batches:
            rows, of = [], []
            for i, t in enumerate(b.text):
                for piece, away in pieces(t, model.weights):
                    rows.append((*model.weights.text_features(piece), away))
                    of.append(i)
            x, of = np.array(rows, np.float32).reshape(-1, N_TEXT + 1), np.array(of, int)
            away = (model.alone.log_odds(x[:, :N_TEXT]) > SURE) & (x[:, N_TEXT] > 0)
            own = np.bincount(of, np.where(away, 0, x[:, 0]), len(b))
            yield b.loc[(np.bincount(of, away, len(b)) > 0) & (own >= OWN_WORDS), ["key"]]

    kept = texts.select(F.col(key).alias("key"), F.col(text).alias("text")).where("key is not null and trim(text) <> ''").distinct()
    return kept.mapInPandas(find, kept.select("key").schema).distinct().withColumnRenamed("key", key)
