"""Values that hold no words of their own: unfilled slots, filler, error pages, script notices.

Texts are cut into lines: segments, and whole titles. Templates are mined from all lines: a
line runs down a prefix tree of fixed depth (number of tokens, first token, second token),
and in its leaf a token that fewer than KEEP_HOSTS hosts have at its position is a variable,
``<*>``. That number is the same at every size of table and leaf. A title is to name its
owner, so own titles have variables; a template without variable that stands alone as the
title of SUPPORT hosts, none of which has its words in its name, is a message. Each template
is classified once, by that or by a few seeds that standards word alike everywhere, and the
verdict goes to all its lines wherever they stand. A line that is a seed by its own words is
one whatever its template masks. Slots that stand unresolved inside ordinary text are looked
for in every text, apart from lines. The mining is relational: counts by leaf, position and
token are aggregated before the shuffle, and no task sees a whole leaf.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import BLANK, is_blank
from ledgerloom.operators.skew import join_by_key
from ledgerloom.session import Kept

#: A token stays in a template if so many hosts have it at its place; a template is a message if it is the whole title of so many hosts.
KEEP_HOSTS, SUPPORT = 3, 4
#: A word of so many letters or more that stands in a host's name is its owner's.
OWN_LETTERS = 5

WORD = r"[\p{L}\p{M}\p{N}$][\p{L}\p{M}\p{N}'’_$.]*"
SEGMENTS = rf"(?<=[.!?।:…])\s+|[\r\n]+|{BLANK}+(?:\||–|—|-|::|»|·){BLANK}+"

SCRIPT = r"(?:java ?script|js|scripts?|active scripting|scripting|client side scripts?)"
REASON = (
    r"(?:bad request|unauthori[sz]ed|authori[sz]ation required|payment required|(?:access )?forbidden|(?:page |file )?not found|method not allowed|not acceptable|"
    r"request time ?out|conflict|gone|too many requests|internal server error|not implemented|bad gateway|"
    r"service (?:temporarily )?unavailable|gateway time ?out|unknown error|web server is down|origin is unreachable|connection timed out)"
)
#: Seeds: what standards and common tools word alike everywhere. All other messages are mined.
MESSAGES = {
    "script": (
        rf".*\b(?:enable|turn on|activate|allow|activer|aktivieren|active|ative|habilite)\b.{{0,30}}\b{SCRIPT}\b.*",
        rf".*\b{SCRIPT} (?:is|are|has been|must be)?\b.{{0,12}}\b(?:disabled|blocked|turned off|off|required|needed|aktivieren|सक्षम|चालू)\b.*",
        rf".*\b(?:support|without|needs|requires) {SCRIPT}\b.*",
        r"noscript\b.*|.*\bverif(?:y|ying) (?:that )?you are (?:a )?human\b.*|checking your browser\b.*",
    ),
    "error": (
        rf"(?:oops |whoops |http |status |error |code |server )*(?:error|http|status|oops|code) (?:<0>|[45]\d\d)(?: error)?(?: {REASON})?",
        rf"(?:[45]\d\d )?(?:oops |error |http )*{REASON}(?: [45]\d\d)?(?: error)?",
        r"[45]\d\d(?: error)?",
        rf"(?:http )?status [45]\d\d\b.*",
        r"traceback most recent call last\b.*|uncaught (?:exception|error)\b.*|(?:php )?(?:warning|notice|fatal error) (?:undefined|uncaught|call to)\b.*|undefined (?:variable|index|offset)\b.*",
    ),
    "filler": (r"lorem ipsum\b.*", r"(?:sample|example|dummy|placeholder|default) (?:headline|heading|text|title|description|paragraph|content)\b.{0,40}"),
}
MESSAGE = {kind: "^(?:" + "|".join(f"(?:{x})" for x in patterns) + ")$" for kind, patterns in MESSAGES.items()}
#: What servers add to their messages.
TAIL = r" (?:server|nginx|apache|iis|cloudflare|litespeed)(?: [<0>\d.]+)?$"

LOREM = (
    "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud "
    "exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur "
    "excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum"
).split()
KEYS = "blah qwerty asdf asdfgh aaa aaaa bbb test testing foo bar baz dummy xxx xyz abc zzz".split()

NAME = r"[A-Za-z_][\w.\- ]{0,40}"
PLAIN = r"(?:add|insert|enter|describe|type|write|your|company|city|state|title|tagline|name|headline|heading|business|site|page|description|slogan|industry|service|product|org|summary|keyword)"
#: Slots of template languages, and brackets around words that ask to be replaced.
SLOTS = (
    rf"\{{\{{\s*{NAME}\s*\}}\}}", rf"\{{%\s*{NAME}\s*%\}}", rf"(?:<|&lt;)%=?\s*{NAME}\s*%(?:>|&gt;)", rf"(?:<|&lt;)\?(?:=|php)?\s*\$?\s*{NAME}\s*\?(?:>|&gt;)",
    rf"[$#]\{{\s*{NAME}\s*\}}", rf"%%{NAME}%%", rf"(?<![\d%])%[A-Za-z_][\w.]*%", rf"(?i)(?<![\d%])%{PLAIN}[\w ]*%", rf"@@{NAME}@@", rf"##{NAME}##", r"(?<!\w)__[A-Za-z][A-Za-z0-9.]*(?:[_ ][A-Za-z0-9.]+)*__(?!\w)",
    rf"\[\[{NAME}\]\]", rf"\*\|{NAME}\|\*", r"(?<![{{\w])\{{\s*[A-Za-z_]\w*(?:\.\w+)*\s*\}}(?!\}})".replace("{{", "{").replace("}}", "}"),
    rf"(?i)[\[«]\s*(?:{PLAIN}\b[\w .]*|[\w .]*\b{PLAIN})\s*[\]»]", rf"(?i)(?:<|&lt;)\s*(?:{PLAIN}\b[\w .]*|[\w .]*\b{PLAIN})\s*(?:>|&gt;)", rf"(?i)\{{\s*{PLAIN}\b[\w .]*\}}",
)
#: Markup that is no slot.
TAGS = r"(?i)</?(?:title|description|summary|a|p|b|i|br|div|span|h[1-6]|li|ul|em|strong)\b[^>]*>"


def has_slot(text: Column) -> Column:
    """Whether an unresolved slot stands in the text."""
    clean = F.regexp_replace(text, TAGS, " ")
    found = F.lit(False)
    for pattern in SLOTS:
        found = found | clean.rlike(pattern)
    return F.coalesce(found, F.lit(False))


def tokens_of(segment: Column) -> Column:
    """Lower-case words; numbers other than HTTP status codes become <0>."""
    words = F.regexp_extract_all(F.regexp_replace(F.lower(segment), "’", "'"), F.lit(f"({WORD})"), 1)
    return F.transform(words, lambda w: F.when(w.rlike(r"\p{N}") & ~w.rlike(r"^[45]\d\d\.?$"), F.lit("<0>")).otherwise(F.regexp_replace(w, r"\.+$", "")))


def verdict(line: Column) -> Column:
    """The kind of message a line or template is, or null."""
    bare = F.regexp_replace(line, TAIL, "")
    words = F.split(bare, " ")
    latin = F.size(F.filter(words, lambda w: w.isin(*LOREM)))
    keys = F.size(F.filter(words, lambda w: w.isin(*KEYS)))
    kind = F.when((latin >= 2) & (latin >= 0.7 * F.size(words)) | (keys == F.size(words)), "filler")
    for name, pattern in MESSAGE.items():
        kind = kind.when(bare.rlike(pattern), name)
    return kind


def mine_templates(lines: DataFrame, kept: Kept) -> DataFrame:
    """(line, template, alone) for distinct lines (line, tokens, hosts, alone); ``alone`` is summed over the template's lines."""
    lines = lines.withColumn("leaf", F.xxhash64(F.size("tokens"), F.get("tokens", F.lit(0)), F.get("tokens", F.lit(1))))
    cells = lines.select("leaf", F.posexplode("tokens").alias("pos", "token"), "hosts").groupBy("leaf", "pos", "token").agg(F.sum("hosts").alias("n"))
    fixed = cells.where(F.col("n") >= KEEP_HOSTS).groupBy("leaf").agg(F.collect_set(F.concat_ws(" ", "pos", "token")).alias("fixed"))
    sizes = lines.groupBy("leaf").agg(F.count("*").alias("n_rows"))
    joined = join_by_key(lines, sizes.join(fixed, "leaf", "left"), "leaf")
    template = F.transform("tokens", lambda t, i: F.when(F.array_contains("fixed", F.concat_ws(" ", i.cast("string"), t)), t).otherwise(F.lit("<*>")))
    named = kept.keep(joined.select("line", F.coalesce(F.array_join(template, " "), F.lit("<*>")).alias("template"), "alone", "own"), "named")
    whole = named.groupBy("template").agg(F.sum("alone").alias("alone"), F.sum("own").alias("own"), F.count("*").alias("n_rows"))
    return join_by_key(named.select("line", "template"), whole, "template")


def find_residue(rows: DataFrame, keys: list[str], text: str, host: str | None = None, title: str | None = None) -> DataFrame:
    """(keys, kind): rows whose ``text`` holds residue; kind is slot, script, error, filler or message (one that was mined).

    ``host`` names the column with the site a row is from (else its keys tell rows apart), ``title`` a boolean column that marks titles (else there are none,
    and only seeds and slots are found). Null, empty and no-value texts hold none. Repeated rows give one row a kind. A row may have several kinds. Other
    columns of ``rows`` don't matter.
    """
    kept = Kept(rows.sparkSession)
    owner = F.coalesce(F.lower(F.col(host).cast("string")), F.concat_ws("|", *(F.col(k).cast("string") for k in keys))) if host else F.concat_ws("|", *(F.col(k).cast("string") for k in keys))
    marked = F.coalesce(F.col(title), F.lit(False)) if title else F.lit(False)
    rows = rows.select(*keys, F.col(text).alias("_text"), owner.alias("_host"), marked.alias("_title")).where(~is_blank(F.col(text))).distinct()
    slots = rows.where(has_slot(F.col("_text"))).select(*keys, F.lit("slot").alias("kind"))
    segments = F.transform(F.split("_text", SEGMENTS), lambda x: F.struct(tokens_of(x).alias("tokens"), F.lit(False).alias("alone")))
    whole = F.when(F.col("_title"), F.array(F.struct(tokens_of(F.col("_text")).alias("tokens"), F.lit(True).alias("alone")))).otherwise(F.array().cast("array<struct<tokens:array<string>,alone:boolean>>"))
    parts = rows.select(*keys, "_host", F.explode(F.concat(segments, whole)).alias("_part"))
    parts = parts.select(*keys, "_host", "_part.tokens", "_part.alone").where(F.size("tokens") > 0)
    letters = F.regexp_replace("_host", "[^a-z]", "")
    own = F.col("alone") & F.exists("tokens", lambda w: (F.length(w) >= OWN_LETTERS) & F.contains(letters, w))
    parts = kept.keep(parts.withColumn("line", F.xxhash64("tokens")).withColumn("own", own), "parts")
    by_host = parts.groupBy("line", "_host").agg(F.first("tokens").alias("tokens"), F.max("alone").cast("long").alias("alone"), F.max("own").cast("long").alias("own"))
    lines = kept.keep(by_host.groupBy("line").agg(F.first("tokens").alias("tokens"), F.count("*").alias("hosts"), F.sum("alone").alias("alone"), F.sum("own").alias("own")), "lines")
    templates = kept.keep(mine_templates(lines, kept), "templates")
    distinct = templates.select("template", "alone", "own").distinct()
    mined = (F.col("alone") >= SUPPORT) & (F.col("own") == 0) & ~F.contains("template", F.lit("<*>"))
    classified = kept.keep(distinct.select("template", F.coalesce(verdict(F.col("template")), F.when(mined, "message")).alias("kind")).where("kind is not null"), "classified")
    by_template = join_by_key(templates, classified.join(templates.groupBy("template").agg(F.count("*").alias("n_rows")), "template"), "template").select("line", "kind")
    by_words = lines.select("line", verdict(F.array_join("tokens", " ")).alias("kind")).where("kind is not null")
    judged = by_template.unionByName(by_words).groupBy("line").agg(F.min("kind").alias("kind"))
    flagged = kept.keep(judged.join(parts.groupBy("line").agg(F.count("*").alias("n_rows")), "line"), "flagged")
    messages = join_by_key(parts.select(*keys, "line"), flagged, "line").select(*keys, "kind")
    return messages.unionByName(slots).distinct()
