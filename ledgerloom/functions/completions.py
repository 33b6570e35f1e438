"""Answers of a completion service, captured as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.text import collapse, or_null


def json_text(x: Column) -> Column:
    """The JSON object in an answer: the answer itself, or what stands from its first to its last brace; null where that is no object."""
    found = F.regexp_extract(x, r"(?s)\{.*\}", 0)
    return F.when(F.try_parse_json(found).isNotNull() & (found != ""), found)


def field(json: Column, name: str) -> Column:
    """A text field, stripped, at most 250 letters; empty is null."""
    return or_null(F.substring(F.trim(F.get_json_object(json, f"$.{name}")), 1, 250))


def short_description(description: Column, name: Column, industry: Column, city: Column, stage: Column) -> Column:
    """The description in at most 200 letters, cut between words, else a sentence made of what is known; null without a name."""
    d = collapse(description)
    cut = F.substring(d, 1, 200)
    cut = F.when(F.instr(cut, " ") > 0, F.regexp_replace(cut, " [^ ]*$", "")).otherwise(cut)
    made = F.concat(name, F.lit(" is a "), F.coalesce(F.concat(F.lower(stage), F.lit("-stage ")), F.lit("")), F.coalesce(industry, F.lit("technology")), F.lit(" company"), F.coalesce(F.concat(F.lit(" based in "), city), F.lit("")), F.lit("."))
    return F.when(description != "", F.when(F.length(d) > 200, cut).otherwise(d)).otherwise(F.replace(made, F.lit("  "), F.lit(" ")))


def signs(text: Column, words: list[str]) -> Column:
    """How many different ones of the words stand in the text."""
    return F.size(F.filter(F.array(*map(F.lit, words)), lambda w: F.contains(F.lower(text), w)))
