"""Text clean-up, keyword rules and small text formats."""

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def trim_to(text: Column, n: int) -> Column:
    return F.substring(F.coalesce(text, F.lit("")), 1, n)


def squeeze(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))


def word_cut(text: Column, limit: int) -> Column:
    """Cut at the last space within ``limit`` characters and mark the cut."""
    head = F.substring(text, 1, limit)
    at_word = F.regexp_replace(head, r" [^ ]*$", "")
    return F.when(F.length(text) > limit, F.concat(at_word, F.lit("..."))).otherwise(text)


def clean_text(text: Column, limit: int = 180,
               cuts: Sequence[str] = (" Visit https://", r"\s*\|\s*Step 1")) -> Column:
    """One-line description: whitespace collapsed, trailing pointers and walkthroughs
    dropped (``cuts``: a literal marker, then a pattern), cut at a word boundary."""
    marker, pattern = cuts
    line = squeeze(text)
    line = F.trim(F.split_part(line, F.lit(marker), F.lit(1)))
    line = F.trim(F.split(line, pattern, 2)[0])
    return word_cut(line, limit)


def tidy_text(text: Column, limit: int = 150) -> Column:
    """Short blurb: query-string examples dropped, preferably cut at a clause end that
    lies beyond 60 characters, otherwise at a word."""
    line = F.trim(F.split(squeeze(text), r"\s*[?&][A-Za-z_]+=", 2)[0])
    head = F.substring(line, 1, limit)
    clause = F.regexp_extract(head, r"^(.*)(?:\. |; | — )", 1)
    short = F.concat(
        F.when(F.length(clause) > 60, clause).otherwise(F.regexp_replace(head, r" [^ ]*$", "")),
        F.lit("..."),
    )
    return F.regexp_replace(F.when(F.length(line) > limit, short).otherwise(line), r"[ .;—-]+$", "")


def slug(text: Column) -> Column:
    dashed = F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-")
    parts = F.split(F.regexp_replace(dashed, "^-+|-+$", ""), "-")
    return F.array_join(F.slice(parts, 1, 5), "-")


def parse_pairs(text: Column) -> Column:
    """``a=1,b=2`` to a map; the last ``=`` of each part separates key and value."""
    parts = F.filter(F.split(F.coalesce(text, F.lit("")), ","), lambda p: p.contains("="))
    return F.map_from_entries(
        F.transform(
            parts,
            lambda p: F.struct(
                F.trim(F.regexp_extract(p, r"^(.*)=[^=]*$", 1)).alias("key"),
                F.trim(F.regexp_extract(p, r"=([^=]*)$", 1)).alias("value"),
            ),
        )
    )


def has_any(text: Column, words: Iterable[str]) -> Column:
    """Does the text contain any of the words, as substrings?"""
    words = list(words)
    if not words:
        return F.lit(False)
    hit = F.lit(False)
    for word in words:
        hit = hit | text.contains(word)
    return hit


def first_pattern(text: Column, rules: Sequence[tuple]) -> Column:
    """Label of the first rule whose pattern occurs in the text."""
    chain = None
    for label, pattern in rules:
        hit = text.rlike(pattern)
        chain = F.when(hit, label) if chain is None else chain.when(hit, label)
    return chain


def first_words(text: Column, rules: Sequence[tuple], default: str | None = None) -> Column:
    """Value of the first rule ``(value, any_of, none_of)`` that fires on substrings."""
    chain = None
    for value, any_of, none_of in rules:
        hit = has_any(text, any_of) & ~has_any(text, none_of)
        chain = F.when(hit, value) if chain is None else chain.when(hit, value)
    return chain.otherwise(F.lit(default))
