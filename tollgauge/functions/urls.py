"""Hosts, paths and client names."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def host_of(url: Column, variant: str = "hostname") -> Column:
    """Host of a URL. Variants: ``hostname`` (lower, no port), ``netloc`` (port kept,
    http only), ``stripped`` (scheme removed, cut at the first slash, lower) and
    ``dotless`` (hostname without leading dots)."""
    if variant == "netloc":
        return F.when(url.startswith("http"), F.coalesce(_authority(url), F.lit(""))).otherwise("")
    if variant == "stripped":
        bare = F.replace(F.replace(url, F.lit("https://"), F.lit("")), F.lit("http://"), F.lit(""))
        return F.coalesce(F.lower(F.trim(F.split_part(bare, F.lit("/"), F.lit(1)))), F.lit(""))
    name = F.coalesce(F.lower(F.try_parse_url(url, F.lit("HOST"))), F.lit(""))
    if variant == "dotless":
        return F.regexp_replace(name, r"^\.+", "")
    return name


def _authority(url: Column) -> Column:
    return F.try_parse_url(url, F.lit("AUTHORITY"))


def url_path(url: Column) -> Column:
    return F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit(""))


def norm_host(value: Column) -> Column:
    """Lookup key of a URL or bare host: trimmed, lower, no leading ``www.``, no path."""
    text = F.lower(F.trim(F.coalesce(value, F.lit(""))))
    bare = F.when(
        text.rlike("^https?://"), F.coalesce(F.try_parse_url(text, F.lit("HOST")), text)
    ).otherwise(text)
    return F.split_part(F.regexp_replace(bare, r"^www\.", ""), F.lit("/"), F.lit(1))


def is_host(name: Column) -> Column:
    return F.coalesce(name.contains(".") & ~name.contains(" "), F.lit(False))


def client_token(user_agent: Column) -> Column:
    """Software family of a caller: first token of the agent string, at most 24 chars."""
    first = F.lower(F.split(F.trim(F.coalesce(user_agent, F.lit(""))), r"[\s/]")[0])
    token = F.substring(F.regexp_replace(first, "[^a-z0-9._-]", ""), 1, 24)
    return F.coalesce(F.nullif(token, F.lit("")), F.lit("unknown"))


def last_path_word(url: Column) -> Column:
    no_query = F.rtrim(F.split_part(F.lower(url), F.lit("?"), F.lit(1)), F.lit("/"))
    return F.element_at(F.split(no_query, "/"), -1)
