"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a regular expression over host and path with the literal tokens that any match must
contain whole. Each rule is filed under the one of its tokens that is rarest among the URLs at
hand. The tokens of a URL fetch candidate rules by an equality join, and only these run their
expression. Only DataFrame functions are used.
"""

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgauge.llm.common import ascii_lower, table

#: fixed values: rules on a host, its subdomains and a path prefix; the longest that fits wins
HOST_RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
              ("allow", "com/fr/"), ("block", "com/de/"))
#: fixed values: patterns that speak where no host rule fits; ^ is a separator or an end
PATTERN_RULES = (("block", "^casino^"), ("block", "^bets^"), ("block", "^pills^"), ("block", "^porn^"),
                 ("block", "^xxx^"), ("block", "^viagra^"), ("block", "^escort^"), ("block", "^torrent^"),
                 ("block", "^warez^"), ("block", "^adult^"), ("block", "^ads^track^"), ("allow", "^casino^history^"))
DEFAULT_VERDICT = "allow"

_SEPARATOR = r"(?:^|$|[^A-Za-z0-9])"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) after the first ://, and path up to ? or #; both empty without ://."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def compile_host_rule(action: str, rule: str) -> tuple:
    """(kind, action, rule, expression, whole literal tokens, length). The last token counts only
    if a separator follows it, since a path rule may end inside a token."""
    host, slash, rest = rule.partition("/")
    whole = re.findall(r"[A-Za-z0-9]+", host) + re.findall(r"[A-Za-z0-9]+(?=[^A-Za-z0-9])", rest)
    expression = r"^(?:[^/]*\.)?" + re.escape(host) + (re.escape("/" + rest) if slash else r"(?=/|$)")
    return "host", action, rule, expression, sorted({t.lower() for t in whole}), len(rule)


def compile_pattern(action: str, pattern: str) -> tuple:
    """As above for a pattern with ^ for separators and * for anything; case does not count."""
    parts = [_SEPARATOR if c == "^" else ".*" if c == "*" else re.escape(c) for c in pattern]
    whole = re.findall(r"(?<=[^A-Za-z0-9*])[A-Za-z0-9]+(?=[^A-Za-z0-9*])", pattern)
    return "pattern", action, pattern, "(?is)" + "".join(parts), sorted({t.lower() for t in whole}), len(pattern)


def rule_table(spark: SparkSession, host_rules=HOST_RULES, patterns=PATTERN_RULES) -> DataFrame:
    """Columns kind, action, rule, expression, tokens, length; as many rows as rules are given."""
    rules = [compile_host_rule(*r) for r in host_rules] + [compile_pattern(*p) for p in patterns]
    made = [F.struct(F.lit(k).alias("kind"), F.lit(a).alias("action"), F.lit(r).alias("rule"),
                     F.lit(x).alias("expression"),
                     F.array(*[F.lit(t) for t in tokens]).cast("array<string>").alias("tokens"),
                     F.lit(n).alias("length")) for k, a, r, x, tokens, n in rules]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*made)))


def _tokens(target: Column) -> Column:
    """Distinct lower-cased tokens, and the empty token under which rules without a token are filed."""
    return F.array_distinct(F.concat(F.split(F.lower(target), "[^a-z0-9]+"), F.array(F.lit(""))))


def judge(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """``urls`` with host, path, rule, pattern and verdict (existing columns of these names are
    replaced).

    rule: the longest host rule that fits, else null; of equally long ones the first by text.
    verdict: that rule's action; without one ``block`` if a block pattern fits and no allow
    pattern does, else ``allow``. A null URL or one without :// has empty host and path and takes
    the default. Repeated rows are judged once and all kept; an empty table gives an empty table.
    Every distinct host and path is looked up once, so a hot URL or host adds no join rows.
    """
    own = ("host", "path", "rule", "pattern", "verdict")
    host, path = host_and_path(F.col(f"`{url}`"))
    rows = urls.select(*[F.col(f"`{c}`") for c in urls.columns if c not in own or c == url],
                       host.alias("_host"), path.alias("_path"))
    targets = rows.select(F.concat("_host", "_path").alias("_target")).where("_target != ''").distinct()
    pieces = targets.select("_target", F.explode(_tokens(F.col("_target"))).alias("token"))

    wanted = rules.select("rule", "kind", F.explode_outer("tokens").alias("token")).withColumn(
        "token", F.coalesce("token", F.lit("")))
    seen = pieces.join(wanted.select("token").distinct(), "token", "left_semi").groupBy("token").agg(
        F.count("*").alias("n"))
    rarest = wanted.join(seen, "token", "left").groupBy("kind", "rule").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token"))["token"].alias("token"))
    index = rules.drop("tokens").join(rarest, ["kind", "rule"])

    fits = pieces.join(index, "token").where(F.rlike(F.col("_target"), F.col("expression")))
    found = fits.groupBy("_target").agg(
        F.min(F.when(F.col("kind") == "host", F.struct((-F.col("length")).alias("l"), "rule", "action"))).alias("_best"),
        F.min(F.when(F.col("kind") == "pattern", F.struct("action", "rule"))).alias("_pattern"))
    out = rows.withColumn("_target", F.concat("_host", "_path")).join(found, "_target", "left")
    kept = [F.col(f"`{c}`") for c in rows.columns if c not in ("_host", "_path")]
    return out.select(*kept, F.col("_host").alias("host"), F.col("_path").alias("path"),
                      F.col("_best.rule").alias("rule"), F.col("_pattern.rule").alias("pattern"),
                      F.coalesce("_best.action", "_pattern.action", F.lit(DEFAULT_VERDICT)).alias("verdict"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, rule_table(spark)).select("page_id", "host", "path", "rule", "pattern", "verdict")


def _oracle() -> str:
    arms = []
    for action, pattern in sorted(PATTERN_RULES, key=lambda p: (p[0], p[1])):
        expression = "".join("(^|$|[^A-Za-z0-9])" if c == "^" else c for c in pattern)
        arms.append(f"WHEN regexp_matches(host || path, '{expression}', 'is') THEN '{{{action}|{pattern}}}'")
    chosen = " ".join(a.replace("{", "").replace("}", "") for a in arms)
    rules = sorted(HOST_RULES, key=lambda r: -len(r[1]))
    fits = []
    for action, rule in rules:
        host, _, rest = rule.partition("/")
        fits.append(f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{rest}') THEN '{action}|{rule}'")
    return f"""
WITH rests AS (SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM rests),
hits AS (SELECT *, CASE {" ".join(fits)} END AS fit, CASE {chosen} END AS said FROM parts)
SELECT page_id, host, path, split_part(fit, '|', 2) AS rule, split_part(said, '|', 2) AS pattern,
  coalesce(split_part(fit, '|', 1), split_part(said, '|', 1), 'allow') AS verdict FROM hits"""


ORACLE = _oracle()
