"""Registered queries: listings, topics, snapshots and arrivals."""

from pyspark.sql import functions as F

from tollgauge import fixed_values as fixed
from tollgauge.functions import text as text_fn
from tollgauge.functions import urls as url_fn
from tollgauge.functions.chain import chain_name
from tollgauge.functions.numbers import days_since
from tollgauge.operators import accuracy, changes, ranks, registry
from tollgauge.plans.inputs import AS_OF, CUR_DATE, PREV_DATE, Tables
from tollgauge.plans.money_queries import board_of
from tollgauge.plans.oracle_parts import any_of
from tollgauge.plans.registry import query


def _sql(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# ---- urls, hosts, names -------------------------------------------------------------------
@query("host_variants", "", """
    select page_id, lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)) as hostname,
      regexp_extract(url, '^https?://([^/?#]+)', 1) as netloc,
      lower(split_part(replace(replace(url, 'https://', ''), 'http://', ''), '/', 1)) as stripped,
      ltrim(lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)), '.') as dotless,
      regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) as path from pages""")
def _(t):
    return t("pages").select("page_id", *[
        url_fn.host_of(F.col("url"), v).alias(v) for v in ("hostname", "netloc", "stripped", "dotless")],
        url_fn.url_path(F.col("url")).alias("path"))


@query("norm_host", "", """
    select page_id, regexp_replace(lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)), '^www\\.', '') as from_url,
      split_part(lower(regexp_replace(url, '^https?://', '')), '/', 1) as from_bare from pages""")
def _(t):
    bare = F.concat(F.lit("  www."), F.regexp_replace("url", "^https?://", ""), F.lit(" "))
    return t("pages").select("page_id", url_fn.norm_host(F.col("url")).alias("from_url"),
                             url_fn.norm_host(bare).alias("from_bare"))


@query("is_host", "posts", """
    select id, contains(service, '.') and not contains(service, ' ') as host_like,
      contains(title, '.') and not contains(title, ' ') as title_like from posts""")
def _(t):
    return t("posts").select("id", url_fn.is_host(F.col("service")).alias("host_like"),
                             url_fn.is_host(F.col("title")).alias("title_like"))


@query("client_token", "", """
    select event_id, case when user_id % 7 = 0 then 'unknown' else
      substr(regexp_replace(lower(event_type || '_' || user_id % 50), '[^a-z0-9._-]', '', 'g'), 1, 24) end as client from events""")
def _(t):
    agent = F.when(F.col("user_id") % 7 == 0, F.lit(" ")).otherwise(F.concat(
        F.lit(" "), F.upper("event_type"), F.lit("_!"), (F.col("user_id") % 50).cast("string"),
        F.lit("/1.2 (x; y)")))
    return t("events").select("event_id", url_fn.client_token(agent).alias("client"))


@query("chain_name", "", """
    select p_partkey, case p_size % 6 when 0 then 'Base' when 1 then 'Solana' when 2 then 'Polygon' when 3 then 'an unnamed chain'
      when 4 then 'eip155:' || p_partkey + 100000 else 'BNB Chain' end as chain from part""")
def _(t):
    net = (F.when(F.col("p_size") % 6 == 0, "EIP155:8453").when(F.col("p_size") % 6 == 1, "solana:main")
           .when(F.col("p_size") % 6 == 2, "eip155:137").when(F.col("p_size") % 6 == 3, "")
           .when(F.col("p_size") % 6 == 4, F.concat(F.lit("eip155:"), (F.col("p_partkey") + 100000).cast("string")))
           .otherwise("eip155:56"))
    return t("part").select("p_partkey", chain_name(net).alias("chain"))


@query("trim_to", "", "select doc_id, substr(text, 1, 200) as head from documents")
def _(t):
    return t("documents").select("doc_id", text_fn.trim_to(F.col("text"), 200).alias("head"))


@query("clean_text", "", """
    select doc_id, case when length(x) > 180 then regexp_replace(substr(x, 1, 180), ' [^ ]*$', '') || '...' else x end as line
    from (select doc_id, trim(split_part(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' Visit https://', 1)) as x from documents)""")
def _(t):
    # a walkthrough marker is appended, which the clean-up has to drop again
    said = F.concat("text", F.lit(" | Step 1 call it"))
    return t("documents").where("length(trim(text)) > 0").select(
        "doc_id", text_fn.clean_text(said).alias("line")).unionByName(
        t("documents").where("length(trim(text)) = 0").select("doc_id", F.lit("").alias("line")))


@query("slug", "", """
    select doc_id, array_to_string(list_slice(string_split(trim(regexp_replace(lower(source || ' ' || lang || ' -- Report No. ' || doc_id || '!'), '[^a-z0-9]+', '-', 'g'), '-'), '-'), 1, 5), '-') as slug
    from documents""")
def _(t):
    title = F.concat_ws(" ", "source", "lang", F.lit("-- Report No."), F.concat(
        F.col("doc_id").cast("string"), F.lit("!")))
    return t("documents").select("doc_id", text_fn.slug(title).alias("slug"))


@query("parse_pairs", "readings", """
    select date, split_part(referrer_text, ',', 1) as first_pair,
      cast(regexp_extract(referrer_text, 'search=([0-9]+)', 1) as bigint) as search, cast(regexp_extract(referrer_text, 'mail=([0-9]+)', 1) as bigint) as mail from readings""")
def _(t):
    m = text_fn.parse_pairs(F.col("referrer_text"))
    return t("readings").select(
        "date", F.concat(F.lit("search="), m["search"]).alias("first_pair"),
        m["search"].try_cast("bigint").alias("search"), m["mail"].try_cast("bigint").alias("mail"))


@query("days_since", "snapshots", f"""
    select url, date, date_diff('day', last_day::date, date '{AS_OF}') as age, 999::bigint as bad from snapshots""")
def _(t):
    return t.index().select("url", "date", days_since(F.col("last_day"), AS_OF).alias("age"),
                            days_since(F.concat(F.lit("n/a "), "last_day"), AS_OF).alias("bad"))


# ---- listings -------------------------------------------------------------------------------
@query("cheapest_price", "listing_prices", "select resource, price from listing_prices")
def _(t):
    return registry.cheapest_price(t.listings()).select("resource", "price")


@query("advertised_price", "listing_docs", """
    select resource, case page_id % 4 when 0 then a / 1e6 when 1 then a * 2 / 1e6 when 2 then (a + 500) / 1e6 else floor(a / 2) / 1e6 end as adv_amount,
      case page_id % 4 when 1 then 'solana:mainnet' when 3 then 'eip155:137' else 'eip155:8453' end as adv_network from listing_docs""")
def _(t):
    return registry.advertised_price(t.listings()).select("resource", "adv_amount", "adv_network")


@query("contract", "listing_docs", """
    select resource, case when ok then (case page_id % 3 when 0 then 'GET' else 'POST' end) end as method,
      case when ok then case page_id % 6 when 0 then 'price|symbol' when 1 then 'change|price|ts' when 2 then 'balance' else 'a|b' end end as expect
    from (select *, page_id % 6 not in (4, 5) and page_id % 3 <> 2 as ok from listing_docs)""")
def _(t):
    return registry.contract(t.listings()).select("resource", "method", "expect")


@query("declared_call", "listing_docs", """
    select resource, case page_id % 3 when 0 then 'GET' else 'POST' end as call_method,
      case when page_id % 7 = 0 then 0 else (page_id * 37) % 900 end as calls30d, case when page_id % 7 = 0 then 0 else (page_id * 13) % 40 end as payers30d
    from listing_docs""")
def _(t):
    return registry.declared_call(t.listings()).select("resource", "call_method", "calls30d", "payers30d")


@query("parse_declared", "", """
    select 'o' || o_orderkey as origin, case o_orderkey % 5 when 0 then 'POST' when 3 then 'PUT' else 'GET' end as method,
      case o_orderkey % 5 when 0 then '/api/v' || o_custkey when 1 then 'bare/' || o_custkey else '/obj/' || o_custkey end as path,
      'https://o' || o_orderkey || '.example.com' || case o_orderkey % 5 when 0 then '/api/v' || o_custkey when 1 then '/bare/' || o_custkey else '/obj/' || o_custkey end as url
    from orders where o_orderkey % 5 not in (2, 4)""")
def _(t):
    k = F.col("o_custkey").cast("string")
    entry = (F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lit("POST /api/v"), k))
             .when(F.col("o_orderkey") % 5 == 1, F.concat(F.lit("bare/"), k))
             .when(F.col("o_orderkey") % 5 == 2, F.concat(F.lit("GET /users/{id}/"), k))
             .when(F.col("o_orderkey") % 5 == 3, F.concat(F.lit('{"path":"/obj/'), k, F.lit('","method":"put"}')))
             .otherwise(F.concat(F.lit("/v1/items/:id"), k)))
    host = F.concat(F.lit("o"), F.col("o_orderkey").cast("string"))
    docs = t("orders").select(F.concat(host, F.lit(".example.com")).alias("origin"), entry.alias("entry"))
    return registry.parse_declared(docs).withColumn(
        "origin", F.split_part("origin", F.lit("."), F.lit(1)))


@query("index_of", "listing_docs", """
    select resource as url, regexp_extract(resource, '^https?://([^/?#]+)', 1) as host,
      case when page_id % 9 = 0 then '' else 'Service ' || page_id % 50 end as service, descr,
      case page_id % 4 when 0 then a::varchar when 1 then (a * 2)::varchar when 2 then (a * 1000000)::varchar else 'abc' end as amount,
      case when page_id % 4 in (0, 3) then 1 else 2 end + (page_id % 4 = 3)::int as n_options,
      case when page_id % 5 = 0 then null else substr(sha256('{"a":' || page_id % 30 || ',"z":1}'), 1, 12) end as schema_fp
    from listing_docs""")
def _(t):
    return registry.index_of(t.listings()).select(
        "url", "host", "service", "descr", "amount", F.size("options").alias("n_options"), "schema_fp")


@query("schema_store", "listing_docs", """
    select distinct substr(sha256('{"a":' || page_id % 30 || ',"z":1}'), 1, 12) as fp, '{"a":' || page_id % 30 || ',"z":1}' as schema
    from listing_docs where page_id % 5 <> 0 and (page_id % 30) <> 7""")
def _(t):
    stored = t.spark.range(1).select(registry.schema_fingerprint(F.lit('{"z":1,"a":7}')).alias("fp"))
    return registry.update_schema_store(stored, t.listings())


@query("valid_listings", "listing_prices", """
    select resource, price from listing_prices where page_id % 6 not in (4, 5) and page_id % 3 <> 2 and price > 0 and price <= 0.01""")
def _(t):
    return registry.valid_listings(t.listings(), 0.01).select("resource", "price")


_BLOB = "lower(resource || ' ' || descr)"
_SELECT = " union all ".join(
    f"select '{name}' as selector, resource from listing_docs where "
    + " and ".join(any_of(_BLOB, g) for g in rule["all"])
    + f" and not {any_of(_BLOB, rule['none'])}" for name, rule in fixed.SELECTORS.items())


@query("select_by_words", "listing_docs", _SELECT)
def _(t):
    out = None
    for name, rule in fixed.SELECTORS.items():
        part = registry.select_by_words(t.listings(), rule["all"], rule["none"]).select(
            F.lit(name).alias("selector"), "resource")
        out = part if out is None else out.unionByName(part)
    return out


@query("drop_other_ticker", "", """
    select p_partkey, url from (select p_partkey, 'https://x.example.com/stock/' || case p_partkey % 4 when 0 then 'AAPL' when 1 then 'quote'
        when 2 then lower(p_type) else 'msft' end || '?v=1' as url, p_partkey % 4 as k, lower(p_type) as ty from part)
    where not (k = 3 or (k = 2 and length(ty) between 2 and 5))""")
def _(t):
    word = (F.when(F.col("p_partkey") % 4 == 0, "AAPL").when(F.col("p_partkey") % 4 == 1, "quote")
            .when(F.col("p_partkey") % 4 == 2, F.lower("p_type")).otherwise("msft"))
    rows = t("part").select("p_partkey", F.concat(
        F.lit("https://x.example.com/stock/"), word, F.lit("?v=1")).alias("resource"))
    return registry.drop_other_ticker(rows, "aapl").select("p_partkey", F.col("resource").alias("url"))


@query("first_per_host", "listing_prices", """
    select host, arg_min(resource, ordinal) as resource, min(ordinal) as ordinal from listing_prices group by host""")
def _(t):
    return ranks.first_per(t.listings().select("host", "ordinal", "resource"), ["host"], F.col("ordinal"))


@query("within_budget", "listing_prices", """
    select url, price from (select resource as url, price, sum(price::decimal(28, 8)) over (order by price, md5(resource), resource rows unbounded preceding) as spent
      from listing_prices where page_id % 6 not in (4, 5) and page_id % 3 <> 2 and price > 0 and price <= 0.01) where spent <= 0.05""")
def _(t):
    rows = registry.valid_listings(t.listings(), 0.01).select(F.col("resource").alias("url"), "price")
    return registry.within_budget(rows, 0.05)


@query("budget_of_checks", "checks", """
    select origin, url, price from (select origin, url, adv_amount as price, sum(adv_amount::decimal(28, 8)) over (order by adv_amount::decimal(28, 8), md5(url), url rows unbounded preceding) as spent
      from checks where adv_amount is not null) where spent <= 250""")
def _(t):
    rows = t("checks").where("adv_amount IS NOT NULL").select("origin", "url", F.col("adv_amount").alias("price"))
    return registry.within_budget(rows, 250.0)


_CAT = "case " + " ".join(
    f"when {any_of('b', pos)} and not {any_of('b', neg)} then '{name}'" for name, _, pos, neg in fixed.CATEGORY_RULES
) + " else 'other' end"
_SRC = "case " + " ".join(
    f"when {any_of('b', pos)} and not {any_of('b', neg)} then {_sql(src) if src else 'null'}" for _, src, pos, neg in fixed.CATEGORY_RULES
) + " end"
_CATMAP = f"""
    with c as (select *, {_CAT} as category, {_SRC} as accuracy_source, page_id % 6 not in (4, 5) and page_id % 3 <> 2 as has_schema
        from (select *, lower(resource || ' ' || descr || ' ' || tag) as b from listing_prices)),
      m as (select host, category, arg_min(resource, ordinal) as url, arg_min(price, ordinal) as price0, min(ordinal) as ordinal from c group by host, category),
      s as (select c.host, c.category, c.accuracy_source, c.resource as url, c.price, c.has_schema, substr(c.descr, 1, 80) as descr, c.ordinal
        from c join m on c.host = m.host and c.category = m.category and c.ordinal = m.ordinal)"""


@query("category_map", "listing_prices", _CATMAP + "select * from s")
def _(t):
    return registry.category_map(t.listings())


@query("category_coverage", "listing_prices", _CATMAP + """
    select category, accuracy_source, count(*) as sellers, count(*) filter (has_schema) as with_schema,
      sum(least(coalesce(price, 0), 0.02)::decimal(28, 8))::double as sweep_cost from s group by category, accuracy_source""")
def _(t):
    return registry.category_coverage(registry.category_map(t.listings()))


@query("category_sellers", "listing_prices", _CATMAP + "select host, url, price from s where category = 'weather' and price > 0 and price <= 0.015")
def _(t):
    return registry.category_sellers(registry.category_map(t.listings()), "weather", 0.015).select("host", "url", "price")


@query("registry_categories", "listing_docs", """
    select case page_id % 4 when 0 then 'Data' when 1 then 'Tools' when 2 then 'AI' else 'UNCATEGORISED' end as category, count(*) as n from listing_docs group by 1""")
def _(t):
    return registry.registry_categories(t.listings())


@query("host_category", "listing_docs", """
    select host, 'prov' || p % 6 as provider, case p % 4 when 0 then 'Data' when 1 then 'Tools' when 2 then 'AI' else 'UNCATEGORISED' end as category
    from (select regexp_extract(resource, '^https?://([^/?#]+)', 1) as host, min(page_id) as p from listing_docs group by 1)""")
def _(t):
    return registry.host_category(t.listings())


_TOPIC = "case " + " ".join(f"when regexp_matches(x, {_sql(pat)}) then {_sql(name)}" for name, pat in fixed.TOPIC_RULES) + " end"
_TOPICS = f"""
    with l as (select host, resource, price, {_TOPIC} as topic from (select *, lower(descr || ' ' || resource) as x from listing_prices)),
      tl as (select * from l where topic is not null and price is not null),
      off as (select topic, host, min(price) as price, count(*) as n from tl group by topic, host),
      br as (select topic, count(*) as b from off group by topic),
      pri as (select host, arg_min(topic, (-n, b, topic)) as topic from off join br using (topic) group by host)"""


@query("topic_of_listings", "listing_prices", _TOPICS + "select host, topic, resource as url, price from tl")
def _(t):
    return registry.topic_listings(t.listings())


@query("topic_of_documents", "", f"select doc_id, {_TOPIC} as topic from (select doc_id, lower(text) as x from documents)")
def _(t):
    return t("documents").select("doc_id", registry.topic_of(F.col("text")).alias("topic"))


@query("primary_topic", "listing_prices", _TOPICS + "select host, topic from pri")
def _(t):
    return registry.primary_topic(registry.topic_listings(t.listings()))


_MARKET = _TOPICS + """,
      own as (select address, arg_min(host, (ordinal, pos)) as lhost from (
        select ordinal, host, generate_subscripts(o, 1) as pos, lower(json_extract_string(unnest(o), '$.payTo')) as address
        from (select ordinal, host, from_json(json_extract(doc, '$.accepts'), '["JSON"]') as o from listing_prices)) where address <> '' group by address),
      hm as (select lhost as host, sum(usdc::decimal(28, 4)) as money, arg_max(organic_score, (-usdc, b.address)) as s0, arg_max(payers, (-usdc, b.address)) as payers,
          arg_max(circular, (-usdc, b.address)) as circular, arg_max(demand, (-usdc, b.address)) as demand, max((-usdc, b.address)) as k from board7 b join own using (address) group by lhost),
      hm2 as (select hm.* exclude (s0), b.organic_score as s from hm join own on own.lhost = hm.host join board7 b on b.address = own.address and (-b.usdc, b.address) = hm.k),
      dd as (select p.topic, count(*) as primary_sellers, coalesce(sum(money), 0)::double as usdc_30d, count(*) filter (money > 0) as earning_sellers,
          coalesce(sum(payers), 0)::bigint as buyers, count(*) filter (coalesce(s, 0) >= 60 and not circular) as real_sellers, median(s::double) as median_ods
        from pri p left join hm2 using (host) group by p.topic),
      pos as (select topic, min(price) as cheapest, max(price) as dearest, median(price) as median, list_sort(list(price)) as ps, count(*) as np from off where price > 0 group by topic),
      q as (select *, case when np >= 10 then ps[greatest(0, floor(np * 0.1)::bigint - 1) + 1] else ps[1] end as p10,
          case when np >= 10 then ps[least(np - 1, floor(np * 0.9)::bigint) + 1] else ps[np] end as p90 from pos),
      su as (select topic, count(*) as sellers, sum(n)::bigint as endpoints from off group by topic),
      market as (select q.topic, sellers, coalesce(primary_sellers, 0) as primary_sellers, endpoints, cheapest, dearest, p10, p90, p90 / p10 as spread, median,
          coalesce(usdc_30d, 0.0) as usdc_30d, coalesce(earning_sellers, 0) as earning_sellers, coalesce(buyers, 0) as buyers, coalesce(real_sellers, 0) as real_sellers, median_ods
        from q join su using (topic) left join dd using (topic))"""


def listing_board(t: Tables):
    """The board with listing hosts as owners of the wallets."""
    from tollgauge.operators.flows import payto_owner
    rows = board_of(t, 7).drop("host").join(payto_owner(t.listings()), "address")
    return rows


@query("topic_market", "listing_prices board7", _MARKET + "select * from market")
def _(t):
    return registry.topic_market(t.listings(), listing_board(t))


@query("topic_rank", "listing_prices board7", _MARKET + "select topic, real_sellers, buyers, usdc_30d from market where sellers >= 3")
def _(t):
    return registry.topic_rank(registry.topic_market(t.listings(), listing_board(t)), 3).select(
        "topic", "real_sellers", "buyers", "usdc_30d")


@query("topic_detail", "listing_prices board7", _MARKET + """
    select o.host, o.price as cheapest, coalesce(money, 0)::double as usdc_30d, demand from off o left join hm using (host) where topic = 'weather' and price > 0""")
def _(t):
    return registry.topic_detail(t.listings(), listing_board(t), "weather")


_FREE = "case " + " ".join(f"when {any_of('x', words)} then {_sql(label)}" for words, label, _ in fixed.FREE_DATA_RULES) + " end"


@query("free_category", "listing_docs", f"select resource, {_FREE} as label from (select resource, lower(descr) as x from listing_docs)")
def _(t):
    return t.listings().select("resource", registry.free_category(F.col("description"))["label"].alias("label"))


@query("origin_rollup", "listing_docs", """
    select regexp_extract(resource, '^https?://([^/?#]+)', 1) as origin, count(*) as breadth,
      sum(case when page_id % 7 = 0 then 0 else (page_id * 37) % 900 end)::bigint as calls30d, max(case when page_id % 7 = 0 then 0 else (page_id * 13) % 40 end) as payers30d,
      max(case when page_id % 7 = 0 then null else '2026-07-' || lpad((page_id % 28 + 1)::varchar, 2, '0') || 'T06:00:00Z' end) as last_called from listing_docs group by 1""")
def _(t):
    return registry.origin_rollup(t.listings())


@query("sample_listings", "listing_docs", """
    select resource, host from (select resource, regexp_extract(resource, '^https?://([^/?#]+)', 1) as host,
      row_number() over (partition by regexp_extract(resource, '^https?://([^/?#]+)', 1) order by case when page_id % 7 = 0 then 0 else (page_id * 37) % 900 end desc, ordinal) as rn
      from listing_docs) where rn <= 4""")
def _(t):
    return registry.sample_listings(t.listings(), 4).select("resource", "host")


@query("tracked_wallets", "listing_prices", """
    select 'Sol' || wk as wallet, arg_max(host, ordinal) as host from listing_prices where page_id % 4 = 1
      and (host like 'm.%' or host like '%.net' or host like '%.org') group by 1""")
def _(t):
    ranked = t.listings().where(F.col("host").endswith(".net") | F.col("host").startswith("m.")).select("host")
    graded = t.listings().select(F.when(F.col("host").endswith(".org"), "B").alias("grade"), F.col("host").alias("service"))
    return registry.tracked_wallets(t.listings(), ranked, graded, "solana")


@query("registry_overlap", "registry_a registry_b", """
    select class, count(*) as urls, count(distinct regexp_extract(url, '^https?://([^/?#]+)', 1)) as hosts from (
      select coalesce(a.resource, b.resource) as url, case when a.resource is null then 'second only' when b.resource is null then 'first only' else 'both' end as class
      from (select distinct resource from registry_a) a full join (select distinct resource from registry_b) b on a.resource = b.resource) group by class""")
def _(t):
    return registry.registry_overlap(t("registry_a"), t("registry_b"))


@query("price_range", "checks", """
    select origin, min(p) as lo, max(p) as hi from (select origin, coalesce(nullif(live_amount, 0), nullif(adv_amount, 0)) as p from checks) where p is not null group by origin""")
def _(t):
    return registry.price_range(t("checks"), "origin", "live_amount", "adv_amount")


@query("touched_on", "listing_docs", """
    select regexp_extract(resource, '^https?://([^/?#]+)', 1) as host, count(*) as n from listing_docs where page_id % 5 = 2 group by 1""")
def _(t):
    return registry.touched_on(t.listings(), "2026-08-03")


@query("describe_services", "listing_docs", """
    with d as (select split_part(resource, '/', 3) as host, arg_min(x, ordinal) as x from (select resource, ordinal, trim(descr) as x from listing_docs) where x <> '' group by 1),
      own as (select distinct split_part(resource, '/', 3) as host from listing_docs where resource like 'https:%/en/%')
    select d.host, case when own.host is not null then 'We serve ' || d.host else
        case when length(y) > 180 then regexp_replace(substr(y, 1, 180), ' [^ ]*$', '') || '...' else y end end as descr,
      case when own.host is not null then 'self' else 'registry' end as source
    from (select *, trim(regexp_replace(x, '\\s+', ' ', 'g')) as y from d) d left join own on own.host = d.host""")
def _(t):
    host = F.split_part("resource", F.lit("/"), F.lit(3))
    said = t.listings().where(F.col("resource").like("https:%/en/%")).select(
        host.alias("host")).distinct().withColumn("said", F.concat(F.lit("We  serve "), "host", F.lit(" ")))
    return registry.describe_services(t.listings().select(host.alias("host")), said, t.listings())


@query("listing_chains", "listing_docs", """
    select resource, case page_id % 4 when 0 then 'Base' when 1 then 'Base|Solana' when 2 then 'BNB Chain|Base' else 'Base|Polygon' end as chains from listing_docs""")
def _(t):
    return t.listings().select("resource", registry.listing_chains().alias("chains"))


# ---- snapshots ------------------------------------------------------------------------------
@query("latest_index", "snapshots", f"select url, amount, date from snapshots where date = '{PREV_DATE}'")
def _(t):
    return changes.latest_index(t.index(), "1998-06-30").select("url", "amount", "date")


_DIFF = f"""
    with p as (select * from snapshots where date = '{PREV_DATE}'), c as (select * from snapshots where date = '{CUR_DATE}'),
      d as (select coalesce(c.url, p.url) as url, coalesce(c.host, p.host) as host, p.amount as p_amount, c.amount as amount,
        case when p.url is null and c.host not in (select host from p) then 'new on new host' when p.url is null then 'new on known host'
          when c.url is null then 'gone' when c.amount <> p.amount then 'repriced' end as change
        from p full join c using (url))"""


@query("index_diff", "snapshots", _DIFF + "select * from d where change is not null")
def _(t):
    return changes.index_diff(t.index(PREV_DATE), t.index(CUR_DATE))


@query("diff_summary", "snapshots", _DIFF + "select change, count(*) as urls, count(distinct host) as hosts from d where change is not null group by change")
def _(t):
    return changes.diff_summary(changes.index_diff(t.index(PREV_DATE), t.index(CUR_DATE)))


def first_seen(t: Tables):
    empty = t.index().select("url", "date").where(F.lit(False))
    return changes.update_first_seen(empty, t.index(CUR_DATE), CUR_DATE, t.index(PREV_DATE), PREV_DATE)


@query("update_first_seen", "snapshots", """
    select url, least(min(date), case when length(url) % 2 = 0 then '1997-01-01' else '1999-06-30' end) as date from snapshots group by url""")
def _(t):
    known = t.index().select("url").distinct().withColumn(
        "date", F.when(F.length("url") % 2 == 0, "1997-01-01").otherwise("1999-06-30"))
    return changes.update_first_seen(known, t.index(CUR_DATE), CUR_DATE, t.index(PREV_DATE), PREV_DATE)


@query("host_first_seen", "snapshots", "select host, min(date) as date from snapshots group by host")
def _(t):
    return changes.host_first_seen(first_seen(t))


def endpoints(t: Tables):
    return changes.arrival_endpoints(t.index(CUR_DATE), first_seen(t), CUR_DATE)


def arrivals(t: Tables):
    return changes.arrivals(endpoints(t))


@query("arrival_endpoints", "arrivals", f"""
    select '{CUR_DATE}' as date, host, service, url, regexp_extract(url, '^https://[^/]+(.*)$', 1) as path, descr, amount, calls30d, new_service from arrivals""")
def _(t):
    return endpoints(t)


_ARR = f"""
    with g as (select host, count(*) as n_endpoints, arg_max(service, url) as service, max(calls30d) as calls30d, bool_and(new_service) as new_service,
        arg_min(url, (-calls30d, url)) as best_url, arg_min(descr, (-calls30d, url)) as best_descr from arrivals group by host),
      u as (select host, string_agg(w, '|' order by w) as unusual, count(*) as k from (select distinct host, unnest(regexp_extract_all(lower(descr), {_sql(fixed.CURIOUS_PATTERN)}, 0)) as w from arrivals) group by host),
      a as (select '{CUR_DATE}' as date, g.*, coalesce(unusual, '') as unusual, coalesce(k, 0) as k,
        case when new_service then 3.0 else 0.0 end + 2 + least(calls30d / 100, 3.0) + 1.5 * least(coalesce(k, 0), 3) + case when n_endpoints >= 5 then 1.0 else 0.0 end as score
        from g left join u using (host))"""


@query("arrivals", "arrivals", _ARR + "select date, host, service, n_endpoints, calls30d, new_service, unusual, best_url, best_descr from a")
def _(t):
    return arrivals(t).select("date", "host", "service", "n_endpoints", "calls30d", "new_service",
                              "unusual", "best_url", "best_descr")


@query("novelty", "arrivals", _ARR + """
    select host, score::double as score, concat_ws('|', case when new_service then 'new service, not another endpoint on a known one' end,
      'already taking paid calls (' || format('{:,}', calls30d) || ' in 30d)',
      case when k > 0 then 'sells something unusual: ' || array_to_string(list_slice(string_split(unusual, '|'), 1, 4), ', ') end,
      case when n_endpoints >= 5 then 'arrived with ' || n_endpoints || ' endpoints at once' end) as why from a""")
def _(t):
    return changes.novelty(arrivals(t)).select("host", "score", "why")


@query("top_arrivals", "arrivals", _ARR + "select host, score::double as score, best_url from a order by score desc, host limit 3")
def _(t):
    return changes.top_arrivals(arrivals(t), 3).select("host", "score", "best_url")


@query("rolling_newest", "arrivals", _ARR + """
    select date, host, n_endpoints from (select date, host, n_endpoints from a union all select '1998-11-30', 'old-' || host, n_endpoints from a) order by date desc, n_endpoints desc, host limit 150""")
def _(t):
    rows = arrivals(t).select("date", "host", "n_endpoints")
    old = rows.withColumn("date", F.lit("1998-11-30")).withColumn("host", F.concat(F.lit("old-"), "host"))
    stale = rows.withColumn("host", F.concat(F.lit("stale-"), "host"))
    return changes.rolling_newest(old.unionByName(stale), rows, CUR_DATE, 150)


@query("daily_brief", "arrivals", _ARR + f"""
    select '{CUR_DATE}' as date, '{PREV_DATE}' as since, sum(n_endpoints)::bigint as endpoints, count(*) as services, count(*) filter (new_service) as new_services from a""")
def _(t):
    return changes.daily_brief(arrivals(t), CUR_DATE, PREV_DATE)


@query("brief_bullets", "arrivals", _ARR + """
    select host, score::double as score, service || ' (' || host || ') — ' || rtrim(best_descr, ' .;-') || '.'
      || ' Already taking money: ' || format('{:,}', calls30d) || ' paid calls.' as line
    from (select * from a order by score desc, host limit 3)""")
def _(t):
    return changes.brief_bullets(arrivals(t), 3)


@query("day_brief", "arrivals board7", _ARR + """
    select 'money' as section, host, usdc as amount, settlements as calls, row_number() over (order by usdc desc, settlements desc, host) as rank
      from (select * from board7 where host <> '' order by usdc desc, host, address limit 8)
    union all select 'new', host, null, calls30d, row_number() over (order by calls30d desc, host) from (select * from a where new_service order by calls30d desc, host limit 5)""")
def _(t):
    return changes.day_brief(board_of(t, 7), arrivals(t))


@query("recheck_plan", "snapshots", f"""
    with s as (select url, amount::double / 1e8 as price from snapshots where date = '{CUR_DATE}'),
      l as (select url, last_day, amount::double / 1e8 as price from snapshots where date = '{PREV_DATE}'),
      j as (select s.url, s.price, l.url is null or abs(l.price - s.price) > 0.0002 as fresh, date_diff('day', last_day::date, date '{AS_OF}') as age0 from s left join l using (url))
    select url, price, case when fresh then 0 else 1 end::bigint as priority, case when fresh then null else age0 end as age from j where fresh or age0 >= 2000""")
def _(t):
    cur = t.index(CUR_DATE).select("url", (F.col("amount").cast("double") / 1e8).alias("price"))
    prev = t.index(PREV_DATE).select("url", F.col("last_day").alias("last_tested"),
                                     (F.col("amount").cast("double") / 1e8).alias("p"))
    # prices that moved less than the tolerance count as unchanged
    log = prev.join(cur, "url", "left").select("url", "last_tested", F.when(
        F.abs(F.col("p") - F.col("price")) > 0.0002, F.col("p")).otherwise(
        F.coalesce("price", "p")).alias("price"))
    return accuracy.recheck_plan(cur, log, AS_OF, 2000)


@query("recheck_counts", "snapshots", f"""
    with s as (select url, amount from snapshots where date = '{CUR_DATE}'), l as (select url, last_day, amount from snapshots where date = '{PREV_DATE}'),
      j as (select s.url, l.url is null or l.amount <> s.amount as fresh, date_diff('day', last_day::date, date '{AS_OF}') as age0 from s left join l using (url))
    select count(*) filter (fresh) as new_or_changed, count(*) filter (not fresh and age0 >= 2000) as stale, count(*) filter (not fresh and age0 < 2000) as skipped from j""")
def _(t):
    cur = t.index(CUR_DATE).select("url", F.col("amount").cast("double").alias("price"))
    log = t.index(PREV_DATE).select("url", F.col("last_day").alias("last_tested"),
                                    F.col("amount").cast("double").alias("price"))
    return accuracy.recheck_counts(cur, accuracy.recheck_plan(cur, log, AS_OF, 2000))


@query("upsert", "snapshots", f"""
    select url, amount, date from snapshots where date = '{CUR_DATE}'
    union all select url, amount, date from snapshots p where date = '{PREV_DATE}' and url not in (select url from snapshots where date = '{CUR_DATE}')""")
def _(t):
    cols = ("url", "amount", "date")
    return changes.upsert(t.index(PREV_DATE).select(*cols), t.index(CUR_DATE).select(*cols), ["url"])


@query("first_per_url", "snapshots", """
    select url, arg_min(amount, date) as amount from snapshots group by url""")
def _(t):
    rows = t.index().select("url", "amount", F.col("date").alias("file"), F.lit(0).alias("ordinal"))
    return changes.first_per_url(rows).select("url", "amount")
