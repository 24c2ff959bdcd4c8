"""Registered queries: ratings, verdicts, catalogue, questions, usage and streams."""

import uuid

from pyspark.sql import functions as F

from tollgauge import fixed_values as fixed
from tollgauge.functions.grades import grade_rank
from tollgauge.operators import accuracy, board, catalog, grams, ratings, receipts, usage, verdicts
from tollgauge.operators.ranks import first_per  # noqa: F401
from tollgauge.plans.check_queries import mart
from tollgauge.plans.inputs import Tables
from tollgauge.plans.ledger_queries import delivery, graded, graded_claims
from tollgauge.plans.marts import stored
from tollgauge.plans.money_queries import board_of, grade_text
from tollgauge.plans.oracle_parts import any_of, quoted
from tollgauge.plans.registry import query
from tollgauge.sources.storage import shared_folder
from tollgauge.streaming import streams

GRADES = quoted(fixed.GRADES)


# ---- ratings ------------------------------------------------------------------------------
@query("grade_rank", "posts", f"select id, (coalesce(nullif(list_position({GRADES}, upper(trim(grade))), 0), 14) - 1)::bigint as rank from posts")
def _(t):
    return t("posts").select("id", grade_rank(F.col("grade")).alias("rank"))


@query("grades_by_service", "graded_grades", "select service, grades, first_ordinal from graded_grades")
def _(t):
    return ratings.grades_by_service(t.posts()).select("service", grade_text().alias("grades"), "first_ordinal")


@query("rating_tally", "posts", """
    select count(*) as ratings, count(distinct service) as services, count(*) filter (call = 'Honest') as honest, count(*) filter (call <> 'Honest') as failed,
      count(*) filter (call is null and free) as free, count(*) filter (call is null and not free) as not_bought from posts where grade is not null and grade <> 'UNGRADED'""")
def _(t):
    return ratings.rating_tally(t.posts())


@query("grade_spread", "posts", f"""
    with g as (select id, service, grade, row_number() over (order by list_position({GRADES}, grade), md5(id::varchar), id) as rn, count(*) over () as n from posts where list_contains({GRADES}, grade))
    select case rn when 1 then 'best' when n then 'worst' else 'middle' end as pick, id, service, grade from g where rn in (1, n // 2 + 1, n)""")
def _(t):
    return ratings.grade_spread(t.posts())


@query("related_posts", "posts", """
    with p as (select id, service, list_distinct(string_split(tag_text, ',')) as tags from posts),
      r as (select a.id, b.id as related_id, row_number() over (partition by a.id order by case when a.service = b.service then 0 else 1 end, len(list_intersect(a.tags, b.tags)) desc, b.id) as rank
        from p a join p b on a.id <> b.id and (a.service = b.service or list_has_any(a.tags, b.tags)))
    select id, related_id, rank from r where rank <= 4""")
def _(t):
    return ratings.related(t.posts(), 4)


@query("related_notes", "posts notes", """
    with p as (select id, string_split(tag_text, ',') as tags from posts), n as (select note_id, ordinal, string_split(tag_text, ',') as tags from notes),
      h as (select p.id, n.note_id, row_number() over (partition by p.id order by n.ordinal) as rank from p join n on list_has_any(p.tags, n.tags)),
      f as (select note_id, row_number() over (order by ordinal) as rank from notes)
    select id, note_id, rank from h where rank <= 2
    union all select p.id, f.note_id, f.rank from p join f on f.rank <= 2 where p.id not in (select id from h)""")
def _(t):
    return ratings.related_notes(t.posts(), t.notes(), 2)


# ---- verdicts -----------------------------------------------------------------------------
def ledger(t: Tables):
    """Delivery and accuracy receipts in one shape."""
    one = delivery(t).select("receipt_id", "kind", "host", "status", "promised", "missing")
    none = F.array().cast("array<string>")
    two = receipts.receipts_from(graded_claims(t), "stock").select(
        "receipt_id", "kind", "host", "status", none.alias("promised"), none.alias("missing"))
    return one.unionByName(two)


def inputs(t: Tables):
    texts = t("origins").select(F.lower("origin").alias("host"), "text")
    return verdicts.preflight_inputs(mart(t), ledger(t), board_of(t, 30), texts)


def fresh_lights(t: Tables):
    return verdicts.verdict(inputs(t))


def lights(t: Tables):
    """Pre-payment verdicts as they are stored."""
    return stored(t, "preflight", lambda: fresh_lights(t))


_RF = """
    with led as (
        select host, 'delivery' as kind, status, len(want) as nf, case when missing = '' then 0 else len(string_split(missing, '|')) end as nm from settled
        union all select host, 'accuracy', case when value is null then 'inconclusive' when abs(dev) <= 500 then 'accurate' else 'off' end, 0, 0 from graded),
      rf as (select host, count(*) as receipts, count(*) filter (status = 'short') as disputes, count(*) filter (status = 'delivered') as delivered,
          count(*) filter (status = 'accurate') as accurate, count(*) filter (status = 'short' and nf >= 2 and nm = nf) as severe,
          min(nf) filter (status = 'short' and nf >= 2 and nm = nf) as severe_fields from led group by host)"""


@query("receipt_facts", "settled graded", _RF + "select host, receipts, disputes, delivered, accurate, severe from rf")
def _(t):
    return verdicts.receipt_facts(ledger(t)).select("host", "receipts", "disputes", "delivered", "accurate", "severe")


_IN = _RF + """,
      bd as (select lower(host) as host, arg_min(coalesce(payout_pct, -1), (-usdc, address)) as payout_pct, arg_min(coalesce(demand, ''), (-usdc, address)) as demand from board30 where host <> '' group by 1),
      i as (select host, price_ok, payto_ok, phantom, pf.host is not null as live, coalesce(receipts, 0) as receipts, coalesce(disputes, 0) as disputes,
          coalesce(delivered, 0) as delivered, coalesce(accurate, 0) as accurate, coalesce(severe, 0) as severe, severe_fields, nullif(payout_pct, -1) as payout_pct, nullif(demand, '') as demand, bd.host is not null as ranked
        from probe_flags pf full join rf using (host) full join bd using (host)),
      ii as (select i.*, o.text from i left join origins o on o.origin = i.host)"""
_NEEDS = "settled graded probe_flags board30 origins"


@query("preflight_inputs", _NEEDS, _IN + "select host, live as checked_live, receipts, payout_pct, demand, text from ii")
def _(t):
    return inputs(t).select("host", F.coalesce("checked_live", F.lit(False)).alias("checked_live"),
                            F.coalesce("receipts", F.lit(0)).alias("receipts"), "payout_pct", "demand", "text")


_FREE = "case " + " ".join(f"when {any_of('lower(text)', words)} then '{label}'" for words, label, _ in fixed.FREE_DATA_RULES) + " end"
_S = {k: v.replace("'", "''") for k, v in vars(fixed).items() if isinstance(v, str)}
_LIGHT = _IN + f""",
      fr as (select *, {_FREE} as free_label, (coalesce(live and not payto_ok, false)::int + coalesce(live and phantom, false)::int + (severe > 0)::int) as reds,
          (coalesce(live and not price_ok, false)::int + (disputes > 0 and severe = 0)::int) as yellows from ii),
      vd as (select host, case when not (live or receipts > 0 or ranked) then 'gray' when reds > 0 then 'red' when yellows > 0 then 'yellow' else 'green' end as light,
        greatest(0, 100 - 45 * reds - 20 * yellows)::bigint as score, live as checked_live, receipts, disputes, delivered, accurate, free_label,
        concat_ws('|', case when live and not payto_ok then 'red' end, case when live and phantom then 'red' end, case when severe > 0 then 'red' end,
          case when live and not price_ok then 'yellow' end, case when disputes > 0 and severe = 0 then 'yellow' end, case when delivered > 0 then 'good' end,
          case when accurate > 0 then 'good' end, case when live and payto_ok and price_ok and not phantom then 'good' end, case when free_label is not null then 'info' end,
          case when payout_pct >= 90 then 'info' end, case when demand = 'one wallet' then 'info' end, case when receipts = 0 then 'info' end) as levels,
        concat_ws('|', case when live and not payto_ok then '{_S['REASON_PAYTO']}' end, case when live and phantom then '{_S['REASON_PHANTOM']}' end,
          case when severe > 0 then 'Paid in full and returned none of its ' || severe_fields || ' promised fields, confirmed on two calls.' end,
          case when live and not price_ok then '{_S['REASON_PRICE']}' end) as first_texts from fr)"""


@query("verdict", _NEEDS, _LIGHT + "select host, light, score, checked_live, receipts, disputes, delivered, accurate, free_label, levels, first_texts from vd")
def _(t):
    hard = (fixed.REASON_PAYTO, fixed.REASON_PHANTOM, fixed.REASON_PRICE)
    told = F.filter("reasons", lambda r: r["text"].isin(*hard) | r["text"].startswith("Paid in full"))
    return fresh_lights(t).select(
        "host", "light", "score", "checked_live", "receipts", "disputes", "delivered", "accurate", "free_label",
        F.array_join(F.transform("reasons", lambda r: r["level"]), "|").alias("levels"),
        F.array_join(F.transform(told, lambda r: r["text"]), "|").alias("first_texts"))


@query("light_counts", _NEEDS, _LIGHT + "select light, count(*) as n, count(free_label) as free_alternative from vd group by light")
def _(t):
    return verdicts.light_counts(lights(t))


def asked(t: Tables):
    """Hosts somebody asks about: every order's host as a URL, and some unknown ones."""
    return t("orders").select(F.when(
        F.col("o_orderkey") % 3 == 0, F.concat(F.lit("https://www.api"), F.col("o_orderkey").cast("string"), F.lit(".example.com/v1?x=1")))
        .when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit("API"), F.col("o_orderkey").cast("string"), F.lit(".example.com")))
        .otherwise(F.concat(F.lit("unknown"), F.col("o_orderkey").cast("string"), F.lit(".example.org"))).alias("host"))


_ASK = "select case when o_orderkey % 3 < 2 then 'api' || o_orderkey || '.example.com' else 'unknown' || o_orderkey || '.example.org' end as host from orders"


@query("preflight", _NEEDS, _LIGHT + f"""
    select a.host, coalesce(light, 'gray') as light, case coalesce(light, 'gray') when 'green' then 'CLEAR' when 'yellow' then 'HOLD' when 'red' then 'ABORT' else 'UNRATED' end as verdict, score,
      case when light is null then '{_S['GATE_UNKNOWN']}' when light = 'green' and checked_live then '{_S['GATE_CHECKED']}'
        when light = 'green' and accurate + delivered > 0 then '{_S['GATE_MEASURED']}' when light = 'green' then '{_S['GATE_LITTLE']}'
        when light = 'yellow' then '{_S['GATE_HOLD']}' when light = 'red' then '{_S['GATE_ABORT']}' else '{_S['GATE_UNRATED']}' end as gate
    from (select distinct host from ({_ASK})) a left join vd using (host)""")
def _(t):
    return catalog.preflight(lights(t), asked(t)).select("host", "light", "verdict", "score", "gate")


@query("payment_safety", "probe_mart board30", f"""
    with bd as (select lower(host) as host, arg_min(coalesce(payout_pct, -1), (-usdc, address)) as payout_pct, arg_min(coalesce(demand, ''), (-usdc, address)) as demand from board30 where host <> '' group by 1)
    select a.host, p.host is not null as checked_live, (p.host is null)::bigint + coalesce(not payto_ok, false)::bigint + coalesce(not price_ok, false)::bigint + coalesce(phantom, false)::bigint
      + coalesce(returns_402 < checked, false)::bigint + coalesce(payout_pct >= 90, false)::bigint + coalesce(demand = 'one wallet', false)::bigint as warnings,
      coalesce(not payto_ok, false) as critical
    from (select distinct host from ({_ASK})) a left join probe_mart p using (host) left join bd using (host)""")
def _(t):
    told = catalog.payment_safety(mart(t), board_of(t, 30), asked(t))
    return told.select("host", "checked_live", F.size("warnings").alias("warnings"),
                       F.exists("warnings", lambda w: w.startswith("CRITICAL")).alias("critical"))


@query("get_service", "graded_grades board30", f"""
    with m as (select lower(host) as host, arg_min(usdc, (-usdc, address)) as usdc, arg_min(settlements, (-usdc, address)) as n from board30 where host <> '' group by 1)
    select a.host, grades is not null or usdc is not null as found, grades, usdc as usdc_received, n as payments
    from (select distinct host from ({_ASK})) a left join graded_grades g on g.service = a.host left join m on m.host = a.host""")
def _(t):
    return catalog.get_service(board_of(t, 30), t.posts(), asked(t)).select(
        "host", "found", F.when(F.col("grades").isNotNull(), grade_text()).alias("grades"), "usdc_received", "payments")


_SEARCHED = "posts", f"""
    select id, grade from posts where grade is not null and contains(lower(service || ' ' || graded_on || ' ' || title || ' ' || coalesce(call, '')), 'fr')
      and coalesce(nullif(list_position({GRADES}, grade), 0), 99) <= list_position({GRADES}, 'B-')"""


@query("search_services", *_SEARCHED)
def _(t):
    return catalog.search_services(t.posts(), " FR ", "B-").select("id", "grade")


_TRAPS = "notes", "select note_id from notes where contains(lower(trap), 'thin') or contains(note_id, 'thin')"


@query("list_traps", *_TRAPS)
def _(t):
    return catalog.list_traps(t.notes(), "Thin").select("note_id")


# ---- catalogue ------------------------------------------------------------------------------
def endpoints(t: Tables):
    """Listings on checked hosts: one per order, with an advertised price and a description."""
    kind = F.concat(F.col("text"), F.lit(" no "), F.col("origin"))
    option = F.struct(
        ((F.col("calls30d") + 1) * 10).cast("string").alias("amount"), F.lit(None).cast("string").alias("maxAmountRequired"),
        F.lit(fixed.USDC_BASE).alias("asset"), F.lit("eip155:8453").alias("network"),
        F.lit("0xpay").alias("payTo"), F.lit(None).cast("string").alias("recipient"))
    rows = t.origins().select(
        F.concat(F.lit("https://"), "origin", F.lit("/v1/report")).alias("resource"), kind.alias("description"),
        F.array(option).alias("accepts"), F.col("breadth").alias("ordinal"),
        F.struct(F.struct(F.struct(F.struct(F.lit("GET").alias("method")).alias("input")).alias("info")).alias("bazaar")).alias("extensions"))
    return rows


def fresh_market(t: Tables):
    done = delivery(t).where("status in ('delivered', 'short')").select("url", "status", "observed")
    return catalog.catalog(endpoints(t), mart(t), done, t.posts())


def market(t: Tables):
    """The catalogue as it is stored."""
    return stored(t, "catalog", lambda: fresh_market(t))


def keyed_market(t: Tables):
    """The catalogue with a number for each URL, as it is stored."""
    return stored(t, "keyed_catalog", lambda: grams.numbered(market(t), "row_key", F.col("url")))


_CAT = """
    with cat as (select o.origin as host, 'https://' || o.origin || '/v1/report' as url, o.text || ' no ' || o.origin as descr, (o.calls30d + 1) * 10 / 1e6 as price_usdc,
        p.reliability, p.price_ok as price_honest, p.payto_ok as payto_honest, case when s.status = 'delivered' then true when s.status = 'short' then false end as delivered_as_promised, g.grades
      from origins o join probe_mart p on p.host = o.origin left join settled s on s.host = o.origin left join graded_grades g on g.service = o.origin)"""
_CN = "origins probe_mart settled graded_grades"


@query("catalog", _CN, _CAT + "select host, url, descr, price_usdc, reliability, price_honest, payto_honest, delivered_as_promised, grades from cat")
def _(t):
    return catalog.catalog_order(fresh_market(t)).select(
        "host", "url", "descr", "price_usdc", "reliability", "price_honest", "payto_honest", "delivered_as_promised",
        F.when(F.col("grades").isNotNull(), grade_text()).alias("grades"))


@query("host_search_rows", _CN, _CAT + """
    select host, count(*) as n, min(price_usdc) as price, bool_and(delivered_as_promised) as delivered, max(reliability) as reliability from cat group by host""")
def _(t):
    return catalog.host_search_rows(market(t)).select("host", "n", "price", "delivered", "reliability")


_SI = _CAT + """,
      h as (select host, min(price_usdc) as price, bool_and(delivered_as_promised) as delivered, substr(min(descr), 1, 70) as descr from cat group by host),
      si as (
        select 'host' as item_type, h.host as label, case when g.service is not null then '/s/' || h.host end as url,
          case when g.service is not null then 'graded' when delivered is not null or h.host in (select host from board30) then 'measured' else 'listed' end as status,
          g.best as grade, price, h.descr, null as keywords
        from h left join graded_grades g on g.service = h.host
        union all select 'host', service, '/s/' || service, 'graded', best, null, '', null from graded_grades where contains(service, '.') and not contains(service, ' ') and service not in (select host from h)
        union all select 'rating', substr(title, 1, 140), '/p/' || id, 'post', null, null, null, trim(lower(replace(tag_text, ',', ' ') || ' ' || service)) from posts
        union all select 'note', substr(trap, 1, 140), '/notes/' || note_id, 'note', null, null, null, lower(substr(bite, 1, 80)) from notes)"""
_SN = _CN + " posts notes board30"


def fresh_index(t: Tables):
    return catalog.search_index(market(t), board_of(t, 30), t.posts(), t.notes())


def index(t: Tables):
    """The search index as it is stored."""
    return stored(t, "search_index", lambda: fresh_index(t))


@query("search_index", _SN, _SI + "select item_type, label, url, status, grade, price, descr, keywords from si")
def _(t):
    return fresh_index(t).select("item_type", "label", "url", "status", "grade", "price", "descr", "keywords")


@query("add_missing_graded", _SN, _SI + """
    select service as label, best as grade from graded_grades where contains(service, '.') and not contains(service, ' ') and service not in (select host from h)""")
def _(t):
    from tollgauge.operators.catalog import host_search_rows
    listed = host_search_rows(market(t)).select(F.col("host").alias("label"), F.lit("host").alias("item_type"))
    return catalog.add_missing_graded(listed, t.posts())


@query("missing_from_marts", _SN, _SI + """
    select 'search' as mart, '/p/' || id as key from posts where '/p/' || id not in (select url from si where url is not null)
    union all select 'catalog', '/p/' || id from posts where service not in (select host from cat)""")
def _(t):
    posts = t.posts().select(F.concat(F.lit("/p/"), F.col("id").cast("string")).alias("url"), F.col("service").alias("host"))
    in_catalog = posts.join(market(t).select("host").distinct(), "host", "left_semi")
    return catalog.missing_from(posts, "url", {"search": index(t), "catalog": in_catalog})


_BOX = _SN, _SI + """,
      q as (select item_type, label, url, status, lower(coalesce(label, '')) as l, coalesce(keywords, '') as kw, lower(coalesce(descr, '')) as d,
          case when lower(label) like 'api1%' then 0 when regexp_matches(lower(label), '(^|[^a-z0-9])api1') then 1 when contains(lower(label), 'api1') then 2 when contains(coalesce(keywords, ''), 'api1') then 3 else 4 end as class,
          list_position(['graded', 'measured', 'post', 'note', 'listed'], status) as ro from si),
      hit as (select * from q where contains(l, 'api1') or contains(kw, 'api1') or contains(d, 'api1'))
    select row_number() over (order by class, ro, length(label), label, url nulls first) as rank, item_type, label, url, status, class::bigint as class, (select count(*) from hit) as total
    from hit order by class, ro, length(label), label, url nulls first limit 8"""


@query("search_box", *_BOX)
def _(t):
    return catalog.search(index(t), "API1", 8)


_FOUND = _CN + " graded", _CAT + """,
      acc as (select host, arg_min(dev, (category, abs(dev))) as off_by, min(category) || ' price' as vs from graded where value is not null and abs(dev) <= 500 group by host),
      s as (select *, contains(lower(descr), 'weather')::int + contains(lower(descr), 'forecast')::int + case when contains(lower(descr), 'weather forecast') then 2 else 0 end as hits from cat where price_usdc <= 0.006 and reliability >= 70)
    select s.host, url, descr, price_usdc, 'GET' as method, 'Base' as chains, reliability, price_honest, payto_honest, coalesce(grades, '') as grades, off_by,
      case when acc.host is not null then 'bps' end as unit, vs, (hits + case when acc.host is not null then 1000 else 0 end)::bigint as score from s left join acc using (host) where hits > 0
    order by score desc, reliability desc, price_usdc, s.host limit 8"""


@query("find_api", *_FOUND)
def _(t):
    return find(t, market(t))


def find(t: Tables, rows):
    good = accuracy.graded_rows(graded(t)).where("verdict = 'accurate'").select(
        "host", "category", F.col("dev").alias("off_by"), "unit", F.concat("category", F.lit(" price")).alias("metric"))
    return catalog.find_api(rows, good, "weather forecast", 0.006, 70, 8).select(
        "host", "url", "descr", "price_usdc", "method", "chains", "reliability", "price_honest", "payto_honest",
        F.coalesce(grade_text(), F.lit("")).alias("grades"), "off_by", "unit", F.col("graded_accurate.vs").alias("vs"), "score")


# ---- the same questions through lists of pieces ---------------------------------------------
def listed(t: Tables, name: str, rows, key: str, text):
    """The lists of a table's pieces, and their lengths, as they are stored."""
    lists = stored(t, f"pieces_{name}", lambda: grams.postings(rows(), key, text), ("bucket",), **grams.PACKED)
    return lists, stored(t, f"piece_counts_{name}", lambda: grams.counts(lists))


@query("search_services_by_pieces", *_SEARCHED)
def _(t):
    text = F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in ("service", "graded_on", "title", "call")])
    found = grams.candidates(*listed(t, "posts", t.posts, "id", text), " FR ")
    return catalog.search_services(grams.narrowed(t.posts(), "id", found), " FR ", "B-").select("id", "grade")


@query("list_traps_by_pieces", *_TRAPS)
def _(t):
    whole = F.to_json(F.struct(*t.notes().columns))
    found = grams.candidates(*listed(t, "notes", t.notes, "note_id", whole), "Thin")
    return catalog.list_traps(grams.narrowed(t.notes(), "note_id", found), "Thin").select("note_id")


def keyed_index(t: Tables):
    """The search index with a number for each item, the same for items that are alike, as it is stored."""
    return stored(t, "keyed_index", lambda: grams.numbered(index(t), "item_key", F.concat_ws("|", "item_type", "label", "url")))


@query("search_box_by_pieces", *_BOX)
def _(t):
    text = F.concat_ws("\n", "label", "keywords", "descr")
    found = grams.candidates(*listed(t, "index", lambda: keyed_index(t), "item_key", text), "API1")
    return catalog.search(grams.narrowed(keyed_index(t), "item_key", found), "API1", 8)


@query("find_api_by_pieces", *_FOUND)
def _(t):
    lists = listed(t, "catalog", lambda: keyed_market(t), "row_key", F.col("descr"))
    found = grams.candidates(*lists, "weather").unionByName(grams.candidates(*lists, "forecast")).distinct()
    return find(t, grams.narrowed(keyed_market(t), "row_key", found))


# ---- usage ----------------------------------------------------------------------------------
_AG = "(coalesce(tool, '') <> '' and coalesce(client, 'unknown') not in (" + ", ".join(f"'{c}'" for c in fixed.TOOLING_CLIENTS) + ", 'acme-own'))"


@query("agent_hits", "hits", f"select strftime(hit_ts, '%Y-%m-%d') as day, tool, client, count(*) as n from hits where {_AG} group by all")
def _(t):
    day = F.date_format(F.timestamp_millis("ts"), "yyyy-MM-dd")
    return usage.agent_hits(t.hits(), ["acme-own"]).groupBy(day.alias("day"), "tool", "client").agg(
        F.count("*").alias("n"))


@query("usage_counters", "hits", f"""
    with h as (select *, {_AG} as agent from hits)
    select 'tool' as dimension, tool as value, count(*) as n, count(*) filter (agent) as agent_n from h where tool is not null group by tool
    union all select 'client', coalesce(client, 'unknown'), count(*), count(*) filter (agent) from h group by 2
    union all select 'day', strftime(hit_ts, '%Y-%m-%d'), count(*), count(*) filter (agent) from h group by 2
    union all select * from (select 'subject', subject, count(*), count(*) filter (agent) from h group by 2 order by 3 desc, 2 limit 25)""")
def _(t):
    return usage.usage_counters(t.hits(), ["acme-own"], 25)


@query("usage_totals", "hits", f"""
    select count(*) as hits, count(*) filter ({_AG}) as agent_hits, count(distinct coalesce(client, 'unknown')) as clients, count(distinct client) filter ({_AG}) as agent_clients from hits""")
def _(t):
    return usage.usage_totals(t.hits(), ["acme-own"])


@query("reading_delta", "readings", "select date, visitors, visitors - lag(visitors) over (order by date) as delta from readings")
def _(t):
    return usage.reading_delta(t.readings())


@query("merge_daily", "readings", """
    select date as day, case when next_date is null then visitors else visitors + 1 end as n from (select *, lead(date) over (order by date) as next_date from readings)""")
def _(t):
    return usage.merge_daily(t.readings())


@query("attribution", "readings", """
    with r as (select date, visitors, regexp_extract(referrer_text, 'search=([0-9]+)', 1)::bigint + regexp_extract(referrer_text, 'mail=([0-9]+)', 1)::bigint as known from readings)
    select date, visitors, known, visitors - known as direct, round_even(100.0::double * known / visitors, 0) as share from r""")
def _(t):
    return usage.attribution(t.readings())


# ---- streams --------------------------------------------------------------------------------
def event_stream(t: Tables):
    schema = t("events").schema
    return (t.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
            .parquet(t.folder))


def _work(t: Tables, name: str) -> tuple[str, str]:
    base = f"{shared_folder(t.spark)}/streams/{name}-{uuid.uuid4().hex}"
    return f"{base}/table", f"{base}/checkpoint"


@query("stream_tape", "", """
    with p as (select strftime(ts, '%Y-%m-%d') as date, event_type as payee, user_id as payer, count(*) as n, sum(cast(floor(value * 100) as bigint)) as u, min(event_id) as b0, max(event_id) as b1 from events group by all)
    select date, payee, sum(n)::bigint as settlements, sum(u)::bigint as units, count(*) as unique_payers, count(*) filter (n > 1) as repeat_payers, max(u)::bigint as top_units, min(b0) as first_block, max(b1) as last_block from p group by all""")
def _(t):
    path, checkpoint = _work(t, "tape")
    rows = event_stream(t).select(
        F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("payee"),
        F.col("user_id").cast("string").alias("payer"), F.floor(F.col("value") * 100).alias("units"),
        F.col("event_id").alias("block"))
    streams.stream_tape(rows, path, checkpoint)
    changes = streams.read_changes(t.spark, path)
    return streams.tape_from_pairs(streams.fold_changes(changes, ["date", "payee", "payer"]))


@query("stream_first_seen", "", "select 'u' || user_id as url, strftime(min(ts), '%Y-%m-%d %H:%M:%S') as first_ts from events group by user_id")
def _(t):
    path, checkpoint = _work(t, "first")
    rows = event_stream(t).select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("url"), "ts")
    streams.stream_first_seen(rows, path, checkpoint)
    seen = streams.fold_changes(streams.read_changes(t.spark, path), ["url"])
    return seen.select("url", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("first_ts"))


@query("stream_usage", "", """
    select strftime(date_trunc('day', ts) - to_days(k::int), '%Y-%m-%d') as start, event_type as tool, count(*) as n from events, range(7) r(k) group by all""")
def _(t):
    path, checkpoint = _work(t, "usage")
    rows = event_stream(t).select(F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("tool"))
    streams.stream_usage(rows, path, checkpoint)
    return streams.fold_changes(streams.read_changes(t.spark, path), ["start", "tool"])
