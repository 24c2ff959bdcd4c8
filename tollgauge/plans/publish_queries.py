"""Registered queries: the published set of marts, and whole answers out of it."""

import uuid

from pyspark.sql import functions as F

from tollgauge import fixed_values as fixed
from tollgauge.operators import accuracy, catalog, guards, ratings, receipts, usage, verdicts
from tollgauge.plans import answer_queries as answers
from tollgauge.plans import check_queries, ledger_queries, money_queries
from tollgauge.plans.inputs import Tables
from tollgauge.plans.oracle_parts import any_of
from tollgauge.plans.registry import query
from tollgauge.sources import publish
from tollgauge.sources.storage import shared_folder


# ---- the published set ----------------------------------------------------------------------
def categories(t: Tables):
    """What each accuracy category measures, and against which source."""
    return ledger_queries.config(t).select("category", F.concat("category", F.lit(" price")).alias("metric"),
                                           F.lit("retail list").alias("source"))


def accuracy_mart(t: Tables):
    return accuracy.accuracy_mart(ledger_queries.graded(t), categories(t))


def ledger(t: Tables):
    """Receipts of both kinds, each with its pointer, in one schema."""
    graded = receipts.receipts_from(ledger_queries.graded_claims(t), "stock", ledger_queries.stored_pointers(t))
    return receipts.as_ledger(ledger_queries.delivery(t)).unionByName(receipts.as_ledger(graded))


def publish_all(t: Tables, ledger_rows=None, board_rows=None):
    """The job of one round: every mart after those it is made from, each before its guards. Facts, and marts that are not
    made from each other, are written side by side; each fact belongs to one of the jobs."""
    def job(r: publish.Publication) -> None:
        facts = [lambda: (check_queries.mart(t), ledger_queries.graded(t))]
        if ledger_rows is None:
            facts.insert(0, lambda: ledger_queries.delivery(t))
        if board_rows is None:
            facts.append(lambda: money_queries.board_of(t, 30))
        publish.side_by_side(t.spark, *facts)
        posts = t.posts()
        board, probe, receipt = publish.side_by_side(
            t.spark,
            lambda: r.stage("leaderboard", ratings.with_grades(
                money_queries.board_of(t, 30) if board_rows is None else board_rows, posts), guards.not_empty),
            lambda: r.stage("probe", check_queries.mart(t), guards.not_empty, guards.no_shrink(guards.SELLER_SHRINK)),
            lambda: r.stage("receipts", ledger(t) if ledger_rows is None else ledger_rows, guards.not_empty,
                            guards.no_untyped_leaves("receipt_id")))

        def listed():
            delivery = r.stage("delivery", receipt.where("kind = 'delivery' and status in ('delivered', 'short')").select(
                "host", "url", "status", "promised", "missing", "observed", "tx", "ts", "receipt_id"))
            return r.stage("catalog", catalog.catalog(
                answers.endpoints(t), probe, delivery.select("url", "status", "observed"), posts),
                guards.not_empty, guards.no_shrink(guards.REGISTRY_SHRINK))

        def preflight():
            texts = t("origins").select(F.lower("origin").alias("host"), "text")
            facts = receipt.select("receipt_id", "kind", "host", "status", "promised", "missing")
            return r.stage("preflight", verdicts.verdict(verdicts.preflight_inputs(probe, facts, board, texts)), guards.not_empty)

        found = publish.side_by_side(
            t.spark, listed, preflight, lambda: r.stage("categories", accuracy_mart(t)),
            lambda: r.stage("ratings", ratings.graded_posts(posts), guards.not_empty),
            lambda: r.stage("agent_usage", usage.usage_counters(t.hits(), ["acme-own"], 25)))[0]
        pages = posts.select(F.concat(F.lit("/p/"), F.col("id").cast("string")).alias("page"))
        r.stage("search_index", catalog.search_index(found, board, posts, t.notes()), guards.covers("url", pages))
    return job


MARTS = ("leaderboard", "catalog", "probe", "delivery", "receipts", "preflight", "categories", "ratings", "search_index", "agent_usage")
_COUNTS = f"""
    select 'leaderboard' as mart, (select count(*) from board30) as n
    union all select 'catalog', (select count(*) from ({answers._CAT} select * from cat))
    union all select 'probe', (select count(*) from probe_mart)
    union all select 'delivery', (select count(*) from settled where status in ('delivered', 'short'))
    union all select 'receipts', (select count(*) from settled) + (select count(*) from graded)
    union all select 'preflight', (select count(*) from ({answers._LIGHT} select * from vd))
    union all select 'categories', (select count(*) from graded where value is not null)
    union all select 'ratings', (select count(*) from posts where grade is not null and grade <> 'UNGRADED')
    union all select 'search_index', (select count(*) from ({answers._SI} select * from si))
    union all select 'agent_usage', (select count(distinct tool) + count(distinct coalesce(client, 'unknown')) + count(distinct strftime(hit_ts, '%Y-%m-%d'))
        + least(25, count(distinct subject)) from hits)"""
_NEEDS = "settled graded probe_flags probe_mart board30 origins posts notes graded_grades hits"


def published_rows(t: Tables, base: str, refused: str | None):
    """Rows of every mart as readers find it, and why the last round was refused."""
    out, places = None, publish.manifest(t.spark, base)
    for mart in MARTS:
        rows = publish.published(t.spark, base, mart, places)
        row = rows.agg(F.lit(mart).alias("mart"), F.count("*").alias("n"), F.lit(refused or "").alias("refused"))
        out = row if out is None else out.unionByName(row)
    return out


@query("published_marts", _NEEDS, f"select mart, n, '' as refused from ({_COUNTS})")
def _(t):
    base = f"{shared_folder(t.spark)}/published-{uuid.uuid4().hex}"
    return published_rows(t, base, publish.publish(t.spark, base, publish_all(t)))


@query("refused_publication", _NEEDS, f"select mart, n, 'a published shape names something that is not a type' as refused from ({_COUNTS})")
def _(t):
    """A second round whose receipts name a value: none of its marts is seen, not even the half board it staged before."""
    base = f"{shared_folder(t.spark)}/published-{uuid.uuid4().hex}"
    publish.publish(t.spark, base, publish_all(t))
    leaked = F.transform("shape", lambda s: F.struct(s["path"].alias("path"), F.when(
        s["path"] == "/price", "63127.97").otherwise(s["type"]).alias("type")))
    half = money_queries.board_of(t, 30).where(F.crc32("address") % 2 == 0)
    return published_rows(t, base, publish.publish(t.spark, base, publish_all(t, ledger(t).withColumn("shape", leaked), half)))


# ---- whole answers ---------------------------------------------------------------------------
def told(name: str, *values: str) -> str:
    """SQL text of a fixed sentence with its places filled in."""
    parts = getattr(fixed, name).replace("'", "''").replace("%%", "\x00").replace("%s", "\x01").replace("%d", "\x01").split("\x01")
    out = f"'{parts[0]}'"
    for value, part in zip(values, parts[1:], strict=True):
        out += f" || {value} || '{part}'"
    return "(" + out.replace("\x00", "%") + ")"


_FREE_SOURCE = "case " + " ".join(f"when {any_of('lower(text)', words)} then '{source}'".replace("chain's", "chain''s").replace("agent's", "agent''s")
                                 for words, _, source in fixed.FREE_DATA_RULES) + " end"
_REASONS = f"""concat_ws(' / ', case when live and not payto_ok then {told('REASON_PAYTO')} end, case when live and phantom then {told('REASON_PHANTOM')} end,
    case when severe > 0 then {told('REASON_SEVERE', 'severe_fields')} end, case when live and not price_ok then {told('REASON_PRICE')} end,
    case when disputes > 0 and severe = 0 then {told('REASON_SHORT', 'disputes')} end, case when delivered > 0 then {told('REASON_DELIVERED', 'delivered')} end,
    case when accurate > 0 then {told('REASON_ACCURATE', 'accurate')} end, case when live and payto_ok and price_ok and not phantom then {told('REASON_MATCHES')} end,
    case when free_label is not null then {told('REASON_FREE', 'free_label', _FREE_SOURCE)} end, case when payout_pct >= 90 then {told('REASON_RECYCLES', 'payout_pct::varchar')} end,
    case when demand = 'one wallet' then {told('REASON_ONE_WALLET')} end, case when receipts = 0 then {told('REASON_UNBOUGHT')} end)"""
_TEXTS = answers._LIGHT + f""",
      rs as (select host, {_REASONS} as reasons from fr)"""


@query("preflight_texts", answers._NEEDS, _TEXTS + f"""
    select a.host, coalesce(light, 'gray') as light, coalesce(reasons, '') as reasons, receipts, disputes, delivered, accurate, checked_live,
      '/s/' || a.host as seller_page, {told('ALWAYS_READ')} as always
    from (select distinct host from ({answers._ASK})) a left join vd using (host) left join rs using (host)""")
def _(t):
    rows = catalog.preflight(answers.lights(t), answers.asked(t))
    return rows.select("host", "light", F.array_join(F.transform("reasons", lambda r: r["text"]), " / ").alias("reasons"),
                       "evidence.*", "seller_page", "always")


_MONEY = "regexp_replace(regexp_replace({0}::decimal(28, 8)::varchar, '0+$', ''), '\\.$', '')"
_WARNED = f"""
    with bd as (select lower(host) as host, arg_min(coalesce(payout_pct, -1), (-usdc, address)) as payout_pct, arg_min(coalesce(demand, ''), (-usdc, address)) as demand,
        arg_min(usdc, (-usdc, address)) as usdc, arg_min(payers, (-usdc, address)) as payers from board30 where host <> '' group by 1),
      mm as (select origin as host, string_agg(url || ' listed $' || {_MONEY.format('adv_amount')} || ' live $' || {_MONEY.format('live_amount')}, '; ' order by url) as shown
        from (select *, row_number() over (partition by origin order by url) as rn from check_live where price_bad) where rn <= 2 group by origin),
      w as (select a.host, p.host is not null as live, p.*, bd.payout_pct, bd.demand, bd.usdc, bd.payers, shown
        from (select distinct host from ({answers._ASK})) a left join probe_mart p using (host) left join bd using (host) left join mm using (host))"""


@query("payment_safety_texts", "probe_mart board30 check_live graded_grades", _WARNED + f"""
    select w.host, live as checked_live, concat_ws(' / ', case when not live then {told('WARN_UNCHECKED')} end, case when live and not payto_ok then {told('WARN_PAYTO')} end,
        case when live and not price_ok then {told('WARN_PRICE', 'shown')} end, case when live and phantom then {told('WARN_PHANTOM')} end,
        case when live and returns_402 < checked then {told('WARN_NO_402', '(checked - returns_402)', 'checked')} end,
        case when payout_pct >= 90 then {told('WARN_RECYCLES', 'payout_pct::varchar')} end, case when demand = 'one wallet' then {told('WARN_ONE_WALLET')} end) as warnings,
      checked as endpoints_checked, returns_402 as returns_402_unpaid, price_ok as price_matches_listing, payto_ok as payto_matches_listing, phantom as phantom_paywall,
      median_ms, usdc as usdc_received, payers as paying_wallets, nullif(demand, '') as demand_shape, coalesce(g.grades, '') as grades
    from w left join graded_grades g on g.service = w.host""")
def _(t):
    rows = catalog.payment_safety(check_queries.mart(t), money_queries.board_of(t, 30), answers.asked(t), t.posts())
    return rows.select(
        "host", "checked_live", F.array_join("warnings", " / ").alias("warnings"), "live_check.endpoints_checked", "live_check.returns_402_unpaid",
        "live_check.price_matches_listing", "live_check.payto_matches_listing", "live_check.phantom_paywall", "live_check.median_ms",
        "demand.usdc_received", "demand.paying_wallets", "demand.demand_shape", F.coalesce(money_queries.grade_text(), F.lit("")).alias("grades"))


@query("preflight_detail", answers._NEEDS + " probe_mart", answers._LIGHT + f"""
    select a.host, coalesce(light, 'gray') as light, p.host is not null as checked_live, p.median_ms from (select distinct host from ({answers._ASK})) a
    left join vd using (host) left join probe_mart p on p.host = a.host""")
def _(t):
    rows = catalog.preflight_detail(answers.lights(t), check_queries.mart(t), money_queries.board_of(t, 30), t.posts(), answers.asked(t))
    return rows.select("host", "light", "detail_checks.checked_live", F.col("detail_checks.live_check.median_ms").alias("median_ms"))


@query("accuracy_mart", "graded", """
    select category, category || ' price' as metric, 'retail list' as source, ref as reference, 'bps' as unit, 500.0::double as tolerance, host, url, value, dev as deviation,
      quoted as price_usdc, case when abs(dev) <= 500 then 'accurate' else 'off' end as verdict from graded where value is not null""")
def _(t):
    return accuracy.accuracy_order(accuracy_mart(t)).drop("abs_dev")


def _flat(answer):
    shown = F.transform("ranked", lambda r: F.concat_ws("~", r["host"], r["returned"].cast("string"), r["off_by"].cast("string"), r["verdict"]))
    return answer.select("category", "found", "metric", "graded_against", "count", "limit", F.array_join(shown, " / ").alias("ranked"),
                         F.array_join(F.coalesce("available_categories", F.array().cast("array<string>")), " / ").alias("available_categories"))


@query("accuracy_answer", "graded", """
    with top as (select category, row_number() over (partition by category order by abs(dev), case when quoted = 0 then 9 else quoted end, url) as rn, host, value, dev
        from graded where value is not null),
      c as (select min(category) as name from top)
    select lower(name) as category, true as found, name || ' price' as metric, 'retail list' as graded_against, (select count(*) from top where category = name) as count, 4::bigint as limit,
      (select string_agg(host || '~' || value::varchar || '~' || dev::varchar || '~' || case when abs(dev) <= 500 then 'accurate' else 'off' end, ' / ' order by rn) from top where category = name and rn <= 4) as ranked,
      '' as available_categories from c
    union all select 'no such category', false, null, null, 0, 50, '', (select string_agg(category, ' / ' order by category) from (select distinct category from top))
    union all select null, false, null, null, 0, 1, '', (select string_agg(category, ' / ' order by category) from (select distinct category from top))""")
def _(t):
    mart = accuracy_mart(t)
    first = mart.agg(F.min("category")).first()[0]  # one name
    asked = ((first, 4), ("No such category ", 99), (None, 0))
    out = None
    for name, limit in asked:
        row = _flat(accuracy.accuracy_answer(mart, name, limit))
        out = row if out is None else out.unionByName(row)
    return out


# ---- the six fixed categories -------------------------------------------------------------------
_SIX = {"crypto-price": (60000, 17), "stock-price": (200, 0.25), "fx-rate": (1.25, 0.0025), "gas-price": (0.5, 0.003),
        "wallet-balance": (1000, 0.125), "weather": (70, 1)}


def _of_six(pick) -> str:
    return "(case o_orderkey % 6 " + " ".join(f"when {i} then {pick(n)}" for i, n in enumerate(_SIX)) + " end)"


_SIX_ROWS = f"""
    select 'https://c' || o_orderkey || '.example.com/v' as url, 'c' || o_orderkey || '.example.com' as host, {_of_six(lambda n: f"'{n}'")} as category,
      cast({_of_six(lambda n: f'cast({_SIX[n][0]} as decimal(14, 6))')} as double) as ref, 0.001 as quoted,
      cast({_of_six(lambda n: f'cast({_SIX[n][0]} as decimal(14, 6)) + cast((o_custkey % 13 - 6) as decimal(4, 0)) * cast({_SIX[n][1]} as decimal(10, 6))')} as decimal(20, 6)) as number
    from {{orders}}"""


@query("six_categories", "", f"""
    with r as ({_SIX_ROWS.format(orders='orders')}), d as (select *, number::double as v from r)
    select url, category, v as value, case when category in ('crypto-price', 'stock-price', 'fx-rate') then round_even(10000.0::double * (v - ref) / ref, 1) else round_even(v - ref, 4) end as dev,
      case category when 'gas-price' then 'gwei' when 'wallet-balance' then 'USDC' when 'weather' then '°F' else 'bps' end as unit,
      abs(case when category in ('crypto-price', 'stock-price', 'fx-rate') then round_even(10000.0::double * (v - ref) / ref, 1) else round_even(v - ref, 4) end)
        <= case category when 'fx-rate' then 50 when 'gas-price' then 0.01 when 'wallet-balance' then 0.01 when 'weather' then 5 else 100 end as accurate from d""")
def _(t):
    rows = t.spark.sql(_SIX_ROWS, orders=t("orders"))
    payloads = rows.withColumn("payload", F.concat(F.lit('{"id":7,"value":'), F.col("number").cast("string"), F.lit("}"))).drop("number")
    graded = accuracy.grade(payloads.withColumn("quoted", F.col("quoted").cast("double")), accuracy.category_config(t.spark))
    return accuracy.graded_rows(graded).select("url", "category", "value", "dev", "unit", (F.col("verdict") == "accurate").alias("accurate"))
