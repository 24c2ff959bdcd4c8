"""Registered queries: free checks, probe score, honesty and challenges."""

from pyspark.sql import functions as F

from tollgauge import fixed_values as fixed
from tollgauge.operators import checks, ranks
from tollgauge.plans.inputs import AS_OF, Tables
from tollgauge.plans.marts import stored
from tollgauge.plans.registry import query


@query("conclusive_checks", "checks", "select origin, url, status from checks where not inconclusive")
def _(t):
    return checks.conclusive(t("checks")).select("origin", "url", "status")


@query("honesty_flags", "check_live", """
    select origin, not bool_or(price_bad) as price_ok, not bool_or(payto_bad) as payto_ok from check_live group by origin""")
def _(t):
    return checks.honesty_flags(t("checks"))


@query("probe_flags", "probe_flags", "select * from probe_flags")
def _(t):
    return checks.probe_flags(t("checks"), t.origins())


@query("trusted_only", "probe_flags checks", """
    select origin, url from checks where origin in (select host from probe_flags where price_ok and payto_ok and not phantom)""")
def _(t):
    flags = checks.probe_flags(t("checks"), t.origins())
    rows = t("checks").select(F.col("origin").alias("host"), "url")
    return checks.trusted_only(rows, flags).select(F.col("host").alias("origin"), "url")


@query("payto_counts", "checks", f"""
    select origin, live_payto as payto, count(*) as n from checks
    where status = 402 and live_payto <> '' and lower(live_payto) not in ('{fixed.BURN_ADDRESSES[0]}', '{fixed.BURN_ADDRESSES[1]}') group by all""")
def _(t):
    return checks.payto_counts(t("checks"))


_MONEY = "regexp_replace(regexp_replace({0}::decimal(28, 8)::varchar, '0+$', ''), '\\.$', '')"
_F = {k: v.replace("'", "''") for k, v in vars(fixed).items() if isinstance(v, str)}
_SCORE = f"""
    with f as (
        select origin, count(*) as n, count(status) as reached, count(*) filter (status = 402) as paid, count(*) filter (status = 200) as opened,
          count(*) filter (status not in (402, 200)) as odd, min(status) filter (status not in (402, 200)) as odd_code,
          count(*) filter (status = 402 and payable) as payable,
          arg_min(body_sample, url) filter (status = 402 and body_sample <> '') as sample,
          count(*) filter (status = 402 and adv_amount is not null and live_amount is not null) as comparable,
          count(*) filter (status = 402 and adv_amount is not null and live_amount is not null and (greatest(adv_amount, live_amount) = 0
              or (greatest(adv_amount, live_amount) - least(adv_amount, live_amount)) / greatest(adv_amount, live_amount) <= 0.02)) as honest,
          arg_min(adv_amount, (-abs(live_amount - adv_amount), url)) filter (status = 402 and adv_amount is not null and live_amount is not null) as w_adv,
          arg_min(live_amount, (-abs(live_amount - adv_amount), url)) filter (status = 402 and adv_amount is not null and live_amount is not null) as w_live,
          count(*) filter (status = 402 and adv_payto <> '' and live_payto <> '') as addressed,
          count(*) filter (status = 402 and adv_payto <> '' and live_payto <> '' and lower(adv_payto) = lower(live_payto)) as same_payto,
          coalesce(bool_or(status = 402 and schema), false) as has_schema
        from checks where not inconclusive group by origin),
      al as (select origin, count(*) as n_checked, coalesce(bool_or(status = 200), false) as free_tier,
          (list_sort(list(ms) filter (status = 402)))[count(*) filter (status = 402) // 2 + 1]::double as median_ms from checks group by origin),
      j as (select o.*, f.* exclude (origin), coalesce(f.n, 0) as k, coalesce(n_checked, 0) as n_checked, coalesce(free_tier, false) as free_tier, median_ms
        from origins o left join f using (origin) left join al using (origin)),
      s as (select *, greatest(0.0, least(100.0,
          case when k > 0 then 15.0::double * (reached / k) else 0 end + case when k > 0 then 15.0::double * ((paid + opened) / k) else 0 end
          + case when paid > 0 then 25.0::double * (payable / paid) else 0 end + case when comparable > 0 then 15.0::double * (honest / comparable) else 0 end
          + case when rotates_payto then 10.0::double when addressed > 0 then 10.0::double * (same_payto / addressed) else 0 end
          + case when discoverable then 6 else 0 end + case when has_schema then 4 else 0 end
          + case when median_ms is null then 0 when median_ms < 400 then 10 when median_ms < 1000 then 7 when median_ms < 2500 then 4 else 1 end
          - case when phantom then 30 else 0 end + case when free_tier then 3 else 0 end))::double as raw from j)
    select origin, k > 0 as assessable, case when k > 0 then round_even(raw, 1) else 0.0 end as score,
      case when k = 0 then '?' when raw >= 85 then 'A' when raw >= 70 then 'B' when raw >= 55 then 'C' when raw >= 40 then 'D' else 'F' end as grade,
      case when k > 0 then concat_ws('|', case when paid > 0 and payable = paid then '{_F['NOTE_PAYABLE']}' end,
          case when comparable > 0 and honest = comparable then '{_F['NOTE_PRICE']}' end, case when rotates_payto then '{_F['NOTE_ROTATES']}' end,
          case when discoverable then 'publishes ' || replace(paths, ',', ' and ') end, case when has_schema then '{_F['NOTE_SCHEMA']}' end,
          case when free_tier then '{_F['NOTE_FREE']}' end)
        when n_checked > 0 then '{_F['NOTE_UNASSESSED_CHECKED']}' else '{_F['NOTE_UNASSESSED_UNLISTED']}' end as notes,
      case when k > 0 then concat_ws('|', case when reached < k then (k - reached) || '/' || k || ' listed resources unreachable' end,
          case when odd > 0 then odd || ' listed resource(s) answer ' || odd_code || ' instead of asking for payment' end,
          case when paid > 0 and payable = 0 then '402 carries no machine-payable quote (' || case when trim(coalesce(sample, '')) in ('{{}}', '') then 'empty body' else 'no payment requirements in the response' end || ')' end,
          case when payable > 0 and payable < paid then (paid - payable) || '/' || paid || ' challenges are not machine-payable' end,
          case when honest < comparable then 'price mismatch: registry says $' || {_MONEY.format('w_adv')} || ', endpoint demands $' || {_MONEY.format('w_live')} end,
          case when not rotates_payto and same_payto < addressed then '{_F['FLAG_PAYTO']}' end, case when phantom then '{_F['FLAG_PHANTOM']}' end)
        else '' end as flags, median_ms from s"""


@query("probe_score", "checks origins", _SCORE)
def _(t):
    return checks.probe_score(t("checks"), t.origins())


@query("upper_median_latency", "checks", """
    select origin, (list_sort(list(ms)))[count(*) // 2 + 1]::double as median from checks where status = 402 group by origin""")
def _(t):
    return ranks.upper_median(t("checks").where("status = 402"), ["origin"], "ms")


@query("market_latency", "checks", """
    select schema, (list_sort(list(ms)))[count(*) // 2 + 1]::double as upper, median(ms)::double as middle from checks group by schema""")
def _(t):
    rows = t("checks")
    return ranks.upper_median(rows, ["schema"], "ms", "upper").join(
        ranks.true_median(rows, ["schema"], "ms", "middle"), "schema")


_TIER = f"""
    with x as (select *, case when settled_tx30d > calls30d then settled_tx30d else calls30d end as c, case when settled_tx30d > calls30d then settled_buyers30d else payers30d end as p,
        settled_tx30d > calls30d as chain, greatest(0, floor(date_diff('second', cast(substr(last_called, 1, 10) || ' ' || substr(last_called, 12, 8) as timestamp), timestamp '{AS_OF} 00:00:00') / 86400))::bigint as days from origins),
      y as (select *, case when p >= 20 and c >= 200 then 'established' when p >= 5 then 'traction' when c >= 500 and p <= 2 then 'self-traffic' when c > 0 then 'thin' else 'dormant' end as t0 from x),
      z as (select origin, case when days > 14 and t0 <> 'dormant' then 'dormant' else t0 end as tier,
        case when days > 14 and t0 <> 'dormant' then 'last paid call ' || days || ' days ago'
          when t0 = 'established' then p || ' distinct wallets paid it in the last 30 days' when t0 = 'traction' then p || ' distinct paying wallets'
          when t0 = 'self-traffic' then format('{{:,}}', c) || ' calls from only ' || p || ' paying wallet(s)'
          when t0 = 'thin' then format('{{:,}}', c) || ' calls from ' || p || ' wallet(s)' else 'no recorded paid calls' end as tier_why,
        case when p > 0 then round_even(c / p, 1) end as wash_ratio, days as days_since_call, case when chain then 'settlement' else 'registry' end as demand_source,
        settled_usd30d, calls30d from y)"""


@query("adoption_tier", "origins", _TIER + "select origin, tier, tier_why, wash_ratio, days_since_call, demand_source from z")
def _(t):
    return checks.adoption_tier(t.origins(), AS_OF).select(
        "origin", "tier", "tier_why", "wash_ratio", "days_since_call", "demand_source")


@query("probe_rank", "checks origins", _TIER.replace("with x as", "with sc as (" + _SCORE + "), x as", 1) + """
    select z.origin, tier, settled_usd30d, calls30d, score,
      coalesce(list_position(['established', 'traction', 'thin', 'self-traffic', 'dormant'], tier) - 1, 5) as tier_order
    from z join sc using (origin)""")
def _(t):
    tiers = checks.adoption_tier(t.origins(), AS_OF)
    scores = checks.probe_score(t("checks"), t.origins()).select("origin", "score")
    return checks.probe_rank(tiers.join(scores, "origin")).select(
        "origin", "tier", "settled_usd30d", "calls30d", "score", "tier_order")


def fresh_mart(t: Tables):
    return checks.probe_mart(t("checks"), t.origins())


def mart(t: Tables):
    """The probe mart as it is stored."""
    return stored(t, "probe_mart", lambda: fresh_mart(t))


@query("probe_mart", "probe_mart check_live", """
    select m.host, breadth, checked, returns_402, priceable, price_ok, payto_ok, phantom, median_ms, reliability,
      coalesce((select string_agg(url, '|' order by url) from (select url from check_live c where c.origin = m.host and price_bad order by url limit 5)), '') as mismatches
    from probe_mart m""")
def _(t):
    return fresh_mart(t).select(
        "host", "breadth", "checked", "returns_402", "priceable", "price_ok", "payto_ok", "phantom",
        "median_ms", "reliability",
        F.coalesce(F.array_join(F.transform("mismatches", lambda m: m["url"]), "|"), F.lit("")).alias("mismatches"))


@query("reliability", "probe_mart", """
    select host, reliability, responds as part_responds, case when price_ok then 25 else 0 end::bigint as part_price_honest,
      case when payto_ok then 25 else 0 end::bigint as part_payto_honest, case when phantom then 0 else 10 end::bigint as part_real,
      case when median_ms is null then 5 when median_ms <= 1000 then 10 when median_ms <= 3000 then 6 else 2 end::bigint as part_fast from probe_mart""")
def _(t):
    return mart(t).select("host", "reliability", *[
        f"part_{p}" for p in ("responds", "price_honest", "payto_honest", "real", "fast")])


def challenge_responses(t: Tables):
    """Captured challenges in every encoding, one per line item."""
    def b64(col):
        return F.regexp_replace(F.base64(F.encode(F.col(col), "utf-8")), r"=+$|\s", "")
    n = F.col("n")
    return t("challenge_rows").select(
        "id",
        F.when(n == 1, F.col("doc")).when(n == 2, F.col("doc2")).when(n == 3, F.col("doc3"))
        .when(n == 7, "pay me").otherwise("{}").alias("body"),
        F.when(n == 4, b64("doc")).when(n == 7, "%%%").alias("payment_required"),
        F.when(n == 5, F.concat(F.lit('X402 requirements="'), b64("doc2"), F.lit('"')))
        .when(n == 6, F.concat(F.lit('Payment request="'), b64("doc6"), F.lit('"')))
        .alias("www_authenticate"))


@query("parse_challenge", "challenge_rows", """
    select id, case when n in (1, 2, 4, 6) then amount / 1e6 when n = 3 then ('0.0' || (10 + amount // 1000))::double end as amount,
      case when n in (1, 2, 4, 6) then payto when n = 5 then '0xno' end as payto,
      case when n in (1, 2, 4) then 'eip155:8453' when n = 3 then 'base' when n = 5 then 'eip155:56' when n = 6 then 'tempo' end as network,
      n in (2, 5) as schema from challenge_rows""")
def _(t):
    return checks.parse_challenge(challenge_responses(t)).select("id", "amount", "payto", "network", "schema")
