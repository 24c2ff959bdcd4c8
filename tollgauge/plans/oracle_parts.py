"""Oracle-side building blocks (SQL), written independently of the Spark operators."""

from tollgauge import fixed_values as fixed

BURN_LIST = ", ".join(f"'{a}'" for a in fixed.BURN_ADDRESSES)


def quoted(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def any_of(text: str, words) -> str:
    return f"list_bool_or([contains({text}, w) for w in {quoted(words)}])" if words else "false"


def _window(n: int) -> str:
    return f"""
    select lower(address) as address, sum(settlements)::bigint as settlements, sum(units)::bigint as units,
      sum(units_out)::bigint as units_out, max(unique_payers) as payers, max(repeat_payers) as repeat_payers,
      max(top_payer_share) as top_payer_share, max(top5_payer_share) as top5_payer_share, max(payer_hhi) as payer_hhi
    from tape where address not in ({BURN_LIST})
      and date in (select distinct date from tape order by date desc limit {n})
    group by 1"""


def score_columns(payers="payers", repeat="repeat_payers", top1="top_payer_share", hhi="payer_hhi",
                  n="settlements") -> str:
    conc = f"coalesce({hhi}, {top1} * {top1})"
    b = f"(40.0::double * greatest(0, least(1, log10({payers}::double) / 2.0::double)))"
    d = f"(40.0::double * greatest(0, least(1, (1.0::double - {conc}) / 0.95::double)))"
    r = f"(20.0::double * greatest(0, least(1, ({repeat}::double / {payers}) / 0.30::double)))"
    return f"""
      case when {payers} > 0 and {conc} is not null then round_even({b} + {d} + {r}, 0)::bigint end as organic_score,
      case when {payers} > 0 then round_even({b}, 1) end as organic_breadth,
      case when {payers} > 0 and {conc} is not null then round_even({d}, 1) end as organic_dispersion,
      case when {payers} > 0 then round_even({r}, 1) end as organic_repeat,
      case when not ({payers} > 0) then null when {conc} is null then 'unknown' when {n} < 10 or {payers} < 3 then 'low'
           when {n} < 100 then 'medium' else 'high' end as organic_confidence"""


def demand_case(payers="payers", top1="top_payer_share", hhi="payer_hhi") -> str:
    return f"""case when coalesce({payers}, 0) = 0 then null
      when {top1} is not null and ({top1} >= 0.9 or coalesce({hhi} >= 0.8, false)) then 'one wallet'
      when {payers} <= 5 then 'thin'
      when {payers} >= 20 and coalesce({top1} <= 0.35, true) and coalesce({hhi} <= 0.15, true) then 'broad'
      else 'mixed' end"""


def _board(window: str) -> str:
    return f"""
    select w.address, coalesce(o.service, substr(w.address, 1, 10) || '…') as service, coalesce(o.host, '') as host,
      o.grade, coalesce(o.shares > 1, false) as shared_wallet, units, units_out,
      round_even(units / 1e6, 4) as usdc, round_even(units_out / 1e6, 4) as usdc_out,
      round_even((units - units_out) / 1e6, 4) as kept,
      case when units > 0 then round_even(100 * units_out::double / units, 1) end as payout_pct,
      coalesce(units > 0 and units_out::double / nullif(units, 0) >= 0.9, false) as circular, settlements, payers,
      case when settlements > 0 then round_even(units / 1e6 / settlements, 6) end as avg_ticket,
      repeat_payers, top_payer_share, top5_payer_share, payer_hhi, {demand_case()} as demand,
      {score_columns()}, 'base' as demand_measured_on, round_even(units / 1e6, 4) as base_usdc
    from {window} w left join owners o on w.address = o.address"""


_NOISE = " + ".join(f"contains(lower(origin), '{w}')::int" for w in fixed.HOSTING_NOISE)

PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    "inflow": (("transfers", "tracked"),
               "select * from transfers where chain = 'base' and payee in (select address from tracked)"),
    "outflow": (("transfers", "tracked"),
                "select * from transfers where chain = 'base' and payer in (select address from tracked)"),
    "pairs": (("inflow",), f"""
        select date, payee, payer, count(*) as n, sum(units) as u, min(block) as b0, max(block) as b1,
          row_number() over (partition by date, payee order by sum(units) desc, payer) as rn
        from inflow where payee not in ({BURN_LIST}) group by date, payee, payer"""),
    "tape_in": (("pairs",), """
        select date, payee as address, sum(n)::bigint as settlements, sum(u)::bigint as units, count(*) as unique_payers,
          count(*) filter (n > 1) as repeat_payers,
          round_even(max(u)::double / greatest(sum(u), 1)::double, 4) as top_payer_share,
          round_even((sum(u) filter (rn <= 5))::double / greatest(sum(u), 1)::double, 4) as top5_payer_share,
          round_even(sum(u * u)::double / (greatest(sum(u), 1)::double * greatest(sum(u), 1)::double), 4) as payer_hhi,
          min(b0) as first_block, max(b1) as last_block
        from pairs group by date, payee"""),
    "tape_out": (("outflow",), """
        select date, payer as address, count(*) as transfers_out, sum(units)::bigint as units_out
        from outflow group by date, payer"""),
    "tape": (("tape_in", "tape_out"), """
        select date, address, coalesce(settlements, 0) as settlements, coalesce(units, 0) as units,
          coalesce(units_out, 0) as units_out, round_even(coalesce(units, 0) / 1e6, 6) as usdc,
          round_even(coalesce(units_out, 0) / 1e6, 6) as usdc_out,
          round_even((coalesce(units, 0) - coalesce(units_out, 0)) / 1e6, 6) as usdc_net,
          coalesce(transfers_out, 0) as transfers_out, coalesce(unique_payers, 0) as unique_payers,
          coalesce(repeat_payers, 0) as repeat_payers, top_payer_share, top5_payer_share, payer_hhi,
          first_block, last_block
        from tape_in full join tape_out using (date, address)"""),
    "window1": (("tape",), _window(1)),
    "window7": (("tape",), _window(7)),
    "window30": (("tape",), _window(30)),
    "owners": (("services",), f"""
        select * from (
          select address, coalesce(service, origin) as service, origin as host, grade,
            count(*) over (partition by address) as shares,
            row_number() over (partition by address order by {_NOISE},
              length(origin) - length(replace(origin, '-', '')), length(origin), origin) as rn
          from (select distinct lower(unnest(string_split(wallets, ','))) as address, origin, service, grade from services)
          where address <> '' and address not in ({BURN_LIST})) where rn = 1"""),
    "board7": (("window7", "owners"), _board("window7")),
    "board30": (("window30", "owners"), _board("window30")),
    "sol": (("transfers", "tracked"), f"""
        select date, payee as wallet, count(*) as settlements, sum(units)::bigint as units, count(distinct payer) as unique_payers,
          case when any_value(supp) % 10 = 9 then '?' else 'api' || any_value(supp) || '.example.com' end as host
        from transfers where chain = 'solana' and payee in (select address from tracked) and payee not in ({BURN_LIST})
        group by date, payee"""),
    "sol_hosts": (("sol",), """
        select host, sum(units)::bigint as units, sum(settlements)::bigint as settlements, max(unique_payers) as payers,
          count(distinct date) as days
        from sol where host <> '?' and date in (select distinct date from sol order by date desc limit 7) group by host"""),
    "listing_prices": (("listing_docs",), f"""
        select *, (select min(cast(json_extract_string(x, '$.amount') as double)) / 1e6
            from (select unnest(from_json(json_extract(doc, '$.accepts'), '["JSON"]')) as x)
            where lower(json_extract_string(x, '$.asset')) = '{fixed.USDC_BASE}'
              and regexp_full_match(json_extract_string(x, '$.amount'), '[0-9]+')) as price,
          regexp_extract(lower(resource), '^https?://([^/:?#]+)', 1) as host
        from listing_docs"""),
    "graded_grades": (("posts",), f"""
        select service, string_agg(grade || ' x' || n, '|' order by g) as grades, min(f) as first_ordinal,
          arg_min(grade, g) as best
        from (select service, grade, count(*) as n, min(ordinal) as f, list_position({quoted(fixed.GRADES)}, grade) as g
              from posts where grade is not null and grade <> 'UNGRADED' and service <> '' group by service, grade)
        group by service"""),
    "check_live": (("checks",), """
        select *, coalesce(adv_amount <> 0 and live_amount <> 0
              and abs(adv_amount - live_amount) / greatest(adv_amount, live_amount) > 0.02, false) as price_bad,
            coalesce(adv_payto <> '' and live_payto <> '' and lower(adv_payto) <> lower(live_payto), false) as payto_bad
        from checks where not inconclusive"""),
    "probe_flags": (("check_live", "origins"), """
        select c.origin as host, not bool_or(price_bad) as price_ok, not bool_or(payto_bad) as payto_ok, any_value(o.phantom) as phantom
        from check_live c join origins o using (origin) group by c.origin"""),
    "probe_mart": (("check_live", "checks", "origins"), """
        select m.*, 
          responds + (case when price_ok then 25 else 0 end) + (case when payto_ok then 25 else 0 end)
            + (case when phantom then 0 else 10 end)
            + (case when median_ms is null then 5 when median_ms <= 1000 then 10 when median_ms <= 3000 then 6 else 2 end) as reliability
        from (
          select c.origin as host, o.breadth, count(*) as checked, count(*) filter (status = 402) as returns_402,
            count(*) filter (payable) as priceable, not bool_or(price_bad) as price_ok, not bool_or(payto_bad) as payto_ok,
            any_value(o.phantom) as phantom,
            list_sort(list(ms) filter (ms <> 0))[(count(ms) filter (ms <> 0)) // 2 + 1]::double as median_ms,
            round_even(30.0::double * count(*) filter (status = 402) / count(*), 0)::bigint as responds
          from check_live c join origins o using (origin) group by c.origin, o.breadth) m"""),
    "judged": (("calls",), f"""
        select c.*, string_split(promise, ',') as want,
          case when json_valid(payload) and json_type(payload) = 'OBJECT' then json_keys(payload) end as k1,
          case when json_valid(payload) and json_type(payload) = 'OBJECT' then
            list_distinct(list_concat(json_keys(payload), coalesce((select list(distinct k) from (
              select unnest(case when json_type(payload, '$."' || key || '"') = 'OBJECT' then json_keys(payload, '$."' || key || '"')
                when json_type(payload, '$."' || key || '"[0]') = 'OBJECT' then json_keys(payload, '$."' || key || '"[0]')
                else [] end) as k from (select unnest(json_keys(payload)) as key))), []))) end as got
        from calls c"""),
    "verdicts": (("judged",), f"""
        select *, list_sort(list_filter(want, lambda w: not coalesce(list_contains(got, w), false))) as lacking,
          list_sort(list_filter(coalesce(got, []), lambda g: not list_contains(want, g))) as bonus,
          case when k1 is null then 'inconclusive'
            when list_has_any(k1, {quoted(fixed.ERROR_KEYS)}) and len(list_intersect(want, k1)) <= len(want) * 0.2 then 'inconclusive'
            when list_has_all(got, want) then 'delivered' else 'short' end as jstatus
        from judged"""),
    "conf": (("verdicts",), f"""
        select url, host, quoted, o_orderkey, v, ms, day, payload, payload2, want, paid_tx as tx, v <> 8 as ok,
          case when v = 8 then 'inconclusive' else jstatus end as status,
          array_to_string(case when v = 8 or jstatus = 'inconclusive' then list_sort(want) when jstatus = 'short' then lacking else [] end, '|') as missing,
          array_to_string(case when v = 8 or jstatus = 'inconclusive' then [] else bonus end, '|') as extra,
          case when v = 8 then '502 bad gateway'
            when jstatus = 'delivered' then '' when jstatus = 'short' then 'missing ' || len(lacking) || ' promised field(s)'
            when k1 is null then '{fixed.WHY_UNREADABLE}' else '{fixed.WHY_ERROR_OBJECT}' end as why
        from verdicts"""),
    "settled": (("conf",), f"""
        select * replace (
            case when status = 'short' and o_orderkey % 3 = 0 and v = 3 and retry = 'delivered' then 'delivered'
                 when status = 'short' and not (retry is not null and retry = 'short') then 'inconclusive' else status end as status,
            case when status = 'short' and retry = 'delivered' then '' else missing end as missing,
            case when status = 'short' and retry = 'delivered' then retry_extra else extra end as extra,
            case when status = 'short' and retry = 'delivered' then '{fixed.WHY_CLEARED}'
                 when status = 'short' and retry = 'short' then '{fixed.WHY_CONFIRMED}'
                 when status = 'short' then '{fixed.WHY_UNCONFIRMED}' else why end as why)
        from (select *,
            case when v = 3 and o_orderkey % 3 = 0 then (case when list_has_all(json_keys(payload2), want) then 'delivered' else 'short' end)
                 when v = 3 and o_orderkey % 3 = 1 then (case when list_has_all(json_keys(payload2), want) then 'delivered' else 'short' end)
                 else 'inconclusive' end as retry,
            case when v = 3 and o_orderkey % 3 <> 2 then array_to_string(list_sort(list_filter(json_keys(payload2), lambda k: not list_contains(want, k))), '|') else '' end as retry_extra
          from conf)"""),
    "graded": (("quotes",), """
        select *, case when gap / ref <= 0.5 then returned end as value,
          case when gap / ref <= 0.5 then round_even(10000.0::double * (returned - ref) / ref, 1) end as dev,
          case when not (gap / ref <= 0.5) then 'no value near the reference (could not isolate this metric)'
            when n3 = 0 then '.data.last' when n3 = 1 then '.items[0].price' else '.figure' end as field
        from (select *, abs(returned - ref) as gap from quotes)"""),
    "arrivals": (("snapshots",), f"""
        select url, host, case when service <> '' then service else host end as service, descr, amount, calls30d,
          host not in (select host from snapshots where date = '1997-12-31' and url in (select url from snapshots where date = '1998-12-31')) as new_service
        from snapshots s where date = '1998-12-31' and url not in (select url from snapshots where date = '1997-12-31')"""),
}
