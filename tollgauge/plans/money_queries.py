"""Registered queries: transfers, tapes, buyers and the board."""

from pyspark.sql import functions as F

from tollgauge import fixed_values as fixed
from tollgauge.functions import chain as chain_fn
from tollgauge.functions.demand import demand_label, directory_demand, organic_score
from tollgauge.functions.numbers import clamp01
from tollgauge.operators import board, changes, flows, graph, ranks, ratings, registry, sellers
from tollgauge.plans.inputs import Tables
from tollgauge.plans.marts import stored
from tollgauge.plans.oracle_parts import BURN_LIST, demand_case, score_columns
from tollgauge.plans.registry import query


def inflow(t: Tables):
    return flows.inflow_to(flows.decode_logs(t.raw_logs()), t("tracked"))


def tape(t: Tables):
    """The tape from transfers that are decoded once and combined: its three parts would each decode all logs again."""
    pairs = stored(t, "transfer_pairs", lambda: flows.dated_pairs(flows.decode_logs(t.raw_logs())))
    return flows.tape_of_dated_pairs(pairs, t("tracked"))


def stored_tape(t: Tables):
    """The tape by date, as the board's windows read it: they ask it twice, for its newest dates and for the rows of these."""
    return stored(t, "tape", lambda: tape(t), ("date",))


def second_chain_tape(t: Tables):
    pairs = stored(t, "second_chain_pairs", lambda: flows.dated_pairs(t("transfers").where("chain = 'solana'")))
    per = flows.tape_of_pairs(flows.inflow_to(pairs, t("tracked")), ["date"])
    hosts = wallet_keys(t).select("address", F.when(F.col("k") % 10 == 9, "?").otherwise(
        F.concat(F.lit("api"), F.col("k").cast("string"), F.lit(".example.com"))).alias("host"))
    return per.withColumnRenamed("payee", "address").join(hosts, "address")


def wallet_keys(t: Tables):
    from tollgauge.plans.inputs import seller
    return t("supplier").selectExpr(f"{seller('s_suppkey')} as address", "s_suppkey as k")


def fresh_board(t: Tables, n: int = 30):
    return board.board_rows(board.window_rollup(stored_tape(t), n), t.services())


def board_of(t: Tables, n: int = 30):
    """The board as its mart has it."""
    return stored(t, f"board{n}", lambda: fresh_board(t, n))


def fresh_fold(t: Tables, n: int = 7):
    return board.fold_chain(board_of(t, n), board.host_rollup(second_chain_tape(t), n))


def folded_board(t: Tables, n: int = 7):
    return stored(t, f"folded_board{n}", lambda: fresh_fold(t, n))


# ---- transfers --------------------------------------------------------------------------
@query("decode_logs", "transfers", """
    select date, payer, payee, units, block, seq from transfers where chain = 'base'""")
def _(t):
    return flows.decode_logs(t.raw_logs()).select("date", "payer", "payee", "units", "block", "seq")


@query("topic_address_roundtrip", "transfers", """
    select seq, lower(payer) as address, '0x' || repeat('0', 24) || substr(payer, 3) as topic
    from transfers""")
def _(t):
    rows = t("transfers").select("seq", chain_fn.address_to_topic(F.col("payer")).alias("topic"))
    return rows.withColumn("address", chain_fn.topic_to_address(F.col("topic")))


@query("hex_units", "transfers", """
    select seq, case when seq % 11 = 0 then null else units end as units,
      case when seq % 11 = 0 then 0 else units end as units_or_zero from transfers""")
def _(t):
    data = F.when(F.col("seq") % 11 == 0, "0xzz").otherwise(
        F.concat(F.lit("0x"), F.lpad(F.lower(F.hex("units")), 64, "0")))
    return t("transfers").select(
        "seq", chain_fn.hex_to_units(data).alias("units"),
        chain_fn.hex_to_units(data, "zero").alias("units_or_zero"))


@query("drop_burn", "transfers", f"""
    select payee, count(*) as n from transfers where payee not in ({BURN_LIST}) group by payee""")
def _(t):
    return flows.drop_burn(t("transfers"), "payee").groupBy("payee").agg(F.count("*").alias("n"))


@query("tape_aggregate", "tape_in", """
    select date, address as payee, settlements, units, round_even(units / 1e6, 6) as usdc, unique_payers,
      repeat_payers, top_payer_share, top5_payer_share, payer_hhi, first_block, last_block from tape_in""")
def _(t):
    return flows.tape_aggregate(inflow(t), ["date"])


@query("outflow_aggregate", "outflow", """
    select payer, count(*) as transfers_out, sum(units)::bigint as units_out from outflow group by payer""")
def _(t):
    out = flows.outflow_from(flows.decode_logs(t.raw_logs()), t("tracked"))
    return flows.outflow_aggregate(out)


@query("merge_flows", "tape", "select * from tape")
def _(t):
    return tape(t)


@query("service_wallets", "tape services", """
    select origin as service, t.* from tape t join (
      select distinct origin, lower(unnest(string_split(wallets, ','))) as address from services) s using (address)""")
def _(t):
    return flows.service_wallets(t.services(), tape(t))


@query("service_rollup", "tape services", """
    select origin as service, sum(settlements)::bigint as settlements, round_even(sum(units) / 1e6, 6) as usdc,
      round_even(sum(units_out) / 1e6, 6) as usdc_out, round_even((sum(units) - sum(units_out)) / 1e6, 6) as usdc_net,
      sum(unique_payers)::bigint as unique_payers
    from tape t join (select distinct origin, lower(unnest(string_split(wallets, ','))) as address from services) s using (address)
    group by origin""")
def _(t):
    return flows.service_rollup(flows.service_wallets(t.services(), tape(t)))


@query("sample_velocity", "transfers", """
    with sides as (
        select payee as address, payer, payee, units, ts, seq from transfers
        union all select payer, payer, payee, units, ts, seq from transfers where payer <> payee),
      s as (select *, row_number() over (partition by address order by ts desc, seq desc) as rn from sides),
      f as (select address, count(*) as sampled, count(*) filter (payee = address) as settlements,
          count(distinct payer) filter (payee = address) as unique_payers, sum(units) filter (payee = address) as units,
          min(ts) filter (payee = address) as first_ts, max(ts) filter (payee = address) as last_ts
        from s where rn <= 100 group by address)
    select address, sampled, settlements, unique_payers, case when settlements > 0 then sampled >= 100 end as truncated,
      round_even(greatest(1e-9, (last_ts - first_ts) / 3600), 3) as window_hours, round_even(units / 1e6, 4) as usdc_in_sample,
      case when settlements > 0 then round_even(units / 1e6 / settlements, 6) end as avg_ticket, first_ts, last_ts,
      round_even((330000000 - last_ts) / 3600, 1) as hours_since_last,
      case when settlements > 1 then round_even(settlements / greatest(1e-9, (last_ts - first_ts) / 3600) * 24, 1)
           when settlements = 1 then 0.0 end as settlements_per_day,
      case when settlements > 1 then round_even(units / 1e6 / greatest(1e-9, (last_ts - first_ts) / 3600) * 24, 4)
           when settlements = 1 then 0.0 end as usd_per_day
    from f""")
def _(t):
    return flows.sample_velocity(wallet_history(t), 330000000)


def wallet_history(t: Tables):
    """Each transfer as it appears in the history of both its wallets."""
    rows = t("transfers").select("payer", "payee", F.col("units").cast("decimal(38,0)").alias("units"),
                                 "ts", "seq")
    sides = F.array_distinct(F.array("payee", "payer"))
    return rows.select(F.explode(sides).alias("address"), "*")


@query("velocity_rollup", "transfers services", """
    with sides as (
        select payee as address, payer, payee, units, ts, seq from transfers
        union all select payer, payer, payee, units, ts, seq from transfers where payer <> payee),
      s as (select *, row_number() over (partition by address order by ts desc, seq desc) as rn from sides),
      f as (select address, count(*) as sampled, count(*) filter (payee = address) as n,
          count(distinct payer) filter (payee = address) as up, sum(units) filter (payee = address) / 1e6 as usd,
          greatest(1e-9, (max(ts) filter (payee = address) - min(ts) filter (payee = address)) / 3600) as h,
          max(ts) filter (payee = address) as last_ts
        from s where rn <= 100 group by address having n > 0),
      w as (select distinct origin, lower(unnest(string_split(wallets, ','))) as address from services)
    select origin as service, sum(n)::bigint as settlements_sampled, max(up) as unique_payers,
      sum(case when n > 1 then round_even(n / h * 24, 1) else 0.0 end::decimal(28, 4))::double as settlements_per_day,
      sum(case when n > 1 then round_even(usd / h * 24, 4) else 0.0 end::decimal(28, 4))::double as usd_per_day,
      min(round_even(usd / n, 6)) as avg_ticket, min(round_even((330000000 - last_ts) / 3600, 1)) as hours_since_last,
      bool_or(sampled >= 100) as truncated
    from w join f using (address) group by origin""")
def _(t):
    return flows.velocity_rollup(flows.sample_velocity(wallet_history(t), 330000000), t.services())


@query("funders", "inflow", """
    select payer, count(distinct payee) as payees, count(*) as pays, round_even(sum(units) / 1e6, 6) as usdc,
      round_even(sum(units) / 1e6 / count(*), 6) as avg_payment, min(block) as first_block, max(block) as last_block
    from inflow group by payer having count(distinct payee) >= 5""")
def _(t):
    logs = flows.decode_logs(t.raw_logs(), "zero")
    return flows.funders(flows.inflow_to(logs, t("tracked")), 5)


DRILL = "0x" + f"{1048576 + 5:x}".rjust(40, "0")


@query("funder_detail", "inflow listing_prices", f"""
    with own as (select address, arg_min(host, ordinal) as host from (
        select ordinal, host, lower(json_extract_string(unnest(from_json(json_extract(doc, '$.accepts'), '["JSON"]')), '$.payTo')) as address
        from listing_prices) where address <> '' group by address)
    select payee, pays, coalesce(host, '?') as host from (
      select payee, count(*) as pays from inflow where payer = '{DRILL}' group by payee) p left join own on p.payee = own.address""")
def _(t):
    return flows.funder_detail(inflow(t), DRILL, flows.payto_owner(t.listings()))


@query("payto_owner", "listing_prices", """
    select address, arg_min(host, (ordinal, pos)) as host from (
        select ordinal, host, generate_subscripts(o, 1) as pos, lower(json_extract_string(unnest(o), '$.payTo')) as address
        from (select ordinal, host, from_json(json_extract(doc, '$.accepts'), '["JSON"]') as o from listing_prices))
    where address <> '' group by address""")
def _(t):
    return flows.payto_owner(t.listings())


_CENSUS = """
    with top as (select address, min(service) as service from owners group by address),
      p as (select payer, payee, count(*) as n, sum(units) as u from inflow where payee in (select address from top) group by all),
      b as (select payer as wallet, sum(u)::bigint as units, round_even(sum(u) / 1e6, 4) as usdc, sum(n)::bigint as payments,
          count(*) as distinct_services, arg_min(payee, (-n, payee)) as top_recipient, max(n) as top_recipient_payments
        from p group by payer)"""


def _top_services(t):
    return board.best_listing(t.services()).select("address", "service")


@query("buyer_census", "inflow owners", _CENSUS + """
    select b.*, service as top_recipient_service from b left join top on top.address = top_recipient""")
def _(t):
    return flows.buyer_census(inflow(t), _top_services(t))


@query("census_summary", "inflow owners", _CENSUS + """
    select count(*) as buyers, round_even(sum(usdc::decimal(28, 4))::double, 2) as total_usdc, sum(payments)::bigint as total_payments,
      round_even(max(usdc) / sum(usdc::decimal(28, 4))::double, 4) as top_buyer_share,
      round_even((select sum(usdc::decimal(28, 4)) from (select usdc from b order by usdc desc, wallet limit 5))::double
        / sum(usdc::decimal(28, 4))::double, 4) as top5_share
    from b""")
def _(t):
    return flows.census_summary(flows.buyer_census(inflow(t), _top_services(t)))


_BAL = """
    select sig, 'acc' || l_suppkey as account, block_time, failed,
      l_linenumber <> 7 as listed, q::double as before,
      case l_returnflag when 'N' then q + e::double / 1000 when 'R' then q - 0.5 else q::double end as after,
      case when l_linenumber = 1 then o_custkey::double * 1000 else o_custkey::double * 1000 - (case when l_returnflag = 'N' then e::double / 1000 else 0 end) end as p_after,
      o_custkey::double * 1000 as p_before, 'c' || o_custkey as owner from token_rows"""


@query("token_inflow", "token_rows", f"""
    select sig, account, case when listed then greatest(after - before, 0.0) else 0.0 end as delta,
      case when listed and after > before and p_before - p_after >= after - before - 1e-9 then owner end as payer
    from ({_BAL})""")
def _(t):
    return flows.token_inflow(token_transactions(t)).select("sig", "account", "delta", "payer")


def token_transactions(t: Tables):
    mint = F.when(F.col("l_linenumber") == 7, "OtherMint").otherwise(fixed.USDC_SOLANA)
    gain = F.col("e").cast("double") / 1000
    after = (F.when(F.col("l_returnflag") == "N", F.col("q") + gain)
             .when(F.col("l_returnflag") == "R", F.col("q") - F.lit(0.5)).otherwise(F.col("q").cast("double")))
    rich = F.col("o_custkey").cast("double") * 1000
    poorer = F.when((F.col("l_linenumber") != 1) & (F.col("l_returnflag") == "N"), rich - gain).otherwise(rich)

    def balance(index, m, owner, amount):
        return F.struct(F.lit(index).alias("accountIndex"), m.alias("mint"), owner.alias("owner"),
                        amount.cast("double").alias("uiAmount"))
    me, payer = F.concat(F.lit("s"), "l_suppkey"), F.concat(F.lit("c"), "o_custkey")
    usdc = F.lit(fixed.USDC_SOLANA)
    return t("token_rows").select(
        "sig", "block_time", "failed", F.concat(F.lit("acc"), "l_suppkey").alias("account"),
        F.array(F.concat(F.lit("acc"), "l_suppkey"), F.lit("payer")).alias("keys"),
        F.array(balance(0, mint, me, F.col("q")), balance(1, usdc, payer, rich)).alias("pre"),
        F.array(balance(0, mint, me, after), balance(1, usdc, payer, poorer)).alias("post"))


@query("wallet_inflow", "token_rows", f"""
    with d as (select account as wallet, failed, block_time, case when listed then greatest(after - before, 0.0) else 0.0 end as delta,
        case when listed and after > before and p_before - p_after >= after - before - 1e-9 then owner end as payer from ({_BAL}))
    select wallet, count(*) as settlements, round_even(sum(delta::decimal(20, 6))::double, 6) as usdc, count(distinct payer) as unique_payers
    from d where delta > 0 and not failed and block_time between 100000000 and 300000000 group by wallet""")
def _(t):
    credits = flows.token_inflow(token_transactions(t)).withColumnRenamed("account", "wallet")
    return flows.wallet_inflow(credits, 100000000, 300000000)


# ---- tape over time ---------------------------------------------------------------------
@query("window_rollup", "window7", "select * from window7")
def _(t):
    return board.window_rollup(stored_tape(t), 7)


@query("window_coverage", "tape", """
    select 40::bigint as days_wanted, count(*) as days_have, count(*) >= 40 as complete, min(date) as first_date, max(date) as last_date
    from (select distinct date from tape order by date desc limit 40)""")
def _(t):
    return board.window_coverage(tape(t), 40)


@query("tape_gaps", "tape", """
    select d::date::varchar as missing_date from (
      select unnest(generate_series(min(date)::date, max(date)::date, interval 1 day)) as d from tape)
    where d::date::varchar not in (select date from tape)""")
def _(t):
    return changes.tape_gaps(tape(t))


@query("wallet_trend", "tape", """
    with e as (select min(date) as a, max(date) as z from tape),
      p as (select address, coalesce(max(round_even(usdc, 2)) filter (date = (select a from e)), 0.0) as first_usdc,
          coalesce(max(round_even(usdc, 2)) filter (date = (select z from e)), 0.0) as last_usdc from tape group by address)
    select *, case when last_usdc > first_usdc * 1.15::double then 'grew' when last_usdc < first_usdc * 0.85::double then 'shrank' else 'flat' end as direction
    from p""")
def _(t):
    return changes.wallet_trend(tape(t))


@query("wallet_days", "tape tracked", """
    with d as (select distinct date from tape), a as (select distinct address from tracked)
    select a.address, d.date, coalesce(round_even(sum(usdc), 2), 0.0) as usdc from a join d on true
      left join tape t on t.address = a.address and t.date = d.date group by 1, 2""")
def _(t):
    return changes.wallet_days(stored_tape(t), t("tracked"))


# ---- board ------------------------------------------------------------------------------
@query("best_listing", "owners", "select address, service, host, grade, shares from owners")
def _(t):
    return board.best_listing(t.services())


@query("attribute_addresses", "window7 owners", """
    select w.address, settlements, coalesce(service, substr(w.address, 1, 10) || '…') as service, coalesce(host, '') as host,
      coalesce(shares > 1, false) as shared_wallet from window7 w left join owners o using (address)""")
def _(t):
    rows = board.attribute(board.window_rollup(stored_tape(t), 7), t.services())
    return rows.select("address", "settlements", "service", "host", "shared_wallet")


@query("board_rows", "board7", "select * from board7")
def _(t):
    return fresh_board(t, 7)


@query("organic_score", "tape", f"""
    select date, address, {score_columns(payers='unique_payers')} from tape""")
def _(t):
    s = organic_score(F.col("unique_payers"), F.col("repeat_payers"), F.col("top_payer_share"),
                      F.col("payer_hhi"), F.col("settlements"))
    return tape(t).withColumn("s", s).select(
        "date", "address", F.col("s.score").alias("organic_score"),
        F.col("s.breadth").alias("organic_breadth"), F.col("s.dispersion").alias("organic_dispersion"),
        F.col("s.repeat").alias("organic_repeat"), F.col("s.confidence").alias("organic_confidence"))


@query("demand_label", "tape", f"""
    select date, address, {demand_case(payers='unique_payers')} as demand from tape""")
def _(t):
    return tape(t).select("date", "address", demand_label(
        F.col("unique_payers"), F.col("top_payer_share"), F.col("payer_hhi")).alias("demand"))


@query("clamp_shares", "tape", """
    select date, address, greatest(0.0, least(1.0, usdc_net / nullif(usdc, 0)))::double as kept_share from tape where usdc <> 0""")
def _(t):
    return tape(t).where("usdc <> 0").select(
        "date", "address", clamp01(F.col("usdc_net") / F.col("usdc")).alias("kept_share"))


@query("directory_demand", "window30", """
    select address, case when settlements = 0 then 'quiet' when payers >= 10 then 'established'
        when settlements >= 500 and payers <= 2 then 'concentrated' when payers >= 3 then 'traction' else 'thin' end as tier,
      case when settlements = 0 then 'no settlement on chain in the last 24h'
        when payers >= 10 then payers || ' distinct wallets paid it on chain'
        when settlements >= 500 and payers <= 2 then format('{:,}', settlements) || ' settlements from ' || payers || ' wallet(s)'
        when payers >= 3 then payers || ' distinct wallets paid it on chain'
        else format('{:,}', settlements) || ' settlement(s) from ' || payers || ' wallet(s)' end as why
    from window30""")
def _(t):
    d = directory_demand(F.nullif("settlements", F.lit(0)), F.col("payers"))
    return board.window_rollup(stored_tape(t), 30).select("address", d["tier"].alias("tier"), d["why"].alias("why"))


@query("second_chain_hosts", "sol_hosts", "select * from sol_hosts")
def _(t):
    return board.host_rollup(second_chain_tape(t), 7)


_FOLD = f"""
    with heads as (select host, min(address) as address from board7 where host <> '' group by host),
      x as (select s.host as h, heads.address as a, round_even(s.units / 1e6, 4) as u, s.settlements as n, s.payers as p
            from sol_hosts s left join heads using (host)),
      folded as (
        select b.address, b.service, b.host, b.demand, case when h is null then usdc else round_even(usdc + u, 4) end as usdc,
          usdc_out, case when h is null then kept else round_even(round_even(usdc + u, 4) - usdc_out, 4) end as kept,
          case when h is null then payout_pct when round_even(usdc + u, 4) <> 0 then round_even(100 * usdc_out / round_even(usdc + u, 4), 1) end as payout_pct,
          circular, settlements + coalesce(n, 0) as settlements, payers,
          case when h is null then avg_ticket else round_even(round_even(usdc + u, 4) / (settlements + n), 6) end as avg_ticket,
          organic_score, demand_measured_on, base_usdc, coalesce(u, 0.0) as other_usdc
        from board7 b left join x on b.address = a and b.host = h
        union all
        select null, h, h, {demand_case('p', 'null::double', 'null::double')}, u, 0.0, u, null, false, n, p, round_even(u / n, 6), null, 'solana', 0.0, u
        from x where a is null)"""
_FOLD_COLS = ("address", "service", "host", "demand", "usdc", "usdc_out", "kept", "payout_pct", "circular",
              "settlements", "payers", "avg_ticket", "organic_score", "demand_measured_on", "base_usdc", "other_usdc")


@query("fold_chain", "board7 sol_hosts", _FOLD + "select * from folded")
def _(t):
    return fresh_fold(t).select(*_FOLD_COLS)


@query("market_totals", "board7 sol_hosts", _FOLD + """
    select round_even(sum(usdc::decimal(28, 4))::double, 2) as total_usdc, round_even(sum(kept::decimal(28, 4))::double, 2) as total_kept,
      sum(settlements)::bigint as total_settlements,
      round_even(coalesce(sum(usdc::decimal(28, 4)) filter (host = ''), 0)::double, 2) as unattributed_usdc from folded""")
def _(t):
    return board.market_totals(folded_board(t))


@query("board_rank", "board7 sol_hosts", _FOLD + """
    select *, row_number() over (order by usdc desc, host, address) as rank from folded where host <> ''
    order by usdc desc, host, address limit 60""")
def _(t):
    return board.board_rank(folded_board(t)).select(*_FOLD_COLS, "rank")


@query("chain_sum_errors", "board7 sol_hosts", _FOLD + """
    , bent as (select * replace (usdc + case when settlements % 2 = 0 then 0.5::double else 0 end as usdc) from folded)
    select host, address, abs(base_usdc + other_usdc - usdc) as diff from bent where abs(base_usdc + other_usdc - usdc) >= 0.02""")
def _(t):
    bent = F.col("usdc") + F.when(F.col("settlements") % 2 == 0, 0.5).otherwise(0.0)
    return board.chain_sum_errors(folded_board(t).withColumn("usdc", bent))


@query("market_summary", "board7 sol_hosts tape", _FOLD + """
    select round_even(sum(usdc::decimal(28, 4))::double, 2) as total_usdc, sum(settlements)::bigint as total_settlements,
      (select min(date) from tape) as tape_from, (select max(date) from tape) as tape_to from folded""")
def _(t):
    from tollgauge.operators import catalog
    return catalog.market_summary(board.market_totals(folded_board(t)), stored_tape(t))


@query("top_services_by_revenue", "board7 sol_hosts", _FOLD + """
    select host, address, usdc as usdc_received, settlements as payments, payers as paying_wallets, payout_pct as sends_back_pct,
      demand as demand_shape, organic_score as organic_demand_score from folded where host <> '' order by usdc desc, host, address limit 10""")
def _(t):
    from tollgauge.operators import catalog
    return catalog.top_services(folded_board(t), "revenue", 10)


@query("top_services_by_demand", "board7 sol_hosts", _FOLD + """
    select host, address, usdc as usdc_received, settlements as payments, payers as paying_wallets, payout_pct as sends_back_pct,
      demand as demand_shape, organic_score as organic_demand_score from folded where host <> '' and organic_score is not null
    order by organic_score desc, host, address limit 10""")
def _(t):
    from tollgauge.operators import catalog
    return catalog.top_services(folded_board(t), "organic_demand", 10)


@query("board_with_grades", "board7 graded_grades", """
    select b.host, b.address, b.usdc, g.grades from board7 b left join graded_grades g on b.host = g.service""")
def _(t):
    rows = ratings.with_grades(board_of(t, 7), t.posts())
    return rows.select("host", "address", "usdc", grade_text().alias("grades"))


def grade_text(col: str = "grades"):
    return F.array_join(F.transform(col, lambda g: F.concat(
        g["grade"], F.lit(" x"), g["n"].cast("string"))), "|")


@query("claim_vs_chain", "listing_prices board30", """
    with c as (select host, sum(case when page_id % 7 = 0 then 0 else (page_id * 37) % 900 end)::bigint as calls30d from listing_prices group by host),
      linked as (select address, arg_min(host, ordinal) as host from (select ordinal, host,
          lower(json_extract_string(unnest(from_json(json_extract(doc, '$.accepts'), '["JSON"]')), '$.payTo')) as address from listing_prices) where address <> '' group by 1),
      s as (select l.host, sum(b.settlements)::bigint as settlements from board30 b join linked l using (address) group by l.host)
    select host, calls30d, settlements from c join s using (host) where calls30d > 0 and settlements > 0""")
def _(t):
    listings = t.listings()
    owned = flows.payto_owner(listings)
    seen = board.window_rollup(stored_tape(t), 30).join(owned, "address")
    return board.claim_vs_chain(registry.declared_call(listings), seen)


# ---- the second source of sellers ---------------------------------------------------------
_REC = """
    with r as (select *, k as o from seller_records union all select * replace (k + 1000000 as ordinal), k from seller_records where k % 6 = 0),
      d as (select recipient, tx, arg_min(units, ordinal) as units, arg_min(buyers, ordinal) as buyers, min(ordinal) as ordinal,
              arg_min(origin_text, ordinal) as origin_text from r group by recipient, tx),
      h as (select lower(split_part(replace(replace(unnest(string_split(origin_text, ',')), 'https://', ''), 'http://', ''), '/', 1)) as host,
              units, tx, buyers, ordinal from d),
      a as (select host, round_even(arg_min(units, (-units, ordinal)) / 1e6, 6) as usd, arg_min(tx, (-units, ordinal)) as tx,
              arg_min(buyers, (-units, ordinal)) as buyers from h group by host),
      u as (select tx, round_even(usd, 4) as ru, buyers, arg_min(host, (length(host), host)) as host, arg_min(usd, (length(host), host)) as usd
            from a group by all)"""


@query("dedupe_sellers", "seller_records", _REC + "select ordinal, tx, units::bigint as units, buyers, recipient as recipients from d")
def _(t):
    return sellers.dedupe_sellers(t.seller_records()).select("ordinal", "tx", "units", "buyers", "recipients")


def alias_hosts(t: Tables):
    return sellers.alias_revenue(sellers.dedupe_sellers(t.seller_records()))


@query("alias_revenue", "seller_records", _REC + "select host, usd, tx, buyers from a")
def _(t):
    return alias_hosts(t)


@query("dedupe_aliases", "seller_records", _REC + "select host, usd, tx, buyers from u")
def _(t):
    return sellers.dedupe_aliases(alias_hosts(t))


@query("seller_headline", "seller_records", _REC + """
    select count(*) as sellers, sum(tx)::bigint as tx, round_even(sum(usd::decimal(28, 6))::double, 2) as usd,
      round_even(100.0::double * max(tx) / sum(tx)::double, 2) as top1_share, round_even(sum(usd::decimal(28, 6))::double / sum(tx)::double, 6) as avg_ticket from u""")
def _(t):
    return sellers.seller_headline(sellers.dedupe_aliases(alias_hosts(t)))


@query("seller_scatter", "seller_records", _REC + """
    select host, tx, round_even(usd, 2) as usd, buyers, round_even(usd / greatest(tx, 1), 6) as avg_ticket from u where tx >= 20 and usd > 0""")
def _(t):
    return sellers.seller_scatter(sellers.dedupe_aliases(alias_hosts(t)))


@query("universe", "listing_docs seller_records", _REC + """,
      b as (select regexp_extract(resource, '^https?://([^/?#]+)', 1) as host, count(*) as breadth from listing_docs group by 1)
    select host, coalesce(breadth, 0) as breadth, coalesce(usd, 0.0) as usd,
      case when breadth is not null and usd is not null then 'both' when breadth is not null then 'registry only' else 'sellers only' end as class
    from b full join a using (host)""")
def _(t):
    return registry.universe(t.listings(), alias_hosts(t))


# ---- shared wallets -----------------------------------------------------------------------
_COMP = """
    WITH RECURSIVE e as (select distinct 'svc:' || origin as a, 'addr:' || lower(unnest(string_split(wallets, ','))) as b from services where wallets <> ''),
      g as (select a as x, b as y from e union select b, a from e union select 'svc:' || origin, 'svc:' || origin from services),
      reach(n, m) as (select x, x from g union select r.n, g.y from reach r join g on r.m = g.x),
      comp as (select substr(n, 5) as origin, min(m) as component from reach where n like 'svc:%' group by n)"""


@query("service_components", "services", _COMP + "select origin, component from comp")
def _(t):
    return graph.service_components(t.services())


@query("extend_components", "services", _COMP + "select origin, component from comp")
def _(t):
    """Half of the services first, then the edges of the others on top of their components."""
    services = t.services()
    half = F.crc32("origin") % 2 == 0
    before = graph.components(graph.service_edges(services.where(half)))
    after = graph.extend_components(before, graph.service_edges(services.where(~half)))
    return graph.services_of(after)


@query("component_flags", "services", _COMP + """,
      f as (select distinct component, unnest(list_filter([case when grade is null then 'ungraded' end, case when service is null then 'unnamed' end,
        case when len(list_filter(string_split(wallets, ','), lambda w: w <> '')) > 1 then 'several wallets' end], lambda x: x is not null)) as flag from services join comp using (origin))
    select component, flag from f""")
def _(t):
    return graph.component_flags(service_members(t))


def service_members(t: Tables):
    comp = graph.service_components(t.services())
    settled = flows.service_rollup(flows.service_wallets(t.services(), board_tape(t)))
    flags = F.array_compact(F.array(
        F.when(F.col("grade").isNull(), "ungraded"), F.when(F.col("service").isNull(), "unnamed"),
        F.when(F.size("payto") > 1, "several wallets")))
    rows = t.services().withColumn("flags", flags).join(comp, "origin")
    return rows.join(settled.select(F.col("service").alias("origin"), "settlements", "usdc",
                                    F.col("unique_payers").alias("payers")), "origin", "left")


def board_tape(t: Tables):
    return board.newest_days(tape(t), 1)


_MEMBERS = _COMP + """,
      st as (select origin, sum(settlements)::bigint as settlements, round_even(sum(units) / 1e6, 6) as usdc, sum(unique_payers)::bigint as payers
        from (select distinct origin, lower(unnest(string_split(wallets, ','))) as address from services) s
        join (select * from tape where date = (select max(date) from tape)) t using (address) group by origin),
      mem as (select s.*, c.component, st.settlements, st.usdc, st.payers, lower(s.origin) as h,
          substr(replace(replace(lower(coalesce(service, '')), ' ', ''), '.', ''), 1, 6) as nm
        from services s join comp c using (origin) left join st using (origin)),
      rk as (select *, row_number() over (partition by component order by
          case when nm <> '' and contains(replace(replace(h, '-', ''), '.', ''), nm) then 0 else 1 end,
          """ + " + ".join(f"contains(h, '{w}')::int" for w in fixed.MEMBER_NOISE) + """,
          length(h) - length(replace(h, '-', '')), length(h), origin) as rn from mem)"""


@query("canonical_member", "services tape", _MEMBERS + """
    select component, max(origin) filter (rn = 1) as head, count(*) - 1 as also_listed,
      coalesce(string_agg(origin, '|' order by rn) filter (rn between 2 and 6), '') as also_names from rk group by component""")
def _(t):
    return graph.canonical_member(service_members(t))


@query("merge_services", "services tape", _MEMBERS + """,
      fl as (select distinct component, unnest([case when grade is null then 'ungraded' end, case when service is null then 'unnamed' end,
          case when contains(wallets, ',') then 'several wallets' end]) as f from mem),
      best as (select component, arg_min(settlements, (-settlements, origin)) as settlements, arg_min(usdc, (-settlements, origin)) as usdc,
          arg_min(payers, (-settlements, origin)) as payers from mem where settlements is not null group by component)
    select r.component, r.origin as head, b.settlements, b.usdc, b.payers,
      case when b.settlements is null then 'quiet' when b.payers >= 10 then 'established' when b.settlements >= 500 and b.payers <= 2 then 'concentrated'
        when b.payers >= 3 then 'traction' else 'thin' end as demand,
      coalesce((select string_agg(f, '|' order by f) from fl where fl.component = r.component and f is not null), '') as flags
    from rk r left join best b using (component) where rn = 1""")
def _(t):
    return graph.merge_services(service_members(t)).select(
        "component", "head", "settlements", "usdc", "payers", "demand", "flags")


@query("distinct_wallet_totals", "services tape", """
    with st as (select origin, sum(settlements)::bigint as settlements, round_even(sum(units) / 1e6, 6) as usdc, sum(unique_payers)::bigint as payers
        from (select distinct origin, lower(unnest(string_split(wallets, ','))) as address from services) s
        join (select * from tape where date = (select max(date) from tape)) t using (address) group by origin),
      k as (select s.origin, list_sort(string_split(wallets, ','))::varchar as ws, wallets, settlements, usdc, payers from services s left join st using (origin)),
      u as (select ws, arg_min(settlements, (-settlements, -payers, origin)) as n, arg_min(usdc, (-settlements, -payers, origin)) as usd from k
            where settlements is not null and wallets <> '' group by ws)
    select (select coalesce(sum(n), 0) from u)::bigint as settlements, (select coalesce(sum(usd::decimal(28, 6)), 0) from u)::double as usdc,
      round_even(100.0::double * max(settlements) / greatest(1, (select sum(n) from u)), 0)::bigint as top_share,
      count(*) filter (settlements is null) as quiet from k""")
def _(t):
    return graph.distinct_wallet_totals(service_members(t))


@query("seller_quantiles", "transfers", """
    with s as (select payee, units, row_number() over (partition by payee order by units) - 1 as i, count(*) over (partition by payee) as n from transfers)
    select payee, max(units::double) filter (i = case when n >= 10 then greatest(0, floor(n * 0.1)::bigint - 1) else 0 end) as p10,
      max(units::double) filter (i = case when n >= 10 then least(n - 1, floor(n * 0.9)::bigint) else n - 1 end) as p90 from s group by payee""")
def _(t):
    return ranks.positional_quantiles(t("transfers"), ["payee"], "units")
