"""Registered queries: responses, their shapes and the judgement of paid calls."""

from pyspark.sql import functions as F

from tollgauge import fixed_values as fixed
from tollgauge.functions import numbers
from tollgauge.operators import accuracy, conformance, shapes
from tollgauge.plans.inputs import Tables
from tollgauge.plans.oracle_parts import any_of, quoted
from tollgauge.plans.registry import query


# ---- coercion and arithmetic ------------------------------------------------------------
@query("to_number", "", """
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, case l_linenumber % 4 when 3 then null else cast(l_extendedprice as bigint) + 0.25 end::double as value,
      l_linenumber % 4 = 1 as truthy, case when l_linenumber % 4 = 3 then null else cast(l_quantity as bigint) end as whole from lineitem""")
def _(t):
    k = F.col("l_linenumber") % 4
    units = F.bround("l_extendedprice", 0).cast("bigint")
    text = (F.when(k == 0, F.concat(F.lit("$"), F.format_number(units, 0), F.lit(".25")))
            .when(k == 1, F.concat(F.lit(" "), units.cast("string"), F.lit(".25")))
            .when(k == 2, F.concat(F.lit("+"), units.cast("string"), F.lit(".25"))).otherwise("n/a 12"))
    flag = F.when(k == 1, " Yes ").when(k == 2, "0").otherwise("nope")
    whole = F.when(k == 3, "x").otherwise(F.col("l_quantity").cast("string"))
    return t("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", numbers.to_number(text).alias("value"),
        numbers.to_bool(flag).alias("truthy"), numbers.to_int(whole).alias("whole"))


@query("call_cap", "checks", """
    select url, least(round_even(adv_amount * 1.25::double + 0.0001::double, 6), 0.01) as cap,
      case when live_amount * 3 <= least(round_even(adv_amount * 1.25::double + 0.0001::double, 6), 0.01::double) * 2 then live_amount * 3 end as charged
    from checks where adv_amount is not null""")
def _(t):
    cap = numbers.call_cap(F.col("adv_amount"))
    return t("checks").where("adv_amount IS NOT NULL").select(
        "url", cap.alias("cap"), numbers.clean_charged(F.col("live_amount") * 3, cap).alias("charged"))


@query("deviation", "quotes", """
    select url, round_even(10000.0::double * (returned - ref) / ref, 1) as bps, round_even(returned - ref, 4) as absolute from quotes""")
def _(t):
    v, r = F.col("returned"), F.col("ref")
    return t("quotes").select("url", numbers.deviation(v, r, F.lit("pct")).alias("bps"),
                              numbers.deviation(v, r, F.lit("abs")).alias("absolute"))


@query("to_fahrenheit", "", """
    select event_id, case user_id % 3 when 0 then 'C' when 1 then 'F' else case when v between -60 and 45 then 'C' when v between 32 and 130 then 'F' else '?' end end as unit,
      case when user_id % 3 = 1 or (user_id % 3 = 2 and v > 45 and v <= 130) then v else round_even(v * 9 / 5 + 32, 1) end as f
    from (select *, floor(value) as v from events)""")
def _(t):
    key = F.when(F.col("user_id") % 3 == 0, "temp_c").when(F.col("user_id") % 3 == 1, "temp_f").otherwise("temp")
    value = F.floor("value").cast("double")
    unit = numbers.temperature_unit(key, value)
    return t("events").select("event_id", unit.alias("unit"), numbers.to_fahrenheit(value, unit).alias("f"))


@query("epoch_age", "", """
    select event_id, case when user_id % 4 = 3 then null else round_even(1706000000 - floor(epoch(ts)), 1)::double end as age from (select *, date_trunc('second', ts) as ts0 from events)""")
def _(t):
    sec = F.unix_seconds(F.col("ts").cast("timestamp")).cast("double")
    reading = (F.when(F.col("user_id") % 4 == 1, sec * 1000).when(F.col("user_id") % 4 == 3, sec / 1000)
               .otherwise(sec))
    return t("events").select("event_id", numbers.age_seconds(reading, 1706000000).alias("age"))


# ---- reading a response -----------------------------------------------------------------
_KIND = "case type when 'OBJECT' then 'object' when 'ARRAY' then 'array' when 'VARCHAR' then 'string' when 'BOOLEAN' then 'boolean' when 'NULL' then 'null' when 'DOUBLE' then 'number' else 'integer' end"


@query("json_shape", "calls", f"""
    with r as (select url, fullkey, path, type, key from calls, json_tree(calls.payload) where json_valid(payload)),
      s as (select url, regexp_replace(replace(replace(substr(fullkey, 2), '[0]', '/~*'), '.', '/'), '"', '', 'g') as p, {_KIND} as type from r where not regexp_matches(fullkey, '\\[[1-9]'))
    select url, p as path, length(p) - length(replace(p, '/', '')) as depth, type from s where length(p) - length(replace(p, '/', '')) <= 3""")
def _(t):
    return shapes.shape_rows(shapes.json_shape(t.calls(), "payload"), "url")


@query("untyped_leaves", "calls", f"""
    select url, '/price' as path from calls where v = 0 and o_custkey % 5 = 0""")
def _(t):
    shaped = shapes.json_shape(t.calls(), "payload")
    leaked = F.transform("shape", lambda s: F.struct(s["path"].alias("path"), F.when(
        (s["path"] == "/price") & (F.col("o_custkey") % 5 == 0), "63127.97").otherwise(s["type"]).alias("type")))
    rows = shapes.shape_rows(shaped.withColumn("shape", leaked), "url")
    return shapes.untyped_leaves(rows).select("url", "path")


@query("publishable", "calls", "select url from calls where not (v = 0 and o_custkey % 5 = 0)")
def _(t):
    shaped = shapes.json_shape(t.calls(), "payload")
    leaked = F.transform("shape", lambda s: F.struct(s["path"].alias("path"), F.when(
        (s["path"] == "/price") & (F.col("o_custkey") % 5 == 0), "63127.97").otherwise(s["type"]).alias("type")))
    rows = shapes.shape_rows(shaped.withColumn("shape", leaked), "url")
    return shapes.publishable(t.calls().select("url"), rows, "url")


@query("delivered_fields", "judged", "select url, coalesce(array_to_string(list_sort(got), '|'), '') as fields from judged")
def _(t):
    return shapes.delivered_fields(t.calls(), "payload").select("url", "fields")


@query("judge", "verdicts", f"""
    select url, jstatus as status, array_to_string(case jstatus when 'inconclusive' then list_sort(want) when 'short' then lacking else [] end, '|') as missing,
      array_to_string(case jstatus when 'inconclusive' then [] else bonus end, '|') as extra,
      case jstatus when 'delivered' then '' when 'short' then 'missing ' || len(lacking) || ' promised field(s)'
        else case when k1 is null then '{fixed.WHY_UNREADABLE}' else '{fixed.WHY_ERROR_OBJECT}' end end as why, jstatus = 'delivered' as conforms from verdicts""")
def _(t):
    return shapes.judge(t.calls(), "payload", "expect").select(
        "url", "status", "missing", "extra", "why", "conforms")


@query("judge_stored_shape", "verdicts", "select url, jstatus as status, jstatus = 'delivered' as conforms from verdicts")
def _(t):
    shaped = shapes.json_shape(t.calls(), "payload")
    return shapes.judge_shape(shaped, "shape", "expect").select("url", "status", "conforms")


@query("find_payment", "calls", "select url, paid_tx as tx from calls")
def _(t):
    return shapes.find_payment(t.calls().drop("tx"), "stdout").select("url", "tx")


@query("split_envelope", "calls", """
    select url, v <> 8 as ok, v <> 8 as paid, paid_tx as tx, case when v <> 8 then asked end as price, case when v = 8 then 502 else 200 end::bigint as http_status,
      case when v = 8 then '502 bad gateway' end as error from calls""")
def _(t):
    return shapes.split_envelope(t.calls().select("url", "stdout")).select(
        "url", "ok", "paid", "tx", "price", "http_status", "error")


_LEAVES = """select url, fullkey, key, type, case when type = 'VARCHAR' then trim(value::varchar, '"') else value::varchar end as text
    from calls, json_tree(calls.payload) where json_valid(payload) and path is not null and fullkey <> '$' and not regexp_matches(fullkey, '\\]$')"""
_NUM = "case when type in ('DOUBLE', 'UBIGINT', 'BIGINT') then text::double when type = 'VARCHAR' then try_cast(ltrim(replace(trim(text), ',', ''), '$') as double) end"


@query("numeric_candidates", "calls", f"""
    with l as ({_LEAVES}), n as (select url, replace(substr(fullkey, 2), '"', '') as path, replace(lower(key), '_', '') as k, {_NUM} as value from l)
    select url, path, value, {any_of('k', fixed.VALUE_HINTS)} as named from n where value > 1 and value < 1e7""")
def _(t):
    nodes = shapes.json_nodes(t.calls(), "payload")
    rows = shapes.numeric_candidates(nodes, lo=1.0, hi=1e7)
    return rows.select("url", F.inline("candidates")).drop("at")


@query("fee_candidates", "calls", f"""
    with l as ({_LEAVES}), n as (select url, replace(substr(fullkey, 2), '"', '') as path, key, {_NUM} as value from l)
    select url, path, key, value from n where {any_of('lower(key)', fixed.FEE_HINTS)} and value > 0 and value < 1e6""")
def _(t):
    rows = shapes.fee_candidates(shapes.json_nodes(t.calls(), "payload"))
    return rows.select("url", F.inline("fees"))


@query("response_staleness", "calls", """
    select url, case when v = 9 then (1800000000 - 1700000000 - o_orderkey)::double end as age_s,
      case when v = 9 and abs(o_orderkey - 4000) < 5000 then 4000 - o_orderkey end as block_delta from calls""")
def _(t):
    nodes = shapes.json_nodes(t.calls(), "payload")
    rows = shapes.block_delta(shapes.staleness(nodes, 1800000000), [30004000])
    return rows.select("url", "age_s", "block_delta")


@query("temperature_candidates", "calls", "select url, '.result.temp_c' as path, 21.5::double as value, 'C' as unit from calls where v = 9")
def _(t):
    rows = shapes.temperature_candidates(shapes.json_nodes(t.calls(), "payload"))
    return rows.select("url", F.inline("temps"))


@query("classify_screen", "calls", f"""
    select url, case when not json_valid(payload) or json_type(payload) not in ('OBJECT', 'ARRAY') then 'unclear'
      when v = 9 then (case when o_custkey % 2 = 0 then 'flagged' else 'clear' end)
      when {any_of('b', fixed.SCREEN_HIGH_RISK)} then 'flagged'
      when {any_of('b', fixed.SCREEN_LOW_RISK)} then (case when not {any_of('b', ('sanction', 'ofac'))} or contains(b, 'false') then 'clear' else 'unclear' end)
      when {any_of('b', fixed.SCREEN_CLEAR_WORDS)} then 'clear' when {any_of('b', fixed.SCREEN_HIT_WORDS)} then 'flagged' else 'unclear' end as screen
    from (select *, lower(payload) as b from calls)""")
def _(t):
    nodes = shapes.json_nodes(t.calls(), "payload")
    return shapes.classify_screen(nodes, "payload").select("url", "screen")


@query("screening_misses", "calls", """
    select host, 'addr' || o_custkey as address, case when not json_valid(payload) or v in (5, 7, 8) then 'unclear' when v = 9 then 'clear' else 'unclear' end as screen
    from calls where o_custkey % 2 = 1""")
def _(t):
    results = shapes.classify_screen(shapes.json_nodes(t.calls(), "payload"), "payload").select(
        "host", F.concat(F.lit("addr"), F.col("o_custkey").cast("string")).alias("address"), "screen")
    labels = t("customer").select(
        F.concat(F.lit("addr"), F.col("c_custkey").cast("string")).alias("address"),
        F.when(F.col("c_custkey") % 2 == 1, "sanctioned").otherwise("clean").alias("expect"))
    return accuracy.screening_misses(results, labels)


@query("retarget_input", "", """
    select c_custkey, 'New York' as city, '40.7' as lat, '7' as days, '0xtarget' as wallet from customer""")
def _(t):
    given = F.create_map(F.lit("City"), F.col("c_name"), F.lit("lat"), F.lit("1"), F.lit("days"), F.lit("7"),
                         F.lit("wallet"), F.col("c_mktsegment"))
    out = shapes.retarget(given, {"New York": ("location", "city", "place", "q", "query", "name"),
                                  "40.7": fixed.LATITUDE_FIELDS, "0xtarget": fixed.ADDRESS_FIELDS})
    return t("customer").select("c_custkey", out["City"].alias("city"), out["lat"].alias("lat"),
                                out["days"].alias("days"), out["wallet"].alias("wallet"))


@query("retarget_place", "", """
    select c_custkey, 'New York' as city, '40.7128' as lat, '-74.006' as lng, 'New York' as q, '7' as days from customer""")
def _(t):
    given = F.create_map(F.lit("City"), F.col("c_name"), F.lit("Latitude"), F.lit("1"), F.lit("lng"), F.col("c_mktsegment"),
                         F.lit("q"), F.col("c_mktsegment"), F.lit("days"), F.lit("7"))
    out = shapes.retarget_place(given, "New York", "40.7128", "-74.006")
    return t("customer").select("c_custkey", out["City"].alias("city"), out["Latitude"].alias("lat"), out["lng"].alias("lng"),
                                out["q"].alias("q"), out["days"].alias("days"))


# ---- conformance ------------------------------------------------------------------------
def envelopes(t: Tables):
    calls = t.calls().select("o_orderkey", "url", "host", "quoted", "expect", "ms", "day", "stdout", "payload2")
    return shapes.split_envelope(calls)


def rows(t: Tables):
    """Judged paid calls with their stored shape."""
    judged = conformance.conformance_rows(envelopes(t))
    return shapes.json_shape(judged, "payload")


def settled(t: Tables):
    """Judged calls after the second call of every short one."""
    first = rows(t)
    retry = shapes.judge(t.calls().select("url", F.col("payload2").alias("payload"), "expect"),
                         "payload", "expect")
    return conformance.reconcile(first, retry)


@query("conformance_rows", "conf calls", """
    select c.url, c.host, status, missing, extra, why, status = 'delivered' as conforms, c.ok as paid, false as free, c.tx
    from conf c""")
def _(t):
    return rows(t).select("url", "host", "status", "missing", "extra", "why", "conforms", "paid", "free", "tx")


@query("charged_amounts", "calls", """
    with p as (select url, quoted, case when v <> 8 then ltrim(asked, '$')::double end as c, least(round_even(quoted * 1.25::double + 0.0001::double, 6), 0.01::double) as cap from calls)
    select url, quoted, case when c <= cap * 2 then c end as charged from p""")
def _(t):
    return rows(t).select("url", "quoted", "charged")


@query("reconcile", "settled", "select url, status, missing, extra, why, status = 'delivered' as conforms from settled")
def _(t):
    return settled(t).select("url", "status", "missing", "extra", "why", "conforms")


@query("verified_only", "conf", "select url, status from conf where status in ('delivered', 'short')")
def _(t):
    return conformance.verified(rows(t)).select("url", "status")


@query("run_summary", "conf calls", """
    with p as (select c.url, c.status, c.ok, c.quoted, case when k.v <> 8 then ltrim(asked, '$')::double end as ch, least(round_even(c.quoted * 1.25::double + 0.0001::double, 6), 0.01::double) as cap
        from conf c join calls k using (url))
    select count(*) as called, count(*) filter (status = 'delivered') as delivered, count(*) filter (ok) as paid, 0::bigint as free,
      count(*) filter (ok and status = 'delivered') as paid_and_delivered,
      count(*) filter (ch <= cap * 2 and ch > quoted * 1.001::double) as overcharged from p""")
def _(t):
    return conformance.run_summary(rows(t))


@query("delivery_counts", "settled", """
    select host, count(*) filter (status = 'delivered') as ok, count(*) filter (status = 'short') as short, count(*) filter (status = 'inconclusive') as inconclusive from settled group by host""")
def _(t):
    return conformance.delivery_counts(settled(t))


@query("latest_verdict", "conf settled", """
    select host, url, status from settled where status in ('delivered', 'short')
    union all select host, url, c.status from conf c where c.status in ('delivered', 'short') and url in (select url from settled where status = 'inconclusive')""")
def _(t):
    early = rows(t).withColumn("file", F.lit("conformance_1")).withColumn("ordinal", F.lit(0))
    late = settled(t).withColumn("file", F.lit("conformance_2")).withColumn("ordinal", F.lit(0))
    cols = ("host", "url", "status", "file", "ordinal")
    return conformance.latest_verdict(early.select(*cols).unionByName(late.select(*cols))).select(
        "host", "url", "status")


@query("untested", "checks conf", """
    select distinct origin from checks where origin not in (select host from conf where status = 'inconclusive')""")
def _(t):
    cands = t("checks").select(F.col("origin").alias("url")).distinct()
    done = shapes.held(rows(t), "status").where("status = 'inconclusive'").select(F.col("host").alias("url"))
    return conformance.untested(cands, done).select(F.col("url").alias("origin"))


@query("recall_targets", "conf captures", """
    select url from conf where status = 'short' and url not in (select url from captures where file = 'raw_9999-01-01.jsonl')""")
def _(t):
    """Short verdicts to call again, without those the newest capture file has."""
    base, newest = rows(t), t("captures").where("file = 'raw_9999-01-01.jsonl'")
    return conformance.recall_targets(base.select("url"), shapes.held(base, "status").where("status = 'short'"), newest)


def _regrade(t):
    old = rows(t).withColumn("conforms", F.col("ms") % 2 == 0)
    return conformance.regrade(old)


_RG = "with r as (select *, ms % 2 = 0 as was, payload like '{%' and v <> 8 as usable, case when v = 8 then 'inconclusive' else jstatus end as now0 from verdicts)"


@query("regrade_clean", "verdicts", _RG + "select url, jstatus as status from r where usable")
def _(t):
    return _regrade(t)[0].select("url", "status")


@query("regrade_recall", "verdicts", _RG + "select url, host, quoted from r where not usable")
def _(t):
    return _regrade(t)[1].select("url", "host", "quoted")


@query("regrade_flips", "verdicts", _RG + """
    select url, host, case when was then 'delivered' else 'failed' end as was, jstatus as now from r where usable and (jstatus = 'delivered') <> was""")
def _(t):
    return _regrade(t)[2]


@query("regrade_summary", "verdicts", _RG + """
    select count(*) filter (usable and jstatus = 'delivered') as delivered, count(*) filter (usable and jstatus = 'short') as short,
      count(*) filter (usable and jstatus = 'inconclusive') as inconclusive, count(*) filter (usable and (jstatus = 'delivered') <> was) as flips,
      count(*) filter (not usable) as recall, count(distinct host) filter (not usable) as recall_hosts from r""")
def _(t):
    return conformance.regrade_summary(*_regrade(t))


@query("regrade_monotone", "verdicts conf", """
    select c.url, case when v.k1 is not null and c.v <> 8 and v.jstatus in ('delivered', 'short') and len(v.lacking) < len(v.want) then v.jstatus else 'short' end as status,
      array_to_string(case when v.k1 is not null and c.v <> 8 and v.jstatus in ('delivered', 'short') and len(v.lacking) < len(v.want) then v.lacking else list_sort(v.want) end, '|') as missing
    from conf c join verdicts v using (url)""")
def _(t):
    overstated = rows(t).withColumn("status", F.lit("short")).withColumn("missing", F.array_sort("promised")) \
        .withColumn("conforms", F.lit(False))
    return conformance.regrade_monotone(overstated).select("url", "status", "missing")


@query("new_shorts", "conf", "select url from conf where status = 'short' and ms % 7 = 0")
def _(t):
    after = rows(t)
    before = after.withColumn("status", F.when(F.col("ms") % 7 == 0, "delivered").otherwise(F.col("status")))
    return conformance.new_shorts(before, after)
