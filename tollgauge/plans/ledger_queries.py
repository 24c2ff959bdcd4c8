"""Registered queries: accuracy grading, receipts and the ledger."""

from pyspark.sql import functions as F

from tollgauge import fixed_values as fixed
from tollgauge.operators import accuracy, archive, receipts, shapes
from tollgauge.operators.shapes import json_nodes, numeric_candidates
from tollgauge.plans.inputs import Tables
from tollgauge.plans.marts import stored
from tollgauge.plans.oracle_parts import quoted
from tollgauge.plans.registry import query
from tollgauge.plans.response_queries import rows as conformance_of
from tollgauge.plans.response_queries import settled

TS = "1998-12-31"


# ---- accuracy ---------------------------------------------------------------------------
def config(t: Tables):
    """One accuracy rule per part type."""
    return t("part").select(F.col("p_type").alias("category")).distinct().select(
        "category", F.lit("pct").alias("kind"), F.lit(0.5).alias("band"), F.lit(500.0).alias("tol"),
        F.lit("bps").alias("unit"), F.lit(1.0).alias("lo"), F.lit(1e6).alias("hi"))


def fresh_graded(t: Tables):
    return accuracy.grade(t("quotes").select("category", "host", "url", "quoted", "ref", "payload"), config(t))


def graded(t: Tables):
    """Graded numbers as they are stored, without the responses they came from."""
    return stored(t, "graded", lambda: fresh_graded(t).drop("payload"))


@query("grade_values", "graded", "select url, category, value, field, dev from graded")
def _(t):
    return fresh_graded(t).select("url", "category", "value", "field", "dev")


@query("reference_value", "quotes", "select category, median(ref) as ref from quotes group by category")
def _(t):
    return accuracy.reference_value(t("quotes").select("category", F.col("ref").alias("value")))


@query("accuracy_summary", "graded", """
    select category, count(*) as called, count(value) as usable, (list_sort(list(abs(dev)) filter (value is not null)))[count(value) // 2 + 1] as median_abs_dev,
      arg_min(host, (-abs(dev), host, url)) filter (value is not null) as worst_host, max(abs(dev)) as worst_dev from graded group by category""")
def _(t):
    return accuracy.accuracy_summary(graded(t))


@query("accuracy_board", "graded", """
    select category, host, url, value, dev, quoted, abs(dev) as abs_dev, case when abs(dev) <= 500 then 'accurate' else 'off' end as verdict from graded where value is not null""")
def _(t):
    return accuracy.accuracy_board(graded(t)).drop("unit")


@query("most_accurate", "graded", """
    select host, url, value, dev, row_number() over (order by abs(dev), quoted, url) as rank from graded where value is not null and category = 'ECONOMY'
    order by abs(dev), quoted, url limit 10""")
def _(t):
    return accuracy.most_accurate(graded(t), "ECONOMY", 10).select("host", "url", "value", "dev", "rank")


@query("nearest_absolute", "quotes", """
    select url, case when abs(returned - ref) <= 100 then returned end as value from quotes""")
def _(t):
    rows = json_nodes(t("quotes"), "payload").withColumn("band", F.lit(100.0)).withColumn("kind", F.lit("abs"))
    found = shapes.nearest(numeric_candidates(rows, lo=1.0, hi=1e6), "ref", "band", "kind")
    return found.select("url", "value")


# ---- accuracy receipts --------------------------------------------------------------------
def graded_claims(t: Tables):
    return graded(t).select(
        "url", "host", "quoted", (F.col("quoted") > 0.002).alias("paid"),
        F.concat("category", F.lit(" price")).alias("metric"), F.col("value").alias("returned"),
        F.col("ref").alias("truth"), F.lit("retail list").alias("truth_source"),
        F.col("dev").alias("dev_value"), F.col("tol").alias("tol_value"), "unit", "field",
        F.lit(TS).alias("ts"))


_ACC = """
    with a as (select url, host, quoted > 0.002::double as paid, category || ' price' as metric, value as returned, ref as truth, dev as dev_value, field,
      case when value is null then 'inconclusive' when abs(dev) <= 500 then 'accurate' else 'off' end as status from graded)"""


@query("accuracy_receipts", "graded", _ACC + """
    select url, metric, returned, dev_value, field, status, case status when 'inconclusive' then 'no value returned to grade'
      when 'accurate' then 'within tolerance of the primary source' else 'outside tolerance of the primary source' end as why from a""")
def _(t):
    return receipts.receipts_from(graded_claims(t), "stock").select(
        "url", "metric", "returned", "dev_value", "field", "status", "why")


@query("daily_feed_receipts", "graded", _ACC + "select url, metric, status from a where returned is not null")
def _(t):
    return receipts.receipts_from(graded_claims(t), "lab").select("url", "metric", "status")


@query("guard_field", "quotes", """
    select url, case when n3 = 0 then null else returned end as returned,
      case when n3 = 0 then 'could not isolate a spot-price field; the closest match in the response was .data.volume24h, which is not a price' end as note from quotes""")
def _(t):
    named = t("quotes").select("url", "returned", F.lit(1.0).alias("dev_value"), F.when(
        F.col("n3") == 0, ".data.volume24h").otherwise(".last").alias("field"))
    return receipts.guard_field(named).select("url", "returned", "note")


@query("price_receipts", "graded", _ACC + """
    select url, case when field = '.data.last' then status else status end as status from a""")
def _(t):
    return receipts.receipts_from(graded_claims(t), "price").select("url", "status")


@query("verify_accuracy", "graded", _ACC + """
    select url, status, true as integrity, true as verdict from a""")
def _(t):
    made = receipts.receipts_from(graded_claims(t), "stock")
    return receipts.verify_accuracy(made).select("url", "status", "integrity", "verdict")


# ---- delivery receipts --------------------------------------------------------------------
def captures(t: Tables):
    content = F.concat_ws("|", "url", "stdout")
    return t("captures").withColumn("capture_id", F.sha2(content, 256))


def pointers(t: Tables):
    return archive.capture_pointers(captures(t), "line")


def stored_pointers(t: Tables):
    """The pointers as they are stored: receipts of both kinds are linked through them."""
    return stored(t, "capture_pointers", lambda: pointers(t))


def fresh_delivery(t: Tables):
    return receipts.delivery_receipts(settled(t), stored_pointers(t), TS)


def delivery(t: Tables):
    """Delivery receipts as they are stored."""
    return stored(t, "delivery_receipts", lambda: fresh_delivery(t))


@query("link_capture_first", "calls", """
    select url, 'raw_' || day || '.jsonl' as raw_file, o_orderkey as raw_line from calls""")
def _(t):
    calls = t("calls").select("url", F.col("paid_tx").alias("tx"))
    return receipts.link_capture_first(calls, captures(t)).select("url", "raw_file", "raw_line")


@query("link_capture_last", "calls recaptured", """
    select url, case when o_orderkey in (select last_key from recaptured) then 'raw_9999-01-01.jsonl' else 'raw_' || day || '.jsonl' end as raw_file, paid_tx as raw_tx from calls""")
def _(t):
    return receipts.link_capture_last(t("calls").select("url"), captures(t)).select("url", "raw_file", "raw_tx")


_POINTED = """
    with c as (select url, file, line, tx, sha256(url || '|' || stdout) as capture_id from captures)"""


@query("capture_pointers", "captures", _POINTED + """
    select capture_id, url, min(file) as first_file, max(file) as last_file, count(distinct tx) as payments from c group by capture_id, url""")
def _(t):
    found = pointers(t).select("capture_id", "url", F.col("first.file").alias("first_file"), F.col("last.file").alias("last_file"),
                               F.col("tx").isNotNull().cast("bigint").alias("payments"))
    return found


def of_source(t: Tables, kind: str):
    """Every call as a row of one kind of comparison, in the form that comparison lands its rows in."""
    run = t("calls").select(
        "url", "host", "quoted", F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderkey") % 4 == 1).alias("paid"),
        F.when(F.col("o_orderkey") % 5 != 0, F.concat(F.lit("$"), F.col("o_custkey").cast("string"), F.lit(".25"))).alias("n"),
        (F.col("o_orderkey") % 201 - 100).cast("string").alias("d"),
        F.when(F.col("o_orderkey") % 7 == 0, ".data.volume24h").otherwise(".price").alias("field"),
        F.concat("day", F.lit("T06:00:00Z")).alias("generated"), F.lit(40000.5).alias("ref"))
    if kind == "price":
        named = F.when(F.col("url").contains("1"), F.array(F.lit("alpha"), F.lit("beta"))).otherwise(F.array().cast("array<string>"))
        return run.withColumnsRenamed({"n": "price", "d": "dev_bps", "ref": "reference_end"}).withColumns({
            "symbol": F.lit("BTC"), "reference_sources": named})
    if kind == "balance":
        return run.withColumnsRenamed({"n": "usdc", "ref": "chain_usdc_end"}).withColumns({
            "dev": F.col("d").cast("double") / 1000, "target": F.lit("0x1234567890abcdef")})
    if kind == "stock":
        return run.withColumnsRenamed({"n": "price", "d": "dev_bps", "ref": "reference"}).withColumn("symbol", F.lit("AAPL"))
    return run.withColumnsRenamed({"n": "value", "d": "dev", "ref": "reference"}).withColumns({
        "category": F.lit("weather"), "metric": F.when(F.col("paid"), "temperature"), "source": F.lit("a model"),
        "tol": F.when(F.col("paid"), 5.0), "unit": F.lit("F")})


@query("receipt_pointers", "captures calls", _POINTED + """,
      d as (select url, arg_min(capture_id, (file, line)) as first_id, min(file) as first_file, arg_max(capture_id, (file, line)) as last_id, max(file) as last_file from c group by url)
    select 'delivery' as kind, k.url, first_id as raw_id, first_file as raw_file, k.paid_tx as tx from calls k join d using (url)
    union all select 'accuracy', k.url, last_id, last_file, k.paid_tx from calls k join d using (url)""")
def _(t):
    both = receipts.as_ledger(delivery(t)).unionByName(receipts.as_ledger(
        receipts.receipts_of_source(of_source(t, "stock"), "stock", stored_pointers(t))))
    return both.select("kind", "url", "raw_id", "raw_file", "tx")


@query("receipts_of_sources", "calls", """
    with r as (select url, o_orderkey as k, day as ts, o_orderkey % 4 = 1 as said, o_orderkey % 4 = 0 as unsaid, case when o_orderkey % 5 <> 0 then o_custkey + 0.25::double end as v,
        (o_orderkey % 201 - 100)::double as d, o_orderkey % 7 = 0 as bad from calls),
      s as (
        select url, 'BTC price' as metric, case when contains(url, '1') then 'median of alpha/beta' else 'median of primary exchanges' end as truth_source, said and not unsaid as paid,
          case when not bad then v end as returned, case when not bad then d end as dev, 50.0::double as tol, 'bps' as unit, ts,
          case when bad then 'could not isolate a spot-price field; the closest match in the response was .data.volume24h, which is not a price' else 'no value returned to grade' end as note from r
        union all select url, 'USDC balance of 0x1234…cdef on Base', 'Base chain balanceOf (latest block)', said or unsaid, v, d / 1000, 0.01, 'USDC', ts, 'no value returned to grade' from r
        union all select url, 'AAPL real-time stock price', 'FMP real-time quote', said or unsaid, v, d, 50.0, 'bps', ts, 'no value returned to grade' from r
        union all select url, case when said then 'temperature' else 'weather' end, 'a model', said or unsaid, v, d, case when said then 5.0 else 100.0 end, 'F', ts, '' from r where v is not null)
    select url, metric, truth_source, paid, returned, tol as tol_value, unit, ts, case when returned is null then 'inconclusive' when abs(dev) <= tol then 'accurate' else 'off' end as status,
      case when returned is null then note when abs(dev) <= tol then 'within tolerance of the primary source' else 'outside tolerance of the primary source' end as why from s""")
def _(t):
    out = None
    for kind in receipts.ADAPTERS:
        made = receipts.receipts_of_source(of_source(t, kind), kind).select(
            "url", "metric", "truth_source", "paid", "returned", "tol_value", "unit", "ts", "status", "why")
        out = made if out is None else out.unionByName(made)
    return out


@query("delivery_receipts", "settled", f"""
    select url, status, why, missing, extra, why = '{fixed.WHY_CONFIRMED}' as reverified,
      case when why = '{fixed.WHY_CONFIRMED}' or contains(why, 're-verify') then 'two-call reconcile' else 'single call' end as decided_by,
      'raw_' || day || '.jsonl' as raw_file from settled""")
def _(t):
    return fresh_delivery(t).select("url", "status", "why", "missing", "extra", "reverified", "decided_by", "raw_file")


_KIND = "case type when 'OBJECT' then 'object' when 'ARRAY' then 'array' when 'VARCHAR' then 'string' when 'BOOLEAN' then 'boolean' when 'NULL' then 'null' when 'DOUBLE' then 'number' else 'integer' end"


@query("content_id", "calls", """
    select url, 'rcpt_' || substr(sha256('{"host":"' || host || '","note":null,"price":"' || asked || '","promised":["' || replace(promise, ',', '","') || '"]}'), 1, 16) as id from calls""")
def _(t):
    facts = F.struct("host", F.lit(None).cast("string").alias("note"), F.col("asked").alias("price"),
                     F.split("promise", ",").alias("promised"))
    return t("calls").select("url", receipts.content_id(facts).alias("id"))


_VERIFIED = f"""
    with x as (select s.url, s.status, s.why, s.v,
        case when contains(s.why, 're-verify') then null else
          (case when c.v = 8 then 'inconclusive' else c.jstatus end) = s.status end as verdict from settled s join verdicts c using (url))"""


@query("verify_receipts", "settled verdicts", _VERIFIED + """
    select url, status, true as integrity, verdict, case when v not in (7, 8) then true end as raw from x""")
def _(t):
    return receipts.verify_delivery(delivery(t), captures(t)).select(
        "url", "status", "integrity", "verdict", "raw")


@query("tampered_receipts", "settled", """
    select url, promised_n <> 1 as broken from (select url, len(want) as promised_n from settled)""")
def _(t):
    cut = delivery(t).withColumn("promised", F.slice("promised", 1, 1))
    return receipts.verify_delivery(cut, captures(t)).select(
        "url", (~F.col("integrity")).alias("broken"))


@query("ledger_self_check", "settled verdicts graded", _VERIFIED + """,
      a as (select case when value is null then 'inconclusive' when abs(dev) <= 500 then 'accurate' else 'off' end as status from graded)
    select (select count(*) from x) + (select count(*) from a) as receipts, (select count(*) from x) + (select count(*) from a) as integrity_ok,
      (select count(verdict) from x) + (select count(*) from a) as verdicts_checked, (select count(*) filter (verdict) from x) + (select count(*) from a) as verdicts_ok,
      (select count(*) filter (not verdict) from x) as mismatches,
      (select count(*) filter (status in ('delivered', 'short')) from x) + (select count(*) filter (status in ('accurate', 'off')) from a) as claims,
      (select count(*) filter (status in ('delivered', 'short')) from x) + (select count(*) filter (status in ('accurate', 'off')) from a) as claims_reproduced""")
def _(t):
    one = receipts.verify_delivery(delivery(t), captures(t))
    two = receipts.verify_accuracy(receipts.receipts_from(graded_claims(t), "stock"))
    return receipts.ledger_self_check(one.unionByName(two))


def ledger_pair(t: Tables):
    """A ledger of first verdicts, and the receipts of the re-verified short calls."""
    known = stored_pointers(t)
    before = receipts.delivery_receipts(conformance_of(t), known, TS)
    late = settled(t).where(F.col("why").isin(fixed.WHY_CLEARED, fixed.WHY_CONFIRMED, fixed.WHY_UNCONFIRMED))
    return before, receipts.delivery_receipts(late, known, TS)


@query("supersede", "settled", "select url, status, why from settled")
def _(t):
    before, fresh = ledger_pair(t)
    return receipts.supersede(before, fresh).select("url", "status", "why")


@query("receipt_summary", "settled calls", """
    with p as (select s.status, case when s.v <> 8 then ltrim(asked, '$')::double end as ch, least(round_even(s.quoted * 1.25::double + 0.0001::double, 6), 0.01::double) as cap from settled s join calls using (url))
    select 'delivery' as kind, status, count(*) as n, count(*) as with_raw,
      coalesce(sum(case when status = 'short' and ch <= cap * 2 then ch::decimal(20, 8) end), 0)::double as paid_for_short from p group by status""")
def _(t):
    return receipts.receipt_summary(delivery(t))
