"""Registered queries: tables that are landed, read back and used, and inputs no cut may change."""

import uuid

from pyspark.sql import functions as F

from tollgauge.operators import archive, checks, flows, guards, receipts, shapes
from tollgauge.plans.inputs import CUR_DATE, PREV_DATE, Tables
from tollgauge.plans.ledger_queries import ledger_pair
from tollgauge.plans.money_queries import board_of, second_chain_tape, stored_tape
from tollgauge.plans.registry import query
from tollgauge.sources import landed, storage
from tollgauge.streaming import streams


def _place(t: Tables, name: str) -> str:
    return f"{storage.shared_folder(t.spark)}/landed/{name}-{uuid.uuid4().hex}"


@query("read_logs", "transfers", """
    select payer, payee, units, block, count(*) as n from transfers where chain = 'base' group by all""")
def _(t):
    path = _place(t, "logs")
    landed.write_logs(t.raw_logs().select("topics", "data", "blockNumber"), path)
    rows = flows.decode_logs(landed.read_logs(t.spark, path))
    return rows.groupBy("payer", "payee", "units", "block").agg(F.count("*").alias("n"))


@query("rejected_logs", "transfers", """
    select seq, case seq % 10 when 0 then 'amount above 124 bits' when 1 then 'amount' when 2 then 'block' end as reason
    from transfers where chain = 'base' and seq % 10 in (0, 1, 2)""")
def _(t):
    k = F.col("seq") % 10
    logs = t.raw_logs().withColumns({
        "data": F.when(k == 0, F.concat(F.lit("0x"), F.repeat(F.lit("f"), 40))).when(k == 1, "0xzz").otherwise(F.col("data")),
        "blockNumber": F.when(k != 2, F.col("blockNumber"))})
    return flows.rejected_logs(logs).select("seq", "reason")


@query("captures_round_trip", "calls", "select url, 'raw_' || day as file, md5(stdout) as content from calls")
def _(t):
    path, empty = _place(t, "captures"), F.lit("")
    rows = t("calls").select(F.concat("day", F.lit("T00:00")).alias("ts"), "url", F.lit("GET").alias("method"),
                             empty.alias("request_body"), F.lit(0).alias("returncode"), "stdout", empty.alias("stderr"))
    landed.append_captures(rows, path)
    return landed.read_captures(t.spark, path).select("url", "file", F.md5("stdout").alias("content"))


@query("ledger_round_trip", "settled", "select url, status, why from settled")
def _(t):
    path = _place(t, "ledger")
    before, fresh = ledger_pair(t)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in before.schema.fields)
    landed.write_ledger(before, path)
    landed.write_ledger(receipts.supersede(landed.read_ledger(t.spark, path, schema), fresh, ranged=True), path)
    return landed.read_ledger(t.spark, path, schema).select("url", "status", "why")


@query("stream_ledger", "settled", "select url, status, why from settled")
def _(t):
    path = _place(t, "receipts")
    before, fresh = ledger_pair(t)
    fresh.write.parquet(f"{path}/in")
    stream = t.spark.readStream.schema(fresh.schema).parquet(f"{path}/in")
    streams.stream_ledger(stream, f"{path}/table", f"{path}/checkpoint")
    return streams.current_ledger(t.spark, f"{path}/table", before).select("url", "status", "why")


@query("write_partition", "transfers", """
    select date, count(*) * case when date = (select max(date) from transfers) then 2 else 1 end as n from transfers group by date""")
def _(t):
    path, rows = _place(t, "days"), t("transfers").select("date", "seq")
    storage.write_partition(rows, path)
    last = rows.join(rows.agg(F.max("date").alias("date")), "date", "left_semi")
    storage.write_partition(last.unionByName(last), path)
    return t.spark.read.parquet(path).groupBy(F.col("date").cast("string").alias("date")).agg(F.count("*").alias("n"))


@query("deep_numbers", "orders", """
    select o_orderkey, '.a.a.a.a.a.a.a.b[1].a.price' as path, o_orderkey + 0.5::double as value from orders""")
def _(t):
    inner = F.concat(F.lit('{"b":[{"a":{}},{"a":{"price":'), F.col("o_orderkey").cast("string"), F.lit('.5}}]}'))
    payload = F.concat(F.lit('{"a":' * 7), inner, F.lit("}" * 7))
    nodes = shapes.json_nodes(t("orders").select("o_orderkey", payload.alias("payload")), "payload")
    return shapes.numeric_candidates(nodes).select("o_orderkey", F.inline("candidates")).select("o_orderkey", "path", "value")


@query("judge_wide_shape", "orders", """
    select o_orderkey, case when o_orderkey % 2 = 0 then 'delivered' else 'short' end as live,
      case when o_orderkey % 2 = 0 then 'delivered' else 'short' end as stored from orders""")
def _(t):
    fields = F.transform(F.sequence(F.lit(10), F.lit(75)), lambda i: F.concat(F.lit('"k'), i.cast("string"), F.lit('":1')))
    kept = F.when(F.col("o_orderkey") % 2 == 0, fields).otherwise(F.slice(fields, 1, 60))
    rows = t("orders").select("o_orderkey", F.concat(F.lit("{"), F.array_join(kept, ","), F.lit("}")).alias("payload"),
                              F.array(F.lit("k11"), F.lit("k75")).alias("expect"))
    live = shapes.judge(shapes.json_shape(rows, "payload"), "payload", prefix="live_")
    both = shapes.judge_shape(live, prefix="stored_")
    return both.select("o_orderkey", F.col("live_status").alias("live"), F.col("stored_status").alias("stored"))


@query("guarded_marts", "board7 probe_mart snapshots", f"""
    select 'board' as mart, (select count(*) from board7) as stored, '' as refused
    union all select 'probe', (select count(*) from probe_mart), ''
    union all select 'index', (select count(*) from snapshots where date = '{CUR_DATE}'),
      'got 0 rows against ' || (select count(*) from snapshots where date = '{PREV_DATE}') || ' before (floor 0.7x)'
    union all select 'day', 0, 'refusing to record an empty day'""")
def _(t):
    """Marts written through their guards; the index mart keeps its version when a truncated pull comes."""
    board, probe = board_of(t, 7), checks.probe_mart(t("checks"), t.origins())
    index, before = t.index(CUR_DATE), t.index(PREV_DATE).count()
    cut = index.where(F.lit(False))
    shrink = lambda df: guards.check_shrink(before, df.count(), 0.7)
    writes = (("board", board, (guards.check_not_empty,)), ("probe", probe, (guards.check_not_empty,)),
              ("index", index, ()), ("index", cut, (shrink,)), ("day", cut, (guards.check_not_empty,)))
    base, refused = _place(t, "marts"), {}
    for name, df, rules in writes:
        refused[name] = guards.write_guarded(df, f"{base}/{name}", *rules) or refused.get(name) or ""
    out = None
    for name, why in refused.items():
        held = bool(storage.versions(t.spark, f"{base}/{name}"))
        rows = storage.read_mart(t.spark, f"{base}/{name}") if held else t.spark.range(0)
        row = rows.agg(F.lit(name).alias("mart"), F.count("*").alias("stored"), F.lit(why).alias("refused"))
        out = row if out is None else out.unionByName(row)
    return out


# ---- landed files, read as they were landed ---------------------------------------------------
@query("read_registry", "listing_docs", """
    select resource, row_number() over (order by page_id) - 1 as ordinal, regexp_extract(lower(resource), '^https?://([^/:?#]+)', 1) as host from listing_docs""")
def _(t):
    """A snapshot in files of unequal size: its order is that of names and rows, not of reading."""
    path = _place(t, "registry")
    rows = t.listings().select("ordinal", "resource", "serviceName", "description", "tags", "accepts", "lastUpdated")
    dealt = rows.repartitionByRange(5, F.sqrt("ordinal")).sortWithinPartitions("ordinal").drop("ordinal")
    landed.write_snapshot(dealt, path)
    return landed.read_registry(t.spark, storage.current_version(t.spark, path), multiline=False).select("resource", "ordinal", "host")


@query("read_tape", "tape sol", """
    select 'base' as chain, date, address, settlements, units, unique_payers from tape
    union all select 'solana', date, wallet, settlements, units, unique_payers from sol""")
def _(t):
    """A document a day for each chain beside a broken one, read back as the tape."""
    path = _place(t, "settlements")
    facts = ("settlements", "usdc", "usdc_out", "usdc_net", "transfers_out", "unique_payers", "repeat_payers", "top_payer_share",
             "top5_payer_share", "payer_hhi", "first_block", "last_block")
    base = stored_tape(t).groupBy("date").agg(F.map_from_entries(F.collect_list(F.struct("address", F.struct(*facts)))).alias("by_address"))
    storage.write_named(base.withColumn("file", F.concat(F.lit("settlements_"), "date", F.lit(".json"))), path, "file")
    wallet = F.struct("settlements", (F.col("units") / 1e6).alias("usdc"), "unique_payers", "host")
    other = second_chain_tape(t).groupBy("date").agg(F.map_from_entries(F.collect_list(F.struct("address", wallet))).alias("by_wallet"))
    other = other.select(F.concat("date", F.lit(" 01:00:00")).alias("generated"), "by_wallet", "date").withColumn(
        "file", F.concat(F.lit("settlements_solana_"), "date", F.lit(".json"))).drop("date")
    storage.write_named(other, path, "file")
    broken = t.spark.createDataFrame([("{broken", "settlements_2099-01-01.json")], "value string, file string")
    storage.write_named(broken, path, "file", "text")
    one = landed.read_tape(t.spark, path).withColumn("chain", F.lit("base"))
    two = landed.read_tape(t.spark, path, "solana").withColumnRenamed("wallet", "address").withColumn("chain", F.lit("solana"))
    keep = ("chain", "date", "address", "settlements", "units", "unique_payers")
    return one.select(*keep).unionByName(two.select(*keep))


@query("snapshot_round_trip", "snapshots", f"""
    select date, url, host, service, descr, amount, calls30d, last_day from snapshots where date = '{CUR_DATE}'""")
def _(t):
    rows = t.index(CUR_DATE)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return landed.read_snapshot(t.spark, landed.write_snapshot(rows, _place(t, "snapshot")), schema)


@query("read_hits", "hits", """
    with h as (select event_id, (epoch_us(hit_ts) // 1000)::bigint as ts, tool, subject, client, event_id % 6 as part from hits),
      bad as (select part, min(event_id) as first_bad from h where event_id % 4001 = 4000 group by part)
    select ts, tool, subject, client from h left join bad using (part) where first_bad is null or event_id < first_bad""")
def _(t):
    """Six logs; some have an unreadable line, which ends what is believed of that log."""
    path = _place(t, "hits")
    rows = t("hits").select(
        "event_id", F.unix_millis(F.col("hit_ts").cast("timestamp")).alias("ts"), "tool", "subject", "client")
    line = F.when(F.col("event_id") % 4001 == 4000, F.lit('{"ts": oops')).otherwise(F.to_json(F.struct("ts", "tool", "subject", "client")))
    logs = rows.select("event_id", line.alias("value"), F.concat(F.lit("hits-"), (F.col("event_id") % 6).cast("string"), F.lit(".jsonl")).alias("file"))
    logs.repartition(6, "file").sortWithinPartitions("file", "event_id").drop("event_id").write.partitionBy("file").text(f"{path}/logs")
    return landed.read_hits(t.spark, f"{path}/logs", "part-*")


@query("captures_pointers_round_trip", "calls", """
    select url, 'raw_' || substr(day, 1, 7) || '-01' as file, paid_tx as tx, 1::bigint as pointers from calls""")
def _(t):
    """Pointers made of a landed archive stay when the same captures are landed again, in other files."""
    path, empty = _place(t, "pointers"), F.lit("")
    month = F.concat(F.substring("day", 1, 7), F.lit("-01T"), F.substring("day", 9, 2))
    rows = t("calls").select(month.alias("ts"), "url", F.lit("GET").alias("method"),
                             empty.alias("request_body"), F.lit(0).alias("returncode"), "stdout", empty.alias("stderr"))
    landed.append_captures(rows, f"{path}/captures")
    before = archive.capture_pointers(archive.with_payment(landed.read_captures(t.spark, f"{path}/captures")))
    archive.write_pointers(before, f"{path}/table")
    landed.append_captures(rows.repartition(3), f"{path}/captures")
    after = archive.capture_pointers(archive.with_payment(landed.read_captures(t.spark, f"{path}/captures")))
    both = archive.read_pointers(t.spark, f"{path}/table").unionByName(after)
    return both.groupBy("url", F.col("first.file").alias("file"), "tx").agg(F.count_distinct("capture_id").alias("pointers"))


# ---- guards of runs ----------------------------------------------------------------------------
@query("guards_of_runs", "transfers tape verdicts", """
    with d as (select date, ((max(ts) - min(ts)) // 3600)::bigint as h, row_number() over (order by date desc) as rn from transfers where chain = 'base' group by date),
      w as (select (select h from d where rn = 1) as new_h, (select h from d where rn = 2) as old_h),
      p as (select count(*) as old_n, count(*) filter (settlements % 3 = 0) as new_n from tape),
      c as (select count(*) filter (v in (0, 3)) as n, count(*) filter (v in (0, 3) and jstatus <> 'delivered') as bad, count(*) filter (v = 0 and jstatus <> 'delivered') as bad0 from verdicts)
    select 'window' as guard, case when old_h > new_h then 'the stored day covers ' || old_h || 'h, this run only ' || new_h || 'h' else '' end as refused from w
    union all select 'window, longer', case when new_h > old_h then 'the stored day covers ' || new_h || 'h, this run only ' || old_h || 'h' else '' end from w
    union all select 'partial', 'stored total ' || old_n || ' against ' || new_n || ' with 4 failures' from p
    union all select 'partial, no failures', '' from p
    union all select 'canary', bad || ' of ' || n || ' known-good responses were not judged delivered' from c
    union all select 'canary, sound', case when bad0 = 0 then '' else 'broken' end from c""")
def _(t):
    """The guards that compare one run with what is stored, each with a run that passes and one that does not."""
    days = [r["h"] for r in t("transfers").where("chain = 'base'").groupBy("date").agg(
        F.floor((F.max("ts") - F.min("ts")) / 3600).alias("h")).orderBy(F.desc("date")).limit(2).collect()]
    total = stored_tape(t).agg(F.count("*").alias("old"), F.count_if(F.col("settlements") % 3 == 0).alias("new")).first()
    known = t.calls()
    runs = {
        "window": lambda: guards.check_window(days[1], days[0]), "window, longer": lambda: guards.check_window(days[0], days[1]),
        "partial": lambda: guards.check_partial(total["old"], total["new"], 4),
        "partial, no failures": lambda: guards.check_partial(total["old"], total["new"], 0),
        "canary": lambda: guards.check_canary(known.where("v in (0, 3)")), "canary, sound": lambda: guards.check_canary(known.where("v = 0"))}
    rows = []
    for name, run in runs.items():
        try:
            run()
            rows.append((name, ""))
        except guards.Refused as why:
            rows.append((name, str(why)))
    return t.spark.createDataFrame(rows, "guard string, refused string")
