"""Inputs of the registered queries, derived from the given tables.

Each input is one SELECT whose text Spark and the oracle engine both read, so the two sides
start from the same rows and only the operators under test differ. Nested columns travel as
JSON or comma text and are parsed with declared schemas on the Spark side.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgauge import fixed_values as fixed
from tollgauge import schemas
from tollgauge.functions.chain import address_to_topic
from tollgauge.functions.text import parse_pairs
from tollgauge.functions.urls import host_of

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

#: a scan of so many bytes is dealt out, unless it has so many tasks a core; a task then gets about so many bytes
DEALT_FROM, SCAN_WAVES, DEALT_BYTES = 1 << 20, 3, 4 << 20

AS_OF = "2002-01-01"
SPLIT = "1998-01-01"
PREV_DATE, CUR_DATE = "1997-12-31", "1998-12-31"

BURN = fixed.BURN_ADDRESSES[1]
ZERO = fixed.BURN_ADDRESSES[0]

# phrases that give listings a subject; every rule family is hit by some
PHRASES = (
    "weather forecast for any city", "gas price oracle in gwei", "wallet balance on base",
    "realtime BTC price feed", "stock quote and stock price, aapl", "web search for agents",
    "whois domain lookup", "email validation and deliverability", "text to speech voice",
    "gift card topup", "invoice builder", "on-chain transaction history", "image generation",
    "forex exchange rate", "fortune and dice game", "supply chain enrichment")


def seller(k: str) -> str:
    return (f"(case when {k} = 3 then '{BURN}' "
            f"else '0x' || lpad(lower(hex({k} + 4096)), 40, '0') end)")


def _payer(k: str) -> str:
    return f"('0x' || lpad(lower(hex({k} + 1048576)), 40, '0'))"


def _case(expr: str, values, default: str = "null") -> str:
    arms = " ".join(f"when {i} then {v}" for i, v in enumerate(values))
    return f"(case {expr} {arms} else {default} end)"


def _text(values) -> list[str]:
    return [f"'{v}'" for v in values]


DAY_INDEX = ("cast((year(l_shipdate) - 1992) * 372 + (month(l_shipdate) - 1) * 31 "
             "+ day(l_shipdate) as bigint)")
CENTS = "cast(round(l_extendedprice * 100) as bigint)"
WALLET_KEY = ("(case when cast(floor(page_id * 2 / 5) as bigint) % 10 = 9 "
              "then cast(floor(page_id * 2 / 5) as bigint) - 1 "
              "else cast(floor(page_id * 2 / 5) as bigint) end)")
PAYER_KEY = "(case when l_suppkey % 7 = 0 then 0 else o_custkey % 97 end)"
PRICE_TEXT = "(cast(cast(floor({c} / 100) as bigint) as string) || '.' || lpad(cast({c} % 100 as string), 2, '0'))"
A = "((page_id * 7919) % 20000)"
MIXED = f"('0x' || upper(substr({seller('wk')}, 3)))"


def _option(amount: str, asset: str, network: str, payto: str) -> str:
    return (f"'{{{{\"amount\":\"' || {amount} || '\",\"asset\":\"{asset}\",\"network\":\"{network}\","
            f"\"payTo\":\"' || {payto} || '\"}}}}'")


_BASE = _option("a", fixed.USDC_BASE, "eip155:8453", MIXED)
_ACCEPTS = _case("page_id % 4", [
    f"'[' || {_BASE} || ']'",
    f"'[' || {_option('(a * 2)', fixed.USDC_SOLANA, 'solana:mainnet', chr(39) + 'Sol' + chr(39) + ' || wk')}"
    f" || ',' || {_BASE} || ']'",
    f"'[' || {_option('(a * 1000000)', '0xfeed', 'eip155:56', chr(39) + '0xFEED' + chr(39) + ' || wk')}"
    f" || ',' || {_option('(a + 500)', fixed.USDC_BASE, 'eip155:8453', MIXED)} || ']'",
    f"'[' || {_option(chr(39) + 'abc' + chr(39), fixed.USDC_BASE, 'eip155:8453', MIXED)}"
    f" || ',{{{{\"maxAmountRequired\":\"' || cast(floor(a / 2) as bigint) || '\",\"asset\":\"{fixed.USDC_BASE}\","
    f"\"network\":\"eip155:137\",\"recipient\":\"0xREC' || wk || '\"}}}}]'",
])
_QUALITY = ("(case when page_id % 7 = 0 then 'null' else '{{\"l30DaysTotalCalls\":' || (page_id * 37) % 900 || "
            "',\"l30DaysUniquePayers\":' || (page_id * 13) % 40 || ',\"lastCalledAt\":\"2026-07-' || "
            "lpad(cast(page_id % 28 + 1 as string), 2, '0') || 'T06:00:00Z\"}}' end)")
_SCHEMA = "(case when page_id % 5 = 0 then 'null' else '{{\"z\":1,\"a\":' || page_id % 30 || '}}' end)"
_EXAMPLE = _case("page_id % 6", _text([
    '{{"price":1,"symbol":"x"}}', '{{"ts":1,"price":2,"change":3}}', '{{"balance":"5"}}',
    '{{"b":1,"a":2}}', '{{}}']), "'null'")
_INPUT = _case("page_id % 3", _text([
    '{{"method":"GET"}}', '{{"method":"post","body":{{"q":1}}}}', '{{"method":"POST"}}']))
_DOC = (f"'{{{{\"accepts\":' || accepts || ',\"quality\":' || {_QUALITY} || "
        f"',\"extensions\":{{{{\"bazaar\":{{{{\"schema\":' || {_SCHEMA} || ',\"info\":{{{{\"input\":' || {_INPUT} || "
        f"',\"output\":{{{{\"example\":' || {_EXAMPLE} || '}}}}}}}}}}}}}}}}' || "
        f"',\"metadata\":{{{{\"provider\":{{{{\"name\":\"prov' || page_id % 6 || '\",\"category\":\"' || "
        f"{_case('page_id % 4', _text(['Data', 'Tools', 'AI']), chr(39) * 2)} || '\"}}}}}}}}' || "
        f"',\"lastUpdated\":\"2026-08-0' || (page_id % 5 + 1) || 'T09:00:00Z\"}}}}'")

# ---- captured calls: one paid call per order --------------------------------------------
O_CENTS = "cast(round(o_totalprice * 100) as bigint)"
_FULL = ("'{{\"price\":' || " + PRICE_TEXT.format(c="oc") + " || ',\"symbol\":\"BTC\",\"ts\":' || (1700000000 + o_orderkey) || "
         "',\"amount\":\"$' || o_orderkey % 9 || ',000.5\",\"balance\":' || o_custkey || ',\"currency\":\"USD\",\"id\":' || o_orderkey || "
         "',\"updated\":\"now\",\"volume\":' || o_orderkey % 100 || '}}'")
_PAYLOADS = [
    _FULL,
    f"'{{{{\"ok\":true,\"data\":' || {_FULL} || '}}}}'",
    f"'{{{{\"observations\":[' || {_FULL} || ',{{{{\"x\":1}}}}],\"links\":{{{{}}}}}}}}'",
    "'{{\"symbol\":\"BTC\",\"ts\":' || (1700000000 + o_orderkey) || '}}'",
    "'{{\"error\":\"bad request\",\"code\":400}}'",
    "'\"upstream timeout\"'",
    f"'[' || {_FULL} || ']'",
    "'null'",
    "'null'",
    "'{{\"result\":{{\"inner\":{{\"price\":' || " + PRICE_TEXT.format(c="oc") + " || ',\"block_number\":' || (30000000 + o_orderkey) || "
    "',\"gasPrice\":\"0.0' || (o_orderkey % 9 + 1) || '\"}},\"temp_c\":21.5,\"sanctioned\":' || "
    "(case when o_custkey % 2 = 0 then 'true' else 'false' end) || '}},\"screened\":true,\"timestamp\":' || (1700000000 + o_orderkey) || '000,\"id\":7}}'",
]
_PROMISES = {
    "1-URGENT": "price,symbol,ts", "2-HIGH": "price,symbol", "3-MEDIUM": "balance,price,symbol,updated",
    "4-NOT SPECIFIED": "id,price"}
_PROMISE = ("(case o_orderpriority " + " ".join(f"when '{k}' then '{v}'" for k, v in _PROMISES.items())
            + " else 'amount,currency,price,symbol,volume' end)")
_PRICE_ASKED = ("(case when o_orderkey % 97 = 0 then '$1915.21' when o_orderkey % 50 = 0 "
                "then '$0.' || lpad(cast(cast(floor((o_orderkey % 900 + 100) * 11 / 10) as bigint) as string), 5, '0') "
                "else '$0.' || lpad(cast(o_orderkey % 900 + 100 as string), 5, '0') end)")
_ENVELOPE = ("'{{\"success\":true,\"data\":' || {p} || ',\"metadata\":{{\"payment\":{{\"success\":true,\"transactionHash\":\"' || tx || "
             "'\"}},\"price\":\"' || asked || '\",\"statusCode\":200}}}}'")

_CHECK_LIVE = "(case when l_tax = 0.08 and l_discount >= 0.08 then p_retailprice / 100000 * 1.05 else p_retailprice / 100000 end)"

DERIVED: dict[str, tuple[tuple[str, ...], str]] = {
    "tracked": (("supplier",), f"select {seller('s_suppkey')} as address from {{supplier}}"),
    "transfers": (("lineitem", "orders"), f"""
        select cast(cast(date_trunc('quarter', l_shipdate) as date) as string) as date,
          case when l_linestatus = 'F' then 'base' else 'solana' end as chain, l_suppkey as supp,
          case when l_returnflag = 'R' then {seller('l_suppkey')} else {_payer(PAYER_KEY)} end as payer,
          case when l_returnflag = 'R' then {_payer(PAYER_KEY)} else {seller('l_suppkey')} end as payee,
          {CENTS} * 10000 as units, {DAY_INDEX} * 43200 + o_orderkey % 43200 as block,
          {DAY_INDEX} * 86400 + o_orderkey % 86400 as ts,
          l_orderkey * 100000 + l_linenumber * 10000 + l_partkey % 10000 as seq
        from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey"""),
    "services": (("supplier",), f"""
        select s_suppkey as ordinal,
          case when s_suppkey % 5 = 1 then 'svc-' || s_suppkey || '-git-main.vercel.app'
               else 'api' || s_suppkey || '.example.com' end as origin,
          case when s_suppkey % 6 = 0 then null else s_name end as service,
          {_case('s_suppkey % 4', _text(['A', 'B', 'C']))} as grade,
          case when s_suppkey % 10 = 9 then ''
               when s_suppkey = 5 then {seller('s_suppkey')} || ',{ZERO}'
               when s_suppkey % 4 = 1 then {seller('s_suppkey')} || ',' || {seller('(s_suppkey - 1)')}
               else {seller('s_suppkey')} end as wallets
        from {{supplier}}"""),
    "listing_text": (("pages",), f"""
        select *, {_ACCEPTS} as accepts from (
          select page_id, page_id as ordinal, url as resource, {A} as a, {WALLET_KEY} as wk,
            case when page_id % 9 = 0 then null else 'Service ' || page_id % 50 end as service_name,
            regexp_extract(html, '<title>(.*?)</title>', 1) || ' ' || {_case('page_id % 16', _text(PHRASES))} as descr,
            regexp_extract(url, '/([a-z][a-z])/', 1) as tag
          from {{pages}})"""),
    "listing_docs": (("listing_text",), f"select page_id, ordinal, resource, service_name, descr, tag, a, wk, accepts, {_DOC} as doc from {{listing_text}}"),
    "checks": (("lineitem", "part"), f"""
        select 'api' || l_orderkey || '.example.com' as origin,
          'https://api' || l_orderkey || '.example.com/p/' || l_partkey || '/' || l_linenumber || '/' || l_suppkey as url,
          case when l_linenumber = 3 and l_returnflag = 'R' then null when l_linenumber = 5 then 500
               when l_linenumber = 4 then 200 else 402 end as status,
          cast(l_quantity as bigint) * 60 as ms,
          case when p_size = 1 then null else p_retailprice / 100000 end as adv_amount,
          case when l_linenumber in (4, 5) or (l_linenumber = 3 and l_returnflag = 'R') or p_size = 2 then null
               else {_CHECK_LIVE} end as live_amount,
          upper({seller('l_suppkey')}) as adv_payto,
          case when l_linenumber in (4, 5) then null when l_discount = 0.1 and l_tax <= 0.01 then '0xelse' || l_partkey
               else {seller('l_suppkey')} end as live_payto,
          'eip155:8453' as network, l_linestatus = 'O' as schema,
          l_linenumber not in (4, 5) and not (l_linenumber = 3 and l_returnflag = 'R') and p_size <> 2 as payable,
          l_linenumber = 7 as inconclusive,
          case when p_size = 2 and l_linenumber not in (4, 5) then (case when l_partkey % 2 = 0 then '{{{{}}}}' else 'pay me' end) end as body_sample,
          cast(l_quantity as bigint) as calls30d
        from {{lineitem}} join {{part}} on l_partkey = p_partkey"""),
    "origins": (("orders",), """
        select 'api' || o_orderkey || '.example.com' as origin, o_orderkey % 30 + 1 as breadth,
          o_orderpriority = '5-LOW' and o_orderstatus = 'P' as phantom,
          o_orderstatus <> 'F' as discoverable,
          case when o_orderstatus = 'O' then '/openapi.json,/.well-known/x402' else '/openapi.json' end as paths,
          o_orderpriority = '1-URGENT' and o_orderstatus = 'P' as rotates_payto,
          o_custkey % 900 as calls30d, o_custkey % 40 as payers30d,
          case when o_custkey % 11 = 0 then null else cast(cast(o_orderdate as date) as string) || 'T05:00:00Z' end as last_called,
          case when o_orderkey % 5 = 0 then o_custkey % 2000 else 0 end as settled_tx30d,
          case when o_orderkey % 5 = 0 then round(o_totalprice) else 0.0 end as settled_usd30d,
          case when o_orderkey % 5 = 0 then o_custkey % 60 else 0 end as settled_buyers30d,
          """ + _case("o_orderkey % 16", _text(PHRASES)) + """ as text
        from {orders}"""),
    "calls": (("orders",), f"""
        select *, case when v = 8 then '{{{{"success":false,"error":{{{{"message":"bad gateway","details":{{{{"statusCode":502}}}}}}}}}}}}'
                       else {_ENVELOPE.format(p='payload').replace('{', '{{').replace('}', '}}')} end as stdout,
          case when v = 8 then null else tx end as paid_tx
        from (select *, {_case('v', _PAYLOADS)} as payload,
            case when v = 3 and o_orderkey % 3 = 0 then {_FULL}
                 when v = 3 and o_orderkey % 3 = 1 then {_PAYLOADS[3]} else 'null' end as payload2
          from (select o_orderkey, o_custkey, o_orderstatus, o_orderpriority, {O_CENTS} as oc, o_orderkey % 10 as v,
              'https://api' || o_orderkey || '.example.com/v1/report' as url,
              'api' || o_orderkey || '.example.com' as host,
              cast(cast(o_orderdate as date) as string) as day,
              cast(o_orderkey % 900 + 100 as double) / 100000 as quoted, {_PRICE_ASKED} as asked,
              '0x' || lpad(lower(hex(o_orderkey + 1)), 64, '0') as tx,
              o_custkey + 100 as ms, {_PROMISE} as promise
            from {{orders}}))"""),
    "recaptured": (("orders",), "select max(o_orderkey) as last_key from {orders} group by o_custkey"),
    "captures": (("calls", "recaptured"), """
        select 'raw_' || day || '.jsonl' as file, o_orderkey as line, url, stdout, paid_tx as tx, payload from {calls}
        union all
        select 'raw_9999-01-01.jsonl' as file, o_orderkey as line, url, stdout, paid_tx as tx, payload from {calls} join {recaptured} on o_orderkey = last_key"""),
    "quotes": (("lineitem", "part"), f"""
        select category, host, url, quoted, ref, case n3
            when 0 then '{{{{"data":{{{{"last":' || {PRICE_TEXT.format(c='uc')} || ',"volume24h":' || vol || '}}}},"count":3}}}}'
            when 1 then '{{{{"items":[{{{{"price":"$' || {PRICE_TEXT.format(c='uc')} || '"}}}},{{{{"price":1}}}}]}}}}'
            else '{{{{"figure":' || {PRICE_TEXT.format(c='uc')} || ',"name":"x","flag":true}}}}' end as payload,
          cast(uc as double) / 100 as returned, n3
        from (select p_type as category, 'api' || l_orderkey || '.example.com' as host,
            'https://api' || l_orderkey || '.example.com/q/' || l_partkey || '/' || l_linenumber || '/' || l_suppkey as url,
            cast(l_linenumber as double) / 1000 as quoted, p_retailprice as ref,
            cast(round(l_extendedprice * 100 / l_quantity) as bigint) as uc,
            cast(l_quantity as bigint) * 1000000 as vol, l_linenumber % 3 as n3
          from {{lineitem}} join {{part}} on l_partkey = p_partkey)"""),
    "snapshots": (("lineitem", "part"), f"""
        select date, url, host, service, descr, cast(amount as string) as amount, calls30d, last_day from (
          select case when l_shipdate < timestamp '{SPLIT} 00:00:00' then '{PREV_DATE}' else '{CUR_DATE}' end as date,
            'https://s' || l_suppkey || '.example.com/p/' || l_partkey as url,
            's' || l_suppkey || '.example.com' as host,
            case when l_suppkey % 3 = 0 then '' else 'Shop ' || l_suppkey end as service,
            max(p_name || ' ' || case when l_partkey % 7 = 0 then 'dice game with trust' else p_type end) as descr,
            min(cast(round(l_extendedprice * 100) as bigint)) as amount,
            count(*) * 30 as calls30d, max(cast(cast(l_shipdate as date) as string)) as last_day
          from {{lineitem}} join {{part}} on l_partkey = p_partkey
          group by 1, 2, 3, 4)"""),
    "hits": (("events",), f"""
        select event_id, ts as hit_ts, case when user_id % 23 = 0 then null else event_type end as tool,
          'u' || user_id as subject,
          {_case('user_id % 6', _text(['cline', 'curl', 'python', 'node']) + ['null'], "'acme-own'")} as client
        from {{events}}"""),
    "posts": (("documents", "labels"), """
        select doc_id as id, doc_id as ordinal,
          case when doc_id % 8 = 0 then source else 'api' || cast(floor(doc_id / 2) as bigint) || '.example.com' end as service,
          case when quality is null then (case when doc_id % 2 = 0 then 'UNGRADED' end)
               when toxic = 1 then 'F'
               when quality = 1 then (case n_chars % 4 when 0 then 'A+' when 1 then 'A' when 2 then 'B+' else 'B-' end)
               else (case n_chars % 2 when 0 then 'C' else 'D' end) end as grade,
          case when quality is null or n_chars % 5 = 0 then null when toxic = 1 then 'No goods'
               when quality = 1 then 'Honest' else 'Overcharged' end as call,
          n_chars % 10 = 0 as free, lang || ' answers' as graded_on,
          source || ' ' || lang || ' report ' || doc_id as title,
          lang || ',' || (case when n_chars > 2000 then 'long' else 'short' end) || ',t' || n_chars % 3 as tag_text
        from {documents} left join (select doc_id as ld, max(quality) as quality, max(toxic) as toxic from {labels} group by doc_id)
          on doc_id = ld"""),
    "notes": (("benchmark",), f"""
        select 'n' || item_id as note_id, item_id as ordinal, text as trap, text as bite,
          {_case('item_id % 4', _text(['en', 'fr', 'de']), "'misc'")} || ',' || (case when item_id % 2 = 0 then 'short' else 'odd' end) as tag_text
        from {{benchmark}}"""),
    "readings": (("events",), """
        select date, visitors, (case when prev_date is null then '' else prev_date || '=' || (prev_n + 1) || ',' end)
            || date || '=' || visitors as daily_text,
          'search=' || s || ',mail=' || m as referrer_text
        from (select date, visitors, s, m, lag(date) over (order by date) as prev_date, lag(visitors) over (order by date) as prev_n
          from (select cast(cast(ts as date) as string) as date, count(*) as visitors,
              sum(case when event_type = 'click' then 1 else 0 end) as s, sum(case when event_type = 'view' then 1 else 0 end) as m
            from {events} group by 1))"""),
    "seller_records": (("lineitem", "orders"), f"""
        select k as ordinal, k, tx, units, buyers, {seller('k')} as recipient,
          'https://api' || k || '.example.com/x' || (case when k % 4 = 1 then ',http://API' || (k - 1) || '.example.com' else '' end) as origin_text
        from (select l_suppkey as k, count(*) as tx, sum({CENTS}) * 10000 as units, count(distinct o_custkey) as buyers
          from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey group by 1)"""),
    "token_rows": (("lineitem", "orders"), """
        select l_orderkey * 100000 + l_linenumber * 10000 + l_partkey % 10000 as sig, l_suppkey, o_custkey, l_returnflag, l_linenumber,
          cast(l_quantity as bigint) as q, cast(round(l_extendedprice) as bigint) as e,
          """ + DAY_INDEX + """ * 86400 as block_time, l_linestatus = 'O' and l_linenumber = 2 as failed
        from {lineitem} join {orders} on l_orderkey = o_orderkey"""),
    "challenge_rows": (("lineitem", "part"), f"""
        select l_orderkey * 100000 + l_linenumber * 10000 + l_partkey % 10000 as id, l_linenumber as n,
          cast(l_quantity as bigint) * 1000 as amount, {seller('l_suppkey')} as payto,
          '{{{{"accepts":[{{{{"amount":"' || cast(l_quantity as bigint) * 1000 || '","asset":"{fixed.USDC_BASE}","network":"eip155:8453","payTo":"' || {seller('l_suppkey')} || '"}}}}]}}}}' as doc,
          '{{{{"accepts":[{{{{"amount":"5","asset":"0xfeed","network":"eip155:56","payTo":"0xno"}}}},{{{{"amount":"' || cast(l_quantity as bigint) * 1000 || '","asset":"{fixed.USDC_BASE}","network":"eip155:8453","payTo":"' || {seller('l_suppkey')} || '"}}}}],"extensions":{{{{"bazaar":{{{{"x":1}}}}}}}}}}}}' as doc2,
          '{{{{"price":{{{{"amount":"0.0' || (10 + cast(l_quantity as bigint)) || '"}}}},"paymentInfo":{{{{"network":"base"}}}}}}}}' as doc3,
          '{{{{"amount":"' || cast(l_quantity as bigint) * 1000 || '","recipient":"' || {seller('l_suppkey')} || '"}}}}' as doc6
        from {{lineitem}} join {{part}} on l_partkey = p_partkey"""),
    "registry_a": (("orders",), "select o_orderkey as ordinal, 'https://api' || o_orderkey || '.example.com/v1/report' as resource from {orders}"),
    "registry_b": (("lineitem",), "select l_orderkey as ordinal, 'https://api' || (l_orderkey + l_partkey) || '.example.com/v1/report' as resource from {lineitem}"),
}


class Tables:
    """Access to given and derived tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        # a caller may say over how many tasks its scans are dealt out; unset, it is told by their size
        self.scan_partitions = int(spark.conf.get("spark.tollgauge.scanPartitions", "0"))

    def _tasks(self, name: str, rows: DataFrame) -> int:
        """Tasks to deal a scan out to: few large row groups would leave all work on a row to a few tasks. 0: as it is read."""
        jvm, context = self.spark.sparkContext._jvm, self.spark.sparkContext
        place = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}.parquet")
        size = place.getFileSystem(context._jsc.hadoopConfiguration()).getContentSummary(place).getLength()
        least = SCAN_WAVES * context.defaultParallelism
        if size < DEALT_FROM or rows._jdf.queryExecution().toRdd().getNumPartitions() >= least:
            return 0
        return max(least, -(-size // DEALT_BYTES))

    def __call__(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            rows = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            tasks = self.scan_partitions or self._tasks(name, rows)
            if not tasks:
                return rows
            # dealt by a row's number in its file: dealing in turn would sort every task's rows first
            numbered = rows.select("*", F.col("_metadata.row_index").alias("_dealt"))
            return numbered.repartition(tasks, "_dealt").drop("_dealt")
        deps, text = DERIVED[name]
        return self.spark.sql(text, **{d: self(d) for d in deps})

    # -- inputs with nested columns ------------------------------------------------------
    def raw_logs(self, chain: str = "base") -> DataFrame:
        rows = self("transfers").where(F.col("chain") == chain)
        return rows.select(
            "date", "ts", "seq",
            F.array(F.lit(fixed.TRANSFER_TOPIC), address_to_topic(F.col("payer")),
                    address_to_topic(F.col("payee"))).alias("topics"),
            F.concat(F.lit("0x"), F.lpad(F.lower(F.hex("units")), 64, "0")).alias("data"),
            F.concat(F.lit("0x"), F.lower(F.hex("block"))).alias("blockNumber"))

    def services(self) -> DataFrame:
        return self("services").withColumn(
            "payto", F.filter(F.split("wallets", ","), lambda w: w != "")).drop("wallets")

    def listings(self, name: str = "listing_docs") -> DataFrame:
        rows = self(name)
        doc = F.from_json("doc", schemas.REGISTRY)
        parsed = rows.withColumn("_d", doc).select(
            "ordinal", "resource", F.col("service_name").alias("serviceName"),
            F.col("descr").alias("description"), F.array("tag").alias("tags"),
            *[F.col(f"_d.{c}").alias(c) for c in
              ("accepts", "quality", "extensions", "metadata", "lastUpdated")])
        return parsed.withColumn("host", host_of(F.col("resource")))

    def origins(self) -> DataFrame:
        return self("origins").withColumn("discovery_paths", F.split("paths", ",")).drop("paths")

    def calls(self) -> DataFrame:
        return self("calls").withColumn("expect", F.split("promise", ","))

    def posts(self) -> DataFrame:
        return self("posts").withColumn("tags", F.split("tag_text", ",")).drop("tag_text")

    def notes(self) -> DataFrame:
        return self("notes").withColumn("tags", F.split("tag_text", ",")).drop("tag_text")

    def hits(self) -> DataFrame:
        return self("hits").select(
            F.unix_millis(F.col("hit_ts").cast("timestamp")).alias("ts"), "tool", "subject", "client")

    def readings(self) -> DataFrame:
        as_counts = lambda c: F.transform_values(
            parse_pairs(F.col(c)), lambda k, v: v.try_cast("bigint"))
        return self("readings").select("date", "visitors", as_counts("daily_text").alias("daily"),
                                       as_counts("referrer_text").alias("referrers"))

    def index(self, date: str | None = None) -> DataFrame:
        rows = self("snapshots")
        return rows if date is None else rows.where(F.col("date") == date)

    def seller_records(self) -> DataFrame:
        rows = self("seller_records").select(
            "ordinal", "tx", F.col("units").cast("decimal(38,0)").alias("units"), "buyers",
            F.array("recipient").alias("recipients"), F.split("origin_text", ",").alias("origins"))
        again = rows.where("ordinal % 6 = 0").withColumn("ordinal", F.col("ordinal") + 1000000)
        return rows.unionByName(again)
