"""Published marts and the questions asked of them."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollgauge import fixed_values as fixed
from tollgauge.functions.grades import grade_rank
from tollgauge.functions.numbers import half_even, money_text
from tollgauge.functions.text import trim_to
from tollgauge.functions.urls import is_host, norm_host
from tollgauge.operators.ratings import grades_by_service
from tollgauge.operators.ranks import first_per
from tollgauge.operators.registry import cheapest_price, listing_chains, with_host


def catalog(listings: DataFrame, reliability: DataFrame, delivery: DataFrame,
            posts: DataFrame) -> DataFrame:
    """Payable endpoints on hosts that answered, with reliability, delivery and grades.

    Input delivery: current verdict per URL (url, status, observed).
    """
    rows = cheapest_price(with_host(listings)).where(
        (F.col("host") != "") & F.col("resource").startswith("http"))
    info = F.col("extensions.bazaar.info.input.method")
    compact = rows.select(
        "host", F.col("resource").alias("url"), trim_to(F.col("description"), 220).alias("descr"),
        half_even(F.col("price"), 6).alias("price_usdc"),
        F.coalesce(info, F.lit("GET")).alias("method"), listing_chains().alias("chains"), "ordinal")
    rel = reliability.select("host", "reliability", F.col("price_ok").alias("price_honest"),
                             F.col("payto_ok").alias("payto_honest"))
    done = delivery.select("url", (F.col("status") == "delivered").alias("delivered_as_promised"),
                           "observed")
    grades = grades_by_service(posts.where(is_host(F.col("service")))).select(
        F.col("service").alias("host"), "grades")
    return compact.join(rel, "host").join(done, "url", "left").join(grades, "host", "left")


def catalog_order(rows: DataFrame) -> DataFrame:
    return rows.orderBy(F.desc(F.coalesce("reliability", F.lit(0))),
                        F.asc_nulls_last("price_usdc"), "url")


def host_search_rows(rows: DataFrame) -> DataFrame:
    """Per host: endpoints, lowest price, and whether what was tested was delivered (null when
    nothing was tested)."""
    first = F.struct((-F.coalesce("reliability", F.lit(0))).alias("r"),
                     F.col("price_usdc").isNull().alias("p0"), "price_usdc", "url")
    return rows.groupBy("host").agg(
        F.count("*").alias("n"), F.min("price_usdc").alias("price"),
        F.bool_and("delivered_as_promised").alias("delivered"),
        F.max("reliability").alias("reliability"),
        F.min_by(trim_to(F.col("descr"), 70), first).alias("descr"))


ITEM = ("item_type", "label", "url", "status", "grade", "price", "reliability", "n", "delivered",
        "descr", "keywords")


def _item(df: DataFrame, **cols: Column) -> DataFrame:
    types = {"price": "double", "reliability": "bigint", "n": "bigint", "delivered": "boolean"}
    return df.select(*[
        cols.get(c, F.lit(None)).cast(types.get(c, "string")).alias(c) for c in ITEM])


def search_index(rows: DataFrame, board_hosts: DataFrame, posts: DataFrame,
                 notes: DataFrame) -> DataFrame:
    """Everything searchable with how much of it was verified: graded, measured or listed
    hosts, graded hosts that left the catalogue, posts and notes."""
    grades = grades_by_service(posts.where(is_host(F.col("service")))).select(
        F.col("service").alias("host"), F.col("grades")[0]["grade"].alias("grade"))
    measured = board_hosts.where("host != ''").select("host").distinct().withColumn(
        "_m", F.lit(True))
    hosts = host_search_rows(rows).join(grades, "host", "left").join(measured, "host", "left")
    graded = F.col("grade").isNotNull()
    status = (F.when(graded, "graded")
              .when(F.col("delivered").isNotNull() | F.col("_m").isNotNull(), "measured")
              .otherwise("listed"))
    page = F.concat(F.lit("/s/"), F.col("host"))
    listed = _item(hosts, item_type=F.lit("host"), label=F.col("host"), url=F.when(graded, page),
                   status=status, grade=F.col("grade"), price=F.col("price"),
                   reliability=F.col("reliability"), n=F.col("n"), delivered=F.col("delivered"),
                   descr=F.col("descr"))
    gone = grades.join(hosts.select("host"), "host", "left_anti")
    missing = _item(gone, item_type=F.lit("host"), label=F.col("host"), url=page,
                    status=F.lit("graded"), grade=F.col("grade"), descr=F.lit(""))
    kw = F.trim(F.lower(F.concat(F.array_join("tags", " "), F.lit(" "),
                                 F.coalesce("service", F.lit("")))))
    written = _item(posts, item_type=F.lit("rating"), label=trim_to(F.col("title"), 140),
                    url=F.concat(F.lit("/p/"), F.col("id").cast("string")), status=F.lit("post"),
                    keywords=kw)
    noted = _item(notes, item_type=F.lit("note"), label=trim_to(F.col("trap"), 140),
                  url=F.concat(F.lit("/notes/"), F.col("note_id")), status=F.lit("note"),
                  keywords=F.lower(trim_to(F.col("bite"), 80)))
    return listed.unionByName(missing).unionByName(written).unionByName(noted)


def add_missing_graded(index: DataFrame, posts: DataFrame) -> DataFrame:
    """Graded hosts that the index does not list yet."""
    graded = grades_by_service(posts.where(is_host(F.col("service")))).select(
        F.col("service").alias("label"), F.col("grades")[0]["grade"].alias("grade"))
    return graded.join(index.where("item_type = 'host'").select("label"), "label", "left_anti")


def missing_from(posts: DataFrame, key: str, marts: dict[str, DataFrame]) -> DataFrame:
    """Keys that a mart should carry but does not; empty when coverage is whole."""
    gaps = None
    for name, mart in marts.items():
        gap = posts.select(key).distinct().join(mart.select(key), key, "left_anti").select(
            F.lit(name).alias("mart"), F.col(key).cast("string").alias("key"))
        gaps = gap if gaps is None else gaps.unionByName(gap)
    return gaps


# ---- questions --------------------------------------------------------------------------
def get_service(board: DataFrame, posts: DataFrame, hosts: DataFrame) -> DataFrame:
    """Grades and settlement of the asked hosts; unknown hosts answer ``found = false``."""
    asked = hosts.select(norm_host(F.col("host")).alias("host")).distinct()
    grades = grades_by_service(posts).select(F.lower("service").alias("host"), "grades")
    money = first_per(board.where("host != ''").select(
        F.lower("host").alias("host"), "usdc", "settlements", "payers", "repeat_payers",
        "payout_pct", "demand", "organic_score", F.coalesce("address", F.lit("")).alias("address")),
        ["host"], -F.col("usdc"), F.col("address"))
    rows = asked.join(grades, "host", "left").join(money, "host", "left")
    return rows.select(
        "host", (F.col("grades").isNotNull() | F.col("usdc").isNotNull()).alias("found"), "grades",
        F.col("usdc").alias("usdc_received"), F.col("settlements").alias("payments"),
        F.col("payers").alias("paying_wallets"), F.col("repeat_payers").alias("repeat_buyers"),
        F.col("payout_pct").alias("sends_back_pct"), F.col("demand").alias("demand_shape"),
        F.col("organic_score").alias("organic_demand_score"))


def search_services(posts: DataFrame, query: str, min_grade: str | None = None) -> DataFrame:
    text = F.lower(F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in
                                      ("service", "graded_on", "title", "call")]))
    rows = posts.where(F.col("grade").isNotNull() & text.contains(query.strip().lower()))
    if min_grade:
        rows = rows.where(grade_rank(F.col("grade")) <= grade_rank(F.lit(min_grade)))
    return rows.select("id", F.col("service").alias("host"), "grade", "graded_on", "call",
                       grade_rank(F.col("grade")).alias("grade_order")).orderBy("grade_order", "id")


def top_services(board: DataFrame, by: str = "revenue", limit: int = 10) -> DataFrame:
    k = min(max(int(limit), 1), 50)
    named = board.where("host != ''")
    if by == "organic_demand":
        rows = named.where("organic_score IS NOT NULL").orderBy(
            F.desc("organic_score"), "host", F.asc_nulls_first("address"))
    else:
        rows = named.orderBy(F.desc("usdc"), "host", F.asc_nulls_first("address"))
    return rows.limit(k).select(
        "host", "address", F.col("usdc").alias("usdc_received"),
        F.col("settlements").alias("payments"), F.col("payers").alias("paying_wallets"),
        F.col("payout_pct").alias("sends_back_pct"), F.col("demand").alias("demand_shape"),
        F.col("organic_score").alias("organic_demand_score"))


def list_traps(notes: DataFrame, query: str | None = None) -> DataFrame:
    if not query:
        return notes
    whole = F.lower(F.to_json(F.struct(*notes.columns)))
    return notes.where(whole.contains(query.strip().lower()))


def find_api(rows: DataFrame, accurate: DataFrame, task: str, max_price: float | None = None,
             min_reliability: int = 70, limit: int = 8) -> DataFrame:
    """Endpoints for a task: words found in the description, the whole phrase counting again as
    much, sellers proven accurate first; one endpoint per host.

    Input accurate: (host, category, off_by, unit, metric) of sellers whose number was right. Each row says what proved its
    seller right (``graded_accurate``), where it can be paid and how it was graded; limits run from 1 to 25.
    """
    task = task.strip().lower()
    words = [w for w in task.split() if len(w) > 2]
    text = F.lower(F.coalesce("descr", F.lit("")))
    hits = F.lit(0)
    for word in words:
        hits = hits + text.contains(word).cast("int")
    hits = hits + F.when(text.contains(task), len(words)).otherwise(0)
    kept = rows.where(F.coalesce("reliability", F.lit(0)) >= min_reliability)
    if max_price is not None:
        kept = kept.where(F.col("price_usdc") <= max_price)
    scored = kept.withColumn("_hits", hits).where("_hits > 0")
    one = scored.groupBy("host").agg(F.min_by(
        F.struct("url", "descr", "price_usdc", "method", "chains", "reliability", "price_honest",
                 "payto_honest", "grades", "_hits"),
        F.struct((-F.col("_hits")).alias("h"), (-F.col("reliability")).alias("r"),
                 F.coalesce("price_usdc", F.lit(9e9)).alias("p"), F.col("url"))).alias("e"))
    proof = first_per(accurate.select("host", "category", "off_by", "unit", "metric"), ["host"],
                      F.col("category"), F.abs("off_by"))
    right = F.when(F.col("category").isNotNull(), F.struct("off_by", "unit", F.col("metric").alias("vs")))
    ranked = one.join(proof, "host", "left").select(
        "host", "e.*", "off_by", "unit", right.alias("graded_accurate"),
        (F.col("e._hits") + F.when(F.col("category").isNotNull(), 1000).otherwise(0)).alias("score"))
    k = min(max(int(limit), 1), 25)
    return ranked.drop("_hits").orderBy(
        F.desc("score"), F.desc("reliability"), F.coalesce("price_usdc", F.lit(9e9)), "host").limit(k)


def preflight(verdicts: DataFrame, hosts: DataFrame) -> DataFrame:
    """Verdict and gate text for a batch of asked hosts or URLs; unknown hosts are unrated."""
    asked = hosts.select(norm_host(F.col("host")).alias("host")).where("host != ''").distinct()
    rows = asked.join(verdicts, "host", "left")
    known = F.col("light").isNotNull()
    light = F.coalesce("light", F.lit("gray"))
    label = F.lit(None).cast("string")
    for name, text in fixed.LIGHT_LABELS.items():
        label = F.when(light == name, text).otherwise(label)
    proven = F.coalesce(F.col("accurate") + F.col("delivered"), F.lit(0)) > 0
    gate = (
        F.when(~known, fixed.GATE_UNKNOWN)
        .when((light == "green") & F.col("checked_live"), fixed.GATE_CHECKED)
        .when((light == "green") & proven, fixed.GATE_MEASURED)
        .when(light == "green", fixed.GATE_LITTLE)
        .when(light == "yellow", fixed.GATE_HOLD)
        .when(light == "red", fixed.GATE_ABORT).otherwise(fixed.GATE_UNRATED))
    evidence = F.when(known, F.struct("receipts", "disputes", "delivered", "accurate", "checked_live"))
    return rows.select("host", label.alias("verdict"), light.alias("light"), "score", gate.alias("gate"),
                       F.coalesce("reasons", F.array().cast(verdicts.schema["reasons"].dataType)).alias("reasons"),
                       evidence.alias("evidence"), F.concat(F.lit("/s/"), "host").alias("seller_page"),
                       F.lit(fixed.ALWAYS_READ).alias("always"))


def preflight_detail(verdicts: DataFrame, probe: DataFrame, board: DataFrame, posts: DataFrame, hosts: DataFrame) -> DataFrame:
    """``preflight`` with all that ``payment_safety`` knows of each host as ``detail_checks``."""
    told = payment_safety(probe, board, hosts, posts)
    detail = told.select("host", F.struct(*[c for c in told.columns if c != "host"]).alias("detail_checks"))
    return preflight(verdicts, hosts).join(detail, "host")


def payment_safety(probe: DataFrame, board: DataFrame, hosts: DataFrame, posts: DataFrame | None = None) -> DataFrame:
    """Warnings to read before paying, from the probe mart and the board, with the live check, the demand and, with
    ``posts``, the grades that they come from."""
    asked = hosts.select(norm_host(F.col("host")).alias("host")).where("host != ''").distinct()
    demand = board.where("host != ''").groupBy(F.lower("host").alias("host")).agg(
        F.min_by(F.struct("usdc", "payers", "demand", "organic_score", "payout_pct"),
                 F.struct(-F.col("usdc"), F.coalesce("address", F.lit("")))).alias("_d"))
    checks = probe.select(F.lower("host").alias("host"), "checked", "returns_402", "price_ok", "payto_ok", "phantom", "median_ms",
                          "free_tier", "mismatches", F.lit(True).alias("_p"))
    rows = asked.join(checks, "host", "left").join(demand, "host", "left")
    if posts is not None:
        rows = rows.join(grades_by_service(posts).select(F.lower("service").alias("host"), "grades"), "host", "left")
    live = F.col("_p").isNotNull()
    shown = F.array_join(F.transform(F.slice(F.coalesce(
        "mismatches", F.array().cast("array<struct<url:string,listed:double,live:double>>")), 1, 2),
        lambda m: F.concat(m["url"], F.lit(" listed $"), money_text(m["listed"]), F.lit(" live $"),
                           money_text(m["live"]))), "; ")
    warnings = F.array_compact(F.array(
        F.when(~live, fixed.WARN_UNCHECKED),
        F.when(live & ~F.col("payto_ok"), fixed.WARN_PAYTO),
        F.when(live & ~F.col("price_ok"), F.format_string(fixed.WARN_PRICE, shown)),
        F.when(live & F.col("phantom"), fixed.WARN_PHANTOM),
        F.when(live & (F.col("returns_402") < F.col("checked")), F.format_string(
            fixed.WARN_NO_402, F.col("checked") - F.col("returns_402"), F.col("checked"))),
        F.when(F.col("_d.payout_pct") >= 90, F.format_string(
            fixed.WARN_RECYCLES, F.col("_d.payout_pct").cast("string"))),
        F.when(F.col("_d.demand") == "one wallet", fixed.WARN_ONE_WALLET)))
    check = F.when(live, F.struct(
        F.col("checked").alias("endpoints_checked"), F.col("returns_402").alias("returns_402_unpaid"),
        F.col("price_ok").alias("price_matches_listing"), F.col("payto_ok").alias("payto_matches_listing"),
        F.col("phantom").alias("phantom_paywall"), "median_ms", "free_tier"))
    money = F.when(F.col("_d").isNotNull(), F.struct(
        F.col("_d.usdc").alias("usdc_received"), F.col("_d.payers").alias("paying_wallets"), F.col("_d.demand").alias("demand_shape"),
        F.col("_d.organic_score").alias("organic_demand_score"), F.col("_d.payout_pct").alias("sends_back_pct")))
    return rows.select("host", live.alias("checked_live"), warnings.alias("warnings"), check.alias("live_check"), money.alias("demand"),
                       *([F.col("grades")] if posts is not None else []))


def market_summary(totals: DataFrame, tape: DataFrame) -> DataFrame:
    span = tape.agg(F.min("date").alias("tape_from"), F.max("date").alias("tape_to"))
    return totals.select("total_usdc", "total_settlements", F.lit(1).alias("_k")).join(
        span.select("tape_from", "tape_to", F.lit(1).alias("_k")), "_k").drop("_k")


def search(index: DataFrame, query: str, k: int = 8) -> DataFrame:
    """Search box ranking: match class (name prefix, word boundary, inside, keyword,
    description for queries of three characters or more), verification, label length."""
    q = query.strip().lower()
    label = F.lower(F.coalesce("label", F.lit("")))
    words = F.coalesce("keywords", F.lit(""))
    text = F.lower(F.coalesce("descr", F.lit("")))
    plain = "".join("\\" + ch if not ch.isalnum() and ch != " " else ch for ch in q)
    cls = (F.when(label.startswith(q), 0)
           .when(label.rlike("(^|[^a-z0-9])" + plain), 1)
           .when(label.contains(q), 2).when(words.contains(q), 3).otherwise(4))
    hit = label.contains(q) | words.contains(q)
    if len(q) >= 3:
        hit = hit | text.contains(q)
    order = F.lit(len(fixed.VERIFICATION_RANK))
    for position, status in reversed(list(enumerate(fixed.VERIFICATION_RANK))):
        order = F.when(F.col("status") == status, position).otherwise(order)
    hits = index.where(hit).select("item_type", "label", "url", "status", cls.alias("class"),
                                   order.alias("rank_order"), F.length("label").alias("_len"))
    total = hits.agg(F.count("*").alias("total"), F.lit(1).alias("_k"))
    top = hits.orderBy("class", "rank_order", "_len", "label", F.asc_nulls_first("url")).limit(k)
    place = Window.orderBy("class", "rank_order", "_len", "label", F.asc_nulls_first("url"))
    numbered = top.withColumn("rank", F.row_number().over(place).cast("bigint")).withColumn(
        "_k", F.lit(1))
    return numbered.join(F.broadcast(total), "_k").select(
        "rank", "item_type", "label", "url", "status", F.col("class").cast("bigint").alias("class"),
        "total")
