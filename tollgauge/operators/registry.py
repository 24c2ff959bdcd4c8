"""The listing registry: prices, contracts, keyword selection, topics and categories."""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollgauge import fixed_values as fixed
from tollgauge.functions.chain import chain_name
from tollgauge.functions.text import first_pattern, first_words, has_any, trim_to
from tollgauge.functions.urls import host_of, last_path_word
from tollgauge.operators.ranks import first_per, quantiles_and_median, running_total, take_by_hash, true_median


def with_host(listings: DataFrame, variant: str = "hostname") -> DataFrame:
    return listings.withColumn("host", host_of(F.coalesce("resource", F.lit("")), variant))


def usdc_prices(asset: str = fixed.USDC_BASE) -> Column:
    """All prices a listing quotes in one asset, integer strings only."""
    quoted = F.filter("accepts", lambda a: (F.lower(a["asset"]) == asset)
                      & a["amount"].rlike("^[0-9]+$"))
    return F.transform(quoted, lambda a: a["amount"].cast("decimal(38,0)").cast("double") / 1e6)


def cheapest_price(listings: DataFrame, asset: str = fixed.USDC_BASE) -> DataFrame:
    return listings.withColumn("price", F.array_min(usdc_prices(asset)))


def asset_decimals(asset: Column) -> Column:
    """Decimals of an asset out of the fixed table; null when unknown."""
    table = F.create_map(*[F.lit(x) for pair in fixed.ASSET_DECIMALS.items() for x in pair])
    return F.try_element_at(table, F.lower(F.coalesce(asset, F.lit(""))))


def to_usd(amount: Column, asset: Column) -> Column:
    units = F.when(amount.rlike("^[+-]?[0-9]+$"), amount.try_cast("decimal(38,0)"))
    return units.cast("double") / F.pow(F.lit(10.0), asset_decimals(asset))


def _asked(option: Column) -> Column:
    return F.coalesce(F.nullif(option["amount"], F.lit("")), option["maxAmountRequired"])


def pay_address(option: Column) -> Column:
    """payTo of an option, or its recipient where payTo is missing or empty."""
    return F.coalesce(F.nullif(option["payTo"], F.lit("")), option["recipient"])


def first_priceable(accepts: Column) -> Column:
    """First payment option whose amount can be expressed in dollars."""
    priced = F.transform(accepts, lambda a: F.struct(
        to_usd(_asked(a), a["asset"]).alias("usd"),
        pay_address(a).alias("payto"), F.nullif(a["network"], F.lit("")).alias("network")))
    return F.get(F.filter(priced, lambda p: p["usd"].isNotNull()), F.lit(0))


def advertised_price(listings: DataFrame) -> DataFrame:
    best = first_priceable(F.col("accepts"))
    return listings.withColumn("_a", best).select(
        *listings.columns, F.col("_a.usd").alias("adv_amount"),
        F.col("_a.payto").alias("adv_payto"), F.col("_a.network").alias("adv_network"))


def contract(listings: DataFrame) -> DataFrame:
    """The listing's own promise: method, body and sorted example fields, null when the
    listing shows no example or a body method carries no body object."""
    info = "extensions.bazaar.info"
    method = F.upper(F.coalesce(F.nullif(F.col(f"{info}.input.method"), F.lit("")), F.lit("GET")))
    body = F.col(f"{info}.input.body")
    fields = F.json_object_keys(F.col(f"{info}.output.example"))
    usable = (F.size(F.coalesce(fields, F.array())) > 0) & (
        ~method.isin(*fixed.BODY_METHODS) | F.json_object_keys(body).isNotNull())
    return listings.select(
        *listings.columns,
        F.when(usable, method).alias("method"), F.when(usable, body).alias("body"),
        F.when(usable, F.array_sort(fields)).alias("expect"))


def declared_call(listings: DataFrame) -> DataFrame:
    """How the registry says to call a listing, and its usage counters."""
    given = F.upper(F.coalesce(F.col("extensions.bazaar.info.input.method"), F.lit("GET")))
    return listings.select(
        *listings.columns,
        F.when(given.isin(*fixed.HTTP_METHODS), given).otherwise("GET").alias("call_method"),
        F.col("extensions.bazaar.info.input.body").alias("call_body"),
        F.coalesce("quality.l30DaysTotalCalls", F.lit(0)).alias("calls30d"),
        F.coalesce("quality.l30DaysUniquePayers", F.lit(0)).alias("payers30d"),
        F.col("quality.lastCalledAt").alias("last_called"))


def parse_declared(docs: DataFrame) -> DataFrame:
    """Calls an origin declares in its own discovery document. Input: (origin, entry), each
    entry ``"POST /path"``, a bare path, or a JSON object with resource/url/path and method.
    Templated paths cannot be called and are dropped."""
    entry = F.col("entry")
    verb = F.regexp_extract(entry, r"^([A-Z]+)\s+(\S.*)$", 1)
    rest = F.regexp_extract(entry, r"^([A-Z]+)\s+(\S.*)$", 2)
    doc = F.from_json(entry, "resource string, url string, path string, method string")
    obj = entry.startswith("{")
    method = F.when(obj, F.upper(F.coalesce(doc["method"], F.lit("GET")))).otherwise(
        F.coalesce(F.nullif(verb, F.lit("")), F.lit("GET")))
    path = F.when(obj, F.coalesce(
        F.nullif(doc["resource"], F.lit("")), F.nullif(doc["url"], F.lit("")), doc["path"])
    ).otherwise(F.when(verb != "", rest).otherwise(entry))
    rows = docs.select("origin", method.alias("method"), path.alias("path"))
    templated = (F.col("path").contains("{") | F.col("path").contains("}")
                 | F.element_at(F.split("path", "/"), -1).contains(":"))
    slash = F.when(F.col("path").startswith("/"), F.col("path")).otherwise(
        F.concat(F.lit("/"), F.col("path")))
    return rows.where((F.col("path") != "") & ~templated).select(
        "origin", "method", "path",
        F.when(F.col("path").startswith("http"), F.col("path")).otherwise(
            F.concat(F.lit("https://"), F.col("origin"), slash)).alias("url"))


def canonical_json(text: Column) -> Column:
    """Compact JSON with sorted keys, so equal documents have equal text."""
    return F.to_json(F.try_parse_json(text))


def schema_fingerprint(text: Column) -> Column:
    return F.substring(F.sha2(canonical_json(text), 256), 1, 12)


def index_of(listings: DataFrame) -> DataFrame:
    """Compact per-URL record with the fields worth comparing between days: all payment options and
    the whole description, since what is stored is not cut; answers cut what they show."""
    first = F.get("accepts", F.lit(0))
    wallets = F.array_sort(F.array_distinct(F.transform(
        F.filter("accepts", lambda a: F.coalesce(a["payTo"] != "", F.lit(False))),
        lambda a: F.lower(a["payTo"]))))
    return listings.where(F.col("resource").startswith("http")).select(
        F.col("resource").alias("url"), host_of(F.col("resource"), "netloc").alias("host"),
        F.coalesce("serviceName", F.lit("")).alias("service"),
        F.coalesce("description", F.lit("")).alias("descr"),
        first["amount"].alias("amount"), first["asset"].alias("asset"),
        first["network"].alias("network"),
        F.coalesce("quality.l30DaysTotalCalls", F.lit(0)).alias("calls30d"),
        F.coalesce("quality.l30DaysUniquePayers", F.lit(0)).alias("payers30d"),
        F.col("quality.lastCalledAt").alias("last_called"),
        F.coalesce(wallets, F.array().cast("array<string>")).alias("payto"),
        F.transform("accepts", lambda a: F.struct(
            a["amount"].alias("amount"), a["asset"].alias("asset"),
            a["network"].alias("network"))).alias("options"),
        schema_fingerprint(F.col("extensions.bazaar.schema")).alias("schema_fp"))


def update_schema_store(store: DataFrame, listings: DataFrame) -> DataFrame:
    """Schemas whose fingerprint the store does not hold yet; append these to the store."""
    seen = listings.where(F.col("extensions.bazaar.schema").isNotNull()).select(
        schema_fingerprint(F.col("extensions.bazaar.schema")).alias("fp"),
        canonical_json(F.col("extensions.bazaar.schema")).alias("schema")).where("fp IS NOT NULL")
    fresh = seen.groupBy("fp").agg(F.min("schema").alias("schema"))
    return fresh.join(store.select("fp"), "fp", "left_anti")


def valid_listings(listings: DataFrame, max_price: float) -> DataFrame:
    """Listings that can be bought and checked: http URL, host, a contract, a small price."""
    rows = cheapest_price(contract(with_host(listings)))
    return rows.where(
        (F.col("host") != "") & F.col("resource").startswith("http")
        & F.col("expect").isNotNull() & (F.col("price") > 0) & (F.col("price") <= max_price))


def listing_blob() -> Column:
    return F.lower(F.concat(F.coalesce("resource", F.lit("")), F.lit(" "),
                            F.coalesce("description", F.lit(""))))


def select_by_words(listings: DataFrame, every: Iterable[Iterable[str]],
                    none: Iterable[str] = ()) -> DataFrame:
    """Listings whose URL and description hit every word group and no excluded word."""
    blob = listing_blob()
    keep = ~has_any(blob, none)
    for group in every:
        keep = keep & has_any(blob, group)
    return listings.where(keep)


def drop_other_ticker(listings: DataFrame, ticker: str) -> DataFrame:
    """Drop listings whose last path word is a different ticker."""
    word = last_path_word(F.col("resource"))
    other = ((word != ticker.lower()) & ~word.isin(*fixed.NON_TICKER_WORDS)
             & word.rlike("^[a-z]{2,5}$"))
    return listings.where(~F.coalesce(other, F.lit(False)))


def within_budget(candidates: DataFrame, budget: float) -> DataFrame:
    """Cheapest-first candidates whose running cost stays inside the budget; equal prices are
    taken in the order of a hash of the URL.

    Rows are counted per price, what the prices cost is summed over ranges of prices, and the
    single price level that is cut is cut through counts per hash prefix, so no task sees all prices.
    """
    money = F.col("price").cast("decimal(28,8)")
    priced = candidates.withColumn("_p", money)
    levels = priced.where(F.col("_p") <= budget).groupBy("_p").agg(F.count("*").alias("_n"))
    costs = levels.withColumn("_cost", (F.col("_p") * F.col("_n")).cast("decimal(38,8)"))
    levels = running_total(costs, "_cost", ["_p"], "_upto")
    left = F.lit(budget).cast("decimal(28,8)") - (F.col("_upto") - F.col("_cost"))
    room = F.when(F.col("_p") > 0, F.floor(left / F.col("_p"))).otherwise(F.col("_n"))
    open_levels = levels.select("_p", "_n", room.cast("bigint").alias("_room")).where("_room > 0")
    whole = priced.join(open_levels.where("_room >= _n").select("_p"), "_p", "left_semi")
    cut = priced.join(open_levels.where("_room < _n").select("_p", "_room"), "_p")
    part = take_by_hash(cut, ["_p"], "_room", "url")
    return whole.select(*candidates.columns).unionByName(part.select(*candidates.columns))


def topic_of(text: Column) -> Column:
    return first_pattern(F.lower(text), fixed.TOPIC_RULES)


def category_of(blob: Column) -> Column:
    """Struct(category, accuracy_source) of a listing's lower-case text."""
    names = [(name, pos, neg) for name, _, pos, neg in fixed.CATEGORY_RULES]
    sources = [(src, pos, neg) for _, src, pos, neg in fixed.CATEGORY_RULES]
    return F.struct(
        first_words(blob, names, fixed.OTHER_CATEGORY).alias("category"),
        first_words(blob, sources).alias("accuracy_source"))


def free_category(text: Column) -> Column:
    """Struct(label, source) when the text advertises data that is free upstream."""
    low = F.lower(F.coalesce(text, F.lit("")))
    labels = [(label, words, ()) for words, label, _ in fixed.FREE_DATA_RULES]
    sources = [(source, words, ()) for words, _, source in fixed.FREE_DATA_RULES]
    label = first_words(low, labels)
    return F.when(label.isNotNull(),
                  F.struct(label.alias("label"), first_words(low, sources).alias("source")))


def category_map(listings: DataFrame) -> DataFrame:
    """One endpoint per (host, category), the first in registry order."""
    rows = cheapest_price(contract(with_host(listings)))
    rows = rows.where((F.col("host") != "") & F.col("resource").startswith("http"))
    blob = F.concat(listing_blob(), F.lit(" "),
                    F.lower(F.coalesce(F.array_join("tags", " "), F.lit(""))))
    named = rows.withColumn("_c", category_of(blob)).select(
        "ordinal", "host", F.col("resource").alias("url"), "price",
        F.col("expect").isNotNull().alias("has_schema"),
        trim_to(F.col("description"), 80).alias("descr"),
        F.col("_c.category").alias("category"), F.col("_c.accuracy_source").alias("accuracy_source"))
    return first_per(named, ["host", "category"], F.col("ordinal"))


def category_coverage(sellers: DataFrame) -> DataFrame:
    cost = F.least(F.coalesce("price", F.lit(0.0)), F.lit(0.02)).cast("decimal(28,8)")
    return sellers.groupBy("category", "accuracy_source").agg(
        F.count("*").alias("sellers"), F.count_if("has_schema").alias("with_schema"),
        F.sum(cost).cast("double").alias("sweep_cost"))


def category_sellers(sellers: DataFrame, category: str, max_price: float) -> DataFrame:
    rows = sellers.where((F.col("category") == category) & (F.col("price") > 0)
                         & (F.col("price") <= max_price))
    return rows.orderBy("price", "url")


def registry_categories(listings: DataFrame) -> DataFrame:
    """How many listings each provider category has."""
    return listings.groupBy(
        F.coalesce(F.nullif(F.col("metadata.provider.category"), F.lit("")),
                   F.lit("UNCATEGORISED")).alias("category")
    ).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "category")


def host_category(listings: DataFrame) -> DataFrame:
    """Provider and category of each host's first listing."""
    rows = with_host(listings, "netloc").where("host != ''").select(
        "host", "ordinal", F.coalesce("metadata.provider.name", F.lit("")).alias("provider"),
        F.coalesce(F.nullif(F.col("metadata.provider.category"), F.lit("")),
                   F.lit("UNCATEGORISED")).alias("category"))
    return first_per(rows, ["host"], F.col("ordinal")).select("host", "provider", "category")


def topic_listings(listings: DataFrame) -> DataFrame:
    """Priced listings with their topic: (host, topic, url, price)."""
    text = F.concat(F.coalesce("description", F.lit("")), F.lit(" "), F.col("resource"))
    rows = cheapest_price(with_host(listings, "dotless")).withColumn("topic", topic_of(text))
    return rows.where("host != '' AND topic IS NOT NULL AND price IS NOT NULL").select(
        "host", "topic", F.col("resource").alias("url"), "price")


def _offers(rows: DataFrame) -> DataFrame:
    return rows.groupBy("topic", "host").agg(
        F.min("price").alias("price"), F.count("*").alias("endpoints"))


def primary_topic(rows: DataFrame) -> DataFrame:
    """Topic that holds most of a host's endpoints; ties go to the rarer topic, then name."""
    offers = _offers(rows)
    breadth = offers.groupBy("topic").agg(F.count("*").alias("breadth"))
    order = F.struct(-F.col("endpoints"), F.col("breadth"), F.col("topic"))
    return offers.join(breadth, "topic").groupBy("host").agg(F.min_by("topic", order).alias("topic"))


def host_money(board: DataFrame) -> DataFrame:
    """Revenue per host over all its rows; the demand shape is that of its last board row."""
    last = F.struct(-F.col("usdc"), F.coalesce("address", F.lit("")))
    return board.where("host != ''").groupBy(F.lower("host").alias("host")).agg(
        F.sum(F.col("usdc").cast("decimal(28,4)")).alias("money"),
        F.max_by(F.struct("organic_score", "payers", "circular", "demand"), last).alias("d"))


def topic_market(listings: DataFrame, board: DataFrame) -> DataFrame:
    """One row per topic: sellers, offer prices, and the demand its primary sellers have."""
    rows = topic_listings(listings)
    offers = _offers(rows).where("price >= 0")
    positive = offers.where("price > 0")
    supply = offers.groupBy("topic").agg(
        F.count("*").alias("sellers"), F.sum("endpoints").alias("endpoints"))
    prices = positive.groupBy("topic").agg(
        F.min("price").alias("cheapest"), F.max("price").alias("dearest"))
    quantiles = quantiles_and_median(positive, ["topic"], "price")
    money = primary_topic(rows).join(host_money(board), "host", "left")
    score = F.coalesce("d.organic_score", F.lit(0))
    demand = money.groupBy("topic").agg(
        F.count("*").alias("primary_sellers"),
        F.coalesce(F.sum("money"), F.lit(0)).cast("double").alias("usdc_30d"),
        F.count_if(F.col("money") > 0).alias("earning_sellers"),
        F.coalesce(F.sum("d.payers"), F.lit(0)).alias("buyers"),
        F.count_if((score >= 60) & ~F.col("d.circular")).alias("real_sellers"))
    shape = true_median(money.select("topic", F.col("d.organic_score").alias("s")),
                        ["topic"], "s", "median_ods")
    return (prices.join(supply, "topic").join(quantiles, "topic")
            .join(demand, "topic", "left").join(shape, "topic", "left")
            .select("topic", "sellers",
                    *[F.coalesce(c, F.lit(0)).alias(c) for c in ("primary_sellers",)],
                    "endpoints", "cheapest", "dearest", "p10", "p90",
                    F.when(F.col("p10") != 0, F.col("p90") / F.col("p10")).alias("spread"), "median",
                    F.coalesce("usdc_30d", F.lit(0.0)).alias("usdc_30d"),
                    *[F.coalesce(c, F.lit(0)).alias(c)
                      for c in ("earning_sellers", "buyers", "real_sellers")], "median_ods"))


def topic_rank(topics: DataFrame, min_sellers: int = 3) -> DataFrame:
    return topics.where(F.col("sellers") >= min_sellers).orderBy(
        F.desc("real_sellers"), F.desc("buyers"), F.desc("usdc_30d"), "topic")


def topic_detail(listings: DataFrame, board: DataFrame, topic: str) -> DataFrame:
    """Sellers of one topic with their cheapest offer, by revenue."""
    rows = topic_listings(listings).where((F.col("topic") == topic) & (F.col("price") > 0))
    offers = rows.groupBy("host").agg(F.min("price").alias("cheapest"))
    return offers.join(host_money(board), "host", "left").select(
        "host", "cheapest", F.coalesce("money", F.lit(0)).cast("double").alias("usdc_30d"),
        F.col("d.demand").alias("demand")).orderBy(F.desc("usdc_30d"), "host")


def origin_rollup(listings: DataFrame) -> DataFrame:
    """Usage of all listings of an origin."""
    rows = declared_call(with_host(listings, "netloc")).where("host != ''")
    return rows.groupBy(F.col("host").alias("origin")).agg(
        F.count("*").alias("breadth"), F.sum("calls30d").alias("calls30d"),
        F.max("payers30d").alias("payers30d"), F.max("last_called").alias("last_called"))


def sample_listings(listings: DataFrame, k: int = 4) -> DataFrame:
    """The k most called listings of each origin (the probe's sample)."""
    rows = declared_call(with_host(listings, "netloc")).where("host != ''")
    order = Window.partitionBy("host").orderBy(F.desc("calls30d"), "ordinal")
    return rows.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= k).drop("_rn")


def tracked_wallets(listings: DataFrame, board: DataFrame, ratings: DataFrame,
                    prefix: str = "solana") -> DataFrame:
    """Payment addresses on another chain of every host that is ranked or graded."""
    tracked = (board.where("host != ''").select("host")
               .unionByName(ratings.where("grade IS NOT NULL AND service != ''")
                            .select(F.col("service").alias("host"))).distinct())
    offers = with_host(listings).select("ordinal", "host", F.explode("accepts").alias("a"))
    offers = offers.where(F.col("a.network").startswith(prefix) & (F.col("a.payTo") != ""))
    pairs = offers.select("ordinal", "host", F.col("a.payTo").alias("wallet"))
    return first_per(pairs.join(tracked, "host", "left_semi"), ["wallet"], -F.col("ordinal"),
                     F.col("host")).select("wallet", "host")


def registry_overlap(first: DataFrame, second: DataFrame) -> DataFrame:
    """URLs and hosts that are in both registries or in one only."""
    a = first.select(F.col("resource").alias("url")).where("url IS NOT NULL").distinct()
    b = second.select(F.col("resource").alias("url")).where("url IS NOT NULL").distinct()
    both = a.withColumn("a", F.lit(True)).join(b.withColumn("b", F.lit(True)), "url", "full_outer")
    side = (F.when(F.col("a") & F.col("b"), "both").when(F.col("a"), "first only")
            .otherwise("second only"))
    host = F.nullif(host_of(F.col("url"), "netloc"), F.lit(""))
    return both.select("url", side.alias("class"), host.alias("host")).groupBy("class").agg(
        F.count("*").alias("urls"), F.count_distinct("host").alias("hosts"))


def universe(listings: DataFrame, sellers: DataFrame) -> DataFrame:
    """Origins worth checking: registry hosts and revenue-earning hosts together."""
    listed = with_host(listings, "netloc").where("host != ''").groupBy("host").agg(
        F.count("*").alias("breadth"))
    earning = sellers.where("host != ''").select("host", "usd")
    both = listed.join(earning, "host", "full_outer")
    side = (F.when(F.col("breadth").isNotNull() & F.col("usd").isNotNull(), "both")
            .when(F.col("breadth").isNotNull(), "registry only").otherwise("sellers only"))
    return both.select("host", F.coalesce("breadth", F.lit(0)).alias("breadth"),
                       F.coalesce("usd", F.lit(0.0)).alias("usd"), side.alias("class")
                       ).orderBy(F.desc("usd"), F.desc("breadth"), "host")


def price_range(rows: DataFrame, key: str, live: str, advertised: str) -> DataFrame:
    """Lowest and highest price per key: live when it is set and not zero, else advertised."""
    price = F.coalesce(F.nullif(F.col(live), F.lit(0.0)), F.nullif(F.col(advertised), F.lit(0.0)))
    return rows.withColumn("_p", price).where("_p IS NOT NULL").groupBy(key).agg(
        F.min("_p").alias("lo"), F.max("_p").alias("hi"))


def touched_on(listings: DataFrame, day: str) -> DataFrame:
    """First-run view: listings the registry itself says were touched on a day, per host."""
    return with_host(listings.where(F.col("lastUpdated").startswith(day)), "netloc").groupBy(
        "host").agg(F.count("*").alias("n"))


def describe_services(hosts: DataFrame, self_described: DataFrame, listings: DataFrame) -> DataFrame:
    """Description per host: its own words first, else the first registry description."""
    from tollgauge.functions.text import clean_text
    own = self_described.where(F.trim("said") != "").select(
        "host", clean_text(F.col("said")).alias("_own"))
    listed = listings.where(F.col("resource").startswith("http")).select(
        F.split_part("resource", F.lit("/"), F.lit(3)).alias("host"), "ordinal",
        F.trim(F.coalesce("description", F.lit(""))).alias("_d")).where("_d != ''")
    reg = first_per(listed, ["host"], F.col("ordinal")).select(
        "host", clean_text(F.col("_d")).alias("_reg"))
    return hosts.select("host").distinct().join(own, "host", "left").join(reg, "host", "left").select(
        "host", F.coalesce("_own", "_reg").alias("descr"),
        F.when(F.col("_own").isNotNull(), "self").when(F.col("_reg").isNotNull(), "registry")
        .alias("source"))


def listing_chains() -> Column:
    """Sorted distinct chain names a listing can be paid on."""
    named = F.filter("accepts", lambda a: F.coalesce(a["network"] != "", F.lit(False)))
    return F.array_sort(F.array_distinct(F.transform(named, lambda a: chain_name(a["network"]))))
