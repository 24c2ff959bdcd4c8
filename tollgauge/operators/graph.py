"""Services that share wallets: connected components and their canonical member."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tollgauge.functions.demand import directory_demand
from tollgauge.fixed_values import MEMBER_NOISE
from tollgauge.operators.board import noise_count
from tollgauge.sources.storage import drop_checkpoint, ensure_checkpoint_dir


def _large_star(edges: DataFrame) -> DataFrame:
    """Connect every larger neighbour of a node to the node's smallest neighbour."""
    both = edges.select(F.inline(F.array(
        F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Connect every smaller neighbour of a node, and the node, to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    # a neighbour moves to the smallest one; the smallest keeps the node itself
    return down.join(least, "a").select(
        F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"),
        F.col("m").alias("b"))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest node of each node's component. Input edges (a, b), any direction.

    Alternates large-star and small-star (Kiveris et al., 2014), which needs a logarithmic
    number of rounds even on long chains. Minima are combining aggregates, and the join of a
    hot node's edges meets one row per node, which adaptive skew handling can split. Each
    round is checkpointed to the shared folder, so lost executors do not replay the loop; the round
    before it is removed once it stands.
    """
    spark: SparkSession = edges.sparkSession
    ensure_checkpoint_dir(spark)
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    current = edges.where("a != b").select("a", "b").distinct().checkpoint()
    seen = None
    for _ in range(max_rounds):
        before, current = current, _small_star(_large_star(current).distinct()).distinct().checkpoint()
        drop_checkpoint(before)
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    labels = current.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return nodes.join(labels, "node", "left").select(
        "node", F.coalesce("label", "node").alias("component"))


def extend_components(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """Components after new edges, from those before: (node, component) of every old and new node.

    The old graph is not read again. New edges are drawn between the old components of their ends, so the contraction works on
    as many rows as there are new edges; components that no new edge touches only pass through a join.
    """
    known = labels.select("node", "component")
    fresh = edges.select("a", "b")
    for end in ("a", "b"):
        seen = known.select(F.col("node").alias(end), F.col("component").alias("_c"))
        fresh = fresh.join(seen, end, "left").withColumn(f"_{end}", F.coalesce("_c", F.col(end))).drop("_c")
    moved = components(fresh.select(F.col("_a").alias("a"), F.col("_b").alias("b"))).select(
        F.col("node").alias("component"), F.col("component").alias("_to"))
    new = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(known, "node", "left_anti").select(
        "node", F.col("node").alias("component"))
    return known.unionByName(new).join(moved, "component", "left").select("node", F.coalesce("_to", "component").alias("component"))


def component_flags(members: DataFrame) -> DataFrame:
    """Flags of a component's members, a row each: a component may have any number of them."""
    return members.select("component", F.explode("flags").alias("flag")).distinct()


def service_edges(services: DataFrame) -> DataFrame:
    """Edges between services and their wallets; each service also has one to itself."""
    named = services.select(F.concat(F.lit("svc:"), "origin").alias("a"), "payto")
    pairs = named.select("a", F.explode("payto").alias("w")).where("w != ''").select(
        "a", F.concat(F.lit("addr:"), F.lower("w")).alias("b")).distinct()
    lone = named.select("a", F.col("a").alias("b"))
    return pairs.unionByName(lone)


def services_of(labels: DataFrame) -> DataFrame:
    """Component of every service of the service-wallet graph."""
    return labels.where(F.col("node").startswith("svc:")).select(F.expr("substring(node, 5)").alias("origin"), "component")


def service_components(services: DataFrame) -> DataFrame:
    """Component of every service in the service-wallet graph."""
    return services_of(components(service_edges(services)))


def _member_order():
    host = F.lower("origin")
    name = F.substring(F.replace(F.replace(F.lower(F.coalesce("service", F.lit(""))),
                                           F.lit(" "), F.lit("")), F.lit("."), F.lit("")), 1, 6)
    bare = F.replace(F.replace(host, F.lit("-"), F.lit("")), F.lit("."), F.lit(""))
    brand = F.when((name != "") & bare.contains(name), 0).otherwise(1)
    dashes = F.length(host) - F.length(F.replace(host, F.lit("-"), F.lit("")))
    return [brand, noise_count(host, MEMBER_NOISE), dashes, F.length(host), F.col("origin")]


def canonical_member(members: DataFrame) -> DataFrame:
    """Per component: the most brand-like member, how many others, and up to five names.

    Only the six best members of a component are ranked beyond the map side.
    """
    ordered = members.select("component", "origin", F.struct(*[
        c.alias(f"o{i}") for i, c in enumerate(_member_order())]).alias("o"))
    counts = ordered.groupBy("component").agg((F.count("*") - 1).alias("also_listed"))
    best = Window.partitionBy("component").orderBy("o")
    top = ordered.withColumn("rn", F.row_number().over(best)).where("rn <= 6")
    names = top.groupBy("component").agg(
        F.max(F.when(F.col("rn") == 1, F.col("origin"))).alias("head"),
        F.array_sort(F.collect_list(F.when(F.col("rn") > 1, F.struct("rn", "origin")))).alias("_n"))
    return names.join(counts, "component").select(
        "component", "head", "also_listed",
        F.transform("_n", lambda n: n["origin"]).alias("also_names"))


def merge_services(members: DataFrame) -> DataFrame:
    """One row per component: canonical member, the best settled member's settlement, demand
    tier and the union of flags. Input: service rows with component, settlements, usdc,
    payers (null when nothing settled) and flags."""
    heads = canonical_member(members)
    best = members.where("settlements IS NOT NULL").groupBy("component").agg(
        F.min_by(F.struct("settlements", "usdc", "payers"),
                 F.struct((-F.col("settlements")).alias("k"), F.col("origin"))).alias("_b"))
    flags = (members.select("component", F.explode("flags").alias("f")).distinct()
             .groupBy("component").agg(F.array_sort(F.collect_list("f")).alias("flags")))
    rows = heads.join(best, "component", "left").join(flags, "component", "left")
    tier = directory_demand(F.col("_b.settlements"), F.col("_b.payers"))
    return rows.select(
        "component", "head", "also_listed", "also_names",
        F.col("_b.settlements").alias("settlements"), F.col("_b.usdc").alias("usdc"),
        F.col("_b.payers").alias("payers"), tier["tier"].alias("demand"), tier["why"].alias("why"),
        F.coalesce("flags", F.array().cast("array<string>")).alias("flags"))


def distinct_wallet_totals(services: DataFrame) -> DataFrame:
    """Settlement over distinct wallet sets (the first service by settlements counts), the top
    service's share of it, and how many services are quiet."""
    keyed = services.withColumn("wallets", F.array_join(F.array_sort(
        F.transform("payto", lambda a: F.lower(a))), ","))
    settled = keyed.where("settlements IS NOT NULL AND wallets != ''")
    order = F.struct((-F.col("settlements")).alias("a"), (-F.col("payers")).alias("b"), F.col("origin"))
    unique = settled.groupBy("wallets").agg(
        F.min_by(F.struct("settlements", "usdc"), order).alias("u"))
    tagged = unique.select(F.lit("u").alias("k"), F.col("u.settlements").alias("n"),
                           F.col("u.usdc").cast("decimal(28,6)").alias("usd"))
    every = keyed.select(F.when(F.col("settlements").isNull(), "quiet").otherwise("settled").alias("k"),
                         F.col("settlements").alias("n"), F.lit(None).cast("decimal(28,6)").alias("usd"))
    both = tagged.unionByName(every)
    tx = F.coalesce(F.sum(F.when(F.col("k") == "u", F.col("n"))), F.lit(0))
    top = F.max(F.when(F.col("k") == "settled", F.col("n")))
    return both.agg(
        tx.alias("settlements"),
        F.coalesce(F.sum("usd"), F.lit(0)).cast("double").alias("usdc"),
        F.coalesce(F.bround(100.0 * top / F.greatest(F.lit(1), tx), 0), F.lit(0.0)).cast("bigint")
        .alias("top_share"),
        F.count_if(F.col("k") == "quiet").alias("quiet"))
