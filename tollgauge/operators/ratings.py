"""Grades earned by buying: tallies, grades per service, picks and related posts."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tollgauge import fixed_values as fixed
from tollgauge.functions.grades import grade_rank


def graded_posts(posts: DataFrame) -> DataFrame:
    return posts.where(F.col("grade").isNotNull() & (F.upper("grade") != "UNGRADED"))


def grades_by_service(posts: DataFrame) -> DataFrame:
    """Grades of each service, best first, with how often each was given.

    The list is one entry per distinct grade, so its length is bounded by the grade scale.
    """
    counts = graded_posts(posts).where("service != ''").groupBy("service", "grade").agg(
        F.count("*").alias("n"), F.min("ordinal").alias("first"))
    ranked = F.struct(grade_rank(F.col("grade")).alias("rank"), F.col("grade"), F.col("n"))
    return counts.groupBy("service").agg(
        F.array_sort(F.collect_list(ranked)).alias("_g"), F.min("first").alias("first_ordinal")
    ).select("service", F.transform("_g", lambda g: F.struct(g["grade"].alias("grade"),
                                                            g["n"].alias("n"))).alias("grades"),
             "first_ordinal")


def with_grades(board: DataFrame, posts: DataFrame) -> DataFrame:
    grades = grades_by_service(posts).select(F.col("service").alias("host"), "grades")
    return board.join(grades, "host", "left")


def rating_tally(posts: DataFrame) -> DataFrame:
    """One row: honest, failed, free, graded without a purchase, distinct services."""
    call = F.col("call")
    return graded_posts(posts).agg(
        F.count("*").alias("ratings"), F.count_distinct("service").alias("services"),
        F.count_if(call == "Honest").alias("honest"),
        F.count_if((call != "") & (call != "Honest")).alias("failed"),
        F.count_if((F.coalesce(call, F.lit("")) == "") & F.col("free")).alias("free"),
        F.count_if((F.coalesce(call, F.lit("")) == "") & ~F.col("free")).alias("not_bought"))


def grade_spread(posts: DataFrame) -> DataFrame:
    """Best, middle and worst post: positions 1, n/2+1 and n of the grade order.

    Positions are found on counts per grade; within the grade that holds a position, posts are
    ordered by a hash of their number, so no task orders all posts.
    """
    known = posts.where(grade_rank(F.col("grade")) < len(fixed.GRADES)).withColumn(
        "g", grade_rank(F.col("grade"))).withColumn("h", F.md5(F.col("id").cast("string")))
    keyed = known.withColumn("b", F.substring("h", 1, 3))
    # at most 13 grades x 4096 hash prefixes are ordered here
    order = Window.orderBy("g", "b")
    cells = keyed.groupBy("g", "b").agg(F.count("*").alias("c")).select(
        "g", "b", "c",
        (F.sum("c").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("c")).alias("before"),
        F.sum("c").over(order.rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing)).alias("n"))
    positions = F.array(
        F.struct(F.lit("best").alias("pick"), F.lit(0).cast("bigint").alias("pos")),
        F.struct(F.lit("middle").alias("pick"), F.floor(F.col("n") / 2).alias("pos")),
        F.struct(F.lit("worst").alias("pick"), (F.col("n") - 1).alias("pos")))
    spots = cells.where("n >= 3").withColumn("p", F.explode(positions)).where(
        (F.col("p.pos") >= F.col("before")) & (F.col("p.pos") < F.col("before") + F.col("c"))
    ).select("g", "b", "p.pick", (F.col("p.pos") - F.col("before")).alias("offset"))
    rank = F.row_number().over(Window.partitionBy("pick").orderBy("h", "id"))
    hits = keyed.join(F.broadcast(spots), ["g", "b"]).withColumn("rn", rank)
    return hits.where(F.col("rn") == F.col("offset") + 1).select("pick", "id", "service", "grade")


#: a tag on more tag sets than this is a common one
COMMON_SETS = 200


def _overlaps(sets: DataFrame, common: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """How many tags the tag sets of a scope share, without pairing all sets that share a common tag.

    Input: one row per (scope, tset) with ``tags``. Gives three tables. ``rare`` (scope, tset, tset2, shared): pairs that share a
    tag found on at most ``common`` sets, with all they share. ``kinds`` (scope, tset, kind): the common tags of a
    set, as text. ``between`` (scope, kind, kind2, shared): how many common tags two kinds share, if any. Sets of one kind are
    alike to every set that shares no rare tag with them, and there are few kinds: tags above the limit are few.
    """
    one = sets.select("scope", "tset", F.explode("tags").alias("t"))
    spread = one.groupBy("scope", "t").agg((F.count("*") > common).alias("often"))
    marked = one.join(spread, ["scope", "t"])
    often = marked.where("often").groupBy("scope", "tset").agg(F.array_sort(F.collect_list("t")).alias("ct"))
    kinds = sets.select("scope", "tset").join(often, ["scope", "tset"], "left").select(
        "scope", "tset", F.coalesce("ct", F.array().cast("array<string>")).alias("ct")).withColumn("kind", F.array_join("ct", "\u0001"))
    kind = kinds.select("scope", "kind", "ct").distinct().select("scope", "kind", F.explode("ct").alias("t"))
    between = kind.join(kind.select("scope", F.col("kind").alias("kind2"), "t"), ["scope", "t"]).groupBy(
        "scope", "kind", "kind2").agg(F.count("*").alias("shared"))
    seldom = marked.where("not often").select("scope", "tset", "t")
    pairs = seldom.join(seldom.select("scope", F.col("tset").alias("tset2"), "t"), ["scope", "t"]).groupBy(
        "scope", "tset", "tset2").agg(F.count("*").alias("n"))
    of = kinds.select("scope", "tset", "kind")
    rare = pairs.join(of, ["scope", "tset"]).join(of.select("scope", F.col("tset").alias("tset2"), F.col("kind").alias("kind2")), [
        "scope", "tset2"]).join(between, ["scope", "kind", "kind2"], "left").select(
        "scope", "tset", "tset2", (F.col("n") + F.coalesce("shared", F.lit(0))).alias("shared"))
    return rare, of, between


def _first(rows: DataFrame, keys: list[str], n: int, *order) -> DataFrame:
    return rows.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_rn") <= n).drop("_rn")


def related(posts: DataFrame, k: int = 4, common: int = COMMON_SETS) -> DataFrame:
    """The k posts most related to each post: same service first, then most shared tags, then
    lowest id; posts that share neither are not related.

    Posts with the same service and tag set are interchangeable, so candidates are ranked per
    (service, tag set) profile and each profile carries only the few ids that can still win. Pairs are formed
    between tag sets that share a rare tag, and between the few kinds of sets that common tags make; of
    each kind only the lowest ids can win, so pairs grow with the posts however common a tag is.
    """
    none = F.array().cast("array<string>")
    tagged = posts.select("id", F.coalesce("service", F.lit("")).alias("service"),
                          F.array_sort(F.array_distinct(F.coalesce("tags", none))).alias("tags"))
    tagged = tagged.withColumn("tset", F.array_join("tags", "\u0001"))
    few = _first(tagged, ["service", "tset"], k + 1, "id").select("service", "tset", "id")
    profiles = tagged.select("service", "tset").distinct()

    # same service: any tag set counts, shared tags break the order
    own = tagged.where("service != ''").select(F.col("service").alias("scope"), "tset", "tags").distinct()
    rare, kinds, between = _overlaps(own, common)
    mine = few.where("service != ''").withColumnRenamed("service", "scope")
    by_rare = rare.join(mine.select("scope", F.col("tset").alias("tset2"), "id"), ["scope", "tset2"]).select("scope", "tset", "id", "shared")
    of_kind = _first(mine.join(kinds, ["scope", "tset"]), ["scope", "kind"], k + 1, "id")
    by_kind = kinds.join(of_kind.select("scope", F.col("kind").alias("kind2"), "id"), "scope").join(
        between, ["scope", "kind", "kind2"], "left").select("scope", "tset", "id", F.coalesce("shared", F.lit(0)).alias("shared"))
    peers = by_rare.unionByName(by_kind).groupBy("scope", "tset", "id").agg(F.max("shared").alias("shared"))
    same = _first(peers, ["scope", "tset"], k + 1, F.desc("shared"), "id").select(
        F.col("scope").alias("service"), "tset", "id", F.lit(0).alias("grp"), "shared")

    # other services: per tag set keep k ids of each service, then the first 2k; whichever service is left out, k ids remain
    sets = tagged.select(F.lit("").alias("scope"), "tset", "tags").distinct()
    rare, kinds, between = (df.drop("scope") for df in _overlaps(sets, common))
    by_rare = rare.join(few.select(F.col("tset").alias("tset2"), "service", "id"), "tset2").select("tset", "service", "id", "shared")
    lowest = _first(few.join(kinds, "tset"), ["kind", "service"], k + 1, "id")
    per_kind = between.join(lowest.select(F.col("kind").alias("kind2"), "service", "id"), "kind2")
    per_kind = _first(_first(per_kind, ["kind", "service"], k + 1, F.desc("shared"), "id"), ["kind"], 3 * k + 3, F.desc("shared"), "id")
    by_kind = kinds.join(per_kind.select("kind", "service", "id", "shared"), "kind").select("tset", "service", "id", "shared")
    cand = by_rare.unionByName(by_kind).groupBy("tset", "service", "id").agg(F.max("shared").alias("shared"))
    capped = _first(cand, ["tset", "service"], k + 1, F.desc("shared"), "id")
    lead = _first(capped, ["tset"], 2 * k + 2, F.desc("shared"), "id").select(
        "tset", F.col("service").alias("service2"), "id", "shared")
    other = profiles.join(lead, "tset").where((F.col("service") != F.col("service2")) | (F.col("service") == "")).select(
        "service", "tset", "id", F.lit(1).alias("grp"), "shared")
    pool = same.unionByName(other).withColumnRenamed("id", "related_id")
    short = pool.withColumn("rn", F.row_number().over(Window.partitionBy("service", "tset").orderBy(
        "grp", F.desc("shared"), "related_id"))).where(F.col("rn") <= k + 1)
    found = tagged.select("id", "service", "tset").join(short, ["service", "tset"]).where(F.col("id") != F.col("related_id"))
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("id").orderBy("rn"))).where(F.col("rank") <= k).select(
        "id", "related_id", F.col("rank").cast("bigint").alias("rank"))


def related_notes(posts: DataFrame, notes: DataFrame, k: int = 2) -> DataFrame:
    """Up to k notes sharing any tag with a post, in note order; posts without one get the
    first k notes."""
    sets = posts.select(F.array_join(F.array_sort(F.array_distinct("tags")), "\u0001").alias("tset"),
                        "tags").distinct()
    one = sets.select("tset", F.explode("tags").alias("t")).distinct()
    first_by_tag = Window.partitionBy("t").orderBy("ordinal")
    by_tag = notes.select("note_id", "ordinal", F.explode("tags").alias("t")).withColumn(
        "rn", F.row_number().over(first_by_tag)).where(F.col("rn") <= k).drop("rn")
    hits = one.join(by_tag, "t").select("tset", "note_id", "ordinal").distinct()
    order = Window.partitionBy("tset").orderBy("ordinal")
    best = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "tset", "note_id", "rank")
    few = notes.orderBy("ordinal").limit(k).select("note_id", "ordinal")
    fallback = few.withColumn("rank", F.row_number().over(Window.orderBy("ordinal"))).select(
        "note_id", "rank")
    bare = sets.select("tset").distinct().join(best, "tset", "left_anti")
    slots = bare.select("tset", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("rank"))
    rest = slots.join(F.broadcast(fallback), "rank").select("tset", "note_id", "rank")
    keyed = posts.select("id", F.array_join(F.array_sort(F.array_distinct("tags")), "\u0001").alias("tset"))
    return keyed.join(best.unionByName(rest), "tset").select(
        "id", "note_id", F.col("rank").cast("bigint").alias("rank"))
