"""Reading JSON responses: shapes, fields, payments and numbers.

Every operator here is a projection over the parsed document (``variant``): containers are
unfolded level by level with array functions inside the row, so no response is exploded and
gathered again and nothing is shuffled.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgauge import fixed_values as fixed
from tollgauge.functions.numbers import epoch_seconds, half_even, temperature_unit, to_number
from tollgauge.functions.text import has_any

ELEMENT = "~*"          # path step into a list's first element; keys escape "~"
NO_TEXT = "array<string>"


def document(df: DataFrame, col: str) -> Column:
    """The parsed response: a variant column as it is, a text column parsed."""
    if isinstance(df.schema[col].dataType, T.VariantType):
        return F.col(col)
    return F.try_parse_json(col)


def as_object(value: Column) -> Column:
    return F.try_variant_get(value, "$", "map<string,variant>")


def as_list(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>")


KINDS = {"OBJECT": "object", "ARRAY": "array", "STRING": "string", "BOOLEAN": "boolean",
         "VOID": "null", "BIGINT": "integer", "DECIMAL": "number", "DOUBLE": "number",
         "FLOAT": "number"}


def kind_of(value: Column) -> Column:
    """Type name of a JSON value; null when there is no document. Written as one lookup, since
    inside lambdas every mention of the value's schema would be computed again."""
    table = F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair])
    head = F.substring_index(F.substring_index(F.schema_of_variant(value), "<", 1), "(", 1)
    return F.try_element_at(table, head)


def held(rows: DataFrame, *columns: str) -> DataFrame:
    """The rows, with these columns computed once before anything is asked of them. A filter on a plain column is moved
    below its projection, and there repeats its whole expression at every mention."""
    rest = [c for c in rows.columns if c not in columns]
    return rows.select(*rest, F.inline(F.array(F.struct(*columns)))).select(*rows.columns)


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, by binding it to a lambda variable."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _escaped(key: Column) -> Column:
    return F.replace(F.replace(key, F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))


def _unescaped(key: Column) -> Column:
    return F.replace(F.replace(key, F.lit("~1"), F.lit("/")), F.lit("~0"), F.lit("~"))


def json_shape(df: DataFrame, col: str, depth: int = 3, out: str = "shape") -> DataFrame:
    """Add the response's type structure: array<struct<path, type>>, no values.

    A list contributes its first element only, an object all its keys, and containers at the
    depth limit stay closed. Null when the text is not JSON.
    """
    def children(node: Column) -> Column:
        fields = F.transform(F.map_entries(as_object(node["v"])), lambda e: F.struct(
            F.concat(node["path"], F.lit("/"), _escaped(e["key"])).alias("path"),
            e["value"].alias("v")))
        first = F.transform(F.slice(as_list(node["v"]), 1, 1), lambda x: F.struct(
            F.concat(node["path"], F.lit("/" + ELEMENT)).alias("path"), x.alias("v")))
        return F.coalesce(fields, first, F.slice(F.array(node), 1, 0))

    root = F.array(F.struct(F.lit("").alias("path"), document(df, col).alias("v")))
    work = df.withColumn("_l0", root)
    for level in range(1, depth + 1):
        work = work.withColumn(f"_l{level}", F.flatten(F.transform(f"_l{level - 1}", children)))
    nodes = F.concat(*[F.col(f"_l{level}") for level in range(depth + 1)])
    # no node is null, so the natural order needs no comparison written as a lambda
    shape = F.sort_array(F.transform(nodes, lambda n: F.struct(
        n["path"].alias("path"), kind_of(n["v"]).alias("type"))))
    parsed = document(df, col).isNotNull()
    return work.select(*df.columns, F.when(parsed, shape).alias(out))


def shape_rows(df: DataFrame, id_col: str, shape: str = "shape") -> DataFrame:
    """The shape as a relation (id, path, depth, type)."""
    rows = df.select(id_col, F.explode(shape).alias("s"))
    steps = F.length("s.path") - F.length(F.replace("s.path", F.lit("/"), F.lit("")))
    return rows.select(id_col, F.col("s.path").alias("path"), steps.alias("depth"),
                       F.col("s.type").alias("type"))


def shape_text(shape: Column) -> Column:
    """Flat text list of a shape, for hashing and storage in a ledger."""
    return F.transform(shape, lambda s: F.concat(s["path"], F.lit("="), s["type"]))


def untyped_leaves(rows: DataFrame) -> DataFrame:
    """Shape rows whose type is not a type name: a value that must not be published."""
    return rows.where(F.col("type").isNotNull() & ~F.col("type").isin(*fixed.SHAPE_TYPES))


def publishable(receipts: DataFrame, rows: DataFrame, id_col: str = "receipt_id") -> DataFrame:
    """Receipts without any untyped leaf in their stored shape."""
    return receipts.join(untyped_leaves(rows).select(id_col).distinct(), id_col, "left_anti")


# ---- fields and judgement ---------------------------------------------------------------
def _top_keys(document: Column) -> Column:
    return F.coalesce(F.map_keys(as_object(document)), F.array().cast(NO_TEXT))


def _delivered(document: Column) -> Column:
    def inner(value: Column) -> Column:
        record = as_object(F.get(as_list(value), F.lit(0)))
        return F.coalesce(F.map_keys(as_object(value)), F.map_keys(record), F.array().cast(NO_TEXT))
    nested = F.flatten(F.transform(F.map_values(as_object(document)), inner))
    return F.array_distinct(F.concat(_top_keys(document), F.coalesce(nested, F.array().cast(NO_TEXT))))


def delivered_fields(df: DataFrame, col: str, out: str = "fields") -> DataFrame:
    """Keys at the top, one level into objects, and of the first record of any list."""
    return df.withColumn(out, F.array_sort(_delivered(document(df, col))))


def _verdict(is_object: Column, keys: Column, got: Column, expect: Column) -> Column:
    want = F.array_sort(F.array_distinct(F.coalesce(expect, F.array().cast(NO_TEXT))))
    error_keys = F.array(*[F.lit(k) for k in fixed.ERROR_KEYS])
    is_error = F.arrays_overlap(keys, error_keys) & (
        F.size(F.array_intersect(want, keys)) <= F.size(want) * 0.2)
    missing = F.array_except(want, got)
    none = F.array().cast(NO_TEXT)

    def outcome(status, gone, extra, why):
        return F.struct(status.alias("status"), gone.alias("missing"), extra.alias("extra"),
                        why.alias("why"), (status == "delivered").alias("conforms"))

    return (
        F.when(~F.coalesce(is_object, F.lit(False)),
               outcome(F.lit("inconclusive"), want, none, F.lit(fixed.WHY_UNREADABLE)))
        .when(is_error, outcome(F.lit("inconclusive"), want, none, F.lit(fixed.WHY_ERROR_OBJECT)))
        .when(F.size(missing) == 0, outcome(
            F.lit("delivered"), none, F.array_sort(F.array_except(got, want)), F.lit("")))
        .otherwise(outcome(F.lit("short"), missing, F.array_sort(F.array_except(got, want)),
                           F.format_string(fixed.WHY_MISSING, F.size(missing)))))


def judge(df: DataFrame, col: str, expect: str = "expect", prefix: str = "") -> DataFrame:
    """Compare a response with the promised fields: delivered, short or inconclusive.

    A response that cannot be read, or an error object that carries at most a fifth of the
    promise, is inconclusive; only a real response that lacks fields is short.
    """
    parsed = df.withColumn("_doc", document(df, col))
    v = F.col("_doc")
    read = parsed.withColumn("_k", F.map_keys(as_object(v))).withColumn("_g", _delivered(v))
    keys = F.coalesce("_k", F.array().cast(NO_TEXT))
    judged = read.withColumn("_j", _verdict(
        F.col("_k").isNotNull(), keys, F.col("_g"), F.col(expect)))
    return _spread(judged, df.columns, prefix)


def judge_shape(df: DataFrame, shape: str = "shape", expect: str = "expect",
                prefix: str = "") -> DataFrame:
    """The same judgement from a stored shape alone."""
    paths = F.col(f"{shape}.path")
    step = r"[^/]+"
    top = F.filter(paths, lambda p: p.rlike(f"^/{step}$"))
    nested = F.filter(paths, lambda p: p.rlike(f"^/{step}/{step}$") & ~p.endswith("/" + ELEMENT))
    records = F.filter(paths, lambda p: p.rlike(rf"^/{step}/~\*/{step}$"))

    def names(items: Column) -> Column:
        return F.transform(items, lambda p: _unescaped(F.substring_index(p, "/", -1)))

    # each is mentioned several times below, and as a column is computed once
    read = df.withColumn("_k", F.coalesce(names(top), F.array().cast(NO_TEXT)))
    read = read.withColumn("_g", F.array_distinct(F.coalesce(
        F.concat("_k", names(nested), names(records)), F.array().cast(NO_TEXT))))
    is_object = F.exists(shape, lambda s: (s["path"] == "") & (s["type"] == "object"))
    judged = read.withColumn("_j", _verdict(is_object, F.col("_k"), F.col("_g"), F.col(expect)))
    return _spread(judged, df.columns, prefix)


def _spread(judged: DataFrame, columns: Sequence[str], prefix: str) -> DataFrame:
    names = [f"{prefix}{n}" for n in ("status", "missing", "extra", "why", "conforms")]
    kept = [c for c in columns if c not in names]
    return judged.select(*kept, *[
        F.col(f"_j.{n[len(prefix):]}").alias(n) for n in names])


# ---- nodes of a response ----------------------------------------------------------------
def json_nodes(df: DataFrame, col: str, out: str = "nodes", keys: Sequence[str] = ()) -> DataFrame:
    """Add all nodes of the response, however deep, or only the fields with one of ``keys``:
    array<struct<path, key, kind, text, depth, at>>, with paths like ``.a.b[0].c``.

    ``at`` is the node's place: the number of the child at every step (fields in order of their
    names, which is how a variant keeps them), so it orders list elements by number, not as text.
    The document is unfolded level by level until a level is empty; a document cannot have more
    levels than opening brackets.
    """
    def children(node: Column) -> Column:
        fields = F.transform(F.map_entries(as_object(node["v"])), lambda e, i: F.struct(
            F.concat(node["path"], F.lit("."), e["key"]).alias("path"),
            e["key"].alias("key"), e["value"].alias("v"), F.array_append(node["at"], i).alias("at")))
        items = F.transform(as_list(node["v"]), lambda x, i: F.struct(
            F.concat(node["path"], F.lit("["), i.cast("string"), F.lit("]")).alias("path"),
            F.lit(None).cast("string").alias("key"), x.alias("v"), F.array_append(node["at"], i).alias("at")))
        return F.coalesce(fields, items)

    def below(level: Column) -> Column:
        return F.flatten(F.filter(F.transform(level, children), lambda found: found.isNotNull()))

    def described(level: Column, depth: Column) -> Column:
        wanted = F.filter(level, lambda n: n["key"].isin(*keys)) if keys else level
        return F.transform(wanted, lambda n: _once(kind_of(n["v"]), lambda kind: F.struct(
            n["path"].alias("path"), n["key"].alias("key"), kind.alias("kind"),
            F.when(~kind.isin("object", "array"),
                   F.try_variant_get(n["v"], "$", "string")).alias("text"),
            depth.alias("depth"), n["at"].alias("at"))))

    def deeper(state: Column, depth: Column) -> Column:
        # a level is described when the next one is unfolded: to bind it to a variable would copy all nodes found so far
        level = state["level"]
        return F.when(F.size(level) == 0, state).otherwise(F.struct(
            below(level).alias("level"), F.concat(state["nodes"], described(level, depth)).alias("nodes")))

    root = F.array(F.struct(F.lit("").alias("path"), F.lit(None).cast("string").alias("key"),
                            document(df, col).alias("v"), F.array().cast("array<int>").alias("at")))
    first = below(root)
    none = F.array().cast("array<struct<path:string,key:string,kind:string,text:string,depth:int,at:array<int>>>")
    written = F.to_json(document(df, col)) if isinstance(df.schema[col].dataType, T.VariantType) else F.col(col)
    opened = F.length(written) - F.length(F.translate(written, "{[", ""))
    found = F.aggregate(F.sequence(F.lit(1), F.greatest(F.lit(1), F.coalesce(opened, F.lit(0)))),
                        F.struct(first.alias("level"), none.alias("nodes")), deeper)
    return df.select(*df.columns, found["nodes"].alias(out))


def find_payment(df: DataFrame, col: str, out: str = "tx") -> DataFrame:
    """Transaction hash anywhere in an envelope: evidence that money moved. The shallowest
    one wins, then the first by place."""
    work = json_nodes(df, col, "_nodes", fixed.PAYMENT_KEYS)
    hits = F.filter("_nodes", lambda n: (n["kind"] == "string")
                    & n["text"].startswith("0x") & (F.length(n["text"]) > 20))
    first = F.array_min(F.transform(hits, lambda n: F.struct(
        n["depth"].alias("depth"), n["at"].alias("at"), n["text"].alias("text"))))
    return work.select(*df.columns, first["text"].alias(out))


def split_envelope(df: DataFrame, col: str = "stdout") -> DataFrame:
    """Client envelope to (ok, payload, paid, tx, price, status, error). A success carries
    data and metadata; anything else carries error details. The payload stays a variant, so its
    numbers keep their form and it is not parsed again."""
    doc = F.try_parse_json(col)
    work = df.withColumn("_env", doc).withColumn("_ok", F.coalesce(
        F.try_variant_get("_env", "$.success", "boolean"), F.lit(False)))
    # a success states its transaction, so only other envelopes are searched for one
    work = find_payment(work.withColumn("_failed", F.when(~F.col("_ok"), F.col("_env"))), "_failed", out="_tx")

    def text(path):
        return F.try_variant_get("_env", path, "string")

    ok = F.col("_ok")
    status = F.when(ok, text("$.metadata.statusCode")).otherwise(text("$.error.details.statusCode"))
    said = F.coalesce(text("$.error.message"), text("$.error.code"), F.lit(""))
    error = (
        F.when(F.trim(F.coalesce(col, F.lit(""))) == "", "no output")
        .when(F.coalesce(kind_of(F.col("_env")) != "object", F.lit(True)),
              F.when(F.col("_env").isNull(), F.trim(col))
              .otherwise("unexpected envelope"))
        .when(~ok, F.trim(F.concat(F.coalesce(status, F.lit("")), F.lit(" "), said))))
    paid = F.when(ok, F.try_variant_get("_env", "$.metadata.payment.success", "boolean")).otherwise(
        F.coalesce(F.try_variant_get("_env", "$.error.details.payment.success", "boolean"),
                   F.col("_tx").isNotNull()))
    return work.select(
        *df.columns, ok.alias("ok"),
        F.when(ok, F.try_variant_get("_env", "$.data", "variant")).otherwise(
            F.try_variant_get("_env", "$.error.details.body", "variant")).alias("payload"),
        F.coalesce(paid, F.lit(False)).alias("paid"),
        F.when(ok, text("$.metadata.payment.transactionHash")).otherwise(
            F.coalesce(text("$.error.details.payment.transactionHash"), F.col("_tx"))).alias("tx"),
        F.when(ok, text("$.metadata.price")).otherwise(text("$.error.details.price")).alias("price"),
        status.try_cast("bigint").alias("http_status"), error.alias("error"))


def _plain(key: Column) -> Column:
    return F.replace(F.replace(F.lower(key), F.lit("_"), F.lit("")), F.lit(" "), F.lit(""))


def _number(node: Column) -> Column:
    return F.when(node["kind"].isin("integer", "number"), node["text"].try_cast("double")).when(
        node["kind"] == "string", to_number(node["text"]))


def numeric_candidates(df: DataFrame, nodes: str = "nodes", lo: Column | float = 0.0,
                       hi: Column | float = 1e12, hints: Sequence[str] = fixed.VALUE_HINTS,
                       out: str = "candidates") -> DataFrame:
    """Numbers and numeric strings held by object fields, inside an open range, with a mark
    when the field name carries a hint: array<struct<value, path, named, at>>."""
    lo = lo if isinstance(lo, Column) else F.lit(lo)
    hi = hi if isinstance(hi, Column) else F.lit(hi)
    fields = F.filter(nodes, lambda n: n["key"].isNotNull() & n["kind"].isin("integer", "number", "string"))
    valued = F.transform(fields, lambda n: F.struct(
        _number(n).alias("value"), n["path"].alias("path"),
        _once(_plain(n["key"]), lambda k: has_any(k, hints)).alias("named"), n["at"].alias("at")))
    return df.withColumn(out, F.filter(valued, lambda c: (c["value"] > lo) & (c["value"] < hi)))


def nearest(df: DataFrame, reference: str, band: str, kind: str,
            candidates: str = "candidates") -> DataFrame:
    """Best candidate near the reference, hinted fields first, of equally near ones the first by
    place; (value, path) or a reason.

    A value outside the band is not a wrong value: the metric could not be isolated.
    """
    named = F.filter(candidates, lambda c: c["named"])
    pool = F.when(F.size(named) > 0, named).otherwise(F.col(candidates))
    ref, limit = F.col(reference), F.col(band)
    gaps = F.transform(pool, lambda c: F.struct(
        F.abs(c["value"] - ref).alias("gap"), c["at"].alias("at"), c["path"].alias("path"), c["value"].alias("value")))
    near = F.filter(gaps, lambda g: F.when(
        F.col(kind) == "pct", g["gap"] / ref <= limit).otherwise(g["gap"] <= limit))
    picked = df.withColumn("_n", F.array_min(near))
    why = F.when(ref.isNull(), fixed.WHY_NO_REFERENCE).when(
        F.col("_n").isNull(), fixed.WHY_NOT_NEAR)
    return picked.select(*df.columns, F.col("_n.value").alias("value"),
                         F.coalesce("_n.path", why).alias("field"))


def fee_candidates(df: DataFrame, nodes: str = "nodes", out: str = "fees") -> DataFrame:
    """Figures that could be a network fee, with key and path."""
    fees = F.transform(
        F.filter(nodes, lambda n: n["key"].isNotNull() & has_any(F.lower(n["key"]), fixed.FEE_HINTS)),
        lambda n: F.struct(_number(n).alias("value"), n["key"].alias("key"), n["path"].alias("path")))
    return df.withColumn(out, F.filter(fees, lambda f: (f["value"] > 0) & (f["value"] < 1e6)))


def staleness(df: DataFrame, as_of_epoch: float, nodes: str = "nodes") -> DataFrame:
    """Age in seconds of the newest plausible clock reading in the response."""
    clocks = F.transform(
        F.filter(nodes, lambda n: n["kind"].isin("integer", "number")
                 & has_any(_plain(n["key"]), fixed.CLOCK_HINTS)),
        lambda n: epoch_seconds(n["text"].try_cast("double")))
    newest = F.array_max(F.array_compact(clocks))
    return df.withColumn("age_s", half_even(F.lit(float(as_of_epoch)) - newest, 1))


def block_delta(df: DataFrame, references: Sequence[int], nodes: str = "nodes") -> DataFrame:
    """Blocks behind the reference head the response's highest block is close to; the last
    matching reference decides."""
    blocks = F.transform(
        F.filter(nodes, lambda n: n["kind"].isin("integer", "number")
                 & _plain(n["key"]).contains("block")),
        lambda n: n["text"].try_cast("double"))
    top = F.array_max(F.filter(blocks, lambda b: (b > 1e6) & (b < 1e9))).cast("bigint")
    delta = F.lit(None).cast("bigint")
    for head in references:
        delta = F.when(F.abs(top - head) < 5000, F.lit(head) - top).otherwise(delta)
    return df.withColumn("block_delta", delta)


def temperature_candidates(df: DataFrame, nodes: str = "nodes", out: str = "temps") -> DataFrame:
    """Temperature readings with unit, from numeric fields only."""
    temps = F.transform(
        F.filter(nodes, lambda n: n["key"].isNotNull() & n["kind"].isin("integer", "number")
                 & has_any(F.lower(n["key"]), fixed.TEMPERATURE_HINTS)),
        lambda n: F.struct(
            n["text"].try_cast("double").alias("value"), n["path"].alias("path"),
            temperature_unit(F.lower(n["key"]), n["text"].try_cast("double")).alias("unit")))
    return df.withColumn(out, F.filter(temps, lambda t: (t["value"] > -100) & (t["value"] < 150)))


def classify_screen(df: DataFrame, col: str, nodes: str = "nodes") -> DataFrame:
    """Screener answer: flagged, clear or unclear. Explicit booleans decide first (in order of
    their places), then risk words, then phrases."""
    def vote(node: Column) -> Column:
        key = F.lower(node["key"])
        yes = node["text"] == "true"
        return (F.when(key.contains("clean") & yes, "clear")
                .when(has_any(key, fixed.SCREEN_FLAG_KEYS) & yes, "flagged")
                .when(has_any(key, fixed.SCREEN_CLEAR_KEYS) & ~yes, "clear"))

    votes = F.transform(
        F.filter(nodes, lambda n: n["key"].isNotNull() & (n["kind"] == "boolean")),
        lambda n: F.struct(n["at"].alias("at"), vote(n).alias("vote")))
    decided = F.array_min(F.filter(votes, lambda v: v["vote"].isNotNull()))["vote"]
    read = df.withColumn("_doc", document(df, col))
    read = read.withColumn("_blob", F.lower(F.to_json("_doc")))  # asked for every word below
    blob = F.col("_blob")
    words = (
        F.when(has_any(blob, fixed.SCREEN_HIGH_RISK), "flagged")
        .when(has_any(blob, fixed.SCREEN_LOW_RISK), F.when(
            ~has_any(blob, ("sanction", "ofac")) | blob.contains("false"), "clear").otherwise("unclear"))
        .when(has_any(blob, fixed.SCREEN_CLEAR_WORDS), "clear")
        .when(has_any(blob, fixed.SCREEN_HIT_WORDS), "flagged")
        .otherwise("unclear"))
    readable = F.coalesce(kind_of(F.col("_doc")).isin("object", "array"), F.lit(False))
    return read.withColumn("screen", F.when(
        readable, F.coalesce(decided, words)).otherwise("unclear")).drop("_doc", "_blob")


def retarget(fields: Column, replacements: dict[str, Sequence[str]]) -> Column:
    """Point an input map at a target: value -> names of the fields it replaces."""
    def swap(key: Column, value: Column) -> Column:
        out = value
        for target, names in replacements.items():
            out = F.when(F.lower(key).isin(*names), F.lit(target)).otherwise(out)
        return out
    return F.transform_values(fields, swap)


def retarget_place(fields: Column, place: str, latitude: str, longitude: str) -> Column:
    """Point an input map at a place by whichever of its fields name one; other fields stay as advertised."""
    return retarget(fields, {place: fixed.PLACE_FIELDS, longitude: fixed.LONGITUDE_FIELDS, latitude: fixed.LATITUDE_FIELDS})
