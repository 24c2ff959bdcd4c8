"""Content-addressed records of judged calls, their verification and the ledger."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollgauge import fixed_values as fixed
from tollgauge import schemas
from tollgauge.functions.numbers import to_bool, to_number
from tollgauge.functions.text import has_any
from tollgauge.operators.archive import as_pointers, identified, link_first, link_last
from tollgauge.operators.ranks import first_per
from tollgauge.operators.shapes import document, json_shape, judge_shape, kind_of, shape_text

ID_PREFIX = "rcpt_"
LOGICAL_KEY = ["kind", "url", "metric", "ts"]


def content_id(evidence: Column, prefix: str = ID_PREFIX) -> Column:
    """Tamper-evident id over an evidence struct whose fields are in alphabetical order."""
    text = F.to_json(evidence, {"ignoreNullFields": "false"})
    return F.concat(F.lit(prefix), F.substring(F.sha2(text, 256), 1, 16))


def _sorted(col: str) -> Column:
    return F.array_sort(F.coalesce(F.col(col), F.array().cast("array<string>")))


def delivery_evidence() -> Column:
    """The facts a dispute turns on, and only those; amounts are text."""
    return F.struct(
        F.col("charged"), _sorted("extra").alias("extra"), F.col("free"), F.col("host"),
        _sorted("missing").alias("missing"), F.col("observed"), F.col("paid"),
        _sorted("promised").alias("promised"), F.col("quoted"), F.col("status"),
        F.nullif(F.col("tx"), F.lit("")).alias("tx"), F.col("url"),
        F.coalesce("why", F.lit("")).alias("why"))


def accuracy_evidence() -> Column:
    return F.struct("dev_value", "field", "host", "metric", "paid", "quoted", "returned",
                    "status", "tol_value", "truth", "truth_source", "unit", "url")


def link_capture_first(calls: DataFrame, captures: DataFrame) -> DataFrame:
    """Archived response of each call by (url, tx), transaction null-safe; the first archived
    occurrence wins."""
    first = first_per(captures.where("url IS NOT NULL").select("url", "tx", "file", "line"),
                      ["url", "tx"], F.col("file"), F.col("line"))
    right = first.select(F.col("url").alias("_u"), F.col("tx").alias("_t"),
                         F.col("file").alias("raw_file"), F.col("line").alias("raw_line"))
    return calls.join(right, (F.col("url") == F.col("_u")) & F.col("tx").eqNullSafe(F.col("_t")),
                      "left").drop("_u", "_t")


def link_capture_last(calls: DataFrame, captures: DataFrame) -> DataFrame:
    """Archived response of each call by URL alone; the last archived occurrence wins."""
    last = captures.where("url IS NOT NULL").groupBy("url").agg(
        F.max_by(F.struct("file", "line", "tx"), F.struct("file", "line")).alias("_r"))
    return calls.join(last, "url", "left").select(
        *calls.columns, F.col("_r.file").alias("raw_file"), F.col("_r.line").alias("raw_line"),
        F.col("_r.tx").alias("raw_tx"))


def delivery_receipts(conformance: DataFrame, pointers: DataFrame, ts: str) -> DataFrame:
    """One receipt per judged call. Input rows carry a ``shape`` (types only); ``pointers`` is the
    table of ``archive.capture_pointers``, or the captures it is made of."""
    rows = conformance.where("url IS NOT NULL").select(
        "url", "host", F.col("quoted").cast("string").alias("quoted"),
        F.col("charged").cast("string").alias("charged"),
        to_bool(F.col("paid").cast("string")).alias("paid"),
        to_bool(F.col("free").cast("string")).alias("free"),
        F.nullif(F.col("tx"), F.lit("")).alias("tx"), F.col("ms").cast("bigint").alias("latency_ms"),
        "promised", "shape", shape_text(F.col("shape")).alias("observed"), "missing", "extra",
        "status", F.coalesce("why", F.lit("")).alias("why"))
    linked = link_first(rows, as_pointers(pointers))
    reverified = F.col("why") == fixed.WHY_CONFIRMED
    two_call = reverified | F.col("why").contains("re-verify")
    return linked.select(
        content_id(delivery_evidence()).alias("receipt_id"), F.lit("delivery").alias("kind"),
        F.lit(ts).alias("ts"), F.lit("").alias("metric"), "url", "host", "quoted", "charged", "paid",
        "free", "tx", "latency_ms", _sorted("promised").alias("promised"), "shape", "observed",
        _sorted("missing").alias("missing"), _sorted("extra").alias("extra"), "status", "why",
        reverified.alias("reverified"),
        F.when(two_call, "two-call reconcile").otherwise("single call").alias("decided_by"),
        "raw_file", "raw_id")


def accuracy_status(returned: Column, dev: Column, tol: Column) -> Column:
    return (F.when(returned.isNull(), "inconclusive")
            .when(F.coalesce(F.abs(dev) <= tol, F.lit(False)), "accurate").otherwise("off"))


def accuracy_receipts(graded: DataFrame, pointers: DataFrame | None = None) -> DataFrame:
    """Receipts of graded numbers. Input: (url, host, quoted, paid, metric, returned, truth,
    truth_source, dev_value, tol_value, unit, field, ts, note). With ``pointers`` each carries the response of
    its URL that was archived last, and the payment made for it."""
    status = accuracy_status(F.col("returned"), F.col("dev_value"), F.col("tol_value"))
    why = (F.when(status == "inconclusive", F.coalesce("note", F.lit("no value returned to grade")))
           .when(status == "accurate", "within tolerance of the primary source")
           .otherwise("outside tolerance of the primary source"))
    rows = graded.where("url IS NOT NULL").select(
        *[F.col(c).cast("string").alias(c) for c in ("quoted",)],
        "url", "host", "paid", "metric", "returned", "truth", "truth_source", "dev_value",
        "tol_value", "unit", "field", "ts", status.alias("status"), why.alias("why"))
    made = rows.select(content_id(accuracy_evidence()).alias("receipt_id"), F.lit("accuracy").alias("kind"), "*")
    if pointers is None:
        return made
    paid = F.coalesce(to_bool(F.col("paid").cast("string")), F.lit(False))
    return link_last(made, as_pointers(pointers)).withColumns({
        "charged": F.when(paid, F.col("quoted")).otherwise("0"), "free": ~paid, "tx": F.col("raw_tx"),
        "reverified": F.lit(False), "decided_by": F.lit("single call")}).drop("raw_tx")


def as_ledger(receipts: DataFrame) -> DataFrame:
    """Receipts of any kind in the columns of one ledger; what a kind does not state is null."""
    kinds = {name: kind for name, kind in (c.strip().split(" ", 1) for c in schemas.LEDGER_COLUMNS)}
    have = set(receipts.columns)
    return receipts.select(*[(F.col(name) if name in have else F.lit(None)).cast(kind).alias(name) for name, kind in kinds.items()])


def _number(column: str) -> Column:
    return to_number(F.col(column).cast("string"))


def _paid(rows: DataFrame, otherwise: bool) -> Column:
    if "paid" not in rows.columns:
        return F.lit(otherwise)
    return F.when(F.col("paid").isNull(), otherwise).otherwise(to_bool(F.col("paid").cast("string")))


def from_price(rows: DataFrame) -> DataFrame:
    """Rows of the price comparison in the form receipts are made from. Input: the rows' own (host, url, quoted, paid, price, dev_bps,
    field) beside the run's (symbol, reference_end, reference_sources, generated)."""
    sources = F.coalesce(F.nullif(F.array_join("reference_sources", "/"), F.lit("")), F.lit(fixed.TRUTH_EXCHANGES))
    return _claims(rows, F.concat(F.coalesce("symbol", F.lit("spot")), F.lit(" price")), _number("price"), F.col("reference_end"),
                   F.concat(F.lit("median of "), sources), _number("dev_bps"), F.lit(50.0), F.lit("bps"), F.col("field"), _paid(rows, False))


def from_balance(rows: DataFrame) -> DataFrame:
    """Rows of the balance comparison: (host, url, quoted, paid, usdc, dev) beside the run's (target, chain_usdc_end, generated)."""
    target = F.coalesce("target", F.lit(""))
    shown = F.when(F.length(target) > 12, F.concat(F.left(target, F.lit(6)), F.lit("…"), F.right(target, F.lit(4)))).otherwise(target)
    return _claims(rows, F.concat(F.lit("USDC balance of "), shown, F.lit(" on Base")), _number("usdc"), F.col("chain_usdc_end"),
                   F.lit(fixed.TRUTH_CHAIN), _number("dev"), F.lit(0.01), F.lit("USDC"), F.lit(".usdc"), _paid(rows, True))


def from_stock(rows: DataFrame) -> DataFrame:
    """Rows of the stock comparison: (host, url, quoted, paid, price, dev_bps, field) beside the run's (symbol, reference, generated)."""
    return _claims(rows, F.concat(F.coalesce("symbol", F.lit("stock")), F.lit(" real-time stock price")), _number("price"),
                   F.col("reference"), F.lit(fixed.TRUTH_STOCK), _number("dev_bps"), F.lit(50.0), F.lit("bps"), F.col("field"), _paid(rows, True))


def from_lab(rows: DataFrame) -> DataFrame:
    """Rows of the daily comparison: (host, url, quoted, paid, value, dev, field) beside their category's (category, metric,
    source, reference, tol, unit) and the run's generated."""
    return _claims(rows, F.coalesce("metric", "category"), _number("value"), F.col("reference"), F.coalesce("source", F.lit("")),
                   _number("dev"), F.coalesce("tol", F.lit(100.0)), F.coalesce("unit", F.lit("")), F.col("field"), _paid(rows, True))


def _claims(rows, metric, returned, truth, source, dev, tol, unit, field, paid) -> DataFrame:
    return rows.where("url IS NOT NULL").select(
        "url", "host", "quoted", paid.alias("paid"), metric.alias("metric"), returned.alias("returned"),
        truth.cast("double").alias("truth"), source.alias("truth_source"), dev.alias("dev_value"), tol.cast("double").alias("tol_value"),
        unit.alias("unit"), field.alias("field"), F.substring(F.coalesce("generated", F.lit("")), 1, 10).alias("ts"))


ADAPTERS = {"price": from_price, "balance": from_balance, "stock": from_stock, "lab": from_lab}


def receipts_of_source(rows: DataFrame, kind: str, pointers: DataFrame | None = None) -> DataFrame:
    """Accuracy receipts from a source's rows in their own form."""
    return receipts_from(ADAPTERS[kind](rows), kind, pointers)


def guard_field(rows: DataFrame, value: str = "returned") -> DataFrame:
    """Null the value of a field that plainly is not a price and say why."""
    bad = has_any(F.lower(F.coalesce("field", F.lit(""))), fixed.NON_PRICE_WORDS)
    rest = [c for c in rows.columns if c not in (value, "dev_value", "note")]
    note = F.col("note") if "note" in rows.columns else F.lit(None).cast("string")
    return rows.select(
        *rest, F.when(~bad, F.col(value)).alias(value),
        F.when(~bad, F.col("dev_value")).alias("dev_value"),
        F.when(bad, F.format_string(fixed.WHY_NON_PRICE, F.col("field"))).otherwise(note).alias("note"))


def receipts_from(rows: DataFrame, kind: str, pointers: DataFrame | None = None) -> DataFrame:
    """Accuracy receipts from one source of graded rows: ``price`` guards against non-price
    fields, ``balance`` and ``stock`` keep rows without a value as inconclusive, and the daily
    feed (``lab``) leaves them out."""
    if kind == "price":
        return accuracy_receipts(guard_field(rows), pointers)
    with_note = rows if "note" in rows.columns else rows.withColumn("note", F.lit(None).cast("string"))
    if kind == "lab":
        with_note = with_note.where("returned IS NOT NULL")
    return accuracy_receipts(with_note, pointers)


def verify_delivery(ledger: DataFrame, captures: DataFrame) -> DataFrame:
    """Re-derive delivery receipts at three levels; null means not checkable here.

    Integrity rehashes the evidence. The verdict is re-judged from the stored shape, except
    where a second call settled it. Raw re-derives the shape from the archived response that the receipt points
    to, wherever it stands now. Input captures: (capture_id, payload).
    """
    rows = judge_shape(ledger, "shape", "promised", prefix="re_")
    captures = identified(captures)
    readable = captures.where(F.coalesce(kind_of(document(captures, "payload")) != "null", F.lit(False)))
    one = readable.groupBy(F.col("capture_id").alias("_c")).agg(F.min("payload").alias("_payload"))
    linked = json_shape(rows.join(one, F.col("raw_id") == F.col("_c"), "left"), "_payload", out="_raw_shape").withColumn(
        "raw_observed", shape_text(F.col("_raw_shape")))
    settled = F.col("why").contains("re-verify")
    return linked.select(
        "receipt_id", "kind", "host", "url", "status",
        (content_id(delivery_evidence()) == F.col("receipt_id")).alias("integrity"),
        F.when(~settled, F.col("re_status") == F.col("status")).alias("verdict"),
        F.when(F.col("raw_observed").isNotNull(),
               F.coalesce(F.col("raw_observed") == F.col("observed"), F.lit(False))).alias("raw"))


def verify_accuracy(ledger: DataFrame) -> DataFrame:
    again = accuracy_status(F.col("returned"), F.col("dev_value"), F.col("tol_value"))
    return ledger.select(
        "receipt_id", "kind", "host", "url", "status",
        (content_id(accuracy_evidence()) == F.col("receipt_id")).alias("integrity"),
        (again == F.col("status")).alias("verdict"), F.lit(None).cast("boolean").alias("raw"))


def ledger_self_check(verified: DataFrame) -> DataFrame:
    """One row: integrity, re-graded verdicts and reproduced claims over the whole ledger."""
    claim = F.col("status").isin("delivered", "short", "accurate", "off")
    held = F.coalesce("verdict", F.lit(False)) | F.coalesce("raw", F.lit(False))
    return verified.agg(
        F.count("*").alias("receipts"), F.count_if("integrity").alias("integrity_ok"),
        F.count_if(F.col("verdict").isNotNull()).alias("verdicts_checked"),
        F.count_if("verdict").alias("verdicts_ok"), F.count_if(~F.col("verdict")).alias("mismatches"),
        F.count_if(claim).alias("claims"), F.count_if(claim & held).alias("claims_reproduced"))


def supersede(ledger: DataFrame, fresh: DataFrame, ranged: bool = False) -> DataFrame:
    """Fresh receipts replace the ledger's receipts of the same call; one row per id. The id does
    not cover the time, so one id can come on two days: a fresh row wins, then the earlier one.

    With ``ranged`` rows are dealt out by ranges of the id, as a canonical ledger is sorted, so they are not sent
    again for that; to find the ranges, the rows are made twice."""
    old = ledger.join(fresh.select(*LOGICAL_KEY).distinct(), LOGICAL_KEY, "left_anti")
    both = fresh.select(*ledger.columns, F.lit(False).alias("_old")).unionByName(
        old.select(*ledger.columns, F.lit(True).alias("_old")))
    return one_per_id(both.repartitionByRange("receipt_id") if ranged else both, "_old").select(*ledger.columns)


def one_per_id(receipts: DataFrame, *first: str) -> DataFrame:
    """One row per receipt id: the least by the given columns, then the earliest."""
    # ranked, so that only the columns that are asked for are sent
    place = F.row_number().over(Window.partitionBy("receipt_id").orderBy(*first, "ts"))
    return receipts.withColumn("_place", place).where("_place = 1").select(*receipts.columns)


def receipt_summary(ledger: DataFrame) -> DataFrame:
    """Counts by kind and verdict, with archived raw and money paid for short deliveries."""
    paid = F.coalesce(F.col("charged").try_cast("decimal(20,8)"), F.lit(0))
    return ledger.groupBy("kind", "status").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("raw_file").isNotNull()).alias("with_raw"),
        F.sum(F.when(F.col("status") == "short", paid).otherwise(0)).cast("double")
        .alias("paid_for_short"))
