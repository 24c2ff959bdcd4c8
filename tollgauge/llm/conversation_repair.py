"""Repair of conversations whose turns are missing, empty, repeated, cut off or given to the wrong side.

A sound conversation's role initials read ``(s?(ua)+)?``. A damaged one is aligned, Wagner-Fischer, to every
feasible length of that string. A shorter alternating string is the end of a longer one, so one table over
suffixes holds all lengths: cell (i, j) is the cheapest way to turn the rows from i on into the last j
initials. Ukkonen's band keeps the cells whose offset alone does not cost more than a repair that is already
known (the incumbent, found by one greedy walk). The cheapest lengths are traced back and their audits compared.

Blank and repeated rows must go, whatever is aligned, so they take no part in the table. A conversation of more than
``LONG`` other rows is aligned in a table whose columns are folded by the period of the string: the same
result with four cells a row.

A conversation is read row by row in its order: one byte a row (its share of the audit) is kept until the conversation ends. Texts are
held as well, up to ``HELD`` characters; a conversation with more is read a second time beside its audit.
"""

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tollgauge.llm.common import settled, table

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 3, 4, 3, 3
INITIALS = "sua"
ROLES = {"u": "user", "a": "assistant"}
SOUND_PAIRS = ("su", "ua", "au")
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
SPACES = " \t\n\x0b\x0c\r"
ENDS = ".!?"
LONG = 2048
HELD = 1 << 25
_NEVER = 1 << 40
_AFTER = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def incumbent(rows: list[tuple[str, int]]) -> int:
    """Cost of a greedy repair of (initial, cost of keeping) rows."""
    cost, state = 0, ""
    for initial, kept in rows:
        due = "a" if state == "u" else "u"
        if initial == due or (initial == "s" and state == ""):
            cost, state = cost + kept, initial
        elif REROLE + kept < DELETE:
            cost, state = cost + REROLE + kept, due
        else:
            cost += DELETE
    return cost + {"": 0, "a": 0, "u": INSERT, "s": 2 * INSERT}[state]


def _tables(rows: list[tuple[str, int]]) -> tuple[np.ndarray, np.ndarray, int]:
    """T[i, j]: rows from i on into the last j initials of an endless ``...uaua``. S[i, j]: into an ``s``
    and then these. Cells outside the band cost ``_NEVER``."""
    n, most = len(rows), incumbent(rows)
    width = n + most // INSERT + 2
    at = np.arange(width)
    ends = {c: np.where(at % 2 == (c == "a"), 0, REROLE) for c in ROLES}
    wrong = np.full(width, REROLE)
    t, s = np.full((n + 1, width), _NEVER), np.full((n + 1, width), _NEVER)
    for i in range(n, -1, -1):
        low, high = max(0, n - i - most // DELETE), min(width, n - i + most // INSERT + 1)
        if i == n:
            row = np.where(at == 0, 0, _NEVER)
        else:
            initial, kept = rows[i]
            row = t[i + 1] + DELETE
            row[1:] = np.minimum(row[1:], t[i + 1, :-1] + ends.get(initial, wrong)[1:] + kept)
            s[i] = s[i + 1] + DELETE
            if initial == "s":
                s[i, 2:] = np.minimum(s[i, 2:], t[i + 1, 2:] + kept)
        row = np.minimum.accumulate(row - INSERT * at) + INSERT * at
        row[:low], row[high:] = _NEVER, _NEVER
        t[i] = np.minimum(row, _NEVER)
    return t, np.minimum(s, _NEVER), most


def _trace(rows: list[tuple[str, int]], t: np.ndarray, s: np.ndarray, j: int, with_s: bool) -> str:
    """The ASCII-least cheapest audit of one length: D before I before K before R."""
    i, n, out = 0, len(rows), []
    while with_s:
        if s[i, j] == s[i + 1, j] + DELETE:
            out.append("D")
        else:
            out.append("K")
            with_s = False
        i += 1
    while i < n or j:
        cost = t[i, j]
        if i < n and cost == t[i + 1, j] + DELETE:
            out.append("D")
            i += 1
        elif j and cost == t[i, j - 1] + INSERT:
            out.append("I")
            j -= 1
        else:
            out.append("K" if rows[i][0] == ("a" if j % 2 else "u") else "R")
            i, j = i + 1, j - 1
    return "".join(out)


def align(rows: list[tuple[str, int]]) -> tuple[int, str]:
    """Cheapest cost and, among the audits of that cost, the ASCII-least."""
    t, s, _ = _tables(rows)
    best = min(int(t[0, ::2].min()), int(s[0, 2::2].min(initial=_NEVER)))
    found = [_trace(rows, t, s, int(j), False) for j in np.flatnonzero(t[0] == best) if j % 2 == 0]
    found += [_trace(rows, t, s, int(j), True) for j in np.flatnonzero(s[0] == best) if j >= 2 and j % 2 == 0]
    return best, min(found)


def align_folded(rows: list[tuple[str, int]]) -> tuple[int, str]:
    """The result of ``align`` from a table with one column for each place in the period of the string."""
    n, states = len(rows), ("", "s", "u", "a")
    ahead = [{"": 0, "a": 0, "u": INSERT, "s": 2 * INSERT}]
    for initial, kept in reversed(rows):
        later, cell = ahead[-1], {}
        for q in states:
            due = "a" if q == "u" else "u"
            cell[q] = min(later[q] + DELETE, later[due] + kept + (0 if initial == due else REROLE))
        if initial == "s":
            cell[""] = min(cell[""], later["s"] + kept)
        cell["a"] = min(cell["a"], cell["u"] + INSERT)
        cell["u"] = min(cell["u"], cell["a"] + INSERT)
        cell["a"] = min(cell["a"], cell["u"] + INSERT)
        cell[""], cell["s"] = min(cell[""], cell["u"] + INSERT), min(cell["s"], cell["u"] + INSERT)
        ahead.append(cell)
    ahead.reverse()
    i, state, out = 0, "", []
    while i < n or ahead[i][state]:
        cost, due = ahead[i][state], "a" if state == "u" else "u"
        if i < n and cost == ahead[i + 1][state] + DELETE:
            out.append("D")
            i += 1
        elif cost == ahead[i][due] + INSERT:
            out.append("I")
            state = due
        elif rows[i][0] == due or (rows[i][0] == "s" and state == "" and cost == ahead[i + 1]["s"] + rows[i][1]):
            out.append("K")
            i, state = i + 1, rows[i][0]
        else:
            out.append("R")
            i, state = i + 1, due
    return ahead[0][""], "".join(out)


def audit(codes: bytes, long: int = LONG) -> tuple[int, str]:
    """Cost and audit of a conversation given as bytes initial + 4 x fault. A row that must go does so at once, since D sorts before I."""
    faults = [c >> 2 for c in codes]
    rows = [((INITIALS + " ")[c & 3], CUT_OFF * (f == TRUNCATED)) for c, f in zip(codes, faults, strict=True)
            if f not in (BLANK, DUPLICATE)]
    cost, edits = (align if len(rows) <= long else align_folded)(rows)
    if len(rows) == len(codes):
        return cost, edits
    out, i = [], 0
    for edit in edits:
        if edit != "I":
            while faults[i] in (BLANK, DUPLICATE):
                out.append("D")
                i += 1
            i += 1
        elif i < len(faults) and faults[i] in (BLANK, DUPLICATE):
            while i < len(faults) and faults[i] in (BLANK, DUPLICATE):
                out.append("D")
                i += 1
        out.append(edit)
    out.append("D" * (len(faults) - i))
    return cost + DELETE * (len(codes) - len(rows)), "".join(out)


@lru_cache(maxsize=1 << 14)
def _audit_of_short(codes: bytes, long: int) -> tuple[int, str]:
    return audit(codes, long)


class _Edits:
    """Applies an audit to the rows of a conversation as they come."""

    def __init__(self, edits: str):
        self.edits, self.at, self.state, self.place = edits, 0, "", 0

    def _put(self, edit: str, role: str, text: str) -> tuple:
        self.place += 1
        return self.place, edit, role, text

    def inserts(self) -> Iterator[tuple]:
        while self.at < len(self.edits) and self.edits[self.at] == "I":
            self.at, self.state = self.at + 1, _AFTER[self.state, "a" if self.state == "u" else "u"]
            yield self._put("I", ROLES[self.state], "")

    def row(self, role: str, text: str) -> Iterator[tuple]:
        yield from self.inserts()
        edit, self.at = self.edits[self.at], self.at + 1
        if edit != "D":
            self.state = _AFTER[self.state, role[:1] if edit == "K" else "a" if self.state == "u" else "u"]
            yield self._put(edit, role if edit == "K" else ROLES[self.state], text)


class _Conversation:
    """What is known of a conversation while its rows are read."""

    def __init__(self, name, held: bool):
        self.name, self.held, self.codes, self.rows = name, held, bytearray(), []
        self.least = self.last = None
        self.turns, self.illegal, self.initial = 0, 0, None

    def add(self, turn, role: str, text: str, initial: str, fault: int) -> None:
        if self.initial is not None and self.initial + initial not in SOUND_PAIRS:
            self.illegal += 1
        self.initial = initial
        if turn is not None and turn != self.last:
            self.least, self.last, self.turns = turn if self.least is None else self.least, turn, self.turns + 1
        self.codes.append((INITIALS + " ").index(initial if initial in INITIALS and initial else " ") + 4 * fault)
        if self.held:
            self.rows.append((role, text))

    def header(self, long: int) -> tuple:
        codes = bytes(self.codes)
        cost, edits = _audit_of_short(codes, long) if len(codes) <= 64 else audit(codes, long)
        faults = np.bincount(np.frombuffer(codes, np.uint8) >> 2, minlength=4)
        gaps = 0 if self.least is None else self.last - self.least + 1 - self.turns
        return (gaps, *(int(faults[f]) for f in (BLANK, DUPLICATE, TRUNCATED)), self.illegal, cost, edits)


class _Out:
    """Collects output rows into record batches of bounded size."""

    def __init__(self, kind: pa.DataType):
        text, whole = pa.string(), pa.int64()
        self.schema = pa.schema([("_conv", kind), ("position", whole), ("edit", text), ("role", text), ("text", text),
                                 *((c, whole) for c in _COUNTS), ("audit", text)])
        self.rows, self.size = [], 0

    def header(self, name, header: tuple) -> None:
        self.rows.append((name, 0, None, None, None, *header))
        self.size += len(header[-1])

    def turn(self, name, turn: tuple) -> None:
        self.rows.append((name, *turn, *[None] * 7))
        self.size += len(turn[3]) + 64

    def batch(self, least: int = 0) -> Iterator[pa.RecordBatch]:
        if self.rows and self.size >= least:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*self.rows, strict=True), self.schema, strict=True)],
                                             schema=self.schema)
            self.rows, self.size = [], 0


def _repairing(long: int, with_turns: bool):
    """Reads whole conversations in order; gives a header (position 0) and, with turns, the repaired ones."""
    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out = None, None

        def close() -> None:
            header = now.header(long)
            out.header(now.name, header)
            if with_turns:
                edits = _Edits(header[-1])
                for row in now.rows:
                    for turn in edits.row(*row):
                        out.turn(now.name, turn)
                for turn in edits.inserts():
                    out.turn(now.name, turn)

        for batch in batches:
            out = out or _Out(batch.schema.field("_conv").type)
            columns = [batch.column(c).to_pylist() for c in ("_place", "_conv", "_turn", "_role", "_text", "_initial", "_fault")]
            for place, name, turn, role, text, initial, fault in zip(*columns, strict=True):
                if place == 1:
                    if now is not None:
                        close()
                        yield from out.batch(1 << 20)
                    now = _Conversation(name, with_turns)
                now.add(turn, role, text, initial, fault)
        if now is not None:
            close()
            yield from out.batch()
    return repair


def _applying(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads headers, each followed by the rows of its conversation in order."""
    edits, name, out = None, None, None
    for batch in batches:
        out = out or _Out(batch.schema.field("_conv").type)
        columns = [batch.column(c).to_pylist() for c in ("_place", "_conv", "_role", "_text", *_COUNTS, "audit")]
        for place, conv, role, text, *header in zip(*columns, strict=True):
            if place == 0:
                for turn in edits.inserts() if edits else ():
                    out.turn(name, turn)
                edits, name = _Edits(header[-1]), conv
                out.header(conv, tuple(header))
            else:
                for turn in edits.row(role, text):
                    out.turn(conv, turn)
            yield from out.batch(1 << 20)
    for turn in edits.inserts() if edits else ():
        out.turn(name, turn)
    if out is not None:
        yield from out.batch()


def flagged(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The rows of whole conversations, each conversation in one partition and in its order (turn, nulls first, then role, then
    text), with ``_place`` from 1, ``_initial`` and ``_fault``. A null role or text counts as one space."""
    rows = turns.select(F.col(f"`{conv}`").alias("_conv"), F.col(f"`{turn}`").alias("_turn"),
                        F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("_role"),
                        F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("_text")).repartition("_conv")
    same = Window.partitionBy("_conv", "_role", "_text").orderBy(F.col("_turn").asc_nulls_first())
    order = Window.partitionBy("_conv").orderBy(F.col("_turn").asc_nulls_first(), "_role", "_text", "_again")
    ended = F.rtrim("_text", F.lit(SPACES))
    fault = (F.when(ended == "", BLANK).when(F.col("_again") > 1, DUPLICATE)
             .when(~F.substring(ended, -1, 1).isin(*ENDS), TRUNCATED).otherwise(FINE))
    return rows.withColumn("_again", F.row_number().over(same)).withColumn("_place", F.row_number().over(order)).select(
        "_place", "_conv", "_turn", "_role", "_text", F.substring("_role", 1, 1).alias("_initial"), fault.alias("_fault"))


def _schema(rows: DataFrame) -> str:
    return (f"_conv {rows.schema['_conv'].dataType.simpleString()}, position bigint, edit string, role string, text string, "
            + ", ".join(f"{c} bigint" for c in _COUNTS) + ", audit string")


def audits(turns: DataFrame, long: int = LONG, **columns: str) -> DataFrame:
    """One row per conversation: ``_conv``, gaps, blank, duplicate, truncated, illegal, cost and audit."""
    rows = flagged(turns, **columns)
    return rows.mapInArrow(_repairing(long, False), _schema(rows)).select("_conv", *_COUNTS, "audit")


def repair(turns: DataFrame, held: int = HELD, long: int = LONG, **columns: str) -> DataFrame:
    """Every conversation repaired: a row at position 0 with its counts, cost and audit, then its turns in order
    with their position from 1, the edit that made them (K, R or I), role and text. Conversations are whole
    and in order within a partition.

    Names of the columns can be given (``conv``, ``turn``, ``role``, ``text``); other columns are not read, whatever their names. A null
    conversation is one of its own; a null turn sorts first and is no turn number; a null role or text counts as one space.
    Rows of one turn follow each other by role and text; repeated rows are duplicates. An empty table gives no row.
    Texts of any length are whole; a conversation of more than ``held`` characters is read twice instead of being held.
    """
    names = {"conv": "conv_id", "turn": "turn", "role": "role", "text": "text"}
    turns = turns.select(*(F.col(f"`{columns.get(k, name)}`").alias(name) for k, name in names.items()))
    size = F.sum(F.length(F.coalesce("text", F.lit(" "))) + 64)
    large = settled(turns.groupBy(F.col("conv_id").alias("_large")).agg(size.alias("_size")).where(F.col("_size") > held).select("_large"))
    if large.isEmpty():
        rows = flagged(turns)
        return rows.mapInArrow(_repairing(long, True), _schema(rows))
    of = F.col("conv_id").eqNullSafe(F.col("_large"))
    rows = flagged(turns.join(large, of, "left_anti"))
    out = rows.mapInArrow(_repairing(long, True), _schema(rows))
    rest = turns.join(large, of, "left_semi")
    heads = settled(audits(rest, long))
    rows = flagged(rest).select("_place", "_conv", "_role", "_text")
    both = heads.withColumn("_place", F.lit(0)).unionByName(rows, allowMissingColumns=True)
    again = both.repartition("_conv").sortWithinPartitions("_conv", "_place").mapInArrow(_applying, _schema(rows))
    return out.unionByName(again)


def _digesting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Headers with the hash of the turns that follow them."""
    import hashlib

    name, header, digest, rows, schema = None, None, None, [], None

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    for found in batches:
        schema = schema or pa.schema([("_conv", found.schema.field("_conv").type), *((c, pa.int64()) for c in _COUNTS),
                                      ("audit", pa.string()), ("repaired_sha256", pa.string())])
        columns = [found.column(c).to_pylist() for c in ("position", "_conv", "role", "text", *_COUNTS, "audit")]
        for place, conv, role, text, *counts in zip(*columns, strict=True):
            if place == 0:
                if header is not None:
                    rows.append((name, *header, digest.hexdigest()))
                name, header, digest = conv, counts, hashlib.sha256()
            else:
                digest.update(f"{'' if place == 1 else chr(10)}{role}:{text}".encode())
        if rows:
            yield batch()
            rows = []
    if header is not None:
        rows.append((name, *header, digest.hexdigest()))
        yield batch()


def digests(repaired: DataFrame) -> DataFrame:
    """One row per conversation of ``repair``: its counts, cost, audit, and ``repaired_sha256`` of its newline-joined ``role:text``."""
    kind = repaired.schema["_conv"].dataType.simpleString()
    return repaired.mapInArrow(_digesting, f"_conv {kind}, " + ", ".join(f"{c} bigint" for c in _COUNTS)
                               + ", audit string, repaired_sha256 string")


def damaged(turns: DataFrame) -> DataFrame:
    """Rows as the contract of the query damages them, by the crc32 of ``conv_id:turn`` modulo 20."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    k = F.crc32(F.concat(shown[0], F.lit(":"), shown[1]).cast("binary")) % 20
    text = F.when(k == 1, "").when(k == 2, F.translate(shown[3], ENDS, "")).otherwise(shown[3])
    copies = F.when(k == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return turns.where(k != 0).select("conv_id", "turn", F.when(k == 4, "user").otherwise(shown[2]).alias("role"),
                                      text.alias("text"), F.explode(copies).alias("_copy")).drop("_copy")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = digests(repair(damaged(turns)))
    every = turns.select("conv_id").distinct()
    none = F.sha2(F.lit("").cast("binary"), 256)
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").select(
        "conv_id", *(F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in _COUNTS),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", none).alias("repaired_sha256"))
