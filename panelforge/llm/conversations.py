"""Repair of conversations by the cheapest edits, with a report and an audit.

A good conversation has the roles ``(system? (user assistant)+)?``.  Rows may be
kept, given the role of a user or an assistant, deleted or inserted; blank rows
and repeats of an earlier role and text must go.  The cheapest script of edits
is found by a dynamic programme over four states whose scripts are persistent
strings (``audits.py``).

Conversations of up to ``ROWS`` rows and ``CHARS`` characters are read whole, in
order, by one task each.  A longer one is cut into blocks by its rows' positions
in a range sort; each block gives its cheapest scripts between all states, and
only these meet to choose the whole script, which is then applied block by
block.  So a conversation may hold any share of the table.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.positions import with_position
from .audits import CUT, GONE, INITIALS, Pieces, cheapest_audit, edited, piece_scripts, state_after
from .common import stage

#: The longest conversation that one task reads whole.
ROWS, CHARS = 20_000, 32_000_000
#: Rows of a longer one that one task sees at once.
BLOCK = 4_096
# Fixed value: what is not shown.
BLANKS = " \t\n\x0b\x0c\r"


def damaged(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
            role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows with faults made by crc32(``conv:turn``) % 20: 0 drops the row, 1
    empties its text, 2 removes its sentence ends, 3 repeats it, 4 makes it a
    user's.  A NULL is one space.  Columns: the four, under the same names."""
    def text_of(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(text_of(conv_col), F.lit(":"), text_of(turn_col)).cast("binary")) % 20
    text = F.when(kind == 1, F.lit("")).when(
        kind == 2, F.regexp_replace(text_of(text_col), "[.!?]", "")).otherwise(text_of(text_col))
    return (conversations.filter(kind != 0)
            .select(F.col(conv_col), F.col(turn_col), F.when(kind == 4, F.lit("user")).otherwise(text_of(role_col)).alias(role_col),
                    text.alias(text_col), F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("_copy"))
            .drop("_copy"))


def _faults(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """conv, turn, role, text, code (initial, blank, truncated), under own names."""
    said = F.coalesce(F.col(text).cast("string"), F.lit(" "))
    who = F.coalesce(F.col(role).cast("string"), F.lit(" "))
    shown = F.rtrim(said, F.lit(BLANKS))
    initial = F.coalesce(*[F.when(who.startswith(c), F.lit(i)) for i, c in enumerate(INITIALS)], F.lit(3))
    code = F.when(shown == "", initial + GONE).when(
        F.right(shown, F.lit(1)).isin(".", "!", "?"), initial).otherwise(initial + CUT)
    return rows.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), who.alias("role"),
                       said.alias("text"), code.cast("int").alias("code"))


def _report(codes, turns):
    """Counts of one conversation, or of a stretch of one, as a dict."""
    some = [t for t in turns if t is not None]
    return {"n": len(codes), "blank": 0, "duplicate": 0, "truncated": sum(c & CUT > 0 for c in codes),
            "illegal": sum(not _legal(a & 3, b & 3) for a, b in zip(codes, codes[1:])),
            "low": min(some, default=None), "high": max(some, default=None), "turns": len(set(some)),
            "first": codes[0] & 3 if codes else None, "last": codes[-1] & 3 if codes else None}


def _legal(a: int, b: int) -> bool:
    return (a, b) in ((0, 1), (1, 2), (2, 1))


def _joined(a, b):
    """The report of two stretches that follow each other."""
    out = {k: a[k] + b[k] for k in ("n", "blank", "duplicate", "truncated", "illegal", "turns")}
    if a["n"] and b["n"]:
        out["illegal"] += not _legal(a["last"], b["first"])
    if a["high"] is not None and a["high"] == b["low"]:
        out["turns"] -= 1
    for k, pick in (("low", min), ("high", max)):
        out[k] = pick((x[k] for x in (a, b) if x[k] is not None), default=None)
    out["first"], out["last"] = (a if a["n"] else b)["first"], (b if b["n"] else a)["last"]
    return out


REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _final(report, cost: int, audit: str) -> dict:
    gaps = 0 if report["low"] is None else report["high"] - report["low"] + 1 - report["turns"]
    return {"gaps": gaps, **{k: report[k] for k in REPORT[1:5]}, "cost": cost, "audit": audit}


_REPORT_TYPE = T.StructType([T.StructField(k, T.LongType()) for k in REPORT] + [T.StructField("audit", T.StringType())])
_ARROW_REPORT = pa.struct([*((k, pa.int64()) for k in REPORT), ("audit", pa.string())])


def _out_type(conv_type: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("conv", conv_type), T.StructField("at", T.LongType()),
                         T.StructField("sub", T.LongType()), T.StructField("edit", T.StringType()),
                         T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
                         T.StructField("report", _REPORT_TYPE)])


class _Writer:
    """Collects output rows and cuts them into Arrow batches of bounded size."""

    def __init__(self, conv_arrow):
        self.types = [conv_arrow, pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), _ARROW_REPORT]
        self.names = ["conv", "at", "sub", "edit", "role", "text", "report"]
        self.rows, self.chars = [], 0

    def add(self, *row):
        self.rows.append(row)
        self.chars += len(row[5] or "") + 32

    def batches(self, enough: int = 4_000_000):
        if self.rows and self.chars >= enough:
            columns = list(zip(*self.rows))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, self.types)], names=self.names)
            self.rows, self.chars = [], 0


def _groups(batches, *keys):
    """Consecutive rows (tuples in column order) with equal keys; reads no further than it must."""
    now, rows = None, []
    for b in batches:
        columns = [b.column(i).to_pylist() for i in range(b.num_columns)]
        at = [b.schema.get_field_index(k) for k in keys]
        for row in zip(*columns):
            key = tuple(row[i] for i in at)
            if rows and key != now:
                yield now, rows
                rows = []
            now = key
            rows.append(row)
    if rows:
        yield now, rows


def _write_edits(writer, conv, script, rows, written=0, at=0):
    """``rows``: (role, text).  Inserts carry the number of the row in front."""
    sub = 0
    for letter, role, row in edited(script, rows, written):
        if letter == "I":
            sub += 1
            writer.add(conv, at - 1, sub, letter, role, "", None)
        else:
            writer.add(conv, at, 0, letter, role or row[0], row[1], None)
            at, sub = at + 1, 0


def _whole(rows: DataFrame, conv_type: T.DataType, known: int = 50_000) -> DataFrame:
    """Edited rows and the report of conversations that fit one task, in order."""
    schema = _out_type(conv_type)

    def run(batches):
        audits: dict[bytes, tuple[int, str]] = {}  # rows of the same codes have the same audit
        writer = None
        for (conv,), group in _groups(_noting_type(batches), "conv"):
            writer = writer or _Writer(_noting_type.last)
            group = [r for r in group if r[5]]
            seen, codes, duplicate = set(), bytearray(), 0
            for _, _, role, text, code, _ in group:
                if not code & GONE:
                    if (role, text) in seen:
                        code, duplicate = code & 3 | GONE, duplicate + 1
                    else:
                        seen.add((role, text))
                codes.append(code)
            report = _report(codes, [r[1] for r in group])
            report["duplicate"], report["blank"] = duplicate, sum(c & GONE > 0 for c in codes) - duplicate
            key = bytes(codes)
            if key not in audits:
                if len(audits) >= known:
                    audits.clear()
                audits[key] = cheapest_audit(key)
            cost, audit = audits[key]
            _write_edits(writer, conv, audit, [(r[2], r[3]) for r in group])
            writer.add(conv, len(group), 0, None, None, None, _final(report, cost, audit))
            yield from writer.batches()
        if writer:
            yield from writer.batches(0)

    return rows.mapInArrow(run, schema)


def _noting_type(batches):
    for b in batches:
        _noting_type.last = b.schema.field("conv").type
        yield b


def _in_order(*columns) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in columns]


def _long(rows: DataFrame, conv_type: T.DataType, block: int) -> DataFrame:
    """The same of conversations of any length, block by block."""
    placed = stage(with_position(rows, _in_order("conv", "turn", "role", "text"), "pos").withColumn(
        "same", F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256)).withColumn(
        "blk", F.floor(F.col("pos") / block)), "long-conversations")
    first = placed.groupBy(F.col("conv").alias("_conv"), F.col("same").alias("_same")).agg(
        F.min("pos").alias("_first"), F.count("*").alias("_n")).filter("_n > 1")
    flagged = placed.select("conv", "turn", "code", "pos", "blk", "same").join(
        first, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("same") == F.col("_same")), "left")
    again = (F.col("pos") > F.col("_first")) & (F.col("code").bitwiseAND(GONE) == 0)
    flagged = flagged.select("conv", "turn", "code", "pos", "blk", F.coalesce(again, F.lit(False)).alias("again"))

    piece_type = T.StructType([
        T.StructField("conv", conv_type), T.StructField("blk", T.LongType()), T.StructField("report", T.MapType(T.StringType(), T.LongType())),
        T.StructField("scripts", T.ArrayType(T.StructType([
            T.StructField("before", T.LongType()), T.StructField("after", T.LongType()), T.StructField("cost", T.LongType()),
            T.StructField("script", T.StringType())])))])
    arrow_report, arrow_scripts = pa.map_(pa.string(), pa.int64()), pa.list_(pa.struct(
        [("before", pa.int64()), ("after", pa.int64()), ("cost", pa.int64()), ("script", pa.string())]))

    def pieces_of(batches):
        for (blk, conv), group in _groups(_noting_type(batches), "blk", "conv"):
            codes = bytes(c & 3 | GONE if again else c for _, _, c, _, _, again in group)
            report = _report(codes, [r[1] for r in group])
            report["duplicate"] = sum(r[5] for r in group)
            report["blank"] = sum(c & GONE > 0 for c in codes) - report["duplicate"]
            scripts = [dict(zip(("before", "after", "cost", "script"), s)) for s in piece_scripts(codes)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([conv], _noting_type.last), pa.array([blk]), pa.array([list(report.items())], arrow_report),
                 pa.array([scripts], arrow_scripts)], names=["conv", "blk", "report", "scripts"])

    pieces = stage(flagged.repartition("blk").sortWithinPartitions("blk", "pos").mapInArrow(pieces_of, piece_type),
                   "conversation-pieces")

    chosen_type = T.StructType([T.StructField("conv", conv_type), T.StructField("blk", T.LongType()),
                                T.StructField("script", T.StringType()), T.StructField("report", _REPORT_TYPE)])

    def choose(batches):
        for (conv,), group in _groups(_noting_type(batches), "conv"):
            found, report = Pieces(), None
            for _, _, counts, scripts in group:
                counts = dict(counts)
                report = counts if report is None else _joined(report, counts)
                found.append([(s["before"], s["after"], s["cost"], s["script"]) for s in scripts])
            cost, (front, *parts) = found.result()
            blks = [r[1] for r in group]
            final = _final(report, cost, front + "".join(parts))
            yield pa.RecordBatch.from_arrays(
                [pa.array([conv] * (len(blks) + 1), _noting_type.last), pa.array([*blks, None], pa.int64()),
                 pa.array([front + parts[0], *parts[1:], None]), pa.array([*[None] * len(blks), final], _ARROW_REPORT)],
                names=["conv", "blk", "script", "report"])

    chosen = stage(pieces.repartition("conv").sortWithinPartitions(*_in_order("conv", "blk")).mapInArrow(
        choose, chosen_type), "conversation-scripts")

    # A block's script leads its rows; where a block begins within a conversation
    # follows from the scripts before it, so that is a second small pass.
    lines = placed.select("conv", "blk", "pos", "role", "text", F.lit(None).cast("string").alias("script")).unionByName(
        chosen.filter("blk IS NOT NULL").select("conv", "blk", F.lit(-1).cast("long").alias("pos"), F.lit(None).cast("string").alias("role"),
                                               F.lit(None).cast("string").alias("text"), "script"))
    spread = lines.repartition("conv", "blk").sortWithinPartitions(*_in_order("conv", "blk", "pos"))
    ends_type = T.StructType([T.StructField("conv", conv_type), T.StructField("blk", T.LongType()),
                              T.StructField("leads", T.ArrayType(T.LongType()))])

    def leads(batches):
        for (conv, blk), group in _groups(_noting_type(batches), "conv", "blk"):
            script, roles = group[0][5], [r[3] for r in group[1:]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([conv], _noting_type.last), pa.array([blk]),
                 pa.array([[state_after(script, roles, s) for s in range(4)]], pa.list_(pa.int64()))],
                names=["conv", "blk", "leads"])

    states_type = T.StructType([T.StructField("conv", conv_type), T.StructField("blk", T.LongType()),
                                T.StructField("written", T.LongType())])

    def states(batches):
        for (conv,), group in _groups(_noting_type(batches), "conv"):
            written, out = 0, []
            for _, blk, lead in group:
                out.append(written)
                written = lead[written]
            yield pa.RecordBatch.from_arrays(
                [pa.array([conv] * len(group), _noting_type.last), pa.array([r[1] for r in group]),
                 pa.array(out, pa.int64())], names=["conv", "blk", "written"])

    begin = spread.mapInArrow(leads, ends_type).repartition("conv").sortWithinPartitions(*_in_order("conv", "blk")).mapInArrow(
        states, states_type)
    start = chosen.filter("blk IS NOT NULL").select(F.col("conv").alias("_conv"), F.col("blk").alias("_blk"), "script").join(
        begin, F.col("_conv").eqNullSafe(F.col("conv")) & (F.col("_blk") == F.col("blk"))).select("conv", "blk", "script", "written")
    lines = placed.select("conv", "blk", "pos", "role", "text", F.lit(None).cast("string").alias("script"),
                          F.lit(None).cast("long").alias("written")).unionByName(
        start.select("conv", "blk", F.lit(-1).cast("long").alias("pos"), F.lit(None).cast("string").alias("role"),
                     F.lit(None).cast("string").alias("text"), "script", "written"))
    out_type = _out_type(conv_type)

    def apply(batches):
        writer = None
        for (conv, _), group in _groups(_noting_type(batches), "conv", "blk"):
            writer = writer or _Writer(_noting_type.last)
            head = group[0]
            _write_edits(writer, conv, head[5], [(r[3], r[4]) for r in group[1:]], head[6], group[1][2])
            yield from writer.batches()
        if writer:
            yield from writer.batches(0)

    turns = lines.repartition("conv", "blk").sortWithinPartitions(*_in_order("conv", "blk", "pos")).mapInArrow(apply, out_type)
    reports = chosen.filter("blk IS NULL").select(
        "conv", F.lit((1 << 62)).cast("long").alias("at"), F.lit(0).cast("long").alias("sub"),
        *[F.lit(None).cast("string").alias(c) for c in ("edit", "role", "text")], "report")
    return turns.unionByName(reports).repartition("conv").sortWithinPartitions(*_in_order("conv", "at", "sub"))


def repair_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", names: DataFrame | None = None, whole_rows: int = ROWS,
                         whole_chars: int = CHARS, block: int = BLOCK) -> DataFrame:
    """Edited rows, each conversation's in order and followed by its report.

    Columns: conv; at, sub: order within the conversation; edit: K(eep), R(ename),
    D(elete), I(nsert); role and text after the edit; report (only in the last
    row, which has no edit): gaps, blank, duplicate, truncated, illegal, cost,
    audit.  Rows are taken by turn (NULL first), then role, then text.  ``names``:
    conversations that get a report though they have no rows (zeros, an empty audit).

    A NULL role or text is one space; such a role, an empty or an unknown one can
    only be changed or deleted.  A NULL conversation is a conversation.  Repeated
    rows are duplicates, texts may have any length, no rows give no rows; other
    columns are not read.  Conversations may have any number of rows; one task
    sees a whole one only up to ``whole_rows`` and ``whole_chars``."""
    conv_type = rows.schema[conv_col].dataType
    every = _faults(rows, conv_col, turn_col, role_col, text_col)
    long_ones = stage(rows.groupBy(F.col(conv_col).alias("_conv")).agg(
        F.count("*").alias("n"), F.sum(F.length(text_col)).alias("chars")).filter(
        (F.col("n") > whole_rows) | (F.col("chars") > whole_chars)).select("_conv"), "long-conversations")
    some_long = long_ones.count() > 0
    is_long = F.col("conv").eqNullSafe(F.col("_conv"))
    short = (every.join(long_ones, is_long, "left_anti") if some_long else every).withColumn("there", F.lit(True))
    if names is not None:
        none = names.select(F.col(conv_col).cast(conv_type).alias("conv")).distinct().select(
            "conv", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"),
            F.lit(0).alias("code"), F.lit(False).alias("there"))
        short = short.unionByName(none.join(long_ones, is_long, "left_anti") if some_long else none)
    out = _whole(short.repartition("conv").sortWithinPartitions(*_in_order("conv", "turn", "role", "text")), conv_type)
    return out.unionByName(_long(every.join(long_ones, is_long, "left_semi"), conv_type, block)) if some_long else out


def digests(repaired: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """One row per conversation: its report and the SHA-256 of its repaired
    ``role:text`` lines.  Reads :func:`repair_conversations`' rows as they come,
    so no conversation is held in memory."""
    conv_type = repaired.schema["conv"].dataType
    names = [*REPORT, "audit", "repaired_sha256"]
    schema = T.StructType([T.StructField("conv", conv_type)] + [T.StructField(k, T.LongType()) for k in REPORT]
                          + [T.StructField(k, T.StringType()) for k in names[-2:]])

    def run(batches):
        digest, begun = hashlib.sha256(), False
        for b in _noting_type(batches):
            convs, out = b.column("conv").to_pylist(), []
            edits, roles, texts = (b.column(c).to_pylist() for c in ("edit", "role", "text"))
            reports = b.column("report").to_pylist()
            for conv, edit, role, text, report in zip(convs, edits, roles, texts, reports):
                if report is not None:
                    out.append((conv, *(report[k] for k in REPORT), report["audit"], digest.hexdigest()))
                    digest, begun = hashlib.sha256(), False
                elif edit != "D":
                    digest.update((("\n" if begun else "") + role + ":" + text).encode())
                    begun = True
            if out:
                types = [_noting_type.last] + [pa.int64()] * len(REPORT) + [pa.string()] * 2
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                                 names=["conv", *names])

    return repaired.mapInArrow(run, schema).withColumnRenamed("conv", conv_col)
