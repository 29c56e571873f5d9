"""Mixing sources to target weights by Pfair scheduling.

Every source's documents are cut into blocks.  With the integer weight q of a
source and the sum L of all weights, its k-th block (from 0) is released at
slot floor(k L / q) and due by slot ceil((k + 1) L / q).  Earliest deadline
first, among the released blocks, fills one frame of L slots in which each
source has exactly q; after any number of slots each source is less than one
block away from its share.  Frames repeat, so block k stands in frame k div q
at the slot of the frame's block k mod q.

Only the frame is scheduled one slot after another: a fold over an array of L
slots, in one row, whose size depends on the weights and not on the documents.
Ranking the documents is a range sort, so a source with most of the rows is
spread over many tasks.  All of it is DataFrame and SQL functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.positions import with_position

#: Documents of a block, and the slots that the default weights share out.
BLOCK_ROWS, SLOTS = 16, 1000


def default_weights(docs: DataFrame, source_col: str = "source", slots: int = SLOTS) -> DataFrame:
    """(source, weight): shares of ``slots`` in proportion to the square root of
    each source's rows, so that a large source doesn't drown the small ones."""
    sizes = docs.groupBy(F.col(source_col).alias("source")).agg(F.sqrt(F.count("*")).alias("root"))
    total = sizes.agg(F.sum(F.col("root").cast("decimal(30,9)")).cast("double").alias("total"))
    return sizes.join(F.broadcast(total)).select(
        "source", F.greatest(F.round(slots * F.col("root") / F.col("total")), F.lit(1))
        .cast("long").alias("weight"))


def _key(column):
    """NULL is a source of its own, before all others."""
    return F.when(F.col(column).isNull(), "0").otherwise(F.concat(F.lit("1"), F.col(column).cast("string")))


def frame(weights: DataFrame) -> DataFrame:
    """(key, weight, length, i, slot): where one frame has the i-th block of each source."""
    one = weights.groupBy(_key("source").alias("key")).agg(F.sum("weight").alias("weight")) \
        .filter("weight > 0").agg(F.array_sort(F.collect_list(F.struct("key", "weight"))).alias("s"),
                                  F.sum("weight").alias("len"))
    # done[i]: blocks of source i that have a slot; the least deadline * 2^20 + i is next.
    due = """array_min(transform(s, (x, i) -> CASE
        WHEN st.done[i] < x.weight AND (st.done[i] * len) div x.weight <= t
        THEN shiftleft(((st.done[i] + 1) * len + x.weight - 1) div x.weight, 20) + i END))"""
    plan = one.filter("len > 0").selectExpr("s", "len", f"""aggregate(sequence(0L, len - 1),
        named_struct('done', transform(s, x -> 0L), 'plan', cast(array() as array<bigint>)),
        (st, t) -> element_at(transform(array({due} & 1048575L), p -> named_struct(
            'done', transform(st.done, (c, i) -> IF(i = p, c + 1, c)),
            'plan', concat(st.plan, array(p)))), 1)).plan AS plan""")
    slots = plan.select("s", "len", F.posexplode("plan").alias("slot", "p")).select(
        F.expr("s[int(p)].key").alias("key"), F.expr("s[int(p)].weight").alias("weight"),
        F.col("len").alias("length"), F.col("slot").cast("long").alias("slot"))
    order = Window.partitionBy("key").orderBy("slot")
    return slots.withColumn("i", (F.row_number().over(order) - 1).cast("long"))


def schedule(docs: DataFrame, weights: DataFrame | None = None, id_col: str = "doc_id",
             source_col: str = "source", block_rows: int = BLOCK_ROWS, keep: list[str] = ()) -> DataFrame:
    """One row per input row: the columns ``keep``, ``_key``, ``_block`` (the
    block's number in its source), ``_release``, ``_deadline``, ``_slot`` and
    ``_place`` (in the block).

    In a source, rows are ordered by the md5 of the id as text, then the id.
    ``weights`` has (source, weight), whole numbers; default ``default_weights``.
    A NULL source is a source; a NULL id counts as ''.  Repeated rows have a
    place each.  Sources without a weight, or with none above zero, keep their
    rows: they follow after all slots, in ``_slot`` NULL, by key and rank."""
    if weights is None:
        weights = default_weights(docs, source_col)
    names = [c for c in dict.fromkeys([*keep]) if c]
    rows = docs.select(*names, _key(source_col).alias("_key"),
                       F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("_md5"),
                       F.col(id_col).alias("_order"))
    ranked = with_position(rows, ["_key", "_md5", "_order"], "_pos")
    # One row per source: where it starts.
    starts = ranked.groupBy("_key").agg(F.min("_pos").alias("_start"))
    f = frame(weights).withColumnsRenamed({c: f"_{c}" for c in ("key", "weight", "length", "i", "slot")})
    quota = starts.join(f.groupBy("_key").agg(F.first("_weight").alias("_weight"),
                                              F.first("_length").alias("_length")), "_key", "left")
    k = F.col("_block")
    placed = (ranked.join(F.broadcast(quota), "_key")  # one row per source
              .withColumn("_rank", F.col("_pos") - F.col("_start"))
              .withColumn("_block", F.expr(f"_rank div {block_rows}"))
              .withColumn("_place", (F.col("_rank") % block_rows).cast("int"))
              .withColumn("_i", k % F.col("_weight")))
    return placed.join(F.broadcast(f.select("_key", "_i", "_slot")), ["_key", "_i"], "left").select(
        *names, "_key", "_block",
        F.expr("(_block * _length) div _weight").alias("_release"),
        F.expr("((_block + 1) * _length + _weight - 1) div _weight").alias("_deadline"),
        F.expr("(_block div _weight) * _length + _slot").alias("_slot"), "_place")


def mix_sources(docs: DataFrame, weights: DataFrame | None = None, id_col: str = "doc_id",
                source_col: str = "source", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The schedule by id: ``doc_id``, ``source``, ``block``, ``release``,
    ``deadline``, ``slot``, ``place``.  Reading by (slot, place) mixes the sources."""
    s = schedule(docs, weights, id_col, source_col, block_rows, [id_col, source_col])
    return s.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                    *(F.col(f"_{c}").alias(c) for c in ("block", "release", "deadline", "slot", "place")))


def in_mixed_order(docs: DataFrame, weights: DataFrame | None = None, id_col: str = "doc_id",
                   source_col: str = "source", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """All rows and columns of ``docs``, sorted by slot and place."""
    s = schedule(docs, weights, id_col, source_col, block_rows, docs.columns)
    return s.orderBy(F.col("_slot").asc_nulls_last(), "_key", "_block", "_place").select(*docs.columns)


#: DuckDB SQL for ``mix_sources`` over documents with the default settings.
MIX_SQL = f"""
WITH RECURSIVE sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
src AS (SELECT source, CASE WHEN source IS NULL THEN '0' ELSE '1' || source END AS key,
    greatest(round({SLOTS} * sqrt(n) / (SELECT sum(sqrt(n)) FROM sizes)), 1)::BIGINT AS weight FROM sizes),
arr AS (SELECT list(weight ORDER BY key) AS ws, list(key ORDER BY key) AS ks, sum(weight)::BIGINT AS len,
    count(*) AS c FROM src),
edf(t, done, p) AS (
    SELECT 0::BIGINT, [0::BIGINT for x in ws], -1::BIGINT FROM arr
    UNION ALL
    SELECT t + 1, [done[i] + CASE WHEN i = p THEN 1 ELSE 0 END for i in range(1, c + 1)], p
    FROM (SELECT e.t, e.done, arr.c, list_min([CASE
              WHEN e.done[i] < arr.ws[i] AND (e.done[i] * arr.len) // arr.ws[i] <= e.t
              THEN (((e.done[i] + 1) * arr.len + arr.ws[i] - 1) // arr.ws[i]) * 1048576 + i END
              for i in range(1, arr.c + 1)]) % 1048576 AS p
          FROM edf e, arr WHERE e.t < arr.len)),
frame AS (SELECT ks[p] AS key, ws[p] AS weight, len, t - 1 AS slot,
    row_number() OVER (PARTITION BY p ORDER BY t) - 1 AS i FROM edf, arr WHERE p > 0),
ranked AS (SELECT doc_id, source, CASE WHEN source IS NULL THEN '0' ELSE '1' || source END AS key,
    row_number() OVER (PARTITION BY source ORDER BY md5(doc_id::VARCHAR), doc_id) - 1 AS r FROM documents),
blocks AS (SELECT *, r // {BLOCK_ROWS} AS block, (r % {BLOCK_ROWS})::INT AS place FROM ranked)
SELECT doc_id, source, block, (block * len) // weight AS release,
    ((block + 1) * len + weight - 1) // weight AS deadline,
    (block // weight) * len + slot AS slot, place
FROM blocks JOIN frame ON blocks.key = frame.key AND blocks.block % frame.weight = frame.i
"""
