"""Sharding by extendible hashing.

A directory is indexed by the leading bits of a row's hash.  One bucket holds
everything at first; only buckets above the byte limit split, on the next bit,
until every shard fits.  Splitting goes on in rounds of a few bits: the rows
of the oversized buckets are summed up per cell, the cells give the sizes of
all buckets between, and each cell belongs to the shortest prefix that fits.

The first 32 bits come from the id, so an id's place does not depend on other
rows; the other 32 from the row's number, so repeated rows of one id, however
many, split as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage

#: Bytes of text in a shard at most; bits of a round.
SHARD_BYTES, ROUND_BITS = 1 << 20, 12
BITS = 64


def assign_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  shard_bytes: int = SHARD_BYTES, round_bits: int = ROUND_BITS) -> DataFrame:
    """One row per input row: ``doc_id``, ``bytes`` (of the text in UTF-8),
    ``depth`` and ``prefix`` of its shard, and ``shard`` (the prefix's bits).

    A shard is the rows that share its ``depth`` leading hash bits.  A NULL or
    empty text has 0 bytes; a NULL id counts as ''.  A row above the limit ends
    alone in a shard (or with rows that share all its bits), the only kind of
    shard above the limit.  An empty table gives no rows; all rows in one shard
    have depth 0 and the empty name."""
    own = F.conv(F.substring(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), 1, 8),
                 16, 10).cast("long")
    number = F.xxhash64(F.monotonically_increasing_id()).bitwiseAND(0xFFFFFFFF)
    todo = stage(docs.select(
        F.col(id_col).alias("doc_id"), own.alias("_a"), number.alias("_b"),
        F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)).cast("long").alias("bytes")),
        "shard-rows").withColumn("_prefix", F.lit("")).withColumn(
        "_bits", F.concat(F.lpad(F.bin("_a"), 32, "0"), F.lpad(F.bin("_b"), 32, "0")))
    done = []
    for base in range(0, BITS, round_bits):
        top = min(base + round_bits, BITS)
        cells = (todo.groupBy(F.substring("_bits", 1, top).alias("_cell"))
                 .agg(F.sum("bytes").alias("size"), F.count("*").alias("rows")))
        paths = cells.select("_cell", "size", "rows", F.explode(F.sequence(F.lit(base), F.lit(top))).alias("depth")) \
            .withColumn("bucket", F.expr("substring(_cell, 1, depth)"))
        buckets = paths.groupBy("depth", "bucket").agg(
            F.sum("size").alias("total"), F.sum("rows").alias("many"))
        fits = (F.col("total") <= shard_bytes) | (F.col("many") == 1) | (F.col("depth") == BITS)
        leaf = stage(paths.join(buckets.filter(fits), ["depth", "bucket"], "left")
                     .groupBy("_cell").agg(F.min(F.when(F.col("total").isNotNull(), F.col("depth"))).alias("depth")),
                     "shard-cells")
        cell = F.substring("_bits", 1, top)
        small = base == 0  # 2 ** round_bits cells at most
        found = todo.withColumn("_cell", cell).join(F.broadcast(leaf) if small else leaf, "_cell")
        done.append(found.filter("depth is not null").select(
            "doc_id", "bytes", "depth", F.expr("substring(_bits, 1, depth)").alias("shard")))
        if not leaf.filter("depth is null").limit(1).count():
            break
        todo = stage(found.filter("depth is null").drop("_cell", "depth"), "shard-rest")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Writes ``docs`` as Parquet with one folder per shard below ``path``, and
    returns the directory: ``shard``, ``depth``, ``rows``, ``bytes``.  Rows join
    their shard by id, so ids (NULL is one) must be unique: repeated ones raise
    ``ValueError`` before anything is written."""
    placed = stage(assign_shards(docs, id_col, text_col, shard_bytes), "shards")
    if placed.groupBy("doc_id").count().filter("count > 1").limit(1).count():
        raise ValueError(f"write_shards needs unique ids, {id_col} has repeated ones")
    named = docs.join(placed.select(F.col("doc_id").alias("_id"), F.concat(F.lit("s"), "shard").alias("shard_id")),
                      F.col(id_col).eqNullSafe(F.col("_id"))).drop("_id")
    named.repartition("shard_id").write.partitionBy("shard_id").parquet(path)
    return placed.groupBy("shard", "depth").agg(F.count("*").alias("rows"), F.sum("bytes").alias("bytes"))


#: DuckDB SQL for ``assign_shards`` over documents with the default limit; ids are unique there.
SHARD_SQL = f"""
WITH rows AS (SELECT doc_id, coalesce(octet_length(encode(text)), 0)::BIGINT AS bytes,
    right(repeat('0', 32) || bin(('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT), 32) AS bits
    FROM documents),
paths AS (SELECT doc_id, bytes, depth::INT AS depth, substr(bits, 1, depth::INT) AS shard
    FROM rows, range(0, 33) AS d(depth)),
buckets AS (SELECT depth, shard, sum(bytes) AS total, count(*) AS many FROM paths GROUP BY depth, shard),
leaf AS (SELECT doc_id, min(p.depth) AS depth FROM paths p JOIN buckets b USING (depth, shard)
    WHERE b.total <= {SHARD_BYTES} OR b.many = 1 GROUP BY doc_id)
SELECT rows.doc_id, rows.bytes, leaf.depth, substr(rows.bits, 1, leaf.depth) AS shard
FROM rows JOIN leaf USING (doc_id)
"""
