"""Exact n-gram Jaccard self-join, as components of linked documents.

1. Every text becomes its set of hashed word n-grams.  Equal sets form one
   node, so copies cost one row each and are never compared.
2. Prefix filter: of two sets with Jaccard similarity t or more, the
   ``n - ceil(t n) + 1`` first shingles of either, in any one order, have a
   shingle in common.  The order is by length, longest first: long shingles
   are rare, and those of short words only, which unrelated texts share by
   chance, come last.  Behind them come shingles that occur often (a bounded
   list; order and list steer cost, never the result).  Of two such sets the
   smaller one, of n shingles, even has the shingle among its first
   ``n - ceil(2 t n / (1 + t)) + 1``: there it is marked as leading.  Nodes that
   share a prefix shingle form a tile.
3. Links inside a tile are looked for in two steps.  First each node against
   a centre (in its size band the node that is in the most tiles), then those
   without a link against the node most like that one; the links found give
   components.  Then only pairs of
   one tile from different components whose smaller node leads, which for a
   group of near copies, or texts around one template, are few.  A tile's nodes
   are dealt over blocks, and each pair of blocks with such pairs meets in a
   group of its own: there each node is compared with the band of nodes that the
   size bound leaves to it, and the hashed bitmaps' bit counts bound the overlap
   from above: folded bitmaps first, which travel with the tiles' rows, then
   whole ones for the pairs that pass.
4. Pairs that pass are checked exactly by intersecting the sorted sets.

Entries move between tasks as packed arrays.  A shingle that very many nodes
share is split into blocks, and each pair of blocks meets in one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import checked_broadcast
from ..session import shuffle_partitions
from .common import Powers, Tokens, mixed, parts, stage, two, whole_rows, with_columns
from .components import connected_components

#: Bits of a bitmap per shingle of the set, at least; their number is a power of two.
BITS_PER_SHINGLE, LEAST_BITS = 6, 64
#: Characters of text whose words are arrays at once.
CHARS = 500_000
#: Frequent shingles kept for the order, and the counts that make one frequent.
FREQUENT = 1 << 18
FREQUENT_IN_SLICE, FREQUENT_IN_ALL = 4, 12
#: Prefix entries a task should get, entries of one shingle before it is split, nodes of a tile per block.
TASK_ENTRIES, HOT_ENTRIES, BLOCK = 1_000_000, 500_000, 2000
#: Times that nodes without a link try a centre nearer to the original.
CLIMBS = 2
#: Rows of tiles that a task should get, pairs that it looks at together, and 64-bit words
#: of their bitmaps.
TASK_ROWS, PAIRS, WORDS = 25_000, 300_000, 1_000_000
#: Shingles that a task counts together for the frequent ones.
COUNTED = 2_000_000

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: list[str], powers: Powers, n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text its distinct n-grams of lower-cased words (A-Z only) as sorted
    hashes, and the bytes of each n-gram's words; fewer words than n make one,
    none make none."""
    t = Tokens(texts, powers)
    size = t.end - t.start
    total = np.r_[0, np.cumsum(size)]
    full = max(len(t.h) - n + 1, 0)
    acc = t.h[:full]
    for k in range(1, n):
        acc = acc * MULTIPLIER + t.h[k:k + full]
    acc = mixed(acc + np.uint64(n))
    length = total[n:n + full] - total[:full]
    out = []
    for first, words in zip(t.first_word.tolist(), t.words.tolist()):
        if words >= n:
            s, at = np.unique(acc[first:first + words - n + 1], return_index=True)
            out.append((s, length[first + at]))
        elif words:
            h = t.h[first:first + 1]
            for k in range(1, words):
                h = h * MULTIPLIER + t.h[first + k:first + k + 1]
            out.append((mixed(h + np.uint64(words)), total[first + words:first + words + 1] - total[first]))
        else:
            out.append((t.h[:0], size[:0]))
    return out


def node_of(s: np.ndarray) -> int | None:
    """A set's 64-bit name, as a signed number; None for the empty set."""
    if not len(s):
        return None
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def leading_size(n: int, percent: int) -> int:
    """The prefix in which a set shares a shingle with the prefix of any similar set that
    is not smaller: they have 2 t n / (1 + t) shingles or more in common."""
    return n - -(-2 * percent * n // (100 + percent)) + 1


def bitmap(s: np.ndarray) -> bytes:
    """One bit per hash of the set, out of a power of two of at least
    ``BITS_PER_SHINGLE`` times its size; halving the bitmap by OR gives the
    next smaller one."""
    bits = max(LEAST_BITS, 1 << (BITS_PER_SHINGLE * len(s) - 1).bit_length())
    at = np.zeros(bits, np.uint8)
    at[(s >> np.uint64(20)) & np.uint64(bits - 1)] = 1
    return np.packbits(at, bitorder="little").tobytes()


def folded(bits: np.ndarray, width: int) -> np.ndarray:
    """Rows of 64-bit words, halved by OR down to ``width`` words."""
    while bits.shape[-1] > width:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] | bits[..., half:]
    return bits


def most_in_common(size_a, size_b, bits_a: np.ndarray, bits_b: np.ndarray) -> np.ndarray:
    """An upper bound of the overlap: a bit in which two bitmaps differ comes
    from a shingle of one set only, another one for each bit."""
    differ = np.bitwise_count(bits_a ^ bits_b).sum(axis=-1, dtype=np.int64)
    return (size_a + size_b - differ) // 2


def ordered(s: np.ndarray, length: np.ndarray, frequent: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The set in the global order: long shingles first, frequent ones last."""
    often = np.zeros(len(s), np.int64)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)
        often = np.where(frequent[at] == s, counts[at], 0)
    return s[np.lexsort((s, -length, often))]


def with_sets(docs: DataFrame, n: int) -> DataFrame:
    """Per row (kind 0): ``_id``, the set's size, node and, once per node and
    task, its bitmap; per some sets (kind 1): the shingles found in several
    of them, and in how many."""

    def run(batches):
        powers, seen, held = Powers(), set(), []
        names = ["kind", "_id", "n", "node", "bits"]
        for piece, texts in parts(batches, chars=CHARS):
            sizes, nodes, bits, sets = [], [], [], []
            for s, _ in shingle_sets(texts, powers, n):
                node = node_of(s)
                sizes.append(len(s))
                nodes.append(node)
                new = node is not None and node not in seen
                if new:
                    seen.add(node)
                    sets.append(s)
                bits.append(bitmap(s) if new else None)
            held += sets
            k = len(texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([0] * k, pa.int32()), piece.column("_id"), pa.array(sizes, pa.int64()),
                 pa.array(nodes, pa.int64()), pa.array(bits, pa.binary())], names=names)
            if sum(map(len, held)) > COUNTED:
                yield often(held)
                held = []
        if held:
            yield often(held)

    def often(sets):
        every = np.sort(np.concatenate(sets))
        # Equal neighbours FREQUENT_IN_SLICE apart: in at least so many of the sets.
        last = every[FREQUENT_IN_SLICE - 1:]
        found = np.unique(last[last == every[:len(every) - FREQUENT_IN_SLICE + 1]])
        times = np.searchsorted(every, found, "right") - np.searchsorted(every, found)
        k = len(found)
        return pa.RecordBatch.from_arrays(
            [pa.array([1] * k, pa.int32()), pa.nulls(k, pa.int64()), pa.array(times.astype(np.int64)),
             pa.array(found.view(np.int64)), pa.nulls(k, pa.binary())],
            names=["kind", "_id", "n", "node", "bits"])

    return docs.mapInArrow(run, "kind int, _id long, n long, node long, bits binary")


def prefix_tiles(docs: DataFrame, n: int, percent: int, frequent: np.ndarray, counts: np.ndarray,
                 groups: int, hot: int) -> DataFrame:
    """(tile, node, leads): nodes with a prefix shingle in common; a tile is named by
    its nodes, so shingles with the same nodes give one tile, where a node leads
    if it does for one of the shingles.  Tiles in which none leads only help to
    find centres."""
    entry = np.dtype([("key", "<u8"), ("node", "<i8")])  # the key's last bit: the shingle leads
    one = np.uint64(1)

    def emit(batches):
        powers, seen, held, size = Powers(), set(), [], 0

        def flush():
            e, lead = np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held])
            blocks = np.ones(len(e), np.int64)
            if len(frequent):
                at = np.minimum(np.searchsorted(frequent, e["key"]), len(frequent) - 1)
                blocks = np.where(frequent[at] == e["key"], 1 + counts[at] // hot, 1)
            split = blocks > 1
            if split.any():  # a node goes to every pair of blocks that has its own
                h, b = e[split], blocks[split]
                own = (mixed(h["node"].view(np.uint64)) % b.astype(np.uint64)).astype(np.int64)
                again = np.repeat(np.arange(len(h)), b)
                other = np.arange(len(again)) - np.repeat(np.cumsum(b) - b, b)
                low, high = np.minimum(own[again], other), np.maximum(own[again], other)
                more = h[again].copy()
                more["key"] = mixed(more["key"] + (low << 32 | high).astype(np.uint64) + np.uint64(1))
                e, lead = np.concatenate([e[~split], more]), np.r_[lead[~split], lead[split][again]]
            e["key"] = e["key"] & ~one | lead
            p = (mixed(e["key"] | one) % np.uint64(groups)).astype(np.int32)
            order = np.argsort(p, kind="stable")
            p, e = p[order], e[order]
            starts = np.flatnonzero(np.r_[True, p[1:] != p[:-1]])
            ends = np.r_[starts[1:], len(p)]
            return pa.RecordBatch.from_arrays(
                [pa.array(p[starts]), pa.array([e[i:j].tobytes() for i, j in zip(starts, ends)],
                                               pa.binary())], names=["p", "entries"])

        for _, texts in parts(batches, chars=CHARS):
            for s, length in shingle_sets(texts, powers, n):
                node = node_of(s)
                if node is None or node in seen:
                    continue
                seen.add(node)
                e = np.empty(prefix_size(len(s), percent), entry)
                e["key"] = ordered(s, length, frequent, counts)[:len(e)]
                e["node"] = node
                held.append((e, (np.arange(len(e)) < leading_size(len(s), percent)).astype(np.uint64)))
                size += len(e)
                if size >= TASK_ENTRIES // 2:
                    yield flush()
                    held.clear()
                    size = 0
        if held:
            yield flush()

    def tiles(pdf):
        import pandas as pd
        e = np.concatenate([np.frombuffer(b, entry) for b in pdf["entries"]])
        del pdf
        e = e[np.argsort(e["key"], kind="stable")]
        key = e["key"] | one
        same = key[1:] == key[:-1]
        e = e[np.r_[False, same] | np.r_[same, False]]
        e = e[np.lexsort((~e["key"] & one, e["node"], e["key"] | one))]  # of a node's, the leading one first
        key = e["key"] | one
        if len(e):
            new = np.r_[True, (key[1:] != key[:-1]) | (e["node"][1:] != e["node"][:-1])]
            e, key = e[new], key[new]
        out = {c: [] for c in ("tile", "node", "leads")}
        if len(e):
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            sizes = np.diff(np.r_[starts, len(e)])
            names = np.add.reduceat(mixed(e["node"].view(np.uint64)), starts)
            lead = (e["key"] & one).astype(np.int64)
            keep = np.repeat(sizes > 1, sizes)
            out = {"tile": np.repeat(names.view(np.int64), sizes)[keep], "node": e["node"][keep], "leads": lead[keep]}
            order = np.lexsort((-out["leads"], out["node"], out["tile"]))
            out = {c: x[order] for c, x in out.items()}
            new = np.r_[True, (np.diff(out["tile"]) != 0) | (np.diff(out["node"]) != 0)][:len(order)]
            out = {c: x[new] for c, x in out.items()}
        return pd.DataFrame(out).astype("int64")

    packed = docs.select("_text").mapInArrow(emit, "p int, entries binary")
    return (packed.groupBy("p").applyInPandas(tiles, "tile long, node long, leads long")
            .groupBy("tile", "node").agg(F.max("leads").alias("leads")))


def star_pairs(tiles: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """One pair (a: node, b: centre) per node.  Each size band of a tile has its
    node that is in the most tiles as centre, which among near copies is near
    the original; a node takes the centre that it meets in the most tiles."""
    degree = tiles.groupBy("node").agg(F.count("*").alias("degree"))
    band = F.floor(F.log("n") / F.log(F.lit(100.0 / percent)))
    t = tiles.select("tile", "node").join(degree, "node").join(
        nodes.select("node", band.alias("band")), "node")
    centre = t.groupBy("tile", "band").agg(F.max(F.struct("degree", "node")).alias("centre"))
    met = t.join(centre, ["tile", "band"]).filter("node != centre.node").groupBy(
        "node", F.col("centre.node").alias("other")).agg(F.count("*").alias("times"))
    return met.groupBy("node").agg(F.max(F.struct("times", "other")).alias("x")).select(
        F.col("node").alias("a"), F.col("x.other").alias("b"))


def nearer_pairs(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs without a link again, with the node most like their centre as
    the new centre.  Copies have more in common with their original than with
    each other, so this climbs towards it."""
    nearest = found.groupBy("b").agg(F.max(F.struct("share", "a")).alias("x")).select(
        F.col("b").alias("old"), F.col("x.a").alias("new"))
    left = pairs.join(found.select("a", "b"), ["a", "b"], "left_anti")
    return left.join(nearest, left["b"] == nearest["old"]).filter("a != new").select(
        "a", F.col("new").alias("b"))


def possible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sizes and bitmaps allow the similarity."""

    def run(batches):
        for batch in batches:
            bits = [batch.column(c).to_pylist() for c in ("bits_a", "bits_b")]
            size = [batch.column(c).to_numpy() for c in ("n_a", "n_b")]
            width = np.array([min(len(x), len(y)) // 8 for x, y in zip(*bits)], np.int64)
            good = np.zeros(batch.num_rows, bool)
            for w in np.unique(width):
                at = np.flatnonzero(width == w)
                a, b = (np.stack([folded(np.frombuffer(x[i], np.uint64), w) for i in at]) for x in bits)
                total = size[0][at] + size[1][at]
                good[at] = (100 + percent) * most_in_common(size[0][at], size[1][at], a, b) >= percent * total
            keep = pa.array(np.flatnonzero(good))
            yield pa.RecordBatch.from_arrays([batch.column(c).take(keep) for c in ("a", "b")], names=["a", "b"])

    def side(x):
        return nodes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("bits").alias(f"bits_{x}"))

    near = (F.col("n_a") * 100 >= F.col("n_b") * percent) & (F.col("n_b") * 100 >= F.col("n_a") * percent)
    both = pairs.join(side("a"), "a").join(side("b"), "b").filter(near)
    return both.select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(run, "a long, b long")


def linked(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity, checked exactly, with
    what ``share`` of their shingles both have.  Sets are made again from one document each of the nodes in question."""
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    ids = nodes.join(wanted, "node", "left_semi").select("id").distinct()

    def sets_of(batches):
        powers, seen = Powers(), set()
        for _, texts in parts(batches, chars=CHARS):
            out = []
            for s, _ in shingle_sets(texts, powers, n):
                node = node_of(s)
                if node is not None and node not in seen:
                    seen.add(node)
                    out.append((node, s.tobytes()))
            cols = list(zip(*out)) or [()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.binary())],
                                             names=["node", "set"])

    ids, fits = checked_broadcast(ids)  # by measured size; beyond it the texts are shuffled
    texts = docs.join(F.broadcast(ids) if fits else ids, F.col("_id").eqNullSafe(F.col("id")),
                      "left_semi").select("_text")
    sets = stage(texts.mapInArrow(sets_of, "node long, set binary").dropDuplicates(["node"]), "tile-sets")

    def run(batches):
        for batch in batches:
            keep, share = [], []
            left, right = batch.column("set_a"), batch.column("set_b")
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(c[i].as_buffer(), np.uint64) for c in (left, right))
                either = len(np.union1d(x, y))
                both = len(x) + len(y) - either
                if 100 * both >= percent * either:
                    keep.append(i)
                    share.append(both / either)
            keep = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(keep) for c in ("a", "b")),
                                              pa.array(share, pa.float64())], names=["a", "b", "share"])

    def side(x):
        return sets.select(F.col("node").alias(x), F.col("set").alias(f"set_{x}"))

    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "set_a", "set_b")
    return both.mapInArrow(run, "a long, b long, share double")


def dealt(tiles: DataFrame, parts: DataFrame, sizes: DataFrame, percent: int,
          block: int) -> tuple[DataFrame, DataFrame]:
    """(per tile its counts and ``rows``, the rows): rows (tile, kind, low_band,
    high_band, low, high, side, node, part, leads), a group for each pair of blocks
    in which pairs of different components can have a leading node.

    With the tile's largest component as main, those pairs are: leading nodes of
    the others among themselves (kind 0; side 1 is the higher block) and with all
    that is not so (kind 1), and leading nodes of the main component with those of
    the others that don't lead (kind 2).  A group has about two blocks of rows.

    The nodes of a tile of more than ``block`` nodes are dealt by size first: sizes
    in a ratio of 100 / ``percent`` make a band, similar sets lie in one band or in
    neighbouring ones, and blocks of other bands never meet.  ``sizes``: node, n."""
    t = tiles.join(parts.withColumnRenamed("component", "part"), "node", "left").withColumn(
        "part", F.coalesce("part", "node")).join(sizes, "node")
    in_band = F.floor(F.log("n") / F.log(F.lit(100.0 / percent)) + F.lit(1e-9)).cast("int")
    per_part = t.groupBy("tile", "part").agg(F.count("*").alias("count"), F.sum("leads").alias("lead"))
    x = per_part.groupBy("tile").agg(F.max(F.struct("count", "part", "lead")).alias("m"), F.sum("count").alias("all"),
                                     F.sum("lead").alias("lead"), F.count("*").alias("parts")).filter("parts > 1")
    x = x.filter("lead > m.lead OR m.lead > 0 AND all - lead - m.count + m.lead > 0").select(
        "tile", F.col("m.part").alias("main"), (F.col("all") > block).alias("wide"))
    x = stage(x, "tile-mains")
    t = t.join(x, "tile").withColumn("band", F.when(F.col("wide"), in_band).otherwise(F.lit(0)))

    def some(condition):
        return F.count_if(F.expr(condition))

    counts = t.groupBy("tile", "band").agg(
        some("leads = 1 AND part != main").alias("a"), some("leads = 1 AND part = main").alias("b"),
        some("leads = 0 AND part != main").alias("c"), some("leads = 0 OR part = main").alias("d"))
    counts = stage(counts.selectExpr("tile", "band", *(f"int(ceil({k} / {block})) AS {k}" for k in "abcd"), "a AS n_a",
                                     "b AS n_b", "c AS n_c", "d AS n_d"), "tile-counts")
    # a tile has few bands: their numbers of blocks travel as one map
    blocks = counts.groupBy("tile").agg(F.map_from_entries(F.collect_list(F.struct(
        "band", F.struct("a", "b", "c", "d")))).alias("blocks"))

    def own(k):
        return f"int(pmod(xxhash64(node), try_element_at(blocks, band).{k}))"

    def met(k, other, kind, low_band, high_band, low, high, side):
        n = f"coalesce(try_element_at(blocks, {other}).{k}, 0)"
        return (f"transform(IF({n} > 0, sequence(0, {n} - 1), array()), o -> struct({kind} AS kind, int({low_band}) AS low_band, "
                f"int({high_band}) AS high_band, int({low}) AS low, int({high}) AS high, int({side}) AS side))")

    def near(k, kind, mine, side):
        """Blocks of the class ``k`` in this node's band and the two beside it."""
        return ", ".join(met(k, f"band + {i}", kind, "band" if side == 0 else f"band + {i}", f"band + {i}" if side == 0 else "band",
                             own(mine) if side == 0 else "o", "o" if side == 0 else own(mine), side) for i in (-1, 0, 1))

    lone = ", ".join((
        met("a", "band", 0, "band", "band", f"least(o, {own('a')})", f"greatest(o, {own('a')})", f"{own('a')} > o"),
        met("a", "band + 1", 0, "band", "band + 1", own("a"), "o", 0),
        met("a", "band - 1", 0, "band - 1", "band", "o", own("a"), 1)))
    groups = f"""CASE
        WHEN leads = 1 AND part != main THEN concat({lone}, {near("d", 1, "a", 0)})
        WHEN leads = 1 THEN concat({near("a", 1, "d", 1)}, {near("c", 2, "b", 0)})
        WHEN part != main THEN concat({near("a", 1, "d", 1)}, {near("b", 2, "c", 1)})
        ELSE concat({near("a", 1, "d", 1)}) END"""
    rows = t.join(blocks, "tile").selectExpr("tile", "node", "part", "leads", "n", f"explode({groups}) AS g")
    near_blocks = blocks.alias("y").join(counts.alias("x"), "tile").selectExpr("tile", " + ".join(
        f"n_{k} * coalesce(try_element_at(blocks, band + {i}).{o}, 0)"
        for k, o in ("aa", "ad", "da", "bc", "cb") for i in (-1, 0, 1)) + " AS rows")
    return near_blocks, rows.select("tile", "g.*", "node", "part", "leads", "n")


#: A node's rows in the tiles carry its bitmap folded to one in so many bits, but not
#: below so many 64-bit words; pairs that pass are held against the whole bitmaps.
COARSE, COARSE_WORDS = 4, 32


def coarse(nodes: DataFrame) -> DataFrame:
    """(node, n, bits) with folded bitmaps."""

    def run(batches):
        for b in batches:
            bits = [folded(w, max(min(len(w), COARSE_WORDS), len(w) // COARSE)).tobytes()
                    for w in (np.frombuffer(x, np.uint64) for x in b.column("bits").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("node"), b.column("n"), pa.array(bits, pa.binary())],
                                             names=["node", "n", "bits"])

    return stage(nodes.select("node", "n", "bits").mapInArrow(run, "node long, n long, bits binary"), "coarse")


def cross_pairs(tiles: DataFrame, parts: DataFrame, signatures: DataFrame, percent: int,
                block: int, buckets: int) -> DataFrame:
    """Pairs of one tile, from different components, that size and bitmap allow.
    At least ``buckets`` tasks share the groups, about ``TASK_ROWS`` rows each."""
    counts, t = dealt(tiles, parts, signatures.select("node", "n"), percent, block)
    total = counts.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    buckets = max(buckets, int(total) // TASK_ROWS + 1)
    t = t.join(signatures.select("node", "bits"), "node")
    named = ["tile", "kind", "low_band", "high_band", "low", "high"]

    def run(pdf):
        import pandas as pd
        pdf = pdf.sort_values([*named, "side", "n", "node"], kind="stable")
        group = np.cumsum(np.r_[0, (np.diff(pdf[named].to_numpy(), axis=0) != 0).any(axis=1)])
        size, part, node, leads, side = (pdf[c].to_numpy() for c in ("n", "part", "node", "leads", "side"))
        alone = ((pdf["kind"] == 0) & (pdf["low"] == pdf["high"])
                 & (pdf["low_band"] == pdf["high_band"])).to_numpy()  # a block with itself
        raw = [np.frombuffer(x, np.uint64) for x in pdf["bits"]]
        width = np.array([len(x) for x in raw])
        stacked = {w: folded_rows(raw, width, w) for w in np.unique(width)}
        # Each row of side 0 is compared with the band of rows of side 1 that the size bound
        # leaves to it, or of its own side where a block meets itself.
        reach = size.max() * 2 + 1
        rows = np.flatnonzero(side == 0)
        base = (2 * group[rows] + ~alone[rows]) * reach
        place = (2 * group + side) * reach + size
        low = np.searchsorted(place, base + -(-percent * size[rows] // 100))
        high = np.searchsorted(place, base + np.minimum(100 * size[rows] // percent, reach - 1), "right")
        ends = np.cumsum(high - low)
        found, first = [], 0
        while first < len(rows):  # some rows' bands at a time
            done = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, done + PAIRS, "right")))
            j, of = ranges(low[first:last], high[first:last])
            i = rows[of + first]
            ok = (part[i] != part[j]) & (~alone[i] | (node[i] < node[j]))
            ok &= (leads[i] > 0) & (size[i] <= size[j]) | (leads[j] > 0) & (size[j] <= size[i])
            i, j = i[ok], j[ok]
            w_pair = np.minimum(width[i], width[j])
            for w in np.unique(w_pair):
                x, y = i[w_pair == w], j[w_pair == w]
                at, bits = stacked[w]
                step = max(1, WORDS // int(w))  # wide bitmaps in smaller lots
                for k in range(0, len(x), step):
                    u, v = x[k:k + step], y[k:k + step]
                    most = most_in_common(size[u], size[v], bits[at[u]], bits[at[v]])
                    good = (100 + percent) * most >= percent * (size[u] + size[v])
                    found.append(np.stack([node[u[good]], node[v[good]]]))
            first = last
        a, b = np.concatenate(found, axis=1) if found else np.empty((2, 0), np.int64)
        pairs = pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})
        return pairs.drop_duplicates()

    bucket = F.pmod(F.xxhash64(*named), F.lit(buckets))
    return t.groupBy(bucket.alias("bucket")).applyInPandas(run, "a long, b long").distinct()


def folded_rows(raw: list[np.ndarray], width: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray]:
    """The bitmaps of ``w`` or twice as many words, folded to ``w``, and each row's place there."""
    rows = np.flatnonzero((width == w) | (width == 2 * w))
    at = np.full(len(raw), -1)
    at[rows] = np.arange(len(rows))
    return at, np.stack([folded(raw[i], w) for i in rows])


def ranges(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, one after another, and which range each is of."""
    size = np.maximum(end - start, 0)
    of = np.repeat(np.arange(len(start)), size)
    return np.arange(len(of)) - np.repeat(np.cumsum(size) - size - start, size), of


def similarity_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       n: int = 5, percent: int = 75, frequent: int = FREQUENT,
                       task_entries: int = TASK_ENTRIES, hot_entries: int = HOT_ENTRIES,
                       block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(rows, classes).  ``rows``: ``_id``, ``n`` (set size) and ``node`` per
    input row; ``classes``: ``node``, ``component_id`` (the smallest id reachable
    by links) and ``keeper``, the smallest node with that id.

    A NULL or wordless text has an empty set, NULL as node and no class.
    Repeated rows fall into one node.  NULL ids are never the smallest unless a
    class has no other.  ``percent`` is at least 50 for the filters to pay."""
    spark = docs.sparkSession
    src = two(docs, id_col, text_col)
    found = stage(with_sets(src, n), "sets")
    rows = found.filter("kind = 0").select("_id", "n", "node")
    nodes = stage(found.filter("kind = 0 and node is not null").groupBy("node").agg(
        F.min("_id").alias("id"), F.max("n").alias("n"), F.max("bits").alias("bits")), "nodes")
    often = (found.filter("kind = 1").groupBy("node").agg(F.sum("n").alias("n"))
             .filter(F.col("n") >= FREQUENT_IN_ALL).orderBy(F.desc("n"), "node")
             .limit(frequent).toArrow())  # at most `frequent` hashes and counts
    keys = often.column("node").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(keys)
    keys, counts = keys[order], often.column("n").to_numpy().astype(np.int64)[order]
    entries = nodes.agg(F.coalesce(F.sum(F.expr(f"n - ceil({percent} * n / 100) + 1")), F.lit(0))).first()[0]
    groups = max(shuffle_partitions(spark), int(entries) // task_entries + 1)
    tiles = stage(prefix_tiles(src, n, percent, keys, counts, groups, hot_entries), "tiles")

    def links(pairs):
        return stage(linked(stage(pairs, "pairs"), src, nodes, n, percent), "links")

    pairs = stage(star_pairs(tiles, nodes, percent), "stars")
    found = links(possible(pairs, nodes, percent))
    first = found
    for _ in range(CLIMBS):
        pairs = stage(nearer_pairs(pairs, found), "stars")
        found = links(possible(pairs, nodes, percent))
        first = first.unionByName(found)
    parts = connected_components(first, "a", "b")
    met = stage(cross_pairs(tiles, parts, coarse(nodes), percent, block, shuffle_partitions(spark)), "met")
    second = links(possible(met, nodes, percent))
    comps = connected_components(first.unionByName(second), "a", "b")

    named = nodes.join(comps, "node", "left").withColumn("component", F.coalesce("component", "node"))
    keepers = named.groupBy("component").agg(
        F.min("id").alias("component_id"),
        F.min(F.struct(F.col("id").isNull(), "id", "node")).alias("low"))
    classes = stage(named.join(keepers, "component").select(
        "node", "component_id", F.col("low.node").alias("keeper")), "classes")
    return rows, classes


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       **settings) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_shingles`` and ``component_id``."""
    rows, classes = similarity_classes(docs, id_col, text_col, **settings)
    return rows.join(classes, "node", "left").select(
        F.col("_id").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("_id")).otherwise(F.col("component_id"))
        .alias("component_id"))


def one_per_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  **settings) -> DataFrame:
    """The rows of ``docs``, all columns, without near duplicates: of each class
    the row with the smallest id stays.  Rows without words all stay."""
    _, classes = similarity_classes(docs, id_col, text_col, **settings)
    n = settings.get("n", 5)

    def fn():
        powers = Powers()
        return lambda texts: [pa.array([node_of(s) for s, _ in shingle_sets(texts, powers, n)], pa.int64())]

    def name(c):  # NULL and numbers as text: plain keys for join and grouping
        return F.coalesce(c.cast("long").cast("string"), F.lit("")).alias("_key")

    tagged = with_columns(whole_rows(docs, text_col), fn, "_node long", CHARS).select(
        "_id", "_node", name(F.col(f"_id.`{id_col}`")))
    keep = classes.filter("node = keeper").select(F.col("keeper").alias("_node"), name(F.col("component_id")))
    kept = tagged.filter("_node is not null").join(keep, ["_node", "_key"]).dropDuplicates(["_node", "_key"])
    return kept.select("_id.*").unionByName(tagged.filter("_node is null").select("_id.*"))
