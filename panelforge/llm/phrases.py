"""Phrases whose words keep company: collocation mining by prefix-free parsing.

1. *Parse.*  Every piece of text (between punctuation or line ends) is cut where
   three consecutive words hash to a multiple of ``TRIGGER``.  A chunk begins
   with the three words of one trigger and ends with those of the next, so
   neighbours overlap by three words, the places depend on content only, and
   repeated passages give the same chunks wherever they stand.
2. *Dictionary.*  Distinct chunks with their frequencies in the parse, stored.
3. *Count* inside distinct chunks, weighted by frequency.  A chunk owns the
   phrases whose last word lies behind the words that it shares with its
   predecessor: each occurrence has exactly one owner.  A phrase can be frequent
   only if its words and its pairs of neighbours are, so words and then pairs
   are first counted by hash, and bitmaps of the frequent hashes (of a bounded
   size, without false negatives) choose what is then counted exactly, as text.
4. *Score* every frequent phrase by its weakest cut, drop those that live inside a
   longer one, and rank per language.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SLICE_CHARS, Powers, mixed, parts, stage

# Longest phrase, least frequency, phrases per language, the share
# of a phrase's occurrences that a longer one must hold to replace it, and scale.
MAX_WORDS, MIN_COUNT, TOP, SHARE, SCALE = 4, 30, 2000, 80, 2_000_000
#: Words that neighbouring chunks share: one fewer than the longest phrase has.
OVERLAP = MAX_WORDS - 1
#: One of so many three-word windows ends a chunk.
TRIGGER = 16
#: Bits of a bitmap of frequent phrases: per phrase, and at least and at most in all.
BITS_PER_PHRASE, MIN_BITS, MAX_BITS = 16, 1 << 16, 1 << 27

_SPACE, _BREAK = 1, 2
CLASS = np.zeros(256, np.uint8)
CLASS[[32, 9]] = _SPACE
CLASS[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = _BREAK


class Words:
    """Words of some byte strings, in order, as arrays: place in ``raw``,
    64-bit hash, and the number of the piece that each is in."""

    def __init__(self, raw: bytes, powers: Powers):
        self.raw = raw
        b = np.frombuffer(raw, np.uint8)
        kind = CLASS[b]
        edge = np.diff(np.r_[0, kind == 0, 0].astype(np.int8))
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.piece = np.cumsum(kind == _BREAK, dtype=np.int64)[self.start] if len(b) else self.start
        if len(self.start):
            up, down = powers.of(len(b))
            term = (b.astype(np.uint64) + np.uint64(1)) * up
            total = np.cumsum(term, dtype=np.uint64)
            h = (total[self.end - 1] - total[self.start] + term[self.start]) * down[self.start]
            self.hash = mixed(h + (self.end - self.start).astype(np.uint64))
        else:
            self.hash = np.zeros(0, np.uint64)

    def windows(self, n: int) -> np.ndarray:
        """Hashes of every ``n`` consecutive words, whatever their pieces."""
        count = max(len(self.hash) - n + 1, 0)
        h = np.zeros(count, np.uint64)
        for i in range(n):
            h = h * np.uint64(0x9E3779B97F4A7C15) + self.hash[i:i + count]
        return mixed(h)


def _lower(text: str) -> bytes:
    """UTF-8 with A-Z in lower case and single spaces between words."""
    raw = text.encode().lower().replace(b"\t", b" ")
    while b"  " in raw:
        raw = raw.replace(b"  ", b" ")
    return raw


def parse(texts: list[str], powers: Powers, trigger: int = TRIGGER) -> tuple[list[bytes], np.ndarray]:
    """The chunks of some texts, and which of them begin a piece."""
    w = Words(b"\n".join(map(_lower, texts)) + b"\n", powers)
    n = len(w.start)
    if not n:
        return [], np.zeros(0, bool)
    first = np.r_[True, w.piece[1:] != w.piece[:-1]]
    last = np.r_[first[1:], True]
    # a trigger window starts behind the piece's first word and ends before its last
    cut = np.flatnonzero((w.windows(OVERLAP) % np.uint64(trigger) == 0)) if n >= OVERLAP else np.zeros(0, np.int64)
    inside = (w.piece[cut] == w.piece[cut + OVERLAP - 1]) & ~first[cut] & ~last[cut + OVERLAP - 1]
    cut = cut[inside]
    begins = np.flatnonzero(first)
    begin = np.sort(np.r_[begins, cut])
    end = np.sort(np.r_[np.flatnonzero(last), cut + OVERLAP - 1])
    raw = w.raw
    chunks = [raw[a:b] for a, b in zip(w.start[begin].tolist(), w.end[end].tolist())]
    return chunks, first[begin]


def chunk_dictionary(docs: DataFrame, lang_col: str = "lang", text_col: str = "text",
                     trigger: int = TRIGGER) -> DataFrame:
    """(lang, head, chunk, n): distinct chunks of all texts and how often each
    occurs.  ``head``: it begins a piece, so all its phrases are its own."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))

    def run(batches):
        powers = Powers()
        for piece, texts in parts(batches):
            langs = piece.column("lang").to_pylist()
            by_lang: dict[str, list[str]] = {}
            for lang, text in zip(langs, texts):
                by_lang.setdefault(lang, []).append(text)
            for lang, some in by_lang.items():
                chunks, head = parse(some, powers, trigger)
                counts: dict[tuple[bytes, bool], int] = {}
                for key in zip(chunks, head.tolist()):
                    counts[key] = counts.get(key, 0) + 1
                keys = list(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys), pa.string()), pa.array([k[1] for k in keys], pa.bool_()),
                     pa.array([k[0] for k in keys], pa.binary()).cast(pa.string()),
                     pa.array(list(counts.values()), pa.int64())], names=["lang", "head", "chunk", "n"])

    chunks = rows.mapInArrow(run, "lang string, head boolean, chunk string, n long")
    return chunks.groupBy("lang", "head", "chunk").agg(F.sum("n").alias("n"))


def _salt(lang: str) -> np.uint64:
    import xxhash
    return np.uint64(xxhash.xxh3_64_intdigest(lang.encode()))


def _gathered(batches, chars: int = SLICE_CHARS):
    """The dictionary's rows in lots of about ``chars`` characters, by language:
    (lang, words, number of each chunk's first word, its first owned word, its
    frequency).  Arrow's batches hold far fewer, which would hide repetition."""
    powers = Powers()

    def lots():
        some, size = [], 0
        for b in batches:
            some.append(b)
            size += b.column("chunk").nbytes
            if size >= chars:
                yield pa.Table.from_batches(some)
                some, size = [], 0
        if some:
            yield pa.Table.from_batches(some)

    for lot in lots():
        codes = lot.column("lang").combine_chunks().dictionary_encode()
        for i, lang in enumerate(codes.dictionary.to_pylist()):
            rows = lot.filter(pc.equal(codes.indices, i))
            w = Words(b"\n".join(rows.column("chunk").cast(pa.binary()).to_pylist()), powers)
            first = np.searchsorted(w.piece, np.arange(rows.num_rows))  # no chunk holds a break
            heads = rows.column("head").to_numpy(zero_copy_only=False)
            yield lang, w, first, first + np.where(heads, 0, OVERLAP), rows.column("n").to_numpy()


def _owned(w: Words, own: np.ndarray, n_words: int) -> np.ndarray:
    """For every window of ``n_words`` words: does it lie in one chunk, which owns it?"""
    count = max(len(w.start) - n_words + 1, 0)
    last = np.arange(count) + n_words - 1
    chunk = w.piece[:count]
    return (chunk == w.piece[last]) & (last >= own[chunk])


class Bitmap:
    """Which phrases of one length may be frequent: a bit per hash."""

    def __init__(self, words: np.ndarray):
        self.words, self.mask = words, np.uint64(64 * len(words) - 1)

    def may_hold(self, h: np.ndarray) -> np.ndarray:
        at = h & self.mask
        return (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _bits_for(n: int) -> int:
    """A power of two that grows with the number of phrases, up to ``MAX_BITS``."""
    want = max(MIN_BITS, n * BITS_PER_PHRASE)
    return min(MAX_BITS, 1 << (want - 1).bit_length())


def bitmap_of(frequent: DataFrame) -> Bitmap:
    """The bitmap of the hashes ``h``; at most ``MAX_BITS`` / 64 numbers reach the driver."""
    bits = _bits_for(frequent.count())
    merged = frequent.select(
        F.expr(f"shiftright(h & {bits - 1}L, 6)").alias("at"), F.expr("shiftleft(1L, cast(h & 63L AS int))").alias("word")
    ).groupBy("at").agg(F.bit_or("word").alias("word")).toArrow()
    words = np.zeros(bits // 64, np.int64)
    words[merged.column("at").to_numpy()] = merged.column("word").to_numpy()
    return Bitmap(words.view(np.uint64))


def hashed_counts(dictionary: DataFrame, n_words: int, of_words: Bitmap | None = None) -> DataFrame:
    """(h, f): occurrences per hash of (language, phrase), for the phrases of
    ``n_words`` words all of which ``of_words`` lets pass.  Phrases that share a
    hash are counted together, so no phrase is counted too low."""
    sent = None if of_words is None else dictionary.sparkSession.sparkContext.broadcast(of_words.words)

    def run(batches):
        known = None if sent is None else Bitmap(sent.value)
        for lang, w, _, own, n in _gathered(batches):
            take = _owned(w, own, n_words)
            if known is not None:
                ok = known.may_hold(w.windows(1) ^ _salt(lang))
                for i in range(n_words):
                    take &= ok[i:i + len(take)]
            at = np.flatnonzero(take)
            if not len(at):
                continue
            h = w.windows(n_words)[at] ^ _salt(lang)
            order = np.argsort(h)
            h = h[order]
            begin = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            f = np.add.reduceat(n[w.piece[at[order]]], begin)
            yield pa.RecordBatch.from_arrays([pa.array(h[begin].view(np.int64)), pa.array(f)], names=["h", "n"])

    return dictionary.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("f"))


#: Phrases that a task adds up before it hands them over.
HELD = 400_000


def exact_counts(dictionary: DataFrame, of_words: Bitmap, of_pairs: Bitmap) -> DataFrame:
    """(lang, words, phrase, f) of every phrase of one to four words whose words
    and pairs the bitmaps let pass; the row of no words counts all words."""
    context = dictionary.sparkSession.sparkContext
    sent = context.broadcast(of_words.words), context.broadcast(of_pairs.words)

    def run(batches):
        words, pairs = (Bitmap(x.value) for x in sent)
        held: dict[tuple[str, int], dict[bytes, int]] = {}

        def flush():
            for (lang, k), counts in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(counts), pa.string()), pa.array([k] * len(counts), pa.int32()),
                     pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64())],
                    names=["lang", "words", "phrase", "n"])
            held.clear()

        for lang, w, _, own, n in _gathered(batches):
            salt = _salt(lang)
            one, two = words.may_hold(w.windows(1) ^ salt), pairs.may_hold(w.windows(2) ^ salt)
            total = held.setdefault((lang, 0), {})
            total[b""] = total.get(b"", 0) + int(n[w.piece[_owned(w, own, 1)]].sum())
            for k in range(1, MAX_WORDS + 1):
                take = _owned(w, own, k)
                for i in range(max(k - 1, 1)):
                    take &= (one if k == 1 else two)[i:i + len(take)]
                at = np.flatnonzero(take)
                counts, raw = held.setdefault((lang, k), {}), w.raw
                get = counts.get
                for a, b, t in zip(w.start[at].tolist(), w.end[at + k - 1].tolist(), n[w.piece[at]].tolist()):
                    g = raw[a:b]
                    counts[g] = get(g, 0) + t
            if sum(map(len, held.values())) > HELD:
                yield from flush()
        yield from flush()

    return dictionary.mapInArrow(run, "lang string, words int, phrase string, n long").groupBy(
        "lang", "words", "phrase").agg(F.sum("n").alias("f"))


def frequent_phrases(dictionary: DataFrame, min_count: int = MIN_COUNT) -> tuple[DataFrame, DataFrame]:
    """(lang, words, phrase, f) of all phrases of one to four words with at
    least ``min_count`` occurrences, and (lang, n) with all words counted."""
    often = F.col("f") >= min_count
    of_words = bitmap_of(stage(hashed_counts(dictionary, 1).filter(often), "frequent-words"))
    of_pairs = bitmap_of(stage(hashed_counts(dictionary, 2, of_words).filter(often), "frequent-pairs"))
    counts = stage(exact_counts(dictionary, of_words, of_pairs).filter(often | (F.col("words") == 0)), "phrases")
    return counts.filter("words > 0"), counts.filter("words = 0").select("lang", F.col("f").alias("n"))


def _joined(words, start, length):
    return F.array_join(F.slice(words, start, length), " ")


def _spans(words, lengths):
    """The phrases of the given lengths inside an array of words."""
    return F.array_distinct(F.flatten(F.transform(lengths, lambda k: F.transform(
        F.sequence(F.lit(1), F.size(words) - k + 1), lambda i: F.array_join(F.slice(words, i, k), " ")))))


def score_sql() -> str:
    """floor(SCALE * a / (l + r)) in exact decimals."""
    return (f"(cast(a AS decimal(19,0)) * cast({SCALE} AS decimal(7,0))) DIV "
            "(cast(l AS decimal(19,0)) + cast(r AS decimal(19,0)))")


def mine_phrases(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", min_count: int = MIN_COUNT,
                 top: int = TOP, trigger: int = TRIGGER) -> DataFrame:
    """Each language's ``top`` collocations: lang, rank, phrase, a, l, r, n, score.

    A NULL language is ``und``, a NULL text is empty; empty texts and an empty
    table give nothing; repeated rows count again; texts may have any length.
    Ties of cuts go to the shortest first part, ties of phrases to the larger
    frequency, then the smaller phrase in byte order.  Other columns are not
    read.  Equal hashes make a bitmap pass more phrases, never fewer; all
    counts are exact."""
    dictionary = stage(chunk_dictionary(docs, lang_col, text_col, trigger), "chunks")
    frequent, totals = frequent_phrases(dictionary, min_count)
    candidates = frequent.filter("words > 1")
    cuts = candidates.select(
        "lang", "phrase", F.col("f").alias("a"), "words", F.split("phrase", " ").alias("w"),
        F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", _joined(F.col("w"), F.lit(1), F.col("k")).alias("_first"),
                       _joined(F.col("w"), F.col("k") + 1, F.col("words") - F.col("k")).alias("_rest"))
    side = frequent.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_part"), F.col("f").alias("_f"))
    for part, name in (("_first", "l"), ("_rest", "r")):
        cuts = cuts.join(side, (F.col("lang") == F.col("_lang")) & (F.col(part) == F.col("_part"))).select(
            *[c for c in cuts.columns if c != part], F.col("_f").alias(name))
    score = F.expr(score_sql())
    scored = cuts.select("lang", "phrase", "a", F.struct(score.alias("score"), "k", "l", "r").alias("cut")).groupBy(
        "lang", "phrase", "a").agg(F.min("cut").alias("cut"))
    inner = candidates.filter("words > 2").select(
        F.col("lang").alias("_lang"), F.col("f").alias("_f"), F.explode(_spans(
            F.split("phrase", " "), F.sequence(F.lit(2), F.col("words") - 1))).alias("_part"))
    inner = inner.groupBy("_lang", "_part").agg(F.max("_f").alias("_longer"))
    whole = scored.join(inner, (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("_part")), "left").filter(
        F.col("_longer").isNull() | (F.col("_longer").cast("decimal(38,0)") * 100
                                     < F.col("a").cast("decimal(38,0)") * SHARE))
    whole = whole.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"),
                         F.col("cut.score").alias("score"))
    # A language's best are among the best of its parts, so no task ranks a whole language.
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    part = whole.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    best = part.withColumn("_r", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).filter(
        F.col("_r") <= top).drop("_r", "_part")
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(
        F.col("rank") <= top)
    totals = totals.select(F.col("lang").alias("_lang"), "n")
    return ranked.join(totals, F.col("lang") == F.col("_lang")).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


PHRASE_SQL = f"""
WITH texts AS (
  SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
pieces AS (
  SELECT d, lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS p,
         generate_subscripts(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]'), 1) AS i FROM texts),
lists AS (SELECT d, i, lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS w FROM pieces),
words AS (SELECT d, i, lang, unnest(w) AS w1, generate_subscripts(w, 1) AS j FROM lists),
runs AS (
  SELECT lang, w1, lead(w1, 1) OVER p AS w2, lead(w1, 2) OVER p AS w3, lead(w1, 3) OVER p AS w4
  FROM words WINDOW p AS (PARTITION BY d, i ORDER BY j)),
grams AS (
  SELECT lang, 1 AS k, w1 AS phrase FROM runs
  UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM runs WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM runs WHERE w3 IS NOT NULL
  UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM runs WHERE w4 IS NOT NULL),
freq AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
cand AS (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM freq WHERE k > 1 AND f >= {MIN_COUNT}),
cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, c.j, l.f AS l, r.f AS r,
         CAST(CAST({SCALE} AS HUGEINT) * c.f // (CAST(l.f AS HUGEINT) + r.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(generate_series(1, k - 1)) AS j FROM cand) AS c
  JOIN freq AS l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.j], ' ')
  JOIN freq AS r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.j + 1:c.k], ' ')),
weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inside AS (
  SELECT lang, part, max(f) AS longer
  FROM (SELECT lang, f, array_to_string(w[s:s + m - 1], ' ') AS part
        FROM (SELECT *, unnest(generate_series(1, k - m + 1)) AS s
              FROM (SELECT *, unnest(generate_series(2, k - 1)) AS m FROM cand WHERE k > 2)))
  GROUP BY lang, part),
kept AS (
  SELECT w.* FROM weakest AS w LEFT JOIN inside AS i ON i.lang = w.lang AND i.part = w.phrase
  WHERE i.longer IS NULL OR CAST(100 AS HUGEINT) * i.longer < CAST({SHARE} AS HUGEINT) * w.a),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM freq WHERE k = 1 GROUP BY lang)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, phrase) AS rank,
             phrase, a, l, r, n, score
      FROM kept AS k JOIN total AS t ON t.lang = k.lang)
WHERE rank <= {TOP}
"""
