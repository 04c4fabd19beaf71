"""Collocations: phrases whose words stand together far more often than apart.

A phrase of two or three words scores the floored millionfold of
``a * a / (l * r)`` at its weakest cut, ``a`` being its count and ``l`` and
``r`` the counts of the two parts. Phrases grow best first: no phrase
with prefix ``p`` can score more than ``f(p) / f(first word of p)``, nor one
that ends in ``q`` more than ``f(q) / f(last word of q)``, because a
phrase is no more frequent than any part of it. Of all pairs, those whose
bounds reach a language's threshold form its frontier, and only triples of
frontier pairs, and those that hold a pair that scores enough itself
(they decide whether it is dropped), are counted. The first threshold is the score of
the pair of rank ``FIRST * top``. Where fewer than ``top`` phrases survive at or above
it, the language's threshold falls to the pair of a rank ``GROWTH`` times
as far, until the last surviving score is settled, ties included, or all is expanded.

A task counts the phrases of a block of texts with numpy and sends each distinct one
once; counts are summed by language and phrase in Spark. Bitmaps of the frontier keep
other triples (and pairs of rare words) at home: they only ever let too much pass, since
what passes is counted whole and held against the frontier's exact counts.

Defined cases: a null or empty text has no words; a null language is ``und``,
one with rows of that name; rows of one id all count; a language without candidates has no
rows; with equal score and count the smaller phrase (UTF-8 bytes) is first. Columns besides the
two named are ignored.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brightlake.llm.text import Chunk, chunks, mix64
from brightlake.session import written

TOP = 2000
MIN_COUNT = 10
#: A phrase is dropped for a longer one that is at least so often, in hundredths.
COVER_PERCENT = 50
#: Rank, in multiples of the rows wanted, of the first threshold, and how far it falls.
FIRST, GROWTH = 2, 4
#: Words of a block that a task counts at a time.
BLOCK_WORDS = 1_000_000
#: Bits of a bitmap, as a power of two: 16 a member, between these.
MIN_BITS, MAX_BITS = 16, 27
#: Parts that the phrases of a language are ranked in first.
SALTS = 32

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 32]] = True
_PIECE = np.zeros(256, dtype=bool)
_PIECE[[10, 11, 12, 13, *b".,;:!?"]] = True
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def chunk_words(chunk: Chunk):
    """Words of some texts: the array of them, the row of each, and whether the next word
    stands in the same piece."""
    data, size = chunk.data, len(chunk.data)
    parts = _PIECE[data]
    apart = parts | _SPACE[data]
    edge = np.zeros(size + 1, dtype=bool)
    edge[chunk.offsets] = True
    before, after = np.ones(size + 1, dtype=bool), np.ones(size + 1, dtype=bool)
    before[1:], after[:-1] = apart, apart
    starts = np.flatnonzero(~after & (before | edge))
    ends = np.flatnonzero(~before & (after | edge))
    rows = np.searchsorted(chunk.offsets, starts, side="right") - 1
    piece = np.zeros(size + 1, dtype=np.int64)
    np.cumsum(parts, out=piece[1:])
    piece = piece[starts]
    joined = np.zeros(len(starts), dtype=bool)
    joined[:-1] = (rows[1:] == rows[:-1]) & (piece[1:] == piece[:-1])
    inside = ~apart
    offsets = np.zeros(len(starts) + 1, dtype=np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets.tobytes()),
                                        pa.py_buffer(data[inside].tobytes()))
    return words, rows, joined


class _Block:
    """Words of some texts with their languages, as codes of distinct words."""

    def __init__(self):
        self.words, self.langs, self.joined, self.names, self.size = [], [], [], {}, 0

    def add(self, words, langs, rows, joined):
        codes = np.array([self.names.setdefault(x, len(self.names)) for x in langs])
        self.words.append(words)
        self.langs.append(codes[rows])
        self.joined.append(joined)
        self.size += len(words)

    def close(self):
        encoded = pa.concat_arrays(self.words).dictionary_encode()
        self.distinct = encoded.dictionary
        self.code = encoded.indices.to_numpy().astype(np.int64)
        self.lang, self.next = np.concatenate(self.langs), np.concatenate(self.joined)
        self.hash = hash_strings(self.distinct)[self.code]
        self.lang_hash = hash_strings(pa.array(list(self.names)))[self.lang]

    def batch(self, lang, *codes, n):
        parts = [self.distinct.take(pa.array(c)) for c in codes]
        phrase = parts[0] if len(parts) == 1 else pc.binary_join_element_wise(*parts, " ")
        names = pa.array(list(self.names), pa.string()).take(pa.array(lang))
        return pa.RecordBatch.from_arrays([names, phrase, pa.array(n.astype(np.int64))],
                                          ["lang", "phrase", "f"])

    def counted(self, level: int, sieves: dict):
        """The block's phrases of ``level`` words that the bitmaps let pass, each with its count."""
        v = len(self.distinct)
        if level == 1:
            key, n = np.unique(self.lang * v + self.code, return_counts=True)
            return self.batch(key // v, key % v, n=n)
        if level == 2:
            good = _bits(sieves["words"], mix64(self.lang_hash + self.hash * _A))
            at = np.flatnonzero(self.next[:-1] & good[:-1] & good[1:])
            key, n = np.unique((self.lang[at] * v + self.code[at]) * v + self.code[at + 1],
                               return_counts=True)
            return self.batch(key // v // v, key // v % v, key % v, n=n)
        at = np.flatnonzero(self.next[:-1])
        pair = np.zeros(len(self.code), dtype=np.uint64)
        pair[at] = pair_hash(self.lang_hash[at], self.hash[at], self.hash[at + 1])
        begins, ends, holds = (_bits(sieves[k], pair) for k in ("begins", "ends", "holds"))
        want = begins[:-1] & ends[1:] | holds[:-1] | holds[1:]
        at = np.flatnonzero(self.next[:-1] & self.next[1:] & want)
        pairs, number = np.unique((self.lang[at] * v + self.code[at]) * v + self.code[at + 1],
                                  return_inverse=True)
        key, n = np.unique(number * v + self.code[at + 2], return_counts=True)
        first = pairs[key // v]
        return self.batch(first // v // v, first // v % v, first % v, key % v, n=n)


def hash_strings(words: pa.Array) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words.to_pylist()), np.uint64, len(words))


def pair_hash(lang: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix64(mix64(lang + first * _A) + second * _B)


def _bits(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = hashes >> np.uint64(64 - (len(bitmap).bit_length() + 2))
    return ((bitmap[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)


def bitmap_of(members: DataFrame) -> np.ndarray:
    """Bits set at the hashes of ``lang`` and ``phrase`` (a word or a pair): 16 a member, but
    no more than ``2 ** MAX_BITS``, so at most 16 MB reach the driver."""
    bits = min(max((16 * members.count()).bit_length(), MIN_BITS), MAX_BITS)

    def mark(batches):
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            lang = hash_strings(batch.column(0))
            parts = pc.split_pattern(batch.column(1), " ")
            first = hash_strings(pc.list_element(parts, 0)) if len(batch) else lang
            pairs = pc.list_value_length(parts).to_numpy() > 1
            h = mix64(lang + first * _A)
            if pairs.any():
                last = hash_strings(pc.list_element(parts.filter(pa.array(pairs)), 1))
                h[pairs] = pair_hash(lang[pairs], first[pairs], last)
            slot = h >> np.uint64(64 - bits)
            for block in np.unique(slot >> np.uint64(16)):
                flags = found.setdefault(int(block), np.zeros(1 << 16, dtype=bool))
                flags[slot[slot >> np.uint64(16) == block] & np.uint64(0xFFFF)] = True
        for block, flags in found.items():
            yield pa.RecordBatch.from_pydict(
                {"block": pa.array([block], pa.int32()),
                 "bits": pa.array([np.packbits(flags, bitorder="little").tobytes()], pa.binary())})

    out = np.zeros((1 << bits) // 8, dtype=np.uint8)
    rows = members.select("lang", "phrase").mapInArrow(mark, "block int, bits binary")
    # One row a block: tasks' bits are joined before they reach the driver.
    for r in rows.repartition("block").mapInArrow(_join_blocks, "block int, bits binary").collect():
        out[r["block"] << 13:(r["block"] + 1) << 13] |= np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def _join_blocks(batches):
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for row in batch.to_pylist():
            bits = np.frombuffer(row["bits"], np.uint8)
            held[row["block"]] = held[row["block"]] | bits if row["block"] in held else bits
    for block, bits in held.items():
        yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()),
                                          "bits": pa.array([bits.tobytes()], pa.binary())})


def phrase_counts(docs: DataFrame, level: int, sieves: dict | None = None, text: str = "text",
                  lang: str = "lang") -> DataFrame:
    """``lang``, ``phrase``, ``f``: phrases of ``level`` words with their counts."""
    shared = {k: docs.sparkSession.sparkContext.broadcast(b) for k, b in (sieves or {}).items()}

    def run(batches):
        block, bitmaps = _Block(), {k: b.value for k, b in shared.items()}
        for batch in batches:
            for first, end, chunk in chunks(batch.column(1), lower=True):
                words, rows, joined = chunk_words(chunk)
                block.add(words, batch.column(0).slice(first, end - first).to_pylist(), rows, joined)
                if block.size >= BLOCK_WORDS:
                    block.close()
                    yield block.counted(level, bitmaps)
                    block = _Block()
        if block.size:
            block.close()
            yield block.counted(level, bitmaps)

    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("_lang"),
                       F.col(text).alias("_text"))
    # The tasks' rows are distinct already: dealt by key at once, with no map-side aggregate.
    return (rows.mapInArrow(run, "lang string, phrase string, f long")
            .repartition("lang", "phrase").groupBy("lang", "phrase").agg(F.sum("f").alias("f")))


def _score(a, left, right):
    """floor(1000000 * a * a / (l * r)) in 38-digit integers: exact to counts of 10 ** 15."""
    a, left, right = (F.col(c).cast("decimal(18,0)") for c in (a, left, right))
    return F.call_function("div", F.lit(Decimal(1000000)) * (a * a), left * right)


def _pairs(docs: DataFrame, words: DataFrame, min_count: int, **names) -> DataFrame:
    """Pairs with at least ``min_count``: counts, score, and the bounds of what begins or ends so."""
    often = written(words.filter(F.col("f") >= min_count), "phrases-words")
    counted = phrase_counts(docs, 2, {"words": bitmap_of(often)}, **names)
    first, last = (F.substring_index("phrase", " ", n) for n in (1, -1))
    pairs = (counted.filter(F.col("f") >= min_count)
             .withColumn("w1", first).withColumn("w2", last)
             .join(often.toDF("lang", "w1", "f1"), ["lang", "w1"])
             .join(often.toDF("lang", "w2", "f2"), ["lang", "w2"]))
    return written(pairs.select(
        "lang", "phrase", "w1", "w2", "f", "f1", "f2", _score("f", "f1", "f2").alias("score"),
        F.expr("f * 1000000BD div f1").alias("begins"), F.expr("f * 1000000BD div f2").alias("ends")),
        "phrases-pairs")


def _thresholds(pairs: DataFrame, wanted: int) -> DataFrame:
    """``lang``, ``level``: the score of the pair of rank ``wanted``, or 0. A language has at most
    1,000,001 scores, whatever its pairs."""
    above = F.sum("n").over(Window.partitionBy("lang").orderBy(F.desc("score")))
    return (pairs.groupBy("lang", "score").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("above", above).groupBy("lang")
            .agg(F.coalesce(F.max(F.when(F.col("above") >= wanted, F.col("score"))),
                            F.lit(0)).alias("level")))


def _expanded(docs: DataFrame, pairs: DataFrame, min_count: int, cover: int, **names) -> DataFrame:
    """Surviving phrases that reach their language's ``level`` (a column of ``pairs``)."""
    reach = {k: pairs.filter(F.col(c) >= F.col("level"))
             for k, c in (("begins", "begins"), ("ends", "ends"), ("holds", "score"))}
    triples = phrase_counts(docs, 3, {k: bitmap_of(m) for k, m in reach.items()}, **names)
    start = F.substring_index("phrase", " ", 2)
    end = F.substring("phrase", F.length(F.substring_index("phrase", " ", 1)) + F.lit(2),
                      F.length("phrase"))
    side = pairs.select("lang", "phrase", "f", "f1", "f2", "level")
    triples = written(
        triples.filter(F.col("f") >= min_count).withColumn("start", start).withColumn("end", end)
        .join(side.select("lang", F.col("phrase").alias("start"), F.col("f").alias("f12"), "f1", "level"),
              ["lang", "start"])
        .join(side.select("lang", F.col("phrase").alias("end"), F.col("f").alias("f23"),
                          F.col("f2").alias("f3")), ["lang", "end"])
        .withColumn("s1", _score("f", "f1", "f23")).withColumn("s2", _score("f", "f12", "f3")),
        "phrases-triples")
    second = F.col("s2") < F.col("s1")
    long = triples.select(
        "lang", "phrase", F.col("f").alias("a"), F.when(second, F.col("f12")).otherwise(F.col("f1")).alias("l"),
        F.when(second, F.col("f3")).otherwise(F.col("f23")).alias("r"),
        F.least("s1", "s2").alias("score"), "level").filter(F.col("score") >= F.col("level"))
    inside = (triples.select("lang", "f", F.explode(F.array("start", "end")).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("f").alias("longer")))
    short = (pairs.filter(F.col("score") >= F.col("level")).join(inside, ["lang", "phrase"], "left")
             .filter(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("f") * cover))
             .select("lang", "phrase", F.col("f").alias("a"), F.col("f1").alias("l"),
                     F.col("f2").alias("r"), "score", "level"))
    return long.unionByName(short)


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", top: int = TOP,
                 min_count: int = MIN_COUNT, cover: int = COVER_PERCENT) -> DataFrame:
    """Each language's best ``top`` phrases: ``lang, rank, phrase, a, l, r, n, score``."""
    names = {"text": text, "lang": lang}
    words = written(phrase_counts(docs, 1, **names), "phrases-all-words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    pairs = _pairs(docs, words, min_count, **names)
    settled, wanted = [], FIRST * top
    left = pairs
    while True:
        levels = written(_thresholds(left, wanted), "phrases-levels")
        found = written(_expanded(docs, left.join(levels, "lang"), min_count, cover, **names),
                        "phrases-found")
        enough = (levels.join(found.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "lang", "left")
                  .withColumn("done", (F.col("level") == 0) | (F.coalesce("n", F.lit(0)) >= top)))
        enough = written(enough.select("lang", "done"), "phrases-settled")
        settled.append(found.join(enough.filter("done"), "lang", "left_semi"))
        if not enough.filter(~F.col("done")).head(1):
            break
        left = left.join(enough.filter(~F.col("done")), "lang", "left_semi")
        wanted *= GROWTH
    best = settled[0]
    for part in settled[1:]:
        best = best.unionByName(part)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = Window.partitionBy("lang", "_salt").orderBy(*order)
    first = (best.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
             .withColumn("_rank", F.row_number().over(salted)).filter(F.col("_rank") <= top))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return (first.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top)
            .join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
