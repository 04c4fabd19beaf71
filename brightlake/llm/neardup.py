"""Near-duplicate documents by min-max hashing.

Under each of ``PERMUTATIONS`` hash functions a document keeps the smallest
and the largest value of its word shingles: two signature values for one hash
evaluation. Bands of ``BAND_ROWS`` values retrieve candidates. At a similarity
of 0.8 two documents share none of the ``BANDS`` bands with probability
``(1 - 0.8**4)**20 = 2.6e-5``.

Documents with equal shingle sets are one representative (the smallest id).
In each band bucket every representative is first compared with the bucket's
most central member, the one that shares the most buckets' places. Links are
confirmed on the full shingle sets and joined to components. Members of
buckets that still hold several components then go through an exact
similarity join: a document's shingles in one global order, rarest first, have
a prefix in which any similar partner must share one, at a place that leaves
enough shingles for the overlap. Its pairs of different components are
confirmed as well. So groups of near copies cost one comparison a member, and
no pair is left out because its bucket is large.

Defined cases: a null or empty text, or one without words, has an empty set
and is linked with nothing; a text of fewer words than a shingle has its whole
word sequence as one; rows of one id are one document, whose texts all count;
a row with a null id is linked with nothing and kept. In ``one_of_each`` every
row is a document of its own, with null and repeated ids too. Other columns are
ignored by ``components`` and carried along by ``one_of_each``.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from brightlake.llm.text import SMALL_BYTES, Chunk, buffers, chunks, mix64, shingles
from brightlake.session import scratch_path

SHINGLE_WORDS = 5
PERMUTATIONS = 40
BAND_ROWS = 4
BANDS = 2 * PERMUTATIONS // BAND_ROWS
#: Similarity of linked documents, in hundredths.
PERCENT = 80
#: Bits, as a power of two, of the bitmap that keeps texts of other ids out of a join.
SIEVE_BITS = 23
#: Parts that the copies of one shingle set are dealt into.
SALTS = 16
#: Counters that order shingles by rarity in the exact join.
RARITY_BITS = 18

_rng = np.random.default_rng(7)
_XOR = _rng.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64)
_ODD = _rng.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signatures(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Min and max of each permutation for the rows that have shingles: (2 * permutations, n)."""
    out = np.zeros((2 * PERMUTATIONS, n), dtype=np.uint64)
    if not len(rows):
        return out
    first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    at = rows[first]
    for i in range(PERMUTATIONS):
        permuted = (values ^ _XOR[i]) * _ODD[i]
        permuted ^= permuted >> np.uint64(32)
        out[i, at] = np.minimum.reduceat(permuted, first)
        out[PERMUTATIONS + i, at] = np.maximum.reduceat(permuted, first)
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band and row: (bands, n)."""
    out = np.zeros((BANDS, signature.shape[1]), dtype=np.uint64)
    for band in range(BANDS):
        key = np.full(signature.shape[1], band, dtype=np.uint64)
        for j in range(BAND_ROWS):
            key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + signature[band + j * BANDS])
        out[band] = key
    return out


def sketches(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """``_id``, ``n_shingles``, a digest of the set and the band keys."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for first, end, chunk in chunks(batch.column(1), lower=True, limit=SMALL_BYTES):
                rows, values = shingles(chunk, words)
                n = np.bincount(rows, minlength=chunk.n)
                sums = []
                for salt in (0x8CB92BA72F3D8DD7, 0xD6E8FEB86659FD93):
                    total = np.zeros(len(values) + 1, dtype=np.uint64)
                    np.cumsum(mix64(values * np.uint64(salt)), out=total[1:])
                    ends = np.cumsum(n)
                    sums.append((total[ends] - total[ends - n]).view(np.int64))
                signature = signatures(rows, values, chunk.n)
                keys = band_keys(signature).T.copy().view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), pa.array(n, pa.int64()),
                     pa.array(sums[0]), pa.array(sums[1]),
                     pa.ListArray.from_arrays(
                         pa.array(np.arange(chunk.n + 1, dtype=np.int32) * BANDS),
                         pa.array(keys.ravel()))],
                    ["_id", "n_shingles", "_s1", "_s2", "_bands"])

    return docs.select(key, text).mapInArrow(
        run, f"_id {kind}, n_shingles long, _s1 long, _s2 long, _bands array<long>")


def _pair_slices(a: pa.Array, b: pa.Array, limit: int = SMALL_BYTES):
    (data_a, at_a), (data_b, at_b) = buffers(a), buffers(b)
    size, first = at_a + at_b, 0
    while first < len(a):
        end = int(np.searchsorted(size, size[first] + limit, side="right")) - 1
        end = min(max(end, first + 1), len(a))
        yield first, end, *[Chunk(d[at[first]:at[end]], at[first:end + 1] - at[first], True)
                            for d, at in ((data_a, at_a), (data_b, at_b))]
        first = end


def similar(a: pa.Array, b: pa.Array, words: int, percent: int) -> np.ndarray:
    """Which rows' texts have shingle sets that are similar enough, by exact counts."""
    out = np.zeros(len(a), dtype=bool)
    for first, end, left, right in _pair_slices(a, b):
        sets = [shingles(c, words) for c in (left, right)]
        keys = [v + mix64((r + 1).astype(np.uint64)) for r, v in sets]
        both = np.concatenate(keys)
        order = np.argsort(both, kind="stable")
        same = order[1:][both[order][1:] == both[order][:-1]]
        rows = np.concatenate([r for r, _ in sets])[same]
        shared = np.bincount(rows, minlength=end - first)
        whole = sum(np.bincount(r, minlength=end - first) for r, _ in sets) - shared
        out[first:end] = (100 * shared >= percent * whole) & (whole > 0)
    return out


def id_bitmap(ids: DataFrame) -> np.ndarray:
    """2 ** SIEVE_BITS bits, set where the hash of an id of ``ids`` falls: one size for any input."""
    def mark(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            slots = batch.column(1).to_numpy()
            for block in np.unique(slots >> 15):
                bits = held.setdefault(int(block), np.zeros(1 << 15, dtype=bool))
                bits[slots[slots >> 15 == block] & 0x7FFF] = True
        for block, bits in held.items():
            yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()),
                                              "bits": [np.packbits(bits).tobytes()]})

    slot = _slot(ids.columns[0])
    blocks = (ids.select(F.shiftright(slot, 15).alias("_block"), slot.alias("_slot")).distinct()
              .repartition("_block").mapInArrow(mark, "block int, bits binary"))
    bitmap = np.zeros(1 << SIEVE_BITS, dtype=bool)
    for r in blocks.collect():
        at = r["block"] << 15
        bitmap[at:at + (1 << 15)] = np.unpackbits(np.frombuffer(bytes(r["bits"]), np.uint8)).astype(bool)
    return np.packbits(bitmap)


def _slot(column: str):
    return F.pmod(F.xxhash64(column), F.lit(1 << SIEVE_BITS)).cast("int")


def texts_of(pairs: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """``_id`` and ``_text`` of the documents in the pairs, written once.

    A bitmap of the ids keeps nearly all other texts out of the join's shuffle.
    """
    ids = pairs.select(F.explode(F.array("_a", "_b")).alias("_id")).distinct()
    bits = docs.sparkSession.sparkContext.broadcast(id_bitmap(ids))

    def sieve(batches):
        for batch in batches:
            slots = batch.column(2).to_numpy()
            keep = (bits.value[slots >> 3] >> (7 - (slots & 7))) & 1
            yield batch.select(["_id", "_text"]).filter(pa.array(keep.astype(bool)))

    named = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text"), _slot(key).alias("_slot"))
    kind = docs.schema[key].dataType.simpleString()
    return _written(named.mapInArrow(sieve, f"_id {kind}, _text string")
                    .join(ids, "_id", "left_semi"), "neardup-texts")


def confirm(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs ``(_a, _b)`` whose texts are similar enough, written to the scratch folder."""
    both = (pairs.join(texts.toDF("_a", "_ta"), "_a").join(texts.toDF("_b", "_tb"), "_b")
            .select("_a", "_b", "_ta", "_tb"))

    def run(batches):
        for batch in batches:
            good = pa.array(similar(batch.column(2), batch.column(3), words, percent))
            yield batch.select(["_a", "_b"]).filter(good)

    return _written(both.mapInArrow(run, pairs.select("_a", "_b").schema), "neardup-links")


def _ways(links: DataFrame) -> DataFrame:
    return links.select(F.explode(F.array(
        F.struct(F.col("_a").alias("_id"), F.col("_b").alias("_to")),
        F.struct(F.col("_b").alias("_id"), F.col("_a").alias("_to")))).alias("w")).select("w.*")


def connected(links: DataFrame) -> DataFrame:
    """``_id`` and the smallest id reachable (``_component``) for every linked id.

    Each round takes the smallest label among neighbours, then the label of
    that label; every round's labels are written, which cuts the lineage.
    """
    ways = _ways(links)
    labels = _written(ways.groupBy("_id").agg(F.least(F.min("_to"), F.first("_id"))
                                              .alias("_component")), "neardup-labels")
    while True:
        near = (ways.join(labels.select(F.col("_id").alias("_to"), "_component"), "_to")
                .groupBy("_id").agg(F.min("_component").alias("_near")))
        lower = (labels.join(near, "_id")
                 .select("_id", F.col("_component").alias("_old"),
                         F.least("_component", "_near").alias("_new")))
        jump = labels.select(F.col("_id").alias("_new"), F.col("_component").alias("_far"))
        changed = Observation(f"neardup-{uuid.uuid4().hex}")
        labels = _written(
            lower.join(jump, "_new").select("_id", "_old", F.least("_new", "_far").alias("_component"))
            .observe(changed, F.count_if(F.col("_component") != F.col("_old")).alias("n"))
            .drop("_old"), "neardup-labels")
        if not changed.get.get("n"):
            return labels


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _star_pairs(members: DataFrame) -> DataFrame:
    """Each member of a bucket with the bucket's most central member."""
    sizes = members.groupBy("_band").agg(F.count("*").alias("_size"))
    degree = members.join(sizes, "_band").groupBy("_id").agg(F.sum("_size").alias("_degree"))
    hubs = (members.join(degree, "_id").groupBy("_band")
            .agg(F.max(F.struct("_degree", F.xxhash64("_id").alias("_tie"), "_id")).alias("_hub"))
            .select("_band", F.col("_hub._id").alias("_b")))
    return (members.join(hubs, "_band").filter("_id != _b")
            .select(F.col("_id").alias("_a"), "_b").distinct())


def _cross_pairs(members: DataFrame, texts: DataFrame, labels: DataFrame, words: int,
                 percent: int) -> DataFrame:
    """Pairs of different components that may be similar, among members of mixed buckets."""
    spark = members.sparkSession
    placed = (members.join(labels, "_id", "left")
              .withColumn("_component", F.coalesce("_component", "_id")))
    mixed = (placed.groupBy("_band").agg(F.min("_component").alias("_x"),
                                         F.max("_component").alias("_y"))
             .filter("_x != _y").select("_band"))
    open_ = _written(placed.join(mixed, "_band", "left_semi").select("_id", "_component")
                     .distinct(), "neardup-open")
    rows = texts.join(open_, "_id").select("_id", "_component", "_text")
    slot = np.uint64(64 - RARITY_BITS)

    def count(batches):
        seen = np.zeros(1 << RARITY_BITS, dtype=np.int64)
        for batch in batches:
            for _, _, chunk in chunks(batch.column(2), lower=True, limit=SMALL_BYTES):
                seen += np.bincount((shingles(chunk, words)[1] >> slot).astype(np.int64),
                                    minlength=len(seen))
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_pydict({"slot": at.astype(np.int32), "seen": seen[at]})

    def pack(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({
                "slots": [batch.column(0).to_numpy().astype(np.int32).tobytes()],
                "seen": [batch.column(1).to_numpy().astype(np.int64).tobytes()]})

    # One number for each of 2 ** RARITY_BITS counters, whatever the input.
    counted = (rows.mapInArrow(count, "slot int, seen long").groupBy("slot")
               .agg(F.sum("seen").alias("seen"))
               .mapInArrow(pack, "slots binary, seen binary").collect())
    rarity = np.zeros(1 << RARITY_BITS, dtype=np.int64)
    for r in counted:
        rarity[np.frombuffer(bytes(r["slots"]), np.int32)] = np.frombuffer(bytes(r["seen"]), np.int64)
    shared = spark.sparkContext.broadcast(rarity)

    def prefixes(batches):
        for batch in batches:
            for first, _, chunk in chunks(batch.column(2), lower=True, limit=SMALL_BYTES):
                row, value = shingles(chunk, words)
                order = np.lexsort((value, shared.value[(value >> slot).astype(np.int64)], row))
                row, value = row[order], value[order]
                n = np.bincount(row, minlength=chunk.n)
                place = np.arange(len(row)) - (np.cumsum(n) - n)[row]
                keep = place <= n[row] - -(-percent * n[row] // 100)
                row = row[keep]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(value[keep].view(np.int64)), batch.column(0).take(pa.array(first + row)),
                     batch.column(1).take(pa.array(first + row)),
                     pa.array(n[row], pa.int64()), pa.array(place[keep], pa.int64())],
                    ["_key", "_id", "_component", "_n", "_place"])

    kind = texts.schema["_id"].dataType.simpleString()
    prefix = _written(rows.mapInArrow(
        prefixes, f"_key long, _id {kind}, _component {kind}, _n long, _place long"),
        "neardup-prefixes")
    several = (prefix.groupBy("_key").agg(F.min("_component").alias("_x"),
                                          F.max("_component").alias("_y"))
               .filter("_x != _y").select("_key"))
    prefix = prefix.join(several, "_key", "left_semi")
    a, b = (prefix.toDF("_key", *[f"{c}_{side}" for c in prefix.columns[1:]]) for side in "ab")
    need = (F.col("_n_a") + F.col("_n_b")) * percent
    return (a.join(b, (a["_key"] == b["_key"]) & (F.col("_component_a") < F.col("_component_b"))
                   & ((F.col("_n_a") - F.col("_place_a")) * (100 + percent) >= need)
                   & ((F.col("_n_b") - F.col("_place_b")) * (100 + percent) >= need))
            .select(F.col("_id_a").alias("_a"), F.col("_id_b").alias("_b")).distinct())


def components(docs: DataFrame, key: str = "doc_id", text: str = "text",
               words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """``key``, ``n_shingles``, ``component_id`` and ``kept`` of every document."""
    docs_ = docs.select(key, text)
    rows = _written(sketches(docs_, key, text, words), "neardup-sketches")
    solid = rows.filter((F.col("n_shingles") > 0) & F.col("_id").isNotNull())
    same = ["n_shingles", "_s1", "_s2"]
    firsts = solid.groupBy(*same).agg(F.min("_id").alias("_rep"), F.count("*").alias("_rows"))
    # Ids of one shingle set are linked through its smallest id; a large set is spread by salt.
    salted = (firsts.filter("_rows > 1").drop("_rows")
              .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    member = _written(
        solid.select("_id", *same, F.pmod(F.xxhash64("_id"), F.lit(SALTS)).cast("int").alias("_salt"))
        .join(salted, [*same, "_salt"], "left")
        .select("_id", F.coalesce("_rep", "_id").alias("_rep")).distinct(), "neardup-members")
    reps = solid.join(firsts.select(F.col("_rep").alias("_id"), *same), ["_id", *same], "left_semi")
    bands = _written(reps.select("_id", F.explode("_bands").alias("_band")).distinct(),
                     "neardup-bands")
    several = bands.groupBy("_band").agg(F.min("_id").alias("_x"), F.max("_id").alias("_y"))
    members = _written(bands.join(several.filter("_x != _y").select("_band"), "_band", "left_semi"),
                       "neardup-bucket-members")
    stars = _written(_star_pairs(members), "neardup-stars")
    texts = texts_of(stars, docs_, key, text)
    links = confirm(stars, texts, words, percent)
    groups = connected(links)
    cross = _written(_cross_pairs(members, texts, groups, words, percent), "neardup-cross")
    more = confirm(cross, texts, words, percent)
    # An id that stands for several texts ties their representatives.
    several = member.groupBy("_id").agg(F.min("_rep").alias("_b"), F.max("_rep").alias("_last"))
    tied = (member.join(several.filter("_b != _last"), "_id")
            .select(F.col("_rep").alias("_a"), "_b").filter("_a != _b"))
    # What was found last joins whole groups: a much smaller graph.
    between = more.unionByName(tied)
    for side in ("_a", "_b"):
        between = (between.join(groups.toDF(side, "_g"), side, "left")
                   .withColumn(side, F.coalesce("_g", side)).drop("_g"))
    joined = connected(between.filter("_a != _b").distinct())
    labels = (groups.join(joined.toDF("_component", "_whole"), "_component", "left")
              .select("_id", F.coalesce("_whole", "_component").alias("_component")))
    alone = joined.join(groups.select("_id"), "_id", "left_anti")
    labels = labels.unionByName(alone)
    labels = (member.join(labels.withColumnRenamed("_id", "_rep"), "_rep", "left")
              .groupBy("_id").agg(F.min(F.coalesce("_component", "_rep")).alias("_component")))
    found = rows.select("_id", "n_shingles").join(labels, "_id", "left").select(
        F.col("_id").alias(key), "n_shingles",
        F.coalesce("_component", "_id").alias("component_id"))
    return found.withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text",
                words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """One document of each component, with all its columns: the row of smallest id.

    Rows are numbered once; among equal ids the first row stays, a null id is the last.
    """
    rows = _written(docs.select(F.monotonically_increasing_id().alias("_row"),
                                F.struct(*[docs[c] for c in docs.columns]).alias("_doc")),
                    "neardup-rows")
    plain = rows.select("_row", F.col("_doc")[key].alias("_key"), F.col("_doc")[text].alias("_body"))
    label = _written(components(plain, "_row", "_body", words, percent)
                     .select("_row", "component_id"), "neardup-labels")
    # Rows linked with nothing have no part in the choice.
    several = label.filter("_row != component_id").select("component_id").distinct()
    member = label.join(several, "component_id", "left_semi").join(plain.drop("_body"), "_row")
    order = F.struct(F.col("_key").isNull(), "_key", "_row")
    first = member.groupBy("component_id").agg(F.min(order)["_row"].alias("_first"))
    gone = member.join(first, "component_id").filter("_row != _first").select("_row")
    return rows.join(gone, "_row", "left_anti").select("_doc.*")
