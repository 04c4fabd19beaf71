"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A paragraph is a non-blank line; a document is the set of its paragraphs'
64-bit digests. Each digest goes to one cell in each of three sub-tables; a
cell holds a count and the exclusive-or of its digests and of their checks.
Two sketches of the same size subtract cell by cell, and peeling cells that
hold a single digest recovers exactly the digests that differ. Where peeling
stops early, the sets are split sixteen ways by further hash digits and each
part gets a sketch of its own, so every retry is sixteen times larger, until
all is recovered. Only DataFrame functions are used.

Defined cases: a null text counts as empty; an empty text has the sketch of
the empty set, and two empty sets have likeness 1; equal texts have equal
fingerprints; the next document is by ascending id, a null id first, rows of
one id by a hash of their text, and after the last comes the first; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brightlake.session import scratch_path

SUB_TABLES = 3
SUB_CELLS = 12
CELLS = SUB_TABLES * SUB_CELLS
ROUNDS = 12
#: Parts that a retry splits a failed sketch into.
SPLIT = 16
#: Documents that one window orders, about.
RANGE_ROWS = 4096
MAX_RANGES = 4096


def paragraph_digests(text: Column) -> Column:
    """Distinct 64-bit digests of the non-blank lines."""
    lines = F.filter(F.split(text, r"\s*\n\s*"), lambda x: F.length(F.trim(x)) > 0)
    return F.array_distinct(F.transform(lines, lambda x: F.xxhash64(F.trim(x))))


def _entry(digest: Column, count: Column) -> Column:
    places = [(F.pmod(F.xxhash64(digest, F.lit(j)), F.lit(SUB_CELLS)) + j * SUB_CELLS)
              .cast("int").alias(f"p{j}") for j in range(SUB_TABLES)]
    return F.struct(count.cast("int").alias("n"), digest.alias("k"),
                    _check(digest).alias("c"), *places)


def _check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit("check")).bitwiseAND(F.lit(0xFFFFFFFF))


def _in_cell(entry: Column, cell: Column) -> Column:
    found = entry["p0"] == cell
    for j in range(1, SUB_TABLES):
        found = found | (entry[f"p{j}"] == cell)
    return found


def _joined(cell: Column, entries: Column, sign: int) -> Column:
    """The cell with all entries added (or taken away)."""
    return F.aggregate(entries, cell, lambda a, e: F.struct(
        (a["n"] + F.lit(sign) * e["n"]).alias("n"), a["k"].bitwiseXOR(e["k"]).alias("k"),
        a["c"].bitwiseXOR(e["c"]).alias("c")))


def sketch(digests: Column) -> Column:
    """The cells of a set of digests: ``array<struct<n, k, c>>``."""
    empty = F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("k"),
                     F.lit(0).cast("long").alias("c"))
    entries = F.transform(digests, lambda d: _entry(d, F.lit(1)))
    return F.transform(F.array(entries), lambda all_: F.transform(
        F.sequence(F.lit(0), F.lit(CELLS - 1)),
        lambda i: _joined(empty, F.filter(all_, lambda e: _in_cell(e, i)), 1)))[0]


def subtract(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, lambda a, b: F.struct(
        (a["n"] - b["n"]).alias("n"), a["k"].bitwiseXOR(b["k"]).alias("k"),
        a["c"].bitwiseXOR(b["c"]).alias("c")))


def _single(cells: Column) -> Column:
    """Distinct entries of the cells that hold one digest."""
    alone = F.filter(cells, lambda x: (F.abs(x["n"]) == 1) & (x["c"] == _check(x["k"])))
    return F.array_distinct(F.transform(alone, lambda x: _entry(x["k"], x["n"])))


def peel(difference: Column) -> Column:
    """``struct<found: array<long>, done: boolean>``: the digests that differ.

    ``done`` says that every cell came out empty, so that ``found`` is complete.
    """
    def state(cells, found):
        return F.transform(F.array(cells), lambda c: F.struct(
            c.alias("cells"), _single(c).alias("single"), found.alias("found")))[0]

    def turn(s, _):
        emptied = F.transform(s["cells"], lambda x, i: _joined(
            x, F.filter(s["single"], lambda e: _in_cell(e, i)), -1))
        found = F.concat(s["found"], F.transform(s["single"], lambda e: e["k"]))
        return F.when(F.size(s["single"]) == 0, s).otherwise(state(emptied, found))

    end = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)),
                      state(difference, F.array().cast("array<bigint>")), turn)
    return F.transform(F.array(end), lambda s: F.struct(
        s["found"].alias("found"),
        F.forall(s["cells"], lambda x: (x["n"] == 0) & (x["k"] == 0)).alias("done")))[0]


def as_text(cells: Column) -> Column:
    """A sketch as base64: 2 bytes of count, 8 of digests, 4 of checks a cell."""
    one = F.transform(cells, lambda x: F.concat(
        F.lpad(F.hex(F.pmod(x["n"], F.lit(65536)).cast("long")), 4, "0"),
        F.lpad(F.hex(x["k"]), 16, "0"), F.lpad(F.hex(x["c"]), 8, "0")))
    return F.base64(F.unhex(F.array_join(one, "")))


def likeness(n_left: Column, n_right: Column, n_differ: Column) -> Column:
    """Shared over all digests of two sets, from their sizes and their difference."""
    both = n_left + n_right
    return F.when(both == 0, F.lit(1.0)).otherwise((both - n_differ) / (both + n_differ))


def recover(pairs: DataFrame, key: str, left: str = "left", right: str = "right") -> DataFrame:
    """``key`` and the number of differing digests (``differ``) of two digest sets a row.

    Rows whose sketch does not peel are split and retried until every part does.
    """
    spark = pairs.sparkSession
    level, done = 0, None
    todo = pairs.select(key, F.col(left).alias("_l"), F.col(right).alias("_r"))
    while True:
        path = scratch_path(spark, f"fingerprint-retry{level}")
        digit = lambda d: F.pmod(F.xxhash64(d, F.lit(f"level {level}")), F.lit(SPLIT))  # noqa: E731,B023
        (todo.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SPLIT - 1))))
         .select(key, *[F.filter(c, lambda d: digit(d) == F.col("_part")).alias(c)
                        for c in ("_l", "_r")])
         .withColumn("_peeled", peel(subtract(sketch(F.col("_l")), sketch(F.col("_r")))))
         .select(key, F.when(~F.col("_peeled.done"), F.col("_l")).alias("_l"),
                 F.when(~F.col("_peeled.done"), F.col("_r")).alias("_r"),
                 F.when(F.col("_peeled.done"), F.size("_peeled.found")).alias("differ"))
         .write.parquet(path))
        tried = spark.read.parquet(path)
        part = tried.filter(F.col("differ").isNotNull()).select(key, "differ")
        done = part if done is None else done.unionAll(part)
        todo = tried.filter(F.col("differ").isNull()).select(key, "_l", "_r")
        if todo.isEmpty():
            return done.groupBy(key).agg(F.sum("differ").alias("differ"))
        level += 1


def with_next(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``_key``, ``_text`` and the text of the next document by id (``_next``).

    Ids are cut into ranges by quantiles; a window orders each range, and the
    last row of a range takes the first row of the following one.
    """
    base = docs.select(F.col(key).alias("_key"), F.coalesce(text, F.lit("")).alias("_text"))
    rows = base.count()
    n = max(1, min(-(-rows // RANGE_ROWS), MAX_RANGES))
    cuts = base.select(F.col("_key").cast("double").alias("k")).approxQuantile(
        "k", [i / n for i in range(1, n)], 0.1 / n) if n > 1 else []
    bounds = F.array(*[F.lit(x) for x in sorted(set(cuts))]).cast("array<double>")
    place = F.when(F.col("_key").isNull(), 0).otherwise(
        F.size(F.filter(bounds, lambda b: b <= F.col("_key"))))
    base = base.withColumn("_range", place).withColumn("_tie", F.xxhash64("_text"))
    order = [F.col("_key").asc_nulls_first(), F.col("_tie")]
    # Ids and texts of the first row of each range; there are few.
    first = (base.groupBy("_range").agg(F.min(F.struct("_key", "_tie")).alias("f"))
             .select("_range", "f._key", "f._tie"))
    ring = Window.orderBy("_range")
    before = (first.withColumn("_to", F.lag("_range").over(ring))
              .withColumn("_to", F.coalesce("_to", F.max("_range").over(
                  ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
              .select("_to", F.col("_key").alias("_k"), F.col("_tie").alias("_t")))
    texts = (base.join(F.broadcast(before),  # one row a range, MAX_RANGES at most
                       F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_tie") == F.col("_t")))
             .groupBy(F.col("_to").alias("_range")).agg(F.first("_text").alias("_first")))
    inside = Window.partitionBy("_range").orderBy(*order)
    return (base.withColumn("_next", F.lead("_text").over(inside))
            .join(texts, "_range")
            .select("_key", "_text", F.coalesce("_next", "_first").alias("_next")))


def fingerprint(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, the sketch as text and the number of paragraphs of every document."""
    digests = paragraph_digests(F.coalesce(F.col(text), F.lit("")))
    return (docs.select(key, digests.alias("_d"))
            .select(key, as_text(sketch(F.col("_d"))).alias("fingerprint"),
                    F.size("_d").alias("n_paragraphs")))


def compare_versions(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited version, and their likeness.

    The edited version has the last half of the code points replaced by the
    beginning of the next document.
    """
    spark = docs.sparkSession
    half = F.floor(F.length("_text") / 2).cast("int")
    edited = F.concat(F.substring(F.col("_text"), F.lit(1), F.length("_text") - half),
                      F.substring(F.col("_next"), F.lit(1), half))
    sets = (with_next(docs, key, text)
            .select("_key", F.length("_text").cast("long").alias("n_chars"),
                    F.col("_text"), edited.alias("_edited"), F.col("_next"))
            .select("_key", "n_chars", F.sha2("_edited", 256).alias("edited_sha256"),
                    *[paragraph_digests(F.col(c)).alias(a) for c, a in
                      (("_text", "_a"), ("_edited", "_b"), ("_next", "_c"))]))
    sketched = sets.select("*", *[sketch(F.col(f"_{x}")).alias(f"_s{x}") for x in "abc"])
    peeled = sketched.select("*", peel(subtract(F.col("_sa"), F.col("_sb"))).alias("_pb"),
                             peel(subtract(F.col("_sa"), F.col("_sc"))).alias("_pc"))
    path = scratch_path(spark, "fingerprint-sketches")
    (peeled.select(
        "_key", "n_chars", "edited_sha256", as_text(F.col("_sa")).alias("fingerprint"),
        as_text(F.col("_sb")).alias("edited_fingerprint"),
        *[F.size(f"_{x}").alias(f"_n{x}") for x in "abc"],
        *[F.when(F.col(f"_p{x}.done"), F.size(f"_p{x}.found")).alias(f"_d{x}") for x in "bc"],
        F.when(~(F.col("_pb.done") & F.col("_pc.done")), F.col("_a")).alias("_a"),
        F.when(~F.col("_pb.done"), F.col("_b")).alias("_b"),
        F.when(~F.col("_pc.done"), F.col("_c")).alias("_c"),
        F.monotonically_increasing_id().alias("_row"))
     .write.option("compression", "zstd").parquet(path))
    tried = spark.read.parquet(path)
    again = [tried.filter(F.col(f"_{x}").isNotNull())
             .select(F.struct("_row", F.lit(x).alias("x")).alias("_pair"),
                     F.col("_a").alias("left"), F.col(f"_{x}").alias("right")) for x in "bc"]
    more = recover(again[0].unionAll(again[1]), "_pair")
    more = more.groupBy(F.col("_pair._row").alias("_row")).agg(*[
        F.max(F.when(F.col("_pair.x") == x, F.col("differ"))).alias(f"_m{x}") for x in "bc"])
    def likenesses(rows, late):
        near = {x: likeness(F.col("_na"), F.col(f"_n{x}"), F.coalesce(f"_d{x}", late(x)))
                for x in "bc"}
        return rows.select(F.col("_key").alias(key), "n_chars", "edited_sha256", "fingerprint",
                           "edited_fingerprint", near["b"].alias("near_edited"),
                           near["c"].alias("near_next"), F.col("_na").alias("n_paragraphs"))

    # Only rows that were retried are joined with what the retries found.
    first = likenesses(tried.filter(F.col("_a").isNull()), lambda x: F.lit(None).cast("long"))
    retried = tried.filter(F.col("_a").isNotNull()).join(more, "_row")
    return first.unionByName(likenesses(retried, lambda x: F.col(f"_m{x}")))
