"""MinHash near-dedup with tensored banding.

Two small collections of REPEATS hashed minhash pairs are kept per document; table (i, j) is keyed by pair i
of the first collection and pair j of the second. So 2 * REPEATS * 2 minhashes stand for REPEATS^2 tables of
four rows each. A document enters table (i, j) only if both of its halves occur elsewhere, which a small
count of halves tells. A pair of likeness 0.75 is missed by all 144 tables with a chance of about 1 in 10,000.

Steps, all of them joins and aggregates on Spark:
1. documents of equal shingle sets fall into one class (128-bit sum of the set's hashes); one id stands for it;
2. in every bucket each member is held against one member (the hub), and confirmed on the full sets;
3. what is left are buckets with members of several components. There a member can only be linked across
   components by shingles that occur in another component too; members with too few of these go. The rest are
   held against the member with the largest share of such shingles, and at last pairs across components are
   made, each in its first common table and only if sizes and parity bits allow, and confirmed on the full
   sets. This is exact for what the tables hold, without pairs inside the large groups of copies;
4. components by star steps.

A document without words or text (null too) has an empty set and is linked with nothing; one of fewer than
five words has its whole sequence as its one shingle. Repeated rows share an id and so a component. A row
without an id is linked with nothing: its component is null and it is kept. Columns other than the id and the
text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from ._common import map_batches, materialise, plain_text, text_steps
from .components import components

SHINGLE = 5
#: 100 * intersection >= SHARE * union
SHARE = 75
REPEATS = 12
#: Parity bits of a set.
BITS = 1024
#: Times that members of several components in a bucket are held against a new hub before all their pairs are.
HUB_ROUNDS = 1
#: Of the 48 minhashes of two documents of likeness 0.75, 36 agree on average; 18 or fewer with a chance below 1e-8.
LEAST_EQUAL = 19

_rng = np.random.default_rng(20240607)
_FACTORS = _rng.integers(0, 1 << 63, 4 * REPEATS, dtype=np.uint64) * K.U(2) + K.U(1)
_SHIFTS = _rng.integers(0, 1 << 63, 4 * REPEATS, dtype=np.uint64)


def shingle_sets(texts, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of each row, ordered by row."""
    buf = K.lower_ascii(texts.buf)
    starts, ends, rows = K.word_bounds(buf, texts.offs)
    words = K.span_hash(buf, starts, ends)
    hashes = K.window_hash(words, size)
    n = len(hashes)
    inside = rows[:n] == rows[len(rows) - n :] if n else np.empty(0, bool)
    hashes, owner = hashes[inside], rows[:n][inside]
    counts = K.row_counts(rows, texts.n)
    first = np.cumsum(counts) - counts
    for k in range(1, size):
        short = np.flatnonzero(counts == k)
        if len(short):
            hashes = np.r_[hashes, K.mix(K.window_hash(words, k)[first[short]] + K.U(k))]
            owner = np.r_[owner, short]
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return owner[new], hashes[new]


def _lists(values: np.ndarray, width: int, item: pa.DataType) -> pa.Array:
    flat = pa.array(values.reshape(-1), item)
    return pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, width), pa.int32()), flat)


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, sig1, sig2 (sums over the set), low (48 minhashes, 32 bits each), a and b (REPEATS keys each).

    For empty sets sig1 and everything after it is null.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for part, texts in text_steps(batches):
            owner, hashes = shingle_sets(texts)
            counts = K.row_counts(owner, texts.n)
            full = np.flatnonzero(counts)
            first = (np.cumsum(counts) - counts)[full]
            low = np.empty((len(full), 4 * REPEATS), np.uint64)
            sums = [np.empty(0, np.uint64)] * 2
            if len(full):
                sums = [np.add.reduceat(K.mix(hashes ^ K.U(salt)), first) for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
                for f in range(4 * REPEATS):
                    low[:, f] = np.minimum.reduceat((hashes ^ _SHIFTS[f]) * _FACTORS[f], first)
            pairs = K.mix(low[:, 0::2] * K.U(K.BASE[0]) ^ K.mix(low[:, 1::2]))
            tables = [
                pa.array(sums[0].view(np.int64)),
                pa.array(sums[1].view(np.int64)),
                _lists((low >> K.U(32)).astype(np.uint32).view(np.int32), 4 * REPEATS, pa.int32()),
                _lists(np.ascontiguousarray(pairs[:, :REPEATS]).view(np.int64), REPEATS, pa.int64()),
                _lists(np.ascontiguousarray(pairs[:, REPEATS:]).view(np.int64), REPEATS, pa.int64()),
            ]
            at = np.full(texts.n, -1)
            at[full] = np.arange(len(full))
            take = pa.array(at, mask=at < 0)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts), *(t.take(take) for t in tables)], names)

    names = ["doc_id", "n_shingles", "sig1", "sig2", "low", "a", "b"]
    rows = docs.select("doc_id", plain_text().alias("text"))
    return map_batches(rows, run, f"doc_id {id_type}, n_shingles long, sig1 long, sig2 long, low array<int>, a array<long>, b array<long>")


def full_sets(docs: DataFrame) -> DataFrame:
    """doc_id, the whole set of shingle hashes of each row, and its parity bits, for confirming.

    A shingle flips one of BITS bits. Two sets differ in at least as many shingles as bits of theirs differ, so
    bits give an upper bound of the intersection.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for part, texts in text_steps(batches):
            owner, hashes = shingle_sets(texts)
            ends = np.r_[0, np.cumsum(K.row_counts(owner, texts.n))]
            sets = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(hashes.view(np.int64)))
            bits = np.zeros((texts.n, BITS // 64), np.uint64)
            at = (hashes * K.U(K.BASE[1]) >> K.U(32)) % K.U(BITS)
            np.bitwise_xor.at(bits, (owner, (at >> K.U(6)).astype(np.int64)), K.U(1) << (at & K.U(63)))
            yield pa.RecordBatch.from_arrays([part.column(0), sets, _lists(bits.view(np.int64), BITS // 64, pa.int64())], ["doc_id", "shingles", "bits"])

    return map_batches(docs.select("doc_id", plain_text().alias("text")), run, f"doc_id {id_type}, shingles array<long>, bits array<long>")


def _halves(reps: DataFrame, side: str, pos: str) -> DataFrame:
    """(rep, position, key) of the halves that two or more documents have."""
    rows = reps.select("rep", F.posexplode(side).alias(pos, side))
    often = rows.groupBy(pos, side).agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    return rows.join(often, [pos, side])


def _confirmed(pairs: DataFrame, reps: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are alike enough: first by minhashes, then by full sets."""
    low = reps.select("rep", "low", "n_shingles")
    close = (
        pairs.join(low.toDF("a", "low_a", "n_a"), "a")
        .join(low.toDF("b", "low_b", "n_b"), "b")
        .filter(f"100 * least(n_a, n_b) >= {SHARE} * greatest(n_a, n_b)")
        .filter(f"size(filter(zip_with(low_a, low_b, (x, y) -> x = y), e -> e)) >= {LEAST_EQUAL}")
        .select("a", "b")
    )
    shared = F.size(F.array_intersect("set_a", "set_b"))
    return (
        close.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a")), "a")
        .join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b")), "b")
        .filter(100 * shared >= SHARE * (F.size("set_a") + F.size("set_b") - shared))
        .select("a", "b")
    )


def near_dedup(docs: DataFrame) -> DataFrame:
    """Per row of docs(doc_id, text): doc_id, n_shingles, component_id, kept (doc_id = component_id)."""
    sigs = materialise(signatures(docs))
    # written first, so that Spark can split the rows of a large class in the joins with it
    classes = materialise(sigs.filter("sig1 is not null").groupBy("sig1", "sig2").agg(F.min("doc_id").alias("rep")))
    member = sigs.select("doc_id", "sig1", "sig2").join(classes, ["sig1", "sig2"]).select("doc_id", "rep")
    reps = materialise(
        sigs.filter("sig1 is not null")
        .join(classes, ["sig1", "sig2"])
        .filter("doc_id = rep")
        .select("rep", "n_shingles", "low", "a", "b", "sig1", "sig2")
        .dropDuplicates(["rep", "sig1", "sig2"])
    )
    # an id with rows of several sets joins these sets
    several = sigs.filter("sig1 is not null").groupBy("doc_id").agg(F.min("sig1").alias("x"), F.max("sig1").alias("y")).filter("x <> y").select("doc_id")
    tied = member.join(several, "doc_id").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))

    keyed = _halves(reps, "a", "i").join(_halves(reps, "b", "j"), "rep").select("rep", "i", "j", F.xxhash64("i", "j", "a", "b").alias("key"))
    counted = keyed.groupBy("key").agg(F.min("rep").alias("hub"), F.max("rep").alias("last")).filter("hub < last").select("key", "hub")
    buckets = materialise(keyed.join(counted, "key").select("key", "i", "j", "rep", "hub"))

    wanted = buckets.select("rep").distinct()
    sets = materialise(full_sets(docs.join(wanted.withColumnRenamed("rep", "doc_id"), "doc_id", "left_semi")).dropDuplicates(["doc_id", "shingles"]))
    stars = buckets.filter("rep <> hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
    links = materialise(_confirmed(stars, reps, sets).union(tied))
    found = materialise(components(links))

    # buckets whose members are in several components: further hubs, then all pairs that are left
    for last in [False] * HUB_ROUNDS + [True]:
        live = _live(buckets, found, reps, sets)
        more = materialise(_confirmed(_pairs(live, hubs_only=not last), reps, sets))
        if not more.isEmpty():
            links = materialise(links.union(more))
            found = materialise(components(links))

    placed = member.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("doc_id", F.coalesce("component", "rep").alias("component_id"))
    by_id = placed.groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    return sigs.select("doc_id", "n_shingles").join(by_id, "doc_id", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component_id", "doc_id"), F.lit(True)).alias("kept"),
    )


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of docs, all columns as they are, of the smallest id of each component; of rows that share an id, one of each text.

    Rows whose id is null are kept, one of each text.
    """
    gone = near_dedup(docs.filter("doc_id is not null")).filter("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    left = docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
    return left.dropDuplicates(["doc_id", "text"])


def _live(buckets: DataFrame, found: DataFrame, reps: DataFrame, sets: DataFrame) -> DataFrame:
    """(key, rep, comp, n_shingles, most) of bucket members that could be alike with one of another component.

    If c of a document's n shingles occur in other components, its likeness to a document of m shingles there
    is at most c / (n + m - c); so m can be at most c * (100 + SHARE) / SHARE - n, here called most.
    """
    placed = buckets.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("key", "i", "j", "rep", F.coalesce("component", "rep").alias("comp"))
    mixed = placed.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x < y").select("key")
    rest = materialise(placed.join(mixed, "key", "left_semi").join(reps.select("rep", "n_shingles"), "rep"))
    node = rest.select("rep", "comp", "n_shingles").distinct()
    rows = sets.join(node.select(F.col("rep").alias("doc_id"), "comp"), "doc_id").select(F.col("doc_id").alias("rep"), "comp", F.explode("shingles").alias("h"))
    abroad = rows.groupBy("h").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x < y").select("h")
    reach = rows.join(abroad, "h").groupBy("rep").agg(F.count("*").alias("c"))
    most = materialise(
        node.join(reach, "rep")
        .withColumn("most", F.floor((F.col("c") * (100 + SHARE) - F.col("n_shingles") * SHARE) / SHARE))
        .filter(f"100 * most >= {SHARE} * n_shingles")
        .join(reps.select("rep", "a", "b"), "rep")
        .join(sets.select(F.col("doc_id").alias("rep"), "bits"), "rep")
        .select("rep", "most", "a", "b", "bits")
        .dropDuplicates(["rep"])
    )
    live = rest.join(most, "rep")
    least = live.groupBy("key").agg(F.min("n_shingles").alias("least"), F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x < y").select("key", "least")
    return materialise(live.join(least, "key").filter("most >= least").drop("least"))


def _pairs(live: DataFrame, hubs_only: bool) -> DataFrame:
    """Pairs (a, b) of one bucket and two components; with hubs_only those with the member that most others could be like.

    A pair is made in its first common table only: the first equal half of either collection. Sizes and parity bits
    rule out, within the join, pairs that can't be alike enough.
    """
    side = lambda x: live.select("key", "i", "j", F.struct("rep", "comp", "n_shingles", "most", "a", "b", "bits").alias(x))
    x, y = side("x"), side("y").drop("i", "j")
    if hubs_only:
        central = F.struct((F.col("y.most") / F.col("y.n_shingles")).alias("share"), (-F.col("y.rep")).alias("first"))
        y = y.groupBy("key").agg(F.max_by("y", central).alias("y"))
        fits = "x.comp <> y.comp"
    else:
        first = " and ".join(f"not exists(zip_with(slice(x.{c}, 1, {at}), slice(y.{c}, 1, {at}), (p, q) -> p = q), e -> e)" for c, at in (("a", "i"), ("b", "j")))
        fits = f"x.comp < y.comp and {first}"
    sizes = f"x.n_shingles <= y.most and y.n_shingles <= x.most and 100 * least(x.n_shingles, y.n_shingles) >= {SHARE} * greatest(x.n_shingles, y.n_shingles)"
    # with d differing bits, the intersection is at most (n + m - d) / 2
    differ = "aggregate(zip_with(x.bits, y.bits, (p, q) -> bit_count(p ^ q)), 0, (s, e) -> s + e)"
    bits = f"{100 + SHARE} * (x.n_shingles + y.n_shingles - {differ}) >= {2 * SHARE} * (x.n_shingles + y.n_shingles)"
    pairs = x.alias("l").join(y.alias("r"), F.expr(f"l.key = r.key and {fits} and {sizes} and {bits}"))
    return pairs.select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b")).distinct()


ORACLE_SQL = """
WITH words AS (
  SELECT doc_id, regexp_extract_all(lower_az, '[^\\x20\\x09-\\x0D]+') AS w
  FROM (SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_az FROM documents)
), sets AS (
  SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN []::VARCHAR[]
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words
), items AS (
  SELECT doc_id, len(s) AS n, hash(unnest(s)) AS h FROM sets
), pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM items x JOIN items y ON x.h = y.h AND x.doc_id < y.doc_id
  GROUP BY x.doc_id, y.doc_id, x.n, y.n
  HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))
), links AS (
  SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs
), reach AS (
  WITH RECURSIVE r(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT r.doc_id, l.b FROM r JOIN links l ON r.other = l.a
  )
  SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id
)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, r.component_id, s.doc_id = r.component_id AS kept
FROM sets s JOIN reach r USING (doc_id)
"""
