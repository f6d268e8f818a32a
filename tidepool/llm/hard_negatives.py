"""Hard-negative mining through a pivot table.

Scores are inner products of whole-number vectors. With M the longest row, a row y becomes (y, sqrt(M^2 - |y|^2)) and
an anchor q becomes (q, 0); then |q - y|^2 = |q|^2 + M^2 - 2 score, so the highest scores are the shortest distances.
Each row's distances to PIVOTS pivots are stored. For any pivot p the triangle inequality gives
|d(q,p) - d(y,p)| <= d(q,y) <= d(q,p) + d(y,p), hence an upper and a lower bracket of the score. Pairs whose brackets
can't reach what is already found, or can't meet a wanted range of scores, are dropped; all others are checked exactly.

1. Pivots are chosen, each far from those before, from SAMPLE rows; every row is indexed.
2. Rows are dealt over groups, sorted by nearest pivot and packed into blocks of BLOCK_ROWS with close distances, so
   that a block's range of distances drops it for an anchor as a whole. Equal vectors fill blocks like others.
3. Blocks of rows and of anchors meet as parts: a task reads one part of each (about PART_ROWS rows and PART_ANCHORS
   anchors at most), so no anchors are copied per group, sent to the driver or broadcast, and an anchor has as many
   intermediate results as there are parts of rows. A task holds one block of rows, its part of the anchors and the
   best found so far.
4. First the best rows of the same label, then, within the ranges that these set, the best of other labels; tasks
   keep the best per anchor and a window takes the best of these.

Rows with a null id, label or vector, or a component that is null or not finite, take no part. A shorter vector counts
as one with zeros behind. "Other rows" are those of another id. Repeated rows are rows of their own: repeated
candidates take a rank each, a repeated anchor is answered as often. A positive of score 0 takes negatives of score 0,
one below 0 takes none. Scores beyond 64 bits are taken as the nearest 64-bit number. No rows or no anchors give an
empty result. Only the three named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import discard, map_batches, materialise, n_partitions

PIVOTS = 12
#: Bound of the rows that pivots are chosen from.
SAMPLE = 2_000
GROUP_ROWS, BLOCK_ROWS, BLOCK_ANCHORS = 100_000, 2_048, 256
#: Bounds of the rows and anchors that a task of the search reads; the fewest anchors that make a part of their own.
PART_ROWS, PART_ANCHORS, LEAST_ANCHORS = 1_000_000, 4_096, 16
#: Bound of rounding errors of brackets, as a share of the squared lengths.
SLACK = 1e-9
LONG = np.iinfo(np.int64)
EXACT = float(1 << 53)


def vectors(column: pa.Array, size: int) -> np.ndarray:
    """floor(256 x) of list values, as rows of `size` doubles with zeros behind shorter ones."""
    flat = np.floor(256.0 * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    sizes = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    out = np.zeros((len(column), size))
    row = np.repeat(np.arange(len(column)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def choose_pivots(rows: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """Up to n different rows, each the farthest from those before it."""
    if not len(rows):
        return rows
    chosen = [int(np.argmax((rows**2).sum(axis=1)))]
    away = ((rows - rows[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < n and away.max() > 0:
        chosen.append(int(np.argmax(away)))
        away = np.minimum(away, ((rows - rows[chosen[-1]]) ** 2).sum(axis=1))
    return rows[chosen]


def row_distances(rows: np.ndarray, pivots: np.ndarray, longest: float) -> np.ndarray:
    """Distances of augmented rows to augmented pivots."""
    norm, p_norm = (rows**2).sum(axis=1), (pivots**2).sum(axis=1)
    last, p_last = np.sqrt(np.maximum(longest - norm, 0)), np.sqrt(np.maximum(longest - p_norm, 0))
    return np.stack([np.sqrt(((rows - p) ** 2).sum(axis=1) + (last - e) ** 2) for p, e in zip(pivots, p_last)], axis=1)


def anchor_distances(anchors: np.ndarray, pivots: np.ndarray, longest: float) -> np.ndarray:
    """Distances of anchors, augmented by 0, to augmented pivots."""
    p_last = np.maximum(longest - (pivots**2).sum(axis=1), 0)
    return np.stack([np.sqrt(((anchors - p) ** 2).sum(axis=1) + e) for p, e in zip(pivots, p_last)], axis=1)


def brackets(anchor_norm: np.ndarray, anchor_away: np.ndarray, away: np.ndarray, longest: float) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper brackets of the scores of anchors (rows) and table rows (columns)."""
    near = np.zeros((len(anchor_away), len(away)))
    far = np.full_like(near, np.inf)
    for p in range(away.shape[1]):
        near = np.maximum(near, np.abs(anchor_away[:, p, None] - away[None, :, p]))
        far = np.minimum(far, anchor_away[:, p, None] + away[None, :, p])
    whole = anchor_norm[:, None] + longest
    slack = SLACK * (whole + 1)
    return (whole - far**2) / 2 - slack, (whole - near**2) / 2 + slack


def scores(anchors: np.ndarray, rows: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Inner products where wanted, exact; elsewhere any number."""
    if np.sqrt((anchors**2).sum(axis=1).max(initial=0) * (rows**2).sum(axis=1).max(initial=0)) < EXACT:
        if wanted.mean() > 1 / 8:
            return anchors @ rows.T
        out = np.zeros(wanted.shape)
        i, j = np.nonzero(wanted)
        for at in range(0, len(i), 1 << 14):
            a, b = i[at : at + (1 << 14)], j[at : at + (1 << 14)]
            out[a, b] = np.einsum("ij,ij->i", anchors[a], rows[b])
        return out
    out = np.zeros(wanted.shape, object)
    for i, j in zip(*np.nonzero(wanted)):
        out[i, j] = sum(int(x) * int(y) for x, y in zip(anchors[i], rows[j]))
    return out


def best(score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores, ties by the smaller id."""
    if len(score) > k:
        keep = score >= np.sort(score)[-k]
        score, ids = score[keep], ids[keep]
    order = np.lexsort((ids, -score))[:k] if score.dtype != object else np.array(sorted(range(len(score)), key=lambda i: (-score[i], ids[i]))[:k], int)
    return score[order], ids[order]


class Block:
    """Packed rows or anchors: ids, labels, whole-number vectors, distances to pivots."""

    def __init__(self, n: int, ids: bytes, labels: bytes, vecs: bytes, away: bytes):
        self.n = n
        self.ids, self.labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
        narrow = np.frombuffer(vecs[1:], np.int16 if vecs[:1] == b"s" else np.float64)
        self.vecs = narrow.astype(np.float64).reshape(n, -1)
        self.away = np.frombuffer(away, np.float64).reshape(n, -1)
        self.norm = (self.vecs**2).sum(axis=1)

    @staticmethod
    def packed(vecs: np.ndarray) -> bytes:
        return b"s" + vecs.astype(np.int16).tobytes() if np.abs(vecs).max(initial=0) < 1 << 15 else b"d" + vecs.tobytes()


def nearest_of_label(anchors: Block, rows: Block, longest: float, k: int, found: list) -> None:
    """Bring found[anchor] = (scores, ids), the k best rows of the anchor's label, up to date with these rows."""
    whole = anchors.norm + longest
    apart = np.maximum(np.maximum(rows.away.min(axis=0) - anchors.away, anchors.away - rows.away.max(axis=0)), 0).max(axis=1)
    reach = (whole - apart**2) / 2 + SLACK * (whole + 1)
    least = np.array([float(s[-1]) if len(s) == k else -np.inf for s, _ in found])
    open_ = ~(reach < least)
    for label in np.unique(anchors.labels[open_]):
        a, r = np.flatnonzero(open_ & (anchors.labels == label)), np.flatnonzero(rows.labels == label)
        if not len(r):
            continue
        low, high = brackets(anchors.norm[a], anchors.away[a], rows.away[r], longest)
        other = anchors.ids[a][:, None] != rows.ids[r][None, :]
        enough = least[a]
        if len(r) > k:  # the k-th highest lower bracket is a score that k rows reach
            enough = np.maximum(enough, np.partition(np.where(other, low, -np.inf), -k, axis=1)[:, -k])
        left = other & ~(high < enough[:, None])
        exact = scores(anchors.vecs[a], rows.vecs[r], left)
        for i, at in enumerate(a):
            s, ids = found[at]
            found[at] = best(np.r_[s, exact[i, left[i]]], np.r_[ids, rows.ids[r[left[i]]]], k)


def negatives_in_ranges(anchors: Block, rows: Block, longest: float, k: int, ranges: list, found: list) -> None:
    """Bring found[anchor][range], the k best rows of other labels with a score in the range, up to date with these rows."""
    whole = anchors.norm + longest
    lowest = np.array([min((max(lo, s[-1] if len(s) == k else lo) for (lo, _), (s, _) in zip(r, f)), default=np.inf) for r, f in zip(ranges, found)], float)
    highest = np.array([max((hi for _, hi in r), default=-np.inf) for r in ranges], float)
    apart = np.maximum(np.maximum(rows.away.min(axis=0) - anchors.away, anchors.away - rows.away.max(axis=0)), 0).max(axis=1)
    far = (anchors.away + rows.away.max(axis=0)).min(axis=1)
    slack = SLACK * (whole + 1)
    a = np.flatnonzero(~((whole - apart**2) / 2 + slack < lowest) & ~((whole - far**2) / 2 - slack > highest))
    if not len(a):
        return
    low, high = brackets(anchors.norm[a], anchors.away[a], rows.away, longest)
    left = (anchors.labels[a][:, None] != rows.labels[None, :]) & ~(high < lowest[a][:, None]) & ~(low > highest[a][:, None])
    exact = scores(anchors.vecs[a], rows.vecs, left)
    for i, at in enumerate(a):
        s, ids = exact[i, left[i]], rows.ids[left[i]]
        for j, (lo, hi) in enumerate(ranges[at]):
            inside = (s >= lo) & (s <= hi)
            if inside.any():
                f = found[at][j]
                found[at][j] = best(np.r_[f[0], s[inside]], np.r_[f[1], ids[inside]], k)


NOTHING = (np.empty(0), np.empty(0, np.int64))
BLOCK = "n int, ids binary, labels binary, vecs binary, away binary"


def _pack(rows: DataFrame, n: int, extra: tuple[str, ...] = ()) -> DataFrame:
    """Successive rows of a partition as blocks of up to n; extra columns become lists."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def run(batches):
        held: list[pa.RecordBatch] = []
        names = ["n", "ids", "labels", "vecs", "away", *extra]

        def block():
            t = pa.Table.from_batches(held)
            vec = np.frombuffer(b"".join(t.column("vec").to_pylist()), np.float64).reshape(t.num_rows, -1)
            values = [
                t.num_rows,
                t.column("vec_id").to_numpy().astype(np.int64).tobytes(),
                t.column("label").to_numpy().astype(np.int64).tobytes(),
                Block.packed(vec),
                b"".join(t.column("away").to_pylist()),
                *(t.column(k).to_pylist() for k in extra),
            ]
            held.clear()
            return pa.RecordBatch.from_pylist([dict(zip(names, values))], schema=kind)

        kind = None
        for batch in batches:
            if kind is None:
                lists = [pa.field(k, pa.list_(batch.schema.field(k).type)) for k in extra]
                kind = pa.schema([("n", pa.int32()), *((k, pa.binary()) for k in ("ids", "labels", "vecs", "away")), *lists])
            start = 0
            while start < batch.num_rows:
                step = min(batch.num_rows - start, n - sum(b.num_rows for b in held))
                held.append(batch.slice(start, step))
                start += step
                if sum(b.num_rows for b in held) == n:
                    yield block()
        if held:
            yield block()

    return map_batches(rows, run, ", ".join([BLOCK, *(f"{k} array<{kinds[k]}>" for k in extra)]))


def _packed_anchors(anchors: DataFrame, n: int, row_parts: int, extra: tuple[str, ...] = ("keys",)) -> DataFrame:
    """n anchors as blocks, in as many parts as bounds ask for, or more where the tasks would be too few for the cores."""
    spread = -(-3 * anchors.sparkSession.sparkContext.defaultParallelism // row_parts)
    parts = max(1, -(-n // PART_ANCHORS), min(spread, -(-n // LEAST_ANCHORS)))
    return _pack(anchors.repartition(parts).sortWithinPartitions("cell", "close", "vec_id"), BLOCK_ANCHORS, extra)


def _pairs_of_blocks(anchors: DataFrame, rows: DataFrame, row_parts: int) -> DataFrame:
    """Every block of anchors beside every block of rows, a task per pair of parts.

    The hint has both sides read where the tasks run: without it Spark would take the anchors for small, as their
    blocks are larger than they look to it, and send them all through the driver.
    """
    asked = anchors.select(*(F.col(k).alias(f"q_{k}") for k in anchors.columns))
    return rows.coalesce(row_parts).crossJoin(asked.hint("shuffle_replicate_nl"))


def _search(pairs: DataFrame, longest: float, start, update, schema: str) -> DataFrame:
    """Run update(state, anchors, rows) over pairs of blocks; start(record, anchors) makes a state, whose rows() go out."""

    def run(batches):
        states: dict[int, _Positives | _Negatives] = {}
        ids = vecs = rows = None
        for batch in batches:
            for record in batch.to_pylist():
                key = record["q_keys"][0]
                if key not in states:
                    states[key] = start(record, Block(*(record[f"q_{k}"] for k in ("n", "ids", "labels", "vecs", "away"))))
                if record["ids"] != ids or record["vecs"] != vecs:  # a block of rows meets all anchors of a part in turn
                    ids, vecs, rows = record["ids"], record["vecs"], Block(*(record[k] for k in ("n", "ids", "labels", "vecs", "away")))
                update(states[key], rows, longest)
        for state in states.values():
            yield from state.rows()

    return map_batches(pairs, run, schema)


class _Positives:
    def __init__(self, record: dict, anchors: Block, k: int):
        self.keys, self.anchors, self.k = record["q_keys"], anchors, k
        self.found = [NOTHING] * anchors.n

    def add(self, rows: Block, longest: float) -> None:
        nearest_of_label(self.anchors, rows, longest, self.k, self.found)

    def rows(self):
        n = [len(s) for s, _ in self.found]
        if sum(n):
            keys = np.repeat(np.array(self.keys, np.int64), n)
            yield pa.RecordBatch.from_arrays([pa.array(keys), *_columns(self.found)], ["key", "vec_id", "score"])


class _Negatives:
    def __init__(self, record: dict, anchors: Block, k: int, percents: tuple[int, int]):
        self.keys, self.anchors, self.k = record["q_keys"], anchors, k
        self.ranges, self.places = [], []
        for positives in record["q_positives"]:
            wanted = {}
            for p in positives:  # one search per different score
                low, high = -(-percents[0] * p // 100), percents[1] * p // 100
                if low <= high:
                    wanted[p] = (low, high)
            self.places.append(list(wanted))
            self.ranges.append(list(wanted.values()))
        self.found = [[NOTHING] * len(r) for r in self.ranges]

    def add(self, rows: Block, longest: float) -> None:
        negatives_in_ranges(self.anchors, rows, longest, self.k, self.ranges, self.found)

    def rows(self):
        flat = [(key, p, f) for key, places, fs in zip(self.keys, self.places, self.found) for p, f in zip(places, fs) if len(f[0])]
        if flat:
            n = [len(f[0]) for _, _, f in flat]
            key, score = np.repeat(np.array([x[0] for x in flat], np.int64), n), np.repeat(np.array([x[1] for x in flat], np.int64), n)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(score), *_columns([f for _, _, f in flat])], ["key", "positive_score", "negative_id", "negative_score"])


def _columns(found: list) -> list[pa.Array]:
    ids = np.concatenate([i for _, i in found])
    s = [min(max(int(x), LONG.min), LONG.max) for f, _ in found for x in f]
    return [pa.array(ids, pa.int64()), pa.array(s, pa.int64())]


def mine_hard_negatives(
    rows: DataFrame,
    *,
    is_anchor: str = "vec_id % 100 = 0",
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    n_positives: int = 5,
    n_negatives: int = 10,
    percents: tuple[int, int] = (30, 90),
) -> DataFrame:
    """Per anchor, positive and rank: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    rows hold an id, a vector and a label; is_anchor is SQL over vec_id. A negative's score lies between the two
    percents of the positive's.
    """
    spark = rows.sparkSession
    x = F.col("vec")
    unfit = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    taken = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vec_col).cast("array<double>").alias("vec"))
    taken = taken.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & ~F.coalesce(unfit, F.lit(False)))
    whole = lambda v: F.when(F.abs(v) < float(1 << 50), F.floor(v * 256.0).cast("double")).otherwise(v * 256.0)
    norm = F.aggregate(x, F.lit(0.0), lambda acc, v: acc + whole(v) * whole(v))
    about = taken.agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("size"), F.max(norm).alias("longest")).first()
    n, size, longest = about["n"], about["size"] or 0, float(about["longest"] or 0.0)
    sample = taken.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vec").toArrow()
    pivots = choose_pivots(vectors(sample.column(0).combine_chunks(), size)) if sample.num_rows else np.zeros((1, size))
    groups = max(1, min(n_partitions(spark), -(-n // BLOCK_ROWS)), -(-n // GROUP_ROWS))
    row_parts = max(1, -(-n // PART_ROWS))

    def measure(batches):
        for batch in batches:
            vec = vectors(batch.column(2), size)
            away = row_distances(vec, pivots, longest)
            q_away = anchor_distances(vec, pivots, longest)
            packed = lambda m: pa.array([r.tobytes() for r in m], pa.binary())
            close = pa.array(away.argmin(axis=1) if away.size else np.zeros(len(vec), int), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed(vec), packed(away), packed(q_away), close, pa.array(away.min(axis=1))], ["vec_id", "label", "vec", "away", "q_away", "cell", "close"])

    measured = map_batches(taken, measure, "vec_id long, label long, vec binary, away binary, q_away binary, cell int, close double")
    dealt = measured.drop("q_away").repartition(groups).sortWithinPartitions("cell", "close", "vec_id")
    blocks = materialise(_pack(dealt, BLOCK_ROWS))

    asked = measured.filter(is_anchor).select("vec_id", "label", "vec", F.col("q_away").alias("away"), "cell", "close")

    def number(batches):
        key = TaskContext.get().partitionId() << 40
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.arange(key, key + batch.num_rows))], [*batch.schema.names, "keys"])
            key += batch.num_rows

    anchors = materialise(map_batches(asked, number, "vec_id long, label long, vec binary, away binary, cell int, close double, keys long"))
    n_anchors = anchors.count()
    packed = _packed_anchors(anchors, n_anchors, row_parts)

    positives = _search(_pairs_of_blocks(packed, blocks, row_parts), longest, lambda r, a: _Positives(r, a, n_positives), _Positives.add, "key long, vec_id long, score long")
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), "vec_id"))
    positives = positives.withColumn("place", place).filter(F.col("place") <= n_positives)
    positives = materialise(positives)

    per_anchor = positives.groupBy(F.col("key").alias("keys")).agg(F.sort_array(F.collect_set("score")).alias("positives"))
    with_ranges = anchors.join(per_anchor.hint("merge"), "keys")  # vectors are larger than they look to Spark here too
    with_positives = _packed_anchors(with_ranges, n_anchors, row_parts, ("keys", "positives"))
    kinds = "key long, positive_score long, negative_id long, negative_score long"
    negatives = _search(_pairs_of_blocks(with_positives, blocks, row_parts), longest, lambda r, a: _Negatives(r, a, n_negatives, percents), _Negatives.add, kinds)
    rank = F.row_number().over(Window.partitionBy("key", "positive_score").orderBy(F.desc("negative_score"), "negative_id"))
    negatives = negatives.withColumn("rank", rank).filter(F.col("rank") <= n_negatives)
    named = positives.select("key", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    ids = anchors.select(F.col("keys").alias("key"), F.col("vec_id").alias("anchor_id"))
    result = materialise(named.join(negatives, ["key", "positive_score"]).join(ids, "key"))
    discard(blocks, anchors, positives)
    return result.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def mine_embeddings(embeddings: DataFrame) -> DataFrame:
    """mine_hard_negatives for the table embeddings, where the label of every seventh vec_id moves to the next of ten."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(embeddings.select("vec_id", label.alias("label"), "embedding"))


ORACLE_SQL = """
with rows as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
        [cast(floor(256 * cast(x as double)) as bigint) for x in embedding] as v
    from embeddings
    where vec_id is not null and label is not null and embedding is not null
        and len([x for x in embedding if x is null or isnan(x) or isinf(x)]) = 0),
scored as (
    select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same,
        cast(list_sum([z[1] * z[2] for z in list_zip(a.v, b.v)]) as bigint) as score
    from rows a join rows b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
positives as (
    select anchor_id, other_id as positive_id, score as positive_score from scored where same
    qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5)
select p.anchor_id, p.positive_id,
    cast(row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.other_id) as integer) as rank,
    s.other_id as negative_id, p.positive_score, s.score as negative_score
from positives p join scored s on s.anchor_id = p.anchor_id and not s.same
    and 30 * p.positive_score <= 100 * s.score and 100 * s.score <= 90 * p.positive_score
qualify rank <= 10
"""
