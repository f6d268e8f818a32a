"""Packing token sequences as a cutting-stock problem, solved by column generation.

A document's ids are cut into whole sequences of `size` and one remainder. The remainders' length histogram
(at most size - 1 numbers, whatever the corpus) goes to the driver. There a linear program over patterns, that
is sets of lengths that fit into one sequence, is solved: its first basis comes from a greedy fill, a knapsack
dynamic program prices new patterns against the dual prices (drawn to those with the best bound, which steadies
them), and it ends when Farley's bound shows the gap to the optimum to be small. Numbers of patterns are rounded
down. Documents are ranked within their length by bucketed counts, and a rank finds its pattern, sequence and
offset by arithmetic in a join with the pattern table, whose size depends on `size` alone. What rounding leaves
over, a few pieces per pattern whatever the corpus, goes into the fullest patterns that can be made of it; only
pieces that no pattern takes with at most `most_waste` places of padding are laid end to end and cut.

Ids are those of the tokenizers library for a byte_bpe .json file (special strings inside texts are ids of
their own), followed by one end id. They are made by tiktoken's merger over that file's vocabulary, which
gives the same ids in a fraction of the time; a test holds the two against each other.

Null and empty texts are the end id alone. A text of any length is cut into whole sequences and a remainder. An
empty table has no pieces. Ids may repeat: rows are ranked by
id, length and checksum, and what still ties is equal in every column that is used. Other columns are not read.
"""

from __future__ import annotations

import json
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import map_batches, materialise, n_partitions, plain_text, text_steps, vocabulary
from .token_counts import byte_letters

SIZE = 1024
#: How near to the linear program's bound pricing goes, and the most patterns that it asks for.
GAP, ROUNDS = 2e-4, 2_000
#: Share of the centre in prices.
SMOOTH = 0.9
#: Padding of a sequence beyond which its pattern isn't used.
MOST_WASTE = 8
#: Rows of the table of remainders to be cut up to which it is broadcast to find their texts.
SMALL = 100_000

_encodings: dict = {}


def encoding(tokenizer: str):
    """(encode, end of text handling) over the vocabulary of a byte_bpe .json file."""
    if tokenizer not in _encodings:
        import public_tokenizers
        import tiktoken

        with open(vocabulary(tokenizer), encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(map(letters.__getitem__, token)): i for token, i in spec["model"]["vocab"].items() if token not in special}
        _encodings[tokenizer] = tiktoken.Encoding(tokenizer, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return _encodings[tokenizer]


def token_ids(text: str, tokenizer: str, end_id: int) -> np.ndarray:
    ids = encoding(tokenizer).encode(text, allowed_special="all")
    ids.append(end_id)
    return np.array(ids, "<u4")


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.tobytes())


# ---- the linear program, on the driver, over the histogram


class Solution(NamedTuple):
    """(pattern, how often) of a linear program, their sum, a bound from below and how many patterns were priced."""

    patterns: list[tuple[dict[int, int], float]]
    value: float
    bound: float
    asked: int


def greedy_patterns(demand: np.ndarray, size: int) -> list[tuple[dict[int, int], float]]:
    """Patterns from large to small lengths, each used until one of its lengths runs out: one pattern per length."""
    left, alive = demand.astype(float), demand > 0
    out = []
    while len(live := np.flatnonzero(alive)):
        pattern: dict[int, int] = {}
        room = size
        for length in live[::-1]:
            if length <= room:
                take = min(room // length, max(1, int(left[length])))
                pattern[int(length)] = int(take)
                room -= length * take
        times = min(left[k] / n for k, n in pattern.items())
        gone = min(pattern, key=lambda k: (left[k] / pattern[k], -k))
        for k, n in pattern.items():
            left[k] = max(0.0, left[k] - n * times)
        alive[gone] = False
        out.append((pattern, times))
    return out


def best_pattern(price: np.ndarray, size: int) -> tuple[float, dict[int, int]]:
    """The knapsack: the pattern of the highest total price; price[k] of length k, below 0 where there is none."""
    best, choice = np.zeros(size + 1), np.zeros(size + 1, np.int64)
    for w in range(1, size + 1):
        totals = best[w - 1 :: -1] + price[1 : w + 1]
        k = int(totals.argmax())
        if totals[k] > best[w - 1] + 1e-12:
            best[w], choice[w] = totals[k], k + 1
        else:
            best[w] = best[w - 1]
    pattern: dict[int, int] = {}
    w = size
    while w > 0 and best[w] > 0:
        if choice[w]:
            pattern[int(choice[w])] = pattern.get(int(choice[w]), 0) + 1
            w -= choice[w]
        else:
            w -= 1
    return float(best[size]), pattern


def solve_patterns(demand: np.ndarray, size: int = SIZE, gap: float = GAP, rounds: int = ROUNDS) -> Solution:
    """Patterns that cover demand[k] pieces of each length k in about the fewest sequences.

    No packing has fewer than `bound` sequences (Farley): the linear program's value over the worth of the best
    pattern at its prices. Pricing ends when the value is within `gap` of it, never before it was asked.
    """
    lengths = np.flatnonzero(demand)
    if not len(lengths):
        return Solution([], 0.0, 0.0, 0)
    basis = greedy_patterns(demand, size)
    at = {int(k): i for i, k in enumerate(lengths)}
    matrix = np.zeros((len(lengths), len(basis)))
    for j, (pattern, _) in enumerate(basis):
        for k, n in pattern.items():
            matrix[at[k], j] = n
    inverse, x = np.linalg.inv(matrix), np.array([t for _, t in basis])
    patterns = [p for p, _ in basis]
    # prices in proportion to length give a first bound; of later ones those with the best bound are the centre that the next are drawn to
    wanted, price = demand[lengths].astype(float), np.full(size + 1, -1.0)
    price[lengths] = centre = lengths / size
    bound, best, asked, pivots = float(centre @ wanted) / best_pattern(price, size)[0], 0.0, 1, 0
    while asked < rounds and x.sum() - bound > gap * x.sum():
        own = inverse.sum(axis=0)
        for share in (SMOOTH, 0.0):
            price[lengths] = mixed = share * centre + (1 - share) * own
            worth, pattern = best_pattern(price, size)
            asked += 1
            if (found := float(mixed @ wanted) / max(worth, 1e-12)) > best:
                best, centre = found, mixed / max(worth, 1e-12)
                bound = max(bound, best)
            if sum(own[at[k]] * n for k, n in pattern.items()) > 1 + 1e-9:
                break
        else:
            break  # no pattern is worth more than a sequence: optimal
        column = inverse[:, [at[k] for k in pattern]] @ np.array(list(pattern.values()), float)
        ok = column > 1e-7
        ratio = np.where(ok, x / np.where(ok, column, 1), np.inf)
        leave = int(ratio.argmin())
        step = max(ratio[leave], 0.0)
        x -= step * column
        x[leave] = step
        inverse[leave] /= column[leave]
        column[leave] = 0
        used = np.flatnonzero(np.abs(column) > 1e-12)
        inverse[used] -= np.outer(column[used], inverse[leave])
        patterns[leave] = pattern
        pivots += 1
        if pivots % 50 == 0:  # rounding errors of the updates go
            matrix[:] = 0
            for j, p in enumerate(patterns):
                for k, n in p.items():
                    matrix[at[k], j] = n
            try:
                inverse = np.linalg.inv(matrix)
            except np.linalg.LinAlgError:  # no digits are left: what is found so far stands
                break
            x = inverse @ wanted
        np.maximum(x, 0, out=x)
    return Solution(list(zip(patterns, x.tolist())), float(x.sum()), bound, asked)


def fullest_pattern(left: np.ndarray, room: int) -> dict[int, int]:
    """The longest piece that is left, and the other lengths, each at most once, that fill up most of the room."""
    first = int(np.flatnonzero(left)[-1])
    others = np.flatnonzero(left[: room - first + 1]).tolist()
    if first <= room - first and left[first] == 1:
        others.remove(first)
    reach, steps = 1, []  # bit r: others taken so far can fill r places
    mask = (1 << room - first + 1) - 1
    for k in others:
        steps.append(reach)
        reach = (reach | reach << k) & mask
    pattern, filled = {first: 1}, reach.bit_length() - 1
    for k, before in zip(reversed(others), reversed(steps)):
        if not before >> filled & 1:
            pattern[k] = pattern.get(k, 0) + 1
            filled -= k
    return pattern


def layout(demand: np.ndarray, size: int, most_waste: int) -> tuple[list[tuple], int]:
    """Rows (length, first rank, end rank, per sequence, first sequence, offset, loose) and the number of sequences.

    Ranks of a length from first to end lie `per sequence` in each of successive sequences, from offset on. In
    a loose row (one per length at most) offset counts places of the laid out rest, from first sequence on.
    Patterns of the linear program come first, as often as their rounded numbers say; what rounding leaves goes
    into the fullest patterns of its own; pieces that find no pattern within most_waste are loose.
    """
    used, rows, sequence = np.zeros(size + 1, np.int64), [], 0
    free = demand.copy()

    def place(pattern: dict[int, int], times: int):
        nonlocal sequence
        offset = 0
        for k, n in sorted(pattern.items(), reverse=True):
            rows.append((k, int(used[k]), int(used[k]) + n * times, n, sequence, offset, False))
            used[k] += n * times
            free[k] -= n * times
            offset += k * n
        sequence += times

    waste = lambda pattern: size - sum(k * n for k, n in pattern.items())
    for pattern, times in solve_patterns(demand, size).patterns:
        times = min([int(times + 1e-6), *(int(free[k]) // n for k, n in pattern.items())])
        if times > 0 and waste(pattern) <= most_waste:
            place(pattern, times)
    loose = np.zeros_like(free)
    while free.any():  # each turn uses up a length
        pattern = fullest_pattern(free, size)
        first = max(pattern)
        if waste(pattern) <= most_waste:
            place(pattern, min(int(free[k]) // n for k, n in pattern.items()))
        else:
            loose[first], free[first] = free[first], 0
    rest, first = 0, sequence
    for k in np.flatnonzero(loose)[::-1].tolist():
        rows.append((k, int(used[k]), int(demand[k]), 1, first, rest, True))
        rest += k * int(loose[k])
    return rows, first + -(-rest // size)


# ---- the Spark side


def _tokenized(docs: DataFrame, tokenizer: str, end_id: int, size: int) -> DataFrame:
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for part, _ in text_steps(batches):
            total, rest, whole = [], [], []
            for text in part.column(1).to_pylist():
                ids = token_ids(text, tokenizer, end_id)
                cut = len(ids) // size * size
                total.append(len(ids))
                whole.append([crc(ids[i : i + size]) for i in range(0, cut, size)])
                rest.append(crc(ids[cut:]) if cut < len(ids) else None)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(total, pa.int64()), pa.array(rest, pa.int64()), pa.array(whole, pa.list_(pa.int64()))], names)

    names = ["doc_id", "doc_tokens", "rest_crc", "whole_crcs"]
    rows = docs.select("doc_id", plain_text().alias("text"))
    return map_batches(rows, run, f"doc_id {id_type}, doc_tokens long, rest_crc long, whole_crcs array<long>")


def _cut_pieces(texts: DataFrame, cuts: DataFrame, tokenizer: str, end_id: int, size: int) -> DataFrame:
    """Checksums of the two parts of each remainder in cuts."""
    id_type = texts.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for part, _ in text_steps(batches):
            out = []
            for doc_id, text, total, rest_crc, place in zip(*(part.column(i).to_pylist() for i in range(5))):
                ids = token_ids(text, tokenizer, end_id)
                rest = ids[len(ids) // size * size :]
                if len(ids) != total or crc(rest) != rest_crc:  # another row of this id
                    continue
                k = size - place % size
                out += [(doc_id, total - len(rest), k, crc(rest[:k]), total, place // size, place % size)]
                out += [(doc_id, total - len(rest) + k, len(rest) - k, crc(rest[k:]), total, place // size + 1, 0)]
            kinds = [part.schema.field(0).type] + [pa.int64()] * 6
            columns = zip(*out) if out else [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], COLUMNS)

    # doc_id, text, doc_tokens, rest_crc, place
    rows = texts.join(cuts, texts["doc_id"].eqNullSafe(cuts["doc_id"])).select(texts["doc_id"], plain_text().alias("text"), "doc_tokens", "rest_crc", "place")
    return map_batches(rows, run, f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def pack(docs: DataFrame, *, tokenizer: str = "byte_bpe_50k.json", end_id: int = 0, size: int = SIZE, most_waste: int = MOST_WASTE) -> DataFrame:
    """One row per piece of docs(doc_id, text): COLUMNS; pieces of a sequence lie gapless from offset 0."""
    spark = docs.sparkSession
    rows = materialise(_tokenized(docs, tokenizer, end_id, size))
    n_rows = rows.count()
    buckets = max(64, 4 * n_partitions(spark), n_rows // 20_000)
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "doc_tokens", "rest_crc"), F.lit(buckets)).cast("int"))
    rows = rows.withColumn("rest", (F.col("doc_tokens") % size).cast("int")).withColumn("n_whole", F.size("whole_crcs"))

    # ranks: counts by bucket, added up over buckets, and row numbers inside
    counts = rows.groupBy("rest", "bucket").agg(F.count("*").alias("n"), F.sum("n_whole").alias("w"))
    counts = materialise(counts)
    demand = np.zeros(size + 1, np.int64)
    for r in counts.filter("rest > 0").groupBy("rest").agg(F.sum("n").alias("n")).collect():  # at most size - 1 rows
        demand[r["rest"]] = r["n"]
    plan, n_sequences = layout(demand, size, most_waste)

    before = Window.partitionBy("rest").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("rest", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rank0"))
    per_bucket = counts.groupBy("bucket").agg(F.sum("w").alias("w"))  # one row per bucket
    wholes = per_bucket.select("bucket", F.coalesce(F.sum("w").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("whole0"))

    order = ["doc_id", "doc_tokens", "rest_crc"]
    inner = Window.partitionBy("rest", "bucket").orderBy(*order)
    ranked = (
        rows.filter("rest > 0")
        .select(*order, "rest", "bucket", (F.row_number().over(inner) - 1).alias("r"))
        .join(starts, ["rest", "bucket"])
        .select(*order, "rest", (F.col("rank0") + F.col("r")).alias("rank"))
    )
    table = spark.createDataFrame(plan, "rest int, lo long, hi long, per long, sequence0 long, offset0 long, loose boolean")
    at = F.col("rank") - F.col("lo")
    placed = ranked.join(F.broadcast(table), "rest").filter("rank >= lo and rank < hi")
    placed = materialise(
        placed.select(
            *order,
            "rest",
            "loose",
            F.when(F.col("loose"), F.col("sequence0") * size + F.col("offset0") + at * F.col("rest"))
            .otherwise((F.col("sequence0") + F.floor(at / F.col("per"))) * size + F.col("offset0") + at % F.col("per") * F.col("rest"))
            .alias("place"),
        )
    )
    across = F.col("loose") & (F.col("place") % size + F.col("rest") > size)
    rest = placed.filter(~across).select(
        "doc_id",
        (F.col("doc_tokens") - F.col("rest")).alias("start"),
        F.col("rest").cast("long").alias("length"),
        F.col("rest_crc").alias("ids_crc32"),
        "doc_tokens",
        F.floor(F.col("place") / size).alias("sequence_id"),
        (F.col("place") % size).alias("offset"),
    )
    cuts = materialise(placed.filter(across).select(*order, "place"))
    wanted = cuts.select(F.col("doc_id").alias("_wanted")).distinct()
    wanted = F.broadcast(wanted) if cuts.count() <= SMALL else wanted
    texts = docs.select("doc_id", "text").join(wanted, docs["doc_id"].eqNullSafe(wanted["_wanted"]), "left_semi").distinct()
    cut = _cut_pieces(texts, cuts, tokenizer, end_id, size)

    run = Window.partitionBy("bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    whole = (
        rows.filter("n_whole > 0")
        .select("doc_id", "doc_tokens", "bucket", "whole_crcs", F.coalesce(F.sum("n_whole").over(run), F.lit(0)).alias("w0"))
        .join(wholes, "bucket")
        .select("doc_id", "doc_tokens", (F.col("whole0") + F.col("w0") + n_sequences).alias("s0"), F.posexplode("whole_crcs").alias("k", "ids_crc32"))
        .select(
            "doc_id",
            (F.col("k") * F.lit(size).cast("long")).alias("start"),
            F.lit(size).cast("long").alias("length"),
            "ids_crc32",
            "doc_tokens",
            (F.col("s0") + F.col("k")).alias("sequence_id"),
            F.lit(0).cast("long").alias("offset"),
        )
    )
    return rest.select(*COLUMNS).union(cut.select(*COLUMNS)).union(whole.select(*COLUMNS))
