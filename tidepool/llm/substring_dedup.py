"""Substring dedup by level-wise doubling: 9 words, then 18, then the whole window of 35.

Level 9 looks at few places only: of the 27 runs of nine words in a window, the one with the smallest hash
(leftmost on ties) is the window's anchor. Equal windows have equal anchors at equal places, so a window can
only be repeated if its anchor's nine words are. Level 18 extends each such anchor, to the right where the
window reaches that far, else to the left. What is repeated at 18 words forms units: neighbouring windows
with one anchor and one side. If all units of equal 18 words are equal from their first to their last word,
all their windows are repeated; else their windows are counted one by one at the full length. Candidates
that are alone at a level end there.

Windows are judged on the input. A repeated row counts as another place. Words are runs of bytes other than
space and \\t \\n \\v \\f \\r; null and empty texts have none, texts under 35 words have no window; an empty table has no rows. Hashes of
places are 64 bits wide; windows and units also compare a second hash of 64 bits. Rows are told apart by id
and a hash of the text, so ids may repeat or be null.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from ._common import discard, map_batches, materialise, plain_text, text_steps

WINDOW = 35
HALF = (WINDOW + 1) // 2
QUARTER = HALF // 2
KEY = ["_doc", "_th"]


class _Windows:
    """Words of a step, and the anchor of each of its windows."""

    def __init__(self, texts):
        self.starts, self.ends, self.rows = K.word_bounds(texts.buf, texts.offs)
        self.words = K.span_hash(texts.buf, self.starts, self.ends)
        n = len(self.words) - WINDOW + 1
        self.at = np.empty(0, np.int64)
        if n > 0:
            self.quarter = K.window_hash(self.words, QUARTER)
            anchor = K.sliding_min(K.mix(self.quarter ^ K.U(0x9AE16A3B2F90404F)), WINDOW - QUARTER + 1)[:n]
            self.at = np.flatnonzero(self.rows[:n] == self.rows[WINDOW - 1 :])
            self.anchor = anchor[self.at]
        counts = K.row_counts(self.rows, texts.n)
        self.first = np.cumsum(counts) - counts


def _key() -> list:
    """What tells rows apart, never null: hashes of id and text."""
    return [F.xxhash64("doc_id").alias("_doc"), F.hash("text").alias("_th")]


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(*_key(), plain_text().alias("text"))


def _out(part, rows: np.ndarray, columns: list, names: list[str]) -> pa.RecordBatch:
    keys = [part.column(i).take(pa.array(rows)) for i in (0, 1)]
    return pa.RecordBatch.from_arrays([*keys, *columns], [*KEY, *names])


def _anchors(keyed: DataFrame) -> DataFrame:
    def run(batches):
        for part, texts in text_steps(batches):
            w = _Windows(texts)
            if len(w.at):
                at = np.unique(w.anchor)
                rows = w.rows[at]
                yield _out(part, rows, [pa.array((at - w.first[rows]).astype(np.int32)), pa.array(w.quarter[at].view(np.int64))], ["p", "h"])

    return map_batches(keyed, run, "_doc long, _th int, p int, h long")


def _chosen(lists: pa.Array, w: _Windows) -> np.ndarray:
    """Which words of a step are named by its rows' lists of positions."""
    named = np.zeros(len(w.words) + 1, bool)
    lengths = np.diff(lists.offsets.to_numpy())
    named[np.repeat(w.first, lengths) + lists.flatten().to_numpy(zero_copy_only=False)] = True
    return named


def _units(kept: DataFrame) -> DataFrame:
    """One row per unit: its 18 words' hash, its first window and number of windows, the hashes of all its words."""

    def run(batches):
        for part, texts in text_steps(batches):
            w = _Windows(texts)
            if not len(w.at):
                continue
            live = _chosen(part.column(3), w)[w.anchor]
            at, anchor = w.at[live], w.anchor[live]
            if not len(at):
                continue
            left = anchor - at >= HALF
            first = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (left[1:] != left[:-1])])
            n = np.diff(np.r_[first, len(at)])
            at, anchor, left = at[first], anchor[first], left[first]
            half = K.window_hash(w.words, HALF)[np.where(left, anchor - QUARTER, anchor)] ^ left.astype(np.uint64)
            whole = []
            for which in (0, 1):
                source = K.mix(w.words ^ K.U(0xA0761D6478BD642F)) if which else w.words
                sums = np.zeros(len(source) + 1, np.uint64)
                np.cumsum(source * K.powers(K.BASE[which], len(source)), out=sums[1:])
                h = (sums[at + n + WINDOW - 1] - sums[at]) * K.powers(K.INVERSE[which], len(source) + 1)[at]
                whole.append(K.mix(h + (n << 8 | anchor - at).astype(np.uint64)))
            rows = w.rows[at]
            columns = [pa.array(x) for x in (half.view(np.int64), (at - w.first[rows]).astype(np.int32), n.astype(np.int32), whole[0].view(np.int64), whole[1].view(np.int64))]
            yield _out(part, rows, columns, ["h", "i", "n", "s1", "s2"])

    return map_batches(kept, run, "_doc long, _th int, h long, i int, n int, s1 long, s2 long")


def _single_windows(kept: DataFrame) -> DataFrame:
    """One row per window that a row's list of starts names: its start and its two hashes."""

    def run(batches):
        for part, texts in text_steps(batches):
            w = _Windows(texts)
            at = w.at[_chosen(part.column(3), w)[w.at]] if len(w.at) else w.at
            if len(at):
                rows = w.rows[at]
                hashes = [pa.array(K.window_hash(w.words, WINDOW, k)[at].view(np.int64)) for k in (0, 1)]
                yield _out(part, rows, [pa.array((at - w.first[rows]).astype(np.int32)), *hashes], ["i", "h1", "h2"])

    return map_batches(kept, run, "_doc long, _th int, i int, h1 long, h2 long")


def repeated_windows(docs: DataFrame) -> DataFrame:
    """(_doc, _th, i, n): from word i on, n successive windows start that also start elsewhere; keys as of _key()."""
    keyed = _keyed(docs)
    # nine words
    anchors = materialise(_anchors(keyed))
    # written first, so that both sides of the join are plain exchanges and Spark can split a hot anchor's rows
    often = materialise(anchors.groupBy("h").agg(F.count("*").alias("c")).filter("c > 1").select("h"))
    live = materialise(anchors.join(often, "h").groupBy(*KEY).agg(F.collect_set("p").alias("at")))
    discard(anchors, often)
    kept = materialise(keyed.join(live, KEY).select(*KEY, "text", "at"))
    discard(live)
    # eighteen words
    units = materialise(_units(kept))
    even = (F.min("s1") == F.max("s1")) & (F.min("s2") == F.max("s2"))
    state = materialise(units.groupBy("h").agg(F.count("*").alias("c"), even.alias("even")).filter("c > 1").select("h", "even"))
    judged = materialise(units.join(state, "h").select(*KEY, "i", "n", "even"))
    discard(units, state)
    # thirty-five words
    starts = judged.filter("not even").groupBy(*KEY).agg(F.array_distinct(F.flatten(F.collect_list(F.expr("sequence(i, i + n - 1)")))).alias("at"))
    single = materialise(_single_windows(kept.drop("at").join(starts, KEY)))
    twice = materialise(single.groupBy("h1", "h2").agg(F.count("*").alias("c")).filter("c > 1").drop("c"))
    some = single.join(twice, ["h1", "h2"]).select(*KEY, "i", F.lit(1).alias("n"))
    found = materialise(judged.filter("even").select(*KEY, "i", "n").union(some))
    discard(kept, judged, single, twice)
    return found


def _with_ranges(docs: DataFrame, out: str) -> DataFrame:
    """docs with the column `out`, the flat list of (i, n) of a row's repeated windows."""
    ranges = repeated_windows(docs).groupBy(*KEY).agg(F.flatten(F.collect_list(F.array("i", "n"))).alias("_gone"))
    return docs.select(F.struct("*").alias("_row"), *_key()).join(ranges, KEY, "left").select("_row.*", F.col("_gone").alias(out))


def _removed(flat: pa.Array, first: np.ndarray, n: int) -> np.ndarray:
    """Which of n words are covered by the windows of the rows' flat (i, n) lists."""
    edge = np.zeros(n + 1, np.int64)
    lengths = np.diff(flat.offsets.to_numpy())
    pairs = flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, 2).astype(np.int64)
    start = np.repeat(first, lengths // 2) + pairs[:, 0]
    np.add.at(edge, start, 1)
    np.add.at(edge, start + pairs[:, 1] + WINDOW - 1, -1)
    return np.cumsum(edge[:n]) > 0


def substring_dedup(docs: DataFrame) -> DataFrame:
    """Per row of docs(doc_id, text): doc_id, n_words, n_removed, kept_sha256 (kept words joined by one space)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for part, texts in text_steps(batches):
            starts, ends, rows = K.word_bounds(texts.buf, texts.offs)
            counts = K.row_counts(rows, texts.n)
            ends_at = np.cumsum(counts)
            gone = _removed(part.column(2), ends_at - counts, len(starts))
            raw = texts.buf.tobytes()
            digests = []
            for a, b in zip(ends_at - counts, ends_at):
                keep = a + np.flatnonzero(~gone[a:b])
                digests.append(sha256(b" ".join([raw[s:e] for s, e in zip(starts[keep].tolist(), ends[keep].tolist())])).hexdigest())
            removed = np.bincount(rows, weights=gone, minlength=texts.n).astype(np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts), pa.array(removed), pa.array(digests)], names)

    names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    none = F.expr("cast(array() as array<int>)")
    rows = _with_ranges(docs.select("doc_id", "text"), "gone").select("doc_id", plain_text().alias("text"), F.coalesce("gone", none).alias("gone"))
    return map_batches(rows, run, f"doc_id {id_type}, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """docs with all repeated words taken out of the text, each with the white space before it.

    Rows that lose every word go; rows without repeats, null texts among them, stay as they are. If there is
    an integer column n_chars, it gets the new length.
    """
    names = docs.columns
    mark = max(names, key=len) + "_gone"  # longer than any name of docs

    def run(batches):
        for batch in batches:
            at, flat = batch.schema.get_field_index("text"), batch.schema.get_field_index(mark)
            hit = batch.filter(pa.compute.is_valid(batch.column(flat)))
            texts, sizes = [], []
            for part, step in text_steps([hit]):
                starts, ends, rows = K.word_bounds(step.buf, step.offs)
                counts = K.row_counts(rows, step.n)
                ends_at = np.cumsum(counts)
                gone = _removed(part.column(flat), ends_at - counts, len(starts))
                raw = step.buf.tobytes()
                for r, (a, b) in enumerate(zip(ends_at - counts, ends_at)):
                    keep = np.ones(int(step.offs[r + 1] - step.offs[r]), bool)
                    base = int(step.offs[r])
                    for k in a + np.flatnonzero(gone[a:b]):
                        keep[(ends[k - 1] if k > a else starts[a]) - base : ends[k] - base] = False
                    text = np.frombuffer(raw, np.uint8)[base : step.offs[r + 1]][keep].tobytes().decode().strip() if not gone[a:b].all() else None
                    texts.append(text)
                    sizes.append(len(text or ""))
            columns = [hit.column(i) for i in range(len(names))]
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            if "n_chars" in names:
                columns[names.index("n_chars")] = pa.array(sizes, pa.int64()).cast(batch.schema.field("n_chars").type)
            out = pa.RecordBatch.from_arrays(columns, names)
            yield out.filter(pa.compute.is_valid(out.column(at)))

    ranged = _with_ranges(docs, mark)
    changed = map_batches(ranged.filter(ranged[mark].isNotNull()), run, docs.schema)
    return ranged.filter(ranged[mark].isNull()).drop(mark).union(changed)


ORACLE_SQL = """
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM words WHERE len(w) >= 35)
), repeated AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY h) AS c FROM windows) WHERE c > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS k FROM repeated
), lists AS (
  SELECT doc_id, list(k) AS ks FROM gone GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(ks), 0)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN ks IS NULL THEN w ELSE list_transform(list_filter(range(1, len(w) + 1), lambda j: NOT list_contains(ks, j)), lambda j: w[j]) END, ' ')) AS kept_sha256
FROM words LEFT JOIN lists USING (doc_id)
"""
