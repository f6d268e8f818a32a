"""Quality rules: counts of a text's words, symbols and repeats, and bands of n-gram perplexity per language.

The language model is a modified Kneser-Ney model of order 5 over characters as they are (code points, with case).
Spark counts the n-grams of all documents of a language; continuation counts, discounts, back-off weights and
probabilities follow by groupings and joins, order by order, so the model grows with the corpus and no part of it
passes through the driver. It is written to the shared folder as a table of hashes with their log-probabilities and
weights, in ranges sorted by hash; a task reads it once and looks n-grams up in sorted arrays.

A document's figure is its mean negative log-probability per character. A language's band lies around the median of
that figure over its documents. Its lower and upper limits are set apart and depend on the length, as a short text
strays further by chance: each lies WIDTH spreads away, where the squared spread is a part between texts plus a part
per character over the length, fitted to the median deviations of the shorter and the longer half of the documents
on that side. Texts outside their limits may mix languages: they are judged once more by pieces of PIECE characters,
each against the language whose middle it is nearest to. A document outside its limits then too is rejected. Null languages and
those of under FEWEST documents share one model and one band; bands of few documents lean on the spread of all.

Null and empty texts have no figure and fail the base rules; texts of any length are scored whole; an empty table
has no rows. Repeated rows are independent rows, ids may be null or tie; columns other than id, text and lang are not
read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from ._common import discard, map_batches, materialise, plain_text, text_steps

ORDER = 5
WIDTH = 2.5
PIECE = 64
LEAST = 0.01
FEWEST = 30
#: n-grams that a task gathers before it counts them.
GATHERED = 1 << 20
#: Rows whose texts are found by broadcasting their ids; beyond it the ids are joined by a shuffle.
SMALL = 100_000

_SYMBOL_BYTES = np.zeros(256, bool)
_SYMBOL_BYTES[[*b"#*$%&|<>"]] = True
_BITS = 21
_MASK = (1 << _BITS) - 1


# ---- n-grams: the last three characters in `lo`, those before in `hi`, 21 bits each; 0 stands before a text


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hi, lo) of the n-gram of ORDER that ends at each character, and its row."""
    sizes = np.array([len(t) for t in texts], np.int64)
    border = "\0" * (ORDER - 1)
    points = np.frombuffer((border + border.join(texts)).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    rows = np.repeat(np.arange(len(texts)), sizes)
    at = np.arange(int(sizes.sum())) + (ORDER - 1) * (rows + 1)
    hi = points[at - 4] << _BITS | points[at - 3]
    lo = points[at - 2] << 2 * _BITS | points[at - 1] << _BITS | points[at]
    return hi, lo, rows


def gram_hash(hi: np.ndarray, lo: np.ndarray, order) -> np.ndarray:
    h = K.mix(lo.astype(np.uint64) * K.U(K.BASE[0]) + K.U(order) if np.isscalar(order) else lo.astype(np.uint64) * K.U(K.BASE[0]) + order.astype(np.uint64))
    return K.mix(h + hi.astype(np.uint64) * K.U(K.BASE[1]))


def distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order that sorts hashes, where each value begins in it, and a place of each value."""
    order = np.argsort(hashes)
    sorted_ = hashes[order]
    begins = np.flatnonzero(np.r_[True, sorted_[1:] != sorted_[:-1]]) if len(order) else order
    return order, begins, order[begins]


def last(hi: np.ndarray, lo: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram of the last `order` characters."""
    if order >= 3:
        return hi & (1 << _BITS * (order - 3)) - 1, lo
    return np.zeros_like(hi), lo & (1 << _BITS * order) - 1


def count_grams(docs: DataFrame) -> DataFrame:
    """(lang, hi, lo, n) over all texts of docs(text, lang)."""

    def run(batches):
        gathered: dict[str, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        sizes: dict[str, int] = {}

        def counted(hi, lo, n):
            order, begins, first = distinct(gram_hash(hi, lo, ORDER))
            return hi[first], lo[first], np.add.reduceat(n[order], begins) if len(n) else n

        def settle(lang):
            gathered[lang] = [counted(*(np.concatenate(x) for x in zip(*gathered[lang])))]
            sizes[lang] = max(GATHERED, 2 * len(gathered[lang][0][0]))

        for part, _ in text_steps(batches):
            hi, lo, rows = grams(part.column(0).to_pylist())
            langs = np.array(part.column(1).to_pylist(), object)
            for lang in set(langs):
                mine = np.flatnonzero((langs == lang)[rows])
                gathered.setdefault(lang, []).append(counted(hi[mine], lo[mine], np.ones(len(mine), np.int64)))
                if sum(len(x[0]) for x in gathered[lang]) > sizes.get(lang, GATHERED):
                    settle(lang)
        for lang in gathered:
            settle(lang)
            ((hi, lo, n),) = gathered[lang]
            for at in range(0, len(n), 1 << 16):
                cut = slice(at, at + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n[cut]), pa.string()), pa.array(hi[cut]), pa.array(lo[cut]), pa.array(n[cut])], ["lang", "hi", "lo", "n"])

    return map_batches(docs, run, "lang string, hi long, lo long, n long").groupBy("lang", "hi", "lo").agg(F.sum("n").alias("n"))


def discounts(ones: list[int]) -> tuple[float, float, float]:
    """What counts of 1, 2 and 3 or more give up, from the numbers of n-grams counted once, twice, three and four times."""
    y = ones[0] / (ones[0] + 2 * ones[1]) if ones[0] + 2 * ones[1] else 0.5
    raw = [k - (k + 1) * y * ones[k] / ones[k - 1] if ones[k - 1] else 0.5 * k for k in (1, 2, 3)]
    return tuple(float(min(max(d, 0.05), k)) for k, d in zip((1, 2, 3), raw))


def kneser_ney(counts: DataFrame) -> DataFrame:
    """(lang, order, hi, lo, log, weight) from (lang, hi, lo, n): log-probability of an n-gram, log weight of what follows it otherwise.

    Order 0 holds the log-probability of a character that a language never has.
    """
    spark = counts.sparkSession
    levels = {ORDER: counts}
    for order in range(ORDER - 1, 0, -1):  # below the top, a count is the number of different characters seen before
        hi, lo = (f"hi & {(1 << _BITS * max(order - 3, 0)) - 1}L", f"lo & {(1 << _BITS * min(order, 3)) - 1}L")
        levels[order] = materialise(levels[order + 1].selectExpr("lang", f"{hi} as hi", f"{lo} as lo").groupBy("lang", "hi", "lo").agg(F.count("*").alias("n")))
    # counts of counts: ORDER rows for each of the labels
    of = lambda order: levels[order].groupBy("lang").agg(*(F.count_if(F.col("n") == k).alias(f"n{k}") for k in (1, 2, 3, 4)), F.count("*").alias("all"))
    freed = {}
    for order in range(1, ORDER + 1):
        rows = [(r["lang"], *discounts([r["n1"], r["n2"], r["n3"], r["n4"]]), 1.0 / (r["all"] + 1)) for r in of(order).collect()]
        freed[order] = F.broadcast(spark.createDataFrame(rows, "lang string, d1 double, d2 double, d3 double, uniform double"))
    lower, made, weights = None, [], {}
    for order in range(1, ORDER + 1):
        rows = levels[order].join(freed[order], "lang").withColumn("d", F.expr("case n when 1 then d1 when 2 then d2 else d3 end"))
        rows = rows.withColumns({"chi": F.expr(f"shiftright(hi, {_BITS})"), "clo": F.expr(f"shiftright(lo, {_BITS}) | shiftleft(hi & {_MASK}L, {2 * _BITS})")})
        context = materialise(rows.groupBy("lang", "chi", "clo").agg(F.sum("n").alias("total"), F.sum("d").alias("given")))
        weights[order - 1] = context.selectExpr("lang", "chi as hi", "clo as lo", "given / total as w")
        rows = rows.join(context, ["lang", "chi", "clo"])
        if order == 1:
            found = rows.selectExpr("lang", "hi", "lo", "(n - d) / total + given / total * uniform as p")
            none = context.join(freed[1], "lang").selectExpr("lang", "given / total * uniform as p")
            made.append(none.selectExpr("lang", "0 as order", "0L as hi", "0L as lo", "ln(p) as log", "0.0D as weight"))
        else:
            low = lower.selectExpr("lang", "hi as shi", "lo as slo", "p as q")
            hi, lo = (f"hi & {(1 << _BITS * max(order - 4, 0)) - 1}L", f"lo & {(1 << _BITS * min(order - 1, 3)) - 1}L")
            rows = rows.withColumns({"shi": F.expr(hi), "slo": F.expr(lo)}).join(low, ["lang", "shi", "slo"])
            found = rows.selectExpr("lang", "hi", "lo", "(n - d) / total + given / total * q as p")
        lower = materialise(found)
        made.append(lower.selectExpr("lang", f"{order} as order", "hi", "lo", "ln(p) as log"))
    out = made[0]
    for order in range(1, ORDER + 1):
        rows = made[order]
        if order < ORDER:
            # contexts that end before a text's first character are no n-grams of this order themselves
            rows = rows.join(weights[order], ["lang", "hi", "lo"], "full").selectExpr("lang", f"{order} as order", "hi", "lo", "coalesce(log, double('NaN')) as log", "coalesce(ln(w), 0.0D) as weight")
        out = out.unionByName(rows if order < ORDER else rows.withColumn("weight", F.lit(0.0)))
    return out


def store_models(docs: DataFrame) -> DataFrame:
    """The models of docs(text, lang), written as (lang, hash, log, weight), sorted by language and hash over all files."""
    counts = materialise(count_grams(docs))

    def run(batches):
        for b in batches:
            order, hi, lo = (b.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(gram_hash(hi, lo, order).view(np.int64)), b.column(4).cast(pa.float32()), b.column(5).cast(pa.float32())], ["lang", "hash", "log", "weight"])

    hashed = map_batches(kneser_ney(counts), run, "lang string, hash long, log float, weight float")
    stored = materialise(hashed.repartitionByRange("lang", "hash").sortWithinPartitions("lang", "hash"))
    discard(counts)
    return stored


class Model:
    """Sorted hashes of n-grams of all orders, their log-probabilities and weights."""

    def __init__(self, hashes: np.ndarray, logs: np.ndarray, weights: np.ndarray):
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.logs, self.weights = hashes[order], logs[order], weights[order]

    def _find(self, hi, lo, order):
        h = gram_hash(hi, lo, order).view(np.int64)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return at, self.hashes[at] == h

    def gram_logs(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """The log-probability of the last character of each n-gram after the others."""
        out, left = np.zeros(len(hi)), np.arange(len(hi))
        for order in range(ORDER, -1, -1):
            at, known = self._find(*last(hi[left], lo[left], order), order)
            known &= ~np.isnan(self.logs[at])
            out[left[known]] += self.logs[at[known]]
            left = left[~known]
            if not len(left) or not order:
                break
            # the context that the next order leaves
            chi, clo = hi[left] >> _BITS, lo[left] >> _BITS | (hi[left] & _MASK) << 2 * _BITS
            at, known = self._find(*last(chi, clo, order - 1), order - 1)
            if order > 1:
                out[left[known]] += self.weights[at[known]]
        return out


_loaded: dict[str, dict[str, Model]] = {}


def load_models(path: str) -> dict[str, Model]:
    """The models of a stored table; a worker keeps those of one table."""
    if path not in _loaded:
        _loaded.clear()
        rows = pq.read_table(path.removeprefix("file://") if path.startswith("file:") else path)
        langs = rows.column("lang").combine_chunks().dictionary_encode()
        codes = langs.indices.to_numpy()
        columns = [rows.column(c).to_numpy() for c in ("hash", "log", "weight")]
        _loaded[path] = {lang: Model(*(c[codes == k] for c in columns)) for k, lang in enumerate(langs.dictionary.to_pylist())}
    return _loaded[path]


def base_counts(texts) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each row."""
    buf, offs, n = texts.buf, texts.offs, texts.n

    def per_row(flags):
        sums = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=sums[1:])
        return sums[offs[1:]] - sums[offs[:-1]]

    starts, ends, rows = K.word_bounds(buf, offs)
    words = K.span_hash(buf, starts, ends)
    windows = K.window_hash(words, 5)
    inside = np.flatnonzero(rows[: len(windows)] == rows[len(rows) - len(windows) :])
    twice = inside[_repeats(windows[inside], rows[inside])[0]]
    repeated = K.covered(twice, 5, len(words))
    # lines: from a row's start or a line feed to the next line feed or the row's end
    feeds = np.flatnonzero(buf == 10)
    feed_rows = np.searchsorted(offs, feeds, "right") - 1
    line_starts = np.sort(np.r_[offs[:-1], feeds + 1], kind="stable")
    line_rows = np.sort(np.r_[np.arange(n), feed_rows], kind="stable")
    line_ends = np.sort(np.r_[offs[1:], feeds], kind="stable")
    with_word = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_starts, line_ends, line_rows = line_starts[with_word], line_ends[with_word], line_rows[with_word]
    later = _repeats(K.span_hash(buf, line_starts, line_ends), line_rows)[1]
    return {
        "n_words": K.row_counts(rows, n),
        "word_chars": per_row(~K.SEPARATOR[buf] & ((buf & 0xC0) != 0x80)),
        "n_symbols": per_row(_SYMBOL_BYTES[buf]),
        "n_dup_lines": np.bincount(line_rows, weights=later, minlength=n).astype(np.int64),
        "n_repeat_words": np.bincount(rows, weights=repeated, minlength=n).astype(np.int64),
    }


def _repeats(values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values occur twice or more in their row; which do so as second or later."""
    order = np.lexsort((values, rows))  # stable: equal values stay in order
    same = (values[order][1:] == values[order][:-1]) & (rows[order][1:] == rows[order][:-1])
    any_, later = np.zeros(len(values), bool), np.zeros(len(values), bool)
    later[order[1:]] = same
    any_[order[1:]] = same
    any_[order[:-1]] |= same
    return any_, later


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def score(docs: DataFrame, models: DataFrame) -> DataFrame:
    """doc_id, lang, COUNTS, surprise (mean negative log-probability; null for empty texts), n_chars per row of docs(doc_id, text, lang)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    path = models.stored_at

    def run(batches):
        for part, texts in text_steps(batches):
            found = load_models(path)
            counts = base_counts(texts)
            hi, lo, rows = grams(part.column(1).to_pylist())
            langs = np.array(part.column(2).to_pylist(), object)
            sizes = np.bincount(rows, minlength=texts.n)
            sums = np.zeros(texts.n)
            for lang in set(langs[sizes > 0]):
                at = np.flatnonzero((langs == lang)[rows])
                order, begins, first = distinct(gram_hash(hi[at], lo[at], ORDER))
                logs = found[lang].gram_logs(hi[at][first], lo[at][first])
                sums += np.bincount(rows[at][order], weights=np.repeat(logs, np.diff(np.r_[begins, len(order)])), minlength=texts.n)
            columns = [pa.array(counts[c]) for c in COUNTS]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), *columns, pa.array(-sums / np.maximum(sizes, 1), mask=sizes == 0), pa.array(sizes), part.column(3)], names)

    names = ["doc_id", "lang", *COUNTS, "surprise", "n_chars", "th"]
    rows = docs.select("doc_id", "text", "lang", F.xxhash64("text").alias("th"))
    return map_batches(rows, run, f"doc_id {id_type}, lang string, {', '.join(f'{c} long' for c in COUNTS)}, surprise double, n_chars long, th long")


def score_pieces(docs: DataFrame, models: DataFrame, middles: dict[str, float]) -> DataFrame:
    """th, excess: how far the pieces of each text of docs(text, th) lie from the middle of the language that each fits best, per character."""
    path = models.stored_at

    def run(batches):
        for part, _ in text_steps(batches):
            hi, lo, rows = grams(part.column(0).to_pylist())
            n = part.num_rows
            sizes = np.bincount(rows, minlength=n)
            pieces = -(-sizes // PIECE)
            first = np.cumsum(pieces) - pieces
            at = first[rows] + (np.arange(len(rows)) - (np.cumsum(sizes) - sizes)[rows]) // PIECE
            lengths = np.bincount(at, minlength=pieces.sum())
            best = np.full(pieces.sum(), np.inf)
            order, begins, first_seen = distinct(gram_hash(hi, lo, ORDER))
            repeats, at_sorted = np.diff(np.r_[begins, len(order)]), at[order]
            for lang, model in load_models(path).items():
                logs = np.repeat(model.gram_logs(hi[first_seen], lo[first_seen]), repeats)
                sums = np.bincount(at_sorted, weights=logs, minlength=len(best))
                off = -sums - middles[lang] * lengths
                best = np.where(np.abs(off) < np.abs(best), off, best)
            excess = np.bincount(np.repeat(np.arange(n), pieces), weights=best, minlength=n) / np.maximum(sizes, 1)
            yield pa.RecordBatch.from_arrays([part.column(1), pa.array(excess)], ["th", "excess"])

    return map_batches(docs, run, "th long, excess double")


def bands(scored: DataFrame, *, fewest: int = FEWEST) -> DataFrame:
    """(lang, middle, and below and above it: between, char) of surprise: the squared spread of a text of n characters is between + char / n.

    A language of n documents leans on the spreads of all like one that has `fewest` more documents of these.
    """

    def median(x):
        return F.percentile_approx(x, 0.5, 10_000)

    scored = scored.filter("surprise is not null").select("lang", "surprise", "n_chars")
    middle = scored.groupBy("lang").agg(median("surprise").alias("middle"), median("n_chars").alias("half"), F.count("*").alias("n"))
    away = scored.join(F.broadcast(middle), "lang").withColumn("away", F.col("surprise") - F.col("middle"))  # one row per label
    found = [F.first("middle").alias("middle"), F.first("n").alias("n")]
    for side, on in (("below", F.col("away") < 0), ("above", F.col("away") > 0)):
        for part, mine in (("short", F.col("n_chars") < F.col("half")), ("long", F.col("n_chars") >= F.col("half"))):
            found.append(median(F.when(on & mine, F.abs("away"))).alias(f"{side}_{part}"))
            found.append(median(F.when(on & mine, 1 / F.greatest("n_chars", F.lit(1)))).alias(f"{side}_{part}_n"))
    rows = [r.asDict() for r in away.groupBy("lang").agg(*found).collect()]  # one per label
    spreads = []
    for r in rows:
        for side in ("below", "above"):
            short, long, short_n, long_n = (r[f"{side}_{k}"] for k in ("short", "long", "short_n", "long_n"))
            # one character strays by a nat or more; a whole language by LEAST or more between texts
            char = 1.0
            if None not in (short, long) and short_n > long_n:
                char = max(1.0, ((1.4826 * short) ** 2 - (1.4826 * long) ** 2) / (short_n - long_n))
            between = max(LEAST**2, (1.4826 * long) ** 2 - char * long_n) if long is not None else LEAST**2
            r |= {f"{side}_between": between, f"{side}_char": char}
        spreads.append([r[k] for k in SPREADS])
    all_n = np.array([r["n"] for r in rows], float)[:, None]
    own = np.array(spreads, float).reshape(-1, len(SPREADS))
    pooled = (own * all_n).sum(axis=0) / max(all_n.sum(), 1)
    leaned = (own * all_n + fewest * pooled) / (all_n + fewest)
    table = [(r["lang"], float(r["middle"]), *map(float, x)) for r, x in zip(rows, leaned)]
    return scored.sparkSession.createDataFrame(table, "lang string, middle double, " + ", ".join(f"{k} double" for k in SPREADS))


SPREADS = ["below_between", "below_char", "above_between", "above_char"]


def quality_rules(docs: DataFrame, *, width: float = WIDTH, fewest: int = FEWEST) -> DataFrame:
    """Per row of docs(doc_id, text, lang): doc_id, COUNTS, base_failed, kept, surprise."""
    # one row per label; labels of few documents share a model with null
    own = [r["lang"] for r in docs.filter("lang is not null").groupBy("lang").agg(F.count("*").alias("n")).filter(F.col("n") >= fewest).collect()]
    docs = docs.select("doc_id", plain_text().alias("text"), F.when(F.col("lang").isin(own), F.col("lang")).otherwise("").alias("lang"))
    models = store_models(docs.select("text", "lang"))
    scored = materialise(score(docs, models))
    limits = bands(scored, fewest=fewest)
    middles = {r["lang"]: r["middle"] for r in limits.collect()}  # one row per label
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    reach = {side: width * F.sqrt(F.col(f"{side}_between") + F.col(f"{side}_char") / F.greatest("n_chars", F.lit(1))) for side in ("below", "above")}
    away = F.col("surprise") - F.col("middle")
    judged = scored.join(F.broadcast(limits), "lang", "left").select("doc_id", "th", *COUNTS, "surprise", failed.alias("base_failed"), away.alias("away"), (-reach["below"]).alias("low"), reach["above"].alias("high"))
    # texts outside their limits, by pieces
    outside = materialise(judged.filter("not base_failed and not (away between low and high)").select("th").distinct())
    wanted = F.broadcast(outside) if outside.count() <= SMALL else outside
    texts = docs.select("text", F.xxhash64("text").alias("th")).join(wanted, "th", "left_semi").dropDuplicates(["th"]).select("text", "th")
    pieces = materialise(score_pieces(texts, models, middles))
    discard(models, outside)
    fits = F.expr("away between low and high or coalesce(excess between low and high, false)")
    return judged.join(pieces, "th", "left").select("doc_id", *COUNTS, "base_failed", (~F.col("base_failed") & F.coalesce(fits, F.lit(False))).alias("kept"), "surprise")
