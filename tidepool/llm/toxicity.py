"""Toxicity: a convolutional text classifier on hashed word embeddings.

Words are runs of letters and digits, in lower case. A word's features are its whole form and its first 4, 5 and 6
bytes; each feature's vector is read from two hashed tables, half from each, so that features which meet in one table
differ in the other, and a word's vector is the sum over its features. Filters of WIDTHS successive words run over the
whole text, each keeps its greatest response, and a logistic layer weighs these.

All labelled rows are learned from. A fifth of them, chosen by a hash of the id, is kept from the weights and sets the
thresholds; the others are dealt to workers of about WORKER_BYTES of text. In each round every worker goes once over its
rows with Adam (numpy), from the weights of the last round, and Spark adds up what the workers changed: a number's change
is the mean over the workers that moved it, weighted by how often they did. Sums are of whole numbers and a worker's rows
come in the order of a hash, so the order of the input doesn't matter; which rows a worker has follows from the join. Either label has half of the weight.
Features of fewer than two texts stay at zero, in training and after; the texts are counted by Spark.

Thresholds are set by language on counts of responses in steps of 1 / STEP, each drawn towards that of all languages
where it has few toxic texts, and a temperature is fitted. A score is 1 / (1 + exp((threshold - response) /
temperature)), so 0.5 is the threshold. The language is found in the text, by the counts of character n-grams in all
labelled rows of each language (naive Bayes); tables' `lang` is never read for a score.

Null, empty and wordless texts get the score of a text without any response. Labels other than 0 and 1 and null labels
are not learned from; several labels of a document are rows of their own. If only one label is there to learn from,
all scores are 0 (label 0 or none) or 1. Documents are scored independently: repeated rows, null ids and ties need no
care, and an empty table gives no rows. A very long text is scored whole, as one numpy step. Columns other than the id,
the text and (to learn from) lang, and the labels' other columns, are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from . import language_id
from ._common import discard, map_batches, materialise, plain_text, text_steps

#: Bytes of text that one worker goes over in a round.
WORKER_BYTES = 24 << 20
#: Rows of each of the two embedding tables, numbers in a row.
BUCKETS, HALF = 1 << 17, 8
WIDTHS, FILTERS = (1, 2, 3), 8
#: Bytes of the prefixes of a word that are features; 0 is the whole word.
PREFIXES = (0, 4, 5, 6)
#: Texts of a training step; rounds, and steps of a worker below which more rounds follow (up to MOST_ROUNDS).
BATCH, ROUNDS, STEPS, MOST_ROUNDS = 32, 3, 500, 12
#: Parts of 1 in which changes of weights are added up; steps of responses in 1, and their bound.
PARTS, STEP, MOST_RESPONSE = 1 << 20, 64, 100
#: Share of words left out of a training step, so that no text is known by a single word.
DROPPED = 0.3
#: Toxic texts at which a language's own threshold counts half.
HALF_TRUST = 10.0

_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def fold(buf: np.ndarray) -> np.ndarray:
    """UTF-8 bytes in lower case (ASCII and Latin-1 letters), with 0 for what is no part of a word."""
    out = K.lower_ascii(buf).copy()
    out[~_WORD[buf]] = 0
    if len(buf) > 1:
        lead, next_ = buf[:-1], buf[1:]
        after = np.flatnonzero((lead == 0xC3) & (next_ >= 0x80) & (next_ <= 0x9E) & (next_ != 0x97)) + 1
        out[after] += 0x20
        signs = np.flatnonzero((lead == 0xC2) & (next_ >= 0xA0) & (next_ <= 0xBF) & ~np.isin(next_, (0xAA, 0xB5, 0xBA)))
        out[signs] = out[signs + 1] = 0
        dashes = np.flatnonzero((lead == 0xE2) & (next_ == 0x80))  # dashes, quotes, dots and spaces of U+2000 to U+203F
        for k in range(3):
            at = dashes + k
            out[at[at < len(out)]] = 0
    return out


def word_features(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per word and feature a 64-bit hash (0 where a word is too short for the prefix), and the row of each word."""
    if not len(buf):
        return np.empty((0, len(PREFIXES)), np.uint64), np.empty(0, np.int64)
    low = fold(buf)
    inside = low > 0
    first, last = np.zeros(len(low), bool), np.zeros(len(low), bool)
    border = offs[(offs > 0) & (offs < len(low))]
    first[0] = last[-1] = True
    first[1:], last[:-1] = ~inside[:-1], ~inside[1:]
    first[border] = True
    last[border - 1] = True
    starts, ends = np.flatnonzero(inside & first), np.flatnonzero(inside & last) + 1
    sums = np.zeros(len(low) + 1, np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * K.powers(K.BASE[0], len(low)), out=sums[1:])
    unshift = K.powers(K.INVERSE[0], len(low))[starts]
    out = np.zeros((len(starts), len(PREFIXES)), np.uint64)
    for j, size in enumerate(PREFIXES):
        stop = np.minimum(starts + size, ends) if size else ends
        h = K.mix((sums[stop] - sums[starts]) * unshift + np.uint64(0x2545F4914F6CDD1D * (j + 1) % (1 << 64)))
        out[:, j] = np.where((ends - starts > size) | (size == 0), h | np.uint64(1), np.uint64(0))
    return out, np.searchsorted(offs, starts, "right") - 1


def places(features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows of the two tables for each feature; row 0 for none."""
    bits = np.uint64(64 - (BUCKETS.bit_length() - 1))
    one, two = (features >> bits).astype(np.int32), (K.mix(features.copy()) >> bits).astype(np.int32)
    none = features == 0
    one[none] = two[none] = 0
    return np.where(none, 0, np.maximum(one, 1)), np.where(none, 0, np.maximum(two, 1))


class Network:
    """Embedding tables, filters and the logistic layer."""

    def __init__(self, numbers: np.ndarray | None = None, seed: int = 5):
        """All weights are views of numbers: the rows of both tables, then the others in rows as long."""
        shapes = [*((w, 2 * HALF, FILTERS) for w in WIDTHS), (len(WIDTHS) * FILTERS,), (len(WIDTHS) * FILTERS,), (1,)]
        ends = np.cumsum([np.prod(x) for x in shapes])
        fresh = numbers is None
        self.numbers = np.zeros((2 * BUCKETS - ends[-1] // -HALF, HALF), np.float32) if fresh else numbers
        self.tables = [self.numbers[:BUCKETS], self.numbers[BUCKETS : 2 * BUCKETS]]
        rest = self.numbers[2 * BUCKETS :].reshape(-1)
        *self.filters, self.bias, self.out, self.shift = (rest[e - np.prod(x) : e].reshape(x) for x, e in zip(shapes, ends))
        if fresh:
            rng = np.random.default_rng(seed)
            for w, spread in [*((t, 0.05) for t in self.tables), *((f, 0.5) for f in self.filters), (self.out, 0.3)]:
                w[:] = rng.normal(0, spread, w.shape)

    def __reduce__(self):
        return Network, (self.numbers,)

    def embed(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        x = np.zeros((len(one), 2 * HALF), np.float32)
        for j in range(one.shape[1]):
            x[:, :HALF] += self.tables[0][one[:, j]]
            x[:, HALF:] += self.tables[1][two[:, j]]
        return x

    def pooled(self, x: np.ndarray, borders: np.ndarray, begins: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Per text and filter the greatest response above 0, and (if begins) the word where it begins; borders are n + 1 positions."""
        n = len(borders) - 1
        best, where = np.zeros((n, len(self.bias)), np.float32), np.full((n, len(self.bias)), -1)
        full = np.flatnonzero(np.diff(borders) > 0)
        if not len(full):
            return best, where
        left = np.repeat(borders[1:], np.diff(borders)) - np.arange(len(x))  # words to the end of the text
        for k, f in enumerate(self.filters):
            got = np.zeros((len(x), FILTERS), np.float32)
            for j in range(len(f)):
                part = x[j:] @ f[j]
                part[left[: len(x) - j] <= j] = 0
                got[: len(x) - j] += part
            at = slice(k * FILTERS, (k + 1) * FILTERS)
            got += self.bias[at]
            top = np.maximum.reduceat(got, borders[:-1][full], axis=0)
            best[full, at] = np.maximum(top, 0)
            for c in range(FILTERS if begins else 0):
                hit = np.flatnonzero(got[:, c] == np.repeat(top[:, c], np.diff(borders)[full]))
                row = np.searchsorted(borders, hit, "right") - 1
                rows, first = np.unique(row, return_index=True)
                where[rows, k * FILTERS + c] = hit[first]
        return best, where

    def responses(self, best: np.ndarray) -> np.ndarray:
        return best @ self.out + self.shift


class Adam:
    def __init__(self, shapes: list[tuple[int, ...]], rate: float):
        self.m, self.v = [np.zeros(s, np.float32) for s in shapes], [np.zeros(s, np.float32) for s in shapes]
        self.rate, self.t = rate, 0

    def step(self, weights: list[np.ndarray], grads: list) -> None:
        """grads holds arrays like the weights, or (rows, gradients of these rows)."""
        self.t += 1
        scale = self.rate * np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        for w, g, m, v in zip(weights, grads, self.m, self.v):
            at, g = g if isinstance(g, tuple) else (slice(None), g)
            m[at] = 0.9 * m[at] + 0.1 * g
            v[at] = 0.999 * v[at] + 0.001 * g * g
            w[at] -= scale * m[at] / (np.sqrt(v[at]) + 1e-6)


class Learner:
    """Adam steps on a copy of a network, and how often each row of its numbers was moved."""

    def __init__(self, start: np.ndarray, kept: np.ndarray, seed: tuple[int, ...], decay: float = 1e-4):
        self.start, self.kept, self.decay = start, kept, decay
        self.net, self.rng = Network(start.copy()), np.random.default_rng(seed)
        self.params = [*self.net.tables, *self.net.filters, self.net.bias, self.net.out]
        self.adam = Adam([p.shape for p in self.params], 0.01)
        self.moved = np.zeros(len(start), np.int64)

    def step(self, one: list[np.ndarray], two: list[np.ndarray], toxic: np.ndarray, weight: np.ndarray) -> None:
        """One step on texts given as rows of the two tables per word."""
        net = self.net
        borders = np.r_[0, np.cumsum([len(x) for x in one])]
        at = [np.concatenate(one), np.concatenate(two)]
        x = net.embed(*at)
        dropped = self.rng.random(len(x)) < DROPPED
        x[dropped] = 0
        best, where = net.pooled(x, borders)
        p = 1 / (1 + np.exp(np.clip(-net.responses(best), -500, 500)))
        d = ((p - toxic) * weight / len(one)).astype(np.float32)
        active = (best > 0) & (where >= 0)
        d_best = np.where(active, d[:, None] * net.out, 0).astype(np.float32)
        d_filters = [np.zeros_like(f) for f in net.filters]
        words, d_words = [], []
        for k, f in enumerate(net.filters):
            rows, cols = np.nonzero(active[:, k * FILTERS : (k + 1) * FILTERS])
            begin, g = where[rows, k * FILTERS + cols], d_best[rows, k * FILTERS + cols]
            for j in range(len(f)):
                inside = begin + j < borders[rows + 1]
                inside[inside] = ~dropped[begin[inside] + j]
                w, c, gj = begin[inside] + j, cols[inside], g[inside]
                np.add.at(d_filters[k][j].T, c, gj[:, None] * x[w])
                words.append(w)
                d_words.append(gj[:, None] * f[j][:, c].T)
        words, d_words = np.concatenate(words), np.concatenate(d_words)
        d_tables = []
        for t in range(2):
            feature = at[t][words]
            target, back = np.unique(feature, return_inverse=True)
            g = np.zeros((len(target), HALF), np.float32)
            for j in range(feature.shape[1]):
                np.add.at(g, back.reshape(feature.shape)[:, j], d_words[:, t * HALF : (t + 1) * HALF])
            ok = self.kept[t][target]
            target, g = target[ok], g[ok]
            d_tables.append((target, g + self.decay * net.tables[t][target]))
            self.moved[target + t * BUCKETS] += 1
        grads = [*d_tables, *(g + self.decay * f for g, f in zip(d_filters, net.filters)), d_best.sum(axis=0), best.T @ d + self.decay * net.out]
        self.adam.step(self.params, grads)
        net.shift -= np.float32(0.05) * d.sum()
        self.moved[2 * BUCKETS :] += 1

    def moves(self) -> pa.RecordBatch:
        """Rows moved: their number, how often, and their changes times that, in whole PARTS."""
        at = np.flatnonzero(self.moved)
        change = (self.net.numbers[at].astype(np.float64) - self.start[at]) * self.moved[at, None]
        columns = [at, self.moved[at], *np.rint(change * PARTS).astype(np.int64).T]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["at", "times", *CHANGES])


CHANGES = [f"c{k}" for k in range(HALF)]


def _by_text(texts) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rows of the two tables, per word of each text."""
    features, row = word_features(texts.buf, texts.offs)
    one, two = places(features)
    cuts = np.searchsorted(row, np.arange(texts.n + 1))
    return [(one[s:e], two[s:e]) for s, e in zip(cuts, cuts[1:])]


def train(rows: DataFrame, counts: dict[int, int], workers: int, kept: np.ndarray) -> Network:
    """A network from all of rows(worker, toxic, text), each worker's together and in order: counts of the labels, table rows that may move."""
    n = sum(counts.values())
    heavy = np.array([n / 2 / max(counts.get(y, 0), 1) for y in (0, 1)])
    rounds = min(max(ROUNDS, -(STEPS * BATCH * workers // -max(n, 1))), MOST_ROUNDS)
    net = Network()
    for table, keep in zip(net.tables, kept):
        table[~keep] = 0
    for k in range(rounds):
        shared = rows.sparkSession.sparkContext.broadcast((net.numbers, kept))

        def run(batches, k=k, shared=shared):
            learner, worker, held = None, None, []

            def step():
                one, two, toxic = zip(*held)
                learner.step(list(one), list(two), np.array(toxic), heavy[list(toxic)])
                held.clear()

            for part, texts in text_steps(batches):
                for (one, two), toxic, own in zip(_by_text(texts), part.column(1).to_pylist(), part.column(0).to_pylist()):
                    if own != worker:
                        if held:
                            step()
                        if learner:
                            yield learner.moves()
                        learner, worker = Learner(*shared.value, (11, k, own)), own
                    held.append((one, two, toxic))
                    if len(held) == BATCH:
                        step()
            if held:
                step()
            if learner:
                yield learner.moves()

        moves = map_batches(rows.select("worker", "toxic", "text"), run, "at long, times long, " + ", ".join(f"{c} long" for c in CHANGES))
        summed = materialise(moves.groupBy("at").agg(*(F.sum(c).alias(c) for c in ["times", *CHANGES])))
        total = summed.toArrow()
        discard(summed)
        change = np.stack([total.column(c).to_numpy() for c in CHANGES], axis=1) / total.column("times").to_numpy()[:, None] / PARTS
        net.numbers[total.column("at").to_numpy()] += change.astype(np.float32)
        shared.unpersist()
    return net


def count_rows(rows: DataFrame) -> tuple[np.ndarray, dict]:
    """Of all rows(toxic, text, lang, fold): table rows of two or more texts that weights are learned from, and the languages' n-grams."""

    def run(batches):
        seen, grams = np.zeros(2 * BUCKETS, np.int64), {}
        for part, texts in text_steps(batches):
            for (one, two), fold_ in zip(_by_text(texts), part.column(2).to_pylist()):
                if fold_:
                    seen[one] += 1  # a place counts once, however often it occurs
                    seen[two + BUCKETS] += 1
            langs = np.array(part.column(1).to_pylist(), object)
            owners, buckets, _ = language_id.features(part.column(0).to_pylist())
            for lang in {x for x in langs if x is not None}:
                mine = langs == lang
                have = grams.setdefault(lang, np.zeros(language_id.BUCKETS, np.int64))
                for o, b in zip(owners, buckets):
                    have += np.bincount(b[mine[o]], minlength=len(have))
        for lang, n in [(None, np.minimum(seen, 2)), *grams.items()]:
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(n[at])], ["lang", "at", "n"])

    counted = map_batches(rows.select("text", "lang", "fold"), run, "lang string, at long, n long").groupBy("lang", "at").agg(F.sum("n").alias("n")).toArrow()
    lang, at, n = np.array(counted.column(0).to_pylist(), object), counted.column(1).to_numpy(), counted.column(2).to_numpy()
    seen = np.zeros(2 * BUCKETS, np.int64)
    of_words = lang == None  # noqa: E711
    seen[at[of_words]] = n[of_words]
    kept = (seen >= 2).reshape(2, BUCKETS)
    kept[:, 0] = False
    names = sorted({x for x in lang[~of_words]})
    uses = np.zeros((len(names), language_id.BUCKETS))
    for j, name in enumerate(names):
        uses[j, at[lang == name]] = n[lang == name]
    return kept, {"names": names, "logs": np.log((uses + 0.5) / (uses.sum(axis=1, keepdims=True) + 0.5 * language_id.BUCKETS))}


def languages_of(languages: dict, texts: list[str]) -> list[str]:
    """The likeliest language of each text; UNKNOWN without letters."""
    names = languages["names"]
    if not names or not texts:
        return [language_id.UNKNOWN] * len(texts)
    owners, buckets, with_letter = language_id.features(texts)
    likely, logs = np.zeros((len(texts), len(names))), languages["logs"]
    for o, b in zip(owners, buckets):
        first = np.flatnonzero(np.diff(o, prepend=-1))
        if len(first):
            for j, own in enumerate(logs):
                likely[o[first], j] += np.add.reduceat(own[b], first)
    return [names[k] if ok else language_id.UNKNOWN for k, ok in zip(likely.argmax(axis=1), with_letter)]


def threshold(z: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> float:
    """The cut with the best weighted F1, halfway between the responses around it."""
    order = np.argsort(-z, kind="stable")
    z, w, y = z[order], weight[order], toxic[order] * weight[order]
    f1 = 2 * np.cumsum(y) / (np.cumsum(w) + y.sum())
    f1[:-1][z[1:] == z[:-1]] = -1  # equal responses fall on one side
    k = int(np.argmax(f1))
    return float((z[k] + z[k + 1]) / 2) if k + 1 < len(z) else float(z[k] - 1)


def calibrate(z: np.ndarray, toxic: np.ndarray, weight: np.ndarray, langs: list[str]) -> dict:
    """Thresholds by language, of all languages, and the temperature under which the labels are most likely."""
    if not toxic.any() or toxic.all():
        return {"by_lang": {}, "all": 0.0, "temperature": 1.0}
    general, by_lang, langs = threshold(z, toxic, weight), {}, np.array(langs, object)
    for lang in set(langs):
        mine = langs == lang
        n = float((toxic * weight)[mine].sum())
        if n and not toxic[mine].all():
            by_lang[lang] = (n * threshold(z[mine], toxic[mine], weight[mine]) + HALF_TRUST * general) / (n + HALF_TRUST)
    moved = z - np.array([by_lang.get(k, general) for k in langs])
    wanted = (toxic * weight.sum() + 0.5) / (weight.sum() + 1)
    tried = np.geomspace(0.05, 20, 121)
    loss = [(weight * np.logaddexp(0, moved / t) - weight * wanted * moved / t).sum() for t in tried]
    return {"by_lang": by_lang, "all": general, "temperature": float(tried[int(np.argmin(loss))])}


def held_out():
    """The rows whose labels nothing is learned from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """A model from all of docs(doc_id, text, lang) and labels(doc_id, toxic) but the rows held out."""
    marks = labels.filter(F.col("toxic").isin(0, 1)).select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter(~held_out()).distinct()
    fold_ = F.pmod(F.xxhash64("doc_id", F.lit(19)), F.lit(5))
    sizes = docs.select("doc_id", F.octet_length(plain_text()).alias("size")).join(marks, "doc_id")
    about = sizes.groupBy("toxic", (fold_ > 0).alias("used")).agg(F.count("*").alias("n"), F.sum("size").alias("size")).collect()
    if len({r["toxic"] for r in about}) < 2:
        return {"only": float(max((r["toxic"] for r in about), default=0))}
    workers = max(1, round(sum(r["size"] for r in about) / WORKER_BYTES))
    # texts are shuffled once, by the join; its partitions, put together, are the workers' rows
    rows = docs.filter(~held_out()).select("doc_id", plain_text().alias("text"), "lang").join(marks.hint("merge"), "doc_id").coalesce(workers)
    rows = rows.select(F.spark_partition_id().alias("worker"), F.xxhash64("doc_id", F.lit(17)).alias("h"), "toxic", "text", "lang", fold_.alias("fold"))
    # one file and row group per worker, so that no later stage has to bring its rows together again
    rows = materialise(rows.sortWithinPartitions("h", "text", "toxic", "lang"), "zstd", **{"parquet.block.size": 256 << 20})
    kept, languages = count_rows(rows)
    net = train(rows.filter("fold > 0"), {r["toxic"]: r["n"] for r in about if r["used"]}, workers, kept)
    shared = docs.sparkSession.sparkContext.broadcast((net, languages))

    def run(batches):
        net, languages = shared.value
        for part, texts in text_steps(batches):
            z = np.clip(respond(net, texts), -MOST_RESPONSE, MOST_RESPONSE)
            steps = np.floor(z * STEP).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(languages_of(languages, part.column(1).to_pylist()), pa.string()), pa.array(steps), part.column(0)], ["lang", "z", "toxic"])

    got = map_batches(rows.filter("fold = 0").select("toxic", "text"), run, "lang string, z long, toxic int")
    got = got.groupBy("lang", "z", "toxic").agg(F.count("*").alias("n")).toArrow().to_pandas().sort_values(["lang", "z", "toxic"])
    discard(rows)
    z, toxic, n = ((got["z"].to_numpy() + 0.5) / STEP, got["toxic"].to_numpy(), got["n"].to_numpy(np.float64))
    return {"net": net, "languages": languages, **calibrate(z, toxic, n, got["lang"].tolist())}


def respond(net: Network, texts) -> np.ndarray:
    """The network's response to each text."""
    features, row = word_features(texts.buf, texts.offs)
    best, _ = net.pooled(net.embed(*places(features)), np.searchsorted(row, np.arange(texts.n + 1)), begins=False)
    return net.responses(best)


def score(model: dict, texts, strings: list[str]) -> np.ndarray:
    """Scores of the texts of a step (as bytes and as strings)."""
    if "only" in model:
        return np.full(texts.n, model["only"])
    cut = np.array([model["by_lang"].get(k, model["all"]) for k in languages_of(model["languages"], strings)])
    return 1 / (1 + np.exp(np.clip((cut - respond(model["net"], texts)) / model["temperature"], -500, 500)))


def score_documents(docs: DataFrame, labels: DataFrame, model: dict | None = None) -> DataFrame:
    """Per row of docs(doc_id, text, lang): doc_id, held_out, score, predicted. Without a model, one is fitted on labels(doc_id, toxic)."""
    model = fit(docs, labels) if model is None else model
    shared = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for part, texts in text_steps(batches):
            s = score(shared.value, texts, part.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select("doc_id", held_out().alias("held_out"), plain_text().alias("text"))
    return map_batches(rows, run, f"doc_id {id_type}, held_out boolean, score double, predicted int")
