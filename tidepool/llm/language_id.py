"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are runs of one to three characters of the lower-cased text, with everything but letters turned into
a word border, hashed into BUCKETS places. Document frequencies are counted by Spark over all learning
documents. The weights are fitted by follow-the-regularised-leader with an elastic-net penalty on a bounded
sample of labelled documents (SAMPLE rows in all on average, dealt evenly over the languages and chosen by a
hash of the id), and a temperature is fitted on a fifth of that sample that the weights do not see. A text of
any length is scored over all of its n-grams.

The term frequency is a share of the text's n-grams, so a score is a mean of one weight per n-gram: a table
lookup, with no per-document vectors. As softmax shares sum up to 1 for any text, the best share is multiplied by
the chance that the text is of a learned language at all: Spark counts the n-grams of each language over all
learning documents, and the mean log-frequency of a text's n-grams (each in the language where it is most
frequent, so texts that mix learned languages are not punished) is held against that of labelled documents, each
without its own counts. Letter junk and unlearned languages lie more than FLOOR deviations below. Null texts and texts without a letter are `und` with score 0; so is
everything if no row can be learned from. Ties go to the language that is first in the alphabet. Rows are
independent; columns other than the id, the text and the label are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import map_batches, plain_text, text_steps

BUCKETS = 1 << 15
#: Bound of the labelled rows that the weights are fitted on.
SAMPLE = 2_000
SCALE = 20.0
#: Deviations below a language's usual n-gram frequency at which a text is as likely of no learned language.
FLOOR = 7.0
UNKNOWN = "und"

_letters: np.ndarray | None = None


def letter_table() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x30000)), bool, 0x30000)
    return _letters


def features(texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Per kind of n-gram the row and the bucket of each; and which rows have a letter."""
    lowered = [t.lower() for t in texts]
    points = np.frombuffer("\n".join([*lowered, ""]).encode("utf-32-le"), np.uint32)
    rows = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in lowered])
    letter = letter_table()[np.minimum(points, 0x2FFFF)]
    c = np.where(letter, points, 32).astype(np.uint64)
    with_letter = np.zeros(len(texts), bool)
    with_letter[rows[letter]] = True
    owners, buckets = [], []
    for n in (1, 2, 3):
        size = max(0, len(c) - n + 1)
        if n == 1:
            keep = letter
        elif n == 2:
            keep = letter[:size] | letter[1:]
            keep &= rows[:size] == rows[1:]
        else:
            keep = letter[1 : size + 1] & (rows[:size] == rows[n - 1 :])
        at = np.flatnonzero(keep)
        h = np.full(len(at), n, np.uint64)
        for k in range(n):
            h = (h ^ c[at + k]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        owners.append(rows[at])
        buckets.append((h * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(49)).astype(np.int64))
    return owners, buckets, with_letter


def _per_row(texts: list[str]):
    """(row, its buckets) for each row."""
    owners, buckets, _ = features(texts)
    cuts = [np.searchsorted(o, np.arange(len(texts) + 1)) for o in owners]
    for r in range(len(texts)):
        yield r, np.concatenate([b[c[r] : c[r + 1]] for b, c in zip(buckets, cuts)])


class FtrlSoftmax:
    """Multinomial logistic regression by FTRL-proximal with L1 and L2 penalties."""

    def __init__(self, n_features: int, n_classes: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.02):
        self.z, self.n = np.zeros((n_features, n_classes)), np.zeros((n_features, n_classes))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * self.l1 - z
        return np.where(np.abs(z) <= self.l1, 0.0, shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        p = softmax(x @ w)
        p[label] -= 1
        g = x[:, None] * p
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits under which the labels, smoothed by one doubtful case, are most likely."""
    n, k = logits.shape if len(labels) else (0, 0)
    if n == 0 or k < 2:
        return 1.0
    wanted = np.full((n, k), 1 / (n + 2) / (k - 1))
    wanted[np.arange(n), labels] = 1 - 1 / (n + 2)
    tried = np.geomspace(0.05, 20, 121)
    loss = [-(wanted * np.log(np.maximum(softmax(logits / t), 1e-12))).sum(axis=1).mean() for t in tried]
    return float(tried[int(np.argmin(loss))])


def fit(docs: DataFrame, *, sample: int = SAMPLE, epochs: int = 6) -> dict:
    """A model from docs(doc_id, text, lang): languages, table (weight of each bucket), temperature."""
    docs = docs.filter("lang is not null and text is not null").select("doc_id", "text", "lang")
    counts = {r["lang"]: r["n"] for r in docs.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(counts)
    if not languages:
        return {"languages": [], "table": np.zeros((BUCKETS, 0), np.float32), "temperature": 1.0, "known": None}

    def frequencies(batches):
        seen, counted = np.zeros(BUCKETS, bool), {}
        for part, _ in text_steps(batches):
            langs = part.column(1).to_pylist()
            for r, buckets in _per_row(part.column(0).to_pylist()):
                documents, uses = counted.setdefault(langs[r], (np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)))
                seen[buckets] = True
                documents += seen
                seen[:] = False
                uses += np.bincount(buckets, minlength=BUCKETS)
        for lang, (documents, uses) in counted.items():
            at = np.flatnonzero(documents)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(documents[at]), pa.array(uses[at])], ["lang", "bucket", "n", "uses"])

    found = map_batches(docs.select("text", "lang"), frequencies, "lang string, bucket long, n long, uses long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"), F.sum("uses").alias("uses")).toArrow().to_pandas()
    df, uses = np.zeros(BUCKETS), np.zeros((BUCKETS, len(languages)))
    np.add.at(df, found["bucket"], found["n"])
    uses[found["bucket"], found["lang"].map(languages.index).to_numpy(int)] = found["uses"]
    idf = np.log((1 + sum(counts.values())) / (1 + df)) + 1

    quota = sample / len(languages)
    shares = docs.sparkSession.createDataFrame([(k, min(1.0, quota / n)) for k, n in counts.items()], "lang string, share double")
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)
    picked = docs.join(F.broadcast(shares), "lang").filter(chance < F.col("share"))

    def vectors(batches):
        for part, _ in text_steps(batches, "text"):
            ids, at, n = [], [], []
            for r, buckets in _per_row(part.column(1).to_pylist()):
                u, c = np.unique(buckets, return_counts=True)
                at.append(u.astype(np.int32))
                n.append(c.astype(np.int32))
                ids.append(r)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(at, pa.list_(pa.int32())), pa.array(n, pa.list_(pa.int32()))], ["k", "lang", "at", "n"])

    rows = picked.select(F.crc32(F.concat(F.lit("order"), F.col("doc_id").cast("string"))).alias("k"), "text", "lang")
    rows = map_batches(rows, vectors, "k long, lang string, at array<int>, n array<int>").toArrow().to_pandas().sort_values("k", kind="stable")
    counted = [(a, n, languages.index(k)) for a, n, k in zip(rows["at"], rows["n"], rows["lang"]) if len(a)]
    examples = [(a, SCALE * n / n.sum() * idf[a], languages.index(k)) for a, n, k in zip(rows["at"], rows["n"], rows["lang"]) if len(a)]
    held, used = examples[::5], [e for i, e in enumerate(examples) if i % 5]
    model = FtrlSoftmax(BUCKETS, len(languages))
    rng = np.random.default_rng(7)
    for _ in range(epochs):
        for i in rng.permutation(len(used)):
            model.learn(*used[i])
    weights = model.weights()
    logits = np.array([x @ weights[at] for at, x, _ in held]).reshape(-1, len(languages))
    temperature = fit_temperature(logits, np.array([y for _, _, y in held], int))
    return {"languages": languages, "table": (weights * idf[:, None] * SCALE).astype(np.float32), "temperature": temperature, "known": fit_known(uses, counted)}


def log_frequencies(uses: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Smoothed log share of n-grams, in the language where it is greatest; uses has a column per language."""
    return np.log((uses + 0.5) / (totals + 0.5 * BUCKETS)).max(axis=-1)


def fit_known(uses: np.ndarray, rows: list[tuple[np.ndarray, np.ndarray, int]]) -> dict[str, np.ndarray]:
    """log: frequency of each bucket; per language the usual mean over a text, its deviation between texts and that of one n-gram.

    rows are labelled texts (buckets, their counts, language), held against all other texts.
    """
    totals, k = uses.sum(axis=0), uses.shape[1]
    means, within, labels = [], [], []
    for at, n, label in rows:
        others, rest = uses[at], totals.copy()
        others[:, label] = np.maximum(others[:, label] - n, 0)
        rest[label] = max(rest[label] - n.sum(), 0)
        logs = log_frequencies(others, rest)
        mean = (n * logs).sum() / n.sum()
        means.append(mean)
        within.append((n * (logs - mean) ** 2).sum() / n.sum())
        labels.append(label)
    means, within, labels = np.array(means), np.array(within), np.array(labels, int)
    if not len(means):
        return {"log": log_frequencies(uses, totals), "middle": np.full(k, -np.inf), "between": np.ones(k), "gram": np.ones(k)}

    def usual(mine):
        middle = np.median(means[mine])
        return np.array([middle, 1.4826 * np.median(np.abs(means[mine] - middle)), np.sqrt(np.median(within[mine]))])

    pooled = usual(np.ones(len(means), bool))
    sizes = np.bincount(labels, minlength=k)[:, None]  # few texts: shrunk towards all
    own = np.array([usual(labels == j) if sizes[j, 0] else pooled for j in range(k)])
    middle, between, gram = ((sizes * own + 10 * pooled) / (sizes + 10)).T
    return {"log": log_frequencies(uses, totals), "middle": middle, "between": np.maximum(between, 0.02), "gram": gram}


def deviations(known: dict[str, np.ndarray], means: np.ndarray, total: np.ndarray, best: np.ndarray) -> np.ndarray:
    """How far mean log-frequencies of texts with total n-grams lie from what is usual in their best languages."""
    # the n-grams of one to three characters overlap: about as much is learned from a sixth of them
    spread = np.sqrt(known["between"][best] ** 2 + 6 * known["gram"][best] ** 2 / np.maximum(total, 1))
    return (means - known["middle"][best]) / spread


def predict(model: dict, texts: list[str]) -> tuple[list[str], np.ndarray]:
    """Language of each text, and the probability that it is of this language and not of an unlearned one or none."""
    names = model["languages"]
    owners, buckets, with_letter = features(texts)
    if not names:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    total = sum(np.bincount(o, minlength=len(texts)) for o in owners)
    logits = np.zeros((len(texts), len(names)))
    for j in range(len(names)):
        column = np.ascontiguousarray(model["table"][:, j])
        for o, b in zip(owners, buckets):
            logits[:, j] += np.bincount(o, weights=column[b], minlength=len(texts))
    p = softmax(logits / np.maximum(total, 1)[:, None] / model["temperature"])
    best = p.argmax(axis=1)
    means = sum(np.bincount(o, weights=model["known"]["log"][b], minlength=len(texts)) for o, b in zip(owners, buckets)) / np.maximum(total, 1)
    known = 1 / (1 + np.exp(np.clip(-FLOOR - deviations(model["known"], means, total, best), -500, 500)))
    chosen = [names[b] if ok else UNKNOWN for b, ok in zip(best, with_letter)]
    return chosen, np.where(with_letter, p[np.arange(len(texts)), best] * known, 0.0)


def held_out():
    """The rows that nothing is learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


def identify(docs: DataFrame, model: dict | None = None) -> DataFrame:
    """Per row of docs(doc_id, text, lang): doc_id, held_out, lang_pred, score. Without a model, one is fitted on the rows not held out."""
    model = fit(docs.filter(~held_out())) if model is None else model
    id_type = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for part, _ in text_steps(batches):
            names, scores = predict(shared.value, part.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(names, pa.string()), pa.array(scores)], ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), plain_text().alias("text"))
    return map_batches(rows, run, f"doc_id {id_type}, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, *, least_score: float = 0.25, model: dict | None = None) -> DataFrame:
    """The rows of docs, all columns as they are, whose language is known with least_score or more."""
    model = fit(docs.filter(~held_out())) if model is None else model
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for part, _ in text_steps(batches):
            names, scores = predict(shared.value, [t or "" for t in part.column(part.schema.get_field_index("text")).to_pylist()])
            yield part.filter(pa.array([n != UNKNOWN and s >= least_score for n, s in zip(names, scores)], pa.bool_()))

    return map_batches(docs, run, docs.schema)


def accuracy(predicted: DataFrame, docs: DataFrame):
    """Rows and share of right languages, held out and not, over rows with a label."""
    joined = predicted.join(docs.filter("lang is not null").select("doc_id", "lang"), "doc_id")
    return joined.groupBy("held_out").agg(F.count("*").alias("rows"), F.avg((F.col("lang_pred") == F.col("lang")).cast("double")).alias("right")).toPandas()
