"""Cross-tokenizer alignment, hard negatives and toxicity, against brute force and the libraries."""

import random
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidepool.llm import hard_negatives as H
from tidepool.llm import queries, token_alignment, toxicity
from tidepool.llm._common import Texts

from .fixtures import SCHEMA, awkward_rows, frame, with_clashing_columns

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"


def plain_alignment(rows):
    """The contract's columns per row, from whole texts."""
    pair = token_alignment.tokenizer_pair(A, B)
    found, counts = [], Counter()
    for _, text, *_ in rows:
        a, b = (pair.a.encode(" " + text, add_special_tokens=False).ids, pair.b.encode(text)) if text else ([], [])
        spans = []
        for ids, table in ((a, pair.a_bytes), (b, pair.b_bytes)):
            at, own = 0, []
            for i in ids:
                own.append((at, at + len(table[i]), i))
                at += len(table[i])
            spans.append(own)
        raw = (" " + text).encode() if text else b""
        if not text or any(b"".join(t[i] for i in ids) != raw for ids, t in ((a, pair.a_bytes), (b, pair.b_bytes))):
            found.append(None)
            continue
        cuts = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, links, start = [], [], 0
        for cut in cuts:
            in_a, in_b = ([x for x in own if start <= x[0] and x[1] <= cut] for own in spans)
            groups.append(",".join(str(x[2]) for x in in_a) + "|" + ",".join(str(x[2]) for x in in_b))
            links += [(x[2], y[2]) for x in in_a for y in in_b if x[0] < y[1] and y[0] < x[1]]
            start = cut
        counts.update(links)
        found.append((len(a), len(b), groups, links))
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = Counter()
    for (key, *_), x in zip(rows, found):
        if x is None:
            out[key, 0, 0, 0, 0, 0, 0, ""] += 1
        else:
            n_a, n_b, groups, links = x
            out[key, n_a, n_b, len(groups), len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links), ";".join(groups)] += 1
    return out


def more_texts():
    r = random.Random(4)
    texts = [" ", "  ", "a ", " a", "a  \n", "\n", "\nabc", "a\tb\n\n c\r\nd", "x  y　z", "▁a", "a▁ b", "a\x0bb\x0c c\x1cd\x85e", "<s> </s> <unk> <0x41> <|endoftext|>", "ﬁ Å é ①", "it's we'll  'd", "a" * 5000, "x " * 3000, "😀 😀​ 日本 語", "a\x00b"]
    return texts + ["".join(r.choice(" \n\tab1.'é日 ") for _ in range(r.randint(1, 60))) for _ in range(60)]


NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def test_alignment(spark, monkeypatch):
    monkeypatch.setattr(token_alignment, "CHUNK_BYTES", 2_000)  # workers of this session may have theirs
    rows = [r for r in awkward_rows() if r[1] is None or len(r[1]) < 20_000] + [(2000 + i, t, None, None, None) for i, t in enumerate(more_texts())] + [(None, "no id here", None, None, None)]
    docs = frame(spark, rows)
    got = token_alignment.align_tokens(with_clashing_columns(docs))
    assert Counter(tuple(r) for r in got.select("doc_id", *NUMBERS, "groups").collect()) == plain_alignment(rows)
    digests = token_alignment.align_tokens(docs, digests=True).select("doc_id", "groups_sha256").collect()
    want = Counter((k[0], sha256(k[-1].encode()).hexdigest() if k[-1] else "") for k in plain_alignment(rows).elements())
    assert Counter(map(tuple, digests)) == want


def test_alignment_with_pairs_joined_by_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(token_alignment, "PAIRS_HELD", 3)
    rows = [(i, t, None, None, None) for i, t in enumerate(more_texts())]
    got = token_alignment.align_tokens(frame(spark, rows))
    assert Counter(tuple(r) for r in got.select("doc_id", *NUMBERS, "groups").collect()) == plain_alignment(rows)


def test_alignment_of_nothing(spark):
    assert token_alignment.align_tokens(frame(spark, []), digests=True).count() == 0
    only_null = token_alignment.align_tokens(frame(spark, [(1, None, None, None, None)]), digests=True).collect()
    assert [tuple(r) for r in only_null] == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_id_pairs(spark):
    rows = [(i, t, None, None, None) for i, t in enumerate(["the cat", "the cats", "a hat the", "ﬁ"])]
    want = Counter()
    for text in (r[1] for r in rows):
        for group in next(iter(plain_alignment([(0, text)])))[-1].split(";"):
            a, b = (x.split(",") for x in group.split("|"))
            if len(a) == 1 or len(b) == 1:
                want.update((int(x), int(y)) for x in a for y in b)
    got = {(r["a"], r["b"]): r["n"] for r in token_alignment.id_pairs(frame(spark, rows)).collect()}
    assert all(got[k] == n for k, n in want.items())


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\r ab1'.é"), st.characters(codec="utf-8")), max_size=40))
def test_segments_encode_alone(text):
    """Cutting texts into segments changes no token of either tokenizer."""
    pair = token_alignment.tokenizer_pair(A, B)
    assert " " in pair.cuts and "\n" in pair.cuts and "\r" not in pair.cuts
    parts = pair.segments(" " + text)
    assert "".join(parts) == " " + text
    if text and "▁" not in text:
        assert [i for x in pair.a_ids(parts) for i in x] == pair.a.encode(" " + text, add_special_tokens=False).ids
        assert [i for x in pair.b_ids(parts) for i in x] == pair.b.encode(text)


VECTORS = "vec_id long, embedding array<float>, label int, score double, key int"


def plain_negatives(rows, moved=True):
    """The contract in plain Python."""
    fit = []
    for key, vec, label, *_ in rows:
        if key is None or label is None or vec is None or any(x is None or not np.isfinite(x) for x in vec):
            continue
        whole = [int(np.floor(256.0 * float(np.float32(x)))) for x in vec]
        fit.append((key, (label + 1) % 10 if moved and key % 7 == 0 else label, whole))
    out = Counter()
    dot = lambda x, y: sum(a * b for a, b in zip(x, y))
    for key, label, vec in fit:
        if key % 100:
            continue
        scored = sorted(((-dot(vec, v), k, lab) for k, lab, v in fit if k != key))
        for p, pid, _ in [x for x in scored if x[2] == label][:5]:
            fits = [x for x in scored if x[2] != label and 30 * -p <= 100 * -x[0] <= 90 * -p][:10]
            out.update((key, pid, i + 1, nid, -p, -n) for i, (n, nid, _) in enumerate(fits))
    return out


def vector_rows(seed, n, size=6, scale=1.0):
    r = np.random.default_rng(seed)
    rows = [(i * 50, [float(np.float32(x)) for x in r.normal(0, scale, size)], int(r.integers(0, 4)), 0.5, 1) for i in range(n)]
    same = rows[3][1]
    rows += [(10_000 + i, same, i % 2, None, None) for i in range(120)]  # ties
    rows += [(7_001, None, 1, None, None), (7_002, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1, None, None), (7_003, [float("nan")] * size, 1, None, None)]
    rows += [(7_004, [float("inf")] + [0.0] * (size - 1), 1, None, None), (7_005, same, None, None, None), (None, same, 1, None, None), (7_006, [0.0] * size, 1, None, None), (7_007, [0.5], 2, None, None), (7_100, [0.0] * size, 2, None, None)]
    return rows


def test_hard_negatives(spark, monkeypatch):
    for seed, scale in ((1, 0.2), (2, 40.0)):
        rows = vector_rows(seed, 90, scale=scale)
        got = H.mine_embeddings(spark.createDataFrame(rows, VECTORS).repartition(3))
        assert Counter(map(tuple, got.collect())) == plain_negatives(rows)


def test_hard_negatives_of_huge_vectors_and_repeated_rows(spark):
    rows = vector_rows(5, 40, scale=1e6)
    assert Counter(map(tuple, H.mine_embeddings(spark.createDataFrame(rows, VECTORS)).collect())) == plain_negatives(rows)
    rows = vector_rows(6, 60)
    rows += [rows[4], rows[2], rows[9]]
    assert Counter(map(tuple, H.mine_embeddings(spark.createDataFrame(rows, VECTORS)).collect())) == plain_negatives(rows)


def test_hard_negatives_of_nothing(spark):
    assert H.mine_embeddings(spark.createDataFrame([], VECTORS)).count() == 0
    assert H.mine_embeddings(spark.createDataFrame([(1, [1.0], 1, None, None)], VECTORS)).count() == 0
    assert H.mine_embeddings(spark.createDataFrame([(100, [], 1, None, None), (101, [], 1, None, None), (102, [], 2, None, None)], VECTORS)).count() == 1


def test_brackets_hold():
    """Every score lies between its brackets, and brackets drop pairs of clustered rows."""
    r = np.random.default_rng(3)
    middle = r.normal(0, 100, (5, 8))
    rows = np.floor(middle[r.integers(0, 5, 400)] + r.normal(0, 5, (400, 8)))
    longest = float((rows**2).sum(axis=1).max())
    pivots = H.choose_pivots(rows)
    low, high = H.brackets((rows[:20] ** 2).sum(axis=1), H.anchor_distances(rows[:20], pivots, longest), H.row_distances(rows, pivots, longest), longest)
    exact = rows[:20] @ rows.T
    assert (low <= exact).all() and (exact <= high).all()
    tenth = np.sort(exact, axis=1)[:, -10]
    assert (high < tenth[:, None]).mean() > 0.5


def test_alignment_composes_portions(spark):
    """Portions of chunks are composed and stored one after the other: the result holds no shuffle, and all rows."""
    rows = [(i, f"words of row {i} and of row {i % 7}", "en", None, None) for i in range(300)]
    whole = frame(spark, rows).repartition(8)
    got = token_alignment.align_tokens(whole)
    assert "CoGroups" not in got._jdf.queryExecution().toString()
    assert sorted(r["doc_id"] for r in got.collect()) == list(range(300))
    one = token_alignment.align_tokens(frame(spark, rows).coalesce(1))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, got.collect()))


def toxic_rows(n=500):
    """Plain texts in two languages; every fourth holds words of a small set, or others with the same beginning."""
    r = random.Random(12)
    syllables = {"en": ("ta", "lo", "mi", "ren", "the", "un"), "fr": ("é", "vou", "la", "eau", "que", "on")}
    rows, labels = [], []
    for i in range(n):
        lang = ("en", "fr")[i % 2]
        text = ["".join(r.choice(syllables[lang]) for _ in range(r.randint(1, 4))) for _ in range(r.randint(5, 80))]
        if bad := i % 4 >= 2:
            for _ in range(r.randint(2, 5)):
                word = r.choice(("scoundrel", "Blackguard", "knave")) if lang == "en" else "vilain" + r.choice(("e", "s", "es", "ement", "ie"))
                text.insert(r.randrange(len(text) + 1), word + r.choice(("", ",", "!")))
        rows.append((i, " ".join(text), lang, "s", None))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_toxicity(spark):
    rows, labels = toxic_rows()
    marks = spark.createDataFrame([*labels, (3, 0, None), (9_999, 1, 1), (4, 1, 7)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(frame(spark, rows), marks)
    got = toxicity.score_documents(frame(spark, rows), marks, model).collect()
    assert len(got) == len(rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    held = [r for r in got if r["held_out"]]
    right = [r["predicted"] == labels[r["doc_id"]][2] for r in held]
    assert len(held) > 60 and sum(right) / len(right) > 0.95
    assert set(model["by_lang"]) == {"en", "fr"}
    # a score reads the text only
    other = [(k, t, "zz", None, 5) for k, t, *_ in rows]
    again = toxicity.score_documents(with_clashing_columns(frame(spark, other)), marks, model).collect()
    assert {(r["doc_id"], r["score"]) for r in again} == {(r["doc_id"], r["score"]) for r in got}
    awkward = toxicity.score_documents(frame(spark), marks, model).collect()
    assert len(awkward) == len(awkward_rows()) and all(0 <= r["score"] < 0.5 for r in awkward if r["doc_id"] in (0, 7, 14))


def test_toxicity_learns_from_all_rows(spark):
    """Each word is in eight rows of one label, too few for any sample of some thousands; the languages come from counts of all rows too."""
    r = random.Random(21)
    words = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9)) for _ in range(3_000)]
    rows = [(i, f"the {words[i % 3_000]} of", "en", None, None) for i in range(24_000)]
    marks = spark.createDataFrame([(i, 1, i % 3_000 % 2) for i in range(24_000)], "doc_id long, quality int, toxic int")
    docs = frame(spark, rows)
    model = toxicity.fit(docs, marks)
    got = toxicity.score_documents(docs, marks, model).filter("held_out").collect()
    assert sum(x["predicted"] == x["doc_id"] % 2 for x in got) / len(got) > 0.97
    # the same model from rows in another order
    again = toxicity.fit(docs.repartition(7), marks.repartition(3))
    assert (again["net"].numbers == model["net"].numbers).all() and again["all"] == model["all"]


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = frame(spark, [(1, "a b", "en", None, None), (None, None, None, None, None)])
    assert {tuple(r) for r in toxicity.score_documents(docs, none).collect()} == {(1, False, 0.0, 0), (None, False, 0.0, 0)}
    assert toxicity.score_documents(frame(spark, []), none).count() == 0
    ones = spark.createDataFrame([(i, 1, 1) for i in range(9)], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in toxicity.score_documents(docs, ones).collect()} <= {0.0, 1.0}


def test_word_features():
    """Words are folded, cut at punctuation of one to three bytes, and known by their beginnings."""
    def words(*texts):
        t = Texts(pa.array(texts, pa.large_string()))
        return toxicity.word_features(t.buf, t.offs)

    f, row = words("Idiot, IDIOT«idiot» “idiot”… É", "", "é idiots", "idiot")
    assert row.tolist() == [0, 0, 0, 0, 0, 2, 2, 3]
    assert len({tuple(x) for x in f[[0, 1, 2, 3, 7]]}) == 1 and (f[4] == f[5]).all()
    assert f[6][0] != f[0][0] and f[6][1] == f[0][1] and f[6][2] == f[6][2]


def test_pooling_reads_whole_texts():
    """The last words of a very long text count; windows never join two texts."""
    net = toxicity.Network()
    r = np.random.default_rng(1)
    x = r.normal(0, 1, (50, 2 * toxicity.HALF)).astype(np.float32)
    borders = np.array([0, 20, 20, 21, 50])
    best, _ = net.pooled(x, borders)
    for i, (s, e) in enumerate(zip(borders, borders[1:])):
        own = np.zeros(len(net.bias))
        for k, f in enumerate(net.filters):
            for at in range(s, e):
                got = sum(x[at + j] @ f[j] for j in range(len(f)) if at + j < e) + net.bias[k * toxicity.FILTERS : (k + 1) * toxicity.FILTERS]
                own[k * toxicity.FILTERS : (k + 1) * toxicity.FILTERS] = np.maximum(own[k * toxicity.FILTERS : (k + 1) * toxicity.FILTERS], got)
        assert best[i] == pytest.approx(own, abs=1e-4)


@pytest.mark.parametrize("name", ["op11_token_alignment", "op12_hard_negatives", "op13_toxicity"])
def test_queries_cover_their_tables(spark, sf_dir, name):
    got = queries.QUERIES[name](spark, sf_dir)
    key, table = ("anchor_id", "embeddings") if "op12" in name else ("doc_id", "documents")
    source = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    if table == "documents":
        assert sorted(r[0] for r in got.select(key).collect()) == sorted(r[0] for r in source.select(key).collect())
    else:
        assert {r[0] for r in got.select(key).collect()} <= {r[0] for r in source.filter("vec_id % 100 = 0").select("vec_id").collect()}
    assert SCHEMA.startswith("doc_id")
