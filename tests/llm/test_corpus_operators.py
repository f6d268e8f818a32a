"""Operators that hold documents against each other, packing and the pipeline."""

import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from tidepool.llm import components, language_id, near_dedup, packing, queries, secret_scan, spot_signatures, substring_dedup

from . import brute
from .fixtures import SCHEMA, awkward_rows, frame, with_clashing_columns

LIBRARY = Tokenizer.from_file(P.path("byte_bpe_50k.json"))


def rows_of(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


def test_near_dedup(spark):
    got = near_dedup.near_dedup(with_clashing_columns(frame(spark)))
    assert rows_of(got, "doc_id", "n_shingles", "component_id", "kept") == brute.near_dedup(awkward_rows())


def test_near_dedup_of_drifting_copies(spark):
    """Copies that are alike only by way of others, and groups that share half of their words."""
    import random

    r = random.Random(8)
    rows, base = [], [f"w{i}" for i in range(120)]
    for group in range(3):
        text = base[:60] + [f"g{group}x{i}" for i in range(60)]
        for k in range(25):
            text = text.copy()
            text[r.randrange(120)] = f"e{group}y{k}"
            rows.append((len(rows), " ".join(text), None, None, None))
    r.shuffle(rows)
    assert rows_of(near_dedup.near_dedup(frame(spark, rows)), "doc_id", "n_shingles", "component_id", "kept") == brute.near_dedup(rows)


def test_keep_one_of_each(spark):
    want = {d for d, _, c, k in brute.near_dedup(awkward_rows()) if k}
    kept = near_dedup.keep_one_of_each(frame(spark))
    assert kept.columns == frame(spark).columns and rows_of(kept, "doc_id") == Counter({(d,): 1 for d in want})


def test_components(spark):
    import random

    r = random.Random(2)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)]
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        lo, hi = sorted((top(a), top(b)))
        parent[hi] = lo
    want = {(x, top(x)) for a, b in links if a != b for x in (a, b)}
    got = components.components(spark.createDataFrame(links, "a long, b long"))
    assert set(map(tuple, got.collect())) == want and got.count() == len(want)
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_substring_dedup(spark):
    got = substring_dedup.substring_dedup(with_clashing_columns(frame(spark)))
    assert rows_of(got, "doc_id", "n_words", "n_removed", "kept_sha256") == brute.substring_dedup(awkward_rows())


def test_substring_borders(spark):
    """Passages of 34, 35 and 36 words, overlaps, repeats in one text."""
    w = [f"w{i}" for i in range(400)]
    texts = [w[:34] + ["a"], w[:34] + ["b"], w[50:85] + ["c"], ["d"] + w[50:85], w[100:136], ["e"] + w[100:136], w[200:260], w[210:270], w[230:290] * 2, ["z"] * 40, ["z"] * 35, ["y"] * 35]
    rows = [(i, " \n".join(t), None, None, None) for i, t in enumerate(texts)]
    assert rows_of(substring_dedup.substring_dedup(frame(spark, rows)), "doc_id", "n_words", "n_removed", "kept_sha256") == brute.substring_dedup(rows)


def test_remove_repeats(spark):
    rows = awkward_rows()
    split, gone = brute.repeated_words([r[1] for r in rows])
    want = Counter((r[0], " ".join(x for i, x in enumerate(w) if i not in g)) for r, w, g in zip(rows, split, gone) if not w or len(g) < len(w))
    got = substring_dedup.remove_repeats(frame(spark))
    assert got.columns == frame(spark).columns
    assert Counter((r["doc_id"], " ".join(brute.WORD.findall(r["text"] or ""))) for r in got.collect()) == want


def check_pieces(pieces, rows, size=1024):
    ids = defaultdict(list)
    for r in rows:
        ids[r[0]].append(np.array([*LIBRARY.encode(r[1] or "", add_special_tokens=False).ids, 0], "<u4"))
    want = Counter()
    got = Counter()
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
        same = [t for t in ids[p["doc_id"]] if len(t) == p["doc_tokens"] and zlib.crc32(t[p["start"] : p["start"] + p["length"]].tobytes()) == p["ids_crc32"]]
        assert same
        got[p["doc_id"]] += p["length"]
    for k, texts in ids.items():
        want[k] = sum(map(len, texts))
    assert got == want
    padding = 0
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at and length > 0
            at += length
        assert at <= size
        padding += 0 if at & (at - 1) == 0 else size - at
    return padding


def test_packing(spark):
    rows = awkward_rows()
    assert check_pieces(packing.pack(with_clashing_columns(frame(spark))).collect(), rows) < 1024
    many = [(i, "word " * (i % 9 * 40 + 3), None, None, None) for i in range(600)]
    pieces = packing.pack(frame(spark, many)).collect()
    sequences = len({p["sequence_id"] for p in pieces})
    assert check_pieces(pieces, many) <= 1024 + packing.MOST_WASTE * sequences
    assert len(pieces) <= len(many) + 9  # hardly a document is cut


def fewest_sequences(pieces, size):
    """By trying all ways."""
    best = len(pieces)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(pieces):
            best = len(rooms)
            return
        for j in {r: j for j, r in enumerate(rooms) if r >= pieces[i]}.values():
            place(i + 1, [*rooms[:j], rooms[j] - pieces[i], *rooms[j + 1 :]])
        place(i + 1, [*rooms, size - pieces[i]])

    place(0, [])
    return best


def patterns_of(size, lengths):
    if not lengths:
        return [()]
    k = lengths[0]
    return [(n, *rest) for n in range(size // k + 1) for rest in patterns_of(size - n * k, lengths[1:])]


def test_linear_program_against_all_ways():
    r = np.random.default_rng(6)
    for _ in range(40):
        size = int(r.integers(6, 14))
        pieces = sorted(r.integers(1, size, r.integers(1, 9)).tolist(), reverse=True)
        demand = np.bincount(pieces, minlength=size + 1)
        found = packing.solve_patterns(demand, size, gap=1e-9)
        assert found.asked >= 1 and found.bound == pytest.approx(found.value, abs=1e-6)
        assert found.value <= fewest_sequences(pieces, size) + 1e-6
        covered = np.zeros(size + 1)
        for pattern, times in found.patterns:
            assert sum(k * n for k, n in pattern.items()) <= size
            for k, n in pattern.items():
                covered[k] += n * times
        assert covered == pytest.approx(demand)
        # the knapsack against every pattern there is
        lengths = sorted(set(pieces))
        price = np.full(size + 1, -1.0)
        price[lengths] = r.random(len(lengths))
        every = [sum(n * price[k] for n, k in zip(p, lengths)) for p in patterns_of(size, lengths)]
        assert packing.best_pattern(price, size)[0] == pytest.approx(max(every))


def test_cutting_stock_layout():
    r = np.random.default_rng(4)
    for n in (1, 5, 300, 20_000):
        demand = np.bincount(r.integers(1, 1024, n), minlength=1025)
        least = -(-int((demand * np.arange(1025)).sum()) // 1024)
        for most_waste in (0, packing.MOST_WASTE):
            rows, sequences = packing.layout(demand, 1024, most_waste)
            assert sequences == least if most_waste == 0 else least <= sequences <= least * 1.001 + 1
            placed = np.zeros(1025, int)
            for length, lo, hi, *_ in sorted(rows):
                assert lo == placed[length]
                placed[length] = hi
            assert (placed == demand).all()
        if n == 20_000:  # what the program decides isn't undone by cutting
            assert sum(hi - lo for _, lo, hi, *_, loose in rows if loose) < 0.03 * n
    assert packing.layout(np.zeros(1025, int), 1024, 0) == ([], 0)
    worth, pattern = packing.best_pattern(np.array([-1.0, -1, 0.3, 0.5] + [-1] * 6), 9)
    assert worth == pytest.approx(1.5) and pattern == {3: 3}


def test_pricing_runs_at_every_size(sf_dir):
    """Of documents: pricing is asked, and ends within the gap of Farley's bound or proves the optimum."""
    import duckdb

    texts = [t or "" for (t,) in duckdb.sql(f"SELECT text FROM '{sf_dir}/documents.parquet'").fetchall()]
    rest = [len(packing.token_ids(t, "byte_bpe_50k.json", 0)) % 1024 for t in texts]
    demand = np.bincount([k for k in rest if k], minlength=1025)
    for times in (1, 100):
        found = packing.solve_patterns(demand * times, 1024)
        assert found.asked >= 2 and found.value - found.bound <= packing.GAP * found.value
        assert found.bound >= (demand * times * np.arange(1025)).sum() / 1024 - 1e-6


def test_spot_signatures(spark):
    rows = [r for r in awkward_rows() if r]
    got = spot_signatures.compare_edited(with_clashing_columns(frame(spark))).collect()
    assert len(got) == len(rows)
    key = {}
    for r in got:
        key.setdefault(r["doc_id"], r)
        assert key[r["doc_id"]] == r  # repeated rows have one result
    texts = {r[0]: r[1] or "" for r in rows}
    order = sorted(texts, reverse=True)
    same = defaultdict(set)
    for i, d in enumerate(order):
        follower = order[(i + 1) % len(order)]
        text, n = texts[d], len(texts[d]) // 2
        edited = text[: len(text) - n] + texts[follower][:n]
        r = key[d]
        same[text].add(r["fingerprint"])
        a, b, c = (set(x.split()) for x in (r["fingerprint"], r["edited_fingerprint"], key[follower]["fingerprint"]))
        assert r["n_chars"] == len(text) and r["edited_sha256"] == sha256(edited.encode()).hexdigest()
        assert r["near_edited"] == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
        assert r["near_next"] == pytest.approx(len(a & c) / len(a | c) if a | c else 1.0)
    assert all(len(f) == 1 for f in same.values())


def test_spot_pairs(spark):
    df = frame(spark)
    pairs, member = spot_signatures.near_pairs(df)
    sets = {}
    fingerprints = {r["doc_id"]: frozenset(r["fingerprint"].split()) for r in spot_signatures.compare_edited(df).collect()}
    member = set(map(tuple, member.collect()))
    for d, c in member:
        sets.setdefault(c, fingerprints[d])
        assert fingerprints[d] == sets[c]
    want = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.75 * len(sets[a] | sets[b])}
    assert {(r["a"], r["b"]) for r in pairs.collect()} == want


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    for run in (near_dedup.near_dedup, substring_dedup.substring_dedup, packing.pack, secret_scan.scan_secrets, language_id.identify, spot_signatures.compare_edited, near_dedup.keep_one_of_each, substring_dedup.remove_repeats):
        assert run(none).count() == 0
    from tidepool.llm import bpe_codec, html_extract, quality_rules, token_counts

    for run in (bpe_codec.encode_decode, token_counts.token_counts, quality_rules.quality_rules):
        assert run(none).count() == 0
    assert html_extract.extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_queries_have_their_columns():
    assert [q.split("_")[0] for q in queries.QUERIES] == [f"op{n}" for n in range(1, 11)]
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rows = awkward_rows()
    frame(spark).write.parquet(str(tmp_path / "documents.parquet"))
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    model = language_id.fit(frame(spark).filter(~language_id.held_out()))
    names, scores = language_id.predict(model, [r[1] or "" for r in rows])
    docs = [r for r, n, s in zip(rows, names, scores) if n != "und" and s >= 0.25]
    kept = {d for d, _, _, k in brute.near_dedup(docs) if k}
    docs = list({(r[0], r[1]): r for r in docs if r[0] in kept}.values())
    split, gone = brute.repeated_words([r[1] for r in docs])
    # white space between kept words stays as it was, so pieces are held against the stage's own texts
    stage = substring_dedup.remove_repeats(frame(spark, docs))
    left = {r["doc_id"]: r["text"] for r in stage.collect()}
    assert {d: brute.WORD.findall(t) for d, t in left.items()} == {r[0]: [x for i, x in enumerate(w) if i not in g] for r, w, g in zip(docs, split, gone) if len(g) < len(w)}
    final = [(d, secret_scan.redact(t, secret_scan.all_spans(t)[1])) for d, t in left.items()]
    assert check_pieces(pieces, final) < 1024


def test_null_ids_and_clashing_columns(spark):
    rows = awkward_rows()
    rows += [(None, rows[9][1], "en", None, None), (None, rows[8][1], None, None, None), (None, "word " * 1500, "en", None, None), (None, None, None, None, None)]
    df = with_clashing_columns(frame(spark, rows))
    assert rows_of(substring_dedup.substring_dedup(df), "doc_id", "n_words", "n_removed", "kept_sha256") == brute.substring_dedup(rows)
    kept = substring_dedup.remove_repeats(df)
    assert kept.columns == df.columns and kept.filter("th = '0' and gone = '11' and `_doc` = '18'").count() == kept.count() > 0
    assert check_pieces(packing.pack(df).collect(), rows) < 1024
    near = near_dedup.near_dedup(df)
    assert near.count() == len(rows) and near.filter("doc_id is null and kept and component_id is null").count() == 4
    assert near_dedup.keep_one_of_each(df).columns == df.columns
    spots = spot_signatures.compare_edited(df)
    assert spots.count() == len(rows) and spots.filter("doc_id is null").count() == 4
    assert language_id.identify(df).count() == len(rows) and language_id.keep_identified(df).columns == df.columns
    assert secret_scan.redact_secrets(df).columns == df.columns
