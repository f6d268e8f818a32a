"""The name index against all pairs, and the partial score against every piece."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidepool.functions import similarity as S
from tidepool.functions import text as T
from tidepool.operators import matching

LETTERS = st.text("abc d", max_size=14)


def plain_partial(a, b):
    """Every piece, one after the other."""
    short, long = sorted((a, b), key=len)
    if not short:
        return 100.0 if not long else 0.0
    n = len(short)
    ways = [(short, long), (long, short)] if n == len(long) else [(short, long)]
    return max(S.ratio(s, t[max(0, i) : i + n]) for s, t in ways for i in range(1 - n, len(t)))


@settings(max_examples=1_500, deadline=None)
@given(LETTERS, LETTERS)
def test_partial_is_the_best_of_all_pieces(a, b):
    assert S.partial(a, b) == pytest.approx(plain_partial(a, b))


def test_partial_of_long_texts():
    rng = random.Random(3)
    long = "".join(rng.choice("abcdef") for _ in range(3_000))
    assert S.partial(long[1_234:1_300], long) == 100
    for _ in range(20):
        short = "".join(rng.choice("abcdef") for _ in range(rng.randint(1, 40)))
        part = long[: rng.randint(1, 300)]
        assert S.partial(short, part) == pytest.approx(plain_partial(short, part))


WORDS = "grand opera house arts center theatre museum of the dover milton rialto aa aaa ab a queen stageworks".split()


def changed(rng, name):
    for _ in range(rng.randint(0, 3)):
        at = rng.randrange(len(name) + 1)
        name = name[:at] + rng.choice(["", "x", "a", " "]) + name[at + rng.randint(0, 1) :]
    return name


def names(seed, n):
    rng = random.Random(seed)
    base = [" ".join(rng.choices(WORDS, k=rng.randint(1, 5))) for _ in range(n)]
    return base, [" ".join(rng.sample(w, len(w))) for w in ([changed(rng, x)][0].split() for x in base) if w]


@pytest.mark.parametrize("seed", [1, 2])
def test_names_resolve_as_among_all_pairs(spark, seed):
    base, asked = names(seed, 150)
    directory = spark.createDataFrame(list(enumerate(base)), "entry_id long, entry_name string")
    wanted = spark.createDataFrame([(x,) for x in asked], "name string").distinct()
    keys = {r["entry_id"]: r["key"] for r in directory.select("entry_id", F.coalesce(T.nz(T.norm_venue("entry_name")), F.lower("entry_name")).alias("key")).collect()}
    firsts = {}
    for i in sorted(keys):
        firsts.setdefault(keys[i], i)
    got = {r["name"]: r for r in matching.resolve_names(wanted, directory).collect()}
    own = {r["name"]: r["key"] for r in wanted.withColumn("key", T.norm_venue("name")).collect()}
    fuzzy = 0
    for name, key in own.items():
        if not key or key in firsts:
            continue
        best = max(firsts, key=lambda k: (S.token_set(key, k), -firsts[k]))
        mean = (S.token_set(key, best) + S.token_sort(key, best)) / 2
        assert got[name]["entry_id"] == (firsts[best] if mean >= matching.TAKEN else None), (name, best)
        if mean >= matching.TAKEN:
            assert got[name]["confidence"] == pytest.approx(mean)
            fuzzy += 1
    assert fuzzy > 10


def test_name_index_meets_few_pairs(spark):
    """Made-up words, as names have them: all likely pairs are met, and nearly no other."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(2, 4)))
    vocabulary = [word() for _ in range(600)]
    known = sorted({" ".join([*rng.sample(vocabulary, 2), rng.choice(["hall", "theatre", "center"])]) for _ in range(800)})
    asked = sorted({x[: (i := rng.randrange(len(x)))] + x[i + 1 :] for x in known})
    frame = lambda rows: spark.createDataFrame([(x,) for x in rows], "key string")
    met = {tuple(r) for r in matching.near_names(frame(asked), frame(known)).collect()}
    likely = {(a, b) for a in asked[:100] for b in known if max(S.token_set(a, b), S.token_sort(a, b)) >= matching.TAKEN}
    assert likely and likely <= met
    assert len(met) < 0.02 * len(asked) * len(known)


def test_empty_directory(spark):
    directory = spark.createDataFrame([], "entry_id long, entry_name string")
    got = matching.resolve_names(spark.createDataFrame([("grand hall",), (None,)], "name string"), directory).collect()
    assert [(r["entry_id"], r["confidence"]) for r in got] == [(None, 0.0)] * 2
