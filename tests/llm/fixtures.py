"""Small documents with the awkward cases that every operator has to take."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(r, n):
    return " ".join("".join(r.choice(("ta", "lo", "mi", "ren", "the", "é", "un")) for _ in range(r.randint(1, 3))) for _ in range(n))


def awkward_rows(seed=3):
    """Nulls in any column, empty and very long texts, ties, repeated rows, near copies, shared passages."""
    r = random.Random(seed)
    passage = words(r, 60)
    base = words(r, 200).split()
    texts = [None, "", " \t\n\v ", "one", "one two three", "The cat is on the mat.\nThe cat is on the mat.\nx", passage, f"{words(r, 50)} {passage} {words(r, 20)}", f"{passage}\n\n{words(r, 10)}"]
    texts += [" ".join(base), " ".join(base), " ".join(base).upper(), " ".join(base[:190] + ["x"] * 10), " ".join(base[:100] + words(r, 100).split())]
    texts += ["a" * 3000, words(r, 5000), words(r, 36) * 3, "日本語 テキスト 😀 ascii", "token = abcdefgh12345678 <|endoftext|> deadbeef" * 3]
    for k in range(30):  # a group of near copies that drift apart
        changed = base.copy()
        for _ in range(k // 3):
            changed[r.randrange(200)] = f"w{r.randrange(9)}"
        texts.append(" ".join(changed))
    texts += [words(r, r.randint(1, 120)) for _ in range(20)]
    rows = [(i * 7 % 997, t, ("en", "fr", None)[i % 3], None if i % 5 == 0 else "s", None) for i, t in enumerate(texts)]
    return rows + [rows[9], rows[7], rows[0]]  # repeated rows


def frame(spark, rows=None):
    return spark.createDataFrame(awkward_rows() if rows is None else rows, SCHEMA).repartition(5)


def with_clashing_columns(df):
    """Extra columns named like results and helpers of the operators."""
    from pyspark.sql import functions as F

    extra = ["th", "kept", "component_id", "score", "lang_pred", "n_tokens", "spans", "start", "bucket", "rep", "fp", "gone", "_w", "key", "i", "n", "h", "dk", "_doc", "_th"]
    return df.select("*", *(F.lit(str(i)).alias(c) for i, c in enumerate(extra)))
