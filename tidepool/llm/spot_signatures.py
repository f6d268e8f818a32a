"""Document fingerprints by SpotSigs, in DataFrame functions only.

A spot is an anchor (a very common word) with the chain of the next CHAIN content words after it; content
words are all but the common words. A text's signature set holds a 32-bit hash of each spot, and of the chain
that follows the text's beginning, so any text with a content word has a signature. A text without a single
anchor takes every word as one. Sets are compared by Jaccard; pairs are searched within partitions by set
length: sets alike in a share s differ in length by at most that factor, so each length is looked up in its
own class and the next, and only under the set's rarest signatures (its prefix).

Null text is an empty one: its fingerprint is "", and two empty fingerprints have likeness 1, one empty and
one other 0. Null ids are last in descending order. Rows equal in id and text count as one document and get the same result each; of rows with one
id and different texts, the order is that of a hash of the text. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import materialise, n_partitions, plain_text

CHAIN = 2
#: Anchors, by language (English, French, German, Spanish).
ANCHORS = """
a an is of that the was
est le la les que un une
das der die ein eine ist und
el es los que un una
""".split()
#: Other common words that are never part of a chain.
COMMON = """
and are as at be been but by for from had has have he her his i if in it its not on or our she so their them they this to we were which with you your
au aux avec ce ces dans de des du elle en et il ils je mais ne nous on ou par pas plus pour qui sa se ses son sur vous
als am an auch auf aus bei dem den des dass du er es für ich im in mit nach nicht sich sie sind von war wie wir zu zum zur
al con como de del en ha las lo más no nos o para pero por se si sin son su sus ya y
""".split()


def _quoted(words) -> str:
    return ", ".join(f"'{w}'" for w in sorted(set(words)))


def with_signatures(df: DataFrame, text: str, out: str) -> DataFrame:
    """df with `out`, the sorted distinct signatures of the column `text`; helper columns go again."""
    keep = df.columns
    anchors, common = _quoted(ANCHORS), _quoted([*ANCHORS, *COMMON])
    df = df.withColumn("_w", F.expr(f"filter(split(lower(`{text}`), '[^\\\\p{{L}}\\\\p{{N}}]+'), x -> x <> '')"))
    # a place knows how many content words come before it once both are numbered: all words before, less common ones before
    df = df.select(*keep, F.expr(f"transform(filter(transform(_w, (x, i) -> struct(x as w, i as i)), p -> p.w in ({common})), (p, j) -> struct(p.w as w, p.i - j as c))").alias("_p"), F.expr(f"filter(_w, x -> x not in ({common}))").alias("_c"))
    df = df.select(*keep, "_c", F.expr(f"filter(_p, p -> p.w in ({anchors}) and p.c < size(_c))").alias("_a"))
    chain = lambda start: ", ".join(f"get(_c, {start} + {k})" for k in range(CHAIN))
    spots = f"transform(_a, p -> hash(p.w, {chain('p.c')}))"
    every = f"transform(_c, (x, i) -> hash(x, {chain('i + 1')}))"
    first = f"case when size(_c) > 0 then array(hash('', {chain('0')})) else cast(array() as array<int>) end"
    spots = f"case when size(_a) > 0 then {spots} else {every} end"
    return df.select(*keep, F.expr(f"sort_array(array_distinct(concat({first}, {spots})))").alias(out))


def fingerprint(signatures: str) -> Column:
    """A set as text: its numbers, sorted, with a space between."""
    return F.concat_ws(" ", F.col(signatures).cast("array<string>"))


def likeness(a: str, b: str) -> Column:
    """Jaccard of two sets of signatures; where one is empty the sets are not opened."""
    shared = F.size(F.array_intersect(a, b))
    return (
        F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0)
        .when((F.size(a) == 0) | (F.size(b) == 0), 0.0)
        .otherwise(shared / (F.size(a) + F.size(b) - shared))
    )


KEY = ["dk", "th"]


def _followers(rows: DataFrame) -> DataFrame:
    """(dk, th, prev_dk, prev_th, prev_n): for each document the one that it is next to, in descending order of ids."""
    spark = rows.sparkSession
    keys = rows.select("doc_id", *KEY, F.length("text").cast("long").alias("n_chars")).distinct()
    down = [F.desc("doc_id"), F.asc("th")]
    keys = materialise(keys.repartitionByRange(n_partitions(spark), *down).select("*", F.spark_partition_id().alias("pid")))
    w = Window.partitionBy("pid").orderBy(*down)
    me = F.struct(*KEY, "n_chars")
    keys = keys.select("pid", *KEY, F.lag(me).over(w).alias("prev"), F.when(F.lead("dk").over(w).isNull(), me).alias("end"))
    ends = keys.filter("end is not null").select("pid", "end")  # one row per range
    over = Window.orderBy("pid")
    ends = ends.select("pid", F.lag("end").over(over).alias("before"), F.max_by("end", "pid").over(over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("very_last"))
    prev = F.coalesce("prev", "before", "very_last")
    linked = keys.join(ends, "pid").select(*KEY, prev.alias("prev"))
    return linked.select(*KEY, F.col("prev.dk").alias("prev_dk"), F.col("prev.th").alias("prev_th"), F.col("prev.n_chars").alias("prev_n"))


def compare_edited(docs: DataFrame) -> DataFrame:
    """The fingerprints of every document and of its edited text, and their likeness, for docs(doc_id, text).

    The edited text has the last floor(n / 2) code points replaced by the first as many of the next document.
    """
    rows = docs.select("doc_id", plain_text().alias("text"))
    # hashes of id and text tell documents apart and are never null
    rows = rows.select("doc_id", F.xxhash64("doc_id").alias("dk"), F.xxhash64("text").alias("th"), "text")
    links = materialise(_followers(rows))
    # both sides of the last join read the same columns of one exchange of texts and signatures
    base = with_signatures(rows, "text", "fp")
    half = F.floor(F.col("prev_n") / 2).cast("int")
    heads = base.join(links, KEY)
    heads = heads.select(F.col("prev_dk").alias("dk"), F.col("prev_th").alias("th"), F.col("text").substr(F.lit(1), half).alias("head"), F.col("fp").alias("next_fp"), F.col("doc_id").alias("next_id"))
    if rows.count() != links.count():  # rows equal in id and text
        heads = heads.dropDuplicates(KEY)
    both = base.join(heads, KEY).withColumn("n_chars", F.length("text").cast("long"))
    edited = F.concat(F.col("text").substr(F.lit(1), (F.col("n_chars") - F.floor(F.col("n_chars") / 2)).cast("int")), F.col("head"))
    both = both.select("doc_id", "next_id", "n_chars", "fp", "next_fp", edited.alias("edited"))
    return with_signatures(both, "edited", "efp").select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint("fp").alias("fingerprint"),
        fingerprint("efp").alias("edited_fingerprint"),
        likeness("fp", "efp").alias("near_edited"),
        likeness("fp", "next_fp").alias("near_next"),
        "next_id",
    )


def near_pairs(docs: DataFrame, share: float = 0.75) -> tuple[DataFrame, DataFrame]:
    """(pairs of class representatives, membership) of docs(doc_id, text) whose signature sets are alike by `share` or more.

    Documents of equal sets form a class, named by its smallest id. Pairs (a, b, likeness) are between classes.
    """
    rows = docs.select("doc_id", plain_text().alias("text"))
    sets = materialise(with_signatures(rows, "text", "fp").drop("text").filter("size(fp) > 0"))
    member = sets.groupBy("fp").agg(F.min("doc_id").alias("class"))
    classes = materialise(member.select("class", "fp", F.size("fp").alias("n")).withColumn("step", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1 / share))).cast("int")))
    sigs = classes.select("class", "n", "step", F.explode("fp").alias("s"))
    common = sigs.groupBy("s").agg(F.count("*").alias("df"))
    rare = Window.partitionBy("class").orderBy("df", "s")
    prefix = sigs.join(common.filter("df > 1"), "s").withColumn("r", F.row_number().over(rare))
    # signatures of one class only come first in the order and match nothing, so they take up places of the prefix
    alone = sigs.join(common.filter("df = 1"), "s").groupBy("class").agg(F.count("*").alias("alone"))
    prefix = prefix.join(alone, "class", "left").filter(F.col("r") + F.coalesce("alone", F.lit(0)) <= F.col("n") - F.ceil(share * F.col("n")) + 1)
    left = prefix.select("s", F.col("class").alias("a"), F.col("n").alias("na"), F.explode(F.array("step", F.col("step") - 1)).alias("step"))
    right = prefix.select("s", F.col("class").alias("b"), F.col("n").alias("nb"), "step")
    cand = left.join(right, ["s", "step"]).filter("a <> b and nb <= na").filter(F.col("nb") >= share * F.col("na"))
    cand = cand.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = cand.join(classes.select(F.col("class").alias("a"), F.col("fp").alias("fa")), "a").join(classes.select(F.col("class").alias("b"), F.col("fp").alias("fb")), "b")
    pairs = pairs.select("a", "b", likeness("fa", "fb").alias("likeness")).filter(F.col("likeness") >= share)
    return pairs, sets.join(member, "fp").select("doc_id", "class")
