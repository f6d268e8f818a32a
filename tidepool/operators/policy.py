"""Which events are in scope: one ordered policy over columns, with a budget for the cases rules can't settle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo
from ..functions import taxonomy as C

#: What the tags of library calendars say.
LIBRARY_ARTS = {"Arts and Crafts": 11, "Book Discussions": 8}
LIBRARY_HINTS = ["Community and Culture", "History and Genealogy", "Literacy and Language"]
LIBRARY_DROPS = ["Story Time", "Jobs/Careers/Entrepreneurship", "Social Services", "Computers and eBooks", "Health and Wellness", "STREAM", "Cooking and Gardening"]


def budgeted(df: DataFrame, wants: Column, order: list, budget: int, out: str = "has_budget") -> DataFrame:
    """df with `out`: among the rows that want it, the first `budget` by order.

    The first ones are found by a sort and limit (each task keeps `budget` rows), never by ranking the whole table.
    The columns of `order` must tell rows apart.
    """
    first = df.filter(wants).orderBy(*order).limit(budget).select(*order).withColumn("_in", F.lit(True))
    return df.join(first, order, "left").withColumn(out, F.coalesce("_in", F.lit(False)) & wants).drop("_in")


def relevance(df: DataFrame, region: geo.Region = geo.DELAWARE) -> DataFrame:
    """df with relevance (in, review or out), reason, category_ids, wants_model.

    df has title, description, venue_name, venue_address, venue_city, presenter, source_categories array<string>,
    tier int, screened boolean, route. wants_model marks rows settled by a default only, which a model may settle.
    """
    tags = F.transform(F.coalesce("source_categories", F.array().cast("array<string>")), lambda t: F.trim(t))
    text = F.concat_ws(" ", "title", "description", "venue_name", "presenter", F.array_join(F.sort_array(tags), " "))
    df = df.withColumns({"_place": geo.verdict("venue_city", "venue_address", "venue_name", region), "_rules": C.classify(F.col("title"), text), "_tags": tags})
    rules, none = F.col("_rules"), F.expr("cast(array() as array<int>)")
    library = F.coalesce(F.col("route") == "libcal", F.lit(False))
    names = F.sort_array(F.array_intersect("_tags", F.array(*map(F.lit, LIBRARY_ARTS))))
    ids = F.create_map(*(F.lit(x) for item in LIBRARY_ARTS.items() for x in item))
    trusted = F.coalesce(F.col("tier").isin(1, 2), F.lit(False)) & ~F.coalesce("screened", F.lit(False))
    hint = rules["relevant"] | F.arrays_overlap("_tags", F.array(*map(F.lit, LIBRARY_HINTS)))
    row = lambda rel, why, cats, model=False: F.struct(
        F.lit(rel).alias("relevance"), (F.lit(why) if isinstance(why, str) else why).alias("reason"), cats.alias("category_ids"), F.lit(model).alias("wants_model")
    )
    answer = (
        F.when(F.col("_place.verdict") == "out", row("out", F.concat(F.lit("outside region: "), F.col("_place.evidence")), none))
        .when(rules["reason"] == "excluded keyword in title", row("out", "excluded keyword in title", none))
        .when(library & (F.size(names) > 0), row("in", F.concat(F.lit("library category "), F.array_join(names, ", ")), C.sanitize(F.transform(names, lambda t: F.try_element_at(ids, t)))))
        .when(library & F.arrays_overlap("_tags", F.array(*map(F.lit, LIBRARY_DROPS))), row("out", "library category out of scope", none))
        .when(trusted & (F.size(rules["category_ids"]) > 0), row("in", "trusted source, keyword categories", rules["category_ids"]))
        .when(trusted, row("in", "trusted source, uncategorized", none, True))
        .when(F.size(rules["title_category_ids"]) > 0, row("in", "title keyword match", rules["title_category_ids"]))
        .when(hint, row("review", "arts hint only", none, True))
        .otherwise(row("out", "no arts signal", none, True))
    )
    return df.withColumn("_a", answer).select(*(c for c in df.columns if not c.startswith("_")), "_a.*")


def tally(df: DataFrame) -> DataFrame:
    """Counters of a policy run: one row (stage, key, value) each."""
    counts = df.agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("relevance") == "in").alias("in_scope"),
        F.count_if(F.col("relevance") == "out").alias("out_of_scope"),
        F.count_if(F.col("reason").startswith("outside region")).alias("outside_region"),
        F.count_if(F.col("relevance") == "review").alias("review"),
        F.count_if((F.col("relevance") == "out") & F.col("wants_model")).alias("unclassified"),
    )
    keys = counts.columns
    return counts.select(F.explode(F.array(*(F.struct(F.lit("policy").alias("stage"), F.lit(k).alias("key"), F.col(k).alias("value")) for k in keys))).alias("c")).select("c.*")


def apply_model(df: DataFrame, model=None, *, order: list, budget: int = 60) -> DataFrame:
    """df after relevance(); the first `budget` rows that want a model get its verdict.

    model is a function of an iterator of pandas frames (title, description, ... in df's columns) that gives the
    same frames with relevance, reason and category_ids set; None leaves the defaults.
    """
    if model is None:
        return df.drop("wants_model")
    marked = budgeted(df, F.col("wants_model"), order, budget)
    asked = marked.filter("has_budget").drop("has_budget", "wants_model")
    return asked.mapInPandas(model, asked.schema).unionByName(marked.filter("not has_budget").drop("has_budget", "wants_model"))


def asking(ask, *, tries: int = 3):
    """A model for apply_model from ask(row: dict) -> {"relevant", "reason", "category_ids"}.

    A refusal (ask gives None) puts the row out; if every try fails, the row keeps its default. So "could not ask" is
    never mistaken for "was told no".
    """

    def run(frames):
        for frame in frames:
            rows = []
            for row in frame.to_dict("records"):
                for attempt in range(tries):
                    try:
                        answer = ask(row)
                    except Exception:  # noqa: BLE001 - one bad answer must not end the job
                        continue
                    if answer is None:
                        row |= {"relevance": "out", "reason": "model: refused", "category_ids": []}
                    else:
                        row |= {"relevance": "in" if answer["relevant"] else "out", "reason": "model: " + answer.get("reason", "")[:200], "category_ids": answer.get("category_ids") or []}
                    break
                rows.append(row)
            yield type(frame)(rows, columns=frame.columns)

    return run
