"""Event categories: names, parents, clean-up, keyword rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Categories by id.
CATEGORIES = {
    1: "Attractions", 2: "Dance", 3: "Festivals & Special Events", 4: "Film", 5: "Free", 6: "Kids & Family Friendly",
    7: "Lectures & Workshops", 8: "Literature & Poetry", 9: "Music", 10: "Theater & Performance", 11: "Visual Arts",
    12: "Music: Bands", 13: "Music: Choral", 14: "Music: Classical/Opera", 15: "Music: Country/Folk/Bluegrass",
    16: "Music: Hip Hop/R&B", 17: "Music: Jazz/Blues", 18: "Music: Rock/Pop", 19: "Music: World",
    20: "Theater: Comedy/Drama", 21: "Theater: Musical", 22: "Theater: Variety", 23: "Visual Arts: Art Centers",
    24: "Visual Arts: Art/Antiques/Craft Shows", 25: "Visual Arts: Art Tours", 26: "Visual Arts: Exhibitions",
    27: "Visual Arts: Galleries", 28: "Visual Arts: Museums", 29: "Visual Arts: Public Art",
}
FREE = 5
#: First and last id of the children of a category.
CHILDREN = {9: (12, 19), 10: (20, 22), 11: (23, 29)}

#: Words that rule out an event if its title has them.
EXCLUDED = [
    r"story\s*times?", "storytimes?", "job fairs?", "blood drives?", "council meeting", "board meeting", "town hall", "bingo", "yard sale",
    "vaccination", "tax prep", "summer camps?", "day camps?", "bird(?:ing)? walks?", "nature hikes?", "5k", "fun run", "tabletop", "board games?",
    r"video gam\w*", "gaming", "d&d", "dungeons", "happy hours?", "karaoke", "trivia nights?", "wing nights?", "taco tuesday", "brunch", "drafts?",
    "half off", "drink specials?", "food trucks?", "wine down", "bottomless", "ladies night", "blue rocks", "baseball", "football", "basketball",
    "soccer match", "reservations?", "room booking", "reserved", "orientation", "tutoring", "office hours", "passport services?", "proctoring",
    "notary", r"(?:museum|library|gallery|office|building|park|center|centre)s?\s+closed",
    r"closed\s+(?:for|due|on|all|today|this|monday|tuesday|wednesday|thursday|friday|saturday|sunday)", "closure",
]
#: Fixed values: (words, category), in order of rank.
KEYWORDS = [
    (["jazz", "blues"], 17),
    (["choir", "choirs", "choral", "chorale", "chorus"], 13),
    (["symphony", "orchestra", "orchestral", "opera", "operas", "classical", "chamber music", "recital", "recitals"], 14),
    (["folk", "bluegrass", "country music"], 15),
    (["hip.?hop", "r&b"], 16),
    (["rock", "indie", "punk"], 18),
    (["band", "bands", "concert", "concerts", "music", "singer", "singers", "songwriter", "songwriters", "acoustic"], 9),
    (["musical", "musicals"], 21),
    (["comedy", "comedies", "drama", "improv", "a play", "stage play", "plays"], 20),
    (["theater", "theaters", "theatre", "theatres", "stage", "performance", "performances"], 10),
    (["ballet", "dance", "dances", "dancing"], 2),
    (["film", "films", "movie", "movies", "screening", "screenings", "cinema", "documentary", "documentaries"], 4),
    (["author", "authors", "book", "books", "poetry", "poet", "poets", "literary", "writer", "writers", "reading", "readings"], 8),
    (["lecture", "lectures", "workshop", "workshops", "class", "classes", "talk", "talks", "seminar", "seminars", "speaker", "speakers"], 7),
    (["festival", "festivals", "fair", "fairs", "parade", "parades", "celebration", "celebrations"], 3),
    (["exhibit", "exhibits", "exhibition", "exhibitions"], 26),
    (["gallery", "galleries", "art show", "art shows", "juried"], 27),
    (["museum", "museums"], 28),
    (["art", "arts", "craft", "crafts", "paint", "painting", "paintings", "sculpt", "sculpture", "sculptures", "photograph", "photography", "photographs", "pottery", "drawing", "drawings", "watercolor", "watercolors"], 11),
]
#: Beginnings of words that hint at the arts.
ARTS_STEMS = ["art", "music", "theat", "danc", "film", "concert", "exhibit", "gallery", "galleries", "author", "poetry", "craft", "festival", "opera", "ballet", "jazz", "choir", "museum", "literar", "cultur", "perform"]


def parent_of(category: int) -> int | None:
    return next((p for p, (lo, hi) in CHILDREN.items() if lo <= category <= hi), None)


def keyword_pattern(words: list[str], category: int) -> str:
    pattern = rf"(?iU)\b(?:{'|'.join(words)})\b"
    # "pop" alone, but not the one of pop-up
    return pattern + r"|(?iU)\bpop\b(?!\s*[-–]?\s*up)" if category == 18 else pattern


EXCLUDED_PATTERN = rf"(?iU)\b(?:{'|'.join(EXCLUDED)})\b"
ARTS_PATTERN = rf"(?iU)\b(?:{'|'.join(ARTS_STEMS)})"


def once(value: Column, then) -> Column:
    """then(value), with the value computed once however often `then` names it."""
    return F.element_at(F.transform(F.array(value), then), 1)


def sanitize(ids: Column, cap: int = 3) -> Column:
    """Known ids as int, each once, without the parents of others, at most cap; from an array of strings or numbers."""

    def without_parents(known: Column) -> Column:
        parents = F.array(*(F.when(F.exists(known, lambda x: x.between(lo, hi)), F.lit(p)) for p, (lo, hi) in CHILDREN.items()))
        return F.slice(F.array_except(known, F.array_compact(parents)), 1, cap)

    known = F.array_distinct(F.filter(F.transform(ids, lambda x: x.try_cast("int")), lambda x: x.between(1, len(CATEGORIES))))
    return once(known, without_parents)


def with_free(ids: Column, is_free: Column) -> Column:
    """Free events bear the category Free, in place of a third one if need be."""
    return F.when((is_free == 1) & ~F.array_contains(ids, FREE), sanitize(F.concat(F.slice(ids, 1, 2), F.array(F.lit(FREE))))).otherwise(ids)


def keyword_categories(text: Column) -> Column:
    found = F.array_compact(F.array(*(F.when(text.rlike(keyword_pattern(w, c)), F.lit(c)) for w, c in KEYWORDS)))
    return sanitize(found)


def classify(title: Column, body: Column) -> Column:
    """struct(relevant, reason, category_ids, title_category_ids) by rules; body is all text of the event."""
    none = F.expr("cast(array() as array<int>)")

    def chosen(t: Column) -> Column:  # t: title, body
        found = F.struct(t["title"].rlike(EXCLUDED_PATTERN).alias("excluded"), keyword_categories(t["title"]).alias("of_title"), t["body"].alias("body"))
        return once(found, lambda f: F.struct(f["excluded"].alias("excluded"), f["of_title"].alias("of_title"), F.when(F.size(f["of_title"]) > 0, f["of_title"]).otherwise(keyword_categories(f["body"])).alias("ids"), f["body"].alias("body")))

    def judged(c: Column) -> Column:
        relevant = ~c["excluded"] & ((F.size(c["ids"]) > 0) | c["body"].rlike(ARTS_PATTERN))
        return once(relevant, lambda r: F.struct(
            r.alias("relevant"),
            F.when(c["excluded"], "excluded keyword in title").when(r, "keyword match").otherwise("no arts keyword").alias("reason"),
            F.when(c["excluded"], none).otherwise(c["ids"]).alias("category_ids"),
            F.when(c["excluded"], none).otherwise(c["of_title"]).alias("title_category_ids"),
        ))

    texts = F.struct(F.coalesce(title, F.lit("")).alias("title"), F.coalesce(body, F.lit("")).alias("body"))
    return once(once(texts, chosen), judged)


def names_of(ids: Column) -> Column:
    table = F.create_map(*(F.lit(x) for item in CATEGORIES.items() for x in item))
    return F.array_compact(F.transform(ids, lambda i: F.try_element_at(table, i)))


#: Display families in their order, by top category.
FAMILIES = {
    9: "Music", 10: "Theater & Performance", 11: "Visual Arts", 2: "Dance", 4: "Film", 8: "Literature & Poetry", 3: "Festivals", 7: "Lectures & Workshops",
    6: "Kids & Family", 1: "Attractions",
}


def family_of(ids: Column) -> Column:
    """The display family of the first category that has one; Free has none."""
    top = F.transform(ids, lambda i: F.coalesce(*(F.when(i.between(lo, hi), F.lit(p)) for p, (lo, hi) in CHILDREN.items()), i))
    table = F.create_map(*(F.lit(x) for item in FAMILIES.items() for x in item))
    return F.coalesce(F.try_element_at(F.array_compact(F.transform(top, lambda i: F.try_element_at(table, i))), F.lit(1)), F.lit("Other"))
