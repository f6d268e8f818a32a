"""Queries whose rows depend on rows before them; the SQL decides them one at a time, the operators all at once."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import discovery, ingest, matching
from .queries import _SCORES, query, sql_norm_title, sql_norm_venue, t


@query(
    """WITH RECURSIVE r AS (SELECT role, conv_id, turn, coalesce(length(text), 0)::BIGINT AS n, row_number() OVER (PARTITION BY role ORDER BY conv_id, turn) AS i FROM conversations),
    f AS (SELECT role, i, n AS used, 0 AS batch FROM r WHERE i = 1
      UNION ALL SELECT r.role, r.i, CASE WHEN f.used > 0 AND f.used + r.n > 2000 THEN r.n ELSE f.used + r.n END, CASE WHEN f.used > 0 AND f.used + r.n > 2000 THEN f.batch + 1 ELSE f.batch END FROM f JOIN r ON r.role = f.role AND r.i = f.i + 1)
    SELECT role, conv_id, turn, batch FROM r JOIN f USING (role, i)"""
)
def char_batches(spark, sf_dir):
    """All turns of a role, which are few keys with many rows each, in batches of up to 2,000 characters."""
    turns = t(spark, sf_dir, "conversations")
    return discovery.char_batches(turns, ["role"], ["conv_id", "turn"], "text", 2_000).select("role", "conv_id", "turn", "batch")


@query(
    f"""WITH RECURSIVE v AS (SELECT p_size, p_partkey % 3 AS day, {sql_norm_venue('p_name')} AS venue, min(p_partkey) AS id FROM part GROUP BY 1, 2, 3),
    left_t AS (SELECT DISTINCT venue AS t FROM v), right_t AS (SELECT DISTINCT venue AS t FROM v), {_SCORES},
    near AS (SELECT a, list(b) AS alike FROM scores WHERE score >= 75 GROUP BY a),
    k AS (SELECT p_size, day, venue, id, alike, row_number() OVER (PARTITION BY p_size, day ORDER BY id) AS i FROM v JOIN near ON a = venue),
    f AS (SELECT p_size, day, i, id, venue, id AS cluster_id, [{{'id': id, 'venue': venue}}] AS heads FROM k WHERE i = 1
      UNION ALL SELECT p_size, day, i, id, venue, coalesce(head, id), CASE WHEN head IS NULL THEN list_append(heads, {{'id': id, 'venue': venue}}) ELSE heads END
        FROM (SELECT k.p_size, k.day, k.i, k.id, k.venue, f.heads, list_filter(f.heads, lambda h: list_contains(k.alike, h.venue))[1].id AS head FROM f JOIN k ON k.p_size = f.p_size AND k.day = f.day AND k.i = f.i + 1))
    SELECT p_partkey AS event_id, cluster_id FROM part JOIN f ON f.p_size = part.p_size AND f.day = p_partkey % 3 AND f.venue = {sql_norm_venue('p_name')}"""
)
def cluster_greedily(spark, sf_dir):
    """Parts as events: title by size, day by key, venue by name; greedy clusters per title and day."""
    part = t(spark, sf_dir, "part")
    events = part.select(F.col("p_partkey").alias("event_id"), F.concat(F.lit("show "), F.col("p_size").cast("string")).alias("title"), F.col("p_name").alias("venue"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("p_partkey") % 3).cast("int")).alias("start_date"))
    return matching.cluster_greedily(events).select("event_id", "cluster_id")


_TITLES = "SELECT p_partkey AS id, p_name AS title, CASE WHEN p_partkey % 4 > 0 THEN p_brand END AS venue, DATE '2024-01-01' + (p_partkey * 37 % 997)::INT AS s, DATE '2024-01-01' + (p_partkey * 37 % 997 + p_size % 3)::INT AS e FROM part"


@query(
    f"""WITH RECURSIVE rows AS ({_TITLES}), n AS (SELECT id, s, e, {sql_norm_title('title')} AS tt, coalesce({sql_norm_venue('venue')}, '') AS vv FROM rows),
    left_t AS (SELECT DISTINCT tt AS t FROM n UNION SELECT DISTINCT vv FROM n WHERE vv <> ''), right_t AS (SELECT t FROM left_t), {_SCORES},
    met AS (SELECT a.id AS later, b.id AS earlier, a.vv <> '' AND b.vv <> '' AS known, a.tt AS ta, b.tt AS tb, a.vv AS va, b.vv AS vb FROM n a JOIN n b ON b.id < a.id AND a.s <= b.e AND b.s <= a.e),
    links AS (SELECT later, earlier, CASE WHEN known THEN 0.62 * x.score + 0.38 * y.score ELSE x.score END AS score, known FROM met JOIN scores x ON x.a = ta AND x.b = tb LEFT JOIN scores y ON y.a = va AND y.b = vb AND known),
    alike AS (SELECT later, earlier, score FROM links WHERE score >= CASE WHEN known THEN 87 ELSE 96 END),
    k AS (SELECT later, list(earlier) AS earlier, row_number() OVER (ORDER BY later) AS i FROM alike GROUP BY later),
    f AS (SELECT 0::BIGINT AS i, []::BIGINT[] AS refused
      UNION ALL SELECT k.i, CASE WHEN len(list_filter(k.earlier, lambda x: NOT list_contains(f.refused, x))) > 0 THEN list_append(f.refused, k.later) ELSE f.refused END FROM f JOIN k ON k.i = f.i + 1),
    gone AS (SELECT unnest(refused) AS id FROM f WHERE i = (SELECT count(*) FROM k)),
    best AS (SELECT later, earlier, row_number() OVER (PARTITION BY later ORDER BY score DESC, earlier) AS r FROM alike WHERE earlier NOT IN (SELECT id FROM gone))
    SELECT id AS row_id, earlier AS repeats FROM rows LEFT JOIN best ON later = id AND r = 1"""
)
def upload_repeats(spark, sf_dir):
    """Parts as one upload, in order of their keys: which row repeats which accepted row; titles count alone where a venue is missing."""
    day = lambda n: F.expr(f"date_add(date'2024-01-01', cast({n} as int))")
    k = F.col("p_partkey")
    rows = t(spark, sf_dir, "part").select(k.alias("row_id"), F.col("p_name").alias("title"), F.when(k % 4 > 0, F.col("p_brand")).alias("venue"), day("p_partkey * 37 % 997").alias("start_date"), day("p_partkey * 37 % 997 + p_size % 3").alias("end_date"))
    return ingest.upload_duplicates(rows).select("row_id", "repeats")
