"""Queries that write the tables' rows as files and read them back."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import functions as F

from ..operators.chains import shared_folder
from ..sources import workbooks
from .queries import query, t

_CELLS = ["key", "title", "venue", "start", "price"]


@query("SELECT p_partkey::VARCHAR AS key, p_name AS title, CASE WHEN p_size % 5 > 0 THEN p_brand || ' <&> \"' || p_type || '\"' END AS venue, strftime(DATE '2024-01-01' + p_size, '%Y-%m-%d') AS start, (p_size * 2)::VARCHAR AS price FROM part")
def workbook_rows(spark, sf_dir):
    """Parts written as workbooks, one per task, and read back as uploads."""
    workbooks.register(spark)
    venue = F.when(F.col("p_size") % 5 > 0, F.concat(F.col("p_brand"), F.lit(' <&> "'), F.col("p_type"), F.lit('"')))
    rows = t(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("key"), F.col("p_name").alias("title"), venue.alias("venue"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("p_size")).cast("string").alias("start"), (F.col("p_size") * 2).cast("string").alias("price"))
    path = f"{shared_folder(spark)}/workbooks-{uuid.uuid4().hex}"
    rows.repartition("key").write.format("workbook").mode("append").save(path)
    return spark.read.format("workbook").option("headers", json.dumps(_CELLS)).load(path).filter("problem is null").select(*_CELLS)
