"""Names found by a lexicon: how the plan meets blocks and forms."""

import re

from pyspark.sql import functions as F

from inquirylake import streaming
from inquirylake.operators import extract

KEYS = ["wp", "fraktion"]


def test_runs_of_blocks_are_not_broadcast(spark):
    """A file of equal texts is far smaller than its rows, so its size tells the planner too little."""
    rows = spark.range(2000).select("id", F.lit(18).alias("wp"), F.lit("CDU").alias("fraktion"), F.concat(F.repeat(F.lit("Eva Nacha, "), 50), F.col("id") % 7).alias("text"))
    rows = streaming.stored(rows.unionByName(spark.createDataFrame([(-1, 18, "CDU", None), (-2, 18, "CDU", "7")], rows.schema)))
    forms = spark.createDataFrame([(18, "CDU", "Eva Nacha", "Nacha", "Eva"), (18, "CDU", "Frank B", "B", "Frank")], "wp int, fraktion string, form string, nach string, vor string")
    found = extract.names_found(rows, forms, F.col("text"), KEYS)
    joins = re.findall(r"(\w+Join) .*Contains", found._jdf.queryExecution().sparkPlan().toString())
    assert joins == ["SortMergeJoin"]
    got = {tuple(r) for r in found.select(F.col("id") < 0, "anfrager_alle", "anzahl_abgeordnete").collect()}
    assert got == {(False, "Nacha, Eva", 1), (True, "", 0)} and found.count() == 2002
