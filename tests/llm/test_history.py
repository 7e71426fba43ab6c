"""A history outlasts the application that wrote it, and it is not moved when a batch is held against it."""

import os
import re
import subprocess
import sys

from pyspark.sql import functions as F

from newsloom.llm import history

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
RUN = """
import sys
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from newsloom.llm import history
shared, day, rows = sys.argv[1], int(sys.argv[2]), [x.split("=") for x in sys.argv[3:]]
spark = SparkSession.builder.master("local[2]").config("spark.checkpoint.dir", "file://" + shared).config("spark.ui.enabled", "false").config("spark.sql.warehouse.dir", shared + "/wh" + sys.argv[2]).config("spark.sql.shuffle.partitions", "3").getOrCreate()
df = spark.createDataFrame([(int(i), day, t) for i, t in rows], "doc_id long, day int, text string")
out = history.deduplicate_batches(df, "day", "doc_id", history.normal_text(F.col("text")), history.paragraphs(F.col("text")), history.History(spark, "accepted"))
print("GOT", sorted((r.doc_id, r.first_id, r.first_batch, r.seen_parts) for r in out.collect()))
"""


def test_history_outlasts_the_application(tmp_path):
    def run(day, *rows):
        got = subprocess.run([sys.executable, "-c", RUN, str(tmp_path), str(day), *rows], capture_output=True, text=True, cwd=ROOT, env=os.environ | {"PYTHONPATH": ROOT}, timeout=300)
        assert "GOT" in got.stdout, got.stderr[-2000:]
        return eval(re.search(r"GOT (.*)", got.stdout).group(1))

    assert run(1, "1=alpha", "2=beta") == [(1, None, None, 0), (2, None, None, 0)]
    assert run(2, "3=Beta", "4=gamma") == [(3, 2, 1, 1), (4, None, None, 0)]
    assert run(3, "5=gamma", "6=alpha", "7=new") == [(5, 4, 2, 1), (6, 1, 1, 1), (7, None, None, 0)]
    assert run(3, "5=gamma", "7=new") == [(5, 4, 2, 1), (7, None, None, 1)]  # the same batch again: no copy of itself
    assert not os.listdir(tmp_path / "newsloom")  # intermediate tables went with their applications


def test_history_is_not_moved(spark):
    h = history.History(spark, buckets=3)
    rows = lambda n, day: spark.range(n).select(F.col("id").alias("doc_id"), F.lit(day).alias("day"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("text"))
    assert history.deduplicate_batches(rows(50, 1), "day", "doc_id", F.col("text"), history=h).filter("first_id is not null").count() == 0
    keys = rows(80, 2).select(history._key("full", F.col("text")).alias("key"), (F.col("doc_id") + 100).alias("first_id"), F.col("day").alias("first_batch"))
    held = h.held(keys)
    assert held.filter("old").count() == 50 and held.filter("old and first_id >= 100").count() == 0
    plan = held._jdf.queryExecution().executedPlan().toString()
    above = plan[plan.index("SortMergeJoin") :]
    assert above.count("Exchange") == 1 and "Bucketed: true" in above  # the one that places the new hashes


def test_plan_does_not_grow_with_batches(spark):
    def size(days):
        df = spark.range(60).select("id", (F.col("id") % days).cast("int").alias("day"), (F.col("id") % 10).cast("string").alias("text"))
        out = history.deduplicate_batches(df, "day", "id", F.col("text"))
        assert out.filter("first_id is not null").count() == 50
        return out._jdf.queryExecution().optimizedPlan().toString().count("\n")

    assert size(2) == size(30)


def test_one_hot_page(spark):
    """A third of all rows on one page; the record that comes back in the same batch points to its smallest id."""
    df = spark.range(900).select("id", (F.col("id") % 5).cast("int").alias("day"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text"))
    got = {r.id: r.first_id for r in history.deduplicate_batches(df, "day", "id", F.col("text")).collect()}
    assert len(got) == 900 and {got[i] for i in range(3, 900, 3)} == {0} and got[0] is None and got[1] is None
