"""Results as files: a folder of JSON lines for each table, briefings by audience, the cost report, the run's summary.

Empty tables give empty folders; null sources count as blank; without records costs are zero.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import rendered
from tidemark.operators.analysis import cost_by

FLAGS_SHOWN, DETAIL_CHARS = 10, 100
RECORD = ("call_id", "stage", "model", "prompt_tokens", "completion_tokens", "estimated_cost_usd", "source_name", "entity_id")


def write_results(tables: dict[str, DataFrame], folder: str) -> None:
    """One folder for each table; what was there is replaced."""
    for name, rows in tables.items():
        rows.write.mode("overwrite").json(f"{folder}/{name}")


def write_briefings(briefings: DataFrame, folder: str) -> None:
    """briefings: (audience, text); a folder for each audience with one file, whose lines are the text's."""
    briefings.select("audience", "text").write.mode("overwrite").partitionBy("audience").text(f"{folder}/briefings")


def total_cost(records: DataFrame) -> DataFrame:
    """One row (total), rounded to six places."""
    return records.agg(F.coalesce(F.round(F.sum("estimated_cost"), 6).cast("double"), F.lit(0.0)).alias("total"))


def cost_report(records: DataFrame, run_id: str = "") -> DataFrame:
    """One row (report): JSON of run, total, and the costs by stage and by source, both few."""

    def rollup(key: str) -> DataFrame:
        return cost_by(records, key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, "cost")))).alias(f"by_{key}"))

    one = total_cost(records).crossJoin(rollup("stage")).crossJoin(rollup("source_name"))  # one row each
    return one.select(F.to_json(F.struct(F.lit(run_id).alias("run_id"), F.col("total").alias("total_cost_usd"), F.col("by_stage"), F.col("by_source_name").alias("by_source"))).alias("report"))


def write_cost_report(records: DataFrame, folder: str, run_id: str) -> None:
    """The report as one JSON line, and beside it the records, which may be many."""
    cost_report(records, run_id).select(F.col("report").alias("value")).coalesce(1).write.mode("overwrite").text(f"{folder}/cost_report")
    records.withColumn("estimated_cost_usd", F.col("estimated_cost").cast("double")).select(*RECORD).write.mode("overwrite").json(f"{folder}/cost_records")


def run_summary(items: DataFrame, entities: DataFrame, sentiments: DataFrame, flags: DataFrame, records: DataFrame) -> DataFrame:
    """One row: sources, items, entities, sentiments, flags, cost."""
    count = lambda rows, name: rows.agg(F.count(F.lit(1)).alias(name))
    first = items.agg(F.countDistinct("source_name").alias("sources"), F.count(F.lit(1)).alias("items"))
    parts = (count(entities, "entities"), count(sentiments, "sentiments"), count(flags, "flags"), total_cost(records).withColumnRenamed("total", "cost"))
    for part in parts:
        first = first.crossJoin(part)  # one row each
    return first


def first_flags(flags: DataFrame, n: int = FLAGS_SHOWN) -> DataFrame:
    """(nth, line): the first flags in order, details cut."""
    few = flags.orderBy("family", "place", "details").limit(n)
    rows = few.agg(F.array_sort(F.collect_list(F.struct("family", "place", "details", "flag_type"))).alias("f"))  # n rows
    each = rows.select(F.posexplode("f").alias("nth", "f"))
    return each.select(F.col("nth").cast("long").alias("nth"), F.concat(F.lit("["), "f.flag_type", F.lit("] "), F.substring("f.details", 1, DETAIL_CHARS)).alias("line"))


def cost_lines(records: DataFrame, key: str) -> DataFrame:
    """(name, line): six places, as the summary shows them."""
    return cost_by(records, key).select(F.col(key).alias("name"), rendered("{name} ${cost:.6f}", name=F.col(key), cost=F.col("cost")).alias("line"))


def printed_summary(spark: SparkSession, tables: dict[str, DataFrame], records: DataFrame, run_id: str, seconds: float, folder: str) -> str:
    """The run's summary as text; output folders in order.  Collects a few lines."""
    one = run_summary(tables["content_items"], tables["entities"], tables["sentiments"], tables["qa_flags"], records).first()
    lines = [f"run {run_id}, {seconds:.1f} s", *(f"{k}: {one[k]}" for k in ("sources", "items", "entities", "sentiments", "flags")), f"cost: ${one['cost']:.6f}"]
    for key in ("stage", "source_name"):
        lines += [f"cost by {key.split('_')[0]}:", *(f"  {r['line']}" for r in cost_lines(records, key).orderBy("name").collect())]
    shown = [f"  {r['line']}" for r in first_flags(tables["qa_flags"]).orderBy("nth").collect()]
    if shown:
        lines += ["flags:", *shown] + ([f"  and {one['flags'] - len(shown)} more"] if one["flags"] > len(shown) else [])
    return "\n".join([*lines, "output:", *(f"  {p}" for p in listing(spark, folder))])


def listing(spark: SparkSession, folder: str) -> list[str]:
    """What lies in a folder of any file system, in order."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(f"{folder}/{s.getPath().getName()}" for s in system.listStatus(path)) if system.exists(path) else []
