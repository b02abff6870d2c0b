"""Returned sentiments matched to an item's entities, and links up to the first repeat."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

MOST_LINKS = 20


def match(returned: DataFrame, entities: DataFrame) -> DataFrame:
    """(item, nth, surface, canonical_id, canonical_name): the first entity of the item that a returned surface names.

    returned: (item, nth, surface); entities: (item, place, canonical_id, canonical_name, surface_form).
    First pass: name and surface hold one another, or the surface is one of the entity's; second: a
    word of the name with over two characters stands in the surface.  Case doesn't count.  An empty
    surface matches the first entity, a null one none; a name that is null counts as the id.
    """
    each = entities.where("canonical_id <> ''").groupBy("item", "canonical_id").agg(
        F.min("place").alias("place"),
        F.min_by(F.coalesce("canonical_name", "canonical_id"), "place").alias("canonical_name"),
        F.collect_set(F.lower("surface_form")).alias("_forms"),
    )
    surface, name = F.lower("surface"), F.lower("canonical_name")
    strong = name.contains(surface) | surface.contains(name) | F.array_contains("_forms", surface)
    words = F.filter(F.split(name, r"\s+"), lambda w: F.char_length(w) > 2)
    weak = F.exists(words, lambda w: F.contains(surface, w))
    level = F.when(strong, 1).when(weak, 2)
    pairs = returned.join(each, "item").withColumn("_level", level).where("_level IS NOT NULL")
    best = F.min_by(F.struct("surface", "canonical_id", "canonical_name"), F.struct("_level", "place"))
    return pairs.groupBy("item", "nth").agg(best.alias("_b")).select("item", "nth", "_b.*")


def until_repeat(links: DataFrame, group: str, key: str, order: str, most: int = MOST_LINKS) -> DataFrame:
    """Each group's rows before the first one whose key came before, `most` at most: later ones are lost."""
    seen = links.withColumn("_k", F.row_number().over(W.partitionBy(group, key).orderBy(order)))
    inner = W.partitionBy(group).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    kept = seen.withColumn("_again", F.max("_k").over(inner)).withColumn("_n", F.count(F.lit(1)).over(inner))
    return kept.where((F.col("_again") == 1) & (F.col("_n") <= most)).select(*links.columns)
