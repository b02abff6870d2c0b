"""Line dedup: explode normalised lines, hash, count distinct documents per hash, drop, reassemble by position.

DataFrame functions only.  The plan is: lines exploded in the scan stage; a hash aggregate whose map
side folds a hot line to one row per task; a join of the narrow line rows (128 bits of hash, id,
position) with the repeated hashes, where the few hot ones are broadcast and their lines dealt out
evenly; positions gathered per document; one join by document that brings positions and texts together.

Defined results: a null text is the empty text, that is one empty line; a null doc_id counts as the
largest id, and all rows without id as one document; rows that repeat a doc_id are one document for
the count, and each such row is cleaned and returned; an empty table gives an empty table; the
documents' other columns are ignored here (``clean`` returns them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ASCII_SPACE, LOWER, UPPER, materialise, prepare, spread_join

LAST_ID = (1 << 63) - 1
MIN_CODE_POINTS = 10
MIN_DOCUMENTS = 2


def line_key(line: Column) -> Column:
    """The line stripped of ASCII white space, A-Z lowered; pure ASCII takes the faster function."""
    bare = F.btrim(line, F.lit(ASCII_SPACE))
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def _id() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID))


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def repeated_positions(docs: DataFrame, min_code_points: int = MIN_CODE_POINTS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(_id, _sig, cuts): -1 and then the ascending positions of the lines that a document loses."""
    line = (
        docs.select(_id().alias("_id"), F.xxhash64(_text()).alias("_sig"), F.posexplode(F.split(_text(), "\n", -1)).alias("_pos", "_line"))
        .select("_id", "_sig", "_pos", line_key(F.col("_line")).alias("_key"))
        .where(F.char_length("_key") >= min_code_points)
        .select("_id", "_sig", "_pos", F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit(1), "_key").alias("_h2"))
    )
    if min_documents <= 2:  # at least two ids: the smallest isn't the largest, which needs no distinct count
        held = line.groupBy("_h1", "_h2").agg(F.min("_id").alias("_first"), F.max("_id").alias("_last"), F.count(F.lit(1)).alias("_n"))
        held = held.where("_first < _last" if min_documents == 2 else "true").drop("_last")
    else:
        each = line.groupBy("_h1", "_h2", "_id").agg(F.count(F.lit(1)).alias("_m"))
        held = each.groupBy("_h1", "_h2").agg(F.min("_id").alias("_first"), F.sum("_m").alias("_n"), F.count(F.lit(1)).alias("_d")).where(F.col("_d") >= min_documents).drop("_d")
    lost = spread_join(line, materialise(held, "line-repeats"), ["_h1", "_h2"], "_n", ["_id", "_sig", "_pos"]).where("_id > _first")
    return lost.groupBy("_id", "_sig").agg(F.concat(F.array(F.lit(-1)), F.array_sort(F.collect_set("_pos"))).alias("_cuts"))


def _kept(lines: Column, cuts: Column) -> Column:
    """The lines between the cuts: one slice for each cut, so the work follows the number of lines."""
    upto = lambda i: F.coalesce(F.get(cuts, i + 1), F.size(lines))
    runs = F.transform(F.sequence(F.lit(0), F.size(cuts) - 1), lambda i: F.slice(lines, F.get(cuts, i) + 2, upto(i) - F.get(cuts, i) - 1))
    return F.array_join(F.flatten(runs), "\n")


def clean(docs: DataFrame, min_code_points: int = MIN_CODE_POINTS, min_documents: int = MIN_DOCUMENTS, counts: tuple[str, str] | None = None) -> DataFrame:
    """All columns of docs with `text` cleaned; a document whose lines all go keeps its row with an empty text.

    With counts, two more columns of these names, in place of docs' own if it has such: the lines
    before, and the lines dropped.
    """
    prepare(docs.sparkSession)
    cuts = repeated_positions(docs, min_code_points, min_documents)
    rest = [c for c in docs.columns if c != "text"]
    # The lines are split before the join: an expression above it would be evaluated for every slice.
    whole = docs.select(F.struct(*rest).alias("_rest"), _id().alias("_id"), F.xxhash64(_text()).alias("_sig"), F.split(_text(), "\n", -1).alias("_lines"))
    joined = whole.join(cuts, ["_id", "_sig"], "left")
    out = joined.select(
        "_rest",
        F.when(F.col("_cuts").isNull(), F.array_join("_lines", "\n")).otherwise(_kept(F.col("_lines"), F.col("_cuts"))).alias("_text"),
        F.size("_lines").cast("long").alias("_n_lines"),
        F.coalesce(F.size("_cuts") - 1, F.lit(0)).cast("long").alias("_n_dropped"),
    )
    new = {} if counts is None else {counts[0]: "_n_lines", counts[1]: "_n_dropped"}
    columns = [F.col("_text").alias("text") if c == "text" else F.col("_rest")[c].alias(c) for c in docs.columns if c not in new]
    return out.select(*columns, *[F.col(c).alias(name) for name, c in new.items()])


def op6_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = clean(docs, counts=("n_lines", "n_dropped"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP6_SQL = r"""
WITH line AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents
), keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM line
), held AS (
  SELECT key, min(doc_id) AS first_id FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT k.doc_id, k.pos, k.line, (h.key IS NOT NULL AND k.doc_id > h.first_id) AS lost
  FROM keyed k LEFT JOIN held h ON k.key = h.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
