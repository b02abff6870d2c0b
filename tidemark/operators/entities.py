"""Mentions, alias resolution, registry.  The alias dimension is fixed and small, so it may be broadcast.

A null text names nothing; a null surface resolves to nothing and registers itself under no id; empty
tables give empty tables; of repeated mentions each is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text as t
from tidemark.runtime import numbered

# Entity type, canonical name, aliases in order.
ALIASES = (
    ("central_bank", "Federal Reserve", ("the fed", "fed", "federal reserve", "us central bank", "u.s. central bank", "fomc")),
    ("central_bank", "European Central Bank", ("ecb", "european central bank")),
    ("central_bank", "Bank of England", ("boe", "bank of england")),
    ("central_bank", "Bank of Japan", ("boj", "bank of japan")),
    ("central_bank", "People's Bank of China", ("pboc", "peoples bank of china")),
    ("central_bank", "Swiss National Bank", ("snb", "swiss national bank")),
    ("central_bank", "Reserve Bank of Australia", ("rba",)),
    ("currency_pair", "EUR/USD", ("eurusd", "eur/usd", "euro dollar", "fiber")),
    ("currency_pair", "GBP/USD", ("gbpusd", "gbp/usd", "cable")),
    ("currency_pair", "USD/JPY", ("usdjpy", "usd/jpy", "dollar yen")),
    ("currency_pair", "USD/CNY", ("usdcny", "usd/cny", "dollar yuan")),
    ("index", "S&P 500", ("s&p 500", "s&p500", "spx", "sp500")),
    ("index", "Dow Jones", ("dow jones", "djia", "dow")),
    ("index", "NASDAQ", ("nasdaq", "nasdaq composite")),
    ("index", "FTSE 100", ("ftse 100", "ftse100")),
    ("index", "DAX", ("dax",)),
    ("index", "Nikkei 225", ("nikkei", "nikkei 225")),
    ("indicator", "CPI", ("cpi", "consumer price index")),
    ("indicator", "NFP", ("nfp", "non-farm payrolls", "non farm payrolls")),
    ("indicator", "GDP", ("gdp", "gross domestic product")),
    ("indicator", "PCE", ("pce", "personal consumption expenditures")),
    ("indicator", "PMI", ("pmi", "purchasing managers index")),
    ("indicator", "Unemployment Rate", ("unemployment rate",)),
    ("indicator", "Interest Rate", ("interest rate",)),
    ("indicator", "Federal Funds Rate", ("federal funds rate", "fed funds rate")),
    ("indicator", "Inflation", ("inflation",)),
)
FALLBACK_CONFIDENCE, LEAST_RESOLVED = 0.3, 0.5
CHUNK = 30


def alias_rows() -> list[tuple[int, str, str, str]]:
    """(order, alias, canonical name, type)."""
    flat = [(alias, name, kind) for kind, name, aliases in ALIASES for alias in aliases]
    return [(i, *row) for i, row in enumerate(flat)]


def alias_dimension(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(alias_rows(), "ord long, alias string, canonical_name string, entity_type string")
    return rows.withColumn("norm", t.normalise(F.col("alias"))).withColumn("canonical_id", t.slug(F.col("canonical_name")))


def dictionary(aliases: DataFrame) -> DataFrame:
    """The look-up: each alias, and right after an entity's first alias the canonical name itself."""
    named = aliases.groupBy("canonical_id").agg(F.min("ord").alias("ord"), F.min_by("canonical_name", "ord").alias("canonical_name"), F.min_by("entity_type", "ord").alias("entity_type"))
    own = named.select((F.col("ord") + 0.5).alias("ord"), F.lower("canonical_name").alias("alias"), "canonical_name", "entity_type", t.normalise(F.col("canonical_name")).alias("norm"), "canonical_id")
    return aliases.withColumn("ord", F.col("ord").cast("double")).unionByName(own)


def mentions(items: DataFrame, aliases: list[tuple[int, str, str, str]] | None = None) -> DataFrame:
    """The gazetteer annotator: an alias that an item's text holds is a mention, with its first span.

    aliases are rows of ``alias_rows``, in lower case.  The text is lowered once and tried for each
    alias within its row: no join.
    """
    known = F.array(*[F.struct(F.lit(i).cast("long").alias("alias_ord"), F.lit(alias).alias("surface_form"), F.lit(kind).alias("entity_type")) for i, alias, _, kind in (alias_rows() if aliases is None else aliases)])
    # A text in an array of one is evaluated once, not once for each alias.
    held = F.transform(F.array(F.lower("combined")), lambda text: F.transform(F.filter(known, lambda a: F.contains(text, a["surface_form"])), lambda a: F.struct(a.alias("a"), (F.instr(text, a["surface_form"]) - 1).cast("long").alias("start"))))
    each = items.select("id", "source_name", "ord", F.explode(F.get(held, F.lit(0))).alias("_m"))
    return each.select("id", "source_name", "ord", "_m.a.alias_ord", "_m.a.surface_form", "_m.a.entity_type", F.col("_m.start").alias("span_start"), (F.col("_m.start") + F.char_length("_m.a.surface_form")).alias("span_end"))


def resolve(found: DataFrame, aliases: DataFrame, resolutions: DataFrame | None = None) -> DataFrame:
    """Adds canonical_id, canonical_name, resolution_confidence: the dictionary, then resolutions, then self-registration.

    resolutions: rows of ``annotate.last_resolution``.  A surface that nothing resolves
    becomes its own entity at FALLBACK_CONFIDENCE, also where its resolution has the empty id; if its
    slug is a known entity's, it joins that one and keeps the low confidence.
    """
    known = dictionary(aliases)
    dim = known.groupBy("norm").agg(F.max_by("canonical_id", "ord").alias("_id"), F.max_by("canonical_name", "ord").alias("_name"))
    names = known.groupBy(F.col("canonical_id").alias("_slug")).agg(F.min_by("canonical_name", "ord").alias("_known"))
    out = found.withColumn("norm", t.normalise(F.col("surface_form"))).join(F.broadcast(dim), "norm", "left")
    if resolutions is None:
        out = out.withColumns({"_told": F.lit(None).cast("string"), "_called": F.lit(None).cast("string"), "_sure": F.lit(None).cast("double")})
    else:  # distinct surfaces may be many: Spark chooses the join
        out = out.join(resolutions.where("canonical_id <> ''").select("norm", F.col("canonical_id").alias("_told"), F.col("canonical_name").alias("_called"), F.col("confidence").alias("_sure")), "norm", "left")
    out = out.withColumn("_slug", F.coalesce("_told", t.slug(F.col("surface_form")))).join(F.broadcast(names), "_slug", "left")
    return out.select(
        *found.columns,
        F.coalesce("_id", "_slug").alias("canonical_id"),
        F.coalesce("_name", "_known", "_called", "surface_form").alias("canonical_name"),
        F.when(F.col("_id").isNotNull(), 1.0).when(F.col("_told").isNotNull(), F.col("_sure")).otherwise(FALLBACK_CONFIDENCE).alias("resolution_confidence"),
    )


def unresolved(found: DataFrame, aliases: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(norm, entity_type, first_ord, number, chunk) of surfaces without an entry: anti join, one row a norm, numbered chunks."""
    left = found.withColumn("norm", t.normalise(F.col("surface_form"))).join(F.broadcast(dictionary(aliases).select("norm").distinct()), "norm", "left_anti")
    place = F.struct("ord", "alias_ord")
    each = left.groupBy("norm").agg(F.min_by("entity_type", place).alias("entity_type"), F.min(place).alias("_first"))
    at = numbered(each, ["_first", "norm"], "number")
    return at.select("norm", "entity_type", F.col("_first.ord").alias("first_ord"), "number", F.floor(F.col("number") / chunk).cast("long").alias("chunk"))


def registry(aliases: DataFrame, resolved: DataFrame | None = None, resolutions: DataFrame | None = None) -> DataFrame:
    """(place, canonical_id, canonical_name, entity_type, aliases): seeds, then resolutions, then self-registered mentions.

    First name and type win; aliases are normalised and distinct in order.  Seeds are always there.
    resolutions: rows of ``annotate.resolutions``; resolved: mentions after ``resolve``.
    """
    step = lambda n, *order: F.struct(F.lit(n).alias("step"), *[o.cast("double").alias(f"o{i}") for i, o in enumerate(order)])
    zero = F.lit(0)
    rows = dictionary(aliases).select(step(0, F.col("ord"), zero, zero).alias("at"), "canonical_id", "canonical_name", "entity_type", "norm")
    if resolutions is not None:
        each = resolutions.select("chunk", "nth", "canonical_id", "canonical_name", "entity_type", F.posexplode("surface_forms").alias("k", "form"))
        rows = rows.unionByName(each.select(step(1, F.col("chunk"), F.col("nth"), F.col("k")).alias("at"), "canonical_id", "canonical_name", "entity_type", t.normalise(F.col("form")).alias("norm")))
    if resolved is not None:
        own = resolved.where((F.col("resolution_confidence") == FALLBACK_CONFIDENCE) & (F.col("canonical_id") == t.slug(F.col("surface_form"))))
        rows = rows.unionByName(own.select(step(2, F.col("ord"), F.col("alias_ord"), zero).alias("at"), "canonical_id", F.col("surface_form").alias("canonical_name"), "entity_type", t.normalise(F.col("surface_form")).alias("norm")))
    # An entity's aliases are distinct before they are gathered: a name that a third of all texts hold is one of them.
    first = rows.groupBy("canonical_id", "norm").agg(F.min("at").alias("at"), F.min_by("canonical_name", "at").alias("canonical_name"), F.min_by("entity_type", "at").alias("entity_type"))
    return first.groupBy("canonical_id").agg(
        F.min("at").alias("place"),
        F.min_by("canonical_name", "at").alias("canonical_name"),
        F.min_by("entity_type", "at").alias("entity_type"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "norm"))), lambda x: x["norm"]), "|").alias("aliases"),
    )


def unresolved_flags(resolved: DataFrame) -> DataFrame:
    """(place, flag_key, surface_form, entity_type, canonical_id, resolution_confidence, source_content_id): the first mention of each.

    Flagged is what has no id, or one with a confidence under LEAST_RESOLVED; both share one set of keys.
    """
    low = resolved.where(F.col("canonical_id").isNull() | (F.col("resolution_confidence") < LEAST_RESOLVED))
    place = F.struct("ord", "alias_ord")
    names = ("surface_form", "entity_type", "canonical_id", "resolution_confidence", "id")
    first = low.groupBy(F.coalesce("canonical_id", "surface_form").alias("flag_key")).agg(F.min(F.struct(place.alias("place"), *names)).alias("_f"))
    return first.select("_f.place", "flag_key", *[F.col(f"_f.{n}").alias("source_content_id" if n == "id" else n) for n in names])
