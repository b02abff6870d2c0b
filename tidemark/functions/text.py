"""Text scalars as column expressions.  White space is Unicode's, with the four ASCII separators.

Null texts give null, or no numbers; nothing here shuffles or leaves the JVM but ``rendered``, which
formats doubles as C does and belongs in the last step of a plan.
"""

from __future__ import annotations

import re
from string import Formatter

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\s\x1c-\x1f]"
# The number pattern, the months, the length of texts for the annotator, of contexts and of evidence.
NUMBER = r"(-?\d{1,3}(?:,\d{3})*(?:\.\d+)?)(?:\s*(%|bps|bp|bn|trn|mn|billion|trillion|million|USD|EUR|GBP|JPY|pct|pp))?"
# As DuckDB's expressions take it: ASCII digits, five spaces, the long s is an s.  And what its \s and \p{Z} strip.
PLAIN_NUMBER = re.sub("s", "[sſ]", NUMBER.replace(r"\s", r"[\t\n\f\r ]"), flags=re.I)
PLAIN_SPACE = "\t\n\f\r \xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
MONTH_DATE = r"(January|February|March|April|May|June|July|August|September|October|November|December)\s+\d{1,2},\s+\d{4}"
ANNOTATED_CHARS, CONTEXT_CHARS, WINDOW_CHARS, EVIDENCE_CHARS = 12_000, 30, 800, 300


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"(?U)^{SPACE}+|{SPACE}+$", "")


def collapse(text: Column) -> Column:
    return F.regexp_replace(text, f"(?U){SPACE}+", " ")


def content_hash(text: Column) -> Column:
    """SHA-256 of the stripped, lower-cased text with single spaces."""
    return F.sha2(collapse(strip(F.lower(text))).cast("binary"), 256)


def normalise(surface: Column) -> Column:
    """Look-up key of a surface form: one leading "the", straight quotes and backticks go."""
    bare = F.regexp_replace(strip(F.lower(surface)), f"(?U)^the{SPACE}+", "")
    return collapse(F.regexp_replace(bare, "['`]", ""))


def slug(name: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "_"), F.lit("_"))


def span_start(text: Column, surface: Column) -> Column:
    """0-based place of the first occurrence, ignoring case."""
    return F.instr(F.lower(text), F.lower(surface)) - 1


def annotated(text: Column) -> Column:
    """What an annotator gets to see."""
    return F.substring(text, 1, ANNOTATED_CHARS)


def context_window(text: Column, surface: Column, window: int = WINDOW_CHARS) -> Column:
    """The text around the first occurrence of surface, half a window on both sides; its beginning if there is none."""
    at = span_start(text, surface)
    start = F.greatest(F.lit(0), at - window // 2)
    return F.when(at < 0, F.substring(text, 1, window)).otherwise(F.substr(text, start + 1, at + window // 2 - start))


def evidence(text: Column, chars: int = EVIDENCE_CHARS) -> Column:
    return F.substring(text, 1, chars)


def numbers(text: Column) -> Column:
    """array<struct<value, unit>> in order of first appearance; units keep their case."""
    found = F.arrays_zip(F.regexp_extract_all(text, F.lit(f"(?i){NUMBER}"), F.lit(1)).alias("v"), F.regexp_extract_all(text, F.lit(f"(?i){NUMBER}"), F.lit(2)).alias("u"))
    return F.array_distinct(F.transform(found, lambda x: F.struct(F.regexp_replace(x["v"], ",", "").cast("double").alias("value"), F.coalesce(x["u"], F.lit("")).alias("unit"))))


def numbers_in_context(text: Column, around: int = CONTEXT_CHARS, plain: bool = False) -> Column:
    """array<struct<value, unit, context_span>>: as ``numbers``, with the text around each first appearance.

    Offsets are beyond the JVM's regular expressions, so this one is an Arrow-batched function; digits
    and spaces are Unicode's here, and -0 and 0 are two numbers.  plain: they are one, of which the first
    stays, and digits and spaces are those of SQL.
    """

    @F.pandas_udf("array<struct<value: double, unit: string, context_span: string>>")
    def find(texts: pd.Series) -> pd.Series:
        pattern = re.compile(PLAIN_NUMBER, re.I | re.A) if plain else re.compile(NUMBER, re.I)
        key, stripped = (float, PLAIN_SPACE) if plain else (repr, None)

        def of(body: str | None) -> list[dict] | None:
            first: dict[tuple[str | float, str], dict] = {}
            for m in pattern.finditer(body or ""):
                value, unit = float(m[1].replace(",", "")), m[2] or ""
                if (key(value), unit) not in first:
                    first[key(value), unit] = {"value": value, "unit": unit, "context_span": body[max(0, m.start() - around) : m.end() + around].strip(stripped)}
            return None if body is None else list(first.values())

        return texts.map(of)

    return find(text)


def parse_date(raw: Column, day_first: bool = False) -> Column:
    formats = ["MMMM d, yyyy", "MMM d, yyyy", *(["d MMMM yyyy"] if day_first else []), "yyyy-MM-dd"]
    return F.coalesce(*[F.try_to_timestamp(strip(raw), F.lit(f)) for f in formats])


def written_date(text: Column) -> Column:
    """The first full English date in the text; empty if there is none."""
    return F.regexp_extract(text, MONTH_DATE, 0)


def parse_iso(raw: Column) -> Column:
    """An ISO 8601 time; with no zone it is UTC (the session's time zone should be); anything else is null."""
    return F.when(raw.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:?\d{2}(:?\d{2}(\.\d+)?)?)?\s*(Z|[+-]\d{2}:?\d{2})?)?$"), raw.try_cast("timestamp"))


def absolute(href: Column, base: str) -> Column:
    return F.when(F.startswith(href, F.lit("http")), href).otherwise(F.concat(F.lit(base), href))


def rendered(template: str, **values: Column) -> Column:
    """Python's format of a template; doubles are rounded from their binary value, as C's printf does.

    A null in any value gives null.
    """
    names = list(dict.fromkeys(n for _, n, _, _ in Formatter().parse(template) if n))

    @F.pandas_udf("string")
    def render(rows: pd.DataFrame) -> pd.Series:
        lists = [rows[n].tolist() for n in names]
        return pd.Series([None if any(v is None or v != v for v in r) else template.format(**dict(zip(names, r))) for r in zip(*lists)], dtype="object")

    return render(F.struct(*[values[n].alias(n) for n in names]))
