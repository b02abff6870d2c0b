"""SQL for DuckDB that gives the rows of the registered queries."""

from __future__ import annotations

from tidemark.functions.text import NUMBER
from tidemark.operators.entities import alias_rows
from tidemark.operators.analysis import METRICS
from tidemark.plans import fixtures as fx
from tidemark.plans.catalog import HEADLINE, KEPT_ALIASES, LINK_BASE, METRIC, REPEATED

_VALUES = ", ".join("({}, '{}', '{}', '{}')".format(i, *(x.replace("'", "''") for x in row)) for i, *row in alias_rows())
_NORM = r"regexp_replace(regexp_replace(regexp_replace(trim(lower({0})), '^the\s+', ''), '[''`]', '', 'g'), '\s+', ' ', 'g')"
_SLUG = "trim(regexp_replace(lower({0}), '[^a-z0-9]+', '_', 'g'), '_')"
#: The smaller dictionary: the entities of these aliases, by alias or by their own name.
_FEW = "(alias IN ({0}) OR ord % 1 = 0.5 AND canonical_id IN (SELECT canonical_id FROM aliases WHERE alias IN ({0})))".format(", ".join(f"'{a}'" for a in KEPT_ALIASES))

ITEMS = r"""
items AS (
  SELECT *, sha256(regexp_replace(regexp_replace(lower(combined), '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g'), '[\s\p{Z}]+', ' ', 'g')) AS content_hash FROM (
    SELECT *, title || ' ' || body AS combined FROM (
      SELECT CAST(doc_id AS VARCHAR) AS id, source AS source_name, doc_id AS ord, split_part(coalesce(text, ''), chr(10), 1) AS title,
             CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) ELSE '' END AS body FROM documents)))
"""
ALIASES = f"""
aliases AS (
  SELECT *, {_NORM.format("alias")} AS norm, {_SLUG.format("canonical_name")} AS canonical_id
  FROM (VALUES {_VALUES}) AS v(ord, alias, canonical_name, entity_type))
"""
DICTIONARY = f"""
dictionary AS (
  SELECT ord::DOUBLE AS ord, alias, canonical_name, entity_type, norm, canonical_id FROM aliases
  UNION ALL SELECT min(ord) + 0.5, lower(arg_min(canonical_name, ord)), arg_min(canonical_name, ord), arg_min(entity_type, ord), {_NORM.format("arg_min(canonical_name, ord)")}, canonical_id FROM aliases GROUP BY canonical_id)
"""
MENTIONS = """
mentions AS (
  SELECT i.id, i.source_name, i.ord, a.ord AS alias_ord, a.alias AS surface_form, a.entity_type,
         strpos(lower(i.combined), a.alias) - 1 AS span_start, strpos(lower(i.combined), a.alias) - 1 + length(a.alias) AS span_end
  FROM items i JOIN aliases a ON contains(lower(i.combined), a.alias))
"""


def _resolved(where: str) -> str:
    return f"""
resolved AS (
  SELECT m.*, coalesce(d.canonical_id, {_SLUG.format("m.surface_form")}) AS canonical_id,
         coalesce(d.canonical_name, k.canonical_name, m.surface_form) AS canonical_name, CASE WHEN d.norm IS NULL THEN 0.3 ELSE 1.0 END::DOUBLE AS resolution_confidence
  FROM mentions m
  LEFT JOIN (SELECT norm, arg_max(canonical_id, ord) AS canonical_id, arg_max(canonical_name, ord) AS canonical_name FROM dictionary WHERE {where} GROUP BY norm) d ON d.norm = {_NORM.format("m.surface_form")}
  LEFT JOIN (SELECT canonical_id, arg_min(canonical_name, ord) AS canonical_name FROM dictionary WHERE {where} GROUP BY canonical_id) k ON k.canonical_id = {_SLUG.format("m.surface_form")})
"""


_BASE = f"WITH {ITEMS}, {ALIASES}, {DICTIONARY}, {MENTIONS}"
_ALL, _SOME = f"{_BASE}, {_resolved('true')}", f"{_BASE}, {_resolved(_FEW)}"
SENTIMENTS = """
sentiments AS (
  SELECT r.ord, r.canonical_id, r.canonical_name, CASE WHEN l.toxic = 1 THEN 'bearish' WHEN l.quality = 1 THEN 'bullish' ELSE 'neutral' END AS label,
         greatest(-1.0, least(1.0, l.quality - 2.0 * l.toxic))::DOUBLE AS score, greatest(0.0, least(1.0, 0.5 + (l.doc_id % 10) / 10.0))::DOUBLE AS confidence,
         r.surface_form AS evidence_span, r.source_name
  FROM resolved r JOIN labels l ON l.doc_id = r.ord)
"""
CONFLICTS = """
conflicts AS (
  SELECT a.canonical_id, a.ord AS ord_a, a.label AS label_a, a.source_name AS source_name_a, b.ord AS ord_b, b.label AS label_b, b.source_name AS source_name_b,
         a.canonical_name, a.confidence AS confidence_a, b.confidence AS confidence_b
  FROM sentiments a JOIN sentiments b ON a.canonical_id = b.canonical_id AND a.ord < b.ord AND a.label <> b.label AND a.source_name <> b.source_name
  WHERE a.confidence >= 0.6 AND b.confidence >= 0.6 AND a.label IN ('bullish', 'bearish') AND b.label IN ('bullish', 'bearish'))
"""
_READ = " UNION ALL ".join(f"SELECT '{m}' AS metric, ord, source_name, regexp_extract_all(combined, '(?i){p}', 1) AS v FROM items" for m, p in METRIC.items())
READINGS = f"readings AS (SELECT metric, ord, unnest(range(len(v))) AS nth, source_name, CAST(unnest(v) AS DOUBLE) AS value FROM ({_READ}))"
INCONSISTENT = """
inconsistent AS (
  SELECT DISTINCT a.metric, a.value AS value_a, b.value AS value_b, a.source_name AS source_a, b.source_name AS source_b
  FROM readings a JOIN readings b ON a.metric = b.metric AND (a.ord < b.ord OR a.ord = b.ord AND a.nth < b.nth) AND a.source_name <> b.source_name
  WHERE a.value <> 0 AND abs(a.value - b.value) / abs(a.value) > 0.005)
"""
_PRICE = "CASE WHEN contains(model, 'gpt-4o-mini') THEN {0} WHEN contains(model, 'gpt-4o') THEN {1} WHEN contains(model, 'gpt-4-turbo') THEN {2} ELSE {3} END"
CALLS = f"""
calls AS (
  SELECT *, (prompt_tokens * {_PRICE.format(0.00015, 0.0025, 0.01, 0.001)} + completion_tokens * {_PRICE.format(0.0006, 0.01, 0.03, 0.003)}) / 1000 AS estimated_cost
  FROM (SELECT conv_id, ['extraction', 'resolution', 'sentiment'][conv_id % 3 + 1] AS stage, ['openai/gpt-4o-mini-2024', 'gpt-4o', 'gpt-4-turbo', 'gpt-5'][conv_id % 4 + 1] AS model,
               CASE WHEN conv_id % 5 = 0 THEN '' ELSE 's' || (conv_id % 7) END AS source_name,
               CAST(sum(CASE WHEN role <> 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS prompt_tokens, CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS completion_tokens
        FROM conversations GROUP BY conv_id))
"""
LINKS = f"""
links AS (SELECT page_id, pos, CASE WHEN starts_with(href, 'http') THEN href ELSE '{LINK_BASE}' || href END AS url FROM (
  SELECT page_id, unnest(range(len(h))) AS pos, unnest(h) AS href FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS h FROM pages)))
"""
_CAPPED = "SELECT * FROM items QUALIFY row_number() OVER (PARTITION BY source_name ORDER BY ord) <= 5"
_N = NUMBER.replace("'", "''")

ORACLES = {
    "content_items": f"WITH {ITEMS} SELECT id, source_name, title, body, content_hash FROM items",
    "cap_per_source": f"WITH {ITEMS} SELECT id, source_name FROM ({_CAPPED})",
    "dedup_first_wins": f"WITH {ITEMS} SELECT id, content_hash FROM items QUALIFY row_number() OVER (PARTITION BY content_hash ORDER BY source_name, ord) = 1",
    "cap_then_dedup": f"WITH {ITEMS} SELECT id, source_name, title, body, content_hash FROM ({_CAPPED}) QUALIFY row_number() OVER (PARTITION BY content_hash ORDER BY source_name, ord) = 1",
    "source_union_filter": f"WITH {ITEMS} SELECT id, source_name FROM items WHERE source_name IN ('src1', 'src3')",
    "headline_filter": f"WITH {ITEMS} SELECT id, title FROM items WHERE length(title) >= 20 AND regexp_matches(title, '{HEADLINE}')",
    "number_values": f"""WITH {ITEMS}, found AS (
        SELECT id, unnest(range(len(v))) AS spot, CAST(replace(unnest(v), ',', '') AS DOUBLE) AS value, coalesce(unnest(u), '') AS unit
        FROM (SELECT id, regexp_extract_all(combined, '(?i){_N}', 1) AS v, regexp_extract_all(combined, '(?i){_N}', 2) AS u FROM items)
      ), firsts AS (SELECT id, value, unit, min(spot) AS spot FROM found GROUP BY ALL)
      SELECT id, row_number() OVER (PARTITION BY id ORDER BY spot) - 1 AS pos, value, unit FROM firsts""",
    "ner_batches": rf"WITH {ITEMS} SELECT id, source_name, (row_number() OVER (ORDER BY source_name, ord) - 1) // 5 AS batch FROM items WHERE length(regexp_replace(combined, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')) >= 20",
    "gazetteer_mentions": f"{_BASE} SELECT id, surface_form, entity_type, span_start, span_end FROM mentions",
    "alias_resolution": f"{_SOME} SELECT id, surface_form, canonical_id, canonical_name, resolution_confidence FROM resolved",
    "unresolved_surfaces": f"""{_BASE}, left_ AS (SELECT *, {_NORM.format("surface_form")} AS norm FROM mentions), each_ AS (
        SELECT norm, arg_min(entity_type, ord * 1000 + alias_ord) AS entity_type, min(ord) AS first_ord, min(ord * 1000 + alias_ord) AS f FROM left_
        WHERE norm NOT IN (SELECT norm FROM dictionary WHERE {_FEW}) GROUP BY norm)
      SELECT norm, entity_type, first_ord, row_number() OVER (ORDER BY f, norm) - 1 AS number, (row_number() OVER (ORDER BY f, norm) - 1) // 30 AS chunk FROM each_""",
    "entity_registry_aliases": f"""WITH {ALIASES}, {DICTIONARY}, each_ AS (SELECT canonical_id, norm, min(ord) AS o FROM dictionary GROUP BY ALL)
      SELECT a.canonical_id, arg_min(a.canonical_name, a.ord) AS canonical_name, arg_min(a.entity_type, a.ord) AS entity_type,
             (SELECT string_agg(norm, '|' ORDER BY o) FROM each_ e WHERE e.canonical_id = a.canonical_id) AS aliases FROM aliases a GROUP BY a.canonical_id""",
    "unresolved_flags": f"""{_SOME}, low AS (SELECT *, coalesce(canonical_id, surface_form) AS flag_key FROM resolved WHERE canonical_id IS NULL OR resolution_confidence < 0.5)
      SELECT flag_key, surface_form, entity_type, canonical_id, resolution_confidence, id AS source_content_id FROM low QUALIFY row_number() OVER (PARTITION BY flag_key ORDER BY ord, alias_ord) = 1""",
    "entity_sentiments": f"{_ALL}, {SENTIMENTS} SELECT * FROM sentiments",
    "sentiment_conflicts": f"{_ALL}, {SENTIMENTS}, {CONFLICTS} SELECT * FROM conflicts",
    "sentiment_summary": f"""{_ALL}, {SENTIMENTS}, counted AS (SELECT canonical_name, label, count(*) AS n, min(ord) AS f FROM sentiments GROUP BY ALL),
      mode AS (SELECT canonical_name, label FROM counted QUALIFY row_number() OVER (PARTITION BY canonical_name ORDER BY n DESC, f) = 1)
      SELECT s.canonical_name, avg(score) AS avg_score, avg(confidence) AS avg_confidence, (SELECT string_agg(x, '|' ORDER BY x) FROM (SELECT DISTINCT source_name AS x FROM sentiments z WHERE z.canonical_name = s.canonical_name)) AS sources,
             arg_min(evidence_span, ord) AS evidence, any_value(m.label) AS dominant_label FROM sentiments s JOIN mode m ON m.canonical_name = s.canonical_name GROUP BY s.canonical_name""",
    "numeric_readings": f"WITH {ITEMS}, {READINGS} SELECT * FROM readings",
    "numeric_inconsistency": f"WITH {ITEMS}, {READINGS}, {INCONSISTENT} SELECT * FROM inconsistent",
    "qa_union": f"""{_BASE}, {_resolved("true")}, {SENTIMENTS}, {CONFLICTS}, {_resolved(_FEW).replace("resolved AS", "resolved_few AS", 1)}, {READINGS}, {INCONSISTENT}
      SELECT 'sentiment_conflict' AS flag_type, canonical_id || '|' || ord_a || '|' || ord_b AS key FROM conflicts
      UNION ALL SELECT DISTINCT 'unresolved_entity', coalesce(canonical_id, surface_form) FROM resolved_few WHERE resolution_confidence < 0.5
      UNION ALL SELECT 'numeric_inconsistency', metric || '|' || source_a || '|' || source_b FROM inconsistent""",
    "cost_records": f"WITH {CALLS} SELECT conv_id, stage, model, prompt_tokens, completion_tokens, CAST(estimated_cost AS DOUBLE) AS estimated_cost FROM calls",
    "cost_by_stage": f"WITH {CALLS} SELECT stage, CAST(sum(CAST(estimated_cost AS DECIMAL(18, 8))) AS DOUBLE) AS cost FROM calls GROUP BY stage",
    "cost_by_source": f"WITH {CALLS} SELECT source_name, CAST(sum(CAST(estimated_cost AS DECIMAL(18, 8))) AS DOUBLE) AS cost FROM calls WHERE source_name <> '' GROUP BY source_name",
    "cost_total": f"WITH {CALLS} SELECT CAST(round(sum(CAST(estimated_cost AS DECIMAL(18, 8))), 6) AS DOUBLE) AS cost FROM calls",
    "run_summary": f"{_BASE} SELECT count(DISTINCT source_name) AS sources, count(*) AS items, count(DISTINCT content_hash) AS distinct_items, (SELECT count(*) FROM mentions) AS mentions FROM items",
    "page_titles": "SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages",
    "page_links": f"WITH {LINKS} SELECT page_id, pos, url FROM links",
    "page_top_links": f"WITH {LINKS} SELECT page_id, pos, url FROM links WHERE pos < 3",
    "links_until_repeat": f"""WITH links(page, pos, url) AS (VALUES {", ".join(map(str, REPEATED))}), seen AS (
        SELECT page, pos, url, row_number() OVER (PARTITION BY page, url ORDER BY pos) AS k, row_number() OVER (PARTITION BY page ORDER BY pos) AS n FROM links)
      SELECT page::BIGINT AS page, pos::BIGINT AS pos, url FROM seen s WHERE n <= 20 AND NOT EXISTS (SELECT 1 FROM seen t WHERE t.page = s.page AND t.pos <= s.pos AND t.k > 1)""",
    "sentiment_match": f"""{_BASE}, {_resolved("true")}, said AS (
        SELECT ord AS item, alias_ord * 2 AS nth, upper(surface_form) AS surface FROM resolved
        UNION ALL SELECT ord, alias_ord * 2 + 1, 'on ' || split_part(canonical_name, ' ', -1) || ' talk' FROM resolved),
      pairs AS (
        SELECT s.item, s.nth, s.surface, r.canonical_id, r.canonical_name, r.alias_ord AS place, CASE
          WHEN contains(lower(r.canonical_name), lower(s.surface)) OR contains(lower(s.surface), lower(r.canonical_name))
            OR EXISTS (SELECT 1 FROM resolved x WHERE x.ord = r.ord AND x.canonical_id = r.canonical_id AND lower(x.surface_form) = lower(s.surface)) THEN 1
          WHEN len(list_filter(string_split(lower(r.canonical_name), ' '), lambda w: length(w) > 2 AND contains(lower(s.surface), w))) > 0 THEN 2 END AS level
        FROM said s JOIN resolved r ON r.ord = s.item)
      SELECT item, nth, surface, canonical_id, canonical_name FROM pairs WHERE level IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY item, nth ORDER BY level, place) = 1""",
    "json_path": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "parse_dates": "SELECT o_orderkey, strftime(o_orderdate, '%B %-d, %Y') AS raw, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS parsed FROM orders",
}
ORACLES["sentiment_lines"] = f"""SELECT canonical_name, '- ' || canonical_name || ': ' || dominant_label || ' (avg score ' || printf('%+.2f', round(avg_score, 2)) || ', confidence ' || printf('%.2f', round(avg_confidence, 2))
  || ') | sources: ' || replace(sources, '|', ', ') || ' | evidence: "' || substr(evidence, 1, 100) || '..."' AS line FROM ({ORACLES["sentiment_summary"]})"""


def _text(x: object) -> str:
    return "NULL" if x is None else repr(x) if not isinstance(x, str) else "'" + x.replace("'", "''") + "'"


def _rows(columns: str, *rows: tuple) -> str:
    """Rows that were worked out by hand from the rules.  columns: name and type, comma-separated."""
    named = [c.split() for c in columns.split(", ")]
    return f"SELECT {', '.join(f'CAST({n} AS {k}) AS {n}' for n, k in named)} FROM (VALUES {', '.join('(' + ', '.join(map(_text, r)) + ')' for r in rows)}) AS t({', '.join(n for n, _ in named)})"


_STRIP = r"regexp_replace({0}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"
_FX_ITEMS = ITEMS.replace("FROM documents", f"FROM (VALUES {', '.join(f'({i}, {_text(s)}, {_text(t)})' for i, s, t in fx.ITEMS)}) AS d(doc_id, source, text)")
_METRIC_READ = " UNION ALL ".join(f"SELECT '{m}' AS metric, ord, source_name, regexp_extract_all(combined, '(?i){p}', 1) AS v FROM items" for m, p in METRICS.items())
_ANSWERS = ", ".join(f"({k}, {_text(v)})" for k, v in fx.RECOGNISED)
_BATCHED = f"""
batched AS (
  SELECT *, n // 5 AS batch, n % 5 AS place FROM (SELECT *, row_number() OVER (ORDER BY source_name, ord) - 1 AS n FROM items WHERE length({_STRIP.format("combined")}) >= 20))
"""
_LISTING = "source_key VARCHAR, source_name VARCHAR, ord BIGINT, source_url VARCHAR, title VARCHAR, body VARCHAR, published VARCHAR"
_QA = (
    ("sentiment_conflict", "eur_usd", "'EUR/USD' is bullish (0.60) per Federal Reserve, but bearish (0.62) per Reuters.", "Federal Reserve|Reuters"),
    ("unresolved_entity", "s_p_500", "Entity 'S&P-500' resolved to 's_p_500' with low confidence (0.30).", "3"),
    ("unresolved_entity", "", "Entity '日本' resolved to '' with low confidence (0.30).", "6"),
    ("numeric_inconsistency", None, "'CPI' shows inconsistent values across sources: 3.1 (Federal Reserve) vs 3.4 (IMF), difference: 9.7%.", "Federal Reserve|IMF"),
    ("numeric_inconsistency", None, "'interest rate' shows inconsistent values across sources: 5.25 (Federal Reserve) vs 5.5 (Reuters), difference: 4.8%.", "Federal Reserve|Reuters"),
    ("numeric_inconsistency", None, "'GDP' shows inconsistent values across sources: 2.9 (IMF) vs 3.1 (Yahoo Finance Markets), difference: 6.9%.", "IMF|Yahoo Finance Markets"),
    ("numeric_inconsistency", None, "'USD/JPY rate' shows inconsistent values across sources: 150.25 (IMF) vs 151.1 (Yahoo Finance Markets), difference: 0.6%.", "IMF|Yahoo Finance Markets"),
)
_SUMMARY = (
    '- EUR/USD: bullish (avg score -0.84, confidence 0.61) | sources: Federal Reserve, Reuters | evidence: "..."',
    '- European Central Bank: neutral (avg score +0.00, confidence 0.50) | sources: Reuters | evidence: "..."',
    f'- Federal Reserve: bullish (avg score +0.50, confidence 0.80) | sources: Federal Reserve | evidence: "{"kept " * 20}..."',
    '- GDP: bearish (avg score -0.04, confidence 0.74) | sources: IMF, Reuters | evidence: "..."',
    '- J. Powell: bearish (avg score -0.10, confidence 0.90) | sources: Reuters | evidence: "..."',
)

ORACLES |= {
    "conflict_messages": f"""{_ALL}, {SENTIMENTS}, {CONFLICTS} SELECT canonical_id AS entity_id, printf('''%s'' is %s (%.2f) per %s, but %s (%.2f) per %s.', canonical_name, label_a, confidence_a, source_name_a, label_b, confidence_b, source_name_b) AS details,
      source_name_a || '|' || source_name_b AS sources FROM conflicts""",
    "numeric_messages": f"""WITH {ITEMS}, {READINGS}, {INCONSISTENT}, said AS (SELECT '''' || metric || ''' shows inconsistent values across sources: ' || value_a || ' (' || source_a || ') vs ' || value_b || ' (' || source_b || '), difference: '
      || printf('%.1f', abs(value_a - value_b) / abs(value_a) * 100) || '%.' AS details, source_a || '|' || source_b AS sources FROM inconsistent) SELECT DISTINCT * FROM said""",
    "number_context": f"""WITH {ITEMS}, split AS (
        SELECT id, combined, string_split_regex(combined, '(?i){_N}') AS gap, regexp_extract_all(combined, '(?i){_N}', 0) AS m, regexp_extract_all(combined, '(?i){_N}', 1) AS v, regexp_extract_all(combined, '(?i){_N}', 2) AS u FROM items),
      each_ AS (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM split),
      found AS (SELECT id, combined, i, length(m[i]) AS size, list_sum(list_transform(gap[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS start,
                CAST(replace(v[i], ',', '') AS DOUBLE) AS value, coalesce(u[i], '') AS unit FROM each_),
      firsts AS (SELECT * FROM found QUALIFY row_number() OVER (PARTITION BY id, value, unit ORDER BY i) = 1)
      SELECT id, row_number() OVER (PARTITION BY id ORDER BY i) - 1 AS pos, value, unit,
             {_STRIP.format("substr(combined, greatest(0, start - 30)::BIGINT + 1, (start + size + 30 - greatest(0, start - 30))::BIGINT)")} AS context_span FROM firsts""",
    "context_windows": f"""{_BASE} SELECT m.id, m.surface_form, substr(i.combined, greatest(0, m.span_start - 400) + 1, m.span_start + 400 - greatest(0, m.span_start - 400)) AS "window", least(12000, length(i.combined)) AS annotated_chars
      FROM mentions m JOIN items i ON i.id = m.id""",
    "page_anchors": r"""SELECT page_id, unnest(h) AS href, unnest(t) AS text FROM (
        SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS h, list_transform(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2), lambda x: trim(x)) AS t FROM pages)""",
    "fed_listing": _rows(_LISTING, ("fed", "Federal Reserve", 0, "https://www.federalreserve.gov/a/monetary2.html", "Policystatementreleased", "Policy Rates stay .", "2024-03-12 00:00"), ("fed", "Federal Reserve", 1, "https://elsewhere.org/fomc3.htm", "FOMC & minutes, third", "Menu Minutes of the meeting", None)),
    "imf_listing": _rows(_LISTING, ("imf", "IMF", 0, "https://www.imf.org/en/News/Articles/one", "First article of the list", "The body itself", "2024-02-02 00:00"), ("imf", "IMF", 1, "https://www.imf.org/en/Publications/three", "Third, a publication", "", None)),
    "markets_listing": _rows(
        _LISTING,
        ("yahoo_markets", "Yahoo Finance Markets", 0, "page0", "Stocks rally on a broad front", "Gains werebroad", "2024-03-01 09:30"), ("yahoo_markets", "Yahoo Finance Markets", 1, "page0", "Bonds fall as yields climb", "", None),
        ("yahoo_markets", "Yahoo Finance Markets", 0, "page1", "Yahoo Finance Markets Overview", "No headline", None), ("yahoo_markets", "Yahoo Finance Markets", 0, "page2", "Yahoo Finance Markets Overview", "", None),
    ),
    "headline_listing": _rows(
        _LISTING,
        ("reuters", "Reuters", 0, "page0", "Dollar firms before payrolls data", "It may end", "2024-03-02 08:00"), ("reuters", "Reuters", 1, "page0", "Bank of Japan hints at a change", "It may end", "2024-03-02 08:00"),
        ("reuters", "Reuters", 0, "page1", "Reuters Currencies Market Overview", "Only text", None),
    ),
    "quote_listing": _rows(
        _LISTING,
        *(("yahoo_eurusd", "Yahoo Finance (EUR/USD)", 0, f"page{i}", "EUR/USD Exchange Rate", body, None) for i, body in enumerate(("EUR/USD price: 1.0861 | Open: 1.0850 | Range: 1.08to1.09", "EUR/USD rate: 1.0842, change: N/A%", "Just text"))),
    ),
    "two_tiers": _rows("page_url VARCHAR, html VARCHAR", ("page0", "a"), ("page1", "y")),
    "date_formats": _rows(
        "n BIGINT, month_first VARCHAR, day_first VARCHAR, iso VARCHAR, written VARCHAR",
        (0, "2024-01-05 00:00", "2024-01-05 00:00", None, "January 5, 2024"), (1, "2024-01-05 00:00", "2024-01-05 00:00", None, ""), (2, None, "2024-01-05 00:00", None, ""), (3, "2024-01-05 00:00", "2024-01-05 00:00", "2024-01-05 00:00", ""),
        (4, None, None, None, ""), (5, "2024-03-12 00:00", "2024-03-12 00:00", None, "March 12, 2024"), (6, None, None, "2024-03-01 09:30", ""), (7, None, None, "2024-03-01 07:30", ""), (8, None, None, "2024-03-01 09:30", ""), (9, None, None, None, ""), (10, None, None, None, ""),
    ),
    "ner_flatten": f"""WITH {_FX_ITEMS}, {_BATCHED}, answers(batch, response) AS (VALUES {_ANSWERS}),
      lists AS (SELECT b.id, b.combined, json_extract(TRY_CAST(a.response AS JSON), '$.articles."' || b.place || '".entities') AS l FROM batched b JOIN answers a ON a.batch = b.batch),
      each_ AS (SELECT id, combined, unnest(range(json_array_length(l)::BIGINT)) AS alias_ord, l FROM lists),
      one AS (SELECT id, combined, alias_ord, json_extract(l, '$[' || alias_ord || ']') AS e FROM each_),
      named AS (SELECT id, combined, alias_ord, trim(e->>'surface_form') AS surface_form, trim(coalesce(e->>'entity_type', 'unknown')) AS entity_type FROM one
                WHERE json_type(e) = 'OBJECT' AND json_type(e, '$.surface_form') = 'VARCHAR' AND coalesce(json_type(e, '$.entity_type'), 'VARCHAR') = 'VARCHAR')
      SELECT id, alias_ord::BIGINT AS alias_ord, surface_form, entity_type, strpos(lower(combined), lower(surface_form)) - 1 AS span_start, strpos(lower(combined), lower(surface_form)) - 1 + length(surface_form) AS span_end
      FROM named WHERE surface_form <> '' AND contains(lower(combined), lower(surface_form))""",
    "resolution_last_wins": _rows("norm VARCHAR, canonical_id VARCHAR, canonical_name VARCHAR, confidence DOUBLE", ("jerome powell", "jerome_powell", "Jerome Powell", 0.95), ("powell", "j_powell", "J. Powell", 0.5)),
    "resolved_mentions": _rows(
        "id VARCHAR, alias_ord BIGINT, surface_form VARCHAR, canonical_id VARCHAR, canonical_name VARCHAR, resolution_confidence DOUBLE",
        ("1", 0, "the Fed", "federal_reserve", "Federal Reserve", 1.0), ("1", 1, "EUR/USD", "eur_usd", "EUR/USD", 1.0), ("1", 2, "EUR/USD", "eur_usd", "EUR/USD", 1.0), ("1", 7, "CPI", "cpi", "CPI", 1.0),
        ("2", 0, "ECB", "european_central_bank", "European Central Bank", 1.0), ("2", 1, "EUR/USD", "eur_usd", "EUR/USD", 1.0), ("2", 2, "Powell", "j_powell", "J. Powell", 0.5), ("2", 3, "GDP", "gdp", "GDP", 1.0),
        ("3", 0, "S&P-500", "s_p_500", "S&P 500", 0.3), ("3", 1, "Jerome Powell", "jerome_powell", "Jerome Powell", 0.95), ("3", 2, "GDP", "gdp", "GDP", 1.0),
        ("6", 0, "Reserve Bank of Australia", "reserve_bank_of_australia", "Reserve Bank of Australia", 1.0), ("6", 1, "日本", "", "日本", 0.3),
    ),
    "sentiment_parse": _rows(
        "id VARCHAR, nth BIGINT, canonical_id VARCHAR, canonical_name VARCHAR, label VARCHAR, score DOUBLE, confidence DOUBLE, evidence_span VARCHAR, source_name VARCHAR",
        ("1", 0, "federal_reserve", "Federal Reserve", "bullish", 1.0, 1.0, "kept " * 60, "Federal Reserve"), ("1", 1, "eur_usd", "EUR/USD", "bullish", -1.0, 0.6, "", "Federal Reserve"), ("1", 4, "federal_reserve", "Federal Reserve", "neutral", 0.0, 0.6, "", "Federal Reserve"),
        ("2", 0, "eur_usd", "EUR/USD", "bearish", -0.675, 0.625, "fell", "Reuters"), ("2", 1, "european_central_bank", "European Central Bank", "neutral", 0.0, 0.5, "", "Reuters"), ("2", 2, "j_powell", "J. Powell", "bearish", -0.1, 0.9, "", "Reuters"),
        ("2", 3, "gdp", "GDP", "bearish", -0.2, 0.59, "", "Reuters"), ("3", 0, "gdp", "GDP", "bullish", 0.125, 0.9, "grew 2.9%", "IMF"),
    ),
    "metric_readings": f"WITH {_FX_ITEMS}, readings AS (SELECT metric, ord, unnest(range(len(v))) AS nth, source_name, CAST(unnest(v) AS DOUBLE) AS value FROM ({_METRIC_READ})) SELECT metric, ord::BIGINT AS ord, nth, source_name, value FROM readings",
    "qa_flags": _rows("flag_type VARCHAR, entity_id VARCHAR, details VARCHAR, sources VARCHAR", *_QA),
    "qa_lines": _rows("line VARCHAR", *((f"[{kind.upper()}] {details}",) for kind, _, details, _ in _QA)),
    "first_flags": _rows("nth BIGINT, line VARCHAR", *((i, f"[{kind}] {details[:100]}") for i, (kind, _, details, _) in enumerate(_QA[:3]))),
    "briefing_context": _rows("context VARCHAR", ("## Entity Sentiment Summary (29 entities identified)\n" + "\n".join(_SUMMARY) + "\n\n## QA Flags\n" + "\n".join(f"[{kind.upper()}] {details}" for kind, _, details, _ in _QA),)),
    "briefing_texts": _rows("audience VARCHAR, text VARCHAR", ("trader", "Buy."), ("analyst", "On the other hand."), ("executive", "[Briefing generation failed for audience: executive]")),
    "call_records": _rows(
        "call_id VARCHAR, stage VARCHAR, model VARCHAR, prompt_tokens BIGINT, completion_tokens BIGINT, estimated_cost DOUBLE, source_name VARCHAR",
        ("extraction:0", "extraction", "gpt-4o", 1000, 200, 0.0045, "Federal Reserve"), ("extraction:1", "extraction", "gpt-4o", 1000, 200, 0.0045, "Zeta"), ("resolution:0", "resolution", "gpt-4o-mini", 300, 50, 0.000075, ""),
        ("sentiment:1", "sentiment", "gpt-5", 800, 120, 0.00116, "Federal Reserve"), ("sentiment:2", "sentiment", "gpt-5", 800, 120, 0.00116, "Reuters"), ("sentiment:3", "sentiment", "gpt-5", 800, 120, 0.00116, "IMF"), ("sentiment:6", "sentiment", "gpt-5", 800, 120, 0.00116, "Reuters"),
    ),
}
ORACLES["fallback_registry"] = f"""SELECT canonical_id, canonical_name, entity_type, CASE canonical_id WHEN 's_p_500' THEN aliases || '|s&p-500' ELSE aliases END AS aliases FROM ({ORACLES["entity_registry_aliases"]})
  UNION ALL {_rows("canonical_id VARCHAR, canonical_name VARCHAR, entity_type VARCHAR, aliases VARCHAR", ("jerome_powell", "Jerome Powell", "person", "powell|jerome powell"), ("j_powell", "J. Powell", "person", "powell"), ("", "日本", "country", "日本"))}"""
