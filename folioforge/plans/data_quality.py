"""Queries p3 (rows that fail to parse) and p4 (a few keys holding most records)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.operators import hot_keys, parse_rejects
from folioforge.session import table


def _parsed(spark: SparkSession, sf: str) -> DataFrame:
    return parse_rejects.parse_records(table(spark, sf, "raw_nodes"), table(spark, sf, "lexicon"))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return _parsed(spark, sf).where(F.col("reason").isNotNull()).select("row_no", "reason")


def p3_loaded(spark: SparkSession, sf: str) -> DataFrame:
    return _parsed(spark, sf).where(F.col("reason").isNull()).drop("reason")


def p3_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Records by export file and outcome."""
    parsed = _parsed(spark, sf).select("row_no", F.coalesce("reason", F.lit("loaded")).alias("outcome"))
    return parsed.groupBy("outcome").agg(F.count(F.lit(1)).alias("n_records"))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return hot_keys.hot_keys(table(spark, sf, "edges")).select("edge_type", "shared_item")


def p4_profile(spark: SparkSession, sf: str) -> DataFrame:
    return hot_keys.key_profile(table(spark, sf, "edges"))


QUERIES = {"p3_found": p3_found, "p3_loaded": p3_loaded, "p3_summary": p3_summary, "p4_found": p4_found, "p4_profile": p4_profile}

# RE2 accepts a well-quoted record as a whole; the fields of such a record are its matches of the field pattern.
_FIELD = r'(?:"(?:[^"]|"")*"|[^",\n\r]*)'
_PARSED = rf"""
quoted AS (SELECT row_no, coalesce(raw_line, '') AS l, regexp_full_match(coalesce(raw_line, ''), '{_FIELD}(?:,{_FIELD})*') AS ok FROM raw_nodes),
fields AS (SELECT row_no, ok, CASE WHEN ok THEN list_transform(regexp_extract_all(',' || l, ',({_FIELD})', 1), lambda x: CASE WHEN x LIKE '"%' THEN replace(substr(x, 2, length(x) - 2), '""', '"') ELSE x END) END AS f FROM quoted),
lex AS (SELECT list(DISTINCT item) AS items FROM lexicon),
reasons AS (SELECT row_no, f, CASE
  WHEN NOT ok THEN 'quoting'
  WHEN len(f) <> 10 THEN 'column_count'
  WHEN f[1] = '' OR f[2] <> 'Node' OR NOT ends_with(f[3], '.gml')
    OR regexp_matches(f[4], '[\x00-\x08\x0b-\x1f\x7f-\x{{9f}}\x{{fffd}}]')
    OR (f[5] <> '' AND NOT list_has_all(items, string_split(f[5], ', ')))
    OR (f[6] <> '' AND NOT list_has_all(items, string_split(f[6], ', ')))
    OR (f[7] <> '' AND NOT list_has_all(items, string_split(f[7], ', ')))
    OR NOT regexp_full_match(f[8], '(parent_[0-9]+)?') THEN 'value' END AS reason
  FROM fields, lex)
"""
_COLUMNS = ", ".join(f"f[{k}] AS {name}" for k, name in enumerate(parse_rejects.NODE_FIELDS, 1))

ORACLES = {
    "p3_found": f"WITH {_PARSED} SELECT row_no, reason FROM reasons WHERE reason IS NOT NULL",
    "p3_loaded": f"WITH {_PARSED} SELECT row_no, {_COLUMNS} FROM reasons WHERE reason IS NULL",
    "p3_summary": f"WITH {_PARSED} SELECT coalesce(reason, 'loaded') AS outcome, count(*) AS n_records FROM reasons GROUP BY 1",
    "p4_found": """
SELECT edge_type, shared_item FROM edges WHERE edge_type <> '' AND shared_item <> ''
GROUP BY 1, 2 HAVING count(*) >= 0.02 * (SELECT count(*) FROM edges)""",
    "p4_profile": """
WITH v AS (SELECT * FROM edges WHERE edge_type <> '' AND shared_item <> ''),
r AS (SELECT edge_type, shared_item, count(*) AS n_rows,
  count(DISTINCT CASE WHEN node1 IS NOT NULL AND node2 IS NOT NULL THEN {'a': least(node1, node2), 'b': greatest(node1, node2)} END) AS n_edges
  FROM v GROUP BY 1, 2),
n AS (SELECT edge_type, shared_item, count(DISTINCT node) AS n_nodes
  FROM (SELECT edge_type, shared_item, node1 AS node FROM v UNION ALL SELECT edge_type, shared_item, node2 FROM v) GROUP BY 1, 2)
SELECT r.edge_type, r.shared_item, n_rows, n_edges, n_nodes FROM r JOIN n USING (edge_type, shared_item)""",
}
