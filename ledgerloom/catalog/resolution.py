"""Queries over name resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.catalog.tables import table
from ledgerloom.operators.report import by_confidence, changed_mappings, resolved_mappings, review_list
from ledgerloom.operators.resolve import (
    alias_dimension,
    best_fuzzy,
    canonical_dimension,
    distinct_names,
    mapping_log,
    method_counts,
    resolve_distinct,
)


def part_seeds(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct part names as canonical names in order of first use, each with two aliases."""
    names = table(spark, sf, "part").groupBy(F.col("p_name").alias("canonical")).agg(F.min("p_partkey").alias("seq"))
    aliases = F.array(F.concat(F.lit("the "), "canonical"), F.replace("canonical", F.lit(" "), F.lit("")))
    return names.select("canonical", aliases.alias("aliases"), "seq")


def misspelled_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Every part name without one character; the key decides which."""
    position = (F.col("p_partkey") % F.length("p_name")).cast("int")
    typo = F.concat(F.left("p_name", position), F.substring(F.col("p_name"), position + 2, F.length("p_name")))
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), typo.alias("raw_name"))


def messy_names(spark: SparkSession, sf: str) -> DataFrame:
    """Exact names, aliases, misspellings and unknown names, one per part and supplier."""
    part = table(spark, sf, "part")
    named = [
        part.select(F.concat(F.lit("a"), "p_partkey").alias("id"), F.concat(F.initcap("p_name"), F.lit(", Inc.")).alias("raw_name")),
        part.select(F.concat(F.lit("b"), "p_partkey").alias("id"), F.concat(F.lit("The "), "p_name").alias("raw_name")),
        misspelled_parts(spark, sf).select(F.concat(F.lit("c"), "id").alias("id"), "raw_name"),
        table(spark, sf, "supplier").select(F.concat(F.lit("d"), "s_suppkey").alias("id"), F.col("s_name").alias("raw_name")),
    ]
    merged = named[0]
    for more in named[1:]:
        merged = merged.unionByName(more)
    return merged


def alias_exact(spark: SparkSession, sf: str) -> DataFrame:
    """Customers' countries in three spellings against nations and their aliases."""
    seeds = table(spark, sf, "nation").select(
        F.col("n_name").alias("canonical"),
        F.array(F.concat(F.lit("Republic of "), F.replace("n_name", F.lit("_"), F.lit(" ")))).alias("aliases"),
        F.col("n_nationkey").alias("seq"),
    )
    number = F.col("c_nationkey").cast("string")
    raw = (
        F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("nation-"), number, F.lit(" Ltd.")))
        .when(F.col("c_mktsegment") == "MACHINERY", F.concat(F.lit("REPUBLIC OF NATION/"), number))
        .otherwise(F.concat(F.lit("Elsewhere "), number))
    )
    names = table(spark, sf, "customer").select("c_custkey", raw.alias("raw_name"))
    log = mapping_log(names, seeds, "c_custkey", min_hot_rows=50)
    return log.select("c_custkey", "canonical_name", "method")


def seed_spellings(spark: SparkSession, sf: str) -> DataFrame:
    return alias_dimension(part_seeds(spark, sf))


def fuzzy_best(spark: SparkSession, sf: str) -> DataFrame:
    names = misspelled_parts(spark, sf).select(F.col("raw_name").alias("norm")).distinct()
    return best_fuzzy(names, canonical_dimension(part_seeds(spark, sf)))


def resolve_counts(spark: SparkSession, sf: str) -> DataFrame:
    names = distinct_names(messy_names(spark, sf))
    return method_counts(resolve_distinct(names, part_seeds(spark, sf)))


def mappings(spark: SparkSession, sf: str) -> DataFrame:
    return mapping_log(messy_names(spark, sf), part_seeds(spark, sf), "id").select(
        "id", "raw_name", "canonical_name", "confidence"
    )


def mapping_rows(spark: SparkSession, sf: str) -> DataFrame:
    return mappings(spark, sf)


def mapping_changed(spark: SparkSession, sf: str) -> DataFrame:
    return changed_mappings(mappings(spark, sf)).select("id", "raw_name", "canonical_name")


def mapping_resolved(spark: SparkSession, sf: str) -> DataFrame:
    return by_confidence(resolved_mappings(mappings(spark, sf)), "id")


def mapping_review(spark: SparkSession, sf: str) -> DataFrame:
    return review_list(mappings(spark, sf).drop("id").distinct())


_SEEDS = "SELECT p_name AS canonical, min(p_partkey) AS seq FROM part GROUP BY p_name"
_TYPOS = """SELECT p_partkey AS id, left(p_name, p_partkey % length(p_name))
    || substr(p_name, p_partkey % length(p_name) + 2) AS raw_name FROM part"""
_NORM = r"""trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(raw_name),
    '\.(com|ai|io|dev|art|co)\b', '', 'g'),
    '\b(inc|incorporated|llc|ltd|limited|corp|corporation|co|company|pbc|plc)\b\.?', '', 'g'),
    '[.,\-_/&]', ' ', 'g'), '\s+', ' ', 'g'))"""
# Longest common subsequence, one table row per step: the list holds the last row of the usual grid.
_LCS = """list_extract(list_reduce(list_prepend(list_resize(CAST([] AS INTEGER[]), length(b) + 1, 0),
      list_transform(range(1, length(a) + 1), lambda i: [CAST(i AS INTEGER)])),
    lambda prev, i: list_reduce(list_prepend([0], list_transform(range(1, length(b) + 1), lambda j: [CAST(j AS INTEGER)])),
      lambda grid, j: list_append(grid, CASE WHEN substr(a, i[1], 1) = substr(b, j[1], 1) THEN prev[j[1]] + 1
        ELSE greatest(grid[j[1]], prev[j[1] + 1]) END))), -1)"""


def _sql_fuzzy(names: str) -> str:
    """Best canonical per distinct ``norm`` of ``names`` at 90 percent, every pair of similar length compared."""
    return f"""SELECT norm, arg_min(canonical, (-score, seq)) AS fuzzy_canonical, round_even(max(score), 3) AS fuzzy_confidence
      FROM (SELECT norm, canonical, seq, 2.0 * lcs / (length(a) + length(b)) AS score, lcs, length(a) + length(b) AS total
        FROM (SELECT *, {_LCS} AS lcs FROM (SELECT n.norm, n.norm AS a, s.canonical AS b, s.canonical, s.seq
          FROM (SELECT DISTINCT norm FROM ({names}) WHERE length(norm) >= 4) n JOIN ({_SEEDS}) s
            ON abs(length(n.norm) - length(s.canonical)) <= 3)))
      WHERE 20 * lcs >= 9 * total GROUP BY norm"""


_MESSY = f"""SELECT 'a' || p_partkey AS id, array_to_string(list_transform(string_split(p_name, ' '),
      lambda w: upper(left(w, 1)) || substr(w, 2)), ' ') || ', Inc.' AS raw_name FROM part
  UNION ALL SELECT 'b' || p_partkey, 'The ' || p_name FROM part
  UNION ALL SELECT 'c' || id, raw_name FROM ({_TYPOS})
  UNION ALL SELECT 'd' || s_suppkey, s_name FROM supplier"""
_RESOLVED = f"""WITH m AS (SELECT *, {_NORM} AS norm FROM ({_MESSY})),
    al AS (SELECT norm, arg_max(canonical, (seq, pos)) AS canonical, bool_or(pos = 0) AS is_canonical FROM (
      SELECT canonical, seq, 0 AS pos, canonical AS norm FROM ({_SEEDS})
      UNION ALL SELECT canonical, seq, 1, 'the ' || canonical FROM ({_SEEDS})
      UNION ALL SELECT canonical, seq, 2, replace(canonical, ' ', '') FROM ({_SEEDS})) GROUP BY norm),
    fz AS ({_sql_fuzzy('SELECT norm FROM m WHERE norm NOT IN (SELECT norm FROM al)')}),
    log AS (SELECT id, raw_name, coalesce(al.canonical, fuzzy_canonical, raw_name) AS canonical_name,
        CASE WHEN al.canonical IS NOT NULL THEN 1.0 ELSE coalesce(fuzzy_confidence, 0.0) END::DOUBLE AS confidence,
        CASE WHEN is_canonical THEN 'exact_canonical' WHEN al.canonical IS NOT NULL THEN 'exact_alias'
          WHEN fuzzy_canonical IS NOT NULL THEN 'fuzzy' ELSE 'no_match' END AS method
      FROM m LEFT JOIN al USING (norm) LEFT JOIN fz USING (norm))"""

QUERIES = {
    "seed_spellings": seed_spellings,
    "alias_exact": alias_exact,
    "fuzzy_best": fuzzy_best,
    "resolve_counts": resolve_counts,
    "mapping_rows": mapping_rows,
    "mapping_changed": mapping_changed,
    "mapping_resolved": mapping_resolved,
    "mapping_review": mapping_review,
}

ORACLE = {
    "seed_spellings": f"""SELECT norm, arg_max(canonical, (seq, pos)) AS canonical, bool_or(pos = 0) AS is_canonical FROM (
      SELECT canonical, seq, 0 AS pos, canonical AS norm FROM ({_SEEDS})
      UNION ALL SELECT canonical, seq, 1, 'the ' || canonical FROM ({_SEEDS})
      UNION ALL SELECT canonical, seq, 2, replace(canonical, ' ', '') FROM ({_SEEDS})) GROUP BY norm""",
    "alias_exact": """SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN n_name
          ELSE 'Elsewhere ' || c_nationkey END AS canonical_name,
        CASE c_mktsegment WHEN 'BUILDING' THEN 'exact_canonical' WHEN 'MACHINERY' THEN 'exact_alias' ELSE 'no_match' END AS method
      FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "fuzzy_best": _sql_fuzzy(f"SELECT raw_name AS norm FROM ({_TYPOS})").replace(" WHERE length(norm) >= 4", ""),
    "resolve_counts": f"""{_RESOLVED} SELECT k.method, count(id) AS records FROM (VALUES ('exact_alias'),
        ('exact_canonical'), ('fuzzy'), ('no_match')) k(method) LEFT JOIN log USING (method) GROUP BY k.method""",
    "mapping_rows": f"{_RESOLVED} SELECT id, raw_name, canonical_name, confidence FROM log",
    "mapping_changed": f"{_RESOLVED} SELECT id, raw_name, canonical_name FROM log WHERE canonical_name <> raw_name",
    "mapping_resolved": f"{_RESOLVED} SELECT id, raw_name, canonical_name, confidence FROM log WHERE confidence > 0",
    "mapping_review": f"""{_RESOLVED} SELECT DISTINCT raw_name, canonical_name, confidence FROM log
      WHERE canonical_name <> raw_name ORDER BY confidence, raw_name, canonical_name LIMIT 40""",
}
