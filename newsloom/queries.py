"""Registered queries of the core library."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newsloom.catalog import QUERIES, SQL, Query, build, evidence, labelling, more, query, read, relations, retrieval, scans, store  # noqa: F401
from newsloom.operators.packed import LOCATIONS, ORGANIZATIONS, PERSONS, THEMES, explode_values


ENTRIES = r"""regexp_extract_all(coalesce({f}, ''), '\s*"(?:[^"]|"")*"[^;|\n\t]*|[^;|\n\t]+')"""
BARE = r"""trim(regexp_replace(trim({x}, e' \t\r\n'), ',\s*[0-9]+\s*$', ''), e' \t\r\n')"""
UNQUOTED = """CASE WHEN regexp_full_match({b}, '"(?:[^"]|"")*"') THEN trim(replace({b}[2:-2], '""', '"')) ELSE {b} END"""


def values_sql(field: str) -> str:
    """SQL list of the values of one packed field; every comma inside a name belongs to it."""
    entries = ENTRIES.format(f=field)
    if field == "v2_themes":
        parts = rf"""flatten(list_transform({entries}, lambda e : regexp_extract_all(e, '"(?:[^"]|"")*"|[^,]+')))"""
        bare = r"trim(x, e' \t\r\n')"
        return f"""list_filter(list_transform(list_filter({parts}, lambda x : NOT regexp_full_match(x, '\\s*[0-9]+\\s*')), lambda x : {UNQUOTED.format(b=bare)}), lambda v : v <> '')"""
    value = UNQUOTED.format(b=BARE.format(x="x"))
    if field == "v2_locations":
        bare = r"trim(x, e' \t\r\n')"
        inner = f"""CASE WHEN {bare}[1] = '"' THEN replace(regexp_extract({bare}, '^"((?:[^"]|"")*)"', 1), '""', '"') ELSE {bare} END"""
        value = f"trim(CASE WHEN contains({inner}, '#') THEN string_split({inner}, '#')[2] ELSE {inner} END)"
    return f"list_filter(list_transform({entries}, lambda x : {value}), lambda v : v <> '')"


P4_SQL = " UNION ALL ".join(
    f"SELECT doc_id, '{f}' AS field, CAST(generate_subscripts(v, 1) AS INTEGER) AS pos, unnest(v) AS value FROM (SELECT doc_id, {values_sql(f)} AS v FROM (SELECT DISTINCT doc_id, {f} FROM bronze_candidates))"
    for f in ("v2_themes", "v2_locations", "v2_persons", "v2_organizations")
)


@query("p4_found", P4_SQL)
def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Every packed value of the candidates in its place."""
    return explode_values(read(spark, d, "bronze_candidates"), [THEMES, LOCATIONS, PERSONS, ORGANIZATIONS])


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
