"""Guarded ad-hoc SQL: one read-only statement over named views and listed functions, with a row limit."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession

READ_ONLY = ("Project", "Filter", "Aggregate", "Join", "Sort", "Union", "UnresolvedWith", "WithCTE", "Distinct", "GlobalLimit", "LocalLimit", "SubqueryAlias", "UnresolvedRelation", "OneRowRelation", "Window", "WithWindowDefinition", "UnresolvedHaving", "Except", "Intersect", "UnresolvedSubqueryColumnAliases", "Pivot", "Unpivot", "LateralJoin", "Offset", "UnresolvedInlineTable")
#: Functions a statement may call: they compute a value from their arguments and do nothing else.
FUNCTIONS = frozenset(
    """abs approx_count_distinct array_contains array_distinct array_size avg bround cardinality ceil ceiling char_length coalesce collect_list collect_set concat concat_ws contains corr
    count count_if cume_dist current_date date date_add date_diff date_format date_sub date_trunc datediff day dayofmonth dayofweek dense_rank element_at endswith exp extract first first_value floor format_number greatest
    hour if ifnull initcap isnotnull isnull lag last last_value lead least left length like ln locate log log10 log1p lower lpad ltrim max max_by mean median min min_by minute month nanvl now nth_value ntile
    nullif nvl nvl2 percent_rank percentile percentile_approx pi position pow power quarter rank regexp_count regexp_extract regexp_like regexp_replace replace reverse right rlike round row_number rpad rtrim second sha2 sign size
    split split_part sqrt startswith std stddev stddev_pop stddev_samp string substr substring sum to_date to_timestamp trim trunc try_cast try_divide typeof unix_timestamp upper var_pop var_samp variance weekofyear when year""".split()
)


def _all(seq) -> list:  # noqa: ANN001
    return [seq.apply(k) for k in range(seq.size())]


def _expressions(e) -> Iterator:  # noqa: ANN001
    yield e
    for c in _all(e.children()):
        yield from _expressions(c)


def guarded(spark: SparkSession, sql: str, limit: int = 200, views: Sequence[str] | None = None) -> DataFrame:
    """Run one SELECT. The parsed plan is checked node by node before it is analysed: what is not a query, a view or a listed function is refused.

    views: names that may be read, by default the session's temporary views; a table by path or in another catalog never may.
    Raises ValueError for commands, several statements, table functions, other functions and other tables; ``limit``
    bounds the rows returned (a feature of the tool, not of the query engine).
    """
    text = sql.strip().rstrip(";")
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    except Exception as e:  # noqa: BLE001
        raise ValueError("one SELECT statement is allowed") from e
    known = {v.lower() for v in views} if views is not None else {t.name.lower() for t in spark.catalog.listTables() if t.isTemporary}
    own: set[str] = set()
    todo, read = [plan], set()
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name not in READ_ONLY:
            raise ValueError(f"{name} is not allowed")
        if name == "UnresolvedRelation":
            read.add(".".join(_all(node.multipartIdentifier())).lower())
        if name == "UnresolvedWith":
            for pair in _all(node.cteRelations()):
                own.add(pair._1().lower())
                todo.append(pair._2())
        for top in _all(node.expressions()):
            for e in _expressions(top):
                if e.nodeName() == "UnresolvedFunction":
                    called = ".".join(_all(e.nameParts())).lower()
                    if called not in FUNCTIONS:
                        raise ValueError(f"function {called} is not allowed")
                if hasattr(e, "plan") and e.getClass().getName().endswith(("ScalarSubquery", "Exists", "ListQuery", "LateralSubquery")):
                    todo.append(e.plan())
        todo += _all(node.children())
    if read - known - own:
        raise ValueError(f"not among the views: {', '.join(sorted(read - known - own))}")
    return spark.sql(text).limit(limit)
