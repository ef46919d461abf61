"""Rights as rows: who sees which rows and columns is read from tables when a view is read.

A policy row is (role, column, rule, value).  The rule ``rows`` lets a role see rows whose column
has the value (``*``: any).  ``show``, ``hash`` and ``hide`` say how a role sees a column.  A member row is
(user, role).  Both tables enter the view's plan as one aggregated row, so a change of either shows
in the next read, and the guarded table is scanned once, without a join or a shuffle of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType

# Ways to see a column, the strongest first.
SHOW, HASH, HIDE = "show", "hash", "hide"
ROWS = "rows"
RULES = (ROWS, SHOW, HASH, HIDE)


def check_policies(policies: DataFrame) -> None:
    """Refuse unknown rules, and rows without a role or column: they would protect nothing."""
    bad = policies.where(f"rule IS NULL OR rule NOT IN {RULES} OR role IS NULL OR `column` IS NULL").limit(5).collect()
    if bad:
        raise ValueError(f"not policies: {bad}; known rules: {', '.join(RULES)}")


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def policy_sql(spark: SparkSession, source: str, policies: str, members: str, user: str | None = None, roles_column: str | None = None) -> str:
    """The query that shows a user's view of a table; the reader's own name if no user is given.

    A column that some policy of ``rows`` names filters the rows: those are seen whose value a role of
    the user is given, or all with ``*``.  A column that some policy of another rule names is shown as
    the best rule of the user's roles says, and is null if none does; ``hash`` gives the SHA-256 of a
    text and null for other types.  With ``roles_column``, rows must also allow one of the user's
    roles there (joined by commas).  Columns without policies are not restricted.
    """
    who = _text(user) if user is not None else "current_user()"
    held = f"SELECT DISTINCT role FROM {members} WHERE user = {who}"
    has = "m.role IS NOT NULL"
    # One row: columns under a rule, what the user's roles are given, and those roles.
    granted = f"""(
        SELECT named_struct(
            'filters', collect_set(p.column) FILTER (WHERE p.rule = '{ROWS}'),
            'values', collect_set(named_struct('c', p.column, 'v', p.value)) FILTER (WHERE p.rule = '{ROWS}' AND {has}),
            'masked', collect_set(p.column) FILTER (WHERE p.rule <> '{ROWS}'),
            'rules', collect_set(named_struct('c', p.column, 'r', p.rule)) FILTER (WHERE p.rule <> '{ROWS}' AND {has}))
        FROM {policies} AS p LEFT JOIN ({held}) AS m ON p.role = m.role)"""
    shown, conditions = [], []
    for field in spark.table(source).schema.fields:
        name, label = f"s.`{field.name}`", _text(field.name)

        def has_rule(rule: str) -> str:
            return f"array_contains({granted}.rules, named_struct('c', {label}, 'r', '{rule}'))"

        digest = f" WHEN {has_rule(HASH)} THEN sha2({name}, 256)" if isinstance(field.dataType, StringType) else ""
        shown.append(f"CASE WHEN NOT array_contains({granted}.masked, {label}) OR {has_rule(SHOW)} THEN {name}{digest} END AS `{field.name}`")

        def allows(value: str) -> str:
            return f"array_contains({granted}.values, named_struct('c', {label}, 'v', {value}))"

        conditions.append(f"(NOT array_contains({granted}.filters, {label}) OR {allows(_text('*'))} OR {allows(f'CAST({name} AS STRING)')})")
    if roles_column is not None:
        conditions.append(f"arrays_overlap(split(s.`{roles_column}`, ','), (SELECT collect_list(role) FROM ({held})))")
    return f"SELECT {', '.join(shown)} FROM {source} AS s WHERE {' AND '.join(conditions)}"


def create_policy_view(spark: SparkSession, name: str, source: str, policies: str, members: str, user: str | None = None, roles_column: str | None = None, temporary: bool = False) -> None:
    """Register the view; read it in place of the table, which its users have no right to."""
    check_policies(spark.table(policies))
    query = policy_sql(spark, source, policies, members, user, roles_column)
    spark.sql(f"CREATE OR REPLACE {'TEMPORARY ' if temporary else ''}VIEW {name} AS {query}")
