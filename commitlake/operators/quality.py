"""Table-level data-quality assertions (unique, not_null, relationships) and a report.

Each check is a plain aggregate or anti join over the whole table; the
report stacks one row per check, so a full suite is a single Spark job.
NULLs can be counted while a table is written (``observe_nulls``), which
spares the report its pass for the not_null checks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

REPORT_COLUMNS = ["table_name", "check_name", "column_name", "severity", "failures"]


def unique(df: DataFrame, column: str) -> DataFrame:
    """Offending values: non-NULL ``column`` values occurring more than once, with their count."""
    return (df.where(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1))


def not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULL count per column, all columns in one pass: rows (column_name, failures)."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("bigint").alias("failures"))
                      for c in columns])
    return counts.select(F.inline(pairs))


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows whose non-NULL ``column`` has no ``field`` match in ``parent``.

    The distinct keys of both sides meet first, so a frequent key is one row there; the rows are then looked up among
    the orphaned keys only.
    """
    keys = parent.select(F.col(field).alias(column)).where(F.col(column).isNotNull()).distinct()
    referred = child.where(F.col(column).isNotNull())
    orphaned = referred.select(column).distinct().join(keys, column, "left_anti")
    return referred.join(orphaned, column, "left_semi")


@dataclass(frozen=True)
class Check:
    table: str
    kind: str            # unique | not_null | relationships
    column: str
    severity: str = "error"
    parent: str | None = None
    field: str | None = None


def _failures(tables: dict[str, DataFrame], check: Check) -> DataFrame:
    df = tables[check.table]
    if check.kind == "unique":
        bad = unique(df, check.column).agg(F.count(F.lit(1)).alias("failures"))
    elif check.kind == "not_null":
        bad = df.agg(F.count_if(F.col(check.column).isNull()).cast("bigint").alias("failures"))
    elif check.kind == "relationships":
        # Count per child key first (combines map-side, so a hot key is one row), then anti-join the keys.
        per_key = df.where(F.col(check.column).isNotNull()).groupBy(check.column).agg(
            F.count(F.lit(1)).alias("_n"))
        bad = relationships(per_key, check.column, tables[check.parent], check.field).agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("failures"))
    else:
        raise ValueError(f"unknown check {check.kind}")
    return bad.select(F.lit(check.table).alias("table_name"), F.lit(check.kind).alias("check_name"),
                      F.lit(check.column).alias("column_name"), F.lit(check.severity).alias("severity"),
                      F.col("failures").cast("bigint").alias("failures"))


def observe_nulls(df: DataFrame, table: str, checks: list[Check]) -> tuple[DataFrame, Observation | None]:
    """``df`` that counts the NULLs of the columns ``checks`` name for ``table`` while it is written, and the Observation
    that has the counts afterwards (None without such checks).

    Write the result itself: metrics are exact in the stage that writes, whose tasks count once however often they are
    tried. Below an exchange a lost executor, or the sampling of a range sort, would count rows twice. A merge writes a
    part of its table only; for both cases leave the table to the report's own pass.
    """
    columns = dict.fromkeys(c.column for c in checks if c.kind == "not_null" and c.table == table)
    if not columns:
        return df, None
    seen = Observation()
    return df.observe(seen, *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]), seen


def quality_report(tables: dict[str, DataFrame], checks: list[Check],
                   observed: dict[str, Observation | None] | None = None) -> DataFrame:
    """One row per check: (table_name, check_name, column_name, severity, failures).

    not_null checks of one table are folded into a single aggregate pass; those of a table in ``observed`` (what
    ``observe_nulls`` gave for it, once written) need none.
    """
    counted = {table: dict(seen.get) for table, seen in (observed or {}).items() if seen is not None}
    known = [(c.table, c.kind, c.column, c.severity, counted[c.table][c.column]) for c in checks
             if c.kind == "not_null" and c.column in counted.get(c.table, {})]
    checks = [c for c in checks if c.kind != "not_null" or c.column not in counted.get(c.table, {})]
    parts = []
    by_table: dict[str, list[Check]] = {}
    for c in checks:
        if c.kind == "not_null":
            by_table.setdefault(c.table, []).append(c)
        else:
            parts.append(_failures(tables, c))
    for table, group in by_table.items():
        sev = {c.column: c.severity for c in group}
        nn = not_null(tables[table], [c.column for c in group])
        sev_map = F.create_map(*[F.lit(x) for kv in sev.items() for x in kv])
        parts.append(nn.select(F.lit(table).alias("table_name"), F.lit("not_null").alias("check_name"),
                               "column_name", sev_map[F.col("column_name")].alias("severity"), "failures"))
    if known:
        spark = next(iter(tables.values())).sparkSession
        parts.append(spark.createDataFrame(known, "table_name string, check_name string, column_name string, "
                                                  "severity string, failures bigint"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*REPORT_COLUMNS)


def assert_passes(report: DataFrame) -> list:
    """Raise when an error-severity check failed; return the failing warn rows."""
    rows = report.where(F.col("failures") > 0).collect()  # one row per check: bounded by the suite size
    errors = [r for r in rows if r["severity"] == "error"]
    if errors:
        raise AssertionError("data-quality errors: " + ", ".join(
            f"{r['table_name']}.{r['column_name']} {r['check_name']} ({r['failures']})" for r in errors))
    return rows


# The assertion suite declared on the marts.
MART_CHECKS = [
    Check("branches", "unique", "branch_sk"),
    *[Check("branches", "not_null", c) for c in
      ["branch_sk", "org", "repo", "repo_id", "branch_name", "commit_sha"]],
    Check("commits", "unique", "sha"),
    *[Check("commits", "not_null", c) for c in ["sha", "commit_timestamp", "git_author_email"]],
    Check("commits", "relationships", "github_author_id", severity="warn", parent="committers",
          field="committer_id"),
    Check("committers", "unique", "committer_id"),
    *[Check("committers", "not_null", c) for c in
      ["committer_id", "total_commits", "first_commit_at", "last_commit_at"]],
    Check("pull_request_commits", "unique", "pull_request_commit_sk"),
    *[Check("pull_request_commits", "not_null", c) for c in
      ["pull_request_commit_sk", "org", "repo", "repo_id", "pull_request_number", "sha"]],
    Check("repositories", "unique", "repo_sk"),
    Check("repositories", "unique", "repo_id"),
    *[Check("repositories", "not_null", c) for c in ["repo_sk", "repo_id", "org", "repo"]],
]
