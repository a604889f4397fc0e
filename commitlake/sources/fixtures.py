"""Raw streams derived from the driver's tables (``events`` and ``part``).

The source project ships no data, so its four raw streams are produced as
pure functions of the test tables and landed through the real envelope
writer. Every record is a projection of one driver row (plus a second
version for every tenth key), so the streams grow linearly with the tables.

Fixed values: the derivation rules below are shared with the DuckDB oracle
(``oracle/``), which recomputes the typed columns straight from the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commitlake.session import configure
from commitlake.sources.envelope import land_envelope

AS_OF = "2024-02-01 00:00:00"           # fixed evaluation time of the fixture marts
EXTRACT_EPOCH = 1706745600              # 2024-02-01T00:00:00Z, first extraction batch
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
API = "https://api.github.com/repos/"
WEB = "https://github.com/"
AVATAR = "https://avatars.githubusercontent.com/u/"
WEB_FLOW_ID = 19864447

# Commit message templates by event_id % 13 ({e} = event_id, {p} = event_id % 50).
MESSAGES = [
    "feat(api): item #{e}",
    "feat:add {e}",
    "feat: spaced",
    "fix(core): bug (#{p})",
    "docs:readme",
    "refactor(db): x",
    "test:unit",
    "chore(deps): bump",
    "perf(io): fast",
    "style:fmt",
    "ci(gh): run",
    "[build] jar",
    None,
]


def as_of_lit() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def _s(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _versions(df: DataFrame, key: str, versions) -> DataFrame:
    """One row per (record, version): v0 for every key, v1 for every tenth key (single scan)."""
    k = F.col(key)
    v = F.explode(F.when(k % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    out = df.select("*", v.alias("v"))
    return out.where(F.col("v").isin(list(versions)))


def _extracted(k: Column, v: Column) -> Column:
    return F.timestamp_seconds(F.lit(EXTRACT_EPOCH) + (k % 5) * 3600 + v * 86400)


def _iso(ts_ntz: Column) -> Column:
    return F.date_format(ts_ntz, ISO_FORMAT)


def _message(e: Column, v: Column) -> Column:
    idx = e % len(MESSAGES)
    out = F.lit(None).cast("string")
    for i in reversed(range(len(MESSAGES))):
        tpl = MESSAGES[i]
        if tpl is None:
            continue
        head, _, tail = tpl.partition("{")
        if not _:
            body = F.lit(tpl)
        else:
            var, _, rest = tail.partition("}")
            body = _s(head, (e if var == "e" else e % 50).cast("string"), rest)
        out = F.when(idx == i, body).otherwise(out)
    return F.when(v == 1, F.concat(out, F.lit(" v1"))).otherwise(out)


def _spread(spark: SparkSession, df: DataFrame, key: str) -> DataFrame:
    """Hash-spread the (few, narrow) driver columns so payload building runs on every core.

    The driver files hold one row group each, which a scan cannot split.
    """
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, key)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id")
    return _spread(spark, ev, "event_id")


def _commit_like(ev: DataFrame, sha_prefix: str, with_pr: bool) -> DataFrame:
    """Commit payloads (GitHub API shape) for commits or pull-request commits."""
    e, u, v = F.col("event_id"), F.col("user_id"), F.col("v")
    ct = F.col("ts") - F.make_dt_interval((u * 37 % 500).cast("int"))   # timestamp_ntz wall clock
    org = _s("org", ((e - e % 6) / 6).cast("bigint") % 2)
    repo = _s("repo", e % 6)
    sha = F.md5(_s(sha_prefix, e))
    tree_sha = F.md5(_s("t", e))
    name = _s("user ", u, "-", e % 2)
    email = F.when(e % 19 != 0, _s("u", u, "_", e % 3, "@x.io"))
    web_flow = e % 4 == 0
    verified = F.when(e % 23 != 0, e % 3 == 0)
    author = F.when(e % 17 != 0, F.struct(
        u.alias("id"), _s("user", u).alias("login"), _s(AVATAR, u).alias("avatar_url"),
        _s(WEB, "user", u).alias("html_url"),
        F.when(u % 50 == 0, "Bot").otherwise("User").alias("type"),
        (u % 40 == 0).alias("site_admin")))
    bot = F.struct(F.lit(WEB_FLOW_ID).cast("bigint").alias("id"), F.lit("web-flow").alias("login"),
                   F.lit(f"{AVATAR}{WEB_FLOW_ID}").alias("avatar_url"), F.lit(f"{WEB}web-flow").alias("html_url"),
                   F.lit("User").alias("type"), F.lit(False).alias("site_admin"))
    commit = F.struct(
        _message(e, v).alias("message"),
        (e % 3).alias("comment_count"),
        F.struct(name.alias("name"), email.alias("email"), _iso(ct).alias("date")).alias("author"),
        F.struct(F.when(web_flow, "GitHub").otherwise(name).alias("name"),
                 F.when(web_flow, "noreply@host.io").otherwise(email).alias("email"),
                 _iso(ct + F.make_dt_interval(F.lit(0), F.lit(0), (e % 7).cast("int"))).alias("date")
                 ).alias("committer"),
        F.struct(tree_sha.alias("sha"), _s(API, org, "/", repo, "/git/trees/", tree_sha).alias("url")).alias("tree"),
        F.struct(verified.alias("verified"),
                 F.when(verified, "valid").when(~verified, "unsigned").alias("reason"),
                 F.when(verified, _iso(ct + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(2)))).alias("verified_at")
                 ).alias("verification"),
    )
    url = _s(API, org, "/", repo, "/commits/", sha)
    head = [sha.alias("sha")]
    if not with_pr:
        head.append(_iso(ct).alias("commit_timestamp"))
    head += [org.alias("org"), repo.alias("repo"), (F.lit(100) + e % 12).alias("repo_id")]
    if with_pr:
        head.append((e % 50).alias("pull_number"))
    head += [_s("C_" if not with_pr else "PRC_", e).alias("node_id"), url.alias("url"),
             _s(WEB, org, "/", repo, "/commit/", sha).alias("html_url")]
    if with_pr:
        head.append(_s(url, "/comments").alias("comments_url"))
    payload = F.struct(*head, commit.alias("commit"), author.alias("author"),
                       F.when(web_flow, bot).otherwise(author).alias("committer"))
    ext = _extracted(e, v)
    return land_envelope(ev, payload, ext, received_at=ext + F.expr("INTERVAL 1 MINUTE"),
                         batched_at=ext + F.expr("INTERVAL 2 MINUTES"),
                         sequence=e * 10 + v, table_version=F.lit(1))


def raw_commits(spark: SparkSession, sf_dir: str, versions=(0, 1)) -> DataFrame:
    """Raw ``commits`` stream: one record per event, a second version for event_id % 10 = 0."""
    configure(spark)
    return _commit_like(_versions(_events(spark, sf_dir), "event_id", versions), "c", with_pr=False)


def raw_pull_request_commits(spark: SparkSession, sf_dir: str, versions=(0, 1)) -> DataFrame:
    """Raw ``pull_request_commits`` stream (sha from 'p' || event_id, pull number event_id % 50)."""
    configure(spark)
    return _commit_like(_versions(_events(spark, sf_dir), "event_id", versions), "p", with_pr=True)


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_name", "p_brand", "p_size")
    return _spread(spark, part, "p_partkey")


def raw_branches(spark: SparkSession, sf_dir: str, versions=(0, 1)) -> DataFrame:
    """Raw ``branches`` stream from ``part``; version 1 flips protection and moves the head."""
    configure(spark)
    df = _versions(_parts(spark, sf_dir), "p_partkey", versions)
    p, v = F.col("p_partkey"), F.col("v")
    org, repo = _s("org", p % 2), _s("repo", p % 6)
    head = F.md5(F.when(v == 1, _s("c", p, "v1")).otherwise(_s("c", p)))
    protected = F.col("p_size") > 25
    payload = F.struct(
        org.alias("org"), repo.alias("repo"), (F.lit(100) + p % 12).alias("repo_id"),
        F.when(p < 12, "main").otherwise(_s("b", p)).alias("name"),
        F.when(v == 1, ~protected).otherwise(protected).alias("protected"),
        F.struct(head.alias("sha"), _s(API, org, "/", repo, "/commits/", head).alias("url")).alias("commit"),
    )
    ext = _extracted(p, v)
    return land_envelope(df, payload, ext, sequence=p * 10 + v, table_version=F.lit(1))


def raw_repositories(spark: SparkSession, sf_dir: str, versions=(0, 1)) -> DataFrame:
    """Raw ``repositories`` stream from ``part``.

    Version 1 (part key % 10 = 0) is updated one day later, with a new
    description and one more star; for key % 30 = 0 it also lacks ``org``,
    so that repository leaves the staging table (latest version wins first).
    """
    configure(spark)
    df = _versions(_parts(spark, sf_dir), "p_partkey", versions)
    p, v = F.col("p_partkey"), F.col("v")
    owner = _s("org", p % 2)
    slug = _s("repo", p)
    day = F.lit("2024-01-01").cast("date")
    updated = F.date_add(day, (p % 28 + v).cast("int")).cast("timestamp_ntz")
    stars = p % 100 + v
    payload = F.struct(
        p.alias("id"), _s("R_", p).alias("node_id"),
        F.when(p % 13 != 0, slug).alias("name"),
        F.when(p % 9 != 0, _s(owner, "/", slug)).alias("full_name"),
        F.when(~((v == 1) & (p % 30 == 0)), owner).alias("org"),
        slug.alias("repo"),
        _s(WEB, owner, "/", slug).alias("html_url"),
        _s("git://github.com/", owner, "/", slug, ".git").alias("git_url"),
        _s("git@github.com:", owner, "/", slug, ".git").alias("ssh_url"),
        _s(WEB, owner, "/", slug, ".git").alias("clone_url"),
        F.when(p % 3 != 0, _s("https://example.org/", p)).alias("homepage"),
        (p % 4 == 0).alias("private"), (p % 7 == 0).alias("fork"), (p % 11 == 0).alias("archived"),
        F.lit(False).alias("disabled"),
        F.when(v == 1, _s(F.col("p_name"), " (updated)")).otherwise(F.col("p_name")).alias("description"),
        F.when(p % 4 == 0, "private").otherwise("public").alias("visibility"),
        F.col("p_brand").alias("language"), F.lit("main").alias("default_branch"),
        F.col("p_size").alias("size"), stars.alias("stargazers_count"), stars.alias("watchers_count"),
        (p % 17).alias("forks_count"), (p % 5).alias("open_issues_count"),
        (p % 23).alias("subscribers_count"), (p % 17).alias("network_count"),
        _iso(F.date_add(F.lit("2023-01-01").cast("date"), (p % 365).cast("int")).cast("timestamp_ntz")).alias("created_at"),
        _iso(updated).alias("updated_at"),
        _iso(updated - F.make_dt_interval(F.lit(0), F.lit(1))).alias("pushed_at"),
        F.struct(owner.alias("login"), (F.lit(1000) + p % 2).alias("id"), F.lit("Organization").alias("type"),
                 _s(WEB, owner).alias("html_url"), _s(AVATAR, F.lit(1000) + p % 2).alias("avatar_url"),
                 F.lit(False).alias("site_admin")).alias("owner"),
    )
    ext = _extracted(p, v)
    return land_envelope(df, payload, ext, sequence=p * 10 + v, table_version=F.lit(1))


RAW_STREAMS = {
    "repositories": raw_repositories,
    "branches": raw_branches,
    "commits": raw_commits,
    "pull_request_commits": raw_pull_request_commits,
}
