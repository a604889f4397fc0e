"""VARIANT payloads: the rows of the JSON route, and scans that read the named fields only."""

import glob
import json
import uuid

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from commitlake.plans import stg_branches, stg_commits, stg_repositories
from commitlake.session import shared_dir
from commitlake.sources import fixtures as fx
from commitlake.sources.envelope import parse_payload, write_raw
from commitlake.sources.schemas import REPOSITORY_FIELDS, STREAM_FIELDS
from commitlake.sources.typed import TYPED, TypedLanding, flatten, is_typed, type_payload

SF = "/root/testdata/sf0.001"


def landed(spark, stream, raw):
    landing = TypedLanding(spark, shared_dir(spark, "tests", f"typed-{uuid.uuid4().hex}"), stream)
    landing.append(raw)
    return landing


def same(one, other):
    texts = [df.select([F.col(n).cast("string") if t == "timestamp" else F.col(n) for n, t in df.dtypes]).collect()
             for df in (one, other)]          # Python has no year 0
    return sorted(map(repr, texts[0])) == sorted(map(repr, texts[1]))


HOSTILE = [
    None, "", "{", "[]", "null", "{}", '{"sha": null}', '{"sha": 1.50, "repo_id": "12", "org": true}',
    '{"sha": {"a": 1}, "org": [1], "repo": "[Fix] x", "node_id": "{not json"}', '{"sha": "a", "sha": "b"}',
    '{"sha": "d", "repo_id": 1.0, "commit": {"comment_count": "x", "verification": {"verified": "TRUE"}}}',
    '{"repo_id": 9223372036854775807, "author": {"id": 9223372036854775808, "site_admin": 1}}',
    '{"commit_timestamp": "2024-02-30T00:00:00Z", "commit": {"author": {"date": "2024-01-01T02:00:00.123456+05:30"}}}',
    '{"commit": "text", "author": 3, "commit_timestamp": "0001-01-01T00:00:00Z", "html_url": "\\u00e9\\ud83d\\ude00 \\u0000"}',
    '{"unknown": {"deep": [1, 2]}, "sha": "", "org": "' + "x" * 50_000 + '"}',
]


def test_hostile_documents_read_as_from_json(spark, envelope):
    raw = envelope([(d, "2024-01-01T00:00:00Z") for d in HOSTILE])
    fields = STREAM_FIELDS["commits"]
    assert same(flatten(landed(spark, "commits", raw).read(), fields), parse_payload(raw, fields))


@pytest.mark.parametrize("stream,builder", [("commits", fx.raw_commits), ("branches", fx.raw_branches),
                                            ("pull_request_commits", fx.raw_pull_request_commits),
                                            ("repositories", fx.raw_repositories)])
def test_streams_read_as_from_json(spark, stream, builder):
    raw = builder(spark, SF)
    rows = landed(spark, stream, raw).read()
    assert is_typed(rows) and not is_typed(raw)
    assert same(flatten(rows, STREAM_FIELDS[stream]), parse_payload(raw, STREAM_FIELDS[stream]))


def test_a_field_that_starts_late_and_one_not_known_at_landing(spark, envelope):
    raw = envelope([({"id": i, "name": "late" if i >= 9_990 else None}, "2024-01-01T00:00:00Z") for i in range(10_000)])
    rows = landed(spark, "repositories", raw.coalesce(1)).read()
    got = flatten(rows, [("repo_id", "id", "i"), ("repo", "name", "s"), ("new", "owner.badge", "s")], [])
    assert got.where(F.col("repo") == "late").agg(F.min("repo_id"), F.count("*")).first()[:2] == (9_990, 10)
    assert got.where(F.col("new").isNotNull()).count() == 0


def test_five_fields_read_under_half_of_the_json_text(spark):
    raw = fx.raw_repositories(spark, SF)
    landing = landed(spark, "repositories", raw)
    text = shared_dir(spark, "tests", f"text-{uuid.uuid4().hex}")
    write_raw(raw.select("data"), text)
    wanted = {"repo_id": "id", "full_name": "full_name", "primary_language": "language",
              "stargazers_count": "stargazers_count", "pushed_at": "pushed_at"}
    read = flatten(landing.read(), [f for f in REPOSITORY_FIELDS if f[0] in wanted], [])
    plan = read._jdf.queryExecution().executedPlan().toString()
    schema = plan.split("ReadSchema: ")[1].splitlines()[0]
    assert schema.startswith("struct<payload:struct<0:bigint,1:string,2:string,3:bigint,4:timestamp>>")
    assert "from_json" not in plan
    # Parquet columns of the five fields, with the metadata and residuals that a shredded read also needs.
    asked = (["payload.metadata", "payload.value"]
             + [f"payload.typed_value.{p}.{part}" for p in wanted.values() for part in ("value", "typed_value")])

    def stored(folder, names=None):
        columns = [g.column(i) for f in glob.glob(folder.removeprefix("file:") + "/**/*.parquet", recursive=True)
                   for m in [pq.ParquetFile(f).metadata] for r in range(m.num_row_groups) for g in [m.row_group(r)]
                   for i in range(g.num_columns)]
        if names is not None:
            assert {x.path_in_schema for x in columns} >= {f"payload.typed_value.{p}.typed_value" for p in wanted.values()}
        return sum(x.total_compressed_size for x in columns if names is None or x.path_in_schema in names)

    assert 2 * stored(landing.path, asked) < stored(text)


def test_staging_and_an_empty_landing(spark, envelope):
    for stream, builder, model in (("commits", fx.raw_commits, stg_commits), ("branches", fx.raw_branches, stg_branches),
                                   ("repositories", fx.raw_repositories, stg_repositories)):
        raw = builder(spark, SF)
        rows = landed(spark, stream, raw).read()
        assert same(model(rows).drop("dbt_updated_at"), model(raw).drop("dbt_updated_at"))
    empty = TypedLanding(spark, shared_dir(spark, "tests", f"typed-{uuid.uuid4().hex}"), "branches")
    assert empty.read().schema.names == TYPED.names and stg_branches(empty.read()).count() == 0
    empty.append(envelope([({"name": "a"}, "2024-01-01T00:00:00Z")]).limit(0))
    assert empty.read().count() == 0


def test_typed_rows_and_more_columns_may_be_landed(spark, envelope):
    raw = envelope([({"id": 1, "name": "a"}, "2024-01-01T00:00:00Z")])
    landing = landed(spark, "repositories", raw.withColumn("payload", F.lit("clash")).withColumn("more", F.lit(1)))
    landing.append(type_payload(raw, "repositories").withColumn("more", F.lit(2)))
    assert landing.read().count() == 2 and landing.read().columns == TYPED.names
    assert json.loads(landing.read().select(F.to_json("payload")).first()[0])["name"] == "a"
