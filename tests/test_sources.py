import uuid

from pyspark.sql import functions as F

from commitlake.session import shared_dir
from commitlake.sources.envelope import land_envelope, parse_payload, read_jsonl, select_streams, write_jsonl
from commitlake.sources.schemas import ENVELOPE


def test_select_streams_patterns(spark):
    df = spark.createDataFrame([('{"sha":"x","org":"y","commit":{"message":"m"}}', 1, "x", "y")], "data string, _sdc_sequence long, sha string, org string")
    catalog = {"commits": df, "branches": df, "releases": df}
    out = select_streams(catalog, ["commits.sha", "branch*.*"])
    assert set(out) == {"commits", "branches"}
    assert out["commits"].columns == ["data", "_sdc_sequence", "sha"]
    assert out["commits"].first()["data"] == '{"sha":"x"}'
    assert out["branches"].columns == df.columns and out["branches"].first()["data"] == df.first()["data"]


def test_land_and_jsonl_roundtrip(spark):
    records = spark.createDataFrame([(1, "a", None), (2, None, True)], "id long, name string, flag boolean")
    raw = land_envelope(records, [F.col("id"), F.col("name"), F.col("flag")],
                        F.lit("2024-02-01 00:00:00").cast("timestamp"), sequence=F.col("id"))
    assert [f.name for f in raw.schema.fields] == [f.name for f in ENVELOPE.fields]
    path = shared_dir(spark, "tests", f"jsonl-{uuid.uuid4().hex}")
    write_jsonl(raw, path)
    back = parse_payload(read_jsonl(spark, path), [("id", "id", "i"), ("name", "name", "s"), ("flag", "flag", "b")],
                         keep=["_sdc_sequence"])
    assert sorted(tuple(r) for r in back.collect()) == [(1, 1, "a", None), (2, 2, None, True)]
