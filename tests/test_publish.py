import pytest
from pyspark.sql import functions as F

from segloom.operators.publish import (
    base_table_name,
    load_template,
    publish_plan,
    render_payload,
    require_publishable,
    table_type,
    upload_mode,
)

CONTEXT = (7340, 918272, "voyages", "voyages_OFFLINE_spring_3", 611, 77016)
COLUMNS = "input_record_count long, input_byte_size long, table_name string, segment_name string, record_count long, byte_size long"
TEMPLATE = (
    '{"part": "${segmentName}", "of": "${tableName}", "rows": [${outputRecordCount}, ${inputRecordCount}], '
    '"bytes": [${outputRecordSize}, ${inputRecordSize}]}'
)


@pytest.mark.parametrize("template", [None, "", "   "])
def test_no_template(spark, template):
    assert spark.createDataFrame([CONTEXT], COLUMNS).select(render_payload(template)).first()[0] == "{}"


def test_all_fields(spark):
    text = spark.createDataFrame([CONTEXT], COLUMNS).select(render_payload(TEMPLATE)).first()[0]
    assert text == (
        '{"part": "voyages_OFFLINE_spring_3", "of": "voyages", "rows": [611, 7340], "bytes": [77016, 918272]}'
    )


def test_unknown_field_fails():
    with pytest.raises(ValueError, match="nope"):
        render_payload("${nope}")


def test_template_file(spark, tmp_path):
    file = tmp_path / "payload.ftl"
    file.write_text(TEMPLATE + "\n")
    assert load_template(spark, str(file)) == TEMPLATE + "\n"
    assert load_template(spark, None) is load_template(spark, " ") is None
    with pytest.raises(Exception):
        load_template(spark, str(tmp_path / "none.ftl"))


@pytest.mark.parametrize(
    "base, wanted, mode",
    [
        (None, "URI", "FILE"),
        (" ", None, "FILE"),
        ("/data", "URI", "FILE"),
        ("file:///data", "METADATA", "FILE"),
        ("s3a://b/d", None, "METADATA"),
        ("s3a://b/d", "uri", "URI"),
        ("s3a://b/d", "other", "METADATA"),
    ],
)
def test_upload_mode(base, wanted, mode):
    assert upload_mode(base, wanted) == mode


@pytest.mark.parametrize(
    "name, kind, base",
    [("t_OFFLINE", "OFFLINE", "t"), ("t_REALTIME", "REALTIME", "t"), ("plain", "OFFLINE", "plain"), ("t_OFFLINE_x", "OFFLINE", "t_OFFLINE_x")],
)
def test_table_names(spark, name, kind, base):
    row = spark.createDataFrame([(name,)], "n string").select(table_type(F.col("n")), base_table_name(F.col("n"))).first()
    assert tuple(row) == (kind, base)


def manifest(spark, uri="s3a://b/seg_"):
    return spark.createDataFrame(
        [(i, f"seg_{i}", None if uri is None else f"{uri}{i}", 10 * (i + 1), 1024 * (i + 1), "t_OFFLINE", "{}") for i in range(3)],
        "segment_id int, segment_name string, segment_uri string, record_count long, byte_size long, table_name string, payload string",
    )


@pytest.mark.parametrize("mode, payload", [("URI", "{}"), ("METADATA", "{}"), ("FILE", None)])
def test_plan(spark, mode, payload):
    plan = publish_plan(manifest(spark), mode, 1).orderBy("push_order").collect()
    assert [(r.push_order, r.segment_name, r.push_offset_seconds, r.payload) for r in plan] == [
        (1, "seg_0", 0, payload),
        (2, "seg_1", 1, payload),
        (3, "seg_2", 2, payload),
    ]


def test_negative_delay_counts_as_none(spark):
    assert {r.push_offset_seconds for r in publish_plan(manifest(spark), "URI", -3).collect()} == {0}


def test_unknown_mode(spark):
    with pytest.raises(ValueError, match="upload mode"):
        publish_plan(manifest(spark), "FTP")


@pytest.mark.parametrize("mode, uri, message", [("URI", None, "no remote location"), ("METADATA", None, "no remote location"), ("FILE", None, "no local path"), ("URI", "/local/", "not remote")])
def test_bad_plans(spark, mode, uri, message):
    with pytest.raises(ValueError, match=message):
        require_publishable(publish_plan(manifest(spark, uri), mode))


@pytest.mark.parametrize("mode, uri", [("URI", "s3a://b/s"), ("METADATA", "s3a://b/s"), ("FILE", "/local/s")])
def test_good_plans(spark, mode, uri):
    assert require_publishable(publish_plan(manifest(spark, uri), mode)).count() == 3
