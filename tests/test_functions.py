import pytest
from pyspark.sql import functions as F

from keyedlog.functions.offsets import decode_offsets, encode_offsets, merge_offsets, offset_of
from keyedlog.functions.text import infer_json_schema, is_blank, is_not_blank, parse_json
from keyedlog.session import scale_conf
from keyedlog.sources.json_lines import json_records, json_strings, read_json_lines
from keyedlog.sources.paths import path_exists, scratch_path


def value(spark, column):
    return spark.range(1).select(column).first()[0]


def as_map(entries):
    if entries is None:
        return F.lit(None).cast("map<string,string>")
    return F.create_map(*[F.lit(x) for pair in entries.items() for x in pair]).cast("map<string,string>")


@pytest.mark.parametrize(
    "previous, submitted, text",
    [
        ({"a": "1", "b": "2"}, {"b": "3", "c": "4"}, "a+1,b+3,c+4"),
        ({}, {}, ""),
        (None, {"z": "9", "a": "1"}, "a+1,z+9"),
        ({"a": "1"}, None, "a+1"),
    ],
)
def test_offsets_merge_and_encode(spark, previous, submitted, text):
    merged = merge_offsets(as_map(previous), as_map(submitted))
    assert value(spark, encode_offsets(merged)) == text
    assert value(spark, decode_offsets(encode_offsets(merged))) == {**(previous or {}), **(submitted or {})}


@pytest.mark.parametrize("name", ["a,b", "a+b"])
def test_separators_in_names_are_refused(spark, name):
    with pytest.raises(Exception, match="separator in table name"):
        value(spark, encode_offsets(as_map({name: "1"})))


@pytest.mark.parametrize("text, entries", [(None, {}), ("", {}), ("a+1,b+2", {"a": "1", "b": "2"})])
def test_offsets_decode(spark, text, entries):
    assert value(spark, decode_offsets(F.lit(text).cast("string"))) == entries


def test_offset_of_an_unknown_source_is_the_beginning(spark):
    assert value(spark, offset_of(as_map({"a": "5"}), "a")) == "5"
    assert value(spark, offset_of(as_map({"a": "5"}), "b")) == "000"
    assert value(spark, offset_of(as_map(None), F.lit("b"))) == "000"


def test_blank_texts(spark):
    df = spark.createDataFrame([(None,), ("",), (" ",), ("x",)], "t string")
    found = df.select(is_blank(F.col("t")), is_not_blank(F.col("t"))).collect()
    assert [tuple(r) for r in found] == [(True, False), (True, False), (False, True), (False, True)]


def test_malformed_json_gives_nulls(spark):
    df = spark.createDataFrame([(1, '{"k": 5}'), (2, "{oops"), (3, None)], "i int, t string")
    assert [tuple(r) for r in parse_json(df, "t", "k bigint").orderBy("i").collect()] == [(1, 5), (2, None), (3, None)]


def test_json_schema_from_all_rows(spark):
    lines = ['{"a": 1, "b": {"c": 1.5}}', '{"a": 2, "d": ["x"]}', "not json"]
    df = spark.createDataFrame([(s,) for s in lines], "t string")
    assert infer_json_schema(df, "t").simpleString() == "struct<a:bigint,b:struct<c:double>,d:array<string>>"
    assert json_records(df, "t").where("a = 1").first()["b"]["c"] == 1.5
    assert json_strings(spark, lines[:2], "a int").agg(F.sum("a")).first()[0] == 3


def test_json_schema_of_odd_names_and_of_nothing(spark):
    df = spark.createDataFrame([('{"a b": 1, "c:d": "x", "g": null}',)], "t string")
    found = json_records(df, "t").first()
    assert (found["a b"], found["c:d"], found["g"]) == (1, "x", None)
    for text in ("nope", "3"):
        with pytest.raises(ValueError, match="no JSON objects"):
            infer_json_schema(spark.createDataFrame([(text,)], "t string"), "t")


def test_a_column_and_a_file_have_the_same_types(spark, tmp_path):
    lines = ['{"VOID": 1, "OBJECT<": "a", "DECIMAL(1,2)": 2, "n": 12345678901234567890, "m": 1}',
             '{"VOID": null, "m": "text", "z": null}', '{"m": {"x":1.5}, "DECIMAL(1,2)": 2.5}']
    (tmp_path / "x.json").write_text("\n".join(lines))
    df = spark.createDataFrame([(s.replace(", ", ",\n"),) for s in lines], "t string")
    file = read_json_lines(spark, str(tmp_path / "x.json"))
    column = json_records(df, "t")
    assert column.schema == file.schema
    assert sorted(map(repr, column.collect())) == sorted(map(repr, file.collect()))
    found = column.where("VOID = 1").first()
    assert (found["OBJECT<"], found["m"], str(found["n"])) == ("a", "1", "12345678901234567890")


def test_json_files(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"a": 1}\n{"a": 2, "b": "z"}\n')
    assert read_json_lines(spark, str(tmp_path)).columns == ["a", "b"]
    assert read_json_lines(spark, str(tmp_path), "b string").where("b is not null").count() == 1


def test_scratch_paths_lie_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(shared) and not path_exists(spark, a) and path_exists(spark, shared)


def test_settings_grow_with_the_data():
    assert scale_conf(10 << 40, 8000)["spark.sql.shuffle.partitions"] == "81920"
    assert scale_conf(1, 8)["spark.sql.shuffle.partitions"] == "16"
