from collections import Counter

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from partloom.errors import ConfigError
from partloom.sources.catalog import TableInfo, TableName, escape_value
from partloom.sources.formats import storage_for, storage_of

LAZY = "org.apache.hadoop.hive.serde2.lazy.LazySimpleSerDe"


def info(**facts):
    facts = {"kind": "EXTERNAL", "location": "file:/x/", "provider": "hive", "serde": None, **facts}
    return TableInfo(name=TableName("d", "t"), partition_columns=("k",), **facts)


@pytest.mark.parametrize(
    "serde, provider",
    [
        ("org.apache.hadoop.hive.ql.io.parquet.serde.ParquetHiveSerDe", "parquet"),
        ("org.apache.hadoop.hive.ql.io.orc.OrcSerde", "orc"),
        ("org.apache.hadoop.hive.serde2.avro.AvroSerDe", "avro"),
        (LAZY, "csv"),
        ("org.apache.hadoop.hive.serde2.OpenCSVSerde", "csv"),
        ("org.apache.hive.hcatalog.data.JsonSerDe", "json"),
        ("org.openx.data.jsonserde.JsonSerDe", "json"),
        ("com.amazon.emr.hive.serde.CloudTrailSerde", "json"),
        ("com.amazonaws.glue.serde.GrokSerDe", "csv"),
        ("org.apache.hadoop.hive.serde2.RegexSerDe", "csv"),
        ("some.other.SerDe", "csv"),
        (None, "csv"),
    ],
)
def test_format_of_a_serde(serde, provider):
    assert storage_of(info(serde=serde)).provider == provider


def test_delimiter_and_codec_of_a_table():
    assert storage_of(info(serde=LAZY)).options["sep"] == "\u0001"
    assert storage_of(info(serde=LAZY, storage_properties={"field.delim": "|"})).options["sep"] == "|"
    assert storage_of(info(provider="csv", storage_properties={"field.delim": "|"})).options["sep"] == "|"
    assert storage_of(info(provider="csv", storage_properties={"sep": ";"})).options["sep"] == ";"
    for properties in ({"parquet.compression": "gzip", "orc.compression": "zlib"}, {"parquet.compression": "gzip"}):
        made = storage_of(info(provider="parquet", table_properties=properties, storage_properties={"compression": "lz4"}))
        assert made.options["compression"] == "gzip"
    assert storage_of(info(provider="orc", table_properties={"orc.compression": "zlib"})).options["compression"] == "zlib"
    assert storage_of(info(provider="orc", storage_properties={"compression": "lz4"})).options["compression"] == "lz4"
    assert "compression" not in storage_of(info(provider="parquet")).options


def test_table_of_another_kind_is_refused():
    with pytest.raises(ConfigError, match="delta"):
        storage_of(info(provider="delta"))


def test_text_for_a_plain_serde(spark, folder):
    select = "select 1 as a, cast(null as string) as b, 'it said \"x\"' as c, timestamp_ntz '2020-01-01 00:00:00.5' as t, '' as e"
    storage = storage_of(info(serde=LAZY))
    spark.sql(select).write.format("csv").options(**storage.options).save(f"{folder}x")
    line = spark.read.text(f"{folder}x").first()[0]
    assert line.split("\u0001") == ["1", "\\N", 'it said "x"', "2020-01-01 00:00:00.500000", ""]


def test_numbers_alone_stay_splittable():
    number = StructType([StructField("a", IntegerType())])
    text = StructType([StructField("a", StringType())])
    assert "multiLine" not in storage_for("textfile", number).options
    assert storage_for("textfile", text).options["multiLine"] == "true"
    nested = StructType([StructField("s", text)])
    assert storage_for("textfile", nested).options["multiLine"] == "true"


# Everything but lone surrogates, which no encoding can hold, and the null marker itself.
words = st.text(st.characters(exclude_categories=["Cs"]), max_size=12).filter(lambda s: s != "\\N")
odd = st.text("\"'\\,\n\r\t|\u0001 #aN\u0000", max_size=8).filter(lambda s: s != "\\N")
texts = st.lists(st.one_of(words, odd, st.none()), min_size=1, max_size=60)


@pytest.mark.parametrize("format", ["textfile", "json"])
@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=texts)
def test_any_text_comes_back(spark, tmp_path_factory, format, values):
    schema = StructType([StructField("i", IntegerType()), StructField("s", StringType())])
    frame = spark.createDataFrame(list(enumerate(values)), schema)
    place = f"file:{tmp_path_factory.mktemp('text')}/x"
    storage = storage_for(format, schema)
    frame.write.format(storage.provider).options(**storage.options).save(place)
    back = spark.read.format(storage.provider).options(**storage.options).schema(schema).load(place)
    assert Counter(rows(back)) == Counter(list(enumerate(values)))


def test_directory_names_are_those_of_spark(spark, folder):
    values = [chr(c) for c in range(1, 127)] + ["ü", "☃", "a b", "..", "%41"]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, k string")
    frame.write.partitionBy("k").parquet(f"{folder}x")
    made = {path.split("/k=", 1)[1].split("/")[0] for path in spark.read.parquet(f"{folder}x").inputFiles()}
    from urllib.parse import unquote

    assert {unquote(name) for name in made} == {escape_value(v) for v in values}
