import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType, StructField, StructType

from core_helpers import rows
from custodia.functions.names import normalize_columns, normalize_map, normalize_schema, slug, snake, snake_name

PIECES = list("aZ09_-.#()'\"éÉßüñÇœΣİıﬁ½²Ⅷ①中文한글日本語") + [
    " ",
    "  ",
    "\t",
    "\n",
    "\x1c",
    "\x85",
    " ",
    " ",
    "　",
    "--",
    "é",
    "​",
    "‿",
    "😀",
    "٣",
]


def random_texts(n=400):
    rnd = random.Random(7)
    return ["".join(rnd.choices(PIECES, k=rnd.randint(0, 12))) for _ in range(n)]


def slug_by_definition(text, allow_unicode):
    if allow_unicode:
        text = unicodedata.normalize("NFKC", text)
    else:
        text = "".join(c for c in unicodedata.normalize("NFKD", text) if ord(c) < 128)
    kept = [c for c in text.lower() if c.isalnum() or c.isspace() or c in "_-"]
    dashed = "".join("-" if c.isspace() else c for c in kept)
    while "--" in dashed:
        dashed = dashed.replace("--", "-")
    return dashed.strip("-_")


def test_snake_examples(spark):
    examples = {
        "End-of-support date": "end_of_support_date",
        "a - b": "a___b",
        "displayName": "displayname",
        "a-b-c": "a_b_c",
        "x y": "x_y",
        "": "",
    }
    df = spark.createDataFrame(list(examples.items()), "name string, expected string")
    assert df.filter(~snake("name").eqNullSafe(F.col("expected"))).collect() == []
    assert {name: snake_name(name) for name in examples} == examples


def test_snake_matches_definition_on_random_texts(spark):
    texts = random_texts()
    expected = ["".join("_" if c == "-" or c.isspace() else c for c in text).lower() for text in texts]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", snake("t").alias("s")).collect()
    assert [row.s for row in got] == expected
    assert [snake_name(t) for t in texts] == expected


@pytest.mark.parametrize("allow_unicode", [False, True])
def test_slug_matches_definition_on_random_texts(spark, allow_unicode):
    texts = random_texts()
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [row.s for row in df.select(slug("t", allow_unicode).alias("s")).collect()]
    assert got == [slug_by_definition(t, allow_unicode) for t in texts]


def test_slug_examples(spark):
    examples = {"7_A B": "7_a-b", "a-b": "a-b", "Zoë  Müller!": "zoe-muller", "--_x_--": "x", "中文": "", None: None}
    df = spark.createDataFrame(list(examples.items()), "t string, expected string")
    assert df.filter(~slug("t").eqNullSafe(F.col("expected"))).collect() == []


def test_normalize_map_keeps_last_of_colliding_keys(spark):
    # Parsed from JSON, which keeps the order of the keys.
    df = spark.createDataFrame(
        [
            (1, '{"Owner": "first", "Cost-Center": "9", "owner": "last"}'),
            (2, "{}"),
            (3, None),
            (4, '{"OWNER": null}'),
            (5, '{"owner": "x", "Owner": null}'),
            (6, '{"owner": "x", "a b": "1", "OWNER": "y", "Owner": "z", "a-b": "2"}'),
        ],
        "id int, text string",
    ).withColumn("m", F.from_json("text", "map<string,string>"))
    got = {row.id: row.m for row in df.select("id", normalize_map("m").alias("m")).collect()}
    assert got == {
        1: {"owner": "last", "cost_center": "9"},
        2: {},
        3: None,
        4: {"owner": None},
        5: {"owner": None},
        6: {"owner": "z", "a_b": "2"},
    }


def test_normalize_schema_reaches_nested_names_and_map_keys(spark):
    df = spark.createDataFrame(
        [(("G", {"A-b": "1"}), [("w", [{"Key": "K"}])], {"X": (1,)}), (None, None, None)],
        "`display Name` struct<givenName: string, `my-Tags`: map<string,string>>, "
        "list array<struct<Type: string, Pairs: array<map<string,string>>>>, byKey map<string, struct<Val: int>>",
    )
    normal = normalize_schema(df)
    assert normal.schema.simpleString() == (
        "struct<display_name:struct<givenname:string,my_tags:map<string,string>>,"
        "list:array<struct<type:string,pairs:array<map<string,string>>>>,"
        "bykey:map<string,struct<val:int>>>"
    )
    first, second = normal.collect()
    assert first.display_name.my_tags == {"a_b": "1"}
    assert first.list[0].pairs == [{"key": "K"}]
    assert first.bykey["x"].val == 1
    assert tuple(second) == (None, None, None)


def test_normalize_columns(spark):
    df = spark.createDataFrame([(1, 2)], "`Release date` int, `End-of-support date` int")
    assert normalize_columns(df).columns == ["release_date", "end_of_support_date"]


def test_names_without_dashes_stay(spark):
    schema = StructType([StructField("m", MapType(StringType(), StringType()))])
    df = spark.createDataFrame([({"a": "1"},)], schema)
    assert rows(normalize_schema(df)) == [({"a": "1"},)]
    assert re.fullmatch(r"[a-z]+", snake_name("ABC"))


def test_unicode_slugs_replace_compatibility_forms(spark):
    df = spark.createDataFrame([("ﬁle ①",)], "t string")
    assert rows(df.select(slug("t", True), slug("t"))) == [("file-1", "file-1")]


@pytest.mark.parametrize("allow_unicode", [False, True])
def test_slugs_pass_texts_to_python_in_small_batches_and_only_those_that_need_it(spark, allow_unicode):
    df = spark.createDataFrame([("plain Text",), ("Ünï ﬁ",), ("",), (None,)], "t string")
    slugged = df.select(slug("t", allow_unicode).alias("s"))
    plan = slugged._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan and "octet_length" in plan
    assert [r.s for r in slugged.collect()] == ["plain-text", "ünï-fi" if allow_unicode else "uni-fi", "", None]
