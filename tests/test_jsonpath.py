import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartlake.functions import PathError, json_path, parse_variant, variant_path

# the reference's unit-test shapes; names and expected values as listed in
# FIXTURES.md section 1 (fixed values), the other fields are our own
DATA1 = {"person": [{"name": "homie", "address": "x street"}, {"name": "bro", "address": "y road"}]}
DATA2 = [{"object": "customer", "color": "red"}, {"object": "bat", "color": "black"}]
DATA3 = [[{"name": "a"}, {"name": "b"}], [{"name": "b"}, {"name": "a"}], [{"name": "c"}, {"name": "c"}]]
S1 = "struct<person:array<struct<name:string,address:string>>>"
S2 = "array<struct<object:string,color:string>>"
S3 = "array<array<struct<name:string>>>"


def _one(spark, data, schema, path):
    import json
    df = spark.createDataFrame([(json.dumps(data),)], "j string")
    return df.select(json_path("j", path, schema=schema).alias("v")).first().v


def _plain(v):
    if isinstance(v, list):
        return [_plain(x) for x in v]
    return v


def test_reference_cases(spark):
    assert _one(spark, DATA1, S1, "person.[0].name") == "homie"
    assert _one(spark, DATA1, S1, "person.[*].name") == ["homie", "bro"]
    assert _one(spark, DATA2, S2, "[*].object") == ["customer", "bat"]
    assert _plain(_one(spark, DATA3, S3, "[*].[*].name")) == [["a", "b"], ["b", "a"], ["c", "c"]]


def test_edges(spark):
    assert _one(spark, DATA1, S1, "missing.[0].name") is None
    assert _one(spark, DATA1, S1, "person.[5].name") is None
    assert _one(spark, {"person": [None, {"name": "z"}]}, S1, "person.[*].name") == [None, "z"]
    assert _one(spark, DATA3, S3, "[1:3].[0].name") == ["b", "c"]
    assert _one(spark, DATA3, S3, "[:1].[1].name") == ["b"]
    assert _one(spark, DATA3, S3, "[2:].[*].name") == [["c", "c"]]
    assert _one(spark, DATA1, S1, "[0]") is None  # bracket on an object: no such key
    with pytest.raises(PathError):
        _one(spark, DATA1, S1, "person.name")  # a list needs a bracket step
    with pytest.raises(PathError):
        _one(spark, DATA1, S1, "person.[x].name")


def test_map_column(spark):
    df = spark.createDataFrame([({"a": "1"},)], "m map<string,string>")
    dtype = df.schema["m"].dataType
    out = df.select(json_path("m", "a", dtype).alias("a"), json_path("m", "b", dtype).alias("b")).first()
    assert out.a == "1" and out.b is None


SCHEMA = T.StructType([T.StructField("xs", T.ArrayType(T.StructType([
    T.StructField("k", T.LongType()), T.StructField("ys", T.ArrayType(T.LongType()))])))])
item = st.one_of(st.none(), st.fixed_dictionaries(
    {"k": st.one_of(st.none(), st.integers(-5, 5)),
     "ys": st.one_of(st.none(), st.lists(st.integers(0, 9), max_size=4))}))
docs = st.fixed_dictionaries({"xs": st.one_of(st.none(), st.lists(item, max_size=5))})
def pick(values, lo, hi=None):
    return None if values is None else values[lo:hi]


# what each path means, written out
PATHS = {
    "xs.[0].k": lambda xs: (xs[0] or {}).get("k") if xs else None,
    "xs.[*].k": lambda xs: None if xs is None else [(x or {}).get("k") for x in xs],
    "xs.[1:3].k": lambda xs: None if xs is None else [(x or {}).get("k") for x in xs[1:3]],
    "xs.[:2].ys": lambda xs: None if xs is None else [(x or {}).get("ys") for x in xs[:2]],
    "xs.[*].ys.[0]": lambda xs: None if xs is None else [next(iter((x or {}).get("ys") or []), None) for x in xs],
    "xs.[*].ys.[*]": lambda xs: None if xs is None else [(x or {}).get("ys") for x in xs],
    "xs.[2:].ys.[1:]": lambda xs: None if xs is None else [pick((x or {}).get("ys"), 1) for x in xs[2:]],
    "nope": lambda xs: None,
    "xs.[3]": lambda xs: xs[3] if xs and len(xs) > 3 else None,
}


@settings(max_examples=25, deadline=None)
@given(doc=docs, path=st.sampled_from(sorted(PATHS)))
def test_property_against_literal_values(spark, doc, path):
    import json
    df = spark.createDataFrame([(json.dumps(doc),)], "j string")
    got = df.select(json_path("j", path, schema=SCHEMA).alias("v")).first().v
    want = PATHS[path](doc["xs"])
    if isinstance(want, dict):
        got = got.asDict(recursive=True) if got is not None else None
    assert _plain(got) == _plain(want)


# --- the same paths on Variant values: no schema is declared ---------------------------

def _variant(spark, data, path, kind="string"):
    import json
    df = spark.createDataFrame([(json.dumps(data),)], "j string")
    return df.select(variant_path(parse_variant("j"), path, kind).alias("v")).first().v


def test_reference_cases_on_variants(spark):
    assert _variant(spark, DATA1, "person.[0].name") == "homie"
    assert _variant(spark, DATA1, "person.[*].name") == ["homie", "bro"]
    assert _variant(spark, DATA2, "[*].object") == ["customer", "bat"]
    assert _plain(_variant(spark, DATA3, "[*].[*].name")) == [["a", "b"], ["b", "a"], ["c", "c"]]


def test_edges_on_variants(spark):
    assert _variant(spark, DATA1, "missing.[0].name") is None
    assert _variant(spark, DATA1, "person.[5].name") is None
    assert _variant(spark, {"person": [None, {"name": "z"}]}, "person.[*].name") == [None, "z"]
    assert _variant(spark, DATA3, "[1:3].[0].name") == ["b", "c"]
    assert _variant(spark, DATA3, "[2:].[*].name") == [["c", "c"]]
    assert _variant(spark, DATA3, "[3:2].[0].name") == []
    assert _variant(spark, DATA1, "[0]") is None
    assert _variant(spark, {"a": 1}, "a.b.c") is None and _variant(spark, {"a": "x"}, "a", "bigint") is None
    assert _variant(spark, {"a b": {"c.d": 3}}, "a b", "map<string,bigint>") == {"c.d": 3}
    assert _variant(spark, {"a": [1, "x", 2]}, "a.[*]", "bigint") == [1, None, 2]
    for wrong in ("person.[x].name", "it's"):
        with pytest.raises(PathError):
            variant_path("j", wrong)
    with pytest.raises(Exception, match="Not a valid path"):
        _variant(spark, DATA1, "person.name")
    torn = spark.createDataFrame([("{",), (None,), ("null",)], "j string")
    assert [r.v for r in torn.select(variant_path(parse_variant("j"), "a").alias("v")).collect()] == [None] * 3


def test_variants_differ_from_row_to_row(spark):
    df = spark.createDataFrame([('{"a": [{"b": 1}]}',), ('{"a": {"b": 2}}',), ('{"c": 3}',)], "j string")
    got = df.select(variant_path(parse_variant("j"), "a.[0].b", "bigint").alias("v")).collect()
    assert [r.v for r in got] == [1, None, None]
