"""Field selector, fan-out, JSON values, output shape and routing."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

import postsift as ps
from fixtures import zone_frame


def rows(done):
    return [r["validation"] for r in done.collect()]


def test_field_by_name_expression_and_address(spark):
    people = spark.createDataFrame([(1, "Ana@Gmail.com", "x@soloa.com")], "id int, correo string, otro string")
    for email, want in (("correo", "ana@gmail.com"), (F.col("otro"), "x@soloa.com"), ("Luz@Gmail.com", "luz@gmail.com")):
        done = ps.validate(people, email, dns=zone_frame(spark))
        assert [r["email"] for r in done.collect()] == [want]
        assert done.columns == ["id", "correo", "otro", "email", "validation"]


def test_missing_field_is_named(spark):
    people = spark.createDataFrame([(1, None), (2, "a@gmail.com")], "id int, email string")
    (v, _) = rows(ps.validate(people, "correo"))
    assert (v["sub_status"], v["field_searched"], v["email"]) == ("field_not_found", "correo", "")
    by_id = {r["id"]: r["validation"]["field_searched"] for r in ps.validate(people).collect()}
    assert by_id == {1: "email", 2: None}


def test_original_fields_can_be_left_out(spark):
    people = spark.createDataFrame([(1, "A@Gmail.com")], "id int, email string")
    assert ps.validate(people, keep_fields=False).columns == ["email", "validation"]
    done = ps.validate(people)
    assert done.columns == ["id", "email", "validation"]
    assert done.first()["email"] == "a@gmail.com"
    assert done.first()["validation"]["email"] == "A@Gmail.com"


def test_odd_column_names(spark):
    people = spark.createDataFrame([(1, "a@gmail.com")], ["the id", "e.mail`s"])
    assert ps.validate(people, "e.mail`s").columns == ["the id", "e.mail`s", "email", "validation"]
    with pytest.raises(ValueError, match="ps_"):
        ps.validate(people.withColumnRenamed("the id", "ps_id"))


def test_arrays_fan_out(spark):
    people = spark.createDataFrame(
        [(1, ["a@gmail.com", None, "B@gmail.com", "sin"]), (2, []), (3, None)], "id int, emails array<string>"
    )
    done = ps.validate(people, "emails", dns=zone_frame(spark), order_by="id")
    assert done.columns == ["id", "email", "validation"]
    got = sorted((r["id"], r["validation"]["email"], r["validation"]["sub_status"] or "", r["validation"]["cached"]) for r in done.collect())
    assert got == [
        (1, "", "field_not_found", False),
        (1, "B@gmail.com", "", True),
        (1, "a@gmail.com", "", False),
        (1, "sin", "failed_syntax_check", False),
        (2, "", "field_not_found", False),
        (3, "", "field_not_found", False),
    ]


VALUES = {
    '"a@gmail.com"': ("a@gmail.com", None),
    "12345": ("12345", "invalid_type"),
    "true": ("true", "invalid_type"),
    "null": ("", "field_not_found"),
    '["a@b.com","c"]': ("a@b.com,c", "invalid_type"),
    '[1,null,{"x":1}]': ("1,,[object Object]", "invalid_type"),
    '{"a":1}': ("[object Object]", "invalid_type"),
    '"  "': ("  ", "empty"),
}


def test_json_values(spark):
    items = spark.createDataFrame([(j,) for j in VALUES], "body string").withColumn("v", F.parse_json("body"))
    done = ps.validate(items, "v", dns=zone_frame(spark), fan_out=False)
    got = {r["body"]: (r["validation"]["email"], r["validation"]["sub_status"]) for r in done.collect()}
    assert got == VALUES


def test_json_arrays_fan_out(spark):
    items = spark.createDataFrame([('["a@gmail.com",7]',), ('"b@gmail.com"',)], "body string")
    done = ps.validate(items.select(F.parse_json("body").alias("v")), "v", dns=zone_frame(spark))
    assert sorted((v["email"], v["sub_status"] or "") for v in rows(done)) == [
        ("7", "invalid_type"),
        ("a@gmail.com", ""),
        ("b@gmail.com", ""),
    ]


@pytest.mark.parametrize(
    ("kind", "value", "text"),
    [("int", 5, "5"), ("double", 12345.0, "12345"), ("double", 1.5, "1.5"), ("boolean", True, "true"), ("array<int>", [1, 2], "1,2")],
)
def test_typed_columns_that_are_not_text(spark, kind, value, text):
    (v,) = rows(ps.validate(spark.createDataFrame([(value,)], f"email {kind}"), fan_out=False))
    assert (v["email"], v["sub_status"]) == (text, "invalid_type")


def test_objects_are_not_text(spark):
    (v,) = rows(ps.validate(spark.createDataFrame([((1,),)], "email struct<a:int>")))
    assert (v["email"], v["sub_status"]) == ("[object Object]", "invalid_type")


def test_routes(spark, tmp_path):
    people = spark.createDataFrame([("a@gmail.com",), ("asdf@gmail.com",), ("a@caido.com",)], "email string")
    done = ps.validate(people, dns=zone_frame(spark))
    assert sorted(r["email"] for r in ps.sendable(done).collect()) == ["a@caido.com", "a@gmail.com"]
    assert [r["email"] for r in ps.discarded(done).collect()] == ["asdf@gmail.com"]
    path = str(tmp_path / "out")
    ps.write_routed(done, path)
    assert sorted(d for d in os.listdir(path) if d.startswith("sendable")) == ["sendable=false", "sendable=true"]
    assert spark.read.parquet(path).where("sendable = 'true'").count() == 2
