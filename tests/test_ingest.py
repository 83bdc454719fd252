import csv
import os

from tradelake.operators.project import sanitize_columns
from tradelake.plans.ingest import ingest_csv_to_parquet


def test_should_sanitize_nothing():
    assert sanitize_columns(["foo"]) == ["foo"]


def test_should_sanitize_whitespace_outside():
    assert sanitize_columns([" foo "]) == ["_foo_"]


def test_should_sanitize_whitespace_in_between():
    assert sanitize_columns(["foo bar"]) == ["foo_bar"]


def test_csv_to_parquet_keeps_strings_and_order(spark, tmp_path):
    src = tmp_path / "input.csv"
    with open(src, "w", newline="") as fh:
        csv.writer(fh).writerows([
            ["first_field", "field with space", " fieldWithOuterSpaces "],
            ["3", "4", "1"],
            ["1", "5", "2"],
        ])
    out = str(tmp_path / "transform")
    ingest_csv_to_parquet(spark, str(src), out)
    actual = spark.read.parquet(out)
    assert actual.columns == ["first_field", "field_with_space", "_fieldWithOuterSpaces_"]
    assert [tuple(r) for r in actual.collect()] == [("3", "4", "1"), ("1", "5", "2")]
    assert all(f.dataType.simpleString() == "string" for f in actual.schema.fields)
    assert os.path.isdir(out)
