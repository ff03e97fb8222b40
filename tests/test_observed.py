"""Checks of rows, counted by the job that writes them."""

from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import quality
from tidemark.operators.quality import Check

CHECKS = [
    Check("t", "not_null", "id"),
    Check("t", "not_null", "kind"),
    Check("t", "accepted_values", "kind", values=("a", "b")),
    Check("t", "accepted_values", "id", values=(1, 2, 3, 4)),
    Check("t", "unique", "id"),
    Check("t", "assertion", "positive"),
]
NEGATIVE = "id < 0"


def checked(spark, path, df, monkeypatch):
    """The report over a written table, and the checks for which its rows were read again."""
    watched, seen = quality.observed(df, CHECKS, {"assertion:t.positive": F.expr(NEGATIVE)})
    watched.write.parquet(path)
    table = spark.read.parquet(path)
    violators = {"assertion:t.positive": table.where(NEGATIVE)}
    plain = rows(quality.report(spark, CHECKS, {"t": table}, violators))
    read, original = [], quality.column_checks

    def recorded(found, checks):
        read.extend(c.name for c in checks)
        return original(found, checks)

    monkeypatch.setattr(quality, "column_checks", recorded)
    got = rows(quality.report(spark, CHECKS, {"t": table}, {}, seen.get))
    monkeypatch.undo()
    assert got == plain
    return got, read


def test_counts_of_the_write_equal_counts_of_the_table(spark, tmp_path, monkeypatch):
    data = [(1, "a"), (1, "x"), (2, "x"), (3, "y"), (None, None), (None, "b"), (4, None)]
    df = spark.createDataFrame(data, "id long, kind string").repartition(5)
    got, read = checked(spark, str(tmp_path / "t"), df, monkeypatch)
    # Only distinct bad values, of which the write has found some, are looked for in the table.
    assert read == ["accepted_values:t.kind"]
    assert [r[3] for r in got if r[2] == "accepted_values"] == [0, 2]


def test_a_table_without_rows(spark, tmp_path, monkeypatch):
    got, _ = checked(spark, str(tmp_path / "t"), spark.createDataFrame([], "id long, kind string"), monkeypatch)
    assert {r[3] for r in got} == {0}


def test_without_such_checks_nothing_is_observed(spark):
    df = spark.range(3)
    assert quality.observed(df, [Check("t", "unique", "id")]) == (df, None)
