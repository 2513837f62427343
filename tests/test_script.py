"""Scripts of several statements, and loads that name their bad rows."""

import uuid

import pytest

from conftest import rows
from ledgerline.plans.script import ScriptError, run_script
from ledgerline.session import scratch_folder
from ledgerline.sources.rejects import RejectedRows, load_checked, read_checked

SCHEMA = "CustomerID int, CreditScore int, CustomerClass string"


@pytest.fixture
def table(spark):
    name = f"t_{uuid.uuid4().hex}"
    yield name, f"{scratch_folder(spark, 'tables')}/{name}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_last_result_wins_and_tables_are_kept_between_statements(spark, table):
    name, folder = table
    script = f"""
CREATE TABLE IF NOT EXISTS {name} (a INT, b STRING) USING parquet LOCATION '{folder}';
INSERT INTO {name} VALUES (1, 'x;y'), (2, NULL);
SELECT 'not this';
SELECT count(*) AS n, max(b) AS b FROM {name}"""
    assert rows(run_script(spark, script)) == [(2, "x;y")]
    assert rows(run_script(spark, script)) == [(4, "x;y")]        # as SQL: the table is kept, the rows come again
    assert rows(run_script(spark, "SELECT a FROM IDENTIFIER(:t) WHERE a > :least;", {"t": name, "least": 1}), "a") == [(2,), (2,)]


def test_failing_statement_is_named_and_earlier_ones_stay(spark, table):
    name, folder = table
    with pytest.raises(ScriptError, match=r"line 2, 'SELECT nothing FROM .*UNRESOLVED_COLUMN"):
        run_script(spark, f"CREATE TABLE {name} USING parquet LOCATION '{folder}' AS SELECT 1 AS a;\nSELECT nothing FROM {name};\nSELECT 2")
    assert rows(spark.table(name)) == [(1,)]
    with pytest.raises(ScriptError):
        run_script(spark, "SELECT 1;\nSELEC 2")


def write(tmp_path, name, *lines):
    path = tmp_path / name
    path.write_text("\n".join(["CustomerID,CreditScore,CustomerClass", *lines]) + "\n")
    return str(path)


def test_all_bad_rows_of_all_files_are_named(spark, tmp_path):
    from pyspark.sql.types import _parse_datatype_string
    schema = _parse_datatype_string(SCHEMA)
    a = write(tmp_path, "a.csv", "1,600,A", "2,many,B", "3,,C", "", "x,y,D")
    b = write(tmp_path, "b.csv", *[f"{i},5,E" for i in range(100)], "7,8", "9,9,F")
    good, report = read_checked(spark, [a, b], schema)
    assert good.columns == schema.names and good.count() == 2 + 101
    got = sorted((f.rsplit("/", 1)[1], r, t, tuple(c)) for f, r, t, c in rows(report, "file", "row", "text", "columns"))
    assert got == [("a.csv", 2, "2,many,B", ("CreditScore",)), ("a.csv", 4, "x,y,D", ("CustomerID", "CreditScore")), ("b.csv", 101, "7,8", ())]
    target, side = str(tmp_path / "target"), str(tmp_path / "side")
    load_checked(spark, write(tmp_path, "c.csv", "1,2,Z"), schema, target)
    with pytest.raises(RejectedRows) as e:
        load_checked(spark, [a, b], schema, target, side)
    assert e.value.count == 3 and all(x in str(e.value) for x in ("a.csv row 2", "a.csv row 4", "b.csv row 101", "number of cells"))
    assert spark.read.parquet(side).count() == 3 and rows(spark.read.parquet(target)) == [(1, 2, "Z")]


def test_row_numbers_hold_in_files_of_many_splits(spark, tmp_path):
    lines = [f"{i},{i},{'A' * 40}" if i % 97 else f"{i},bad,B" for i in range(1, 5000)]
    path = write(tmp_path, "big.csv", *lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        good, report = read_checked(spark, path, "credit")
        assert rows(report.orderBy("row"), "row", "text") == [(i, f"{i},bad,B") for i in range(97, 5000, 97)]
        assert good.count() + report.count() == 4999
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_header_and_empty_files(spark, tmp_path):
    good, report = read_checked(spark, write(tmp_path, "none.csv"), "credit")
    assert good.count() == 0 and report.count() == 0
    path = tmp_path / "wrong.csv"
    path.write_text("CreditScore,CustomerID,CustomerClass\n1,2,A\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_checked(spark, str(path), "credit")
