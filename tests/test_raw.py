import uuid

import pytest
from helpers import plan_of, rows, settings
from pyspark.sql import Observation

from bankmart.operators.dedup import SOURCE_ORDER, keep_first
from bankmart.sources.raw import (
    ALL, LAST_WINS, REJECT, SameName, first_lines, raw_files, read_csv, read_raw_table, split_rejected, typed,
)


def write(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(content)
    return str(path)


def test_raw_files_are_found_by_name_in_any_folder(spark, tmp_path):
    write(tmp_path / "a" / "accounts.csv", "x\n1\n")
    write(tmp_path / "b" / "c" / "notes.txt", "x\n1\n")
    write(tmp_path / "b" / "accounts.csv", "x\n22\n")
    write(tmp_path / "b" / "skip.json", "{}")
    root = str(tmp_path)
    found = rows(raw_files(spark, root, LAST_WINS), "file_name", "path", "length")
    assert [name for name, _, _ in found] == ["accounts.csv", "notes.txt"]
    assert found[0][1].endswith("/b/accounts.csv") and found[0][2] == 5
    assert raw_files(spark, root, ALL).count() == 3
    assert rows(read_raw_table(spark, root, "accounts.csv", LAST_WINS), "x") == [("22",)]
    assert rows(read_raw_table(spark, root, "accounts.csv", ALL), "x") == [("1",), ("22",)]


def test_files_of_one_name_stop_the_job_by_default(spark, tmp_path):
    write(tmp_path / "2024" / "01" / "transactions.csv", "x\n1\n")
    write(tmp_path / "2024" / "02" / "transactions.csv", "x\n2\n")
    write(tmp_path / "notes.csv", "x\n3\n")
    root = str(tmp_path)
    for read in (lambda: raw_files(spark, root), lambda: read_raw_table(spark, root, "transactions.csv")):
        with pytest.raises(SameName, match="2 files .* transactions.csv"):
            read()
    assert rows(read_raw_table(spark, root, "notes.csv"), "x") == [("3",)]


def test_a_table_is_several_files_or_a_folder(spark, tmp_path):
    write(tmp_path / "2024" / "01" / "t.csv", "a,b\n1,x\n")
    write(tmp_path / "2024" / "02" / "t.csv", "b,a\ny,2\n")
    write(tmp_path / "more.csv", "a\n3\n")
    expected = [("1", "x"), ("2", "y")]
    assert rows(read_raw_table(spark, str(tmp_path), "2024/"), "a", "b") == expected
    assert rows(read_raw_table(spark, str(tmp_path), ["2024/", "more.csv"]), "a", "b") == [*expected, ("3", None)]
    assert rows(read_csv(spark, str(tmp_path / "2024")), "a", "b") == expected


@pytest.mark.parametrize("line", ["1,2,3", "1"])
def test_rows_that_do_not_fit_their_header_stop_the_job(spark, tmp_path, line):
    path = write(tmp_path / "t.csv", f"a,b\n1,2\n{line}\n")
    with pytest.raises(Exception, match="MALFORMED"):
        read_csv(spark, path).select("a").collect()
    assert len(rows(read_csv(spark, path, malformed="keep"), "a")) == 2


def test_unreadable_values_are_counted(spark, tmp_path):
    path = write(tmp_path / "t.csv", "ProductCategoryID,ProductCategoryName\n1,a\nx,b\n7.5,c\n,d\n")
    seen = Observation("lost")
    assert rows(typed(read_csv(spark, path), "DimProductCategory", observation=seen), "ProductCategoryID") == [(None,)] * 3 + [(1,)]
    assert seen.get == {"ProductCategoryID": 2, "ProductCategoryName": 0}


def test_no_raw_file_is_an_error(spark, tmp_path):
    write(tmp_path / "only.json", "{}")
    with pytest.raises(FileNotFoundError):
        raw_files(spark, str(tmp_path))
    write(tmp_path / "a.csv", "x\n1\n")
    with pytest.raises(FileNotFoundError):
        read_raw_table(spark, str(tmp_path), "b.csv")


def test_csv_text_is_kept_and_markers_are_null(spark, tmp_path):
    path = write(tmp_path / "t.csv", 'a,b\n1.0,"x, ""y"""\nNA, pad \n"",n/a\n')
    assert rows(read_csv(spark, path), "a", "b") == [(None, None), (None, " pad "), ("1.0", 'x, "y"')]


def test_line_breaks_in_quotes_need_multi_line(spark, tmp_path):
    path = write(tmp_path / "t.csv", 'a,b\n1,"two\nlines"\n2,x\n')
    assert rows(read_csv(spark, path, multi_line=True), "a", "b") == [("1", "two\nlines"), ("2", "x")]


def test_first_row_is_first_in_the_file_even_when_it_is_split(spark, tmp_path):
    lines = [f"{i % 100},{i}" for i in range(4000)]
    path = write(tmp_path / "t.csv", "k,v\n" + "\n".join(lines) + "\n")
    with settings(spark, spark_sql_files_maxPartitionBytes="3000", spark_sql_files_openCostInBytes="1"):
        df = read_csv(spark, path)
        assert df.rdd.getNumPartitions() > 5
        kept = keep_first(df, ["k"]).collect()
    assert {int(r.v) for r in kept} == set(range(100))


def test_files_of_a_folder_are_ordered_by_path(spark, tmp_path):
    write(tmp_path / "t" / "2.csv", "k,v\n1,second\n" + "9,filler\n" * 50)
    write(tmp_path / "t" / "1.csv", "k,v\n0,other\n1,first\n")
    kept = keep_first(read_csv(spark, str(tmp_path / "t")), ["k"])
    assert ("1", "first") in rows(kept, "k", "v")


def test_typed_picks_columns_by_name(spark, tmp_path):
    header = "Status,Balance,AccountID,CustomerID,Extra,AccountType,OpenDate,ClosedDate,RegistrationID"
    path = write(tmp_path / "t.csv", f"{header}\nOpen,12.5,1.0,7,zzz,Savings,2024-01-02,bad,nan\n")
    df = typed(read_csv(spark, path), "DimAccount")
    row = df.collect()[0]
    assert (row.AccountID, row.CustomerID, row.Balance, row.ClosedDate, row.RegistrationID) == (1, 7, 12.5, None, None)
    assert str(row.OpenDate) == "2024-01-02 00:00:00"
    assert df.columns[-1] == SOURCE_ORDER and "Extra" not in df.columns


def jobs_run(spark, action):
    """Spark jobs that an action starts."""
    group = f"counted-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, "")
    try:
        action()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_jobs_do_not_grow_with_files(spark, tmp_path):
    for n in (2, 40):
        for i in range(n):
            write(tmp_path / str(n) / f"d{i % 3}" / f"{i}.csv", f"a,b\n{i},x\n" if i % 2 else f"b,a\nx,{i}\n")
    counts = [jobs_run(spark, lambda n=n: read_raw_table(spark, str(tmp_path), f"{n}/")) for n in (2, 40)]
    assert counts[0] == counts[1]
    assert rows(read_raw_table(spark, str(tmp_path), "40/"), "a", "b") == sorted((str(i), "x") for i in range(40))


def test_header_is_the_first_line_that_is_not_blank(spark, tmp_path):
    write(tmp_path / "a.csv", "\n  \nx,y\n1,2\n")
    write(tmp_path / "b.csv", "\ufeffx,y\n3,4\n")
    write(tmp_path / "empty.csv", "")
    write(tmp_path / "c.txt", "z\n")
    found = {r.path.split("/")[-1]: r.header for r in first_lines(spark, [str(tmp_path)]).collect()}
    assert found == {"a.csv": "x,y", "b.csv": "x,y", "c.txt": "z"}
    assert rows(read_csv(spark, str(tmp_path), glob="*.csv"), "x", "y") == [("1", "2"), ("3", "4")]
    with pytest.raises(FileNotFoundError):
        read_csv(spark, str(tmp_path / "empty.csv"))


def test_a_task_per_file_however_large(spark, tmp_path):
    write(tmp_path / "large.csv", "a,b\n" + "1,2\n" * 300_000)
    write(tmp_path / "small.csv", "c\n")
    with settings(spark, spark_sql_files_maxPartitionBytes="100KB"):
        first = first_lines(spark, [str(tmp_path)])
        assert first.rdd.getNumPartitions() == 2
        assert rows(first, "header") == [("a,b",), ("c",)]


def test_paths_of_headers_are_decoded_once_a_file(spark, tmp_path):
    write(tmp_path / "a +%b" / "1.csv", "\n \t\na,b\n1,2\n")
    first = first_lines(spark, [str(tmp_path / "a +%b")])
    assert [(r.path.split("/")[-2], r.header) for r in first.collect()] == [("a +%b", "a,b")]
    plan = plan_of(first)
    assert plan.index("MapInArrow") > plan.index("decode")


def test_names_with_glob_signs(spark, tmp_path):
    write(tmp_path / "x" / "t[1].csv", "a\n1\n")
    write(tmp_path / "y" / "t[1].csv", "a\n2\n")
    write(tmp_path / "y" / "t1.csv", "a\n3\n")
    write(tmp_path / "z z" / "50%+{a}.csv", "b,a\nx,4\n")
    write(tmp_path / "z z" / "plain.csv", "a,b\n5,y\n")
    assert rows(read_raw_table(spark, str(tmp_path), "t[1].csv", ALL), "a") == [("1",), ("2",)]
    assert rows(read_raw_table(spark, str(tmp_path), "t[1].csv", LAST_WINS), "a") == [("2",)]
    assert rows(read_raw_table(spark, str(tmp_path), "z z/"), "a", "b") == [("4", "x"), ("5", "y")]


def test_rows_that_do_not_fit_are_set_aside(spark, tmp_path):
    path = write(tmp_path / "t.csv", 'a,b\n1,2\n1,2,3\n4\n"5,\n6,"x,y"\n')
    kept, rejected = split_rejected(read_csv(spark, path, malformed=REJECT))
    assert rows(kept, "a", "b") == [("1", "2"), ("6", "x,y")] and kept.columns == ["a", "b", SOURCE_ORDER]
    assert rejected.columns == ["file", "block", "row", "text", "reason"]
    assert rows(rejected, "text", "reason", "block", "row") == [
        ('"5,', "quote without end", 0, 3), ("1,2,3", "3 fields instead of 2", 0, 1), ("4", "1 fields instead of 2", 0, 2),
    ]
    assert rejected.first()["file"].endswith("/t.csv")


@pytest.mark.parametrize("text,expected", [
    ("7", 7), ("7.0", 7), (" 7 ", 7), ("7.5", None), ("-3", -3), ("1e3", 1000), ("x", None), ("", None), (None, None), ("9223372036854775807", 2**63 - 1),
])
def test_keys(spark, text, expected):
    frame = spark.createDataFrame([(text, "n")], "ProductCategoryID string, ProductCategoryName string")
    assert typed(frame, "DimProductCategory").first()["ProductCategoryID"] == expected
