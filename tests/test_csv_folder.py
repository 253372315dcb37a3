import os
import random

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from aloft.sources import csv_folder as CF
from aloft.sources import csv_records
from aloft.sources.csv_folder import NoCsvFilesError, read_csv_folder


def _write(folder, name, text):
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_header_drift_aligned_by_name(spark, tmp_path):
    folder = str(tmp_path)
    _write(folder, "a.csv", "A,B\n1,2\n3,4\n")
    _write(folder, "b.csv", "B,A,C\n20,10,x\n")
    _write(folder, "c.csv", " a ,B,\n100,200,\nNA,N/A,junk\n")
    _write(folder, "notes.txt", "ignored\n")
    df = read_csv_folder(spark, folder)
    assert df.columns == ["A", "B", "C"]
    assert _rows(df) == sorted([("1", "2", None), ("3", "4", None), ("10", "20", "x"), ("100", "200", None),
                                (None, None, None)], key=str)


def test_quotes_and_line_ends_inside_fields(spark, tmp_path):
    _write(str(tmp_path), "a.csv", 'A,"B ""b"""\n"two\nlines",5\n"x ""q"" y","1,2"\n7\n')
    df = read_csv_folder(spark, str(tmp_path))
    assert df.columns == ["A", 'B "B"']
    assert _rows(df) == sorted([("two\nlines", "5"), ('x "q" y', "1,2"), ("7", None)], key=str)


def test_header_with_a_line_end(spark, tmp_path):
    _write(str(tmp_path), "a.csv", '"A\na",B\n1,2\n')
    df = read_csv_folder(spark, str(tmp_path))
    assert df.columns == ["A\nA", "B"] and _rows(df) == [("1", "2")]


@pytest.mark.parametrize("record", ["2,3,EXTRA", "2,3,", '2,"3,4",EXTRA', "2,3,,x"])
def test_surplus_fields_are_an_error_that_names_the_file(spark, tmp_path, record):
    _write(str(tmp_path), "good.csv", "A,B\n1,2\n")
    _write(str(tmp_path), "surplus.csv", f"A,B\n1,2\n{record}\n")
    df = read_csv_folder(spark, str(tmp_path))
    with pytest.raises(Exception, match="more fields than the header in .*surplus.csv"):
        df.select("A").collect()


def test_empty_folder_raises(spark, tmp_path):
    with pytest.raises(NoCsvFilesError):
        read_csv_folder(spark, str(tmp_path))


# -- files in splits ---------------------------------------------------------------------------------

def _multiline_reader(spark, files, names):
    """Spark's own reader of line ends inside quotes, which does not split files."""
    df = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(files)
    return _rows(df.toDF(*names))


def _field(r):
    kind = r.randrange(8)
    if kind == 0:
        return '"' + "".join(r.choice(['a', ',', '\n', '""', ' ', '\r\n', 'é']) for _ in range(r.randrange(1, 60))) + '"'
    if kind == 1:
        return 'x"y'  # a quote inside an unquoted field
    if kind == 2:
        return '"plain"'
    return "".join(r.choice("abc12 ") for _ in range(r.randrange(1, 9)))


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_split_scan_equals_the_whole_file_reader(spark, tmp_path, small_splits, seed):
    r = random.Random(seed)
    files = []
    for k in range(4):
        end = "\r\n" if k == 3 else "\n"
        text = "A,B,C" + end + "".join(",".join(_field(r) for _ in range(3)) + end + ("" if r.randrange(9) else end)
                                       for _ in range(120))
        if k == 2:  # one record longer than many splits
            text += '1,"' + "long, text\n" * 200 + '",3' + end
        with open(tmp_path / f"f {k}.csv", "w", newline="", encoding="utf-8") as f:
            f.write(text)
        files.append(str(tmp_path / f"f {k}.csv"))
    df = read_csv_folder(spark, str(tmp_path), tokens=None)
    # Spark's reader turns the line ends inside quotes of a \\r\\n file into \\n; here they stay
    plain = lambda rows: sorted([tuple(v and v.replace("\r\n", "\n") for v in x) for x in rows], key=str)
    assert plain(_rows(df)) == plain(_multiline_reader(spark, files, ["A", "B", "C"]))


def test_one_quoted_file_is_read_by_several_tasks(spark, tmp_path, small_splits):
    with open(tmp_path / "a.csv", "w", newline="") as f:
        f.write("A,B\n" + "".join(f'{i},"line {i}\nend"\n' for i in range(400)))
    groups = CF.survey(spark, CF.list_csv_files(spark, str(tmp_path)))
    assert [(g.header, len(g.lines), len(g.quoted)) for g in groups] == [(("A", "B"), 0, 1)]
    found = csv_records.effects(spark, groups[0].quoted)
    assert found.count() > 10 and found.rdd.getNumPartitions() > 1
    assert any(csv_records.start_states(found.collect()).values())
    df = read_csv_folder(spark, str(tmp_path))
    assert _rows(df) == sorted([(str(i), f"line {i}\nend") for i in range(400)], key=str)


def test_only_files_with_quoted_line_ends_are_put_together(spark, tmp_path):
    _write(str(tmp_path), "a.csv", 'A,B\n1,"x, ""y"""\n')
    _write(str(tmp_path), "b.csv", 'A,B\n2,"x\ny"\n')
    _write(str(tmp_path), "c.csv", "A,B\n3,5\" pipe\n")
    _write(str(tmp_path), "d.csv", "")
    _write(str(tmp_path), "e.csv", "\nA,B\n4,4\n")
    groups = {g.header: g for g in CF.survey(spark, CF.list_csv_files(spark, str(tmp_path)))}
    assert set(groups) == {("A", "B"), ()}
    assert [len(groups["A", "B"].lines), len(groups["A", "B"].quoted)] == [3, 1]
    assert _rows(read_csv_folder(spark, str(tmp_path))) == sorted(
        [("1", 'x, "y"'), ("2", "x\ny"), ("3", '5" pipe'), ("4", "4")], key=str)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet='a,"x', max_size=14))
def test_whole_lines_are_what_the_state_machine_says(line):
    sure = bool(csv_records.whole(pa.array([line]))[0])
    assert not (sure and csv_records.ends_inside(line, False))


def test_many_files_few_headers(spark, tmp_path):
    for i in range(600):
        _write(str(tmp_path), f"{i:04d}.csv", f"A,B\n{i},1\n" if i % 3 else f"B,A\n1,{i}\n")
    groups = CF.survey(spark, CF.list_csv_files(spark, str(tmp_path)))
    assert sorted((g.header, len(g.lines)) for g in groups) == [(("A", "B"), 400), (("B", "A"), 200)]
    got = read_csv_folder(spark, str(tmp_path))
    assert sorted(int(r["A"]) for r in got.collect()) == list(range(600)) and got.where("B <> '1'").count() == 0
