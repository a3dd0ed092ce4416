"""Large files with quoted line breaks, read by ranges: the rows of the multi-line reader."""

import random

import pytest

from feedrecon.sources import csv_feeds as CSV
from feedrecon.sources import csv_ranges as CR

COLS = "abcd"


@pytest.fixture(params=["300b", "97b", "1k"])
def small_splits(spark, request):
    """Splits of a few hundred bytes, so that small files are large ones."""
    keys = {"spark.sql.files.maxPartitionBytes": request.param, "spark.sql.files.openCostInBytes": "1b"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _write(tmp_path, name, text):
    (tmp_path / name).write_bytes(text.encode())
    return f"file:{tmp_path}/{name}"


def _cell(rng):
    kind = rng.randrange(9)
    word = "".join(rng.choice("xyzäß漢 ") for _ in range(rng.randrange(0, 9)))
    if kind == 0:
        return f'"{word}\n{word}"'
    if kind == 1:
        return f'"{word}""{word}"'
    if kind == 2:
        return '"a, b\n\n""c"",\nd"'
    if kind == 3:
        return '""'
    return word


def _file(rng, n, newline="\n", cell=_cell):
    return newline.join([",".join(COLS), *[",".join(cell(rng) for _ in COLS) for _ in range(n)]]) + rng.choice(["", newline])


def _rows(df):
    return sorted(tuple("" if c is None else c for c in r[1:]) for r in df.collect())


def _multi_line(spark, path):
    return CSV.csv_rows(spark, [path], len(COLS))


@pytest.mark.parametrize("seed", range(3))
def test_ranges_give_the_rows_of_the_multi_line_reader(spark, tmp_path, small_splits, seed):
    rng = random.Random(seed)
    path = _write(tmp_path, "r.csv", _file(rng, 160))
    assert CR.ways(spark, [path]) == {path: CR.RANGES}
    got = CSV.csv_rows(spark, [path], len(COLS), ways={path: CR.RANGES})
    assert _rows(got) == _rows(_multi_line(spark, path))
    assert CR.probe(spark, [path]).count() > 4                      # many ranges


def test_a_record_over_many_ranges(spark, tmp_path, small_splits):
    long = '"' + "\n".join(f"line {i}, ""x""" for i in range(400)) + '"'
    path = _write(tmp_path, "long.csv", f'a,b,c,d\n1,2,3,4\n5,{long},7,8\n9,"x\ny",1,2\n')
    got = CSV.csv_rows(spark, [path], len(COLS), ways={path: CR.RANGES})
    assert _rows(got) == _rows(_multi_line(spark, path)) and got.count() == 3


def test_header_over_a_border(spark, tmp_path, small_splits):
    head = '"' + "a\n" * 400 + '",b,c,d'
    path = _write(tmp_path, "head.csv", f'{head}\n1,"2\n3",4,5\n')
    got = CSV.csv_rows(spark, [path], len(COLS), ways={path: CR.RANGES})
    assert _rows(got) == [("1", "2\n3", "4", "5")]


def test_files_without_breaks_are_split_by_the_ordinary_reader(spark, tmp_path, small_splits):
    rng = random.Random(5)
    plain = _write(tmp_path, "p.csv", _file(rng, 200, cell=lambda r: r.choice(["x", "", '"a, ""b"""', "ü"])))
    assert CR.ways(spark, [plain]) == {plain: CR.PLAIN}
    got = CSV.csv_rows(spark, [plain], len(COLS), ways={plain: CR.PLAIN})
    assert _rows(got) == _rows(_multi_line(spark, plain)) and got.rdd.getNumPartitions() > 1


@pytest.mark.parametrize("odd", ['5" x,b,c,d', '"a"b,c,d,e', "  \n1,2,3,4", "a\rb,c,d,e", '7,5",x,"y\nz"'])
def test_irregular_files_are_read_whole(spark, tmp_path, small_splits, odd):
    path = _write(tmp_path, "odd.csv", "a,b,c,d\n" + '1,"2\n3",4,5\n' * 40 + odd + "\n")
    assert CR.ways(spark, [path]) == {path: CR.WHOLE}


def test_carriage_returns(spark, tmp_path, small_splits):
    rng = random.Random(8)
    path = _write(tmp_path, "crlf.csv", _file(rng, 60, "\r\n", lambda r: r.choice(["x", '"a\nb"', '"a ""q"""'])))
    assert CR.ways(spark, [path]) == {path: CR.RANGES}
    got = CSV.csv_rows(spark, [path], len(COLS), ways={path: CR.RANGES})
    assert _rows(got) == _rows(_multi_line(spark, path))


def test_the_folder_reader_splits_large_files(spark, tmp_path, small_splits):
    head = "stu_id,firstName,lastName,school_code,credential_category,issued_on,status_code,modified_timestamp"
    row = 'stu{0},"Ed{1}",Ng,DIST002-SCH001,GED,2020-01-02,ACT,2021-01-01T00:00:00'
    broken = "\n".join([head, *[row.format(100000 + i, "\nJo" if i % 3 == 0 else "") for i in range(50)]])
    plain = "\n".join([head, *[row.format(200000 + i, "") for i in range(50)]])
    _write(tmp_path, "broken.csv", broken)
    _write(tmp_path, "plain.csv", plain)
    _write(tmp_path, "small.csv", "\n".join([head, row.format(300000, "\nAl")][:1]))
    slots, classified = CSV.read_feeds(spark, str(tmp_path))
    ways = CSV.large_file_ways(spark, classified)
    assert {p.rsplit("/", 1)[1]: w for p, w in ways.items() if "small" not in p} == {"broken.csv": CR.RANGES, "plain.csv": CR.PLAIN}
    rows = {r.raw_student_id: r.raw_first_name for r in slots.collect()}
    assert len(rows) == 100 and rows["stu100000"] == "Ed\nJo" and rows["stu200000"] == "Ed"
    counts = {r.feed: r.source_count for r in CSV.feed_counts(spark, str(tmp_path), classified).collect()}
    assert counts == {"broken.csv": 50, "plain.csv": 50, "small.csv": 0}
