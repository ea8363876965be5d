"""The parallel record scan against Python's csv reader, with records straddling splits."""

import csv
import io
import random

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from ledgerproof.sources import csvfiles, quality, records
from ledgerproof.sources.headers import clean_header, clean_name, read_header
from ledgerproof.sources.records import numbered_lines, raw_lines, read_records, split_offsets

HEADER = "UNIQUE_KEY,free text,note"


def reference(data: str):
    """(record_num, start_line, end_line, cells) of every record behind the header."""
    reader = csv.reader(io.StringIO(data, newline=""))
    next(reader)
    end = reader.line_num
    out = []
    for num, row in enumerate(reader, start=1):
        start, end = end + 1, reader.line_num
        out.append((num, start, end, row))
    return out


def quoted(cell: str) -> str:
    return '"' + cell.replace('"', '""') + '"'


def random_records(seed: int, rows: int, newline: str) -> list[tuple[str, list[str]]]:
    """Records as written, with the cells they were written from."""
    rng = random.Random(seed)
    pieces = ["word", ",", '"', "\n", "\r\n", " ", "é", "x" * 40, '""', "\n\n", "\u0001", "\u0001\u0003"]
    if newline == "\n":
        pieces.remove("\r\n")
    out = []
    for i in range(rows):
        cells = [f"K{i}"]
        for _ in range(2):
            cells.append("".join(rng.choice(pieces) for _ in range(rng.choice((0, 0, 1, 3, 9)))))
        if rng.random() < 0.05:
            cells.append(rng.choice(["extra", "surplus\nx", "a,b\n"]))
        elif rng.random() < 0.05:
            cells.pop()
        written = [c if set(c).isdisjoint(',"\r\n') and rng.random() < 0.5 else quoted(c) for c in cells]
        out.append((",".join(written), cells))
    return out


def random_csv(seed: int, rows: int, newline: str, last_newline: bool = True) -> str:
    lines = [HEADER, *(text for text, _ in random_records(seed, rows, newline))]
    return newline.join(lines) + (newline if last_newline else "")


def write(path, data: str) -> str:
    path.write_bytes(data.encode("utf-8"))
    return str(path)


@pytest.mark.parametrize(
    "seed,newline,last,broadcast",
    [(1, "\n", True, True), (2, "\r\n", True, True), (3, "\n", False, True), (7, "\n", True, False)],
)
def test_records_match_csv_reader_across_splits(
    spark, tmp_path, small_splits, monkeypatch, seed, newline, last, broadcast
):
    if not broadcast:
        monkeypatch.setattr(records, "MAX_BROADCAST_SPLITS", 0)
    data = random_csv(seed, 120, newline, last)
    path = write(tmp_path / "a.csv", data)
    splits = split_offsets(raw_lines(spark, path)).count()
    assert splits > 10
    want = reference(data)
    parsed = csvfiles.read_parsed(spark, path).withColumn("own", records.own_cells("raw"))
    got = parsed.orderBy("record_num").collect()
    assert [(r.record_num, r.start_line, r.end_line) for r in got] == [w[:3] for w in want]
    assert [r.fields for r in got] == [len(w[3]) for w in want]
    assert [r.own for r in got] == [w[3] for w in want]
    assert not any(r.unclosed for r in got)
    for r, w in zip(got, want):
        if r.fields == r.expected:
            assert [c or "" for c in r.cells] == w[3]
    positions = quality.record_positions(spark, path).first()
    assert (positions.records, positions.faults) == (len(want) + 1, 0)
    assert positions.lines == positions.last_line == want[-1][2]


def test_line_numbers_are_complete(spark, tmp_path, small_splits):
    data = random_csv(4, 80, "\n")
    path = write(tmp_path / "a.csv", data)
    lines = numbered_lines(spark, path).orderBy("line_num").collect()
    assert [r.line_num for r in lines] == list(range(1, data.count("\n") + 1))
    assert [r.value for r in lines] == data.split("\n")[:-1]


def test_every_file_has_its_own_header_and_numbers(spark, tmp_path, small_splits):
    datas = {f"f{i}.csv": random_csv(10 + i, 30, "\n") for i in range(3)}
    for name, data in datas.items():
        write(tmp_path / name, data)
    got = csvfiles.read_parsed(spark, str(tmp_path)).orderBy("file", "record_num").collect()
    for name, data in datas.items():
        mine = [(r.record_num, r.start_line, r.end_line) for r in got if r.file.endswith(name)]
        assert mine == [w[:3] for w in reference(data)]


def test_multiline_report_names_what_was_written(spark, tmp_path, small_splits):
    header, want, line = HEADER.split(","), {}, 1
    written = random_records(5, 150, "\r\n")
    for number, (text, cells) in enumerate(written, start=1):
        extra = text.count("\n")
        broken = [i for i, c in enumerate(cells) if not set(c).isdisjoint("\r\n")]
        if broken:
            names = [header[i] for i in broken if i < len(header)]
            want[number] = (line + 1, line + 1 + extra, extra, cells[0], ";".join(map(str, broken)), ";".join(names))
        line += 1 + extra
    path = write(tmp_path / "a.csv", "\r\n".join([HEADER, *(t for t, _ in written)]) + "\r\n")
    report = quality.multiline_records(spark, path, key="UNIQUE_KEY", preview_chars=20)
    got = {r.record_num: tuple(r)[2:8] for r in report.collect()}
    assert got == want
    assert any("3" in w[4] for w in want.values())
    for r in report.collect():
        first = int(r.fields_with_newline_indexes.split(";")[0])
        label, _, shown = r.preview.partition(": ")
        assert label == (header[first] if first < 3 else "") and "\n" not in shown and len(shown) <= 23
        assert written[r.record_num - 1][1][first].startswith(shown[:1].replace("\\", "\n")) or "\\" in shown[:1]
    totals = quality.multiline_totals(spark, path).first()
    assert totals.scanned_records == 150
    assert totals.extra_physical_lines == sum(w[2] for w in want.values())
    assert totals.multiline_records == len(want)
    few = quality.multiline_records(spark, path, first=3).collect()
    assert [r.record_num for r in few] == sorted(want)[:3]


def test_previews_show_the_records_own_cells(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'a,b,c\n1,2,3,"surplus\nx",5\n6,7\n8,"9 ""q""",10\n')
    rows = quality.bad_structure(spark, path).orderBy("record_num").collect()
    assert [r.preview for r in rows] == ["1 | 2 | 3 | surplus\\nx | 5", "6 | 7"]
    row = quality.multiline_records(spark, path).first()
    assert (row.fields_with_newline_indexes, row.fields_with_newline_names) == ("3", "")
    with pytest.raises(PySparkException, match=r"1 \| 2 \| 3 \| surplus"):
        csvfiles.read_strict(spark, path).agg({"a": "max"}).collect()
    assert [r.record_num for r in quality.bad_structure(spark, path, first=1).collect()] == [1]


def test_bad_structure_and_loads(spark, tmp_path, small_splits):
    data = random_csv(6, 150, "\n") + "\nK-after-blank,x,y\n"
    path = write(tmp_path / "a.csv", data)
    want = [(n, s, e, len(row)) for n, s, e, row in reference(data) if len(row) != 3]
    assert any(w[3] == 0 for w in want) and any(w[3] == 4 for w in want) and any(w[3] == 2 for w in want)
    got = quality.bad_structure(spark, path).orderBy("record_num").collect()
    assert [(r.record_num, r.start_line, r.end_line, r.actual_fields) for r in got] == want
    rejects = sum(1 for w in want if w[3])
    summary = csvfiles.reject_summary(spark, path, cap=rejects).first()
    assert (summary.rejected, summary.accepted) == (rejects, True)
    assert not csvfiles.reject_summary(spark, path, cap=rejects - 1).first().accepted
    good = csvfiles.read_tolerant(spark, path, cap=rejects)
    assert good.columns == ["UNIQUE_KEY", "free_text", "note"]
    assert good.count() == len(reference(data)) - len(want)
    with pytest.raises(csvfiles.RejectedRows, match=f"more than {rejects - 1}"):
        csvfiles.read_tolerant(spark, path, cap=rejects - 1)
    with pytest.raises(PySparkException, match=r"malformed record \d+, lines \d+-\d+ of .*a.csv: \d fields instead of 3"):
        csvfiles.read_strict(spark, path).agg({"note": "max"}).collect()


def test_strict_load_passes_sound_files(spark, tmp_path, small_splits):
    """Lines inside a record look malformed by themselves; they must not stop the load."""
    rows = [f'K{i},"a,b\nc,d,e,f\n{i}",x' for i in range(200)]
    path = write(tmp_path / "a.csv", HEADER + "\n" + "\n".join(rows) + "\n")
    stored = str(tmp_path / "stored")
    csvfiles.read_strict(spark, path).write.parquet(stored)
    assert spark.read.parquet(stored).count() == 200


@pytest.mark.parametrize("column", [0, 1, 2])
@pytest.mark.parametrize("split", ["300", "1m"])
def test_open_quotes_stop_or_are_reported(spark, tmp_path, small_splits, column, split):
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    cells = ["K", "plain", "x"]
    cells[column] = '"' + cells[column]
    lines = [HEADER, *["K,plain,x"] * 100, ",".join(cells), *["K,plain,x"] * 900]
    path = write(tmp_path / "a.csv", "\n".join(lines) + "\n")
    raw = read_records(spark, path).where("unclosed").collect()
    assert [(r.record_num, r.start_line, r.end_line, r.raw) for r in raw] == [(101, 102, 1002, lines[101])]
    for reader in (csvfiles.read_strict, csvfiles.read_quoted):
        # Spark wraps the error when both halves of the scan meet it at the same time.
        with pytest.raises((PySparkException, Py4JJavaError), match="a quote is left open .* record 101 from line 102"):
            reader(spark, path).agg({"note": "max"}).collect()
    with pytest.raises(csvfiles.RejectedRows, match="a quote is left open"):
        csvfiles.read_tolerant(spark, path, cap=10_000)
    summary = csvfiles.reject_summary(spark, path, cap=10_000).first()
    assert (summary.loaded, summary.rejected, summary.open_quotes, summary.accepted) == (100, 1, 1, False)
    bad = quality.bad_structure(spark, path).collect()
    assert [(r.record_num, r.start_line, r.unclosed) for r in bad] == [(101, 102, True)]
    balance = quality.quote_balance(spark, path).first()
    assert (balance.lines, balance.records, balance.quotes, balance.open_record) == (1002, 102, 1, 101)
    with pytest.raises(csvfiles.RejectedRows):
        csvfiles.load_tolerant(spark, path, 10_000, str(tmp_path / "rejects"))
    assert spark.read.parquet(str(tmp_path / "rejects")).first().start_line == 102


def test_open_quote_spoils_only_its_own_file(spark, tmp_path, small_splits):
    write(tmp_path / "a.csv", HEADER + '\nK1,"open,x\n' + "K,plain,x\n" * 200)
    write(tmp_path / "b.csv", HEADER + "\n" + 'K,"a\nb",x\n' * 200)
    balance = {r.file[-5:]: r.open_record for r in quality.quote_balance(spark, str(tmp_path)).collect()}
    assert balance == {"a.csv": 1, "b.csv": None}
    assert csvfiles.read_parsed(spark, str(tmp_path)).where("NOT unclosed").count() == 200


@pytest.mark.parametrize("quoted", [True, False])
def test_another_header_in_a_further_file_stops_every_load(spark, tmp_path, quoted):
    reader = csvfiles.read_quoted if quoted else csvfiles.read_unquoted
    write(tmp_path / "a.csv", "k,v,w\n1,2,3\n")
    write(tmp_path / "b.csv", "k,v,w\n4,5,6\n")
    assert sorted(map(tuple, reader(spark, str(tmp_path)).collect())) == [("1", "2", "3"), ("4", "5", "6")]
    write(tmp_path / "c.csv", "w,v,k\n7,8,9\n")
    with pytest.raises((PySparkException, Py4JJavaError), match="c.csv"):
        reader(spark, str(tmp_path)).collect()
    write(tmp_path / "c.csv", "7,8,9\n")  # without a header
    with pytest.raises((PySparkException, Py4JJavaError), match="c.csv"):
        reader(spark, str(tmp_path)).collect()
    if quoted:
        for strict in (csvfiles.read_strict, lambda s, p: csvfiles.read_tolerant(s, p, 9)):
            with pytest.raises((PySparkException, Py4JJavaError), match="another header in .*c.csv: 7,8,9"):
                strict(spark, str(tmp_path)).collect()


def test_one_text_pass_and_bounded_keys(spark, tmp_path):
    """Only one pass hands text to Python; the counting pass and the pieces do not."""
    path = write(tmp_path / "a.csv", random_csv(1, 20, "\n"))
    plan = read_records(spark, path)._jdf.queryExecution().optimizedPlan().toString()
    passes = [line for line in plan.splitlines() if "MapInArrow" in line]
    assert sum("join_records" in line for line in passes) == 1
    assert all("count_splits" in line or "join_records" in line for line in passes)


def test_missing_records_keep_duplicates_and_skip_blank_keys(spark, tmp_path, small_splits):
    rows = [f"K{i % 40},t{i},n" for i in range(60)] + [",blank,n", '"  ",blank,n', " K7 ,padded,n"]
    path = write(tmp_path / "a.csv", HEADER + "\n" + "\n".join(rows) + "\n")
    target = spark.createDataFrame([(f"K{i}",) for i in range(40) if i not in (3, 7, 25)], "k string")
    got = quality.missing_records(spark, path, "UNIQUE_KEY", target, "k")
    found = sorted((r.source_line_num, r.UNIQUE_KEY.strip()) for r in got.collect())
    assert found == [(5, "K3"), (9, "K7"), (27, "K25"), (45, "K3"), (49, "K7"), (64, "K7")]


def test_line_count_check(spark, tmp_path):
    path = write(tmp_path / "a.csv", HEADER + '\nK1,"a\nb",x\nK2,c,x\nK3,d,x')
    row = quality.line_vs_record_count(spark, path, csvfiles.read_quoted(spark, path)).first()
    assert (row.expected_lines, row.loaded_rows, row.diff, row.matches) == (4, 3, 1, False)
    shape = quality.record_shape(spark, path).first()
    assert (shape.records, shape.columns) == (3, 3)


def test_terminators(spark, tmp_path):
    path = write(tmp_path / "a.csv", "a,b\r\n1,2\r\n3,4\n")
    row = quality.terminator_profile(spark, path).first()
    assert (row.crlf_lines, row.lf_lines, row.terminator) == (2, 1, "CRLF")


def test_header_names():
    assert clean_header(["﻿ID", " amount usd", "x-y", "x y", "", None, "É#1", "COL", "id"]) == [
        "ID", "amount_usd", "x_y", "x_y_2", "COL_5", "COL_6", "É_1", "COL_8", "id_2",
    ]
    assert clean_header(["X", "X", "X", "X_2"]) == ["X", "X_2", "X_3", "X_2_2"]
    assert clean_name("﻿", 4) == "COL_4"


def test_bom_and_blank_header_cells(spark, tmp_path):
    path = write(tmp_path / "a.csv", '﻿"Key, long",,a-b,a b\n1,2,3,"4,5"\n,"",,\n')
    assert clean_header(read_header(spark, path)) == ["Key__long", "COL_2", "a_b", "a_b_2"]
    for reader in (csvfiles.read_quoted, csvfiles.read_report):
        rows = {tuple(r) for r in reader(spark, path).collect()}
        assert rows == {("1", "2", "3", "4,5"), (None, None, None, None)}, reader


def test_unquoted_lines(spark, tmp_path, small_splits):
    lines = [f'{i},"x,y{i}"' for i in range(100)] + ["short", "1,2,3,4,5", "a\x00b,c,d", ",,"]
    path = write(tmp_path / "a.csv", "k,v,w\n" + "\n".join(lines) + "\n")
    got = sorted(map(tuple, csvfiles.read_unquoted(spark, path).collect()), key=str)
    want = [(str(i), '"x', f'y{i}"') for i in range(100)]
    want += [("short", None, None), ("1", "2", "3,4,5"), ("a\x00b", "c", "d"), (None, None, None)]
    assert got == sorted(want, key=str)
    good, rejected = csvfiles.split_rejects(spark, path, quoted=False)
    assert good.count() == 102
    assert sorted((r.raw, r.fields) for r in rejected.collect()) == [("1,2,3,4,5", 5), ("short", 1)]
    assert csvfiles.read_tolerant(spark, path, cap=2, quoted=False).count() == 102
    with pytest.raises(csvfiles.RejectedRows):
        csvfiles.read_tolerant(spark, path, cap=1, quoted=False)


def test_inferred_types(spark, tmp_path):
    typed = write(tmp_path / "b.csv", "k,v\n1,2.5\n2,3.5\n")
    assert csvfiles.read_inferred(spark, typed).dtypes == [("k", "bigint"), ("v", "decimal(38,10)")]
    more = write(tmp_path / "c.csv", 'd,t,b,e,m\n2024-01-02,2024-01-02 03:04:05,true,1e300,"x\ny"\n,,,,\n')
    assert [k for _, k in csvfiles.read_inferred(spark, more).dtypes] == ["date", "timestamp", "boolean", "double", "string"]
    odd = "a,b,c,d,e\n+1,-2.5,2024-1-2,TRUE,.5\n7,3,2024-01-02,x,1e5\n99999999999999999999,1234567890123456.5,,false,5\n"
    kinds = [k for _, k in csvfiles.read_inferred(spark, write(tmp_path / "e.csv", odd)).dtypes]
    assert kinds == ["decimal(38,10)", "decimal(38,10)", "date", "string", "double"]
    bare = write(tmp_path / "d.csv", "k,v\n")
    assert csvfiles.read_inferred(spark, bare).dtypes == [("k", "string"), ("v", "string")]


def test_empty_to_null_and_json_keys(spark):
    df = spark.createDataFrame([("", 1), ("a", 2)], "t string, n int")
    assert [tuple(r) for r in csvfiles.empty_to_null(df).collect()] == [(None, 1), ("a", 2)]
    keys = spark.createDataFrame([('["a","b"]',), ("[]",), (None,)], "j string")
    assert [r.value for r in csvfiles.json_keys(keys, "j").collect()] == ["a", "b"]


def test_empty_and_header_only_files(spark, tmp_path):
    write(tmp_path / "a.csv", HEADER + "\n")
    write(tmp_path / "b.csv", HEADER + "\nK1,x,y\n")
    write(tmp_path / "c.csv", "")
    path = str(tmp_path)
    assert [tuple(r) for r in csvfiles.read_quoted(spark, path).collect()] == [("K1", "x", "y")]
    assert [tuple(r) for r in csvfiles.read_unquoted(spark, path).collect()] == [("K1", "x", "y")]
    assert quality.record_shape(spark, path).first().records == 1
