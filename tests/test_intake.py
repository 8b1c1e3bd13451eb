import datetime
from decimal import Decimal

import pytest
from helpers import as_text
from feeds import VALID, feed, put

from tallyframe.operators.conform import accepted_rows, conform, header_groups, parse_files, rejected_rows
from tallyframe.operators.contract import bad_files, check_files, quarantine_lines
from tallyframe.schema import SALES_FACT
from tallyframe.sources.files import HEADER_CHARACTERS, _listing_of, as_uri, list_files, read_headers


def variants(tmp_path):
    put(tmp_path, "valid.csv", feed(VALID, "1,121,soap,2023-03-03,1,1.5,2,3.0"))
    put(tmp_path, "sub/extra.csv", feed(VALID + ",payment_mode", "1,121,soap,2023-03-03,1,1.5,2,3.0,UPI"))
    put(tmp_path, "missing.csv", feed(VALID.replace("store_id,", "") + ",payment_mode", "1,soap,2023-03-03,[1, 2],1,2,2,UPI"))
    put(tmp_path, "header_only.csv", VALID + "\n")
    put(tmp_path, "zero.csv", "")
    put(tmp_path, "blank.csv", "\n \n")
    put(tmp_path, "notes.txt", "not a table")
    put(tmp_path, "CASE.CSV", VALID + "\n")
    put(tmp_path, "late header+1 %41.csv", "\n\n" + VALID + "\r\n")
    put(tmp_path, "quoted.csv", '"' + VALID.replace(",", '","') + '","a, b"\n')
    put(tmp_path, "twice.csv", VALID + ",zone,Zone,\n")
    put(tmp_path, "bom.csv", "\ufeff" + VALID + "\n")
    put(tmp_path, "price_twice.csv", VALID + ",price\n")
    return str(tmp_path)


@pytest.mark.parametrize("how", ["open", "scan"])
def test_verdicts(spark, tmp_path, how):
    files = list_files(spark, variants(tmp_path))
    checked = check_files(files, headers=read_headers(files.where("file_name like '%.csv'"), how))
    got = {r.file_name: (r.verdict, r.reason, r.missing, r.extra) for r in checked.collect()}
    assert got == {
        "valid.csv": ("ok", None, [], []),
        "extra.csv": ("ok", None, [], ["payment_mode"]),
        "missing.csv": ("error", "missing columns: store_id", ["store_id"], ["payment_mode"]),
        "header_only.csv": ("ok", None, [], []),
        "zero.csv": ("error", "no header line", None, None),
        "blank.csv": ("error", "no header line", None, None),
        "notes.txt": ("error", "not a csv file", None, None),
        "CASE.CSV": ("error", "not a csv file", None, None),
        "late header+1 %41.csv": ("ok", None, [], []),
        "quoted.csv": ("ok", None, [], ["a, b"]),
        "twice.csv": ("ok", None, [], ["zone8", "Zone9", "_c10"]),
        "bom.csv": ("ok", None, [], []),
        "price_twice.csv": ("error", "missing columns: price", ["price"], ["price5", "price8"]),
    }


def test_names_are_those_of_the_csv_reader(spark, tmp_path):
    files = list_files(spark, variants(tmp_path))
    for row in check_files(files).where("header is not null").collect():
        assert row.header == spark.read.option("header", True).csv(row.path.replace("file://", "")).columns


def test_file_names_are_taken_literally(spark, tmp_path):
    names = ["day [1].csv", "day 1.csv", "a{b,c}*.csv", "50% #2?+x.csv"]
    for number, name in enumerate(names):
        put(tmp_path, name, feed(VALID, f"{number},121,soap,2023-03-03,1,1.5,2,3.0"))
    files = list_files(spark, str(tmp_path))
    for how in ("open", "scan"):
        assert read_headers(files, how).where("header_line is null").count() == 0
    parsed = parse_files(spark, header_groups(check_files(files)))
    found = {r.source_file.rsplit("/", 1)[1]: r.customer_id for r in accepted_rows(parsed).collect()}
    assert found == {name: number for number, name in enumerate(names)}


def test_choice_of_the_header_read(spark, tmp_path):
    put(tmp_path, "a.csv", VALID + "\n")
    files = list_files(spark, str(tmp_path))
    assert as_uri("s3a://shop/in/a b.csv") == "s3://shop/in/a%20b.csv"
    spark.conf.set("spark.tallyframe.headers", "scan")
    try:
        plan = read_headers(files)._jdf.queryExecution().optimizedPlan().toString()
        assert "MapInArrow" not in plan and check_files(files).first().verdict == "ok"
    finally:
        spark.conf.unset("spark.tallyframe.headers")
    assert "MapInArrow" in read_headers(files)._jdf.queryExecution().optimizedPlan().toString()
    with pytest.raises(ValueError):
        read_headers(files, "guess")


def test_listing(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        list_files(spark, str(tmp_path))
    put(tmp_path, "in/x.csv", VALID)
    row = list_files(spark, str(tmp_path)).first()
    assert row.file_name == "x.csv" and row.object_key == f"{tmp_path}/in/x.csv".lstrip("/")


def tree(tmp_path):
    """Folders of several depths, hidden and empty ones among them; names that are patterns, percent signs, copies."""
    line = feed(VALID, "1,121,soap,2023-03-03,1,1.5,2,3.0")
    names = ["a.csv", "b [1].csv", "50% #2?+x.csv", "deep/1/2/3/4/5/6/7/8/9/d.csv", "deep/1/2/3/4/5/6/7/8/9/_h.csv", "_tmp/part.csv"]
    names += ["_tmp/.s.csv", ".x.csv", "_y.csv", ".x.csv.crc", "k=1/_part=2/z.csv", "_k=v.csv", "c.csv._COPYING_", "_metadata_1", "_metadata/m.csv", "note.txt"]
    names += [f"wide/{n}/f.csv" for n in range(40)]
    for name in names:
        put(tmp_path, name, line)
    put(tmp_path, "deep/empty.csv", "")
    (tmp_path / "nothing" / "here").mkdir(parents=True)
    return str(tmp_path)


def test_listing_in_tasks_equals_the_listing_of_the_source(spark, tmp_path):
    columns = ["path", "file_name", "object_key", "file_key"]
    location = tree(tmp_path)
    in_tasks, of_source = (as_text(list_files(spark, location, how), *columns) for how in ("tasks", "source"))
    assert in_tasks == of_source and len(in_tasks) == len({row[0] for row in in_tasks})
    found = {row[0].removeprefix(f"file://{tmp_path}/") for row in in_tasks}
    assert {"deep/1/2/3/4/5/6/7/8/9/d.csv", "deep/1/2/3/4/5/6/7/8/9/_h.csv", "_tmp/.s.csv", "deep/empty.csv", "_k=v.csv"} <= found
    assert not {"_tmp/part.csv", ".x.csv.crc", "c.csv._COPYING_"} & found and len(found) == 40 + 13
    assert as_text(list_files(spark, f"{tmp_path}/a.csv", "tasks"), *columns) == [row for row in in_tasks if row[1] == "a.csv"]


def test_no_listed_name_passes_the_driver(spark, tmp_path):
    location = tree(tmp_path)
    for how, local in (("tasks", False), ("source", True)):
        plan = list_files(spark, location, how)._jdf.queryExecution().optimizedPlan().toString()
        assert ("LocalRelation" in plan or "LogicalRDD" in plan) == local
    listed = list_files(spark, location)
    folders = {file.rsplit("/", 1)[0] for file in listed.inputFiles()}
    # One table per level; the level of the 40 folders is listed by several tasks.
    assert len(folders) == 11
    assert max(sum(file.startswith(f"{folder}/") for file in listed.inputFiles()) for folder in folders) > 8


def test_choice_of_the_listing(spark, tmp_path):
    put(tmp_path, "1/a.csv", VALID)
    put(tmp_path, "2/b.csv", VALID)
    pattern = f"{tmp_path}/[12]"
    assert sorted(r.file_name for r in list_files(spark, pattern).collect()) == ["a.csv", "b.csv"]
    for choice in (_listing_of, lambda name: _listing_of(f"{name}/x")):
        assert [choice(x) for x in ("/in", "file:/in", "s3a://shop/in", "hdfs://h/in", "viewfs://c/in", "/in/2023-*")] == ["tasks"] * 3 + ["source"] * 3
    with pytest.raises(ValueError):
        list_files(spark, str(tmp_path), "guess")
    for how in ("tasks", "source"):
        with pytest.raises(FileNotFoundError):
            list_files(spark, str(tmp_path / "1" / "none" if how == "tasks" else empty(tmp_path)), how)


def empty(tmp_path):
    (tmp_path / "empty").mkdir()
    return tmp_path / "empty"


def test_conform_types_and_values(spark, tmp_path):
    put(tmp_path, "valid.csv", feed(VALID, "1,121,soap,2023-03-03,1,1.5,2,3", "2,121,,2023-03-04 10:00:00,2,100,1,100"))
    fact = conform(spark, check_files(list_files(spark, str(tmp_path))))
    assert [(f.name, f.dataType) for f in fact.schema] == [(f.name, f.dataType) for f in SALES_FACT]
    assert [tuple(r) for r in fact.orderBy("customer_id").collect()] == [
        (1, 121, "soap", datetime.date(2023, 3, 3), 1, Decimal("1.50"), 2, Decimal("3.00"), None),
        (2, 121, None, datetime.date(2023, 3, 4), 2, Decimal("100.00"), 1, Decimal("100.00"), None),
    ]


def test_mixed_and_reordered_headers_keep_their_values(spark, tmp_path):
    plain = [f"1,121,soap,2023-03-{d:02d},1,1,{d},10" for d in range(1, 29)] * 20
    put(tmp_path, "big.csv", feed(VALID, *plain))
    put(tmp_path, "turned.csv", feed(",".join(reversed(VALID.split(","))), "30,3,10,4,2023-04-01,oil,122,2"))
    put(tmp_path, "extra.csv", feed("zone," + VALID + ",payment_mode", "north,3,121,pen,2023-05-01,1,2,1,2,UPI", ",3,121,pen,2023-05-02,1,2,1,2,", ",3,121,pen,2023-05-03,1,2,1,2,cash"))
    checked = check_files(list_files(spark, str(tmp_path)))
    assert len(header_groups(checked)) == 3
    fact = conform(spark, checked)
    assert fact.count() == 20 * 28 + 4
    assert as_text(fact.where("customer_id = 2")) == [("2", "122", "oil", "2023-04-01", "4", "10.00", "3", "30.00", None)]
    assert as_text(fact.where("customer_id = 3"), "additional_column") == [("",), ("cash",), ("north,UPI",)]


def test_rows_with_bad_values_are_set_apart(spark, tmp_path):
    put(
        tmp_path,
        "mixed.csv",
        feed(
            VALID + ",note",
            "1,121,soap,2023-03-03,1,1.5,2,3.0,ok",
            '1,121,soap,2023-03-03,"[1, 2, 3]",1.5,2,3.0,list',
            "x,121,soap,2023-13-03,1,1.5,2.5,3.0,three",
            ",,,,,,,,",
            "1,121,soap,2023-03-03,1.0,1.5,2.0,3,whole",
        ),
    )
    parsed = parse_files(spark, header_groups(check_files(list_files(spark, str(tmp_path)))))
    assert accepted_rows(parsed).count() == 3
    rejected = rejected_rows(parsed)
    assert as_text(rejected, "reason") == [
        ("bad value: customer_id,sales_date,quantity",),
        ("bad value: sales_person_id",),
    ]
    assert as_text(rejected.selectExpr("get_json_object(raw_record, '$.sales_person_id') as p", "get_json_object(raw_record, '$.note') as n")) == [
        ("1", "three"),
        ("[1, 2, 3]", "list"),
    ]
    assert {r.source_file for r in rejected.collect()} == {f"file://{tmp_path}/mixed.csv"}


def test_without_good_files_the_fact_is_empty_and_typed(spark, tmp_path):
    put(tmp_path, "notes.txt", "nothing")
    fact = conform(spark, check_files(list_files(spark, str(tmp_path))))
    assert fact.count() == 0 and fact.schema == SALES_FACT


def test_renamed_headers_are_read(spark, tmp_path):
    put(tmp_path, "odd.csv", feed(VALID + ",zone,Zone,", "1,121,soap,2023-03-03,1,1.5,2,3.0,a,b,c"))
    put(tmp_path, "only.csv", VALID + "\n")
    fact = conform(spark, check_files(list_files(spark, str(tmp_path))))
    assert as_text(fact, "customer_id", "additional_column") == [("1", "a,b,c")]


def test_rejected_files_keep_their_lines(spark, tmp_path):
    checked = check_files(list_files(spark, variants(tmp_path)))
    lines = quarantine_lines(checked)
    assert ("missing.csv", "missing columns: store_id", "1,soap,2023-03-03,[1, 2],1,2,2,UPI") in as_text(lines)
    assert bad_files(checked).count() == 6
    assert quarantine_lines(checked.where("verdict = 'ok'")) is None


def test_a_file_with_another_header_than_checked_stops_the_read(spark, tmp_path):
    put(tmp_path, "a.csv", feed(VALID, "1,121,soap,2023-03-03,1,1.5,2,3.0"))
    groups = header_groups(check_files(list_files(spark, str(tmp_path))))
    put(tmp_path, "a.csv", feed(",".join(reversed(VALID.split(","))), "30,3,10,4,2023-04-01,oil,122,2"))
    with pytest.raises(Exception, match="CSV header does not conform|FAILED_READ_FILE|Header"):
        parse_files(spark, groups).collect()


@pytest.mark.parametrize("how", ["open", "scan"])
def test_both_header_readers_agree(spark, tmp_path, how):
    put(tmp_path, "tab.csv", "\t\n \t \n" + VALID + "\n1,2")
    (tmp_path / "cr.csv").write_bytes((VALID + "\r1,121,soap,2023-03-03,1,1,1,1\r").encode())
    (tmp_path / "crlf.csv").write_bytes(("\r\n" + VALID + "\r\n").encode())
    put(tmp_path, "no_end.csv", VALID)
    put(tmp_path, "bom.csv", "\ufeff" + VALID + "\n")
    put(tmp_path, "long.csv", "é" * (HEADER_CHARACTERS + 1))
    put(tmp_path, "fits.csv", VALID + "," + "é" * (HEADER_CHARACTERS - len(VALID) - 1) + "\n")
    files = list_files(spark, str(tmp_path))
    lines = {r.path.rsplit("/", 1)[1]: r.header_line for r in read_headers(files, how).collect()}
    assert {n: line for n, line in lines.items() if n not in ("long.csv", "fits.csv")} == dict.fromkeys(
        ["tab.csv", "cr.csv", "crlf.csv", "no_end.csv", "bom.csv"], VALID
    )
    assert len(lines["fits.csv"]) == HEADER_CHARACTERS and len(lines["long.csv"]) == HEADER_CHARACTERS + 1
    checked = check_files(files, headers=read_headers(files, how))
    verdict = {r.file_name: (r.verdict, r.reason) for r in checked.collect()}
    assert verdict["long.csv"] == ("error", f"header line over {HEADER_CHARACTERS} characters")
    assert {v for n, (v, _) in verdict.items() if n != "long.csv"} == {"ok"}


def test_rows_that_a_cast_would_change_are_set_apart(spark, tmp_path):
    good = "1,121,soap,2023-03-03,1,1.50,2,3.0"
    put(
        tmp_path,
        "rows.csv",
        feed(
            VALID, good, good + ",surplus", "1,121,soap,2023-03-03,1,1.5,2",
            "1,121,soap,2023-03-03,1,1.555,2,3.0", "1,121,soap,2023,1,1.5,2,3.0", "1,121,soap,2023-03,1,1.5,2,3.0",
        ),
    )
    parsed = parse_files(spark, header_groups(check_files(list_files(spark, str(tmp_path)))))
    assert accepted_rows(parsed).count() == 1
    assert as_text(rejected_rows(parsed), "reason") == [
        ("bad value: price",), ("bad value: sales_date",), ("bad value: sales_date",),
        ("wrong number of cells",), ("wrong number of cells",),
    ]
    torn = rejected_rows(parsed).where("reason like 'wrong%'").selectExpr("get_json_object(raw_record, '$.line') as line")
    assert as_text(torn) == [("1,121,soap,2023-03-03,1,1.5,2",), (good + ",surplus",)]


def test_hidden_names_are_judged(spark, tmp_path):
    for name in ("_x.csv", "day/.y.csv", "seen.csv"):
        put(tmp_path, name, feed(VALID, "1,121,soap,2023-03-03,1,1.5,2,3.0"))
    put(tmp_path, "_SUCCESS", "")
    verdict = {r.file_name: r.reason for r in check_files(list_files(spark, str(tmp_path))).collect()}
    assert verdict == {"_x.csv": "hidden name", ".y.csv": "hidden name", "seen.csv": None}


def test_hidden_names_are_found_however_deep(spark, tmp_path):
    put(tmp_path, "seen.csv", VALID)
    put(tmp_path, "/".join("abcdefghi") + "/_deep.csv", VALID)
    put(tmp_path, "[x]/.y/z/_odd.csv", VALID)
    (tmp_path / "_folder.csv").mkdir()
    verdict = {r.file_name: r.reason for r in check_files(list_files(spark, str(tmp_path))).collect()}
    assert verdict == {"_deep.csv": "hidden name", "_odd.csv": "hidden name", "seen.csv": None}


def test_text_of_a_file_with_a_long_header_is_kept(spark, tmp_path):
    put(tmp_path, "long.csv", "é" * (HEADER_CHARACTERS + 1) + "\n1,2\n")
    put(tmp_path, "_long.csv", "é" * (HEADER_CHARACTERS + 1) + "\n1,2\n")
    lines = quarantine_lines(check_files(list_files(spark, str(tmp_path)))).collect()
    assert {r.file_name for r in lines} == {"long.csv"} and sorted(len(r.line) for r in lines) == [3, HEADER_CHARACTERS + 1]


def test_two_thousand_headers_are_one_scan(spark, tmp_path):
    names = VALID.split(",")
    row = dict(zip(names, "7,121,soap,2023-03-03,1,1.5,2,3.0".split(",")))
    for number in range(2000):
        turned = names[number % 8 :] + names[: number % 8]
        put(tmp_path, f"{number}.csv", feed(",".join([f"extra_{number}", *turned]), ",".join([f"e{number}", *[row[n] for n in turned]])))
    groups = header_groups(check_files(list_files(spark, str(tmp_path))))
    fact = accepted_rows(parse_files(spark, groups))
    plan = fact._jdf.queryExecution().optimizedPlan().toString()
    assert len(groups) == 2000 and plan.count("- Relation [") == 1
    assert fact.count() == 2000 and fact.drop("source_file", "additional_column").distinct().count() == 1
    assert {r.additional_column for r in fact.collect()} == {f"e{n}" for n in range(2000)}


def test_headers_of_very_different_widths(spark, tmp_path):
    row = "1,121,soap,2023-03-03,1,1.5,2,3.0"
    for wide in (0, 8, 9, 300):
        more = "".join(f",x{k}" for k in range(wide))
        put(tmp_path, f"w{wide}.csv", feed(VALID + more, row + "," * wide, row + ",y" * wide, row + ",y" * (wide + 1), row[:-4]))
    parsed = parse_files(spark, header_groups(check_files(list_files(spark, str(tmp_path)))))
    assert accepted_rows(parsed).count() == 8 and rejected_rows(parsed).where("reason = 'wrong number of cells'").count() == 8
    folded = {r.additional_column for r in accepted_rows(parsed).collect()}
    assert folded == {None, "", *[",".join("y" * wide) for wide in (8, 9, 300)]}


def test_quotes_marks_and_odd_characters(spark, tmp_path):
    lines = [
        '1,121,"soap, ""soft""",2023-03-03,1,1.5,2,3.0', '2,121,"",2023-03-03,1,1.5,2,3.0', "3,121,a\x01b,2023-03-03,1,1.5,2,3.0",
        "4,121,\x02tallyframe end\x02,2023-03-03,1,1.5,2,3.0", "5,121,so\"ap,2023-03-03,1,1.5,2,3.0", " 6,121, x ,2023-03-03,1,1.5,2,3.0",
        "7,121,open,2023-03-03,1,1.5,2,\"3.0", VALID,
    ]
    put(tmp_path, "odd.csv", feed(VALID, *lines))
    parsed = parse_files(spark, header_groups(check_files(list_files(spark, str(tmp_path))))).collect()
    names = {r.customer_id: r.product_name for r in parsed if r.fits}
    plain = spark.read.option("header", True).csv(str(tmp_path)).collect()
    assert len(parsed) == len(plain) == 8
    assert names == {int(r.customer_id): r.product_name for r in plain if r.customer_id.strip() in set("123456")}
    assert sorted(r.reason.split(":")[0] for r in parsed if not r.fits) == ["bad value", "wrong number of cells"]


def test_lines_without_quotes_are_cut_and_quoted_ones_parsed_alike(spark, tmp_path):
    cells = ["1", "121", "soap", "2023-03-03", "1", "1.50", "2", "3.00", "UPI", "north"]
    lines = [cells, [*cells[:8], "", ""], [*cells[:8], "UPI", ""], cells[:9], [*cells, ""], ["", *cells[1:]], [" 1 ", *cells[1:]], ["x", *cells[1:]]]
    for name, quote in (("plain", "%s"), ("quoted", '"%s"')):
        text = "\n".join(",".join(quote % c if c else c for c in line) for line in lines)
        put(tmp_path, f"{name}/a b%41.csv", VALID + ",payment_mode,zone\n" + text + "\n")
        put(tmp_path, f"{name}/b.csv", VALID + "\n" + ",".join(quote % c for c in cells[:8]) + "\n")
    held = {}
    for name in ("plain", "quoted"):
        parsed = parse_files(spark, header_groups(check_files(list_files(spark, f"{tmp_path}/{name}"))))
        torn = "wrong number of cells"
        held[name] = as_text(parsed.selectExpr(*SALES_FACT.names, "fits", "reason", f"if(reason = '{torn}', null, raw_record)"))
        assert "split(" in parsed._jdf.queryExecution().optimizedPlan().toString()
    assert held["plain"] == held["quoted"]
    assert len(held["plain"]) == 9
    folded = accepted_rows(parsed).select("additional_column").collect()
    assert sorted((r[0] or "" for r in folded)) == ["", "", "UPI", "UPI,north", "UPI,north", "UPI,north"]
