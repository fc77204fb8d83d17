import csv
import os
import random
import time

import pytest

from meridian.sinks import landing
from meridian.sources import bulk_csv, csv_records, raw


def _write(tmp_root, name, text):
    path = tmp_root.replace("file:", "") + "/" + name
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)
    return path


def test_provider_summary_csv(spark, tmp_root):
    p = _write(tmp_root, "src/a.csv", "rndrng_npi,rndrng_prvdr_last_org_name,rndrng_prvdr_state_abrvtn,bene_unique_cnt\n"
               "0123456789,Smith,CA,12\n1234567890,\"Jones, Jr\",TX,7\n")
    m = bulk_csv.bulk_load(spark, p, tmp_root, "cms_phys", "run-1")
    df = raw.read_runs(spark, tmp_root, "cms_phys")
    assert m.row_count == 2
    assert dict(df.dtypes) == {"rndrng_npi": "string", "rndrng_prvdr_last_org_name": "string",
                               "rndrng_prvdr_state_abrvtn": "string", "bene_unique_cnt": "bigint"}
    assert sorted(r.rndrng_npi for r in df.collect()) == ["0123456789", "1234567890"]


def test_drug_and_payment_types(spark, tmp_root):
    p = _write(tmp_root, "src/b.csv", "state,ndc,units_reimbursed,Total_Amount_of_Payment_USDollars,flag,day,paid,dm\n"
               "CA,00000000001,10,12.5,true,2024-01-02,01/15/2024,13/01/2024\n"
               "TX,00000000002,3,1e2,false,2024-02-03,1/5/2024,01/02/2024\n")
    types = bulk_csv.infer_types(bulk_csv.read_csv_text(spark, p))
    assert types == {"state": "string", "ndc": "string", "units_reimbursed": "bigint",
                     "Total_Amount_of_Payment_USDollars": "double", "flag": "boolean", "day": "date",
                     "paid": "date_us", "dm": "string"}
    import datetime

    rows = bulk_csv.read_typed_csv(spark, p).orderBy("state").collect()
    assert [r.paid for r in rows] == [datetime.date(2024, 1, 15), datetime.date(2024, 1, 5)]


def test_late_value_keeps_text(spark, tmp_root):
    rows = "\n".join(str(i) for i in range(1000))
    p = _write(tmp_root, "src/c.csv", f"v\n{rows}\nabc\n")
    assert bulk_csv.infer_types(bulk_csv.read_csv_text(spark, p)) == {"v": "string"}


def test_header_only_is_refused(spark, tmp_root):
    p = _write(tmp_root, "src/d.csv", "a,b\n")
    with pytest.raises(landing.EmptyExtractError):
        bulk_csv.bulk_load(spark, p, tmp_root, "cms_empty", "run-1")
    assert not os.path.exists(tmp_root.replace("file:", "") + "/cms_empty/run-1.parquet")


def test_quoted_line_breaks_are_detected(spark, tmp_root):
    plain = _write(tmp_root, "src/p.csv", 'id,note\n1,"a ""q"" b"\n2,x\n')
    broken = _write(tmp_root, "src/m.csv", 'id,note,n\n1,"x\ny,z,w",2\n3,plain,4\n')
    assert csv_records.records(spark, plain, ",").count() == csv_records.records(spark, broken, ",").count() == 3
    rows = bulk_csv.read_typed_csv(spark, broken).orderBy("id").collect()
    assert [(r.id, r.note, r.n) for r in rows] == [(1, "x\ny,z,w", 2), (3, "plain", 4)]


def test_delimiter_sniffing(spark, tmp_root):
    tab = _write(tmp_root, "src/t.tsv", "npi\tname\tn\n0123456789\tA, B\t5\n")
    semi = _write(tmp_root, "src/s.csv", '"a;b";c\n1;2\n')
    assert bulk_csv.sniff_delimiter(spark, tab) == "\t"
    assert bulk_csv.sniff_delimiter(spark, semi) == ";"
    rows = bulk_csv.read_typed_csv(spark, tab).collect()
    assert [(r.npi, r.name, r.n) for r in rows] == [("0123456789", "A, B", 5)]


def test_ragged_rows_fail_and_are_listed(spark, tmp_path):
    (tmp_path / "r.csv").write_text("a,b\n1,2\n3,4,5\n6\n7,8\n")
    with pytest.raises(Exception, match="malformed CSV record"):
        bulk_csv.read_csv_text(spark, str(tmp_path)).select("b").collect()
    assert sorted(r.record for r in bulk_csv.malformed_rows(spark, str(tmp_path)).collect()) == ["3,4,5", "6"]


def test_inch_marks_do_not_span_lines(spark, tmp_path):
    (tmp_path / "i.csv").write_text('size,name\n5" pipe,"a ""b"" c"\n"x, y",6"\n')
    assert sorted(map(tuple, bulk_csv.read_csv_text(spark, str(tmp_path)).collect())) == [('5" pipe', 'a "b" c'), ("x, y", '6"')]


@pytest.fixture()
def tiny_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "64"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def _random_csv(rng, rows):
    pieces = ["a", "b c", "", '"', '""', ",", "\n", "\n\n", "\r\n", "é", "0", "x" * 70]
    values = [[f"{i}", *("".join(rng.choice(pieces) for _ in range(rng.randrange(6))) for _ in range(2))] for i in range(rows)]
    return values


@pytest.mark.parametrize("seed", range(4))
def test_records_are_cut_the_same_at_any_split(spark, tmp_path, tiny_splits, seed):
    rng = random.Random(seed)
    want = []
    for f in range(3):
        values = _random_csv(rng, 60)
        with open(tmp_path / f"f{f}.csv", "w", newline="") as fh:
            out = csv.writer(fh, quoting=csv.QUOTE_ALL if seed % 2 else csv.QUOTE_MINIMAL, lineterminator="\r\n" if f else "\n")
            out.writerow(["id", "one", "two"])
            out.writerows(values)
        want += values
    lines = spark.read.option("lineSep", "\n").text(str(tmp_path))
    assert lines.rdd.getNumPartitions() > 20
    got = [tuple(x or "" for x in r) for r in bulk_csv.read_csv_text(spark, str(tmp_path), sep=",").collect()]
    assert sorted(got) == sorted(map(tuple, want))


def test_values_that_span_many_splits_or_never_close(spark, tmp_path, tiny_splits):
    long = "line\n" * 200
    (tmp_path / "a.csv").write_text(f'id,v\n1,"{long}"\n\n2,b\n3,"""{long}"""\n')
    (tmp_path / "b.csv").write_text("id,v\n4,d\n")
    got = {r.id: r.v for r in bulk_csv.read_csv_text(spark, str(tmp_path)).collect()}
    assert got == {"1": long, "2": "b", "3": f'"{long}"', "4": "d"}
    (tmp_path / "b.csv").write_text('id,v\n4,"never closed\n5,e\n' + "6,f\n" * 30)
    records = {r.record for r in csv_records.records(spark, str(tmp_path), ",").collect()}
    assert '4,"never closed\n5,e\n' + "\n".join(["6,f"] * 30) in records and "2,b" in records


def test_wide_tables_are_inferred_in_one_narrow_pass(spark, tmp_path):
    kinds = ["7", "1.5", "true", "2024-01-02", "1/5/2024", "2024-01-02 03:04:05", "text", "", "007"]
    types = ["bigint", "double", "boolean", "date", "date_us", "timestamp", "string", "string", "string"]
    header = ",".join(f"c{i}" for i in range(91))
    (tmp_path / "w.csv").write_text(header + "\n" + (",".join(kinds[i % 9] for i in range(91)) + "\n") * 200)
    raw = bulk_csv.read_csv_text(spark, str(tmp_path))
    assert bulk_csv.infer_types(raw) == {f"c{i}": types[i % 9] for i in range(91)}
    start = time.perf_counter()
    assert bulk_csv.read_typed_csv(spark, str(tmp_path)).count() == 200
    assert time.perf_counter() - start < 5


def test_header_names_of_any_kind(spark, tmp_path):
    (tmp_path / "h.csv").write_text('"a.b","x`y","sp ace",a\n1,2,3,4\n')
    row = bulk_csv.read_typed_csv(spark, str(tmp_path)).first()
    assert row.asDict() == {"a.b": 1, "x`y": 2, "sp ace": 3, "a": 4}
