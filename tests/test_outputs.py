"""Output verification, retention over folders, schema drift, JSON lines read once."""

import hashlib
import os

from pyspark.sql import functions as F

from ledgerline.operators import drift, verify
from ledgerline.operators.profile import profile_json_frame
from ledgerline.sinks import steps
from ledgerline.sources import delivered as D
from ledgerline.sources.files import read_any
from ledgerline.sources.json_lines import inferred, read_json_lines


def put(path, data):
    path = path.replace("file:", "")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(data)


def digest(*lines):
    return str(sum(int(hashlib.md5(x.encode()).hexdigest()[:15], 16) for x in lines))


def test_report_on_an_output(spark, scratch):
    put(scratch + "/a.csv", "x,y\n1,é\n2,b\n")
    put(scratch + "/b.csv", "x,y\n3,c")          # no last break
    put(scratch + "/_SUCCESS", "")
    r = verify.verify_output(spark, scratch).first()
    assert (r["files"], r["rows"], r["data_bytes"], r["digest"], r["header"], r["ok"]) == (
        2, 3, 13, digest("1,é", "2,b", "3,c"), "x,y", True)
    assert r["preview"] == ["x,y", "1,é", "2,b"]
    # the same rows in other files and another order have the same digest
    put(scratch + "-2/z.csv", "x,y\n3,c\n2,b\n1,é\n")
    s = verify.verify_output(spark, scratch + "-2").first()
    assert (s["rows"], s["data_bytes"], s["digest"]) == (r["rows"], r["data_bytes"], r["digest"])
    put(scratch + "-2/y.csv", "x,z\n3,c\n")
    assert not verify.verify_output(spark, scratch + "-2").first()["ok"]
    per_file = {f["file"].rsplit("/", 1)[1]: f for f in verify.output_files(spark, scratch).collect()}
    assert (per_file["a.csv"]["lines"], per_file["b.csv"]["data_bytes"], per_file["b.csv"]["file_size"]) == (2, 4, 7)


def test_an_output_without_rows_is_not_ok(spark, scratch):
    put(scratch + "/a.csv", "x,y\n")
    r = verify.verify_output(spark, scratch).first()
    assert (r["files"], r["rows"], r["data_bytes"], r["digest"], r["ok"]) == (1, 0, 0, "0", False)
    put(scratch + "-e/a.csv", "")
    r = verify.verify_output(spark, scratch + "-e").first()
    assert (r["files"], r["rows"], r["ok"], r["preview"]) == (0, 0, False, [])
    j = scratch + "-j"
    put(j + "/a.json", '{"a":1}\n{"a":2}\n')
    assert verify.verify_output(spark, j, "json").first()["rows"] == 2


def test_expired_folders_go_as_a_whole(spark, scratch):
    # step s is the hour from 2025-01-01 00:00 + s h; the cut is 2025-01-02 00:00
    df = spark.createDataFrame([(f"t{s}", s) for s in (1, 22, 23, 24, 30)], "transaction_id string, step int")
    path = scratch + "/silver"
    steps.replace_steps(df, path, [1, 22, 23, 24, 30])
    plan = {r["step"]: r for r in verify.step_folders(spark, scratch, "2025-01-09 00:00:00").collect()}
    assert {s: r["expired"] for s, r in plan.items()} == {1: True, 22: True, 23: True, 24: False, 30: False}
    assert all(r["table"] == "silver" and r["files"] >= 1 and r["bytes"] > 0 for r in plan.values())
    late = {r["step"]: r["expired"] for r in verify.step_folders(spark, scratch, "2025-01-08 23:59:59").collect()}
    assert not late[23] and late[22]      # the last second of step 23 is not older than the cut
    assert verify.expire_steps(spark, path, "2025-01-09 00:00:00") == [1, 22, 23]
    assert sorted(r["step"] for r in steps.read_steps(spark, path).collect()) == [24, 30]
    assert verify.expire_steps(spark, path, "2025-01-09 00:00:00") == []


def test_types_join_over_values_and_files(spark, scratch):
    put(scratch + "/a.csv", 'id,v,w,d,t,b,n,s\n1,1,3000000000,2024-01-01,2024-01-01 10:00:00,true,,x\n2,2,,,,,,\n')
    put(scratch + "/b.csv", 'v,id,d,w\n1.5,7,2024-02-30,5\n-2e3,8,2024-01-01,6\n1,2\n')
    put(scratch + "/c.csv", 'id,v,d\r\n3,4,2024-01-01 00:00\r\n')
    per_file = drift.file_columns(D.read_lines(spark, scratch))
    types = {(r["file"].rsplit("/", 1)[1][0], r["column"]): r["type"] for r in per_file.collect()}
    assert types["a", "n"] == "void" and types["a", "b"] == "boolean" and types["a", "t"] == "timestamp"
    got = {r["column"]: tuple(r)[1:] for r in drift.schema_drift(per_file).collect()}
    assert got == {
        "id": ("int", "int", 3, 5, 5), "v": ("double", "double,int", 3, 5, 5),
        "w": ("bigint", "bigint,int", 2, 3, 4), "d": ("string", "date,string,timestamp", 3, 4, 5),
        "t": ("timestamp", "timestamp", 1, 1, 2), "b": ("boolean", "boolean", 1, 1, 2),
        "n": ("void", "void", 1, 0, 2), "s": ("string", "string", 1, 1, 2)}


def test_drift_of_nothing(spark, scratch):
    put(scratch + "/a.csv", "")
    assert drift.schema_drift(drift.file_columns(D.read_lines(spark, scratch))).collect() == []


def test_json_lines_are_read_once_with_the_inferred_schema(spark, scratch):
    put(scratch + "/a.json", '{"a":1,"b":2.5,"c":"x","it\'s":null}\n{"a":99999999999,"b":3,"o":{"k":[1,2]}}\n')
    put(scratch + "/b.json", '{"a":null,"m":1}\n{"m":"text","z z":true}\n\n')
    want = read_any(spark, scratch, "json")
    got = read_json_lines(spark, scratch)
    assert sorted(got.rows.dtypes) == sorted(want.dtypes) and got.n_rows == 4 and got.n_bad == 0
    cols = sorted(want.columns)
    sel = [F.col(f"`{c}`") for c in cols]
    assert sorted(map(str, got.rows.select(*sel).collect())) == sorted(map(str, want.select(*sel).collect()))
    assert profile_json_frame(got.rows).where("record_count = 4").count() == 4


def test_lines_that_are_no_object_are_kept(spark, scratch):
    put(scratch + "/a.json", '{"a":1}\n{"a":2\n[1]\n"text"\n\n{"a":3}\n')
    got = read_json_lines(spark, scratch)
    assert (got.n_rows, got.n_bad) == (2, 3)
    assert sorted(r["line"] for r in got.bad.collect()) == ['"text"', '[1]', '{"a":2']
    assert sorted(r["a"] for r in got.rows.collect()) == [1, 3]
    put(scratch + "-e/a.json", "")
    none = read_json_lines(spark, scratch + "-e")
    assert none.rows.count() == 0 and none.rows.columns == [] and inferred(None).fields == []
