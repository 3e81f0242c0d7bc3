"""Files landed as text, read by header name, with what does not fit kept."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.schemas import FEED_SCHEMAS, FEEDS
from ledgerline.sinks import bronze as B
from ledgerline.sinks.writers import IncompleteBatchError
from ledgerline.sources import delivered as D

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("amount", T.DoubleType()),
                       T.StructField("name", T.StringType())])


def put(path, data):
    path = path.replace("file:", "")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data.encode() if isinstance(data, str) else data)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def failed():
    return F.transform(D.FAILED, lambda x: F.concat(x["field"], F.lit("="), x["value"])).alias("failed")


def test_values_that_do_not_fit_are_listed_and_kept(spark, scratch):
    put(scratch + "/a.csv", "id,amount,name\n1,2.5,x\n12x,3,y\n7,n/a,\n8.5,oops,z\n,,\n 9 , 1e3 ,w\n")
    got = D.rescue(D.read_lines(spark, scratch), SCHEMA)
    assert rows(got, "id", "amount", "name", failed()) == sorted([
        (1, 2.5, "x", []), (None, 3.0, "y", ["id=12x"]), (7, None, None, ["amount=n/a"]),
        (None, None, "z", ["id=8.5", "amount=oops"]), (None, None, None, []),
        (9, 1000.0, "w", [])], key=str)
    assert D.sound(got).count() == 3 and D.quarantine(got).count() == 3


def test_columns_are_read_by_name_in_any_order_and_width(spark, scratch):
    put(scratch + "/a.csv", "id,amount,name\n1,1.0,a\n")
    put(scratch + "/b.csv", "name,id,amount\nb,2,2.0\nname,id,amount\nc,3,3.0\n")     # header repeated
    put(scratch + "/c.csv", 'extra,"name",amount,id\r\ne,"d,d",4.0,4\r\ne,f,5.0\r\n')  # wider, CRLF, short line
    put(scratch + "/d.csv", "id,sum,name\n9,9.0,z\n")                               # a column is missing
    got = D.rescue(D.read_lines(spark, scratch), SCHEMA)
    assert rows(D.sound(got), "id", "amount", "name") == [
        (1, 1.0, "a"), (2, 2.0, "b"), (3, 3.0, "c"), (4, 4.0, "d,d")]
    assert rows(got.where(D.WHOLE + " is not null"), D.WHOLE) == [
        ("9,9.0,z",), ("e,f,5.0\r",), ("id,sum,name",)]


def test_too_many_fields_and_no_rows(spark, scratch):
    put(scratch + "/a.csv", "id,amount,name\n1,1.0,a,b\n\n")
    got = D.rescue(D.read_lines(spark, scratch), SCHEMA)
    assert rows(got, "id", D.WHOLE) == [(None, "1,1.0,a,b")]
    put(scratch + "-empty/a.csv", "")
    got = D.rescue(D.read_lines(spark, scratch + "-empty"), SCHEMA)
    assert got.count() == 0 and got.columns[:3] == ["id", "amount", "name"]


def _deliver(root, step, n=3, **texts):
    for feed in FEEDS:
        names = FEED_SCHEMAS[feed].fieldNames()
        cell = {"transaction_id": "T{i}", "step": str(step), "type": "PAY", "origin_account_id": "C1",
                "dest_account_id": "M1", "isFraud": "0", "isFlaggedFraud": "1"}
        lines = [",".join(names)] + [",".join(cell.get(c, "1.5").format(i=i) for c in names)
                                     for i in range(n)]
        put(f"{root}/{feed}/step={step}/part.csv", texts.get(feed, "\n".join(lines) + "\n"))


def test_landing_keeps_the_text_of_every_file(spark, scratch):
    src, dst = scratch + "/src", scratch + "/dst"
    odd = 'isFraud,transaction_id,isFlaggedFraud\n"1",T0,0\n\n0,é,yes\r\n1,"a ""q""",0'   # no last break
    _deliver(src, 1)
    _deliver(src, 2, fraud=odd)
    plans = B.land_files(spark, src, dst, load_id="L1")
    assert plans == {"transactions": 8, "accounts": 8, "fraud": 9}
    lines = B.landed_lines(spark, dst, "fraud")
    assert {r["_load"] for r in lines.select("_load").distinct().collect()} == {"L1"}
    sums = {r[D.FILE].rsplit("/", 2)[1]: r for r in D.file_sums(lines).collect()}
    assert all(r["whole"] for r in sums.values())
    found = lines.where("step = 2").orderBy(D.BLOCK, D.POS).collect()
    text = "\n".join(r["line"] for r in found)
    assert text == odd and sums["step=2"]["file_size"] == len(odd.encode())
    bad = B.malformed_values(B.rescued_feed(spark, dst, "fraud"), ["transaction_id", "step"])
    assert rows(bad, "transaction_id", "step", "field", "value") == [("é", 2, "isFlaggedFraud", "yes")]
    assert B.typed_feed(spark, dst, "fraud").count() == 5
    assert B.typed_feed(spark, dst, "transactions").dtypes == [
        (f.name, f.dataType.simpleString()) for f in FEED_SCHEMAS["transactions"].fields]


def test_landing_is_all_or_error_and_replaces_a_step(spark, scratch):
    src, dst = scratch + "/src", scratch + "/dst"
    _deliver(src, 1)
    _deliver(src, 2)
    os.remove(f"{src}/fraud/step=2/part.csv".replace("file:", ""))
    with pytest.raises(IncompleteBatchError):
        B.land_files(spark, src, dst)
    assert not os.path.exists(dst.replace("file:", ""))
    assert B.land_files(spark, src, dst, [1])["fraud"] == 4
    _deliver(src, 1, n=7)
    B.land_files(spark, src, dst, [1], load_id="again")
    got = B.landed_lines(spark, dst, "fraud")
    assert got.count() == 8 and got.where("_load = 'again'").count() == 8


def test_landing_plan_has_no_exchange(spark, scratch):
    _deliver(scratch, 1)
    lines = D.read_lines(spark, f"{scratch}/fraud/step=1", base=f"{scratch}/fraud")
    assert "Exchange" not in lines._jdf.queryExecution().executedPlan().toString()


def test_line_index_counts_over_files(spark, scratch):
    """The number of each row over several files of unequal size, whatever the splits."""
    want, at = [], 0
    for k, n in enumerate([5, 4000, 1, 0, 777]):
        put(f"{scratch}/in/f{k}.csv", "".join(f"row{at + i},{'x' * (i % 50)}\n" for i in range(n)))
        want += [f"row{at + i}" for i in range(n)]
        at += n
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        D.read_lines(spark, scratch + "/in").write.parquet(scratch + "/stored")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    stored = spark.read.parquet(scratch + "/stored")
    assert stored.select(D.BLOCK).distinct().count() > 3
    got = D.with_line_index(stored).orderBy("line_index").collect()
    assert [r["line_index"] for r in got] == list(range(at))
    assert [r["line"].split(",")[0] for r in got] == want
    some = D.with_line_index(stored.where(~F.col("line").contains("xx"))).orderBy("line_index").collect()
    assert [r["line_index"] for r in some] == list(range(len(some)))
    kept = {r["line"].split(",")[0] for r in some}
    assert [r["line"].split(",")[0] for r in some] == [w for w in want if w in kept]
