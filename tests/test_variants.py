"""Payloads as variants: what is kept, types that change, and filters that reach the files."""

import contextlib
import glob
import io

import pyarrow.parquet as pq
from msgflow.operators import PRODUCT
from msgflow.streaming import OutputLog, VariantBatches, read_batches, variant_field, variant_fields, variant_rows


def test_every_message_is_kept(wide):
    texts = ['{"a":1}', "[1,2]", "7", "bad", "", None, '{"a":1,"a":2}', "{}", "null"]
    rows = variant_rows(wide(*texts), keep=["kafka_offset"])
    found = rows.select("kafka_offset", "_corrupt_record", rows.payload.isNull().alias("none")).orderBy("kafka_offset").collect()
    assert [(r[1], r[2]) for r in found] == [
        (None, False), (None, False), (None, False), ("bad", True), ("", True), (None, True), (None, False), (None, False), (None, False),
    ]
    assert [r[0] for r in rows.orderBy("kafka_offset").select(variant_field("a", "int")).collect()] == [1, *[None] * 5, 2, None, None]


def test_a_type_that_changes_needs_no_new_version(spark, wide, tmp_path):
    path, counts = str(tmp_path / "data"), []
    log = OutputLog(str(tmp_path / "log"))
    write = VariantBatches(path, keep=["kafka_offset"], log=log, report=lambda n, c: counts.append(dict(c)))
    for number, text in enumerate(['{"n":9007199254740993}', '{"n":2.5}', '{"n":"x","m":{"k":[1]}}', "bad"]):
        write(wide(text), number)
        write(wide(text), number)  # each batch runs twice
    rows = log.read(spark, path)
    assert rows.count() == 4 and counts[-1] == {"seen": 1, "kept": 0, "rejected": 1}
    assert {r[0] for r in rows.select(variant_field("n")).collect()} == {"9007199254740993", "2.5", "x", None}
    assert {r[0] for r in rows.select(variant_field("n", "bigint")).collect()} == {9007199254740993, 2, None}
    assert {r[0] for r in rows.select(variant_field("m.k", "array<int>").cast("string")).collect()} == {"[1]", None}


def test_filters_on_shredded_fields_reach_the_files(spark, wide, tmp_path):
    path = str(tmp_path / "data")
    for number in range(2):
        texts = [f'{{"id":{i},"product":"p{i}","price":{i}.5,"in_stock":true}}' for i in range(number * 500, number * 500 + 500)]
        VariantBatches(path, keep=["kafka_offset"])(wide(*texts), number)
    file = glob.glob(f"{path}/**/*.parquet", recursive=True)[0]
    columns = {c.path for c in pq.ParquetFile(file).schema}
    assert "payload.typed_value.id.typed_value" in columns
    rows = read_batches(spark, path)
    few = variant_fields(rows, PRODUCT, keep=[]).where("id = 700")
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        few.explain("formatted")
    assert "7" in text.getvalue().split("PushedFilters")[1].splitlines()[0]
    assert [tuple(r) for r in few.collect()] == [(700, "p700", 700.5, True)]
