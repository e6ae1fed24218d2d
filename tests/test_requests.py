import base64
import json
import math

import pandas as pd
import pytest
from msgflow.functions import base64_text
from msgflow.operators import request_batches, request_bodies, score_requests
from msgflow.sources import binary_files
from pyspark.errors import PySparkException
from pyspark.sql import functions as F


def skewed(spark):
    """One group with a third of all rows, one without a name, many small ones; gaps in the order."""
    rows = [("hot", i * i) for i in range(300)] + [(None, i) for i in range(100)]
    rows += [(f"g{i % 40}", i) for i in range(500)]
    return rows, spark.createDataFrame(rows, "source string, position bigint").repartition(7)


def brute_force(rows, size):
    groups = {}
    for source, position in rows:
        groups.setdefault(source, []).append(position)
    return {
        (source, number): sorted(positions)[number * size : (number + 1) * size]
        for source, positions in groups.items()
        for number in range(math.ceil(len(positions) / size))
    }


@pytest.mark.parametrize("size", [1, 3, 7])
def test_batches_against_brute_force(spark, size):
    rows, items = skewed(spark)
    batches = request_batches(
        items, group="source", order="position", size=size, content=F.col("position").cast("string")
    )
    found = batches.select("source", "request_no", "items.position", "items.content").collect()
    assert {(r["source"], r["request_no"]): r["position"] for r in found} == brute_force(rows, size)
    assert all(r["content"] == [str(p) for p in r["position"]] for r in found)


def test_uneven_order(spark):
    """Dense places with far outliers, and many items at one place."""
    rows = [("a", i) for i in range(200)] + [("a", 2**62), ("a", -(2**62)), ("b", 1), ("b", 2**40)]
    rows += [("b", 2**40 + i) for i in range(1, 150)]
    items = spark.createDataFrame(rows, "source string, position bigint").repartition(5)
    batches = request_batches(items, group="source", order="position", size=4, content=F.lit("x"))
    found = batches.select("source", "request_no", "items.position").collect()
    assert {(r[0], r[1]): r[2] for r in found} == brute_force(rows, 4)
    same = spark.range(100).select(F.lit("a").alias("source"), F.lit(5).cast("bigint").alias("position"))
    batches = request_batches(same, group="source", order="position", size=4, content=F.lit("x"))
    assert sorted(r["request_no"] for r in batches.collect()) == list(range(25))


def test_order_must_be_an_integer(spark):
    items = spark.createDataFrame([("a", "1")], "source string, position string")
    with pytest.raises(ValueError, match="position must be an integer column"):
        request_batches(items, group="source", order="position", size=3, content=F.lit("x"))


def test_images_to_bodies(spark, tmp_path):
    images = {f"image{i}.jpg": bytes([i, 255, 0, 10]) * 50 for i in range(4)}
    for name, data in images.items():
        (tmp_path / name).write_bytes(data)
    (tmp_path / "notes.txt").write_text("no image")
    files = binary_files(spark, str(tmp_path), "*.jpg").select(
        F.lit("camera").alias("device"),
        F.regexp_extract("path", r"(\d+)\.jpg$", 1).cast("bigint").alias("n"),
        "content",
    )
    batches = request_batches(files, group="device", order="n", size=3, content=base64_text(F.col("content")))
    bodies = request_bodies(batches, system='Say "on"', prompt="Which\nare on?", domain="Vision", model="m")
    first, second = bodies.orderBy("request_no").collect()
    assert first["body_bytes"] == len(first["body"].encode())
    body = json.loads(first["body"])
    assert list(body) == ["domainName", "modelName", "modelPayload"]
    payload = body["modelPayload"]
    assert (payload["temperature"], payload["top_p"], payload["max_tokens"]) == (0.5, 0.95, 3000)
    assert payload["messages"][0] == {"role": "system", "content": 'Say "on"'}
    user = payload["messages"][1]
    expected = [{"image": base64.b64encode(images[f"image{i}.jpg"]).decode()} for i in range(3)]
    assert user == {"role": "user", "content": [*expected, {"type": "text", "text": "Which\nare on?"}]}
    assert len(json.loads(second["body"])["modelPayload"]["messages"][1]["content"]) == 2


def test_scoring(spark):
    # Defined here so that it is sent to the workers, which do not know this file.
    def refusing(bodies):
        status = bodies.str.len().le(3).map({True: 200, False: 413})
        return pd.DataFrame({"status": status, "response": "answer to " + bodies})

    requests = spark.createDataFrame([(1, "abc"), (2, "abcd")], "n int, body string")
    scored = score_requests(requests, refusing)
    assert sorted(map(tuple, scored.collect())) == [(1, 200, "answer to abc", None), (2, 413, None, "answer to abcd")]
    with pytest.raises(PySparkException, match="1 of 1 scoring requests failed|1 of 2 scoring requests failed"):
        score_requests(requests, refusing, fail_on_error=True).collect()


def test_a_scorer_gets_bounded_bytes(spark):
    def counting(bodies):
        size = int(bodies.str.encode("utf-8").str.len().sum())
        return pd.DataFrame({"status": 200, "response": [f"{len(bodies)},{size}"] * len(bodies)})

    sizes = [500_000] * 20 + [9_000_000, 3, None, 500_000]
    rows = spark.createDataFrame([(i, n) for i, n in enumerate(sizes)], "n int, size int").coalesce(1)
    requests = rows.select("n", F.repeat(F.lit("é"), F.expr("size div 2")).alias("body"), F.current_timestamp().alias("at"))
    scored = score_requests(requests, counting)
    assert scored.columns == ["n", "at", "status", "response", "error"]
    found = scored.orderBy("n").collect()
    assert [r["n"] for r in found] == list(range(len(sizes))) and {r["status"] for r in found} == {200}
    calls = [tuple(map(int, r["response"].split(","))) for r in found]
    assert all(size <= 4_000_000 or n == 1 for n, size in calls)
    assert (1, 9_000_000 // 2 * 2) in calls
