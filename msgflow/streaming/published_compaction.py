"""Small published files into larger ones, in place: only small files are read, and one log entry swaps them."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.compaction import TARGET_BYTES, packing_session
from .published import Attempt, OutputLog

#: The run that replaced files count to; a file that is this share of the target or more is left alone.
REPLACED = "replaced"
FULL_SHARE = 0.75


class Compaction(NamedTuple):
    """What a run has done; ``version`` is None if nothing was swapped."""

    version: int | None
    files_read: int
    bytes_read: int
    files_written: int


def bins(files: Sequence[tuple[str, int, bool]], target_bytes: int) -> list[list[str]]:
    """Paths to be merged, a list for each new file, from (path, bytes, whether it is the product of a merge).

    The largest file goes first, into the first bin that has room. A bin is worth a merge if it fills a file, or holds two files that have not
    been merged before; so a second run finds nothing to do.
    """
    out: list[tuple[int, list[tuple[str, int, bool]]]] = []
    for file in sorted(files, key=lambda f: (-f[1], f[0])):
        if file[1] >= FULL_SHARE * target_bytes:
            continue
        for i, (size, held) in enumerate(out):
            if size + file[1] <= target_bytes:
                out[i] = size + file[1], [*held, file]
                break
        else:
            out.append((file[1], [file]))
    worth = [
        held
        for size, held in out
        if len(held) > 1 and (size >= FULL_SHARE * target_bytes or sum(not merged for _, _, merged in held) > 1)
    ]
    return [[path for path, _, _ in held] for held in worth]


def _candidates(files: DataFrame, side: str) -> DataFrame:
    """(path, bytes, merged, folder): files that no batch can still replace, with the folder whose files have one schema.

    The last batch of a run may run again, so it is left alone.
    """
    mine = files.where(F.col("side") == side)
    last = mine.where(F.col("run") != REPLACED).groupBy("run").agg(F.max("batch_id").alias("last"))
    folder = F.regexp_extract("path", "^(.*?)/run=[^/]*/batch_id=", 1)
    settled = mine.join(last, "run", "left").where("last is null or batch_id < last")
    return settled.select("path", "bytes", (F.col("run") == REPLACED).alias("merged"), folder.alias("folder"))


def compact_published(spark: SparkSession, log: OutputLog, side: str, *, target_bytes: int = TARGET_BYTES) -> Compaction:
    """Merges the small files of a side into files of about ``target_bytes``; readers see each row once, before, during and after.

    The files stay on disk for readers of earlier versions, until ``OutputLog.remove_unseen``. If a batch runs again meanwhile, the merge is given up.
    A task reads and writes one new file. File names and sizes come to the driver, as in any file index; rows do not.
    """
    side = side.rstrip("/")
    base = log.latest(spark)
    if base < 0:
        return Compaction(None, 0, 0, 0)
    found = _candidates(log.files(spark, base), side).collect()
    attempt = Attempt(spark, log, REPLACED, base)
    read: list[str] = []
    for folder in sorted({row["folder"] for row in found}):
        paths = [p for b in bins([(r["path"], r["bytes"], r["merged"]) for r in found if r["folder"] == folder], target_bytes) for p in b]
        if paths:
            session = packing_session(spark, target_bytes)
            # Fields may have been added from file to file, so the schema is that of all of them.
            rows = session.read.option("recursiveFileLookup", "true").option("mergeSchema", "true").parquet(*paths)
            attempt.name = uuid.uuid4().hex
            attempt.write(rows, side, folder)
            read += paths
    if not read:
        return Compaction(None, 0, 0, 0)
    sizes = {row["path"]: row["bytes"] for row in found}
    written = len(attempt.files)
    version = log.replace(spark, base, attempt.files, read)
    if version is None:
        attempt.give_up()
    return Compaction(version, len(read), sum(sizes[path] for path in read), written)
