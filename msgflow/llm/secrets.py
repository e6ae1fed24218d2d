"""Secret scans on DataFrame functions: pattern spans, and ownership frequency over the whole corpus.

Candidates are found by patterns. What tells a live credential from an example is who has it: an example is copied into
many repositories of many owners, a live credential stays with its owner, in a few repositories. So the hashes of all candidate values
are counted by distinct repositories and owners over the corpus, and a value that many owners have, or that lies in very many
repositories of few owners, is a widely copied example.

Within a text all work is linear in its findings: positions and overlaps come from scans of arrays, see ``exclusive_scan``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import Tables, unused, without

# The base patterns of the contract. ``hex`` and ``access`` ask for the least length in the pattern, where that
# gives the same spans as matching any length and dropping the short ones; ``assign`` must match first and drop then.
ASSIGN = r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
ASSIGN_VALUE = r"""(?i)^(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: Added by the method: long runs that hold capitals, small letters and digits, as generated keys do.
MIXED = r"[A-Za-z0-9+/_-]{20,}"
KINDS = ("assign", "access", "hex", "mixed")
LEAST_VALUE = 6
#: A value that at least so many owners have, or that lies in so many repositories, is a widely copied example.
EXAMPLE_OWNERS = 3
EXAMPLE_REPOSITORIES = 100
#: Elements that a scan adds to an array one by one, and code points that are looked through for a place in a text.
_CHUNK, _TEXT_CHUNK = 64, 4096


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def exclusive_scan(values: Column, merge: Callable[[Column, Column], Column], zero: Column, levels: int = 2) -> Column:
    """For each element of an array<bigint> the fold of all elements before it, by an associative function.

    A step that adds to an array copies it, so only short arrays are built that way: the array is cut into chunks, the
    chunks' own folds are scanned by the level above, and each chunk goes on from there.
    """
    if not levels:
        return _scan_from(values, merge, zero)

    def scan(v: Column) -> Column:
        begins = F.when(F.size(v) > 0, F.sequence(F.lit(0), F.size(v) - 1, F.lit(_CHUNK))).otherwise(F.array().cast("array<int>"))
        chunks = F.transform(begins, lambda i: F.slice(v, i + 1, F.lit(_CHUNK)))
        return _let(chunks, joined)

    def joined(chunks: Column) -> Column:
        firsts = exclusive_scan(F.transform(chunks, lambda c: F.aggregate(c, zero, merge)), merge, zero, levels - 1)
        return F.flatten(F.zip_with(chunks, firsts, lambda c, first: _scan_from(c, merge, first)))

    return _let(values, scan)


def _scan_from(values: Column, merge: Callable[[Column, Column], Column], first: Column) -> Column:
    begin = F.struct(first.alias("at"), F.array().cast("array<bigint>").alias("out"))

    def step(done: Column, value: Column) -> Column:
        return F.struct(merge(done["at"], value).alias("at"), F.concat(done["out"], F.array(done["at"])).alias("out"))

    return F.aggregate(values, begin, step, lambda done: done["out"])


def _sum(a: Column, b: Column) -> Column:
    return a + b


def _most(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def spans(text: Column, pattern: str) -> Column:
    """array<struct<start, end, found>> of the leftmost non-overlapping matches; positions in code points, end exclusive.

    The text is split by the pattern: the lengths of the parts between and of the matches add up to the positions. Only
    texts that match at all are split. The pattern must not match the empty text.
    """
    nothing = F.array().cast("array<struct<start:int,end:int,found:string>>")
    pieces = F.filter(
        F.zip_with(
            F.split(text, pattern, -1),
            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
            lambda part, found: F.struct(F.length(part).cast("bigint").alias("part"), found.alias("found")),
        ),
        lambda piece: piece["found"].isNotNull(),
    )

    def placed(pieces: Column) -> Column:
        lengths = F.transform(pieces, lambda piece: piece["part"] + F.length(piece["found"]))
        return F.zip_with(pieces, exclusive_scan(lengths, _sum, F.lit(0).cast("bigint")), one)

    def one(piece: Column, before: Column) -> Column:
        start = (before + piece["part"]).cast("int")
        return F.struct(start.alias("start"), (start + F.length(piece["found"])).alias("end"), piece["found"].alias("found"))

    return F.when(text.rlike(pattern), _let(pieces, placed)).otherwise(nothing)


def _apart(mixed: Column, base: Column) -> Column:
    """The spans of ``mixed`` that share no character with one of ``base``.

    Both are put into one order, base spans by their start and the others by their end; a span is apart if all base spans before
    its end have ended by its start.
    """
    nobody = F.lit(-1).cast("bigint")

    def event(key: Column, is_base: int, span: Column) -> Column:
        reach = span["end"].cast("bigint") if is_base else nobody
        return F.struct(key.alias("key"), F.lit(is_base).alias("is_base"), reach.alias("reach"), span.alias("span"))

    events = F.sort_array(
        F.concat(F.transform(base, lambda b: event(b["start"], 1, b)), F.transform(mixed, lambda m: event(m["end"], 0, m)))
    )

    def kept(events: Column) -> Column:
        before = exclusive_scan(F.transform(events, lambda e: e["reach"]), _most, nobody)
        free = F.zip_with(
            events, before, lambda e, reach: F.when((e["is_base"] == 0) & (reach <= e["span"]["start"]), e["span"])
        )
        return F.filter(free, lambda span: span.isNotNull())

    return F.when((F.size(mixed) > 0) & (F.size(base) > 0), _let(events, kept)).otherwise(mixed)


def _finding(kind: str, value: Column, span: Column) -> Column:
    return F.struct(
        span["start"].alias("start"),
        F.lit(KINDS.index(kind)).alias("rank"),
        span["end"].alias("end"),
        F.lit(kind).alias("kind"),
        F.sha2(value, 256).alias("value_sha256"),
    )


def with_candidates(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with ``found``: all candidates by start, then kind.

    ``mixed`` runs that share characters with a base candidate are left out. A null text has none.
    """
    whole = F.col(text)
    value = lambda s: F.regexp_extract(s["found"], ASSIGN_VALUE, 1)
    assign = F.filter(spans(whole, ASSIGN), lambda s: F.length(value(s)) >= LEAST_VALUE)
    base = F.concat(
        F.transform(assign, lambda s: _finding("assign", value(s), s)),
        F.transform(spans(whole, ACCESS), lambda s: _finding("access", s["found"], s)),
        F.transform(spans(whole, HEX), lambda s: _finding("hex", s["found"], s)),
    )
    classes = ("[A-Z]", "[a-z]", "[0-9]")
    mixed = F.transform(
        F.filter(spans(whole, MIXED), lambda s: reduce(Column.__and__, [s["found"].rlike(c) for c in classes])),
        lambda s: _finding("mixed", s["found"], s),
    )
    # (the caller passes columns of its own only, so these names are free)
    rows = docs.withColumns({"_base": base, "_mixed": mixed})
    apart = _apart(F.col("_mixed"), F.col("_base"))
    return rows.withColumn("found", F.sort_array(F.concat("_base", apart))).drop("_base", "_mixed")


def ownership(candidates: DataFrame) -> DataFrame:
    """(value, owners, repositories) from (value, owner, repository): distinct owners, and distinct repositories of each.

    A repository is named within its owner. Nulls count as an owner or repository of their own. The counts are taken in
    three aggregations that all combine before they shuffle, so a value that is everywhere is no hot group.
    """
    repositories = candidates.select("value", "owner", "repository").distinct()
    owners = repositories.groupBy("value", "owner").agg(F.count("*").alias("n"))
    return owners.groupBy("value").agg(F.count("*").alias("owners"), F.sum("n").alias("repositories"))


def find_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    repository_col: str = "doc_id",
    owner_col: str = "source",
    example_owners: int = EXAMPLE_OWNERS,
    example_repositories: int = EXAMPLE_REPOSITORIES,
) -> DataFrame:
    """``docs`` with ``findings``, labelled by who has the same value anywhere in the corpus.

    ``findings`` is array<struct<start, rank, end, kind, owners, repositories, live>> by start, then kind; positions in code
    points, end exclusive. ``owners`` and ``repositories`` count distinct owners and repositories with the finding's
    value; ``live`` is true where fewer than ``example_owners`` owners have it and it lies in fewer than ``example_repositories``
    repositories. Null owners are one owner, null repositories one repository of each owner. A null or empty text has an empty array. A text of
    any length is scanned whole, in time that is linear in its length and findings. A column named ``findings`` is replaced; rows that
    repeat are labelled alike; an empty table gives an empty result.
    """
    tables = Tables(docs.sparkSession, "secrets")
    narrow = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(text).alias("h"),
        F.col(repository_col).cast("string").alias("repository"),
        F.col(owner_col).cast("string").alias("owner"),
        F.col(text).alias("text"),
    )
    rows = tables.store(with_candidates(narrow, "text").drop("text").where(F.size("found") > 0))
    each = rows.select("*", F.explode("found").alias("c")).select("*", F.col("c.value_sha256").alias("value"))
    counts = tables.store(ownership(each))
    finding = F.struct(
        *[F.col(f"c.{name}") for name in ("start", "rank", "end", "kind")],
        "owners",
        "repositories",
        ((F.col("owners") < example_owners) & (F.col("repositories") < example_repositories)).alias("live"),
    )
    rows_ = without(docs, ["findings"])
    id_, h_ = unused(rows_, "_id", "_h")
    labelled = (
        each.join(counts, "value")
        .groupBy(F.col("id").alias(id_), F.col("h").alias(h_))
        .agg(F.array_sort(F.collect_set(finding)).alias("findings"))
    )
    labelled = tables.store(labelled)
    tables.drop(rows, counts)
    same = F.col(id_col).eqNullSafe(F.col(id_)) & (F.xxhash64(text) == F.col(h_))
    joined = rows_.join(labelled, same, "left").drop(id_, h_)
    return joined.withColumn("findings", F.coalesce("findings", F.array().cast(joined.schema["findings"].dataType)))


def redacted(text: Column, spans_: Column, mark: str = "[secret]") -> Column:
    """``text`` with each of the given spans (by start; they may overlap) replaced by ``mark``.

    The text is cut into chunks once, so the place of a span is looked for in a chunk, not in the whole text.
    """

    def clean(chunks: Column, s: Column) -> Column:
        ends = F.transform(s, lambda one: one["end"].cast("bigint"))
        before = exclusive_scan(ends, _most, F.lit(0).cast("bigint"))
        parts = F.zip_with(
            s,
            before,
            lambda one, at: F.when(one["start"] < at, "").otherwise(F.concat(_between(chunks, at, one["start"]), F.lit(mark))),
        )
        return F.concat(F.array_join(parts, ""), _between(chunks, F.array_max(ends), F.length(text)))

    chunks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_TEXT_CHUNK}}}"), F.lit(0))
    whole = _let(F.struct(chunks.alias("chunks"), spans_.alias("spans")), lambda both: clean(both["chunks"], both["spans"]))
    return F.when(F.size(spans_) > 0, whole).otherwise(text)


def _between(chunks: Column, begin: Column, end: Column) -> Column:
    """The code points from ``begin`` to ``end`` of a text in chunks."""
    first, last = F.floor(begin / _TEXT_CHUNK).cast("int"), F.floor((end - 1) / _TEXT_CHUNK).cast("int")

    def piece(i: Column) -> Column:
        at = F.greatest(begin - i * _TEXT_CHUNK, F.lit(0)).cast("int")
        return F.substring(chunks[i], at + 1, (F.least(end - i * _TEXT_CHUNK, F.lit(_TEXT_CHUNK)) - at).cast("int"))

    return F.when(end > begin, F.array_join(F.transform(F.sequence(first, last), piece), "")).otherwise("")


def span_text(findings: Column) -> Column:
    """``kind:start:end`` of findings, comma-joined."""
    one = lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))
    return F.array_join(F.transform(findings, one), ",")
