"""Rows that every operator has to bear, next to the given documents."""

from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"

ROWS = [
    (None, "an id that is null, with a text of some words to go on", "en", "s1", 54),
    (None, None, None, None, None),
    (9_000_001, None, "en", "s1", None),
    (9_000_002, "", "en", "s1", 0),
    (9_000_003, "", None, None, 0),
    (9_000_004, " \t\n ", "fr", "s2", 4),
    (9_000_005, "one", "en", "s2", 3),
    (9_000_006, "naïve ÉCOLE — 漢字 🙂 <|endoftext|> a b", "fr", "s2", 30),
    (9_000_007, "same words again " * 3, "en", "s3", 51),
    (9_000_007, "same words again " * 3, "en", "s3", 51),
    (9_000_008, "same words again " * 3, "en", "s4", 51),
    (9_000_009, "a long text of many words that goes on " * 40_000, "en", "s5", 1_600_000),
    (9_000_010, "x" * 300_000, "en", "s5", 300_000),
    (-7, "a negative id\r\nwith\x0blines", "de", "s6", 24),
]


def edge_rows(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def with_edges(spark, sf_dir):
    """The given documents and the edge rows."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").union(
        edge_rows(spark)
    )


def clashing(df, *names):
    """``df`` with more columns, of names that the operator may use itself."""
    return df.withColumns({name: F.lit(f"own {name}") for name in names})


def rows_of(df, *names):
    """The collected rows of some columns, sortable in the presence of nulls."""
    found = [tuple(r) for r in (df.select(*names) if names else df).collect()]
    return sorted(found, key=repr)
