"""Operators that keep a table's other columns keep those of any name: their own working names of the code, and each other's."""

import pytest
from pyspark.sql import functions as F

from docquarry.llm import language, mixing, pieces, pii, quality, simhash

NAMES = ["id", "th", "key", "hash", "size", "words", "position", "part", "turn", "place", "spans", "kept", "common", "host", "lines", "text_key", "rank", "start", "keep", "label", "best", "n", "t"]
NAMES += [f"__{n}" for n in ("id", "th", "row_th", "text", "spans", "own", "where", "key", "kept", "common", "mix_size", "mix_pass", "mix_hash")]


@pytest.fixture(scope="module")
def docs(spark):
    own = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = own.union(own.where("doc_id < 5"))  # some rows twice
    return rows.select("*", *[F.concat(F.lit(f"{n} "), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(c) for n, c in enumerate(NAMES)]).cache()


KEEPING = {
    "language": language.keep_identified,
    "simhash": simhash.keep_one,
    "pii": pii.masked,
    "mixing": mixing.mixed_rows,
    "quality": lambda df: quality.cleaned(df, min_documents=3, max_removed=0.9),
    "pieces": pieces.with_pieces,
}


@pytest.mark.parametrize("name", KEEPING)
def test_columns_of_any_name_are_kept(docs, name):
    out = KEEPING[name](docs)
    assert out.columns[: len(docs.columns)] == docs.columns
    rows = out.collect()
    assert len(rows) > 100 and all(r[c] == f"{n} {r.doc_id}" for r in rows for n, c in enumerate(NAMES))


@pytest.mark.parametrize("name", KEEPING)
def test_null_columns_and_empty_tables(spark, docs, name):
    nulls = spark.createDataFrame([(None,) * len(docs.columns)] * 2 + [(7,) + (None,) * (len(docs.columns) - 1)], ", ".join(f"{c} {t}" for c, t in docs.dtypes))
    assert KEEPING[name](nulls).count() == {"language": 0, "simhash": 1, "pii": 3, "mixing": 0, "quality": 0, "pieces": 3}[name]
    assert KEEPING[name](nulls.limit(0)).count() == 0
