"""Splitting of large documents at natural breaks, in an Arrow function.

The split's own rules, which its users can rely on:

* separators are tried in order; the first that occurs is used;
* a separator stays at the start of the piece that follows it;
* pieces over ``size`` are split again by the separators after it;
* pieces are joined while they fit into ``size``; a part starts with what of the
  last part's pieces fits into ``overlap``;
* white space at a part's ends goes, and an empty part is none.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..arrow import in_bytes, ready
from . import text

#: Sizes in characters: documents above LIMIT are split into parts of TARGET with OVERLAP.
LIMIT, TARGET, OVERLAP = 80_000, 70_000, 500
#: Separators, most natural first.
SEPARATORS = ["\n * * *\n", "\n* * *\n", "\n---\n", "\n\n\n", "\n\n", "\n", ". ", " ", ""]


def _pieces(body: str, separator: str) -> list[str]:
    if not separator:
        return list(body)
    first, *rest = body.split(separator)
    return [p for p in [first, *(separator + x for x in rest)] if p]


def _merge(pieces: list[str], size: int, overlap: int) -> list[str]:
    parts: list[str] = []
    begin = total = 0  # the pieces of the part in the making
    for end, piece in enumerate(pieces):
        if total + len(piece) > size and end > begin:
            parts.append("".join(pieces[begin:end]).strip())
            while begin < end and (total > overlap or total + len(piece) > size):
                total -= len(pieces[begin])
                begin += 1
        total += len(piece)
    parts.append("".join(pieces[begin:]).strip())
    return [p for p in parts if p]


def split_text(body: str, size: int = TARGET, overlap: int = OVERLAP, separators: list[str] = SEPARATORS) -> list[str]:
    """Parts of ``body`` of at most ``size`` characters."""
    k = next(i for i, s in enumerate(separators) if not s or s in body)
    parts: list[str] = []
    fitting: list[str] = []
    for piece in _pieces(body, separators[k]):
        if len(piece) < size or not separators[k + 1 :]:
            fitting.append(piece)
            continue
        parts += _merge(fitting, size, overlap) if fitting else []
        fitting = []
        parts += split_text(piece, size, overlap, separators[k + 1 :])
    return parts + (_merge(fitting, size, overlap) if fitting else [])


def split_column(content: Column, limit: int = LIMIT, size: int = TARGET, overlap: int = OVERLAP) -> Column:
    """The parts of a document, each with the document's header; for large documents alone."""
    ready()

    @F.arrow_udf("array<string>")
    def parts(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for headers, bodies in in_bytes(columns):
            yield pa.array([None if b is None else [f"{h}\n\n{p}" for p in split_text(b, size, overlap)] for h, b in zip(headers, bodies)], pa.list_(pa.string()))

    body = text.content_body(content)
    return F.when((F.length(content) <= limit) | (F.length(body) == 0), F.array(content)).otherwise(parts(text.url_header(content), body))


def split_documents(df: DataFrame, limit: int = LIMIT, size: int = TARGET, overlap: int = OVERLAP, content: str = "content") -> DataFrame:
    """``df``'s large documents with ``part_number`` (from 1) and ``part_content``.

    The filter comes first, so the function sees no document that stays whole.
    """
    large = df.where(F.length(content) > limit)
    split = large.withColumn("__parts", split_column(F.col(content), limit, size, overlap))
    return split.select(*df.columns, F.posexplode("__parts").alias("__at", "part_content")).withColumn("part_number", F.col("__at") + 1).drop("__at")
