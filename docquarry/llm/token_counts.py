"""Token counts: whole texts through a public tokenizer, lengths only.

Texts travel to Arrow functions in batches balanced by bytes.  A text is split
at boundaries that no token of the tokenizer can cross, and each distinct piece
of a batch is encoded once by the library in ``encode_batch``; a text's count is
the sum over its pieces.  Piece counts are kept between batches in a table of
bounded size, so memory does not follow the corpus.

Safe boundaries by kind of tokenizer:

``word``
    (BPE with word ends, white space dropped) ASCII white space: it belongs to
    no token and composes with no neighbour under NFC or lower-casing.
``byte``
    (byte-level BPE, a word carries its leading space) before a single space
    between two ASCII letters: the pre-tokenizer always breaks there.
``piece``
    (SentencePiece BPE with a dummy prefix) the same places; the space of a
    later piece is the dummy prefix that the library puts before it.

Defined results: null text counts as empty (0 bytes, 0 tokens); a text without
a safe boundary is encoded whole; repeated rows give repeated rows; an empty
table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import bound_batches, by_bytes, utf8

#: Distinct pieces whose counts a worker keeps, and the longest that it keeps.
CACHE_ENTRIES, CACHE_BYTES = 400_000, 64

_BETWEEN = re.compile(rb"(?<=[A-Za-z])(?= [A-Za-z])")


def tokenizer_path(name: str) -> str:
    """Where the vocabulary file ``name`` lies; an absolute path stays as it is."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def load_counter(name: str, kind: str | None = None) -> tuple[Callable[[list[str]], list[int]], str]:
    """A function from texts to token counts as the library gives them, and the tokenizer's kind."""
    path = tokenizer_path(name)
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)], kind or "piece"
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    if kind is None:
        kind = "word" if '"end_of_word_suffix":"</w>"' in model.to_str() else "byte"
    return lambda texts: [len(x.ids) for x in model.encode_batch(texts, add_special_tokens=False)], kind


def split_safely(text: bytes, kind: str) -> list[bytes]:
    """Pieces of ``text`` whose token counts add up to the text's."""
    if kind == "word":
        return text.split()
    if kind == "whole" or not text:
        return [text] if text else []
    pieces = _BETWEEN.split(text)
    return pieces if kind == "byte" else pieces[:1] + [x[1:] for x in pieces[1:]]


class Counter:
    """Counts texts, remembering the counts of short pieces within a bound."""

    def __init__(self, name: str, kind: str | None = None):
        self.count, self.kind = load_counter(name, kind)
        self.known: dict[bytes, int] = {}

    def __call__(self, texts: list[bytes | None]) -> list[int]:
        known = self.known
        if len(known) > CACHE_ENTRIES:
            known.clear()
        split = [split_safely(x, self.kind) if x else [] for x in texts]
        new = list(set().union(*split).difference(known))
        counted = self.count([x.decode("utf-8", "replace") for x in new])
        known.update(zip(new, counted))
        out = [sum(map(known.__getitem__, x)) for x in split]
        for x in new:
            if len(x) > CACHE_BYTES:
                del known[x]
        return out


def count_tokens(df: DataFrame, tokenizer: str = "word_bpe_49k.json", *, id_column: str = "doc_id", text_column: str = "text", limit: int = 2048, batch_bytes: int = 4 << 20) -> DataFrame:
    """``id, n_bytes, n_tokens, over_limit`` for each row of ``df``; the texts never come back from Python."""
    bound_batches(df.sparkSession)
    narrow = df.select(df[id_column], df[text_column])
    names = [id_column, "n_bytes", "n_tokens", "over_limit"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(tokenizer)
        for batch in by_bytes(batches, text_column, batch_bytes):
            texts = utf8(batch.column(1))
            counts = counter(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x or b"") for x in texts], pa.int64()), pa.array(counts, pa.int64()), pa.array([n > limit for n in counts], pa.bool_())],
                names,
            )

    kind = dict(narrow.dtypes)[id_column]
    return narrow.mapInArrow(encode, f"`{id_column}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
