import random

import pytest
from tokenizers import Tokenizer

from docquarry.llm import token_counts

ALPHABET = "abc XYZ \n\t\x0b\x0c\r\x1c\x85\xa0 ﬁΣσς'é'sst<|endoftext|>1٣२漢字🙂ñ▁_-.!"


def odd_texts():
    random.seed(9)
    return ["".join(random.choice(ALPHABET) for _ in range(random.randint(0, 40))) + random.choice(["", "<|endoftext|>", "<|startoftext|> a", "ΑΣ b", "Á ́b"]) for _ in range(1500)]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_pieces_count_as_the_library_does(name):
    counter = token_counts.Counter(name)
    texts = odd_texts()
    assert counter([t.encode() for t in texts]) == counter.count(texts)


def test_counts_of_a_table(spark):
    texts = [None, "", " \n", "word " * 50000, "x" * 3000, "<|endoftext|> twice <|endoftext|>", "tie", "tie", *odd_texts()[:300]]
    df = spark.createDataFrame([(i, t, "a", 1) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string, n_bytes int")
    library = Tokenizer.from_file(token_counts.tokenizer_path("word_bpe_49k.json"))
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 100) for i, t in enumerate(texts)]
    assert sorted(map(tuple, token_counts.count_tokens(df, limit=100, batch_bytes=1000).collect())) == want
    assert token_counts.count_tokens(df.limit(0)).count() == 0
    assert token_counts.count_tokens(spark.createDataFrame([(None, "a b")], "doc_id long, text string")).collect() == [(None, 3, 2, False)]
