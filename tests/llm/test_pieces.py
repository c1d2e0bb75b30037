import heapq
import random

import duckdb
import numpy as np
import pytest
import sentencepiece

from docquarry.llm import pieces
from docquarry.llm.token_counts import tokenizer_path

MODEL = "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def model():
    return pieces.load(MODEL)


def brute(model, text):
    """All segmentations of a normalised text, by its whole lattice."""
    if not text:
        return [(0, ())]
    out = []
    for k in range(1, min(model.longest, len(text)) + 1):
        found = model.ids.get(text[:k])
        if found:
            head = [(found[1], found[:1])]
        elif k == 1:
            spelled = [model.bytes[b] for b in text[0].encode()]
            head = [(sum(s for _, s in spelled), tuple(i for i, _ in spelled))]
        else:
            continue
        out += [(s + t, a + b) for s, a in head for t, b in brute(model, text[k:])]
    return out


def test_words_match_brute_force(model):
    random.seed(7)
    for _ in range(150):
        word = " " + "".join(random.choice("theinéß漢🙂1") for _ in range(random.randint(0, 7)))
        want = heapq.nlargest(5, brute(model, word))
        got = model.nbest(word, 5)
        assert [s for s, _ in got] == [s for s, _ in want]
        assert len({i for _, i in got}) == len(got) and all(x in brute(model, word) for x in got)


def test_texts_match_brute_force(model):
    random.seed(8)
    encoder = pieces.Encoder(MODEL, 4)
    for _ in range(60):
        text = "".join(random.choice("ab  \nthé") for _ in range(random.randint(1, 10)))
        want = heapq.nlargest(4, brute(model, " " + text))
        got = encoder([text], whole=True)
        assert got.scores == [[s for s, _ in want]], text
        assert len(got.row) == got.counts[0][0] and [len(w) for w in got.ways[0]] == got.counts[0]
        assert all((s, tuple(w)) in brute(model, " " + text) for s, w in zip(got.scores[0], got.ways[0])) and len({*map(tuple, got.ways[0])}) == len(want)
    got = encoder([None, ""], whole=True)
    assert [len(got.row), got.scores, got.counts, got.ways] == [0, [[0]] * 2, [[0]] * 2, [[[]]] * 2]
    words = [" " + w for w in open(__file__).read().split() if model.spells(w)]
    words = sorted(set(words), key=len)
    score, gap, count, ids = model.viterbi_many(words)
    one = [model.viterbi(w) for w in words]
    assert [(s, g) for s, _, g in one] == list(zip(score.tolist(), gap.tolist()))
    assert [len(i) for _, i, _ in one] == count.tolist() and [x for _, i, _ in one for x in i] == ids.tolist()


def test_round_trip_and_library_decoding(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(MODEL))
    texts = [None, "", " ", "a", "Hello, world  twice", "漢字🙂 \t\r\n é", "x" * 5000, "word " * 30000, " lead", "tail ", "tie tie", "tie tie"]
    df = spark.createDataFrame([(i, t, 5, "c") for i, t in enumerate(texts)], "doc_id long, text string, score int, piece_ids string")
    rows = {r.doc_id: r for r in pieces.round_trip(df).collect()}
    assert len(rows) == len(texts) and all(r.round_trip for r in rows.values())
    assert rows[10].ids_sha256 == rows[11].ids_sha256 and rows[0].n_pieces == 0
    encoded = {r.doc_id: r for r in pieces.encode(df).collect()}
    assert all(library.decode(list(ids)) == (t or "") for i, t in enumerate(texts) for ids in (encoded[i].lattice_ids, *encoded[i].nbest_ids))
    assert all(list(encoded[i].piece_ids) == library.encode(t or "") and list(encoded[i].nbest_ids[0]) == list(encoded[i].lattice_ids) for i, t in enumerate(texts))
    for column in ("piece_ids", "lattice_ids"):
        assert {r.doc_id: r.text for r in pieces.decode(pieces.encode(df), ids_column=column).collect()} == {i: t or "" for i, t in enumerate(texts)}
    assert all(r.nbest_scores == sorted(r.nbest_scores, reverse=True) for r in rows.values())
    added = pieces.with_pieces(df)
    assert added.columns == ["doc_id", "text", "score", "piece_ids", "piece_ids_", "lattice_ids", "n_pieces", "round_trip"]
    assert all(r.round_trip and r.n_pieces == rows[r.doc_id].n_pieces and r.piece_ids == "c" and list(r.piece_ids_) == library.encode(texts[r.doc_id] or "") for r in added.collect())
    assert pieces.round_trip(df.limit(0)).count() == 0 and pieces.with_pieces(df.limit(0)).count() == 0


def test_pieces_of_documents_are_the_librarys():
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(MODEL))
    encoder = pieces.Encoder(MODEL)
    texts = [r[0] for r in duckdb.sql("SELECT text FROM '/root/testdata/sf0.01/documents.parquet'").fetchall()] + ["a  b   c ", " \n\t x", "", "▁a▁", "é🙂漢 漢"]
    for start in range(0, len(texts), 100):
        part = texts[start : start + 100]
        assert encoder(part).piece_ids().to_pylist() == library.encode([t or "" for t in part])


def unigram(folder, normal, falls_back=False):
    """A unigram model put together by hand: pieces with made-up scores, no training."""
    from sentencepiece import sentencepiece_model_pb2 as format

    rng = random.Random(41)
    model = format.ModelProto()
    rows = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    rows += [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)] if falls_back else []
    stems = {"▁", "\n" if normal is None else "-"} | set("abcdehilnorst,.") | {"é"}
    while len(stems) < 400:
        stems.add(rng.choice(["▁", ""]) + "".join(rng.choice("abcdehilnorst") for _ in range(rng.randint(1, 4))))
    rows += [(p, -rng.uniform(3, 9) - 2.1 * len(p), 1) for p in sorted(stems)]
    for piece, score, kind in rows:
        p = model.pieces.add()
        p.piece, p.score, p.type = piece, score, kind
    model.trainer_spec.model_type = 1
    model.trainer_spec.byte_fallback = falls_back
    model.normalizer_spec.add_dummy_prefix = model.normalizer_spec.escape_whitespaces = True
    model.normalizer_spec.remove_extra_whitespaces = normal is not None
    if normal:
        spec = format.ModelProto()
        spec.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=normal).serialized_model_proto())
        model.normalizer_spec.precompiled_charsmap = spec.normalizer_spec.precompiled_charsmap
    path = folder / f"{normal}-{falls_back}.model"
    path.write_bytes(model.SerializeToString())
    return str(path)


@pytest.mark.parametrize("normal", [None, "", "nmt_nfkc"])
@pytest.mark.parametrize("falls_back", [False, True])
def test_unigram_models_match_the_library(spark, tmp_path, normal, falls_back):
    """The library's own search is the oracle: best ids, the N best (ids, ties aside), decoding, unknown characters, normalisation."""
    path = unigram(tmp_path, normal, falls_back)
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(42)
    alphabet = ["the ", "ston", "ear", "in", "a", "h", " ", "  ", ", ", ".", "é", "漢", "漢字", "🙂", "Q", "ﬁ", "\n", "\u3000", "x"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 12))) for _ in range(300)] + ["", " ", "漢", "a漢字b", " ".join(["stone"] * 40)]
    encoder = pieces.Encoder(path, 5)
    got = encoder(texts, whole=True)
    assert got.piece_ids().to_pylist() == library.encode(texts)
    assert [encoder.pieces.decode(x) for x in got.piece_ids().to_pylist()] == [library.decode(x) for x in library.encode(texts)]
    score = lambda ids: sum(library.get_score(i) for i in ids)
    for text, ways in zip(texts, got.ways):
        theirs = library.nbest_encode_as_ids(text, 5) if encoder.pieces.normal(text) else [[]]
        known = falls_back is False and all(i for w in theirs for i in w)
        assert ways[0] == list(theirs[0]) and len({*map(tuple, ways)}) <= len(ways)
        if known:  # scores in whole millionths: a tie may come in another order
            assert np.allclose([score(w) for w in ways], [score(w) for w in theirs], atol=1e-4) and len(ways) == len(theirs), text
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in pieces.round_trip(df, path).collect()}
    for i, t in enumerate(texts):
        decodes = library.decode(library.encode(t)) == encoder.pieces.normal(t)
        assert rows[i].round_trip == decodes and rows[i].n_pieces == len(library.encode(t))


def test_large_numbers_of_segmentations(model):
    encoder = pieces.Encoder(MODEL, 40)
    got = encoder(["there then that"], whole=True)
    want = heapq.nlargest(40, brute(model, " there then that"))
    assert got.scores == [[s for s, _ in want]] and len({*map(tuple, got.ways[0])}) == 40
