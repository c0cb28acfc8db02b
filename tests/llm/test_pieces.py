import math
import random

import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as proto

from corpusloom.llm.pieces import _ids_of, _path_ids, decode_ids, decode_pieces, encode_pieces, encode_text, read_pieces, round_trip_pieces, stream_viterbi

from .messy import TEXTS, empty, messy

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def unigram(tmp_path_factory):
    """The same pieces as a unigram model, which the library also encodes by best path.

    The library adds scores as 32-bit floats, in which a score of -1e9 drowns all others: such
    scores become the lowest of the rest.
    """
    model = proto.ModelProto()
    with open(MODEL, "rb") as file:
        model.ParseFromString(file.read())
    model.trainer_spec.model_type = 1
    for piece in model.pieces:
        piece.score = max(piece.score, -40_000.0)
    path = tmp_path_factory.mktemp("model") / "unigram.model"
    path.write_bytes(model.SerializeToString())
    return str(path)


def sample_texts():
    draw = random.Random(6)
    parts = ["the", "word", " ", "  ", "\n", "ñandú", "日本語", "🎉", "====", "aaaaaaaa", "Zx", ".", ",,", "\t", "12", "don't", "𝔘", "representation"]
    return ["".join(draw.choice(parts) for _ in range(draw.randint(0, 40))) for _ in range(300)]


def test_equal_to_the_library(unigram):
    library, pieces = sentencepiece.SentencePieceProcessor(model_file=unigram), read_pieces(open(unigram, "rb").read())
    for text in sample_texts() + ["a" * 5_000, "日" * 700, "=" * 333]:
        ids = encode_text(text, pieces)
        assert ids == library.encode(text)
        assert decode_ids(ids, pieces) == text == library.decode(ids)


def brute(text, pieces):
    def lookup(piece):
        node = pieces.trie
        for char in piece:
            node = node[0].get(char)
            if node is None:
                return 0, -1
        return (0, -1) if node[1] is None else node[1:]

    best, back = [0.0] + [-math.inf] * len(text), [None] * (len(text) + 1)
    for end in range(1, len(text) + 1):
        for begin in range(max(0, end - pieces.longest), end):
            score, piece = lookup(text[begin:end])
            if piece < 0:
                if end > begin + 1:
                    continue
                score, piece = pieces.unknown_score, pieces.unknown
            if best[begin] + score > best[end]:
                best[end], back[end] = best[begin] + score, (begin, piece)
    found, end = [], len(text)
    while end:
        begin, piece = back[end]
        found.append((piece, text[begin:end]))
        end = begin
    return found[::-1]


def test_stream_equals_whole_viterbi(unigram):
    pieces = read_pieces(open(unigram, "rb").read())
    for text in sample_texts():
        marked = text.replace(" ", "▁")
        assert list(stream_viterbi(marked, pieces)) == brute(marked, pieces)
        for part in (marked[:7], marked[5:30], marked):
            assert _path_ids(part, pieces) == _ids_of(brute(part, pieces), pieces)


def test_ids_come_before_the_text_ends(unigram):
    pieces = read_pieces(open(unigram, "rb").read())

    class Watched(str):
        furthest = 0

        def __getitem__(self, at):
            if isinstance(at, slice):
                Watched.furthest = max(Watched.furthest, at.stop)
            return str.__getitem__(self, at)

    first = next(iter(stream_viterbi(Watched("the▁quick▁brown▁fox▁" * 1_000), pieces)))
    assert first[1] == "the" and Watched.furthest < 8 * pieces.longest


def test_tables(spark):
    rows = round_trip_pieces(messy(spark), MODEL).collect()
    assert len(rows) == len(TEXTS)
    assert all(r.same for r in rows) and sorted(r.decoded for r in rows) == sorted(t or "" for _, t in TEXTS)
    encoded = encode_pieces(messy(spark), MODEL, "doc_id")
    decoded = decode_pieces(encoded.withColumnRenamed("doc_id", "id"), MODEL, "id").collect()
    assert sorted(r.text for r in decoded) == sorted(t or "" for _, t in TEXTS)
    nulls = spark.createDataFrame([(1, None)], "doc_id int, ids array<int>")
    assert decode_pieces(nulls, MODEL).first().text is None
    assert round_trip_pieces(empty(spark), MODEL).count() == 0


def test_space_mark_itself_decodes_to_a_space(spark):
    row = round_trip_pieces(spark.createDataFrame([(1, "a▁b")], "doc_id int, text string"), MODEL).first()
    assert not row.same and row.decoded == "a b"
