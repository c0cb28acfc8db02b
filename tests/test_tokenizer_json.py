import json

import pytest

from corpusloom.functions.text import BYTE_BPE, CHAR_BPE
from corpusloom.operators.bpe import train_bpe
from corpusloom.sources.tokenizer_json import (
    read_tokenizer_json,
    tokenizer_json,
    write_tokenizer_json,
)


@pytest.mark.parametrize("kind", [CHAR_BPE, BYTE_BPE])
def test_public_library_reads_it_and_it_reads_back(spark, tmp_path, kind):
    tokenizers = pytest.importorskip("tokenizers")
    texts = spark.createDataFrame([("the cat \"the\" cat's \\ café the cat",)], "text string")
    made = train_bpe(texts, kind)
    theirs = tokenizers.Tokenizer.from_str(tokenizer_json(made).first().value)
    assert theirs.get_vocab() == {r.token: r.id for r in made.vocab.collect()}
    assert theirs.decode(theirs.encode("the cat<|pad|>the").ids).strip() == "the cat the"
    write_tokenizer_json(made, str(tmp_path / "j"))
    back = read_tokenizer_json(spark, str(tmp_path / "j"))
    assert back.kind == kind
    assert sorted(back.vocab.select("token", "id", "is_special").collect()) == sorted(made.vocab.collect())
    assert sorted(back.merges.collect()) == sorted(made.merges.collect())


def test_older_files_and_added_tokens(spark, tmp_path):
    written = {
        "added_tokens": [{"id": 3, "content": "</s>", "special": True}],
        "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True},
        "model": {"type": "BPE", "vocab": {"a": 0, "b": 1, "ab": 2}, "merges": ["a b"]},
    }
    (tmp_path / "t.json").write_text(json.dumps(written, indent=1))
    back = read_tokenizer_json(spark, str(tmp_path / "t.json"))
    assert back.kind == BYTE_BPE
    assert tuple(back.merges.first()) == (0, "a", "b", "ab")
    assert {r.token for r in back.vocab.where("is_special").collect()} == {"</s>"}
    assert back.vocab.count() == 4


@pytest.mark.parametrize("change,named", [
    ({"pre_tokenizer": {"type": "Whitespace"}}, "pre_tokenizer"),
    ({"pre_tokenizer": None}, "pre_tokenizer"),
    ({"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False}}, "add_prefix_space"),
    ({"normalizer": {"type": "NFC"}}, "normalizer"),
    ({"unk_token": "[UNK]"}, "unk_token"),
    ({"type": "WordPiece"}, "model.type"),
    ({"byte_fallback": True}, "byte_fallback"),
    ({"ignore_merges": True}, "ignore_merges"),
    ({"continuing_subword_prefix": "##"}, "continuing_subword_prefix"),
])
def test_other_files_are_refused_by_name(spark, tmp_path, change, named):
    model = {"type": "BPE", "vocab": {"a": 0}, "merges": []}
    written = {"normalizer": None, "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True}}
    for name, value in change.items():
        (written if name in written else model)[name] = value
    (tmp_path / "t.json").write_text(json.dumps({**written, "model": model}))
    with pytest.raises(ValueError, match=named):
        read_tokenizer_json(spark, str(tmp_path / "t.json"))
