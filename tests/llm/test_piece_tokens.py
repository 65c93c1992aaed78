import random

import numpy as np
import pytest
from cases import frame, odd_rows

from riskloom.llm.piece_tokens import PieceModel, encode_and_decode
from riskloom.llm.queries import PIECES, tokenizer_path


@pytest.fixture(scope="module")
def pair():
    from sentencepiece import SentencePieceProcessor

    path = tokenizer_path(PIECES)
    return PieceModel(open(path, "rb").read()), SentencePieceProcessor(model_file=path)


@pytest.mark.parametrize("seed", range(3))
def test_equals_the_library(pair, seed):
    own, given = pair
    r = random.Random(seed)
    alphabet = list("abcdefghij thesorinABC \n\t.,▁éñ日本🎉\x00ﬁ\xa0  -=_#*09")
    texts = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 80))) for _ in range(3000)]
    texts += ["".join(r.choice("etaoin ") for _ in range(2000)) for _ in range(5)] + [" " * n for n in range(50)] + ["a" * n for n in range(50)]
    texts += ["ab" * 2000, " " * 2000 + "x", "=====" * 300, "0123456789" * 300, "<s>a</s><unk>"]
    ids = own.encode(texts)
    assert ids == [given.encode(t) for t in texts]
    assert [own.decode(np.array(i, np.int64)) for i in ids] == [given.decode(i) for i in ids]


def test_rows(spark, pair):
    rows = odd_rows()
    got = encode_and_decode(frame(spark, rows), tokenizer_path(PIECES))
    expected = sorted(((d, pair[1].encode(t or ""), t or "") for d, t in rows), key=repr)
    assert sorted(((r.doc_id, r.ids, r.decoded) for r in got.collect()), key=repr) == expected
    assert got.first().rest.key == "y"
    assert encode_and_decode(frame(spark, []), tokenizer_path(PIECES)).collect() == []


def test_forgetting_words_changes_nothing(pair, monkeypatch):
    monkeypatch.setattr("riskloom.llm.piece_tokens.REMEMBERED", 60)
    own, given = PieceModel(open(tokenizer_path(PIECES), "rb").read()), pair[1]
    r = random.Random(8)
    vocabulary = ["".join(r.choice("abcdé日 ") for _ in range(r.randint(1, 6))) for _ in range(150)]
    for _ in range(40):
        texts = [" ".join(r.choice(vocabulary[: r.choice((10, 150))]) for _ in range(r.randint(0, 30))) for _ in range(6)]
        assert own.encode(texts) == [given.encode(t) for t in texts]
