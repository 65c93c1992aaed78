import json
import random

import numpy as np
import pytest
from cases import frame, odd_rows

from riskloom.llm import token_counts as T
from riskloom.llm.queries import BYTES, tokenizer_path

END = "<|endoftext|>"


@pytest.fixture(scope="module")
def vocabulary():
    return open(tokenizer_path(BYTES), encoding="utf-8").read()


@pytest.fixture(scope="module")
def library(vocabulary):
    from tokenizers import Tokenizer

    return Tokenizer.from_str(vocabulary)


def expected(library, rows):
    return sorted(((d, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for d, t in rows), key=repr)


def result(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in df.collect()), key=repr)


def test_pre_tokens_are_those_of_the_library(library):
    classes = T.character_classes(library)
    r = random.Random(4)
    alphabet = [*"ab's't're 've m ll d  \n\t1 2é日!'''\"-.  🎉\x00  ²Ⅷ", "'s", "'re", "'ll", " '", "\n\n"]
    for _ in range(5000):
        text = "".join(r.choice(alphabet) for _ in range(r.randint(1, 14)))
        raw = np.frombuffer(text.encode(), np.uint8)
        starts = T.pieces(raw, np.array([0]), classes)
        own = [text.encode()[a:b].decode() for a, b in zip(starts, np.append(starts[1:], len(raw)))]
        assert own == [text[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(text)]


def test_classes_where_the_library_knows_other_characters(library):
    class Narrow:
        """A library for which é is no letter."""

        def __init__(self):
            self.pre_tokenizer = self

        def pre_tokenize_str(self, text):
            return library.pre_tokenizer.pre_tokenize_str(text.replace("é", "!"))

    usual, narrow = T.character_classes(library), T.character_classes(Narrow())
    assert usual[ord("é")] == T.LETTER and narrow[ord("é")] == T.OTHER
    usual[ord("é")] = T.OTHER
    assert (usual == narrow).all()


def test_counts_equal_the_library(spark, vocabulary, library):
    r = random.Random(9)
    words = ["".join(r.choice("theraingolupd'éñ日") for _ in range(r.randint(1, 9))) for _ in range(400)]
    rows = [(d, r.choice(" \n").join(r.choices(words, k=r.randint(0, 200)))) for d in range(150)]
    rows += [(1000, END), (1001, f"a {END}\n {END}{END} b"), (1002, "<|endof" + END + "text|>"), (1003, "=" * 3000 + " " * 500), (1004, "ab" * 20_000), (1005, f"  {END}  ")]
    rows += odd_rows()
    assert result(T.count_tokens(frame(spark, rows), vocabulary)) == expected(library, rows)
    assert result(T.count_tokens(frame(spark, rows), vocabulary, frequent=1)) == expected(library, rows)
    assert T.count_tokens(frame(spark, []), vocabulary).collect() == []
    over = {x.doc_id: x.over_limit for x in T.count_tokens(frame(spark, [(1, "a b c"), (2, "a b c d")]), vocabulary, limit=3).collect()}
    assert over == {1: False, 2: True}


def test_small_caches_change_nothing(vocabulary, library, monkeypatch):
    monkeypatch.setattr(T, "CACHE_ENTRIES", 64)
    monkeypatch.setattr(T, "AT_ONCE", 32)
    cache = T.Cache(vocabulary)
    r = random.Random(3)
    for _ in range(60):
        words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(1, 12))).encode() for _ in range(50)]
        raw, sizes = np.frombuffer(b"".join(words), np.uint8), np.array([len(w) for w in words])
        starts = np.cumsum(sizes) - sizes
        plain = [len(library.encode(w.decode()).ids) for w in words]
        assert cache.short(raw.tobytes(), starts, sizes, T.keys_of(raw, starts, sizes)).tolist() == plain
        assert cache.others(words) == plain


def test_keys_tell_sizes_apart():
    words = [b"a", b"a\x00", b"\x00", b"\x00\x00", b"abcdefgh", b"abcdefgh\x00", b"x" * 24]
    raw, sizes = np.frombuffer(b"".join(words), np.uint8), np.array([len(w) for w in words])
    table = T.LengthTable(16)
    keys = T.keys_of(raw, np.cumsum(sizes) - sizes, sizes)
    assert table.add(keys, sizes, lambda new: new + 1).tolist() == table.find(keys, sizes).tolist() == [1, 2, 3, 4, 5, 6, 7]
    assert table.used == 7


def test_other_tokenizers_are_refused(spark, vocabulary):
    other = json.loads(vocabulary) | {"pre_tokenizer": {"type": "Whitespace"}}
    with pytest.raises(ValueError):
        T.count_tokens(frame(spark, []), json.dumps(other))
