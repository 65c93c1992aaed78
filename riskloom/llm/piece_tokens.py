"""SentencePiece BPE encoding by vectorised merge rounds, and decoding.

Texts are cut where no piece of the vocabulary reaches across (before white space that follows a word, around characters
that no longer piece holds), and only words not met before are encoded, all together: one flat array holds the symbols
of all words; a round finds the best pair of every word (segmented minimum of pair ranks), merges its leftmost
occurrences in all words at once, and compacts the array; words without a pair leave it.

A word merges several occurrences of its best pair in one round only if none of the new pairs ranks as high as the pair
itself. Else it merges the leftmost alone. Both give what one merge at a time gives.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from riskloom.llm import common as C

SPACE = "▁"
NONE = np.int64(2**40)
#: Words whose ids a worker remembers.
REMEMBERED = 300_000


class PieceModel:
    """Tables of a SentencePiece BPE model with byte fallback and identity normalisation."""

    def __init__(self, proto: bytes):
        from sentencepiece import SentencePieceProcessor

        given = SentencePieceProcessor(model_proto=proto)
        n = given.vocab_size()
        names = [given.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (given.is_unknown(i) or given.is_control(i) or given.is_byte(i) or given.is_unused(i))]
        byte_ids = [i for i in range(n) if given.is_byte(i)]
        if len(byte_ids) != 256 or given.normalize(" a  Bﬁ\n") != f"{SPACE}{SPACE}a{SPACE}{SPACE}Bﬁ\n":
            raise ValueError("only models with byte fallback, identity normalisation and a dummy prefix are covered")
        self.size = n
        self.byte_ids = sorted(byte_ids, key=lambda i: int(names[i][3:5], 16))
        symbols = {names[i]: i for i in plain}
        for i in plain:
            for c in names[i]:
                symbols.setdefault(c, len(symbols) + n)  # a character that only longer pieces hold
        self.of_char = np.full(0x110000, -1, np.int64)
        for name, i in symbols.items():
            if len(name) == 1:
                self.of_char[ord(name)] = i
        order = {score: rank for rank, score in enumerate(sorted({given.get_score(i) for i in plain}, reverse=True))}
        self.width = max(symbols.values()) + 1
        pairs = {}
        for i in plain:
            name = names[i]
            for cut in range(1, len(name)):
                left, right = symbols.get(name[:cut]), symbols.get(name[cut:])
                if left is not None and right is not None:
                    pairs[left * self.width + right] = (order[given.get_score(i)], i)
        keys = np.array(sorted(pairs), np.int64)
        self.keys = np.append(keys, np.int64(2**62))
        self.ranks = np.array([pairs[k][0] for k in keys.tolist()] + [0], np.int64)
        self.merged = np.array([pairs[k][1] for k in keys.tolist()] + [0], np.int64)
        longer = {c for i in plain if len(names[i]) > 1 for c in names[i]}
        inner = any(SPACE in names[i].lstrip(SPACE) for i in plain)
        alone = "".join(c for c in "\n\r\t" if c not in longer)
        words = f"[^{alone}]+" if inner else f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+"
        self.words = re.compile(f"{words}|[{alone}]" if alone else words)
        shown = [bytes([int(names[i][3:5], 16)]) if given.is_byte(i) else b"" if given.is_control(i) else names[i].replace(SPACE, " ").encode() for i in range(n)]
        self.shown_at = np.concatenate([[0], np.cumsum([len(x) for x in shown])])
        self.shown = np.frombuffer(b"".join(shown), np.uint8)
        # words met before: their numbers, names, uses, and their ids in one flat array
        self.known: dict[str, int] = {}
        self.names: list[str] = []
        self.flat, self.sizes, self.starts, self.uses = (np.zeros(0, np.int64) for _ in range(4))

    def _joined(self, left: np.ndarray, right: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged piece of pairs; NONE where no piece is the two together."""
        key = np.where(allowed & (left >= 0) & (right >= 0), left * self.width + right, -1)
        at = np.searchsorted(self.keys, key)
        found = self.keys[at] == key
        return np.where(found, self.ranks[at], NONE), np.where(found, self.merged[at], 0)

    def _pairs(self, symbol: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged piece of each symbol with the next one of its word."""
        rank, piece = np.full(len(symbol), NONE), np.zeros(len(symbol), np.int64)
        rank[:-1], piece[:-1] = self._joined(symbol[:-1], symbol[1:], word[1:] == word[:-1])
        return rank, piece

    @staticmethod
    def _leftmost(match: np.ndarray) -> np.ndarray:
        """Every second position of each run of matches, from its left end: pairs that do not overlap."""
        run = np.flatnonzero(match & ~np.concatenate([[False], match[:-1]]))
        place = np.zeros(len(match), np.int64)
        place[run[0]:] = np.arange(run[0], len(match)) - np.repeat(run, np.diff(np.append(run, len(match))))
        return match & (place % 2 == 0)

    def _merged_arrays(self, symbol, word, char, rank, piece, chosen):
        """The arrays after the chosen merges, and the positions whose pairs are new."""
        symbol = np.where(chosen, piece, symbol)
        stay = np.ones(len(symbol), bool)
        stay[1:] = ~chosen[:-1]
        symbol, word, char, rank, piece, made = (x[stay] for x in (symbol, word, char, rank, piece, chosen))
        new = made.copy()
        new[:-1] |= made[1:]
        at = np.flatnonzero(new)
        after = np.minimum(at + 1, len(symbol) - 1)
        rank[at], piece[at] = self._joined(symbol[at], symbol[after], (after > at) & (word[at] == word[after]))
        return (symbol, word, char, rank, piece), at

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and how many each word has."""
        sizes = np.array([len(w) for w in words])
        char = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        symbol, word = self.of_char[char], np.repeat(np.arange(len(words)), sizes)
        rank, piece = self._pairs(symbol, word)
        done = []
        while len(symbol):
            first = np.flatnonzero(C.run_starts(word))
            best = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(word))))
            if (over := best == NONE).any():
                done.append((word[over], symbol[over], char[over]))
                symbol, word, char, rank, piece, best = (x[~over] for x in (symbol, word, char, rank, piece, best))
                if not len(symbol):
                    break
            chosen = self._leftmost(rank == best)
            arrays = symbol, word, char, rank, piece
            now, at = self._merged_arrays(*arrays, chosen)
            several = np.bincount(word[chosen], minlength=int(word[-1]) + 1) > 1
            if several.any():
                limit = np.full(len(several), -1)
                limit[word] = best
                hasty = np.zeros(len(several), bool)
                hasty[now[1][at[now[3][at] <= limit[now[1][at]]]]] = True
                # what a merged symbol would have met, had the pair after it not been merged as well
                i = np.flatnonzero(chosen[:-2] & chosen[2:] & (word[:-2] == word[2:]))
                met, _ = self._joined(piece[i], symbol[i + 2], np.ones(len(i), bool))
                hasty[word[i[met <= best[i]]]] = True
                if (hasty & several).any():
                    where = np.flatnonzero(chosen)
                    leading = np.zeros(len(chosen), bool)
                    leading[where[C.run_starts(word[where])]] = True
                    now, _ = self._merged_arrays(*arrays, chosen & (leading | ~(hasty & several)[word]))
            symbol, word, char, rank, piece = now
        word, symbol, char = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(word, kind="stable")
        word, symbol, char = word[order], symbol[order], char[order]
        unknown = np.flatnonzero((symbol < 0) | (symbol >= self.size))
        if len(unknown):  # characters that are no piece become the pieces of their bytes
            spelled = [[self.byte_ids[y] for y in chr(c).encode()] for c in char[unknown].tolist()]
            times = np.ones(len(symbol), np.int64)
            times[unknown] = [len(x) for x in spelled]
            word, symbol = np.repeat(word, times), np.repeat(symbol, times)
            starts = (np.cumsum(times) - times)[unknown]
            own = np.array([len(x) for x in spelled])
            symbol[np.arange(own.sum()) + np.repeat(starts - np.cumsum(own) + own, own)] = [y for x in spelled for y in x]
        return symbol, np.bincount(word, minlength=len(words))

    def _remember(self, words: list[str]) -> None:
        """Adds words; when there are too many, those met only once since the last time are forgotten."""
        fresh = [w for w in words if w not in self.known]
        if len(self.known) + len(fresh) > REMEMBERED:
            keep = np.flatnonzero(self.uses[:len(self.names)] > 1)
            ids, sizes = self._gather(keep), self.sizes[keep]
            self.names = [self.names[i] for i in keep.tolist()] if len(keep) + len(fresh) <= REMEMBERED else []
            if not self.names:
                ids, sizes = ids[:0], sizes[:0]
            self.known = {w: i for i, w in enumerate(self.names)}
            self.flat, self.sizes, self.uses = ids, sizes, np.zeros(len(sizes), np.int64)
            fresh = [w for w in words if w not in self.known]
        if fresh:
            ids, sizes = self.encode_words(fresh)
            self.known.update(zip(fresh, range(len(self.names), len(self.names) + len(fresh))))
            self.names += fresh
            self.flat, self.sizes = np.concatenate([self.flat, ids]), np.concatenate([self.sizes, sizes])
            self.uses = np.concatenate([self.uses, np.zeros(len(fresh), np.int64)])
        self.starts = np.cumsum(self.sizes) - self.sizes

    def _gather(self, numbers: np.ndarray) -> np.ndarray:
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        return self.flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[numbers] - ends + sizes, sizes)]

    def encode_flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, without begin or end ids, and where each text's ids start (and the end)."""
        cut = [self.words.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        self._remember(list({w for words in cut for w in words if w not in self.known}) or [])
        try:
            numbers = np.array([self.known[w] for words in cut for w in words], np.int64)
        except KeyError:  # some known words were forgotten to make room
            self._remember(list({w for words in cut for w in words}))
            numbers = np.array([self.known[w] for words in cut for w in words], np.int64)
        self.uses += np.bincount(numbers, minlength=len(self.uses))
        per_text = np.concatenate([[0], np.cumsum([len(words) for words in cut])]).astype(np.int64)
        upto = np.concatenate([[0], np.cumsum(self.sizes[numbers])])
        return self._gather(numbers), upto[per_text]

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text."""
        ids, at = self.encode_flat(texts)
        return [ids[i:j].tolist() for i, j in zip(at[:-1], at[1:])]

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids; the space that stands for the dummy prefix goes, bytes are joined to characters."""
        start = self.shown_at[ids]
        size = self.shown_at[ids + 1] - start
        ends = np.cumsum(size)
        raw = self.shown[np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - ends + size, size)].tobytes()
        return raw.removeprefix(b" ").decode("utf-8", "replace")


_MODELS: dict[int, PieceModel] = {}


def _model(proto: bytes) -> PieceModel:
    """One model per worker process."""
    if (key := hash(proto)) not in _MODELS:
        _MODELS[key] = PieceModel(proto)
    return _MODELS[key]


def _tokens(model):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _model(model.value)
        for batch in batches:
            for a, b in C.chunks(batch):
                ids, at = own.encode_flat(batch.column("text").slice(a, b - a).to_pylist())
                texts = [own.decode(ids[i:j]) for i, j in zip(at[:-1], at[1:])]
                yield C.carried(batch, a, b - a, ids=pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32))), decoded=pa.array(texts, pa.string()))

    return rows


def encode_and_decode(docs: DataFrame, model_path: str) -> DataFrame:
    """Piece ids of every text and the text decoded from them.

    ``model_path`` names a SentencePiece BPE model that the driver reads; it is broadcast (about half a megabyte).
    Result, one row per input row: doc_id, ids (array<int>), decoded and, if the input has more columns, those in the
    struct ``rest``. A null or empty text has no ids and decodes to the empty text; a null doc_id stays null; repeated
    rows give repeated results. A very long text is a chunk of its own.
    """
    with open(model_path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    texts = C.packed(docs)
    return texts.mapInArrow(_tokens(model), C.schema_with(texts, ids="array<int>", decoded="string"))
