"""SentencePiece encoding and decoding by a shared-prefix Viterbi.

A text is cut into marked words: white-space marks followed by other characters, or a
line feed. No piece crosses such a boundary, so words are encoded apart, and each
distinct word of a slice of texts once. Sorted, the words are the depth-first order of
their trie: a word keeps the forward values of the prefix it shares with the one
before and extends them from there.

A unigram model's forward value is the best score of a prefix. A BPE model's pieces
are ranked by merge order, and the sum of ranks is not what its encoder minimises.
There the forward value of a prefix is the last piece of its encoding: a piece extends
a prefix if merging would leave it apart from the prefix's last piece. Boundaries of
merging are decided by the two pieces that touch, so exactly one piece fits and the
path equals the merge result.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shopledger.llm.batches import Fields, keyed_texts, slices, texts_of

MARK = "\u2581"

# Texts encoded together: their distinct words are sorted and walked at one time.
BATCH_BYTES = 4 << 20

# Remembered pairs of pieces; beyond it the memory starts anew.
MAX_PAIRS = 500_000

_WORDS = re.compile(f"\n|{MARK}+[^{MARK}\n]*|[^{MARK}\n]+")

# Piece and model types of the model format.
NORMAL, UNKNOWN, BYTE = 1, 2, 6
UNIGRAM, BPE = 1, 2

# Fixed value: how far an unknown character scores below the worst piece.
UNKNOWN_PENALTY = 10.0


class PieceModel:
    """A model file's pieces, and encoding of words; made once per task.

    Supports unigram and BPE models without a normaliser table, with a prefix mark and
    all white space kept; others raise ValueError.
    """

    def __init__(self, serialized: bytes):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        model.ParseFromString(serialized)
        normal = model.normalizer_spec
        if normal.precompiled_charsmap or normal.remove_extra_whitespaces:
            raise ValueError("models that normalise texts are not supported")
        if not normal.add_dummy_prefix or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only models with a mark before words are supported")
        self.bpe = model.trainer_spec.model_type == BPE
        if not self.bpe and model.trainer_spec.model_type != UNIGRAM:
            raise ValueError("only unigram and BPE models are supported")
        self.ids: dict[str, int] = {}
        self.scores: list[float] = []
        self.byte_ids: dict[int, int] = {}
        self.unknown = 0
        self.surface: list[bytes] = []
        for at, piece in enumerate(model.pieces):
            self.scores.append(piece.score)
            self.surface.append(b"")
            if piece.type == NORMAL:
                if MARK in piece.piece.lstrip(MARK) or "\n" in piece.piece:
                    raise ValueError(f"piece {piece.piece!r} crosses a word boundary")
                self.ids[piece.piece] = at
                self.surface[at] = piece.piece.replace(MARK, " ").encode()
            elif piece.type == BYTE:
                value = int(piece.piece[3:5], 16)
                self.byte_ids[value] = at
                self.surface[at] = bytes([value])
            elif piece.type == UNKNOWN:
                self.unknown = at
                self.surface[at] = " \u2047 ".encode()
            elif piece.type == 4:
                raise ValueError("user-defined pieces are not supported")
        self.texts = {at: piece for piece, at in self.ids.items()}
        self.byte_fallback = model.trainer_spec.byte_fallback
        worst = min((self.scores[i] for i in self.ids.values()), default=0.0)
        self.unknown_score = worst - UNKNOWN_PENALTY
        # Node of the pieces' trie: character -> node; "" -> the piece that ends here.
        self.root: dict = {}
        for piece, at in self.ids.items():
            node = self.root
            for ch in piece:
                node = node.setdefault(ch, {})
            node[""] = at
        self.pairs: dict[int, bool] = {}
        self.alone: dict[int, bool] = {}

    def _merged(self, text: str) -> list[str]:
        """The symbols of ``text`` after merging, best pair first, leftmost on ties."""
        symbols = list(text)
        while True:
            best, place = None, -1
            for at in range(len(symbols) - 1):
                piece = self.ids.get(symbols[at] + symbols[at + 1])
                if piece is not None and (best is None or self.scores[piece] > best):
                    best, place = self.scores[piece], at
            if best is None:
                return symbols
            symbols[place : place + 2] = [symbols[place] + symbols[place + 1]]

    def _fits(self, before: int | None, piece: int) -> bool:
        """Whether merging leaves ``piece`` whole and apart from the piece before it.

        Negative ids stand for unknown characters, which merge with nothing.
        """
        own = self.alone.get(piece)
        if own is None:
            own = self.alone[piece] = self._merged(self.texts[piece]) == [self.texts[piece]]
        if not own or before is None or before < 0:
            return own
        pair = before * len(self.scores) + piece
        found = self.pairs.get(pair)
        if found is None:
            if len(self.pairs) >= MAX_PAIRS:
                self.pairs.clear()
            a, b = self.texts[before], self.texts[piece]
            found = self.pairs[pair] = self._merged(a + b) == [a, b]
        return found

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """The ids of each of the sorted distinct ``words``."""
        # By position in the current word: pieces begun and not ended, the last piece of
        # the best path and where it starts, and the path's score.
        open_: list[list] = [[]]
        last: list[int | None] = [None]
        start: list[int] = [0]
        score: list[float] = [0.0]
        previous, out = "", []
        root, bpe, scores, fits = self.root, self.bpe, self.scores, self._fits
        for word in words:
            shared, limit = 0, min(len(previous), len(word))
            while shared < limit and previous[shared] == word[shared]:
                shared += 1
            del open_[shared + 1 :], last[shared + 1 :], start[shared + 1 :], score[shared + 1 :]
            for at in range(shared, len(word)):
                ch = word[at]
                alive = []
                piece_, start_, score_ = None, at, 0.0
                for begin, node in (*open_[at], (at, root)):
                    child = node.get(ch)
                    if child is None:
                        continue
                    alive.append((begin, child))
                    piece = child.get("")
                    if piece is None:
                        continue
                    if bpe:
                        if piece_ is None and fits(last[begin], piece):
                            piece_, start_ = piece, begin
                    else:
                        total = score[begin] + scores[piece]
                        if piece_ is None or total > score_:
                            piece_, start_, score_ = piece, begin, total
                if ch not in root or "" not in root[ch]:
                    total = score[at] + self.unknown_score
                    if piece_ is None or (not bpe and total > score_):
                        piece_, start_, score_ = -1 - ord(ch), at, total
                open_.append(alive)
                last.append(piece_)
                start.append(start_)
                score.append(score_)
            previous = word
            ids: list[int] = []
            at = len(word)
            while at:
                piece = last[at]
                if piece >= 0:
                    ids.append(piece)
                elif self.byte_fallback:
                    raw = chr(-1 - piece).encode("utf-8", "surrogatepass")
                    ids.extend(self.byte_ids[b] for b in reversed(raw))
                elif not ids or ids[-1] != self.unknown:
                    ids.append(self.unknown)
                at = start[at]
            ids.reverse()
            out.append(ids)
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each text)."""
        split = [_WORDS.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        words = sorted({word for found in split for word in found})
        place = {word: at for at, word in enumerate(words)}
        encoded = self.encode_words(words)
        lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
        flat = np.fromiter((i for ids in encoded for i in ids), np.int32, int(lengths.sum()))
        firsts = np.concatenate(([0], np.cumsum(lengths)[:-1])) if len(lengths) else lengths
        used = np.fromiter(
            (place[w] for found in split for w in found), np.int64, sum(map(len, split))
        )
        sizes = lengths[used]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        index = np.arange(total) + np.repeat(firsts[used] - (ends - sizes), sizes)
        per_text = np.zeros(len(texts), np.int64)
        counts = np.fromiter(map(len, split), np.int64, len(split))
        np.add.at(per_text, np.repeat(np.arange(len(texts)), counts), sizes)
        return flat[index], per_text

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids`` without the first mark; broken bytes become U+FFFD."""
        surface = self.surface
        text = b"".join([surface[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=2)
def piece_model(serialized: bytes) -> PieceModel:
    return PieceModel(serialized)


def encode(
    docs: DataFrame, model: bytes, fields: Fields = Fields(), decoded: bool = False
) -> DataFrame:
    """(key, n_pieces, ids) of every row; with ``decoded`` also the decoded text.

    ``model`` is the content of a model file, which has a fixed size. Null texts and
    empty texts have no ids. Repeated rows stay; other columns are ignored. No shuffle.
    """
    source = keyed_texts(docs, fields)
    kind = source.schema["key"].dataType.simpleString()

    def run(batches):
        pieces = piece_model(model)
        for batch in batches:
            for part in slices(batch, "text", BATCH_BYTES):
                ids, counts = pieces.encode(texts_of(part))
                offsets = np.concatenate(([0], np.cumsum(counts)))
                arrays = [
                    part.column("key"),
                    pa.array(counts),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids)),
                ]
                names = ["key", "n_pieces", "ids"]
                if decoded:
                    spans = zip(offsets.tolist(), offsets[1:].tolist())
                    texts = [pieces.decode(ids[i:j].tolist()) for i, j in spans]
                    arrays.append(pa.array(texts, pa.string()))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(arrays, names)

    schema = f"key {kind}, n_pieces bigint, ids array<int>"
    return source.mapInArrow(run, schema + (", decoded string" if decoded else ""))
