"""Byte-level BPE encoding and decoding by a trie of distinct words.

A text is cut at added tokens and into words, which no token crosses, so a distinct word
is encoded once. The new words of a slice of texts go into a trie: in byte order they are
its depth-first traversal, and a word goes on from the deepest node it shares with the
word before.

A node's state is the last token of its prefix's encoding, where that token starts. Two
tokens stand side by side in an encoding exactly if no merge crosses their boundary while
they grow, so of the tokens that end at a node just one fits the state of the node where
it begins. States are carried down the trie, and the encodings of shared prefixes are
found once; a word's ids are read back from its last node.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from shopledger.llm.batches import Fields, keyed_texts, slices, texts_of

# Bounds of what a worker remembers from slice to slice; beyond them it starts anew.
MAX_WORDS = 300_000
MAX_PAIRS = 1_000_000

NEVER = 1 << 60

# Fixed value: how byte-level models cut a text into words.
WORD_PATTERN = (
    r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies.

    Visible Latin-1 characters stand for themselves; the other bytes take the letters
    from U+0100 on, in order.
    """
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + at): b for at, b in enumerate(hidden)}


class ByteBpe:
    """A byte-level BPE model file; made once per task.

    Truncation and padding are not used. Raises ValueError for models that normalise
    texts, add a prefix space, cut words by another rule, post-process, drop merges at
    random, or whose merges are not in the order in which they build on each other.
    """

    def __init__(self, serialized: bytes):
        spec = json.loads(serialized)
        model, cutter, joiner = spec["model"], spec["pre_tokenizer"], spec["decoder"]
        if spec.get("normalizer") or (spec.get("post_processor") or {}).get("type", "ByteLevel") != "ByteLevel":
            raise ValueError("models that normalise or post-process are not supported")
        if (cutter or {}).get("type") != "ByteLevel" or not cutter.get("use_regex", True):
            raise ValueError("only byte-level words are supported")
        if cutter.get("add_prefix_space") or (joiner or {}).get("type") != "ByteLevel":
            raise ValueError("only byte-level words without a prefix space are supported")
        if model.get("type", "BPE") != "BPE" or model.get("dropout") or model.get("ignore_merges"):
            raise ValueError("only BPE by merges alone is supported")
        if any(model.get(name) for name in ("continuing_subword_prefix", "end_of_word_suffix")):
            raise ValueError("marked parts of words are not supported")
        letters = byte_letters()
        vocabulary: dict[str, int] = model["vocab"]
        self.surface: dict[int, bytes] = {}
        for piece, at in vocabulary.items():
            if all(ch in letters for ch in piece):
                self.surface[at] = bytes([letters[ch] for ch in piece])
            else:
                self.surface[at] = piece.encode()
        self._add_merges(vocabulary, model["merges"])
        missing = [b for ch, b in letters.items() if ch not in vocabulary]
        if missing:
            raise ValueError(f"bytes without a token: {missing}")
        self._add_tokens(spec.get("added_tokens") or [])
        # Trie of the tokens: byte -> node; -1 -> the token that ends here.
        self.root: dict = {}
        for at, raw in self.surface.items():
            if at in self.formed and self._whole(at):
                node = self.root
                for byte in raw:
                    node = node.setdefault(byte, {})
                node[-1] = at
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}
        self.cut = regex.compile(WORD_PATTERN).findall
        self.spec = serialized
        self.library = None

    def _add_merges(self, vocabulary: dict[str, int], merges: list) -> None:
        """Notes by which merge, and from which parts, each token is formed."""
        letters = byte_letters()
        self.formed = {vocabulary[ch]: -1 for ch in letters if ch in vocabulary}
        self.parts: dict[int, tuple[int, int]] = {}
        self.merge: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(merges):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b, both = vocabulary[left], vocabulary[right], vocabulary[left + right]
            if a not in self.formed or b not in self.formed or both in self.formed:
                raise ValueError(f"merge {rank} forms {both} before its parts or again")
            self.formed[both] = rank
            self.parts[both] = (a, b)
            self.merge[a, b] = rank
        # The tokens at a token's left and right edge while it grows, from the byte on,
        # each with the merge that ends it.
        self.left_edge: dict[int, list[tuple[int, int]]] = {}
        self.right_edge: dict[int, list[tuple[int, int]]] = {}
        for at in sorted(self.formed, key=self.formed.__getitem__):
            before, after = [], []
            if at in self.parts:
                a, b = self.parts[at]
                before = [*self.left_edge[a][:-1], (a, self.formed[at])]
                after = [*self.right_edge[b][:-1], (b, self.formed[at])]
            self.left_edge[at] = [*before, (at, NEVER)]
            self.right_edge[at] = [*after, (at, NEVER)]

    def _add_tokens(self, added: list[dict]) -> None:
        """Strings that are tokens of their own wherever they occur; the longest counts."""
        for token in added:
            if any(token.get(name) for name in ("single_word", "lstrip", "rstrip", "normalized")):
                raise ValueError(f"added token {token['content']!r} has unsupported options")
        self.added = {token["content"]: token["id"] for token in added}
        for content, at in self.added.items():
            self.surface[at] = content.encode()
        longest = sorted(self.added, key=len, reverse=True)
        choices = "|".join(regex.escape(content) for content in longest)
        self.find_added = regex.compile(f"({choices})") if longest else None

    def _apart(self, a: int, b: int, until: int) -> bool:
        """Whether no merge before ``until`` crosses the boundary between two tokens.

        The edges grow by merges in rank order. Of equal merges the left one is done
        first: one that ends the left edge's token comes before one across the boundary,
        and that before one that ends the right edge's token.
        """
        left, right, merge = self.right_edge[a], self.left_edge[b], self.merge
        i = j = 0
        while True:
            (x, x_ends), (y, y_ends) = left[i], right[j]
            across = merge.get((x, y), NEVER)
            if across < until and across < x_ends and across <= y_ends:
                return False
            if x_ends >= NEVER and y_ends >= NEVER:
                return True
            if x_ends <= y_ends:
                i += 1
            else:
                j += 1

    def _whole(self, token: int) -> bool:
        """Whether the token's own bytes are encoded as the token."""
        found = self.parts.get(token)
        return found is None or (
            self._whole(found[0])
            and self._whole(found[1])
            and self._apart(*found, until=self.formed[token])
        )

    def _fits(self, before: int, token: int) -> bool:
        pair = before << 32 | token
        found = self.pairs.get(pair)
        if found is None:
            if len(self.pairs) >= MAX_PAIRS:
                self.pairs.clear()
            found = self.pairs[pair] = self._apart(before, token, NEVER)
        return found

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """The ids of distinct words, which are in byte order."""
        # By depth on the current path of the words' trie: the tokens begun and not
        # ended there, and the state: last token and the depth where it begins.
        begun: list[list] = [[]]
        last: list[int] = [-1]
        start: list[int] = [0]
        root, fits, pairs = self.root, self._fits, self.pairs
        previous, out = b"", []
        for word in words:
            shared, limit = 0, min(len(previous), len(word))
            while shared < limit and previous[shared] == word[shared]:
                shared += 1
            del begun[shared + 1 :], last[shared + 1 :], start[shared + 1 :]
            for depth in range(shared, len(word)):
                byte = word[depth]
                alive, token_, start_ = [], -1, depth
                for entry in (*begun[depth], (depth, root)):
                    node = entry[1].get(byte)
                    if node is None:
                        continue
                    begin = entry[0]
                    alive.append((begin, node))
                    if token_ < 0 and (token := node.get(-1)) is not None:
                        before = last[begin]
                        fit = before < 0 or pairs.get(before << 32 | token)
                        if fit is None:
                            fit = fits(before, token)
                        if fit:
                            token_, start_ = token, begin
                begun.append(alive)
                last.append(token_)
                start.append(start_)
            previous = word
            ids, depth = [], len(word)
            while depth:
                ids.append(last[depth])
                depth = start[depth]
            ids.reverse()
            out.append(ids)
        return out

    def words_of(self, text: str) -> list[str]:
        """The words of a text without added tokens.

        The word pattern's classes are those of the library where characters are printable
        or common white space. A text with others, such as ones not assigned yet, is cut
        by the library.
        """
        if text.isascii() or text.replace("\n", "").replace("\t", "").isprintable():
            return self.cut(text)
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_str(self.spec.decode()).pre_tokenizer
        return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each text)."""
        known = self.words
        if len(known) > MAX_WORDS:
            known.clear()
        cut, new = [], set()
        for text in texts:
            if self.find_added is None or not self.find_added.search(text):
                words = self.words_of(text)
            else:  # odd places hold the added tokens
                words = []
                for at, part in enumerate(self.find_added.split(text)):
                    if at % 2:
                        words.append(np.array([self.added[part]], "<i4").tobytes())
                    else:
                        words.extend(self.words_of(part))
            cut.append(words)
            new.update(words)
        new.difference_update(known)
        unseen = sorted(word.encode() for word in new if isinstance(word, str))
        for word, ids in zip(unseen, self.encode_words(unseen)):
            known[word.decode()] = np.array(ids, "<i4").tobytes()
        found = [
            b"".join([known[w] if isinstance(w, str) else w for w in words]) for words in cut
        ]
        counts = np.fromiter(map(len, found), np.int64, len(found)) // 4
        return np.frombuffer(b"".join(found), "<i4"), counts

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``, added tokens included; broken bytes become U+FFFD.

        Ids without a token have no text.
        """
        surface = self.surface
        try:
            raw = b"".join([surface[i] for i in ids])
        except KeyError:
            raw = b"".join([surface.get(i, b"") for i in ids])
        return raw.decode("utf-8", "replace")


@lru_cache(maxsize=2)
def byte_bpe(serialized: bytes) -> ByteBpe:
    return ByteBpe(serialized)


def encode(
    docs: DataFrame, model: bytes, fields: Fields = Fields(), decoded: bool = False
) -> DataFrame:
    """(key, n_tokens, ids) of every row; with ``decoded`` also the text the ids decode to.

    ``model`` is the content of a tokenizer file, which has a fixed size. Null texts and
    empty texts have no ids and decode to the empty text; null and repeated keys and
    repeated rows stay; other columns are ignored. A text is encoded whole, however long.
    No shuffle.
    """
    source = keyed_texts(docs, fields)
    kind = source.schema["key"].dataType.simpleString()

    def run(batches):
        bpe = byte_bpe(model)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, counts = bpe.encode(texts_of(part))
                offsets = np.concatenate(([0], np.cumsum(counts)))
                arrays = [
                    part.column("key"),
                    pa.array(counts, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids)),
                ]
                names = ["key", "n_tokens", "ids"]
                if decoded:
                    spans = zip(offsets.tolist(), offsets[1:].tolist())
                    texts = [bpe.decode(ids[i:j].tolist()) for i, j in spans]
                    arrays.append(pa.array(texts, pa.string()))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(arrays, names)

    schema = f"key {kind}, n_tokens bigint, ids array<int>"
    return source.mapInArrow(run, schema + (", decoded string" if decoded else ""))
