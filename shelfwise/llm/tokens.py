"""Token ids of whole texts, each distinct word encoded once per worker.

The tokenizers library needs about 15 microseconds a word. Documents repeat their words, so a
worker remembers the ids of the words it has met. Text is only cut where the tokenizer itself
always cuts (at single blanks and line ends between other characters); a text with any other
white space, or with one of the vocabulary's added tokens, is given to the tokenizer whole, so the
ids are those of whole texts in every case.
"""

from __future__ import annotations

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

#: Bytes that a worker's remembered words and their ids take at most.
MEMO = 96 << 20
#: Bytes of a remembered word besides its characters and ids.
ENTRY = 200

PUNCTUATION = ".,!?;:|#$%&*()[]{}\"'-_/<>=+~^@`\\"


def _byte_alphabet() -> dict[int, str]:
    """The printable stand-ins of byte-level vocabularies: printable Latin-1 characters stand for
    themselves, the other bytes for the characters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(others)}


_ALPHABET = _byte_alphabet()


class Encoder:
    """``encode(text)``: the ids as little-endian bytes of ``dtype``.

    ``spaced``: words carry the blank before them (byte-level vocabularies); otherwise white space
    only separates words, and letters are lower-cased.
    """

    def __init__(self, name: str, spaced: bool) -> None:
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        # Where a text holds one of these, the tokenizer gives its id and cuts the text there.
        self._added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        small = self.tokenizer.get_vocab_size() <= 1 << 16
        self.dtype = np.dtype("<u2" if small else "<u4")
        self.spaced = spaced
        self._tokenize = self.tokenizer.model.tokenize
        # The bytes of each id; words of one token share them.
        ids = range(max(self.tokenizer.get_vocab().values()) + 1)
        self._bytes = [i.to_bytes(self.dtype.itemsize, "little") for i in ids]
        self._first: dict[str, bytes | None] = _Memo(self, "")
        self._later: dict[str, bytes | None] = _Memo(self, " ") if spaced else self._first

    def pack(self, ids: list[int]) -> bytes:
        return np.asarray(ids, dtype=self.dtype).tobytes()

    def whole(self, text: str) -> bytes:
        return self.pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if any(token in text for token in self._added):
            return self.whole(text)
        if not self.spaced:
            return b"".join(map(self._first.__getitem__, text.replace("\n", " ").split(" ")))
        first, later = self._first, self._later
        lines = []
        try:
            for line in text.split("\n"):
                words = line.split(" ")
                head = first[words[0]]
                words[0] = ""
                lines.append(head + b"".join(map(later.__getitem__, words[1:])))
            return first["\n"].join(lines) if len(lines) > 1 else lines[0]
        except TypeError:  # a word stands for None: white space that words can't be cut at
            return self.whole(text)

    def word(self, word: str, lead: str, memo: dict[str, bytes | None]) -> bytes | None:
        """Ids of one word, or None if the whole text has to be encoded at once."""
        if word.isalpha():  # most words; they hold no white space
            text = word if self.spaced else word.lower()
            if word.isascii():
                return self._model(f"Ġ{text}" if lead else text)
            if max(word) < "Ā":
                return self._model("".join(map(_ALPHABET.__getitem__, (lead + text).encode())))
            return self._odd(word, lead)
        if word == "\n" and self.spaced:
            return self.whole(word)
        if not word:
            return None if self.spaced else b""
        if self.spaced and len(word.split()) != 1 or word.strip() != word:
            return None if self.spaced else self.whole(word)
        core = word.rstrip(PUNCTUATION)
        if core and core != word and core.isalpha() and (core.isascii() or max(core) < "Ā"):
            return memo[core] + self._tail(word[len(core):])
        return self._odd(word, lead)

    def _model(self, stand_in: str) -> bytes:
        """Ids of a word that the vocabulary's model takes as it is."""
        one = self._bytes
        return b"".join([one[token.id] for token in self._tokenize(stand_in)])

    def _odd(self, word: str, lead: str) -> bytes | None:
        """A word with other characters; it can be cut off only where both its ends are plain."""
        if self.spaced and not (word[0].isprintable() and word[-1].isprintable()):
            return None
        return self.whole(lead + word)

    def _tail(self, marks: str) -> bytes:
        return self._first[marks] if len(marks) < 8 else self.whole(marks)


class _Memo(dict):
    """Words in two generations: once the young one is full, it becomes the old one. Words in use come
    back from there without being encoded again; others go with it."""

    def __init__(self, encoder: Encoder, lead: str) -> None:
        self.encoder, self.lead, self.size = encoder, lead, 0
        self.old: dict[str, bytes | None] = {}

    def __missing__(self, word: str) -> bytes | None:
        old = self.old
        ids = old[word] if word in old else self.encoder.word(word, self.lead, self)
        self.size += ENTRY + 4 * len(word) + (len(ids) if ids else 0)
        if self.size > MEMO // 2:
            self.old = dict(self)
            self.clear()
            self.size = 0
        self[word] = ids
        return ids


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(name: str, spaced: bool) -> Encoder:
    """The worker's encoder; worker processes live through many tasks."""
    if (name, spaced) not in _ENCODERS:
        _ENCODERS[name, spaced] = Encoder(name, spaced)
    return _ENCODERS[name, spaced]
