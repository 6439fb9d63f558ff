"""Token ids of whole texts by a public tokenizer that treats every word on its own."""

from __future__ import annotations

import re
import struct

import public_tokenizers
from tokenizers import Tokenizer

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
ID_BYTES = 4
CACHED_WORDS = 400_000
"""Words whose ids a worker remembers, about 200 bytes each."""

_MARKS = ".,;:!?"
#: Marks that end a word of letters are a word of their own for the vocabulary.
_TRAILING = re.compile(rb"[.,;:!?$%&*#](?<=[A-Za-z].)[.,;:!?$%&*#]*(?=[ \t-\r]|\Z)")
_COMBINING = b"\xcc"
_PACKED = [struct.Struct(f"<{n}I").pack for n in range(32)]
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: Byte-level vocabularies spell a byte as the sign of that number if it prints, else from 256 on.
_BYTE_SIGNS = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in set(_PRINTED))}


class WordEncoder:
    """Ids of texts, as little-endian unsigned 32-bit numbers laid end to end.

    For vocabularies that drop white space and never look across it, so that the ids of a text are
    those of its words.  Words come again and again; each is encoded once and remembered, those
    not met for long are forgotten first.
    """

    def __init__(self, path: str = WORD_BPE, cached: int = CACHED_WORDS):
        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self._cached = cached
        self._known: dict[bytes, bytes] = {}
        self._before: dict[bytes, bytes] = {}
        self._added = [t.content.lower().encode() for t in self._tokenizer.get_added_tokens_decoder().values()]

    def size(self) -> int:
        """One more than the largest id."""
        return max(self._tokenizer.get_vocab(with_added_tokens=True).values()) + 1

    def _letters(self, word: str, raw: bytes) -> bytes:
        """Ids of one run of lower-case letters, which the vocabulary takes as a whole."""
        spelled = word if word.isascii() else raw.decode("latin-1").translate(_BYTE_SIGNS)
        ids = [token.id for token in self._model.tokenize(spelled)]
        return _PACKED[len(ids)](*ids) if len(ids) < len(_PACKED) else struct.pack(f"<{len(ids)}I", *ids)

    def _whole(self, text: str) -> bytes:
        ids = self._tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _learn(self, word: bytes) -> bytes:
        ids = self._before.get(word) or self._known.get(word) or self._ids(word)
        if 2 * len(self._known) >= self._cached:
            self._known, self._before = {}, self._known
        self._known[word] = ids
        return ids

    def _ids(self, word: bytes) -> bytes:
        if word.isalpha():
            low = word.lower()
            return self._letters(low.decode("ascii"), low)
        text = word.decode("utf-8", "surrogatepass")
        stem = text.rstrip(_MARKS)
        if not stem.isalpha() or not stem.isascii() and max(stem) >= "Ā":
            return self._whole(text)
        # letters, then marks: two separate words for the vocabulary, which knows no capitals
        low, marks = stem.lower(), text[len(stem) :]
        ids = self._letters(low, low.encode())
        return ids + self._learn(marks.encode()) if marks else ids

    def _words(self, text: bytes) -> list[bytes]:
        """Words of a text, spelled alike where the vocabulary sees no difference."""
        low = text.lower()
        if any(token in low for token in self._added):
            return text.split()
        # a capital may stay apart from a mark above or below it that its small letter is joined with
        return _TRAILING.sub(rb" \g<0>", text if _COMBINING in text else low).split()

    def encode(self, text: str | bytes | None) -> bytes:
        """Ids of a text, or of its bytes in UTF-8."""
        known, learn = self._known.get, self._learn
        raw = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text or b""
        return b"".join([known(w) or learn(w) for w in self._words(raw)])


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str = WORD_BPE) -> WordEncoder:
    """The worker's encoder, which later tasks find warm."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def forget() -> None:
    """Let go of the worker's encoders and the words they remember."""
    _encoders.clear()
