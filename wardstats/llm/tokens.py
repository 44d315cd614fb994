"""Texts to the ids of a public tokenizer, word by word with a bounded memo."""

from __future__ import annotations

import numpy as np
from tokenizers import Tokenizer

END_ID = 1
MEMO_WORDS = 1_000_000


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else the next from 256."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


_LETTERS = _byte_letters()


class _Memo(dict):
    """The ids of words; one that is not there yet is asked for and kept."""

    def __init__(self, learn):
        super().__init__()
        self.learn = learn

    def __missing__(self, word: str) -> bytes:
        ids = self[word] = self.learn(word)
        return ids


class Encoder:
    """The ids of a text, the same as ``Tokenizer.encode(..., add_special_tokens=False)``.

    For a tokenizer whose pre-tokenizer drops white space and lower-cases, the
    ids of a text are those of its words in a row. Words repeat, so their ids
    are kept, for about ``MEMO_WORDS`` words. A new word of plain letters, with
    or without a stop behind it, is one pre-token, which goes straight to the
    tokenizer's model; any other word, and a text with an added token's string
    or an odd separator, takes the tokenizer's whole way. A null text is empty.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.width = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 65536 else "<u4")
        self.id_bytes = [i.to_bytes(self.width.itemsize, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.memo = _Memo(self._learn)
        self.stops = {s: self._whole(s) for s in ".,"}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.width).tobytes()

    def _learn(self, word: str) -> bytes:
        stop = self.stops.get(word[-1])
        bare = word if stop is None else word[:-1]
        # Letters up to U+00FF: composed already, and one lower-case letter each.
        if not bare.isalpha() or bare != bare.lower():
            return self._whole(word)
        if not bare.isascii():
            if max(bare) >= "Ā":
                return self._whole(word)
            bare = bare.encode().decode("latin-1").translate(_LETTERS)
        own = self.id_bytes
        ids = b"".join([own[t.id] for t in self.tokenize(bare)])
        return ids if stop is None else ids + stop

    def packed(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian integers of ``width``."""
        out, get = [], self.memo.__getitem__
        for text in texts:
            text = text or ""
            if "<|" in text or any(c in text for c in "\x1c\x1d\x1e\x1f"):
                out.append(self._whole(text))
            else:
                # A-Z in lower case have the same ids and make fewer words.
                out.append(b"".join(map(get, text.encode().lower().decode().split())))
            if len(self.memo) > MEMO_WORDS:
                self.memo.clear()
        return out

    def ids(self, packed: bytes) -> np.ndarray:
        return np.frombuffer(packed, self.width)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
