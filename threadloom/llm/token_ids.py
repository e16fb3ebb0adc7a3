"""Token ids of whole texts by a public word-level BPE vocabulary.

The tokenizer removes white space before it merges anything, so no token spans a blank or a line break; and a run of letters
ends where a symbol begins. Texts are therefore cut at blanks and line breaks, and each distinct piece is encoded once; a text's ids are put
together from those of its pieces. Pieces of Latin letters, which the tokenizer only lowers, go straight to the library's
merges; symbols that close such a piece are a piece of their own. All others are encoded by the library as they are. A text
that may hold a special token, which is found across any cut, is encoded by the library as a whole.
"""

from __future__ import annotations

import os
import re
import sys
from array import array

END_ID = 2
#: Pieces whose ids a worker remembers; twice as many for a short time.
REMEMBERED = 250_000
#: Letters that lower to one small Latin letter each, then symbols (no apostrophe, which may begin an ending like 's).
_PLAIN = re.compile("([a-zß-öø-ÿÀ-ÖØ-Þ]+)([!-&(-/:-@\\[-`{-~]*)").fullmatch


class _Known(dict):
    """Packed ids by piece; a piece that is not there yet is encoded, or taken from what was known before."""

    def __init__(self, encoder: Encoder, before: dict[str, bytes]):
        super().__init__()
        self.before, self.letters = before, encoder.letters
        self.merges, self.whole = encoder.merges.tokenize, encoder.whole

    def __missing__(self, piece: str) -> bytes:
        found = self.before.get(piece)
        if found is None:
            cut = _PLAIN(piece)
            if cut is None:
                found = self.whole([piece])[0]
            elif cut[2]:
                found = self[cut[1]] + self[cut[2]]
            else:
                small = piece if piece.isascii() else piece.lower().encode().decode("latin-1").translate(self.letters)
                found = _packed([token.id for token in self.merges(small)])
        self[piece] = found
        return found


class Encoder:
    """ids() gives a text's ids as little-endian unsigned 32-bit integers, the end id last."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # bytes that stand for themselves
        hidden = [byte for byte in range(256) if byte not in shown]
        self.letters = str.maketrans({chr(byte): chr(256 + k) for k, byte in enumerate(hidden)})
        self.special = [str(token.content) for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.hints = {token[:2] for token in self.special}
        self.known = _Known(self, {})
        self.end = _packed([END_ID])

    def whole(self, texts: list[str]) -> list[bytes]:
        return [_packed(found.ids) for found in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def ids(self, texts: list[str | None]) -> list[bytes]:
        if len(self.known) > REMEMBERED:
            self.known.before = {}
            self.known = _Known(self, self.known)
        known = self.known.__getitem__
        return [
            (self.whole([text])[0] if self._special(text) else b"".join(map(known, _lower(text or "").replace("\n", " ").split(" "))))
            + self.end
            for text in texts
        ]

    def _special(self, text: str | None) -> bool:
        """Whether the text holds a special token, or what lower case would turn into one."""
        return bool(text) and any(token in text for token in self.hints)


def _packed(ids: list[int]) -> bytes:
    found = array("I", ids)
    if sys.byteorder == "big":
        found.byteswap()
    return found.tobytes()


def _lower(text: str) -> str:
    """A-Z only, which the tokenizer would lower itself."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each worker and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
