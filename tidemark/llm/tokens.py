"""Encoding whole texts with a public tokenizer, a word at a time.

The tokenizers used here never join what stands on two sides of a space or a line feed, so a text's ids are its words'
ids one after another. Words repeat, so a worker keeps the ids of those it has met, up to a fixed number. A new word of
plain letters needs none of the tokenizer's steps but its merges; for any other word all its steps are run.

Added tokens of the tokenizer (control strings such as <|endoftext|>) that occur in a text become their single id, as the
untouched tokenizer has it: a text is first split at them, in exactly their writing and case.
"""

from __future__ import annotations

import os
import re
from array import array

from tidemark.llm.workers import kept

#: Words, and pieces of words, whose ids a Python worker keeps; beyond that it starts anew.
KEPT_WORDS, KEPT_PIECES = 500_000, 300_000
#: Longer words are encoded each time they occur.
KEPT_CHARS = 48
#: How the tokenizer splits ASCII text, and letters whose lower case and normal form are beyond doubt.
_ASCII_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^ a-z0-9]+")
_LETTERS = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([,.]?)")


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _as_byte_letters() -> list[str]:
    """The letter that byte-level tokenizers write for each byte: itself if it is visible, or the next from 256 on."""
    seen = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in seen else next(rest)) for b in range(256)]


class WordEncoder:
    """ids of a text as little-endian unsigned 32-bit integers, for word_bpe_49k.json."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        # A task has one core; the library's own threads would only spin over the few words of a text.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # of what is left between the added tokens, none is one
        self.merges = self.tokenizer.model
        added = {t.content: array("I", [n]).tobytes() for n, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.added = added
        self.at_added = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.letters = _as_byte_letters()
        self.known: dict[str, bytes] = {"": b""}
        self.pieces: dict[str, bytes] = {}

    @classmethod
    def get(cls, path: str) -> WordEncoder:
        return kept(f"tokens {path}", lambda: cls(path))

    def encode(self, text: str | None) -> bytes:
        text = text or ""
        if self.at_added and self.at_added.search(text):
            parts = self.at_added.split(text)
            return b"".join([self.added[p] if n % 2 else self._plain(p) for n, p in enumerate(parts)])
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        # The tokenizer ignores case; for other letters than these, only the tokenizer knows how.
        words = (text.lower() if text.isascii() else text).replace("\n", " ").split(" ")
        new = set(words).difference(self.known)
        for w in new:
            self.known[w] = self._word(w)
        out = b"".join(map(self.known.__getitem__, words))
        for w in new:
            if len(w) > KEPT_CHARS:
                del self.known[w]
        if len(self.known) > KEPT_WORDS:
            self.known = {"": b""}
        if len(self.pieces) > KEPT_PIECES:
            self.pieces = {}
        return out

    def _word(self, word: str) -> bytes:
        if len(word) <= KEPT_CHARS:
            if word.isascii():
                if word.isprintable():
                    return b"".join([self._piece(p) for p in _ASCII_PIECES.findall(word.lower())])
            elif m := _LETTERS.fullmatch(word):
                return self._piece(m[1].lower()) + (self._piece(m[2]) if m[2] else b"")
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            written = piece if piece.isascii() else "".join([self.letters[b] for b in piece.encode()])
            ids = self.pieces[piece] = array("I", [t.id for t in self.merges.tokenize(written)]).tobytes()
        return ids
