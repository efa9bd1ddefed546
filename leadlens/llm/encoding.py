"""Whole texts to token ids with a public tokenizer file; words that were seen keep their ids."""

from __future__ import annotations

import re
import sys
from array import array

LITTLE = sys.byteorder == "little" and array("I").itemsize == 4
#: Letters whose class, case and composition are alike in all Unicode versions, and ASCII marks (without ', which begins contractions) that stand
#: alone after them.
SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-įĲ-ɏ]+)([!-&(-/:-@\[-`{-~]*)")
#: A run of non-white characters with the blank before it, or white space (fixed values: Unicode's).
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECES = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")


def byte_letters() -> dict[int, str]:
    """The character by which byte-level vocabularies write each byte: printable ones as they are, the rest from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(rest)}


class _Memory(dict):
    """Ids of words, at most ``most`` of up to ``longest`` characters; then it starts anew."""

    def __init__(self, compute, most: int, longest: int):
        super().__init__()
        self.compute, self.most, self.longest = compute, most, longest

    def __missing__(self, word: str) -> bytes:
        ids = self.compute(word)
        if len(word) <= self.longest:
            if len(self) >= self.most:
                self.clear()
            self[word] = ids
        return ids


class PieceEncoder:
    """Encodes texts word by word with the tokenizers library and remembers the ids of words.

    Byte-level and word-end vocabularies split at white space before any merge, so the ids of a text are those of its
    words in a row: with the blank before them in a byte-level vocabulary, without white space in a word-end one.
    Simple words go straight to the vocabulary's model, others through the whole library; a word with marks at its end is looked up without
    them, so that a word's ids are computed once, whatever follows it.  The memory is bounded and results don't depend on it.  Any other kind of vocabulary encodes whole texts.  With ``added``, as the library does by default, the strings of added tokens in a text
    have these tokens' ids, and a text that holds one is encoded whole; without, special tokens' strings are ordinary text.
    """

    def __init__(self, path: str, end_id: int = 1, most: int = 800_000, longest: int = 40, added: bool = False):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = not added
        strings = [t.content for t in self.tok.get_added_tokens_decoder().values() if t.content] if added else []
        self.added = re.compile("|".join(map(re.escape, strings)), re.I).search if strings else None  # any case: some match normalized text
        self.end = end_id.to_bytes(4, "little")
        self.letters = byte_letters()
        model, before = self.tok.model, type(self.tok.pre_tokenizer).__name__
        self.kind = "word" if getattr(model, "end_of_word_suffix", None) and self.tok.normalizer is not None else "byte" if before == "ByteLevel" and self.tok.normalizer is None else "other"
        # pre-tokenizers and normalizers are looked at by what they do
        if self.kind == "word" and self._ids("A  b\n") != self._ids("a b") or self.kind == "byte" and self._ids("a b") != self._ids("a") + self._ids(" b"):
            self.kind = "other"
        self.model = model
        self.bare = _Memory(lambda w: self._word("", w), most, longest)
        self.spaced = _Memory(lambda w: self._word(" ", w), most, longest)
        self.pieces = _Memory(self._whole, most // 8, longest)

    def _ids(self, text: str) -> list[int]:
        return self.tok.encode(text, add_special_tokens=False).ids

    @staticmethod
    def _pack(ids: list[int]) -> bytes:
        return array("I", ids).tobytes() if LITTLE else b"".join([i.to_bytes(4, "little") for i in ids])

    def _whole(self, text: str) -> bytes:
        return self._pack(self._ids(text))

    def _word(self, blank: str, word: str) -> bytes:
        stem = word
        if not (word.isascii() and word.isalpha()):
            m = SIMPLE.fullmatch(word)
            if m is None:
                return self._whole(blank + word)
            stem, marks = m.groups()
            if marks:
                return (self.spaced if blank else self.bare)[stem] + self.pieces[marks]
        if self.kind == "word":
            stem = stem.lower()
        letters = stem if stem.isascii() else stem.encode().decode("latin-1").translate(self.letters)
        spelt = self.letters[32] + letters if blank and self.kind == "byte" else letters
        return self._pack([t.id for t in self.model.tokenize(spelt)])

    def _text(self, text: str) -> bytes:
        if self.added is not None and self.added(text):
            return self._whole(text)
        if self.kind == "word":
            if "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text:  # white to Python alone
                return b"".join(map(self.pieces.__getitem__, PIECES.findall(text)))
            return b"".join(map(self.bare.__getitem__, text.split()))
        if self.kind == "other":
            return self._whole(text)
        lines = [line.split(" ") for line in text.split("\n")]
        words, n = text.split(), sum(map(len, lines))
        if len(words) != n or sum(map(len, words)) != len(text) - n + 1:  # white space other than single blanks and line ends
            return b"".join(map(self.pieces.__getitem__, PIECES.findall(text)))
        spaced, bare = self.spaced.__getitem__, self.bare.__getitem__
        return self.pieces["\n"].join([bare(words[0]) + b"".join(map(spaced, words[1:])) for words in lines])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text with the end id, as little-endian unsigned 32-bit integers."""
        return [self._text(t) + self.end for t in texts]
