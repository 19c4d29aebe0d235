"""Ids of a word tokenizer, kept by white-space word.

``tokenizers`` models that drop white space and whose pre-tokenizer never
looks across it encode a text as the concatenation of its words.  So a
worker encodes a word once and keeps its packed ids; a text is a split and
a join.  A word of Latin-1 characters is cut into its pieces here and each
piece goes to the model of the library; other words, whose normal form or
classes are the library's business, go through all of it.  ``WordIds``
checks the properties it relies on with the tokenizer it loads.
"""

from __future__ import annotations

import json
import os
import re
from struct import pack

from quarry.llm.common import only_memo

#: What ``str.split()`` takes for white space and Unicode does not.
SEPARATORS = re.compile("[\x1c-\x1f]")
WHITE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def split_words(text: str) -> list[str]:
    """Runs without Unicode white space."""
    if SEPARATORS.search(text):
        return [w for w in WHITE.split(text) if w]
    return text.split()


#: Fixed values of the pre-tokenizer: its pattern, and the same for lower-case Latin-1.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LATIN = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+|[0-9\xb2\xb3\xb9\xbc-\xbe]|[^0-9a-z\xaa\xb2\xb3\xb5\xb9\xba\xbc-\xbe\xdf-\xf6\xf8-\xff]+")
NORMAL = ["NFC", "Replace", "Lowercase"]


def byte_letters() -> dict[int, int]:
    """How byte-level models write a byte: printable ones as themselves,
    the others as the code points from 256 on."""
    hidden = [c for c in range(256) if not (0x21 <= c <= 0x7E or 0xA1 <= c <= 0xAC or 0xAE <= c <= 0xFF)]
    return {c: 256 + i for i, c in enumerate(hidden)}


class WordIds:
    def __init__(self, path: str, max_words: int = 1_300_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.model._resize_cache(0)         # words are kept here
        self.max_words = max_words
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.hidden = byte_letters()
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        steps = [x["type"] for x in config["normalizer"].get("normalizers", [])]
        if steps != NORMAL or json.dumps(PATTERN)[1:-1] not in json.dumps(config["pre_tokenizer"]):
            raise ValueError(f"{path}: this tokenizer's words are not known to stand alone")

    def _library(self, word: str) -> bytes:
        ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        return pack(f"<{len(ids)}I", *ids)

    def _piece(self, piece: str) -> bytes:
        packed = self.known.get(piece) or self.older.get(piece)
        if packed is None:
            letters = piece if piece.isascii() and piece.isprintable() else piece.encode().decode("latin-1").translate(self.hidden)
            ids = [t.id for t in self.model.tokenize(letters)]
            packed = self.known[piece] = pack(f"<{len(ids)}I", *ids)
        return packed

    def _word(self, word: str) -> bytes:
        if not word.isascii():
            try:
                word.encode("latin-1")
            except UnicodeEncodeError:
                return self._library(word)
        pieces = LATIN.findall(word.lower())
        return self._piece(pieces[0]) if len(pieces) == 1 else b"".join(map(self._piece, pieces))

    def encode_one(self, text: str) -> bytes:
        """The ids of a text, little-endian unsigned 32-bit."""
        words = split_words(text)
        if 2 * len(self.known) >= self.max_words:
            self.older, self.known = self.known, {}
        known = self.known
        for word in [w for w in words if w not in known]:
            known[word] = self.older.get(word) or self._word(word)
        return b"".join(map(known.__getitem__, words))

    def encode(self, texts: list[str]) -> list[bytes]:
        return [self.encode_one(t) for t in texts]


def word_ids(path: str) -> WordIds:
    """One encoder per worker process."""
    return only_memo(WordIds, path)


def encoded(batches, path: str):
    """(row values without the text, packed ids) of record batches whose
    last column is the text (null: empty)."""
    encode = word_ids(path).encode_one
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns[:-1]]
        for *key, text in zip(*columns, batch.columns[-1], strict=True):
            yield key, encode(text.as_py() or "")
