"""Token ids of texts, inside tasks.

Texts are encoded in parts if the tokenizer's file normalizes and cuts them in the
way written out here, and as a whole if it does anything else.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache
from pathlib import Path

import numpy as np

# Texts of Latin-1 that need no normalization but lower case, the tokenizer's own cut of
# such texts into words, and white space at which any text can be cut without changing its ids.
PLAIN = re.compile(r"[\x20-\x7e\t\n\rÀ-ÖØ-öø-ÿ]*")
WORDS = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")
CUTS = re.compile(r"[ \t\n\r]+")
# What a tokenizer's file says of normalization and cutting if the above holds for it.
NORMALIZER = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
}
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
            "behavior": "Removed", "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
SPECIAL = re.compile(r"<\|\S*")


def in_parts(specification: dict) -> bool:
    """Whether texts can be cut as written out here before this tokenizer sees them."""
    return (
        specification["normalizer"] == NORMALIZER and specification["pre_tokenizer"] == PRE_TOKENIZER
        and not specification["model"].get("dropout")
        and all(SPECIAL.fullmatch(token["content"]) for token in specification["added_tokens"])
    )


class Remembered(dict):
    """Packed ids by text. When it is full the older half goes, but for what is used meanwhile."""

    most = 250_000

    def __init__(self):
        super().__init__()
        self.older: dict[str, bytes] = {}

    def __missing__(self, text: str) -> bytes:
        ids = self.older.get(text)
        if ids is None:
            ids = self.made(text)
        if len(text) <= 64:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[text] = ids
        return ids

    def made(self, text: str) -> bytes:
        raise NotImplementedError


class WordIds(Remembered):
    """Packed ids of words, by the tokenizer."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def made(self, text: str) -> bytes:
        if text.isascii():
            return b"".join([token.id.to_bytes(4, "little") for token in self.model.tokenize(text)])
        return self.whole(text)


class ChunkIds(Remembered):
    """Packed ids of chunks of other texts, between white space."""

    most = 25_000

    def __init__(self, words: WordIds):
        super().__init__()
        self.words = words

    def made(self, text: str) -> bytes:
        return self.words.whole(text)


@lru_cache(maxsize=2)
def tokens_of(path: str) -> tuple[WordIds, ChunkIds, bool]:
    words = WordIds(path)
    return words, ChunkIds(words), in_parts(json.loads(Path(path).read_text("utf-8")))


def token_ids(text: str, path: str) -> np.ndarray:
    """Ids as the tokenizer of this file gives them for the whole text.

    One that drops white space and never joins across it or from word to word, as
    that of word_bpe_49k.json, gives the same ids for the parts one by one.
    """
    words, chunks, parts = tokens_of(path)
    if not parts:
        packed = words.whole(text)
    elif PLAIN.fullmatch(text) and "<|" not in text:
        packed = b"".join([words[word] for word in WORDS.findall(text.lower())])
    else:
        packed = b"".join([chunks[chunk] for chunk in CUTS.split(text) if chunk])
    return np.frombuffer(packed, "<u4")
