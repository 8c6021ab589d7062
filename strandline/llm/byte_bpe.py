"""Ids of a byte-level BPE vocabulary file of the `tokenizers` library, whole texts in bounded memory.

tiktoken's engine reads the same file and gives the same ids (tests hold it against `tokenizers` on every kind of character) at about a
fifth of the CPU; `tokenizers` itself takes what that engine refuses, such as a million blanks in a row.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator

import numpy as np

MODEL = "/opt/tokenizers/byte_bpe_50k.json"
#: The split of this kind of vocabulary, and the bytes that stand for themselves in its file.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: A blank between characters that are none: no token reaches over its start, be it of this kind of vocabulary or of SentencePiece's, and
#: what follows encodes as if nothing stood before.
CUT = re.compile(r"(?<=\S) (?=\S)")
#: Characters that are encoded at once, if the text has a CUT.
BLOCK = 1 << 17


def blocks(text: str) -> Iterator[str]:
    """The text in parts of about BLOCK characters that encode by themselves; a part goes on to the next CUT."""
    at = 0
    while len(text) - at > BLOCK and (m := CUT.search(text, at + BLOCK)):
        yield text[at : m.start()]
        at = m.start()
    yield text[at:] if at else text


class ByteBpe:
    """encode() and the bytes of each id."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        self.path = path
        self.special = {t["content"]: t["id"] for t in model["added_tokens"] if t["special"]}
        others = iter(range(256, 512))
        byte = {chr(b if b in PLAIN else next(others)): b for b in range(256)}
        vocabulary = {bytes(byte[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in self.special}
        self.bytes = [b""] * (max([*vocabulary.values(), *self.special.values()]) + 1)
        for token, i in [*vocabulary.items(), *((t.encode(), i) for t, i in self.special.items())]:
            self.bytes[i] = token
        self.engine = tiktoken.Encoding("byte-bpe", pat_str=SPLIT, mergeable_ranks=vocabulary, special_tokens=self.special)

    @functools.cached_property
    def library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def encode(self, text: str, special: bool) -> np.ndarray:
        """Ids of a text as unsigned 32-bit numbers. special: whether the strings of special tokens within it are these tokens."""
        try:
            return self.engine.encode_to_numpy(text, allowed_special="all" if special else set(), disallowed_special=())
        except ValueError:
            self.library.encode_special_tokens = not special
            return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)


@functools.lru_cache(maxsize=1)
def byte_bpe(path: str) -> ByteBpe:
    return ByteBpe(path)
