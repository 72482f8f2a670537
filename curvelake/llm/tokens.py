"""Token ids of whole texts under a public byte-level BPE file, with a bounded memory of chunks."""

from __future__ import annotations

import json
from pathlib import Path

import numpy as np

from curvelake.llm.common import process_cache

#: Chunks remembered per process, some 110 MB.
REMEMBERED = 500_000

#: White space on which regex dialects differ: a text with one is encoded in one go.
FOREIGN = "\x1c\x1d\x1e\x1f\x85" + "".join(map(chr, (0x180E, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF)))
ASCII_WHITE = " \t\n\r\x0b\x0c"
OTHER_WHITE = "".join(c for c in map(chr, range(128, 0x3001)) if c.isspace() and c not in FOREIGN)

#: A special token in a text is that token, as the file says.
SPECIAL = "<|"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def is_plain(text: str) -> bool:
    """Every blank stands directly before a visible character, so that each begins a new chunk."""
    if SPECIAL in text or text.endswith(" ") or any(" " + c in text for c in ASCII_WHITE):
        return False
    return text.isascii() and not any(c in text for c in FOREIGN[:4]) or not (
        any(c in text for c in FOREIGN) or any(" " + c in text for c in OTHER_WHITE)
    )


class Encoder:
    """Encodes texts by chunks; a chunk seen before is looked up.

    The pre-tokenizer never joins what is before a blank with the blank and the visible character after
    it, so a text falls apart at such blanks. Texts with other blanks, special tokens or rare white
    space are encoded whole by the tokenizer of the file; single chunks by the same vocabulary's ranks.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        letters = _byte_letters(ByteLevel.alphabet())
        vocab = json.loads(Path(path).read_text())["model"]["vocab"]
        ranks = {bytes(letters[c] for c in token): i for token, i in vocab.items() if set(token) <= set(letters)}
        self.ranks = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.seen: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str) -> Encoder:
        held = process_cache("encoders")
        if path not in held:
            held[path] = cls(path)
        return held[path]

    def _chunk(self, chunk: str) -> bytes:
        return np.array(self.ranks.encode_ordinary(chunk), "<u4").tobytes()

    def encode_one(self, text: str) -> np.ndarray:
        """Ids of a text as little-endian unsigned 32-bit numbers."""
        if not is_plain(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        first, *parts = text.split(" ")
        seen = self.seen
        if len(seen) > REMEMBERED:
            seen.clear()
        for part in set(parts).difference(seen):
            seen[part] = self._chunk(" " + part)
        return np.frombuffer(self._chunk(first) + b"".join([seen[p] for p in parts]), "<u4")

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [self.encode_one(t) for t in texts]


def _byte_letters(alphabet: list[str]) -> dict[str, int]:
    """Byte of each letter of the byte-level alphabet: visible bytes stand for themselves, the others follow from 256."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in visible]
    letters = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(others)}
    if set(letters) != set(alphabet):
        raise ValueError("the file's alphabet is not the byte-level one")
    return letters
