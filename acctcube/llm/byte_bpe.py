"""Byte-level BPE ids of whole texts from a ``tokenizers`` vocabulary file.

The ids are those of the tokenizers library. They are found with tiktoken over the vocabulary of
the same file, several times as fast; ``tests/llm`` holds the two against each other on every
code point, on long runs and on random texts. A file that is not plain byte-level BPE whose ids
follow its merges is refused.
"""

from __future__ import annotations

import functools
import json

import numpy as np
import tiktoken

#: Fixed value: the splitting pattern of byte-level BPE with ``use_regex``.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies print bytes without a visible form as characters from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


class ByteBpe:
    """Ids and bytes of the tokens of one vocabulary file, given as its text."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model, split = spec["model"], spec["pre_tokenizer"]
        plain = model["type"] == "BPE" and spec["normalizer"] is None and split["type"] == "ByteLevel"
        if not plain or split["add_prefix_space"] or not split["use_regex"] or model.get("ignore_merges"):
            raise ValueError("not a plain byte-level BPE vocabulary")
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        byte_of = byte_of_char()
        self.bytes = {i: bytes(map(byte_of.__getitem__, t)) for t, i in model["vocab"].items() if t not in special}
        made = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if made != sorted(made) or len(made) + 256 != len(self.bytes):
            raise ValueError("ids do not follow the merges")
        self._own = tiktoken.Encoding(
            "vocabulary file", pat_str=PATTERN, mergeable_ranks={b: i for i, b in self.bytes.items()}, special_tokens=special
        )

    def ids(self, text: str, special: bool = False) -> np.ndarray:
        """Ids of a text as unsigned 32-bit integers; ``special`` finds special tokens in it,
        otherwise their strings are plain text."""
        allowed = "all" if special else set()
        return self._own.encode_to_numpy(text, allowed_special=allowed, disallowed_special=())


class Spelling:
    """The bytes of rows of ids, for a table of the bytes of each id."""

    def __init__(self, tokens: dict[int, bytes]):
        table = [tokens.get(i, b"") for i in range(max(tokens) + 1)]
        self.sizes = np.array([len(t) for t in table], np.int64)
        self._first = np.cumsum(self.sizes) - self.sizes
        self._all = np.frombuffer(b"".join(table), np.uint8)

    def spell(self, ids: np.ndarray) -> bytes:
        n = self.sizes[ids]
        ends = np.cumsum(n)
        return self._all[np.arange(n.sum()) + np.repeat(self._first[ids] - ends + n, n)].tobytes()


@functools.cache
def byte_bpe(text: str) -> ByteBpe:
    """One encoder per vocabulary and process."""
    return ByteBpe(text)
