"""Ids of whole texts from a ``tokenizers`` vocabulary file of BPE with word ends.

The ids are those of the tokenizers library. A text is put in lower case and cut into pieces, and the
ids of a piece are remembered; a new piece is merged by tiktoken, with a space in the place of the mark of
a word's end. The library itself takes texts that hold a special token or a letter or number assigned
after Unicode 3.2, about which splitting patterns of different versions disagree, and every text
where the file is of another kind. ``tests/llm`` holds the two against each other on every code
point, on random texts and on whole tables.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata

import numpy as np
import regex
import tiktoken
from tokenizers import Tokenizer

from acctcube.llm.byte_bpe import byte_of_char

#: Pieces are forgotten when they hold this many characters together.
CACHE = 1 << 22
END = "</w>"

#: The parts of a file whose texts are cut here.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
PRE_TOKENIZERS = [
    {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]

_pieces = regex.compile(SPLIT).findall
_ascii_pieces = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-z]+|[0-9]|[^\sa-z0-9]+", re.ASCII).findall


@functools.cache
def _agreed() -> frozenset[str]:
    """Characters that all versions of Unicode in use take alike for letters, numbers, spaces or neither."""

    def agreed(c: str) -> bool:
        return unicodedata.ucd_3_2_0.category(c) != "Cn" or unicodedata.category(c)[0] in "MPS"

    return frozenset(c for c in map(chr, (*range(0xD800), *range(0xE000, 0x110000))) if agreed(c))


class WordBpe(dict):
    """Ids of pieces, as little-endian unsigned 32-bit integers, for one vocabulary file given as its text."""

    def __init__(self, text: str):
        super().__init__()
        self.library = Tokenizer.from_str(text)
        spec = json.loads(text)
        model = spec["model"]
        special = [t["content"] for t in spec["added_tokens"]]
        self._special = re.compile("|".join(map(re.escape, special)) or r"(?!)")
        self.plain = (
            (spec["normalizer"] or {}).get("normalizers") == NORMALIZERS
            and (spec["pre_tokenizer"] or {}).get("pretokenizers") == PRE_TOKENIZERS
            and (model["type"], model["end_of_word_suffix"], model["continuing_subword_prefix"]) == ("BPE", END, None)
            and not (model["dropout"] or model["unk_token"] or model["fuse_unk"] or model["byte_fallback"] or model["ignore_merges"])
        )
        if self.plain:
            own = {t: i for t, i in model["vocab"].items() if t not in special}
            self._own, self._id = _merger(own, model["merges"])
            ends = {i for t, i in own.items() if t.endswith(END) and t != END}
            self._last = np.isin(self._id, list(ends))
            self._held = 0

    def _learn(self, pieces: list[str]) -> None:
        """Merge the pieces not yet known, in one call."""
        if self._held > CACHE:
            self.clear()
            self._held = 0
        new = [p for p in set(pieces) if p not in self]
        if new:
            joined = " ".join(new) + " "
            found = self._own.encode_to_numpy(joined, disallowed_special=())
            ends = (4 * (np.flatnonzero(self._last[found]) + 1)).tolist()
            data = self._id[found].tobytes()
            self.update((p, data[a:b]) for p, a, b in zip(new, [0, *ends], ends))
            self._held += len(joined)

    def _lower(self, text: str) -> str:
        """The text as the file's normaliser gives it, but for white space."""
        if unicodedata.is_normalized("NFC", text):
            # the normaliser does not look at a letter's place in its word
            return text.replace("Σ", "σ").lower()
        return self.library.normalizer.normalize_str(text)

    def ids(self, text: str) -> bytes:
        """Ids of a text, without special tokens of the tokenizer's own adding."""
        simple = text.isascii()
        if not self.plain or self._special.search(text) or not simple and not _agreed().issuperset(set(text)):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        pieces = _ascii_pieces(text.lower()) if simple else _pieces(self._lower(text))
        self._learn(pieces)
        return b"".join(map(self.__getitem__, pieces))


def _merger(vocab: dict[str, int], merges: list) -> tuple[tiktoken.Encoding, np.ndarray]:
    """An encoder of pieces followed by a space, and the id of each of its tokens.

    The last byte of a piece joins the space before any merge, so these tokens come first.
    """
    byte_of = byte_of_char()
    made = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in merges]
    last = [vocab[c + END] for c in byte_of]
    order = [*last, *(vocab[c] for c in byte_of), *made]
    if sorted(order) != list(range(len(order))) or len(order) != len(vocab):
        raise ValueError("vocabulary is not bytes, last bytes and merges")

    names = {i: t for t, i in vocab.items()}

    def spelt(i: int) -> bytes:
        name = names[i]
        end = name.endswith(END) and name != END
        return bytes(map(byte_of.__getitem__, name[: -len(END)] if end else name)) + b" " * end

    ranks = {spelt(i): k for k, i in enumerate(order)}
    if len(ranks) != len(order):
        raise ValueError("two tokens with the same bytes")
    return tiktoken.Encoding("vocabulary file", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={}), np.array(order, "<u4")


@functools.cache
def word_bpe(text: str) -> WordBpe:
    """One encoder per vocabulary and process."""
    return WordBpe(text)
