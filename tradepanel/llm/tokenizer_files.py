"""What a tokenizer file of byte-level BPE says: symbols, merges, special strings."""

from __future__ import annotations

import json
import re

#: Characters that the Unicode property White_Space holds (fixed values).
WHITE_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

#: The pattern of byte-level BPE without a pattern of its own (a fixed value).
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones stand for themselves,
    the others take code points from 256 on, in order."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    letters, spare = [], 256
    for byte in range(256):
        letters.append(chr(byte if byte in printable else spare))
        spare += byte not in printable
    return letters


class TokenizerFile:
    """Vocabulary and merges of a byte-level BPE tokenizer in JSON."""

    def __init__(self, content: bytes):
        spec = json.loads(content)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("byte_fallback") or model.get("dropout"):
            raise ValueError("a byte-level BPE model without dropout is expected")
        self.ids: dict[str, int] = model["vocab"]
        self.word_end: str = model.get("end_of_word_suffix") or ""
        self.special = {token["content"]: token["id"] for token in spec.get("added_tokens", [])}
        self.symbols = {i: symbol for symbol, i in self.ids.items()} | {
            i: text for text, i in self.special.items()
        }
        #: (left id, right id) -> (rank, id of both together)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            key = (self.ids[left], self.ids[right])
            self.merges.setdefault(key, (rank, self.ids[left + right]))
        self.letters = byte_letters()
        self.lower = "Lowercase" in json.dumps(spec.get("normalizer"))
        self.joiner = " " if spec.get("decoder") is None else ""
        self.pattern = BYTE_LEVEL_PATTERN
        for step in (spec.get("pre_tokenizer") or {}).get("pretokenizers", []):
            if step["type"] == "Split":
                self.pattern = step["pattern"]["Regex"]
        by_length = sorted(self.special, key=len, reverse=True)
        self.special_split = (
            re.compile("(" + "|".join(map(re.escape, by_length)) + ")") if by_length else None
        )

    def parts(self, text: str) -> list[str]:
        """The text cut at special strings; every second part is such a string."""
        if self.special_split is None or not any(s in text for s in self.special):
            return [text]
        return self.special_split.split(text)
