"""Reading BPE vocabulary files: symbols, merges, special strings."""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import lru_cache


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters, spare = [""] * 256, 0x100
    for byte in range(256):
        if byte in plain:
            letters[byte] = chr(byte)
        else:
            letters[byte] = chr(spare)
            spare += 1
    return letters


@dataclass(frozen=True)
class Vocabulary:
    ids: dict[str, int]
    merges: list[tuple[int, int, int]]  # left, right, merged, in order of rank
    specials: dict[str, int]
    word_end: str


@lru_cache(maxsize=4)
def load_vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    model = content["model"]
    ids, word_end = model["vocab"], model.get("end_of_word_suffix") or ""
    pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    made = [ids[a + b] for a, b in pairs]
    if len(set(made)) < len(made):
        raise ValueError("a symbol is made by two merges: their order would not decide the result alone")
    return Vocabulary(
        ids, [(ids[a], ids[b], w) for (a, b), w in zip(pairs, made)],
        {t["content"]: t["id"] for t in content["added_tokens"]}, word_end,
    )
