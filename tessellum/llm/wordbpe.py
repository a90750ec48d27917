"""Texts as chunks for a word-level BPE tokenizer, each distinct chunk handled once.

The tokenizer drops white space and splits between ASCII letters or digits and
ASCII punctuation, so a text's tokens are those of its chunks, end to end.
Apostrophes, controls and characters beyond ASCII never end a chunk: they may
take part in contractions, compositions or runs of other symbols.  The string of
a special token is a chunk of its own, and what stands beside it is split there.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np
import pandas as pd

from tessellum.llm import arrowtext as at

DEFAULT = "word_bpe_49k.json"
CACHE = 400_000  # chunks that a worker remembers


def resolve(name: str) -> str:
    """The path of a tokenizer file: a path, or the name of a public vocabulary file."""
    if os.path.exists(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def load(name: str):
    """(library tokenizer, parsed file) of a .json file whose chunks are independent."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    path = resolve(name)
    with open(path, encoding="utf-8") as f:
        parsed = json.load(f)
    model = parsed["model"]
    steps = (parsed.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    if model["type"] != "BPE" or not model.get("end_of_word_suffix") or steps[0].get("behavior") != "Removed":
        raise ValueError(f"{name}: a BPE with word ends that drops white space is needed")
    return Tokenizer.from_file(path), parsed


def specials(name: str) -> dict[bytes, int]:
    """The strings of the special tokens and their ids; others than those that stand for themselves are refused."""
    added = load(name)[1].get("added_tokens", [])
    if any(x.get("lstrip") or x.get("rstrip") or x.get("single_word") or x.get("normalized") for x in added):
        raise ValueError(f"{name}: a special token that takes in what stands beside it")
    return {x["content"].encode(): x["id"] for x in added}


def special_spans(block: at.TextBlock, found: dict[bytes, int]) -> list[tuple[int, int]]:
    """Byte spans of the special strings inside the texts of a block, leftmost first and not overlapping."""
    raw = block.data.tobytes()
    if not any(x in raw for x in found):
        return []
    pattern = re.compile(b"|".join(re.escape(x) for x in sorted(found, key=len, reverse=True)))
    near = np.unique([np.searchsorted(block.offsets, m.start(), "right") - 1 for x in found for m in re.finditer(re.escape(x), raw)])
    edges = [(int(block.offsets[i]), int(block.offsets[i + 1])) for i in near]
    return [m.span() for a, b in edges for m in pattern.finditer(raw, a, b)]


_SPACE, _LETTER, _SIGN, _GLUE = 0, 1, 2, 3
_CLASS = np.full(256, _GLUE, np.uint8)
_CLASS[[9, 10, 13, 32]] = _SPACE
for _c in range(0x21, 0x7F):
    _CLASS[_c] = _LETTER if chr(_c).isalnum() else _SIGN
_CLASS[0x27] = _GLUE


def chunks(block: at.TextBlock, special: dict[bytes, int] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, offsets) of the chunks of a block; offsets give each text's first chunk."""
    kind = _CLASS[block.data]
    begins = kind != _SPACE
    if len(kind) > 1:
        a, b = kind[:-1], kind[1:]
        begins[1:] &= (a != b) & ((a == _SPACE) | ((a != _GLUE) & (b != _GLUE)))
    edges = block.offsets[1:-1]
    edges = edges[edges < len(kind)]
    begins[edges] = kind[edges] != _SPACE
    for a, b in special_spans(block, special or {}):
        begins[a], begins[a + 1 : b] = True, False
        if b < len(kind):
            begins[b] = kind[b] != _SPACE
    starts = np.flatnonzero(begins)
    # a chunk ends where the next begins, or at white space or the text's end before that
    stop = np.zeros(len(kind) + 1, bool)
    stop[:-1] = kind == _SPACE
    stop[starts] = True
    stop[block.offsets[1:]] = True
    stops = np.flatnonzero(stop)
    ends = stops[np.searchsorted(stops, starts, "right")]
    return starts, ends, np.searchsorted(starts, block.offsets)


def distinct(block: at.TextBlock, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[int], np.ndarray]:
    """(code of each chunk, hash of each code, a chunk of each code)."""
    hashes = at.span_hashes(block.data, starts, ends)
    codes, unique = pd.factorize(hashes)
    sample = np.zeros(len(unique), np.int64)
    sample[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
    return codes, unique.tolist(), sample


def hashed(found: dict[bytes, int]) -> dict[int, int]:
    """The ids of special strings by the hash that `distinct` gives their chunk."""
    raw = b"".join(found)
    ends = np.cumsum([len(x) for x in found], dtype=np.int64)
    starts = ends - np.array([len(x) for x in found], np.int64)
    return dict(zip(at.span_hashes(np.frombuffer(raw, np.uint8), starts, ends).tolist(), found.values(), strict=True))


def strings(block: at.TextBlock, starts: np.ndarray, ends: np.ndarray) -> list[str]:
    raw = block.data.tobytes()
    return [raw[a:b].decode("utf-8", "replace") for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
