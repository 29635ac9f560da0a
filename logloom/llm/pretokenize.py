"""Vocabulary files and the split into pieces that byte-level BPE works on."""

from __future__ import annotations

import base64
import json
import re
from functools import lru_cache

import public_tokenizers
import regex
import tiktoken


@lru_cache(maxsize=4)
def ranks_of(path: str) -> dict[bytes, int]:
    """Token bytes to rank, of a .tiktoken file or a byte-level .json one."""
    with open(path, "rb") as file:
        if not path.endswith(".json"):
            return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        spec = json.load(file)
    added = {x["content"] for x in spec.get("added_tokens", [])}
    to_byte = _printable_bytes()
    return {bytes(to_byte[c] for c in token): rank for token, rank in spec["model"]["vocab"].items() if token not in added}


@lru_cache(maxsize=4)
def added_tokens(path: str) -> dict[str, int]:
    """Tokens that a .json file adds to its vocabulary; a .tiktoken file has none."""
    if not path.endswith(".json"):
        return {}
    with open(path, "rb") as file:
        return {x["content"]: x["id"] for x in json.load(file).get("added_tokens", [])}


def _printable_bytes() -> dict[str, int]:
    """Byte-level files write each byte as a printable character: itself where it
    is printable Latin-1, otherwise the next free one from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    moved = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}


@lru_cache(maxsize=4)
def encoder(path: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks_of(path), special_tokens=added_tokens(path))


#: The public pattern for texts in which letters, digits and blanks are what the
#: standard library takes them for: the same alternatives, tried twice as fast.
_PLAIN = re.compile(r" ?[^\W\d_]+|'(?:[stmd]|re|ve|ll)| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
_FULL = regex.compile(public_tokenizers.PATTERN)
#: Letters of the Latin and Greek blocks up to U+052F (but the signs below U+00C0) and general
#: punctuation are classed alike by both libraries; any other character takes the full pattern.
_OTHER = re.compile("[^\t-\r -\x7e¡§«»¿-ͷЀ-ҁҊ-ԯ‐-‧‰-⁞]")


def pieces_of(text: str) -> list[str]:
    """What public_tokenizers.PATTERN finds in the text, in order."""
    return _FULL.findall(text) if _OTHER.search(text) else _PLAIN.findall(text)
