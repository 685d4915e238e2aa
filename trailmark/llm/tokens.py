"""Token ids of whole texts with a public vocabulary.

tiktoken applies the vocabulary (the same merges as the tokenizers file, as tests check); a text that it
refuses is encoded by tokenizers.
"""

from __future__ import annotations

import base64
import json
import re
from functools import lru_cache

import numpy as np

VOCABULARY, TOKENIZER = "byte_bpe_50k.tiktoken", "byte_bpe_50k.json"


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(2)
def _encoder(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(2)
def _fallback(path: str):
    """tokenizers' own encoder, which takes strings of special tokens for ordinary text."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t


@lru_cache(2)
def _special(path: str) -> tuple[dict[str, int], re.Pattern]:
    """The added tokens of a tokenizers file, and what splits a text at their strings (the longest first)."""
    with open(path, encoding="utf-8") as f:
        ids = {x["content"]: x["id"] for x in json.load(f)["added_tokens"]}
    return ids, re.compile("|".join(re.escape(s) for s in sorted(ids, key=len, reverse=True)) or "(?!)")


@lru_cache(2)
def _table(path: str) -> dict[int, bytes]:
    with open(path, "rb") as f:
        return {int(b): base64.b64decode(a) for a, b in map(bytes.split, f)}


def encode(text: str, vocabulary: str = VOCABULARY, tokenizer: str = TOKENIZER, special: bool = False) -> list[int]:
    """Ids of a whole text. Strings of special tokens are ordinary text, or with special these tokens, as tokenizers has it: what stands between is encoded by itself."""
    path = vocabulary_path(tokenizer)
    if special:
        ids, pattern = _special(path)
        out, at = [], 0
        for m in pattern.finditer(text):
            out += [*(encode(text[at : m.start()], vocabulary, tokenizer) if m.start() > at else ()), ids[m.group()]]
            at = m.end()
        return out + encode(text[at:], vocabulary, tokenizer) if out else encode(text, vocabulary, tokenizer)
    try:
        return _encoder(vocabulary_path(vocabulary)).encode_ordinary(text)
    except BaseException as e:  # a Rust panic is no Exception
        if isinstance(e, (KeyboardInterrupt, SystemExit, MemoryError)):
            raise
        return _fallback(path).encode(text, add_special_tokens=False).ids


def encode_array(text: str, vocabulary: str = VOCABULARY, tokenizer: str = TOKENIZER, special: bool = False) -> np.ndarray:
    return np.array(encode(text, vocabulary, tokenizer, special), np.uint32)


def decode(ids, vocabulary: str = VOCABULARY) -> str:
    """The text of ids that encode gave."""
    table = _table(vocabulary_path(vocabulary))
    return b"".join([table[i] for i in ids]).decode("utf-8")
