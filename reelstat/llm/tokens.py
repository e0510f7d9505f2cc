"""Public byte-level BPE vocabularies, loaded once per worker process."""

from __future__ import annotations

import base64
import json
import os
from functools import lru_cache

import numpy as np

#: A tiktoken rank file by name in the public tokenizer folder, or by its path. Added tokens come from the tokenizers
#: file (.json) beside it, if there is one.
VOCABULARY = "byte_bpe_50k.tiktoken"
EMPTY = np.empty(0, np.uint32)


@lru_cache(maxsize=4)
def encoding(vocabulary: str = VOCABULARY, added: bool = False):
    """The tiktoken encoding of a rank file; its ids equal those that ``tokenizers`` gives with the JSON of
    the same vocabulary, without its added tokens (such strings being ordinary text) or with them."""
    import public_tokenizers
    import tiktoken

    path = vocabulary if os.path.isabs(vocabulary) else public_tokenizers.path(vocabulary)
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    special = added_tokens(os.path.splitext(path)[0] + ".json") if added else {}
    return tiktoken.Encoding(os.path.basename(path), pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


def added_tokens(path: str) -> dict[str, int]:
    """String -> id of the added tokens of a tokenizers file; none without the file."""
    if not os.path.exists(path):
        return {}
    with open(path, encoding="utf-8") as file:
        found = json.load(file)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in found):
        raise ValueError(f"added tokens that depend on their surroundings: {path}")
    return {t["content"]: t["id"] for t in found}


def encode(text: str | None, vocabulary: str = VOCABULARY) -> np.ndarray:
    """The ids of a whole text (null: none), strings of added tokens being ordinary text."""
    return encoding(vocabulary).encode_to_numpy(text, disallowed_special=()) if text else EMPTY


def encode_added(text: str | None, vocabulary: str = VOCABULARY) -> np.ndarray:
    """The ids of a whole text (null: none) as ``tokenizers`` gives them with add_special_tokens=False: the string of
    an added token has that token's id."""
    return encoding(vocabulary, True).encode_to_numpy(text, allowed_special="all") if text else EMPTY
