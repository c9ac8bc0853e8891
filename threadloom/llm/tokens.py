"""Tokens of a byte-level vocabulary, and places where a text may be cut without changing them.

The vocabulary's rank file is a parameter. Ids are those of the public 50k byte-level
vocabulary, whose one special token is an id of its own also where its string stands in a text.
"""

import base64
import os
from functools import lru_cache

import numpy as np

#: Texts are encoded in blocks of at least this many bytes, so memory follows the block.
BLOCK = 1 << 16
#: The special token of the vocabulary. Its string holds no white space, so no cut splits it.
SPECIAL = "<|endoftext|>"
SPECIAL_ID = 50256
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 13, 32]] = True
#: A byte that may end a white-space character: ASCII ones, and all continuation bytes.
_MAY_END_WHITE = np.zeros(256, bool)
_MAY_END_WHITE[[*range(9, 14), *range(28, 33)]] = True
_MAY_END_WHITE[128:] = True


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=4)
def encoder(path: str):
    """A function from text to ids, one per process."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding(
        os.path.basename(path), pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={SPECIAL: SPECIAL_ID}
    )


@lru_cache(maxsize=4)
def token_sizes(path: str) -> np.ndarray:
    """Bytes of each token."""
    values = encoder(path).token_byte_values()
    enc = encoder(path)
    sizes = np.zeros(enc.n_vocab, np.int64)
    for value in values:
        sizes[enc.encode_single_token(value)] = len(value)
    sizes[SPECIAL_ID] = len(SPECIAL)
    return sizes


def ids_of(text: str, path: str) -> list[int]:
    """The ids of a piece of text, with the special token where its string stands."""
    return encoder(path).encode(text, allowed_special={SPECIAL}, disallowed_special=())


def cuts(text: bytes) -> np.ndarray:
    """Offsets where a run of white space begins: no token crosses them, whatever stands around.

    The pattern's pieces never hold white space after another character, and look no further
    back; so the text before such an offset and the text after it are encoded apart. Beside a
    character that may itself be white space no offset is given, which only makes pieces longer.
    """
    b = np.frombuffer(text, np.uint8)
    if len(b) < 2:
        return np.zeros(0, np.int64)
    at = np.flatnonzero(_WHITE[b[1:]]) + 1
    before = b[at - 1]
    safe = ~_MAY_END_WHITE[before]
    two = (before >= 128) & (at >= 2)
    lead = b[np.maximum(at - 2, 0)]
    return at[safe | (two & (lead >= 0xC3) & (lead <= 0xDF))]


def begins_white(left: bytes) -> bool:
    """Whether ``cuts`` has the end of ``left`` when white space follows."""
    return not _MAY_END_WHITE[left[-1]] or (left[-1] >= 128 and len(left) > 1 and 0xC3 <= left[-2] <= 0xDF)


def blocks(text: bytes, size: int = BLOCK) -> list[bytes]:
    """The text in pieces of ``size`` bytes or more (until the next safe offset)."""
    if len(text) <= size:
        return [text]
    safe = cuts(text)
    out, start = [], 0
    while len(text) - start > size:
        k = np.searchsorted(safe, start + size)
        if k == len(safe):
            break
        out.append(text[start : safe[k]])
        start = int(safe[k])
    return [*out, text[start:]]


def encode(text: bytes, path: str) -> np.ndarray:
    """The ids of a text."""
    parts = [np.array(ids_of(b.decode(), path), np.uint32) for b in blocks(text)]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)
