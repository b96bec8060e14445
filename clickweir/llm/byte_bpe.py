"""Token ids of a byte-level BPE file, as numpy arrays.

The file's merges become a table of ranks for `tiktoken`, several times as fast as the general tokenizer. Both
give the same ids if the merges make the ids in order and every token's own bytes encode to that token: a
merge of a rank then finds its bytes cut in the same two parts by the ranks before it, whatever stands around them.
Files of another kind, and texts that the pattern matcher gives up on, go through the general tokenizer.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np

# Fixed value: the word pattern of the byte-level pre-tokenizer.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PIECE_CHARS = 1 << 20      # longer texts are encoded in pieces, which bounds the memory of a call


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level token stands for: itself if it prints, else one past 255."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(prints)]
    return {chr(b): b for b in prints} | {chr(256 + n): b for n, b in enumerate(others)}


def token_bytes(tokenizer_json: str) -> list[bytes]:
    """The bytes of every id of the file's model; added tokens as their text."""
    data, byte = json.loads(tokenizer_json), byte_of_char()
    added = {t["id"]: t["content"].encode() for t in data.get("added_tokens", [])}
    out = [b""] * (1 + max([*data["model"]["vocab"].values(), *added]))
    for token, i in data["model"]["vocab"].items():
        out[i] = added[i] if i in added else bytes(byte[c] for c in token)
    for i, content in added.items():
        out[i] = content
    return out


def ranks(tokenizer_json: str) -> dict[bytes, int] | None:
    """Bytes to ids, if the file is a plain byte-level BPE whose merges make the ids from 256 on in order."""
    data = json.loads(tokenizer_json)
    model, before = data["model"], data.get("pre_tokenizer") or {}
    if model.get("type", "BPE") != "BPE" or before.get("type") != "ByteLevel" or data.get("normalizer") or before.get("add_prefix_space") \
            or not before.get("use_regex", True) or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
        return None
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    if any(model["vocab"].get(a + b) != 256 + n for n, (a, b) in enumerate(merges)):
        return None
    table = token_bytes(tokenizer_json)[:256 + len(merges)]
    out = {b: i for i, b in enumerate(table)}
    return out if len(out) == len(table) and all(len(b) == 1 for b in table[:256]) else None


class ByteBpe:
    """`ids(text)` as an array of unsigned 32-bit ids; strings of special tokens are ordinary text."""

    def __init__(self, tokenizer_json: str):
        self.tokenizer_json, self.general = tokenizer_json, None
        table = ranks(tokenizer_json)
        if table is None:
            self.fast = None
        else:
            import tiktoken

            self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})

    def _piece(self, text: str) -> np.ndarray:
        if self.fast is not None:
            try:
                return np.asarray(self.fast.encode_to_numpy(text, disallowed_special=()), dtype="<u4")
            except ValueError:      # the pattern matcher's stack is bounded
                pass
        if self.general is None:
            from tokenizers import Tokenizer

            self.general = Tokenizer.from_str(self.tokenizer_json)
            self.general.encode_special_tokens = True
        return np.array(self.general.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def ids(self, text: str) -> np.ndarray:
        """A long text of ranks is cut where one space stands between two other characters that are no
        white space: a token always begins there."""
        if self.fast is None or len(text) <= PIECE_CHARS:
            return self._piece(text)
        return np.concatenate([self._piece(p) for p in pieces(text, PIECE_CHARS)])


def pieces(text: str, chars: int) -> list[str]:
    """`text` cut before single spaces into pieces of about so many characters, longer where there are none."""
    out, at = [], 0
    while len(text) - at > chars:
        cut = text.find(" ", at + chars)
        while cut >= 0 and (text[cut - 1].isspace() or text[cut + 1:cut + 2].isspace()):
            cut = text.find(" ", cut + 1)
        if cut < 0 or cut + 1 == len(text):
            break
        out.append(text[at:cut])
        at = cut
    return [*out, text[at:]]


@lru_cache(maxsize=2)
def shared(tokenizer_json: str) -> ByteBpe:
    """One encoder per file and worker; it keeps nothing of the texts."""
    return ByteBpe(tokenizer_json)
