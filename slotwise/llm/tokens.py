"""Token ids of whole texts, word by word.

The tokenizers library defines the ids. Encoding whole texts with it costs too
much here, so ids are kept per white-space-separated chunk: the vocabulary's
pre-tokenizer never joins characters across white space, so a text's ids are its
chunks' ids in a row. Chunks of printable Latin-1 characters are merged by
tiktoken from the same merge table. The two agree when every merge of the table
is what the table itself makes of the merged text (``merges_are_reachable``,
checked by a test for the vocabulary used): whenever two neighbours form a known
token, they are then the pair the table names. All other chunks, and special
tokens, go to the tokenizers library.
"""

from __future__ import annotations

import json
import re
import sys
from array import array

#: Most chunks whose ids a Python worker remembers; then it starts afresh.
CACHE_CHUNKS = 500_000
END = b"\xff"  # never a byte of UTF-8: stands for the vocabulary's end-of-word mark
PLAIN = re.compile("[!-~¡-ÿ]+")
# the vocabulary's pre-tokenizer, with the letters and digits of printable Latin-1 spelled out
LETTERS, DIGITS = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾"
PRE_TOKENS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{DIGITS}]|[^{LETTERS}{DIGITS}]+")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_of_symbol() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 characters stand for themselves, the rest follow from 256 on."""
    kept = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = [b for b in range(256) if b not in set(kept)]
    return {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(other)}


def merges_of(model: dict) -> list[tuple[str, str]]:
    return [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]


def merges_are_reachable(path: str) -> bool:
    """Whether applying earlier merges to each merge's text leaves exactly the pair that it joins."""
    model = json.load(open(path, encoding="utf-8"))["model"]
    suffix, merges = model["end_of_word_suffix"], merges_of(model)
    rank = {m: i for i, m in enumerate(merges)}
    for i, pair in enumerate(merges):
        text = "".join(pair)
        parts = list(text.removesuffix(suffix))
        if text.endswith(suffix):
            parts[-1] += suffix
        while len(parts) > 2:
            r, k = min((rank.get(p, len(merges)), k) for k, p in enumerate(zip(parts, parts[1:])))
            if r >= i:
                break
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        if tuple(parts) != pair:
            return False
    return True


class ChunkIds(dict):
    """``chunk bytes -> its ids as little-endian unsigned 32-bit integers``, filled on demand."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        super().__init__()
        spec = json.load(open(path, encoding="utf-8"))
        self.slow = Tokenizer.from_file(path)
        model = spec["model"]
        vocab, suffix, to_byte = model["vocab"], model["end_of_word_suffix"], byte_of_symbol()

        def raw(token: str) -> bytes:
            body = bytes(to_byte[c] for c in token.removesuffix(suffix))
            return body + END if token.endswith(suffix) else body

        # single bytes, then bytes that end a word, then the merges in their order
        ranks = {bytes([b]): b for b in range(256)} | {bytes([b]) + END: 256 + b for b in range(256)}
        self.ids = [0] * 512
        for c, b in to_byte.items():
            self.ids[b], self.ids[256 + b] = vocab[c], vocab[c + suffix]
        for a, b in merges_of(model):
            ranks[raw(a + b)] = len(self.ids)
            self.ids.append(vocab[a + b])
        self.merge = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece

    def __missing__(self, chunk: bytes) -> bytes:
        if len(self) >= CACHE_CHUNKS:
            self.clear()
        text = chunk.decode("utf-8")
        if PLAIN.fullmatch(text) and "<|" not in text:
            text, rank_ids = text.lower(), self.ids
            words = (text,) if text.isalpha() else PRE_TOKENS.findall(text)
            packed = array("I", [rank_ids[r] for w in words for r in self.merge(w.encode() + END)])
        else:
            packed = array("I", self.slow.encode(text, add_special_tokens=False).ids)
        if sys.byteorder == "big":
            packed.byteswap()
        packed = packed.tobytes()
        if len(chunk) <= 64:
            self[chunk] = packed
        return packed


_LOADED: dict[str, ChunkIds] = {}


def chunk_ids(path: str) -> ChunkIds:
    """The worker's table for a vocabulary file; Python workers outlive tasks and keep it."""
    if path not in _LOADED:
        _LOADED[path] = ChunkIds(path)
    return _LOADED[path]


def packed_ids(text: str, ids: ChunkIds) -> bytes:
    """All ids of a text, four bytes each. Lone surrogates cannot occur in a Spark string."""
    return b"".join(map(ids.__getitem__, text.encode("utf-8").split()))
