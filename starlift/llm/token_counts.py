"""Token counts: overlap resynchronisation of huge documents.

Texts up to CHUNK characters are encoded whole. A longer one is encoded in chunks that reach OVERLAP characters over
each cut, with the offset of every token. Around a cut both chunks list their token starts that are proven stable,
and the last start that both have splices them: tokens before it count from the left chunk, the others from the
right one. Where none agrees, the overlap is widened (doubled) and both chunks are encoded again.

Proof of stability: a place with a letter before it and a single space and a letter after it. The splitting pattern
has no alternative that takes a letter and then a space, so a piece ends there whatever came before; ``" ?\\p{L}+"``
starts there whatever comes after; merges never leave a piece, and a special string holds no space.

Memory is that of one chunk. Defined results: null text counts as empty with 0 tokens; special strings inside texts
become one special token as the library does by default; repeated rows give repeated results.
"""

from __future__ import annotations

import base64
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlift.llm.common import texts

CHUNK = 1 << 15
OVERLAP = 256
LIMIT = 1024

_STABLE = regex.compile(r"(?<=\p{L})(?= \p{L})")
#: How the vocabulary file's byte-level splitter cuts a text before merging (fixed value).
_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def vocabulary_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _bytes_of_symbols() -> dict[str, int]:
    """The printable stand-in of each byte in a byte-level vocabulary, by its published rule."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@lru_cache(maxsize=2)
def encoding(path: str):
    """The vocabulary file's ranks and special tokens as a fast encoder (one per Python worker).

    Ranks must equal merge order for the two engines to agree; that is checked once here on the file itself.
    """
    import tiktoken
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, back = spec["model"], _bytes_of_symbols()
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(back[c] for c in s): i for s, i in model["vocab"].items() if s not in special}
    merged = [("".join(m) if isinstance(m, list) else m.replace(" ", "")) for m in model["merges"]]
    ids = [model["vocab"][m] for m in merged]
    if any(a >= b for a, b in zip(ids, ids[1:])) or model["type"] != "BPE":
        raise ValueError("ids of the vocabulary don't follow its merges")
    return tiktoken.Encoding(name=path, pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens=special)


def encode(enc, text: str) -> list[int]:
    return enc.encode(text, allowed_special="all")


def _starts(enc, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Token ids and the character offset at which each token starts (-1 inside a character)."""
    ids = encode(enc, text)
    sizes = np.fromiter((len(enc.decode_single_token_bytes(i)) for i in ids), np.int64, len(ids))
    at = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(ids) else np.zeros(0, np.int64)
    raw = np.frombuffer(text.encode(), np.uint8)
    char = np.where((raw & 0xC0) != 0x80, np.cumsum((raw & 0xC0) != 0x80) - 1, -1)
    return np.asarray(ids, np.int64), char[at] if len(at) else at


def _stable(text: str, lo: int, hi: int) -> set[int]:
    return {m.start() for m in _STABLE.finditer(text, max(0, lo), min(len(text), hi + 2)) if lo <= m.start() < hi}


def count_tokens(enc, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of the whole text; equal to encoding it at once."""
    if len(text) <= chunk:
        return len(encode(enc, text))
    total, left, cut = 0, 0, chunk
    while True:
        if cut >= len(text):
            return total + len(encode(enc, text[left:]))
        wide = overlap
        while True:
            lo, hi = max(left + 1, cut - wide), min(len(text), cut + wide)
            stable = _stable(text, lo, hi)
            if stable:
                _, a = _starts(enc, text[left:hi])
                _, b = _starts(enc, text[lo - 1:min(len(text), hi + wide)])
                both = stable & set((a + left).tolist()) & set((b + lo - 1).tolist())
                if both:
                    break
            if lo <= left + 1 and hi >= len(text):
                return total + len(encode(enc, text[left:]))
            wide *= 2
        at = max(both)  # the farthest: a widened overlap still moves on
        total += int(np.searchsorted(np.maximum.accumulate(a), at - left))
        left, cut = at, at + chunk


def _counter(path: str, chunk: int, overlap: int):
    def run(batches):
        enc = encoding(path)
        for b in batches:
            col = b.column("text")
            n = [count_tokens(enc, t, chunk, overlap) for t in (x.as_py() for x in col)]
            size = pc.cast(pc.binary_length(col), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), size, pa.array(n, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])
    return run


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row; no shuffle."""
    out = texts(docs).mapInArrow(_counter(path, chunk, overlap), "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
