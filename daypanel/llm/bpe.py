"""Byte-level byte-pair encoding of single pre-tokens from a rank file, as a small helper for tasks."""

from __future__ import annotations

import base64
import ctypes
import gc
import heapq
import json
from collections.abc import Callable

import pyarrow as pa
import regex

# The split pattern of the public rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Entries of a worker's memory of encoded pre-tokens; beyond it the memory starts anew, results stay the same.
MEMORY = 150_000

_memories: dict[str, dict] = {}


def memory(name: str, start: dict) -> dict:
    """What this worker remembers under a name; it outlives a task, and starts anew once it is full or another step asks."""
    if name not in _memories:
        forget()  # of the step before
    kept = _memories.setdefault(name, {})
    if not kept or len(kept) > MEMORY:
        kept.clear()
        kept.update(start)
    return kept


def forget() -> None:
    """Give back what this worker remembers and what its allocators hold, before a step that needs the space."""
    _memories.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library keeps what it has
        pass


def splitter() -> Callable[[str], list[str]]:
    """All pre-tokens of a text, in order; together they are the text.

    ``\\s`` is written out as the Unicode White_Space property, which the tokenizer libraries use.
    """
    space = r"\p{White_Space}"
    return regex.compile(PATTERN.replace(r"[^\s\p{L}\p{N}]", rf"[^{space}\p{{L}}\p{{N}}]").replace(r"\s+", rf"{space}+").replace(r"(?!\S)", rf"(?!\P{{White_Space}})")).findall


def tiktoken_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f.read().splitlines())}


def byte_letters() -> dict[str, int]:
    """The printable stand-ins of bytes that byte-level vocabularies are written in."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def tokenizer_json(path: str) -> tuple[dict[bytes, int], dict[bytes, int], dict[str, int]]:
    """Ids by token, merge ranks by merged token, and special strings of a byte-level ``tokenizer.json``."""
    with open(path, encoding="utf-8") as f:
        d = json.load(f)
    at = byte_letters()
    raw = lambda s: bytes(at[c] for c in s)
    ids = {raw(t): i for t, i in d["model"]["vocab"].items()}
    merges = [m.split(" ") if isinstance(m, str) else m for m in d["model"]["merges"]]
    ranks: dict[bytes, int] = {}
    for i, (a, b) in enumerate(merges):
        ranks.setdefault(raw(a) + raw(b), i)
    return ids, ranks, {t["content"]: t["id"] for t in d["added_tokens"]}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """Join the neighbours whose union has the lowest rank, leftmost first, until none has a rank."""
    if len(piece) > 48:
        return merge_long(piece, ranks)
    parts = [piece[i : i + 1] for i in range(len(piece))]
    pairs = [ranks.get(piece[i : i + 2], 1 << 60) for i in range(len(piece) - 1)]
    while pairs:
        low = min(pairs)
        if low == 1 << 60:
            break
        i = pairs.index(low)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], 1 << 60)
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], 1 << 60)
    return parts


def merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The same with a heap over a linked list: n log n for very long pre-tokens."""
    n = len(piece)
    end = list(range(1, n + 1))  # of the part that starts here; 0: no part starts here
    before = list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        mid = end[i]
        if not mid or mid >= n or not end[mid] or end[mid] != stop:
            continue
        end[i], end[mid] = stop, 0
        if stop < n:
            before[stop] = i
            if (r := ranks.get(piece[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (b := before[i]) >= 0 and (r := ranks.get(piece[b:stop])) is not None:
            heapq.heappush(heap, (r, b, stop))
    out, i = [], 0
    while i < n:
        out.append(piece[i : end[i]])
        i = end[i]
    return out
