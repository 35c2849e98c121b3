"""Ids of whole texts by a word-level BPE file of the ``tokenizers`` library, remembered word by word.

The file's steps are fixed values: NFC, white space to one space, lower case, split by ``WORDS`` with everything between the
matches removed, merges inside each match.  Words never merge with each other, so a worker hands every distinct word to the
library once, many in one text with spaces between them, and joins the remembered ids.  Texts with letters or digits beyond the
basic plane, where Unicode versions differ, and texts with special strings go to the library as they are.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import regex

# The split pattern of the file; and the same for texts within Latin-1, whose letters, digits and spaces are listed.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"
LATIN_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|[^a-zªµºß-öø-ÿ0-9²³¹¼½¾\t-\r \x85\xa0]+"

# Words a worker remembers; beyond it the memory starts anew, results stay the same.
MEMORY = 500_000

# Unknown words that go to the library in one text.
TOGETHER = 2000

# Characters of a text that are split at a time; cuts lie before white space only.
CHUNK = 1 << 20

_known: dict[str, dict[str, bytes]] = {}


def chunks(text: str, size: int = CHUNK) -> Iterator[str]:
    """Parts of a text of about ``size`` characters that begin with white space; a run without any stays whole."""
    at, space = 0, re.compile(r"\s")
    while len(text) - at > size:
        cut = space.search(text, at + size)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def encoder(path: str) -> Callable[[list[str]], list[bytes]]:
    """A function from texts to their ids, each as little-endian unsigned 32-bit integers."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has its core already
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    special = [t.content for t in library.get_added_tokens_decoder().values()]
    marks = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
    words, latin_words = regex.compile(WORDS).findall, re.compile(LATIN_WORDS).findall
    beyond = regex.compile(r"[[\U00010000-\U0010FFFF]&&[\p{L}\p{N}\p{M}]]", regex.V1).search
    known = _known.setdefault(path, {})
    vocabulary = library.get_vocab()
    last = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)  # ids that end a word
    last[[i for token, i in vocabulary.items() if token.endswith(library.model.end_of_word_suffix)]] = True
    pack = lambda ids: np.array(ids, dtype="<u4").tobytes()

    def split(part: str) -> list[str] | bytes:
        try:
            part.encode("latin-1")
            return latin_words(part.lower())
        except UnicodeEncodeError:
            pass
        if beyond(part) or (marks is not None and marks.search(part)):
            return pack(library.encode(part, add_special_tokens=False).ids)
        part = unicodedata.normalize("NFC", part)
        return words("".join(map(str.lower, part)) if "Σ" in part else part.lower())

    def pieces(text: str) -> Iterator[list[str] | bytes]:
        if marks is not None and marks.search(text):
            yield pack(library.encode(text, add_special_tokens=False).ids)
            return
        for part in chunks(text):
            yield split(part)

    def learn(words: list[str]) -> None:
        for i in range(0, len(words), TOGETHER):
            some = words[i : i + TOGETHER]
            ids = np.array(library.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, dtype="<u4")
            stops = np.flatnonzero(last[ids]) + 1
            if len(stops) != len(some):
                known.update((w, pack(library.encode(w, add_special_tokens=False).ids)) for w in some)
                continue
            raw, at = ids.tobytes(), [0, *(4 * stops).tolist()]
            known.update(zip(some, map(raw.__getitem__, map(slice, at, at[1:])), strict=True))

    def encode(texts: list[str]) -> list[bytes]:
        done: list[list[bytes]] = [[] for _ in texts]
        waiting: list[tuple[int, list[str] | bytes]] = []

        def finish() -> None:
            learn(list(set().union(*(part for _, part in waiting if not isinstance(part, bytes))).difference(known)))
            for i, part in waiting:
                done[i].append(part if isinstance(part, bytes) else b"".join(map(known.__getitem__, part)))
            waiting.clear()
            if len(known) > MEMORY:
                known.clear()

        size = 0
        for i, text in enumerate(texts):
            for part in pieces(text):
                waiting.append((i, part))
                size += len(part)
                if size > CHUNK:  # the words of about one chunk at a time become ids
                    finish()
                    size = 0
        finish()
        return [b"".join(parts) for parts in done]

    return encode
