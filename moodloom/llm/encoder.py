"""Token ids of many texts by the tokenizers library, each different word encoded once per worker.

A byte-level BPE file splits a text by a fixed pattern and encodes each piece by itself, so the ids
of a piece may be remembered. Only texts of characters whose class no Unicode version has changed
are split here; all others, and texts that hold an added token, go to the library whole.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Sequence
from functools import lru_cache
from itertools import islice

import numpy as np

# Letters of the characters that are split here: Latin, Cyrillic, kana, Han and Hangul.
LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f\u0400-\u045f\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3"
# All of those characters: the letters, tab, line feed, ASCII, dashes and quotation marks.
PLAIN = re.compile(
    f"[{LETTERS}\t\n\x20-\x7e\xa1-\xa9\xab\xac\xae-\xb1\xb4\xb6-\xb8\xbb\xbf\xd7\xf7\u2010-\u2027]*"
)
# Fixed value: how byte-level BPE files with ``use_regex`` split a text, for those characters.
PIECES = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[0-9]+| ?[^\s{LETTERS}0-9]+|\s+(?!\S)|\s+"
)
# Words remembered by a worker, some hundred bytes each; beyond it a batch keeps its new words to itself.
KEPT_WORDS = 700_000
# Words that a worker keeps from one task to the next. They are those it learnt first, so the frequent ones are among them. Short tasks
# leave more workers waiting than there are cores, and each of them holds its words.
WAITING_WORDS = 400_000
# Words remembered where other stages of a job have filled the memory before.
FEW_WORDS = 200_000
WORDS_AT_ONCE = 512


class Encoder:
    """``encode(texts)`` gives the ids of each text as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, kept_words: int = KEPT_WORDS) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has one task per core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        before = spec["pre_tokenizer"] or {}
        self.by_words = (
            spec["normalizer"] is None
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space", True)
            and spec["model"]["type"] == "BPE"
            and not spec["model"].get("dropout")
        )
        self.added = [token["content"] for token in spec["added_tokens"]]
        self.kept_words = kept_words
        self.known: dict[str, bytes] = {}

    def is_plain(self, text: str) -> bool:
        return (
            self.by_words
            and PLAIN.fullmatch(text) is not None
            and not any(token in text for token in self.added)
        )

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        split = [PIECES.findall(text) if self.is_plain(text) else None for text in texts]
        fresh = set().union(*(words for words in split if words)).difference(self.known)
        if fresh:
            self.learn(list(fresh))
        ids_of = self.known.__getitem__
        ids = [
            self.whole(text) if words is None else b"".join(map(ids_of, words))
            for text, words in zip(texts, split)
        ]
        if len(self.known) > self.kept_words:
            for word in fresh:
                del self.known[word]
        return ids

    def trim(self, words: int = WAITING_WORDS) -> None:
        """Forget all words but the ``words`` learnt first; called at the end of a task."""
        if len(self.known) > words:
            self.known = dict(islice(self.known.items(), words))

    def whole(self, text: str) -> bytes:
        encoded = self.library.encode(text, add_special_tokens=False)
        return np.array(encoded.ids, "<u4").tobytes()

    def learn(self, words: list[str]) -> None:
        """Words that begin with one space stay apart when joined, which spares calls."""
        spaced = [w for w in words if w[0] == " " and w[1:2].strip()]
        single = [w for w in words if not (w[0] == " " and w[1:2].strip())]
        groups = [spaced[i : i + WORDS_AT_ONCE] for i in range(0, len(spaced), WORDS_AT_ONCE)]
        joined = self.library.encode_batch(["".join(g) for g in groups], add_special_tokens=False)
        for group, encoded in zip(groups, joined):
            ids = np.array(encoded.ids, "<u4").tobytes()
            counts = np.bincount(np.array(encoded.word_ids, "i8"), minlength=len(group))
            if len(counts) != len(group):
                single += group
                continue
            ends = (np.cumsum(counts) * 4).tolist()
            self.known.update(
                (word, ids[start:end]) for word, start, end in zip(group, [0, *ends], ends)
            )
        encoded = self.library.encode_batch(single, add_special_tokens=False)
        self.known.update((w, np.array(e.ids, "<u4").tobytes()) for w, e in zip(single, encoded))


@lru_cache(maxsize=2)
def encoder(path: str, kept_words: int = KEPT_WORDS) -> Encoder:
    """One encoder per worker process, file and number of words kept."""
    return Encoder(path, kept_words)
