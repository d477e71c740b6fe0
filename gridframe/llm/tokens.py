"""Encoding of texts by public tokenizer files, through worker caches of words.

Both tokenizer files split a text into pre-tokens before they merge bytes, and
never merge across white space. So a text's ids are its words' ids, one after the
other, and a word that a worker has met needs no merging again. A cache has two
generations: when the young one is full it becomes the old one, and words met
again move back. That bounds its memory and keeps frequent words. The texts
of a column are cut and put together in Arrow: Python sees distinct words only.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of a worker's cache of words.
CACHE_BYTES = 64 << 20
#: Letters of one pre-token, and a run of marks after them, which is another.
SIMPLE = re.compile(r"(?P<core>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<tail>[.,;:!?#$%&*]*)")


class Cache:
    """A map in two generations, which together hold about `limit` bytes."""

    def __init__(self, limit: int) -> None:
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.size, self.new, self.old = 0, {}, {}

    def turn(self) -> None:
        if self.size > self.limit // 2:
            self.old, self.new, self.size = self.new, {}, 0

    def put(self, key: str, value, bytes_: int) -> None:
        self.new[key] = value
        self.size += bytes_

    def put_all(self, values: dict, bytes_: int) -> None:
        """Keeps values that take so many bytes together."""
        self.new.update(values)
        self.size += bytes_


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class WordEncoder:
    """Ids of whole texts by a tokenizer file that drops white space and marks each pre-token's last id."""

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES) -> None:
        self.tokenizer = load(path)
        self.cores = Cache(cache_bytes)
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True

    @staticmethod
    def _bytes(words: Iterable[str], n: int) -> int:
        """About what n words, their ids and their places in a cache take."""
        return 4 * sum(map(len, words)) + 150 * n

    def _learn_cores(self, cores: list[str]) -> None:
        """Encodes pure-letter words together: each is one pre-token, so the end marks part their ids."""
        old = self.cores.old
        todo = set(cores).difference(self.cores.new)
        known = {c: old[c] for c in todo if c in old} if old else {}
        self.cores.put_all(known, self._bytes(known, len(known)))
        words = list(todo.difference(known))
        if not words:
            return
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u2")
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(words):
            raise AssertionError("a word of letters gave more than one pre-token")
        raw, stops = ids.tobytes(), (2 * ends).tolist()
        self.cores.put_all({c: raw[at:stop] for c, at, stop in zip(words, [0, *stops], stops)}, self._bytes(words, len(words)))

    def _alone(self, words: pa.Array) -> pa.Array:
        """The ids of each of the words, as bytes."""
        found = self.tokenizer.encode_batch_fast(words.to_pylist(), add_special_tokens=False) if len(words) else []
        return pa.array([np.array(x.ids, "<u2").tobytes() for x in found], pa.large_binary())

    def _words_ids(self, words: pa.Array) -> pa.Array:
        """The ids, as bytes, of distinct chunks without white space that parts them: a word's letters are encoded once, whatever marks follow."""
        none = pa.scalar(b"", pa.large_binary())
        parts = pc.extract_regex(words, f"^{SIMPLE.pattern}$")
        simple = parts.is_valid()
        parts = parts.filter(simple)
        core, tail = pc.utf8_lower(parts.field("core")).dictionary_encode(), parts.field("tail").dictionary_encode()
        cores = core.dictionary.to_pylist()
        self._learn_cores(cores)
        cores = pa.array(list(map(self.cores.new.__getitem__, cores)), pa.large_binary())
        joined = pc.binary_join_element_wise(cores.take(core.indices), self._alone(tail.dictionary).take(tail.indices), none)
        rest = self._alone(words.filter(pc.invert(simple)))
        place = np.argsort(~simple.to_numpy(zero_copy_only=False), kind="stable")
        back = np.empty(len(place), np.int64)
        back[place] = np.arange(len(place))
        return pa.concat_arrays([joined, rest]).take(pa.array(back))

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a column, one text's after the other's, and where each text's end. Null counts as empty."""
        self.cores.turn()
        chunks = pc.split_pattern(pc.replace_substring(pc.fill_null(column, ""), "\n", " "), " ")
        words = chunks.flatten().dictionary_encode()
        found = self._words_ids(words.dictionary).take(words.indices)
        ends = np.frombuffer(found.buffers()[1], np.int64)[chunks.offsets.to_numpy()[1:]] // 2
        return np.frombuffer(found.buffers()[2] or b"", "<u2", int(ends[-1]) if len(ends) else 0), ends

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Each text's ids."""
        ids, ends = self.encode_column(pa.array(texts, pa.string()))
        return np.split(ids, ends[:-1])

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def forget_words(self) -> None:
        self.cores.clear()


_ENCODERS: dict[str, WordEncoder] = {}


def word_encoder(path: str, cache_bytes: int = CACHE_BYTES) -> WordEncoder:
    """This process's encoder for a file; it lives as long as the worker, or until `forget_encoders`."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path, cache_bytes)
    return _ENCODERS[path]


def forget_encoders() -> None:
    _ENCODERS.clear()


def forget_words() -> None:
    """Empties the encoders' caches; the tokenizers stay."""
    for e in _ENCODERS.values():
        e.forget_words()
