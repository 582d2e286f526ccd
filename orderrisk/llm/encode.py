"""Token ids of whole texts from the tokenizers library, with batches balanced by bytes.

A byte-pair tokenizer never merges across its own pre-token boundaries, so a text may be cut beside
single white-space characters without changing an id. Texts are cut there into words, each distinct
word of a batch goes to the library once, and a worker remembers a bounded number of words in flat arrays.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BATCH_BYTES = 1 << 23
REMEMBERED = 300_000
_TOGETHER = 512

# The white space of the tokenizers' patterns; Python's own class also holds four control characters.
_WS = "\t\n\x0b\x0c\r \x85\xa0  -     　"
# A space before a word belongs to it; of a longer run all but the last character form one piece.
_KEEPING = re.compile(f" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]").findall
_CUT = re.compile(f"(?<=[^{_WS}]) (?=[^{_WS}])")
_LOOSE = re.compile(f"[{_WS}]|.*[{_WS}]$|$", re.DOTALL).match
# Marks behind a letter or digit are a pre-token of their own.
_MARKS = ".,!|*#$%&"
_UP_TO_MARKS = f"(?s)^.*[^{_MARKS}]"
_BEFORE_MARKS = "[a-z0-9ß-öø-ÿ]$"


def segments(text: str, size: int = BATCH_BYTES) -> Iterator[str]:
    """``text`` cut before single spaces between words into parts of about ``size`` characters."""
    start = 0
    while len(text) - start > size:
        cut = _CUT.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def batches(texts: Iterable[str], size: int = BATCH_BYTES) -> Iterator[list[tuple[int, str]]]:
    """(index of the text, segment) in lists of about ``size`` characters each."""
    batch: list[tuple[int, str]] = []
    held = 0
    for index, text in enumerate(texts):
        for segment in segments(text, size):
            batch.append((index, segment))
            held += len(segment)
            if held >= size:
                yield batch
                batch, held = [], 0
    if batch:
        yield batch


class _Known:
    """Words and their ids in flat arrays, so that looking many words up makes no Python objects.

    When there are more than ``most`` words the half that was used last stays.
    """

    def __init__(self, most: int) -> None:
        self.most = most
        self.words = pa.array([], pa.large_string())
        self.starts = self.sizes = self.used = np.zeros(0, np.int64)
        self.flat = np.zeros(0, "<u4")
        self.turn = 0

    def find(self, words: pa.Array) -> np.ndarray:
        """The place of each word; -1 for an unknown one."""
        self.turn += 1
        found = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy().astype(np.int64)
        self.used[found[found >= 0]] = self.turn
        return found

    def add(self, words: pa.Array, flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Places of new words whose ids lie one after the other in ``flat``."""
        first = len(self.words)
        self.words = pa.concat_arrays([self.words, words])
        self.starts = np.concatenate((self.starts, len(self.flat) + np.cumsum(sizes) - sizes))
        self.sizes = np.concatenate((self.sizes, sizes))
        self.used = np.concatenate((self.used, np.full(len(sizes), self.turn)))
        self.flat = np.concatenate((self.flat, flat))
        return first + np.arange(len(sizes))

    def ids(self, places: np.ndarray) -> np.ndarray:
        size = self.sizes[places]
        return self.flat[np.repeat(self.starts[places] - np.cumsum(size) + size, size) + np.arange(size.sum())]

    def forget(self) -> None:
        if len(self.words) > self.most:
            kept = np.flatnonzero(self.used >= np.partition(self.used, -(self.most // 2))[-(self.most // 2)])
            self.flat = self.ids(kept)
            self.words, self.sizes, self.used = self.words.take(pa.array(kept)), self.sizes[kept], self.used[kept]
            self.starts = np.cumsum(self.sizes) - self.sizes


class Encoder:
    """One tokenizer file in one worker."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._special = re.compile("|".join(map(re.escape, special))).search if special else lambda text: None
        self._drops_space = not len(self._one(" "))
        self._folds = self._drops_space and self._one("Ab").tolist() == self._one("ab").tolist()
        self._mark = " 0 " if self._drops_space else "\n"
        self._mark_id = self._one(self._mark)
        self._known = _Known(REMEMBERED)

    def _one(self, text: str) -> np.ndarray:
        return self._library([text])[0]

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4") for x in found]

    def _many(self, words: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids and sizes of words: many in one call, with a mark between them that has one id of its own."""
        if len(self._mark_id) != 1:
            ids = self._library(words)
            return ids, [np.array([len(x) for x in ids], np.int64)]
        flat, sizes = [], []
        groups = [words[i : i + _TOGETHER] for i in range(0, len(words), _TOGETHER)]
        for group, ids in zip(groups, self._library([self._mark.join(g) for g in groups]), strict=True):
            between = ids == self._mark_id[0]
            cuts = np.flatnonzero(between)
            if len(cuts) == len(group) - 1:
                flat.append(ids[~between])
                sizes.append(np.diff(np.concatenate(([-1], cuts, [len(ids)]))) - 1)
            else:
                own = self._library(group)
                flat += own
                sizes.append(np.array([len(x) for x in own], np.int64))
        return flat, sizes

    def _learn(self, words: pa.Array) -> np.ndarray:
        """Places of distinct words among the known ones, which the new ones join."""
        words = words.cast(pa.large_string())
        found = self._known.find(words)
        new = np.flatnonzero(found < 0)
        if len(new):
            mark = self._mark.strip(" ")
            texts = words.take(pa.array(new)).to_pylist()
            # Words that hold the mark, or nothing, cannot stand between marks.
            odd = np.array([not w or mark in w for w in texts])
            for group, alone in ((new[~odd], False), (new[odd], True)):
                if len(group):
                    some = [w for w, x in zip(texts, odd.tolist(), strict=True) if x == alone]
                    ids = self._library(some) if alone else []
                    flat, sizes = (ids, [np.array([len(x) for x in ids], np.int64)]) if alone else self._many(some)
                    found[group] = self._known.add(words.take(pa.array(group)), np.concatenate(flat), np.concatenate(sizes))
        return found

    def _spelt(self, names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Places of distinct words whose white space and ASCII case do not count: of the letters, and of marks behind them or -1."""
        low = pc.ascii_lower(names)
        base = pc.ascii_rtrim(low, _MARKS)
        base = pc.if_else(pc.match_substring_regex(base, _BEFORE_MARKS), base, low)
        coded = base.dictionary_encode()
        letters = self._learn(coded.dictionary)[coded.indices.to_numpy()]
        marks = np.full(len(names), -1)
        marked = np.flatnonzero(pc.binary_length(base).to_numpy() < pc.binary_length(low).to_numpy())
        if len(marked):
            trails = pc.replace_substring_regex(low.take(pa.array(marked)), _UP_TO_MARKS, "").dictionary_encode()
            marks[marked] = self._learn(trails.dictionary)[trails.indices.to_numpy()]
        return letters, marks

    def _words(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The known word at each place, each segment's places, and which segments are loose.

        A loose segment holds white space of more than one character; its words are not used.
        """
        gap = " " if self._drops_space else " \n "
        split = pc.split_pattern(pc.replace_substring(pa.array(parts, pa.large_string()), "\n", gap), " ")
        coded = split.flatten().dictionary_encode()
        at = coded.indices.to_numpy().astype(np.int64)
        ends = split.offsets.to_numpy().astype(np.int64)
        loose = np.zeros(len(parts), bool)
        if self._folds:
            letters, marks = self._spelt(coded.dictionary)
            has = marks[at] >= 0
            last = np.cumsum(1 + has)
            places = np.empty(last[-1] if len(last) else 0, np.int64)
            places[last - 1 - has] = letters[at]
            places[last[has] - 1] = marks[at[has]]
            return places, np.concatenate(([0], last))[ends], loose
        if self._drops_space:
            return self._learn(coded.dictionary)[at], ends, loose
        names = coded.dictionary.to_pylist()
        # Any word but a segment's first and a line's first carries the space before it.
        firsts = [names[i] for i in at[ends[:-1]]]
        at[ends[:-1]] = np.arange(len(names), len(names) + len(parts))
        line = names.index("\n") if "\n" in names else -1
        bad = np.array([w != "\n" and _LOOSE(w) is not None for w in [*names, *firsts]])
        loose = np.add.reduceat(bad[at], ends[:-1]) > 0
        first = np.zeros(len(at), bool)
        first[1:] = at[:-1] == line
        first &= at < len(names)
        used, at = np.unique(at * 2 + (first | (at == line) | (at >= len(names))), return_inverse=True)
        spelt = [*names, *firsts]
        names = pa.array([spelt[u >> 1] if u & 1 else f" {spelt[u >> 1]}" for u in used.tolist()], pa.large_string()).dictionary_encode()
        return self._learn(names.dictionary)[names.indices.to_numpy()][at], ends, loose

    def _segments(self, parts: list[str], only_lengths: bool) -> list:
        self._known.forget()
        places, ends, loose = self._words(parts)
        total = np.concatenate(([0], np.cumsum(self._known.sizes[places])))[ends]
        if only_lengths:
            out = np.diff(total).tolist()
        else:
            flat = self._known.ids(places).tobytes()
            out = [flat[a * 4 : b * 4] for a, b in zip(total[:-1], total[1:], strict=True)]
        for i in np.flatnonzero(loose):
            words = pa.array(_KEEPING(parts[i]), pa.large_string()).dictionary_encode()
            places = self._learn(words.dictionary)[words.indices.to_numpy()]
            out[i] = int(self._known.sizes[places].sum()) if only_lengths else self._known.ids(places).tobytes()
        return out

    def _texts(self, texts: Iterable[str | None], only_lengths: bool) -> list:
        texts = [t or "" for t in texts]
        # A special string is matched before anything else, so a text that holds one stays whole.
        whole = {i: self._one(t).tobytes() for i, t in enumerate(texts) if self._special(t)}
        out: list = [0 if only_lengths else b""] * len(texts)
        for batch in batches("" if i in whole else t for i, t in enumerate(texts)):
            for (i, _), found in zip(batch, self._segments([s for _, s in batch], only_lengths), strict=True):
                out[i] += found
        for i, found in whole.items():
            out[i] = len(found) >> 2 if only_lengths else found
        return out

    def ids(self, texts: Iterable[str | None]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers; null counts as empty."""
        return self._texts(texts, False)

    def lengths(self, texts: Iterable[str | None]) -> list[int]:
        """Each text's number of ids; null counts as empty."""
        return self._texts(texts, True)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a file; loaded once and kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
