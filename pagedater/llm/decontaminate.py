"""Benchmark passages in documents, unchanged or edited.

Texts are sequences of lower-cased words. A window as long as a benchmark item is embedded
by CGK random walks: a pointer reads the window's word, writes it, and moves on or stays by
a random bit of the step and the word, so that an edit only disturbs the output until the
walks of item and window meet again, and edit distance turns into Hamming distance. Samples
of a few output places are the keys of a locality-sensitive hash; walks and samples are
repeated until an item at the allowed edit rate is met with the target recall. What
collides is verified exactly: an occurrence is a stretch of words whose edit distance from
the item is at most the rate times the item's words.

Windows are read at every word, but embedded only where they may match: an item of n words
with e edits keeps at least n - 2 - 3 e of its three-word runs, so windows with fewer runs
of any item are out, without loss.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagedater.llm.common import picked

EDIT_RATE = 0.2
RECALL = 0.99
#: Walks, and how many output places a key samples of one.
WALKS = 8
SAMPLED = 3
#: Share of equal output places at the full edit rate that repetitions are planned for.
AGREEMENT = 0.45
#: Items of fewer words than this must occur unchanged; those under three words are not sought.
EDITABLE = 8
#: Bytes of items that a task holds at once; more items are searched in blocks.
BLOCK_BYTES = 4 * 1024 * 1024

WORD = re.compile(r"\w+")
FOUND = "doc_id long, item_id long, start long, end long, edits int, item_words int"
TABLE_BITS = 22
WINDOWS_AT_ONCE = 4096


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer, over arrays."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def scores(item: list[int], words: list[int], low: int, high: int) -> Iterator[tuple[int, int]]:
    """(end, edits) for every end of a stretch of ``words[low:high]``: edits of the closest one.

    Myers' bit-parallel scan; the whole item must be spent, the stretch may begin anywhere
    from ``low`` on.
    """
    n = len(item)
    masks: dict[int, int] = defaultdict(int)
    for i, word in enumerate(item):
        masks[word] |= 1 << i
    full, top = (1 << n) - 1, 1 << (n - 1)
    up, down, score = full, 0, n
    for j in range(low, high):
        eq = masks.get(words[j], 0)
        diagonal = (((eq & up) + up) ^ up) | eq | down
        plus = down | ~(diagonal | up) & full
        minus = up & diagonal
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus, minus = (plus << 1) & full, (minus << 1) & full
        up = minus | ~(diagonal | plus) & full
        down = plus & diagonal
        yield j + 1, score


def stretches(item: list[int], edits: int, words: list[int], low: int, high: int) -> Iterator[tuple[int, int, int]]:
    """(start, end, edits) of stretches of ``words[low:high]`` within ``edits`` of ``item``.

    Stretches do not overlap; of those that do the closest one is taken, the first of equals,
    and what it leaves free on its left is searched too. Behind an end that is close enough
    only as many words are read as an overlapping stretch can have, and the search goes on
    behind the stretch taken: the time is in proportion to the words, however often the item
    recurs.
    """
    reach = len(item) + edits
    while high - low >= len(item) - edits:
        first, best, end = None, edits + 1, low
        for at, score in scores(item, words, low, high):
            if score < best:
                first = at if first is None else first
                best, end = score, at
            if first is not None and at >= first + reach:
                break
        if first is None:
            return
        back = words[max(low, end - reach) : end][::-1]
        length = min((score, size) for size, score in scores(item[::-1], back, 0, len(back)))[1]
        start = end - length
        yield from stretches(item, edits, words, max(low, first - reach), start)
        yield start, end, best
        low = end


class Items:
    """Benchmark items, prepared to be sought in texts."""

    def __init__(
        self, items: list[tuple[int, str | None]], rate: float = EDIT_RATE, recall: float = RECALL, seed: int = 11
    ) -> None:
        self.vocabulary: dict[str, int] = {}
        self.items: list[tuple[int, list[int], int]] = []
        of_length = defaultdict(list)
        for item_id, text in items:
            words = WORD.findall((text or "").lower())
            if len(words) < 3:
                continue
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            of_length[len(ids)].append(len(self.items))
            self.items.append((item_id, ids, math.floor(rate * len(ids)) if len(ids) >= EDITABLE else 0))
        self.pad = len(self.vocabulary) + 1
        samples = math.log(1 - recall) / math.log(1 - AGREEMENT**SAMPLED)
        self.samples = math.ceil(samples / WALKS)
        rng = np.random.default_rng(seed)
        self.seeds = rng.integers(1, 1 << 62, WALKS).astype(np.uint64)
        self._index_runs(of_length)
        # Per length: edits, least shared runs, sampled places, sorted keys and their items.
        self.lengths = {}
        for n, members in sorted(of_length.items()):
            edits = self.items[members[0]][2]
            places = rng.integers(0, 2 * n, (WALKS, self.samples, SAMPLED))
            keys = self._keys(np.array([self.items[m][1] for m in members]), places)
            order = np.argsort(keys.ravel(), kind="stable")
            owner = np.repeat(np.array(members), keys.shape[1])[order]
            self.lengths[n] = (edits, max(1, n - 2 - 3 * edits), places, keys.ravel()[order], owner)

    def _index_runs(self, of_length: dict[int, list[int]]) -> None:
        """The items' three-word runs; per run the lengths of items that hold it, and how often."""
        most: dict[tuple[int, int], int] = defaultdict(int)
        for n, members in of_length.items():
            for m in members:
                runs, times = np.unique(self._runs(np.array(self.items[m][1])), return_counts=True)
                for run, count in zip(runs.tolist(), times.tolist()):
                    most[run, n] = max(most[run, n], count)
        rows = sorted((run, n, count) for (run, n), count in most.items())
        run, self.run_length, self.run_most = (np.array(c, np.int64) for c in zip(*rows)) if rows else [np.zeros(0, np.int64)] * 3
        self.runs, self.run_first = np.unique(run, return_index=True)
        self.run_first = np.append(self.run_first, len(run))
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[self._slot(self.runs)] = True

    def _runs(self, ids: np.ndarray) -> np.ndarray:
        size = np.int64(len(self.vocabulary) + 2)
        return (ids[:-2] * size + ids[1:-1]) * size + ids[2:]

    def _slot(self, runs: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (runs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE_BITS)

    def _keys(self, windows: np.ndarray, places: np.ndarray) -> np.ndarray:
        """A key per window (rows of word ids) and sample, over all walks."""
        count, n = windows.shape
        padded = np.hstack([windows, np.full((count, 1), self.pad)]).astype(np.uint64)
        rows, out = np.arange(count), []
        with np.errstate(over="ignore"):
            for walk, seed in enumerate(self.seeds):
                at = np.zeros(count, np.int64)
                written = np.empty((2 * n, count), np.uint64)
                for step in range(2 * n):
                    word = padded[rows, at]
                    written[step] = word
                    bit = mix(word * np.uint64(0x9E3779B97F4A7C15) + seed + np.uint64(step) * np.uint64(0xD1B54A32D192ED03))
                    at = np.minimum(at + (bit >> np.uint64(63)).astype(np.int64), n)
                for sample, chosen in enumerate(places[walk]):
                    key = np.full(count, walk * 1000 + sample + 1, np.uint64)
                    for place in chosen:
                        key = mix(key * np.uint64(31) + written[place])
                    out.append(key)
        return np.array(out).T

    def search(self, text: str | None) -> list[tuple[int, int, int, int, int]]:
        return self.search_all([text])[0]

    def search_all(self, texts: list[str | None], once: bool = False) -> list[list[tuple[int, int, int, int, int]]]:
        """Per text (item_id, start, end, edits, item words) of occurrences, in code points.

        With ``once`` a single occurrence of a text is enough.

        Occurrences of an item in a text do not overlap. Windows of all texts are embedded
        together.
        """
        out: list[list[tuple]] = [[] for _ in texts]
        get = self.vocabulary.get
        waiting: dict[int, list[tuple[int, np.ndarray, np.ndarray]]] = defaultdict(list)
        words: dict[int, np.ndarray] = {}
        for k, text in enumerate(texts if self.items else []):
            ids = np.array([get(w, 0) for w in WORD.findall((text or "").lower())], np.int64)
            if len(ids) < 3:
                continue
            for n, starts in self._possible(ids):
                words[k] = ids
                waiting[n].append((k, ids, starts))
        starts_of: dict[int, dict[int, set[int]]] = defaultdict(lambda: defaultdict(set))
        for n, entries in waiting.items():
            for k, starts, windows in self._windows(n, entries):
                self._collide(n, k, starts, windows, starts_of)
        for k, found in starts_of.items():
            out[k] = self._verified(texts[k], words[k], found, once)
        return out

    def _possible(self, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Per item length the starts of windows with enough runs of items of that length."""
        runs = self._runs(ids)
        maybe = np.flatnonzero(self.table[self._slot(runs)])
        if not len(maybe):
            return
        index = np.minimum(np.searchsorted(self.runs, runs[maybe]), len(self.runs) - 1)
        real = self.runs[index] == runs[maybe]
        hit, index = maybe[real], index[real]
        if not len(hit):
            return
        first = self.run_first[index]
        times = self.run_first[index + 1] - first
        row = np.repeat(first - np.cumsum(times) + times, times) + np.arange(times.sum())
        hit, index = np.repeat(hit, times), np.repeat(index, times)
        length, most = self.run_length[row], self.run_most[row]
        for n in np.unique(length).tolist():
            edits, need, *_ = self.lengths[n]
            own = length == n
            if own.sum() < need:
                continue
            at, run, cap = hit[own], index[own], most[own]
            # A run counts in a window as often as an item has it: from the cap-th last on.
            order = np.lexsort((at, run))
            at, run, cap = at[order], run[order], cap[order]
            back = np.arange(len(at)) - cap
            same = (back >= 0) & (run[np.maximum(back, 0)] == run)
            last = np.where(same, at[np.maximum(back, 0)], -1)
            low = np.maximum(np.maximum(last + 1, at - (n + edits - 2) + 1), 0)
            change = np.bincount(low, minlength=len(ids) + 1) - np.bincount(at + 1, minlength=len(ids) + 1)
            starts = np.flatnonzero(np.cumsum(change) >= need)
            if len(starts):
                yield n, starts

    def _windows(self, n: int, entries: list) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Windows of n words in blocks: the texts they are from, their starts, their words."""
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        held = 0
        for k, ids, all_starts in entries:
            for starts in np.array_split(all_starts, math.ceil(len(all_starts) / WINDOWS_AT_ONCE)):
                where = starts[:, None] + np.arange(n)
                windows = np.where(where < len(ids), ids[np.minimum(where, len(ids) - 1)], self.pad)
                parts.append((np.full(len(starts), k), starts, windows))
                held += len(starts)
                if held >= WINDOWS_AT_ONCE:
                    yield tuple(map(np.concatenate, zip(*parts)))
                    parts, held = [], 0
        if parts:
            yield tuple(map(np.concatenate, zip(*parts)))

    def _collide(self, n: int, texts: np.ndarray, starts: np.ndarray, windows: np.ndarray, starts_of: dict) -> None:
        _, _, places, keys, owner = self.lengths[n]
        made = self._keys(windows, places)
        width = made.shape[1]
        made = made.ravel()
        low, high = np.searchsorted(keys, made, "left"), np.searchsorted(keys, made, "right")
        for i in np.flatnonzero(high > low).tolist():
            found = starts_of[int(texts[i // width])]
            for item in set(owner[low[i] : high[i]].tolist()):
                found[item].add(int(starts[i // width]))

    def _verified(self, text: str, ids: np.ndarray, starts_of: dict[int, set[int]], once: bool) -> list[tuple]:
        lower = text.lower()
        # Lower-casing can change lengths; then words are placed by their own search.
        source = lower if len(lower) == len(text) else text
        spots = [m.span() for m in WORD.finditer(source)]
        if len(spots) != len(ids):
            spots = [m.span() for m in WORD.finditer(lower)]
        out = []
        for item, starts in sorted(starts_of.items()):
            item_id, words, edits = self.items[item]
            n = len(words)
            done = 0
            ordered = sorted(starts)
            at = 0
            while at < len(ordered):
                # Starts whose windows overlap are one neighbourhood.
                first = at
                while at + 1 < len(ordered) and ordered[at + 1] <= ordered[at] + n:
                    at += 1
                low, high = max(0, ordered[first] - edits, done), min(len(ids), ordered[at] + n + edits)
                part = ids[low:high].tolist()
                for start, end, found in stretches(words, edits, part, 0, len(part)):
                    out.append((item_id, spots[low + start][0], spots[low + end - 1][1], found, n))
                    if once:
                        return out
                    done = low + end
                at += 1
        return out


def item_blocks(benchmark: DataFrame, rate: float = EDIT_RATE, recall: float = RECALL) -> Iterator[Items]:
    """The items (item_id, text) in blocks of bounded size, one after the other."""
    items = picked(benchmark, "item_id", "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    for k in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        yield Items(sorted(((r["item_id"], r["text"]) for r in rows), key=repr), rate, recall)


def occurrences(docs: DataFrame, benchmark: DataFrame, rate: float = EDIT_RATE, recall: float = RECALL) -> DataFrame:
    """One row per occurrence of a benchmark item in a document (doc_id, text).

    Null and empty texts have none, nor have items under three words; null ids are passed
    on; repeated documents and items each have their own rows.
    """
    out = None
    for items in item_blocks(benchmark, rate, recall):

        def run(batches: Iterator[pa.RecordBatch], items: Items = items) -> Iterator[pa.RecordBatch]:
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
            names = [x.split()[0] for x in FOUND.split(", ")]
            for batch in batches:
                found = items.search_all(batch.column("text").to_pylist())
                rows = [(doc_id, *hit) for doc_id, hits in zip(batch.column("doc_id").to_pylist(), found) for hit in hits]
                columns = list(zip(*rows)) if rows else [[]] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        found = picked(docs, "doc_id", "text").mapInArrow(run, FOUND)
        out = found if out is None else out.unionByName(found)
    return out


def clean_documents(docs: DataFrame, benchmark: DataFrame, rate: float = EDIT_RATE, recall: float = RECALL) -> DataFrame:
    """The documents without any occurrence, with all their columns.

    Null and empty texts stay; of repeated rows all stay or none. A very long text costs time
    in proportion to its words, also where it repeats an item throughout.
    """

    def without(items: Items):
        @F.pandas_udf("boolean")
        def clean(texts):
            found = items.search_all([t if isinstance(t, str) else None for t in texts], once=True)
            return pd.Series([not hits for hits in found], dtype=bool)

        return clean

    for items in item_blocks(benchmark, rate, recall):
        docs = docs.filter(without(items)("text"))
    return docs
