"""Byte-pair tokens: learning a merge table, and applying one.

Sennrich, Haddow and Birch, "Neural Machine Translation of Rare Words with Subword
Units" (2016). Learning works on the table of distinct words, never on the texts, and
gives the table that merging one pair at a time gives, but many pairs in a round:

- The counts of all pairs stay in a table that each round changes by what its merges
  took away and made.
- The most frequent pairs are tried together. One pass over the words counts the
  neighbours of each: as many pairs, at most, does a merge make of one kind, and as many
  occurrences does it take from a pair that overlaps it.
- Of the pairs, in order, those go together that do not overlap one another and are more
  frequent than any pair that the ones before could make, or than what is left of a pair
  that had to wait. So nothing could have come in between (see ``chosen``).

Applying happens where the text is: a task keeps the segments of the words it has met, and
nothing is shuffled, however frequent a word.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session
from .tokens import SPACE

# Runs of letters, up to three digits, or runs of other marks.
PIECE = rf"[\p{{L}}\p{{M}}]+|\p{{N}}{{1,3}}|[^{SPACE}\p{{L}}\p{{M}}\p{{N}}]+"
# A merge table within this size goes to every task.
MAX_MERGES = 1_000_000
# Pairs tried together in a round, and words whose segments a task keeps.
CANDIDATES = 512
CACHED_WORDS = 200_000
# Pairs seen less often are not worth a merge.
MIN_COUNT = 2
# Symbols are numbers: characters their code points, merged ones from here on.
MERGED = 0x110000

PAIRS = "left string, right string, n long"
MERGES = "rank int, left string, right string"


def pieces_of(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``pieces``, the words of the text in order."""
    return df.withColumn("pieces", F.regexp_extract_all(text, F.lit(PIECE), F.lit(0)))


def word_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """``(word, n)`` over all texts; partial counts merge map-side."""
    words = pieces_of(df, text).select(F.explode("pieces").alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n"))


# --- learning ---------------------------------------------------------------


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of a batch of words one after another, their words, and the words' counts."""
    lists = batch.column("symbols")
    sizes = np.diff(lists.offsets.to_numpy())
    return lists.flatten().to_numpy(), np.repeat(np.arange(len(sizes)), sizes), batch.column("n").to_numpy()


def _keys(symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a pair begins, and the pair there as one number."""
    at = np.flatnonzero(word[1:] == word[:-1])
    return at, (symbols[at].astype(np.int64) << 32) | symbols[at + 1]


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    some, place = np.unique(keys, return_inverse=True)
    total = np.zeros(len(some), np.int64)
    np.add.at(total, place, n)
    return some, total


class Names:
    """Symbols as text; merged ones by number."""

    def __init__(self, merged: list[str]):
        self.merged = merged

    def __call__(self, symbol: int) -> str:
        return chr(symbol) if symbol < MERGED else self.merged[symbol - MERGED]


def _pair_rows(keys: np.ndarray, n: np.ndarray, name: Names) -> dict[str, list]:
    return {
        "left": [name(k) for k in (keys >> 32).tolist()],
        "right": [name(k) for k in (keys & 0xFFFFFFFF).tolist()],
        "n": n.tolist(),
    }


def spelled_words(counts: DataFrame) -> DataFrame:
    """``(n, symbols)`` of words with more than one character, spelled in code points."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [w.encode("utf-32-le") for w in batch.column("word").to_pylist()]
            sizes = np.cumsum([0, *(len(w) // 4 for w in words)])
            lists = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(np.frombuffer(b"".join(words), "<i4")))
            yield pa.RecordBatch.from_arrays([batch.column("n"), lists], names=["n", "symbols"])

    long = counts.filter(F.length("word") > 1)
    n = int(long.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Distinct words are small rows with much work each: use every shuffle partition.
    return long.repartition(n, "word").select("word", "n").mapInArrow(spell, "n long, symbols array<int>")


def pair_counts(words: DataFrame) -> DataFrame:
    """How often each pair of symbols is adjacent, weighted by word counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            symbols, word, n = _flat(batch)
            at, keys = _keys(symbols, word)
            yield pa.RecordBatch.from_pydict(_pair_rows(*_summed(keys, n[word[at]]), Names([])))

    return words.mapInArrow(count, PAIRS).groupBy("left", "right").agg(F.sum("n").alias("n"))


def _occurrences(symbols: np.ndarray, word: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the pairs (sorted keys) occur, from the left and without overlap of their own, and which."""
    at, keys = _keys(symbols, word)
    which = np.minimum(np.searchsorted(pairs, keys), len(pairs) - 1)
    hit = pairs[which] == keys
    at, which, keys = at[hit], which[hit], keys[hit]
    twin = (keys >> 32) == (keys & 0xFFFFFFFF)
    if twin.any():
        # In a run of one symbol every other pair counts.
        start = np.r_[True, (symbols[1:] != symbols[:-1]) | (word[1:] != word[:-1])]
        run = np.maximum.accumulate(np.where(start, np.arange(len(symbols)), 0))
        kept = ~twin | ((at - run[at]) % 2 == 0)
        at, which = at[kept], which[kept]
    return at, which


def neighbours(words: DataFrame, pairs: np.ndarray) -> list:
    """Per pair (sorted keys) what stands beside its occurrences.

    Rows ``(pair, most, met)``: the count of its most frequent neighbour on one side, and
    ``(count, other)`` for each other pair of the list that an occurrence overlaps.
    """
    shared = words.sparkSession.sparkContext.broadcast(pairs)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = shared.value
        for batch in batches:
            symbols, word, n = _flat(batch)
            at, which = _occurrences(symbols, word, pairs)
            for side, beside, first in (("L", at - 1, at - 1), ("R", at + 2, at + 1)):
                inside = (beside >= 0) & (beside < len(symbols))
                inside[inside] = word[beside[inside]] == word[at[inside]]
                keys, total = _summed(
                    (which[inside].astype(np.int64) << 32) | symbols[beside[inside]], n[word[at[inside]]]
                )
                pair, near = keys >> 32, keys & 0xFFFFFFFF
                left, right = pairs[pair] >> 32, pairs[pair] & 0xFFFFFFFF
                over = (near << 32) | left if side == "L" else (right << 32) | near
                other = np.minimum(np.searchsorted(pairs, over), len(pairs) - 1)
                other = np.where(pairs[other] == over, other, -1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pair, pa.int32()), pa.array([side] * len(pair), pa.string()), pa.array(near), pa.array(other, pa.int32()), pa.array(total)],
                    names=["pair", "side", "near", "other", "n"],
                )

    found = words.mapInArrow(look, "pair int, side string, near long, other int, n long")
    sums = found.groupBy("pair", "side", "near", "other").agg(F.sum("n").alias("n"))
    met = F.collect_list(F.when(F.col("other") >= 0, F.struct("n", "other")))
    return sums.groupBy("pair").agg(F.max("n").alias("most"), met.alias("met")).collect()


def chosen(
    candidates: list[tuple[str, str, int]], near: list, places: list[int], known: set[str], most: int
) -> list[tuple[int, int]]:
    """Which candidates merge in one round, in order, each with its wave; at least the first.

    ``near`` has the rows of ``neighbours``, by place among the sorted keys; ``places`` gives
    each candidate's. A merge takes occurrences from the pairs that overlap it, between the
    larger share of its two sides and their sum, so what is left of each candidate is known
    from below and from above. The next one is the one with the most left, if it has more
    than any other can have, and more than any new pair: a merge makes none more often than
    its most frequent neighbour stands beside it. Otherwise the round ends, as it does before
    a symbol that exists already, whose pairs would grow. A pair of twins that has lost
    occurrences waits, as its runs are cut anew. Pairs that overlap are in different waves.
    """
    rank = {place: i for i, place in enumerate(places)}
    made: dict[int, int] = defaultdict(int)
    taken: dict[int, dict[int, list[int]]] = defaultdict(dict)
    for row in near:
        i = rank[row["pair"]]
        made[i] = max(made[i], row["most"])
        for met in row["met"]:
            j = rank[met["other"]]
            if i != j:
                taken[i].setdefault(j, []).append(met["n"])
    least = [n for _, _, n in candidates]
    upmost = list(least)
    queue = [(-n, left, right, i) for i, (left, right, n) in enumerate(candidates)]
    heapq.heapify(queue)
    wave: dict[int, int] = {}
    out: list[tuple[int, int]] = []
    done: set[int] = set()
    texts: set[str] = set()
    bound = 0
    # Pairs that are no candidates are at most as frequent as the last one of a full list.
    floor = candidates[-1][2] if len(candidates) == CANDIDATES else 0
    while queue and len(out) < most:
        n, left, right, i = heapq.heappop(queue)
        if i in done or -n != upmost[i]:
            continue
        if out:
            while queue and (queue[0][3] == i or queue[0][3] in done or -queue[0][0] != upmost[queue[0][3]]):
                heapq.heappop(queue)
            rival = (queue[0][0], *queue[0][1:3]) if queue else (0, "", "")
            unseen = least[i] <= floor and least[i] < candidates[i][2]
            if least[i] <= bound or unseen or (-least[i], left, right) > rival:
                break
        text = left + right
        if text in known or text in texts:
            return out or [(i, 0)]
        done.add(i)
        texts.add(text)
        out.append((i, wave.get(i, 0)))
        bound = max(bound, made[i])
        lost = candidates[i][2] - least[i]
        for j, sides in taken[i].items():
            if j in done:
                continue
            wave[j] = max(wave.get(j, 0), out[-1][1] + 1)
            least[j] -= sum(sides)
            upmost[j] = min(upmost[j], candidates[j][2] - max(sides) + lost)
            if candidates[j][0] == candidates[j][1]:
                bound = max(bound, upmost[j])
                done.add(j)
            else:
                heapq.heappush(queue, (-upmost[j], *candidates[j][:2], j))
    return out


def _merged(symbols: np.ndarray, word: np.ndarray, pairs: np.ndarray, into: np.ndarray):
    """Symbols and their words after merging pairs (sorted keys) that do not overlap one another."""
    at, which = _occurrences(symbols, word, pairs)
    keep = np.ones(len(symbols), bool)
    keep[at + 1] = False
    symbols = symbols.copy()
    symbols[at] = into[which]
    return symbols[keep], word[keep]


def rewritten(words: DataFrame, waves: list[tuple[np.ndarray, np.ndarray]], merged: list[str]) -> DataFrame:
    """Words after merging the pairs (sorted keys and new symbols) of each wave, and how all pair counts change.

    Rows of words have ``symbols`` and their count ``n``, rows of changes ``left``, ``right``
    and the change ``n``. Only words that lost symbols make changes, and words that are one
    symbol are left out.
    """
    shared = words.sparkSession.sparkContext.broadcast((waves, merged))

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waves, merged = shared.value
        name = Names(merged)
        for batch in batches:
            symbols, word, n = _flat(batch)
            after, word_after = symbols, word
            for pairs, into in waves:
                after, word_after = _merged(after, word_after, pairs, into)
            size = np.bincount(word_after, minlength=len(n))
            changed = np.bincount(word, minlength=len(n)) > size
            change = []
            for some, of, sign in ((symbols, word, -1), (after, word_after, 1)):
                begin, keys = _keys(some, of)
                moved = changed[of[begin]]
                change.append((keys[moved], sign * n[of[begin[moved]]]))
            keys, total = _summed(*(np.concatenate(x) for x in zip(*change)))
            rows = _pair_rows(keys[total != 0], total[total != 0], name)
            whole = size > 1
            sizes = pa.array(np.cumsum(np.r_[0, size[whole]]), pa.int32())
            lists = pa.ListArray.from_arrays(sizes, pa.array(after[whole[word_after]], pa.int32()))
            names = ["n", "symbols", "left", "right"]
            none = pa.nulls(len(lists), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(n[whole]), lists, none, none], names=names)
            texts = (pa.array(rows[side], pa.string()) for side in ("left", "right"))
            lists = pa.nulls(len(rows["n"]), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(rows["n"], pa.int64()), lists, *texts], names=names)

    return words.mapInArrow(rewrite, "n long, symbols array<int>, left string, right string")


def learn_merges(counts: DataFrame, n_merges: int, min_count: int = MIN_COUNT) -> DataFrame:
    """Learn a merge table ``(rank, left, right)`` from ``(word, n)`` rows.

    The most frequent pair of symbols merges first, ties by ``left``, then ``right``, and so
    on until ``n_merges`` are learned or no pair is as frequent as ``min_count``. Each round
    brings a bounded number of candidates to the driver; words and pair counts are staged.
    """
    spark = counts.sparkSession
    words = session.stage(spelled_words(counts), "words")
    pairs = session.stage(pair_counts(words), "pairs")
    merged: list[str] = []
    numbers: dict[str, int] = {}
    learned: list[tuple[int, str, str]] = []
    while len(learned) < n_merges:
        best = pairs.filter(F.col("n") >= min_count).orderBy(F.desc("n"), "left", "right").limit(CANDIDATES).collect()
        if not best:
            break
        candidates = [tuple(row) for row in best]
        number = lambda text: ord(text) if len(text) == 1 else numbers[text]
        keys = np.array([(number(left) << 32) | number(right) for left, right, _ in candidates], np.int64)
        order = np.argsort(keys)
        places = np.empty(len(keys), int)
        places[order] = np.arange(len(keys))
        near = neighbours(words, keys[order])
        now = chosen(candidates, near, places.tolist(), set(numbers), n_merges - len(learned))
        for i, _ in now:
            left, right, _ = candidates[i]
            learned.append((len(learned), left, right))
            if left + right not in numbers:
                numbers[left + right] = MERGED + len(merged)
                merged.append(left + right)
        waves = []
        for wave in range(max(w for _, w in now) + 1):
            some = sorted((int(keys[i]), numbers[candidates[i][0] + candidates[i][1]]) for i, w in now if w == wave)
            waves.append(tuple(np.array(x, np.int64) for x in zip(*some)))
        step = session.stage(rewritten(words, waves, merged), "words")
        words = step.filter("symbols is not null").select("n", "symbols")
        changes = step.filter("symbols is null").select("left", "right", "n")
        sums = pairs.unionByName(changes).groupBy("left", "right").agg(F.sum("n").alias("n"))
        pairs = session.stage(sums.filter("n > 0"), "pairs")
    return spark.createDataFrame(learned, MERGES)


# --- applying ---------------------------------------------------------------


def segment(word: str, ranks: dict[tuple[str, str], list[int]]) -> list[str]:
    """Symbols of one word: the merges in order of rank, each from the left.

    A pair may have several ranks; one that comes about late merges at its next rank. A heap
    of the pairs that can merge makes the time almost proportional to the word.
    """
    symbols: list[str | None] = list(word)
    after = [*range(1, len(symbols)), -1]
    before = list(range(-1, len(symbols) - 1))
    waiting: list[tuple[int, int, str, str]] = []

    def push(i: int, now: int) -> None:
        if i >= 0 and after[i] >= 0:
            pair = (symbols[i], symbols[after[i]])
            known = ranks.get(pair)
            if known and (place := bisect_right(known, now)) < len(known):
                heapq.heappush(waiting, (known[place], i, *pair))

    for i in range(len(symbols)):
        push(i, -1)
    while waiting:
        rank, i, left, right = heapq.heappop(waiting)
        if symbols[i] != left or after[i] < 0 or symbols[after[i]] != right:
            continue
        gone = after[i]
        symbols[i], symbols[gone] = left + right, None
        after[i] = after[gone]
        if after[i] >= 0:
            before[after[i]] = i
        push(before[i], rank)
        push(i, rank)
    return [s for s in symbols if s is not None]


class Segments(dict):
    """Symbols by word; beyond the bound a new word is segmented again each time."""

    def __init__(self, ranks: dict[tuple[str, str], list[int]], limit: int = CACHED_WORDS):
        super().__init__()
        self.ranks, self.limit = ranks, limit

    def __missing__(self, word: str) -> list[str]:
        symbols = segment(word, self.ranks)
        if len(self) < self.limit:
            self[word] = symbols
        return symbols


class Numbers(Segments):
    """Symbols by word as numbers, which ``numbers`` deals in the order of first meeting."""

    def __init__(self, ranks: dict[tuple[str, str], list[int]], limit: int = CACHED_WORDS):
        super().__init__(ranks, limit)
        self.numbers: dict[str, int] = {}

    def __missing__(self, word: str) -> list[int]:
        symbols = [self.numbers.setdefault(s, len(self.numbers)) for s in segment(word, self.ranks)]
        if len(self) < self.limit:
            self[word] = symbols
        return symbols


def merge_ranks(merges: DataFrame) -> dict[tuple[str, str], list[int]]:
    """The ranks of each pair, ascending; refused beyond ``MAX_MERGES``."""
    rows = merges.select("rank", "left", "right").limit(MAX_MERGES + 1).collect()
    if len(rows) > MAX_MERGES:
        raise ValueError(f"more than {MAX_MERGES} merges")
    ranks: dict[tuple[str, str], list[int]] = defaultdict(list)
    for rank, left, right in sorted(rows):
        ranks[left, right].append(rank)
    return dict(ranks)


def _segmented(spark: SparkSession, merges: DataFrame):
    return spark.sparkContext.broadcast(merge_ranks(merges))


def subword_lists(df: DataFrame, merges: DataFrame, text: str = "text") -> DataFrame:
    """Add ``tokens``, the byte-pair tokens of the text in order. No shuffle.

    A null text has no tokens. Texts go through the tasks in small batches.
    """
    ranks = _segmented(df.sparkSession, merges)
    fields = df.schema.jsonValue()["fields"]
    schema = df.select("*", F.lit(None).cast("array<string>").alias("tokens")).schema
    names = [f["name"] for f in fields]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments = Segments(ranks.value)
        for batch in batches:
            lists = batch.column(len(names)).to_pylist()
            tokens = [[s for w in words or () for s in segments[w]] for words in lists]
            columns = [batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(tokens, pa.list_(pa.string()))], names=[*names, "tokens"])

    return pieces_of(df, text).mapInArrow(apply, schema)


def _counted(lists: pa.ListArray, numbers: Numbers) -> tuple[np.ndarray, ...]:
    """How often each row has each symbol: rows (ascending), numbers of symbols, counts.

    Each distinct word is looked up once for all rows, and its symbols count as often as it does.
    """
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    coded = lists.flatten().dictionary_encode()
    symbols = [numbers[w] for w in coded.dictionary.to_pylist()]
    n_words = max(1, len(symbols))
    keys, times = np.unique(
        np.repeat(np.arange(len(sizes)), sizes) * n_words + coded.indices.to_numpy(), return_counts=True
    )
    lengths = np.array([len(x) for x in symbols], np.int64)
    begin = np.cumsum(lengths) - lengths
    flat = np.array([i for x in symbols for i in x], np.int64)
    row, word = keys // n_words, keys % n_words
    long = lengths[word]
    place = np.arange(long.sum()) - np.repeat(np.cumsum(long) - long, long) + np.repeat(begin[word], long)
    n_symbols = max(1, len(numbers.numbers))
    pairs, total = _summed(np.repeat(row, long) * n_symbols + flat[place], np.repeat(times, long))
    return pairs // n_symbols, pairs % n_symbols, total


def _bags(ranks: dict, batches: Iterator[pa.RecordBatch], rows: int = 2000) -> Iterator[tuple]:
    """Parts of batches whose last column is a list of words, with the rows, tokens and counts in them."""
    numbers = Numbers(ranks)
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            row, symbol, n = _counted(part.column(part.num_columns - 1), numbers)
            yield part, row, pa.array(list(numbers.numbers), pa.string()).take(pa.array(symbol)), pa.array(n)


def subword_bags(df: DataFrame, merges: DataFrame, text: str = "text") -> DataFrame:
    """``bag`` in the place of the text: its distinct byte-pair tokens, each with its count. No shuffle."""
    ranks = _segmented(df.sparkSession, merges)
    kept = [c for c in df.columns if c != text]
    kind = "array<struct<token: string, n: bigint>>"
    schema = df.select(*kept, F.lit(None).cast(kind).alias("bag")).schema

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, row, tokens, n in _bags(ranks.value, batches):
            ends = pa.array(np.searchsorted(row, np.arange(part.num_rows + 1)), pa.int32())
            bags = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays([tokens, n], ["token", "n"]))
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], bags], names=[*kept, "bag"])

    return pieces_of(df, text).select(*kept, "pieces").mapInArrow(apply, schema)


def subword_tokens(df: DataFrame, merges: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Byte-pair token counts of each row, ``(doc, token, n)``. No shuffle."""
    ranks = _segmented(df.sparkSession, merges)
    read = pieces_of(df.select(doc, text), text).select(doc, "pieces")
    kind = dict(read.dtypes)[doc]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, row, tokens, n in _bags(ranks.value, batches):
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row)), tokens, n], names=[doc, "token", "n"])

    return read.mapInArrow(apply, f"`{doc}` {kind}, token string, n bigint")
