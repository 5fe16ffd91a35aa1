"""A subword vocabulary compiled to a deterministic transducer that counts tokens.

Merging by score has one result per text, and two neighbouring tokens stand in it exactly
if merging their two texts alone gives those two tokens. So the tokens of a prefix end in
one known token, and a finite state is enough: for each earlier place where a piece could
still be under way, the last token up to there and the tokens counted up to there. A
transition reads a character and is annotated with the tokens it adds (a merge may take
some back). Transitions are compiled when first met and kept in a hash table of bounded
size; many chunks of text are then read at once, a character each at a time.

Where no piece holds two neighbouring characters, the state is known without what stands
before. Chunks are cut there. Where there is no such place (long runs of junk), the cut
takes every piece that covers it as a possible state: a chunk becomes a map from possible
states before it to possible states behind it, with counts. Maps compose, in pairs, until
one is left for the text; one path through all maps is the right one.
"""

from __future__ import annotations

import numpy as np

CHUNK = 512
#: Characters of a very long text that are read together.
PART = 1 << 20
#: Characters behind a cut's place in which a place that no piece covers is looked for.
SLACK = 64
#: States kept compiled in one Python worker; beyond that compilation starts anew.
MOST_STATES = 350_000
#: Pairs of pieces tried by merging; beyond that they are forgotten.
MOST_PAIRS = 2_000_000

START, DEAD, FRESH = -1, -1, 0
NEVER = float("-inf")
#: Of the hash table: a free slot, the multiplier, and slots at first.
EMPTY, GOLDEN, SLOTS = (1 << 64) - 1, 0x9E3779B97F4A7C15, 1 << 18
SPACE, MARK = " ", "▁"


class Pieces:
    """The pieces of a vocabulary, a trie over them, and merging by score."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.classes = {c: i for i, c in enumerate(sorted(p for p in scores if len(p) == 1), 1)}
        # Pieces with a character that is no piece can never come about.
        self.texts = [p for p in scores if p and all(c in self.classes for c in p)]
        self.number = {p: i for i, p in enumerate(self.texts)}
        self.children: list[dict[int, int]] = [{}]
        self.depth, self.piece = [0], [-1]
        width = len(self.classes) + 1
        self.width = width
        self.crossable = np.zeros((width, width), bool)
        for i, text in enumerate(self.texts):
            node, before = 0, 0
            for c in text:
                c = self.classes[c]
                if before:
                    self.crossable[before, c] = True
                before = c
                if c not in self.children[node]:
                    self.children[node][c] = len(self.depth)
                    self.children.append({})
                    self.depth.append(self.depth[node] + 1)
                    self.piece.append(-1)
                node = self.children[node][c]
            self.piece[node] = i
        self.fail = [0] * len(self.depth)
        level = list(self.children[0].values())
        while level:
            below = []
            for node in level:
                for c, child in self.children[node].items():
                    self.fail[child] = self.goto(self.fail[node], c)
                    below.append(child)
            level = below
        self.last = [self.classes[p[-1]] for p in self.texts]
        self.longest = max(map(len, self.texts), default=1)
        self.neighbours: dict[tuple[int, int], bool] = {}

    def goto(self, node: int, c: int) -> int:
        while node and c not in self.children[node]:
            node = self.fail[node]
        return self.children[node].get(c, 0)

    def stands(self, before: str, piece: str) -> bool:
        """Whether merging leaves just these two texts (or one, after an empty one).

        The best score goes first, the leftmost of equal ones.
        """
        parts, edge = list(before + piece), len(before)
        scores = [self.scores.get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while scores and (best := max(scores)) > NEVER:
            i = scores.index(best)
            if i + 1 == edge:
                return False
            edge -= i < edge
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del scores[i]
            if i:
                scores[i - 1] = self.scores.get(parts[i - 1] + parts[i], NEVER)
            if i < len(scores):
                scores[i] = self.scores.get(parts[i] + parts[i + 1], NEVER)
        return len(parts) == 1 + bool(before)

    def fits(self, before: int, piece: int) -> bool:
        """Whether a piece may follow another one, or stand at a start."""
        known = self.neighbours.get((before, piece))
        if known is None:
            if len(self.neighbours) > MOST_PAIRS:
                self.neighbours.clear()
            known = self.stands("" if before == START else self.texts[before], self.texts[piece])
            self.neighbours[before, piece] = known
        return known


class Transducer:
    """Compiled states and transitions. A state is a trie node with its live places.

    A live place is ``(characters back, last token up to there, tokens up to there)``, the
    tokens counted from those of the nearest live place.
    """

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.bits = np.uint64(max(1, int(pieces.width).bit_length()))
        self.clear()

    def clear(self) -> None:
        self.states: list[tuple[int, tuple]] = [(0, ((0, START, 0),))]
        self.numbers = {self.states[0]: FRESH}
        self._room(SLOTS)

    def _room(self, size: int) -> None:
        self.mask = np.uint64(size - 1)
        self.shift = np.uint64(64 - (size.bit_length() - 1))
        self.filled = 0
        self.keys = np.full(size, EMPTY, np.uint64)
        self.next = np.zeros(size, np.int32)
        self.added = np.zeros(size, np.int32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(GOLDEN)) >> self.shift

    def _number(self, node: int, alive: dict[int, tuple[int, int]]) -> tuple[int, int]:
        """The state of live places, and the tokens up to the nearest of them."""
        if not alive:
            return DEAD, 0
        places = sorted(alive)
        first, deepest = alive[places[0]][1], places[-1]
        while self.pieces.depth[node] > deepest:
            node = self.pieces.fail[node]
        state = (node, tuple([(k, alive[k][0], alive[k][1] - first) for k in places]))
        number = self.numbers.get(state)
        if number is None:
            number = self.numbers[state] = len(self.states)
            self.states.append(state)
        return number, first

    def forced(self, piece: int) -> int:
        """The state right behind a piece that is taken for granted."""
        return self._number(0, {0: (piece, 0)})[0]

    def step(self, number: int, c: int) -> tuple[int, int]:
        """Next state and tokens added by a character; compiled, not looked up."""
        if number == DEAD:
            return DEAD, 0
        pieces = self.pieces
        node, places = self.states[number]
        alive = {k: (token, n) for k, token, n in places}
        here = alive.get(0)
        if c == 0 or (here and here[0] != START and not pieces.crossable[pieces.last[here[0]], c]):
            # No piece holds both characters: only a token's end here leads on, and it is a start.
            alive = {0: (START, here[1])} if here else {}
            if c == 0:
                return self._number(0, alive)
            node = 0
        node = pieces.goto(node, c)
        after: dict[int, tuple[int, int]] = {}
        at = node
        while at:
            back = pieces.depth[at]
            if back - 1 in alive:
                after[back] = alive[back - 1]
                piece = pieces.piece[at]
                if piece >= 0 and pieces.fits(after[back][0], piece):
                    after[0] = (piece, after[back][1] + 1)
            at = pieces.fail[at]
        return self._number(node, after)

    def _insert(self, key: int, state: int, added: int) -> None:
        slot = (key * GOLDEN & EMPTY) >> int(self.shift)
        while (held := int(self.keys[slot])) != EMPTY:
            if held == key:
                return
            slot = (slot + 1) & int(self.mask)
        self.keys[slot], self.next[slot], self.added[slot] = key, state, added
        self.filled += 1

    def _grow(self) -> None:
        taken = self.keys != np.uint64(EMPTY)
        old = self.keys[taken], self.next[taken], self.added[taken]
        self._room(4 * len(self.keys))
        for key, state, added in zip(*(x.tolist() for x in old)):
            self._insert(key, state, added)

    def steps(self, states: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``step`` for many states at once, by the table; what it lacks is compiled."""
        keys = (states.astype(np.uint64) << self.bits) | classes.astype(np.uint64)
        slots = self._slot(keys)
        wrong = np.flatnonzero(self.keys[slots] != keys)
        while len(wrong):
            held = self.keys[slots[wrong]]
            missing = wrong[held == np.uint64(EMPTY)]
            if len(missing):
                for key in np.unique(keys[missing]).tolist():
                    self._insert(key, *self.step(key >> int(self.bits), key & ((1 << int(self.bits)) - 1)))
                    if 4 * self.filled > len(self.keys):
                        self._grow()
                slots = self._slot(keys)
                wrong = np.arange(len(keys))
            else:
                slots[wrong] = (slots[wrong] + np.uint64(1)) & self.mask
            wrong = wrong[self.keys[slots[wrong]] != keys[wrong]]
        return self.next[slots], self.added[slots]

    def read(self, classes: np.ndarray, states: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """Read stretches of text, each from a state of its own: last states and tokens added."""
        order = np.argsort(starts - ends, kind="stable")
        at, left = starts[order].copy(), (ends - starts)[order]
        state, total = states[order].astype(np.int64), np.zeros(len(order), np.int64)
        active = int(np.count_nonzero(left > 0))
        for done in range(int(left.max(initial=0))):
            while active and left[active - 1] <= done:
                active -= 1
            if state[:active].min(initial=0) < 0:
                going = np.flatnonzero(state[:active] >= 0)
                state[going], added = self.steps(state[going], classes[at[going]])
                total[going] += added
            else:
                state[:active], added = self.steps(state[:active], classes[at[:active]])
                total[:active] += added
            at[:active] += 1
        last, sums = np.empty_like(state), np.empty_like(total)
        last[order], sums[order] = state, total
        return last, sums


def cuts(open_at: np.ndarray, start: int, end: int) -> list[tuple[int, bool]]:
    """Places ``(place, whether no piece covers it)`` that cut a text into chunks; its ends among them.

    ``open_at`` holds, in order, the places that no piece covers.
    """
    wanted = np.arange(start + CHUNK, end - CHUNK // 2, CHUNK)
    if not len(wanted):
        return [(start, True), (end, True)]
    place = np.searchsorted(open_at, wanted)
    near = open_at[np.minimum(place, len(open_at) - 1)] if len(open_at) else np.full(len(wanted), -1)
    free = (place < len(open_at)) & (near - wanted <= SLACK) & (near < end)
    return [(start, True), *zip(np.where(free, near, wanted).tolist(), free.tolist()), (end, True)]


def covering(pieces: Pieces, classes: np.ndarray, start: int, place: int, end: int) -> list[tuple[int, int]]:
    """Pieces ``(end, piece)`` that hold the character before ``place``: possible states there."""
    found = []
    for first in range(max(start, place - pieces.longest), place):
        node = 0
        for at in range(first, min(end, first + pieces.longest)):
            node = pieces.children[node].get(int(classes[at]), -1)
            if node < 0:
                break
            if pieces.piece[node] >= 0 and at + 1 >= place and pieces.fits(START, pieces.piece[node]):
                found.append((at + 1, pieces.piece[node]))
    return found


def composed(first: dict, second: dict) -> dict:
    """One map for two neighbouring chunks: ``{state before: {state behind: tokens}}``."""
    out: dict = {}
    for before, reached in first.items():
        onward: dict = {}
        for middle, n in reached.items():
            for behind, more in second.get(middle, {}).items():
                onward[behind] = n + more
        if onward:
            out[before] = onward
    return out


def scanned(maps: list[dict]) -> dict:
    """All maps composed, neighbours in pairs."""
    while len(maps) > 1:
        maps = [composed(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
    return maps[0]


class Counter:
    """Counts the tokens of many texts by one transducer."""

    def __init__(self, scores: dict[str, float]):
        self.pieces = Pieces(scores)
        self.machine = Transducer(self.pieces)
        self.classes = np.zeros(0x110000, np.int32)
        for c, i in self.pieces.classes.items():
            self.classes[ord(c)] = i
        self.classes[ord(SPACE)] = self.pieces.classes.get(MARK, 0)

    def parts(self, text: str) -> list[str]:
        """A text cut where no piece covers the cut, into parts of about ``PART`` characters."""
        out, start = [], 0
        while len(text) - start > 2 * PART:
            cut, at = 0, start + PART
            while not cut and at < len(text) - 1:
                classes = self.classes[np.frombuffer(text[at : at + 4097].encode("utf-32-le"), "<u4")]
                free = np.flatnonzero(~self.pieces.crossable[classes[:-1], classes[1:]])
                cut, at = (at + int(free[0]) + 1 if len(free) else 0), at + 4096
            if not cut:
                break
            out.append(text[start:cut])
            start = cut
        return [*out, text[start:]]

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text as it stands. A character that is no piece counts as its bytes."""
        if len(self.machine.states) > MOST_STATES:
            self.machine.clear()
        points = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
        ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        classes = self.classes[points]
        # Characters that are no piece: where they stand, and their bytes before each of them.
        strange = np.flatnonzero(classes == 0)
        code = np.where(points[strange] == ord(SPACE), ord(MARK), points[strange])
        size = 1 + (code >= 0x80).astype(np.int64) + (code >= 0x800) + (code >= 0x10000)
        as_bytes = np.concatenate([[0], np.cumsum(size)])[np.searchsorted(strange, np.concatenate([[0], ends]))]
        open_at = np.flatnonzero(~self.pieces.crossable[classes[:-1], classes[1:]]) + 1
        # A lane is a chunk read from one possible state before it.
        lanes, chunks = [], []
        for start, end in zip([0, *ends[:-1].tolist()], ends.tolist()):
            places = cuts(open_at, start, end) if end > start else []
            own = []
            before = [(start, START)]
            for (_, _), (place, free) in zip(places, places[1:]):
                behind = [(place, START)] if free else covering(self.pieces, classes, start, place, end)
                own.append((len(lanes), before, place, free, behind))
                lanes += [(at, place, FRESH if piece == START else self.machine.forced(piece)) for at, piece in before]
                before = behind
            chunks.append(own)
        if not lanes:
            return [0] * len(texts)
        at, to, state = np.array(lanes, np.int64).T
        last, tokens = self.machine.read(classes, state, at, to)
        out = []
        for i, (start, end, own) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist(), chunks)):
            if all(len(before) == 1 and free for _, before, _, free, _ in own):
                # Every map has one state on either side: their composition is a sum.
                n = sum(int(tokens[lane]) for lane, *_ in own)
            else:
                maps = [self._map(int(lane), tokens, last, *rest) for lane, *rest in own]
                n = scanned(maps)[start, START][end, START] if maps else 0
            out.append(n + int(as_bytes[i + 1] - as_bytes[i]))
        return out

    def _map(self, lane: int, tokens, last, before, place: int, free: bool, behind) -> dict:
        """The map of a chunk from the last states of its lanes."""
        out = {}
        for i, start in enumerate(before):
            if last[lane + i] == DEAD:
                continue
            alive = {k: (token, int(tokens[lane + i]) + n) for k, token, n in self.machine.states[last[lane + i]][1]}
            if free:
                reached = {(place, START): alive[0][1]} if 0 in alive else {}
            else:
                reached = {}
                for end, piece in behind:
                    back = place - (end - len(self.pieces.texts[piece]))
                    if back in alive and self.pieces.fits(alive[back][0], piece):
                        reached[end, piece] = alive[back][1] + 1
            out[start] = reached
        return out
