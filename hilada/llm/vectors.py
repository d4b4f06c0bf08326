"""Texts of a batch as one array of code points, from which words, lines and their measures are taken by array operations.

Words and lines get 64-bit hashes that depend on their code points only, so they can be counted and compared over all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

LETTER, DIGIT, NUMBER, UPPER, SPACE, LINE_END, PLAIN, CONTROL, NUMERIC, SENTENCE, CLOSING = (1 << i for i in range(11))
#: Code points whose properties stand in a table; others are looked up when they come.
TABLED = 0x20000
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
_tables: dict[str, np.ndarray] = {}


def _flags(code: int) -> int:
    """What a code point is: str.isalpha, 0-9, str.isdigit, str.isupper, white space, end of a line, no symbol, a control
    character, part of a numeric line, end of a sentence, what may follow that."""
    c = chr(code)
    word = c.isalnum() or c == "_"
    out = LETTER * c.isalpha() | DIGIT * ("0" <= c <= "9") | NUMBER * c.isdigit() | UPPER * c.isupper() | SPACE * c.isspace()
    out |= LINE_END * (c in "\n\r\x0b\x0c\x1c\x1d\x1e\x85  ") | SENTENCE * (c in ".!?…") | CLOSING * (c.isspace() or c in "\"”»")
    out |= PLAIN * (word or c.isspace() or c in ".,;:¿?¡!()«»“”\"'’—–-…·" or "̀" <= c <= "ͯ")
    out |= CONTROL * (0 < code < 0x20 and c not in "\t\n\r" or code == 0x7F) | NUMERIC * (c.isspace() or c.isdigit() or c in ".,:;()-–—")
    return out


def _lower(code: int) -> int:
    low = chr(code).lower()
    return ord(low) if len(low) == 1 else code


def _table(name: str, of, kind) -> np.ndarray:
    if name not in _tables:
        _tables[name] = np.fromiter(map(of, range(TABLED)), kind, TABLED)
    return _tables[name]


def _looked_up(codes: np.ndarray, name: str, of, kind) -> np.ndarray:
    if not len(codes) or codes.max() < TABLED:
        return _table(name, of, kind)[codes]
    out = _table(name, of, kind)[np.minimum(codes, TABLED - 1)]
    rare = np.flatnonzero(codes >= TABLED)
    distinct, at = np.unique(codes[rare], return_inverse=True)
    out[rare] = np.fromiter(map(of, distinct.tolist()), kind, len(distinct))[at]
    return out


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse, modulo 2**64."""
    if len(_tables.get("up", ())) < n:
        size = max(n, 1 << 20)
        for name, base in (("up", BASE), ("down", INVERSE)):
            powers = np.full(size, base, np.uint64)
            powers[0] = 1
            _tables[name] = np.cumprod(powers, dtype=np.uint64)
    return _tables["up"], _tables["down"]


def word_hash(word: str) -> int:
    """The hash that Texts.words gives to a word, as a signed number."""
    h = sum(_lower(ord(c)) * pow(BASE, i, 1 << 64) for i, c in enumerate(word)) % (1 << 64)
    return h - (1 << 64) if h >> 63 else h


def groups(texts: list[str], most: int = 400_000) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `most` code points together; a longer text is a range of its own."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > most:
            yield start, i
            start, size = i, 0
        size += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


class Texts:
    """The code points of some texts, each followed by a line end that isn't its own."""

    def __init__(self, texts: list[str]):
        self.texts, self.n = texts, len(texts)
        lengths = np.fromiter(map(len, texts), np.int64, self.n)
        self.codes = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
        self.ends = np.cumsum(lengths + 1) - 1
        self.starts = self.ends - lengths
        self.lengths = lengths
        self.flags = _looked_up(self.codes, "flags", _flags, np.uint16)
        self._words: dict[int, tuple] = {}

    def has(self, flag: int) -> np.ndarray:
        return (self.flags & flag) != 0

    def within(self, mask: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How many of the mask are in each range."""
        at = np.flatnonzero(mask)
        return np.searchsorted(at, ends) - np.searchsorted(at, starts)

    def runs(self, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the runs of the mask; none crosses a text as its last code point is a line end."""
        change = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
        return change[::2], change[1::2]

    def owner(self, at: np.ndarray) -> np.ndarray:
        """The text in which each position lies."""
        return np.searchsorted(self.ends, at)

    def hashes(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        up, down = _powers(len(codes) + 1)
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes.astype(np.uint64) * up[: len(codes)], dtype=np.uint64, out=sums[1:])
        return ((sums[ends] - sums[starts]) * down[starts]).view(np.int64)

    def words(self, least: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each run of at least `least` letters: its text, the hash of its lower-case form, start and end."""
        if least in self._words:
            return self._words[least]
        starts, ends = self.runs(self.has(LETTER))
        if least > 1:
            long = ends - starts >= least
            starts, ends = starts[long], ends[long]
        self._words[least] = self.owner(starts), self.hashes(_looked_up(self.codes, "lower", _lower, np.uint32), starts, ends), starts, ends
        return self._words[least]

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each line: its text and, without white space around it, its start and end (equal in a blank line).

        CR LF ends one line; a blank last line is none.
        """
        is_end = self.has(LINE_END)
        is_end[:-1] &= ~((self.codes[:-1] == 13) & (self.codes[1:] == 10) & ~np.isin(np.arange(1, len(self.codes)), self.ends))
        ends = np.flatnonzero(is_end)
        starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
        full = np.flatnonzero(~self.has(SPACE))
        lo, hi = np.searchsorted(full, starts), np.searchsorted(full, ends)
        blank = lo == hi
        if len(full):
            first, last = np.where(blank, starts, full[np.minimum(lo, len(full) - 1)]), np.where(blank, starts, full[np.maximum(hi - 1, 0)] + 1)
        else:
            first = last = starts
        owner = self.owner(ends)
        kept = ~(blank & (ends == self.ends[owner]))
        return owner[kept], first[kept], last[kept]

    def count(self, owners: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(owners, weights, self.n) if self.n else np.zeros(0)


def skeletons(units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each unit: a hash of what must be equal in units of one template, how many words that is, and how many slots it has.

    Slots are the signs ~, numbers, and words with a capital and a small letter that don't open the unit; case, signs and white
    space make no difference.
    """
    t = Texts(units)
    starts, ends = t.runs(t.has(LETTER))
    upper, owner = t.has(UPPER), t.owner(starts)
    opens = np.concatenate([[True], owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, bool)
    named = ~opens & upper[starts] & (ends - starts > 1) & ~upper[np.minimum(starts + 1, len(upper) - 1)]
    kept = ~named
    edge = np.zeros(len(t.codes) + 1, np.int8)
    edge[starts[kept]] = 1
    edge[ends[kept]] -= 1
    stays = np.cumsum(edge[:-1], dtype=np.int8) > 0
    before = np.concatenate([[0], np.cumsum(stays)])
    lower = _looked_up(t.codes[stays], "lower", _lower, np.uint32)
    hashes = t.hashes(lower, before[t.starts], before[t.ends])
    digits, _ = t.runs(t.has(NUMBER))
    numbers, marks, words = t.count(t.owner(digits)), t.within(t.codes == 0x7E, t.starts, t.ends), t.count(owner[kept])
    hashes = np.where(words > 0, hashes, 2 + 3 * marks.astype(np.int64) + 1_000_003 * numbers.astype(np.int64))  # without words, what is left is their kind
    return hashes, words, (t.count(owner[named]) + numbers + marks).astype(np.int64)


class Counts:
    """How often each of many hashes came, by sorting what has gathered from time to time."""

    def __init__(self, gathered: int = 500_000):
        self.most, self.size = gathered, 0
        self.new: list[np.ndarray] = []
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, keys: np.ndarray) -> None:
        self.new.append(keys)
        self.size += len(keys)
        if self.size > max(self.most, len(self.keys)):
            self.merge()

    def merge(self) -> None:
        if not self.new:
            return
        keys = np.sort(np.concatenate(self.new))
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        keys, counts = np.concatenate([self.keys, keys[first]]), np.concatenate([self.counts, np.diff(np.append(first, len(keys)))])
        order = np.argsort(keys, kind="stable")  # two sorted runs
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        self.keys, self.counts = keys[first], np.add.reduceat(counts, first) if len(first) else counts
        self.new, self.size = [], 0

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        self.merge()
        return self.keys, self.counts


def once_each(owner: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Places of the first of the equal hashes of each owner."""
    with np.errstate(over="ignore"):
        keys = hashes ^ (owner.astype(np.uint64) * np.uint64(INVERSE)).view(np.int64)
    order = np.argsort(keys)
    keys = keys[order]
    return order[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else order
