"""A finite-state transducer over UTF-8 bytes that measures texts, inside tasks.

Every byte has a class. From a state, a class leads to the next state and puts out
what happens there: a word begins, a word ends, a code point begins, a capital, a
symbol. Which state follows depends on the class alone, so a block of bytes takes its
steps together: NEXT of the classes, moved on by one, are the states before each byte,
and EVENTS of (state, class) are the outputs. The words that end are inserted into a
hash table that compares bytes whenever two words meet in a slot.

A block ends where no word is open, so memory is that of BLOCK bytes and the longest
word, and of the distinct words of one document.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np

# Classes of bytes, states, and events as bits.
SPACE, CAPITAL, SYMBOL, INNER, OTHER = range(5)
OUTSIDE, INSIDE = range(2)
BEGINS, ENDS, POINT, UPPER, MARK = (1 << k for k in range(5))

WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = b"#$%&*|"

#: Bytes that take their steps together.
BLOCK = 1 << 20
STEP = np.uint64(0x9E3779B97F4A7C15)
BACK = np.uint64(pow(int(STEP), -1, 1 << 64))


def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of a byte, next state by class, events by state and class."""
    kind = np.full(256, OTHER, np.uint8)
    kind[0x80:0xC0] = INNER
    kind[ord("A") : ord("Z") + 1] = CAPITAL
    kind[list(SYMBOLS)] = SYMBOL
    kind[list(WHITE)] = SPACE
    follows = np.array([OUTSIDE if k == SPACE else INSIDE for k in range(5)], np.uint8)
    own = [POINT, POINT | UPPER, POINT | MARK, 0, POINT]
    events = np.zeros((2, 5), np.uint8)
    for state in (OUTSIDE, INSIDE):
        for k in range(5):
            turn = {(OUTSIDE, INSIDE): BEGINS, (INSIDE, OUTSIDE): ENDS}.get((state, int(follows[k])), 0)
            events[state, k] = own[k] | turn
    return kind, follows, events


KIND, NEXT, EVENTS = tables()
_forward = np.cumprod(np.full(BLOCK, STEP, np.uint64))
_backward = np.cumprod(np.full(BLOCK, BACK, np.uint64))


def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """STEP and its inverse to the powers from 1 on."""
    if count <= BLOCK:
        return _forward[:count], _backward[:count]
    return np.cumprod(np.full(count, STEP, np.uint64)), np.cumprod(np.full(count, BACK, np.uint64))


def span_hashes(content: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span, wherever in the content it lies."""
    forward, backward = powers(len(content))
    sums = np.empty(len(content) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((content.astype(np.uint64) + np.uint64(1)) * forward, out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * backward[starts]
    hashes ^= hashes >> np.uint64(29)
    hashes *= np.uint64(0xBF58476D1CE4E5B9)
    return hashes ^ (hashes >> np.uint64(32))


class SpanTable:
    """An open hash table of byte spans by owner; a span is known if its owner has the same bytes in it."""

    def __init__(self, content: np.ndarray):
        # Room behind the end, so that eight bytes can be read from any place.
        self.content = np.concatenate([content, np.zeros(8, np.uint8)])
        self.eight = np.ndarray((len(content) + 1,), "<u8", self.content.data, strides=(1,))
        self.slots = np.full(1 << 10, -1, np.int64)
        self.starts, self.lengths, self.owners, self.hashes = (
            np.empty(0, kind) for kind in (np.int64, np.int64, np.int64, np.uint64)
        )

    def insert(self, owners: np.ndarray, starts: np.ndarray, lengths: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The spans are inserted; whether each is the first of its bytes."""
        known = len(self.starts)
        self.starts, self.lengths = np.r_[self.starts, starts], np.r_[self.lengths, lengths]
        self.owners, self.hashes = np.r_[self.owners, owners], np.r_[self.hashes, hashes + owners.astype(np.uint64) * STEP]
        new = known + np.arange(len(starts))
        held = self.slots[self.slots >= 0]
        if 2 * (len(held) + len(new)) > len(self.slots):
            self.slots = np.full(1 << int(4 * (len(held) + len(new))).bit_length(), -1, np.int64)
            self._settle(held)
        first = np.zeros(len(starts), bool)
        first[self._settle(new) - known] = True
        # Spans that were known already are let go.
        keep = np.r_[np.ones(known, bool), first]
        taken = self.slots >= 0
        self.slots[taken] = (np.cumsum(keep) - 1)[self.slots[taken]]
        self.starts, self.lengths, self.owners, self.hashes = (
            column[keep] for column in (self.starts, self.lengths, self.owners, self.hashes)
        )
        return first

    def _settle(self, spans: np.ndarray) -> np.ndarray:
        """Every span probes from its own slot on until it finds room or its equal; those that found room."""
        mask = np.uint64(len(self.slots) - 1)
        at = (self.hashes[spans] & mask).astype(np.int64)
        settled = []
        while len(spans):
            free = self.slots[at] < 0
            # Of the spans that claim one slot, the first gets it.
            self.slots[at[free][::-1]] = spans[free][::-1]
            other = self.slots[at]
            own = other == spans
            settled.append(spans[own])
            left = ~own & ~self.same(spans, other)
            spans, at = spans[left], (at[left] + 1) & int(mask)
        return np.concatenate(settled) if settled else spans

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether spans have one owner and the same bytes."""
        equal = (self.lengths[a] == self.lengths[b]) & (self.owners[a] == self.owners[b]) & (self.hashes[a] == self.hashes[b])
        left = np.flatnonzero(equal)
        offset = 0
        while len(left):
            rest = self.lengths[a[left]] - offset
            differ = self.eight[self.starts[a[left]] + offset] ^ self.eight[self.starts[b[left]] + offset]
            # Of the last bytes only those of the span count.
            beyond = np.uint64(8) * np.clip(8 - rest, 0, 7).astype(np.uint64)
            equal[left[(differ << beyond) != 0]] = False
            left = left[equal[left] & (rest > 8)]
            offset += 8
        return equal


@dataclass
class Counts:
    """What one pass finds, by text."""

    words: np.ndarray
    distinct: np.ndarray
    capitals: np.ndarray
    points: np.ndarray
    symbols: np.ndarray


def groups(texts: Sequence[bytes]) -> Iterator[tuple[int, int]]:
    """Runs of texts of about a block together."""
    first, size = 0, 0
    for k, text in enumerate(texts):
        if size and size + len(text) > BLOCK:
            yield first, k
            first, size = k, 0
        size += len(text) + 1
    if first < len(texts):
        yield first, len(texts)


def measure(texts: Sequence[bytes]) -> Counts:
    """Words, distinct words, capitals, code points and symbols of every text, in one pass."""
    counts = Counts(*(np.zeros(len(texts), np.int64) for _ in range(5)))
    for first, last in groups(texts):
        content = np.frombuffer(b"\n".join(texts[first:last]) + b"\n", np.uint8)
        lengths = np.fromiter((len(text) + 1 for text in texts[first:last]), np.int64, last - first)
        _run(content, np.cumsum(lengths), first, counts)
    return counts


def _run(content: np.ndarray, ends: np.ndarray, first: int, counts: Counts) -> None:
    """One buffer of texts, each with white space behind it that is not counted."""
    table, begin = SpanTable(content), 0
    while begin < len(content):
        end = _outside(content, begin)
        kinds = KIND[content[begin:end]]
        after = NEXT[kinds]
        before = np.empty_like(after)
        # A block begins outside of words.
        before[0], before[1:] = OUTSIDE, after[:-1]
        events = EVENTS[before, kinds]
        bounds = np.clip(ends - begin, 0, end - begin)
        for bit, into in ((POINT, counts.points), (UPPER, counts.capitals), (MARK, counts.symbols), (BEGINS, counts.words)):
            sums = np.r_[0, np.cumsum(events & bit != 0)][bounds]
            into[first : first + len(ends)] += np.diff(sums, prepend=0)
        starts, stops = np.flatnonzero(events & BEGINS), np.flatnonzero(events & ENDS)
        owners = np.searchsorted(ends, starts + begin, "right")
        new = table.insert(owners, starts + begin, stops - starts, span_hashes(content[begin:end], starts, stops))
        counts.distinct[first : first + len(ends)] += np.bincount(owners[new], minlength=len(ends))
        begin = end
    counts.points[first : first + len(ends)] -= 1


def _outside(content: np.ndarray, begin: int) -> int:
    """The end of a block: behind the first white space from BLOCK on."""
    end = begin + BLOCK
    while end < len(content):
        white = np.flatnonzero(KIND[content[end - 1 : end + BLOCK]] == SPACE)
        if len(white):
            return end + int(white[0])
        end += BLOCK + 1
    return len(content)
