"""Induced suffix sorting with common-prefix values, on disk-backed priority queues.

One block of text (bytes, as numpy) is sorted as in external induced sorting: the suffixes that are
smaller than both neighbours' (LMS) are sorted first, by recursion on their names; then one pass in
ascending order induces the L-type suffixes and one in descending order the S-type ones. The priority
queue is keyed by (first character, order of arrival): what a scanned suffix induces is appended to
its character's queue, and each tuple carries its common prefix with the one before it in that queue,
which is one more than the smallest common prefix scanned since. Queues are arrays that move to an
anonymous temporary file of the task once together they pass a limit, so memory stays bounded.

Suffixes are told apart up to ``depth`` characters only: common prefixes are cut there.
"""

from __future__ import annotations

import tempfile

import numpy as np

QUEUE_BYTES = 128 << 20
SCAN = 1 << 20  # suffixes scanned at a time


class BucketQueues:
    """One queue of (position, common prefix) blocks per character, spilling to a temporary file."""

    def __init__(self, alphabet: int, limit: int = QUEUE_BYTES):
        self.blocks: list[list] = [[] for _ in range(alphabet)]
        self.limit, self.held, self.file = limit, 0, None

    def push(self, char: int, pos: np.ndarray, lcp: np.ndarray) -> None:
        self.blocks[char].append((pos, lcp))
        self.held += pos.nbytes + lcp.nbytes
        if self.held > self.limit:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()  # no name on disk: gone with the task
        self.file.seek(0, 2)
        for queue in self.blocks:
            for i, block in enumerate(queue):
                if isinstance(block[0], np.ndarray):
                    at = self.file.tell()
                    block[0].tofile(self.file)
                    block[1].tofile(self.file)
                    queue[i] = (at, len(block[0]))
        self.file.flush()
        self.held = 0

    def pop(self, char: int):
        """All waiting blocks of a character, in order of arrival."""
        queue, self.blocks[char] = self.blocks[char], []
        for block in queue:
            if isinstance(block[0], np.ndarray):
                self.held -= block[0].nbytes + block[1].nbytes
                yield block
            else:
                self.file.seek(block[0])
                yield (np.fromfile(self.file, np.int32, block[1]), np.fromfile(self.file, np.int16, block[1]))


def suffix_types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one (S-type). The last character, a unique
    smallest one, is S-type."""
    change = np.flatnonzero(text[:-1] != text[1:])
    smaller = text[change] < text[change + 1]
    runs = np.diff(np.concatenate(([-1], change, [len(text) - 1])))
    return np.repeat(np.concatenate((smaller, [True])), runs)


def common_prefix(padded: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Common prefix of the suffixes at ``a`` and ``b``, up to ``depth``; ``padded`` has at least
    ``depth + 8`` zeros after the text."""
    words = np.ndarray((len(padded) - 7,), dtype="<u8", buffer=padded, strides=(1,))
    out = np.full(len(a), depth, dtype=np.int16)
    active, at = np.arange(len(a)), 0
    a, b = a.astype(np.int64), b.astype(np.int64)
    while len(active) and at < depth:
        diff = words[a + at] ^ words[b + at]
        ends = diff != 0
        lowest = diff[ends] & (~diff[ends] + np.uint64(1))
        out[active[ends]] = np.minimum(depth, at + (np.log2(lowest.astype(np.float64)).astype(np.int64) >> 3))
        active, a, b, at = active[~ends], a[~ends], b[~ends], at + 8
    return out


class _Induction:
    """One pass over the queues; ``carry`` says whether common prefixes are kept."""

    def __init__(self, text, s_type, alphabet: int, depth: int, want_s: bool, carry: bool, limit: int):
        self.text, self.s_type, self.want_s, self.carry, self.depth = text, s_type, want_s, carry, depth
        self.queues = BucketQueues(alphabet, limit)
        self.least = np.zeros(alphabet, dtype=np.int16)  # smallest common prefix since a character's last tuple

    def scan(self, pos: np.ndarray, lcp: np.ndarray) -> None:
        """Induce from a block of sorted suffixes: each gives its left neighbour if of the wanted type."""
        if not len(pos):
            return
        left = pos - 1
        chosen = np.flatnonzero((pos > 0) & (self.s_type[left] == self.want_s))
        if not len(chosen):
            np.minimum(self.least, lcp.min(), out=self.least)
            return
        char = self.text[left[chosen]]
        order = np.argsort(char, kind="stable")
        chosen, char = chosen[order], char[order]
        heads = np.flatnonzero(np.concatenate(([True], char[1:] != char[:-1])))
        lasts = np.append(heads[1:], len(chosen))
        kinds = char[heads]
        if self.carry:
            ends = chosen + 1
            begins = np.zeros_like(chosen)
            begins[1:] = ends[:-1]
            begins[heads] = 0
            wide = np.append(lcp, np.int16(self.depth))
            least = np.minimum.reduceat(wide, np.column_stack((begins, ends)).ravel())[::2]
            least[heads] = np.minimum(least[heads], self.least[kinds])
            values = np.minimum(least + 1, self.depth).astype(np.int16)
            tail = np.append(np.minimum.accumulate(lcp[::-1])[::-1], np.int16(self.depth))
            np.minimum(self.least, tail[0], out=self.least)
            self.least[kinds] = tail[ends[lasts - 1]]
        else:
            values = np.zeros(len(chosen), dtype=np.int16)
        tuples = left[chosen].astype(np.int32)
        for at, to, c in zip(heads, lasts, kinds, strict=True):
            self.queues.push(int(c), tuples[at:to], values[at:to])

    def bucket(self, char: int):
        """The sorted suffixes of one character; a run of the character induces into its own queue."""
        got_pos, got_lcp = [np.zeros(0, np.int32)], [np.zeros(0, np.int16)]
        while self.queues.blocks[char]:
            waiting = list(self.queues.pop(char))
            pos, lcp = (np.concatenate([block[i] for block in waiting]) for i in range(2))
            if len(got_pos) == 1:
                lcp[0] = 0  # what was scanned before begins with another character
            got_pos.append(pos)
            got_lcp.append(lcp)
            for at in range(0, len(pos), SCAN):
                self.scan(pos[at: at + SCAN], lcp[at: at + SCAN])
        return np.concatenate(got_pos), np.concatenate(got_lcp)


def _induce(text, padded, s_type, alphabet, lms, lms_lcp, depth, carry, limit):
    """Yields per character, in descending order, the L-type suffixes (ascending) and the S-type ones
    (descending), each with its common prefixes. ``lms`` is grouped by first character."""
    cuts = np.searchsorted(text[lms], np.arange(alphabet + 1))
    up = _Induction(text, s_type, alphabet, depth, False, carry, limit)
    large = []
    for c in range(alphabet):
        pos, lcp = up.bucket(c)
        large.append((pos, lcp))
        seeds, seed_lcp = lms[cuts[c]:cuts[c + 1]], lms_lcp[cuts[c]:cuts[c + 1]].copy()
        if carry and len(seeds):
            seed_lcp[0] = common_prefix(padded, pos[-1:], seeds[:1], depth)[0] if len(pos) else 0
        up.scan(seeds, seed_lcp)
    down = _Induction(text, s_type, alphabet, depth, True, carry, limit)
    for c in range(alphabet - 1, -1, -1):
        small = down.bucket(c)
        pos, lcp = large[c]
        if c == 0 and not len(small[0]):  # the last character has no successor to induce it
            small = (np.array([len(text) - 1], np.int32), np.zeros(1, np.int16))
        if len(pos):
            back = np.append(np.int16(0), lcp[:0:-1]).astype(np.int16)
            if carry and len(small[0]):
                back[0] = common_prefix(padded, pos[-1:], small[0][-1:], depth)[0]
            down.scan(pos[::-1], back)
        yield c, (pos, lcp), small
        large[c] = None


def _order_names(names: np.ndarray, reach: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of a sequence of names that begin at the characters ``reach``, told apart
    by at least ``depth`` characters: pairs of names become names, again and again.

    A rank is the first slot of its group of equals; only groups that are neither single nor equal
    for ``depth`` characters already are sorted again."""
    n = len(names)
    order = np.argsort(names, kind="stable")
    rank = np.empty(n, dtype=np.int64)
    slots, key, step = np.arange(n), names[order], 1
    while len(slots):
        fresh = np.concatenate(([True], key[1:] != key[:-1]))
        heads = np.flatnonzero(fresh)
        sizes = np.diff(np.append(heads, len(slots)))
        mine = order[slots]
        rank[mine] = np.repeat(slots[heads], sizes)
        end = np.minimum(mine + step, n - 1)
        tied = np.repeat(sizes > 1, sizes) & (reach[end] - reach[mine] < depth)
        slots, mine = slots[tied], mine[tied]
        if step >= n:
            break
        after = np.where(mine + step < n, rank[np.minimum(mine + step, n - 1)] + 1, 0)
        key = rank[mine] * (n + 1) + after
        by = np.argsort(key)
        key, order[slots], step = key[by], mine[by], 2 * step
    return order


def sorted_neighbours(text: np.ndarray, alphabet: int, depth: int, limit: int = QUEUE_BYTES):
    """Blocks of neighbouring suffixes in sorted order: yields ``(positions, lcp)`` where ``lcp[i]`` is
    the common prefix, up to ``depth``, of positions ``i`` and ``i - 1``. ``text`` ends with 0, which
    occurs nowhere else. Suffixes of different first characters are never neighbours here."""
    padded = np.concatenate((text, np.zeros(depth + 16, dtype=np.uint8)))
    s_type = suffix_types(text)
    lms = np.flatnonzero(s_type[1:] & ~s_type[:-1]).astype(np.int32) + np.int32(1)
    by_char = lms[np.argsort(text[lms], kind="stable")]
    none = np.zeros(len(lms), dtype=np.int16)
    is_lms = np.zeros(len(text), dtype=bool)
    is_lms[lms] = True
    parts = []
    for _, _, (small, _) in _induce(text, padded, s_type, alphabet, by_char, none, depth, False, limit):
        parts.append(small[is_lms[small]])
    number = np.zeros(len(text), dtype=np.int32)
    number[lms] = np.arange(len(lms), dtype=np.int32)
    length = np.append(np.diff(lms) + 1, 1).astype(np.int32)
    by_name = number[np.concatenate(parts)[::-1]]  # LMS numbers in order of their substrings
    del parts, number, is_lms
    a, b = lms[by_name[:-1]], lms[by_name[1:]]
    size = length[by_name[:-1]]
    same = size == length[by_name[1:]]
    active, k = np.flatnonzero(same).astype(np.int32), 0
    while len(active):
        active = active[size[active] > k]
        equal = text[a[active] + k] == text[b[active] + k]
        same[active[~equal]] = False
        active, k = active[equal], k + 1
    names = np.zeros(len(lms), dtype=np.int64)
    names[by_name] = np.concatenate(([0], np.cumsum(~same)))[: len(by_name)]
    del a, b, size, same, length, by_name
    ordered = lms[_order_names(names, lms.astype(np.int64), depth)]
    lcp = np.zeros(len(ordered), dtype=np.int16)
    lcp[1:] = common_prefix(padded, ordered[:-1], ordered[1:], depth)
    for _, (pos, values), (small, small_values) in _induce(
            text, padded, s_type, alphabet, ordered, lcp, depth, True, limit):
        yield pos, values
        yield small, small_values
        if len(pos) and len(small):
            yield (np.array([pos[-1], small[-1]], np.int32),
                   np.concatenate(([0], common_prefix(padded, pos[-1:], small[-1:], depth))).astype(np.int16))
