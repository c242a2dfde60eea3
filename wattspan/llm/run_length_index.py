"""A run-length compressed Burrows-Wheeler index of many short pieces of text.

The transform is kept as its runs, with the text position at both ends of every run. The
longest matches of patterns are streamed through it from right to left, many patterns at a
time: where a pattern goes on with the byte before the current match, the match grows by one;
else it moves to the nearer, by common length, of the two run ends with that byte around it.
"""

from __future__ import annotations

import numpy as np

# A position in the index has so many bits, so that two ranks and a position fit a sort key.
POSITION_BITS = 21
MOST_SYMBOLS = 1 << POSITION_BITS


def flat_ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``start, start + 1, ...`` for ``count`` numbers of every range, one after the other."""
    counts = counts.astype(np.int64)
    before = np.cumsum(counts) - counts
    return np.repeat(starts.astype(np.int64) - before, counts) + np.arange(int(counts.sum()))


class RunLengthIndex:
    """Index of ``pieces``, given as one array of bytes and the length of each piece.

    ``owners`` numbers the document of each piece. For every string of ``length`` bytes in
    the index, :meth:`first_owner` gives the least owner of any piece that holds it.
    """

    def __init__(self, raw: np.ndarray, sizes: np.ndarray, owners: np.ndarray, length: int) -> None:
        self.length = length
        count = len(sizes)
        ends = np.cumsum(sizes + 1) - 1
        total = int(ends[-1]) + 1
        if total >= MOST_SYMBOLS:
            raise ValueError("too many symbols for one index")
        # Bytes are symbols from 1 on; a 0 ends every piece.
        symbols = np.zeros(total, np.int64)
        inside = np.ones(total, bool)
        inside[ends] = False
        symbols[inside] = raw.astype(np.int64) + 1
        end_of = np.repeat(ends, sizes + 1)
        owner_of = np.repeat(owners, sizes + 1)
        self._sort(symbols, end_of, int(sizes.max()) + 1)
        self._first_owners(end_of, owner_of)
        self._runs(symbols)
        self.count = count

    def _sort(self, symbols: np.ndarray, end_of: np.ndarray, longest: int) -> None:
        """Order of all suffixes, each up to its end; equal ones stay in order of position.

        Ranks of prefixes of 1, 2, 4, ... symbols are kept for comparing positions.
        """
        at = np.arange(len(symbols))

        def later(rank: np.ndarray, step: int) -> np.ndarray:
            """Ranks ``step`` positions later, 0 beyond the end of a piece."""
            moved = np.zeros_like(rank)
            moved[: len(rank) - step] = rank[step:]
            moved[at + step > end_of] = 0
            return moved

        def ranked(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            packed = np.sort((key << POSITION_BITS) | at)
            order = packed & (MOST_SYMBOLS - 1)
            packed >>= POSITION_BITS
            rank = np.empty(len(key), np.int64)
            rank[order] = np.cumsum(np.concatenate([[1], packed[1:] != packed[:-1]]))
            return order, rank

        two = (symbols << 9) | later(symbols, 1)
        order, rank = ranked((two << 18) | later(two, 2))
        self.ranks, depth = {1: symbols, 4: rank}, 4
        while depth < longest:
            order, rank = ranked((rank << POSITION_BITS) | later(rank, depth))
            depth *= 2
            self.ranks[depth] = rank
        self.order = order

    def _first_owners(self, end_of: np.ndarray, owner_of: np.ndarray) -> None:
        """Least owner of the string at every position, as runs over the positions."""
        order, length = self.order, self.length
        depth = max(d for d in self.ranks if d <= length)
        rank, rest = self.ranks[depth], length - depth
        whole = order + length <= end_of[order]
        safe = np.minimum(order + rest, len(order) - 1)
        same = whole[1:] & whole[:-1]
        same &= (rank[order[1:]] == rank[order[:-1]]) & (rank[safe[1:]] == rank[safe[:-1]])
        if 2 * depth < length:
            raise ValueError("pieces are shorter than the strings looked for")
        fresh = np.concatenate([[True], ~same])
        least = np.minimum.reduceat(owner_of[order], np.flatnonzero(fresh))
        first = np.empty(len(order), owner_of.dtype)
        first[order] = least[np.cumsum(fresh) - 1]
        change = np.concatenate([[True], first[1:] != first[:-1]])
        self.owner_starts = np.flatnonzero(change)
        self.owners = first[self.owner_starts]

    def _runs(self, symbols: np.ndarray) -> None:
        order = self.order
        before = symbols[order - 1]  # what precedes position 0 is the last end
        heads = np.flatnonzero(np.concatenate([[True], before[1:] != before[:-1]]))
        tails = np.concatenate([heads[1:], [len(before)]])
        kind = before[heads]
        by_symbol = np.argsort(kind, kind="stable")
        heads, tails, kind = heads[by_symbol], tails[by_symbol], kind[by_symbol]
        sizes = tails - heads
        # Rows of suffixes are in order of their first symbol, so the row that a step back
        # leads to is the number of earlier equal symbols after those of lesser ones.
        self.base = np.cumsum(sizes) - sizes
        self.heads, self.tails = heads, tails
        self.keys = kind * MOST_SYMBOLS + heads
        self.head_at, self.tail_at = order[heads], order[tails - 1]
        self.bounds = np.searchsorted(kind, np.arange(258))

    @property
    def runs(self) -> int:
        return len(self.heads)

    def first_owner(self, at: np.ndarray) -> np.ndarray:
        return self.owners[np.searchsorted(self.owner_starts, at, "right") - 1]

    def _common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Common length of the suffixes at ``a`` and ``b``, at most ``most``."""
        last, found = len(self.order) - 1, np.zeros(len(a), np.int64)
        for depth in sorted(self.ranks, reverse=True):
            rank = self.ranks[depth]
            for _ in range(3 if depth == 1 else 1):
                one, other = np.minimum(a + found, last), np.minimum(b + found, last)
                found += depth * (rank[one] == rank[other])
        return np.minimum(found, most)

    def matches(self, raw: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
        """Where the index holds the ``length`` bytes at a place of a pattern.

        Patterns come as one array of bytes and their sizes. Three arrays return: pattern,
        place in it, and a position of the index with the same bytes. A pattern is dropped
        as soon as no place left of here can still match.
        """
        widest, count = int(sizes.max(initial=0)), len(sizes)
        grid = np.zeros((count, widest), np.int64)
        shift = widest - sizes
        grid.ravel()[flat_ranges(np.arange(count) * widest + shift, sizes)] = raw.astype(np.int64) + 1
        live = np.arange(count)
        row = np.zeros(count, np.int64)
        at = np.full(count, self.order[0])
        matched = np.zeros(count, np.int64)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for column in range(widest - 1, -1, -1):
            use = np.flatnonzero(shift[live] <= column)
            symbol = grid[live[use], column]
            r, p, m = row[use], at[use], matched[use]
            run = np.searchsorted(self.keys, symbol * MOST_SYMBOLS + r, "right") - 1
            low, high = self.bounds[symbol], self.bounds[symbol + 1]
            before = run >= low
            inside = before & (r < self.tails[run])
            out = np.flatnonzero(~inside)
            if len(out):
                j, after = run[out], run[out] + 1 < high[out]
                next_run = np.minimum(j + 1, len(self.heads) - 1)
                up = np.where(before[out], self._common(p[out], self.tail_at[j], m[out]), -1)
                down = np.where(after, self._common(p[out], self.head_at[next_run], m[out]), -1)
                lower, none = down > up, (up < 0) & (down < 0)
                chosen = np.where(lower, next_run, j)
                r[out] = np.where(lower, self.heads[chosen], self.tails[chosen] - 1)
                p[out] = np.where(lower, self.head_at[chosen], self.tail_at[chosen])
                m[out] = np.where(none, -1, np.maximum(up, down))
                run[out] = chosen
            # A symbol that the index lacks ends the match; any row will do to go on.
            lacks = m < 0
            r = np.where(lacks, 0, self.base[run] + r - self.heads[run])
            p = np.where(lacks, self.order[0], p - 1)
            m += 1
            row[use], at[use], matched[use] = r, p, m
            place = column - shift[live]
            hit = np.flatnonzero((place >= 0) & (matched >= self.length))
            if len(hit):
                found.append((live[hit], place[hit], at[hit]))
            keep = (matched + place >= self.length) | (place < 0) | (column == widest)
            keep |= shift[live] > column
            if not keep.all():
                live, row, at, matched = live[keep], row[keep], at[keep], matched[keep]
            if not len(live):
                break
        if not found:
            return tuple(np.zeros(0, np.int64) for _ in range(3))
        return tuple(np.concatenate(part) for part in zip(*found))
