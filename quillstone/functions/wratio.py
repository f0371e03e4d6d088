"""A weighted composite ratio of texts (0 to 100), one asked text against many at once.

ratio(a, b) = 200 L / (|a| + |b|), L the length of their longest common subsequence. The composite takes the best of the ratio and of those of
sorted words and of word sets (scaled by WORDS); for texts whose lengths differ by LONGER or more, of the shorter one's best ratio with a
window of the longer (scaled by PARTIAL, by FAR beyond FAR_LONGER), again for sorted words and word sets.

L is found by bit-parallel dynamic programming: a pattern of up to 64 characters is a machine word, and numpy steps through all other texts
together, a column of characters at a time. Longer patterns take Python's long integers.
"""

from __future__ import annotations

import numpy as np

# Scales and length ratios of the composite.
WORDS, PARTIAL, FAR, LONGER, FAR_LONGER = 0.95, 0.9, 0.6, 1.5, 8.0
WORD = 64


class Texts:
    """Many texts as a matrix of letter numbers (0 behind a text's end)."""

    def __init__(self, texts: list[str]) -> None:
        self.texts = texts
        self.sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.letters = {c: i for i, c in enumerate(sorted(set("".join(texts))), 1)}
        self.codes = np.zeros((len(texts), int(self.sizes.max(initial=0))), np.int32)
        if texts:
            self.codes[np.arange(self.codes.shape[1]) < self.sizes[:, None]] = [self.letters[c] for t in texts for c in t]

    def common(self, pattern: str, first: int = 0, width: int | None = None) -> np.ndarray:
        """Longest common subsequence of pattern with each text's window of width characters from first on."""
        upto = self.codes.shape[1] if width is None else min(first + width, self.codes.shape[1])
        if len(pattern) > WORD:
            return np.array([_common(pattern, t[first : None if width is None else first + width]) for t in self.texts], np.int64)
        table = np.zeros(len(self.letters) + 1, np.uint64)
        for i, c in enumerate(pattern):
            if c in self.letters:
                table[self.letters[c]] |= np.uint64(1 << i)
        state = np.full(len(self.texts), ~np.uint64(0))
        for column in range(first, upto):
            hit = state & table[self.codes[:, column]]
            state = (state + hit) | (state - hit)
        return np.bitwise_count(~state & np.uint64((1 << len(pattern)) - 1)).astype(np.int64)

    def ratios(self, pattern: str) -> np.ndarray:
        return 200.0 * self.common(pattern) / np.maximum(len(pattern) + self.sizes, 1)

    def window_ratios(self, pattern: str) -> np.ndarray:
        """The best ratio of the shorter with a window of the longer: of its length, or a shorter one at either end."""
        best = np.zeros(len(self.texts))
        longer = np.flatnonzero(self.sizes >= len(pattern))
        if len(longer) and pattern:
            part = self if len(longer) == len(self.texts) else Texts([self.texts[i] for i in longer])
            found = np.zeros(len(longer))
            for first, width in [(0, w) for w in range(1, len(pattern))] + [(i, len(pattern)) for i in range(part.codes.shape[1])]:
                held = np.clip(part.sizes - first, 0, width)
                found = np.maximum(found, np.where(held > 0, 200.0 * part.common(pattern, first, width) / (len(pattern) + held), 0))
            best[longer] = found
        for size in np.unique(self.sizes[(self.sizes <= len(pattern)) & (self.sizes > 0)]).tolist():
            rows = np.flatnonzero(self.sizes == size)
            part, found = Texts([self.texts[i] for i in rows]), best[rows]
            for window in {pattern[i : i + size] for i in range(len(pattern))} | {pattern[:w] for w in range(1, size)}:
                found = np.maximum(found, 200.0 * part.common(window) / (len(window) + size))
            best[rows] = found
        return best


def _common(a: str, b: str) -> int:
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    whole = (1 << len(a)) - 1
    state = whole
    for c in b:
        hit = state & masks.get(c, 0)
        state = ((state + hit) | (state - hit)) & whole
    return len(a) - state.bit_count()


class Scorer:
    """Scores of asked texts against a vocabulary; its matrices are made once."""

    def __init__(self, texts: list[str]) -> None:
        self.whole = Texts(texts)
        self.words = [t.split() for t in texts]
        self.sets = [set(w) for w in self.words]
        self.sorted = Texts([" ".join(sorted(w)) for w in self.words])
        self.unique = Texts([" ".join(sorted(s)) for s in self.sets])
        self.holders: dict[str, list[int]] = {}
        for i, s in enumerate(self.sets):
            for w in s:
                self.holders.setdefault(w, []).append(i)

    def scores(self, asked: str) -> np.ndarray:
        n, sizes = len(self.words), self.whole.sizes
        if not asked or not n:
            return np.zeros(n)
        words, longest, shortest = asked.split(), np.maximum(sizes, len(asked)), np.maximum(np.minimum(sizes, len(asked)), 1)
        apart = longest / shortest
        base = np.where(sizes > 0, self.whole.ratios(asked), 0.0)
        near, far = np.flatnonzero((apart < LONGER) & (sizes > 0)), np.flatnonzero((apart >= LONGER) & (sizes > 0))
        out = base.copy()
        by_words = np.maximum(self.sorted.ratios(" ".join(sorted(words))), self._set_ratios(words)) if len(near) else base
        out[near] = np.maximum(out[near], WORDS * by_words[near])
        if len(far):
            scale = np.where(apart[far] <= FAR_LONGER, PARTIAL, FAR)
            shared = np.zeros(n, bool)
            for w in set(words):
                shared[self.holders.get(w, [])] = True
            take = lambda texts: Texts([texts.texts[i] for i in far])
            plain = take(self.whole).window_ratios(asked)
            token = np.maximum(take(self.sorted).window_ratios(" ".join(sorted(words))), take(self.unique).window_ratios(" ".join(sorted(set(words)))))
            token = np.where(shared[far], 100.0, token)
            out[far] = np.maximum(out[far], np.maximum(plain * scale, token * WORDS * scale))
        return out

    def _set_ratios(self, words: list[str]) -> np.ndarray:
        """The best of the words in common against each side, and of both sides."""
        own = set(words)
        out = np.zeros(len(self.words))
        if not own:
            return out
        shared: dict[int, set[str]] = {}
        for w in own:
            for i in self.holders.get(w, ()):
                shared.setdefault(i, set()).add(w)
        apart = np.array([i for i, s in enumerate(self.sets) if i not in shared and s], np.int64)
        if len(apart):
            out[apart] = self.unique.ratios(" ".join(sorted(own)))[apart]
        by_common: dict[frozenset, list[int]] = {}
        for i, s in shared.items():
            by_common.setdefault(frozenset(s), []).append(i)
        for common, rows in by_common.items():
            left, middle = " ".join(sorted(own - common)), len(" ".join(common))
            rest = Texts([" ".join(sorted(self.sets[i] - common)) for i in rows])
            a, b = middle + (1 + len(left) if left else 0), middle + np.where(rest.sizes > 0, 1 + rest.sizes, 0)
            distance = len(left) + rest.sizes - 2 * rest.common(left)
            # the words in common against either side, and both sides: their joint length less what differs
            both = 100.0 - 100.0 * distance / (middle + 1 + len(left) + middle + 1 + rest.sizes)
            with_left = 100.0 - 100.0 * (1 + len(left)) / (middle + middle + 1 + len(left))
            with_rest = 100.0 - 100.0 * (1 + rest.sizes) / (middle + middle + 1 + rest.sizes)
            found = np.maximum(np.maximum(both, with_left), with_rest)
            out[rows] = np.where((a == middle) | (b == middle), 100.0, found)
        return out
