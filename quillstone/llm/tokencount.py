"""Edit-aware token counts: a segment tree of pre-tokens for each document.

A text's pre-tokens (by the tokenizer's split pattern) never merge across their borders, so a text's token count is the sum
of its pre-tokens' counts. The tree's leaves are blocks of BLOCK pre-tokens; inner nodes hold the sums of characters and
tokens below. An edit finds its blocks by descending the character sums, splits only the touched pre-tokens' surroundings
anew, and adds the difference to the sums on the way up.

Boundary context: a pre-token depends on at most LOOK_AHEAD characters behind its end and on nothing before its start. So
splitting starts at the first pre-token that ends within LOOK_AHEAD characters of the edit or behind it, and stops at the first
border behind the edit that was a border before: from there on the old pre-tokens hold.

Defined results: a null text is empty, with 0 tokens; edits are (start, end, text) in code points of the text as the edits
before have left it, cut off at its ends; null edits are none; a null or very large doc_id stays as it is; repeated rows give
repeated results; an empty table gives an empty result; texts of any length are counted whole; other columns are not read.
"""

from __future__ import annotations

import base64
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pandas as pd
import regex
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

BLOCK = 64
#: The pattern looks one character beyond a run of white space, and two for a contraction.
LOOK_AHEAD = 3
CACHE_PIECES = 400_000


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


class Counter:
    """Token counts of pre-tokens, remembered in a bounded table."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.split = regex.compile(pattern)
        self.known: dict[str, int] = {}

    def counts(self, pieces: list[str]) -> list[int]:
        known = self.known
        new = [p for p in set(pieces) if p not in known]
        if new:
            if len(known) + len(new) > CACHE_PIECES:
                known.clear()
                new = list(set(pieces))
            encode = self.encoding.encode_ordinary
            for p in new:
                known[p] = len(encode(p))
        return list(map(known.__getitem__, pieces))


@lru_cache(maxsize=2)
def counter(path: str, pattern: str) -> Counter:
    return Counter(path, pattern)


class TokenTree:
    """A document's pre-tokens in blocks under a binary tree of (characters, tokens, pre-tokens) sums."""

    def __init__(self, text: str, counts: Counter) -> None:
        self.counts = counts
        self.work = 0  # characters split anew by edits
        pieces = counts.split.findall(text)
        self.blocks, self.block_counts = _cut(pieces, counts.counts(pieces))
        self._sum([_sums(b, c) for b, c in zip(self.blocks, self.block_counts)])

    def _sum(self, known: list[tuple[int, int, int]]) -> None:
        """The tree over the blocks' (characters, tokens, pre-tokens)."""
        self.leaves = 1
        while self.leaves < len(known):
            self.leaves *= 2
        n = self.leaves
        rest = [0] * (n - len(known))
        chars, tokens, sizes = ([0] * n + [k[i] for k in known] + rest for i in range(3))
        for i in range(n - 1, 0, -1):
            chars[i], tokens[i], sizes[i] = chars[2 * i] + chars[2 * i + 1], tokens[2 * i] + tokens[2 * i + 1], sizes[2 * i] + sizes[2 * i + 1]
        self.chars, self.tokens, self.sizes = chars, tokens, sizes

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    @property
    def n_pieces(self) -> int:
        return self.sizes[1]

    def text(self) -> str:
        return "".join([p for b in self.blocks for p in b])

    def _find(self, place: int) -> tuple[int, int]:
        """The block that holds character place (the last one, if it is the end), and the characters before the block."""
        i, before = 1, 0
        while i < self.leaves:
            i *= 2
            if place >= before + self.chars[i] and self.sizes[i + 1]:
                before += self.chars[i]
                i += 1
        return i - self.leaves, before

    def _set(self, block: int, pieces: list[str], counts: list[int]) -> None:
        self.blocks[block], self.block_counts[block] = pieces, counts
        i = self.leaves + block
        dc, dt, ds = sum(map(len, pieces)) - self.chars[i], sum(counts) - self.tokens[i], len(pieces) - self.sizes[i]
        while i:
            self.chars[i] += dc
            self.tokens[i] += dt
            self.sizes[i] += ds
            i //= 2

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace characters start..end by new."""
        start = min(max(start, 0), self.n_chars)
        end = min(max(end, start), self.n_chars)
        first, before = self._find(max(start - LOOK_AHEAD, 0))
        # from the first pre-token that ends within LOOK_AHEAD characters of the edit
        ends = list(accumulate(map(len, self.blocks[first]), initial=before))
        skip = min(bisect_left(ends, start - LOOK_AHEAD + 1, 1) - 1, len(self.blocks[first]))
        origin = ends[skip]
        last, base = self._find(end)
        span = [p for b in self.blocks[first : last + 1] for p in b]
        span_counts = [c for b in self.block_counts[first : last + 1] for c in b]
        head, old = span[:skip], span[skip:]
        size = base + self.chars[self.leaves + last] - origin  # characters from origin to the end of block `last`
        text = "".join(old)
        text = text[: start - origin] + new + text[end - origin :]
        shift = len(new) - (end - start)
        kept_from = set(accumulate(map(len, old), initial=0))
        pieces: list[str] = []
        at, tail, known = 0, [], 0
        while True:
            # more blocks are read only if the split does not meet an old border in those at hand
            found = None
            pieces, at = [], 0
            for m in self.counts.split.finditer(text):
                if at >= start - origin + len(new) and at - shift in kept_from and at - shift < size and at - shift >= end - origin:
                    found = at - shift
                    break
                pieces.append(m.group())
                at = m.end()
            self.work += at
            if found is not None:
                place, i = 0, 0
                while place < found:
                    place += len(old[i])
                    i += 1
                tail, known = old[i:], len(old) - i
                break
            following = last + 1
            while following < len(self.blocks) and not self.blocks[following]:
                following += 1
            if following >= len(self.blocks):
                break
            more = self.blocks[following]
            span_counts += self.block_counts[following]
            kept_from |= set(accumulate(map(len, more), initial=size))
            old += more
            text += "".join(more)
            size += self.chars[self.leaves + following]
            last = following
        # only the pieces split anew are counted; what stays has its counts
        result = head + pieces + tail
        counted = span_counts[:skip] + self.counts.counts(pieces) + (span_counts[-known:] if known else [])
        if len(result) <= 4 * BLOCK:
            for b in range(first + 1, last + 1):
                self._set(b, [], [])
            self._set(first, result, counted)
        else:  # the block has outgrown the tree: it is cut, and the sums are added up anew from the blocks' own
            blocks, block_counts = _cut(result, counted)
            sums = list(zip(*(v[self.leaves : self.leaves + len(self.blocks)] for v in (self.chars, self.tokens, self.sizes))))
            sums[first : last + 1] = [_sums(b, c) for b, c in zip(blocks, block_counts)]
            self.blocks[first : last + 1], self.block_counts[first : last + 1] = blocks, block_counts
            self._sum(sums)


def _cut(pieces: list[str], counts: list[int]) -> tuple[list[list[str]], list[list[int]]]:
    """Blocks of pieces and of their counts; one empty block for none."""
    at = range(0, len(pieces), BLOCK)
    return [pieces[i : i + BLOCK] for i in at] or [[]], [counts[i : i + BLOCK] for i in at] or [[]]


def _sums(block: list[str], counts: list[int]) -> tuple[int, int, int]:
    return sum(map(len, block)), sum(counts), len(block)


def count_edits(docs: DataFrame, edits: Column, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, n_pretokens, n_tokens, edited_chars, edited_tokens and recounted_chars (split anew by the edits) of each row.

    edits: array of structs (at: int, upto: int, text: string), applied in their order. Ids cross to Python as text, since numbers beside
    nulls would turn to floats there.
    """
    path, pattern = path or default_path(), pattern or default_pattern()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = counter(path, pattern)
        for batch in batches:
            rows = []
            for doc_id, text, wanted in zip(batch["doc_id"], batch["text"], batch["edits"]):
                tree = TokenTree(text if isinstance(text, str) else "", own)
                pieces, tokens = tree.n_pieces, tree.n_tokens
                for e in wanted if wanted is not None else ():
                    tree.edit(e["at"], e["upto"], e["text"] or "")
                rows.append((doc_id, pieces, tokens, tree.n_chars, tree.n_tokens, tree.work))
            yield pd.DataFrame(rows, columns=["doc_id", "n_pretokens", "n_tokens", "edited_chars", "edited_tokens", "recounted_chars"])

    sent = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text", edits.alias("edits"))
    found = sent.mapInPandas(run, "doc_id string, n_pretokens long, n_tokens long, edited_chars long, edited_tokens long, recounted_chars long")
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


def standard_edits() -> Column:
    """Three edits of every text: 40 characters in the middle give way to its first 24, 7 at a quarter go, a phrase comes last."""
    n = F.coalesce(F.length("text"), F.lit(0))
    middle, quarter = F.floor(n / 2).cast("int"), F.floor(n / 4).cast("int")
    edit = lambda at, upto, text: F.struct(at.alias("at"), upto.alias("upto"), text.alias("text"))
    far = F.lit(2**31 - 1)
    return F.array(edit(middle, middle + 40, F.substring(F.coalesce("text", F.lit("")), 1, 24)), edit(quarter, quarter + 7, F.lit("")), edit(far, far, F.lit(" It's the end.")))


def op1_edit_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_edits(table(spark, sf_dir, "documents", "doc_id", "text"), standard_edits())


QUERIES = {"op1_edit_token_counts": op1_edit_token_counts}
ORACLES: dict[str, str] = {}
