"""BPE encoding and decoding with a minimal acyclic transducer as lexicon.

The tokenizer file (word ends, lower case, white space dropped) is read as it is: added tokens are cut out of the raw
text, the rest is put in NFC and lower case and falls into words at white space. No alternative of the split pattern
matches white space, so a word's ids do not depend on its neighbours.

Lexicon: all words of the corpus of up to LEXICON_CHARS characters are counted; the LEXICON_WORDS most frequent are compiled on the
driver into a minimal acyclic automaton (common suffixes share states) whose arcs carry counts, so that a path numbers its word; the
number points at the word's ids. The file, named by its content, is put into the shared folder; Spark hands it to the executors, where
every worker maps it into memory. Words outside the lexicon are merged exactly, pair by pair. Both limits bound the file, not the result.

Defined results: a null text is empty, with no ids and an empty decoded text; a text of any length, also of one word, is encoded whole;
a null or very large doc_id stays as it is; repeated rows give repeated results; an empty table has an empty lexicon and result; other
columns are not read. What is a letter is known for all code points up to Unicode 15.1; later ones may be split otherwise than by the library.
"""

from __future__ import annotations

import hashlib
import json
import os
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, ensure_shared_dir, table

LEXICON_WORDS, LEXICON_CHARS = 131_072, 64
#: Words of the lexicon occur so often at least.
MIN_COUNT = 2
#: Entries of a worker's word cache, of its pre-token cache and of its counters before they are emptied.
CACHE_WORDS, CACHE_PIECES, COUNTED_WORDS = 600_000, 200_000, 300_000

_SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")  # white space to str.split, but not to the tokenizer


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 itself, others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(moved)) for b in range(256)]


class WordBpe:
    """The tokenizer of one file: words to ids, ids to text."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, end = spec["model"], spec["model"]["end_of_word_suffix"]
        vocab: dict[str, int] = model["vocab"]
        self.strings: list[str] = [""] * (1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]))
        for s, i in vocab.items():
            self.strings[i] = s
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for s, i in self.added.items():
            self.strings[i] = s
        self._added = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.added, key=len, reverse=True)) + ")")
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self._split = regex.compile(split.replace("[^\\s", "[^\\p{White_Space}"))
        letters = byte_letters()
        self.inner = [vocab[c] for c in letters]
        self.last = [vocab[c + end] for c in letters]
        self.pairs: dict[int, int] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.pairs.setdefault(vocab[a] << 17 | vocab[b], rank << 17 | vocab[a + b])
        self.table = PairTable(self.pairs)
        self._pieces: dict[str, bytes] = {}

    def parts(self, text: str) -> list[str]:
        """Text between added tokens, and those tokens at the odd places."""
        return self._added.split(text) if any(s in text for s in self.added) else [text]

    def words(self, part: str) -> list[str]:
        """The words of text without added tokens, in normal form."""
        if not part.isascii():
            part = unicodedata.normalize("NFC", part)
            if "Σ" in part:
                part = part.replace("Σ", "σ")  # lower case letter by letter, whatever follows
        part = part.lower()
        if any(s in part for s in _SEPARATORS):
            return regex.findall(r"\P{White_Space}+", part)
        return part.split()

    def merge_one(self, piece: str) -> bytes:
        """Ids (little-endian unsigned 32 bits) of one pre-token: the pair of least rank, leftmost first, until none is left."""
        raw = piece.encode()
        ids = [self.inner[b] for b in raw[:-1]] + [self.last[raw[-1]]]
        # a heap of (pair, place) and links between the pieces that are left: n log n for words of any length
        get, end = self.pairs.get, len(ids)
        after, before = list(range(1, end + 1)), list(range(-1, end - 1))
        heap = [(rank, i) for i, rank in enumerate(map(get, [a << 17 | b for a, b in zip(ids, ids[1:])])) if rank is not None]
        heapify(heap)
        while heap:
            best, i = heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= end or get(ids[i] << 17 | ids[j]) != best:
                continue  # one of the two has been merged since
            ids[i], ids[j] = best & 0x1FFFF, -1
            k = after[i] = after[j]
            if k < end:
                before[k] = i
                if (rank := get(ids[i] << 17 | ids[k])) is not None:
                    heappush(heap, (rank, i))
            if (h := before[i]) >= 0 and (rank := get(ids[h] << 17 | ids[i])) is not None:
                heappush(heap, (rank, h))
        return np.array([i for i in ids if i >= 0], "<u4").tobytes()

    def encode_word(self, word: str) -> bytes:
        return b"".join([self.merge_one(p) for p in self._split.findall(word)])

    def forget(self) -> None:
        """Empty the cache of pre-tokens."""
        self._pieces.clear()

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word; new pre-tokens of all words are merged together."""
        findall = self._split.findall
        split = [[w] if w.isalpha() else findall(w) for w in words]  # letters only: one pre-token
        new = [p for p in {p for pieces in split for p in pieces} if p not in self._pieces]
        if len(self._pieces) + len(new) > CACHE_PIECES:
            self._pieces.clear()
            new = list({p for pieces in split for p in pieces})
        short = sorted((p for p in new if len(p) <= LONGEST_TOGETHER), key=len)
        for at in range(0, len(short), 2048):
            block = short[at : at + 2048]
            self._pieces.update(zip(block, self._merge_block(block)))
        for p in new:
            if len(p) > LONGEST_TOGETHER:
                self._pieces[p] = self.merge_one(p)
        get = self._pieces.__getitem__
        return [get(pieces[0]) if len(pieces) == 1 else b"".join(map(get, pieces)) for pieces in split]

    def _merge_block(self, pieces: list[str]) -> list[bytes]:
        """merge_one() of many pre-tokens in step: each round joins the leftmost pair of least rank of every one."""
        raw = [p.encode() for p in pieces]
        left = np.fromiter(map(len, raw), np.int64, len(raw))
        n, width = len(raw), int(left.max())
        inside = np.arange(width) < left[:, None]
        data = np.frombuffer(b"".join(raw), np.uint8)
        ids = np.zeros((n, width), np.int64)
        ids[inside] = np.array(self.inner)[data]
        ids[np.arange(n), left - 1] = np.array(self.last)[data[np.cumsum(left) - 1]]
        ranks = np.full((n, width), NO_PAIR)
        pairs = inside[:, 1:]
        ranks[:, :-1][pairs] = self.table.get(ids[:, :-1][pairs], ids[:, 1:][pairs])
        out: list[bytes] = [b""] * n
        rows, columns = np.arange(n), np.arange(width)
        while len(rows):
            at = ranks.argmin(1)
            every = np.arange(len(rows))
            best = ranks[every, at]
            done = best == NO_PAIR
            if done.any():
                for r, k, own in zip(rows[done].tolist(), left[done].tolist(), ids[done].astype("<u4")):
                    out[r] = own[:k].tobytes()
                go = ~done
                rows, ids, ranks, left, at, best = rows[go], ids[go], ranks[go], left[go], at[go], best[go]
                every = np.arange(len(rows))
                if not len(rows):
                    break
            ids = np.take_along_axis(ids, np.minimum(columns + (columns > at[:, None]), width - 1), 1)
            ranks = np.take_along_axis(ranks, np.minimum(columns + (columns >= at[:, None]), width - 1), 1)
            left = left - 1
            ids[every, at] = best & 0x1FFFF
            before = np.flatnonzero(at > 0)
            ranks[before, at[before] - 1] = self.table.get(ids[before, at[before] - 1], ids[before, at[before]])
            after = np.flatnonzero(at < left - 1)
            ranks[after, at[after]] = self.table.get(ids[after, at[after]], ids[after, at[after] + 1])
            ends = np.flatnonzero(at == left - 1)
            ranks[ends, at[ends]] = NO_PAIR
        return out

    def decode(self, ids: bytes) -> str:
        """The tokens' strings, joined by spaces: what this file's decoder does."""
        return " ".join(map(self.strings.__getitem__, memoryview(ids).cast("I")))


#: Characters of the pre-tokens that are merged in blocks; longer ones are merged one by one.
LONGEST_TOGETHER = 24
NO_PAIR = np.int64(1 << 60)


class PairTable:
    """Open-addressing table of merges: (left id, right id) -> rank << 17 | merged id, looked up for whole arrays."""

    def __init__(self, pairs: dict[int, int]) -> None:
        bits = max(4, (2 * len(pairs)).bit_length())
        self.mask, self.shift = (1 << bits) - 1, np.uint64(64 - bits)
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, NO_PAIR)
        self.probes = 0
        keys = np.fromiter(pairs, np.int64, len(pairs))
        for key, value, slot in zip(pairs, pairs.values(), self._home(keys).tolist()):
            n = 0
            while self.keys[(slot + n) & self.mask] != -1:
                n += 1
            self.keys[(slot + n) & self.mask], self.values[(slot + n) & self.mask] = key, value
            self.probes = max(self.probes, n + 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 17 | b
        slot = self._home(key)
        held = self.keys[slot]
        out = np.where(held == key, self.values[slot], NO_PAIR)
        open_ = np.flatnonzero((held != key) & (held != -1))
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            at = (slot[open_] + 1) & self.mask
            slot[open_] = at
            held = self.keys[at]
            hit = held == key[open_]
            out[open_[hit]] = self.values[at[hit]]
            open_ = open_[~hit & (held != -1)]
        return out


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordBpe:
    return WordBpe(path)


def minimal_automaton(words: list[bytes]) -> tuple[list[dict[int, int]], list[bool]]:
    """Arcs and final marks of the minimal acyclic automaton of sorted distinct words, built word by word; state 0 starts."""
    arcs: list[dict[int, int]] = [{}]
    final = [False]
    register: dict[tuple, int] = {}
    free: list[int] = []
    path: list[tuple[int, int]] = []  # (state, byte) from the start along the last word
    last = b""

    def settle(keep: int) -> None:
        """States of the last word beyond its first keep bytes become registered ones, or give way to their equals."""
        while len(path) > keep:
            state, byte = path.pop()
            child = arcs[state][byte]
            key = (final[child], tuple(arcs[child].items()))
            equal = register.setdefault(key, child)
            if equal != child:
                arcs[state][byte] = equal
                arcs[child] = {}
                free.append(child)

    for word in words:
        shared = len(os.path.commonprefix([word, last]))
        settle(shared)
        state = arcs[path[-1][0]][path[-1][1]] if path else 0
        for byte in word[shared:]:
            if free:
                new = free.pop()
                arcs[new], final[new] = {}, False
            else:
                new = len(arcs)
                arcs.append({})
                final.append(False)
            arcs[state][byte] = new
            path.append((state, byte))
            state = new
        final[state] = True
        last = word
    settle(0)
    return arcs, final


class Lexicon:
    """The transducer: slots of an open-addressing table hold (state, byte) -> state, words passed; outputs by number."""

    MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, path: str) -> None:
        flat = np.memmap(path, np.uint32, "r").view(np.ndarray)
        slots, states, words, outputs, self.probes = (int(x) for x in flat[:5])
        self.shift = np.uint64(64 - (slots.bit_length() - 1))
        sizes = (slots, slots, slots, states, words + 1, outputs)
        at = 8 + np.cumsum([0, *sizes])
        self.keys, self.targets, self.passed, self.final, self.offsets, self.ids = (flat[a : a + n] for a, n in zip(at, sizes))
        self.words = words
        self.output = memoryview(self.ids).cast("B")

    @classmethod
    def compile(cls, entries: dict[str, bytes]) -> bytes:
        """The file of word -> ids."""
        words = sorted(w.encode() for w in entries)
        arcs, final = minimal_automaton(words)
        below: dict[int, int] = {}
        stack = [0]
        while stack:  # words accepted from each state on
            s = stack[-1]
            waiting = [t for t in arcs[s].values() if t not in below]
            if waiting:
                stack += waiting
            else:
                below[s] = final[s] + sum(below[t] for t in arcs[s].values())
                stack.pop()
        order = {s: i for i, s in enumerate(sorted(below))}
        keys, targets, passed = [], [], []
        for s, i in order.items():
            before = int(final[s])
            for byte, t in sorted(arcs[s].items()):
                keys.append(i << 8 | byte)
                targets.append(order[t])
                passed.append(before)
                before += below[t]
        slots = 1 << max(4, (2 * len(keys)).bit_length())
        table_ = np.full((3, slots), 0xFFFFFFFF, np.uint32)
        home = ((np.array(keys, np.uint64) * cls.MULTIPLIER) >> np.uint64(64 - (slots.bit_length() - 1))).astype(np.int64)
        probes = 0
        for i, slot in enumerate(home.tolist()):
            n = 0
            while table_[0, (slot + n) % slots] != 0xFFFFFFFF:
                n += 1
            table_[:, (slot + n) % slots] = keys[i], targets[i], passed[i]
            probes = max(probes, n + 1)
        outputs = [np.frombuffer(entries[w.decode()], "<u4") for w in words]
        offsets = np.cumsum([0, *map(len, outputs)])
        head = np.array([slots, len(order), len(words), offsets[-1], probes, 0, 0, 0], np.uint32)
        ends = np.array([final[s] for s in order], np.uint32)
        return b"".join(part.astype("<u4").tobytes() for part in (head, table_.ravel(), ends, offsets.astype(np.uint32), *outputs))

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Number of each word, -1 if the automaton does not accept it: all words step through it together."""
        out = np.full(len(words), -1, np.int64)
        if not self.words or not words:
            return out
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(-lengths, kind="stable")
        data = np.frombuffer(b"".join(words), np.uint8)
        starts = (np.cumsum(lengths) - lengths)[order]
        lengths = lengths[order]
        state, number = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        for place in range(int(lengths[0])):
            going = np.searchsorted(-lengths, -place, "left")
            alive = np.flatnonzero(state[:going] >= 0)
            if not len(alive):
                break
            key = (state[alive] << 8) | data[starts[alive] + place]
            slot = ((key.astype(np.uint64) * self.MULTIPLIER) >> self.shift).astype(np.int64)
            target, passed = np.full(len(alive), -1, np.int64), np.zeros(len(alive), np.int64)
            open_ = np.arange(len(alive))
            for _ in range(self.probes):
                at = slot[open_] & (len(self.keys) - 1)
                held = self.keys[at]
                hit = held == key[open_]
                target[open_[hit]], passed[open_[hit]] = self.targets[at[hit]], self.passed[at[hit]]
                open_ = open_[~hit & (held != 0xFFFFFFFF)]
                if not len(open_):
                    break
                slot[open_] += 1
            state[alive], number[alive] = target, number[alive] + passed
        accepted = (state >= 0) & (lengths > 0)
        accepted[accepted] = self.final[state[accepted]] == 1
        out[order] = np.where(accepted, number, -1)
        return out

    def lookup(self, words: list[str]) -> list[bytes | None]:
        """Ids of each word, None for words outside the lexicon."""
        numbers = self.numbers([w.encode() for w in words])
        starts, ends = (self.offsets[numbers] * 4).tolist(), (self.offsets[numbers + 1] * 4).tolist()
        return [self.output[a:b].tobytes() if n >= 0 else None for n, a, b in zip(numbers.tolist(), starts, ends)]


class Encoder:
    """A worker's encoder: lexicon first, exact merges for other words, both behind one bounded cache."""

    def __init__(self, bpe: WordBpe, lexicon: Lexicon | None) -> None:
        self.bpe, self.lexicon, self.known = bpe, lexicon, {}

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > CACHE_WORDS:
            self.known.clear()
            new = list(words)
        found = self.lexicon.lookup(new) if self.lexicon else [None] * len(new)
        self.known.update((w, ids) for w, ids in zip(new, found) if ids is not None)
        unseen = [w for w, ids in zip(new, found) if ids is None]
        self.known.update(zip(unseen, self.bpe.encode_words(unseen)))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, little-endian unsigned 32 bits."""
        split = [[(self.bpe.words(p) if not i & 1 else p) for i, p in enumerate(self.bpe.parts(t or ""))] for t in texts]
        self.learn({w for text in split for part in text[::2] for w in part})
        get, added = self.known.__getitem__, self.bpe.added
        return [b"".join([b"".join(map(get, p)) if not i & 1 else added[p].to_bytes(4, "little") for i, p in enumerate(text)]) for text in split]


def word_counts(docs: DataFrame, path: str) -> DataFrame:
    """word, n over all texts, of words of up to LEXICON_CHARS characters: counted in each task first, then added up."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe, seen = tokenizer(path), Counter()
        emit = lambda: pd.DataFrame({"word": list(seen), "n": list(seen.values())})
        for batch in batches:
            for text in batch["text"]:
                if text:
                    for part in bpe.parts(text)[::2]:
                        seen.update([w for w in bpe.words(part) if len(w) <= LEXICON_CHARS])
                    if len(seen) > COUNTED_WORDS:
                        yield emit()
                        seen.clear()
        if seen:
            yield emit()

    return docs.select("text").mapInPandas(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(docs: DataFrame, path: str, most: int) -> list[str]:
    """Words of at least MIN_COUNT occurrences down to the count at which there would be more than most, by sixteenths of an octave.

    The driver gets one row a count bin, then at most `most` words.
    """
    counts = cut(word_counts(docs, path).where(F.col("n") >= MIN_COUNT).withColumn("bin", F.floor(F.log2("n") * 16).cast("int")))
    least, total = None, 0
    for r in sorted(counts.groupBy("bin").agg(F.count("*").alias("words")).collect(), key=lambda r: -r["bin"]):
        total += r["words"]
        if total > most:
            break
        least = r["bin"]
    return [] if least is None else [r["word"] for r in counts.where(F.col("bin") >= least).select("word").collect()]


def build_lexicon(docs: DataFrame, path: str, words: int = LEXICON_WORDS) -> str:
    """Compile the most frequent words of docs into a file that Spark hands to the executors; its name there.

    A corpus whose words are as before has its file already.
    """
    top = frequent_words(docs, path, words)
    bpe = tokenizer(path)
    data = Lexicon.compile(dict(zip(top, bpe.encode_words(top))))
    bpe.forget()
    spark = docs.sparkSession
    name = f"lexicon-{hashlib.sha256(data).hexdigest()[:32]}.bin"
    place = f"{ensure_shared_dir(spark)}/{name}"
    jvm = spark._jvm
    to_path = jvm.org.apache.hadoop.fs.Path
    store = to_path(place).getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(to_path(place)):
        part = to_path(f"{place}.{uuid.uuid4().hex}")
        out = store.create(part, True)
        for at in range(0, len(data), 1 << 20):
            out.write(bytearray(data[at : at + (1 << 20)]))
        out.close()
        store.rename(part, to_path(place))
    spark.sparkContext.addFile(place)
    return name


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def _encoder(path: str, name: str) -> Encoder:
    if (path, name) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path, name] = Encoder(tokenizer(path), Lexicon(SparkFiles.get(name)))
    return _ENCODERS[path, name]


def _parts(batches: Iterator[pd.DataFrame], rows: int = 256) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.iloc[at : at + rows]


def _sent(docs: DataFrame) -> DataFrame:
    """doc_id and text; ids cross to Python as text, since numbers beside nulls would turn to floats there."""
    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")


def encode(docs: DataFrame, path: str | None = None, lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """doc_id, ids array<long> and decoded text of each row."""
    path = path or default_path()
    name = build_lexicon(docs, path, lexicon_words)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        worker = _encoder(path, name)
        for part in _parts(batches):
            coded = worker.encode(part["text"].tolist())
            ids = [np.frombuffer(c, "<u4").astype(np.int64) for c in coded]
            yield pd.DataFrame({"doc_id": part["doc_id"].to_numpy(), "ids": ids, "decoded": [worker.bpe.decode(c) for c in coded]})

    found = _sent(docs).mapInPandas(run, "doc_id string, ids array<long>, decoded string")
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


def encode_digests(docs: DataFrame, path: str | None = None, lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row's text; the text is decoded from its ids."""
    path = path or default_path()
    name = build_lexicon(docs, path, lexicon_words)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        worker = _encoder(path, name)
        for part in _parts(batches):
            coded = worker.encode(part["text"].tolist())
            yield pd.DataFrame({
                "doc_id": part["doc_id"].to_numpy(),
                "n_tokens": [len(ids) // 4 for ids in coded],
                "ids_sha256": [hashlib.sha256(ids).hexdigest() for ids in coded],
                "decoded_sha256": [hashlib.sha256(worker.bpe.decode(ids).encode()).hexdigest() for ids in coded],
            })

    found = _sent(docs).mapInPandas(run, "doc_id string, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(table(spark, sf_dir, "documents", "doc_id", "text"))


QUERIES = {"op4_bpe_round_trip": op4_bpe_round_trip}
ORACLES: dict[str, str] = {}
