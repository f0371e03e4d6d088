"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within RADIUS bits share a variant within RADIUS / 2 bits of both. Every distinct fingerprint therefore
stands for all its variants of up to RADIUS / 2 flipped bits (2,081 of 64 bits), and fingerprints that share a variant
are linked. The shuffle goes by the variants' leading bits: a fingerprint is sent once to each cell (a value of those
bits) that any of its variants falls in, with the flips left for the other bits, and the cell's task makes and sorts the
variants there. Cells of many variants are dealt further by parity bits of the variant, as many as its
size asks for, so that a hot group's variants spread over many tasks, each variant in exactly one.

All fingerprints that share a variant lie within RADIUS of each other, and each such pair is verified by its bit
distance as it is linked. A task returns a spanning forest of its cell's links, not the pairs: no more rows than fingerprints
it got. Components are then found by min-label contraction over those links, in checkpointed rounds. Joins on fingerprints, nodes
and roots send what hot ones need to every task (hot_join), so a large component, a hub or a much copied text does not meet in one.

Defined results: null, empty and wordless texts have fingerprint zero and are linked like any other; repeated rows each
get a row; a null doc_id gets its component but never names one, a very large one stays as it is; texts of any length are read whole;
an empty table gives an empty result; other columns, whatever their names, are kept by keep_one and not read otherwise.
"""

from __future__ import annotations

import re
from functools import lru_cache, partial
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import HOT_ROWS, cut, hot_join, small_side, table

BITS, RADIUS, SHINGLE = 64, 4, 4
HALF = RADIUS // 2
#: Variants that a cell should hold on average, those from which it is dealt by parity bits, and the most such bits.
CELL_VARIANTS, HOT_VARIANTS, PARITY = 1_000_000, 3_000_000, 10
SEED = 42

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_hash = partial(xxhash.xxh64_intdigest, seed=SEED)


def fingerprint(text: str | None, words: int = SHINGLE) -> int:
    """SimHash of the words' shingles, repeats included; the whole sequence if it is shorter; 0 for no words."""
    found = _WORD.findall((text or "").encode().lower())
    if not found:
        return 0
    if len(found) <= words:
        return _hash(b" ".join(found))
    return _majority(np.fromiter(map(_hash, map(b" ".join, zip(*(found[i:] for i in range(words))))), np.uint64))


def _majority(hashes: np.ndarray) -> int:
    """Bits set in more than half of hashes."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 8192):
        ones += np.unpackbits(hashes[at : at + 8192].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, *keep: str) -> DataFrame:
    """Columns keep of docs and fp, the fingerprint of each row's text as a signed long; only the text goes to Python."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t if isinstance(t, str) else None) for t in texts], np.uint64).view(np.int64))

    return docs.select(*[F.col(f"`{c}`") for c in keep], of(F.col("text")).alias("fp"))


@lru_cache(maxsize=8)
def flips(bits: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Masks of up to most set bits among the lowest bits, and the number set in each."""
    masks = [(sum(1 << b for b in c), k) for k in range(min(most, bits) + 1) for c in combinations(range(bits), k)]
    return np.array([m for m, _ in masks], np.uint64), np.array([k for _, k in masks], np.int64)


def _parity_masks() -> np.ndarray:
    """PARITY pseudo-random 64-bit words; a parity bit of v is that of the set bits of v & word."""
    return np.array([_hash(b"parity %d" % i) for i in range(PARITY)], np.uint64)


def parities(values: np.ndarray, bits: int) -> np.ndarray:
    """The first parity bits of each value, as a number; linear: parities(a ^ b) = parities(a) ^ parities(b)."""
    out = np.zeros(len(values), np.int64)
    for i, word in enumerate(_parity_masks()[:bits]):
        out |= (np.bitwise_count(values & word).astype(np.int64) & 1) << i
    return out


def routes(distinct: DataFrame, prefix: int) -> DataFrame:
    """cell, fp, budget: each fingerprint at every cell that its variants reach, with the flips left for other bits."""
    masks, used = flips(prefix, HALF)
    rows = F.array(*[F.struct(F.lit(int(m)).alias("m"), F.lit(HALF - int(k)).alias("budget")) for m, k in zip(masks, used)])
    top = F.shiftrightunsigned("fp", BITS - prefix)
    step = distinct.select("fp", F.explode(rows).alias("r"))
    return step.select(top.bitwiseXOR(F.col("r.m").cast("long")).cast("int").alias("cell"), "fp", F.col("r.budget").cast("int").alias("budget"))


def link_cell(fp: np.ndarray, budget: np.ndarray, cell: int, prefix: int, bits: int = 0, parity: int = 0) -> np.ndarray:
    """Spanning forest (n, 2) of the fingerprints that share variants in the cell whose first parity bits are parity."""
    low = BITS - prefix
    suffix_mask = np.uint64((1 << low) - 1)
    values = fp.view(np.uint64)
    suffix = values & suffix_mask
    made, owners = [], []
    top = np.uint64(cell << low if low < BITS else 0)
    for b in range(HALF + 1):
        own = np.flatnonzero(budget == b)
        if not len(own):
            continue
        masks, _ = flips(low, b)
        # variant = top | (suffix ^ mask); its parities are known from those of its parts
        have = parities(top | suffix[own], bits)
        of_mask = parities(masks, bits)
        for p in np.unique(have):
            some, chosen = own[have == p], masks[of_mask == (p ^ parity)]
            made.append((suffix[some, None] ^ chosen[None]).ravel())
            owners.append(np.repeat(some.astype(np.int32), len(chosen)))
    if not made:
        return np.zeros((0, 2), np.int64)
    variants, owner = np.concatenate(made), np.concatenate(owners)
    order = np.argsort(variants, kind="quicksort")
    variants, owner = variants[order], owner[order]
    same = np.flatnonzero(variants[1:] == variants[:-1])
    a, b = owner[same].astype(np.int64), owner[same + 1].astype(np.int64)
    links = np.unique((np.minimum(a, b) << 32) | np.maximum(a, b))
    a, b = links >> 32, links & 0xFFFFFFFF
    if not (np.bitwise_count(values[a] ^ values[b]) <= RADIUS).all():
        raise AssertionError("a shared variant links fingerprints beyond the radius")
    return forest(a, b, fp)


def forest(a: np.ndarray, b: np.ndarray, fp: np.ndarray) -> np.ndarray:
    """For links between places a and b of fp: rows (fp, least fp of its component), but for the least itself."""
    label = np.argsort(np.argsort(fp, kind="stable"), kind="stable")  # rank by value
    while len(a):
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        by_rank = np.empty(len(fp), np.int64)
        by_rank[np.argsort(np.argsort(fp, kind="stable"), kind="stable")] = np.arange(len(fp))
        new = np.minimum(new, new[by_rank[new]])
        if (new == label).all():
            break
        label = new
    value = np.sort(fp, kind="stable")[label]
    moved = np.flatnonzero(value != fp)
    return np.stack([fp[moved], value[moved]], 1)


def links(distinct: DataFrame, n: int) -> DataFrame:
    """a, b: links between fingerprints within RADIUS bits, as spanning forests of cells. distinct: fp without repeats; n: its rows."""
    prefix = 8
    while n * 2081 / (1 << prefix) > CELL_VARIANTS and prefix < 24:
        prefix += 1
    sent = routes(distinct, prefix)
    variants = F.sum(F.element_at(F.array(*[F.lit(len(flips(BITS - prefix, k)[0])) for k in range(HALF + 1)]), F.col("budget") + 1))
    bits = F.least(F.lit(PARITY), F.ceil(F.log2(F.col("n") / F.lit(CELL_VARIANTS)))).cast("int")
    hot = cut(sent.groupBy("cell").agg(variants.alias("n")).where(F.col("n") > HOT_VARIANTS).select("cell", bits.alias("bits")))
    sent = sent.join(small_side(hot, hot.count(), 16), "cell", "left").withColumn("bits", F.coalesce("bits", F.lit(0)))
    sent = sent.withColumn("parity", F.explode(F.sequence(F.lit(0), F.expr("shiftleft(1, bits) - 1"))))

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        found = link_cell(rows["fp"].to_numpy(), rows["budget"].to_numpy(), int(key[0]), prefix, int(key[1]), int(key[2]))
        return pd.DataFrame({"a": found[:, 0], "b": found[:, 1]})

    return sent.select("cell", "bits", "parity", "fp", "budget").groupBy("cell", "bits", "parity").applyInPandas(run, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root: the least node reachable over edges (a, b), by large-star and small-star rounds."""
    edges = cut(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before, n = None, edges.count()
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("degree")).select("a", F.least("a", "m").alias("m"), "degree")
        large = hot_join(both.where("b > a"), least, "a", "degree", 24, 2 * n).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        large = large if n <= HOT_ROWS else cut(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("degree"))
        small = hot_join(large, least, "a", "degree", 24, 2 * n).select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
        edges = cut(small.where("a != b").distinct())
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before, n = state, state[0]


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fp and component_id (least doc_id reachable) of each row of docs (doc_id, text)."""
    prints = cut(fingerprints(docs, "doc_id"))
    named = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies")))
    n = named.count()
    found = components(links(named.select("fp"), n))
    # the members of components of more than one, with what names them
    members = found.unionByName(found.select(F.col("root").alias("node"), "root").distinct()).withColumnRenamed("node", "fp")
    members = cut(hot_join(named.select("fp", "least"), members.withColumn("one", F.lit(1)), "fp", "one", 24, n))
    least = members.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("size"))
    renamed = hot_join(members, least, "root", "size", 24, n).select("fp", F.col("component_id").alias("of"), F.lit(True).alias("linked"))
    answers = named.join(renamed, "fp", "left").select("fp", F.when(F.col("linked"), F.col("of")).otherwise(F.col("least")).alias("component_id"), "copies")
    return hot_join(prints, answers, "fp", "copies", 32, n).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of docs, with its columns, whose doc_id names their component; of rows that repeat a kept doc_id one stays.

    Rows with a null doc_id all stay: they can't be named.
    """
    found = near_duplicates(docs.select("doc_id", "text")).where(F.col("doc_id").isNotNull())
    by_id = cut(found.groupBy("doc_id").agg(F.max(F.col("doc_id") == F.col("component_id")).alias("stays"), F.count("*").alias("n")))
    goes, repeats = by_id.where(~F.col("stays")).select("doc_id"), by_id.where(F.col("stays") & (F.col("n") > 1)).select("doc_id")
    kept = docs.join(small_side(goes, goes.count(), 16), "doc_id", "left_anti").select(*docs.columns)
    if not repeats.limit(1).count():
        return kept
    again = small_side(repeats, repeats.count(), 16)
    return kept.join(again, "doc_id", "left_anti").select(*docs.columns).union(kept.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(*docs.columns))


def op2_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op2_simhash_components": op2_simhash_components}
ORACLES: dict[str, str] = {}
