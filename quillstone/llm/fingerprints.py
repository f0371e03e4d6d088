"""Homomorphic multiset fingerprints of documents, in DataFrame functions only.

A text is the multiset of its paragraphs (lines). Every paragraph hashes to a wide vector, and a text's vector is the
sum over its paragraphs, lane by lane, modulo powers of two; so the order of paragraphs does not matter, and adding or
taking away paragraphs adds or takes away their vectors. A vector has two banks:

* SUM_LANES lanes modulo 2**64 from salted 64-bit hashes of the whole paragraph, for equality;
* BIT_LANES lanes modulo 2**32 from the paragraph's word trigrams (the whole paragraph, if shorter): a trigram adds +1 to lane
  i if bit i of its hash is set, else -1. Sums of such lanes keep inner products (tug of war), so the cosine of two
  texts' lanes, cut off below zero, estimates the likeness of their trigram multisets.

A fingerprint is the hexadecimal of all lanes. An edited text is not hashed anew: only the paragraphs from the cut on are, and
their old vectors are subtracted from the sum as the new ones are added.

Defined results: a null text is empty and its vector zero; equal fingerprints have likeness 1, and a zero vector has likeness 0
with any other; documents are ordered by doc_id (nulls last), those of one doc_id, or of none, by a hash of the text; the last is
followed by the first, so that rows that repeat a doc_id follow each other and the only document follows itself; texts of any
length are fingerprinted whole; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, let, small_side, table

SUM_LANES, BIT_LANES, BIT_BITS, SHINGLE = 4, 64, 32, 3
#: Documents of one span of doc_id, on average, and the most spans.
SPAN_ROWS, MAX_SPANS = 1_000, 65_536
_NULL_ID = 2**63 - 1


def paragraphs(text: Column) -> Column:
    """The lines of text, without empty ones."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda p: F.length(p) > 0)


def _trigrams(words: Column) -> Column:
    """Hashes of the word trigrams of an array of words; of all words together, if there are fewer."""
    n = F.size(words)
    many = F.transform(F.sequence(F.lit(1), n - (SHINGLE - 1)), lambda i: F.xxhash64(F.element_at(words, i), F.element_at(words, i + 1), F.element_at(words, i + 2)))
    return F.when(n >= SHINGLE, many).otherwise(F.array(F.xxhash64(F.array_join(words, " "), F.lit("short"))))


def _pieces(text: Column) -> Column:
    """Trigram hashes of all paragraphs of text, paragraph by paragraph."""
    words = F.transform(paragraphs(text), lambda p: F.split(p, " "))
    return F.flatten(F.transform(words, _trigrams))


def _wrap_sum(hashes: Column) -> Column:
    """Sum of an array of longs modulo 2**64: the halves are added without overflow, then joined."""
    return let(hashes, _wrap_sum_of)


def _wrap_sum_of(hashes: Column) -> Column:
    low = F.aggregate(hashes, F.lit(0).cast("long"), lambda a, h: a + h.bitwiseAND(F.lit(0xFFFFFFFF)))
    high = F.aggregate(hashes, F.lit(0).cast("long"), lambda a, h: a + F.shiftrightunsigned(h, 32))
    high = (high + F.shiftrightunsigned(low, 32)).bitwiseAND(F.lit(0xFFFFFFFF))
    return F.shiftleft(high, 32).bitwiseOR(low.bitwiseAND(F.lit(0xFFFFFFFF)))


def sum_lanes(text: Column) -> Column:
    """Array of SUM_LANES longs: the equality bank."""
    salted = lambda lane: F.transform(paragraphs(text), lambda p: F.xxhash64(p, F.lit(lane)))
    return F.array(*[_wrap_sum(salted(lane)) for lane in range(SUM_LANES)])


def _add_wrapped(a: Column, b: Column, sign: int) -> Column:
    """a + sign * b modulo 2**64."""
    lows = F.lit(0xFFFFFFFF)
    low = a.bitwiseAND(lows) + F.lit(sign) * b.bitwiseAND(lows)
    high = F.shiftrightunsigned(a, 32) + F.lit(sign) * F.shiftrightunsigned(b, 32) + F.shiftright(low, 32)
    return F.shiftleft(high.bitwiseAND(lows), 32).bitwiseOR(low.bitwiseAND(lows))


def bit_sums(segments: DataFrame, *keys: str) -> DataFrame:
    """keys, pieces and bits (array of BIT_LANES counts of set hash bits) of all texts that share keys.

    segments: keys and text. Trigram hashes are exploded and summed 2 lanes a long, each with 32 bits of room.
    """
    both = 0x0000000100000001
    rows = segments.select(*keys, F.explode_outer(_pieces(F.col("text"))).alias("h"))
    half = BIT_LANES // 2
    sums = [F.sum(F.coalesce((F.shiftrightunsigned("h", i) if i else F.col("h")).bitwiseAND(F.lit(both)), F.lit(0))).alias(f"s{i}") for i in range(half)]
    found = rows.groupBy(*keys).agg(F.count("h").alias("pieces"), *sums)
    lows = [F.col(f"s{i}").bitwiseAND(F.lit(0xFFFFFFFF)) for i in range(half)]
    highs = [F.shiftrightunsigned(f"s{i}", 32) for i in range(half)]
    return found.select(*keys, "pieces", F.array(*lows, *highs).alias("bits"))


def _lanes(bits: Column, pieces: Column) -> Column:
    """Signed lanes 2 * bits - pieces, modulo 2**BIT_BITS, as numbers from -2**31 on; no text has the 2**31 trigrams that would wrap."""
    half = F.lit(1 << (BIT_BITS - 1))
    return F.transform(bits, lambda b: (F.pmod(2 * b - pieces + half, F.lit(1 << BIT_BITS)) - half).cast("int"))


def fingerprint_of(sums: Column, lanes: Column) -> Column:
    """Hexadecimal of both banks."""
    first = F.array_join(F.transform(sums, lambda s: F.lpad(F.hex(s), 16, "0")), "")
    second = F.array_join(F.transform(lanes, lambda c: F.lpad(F.hex(F.pmod(c, F.lit(1 << BIT_BITS))), BIT_BITS // 4, "0")), "")
    return F.lower(F.concat(first, second))


def likeness(print_a: Column, lanes_a: Column, print_b: Column, lanes_b: Column) -> Column:
    """Cosine of the signed lanes, from 0 to 1; 1 for equal fingerprints."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norms = F.sqrt(dot(lanes_a, lanes_a) * dot(lanes_b, lanes_b))
    return F.when(print_a == print_b, F.lit(1.0)).when(norms > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), dot(lanes_a, lanes_b) / norms))).otherwise(F.lit(0.0))


def spans_of(ids: DataFrame) -> Column:
    """The span of each row of ids (id, tie): how many of the cut points, about SPAN_ROWS rows apart by quantile, are not above its id.

    An id that is several cut points holds many rows; they are split into as many spans by tie, a hash below 2**63.
    """
    n = ids.count()
    parts = min(MAX_SPANS, max(1, n // SPAN_ROWS))
    shares = [i / parts for i in range(1, parts)]
    found = ids.agg(F.percentile_approx("id", shares, F.lit(10 * parts)).alias("cuts")).first()["cuts"] if shares and n else None
    splits = Counter(found or [])
    points = sorted(splits)
    if not points:
        return F.lit(0)
    # a split id has spans of its own, then come the ids up to the next point; any other point shares a span with them
    widths = [splits[p] + 1 if splits[p] > 1 else 1 for p in points]
    firsts = list(accumulate(widths, initial=1))[:-1]
    literal = lambda values, kind: F.expr(f"array({', '.join(map(str, values))})").cast(f"array<{kind}>")
    points_, splits_, firsts_ = literal(points, "bigint"), literal([splits[p] for p in points], "int"), literal(firsts, "int")
    steps = F.lit([1 << k for k in reversed(range(len(points).bit_length()))])
    below = lambda at, step: F.get(points_, at + step - 1) <= F.col("id")
    place = F.aggregate(steps, F.lit(0), lambda at, step: F.when((at + step <= len(points)) & below(at, step), at + step).otherwise(at))

    def span(at: Column) -> Column:
        k = F.get(splits_, at - 1)
        part = F.least((F.col("tie") / F.lit(float(1 << 63)) * k).cast("int"), k - 1)
        inside = F.when(k == 1, 0).when(F.get(points_, at - 1) == F.col("id"), part).otherwise(k)
        return F.when(at == 0, 0).otherwise(F.get(firsts_, at - 1) + inside)

    return let(place, span)


def _segments(spanned: DataFrame) -> DataFrame:
    """Beside the columns of spanned (text, next_text): n_chars, edited, and the segments kept, old, new of the edit.

    kept holds the paragraphs in front of the one that is cut, old what follows of the text, new of the edited text.
    """
    moved = F.expr("cast(length(text) div 4 as int)")
    keeps = F.expr("cast(length(text) - length(text) div 4 as int)")
    cut_text = spanned.withColumn("n_chars", F.length("text").cast("long")).withColumn("head", F.substring("text", F.lit(1), keeps))
    cut_text = cut_text.withColumn("edited", F.concat("head", F.substring("next_text", F.lit(1), moved)))
    from_end = F.instr(F.reverse("head"), "\n")
    whole = F.when(from_end > 0, F.length("head") - from_end + 1).otherwise(F.lit(0))
    cut_text = cut_text.withColumn("whole", whole.cast("int"))
    rest = F.col("whole") + 1
    everything = F.lit(2**31 - 1)
    return cut_text.select(
        "*",
        F.substring("text", F.lit(1), F.col("whole")).alias("kept"),
        F.substring("text", rest, everything).alias("old"),
        F.substring("edited", rest, everything).alias("new"),
    )


def fingerprint_texts(docs: DataFrame, *keys: str) -> DataFrame:
    """keys, sums, lanes and fingerprint of each row of docs (keys, text); keys name a row."""
    rows = docs.select(*keys, sum_lanes(F.col("text")).alias("sums"), F.col("text"))
    bits = bit_sums(rows.select(*keys, "sums", "text"), *keys, "sums")
    lanes = bits.select(*keys, "sums", _lanes(F.col("bits"), F.col("pieces")).alias("lanes"))
    return lanes.withColumn("fingerprint", fingerprint_of(F.col("sums"), F.col("lanes")))


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, both fingerprints, near_edited and near_next of each row of docs (doc_id, text).

    The texts are shuffled once, by span of doc_id: inside a span a window hands every document the text of the next one,
    and a span's last document gets the first text of the next span. All that follows keeps that partitioning.
    """
    base = docs.select("doc_id", F.coalesce("doc_id", F.lit(_NULL_ID)).alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    base = base.withColumn("tie", F.shiftrightunsigned(F.xxhash64("text"), 1))
    placed = base.withColumn("span", spans_of(base.select("id", "tie")))
    starts = cut(placed.groupBy("span").agg(F.min(F.struct("id", "tie")).alias("least")).select("span", "least.id", "least.tie"))
    then = Window.orderBy("span")
    follows = starts.select("span", "id", "tie", F.coalesce(F.lag("span").over(then), F.max("span").over(Window.partitionBy())).alias("before"))
    heads = placed.join(small_side(follows, starts.count(), 40), ["span", "id", "tie"])
    heads = cut(heads.groupBy(F.col("before").alias("span")).agg(F.min("text").alias("then_text")))
    printed = fingerprint_texts(heads.select("span", F.col("then_text").alias("text")), "span")
    printed = cut(printed.select("span", F.col("lanes").alias("then_lanes"), F.col("fingerprint").alias("then_print")))

    order = Window.partitionBy("span").orderBy("id", "tie", "text")
    rows = placed.withColumn("next_text", F.lead("text").over(order)).withColumn("rn", F.row_number().over(order))
    rows = rows.join(heads, "span").withColumn("next_text", F.coalesce("next_text", "then_text")).drop("then_text")
    parts = _segments(rows)
    old_sums, gone, come = sum_lanes(F.col("text")), sum_lanes(F.col("old")), sum_lanes(F.col("new"))
    edited_sums = F.zip_with(F.zip_with("old_sums", gone, lambda a, b: _add_wrapped(a, b, -1)), come, lambda a, b: _add_wrapped(a, b, 1))
    parts = parts.withColumn("old_sums", old_sums)
    keys = ("span", "rn", "doc_id", "n_chars", "edited_sha256", "old_sums", "new_sums")
    parts = parts.select("span", "rn", "doc_id", "n_chars", F.sha2(F.col("edited"), 256).alias("edited_sha256"), "old_sums", edited_sums.alias("new_sums"), "kept", "old", "new")
    segments = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).alias("text")) for k, c in enumerate(("kept", "old", "new"))]))
    split = parts.select(*keys, segments.alias("seg")).select(*keys, "seg.kind", "seg.text")
    bits = bit_sums(split, *keys, "kind")
    lane = lambda skip: F.array(*[F.sum(F.when(F.col("kind") != skip, F.col("bits")[i]).otherwise(0)) for i in range(BIT_LANES)])
    count = lambda skip: F.sum(F.when(F.col("kind") != skip, F.col("pieces")).otherwise(0))
    merged = bits.groupBy(*keys).agg(lane(2).alias("old_bits"), count(2).alias("old_pieces"), lane(1).alias("new_bits"), count(1).alias("new_pieces"))
    merged = merged.withColumns({"lanes": _lanes(F.col("old_bits"), F.col("old_pieces")), "edited_lanes": _lanes(F.col("new_bits"), F.col("new_pieces"))})
    merged = merged.withColumns({"fingerprint": fingerprint_of(F.col("old_sums"), F.col("lanes")), "edited_fingerprint": fingerprint_of(F.col("new_sums"), F.col("edited_lanes"))})
    by_row = Window.partitionBy("span").orderBy("rn")
    merged = merged.select("span", "rn", "doc_id", "n_chars", "edited_sha256", "lanes", "edited_lanes", "fingerprint", "edited_fingerprint")
    merged = merged.withColumns({"next_lanes": F.lead("lanes").over(by_row), "next_print": F.lead("fingerprint").over(by_row)})
    merged = merged.join(printed, "span").withColumns({"next_lanes": F.coalesce("next_lanes", "then_lanes"), "next_print": F.coalesce("next_print", "then_print")})
    return merged.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("lanes"), F.col("edited_fingerprint"), F.col("edited_lanes")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("lanes"), F.col("next_print"), F.col("next_lanes")).alias("near_next"),
    )


def op6_multiset_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents", "doc_id", "text"))


QUERIES = {"op6_multiset_fingerprints": op6_multiset_fingerprints}
ORACLES: dict[str, str] = {}
