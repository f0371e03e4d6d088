"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features: character 1-, 2- and 3-grams of the lower-cased text, every run of characters that are not letters read as
one space, hashed to DIMENSIONS columns. TF is an n-gram's share of the text's n-grams of its order; IDF comes from all training
documents, counted in Spark: each task adds up its documents' columns, and the driver gets DIMENSIONS sums at most. Training:
follow-the-regularised-leader (FTRL-proximal) with L1 and L2 penalties, then one temperature fitted on sample rows that training left out.

The classifier is fitted on a bounded sample: at most SAMPLE_PER_LANG labelled training documents of each language, SAMPLE_ROWS of all and
SAMPLE_PAIRS n-gram counts together, picked by a hash of doc_id over the whole table; it learns the MAX_LANGUAGES most frequent labels.
Executors turn the documents into sparse counts. Scoring covers every whole text, in numpy, over Arrow batches.

The probabilities are shares among the learned languages, so they cannot tell a text in none of them (on separable languages every one is
near 1). For that the model measures a text's strangeness: how far its mean IDF lies above the usual one, in units that allow short texts more.
The calibration rows, each against the IDF without itself, give the limit: SLACK times the strangest of them.

Defined results: null, empty and letterless texts are `und` with score 0; without any labelled training row everything is
`und` with score 0; of languages of equal probability the first in code-point order is taken; rows with a null doc_id are scored but never
learned from; of rows that repeat a training doc_id and label one, that of the least text, is in the sample; repeated rows get equal results;
texts of any length are read whole; an empty table gives an empty result; other columns are not read by op10, and kept by reject.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_name, table

DIMENSIONS = 1 << 16
ORDERS = (1, 2, 3)
SAMPLE_PER_LANG, SAMPLE_ROWS, SAMPLE_PAIRS, MAX_LANGUAGES = 1200, 6000, 16_000_000, 400
#: Share of the sample kept for the temperature: one in CALIBRATE_EVERY.
CALIBRATE_EVERY = 5
FOLDS, HELD_OUT_FOLD = 5, 0
ALPHA, BETA, L1, L2, EPOCHS = 1.0, 1.0, 2e-4, 1e-4, 3
#: Times the strangest calibration row that a text may be strange; n-grams that weigh as much as a text's length in its strangeness;
#: calibration rows needed for a limit (none is set by fewer).
SLACK, STEADY_CHARS, LEAST_CALIBRATION = 1.5, 1000, 20
#: Characters scored at once.
BLOCK_CHARS = 1 << 20

_SPACE = 32


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def _letter_table() -> np.ndarray:
    """For each code point itself if a letter, else a space."""
    points = np.arange(0x110000, dtype=np.uint32)
    letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return np.where(letters, points, _SPACE).astype(np.uint32)


_TABLE: list[np.ndarray] = []


def _points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all texts, each text between single spaces, and where each text begins."""
    if not _TABLE:
        _TABLE.append(_letter_table())
    parts = [f" {t.lower()} " for t in texts]
    points = _TABLE[0][np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32)]
    starts = np.cumsum([0, *map(len, parts)])[:-1]
    keep = np.empty(len(points), bool)
    keep[:1] = True
    keep[1:] = (points[1:] != _SPACE) | (points[:-1] != _SPACE)
    keep[starts] = True
    return points[keep], (np.cumsum(keep) - 1)[starts]


def _hashes(points: np.ndarray, order: int) -> np.ndarray:
    """Column of the n-gram that ends at each place from order - 1 on."""
    n = len(points) - order + 1
    h = np.full(max(n, 0), order * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
    for i in range(order):
        h = (h ^ points[i : i + n]) * np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(15)
    return h & np.uint32(DIMENSIONS - 1)


def sparse_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Columns and TF values of one text."""
    points, _ = _points([text])
    columns, values = [], []
    for order in ORDERS:
        found, counts = np.unique(_hashes(points, order), return_counts=True)
        columns.append(found.astype(np.int64))
        values.append(counts / max(counts.sum(), 1))
    columns, values = np.concatenate(columns), np.concatenate(values)
    merged, back = np.unique(columns, return_inverse=True)
    return merged.astype(np.int32), np.bincount(back, values, minlength=len(merged)).astype(np.float32)


@dataclass
class Model:
    """languages, weights (DIMENSIONS, languages) with the IDF multiplied in, bias and temperature; IDF, its usual mean and the strangest calibration row."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    idf: np.ndarray
    usual: float
    strangest: float

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The language and its calibrated probability for each text."""
        return self.judge(texts)[:2]

    def judge(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The language, its calibrated probability and the strangeness of each text."""
        names, scores, strange = ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        known = [i for i, t in enumerate(texts) if self.languages and has_letter(t)]
        block: list[int] = []
        size = 0
        for place, i in enumerate(known):
            block.append(i)
            size += len(texts[i])
            if size >= BLOCK_CHARS or place == len(known) - 1:
                logits, strange[block] = self._logits([texts[j] for j in block])
                p = _softmax(logits / self.temperature)
                best = p.argmax(1)
                for j, b, score in zip(block, best.tolist(), p.max(1).tolist()):
                    names[j], scores[j] = self.languages[b], score
                block, size = [], 0
        return names, scores, strange

    def _logits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        points, starts = _points(texts)
        out = np.tile(self.bias, (len(texts), 1)).astype(np.float64)
        ends = np.append(starts[1:], len(points))
        surprise = np.zeros(len(texts))
        for order in ORDERS:
            counts = ends - starts - order + 1
            h = _hashes(points, order)
            some = np.flatnonzero(counts > 0)
            if not len(some):
                continue
            inside = np.zeros(len(h) + 1, np.int32)
            np.add.at(inside, starts[some], 1)
            np.add.at(inside, np.minimum(starts[some] + counts[some], len(h)), -1)
            h = h[np.cumsum(inside[:-1]) > 0]
            firsts = np.cumsum(counts[some]) - counts[some]
            for k in range(len(self.languages)):
                out[some, k] += np.add.reduceat(self.weights[k][h], firsts, dtype=np.float64) / counts[some]
            surprise[some] += np.add.reduceat(self.idf[h], firsts, dtype=np.float64) / counts[some]
        return out, _strangeness(surprise, ends - starts, self.usual)


def _strangeness(surprise: np.ndarray, sizes: np.ndarray, usual: float) -> np.ndarray:
    """How far surprise (sums of TF times IDF) of texts of sizes letters lies above the usual one; a mean over few n-grams may lie further off."""
    return (surprise - usual) / np.sqrt(1 / np.maximum(sizes, 1) + 1 / STEADY_CHARS)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts with letters each column occurs, and the number of these texts."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, seen, n = np.zeros(DIMENSIONS + 1, np.int64), np.zeros(DIMENSIONS, bool), 0
        for batch in batches:
            for text in batch["text"]:
                if has_letter(text):
                    points, _ = _points([text])
                    seen[:] = False
                    for order in ORDERS:
                        seen[_hashes(points, order)] = True
                    total[:-1] += seen
                    n += 1
        total[-1] = n
        some = np.flatnonzero(total)
        yield pd.DataFrame({"column": some.astype(np.int32), "n": total[some]})

    sums = docs.select("text").mapInPandas(count, "column int, n long").groupBy("column").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(DIMENSIONS + 1, np.int64)
    total[sums["column"]] = sums["n"]
    return total[:-1], int(total[-1])


def train(rows: list[tuple[str, np.ndarray, np.ndarray, int]], seen: np.ndarray | None = None, n_docs: int = 0) -> Model:
    """FTRL-proximal with elastic net over (language, columns, TF values, letters), in the order given; then the temperature and the limit.

    seen, n_docs: in how many of n_docs documents, rows among them, each column occurs; by default those of rows.
    """
    languages = sorted({row[0] for row in rows})
    if not languages:
        return Model([], np.zeros((0, DIMENSIONS), np.float32), np.zeros(0), 1.0, np.zeros(DIMENSIONS, np.float32), 0.0, np.inf)
    k = len(languages)
    place = {lang: i for i, lang in enumerate(languages)}
    if seen is None:
        seen, n_docs = np.zeros(DIMENSIONS), len(rows)
        for _, columns, _, _ in rows:
            seen[columns] += 1
    idf = np.log((1 + n_docs) / (1 + seen)) + 1
    # the sample stays as it came, in 32 bits; a row is widened and weighted only while it is looked at
    wide = lambda row: (place[row[0]], np.append(row[1], DIMENSIONS), np.append(row[2] * idf[row[1]], 1.0))
    held = [r for i, r in enumerate(rows) if i % CALIBRATE_EVERY == 0]
    fit = [r for i, r in enumerate(rows) if i % CALIBRATE_EVERY] or rows
    z, n, w = np.zeros((DIMENSIONS + 1, k)), np.zeros((DIMENSIONS + 1, k)), np.zeros((DIMENSIONS + 1, k))
    for _ in range(EPOCHS):
        for y, columns, x in map(wide, fit):
            zc, nc = z[columns], n[columns]
            wc = np.where(np.abs(zc) <= L1, 0.0, -(zc - np.sign(zc) * L1) / ((BETA + np.sqrt(nc)) / ALPHA + L2))
            p = _softmax((x @ wc)[None])[0]
            p[y] -= 1
            g = x[:, None] * p
            grown = nc + g * g
            z[columns] = zc + g - (np.sqrt(grown) - np.sqrt(nc)) / ALPHA * wc
            n[columns] = grown
    w = np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))
    logits, y = np.array([x @ w[c] for _, c, x in map(wide, held)]), np.array([place[r[0]] for r in held])
    # a held row counted for its own IDF, so it is taken out
    surprise = np.array([r[2] @ (np.log((1 + n_docs) / seen[r[1]]) + 1) for r in held])
    usual = float(np.median(surprise))
    strangest = _strangeness(surprise, np.array([r[3] for r in held]), usual).max() if len(held) >= LEAST_CALIBRATION else np.inf
    weights = np.ascontiguousarray((w[:-1] * idf[:, None]).T).astype(np.float32)
    return Model(languages, weights, w[-1], _temperature(logits, y), idf.astype(np.float32), usual, float(strangest))


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least negative log likelihood, by golden-section search over its logarithm in [-8, 4]."""
    if not len(y):
        return 1.0
    loss = lambda t: -np.log(np.maximum(_softmax(logits / np.exp(t))[np.arange(len(y)), y], 1e-12)).mean()
    low, high, ratio = -8.0, 4.0, (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fold(doc_id):
    """crc32 of the id as text, modulo FOLDS; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def training_documents(docs: DataFrame) -> DataFrame:
    """The labelled documents outside the held-out fold."""
    return docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != HELD_OUT_FOLD))


def training_rows(docs: DataFrame, per_lang: int = SAMPLE_PER_LANG, all_rows: int = SAMPLE_ROWS, all_pairs: int = SAMPLE_PAIRS) -> list[tuple[str, np.ndarray, np.ndarray, int]]:
    """(language, columns, values, letters) of the sample, in the order of an id's hash.

    The number of training rows of each language gives the share of hash values to keep; the lengths of the texts under that share (a
    text of n characters has 3 n n-grams at most) tell where the bound on pairs cuts them; only what is left is turned into counts.
    """
    pool = training_documents(docs)
    counts = {r["lang"]: r["n"] for r in pool.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES).collect()}
    if not counts:
        return []
    most = max(1, min(per_lang, all_rows // len(counts)))
    unit = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 40)) / F.lit(float(1 << 40))

    def under(limits: dict[str, float]) -> Column:
        names = sorted(limits)
        limit = F.try_element_at(F.create_map(*[F.lit(x) for lang in names for x in (lang, limits[lang])]), F.col("lang"))
        return F.coalesce(F.col("unit") < limit, F.lit(False))

    placed = pool.select("lang", "text", unit.alias("unit"))
    shares = {lang: min(1.0, most / n) for lang, n in counts.items()}
    sample = placed.where(under(shares)).groupBy("lang", "unit").agg(F.min("text").alias("text"))
    limits, used, rows = dict(shares), dict.fromkeys(counts, 0), dict.fromkeys(counts, 0)
    for r in sorted(sample.select("lang", "unit", F.length("text").alias("n")).collect(), key=lambda r: (r["unit"], r["lang"])):
        lang = r["lang"]
        used[lang] += min(3 * (r["n"] or 0) + 6, DIMENSIONS)
        rows[lang] += 1
        if rows[lang] > 1 and (used[lang] > all_pairs // len(counts) or rows[lang] > 2 * most):
            limits[lang] = min(limits[lang], r["unit"])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(lang, unit, *sparse_counts(text), len(_points([text])[0])) for lang, unit, text in zip(batch["lang"], batch["unit"], batch["text"]) if has_letter(text)]
            yield pd.DataFrame(rows, columns=["lang", "unit", "columns", "values", "letters"])

    found = sample.where(under(limits)).mapInPandas(count, "lang string, unit double, columns array<int>, values array<float>, letters int").toPandas()
    found = found.sort_values(["unit", "lang"], kind="stable")
    return [(lang, np.asarray(c, np.int32), np.asarray(v, np.float32), n) for lang, c, v, n in zip(found["lang"], found["columns"], found["values"], found["letters"])]


def fit(docs: DataFrame, per_lang: int = SAMPLE_PER_LANG) -> Model:
    """A model of the training documents (doc_id, text, lang)."""
    rows = training_rows(docs, per_lang)
    return train(rows, *document_frequencies(training_documents(docs))) if rows else train([])


def predict(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """The columns keep of docs, then lang_pred and score of each row's text; only the text goes to Python."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        names, scores = sent.value.predict([t if isinstance(t, str) else None for t in texts])
        return pd.DataFrame({"lang_pred": names, "score": scores})

    name = free_name(docs, "lid")
    columns = [F.col(f"`{c}`") for c in keep]
    return docs.select(*columns, predicted(F.col("text")).alias(name)).select(*columns, F.col(name)["lang_pred"].alias("lang_pred"), F.col(name)["score"].alias("score"))


def reject(docs: DataFrame, min_score: float = 0.0, per_lang: int = SAMPLE_PER_LANG, slack: float | None = None) -> DataFrame:
    """The rows of docs, with its columns, whose text has letters and is a learned language by min_score at least.

    With slack, texts go too that are more than slack times as strange as the strangest calibration row: other languages, code, gibberish.
    """
    model = fit(docs, per_lang)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    limit = np.inf if slack is None else slack * max(model.strangest, 1.0)

    @F.pandas_udf("boolean")
    def known(texts: pd.Series) -> pd.Series:
        names, scores, strange = sent.value.judge([t if isinstance(t, str) else None for t in texts])
        return pd.Series(np.array([n != "und" for n in names], bool) & (scores >= min_score) & (strange <= limit))

    return docs.where(known(F.col("text")))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    scored = predict(docs, fit(docs), "doc_id")
    return scored.select("doc_id", F.coalesce(fold(F.col("doc_id")) == HELD_OUT_FOLD, F.lit(False)).alias("held_out"), "lang_pred", "score")


QUERIES = {"op10_language_id": op10_language_id}
ORACLES: dict[str, str] = {}
