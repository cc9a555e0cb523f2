"""Quality rules: hashed n-gram logistic regression with calibrated probabilities and fixed thresholds.

A text becomes counts of hashed word 1- and 2-grams and of hashed 3- and
4-grams of its UTF-8 bytes, each half damped (square root) and scaled to length
one.  A logistic regression learns on labelled texts; Platt's line, fitted on a
fold that the weights never saw, turns its margin into a probability.  Texts are
scored in Arrow batches; plain counts of the text (words, symbols, repeated
lines and word windows) come from the same pass.

Defined results:

* null, empty and blank texts have no words: all counts 0, ``base_failed``;
* very long texts are counted whole, their bytes in slices that overlap, so
  memory beyond the text's words is bounded;
* repeated rows and ids each get a row; in learning a labelled id counts once,
  with its least label and least text;
* without labelled texts of both classes there is no verdict of the method:
  what passes the base rules is kept (``probability`` is null);
* an empty table gives an empty result; all columns of ``docs`` are kept, and
  the result's name is lengthened where a column has it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdant.llm.common import cut, free_name, prepare

#: Bins of the word half and of the byte half.
BINS = 1 << 14
#: Labelled texts learned from, at most (a documented bound; parameter of ``learn``).
MAX_LABELLED = 8000
#: A text is kept at this probability of good quality or more.
MIN_PROBABILITY = 0.5
#: Base rules: least words, and the largest share of words in repeated three-word windows (percent).
MIN_WORDS = 50
MAX_REPEATED = 50
#: Bytes of a text hashed at a time.
SLICE = 1 << 20

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
REPORT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, probability double, kept boolean")


def _word_ids(words: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """Words as numbers of their first occurrence, and the distinct words."""
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(number.__getitem__, words), np.int64, len(words)), list(number)


def repeated_window_words(ids: np.ndarray, window: int = 3) -> int:
    """Words inside ``window``-word windows that occur twice or more."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    key = ids[:n]
    for j in range(1, window):                 # numbers of longer and longer windows: exact, and small
        nxt = ids[j:j + n]
        key = np.unique(key * (int(nxt.max()) + 1) + nxt, return_inverse=True)[1]
    twice = np.bincount(key)[key] > 1
    inside = np.zeros(len(ids) + 1, np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(inside, starts, 1)
    np.add.at(inside, starts + window, -1)
    return int((np.cumsum(inside[:-1]) > 0).sum())


def repeated_lines(data: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    if b"\n" not in data:
        return 0
    seen: set[bytes] = set()
    count = 0
    for line in data.split(b"\n"):
        if line.strip():
            count += line in seen
            seen.add(line)
    return count


def _mix(h: np.ndarray) -> np.ndarray:
    """Bin numbers of 64-bit hashes (the high bits of a product)."""
    return ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(50)).astype(np.int64)


def gram_counts(data: bytes, ids: np.ndarray, distinct: list[bytes]) -> np.ndarray:
    """Counts of hashed word 1-, 2-grams (first half) and byte 3-, 4-grams (second half)."""
    out = np.zeros(2 * BINS, np.int64)
    if len(ids):
        own = np.fromiter(map(zlib.crc32, distinct), np.uint64, len(distinct))
        for lo in range(0, len(ids), SLICE):
            h = own[ids[lo:lo + SLICE + 1]]
            out[:BINS] += np.bincount(_mix(h[:SLICE]), minlength=BINS)
            out[:BINS] += np.bincount(_mix(h[:-1] * np.uint64(0x100000001B3) + h[1:] + np.uint64(7)), minlength=BINS)
    raw = np.frombuffer(data, np.uint8)
    for lo in range(0, len(raw), SLICE):
        for n in (3, 4):
            seg = raw[lo:lo + SLICE + n - 1]
            m = len(seg) - n + 1
            if m > 0:
                h = np.full(m, n, np.uint64)
                for j in range(n):
                    h = (h << np.uint64(8)) | seg[j:j + m]
                out[BINS:] += np.bincount(_mix(h), minlength=BINS)
    return out


def scaled(counts: np.ndarray) -> np.ndarray:
    """Damped counts, each half of length one (a half without counts stays zero)."""
    x = np.sqrt(counts)
    for half in (x[:BINS], x[BINS:]):
        size = np.sqrt(half @ half)
        if size > 0:
            half /= size
    return x


@dataclass
class QualityModel:
    """Weights (with a bias at the end) and Platt's line; without weights nothing is judged."""

    weights: np.ndarray | None = None
    slope: float = 1.0
    offset: float = 0.0

    def probability(self, counts: np.ndarray) -> float | None:
        if self.weights is None:
            return None
        margin = float(scaled(counts) @ self.weights[:-1] + self.weights[-1])
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30))))

    def report(self, text: str | None, min_words: int = MIN_WORDS, max_repeated: int = MAX_REPEATED,
               min_probability: float = MIN_PROBABILITY) -> tuple:
        """The fields of ``REPORT`` for one text."""
        text = text if isinstance(text, str) else ""
        data = text.encode()
        words = data.split()                     # bytes split at exactly the six ASCII blanks
        ids, distinct = _word_ids(words)
        n, again = len(words), repeated_window_words(ids)
        failed = n < min_words or 100 * again > max_repeated * n
        p = self.probability(gram_counts(data, ids, distinct))
        return (n, len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), repeated_lines(data), again,
                failed, p, not failed and (p is None or p >= min_probability))


def labelled_texts(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, limit: int) -> DataFrame:
    """(h, y, text) of at most ``limit`` labelled documents, chosen by a hash of their ids."""
    known = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
                   .groupBy(F.col(id_col).alias("__id")).agg(F.min(label_col).alias("__y"))
                   .withColumn("__h", F.xxhash64("__id")).orderBy("__h", "__id").limit(limit))
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    return (texts.join(F.broadcast(known), "__id").groupBy("__id", "__h", "__y").agg(F.min("__text").alias("text"))
                 .select(F.col("__h").alias("h"), F.col("__y").cast("int").alias("y"), "text"))


def _sparse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for h, y, text in zip(batch["h"], batch["y"], batch["text"], strict=True):
            data = (text if isinstance(text, str) else "").encode()
            c = gram_counts(data, *_word_ids(data.split()))
            at = np.flatnonzero(c)
            x = scaled(c)[at]
            rows.append((h, y, at.astype(np.uint16).tobytes(), x.astype(np.float16).tobytes()))
        yield pd.DataFrame(rows, columns=["h", "y", "at", "x"])


def fit_weights(at: list[np.ndarray], x: list[np.ndarray], y: np.ndarray, rounds: int = 12, batch: int = 32,
                rate: float = 0.5, penalty: float = 1e-5) -> np.ndarray:
    """Logistic regression by AdaGrad over mini-batches, rows in the given order."""
    w, seen = np.zeros(2 * BINS + 1), np.full(2 * BINS + 1, 1e-3)
    for r in range(rounds):
        order = np.random.default_rng(r).permutation(len(y))
        for lo in range(0, len(y), batch):
            part = order[lo:lo + batch]
            cols = np.concatenate([at[i] for i in part]).astype(np.int64)
            vals = np.concatenate([x[i] for i in part]).astype(np.float64)
            row = np.repeat(np.arange(len(part)), [len(at[i]) for i in part])
            margin = np.bincount(row, vals * w[cols], minlength=len(part)) + w[-1]
            err = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y[part]
            grad = np.bincount(cols, vals * err[row], minlength=len(w)) / len(part) + penalty * w
            grad[-1] = err.mean()
            seen += grad * grad
            w -= rate * grad / np.sqrt(seen)
    return w


def platt(margin: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset of the probability line (Newton steps, smoothed targets)."""
    pos, neg = y.sum(), (1 - y).sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a = np.array([1.0, 0.0])
    m = np.stack([margin, np.ones_like(margin)], axis=1)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(m @ a, -30, 30)))
        step = np.linalg.solve(m.T @ (m * (p * (1 - p) + 1e-9)[:, None]) + 1e-6 * np.eye(2), m.T @ (p - target))
        a -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(max(a[0], 1e-3)), float(a[1])


def _train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row: weights, slope and offset; nothing where a class is missing in either fold."""
    h, y, at, x = [], [], [], []
    for b in batches:
        h += b["h"].tolist()
        y += b["y"].tolist()
        at += [np.frombuffer(v, np.uint16) for v in b["at"]]
        x += [np.frombuffer(v, np.float16) for v in b["x"]]
    order = np.argsort(np.array(h, np.int64), kind="stable")
    y = np.array(y, float)
    hold = np.array(h, np.int64) % 5 == 0
    learn, check = order[~hold[order]], order[hold[order]]
    if len(set(y[learn])) == 2:
        w = fit_weights([at[i] for i in learn], [x[i] for i in learn], y[learn])
        margin = np.array([x[i].astype(float) @ w[at[i]] + w[-1] for i in check])
        line = platt(margin, y[check]) if len(set(y[check])) == 2 else (1.0, 0.0)
        yield pd.DataFrame([(w.astype(np.float64).tobytes(), *line)], columns=["w", "slope", "offset"])


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          limit: int = MAX_LABELLED) -> QualityModel:
    """A model of at most ``limit`` labelled texts; one that judges nothing where a class is missing.

    Texts become sparse counts in parallel and are written once; one task fits
    the weights on them (at most 32,768 bins of 4 bytes a text), and the driver
    receives the weights only.
    """
    prepare(docs.sparkSession)
    rows = labelled_texts(docs, labels, id_col, text_col, label_col, limit)
    table = cut(rows.mapInPandas(_sparse, "h long, y int, at binary, x binary"), "quality-sample")
    fitted = table.repartition(1).mapInPandas(_train, "w binary, slope double, offset double").collect()
    if not fitted:
        return QualityModel()
    return QualityModel(np.frombuffer(fitted[0]["w"], np.float64).copy(), fitted[0]["slope"], fitted[0]["offset"])


def report_column(model: QualityModel, text: Column, min_words: int = MIN_WORDS, max_repeated: int = MAX_REPEATED,
                  min_probability: float = MIN_PROBABILITY) -> Column:
    """Column struct of ``REPORT``: counts, base rules, probability of good quality and the verdict."""

    names = [f.split()[0] for f in REPORT.split(", ")]

    @F.pandas_udf(REPORT)
    def report(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [model.report(t, min_words, max_repeated, min_probability) for t in batch]
            out = pd.DataFrame(rows, columns=names)
            out["probability"] = out["probability"].astype("float64")
            yield out

    return report(text)


def judge(docs: DataFrame, model: QualityModel, text_col: str = "text", out: str = "quality_report", **limits) -> DataFrame:
    """``docs`` with a struct column ``out`` of ``REPORT``; every row and column is kept."""
    prepare(docs.sparkSession)
    return docs.withColumn(free_name(docs, out), report_column(model, F.col(text_col), **limits))


def keep_good(docs: DataFrame, model: QualityModel, text_col: str = "text", **limits) -> DataFrame:
    """The documents that pass the base rules and the method, with their own columns."""
    name = free_name(docs, "__quality")
    return (judge(docs, model, text_col, name, **limits).where(F.col(f"`{name}`.kept"))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
