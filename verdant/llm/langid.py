"""Hierarchical language identification.

Texts are bags of hashed byte n-grams (of two and three bytes, letters only).
First the language family is predicted: one linear support vector machine per
family against the rest.  Then, among the languages of that family alone,
one-versus-one linear support vector machines vote.  Margins become
probabilities by Platt's sigmoids fitted on texts the machines have not seen;
the score is the family's probability times the language's within it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdant.llm.common import cut, free_name, prepare

#: Labelled texts per language that are learned from at most, and languages at most.
MAX_PER_LANGUAGE = 400
MAX_LANGUAGES = 200
#: Vectors of all other families that a family's machine is learned from, about.
MAX_REST = 4000
#: Hashed features of each n-gram length.
BUCKETS = 2048
#: Bytes of the excerpt that is learned from next to each whole text, so that short texts are known too.
EXCERPT = 60
UNKNOWN = "und"

# Language codes by family; a code that is not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fy lb af yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky tk",
    "indic": "hi bn mr gu pa ur ne si",
    "semitic": "ar he mt am",
    "celtic": "ga gd cy br",
    "baltic": "lt lv",
    "austronesian": "id ms tl jv",
    "dravidian": "ta te kn ml",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

_HAS_LETTER = regex.compile(r"\p{L}")
# ASCII letters in lower case and bytes of non-ASCII characters as they are; the rest is a space.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def family_of(lang: str) -> str:
    return FAMILY_OF.get(lang.lower().partition("-")[0], f"only:{lang}")


def has_letter(text: str | None) -> bool:
    return bool(text) and _HAS_LETTER.search(text) is not None


def _letters(text: str) -> bytes:
    words = text.lower().encode("utf-8", "surrogatepass").translate(_LETTERS).split()
    return b" " + b" ".join(words) + b" "


def _counts(data: bytes) -> np.ndarray:
    b = np.frombuffer(data, dtype=np.uint8).astype(np.uint32)
    out = np.zeros(2 * BUCKETS, dtype=np.float64)
    if len(b) > 2:
        two = b[:-1] * np.uint32(257) + b[1:]
        three = two[:-1] * np.uint32(263) + b[2:]
        for at, grams in ((0, two), (BUCKETS, three)):
            mixed = (grams * np.uint32(2654435761)) >> np.uint32(32 - 11)
            out[at:at + BUCKETS] += np.bincount(mixed.astype(np.int64), minlength=BUCKETS)
    return out


def features(text: str) -> np.ndarray:
    """Square roots of the n-grams' shares: a vector of the same length for short and long texts."""
    data, total = _letters(text), np.zeros(2 * BUCKETS)
    for at in range(0, len(data), 1 << 20):                  # bounded memory for very long texts
        total += _counts(data[max(0, at - 2):at + (1 << 20)])
    for at in (0, BUCKETS):
        s = total[at:at + BUCKETS].sum()
        if s:
            total[at:at + BUCKETS] /= s
    return np.sqrt(total).astype(np.float32)


# -- linear machines -------------------------------------------------------------------------------

def fit_svm(x: np.ndarray, y: np.ndarray, c: float = 4.0, rounds: int = 30, seed: int = 7) -> np.ndarray:
    """Weights (bias last) of a linear SVM, y of -1 and 1, by dual coordinate descent (Hsieh et al., 2008)."""
    x = np.hstack([x, np.ones((len(x), 1), dtype=x.dtype)])
    w, alpha = np.zeros(x.shape[1]), np.zeros(len(x))
    square = np.einsum("ij,ij->i", x, x, dtype=np.float64)
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(len(x)):
            step = (1 - y[i] * (x[i] @ w)) / square[i]
            new = min(c, max(0.0, alpha[i] + step))
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w


def fit_sigmoid(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(slope, bias) of Platt's sigmoid with his smoothed targets, by Newton's method."""
    n1, n0 = (y > 0).sum(), (y <= 0).sum()
    if not n1 or not n0:
        return 4.0, 0.0
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a = np.array([2.0, 0.0])
    x = np.stack([margin, np.ones(len(margin))], axis=1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ a, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 1e-6 * np.eye(2), x.T @ (p - target))
        a -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return max(0.5, float(a[0])), float(a[1])


@dataclass
class LanguageModel:
    """Families with their languages, and the machines: rows of ``weights`` with Platt sigmoids."""

    families: list[str] = field(default_factory=list)
    languages: dict[str, list[str]] = field(default_factory=dict)
    weights: np.ndarray | None = None
    sigmoids: np.ndarray | None = None
    family_rows: dict[str, int] = field(default_factory=dict)
    pair_rows: dict[tuple[str, str], int] = field(default_factory=dict)

    def _probabilities(self, x: np.ndarray) -> np.ndarray:
        margin = x.astype(np.float64) @ self.weights[:, :-1].T + self.weights[:, -1]
        return 1 / (1 + np.exp(-np.clip(margin * self.sigmoids[:, 0] + self.sigmoids[:, 1], -30, 30)))

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, str | None]]:
        """(language, score, family) of each text."""
        out: list = [(UNKNOWN, 0.0, None)] * len(texts)
        known = [i for i, t in enumerate(texts) if self.families and has_letter(t)]
        for at in range(0, len(known), 256):
            part = known[at:at + 256]
            p = self._probabilities(np.stack([features(texts[i]) for i in part])) if self.weights is not None else None
            for k, i in enumerate(part):
                out[i] = self._decide(p[k] if p is not None else None)
        return out

    def _decide(self, p: np.ndarray | None) -> tuple[str, float, str]:
        if len(self.families) == 1:
            family, p_family = self.families[0], 1.0
        else:
            shares = np.array([p[self.family_rows[f]] for f in self.families]) + 1e-12
            k = int(shares.argmax())
            family, p_family = self.families[k], float(shares[k] / shares.sum())
        langs = self.languages[family]
        if len(langs) == 1:
            return langs[0], p_family, family
        votes, total = dict.fromkeys(langs, 0), dict.fromkeys(langs, 0.0)
        for (a, b), row in self.pair_rows.items():
            if a in votes and b in votes:
                q = float(p[row])
                votes[a if q >= 0.5 else b] += 1
                total[a] += q
                total[b] += 1 - q
        best = max(langs, key=lambda x: (votes[x], total[x]))
        return best, p_family * total[best] / sum(total.values()) * len(langs) / 2 if len(langs) > 2 else p_family * total[best], family


def _train(x: np.ndarray, y: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, tuple[float, float]]:
    """A machine learned without the held texts, and its sigmoid from them."""
    if held.all() or not (y[~held] > 0).any() or not (y[~held] < 0).any():
        held = np.zeros(len(y), dtype=bool)
    w = fit_svm(x[~held], y[~held])
    seen = held if held.any() else ~held
    return w, fit_sigmoid(x[seen] @ w[:-1] + w[-1], y[seen])


def _sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, limit: int, max_languages: int) -> DataFrame:
    """(lang, text): at most ``limit`` texts of each language, chosen by a hash of the id.

    A language's number of ids (estimated by a sketch, so no id is shuffled)
    gives the share of the hash's range that holds half as many again as asked
    for; only ids below it are ranked.  Each language's part of the range is
    as wide as the language is rare, so the ranked rows do not grow with the
    table.  The chosen ids are then few enough to broadcast.
    """
    rows = docs.select(F.col(id_col).alias("__id"), F.col(lang_col).alias("lang")).where("lang is not null and __id is not null")
    langs = (rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("__id", 0.03).alias("ids"))
                 .orderBy(F.desc("n"), "lang").limit(max_languages)
                 .select("lang", (F.lit(1.5 * limit + 60) / F.greatest("ids", F.lit(1))).alias("share")))
    place = F.pmod(F.xxhash64("__id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("__id"), "__id"))
    chosen = (rows.join(F.broadcast(langs), "lang").where(place < F.col("share")).select("__id", "lang").distinct()
                  .withColumn("__rank", rank).where(F.col("__rank") <= limit).select("__id", "lang"))
    texts = (docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text"))
                 .join(F.broadcast(chosen), "__id").where("text is not null"))
    # A chosen id may repeat: copies count once, and of its other texts come the first of every id before the second of any.
    texts = texts.groupBy("__id", "lang", F.xxhash64("text").alias("__hash")).agg(F.min("text").alias("text"))
    nth = F.row_number().over(Window.partitionBy("lang", "__id").orderBy("__hash"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("__nth", F.xxhash64("__id"), "__id"))
    return (texts.withColumn("__nth", nth).where(F.col("__nth") <= limit)
                 .withColumn("__rank", rank).where(F.col("__rank") <= limit).select("__id", "lang", "text"))


_MACHINE = "machine string, weights binary, slope double, bias double"


def _train_group(rows: pd.DataFrame) -> pd.DataFrame:
    """One machine from its rows (machine, id, lang, part, at, x, y), in an order that no partitioning changes."""
    rows = rows.sort_values(["id", "lang", "part", "x"], kind="stable")
    x = np.zeros((len(rows), 2 * BUCKETS), dtype=np.float32)
    for k, (at, values) in enumerate(zip(rows["at"], rows["x"], strict=True)):
        x[k, np.frombuffer(at, dtype=np.uint16)] = np.frombuffer(values, dtype=np.float32)
    held = np.array([hash_of(f"held{i}") % 5 == 0 for i in rows["id"]])
    w, (slope, bias) = _train(x, rows["y"].to_numpy(dtype=np.float64), held)
    return pd.DataFrame([(rows["machine"].iloc[0], w.astype(np.float64).tobytes(), slope, bias)],
                        columns=["machine", "weights", "slope", "bias"])


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          limit: int = MAX_PER_LANGUAGE, max_languages: int = MAX_LANGUAGES, max_rest: int = MAX_REST) -> LanguageModel:
    """A model from at most ``limit`` texts of each of the ``max_languages`` most frequent languages; empty where none has letters.

    Every machine is trained in a task of its own, from the sparse vectors of
    its languages; a family's machine takes about ``max_rest`` vectors of the
    other families (by a hash of the id) where these hold more.  The driver gets
    the languages' counts and the weights, 32 KB a machine.
    """
    spark = prepare(docs.sparkSession)

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for i, lang, text in zip(batch["__id"], batch["lang"], batch["text"], strict=True):
                if not has_letter(text):
                    continue
                start = (hash_of(str(i)) * len(text)) >> 32
                for part, piece in enumerate((text, text[start:start + EXCERPT])):
                    if has_letter(piece):
                        x = features(piece)
                        at = np.flatnonzero(x)
                        rows.append((i, lang, part, at.astype(np.uint16).tobytes(), x[at].tobytes()))
            yield pd.DataFrame(rows, columns=["id", "lang", "part", "at", "x"])

    sample = _sample(docs, id_col, text_col, lang_col, limit, max_languages).select(F.col("__id").cast("string").alias("__id"), "lang", "text")
    table = cut(sample.mapInPandas(vectors, "id string, lang string, part int, at binary, x binary"), "language-vectors")
    counts = {r["lang"]: r["n"] for r in table.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    model = LanguageModel()
    for name in sorted(counts):
        model.languages.setdefault(family_of(name), []).append(name)
    model.families = sorted(model.languages)

    # (machine, language, side, share): the languages of each machine and the share of their vectors that it takes.
    plan = []
    if len(model.families) > 1:
        for f in model.families:
            model.family_rows[f] = len(model.family_rows)
            rest = sum(n for name, n in counts.items() if family_of(name) != f)
            plan += [(f"{model.family_rows[f]}", name, 1.0 if family_of(name) == f else -1.0,
                      1.0 if family_of(name) == f else min(1.0, max_rest / rest)) for name in counts]
    for langs in model.languages.values():
        for a, b in combinations(langs, 2):
            row = len(model.family_rows) + len(model.pair_rows)
            model.pair_rows[a, b] = row
            plan += [(f"{row}", a, 1.0, 1.0), (f"{row}", b, -1.0, 1.0)]
    if not plan:
        return model
    # At most languages x (families + languages of a family) narrow rows, so it is broadcast.
    sides = spark.createDataFrame(plan, "machine string, lang string, y double, share double")
    place = F.pmod(F.xxhash64("machine", "id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    rows = table.join(F.broadcast(sides), "lang").where((F.col("share") >= 1) | (place < F.col("share"))).drop("share")
    found = {r["machine"]: r for r in rows.groupBy("machine").applyInPandas(_train_group, _MACHINE).collect()}
    order = [found[f"{k}"] for k in range(len(found))]
    model.weights = np.array([np.frombuffer(r["weights"], dtype=np.float64) for r in order])
    model.sigmoids = np.array([(r["slope"], r["bias"]) for r in order])
    return model


def hash_of(text: str) -> int:
    import zlib

    return zlib.crc32(text.encode())


def predict_column(model: LanguageModel, text: Column) -> Column:
    """Column struct<lang string, score double, family string>; ``und`` with score 0 for texts without a letter."""
    shared = model

    @F.pandas_udf("lang string, score double, family string")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = shared.predict([t if isinstance(t, str) else None for t in batch])
            yield pd.DataFrame({c: pd.Series(list(v), dtype=kind) for c, v, kind in zip(
                ("lang", "score", "family"), zip(*found, strict=True) if found else ((), (), ()), (object, float, object), strict=True)})

    return predict(text)


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text", out: str = "language") -> DataFrame:
    """``docs`` with a struct column ``out`` (lengthened if taken); every row and column is kept.

    Null, empty and letterless texts are ``und`` with score 0, and so is every
    text under a model that learned nothing.
    """
    prepare(docs.sparkSession)
    return docs.withColumn(free_name(docs, out), predict_column(model, F.col(text_col)))


def keep_identified(docs: DataFrame, model: LanguageModel, text_col: str = "text", min_score: float = 0.0) -> DataFrame:
    """The documents with a recognised language (not ``und``) of at least ``min_score``, with their own columns."""
    name = free_name(docs, "__language")
    return (identify(docs, model, text_col, name)
            .where((F.col(f"`{name}`.lang") != UNKNOWN) & (F.col(f"`{name}`.score") >= min_score))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
