"""Toxicity scores: a lexicon trie intersected with Levenshtein automata, and context windows.

The lexicon (terms given, and terms learned from labelled texts) is a trie.
The Levenshtein automata of all words within a term's allowed distance are
intersected with it: a state is the set of (trie node, edits spent) pairs that
a word's letters can have reached, built when first needed and remembered, so
nearly every clean word ends in the dead state after a few letters.  Hits are
weighed by their context window: inside quotation marks or next to a word that
reports speech a hit counts as quotation, otherwise as abuse, and more so next
to a second-person pronoun.  A logistic regression turns a text's masses of
exact, misspelled and quoted hits into the score.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdant.llm.common import fold, free_name, prepare

#: Labelled texts that the weights are fitted on at most, learned terms and their known look-alikes kept at most.
MAX_LABELLED = 8000
MAX_TERMS = 500
MAX_CLEAN = 50_000
#: Words whose contexts are counted, as a multiple of the terms kept.
CANDIDATES = 4
THRESHOLD = 0.7
#: Words on either side of a hit that make its context.
CONTEXT = 8

# Terms known without learning, and words that mark speech or address.
SEED_TERMS = ("idiot", "moron", "imbecile", "stupid", "worthless", "pathetic", "disgusting", "loser", "scum", "bastard",
              "asshole", "bitch", "retard", "dumbass", "crap", "shit", "fuck", "whore", "slut")
REPORT_WORDS = frozenset(("said", "says", "wrote", "writes", "called", "calls", "quote", "quoted", "quotes", "word", "words",
                          "term", "terms", "phrase", "slur", "insult", "insults", "alleged", "reported"))
ADDRESS_WORDS = frozenset(("you", "your", "you're", "youre", "u", "yourself", "du", "dich", "tu", "toi", "vous", "tú", "usted"))
LEET = (str.maketrans("013457@$", "oieastas"), str.maketrans("013457@$", "oleastas"))
QUOTES = "\"“”„«»"

_WORD = re.compile(r"[^\W_][\w@$]*")
_LEET = re.compile(r"[0-9@$]")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def allowed_edits(term: str) -> int:
    """Edits within which a word counts as a misspelling of the term."""
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Automaton:
    """Deterministic automaton of all words within the allowed distance of a lexicon term."""

    STATES = 50_000                       # remembered at most; then it starts anew

    def __init__(self, terms: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.limit = [0]                  # most edits any term below the node allows
        self.term: list[str | None] = [None]
        for t in sorted(set(terms)):
            node, k = 0, allowed_edits(t)
            self.limit[0] = max(self.limit[0], k)
            for c in t:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.limit.append(0)
                    self.term.append(None)
                node = self.children[node][c]
                self.limit[node] = max(self.limit[node], k)
            self.term[node] = t
        self._reset()

    def _reset(self) -> None:
        self.number: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.moves: list[dict[str, int]] = []
        self.accepts: list[tuple[int, str] | None] = []
        self.dead = self._state(())
        self.start = self._state(self._close({0: 0}))

    def _state(self, state: tuple) -> int:
        """The number of a state; a new one gets its acceptance: (edits, term) of its nearest term, ties by text."""
        k = self.number.get(state)
        if k is None:
            k = self.number[state] = len(self.states)
            self.states.append(state)
            self.moves.append({})
            self.accepts.append(min(((e, t) for node, e in state if (t := self.term[node]) is not None and e <= allowed_edits(t)),
                                    default=None))
        return k

    def _close(self, spent: dict[int, int]) -> tuple:
        """Add what is reached by leaving out term letters; the state as a sorted tuple."""
        todo = list(spent.items())
        while todo:
            node, e = todo.pop()
            if spent.get(node) != e:
                continue
            for child in self.children[node].values():
                if e + 1 <= self.limit[child] and spent.get(child, 99) > e + 1:
                    spent[child] = e + 1
                    todo.append((child, e + 1))
        return tuple(sorted(spent.items()))

    def _step(self, state: tuple, c: str) -> tuple:
        spent: dict[int, int] = {}

        def reach(node, e):
            if e <= self.limit[node] and spent.get(node, 99) > e:
                spent[node] = e

        for node, e in state:
            reach(node, e + 1)                                     # a letter too many
            for letter, child in self.children[node].items():
                reach(child, e if letter == c else e + 1)          # the letter, or another one
        return self._close(spent) if spent else ()

    def match(self, word: str) -> tuple[int, str] | None:
        """(edits, term) of the nearest term, ties by its text; None if no term is near enough."""
        if len(self.states) > self.STATES:
            self._reset()
        k, dead, moves = self.start, self.dead, self.moves
        for c in word:
            new = moves[k].get(c)
            if new is None:
                new = moves[k][c] = self._state(self._step(self.states[k], c))
            if new == dead:
                return None
            k = new
        return self.accepts[k]


@dataclass
class ToxicityModel:
    """Terms, words that look like a term but are known to be clean, and the score's weights."""

    terms: list[str]
    clean: frozenset = frozenset()
    #: Bias, then the weights of ``features``; the values here hold without labelled texts.
    weights: list[float] = field(default_factory=lambda: [-3.0, 2.5, 2.0, 1.0, 0.0, 0.2, 0.1])

    def __post_init__(self):
        self._automaton = None
        self._seen: dict[str, tuple[int, str] | None] = {}

    def __getstate__(self):
        return {"terms": self.terms, "clean": self.clean, "weights": self.weights}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.__post_init__()

    def near(self, word: str) -> tuple[int, str] | None:
        """(edits, term) of a word, digits and signs read as letters where that helps."""
        if self._automaton is None:
            self._automaton = Automaton(self.terms)
        found = self._automaton.match(word)
        if found is None and _LEET.search(word) and not word.isdigit():
            found = min(filter(None, (self._automaton.match(word.translate(t)) for t in LEET)), default=None)
        return None if found and found[0] and word in self.clean else found

    def hits(self, words: list[str]) -> dict[str, tuple[int, str]]:
        seen = self._seen
        out = {}
        for w in set(words):
            if w in seen:
                if seen[w]:
                    out[w] = seen[w]
                continue
            found = self.near(w)
            if len(seen) > 200_000:
                seen.clear()
            seen[w] = found
            if found:
                out[w] = found
        return out

    def spans(self, text: str) -> list[tuple[int, int, str, int, float]]:
        """(start, end, term, edits, quotation 0..1) of each hit."""
        low = text.lower()
        found = self.hits(_WORD.findall(low))
        if not found:
            return []
        tokens = [(m.start(), m.end(), m.group()) for m in _WORD.finditer(low)]
        return [(a, b, found[w][1], found[w][0], _quotation(low, tokens, i))
                for i, (a, b, w) in enumerate(tokens) if w in found]

    def features(self, text: str | None) -> list[float]:
        """Whether there is abuse, logarithms of exact, misspelled and quoted mass, and densities of the first two."""
        words = _WORD.findall(text.lower()) if text else []
        if not words or not self.hits(words):
            return [0.0] * 6
        exact = near = quoted = 0.0
        for *_, edits, q in self.spans(text):
            weight = 1 / (1 + edits)
            quoted += weight * q
            if edits:
                near += weight * (1 - q)
            else:
                exact += 1 - q
        size = len(words) + 20
        return [float(exact >= 0.5), math.log1p(exact), math.log1p(near), math.log1p(quoted),
                100 * exact / size, 100 * near / size]

    def score(self, text: str | None) -> float:
        z = self.weights[0] + sum(w * x for w, x in zip(self.weights[1:], self.features(text), strict=True))
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))


def _quotation(text: str, tokens: list[tuple[int, int, str]], i: int) -> float:
    """How far the context of a hit speaks for quotation (1) and not abuse (0)."""
    low, high = max(0, i - CONTEXT), min(len(tokens), i + CONTEXT + 1)
    a, b, _ = tokens[i]
    before, after = text[tokens[low][0]:a], text[b:tokens[high - 1][1]]
    before, after = before.rpartition("\n")[2], after.partition("\n")[0]
    marks = sum(before.count(q) for q in QUOTES)
    inside = marks % 2 == 1 and any(q in after or text[b:b + 1] == q for q in QUOTES)
    around = {w for *_, w in tokens[low:high]}
    q = 0.7 * inside + 0.3 * bool(around & REPORT_WORDS)
    return max(0.0, min(1.0, q - 0.3 * bool(around & ADDRESS_WORDS)))


# -- learning -------------------------------------------------------------------------------------

def _labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, limit: int) -> DataFrame:
    """(y, text) of at most ``limit`` labelled texts, chosen by a hash of the id."""
    chosen = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
                    .groupBy(F.col(id_col).alias("__id")).agg(F.max(label_col).cast("int").alias("y"))
                    .orderBy(F.xxhash64("__id"), "__id").limit(limit))
    rows = (docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text"))
                .join(F.broadcast(chosen), "__id").where("text is not null")
                .groupBy("__id", "y", F.xxhash64("text").alias("hash")).agg(F.min("text").alias("text"))).checkpoint(eager=True)
    if rows.count() > limit:        # an id with several texts: the first of every id come before the second of any
        nth = F.row_number().over(Window.partitionBy("__id").orderBy("hash"))
        first = (rows.select("__id", "hash").withColumn("nth", nth).where(F.col("nth") <= limit)
                     .orderBy("nth", F.xxhash64("__id"), "__id").limit(limit).select("__id", "hash"))
        rows = rows.join(F.broadcast(first), ["__id", "hash"])
    return rows.select("y", "text")


def _distinct_texts(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> tuple[DataFrame, DataFrame]:
    """(__id, hash, text) of all texts, and (__id, hash, y, weight) of the labelled ones; copies count once, by the smallest id.

    Ids and hashes are shuffled, not texts; rows that repeat both id and text
    share one row's weight.
    """
    label = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
                   .groupBy(F.col(id_col).alias("__id")).agg(F.max(label_col).cast("int").alias("y")))
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text"),
                       F.xxhash64(F.col(text_col)).alias("hash")).where("text is not null and __id is not null")
    rows = rows.select("__id", "hash", "text")
    first = (rows.select("__id", "hash").join(label, "__id").groupBy("hash", "y", "__id").agg(F.count(F.lit(1)).alias("n"))
                 .groupBy("hash", "y").agg(F.min(F.struct("__id", "n")).alias("first"))
                 .select("hash", "y", "first.__id", (1 / F.col("first.n")).alias("weight")))
    return rows, first


def _gain(n1: Column, n0: Column, rate: float) -> Column:
    """One-sided binomial deviation of a word's counts from the toxic texts' share."""
    p, q = n1 / (n1 + n0), F.lit(max(rate, 1e-9))
    return n1 * F.log(p / q) + F.when(n0 > 0, n0 * F.log((1 - p) / (1 - q))).otherwise(0.0)


def _word_counts(texts: DataFrame, labelled: DataFrame, max_terms: int) -> tuple[DataFrame, list[str]]:
    """(word, n1, n0: texts by label) over all texts, and the words that stand out in toxic ones.

    Of the words that stand out most by texts (``CANDIDATES`` times
    ``max_terms``), terms are those that do so by distinct (previous, word,
    next) contexts, significantly among all the words looked at; so near copies
    of one text do not make its words terms.
    """

    key = ", ".join(f"{c} {kind}" for c, kind in texts.dtypes if c != "text")

    def distinct(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["text"] = [" ".join(sorted(set(words_of(text)))) for text in batch["text"]]
            yield batch.rename(columns={"text": "words"})

    # Texts leave their tasks as distinct words, contexts as those of the words looked at.
    listed = texts.mapInPandas(distinct, f"{key}, words string").join(labelled, ["__id", "hash"])
    words = (listed.where("words <> ''").select("y", "weight", F.explode(F.split("words", " ")).alias("word"))
                   .groupBy("word").agg(F.round(F.sum(F.col("weight") * F.col("y"))).alias("n1"),
                                        F.round(F.sum(F.col("weight") * (1 - F.col("y")))).alias("n0"))).checkpoint(eager=True)
    t = words.agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"), F.count(F.lit(1)).alias("words")).first()
    rate, need = (t["n1"] or 0) / max(1, (t["n1"] or 0) + (t["n0"] or 0)), math.log(max(2, t["words"]))

    def outstanding(counts: DataFrame, least: int, need: float, limit: int) -> list[str]:
        n1, n0 = F.col("n1").cast("double"), F.col("n0").cast("double")
        gain = _gain(n1, n0, rate)
        return [r["word"] for r in counts.where((n1 >= least) & (n1 >= n0)).withColumn("gain", gain).where(F.col("gain") >= need)
                .orderBy(F.desc("gain"), "word").limit(limit).select("word").collect()]

    looked = frozenset(outstanding(words, 2, 0.0, CANDIDATES * max_terms))

    def contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for own, print_, text in zip(batch["__id"], batch["hash"], batch["text"], strict=True):
                found = ["", *words_of(text), ""]
                if not looked.isdisjoint(found):
                    out += {(own, print_, b, a + " " + c) for a, b, c in zip(found, found[1:], found[2:], strict=False) if b in looked}
            yield pd.DataFrame(out, columns=["__id", "hash", "word", "around"])

    around = (texts.select("__id", "hash", "text").mapInPandas(contexts, f"{key}, word string, around string")
                   .select("__id", "hash", "word", F.xxhash64("around").alias("around")).join(labelled, ["__id", "hash"])
                   .groupBy("word", "around").agg(F.max("y").alias("hi"), F.min("y").alias("lo"))
                   .groupBy("word").agg(F.sum("hi").alias("n1"), F.sum(1 - F.col("lo")).alias("n0")))
    return words, outstanding(around, 3, need, max_terms) if looked else []


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 60) -> np.ndarray:
    """Weights (bias first) of a ridge logistic regression by Newton's method."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    penalty = np.diag([1e-6] + [ridge] * (x.shape[1] - 1)) * len(x) ** 0.5
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p) + 1e-9)[:, None]) + penalty, x.T @ (p - y) + penalty @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          limit: int = MAX_LABELLED, max_terms: int = MAX_TERMS, max_clean: int = MAX_CLEAN) -> ToxicityModel:
    """A model from labelled texts; the default weights where a label is missing.

    Words are counted over all labelled texts: the ``max_terms`` that stand out
    most become terms, and of clean words that look like a term the
    ``max_clean`` most frequent are known.  The weights are fitted on at most
    ``limit`` texts.
    """
    prepare(docs.sparkSession)
    rows = _labelled(docs, labels, id_col, text_col, label_col, limit).checkpoint(eager=True)
    words, chosen = _word_counts(*_distinct_texts(docs, labels, id_col, text_col, label_col), max_terms)
    model = ToxicityModel(sorted({*SEED_TERMS, *chosen}))
    shared, terms = model, set(model.terms)

    def look_alikes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda w: w not in terms and shared.near(w) is not None).astype(bool)

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([[int(y), *fitted.features(t)] for y, t in zip(batch["y"], batch["text"], strict=True)],
                               columns=["y", *"abcdef"])

    near = F.pandas_udf(look_alikes, "boolean")
    # Words near a term that clean texts use.
    clean = (words.where((F.col("n0") >= 2) & (F.col("n0") > F.col("n1"))).where(near("word"))
                  .orderBy(F.desc("n0"), "word").limit(max_clean).select("word").toPandas()["word"])
    fitted = ToxicityModel(model.terms, frozenset(clean))
    table = rows.mapInPandas(features, "y int, a double, b double, c double, d double, e double, f double").toPandas()
    if table["y"].nunique() == 2:
        fitted.weights = fit_logistic(table[[*"abcdef"]].to_numpy(), table["y"].to_numpy(dtype=float)).tolist()
    return fitted


SPANS = "array<struct<start:int,end:int,term:string,edits:int,quotation:double>>"


def score_column(model: ToxicityModel, text: Column, spans: bool = False) -> Column:
    """Column struct<score double, hits>: the score of a text (null and empty ones have no hits) and, if asked, its hits."""
    kind = f"score double, n_hits int, spans {SPANS}"

    @F.pandas_udf(kind)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for t in batch:
                t = t if isinstance(t, str) else None
                found = model.spans(t) if spans and t else []
                rows.append((model.score(t), len(found), found))
            yield pd.DataFrame(rows, columns=["score", "n_hits", "spans"])

    return score(text)


def score_documents(docs: DataFrame, model: ToxicityModel, text_col: str = "text", out: str = "toxicity",
                    spans: bool = False) -> DataFrame:
    """``docs`` with a struct column ``out`` (lengthened if taken); every row and column is kept."""
    prepare(docs.sparkSession)
    return docs.withColumn(free_name(docs, out), score_column(model, F.col(text_col), spans))


def drop_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score is below ``threshold``, with their own columns."""
    name = free_name(docs, "__toxicity")
    return (score_documents(docs, model, text_col, name).where(F.col(f"`{name}`.score") < threshold)
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def training_rows(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The labels that may be learned from: crc32 of the id as text, modulo 3, is not 1."""
    return labels.where(fold(id_col, 3) != 1)
