"""Chat transcripts: roles by a hidden Markov model, then canonical turns.

A transcript is a conversation's rows in order; a row may hold several turns
("User: ...", "### Assistant", "<|system|>"), one, or a part without any
marker.  Each line is an observation: its speaker marker, whether it starts a
row, its length, whether it asks, whether it is blank.  The hidden states say
whose turn the line begins or continues; Viterbi finds the likeliest sequence
over the whole conversation, and each turn is rendered in one form.

Rows are range-sorted over the cluster and a long conversation may be cut over
many tasks.  Viterbi is a product of matrices in the (max, +) semiring: each
piece gives a small matrix, the pieces of a conversation are chained, and each
piece is then decoded between its known end states.  No conversation is
gathered into one task.  A group of rows holds many pieces, whose sequences are
searched side by side, a line of each at a time.

The model is counted by Spark: tasks turn whole lines into what they show, and
only the counts of the (few) different shows and moves reach the driver.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verdant.llm.common import cut, prepare

#: Labelled conversations that are learned from at most, and first turns of each.
MAX_CONVERSATIONS = 2000
MAX_ROWS = 64
#: Groups that the conversations of a range of rows are dealt to for decoding.
GROUPS = 64

# Canonical roles and the names that speakers are marked with.
ROLES = ("system", "user", "assistant")
SPEAKERS = {
    "system": "system context instructions instruction developer",
    "user": "user human customer question q prompt client student caller",
    "assistant": "assistant ai bot gpt model answer a response agent chatbot tutor operator",
}
ROLE_OF = {name: role for role, names in SPEAKERS.items() for name in names.split()}
_NAMES = "|".join(sorted(ROLE_OF, key=len, reverse=True))
#: A speaker's name at the start of a line, in brackets, bold, as a heading, or before a colon.
_MARKER = re.compile(rf"\s*(?:<\|(?:im_start\|>|start_header_id\|>)?\s*(?P<tag>{_NAMES})\s*(?:\|>|<\|end_header_id\|>|$)"
                     rf"|\[(?P<box>{_NAMES})\]:?|\*\*(?P<bold>{_NAMES}):?\*\*:?|#{{1,4}}\s*(?P<head>{_NAMES})\s*(?::|$)"
                     rf"|(?P<plain>{_NAMES})\s?:)[ \t]*", re.IGNORECASE)
_END = re.compile(r"\s*(?:<\|im_end\|>|<\|eot_id\|>|<\|end\|>)\s*$")
_ENDS = ("<|im_end|>", "<|eot_id|>", "<|end|>")

#: States: begin and continue a turn of each role.
STATES = [(r, b) for r in ROLES for b in (True, False)]
N = len(STATES)
NEVER = -1e9


def marker_of(line: str) -> tuple[str | None, str]:
    """(role that the line's marker names, the line without it)."""
    m = _MARKER.match(line)
    if not m:
        return None, line
    name = next(x for x in m.groupdict().values() if x)
    return ROLE_OF[name.lower()], line[m.end():]


def without_end(line: str) -> str:
    return _END.sub("", line) if line.rstrip().endswith(_ENDS) else line


def features(line: str, first: bool) -> tuple:
    """What a line shows: marker, start of a row, length class, question, blank."""
    return _shows(*marker_of(line), first)


def _shows(role: str | None, rest: str, first: bool) -> tuple:
    rest = rest.strip()
    return (role or "none", first, min(9, len(rest).bit_length()), rest.endswith("?"), not rest)


@dataclass
class TranscriptModel:
    """Logarithms: start and transition of states, and of each feature's values by state."""

    start: np.ndarray = field(default_factory=lambda: np.zeros(N))
    move: np.ndarray = field(default_factory=lambda: np.zeros((N, N)))
    shows: list[dict] = field(default_factory=list)

    def emissions(self, rows: list[str]) -> tuple[np.ndarray, list[tuple[int, str]]]:
        """(scores of each line by state, (row, line without marker) of each line)."""
        scores, lines = [], []
        for r, text in enumerate(rows):
            for k, line in enumerate(text.split("\n")):
                role, rest = marker_of(line)
                scores.append(self._score(_shows(role, rest, k == 0)))
                lines.append((r, without_end(rest)))
        return np.array(scores).reshape(-1, N), lines

    def _score(self, f: tuple) -> np.ndarray:
        known = getattr(self, "_known", None)
        if known is None:
            known = self._known = {}
        if f not in known:
            s = np.zeros(N)
            for table, value in zip(self.shows, f, strict=True):
                s = s + table.get(value, table[None])
            role, first = f[0], f[1]
            for k, (r, begins) in enumerate(STATES):
                if (first or role != "none") and not begins:
                    s[k] = NEVER                       # a row or a marker begins a turn
                if role != "none" and r != role:
                    s[k] += NEVER / 2                  # a marker names its role
            known[f] = s
        return known[f]


def _counts(conversations: list[list[tuple[str, str]]]) -> TranscriptModel:
    """The model of conversations of (role, text) rows."""
    starts, moves, shown = Counter(), Counter(), Counter()
    for rows in conversations:
        last = None
        for role, text in rows:
            for k, line in enumerate(text.split("\n")):
                state = (role, k == 0)
                if last is None:
                    starts[state] += 1
                else:
                    moves[last, state] += 1
                shown[state, features(line, k == 0)] += 1
                last = state
    return _model(starts, moves, shown)


def _model(starts: dict, moves: dict, shown: dict) -> TranscriptModel:
    """Smoothed relative frequencies from the numbers of starts, (state, next state) and (state, features)."""
    place = {state: k for k, state in enumerate(STATES)}
    start, move = np.ones(N) * 0.1, np.ones((N, N)) * 0.1
    shows = [[Counter() for _ in range(N)] for _ in range(5)]
    for state, n in starts.items():
        start[place[state]] += n
    for (a, b), n in moves.items():
        move[place[a], place[b]] += n
    for (state, f), n in shown.items():
        for table, value in zip(shows, f, strict=True):
            table[place[state]][value] += n
    for j, (r, begins) in enumerate(STATES):
        for i, (own, _) in enumerate(STATES):
            if not begins and own != r:
                move[i, j] = 0.0                       # only its own turn is continued
        if not begins:
            start[j] = 0.0
    with np.errstate(divide="ignore"):
        model = TranscriptModel(np.maximum(np.log(start / start.sum()), NEVER),
                                np.maximum(np.log(move / move.sum(axis=1, keepdims=True)), NEVER))
    for table in shows:
        values = {v for c in table for v in c} | {None}
        total = np.array([sum(c.values()) + len(values) for c in table], dtype=float)
        model.shows.append({v: np.log((np.array([c.get(v, 0) for c in table]) + 1.0) / total) for v in values})
    return model


#: Without labelled conversations: a system turn may come first, then users and assistants alternate.
_DEFAULT = [[("system", "be brief\nand kind"), ("user", "what?"), ("assistant", "this"), ("user", "and\nwhy?"), ("assistant", "that")],
            [("user", "what?\nit is\nodd"), ("assistant", "this\nand more"), ("user", "why?"), ("assistant", "so\nbecause\nof it")]] * 50


_SHOWN = "r string, begins boolean, marker string, first boolean, size int, asks boolean, blank boolean, n long"


def learn(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text", limit: int = MAX_CONVERSATIONS, max_turns: int = MAX_ROWS) -> TranscriptModel:
    """A model from at most ``limit`` conversations (by a hash of the id) and the turns of each below ``max_turns``.

    Lines are read whole.  Roles are matched by the speakers' names; rows of
    other roles, and rows without an id, turn or text, are skipped; copies of a
    row count once.  Without such rows it is the default model.
    """
    prepare(rows.sparkSession)
    names = F.create_map(*[F.lit(x) for kv in ROLE_OF.items() for x in kv])
    kept = (rows.select(F.col(conv_col).alias("c"), F.col(turn_col).alias("t"), names[F.lower(role_col)].alias("r"),
                        F.col(text_col).alias("x")).where("c is not null and r is not null and x is not null")
                .where(F.col("t") < max_turns))
    chosen = kept.select("c").distinct().orderBy(F.xxhash64("c"), "c").limit(limit)
    table = cut(kept.join(F.broadcast(chosen), "c").groupBy("c", "t", "r").agg(F.min("x").alias("x")), "transcript-rows")

    def shapes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen = Counter((role, k == 0, *features(line, k == 0)) for role, text in zip(batch["r"], batch["x"], strict=True)
                           for k, line in enumerate(text.split("\n")))
            yield pd.DataFrame([(*shape, n) for shape, n in seen.items()], columns=[x.split()[0] for x in _SHOWN.split(", ")])

    *shape, _ = (x.split()[0] for x in _SHOWN.split(", "))
    shown = table.select("r", "x").mapInPandas(shapes, _SHOWN).groupBy(*shape).agg(F.sum("n").alias("n")).collect()
    order = Window.partitionBy("c").orderBy("t", "r")                 # at most three rows a turn
    turns = (table.select("c", "t", "r", F.size(F.split("x", "\n", -1)).alias("lines"))
                  .select("r", "lines", F.lag("r").over(order).alias("before"), F.lag("lines").over(order).alias("had"))
                  .groupBy("r", "before", (F.col("had") == 1).alias("one"))
                  .agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("lines") > 1).cast("long")).alias("second"),
                       F.sum(F.greatest(F.col("lines") - 2, F.lit(0)).cast("long")).alias("later")).collect())
    if not turns:
        return _counts(_DEFAULT)
    starts, moves = Counter(), Counter()
    for row in turns:
        if row["before"] is None:
            starts[row["r"], True] += row["n"]
        else:
            moves[(row["before"], row["one"]), (row["r"], True)] += row["n"]
        moves[(row["r"], True), (row["r"], False)] += row["second"]
        moves[(row["r"], False), (row["r"], False)] += row["later"]
    return _model(starts, moves, {((x["r"], x["begins"]), tuple(x[c] for c in shape[2:])): x["n"] for x in shown})


# -- Viterbi ---------------------------------------------------------------------------------------

def transfer(model: TranscriptModel, scores: np.ndarray) -> np.ndarray:
    """(max, +) product of a piece's lines: best score from the state before it to its last state."""
    out = None
    for s in scores:
        step = model.move + s
        out = step if out is None else (out[:, :, None] + step[None]).max(axis=1)
    return out if out is not None else np.where(np.eye(N) > 0, 0.0, NEVER)


def viterbi(model: TranscriptModel, scores: np.ndarray, before: int | None, last: int | None) -> list[int]:
    """Best states of the lines, given the state before them (None: a start) and that of the last (None: free)."""
    best = (model.start if before is None else model.move[before]) + scores[0]
    back = []
    for s in scores[1:]:
        both = best[:, None] + model.move
        back.append(both.argmax(axis=0))
        best = both.max(axis=0) + s
    state = int(best.argmax()) if last is None else last
    path = [state]
    for b in reversed(back):
        state = int(b[state])
        path.append(state)
    return path[::-1]


def viterbi_many(model: TranscriptModel, scores: np.ndarray, sizes: list[int], before: list[int], last: list[int]) -> np.ndarray:
    """``viterbi`` of many pieces at once: the pieces' lines follow each other in ``scores``, -1 is a start or a free end."""
    sizes, before, last = (np.asarray(x, dtype=np.int64) for x in (sizes, before, last))
    order = np.argsort(-sizes, kind="stable")                       # the pieces that have a k-th line come first
    at, sizes, before, last = (np.cumsum(sizes) - sizes)[order], sizes[order], before[order], last[order]
    active = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")
    best = np.where(before[:, None] < 0, model.start[None], model.move[np.maximum(before, 0)]) + scores[at]
    back = np.zeros(scores.shape, dtype=np.int8)
    for k in range(1, sizes[0]):
        m = active[k]
        both = best[:m, :, None] + model.move[None]
        back[at[:m] + k] = both.argmax(axis=1)
        best[:m] = both.max(axis=1) + scores[at[:m] + k]
    state = np.where(last < 0, best.argmax(axis=1), last)
    path = np.zeros(len(scores), dtype=np.int64)
    for k in range(sizes[0] - 1, -1, -1):
        m = active[k]
        here = at[:m] + k
        path[here] = state[:m]
        state[:m] = back[here, state[:m]]
    return path


def render(role: str, text: str) -> str:
    """The canonical form of a turn."""
    return f"<|{role}|>\n{text.strip()}\n<|end|>\n"


_TURNS = "c string, t string, part int, role string, text string, rendered string"


def parse(rows: DataFrame, model: TranscriptModel, conv_col: str = "conv_id", turn_col: str = "turn",
          text_col: str = "text") -> DataFrame:
    """(conv_col, turn_col, part, role, text, rendered): the canonical turns of every conversation.

    A row's turns are its parts 0, 1, ...; a row without text is one empty
    turn.  Rows follow each other by turn (nulls first), then by a hash of the
    text; repeated rows are repeated turns.  A null conversation id is a
    conversation of its own.  Other columns, the role's too, are not read; an
    empty table gives an empty result.  Ids and turns are of a type that a
    cast to text and back leaves as it is.
    """
    prepare(rows.sparkSession)
    order = [F.col("c").asc_nulls_first(), F.col("t").asc_nulls_first(), F.xxhash64("x")]

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        seg, pos = TaskContext.get().partitionId(), 0
        for batch in batches:
            yield batch.assign(seg=seg, pos=range(pos, pos + len(batch)))
            pos += len(batch)

    kind = dict(rows.dtypes)
    schema = f"c {kind[conv_col]}, t {kind[turn_col]}, x string, seg int, pos long"
    table = cut(rows.select(F.col(conv_col).alias("c"), F.col(turn_col).alias("t"), F.coalesce(F.col(text_col), F.lit("")).alias("x"))
                    .repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(number, schema), "transcripts")
    key = F.coalesce(F.col("c").cast("string"), F.lit(""))
    named = table.withColumn("conv", F.concat(F.when(F.col("c").isNull(), "-").otherwise("+"), key))
    # Conversations that were cut over tasks: a matrix per piece, then a chain of the pieces.
    cuts = named.groupBy("conv").agg(F.min("seg").alias("lo"), F.max("seg").alias("hi")).where("lo < hi").select("conv")
    cuts = cut(cuts, "transcript-cuts")                 # at most one new conversation per task boundary
    ends = _chain(named.join(cuts, "conv"), model)

    def decode(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["conv", "pos"], kind="stable")
        texts, convs = group["x"].tolist(), group["conv"].tolist()
        starts = [k for k, name in enumerate(convs) if k == 0 or name != convs[k - 1]]
        piece_of = np.cumsum(np.isin(np.arange(len(convs)), starts)) - 1
        known = [[-1 if x != x else int(x) for x in group[c].iloc[starts].tolist()] for c in ("before", "last")]
        scores, lines = model.emissions(texts)
        sizes = np.bincount(piece_of[[r for r, _ in lines]], minlength=len(starts))
        turns: list[tuple[int, int, str, list[str]]] = []
        for state, (r, line) in zip(viterbi_many(model, scores, sizes, *known).tolist(), lines, strict=True):
            role, begins = STATES[state]
            if begins or not turns or piece_of[turns[-1][0]] != piece_of[r]:
                turns.append((r, turns[-1][1] + 1 if turns and turns[-1][0] == r else 0, role, [line]))
            else:
                turns[-1][3].append(line)
        ids, places = group["c"].tolist(), group["t"].tolist()
        return pd.DataFrame([(ids[r], places[r], part, role, "\n".join(text), render(role, "\n".join(text)))
                             for r, part, role, text in turns], columns=[c.split()[0] for c in _TURNS.split(", ")], dtype=object)

    # Pieces of cut conversations know the states at their ends; a group holds many pieces of one range of rows.
    pieces = (named.select(F.col("c").cast("string").alias("c"), F.col("t").cast("string").alias("t"), "conv", "seg", "pos", "x")
                   .join(ends, ["conv", "seg"], "left"))
    turns = (pieces.groupBy("seg", F.pmod(F.xxhash64("conv"), F.lit(GROUPS)).alias("part"))
                   .applyInPandas(decode, _TURNS))
    return turns.select(F.col("c").cast(kind[conv_col]).alias(conv_col), F.col("t").cast(kind[turn_col]).alias(turn_col),
                        "part", "role", "text", "rendered")


def _chain(pieces: DataFrame, model: TranscriptModel) -> DataFrame:
    """(conv, seg, before, last): the states before each piece (-1: start) and at its end, of cut conversations."""

    def matrix(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("pos")
        scores, _ = model.emissions(group["x"].tolist())
        m = transfer(model, scores)
        first = transfer(model, scores[1:]) if len(scores) > 1 else None
        start = model.start + scores[0]
        begun = (start[:, None] + first).max(axis=0) if first is not None else start
        return pd.DataFrame({"conv": [group["conv"].iloc[0]], "seg": [int(group["seg"].iloc[0])],
                             "m": [m.ravel().tolist()], "begun": [begun.tolist()]})

    def chain(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("seg")
        best, back = np.array(group["begun"].iloc[0]), []
        for m in group["m"].iloc[1:]:
            both = best[:, None] + np.array(m).reshape(N, N)
            back.append(both.argmax(axis=0))
            best = both.max(axis=0)
        state = int(best.argmax())
        last = [state]
        for b in reversed(back):
            state = int(b[state])
            last.append(state)
        last = last[::-1]
        return pd.DataFrame({"conv": group["conv"].to_numpy(dtype=object), "seg": group["seg"].to_numpy(),
                             "before": [-1, *last[:-1]], "last": last})

    matrices = (pieces.select("conv", "seg", "pos", "x").groupBy("conv", "seg")
                      .applyInPandas(matrix, "conv string, seg int, m array<double>, begun array<double>"))
    return cut(matrices.groupBy("conv").applyInPandas(chain, "conv string, seg int, before int, last int"), "transcript-ends")


def log_likelihood(model: TranscriptModel, scores: np.ndarray, path: list[int]) -> float:
    """Score of a state sequence (for tests)."""
    total = model.start[path[0]] + scores[0][path[0]]
    for a, b, s in zip(path, path[1:], scores[1:], strict=False):
        total += model.move[a, b] + s[b]
    return total if math.isfinite(total) else NEVER
