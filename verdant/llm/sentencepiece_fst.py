"""SentencePiece encoding and decoding with weighted finite-state transducers.

A model is compiled into three transducers, given by their arcs:

* the normaliser reads characters and writes symbols (white space as U+2581, the
  dummy prefix, runs of blanks as one); its states are START, BODY and GAP;
* the pieces are a trie over symbols whose final states write ids;
* byte fallback reads the UTF-8 bytes of a symbol that no piece stands for and writes
  their ids; its states are the number of bytes still to come.

A text is composed with the normaliser (which is deterministic, so a chain of symbols
comes out) and the chain with the union of pieces and fallback, whose arcs are made when
the search reaches them.  The path of least weight in the tropical semiring (weights add
along a path, the smallest wins) is the encoding, and its arcs' outputs are the ids.

* Unigram models: an arc weighs the negated log probability of its piece.
* BPE models: states also hold the last piece, and an arc weighs 0 where merging
  the two pieces' text alone gives back just these two pieces, else infinity.
  A sequence is the BPE encoding of its text exactly if each neighbouring pair
  passes this test (see Berglund et al., "Constructing a BPE Tokenization DFA",
  2024), so one path of finite weight is left, and each prefix has one too.

Where no piece holds two neighbouring characters, the lattice falls apart
between them.  Texts are cut there (before words, and between letters and
punctuation), and the parts, which all but the first meet the normaliser in BODY, are
composed and searched once and remembered.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdant.llm.common import free_name, prepare

SPACE = "▁"
#: Parts of texts whose ids a worker remembers (so many new ones, and as many of before), and pairs of pieces.
CACHE_WORDS = 250_000
CACHE_PAIRS = 500_000
#: Texts whose ids leave a worker at once.
ROWS_OUT = 500
#: Characters of a text that are encoded at once, where it can be cut.
PART = 4_000_000
INFINITY = float("inf")
WORD_START = re.compile(f"(?<=[^ {SPACE}])[ {SPACE}]")
#: States of the normaliser: nothing written yet, a symbol written last, blanks held back.
START, BODY, GAP = range(3)


class Transducer:
    """A compiled model: ``encode(text)`` gives ids, ``decode(ids)`` text."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        kinds = pb.ModelProto.SentencePiece
        self.bpe = model.trainer_spec.model_type == pb.TrainerSpec.BPE
        if not self.bpe and model.trainer_spec.model_type != pb.TrainerSpec.UNIGRAM:
            raise ValueError("only BPE and unigram models")
        norm = model.normalizer_spec
        if norm.precompiled_charsmap or not norm.escape_whitespaces or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only identity normalisers with escaped white space before words")
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces):
            raise ValueError("no user-defined or unused pieces")
        self.dummy_prefix = norm.add_dummy_prefix
        self.normaliser = self._normaliser(SPACE if norm.add_dummy_prefix else "", norm.remove_extra_whitespaces)
        self.pieces = [p.piece for p in model.pieces]
        self.score = [p.score for p in model.pieces]
        self.unknown = next((i for i, p in enumerate(model.pieces) if p.type == kinds.UNKNOWN), 0)
        self.byte_id = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE}
        self.id_of = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        self.byte_fallback = model.trainer_spec.byte_fallback and len(self.byte_id) == 256
        self.fallback = self._fallback()
        self.unknown_weight = 10.0 - min((self.score[i] for i in self.id_of.values()), default=0.0)
        # A character that only longer pieces hold is a piece of its own for the search; its output is the fallback's.
        self.listed = len(self.pieces)
        for c in sorted({c for p in self.id_of for c in p} - set(self.id_of)):
            self.id_of[c] = len(self.pieces)
            self.pieces.append(c)
            self.score.append(-self.unknown_weight)
        # What an arc of the pieces writes: its id, or the fallback's output of a character that is no piece.
        self.writes = [(i,) if i < self.listed else self.fall_back(p) for i, p in enumerate(self.pieces)]
        # The piece transducer: a node maps a character to (id emitted there or -1, next node).
        self.root: dict[str, list] = {}
        for piece, i in self.id_of.items():
            node = self.root
            for c in piece[:-1]:
                node = node.setdefault(c, [-1, {}])[1]
            node.setdefault(piece[-1], [-1, {}])[0] = i
        self.cut = self._cuts()
        self.words: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.fits: dict[int, dict[int, bool]] = {}
        self.n_fits = 0
        normal = set(self.id_of.values())
        self.text_of = [p.replace(SPACE, " ").encode() if i in normal else b"" for i, p in enumerate(self.pieces[:self.listed])]
        for value, i in self.byte_id.items():
            self.text_of[i] = bytes([value])
        self.text_of[self.unknown] = " \u2047 ".encode()

    def _cuts(self) -> re.Pattern | None:
        """Pattern of the parts that a text falls into; None if pieces go on over word starts.

        Characters that neighbour each other in some piece are of one class; a
        part is a run of one class with the word starts before it.
        """
        if any(SPACE in p.lstrip(SPACE) for p in self.id_of):
            return None
        group = {c: c for p in self.id_of for c in p if c != SPACE}

        def find(c):
            while group[c] != c:
                group[c] = group[group[c]]
                c = group[c]
            return c

        for p in self.id_of:
            p = p.lstrip(SPACE)
            for a, b in zip(p, p[1:], strict=False):
                group[find(a)] = find(b)
        classes: dict[str, list[str]] = {}
        for c in sorted(group):
            classes.setdefault(find(c), []).append(c)
        runs = [f"[{''.join(map(re.escape, cs))}]+" for cs in sorted(classes.values(), key=len, reverse=True) if len(cs) > 1]
        return re.compile(f"[ {SPACE}]*(?:{'|'.join([*runs, f'[^ {SPACE}]'])})|[ {SPACE}]+", re.DOTALL)

    # -- normaliser and fallback ---------------------------------------------------------------------

    @staticmethod
    def _normaliser(prefix: str, squeeze: bool) -> dict[int, tuple[tuple[str, int], tuple[str, int]]]:
        """Arcs of a state: (symbols written, next state) for a blank, and the same for a character, which is copied behind."""
        if squeeze:
            return {START: (("", START), (prefix, BODY)), BODY: (("", GAP), ("", BODY)), GAP: (("", GAP), (SPACE, BODY))}
        return {START: ((prefix + SPACE, BODY), (prefix, BODY)), BODY: ((SPACE, BODY), ("", BODY))}

    def normalise(self, text: str, state: int = START) -> str:
        """The chain of symbols that a text composed with the normaliser writes from ``state`` on; every state is final."""
        out = []
        for c in text:
            blank, other = self.normaliser[state]
            if c == " ":
                written, state = blank
                out.append(written)
            else:
                written, state = other
                out.append(written + c)
        return "".join(out)

    def _fallback(self) -> dict[int, dict[int, tuple[int, int]]]:
        """Arcs of the byte machine: state (bytes still to come) -> byte -> (id written, next state)."""
        if not self.byte_fallback:
            return {}
        lead = {b: 0 if b < 0x80 else 1 if b < 0xE0 else 2 if b < 0xF0 else 3 for b in [*range(0x80), *range(0xC2, 0xF5)]}
        arcs = {0: {b: (self.byte_id[b], more) for b, more in lead.items()}}
        for more in (1, 2, 3):
            arcs[more] = {b: (self.byte_id[b], more - 1) for b in range(0x80, 0xC0)}
        return arcs

    def fall_back(self, symbol: str) -> tuple[int, ...]:
        """What the fallback writes for a symbol: the ids along its bytes, or the unknown id without byte pieces."""
        if not self.byte_fallback:
            return (self.unknown,)
        state, ids = 0, []
        for byte in symbol.encode("utf-8", "surrogatepass"):
            written, state = self.fallback[state][byte]
            ids.append(written)
        return tuple(ids)

    # -- weights -------------------------------------------------------------------------------------

    def merge(self, text: str) -> list[str]:
        """Plain BPE of a short text: join the best-scored neighbours, the leftmost of equals, till none is a piece."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                i = self.id_of.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or self.score[i] > best):
                    best, at = self.score[i], k
            if best is None:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def fit(self, last: int, piece: int) -> bool:
        """Whether a BPE arc for ``piece`` weighs 0 in a state whose last piece is ``last`` (-1: none); else infinity."""
        own = self.pieces[piece]
        expected = [own] if last < 0 else [self.pieces[last], own]
        self.n_fits += 1
        return self.merge("".join(expected)) == expected

    # -- composition and shortest path ---------------------------------------------------------------

    def _bpe_path(self, text: str) -> list[tuple[int, ...]]:
        """Outputs along the only path of finite weight: one state per position is reached."""
        if self.n_fits > CACHE_PAIRS:
            self.fits, self.n_fits = {}, 0
        n, root, fits, writes = len(text), self.root, self.fits, self.writes
        back, last, wrote = [0] * (n + 1), [None] * (n + 1), [()] * (n + 1)
        last[0] = -1
        for i in range(n):
            state = last[i]
            if state is None:
                continue
            arc = root.get(text[i])
            if arc is None:                       # no piece holds it: the fallback's arc, and a new start behind it
                last[i + 1], back[i + 1], wrote[i + 1] = -1, i, self.fall_back(text[i])
                continue
            row = fits.get(state)
            if row is None:
                row = fits[state] = {}
            j = i
            while arc is not None:
                piece, node = arc
                j += 1
                if piece >= 0:
                    ok = row.get(piece)
                    if ok is None:
                        ok = row[piece] = self.fit(state, piece)
                    if ok:
                        last[j], back[j], wrote[j] = piece, i, writes[piece]
                arc = node.get(text[j]) if j < n else None
        return self._outputs(back, wrote)

    def _unigram_path(self, text: str) -> list[tuple[int, ...]]:
        """Outputs along the path of least weight: all arcs lead forward, so one sweep relaxes them."""
        n = len(text)
        total, back, wrote = [INFINITY] * (n + 1), [0] * (n + 1), [()] * (n + 1)
        total[0] = 0.0
        for i in range(n):
            arc, j = self.root.get(text[i]), i
            if arc is None:
                w = total[i] + self.unknown_weight
                if w < total[i + 1]:
                    total[i + 1], back[i + 1], wrote[i + 1] = w, i, self.fall_back(text[i])
            while arc is not None:
                piece, node = arc
                j += 1
                if piece >= 0:
                    w = total[i] - self.score[piece]
                    if w < total[j]:
                        total[j], back[j], wrote[j] = w, i, self.writes[piece]
                arc = node.get(text[j]) if j < n else None
        return self._outputs(back, wrote)

    @staticmethod
    def _outputs(back: list[int], wrote: list[tuple[int, ...]]) -> list[tuple[int, ...]]:
        out, at = [], len(back) - 1
        while at:
            out.append(wrote[at])
            at = back[at]
        return out[::-1]

    def shortest_path(self, symbols: str) -> list[int]:
        """Ids on the path of least weight through the lattice of a chain of symbols."""
        ids: list[int] = []
        for written in (self._bpe_path(symbols) if self.bpe else self._unigram_path(symbols)):
            if self.byte_fallback or written != (self.unknown,) or not ids or ids[-1] != self.unknown:
                ids += written
        return ids

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a text; none for null and empty ones."""
        if not text:
            return np.zeros(0, dtype=np.int32)
        if self.cut is None:
            return np.array(self.shortest_path(self.normalise(text)), dtype=np.int32)
        # The first part meets the normaliser in START; the parts behind a character that is no blank in BODY.
        first = self.cut.match(text).group()
        out, at = [self._ids(first, START)], len(first)
        while at < len(text):
            # A long text in steps that end before the blanks before a word; a text without words is one step.
            end = WORD_START.search(text, at + PART) if len(text) - at > PART else None
            end = end.start() if end else len(text)
            out.append(self._parts(text[at:end]))
            at = end
        ids = np.frombuffer(b"".join(out), dtype=np.int32)
        if self.byte_fallback or len(ids) < 2:
            return ids
        unknown = ids == self.unknown                     # a run of unknown characters is one piece
        return ids[np.concatenate([[True], ~(unknown[1:] & unknown[:-1])])]

    def _ids(self, part: str, state: int) -> bytes:
        return np.array(self.shortest_path(self.normalise(part, state)), dtype=np.int32).tobytes()

    def _parts(self, text: str) -> bytes:
        parts, known, before = self.cut.findall(text), self.words, self.before
        for p in set(parts):
            if p not in known:
                ids = before.get(p)
                known[p] = self._ids(p, BODY) if ids is None else ids
        out = b"".join([known[p] for p in parts])
        if len(known) > CACHE_WORDS:
            self.words, self.before = {}, known
        return out

    def decode(self, ids) -> str:
        """The text of ids; byte pieces that are no UTF-8 become U+FFFD, control and unlisted ids nothing."""
        text_of, size = self.text_of, len(self.text_of)
        data = b"".join([text_of[i] for i in ids if 0 <= i < size])
        text = data.decode("utf-8", "replace")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    return Transducer(path)


def encode_column(path: str, text: Column) -> Column:
    """Column array<int>: the ids of a text; empty for null and empty texts."""

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fst = transducer(path)
        for batch in batches:
            texts = batch.tolist()
            for at in range(0, len(texts), ROWS_OUT):
                yield pd.Series([fst.encode(t if isinstance(t, str) else None) for t in texts[at:at + ROWS_OUT]], dtype=object)

    return encode(text)


def decode_column(path: str, ids: Column) -> Column:
    """Column string: the text of ids; empty for null ids."""

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fst = transducer(path)
        for batch in batches:
            for at in range(0, len(batch), ROWS_OUT):
                yield pd.Series([fst.decode(x.tolist()) if x is not None else "" for x in batch.iloc[at:at + ROWS_OUT]], dtype=object)

    return decode(ids)


def digest_column(path: str, text: Column) -> Column:
    """Column struct<n_ids, ids_crc32, round_trip>: a text's ids by their number and crc32, and whether they decode to it.

    The crc32 is unsigned and of the ids as little-endian 32-bit integers; a
    text round-trips if decoding gives it back, U+2581 read as a space.
    """

    @F.pandas_udf("n_ids long, ids_crc32 long, round_trip boolean")
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        fst = transducer(path)
        for batch in batches:
            rows = []
            for t in batch:
                t = t if isinstance(t, str) else ""
                ids = fst.encode(t)
                rows.append((len(ids), zlib.crc32(ids.astype("<i4").tobytes()), fst.decode(ids.tolist()) == t.replace(SPACE, " ")))
            yield pd.DataFrame(rows, columns=["n_ids", "ids_crc32", "round_trip"])

    return digest(text)


def tokenize(docs: DataFrame, path: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with a column ``out`` (lengthened if taken) of the texts' ids; every row and column is kept."""
    prepare(docs.sparkSession)
    return docs.withColumn(free_name(docs, out), encode_column(path, F.col(text_col)))
