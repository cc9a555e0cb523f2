import random

import numpy as np
import pytest

from verdant.llm import transcripts as t


def brute(model, scores):
    from itertools import product
    return max(product(range(t.N), repeat=len(scores)), key=lambda p: t.log_likelihood(model, scores, list(p)))


def test_viterbi_equals_brute_force_and_pieces():
    rng = np.random.default_rng(2)
    for _ in range(10):
        model = t.TranscriptModel(rng.standard_normal(t.N), rng.standard_normal((t.N, t.N)), [])
        scores = rng.standard_normal((5, t.N))
        path = t.viterbi(model, scores, None, None)
        assert path == list(brute(model, scores))
        m = t.transfer(model, scores[1:])
        assert np.isclose((model.start + scores[0])[:, None] + m, ((model.start + scores[0])[:, None] + m)).all()
        best = ((model.start + scores[0])[:, None] + m).max()
        assert np.isclose(best, t.log_likelihood(model, scores, path))
        cut = t.viterbi(model, scores[:2], None, path[1]) + t.viterbi(model, scores[2:], path[1], path[-1])
        assert cut == path


def test_many_pieces_equal_one_by_one():
    rng = np.random.default_rng(5)
    model = t.TranscriptModel(rng.standard_normal(t.N), rng.standard_normal((t.N, t.N)), [])
    sizes = [3, 1, 40, 7, 1, 3]
    before, last = [-1, 2, -1, 0, -1, 5], [-1, 3, 4, -1, -1, 0]
    scores = np.round(rng.standard_normal((sum(sizes), t.N)), 1)
    got, at = t.viterbi_many(model, scores, sizes, before, last), 0
    for n, b, e in zip(sizes, before, last, strict=True):
        assert got[at:at + n].tolist() == t.viterbi(model, scores[at:at + n], None if b < 0 else b, None if e < 0 else e)
        at += n


def test_learned_counts_equal_plain_ones(spark):
    """Counting in Spark gives the model of counting row by row; lines are read whole, copies once, turns up to the bound."""
    rng = random.Random(8)
    chats = [talk(rng.randrange(1, 9), rng) for _ in range(30)]
    chats.append([("user", "why " * 5000 + "?"), ("assistant", "x" * 100_000 + "\n\nUser: y"), ("user", "\n")])
    rows = [(c, k, "Human" if role == "user" else role, text) for c, chat in enumerate(chats) for k, (role, text) in enumerate(chat)]
    more = [rows[0], (None, 0, "user", "x"), (3, None, "user", "x"), (3, 0, None, "x"), (3, 1, "narrator", "x"), (3, 1, "user", None),
            (3, 7, "user", "beyond?")]
    df = spark.createDataFrame(rows + more, "conv_id long, turn long, role string, text string")
    got, want = t.learn(df, max_turns=7), t._counts([chat[:7] for chat in chats])
    assert np.allclose(got.start, want.start) and np.allclose(got.move, want.move)
    for a, b in zip(got.shows, want.shows, strict=True):
        assert a.keys() == b.keys() and all(np.allclose(a[v], b[v]) for v in a)
    long = spark.createDataFrame([(1, 0, "why " * 300_000 + "?\n" + "line\n" * 50_000)], "conv_id long, turn long, text string")
    text = long.first().text
    turns = t.parse(long, got).orderBy("part").collect()
    path = t.viterbi(got, got.emissions([text])[0], None, None)
    assert "\n".join(r.text for r in turns) == text
    assert [r.role for r in turns] == [t.STATES[k][0] for k in path if t.STATES[k][1]] and turns[0].role == "user"


@pytest.mark.parametrize("line, role, rest", [
    ("User: hi", "user", "hi"), ("### Assistant", "assistant", ""), ("<|system|>", "system", ""), ("[Human] x", "user", "x"),
    ("**AI:** y", "assistant", "y"), ("A: yes", "assistant", "yes"), ("<|im_start|>user", "user", ""), ("Users: no", None, "Users: no"),
    ("a plain line", None, "a plain line")])
def test_markers(line, role, rest):
    assert t.marker_of(line) == (role, rest)


def talk(n, rng):
    out = [("system", "Be brief.")] if rng.random() < 0.3 else []
    for k in range(n):
        out.append(("user", " ".join(["ask"] * rng.randrange(2, 9)) + "?") if k % 2 == 0 else
                   ("assistant", "\n".join(" ".join(["tell"] * rng.randrange(9, 40)) for _ in range(rng.randrange(1, 5)))))
    return out


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(3)
    rows = [(c, k, role, text, "x") for c in range(40) for k, (role, text) in enumerate(talk(rng.randrange(1, 9), rng))]
    rows += [(500, k, role, text, "x") for k, (role, text) in enumerate(talk(1500, rng))]     # a conversation over many tasks
    return rows, spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part string")


def test_roles_are_recovered(spark, data):
    rows, df = data
    model = t.learn(df)
    got = t.parse(df.drop("role"), model).collect()
    assert len(got) == len(rows) and {r.part for r in got} == {0}
    want = {(c, k): role for c, k, role, _, _ in rows}
    assert np.mean([r.role == want[r.conv_id, r.turn] for r in got]) > 0.97
    text = {(c, k): x for c, k, _, x, _ in rows}
    assert all(r.rendered == f"<|{r.role}|>\n{text[r.conv_id, r.turn]}\n<|end|>\n" for r in got)


def test_cut_conversations_have_the_best_path(spark, data):
    """The long conversation, decoded in pieces over tasks, scores as well as decoded whole."""
    rows, df = data
    model = t.learn(df)
    texts = [x for c, _, _, x, _ in rows if c == 500]
    scores, _ = model.emissions(texts)
    whole = t.viterbi(model, scores, None, None)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = [r.role for r in t.parse(df.where("conv_id = 500"), model).orderBy("turn", "part").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == [t.STATES[s][0] for s in whole if t.STATES[s][1]]


def test_markers_nulls_and_empties(spark):
    model = t.learn(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    rows = [(1, 0, "User: what is it?\nA thing\nAssistant: an answer\nof two lines\n\nUser: thanks"), (2, None, "Q: a?"), (2, 1, None), (2, 1, None),
            (None, 0, "### System\nrules<|im_end|>"), (3, 5, "")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, text string, seg string")
    got = sorted((str(r.conv_id), str(r.turn), r.part, r.role, r.text) for r in t.parse(df, model).collect())
    assert [g[2:] for g in got if g[0] == "1"] == [(0, "user", "what is it?\nA thing"), (1, "assistant", "an answer\nof two lines\n"), (2, "user", "thanks")]
    assert [g[2:] for g in got if g[0] == "None"] == [(0, "system", "\nrules")]
    assert len([g for g in got if g[0] == "2"]) == 3 and len([g for g in got if g[0] == "3"]) == 1
    assert t.parse(df.limit(0), model).count() == 0
