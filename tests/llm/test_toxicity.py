import random
from itertools import product

from verdant.llm import toxicity as t


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def test_automaton_equals_distances():
    rng = random.Random(4)
    terms = ["abcab", "bca", "aaaa", "abcabcabc", "cabba", "bbbbbbbbbb"]
    automaton = t.Automaton(terms)
    words = ["".join(w) for n in range(5) for w in product("abc", repeat=n)]
    words += ["".join(rng.choices("abcd", k=rng.randrange(4, 12))) for _ in range(3000)]
    for term in terms:                                        # and words near the terms
        for _ in range(300):
            w = list(term)
            for _ in range(rng.randrange(4)):
                k = rng.randrange(len(w) + 1)
                w[k:k + rng.randrange(2)] = rng.choice(["", "a", "d"])
            words.append("".join(w))
    for w in words:
        near = [(distance(w, x), x) for x in terms if distance(w, x) <= t.allowed_edits(x)]
        assert automaton.match(w) == (min(near) if near else None), w


def test_context_and_spellings():
    model = t.ToxicityModel(sorted(t.SEED_TERMS))
    assert [s[2:4] for s in model.spans("an idot, an idiott, a w0rthl3ss 1d1ot, lo$er")] == [
        ("idiot", 1), ("idiot", 1), ("worthless", 2), ("idiot", 0), ("loser", 1)]
    assert model.spans("an ideal iota of worth") == [] == model.spans("12345")
    quoted = model.spans('She reported that he wrote "idiot" on the wall')[0][4]
    abuse = model.spans("You are such an idiot")[0][4]
    assert quoted > 0.6 and abuse == 0
    assert model.score("you stupid worthless idiot, you pathetic loser") > 0.7 > model.score('he said "idiot"')
    assert model.score(None) == model.score("") == model.score("a calm and kind text") < 0.2
    long = model.score("fine words " * 200_000 + " idiot")
    assert 0 <= long <= 1


def test_learning_and_frame(spark):
    rng = random.Random(6)
    vocab = ["".join(rng.choices("abcdefghij", k=rng.randrange(3, 9))) for _ in range(400)]
    bad = ["zorkwit", "blaxnor", "quigfump"]

    def doc(toxic):
        words = rng.choices(vocab, k=60)
        for _ in range(4 if toxic else 0):
            words[rng.randrange(60)] = rng.choice(bad)
        return " ".join(words)
    rows = [(i, doc(i % 3 == 0), "x", i % 3 == 0) for i in range(300)]
    copies = [(1000 + i, rows[0][1], "x", True) for i in range(40)]      # copies must not make their words toxic
    docs = spark.createDataFrame([r[:3] for r in rows + copies], "doc_id long, text string, toxicity string")
    labels = spark.createDataFrame([(r[0], int(r[3])) for r in rows + copies] + [(None, 1), (5, None)], "doc_id long, toxic int")
    model = t.learn(docs, labels)
    learned = set(model.terms) - set(t.SEED_TERMS)
    assert set(bad) <= learned and len(learned) <= 5
    fresh = [(1, doc(True)), (2, doc(False)), (3, None), (4, ""), (5, "zorkwitt blaxnr quigfump " * 3)]
    out = t.score_documents(spark.createDataFrame([(*f, "x") for f in fresh], "doc_id long, text string, toxicity string"), model, spans=True)
    got = {r.doc_id: r["toxicity_"] for r in out.collect()}
    assert out.columns == ["doc_id", "text", "toxicity", "toxicity_"]
    assert got[1].score >= 0.7 > got[2].score and got[3].score == got[4].score < 0.5 and got[5].score >= 0.7 and len(got[5].spans) == 9
    kept = t.drop_toxic(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r[0] for r in rows if not r[3]}
    empty = t.learn(docs.limit(0), labels.limit(0))
    assert empty.score("you stupid idiot, you worthless scum") >= 0.7 and t.score_documents(docs.limit(0), empty).count() == 0


def test_held_out_accuracy(spark):
    from verdant.llm.queries import op1_toxicity
    d = "/root/testdata/sf0.1"
    out = op1_toxicity(spark, d)
    labels = spark.read.parquet(f"{d}/labels.parquet")
    rows = out.where("held_out").join(labels, "doc_id").select("predicted", "toxic").collect()
    hit = sum(r.predicted and r.toxic for r in rows)
    assert hit / sum(r.predicted for r in rows) >= 0.9 and hit / sum(r.toxic for r in rows) >= 0.8


def test_labelled_rows_of_repeated_ids(spark):
    """An id that repeats, with copies and with other texts, adds no more rows than asked for."""
    rows = [(1, "the same text")] * 300 + [(1, f"other text {k}") for k in range(300)] + [(k, f"text {k}") for k in range(2, 9)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 9)], "doc_id long, toxic int")
    got = t._labelled(spark.createDataFrame(rows, "doc_id long, text string"), labels, "doc_id", "text", "toxic", 20).collect()
    assert len(got) == 20 == len({r.text for r in got}) and {f"text {k}" for k in range(2, 9)} <= {r.text for r in got}


def test_terms_are_counted_over_all_labelled_texts(spark):
    """Terms beyond the fit's sample are found; copies, repeated rows and near copies do not make terms; ties go by text."""
    rng = random.Random(11)
    vocab = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(300)]
    rows = []
    for i in range(2000):
        words = rng.choices(vocab, k=30)
        if i % 40 == 0:
            words[8], words[16] = "vexmorp", "vexmorq"
        rows.append((i, " ".join(words), int(i % 40 == 0)))
    once = rows[0][1].replace("vexmorp", "copyword").replace("vexmorq", "copyword")
    rows += [(3000 + i, once, 1) for i in range(200)] + [(4000, once + " again", 1)] * 200
    rows += [(5000, None, 1), (5001, "", 1), (None, "vexmorp", 0)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    texts = t._distinct_texts(docs, labels, "doc_id", "text", "toxic")
    words, chosen = t._word_counts(*texts, 500)
    count = {r.word: (r.n1, r.n0) for r in words.collect()}
    assert count["vexmorp"] == (50, 0)
    assert count["copyword"] == (2, 0) and count["again"] == (1, 0)
    assert chosen[:2] == ["vexmorp", "vexmorq"] and "copyword" not in chosen
    assert t._word_counts(*texts, 1)[1] == ["vexmorp"]
    assert {"vexmorp", "vexmorq"} <= set(t.learn(docs, labels, limit=60).terms)


def test_quotation_lowers_a_learned_score(spark):
    """Labels that call abuse toxic and the same words in reported speech clean: the learned weights tell them apart."""
    rng = random.Random(12)
    vocab = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(200)]

    def doc(kind):
        words = rng.choices(vocab, k=30)
        if kind == 1:
            words[10:10] = ["you", "are", "an", rng.choice(["idiot", "moron"])]
        if kind == 2:
            words[10:10] = ["she", "wrote", '"' + rng.choice(["idiot", "moron"]) + '"', "there"]
        return " ".join(words)

    rows = [(i, doc(i % 3), int(i % 3 == 1)) for i in range(600)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    model = t.learn(docs, labels)
    plain = " ".join(vocab[:20])
    assert model.score(f"{plain} you are an idiot {plain}") > 0.9
    assert model.score(f'{plain} she wrote "idiot" there {plain}') < 0.3
