import numpy as np

from verdant.llm import langid as g


def test_svm_and_sigmoid_separate():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((200, 5)).astype(np.float32)
    y = np.where(x[:, 0] + 0.5 * x[:, 1] > 0, 1.0, -1.0)
    w = g.fit_svm(x, y)
    margin = x @ w[:-1] + w[-1]
    assert ((margin > 0) == (y > 0)).mean() > 0.97
    a, b = g.fit_sigmoid(margin, y)
    p = 1 / (1 + np.exp(-(a * margin + b)))
    assert p[y > 0].mean() > 0.9 > 0.1 > p[y < 0].mean()


def test_features():
    assert np.allclose(g.features("Abc abc"), g.features("ABC, 12 abc!"))
    assert abs((g.features("abc " * 400_000) ** 2).sum() - 2) < 1e-3       # a long text, in parts
    assert not g.has_letter("123 !?") and not g.has_letter(None) and g.has_letter("12é")


def test_hierarchy_and_frame(spark):
    words = {"en": "the cat sat with them there thing", "de": "der hund nicht durch ich schule", "fr": "le chat était avec eux où",
             "es": "el niño años más qué corazón", "xx": "kizo wuzi zuko wiko"}
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(rng.choice(words[k].split(), 20)), k, "x") for i, k in enumerate([*words] * 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, language string")
    odd = spark.createDataFrame([(None, "the cat", None, "x"), (9001, None, "en", "x"), (9002, "12 !", None, "x"), (9003, "", "fr", "x")], df.schema)
    model = g.learn(df.union(odd))
    assert set(model.families) == {"germanic", "romance", "only:xx"} and model.languages["romance"] == ["es", "fr"]
    assert set(model.pair_rows) == {("de", "en"), ("es", "fr")}
    out = g.identify(df.union(odd), model)
    assert out.columns == [*df.columns, "language_"]
    got = out.collect()
    assert len(got) == len(rows) + 4 and np.mean([r["language_"].lang == r.lang for r in got if r.doc_id is not None and r.doc_id < 9000]) > 0.97
    assert all(0 <= r["language_"].score <= 1 for r in got)
    assert {r.doc_id: r["language_"].lang for r in got if (r.doc_id or 0) > 9000} == {9001: "und", 9002: "und", 9003: "und"}
    kept = g.keep_identified(df.union(odd), model)
    assert kept.columns == df.columns and kept.count() == len(rows) + 1
    none = g.learn(df.limit(0))
    assert {r["language_"].lang for r in g.identify(df.limit(5), none).collect()} == {"und"}
    assert g.identify(df.limit(0), model).count() == 0
    one = g.learn(df.where("lang = 'en'"))
    assert {r["language_"].lang for r in g.identify(df.limit(5), one).collect()} == {"en"}


def test_held_out_accuracy(spark):
    from verdant.llm.queries import op2_language
    d = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang")
    rows = op2_language(spark, d).where("held_out").join(docs, "doc_id").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) >= 0.97


def test_languages_are_a_parameter(spark):
    rows = [(k, lang, text) for k, (lang, text) in enumerate([("en", "the house"), ("de", "das haus"), ("fr", "la maison")] * 9 + [("en", "a dog")])]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    assert sorted(x for v in g.learn(df).languages.values() for x in v) == ["de", "en", "fr"]
    assert sorted(x for v in g.learn(df, max_languages=2).languages.values() for x in v) == ["de", "en"]


def test_sample_of_repeated_ids(spark):
    """An id that repeats, with copies and with other texts, adds no more rows than asked for."""
    rows = [(1, "en", "the same text")] * 300 + [(1, "en", f"other text {k}") for k in range(300)] + [(k, "en", f"text {k}") for k in range(2, 9)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    got = g._sample(df, "doc_id", "text", "lang", 20, 5).collect()
    assert len(got) == 20 == len({(r["__id"], r.text) for r in got})
    assert {r["__id"] for r in got} == set(range(1, 9))


def test_many_languages_are_learned_in_tasks(spark):
    """200 languages, each a family of its own: the driver gets weights alone, and the rest's share is bounded."""
    rng = np.random.default_rng(5)
    rows = []
    for k in range(200):
        words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 5)) for _ in range(6)]
        rows += [(len(rows) + j, f"q{k:03d}", " ".join(rng.choice(words, 30))) for j in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(4)
    model = g.learn(df, max_rest=300)
    assert len(model.families) == 200 == len(model.weights) and not model.pair_rows
    got = g.identify(df, model).collect()
    assert np.mean([r.language.lang == r.lang for r in got]) > 0.95


def test_votes_by_brute_force(spark):
    """Family, votes and score, taken from the machines one by one."""
    words = {"en": "the cat sat with them", "de": "der hund nicht durch ich", "nl": "de kat zat niet met hen", "sv": "katten satt inte med dem och",
             "fr": "le chat etait avec eux", "es": "el gato estaba con ellos", "ru": "кот сидел с ними"}
    rng = np.random.default_rng(3)
    rows = [(i, k, " ".join(rng.choice(words[k].split(), 8))) for i, k in enumerate([*words] * 20)]
    model = g.learn(spark.createDataFrame(rows, "doc_id long, lang string, text string"))
    texts = [t for _, _, t in rows[:30]] + ["the kat nicht med", "x", "de de de", "кот the"]
    for text, (lang, score, family) in zip(texts, model.predict(texts), strict=True):
        x = g.features(text).astype(float)

        def p(row):
            slope, bias = model.sigmoids[row]
            return 1 / (1 + np.exp(-np.clip(slope * (sum(model.weights[row][:-1] * x) + model.weights[row][-1]) + bias, -30, 30)))

        shares = {f: p(model.family_rows[f]) + 1e-12 for f in model.families}
        first = max(shares, key=lambda f: (shares[f], -model.families.index(f)))
        langs = model.languages[first]
        won = {a: sum((p(model.pair_rows[a, b]) >= 0.5) if (a, b) in model.pair_rows else (p(model.pair_rows[b, a]) < 0.5)
                      for b in langs if b != a) for a in langs}
        sums = {a: sum(p(model.pair_rows[a, b]) if (a, b) in model.pair_rows else 1 - p(model.pair_rows[b, a])
                       for b in langs if b != a) for a in langs}
        best = max(langs, key=lambda a: (won[a], sums[a]))
        within = 1.0 if len(langs) == 1 else sums[best] / (len(langs) - 1)
        assert (family, lang) == (first, best) and abs(score - shares[first] / sum(shares.values()) * within) < 1e-6


def test_ties_between_languages(spark):
    """Equal texts under two languages: the same answer for all of them, and the learned model is the same again."""
    rows = [(i, lang, "one and the same text") for i, lang in enumerate(["en", "de"] * 20)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    models = [g.learn(df), g.learn(df.repartition(5))]
    assert np.array_equal(models[0].weights, models[1].weights)
    assert len({(r.language.lang, r.language.score) for r in g.identify(df, models[0]).collect()}) == 1


def test_sample_is_full_and_bounded(spark):
    rows = [(i, "en" if i % 10 else "de", f"text {i}") for i in range(20_000)]
    got = g._sample(spark.createDataFrame(rows, "doc_id long, lang string, text string"), "doc_id", "text", "lang", 100, 5).groupBy("lang").count().collect()
    assert {r["lang"]: r["count"] for r in got} == {"en": 100, "de": 100}
