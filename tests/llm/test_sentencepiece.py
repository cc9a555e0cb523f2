import random

import pytest

from verdant.llm import sentencepiece_fst as s

P = pytest.importorskip("public_tokenizers")
PATH = P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_ids_equal_library(library):
    rng = random.Random(1)
    fst = s.Transducer(PATH)
    cases = ["", "  hi  \n\tthere é☃ ▁x", " " * 40, "a" * 100, "<0x0A> </s> <unk>", "\n\n  \n", "日本語テキスト 🙂🙂", "▁▁", "é" * 30,
             *["".join(rng.choice(" abcdeéthing\n.,▁ß你1") for _ in range(rng.randrange(60))) for _ in range(1500)]]
    for c in cases:
        ids = fst.encode(c).tolist()
        assert ids == library.encode(c), repr(c)
        assert fst.decode(ids) == c.replace("▁", " ") == library.decode(ids)
    assert fst.decode([3 + 0xFF, 10**9, -1, 1]) == "�"


def test_normaliser_and_fallback_machines(library, monkeypatch):
    """Arcs of the normaliser against plain replacement, bytes against UTF-8, and cut texts against whole ones."""
    import re
    from itertools import product

    for prefix, squeeze in product(("", "▁"), (False, True)):
        machine = s.Transducer.__new__(s.Transducer)
        machine.normaliser = machine._normaliser(prefix, squeeze)
        for n in range(7):
            for c in product("a ▁", repeat=n):
                text = "".join(c)
                plain = re.sub(" +", " ", text.strip(" ")) if squeeze else text
                assert machine.normalise(text) == (prefix + plain.replace(" ", "▁") if plain else ""), (text, prefix, squeeze)
    fst = s.Transducer(PATH)
    for c in "\0aé☃🙂\U0010ffff":
        assert [fst.pieces[i] for i in fst.fall_back(c)] == [f"<0x{b:02X}>" for b in c.encode()]
    # Long texts in short steps: a run of blanks is never cut.
    monkeypatch.setattr(s, "PART", 5)
    for n in range(12):
        for text in ("ab" + " " * n + "cd  ef" + " " * n, " " * n + "▁ x" * n, "a" * n + "🙂 " * n):
            assert fst.encode(text).tolist() == library.encode(text), repr(text)


def test_one_path_and_weights():
    """The path's neighbours fit, and every other segmentation of a short text has a pair that does not."""
    fst = s.Transducer(PATH)
    for text in ("▁there", "▁▁▁x", "thing", "▁aaaa"):
        valid = []

        def extend(at, last, ids, text=text, valid=valid):
            if at == len(text):
                valid.append(ids)
            for end in range(at + 1, len(text) + 1):
                i = fst.id_of.get(text[at:end])
                if i is not None and fst.fit(last, i):
                    extend(end, i, [*ids, i])
        extend(0, -1, [])
        assert valid == [fst.shortest_path(text)]


def test_unigram_shortest_path(tmp_path):
    """A unigram model: least total weight over all segmentations, with unknown and byte pieces."""
    from itertools import product

    from sentencepiece import sentencepiece_model_pb2 as pb
    m = pb.ModelProto()
    for piece, score, kind in [("<unk>", 0, 2), ("▁", -3, 1), ("a", -2, 1), ("b", -2.5, 1), ("ab", -3.1, 1), ("ba", -4.2, 1), ("aba", -5.5, 1), ("▁a", -2.2, 1)]:
        m.pieces.add(piece=piece, score=score, type=kind)
    m.trainer_spec.model_type = pb.TrainerSpec.UNIGRAM
    m.normalizer_spec.name, m.normalizer_spec.add_dummy_prefix, m.normalizer_spec.escape_whitespaces = "identity", True, True
    m.normalizer_spec.remove_extra_whitespaces = True
    path = tmp_path / "u.model"
    path.write_bytes(m.SerializeToString())
    fst = s.Transducer(str(path))
    import sentencepiece
    lib = sentencepiece.SentencePieceProcessor(model_file=str(path))
    for n in range(1, 6):
        for c in product("ab ", repeat=n):
            text = "".join(c)
            own, theirs = fst.encode(text).tolist(), lib.encode(text)
            weight = lambda ids: sum(-fst.score[i] for i in ids)
            assert abs(weight(own) - weight(theirs)) < 1e-4, text
    assert fst.encode("axxa").tolist() == lib.encode("axxa")


def test_frame(spark):
    rows = [(1, "hello  world", "x"), (2, None, "y"), (2, "", "z"), (None, "hello  world", "x"), (3, "é☃" * 20_000, "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = s.tokenize(df, PATH)
    assert out.columns == ["doc_id", "text", "ids", "ids_"]
    back = out.withColumn("t", s.decode_column(PATH, out["ids_"])).collect()
    assert sorted((r.t, r.text or "") for r in back) == sorted((r[1] or "", r[1] or "") for r in rows)
    assert s.tokenize(df.limit(0), PATH).count() == 0
