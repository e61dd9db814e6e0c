import random

from flowmart.llm import language

WORDS = {"en": "the of and that with thing nation other this there".split(), "de": "der die und nicht schön über keit ung sich ein".split(),
         "fr": "le la que être où çà les pour avec dans".split()}


def text(lang, n, seed=0):
    rnd = random.Random(f"{lang}{seed}")
    return " ".join(rnd.choices(WORDS[lang], k=n))


def training(make_docs):
    return make_docs([(i, text(lang, 200, i), lang) for i, lang in enumerate(["en", "de", "fr"] * 8)] + [(90, None, "en"), (91, "text without language", None)])


def test_mixtures(make_docs):
    model = language.fit(training(make_docs))
    assert model[0] == ["de", "en", "fr"]
    rows = [(1, text("de", 50, 99)), (2, text("fr", 40, 9) + " " + text("en", 60, 8)), (3, None), (4, ""), (5, "123 %% !"), (6, "THE"), (7, text("en", 90_000)),
            (7, text("de", 50, 99)), (None, text("fr", 9))]
    got = {(r.doc_id, r.lang_pred): r for r in language.predict(make_docs(rows), model).collect()}
    assert set(got) == {(1, "de"), (2, "en"), (3, "und"), (4, "und"), (5, "und"), (6, "en"), (7, "en"), (7, "de"), (None, "fr")}
    assert got[1, "de"].score == 1 and [x.lang for x in got[1, "de"].languages] == ["de"]
    mixed = got[2, "en"]
    assert [x.lang for x in mixed.languages] == ["en", "fr"] and abs(mixed.score - 0.6) < 0.05
    assert got[3, "und"].score == 0 and got[3, "und"].languages == []


def test_nothing_learned(make_docs):
    model = language.fit(make_docs([]))
    assert [(r.lang_pred, r.score) for r in language.predict(make_docs([(1, "some text"), (2, None)]), model).collect()] == [("und", 0.0)] * 2


def test_keep_known(make_docs):
    docs = training(make_docs).unionByName(make_docs([(200, "42 ..."), (201, text("de", 30, 5), None)]))
    left = language.keep_known(docs)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == set(range(24)) | {91, 201}
    assert language.keep_known(make_docs([])).collect() == []


def test_long_text_is_counted_whole():
    from flowmart.llm.common import text_batches

    long = "ab cd  " * 5000
    runs = list(text_batches(["x", long, None], most=1000))
    assert max(sum(map(len, p)) for _, p in runs) < 2002
    assert "".join(p for own, ps in runs for o, p in zip(own, ps) if o == 1) == long
    assert all(not (a[-1].isalpha() and b[0].isalpha()) for (_, (*_, a)), (_, (b, *_)) in zip(runs[1:-1], runs[2:-1]))


def test_held_out_accuracy(spark):
    from pyspark.sql import functions as F

    from flowmart.llm.queries import op1

    sf = "/root/testdata/sf0.01"
    found = op1(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out and lang is not null")
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97


def test_marks_without_a_letter_are_no_language(spark, make_docs):
    docs = [(i, "the and of with house", "en") for i in range(9)] + [(20 + i, "der und das mit haus", "de") for i in range(9)]
    model = language.fit(make_docs(docs))
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(make_docs([(1, "\u0301 12 \u0308\u0301 3"), (2, "the\u0301 house \u0301"), (3, "12 ...")]), model).collect()}
    assert got[1] == ("und", 0.0) and got[3] == ("und", 0.0) and got[2][0] == "en"


def test_documents_in_three_languages_stay(spark, make_docs):
    import random

    rng = random.Random(3)
    vocab = {lang: ["".join(rng.choices(letters, k=5)) for _ in range(60)] for lang, letters in (("aa", "abcdef"), ("bb", "ghijkl"), ("cc", "mnopqr"))}
    rows = [(i, " ".join(rng.choices(vocab[lang], k=80)), lang) for i in range(30) for lang in [sorted(vocab)[i % 3]]]
    mixed = " ".join(rng.choices(vocab["aa"], k=40) + rng.choices(vocab["bb"], k=30) + rng.choices(vocab["cc"], k=30))
    left = language.keep_known(make_docs([*rows, (99, mixed, None), (100, "123", None), (101, None, None)]))
    assert {r.doc_id for r in left.collect()} == {*range(30), 99}


def test_mixtures_equal_plain_python_over_all_language_sets():
    """EM by hand, for every prefix of the languages by share, kept if its penalised likelihood is the best."""
    import math

    import numpy as np

    rng = np.random.default_rng(5)
    owner, rows = [], []
    for d in range(25):
        for _ in range(int(rng.integers(1, 60))):
            owner.append(d)
            rows.append(rng.normal(-10, 2, 4) + 6 * np.eye(4)[d % 4 if rng.random() < 0.7 else (d // 4) % 4])
    likely = np.array(rows, np.float32)
    known, got = language.mixtures(likely, np.array(owner), 26)
    assert known.tolist() == [True] * 25 + [False]
    for d in range(25):
        p = [[math.exp(v - max(r)) for v in r] for r in likely[np.array(owner) == d].astype(float).tolist()]

        def em(allowed):
            share = [1 / len(allowed) if j in allowed else 0.0 for j in range(4)]
            while True:
                new = [0.0] * 4
                for r in p:
                    total = sum(a * b for a, b in zip(r, share))
                    for j in range(4):
                        new[j] += r[j] * share[j] / total / len(p)
                moved = max(abs(a - b) for a, b in zip(new, share)) > language.CHANGE
                share = new
                if not moved:
                    return share, sum(math.log(sum(a * b for a, b in zip(r, share))) for r in p)
        order = sorted(range(4), key=lambda j: -em(range(4))[0][j])
        # One language alone is the best of all four; larger sets are prefixes of the order.
        best = max(((sum(math.log(max(r[j], 1e-300)) for r in p), [float(i == j) for i in range(4)]) for j in range(4)), key=lambda x: x[0])
        for k in range(2, 5):
            share, gain = em(order[:k])
            score = gain - 0.5 * math.log(max(len(p), 2)) * (k - 1)
            if score > best[0] + 1e-9:
                best = (score, share)
        assert np.abs(got[d] - best[1]).max() < 0.02
