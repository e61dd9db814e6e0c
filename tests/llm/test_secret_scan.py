import random

import pytest
from pyspark.sql import functions as F

from flowmart.llm import secret_scan as scan
from flowmart.llm.queries import tokenizer_path

RND = random.Random(4)
HEX = lambda n: "".join(RND.choices("0123456789abcdef", k=n))
KEY = lambda: "AKIA" + "".join(RND.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", k=16))


@pytest.fixture(scope="module")
def docs(spark):
    rows = []
    for i in range(60):
        rows += [(i, f"some words before {KEY()} and after"), (100 + i, f'then token = "{HEX(40)}" was set'), (200 + i, f"login password={HEX(18)} please"),
                 (300 + i, f"write to person.{i}name@mail{i % 9}.example.com or call"), (400 + i, f"see commit {HEX(40)} for details"),
                 (500 + i, f"host 10.20.{i}.254 port and card {RND.randrange(10**15, 10**16)} today")]
    rows += [(900, None), (901, ""), (902, "no candidate here"), (903, ("filler words " * 20_000) + KEY()), (None, f"x {KEY()} y"), (904, "é 🙂 " + KEY() + " " + KEY())]
    return spark.createDataFrame([(*r, "own") for r in rows], "doc_id long, text string, value string")


def test_findings(docs):
    got = scan.scan(docs, tokenizer_path()).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in got:
        assert texts[r.doc_id][r.start:r.start + r.length] == r.value and 0 <= r.score <= 1
    secret = {r.doc_id for r in got if r.secret}
    assert secret == {*range(60), *range(100, 160), *range(200, 260), 903, None, 904}
    assert sum(r.doc_id == 904 for r in got) == 2
    assert {r.doc_id for r in got if not r.secret} >= {*range(400, 460)}


def test_given_labels(spark, docs):
    found = scan.candidates(docs)
    labelled = found.withColumn("label", F.when(F.col("value").rlike("^[0-9a-f]{40}$"), 0.0).otherwise(1.0))
    got = scan.scan(docs, tokenizer_path(), labelled).collect()
    assert not any(r.secret for r in got if 100 <= (r.doc_id or 0) < 160 or 400 <= (r.doc_id or 0) < 460)


def test_native_empty_and_one_label(spark, docs):
    found = scan.scan(docs, tokenizer_path())
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan.replace("ArrowEval", "Arrow")
    assert scan.scan(docs.limit(0), tokenizer_path()).collect() == []
    few = scan.scan(docs.where("doc_id = 904"), tokenizer_path()).collect()
    assert len(few) == 2 and all(r.secret and r.score == 1 for r in few)


def test_assigned_values_of_any_length_and_signs(spark):
    texts = {
        1: ("login password: Tr0ub4dor please", "Tr0ub4dor"), 2: ('x password = "Tr0ub4dor" y', "Tr0ub4dor"), 3: ("password=correct-horse-battery-staple", "correct-horse-battery-staple"),
        4: ('pwd = "S3cr!t#Pass$word9"', "S3cr!t#Pass$word9"), 5: ('{"api_key": "a!b"}', "a!b"), 6: ("Secret: x9.", "x9"), 7: ("my_token => abc123", "abc123"),
    }
    docs = spark.createDataFrame([(k, t) for k, (t, _) in texts.items()] + [(20, "passwords are bad: use keys"), (21, "the key is here"), (22, "password:   ")], "doc_id long, text string")
    got = scan.candidates(docs).collect()
    assert {(r.doc_id, r.value) for r in got} == {(k, v) for k, (_, v) in texts.items()}
    assert all(texts[r.doc_id][0][r.start:r.start + len(r.value)] == r.value for r in got)


def test_candidates_equal_plain_python(spark):
    """Candidates by Python's own expressions, over generated texts."""
    import re

    rng = random.Random(8)
    part = lambda: rng.choice(["password", "pwd:", "= ", "x", " ", ", ", "token=", HEX(14), KEY(), "a/b.c9", '"', "é", "secret: ", "word", "!9#", "\n"])
    rows = [(i, "".join(part() for _ in range(rng.randint(1, 25)))) for i in range(300)]
    want = set()
    for k, t in rows:
        for m in re.finditer(scan.CANDIDATE, t):
            run, named = m[0], re.match(scan.NAMED, m[0])
            name = named[0] if named else (re.match(r"([A-Za-z_][A-Za-z0-9_.-]*[=:]+)(?=.{6,})", run) or [""])[0]
            value = re.sub(r"[.:=,;)\]}]+$", "", run[len(name):])
            if value and (named or len(value) >= 8 and re.search("[0-9]", value)):
                want.add((k, m.start() + len(name), value))
    got = {(r.doc_id, r.start, r.value) for r in scan.candidates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(want) > 100 and got == want


def test_words_after_a_credential_are_no_secrets(spark):
    rows = []
    for i in range(80):
        rows += [(i, f"login password: {HEX(6)}X{i}"), (100 + i, f"the key: {['remember', 'house', 'people', 'water'][i % 4]} and more"), (200 + i, f'token = "{HEX(24)}"'), (300 + i, f"see commit {HEX(40)}")]
    rows += [(400, "password=correct-horse-battery-staple"), (401, "the secret: nothing is lost")]
    got = scan.scan(spark.createDataFrame(rows, "doc_id long, text string"), tokenizer_path()).collect()
    secret = {r.doc_id for r in got if r.secret}
    assert secret >= {*range(80), *range(200, 280)} and not secret & {*range(100, 180), *range(300, 380)}
