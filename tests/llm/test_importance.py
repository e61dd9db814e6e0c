import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from flowmart.llm import importance


def brute(docs, target, percent, least, buckets, low, high, seed):
    def feats(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return len(w), [" ".join(w[i:i + n]) for n in range(low, high + 1) for i in range(len(w) - n + 1)]

    def counts(texts):
        out = [0] * buckets
        for t in texts:
            for f in feats(t)[1]:
                out[zlib.crc32(f.encode()) % buckets] += 1
        return out

    s, t = counts(x for _, x in docs), counts(target)
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    rows = []
    for i, (k, text) in enumerate(docs):
        n, f = feats(text)
        w = sum(gain[zlib.crc32(x.encode()) % buckets] for x in f)
        h = int(hashlib.sha256(f"{seed}:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        rows.append((k, n, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fits = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = fits[:len(fits) * percent // 100]
    return sorted((r[0] is None, r[0] or 0, r[2], r[3], r[4]) for r in rows), [(r[0], r[4], i) for i, r in enumerate(drawn, 1)]


def texts(seed, n):
    rng = random.Random(seed)
    vocab = ["Apfel", "été", "the", "of", "42", "x", "日本", "naïve", "WORD", "a-b"]
    return [(i, None if i % 17 == 3 else "" if i % 17 == 5 else rng.choice([" ", ", ", "\n"]).join(rng.choices(vocab, k=rng.randint(1, 30)))) for i in range(n)]


@pytest.mark.parametrize("low, high, percent", [(1, 1, 10), (1, 2, 35), (2, 3, 100), (1, 1, 0)])
def test_equals_plain_python(spark, make_docs, low, high, percent):
    docs = texts(low + high, 150) + [(None, "the of " * 12), (None, "the of " * 12), (7, "x " * 40), (7, "x " * 40), (8, "word " * 3000)]
    target = ["the the of été", None, "日本 of the x"]
    got = importance.resample(make_docs(docs), spark.createDataFrame([(t,) for t in target], "text string"), percent=percent, least_words=8, buckets=50, low=low, high=high)
    rows = got.collect()
    want, drawn = brute(docs, target, percent, 8, 50, low, high, 2024)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_features, r.weight, r.score) for r in rows) == want
    assert sorted(((r.doc_id, r.score, r["rank"]) for r in rows if r["rank"]), key=lambda r: r[2]) == drawn
    assert {r["rank"] for r in rows if r["rank"]} == set(range(1, len(drawn) + 1))


def test_cutoff_with_ties_takes_exactly_as_many(spark):
    table = spark.range(1000).select((F.col("id") % 3).alias("s"), (F.col("id") % 50).alias("k"), "id")
    order = [-F.col("s"), F.col("k"), F.col("id")]
    want = [r.id for r in table.orderBy(F.desc("s"), "k", "id").collect()]
    for need in (0, 1, 333, 334, 500, 999, 1000):
        taken = table.where(importance.cutoff(table, order, need))
        assert {r.id for r in taken.collect()} == set(want[:need])


def test_empty_tables(spark, make_docs):
    target = spark.createDataFrame([], "text string")
    assert importance.resample(make_docs([]), target).count() == 0
    row = importance.resample(make_docs([(1, "a " * 30)]), target, percent=100).first()
    assert (row.n_features, row["rank"]) == (30, 1)


def test_text_keys_are_refused(spark):
    docs = spark.createDataFrame([("a", "b")], "doc_id string, text string")
    with pytest.raises(TypeError):
        importance.resample(docs, docs)
