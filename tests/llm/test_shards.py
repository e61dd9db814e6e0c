import zlib
from collections import defaultdict

from flowmart.llm import shards


def jump(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_place_equals_published_algorithm(make_docs):
    rows = [(i, f"text {i}") for i in range(300)] + [(-5, None), (2**63 - 1, ""), (-2**63, "ä"), (None, "no key"), (7, "text 7"), (8, "z" * 100_000)]
    got = shards.place(make_docs(rows), 8).collect()
    want = sorted((str(k), len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), jump((2**64 - 1 if k is None else k) % 2**64, 8),
                   jump((2**64 - 1 if k is None else k) % 2**64, 9)) for k, t in rows)
    assert sorted((str(r.doc_id), r.size, r.text_crc32, r.shard, r.grown_shard) for r in got) == want
    slots = defaultdict(list)
    for r in sorted(got, key=lambda r: (r.shard, r.slot)):
        slots[r.shard].append(r)
    for held in slots.values():
        assert [r.slot for r in held] == list(range(len(held)))
        order = [(r.doc_id is not None, r.doc_id or 0, r.size) for r in held]
        assert order == sorted(order)
    assert all(r.grown_shard in (r.shard, 8) and r.law == "key" for r in got)


def test_known_values_other_keys_and_counts(spark):
    df = spark.createDataFrame([(1,), (42,), (0xDEAD10CC,), (256,)], "k long")
    key = shards.stable_key(df, "k")
    assert [r[0] for r in df.select(shards.jump_hash(key, 1)).collect()] == [0] * 4
    assert [r[0] for r in df.select(shards.jump_hash(key, 666)).collect()] == [jump(k, 666) for k in (1, 42, 0xDEAD10CC, 256)]
    assert jump(42, 57) == 43 and jump(0xDEAD10CC, 666) == 361
    names = spark.createDataFrame([(f"n{i}",) for i in range(2000)], "k string")
    found = names.select(shards.jump_hash(shards.stable_key(names, "k"), 4).alias("s")).groupBy("s").count().collect()
    assert len(found) == 4 and all(400 < r["count"] < 600 for r in found)


def test_empty_and_native(make_docs):
    assert shards.place(make_docs([]), 8).collect() == []
    plan = shards.place(make_docs([(1, "a")]), 8)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
