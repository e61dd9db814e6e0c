import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from flowmart.llm import simhash
from flowmart.llm.components import components


def by_hand(text):
    words = re.findall("[^ \t\n\x0b\x0c\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(keyed):
    """(key, fingerprint) to the smallest key reachable, by all pairs."""
    parent = list(range(len(keyed)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(keyed)):
        for j in range(i):
            if (keyed[i][1] ^ keyed[j][1]).bit_count() <= 3:
                parent[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(keyed):
        if k is not None:
            least[find(i)] = min(k, least.get(find(i), k))
    return [least.get(find(i)) for i in range(len(keyed))]


TEXTS = [None, "", " \t", "One", "one", "Two words", "a b c", "A  b\tC", "É b c d", "é b c d", "x y z w " * 30_000]


def test_fingerprint():
    for t in TEXTS:
        assert simhash.fingerprint(t) == by_hand(t) or len(t or "") > 1000
    assert simhash.fingerprint("a b c d e f") == by_hand("a b c d e f")


def test_groups_equal_all_pairs(make_docs):
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    base = [rnd.choices(words, k=400) for _ in range(6)]
    rows = [(i, t) for i, t in enumerate(TEXTS[:-1])] + [(None, "lone null key"), (3, "one")]
    for n in range(70):
        copy = list(base[n % 6])
        for _ in range(n % 4):
            copy[rnd.randrange(400)] = rnd.choice(words)
        rows.append((50 + n, " ".join(copy)))
    got = simhash.near_duplicate_groups(make_docs(rows)).collect()
    want = roots([(k, by_hand(t)) for k, t in rows])
    assert sorted((str(k), f"{by_hand(t):016x}", str(r)) for (k, t), r in zip(rows, want)) == sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got)


def test_links_of_dense_and_random_fingerprints(spark):
    rnd = random.Random(5)
    center = rnd.getrandbits(64)
    prints = {rnd.getrandbits(64) for _ in range(200)} | {0, 1, 7, 2**64 - 1}
    for _ in range(300):  # a dense group, and chains that drift away from it
        bits = rnd.sample(range(64), rnd.randint(1, 5))
        prints.add(center ^ sum(1 << b for b in bits))
    prints = sorted(prints)
    signed = [p - 2**64 if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    label = {r.node: r.label for r in components(simhash.linked_fingerprints(df)).collect()}
    want = roots([(s, p) for s, p in zip(signed, prints)])
    groups = {}
    for s, w in zip(signed, want):
        groups.setdefault(w, set()).add(label.get(s, s))
    assert all(len(g) == 1 for g in groups.values()) and len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_ring_passes_every_close_pair(spark):
    rnd = random.Random(1)
    pairs = []
    for _ in range(400):
        a = rnd.getrandbits(64)
        b = a ^ sum(1 << i for i in rnd.sample(range(64), rnd.randint(0, 3)))
        pairs.append((a - 2**64 if a >> 63 else a, b - 2**64 if b >> 63 else b))
    df = spark.createDataFrame(pairs, "a long, b long")
    assert df.where(simhash.ring_start(F.col("a"), F.col("b")) < 0).count() == 0


def test_drop_and_empty(make_docs):
    long = " ".join(f"w{i}" for i in range(500))
    docs = make_docs([(5, long), (9, long + " end"), (7, "else entirely different text"), (7, "else entirely different text"), (None, long), (None, None)])
    left = simhash.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == ["5", "7", "None"]
    assert simhash.near_duplicate_groups(make_docs([])).collect() == [] and simhash.drop_near_duplicates(make_docs([])).collect() == []


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(7, 7), (None, 3), (1, 0)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}


@pytest.mark.parametrize("distance", [2, 4])
def test_other_distances_are_refused(spark, distance):
    with pytest.raises(ValueError):
        simhash.linked_fingerprints(spark.createDataFrame([], "fp long"), distance)


def test_rows_of_one_key_are_decided_apart(spark, make_docs):
    """Null keys, and keys that repeat with other texts: a row goes if a row with a smaller key is near, whatever else bears its key."""
    base = [" ".join(f"w{n}x{i}" for i in range(400)) for n in range(4)]
    rows = [(1, base[0]), (2, base[0] + " end"), (2, base[1]), (None, base[1]), (None, base[2]), (None, base[2]), (3, base[3]), (3, base[3])]
    for a, b in ((0, 1), (2, 3)):
        assert (simhash.fingerprint(rows[a][1]) ^ simhash.fingerprint(rows[b][1])).bit_count() <= 3
    left = simhash.drop_near_duplicates(make_docs(rows)).collect()
    assert sorted((str(r.doc_id), r.text) for r in left) == sorted([("1", base[0]), ("2", base[1]), ("None", base[2]), ("3", base[3])])
