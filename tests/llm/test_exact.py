import hashlib
from collections import Counter, defaultdict

import pytest

from flowmart.llm import exact


def plain(rows):
    groups = defaultdict(list)
    for key, text, *_ in rows:
        groups[(text or "").encode().lower()].append(key)
    return groups


ROWS = [(1, "Same Text"), (2, "same text"), (3, "SAME TEXT"), (4, "É"), (5, "é"), (6, None), (7, ""), (8, "x" * 50_000), (8, "x" * 50_000), (None, "lone"),
        (9, "pair"), (None, "pair"), (None, None)] + [(100 + i, "Hot row") for i in range(60)]


@pytest.mark.parametrize("counters", [2, 1024])
def test_groups(make_docs, counters):
    got = exact.duplicate_groups(make_docs(ROWS), counters=counters).collect()
    groups = plain(ROWS)
    want = Counter()
    for text, keys in groups.items():
        best = max((k for k in keys if k is not None), default=None)
        for k in keys:
            want[(k, best, len(keys), hashlib.sha256(text).hexdigest())] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


@pytest.mark.parametrize("counters", [2, 1024])
def test_drop_keeps_all_columns_and_one_of_each(make_docs, counters):
    docs = make_docs(ROWS)
    left = exact.drop_duplicates(docs, counters=counters)
    assert left.columns == docs.columns
    rows = left.collect()
    groups = plain(ROWS)
    assert sorted((r.text or "").lower() if (r.text or "").isascii() else r.text for r in rows) == sorted(
        k.decode() if k.isascii() else k.decode() for k in groups)
    for r in rows:
        keys = [k for k in groups[(r.text or "").encode().lower()] if k is not None]
        assert r.doc_id == max(keys, default=None) and r.row == "y"


def test_empty(make_docs):
    assert exact.duplicate_groups(make_docs([])).collect() == []
    assert exact.drop_duplicates(make_docs([])).collect() == []


def test_misra_gries_keeps_frequent():
    import pyarrow as pa

    values = [b"a"] * 500 + [bytes([i % 250, i // 250]) for i in range(500)]
    batches = [pa.RecordBatch.from_arrays([pa.array(values[i::4], pa.binary())], names=["digest"]) for i in range(4)]
    found = {d: n for b in exact._frequent(iter(batches), 10) for d, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist())}
    assert len(found) <= 10 and 500 - 1000 / 10 <= found[b"a"] <= 500
