import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from flowmart.llm import packing
from flowmart.llm.queries import tokenizer_path


def check(rows, got, window):
    tok = Tokenizer.from_file(tokenizer_path())
    ids = [tok.encode(t or "", add_special_tokens=False).ids + [2] for _, t in rows]
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for (key, _), want in zip(rows, ids):
        at = 0
        for r in sorted(pieces[key], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(want)
            part = np.array(want[at:at + r.length], "<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(part)
            at += r.length
        assert at == len(want)
    for held in sequences.values():
        at = 0
        for r in sorted(held, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    return [sum(r.length for r in h) for h in sequences.values()]


TEXTS = ["It's well-known: 3rd-rate, don't!", None, "", "Ünïcödé ÉÀ İstanbul ΟΔΟΣ ß", "İ, İ. ǆ. á, ª, º. ²,", "a\x1cb\x85c d e", "x<|endoftext|>y <|startoftext|>", "नमस्ते 世界 é Å",
         "word " * 3000, "\n\t ", "9 99 999 a1b2", "\U0001f600 smile", "end."]


def test_pieces_and_sequences(make_docs):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100 + i, f"short text number {i} " * (i % 17)) for i in range(200)]
    for window in (64, 4096):
        got = packing.pack(make_docs(rows).coalesce(1), tokenizer_path(), window=window).collect()
        sizes = check(rows, got, window)
        assert sum(s < window for s in sizes) <= 1


def test_ids_equal_the_tokenizer_on_real_texts(spark):
    import pyarrow.parquet as pq

    tok, ids = Tokenizer.from_file(tokenizer_path()), packing.encoder(tokenizer_path())
    for t in pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist() + TEXTS:
        assert np.frombuffer(ids(t or ""), "<u4").tolist() == tok.encode(t or "", add_special_tokens=False).ids


def test_least_sum_of_squares():
    p = packing.Packer(10, 0)
    seen = defaultdict(int)
    rnd = np.random.default_rng(2)
    for n in range(500):
        size = int(rnd.integers(1, 11))
        cost = {}
        for level in [0] + [h for h in range(1, 10) if seen[h] and h + size <= 10]:
            after = dict(seen)
            if level:
                after[level] -= 1
            if level + size < 10:
                after[level + size] = after.get(level + size, 0) + 1
            cost[level] = sum(v * v for v in after.values())
        before = p.count.copy()
        p.put(n, size)
        moved = p.count[1:10] - before[1:10]
        level = next((h for h in range(1, 10) if moved[h - 1] < 0), 0)
        assert cost[level] == min(cost.values())
        if level:
            seen[level] -= 1
        if level + size < 10:
            seen[level + size] += 1
        assert [p.count[h] for h in range(1, 10)] == [seen[h] for h in range(1, 10)]


def test_empty(make_docs):
    assert packing.pack(make_docs([]), tokenizer_path()).collect() == []
    got = packing.pack(make_docs([(None, "a"), (None, "a")]), tokenizer_path()).collect()
    assert len(got) == 2 and all(r.doc_id is None for r in got)
