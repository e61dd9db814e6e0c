import random

import numpy as np
import pytest

from flowmart.llm import suffix_dedup as sd


def brute(docs, window):
    """Per (key, text) in order: (bytes, removed, runs, kept)."""
    seen, out = {}, {}
    rows = sorted({(k is None, k or 0, (t or "")) for k, t in docs}, key=lambda r: r[:2])
    for none, k, t in rows:
        data = t.encode()
        gone = bytearray(len(data))
        for i in range(len(data) - window + 1):
            w = data[i:i + window]
            if w in seen:
                gone[i:i + window] = b"\1" * window
            else:
                seen[w] = True
        runs = sum(1 for i in range(len(data)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[(None if none else k, t)] = (len(data), sum(gone), runs, bytes(b for b, g in zip(data, gone) if not g))
    return out


def corpus(seed, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeé日", k=rng.randint(1, 7)))
    prose = lambda k: " ".join(word() for _ in range(k))
    shared = [prose(30) for _ in range(4)]
    docs = []
    for i in range(n):
        kind = i % 6
        text = prose(rng.randint(0, 60))
        if kind == 1:
            text = prose(10) + rng.choice(shared) + prose(12)
        elif kind == 2:
            text = docs[rng.randrange(len(docs))][1] or ""
        elif kind == 3:
            old = docs[rng.randrange(len(docs))][1] or ""
            text = old[:len(old) // 2] + "#" + old[len(old) // 2:]
        elif kind == 4:
            text = rng.choice(["a" * 400, "ab" * 200, shared[0] * 3, "", None])
        docs.append((i, text))
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("seed, hot", [(1, 4096), (2, 2), (3, 0)])
def test_equals_plain_python(spark, make_docs, seed, hot):
    docs = corpus(seed) + [(None, corpus(seed)[5][1]), (3, "x" * 150 + " other text"), (3, "x" * 150 + " other text")]
    docs = [(k, t) for k, t in docs if (k, t) == (3, "x" * 150 + " other text") or k != 3]
    got = sd.drop_repeats(make_docs(docs), hot=hot).collect()
    want = brute(docs, 100)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == sorted(
        (str(k), *want[(k, t or "")]) for k, t in docs)


def test_one_passage_in_very_many_documents(spark, make_docs):
    rng = random.Random(4)
    passage = "".join(rng.choices("abcdefgh ", k=260))
    docs = [(i, "".join(rng.choices("stuvwxyz ", k=50)) + passage + "".join(rng.choices("stuvwxyz ", k=50))) for i in range(300)]
    got = sd.drop_repeats(make_docs(docs), hot=64).collect()
    want = brute(docs, 100)
    assert {(r.doc_id, r.n_removed, r.n_spans) for r in got} == {(k, *want[(k, t)][1:3]) for k, t in docs}


def test_blocks_and_long_texts(spark, make_docs, monkeypatch):
    rng = random.Random(9)
    long = "".join(rng.choices("abcdefghijkl \n", k=1_300_000))
    docs = [(1, long), (2, "zz" + long[1_048_000:1_049_400] + "yy"), (3, None)]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in sd.drop_repeats(make_docs(docs)).collect()}
    assert got == {1: (1_300_000, 0, 0), 2: (1404, 1400, 1), 3: (0, 0, 0)}


def test_suffixes_are_sorted_and_prefixes_right():
    rng = random.Random(2)
    for _ in range(30):
        strings = [bytes(rng.choices(range(1, 5), k=rng.randint(1, 40))) for _ in range(rng.randint(1, 12))]
        ends = np.cumsum([len(s) for s in strings])
        owner, length, common = sd.suffix_order(np.frombuffer(b"".join(strings), np.uint8), ends, 3)
        found = [(o, n) for o, n in zip(owner.tolist(), length.tolist()) if n]
        every = sorted((s[i:], k) for k, s in enumerate(strings) for i in range(len(s)))
        assert found == [(k, len(s)) for s, k in every if len(s) >= 3]
        both = [b"", *[s for s, _ in every]]
        shared = [min(3, next((i for i, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y)))) for x, y in zip(both, both[1:])]
        assert common.tolist()[len(strings):] == shared


def test_numbers_keep_windows_apart():
    rng = random.Random(6)
    held, at = [], []
    for _ in range(400):
        anchor = bytes(rng.choices(b"xy", k=4)) * 12
        left = rng.randint(0, 52)
        held.append(bytes(rng.choices(b"ab", k=left)) + anchor + bytes(rng.choices(b"ab", k=52 - left)))
        at.append(left)
    strings, width = sd.numbered(held, at, 48)
    assert width == 2 and {len(s) for s in strings} == {54} and all(0 not in s for s in strings)
    assert len({(h, i) for h, i in zip(held, at)}) == len(set(strings))


def test_pieces_hold_every_window_once():
    rng = random.Random(3)
    texts = ["".join(rng.choices("ab c", k=k)).encode() for k in (0, 5, 99, 100, 101, 700, 0, 320)]
    data = b"".join(texts)
    starts, sizes, ids, spots = sd.pieces_of(np.frombuffer(data, np.uint8), np.cumsum([len(t) for t in texts]))
    assert ((spots >= starts + sizes - 1) & (spots + 48 <= starts + 100)).all()
    assert len({(i, data[p:p + 48]) for i, p in zip(ids.tolist(), spots.tolist())}) == len(set(ids.tolist()))
    covered = [s + i for s, n in zip(starts.tolist(), sizes.tolist()) for i in range(n)]
    base, want = 0, []
    for t in texts:
        want += range(base, base + max(0, len(t) - 99))
        base += len(t)
    assert covered == want and sizes.max() <= 53


def test_empty_table(spark, make_docs):
    assert sd.drop_repeats(make_docs([])).count() == 0


def literal(docs, window=100):
    """(key, bytes, removed, runs, kept) of each row: only a smaller key, or an earlier start in the row itself, takes anything."""
    key = lambda k: (k is None, k or 0)
    windows = [[t.encode()[i:i + window] for i in range(len(t.encode()) - window + 1)] for _, t in docs]
    least = {}
    for (k, _), own in zip(docs, windows):
        for w in own:
            least[w] = min(least.get(w, key(k)), key(k))
    out = []
    for (k, t), own in zip(docs, windows):
        data, seen = t.encode(), set()
        gone = bytearray(len(data))
        for i, w in enumerate(own):
            if least[w] < key(k) or w in seen:
                gone[i:i + window] = b"\1" * window
            seen.add(w)
        runs = sum(1 for i in range(len(data)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((str(k), len(data), sum(gone), runs, bytes(b for b, g in zip(data, gone) if not g)))
    return sorted(out)


@pytest.mark.parametrize("hot", [4096, 2, 0])
def test_rows_that_repeat_a_key_lose_nothing_to_each_other(spark, make_docs, hot):
    rng = random.Random(12)
    base = "".join(rng.choices("abcdefg ", k=900))
    docs = []
    for i in range(60):
        at = rng.randrange(700)
        part = base[at:at + rng.randint(90, 300)]
        text = part[:rng.randint(0, 200)] + rng.choice(["", "#", "##"]) + part + rng.choice(["", base[at:at + 150]])
        docs.append((rng.choice([None, 1, 2, 3, i + 4, i + 4]), text))
    docs += docs[:20]
    got = sd.drop_repeats(make_docs(docs), hot=hot).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == literal(docs)


def test_windows_around_sorted_tails():
    rng = random.Random(5)
    for _ in range(40):
        strings, at = [], []
        for _ in range(rng.randint(1, 25)):
            at.append(rng.randint(0, 6))
            number = bytes([249 + rng.randrange(2)])
            strings.append(bytes(rng.choices(b"ab", k=at[-1])) + number + bytes(rng.choices(b"ab", k=rng.randint(6 - at[-1], 6))))
        document = np.sort(rng.choices(range(8), k=len(strings)))
        row = np.cumsum(np.concatenate([[0], (np.diff(document) > 0) | (np.array(rng.choices([0, 1], k=len(strings) - 1)) > 0)])) if len(strings) > 1 else document
        start = np.arange(len(strings)) * 10
        who, offset = sd.later_windows(strings, at, 7, document, row, start)
        places = [(k, i) for k, s in enumerate(strings) for i in range(min(at[k], len(s) - 7) + 1)]
        text = {p: strings[p[0]][p[1]:p[1] + 7] for p in places}
        want = [(k, i) for k, i in places if any(
            text[k, i] == text[q] and (document[q[0]] < document[k] or row[q[0]] == row[k] and start[q[0]] + q[1] < start[k] + i) for q in places)]
        assert list(zip(who.tolist(), offset.tolist())) == want
