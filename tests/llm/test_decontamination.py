import re

import pyarrow.parquet as pq
import pytest

from flowmart.llm import decontamination as dec

ITEM = "A train leaves Berlin at 14 and travels 120 km in 2 hours, then Maria waits until Maria gets 14 more tickets from Peter."
ITEMS = [(1, ITEM), (2, "short item of exactly six words"), (3, "too short"), (4, None), (5, ""), (6, "one literal phrase which the corpus never repeats anywhere at all today")]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(*x, "z") for x in ITEMS], "item_id long, text string, pos string")


def found(make_docs, items, rows):
    return {(r.doc_id, r.item_id): r for r in dec.contaminated(make_docs(rows), items).collect()}


def test_copies_templates_and_slots(make_docs, items):
    other = ITEM.replace("Berlin", "Paris").replace("14", "9").replace("120 km", "300 miles").replace("Maria", "Anna").replace("Peter", "Paul").replace(" 2 ", " 3,5 ")
    wrong = other.replace("Anna gets 9", "Julia gets 77")
    rows = [(1, "Intro text. " + ITEM + " And more."), (2, "Before that " + ITEM.upper()), (3, other), (4, wrong), (5, None), (6, ""), (7, "we saw a short item of exactly six words here"),
            (8, "filler words only " * 40_000 + ITEM), (9, "clean text about trains and tickets and Maria"), (10, ITEM[37:]), (3, other), (None, ITEM),
            (11, "too short"), (12, "one literal phrase which the corpus never repeats")]
    got = found(make_docs, items, rows)
    assert set(got) == {(1, 1), (2, 1), (3, 1), (7, 2), (8, 1), (10, 1), (None, 1)}
    assert got[1, 1].exact and not got[3, 1].exact and got[8, 1].start == 120_000


def test_slot_check_is_what_tells_apart(make_docs, spark):
    item = spark.createDataFrame([(1, "He gave 5 apples to Tom and then another 5 pears to Tom and kept the last 5 plums for Tom alone")], "item_id long, text string")
    same = "He gave 8 apples to Bob and then another 8 pears to Bob and kept the last 8 plums for Bob alone"
    mixed = "He gave 8 apples to Bob and then another 9 pears to Jim and kept the last 7 plums for Max alone"
    got = dec.contaminated(make_docs([(1, same), (2, mixed)]), item).collect()
    assert [r.doc_id for r in got] == [1]


def test_driver_documents_by_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    words = lambda t: re.findall(r"[^\W\d_]+", (t or "").lower())
    docs, bench = (pq.read_table(f"{sf}/{t}.parquet").to_pylist() for t in ("documents", "benchmark"))
    padded = [(d["doc_id"], f" {' '.join(words(d['text']))} ") for d in docs]
    want = {(d, b["item_id"]) for b in bench for w in [f" {' '.join(words(b['text']))} "] for d, t in padded if w in t}
    got = dec.contaminated(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")).collect()
    assert want and {(r.doc_id, r.item_id) for r in got} == want


def test_drop_and_empty(make_docs, items):
    docs = make_docs([(1, ITEM), (2, "clean"), (None, ITEM), (3, None)])
    left = dec.drop_contaminated(docs, items)
    assert left.columns == docs.columns and sorted(str(r.doc_id) for r in left.collect()) == ["2", "3"]
    assert dec.contaminated(make_docs([]), items).collect() == [] and dec.contaminated(docs, items.limit(0)).collect() == []


def test_long_texts_lose_no_window_at_a_cut(make_docs, items, monkeypatch):
    import pyarrow as pa

    text = "filler " * 50 + ITEM + " filler" * 50
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text])], names=["id", "text"])
    whole = [b.to_pylist() for b in dec._rows(iter([batch]), [8], 5, None)]
    monkeypatch.setattr(dec, "text_batches", lambda t: __import__("flowmart.llm.common", fromlist=["x"]).text_batches(t, 40))
    cut = [b.to_pylist() for b in dec._rows(iter([batch]), [8], 5, None)]
    plain = lambda rows: [(r["pos"], r["hash"]) for r in rows[0]]
    assert plain(whole) == plain(cut)


def test_names_at_sentence_starts_and_names_of_several_words(spark, make_docs):
    items = spark.createDataFrame([
        ("a", "Tom has 5 apples. Tom buys 3 more. Tom gives 2 to Ann. How many apples does Tom have now?"),
        ("b", "A train leaves Berlin at 14 and travels 120 km in 2 hours, then Maria waits until Maria gets 14 more tickets from Peter."),
    ], "item_id string, text string")
    rows = [
        (1, "So. Eve has 8 apples. Eve buys 6 more. Eve gives 4 to Sam. How many apples does Eve have now? Right."),
        (2, "A train leaves New York at 9 and travels 300 miles in 3 hours, then Anna Lee waits until Anna Lee gets 9 more tickets from Paul."),
        (3, "Eve has 8 apples. Bob buys 6 more. Max gives 4 to Sam. How many apples does Jim have now?"),
        (4, "Mary Ann Smith has 8 apples. Mary Ann Smith buys 6 more. Mary Ann Smith gives 4 to Sam. How many apples does Mary Ann Smith have now?"),
        (5, "Tom has a house. Tom buys bread and more. Tom gives it to Ann. How many people does Tom know now?"),
    ]
    got = {(r.doc_id, r.item_id): r.exact for r in dec.contaminated(make_docs(rows), items).collect()}
    assert got == {(1, "a"): False, (2, "b"): False, (4, "a"): False}


def test_generated_changes_of_names_and_numbers_are_found(spark, make_docs):
    import random

    rng = random.Random(2)
    nouns = "apples stones letters coins books cards shells stamps".split()
    verbs = "finds loses sells buys collects paints counts carries".split()
    names = ["Ann", "Bob", "Carla", "New York", "Dan Brown", "Eve", "Old Tom Bombadil", "Finn"]
    def story(steps, people, numbers):
        return " ".join(f"{people[p]} {v} {numbers[n]} {o} while the others only look at them." for p, v, n, o in steps)
    items, rows = [], []
    for i in range(25):
        steps = [(rng.randrange(2), rng.choice(verbs), k, rng.choice(nouns)) for k in range(3)]
        items.append((i, story(steps, rng.sample(names, 2), rng.sample(range(2, 99), 3))))
        rows.append((i, "Before it. " + story(steps, rng.sample(names, 2), rng.sample(range(2, 99), 3)) + " After it."))
    found = {(r.doc_id, r.item_id) for r in dec.contaminated(make_docs(rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert {(i, i) for i in range(25)} <= found


def test_rows_are_dropped_by_their_own_text(make_docs, items):
    docs = make_docs([(1, ITEM), (1, "clean"), (2, "clean"), (2, "clean"), (None, "clean"), (None, ITEM)])
    assert sorted((str(r.doc_id), r.text) for r in dec.drop_contaminated(docs, items).collect()) == [("1", "clean"), ("2", "clean"), ("2", "clean"), ("None", "clean")]
