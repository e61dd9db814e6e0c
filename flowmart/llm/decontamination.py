"""Benchmark decontamination: windows of canonical templates, hash-joined, with a check that their slots agree."""

from __future__ import annotations

import functools
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F, types as T

from flowmart.llm.common import hash_map, map_has, small_batches, stored, text_batches

#: Tokens to a window, and how many of a template window's tokens must be literal.
WINDOW, LITERAL = 8, 4
#: Tokens of the shortest item that is searched for.
LEAST = 5
#: Kinds of windows: of plain tokens, of templates whose names stand within sentences, and of templates whose names may begin one.
PLAIN, WITHIN, ANYWHERE = 0, 1, 2
#: A document is contaminated by an item of which this part of the windows agrees in one alignment, or so many windows.
PART, ENOUGH = 0.5, 6
# Units of measure, currencies and spans of time that take a number.
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg lb lbs oz ton tons tonne tonnes ml cl l litre litres "
    "liter liters gallon gallons pint pints s sec secs second seconds min mins minute minutes h hr hrs hour hours day days week weeks "
    "month months year years hz khz mhz ghz v w kw mw kwh j kj cal kcal pa kpa bar k c f kph mph percent % $ € £ ¥ usd eur gbp dollar "
    "dollars cent cents euro euros pound pounds degree degrees"
).split()
NUMBER, NAME, UNIT = 1, 2, 3


@functools.cache
def _classes():
    """For each code point: 0 other, 1 letter or mark, 2 digit; and whether it is an upper-case letter."""
    import unicodedata

    import numpy as np

    kind, upper = np.zeros(0x110001, np.uint8), np.zeros(0x110001, bool)
    for c in range(0x110000):
        cat = unicodedata.category(chr(c))
        if cat[0] in "LM":
            kind[c] = 1
            upper[c] = cat in ("Lu", "Lt")
        elif cat == "Nd":
            kind[c] = 2
    for c in map(ord, "%$€£¥"):
        kind[c] = 3
    return kind, upper


def _powers(n: int):
    import numpy as np

    return np.concatenate([[np.uint64(1)], np.cumprod(np.full(max(0, n - 1), 0x9E3779B97F4A7C15, np.uint64))])


@functools.cache
def _unit_hashes():
    import numpy as np

    return np.sort(np.concatenate([_tokens([u])[1][:1] for u in UNITS]))


def _tokens(pieces: list[str]):
    """(piece, hash of the lower-case token, is a number, begins upper-case, begins a sentence) of each token in order.

    A token is a run of letters, a number with its inner points and commas, or a sign of a unit.
    """
    import numpy as np

    kinds, uppers = _classes()
    text = "\n\n" + "\n\n".join(pieces) + "\n\n"
    points = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    kind = kinds[points]
    inner = np.flatnonzero((points == 46) | (points == 44))
    kind[inner[(kind[inner - 1] == 2) & (kind[inner + 1] == 2)]] = 2
    inside = kind > 0
    first = np.flatnonzero(inside & ((kind != np.roll(kind, 1)) | (kind == 3)))
    if not len(first):
        none = np.zeros(0, bool)
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), none, none, none
    low = text.lower()
    if len(low) != len(text):  # a few letters have a longer lower case
        low = "".join([c.lower()[0] for c in text])
    values = np.frombuffer(low.encode("utf-32-le", "replace"), "<u4").astype(np.uint64) + np.uint64(1)
    values[~inside | (points == 44)] = 0  # commas in thousands do not count
    place = np.arange(first[0], len(points)) - np.repeat(first, np.diff(np.append(first, len(points))))
    place[~inside[first[0]:]] = 0
    hashes = np.add.reduceat(values[first[0]:] * _powers(int(place.max()) + 1)[place], first - first[0])
    hashes = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    hashes ^= hashes >> np.uint64(32)
    # A sentence begins after . ! ? : or a line end, with nothing but signs between.
    stops = np.cumsum(np.isin(points, [10, 46, 33, 63, 58, 0x3002]) & ~inside)
    begins = stops[first] > stops[np.concatenate([[0], first[:-1]])]
    begins[0] = True
    ends = np.cumsum([2 + len(p) for p in pieces])
    return np.searchsorted(ends, first - 2, side="right"), hashes, kind[first] == 2, uppers[points[first]], begins


def _templates(owner, hashes, number, upper, begins):
    """For either kind of template: (kind, owners, values, canonical values, slots) of its tokens.

    Numbers, units beside a number and runs of names are slots; a run is one token, so that a name of two words can stand for one of
    one. A capital at a sentence's start may or may not be a name, which makes the two kinds. Runs end with their sentence.
    """
    import numpy as np

    unit = np.isin(hashes, _unit_hashes())
    beside = np.zeros(len(hashes), bool)
    beside[1:] |= number[:-1]
    beside[:-1] |= number[1:]
    beside &= unit
    fresh = begins.copy()  # a run begins anew here
    fresh[1:] |= owner[1:] != owner[:-1]
    fresh[:1] = True
    for kind in (WITHIN, ANYWHERE):
        name = upper & ~number & ~beside if kind == ANYWHERE else upper & ~begins & ~number & ~beside
        ahead = np.concatenate([[False], name[:-1]]) & ~fresh
        held = np.flatnonzero(~(name & ahead))
        if not len(held):
            continue
        place = np.arange(len(hashes)) - np.repeat(held, np.diff(np.append(held, len(hashes))))
        values = np.add.reduceat(hashes * (np.uint64(2) * place.astype(np.uint64) + np.uint64(1)), held)
        slot = np.where(number[held], NUMBER, np.where(beside[held], UNIT, np.where(name[held], NAME, 0))).astype(np.uint8)
        yield kind, owner[held], values, np.where(slot > 0, slot.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93), values), slot


def _roll(values, start, size: int):
    """The hash of the ``size`` values from each start."""
    import numpy as np

    total = np.full(len(start), size, np.uint64)
    for k in range(size):
        total = total * np.uint64(0x100000001B3) + values[start + k]
        total ^= total >> np.uint64(31)
    total *= np.uint64(0x94D049BB133111EB)
    return total ^ (total >> np.uint64(30))


def _rows(batches: Iterator, sizes: list[int], literal: int, sent) -> Iterator:
    """Window rows of one task's texts, for every size in ``sizes``.

    With the map of a benchmark in ``sent`` only windows that may be the benchmark's are handed on. Without one a text gives
    windows of the largest size that it has tokens for.
    """
    import numpy as np
    import pyarrow as pa

    known = sent.value if sent is not None else None
    for batch in batches:
        ids = batch.column(0)
        parts = [(np.array(own, np.int64), _tokens(pieces)) for own, pieces in text_batches(batch.column(1).to_pylist())]
        if not parts:
            continue
        owner = np.concatenate([own[t[0]] for own, t in parts])
        hashes, number, upper, begins = (np.concatenate([t[k] for _, t in parts]) for k in range(1, 5))
        none = np.zeros(len(owner), np.uint8)
        for kind, own, values, canon, slot in [(PLAIN, owner, hashes, hashes, none), *_templates(owner, hashes, number, upper, begins)]:
            filled = np.concatenate([[0], np.cumsum(slot > 0)])
            count = np.bincount(own, minlength=len(ids))
            first = np.concatenate([[0], np.cumsum(count)[:-1]])
            within = np.arange(len(own)) - first[own]
            for size in sizes:
                fits = within + size <= count[own]
                if known is None and size < max(sizes):
                    fits &= count[own] == size
                begin = np.flatnonzero(fits)
                if kind != PLAIN:
                    used = filled[begin + size] - filled[begin]
                    begin = begin[size - used >= min(literal, size - 1)]
                value = _roll(canon, begin, size) ^ np.uint64(kind)
                if known is not None:
                    may = map_has(known, value)
                    begin, value = begin[may], value[may]
                if not len(begin):
                    continue
                taken = [[] if kind == PLAIN else values[s:s + size][slot[s:s + size] > 0].view(np.int64).tolist() for s in begin]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(own[begin])), pa.array(within[begin], pa.int32()), pa.array(np.full(len(begin), size, np.int32)),
                        pa.array(np.full(len(begin), kind, np.int32)), pa.array(value.view(np.int64)), pa.array(taken, pa.list_(pa.int64())),
                    ],
                    names=["id", "pos", "size", "kind", "hash", "slots"],
                )


def windows(docs: DataFrame, key: str, text: str, sizes: list[int], literal: int = LITERAL, sent=None) -> DataFrame:
    """(id, pos, size, kind, hash, slots): windows of plain tokens, and of both templates where they have enough literals."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text")).where("text is not null")
    schema = T.StructType([rows.schema["id"], *T.StructType.fromDDL("pos int, size int, kind int, hash long, slots array<long>")])
    return rows.mapInArrow(lambda it: _rows(it, sizes, literal, sent), schema)


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, literal: int = LITERAL, part: float = PART, enough: int = ENOUGH,
                 key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document and benchmark item found in it: doc_id, item_id, start, windows, item_windows, exact.

    Texts become lower-case tokens; numbers, units beside a number and runs of names become typed placeholders. Templates come in two
    kinds, as a capital at a sentence's start is a name or is none. Windows of ``window`` tokens, plain and of either kind, meet by their
    hash. Matches of a document and an item in one kind and at one distance of positions form an alignment; plain windows belong
    to alignments of their own. Template windows count only if their slots agree: the same value of the item
    always became the same value of the document and the other way round. A document has the item if one alignment
    has half (``part``) of the item's windows of that kind, or ``enough`` of them. ``exact`` tells that plain windows alone suffice.

    An item shorter than the window is one window of all its tokens; one of fewer than ``LEAST`` tokens is not searched
    for. Null texts have no windows; rows of one key (of any type) count as one document, as do rows without a key; repeated rows and
    items change nothing; empty tables give no rows; other columns are not read.
    """
    spark = docs.sparkSession
    sizes = list(range(LEAST, window + 1))
    bench = stored(windows(benchmark, item, item_text, sizes, literal).distinct())
    used = sorted(r["size"] for r in bench.select("size").distinct().collect())
    sent = spark.sparkContext.broadcast(hash_map(bench, "hash"))
    totals = bench.groupBy(F.col("id").alias("item_id"), "kind").agg(F.countDistinct("pos").alias("item_windows"))
    found = windows(docs, key, text, used or [window], literal, sent)
    there = bench.select(F.col("id").alias("item_id"), F.col("pos").alias("item_pos"), "kind", "hash", F.col("slots").alias("item_slots"))
    pairs = F.arrays_zip(F.col("item_slots").alias("i"), F.col("slots").alias("d"))
    # ``pos`` counts in the text of a row, so rows of one key meet only where they say the same.
    hits = found.join(there, ["hash", "kind"]).where(F.size("slots") == F.size("item_slots")).select(
        F.col("id").alias("doc_id"), "item_id", "kind", (F.col("pos") - F.col("item_pos")).alias("start"), "item_pos", pairs.alias("pairs")
    )
    lines = hits.groupBy("doc_id", "item_id", "kind", "start").agg(
        F.array_distinct(F.flatten(F.collect_list("pairs"))).alias("pairs"), F.count_distinct("item_pos").alias("windows")
    )
    size = F.size("pairs")
    agree = (size == F.size(F.array_distinct(F.col("pairs.i")))) & (size == F.size(F.array_distinct(F.col("pairs.d"))))
    need = F.least(F.lit(enough), F.ceil(F.col("item_windows") * part))
    judged = lines.where(agree).join(totals, ["item_id", "kind"]).where(F.col("windows") >= need)
    exact = F.col("kind") == PLAIN
    best = F.max(F.struct(exact.alias("exact"), "windows", (-F.col("start")).alias("back"), "item_windows"))
    return judged.groupBy("doc_id", "item_id").agg(best.alias("best")).select(
        "doc_id", "item_id", (-F.col("best.back")).alias("start"), F.col("best.windows").cast("long").alias("windows"), "best.item_windows", "best.exact"
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with all its columns, less the rows whose text has an item by :func:`contaminated`.

    Texts are judged, whatever their rows' keys: rows with a null key, or with one that others bear, go or stay by their own text. Texts are
    named by two 64-bit hashes. Rows with a null text stay.
    """
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    body = F.col(f"row.`{text}`")
    named = F.struct(F.xxhash64(body).alias("a"), F.xxhash64(F.lit(1), body).alias("b"))
    found = contaminated(rows.select(named.alias("id"), body.alias("text")), benchmark, key="id", text="text")
    bad = stored(found.select(F.col("doc_id.a").alias("a"), F.col("doc_id.b").alias("b")).distinct())
    named_rows = rows.select("row", named.alias("id"))
    return named_rows.join(bad, (F.col("id.a") == F.col("a")) & (F.col("id.b") == F.col("b")), "left_anti").select("row.*")
