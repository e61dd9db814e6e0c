"""Repeated passages: bytes covered by a string that starts earlier too, from Burrows-Wheeler transforms built column by column.

Windows are dealt out by their minimizer: of the anchors (short substrings) in a window the one with the smallest hash. Equal windows have
equal minimizers, so windows of one anchor can be judged apart from all others. Consecutive windows with one minimizer form a
piece. Pieces whose anchor occurs once are never sent anywhere. Equal pieces collapse to the earliest; the
distinct pieces of an anchor are sorted by their suffixes in a task, one symbol of every piece a round. There the anchor, which all windows
of a piece hold whole, is written as a short number; no suffix that starts behind it holds a window, so the rounds begin in front of it.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from flowmart.llm.common import hash_map, map_bits, map_has, small_batches, stored, stored_with_count

#: Bytes of a window that count as a repeat, and of an anchor.
WINDOW, ANCHOR = 100, 48
#: Symbols of anchors' numbers: the bytes that UTF-8 never has, plus one.
NUMBER_FROM, NUMBERS = 249, 7
#: Starts of windows that are hashed at once; their place is the low bits of the key that finds a minimizer.
PLACE_BITS = 16
#: Bytes of the pieces that are sorted together, and distinct pieces of one anchor from which windows are grouped by Spark instead.
COLLECTION, HOT = 256 << 10, 4096


def _anchor_hashes(data, anchor: int):
    """A 64-bit hash of the ``anchor`` bytes from each place, by doubling, from 8 bytes on if ``anchor`` is a multiple of 8."""
    import numpy as np

    turn, length = 0xD6E8FEB86659FD93, 1 if anchor % 8 else 8
    if length == 1:
        part = data.astype(np.uint64) + np.uint64(1)
    else:
        part = np.ndarray(len(data) - 7, "<u8", np.ascontiguousarray(data), strides=(1,)).astype(np.uint64)
        part ^= part >> np.uint64(32)
    part *= np.uint64(0x9E3779B97F4A7C15)
    part ^= part >> np.uint64(29)
    h, held = None, 0  # of the first ``held`` bytes
    places = len(data) - anchor + 1
    while True:
        if anchor & length:
            if h is None:
                h = part[:places].copy()
            else:
                h *= np.uint64(turn)
                h += part[held:held + places]
            held += length
        if 2 * length > anchor:
            break
        longer = part[:-length] * np.uint64(turn)
        longer += part[length:]
        part = longer
        turn, length = turn * turn % (1 << 64), 2 * length
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def _least(values, width: int):
    """The least of each ``width`` consecutive values."""
    import numpy as np

    step = 1
    while 2 * step <= width:
        values = np.minimum(values[:-step], values[step:])
        step *= 2
    rest = width - step
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def pieces_of(data, ends, window: int = WINDOW, anchor: int = ANCHOR):
    """(start, windows, anchor, anchor's start) of all pieces of texts that lie one after another in ``data`` and end at ``ends``.

    A piece is a run of window starts with one minimizer (of equal hashes the leftmost), so it has at most
    ``window - anchor + 1`` starts. Anchors are hashed anew, since minimizers alone crowd the low numbers.
    """
    import numpy as np

    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    place = np.uint64((1 << PLACE_BITS) - 1)
    begins = np.concatenate([[0], ends[:-1]]) if len(ends) else np.zeros(0, np.int64)
    out = []
    block = (1 << PLACE_BITS) - window
    numbers = np.arange(min(block + window, len(data)), dtype=np.uint64)
    beside = np.arange(window - 1)
    for at in range(0, len(data), block):
        part = data[at:at + block + window - 1]
        if len(part) < window:
            break
        h = _anchor_hashes(part, anchor)
        tagged = h & ~place
        tagged |= numbers[:len(h)]
        least = _least(tagged, window - anchor + 1)
        # Windows that leave their text do not count.
        first, last = np.searchsorted(ends, [at, at + len(part)], "right")
        stop = ends[first:last + 1] - at
        leaves = np.maximum(stop - window + 1, np.maximum(begins[first:last + 1] - at, 0))[:, None] + beside
        least[leaves[leaves < np.minimum(stop, len(least))[:, None]]] = none
        cuts = np.flatnonzero(least[1:] != least[:-1]) + 1
        starts = np.concatenate([[0], cuts])
        sizes = np.diff(np.concatenate([starts, [len(least)]]))
        good = least[starts] != none
        starts, sizes = starts[good], sizes[good]
        spots = (least[starts] & place).astype(np.int64)
        ids = h[spots]
        ids = (ids ^ (ids >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
        ids ^= ids >> np.uint64(28)
        ids *= np.uint64(0xC2B2AE3D27D4EB4F)
        out.append((starts + at, sizes, ids, spots + at))
    if not out:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64), none
    return tuple(np.concatenate(c) for c in zip(*out))


def _bytes_of(column):
    """(all bytes, end of each text) of a string column; null counts as empty."""
    import numpy as np
    import pyarrow as pa

    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return whole, ends[1:] - ends[0]


def _count_anchors(batches: Iterator, window: int, anchor: int) -> Iterator:
    """(anchor, n) for each batch."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        ids, n = np.unique(pieces_of(*_bytes_of(batch.column(0)), window, anchor)[2], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(ids.view(np.int64)), pa.array(n)], names=["anchor", "n"])


#: One number for a piece by its anchor, its text's hash and its start, here and in ``_place_of``.
PLACE = "anchor ^ source ^ shiftleft(start, 40)"


def _place_of(anchors, sources, starts):
    import numpy as np

    return anchors ^ sources ^ (starts.astype(np.uint64) << np.uint64(40))


def _shared_pieces(batches: Iterator, often, window: int, anchor: int) -> Iterator:
    """(anchor, high, low, doc_id, source, start, windows, again) of the pieces of (doc_id, source, text) rows whose anchor may occur more than once.

    ``high`` and ``low`` are the digest, ``again`` says that the same row holds an equal piece further left.
    """
    import numpy as np
    import pyarrow as pa
    import xxhash

    for batch in batches:
        data, ends = _bytes_of(batch.column(2))
        starts, sizes, ids, _ = pieces_of(data, ends, window, anchor)
        keep = map_has(often.value, ids)
        starts, sizes, ids = starts[keep], sizes[keep], ids[keep]
        doc, source, local = _owners(batch, ends, starts)
        raw = memoryview(data)
        digests = [xxhash.xxh3_128_digest(raw[i:j]) for i, j in zip(starts.tolist(), (starts + sizes + window - 1).tolist())]
        high, low = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2).T.copy()
        order = np.lexsort((low, high, doc))
        again = np.zeros(len(doc), bool)
        again[order[1:]] = np.logical_and.reduce([x[order[1:]] == x[order[:-1]] for x in (low, high, doc)])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ids.view(np.int64)), pa.array(high), pa.array(low), batch.column(0).take(pa.array(doc)), pa.array(source), pa.array(local),
                pa.array(sizes), pa.array(again),
            ],
            names=["anchor", "high", "low", "doc_id", "source", "start", "windows", "again"],
        )


def _owners(batch, ends, starts):
    """(row, its text's hash, start within the text) for each start in the batch's bytes."""
    import numpy as np

    doc = np.searchsorted(ends, starts, "right")
    begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    return doc, batch.column(1).to_numpy(zero_copy_only=False)[doc], starts - begins[doc]


def _wanted_pieces(batches: Iterator, anchors, places, window: int, anchor: int) -> Iterator:
    """(anchor, held, at, doc_id, source, start): the bytes of the pieces that may be in both maps, and where in them the anchor begins."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        data, ends = _bytes_of(batch.column(2))
        found = pieces_of(data, ends, window, anchor)
        keep = map_has(anchors.value, found[2])
        starts, sizes, ids, spots = (x[keep] for x in found)
        doc, source, local = _owners(batch, ends, starts)
        keep = map_has(places.value, _place_of(ids, source.view(np.uint64), local))
        raw = memoryview(data)
        held = [bytes(raw[i:j]) for i, j in zip(starts[keep].tolist(), (starts + sizes + window - 1)[keep].tolist())]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ids[keep].view(np.int64)), pa.array(held, pa.binary()), pa.array((spots - starts)[keep].astype(np.int32)),
                batch.column(0).take(pa.array(doc[keep])), pa.array(source[keep]), pa.array(local[keep]),
            ],
            names=["anchor", "held", "at", "doc_id", "source", "start"],
        )


def suffix_order(flat, ends, most: int, tails=None):
    """(owner, length, common prefix) of every suffix of several strings, sorted, but only of suffixes of ``most`` or more symbols.

    ``flat`` holds the strings' symbols, each from 1 to 255, one string after another; common prefixes with the suffix before are counted up to
    ``most``. Of equal suffixes that of the earlier string is first. All strings grow by one symbol a round, from their last to their first.
    The transform holds, for each sorted suffix, the symbol in front of it, or 0 at a string's start. Sorting the transform itself
    by symbol, stably, gives the places of the suffixes that the next symbols begin. Transform and prefixes are rewritten in order each
    round: old entries keep their order, new ones are merged in.

    Strings may have tails that are sorted already: ``tails`` has the tails' lengths and their common prefixes, up to ``most``, with the tail before;
    the strings come in their tails' order, without the tails. No suffix then starts within a tail; a tail counts as smaller than any symbol.
    """
    import numpy as np

    m = len(ends)
    sizes = np.diff(np.concatenate([[0], ends]))
    transform = np.where(sizes > 0, np.append(flat, np.uint8(0))[ends - 1], 0).astype(np.uint8)
    kind = np.uint8 if most < 256 else np.uint16
    tail, common = np.zeros((2, m), np.int64) if tails is None else tails
    common = common.astype(kind)
    doc, spot = np.arange(m), np.arange(m)  # strings that may grow, by their place in the order
    for taken in range(1, int(sizes.max()) + 1):
        symbol = transform[spot]
        going = symbol > 0
        doc, spot, symbol = doc[going], spot[going], symbol[going]
        order = np.argsort(transform, kind="stable")
        done = len(transform) - int(np.count_nonzero(transform))
        fresh = np.zeros(len(transform), bool)
        fresh[spot] = True
        spot = np.flatnonzero(fresh[order]) - done + m
        doc = doc[np.argsort(symbol, kind="stable")]
        size = m + len(order) - done
        old = np.ones(size, bool)
        old[spot] = False
        grown, prefix = np.empty(size, np.uint8), np.empty(size, kind)
        grown[old], prefix[old] = transform, common
        more = sizes[doc] > taken
        grown[spot] = np.where(more, flat[np.where(more, ends[doc] - taken - 1, 0)], 0)
        # A new suffix shares with the one before it, and the one after it with the new one, one symbol more than what follows them.
        touched = np.zeros(size + 1, bool)
        touched[spot] = touched[spot + 1] = True
        at = np.flatnonzero(touched[:size])
        at = at[at >= m]
        here = order[at - m + done]
        before = order[np.maximum(at - m + done - 1, 0)]
        same = (at > m) & (transform[here] == transform[before])
        prefix[at] = 0
        at, low, high = at[same], before[same] + 1, here[same] + 1
        by = np.argsort(low, kind="stable")
        ranges = np.empty(2 * len(at), np.int64)
        ranges[::2], ranges[1::2] = low[by], high[by]
        if len(at):
            prefix[at[by]] = np.minimum(np.minimum.reduceat(np.append(common, 0), ranges)[::2], most - 1) + 1
        transform, common = grown, prefix
    owner, length = np.full(len(transform), -1, np.int32), np.zeros(len(transform), np.int32)
    order = np.argsort(transform, kind="stable")
    done = len(transform) - int(np.count_nonzero(transform))
    after = np.empty(len(order), np.int64)
    after[order] = np.arange(len(order)) + (m - done)
    doc, spot = np.arange(m), np.arange(m)
    for taken in range(int(sizes.max()) + 1):
        if taken:
            going = transform[spot] > 0
            doc, spot = doc[going], after[spot[going]]
        size = tail[doc] + taken
        whole = size >= most
        owner[spot[whole]], length[spot[whole]] = doc[whole], size[whole]
    return owner, length, common


def numbered(held: list[bytes], at: list[int], anchor: int) -> tuple[list[bytes], int]:
    """The pieces with every byte raised by one and the anchor in them replaced by its number, and the number's length.

    Equal numbers stand for equal bytes. Numbers have symbols that no text has, so equal strings have their anchors at one place.
    """
    numbers: dict[bytes, int] = {}
    which = [numbers.setdefault(h[i:i + anchor], len(numbers)) for h, i in zip(held, at)]
    width = 1
    while NUMBERS**width < len(numbers):
        width += 1
    codes = [bytes(NUMBER_FROM + k // NUMBERS**j % NUMBERS for j in range(width)) for k in range(len(numbers))]
    up = bytes(min(255, b + 1) for b in range(256))
    return [h[:i].translate(up) + codes[k] + h[i + anchor:].translate(up) for h, i, k in zip(held, at, which)], width


def later_windows(strings: list[bytes], at: list[int], window: int, document, row, start):
    """(string, offset) of every window that equals one of an earlier document, or of the same row further left; no symbol is 0.

    Every window of a string starts at ``at`` or before it and ends behind it, and equal windows have it at one place, as with an anchor that starts
    there. So the strings' parts from ``at`` on are sorted once, and only the parts before grow by a symbol a round.
    ``document``, ``row`` and ``start`` have a number for each string: both numbers never fall from a string to the next, rows of
    one number are one row (or the same row twice), and strings of a row are in the order of their starts in it and share no window's start.
    """
    import numpy as np

    tails = [s[i:] for s, i in zip(strings, at)]
    order = sorted(range(len(strings)), key=tails.__getitem__)
    size = np.array([len(tails[k]) for k in order])
    padded = np.array([tails[k] for k in order], f"S{max(window, size.max())}").view(np.uint8).reshape(len(order), -1)
    equal = np.pad(padded[1:] == padded[:-1], ((1, 0), (0, 1)))
    shared = np.minimum(np.minimum(equal.argmin(1), size), window)
    shared[1:] = np.minimum(shared[1:], size[:-1])
    ends = np.cumsum([at[k] for k in order])
    flat = np.frombuffer(b"".join(strings[k][:at[k]] for k in order), np.uint8)
    owner, length, common = suffix_order(flat, ends, window, (size, shared))
    joined = common >= window
    member = joined.copy()
    member[:-1] |= joined[1:]
    run = np.cumsum(~joined)[member]
    own = np.array(order)[owner[member]]
    offset = np.array([len(s) for s in strings])[own] - length[member]
    if not len(run):
        return own, offset
    most = int(offset.max()) + 1
    run, rank = np.divmod(np.sort(run * (len(strings) * most) + own * most + offset), len(strings) * most)
    own, offset = np.divmod(rank, most)
    runs = run[1:] != run[:-1]

    def firsts(values, changes):
        begins = np.flatnonzero(np.concatenate([[True], changes]))
        return np.repeat(values[begins], np.diff(np.concatenate([begins, [len(values)]])))

    place = start[own] + offset
    late = document[own] > firsts(document[own], runs)
    late |= place > firsts(place, runs | (row[own][1:] != row[own][:-1]))
    rank = np.sort(rank[late])
    return np.divmod(rank, most)


def _sorted_spans(batches: Iterator, window: int, anchor: int, schema) -> Iterator:
    """The spans that the windows of pieces make which start earlier too; rows come by anchor, then in order."""
    import numpy as np
    import pyarrow as pa

    def judged(rows: pa.Table):
        at = rows["at"].to_pylist()
        strings, width = numbered(rows["held"].to_pylist(), at, anchor)
        key, source, start = rows["doc_id"].combine_chunks().dictionary_encode("encode").indices.to_numpy(), rows["source"].to_numpy(), rows["start"].to_numpy()
        other = key[1:] != key[:-1]
        document, row = (np.concatenate([[0], np.cumsum(x)]) for x in (other, other | (source[1:] != source[:-1])))
        who, offset = later_windows(strings, at, window - anchor + width, document, row, start)
        if not len(who):
            return
        cut = np.flatnonzero((who[1:] != who[:-1]) | (offset[1:] != offset[:-1] + 1)) + 1
        first, last = np.concatenate([[0], cut]), np.concatenate([cut, [len(who)]]) - 1
        of = rows.take(pa.array(who[first]))
        begin = of["start"].to_numpy() + offset[first]
        spans = pa.table([of["doc_id"], of["source"], pa.array(begin), pa.array(begin + offset[last] - offset[first] + window)], names=schema.names)
        yield from spans.combine_chunks().to_batches()

    held, size, last = [], 0, None
    for batch in batches:
        anchors = batch.column(0).to_numpy()
        bytes_up_to = np.cumsum(np.array(pa.compute.binary_length(batch.column(1))))
        at, base = 0, 0
        changes = np.flatnonzero(anchors[1:] != anchors[:-1]) + 1
        for cut in [0, *changes.tolist()]:
            if cut == 0 and last == anchors[0]:
                continue
            upto = int(bytes_up_to[cut - 1]) if cut else 0
            if size + upto - base >= COLLECTION:
                held.append(batch.slice(at, cut - at))
                yield from judged(pa.Table.from_batches(held))
                held, size, at, base = [], 0, cut, upto
        held.append(batch.slice(at))
        size += int(bytes_up_to[-1]) - base
        last = anchors[-1]
    if size:
        yield from judged(pa.Table.from_batches(held))


def _each_window(batches: Iterator, window: int) -> Iterator:
    """(digest, doc_id, source, start) of every window of each piece."""
    import pyarrow as pa
    import xxhash

    for batch in batches:
        which, digests, starts = [], [], []
        for i, (held, start) in enumerate(zip(batch.column("held").to_pylist(), batch.column("start").to_pylist())):
            n = len(held) - window + 1
            which += [i] * n
            digests += [xxhash.xxh3_128_digest(held[k:k + window]) for k in range(n)]
            starts += range(start, start + n)
        at = pa.array(which, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(digests, pa.binary()), batch.column("doc_id").take(at), batch.column("source").take(at), pa.array(starts, pa.int64())],
            names=["digest", "doc_id", "source", "start"],
        )


def _smaller(first: str) -> F.Column:
    """Whether the key ``first`` is before the row's; null is last."""
    return (F.col(first) < F.col("doc_id")) | (F.col("doc_id").isNull() & F.col(first).isNotNull())


def repeated_spans(texts: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, hot: int = HOT) -> DataFrame:
    """(doc_id, source, begin, end): spans, in bytes, that windows cover which start earlier too; spans may overlap.

    ``texts`` has doc_id, source (a 64-bit hash of the text) and text, and is read three times, its keys once more. No row of a key is before
    another of that key: they lose nothing to each other, and rows that agree in both columns have the same spans.
    """
    spark: SparkSession = texts.sparkSession
    small_batches(spark)
    key = f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, source long, start long"
    spans_schema = T.StructType([texts.schema["doc_id"], *T.StructType.fromDDL("source long, begin long, end long")])

    def mapped(rows: DataFrame, column: str):
        held, n = stored_with_count(rows.select(column))
        return spark.sparkContext.broadcast(hash_map(held, column, map_bits(n)))

    counted = texts.select("text").mapInArrow(lambda it: _count_anchors(it, window, anchor), "anchor long, n long")
    often = mapped(counted.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1"), "anchor")
    pieces = stored(texts.mapInArrow(
        lambda it: _shared_pieces(it, often, window, anchor), f"anchor long, high long, low long, {key}, windows long, again boolean"
    ))
    same = ["anchor", "high", "low"]
    leftmost = pieces.where(~F.col("again"))
    groups = stored(leftmost.groupBy(*same).agg(
        F.min("doc_id").alias("first"), F.min_by(F.expr(PLACE), "doc_id").alias("place"), F.count(F.lit(1)).alias("n")
    ))
    later = leftmost.join(groups.where("n > 1").select(*same, "first"), same).where(_smaller("first"))
    later = later.select("doc_id", "source", "start", "windows").unionByName(pieces.where("again").select("doc_id", "source", "start", "windows"))
    spans = later.select("doc_id", "source", F.col("start").alias("begin"), (F.col("start") + F.col("windows") + (window - 1)).alias("end"))
    # Anchors of several distinct pieces: their windows have to be compared, in one piece of a kind, or in each row of the first key.
    several = stored(groups.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1"))
    anchors = mapped(several, "anchor")
    kinds = groups.join(several, "anchor")
    leaders = kinds.where("place IS NOT NULL").select("place")  # null where all keys are
    repeated, n = stored_with_count(texts.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").select(F.col("doc_id").alias("key")))
    if n:
        twins = leftmost.join(repeated, F.col("doc_id").eqNullSafe(F.col("key")), "left_semi")
        leaders = leaders.unionByName(
            twins.join(kinds.select(*same, "first"), same).where(F.col("doc_id").eqNullSafe(F.col("first"))).select(F.expr(PLACE).alias("place"))
        )
    places = mapped(leaders, "place")
    distinct = stored(texts.mapInArrow(lambda it: _wanted_pieces(it, anchors, places, window, anchor), f"anchor long, held binary, at int, {key}"))
    crowded = several.where(F.col("kinds") > hot).select("anchor")
    common = distinct.join(crowded, "anchor", "left_anti").repartition("anchor").sortWithinPartitions(
        "anchor", F.asc_nulls_last("doc_id"), "source", "start"
    )
    spans = spans.unionByName(common.mapInArrow(lambda it: _sorted_spans(it, window, anchor, spans_schema), spans_schema))
    crowd = distinct.join(crowded, "anchor", "left_semi").select("held", "doc_id", "source", "start")
    each = stored(crowd.mapInArrow(lambda it: _each_window(it, window), f"digest binary, {key}"))
    own = stored(each.groupBy("digest", "doc_id", "source").agg(F.min("start").alias("left"), F.count(F.lit(1)).alias("n")))
    firsts = own.groupBy("digest").agg(F.min("doc_id").alias("first"), F.sum("n").alias("n")).where("n > 1").drop("n")
    elsewhere = each.join(firsts, "digest").where(_smaller("first"))
    within = own.where("n > 1").select(F.col("digest").alias("d"), F.col("doc_id").alias("k"), F.col("source").alias("s"), "left")
    there = (F.col("digest") == F.col("d")) & F.col("doc_id").eqNullSafe(F.col("k")) & (F.col("source") == F.col("s")) & (F.col("start") > F.col("left"))
    for found in elsewhere, each.join(within, there):
        spans = spans.unionByName(found.select("doc_id", "source", F.col("start").alias("begin"), (F.col("start") + window).alias("end")))
    return spans


def _cut_out(batches: Iterator) -> Iterator:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of (doc_id, text, spans)."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        out = []
        for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            data = text.encode()
            gone = np.zeros(len(data) + 1, np.int32)
            if spans:
                begin = np.array([s["begin"] for s in spans])
                end = np.array([s["end"] for s in spans])
                np.add.at(gone, begin, 1)
                np.add.at(gone, end, -1)
            covered = np.cumsum(gone)[:-1] > 0
            runs = int(covered[:1].sum() + (covered[1:] & ~covered[:-1]).sum())
            out.append((len(data), int(covered.sum()), runs, np.frombuffer(data, np.uint8)[~covered].tobytes()))
        columns = list(zip(*out)) or [()] * 4
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, [pa.int64()] * 3 + [pa.binary()]))],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def drop_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, anchor: int = ANCHOR, hot: int = HOT) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept (binary, the bytes that stay, joined).

    A byte goes if a string of ``window`` bytes covers it that also starts earlier: in a row with a smaller key (null keys are last), or further
    left in the same text. Strings are judged on the input; matches never cross documents; a null text is empty. Rows
    that repeat a key lose nothing to each other, since neither has the smaller key. Texts shorter than a window lose nothing; an empty table gives no rows; other columns are not read.

    ``docs`` is read five times, its keys once more: store it if it is costly. Only texts that may lose something are shuffled.
    """
    spark = docs.sparkSession
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    texts = docs.select(F.col(f"`{key}`").alias("doc_id"), F.xxhash64(whole).alias("source"), whole.alias("text"))
    spans = repeated_spans(texts, window, anchor, hot)
    listed, n = stored_with_count(
        spans.groupBy("doc_id", "source").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    )
    sent = spark.sparkContext.broadcast(hash_map(listed, "source", map_bits(n)))

    @F.arrow_udf(T.BooleanType())
    def maybe(source):
        import numpy as np
        import pyarrow as pa

        return pa.array(map_has(sent.value, source.to_numpy(zero_copy_only=False).view(np.uint64)))

    tagged = texts.withColumn("maybe", maybe("source"))
    data = F.col("text").cast("binary")
    whole_rows = tagged.where(~F.col("maybe")).select(
        "doc_id", F.length(data).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), data.alias("kept"),
    )
    there = listed.select(F.col("doc_id").alias("k"), F.col("source").alias("s"), "spans")
    cut = tagged.where("maybe").join(there, F.col("doc_id").eqNullSafe(F.col("k")) & (F.col("source") == F.col("s")), "left").select("doc_id", "text", "spans")
    kind = texts.schema["doc_id"].dataType.simpleString()
    return whole_rows.unionByName(cut.mapInArrow(_cut_out, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary"))
