"""Sum-of-squares packing of tokenised documents into windows of fixed length."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, functions as F

from flowmart.llm.common import small_batches

WINDOW, END = 4096, 2
#: Words, and as many pieces, whose ids a task remembers: twice so many entries at most, of about 200 bytes.
REMEMBERED = 1_000_000

_ENCODERS: dict[str, Callable] = {}
_MEMORIES: list[_Recent] = []


def forget() -> None:
    """Empty the memories of all encoders and hand unused memory back: workers live on from stage to stage."""
    import pyarrow as pa

    for memory in _MEMORIES:
        memory.clear()
        memory.older = {}
    pa.default_memory_pool().release_unused()


def encoder(path: str) -> Callable[[str], bytes]:
    """A function from a text to its ids as little-endian unsigned 32-bit numbers, equal to the tokenizer's own.

    Ids are remembered by word between blanks, which is exact because no token of a tokenizer that splits by a pattern
    without blanks spans one. A new word is cut by that pattern and only new pieces meet the tokenizer's model. That holds
    for printable Latin words; other words, words with the text of a special token, and tokenizers of another build go through the
    whole tokenizer.
    """
    if path in _ENCODERS:
        return _ENCODERS[path]
    import json
    import re
    from array import array

    import numpy as np
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)

    def full(text: str) -> bytes:
        return np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    pattern = _split_pattern(json.loads(whole.to_str()))
    if pattern is None:
        _ENCODERS[path] = full
        return full
    model = whole.model
    special = re.compile("|".join(re.escape(t.content) for t in whole.get_added_tokens_decoder().values()) or "(?!)").search
    odd = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
    blank = re.compile("[\t\n\x0b\x0c\r ]+")

    def piece_ids(text: str) -> bytes:
        known = text if text.isascii() else _byte_signs(text)
        return array("I", [t.id for t in model.tokenize(known)]).tobytes()

    pieces = _Recent(piece_ids)
    piece = pieces.__getitem__

    def word_ids(text: str) -> bytes:
        # A comma or point after a letter is a piece of its own.
        if text[-1] in ",." and text[-2:-1].lower().isalpha():
            return words[text[:-1]] + piece(text[-1])
        low = text.lower()
        latin = low.isascii() or max(low) < "\u0250"
        if not latin or not text.isprintable() or special(text):
            return full(text)
        if not low.isalpha():
            return b"".join(map(piece, pattern.findall(low)))
        return piece_ids(low) if low == text else words[low]  # a word is remembered once

    words = _Recent(word_ids)
    _MEMORIES.extend([pieces, words])

    def by_word(text: str) -> bytes:
        return b"".join(map(words.__getitem__, blank.split(text) if odd.search(text) else text.split()))

    _ENCODERS[path] = by_word
    return by_word


class _Recent(dict):
    """Results of a function by text. When full it becomes the older generation, from which texts in use come back."""

    def __init__(self, make: Callable[[str], bytes]) -> None:
        self.make, self.older = make, {}

    def __missing__(self, text: str) -> bytes:
        found = self.older.get(text)
        if found is None:
            found = self.make(text)
            if len(text) > 64:
                return found
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        self[text] = found
        return found


def _split_pattern(build: dict):
    """The pattern by which a tokenizer of the expected build cuts a text, else None.

    Expected are NFC, blanks made one, lower case; then matches of a pattern that has no blank, as signs for bytes.
    """
    import regex

    normal, pre = build["normalizer"] or {}, build["pre_tokenizer"] or {}
    steps = [s["type"] for s in normal.get("normalizers", [])]
    cuts = pre.get("pretokenizers", [])
    if steps != ["NFC", "Replace", "Lowercase"] or [c["type"] for c in cuts] != ["Split", "ByteLevel"]:
        return None
    split, signs = cuts
    plain = split["behavior"] == "Removed" and split["invert"] and not signs["add_prefix_space"] and not signs["use_regex"]
    pattern = regex.compile(split["pattern"].get("Regex", " "))
    return pattern if plain and not pattern.search(" \t\n") else None


def _byte_signs(text: str) -> str:
    """The signs that byte-level models read for a text's bytes."""
    from tokenizers import pre_tokenizers

    return pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(text)[0][0]


class Packer:
    """Windows under way in one task: for each fill level the windows at it, and how many in the level array.

    An item goes where the sum of the squared counts of partially filled windows grows least: into a window at level h, which
    takes one from level h and gives one to level h + size, or into a new window. Full windows are handed out at once.
    """

    def __init__(self, window: int, first: int) -> None:
        import numpy as np

        self.window, self.next = window, first
        self.count = np.zeros(window + 1, np.int64)
        self.open: list[list] = [[] for _ in range(window)]

    def put(self, doc, size: int) -> list | None:
        """Place (document, size); the window's items if that fills it."""
        import numpy as np

        last = self.window - size
        levels = np.flatnonzero(self.count[: last + 1])
        level, least = 0, 2 * self.count[size] + 1 if last else 0  # a new window
        if len(levels):
            held = self.count[levels]
            grows = 2 * (self.count[levels + size] - held) + 2  # from h to h + size
            if levels[-1] == last:
                grows[-1] = 1 - 2 * held[-1]  # a full window is no longer counted
            best = int(grows.argmin())
            level = int(levels[best]) if grows[best] < least else 0
        items = self.open[level].pop() if level else []
        self.count[level] -= level > 0
        items.append((doc, size))
        if level + size == self.window:
            return items
        self.open[level + size].append(items)
        self.count[level + size] += 1
        return None

    def rest(self) -> Iterator[list]:
        """The windows still open, fullest first."""
        for level in range(self.window - 1, 0, -1):
            yield from self.open[level]
        self.open = [[] for _ in range(self.window)]
        self.count[:] = 0


def pack_task(batches: Iterator, path: str, window: int, end: int) -> Iterator:
    """Pack one task's documents; windows never hold documents of two tasks.

    A document longer than the window fills windows of its own, and its remainder is packed. When the task's
    documents end, the windows still open are cut together into full ones, so at most one window has padding.
    """
    import zlib

    import numpy as np
    import pyarrow as pa
    from pyspark import TaskContext

    ids_of = encoder(path)
    packer = Packer(window, 0)
    sequence = TaskContext.get().partitionId() << 33
    closing = np.array([end], "<u4").tobytes()
    out: list[tuple] = []
    kind = None

    def emit(items: list) -> None:
        nonlocal sequence
        offset = 0
        for (doc, start, data, total), size in items:
            out.append((doc, start, size, zlib.crc32(data), total, sequence, offset))
            offset += size
        sequence += 1

    def flush() -> pa.RecordBatch:
        columns = list(zip(*out)) or [()] * 7
        out.clear()
        kinds = [kind, *[pa.int64()] * 6]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)],
            names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
        )

    for batch in batches:
        kind = batch.schema.field(0).type
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            data = ids_of(text or "") + closing
            total = len(data) // 4
            for start in range(0, total, window):
                part = data[4 * start:4 * (start + window)]
                size = len(part) // 4
                full = packer.put((doc, start, part, total), size)
                if full:
                    emit(full)
        if out:
            yield flush()
    room, items = window, []
    for held in packer.rest():
        for (doc, start, data, total), size in held:
            while size:
                take = min(room, size)
                items.append(((doc, start, data[:4 * take], total), take))
                data, start, size, room = data[4 * take:], start + take, size - take, room - take
                if not room:
                    emit(items)
                    room, items = window, []
    if items:
        emit(items)
    forget()
    if out:
        yield flush()


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, end: int = END, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are the tokenizer's for its whole text (null: empty) and ``end``. Every id lies in one piece; pieces of a sequence
    are gapless from offset 0. Each task of the scan packs the documents it reads, holding at most the window's number of open
    windows for each fill level in use, without a shuffle; every task leaves at most one window that is not full.
    Sequence numbers hold the task in their upper bits. A task that is run anew packs the same rows again. Repeated rows
    are packed each; a null key stays null; an empty table gives no rows; other columns are not read.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return rows.mapInArrow(lambda it: pack_task(it, tokenizer, window, end), schema)
