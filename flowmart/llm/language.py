"""Language identification by mixture inference: EM over word likelihoods, language set by penalised likelihood."""

from __future__ import annotations

import functools
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F, types as T

from flowmart.llm.common import small_batches, text_batches

#: Hash buckets of character trigrams; a model has so many numbers per language.
BUCKETS = 1 << 16
#: Added to every count; change of a proportion below which EM ends.
SMOOTHING, CHANGE = 0.5, 1e-3
#: The name of texts without a letter.
UNKNOWN = "und"


@functools.cache
def _letters():
    """For each code point: 1 for a letter, 2 for a mark, which belongs to a word but makes none."""
    import unicodedata

    import numpy as np

    table = np.zeros(0x110001, np.uint8)
    table[:0x110000] = ["LM".find(unicodedata.category(chr(c))[0]) + 1 for c in range(0x110000)]
    return table


def _trigrams(pieces: list[str]):
    """(bucket of each letter's trigram, number of its word, number of the piece of each word)."""
    import numpy as np

    low = [p.lower() for p in pieces]
    points = np.frombuffer(("\n" + "\n".join(low) + "\n").encode("utf-32-le", "replace"), "<u4")
    kind = _letters()[points]
    letter = kind > 0
    if (kind == 2).any():
        at = np.flatnonzero(letter)
        word = np.cumsum(~letter[at - 1]) - 1
        made = np.bincount(word, kind[at] == 1) > 0
        letter[at[~made[word]]] = False  # marks without a letter
    code = np.where(letter, points, 0).astype(np.uint32)
    at = np.flatnonzero(letter)
    mixed = code[at - 1] * np.uint32(0x9E3779B1) + code[at] * np.uint32(0x85EBCA77) + code[at + 1] * np.uint32(0xC2B2AE3D)
    mixed ^= mixed >> np.uint32(15)
    bucket = ((mixed * np.uint32(0x27D4EB2F)) >> np.uint32(32 - 16)).astype(np.int64)
    first = ~letter[at - 1]
    word = np.cumsum(first) - 1
    ends = np.cumsum([1 + len(p) for p in low])
    return bucket, word, np.searchsorted(ends, at[first] - 1, side="right") if len(at) else at


def _count(batches: Iterator) -> Iterator:
    """One task's trigram counts by language."""
    import numpy as np
    import pyarrow as pa

    held: dict = {}
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang in dict.fromkeys(langs):
            total = held.setdefault(lang, np.zeros(BUCKETS, np.int64))
            for _, pieces in text_batches([t for t, own in zip(texts, langs) if own == lang]):
                total += np.bincount(_trigrams(pieces)[0], minlength=BUCKETS)
    for lang, total in held.items():
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(total[at])], names=["lang", "bucket", "n"]
        )


def fit(docs: DataFrame, text: str = "text", lang: str = "lang"):
    """(languages, log-likelihood of each bucket by language), learned from every row whose text and language are not null.

    Counts are summed in each task and then by Spark; what comes to the driver is at most ``BUCKETS`` numbers a language.
    A language whose texts have no letter is not learned.
    """
    import numpy as np

    small_batches(docs.sparkSession)
    rows = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang is not null and text is not null")
    counts = rows.mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(counts["lang"].to_pylist()))
    table = np.full((BUCKETS, max(1, len(langs))), SMOOTHING)
    index = {name: i for i, name in enumerate(langs)}
    of = np.array([index[x] for x in counts["lang"].to_pylist()], np.int64)
    table[counts["bucket"].to_numpy(), of] += counts["n"].to_numpy()
    return langs, np.log(table / table.sum(axis=0)).astype(np.float32)


def _em(p, owner, starts, n, allowed):
    """Proportions and log-likelihood gain of each document's mixture over the ``allowed`` languages.

    A document's rounds go on until none of its proportions moves by more than ``CHANGE``. Every such move raises its likelihood by
    an amount that is bounded below, so they end.
    """
    import numpy as np

    share = allowed / allowed.sum(axis=1, keepdims=True)
    live = np.arange(len(starts))
    rows, own, at = slice(None), owner, starts
    while True:
        part = p[rows] * share[live][own]
        part /= part.sum(axis=1, keepdims=True)
        new = np.add.reduceat(part, at, axis=0) / n[live, None]
        moved = np.abs(new - share[live]).max(axis=1) > CHANGE
        share[live] = new
        if not moved.any():
            break
        if moved.mean() < 0.7:  # go on with the documents that still move
            keep = np.zeros(len(starts), bool)
            keep[live[moved]] = True
            live = np.flatnonzero(keep)
            rows = np.flatnonzero(keep[owner])
            size = n[live].astype(np.int64)
            own, at = np.repeat(np.arange(len(live)), size), np.concatenate([[0], np.cumsum(size)[:-1]])
    gain = np.log(np.maximum((p * share[owner]).sum(axis=1), 1e-30))
    return share, np.add.reduceat(gain, starts)


def mixtures(likely, owner, documents: int):
    """(has words, proportions by language) of each document from its words' log-likelihoods.

    ``likely`` has a row per word, ordered by ``owner``. Each language set tried is a prefix of the languages by their
    proportion under all languages; the one with the best log-likelihood less half the log of the number of words for each
    further language is kept, the smaller set on a tie.
    """
    import numpy as np

    n = np.bincount(owner, minlength=documents)
    some = np.flatnonzero(n)
    out = np.zeros((documents, likely.shape[1]))
    if not len(some):
        return n > 0, out
    size = n[some]
    starts = np.concatenate([[0], np.cumsum(size)[:-1]])
    own = np.repeat(np.arange(len(some)), size)
    top = likely.max(axis=1, keepdims=True)
    p = np.exp(likely - top)
    languages = likely.shape[1]
    alone = np.add.reduceat((likely - top).astype(np.float64), starts, axis=0)
    best, score = np.zeros((len(some), languages)), alone.max(axis=1)
    best[np.arange(len(some)), alone.argmax(axis=1)] = 1
    if languages > 1:
        cost = 0.5 * np.log(np.maximum(size, 2))
        share, gain = _em(p, own, starts, size, np.ones((len(some), languages), np.float32))
        rank = np.argsort(np.argsort(-share, axis=1, kind="stable"), axis=1)
        open_ = gain - cost > score  # else no larger set can pay for itself
        for k in range(2, languages + 1):
            at = np.flatnonzero(open_)
            if not len(at):
                break
            rows = np.flatnonzero(open_[own])
            sub = np.repeat(np.arange(len(at)), size[at])
            begin = np.concatenate([[0], np.cumsum(size[at])[:-1]])
            s, g = _em(p[rows], sub, begin, size[at], (rank[at] < k).astype(np.float32))
            better = g - cost[at] * (k - 1) > score[at]
            score[at[better]] = (g - cost[at] * (k - 1))[better]
            best[at[better]] = s[better]
    out[some] = best
    return n > 0, out


def _predict(batches: Iterator, model) -> Iterator:
    import numpy as np
    import pyarrow as pa

    langs, table = model.value
    for batch in batches:
        texts = batch.column(1).to_pylist()
        likely, owners = [], []
        for owner, pieces in text_batches(texts):
            bucket, word, piece = _trigrams(pieces)
            if len(bucket):
                edge = np.concatenate([[0], np.flatnonzero(np.diff(word)) + 1])
                likely.append(np.add.reduceat(table[bucket], edge, axis=0))
                owners.append(np.array(owner, np.int64)[piece])
        if likely and langs:
            known, share = mixtures(np.concatenate(likely), np.concatenate(owners), len(texts))
        else:
            known, share = np.zeros(len(texts), bool), np.zeros((len(texts), 1))
        top = share.argmax(axis=1)
        named = [[(langs[j], float(s[j])) for j in np.argsort(-s, kind="stable") if s[j] > 0] if k else [] for k, s in zip(known, share)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([langs[j] if k else UNKNOWN for k, j in zip(known, top)], pa.string()),
                pa.array([min(1.0, float(s[j])) if k else 0.0 for k, s, j in zip(known, share, top)], pa.float64()),
                pa.array([[{"lang": a, "share": b} for a, b in x] for x in named], pa.list_(pa.struct({"lang": pa.string(), "share": pa.float64()}))),
            ],
            names=["id", "lang_pred", "score", "languages"],
        )


def predict(docs: DataFrame, model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``key``, lang_pred, score, languages (array of language and share, largest first).

    ``lang_pred`` is the language with the largest share of the document's words, ``score`` that share. Null texts, texts
    without a letter, and every text under an empty model give ``und``, score 0 and no languages. Ties go to the language
    that is first by name. Reads ``key`` and ``text`` only; repeated rows give repeated rows.
    """
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.select(F.col(key)).schema[0].dataType.simpleString()
    schema = f"id {kind}, lang_pred string, score double, languages array<struct<lang:string,share:double>>"
    return docs.select(F.col(key).alias("id"), F.col(text)).mapInArrow(lambda it: _predict(it, sent), schema).withColumnRenamed("id", key)


def fold(key: str = "doc_id", folds: int = 3):
    """The fold of a document: crc32 of its key as text (null: of nothing) modulo ``folds``."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % folds


def keep_known(docs: DataFrame, least: float = 0.0, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` with all its columns, less the rows whose text has no learned language, or none with a share of ``least``.

    A document in several learned languages stays, however its words are shared among them, unless ``least`` is raised. Learns from the same rows that it judges; the language column is no input of a prediction.
    """
    model = fit(docs, text, lang)
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))
    def judge(texts):
        import pyarrow as pa

        batch = pa.RecordBatch.from_arrays([pa.nulls(len(texts)), texts], names=["id", "text"])
        found = next(_predict(iter([batch]), sent))
        return pa.StructArray.from_arrays([found.column(1), found.column(2)], names=["lang_pred", "score"])

    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), docs[f"`{text}`"].alias("text"))
    found = rows.select("row", judge("text").alias("found"))
    return found.where((F.col("found.lang_pred") != UNKNOWN) & (F.col("found.score") >= least)).select("row.*")
