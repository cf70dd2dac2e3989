"""Operator 11: spelling variants of the words of a corpus by reduced-alphabet generation.

Words are maximal runs of letters (A to Z, a to z, U+00C0 to U+00FF), lower-cased in A to
Z only, of at least ``min_length`` letters and ``min_count`` occurrences. Two words are near
if one inserted, deleted or replaced letter makes one of the other.

Letters are reduced to a few symbols (code point modulo their number). Of every reduced
word its full neighbourhood is generated: itself, and all words one deletion, replacement or
insertion of a symbol away. Neighbours that are reduced words of the vocabulary meet them in
an equi-join, and the original words are verified by edit distance. One edit of a word is at
most one edit of its reduced word, so no near pair is missed.

The number of symbols is taken from the size of the vocabulary, so that the shortest reduced
words are about ``room`` times as many as there are words (few false meetings); more words
mean a longer neighbourhood, never other results. Reduced words are known by 64-bit hashes of
their symbols, from which the hashes of all neighbours follow by prefix sums. A bitmap of a
fixed size (``2**bits`` bits, at most 2**bits / 64 longs, whatever the corpus) of the
vocabulary's reduced words is broadcast; a neighbour without its bit is not in the vocabulary
and is not sent to the join.

A word's form is its near word of most occurrences (ties: smallest in code-point order), if
these are at least ``ratio`` times its own; its root follows the forms to the last. Counts
grow ``ratio``-fold on the way, so a chain has at most 19 words and five rounds of pointer
doubling reach its end (``ratio`` of at least 10).

Occurrences are counted by partial aggregates before the shuffle, so a word in a third of
all documents costs a row per task. A reduced word shared by very many words is a hot key of
the join, which adaptive execution splits.

Defined results: null and empty texts have no words; repeated rows count again; a null id
stands as an empty string in the planted deletion; very long texts are read whole; extra
columns are not read, whatever their names; an empty table or vocabulary gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payflux.llm.common import mix, powers, stored

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BASE = 0x9E3779B97F4A7C15
_ROWS = 1 << 21  # neighbours computed at a time


def occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 7, plant: bool = False) -> DataFrame:
    """(word) per occurrence of a run of at least ``min_length`` letters; ``plant`` deletes a letter where the contract says so."""
    runs = docs.select(F.col(id_col).cast("string").alias("id"),
                       F.explode(F.regexp_extract_all(F.translate(text_col, _UPPER, _LOWER), F.lit(f"[a-z\\u00C0-\\u00FF]{{{min_length},}}"), F.lit(0))).alias("run"))
    if not plant:
        return runs.select(F.col("run").alias("word"))
    h = runs.select("run", F.crc32(F.concat(F.coalesce("id", F.lit("")), F.lit(":"), F.col("run")).cast("binary")).alias("h"))
    cut = F.expr("concat(substring(run, 1, cast(h % length(run) as int)), substring(run, cast(h % length(run) as int) + 2))")
    return h.select(F.when(F.col("h") % 31 == 0, cut).otherwise(F.col("run")).alias("word")).where(F.length("word") >= min_length)


def vocabulary(words: DataFrame, min_count: int = 2) -> DataFrame:
    """(word, n)"""
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def symbols_for(words: int, min_length: int, room: int = 16) -> int:
    """The least number of symbols (from 4) whose words of the smallest length are ``room`` times as many as ``words``."""
    s = 4
    while s < 64 and s ** min_length < room * words:
        s += 1
    return s


def reduced(words: list[str], symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """The symbols (from 1) of all words in a line, and the words' lengths."""
    line = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    return (line % symbols + 1).astype(np.uint64), np.fromiter(map(len, words), dtype=np.int64, count=len(words))


def hashes(rows: np.ndarray) -> np.ndarray:
    """Hash per row of equally long reduced words, before mixing: a polynomial in the symbols."""
    return rows @ powers(_BASE, rows.shape[1]) if rows.shape[1] else np.zeros(len(rows), dtype=np.uint64)


def neighbourhood(rows: np.ndarray, symbols: int) -> np.ndarray:
    """Mixed hashes of the full one-edit neighbourhood per row (a column per edit; equal neighbours may repeat)."""
    n = rows.shape[1]
    up = powers(_BASE, n + 1)
    term = rows * up[:n]
    head = np.zeros((len(rows), n + 1), dtype=np.uint64)
    np.cumsum(term, axis=1, out=head[:, 1:])
    whole = head[:, -1:]
    tail = whole - head  # of the symbols from a place on, where they stand
    down = np.uint64(pow(_BASE, -1, 1 << 64))
    alphabet = np.arange(1, symbols + 1, dtype=np.uint64)
    drop = head[:, :n] + tail[:, 1:] * down
    swap = ((whole - term)[:, :, None] + (alphabet[None, :] * up[:n, None])[None]).reshape(len(rows), -1)
    put = ((head + tail * np.uint64(_BASE))[:, :, None] + (alphabet[None, :] * up[:, None])[None]).reshape(len(rows), -1)
    return mix(np.concatenate([whole, drop, swap, put], axis=1))


def _by_length(words: list[str], symbols: int, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and symbol rows of the words of each length, about ``_ROWS`` neighbours at a time."""
    line, size = reduced(words, symbols)
    first = np.cumsum(size) - size
    for n in np.unique(size):
        at = np.flatnonzero(size == n)
        step = max(1, _ROWS // max(1, width * (2 * int(n) + 1)))
        for i in range(0, len(at), step):
            some = at[i:i + step]
            yield some, line[first[some][:, None] + np.arange(n)[None, :]]


def keyed(words: DataFrame, symbols: int) -> DataFrame:
    """(word, n, key): the hash of the reduced word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = np.zeros(batch.num_rows, dtype=np.uint64)
            for at, rows in _by_length(batch.column("word").to_pylist(), symbols, 1):
                key[at] = mix(hashes(rows))
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array(key.view(np.int64))], names=["word", "n", "key"])

    return words.select("word", "n").mapInArrow(run, "word string, n bigint, key bigint")


def bitmap(keys: DataFrame, bits: int) -> np.ndarray:
    """A bit for every key (modulo 2**bits), in bytes; at most 2**bits / 64 rows reach the driver."""
    mask = (1 << bits) - 1
    slots = (keys.select(F.col("key").bitwiseAND(F.lit(mask)).alias("k"))
             .groupBy(F.shiftright("k", 6).alias("slot")).agg(F.expr("bit_or(shiftleft(1L, cast(k & 63 as int)))").alias("word")))
    out = np.zeros(1 << (bits - 6), dtype=np.uint64)
    got = slots.toArrow()
    out[got.column("slot").to_numpy()] = got.column("word").to_numpy().view(np.uint64)
    return out.view(np.uint8)


def probes(words: DataFrame, symbols: int, bits: int, sketch) -> DataFrame:
    """(word, n, key): the neighbours of every word's reduced word that may be reduced words of the vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bit = sketch.value
        mask = np.uint64((1 << bits) - 1)
        for batch in batches:
            for at, rows in _by_length(batch.column("word").to_pylist(), symbols, symbols):
                keys = np.sort(neighbourhood(rows, symbols), axis=1)
                low = keys & mask
                ok = (bit[(low >> np.uint64(3)).astype(np.int64)] >> (low & np.uint64(7)).astype(np.uint8)) & 1 > 0
                ok[:, 1:] &= keys[:, 1:] != keys[:, :-1]
                i, j = np.nonzero(ok)
                some = batch.take(pa.array(at[i]))
                yield pa.RecordBatch.from_arrays([some.column("word"), some.column("n"), pa.array(keys[i, j].view(np.int64))], names=["word", "n", "key"])

    return words.select("word", "n").mapInArrow(run, "word string, n bigint, key bigint")


def near_words(words: DataFrame, min_length: int = 7, room: int = 16, bits: int = 27) -> DataFrame:
    """(word, n, other, m): all pairs of near words of the vocabulary (word, n), in both directions."""
    spark = words.sparkSession
    symbols = symbols_for(words.count(), min_length, room)
    known = stored(keyed(words, symbols), "spelling-keys")
    sketch = spark.sparkContext.broadcast(bitmap(known, bits))
    made = probes(known, symbols, bits, sketch)
    return (made.join(known.select("key", F.col("word").alias("other"), F.col("n").alias("m")), "key")
            .where("word <> other and abs(length(word) - length(other)) <= 1 and levenshtein(word, other, 1) = 1")
            .select("word", "n", "other", "m"))


def rooted(forms: DataFrame, ratio: int = 10) -> DataFrame:
    """(word, root) of (word, form): the last form reached, by pointer doubling."""
    if ratio < 10:
        raise ValueError("ratio must be at least 10")
    now = forms.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(5):
        now = stored(now, "spelling-roots")
        step = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if not now.join(step, "root", "left_semi").limit(1).count():
            break
        now = now.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return now


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 7, min_count: int = 2,
             ratio: int = 10, room: int = 16, bits: int = 27, plant: bool = False) -> DataFrame:
    """(word, form, root, n, n_near, form_n) per word of the vocabulary."""
    words = stored(vocabulary(occurrences(docs, id_col, text_col, min_length, plant), min_count), "spelling-words")
    near = (near_words(words, min_length, room, bits).groupBy("word", "n", "m")
            .agg(F.min("other").alias("other"), F.count("*").alias("k"))
            .groupBy("word", "n").agg(F.sum("k").alias("n_near"), F.max_by("other", "m").alias("form"), F.max("m").alias("form_n")))
    good = F.col("form_n") >= ratio * F.col("n")
    found = stored(near.select("word", "n_near", F.when(good, F.col("form")).alias("form"), F.when(good, F.col("form_n")).alias("form_n")), "spelling-near")
    roots = rooted(found.select("word", "form"), ratio)
    return (words.join(found, "word", "left").join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form_n"))
