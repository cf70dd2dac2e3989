"""Operator 7: best-fit packing of token sequences under several capacities.

Documents are tokenised inside tasks and cut into pieces of at most ``tokens``
ids. Pieces are dealt by a hash into blocks of bounded size; within a block they
are packed by vector best fit in decreasing length: every bin has residual
capacities of tokens, documents and attention cost (sum of squared lengths), and
a piece goes to the open bin that holds it under every constraint and scores
best, by the weighted dot product of its demand and the residual, or by the
smallest weighted norm of the residual that it leaves. By default tokens decide,
as the fewest sequences are asked for; documents and cost have so small a weight
that they choose between bins of equal token residuals only.

Defined results: a null text counts as empty (one piece, the end id alone);
repeated rows are packed as separate documents; pieces of equal length are taken
in the order of the rows; a text of any length is cut into pieces and taken a few
megabytes at a time with others, or alone; the input's columns of ``pack`` stay,
whatever their names, but for sequence_id and offset, which are replaced; an empty
table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from payflux.llm.common import slices, stored

#: Pieces packed together by one task.
BLOCK = 8192
#: Distinct words whose ids a worker remembers.
WORDS_KEPT = 700_000
#: Bytes of text taken at a time; a longer text stands alone.
_BYTES = 2 << 20
#: Words of printable ASCII and of the Latin-1 letters beyond it, and the tokenizer's own parts of such a word in
#: lower case (fixed values of its split pattern).
_SIMPLE = re.compile("[!-~À-ÖØ-öø-ÿ]+")
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")
#: The letter that stands for a byte in the tokenizer's model: its own where that prints, else the next one from 256 on.
_UNPRINTED = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
_LETTER = {b: 256 + k for k, b in enumerate(_UNPRINTED)}


class WordIds:
    """Ids of white-space separated words, remembered per worker.

    The tokenizer lower-cases, drops white space and never merges across it, so
    a text's ids are those of its words in a line. Words are remembered in two
    generations: the younger takes every word met, and when it is full it becomes the
    older one, whose words not met since are forgotten.
    """

    _held: dict[str, "WordIds"] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    @classmethod
    def of(cls, path: str) -> "WordIds":
        if path not in cls._held:
            cls._held[path] = cls(path)
        return cls._held[path]

    def words(self, words: list[bytes]) -> list[bytes]:
        """The ids of words (ASCII letters in lower case), little-endian, four bytes each."""
        if len(self.young) + len(words) > WORDS_KEPT // 2:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        out = list(map(young.get, words))
        for i, ids in enumerate(out):
            if ids is None:
                w = words[i]
                ids = old.get(w)
                if ids is None:
                    ids = self._model_ids(w.decode()) if w.isalpha() else self._encoded(w)  # bytes: ASCII letters only
                young[w] = out[i] = ids
        return out

    def _encoded(self, word: bytes) -> bytes:
        """A word of ASCII and Latin-1 letters is cut into the tokenizer's own parts, which its
        model encodes; other words are encoded by the whole tokenizer."""
        t = word.decode("utf-8", "replace")
        if _SIMPLE.fullmatch(t) and "<|" not in t:
            return b"".join(map(self._part, _PARTS.findall(t.lower())))
        return array("I", self.tokenizer.encode(t, add_special_tokens=False).ids).tobytes()

    def _model_ids(self, part: str) -> bytes:
        return array("I", [x.id for x in self.model.tokenize(part)]).tobytes()

    def _part(self, part: str) -> bytes:
        """The ids of a part of a word that the tokenizer never merges with its neighbours."""
        w = part.encode()
        ids = self.young.get(w) or self.old.get(w)
        if ids is None:
            ids = self.young[w] = self._model_ids(part if part.isascii() else w.decode("latin-1").translate(_LETTER))
        return ids

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a line, and where each text begins in them (with the end)."""
        words = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.string()).fill_null("")))
        coded = words.flatten().dictionary_encode()
        ids = self.words(coded.dictionary.cast(pa.binary()).to_pylist())
        flat = np.frombuffer(b"".join(ids), dtype="<u4")
        length = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
        which = coded.indices.to_numpy()
        n = length[which]
        ends = np.concatenate(([0], np.cumsum(n)))
        shift = (np.cumsum(length) - length)[which] - ends[:-1]  # from a word's place in the line to that in ``flat``
        line = flat[np.arange(ends[-1]) + np.repeat(shift, n)]
        return line, ends[words.offsets.to_numpy() - words.offsets[0].as_py()]


PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids_crc32", pa.int64())])


def _pieces(batches: Iterator[pa.RecordBatch], path: str, most: int, end_id: int) -> Iterator[pa.RecordBatch]:
    ids_of = WordIds.of(path)
    end = np.array([end_id], dtype="<u4").tobytes()
    for batch in batches:
        doc, piece, start, length, crc = [], [], [], [], []
        for part in slices(batch, batch.schema.names[1], _BYTES):
            line, at = ids_of.texts(part.column(1))
            for k, d in enumerate(part.column(0).to_pylist()):
                ids = line[at[k]:at[k + 1]].tobytes() + end
                for j, first in enumerate(range(0, len(ids), 4 * most)):
                    cut = ids[first:first + 4 * most]
                    doc.append(d)
                    piece.append(j)
                    start.append(first // 4)
                    length.append(len(cut) // 4)
                    crc.append(zlib.crc32(cut))
        yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip((doc, piece, start, length, crc), PIECES)],
                                         schema=PIECES)


def pieces(docs: DataFrame, path: str, tokens: int = 2048, end_id: int = 0, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """Pieces of every document: doc_id, piece, start, length, ids_crc32."""
    return docs.select(F.col(id_col).cast("bigint"), text_col).mapInArrow(
        partial(_pieces, path=path, most=tokens, end_id=end_id),
        "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def vector_best_fit(lengths: np.ndarray, tokens: int, documents: int, cost: int, weights: tuple[float, float, float],
                    score: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every piece, pieces taken in decreasing length.

    Bins with equal residuals are interchangeable, so open bins are kept by
    residual (a row of the matrix and a stack of bins): a choice costs the
    number of distinct residuals, not of bins.
    """
    bins, offsets = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    cap = np.array([tokens, documents, cost], dtype=np.int64)
    w = np.array(weights, dtype=np.float64)
    rows = np.zeros((64, 3), dtype=np.int64)  # distinct residuals; a row without bins holds zeros
    stacks: list[list[int]] = [[] for _ in range(64)]
    where: dict[tuple, int] = {}
    spare = list(range(63, -1, -1))
    top = 0
    used: list[int] = []  # tokens in each bin
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        need = np.array([n, 1, n * n], dtype=np.int64)
        live = rows[:top]
        ok = np.flatnonzero((live >= need).all(axis=1))
        if len(ok):
            left = live[ok]
            if score == "norm":
                value = -(w * ((left - need) / cap) ** 2).sum(axis=1)
            else:
                value = (w * (need / cap) * (left / cap)).sum(axis=1)
            r = int(ok[int(value.argmax())])
            b = stacks[r].pop()
            now = rows[r] - need
            if not stacks[r]:
                del where[tuple(rows[r].tolist())]
                rows[r] = 0
                spare.append(r)
        else:
            b = len(used)
            used.append(0)
            now = cap - need
        bins[i], offsets[i] = b, used[b]
        used[b] += n
        if now.min() <= 0:
            continue  # full in one respect
        k = tuple(now.tolist())
        r = where.get(k)
        if r is None:
            if not spare:
                grown = len(rows)
                rows = np.vstack([rows, np.zeros_like(rows)])
                stacks += [[] for _ in range(grown)]
                spare = list(range(2 * grown - 1, grown - 1, -1))
            r = where[k] = spare.pop()
            rows[r] = now
            top = max(top, r + 1)
        stacks[r].append(b)
    return bins, offsets


def _pack(table: pa.Table, **how) -> pa.Table:
    block = table.column("block")[0].as_py()
    order = table.sort_by("row")
    bins, offsets = vector_best_fit(order.column("length").to_numpy(), **how)
    return pa.table({"piece": order.column("piece"), "sequence_id": pa.array(bins + (block << 32), pa.int64()), "offset": pa.array(offsets, pa.int64())})


def pack(frame: DataFrame, tokens: int = 2048, documents: int = 2048, cost: int = 2048 * 2048,
         weights: tuple[float, float, float] = (1.0, 1e-8, 1e-8), score: str = "norm", block: int = BLOCK) -> DataFrame:
    """Sequences of the pieces (with a ``length``): adds sequence_id and offset.

    A full piece is a sequence of its own and is not dealt. The others go to
    ``count / block`` blocks by a hash of the row; each block ends with a few
    bins that are not full, about one in some thousand.
    """
    names = [c for c in frame.columns if c not in ("sequence_id", "offset")]
    frame = stored(frame.select(F.struct(*[f"`{c}`" for c in names]).alias("piece"), F.col("length").cast("bigint").alias("length"),
                                F.monotonically_increasing_id().alias("row")), "pack-pieces")
    whole, rest = frame.where(F.col("length") >= tokens), frame.where(F.col("length") < tokens)
    blocks = max(1, -(-rest.count() // block))
    schema = T.StructType([frame.schema["piece"], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    how = {"tokens": tokens, "documents": documents, "cost": cost, "weights": weights, "score": score}

    def one(table: pa.Table) -> pa.Table:
        return _pack(table, **how)

    packed = rest.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks))).groupBy("block").applyInArrow(one, schema)
    alone = whole.select("piece", (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    return packed.unionByName(alone).select("piece.*", "sequence_id", "offset")
