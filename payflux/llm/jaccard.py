"""Operator 6: size-aware heavy-light Jaccard join of word n-gram sets.

A text's set holds its distinct ``width``-word shingles. Equal sets are one
class; only class representatives are joined. Shingles stand in one global
order, rarest first by a fixed-size frequency sketch over all documents, so
linked sets share shingles near the front of both.

* Light sets (size up to the boundary) list all 2-element subsets of their short
  front; two linked light sets share one.
* Heavy sets scan inverted lists: each shingle of the front is a list, in which
  light sets near the boundary stand too.

The boundary is the size of least cost: rows for subsets below it against list
rows and list lengths above it. Candidates pass size and position bounds and are
then verified on whole sets, so the links are exact and the sketch affects cost only.

Inside a list the members are compared with one leader first; only members that
components do not join yet are compared among each other afterwards, and only rows of
lists that some other pair may need are kept for that. A group of copies thus costs its
size, and no link between components is lost.

Pairs are first judged by bitmaps of both sets: a bit that only one of them has stands for
a member that only this one has, which bounds what they share. Only the documents of the
pairs left are read again; they are found by a bitmap of their ids, so no text is shuffled.

Defined results: a null or empty text has the empty set and links with nothing;
a null id gives a row with null component; rows that repeat an id are one
document, linked through any of its texts; members of a list that are equal in size
and leading shingles go by position, then id; texts of any length are taken whole;
extra columns are not read, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payflux.llm.common import connected_components, doc_words, mix, slices, stored
from payflux.llm.substring import run_hashes

#: Buckets of the frequency sketch: 16 MB, whatever the input.
SKETCH_BITS = 24
#: Largest light set that the boundary search considers.
LIGHT_MOST = 400
#: Bits of a set's bitmap.
MARKS = 1024
#: Bits of the bitmap of ids (as a power of two): 8 MB, whatever the input.
ID_BITS = 26
#: Lists up to this length are judged pair by pair before their rows are kept.
SHORT = 16


def shingle_sets(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all rows, ascending within each row, and where each row's begin (plus the total)."""
    words, first = doc_words(column, lower=True)
    row, _, (h,) = run_hashes(words, first, width, (5,))
    short = np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < width))
    if len(short):
        whole = [np.bitwise_xor.reduce(mix(words[first[i]:first[i + 1]] + np.arange(1, first[i + 1] - first[i] + 1, dtype=np.uint64)
                                           * np.uint64(0xA0761D6478BD642F))) for i in short]
        row, h = np.concatenate([row, short]), np.concatenate([h, mix(np.array(whole, dtype=np.uint64))])
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    row, h = row[new], h[new]
    return h, np.searchsorted(row, np.arange(len(first)))


# ---- frequency sketch

_BLOCKS = 16


def _sketch(batches: Iterator[pa.RecordBatch], width: int, bits: int) -> Iterator[pa.RecordBatch]:
    """A task's counts by bucket, at most 255 each, as compressed blocks (most buckets of a task are empty)."""
    total = np.zeros(1 << bits, dtype=np.uint32)
    for whole in batches:
        for b in slices(whole, "text"):
            h, _ = shingle_sets(b.column("text"), width)
            np.add.at(total, (h >> np.uint64(64 - bits)).astype(np.int64), np.uint32(1))
    blocks = np.split(np.minimum(total, 255).astype(np.uint8), _BLOCKS)
    yield pa.RecordBatch.from_arrays([pa.array(range(_BLOCKS), pa.int32()), pa.array([zlib.compress(x, 1) for x in blocks], pa.binary())],
                                     names=["block", "counts"])


def _sum_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of a block over all tasks, as 16 log2(1 + count)."""
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for k, c in zip(b.column("block").to_pylist(), b.column("counts")):
            x = np.frombuffer(zlib.decompress(c.as_buffer()), dtype=np.uint8)
            total[k] = total[k] + x if k in total else x.astype(np.int64)
    if total:
        level = [np.minimum(np.rint(16 * np.log2(1.0 + x)), 255).astype(np.uint8) for x in total.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in level], pa.binary())],
                                         names=["block", "counts"])


def frequency_sketch(docs: DataFrame, width: int, bits: int = SKETCH_BITS) -> np.ndarray:
    """How often all documents hold the shingles of a bucket (the top bits of their hash), on a log scale.

    One byte for each of a fixed number of buckets, whatever the input. The order
    of shingles needs no more: any order gives the same links.
    """
    out = "block int, counts binary"
    rows = (docs.select("text").mapInArrow(partial(_sketch, width=width, bits=bits), out)
            .repartition(_BLOCKS, "block").mapInArrow(_sum_blocks, out).collect())
    levels = np.zeros(1 << bits, dtype=np.uint8)
    size = (1 << bits) // _BLOCKS
    for r in rows:
        levels[r.block * size:(r.block + 1) * size] = np.frombuffer(r.counts, dtype=np.uint8)
    return levels


# ---- signatures: size, hash of the set, front in the global order

def front(n: int | np.ndarray, num: int, den: int, extra: int):
    """Length of the front in which a set of size ``n`` shares ``extra`` members with any linked set."""
    return np.minimum(n, n + (-n * num // den) + extra)  # n - ceil(n * num / den) + extra


def _signatures(batches: Iterator[pa.RecordBatch], width: int, num: int, den: int, bits: int, sketch) -> Iterator[pa.RecordBatch]:
    levels = sketch.value
    noise = float(np.median(levels[:1 << 16]))
    for whole in batches:
        for b in slices(whole, "text"):
            h, cut = shingle_sets(b.column("text"), width)
            seen = levels[(h >> np.uint64(64 - bits)).astype(np.int64)]
            key = (seen.astype(np.uint64) << np.uint64(56)) | (h >> np.uint64(8))
            sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h + np.uint64(s)), dtype=np.uint64)]) for s in (11, 13)]
            n = np.diff(cut)
            fronts, extra = [], []
            for i in range(b.num_rows):
                m = int(n[i])
                if m < 2:
                    fronts.append(b"")
                    extra.append(0)
                    continue
                part = np.sort(key[cut[i]:cut[i + 1]])[:int(front(m, num, den, 2))]
                fronts.append(part.tobytes())
                level = (part >> np.uint64(56)).astype(np.float64)
                extra.append(int(np.maximum(np.exp2(level / 16) - np.exp2(noise / 16), 0).sum()))
            s1, s2 = (s[cut[1:]] - s[cut[:-1]] for s in sums)
            marks = np.zeros((b.num_rows, MARKS), dtype=bool)
            marks[np.repeat(np.arange(b.num_rows), n), (h % np.uint64(MARKS)).astype(np.int64)] = True
            marks = np.packbits(marks, axis=1)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(n.astype(np.int32)), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)),
                 pa.array(extra, pa.int64()), pa.array(fronts, pa.binary()), pa.array([m.tobytes() for m in marks], pa.binary())],
                names=["id", "n", "s1", "s2", "extra", "front", "marks"])


def boundary(histogram: list[tuple[int, int, int]], num: int, den: int) -> int:
    """The largest light size of least cost, from (size, sets, excess of list lengths over their fronts) up to ``LIGHT_MOST``.

    A light set costs its subsets, and one within reach of a heavy set its list
    rows too; a heavy set costs its list rows and what they are estimated to meet.
    """
    size = {n: (c, e) for n, c, e in histogram}
    lists = {n: c * int(front(n, num, den, 1)) + e for n, (c, e) in size.items()}
    subsets = {n: c * int(front(n, num, den, 2)) * (int(front(n, num, den, 2)) - 1) // 2 for n, (c, _) in size.items()}

    def cost(x: int) -> int:
        return sum(subsets[n] + (lists[n] if n * den >= x * num else 0) if n <= x else lists[n] for n in size)

    return min([0, *size], key=lambda x: (cost(x), x))


# ---- lists

LISTED = "key bigint, kind tinyint, ord bigint, id bigint, n int, pos int"
LIGHT, HEAVY_LIST = 1, 0


def _listed(batches: Iterator[pa.RecordBatch], light: int, num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Rows of the lists: (key, kind, ord, id, n, position of the last shingle in the key).

    ``ord`` is the size band (sizes within the threshold of each other), then the
    position, then a hash of the id. A list's first row in a band thus has the
    fewest rarer shingles, those that a copy's changes brought: of a group of near
    copies it is the one nearest to all, and the same in most lists.
    """
    for b in batches:
        keys, kinds, rows, poss = [], [], [], []
        ids, n = b.column("id").to_numpy(), b.column("n").to_numpy().astype(np.int64)
        fronts = b.column("front")
        band = np.floor(np.log(n) / np.log(den / num)).astype(np.int64)
        tie = (mix(ids.astype(np.uint64)) >> np.uint64(40)).astype(np.int64)
        for i in range(b.num_rows):
            m = int(n[i])
            f = np.frombuffer(fronts[i].as_buffer(), dtype="<u8")
            if m > light or m * den >= light * num:  # heavy, or within reach of a heavy set
                k = int(front(m, num, den, 1))
                keys.append(mix(f[:k]))
                kinds.append(np.full(k, HEAVY_LIST, dtype=np.int8))
                poss.append(np.arange(k))
                rows.append(np.full(k, i))
            if m <= light:
                a, c = np.triu_indices(len(f), 1)
                keys.append(mix(f[a] * np.uint64(0x9FB21C651E98DF25) + f[c]))
                kinds.append(np.full(len(a), LIGHT, dtype=np.int8))
                poss.append(c)
                rows.append(np.full(len(a), i))
            if keys and (len(keys) >= 2000 or i == b.num_rows - 1):
                r, at = np.concatenate(rows), np.concatenate(poss)
                ords = (band[r] << 48) | (np.minimum(at, (1 << 24) - 1) << 24) | tie[r]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(kinds)), pa.array(ords),
                     pa.array(ids[r]), pa.array(n[r].astype(np.int32)), pa.array(at.astype(np.int32))],
                    names=["key", "kind", "ord", "id", "n", "pos"])
                keys, kinds, rows, poss = [], [], [], []


def _need(a: np.ndarray, b: np.ndarray, num: int, den: int) -> np.ndarray:
    """Least intersection of linked sets of sizes a and b."""
    return -(-(a + b) * num // (num + den))


def possible(x: dict, y: dict, num: int, den: int) -> np.ndarray:
    """Size and position bounds for pairs that share a key (its last shingle at ``pos`` in each)."""
    most = 1 + x["kind"] + np.minimum(x["n"] - x["pos"], y["n"] - y["pos"]) - 1
    small, large = np.minimum(x["n"], y["n"]), np.maximum(x["n"], y["n"])
    return (small * den >= large * num) & (most >= _need(x["n"], y["n"], num, den)) & (x["id"] != y["id"])


def _columns(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    return {c: batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.schema.names}


def _groups(x: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Where lists begin in sorted rows, and the size of each."""
    new = np.ones(len(x["key"]), dtype=bool)
    new[1:] = (x["key"][1:] != x["key"][:-1]) | (x["kind"][1:] != x["kind"][:-1])
    starts = np.flatnonzero(new)
    return starts, np.diff(np.append(starts, len(new)))


def _bounded(x: dict, y: dict, num: int, den: int, light: int) -> np.ndarray:
    """Pairs of rows worth verifying; two light sets meet in subset lists only."""
    both_light = (x["kind"] == HEAVY_LIST) & (x["n"] <= light) & (y["n"] <= light)
    return possible(x, y, num, den) & ~both_light


def _wanted(x: dict, other: np.ndarray, starts: np.ndarray, size: np.ndarray, num: int, den: int, light: int) -> np.ndarray:
    """Rows of whole lists that may link with another row than that at ``other``, the first of their band."""
    group = np.repeat(np.arange(len(starts)), size)
    out = np.zeros(len(group), dtype=bool)
    i, gap = np.flatnonzero(np.repeat((size > 1) & (size <= SHORT), size)), 0
    while len(i):
        gap += 1
        i = i[i >= gap]
        i = i[group[i] == group[i - gap]]
        j = i - gap
        ok = (other[i] != j) & _bounded({n: v[i] for n, v in x.items()}, {n: v[j] for n, v in x.items()}, num, den, light)
        out[i[ok]] = out[j[ok]] = True
    return out


def _stars(batches: Iterator[pa.RecordBatch], num: int, den: int, light: int) -> Iterator[pa.RecordBatch]:
    """Rows of lists with a ``mate`` to verify (itself: none), and whether they may link with other rows (``more``).

    The mate is the first row of the list's size band. Rows come sorted by list and
    ``ord``; between batches one row is kept, the first of the open list's last band.
    Short lists inside a batch are judged pair by pair, and rows without use left out;
    all rows of other lists with two members and more are kept.
    """
    names = ["key", "kind", "ord", "id", "n", "pos"]
    types = (pa.int64(), pa.int8(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
    held, held_sent = {n: np.empty(0, dtype=np.int64) for n in names}, False
    for batch in batches:
        if not batch.num_rows:
            continue
        c = _columns(batch)
        x = {n: np.concatenate([held[n], c[n]]) for n in names}
        sent = np.zeros(len(x["key"]), dtype=bool)
        sent[:len(held["key"])] = held_sent
        starts, size = _groups(x)
        opens = np.zeros(len(sent), dtype=bool)
        opens[starts] = True
        opens[1:] |= (x["ord"][1:] >> 48) != (x["ord"][:-1] >> 48)
        heads = np.flatnonzero(opens)
        other = heads[np.cumsum(opens) - 1]
        ok = (np.arange(len(sent)) != other) & _bounded(x, {n: v[other] for n, v in x.items()}, num, den, light)
        whole = size <= SHORT
        whole[-1] = False
        if len(held["key"]):
            whole[0] = False
        more = np.repeat(~whole, size) | _wanted(x, other, starts, size, num, den, light)
        keep = np.repeat(size > 1, size) & ~sent & (ok | more)
        yield pa.RecordBatch.from_arrays([*[pa.array(x[n][keep], t) for n, t in zip(names, types)],
                                          pa.array(np.where(ok, x["id"][other], x["id"])[keep]), pa.array(more[keep])],
                                         names=[*names, "mate", "more"])
        held_sent = bool(size[-1] > 1)
        held = {n: v[heads[-1:]] for n, v in x.items()}


def _cross(batches: Iterator[pa.RecordBatch], num: int, den: int, light: int) -> Iterator[pa.RecordBatch]:
    """Pairs of rows of a list in different components, within the bounds; rows sorted by list and size.

    A row looks back only as far as sizes allow; rows of the open list are kept in
    runs no longer than that reach.
    """
    names = ["key", "kind", "id", "n", "pos", "comp"]
    back: dict[str, np.ndarray] = {n: np.empty(0, dtype=np.int64) for n in names}
    for batch in batches:
        c = _columns(batch)
        if not len(c["key"]):
            continue
        m = len(back["key"])
        x = {n: np.concatenate([back[n], c[n]]) for n in names}
        starts, size = _groups(x)
        group = np.repeat(np.arange(len(starts)), size)
        pairs, gap, i = [], 0, np.arange(m, len(group))
        while len(i):
            gap += 1
            i = i[i >= gap]
            i = i[group[i] == group[i - gap]]
            i = i[x["n"][i - gap] * den >= x["n"][i] * num]
            p, q = {n: v[i] for n, v in x.items()}, {n: v[i - gap] for n, v in x.items()}
            ok = (p["comp"] != q["comp"]) & _bounded(p, q, num, den, light)
            if ok.any():
                pairs.append(np.unique(np.stack([np.minimum(p["id"], q["id"])[ok], np.maximum(p["id"], q["id"])[ok]]), axis=1))
        if pairs:
            p = np.unique(np.concatenate(pairs, axis=1), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(p[0]), pa.array(p[1])], names=["a", "b"])
        open_ = (group == group[-1]) & (x["n"] * den >= x["n"][-1] * num)
        back = {n: x[n][open_] for n in names}


# ---- verification

def _set_rows(batches: Iterator[pa.RecordBatch], width: int, wanted) -> Iterator[pa.RecordBatch]:
    """The sets of the rows whose bit is set among the wanted ids."""
    for whole in batches:
        at = whole.column("at").to_numpy()
        whole = whole.filter(pa.array((wanted.value[at >> 6] >> (at & 63)) & 1 == 1))
        for b in slices(whole, "text"):
            h, cut = shingle_sets(b.column("text"), width)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([h[i:j].tobytes() for i, j in zip(cut[:-1], cut[1:])], pa.binary())],
                                             names=["id", "members"])


def _hopeful(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """The pairs whose sets may share enough: a bit that one set alone has stands for a member that it alone has."""
    for b in batches:
        if not b.num_rows:
            continue
        p, q = (np.frombuffer(b"".join(b.column(c).to_pylist()), dtype=np.uint64).reshape(b.num_rows, -1) for c in ("x", "y"))
        n, m = (b.column(c).to_numpy().astype(np.int64) for c in ("n", "m"))
        most = np.minimum(n - np.bitwise_count(p & ~q).sum(axis=1, dtype=np.int64), m - np.bitwise_count(q & ~p).sum(axis=1, dtype=np.int64))
        keep = pa.array(most >= _need(n, m, num, den))
        yield pa.RecordBatch.from_arrays([b.column("a").filter(keep), b.column("b").filter(keep)], names=["a", "b"])


def _verified(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ok = []
        for x, y in zip(b.column("x"), b.column("y")):
            p, q = np.frombuffer(x.as_buffer(), dtype="<u8"), np.frombuffer(y.as_buffer(), dtype="<u8")
            both = np.concatenate([p, q])
            both.sort(kind="stable")
            shared = int((both[1:] == both[:-1]).sum())
            ok.append(den * shared >= num * (len(p) + len(q) - shared))
        keep = pa.array(ok, pa.bool_())
        yield pa.RecordBatch.from_arrays([b.column("a").filter(keep), b.column("b").filter(keep)], names=["a", "b"])


def links(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the threshold."""
    return (pairs.join(sets.select(F.col("id").alias("a"), F.col("members").alias("x")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("members").alias("y")), "b")
            .mapInArrow(partial(_verified, num=num, den=den), "a bigint, b bigint"))


def _place(bits: int) -> Column:
    """The bit of an id in a bitmap."""
    return F.shiftrightunsigned(F.xxhash64("id"), 64 - bits)


def _ids(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))


def bitmap(ids: DataFrame, bits: int = ID_BITS) -> np.ndarray:
    """The bits of all ids, as longs: of a fixed size, whatever the input; others may share a bit."""
    words = (ids.select(_place(bits).alias("at")).groupBy(F.shiftright("at", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits")).toArrow())
    out = np.zeros(1 << (bits - 6), dtype=np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out


def hopeful(pairs: DataFrame, sig: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) that the bitmaps of their sets leave."""
    marks = sig.where("n >= 2").select("id", "n", "marks")
    return stored(pairs.join(marks.select(F.col("id").alias("a"), "n", F.col("marks").alias("x")), "a")
                  .join(marks.select(F.col("id").alias("b"), F.col("n").alias("m"), F.col("marks").alias("y")), "b")
                  .mapInArrow(partial(_hopeful, num=num, den=den), "a bigint, b bigint").distinct(), "jaccard-pairs")


def _members(named: DataFrame, pairs: DataFrame, width: int) -> DataFrame:
    """The whole sets of the documents in the pairs (and of some others, whose ids share a bit)."""
    wanted = named.sparkSession.sparkContext.broadcast(bitmap(_ids(pairs)))
    rows = named.where("id is not null").select("id", "text", _place(ID_BITS).alias("at"))
    return stored(rows.mapInArrow(partial(_set_rows, width=width, wanted=wanted), "id bigint, members binary"), "jaccard-sets")


def clusters(docs: DataFrame, width: int = 5, threshold: tuple[int, int] = (80, 100), id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """Per document: id, n_shingles, component_id (the smallest id reachable by links, itself included)."""
    num, den = threshold
    spark = docs.sparkSession
    named = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    sketch = spark.sparkContext.broadcast(frequency_sketch(named, width))
    sig = stored(named.mapInArrow(partial(_signatures, width=width, num=num, den=den, bits=SKETCH_BITS, sketch=sketch),
                                  "id bigint, n int, s1 bigint, s2 bigint, extra bigint, front binary, marks binary"), "jaccard-signatures")
    classes = sig.where("n > 0 and id is not null").groupBy("n", "s1", "s2").agg(F.min("id").alias("rep"))

    # representatives of classes whose size allows a link to a different set
    reps = sig.where("n >= 2").join(classes.select(F.col("rep").alias("id"), "n", "s1", "s2"), ["id", "n", "s1", "s2"])
    light = boundary([tuple(r) for r in reps.where(F.col("n") <= LIGHT_MOST).groupBy("n")
                     .agg(F.count("*"), F.sum("extra")).collect()], num, den)
    listed = reps.select("id", "n", "front").mapInArrow(partial(_listed, light=light, num=num, den=den), LISTED)
    lists = stored(listed.repartition("key").sortWithinPartitions("key", "kind", "ord")
                   .mapInArrow(partial(_stars, num=num, den=den, light=light), LISTED + ", mate bigint, more boolean"), "jaccard-lists")
    star = stored(lists.where("mate <> id").select(F.least("id", "mate").alias("a"), F.greatest("id", "mate").alias("b")).distinct(),
                  "jaccard-stars")
    near = hopeful(star, sig, num, den)
    linked = stored(links(near, _members(named, near, width), num, den).distinct(), "jaccard-links")
    parts = connected_components(linked)

    # lists that components have not joined: all possible pairs across components
    rest = (lists.where("more").select("key", "kind", "id", "n", "pos").join(parts, "id", "left")
            .withColumn("comp", F.coalesce("component", "id")).drop("component"))
    mixed = rest.groupBy("key", "kind").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key", "kind")
    cross = (rest.join(mixed, ["key", "kind"]).repartition("key").sortWithinPartitions("key", "kind", "n", "id")
             .select("key", "kind", "id", "n", "pos", "comp")
             .mapInArrow(partial(_cross, num=num, den=den, light=light), "a bigint, b bigint").distinct()
             .join(star, ["a", "b"], "left_anti"))
    cross = hopeful(stored(cross, "jaccard-cross"), sig, num, den)
    more = stored(links(cross, _members(named, cross, width), num, den), "jaccard-more")
    parts = connected_components(linked.unionByName(more))

    out = (sig.select("id", "n", "s1", "s2").join(classes, ["n", "s1", "s2"], "left")
           .join(parts.select(F.col("id").alias("rep"), "component"), "rep", "left"))
    # an id that repeats with other texts is one document: its smallest component holds
    return out.select(F.col("id").alias(id_col), F.col("n").cast("bigint").alias("n_shingles"),
                      F.when(F.col("id").isNotNull(), F.coalesce("component", "rep", "id")).alias("component_id"))
