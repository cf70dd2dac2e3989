"""Operator 2: embedding near-duplicates by E8 lattice hashing.

A vector is scaled to length one, projected to eight dimensions by an orthonormal
map per table and decoded to the nearest point of the E8 lattice, its home cell.
It also probes the neighbouring cells that lie nearest. Two vectors meet where one
probes the other's home; those that meet are verified by cosine in double precision.

Only vectors of equal, non-null label are compared. Vectors with equal components
are one class and are compared once. A crowded cell is cut into blocks, and the
blocks are compared pairwise by matrix products; a task returns counts of links
and a spanning forest, never the pairs. A link that shows in several tables
counts in the first one only, which both vectors' cells tell.

Defined results: unusable vectors (null, zero, null or non-finite components, a
length unlike the others') and null labels link with nothing; a null id gives a
row that links with nothing, with null component and kept null; repeated rows and rows
that share an id are vectors of their own, each with a row of the result; a component's
name is its smallest id, so ties don't arise; vectors have no texts; extra columns are
not read, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payflux.llm.common import connected_components, mix, stored
from payflux.llm.vectors import matrix, usable


@dataclass(frozen=True)
class Lattice:
    """``scale``: size of a lattice unit after projection; ``block``: vectors of a cell compared at once."""

    tables: int = 4
    probes: int = 4
    scale: float = 0.15
    seed: int = 8
    block: int = 1024


def nearest_d8(y: np.ndarray) -> np.ndarray:
    """The nearest point with whole coordinates of even sum: round, and where the sum is odd round the worst one the other way."""
    near = np.rint(y)
    rest = y - near
    odd = np.flatnonzero(near.sum(axis=1).astype(np.int64) & 1)
    worst = np.abs(rest[odd]).argmax(axis=1)
    near[odd, worst] += np.where(rest[odd, worst] >= 0, 1, -1)
    return near


def nearest_e8(y: np.ndarray) -> np.ndarray:
    """The nearest E8 point: the better of D8 and D8 shifted by one half."""
    a, b = nearest_d8(y), nearest_d8(y - 0.5) + 0.5
    return np.where((((y - a) ** 2).sum(axis=1) <= ((y - b) ** 2).sum(axis=1))[:, None], a, b)


def shortest_vectors() -> np.ndarray:
    """The 240 neighbours of a lattice point, by rule: two units, or eight halves with an even number of minus signs."""
    out = []
    for i, j in combinations(range(8), 2):
        for s, t in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = s, t
            out.append(v)
    out += [np.array(s) for s in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


def cell_codes(points: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """A 64-bit code of lattice points (..., 8) and a salt per row."""
    h = salt.astype(np.uint64)
    for k in range(8):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + np.rint(2 * points[..., k]).astype(np.int64).astype(np.uint64) + np.uint64(k + 1))
    return h


def cells(unit: np.ndarray, label: np.ndarray, how: Lattice) -> np.ndarray:
    """Codes (rows, tables, 1 + probes): home cell first, then the nearest neighbouring cells."""
    rng = np.random.default_rng(how.seed)
    dims = unit.shape[1]
    roots = shortest_vectors()
    out = np.empty((len(unit), how.tables, 1 + how.probes), dtype=np.uint64)
    for t in range(how.tables):
        flat = rng.normal(size=(max(dims, 8), 8))
        q = np.linalg.qr(flat)[0][:dims]
        y = unit @ q / how.scale * np.sqrt(dims / 64)
        home = nearest_e8(y)
        salt = mix(label.astype(np.int64).astype(np.uint64) * np.uint64(31) + np.uint64(t))
        out[:, t, 0] = cell_codes(home, salt)
        towards = (y - home) @ roots.T
        near = np.argpartition(-towards, how.probes, axis=1)[:, :how.probes]
        for k in range(how.probes):
            out[:, t, 1 + k] = cell_codes(home + roots[near[:, k]], salt)
    return out


_CODED = "id bigint, label bigint, mult bigint, unit binary, codes binary"


def _code(batches: Iterator[pa.RecordBatch], how: Lattice) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if not b.num_rows:
            continue
        x = matrix(b.column("vec"))
        unit = x / np.abs(x).max(axis=1, keepdims=True)  # first by the largest component: squares cannot overflow
        unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
        codes = cells(unit, b.column("label").to_numpy(), how)
        yield pa.RecordBatch.from_arrays(
            [b.column("id"), b.column("label"), b.column("mult"), pa.array([u.tobytes() for u in unit], pa.binary()),
             pa.array([c.tobytes() for c in codes], pa.binary())], names=["id", "label", "mult", "unit", "codes"])


def _cell_rows(batches: Iterator[pa.RecordBatch], how: Lattice) -> Iterator[pa.RecordBatch]:
    wide = how.tables * (1 + how.probes)
    for b in batches:
        codes = np.array([np.frombuffer(c.as_buffer(), dtype="<u8") for c in b.column("codes")]).reshape(-1, wide)
        if not len(codes):
            continue
        home = np.tile((np.arange(wide) % (1 + how.probes) == 0), len(codes))
        yield pa.RecordBatch.from_arrays(
            [pa.array(codes.reshape(-1).view(np.int64)), pa.array(home), pa.array(np.tile(np.arange(wide) // (1 + how.probes), len(codes)).astype(np.int8)),
             pa.array(np.repeat(b.column("id").to_numpy(), wide))], names=["cell", "home", "tab", "id"])


def _first_meeting(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For pairs with codes (pairs, tables, 1 + probes), a's id smaller: 2 * table, plus 1 where only b's home is probed."""
    probes_a = (a[:, :, :1] == b).any(axis=2)  # b probes or shares a's home
    probes_b = (b[:, :, :1] == a).any(axis=2)
    events = np.stack([probes_a, probes_b], axis=2).reshape(len(a), -1)
    return events.argmax(axis=1)


def _spanning(n: int, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For links (x, y) among n rows: every linked row and the smallest row of its part (label passing with jumps)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    hit = np.unique(np.concatenate([x, y]))
    return hit, label[hit]


class _Cell:
    """One block pair of a cell: its homes and all that meet there."""

    def __init__(self, rows: dict[str, np.ndarray], how: Lattice, cosine: float):
        self.rows, self.how, self.cosine = rows, how, cosine

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids counted with their links' weight, and forest edges."""
        r = self.rows
        none = np.empty(0, dtype=np.int64)
        h, s = np.flatnonzero(r["home_side"]), np.flatnonzero(~r["home_side"])
        if not len(h) or not len(s):
            return none, none, none, none
        unit = r["unit"]
        i, j = np.nonzero(unit[h] @ unit[s].T >= self.cosine - 1e-12)
        p, q = h[i], s[j]
        # the product of matrices may round otherwise than a sum by pair; the border is decided by the latter
        keep = (r["id"][p] != r["id"][q])
        p, q = p[keep], q[keep]
        if len(p):
            c = np.einsum("ij,ij->i", unit[p], unit[q])
            p, q = p[c >= self.cosine], q[c >= self.cosine]
        if not len(p):
            return none, none, none, none
        small = np.where(r["id"][p] < r["id"][q], p, q)
        large = np.where(r["id"][p] < r["id"][q], q, p)
        event = 2 * r["tab"][p].astype(np.int64) + (p != small)
        once = _first_meeting(r["codes"][small], r["codes"][large]) == event
        small, large = small[once], large[once]
        if not len(small):
            return none, none, none, none
        ids = np.concatenate([r["id"][small], r["id"][large]])
        weight = np.concatenate([r["mult"][large], r["mult"][small]])
        # the forest runs over ids: a vector may stand on both sides
        names, at = np.unique(np.concatenate([r["id"][small], r["id"][large]]), return_inverse=True)
        hit, root = _spanning(len(names), at[:len(small)], at[len(small):])
        return ids, weight, names[hit], names[root]


_FOUND = "id bigint, weight bigint, other bigint"


def _verify(batches: Iterator[pa.RecordBatch], how: Lattice, cosine: float) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (cell, hb, qb): per batch of groups the summed link weights (other null) and forest edges (weight 0)."""
    held: dict[str, np.ndarray] | None = None
    ids, weights, left, right = [], [], [], []

    def flush() -> Iterator[pa.RecordBatch]:
        if ids or left:
            k, at = np.unique(np.concatenate(ids or [np.empty(0, np.int64)]), return_inverse=True)
            w = np.bincount(at, weights=np.concatenate(weights), minlength=len(k)).astype(np.int64) if len(k) else np.empty(0, np.int64)
            e = np.unique(np.stack([np.concatenate(left), np.concatenate(right)]), axis=1) if left else np.empty((2, 0), np.int64)
            e = e[:, e[0] != e[1]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([k, e[0]])), pa.array(np.concatenate([w, np.zeros(e.shape[1], np.int64)])),
                 pa.array([None] * len(k) + e[1].tolist(), pa.int64())], names=["id", "weight", "other"])
        for x in (ids, weights, left, right):
            x.clear()

    def done(rows: dict[str, np.ndarray]) -> None:
        a, w, x, y = _Cell(rows, how, cosine).links()
        if len(a):
            ids.append(a)
            weights.append(w)
            left.append(x)
            right.append(y)

    for b in batches:
        if not b.num_rows:
            continue
        wide = how.tables * (1 + how.probes)
        c = {k: b.column(k).to_numpy(zero_copy_only=False) for k in ("cell", "hb", "qb", "id", "mult", "tab", "home_side")}
        c["unit"] = np.array([np.frombuffer(u.as_buffer(), dtype="<f8") for u in b.column("unit")])
        c["codes"] = np.array([np.frombuffer(u.as_buffer(), dtype="<u8") for u in b.column("codes")]).reshape(-1, how.tables, wide // how.tables)
        if held is not None:
            c = {k: np.concatenate([held[k], v]) for k, v in c.items()}
        new = np.ones(len(c["cell"]), dtype=bool)
        new[1:] = (c["cell"][1:] != c["cell"][:-1]) | (c["hb"][1:] != c["hb"][:-1]) | (c["qb"][1:] != c["qb"][:-1])
        cuts = np.flatnonzero(new)
        for i, j in zip(cuts[:-1], cuts[1:]):
            done({k: v[i:j] for k, v in c.items()})
        held = {k: v[cuts[-1]:].copy() for k, v in c.items()}  # one open group, bounded by its blocks
        yield from flush()
    if held is not None:
        done(held)
    yield from flush()


def near_duplicates(vectors: DataFrame, cosine: float = 0.98, how: Lattice = Lattice(), id_col: str = "vec_id",
                    vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Per row: id, n_links, component_id, kept."""
    numbered = stored(vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("vec"),
                                     F.col(label_col).cast("bigint").alias("label"), F.monotonically_increasing_id().alias("row")), "e8-rows")
    rows = usable(numbered, "id", "vec", "label", "row").where("label is not null")
    rows = rows.withColumn("vec", F.col("vec").cast("array<double>"))
    rows = rows.withColumn("h1", F.xxhash64("label", "vec")).withColumn("h2", F.xxhash64(F.lit(2), "vec", "label"))
    classes = rows.groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.count("*").alias("mult"))
    reps = (rows.join(classes, ["h1", "h2"]).where("id = rep").dropDuplicates(["id", "h1", "h2"])
            .select("id", "label", "mult", "vec"))
    coded = stored(reps.mapInArrow(partial(_code, how=how), _CODED), "e8-codes")
    at = coded.select("id", "codes").mapInArrow(partial(_cell_rows, how=how), "cell bigint, home boolean, tab tinyint, id bigint")
    # cells with a home and something else
    crowd = (at.groupBy("cell").agg(F.sum(F.col("home").cast("int")).alias("homes"), F.count("*").alias("all"))
             .where("homes > 0 and all > 1"))
    blocks = lambda c: F.ceil(F.col(c) / F.lit(how.block)).cast("int")
    live = at.join(crowd, "cell").withColumn("nh", blocks("homes")).withColumn("nq", blocks("all"))
    h = F.col("id")
    homes = (live.where("home").withColumn("hb", F.pmod(F.xxhash64(h), F.col("nh")).cast("int"))
             .withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("nq") - 1))).withColumn("home_side", F.lit(True)))
    others = (live.withColumn("qb", F.pmod(F.xxhash64(h, F.lit(1)), F.col("nq")).cast("int"))
              .withColumn("hb", F.explode(F.sequence(F.lit(0), F.col("nh") - 1))).withColumn("home_side", F.lit(False)))
    cols = ["cell", "hb", "qb", "tab", "id", "home_side"]
    met = homes.select(*cols).unionByName(others.select(*cols)).join(coded.select("id", "mult", "unit", "codes"), "id")
    found = stored(met.repartition("cell", "hb", "qb").sortWithinPartitions("cell", "hb", "qb")
                   .mapInArrow(partial(_verify, how=how, cosine=cosine), _FOUND), "e8-found")
    parts = connected_components(found.where("other is not null").select(F.col("id").alias("a"), F.col("other").alias("b")))
    degree = found.where("other is null").groupBy("id").agg(F.sum("weight").alias("links"))
    by_class = (classes.join(degree.withColumnRenamed("id", "rep"), "rep", "left")
                .join(parts.select(F.col("id").alias("rep"), "component"), "rep", "left")
                .select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"),
                        F.coalesce("component", "rep").alias("component_id")))
    part = rows.select("id", "h1", "h2").join(by_class, ["h1", "h2"]).select("id", "n_links", "component_id")
    alone = (numbered.select("id", "row").join(rows.select("row"), "row", "left_anti")
             .select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id")))
    return (part.unionByName(alone).withColumn("kept", F.col("id") == F.col("component_id")).withColumnRenamed("id", id_col))
