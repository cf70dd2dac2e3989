import random

import pytest

from payflux.llm import mixing

DOCS = "doc_id bigint, text string, source string, size string, copies int"


def fixture():
    rnd = random.Random(1)
    rows = [(i, " ".join("w" * rnd.randint(1, 3) for _ in range(rnd.randint(0, 60))), rnd.choice(["a", "a", "a", "b", "é", None]), "x", 7)
            for i in range(900)]
    rows += [(900, None, "a", None, None), (901, "", "b", None, None), (902, " \t\n ", "b", None, None)]
    rows += [(903, "same text", "b", None, None)] * 3 + [(None, "no id", "a", None, None), (904, "long " * 30_000, "a", None, None)]
    return rows


def levels(sizes: dict, weights=(5, 2, 1)) -> dict:
    """Targets by resharing the excess again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, out, open_ = 1.5 * sum(sizes.values()), {}, set(names)
    while open_:
        rest = total - sum(out.values())
        share = {s: rest * w[s] / sum(w[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not full:
            return out | share
        out |= {s: 2.0 * sizes[s] for s in full}
        open_ -= full
    return out


def test_targets_and_copies(spark):
    rows = fixture()
    docs = spark.createDataFrame(rows, DOCS)
    got = mixing.mix_decisions(docs).collect()
    assert len(got) == len(rows)
    size, taken, target = {}, {}, {}
    by_id = {}
    for i, t, s, *_ in rows:
        n = len((t or "").encode().split())
        size[s] = size.get(s, 0) + n
        by_id.setdefault(i, (n, s))
    expected = levels(size)
    for r in got:
        n, s = by_id[r.doc_id]
        assert r["size"] == n and r.source_size == size[s]
        assert r.target == pytest.approx(expected[s])
        assert r.copies in (0, 1, 2) and r.taken == r.copies * n
        taken[s], target[s] = taken.get(s, 0) + r.taken, r.target
    for s in taken:
        largest = max(len((t or "").encode().split()) for _, t, x, *_ in rows if x == s)
        assert abs(taken[s] - target[s]) <= largest
    again = mixing.mix_decisions(docs.repartition(5)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_rows_are_repeated_and_keep_their_columns(spark):
    docs = spark.createDataFrame(fixture(), DOCS)
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    copies = sum(r.copies for r in mixing.mix_decisions(docs).collect())
    assert abs(out.count() - copies) <= 10  # rows of the same order key may change places
    assert out.where("doc_id = 903").count() <= 6


def test_empty_and_wordless_tables(spark):
    assert mixing.mix_decisions(spark.createDataFrame([], DOCS)).count() == 0
    got = mixing.mix_decisions(spark.createDataFrame([(1, None, None, None, None), (2, " ", "a", None, None)], DOCS)).collect()
    assert [(r.target, r.taken) for r in got] == [(0.0, 0), (0.0, 0)]
