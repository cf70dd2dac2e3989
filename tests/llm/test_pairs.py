"""Near-duplicate operators against brute force: sets of shingles, repeated windows, lines, vectors."""

import hashlib
import math
import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from payflux.llm import ann, common, embed_dedup, jaccard, line_dedup, substring

DOCS = "doc_id bigint, text string, id string, pos string"


def components(ids, links):
    up = {i: i for i in ids}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i
    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


def texts(seed=3):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    passage = [rnd.choice(vocab) for _ in range(60)]
    out = []
    for _ in range(40):
        out.append([rnd.choice(vocab) for _ in range(rnd.choice([1, 3, 4, 5, 9, 30, 80, 300]))])
    for _ in range(80):  # near copies with a few words changed, added or cut
        t = list(rnd.choice(out))
        for _ in range(rnd.randint(0, 3)):
            t[rnd.randrange(len(t))] = rnd.choice(vocab)
        out.append(t + [rnd.choice(vocab)] * rnd.randint(0, 2))
    for _ in range(15):  # a common passage
        t = [rnd.choice(vocab) for _ in range(rnd.randint(0, 80))]
        k = rnd.randint(0, len(t))
        out.append(t[:k] + passage + t[k:])
    out += [["x"] * 200, ["a", "b"] * 90, vocab * 12]
    rows = [(i, rnd.choice([" ", "\n", "\t "]).join(t), "x", None) for i, t in enumerate(out)]
    n = len(rows)
    rows += [(n + 1, None, None, None), (n + 2, "", None, None), (n + 3, " \n ", None, None), (n + 4, rows[0][1].upper(), None, None)]
    rows += [rows[5], rows[5], (None, rows[7][1], None, None)]
    return rows


def shingles(t):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


@pytest.mark.parametrize("light", [None, 0, 40, 400])
def test_jaccard(spark, monkeypatch, light):
    if light is not None:  # any boundary gives the same links
        monkeypatch.setattr(jaccard, "boundary", lambda *a: light)
    common.shipped(spark)
    rows = texts()
    got = jaccard.clusters(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == len(rows)
    sets = {i: shingles(t) for i, t, *_ in rows if i is not None}
    links = [(a, b) for a, b in combinations(sets, 2) if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    part = components(sets, links)
    assert len(links) > 30
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.n_shingles > 0
        else:
            assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), part[r.doc_id]), r


def test_jaccard_empty(spark):
    assert jaccard.clusters(spark.createDataFrame([], DOCS)).count() == 0


def test_jaccard_lists_keep_what_may_link():
    """A list of two in one size band is left to its star pair; every other possible pair keeps both its rows."""
    rnd = np.random.default_rng(5)
    num, den, light = 80, 100, 0
    rows, i = [], 0
    for key in range(400):
        for _ in range(rnd.integers(1, 30) if key % 40 == 0 else rnd.integers(1, 5)):
            rows.append((key, 0, i, int(rnd.integers(40, 70)), int(rnd.integers(0, 12))))
            i += 1
    key, kind, ids, n, pos = (np.array(c) for c in zip(*rows))
    ords = (np.floor(np.log(n) / np.log(den / num)).astype(np.int64) << 48) | (pos << 24) | ids
    order = np.lexsort((ords, kind, key))
    whole = pa.RecordBatch.from_arrays(
        [pa.array(key[order]), pa.array(kind[order], pa.int8()), pa.array(ords[order]), pa.array(ids[order]), pa.array(n[order], pa.int32()),
         pa.array(pos[order], pa.int32())], names=["key", "kind", "ord", "id", "n", "pos"])
    got = [r for b in jaccard._stars((whole.slice(k, 64) for k in range(0, len(key), 64)), num, den, light) for r in b.to_pylist()]
    star = {(r["key"], *sorted((r["id"], r["mate"]))) for r in got if r["mate"] != r["id"]}
    more = {(r["key"], r["id"]) for r in got if r["more"]}
    lists = {}
    for r in whole.to_pylist():
        lists.setdefault(r["key"], []).append(r)
    possible = 0
    for k, members in lists.items():
        for a, b in combinations(members, 2):
            x, y = ({c: np.array([r[c]]) for c in ("kind", "n", "pos", "id")} for r in (a, b))
            if jaccard._bounded(x, y, num, den, light)[0]:
                possible += 1
                assert (k, *sorted((a["id"], b["id"]))) in star or {(k, a["id"]), (k, b["id"])} <= more
    assert possible > 200 and len(more) < 0.75 * len(key)


def test_jaccard_bitmaps_lose_no_link():
    """The bound from bitmaps holds for every pair, and leaves out pairs that share little."""
    rnd = np.random.default_rng(6)
    pairs = []
    for n in (2, 5, 40, 300, 3000):
        for share in (0.1, 0.5, 0.85, 0.95, 1.0):
            both = rnd.integers(0, 1 << 62, max(1, int(n * share)))
            pairs.append([np.unique(np.concatenate([both, rnd.integers(0, 1 << 62, n - len(both))])) for _ in range(2)])

    def marks(h):
        bits = np.zeros(jaccard.MARKS, dtype=bool)
        bits[h % jaccard.MARKS] = True
        return np.packbits(bits).tobytes()

    batch = pa.RecordBatch.from_arrays([pa.array(range(len(pairs)), pa.int64()), pa.array(range(len(pairs)), pa.int64()),
                                        pa.array([len(x) for x, _ in pairs], pa.int32()), pa.array([len(y) for _, y in pairs], pa.int32()),
                                        pa.array([marks(x) for x, _ in pairs]), pa.array([marks(y) for _, y in pairs])], names=["a", "b", "n", "m", "x", "y"])
    left = set(next(jaccard._hopeful(iter([batch]), 80, 100)).column("a").to_pylist())
    linked = {k for k, (x, y) in enumerate(pairs) if 100 * len(np.intersect1d(x, y)) >= 80 * len(np.union1d(x, y))}
    assert linked and linked <= left and len(left) < len(pairs)


def test_jaccard_reads_candidates_without_a_shuffle(spark):
    """The texts of candidate pairs are found by a bitmap of ids of a fixed size."""
    ids = spark.range(0, 4000, 7).select("id")
    bits = jaccard.bitmap(ids)
    assert bits.nbytes == 1 << (jaccard.ID_BITS - 3)
    at = np.array([r.at for r in ids.select(jaccard._place(jaccard.ID_BITS).alias("at")).collect()])
    assert ((bits[at >> 6] >> (at & 63)) & 1).all() and sum(int(x).bit_count() for x in np.unique(bits[at >> 6])) <= 64 * len(at)
    named = spark.createDataFrame([(i, f"text of the document number {i}") for i in range(60)] + [(None, "none")], "id bigint, text string")
    pairs = spark.createDataFrame([(0, 7), (7, 14)], "a bigint, b bigint")
    got = {r.id for r in jaccard._members(named, pairs, 5).collect()}
    assert {0, 7, 14} <= got and len(got) < 10


def test_components_leave_one_table(spark):
    """Every round's table goes when the next one stands; chains, stars and rings have their smallest id."""
    before = len(common.WRITTEN)
    links = [(i, i + 1) for i in range(10, 60)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 202), (202, 200), (7, 7)] + [(300, 301)] * 3
    got = {r.id: r.component for r in common.connected_components(spark.createDataFrame(links + [(None, 1)], "a bigint, b bigint")).collect()}
    want = {i: 10 for i in range(10, 61)} | {i: 100 for i in range(100, 140)} | {i: 200 for i in (200, 201, 202)} | {300: 300, 301: 300}
    assert got == want
    assert len(common.WRITTEN) == before + 1


def test_boundary_follows_cost():
    sets = [(n, 100, 0) for n in range(4, 60)]
    assert jaccard.boundary(sets, 80, 100) < 20  # lists that meet nothing are cheaper than subsets
    crowded = [(n, 100, 10**7) for n in range(4, 60)]
    assert jaccard.boundary(crowded, 80, 100) >= 40


def test_covers():
    for period, cover in substring.COVERS.items():
        for d in range(period):
            assert any((c + d) % period in cover for c in cover)


def brute_windows(rows, width):
    words = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for _, t, *_ in rows]
    seen = Counter(tuple(w[i:i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i:i + width])] > 1:
                gone[i:i + width] = [True] * width
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("width", [35, 18, 4])
def test_repeated_windows(spark, width):
    common.shipped(spark)
    rows = texts(4)
    got = substring.remove_repeats(spark.createDataFrame(rows, DOCS), width, digest=True).collect()
    want = sorted((r[0] is not None, r[0] or 0, *x) for r, x in zip(rows, brute_windows(rows, width)))
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_words, r.n_removed, r.kept_sha256) for r in got) == want


def test_texts_without_id_are_told_apart(spark):
    common.shipped(spark)
    passage = " ".join(f"p{k}" for k in range(40))
    some = spark.range(200_000).selectExpr(f"concat('a', id, ' {passage}') as a", "concat('b', id) as b")
    met = some.selectExpr("a", "hash(a, true) as h").join(some.selectExpr("b", "hash(b, true) as h"), "h").first()  # equal in 32 bits
    rows = [(None, met.a, "x", None), (None, met.b, "x", None), (1, passage, "x", None)]
    got = substring.remove_repeats(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((r.n_words, r.n_removed, r.kept) for r in got) == [(1, 0, met.b), (40, 40, ""), (41, 40, met.a.split(" ")[0])]


def test_repeated_windows_empty(spark):
    assert substring.remove_repeats(spark.createDataFrame([], DOCS)).count() == 0


# ---- lines

def normal(line):
    return re.sub(r"[\s!-/:-@\[-`{-~]+", " ", line.lower()).strip()


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def line_rows():
    rnd = random.Random(7)
    base = [" ".join(f"word{rnd.randrange(500)}" for _ in range(n)) for n in (1, 2, 5, 12, 30, 60, 60, 90)]
    rows = []
    for i in range(40):
        lines = []
        for _ in range(rnd.randint(0, 6)):
            line = rnd.choice(base).split(" ")
            if rnd.random() < 0.6:
                line[rnd.randrange(len(line))] = f"other{rnd.randrange(40)}"
            lines.append(rnd.choice(["{}", " {} ", "{}!", "- {}"]).format(" ".join(line)).title())
        rows.append((i, "\n".join(lines), None, None))
    return rows + [(60, None, None, None), (61, "", None, None), (62, "---\n\n---\n***", None, None), (None, base[4] + "\nfresh line", None, None),
                   rows[3], (63, "one very long line " * 400, None, None), (64, "One very long line " * 400 + "end", None, None)]


def line_links(names):
    """Pairs of an edit similarity of at least 0.8."""
    out = []
    for a, b in combinations(range(len(names)), 2):
        x, y = names[a], names[b]
        most = math.floor(max(len(x), len(y)) * 0.2 + 1e-9)
        if abs(len(x) - len(y)) <= most and sum((Counter(x) - Counter(y)).values()) <= most and edits(x, y) <= most:
            out.append((a, b))
    return out


@pytest.mark.parametrize("crowd, many", [(64, 64), (3, 64), (3, 3)])
def test_lines(spark, monkeypatch, crowd, many):
    """With as many SimHashes as find every link, the result is that of brute force, with large keys and small ones."""
    monkeypatch.setattr(line_dedup, "CROWD", crowd)
    monkeypatch.setattr(line_dedup, "MANY", many)
    monkeypatch.setattr(line_dedup, "_OF", 1)
    monkeypatch.setattr(line_dedup, "FAR", 128)
    monkeypatch.setattr(line_dedup, "_KEYS_AT_ONCE", 96)
    monkeypatch.setattr(line_dedup, "scheme", lambda *a: (6, 16, 1))
    rows = line_rows()
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, DOCS))
    assert got.columns == ["doc_id", "text", "id", "pos", "n_lines", "n_removed"]
    last = 1 << 63
    first = {}
    for i, t, *_ in rows:
        for k, line in enumerate((t or "").split("\n") if t is not None else []):
            if n := normal(line):
                first[n] = min(first.get(n, (last + 1, 0)), (last if i is None else i, k))
    names = sorted(first, key=first.get)
    links = line_links(names)
    part = components(range(len(names)), links)
    assert len(links) > 5
    place = {n: first[names[part[k]]] for k, n in enumerate(names)}
    want = []
    for i, t, *_ in rows:
        lines = t.split("\n") if t is not None else []
        keep = [x for k, x in enumerate(lines) if not normal(x) or place[normal(x)] == (last if i is None else i, k)]
        want.append((str(i), len(lines), len(lines) - len(keep), None if t is None else "\n".join(keep)))
    mine = [(str(r.doc_id), r.n_lines, r.n_removed, r.text) for r in got.collect()]
    assert sorted(map(str, mine)) == sorted(map(str, want))


def test_recall_of_near_lines(spark, monkeypatch):
    """With the scheme of 2.5 million lines: recall by length and kind of edit, against edit similarity alone."""
    rnd = random.Random(11)
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda: "".join(rnd.choice(letters) for _ in range(rnd.randint(2, 9)))
    rows, pairs = [], {}
    for size in ((4, 7), (8, 15), (16, 31), (32, 80)):
        for kind in ("word", "letters"):
            for _ in range(50):
                words = [word() for _ in range(rnd.randint(*size))]
                a = b = " ".join(words)
                if kind == "word":
                    words[rnd.randrange(len(words))] = word()
                    b = " ".join(words)
                else:
                    typos = list(a)
                    for k in rnd.sample([k for k, c in enumerate(a) if c != " "], max(1, len(a) // 40)):
                        typos[k] = rnd.choice(letters)
                    b = "".join(typos)
                if a != b:
                    if line_links([a, b]):
                        pairs[len(rows) + 1] = (size, kind)
                    rows += [(len(rows), a), (len(rows) + 1, b)]
    scheme = line_dedup.scheme
    monkeypatch.setattr(line_dedup, "_KEYS_AT_ONCE", 32)
    monkeypatch.setattr(line_dedup, "scheme", lambda n, *a: scheme(2_500_000, *a))
    gone = {r.doc_id for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).where("n_removed > 0").collect()}
    assert gone <= set(pairs)  # no line goes that brute force keeps
    found = {c: np.mean([k in gone for k in pairs if pairs[k] == c]) for c in sorted(set(pairs.values()))}
    print(found)
    assert found[(16, 31), "word"] >= 0.95 and found[(32, 80), "word"] >= 0.95 and found[(8, 15), "word"] >= 0.75
    assert min(found.values()) >= 0.4 and np.mean(list(found.values())) >= 0.8


def test_scheme_keeps_recall_as_lines_grow():
    for n in (0, 1, 500, 10**6, 10**8, 10**10):
        count, blocks, r = line_dedup.scheme(n, 0.867, 0.85)
        same = 0.867 ** (64 / blocks)
        miss = sum(math.comb(blocks, i) * same ** i * (1 - same) ** (blocks - i) for i in range(r))
        assert 1 - miss ** count >= 0.85 and 64 * r / blocks >= min(60, math.log2(n + 1)) - 1


def test_lines_with_inner_names_as_columns(spark):
    names = ["doc_id", "text", "row", "lead", "gone", "rest", "id", "pos", "line", "n_lines", "a.b"]
    rows = [(1, "one line of words\nanother thing", *("abcdefgh"), 7), (2, "one line of words", *("abcdefgh"), 7)]
    frame = spark.createDataFrame(rows, names)
    got = line_dedup.dedup_lines(frame)
    assert got.columns == [c for c in names if c != "n_lines"] + ["n_lines", "n_removed"]
    assert sorted((r.doc_id, r.text, r.row, r.gone, r["a.b"], r.n_lines, r.n_removed) for r in got.collect()) == [
        (1, rows[0][1], "a", "c", 7, 2, 0), (2, "", "a", "c", 7, 1, 1)]
    assert line_dedup.dedup_lines(frame, counts=False).columns == names


def test_lines_of_rows_that_share_an_id(spark):
    same, other = "one common line of words", "a line that stands nowhere else"
    rows = [(None, same, "a", None), (None, other, "b", None), (1, same, "c", None),  # null ids are rows of their own
            (5, f"{same}\nfirst of five", "d", None), (5, "wholly unlike it\nsecond text here", "e", None), (5, "wholly unlike it\nand more", "f", None)]
    got = {r.id: (r.text, r.n_lines, r.n_removed) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, DOCS).coalesce(1)).collect()}
    assert got == {"a": ("", 1, 1), "b": (other, 1, 0), "c": (same, 1, 0), "d": ("first of five", 2, 1),
                   "e": ("wholly unlike it\nsecond text here", 2, 0), "f": ("and more", 2, 1)}


@pytest.mark.parametrize("crowd", [16, 1000])
def test_lines_of_a_family_cost_its_size(spark, monkeypatch, crowd):
    """A line is verified with few of its family, whether its keys are crowded or not; all the family is one group."""
    verified, seen = line_dedup._verified, []
    monkeypatch.setattr(line_dedup, "_verified", lambda pairs, *a: (seen.append(pairs.count()), verified(pairs, *a))[1])
    monkeypatch.setattr(line_dedup, "CROWD", crowd)
    monkeypatch.setattr(line_dedup, "_OF", 1)
    monkeypatch.setattr(line_dedup, "_KEYS_AT_ONCE", 16)
    monkeypatch.setattr(line_dedup, "scheme", lambda *a: (2, 16, 1))
    words = [f"w{i * 7919 % 10007}x" for i in range(60)]
    rows = [(i, " ".join([*words[:i % 60], f"other{i}", *words[i % 60 + 1:]])) for i in range(90)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert [r.doc_id for r in got if not r.n_removed] == [0]
    assert sum(seen) <= 4 * len(rows)  # all pairs are 4005


def test_simhashes_of_many_features(spark):
    """Bits that more than half of the features have, counted in groups of SimHashes and narrow or wide counters alike."""
    from pyspark.sql import functions as F

    rnd = random.Random(3)
    texts = [" ".join(f"{rnd.randrange(10**6):06d}" for _ in range(n)) for n in (1, 2, 3, 4, 7, 8, 40, 200)]
    lines = spark.createDataFrame([(i, i, 0, t) for i, t in enumerate(texts)], "id bigint, row bigint, pos int, line string").coalesce(1)
    named = lines.select("row", line_dedup.words_of("line").alias("words")).select("row", F.explode(line_dedup.features("words")).alias("f"))
    hashes = named.select("row", *[F.xxhash64("f", F.lit(s)).alias(f"s{s + 1}") for s in range(5)]).collect()
    want = {}
    for row in range(len(texts)):
        for s in range(1, 6):
            mine = [r[f"s{s}"] for r in hashes if r.row == row]
            bits = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in mine) > len(mine) // 2)
            want[row, s] = bits - (1 << 64) if bits >> 63 else bits
    for count, lane in ((5, 16), (2, 32)):
        got = {(r.row, s): r[f"s{s}"] for r in line_dedup._simhashes(lines, count, lane).collect() for s in range(1, count + 1)}
        assert got == {k: v for k, v in want.items() if k[1] <= count}


def test_simhash_counters_are_dealt_to_more_tasks_as_lines_grow(spark, monkeypatch):
    rows = spark.createDataFrame([(0, 0, "some line of words")], "row bigint, id bigint, text string")
    monkeypatch.setattr(line_dedup, "_COUNTERS", 10)
    plan = line_dedup.simhashes(rows, 2, lines=10_000)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [row" in plan and ", 2000" in plan


def test_first_pairs_of_lines_are_made_in_parts(spark, monkeypatch):
    """Leaders and the first keys are jobs of their own, so their shuffle files don't stand together; texts are cut once a row."""
    made, tables = [], []
    first_met, parts = line_dedup._first_met, line_dedup.stored_parts
    monkeypatch.setattr(line_dedup, "_first_met", lambda forms, keys, *a: (made.append(len(keys)), first_met(forms, keys, *a))[1])
    monkeypatch.setattr(line_dedup, "stored_parts", lambda frames, name: (tables.append(len(frames)), parts(frames, name))[1])
    monkeypatch.setattr(line_dedup, "scheme", lambda *a: (2, 4, 1))
    rows = [(0, "a line of some words here\nwhat nobody else says"), (1, "a line of some words here\nthird")]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert made == [2, 2] and tables == [3, 2]
    assert "lambdafunction(split(" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.doc_id, r.text, r.n_lines, r.n_removed) for r in got.collect()) == [(0, rows[0][1], 2, 0), (1, "third", 2, 1)]


def test_lines_empty(spark):
    assert line_dedup.dedup_lines(spark.createDataFrame([], DOCS)).count() == 0


# ---- vectors

VECTORS = "vec_id bigint, embedding array<float>, label int, id string"


def vectors(n=600, dims=64, seed=5):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims)) * rng.uniform(0.5, 3, size=(n, 1))
    for k in range(n // 3, n):  # near and exact copies
        x[k] = x[rng.integers(0, n // 3)] * rng.uniform(0.5, 2) + rng.normal(size=dims) * rng.choice([0.0, 0.01, 0.05, 0.1, 0.2])
    rows = [(i, v.astype(np.float32).tolist(), int(i % 3), "x") for i, v in enumerate(x)]
    bad = [None, [], [0.0] * dims, [None] + [1.0] * (dims - 1), [float("nan")] * dims, [float("inf")] + [1.0] * (dims - 1), [1.0, 2.0]]
    rows += [(n + i, v, 1, None) for i, v in enumerate(bad)]
    rows += [(n + 20 + i, rows[0][1], rows[0][2], None) for i in range(3)] + [(n + 30, rows[0][1], None, None), (None, rows[0][1], 0, None)]
    return rows


def test_vectors(spark):
    common.shipped(spark)
    rows = vectors()
    got = {r.vec_id: r for r in embed_dedup.near_duplicates(
        spark.createDataFrame(rows, VECTORS), how=embed_dedup.Lattice(block=64)).collect()}
    assert len(got) == len(rows)
    good = {i: np.array(v, dtype=float) for i, v, lab, _ in rows if i is not None and lab is not None and v and len(v) == 64
            and None not in v and np.isfinite(v).all() and any(v)}
    lab = {i: x for i, _, x, _ in rows}
    links = [(a, b) for a, b in combinations(good, 2) if lab[a] == lab[b]
             and good[a] @ good[b] / np.sqrt((good[a] @ good[a]) * (good[b] @ good[b])) >= 0.98]
    assert len(links) > 100
    part = components([i for i in got if i is not None], links)
    degree = Counter(i for x in links for i in x)
    for i, r in got.items():
        if i is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, None)
        else:
            assert (r.n_links, r.component_id, r.kept) == (degree[i], part[i], part[i] == i)


def test_e8_decoding_is_nearest():
    rng = np.random.default_rng(2)
    y = rng.normal(size=(200, 8)) * 2
    best = embed_dedup.nearest_e8(y)
    roots = embed_dedup.shortest_vectors()
    assert roots.shape == (240, 8)
    distance = ((y - best) ** 2).sum(axis=1)
    assert (((y[:, None] - best[:, None] - roots[None]) ** 2).sum(axis=2).min(axis=1) >= distance - 1e-9).all()


def test_vectors_empty(spark):
    assert embed_dedup.near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0
    assert ann.nearest(spark.createDataFrame([], VECTORS), spark.createDataFrame([], VECTORS)).count() == 0


@pytest.mark.parametrize("n", [12, 600])
def test_nearest(spark, n):
    common.shipped(spark)
    rows = vectors(n)
    data = spark.createDataFrame(rows, VECTORS)
    got = ann.nearest(data, data.where("vec_id % 20 = 0"), how=ann.Collisions(block=200, queries=16)).collect()
    good = {i: np.array(v, dtype=float) for i, v, _, _ in rows if i is not None and v and len(v) == 64
            and None not in v and np.isfinite(v).all() and any(v)}
    hit = total = 0
    for q in (i for i in good if i % 20 == 0):
        score = {i: float(good[i] @ good[q]) for i in good if i != q}
        best = sorted(score, key=lambda i: (-score[i], i))[:20]
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, len(best) + 1))
        assert all(r.score == pytest.approx(score[r.vec_id], abs=1e-9) for r in mine)
        assert [(-r.score, r.vec_id) for r in mine] == sorted((-r.score, r.vec_id) for r in mine)
        hit, total = hit + len({r.vec_id for r in mine} & set(best)), total + len(best)
    assert hit >= 0.9 * total
