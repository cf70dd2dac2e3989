"""Spelling variants, periodic runs and URL rules against brute force; lost rows and clashing names of the others."""

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from payflux.llm import arc, common, embed_dedup, mixing, packing, periodic_runs, spelling, toxicity, url_rules

# ---- spelling variants


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[k + (len(a) == len(b)):] == b[k + 1:]


def brute_variants(rows, length, least, ratio, plant):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            if plant:
                h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
                if h % 31 == 0:
                    run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= length:
                n[run] += 1
    n = {w: k for w, k in n.items() if k >= least}
    near = {w: sorted((x for x in n if one_edit(w, x)), key=lambda x: (-n[x], x)) for w in n}
    form = {w: near[w][0] if near[w] and n[near[w][0]] >= ratio * n[w] else None for w in n}
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def word_rows():
    rnd = random.Random(9)
    base = ["abcdefgh", "abcdefghi", "Straßenbahn", "ÀÉÎõüÿabc", "zzzzzzz", "zzzzzzzz", "aaaaaaaab", "naïveté", "ABCDEFGX"]
    rows = []
    for i in range(300):
        words = []
        for _ in range(rnd.randint(0, 40)):
            w = rnd.choice(base[:rnd.choice([1, 2, 9])])
            if rnd.random() < 0.2:
                k = rnd.randrange(len(w))
                w = rnd.choice([w[:k] + w[k + 1:], w[:k] + rnd.choice("abzé×÷") + w[k:], w[:k] + rnd.choice("abzé") + w[k + 1:]])
            words.append(w)
        rows.append((i, rnd.choice([" ", ", ", "1", "\n"]).join(words)))
    return rows + [(None, "abcdefgh " * 30), (301, None), (302, ""), (303, "abcdefgh" * 500), rows[5], rows[5]]


@pytest.mark.parametrize("room, plant", [(16, True), (0, False)])
def test_variants(spark, room, plant):
    common.shipped(spark)
    rows = word_rows()
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id bigint, text string, word string, n int").repartition(5)
    got = spelling.variants(docs, room=room, plant=plant)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = brute_variants(rows, 7, 2, 10, plant)
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))
    assert sum(r[1] is not None for r in want) > 20 and any(r[2] not in (r[0], r[1]) for r in want) or not plant


def test_variants_empty(spark):
    for rows in ([], [(1, None), (2, "short words only")]):
        assert spelling.variants(spark.createDataFrame(rows, "doc_id bigint, text string")).count() == 0


def test_neighbourhood_is_full():
    rng = np.random.default_rng(1)
    for symbols in (2, 4, 9):
        rows = rng.integers(1, symbols + 1, size=(5, 6)).astype(np.uint64)
        key = lambda w: int(common.mix(spelling.hashes(np.array([w], dtype=np.uint64)))[0])
        for row, keys in zip(rows.tolist(), spelling.neighbourhood(rows, symbols)):
            want = {key(row)} | {key(row[:i] + row[i + 1:]) for i in range(6)}
            want |= {key(row[:i] + [s] + row[i + d:]) for d in (0, 1) for i in range(7 - d) for s in range(1, symbols + 1)}
            assert set(keys.tolist()) == want


# ---- periodic runs

def brute_runs(words, least=24, repeats=3):
    found = {}
    for q in range(1, len(words) // repeats + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i - s + q >= max(least, repeats * q):
                found.setdefault((s, i - s + q), q)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def run_texts(rnd, texts):
    out = []
    for _ in range(texts):
        n, k = rnd.randint(0, 150), rnd.choice([1, 2, 3, 5, 30])
        w = [str(rnd.randrange(k)).encode() for _ in range(n)]
        if rnd.random() < 0.4 and n:
            unit = w[:rnd.randint(1, 9)]
            w = w + unit * rnd.randint(1, 20) + unit[:2]
        out.append(w)
    return out


def test_runs_of_random_texts():
    rnd = random.Random(3)
    for _ in range(150):
        texts, least, repeats = run_texts(rnd, rnd.randint(1, 6)), rnd.choice([2, 6, 24]), rnd.choice([2, 3, 4])
        assert periodic_runs.runs_of(texts, least, repeats) == [brute_runs(t, least, repeats) for t in texts]


def test_planted_is_the_contract():
    words = [str(i).encode() for i in range(200)]
    for doc in range(60):
        h = zlib.crc32(str(doc).encode())
        want, n, g = list(words), len(words), h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            want = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        assert periodic_runs.planted(words, doc) == want
    assert periodic_runs.planted(words, None) == words and periodic_runs.planted([], 4) == []


@pytest.mark.parametrize("plant", [True, False])
def test_periodic_runs(spark, plant):
    common.shipped(spark)
    rows = [(i, b" ".join(t).decode(), "x", i) for i, t in enumerate(run_texts(random.Random(5), 120))]
    rows += [(500, None, None, None), (501, "", "", 1), (502, " \n\t ", "", 1), (503, "a b c " * 5000 + "end", "x", 1), (None, "x " * 40, "x", 1), rows[7], rows[7]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, row string, `start` int").repartition(3)
    got = periodic_runs.periodic_runs(docs, plant=plant)
    assert got.columns == ["doc_id", "row", *periodic_runs.RESULTS.names]
    want = []
    for i, t, row, _ in rows:
        words = (t or "").encode().split()
        words = periodic_runs.planted(words, i) if plant else words
        runs = brute_runs(words)
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
        want.append((i, row, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2],
                     hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
                     hashlib.sha256(b" ".join(w for k, w in enumerate(words) if k not in gone)).hexdigest()))
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0


# ---- URL rules

def brute_judge(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S).groups()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [(len(h + p), len(h), h + p, v) for h, p, v in rules if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
    if not fit:
        return host, path, None, "allow"
    return host, path, *max(fit)[2:]


RULES = url_rules.RULES + [("a.example.org", "", "allow"), ("example.org", "/en/12", "allow"), ("b", "/", "block"), ("b", "/", "allow"), ("x..y", "/q", "block")]
URLS = ["http://example.org/es/a", "https://A.Example.ORG/es/", "http://example.org/en/1", "http://example.org/en/12/3", "http://example.org", "http://org/x?y",
        "http://notexample.org/es/", "http://a.com/fr/", "http://com/de/x#f", "http://com/DE/", "x://b/", "http://u@c.b/", "http://x..y/q", "http://.org/", "http://org./",
        "nothing", "", None, "://", "http:///path", "a://b/://c", "http://example.org:80/es/", "HTTP://com/de/" + "z" * 100_000, "http://a.example.org", "http://é.org/\n/x"]


@pytest.mark.parametrize("broadcast", [100, 0])
def test_url_rules(spark, broadcast):
    rows = [(i, u, "x", "y", 1) for i, u in enumerate(URLS)] + [(None, URLS[0], None, None, None), (0, URLS[0], "x", "y", 1)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, short string, row string, salt int")
    rules = url_rules.rules_of(spark, RULES + [(None, "/", "block"), ("", "/", "block"), ("org", "x", "block"), ("org", "/", "maybe"), ("net", None, "block")])
    got = url_rules.judge(pages, rules, broadcast_rules=broadcast)
    assert got.columns == [*pages.columns, "host", "path", "rule", "verdict"]
    want = [(*r, *brute_judge(r[1], RULES)) for r in rows]
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))


def test_url_rules_empty(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")], "host bigint, url string")
    none = url_rules.rules_of(spark, [])
    assert [tuple(r) for r in url_rules.judge(pages, none, otherwise="block").collect()] == [("http://a.org/", "a.org", "/", None, "block")]
    assert url_rules.judge(pages.limit(0), url_rules.rules_of(spark, RULES)).count() == 0


def test_url_rules_run_without_python(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id bigint, url string")
    plan = url_rules.judge(pages, url_rules.rules_of(spark, RULES))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


# ---- no row lost, no name taken

def test_vectors_that_share_an_id_stay(spark):
    common.shipped(spark)
    v = [1.0] + [0.0] * 63
    rows = [(1, v, 1, "a"), (1, None, 1, "b"), (1, v, None, "c"), (2, v, 1, "d"), (2, [0.0] * 64, 1, "e"), (None, v, 1, "f"), (3, [float("nan")] * 64, 1, "g")]
    got = embed_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int, row string")).collect()
    assert len(got) == len(rows)
    assert sorted((r.vec_id or 0, r.n_links) for r in got) == [(0, 0), (1, 0), (1, 0), (1, 1), (2, 0), (2, 1), (3, 0)]


def test_pages_whose_url_looks_like_a_version_block(spark, tmp_path):
    common.shipped(spark)
    pages = spark.createDataFrame([(1, "http://a/", "one"), (2, "filedesc:x", "two"), (3, "filedesc://pages.arc", "three")], "page_id bigint, url string, html string").coalesce(1)
    arc.write_arc(pages, f"{tmp_path}/arc")
    arc.write_warc(arc.convert(arc.read_arc(spark, f"{tmp_path}/arc")), f"{tmp_path}/warc")
    assert {r.key for r in arc.resolved(arc.read_warc(spark, f"{tmp_path}/warc")).collect()} == {1, 2, 3}


def test_unreadable_archives_fail(spark, tmp_path):
    common.shipped(spark)
    (tmp_path / "arc").mkdir()
    (tmp_path / "arc" / "a.arc").write_bytes(b"filedesc://a 0.0.0.0 20000101000000 text/plain 77\ncut off")
    records = arc.read_arc(spark, f"{tmp_path}/arc")
    with pytest.raises(Exception, match="unreadable ARC record"):
        arc.convert(records).collect()
    assert arc.convert(records, skip_errors=True).count() == 0


def test_sample_is_bounded_in_rows(spark):
    """An id that stands very often is learnt from once; the weights are those of a plain FTRL loop."""
    common.shipped(spark)
    rnd = random.Random(4)
    docs = [(i, " ".join(rnd.choice(["bad", "worse", "vile"] if i % 3 == 0 else ["good", "fine", "kind"]) for _ in range(12))) for i in range(60)]
    s = toxicity.Settings(rows=40, seen=1, passes=2, l1=0.5)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in docs], "doc_id bigint, toxic int")
    at, w = toxicity.train(spark.createDataFrame(docs + [docs[0]] * 3000 + [(0, "another text")], "doc_id bigint, text string"), labels, s, learn="true")
    again = toxicity.train(spark.createDataFrame(docs + [(0, "another text")], "doc_id bigint, text string"), labels, s, learn="true")
    assert at.tolist() == again[0].tolist() and w.tolist() == again[1].tolist()

    import pyarrow as pa
    order = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("doc_id", "text", "xxhash64(doc_id) h").orderBy("h").limit(40).collect()
    z, n = Counter(), Counter()
    weight = lambda i: 0.0 if abs(z[i]) <= s.l1 else -(z[i] - np.sign(z[i]) * s.l1) / ((s.beta + n[i] ** 0.5) / s.alpha + s.l2)
    for _ in range(s.passes):
        for r in order:
            idx = [0, *sorted(set(toxicity.features(pa.array([r.text]), s.bits)[0].tolist()))]
            ws = [weight(i) for i in idx]
            g = 1 / (1 + np.exp(-sum(ws))) - int(r.doc_id % 3 == 0)
            for i, wi in zip(idx, ws):
                z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / s.alpha * wi
                n[i] += g * g
    at, w = toxicity.train(spark.createDataFrame(docs, "doc_id bigint, text string"), labels, s, learn="true")
    want = {i: weight(i) for i in z if weight(i)}
    assert len(want) > 10 and sorted(want) == at.tolist() and np.allclose([want[i] for i in at.tolist()], w)


def test_mix_and_pack_keep_columns_of_any_name(spark):
    common.shipped(spark)
    names = ["doc_id", "text", "source", "row", "_row_", "_copies_", "_copy_", "doc", "copies"]
    rows = [(i, "a b c d", "s", *range(6)) for i in range(8)]
    got = mixing.mix(spark.createDataFrame(rows, names))
    assert got.columns == names and {tuple(r) for r in got.collect()} <= set(rows) and got.count() >= 8
    names = ["length", "sequence_id", "offset", "_block_", "_row_", "block", "row", "piece"]
    out = packing.pack(spark.createDataFrame([(700, 1, 2, 3, 4, 5, 6, k) for k in range(9)], names))
    assert out.columns == ["length", "_block_", "_row_", "block", "row", "piece", "sequence_id", "offset"]
    got = out.collect()
    assert sorted(r.piece for r in got) == list(range(9)) and len({(r.sequence_id, r.offset) for r in got}) == 9
