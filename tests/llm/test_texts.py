"""Archives, packing, toxicity, token counts and the pipeline."""

import base64
import gzip
import hashlib
import io
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from payflux.llm import arc, common, packing, queries, token_counts, toxicity

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, length string, score string, block int"
VOCAB = public_tokenizers.path("word_bpe_49k.json")


def texts():
    rnd = random.Random(2)
    rows = [(i, " ".join(rnd.choice(["Hello", "wörld", "don't", "x1y2", "ção", "…", "naïve-ish", "12345"]) for _ in range(rnd.randint(0, 400))),
             "x", "y", 1) for i in range(150)]
    return rows + [(150, None, None, None, None), (151, "", None, None, None), (152, "word " * 9000, None, None, None),
                   (153, "x" * 20_000, None, None, None), rows[4], rows[4], (None, "no id", None, None, None)]


# ---- ARC and WARC

PAGES = "page_id bigint, url string, html string, kind string, best string"


def test_arc_to_warc(spark, tmp_path):
    common.shipped(spark)
    rows = [(i, f"http://a.example/{i}", f"<p>page {i % 40} é</p>" + "\n\nURL " * (i % 5), "x", None) for i in range(120)]
    rows += [(200, None, None, None, None), (201, "", "", None, None), (202, "http://x/ y\n", "WARC/1.1\r\n\r\n" * 1000, None, None),
             (203, "u", "z" * 300_000, None, None), (None, "v", rows[0][2], None, None), (203, "u", "z" * 300_000, None, None)]
    pages = spark.createDataFrame(rows, PAGES).repartition(3)
    arc.write_arc(pages, f"{tmp_path}/arc")
    arc.write_warc(arc.convert(arc.read_arc(spark, f"{tmp_path}/arc")), f"{tmp_path}/warc")
    records = arc.read_warc(spark, f"{tmp_path}/warc")
    got = arc.resolved(records).collect()
    best = {}
    for i, _, h, *_ in rows:
        best[h or ""] = max(best.get(h or "", -1), -1 if i is None else i)
    want = []
    for i, _, h, *_ in rows:
        data = (h or "").encode()
        again = best[h or ""] != (-1 if i is None else i)
        want.append((str(i), len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response",
                     best[h or ""] if again else None))
    assert sorted(map(str, ((str(r.key), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got))) == sorted(map(str, want))
    payloads = {bytes(r.payload).decode() for r in records.where("record_type = 'response'").collect()}
    assert payloads == {h or "" for _, _, h, *_ in rows}
    assert records.where("record_type = 'warcinfo'").count() >= 1
    dates = records.where("record_type = 'response'").select("date").first().date
    assert len(dates) == 20 and dates.endswith("Z")


def test_arc_versions_and_faults():
    one = b"filedesc://a 0.0.0.0 20000101000000 text/plain 10\n1 0 x\nURL\n\nhttp://a 1.2.3.4 20010203040506 text/html 5\nab\ncd\n"
    two = b"filedesc://b 0.0.0.0 20000101000000 text/plain 6\n2 0 x\n\nhttp://b 1.2.3.4 20010203040506 text/html 200 - - 0 - 3\nxyz\n"
    got = list(arc.arc_records(io.BytesIO(one + two)))
    assert [r["block"] for r in got if not r["opening"]] == [b"ab\ncd", b"xyz"]
    cut = list(arc.arc_records(io.BytesIO(one[:-4])))
    assert cut[-1]["error"] == "2 of 5 bytes"
    assert "error" in list(arc.arc_records(io.BytesIO(b"http://a only three\n")))[0]


def test_arc_empty(spark, tmp_path):
    arc.write_arc(spark.createDataFrame([], PAGES), f"{tmp_path}/arc")
    assert arc.read_arc(spark, f"{tmp_path}/arc").count() == 0


# ---- packing

def test_pieces_and_sequences(spark):
    common.shipped(spark)
    rows = texts()
    got = packing.pack(packing.pieces(spark.createDataFrame(rows, DOCS), VOCAB), block=100).collect()
    t = Tokenizer.from_file(VOCAB)
    want = []
    for i, x, *_ in rows:
        ids = np.array([*t.encode(x or "", add_special_tokens=False).ids, 0], dtype="<u4")
        want += [(str(i), k, at, len(ids[at:at + 2048]), zlib.crc32(ids[at:at + 2048].tobytes())) for k, at in enumerate(range(0, len(ids), 2048))]
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    seqs = {}
    for r in sorted(got, key=lambda r: r.offset):
        assert r.offset == seqs.get(r.sequence_id, 0)
        seqs[r.sequence_id] = r.offset + r.length
    assert max(seqs.values()) <= 2048


@pytest.mark.parametrize("score", ["norm", "dot"])
def test_capacities_hold(score):
    rng = np.random.default_rng(3)
    n = rng.integers(1, 700, 800)
    bins, at = packing.vector_best_fit(n, 1000, 5, 400_000, (1.0, 0.5, 0.5), score)
    for b in np.unique(bins):
        m = n[bins == b]
        assert m.sum() <= 1000 and len(m) <= 5 and ((m * m).sum() <= 400_000 or len(m) == 1)
        o = np.argsort(at[bins == b])
        assert (np.cumsum(m[o]) - m[o] == at[bins == b][o]).all()


def test_best_fit_is_tight():
    n = np.random.default_rng(4).integers(1, 2049, 5000)
    bins, _ = packing.vector_best_fit(n, 2048, 2048, 2048 * 2048, (1.0, 0.0, 0.0))
    assert bins.max() + 1 <= 1.02 * -(-n.sum() // 2048)


def test_packing_empty(spark):
    assert packing.pack(packing.pieces(spark.createDataFrame([], DOCS), VOCAB)).count() == 0


# ---- token counts

def test_token_counts(spark):
    common.shipped(spark)
    pieces = {p for p in token_counts.vocabulary(VOCAB)} | {(b,) for b in range(256)}

    def greedy(word):
        s, n, i = (*word, 256), 0, 0
        while i < len(s) - 1:
            i = next(j for j in range(min(len(s), i + 60), i, -1) if s[i:j] in pieces)
            n += 1
        return n
    rows = texts()
    got = token_counts.token_counts(spark.createDataFrame(rows, DOCS), VOCAB).collect()
    want = []
    for i, x, *_ in rows:
        words = (x or "").encode().lower().split()
        want.append((str(i), len(words), sum(map(greedy, words))))
    assert sorted((str(r.doc_id), r.n_words, r.n_tokens) for r in got) == sorted(want)


def test_automaton_on_random_vocabularies():
    rnd = random.Random(6)
    for _ in range(200):
        pieces = [tuple(rnd.choice(b"ab") for _ in range(rnd.randint(1, 5))) + ((256,) if rnd.random() < 0.3 else ()) for _ in range(8)]
        a = token_counts.Automaton(pieces)
        known = set(pieces) | {(b,) for b in b"ab"}
        for _ in range(30):
            w = bytes(rnd.choice(b"ab") for _ in range(rnd.randint(1, 12)))
            s, n, i = (*w, 256), 0, 0
            while i < len(s) - 1:
                i = next(j for j in range(len(s), i, -1) if s[i:j] in known)
                n += 1
            assert a.count(w) == n


# ---- toxicity

def test_toxicity_held_out(spark):
    common.shipped(spark)
    rnd = random.Random(8)
    bad = ["vile", "rotten", "wicked"]
    rows, labels = [], []
    for i in range(900):
        t = [f"w{rnd.randrange(300)}" for _ in range(60)]
        if i % 6 == 0:
            for _ in range(5):
                t[rnd.randrange(60)] = rnd.choice(bad) + rnd.choice(["", ".", "!"])
        rows.append((i, " ".join(t), None, "x", None))
        labels.append((i, 1, int(i % 6 == 0)))
    rows += [(2000, None, None, None, None), (2001, "", None, None, None), (2002, "clean " * 50_000, None, None, None), (None, "w1 w2", None, None, None)]
    labels += [(3, 0, None), (None, 0, 1), (99_999, 0, 1)]
    docs, marks = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = toxicity.toxicity(docs, marks).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    held = [r for r in got if r.held_out and r.doc_id < 900]
    assert sum(r.predicted == (r.doc_id % 6 == 0) for r in held) >= 0.97 * len(held)
    kept = toxicity.clean(docs, toxicity.train(docs, marks))
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if not r.predicted}


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame(texts()[:5], DOCS)
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert {r.predicted for r in toxicity.toxicity(docs, none).collect()} == {0}
    assert toxicity.toxicity(docs.limit(0), none).count() == 0


# ---- pipeline

def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = common.stored(stage(spark, before, SF), f"test-stage-{k}")
        if k < 4:
            assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes), name
        if name == "toxicity":
            marks = spark.read.parquet(f"{SF}/labels.parquet")
            clean = marks.where("toxic = 0").join(docs, "doc_id", "left_semi").count()
            assert out.join(marks.where("toxic = 0"), "doc_id", "left_semi").count() == clean
        if name == "line dedup":
            assert out.count() == before.count() and out.where("n_chars <> length(text)").count() == 0
        if name == "n-gram Jaccard join":
            from payflux.llm import jaccard
            groups = jaccard.clusters(before).select("component_id").distinct().count()
            assert out.count() == groups
        if name == "mixing sources":
            assert out.groupBy("doc_id").count().where("count > 2").count() == 0
        before = out
    assert before.groupBy("sequence_id").agg({"length": "sum"}).where("`sum(length)` > 2048").count() == 0


def test_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert set(queries.QUERIES) <= names and "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))
    assert gzip and set(queries.ORACLE_SQL) <= set(queries.QUERIES)
