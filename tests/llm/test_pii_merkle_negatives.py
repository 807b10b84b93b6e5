"""Personal data, hard negatives and Merkle manifests against brute force, and their edges."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.llm import hard_negatives as hn
from tabforge.llm import merkle_manifest as mm
from tabforge.llm import pii_crf as pii
from tabforge.llm import registry

from .conftest import edge_rows, prose

# ------------------------------------------------------------------ personal data

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def plain_spans(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            double = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            luhn = sum(x - 9 if x > 9 else x for x in double) % 10 == 0
            if [True, max(map(int, m[0].split("."))) <= 255 if kind == 1 else 0, 12 <= len(digits) <= 19 and luhn,
                    9 <= len(digits) <= 15][kind]:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_patterns_against_plain_matching():
    rnd = random.Random(3)
    for _ in range(20000):
        text = "".join(rnd.choice("1234567890 a.@+-()_%é\n25") for _ in range(rnd.randint(1, 40)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_long_runs_take_linear_time():
    for text in ("a" * 400000, "1" * 400000, "1." * 200000, "a@" * 200000, "+1 " * 130000, "a.b@" + "c-" * 200000):
        pii.base_spans(text)


def path_score(y, emit, trans):
    return trans[0, y[0]] + emit[0, y[0]] + sum(trans[a, b] + emit[i + 1, b] for i, (a, b) in enumerate(zip(y, y[1:])))


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(1)
    for _ in range(8):
        emit = rng.normal(0, 3, (4, pii.LABELS))
        emit[:, 0] += rng.choice([0, 4, 12], 4)
        trans = pii.allowed() + rng.normal(0, .6, (pii.LABELS, pii.LABELS))
        best = max(path_score(y, emit, trans) for y in itertools.product(range(pii.LABELS), repeat=4))
        assert abs(path_score(pii.viterbi(emit, trans, np.zeros(4, int)), emit, trans) - best) < 1e-9


def test_cuts_do_not_change_the_path(monkeypatch):
    rng = np.random.default_rng(2)
    for _ in range(10):
        emit = rng.normal(0, 3, (2000, pii.LABELS))
        emit[:, 0] += rng.choice([0, 4, 14, 20], 2000, p=[.05, .05, .5, .4])
        trans = pii.allowed() + rng.normal(0, .4, (pii.LABELS, pii.LABELS))
        line = np.sort(rng.integers(0, 7, 2000))
        assert pii.surely_outside(emit, trans).mean() > 0.2
        with monkeypatch.context() as m:
            got = pii.viterbi(emit, trans, line)
            m.setattr(pii, "surely_outside", lambda e, t: np.zeros(len(e), bool))
            assert (got == pii.viterbi(emit, trans, line)).all()


def test_marginals_against_all_paths():
    rng = np.random.default_rng(3)
    emit, trans = rng.normal(0, 1, (3, pii.LABELS)), rng.normal(0, 1, (pii.LABELS, pii.LABELS))
    prob, pair = pii.marginals(emit, trans, np.zeros(3, int))
    want, steps, total = np.zeros_like(emit), np.zeros_like(trans), 0.0
    for y in itertools.product(range(pii.LABELS), repeat=3):
        p = np.exp(path_score(y, emit, trans))
        total += p
        want[np.arange(3), y] += p
        for a, b in zip((0, *y), y):
            steps[a, b] += p
    assert np.allclose(prob, want / total) and np.allclose(pair, steps / total)


VARIANTS = [("please call (044) 555-1234 after ten", 3, "(044) 555-1234"), ("write to bob(at)host3.example.org now", 0,
            "bob(at)host3.example.org"), ("card 4111.1111.1111.1111 was charged", 2, "4111.1111.1111.1111"),
            ("number 12 4111 1111 1111 1111 and so on", 2, "4111 1111 1111 1111"), ("ring 044-555-9876 today", 3, "044-555-9876")]


def test_the_field_adds_what_patterns_miss(spark):
    rows = [(i, prose(i, 60) + "\n" + line + "\n" + prose(i + 50, 40)) for i, (line, _, _) in enumerate(VARIANTS)]
    clean = [(100 + i, prose(200 + i, 120) + " in 1998, section 3.2.1 of 12/10/2010 for 1,000 ") for i in range(30)]
    known = [(200 + i, prose(300 + i, 30) + f" w{i}@mail.example.com and +1 (21{i % 10}) 555-77{i:02d} " + prose(i, 30))
             for i in range(30)]
    docs = spark.createDataFrame(rows + clean + known, "doc_id long, text string")
    texts = dict(rows + clean + known)
    out = {r.doc_id: r.spans for r in pii.personal_data(docs).collect()}
    for i, (_, kind, value) in enumerate(VARIANTS):
        assert [(s.kind, texts[i][s.start:s.end]) for s in out[i] if s.added] == [(kind, value)]
    assert not any(out[d] for d, _ in clean)
    for d, text in known:
        assert [(s.start, s.kind, s.end) for s in out[d] if not s.added] == plain_spans(text) != []


def test_personal_data_query(spark, sf_dir):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = registry.op11_personal_data(spark, sf_dir).collect()
    assert Counter(r.doc_id for r in rows) == Counter(list(docs))
    for r in rows:
        spans = plain_spans(docs[r.doc_id])
        text = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in spans)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in spans) for i in range(4)]
        assert set(filter(None, text.split(","))) <= set(r.spans.split(",")) and r.n_added >= 0


def test_personal_data_edges(spark, edge_docs, no_docs):
    got = pii.personal_data(edge_docs).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in edge_rows())
    assert not any(r.spans for r in got)
    assert pii.personal_data(no_docs).count() == 0
    assert pii.personal_data(edge_docs, edge_docs.limit(0).selectExpr(
        "text", "cast(null as array<struct<start:long,kind:int,end:long>>) as spans")).count() == len(edge_rows())
    long = "word " * 300000 + "a@b.example.com " + "1" * 100000 + " \U0001F600 +1 (044) 555-1234"
    row = pii.personal_data(spark.createDataFrame([(None, long)], "doc_id long, text string")).first()
    assert [(s.start, s.kind, s.end) for s in row.spans if not s.added] == plain_spans(long)


# ------------------------------------------------------------------ hard negatives

def plain_negatives(rows, anchor_mod=50, k=5, m=3):
    """rows: (id or None, vector or None, label or None); every row stands for itself."""
    part = []
    for i, (vid, vec, label) in enumerate(rows):
        if label is not None and vec is not None and all(x is not None and np.isfinite(x) for x in vec):
            part.append((i, vid, [int(np.floor(256 * float(x))) for x in vec], label))
    out = []
    for i, vid, q, label in part:
        if vid is None or vid % anchor_mod:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(q, w)), o is None, o or 0, j, o, lab)
                         for j, o, w, lab in part if j != i and len(w) == len(q)), key=lambda x: x[:4])
        for p in [s for s in scored if s[5] == label][:k]:
            hits = [s for s in scored if s[5] != label and 50 * -p[0] <= 100 * -s[0] <= 95 * -p[0]][:m]
            out += [(vid, p[4], r + 1, h[4], -p[0], -h[0]) for r, h in enumerate(hits)]
    return Counter(out)


def vector_rows(n, d, clusters, seed=0):
    rng = np.random.default_rng(seed)
    centers = rng.normal(0, 1, (clusters, d))
    x = (centers[rng.integers(0, clusters, n)] + rng.normal(0, .15, (n, d))).astype(np.float32)
    x[rng.integers(0, n, n // 10)] = x[0]  # ties and repeated vectors
    return [(i, [float(v) for v in x[i]], int(rng.integers(0, 4))) for i in range(n)]


SMALL = hn.Layout(block_bytes=16 * 4 * 8, chunk=3, share=40, maps=5)
SCHEMA = "vec_id long, embedding array<float>, label int, q string, d string, block string, id string"


@pytest.mark.parametrize("layout", [hn.Layout(), SMALL])
def test_hard_negatives_against_brute_force(spark, layout):
    rows = vector_rows(500, 8, 6)
    rows += [(None, rows[3][1], 2), (50, rows[50][1], 1), (50, rows[50][1], 1), (600, None, 1), (650, [1.0, None] * 4, 1),
             (700, [float("nan")] * 8, 1), (750, [float("inf")] + [0.0] * 7, 1), (800, [1.0] * 8, None), (850, [], 1),
             (900, [1.0, 2.0], 0), (901, [1.0, 1.5], 0), (902, [0.5, 1.2], 3), (-50, rows[7][1], 0), (950, [0.0] * 8, 2)]
    df = spark.createDataFrame([(*r, "q", "d", "b", "i") for r in rows], SCHEMA)
    got = Counter(tuple(r) for r in hn.hard_negatives(df, layout=layout).collect())
    want = plain_negatives([(r[0], r[1], r[2]) for r in df.collect()])
    assert got == want and len(want) > 50


def test_zone_maps_exclude_blocks(spark):
    """Clustered vectors: most blocks of a positives' search are excluded, and nothing is lost."""
    rng = np.random.default_rng(5)
    centers = rng.normal(0, 3, (40, 6))
    rows = [(i, [float(v) for v in centers[i % 40] + rng.normal(0, .05, 6)], (i // 40) % 3) for i in range(4000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    layout = hn.Layout(block_bytes=32 * 4 * 6, chunk=4, share=100, maps=16)
    vectors = hn.quantised(df, 256, "vec_id", "embedding", F.col("label"))
    cut = hn.blocks(vectors, 4000, layout)
    anchors = hn.own_block(cut, 5, 50)
    read = hn.choose_blocks(anchors, cut, False, layout).agg(F.sum("blocks")).first()[0]
    assert read < 0.3 * 80 * cut.count()


def test_hard_negatives_edges(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert hn.hard_negatives(none).count() == 0
    one = spark.createDataFrame([(0, [1.0, 2.0], 1), (1, None, 1)], "vec_id long, embedding array<float>, label int")
    assert hn.hard_negatives(one).count() == 0


def test_hilbert_curve_steps_to_neighbours():
    for dims, bits in ((2, 4), (3, 3)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        key = hn.hilbert_key(cells, bits)
        assert sorted(key) == list(range(len(cells)))
        walk = cells[np.argsort(key)]
        assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


# ------------------------------------------------------------------ Merkle manifests

def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def piece(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def plain_tree(leaves, arity):
    """(root, proofs as lists of (left siblings, right siblings))."""
    level, proofs = list(leaves), [[] for _ in leaves]
    place = list(range(len(leaves)))
    while len(level) > 1:
        for i, p in enumerate(place):
            run = level[p - p % arity:p - p % arity + arity]
            proofs[i].append((run[:p % arity], run[p % arity + 1:]))
            place[i] = p // arity
        level = [sha(*level[i:i + arity]) for i in range(0, len(level), arity)]
    return (level[0] if level else None), proofs


def plain_manifest(rows, arity=2):
    """rows: (doc_id, source, lang, n_chars, text)"""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    done, subroots = {}, []
    for name in names:
        ordered = sorted(((r[0] is not None, r[0] or 0, sha(*map(piece, r)), r) for r in groups[name]), key=lambda x: x[:3])
        root, proofs = plain_tree([o[2] for o in ordered], arity)
        subroots.append(root)
        done[name] = [(o[2], o[3], p) for o, p in zip(ordered, proofs)]
    top, above = plain_tree(subroots, arity)
    out = []
    for name, sub, up in zip(names, subroots, above):
        for leaf, r, proof in done[name]:
            path = proof + up
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None
            h = sha(*map(piece, (*r[:3], r[3] + 1, r[4]))) if hit else leaf
            for left, right in path:
                h = sha(*left, h, *right)
            out.append((r[0], leaf, sub, top, sha(*[x for lr in path for side in lr for x in side]), h, h == top))
    return Counter(out)


def spark_manifest(docs, arity=2):
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    tampered = {"n_chars": F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    out = mm.verified(mm.merkle_manifest(docs, tampered=tampered, arity=arity))
    return Counter(tuple(r) for r in out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                                                "verified").collect())


@pytest.mark.parametrize("arity, small", [(2, 4096), (2, 3), (3, 4096), (5, 2)])
def test_merkle_against_plain_trees(spark, edge_docs, monkeypatch, arity, small):
    monkeypatch.setattr(mm, "SMALL", small)
    monkeypatch.setattr(mm, "ROWS", 20)
    more = [(100 + i, f"é text {i}", [None, "de", "", "en", "fr"][i % 5 if i % 2 else 3], "s", i) for i in range(67)]
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = edge_docs.unionByName(spark.createDataFrame(more, "doc_id long, text string, lang string, source string, "
                                                             "n_chars long"), allowMissingColumns=True)
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = spark_manifest(docs.select(*names, "row", "h1", F.lit(1).alias("g"), F.lit(2).alias("idx")), arity)
    assert got == plain_manifest(rows, arity)
    assert any(r[-1] for r in got) and not all(r[-1] for r in got)


def test_merkle_edges(spark, no_docs):
    assert mm.merkle_manifest(no_docs).count() == 0
    one = spark.createDataFrame([(7, "t", None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    assert spark_manifest(one) == plain_manifest([(7, None, None, None, "t")])
    (row,) = plain_manifest([(7, None, None, None, "t")])
    assert row[4] == sha("") and row[1] == row[2] == row[3]
