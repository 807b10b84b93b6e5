"""Cases of reviewed findings, each against a plain computation."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import functions as F

from tabforge.llm import context_mixing, quality_llr, simhash_dedup
from tabforge.llm.common import join_heavy, text_buffers

from .conftest import edge_rows, prose
from .test_brute import words


def signed(s, seed=42):
    h = xxhash.xxh64_intdigest(s.encode(), seed)
    return h - (1 << 64) if h >> 63 else h


def word_grams(t):
    ws = words(t)
    return [b for w, v in zip(ws, [*ws[1:], ""])
            for b in (signed(w) % quality_llr.BUCKETS, signed(v, signed(w) % (1 << 64)) % quality_llr.BUCKETS)]


def test_quality_words_and_pairs(spark, edge_docs, edge_labels):
    """The ratio of whole words and pairs is recomputed; the verdict counts them like the edges."""
    labels: dict = {}
    for r in edge_labels.collect():
        labels.setdefault(r.doc_id, []).append(r.quality)
    docs = [(r[0], r[1] or "") for r in edge_rows()]
    copies: dict = {}
    for d, t in docs:
        copies.setdefault(t, []).append(d)
    raw, target = Counter(), Counter()
    for t, ds in copies.items():
        marks = [min(q) == 1 for d in ds if d is not None and (q := [x for x in labels.get(d, []) if x is not None])]
        for d in ds:
            raw.update(word_grams(t))
            if d is not None and marks and all(marks):
                target.update(word_grams(t))
    scale, k = sum(target.values()) / sum(raw.values()), quality_llr.SMOOTH
    rows = quality_llr.quality_rules(edge_docs, edge_labels).collect()
    assert len(rows) == len(docs)
    for r in rows:
        grams = word_grams(r["row"].text or "")
        assert len(grams) == r.n_grams
        assert r.word_llr_sum == sum(round(1e6 * math.log((target[b] + k) / (raw[b] * scale + k))) for b in grams)
        mean = quality_llr.MIN_MEAN_LLR * 1e6
        assert r.kept == (not r.base_failed and r.llr_sum >= mean * r.n_grams
                          and r.llr_sum + r.word_llr_sum >= mean * 2 * r.n_grams)


def test_junk_inside_words_is_seen(spark):
    """Copied junk whose words have the edges of clean ones, with foreign letters inside."""
    clean = [" ".join(w + w[::-1] + w for w in prose(s, 120).split()) for s in range(300)]
    junk = " ".join(w[:len(w) // 2] + "qzx" + w[len(w) // 2:] for w in clean[0].split())
    docs = spark.createDataFrame([*enumerate(clean), *((1000 + i, junk) for i in range(150))], "doc_id long, text string")
    labels = spark.range(200).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    out = quality_llr.quality_rules(docs, labels)
    assert out.where("row.doc_id < 1000 and not kept and not base_failed").count() == 0
    bad = out.where("row.doc_id >= 1000").collect()
    assert len(bad) == 150 and not any(r.kept or r.base_failed for r in bad)
    assert all(r.llr_sum >= quality_llr.MIN_MEAN_LLR * 1e6 * r.n_grams for r in bad)  # the edges alone would keep it


def test_verdict_is_no_filter_on_split_texts(spark, edge_docs, edge_labels):
    """The pipeline's filter reads finished columns: pushed below, it split the text again for every word."""
    kept = quality_llr.keep_good(edge_docs, edge_labels)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" in plan
    assert not any("split(" in x for x in plan.splitlines() if x.lstrip(" +-:").startswith("Filter"))
    rows = quality_llr.quality_rules(edge_docs, edge_labels).where("kept").count()
    assert kept.count() == rows > 0


def test_contexts_travel_in_blocks(spark):
    """A few rows hold all counts of a task; chunks get what they ask, also when read in parts."""
    texts = [prose(s, 300) for s in range(30)]
    code = context_mixing.Code(np.bincount(np.frombuffer("".join(texts).encode(), np.uint8), minlength=257))
    learn = spark.createDataFrame([(t,) for t in texts], "t string").repartition(2)
    blocks = context_mixing.context_blocks(learn, code, 5)
    assert blocks.count() <= 2 * 5
    want: dict = {}
    for t in texts:
        raw = np.frombuffer(t.encode(), np.uint8)
        sym, own, _, _ = context_mixing.sequences(raw, np.array([0, len(raw)]), code)
        for k in context_mixing.ORDERS:
            for h, s in zip(context_mixing.context_keys(sym, k, code)[own].tolist(), sym[own].tolist()):
                want.setdefault(h, Counter())[s] += 1
    got = {r.h: {c % context_mixing.SYMBOLS: c // context_mixing.SYMBOLS for c in r["counts"]}
           for r in context_mixing.context_counts(learn, code, 5).collect()}
    assert got == want

    rows = spark.createDataFrame([(i % 2, t) for i, t in enumerate([*texts[:6], "§ unseen §"])], "chunk long, t string")
    asked = context_mixing.asked(rows, code, 5)  # the chunks alternate, so each is asked for in parts
    found = blocks.groupBy("bucket").cogroup(asked.groupBy("bucket")).applyInArrow(
        context_mixing.replies, context_mixing.REPLY).toArrow()
    for chunk in (0, 1):
        col = pa.array([r.t for r in rows.collect() if r.chunk == chunk])
        seen = context_mixing.Contexts.of(col, found.filter(pc.equal(found["chunk"], chunk)), 5, code)
        data, off = text_buffers(col)
        sym, own, _, _ = context_mixing.sequences(data, off, code)
        for k, row in zip(context_mixing.ORDERS, seen.rows(sym, own)):
            for h, r in zip(context_mixing.context_keys(sym, k, code)[own].tolist(), row.tolist()):
                counts = want.get(h, {})
                pairs = np.array([c * context_mixing.SYMBOLS + s for s, c in counts.items()], np.int64)
                assert np.array_equal(seen.tables[0][r], context_mixing.log_odds(pairs, np.array([0, len(pairs)]), code)[1])


def test_scores_do_not_depend_on_buckets(spark, edge_docs, monkeypatch):
    def scores():
        return sorted((r.n_tokens, r.score) for r in context_mixing.lm_scores(edge_docs, edge_docs["doc_id"] > 5).collect())

    one = scores()
    monkeypatch.setattr(context_mixing, "BUCKET", 500)
    assert scores() == one


def test_window_keys_are_sorted_as_plain_numbers(spark):
    """op4_quality_rules: the keys of 3-word windows cannot be null, and are one column, sorted once per document."""
    from tabforge.llm.quality_llr import pair_hashes, position_bits, window_keys, words_of
    docs = spark.createDataFrame([("a b c a b c",), ("a b",), ("",), ("x " * 9,)], "t string")
    docs = docs.select(words_of(F.col("t")).alias("w")).select("w", pair_hashes(F.col("w")).alias("p"),
                                                               position_bits(F.col("w")).alias("b"))
    out = docs.select("w", "b", window_keys(F.col("p"), F.col("b")).alias("keys"))
    assert not out.schema["keys"].dataType.containsNull
    for r in out.collect():
        assert r.keys == sorted(r.keys)
        assert sorted(k % 2 ** r.b for k in r.keys) == list(range(max(0, len(r.w) - 2)))
        groups = {}
        for k in r.keys:
            i = k % 2 ** r.b
            groups.setdefault(k >> r.b, set()).add(tuple(r.w[i:i + 3]))
        assert all(len(g) == 1 for g in groups.values())


def test_joins_on_fingerprints_are_not_broadcast(spark, tmp_path):
    """Tables that look small as files, before their rows are multiplied, are joined by a shuffle."""
    fps = [((i * 0x9E3779B97F4A7C15) & 0x7FFFFFFFFFFFFFFF, 1) for i in range(200)]
    fps += [(f ^ 5, 1) for f, _ in fps[:50]]
    spark.createDataFrame(fps, "fp long, n long").write.parquet(str(tmp_path / "fps"))
    table = spark.read.parquet(str(tmp_path / "fps"))
    links = simhash_dedup.near_links(table)
    joined = join_heavy(table, table.withColumnRenamed("n", "m"), ["fp"], table.count(), "m")
    for df, bounded in ((links, 0), (joined, 2)):  # the heavy keys of join_heavy are broadcast, of 1024 rows at most
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") == bounded
    got = {frozenset((r.u, r.v)) for r in links.distinct().collect()}
    assert got == {frozenset((f, f ^ 5)) for f, _ in fps[:50]}
    assert joined.count() == len(fps)


def test_texts_do_not_change_each_others_scores(monkeypatch):
    """Bits deeper than the gates, texts that end in other blocks and stretches of any length: as each text alone."""
    texts = [prose(s, n).encode() + bytes(range(128, 128 + s)) for s, n in ((1, 3), (2, 90), (40, 200), (90, 30), (5, 700))] + [b""]
    code = context_mixing.Code(np.append(2 ** np.maximum(40 - np.arange(256) // 2, 1), 1))  # a code of more than 16 bits
    assert code.depth.max() > context_mixing.GATES + 2
    tables = [np.random.default_rng(k).integers(-40, 40, (context_mixing.SLOTS, context_mixing.SYMBOLS)).astype(np.int8)
              for k in context_mixing.ORDERS]

    def scores(some):
        off = np.concatenate(([0], np.cumsum([len(t) for t in some])))
        sym, own, first, _ = context_mixing.sequences(np.frombuffer(b"".join(some), np.uint8), off, code)
        return context_mixing.log_probabilities(sym, own, first, code, tables, refine=True).tolist()

    alone = [scores([t])[0] for t in texts]
    for ahead in (1, 300, 1 << 15):
        monkeypatch.setattr(context_mixing, "AHEAD", ahead, raising=False)
        assert np.allclose(scores(texts), alone, rtol=1e-12, atol=0)


def test_scoring_takes_one_step_for_all_depths(monkeypatch):
    """A block of a text is one step, however many bits its symbols have."""
    code = context_mixing.Code(np.bincount(np.frombuffer(prose(1, 500).encode(), np.uint8), minlength=257))
    text = np.frombuffer(prose(3, 3000).encode(), np.uint8)
    sym, own, first, _ = context_mixing.sequences(text, np.array([0, len(text)]), code)
    tables = [np.zeros((context_mixing.SLOTS, context_mixing.SYMBOLS), np.float16)] * len(context_mixing.ORDERS)
    steps = Counter()

    class Counted:
        def __getattr__(self, name):
            steps[name] += 1
            return getattr(np, name)

    monkeypatch.setattr(context_mixing, "np", Counted())
    context_mixing.log_probabilities(sym, own, first, code, tables, refine=True)
    assert steps["bincount"] < 3 * (len(own) / context_mixing.BLOCK + 1)
