"""Queries of this subpackage, one per operator over its whole table, with their SQL
where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


@query("op1_simhash_dedup")
def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash_dedup import simhash_groups
    out = simhash_groups(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                      F.col("first.doc_id").alias("component_id"))


@query("op4_quality_rules")
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_llr import quality_rules
    out = quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "n_grams", "llr_sum", "word_llr_sum")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OP8_SQL = f"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(ls, 1) AS pos, unnest(ls) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') AS k
  FROM lines
), repeated AS (
  SELECT k, min(doc_id) AS keeper FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT keyed.*, repeated.keeper IS NOT NULL AND keyed.doc_id <> repeated.keeper AS dropped
  FROM keyed LEFT JOIN repeated USING (k)
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN dropped THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(CASE WHEN NOT dropped THEN line END, chr(10) ORDER BY pos), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query("op8_line_dedup", OP8_SQL)
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import line_dedup
    out = line_dedup(table(spark, sf_dir, "documents"))
    return out.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query("op10_benchmark_decontamination")
def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per contaminated document and benchmark item; clean documents have none."""
    from .spaced_seed import contaminated
    out = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.groupBy("doc_id", "item_id").agg(F.max("n_agree").alias("n_agree"), F.max("item_tokens").alias("item_tokens"),
                                                F.min("start").alias("start"))


@query("op5_secret_scan")
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secret_scan import secret_spans, span_text
    out = secret_spans(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < 3)

    def count(test):
        return F.size(F.filter("spans", test)).cast("long")

    return out.select("doc_id", count(lambda s: s["kind"] == 0).alias("n_assign"),
                      count(lambda s: s["kind"] == 1).alias("n_access"), count(lambda s: s["kind"] == 2).alias("n_hex"),
                      F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"),
                      count(lambda s: s["live"]).alias("n_live"), count(lambda s: ~s["live"]).alias("n_example"))


def _remainder(n: int):
    """crc32 of the id as text, modulo n (a NULL id counts as the empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(n))


@query("op7_quality_classifier")
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_knn import quality_scores
    labels = table(spark, sf_dir, "labels").where(_remainder(4) != 2)
    out = quality_scores(table(spark, sf_dir, "documents"), labels)
    return out.select("doc_id", (_remainder(4) == 2).alias("held_out"), "score",
                      (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op3_token_counts")
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of the corpus after three batches: every document is inserted, exact
    copies are deleted (the smallest id of a text stays), and documents whose text
    changes when runs of blanks are collapsed get a revised count.  The first batch is
    delivered twice, as after a lost acknowledgement.  A row without id is named by a hash of its
    text, source and language, so it counts too (equal such rows once)."""
    from .common import hash128, materialise, scratch_path
    from .token_rollup import TokenRollup, with_token_counts
    version = F.lit("byte_bpe_50k").alias("version")
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text", *hash128(text))
    name = F.concat_ws(":", F.lit("row"), F.col("h1"), F.col("h2"), F.xxhash64("source", "lang"))
    docs = docs.select(F.col("doc_id").alias("id"), F.coalesce(F.col("doc_id").cast("string"), name).alias("doc_id"),
                       "source", "lang", "text", "h1", "h2")
    rollup = TokenRollup(spark, scratch_path(spark, "token-rollup"))

    def facts(rows, op, seq):
        return with_token_counts(rows.select("doc_id", version, "source", "lang", "text")).select(
            "doc_id", "version", "source", "lang", F.lit(op).alias("op"), "n_tokens", F.lit(seq).alias("seq"))

    inserts = facts(docs, "set", 1)
    rollup.apply(1, inserts)
    rollup.apply(1, inserts)
    hashed = docs.select("id", "doc_id", "source", "lang", "h1", "h2")
    firsts = hashed.groupBy("h1", "h2").agg(F.min(F.struct(F.col("id").isNull(), "id", "doc_id")).alias("f"))
    copies = materialise(hashed.join(firsts.select("f.doc_id"), "doc_id", "left_anti"), "copies")
    rollup.apply(2, copies.select("doc_id", version, "source", "lang", F.lit("delete").alias("op"),
                                  F.lit(0).cast("long").alias("n_tokens"), F.lit(1).alias("seq")))
    clean = F.regexp_replace(text, r"[\x20\t]{2,}", " ")
    revised = (docs.join(copies.select("doc_id"), "doc_id", "left_anti").withColumn("clean", clean)
               .where(F.col("clean") != text).withColumn("text", F.col("clean")))
    rollup.apply(3, facts(revised, "set", 1))
    return rollup.totals()


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import toxicity_scores
    labels = table(spark, sf_dir, "labels").where(_remainder(5) != 0)
    out = toxicity_scores(table(spark, sf_dir, "documents"), labels)
    return out.select("doc_id", (_remainder(5) == 0).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op2_sentencepiece")
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document, their score, and whether decoding them gives the text."""
    from .sentencepiece_scan import decode, encode
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"), "text")
    return decode(encode(docs)).select("row.doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", "score",
                                       (F.sha2("text", 256) == F.col("row.sha")).alias("decoded"))


@query("op9_lm_scoring")
def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .context_mixing import lm_scores
    out = lm_scores(table(spark, sf_dir, "documents"), _remainder(7) != 2)
    return out.withColumn("held_out", _remainder(7) == 2)


@query("op11_personal_data")
def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii_crf import KINDS, personal_data
    from .secret_scan import span_text
    out = personal_data(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: ~s["added"])

    def count(test):
        return F.size(F.filter("spans", test)).cast("long")

    def of_kind(k: int):  # a lambda's second argument would be the place in the array
        return lambda s: (s["kind"] == k) & ~s["added"]

    per_kind = [count(of_kind(k)).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return out.select("doc_id", *per_kind, F.sha2(span_text(base, KINDS), 256).alias("base_sha256"),
                      span_text(F.col("spans"), KINDS).alias("spans"), count(lambda s: s["added"]).alias("n_added"))


OP12_SQL = """
WITH q AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS other_id,
         list_inner_product(a.v, b.v)::BIGINT AS score
  FROM q a JOIN q b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.other_id AS positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY n.score DESC, n.other_id)::INTEGER AS rank,
       n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
WHERE 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY n.score DESC, n.other_id) <= 3
"""


@query("op12_hard_negatives", OP12_SQL)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .hard_negatives import hard_negatives
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), label=label)


OP13_SQL = """
WITH RECURSIVE crc AS (
  SELECT doc_id, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(1, length(doc_id::VARCHAR) + 1),
                                                    lambda i: ord(substr(doc_id::VARCHAR, i, 1))::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), list_transform(range(8), lambda k: 0::BIGINT)),
                             lambda x, k: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END)))
    AS inverted
  FROM documents
), fields AS (
  SELECT documents.doc_id, lang, n_chars,
         coalesce(strlen(documents.doc_id::VARCHAR) || ':' || documents.doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') AS head,
         coalesce(strlen(text) || ':' || text, '-') AS tail,
         n_chars + CASE WHEN xor(inverted, 4294967295::BIGINT) % 7 = 0 THEN 1 ELSE 0 END AS changed
  FROM documents JOIN crc ON documents.doc_id = crc.doc_id
), leaves AS (
  SELECT doc_id, coalesce('=' || lang, '') AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS idx,
         count(*) OVER (PARTITION BY lang) AS n,
         sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS h,
         sha256(head || coalesce(strlen(changed::VARCHAR) || ':' || changed, '-') || tail) AS claimed
  FROM fields
), nodes AS (
  SELECT g, 0 AS lvl, idx, n, h FROM leaves
  UNION ALL
  SELECT g, lvl + 1, idx // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY idx))
  FROM nodes WHERE n > 1 GROUP BY g, lvl, idx // 2
), subroots AS (
  SELECT g, row_number() OVER (ORDER BY encode(g)) - 1 AS idx, count(*) OVER () AS n, h, lvl AS depth
  FROM nodes WHERE n = 1
), tops AS (
  SELECT 0 AS lvl, idx, n, h FROM subroots
  UNION ALL
  SELECT lvl + 1, idx // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY idx))
  FROM tops WHERE n > 1 GROUP BY lvl, idx // 2
), steps AS (
  SELECT l.doc_id, x.lvl, l.idx // (1::BIGINT << x.lvl) AS place, s.h AS sib
  FROM leaves l JOIN (SELECT DISTINCT g, lvl FROM nodes WHERE n > 1) x ON x.g = l.g
  LEFT JOIN nodes s ON s.g = l.g AND s.lvl = x.lvl AND s.idx = xor(l.idx // (1::BIGINT << x.lvl), 1::BIGINT)
  UNION ALL
  SELECT l.doc_id, r.depth + x.lvl, r.idx // (1::BIGINT << x.lvl), s.h
  FROM leaves l JOIN subroots r ON r.g = l.g CROSS JOIN (SELECT DISTINCT lvl FROM tops WHERE n > 1) x
  LEFT JOIN tops s ON s.lvl = x.lvl AND s.idx = xor(r.idx // (1::BIGINT << x.lvl), 1::BIGINT)
), folds AS (
  SELECT doc_id, 0 AS lvl, claimed AS h FROM leaves
  UNION ALL
  SELECT f.doc_id, f.lvl + 1,
         sha256(CASE WHEN s.place % 2 = 1 THEN s.sib || f.h ELSE f.h || coalesce(s.sib, '') END)
  FROM folds f JOIN steps s ON s.doc_id = f.doc_id AND s.lvl = f.lvl
), proofs AS (
  SELECT doc_id, sha256(coalesce(string_agg(sib, '' ORDER BY lvl), '')) AS proof_sha256 FROM steps GROUP BY doc_id
), ends AS (SELECT doc_id, arg_max(h, lvl) AS folded_root FROM folds GROUP BY doc_id)
SELECT l.doc_id, l.h AS leaf, r.h AS subroot, t.h AS root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256,
       e.folded_root, e.folded_root = t.h AS verified
FROM leaves l JOIN subroots r ON r.g = l.g CROSS JOIN (SELECT h FROM tops WHERE n = 1) t
LEFT JOIN proofs p ON p.doc_id = l.doc_id JOIN ends e ON e.doc_id = l.doc_id
"""


@query("op13_merkle_manifest", OP13_SQL)
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents; where 7 divides the id's checksum, n_chars is tampered with."""
    from .merkle_manifest import merkle_manifest, verified
    docs = table(spark, sf_dir, "documents")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0  # NULL ids stay as they are
    tampered = {"n_chars": F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    return verified(merkle_manifest(docs, tampered=tampered)).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
