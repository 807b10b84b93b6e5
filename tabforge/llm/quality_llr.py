"""Quality rules: fixed base rules, then a hashed n-gram log-likelihood ratio between a
trusted-target and the raw-corpus multinomial, length-normalised, with one threshold
for every document.  DataFrame functions only.

n-grams, hashed into ``BUCKETS`` buckets per kind, each kind a multinomial of its own:

* words: every word and every pair of neighbouring words; the end of the text is the last
  word's neighbour;
* characters: the trigrams at both edges of every word (first and last three code points,
  marked with ``^`` and ``$``).  They show case, punctuation runs, symbols and separators as
  well as the language's affixes, and their set saturates early, so rare words of clean
  documents do not look foreign.

* raw corpus: every row of the documents, copies and repeated rows included, so widely copied
  junk counts as often as it is there (equal texts are read once and weighted);
* trusted target: all copies of texts that are labelled good somewhere and bad nowhere;
* ``llr(b) = ln p_target(b) - ln p_raw(b)``, both smoothed by pseudo-counts in proportion
  to their totals: ``ln((target + SMOOTH) / (expected + SMOOTH))``, where ``expected`` is
  the raw count scaled to the target's total.  What is too rare to be expected in the
  target is no evidence, and a small target decides little.  In whole millionths, so
  that the sum does not depend on the order of rows;
* verdict: the mean llr of all the document's n-grams is at least ``MIN_MEAN_LLR`` nats, and so
  is that of the edges alone.

Defined results: a NULL or empty text has no words (``base_failed``); without a trusted
label the ratio is zero and the base rules decide alone; documents without id
belong to the raw corpus and cannot be trusted; repeated rows are returned as often as they come.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash128, let

BUCKETS = 1 << 15
MIN_MEAN_LLR = -1.2
MICRO = 1_000_000
SMOOTH = 2.0
WORD_SPLIT = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, WORD_SPLIT), "")


def bucket(h: Column, buckets: int) -> Column:
    """Bucket number of a hash; the usual power of two takes the low bits, which is the same number."""
    return h.bitwiseAND(F.lit(buckets - 1)) if buckets & (buckets - 1) == 0 else F.pmod(h, F.lit(buckets))


def edge_buckets(word: Column, buckets: int = BUCKETS) -> Column:
    """The two bucket numbers of a word's edges."""
    return F.array(bucket(F.xxhash64(F.concat(F.lit("^"), F.substring(word, 1, 3))), buckets),
                   bucket(F.xxhash64(F.concat(F.substring(word, -3, 3), F.lit("$"))), buckets))


def word_buckets(word: Column, following: Column, buckets: int = BUCKETS) -> Column:
    """The bucket numbers of a word and of the pair it makes with the following one (empty at
    the end); they come after those of the edges."""
    return F.array(bucket(F.xxhash64(word), buckets) + buckets,
                   bucket(F.xxhash64(word, following), buckets) + buckets)


def following_words(words: Column) -> Column:
    """For every word the one after it, empty at the end."""
    return F.when(F.size(words) > 0, F.concat(F.slice(words, F.lit(2), F.size(words)), F.array(F.lit("")))) \
        .otherwise(F.slice(words, 1, 0))


def followed(words: Column) -> Column:
    """Every word ``w`` with the one after it, ``following``, empty at the end."""
    return F.arrays_zip(words.alias("w"), following_words(words).alias("following"))


def pair_hashes(words: Column) -> Column:
    """Hash of every word with the one after it."""
    return F.zip_with(words, following_words(words), lambda w, following: F.xxhash64(w, following))


def _shift(name: str, value: Column, by: Column) -> Column:
    return F.call_function(name, value, by)  # SQL shifts take a column amount through call_function


def position_bits(words: Column) -> Column:
    """So many bits hold every position in ``words``."""
    return F.ceil(F.log2(F.size(words) + 1.0)).cast("int")


def window_keys(pairs: Column, bits: Column) -> Column:
    """One long per 3-word window, sorted: the hash of its two pairs in the high bits, its position in
    the ``bits`` low ones.  Never null, so that they are sorted as plain numbers."""
    def packed(h, i):
        both = h.bitwiseXOR(_shift("shiftleft", F.get(pairs, i + 1), F.lit(1)))
        return F.coalesce(_shift("shiftleft", both, bits).bitwiseOR(i.cast("long")), F.lit(0).cast("long"))

    return F.sort_array(F.transform(F.slice(pairs, F.lit(1), F.greatest(F.size(pairs) - 2, F.lit(0))), packed))


def n_repeat_words(words: Column, keys: Column, bits: Column) -> Column:
    """Words inside a 3-word window that occurs twice or more; ``keys`` are the ``window_keys`` with
    ``bits`` for the position.

    Sorted, equal windows are neighbours; a neighbour counts only if the words themselves agree.
    The covered words are the union of the windows' intervals, taken from their sorted positions.
    """
    n = F.size(words)

    def count(low):
        def same(k):
            x, y = F.get(keys, k), F.get(keys, k + 1)
            i, j = x.bitwiseAND(low).cast("int"), y.bitwiseAND(low).cast("int")
            return ((_shift("shiftright", x.bitwiseXOR(y), bits) == 0)
                    & (F.get(words, i) == F.get(words, j)) & (F.get(words, i + 1) == F.get(words, j + 1))
                    & (F.get(words, i + 2) == F.get(words, j + 2)))

        def covered(pos):
            gaps = F.transform(pos, lambda p, i: F.least(F.lit(3).cast("long"),
                                                         F.coalesce(F.get(pos, i + 1) - p, F.lit(3).cast("long"))))
            return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)

        hit = F.filter(F.sequence(F.lit(0), n - 4), same)
        both = F.transform(hit, lambda k: F.array(F.get(keys, k).bitwiseAND(low), F.get(keys, k + 1).bitwiseAND(low)))
        return let(F.sort_array(F.array_distinct(F.flatten(both))), covered)

    counted = let(_shift("shiftleft", F.lit(1).cast("long"), bits) - 1, count)  # once per document, not once per window
    return F.when(n < 4, F.lit(0).cast("long")).otherwise(counted)


def base_stats(txt: str = "txt", words: str = "words", keys: str = "keys", bits: str = "bits") -> list[Column]:
    t = F.col(txt)
    worded = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return [F.size(words).cast("long").alias("n_words"),
            F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            let(worded, lambda ls: F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
            n_repeat_words(F.col(words), F.col(keys), F.col(bits)).alias("n_repeat_words")]


def fit_llr(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            buckets: int = BUCKETS) -> list[int]:
    """llr in whole millionths by bucket: ``buckets`` numbers for the edges, then as many for the
    words, whatever the corpus."""
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("txt"))
    marks = labels.groupBy(F.col("doc_id").alias("id")).agg((F.min("quality") == 1).alias("good"))
    # Equal texts are read once, with the number of their rows as weight; they are trusted if some
    # copy is labelled and none is bad.  The text stays where it is until the representative is known.
    rows = base.where(F.col("id").isNotNull())
    same = (rows.select("id", *hash128(F.col("txt"))).groupBy("h1", "h2", "id").agg(F.count("*").alias("k"))
            .join(marks, "id", "left").groupBy("h1", "h2")
            .agg(F.min("id").alias("id"), F.sum("k").alias("n"), F.min_by("k", "id").alias("k"),
                 F.coalesce(F.min("good"), F.lit(False)).alias("good"))
            .select("id", "h1", "h2", "good", (F.col("n") / F.col("k")).alias("weight")))
    read = (rows.withColumns({"h1": F.xxhash64("txt"), "h2": F.xxhash64(F.lit(1), "txt")})
            .join(same, ["id", "h1", "h2"]).select("good", "weight", "txt"))
    # Rows without an id can have no label; each is a row of the raw corpus.
    read = read.unionByName(base.where(F.col("id").isNull()).select(
        F.lit(False).alias("good"), F.lit(1.0).alias("weight"), "txt"))
    word, following = F.col("f.w"), F.col("f.following")
    counts = (read.select("good", "weight", words_of(F.col("txt")).alias("words"))
              .select("good", "weight", F.explode(followed(F.col("words"))).alias("f"))
              .select("good", "weight", F.explode(F.concat(edge_buckets(word, buckets),
                                                           word_buckets(word, following, buckets))).alias("bucket"))
              .groupBy("bucket").agg(F.sum("weight").alias("raw"),
                                     F.coalesce(F.sum(F.when(F.col("good"), F.col("weight"))), F.lit(0.0)).alias("target"))
              .collect())  # at most 2 * `buckets` rows
    raw, target = [0] * (2 * buckets), [0] * (2 * buckets)
    for r in counts:  # whole numbers of rows, up to the rounding of the weights
        raw[r.bucket], target[r.bucket] = round(r.raw), round(r.target)
    n_raw, n_target = sum(raw[:buckets]), sum(target[:buckets])  # both kinds have two n-grams a word
    if not n_target:
        return [0] * (2 * buckets)
    return [round(MICRO * math.log((t + SMOOTH) / (r * n_target / n_raw + SMOOTH))) for r, t in zip(raw, target)]


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  buckets: int = BUCKETS, min_mean_llr: float = MIN_MEAN_LLR) -> DataFrame:
    """Columns: ``row`` (the input row as a struct), n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, n_grams, llr_sum (of the edges, millionths), word_llr_sum (of
    the words and pairs, as many n-grams), base_failed, kept.

    Scoring is a projection: the bounded ratio table is a constant of the plan, so the
    texts are neither shuffled nor joined.  Its columns leave through ``inline``: a filter on
    them would else be pushed below, where the optimizer puts the whole split of the text in
    place of every mention of a word."""
    llr = fit_llr(docs, labels, id_col, text_col, buckets)

    def ratios(part):
        return F.split(F.lit(",".join(map(str, part))), ",").cast("array<bigint>")

    none = F.lit(0).cast("long")

    # Each bucket number is used once, so the arrays vanish from the plan.
    def of(table, b):
        return F.get(table, b.cast("int"))

    def llr_sum(table):
        def more(total, w):
            edges = edge_buckets(w, buckets)
            return total + of(table, edges[0]) + of(table, edges[1])
        return F.aggregate("words", none, more)

    def word_llr_sum(table):
        def more(total, h):
            return total + of(table, bucket(h, buckets))
        return (F.aggregate("words", none, lambda total, w: more(total, F.xxhash64(w)))
                + F.aggregate("pairs", none, more))

    scored = (docs.select(F.struct("*").alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("txt"))
              .withColumn("words", words_of(F.col("txt")))
              .withColumns({"pairs": pair_hashes(F.col("words")), "bits": position_bits(F.col("words"))})
              # Sorted as a column of its own, outside any lambda, the keys stay plain numbers.
              .withColumn("keys", window_keys(F.col("pairs"), F.col("bits")))
              .select("row", F.inline(F.array(F.struct(
                  *base_stats(), (2 * F.size("words")).cast("long").alias("n_grams"),
                  let(ratios(llr[:buckets]), llr_sum).alias("llr_sum"),
                  let(ratios(llr[buckets:]), word_llr_sum).alias("word_llr_sum"))))))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    least = F.lit(round(min_mean_llr * MICRO)) * F.col("n_grams")
    good = (F.col("llr_sum") >= least) & (F.col("llr_sum") + F.col("word_llr_sum") >= 2 * least)
    return scored.withColumn("base_failed", failed).withColumn("kept", ~failed & good)


def keep_good(docs: DataFrame, labels: DataFrame, **kw) -> DataFrame:
    """Pipeline form: the rows of ``docs`` that pass."""
    return quality_rules(docs, labels, **kw).where("kept").select("row.*")
