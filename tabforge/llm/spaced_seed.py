"""Benchmark decontamination by spaced-seed hashing.

Fixed masks select some of the token positions of a window and ignore the others, so a
seed survives substitutions at ignored places.  The masks are chosen so that every overlap
that the check accepts (see below) is hit by one of them, wherever its substitutions lie;
items shorter than ``WINDOW`` have masks of their own length.  Test and training windows are joined
on (mask, hash); every hit fixes a diagonal (training position minus test position)
along which the texts are compared token by token.  A pair counts when some stretch of
``WINDOW`` tokens (the whole item, if shorter) agrees in at least ``MIN_AGREE`` of its
places.

Tokens are white-space words, A-Z lower-cased.  The training side is scanned once; a
bit table of the test hashes (``FILTER_BITS``, a constant size however large the
benchmark is, three bits per hash) keeps windows that cannot join from being shuffled.  Documents with a
surviving window keep their token hashes for the comparison; all others leave no row.

Defined results: NULL or empty texts match nothing; items of 5 tokens or fewer must match exactly;
rows sharing a ``doc_id`` are judged by their own texts.  The filter ``drop_contaminated`` leaves items
under ``MIN_DROP`` tokens aside: so few words stand in many documents by chance.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_heavy, materialise, mix64, ship, text_buffers, text_slices, text_tokens

#: Fixed values by the item's length (16: that or more): 1 = compared position, 0 = ignored.
#: Every choice of as many places as MIN_AGREE lets differ in a stretch of that length
#: leaves some mask a position where it compares none of them.
MASKS = {
    1: "1",
    2: "11",
    3: "111",
    4: "1111",
    5: "11111",
    6: "11111 111011 101111 110111 111101",
    7: "111111 1011111 1111011 1111101 1110111 1101111",
    8: "1111111 11101111 11011111 11111101 11110111 11111011 10111111",
    9: "11111111 111110111 111111011 111111101 111011111 111101111 110111111 101111111",
    10: "1111011 11001111 110110011 10101111 111010101",
    11: "11101111 110111011 1110100111 111110101 11000011111 11011010011 1111111",
    12: "11101111 1111010011 1010011111 10110110011 1111111",
    13: "111011111 1111101011 11010011111 111001100111 111111011",
    14: "1110110111 11011101011 111000111011 10111100111",
    15: "11101111 11100100111 111110101 110110000111 110101001011 111110011",
    16: "1110110111 1110010100111 1101001101011 11011001111 111111000011 11110101011 111000111101 101111111",
}
MIN_TOKENS = 1   # of items that are searched for
MIN_DROP = 5     # of items whose passages make a document go; shorter ones occur by chance
WINDOW = 16
MIN_AGREE = 0.8
FILTER_BITS = 1 << 24
PROBES = (0, 20, 40)  # shifts of a hash that give its bits


def _masks() -> list[tuple[int, list[int]]]:
    """Item length and compared positions of each mask."""
    return [(n, [i for i, c in enumerate(m) if c == "1"]) for n, ms in MASKS.items() for m in ms.split()]


def _windows(tokens, room, lengths: set[int]):
    """(mask, positions, hashes) of all windows; ``room`` is each token's distance to
    the end of its text.  Only masks for the item lengths in ``lengths`` run."""
    odd = mix64(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)
    for m, (length, care) in enumerate(_masks()):
        span = care[-1] + 1
        n = len(tokens) - span + 1
        if length not in lengths or n <= 0:
            continue
        h = np.full(n, np.uint64(m + 1))
        for j, c in enumerate(care):
            h += tokens[c:c + n] * odd[j]
        at = np.flatnonzero(room[:n] >= span)
        yield m, at, mix64(h[at])


def _room(first):
    lens = np.diff(first)
    ends = np.repeat(first[1:], lens)
    return ends - np.arange(first[0], first[-1]), lens


def _item_rows(items: DataFrame, id_col: str, text_col: str, min_tokens: int) -> DataFrame:
    """(item_id, tokens) of distinct items long enough to be searched for."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            data, off = text_buffers(batch.column(1))
            first, tok, _, _ = text_tokens(data, off)
            parts = [tok[first[i]:first[i + 1]].view(np.int64) for i in range(len(first) - 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(parts, pa.list_(pa.int64()))],
                                             names=["item_id", "tokens"])

    rows = (items.select(F.col(id_col).cast("long").alias("item_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
            .mapInArrow(run, "item_id long, tokens array<long>"))
    return materialise(rows.where(F.size("tokens") >= max(min_tokens, 1)).distinct(), "items")


def _seed_rows(items: DataFrame) -> DataFrame:
    """(mask, h, item_id, at) of every window of the items."""
    def run(frames):
        import pandas as pd
        for df in frames:
            for item, toks in zip(df["item_id"], df["tokens"]):
                t = np.asarray(toks, np.int64).view(np.uint64)
                room = len(t) - np.arange(len(t))
                for m, at, h in _windows(t, room, {min(len(t), WINDOW)}):
                    yield pd.DataFrame({"mask": np.int32(m), "h": h.view(np.int64), "item_id": item,
                                        "at": at.astype(np.int32)})

    return materialise(items.mapInPandas(run, "mask int, h long, item_id long, at int"), "seeds")


def _suspects(docs: DataFrame, bits, lengths: set[int], id_col: str, text_col: str) -> DataFrame:
    """Documents with a window whose hash is in the bit table: their tokens and windows."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            data, off = text_buffers(batch.column(3))
            for i, j in text_slices(off):
                part = data[off[i]:off[j]]
                first, tok, _, _ = text_tokens(part, off[i:j + 1] - off[i])
                room, lens = _room(first)
                masks, ats, hs = [], [], []
                for m, at, h in _windows(tok, room, lengths):
                    hit = np.arange(len(h))
                    for shift in PROBES:
                        slot = (h[hit] >> np.uint64(shift)) & np.uint64(FILTER_BITS - 1)
                        hit = hit[(bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) != 0]
                    masks.append(np.full(len(hit), m, np.int32))
                    ats.append(at[hit])
                    hs.append(h[hit])
                if not masks or not sum(map(len, masks)):
                    continue
                mask, at, h = map(np.concatenate, (masks, ats, hs))
                doc = np.searchsorted(first, at, side="right") - 1
                order = np.argsort(doc, kind="stable")
                mask, at, h, doc = mask[order], at[order], h[order], doc[order]
                own = np.unique(doc)
                lo = np.searchsorted(doc, own)
                hi = np.append(lo[1:], len(doc))
                rows = pa.array(own + i)
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(c).take(rows) for c in range(3)),
                    pa.array([tok[first[d]:first[d + 1]].view(np.int64) for d in own], pa.list_(pa.int64())),
                    pa.array([mask[a:b] for a, b in zip(lo, hi)], pa.list_(pa.int32())),
                    pa.array([(at[a:b] - first[d]).astype(np.int32) for a, b, d in zip(lo, hi, own)], pa.list_(pa.int32())),
                    pa.array([h[a:b].view(np.int64) for a, b in zip(lo, hi)], pa.list_(pa.int64())),
                ], names=["rid", "doc_id", "th", "tokens", "masks", "ats", "hs"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("doc_id"),
                       F.xxhash64(text).alias("th"), text.alias("text"))
    return materialise(rows.mapInArrow(run, "rid long, doc_id long, th long, tokens array<long>, masks array<int>, "
                                            "ats array<int>, hs array<long>"), "suspects")


def _verify(window: int, min_agree: float):
    """The best accepted diagonal of each document and item: most equal tokens, then first."""
    def run(frames):
        import pandas as pd
        for df in frames:
            rows = []
            for doc_id, th, item_id, doc, item, diagonals in zip(*(df[x] for x in (
                    "doc_id", "th", "item_id", "tokens", "item", "diagonals"))):
                doc, item = np.asarray(doc), np.asarray(item)
                w, best = min(window, len(item)), None
                for diag in diagonals.tolist():
                    lo, hi = max(0, -diag), min(len(item), len(doc) - diag)
                    if hi - lo < w:
                        continue
                    total = np.concatenate(([0], np.cumsum(doc[lo + diag:hi + diag] == item[lo:hi])))
                    if int((total[w:] - total[:-w]).max()) >= min_agree * w:
                        found = (int(total[-1]), -(lo + diag))
                        best = found if best is None else max(best, found)
                if best is not None:
                    rows.append((doc_id, th, item_id, best[0], -best[1], len(item)))
            yield pd.DataFrame(rows, columns=["doc_id", "th", "item_id", "n_agree", "start", "item_tokens"])
    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", window: int = WINDOW, min_agree: float = MIN_AGREE,
                 min_tokens: int = MIN_TOKENS) -> DataFrame:
    """One row per contaminated document row text and item: doc_id, th (text hash),
    item_id, n_agree (equal tokens on the best diagonal), item_tokens, start (token)."""
    ship(docs.sparkSession)
    items = _item_rows(benchmark, item_col, "text", min_tokens)
    seeds = _seed_rows(items)
    lengths = {r[0] for r in items.select(F.least(F.size("tokens"), F.lit(WINDOW))).distinct().collect()}  # 16 at most
    # At most FILTER_BITS / 64 rows reach the driver.
    slots = F.array(*[F.shiftrightunsigned("h", shift).bitwiseAND(FILTER_BITS - 1) for shift in PROBES])
    words = (seeds.select(F.explode(slots).alias("slot"))
             .select(F.shiftright("slot", 6).alias("w"),
                     F.call_function("shiftleft", F.lit(1).cast("long"), F.col("slot").bitwiseAND(63).cast("int")).alias("b"))
             .groupBy("w").agg(F.bit_or("b").alias("b")).collect())
    bits = np.zeros(FILTER_BITS // 64, np.uint64)
    for r in words:
        bits[r.w] = np.int64(r.b).view(np.uint64)
    found = _suspects(docs, bits, lengths, id_col, text_col)
    hits = found.select("rid", F.explode(F.arrays_zip("masks", "ats", "hs")).alias("x")).select(
        "rid", F.col("x.masks").alias("mask"), F.col("x.ats").alias("pos"), F.col("x.hs").alias("h"))
    # Hits of one passage share a diagonal: they are merged before and after the shuffle.  A document's
    # tokens are read once per item, with all its diagonals.
    lines = (hits.join(seeds, ["mask", "h"]).groupBy("rid", "item_id")
             .agg(F.collect_set(F.col("pos") - F.col("at")).alias("diagonals")))
    lines = materialise(lines, "diagonals")
    pairs = materialise(lines.join(found.select("rid", "doc_id", "th", "tokens"), "rid"), "pairs")
    used = pairs.groupBy("item_id").agg(F.count("*").alias("n"))
    wanted = materialise(items.join(used, "item_id").select("item_id", F.col("tokens").alias("item"), "n"), "wanted")
    checked = (join_heavy(pairs, wanted, ["item_id"], pairs.count())
               .select("doc_id", "th", "item_id", "diagonals", "tokens", "item")
               .mapInPandas(_verify(window, min_agree),
                            "doc_id long, th long, item_id long, n_agree long, start long, item_tokens long"))
    best = F.max(F.struct("n_agree", (-F.col("start")).alias("neg"), "item_tokens")).alias("b")
    return checked.groupBy("doc_id", "th", "item_id").agg(best).select(
        "doc_id", "th", "item_id", "b.n_agree", "b.item_tokens", (-F.col("b.neg")).alias("start"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      min_tokens: int = MIN_DROP, **kw) -> DataFrame:
    """Pipeline form: the rows of ``docs`` without a benchmark passage."""
    bad = contaminated(docs, benchmark, id_col=id_col, text_col=text_col, min_tokens=min_tokens, **kw).select(
        F.col("doc_id").alias("bad_id"), F.col("th").alias("bad_th")).distinct()
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("h"))
    return rows.join(bad, F.col("id").eqNullSafe(F.col("bad_id")) & (F.col("h") == F.col("bad_th")),
                     "left_anti").select("row.*")
