"""Secret scans with corpus-wide ownership frequency.

Every candidate value is hashed (the value itself leaves its task in no form) and
counted by distinct owners and repositories over the whole corpus.  A value seen at
many owners, in many repositories or in many documents (of one owner, too) is a widely
copied example; one that stays with few of each and looks random is live-looking.  The base kinds (assign, access, hex) are always reported; the method
adds spans of kind ``owned``: long mixed tokens outside the base spans that are
live-looking.

Counting is nested aggregations, (value, document) -> (value, owner, repository) -> (value, owner) ->
value, each combined before its shuffle, so a value in a third of all documents reaches
the last one as one row per owner and task.  The verdicts return to the spans by
``join_heavy``.

Defined results: a NULL text is empty; a NULL owner or repository is a value of its own;
repeated rows are reported each; spans are code points, end exclusive.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_heavy, materialise, ship, text_buffers, text_slices

#: Fixed values of the contract.
KINDS = ("assign", "access", "hex", "owned")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24
WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

OWNED = re.compile(r"[A-Za-z0-9+/_-]{20,}")
MAX_OWNERS = 2       # a live credential stays with this many owners
MAX_REPOS, MAX_DOCS = 4, 50
MIN_BITS = 3.0       # Shannon entropy per character of a live-looking value


def entropy(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, value) of the base kinds, by start, then kind."""
    out = [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    out += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    out += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text) if len(m[0]) >= MIN_HEX]
    return sorted(out)


def candidate_spans(text: str) -> list[tuple[int, int, int, str]]:
    """Base spans and the long mixed tokens that overlap none of them."""
    base = base_spans(text)
    out = list(base)
    starts = [b[0] for b in base]
    reach = list(accumulate((b[2] for b in base), max))  # the furthest end of the spans up to here
    for m in OWNED.finditer(text):
        v = m[0]
        mixed = re.search("[A-Za-z]", v) and re.search("[0-9]", v)
        before = bisect_left(starts, m.end())  # base spans that begin before the token ends
        if mixed and not (before and reach[before - 1] > m.start()):
            out.append((m.start(), 3, m.end(), v))
    return sorted(out)


_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdef")] = True
_OWNED = np.zeros(256, bool)
_OWNED[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")] = True


def _runs(mask, n: int):
    """Positions where a run of at least ``n`` (16 < n < 32) true bytes begins."""
    m, have = mask, 1
    while have * 2 <= n:
        m = m[:-have] & m[have:]
        have *= 2
    return np.flatnonzero(m[:len(m) - (n - have)] & m[n - have:]) if len(m) > n - have else np.zeros(0, np.int64)


def _suspicious(data, off):
    """Numbers of the texts in which any pattern can match (a superset)."""
    found = set()
    for mask, n in ((_HEX[data], MIN_HEX), (_OWNED[data], 20)):
        if len(mask) > 2 * n:
            found.update((np.searchsorted(off, _runs(mask, n), side="right") - 1).tolist())
        else:
            found.update(range(len(off) - 1))
    low = data.tobytes().lower()
    for word in (*WORDS, b"akia"):
        at = low.find(word)
        while at >= 0:
            i = int(np.searchsorted(off, at, side="right")) - 1
            found.add(i)
            at = low.find(word, int(off[i + 1]))
    return found


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
         repo_col: str = "lang") -> DataFrame:
    """One row per document: rid, doc_id, owner, repo, and found, an array of
    (start, kind, end, h, random)."""
    def run(batches):
        import pyarrow as pa
        from xxhash import xxh3_128_digest
        kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()),
                                   ("h", pa.binary()), ("random", pa.bool_())]))
        for batch in batches:
            data, off = text_buffers(batch.column(4))
            found: list[list] = [[] for _ in range(len(off) - 1)]
            for i, j in text_slices(off):
                for t in _suspicious(data[off[i]:off[j]], off[i:j + 1] - off[i]):
                    text = data[off[i + t]:off[i + t + 1]].tobytes().decode("utf-8", "replace")
                    found[i + t] = [{"start": s, "kind": k, "end": e, "h": xxh3_128_digest(v.encode()),
                                     "random": entropy(v) >= MIN_BITS} for s, k, e, v in candidate_spans(text)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in range(4)), pa.array(found, kind)],
                                             names=["rid", "doc_id", "owner", "repo", "found"])

    ship(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("doc_id"),
                       F.col(owner_col).cast("string").alias("owner"), F.col(repo_col).cast("string").alias("repo"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return materialise(rows.mapInArrow(
        run, f"rid long, doc_id {kind}, owner string, repo string, "
             "found array<struct<start:long,kind:int,end:long,h:binary,random:boolean>>"), "secrets")


def ownership(found: DataFrame) -> DataFrame:
    """(h, owners, repos, docs, n) over all candidates of the corpus."""
    return (found.groupBy("h", "owner", "repo", "rid").agg(F.count("*").alias("n"))
            .groupBy("h", "owner", "repo").agg(F.count("*").alias("docs"), F.sum("n").alias("n"))
            .groupBy("h", "owner").agg(F.count("*").alias("repos"), F.sum("docs").alias("docs"), F.sum("n").alias("n"))
            .groupBy("h").agg(F.count("*").alias("owners"), F.sum("repos").alias("repos"), F.sum("docs").alias("docs"),
                              F.sum("n").alias("n")))


def secret_spans(docs: DataFrame, max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS, max_docs: int = MAX_DOCS,
                 **cols) -> DataFrame:
    """One row per document: doc_id and ``spans``, an array of (start, kind, end, owners,
    repos, live) by start, then kind; kind counts as in ``KINDS``."""
    rows = scan(docs, **cols)
    found = materialise(rows.select("rid", "owner", "repo", F.explode("found").alias("f"))
                        .select("rid", "owner", "repo", "f.*"), "candidates")
    owned = materialise(ownership(found), "ownership")
    live = (F.col("owners") <= max_owners) & (F.col("repos") <= max_repos) & (F.col("docs") <= max_docs) & F.col("random")
    judged = (join_heavy(found.select("rid", "start", "kind", "end", "h", "random"), owned, ["h"], found.count())
              .withColumn("live", live).where("kind < 3 or live"))
    spans = judged.groupBy("rid").agg(F.array_sort(F.collect_list(
        F.struct("start", "kind", "end", "owners", "repos", "live"))).alias("spans"))
    return rows.select("rid", "doc_id").join(spans, "rid", "left").select(
        "doc_id", F.coalesce("spans", F.array().cast(spans.schema["spans"].dataType)).alias("spans"))


def span_text(spans, names=KINDS):
    """kind:start:end of each span, comma-joined."""
    kinds = F.array(*map(F.lit, names))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
