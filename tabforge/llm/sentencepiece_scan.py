"""SentencePiece-style encoding and decoding by a max-plus parallel scan.

The segmentation of a text is the path of greatest total score through the lattice of
vocabulary pieces (a max-plus recurrence).  A giant document is cut into chunks of
``CHUNK`` characters.  A piece may straddle a chunk's end by fewer than L characters
(L: the longest piece), so a chunk is a transfer matrix of L x L scores, from the
offset of the first boundary in the chunk to that in the next one.  Matrices combine
associatively under (max, +): first within blocks of ``FAN`` chunks, then over the
blocks; going back down, every block and then every chunk learns its two boundary
offsets, and the chunks are backtraced independently.  Documents of one chunk are
encoded where they lie and are not shuffled.

Vocabulary: the pieces of a SentencePiece model file (its path is a parameter).  A BPE
model holds ranks, not probabilities; a piece of rank r scores ``-ln(r + 2)`` (Zipf's
law), a byte piece ``BYTE_SCORE``; both as whole millionths, so sums are exact in any
order.  A blank is written as U+2581 and a text begins with one, as usual; characters
without a piece, and a literal U+2581, are spelled in byte pieces, so decoding returns
every text exactly.

No piece of such a vocabulary has U+2581 behind another character, so a path has a
boundary before every word: words are encoded once per worker and kept in tables of at
most ``CACHE`` entries, of which the words not met lately go first; a chunk with such a boundary has a rank-one matrix (head
scores, inner score, tail scores).  A vocabulary without this property is handled by
the full matrices.  Equal totals are decided for the longest last piece.

Defined results: a NULL or empty text has no pieces; repeated rows are encoded each.
"""

from __future__ import annotations

import math
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, ship, text_buffers

CHUNK = 1 << 16
FAN = 256
CACHE = 600_000
MICRO = 1_000_000
BYTE_SCORE = -14 * MICRO
NEVER = -(1 << 60)
BLANK = "▁"
#: A literal U+2581 in a text: its three bytes, as code points that no text contains.
ESCAPED = "\udce2\udc96\udc81"


class Pieces:
    """Vocabulary of a SentencePiece model, loaded once per worker and path."""
    _loaded: dict = {}

    @classmethod
    def of(cls, path: str | None) -> Pieces:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def __init__(self, path: str | None):
        import public_tokenizers
        from sentencepiece import SentencePieceProcessor
        sp = SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
        self.score: dict[str, int] = {}
        self.id: dict[str, int] = {}
        self.byte_id = [0] * 256
        self.bytes: list[bytes] = [b""] * sp.get_piece_size()
        rank = 0
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                b = int(piece[3:5], 16)
                self.byte_id[b], self.bytes[i] = i, bytes([b])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.score[piece], self.id[piece] = round(-MICRO * math.log(rank + 2)), i
                self.bytes[i] = piece.replace(BLANK, " ").encode()
                rank += 1
        self.longest = max(map(len, self.score))
        # Score of every piece; 0 for what only begins one, so that a search can stop early.
        self.reach: dict[str, int] = {p[:n]: 0 for p in self.score for n in range(1, len(p))} | self.score
        self.by_id = np.full(sp.get_piece_size(), BYTE_SCORE, np.int64)
        self.by_id[list(self.id.values())] = list(self.score.values())
        words = all(BLANK not in p.lstrip(BLANK) for p in self.score)
        lines = all("\n" not in p for p in self.score)
        self.segment = re.compile(rf"\n|{BLANK}+[^{BLANK}\n]*|[^{BLANK}\n]+" if words and lines else "(?s).+")
        self.cuttable = words and lines
        self.known: dict[str, bytes] = {}   # ids of words, in two generations
        self.older: dict[str, bytes] = {}

    def spell(self, ch: str) -> list[int]:
        code = ord(ch)
        raw = bytes([code & 255]) if 0xDC80 <= code <= 0xDCFF else ch.encode()
        return [self.byte_id[b] for b in raw]

    def best(self, seg: str, start: int = 0, stop: int | None = None):
        """Best scores of reaching each place of ``seg`` from ``start`` (edges begin
        before ``stop``) and the place each best path comes from."""
        n = len(seg)
        stop = n if stop is None else min(stop, n)
        score, back = [NEVER] * (n + 1), [-1] * (n + 1)
        score[start] = 0
        get, longest = self.reach.get, self.longest
        for p in range(start, stop):
            here = score[p]
            if here == NEVER:
                continue
            end = p + longest
            single = get(seg[p], 1)
            if single >= 0:
                s = here + BYTE_SCORE * len(self.spell(seg[p]))
            else:
                s = here + single
            if s > score[p + 1]:  # the first to reach a total has the longest last piece
                score[p + 1], back[p + 1] = s, p
            if single > 0:
                continue
            for q in range(p + 2, (end if end < n else n) + 1):
                s = get(seg[p:q], 1)
                if s < 0:
                    s += here
                    if s > score[q]:
                        score[q], back[q] = s, p
                elif s:
                    break
        return score, back

    def path(self, seg: str, back: list[int], start: int) -> list[int]:
        ids: list[int] = []
        q = len(seg)
        while q > start:
            p = back[q]
            i = self.id.get(seg[p:q])
            ids.extend(reversed(self.spell(seg[p])) if i is None else [i])
            q = p
        return ids[::-1]

    def encode(self, t: str) -> tuple[bytes, int]:
        """(int32 ids, score) of a prepared text between two boundaries."""
        get, ids = self.known.get, []
        for seg in self.segment.findall(t):
            ids.append(get(seg) or self._word(seg))
        raw = b"".join(ids)
        return raw, int(self.by_id[np.frombuffer(raw, np.int32)].sum())

    def _word(self, seg: str) -> bytes:
        """Ids of a segment that the younger generation does not hold."""
        found = self.older.get(seg)
        if found is None:
            found = np.array(self.path(seg, self.best(seg)[1], 0), np.int32).tobytes()
        if len(seg) <= 64:
            if len(self.known) >= CACHE // 2:
                self.older = dict(self.known)
                self.known.clear()  # the same dict: callers hold its lookup
            self.known[seg] = found
        return found

    def decode(self, ids) -> bytes:
        out = b"".join(map(self.bytes.__getitem__, ids))
        return out[1:]  # the blank at the beginning


def prepare(text: str, first: bool = True) -> str:
    t = text.replace(BLANK, ESCAPED).replace(" ", BLANK)
    return BLANK + t if first and text else t


# ------------------------------------------------------------------ matrices of a chunk

def _cuts(v: Pieces, t: str, lo: int, hi: int) -> tuple[int, int] | None:
    """First and last sure boundary in [lo, hi]: before a word or a line end."""
    if not v.cuttable:
        return None
    places = [m.start() for m in re.finditer(rf"(?<![{BLANK}]){BLANK}|\n", t[:hi + 1]) if lo <= m.start() <= hi and m.start()]
    return (places[0], places[-1]) if places else None


def transfer(v: Pieces, t: str, n: int) -> np.ndarray:
    """L x L scores: from entry offset a to n + b; edges begin before n (n <= len(t))."""
    width = v.longest
    m = np.full((width, width), NEVER, np.int64)
    cut = _cuts(v, t, width, n)
    if cut is None:
        for a in range(min(width, n + 1)):
            score, _ = v.best(t, a, n)
            for b in range(min(width, len(t) - n + 1)):
                m[a, b] = score[n + b]
        return m
    f, g = cut
    inner = v.encode(t[f:g])[1]
    tail, _ = v.best(t[g:], 0, n - g)
    for a in range(width):
        head, _ = v.best(t[:f], a)
        if head[f] > NEVER:
            for b in range(min(width, len(t) - n + 1)):
                if tail[n + b - g] > NEVER:
                    m[a, b] = head[f] + inner + tail[n + b - g]
    return m


def combine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Product under (max, +)."""
    return np.maximum((x[:, :, None] + y[None, :, :]).max(axis=1), NEVER)


def route(mats: list[np.ndarray], entry: int, leave: int) -> list[int]:
    """Boundary offsets before, between and behind the matrices on the best path."""
    score = np.full(mats[0].shape[0], NEVER, np.int64)
    score[entry] = 0
    came = []
    for m in mats:
        step = score[:, None] + m
        came.append(step.argmax(axis=0))
        score = np.maximum(step.max(axis=0), NEVER)
    out = [leave]
    for c in reversed(came):
        out.append(int(c[out[-1]]))
    return out[::-1]


# ------------------------------------------------------------------ Spark side

def _encode_small(path: str | None):
    def run(batches):
        import pyarrow as pa
        v = Pieces.of(path)
        for batch in batches:
            data, off = text_buffers(batch.column(1))
            raw = data.tobytes()
            parts, scores = [], []
            for i in range(len(off) - 1):
                ids, s = v.encode(prepare(raw[off[i]:off[i + 1]].decode("utf-8", "replace")))
                parts.append(ids)
                scores.append(s)
            ends = np.concatenate(([0], np.cumsum([len(p) // 4 for p in parts]))).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(parts), np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids, pa.array(scores, pa.int64())],
                                             names=["row", "ids", "score"])
    return run


def _chunks(chunk: int, ahead: int):
    """Chunks of giant texts with the characters ahead that a piece may reach into."""
    def run(frames):
        import pandas as pd
        for df in frames:
            for rid, text in zip(df["rid"], df["text"]):
                n = -(-len(text) // chunk)
                for c in range(n):
                    yield pd.DataFrame({"rid": [rid], "c": [c], "last": [c == n - 1],
                                        "part": [text[c * chunk:(c + 1) * chunk]],
                                        "ahead": [text[(c + 1) * chunk:(c + 1) * chunk + ahead]]})
    return run


def _prepared(row_part: str, row_ahead: str, c: int) -> tuple[str, int]:
    """Prepared characters of a chunk with those ahead, and how many are its own."""
    own = prepare(row_part, c == 0)
    return own + prepare(row_ahead, False), len(own)


def _matrices(path: str | None):
    def run(frames):
        import pandas as pd
        v = Pieces.of(path)
        for df in frames:
            mats = [transfer(v, *_prepared(p, a, c)).tobytes() for p, a, c in zip(df["part"], df["ahead"], df["c"])]
            yield pd.DataFrame({"rid": df["rid"], "c": df["c"], "m": mats})
    return run


def _square(raw: bytes) -> np.ndarray:
    m = np.frombuffer(raw, np.int64)
    return m.reshape(math.isqrt(len(m)), -1)


def _product(df):
    import pandas as pd
    df = df.sort_values("c")
    m = _square(df["m"].iloc[0])
    for raw in df["m"].iloc[1:]:
        m = combine(m, _square(raw))
    return pd.DataFrame({"rid": df["rid"].iloc[:1], "b": df["c"].iloc[:1] // FAN, "m": [m.tobytes()]})


def _route_blocks(df):
    import pandas as pd
    df = df.sort_values("b")
    mats = [_square(x) for x in df["m"]]
    at = route(mats, 0, 0)
    return pd.DataFrame({"rid": df["rid"], "b": df["b"], "entry": at[:-1], "leave": at[1:],
                         "score": [int(m[a, b]) for m, a, b in zip(mats, at, at[1:])]})


def _route_chunks(df):
    import pandas as pd
    df = df.sort_values("c")
    at = route([_square(x) for x in df["m"]], int(df["entry"].iloc[0]), int(df["leave"].iloc[0]))
    return pd.DataFrame({"rid": df["rid"], "c": df["c"], "entry": at[:-1], "leave": at[1:]})


def _backtrace(path: str | None):
    def run(frames):
        import pandas as pd
        v = Pieces.of(path)
        for df in frames:
            ids = []
            for r in df.itertuples():
                t, n = _prepared(r.part, r.ahead, r.c)
                ids.append(np.frombuffer(v.encode(t[r.entry:n + r.leave])[0], np.int32).tolist())
            yield pd.DataFrame({"rid": df["rid"], "c": df["c"], "ids": ids})
    return run


def _encode_giant(giant: DataFrame, path: str | None, chunk: int) -> DataFrame:
    ahead = 64  # characters; more than the longest piece, checked below
    if Pieces.of(path).longest > ahead:
        raise ValueError("pieces of more than 64 characters")
    chunks = materialise(giant.select("rid", "text").mapInPandas(
        _chunks(chunk, ahead), "rid long, c int, last boolean, part string, ahead string").repartition("rid", "c"), "chunks")
    mats = materialise(chunks.select("rid", "c", "part", "ahead").mapInPandas(_matrices(path), "rid long, c int, m binary"),
                       "matrices")
    mats = mats.withColumn("b", F.floor(F.col("c") / FAN).cast("int"))
    blocks = mats.groupBy("rid", "b").applyInPandas(_product, "rid long, b int, m binary")
    routed = materialise(blocks.groupBy("rid").applyInPandas(
        _route_blocks, "rid long, b int, entry int, leave int, score long"), "block-routes")
    routes = (mats.join(routed.drop("score"), ["rid", "b"]).groupBy("rid", "b")
              .applyInPandas(_route_chunks, "rid long, c int, entry int, leave int"))
    parts = chunks.join(routes, ["rid", "c"]).mapInPandas(_backtrace(path), "rid long, c int, ids array<int>")
    whole = parts.groupBy("rid").agg(F.flatten(F.transform(
        F.array_sort(F.collect_list(F.struct("c", "ids"))), lambda x: x["ids"])).alias("ids"))
    return whole.join(routed.groupBy("rid").agg(F.sum("score").alias("score")), "rid").select("rid", "ids", "score")


def encode(docs: DataFrame, text_col: str = "text", path: str | None = None, chunk: int = CHUNK) -> DataFrame:
    """The columns of ``docs`` but the text (as a struct ``row``), ids and score.
    ``chunk`` must not be below the longest piece."""
    ship(docs.sparkSession)
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col])
    rows = docs.select(rest.alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    small = rows.where(F.char_length("text") <= chunk).mapInArrow(
        _encode_small(path), f"row {kind}, ids array<int>, score long")
    giant = materialise(rows.where(F.char_length("text") > chunk)
                        .withColumn("rid", F.monotonically_increasing_id()), "giants")
    whole = giant.select("rid", "row").join(_encode_giant(giant, path, chunk), "rid")
    return small.unionByName(whole.select("row", "ids", "score"))


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """The rows of ``encoded`` with their ``text``."""
    ship(encoded.sparkSession)
    names = encoded.columns
    at = names.index("ids")

    def run(batches):
        import pyarrow as pa
        v = Pieces.of(path)
        for batch in batches:
            ids = batch.column(at)
            ends = np.asarray(ids.offsets)
            flat = np.asarray(ids.values)
            texts = [v.decode(flat[a:b].tolist()).decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*names, "text"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(run, f"{fields}, text string")


def encode_documents(docs: DataFrame, text_col: str = "text", **kw) -> DataFrame:
    """Pipeline form: the columns of ``docs`` but the text, with ids and n_ids (columns
    that have these names already are replaced)."""
    docs = docs.drop(*{"ids", "n_ids"} & set(docs.columns))
    return encode(docs, text_col, **kw).select("row.*", "ids", F.size("ids").alias("n_ids"))
