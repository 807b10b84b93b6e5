"""Personal data: base patterns and a linear-chain conditional random field over word shapes.

The base kinds (email, ip, card, phone) are found by their patterns and always reported.
The field labels every token of every text (runs of letters and digits; single other
characters) as outside, begin or inside of a kind.  Its features are word shapes (character
classes with the lengths of digit runs) of the token and two neighbours on either side, blanks
between them, and short words.  A chain is a line.  The best labels come from Viterbi's algorithm,
run in step over all lines of an Arrow batch in numpy.  Labelled runs that pass the kind's check
(Luhn, number of digits, parts of an address) and touch no base span are added.

Chains are cut behind tokens that every best path labels as outside (``surely_outside``), so the
cut changes nothing, and a line of a million words is decoded in short pieces.

The field is trained here, from a small labelled table: ``SEEDS``, marked lines with notations
that the patterns miss, and rows of ``labelled`` (text, spans).  Without that argument these are
windows of at most ``MAX_LABELLED`` distinct documents (those with the smallest text hashes),
labelled by the base patterns, but for windows with grouped digits or a spelled ``@`` outside
their spans.  The bound holds for the training rows alone; every text is scanned
whole.  Training is a few thousand short rows on the driver; its result is a table of
``BUCKETS`` x 9 weights.

Defined results: a NULL text is empty; empty texts have no spans; repeated rows are reported each;
spans are code points, end exclusive, by start, then kind; extra columns take no part; without
documents there are no rows.  No pattern backtracks over a long run: each is anchored
at its ``@``, ``+`` or the start of a digit run, so time grows with the length of the text.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix64, ship, text_buffers, text_slices

#: Fixed values of the contract.
KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

MAX_LABELLED = 4000   # documents of which windows are labelled by the base patterns
WINDOW = 12           # tokens kept on either side of a span, or of a window without one
BUCKETS = 1 << 15
LABELS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind
FORBIDDEN = -8.0     # an inside without its begin
ROUNDS, RIDGE = 100, 0.2

#: The hand-labelled rows: spans as [kind value].
SEEDS = """
call [phone (017) 555-7713] before noon
tel [phone 017-555-7713] or [phone 017.555.7713] after six
phone: [phone 0171 555 7713], fax [phone 0171 555 7714]
ring [phone 555-017-7713] and ask
mobile ([phone (0171) 5557713])
her number is [phone 00 49 171 5557713] at home
write to [email jane (at) mail.example.com] today
mail [email jane.doe[at]example.org], please
or [email j_doe [at] mail.example.net] instead
contact [email info(at)example.com].
send it to [email jane at mail dot example dot com] soon
paid with [card 4111.1111.1111.1111] in may
card [card 5500/0000/0000/0004] was refused
the account [card 4111_1111_1111_1111] is closed
since 2021 [card 4111 1111 1111 1111] was used
no 17 [card 5500-0000-0000-0004] and others
host [ip 10.0.0.1], port 8080
from [ip 192 . 168 . 0 . 1] to [ip 172.16.5.4]:443
seen at [ip 10,1,2,3] twice
address [ip 10-1-2-3] was blocked
version 1.2.3 of 2020-10-11 costs 1,234.56 in all
chapter 4 (page 117), lines 12-15 and 20-31
order 20391 of 12/10/2019 has 3 parts
it was 10:15 on 3 may 1998, at the 2nd door
see section 3.2.1 for the 1,000,000 rows
born 1975-03-12, moved in 1998/99
"""


# ------------------------------------------------------------------ base patterns

def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        x = ord(ch) - 48
        if i % 2:
            x = 2 * x - 9 if x > 4 else 2 * x
        total += x
    return total % 10 == 0


def _digits(value: str) -> str:
    return re.sub(r"[^0-9]", "", value)


def emails(text: str):
    """Leftmost non-overlapping matches, found from every ``@``: the local part is the run of
    its characters before it, as far as the last match leaves it."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        done = m.end() if m else at + 1
        if m:
            yield start, done
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base kinds, by start, then kind."""
    out = [(s, 0, e) for s, e in emails(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text)
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        d = _digits(m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(out)


def plausible(kind: int, value: str) -> bool:
    """Check of an added span."""
    d = _digits(value)
    if kind == 0:
        low = value.lower()
        host = re.split(r"@|[\[(]\s*at\s*[\])]|\sat\s", low)
        return len(host) == 2 and bool(host[0].strip()) and bool(re.search(r"[a-z0-9](\s*\.\s*|\s+dot\s+)[a-z0-9]", host[1]))
    if kind == 1:
        parts = re.findall(r"[0-9]+", value)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == 2:
        return 12 <= len(d) <= 19 and luhn(d)
    return 9 <= len(d) <= 15


# ------------------------------------------------------------------ tokens and features

def _classes():
    c = np.arange(256, dtype=np.uint8)  # other characters stand for themselves
    c[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
    c[ord("0"):ord("9") + 1] = ord("0")
    c[ord("A"):ord("Z") + 1] = ord("A")
    c[ord("a"):ord("z") + 1] = ord("a")
    c[0x80:] = 0x80
    return c


_CLASS = _classes()
_WORD = np.isin(_CLASS, [ord("0"), ord("A"), ord("a"), 0x80])
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SALT = np.arange(1, 17, dtype=np.uint64) * _STEP


def tokens(data, breaks):
    """(starts, ends, shape, brief, word, blank, line) of the tokens of concatenated texts:
    byte positions, hashes of the shape with and without lengths of digit runs and of the
    word (0 beyond 6 bytes), whether white space comes before, and the number of the
    line; ``breaks`` are the positions where texts begin."""
    n = len(data)
    cls, word = _CLASS[data], _WORD[data]
    solid = cls != 0
    cut = np.zeros(n, bool)
    cut[breaks[breaks < n]] = True
    begin = solid.copy()
    begin[1:] &= ~(word[1:] & word[:-1]) | cut[1:]
    starts = np.flatnonzero(begin)
    if not len(starts):
        z = np.zeros(0, np.int64)
        return z, z, z.astype(np.uint64), z.astype(np.uint64), z.astype(np.uint64), z.astype(np.uint64), z
    last = np.append(starts[1:], n)
    filled = np.concatenate(([0], np.cumsum(solid)))
    ends = starts + (filled[last] - filled[starts])  # white space after a token is not part of it
    # Runs of one class inside the tokens.
    turn = solid.copy()
    turn[1:] &= (cls[1:] != cls[:-1]) | begin[1:]
    runs = np.flatnonzero(turn)
    owner = np.searchsorted(starts, runs, side="right") - 1
    rend = np.minimum(np.append(runs[1:], n), ends[owner])
    size = np.minimum(rend - runs, 31).astype(np.uint64)
    kind = cls[runs].astype(np.uint64)
    first = np.searchsorted(runs, starts)
    nth = (np.arange(len(runs)) - first[owner]).astype(np.uint64)
    weight = mix64((nth + np.uint64(1)) * _STEP) | np.uint64(1)
    digit = kind == ord("0")
    shape = mix64(np.add.reduceat((kind * np.uint64(32) + np.where(digit, size, np.uint64(0)) + np.uint64(1)) * weight, first))
    brief = mix64(np.add.reduceat((kind * np.uint64(32) + np.uint64(1)) * weight, first))
    length = ends - starts
    ident = np.zeros(len(starts), np.uint64)
    for k in range(6):  # words of up to 6 bytes, packed
        has = (length > k) & (length <= 6)
        ident[has] = (ident[has] << np.uint64(8)) | _LOWER[data[starts[has] + k]]
    ident = np.where(ident > 0, mix64(ident), np.uint64(0))
    blank = np.ones(len(starts), np.uint64)
    blank[1:] = starts[1:] != ends[:-1]
    edge = (data == 10) | cut
    line = np.cumsum(edge)[starts]
    return starts, ends, shape, brief, ident, blank, line


def features(shape, brief, ident, blank, line):
    """Feature numbers (tokens x features) below ``BUCKETS``."""
    n = len(shape)

    def at(values, k):
        out = np.full(n, np.uint64(1))
        if abs(k) < n:
            a, b = (slice(k, None), slice(None, n - k)) if k > 0 else (slice(None, n + k), slice(-k, None))
            out[b] = np.where(line[a] == line[b], values[a], np.uint64(1))
        return out

    one = np.uint64(1)
    before, after = at(shape, -1), at(shape, 1)
    gap = at(blank, 1)
    spaced = shape * (one + blank * _STEP)
    rows = [spaced, before + blank, after + gap, at(brief, -1) * _STEP + brief + mix64(at(brief, 1) + blank + gap * np.uint64(7)),
            mix64(at(shape, -2)) + before, mix64(at(shape, 2)) + after, np.where(ident > 0, ident, brief), at(ident, -1),
            mix64(before + blank) * _STEP + mix64(spaced) + after]
    out = np.empty((n, len(rows)), np.int32)
    for j, r in enumerate(rows):
        out[:, j] = (mix64(r + _SALT[j]) & np.uint64(BUCKETS - 1)).astype(np.int32)
    return out


# ------------------------------------------------------------------ the field

def allowed():
    """Transition scores before training: an inside follows its begin or itself."""
    t = np.zeros((LABELS, LABELS))
    for k in range(len(KINDS)):
        t[:, 2 + 2 * k] = FORBIDDEN
        t[[1 + 2 * k, 2 + 2 * k], 2 + 2 * k] = 0.0
    return t


def _grid(line):
    """Lines by falling length: (order of first tokens, lengths)."""
    first = np.flatnonzero(np.append(True, line[1:] != line[:-1])) if len(line) else np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(line)))
    by = np.argsort(-size, kind="stable")
    return first[by], size[by]


def surely_outside(emit, trans):
    """Tokens that every best path labels as outside.

    Say "outside" leads at a token by more than 2 d, where d bounds what one transition can
    lose when labels are replaced by outside (but for the step into an inside, which loses up
    to ``into``).  Replacing a run of w other labels among such tokens changes w + 1
    transitions, and wins unless the run ends at a transition into an inside, that is right
    before a token without that lead; it still wins if w * d > into.  So a token is sure if it and
    the next into / d tokens have the lead.
    """
    inside = np.arange(2, LABELS, 2)
    d = float(trans.max() - min(trans[:, 0].min(), np.delete(trans[0], inside).min())) + 1e-3
    into = float(trans.max() - trans[0].min()) + 1e-3
    calm = emit[:, 0] - emit[:, 1:].max(1) > 2 * d
    restless = np.cumsum(~calm)
    far = np.minimum(np.arange(len(calm)) + int(into / d) + 1, len(calm) - 1)
    return calm & (restless[far] == restless)


def viterbi(emit, trans, line):
    """Best label of every token; a line starts as if an outside came before."""
    n = len(emit)
    best = np.zeros(n, np.int8)
    if not n:
        return best
    sure = surely_outside(emit, trans)
    first, size = _grid(np.cumsum(np.append(False, sure[:-1])) + line.astype(np.int64) * 2 ** 32)
    open_ = (size > 1) | ~sure[first]
    first, size = first[open_], size[open_]
    if not len(first):
        return best
    back = np.zeros((n, LABELS), np.int8)
    active = np.searchsorted(-size, -np.arange(1, int(size[0]) + 1), side="right")  # chains with more than t tokens
    score = emit[first] + trans[0]
    scores = score
    tail = np.empty((len(first), LABELS), emit.dtype)
    for t in range(1, int(size[0])):
        m = int(active[t])
        tail[m:len(scores)] = scores[m:]
        scores = scores[:m]
        at = first[:m] + t
        new = np.empty_like(scores)
        for j in range(LABELS):
            cand = scores + trans[:, j]
            frm = cand.argmax(1)
            back[at, j] = frm
            new[:, j] = cand[np.arange(m), frm]
        scores = new + emit[at]
    tail[:len(scores)] = scores
    label = tail.argmax(1).astype(np.int8)
    end = first + size - 1
    best[end] = label
    for t in range(int(size[0]) - 1, 0, -1):
        m = int(active[t])
        at = first[:m] + t
        best[at - 1] = back[at, best[at]]
    return best


def marginals(emit, trans, line):
    """(label probabilities of every token, expected transitions): forward and backward
    sums in step over all lines, scaled to one at every token."""
    first, size = _grid(line)
    steps = int(size[0])
    active = np.searchsorted(-size, -np.arange(1, steps + 1), side="right")
    local, move = np.exp(emit - emit.max(1, keepdims=True)), np.exp(trans)
    alpha, beta, scale = np.empty_like(local), np.ones_like(local), np.ones((len(local), 1))
    for t in range(steps):
        at = first[:active[t]] + t
        a = local[at] * (alpha[at - 1] @ move if t else move[0])
        scale[at] = a.sum(1, keepdims=True)
        alpha[at] = a / scale[at]
    pair = np.zeros_like(trans)
    for t in range(steps - 1, 0, -1):
        at = first[:active[t]] + t
        ahead = local[at] * beta[at] / scale[at]
        beta[at - 1] = ahead @ move.T
        pair += (alpha[at - 1].T @ ahead) * move
    prob = alpha * beta
    pair[0] += prob[first].sum(0)
    return prob, pair


def train(rows: list[tuple[str, list]], rounds: int = ROUNDS):
    """(weights, transitions) from (text, [(start, kind, end), ...]) with code point spans."""
    base = allowed()
    if not rows:
        return np.zeros((BUCKETS, LABELS), np.float32), base.astype(np.float32)
    raw = [t.encode() for t, _ in rows]
    off = np.concatenate(([0], np.cumsum([len(r) for r in raw])))
    data = np.frombuffer(b"".join(raw), np.uint8)
    starts, ends, shape, brief, ident, blank, line = tokens(data, off[:-1])
    gold = np.zeros(len(starts), np.int64)
    for i, (text, spans) in enumerate(rows):
        for s, k, e in spans:
            a, b = off[i] + len(text[:s].encode()), off[i] + len(text[:e].encode())
            inside = np.flatnonzero((starts >= a) & (starts < b))
            gold[inside] = 2 + 2 * k
            gold[inside[:1]] = 1 + 2 * k
    feats = features(shape, brief, ident, blank, line)
    used, local = np.unique(feats, return_inverse=True)
    local = local.reshape(feats.shape)
    w, trans = np.zeros((len(used), LABELS)), base.copy()
    g2w, g2t = np.full_like(w, 1e-3), np.full_like(trans, 1e-3)
    hot = np.eye(LABELS)[gold]
    new = np.append(True, line[1:] != line[:-1])
    seen = np.zeros_like(trans)
    np.add.at(seen, (np.where(new, 0, np.append(0, gold[:-1])), gold), 1.0)
    for _ in range(rounds):
        prob, pair = marginals(w[local].sum(1), trans, line)
        diff = hot - prob
        grad = np.empty_like(w)
        for j in range(LABELS):
            grad[:, j] = np.bincount(local.ravel(), np.repeat(diff[:, j], local.shape[1]), len(used))
        grad -= RIDGE * w
        step = seen - pair - RIDGE * (trans - base)
        g2w += grad * grad
        g2t += step * step
        w += 0.5 * grad / np.sqrt(g2w)
        trans += 0.5 * step / np.sqrt(g2t)
    weights = np.zeros((BUCKETS, LABELS), np.float32)
    weights[used] = w
    return weights, trans.astype(np.float32)


def added_runs(data, breaks, model):
    """(kind, byte start, byte end) of the labelled runs, in order."""
    weights, trans = model
    starts, ends, *shapes, line = tokens(data, breaks)
    if not len(starts):
        return []
    feats = features(*shapes, line)
    emit = np.zeros((len(starts), LABELS), np.float32)
    for j in range(feats.shape[1]):
        emit += weights[feats[:, j]]
    label = viterbi(emit, trans, line)
    kind = (label.astype(np.int64) + 1) // 2 - 1
    head = (label > 0) & ((label % 2 == 1) | np.append(True, (kind[1:] != kind[:-1]) | (line[1:] != line[:-1])))
    first = np.flatnonzero(head)
    stop = np.flatnonzero(np.append(label == 0, True) | np.append(head, True))
    after = stop[np.searchsorted(stop, first, side="right")]
    return [(int(kind[i]), int(starts[i]), int(ends[j - 1])) for i, j in zip(first, after)]


# ------------------------------------------------------------------ Spark

def parse_seeds(text: str = SEEDS) -> list[tuple[str, list]]:
    rows = []
    for row in text.strip().splitlines():
        plain, spans, at = "", [], 0
        for m in re.finditer(r"\[(email|ip|card|phone) ((?:[^\[\]]|\[at\])+)\]", row):
            plain += row[at:m.start()]
            spans.append((len(plain), KINDS.index(m[1]), len(plain) + len(m[2])))
            plain, at = plain + m[2], m.end()
        rows.append((plain + row[at:], spans))
    return rows


LABELLED = "text string, spans array<struct<start:long,kind:int,end:long>>"


GROUPS = re.compile(r"[0-9]++(?:[\x20().,/_-]{1,3}[0-9]++)++")
AT = re.compile(r"[\[(] ?at ?[\])]", re.IGNORECASE)


def doubtful(text: str, spans: list[dict]) -> bool:
    """Whether a window holds what may be personal data outside its spans (grouped digits, a spelled
    ``@``): the patterns cannot say that it is none, so it is no example."""
    rest = "".join("\n" if any(s["start"] <= i < s["end"] for s in spans) else ch for i, ch in enumerate(text))
    return bool(AT.search(rest)) or any(9 <= len(_digits(m[0])) <= 19 for m in GROUPS.finditer(rest))


def rule_labelled(docs: DataFrame, text_col: str = "text", limit: int = MAX_LABELLED) -> DataFrame:
    """(text, spans): windows around the base spans of at most ``limit`` distinct documents,
    and one window without a span of each."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(text.alias("text"), F.xxhash64(text).alias("th"))
    chosen = rows.select("th").distinct().orderBy("th").limit(limit)

    def run(batches):
        import pandas as pd
        for b in batches:
            out = []
            for t in b["text"]:
                base = base_spans(t)
                ranges = [(max(0, s - 8 * WINDOW), e + 8 * WINDOW) for s, _, e in base[:4]]
                mid = len(t) // 2
                if not any(s < mid + 8 * WINDOW and mid < e for s, _, e in base):
                    ranges.append((mid, mid + 8 * WINDOW))
                for a, z in ranges:
                    a = max((t.rfind(c, 0, a) + 1 for c in " \n"), default=0) if a else 0
                    z = min([i for i in (t.find(" ", z), t.find("\n", z)) if i >= 0], default=len(t))
                    if any(s < a < e or s < z < e for s, _, e in base) or z - a > 40 * WINDOW:
                        continue
                    spans = [{"start": s - a, "kind": k, "end": e - a} for s, k, e in base if a <= s and e <= z]
                    if not doubtful(t[a:z], spans):
                        out.append((t[a:z], spans))
            yield pd.DataFrame(out, columns=["text", "spans"])

    ship(docs.sparkSession)
    return (rows.join(F.broadcast(chosen), "th").dropDuplicates(["th"]).select("text").mapInPandas(run, LABELLED))


def fit(docs: DataFrame, labelled: DataFrame | None = None, text_col: str = "text"):
    """The field, trained from the seeds and the rows of ``labelled``."""
    rows = (rule_labelled(docs, text_col) if labelled is None else labelled).select("text", "spans")
    found = sorted({(r.text, tuple(sorted((s.start, s.kind, s.end) for s in r.spans or [])))
                    for r in rows.collect() if r.text})
    return train(parse_seeds() + [(t, list(s)) for t, s in found])


def personal_data(docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per document: the id and ``spans``, an array of (start, kind, end, added) by
    start, then kind; kind counts as in ``KINDS``."""
    spark = ship(docs.sparkSession)
    model = spark.sparkContext.broadcast(fit(docs, labelled, text_col))

    def run(batches):
        import pyarrow as pa
        kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("added", pa.bool_())]))
        for batch in batches:
            data, off = text_buffers(batch.column(1))
            spans: list[list] = [[] for _ in range(len(off) - 1)]
            for i, j in text_slices(off):
                part, at = data[off[i]:off[j]], off[i:j + 1] - off[i]
                seeds: dict[int, list] = {}
                for k, s, e in added_runs(part, at[:-1], model.value):
                    seeds.setdefault(int(np.searchsorted(at, s, side="right")) - 1, []).append((k, s, e))
                marks = ((part >= 48) & (part <= 57)) | (part == 64)
                marked = np.concatenate(([0], np.cumsum(marks)))
                for t in set(np.flatnonzero(marked[at[1:]] > marked[at[:-1]]).tolist()) | set(seeds):
                    raw = part[at[t]:at[t + 1]]
                    text = raw.tobytes().decode("utf-8", "replace")
                    base = base_spans(text)
                    found = [{"start": s, "kind": k, "end": e, "added": False} for s, k, e in base]
                    if t in seeds:
                        taken = sorted((s, e) for s, _, e in base)
                        reach = np.maximum.accumulate([e for _, e in taken]) if taken else np.zeros(0, np.int64)
                        points = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
                        for k, s, e in seeds[t]:
                            s, e = int(points[s - at[t]]), int(points[e - at[t]])
                            left = int(np.searchsorted([x for x, _ in taken], e)) if taken else 0
                            if (not left or reach[left - 1] <= s) and plausible(k, text[s:e]):
                                found.append({"start": s, "kind": k, "end": e, "added": True})
                        found.sort(key=lambda x: (x["start"], x["kind"]))
                    spans[i + t] = found
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=["doc_id", "spans"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, "
                                "spans array<struct<start:long,kind:int,end:long,added:boolean>>")
