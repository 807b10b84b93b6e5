"""Toxicity by noisy-channel deobfuscation.

1. A character trigram model is counted over the words of all documents.
2. Every token with a letter and a digit, symbol or doubled letter, and every run of three or more
   one-character tokens, is read as a lattice, however long: every character may stand for
   itself, for the letters it imitates, or for nothing; runs may shrink to one or two
   letters; a blank between single characters may end a word or stand for nothing.  The Viterbi
   path under the character model is the restored text.  Symbols at a token's edges may be punctuation
   or letters: both readings are decoded.  A token without any letter is a number or punctuation.
3. Restored and ordinary words and their beginnings (4, 5 and 6 bytes) are the features
   of a logistic regression on labelled documents; those that occur in clean documents
   as often as in toxic ones are left out beforehand.

The character model covers every document.  Word evidence is learned from at most
``MAX_FIT`` distinct labelled texts, the first by hash, of which near copies (an equal
minimum of hashed 5-word windows under one of ``SKETCHES`` hash functions) count once:
else the rare words of one often copied text would look like evidence.  Both tables
have constant bounds (ALPHABET^3 counts, ``MAX_FEATURES`` weights).

Defined results: NULL and empty texts get the intercept's score; without labelled rows
of both kinds all scores are 0; repeated rows are scored each.
"""

from __future__ import annotations

import math
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, mix64, ship, text_buffers, text_slices, text_tokens
from .quality_knn import sample_labelled

ALPHABET = 64
MAX_FIT = 20_000
MAX_FEATURES = 4096
SKETCHES = 3
MIN_DOCS = 5      # toxic documents that must hold a feature
MIN_LIFT = 1.0    # log-odds over the prior
PRIOR_ROWS = 5.0
RIDGE = 0.0002
PREFIXES = (4, 5, 6)
CACHED_SPOT = 80  # restored spots up to this many characters are remembered by a task

#: Letters a character imitates.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "*": "", "#": "h"}
SEPARATORS = set(".-_*~'^/\\ ·")
SUBSTITUTE, DROP, COLLAPSE, WORD_END = -1.0, -1.0, -0.5, -1.0  # log channel costs


def _letter_classes():
    """Class of each code point: 0 no letter, 1-26 a-z, 27-58 U+00E0-U+00FF, 59 others."""
    lut = np.zeros(0x181, np.int64)
    for c in range(0x180):
        low = chr(c).lower()[0]
        if not chr(c).isalpha():
            continue
        if "a" <= low <= "z":
            lut[c] = ord(low) - 96
        elif 0xE0 <= ord(low) <= 0xFF:
            lut[c] = 27 + ord(low) - 0xE0
        else:
            lut[c] = 59
    lut[0x180] = 59
    return lut


_CLASS = _letter_classes()


def classes(text: str) -> np.ndarray:
    cp = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    return _CLASS[np.minimum(cp, 0x180)]


def fit_characters(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Log-probabilities [a, b, c] of a class after two others; 0 is the word's edge.
    ALPHABET^3 counts at most come back."""
    def run(batches):
        import pyarrow as pa
        total = np.zeros(ALPHABET ** 3, np.int64)
        for batch in batches:
            data, off = text_buffers(batch.column(0))
            for i, j in text_slices(off):
                # No letter is lost between texts: each slice is padded, texts meet at an edge.
                text = "\n\n".join(data[off[t]:off[t + 1]].tobytes().decode("utf-8", "replace") for t in range(i, j))
                c = classes("\n\n" + text + "\n\n")
                if len(c) > 4:
                    idx = c[:-2] * ALPHABET ** 2 + c[1:-1] * ALPHABET + c[2:]
                    total += np.bincount(idx[(c[1:-1] > 0) | (c[2:] > 0)], minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["gram", "n"])

    rows = (docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("t")).mapInArrow(run, "gram long, n long")
            .groupBy("gram").agg(F.sum("n").alias("n")).toPandas())
    counts = np.zeros(ALPHABET ** 3)
    counts[rows["gram"].to_numpy()] = rows["n"].to_numpy()
    counts = counts.reshape(ALPHABET, ALPHABET, ALPHABET)
    same = np.arange(1, 59)
    counts[same, same, same] = 0  # a letter three times in a row is repetition, not spelling
    pair = counts.sum(axis=0) + 0.5  # back-off: the class after one other
    back = pair / pair.sum(axis=1, keepdims=True)
    return np.log((counts + 20 * back[None]) / (counts.sum(axis=2, keepdims=True) + 20))


def _options(ch: str, inner: bool) -> list[tuple[str, int, float]]:
    """Letters that a character may stand for, their classes and channel costs; '' drops it, a blank
    ends a word."""
    out = [(ch, 0.0)] if ch.isalpha() else []
    out += [(x, SUBSTITUTE) for x in LEET.get(ch, "")]
    if inner and ch in SEPARATORS:
        out.append(("", DROP / 2 if ch == " " else DROP))
        if ch == " ":
            out.append((" ", WORD_END))
    return [(x, int(_CLASS[min(ord(x[0]), 0x180)]) if x else 0, cost) for x, cost in out]


_known: dict = {"logp": None, "key": None, "nested": None, "spots": {}}


def _model(logp: np.ndarray):
    """The character model as nested lists; what was restored under another model is forgotten."""
    if _known["logp"] is not logp:
        key = logp.tobytes()
        if key != _known["key"]:
            _known.update(key=key, nested=logp.tolist(), spots={})
        _known["logp"] = logp
    return _known["nested"]


_BREAK = re.compile(r"\s{2,}|[\t-\r]")


def restore(spot: str, logp: np.ndarray) -> str:
    """Most likely letters behind an obfuscated spot.  States are the last two classes;
    a letter equal to the one before it may also be swallowed (repetition).  A character
    with no reading at all, a line's end and several blanks stay as an edge between words.  Paths share
    what they have in common, so memory grows with the spot's length alone."""
    table = _model(logp)
    low = _BREAK.sub("\n", spot.strip().lower())
    memo: dict = {}
    paths: dict = {(0, 0): (0.0, None)}  # score, (last letter, what precedes it)
    for i, ch in enumerate(low):
        key = (ch, 0 < i < len(low) - 1)
        options = memo.get(key)
        if options is None:
            options = memo[key] = _options(*key)
        step: dict = {}

        def offer(state, score, node):
            if state not in step or score > step[state][0]:
                step[state] = (score, node)

        for (a, b), (score, node) in paths.items():
            row = table[a][b]
            last = node[0] if node else " "
            if not options:
                offer((0, 0), score + row[0], node if last == " " else (" ", node))
            for letter, c, cost in options:
                if not letter:
                    offer((a, b), score + cost, node)
                elif letter == " ":
                    if last != " ":
                        offer((0, 0), score + cost + row[0], (" ", node))
                else:
                    offer((b, c), score + cost + row[c], (letter, node))
                    if last == letter and c:
                        offer((a, b), score + cost + COLLAPSE, node)
        paths = step
    _, node = max(((score + table[a][b][0], node) for (a, b), (score, node) in paths.items()), key=lambda x: x[0])
    out = []
    while node:
        out.append(node[0])
        node = node[1]
    return "".join(reversed(out))


def _bytes(*values) -> np.ndarray:
    out = np.zeros(256, bool)
    for v in values:
        out[list(v)] = True
    return out


_IS_LETTER = _bytes(range(65, 91), range(97, 123), range(128, 256))
_IMITATES = _bytes(b"".join(k.encode() for k, v in LEET.items() if v))
_DIGIT = _bytes(b"0123456789@$")
_CONTINUES = _bytes(range(0x80, 0xC0))


def _ends(mask, starts, ends):
    """First marked byte of each token and the byte behind its last one (empty: its start twice)."""
    pos = np.append(np.flatnonzero(mask), len(mask))
    lo, hi = np.searchsorted(pos, starts), np.searchsorted(pos, ends)
    some = hi > lo
    return np.where(some, pos[lo], starts), np.where(some, pos[np.maximum(hi - 1, 0)] + 1, starts)


def spots(data, off) -> list[tuple[int, int, int]]:
    """(text, start, end) of what is read as a lattice, in bytes of ``data``; equal tokens of a text once."""
    n = len(data)
    first, whole, starts, ends = text_tokens(data, off)
    if not len(starts):
        return []
    letter = _IS_LETTER[data]

    def total(mask):
        return np.concatenate(([0], np.cumsum(mask)))

    letters = total(letter)
    low = data | np.where((data >= 65) & (data <= 90), 32, 0).astype(np.uint8)
    twice = np.zeros(n, bool)
    twice[:-1] = (low[1:] == low[:-1]) & letter[1:] & (data[:-1] < 128)
    if n > 3:
        twice[:-3] |= (data[:-3] >= 0xC3) & (data[2:-1] == data[:-3]) & (data[3:] == data[1:-2])  # two-byte letters
    doubled = total(twice)
    double = doubled[ends - 1] > doubled[starts]
    word = letters[ends] > letters[starts]
    doc = np.searchsorted(first, np.arange(len(starts)), side="right") - 1
    _, once = np.unique(whole ^ mix64(doc.astype(np.uint64)), return_index=True)
    seen = np.zeros(len(starts), bool)
    seen[once] = True

    def chosen(a, b):
        return seen & word & (b > a) & ((letters[b] - letters[a] < b - a) | double)

    a, b = _ends(letter | _IMITATES[data], starts, ends)  # symbols at the edges are letters
    inner, _ = _ends(letter | _DIGIT[data], starts, ends)  # or punctuation
    _, last = _ends(letter, starts, ends)
    one, two = chosen(a, b), chosen(inner, last)
    two &= ~one | (inner != a) | (last != b)
    out = [(doc[one], a[one], b[one]), (doc[two], inner[two], last[two])]
    # Runs of one-character tokens, whatever stands between them.
    heads = total(~_CONTINUES[data])
    single = (heads[ends] - heads[starts] == 1) & (letter | _IMITATES[data])[starts]
    joined = np.zeros(len(starts), bool)
    joined[1:] = single[1:] & single[:-1] & (doc[1:] == doc[:-1])
    begin = np.flatnonzero(single & ~joined)
    edges = np.append(np.flatnonzero(~joined), len(starts))
    stop = edges[np.searchsorted(edges, begin, side="right")]
    run = (stop - begin >= 3) & (letters[ends[stop - 1]] > letters[starts[begin]])
    out.append((doc[begin[run]], starts[begin[run]], ends[stop[run] - 1]))
    return list(zip(*(np.concatenate(x).tolist() for x in zip(*out))))


_SALT = {p: np.uint64(0xA0761D6478BD642F * p & (1 << 64) - 1) for p in PREFIXES}


def features(data, off):
    """(text of each word, [whole, prefixes...] hashes) of letter runs."""
    first, whole, starts, ends = text_tokens(data, off, _IS_LETTER)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(first))
    cols = [whole]
    for p in PREFIXES:
        keep = ends - starts > p
        h = np.zeros(len(starts), np.uint64)
        if keep.any():
            at = starts[keep][:, None] + np.arange(p)
            low = data[at] | np.where((data[at] >= 65) & (data[at] <= 90), 32, 0).astype(np.uint8)
            h[keep] = _SALT[p]
            for k in range(p):
                h[keep] = (h[keep] ^ low[:, k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                h[keep] ^= h[keep] >> np.uint64(29)
        cols.append(h)
    return doc, np.stack(cols, axis=1) if len(whole) else np.zeros((0, 1 + len(PREFIXES)), np.uint64)


def word_features(data, off, logp):
    """Features of a slice of texts: ordinary words and those of the restored spots."""
    doc, feats = features(data, off)
    found = spots(data, off)
    if not found:
        return doc, feats
    _model(logp)
    known, raw = _known["spots"], data.tobytes()
    texts: dict[int, dict] = {}
    for d, s, e in found:
        spot = raw[s:e]
        text = known.get(spot)
        if text is None:
            text = restore(spot.decode("utf-8", "replace"), logp)
            if len(spot) <= CACHED_SPOT:
                if len(known) > 200_000:
                    known.clear()
                known[spot] = text
        texts.setdefault(d, {})[text] = None
    docs = sorted(texts)
    joined = [" ".join(texts[d]).encode() for d in docs]
    more_off = np.concatenate(([0], np.cumsum([len(r) for r in joined]))).astype(np.int64)
    more_doc, more = features(np.frombuffer(b"".join(joined), np.uint8), more_off)
    return np.concatenate((doc, np.array(docs, np.int64)[more_doc])), np.concatenate((feats, more))


def once_per_near_copy(sample: DataFrame) -> DataFrame:
    """(label, text) rows of the sample, one per set of near copies."""
    names = [f"m{s}" for s in range(SKETCHES)]

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            data, off = text_buffers(batch.column(1))
            mins = np.zeros((SKETCHES, len(off) - 1), np.int64)
            for i, j in text_slices(off):
                first, tok, _, _ = text_tokens(data[off[i]:off[j]], off[i:j + 1] - off[i])
                for t in range(j - i):
                    w = tok[first[t]:first[t + 1]]
                    h = np.zeros(max(1, len(w) - 4), np.uint64)
                    for k in range(min(5, len(w))):
                        h = mix64(h * np.uint64(31) + w[k:k + len(h)])
                    for s in range(SKETCHES):
                        mins[s, i + t] = mix64(h + np.uint64(s)).view(np.int64).min()
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, mins)], names=["label", "text", *names])

    rows = sample.mapInArrow(run, "label int, text string, " + ", ".join(f"{n} long" for n in names))
    for n in names:  # the first by text of each equal minimum
        rows = rows.groupBy(n).agg(F.min(F.struct("text", "label", *[x for x in names if x != n])).alias("r")).select(n, "r.*")
    return rows.select("label", "text")


def fit_words(docs: DataFrame, labels: DataFrame, logp, id_col: str = "doc_id", text_col: str = "text"):
    """(sorted feature hashes, weights, intercept) from the bounded sample."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            label = np.asarray(batch.column(0))
            data, off = text_buffers(batch.column(1))
            hs, ys = [], []
            for i, j in text_slices(off):
                doc, feats = word_features(data[off[i]:off[j]], off[i:j + 1] - off[i], logp)
                for d, f in _by_text(doc, feats, j - i):
                    h = np.unique(f)
                    hs.append(h[h != 0])
                    ys.append(np.full(len(hs[-1]), label[i + d]))
            if hs:
                h, y = np.concatenate(hs), np.concatenate(ys)
                u, at, n = np.unique(h, return_inverse=True, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(u.view(np.int64)), pa.array(n.astype(np.int64)),
                     pa.array(np.bincount(at, weights=y, minlength=len(u)).astype(np.int64))], names=["h", "n", "toxic"])

    sample = materialise(once_per_near_copy(sample_labelled(docs, labels, "toxic", MAX_FIT, id_col, text_col)), "fit-texts")
    n, toxic = sample.agg(F.count("*"), F.sum("label")).first()
    if not n or not toxic:
        return None
    if toxic == n:
        return None
    pi = toxic / n
    lift = (F.col("toxic") + PRIOR_ROWS * pi) / (F.col("n") + PRIOR_ROWS)
    rows = (sample.mapInArrow(run, "h long, n long, toxic long").groupBy("h")
            .agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic")).where(F.col("toxic") >= MIN_DOCS)
            .where(F.log(lift / (1 - lift)) - math.log(pi / (1 - pi)) >= MIN_LIFT)
            .orderBy(F.desc((F.col("toxic") - F.col("n") * pi) / F.sqrt(F.col("n"))), "h").limit(MAX_FEATURES).toPandas())
    h = np.sort(rows["h"].to_numpy().astype(np.int64).view(np.uint64))
    if not len(h):
        return h, np.zeros(0), math.log(pi / (1 - pi))

    def present(batches):
        import pyarrow as pa
        for batch in batches:
            data, off = text_buffers(batch.column(1))
            terms: list[list[str]] = [[] for _ in range(len(off) - 1)]
            for i, j in text_slices(off):
                for d, f in zip(*_hits(*word_features(data[off[i]:off[j]], off[i:j + 1] - off[i], logp), h)):
                    terms[i + d].append(str(f))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.float64()), pa.array(terms, pa.list_(pa.string()))],
                                             names=["label", "terms"])

    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import CountVectorizerModel
    names = [str(i) for i in range(len(h))]
    vectors = CountVectorizerModel.from_vocabulary(names, inputCol="terms", outputCol="features").setBinary(True).transform(
        materialise(sample.mapInArrow(present, "label double, terms array<string>"), "fit-terms"))
    fitted = LogisticRegression(regParam=RIDGE, standardization=False, maxIter=40).fit(vectors)
    return h, fitted.coefficients.toArray(), fitted.intercept


def _hits(doc, feats, h):
    """Distinct (text, place in ``h``) pairs of the features found."""
    if not len(h) or not len(feats):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    slot = np.uint64((1 << 20) - 1)
    maybe = np.zeros(1 << 20, bool)
    maybe[(h & slot).astype(np.int64)] = True
    row, col = np.nonzero(maybe[(feats & slot).astype(np.int64)])
    f = feats[row, col]
    at = np.minimum(np.searchsorted(h, f), len(h) - 1)
    same = h[at] == f
    pairs = np.unique(doc[row[same]] * np.int64(len(h)) + at[same])
    return pairs // len(h), pairs % len(h)


def _by_text(doc, feats, n: int):
    order = np.argsort(doc, kind="stable")
    doc, feats = doc[order], feats[order]
    cut = np.searchsorted(doc, np.arange(n + 1))
    for d in range(n):
        yield d, feats[cut[d]:cut[d + 1]].ravel()


def log_odds(doc, feats, n: int, model) -> np.ndarray:
    h, weights, intercept = model
    text, at = _hits(doc, feats, h)
    return intercept + np.bincount(text, weights=weights[at], minlength=n)


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row of ``docs``; ``labels`` are those to learn from."""
    ship(docs.sparkSession)
    logp = fit_characters(docs, text_col)
    model = fit_words(docs, labels, logp, id_col, text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    if model is None:
        return rows.select("doc_id", F.lit(0.0).alias("score"))
    held = docs.sparkSession.sparkContext.broadcast((logp, model))

    def run(batches):
        import pyarrow as pa
        logp, model = held.value
        for batch in batches:
            data, off = text_buffers(batch.column(1))
            z = np.zeros(len(off) - 1)
            for i, j in text_slices(off):
                doc, feats = word_features(data[off[i]:off[j]], off[i:j + 1] - off[i], logp)
                z[i:j] = log_odds(doc, feats, j - i, model)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-z)))], names=["doc_id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, score double")
