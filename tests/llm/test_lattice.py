"""Obfuscated text: lattices against all readings, and the forms through the whole operator."""
import itertools

import numpy as np
import pytest

from tabforge.llm import toxicity


@pytest.fixture(scope="module")
def words(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")


@pytest.fixture(scope="module")
def logp(words):
    return toxicity.fit_characters(words)


def readings(spot):
    """(text, channel cost) of every reading, letter by letter."""
    per = []
    for i, ch in enumerate(spot):
        own = [(x, cost) for x, _, cost in toxicity._options(ch, 0 < i < len(spot) - 1)]
        per.append((own or [(" ", 0.0)]) + [("swallow " + x, c + toxicity.COLLAPSE) for x, c in own if x.strip()])
    for choice in itertools.product(*per):
        text, cost = "", 0.0
        for x, c in choice:
            if x.startswith("swallow "):
                if not text or text[-1] != x[-1]:
                    break
            elif x != " " or text[-1:] not in ("", " "):
                text += x
            elif c:
                break  # a word's end where there is no word
            cost += c
        else:
            yield text, cost


def score(text, cost, logp):
    a = b = 0
    for ch in text + " ":
        c = int(toxicity._CLASS[min(ord(ch), 0x180)])
        cost += float(logp[a, b, c])
        a, b = (b, c) if c else (0, 0)
    return cost


@pytest.mark.parametrize("spot", ["1d10t", "!diot", "l0$3r", "4$$h0l3", "i d 1", "a b c", "s.t.4", "gooood", "é1è", "b4d w0", "x*y"])
def test_the_path_is_the_best_of_all_readings(logp, spot):
    best = max(score(t, c, logp) for t, c in readings(spot))
    got = toxicity.restore(spot, logp)
    assert best == pytest.approx(max(score(t, c, logp) for t, c in readings(spot) if t == got), abs=1e-9)


def test_every_form_is_found_and_clean_words_stay(spark, words):
    """Learned from the plain word alone, all forms score as it does."""
    rnd = np.random.default_rng(2)
    vocabulary = np.array(sorted({w for r in words.limit(200).collect() for w in r.text.split() if w.isalpha()} - {"idiot"}))
    rows = [(i, " ".join([*rnd.choice(vocabulary, 15), *["idiot"] * (i % 2), *rnd.choice(vocabulary, 5)])) for i in range(400)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    forms = ["idiot", "idi0t", "id!ot", "i d i o t", "1d10t", "!diot", "i d 1 0 t", "y o u a r e a n i d i o t",
             "y o u  a r e  a n\ni d i o t", "(1D10T)", "1d10t!!", "i" + "d" * 500 + "1" * 300 + "0t"]
    plain = ["paper", "good", "42", "", "well-known", "1234567", "$$$", "a b"]
    docs = spark.createDataFrame(rows + [(1000 + i, f"see {x} here") for i, x in enumerate([*forms, *plain])] + [(2000, None)],
                                 "doc_id long, text string").unionByName(words.selectExpr("doc_id + 100000 as doc_id", "text"))
    got = {r.doc_id: r.score for r in toxicity.toxicity_scores(docs, labels).where("doc_id < 100000").collect()}
    for i, form in enumerate(forms):
        assert got[1000 + i] > 0.9, form
    for i, word in enumerate(plain):
        assert got[1000 + len(forms) + i] < 0.1, word
    assert got[2000] < 0.1


def test_restored_text_belongs_to_its_model(logp):
    other = np.log(np.full_like(logp, 1 / toxicity.ALPHABET))
    data = np.frombuffer(b"an id1ot", np.uint8)
    a = toxicity.word_features(data, np.array([0, 8]), logp)[1]
    toxicity.word_features(data, np.array([0, 8]), other)
    assert (a == toxicity.word_features(data, np.array([0, 8]), logp)[1]).all()


def test_long_spots_are_linear_and_whole(logp):
    text = "i d 1 0 t " * 20_000
    assert toxicity.restore(text, logp).replace(" ", "").startswith("idiotidiot")
    data = np.frombuffer(text.encode(), np.uint8)
    assert toxicity.spots(data, np.array([0, len(data)])) == [(0, 0, len(data) - 1)]
