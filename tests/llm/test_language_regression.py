"""The language regression against the same method written out one coordinate at a time."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledger_spark.llm import language_id as L
from ledger_spark.llm.queries import QUERIES

MASK = (1 << 64) - 1
MIX = 0x9E3779B97F4A7C15


def grams(text):
    """Bucket counts of runs of one to three characters, one at a time."""
    text = text or ""
    if not any(c.isalpha() for c in text):
        return {}
    points = [32]
    for c in [*text.lower(), " "]:
        point = ord(c) if c.isalpha() else 32
        if point != 32 or points[-1] != 32:
            points.append(point)
    found = Counter()
    for i in range(len(points)):
        one = two = None
        for length, point in enumerate(points[i : i + 3], 1):
            if length == 1:
                one = hashed = points[i] * MIX & MASK
            elif length == 2:
                two = hashed = ((one ^ (one >> 31)) * MIX + point) & MASK
            else:
                hashed = ((two ^ (two >> 29)) * MIX + point) & MASK
            found[(hashed * MIX & MASK) >> 49] += 1
    return dict(found)


def softmax(scores):
    top = max(scores)
    powers = [math.exp(s - top) for s in scores]
    return [p / sum(powers) for p in powers]


class Plain:
    """FTRL with elastic net and a temperature, in dictionaries."""

    def __init__(self, rows, texts_of_all):
        self.languages = sorted({lang for lang, _ in rows})
        self.n_rows, self.df = len(texts_of_all), Counter()
        for text in texts_of_all:
            self.df.update(grams(text).keys())
        self.z = [Counter() for _ in self.languages]
        self.n = [Counter() for _ in self.languages]
        learn, keep, seen = [], [], Counter()
        for lang, text in rows:
            label = self.languages.index(lang)
            place = seen[label]
            seen[label] += 1
            (keep if place and (place + label) % 5 == 4 else learn).append((label, self.features(text)))
        for _ in range(L.EPOCHS):
            for label, x in learn:
                p = softmax(self.scores(x))
                for k in range(len(self.languages)):
                    for i, value in x.items():
                        g = (p[k] - (k == label)) * value
                        w, n = self.weight(k, i), self.n[k][i]
                        step = (math.sqrt(n + g * g) - math.sqrt(n)) / L.ALPHA
                        self.n[k][i] = n + g * g
                        # All weights of one row are those before it.
                        self.z[k][i] += g - step * w
        self.kept = keep
        grid = [0.05 * 100 ** (i / 40) for i in range(41)]
        scored = [(label, self.scores(x)) for label, x in keep]
        loss = lambda t: sum(-math.log(softmax([s / t for s in v])[y] + 1e-12) for y, v in scored)
        self.temperature = min(grid, key=loss) if scored else 1.0

    def features(self, text):
        idf = lambda i: math.log((1 + self.n_rows) / (1 + self.df[i])) + 1
        x = {i: math.log1p(c) * idf(i) for i, c in grams(text).items()}
        norm = math.sqrt(sum(v * v for v in x.values()))
        return {i: v / norm for i, v in x.items()} if norm else x

    def weight(self, k, i):
        z = self.z[k][i]
        if abs(z) <= L.L1:
            return 0.0
        return (math.copysign(L.L1, z) - z) / ((L.BETA + math.sqrt(self.n[k][i])) / L.ALPHA + L.L2)

    def scores(self, x):
        return [sum(self.weight(k, i) * v for i, v in x.items()) for k in range(len(self.languages))]

    def predict(self, text):
        x = self.features(text)
        if not x or not self.languages:
            return L.UNDETERMINED, 0.0
        p = softmax([s / self.temperature for s in self.scores(x)])
        return self.languages[p.index(max(p))], max(p)


def _corpus(languages, each, seed=3):
    pick = random.Random(seed)
    alphabets = ["abcdeñ", "cdefgé", "efghiü", "ghijkß", "ijklmø"]
    rows = []
    for n in range(each):
        for k in range(languages):
            words = ["".join(pick.choices(alphabets[k], k=pick.randint(2, 6))) for _ in range(pick.randint(3, 12))]
            rows.append((n * languages + k, " ".join(words).capitalize() + ".", f"l{k}"))
    return rows


@pytest.mark.parametrize("text", ["", None, "12 34", "Ab", "Hola,  qué tal?", "ß" * 9, " a\n\tb ", "\U00020000x"])
def test_grams(text):
    at, counts = L.gram_counts(text)
    assert dict(zip(at.tolist(), counts.tolist(), strict=True)) == grams(text)


@pytest.mark.parametrize("languages", [2, 5])
def test_weights_temperature_and_predictions(spark, languages):
    corpus = _corpus(languages, 12)
    # A copy counts for the document frequencies, and is learned from once.
    corpus += [(1000, corpus[0][1], corpus[0][2]), (1001, None, "l0"), (1002, "sin lengua", None)]
    docs = spark.createDataFrame(corpus, "doc_id long, text string, lang string")
    model = L.train(docs)
    hashes = {
        r["text"]: r["hash"]
        for r in docs.where("text IS NOT NULL").select("text", F.xxhash64("text").alias("hash")).collect()
    }
    labelled = [(lang, text) for _, text, lang in corpus if lang is not None and text is not None]
    ranked, rank = [], Counter()
    for lang, text in sorted(set(labelled), key=lambda r: (r[0], hashes[r[1]])):
        rank[lang] += 1
        ranked.append((rank[lang], lang, text))
    plain = Plain([(lang, text) for _, lang, text in sorted(ranked)], [text for _, text in labelled])

    assert plain.kept and model.languages == plain.languages
    assert model.temperature == pytest.approx(plain.temperature)
    for k in range(languages):
        want = np.zeros(L.BUCKETS)
        for i in plain.z[k]:
            want[i] = plain.weight(k, i)
        assert np.allclose(model.weights[k], want, atol=1e-5)
        assert 0 < np.count_nonzero(want) < L.BUCKETS
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in L.predict(docs, model).collect()}
    for doc_id, text, _ in corpus:
        lang, score = plain.predict(text)
        assert got[doc_id][0] == lang and got[doc_id][1] == pytest.approx(score, abs=1e-4)


def test_the_query_against_the_plain_version(spark, tmp_path):
    """The whole query: only rows outside the held-out fifth are learned from, all are predicted."""
    import zlib

    corpus = _corpus(3, 20, seed=8)
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame(corpus, "doc_id long, text string, lang string").write.parquet(path)
    got = {r["doc_id"]: r for r in QUERIES["op9_language_id"](spark, str(tmp_path)).collect()}
    held = {d: zlib.crc32(str(d).encode()) % 5 == 0 for d, _, _ in corpus}
    hashes = {
        r["text"]: r["hash"]
        for r in spark.read.parquet(path).select("text", F.xxhash64("text").alias("hash")).collect()
    }
    labelled = [(lang, text) for d, text, lang in corpus if not held[d]]
    ranked, rank = [], Counter()
    for lang, text in sorted(set(labelled), key=lambda r: (r[0], hashes[r[1]])):
        rank[lang] += 1
        ranked.append((rank[lang], lang, text))
    plain = Plain([(lang, text) for _, lang, text in sorted(ranked)], [text for _, text in labelled])
    assert len(got) == len(corpus)
    for doc_id, text, _ in corpus:
        lang, score = plain.predict(text)
        assert got[doc_id]["held_out"] == held[doc_id]
        assert got[doc_id]["lang_pred"] == lang
        assert got[doc_id]["score"] == pytest.approx(score, abs=1e-4)
