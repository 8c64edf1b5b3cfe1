"""Lexical search, vector codes and the language model against plain Python, on awkward rows."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledger_spark.llm import lexical_search, recurrent_lm, vector_codes
from ledger_spark.llm.queries import QUERIES
from tests.llm import brute

RANDOM = random.Random(9)
WORDS = ["".join(RANDOM.choice("abcdeé") for _ in range(RANDOM.randint(1, 4))) for _ in range(120)]


def prose(n):
    return " ".join(RANDOM.choice(WORDS[: RANDOM.choice([10, 120])]) for _ in range(n))


TEXTS = [None, "", " \t\r\n", "!? ...", "A", "x" * 5000, prose(4000), "É é e E\x00e\x0b_x-y", "\x1c\x85\xa0"]
TEXTS += [prose(RANDOM.randint(1, 80)) for _ in range(150)]
DOCS = [(i, t) for i, t in enumerate(TEXTS)]
DOCS += [(20, TEXTS[20]), (20, TEXTS[20]), (21, TEXTS[22]), (None, TEXTS[23]), (None, None)]
ITEMS = [(i, prose(RANDOM.randint(1, 12))) for i in range(12)]
ITEMS += [(1, ITEMS[1][1]), (None, "a b"), (20, None), (21, ""), (22, "nowhere at all"), (23, WORDS[0] * 3)]


def ranked(docs, items, k=10):
    term = "[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+"
    terms = lambda t: re.findall(term, brute.lower_ascii(t))
    held = [(d, Counter(terms(t)), len(terms(t))) for d, t in docs]
    held = [h for h in held if h[2]]
    count, length = len(held), sum(h[2] for h in held)
    out = []
    for item, text in items:
        scored = []
        for doc, tf, n in held:
            score = 0
            for t in terms(text):
                df = sum(t in h[1] for h in held)
                m = 100 - 75 + (75 * n * count) // length
                w = math.floor(1000 * math.log((2 * count + 2) / (2 * df + 1)))
                score += w * ((1000000000 * tf[t]) // (1000 * tf[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc))
        for rank, (score, _, doc) in enumerate(sorted(scored, key=lambda s: (s[0], s[1], s[2] or 0))[:k]):
            out.append((item, rank + 1, doc, -score))
    return sorted(out, key=repr)


def tables(spark, docs, items):
    text = lambda df: df.withColumns({"n": F.lit(1), "Item": F.lit("x"), "terms": F.lit(2)})
    return (
        text(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)),
        text(spark.createDataFrame(items, "item_id long, text string")),
    )


@pytest.mark.parametrize("postings", [150, 10**6])
def test_lexical_search(spark, monkeypatch, postings):
    monkeypatch.setattr(lexical_search, "POSTINGS_PER_SHARD", postings)
    got = lexical_search.search(*tables(spark, DOCS, ITEMS)).select("item_id", "rank", "doc_id", "score")
    assert sorted(map(tuple, got.collect()), key=repr) == ranked(DOCS, ITEMS)


def test_lexical_search_in_query_blocks(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "QUERY_BYTES", 100)
    got = lexical_search.search(*tables(spark, DOCS, ITEMS), k=3)
    got = got.select("item_id", "rank", "doc_id", "score")
    assert sorted(map(tuple, got.collect()), key=repr) == ranked(DOCS, ITEMS, 3)


def test_lexical_search_of_nothing(spark):
    for docs, items in (([], ITEMS), (DOCS, []), ([(1, None)], ITEMS)):
        assert lexical_search.search(*tables(spark, docs, items)).collect() == []


def test_windows_below_the_best_scores_are_skipped():
    """After strong documents, windows and lists that cannot reach them are not read."""
    size, window = 40 * lexical_search.DOCS_PER_WINDOW, lexical_search.DOCS_PER_WINDOW
    docs = np.concatenate([np.arange(size), np.arange(5)])
    terms = np.repeat([0, 1], [size, 5])
    scores = np.where(terms == 0, 1, 1000) + np.arange(len(docs)) % 2
    shard = lexical_search.Shard(terms, docs, scores, size, 2)
    keys = np.stack([np.zeros(size, int), np.arange(size)], axis=1)
    best = lexical_search.Best(5)
    read = []
    add = best.add
    best.add = lambda scores, keys: (read.append(len(scores)), add(scores, keys))
    lexical_search.search_shard(shard, [(0, 1), (1, 2)], keys, best)
    assert best.keys[:, 1].tolist() == [1, 3, 0, 2, 4]
    assert len(read) == 1 and window > 5


def codes(rows, parts=16, entries=64, rounds=2):
    kept = [r for r in rows if r[2] is not None and all(x is not None and math.isfinite(x) for x in r[2])]
    whole = [(i, label, [math.floor(256 * x) for x in v]) for i, label, v in kept]
    fit = [r for r in whole if r[2] and len(r[2]) % parts == 0]
    fit.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    size = len(fit[0][2]) // parts
    same = [r for r in fit if len(r[2]) == size * parts]
    cut = lambda v, p: v[p * size : (p + 1) * size]
    books = [[cut(r[2], p) for r in same[:entries]] for p in range(parts)]

    def nearest(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(cut(v, p), e)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        moved = []
        for p in range(parts):
            at = {}
            for r in same:
                at.setdefault(nearest(r[2], p)[1], []).append(cut(r[2], p))
            moved.append(
                [[sum(c) // len(at[i]) for c in zip(*at[i])] if i in at else e for i, e in enumerate(books[p])]
            )
        books = moved
    out, sums = [], {}
    for i, label, v in whole:
        found = [nearest(v, p) for p in range(parts)] if len(v) == size * parts else None
        error = sum(d for d, _ in found) if found else None
        out.append((i, label, found and [e for _, e in found], error))
        if found:
            sums[label] = sums.get(label, 0) + error
    return sorted(((i, c, e, sums.get(label)) for i, label, c, e in out), key=repr), books


def vector_rows(n, width):
    pick = random.Random(n)
    rows = [(i, i % 5 or None, [pick.gauss(0, 0.1) for _ in range(width)]) for i in range(3, n)]
    rows += [(n, 1, rows[0][2]), (n, 1, rows[0][2]), (None, 7, rows[2][2])]
    bad = [None, [], [None] * width, [float("nan")] * width, [float("inf")] * width, [0.5] * (width + 1)]
    return rows + [(1000 + i, 3, v) for i, v in enumerate(bad)]


@pytest.mark.parametrize(("n", "width"), [(150, 64), (20, 32), (200, 16)])
def test_vector_codes(spark, n, width):
    from ledger_spark.llm.threshold_search import usable

    rows = vector_rows(n, width)
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    whole = df.where(usable(F.col("embedding"))).repartition(3).select(
        "vec_id", "label", vector_codes.whole_numbers(F.col("embedding")).alias("v")
    )
    coded, books = vector_codes.compress(whole)
    want, entries = codes(rows)
    got = [tuple(r) for r in coded.select("vec_id", "codes", "error", "label_error").collect()]
    assert sorted(got, key=repr) == want
    assert books.tolist() == entries


def test_cells_leave_out_no_nearest_entry(monkeypatch):
    pick = np.random.default_rng(2)
    monkeypatch.setattr(vector_codes, "MAX_CELLS", 300)
    for spread in (1, 3, 40, 10**6):
        entries = pick.integers(-spread, spread + 1, (64, 3))
        points = pick.integers(-2 * spread, 2 * spread + 1, (2000, 3))
        book = vector_codes.PartCodebook(entries)
        apart = ((points[:, None, :] - entries) ** 2).sum(axis=2)
        for _ in range(2):
            index, distance = book.nearest(points)
            assert (index == apart.argmin(axis=1)).all() and (distance == apart.min(axis=1)).all()
        assert len(book.known) <= max(300, len(np.unique(points // book.edge, axis=0)))


def test_vector_codes_of_nothing_and_of_huge_numbers(spark):
    none = spark.createDataFrame([], "vec_id long, label int, v array<long>")
    coded, books = vector_codes.compress(none)
    assert coded.collect() == [] and books.size == 0
    rows = [(i, 1, [s * 1e300] * 16) for i, s in enumerate((1.0, -1.0))]
    df = spark.createDataFrame(rows, "vec_id long, label int, e array<double>")
    v = vector_codes.whole_numbers(F.col("e")).alias("v")
    coded, _ = vector_codes.compress(df.select("vec_id", "label", v))
    assert sorted((r.vec_id, r.error, r.label_error) for r in coded.collect()) == [(0, 0, 0), (1, 0, 0)]


def lm_words(text):
    return [*re.findall("[^\x20\x09-\x0d]+", brute.lower_ascii(text)), ""]


def kept_out(doc):
    return doc is None or zlib.crc32(str(doc).encode()) % 7 == 2


def test_language_model_counts(spark, monkeypatch):
    """Few frequent words, so that most are looked up in the table."""
    monkeypatch.setattr(recurrent_lm, "HEAD", 40)
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").repartition(3)
    docs = docs.withColumns({"Score": F.lit("own"), "_row": F.lit("own"), "word": F.lit("own")})
    held = recurrent_lm.held_out(F.col("doc_id"))
    model = recurrent_lm.fit(docs.where(~held).select("text"))
    got = recurrent_lm.score(docs.withColumn("held_out", held), model)
    assert got.columns == [
        *("doc_id", "_row", "word", "held_out"),
        *("n_tokens", "n_known", "train_tokens", "base_score", "score"),
    ]
    counts = Counter(w for d, t in DOCS if not kept_out(d) for w in lm_words(t))
    total = sum(counts.values())

    def want(doc, text):
        words = lm_words(text)
        logs = [math.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in words]
        known = sum(counts[w] > 0 for w in words)
        return doc, kept_out(doc), len(words), known, total, round(sum(logs), 6)

    rows = [(*r[:4], r[4], round(r[5], 6)) for r in got.select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score").collect()]
    assert sorted(rows, key=repr) == sorted((want(d, t) for d, t in DOCS), key=repr)
    # Equal texts have equal scores, and every score is a probability.
    scores = {}
    for r in got.collect():
        assert r.score < 0
        scores.setdefault(r.doc_id, set()).add(round(r.score, 4))
    assert len(scores[20]) == 1


def test_language_model_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    model = recurrent_lm.fit(none.select("text"))
    assert recurrent_lm.score(none, model).collect() == []
    some = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    rows = recurrent_lm.score(some, model).orderBy("doc_id").collect()
    assert [tuple(r)[:5] for r in rows] == [(1, 3, 0, 0, 0.0), (2, 1, 0, 0, 0.0)]


def small_lexicon():
    head = [(f"w{i}".encode(), 100 - i) for i in range(70)] + [(b"", 9)]
    return recurrent_lm.Lexicon(head, sum(n for _, n in head) + 50, 90, 60)


def plain_log_probability(net, doc, end):
    """Step by step, one document, plain formulas in double precision."""
    w = {k: v.astype(float) for k, v in net.parts(net.flat).items()}
    h, size = np.zeros(recurrent_lm.HIDDEN), recurrent_lm.HIDDEN
    total, before = 0.0, end
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    softmax = lambda x: np.exp(x - x.max()) / np.exp(x - x.max()).sum()
    for token in doc:
        x = w["embedding"][before] @ w["entry"] + w["entry_bias"]
        u = h @ w["state"]
        r, z = sigmoid(x[:size] + u[:size]), sigmoid(x[size : 2 * size] + u[size : 2 * size])
        new = np.tanh(x[2 * size :] + r * u[2 * size :])
        h = (1 - z) * new + z * h
        k, at = divmod(token, recurrent_lm.CLASS_SIZE)
        classes = softmax(h @ w["classes"] + w["classes_bias"])
        words = softmax(h @ w["words"][k] + w["words_bias"][k])
        total += math.log10(classes[k] * words[at])
        before = token
    return total


def test_network_carries_its_state_over_windows_and_sums_to_one():
    lexicon, pick = small_lexicon(), np.random.default_rng(3)
    net = recurrent_lm.Network(lexicon.frequencies)
    net.flat += pick.normal(0, 0.2, net.flat.shape).astype(np.float32)
    size = len(lexicon.frequencies)
    docs = [pick.integers(0, size, n) for n in (1, 500, 3, 90, 33, 32, 31, 700, 2)]
    got = net.log_probabilities(docs, lexicon.end)
    want = [plain_log_probability(net, d, lexicon.end) for d in docs]
    assert np.allclose(got, want, rtol=1e-4)
    one = [np.array([s]) for s in range(size)]
    assert abs((10.0 ** net.log_probabilities(one, lexicon.end)).sum() - 1) < 1e-4


def test_slopes_are_those_of_the_loss():
    lexicon, pick = small_lexicon(), np.random.default_rng(4)
    net = recurrent_lm.Network(lexicon.frequencies)
    net.flat = (net.flat + pick.normal(0, 0.2, net.flat.shape)).astype(np.float64)
    docs = [pick.integers(0, len(lexicon.frequencies), n) for n in (9, 4, 13, 2)]
    stream = recurrent_lm.Stream(docs, 2, lexicon.end)
    window, state = (0, len(stream.active)), np.zeros((2, recurrent_lm.HIDDEN), np.float32)
    _, _, slope = net.slopes(stream, window, state)

    def loss():
        return -net.slopes(stream, window, state)[0]

    for name, part in net.parts(np.arange(len(net.flat))).items():
        for at in pick.choice(part.reshape(-1), 6):
            kept, step = net.flat[at], 1e-2
            net.flat[at] = kept + step
            high = loss()
            net.flat[at] = kept - step
            low = loss()
            net.flat[at] = kept
            assert abs((high - low) / (2 * step) - slope[at]) < 2e-2, name


def test_training_beats_frequencies():
    """A language in which each word tells the next one."""
    pick = random.Random(1)
    texts = []
    for _ in range(400):
        at = pick.randrange(50)
        texts.append(" ".join(f"w{(at + 7 * i) % 50}" for i in range(20)).encode())
    counts = Counter(w for t in texts for w in recurrent_lm.words_of(t))
    head = sorted(counts.items(), key=lambda x: (-x[1], x[0]))
    lexicon = recurrent_lm.Lexicon(head, sum(counts.values()), len(counts), 60)
    net = recurrent_lm.Network(lexicon.frequencies)
    docs = [lexicon.symbols(t) for t in texts]
    before = net.log_probabilities(docs[300:], lexicon.end).sum()
    for _ in range(40):
        net.learn(docs[:300], lexicon.end)
    assert net.log_probabilities(docs[300:], lexicon.end).sum() > before / 3


@pytest.mark.parametrize("name", ["op11_lexical_search", "op12_vector_codes", "op13_recurrent_lm"])
def test_queries_are_registered(name):
    assert name in QUERIES
