"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Weights are learned by follow-the-regularised-leader with elastic-net penalties, then one
temperature is fitted on rows kept out of that. Document frequencies come from all labelled rows;
the regression is fitted on a sample of at most ``MAX_ROWS_PER_LANGUAGE`` of them per language.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledger_spark.llm.tables import from_text, pieces, share, shared

BUCKETS = 1 << 15
MAX_ROWS_PER_LANGUAGE = 400
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.001
UNDETERMINED = "und"
CHUNK_BYTES = 4_000_000


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and counts of the runs of one to three characters in lower case; whatever is not a
    letter counts as one blank. No letter, no grams."""
    words = "".join(c if c.isalpha() else " " for c in set(text or "")).split()
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    points = np.frombuffer((text or "").lower().encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    kinds, at = np.unique(points, return_inverse=True)
    letters = np.array([chr(int(k)).isalpha() for k in kinds])
    kinds[~letters] = 32
    points = np.concatenate([[np.uint64(32)], kinds[at], [np.uint64(32)]])
    blank = points == 32
    points = points[~(blank & np.append(False, blank[:-1]))]
    mix = np.uint64(0x9E3779B97F4A7C15)
    one = points * mix
    two = (one[:-1] ^ (one[:-1] >> np.uint64(31))) * mix + points[1:]
    three = (two[:-1] ^ (two[:-1] >> np.uint64(29))) * mix + points[2:]
    hashed = [(x * mix) >> np.uint64(49) for x in (one, two, three)]
    counts = np.bincount(np.concatenate(hashed).astype(np.int64), minlength=BUCKETS)
    found = np.flatnonzero(counts)
    return found, counts[found]


class LanguageModel:
    """Inverse document frequencies, weights of each language and the temperature."""

    def __init__(self, languages: list[str], idf: np.ndarray):
        self.languages, self.idf = languages, idf
        self.weights = np.zeros((len(languages), BUCKETS), dtype=np.float32)
        self.temperature = 1.0

    def features(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        found, counts = gram_counts(text)
        values = np.log1p(counts) * self.idf[found]
        norm = np.sqrt((values * values).sum())
        return found, values / norm if norm else values

    def scores(self, at: np.ndarray, values: np.ndarray) -> np.ndarray:
        return self.weights[:, at] @ values

    def fit(self, rows: list[tuple[int, np.ndarray, np.ndarray]]) -> None:
        """Every fifth row of each language is kept for the temperature, never its first one.

        Languages start to count at different places, so many languages of few rows keep some too.
        """
        learn, keep, seen = [], [], Counter()
        for row in rows:
            label, place = row[0], seen[row[0]]
            seen[label] += 1
            (keep if place and (place + label) % 5 == 4 else learn).append(row)
        z = np.zeros_like(self.weights, dtype=np.float64)
        n = np.zeros_like(z)
        for _ in range(EPOCHS):
            for label, at, values in learn:
                zi, ni = z[:, at], n[:, at]
                w = np.where(
                    np.abs(zi) > L1,
                    (np.sign(zi) * L1 - zi) / ((BETA + np.sqrt(ni)) / ALPHA + L2),
                    0.0,
                )
                p = softmax(w @ values)
                p[label] -= 1.0
                g = p[:, None] * values[None, :]
                step = (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA
                z[:, at] = zi + g - step * w
                n[:, at] = ni + g * g
        w = (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        self.weights = np.where(np.abs(z) > L1, w, 0.0).astype(np.float32)
        scored = [(label, self.scores(at, values)) for label, at, values in keep]

        def loss(temperature: float) -> float:
            return sum(-np.log(softmax(s / temperature)[y] + 1e-12) for y, s in scored)

        if scored:
            self.temperature = float(min(np.geomspace(0.05, 5.0, 41), key=loss))

    def predict(self, text: str | None) -> tuple[str, float]:
        at, values = self.features(text)
        if not len(at) or not self.languages:
            return UNDETERMINED, 0.0
        p = softmax(self.scores(at, values) / self.temperature)
        best = int(np.argmax(p))
        return self.languages[best], float(p[best])


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max())
    return e / e.sum()


def _sample(rows: DataFrame) -> DataFrame:
    """(lang, rank, text): of each language the distinct texts of smallest hash, up to the bound.

    Only hashes below a share that leaves about four times the bound are ranked, so what meets in the
    task of a language does not grow with the table; copies of a text count once.
    """
    hashed = rows.withColumn("hash", F.xxhash64("text"))
    counts = hashed.groupBy("lang").agg(F.approx_count_distinct("hash").alias("n"))  # per language
    share_kept = F.least(F.lit(1.0), 4.0 * MAX_ROWS_PER_LANGUAGE / F.col("n"))
    place = F.shiftrightunsigned("hash", 11) / F.lit(float(1 << 53))
    keys = (
        hashed.select("lang", "hash")
        .join(F.broadcast(counts), "lang")
        .where(place <= share_kept)
        .select("lang", "hash")
        .distinct()
    )
    first = Window.partitionBy("lang").orderBy("hash")
    keys = keys.withColumn("rank", F.row_number().over(first))
    keys = keys.where(F.col("rank") <= MAX_ROWS_PER_LANGUAGE)
    found = hashed.join(F.broadcast(keys), ["lang", "hash"])
    return found.groupBy("lang", "rank").agg(F.min("text").alias("text"))


def train(labelled: DataFrame, text_column: str = "text", lang_column: str = "lang") -> LanguageModel:
    """The model of the rows that have a language; no other column is looked at.

    The driver gets one number per bucket and the whole texts of the sample, whose rows are bounded and
    whose bytes are not. Without labelled rows the model knows no language and predicts ``und``.
    """
    rows = labelled.where(F.col(lang_column).isNotNull() & F.col(text_column).isNotNull()).select(
        F.col(lang_column).alias("lang"), F.col(text_column).alias("text")
    )

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS + 1, dtype=np.int64)  # the last one counts the rows
        for batch in pieces(batches, 0, CHUNK_BYTES):
            for text in batch.column(0).to_pylist():
                total[gram_counts(text)[0]] += 1
                total[BUCKETS] += 1
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found, pa.int32()), pa.array(total[found], pa.int64())], ["bucket", "n"]
        )

    counted = rows.select("text").mapInArrow(frequencies, "bucket int, n long")
    df = np.zeros(BUCKETS + 1, dtype=np.int64)
    for bucket, n in counted.groupBy("bucket").agg(F.sum("n")).collect():
        df[bucket] = n
    idf = np.log((1.0 + df[BUCKETS]) / (1.0 + df[:BUCKETS])) + 1.0
    sample = _sample(rows).collect()
    sample.sort(key=lambda r: (r["rank"], r["lang"]))
    languages = sorted({r["lang"] for r in sample})
    model = LanguageModel(languages, idf.astype(np.float64))
    place = {lang: i for i, lang in enumerate(languages)}
    if languages:
        model.fit([(place[r["lang"]], *model.features(r["text"])) for r in sample])
    return model


def predict(df: DataFrame, model: LanguageModel, text_column: str = "text") -> DataFrame:
    """``df`` with ``lang_pred`` and ``score`` (0 to 1), replaced if there; all rows stay.

    NULL, empty texts and texts without a letter are ``und`` with score 0. No shuffle.
    """
    model_of_task = share(df.sparkSession, model)

    def start():
        known = shared(model_of_task)

        def compute(texts: list[str | None]) -> list[pa.Array]:
            found = [known.predict(t) for t in texts]
            return [
                pa.array([f[0] for f in found], pa.string()),
                pa.array([f[1] for f in found], pa.float64()),
            ]

        return compute

    return from_text(df, text_column, "lang_pred string, score double", start, CHUNK_BYTES)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept out of training; one without an id is."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))
