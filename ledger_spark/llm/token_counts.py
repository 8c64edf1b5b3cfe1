"""Token counts without encoding: whole words that are one token are counted directly.

Offline, every vocabulary string that ends a word is encoded by the merges; those that come out as
one token are the whole-token set. A pre-token of that set counts one, only the rest is merged.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ledger_spark.llm.merges import PairTable, WordCache, merge_words
from ledger_spark.llm.tables import pieces, share, shared

CHUNK_BYTES = 2_000_000


def byte_names() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordModel:
    """A lower-casing BPE with word ends over the bytes of each word, from its JSON file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        kinds = [x["type"] for x in spec["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"unknown normalisation {kinds}")
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        self.words = regex.compile(split["pattern"]["Regex"])
        specials = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, specials)))
        vocabulary, suffix = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        columns = (
            [vocabulary[a] for a, _ in pairs],
            [vocabulary[b] for _, b in pairs],
            range(len(pairs)),
            [vocabulary[a + b] for a, b in pairs],
        )
        self.table = PairTable(*(np.array(x, dtype=np.int64) for x in columns))
        names = byte_names()
        self.inner = np.array([vocabulary[names[b]] for b in range(256)], dtype=np.int32)
        self.final = np.array([vocabulary[names[b] + suffix] for b in range(256)], dtype=np.int32)
        self.whole = self._whole_tokens(vocabulary, suffix, {c: b for b, c in names.items()})

    def _whole_tokens(self, vocabulary, suffix: str, values: dict[str, int]) -> frozenset[str]:
        """Strings proved to encode alone as one token."""
        strings = []
        for piece in vocabulary:
            if piece.endswith(suffix) and piece != suffix:
                try:
                    strings.append(bytes(values[c] for c in piece[: -len(suffix)]).decode())
                except UnicodeDecodeError:
                    continue
        _, counts = self.merge(strings)
        return frozenset(s for s, n in zip(strings, counts.tolist(), strict=True) if n == 1)

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after another, and the number of each."""
        data = [w.encode() for w in words]
        lengths = np.fromiter(map(len, data), np.int64, len(data))
        values = np.frombuffer(b"".join(data), dtype=np.uint8)
        symbols = self.inner[values]
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self.final[values[ends]]
        return merge_words(symbols, lengths, self.table)

    def counts(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For the cache: the number of tokens of each word, as one value per word."""
        counts = np.ones(len(words), dtype=np.int32)
        rest = [i for i, w in enumerate(words) if w not in self.whole]
        if rest:
            counts[rest] = self.merge([words[i] for i in rest])[1]
        return counts, np.ones(len(words), dtype=np.int64)

    def split(self, text: str) -> tuple[list[str], int]:
        """The pre-tokens of a text, and how many special tokens stand between them."""
        parts = self.special.split(text) if "<|" in text else [text]
        words: list[str] = []
        for part in parts:
            # Character by character, so a capital sigma is never a final one.
            lower = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
            words += self.words.findall(lower)
        return words, len(parts) - 1


def count_tokens(
    df: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row (id, n_bytes, n_tokens) for each row of ``df``; other columns are left out.

    NULL counts as the empty text: no bytes, no tokens. Repeated rows and NULL ids are kept; an
    empty table gives an empty table. No shuffle; memory is bounded by slices of the texts and a
    word cache of fixed size.
    """
    model = share(df.sparkSession, WordModel(model_path))  # vocabulary only

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = shared(model)
        cache = WordCache(counter.counts)
        for batch in pieces(batches, 1, CHUNK_BYTES):
            words, bounds, specials = [], [0], []
            for text in batch.column(1).to_pylist():
                found, special = counter.split(text or "")
                words += found
                bounds.append(len(words))
                specials.append(special)
            codes = cache.codes(words)
            total = np.append(0, np.cumsum(cache.flat[codes], dtype=np.int64))[bounds]
            sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(1)), 0)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    sizes.cast(pa.int64()),
                    pa.array(np.diff(total) + np.array(specials, dtype=np.int64), pa.int64()),
                ],
                ["id", "n_bytes", "n_tokens"],
            )

    kind = df.schema[id_column].dataType.simpleString()
    rows = df.select(id_column, text_column)
    return rows.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long").withColumnRenamed(
        "id", id_column
    )
