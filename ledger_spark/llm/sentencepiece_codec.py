"""SentencePiece (BPE with byte fallback) encoding and decoding.

The model's vocabulary and scores are read from its file; segmentation and merging are done here
in vectorised rounds (``merges``), and decoding by joining the bytes of the pieces.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledger_spark.llm.merges import PairTable, WordCache, merge_words
from ledger_spark.llm.tables import pieces, share, shared

SPACE = "▁"
CHUNK_BYTES = 1_000_000


def _each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    """The library decodes each byte that belongs to no character to a U+FFFD of its own."""
    return "\ufffd" * (error.end - error.start), error.end


class PieceModel:
    """Lookup tables of a BPE model with identity normalisation, dummy prefix and byte fallback."""

    def __init__(self, vocabulary: list[tuple[str, float]], byte_ids: list[int], special: set[int]):
        plain = {p: i for i, (p, _) in enumerate(vocabulary) if i not in special}
        for i in byte_ids:
            plain.pop(vocabulary[i][0], None)
        scores = sorted({s for p, s in vocabulary if p in plain}, reverse=True)
        rank_of = {s: r for r, s in enumerate(scores)}
        # Symbols: piece ids, then code points of characters that are no piece.
        self.pieces = len(vocabulary)
        self.byte_ids = np.array(byte_ids, dtype=np.int32)
        self.symbol_of = np.arange(0x110000, dtype=np.int32) + self.pieces
        for piece, i in plain.items():
            if len(piece) == 1:
                self.symbol_of[ord(piece)] = i
        left, right, rank, merged = [], [], [], []

        def symbol(part: str) -> int | None:
            return int(self.symbol_of[ord(part)]) if len(part) == 1 else plain.get(part)

        for piece, i in plain.items():
            for k in range(1, len(piece)):
                a, b = symbol(piece[:k]), symbol(piece[k:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    rank.append(rank_of[vocabulary[i][1]])
                    merged.append(i)
        self.table = PairTable(*(np.array(x, dtype=np.int64) for x in (left, right, rank, merged)))
        self.bytes_of = [p.replace(SPACE, " ").encode() for p, _ in vocabulary]
        for value, i in enumerate(byte_ids):
            self.bytes_of[i] = bytes([value])
        for i in special:
            self.bytes_of[i] = b""
        # No piece holds a space after another character, so none crosses such a place; a
        # character that occurs in single pieces only never merges.
        if any(SPACE in p.lstrip(SPACE) for p in plain):
            raise ValueError("pieces that reach over a space are not supported")
        joined = {c for p in plain if len(p) > 1 for c in p} - {SPACE}
        kinds = "".join(map(re.escape, sorted(joined)))
        self.words = re.compile(f"{SPACE}+[{kinds}]*|[{kinds}]+|[^{SPACE}{kinds}]", re.DOTALL)

    @classmethod
    def load(cls, path: str) -> PieceModel:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = range(model.get_piece_size())
        vocabulary = [(model.id_to_piece(i), model.get_score(i)) for i in size]
        byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        special = {i for i in size if model.is_control(i) or model.is_unknown(i)}
        return cls(vocabulary, byte_ids, special)

    def split(self, text: str) -> list[str]:
        return self.words.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and the number of each."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ids, counts = merge_words(self.symbol_of[points], lengths, self.table)
        unknown = np.flatnonzero(ids >= self.pieces)
        if not len(unknown):
            return ids, counts
        spelled = [
            self.byte_ids[list(chr(i - self.pieces).encode())] for i in ids[unknown].tolist()
        ]
        sizes = np.ones(len(ids), dtype=np.int64)
        sizes[unknown] = [len(x) for x in spelled]
        out = np.repeat(ids, sizes)
        begin = np.cumsum(sizes) - sizes
        for at, x in zip(begin[unknown].tolist(), spelled, strict=True):
            out[at : at + len(x)] = x
        word = np.repeat(np.arange(len(words)), counts)
        return out, np.bincount(word, weights=sizes, minlength=len(words)).astype(np.int64)

    def decode(self, ids) -> str:
        """Text of the ids: the dummy space of the first piece goes, stray bytes become U+FFFD."""
        codecs.register_error("each_byte", _each_byte)
        text = b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "each_byte")
        return text[1:] if text.startswith(" ") and ids[0] != self.byte_ids[32] else text


def encode_decode(
    df: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row (id, ids array<int>, decoded string) for each row of ``df``; other columns are left
    out. No shuffle: each task works through its rows in slices of about a megabyte.

    NULL counts as the empty text, which has no ids and decodes to the empty text. Repeated rows
    and NULL ids are kept as they are; an empty table gives an empty table.
    """
    model = share(df.sparkSession, PieceModel.load(model_path))  # vocabulary only

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared(model)
        cache = WordCache(codec.encode_words)
        for batch in pieces(batches, 1, CHUNK_BYTES):
            words, bounds = [], [0]
            for text in batch.column(1).to_pylist():
                words += codec.split(text or "")
                bounds.append(len(words))
            codes = cache.codes(words)
            ids = cache.ids(codes)
            ends = np.append(0, np.cumsum(cache.counts[codes]))[bounds]
            values = ids.tolist()
            decoded = [
                codec.decode(values[a:b])
                for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())),
                    pa.array(decoded, pa.string()),
                ],
                ["id", "ids", "decoded"],
            )

    kind = df.schema[id_column].dataType.simpleString()
    rows = df.select(id_column, text_column)
    return rows.mapInArrow(run, f"id {kind}, ids array<int>, decoded string").withColumnRenamed(
        "id", id_column
    )
