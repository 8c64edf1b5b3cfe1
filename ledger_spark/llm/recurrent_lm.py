"""Language-model scoring: a gated recurrent network over whole documents, beside word counts.

Words are counted over all training documents. The network tells the most frequent ones apart and
all others as one rare word, which is then spread by the counts, so that its probabilities are of
whole texts. Its output is factored: a class first, then a word of the class. It is trained by
backpropagation through time that is cut at windows; the state goes on from window to window until a
document ends, in training and in scoring. Every training document is learned from once: in each
round the tasks go on from the same weights, each over its own documents, and the weights that they
reach are averaged by tokens. The driver holds the weights and the most frequent words, both of
bounded size.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ledger_spark.llm.tables import pieces, scratch, share, shared, unused

# Words that the network tells apart, and words whose counts every task holds.
VOCABULARY = 1022
HEAD = 1 << 17
HEAD_WORD_BYTES = 64
STEPS_PER_OCTAVE = 16
# Size of the network, and words in a class.
EMBEDDED, HIDDEN, CLASS_SIZE = 16, 16, 32
# Steps of a window, documents side by side, rounds of averaging, least tokens of a task.
WINDOW, LANES, TRAINING_LANES, ROUNDS, TOKENS_PER_TASK = 32, 512, 128, 4, 250_000
FEW_LANES = 16
RATE, FIRST_SQUARES = 0.1, 1e-5
# Scores are held within this, so that their powers are finite.
MOST_SCORE = 60.0
SLICE_BYTES = 8_000_000

# The end of a text; no word is empty.
END = b""
LOG10 = float(np.log(10.0))


def words_of(text: bytes | None) -> list[bytes]:
    """Runs of other than ASCII blanks, A-Z in lower case, and the end."""
    return [*(text or b"").lower().split(), END]


def words_in(texts: pa.Array) -> pa.ListArray:
    """The same words of every text of an array, all at once."""
    bare = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
    # A blank at the end gives the empty word there, which an empty text gives by itself.
    ended = pc.if_else(pc.equal(bare, ""), "", pc.binary_join_element_wise(bare, " ", ""))
    words = pc.ascii_split_whitespace(ended)
    return words.cast(pa.list_(pa.binary()))


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept out of training; one without an id is."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(True))


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over all texts of a one-column table, counted in the tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, 0):
            found = words_in(batch.column(0)).flatten().value_counts()
            arrays = [found.field("values"), found.field("counts")]
            yield pa.RecordBatch.from_arrays(arrays, ["word", "n"])

    return texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, most: int = HEAD) -> tuple[list[tuple[bytes, int]], Column]:
    """The most frequent words that are short enough, most frequent first, and the condition that
    a row of ``counts`` is one of them.

    A histogram of counts in steps of a sixteenth of an octave gives the least count with which no
    more than ``most`` words are left, so the driver never ranks the words of all tasks.
    """
    short = F.octet_length("word") <= HEAD_WORD_BYTES
    step = F.floor(F.log2("n") * STEPS_PER_OCTAVE)
    bins = counts.where(short).groupBy(step.alias("step")).agg(F.count("n"), F.min("n")).collect()
    least, room = None, most
    for _, words, smallest in sorted(bins, reverse=True):
        if words > room:
            break
        least, room = smallest, room - words
    held = short & (F.col("n") >= least) if least is not None else F.lit(False)
    found = [(bytes(r["word"]), r["n"]) for r in counts.where(held).collect()]
    return sorted(found, key=lambda x: (-x[1], x[0])), held


class Symbols:
    """Numbers of some words, all other words being one."""

    def __init__(self, words: list[bytes], numbers: np.ndarray, other: int):
        self.words = pa.array(words, pa.binary())
        self.numbers = np.append(numbers, other).astype(np.int64)

    def of(self, words: pa.Array) -> np.ndarray:
        """The numbers of an array of words."""
        return self.numbers[pc.fill_null(pc.index_in(words, self.words), -1).to_numpy()]

    def documents(self, texts: pa.Array) -> list[np.ndarray]:
        words = words_in(texts)
        numbers = self.of(words.flatten())
        return np.split(numbers, np.cumsum(words.value_lengths().to_numpy())[:-1])


class Lexicon:
    """Numbers of the frequent words, their counts, and the symbols of the network.

    Symbols are the ``VOCABULARY`` most frequent words, the end and the rare word, by frequency.
    """

    def __init__(self, head: list[tuple[bytes, int]], total: int, distinct: int, vocabulary: int):
        self.total, self.distinct = total, distinct
        ends = [x for x in head if x[0] == END] or [(END, 0)]
        named = [x for x in head if x[0] != END][:vocabulary] + ends
        rest = total - sum(n for _, n in named)
        symbols = sorted([*named, (None, rest)], key=lambda x: (-x[1], x[0] is None, x[0] or b""))
        self.frequencies = np.array([n for _, n in symbols], dtype=np.int64)
        place = {word: i for i, (word, _) in enumerate(symbols)}
        self.rare, self.end = place.pop(None), place[END]
        self.named = Symbols(list(place), np.array(list(place.values())), self.rare)
        # What rare words share: their counts, and one for each of them and for one not seen.
        known = sum(n > 0 for _, n in named)
        self.rare_total = rest + (distinct - known) + 1
        words = head if ends[0][1] else [*head, *ends]
        self.number = Symbols([word for word, _ in words], np.arange(len(words)), -1)
        # The last place is that of a word which is not frequent.
        self.logs = np.append(np.log10(np.array([n for _, n in words], dtype=np.float64) + 1), 0.0)
        self.known = np.array([n > 0 for _, n in words] + [False])
        self.symbol = np.array([place.get(word, self.rare) for word, _ in words] + [self.rare])

    def symbols(self, text: bytes | None) -> np.ndarray:
        """The words of a text as symbols."""
        return self.named.documents(pa.array([text], pa.binary()))[0]


class Stream:
    """Documents side by side in lanes, one after another within a lane.

    Tokens lie by step and lane. Longer lanes come first, so the lanes that have not ended are the
    first ones at every step, and nothing is padded.
    """

    def __init__(self, docs: list[np.ndarray], lanes: int, end: int):
        load = [(0, lane) for lane in range(min(lanes, len(docs)))]
        held: list[list[int]] = [[] for _ in load]
        for doc in sorted(range(len(docs)), key=lambda i: -len(docs[i])):
            size, lane = load[0]
            held[lane].append(doc)
            heapq.heapreplace(load, (size + len(docs[doc]), lane))
        lengths = sorted(((size, lane) for size, lane in load), reverse=True)
        sizes = np.array([size for size, _ in lengths])
        steps = np.arange(sizes[0])
        self.active = len(sizes) - np.searchsorted(sizes[::-1], steps, side="right")
        self.offsets = np.concatenate([[0], np.cumsum(self.active)])
        total = int(self.offsets[-1])
        self.target = np.empty(total, dtype=np.int64)
        self.input = np.empty(total, dtype=np.int64)
        self.doc = np.empty(total, dtype=np.int64)
        self.carry = np.ones((total, 1), dtype=np.float32)
        self.begins = np.zeros(len(steps), dtype=bool)
        for place, (size, lane) in enumerate(lengths):
            at = self.offsets[:size] + place
            tokens = np.concatenate([docs[d] for d in held[lane]])
            ends = np.cumsum([len(docs[d]) for d in held[lane]])
            self.target[at] = tokens
            self.input[at] = np.append(end, tokens[:-1])
            self.doc[at] = np.repeat(held[lane], [len(docs[d]) for d in held[lane]])
            begins = np.append(0, ends[:-1])
            self.carry[at[begins]] = 0.0
            self.begins[begins] = True

    def last(self, window: tuple[int, int]) -> int:
        """Where the last step of a window begins among the tokens of the window."""
        return int(self.offsets[window[1] - 1] - self.offsets[window[0]])

    def windows(self) -> Iterator[tuple[int, int]]:
        """Steps from and to; of more steps where few lanes are left."""
        start = 0
        while start < len(self.active):
            steps = WINDOW * max(1, FEW_LANES // int(self.active[start]))
            yield start, min(start + steps, len(self.active))
            start += steps


class Network:
    """A gated recurrent unit with a class-factored softmax, its weights as one flat array."""

    def __init__(self, frequencies: np.ndarray, seed: int = 1):
        pick = np.random.default_rng(seed)
        size = len(frequencies)
        classes = -(-size // CLASS_SIZE)
        # Before any training it predicts by frequency.
        share_of = np.zeros(classes * CLASS_SIZE)
        share_of[:size] = frequencies + 1.0
        share_of = share_of.reshape(classes, CLASS_SIZE)
        of_class = share_of.sum(axis=1, keepdims=True)
        with np.errstate(divide="ignore"):
            inside = np.maximum(np.log(share_of / of_class), -1e4)
        normal = lambda *shape: pick.normal(0, 0.1, shape)
        first = {
            "embedding": normal(size, EMBEDDED),
            "entry": normal(EMBEDDED, 3 * HIDDEN),
            "entry_bias": np.zeros(3 * HIDDEN),
            "state": normal(HIDDEN, 3 * HIDDEN),
            "classes": np.zeros((HIDDEN, classes)),
            "classes_bias": np.log(of_class[:, 0] / of_class.sum()),
            "words": np.zeros((classes, HIDDEN, CLASS_SIZE)),
            "words_bias": inside,
        }
        self.shapes = {name: value.shape for name, value in first.items()}
        flat = np.concatenate([v.reshape(-1) for v in first.values()]).astype(np.float32)
        self.flat, self.squares = flat, np.full_like(flat, FIRST_SQUARES)

    def parts(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for name, shape in self.shapes.items():
            size = int(np.prod(shape))
            out[name] = flat[at : at + size].reshape(shape)
            at += size
        return out

    def advance(
        self, w: dict, stream: Stream, window: tuple[int, int], state: np.ndarray, way: bool = True
    ):
        """The states after each step of a window, and what backpropagation needs of the way if asked.

        Tokens lie along the last axis here and below, so that every gate is one block of memory.
        """
        start, stop = window
        first, h = stream.offsets[start], HIDDEN
        symbols = np.ascontiguousarray((w["embedding"] @ w["entry"] + w["entry_bias"]).T)
        turned = np.ascontiguousarray(w["state"].T)
        # A gate is half of one more than the hyperbolic tangent of half its sum.
        symbols[: 2 * h] *= 0.5
        turned[: 2 * h] *= 0.5
        after, before, pushes, gates, fresh = ([] for _ in range(5))
        state = state.T
        for t in range(start, stop):
            now = slice(stream.offsets[t], stream.offsets[t + 1])
            old = state if state.shape[1] == stream.active[t] else state[:, : stream.active[t]]
            if stream.begins[t]:
                old = old * stream.carry[now, 0]
            entry, pushed = symbols.take(stream.input[now], axis=1), turned @ old
            gate, new = entry[: 2 * h], entry[2 * h :]
            gate += pushed[: 2 * h]
            np.tanh(gate, out=gate)
            gate += 1.0
            gate *= 0.5
            new += gate[:h] * pushed[2 * h :]
            np.tanh(new, out=new)
            state = old - new
            state *= gate[h:]
            state += new
            after.append(state)
            if way:
                before.append(old)
                pushes.append(pushed[2 * h :])
                gates.append(gate)
                fresh.append(new)
        kept = (before, gates, fresh, pushes) if way else ()
        return np.concatenate(after, axis=1), [np.concatenate(x, axis=1) for x in kept]

    def output(self, w: dict, states: np.ndarray, target: np.ndarray, slopes: dict | None = None):
        """Natural log probability of each target, and the slopes by state where they are asked."""
        kind, place = target // CLASS_SIZE, target % CLASS_SIZE
        tokens = np.arange(len(target))
        # No state is beyond one, so weights and bias bound the scores.
        below = np.abs(w["classes"]).sum(axis=0) + np.abs(w["classes_bias"]) < MOST_SCORE
        inner = np.abs(w["words"]).sum(axis=1) + np.abs(w["words_bias"]) < MOST_SCORE
        below, inner = below.all(), inner.all(axis=1)
        logs, powers, sums = self._softmax(
            w["classes"], w["classes_bias"], states, kind, tokens, below
        )
        if slopes is not None:
            powers /= sums
            powers[kind, tokens] -= 1.0
            slopes["classes"] += states @ powers.T
            slopes["classes_bias"] += powers.sum(axis=1)
            back = w["classes"] @ powers
        order = np.argsort(kind.astype(np.uint16), kind="stable")
        found, starts = np.unique(kind[order], return_index=True)
        held, place = states.take(order, axis=1), place[order]
        inside, ways = np.empty_like(logs), np.empty_like(held)
        for k, a, b in zip(found, starts, np.append(starts[1:], len(order)), strict=True):
            mine, wanted = tokens[: b - a], place[a:b]
            own = held[:, a:b]
            inside[a:b], powers, sums = self._softmax(
                w["words"][k], w["words_bias"][k], own, wanted, mine, inner[k]
            )
            if slopes is not None:
                powers /= sums
                powers[wanted, mine] -= 1.0
                slopes["words"][k] += own @ powers.T
                slopes["words_bias"][k] += powers.sum(axis=1)
                ways[:, a:b] = w["words"][k] @ powers
        logs[order] += inside
        if slopes is not None:
            rank = np.empty_like(order)
            rank[order] = tokens
            back += ways.take(rank, axis=1)
        return (logs, back) if slopes is not None else (logs, None)

    @staticmethod
    def _softmax(weights, bias, states, wanted, tokens, below) -> tuple[np.ndarray, ...]:
        """Log probability of the wanted ones, the powers of all scores, and their sums; ``below``
        says that no score can be beyond what it is held within."""
        scores = weights.T @ states
        scores += bias[:, None]
        if not below:
            np.minimum(scores, MOST_SCORE, out=scores)
            np.maximum(scores, -MOST_SCORE, out=scores)
        logs = scores[wanted, tokens]
        powers = np.exp(scores, out=scores)
        sums = powers.sum(axis=0)
        return logs - np.log(sums), powers, sums

    def log_probabilities(self, docs: list[np.ndarray], end: int) -> np.ndarray:
        """log10 of the probability of each document of symbols."""
        stream, w = Stream(docs, LANES, end), self.parts(self.flat)
        total = np.zeros(len(docs))
        state = np.zeros((len(docs), HIDDEN), np.float32)
        for window in stream.windows():
            at = slice(stream.offsets[window[0]], stream.offsets[window[1]])
            states, _ = self.advance(w, stream, window, state, way=False)
            logs, _ = self.output(w, states, stream.target[at])
            total += np.bincount(stream.doc[at], logs, len(docs))
            state = states[:, stream.last(window) :].T
        return total / LOG10

    def slopes(self, stream: Stream, window: tuple[int, int], state: np.ndarray):
        """Sum of log probabilities over a window, its last states, and the slopes of its loss."""
        start, stop = window
        first = stream.offsets[start]
        at = slice(first, stream.offsets[stop])
        w, slope_of = self.parts(self.flat), np.zeros_like(self.flat)
        slopes = self.parts(slope_of)
        states, (before, gates, fresh, inner) = self.advance(w, stream, window, state)
        logs, back = self.output(w, states, stream.target[at], slopes)
        h, carry = HIDDEN, stream.carry[at, 0]
        reset, keep = gates[:h], gates[h:]
        through = (1 - keep) * (1 - fresh * fresh)
        # The slope of a state times these is that of what the state before pushed into each gate.
        ways = np.empty((3, h, len(carry)), np.float32)
        np.multiply(through * inner, reset * (1 - reset), out=ways[0])
        np.multiply(before - fresh, keep * (1 - keep), out=ways[1])
        np.multiply(through, reset, out=ways[2])
        pushes = []
        later = np.zeros((h, 0), np.float32)
        for t in range(stop - 1, start - 1, -1):
            now = slice(stream.offsets[t] - first, stream.offsets[t + 1] - first)
            d = back[:, now]
            d[:, : later.shape[1]] += later
            split = (ways[:, :, now] * d).reshape(3 * h, -1)
            pushes.append(split)
            later = w["state"] @ split
            later += d * keep[:, now]
            if stream.begins[t]:
                later *= carry[now]
        pushed = np.concatenate(pushes[::-1], axis=1)
        into = pushed.copy()
        into[2 * h :] = back * through
        slopes["state"] += before @ pushed.T
        slopes["entry_bias"] += into.sum(axis=1)
        slopes["entry"] += (into @ w["embedding"][stream.input[at]]).T
        order = np.argsort(stream.input[at], kind="stable")
        found, starts = np.unique(stream.input[at][order], return_index=True)
        slopes["embedding"][found] += np.add.reduceat((into.T @ w["entry"].T)[order], starts)
        return float(logs.sum()), states[:, stream.last(window) :].T, slope_of

    def learn(self, docs: list[np.ndarray], end: int) -> None:
        """One pass over documents of symbols, a step after every window."""
        stream = Stream(docs, TRAINING_LANES, end)
        state = np.zeros((len(docs), HIDDEN), np.float32)
        for window in stream.windows():
            _, state, slope = self.slopes(stream, window, state)
            slope /= stream.offsets[window[1]] - stream.offsets[window[0]]
            self.squares += slope * slope
            self.flat -= RATE * slope / np.sqrt(self.squares)


def _slices(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The rows in slices of about ``SLICE_BYTES`` of text, small batches put together: the more
    documents lie side by side, the fewer steps they take."""
    held, size = [], 0

    def together() -> list[pa.RecordBatch]:
        return pa.Table.from_batches(held).combine_chunks().to_batches() if held else []

    for batch in pieces(batches, column, SLICE_BYTES):
        held.append(batch)
        size += batch.column(column).nbytes
        if size >= SLICE_BYTES:
            yield from together()
            held, size = [], 0
    yield from together()


class LanguageModel:
    """What is learned: the lexicon, the network, and the counts of all other words as a table."""

    def __init__(self, lexicon: Lexicon, network: Network, others: DataFrame):
        self.lexicon, self.network, self.others = lexicon, network, others


def _one_round(texts: DataFrame, lexicon: Lexicon, network: Network) -> None:
    """Let every task learn from its documents, and take the mean of the weights they reach.

    Each task counts by its tokens; one whose weights are not finite does not count. The driver gets
    one row per weight.
    """
    start_of_task = share(texts.sparkSession, (lexicon.named, lexicon.end, network))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        named, end, own = shared(start_of_task)
        tokens = 0
        for batch in _slices(batches, 0):
            if batch.num_rows:
                docs = named.documents(batch.column(0))
                own.learn(docs, end)
                tokens += sum(map(len, docs))
        if tokens and np.isfinite(own.flat).all() and np.isfinite(own.squares).all():
            arrays = [pa.array([x], pa.list_(pa.float32())) for x in (own.flat, own.squares)]
            arrays.append(pa.array([tokens], pa.int64()))
            yield pa.RecordBatch.from_arrays(arrays, ["flat", "squares", "tokens"])

    reached = texts.mapInArrow(run, "flat array<float>, squares array<float>, tokens long")
    each = reached.select("tokens", F.posexplode(F.arrays_zip("flat", "squares")))
    mean = lambda name: F.sum(F.col("tokens") * F.col(f"col.{name}")) / F.sum("tokens")
    found = each.groupBy("pos").agg(mean("flat"), mean("squares")).toPandas()
    if len(found) == len(network.flat):
        at = found["pos"].to_numpy()
        network.flat[at], network.squares[at] = found.iloc[:, 1], found.iloc[:, 2]


def fit(texts: DataFrame, rounds: int = ROUNDS) -> LanguageModel:
    """The model of a table of one text column; every row is counted and learned from once.

    NULL is an empty text, which still has an end. The rounds deal the texts out by a digest; copies
    are learned from together. A table without rows gives a model that knows no word.
    """
    counts = scratch(word_counts(texts), "word-counts")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("n")).first()
    head, held = frequent(counts)
    lexicon = Lexicon(head, total, distinct, VOCABULARY)
    network = Network(lexicon.frequencies)
    dealt = F.pmod(F.xxhash64(texts.columns[0]), F.lit(rounds))
    tasks = max(1, total // (rounds * TOKENS_PER_TASK))
    for r in range(rounds if total else 0):
        _one_round(texts.where(dealt == r).coalesce(tasks), lexicon, network)
    return LanguageModel(lexicon, network, counts.where(~held))


def score(docs: DataFrame, model: LanguageModel, text_column: str = "text") -> DataFrame:
    """``docs`` without the text, with n_tokens, n_known, train_tokens, base_score and score.

    ``base_score`` is the log10 probability of the text by word counts alone, one added to each;
    ``score`` is that of the network. Columns of these names are replaced, whatever their case. Every
    row stays, NULL being an empty text. Words that are not frequent are looked up in the table of
    counts, one row for each document and word; those of no training document add nothing.
    """
    spark, lexicon = docs.sparkSession, model.lexicon
    added = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    docs = docs.drop(*[c for c in docs.columns if c.lower() in added and c != text_column])
    own = ["row", "known", "rare", "logs", "rare_logs", "network_logs", "others", "of", "times", "sum"]
    row, known, rare, logs, rare_logs, network_logs, others, of, times, found_logs = unused(docs, own)
    new = StructType.fromDDL(
        f"{row} long, n_tokens long, {known} long, {rare} long, {logs} double, {rare_logs} double,"
        f" {network_logs} double, {others} array<struct<word: binary, times: long>>"
    )
    kept = [f for f in docs.schema.fields if f.name != text_column]
    text_at = docs.columns.index(text_column)
    kinds = to_arrow_schema(new)
    state = share(spark, (lexicon, model.network))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, network = shared(state)
        number = TaskContext.get().partitionId() << 40
        for batch in _slices(batches, text_at):
            words = words_in(batch.column(text_at))
            lengths = words.value_lengths().to_numpy()
            words, size = words.flatten(), len(lengths)
            numbers = lexicon.number.of(words)
            symbols = lexicon.symbol[numbers]
            doc, is_rare = np.repeat(np.arange(size), lengths), symbols == lexicon.rare
            by_doc = lambda x: np.bincount(doc, x, size)
            found_logs = lexicon.logs[numbers]
            other = numbers < 0
            listed = words.filter(pa.array(other)).dictionary_encode()
            distinct = max(1, len(listed.dictionary))
            pairs, times = np.unique(
                doc[other] * distinct + listed.indices.to_numpy(), return_counts=True
            )
            ends = np.append(0, np.cumsum(np.bincount(pairs // distinct, minlength=size)))
            docs = np.split(symbols, np.cumsum(lengths)[:-1]) if size else []
            columns = [
                np.arange(number, number + size),
                lengths,
                by_doc(lexicon.known[numbers]),
                by_doc(is_rare),
                by_doc(found_logs),
                by_doc(np.where(is_rare, found_logs, 0.0)),
                network.log_probabilities(docs, lexicon.end) if docs else np.zeros(0),
            ]
            number += size
            kind_of = zip(columns, kinds.types[:-1], strict=True)
            arrays = [pa.array(c.astype(k.to_pandas_dtype()), k) for c, k in kind_of]
            pairs = [listed.dictionary.take(pa.array(pairs % distinct)), pa.array(times, pa.int64())]
            listed = pa.StructArray.from_arrays(pairs, ["word", "times"])
            listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), listed)
            arrays.append(listed.cast(kinds.types[-1]))
            rest = [c for i, c in enumerate(batch.columns) if i != text_at]
            names = [n for n in batch.schema.names if n != batch.schema.names[text_at]]
            yield pa.RecordBatch.from_arrays(rest + arrays, names + kinds.names)

    read = scratch(docs.mapInArrow(run, StructType(kept + new.fields)), "scored")
    asked = read.select(F.col(row).alias(of), F.explode(others).alias("other")).select(of, "other.*")
    found = asked.join(model.others.where("n > 0"), "word").groupBy(of).agg(
        F.sum("times").alias(times),
        F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias(found_logs),
    )
    more, more_logs = (F.coalesce(F.col(c), F.lit(0)) for c in (times, found_logs))
    base = float(np.log10(lexicon.total + lexicon.distinct + 1))
    spread = float(np.log10(lexicon.rare_total))
    return read.join(found, F.col(row) == F.col(of), "left").select(
        *[F.col(f"`{f.name}`") for f in kept],
        "n_tokens",
        (F.col(known) + more).alias("n_known"),
        F.lit(lexicon.total).cast("long").alias("train_tokens"),
        (F.col(logs) + more_logs - F.col("n_tokens") * base).alias("base_score"),
        (F.col(network_logs) + F.col(rare_logs) + more_logs - F.col(rare) * spread).alias("score"),
    )
