"""Language-model scores of a hashed maximum-entropy model with a class-factored softmax.

P(w | h) = P(class of w | h) P(w | its class, h). Both factors start from the unigram base distribution and are tilted
by hashed features of the words before w: the last word, the last two, and the word before the last alone (a skip
feature). A feature picks one row of ``CLASSES`` weights for the class, and with a class one row of
``MEMBERS`` weights for the word. The most frequent words have places in classes; all others, and every unknown word,
share the last class, in which they keep the base distribution. So the model has one size at every size of the corpus,
sums to one over all known words and one unknown, and reads each training text once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.llm.text import Words, mix, slices, words_of
from tessella.llm.wordids import join
from tessella.session import cut_lineage, scratch_path

CLASSES, MEMBERS = 64, 64        # the last class holds all words without a place of their own
ROWS = 1 << 15                   # hashed rows of weights for classes, and as many for words
SHARDS = 32                      # parts of the rows whose gradients are added apart
ROUNDS = 5                       # gradient steps; each has twice the texts of the one before, together all of them
STEP, DAMP = 0.6, 2.0            # length of a step, and observations that it takes to believe a gradient
FREQUENT = 1 << 20               # words whose counts are broadcast at most; the rest is joined
WORD_BYTES = 64                  # longer words are always joined, so that what is broadcast is bounded
SLICE_BYTES, COUNT_BYTES = 1 << 20, 4 << 20
TASK_BYTES = 24 << 20            # training text whose gradient one task adds up
FAN_IN = 64                      # gradients that one task adds
CHUNK, FEW = 8192, 64
START = np.array([0x51, 0x52], np.uint64)  # signs before a text's first word
END = np.uint64(0x9D39247E33776D41)              # sign of the end, which stands as the empty word in tables
BASES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)


class Lookup:
    """Positions of 64-bit signs in a list of distinct ones: an open table with linear probing, filled and read in bulk."""

    def __init__(self, signs: np.ndarray):
        size = 1 << max(4, int(2 * len(signs)).bit_length())
        self.mask = np.uint64(size - 1)
        self.place = np.full(size, -1, np.int32)
        self.signs = signs
        left, slot = np.arange(len(signs), dtype=np.int32), (signs & self.mask).astype(np.int64)
        while len(left):
            free = np.flatnonzero(self.place[slot] < 0)
            self.place[slot[free]] = left[free]  # of those that want one slot, the last has it
            lost = self.place[slot] != left
            left, slot = left[lost], (slot[lost] + 1) & int(self.mask)

    def __call__(self, signs: np.ndarray) -> np.ndarray:
        """The position of each sign, -1 for an unknown one."""
        out = np.full(len(signs), -1, np.int64)
        if not len(self.signs):
            return out
        left, slot = np.arange(len(signs)), (signs & self.mask).astype(np.int64)
        while len(left):
            at = self.place[slot]
            found = (at >= 0) & (self.signs[at] == signs[left])
            out[left[found]] = at[found]
            on = (at >= 0) & ~found
            left, slot = left[on], (slot[on] + 1) & int(self.mask)
        return out


@dataclass
class Tokens:
    """Signs of the words of several texts, each text's end after its last word."""

    words: Words
    signs: np.ndarray
    first: np.ndarray

    @staticmethod
    def of(texts: pa.Array) -> Tokens:
        words = words_of(texts, lower=True)
        counts = words.counts
        first = np.concatenate([[0], np.cumsum(counts + 1)])
        signs = np.full(first[-1], END, np.uint64)
        signs[np.arange(len(words.starts)) + words.owners()] = words.hashes()
        return Tokens(words, signs, first)

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def texts(self, at: np.ndarray) -> pa.Array:
        """The words at these places, the end as an empty one."""
        owner = np.searchsorted(self.first, at, side="right") - 1
        word = at - owner
        ends = at == self.first[owner + 1] - 1
        size = np.zeros(len(at), np.int64)
        size[~ends] = (self.words.ends - self.words.starts)[word[~ends]]
        bounds = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        return pa.StringArray.from_buffers(len(at), pa.py_buffer(bounds), pa.py_buffer(join(self.words, word[~ends], b"")))

    def histories(self) -> list[np.ndarray]:
        """Hashes of the features of what stands before each token."""
        at = np.arange(len(self.signs)) - np.repeat(self.first[:-1], np.diff(self.first))
        before = []
        for k in (1, 2):
            sign = np.full(len(self.signs), START[k - 1])
            sign[k:][at[k:] >= k] = self.signs[:-k][at[k:] >= k]
            before.append(sign * BASES[k - 1])
        one, two = before
        return [mix(x + np.uint64(k)) for k, x in enumerate((one, one + two, two))]


def add_rows(into: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """into[rows[i]] += values[i % len(values)], repeats included: the k-th ones of all rows that have so many at once."""
    order = np.argsort(rows.astype(np.uint16), kind="stable")
    rows, source = rows[order], order % len(values)
    start = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
    size = np.diff(np.append(start, len(rows)))
    by = np.argsort(-size, kind="stable")
    start, size = start[by], size[by]
    total, k = values[source[start]], 1
    while more := int(np.searchsorted(-size, -k)):  # rows with more than k
        if more < FEW:  # some rows are met again and again
            for r in range(more):
                total[r] += values[source[start[r] + k:start[r] + size[r]]].sum(0)
            break
        total[:more] += values[source[start[:more] + k]]
        k += 1
    into[rows[start]] += total


@dataclass
class Model:
    """Places of words, base probabilities and weights.

    ``signs``: words with a place in order of it (``CLASSES - 1`` classes of ``MEMBERS``); ``counts``: their counts;
    ``tokens`` and ``kinds``: of the training texts.
    """

    signs: np.ndarray
    counts: np.ndarray
    tokens: int
    kinds: int
    classes: np.ndarray = field(init=False)
    words: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.classes = np.zeros((ROWS, CLASSES), np.float32)
        self.words = np.zeros((ROWS, MEMBERS), np.float32)
        mass = np.zeros(CLASSES * MEMBERS)
        mass[:len(self.counts)] = self.counts + 1
        mass = mass.reshape(CLASSES, MEMBERS)
        of_class = mass.sum(1)
        self.total = self.tokens + self.kinds + 1.0
        self.rest = self.total - of_class.sum()  # of all other words and the unknown one
        of_class[-1] = self.rest
        with np.errstate(divide="ignore", invalid="ignore"):
            self.of_class = np.maximum(np.log(of_class / self.total), -1e30).astype(np.float32)
            self.of_word = np.nan_to_num(np.maximum(np.log(mass / of_class[:, None]), -1e30), nan=-1e30).astype(np.float32)

    def places(self, lookup: Lookup, signs: np.ndarray) -> np.ndarray:
        at = lookup(signs)
        return np.where(at < 0, (CLASSES - 1) * MEMBERS, at)

    def logs(self, places: np.ndarray, histories: list[np.ndarray], gradient: Gradient | None = None) -> np.ndarray:
        """log P(class | h) P(word | class, h) of each token, the second factor only of words with a place."""
        out = np.empty(len(places))
        for lo in range(0, len(places), CHUNK):
            place = places[lo:lo + CHUNK]
            kind, member = place // MEMBERS, place % MEMBERS
            past = [h[lo:lo + CHUNK] for h in histories]
            rows = [(h % np.uint64(ROWS)).astype(np.int64) for h in past]
            out[lo:lo + CHUNK] = self._factor(self.classes, rows, self.of_class, kind, gradient and gradient.classes)
            own = np.flatnonzero(kind < CLASSES - 1)
            salt = BASES[0] * (kind[own].astype(np.uint64) + np.uint64(7))
            rows = [(mix(h[own] ^ salt) % np.uint64(ROWS)).astype(np.int64) for h in past]
            out[lo + own] += self._factor(self.words, rows, self.of_word[kind[own]], member[own], gradient and gradient.words)
        return out

    @staticmethod
    def _factor(weights: np.ndarray, rows: list[np.ndarray], base: np.ndarray, wanted: np.ndarray,
                gradient: tuple[np.ndarray, np.ndarray] | None) -> np.ndarray:
        """log softmax(base + sum of the rows)[wanted]; adds observed less expected to the gradient."""
        if not len(wanted):
            return np.zeros(0)
        z, more = np.take(weights, rows[0], axis=0), np.empty((len(wanted), weights.shape[1]), np.float32)
        for r in rows[1:]:
            np.take(weights, r, axis=0, out=more, mode="clip")
            z += more
        z += base  # at most a few: a weight is below ROUNDS * STEP, and a base logarithm is negative
        at = np.arange(len(wanted))
        log = z[at, wanted].astype(np.float64)
        np.exp(z, out=z)
        norm = z.sum(1, keepdims=True)
        log -= np.log(norm[:, 0])
        if gradient is not None:
            z /= -norm
            z[at, wanted] += 1
            every = np.concatenate(rows)
            add_rows(gradient[0], every, z)
            gradient[1][:] += np.bincount(every, minlength=ROWS)
        return log

    def step(self, gradient: Gradient) -> None:
        """Each weight by its gradient over what a count of its size can vary: bounded, and alike at every size."""
        for weights, (slope, met), base in ((self.classes, gradient.classes, np.exp(self.of_class)),
                                            (self.words, gradient.words, np.float32(1 / MEMBERS))):
            for rows in np.split(np.arange(ROWS), SHARDS):  # a part at a time: the driver holds the model, not copies of it
                part = slope[rows]
                weights[rows] += STEP * part / (met[rows, None] * base + np.abs(part) + DAMP)


class Gradient:
    """Observed less expected, and how often each row was met, of classes and of words."""

    def __init__(self) -> None:
        self.classes, self.words = ((np.zeros((ROWS, n), np.float32), np.zeros(ROWS)) for n in (CLASSES, MEMBERS))

    def parts(self) -> Iterator[tuple[int, bytes]]:
        """(shard, bytes) of the rows that were met, the numbers rounded to the upper halves of floats."""
        for t, (slope, met) in enumerate((self.classes, self.words)):
            for shard, rows in enumerate(np.split(np.arange(ROWS), SHARDS)):
                some = rows[met[rows] > 0]
                if len(some):
                    short = (slope[some].view(np.uint32) + np.uint32(0x8000)) >> np.uint32(16)
                    yield t * SHARDS + shard, b"".join((np.array([len(some)], "<u8").tobytes(), some.astype("<u4").tobytes(),
                                                        met[some].astype("<f8").tobytes(), short.astype("<u2").tobytes()))

    def add(self, part: int, data: bytes) -> None:
        slope, met = (self.classes, self.words)[part // SHARDS]
        n = int(np.frombuffer(data, "<u8", 1)[0])
        rows = np.frombuffer(data, "<u4", n, 8)
        met[rows] += np.frombuffer(data, "<f8", n, 8 + 4 * n)
        long = np.frombuffer(data, "<u2", -1, 8 + 12 * n).astype(np.uint32) << np.uint32(16)
        slope[rows] += long.view(np.float32).reshape(n, -1)


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n_all, n_train) over all texts; the end is the empty word. ``docs``: __train, __text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "__text", COUNT_BYTES):
            tokens = Tokens.of(rows.column(1))
            train = rows.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            _, at, of, n = np.unique(tokens.signs, return_index=True, return_inverse=True, return_counts=True)
            learnt = np.bincount(of, weights=np.repeat(train, np.diff(tokens.first)), minlength=len(at)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([tokens.texts(at), pa.array(n), pa.array(learnt)], ["word", "n_all", "n_train"])

    found = docs.select("__train", "__text").mapInArrow(count, "word string, n_all long, n_train long")
    return found.groupBy("word").agg(F.sum("n_all").alias("n_all"), F.sum("n_train").alias("n_train"))


def signs_of(words: pa.Array) -> np.ndarray:
    signs = np.full(len(words), END, np.uint64)
    found = words_of(words)
    signs[found.owners()] = found.hashes()
    return signs


def add_up(parts: DataFrame, tasks: int) -> Gradient:
    """The sum of all tasks' gradients (__shard, __task, __data): in steps of ``FAN_IN``, in the order of the tasks."""

    def add(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("__shard", "__task", "__data")), strict=True))
        total = Gradient()
        for shard, _, data in rows:
            total.add(shard, data)
        return pa.table({"__shard": pa.array([rows[0][0]], pa.int32()), "__task": pa.array([rows[0][1] // FAN_IN], pa.int32()),
                         "__data": pa.array([dict(total.parts())[rows[0][0]]], pa.binary())})

    while True:
        tasks = -(-tasks // FAN_IN)
        parts = parts.groupBy("__shard", F.floor(F.col("__task") / FAN_IN).alias("__group")) \
            .applyInArrow(add, "__shard int, __task int, __data binary")
        if tasks <= 1:
            break
    total = Gradient()
    for row in parts.collect():  # as large as the model at most
        total.add(row["__shard"], row["__data"])
    return total


def train(docs: DataFrame, model: Model) -> Model:
    """``ROUNDS`` gradient steps over the training texts, of which each takes part in one. ``docs``: __key, __train, __text."""
    spark = docs.sparkSession
    chance = F.pmod(F.xxhash64("__key", "__text"), F.lit((1 << ROUNDS) - 1)) + 1
    folder = scratch_path(spark, "maxent-texts")
    docs.where("__train").select("__text", F.floor(F.log2(chance)).cast("int").alias("__round")) \
        .write.partitionBy("__round").parquet(folder)
    dealt = spark.read.schema("__text string, __round int").parquet(folder)
    sizes = dict(dealt.groupBy("__round").agg(F.sum(F.octet_length("__text"))).collect())
    for k in sorted(sizes):
        shared = spark.sparkContext.broadcast(model)

        def task(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            now, total = shared.value, Gradient()
            lookup = Lookup(now.signs)
            for rows in slices(batches, "__text", SLICE_BYTES):
                tokens = Tokens.of(rows.column(0))
                now.logs(now.places(lookup, tokens.signs), tokens.histories(), total)
            for shard, data in total.parts():
                yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([TaskContext.get().partitionId()], pa.int32()),
                                                  pa.array([data], pa.binary())], ["__shard", "__task", "__data"])

        tasks = -(-(sizes[k] or 0) // TASK_BYTES) or 1
        parts = dealt.where(F.col("__round") == k).select("__text").coalesce(tasks) \
            .mapInArrow(task, "__shard int, __task int, __data binary")
        model.step(add_up(parts, tasks))
        shared.destroy()
    return model


def score_texts(docs: DataFrame, learn: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, n_known, train_tokens, base_score, score) of each row, learning from the rows of ``learn``.

    Tokens are the words between ASCII white space, A-Z lower-cased, and one end for each text. With c of a token's N
    occurrences in the training texts, which have V different tokens, ``base_score`` sums log10((c + 1) / (N + V + 1)).
    ``score`` is the model's log10 probability of the text; all unknown words share one place in it, as in the base.

    Words are counted by Spark. Counts of the ``FREQUENT`` most frequent words are broadcast; a text's other words go
    through a join on the word. A step's gradients are added in a tree. A null text is an empty one and has its end
    as its only token. A null ``learn`` counts as false. Without any training text all scores follow from counts of 0. Equal rows
    and repeated or null keys each have their row. Other columns are not read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("__key"), F.coalesce(learn, F.lit(False)).alias("__train"),
                       F.coalesce(F.col(text), F.lit("")).alias("__text"))
    counts = cut_lineage(count_words(rows))
    sums = counts.agg(F.coalesce(F.sum("n_train"), F.lit(0)), F.count(F.when(F.col("n_train") > 0, 1))).first()
    short = counts.where((F.octet_length("word") <= WORD_BYTES) & (F.col("n_all") > 0))
    placed = short.where("n_train > 0").orderBy(F.col("n_train").desc(), "word").limit((CLASSES - 1) * MEMBERS) \
        .select("word", "n_train").toArrow()
    model = train(rows, Model(signs_of(placed.column(0).combine_chunks()), placed.column(1).to_numpy(), *sums))
    size = F.floor(F.log2("n_all") * 8).cast("int")
    least, room = None, FREQUENT
    for r in short.groupBy(size.alias("size")).count().orderBy(F.col("size").desc()).collect():  # 8 for each doubling
        room -= r["count"]
        if room < 0:
            break
        least = r["size"]
    known = short.where(size >= least).select("word", "n_train").toArrow() if least is not None else placed.slice(0, 0)
    shared = spark.sparkContext.broadcast((model, signs_of(known.column(0).combine_chunks()), known.column(1).to_numpy()))
    folder = scratch_path(spark, "maxent-scores")
    rows.select("__key", "__text").mapInArrow(
        lambda batches: _score(batches, *shared.value),
        f"__row long, __key {rows.schema['__key'].dataType.simpleString()}, n_tokens long, known long, base double, model double, "
        "others array<struct<word: string, times: long>>").write.parquet(folder)
    scanned = spark.read.parquet(folder)
    more = scanned.select("__row", F.inline("others")).join(counts, "word").groupBy("__row").agg(
        F.sum(F.col("times") * F.log10(F.col("n_train") + 1)).alias("more"),
        F.sum(F.when(F.col("n_train") > 0, F.col("times"))).alias("more_known"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return scanned.join(more, "__row", "left").select(
        F.col("__key").alias(key), "n_tokens", (F.col("known") + zero("more_known")).alias("n_known"),
        F.lit(int(sums[0])).cast("long").alias("train_tokens"), (F.col("base") + zero("more")).alias("base_score"),
        (F.col("model") + zero("more")).alias("score"))


def _score(batches: Iterator[pa.RecordBatch], model: Model, signs: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Scores but for the counts of words that are not broadcast, which are listed."""
    places, frequent = Lookup(model.signs), Lookup(signs)
    row = TaskContext.get().partitionId() << 40
    for rows in slices(batches, "__text", SLICE_BYTES):
        tokens = Tokens.of(rows.column(1))
        owner, n = tokens.owners(), rows.num_rows
        at, place = frequent(tokens.signs), model.places(places, tokens.signs)
        count = np.where(at >= 0, counts[at] if len(counts) else 0, 0)
        placed = place < (CLASSES - 1) * MEMBERS
        count[placed] = model.counts[place[placed]]
        logs = model.logs(place, tokens.histories()) / np.log(10)
        logs += np.where(placed, 0, np.log10(count + 1.0) - np.log10(model.rest))
        other = np.flatnonzero((at < 0) & ~placed)
        # a text's words of unknown count: each once, with its times
        by = np.lexsort((tokens.signs[other], owner[other]))
        other = other[by]
        new = np.ones(len(other), bool)
        new[1:] = (tokens.signs[other][1:] != tokens.signs[other][:-1]) | (owner[other][1:] != owner[other][:-1])
        times = np.diff(np.append(np.flatnonzero(new), len(other)))
        cut = np.searchsorted(owner[other[new]], np.arange(n + 1)).astype(np.int32)
        listed = pa.StructArray.from_arrays([tokens.texts(other[new]), pa.array(times)], ["word", "times"])
        sums = lambda x: pa.array(np.bincount(owner, weights=x, minlength=n))
        yield pa.RecordBatch.from_arrays(
            [pa.array(row + np.arange(n)), rows.column(0), pa.array(np.diff(tokens.first)),
             pa.array(np.bincount(owner[count > 0], minlength=n)), sums(np.log10(count + 1.0) - np.log10(model.total)), sums(logs),
             pa.ListArray.from_arrays(pa.array(cut), listed)],
            ["__row", "__key", "n_tokens", "known", "base", "model", "others"])
        row += n
