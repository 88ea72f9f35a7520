"""Log-bilinear language model, trained with noise-contrastive estimation in numpy.

Every word with at least ``HEAD_SHARE`` of all training tokens, and the end of a text, is an entry
with vectors of its own, as context and as target, however many such words there are. All rarer words
share the entries of buckets by length and letters beyond ASCII. The context vectors of the two
entries before a token, each times a matrix of its position, add up to a prediction. The probability
of a token is that of its entry, in a bucket times the word's share of it by counts over all training
texts (plus one for each word, and one for unseen words).

* Counts: every task counts the words of its training texts; counts are summed by word.
* Steps: entries are sorted by frequency and cut into classes of classes of about equal size, the
  cube root of their number. Products of the prediction with the vectors of classes, of classes
  within a class and of entries within such a class, plus biases, give the scores of three steps.
* Training: every task trains from the same start on all its training texts, in minibatches, with
  noise drawn from the frequencies for the first step and evenly from the same class for the others.
  The models are averaged row by row, weighted by the times that a task met the row, in a tree of
  groups of bounded size. The state of a model grows with the number of entries.
* Normalisation: each step is normalised over all its members, so all probabilities are exact.
* Scoring: words with at least ``HEAD_SHARE`` of all training tokens are looked up where the text
  lies; there are at most 1 / HEAD_SHARE of them, however large the corpus, which bounds what is
  broadcast. Rarer words are summed by text and word, and joined with their counts.

Words are compared by 64-bit hashes. NULL texts are empty and have the end as their only token; a
NULL doc_id counts as an empty text in the split; repeated rows are scored, and learnt from, each.
Without any training text all counts are zero and the entries are about equally probable. An empty table gives
no rows. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm import shared
from sparkmart.llm.words import Words, bytes_of, chunks

OWN = 448  # most frequent words, numbered before the buckets; the other entries come after START
LENGTHS = (4, 6, 8, 10, 13, 17)
BUCKETS = 9 * (len(LENGTHS) + 1)
CLASSES = 1 + OWN + BUCKETS
END, START = 0, CLASSES  # START stands before a text
DIM = 16
NOISE = 24
WITHIN = 2  # noise of a token in each of the steps within a class
ROWS = 8192  # of a model's state, sent together
LEAST = 3_000_000  # tokens for a model of its own
BATCH = 2048
RATE = 0.08
HEAD_SHARE = 5e-7
FLUSH = 1_000_000
FOLD, HELD_OUT = 7, 2
SHIFT = np.uint64(44)  # words are looked up by the upper 20 bits first


def held_out():
    """True for texts that are scored only."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLD == HELD_OUT


def buckets(words: Words) -> np.ndarray:
    """Bucket of each word: length and the first continuation byte, if any."""
    size = np.searchsorted(LENGTHS, words.ends - words.starts, side="left")
    beyond = np.flatnonzero((words.data & 0xC0) == 0x80)
    at = np.searchsorted(beyond, words.starts)
    place = np.append(beyond, len(words.data))[at]
    has = place < words.ends
    letter = np.where(has, 1 + (words.data[np.minimum(place, max(0, len(words.data) - 1))] & 7), 0) if len(words.data) else at
    return size * 9 + letter


def word_counts(texts: DataFrame) -> DataFrame:
    """Training words as (word, bucket, n): sums of each task, not yet summed over tasks."""
    import pyarrow as pa

    def emit(parts):
        word, bucket, n = (np.concatenate(x) for x in zip(*parts))
        _, first, inverse = np.unique(word, return_index=True, return_inverse=True)
        total = np.bincount(inverse, weights=n).astype(np.int64)
        return word[first], bucket[first], total

    def batch_of(part):
        word, bucket, n = part
        columns = [pa.array(word.view(np.int64)), pa.array(bucket.astype(np.int32)), pa.array(n)]
        return pa.RecordBatch.from_arrays(columns, ["word", "bucket", "n"])

    def task(batches) -> Iterator:
        parts, size = [], 0
        for batch in batches:
            data, offsets = bytes_of(batch.column("text"))
            for i, j in chunks(offsets):
                words = Words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                word, first, n = np.unique(words.hashes(), return_index=True, return_counts=True)
                parts.append((word, buckets(words)[first], n.astype(np.int64)))
                size += len(word)
                if size > FLUSH:
                    parts = [emit(parts)]
                    size = len(parts[0][0])
                    if size > FLUSH // 2:
                        yield batch_of(parts[0])
                        parts, size = [], 0
        if parts:
            yield batch_of(emit(parts))

    return texts.mapInArrow(task, "word long, bucket int, n long")


class Vocabulary:
    """Head words (sorted hashes) with their counts and entries; totals of words and entries.

    ``class_n`` and ``class_v`` are tokens and words of the first CLASSES entries, those of buckets
    without head words; ``more_n`` are tokens of the entries after START.
    """

    def __init__(self, word, bucket, n, by_bucket: dict[int, tuple[int, int]], texts: int):
        order = np.argsort(word, kind="stable")
        self.word, self.n = word[order], n[order].astype(np.int64)
        begin = np.searchsorted(self.word >> SHIFT, np.arange((1 << 20) + 1, dtype=np.uint64))
        self.first, self.most = begin[:-1].astype(np.int32), int(np.diff(begin).max())
        rank = np.lexsort((self.word, -self.n))
        top, more = rank[:OWN], rank[OWN:]
        self.cls = np.zeros(len(rank), np.int32)
        self.cls[top] = 1 + np.arange(len(top))
        self.cls[more] = START + 1 + np.arange(len(more))
        self.more_n = self.n[more]
        self.texts = texts
        self.tokens = sum(c for c, _ in by_bucket.values()) + texts
        self.distinct = sum(v for _, v in by_bucket.values()) + (texts > 0)
        self.class_n = np.zeros(CLASSES, np.int64)
        self.class_v = np.zeros(CLASSES, np.int64)
        self.class_n[END], self.class_v[END] = texts, 1
        for b, (c, v) in by_bucket.items():
            self.class_n[1 + OWN + b], self.class_v[1 + OWN + b] = c, v
        np.subtract.at(self.class_n, 1 + OWN + bucket[order], self.n)
        np.subtract.at(self.class_v, 1 + OWN + bucket[order], 1)
        self.class_n[1 : 1 + len(top)], self.class_v[1 : 1 + len(top)] = self.n[top], 1

    def find(self, hashes: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether each word is a head word, its count (0 if not) and its entry."""
        if not len(self.word):
            return np.zeros(len(hashes), bool), np.zeros(len(hashes), np.int64), (1 + OWN + bucket).astype(np.int32)
        at = self.first.take((hashes >> SHIFT).astype(np.int64))
        for _ in range(self.most):
            at += self.word.take(at, mode="clip") < hashes
        np.minimum(at, len(self.word) - 1, out=at)
        hit = self.word.take(at) == hashes
        return hit, np.where(hit, self.n[at], 0), np.where(hit, self.cls[at], 1 + OWN + bucket).astype(np.int32)


def with_ends(words: Words, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Entries of all tokens with the ends put in, of the two before each, and each text's first."""
    n = len(words.at) - 1
    first = words.at + np.arange(n + 1)
    out = np.zeros(first[-1], np.int32)
    out[np.arange(len(cls)) + words.text_of()] = cls
    one = np.concatenate([[START], out[:-1]]).astype(np.int32)
    two = np.concatenate([[START, START], out[:-2]])[: len(out)].astype(np.int32)
    one[first[:-1]] = START
    two[first[:-1]] = START
    second = first[:-1] + 1
    two[second[second < first[1:]]] = START
    return out, one, two, first


class Model:
    """Vectors of context entries, classes and target entries with biases, and position matrices.

    All are rows of one table, each with its bias (or 0) last: contexts by entry, the three steps'
    members (entries in the order of ``place``), and the rows of the two matrices.
    """

    def __init__(self, class_n: np.ndarray, more_n: np.ndarray | tuple = (), seed: int = 11):
        draw = np.random.default_rng(seed)
        n = np.concatenate([class_n, np.asarray(more_n, np.int64)]) + 1.0
        order = np.argsort(-n, kind="stable")
        leaves = len(n)
        self.place = np.zeros(leaves + 1, np.int32)  # START is no target
        self.place[np.where(order < START, order, order + 1)] = np.arange(leaves)
        width = 2
        while width**3 < leaves:
            width += 1
        self.width = width
        self.over = (width * width, width, 1)  # entries below a member of each step
        self.sizes = [-(-leaves // x) for x in self.over]
        self.at = np.cumsum([leaves + 1, *self.sizes])
        self.table = draw.normal(0, 0.1, (self.at[-1] + 2 * DIM, DIM + 1)).astype(np.float32)
        self.table[:, DIM] = 0
        self.noise = np.add.reduceat(n[order], np.arange(self.sizes[0]) * self.over[0]) / n.sum()
        whole = np.ones(1)
        for at, size, x in zip(self.at, self.sizes, self.over):
            share = np.add.reduceat(n[order], np.arange(size) * x) / n.sum()
            self.table[at : at + size, DIM] = np.log(share / whole[np.arange(size) // width % len(whole)])
            whole = share
        for k in (0, 1):
            matrix = self.table[self.at[-1] + k * DIM :][:DIM, :DIM]
            matrix[:] = np.eye(DIM) * 0.5 + 0.02 * matrix
        self.weight = np.zeros(len(self.table))

    def matrices(self) -> tuple[np.ndarray, np.ndarray]:
        at = self.at[-1]
        return self.table[at : at + DIM, :DIM], self.table[at + DIM :, :DIM]

    def parts(self) -> Iterator[bytes]:
        """The table, ``ROWS`` rows at a time: each row times its weight, and the weight."""
        for at in range(0, len(self.table), ROWS):
            weight = self.weight[at : at + ROWS, None]
            yield np.hstack([self.table[at : at + ROWS] * weight, weight]).astype("<f4").tobytes()

    def load(self, part: int, sums: np.ndarray) -> None:
        """Rows of a part from sums over models; rows that none has met stay."""
        sums = sums.reshape(-1, DIM + 2)
        met = np.flatnonzero(sums[:, -1])
        self.table[part * ROWS + met] = sums[met, :-1] / sums[met, -1:]

    def trainer(self, seed: int):
        """A function that takes one minibatch (entries, one before, two before) and learns from it."""
        table, place, width = self.table, self.place, self.width
        squares = np.full(table.shape, 1e-3, np.float32)
        draw = np.random.default_rng(seed)
        heap, lift = np.cumsum(self.noise), np.log(NOISE * self.noise).astype(np.float32)
        slot = np.zeros(len(table), np.int32)
        last = np.arange(self.at[-1], len(table))
        room = np.empty((DIM + 1, BATCH * (3 + 2 * (1 + WITHIN)) + NOISE + 2 * DIM))

        def learn(target, one, two):
            leaf, n = place[target], len(target)
            first, second = self.matrices()
            a, b = table.take(one, axis=0)[:, :DIM], table.take(two, axis=0)[:, :DIM]
            predicted = a @ first + b @ second
            # The first step shares its noise. Derivatives of log sigmoid(good) + sum log sigmoid(-bad).
            near = leaf // self.over[0]
            noise = np.minimum(np.searchsorted(heap, draw.random(NOISE)), len(heap) - 1)
            top = table[self.at[0] : self.at[1]]
            own, others = top.take(near, axis=0), top[noise]
            good = np.einsum("nd,nd->n", predicted, own[:, :DIM]) + own[:, DIM] - lift[near]
            bad = predicted @ others[:, :DIM].T + (others[:, DIM] - lift[noise])
            up = 1 / (1 + np.exp(np.clip(good, -30, 30)))
            down = -1 / (1 + np.exp(-np.clip(bad, -30, 30)))
            to = up[:, None] * own[:, :DIM] + down @ others[:, :DIM]
            # Columns are summed by row of the table; the derivatives lie by column, as bincount wants them.
            turned = np.ascontiguousarray(predicted.T)
            index = [self.at[0] + near, self.at[0] + noise]
            total = n * (3 + 2 * (1 + WITHIN)) + NOISE + 2 * DIM
            rows, end = (room[:, :total] if n <= BATCH else np.empty((DIM + 1, total))), n + NOISE
            np.multiply(turned, up, out=rows[:DIM, :n])
            rows[:DIM, n:end] = predicted.T @ down
            rows[DIM, :n], rows[DIM, n:end] = up, down.sum(axis=0)
            for at, size, x in zip(self.at[1:], self.sizes[1:], self.over[1:]):
                member = leaf // x
                low = member // width * width
                among = np.minimum(size - low, width)
                drawn = (draw.random((WITHIN, n), dtype=np.float32) * among).astype(np.int32)
                ids = np.empty((1 + WITHIN, n), np.int64)
                ids[0] = at + member
                ids[1:] = at + low + np.minimum(drawn, among - 1)
                near = table.take(ids, axis=0)
                scores = np.einsum("nd,knd->kn", predicted, near[:, :, :DIM]) + near[:, :, DIM]
                scores -= np.log(WITHIN / among.astype(np.float32))
                pull = -1 / (1 + np.exp(-np.clip(scores, -30, 30)))
                pull[0] += 1
                to += np.einsum("kn,knd->nd", pull, near[:, :, :DIM])
                index.append(ids.ravel())
                begin, end = end, end + pull.size
                np.multiply(turned[:, None, :], pull, out=rows[:DIM, begin:end].reshape(DIM, 1 + WITHIN, n))
                rows[DIM, begin:end] = pull.ravel()
            index += [one, two, last]
            rows[DIM, end:] = 0
            for more in (first @ to.T, second @ to.T, to.T @ a, to.T @ b):
                begin, end = end, end + more.shape[1]
                rows[:DIM, begin:end] = more
            index = np.concatenate(index)
            each = np.arange(len(index), dtype=np.int32)
            slot[index] = each
            met = index[slot.take(index) == each]
            slot[met] = np.arange(len(met), dtype=np.int32)
            into = slot.take(index).astype(np.int64)
            grad = np.empty((len(met), DIM + 1), np.float32)
            for d, column in enumerate(rows):
                grad[:, d] = np.bincount(into, weights=column, minlength=len(met))
            square = squares.take(met, axis=0)
            square += grad * grad
            squares[met] = square
            grad *= RATE
            grad /= np.sqrt(square, out=square)
            grad += table.take(met, axis=0)
            table[met] = grad
            self.weight[met] += np.bincount(into, minlength=len(met))

        return learn

    def scorer(self):
        """A function from entries and the two before each to natural log-probabilities."""
        first, second = self.matrices()
        contexts = self.table[: self.at[0], :DIM]
        a, b = contexts @ first, contexts @ second

        def step(predicted, at, low, size, member):
            """Log-probabilities of ``member`` among the ``size`` members from ``low`` on."""
            rows = self.table[at + low : at + low + size]
            scores = rows[:, :DIM] @ predicted
            scores += rows[:, DIM:]
            own = scores[member - low, np.arange(len(member))]
            top = scores.max(axis=0)
            scores -= top
            return own - top - np.log(np.exp(scores, out=scores).sum(axis=0))

        def score(target, one, two):
            leaf = self.place[target]
            group = leaf // self.width
            order = np.argsort(group.astype(np.uint16) if self.sizes[1] < 1 << 16 else group, kind="stable")
            leaf = leaf[order]
            predicted = a.take(one[order], axis=0)
            predicted += b.take(two[order], axis=0)
            predicted = np.ascontiguousarray(predicted.T)
            out = np.zeros(len(leaf))
            for k, (at, size, x) in enumerate(zip(self.at, self.sizes, self.over)):
                member = leaf // x
                parent = member // self.width if k else np.zeros_like(member)
                cuts = np.append(np.flatnonzero(np.diff(parent, prepend=-1)), len(leaf))
                lows = (parent[cuts[:-1]] * self.width).tolist()
                for low, i, end in zip(lows, cuts[:-1].tolist(), cuts[1:].tolist()):
                    among = min(self.width, size - low) if k else size
                    for j in range(i, end, BATCH):
                        s = slice(j, min(end, j + BATCH))
                        out[s] += step(predicted[:, s], at, low, among, member[s])
            back = np.empty_like(out)
            back[order] = out
            return back

        return score


def _train(texts: DataFrame, vocabulary, start: Model, folder: str, tokens: int) -> Model:
    """Average of the models that the tasks train on all rows of ``texts``."""
    import pandas as pd

    def task(batches) -> Iterator:
        import pyarrow as pa

        model = Model(vocabulary.value.class_n, vocabulary.value.more_n)
        learn, seen = model.trainer(5), 0
        held: list[list[np.ndarray]] = []
        for batch in batches:
            data, offsets = bytes_of(batch.column("text"))
            for i, j in chunks(offsets):
                words = Words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                _, _, cls = vocabulary.value.find(words.hashes(), buckets(words))
                held.append(list(with_ends(words, cls)[:3]))
                whole = [np.concatenate(x) for x in zip(*held)]
                n = len(whole[0])
                for at in range(0, n - BATCH + 1, BATCH):
                    learn(*(x[at : at + BATCH] for x in whole))
                held = [[x[n - n % BATCH :] for x in whole]]
                seen += n - n % BATCH
        if held and len(held[0][0]):
            learn(*held[0])
            seen += len(held[0][0])
        if seen:
            for k, sums in enumerate(model.parts()):
                yield pa.RecordBatch.from_pydict({"part": pa.array([k], pa.int32()), "sums": [sums]})

    def add(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(s, "<f4").astype(float) for s in pdf["sums"].sort_values())
        return pd.DataFrame({"part": [key[0]], "sums": [total.astype("<f4").tobytes()]})

    add.__annotations__ = {}
    # Small partitions train together, as each model has all entries.
    many = -(-max(1, tokens) // LEAST)
    models = shared.staged(texts.coalesce(many).mapInArrow(task, "part int, sums binary"), folder, "models-0")
    n, step = models.where("part = 0").count(), 0  # one for each task; about 32 models meet in a group
    while n > 1:
        step += 1
        group = F.pmod(F.xxhash64("sums"), F.lit(-(-n // 32) if n > 64 else 1)).alias("group")
        merged = models.select("*", group).groupBy("part", "group").applyInPandas(add, "part int, sums binary")
        models = shared.staged(merged, folder, f"models-{step}")
        n = models.groupBy("part").count().agg(F.max("count")).first()[0]
    for row in models.collect():
        start.load(row.part, np.frombuffer(row.sums, "<f4"))
    return start


def fit(docs: DataFrame, folder: str) -> tuple[Vocabulary, DataFrame, Model]:
    """Vocabulary, counts of all training words (word, n), and the trained model."""
    spark = docs.sparkSession
    train = docs.where(~held_out()).select(F.col("text").cast("string").alias("text"))
    counts = word_counts(train).groupBy("word", "bucket").agg(F.sum("n").alias("n"))
    counts = shared.staged(counts, folder, "counts")
    shared.release(spark)
    totals = counts.groupBy("bucket").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    by_bucket = {r.bucket: (r.n, r.v) for r in totals}
    texts = train.count()
    tokens = texts + sum(c for c, _ in by_bucket.values())
    # No more than 1 / HEAD_SHARE words can have that share.
    head = counts.where(F.col("n") >= max(1.0, HEAD_SHARE * tokens)).toArrow()
    column = lambda c: head.column(c).to_numpy()
    vocabulary = Vocabulary(column("word").view(np.uint64), column("bucket"), column("n"), by_bucket, texts)
    sent = spark.sparkContext.broadcast(vocabulary)
    model = _train(train, sent, Model(vocabulary.class_n, vocabulary.more_n), folder, tokens)
    return vocabulary, counts.select("word", "n"), model


def score(docs: DataFrame, vocabulary: Vocabulary, counts: DataFrame, model: Model, folder: str) -> DataFrame:
    """Base score and model score of every row of ``docs`` (doc_id, text)."""
    import pyarrow as pa

    sent = docs.sparkSession.sparkContext.broadcast((vocabulary, model))
    tail = pa.list_(pa.struct([("word", pa.int64()), ("times", pa.int64())]))

    def task(batches) -> Iterator:
        vocabulary, model = sent.value
        log_p = model.scorer()
        below = np.log10(vocabulary.class_n + vocabulary.class_v + 1.0)
        end_log = np.log10(vocabulary.texts + 1.0)
        base_below = np.log10(vocabulary.tokens + vocabulary.distinct + 1.0)
        for batch in batches:
            data, offsets = bytes_of(batch.column("text"))
            ids, outs = batch.column("doc_id"), batch.column("held_out")
            rows = batch.column("row")
            for i, j in chunks(offsets):
                words = Words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                hashes = words.hashes()
                hit, n, cls = vocabulary.find(hashes, buckets(words))
                target, one, two, first = with_ends(words, cls)
                class_log = np.add.reduceat(log_p(target, one, two), first[:-1]) / np.log(10)
                text = words.text_of()
                size = j - i
                logs = np.where(hit, np.log10(n + 1.0), 0.0)
                sums = lambda x: np.bincount(text, weights=x, minlength=size)  # noqa: E731, B023
                tokens = np.diff(first)
                base = sums(logs) + end_log - tokens * base_below
                inside = np.zeros(len(cls))  # an entry of one word: its share is 1
                inside[~hit] = -below[cls[~hit]]
                model_score = class_log + sums(inside)
                known = sums(hit).astype(np.int64) + (vocabulary.texts > 0)
                # Rarer words: number of times in each text.
                rare = np.flatnonzero(~hit)
                order = rare[np.lexsort((hashes[rare], text[rare]))]
                new = np.ones(len(order), bool)
                new[1:] = (hashes[order[1:]] != hashes[order[:-1]]) | (text[order[1:]] != text[order[:-1]])
                begin = np.flatnonzero(new)
                times = np.diff(np.append(begin, len(order)))
                bounds = np.searchsorted(text[order[begin]], np.arange(size + 1))
                pairs = pa.StructArray.from_arrays(
                    [pa.array(hashes[order[begin]].view(np.int64)), pa.array(times.astype(np.int64))], ["word", "times"]
                )
                columns = [
                    rows.slice(i, size), ids.slice(i, size), outs.slice(i, size), pa.array(tokens.astype(np.int64)),
                    pa.array(known), pa.array(base), pa.array(model_score),
                    pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pairs).cast(tail),
                ]
                yield pa.RecordBatch.from_arrays(
                    columns, ["row", "doc_id", "held_out", "n_tokens", "known", "base", "model", "tail"]
                )

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out().alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    declared = (
        "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, model double, "
        "tail array<struct<word:bigint,times:bigint>>"
    )
    made = shared.staged(rows.mapInArrow(task, declared), folder, "scored")
    each = made.select("row", F.explode("tail").alias("x")).select("row", "x.word", "x.times")
    joined = each.join(counts, "word")  # words without a count add log(1) = 0
    rest = joined.groupBy("row").agg(
        F.sum("times").alias("times"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("logs")
    )
    nil = lambda c, z: F.coalesce(F.col(c), F.lit(z))
    return made.drop("tail").join(rest, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + nil("times", 0)).alias("n_known"),
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + nil("logs", 0.0)).alias("base_score"),
        (F.col("model") + nil("logs", 0.0)).alias("score"),
    )


def op9_log_bilinear(spark, sf_dir: str) -> DataFrame:
    """Log-probability of every document, with a unigram base score."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = shared.workspace(spark, "bilinear")
    return score(docs, *fit(docs, folder), folder)
