"""Language-model scoring by a log-bilinear neural model, trained in numpy with noise-contrastive estimation.

Every word of the corpus is counted. Frequent words are outputs of their own; the others share an output with words of the
same count, within which a word has its share of the counts. In training, an occurrence of a word counted c times stands
for one counted c - 1 times (leave one out), so the output of count 0, all words that training does not know, gets the mass that
unknown words have. A token's log probability is context vector . output vector + bias, normalised over all outputs: the
context is the token before, so the normalisers of all contexts come from one batched matrix product.

Every text that is not held out trains the model: in each epoch every block of documents goes on from the same state, and the
blocks' states are averaged output by output, weighted by how often the output occurs in a block.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import NO_ID, block_number, cuts, from_planes, number, pack, planes, unpack
from .common import CHANGED, by_bytes, id_text, shuffle_partitions, split_words, values

#: Frequent words at most, and their count in the texts to learn from at least.
HEAD, OFTEN = 6000, 5
EXACT, CLASSES, DIM = 16, 96, 24
EPOCHS, BATCH_BYTES = 2, 12 << 20
#: Groups of outputs in which the blocks' states are averaged.
PIECES = 64


def class_of(count: np.ndarray) -> np.ndarray:
    """0 to EXACT for such counts, then two classes for each doubling."""
    big = EXACT + np.ceil(2 * np.log2(np.maximum(count, 1) / EXACT)).astype(np.int64)
    return np.minimum(np.where(count <= EXACT, count, big), CLASSES - 1)


@dataclass
class Model:
    """Outputs: 0 the end, 1..head the frequent words, then the classes."""

    context: np.ndarray
    output: np.ndarray
    bias: np.ndarray
    normal: np.ndarray
    shares: np.ndarray  # of each class: the sum of its words' counts
    head: int
    end_count: int
    tokens: int
    types: int

    def log10(self, before: np.ndarray, code: np.ndarray, count: np.ndarray) -> np.ndarray:
        out = np.empty(len(code))
        for at in range(0, len(code), 100_000):
            b, c = before[at : at + 100_000], code[at : at + 100_000]
            out[at : at + 100_000] = np.einsum("ij,ij->i", self.context[b], self.output[c]) + self.bias[c] - self.normal[b]
        kind = code - self.head - 1
        shared = kind > 0
        out[shared] += np.log(count[shared] / self.shares[kind[shared]])
        return out / np.log(10)


def start(prior: np.ndarray, seed: int = 11) -> np.ndarray:
    """The state to begin with, a row for each output: context vector, output vector, bias, and the sums of squares of their steps."""
    rng, n = np.random.default_rng(seed), len(prior)
    vectors = rng.standard_normal((n, 2 * DIM)).astype(np.float32) * 0.05
    return np.concatenate([vectors, np.log(prior).astype(np.float32)[:, None], np.full((n, 3), 0.1, np.float32)], axis=1)


def _descend(table: np.ndarray, sums: np.ndarray, where: np.ndarray, grad: np.ndarray, rate: float) -> None:
    order = np.argsort(where, kind="stable")
    at = where[order]
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    used, total = at[first], np.add.reduceat(grad[order], first, axis=0)
    sums[used] += (total**2).mean(axis=1)
    table[used] -= rate * total / np.sqrt(sums[used])[:, None]


def epoch(state: np.ndarray, before: np.ndarray, code: np.ndarray, prior: np.ndarray, rng: np.random.Generator, noise: int = 64, batch: int = 1024, rate: float = 0.05) -> None:
    """One pass over pairs of outputs, in place; prior is the noise distribution, drawn from once for all pairs of a batch."""
    context, output, bias, sums = state[:, :DIM], state[:, DIM : 2 * DIM], state[:, 2 * DIM : 2 * DIM + 1], state[:, 2 * DIM + 1 :]
    log_noise = np.log(noise * prior).astype(np.float32)
    cumulative, order = np.cumsum(prior), rng.permutation(len(code))
    for at in range(0, len(order), batch):
        rows = order[at : at + batch]
        own, target = before[rows], code[rows]
        drawn = np.minimum(np.searchsorted(cumulative, rng.random(noise) * cumulative[-1]), len(prior) - 1)
        c, o, d = context[own], output[target], output[drawn]
        delta = np.einsum("bd,bd->b", c, o) + bias[target, 0] - log_noise[target]
        g = -1 / (1 + np.exp(np.clip(delta, -30, 30)))
        delta = c @ d.T + (bias[drawn, 0] - log_noise[drawn])
        h = 1 / (1 + np.exp(-np.clip(delta, -30, 30)))
        _descend(context, sums[:, 0], own, g[:, None] * o + h @ d, rate)
        both = np.concatenate([target, drawn])
        _descend(output, sums[:, 1], both, np.concatenate([g[:, None] * c, h.T @ c]), rate)
        _descend(bias, sums[:, 2], both, np.concatenate([g, h.sum(axis=0)])[:, None], rate)


def parts_of(state: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Context vectors, output vectors, biases and normalisers."""
    context, output, bias = (np.ascontiguousarray(x) for x in (state[:, :DIM], state[:, DIM : 2 * DIM], state[:, 2 * DIM]))
    return context, output, bias, normalisers(context, output, bias)


def fit(before: np.ndarray, code: np.ndarray, prior: np.ndarray, epochs: int = EPOCHS, seed: int = 11) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Context vectors, output vectors, biases and normalisers from pairs of outputs that one process holds."""
    state, rng = start(prior, seed), np.random.default_rng(seed)
    for _ in range(epochs):
        epoch(state, before, code, prior, rng)
    return parts_of(state)


def normalisers(context: np.ndarray, output: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Logarithm of the sum over all outputs, for each context."""
    out = np.empty(len(context))
    for at in range(0, len(context), 512):
        logits = context[at : at + 512] @ output.T + bias
        top = logits.max(axis=1, keepdims=True)
        out[at : at + 512] = (top + np.log(np.exp(logits - top).sum(axis=1, keepdims=True)))[:, 0]
    return out


_BLOCKS = "block long, part int, data binary, ids binary, counts binary, home binary, learn binary"


def _blocks(docs: DataFrame, parts: int) -> DataFrame:
    """Distinct words of a block by part with their counts in the texts to learn from; with part null, the block's documents."""

    def build(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ordinal = 0
        for batch in by_bytes(it, BATCH_BYTES):
            vocabulary, index_all, offsets = split_words(batch.column(1))
            vocabulary = vocabulary.cast(pa.binary())
            for at, end in cuts(offsets, batch.num_rows):
                counts = np.diff(offsets[at : end + 1])
                used, index = np.unique(index_all[offsets[at] : offsets[end]], return_inverse=True)
                words = vocabulary.take(pa.array(used)).to_pylist()
                learn = batch.column(2).slice(at, end - at).to_numpy(zero_copy_only=False).astype(bool)
                rank, home, by_part = number(words, index, parts)
                learned = np.empty(len(words), np.int64)
                learned[rank] = np.bincount(index[np.repeat(learn, counts)], minlength=len(words))
                at_rank = [words[i] for i in np.argsort(rank)]
                rows = [(p, pack([at_rank[i] for i in own]), planes(learned[own])) for p, own in by_part]
                ids, data = batch.column(0).slice(at, end - at).fill_null(NO_ID).to_numpy(zero_copy_only=False).astype("<i8").tobytes(), planes(rank[index])
                block, ordinal = block_number(ordinal, ids, data, *(d for _, d, _ in rows)), ordinal + 1
                none = [None] * len(rows)
                yield pa.RecordBatch.from_pydict(
                    {
                        "block": [block] * (len(rows) + 1),
                        "part": [None, *(p for p, _, _ in rows)],
                        "data": [data, *(d for _, d, _ in rows)],
                        "ids": [ids, *none],
                        "counts": [counts.astype("<u4").tobytes(), *(c for _, _, c in rows)],
                        "home": [planes(home), *none],
                        "learn": [learn.astype(np.uint8).tobytes(), *none],
                    },
                    pa.schema([("block", pa.int64()), ("part", pa.int32()), *[(c, pa.binary()) for c in ("data", "ids", "counts", "home", "learn")]]),
                )

    return docs.select("doc_id", "text", "learn").mapInArrow(build, _BLOCKS)


_COUNTED = "kind int, block long, part int, counts binary, local binary, word binary, a long, b long, c long"


def _count(key: tuple, it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each part: every block's words with their counts in the whole corpus and their number among the part's most
    frequent words (kind 0); words, counts and left-out counts of each class (kind 1); the part's most frequent words, at
    most HEAD, by falling count and then by themselves (kind 2)."""
    total: Counter = Counter()
    asked = []
    for b in it:
        for block, data, counts in zip(b.column("block").to_pylist(), b.column("data").to_pylist(), b.column("counts").to_pylist(), strict=True):
            asked.append((block, data))
            for w, c in zip(unpack(data), from_planes(counts).tolist(), strict=True):
                total[w] += c
    often = sorted((w for w, c in total.items() if c >= OFTEN), key=lambda w: (-total[w], w))[:HEAD]
    local = {w: n + 1 for n, w in enumerate(often)}
    part, rows = key[0].as_py(), []
    for block, data in asked:
        words = unpack(data)
        counts = np.fromiter((total[w] for w in words), np.uint32, len(words))
        numbers = np.fromiter((local.get(w, 0) for w in words), np.uint32, len(words))
        rows.append((0, block, part, planes(counts), planes(numbers), None, None, None, None))
    known = np.fromiter((c for c in total.values() if c), np.int64)
    for k, (n, s, left) in enumerate(zip(*_by_class(known), strict=True)):
        if n or left:
            rows.append((1, k, None, None, None, None, n, s, left))
    rows += [(2, n + 1, part, None, None, w, total[w], None, None) for n, w in enumerate(often)]
    types = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], [x.split()[0] for x in _COUNTED.split(", ")])


def _by_class(counts: np.ndarray) -> tuple[list[int], list[int], list[int]]:
    """Of each class: words, the sum of their counts, and the sum of the counts of words that leaving one out puts there."""
    own, left = class_of(counts), class_of(counts - 1)
    return tuple(np.bincount(k, weights=w, minlength=CLASSES).astype(np.int64).tolist() for k, w in ((own, None), (own, counts), (left, counts)))


_CODED = "block long, data binary, ids binary, counts binary, learn binary, code binary, known binary"


def _code(head, size: int):
    """Each block's documents with the output and the count of every word; head has the numbers of each part's most frequent words."""

    def code(left: pa.Table, right: pa.Table) -> pa.Table:
        if right.num_rows and not left.num_rows:
            raise ValueError(CHANGED)
        columns = [[] for _ in range(7)]
        for at in range(left.num_rows):
            row = {c: left.column(c)[at].as_py() for c in ("block", "data", "ids", "counts", "learn", "home")}
            home = from_planes(row["home"])
            count, number = np.full(len(home), -1, np.int64), np.full(len(home), -1, np.int64)
            for part, c, n in zip(*values(right, "part", "counts", "local"), strict=True):
                mine, n = home == part, from_planes(n).astype(np.int64)
                of = np.concatenate([[-1], head.value.get(part, np.zeros(0, np.int64))])
                count[mine], number[mine] = from_planes(c), np.where(n < len(of), of[np.minimum(n, len(of) - 1)], -1)
            if (count < 0).any():
                raise ValueError(CHANGED)
            codes = np.where(number >= 0, number + 1, size + 1 + class_of(count))
            for column, x in zip(columns, (row["block"], row["data"], row["ids"], row["counts"], row["learn"], planes(codes), planes(count)), strict=True):
                column.append(x)
        return pa.Table.from_arrays([pa.array(c, pa.binary() if k else pa.int64()) for k, c in enumerate(columns)], [x.split()[0] for x in _CODED.split(", ")])

    return code


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for at in range(batch.num_rows):
        yield {c: batch.column(c)[at].as_py() for c in batch.schema.names}


_TRAINED = "piece int, rows binary, weight binary, state binary"


def _train(shared, head: int, number: int):
    """A block's state after one epoch over its texts to learn from: the outputs that occur, with how often they do."""

    def train(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, prior = shared.value
        for row in (r for batch in it for r in _rows(batch)):
            code, count = from_planes(row["code"]).astype(np.int64), from_planes(row["known"]).astype(np.int64)
            code = np.where(code <= head, code, head + 1 + class_of(np.maximum(count - 1, 0)))
            sizes, learn = np.frombuffer(row["counts"], "<u4").astype(np.int64), np.frombuffer(row["learn"], np.uint8) == 1
            stream = code[from_planes(row["data"])[np.repeat(learn, sizes)]]
            stream = np.insert(stream, np.cumsum(sizes[learn]), 0)  # one end after each text
            if not len(stream):
                continue
            state = begun.copy()
            epoch(state, np.concatenate([[0], stream[:-1]]), stream, prior, np.random.default_rng([number, row["block"] % 2**63]))
            times = np.bincount(stream, minlength=len(state))
            used = np.flatnonzero(times)
            pieces = [(k, mine) for k in range(PIECES) if len(mine := used[used % PIECES == k])]
            yield pa.RecordBatch.from_pydict(
                {"piece": [k for k, _ in pieces], "rows": [m.astype("<u4").tobytes() for _, m in pieces], "weight": [times[m].astype("<f8").tobytes() for _, m in pieces], "state": [state[m].tobytes() for _, m in pieces]},
                pa.schema([("piece", pa.int32()), *[(c, pa.binary()) for c in ("rows", "weight", "state")]]),
            )

    return train


def _average(n: int):
    def average(key: tuple, it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = key[0].as_py()
        own = len(range(piece, n, PIECES))
        total, weight = np.zeros((own, 2 * DIM + 4)), np.zeros(own)
        for row in (r for batch in it for r in _rows(batch)):
            at, w = np.frombuffer(row["rows"], "<u4") // PIECES, np.frombuffer(row["weight"], "<f8")
            total[at] += w[:, None] * np.frombuffer(row["state"], np.float32).reshape(len(at), -1)
            weight[at] += w
        used = np.flatnonzero(weight)
        mean = (total[used] / weight[used, None]).astype(np.float32)
        yield pa.RecordBatch.from_arrays([pa.array([piece], pa.int32()), *(pa.array([x], pa.binary()) for x in ((used * PIECES + piece).astype("<u4").tobytes(), weight[used].tobytes(), mean.tobytes()))], ["piece", "rows", "weight", "state"])

    return average


def _score(model):
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def score(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for row in (r for batch in it for r in _rows(batch)):
            columns = []
            code, count = from_planes(row["code"]).astype(np.int64), from_planes(row["known"]).astype(np.int64)
            size = np.frombuffer(row["counts"], "<u4").astype(np.int64)
            index = from_planes(row["data"])
            ends = np.cumsum(size + 1)  # one end after each text
            tokens = np.zeros(ends[-1], np.int64)
            counts = np.full(ends[-1], m.end_count, np.int64)
            word = np.ones(ends[-1], bool)
            word[ends - 1] = False
            tokens[word], counts[word] = code[index], count[index]
            before = np.concatenate([[0], tokens[:-1]])  # after an end comes a new text
            base = np.log10((counts + 0.5) / (m.tokens + 0.5 * (m.types + 1)))
            starts = ends - size - 1
            columns.append([None if x == NO_ID else x for x in np.frombuffer(row["ids"], "<i8").tolist()])
            columns.append((np.frombuffer(row["learn"], np.uint8) == 0).tolist())
            columns.append((size + 1).tolist())
            columns.append(np.add.reduceat((counts > 0).astype(np.int64), starts).tolist())
            columns.append([m.tokens] * len(size))
            columns.append(np.add.reduceat(base, starts).tolist())
            columns.append(np.add.reduceat(m.log10(before, tokens, counts), starts).tolist())
            types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return score


def _head(counted: DataFrame, words: list[int]) -> list:
    """part, number in the part and count of the HEAD most frequent words; words has how many each class has."""
    above = np.cumsum(words[::-1])[::-1]
    enough = np.flatnonzero(above >= HEAD)
    least = int(enough[-1]) if len(enough) else 0  # words of lower classes are not among them
    found = counted.where("kind = 2").select("part", F.col("block").alias("local"), "word", F.col("a").alias("count"))
    if least > EXACT:
        found = found.where(F.col("count") > int(EXACT * 2 ** ((least - EXACT - 1) / 2)))
    return found.orderBy(F.desc("count"), "word").limit(HEAD).select("part", "local", "count").collect()


def score_texts(docs: DataFrame, folds: int = 5, fold: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Texts whose crc32(id as text) mod folds is `fold` are held out; all others are counted and train the model. Tokens are the words
    [^\\x20\\x09-\\x0D]+ after lower-casing A-Z, and one end. base_score is the sum of log10((c + 0.5) / (N + 0.5 (V + 1))), score the
    model's log10 probability, over the same events: V known tokens and one for all others. A null text counts as empty; a
    null id is learned from. Where nothing is learned, the model knows the end alone. Other columns are ignored.
    """
    spark = docs.sparkSession
    texts = id_text(docs, id_col, text_col).withColumn("learn", ~F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == fold, F.lit(False)))
    parts = shuffle_partitions(spark)
    blocks = _blocks(texts, parts).persist(StorageLevel.MEMORY_AND_DISK)
    blocks.count()  # two branches read it
    counted = blocks.where("part IS NOT NULL").select("part", "block", "data", "counts").groupBy("part").applyInArrow(_count, _COUNTED).persist(StorageLevel.MEMORY_AND_DISK)
    of_class = np.zeros((CLASSES, 3), np.int64)
    for r in counted.where("kind = 1").groupBy("block").agg(F.sum("a").alias("n"), F.sum("b").alias("s"), F.sum("c").alias("left")).collect():  # CLASSES rows
        of_class[r["block"]] = r["n"], r["s"], r["left"]
    top = _head(counted, of_class[:, 0].tolist())  # HEAD rows
    frequent = np.array([r["count"] for r in top], np.int64)
    of_class -= np.array(_by_class(frequent)).T
    head: dict[int, list] = {}
    for n, r in enumerate(top):
        head.setdefault(r["part"], []).append((r["local"], n))
    numbers = spark.sparkContext.broadcast({p: np.array([n for _, n in sorted(x)], np.int64) for p, x in head.items()})  # a part's words are its first ones
    ends = texts.where("learn").count()

    size, shares = 1 + len(top) + CLASSES, of_class[:, 1].astype(float)
    types, tokens = int((ends > 0) + len(top) + of_class[:, 0].sum()), int(ends + frequent.sum() + of_class[:, 1].sum())
    mass = np.full(size, 0.5) + np.concatenate([[ends], frequent, of_class[:, 2]])
    empty = np.flatnonzero(shares == 0)
    mass[1 + len(top) + empty[empty > 0]] = 1e-9  # no word would have it
    prior = mass / mass.sum()

    whole = blocks.where("part IS NULL").select("block", "data", "ids", "counts", "home", "learn")
    known = counted.where("kind = 0").select("block", "part", "counts", "local")
    coded = whole.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(_code(numbers, len(top)), _CODED).persist(StorageLevel.MEMORY_AND_DISK)  # each epoch reads it
    state = start(prior)
    for n in range(EPOCHS):
        shared = spark.sparkContext.broadcast((state, prior))  # bounded by HEAD and CLASSES
        trained = coded.mapInArrow(_train(shared, len(top), n), _TRAINED).groupBy("piece").applyInArrow(_average(size), _TRAINED)
        for r in trained.collect():  # PIECES rows
            state[np.frombuffer(r["rows"], "<u4")] = np.frombuffer(r["state"], np.float32).reshape(-1, state.shape[1])
    held = spark.sparkContext.broadcast(Model(*parts_of(state), shares, len(top), ends, tokens, types))  # bounded by HEAD and CLASSES
    return coded.mapInArrow(_score(held), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
