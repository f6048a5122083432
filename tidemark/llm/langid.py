"""Language identification by a convolutional network over bytes.

Bytes are embedded; filters of widths 2, 3 and 4 slide over a window of fixed length; the maximum of each filter over the
window goes to a softmax. A text's windows cover it whole and their logits are averaged. Training is plain numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches

WINDOW, EMBED, WIDEST, FILTERS = 256, 8, 4, 16
#: Labelled documents that fit the model at most, those with the smallest hash of their id.
TRAIN_DOCS, TRAIN_WINDOWS = 6000, 3
UNKNOWN = "und"


@dataclass
class Network:
    languages: list[str]
    embed: np.ndarray  # 257 x EMBED; row 256 is padding
    conv: np.ndarray  # WIDEST*EMBED x filters; a narrow filter is zero beyond its width
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n, length = windows.shape
        wide = np.full((n, length + WIDEST - 1), 256, np.int64)
        wide[:, :length] = windows
        e = self.embed[wide].reshape(n, -1)
        columns = np.lib.stride_tricks.sliding_window_view(e, WIDEST * EMBED, axis=1)[:, ::EMBED].reshape(n * length, -1)
        z = (columns @ self.conv).reshape(n, length, -1)
        return z, columns, wide

    def logits(self, windows: np.ndarray) -> np.ndarray:
        out = np.empty((len(windows), len(self.languages)), np.float32)
        for at in range(0, len(windows), 64):
            z, _, _ = self.pooled(windows[at : at + 64])
            out[at : at + 64] = np.maximum(z.max(axis=1) + self.bias, 0) @ self.out + self.out_bias
        return out


def _mask() -> np.ndarray:
    mask = np.zeros((WIDEST * EMBED, FILTERS * (WIDEST - 1)), np.float32)
    for k, width in enumerate(range(2, WIDEST + 1)):
        mask[: width * EMBED, k * FILTERS : (k + 1) * FILTERS] = 1
    return mask


def fit(windows: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = 5, batch: int = 64, rate: float = 3e-3, seed: int = 7) -> Network:
    """Adam on the cross entropy, classes weighted by the inverse root of their share."""
    rng, mask = np.random.default_rng(seed), _mask()
    normal = lambda *s, scale: (rng.standard_normal(s) * scale).astype(np.float32)
    net = Network(languages, normal(257, EMBED, scale=0.5), normal(*mask.shape, scale=0.2) * mask, np.zeros(mask.shape[1], np.float32), normal(mask.shape[1], len(languages), scale=0.2), np.zeros(len(languages), np.float32))
    names = ("embed", "conv", "bias", "out", "out_bias")
    moments = {k: (np.zeros_like(getattr(net, k)), np.zeros_like(getattr(net, k))) for k in names}
    share = np.bincount(labels, minlength=len(languages)) / max(1, len(labels))
    weight, t = 1 / np.sqrt(np.maximum(share, 1e-6)), 0
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            x, y = windows[rows], labels[rows]
            z, columns, wide = net.pooled(x)
            best = z.argmax(axis=1)
            top = np.take_along_axis(z, best[:, None, :], 1)[:, 0] + net.bias
            hidden = np.maximum(top, 0)
            logits = hidden @ net.out + net.out_bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(y)), y] -= 1
            d = (p * (weight[y] / weight[y].sum())[:, None]).astype(np.float32)
            g = {"out": hidden.T @ d, "out_bias": d.sum(axis=0)}
            back = (d @ net.out.T) * (top > 0)
            g["bias"] = back.sum(axis=0)
            n, length = x.shape
            picked = columns.reshape(n, length, -1)[np.arange(n)[:, None], best]  # rows x filters x inputs: only the maxima pass a gradient
            g["conv"] = np.einsum("nf,nfi->if", back, picked) * mask
            into = (back[:, :, None] * net.conv.T[None]).reshape(n, -1, WIDEST, EMBED)
            place = wide[np.arange(n)[:, None, None], best[:, :, None] + np.arange(WIDEST)]
            g["embed"] = np.stack([np.bincount(place.ravel(), weights=into[..., k].ravel(), minlength=257) for k in range(EMBED)], axis=1).astype(np.float32)
            t += 1
            for k in names:
                m, v = moments[k]
                m += 0.1 * (g[k] - m)
                v += 0.001 * (g[k] ** 2 - v)
                getattr(net, k)[...] -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return net


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Windows that cover each text whole, the last one padded, and the offset of each text's first window."""
    count = np.array([max(1, -(-len(t) // WINDOW)) for t in texts], np.int64)
    ends = np.concatenate([[0], np.cumsum(count)])
    flat = np.full(int(ends[-1]) * WINDOW, 256, np.int16)
    for t, at in zip(texts, ends, strict=False):
        flat[at * WINDOW : at * WINDOW + len(t)] = np.frombuffer(t, np.uint8)
    return flat.reshape(-1, WINDOW), ends


def train(labelled: DataFrame, limit: int = TRAIN_DOCS, each: int = TRAIN_WINDOWS) -> Network | None:
    """Of a table (doc_id, text, lang) without nulls, on `each` windows of at most `limit` texts; None without one.

    Any window of a whole text may be chosen, by a hash of id and number; a text of fewer windows is learned whole. Of rows that share an id
    one counts. What reaches the driver is bounded by limit * each windows, however long the texts.
    """
    chosen = labelled.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    texts = labelled.join(F.broadcast(chosen), "doc_id")  # at most `limit` ids
    raw = F.encode("text", "utf-8")
    count = F.greatest(F.lit(1), F.ceil(F.length(raw) / WINDOW)).cast("int")
    spots = F.when(count <= each, F.sequence(F.lit(0), count - 1)).otherwise(F.array_distinct(F.transform(F.sequence(F.lit(1), F.lit(each)), lambda k: F.pmod(F.xxhash64("doc_id", k), count).cast("int"))))
    cut = texts.select("doc_id", "lang", raw.alias("raw"), spots.alias("spots"))
    cut = cut.select("doc_id", "lang", F.transform("spots", lambda at: F.substring("raw", at * WINDOW + 1, F.lit(WINDOW))).alias("windows"))
    rows = cut.groupBy("doc_id").agg(F.min(F.struct("lang", "windows")).alias("x")).select("doc_id", "x.lang", F.explode("x.windows").alias("window")).toArrow()
    rows = rows.sort_by([("doc_id", "ascending"), ("lang", "ascending"), ("window", "ascending")])
    if not rows.num_rows:
        return None
    lang = rows.column("lang").to_pylist()
    languages = sorted(set(lang))
    windows, _ = windows_of(rows.column("window").to_pylist())
    return fit(windows, np.array([languages.index(x) for x in lang]), languages)


def identify(docs: DataFrame, network: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, lang_pred, score (probability of lang_pred to five places; beyond, it hangs on the batch).

    A text that is null or has no letter is `und` with score 1, as is every text where nothing was learned. Other columns are
    ignored; rows that repeat are judged alike; an empty table gives an empty result.
    """
    held = docs.sparkSession.sparkContext.broadcast(network)  # its size is fixed by the constants above

    def of(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it, 200):
            net, text = held.value, pc.fill_null(b.column(1), "")
            letters = pc.match_substring_regex(text, r"\pL").to_numpy(zero_copy_only=False)
            names, scores = np.array([UNKNOWN] * b.num_rows, object), np.ones(b.num_rows)
            if net is not None and letters.any():
                windows, ends = windows_of(text.filter(pa.array(letters)).cast(pa.binary()).to_pylist())
                logits = np.add.reduceat(net.logits(windows), ends[:-1], axis=0) / np.diff(ends)[:, None]
                p = np.exp(logits - logits.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                names[letters], scores[letters] = np.array(net.languages, object)[p.argmax(axis=1)], p.max(axis=1).round(5)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(of, "doc_id long, lang_pred string, score double")


def languages(docs: DataFrame, folds: int = 5) -> DataFrame:
    """Learns from the documents outside the held-out fold, crc32(doc_id as text) mod folds = 0, and predicts all: doc_id, held_out, lang_pred, score."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % folds == 0
    learned = docs.where(~held_out).where("text IS NOT NULL AND lang IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "text", "lang")
    return identify(docs, train(learned)).select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")
