"""Words that a public tokenizer encodes one by one.

A byte-level tokenizer cuts a text by a pattern before its merges, so a text's ids are the ids of its words put in a row.
Spark applies the pattern. Texts with special tokens or with code points that Java's Unicode tables do not know stay
whole: the library itself then splits them, as one long word. A tokenizer that drops white space needs no pattern: it encodes what
lies between ASCII white space apart.
"""

from __future__ import annotations

import os
from dataclasses import dataclass
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: The split patterns of the tokenizer files.
BYTE_PATTERN = r"(?U)'(?:[stmd]|re|ve|ll)| ?+(?:\p{L}++|\p{N}++|[^\s\p{L}\p{N}]++)|\s+(?!\S)|\s+"
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|\pL+|\pN|[^\s\pL\pN]+"
#: Special tokens, and code points that Java's older Unicode tables do not know as letters or numbers.
UNSAFE = r"<\|(?:start|end)oftext\|>|\p{Cn}"
AT_ONCE, MOST_KEPT = 16_384, 150_000


@dataclass(frozen=True)
class Vocabulary:
    """A tokenizer file and its split pattern."""

    path: str
    pattern: str

    def words(self, text: Column) -> Column:
        """The words of a text, in order; an unsafe text is one word."""
        whole = F.regexp_extract_all(text, F.lit(self.pattern), F.lit(0))
        return F.when(text.rlike(UNSAFE), F.array(text)).otherwise(whole)


def byte_bpe(path: str | None = None) -> Vocabulary:
    return Vocabulary(path or public_file("byte_bpe_50k.json"), BYTE_PATTERN)


def public_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def tokenizer(path: str):
    """The library's tokenizer, loaded once in each worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


@lru_cache(maxsize=4)
def _separator(path: str) -> tuple[str, int]:
    """A special token, which the library cuts out before anything else: words around it are encoded apart."""
    id_, token = max(tokenizer(path).get_added_tokens_decoder().items())
    return token.content, id_


@lru_cache(maxsize=4)
def _closing(path: str) -> np.ndarray | None:
    """For each id whether its piece ends a word, where the vocabulary marks that."""
    t = tokenizer(path)
    out = np.zeros(t.get_vocab_size(), bool)
    for piece, id_ in t.get_vocab().items():
        out[id_] = piece.endswith("</w>")
    return out if out.any() else None


def _runs(words: list[str], apart: np.ndarray) -> list[list[str] | str]:
    """Words in runs of 256; those set apart alone."""
    runs, start = [], 0
    for stop in [*np.flatnonzero(apart).tolist(), len(words)]:
        runs += [words[a : min(a + 256, stop)] for a in range(start, stop, 256)]
        runs += words[stop : stop + 1]
        start = stop + 1
    return runs


def encode_flat(path: str, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words in a row (uint32) and how many each has.

    Plain words go to the library 256 to a text. With a vocabulary that marks word ends, a space lies between them and each
    ends with its last part by WORD_PATTERN; otherwise a special token, which the library cuts out first, does.
    """
    (mark, end), closing = _separator(path), _closing(path)
    encode, ids, lengths = tokenizer(path).encode_batch_fast, [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
    for at in range(0, len(words), AT_ONCE):
        part = words.slice(at, AT_ONCE)
        unsafe = pc.match_substring_regex(part, r"<\|" if closing is None else r"<\||[^!-~¡-įı-ſ]").to_numpy(zero_copy_only=False) | (pc.binary_length(part).to_numpy(zero_copy_only=False) == 0)
        parts = pc.count_substring_regex(part, WORD_PATTERN).to_numpy(zero_copy_only=False) if closing is not None else None
        runs, done = _runs(part.to_pylist(), unsafe), 0
        for r, e in zip(runs, encode([r if isinstance(r, str) else (mark if closing is None else " ").join(r) for r in runs], add_special_tokens=False), strict=True):
            got = np.array(e.ids, np.uint32)
            if isinstance(r, str):
                size = np.array([len(got)])
            elif closing is None:
                cut = got == end
                size = np.diff(np.concatenate([[-1], np.flatnonzero(cut), [len(got)]])) - 1
                got = got[~cut]
            else:
                ends, last = np.flatnonzero(closing[got]) + 1, np.cumsum(parts[done : done + len(r)])
                if len(ends) != last[-1]:  # the two pattern engines differ
                    each = [np.array(x.ids, np.uint32) for x in encode(r, add_special_tokens=False)]
                    got, size = np.concatenate(each), np.array([len(x) for x in each])
                else:
                    size = np.diff(ends[last - 1], prepend=0)
            done += 1 if isinstance(r, str) else len(r)
            ids.append(got)
            lengths.append(size)
    return np.concatenate(ids), np.concatenate(lengths)


class Remembered:
    """encode_flat for one batch after another in a worker; words that a batch repeats are kept, MOST_KEPT of them."""

    def __init__(self, path: str):
        self.path, self.place = path, {}
        self.ids, self.lengths = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def encode(self, words: pa.Array, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids known so far, and for each word where its ids start and how many there are."""
        place = np.empty(len(words), np.int64)
        for at in range(0, len(words), AT_ONCE):
            part = words.slice(at, AT_ONCE).to_pylist()
            place[at : at + len(part)] = np.fromiter(map(self.place.get, part, repeat(-1)), np.int64, len(part))
        fresh = np.flatnonzero(place < 0)
        fresh = fresh[np.argsort(times[fresh] < 2, kind="stable")]  # repeated words first
        ids, lengths = encode_flat(self.path, words.take(pa.array(fresh)))
        place[fresh] = len(self.lengths) + np.arange(len(fresh))
        ids, lengths = np.concatenate([self.ids, ids]), np.concatenate([self.lengths, lengths])
        starts = np.cumsum(lengths) - lengths
        n = min(int((times[fresh] >= 2).sum()), MOST_KEPT - len(self.place))
        self.place.update(zip(words.take(pa.array(fresh[:n])).to_pylist(), range(len(self.place), len(self.place) + n), strict=True))
        self.lengths = lengths[: len(self.place)].copy()
        self.ids = ids[: self.lengths.sum()].copy()
        return ids, starts[place], lengths[place]


@lru_cache(maxsize=2)
def remembered(path: str) -> Remembered:
    return Remembered(path)


def encode_words(path: str, words: list[str]) -> list[bytes]:
    """Ids of each word, as little-endian unsigned 32-bit integers."""
    ids, lengths = encode_flat(path, pa.array(words, pa.string()))
    data, ends = ids.astype("<u4").tobytes(), np.cumsum(lengths) * 4
    return [data[b - n : b] for b, n in zip(ends.tolist(), (lengths * 4).tolist(), strict=True)]


def spread(index: np.ndarray, ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a row of words, and how many ids come before each of them (and the total at the end)."""
    n = lengths[index]
    ends = np.concatenate([[0], np.cumsum(n)])
    return ids[np.repeat((starts[index] - ends[:-1]).astype(np.int32), n) + np.arange(ends[-1], dtype=np.int32)], ends
