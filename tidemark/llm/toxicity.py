"""Toxicity by compression distance: two zstandard dictionaries, one trained on ordinary text and one on toxic text.

A window is one word in lower case, or two in a row where the first begins a phrase of the toxic dictionary, with a space on either side
and a fixed tail (zstandard looks for no match in a block's last bytes); a word over `WINDOW` characters is cut into several. Each window
is compressed with either dictionary. The pair of lengths says how ordinary and how toxic it looks, and what a pair is worth is
calibrated, words and phrases apart: the log ratio of its frequencies in toxic and in ordinary documents. A document's evidence is the sum over its whole text of the windows whose worth is above a threshold, and a
logistic curve over evidence and length, fitted on the same documents, turns it into a score.

Only fitting takes a sample: at most `TOXIC` toxic and `ORDINARY` ordinary labelled documents, those with the least hashes of their
ids. The toxic dictionary is trained on the toxic texts as far as their words and phrases are more frequent there than in ordinary ones, by
a ratio and beyond what chance does to that many windows (`_telling`); the rest is the same in both. A word that ordinary texts quote, or
that stands in some with a wrong label, so stays one of it. The ordinary dictionary is trained on the ordinary texts without these words.
Scoring takes every document whole.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm import words as W
from tidemark.llm.frames import share, tidied

#: Most labelled documents taken to fit on, by label.
TOXIC, ORDINARY = 4_000, 8_000
WINDOW = 48
TAIL = b"\n" * 12
LEVEL = 19
#: Bytes of the dictionaries.
ORDINARY_BYTES, TOXIC_BYTES = 1_000_000, 16_384
#: Least gain a window's lengths must stand for (a log ratio) to count as evidence.
WORTH = 1.5
#: Evidence beyond this changes nothing.
MOST = 100.0
#: Windows whose worth a task keeps at hand.
CACHE = 1 << 19


def _train(samples: list[bytes], size: int, segment: int) -> bytes:
    """A trained dictionary, or the samples themselves where they are too few to train on."""
    samples = [s for s in samples if s]
    try:
        return zstandard.train_dictionary(size, samples, d=6, k=segment, f=20, accel=1, steps=1).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _compressor(content: bytes) -> zstandard.ZstdCompressor | None:
    if len(content) < 8:
        return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False)
    held = zstandard.ZstdCompressionDict(content)
    held.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_dict_id=False, write_content_size=False, write_checksum=False)


def windows(text: str | None) -> list[str]:
    """The words of a text, long ones in pieces."""
    out = (text or "").lower().split()
    if any(len(w) > WINDOW for w in out):
        out = [w[i : i + WINDOW] for w in out for i in range(0, len(w), WINDOW)]
    return out


def _framed(window: str) -> bytes:
    return f" {window} ".encode("utf-8", "replace")


def _phrases(found: list[str], starts: frozenset[str]) -> list[str]:
    """The pairs of words in a row whose first one begins a phrase."""
    return [f"{a} {b}" for a, b in zip(found, found[1:]) if a in starts] if starts else []


@dataclass
class Model:
    """Two dictionaries, the words that begin a phrase, the worth of pairs of lengths, and the curve over (1, evidence, log of the number of
    words)."""

    ordinary: bytes
    toxic: bytes
    starts: frozenset[str]
    worth: dict[tuple[int, int, bool], float]
    curve: tuple[float, float, float]

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer(dict):
    """Worth of each window, kept for those seen first; a frequent one is among them."""

    def __init__(self, model: Model):
        self.model = model
        self.with_ordinary, self.with_toxic = _compressor(model.ordinary), _compressor(model.toxic)

    def lengths(self, window: str) -> tuple[int, int, bool]:
        """Both lengths, and whether the window is a phrase."""
        framed = _framed(window) + TAIL
        return len(self.with_ordinary.compress(framed)), len(self.with_toxic.compress(framed)), " " in window

    def __missing__(self, window: str) -> float:
        worth = self.model.worth.get(self.lengths(window), 0.0)
        if len(self) < CACHE:
            self[window] = worth
        return worth

    def features(self, text: str | None) -> tuple[float, float, float]:
        found = windows(text)
        evidence = sum(map(self.__getitem__, found)) + sum(map(self.__getitem__, _phrases(found, self.model.starts)))
        return 1.0, min(evidence, MOST), float(np.log1p(len(found)))

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.dot(self.features(text), self.model.curve))))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Newton steps for a logistic curve with a little ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (y - p)) - 1e-2 * w
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w)), slope)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w


def _telling(toxic: list[np.ndarray], plain: list[np.ndarray]) -> np.ndarray:
    """The windows (as numbers, without repeats in a text) that tell toxic texts: in at least exp(WORTH) times the share of them as of the
    ordinary ones, and more unevenly than chance makes the most uneven of as many windows."""
    if not toxic or not plain:
        return np.zeros(0, np.int64)
    windows, a = np.unique(np.concatenate(toxic), return_counts=True)
    others = np.concatenate(plain)
    at = np.minimum(np.searchsorted(windows, others), max(len(windows) - 1, 0))
    b = np.bincount(at[windows[at] == others], minlength=len(windows)) if len(windows) else a
    share_of = len(toxic) / (len(toxic) + len(plain))
    ratio = np.log((a + 0.5) / (len(toxic) + 1)) - np.log((b + 0.5) / (len(plain) + 1))
    uneven = a * np.log(a / ((a + b) * share_of)) + b * np.log(np.maximum(b, 1) / ((a + b) * (1 - share_of)))
    return windows[(ratio >= WORTH) & (uneven >= np.log(max(len(windows), 1)))]


def _dictionaries(samples: list[tuple[list[str], int]]) -> tuple[bytes, bytes, frozenset[str]]:
    """The ordinary and the toxic dictionary of labelled documents, given by their words, and the words that begin a phrase."""
    number: dict[str, int] = {}
    texts = [(np.array([number.setdefault(w, len(number)) for w in found], np.int64), y) for found, y in samples]
    names = list(number)
    single = _telling(*([np.unique(x) for x, y in texts if y == label] for label in (1, 0)))

    def pairs(x: np.ndarray) -> np.ndarray:
        # a phrase with a telling word in it says nothing more
        free = ~np.isin(x, single)
        return np.where(free[:-1] & free[1:], x[:-1] << 32 | x[1:], -1)

    double = _telling(*([np.setdiff1d(pairs(x), [-1]) for x, y in texts if y == label] for label in (1, 0)))
    bad = {names[k] for k in single.tolist()}
    plain = [[w for w in found if w not in bad] for found, y in samples if not y]
    ordinary = _train([" ".join(w[i : i + 8]).encode("utf-8", "replace") for w in plain for i in range(0, len(w), 8)], ORDINARY_BYTES, 50)
    toxic = []
    for x, y in texts:
        if y:
            held = [(i, names[x[i]]) for i in np.flatnonzero(np.isin(x, single)).tolist()]
            held += [(i, f"{names[x[i]]} {names[x[i + 1]]}") for i in np.flatnonzero(np.isin(pairs(x), double)).tolist()]
            toxic.append(b"".join(_framed(w) for _, w in sorted(held)))
    return ordinary, _train(toxic, TOXIC_BYTES, 32), frozenset(names[k] for k in (double >> 32).tolist())


def train(samples: list[tuple[str | None, int]], shares: dict[int, float] | None = None) -> Model:
    """Fit on (text, label) samples; shares gives each label's weight, so that a sample with other shares than the corpus does not
    shift the scores. Without samples of both labels every text scores the share of label 1, or 0."""
    labels = {y for _, y in samples}
    if labels != {0, 1}:
        return Model(b"", b"", frozenset(), {}, (30.0 if labels == {1} else -30.0, 0.0, 0.0))
    known: dict[str, str] = {}  # one string for all occurrences of a window
    cut = [([known.setdefault(w, w) for w in windows(t)], y) for t, y in samples]
    dictionaries = _dictionaries(cut)
    scorer = Scorer(Model(*dictionaries, {}, (0.0, 0.0, 0.0)))
    pairs = {w: scorer.lengths(w) for w in set().union(*(found for found, _ in cut), *(_phrases(found, dictionaries[2]) for found, _ in cut))}
    looked = [(Counter(map(pairs.__getitem__, found + _phrases(found, dictionaries[2]))), len(found), y) for found, y in cut]
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    for seen, _, y in looked:
        counts[y].update(seen)
    total = [sum(c.values()) + 100 for c in counts]
    worth = {k: float(np.log((counts[1][k] + 1) / total[1]) - np.log((counts[0][k] + 1) / total[0])) for k in {*counts[0], *counts[1]}}
    worth = {k: v for k, v in worth.items() if v > WORTH}
    x = np.array([(1.0, min(sum(worth.get(k, 0.0) * n for k, n in seen.items()), MOST), np.log1p(n)) for seen, n, _ in looked])
    y = np.array([label for _, _, label in looked], float)
    curve = _logistic(x, y, np.array([(shares or {}).get(int(v), 1.0) for v in y]))
    return Model(*dictionaries, worth, tuple(curve))


def fit(documents: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic", where: Column | None = None) -> Model:
    """Train on labelled documents; `where` (over the column doc_id) keeps rows out of the fit, such as a held-out part.

    At most TOXIC + ORDINARY labelled ids are chosen, and one task fits on their whole texts; only the model comes to the driver. Rows without an
    id, a label of 0 or 1, or a document are not used; an id with both labels counts as toxic. Repeated documents of an id are all used.
    """
    marked = labels.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("y")).where("y IN (0, 1) AND doc_id IS NOT NULL")
    if where is not None:
        marked = marked.where(where)
    marked = marked.groupBy("doc_id").agg(F.max("y").alias("y")).withColumn("h", F.xxhash64("doc_id"))
    total = {r["y"]: r["count"] for r in marked.groupBy("y").count().collect()}  # two rows
    chosen = None
    for y, most in ((0, ORDINARY), (1, TOXIC)):
        part = marked.where(F.col("y") == y).orderBy("h", "doc_id").limit(most)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = documents.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows = texts.join(F.broadcast(chosen), "doc_id").select("text", "y", "h", F.crc32(F.coalesce("text", F.lit(""))).alias("c"))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        samples = [(t.as_py(), y) for batch in batches for t, y in zip(batch.column(0), batch.column(1).to_pylist(), strict=True)]
        taken = Counter(y for _, y in samples)
        shares = {y: total[y] / taken[y] for y in taken}
        least = min(shares.values(), default=1.0)
        model = train(samples, {y: s / least for y, s in shares.items()})
        rest = pickle.dumps((model.starts, model.worth, model.curve))
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in (model.ordinary, model.toxic, rest)], names=["ordinary", "toxic", "rest"])

    sample = rows.repartition(1).sortWithinPartitions("h", "c", "text").select("text", "y")
    found = sample.mapInArrow(tidied(learn), "ordinary binary, toxic binary, rest binary").collect()
    if not found:
        return train([])
    return Model(bytes(found[0]["ordinary"]), bytes(found[0]["toxic"]), *pickle.loads(found[0]["rest"]))


def score(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Every row as doc (a struct of its columns, so no name clashes) with score, from 0 to 1; null and empty texts score like texts without evidence,
    equal texts alike, repeated rows are rows of their own, and an empty table gives none."""
    shared = share(documents.sparkSession, model)
    rows = documents.select(F.struct(*(f"`{c}`" for c in documents.columns)).alias("doc"), F.col(f"`{text}`").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared().scorer()
        for batch in batches:
            column = batch.column(1)
            for row, end, _, _ in W.slices(column):
                scores = [scorer.score(t) for t in column.slice(row, end - row).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, end - row), pa.array(scores, pa.float64())], names=["doc", "score"])

    return rows.mapInArrow(tidied(work), f"doc {rows.schema['doc'].dataType.simpleString()}, score double")


def held_out(doc_id: Column) -> Column:
    """A fifth of the documents, by the checksum of the id as text; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def drop_toxic(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows, all columns, that score below one half."""
    return score(documents, model, text).where("score < 0.5").select(*(F.col("doc").getField(c).alias(c) for c in documents.columns))
