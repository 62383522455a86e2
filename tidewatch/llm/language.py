"""Language identification by a byte convolutional network, trained here in numpy.

Text goes through as bytes: A-Z in lower case, ASCII that is no letter as a space. Fixed-length
windows cover the whole text; each is embedded byte by byte, filtered at several widths at once,
max-pooled over its positions and classified by softmax. A document's probabilities are the mean
over its windows, weighted by their letters. Windows of many documents form one batch, so the work
per byte is a matrix product.

The network is fitted on the driver to windows of a bounded sample of labelled documents
(``sample_docs`` for each language, ``sample_windows`` from each, spread over its whole text);
prediction is a map over the documents, without a shuffle.

Nulls and edge cases: null texts and texts without a letter are ``und`` with score 0, as is every
text if nothing is labelled; rows without a label are not learned from; repeated rows are each
predicted; an empty table gives no rows. Further columns are kept; ``lang_pred`` and ``score``
replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.arrays import as_strings, buffers, row_blocks

UNKNOWN = "und"
LENGTH = 96
WIDTHS = (2, 3, 4)
FILTERS = 12
DIMENSIONS = 8
REACH = max(WIDTHS)
SPACE = 0x20

LETTERS = np.full(256, SPACE, np.uint8)
LETTERS[0x80:] = np.arange(0x80, 0x100)
for _c in range(0x80):
    if chr(_c).isalpha():
        LETTERS[_c] = ord(chr(_c).lower())


def windows_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows that cover each row (the next one's first bytes included), and their rows."""
    sizes = np.diff(offsets)
    counts = -(-sizes // LENGTH)
    row = np.repeat(np.arange(len(sizes)), counts)
    number = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = offsets[row] + number * LENGTH
    at = begin[:, None] + np.arange(LENGTH + REACH - 1)
    inside = at < offsets[row + 1][:, None]
    out = LETTERS[data][np.minimum(at, max(0, len(data) - 1))] if len(data) else np.zeros(at.shape, np.uint8)
    out[~inside] = SPACE
    return out, row


@dataclass
class Network:
    """Embedding, filters of all widths side by side (rows beyond a width are 0), and the classifier."""

    languages: list[str]
    embedding: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    weights: np.ndarray
    shift: np.ndarray

    def _responses(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        embedded = self.embedding[windows]
        flat = np.lib.stride_tricks.sliding_window_view(
            embedded.reshape(len(windows), -1), REACH * DIMENSIONS, axis=1
        )[:, ::DIMENSIONS]
        patches = np.ascontiguousarray(flat).reshape(-1, REACH * DIMENSIONS)
        return patches, (patches @ self.filters).reshape(len(windows), LENGTH, -1)

    def probabilities(self, windows: np.ndarray, batch: int = 512) -> np.ndarray:
        out = np.empty((len(windows), len(self.languages)), np.float32)
        for k in range(0, len(windows), batch):
            _, response = self._responses(windows[k : k + batch])
            pooled = np.maximum(response.max(axis=1) + self.bias, 0)
            out[k : k + batch] = _softmax(pooled @ self.weights + self.shift)
        return out


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def train(
    windows: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = 10, rate: float = 4e-3,
    batch: int = 256, seed: int = 5,
) -> Network:
    """Fit a network to labelled windows by gradient descent with Adam, classes weighted alike."""
    random = np.random.default_rng(seed)
    n_filters, span = FILTERS * len(WIDTHS), REACH * DIMENSIONS
    open_ = np.zeros((span, n_filters), np.float32)
    for k, width in enumerate(WIDTHS):
        open_[: width * DIMENSIONS, k * FILTERS : (k + 1) * FILTERS] = 1
    net = Network(
        languages, random.normal(0, 0.5, (256, DIMENSIONS)).astype(np.float32),
        (random.normal(0, 0.3, (span, n_filters)) * open_).astype(np.float32),
        np.zeros(n_filters, np.float32),
        random.normal(0, 0.2, (n_filters, len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    names = ("embedding", "filters", "bias", "weights", "shift")
    first = {k: np.zeros_like(getattr(net, k)) for k in names}
    second = {k: np.zeros_like(getattr(net, k)) for k in names}
    share = len(labels) / len(languages) / np.maximum(np.bincount(labels, minlength=len(languages)), 1)
    step, total = 0, epochs * -(-len(labels) // batch)
    for _ in range(epochs):
        order = random.permutation(len(labels))
        for k in range(0, len(order), batch):
            rows = order[k : k + batch]
            x = windows[rows].copy()
            # short texts occur too: cut some windows to a random length
            cut = random.random(len(rows)) < 0.3
            stop = np.where(cut, random.integers(8, LENGTH, len(rows)), x.shape[1])
            x[np.arange(x.shape[1]) >= stop[:, None]] = SPACE
            slopes = _slopes(net, x, labels[rows], share, open_)
            step += 1
            pace = rate * min(1.0, 2 * (1 - step / (total + 1)))
            for name, slope in zip(names, slopes, strict=True):
                first[name] += 0.1 * (slope - first[name])
                second[name] += 0.01 * (slope * slope - second[name])
                move = first[name] / (1 - 0.9**step)
                getattr(net, name)[...] -= pace * move / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-7)
    return net


def _slopes(net: Network, x, labels, share, open_):
    rows = np.arange(len(x))
    patches, response = net._responses(x)
    place = response.argmax(axis=1)
    pooled = np.take_along_axis(response, place[:, None], 1)[:, 0] + net.bias
    hidden = np.maximum(pooled, 0)
    error = _softmax(hidden @ net.weights + net.shift)
    error[rows, labels] -= 1
    error *= (share[labels] / len(x))[:, None]
    back = (error @ net.weights.T * (pooled > 0)).astype(np.float32)
    taken = patches.reshape(len(x), LENGTH, -1)[rows[:, None], place]
    filters = np.einsum("nf,nfk->kf", back, taken) * open_
    # what each byte under a maximum contributes to its embedding
    spread = (back[:, :, None] * net.filters.T).reshape(len(x), -1, REACH, DIMENSIONS)
    under = x[rows[:, None, None], place[:, :, None] + np.arange(REACH)]
    embedding = np.zeros_like(net.embedding)
    np.add.at(embedding, under.reshape(-1), spread.reshape(-1, DIMENSIONS))
    return embedding, filters, back.sum(0), hidden.T @ error, error.sum(0)


# ---------------------------------------------------------------- in Spark


def sample_windows_of(
    docs: DataFrame, label: str, sample_docs: int, sample_windows: int
) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Windows, labels and languages of a bounded sample: the first distinct texts of each language in
    hash order. Copies are merged before the ranking, so a large group of them takes one place."""
    rows = docs.where(F.col(label).isNotNull() & F.col("text").rlike(r"\p{L}")).select(
        F.col(label).cast("string").alias("label"), F.col("text").cast("string").alias("text"),
        F.xxhash64("text").alias("key"),
    )
    # hashes alone are ranked; the few texts are then fetched by them
    rank = F.row_number().over(Window.partitionBy("label").orderBy("key"))
    picked = rows.select("label", "key").distinct().withColumn("rank", rank).where(F.col("rank") <= sample_docs)
    chosen = rows.join(F.broadcast(picked.select("label", "key")), ["label", "key"], "left_semi")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            texts = as_strings(batch.column("text"))
            held = zip(batch.column("label").to_pylist(), batch.column("key").to_pylist(), strict=True)
            for k, pair in enumerate(held):
                if pair in seen:
                    continue
                seen.add(pair)
                data, offsets = buffers(texts.slice(k, 1))
                found, _ = windows_of(data, offsets)
                take = np.unique(np.linspace(0, len(found) - 1, sample_windows).astype(int))
                yield pa.RecordBatch.from_pydict({
                    "label": [pair[0]] * len(take), "key": pa.array([pair[1]] * len(take), pa.int64()),
                    "number": take.astype(np.int32), "bytes": pa.array([w.tobytes() for w in found[take]]),
                })

    windows = chosen.mapInArrow(cut, "label string, key long, number int, bytes binary")
    found = sorted(set(map(tuple, windows.collect())))
    languages = sorted({r[0] for r in found})
    width = LENGTH + REACH - 1
    x = np.frombuffer(b"".join(bytes(r[3]) for r in found), np.uint8).reshape(-1, width)
    return x, np.array([languages.index(r[0]) for r in found], np.int64), languages


def fit(
    docs: DataFrame, label: str = "lang", sample_docs: int = 300, sample_windows: int = 8
) -> Network | None:
    """A network for the languages that ``docs`` are labelled with; None if there are none."""
    windows, labels, languages = sample_windows_of(docs, label, sample_docs, sample_windows)
    return train(windows, labels, languages) if languages else None


def has_letter(text: Column) -> Column:
    return F.coalesce(text.cast("string").rlike(r"\p{L}"), F.lit(False))


def _predict(texts: pa.Array, network: Network) -> tuple[np.ndarray, np.ndarray]:
    """The best language of each text and its probability."""
    texts = as_strings(texts)
    best, score = np.zeros(len(texts), np.int64), np.zeros(len(texts))
    for begin, end in row_blocks(texts):
        totals = np.zeros((end - begin, len(network.languages)))
        letters = np.zeros(end - begin)
        data, offsets = buffers(texts.slice(begin, end - begin))
        # a very long text comes alone, in parts that each hold whole windows
        step = LENGTH << 14
        for low in range(0, max(1, int(offsets[-1])) if end - begin == 1 else 1, step):
            if end - begin == 1:
                part = data[low : low + step + REACH - 1]
                stop = min(step, len(data) - low)
                windows, row = windows_of(part[: stop + REACH - 1], np.array([0, len(part)]))
                windows, row = windows[: -(-stop // LENGTH)], row[: -(-stop // LENGTH)]
            else:
                windows, row = windows_of(data, offsets)
            if not len(windows):
                continue
            weight = (windows[:, :LENGTH] != SPACE).sum(axis=1).astype(float)
            share = network.probabilities(windows) * weight[:, None]
            for k in range(share.shape[1]):
                totals[:, k] += np.bincount(row, share[:, k], end - begin)
            letters += np.bincount(row, weight, end - begin)
        best[begin:end] = totals.argmax(axis=1)
        score[begin:end] = totals.max(axis=1) / np.maximum(letters, 1)
    return best, np.clip(score, 0, 1)


def identify(docs: DataFrame, network: Network | None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, from the whole of each text."""
    rows = docs.drop("lang_pred", "score").withColumn("__letter", has_letter(F.col("text")))
    schema = rows.drop("__letter").schema.add("lang_pred", "string").add("score", "double")
    held = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letter = np.asarray(batch.column("__letter").to_numpy(zero_copy_only=False))
            if held.value is None:
                letter = np.zeros(len(batch), bool)
                best, score = np.zeros(len(batch), np.int64), np.zeros(len(batch))
                names = np.array([UNKNOWN], object)
            else:
                best, score = _predict(batch.column("text").cast(pa.string()), held.value)
                names = np.array(held.value.languages, object)
            columns = [batch.column(k) for k in range(batch.num_columns) if batch.schema.names[k] != "__letter"]
            columns += [
                pa.array(np.where(letter, names[best], UNKNOWN), pa.string()),
                pa.array(np.where(letter, score, 0.0)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from: a fourth, by the checksum of the id."""
    fold = F.pmod(F.crc32(F.encode(doc_id.cast("string"), "utf-8")), F.lit(4))
    return F.coalesce(fold == 2, F.lit(False))


def learnable(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))


def language_filter(docs: DataFrame, least_score: float = 0.3) -> DataFrame:
    """``docs`` without texts that are in no known language: none at all, or all about alike."""
    found = identify(docs, fit(learnable(docs)))
    clean = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score)
    return found.where(clean).select(*[c for c in docs.columns if c not in ("lang_pred", "score")])
