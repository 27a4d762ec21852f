"""Language identification with a byte convolutional network, trained here in numpy.

A text is cut into windows of fixed length that cover it whole. In each window byte pairs
and bytes are looked up, filters of several widths slide over them, the greatest response
of a filter is kept, and a softmax layer turns the responses into languages. The windows'
log-probabilities are averaged by length.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.llm.tables import clear_name, least_hashed_of_each, quoted
from shardloom.llm.text import encoded
from shardloom.session import attach

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
EMBEDDING = 8
# The training sample: so many documents of each label at most, by a hash of the id, and of all
# labels together so many; but a label always has some. Of each document so many windows.
# Held-out documents are never among them.
SAMPLE_DOCUMENTS = 2_000
SAMPLE_IN_ALL = 16_000
SAMPLE_OF_EACH = 20
SAMPLE_WINDOWS = 4
STEPS = 600
BATCH = 64
SEED = 7
UNKNOWN = "und"
# Windows that are worked off at once.
BLOCK = 512

_WORD = re.compile(r"[^\W\d_]")


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 on division by 4; a null id is not held out."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def _has_letter(text: str) -> bool:
    """Whether a character is of one of the letter categories; number signs and marks are not."""
    return any(found[0].isalpha() for found in _WORD.finditer(text))


class ByteNet:
    """Embedding, filters of several widths, max pooling, softmax; byte 0 pads."""

    def __init__(self, labels: Sequence[str], seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.labels = list(labels)
        self.embedding = rng.normal(0, 0.3, (256, EMBEDDING)).astype(np.float32)
        self.filters = [
            rng.normal(0, 1 / np.sqrt(w * EMBEDDING), (w, EMBEDDING, FILTERS)).astype(np.float32)
            for w in WIDTHS
        ]
        self.bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        pooled = FILTERS * len(WIDTHS)
        self.out = rng.normal(0, 0.1, (pooled, len(self.labels))).astype(np.float32)
        self.out_bias = np.zeros(len(self.labels), np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, *self.bias, self.out, self.out_bias]

    def fit(self, windows: np.ndarray, target: np.ndarray, steps: int = STEPS, seed: int = SEED):
        """Adam on the cross entropy of balanced batches."""
        rng = np.random.default_rng(seed)
        by_label = [np.flatnonzero(target == k) for k in range(len(self.labels))]
        by_label = [rows for rows in by_label if len(rows)]
        first = [np.zeros_like(p) for p in self.parameters()]
        second = [np.zeros_like(p) for p in self.parameters()]
        for step in range(1, steps + 1):
            rows = np.concatenate(
                [rng.choice(of, max(1, BATCH // len(by_label))) for of in by_label]
            )
            rate = 0.01 * (1 - step / (steps + 1))
            gradients = self._gradients(windows[rows], target[rows])
            for p, g, m, v in zip(self.parameters(), gradients, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
        return self

    def _gradients(self, windows: np.ndarray, target: np.ndarray) -> list[np.ndarray]:
        n = len(windows)
        x = self.embedding[windows]
        pooled, peaks = [], []
        for filters, bias in zip(self.filters, self.bias, strict=True):
            width = len(filters)
            span = WINDOW - width + 1
            response = sum(x[:, k : k + span] @ filters[k] for k in range(width)) + bias
            peak = response.argmax(axis=1)
            peaks.append(peak)
            pooled.append(np.maximum(np.take_along_axis(response, peak[:, None], 1)[:, 0], 0))
        hidden = np.concatenate(pooled, axis=1)
        error = np.exp(_log_softmax(hidden @ self.out + self.out_bias))
        error[np.arange(n), target] -= 1
        error /= n
        back = (error @ self.out.T) * (hidden > 0)
        embedding = np.zeros_like(self.embedding)
        filter_gradients, bias_gradients = [], []
        for i, (filters, peak) in enumerate(zip(self.filters, peaks, strict=True)):
            part = back[:, i * FILTERS : (i + 1) * FILTERS]
            gradient = np.zeros_like(filters)
            for k in range(len(filters)):
                at = windows[np.arange(n)[:, None], peak + k]
                gradient[k] = np.einsum("nfe,nf->ef", self.embedding[at], part)
                np.add.at(embedding, at, part[:, :, None] * filters[k].T[None])
            filter_gradients.append(gradient)
            bias_gradients.append(part.sum(axis=0))
        return [embedding, *filter_gradients, *bias_gradients, hidden.T @ error, error.sum(axis=0)]

    def tables(self) -> list[list[np.ndarray]]:
        """Filters as lookups: a table per byte pair, and one per byte for an odd width."""
        each = []
        for filters in self.filters:
            single = [self.embedding @ f for f in filters]
            steps = []
            for k in range(0, len(filters) - 1, 2):
                steps.append((single[k][:, None] + single[k + 1][None]).reshape(65536, FILTERS))
            if len(filters) % 2:
                steps.append(single[-1])
            each.append(steps)
        return each

    def log_probabilities(self, windows: np.ndarray, tables=None) -> np.ndarray:
        """For each window, the log-probability of every label."""
        tables = tables or self.tables()
        found = np.empty((len(windows), len(self.labels)), np.float32)
        for lo in range(0, len(windows), BLOCK):
            block = windows[lo : lo + BLOCK].astype(np.intp)
            pairs = block[:, :-1] * 256 + block[:, 1:]
            pooled = []
            for steps, width, bias in zip(tables, WIDTHS, self.bias, strict=True):
                span = WINDOW - width + 1
                response = steps[0][pairs[:, :span]]
                for k, table in enumerate(steps[1:], 1):
                    source = pairs if len(table) > 256 else block
                    response += table[source[:, 2 * k : 2 * k + span]]
                while response.shape[1] > 1:  # halves, as numpy is slow over a short last axis
                    half = response.shape[1] // 2
                    top = np.maximum(response[:, :half], response[:, half : 2 * half])
                    if response.shape[1] % 2:
                        np.maximum(top[:, 0], response[:, -1], out=top[:, 0])
                    response = top
                pooled.append(np.maximum(response[:, 0] + bias, 0))
            found[lo : lo + BLOCK] = _log_softmax(
                np.concatenate(pooled, axis=1) @ self.out + self.out_bias
            )
        return found


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def windows_of(text: bytes) -> np.ndarray:
    """The whole text as rows of ``WINDOW`` bytes, the last one padded with zeros."""
    rows = max(1, -(-len(text) // WINDOW))
    padded = np.zeros(rows * WINDOW, np.uint8)
    padded[: len(text)] = np.frombuffer(text, np.uint8)
    return padded.reshape(rows, WINDOW)


def train(
    docs: DataFrame,
    label_col: str = "lang",
    text_col: str = "text",
    id_col: str = "doc_id",
    sample: int = SAMPLE_DOCUMENTS,
    steps: int = STEPS,
    seed: int = SEED,
) -> ByteNet | None:
    """A network fitted on at most ``sample`` documents of each label that are not held out.

    Every label with such a document is learnt, however rare. With many labels each has less:
    ``SAMPLE_IN_ALL`` documents are shared out, but not below ``SAMPLE_OF_EACH``. The sample
    is the least of each label by a hash of id and text; only it comes to the driver, and of
    each text ``SAMPLE_WINDOWS`` windows spread over its whole length: some 16 MB, or 20 KB a
    label if there are over 800 labels. Without a labelled text the result is None.
    """
    labelled = docs.filter(
        ~held_out(quoted(id_col)) & quoted(label_col).isNotNull() & (F.octet_length(quoted(text_col)) > 0)
    ).select(quoted(label_col).alias("label"), quoted(text_col).alias("text"), quoted(id_col).alias("id"))
    step = F.greatest(F.floor(F.length("text") / SAMPLE_WINDOWS), F.lit(1)).cast("int")
    pieces = F.array(*[
        F.substring(F.col("text"), step * k + 1, F.lit(WINDOW)) for k in range(SAMPLE_WINDOWS)
    ])
    drawn = labelled.select("label", pieces.alias("pieces"), F.xxhash64("id", "text", F.lit(seed)).alias("at"))
    n_labels = docs.filter(~held_out(quoted(id_col)) & quoted(label_col).isNotNull()).agg(
        F.count_distinct(quoted(label_col))
    ).first()[0]
    share = min(sample, max(SAMPLE_OF_EACH, SAMPLE_IN_ALL // max(n_labels, 1)))
    rows = least_hashed_of_each(drawn, "label", "at", share).select("label", "pieces").collect()
    if not rows:
        return None
    labels = sorted({row.label for row in rows})
    parts = [(labels.index(row.label), p.encode()) for row in rows for p in row.pieces if p]
    parts = [(label, piece[:WINDOW]) for label, piece in parts]
    windows = np.concatenate([windows_of(piece) for _, piece in parts])
    return ByteNet(labels, seed).fit(windows, np.array([label for label, _ in parts]), steps)


def predictions(text: Column, net: ByteNet | None) -> Column:
    """Struct ``(lang_pred, score)`` of a whole text."""

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def predict(column: pa.Array) -> pa.Array:
        texts = encoded(column)
        lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if net is not None:
            tables = _tables_of(net)
            for i, mean in _means(texts, net, tables):
                best = int(mean.argmax())
                lang[i], score[i] = net.labels[best], float(np.exp(mean[best]))
        return pa.StructArray.from_arrays(
            [pa.array(lang, pa.string()), pa.array(np.clip(score, 0, 1))], ["lang_pred", "score"]
        )

    return predict(text)


_cache: dict[bytes, list[list[np.ndarray]]] = {}


def _tables_of(net: ByteNet) -> list[list[np.ndarray]]:
    key = b"".join(p.tobytes() for p in net.parameters())
    if key not in _cache:
        _cache.clear()
        _cache[key] = net.tables()
    return _cache[key]


def _means(texts: list[bytes], net: ByteNet, tables):
    """``(i, label log-probabilities)`` of the texts with a letter, renormalised after averaging."""
    pending, size = [], 0
    for i, text in enumerate(texts):
        if not _has_letter(text.decode("utf-8", "replace")):
            continue
        pending.append(i)
        size += len(text) + WINDOW
        if size > 1 << 20:
            yield from _averaged(pending, texts, net, tables)
            pending, size = [], 0
    if pending:
        yield from _averaged(pending, texts, net, tables)


def _averaged(rows: list[int], texts: list[bytes], net: ByteNet, tables):
    windows = [windows_of(texts[i]) for i in rows]
    counts = np.array([len(w) for w in windows])
    found = net.log_probabilities(np.concatenate(windows), tables)
    starts = np.cumsum(counts) - counts
    weight = np.full(len(found), float(WINDOW))
    lengths = np.array([len(texts[i]) for i in rows])
    weight[starts + counts - 1] = lengths - (counts - 1) * WINDOW
    means = np.add.reduceat(found * weight[:, None], starts, axis=0) / lengths[:, None]
    yield from zip(rows, _log_softmax(means), strict=True)


def identify(
    docs: DataFrame,
    net: ByteNet | None,
    text_col: str = "text",
    id_col: str = "doc_id",
) -> DataFrame:
    """All columns of ``docs`` and ``held_out, lang_pred, score``.

    The prediction sees the text alone. A null text, or one without a letter, is ``und``
    with score 0, and so is every text if there was nothing to learn from. Columns of
    ``docs`` named like a new one are replaced.
    """
    attach(docs.sparkSession)
    made = {"held_out", "lang_pred", "score"}
    own = [quoted(c) for c in docs.columns if c.lower() not in made]
    both = clear_name(docs, "_prediction")
    found = docs.select(
        *own, held_out(quoted(id_col)).alias("held_out"), predictions(quoted(text_col), net).alias(both)
    )
    return found.select(
        *own, "held_out", F.col(f"{both}.lang_pred").alias("lang_pred"), F.col(f"{both}.score").alias("score")
    )
