"""A byte-level convolutional network in numpy that scores whole documents."""

from __future__ import annotations

import io
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rookery.llm.labelled import FIT_BYTES, FIT_ROWS, fitted, labelled_sample
from rookery.llm.rows import Packed, slabs, text_bytes

# Bytes of a chunk and between the first bytes of two chunks, bytes under a filter and between two places.
CHUNK, STEP = 1024, 896
WIDTH, STRIDE = 8, 4
EMBED, FILTERS = 8, 32
PREDICT_AT = 0.7
HELD_OUT = 2
_FRAMES = (CHUNK - WIDTH) // STRIDE + 1


@dataclass
class Net:
    embed: np.ndarray  # 257 x EMBED; 256 stands for what lies behind the text
    filters: np.ndarray  # WIDTH * EMBED x FILTERS
    shift: np.ndarray
    out: np.ndarray  # weights of the mean and of the highest value over chunks, for each filter
    bias: np.ndarray

    def dump(self) -> bytes:
        raw = io.BytesIO()
        np.savez(raw, **{f.name: getattr(self, f.name) for f in fields(self)})
        return raw.getvalue()

    @classmethod
    def load(cls, raw: bytes) -> Net:
        held = np.load(io.BytesIO(raw))
        return cls(**{f.name: held[f.name] for f in fields(cls)})


def fresh(seed: int = 11) -> Net:
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 0.5, (257, EMBED)).astype(np.float32)
    embed[256] = 0
    return Net(
        embed,
        rng.normal(0, 1 / np.sqrt(WIDTH * EMBED), (WIDTH * EMBED, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32),
        np.zeros(2 * FILTERS, np.float32),
        np.zeros(1, np.float32),
    )


def chunk_starts(size: int) -> np.ndarray:
    """Chunks overlap and together cover every byte; an empty text has one chunk of padding."""
    return np.arange(0, max(1, size - CHUNK + STEP), STEP) if size > CHUNK else np.zeros(1, np.int64)


def _chunks(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte values of all chunks of the texts, padded, and the text of each chunk."""
    starts = [chunk_starts(int(n)) for n in np.diff(at)]
    owner = np.repeat(np.arange(len(starts)), [len(s) for s in starts])
    begin = np.concatenate(starts) + at[:-1][owner]
    length = np.minimum(begin + CHUNK, at[1:][owner]) - begin
    out = np.full((len(owner), CHUNK), 256, np.int16)
    for i, (b, n) in enumerate(zip(begin.tolist(), length.tolist())):
        out[i, :n] = raw[b : b + n]
    return out, owner


def _frames(net: Net, chunks: np.ndarray) -> np.ndarray:
    """The embedded bytes under a filter, for each place of each chunk."""
    embedded = net.embed[chunks].reshape(len(chunks), CHUNK * EMBED)
    own, item = embedded.strides
    view = np.lib.stride_tricks.as_strided(
        embedded, (len(chunks), _FRAMES, WIDTH * EMBED), (own, STRIDE * EMBED * item, item), writeable=False
    )
    return np.ascontiguousarray(view).reshape(-1, WIDTH * EMBED)


def pooled(net: Net, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Highest filter values of each chunk, where they are, and the frames."""
    frames = _frames(net, chunks)
    values = (frames @ net.filters).reshape(len(chunks), _FRAMES, FILTERS)
    best = values.argmax(axis=1)
    top = np.take_along_axis(values, best[:, None, :], axis=1)[:, 0, :] + net.shift
    return np.maximum(top, 0), best, frames


def _combined(top: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and highest chunk value for each text and filter."""
    first = np.searchsorted(owner, np.arange(n))
    count = np.diff(np.append(first, len(owner)))[:, None]
    return np.add.reduceat(top, first, axis=0) / count, np.maximum.reduceat(top, first, axis=0)


def scores(net: Net, raw: np.ndarray, at: np.ndarray, most_chunks: int = 64) -> np.ndarray:
    """The probability of label 1 for each text; chunks pass in groups.

    Groups are filled up to one size and rows are summed one by one, as products of matrices round a row
    by the shape it stands in: a text has the same score whatever texts are beside it.
    """
    n = len(at) - 1
    if not n:
        return np.empty(0)
    chunks, owner = _chunks(raw, at)
    full = np.concatenate((chunks, np.repeat(chunks[:1], -len(chunks) % most_chunks, axis=0)))
    top = np.concatenate([_top(net, full[i : i + most_chunks]) for i in range(0, len(full), most_chunks)])
    mean, high = _combined(top[: len(chunks)], owner, n)
    z = (mean * net.out[:FILTERS]).sum(axis=1) + (high * net.out[FILTERS:]).sum(axis=1) + net.bias[0]
    return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -40, 40)))


def _top(net: Net, chunks: np.ndarray) -> np.ndarray:
    values = (_frames(net, chunks) @ net.filters).reshape(len(chunks), _FRAMES, FILTERS)
    return np.maximum(values.max(axis=1) + net.shift, 0)


def fit(
    texts: list[bytes], labels: list[int], epochs: int = 12, batch: int = 16, rate: float = 0.01, seed: int = 11
) -> bytes:
    """Adam on the log loss; the gradient of a maximum goes to the place that has it."""
    net = fresh(seed)
    y = np.array(labels, np.float32)
    if len(set(labels)) < 2:
        net.bias[:] = 0 if not labels else (4.0 if labels[0] else -4.0)
        return net.dump()
    share = float(y.mean())
    net.bias[:] = np.log(share / (1 - share))
    rng = np.random.default_rng(seed)
    net.out[:] = rng.normal(0, 0.05, 2 * FILTERS)
    names = [f.name for f in fields(Net)]
    m = {k: np.zeros_like(getattr(net, k)) for k in names}
    v = {k: np.zeros_like(getattr(net, k)) for k in names}
    step, total = 0, epochs * -(-len(texts) // batch)
    for _ in range(epochs):
        for some in np.array_split(rng.permutation(len(texts)), -(-len(texts) // batch)):
            step += 1
            gradients = _gradients(net, [texts[i] for i in some], y[some])
            now = rate * (1 - step / (total + 1))
            for k in names:
                g = gradients[k]
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                move = m[k] / (1 - 0.9**step) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-7)
                getattr(net, k)[...] -= (now * move).astype(np.float32)
            net.embed[256] = 0
    return net.dump()


def _gradients(net: Net, texts: list[bytes], y: np.ndarray) -> dict[str, np.ndarray]:
    at = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    chunks, owner = _chunks(np.frombuffer(b"".join(texts), np.uint8), at)
    top, best, frames = pooled(net, chunks)
    n = len(texts)
    mean, high = _combined(top, owner, n)
    z = mean @ net.out[:FILTERS] + high @ net.out[FILTERS:] + net.bias[0]
    error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / n
    out = np.concatenate([error @ mean, error @ high])
    count = np.bincount(owner, minlength=n)
    d_top = (error / count)[owner][:, None] * net.out[:FILTERS]
    ties = top == high[owner]
    shared = np.maximum(np.add.reduceat(ties, np.searchsorted(owner, np.arange(n)), axis=0), 1)
    d_top = d_top + ties / shared[owner] * error[owner][:, None] * net.out[FILTERS:]
    d_top = d_top * (top > 0)
    place = (np.arange(len(chunks))[:, None] * _FRAMES + best).ravel()
    used = frames[place].reshape(len(chunks), FILTERS, WIDTH * EMBED)
    filters = np.einsum("cf,cfw->wf", d_top, used)
    d_used = d_top[:, :, None] * net.filters.T[None]
    byte = best[:, :, None] * STRIDE + np.arange(WIDTH)
    seen = chunks[np.arange(len(chunks))[:, None, None], byte].ravel()
    d_used = d_used.reshape(-1, EMBED)
    embed = np.stack([np.bincount(seen, d_used[:, e], 257) for e in range(EMBED)], axis=1)
    return {
        "embed": embed.astype(np.float32),
        "filters": filters.astype(np.float32),
        "shift": d_top.sum(axis=0).astype(np.float32),
        "out": out.astype(np.float32),
        "bias": np.array([error.sum()], np.float32),
    }


def remainder(id_col: str = "id"):
    """crc32 of the id as text, mod 4; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    rows: int = FIT_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
    most_bytes: int = FIT_BYTES,
) -> bytes:
    """The network for ``labels.quality``, fitted on about ``rows`` texts whose ids are not held out.

    Texts over ``most_bytes`` are not fitted on; all are scored whole.
    """
    sample = labelled_sample(docs, labels, "quality", remainder() != HELD_OUT, rows, most_bytes, id_col, text_col)
    return fitted(sample, fit)


def quality_scores(
    docs: DataFrame, model: bytes, at: float = PREDICT_AT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id, held_out, score, predicted)`` for every row of ``docs``, in one pass without a shuffle.

    A whole text is cut into overlapping chunks of bytes. Each filter gives its highest value in a
    chunk; the mean and the highest of these over all chunks give one probability. Null texts
    count as empty, and an empty text is one chunk of padding. ``held_out`` is false for a null id.
    Repeated rows get the same score; no rows give no rows; only the text is an input of the score.
    """
    held: list[Net] = []

    def score(texts: pa.Array) -> pa.Array:
        if not held:
            held.append(Net.load(model))
        raw, offsets = text_bytes(texts)
        parts = [
            scores(held[0], raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            for a, b in slabs(offsets, 256 << 10)
        ]
        return pa.array(np.concatenate(parts) if parts else np.empty(0))

    frame = Packed(docs, id_col, text_col).frame.withColumn("score", F.arrow_udf(score, "double")("text"))
    return frame.select(
        "id",
        F.coalesce(remainder() == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= at).cast("int").alias("predicted"),
    )


__all__ = ["Net", "fit", "fit_quality", "quality_scores", "scores"]
