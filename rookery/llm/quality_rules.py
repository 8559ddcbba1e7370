"""Base rules and a hashed n-gram logistic regression against fixed thresholds."""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rookery.llm.labelled import FIT_BYTES, FIT_ROWS, fitted, labelled_sample
from rookery.llm.rows import Packed, give_back, mixed, slabs, text_bytes

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
KEEP_AT = 0.5
SYMBOLS = b"#*$%&|<>"
BUCKETS = 1 << 16
# Hashed features: words, word pairs, four characters.
FAMILIES, CHARACTERS = 3, 4
_SCALE = 32.0
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
_FIRST_BYTE = (np.arange(256) & 0xC0) != 0x80
_SPREAD = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
_PAIR = np.uint64(0x9E3779B97F4A7C15)


class Words:
    """Words of a slab of texts: hashes, the text of each, and counts per text."""

    def __init__(self, raw: np.ndarray, at: np.ndarray) -> None:
        self.raw, self.at = raw, at
        space = _SPACE[raw]
        edge = np.ones(len(raw), bool)
        edge[1:] = space[:-1]
        edge[at[:-1][at[:-1] < len(raw)]] = True
        starts = np.flatnonzero(edge & ~space)
        self.of_text = np.searchsorted(at, starts, side="right") - 1
        n = len(at) - 1
        self.count = np.bincount(self.of_text, minlength=n)
        self.first = np.concatenate(([0], np.cumsum(self.count)))
        if len(starts):
            # A word is a polynomial of its bytes; what follows it up to the next word adds nothing.
            place = np.arange(len(raw)) - np.repeat(np.append(0, starts), np.diff(np.concatenate(([0], starts, [len(raw)]))))
            power = _powers(int(place.max(initial=0)) + 1)[place]
            power *= _SPREAD[raw]
            power[space] = 0
            self.hash = mixed(np.add.reduceat(power, starts))
        else:
            self.hash = np.empty(0, np.uint64)

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return total[self.at[1:]] - total[self.at[:-1]]

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash and first word of each run of ``size`` words inside one text."""
        if len(self.hash) < size:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        last = len(self.hash) - size + 1
        first = np.flatnonzero(self.of_text[:last] == self.of_text[size - 1 :])
        h = self.hash[first]
        for j in range(1, size):
            h = mixed(h * _PAIR + self.hash[first + j])
        return h, first


def _powers(n: int, _made: list[np.ndarray] = []) -> np.ndarray:  # noqa: B006  (kept between calls)
    if not _made or len(_made[0]) < n:
        size = max(4096, 1 << (n - 1).bit_length())
        _made[:] = [np.cumprod(np.full(size, 0xD6E8FEB86659FD93, np.uint64))]
    return _made[0]


def base_counts(words: Words) -> dict[str, np.ndarray]:
    n = len(words.at) - 1
    raw = words.raw
    h, first = words.windows(3)
    key = h ^ mixed(words.of_text[first].astype(np.uint64) + np.uint64(1))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(len(key), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    repeated = np.zeros(len(words.hash) + 2, bool)
    for j in range(3):
        repeated[first[again] + j] = True
    lines = np.zeros(n, np.int64)
    data = raw.tobytes()
    for i, (a, b) in enumerate(zip(words.at[:-1].tolist(), words.at[1:].tolist())):
        own = [x for x in data[a:b].split(b"\n") if x.strip()]
        lines[i] = len(own) - len(set(own))
    return {
        "n_words": words.count.astype(np.int64),
        "word_chars": words.per_text(_FIRST_BYTE[raw] & ~_SPACE[raw]),
        "n_symbols": words.per_text(_SYMBOL[raw]),
        "n_dup_lines": lines,
        "n_repeat_words": np.bincount(words.of_text[repeated[: len(words.hash)]], minlength=n).astype(np.int64),
    }


def _features(words: Words) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Family, buckets, and where each text's buckets begin and end."""
    mask = np.uint64(BUCKETS - 1)
    yield 0, (words.hash & mask).astype(np.int64), words.first
    h, first = words.windows(2)
    yield 1, (h & mask).astype(np.int64), np.searchsorted(first, words.first)
    # Characters are code points: a letter with an accent is one, whatever its bytes.
    points = np.frombuffer(words.raw.tobytes().decode().encode("utf-32-le"), np.uint32)
    at = np.concatenate(([0], np.cumsum(_FIRST_BYTE[words.raw])))[words.at]
    if len(points) >= CHARACTERS:
        gram = np.zeros(len(points) - CHARACTERS + 1, np.uint32)
        for i in range(CHARACTERS):
            gram = (gram ^ points[i : len(points) - CHARACTERS + 1 + i]) * np.uint32(0x9E3779B1)
            gram ^= gram >> np.uint32(15)
        inside = np.ones(len(gram), bool)
        for back in range(1, CHARACTERS):
            edge = at[1:-1] - back
            inside[edge[(edge >= 0) & (edge < len(gram))]] = False
        places = np.flatnonzero(inside)
        yield 2, (gram[places] & np.uint32(BUCKETS - 1)).astype(np.int64), np.searchsorted(places, at)
    else:
        yield 2, np.empty(0, np.int64), np.zeros(len(at), np.int64)


def _slab(texts: list[bytes]) -> Words:
    at = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    return Words(np.frombuffer(b"".join(texts), np.uint8), at)


def logits(words: Words, weights: np.ndarray, bias: float) -> np.ndarray:
    """Bias and, for each family, the mean weight of a text's features."""
    out = np.full(len(words.at) - 1, bias)
    for family, buckets, at in _features(words):
        total = np.concatenate(([0.0], np.cumsum(weights[family][buckets], dtype=np.float64)))
        count = at[1:] - at[:-1]
        out += _SCALE * (total[at[1:]] - total[at[:-1]]) / np.maximum(count, 1)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(texts: list[bytes], labels: list[int], epochs: int = 12, seed: int = 7) -> bytes:
    """Weights, bias and calibration; a quarter of the rows is kept for the calibration alone."""
    y = np.array(labels, float)
    weights, bias, slope, shift = np.zeros((FAMILIES, BUCKETS)), 0.0, 1.0, 0.0
    if len(set(labels)) == 2:
        held = np.arange(len(y)) % 4 == 3
        train = np.flatnonzero(~held)
        rng = np.random.default_rng(seed)
        rows = [_sparse([texts[i]]) for i in train]
        flat = weights.reshape(-1)
        m, v, t = np.zeros_like(flat), np.zeros_like(flat), 0
        bias = float(np.log(max(y[train].mean(), 1e-3) / max(1 - y[train].mean(), 1e-3)))
        for epoch in range(epochs):
            order = rng.permutation(len(train))
            for some in np.array_split(order, max(1, len(order) // 64)):
                index = np.concatenate([rows[i][0] for i in some])
                value = np.concatenate([rows[i][1] for i in some])
                owner = np.repeat(np.arange(len(some)), [len(rows[i][0]) for i in some])
                score = bias + np.bincount(owner, value * flat[index], len(some))
                error = (_sigmoid(score) - y[train[some]]) / len(some)
                gradient = np.bincount(index, value * error[owner], len(flat)) + 1e-6 * flat
                t += 1
                m = 0.9 * m + 0.1 * gradient
                v = 0.99 * v + 0.01 * gradient**2
                flat -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
                bias -= 0.05 * float(error.sum())
        score = np.concatenate([logits(_slab([texts[i]]), weights, bias) for i in np.flatnonzero(held)])
        slope, shift = _calibrated(score, y[held])
    out = io.BytesIO()
    np.savez(out, weights=weights.astype(np.float32), numbers=np.array([bias, slope, shift]))
    return out.getvalue()


def _sparse(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    index, value = [], []
    for family, buckets, _ in _features(_slab(texts)):
        own, count = np.unique(buckets, return_counts=True)
        index.append(own + family * BUCKETS)
        value.append(_SCALE * count / max(1, len(buckets)))
    return np.concatenate(index), np.concatenate(value)


def _calibrated(score: np.ndarray, y: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """Platt scaling by damped Newton steps, with smoothed targets and standardised scores."""
    ones, zeros = y.sum(), len(y) - y.sum()
    if not ones or not zeros:
        return 1.0, 0.0
    middle, width = float(np.median(score)), float(score.std()) or 1.0
    target = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    x = np.stack([(score - middle) / width, np.ones_like(score)], axis=1)

    def loss(theta: np.ndarray) -> float:
        z = x @ theta
        return float((np.logaddexp(0, z) - target * z).sum() + 0.05 * (theta**2).sum())

    theta = np.zeros(2)
    for _ in range(steps):
        p = _sigmoid(x @ theta)
        gradient = x.T @ (p - target) + 0.1 * theta
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2)
        move, now = np.linalg.solve(hessian, gradient), loss(theta)
        size = 1.0
        while size > 1e-6 and loss(theta - size * move) > now:
            size /= 2
        theta = theta - size * move
        if np.abs(size * move).max() < 1e-9:
            break
    slope = float(theta[0]) / width
    return slope, float(theta[1]) - slope * middle


class Model:
    def __init__(self, raw: bytes) -> None:
        held = np.load(io.BytesIO(raw))
        self.weights = held["weights"].astype(np.float64)
        self.bias, self.slope, self.shift = held["numbers"].tolist()

    def probability(self, words: Words) -> np.ndarray:
        return _sigmoid(self.slope * logits(words, self.weights, self.bias) + self.shift)


_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _checked(texts: pa.Array, model: Model, keep_at: float) -> pa.StructArray:
    raw, at = text_bytes(texts)
    parts = []
    for first, last in slabs(at, 256 << 10):
        words = Words(raw[at[first] : at[last]], at[first : last + 1] - at[first])
        own = base_counts(words)
        failed = (own["n_words"] < MIN_WORDS) | (
            100 * own["n_repeat_words"] > MAX_REPEATED_PERCENT * own["n_words"]
        )
        p = model.probability(words)
        parts.append([*(own[c] for c in _COUNTS), failed, p, ~failed & (p >= keep_at)])
    columns = [np.concatenate(x) for x in zip(*parts)] if parts else [np.empty(0, np.int64)] * 5 + [
        np.empty(0, bool), np.empty(0), np.empty(0, bool)
    ]
    return pa.StructArray.from_arrays(
        [pa.array(c) for c in columns], names=[*_COUNTS, "base_failed", "probability", "kept"]
    )


_VERDICT = "struct<" + ",".join(f"{c}:long" for c in _COUNTS) + ",base_failed:boolean,probability:double,kept:boolean>"


def with_verdicts(packed: Packed, model: bytes, keep_at: float = KEEP_AT) -> DataFrame:
    """The frame of a ``Packed`` with a struct ``verdict`` per row; one pass over the texts, no shuffle."""
    held: list[Model] = []

    def check(texts: pa.Array) -> pa.Array:
        if not held:
            held.append(Model(model))
        verdicts = _checked(texts, held[0], keep_at)
        give_back()
        return verdicts

    return packed.frame.withColumn("verdict", F.arrow_udf(check, _VERDICT)("text"))


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    rows: int = FIT_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
    most_bytes: int = FIT_BYTES,
) -> bytes:
    """The model of ``labels.quality``, on about ``rows`` labelled texts of up to ``most_bytes``."""
    sample = labelled_sample(docs, labels, "quality", None, rows, most_bytes, id_col, text_col)
    return fitted(sample, fit)


def quality_verdicts(
    docs: DataFrame,
    model: bytes,
    keep_at: float = KEEP_AT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, probability)``.

    ``kept`` is false where a base rule fails (fewer than 50 words, or more than half of the words in
    three-word windows that the text repeats), else whether the calibrated probability reaches
    ``keep_at``. Null and empty texts have no word and fail. Repeated rows get the same verdict; no
    rows give no rows; other columns, labels among them, are no input.
    """
    frame = with_verdicts(Packed(docs, id_col, text_col), model, keep_at)
    return frame.select("id", "verdict.*").select(
        "id", *_COUNTS, "base_failed", "kept", "probability"
    )


def keep_good(
    docs: DataFrame, model: bytes, keep_at: float = KEEP_AT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns unchanged."""
    packed = Packed(docs, id_col, text_col)
    return packed.unpack(with_verdicts(packed, model, keep_at).filter("verdict.kept"))
