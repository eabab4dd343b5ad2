"""Toxicity scores from a bidirectional gated recurrent network with attention pooling.

A word's input is the sum of a vector for the word (hashed) and the mean of vectors for its
character grams (hashed), so that forms of a word never seen still resemble it. The network
reads windows of words in both directions, weighs its states by attention and scores each window;
windows overlap and cover the whole text. A document's score comes from its best window,
calibrated on training documents. Written and trained in NumPy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entiva.llm.common import ship
from entiva.llm.words import hashed, in_blocks, located

WORDS, GRAMS = 1 << 14, 1 << 14
INPUT, STATE, ATTENTION = 16, 12, 8
#: Words of a window and words from one window's start to the next one's: passages of up to 24
#: words stand whole in a window wherever they begin.
WIDTH, STRIDE = 48, 24
GRAM = 4

_lower = np.arange(256, dtype=np.uint32)
_lower[65:91] += 32
_lower[[9, 10, 11, 12, 13]] = 32


@dataclass
class Block:
    """Distinct words of some texts, their grams, and the windows of all texts."""

    words: np.ndarray  # bucket of each distinct word
    grams: np.ndarray  # buckets of all grams of the distinct words, word by word
    firsts: np.ndarray  # first gram of each distinct word
    windows: np.ndarray  # windows x WIDTH: distinct word, -1 beyond the end
    documents: np.ndarray  # first window of each text, and the end


def read(texts: list[bytes]) -> Block:
    """Every text has at least one window, an empty one if it has no words."""
    data = np.frombuffer(b"\n" + b"\n".join(texts) + b"\n" * GRAM, np.uint8)
    starts, ends, bounds = located(data, [b"", *texts])
    bounds = bounds[1 : len(texts) + 2]
    if len(starts):
        hashes = hashed(data, starts, ends)
        distinct, first, places = np.unique(hashes, return_index=True, return_inverse=True)
        lower = _lower[data]
        begin, length = starts[first] - 1, ends[first] - starts[first]
        counts = np.maximum(1, length + 2 - GRAM + 1)
        firsts = np.concatenate([[0], np.cumsum(counts)[:-1]])
        at = np.arange(counts.sum()) - np.repeat(firsts - begin, counts)
        grams = np.zeros(len(at), np.uint32)
        for k in range(GRAM):
            grams = grams * np.uint32(0x9E3779B1) + lower[at + k]
        grams ^= grams >> np.uint32(15)
        grams *= np.uint32(0x85EBCA77)
        grams = (grams >> np.uint32(18)).astype(np.int32)
        words = (distinct >> np.uint64(50)).astype(np.int32)
    else:
        words, grams, firsts = (np.zeros(0, np.int32) for _ in range(3))
        places = np.zeros(0, np.int64)
    sizes = np.diff(bounds)
    per_text = np.maximum(1, -(-(sizes - (WIDTH - STRIDE)) // STRIDE))
    documents = np.concatenate([[0], np.cumsum(per_text)])
    text_of = np.repeat(np.arange(len(texts)), per_text)
    number = np.arange(len(text_of)) - documents[text_of]
    at = bounds[text_of][:, None] + number[:, None] * STRIDE + np.arange(WIDTH)
    beyond = at >= bounds[text_of + 1][:, None]
    padded = np.append(places, -1)
    return Block(words, grams, firsts, padded[np.where(beyond, len(places), at)], documents)


def fresh(seed: int) -> dict[str, np.ndarray]:
    draw = np.random.default_rng(seed)

    def normal(*shape: int, scale: float) -> np.ndarray:
        return (draw.standard_normal(shape) * scale).astype(np.float32)

    p = {"words": normal(WORDS, INPUT, scale=0.1), "grams": normal(GRAMS, INPUT, scale=0.3)}
    for d in "fb":
        p[f"w{d}"] = normal(INPUT, 3 * STATE, scale=INPUT**-0.5)
        p[f"u{d}"] = normal(STATE, 3 * STATE, scale=STATE**-0.5)
        p[f"c{d}"] = np.zeros(3 * STATE, np.float32)
    p["a"] = normal(2 * STATE, ATTENTION, scale=0.3)
    p["v"] = normal(ATTENTION, scale=0.3)
    p["o"] = normal(2 * STATE, scale=0.3)
    p["bias"] = np.zeros(1, np.float32)
    return p


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def inputs(p: dict[str, np.ndarray], block: Block) -> np.ndarray:
    """Input vector of each distinct word, and a last one of zeros for the padding."""
    vectors = np.zeros((len(block.words) + 1, INPUT), np.float32)
    if len(block.words):
        sums = np.add.reduceat(p["grams"][block.grams], block.firsts, axis=0)
        counts = np.diff(np.append(block.firsts, len(block.grams)))[:, None]
        vectors[:-1] = p["words"][block.words] + sums / counts.astype(np.float32)
    return vectors


def forward(
    p: dict[str, np.ndarray], vectors: np.ndarray, windows: np.ndarray, keep: list | None = None
) -> np.ndarray:
    """Logit of each window; with ``keep``, what the backward pass needs is appended to it."""
    n = len(windows)
    steps = windows.T
    mask = (steps >= 0).astype(np.float32)[:, :, None]
    states = np.zeros((WIDTH, n, 2 * STATE), np.float32)
    traces = []
    for i, d in enumerate("fb"):
        projected = vectors @ p[f"w{d}"] + p[f"c{d}"]
        h = np.zeros((n, STATE), np.float32)
        trace = []
        for t in range(WIDTH) if d == "f" else range(WIDTH - 1, -1, -1):
            x = projected[steps[t]]
            r = h @ p[f"u{d}"]
            gates = 1 / (1 + np.exp(-(x[:, : 2 * STATE] + r[:, : 2 * STATE])))
            z, reset = gates[:, :STATE], gates[:, STATE:]
            new = np.tanh(x[:, 2 * STATE :] + reset * r[:, 2 * STATE :])
            if keep is not None:
                trace.append((t, h, z, reset, new, r[:, 2 * STATE :]))
            h = h + mask[t] * (1 - z) * (new - h)
            states[t, :, i * STATE : (i + 1) * STATE] = h
        traces.append(trace)
    hidden = np.tanh(states @ p["a"])
    energy = hidden @ p["v"] + (mask[:, :, 0] - 1) * 30
    attention = np.exp(energy - energy.max(0))
    attention /= attention.sum(0)
    pooled = np.einsum("tn,tns->ns", attention, states)
    if keep is not None:
        keep.extend([steps, mask, states, traces, hidden, attention, pooled])
    return pooled @ p["o"] + p["bias"][0]


def backward(
    p: dict[str, np.ndarray], vectors: np.ndarray, kept: list, slope: np.ndarray
) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Gradients of the parameters and of the input vectors, given those of the logits."""
    steps, mask, states, traces, hidden, attention, pooled = kept
    g = {"o": slope @ pooled, "bias": np.array([slope.sum()], np.float32)}
    d_pooled = slope[:, None] * p["o"]
    d_states = attention[:, :, None] * d_pooled
    d_attention = np.einsum("tns,ns->tn", states, d_pooled)
    d_energy = attention * (d_attention - (attention * d_attention).sum(0))
    g["v"] = np.einsum("tn,tna->a", d_energy, hidden)
    d_hidden = d_energy[:, :, None] * p["v"] * (1 - hidden**2)
    g["a"] = np.einsum("tns,tna->sa", states, d_hidden)
    d_states += d_hidden @ p["a"].T
    d_vectors = np.zeros_like(vectors)
    for i, d in enumerate("fb"):
        u = p[f"u{d}"]
        d_projected = np.zeros((len(vectors), 3 * STATE), np.float32)
        g_u = np.zeros_like(u)
        d_h = np.zeros((len(slope), STATE), np.float32)
        for t, h, z, reset, new, inner in reversed(traces[i]):
            d_h = d_h + d_states[t, :, i * STATE : (i + 1) * STATE]
            m = mask[t] * d_h
            d_new = m * (1 - z) * (1 - new**2)
            d_z = m * (h - new) * z * (1 - z)
            d_reset = d_new * inner * reset * (1 - reset)
            d_x = np.concatenate([d_z, d_reset, d_new], 1)
            d_r = np.concatenate([d_z, d_reset, d_new * reset], 1)
            np.add.at(d_projected, steps[t], d_x)
            g_u += h.T @ d_r
            d_h = d_h - m * (1 - z) + d_r @ u.T
        g[f"u{d}"] = g_u
        g[f"c{d}"] = d_projected.sum(0)
        g[f"w{d}"] = vectors.T @ d_projected
        d_vectors += d_projected @ p[f"w{d}"].T
    return g, d_vectors


class Trainer:
    """Adam over the dense parameters; vectors of words and grams by their own squares."""

    def __init__(self, p: dict[str, np.ndarray], rate: float = 0.01):
        self.p, self.rate, self.turn = p, rate, 0
        self.first = {k: np.zeros_like(v) for k, v in p.items() if k not in ("words", "grams")}
        self.second = {k: np.zeros_like(v) for k, v in p.items()}

    def step(self, block: Block, windows: np.ndarray, labels: np.ndarray) -> None:
        used, places = np.unique(windows, return_inverse=True)
        pad = len(block.words)
        used = np.where(used < 0, pad, used)
        vectors = self.vectors[used]
        local = np.where(windows < 0, -1, places.reshape(windows.shape))
        kept: list = []
        logits = forward(self.p, np.vstack([vectors, np.zeros((1, INPUT), np.float32)]), local, kept)
        slope = ((sigmoid(logits) - labels) / len(labels)).astype(np.float32)
        wide = np.vstack([vectors, np.zeros((1, INPUT), np.float32)])
        g, d_vectors = backward(self.p, wide, kept, slope)
        self.turn += 1
        for k, grad in g.items():
            self.first[k] = 0.9 * self.first[k] + 0.1 * grad
            self.second[k] = 0.999 * self.second[k] + 0.001 * grad**2
            fit = self.first[k] / (1 - 0.9**self.turn)
            size = np.sqrt(self.second[k] / (1 - 0.999**self.turn)) + 1e-8
            self.p[k] -= (self.rate * fit / size).astype(np.float32)
        real = used < pad
        of, grad = used[real], d_vectors[:-1][real]
        self.adapt("words", block.words[of], grad)
        ends = np.append(block.firsts, len(block.grams))
        counts = ends[of + 1] - ends[of]
        at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts - ends[of], counts)
        self.adapt("grams", block.grams[at], np.repeat(grad / counts[:, None], counts, axis=0))

    def adapt(self, name: str, rows: np.ndarray, grad: np.ndarray) -> None:
        distinct, places = np.unique(rows, return_inverse=True)
        total = np.zeros((len(distinct), INPUT), np.float32)
        np.add.at(total, places, grad)
        self.second[name][distinct] += total**2
        step = 10 * self.rate * total / (np.sqrt(self.second[name][distinct]) + 1e-6)
        self.p[name][distinct] -= step.astype(np.float32)

    def refresh(self, block: Block) -> None:
        self.vectors = inputs(self.p, block)


@dataclass
class ToxicityModel:
    parameters: dict[str, np.ndarray]
    calibration: tuple[float, float, float]  # of the best logit, of log windows, constant


#: Windows that go through the network together.
TOGETHER = 2048


def window_logits(p: dict[str, np.ndarray], vectors: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Logits as ``forward`` gives them, without its traces: steps work in place."""
    inner = 2 * STATE
    projected = {}
    for d in "fb":
        both = vectors @ p[f"w{d}"] + p[f"c{d}"]
        projected[d] = both[:, :inner].copy(), both[:, inner:].copy()
    parts = []
    for i in range(0, len(windows), TOGETHER):
        steps = windows[i : i + TOGETHER].T
        absent = steps < 0
        places = np.where(absent, len(vectors) - 1, steps)
        padded = absent.any(1)
        states = np.empty((WIDTH, places.shape[1], inner), np.float32)
        for k, d in enumerate("fb"):
            _read(projected[d], p[f"u{d}"], places, absent, padded, k == 1,
                  states[:, :, k * STATE : (k + 1) * STATE])
        hidden = states @ p["a"]
        np.tanh(hidden, out=hidden)
        energy = hidden @ p["v"] + ((~absent).astype(np.float32) - 1) * 30
        attention = np.exp(energy - energy.max(0))
        attention /= attention.sum(0)
        parts.append(np.einsum("tn,tns->ns", attention, states) @ p["o"] + p["bias"][0])
    return np.concatenate(parts)


def _read(
    projected: tuple[np.ndarray, np.ndarray],
    u: np.ndarray,
    places: np.ndarray,
    absent: np.ndarray,
    padded: np.ndarray,
    backwards: bool,
    states: np.ndarray,
) -> None:
    """Fill ``states`` with those of one direction; beyond a text's end the state stays."""
    n = places.shape[1]
    h = np.zeros((n, STATE), np.float32)
    r = np.empty((n, 3 * STATE), np.float32)
    x, x_new = np.empty((n, 2 * STATE), np.float32), np.empty((n, STATE), np.float32)
    gates, new = np.empty_like(x), np.empty_like(x_new)
    for t in range(WIDTH - 1, -1, -1) if backwards else range(WIDTH):
        np.take(projected[0], places[t], axis=0, out=x, mode="clip")
        np.take(projected[1], places[t], axis=0, out=x_new, mode="clip")
        np.matmul(h, u, out=r)
        np.add(x, r[:, : 2 * STATE], out=gates)
        np.negative(gates, out=gates)
        np.exp(gates, out=gates)
        gates += 1
        np.reciprocal(gates, out=gates)
        np.multiply(r[:, 2 * STATE :], gates[:, STATE:], out=new)
        new += x_new
        np.tanh(new, out=new)
        new -= h
        new *= 1 - gates[:, :STATE]
        if padded[t]:
            new[absent[t]] = 0
        h += new
        states[t] = h


def learn(
    texts: list[bytes], labels: np.ndarray, share: float, epochs: int = 10, seed: int = 7
) -> ToxicityModel:
    """Train on labelled texts; ``share`` is that of label 1 among all labelled rows.

    A document's label holds for it as a whole: a positive one is represented by the window that
    scores best so far, a negative one by its worst or a random window.
    """
    draw = np.random.default_rng(seed)
    block = read(texts)
    p = fresh(seed)
    trainer = Trainer(p)
    begin, count = block.documents[:-1], np.diff(block.documents)
    logits = np.zeros(len(block.windows), np.float32)
    few = 6
    for epoch in range(epochs):
        trainer.refresh(block)
        tried = begin[:, None] + (draw.random((len(texts), few)) * count[:, None]).astype(int)
        if epoch < 2:
            chosen = tried[:, 0]
        else:
            flat = np.unique(tried)
            logits[flat] = window_logits(p, trainer.vectors, block.windows[flat])
            best = tried[np.arange(len(texts)), logits[tried].argmax(1)]
            chosen = np.where((labels > 0) | (draw.random(len(texts)) < 0.5), best, tried[:, 0])
        order = draw.permutation(len(texts))
        for i in range(0, len(order), 128):
            batch = order[i : i + 128]
            trainer.refresh(block) if i % 1024 == 0 else None
            trainer.step(block, block.windows[chosen[batch]], labels[batch].astype(np.float32))
        trainer.rate *= 0.85
    vectors = inputs(p, block)
    logits = window_logits(p, vectors, block.windows)
    best = np.maximum.reduceat(logits, begin)
    weight = np.where(labels > 0, share / max(labels.mean(), 1e-9),
                      (1 - share) / max(1 - labels.mean(), 1e-9))
    return ToxicityModel(p, calibrate(best, np.log(count), labels, weight))


def calibrate(
    best: np.ndarray, size: np.ndarray, labels: np.ndarray, weight: np.ndarray
) -> tuple[float, float, float]:
    """Weighted logistic regression by Newton's method, with a slight ridge."""
    x = np.stack([best, size, np.ones(len(best))], 1).astype(np.float64)
    b = np.array([1.0, 0.0, 0.0])
    for _ in range(30):
        p = sigmoid(x @ b)
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.eye(3) * 1e-3 * len(x)
        b += np.linalg.solve(curve, x.T @ (weight * (labels - p)) - 1e-3 * len(x) * (b - [1, 0, 0]))
    return tuple(b.tolist())


def fit(
    documents: DataFrame,
    labels: DataFrame,
    training: Column,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    sample_documents: int = 2_500,
    sample_chars: int = 12_000,
) -> ToxicityModel | None:
    """Train on a bounded sample of labelled rows that meet ``training`` (a test of the id).

    Per label the ``sample_documents`` rows of lowest id hash, of each at most ``sample_chars``
    characters, cut from a place given by the hash. Rows without a label or a text are not
    drawn. None if a label has no row.
    """
    rows = labels.select(
        F.col(id_column).alias("id"), F.col(label_column).cast("int").alias("label")
    ).filter("id is not null and label in (0, 1)")
    rows = rows.filter(training).distinct()
    totals = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    by_draw = Window.partitionBy("label").orderBy(F.xxhash64("id"), "id")
    chosen = rows.withColumn("n", F.row_number().over(by_draw)).filter(
        F.col("n") <= sample_documents
    )
    texts = documents.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    over = F.greatest(F.length("text") - sample_chars, F.lit(0)) + 1
    cut = F.substr("text", F.pmod(F.xxhash64("id"), over).cast("int") + 1, F.lit(sample_chars))
    found = (
        texts.filter("text is not null")
        .join(F.broadcast(chosen), "id")  # sample_documents rows per label
        .groupBy("label", "n")  # an id on many rows gives one text
        .agg(F.min(cut).alias("text"))
        .collect()
    )
    found = sorted(found, key=lambda r: (r.label, r.n, r.text))
    values = np.array([r.label for r in found])
    if len(set(values.tolist())) < 2:
        return None
    share = totals[1] / (totals[0] + totals[1])
    return learn([r.text.encode() for r in found], values, share)


def scores(
    documents: DataFrame,
    model: ToxicityModel | None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, score, predicted, n_windows`` of every row; nothing is shuffled.

    All overlapping windows of the whole text are scored. Null and empty texts have one empty
    window and get its score. Without a model every score is 0. Repeated rows score alike,
    an empty table gives no rows, other columns are ignored.
    """
    ship(documents.sparkSession)
    sent = documents.sparkSession.sparkContext.broadcast(model)
    rows = documents.select(
        F.col(id_column).alias("doc_id"),
        F.coalesce(F.col(text_column), F.lit("")).cast("binary").alias("text"),
    )
    kind = dict(rows.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            found, counts = [np.zeros(0)], [np.zeros(0, np.int64)]
            for _, texts in in_blocks(batch.column(1).to_pylist()):
                block = read(texts)
                counts.append(np.diff(block.documents))
                if own is None:
                    found.append(np.zeros(len(texts)))
                    continue
                logits = window_logits(own.parameters, inputs(own.parameters, block), block.windows)
                best = np.maximum.reduceat(logits, block.documents[:-1]).astype(np.float64)
                a, b, c = own.calibration
                found.append(sigmoid(a * best + b * np.log(counts[-1]) + c))
            score = np.concatenate(found)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(score, pa.float64()),
                    pa.array((score >= 0.5).astype(np.int32), pa.int32()),
                    pa.array(np.concatenate(counts), pa.int64()),
                ],
                names=["doc_id", "score", "predicted", "n_windows"],
            )

    return rows.mapInArrow(run, f"doc_id {kind}, score double, predicted int, n_windows long")
