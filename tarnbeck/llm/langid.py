"""Language identification by a bidirectional gated recurrent network over bytes.

A text's UTF-8 bytes are cut into windows of WINDOW bytes, the last one padded; all windows of a batch run side by side,
so the recurrence takes WINDOW steps however long a text is. Each byte is labelled with a distribution over the learned
languages, and a document's probabilities are the mean over all its bytes. The network is trained in numpy on the
driver, by backpropagation through time, from windows of a bounded sample of labelled rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnbeck.llm.common import in_batches, table

WINDOW = 64
HIDDEN = 8
#: Labelled rows that the training may take at most, and windows of each.
SAMPLE_ROWS = 1500
SAMPLE_WINDOWS = 6
STEPS = 220
BATCH = 256
RATE = 0.02
PAD = 256
#: Windows that run side by side.
SIDE = 2048
#: The stage lets documents go whose best language has less than this.
LEAST_SCORE = 0.3


def _has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    weights: dict[str, np.ndarray]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _states(x: np.ndarray, w: dict[str, np.ndarray], side: str, keep: bool = False) -> tuple[np.ndarray, list]:
    """States (time, window, hidden) of one direction over byte ids (time, window); what BPTT needs too if keep."""
    table_, u = w[f"in_{side}"], w[f"re_{side}"]
    steps, n, size = len(x), x.shape[1], HIDDEN
    out, h, kept = np.empty((steps, n, size), dtype=table_.dtype), np.zeros((n, size), dtype=table_.dtype), []
    for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
        a = table_[x[t]]
        b = h @ u
        gates = _sigmoid(a[:, : 2 * size] + b[:, : 2 * size])
        z, r = gates[:, :size], gates[:, size:]
        c = np.tanh(a[:, 2 * size :] + r * b[:, 2 * size :])
        new = c + z * (h - c)
        if keep:
            kept.append((t, h, z, r, c, b[:, 2 * size :]))
        out[t] = h = new
    return out, kept


def _run(x: np.ndarray, w: dict[str, np.ndarray], side: str) -> np.ndarray:
    """_states without what training keeps: gates apart, so that all arrays are contiguous, and buffers used again."""
    tables = [np.ascontiguousarray(w[f"in_{side}"][:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3)]
    us = [np.ascontiguousarray(w[f"re_{side}"][:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3)]
    out = np.empty((len(x), x.shape[1], HIDDEN), dtype=tables[0].dtype)
    z, r, c, b = (np.empty((x.shape[1], HIDDEN), dtype=tables[0].dtype) for _ in range(4))
    h = np.zeros_like(z)
    for t in range(len(x)) if side == "f" else range(len(x) - 1, -1, -1):
        for gate, k in ((z, 0), (r, 1)):
            np.take(tables[k], x[t], axis=0, out=gate, mode="clip")
            np.matmul(h, us[k], out=b)
            gate += b
            _sigmoid(gate)
        np.matmul(h, us[2], out=b)
        b *= r
        np.take(tables[2], x[t], axis=0, out=c, mode="clip")
        c += b
        np.tanh(c, out=c)
        np.subtract(h, c, out=b)
        b *= z
        h = np.add(b, c, out=out[t])
    return out


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=-1, keepdims=True))
    return x / x.sum(axis=-1, keepdims=True)


def position_probabilities(x: np.ndarray, w: dict[str, np.ndarray]) -> np.ndarray:
    """(time, window, language): the label of every byte."""
    rows = x.size
    p = _run(x, w, "f").reshape(rows, HIDDEN) @ w["out"][:HIDDEN]
    p += _run(x, w, "b").reshape(rows, HIDDEN) @ w["out"][HIDDEN:]
    p += w["bias"]
    np.exp(p, out=p)  # logits are small: each is bounded by the weights
    p /= p.sum(axis=1, keepdims=True)
    return p.reshape(*x.shape, -1)


def gradients(x: np.ndarray, y: np.ndarray, mass: np.ndarray, w: dict[str, np.ndarray]) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross-entropy over the bytes with mass, and its gradients by backpropagation through time."""
    f, keep_f = _states(x, w, "f", keep=True)
    b, keep_b = _states(x, w, "b", keep=True)
    both = np.concatenate([f, b], axis=2)
    p = _softmax(both @ w["out"] + w["bias"])
    n = np.arange(x.shape[1])
    total = mass.sum()
    loss = float(-(np.log(p[:, n, y] + 1e-9) * mass).sum() / total)
    d = p.copy()
    d[:, n, y] -= 1
    d *= (mass / total)[:, :, None]
    flat = both.reshape(-1, 2 * HIDDEN)
    grads = {"out": flat.T @ d.reshape(-1, d.shape[2]), "bias": d.sum(axis=(0, 1))}
    back = d @ w["out"].T
    for side, kept, dh_out in (("f", keep_f, back[:, :, :HIDDEN]), ("b", keep_b, back[:, :, HIDDEN:])):
        u = w[f"re_{side}"]
        gu, da_all = np.zeros_like(u), np.empty((len(x), x.shape[1], 3 * HIDDEN), dtype=u.dtype)
        dh = np.zeros((x.shape[1], HIDDEN), dtype=u.dtype)
        for t, h, z, r, c, bc in reversed(kept):
            dh = dh + dh_out[t]
            dc = dh * (1 - z) * (1 - c * c)
            da = np.concatenate([dh * (h - c) * z * (1 - z), dc * bc * r * (1 - r), dc], axis=1)
            da_all[t] = da
            db = da.copy()
            db[:, 2 * HIDDEN :] *= r
            gu += h.T @ db
            dh = dh * z + db @ u.T
        gt = np.zeros_like(w[f"in_{side}"])
        np.add.at(gt, x.reshape(-1), da_all.reshape(-1, 3 * HIDDEN))
        grads |= {f"re_{side}": gu, f"in_{side}": gt}
    return loss, grads


def train(rows: list[tuple[str, str]], steps: int = STEPS, seed: int = 11) -> Model:
    """From (language, text) rows, each a window or less. No rows: a model without languages."""
    languages = tuple(sorted({r[0] for r in rows}))
    if not languages:
        return Model((), {})
    r = np.random.default_rng(seed)
    x = np.stack([_ids(t.encode("utf-8", "surrogatepass")[:WINDOW]) for _, t in rows], axis=1)
    y = np.array([languages.index(k) for k, _ in rows])
    w = {"out": r.normal(0, 0.3, (2 * HIDDEN, len(languages))), "bias": np.zeros(len(languages))}
    for side in "fb":
        w |= {f"in_{side}": r.normal(0, 0.3, (PAD + 1, 3 * HIDDEN)), f"re_{side}": r.normal(0, 0.3, (HIDDEN, 3 * HIDDEN))}
    w = {k: v.astype(np.float32) for k, v in w.items()}
    first, second = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}
    share = np.bincount(y, minlength=len(languages)) / len(y)
    chance = (1 / share[y]) ** 0.5
    chance /= chance.sum()
    for step in range(1, steps + 1):
        at = r.choice(len(y), size=min(BATCH, len(y)), p=chance)
        some = x[:, at]
        _, grads = gradients(some, y[at], (some != PAD).astype(np.float32), w)
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, g in grads.items():
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            w[k] = (w[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return Model(languages, w)


def _ids(raw: bytes) -> np.ndarray:
    """A whole number of windows' ids, one at least."""
    n = max(1, -(-len(raw) // WINDOW)) * WINDOW
    out = np.full(n, PAD, dtype=np.int16)
    out[: len(raw)] = np.frombuffer(raw, dtype=np.uint8)
    return out


def predict(texts: list[str | None], model: Model) -> list[tuple[str, float]]:
    """(language, probability) of each whole text; ("und", 0) for null, for no letters, and from a model without languages."""
    found = [("und", 0.0)] * len(texts)
    if not model.languages:
        return found
    at = [i for i, t in enumerate(texts) if t and _has_letter(t)]
    totals = np.zeros((len(texts), len(model.languages)))
    parts, owners, held = [], [], 0

    def run() -> None:
        nonlocal parts, owners, held
        if parts:
            x = np.concatenate(parts).reshape(-1, WINDOW)
            owner = np.concatenate(owners)
            for k in range(0, len(x), SIDE):
                some = np.ascontiguousarray(x[k : k + SIDE].T, dtype=np.intp)
                p = position_probabilities(some, model.weights)
                p[some == PAD] = 0
                sums = p.sum(axis=0, dtype=np.float64)
                for j in range(len(model.languages)):
                    totals[:, j] += np.bincount(owner[k : k + SIDE], weights=sums[:, j], minlength=len(texts))
        parts, owners, held = [], [], 0

    for i in at:
        ids = _ids(texts[i].encode("utf-8", "surrogatepass"))
        parts.append(ids)
        owners.append(np.full(len(ids) // WINDOW, i))
        held += len(ids) // WINDOW
        if held >= SIDE:
            run()
    run()
    for i in at:
        p = totals[i] / totals[i].sum()
        k = int(p.argmax())
        found[i] = (model.languages[k], float(min(1.0, p[k])))
    return found


def _remainder() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 3


def fit(docs: DataFrame, rows: int = SAMPLE_ROWS, windows: int = SAMPLE_WINDOWS) -> Model:
    """A model from at most `rows` rows with text and language whose crc32(doc_id) mod 3 isn't 1: those with the least hash of doc_id.

    Of each, `windows` windows at places that the hash gives. The hash only picks rows; the network sees text alone.
    """
    mark = F.xxhash64(F.col("doc_id").cast("long"))
    learn = docs.where("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL").where(_remainder() != 1)
    marks = [r[0] for r in learn.select(mark.alias("m")).orderBy("m").limit(rows).collect()]
    if not marks:
        return train([])
    text = F.col("text").cast("string")
    spots = [F.substring(text, (F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.lit(k)), F.greatest(F.length(text) - WINDOW, F.lit(1))) + 1).cast("int"), F.lit(WINDOW)) for k in range(windows)]
    picked = learn.where(mark <= marks[-1]).select(mark.alias("m"), F.col("lang").cast("string").alias("lang"), F.array(*spots).alias("spots")).orderBy("m", "lang").limit(rows).collect()
    return train([(r.lang, s) for r in picked for s in r.spots if s and _has_letter(s)])


def _label(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = predict(batch.column(2).to_pylist(), model)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])


def label(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score), one row per row of docs; held_out is false without a doc_id. Further columns are not read."""
    read = docs.select(F.col("doc_id").cast("long"), F.coalesce(_remainder() == 1, F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text"))
    return in_batches(read).mapInArrow(functools.partial(_label, model=model), "doc_id long, held_out boolean, lang_pred string, score double")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return label(docs, fit(docs))


def _keep(batches: Iterator[pa.RecordBatch], model: Model, column: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = predict(batch.column(column).to_pylist(), model)
        yield batch.filter(pa.array([x[0] != "und" and x[1] >= LEAST_SCORE for x in found], pa.bool_()))


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage: documents go whose text is null or has no letters, or whose language stays unclear. The model learns from the documents at hand."""
    return in_batches(docs).mapInArrow(functools.partial(_keep, model=fit(docs), column=docs.columns.index("text")), docs.schema)


QUERIES = {"op7_language": op7_language}
ORACLES: dict[str, str] = {}
