"""Language identification by a bidirectional gated recurrent network over bytes.

A text is read in windows of ``WINDOW`` bytes; one network reads forward from ``CONTEXT`` bytes
before the window and one backward from ``CONTEXT`` bytes behind it (from a zero state at the
text's ends), every position gets label probabilities from both states, and the mean over all
positions of the text gives the document's probabilities. So a label rests on 32 to 95 bytes
to either side, not on the whole text; windows are independent and a long text is read in batches.
Training is plain numpy: backpropagation through time over labelled windows, Adam steps.

The training sample is bounded by parameters: at most about ``per_label`` documents of
each label (those with the smallest hash of their id; the share is taken from full label
counts), one excerpt of ``excerpt_chars`` code points of each. Prediction covers every
byte of every text, in batches, in tasks.

A null text, or one without a letter, is ``und`` with score 0. Of labels with equal
probabilities the first in ascending order is taken. Rows stay one to one. With
no labelled row at all, everything is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import only_memo, small_batches

HIDDEN = 8
WINDOW = 64
CONTEXT = 32  # bytes read before and behind a window
BATCH = 2048  # windows per pass
UNDETERMINED = "und"


@dataclass
class ByteNet:
    """Labels and float32 weights; gates are update (z), reset (r) and candidate (n)."""

    labels: list[str]
    emb: np.ndarray  # (2, 3, 256, H): byte input of each direction and gate
    rec: np.ndarray  # (2, 3, H, H): recurrent weights
    out: np.ndarray  # (2, H, K)
    bias: np.ndarray  # (K,)

    @classmethod
    def fresh(cls, labels: list[str], seed: int = 7, hidden: int = HIDDEN) -> ByteNet:
        rng = np.random.default_rng(seed)

        def normal(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        return cls(list(labels), normal(2, 3, 256, hidden, scale=0.5), normal(2, 3, hidden, hidden, scale=hidden**-0.5),
                   normal(2, hidden, len(labels), scale=hidden**-0.5), np.zeros(len(labels), np.float32))

    def weights(self) -> list[np.ndarray]:
        return [self.emb, self.rec, self.out, self.bias]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place, by way of tanh (one vectorised call)."""
    x *= 0.5
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


def _states(net: ByteNet, d: int, data: np.ndarray, mask: np.ndarray | None, keep: list | None = None) -> np.ndarray:
    """Hidden states (T, B, H) of direction ``d``; ``keep`` collects what training needs."""
    steps, rows = data.shape
    ez, er, en = net.emb[d]
    uz, ur, un = net.rec[d]
    h = np.zeros((rows, ez.shape[1]), np.float32)
    states = np.empty((steps, *h.shape), np.float32)
    z, r, n, s = (np.empty_like(h) for _ in range(4))
    for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
        x = data[t]
        if keep is not None:
            z, r, n, s = (np.empty_like(h) for _ in range(4))
        np.take(ez, x, axis=0, out=z, mode="clip")
        z += h @ uz
        _sigmoid(z)
        np.take(er, x, axis=0, out=r, mode="clip")
        r += h @ ur
        _sigmoid(r)
        np.matmul(h, un, out=s)
        np.take(en, x, axis=0, out=n, mode="clip")
        n += r * s
        np.tanh(n, out=n)
        if keep is not None:
            keep.append((t, h, z, r, n, s))
        before, h = h, states[t]
        np.subtract(before, n, out=h)  # h = n + z * (before - n)
        h *= z
        h += n
        if mask is not None:
            h *= mask[t][:, None]
    return states


def position_probabilities(net: ByteNet, data: np.ndarray, mask: np.ndarray | None, skip: int = 0) -> np.ndarray:
    """Label probabilities (T, B, K) of the window's positions, which begin ``skip`` bytes into
    ``data``: the forward direction starts before them, the backward one behind them."""
    stop = min(len(data), skip + WINDOW)
    scores = _states(net, 0, data[:stop], None if mask is None else mask[:stop])[skip:] @ net.out[0]
    scores += _states(net, 1, data[skip:], None if mask is None else mask[skip:])[: stop - skip] @ net.out[1]
    scores += net.bias
    scores -= scores.max(axis=2, keepdims=True)
    np.exp(scores, out=scores)
    scores /= scores.sum(axis=2, keepdims=True)
    return scores


def _gradients(net: ByteNet, data: np.ndarray, mask: np.ndarray, target: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy over positions and its gradients, through time."""
    steps, rows = data.shape
    kept: list[list] = [[], []]
    states = [_states(net, d, data, mask, kept[d]) for d in (0, 1)]
    scores = states[0] @ net.out[0] + states[1] @ net.out[1] + net.bias
    scores -= scores.max(axis=2, keepdims=True)
    probs = np.exp(scores)
    probs /= probs.sum(axis=2, keepdims=True)
    weight = mask / mask.sum()
    loss = -float((np.log(probs[:, np.arange(rows), target] + 1e-9) * weight).sum())
    delta = probs
    delta[:, np.arange(rows), target] -= 1
    delta *= weight[:, :, None]
    g_emb, g_rec, g_out = np.zeros_like(net.emb), np.zeros_like(net.rec), np.zeros_like(net.out)
    flat = delta.reshape(-1, delta.shape[2])
    for d in (0, 1):
        g_out[d] = states[d].reshape(-1, states[d].shape[2]).T @ flat
        from_out = delta @ net.out[d].T
        carried = np.zeros_like(states[d][0])
        uz, ur, un = net.rec[d]
        d_in = np.empty((3, steps, rows, uz.shape[0]), np.float32)
        for t, h, z, r, n, s in reversed(kept[d]):
            dh = (from_out[t] + carried) * mask[t][:, None]
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (h - n) * z * (1 - z)
            dr = dn * s * r * (1 - r)
            ds = dn * r
            carried = dh * z + dz @ uz.T + dr @ ur.T + ds @ un.T
            g_rec[d, 0] += h.T @ dz
            g_rec[d, 1] += h.T @ dr
            g_rec[d, 2] += h.T @ ds
            d_in[0, t], d_in[1, t], d_in[2, t] = dz, dr, dn
        byte = data.reshape(-1)
        for gate in range(3):
            flat_in = d_in[gate].reshape(steps * rows, -1)
            for j in range(flat_in.shape[1]):
                g_emb[d, gate, :, j] = np.bincount(byte, weights=flat_in[:, j], minlength=256)
    return loss, [g_emb, g_rec, g_out, flat.sum(axis=0)]


def windows(texts: list[bytes], size: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window bytes (W, size), real length of each window, text index of each window)."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    count = -(-lengths // size)
    owner = np.repeat(np.arange(len(texts)), count)
    padded = b"".join(t + b"\0" * (-len(t) % size) for t in texts)
    data = np.frombuffer(padded, dtype=np.uint8).reshape(-1, size)
    real = np.full(len(data), size, dtype=np.int64)
    last = np.cumsum(count) - 1
    used = count > 0
    real[last[used]] = lengths[used] - (count[used] - 1) * size
    return data, real, owner


def train(texts: list[str], labels: list[str], steps: int = 300, batch: int = 192, rate: float = 0.02, seed: int = 7) -> ByteNet:
    """Fit on labelled texts; batches draw the labels evenly."""
    names = sorted(set(labels))
    net = ByteNet.fresh(names, seed)
    data, real, owner = windows([t.encode("utf-8", "surrogatepass") for t in texts])
    target = np.array([names.index(x) for x in labels])[owner] if len(texts) else np.empty(0, int)
    pools = [np.flatnonzero(target == k) for k in range(len(names))]
    rng = np.random.default_rng(seed)
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in net.weights()]
    for step in range(1, steps + 1):
        pick = np.concatenate([rng.choice(p, max(1, batch // len(names))) for p in pools if len(p)])
        mask = (np.arange(WINDOW)[:, None] < real[pick]).astype(np.float32)
        _, grads = _gradients(net, np.ascontiguousarray(data[pick].T), mask, target[pick])
        scale = min(1.0, 1.0 / (np.sqrt(sum(float((g * g).sum()) for g in grads)) + 1e-9))
        lr = rate * (0.5 + 0.5 * np.cos(np.pi * step / (steps + 1)))
        for w, g, (m, v) in zip(net.weights(), grads, moments):
            g = g * scale
            m += 0.1 * (g - m)
            v += 0.005 * (g * g - v)
            w -= (lr * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.995**step)) + 1e-8)).astype(np.float32)
    return net


def windows_in_context(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes (W, CONTEXT + WINDOW + CONTEXT), first and end of the text's bytes in each row, text
    index): the windows of all texts, each with the bytes around it."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    count = -(-lengths // WINDOW)
    owner = np.repeat(np.arange(len(texts)), count)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    around = b"\0" * CONTEXT
    flat = np.frombuffer(around + b"".join(t + b"\0" * (-len(t) % WINDOW) for t in texts) + around, dtype=np.uint8)
    data = np.lib.stride_tricks.sliding_window_view(flat, WINDOW + 2 * CONTEXT)[::WINDOW] if len(owner) else np.empty((0, 0), np.uint8)
    first = np.maximum(0, CONTEXT - number * WINDOW)
    end = np.minimum(WINDOW + 2 * CONTEXT, CONTEXT + lengths[owner] - number * WINDOW)
    return data, first, end, owner


def pooled(net: ByteNet, texts: list[bytes]) -> np.ndarray:
    """Mean position probabilities (texts, K) over all bytes; zeros for an empty text."""
    data, first, end, owner = windows_in_context(texts)
    total = np.zeros((len(texts), len(net.labels)))
    order = np.lexsort((end, first))  # windows at a text's ends together: only they need a mask
    cuts = np.flatnonzero(np.diff(first[order])) + 1
    for group in np.split(order, cuts) if len(order) else []:
        for at in range(0, len(group), BATCH):
            pick = group[at : at + BATCH]
            low, high = int(first[pick[0]]), int(end[pick].max())
            part = np.ascontiguousarray(data[pick, low:high].T)
            place = np.arange(low, high)[:, None]
            inside = place < end[pick]
            mask = None if inside.all() else inside.astype(np.float32)
            probs = position_probabilities(net, part, mask, CONTEXT - low)
            if mask is not None:
                probs *= mask[CONTEXT - low :][:WINDOW, :, None]
            np.add.at(total, owner[pick], probs.sum(axis=0))
    return total / np.maximum(1, np.array([len(t) for t in texts]))[:, None]


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def training_sample(
    df: DataFrame, per_label: int, excerpt_chars: int, id_col: str, text_col: str, label_col: str
) -> tuple[list[str], list[str]]:
    """About ``per_label`` excerpts of each label, chosen by a hash of the id."""
    labelled = df.where(F.col(label_col).isNotNull() & (F.length(F.coalesce(text_col, F.lit(""))) > 0))
    counts = {r[0]: r[1] for r in labelled.groupBy(label_col).count().collect()}
    if not counts:
        return [], []
    draw = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    share = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, per_label / n)))])
    start = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit("start")), F.greatest(F.length(text_col) - excerpt_chars, F.lit(1)))
    rows = (
        labelled.where(draw < F.element_at(share, F.col(label_col)))
        .select(F.col(id_col).cast("string").alias("id"), F.substring(text_col, start.cast("int") + 1, F.lit(excerpt_chars)).alias("text"),
                F.col(label_col).alias("label"))
        .collect()
    )
    rows = sorted(rows, key=lambda r: (r["id"] or "", r["text"], r["label"]))
    return [r["text"] for r in rows], [r["label"] for r in rows]


def fit(
    df: DataFrame, per_label: int = 600, excerpt_chars: int = 512, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "lang", **training: int,
) -> ByteNet | None:
    """Train on a bounded sample of the labelled rows of ``df``; None if there are none."""
    texts, labels = training_sample(df, per_label, excerpt_chars, id_col, text_col, label_col)
    return train(texts, labels, **training) if texts else None


def predict(df: DataFrame, net: ByteNet | None, carry: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The ``carry`` columns of every row with ``lang_pred`` and ``score``."""
    shared = df.sparkSession.sparkContext.broadcast(net)  # a few thousand weights
    ddl = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in carry)
    columns = list(dict.fromkeys([*carry, text_col]))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_memo("langid", lambda: None)
        model = shared.value
        for batch in small_batches(batches, text_col, 1 << 20):
            texts = batch.column(text_col).to_pylist()
            known = [i for i, t in enumerate(texts) if model is not None and has_letter(t)]
            names, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
            if known:
                probs = pooled(model, [texts[i].encode("utf-8", "surrogatepass") for i in known])
                for i, row in zip(known, probs):
                    names[i] = model.labels[int(row.argmax())]
                    scores[i] = min(1.0, float(row.max()))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in carry), pa.array(names, pa.string()), pa.array(scores)], [*carry, "lang_pred", "score"]
            )

    return df.select(*columns).mapInArrow(label, f"{ddl}, lang_pred string, score double")
