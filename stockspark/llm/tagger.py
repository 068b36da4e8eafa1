"""A character-level bidirectional LSTM with CRF transitions, in numpy.

Both directions run as one recurrent step over a block-diagonal state, for a batch of windows at a
time. Arrays are laid out (time, features, windows), so that every step works on long rows. The
squashing function is x / (1 + |x|), in training and in use, as tanh takes most of the time otherwise.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

HIDDEN = 6
EMBEDDING = 6
LENGTH = 256
STRIDE = 224
TAGS = 5  # none, and the kinds of patterns.KINDS
CLASSES = 100
BATCH = 2048

_table: list[np.ndarray] = []


def class_table() -> np.ndarray:
    """Character classes: printable ASCII one by one, line ends, other letters, the rest, padding (0)."""
    if not _table:
        table = np.fromiter((98 if chr(i).isalpha() else 99 for i in range(0x110000)), dtype=np.uint8, count=0x110000)
        table[32:127] = np.arange(2, 97)
        table[[9, 10, 13]] = 1
        _table.append(table)
    return _table[0]


def classes_of(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return class_table()[codes]


@dataclass
class Tagger:
    """Character embedding, input and recurrent weights by direction, output weights, transitions."""

    embedding: np.ndarray  # (CLASSES, EMBEDDING)
    inputs: np.ndarray  # (2, 4 * HIDDEN, EMBEDDING); gates input, forget, output, then the candidate
    shift: np.ndarray  # (2, 4 * HIDDEN)
    recurrent: np.ndarray  # (2, 4 * HIDDEN, HIDDEN)
    output: np.ndarray  # (TAGS, 2 * HIDDEN)
    bias: np.ndarray  # (TAGS,)
    moves: np.ndarray  # (TAGS, TAGS): from, to
    start: np.ndarray  # (TAGS,)

    def names(self):
        return ("embedding", "inputs", "shift", "recurrent", "output", "bias", "moves", "start")


def fresh(seed: int = 1) -> Tagger:
    draw = np.random.default_rng(seed)
    h = HIDDEN
    shift = np.zeros((2, 4 * h), dtype=np.float32)
    shift[:, h : 2 * h] = 1.0
    return Tagger(
        draw.normal(0, 0.5, (CLASSES, EMBEDDING)).astype(np.float32),
        draw.normal(0, 0.5, (2, 4 * h, EMBEDDING)).astype(np.float32),
        shift,
        draw.normal(0, 0.4, (2, 4 * h, h)).astype(np.float32),
        draw.normal(0, 0.4, (TAGS, 2 * h)).astype(np.float32),
        np.array([1.0] + [0.0] * (TAGS - 1), dtype=np.float32),
        np.eye(TAGS, dtype=np.float32),
        np.zeros(TAGS, dtype=np.float32),
    )


def emissions(model: Tagger, x: np.ndarray) -> np.ndarray:
    """Scores (time, tags, windows) for windows of classes (time, windows)."""
    steps, n = x.shape
    h, e = HIDDEN, EMBEDDING
    # Rows: the three gates of both directions (6h), then both candidates (2h). Columns: both states,
    # the characters ahead and back, and a constant.
    weights = np.zeros((8 * h, 2 * h + 2 * e + 1), dtype=np.float32)
    for gate in range(4):
        for d in range(2):
            rows, own = slice((2 * gate + d) * h, (2 * gate + d + 1) * h), slice(gate * h, (gate + 1) * h)
            weights[rows, d * h : (d + 1) * h] = model.recurrent[d, own]
            weights[rows, 2 * h + d * e : 2 * h + (d + 1) * e] = model.inputs[d, own]
            weights[rows, -1] = model.shift[d, own]
    embedded = np.empty((steps, e, n), dtype=np.float32)
    columns = np.ascontiguousarray(model.embedding.T)
    for t in range(steps):
        np.take(columns, x[t], axis=1, out=embedded[t], mode="clip")
    full = np.zeros((2 * h + 2 * e + 1, n), dtype=np.float32)
    full[-1] = 1.0
    state = full[: 2 * h]
    z, size = np.empty((8 * h, n), dtype=np.float32), np.empty((8 * h, n), dtype=np.float32)
    c = np.zeros((2 * h, n), dtype=np.float32)
    t1, t2 = np.empty_like(c), np.empty_like(c)
    states = np.empty((steps, 2 * h, n), dtype=np.float32)
    for t in range(steps):
        full[2 * h : 2 * h + e] = embedded[t]
        full[2 * h + e : -1] = embedded[steps - 1 - t]
        np.matmul(weights, full, out=z)
        np.abs(z, out=size)
        size += 1.0
        z /= size
        gates = z[: 6 * h]
        gates *= 0.5
        gates += 0.5
        np.multiply(z[2 * h : 4 * h], c, out=c)
        np.multiply(z[: 2 * h], z[6 * h :], out=t1)
        c += t1
        np.abs(c, out=t2)
        t2 += 1.0
        np.divide(c, t2, out=t2)
        np.multiply(z[4 * h : 6 * h], t2, out=state)
        states[t, :h] = state[:h]
        states[steps - 1 - t, h:] = state[h:]
    scores = np.matmul(model.output, states)
    scores += model.bias[:, None]
    return scores


def best_paths(model: Tagger, scores: np.ndarray) -> np.ndarray:
    """Viterbi tags (time, windows) as uint8.

    A window is all "none" for certain where no run of other tags can gain, even with the best transition
    at each of its steps and one more to leave it; the others are decoded in full.
    """
    steps, _, n = scores.shape
    tags = np.zeros((steps, n), dtype=np.uint8)
    gain = float(max(model.moves.max(), 0.0) - model.moves[0, 0])
    lead = (scores[:, 1:] - scores[:, :1]).max(axis=1) + gain
    lead[0] += max(0.0, float((model.start[1:] - model.start[0]).max()))
    # The best run that ends at a step: the sum up to it less the lowest sum before it.
    upto = np.cumsum(lead, axis=0, dtype=np.float64)
    before = np.minimum.accumulate(np.vstack([np.zeros((1, n)), upto[:-1]]), axis=0)
    open_ = np.flatnonzero((upto - before).max(axis=0) + gain > -1e-6)
    if not len(open_):
        return tags
    s = np.ascontiguousarray(scores[:, :, open_])
    m = len(open_)
    back = np.empty((steps, TAGS, m), dtype=np.uint8)
    value = s[0] + model.start[:, None]
    for t in range(1, steps):
        tried = value[:, None, :] + model.moves[:, :, None]
        back[t] = tried.argmax(axis=0)
        value = tried.max(axis=0) + s[t]
    path = np.empty((steps, m), dtype=np.uint8)
    path[-1] = value.argmax(axis=0)
    column = np.arange(m)
    for t in range(steps - 1, 0, -1):
        path[t - 1] = back[t, path[t], column]
    tags[:, open_] = path
    return tags


def windows_of(lengths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(text, first place) of all windows: every STRIDE characters until the end is covered."""
    texts, starts = [], []
    for i, n in enumerate(lengths):
        if n:
            count = 1 + max(0, -(-(n - LENGTH) // STRIDE))
            texts.append(np.full(count, i))
            starts.append(np.arange(count) * STRIDE)
    if not texts:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(texts), np.concatenate(starts)


def tag_texts(model: Tagger, texts: list[str]) -> list[list[tuple[int, int, int]]]:
    """(start, kind, end) of the tagged spans of each whole text.

    Windows are decoded one by one. Where two overlap, each character takes its tag from the window
    in which it lies farther from the border, and spans are read off the joined tags of the whole text.
    """
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    lengths = [len(t) for t in texts]
    owner, first = windows_of(lengths)
    if not len(owner):
        return found
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    flat = np.concatenate([np.concatenate([classes_of(t) for t in texts]), np.zeros(LENGTH, dtype=np.uint8)])
    tags = np.zeros(int(offsets[-1]) + LENGTH, dtype=np.uint8)
    ends = np.array(lengths)[owner] - first
    order = np.argsort(np.minimum(ends, LENGTH), kind="stable")
    overlap = (LENGTH - STRIDE) // 2
    steps = np.arange(LENGTH)[:, None]
    for at in range(0, len(order), BATCH):
        pick = order[at : at + BATCH]
        size = int(min(LENGTH, ends[pick].max()))
        place = (offsets[owner[pick]] + first[pick])[None, :] + steps[:size]
        inside = steps[:size] < ends[pick][None, :]
        x = np.where(inside, flat[place], np.uint8(0))
        path = best_paths(model, emissions(model, x))
        low = np.where(first[pick] > 0, overlap, 0)[None, :]
        high = np.where(ends[pick] > LENGTH, LENGTH - overlap, LENGTH)[None, :]
        own = inside & (steps[:size] >= low) & (steps[:size] < high) & (path > 0)
        tags[place[own]] = path[own]
    changes = np.flatnonzero(np.diff(tags[: int(offsets[-1])].astype(np.int16))) + 1
    borders = np.unique(np.concatenate((offsets, changes)))
    for s, e in zip(borders[:-1].tolist(), borders[1:].tolist()):
        if e > s and tags[s]:
            i = int(np.searchsorted(offsets, s, side="right")) - 1
            found[i].append((s - int(offsets[i]), int(tags[s]) - 1, e - int(offsets[i])))
    return found


def train(windows: list[tuple[str, list[tuple[int, int, int]]]], steps: int = 220, batch: int = 96, rate: float = 0.03, seed: int = 1) -> Tagger:
    """Fit on windows of equal length with labelled (start, kind, end) spans, by Adam on the CRF likelihood."""
    model = fresh(seed)
    if not windows:
        return model
    size = max(len(w) for w, _ in windows)
    x = np.zeros((size, len(windows)), dtype=np.uint8)
    y = np.zeros((size, len(windows)), dtype=np.int64)
    for k, (text, spans) in enumerate(windows):
        x[: len(text), k] = classes_of(text)
        for s, kind, e in spans:
            y[s:e, k] = kind + 1
    draw = np.random.default_rng(seed)
    positive = np.flatnonzero((y > 0).any(0))
    slow = {n: (np.zeros_like(getattr(model, n)), np.zeros_like(getattr(model, n))) for n in model.names()}
    for k in range(1, steps + 1):
        pick = draw.integers(0, len(windows), batch)
        if len(positive):
            pick[: batch // 2] = positive[draw.integers(0, len(positive), batch // 2)]
        slopes = gradients(model, x[:, pick], y[:, pick])
        now = rate * min(1.0, 2 * (1 - k / (steps + 1)))
        for n in model.names():
            g = slopes[n] / batch
            a, b = slow[n]
            a *= 0.9
            a += 0.1 * g
            b *= 0.99
            b += 0.01 * g * g
            getattr(model, n)[...] -= (now * (a / (1 - 0.9**k)) / (np.sqrt(b / (1 - 0.99**k)) + 1e-7)).astype(np.float32)
    return model


def _squash(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


def _run(drive: np.ndarray, recurrent: np.ndarray) -> list[tuple]:
    """One direction over inputs (time, windows, gates) with all values kept for the way back."""
    h, n = HIDDEN, drive.shape[1]
    c, s = np.zeros((n, h), dtype=np.float32), np.zeros((n, h), dtype=np.float32)
    kept = []
    for t in range(len(drive)):
        z = _squash(drive[t] + s @ recurrent.T)
        gates = 0.5 * z[:, : 3 * h] + 0.5
        i, f, o, g = gates[:, :h], gates[:, h : 2 * h], gates[:, 2 * h :], z[:, 3 * h :]
        before, state_before = c, s
        c = f * c + i * g
        tc = _squash(c)
        s = o * tc
        kept.append((i, f, o, g, before, tc, state_before, z, s))
    return kept


def gradients(model: Tagger, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Slopes of the negative CRF log-likelihood, summed over the windows."""
    steps, n = x.shape
    h = HIDDEN
    embedded = model.embedding[x]
    seen_by = (embedded, embedded[::-1])
    kept = [_run(seen_by[d] @ model.inputs[d].T + model.shift[d], model.recurrent[d]) for d in range(2)]
    states = np.concatenate([np.stack([k[-1] for k in kept[0]]), np.stack([k[-1] for k in kept[1]])[::-1]], axis=2)
    score = states @ model.output.T + model.bias

    def total(v: np.ndarray, axis: int) -> np.ndarray:
        top = v.max(axis=axis, keepdims=True)
        return np.squeeze(top, axis) + np.log(np.exp(v - top).sum(axis=axis))

    alpha = np.empty((steps, n, TAGS))
    beta = np.zeros((steps, n, TAGS))
    alpha[0] = score[0] + model.start
    for t in range(1, steps):
        alpha[t] = total(alpha[t - 1][:, :, None] + model.moves, 1) + score[t]
    for t in range(steps - 2, -1, -1):
        beta[t] = total((beta[t + 1] + score[t + 1])[:, None, :] + model.moves, 2)
    norm = total(alpha[-1], 1)
    marginal = np.exp(alpha + beta - norm[None, :, None])
    truth = np.eye(TAGS)[y]
    d_score = (marginal - truth).astype(np.float32)
    pairs = np.exp(alpha[:-1][:, :, :, None] + model.moves + (score[1:] + beta[1:])[:, :, None, :] - norm[None, :, None, None])
    seen = np.einsum("tni,tnj->ij", truth[:-1], truth[1:])
    found = {
        "moves": (pairs.sum((0, 1)) - seen).astype(np.float32),
        "start": d_score[0].sum(0),
        "bias": d_score.sum((0, 1)),
        "output": np.einsum("tnk,tnh->kh", d_score, states),
        "embedding": np.zeros_like(model.embedding),
        "inputs": np.zeros_like(model.inputs),
        "shift": np.zeros_like(model.shift),
        "recurrent": np.zeros_like(model.recurrent),
    }
    d_states = d_score @ model.output
    for d in range(2):
        mine = d_states[:, :, :h] if d == 0 else d_states[::-1, :, h:]
        dh, dc = np.zeros((n, h), dtype=np.float32), np.zeros((n, h), dtype=np.float32)
        dz_all = np.empty((steps, n, 4 * h), dtype=np.float32)
        for t in range(steps - 1, -1, -1):
            i, f, o, g, before, tc, state_before, z, _ = kept[d][t]
            dh = dh + mine[t]
            dc = dc + dh * o * (1 - np.abs(tc)) ** 2
            dz = dz_all[t]
            dz[:, :h] = dc * g * 0.5
            dz[:, h : 2 * h] = dc * before * 0.5
            dz[:, 2 * h : 3 * h] = dh * tc * 0.5
            dz[:, 3 * h :] = dc * i
            dz *= (1 - np.abs(z)) ** 2
            found["recurrent"][d] += dz.T @ state_before
            dh = dz @ model.recurrent[d]
            dc = dc * f
        found["inputs"][d] = np.einsum("tnz,tne->ze", dz_all, seen_by[d])
        found["shift"][d] = dz_all.sum((0, 1))
        back = (dz_all if d == 0 else dz_all[::-1]) @ model.inputs[d]
        np.add.at(found["embedding"], x.ravel(), back.reshape(-1, EMBEDDING))
    return found
