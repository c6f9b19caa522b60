"""A small gated recurrent language model in numpy: class-factored softmax, truncated backpropagation, carried state."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

HIDDEN = 20
CLASSES, IN_CLASS = 16, 16
SYMBOLS = CLASSES * IN_CLASS
STEPS = 16  # length of a window; backpropagation stops at its start, the state goes on
STREAMS = 512
F32 = np.float32


def _softmax_log(logits: np.ndarray) -> np.ndarray:
    top = logits.max(axis=1, keepdims=True)
    logits = logits - top
    return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


def _log_of(logits: np.ndarray, rows: np.ndarray, pick) -> np.ndarray:
    """Log-softmax of one column per row."""
    top = logits.max(axis=1)
    return logits[rows, pick] - top - np.log(np.exp(logits - top[:, None]).sum(axis=1))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return F32(1) / (F32(1) + np.exp(-x))


@dataclass
class Params:
    """Input table by symbol, recurrent weights, and the two output layers."""

    inputs: np.ndarray
    recurrent: np.ndarray
    bias: np.ndarray
    to_class: np.ndarray
    class_bias: np.ndarray
    to_word: np.ndarray
    word_bias: np.ndarray

    def arrays(self) -> list[np.ndarray]:
        return [self.inputs, self.recurrent, self.bias, self.to_class, self.class_bias, self.to_word, self.word_bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in self.arrays()])

    @staticmethod
    def shapes() -> list[tuple]:
        h = HIDDEN
        return [(SYMBOLS, 3 * h), (h, 3 * h), (3 * h,), (h, CLASSES), (CLASSES,), (CLASSES, h, IN_CLASS), (CLASSES, IN_CLASS)]

    @staticmethod
    def of(flat: np.ndarray) -> Params:
        out, at = [], 0
        for shape in Params.shapes():
            size = int(np.prod(shape))
            out.append(np.ascontiguousarray(flat[at : at + size].reshape(shape), dtype=F32))
            at += size
        return Params(*out)

    @staticmethod
    def start(counts: np.ndarray) -> Params:
        """Small random weights; output biases follow the symbol counts, so training starts at the unigram model."""
        rng = np.random.default_rng(5)
        p = Params.of(rng.normal(0, 0.1, sum(int(np.prod(s)) for s in Params.shapes())).astype(F32))
        share = (counts.reshape(CLASSES, IN_CLASS) + 0.5).astype(float)
        p.bias[:] = 0
        p.class_bias[:] = np.log(share.sum(axis=1) / share.sum())
        p.word_bias[:] = np.log(share / share.sum(axis=1, keepdims=True))
        return p


def _step(p: Params, table: np.ndarray, h: np.ndarray, x: np.ndarray):
    """One step of all streams; ``table`` holds what each symbol gives to the gates, bias included."""
    n = HIDDEN
    given = table[x]
    carried = h @ p.recurrent
    gates = _sigmoid(given[:, : 2 * n] + carried[:, : 2 * n])
    keep, reset = gates[:, :n], gates[:, n:]
    new = np.tanh(given[:, 2 * n :] + reset * carried[:, 2 * n :])
    return (F32(1) - keep) * new + keep * h, (keep, reset, new, carried[:, 2 * n :])


def _outputs(p: Params, states: np.ndarray, target: np.ndarray, learn: bool):
    """Log-probabilities of the targets and, for learning, gradients of the outputs and of the states.

    Rows are put in the order of their class first, so that every class works on a slice.
    """
    group = (target // IN_CLASS).astype(np.uint8)
    order = np.argsort(group, kind="stable")
    states, word = states[order], (target % IN_CLASS)[order]
    cuts = np.r_[0, np.cumsum(np.bincount(group, minlength=CLASSES))]
    told = np.empty(len(target))
    of_class = states @ p.to_class + p.class_bias
    if not learn:
        told[:] = _log_of(of_class, np.arange(len(target)), group[order])
        for c in range(CLASSES):
            at = slice(cuts[c], cuts[c + 1])
            if cuts[c + 1] > cuts[c]:
                told[at] += _log_of(states[at] @ p.to_word[c] + p.word_bias[c], np.arange(cuts[c + 1] - cuts[c]), word[at])
    else:
        log_class = _softmax_log(of_class)
        d_class = np.exp(log_class)
        for c in range(CLASSES):
            d_class[cuts[c] : cuts[c + 1], c] -= 1
        d_states = d_class @ p.to_class.T
        grads = [states.T @ d_class, d_class.sum(axis=0), np.zeros_like(p.to_word), np.zeros_like(p.word_bias)]
        for c in range(CLASSES):
            at, rows = slice(cuts[c], cuts[c + 1]), np.arange(cuts[c + 1] - cuts[c])
            if not len(rows):
                continue
            log_word = _softmax_log(states[at] @ p.to_word[c] + p.word_bias[c])
            told[at] = log_class[at, c].astype(np.float64) + log_word[rows, word[at]]
            d = np.exp(log_word)
            d[rows, word[at]] -= 1
            grads[2][c], grads[3][c] = states[at].T @ d, d.sum(axis=0)
            d_states[at] += d @ p.to_word[c].T
    out = np.empty(len(target))
    out[order] = told
    if not learn:
        return out
    back = np.empty_like(d_states)
    back[order] = d_states
    return out, grads, back


def lay_out(symbols: np.ndarray, at: np.ndarray, streams: int) -> tuple[np.ndarray, np.ndarray]:
    """Whole documents laid end to end in parallel streams: first token and length of each, longest first."""
    size = np.diff(at)
    n = max(1, min(streams, len(size)))
    share = max(int(size.max()), -(-int(at[-1]) // n))
    stream = (at[:-1] + size // 2) // share
    first = np.flatnonzero(np.r_[True, np.diff(stream) != 0])
    start = at[first]
    length = np.diff(np.r_[start, at[-1]])
    order = np.argsort(-length, kind="stable")
    return start[order], length[order]


def _windows(symbols: np.ndarray, at: np.ndarray, streams: int):
    """Token positions and the active streams, window by window."""
    start, length = lay_out(symbols, at, streams)
    opens = np.zeros(len(symbols), bool)
    opens[at[:-1]] = True
    for t in range(0, int(length[0]), STEPS):
        active = int(np.searchsorted(-length, -t, side="left"))
        steps = min(STEPS, int(length[0]) - t)
        pos = start[:active, None] + t + np.arange(steps)
        live = t + np.arange(steps) < length[:active, None]
        yield active, np.where(live, pos, 0), live, opens


def log_probs(p: Params, symbols: np.ndarray, at: np.ndarray, streams: int = 2 * STREAMS) -> np.ndarray:
    """Natural log-probability of every token; a document ends with the symbol that also stands before its start."""
    out = np.zeros(len(symbols))
    end = symbols[at[1:] - 1][0] if len(at) > 1 else 0
    before = np.r_[end, symbols[:-1]]
    h, table = None, p.inputs + p.bias
    for active, pos, live, opens in _windows(symbols, at, streams):
        h = np.zeros((active, HIDDEN), F32) if h is None else h[:active]
        states = np.empty((pos.shape[1], active, HIDDEN), F32)
        for k in range(pos.shape[1]):
            x = pos[:, k]
            h = np.where(opens[x][:, None], F32(0), h)
            h, _ = _step(p, table, h, before[x])
            states[k] = h
        where = live.T.ravel()
        tokens = pos.T.ravel()[where]
        out[tokens] = _outputs(p, states.reshape(-1, HIDDEN)[where], symbols[tokens], False)
    return out


class Adam:
    def __init__(self, p: Params, rate: float):
        self.rate, self.t = rate, 0
        self.m = [np.zeros_like(a) for a in p.arrays()]
        self.v = [np.zeros_like(a) for a in p.arrays()]

    def step(self, p: Params, grads: list[np.ndarray]) -> None:
        self.t += 1
        fix = self.rate * (1 - 0.999**self.t) ** 0.5 / (1 - 0.9**self.t)
        for a, g, m, v in zip(p.arrays(), grads, self.m, self.v):
            m += F32(0.1) * (g - m)
            v += F32(0.001) * (g * g - v)
            a -= F32(fix) * m / (np.sqrt(v) + F32(1e-6))


def learn(p: Params, symbols: np.ndarray, at: np.ndarray, rate: float, streams: int = STREAMS) -> None:
    """One pass over the documents by truncated backpropagation; p changes in place."""
    if not len(symbols):
        return
    adam, n = Adam(p, rate), HIDDEN
    end = symbols[at[1:] - 1][0]
    before = np.r_[end, symbols[:-1]]
    h = None
    for active, pos, live, opens in _windows(symbols, at, streams):
        h = np.zeros((active, HIDDEN), F32) if h is None else h[:active]
        kept, states, table = [], np.empty((pos.shape[1], active, HIDDEN), F32), p.inputs + p.bias
        for k in range(pos.shape[1]):
            x = pos[:, k]
            fresh = opens[x]
            h = np.where(fresh[:, None], F32(0), h)
            old = h
            h, parts = _step(p, table, h, before[x])
            kept.append((before[x], old, fresh, parts))
            states[k] = h
        where = live.T.ravel()
        tokens = pos.T.ravel()[where]
        flat = states.reshape(-1, HIDDEN)
        _, out_grads, d_states = _outputs(p, flat[where], symbols[tokens], True)
        d_all = np.zeros_like(flat)
        d_all[where] = d_states
        d_all = d_all.reshape(states.shape)
        d_inputs, d_rec = np.zeros_like(p.inputs), np.zeros_like(p.recurrent)
        d_h = np.zeros((active, HIDDEN), F32)
        given = np.empty((len(kept), active, 3 * n), F32)
        for k in range(len(kept) - 1, -1, -1):
            x, old, fresh, (keep, reset, new, carried) = kept[k]
            d = d_all[k] + d_h
            d_new = d * (1 - keep) * (1 - new * new)
            g = given[k]
            g[:, :n] = d * (old - new) * keep * (1 - keep)
            g[:, n : 2 * n] = d_new * carried * reset * (1 - reset)
            g[:, 2 * n :] = d_new
            through = g.copy()
            through[:, 2 * n :] *= reset
            d_rec += old.T @ through
            d_h = d * keep + through @ p.recurrent.T
            d_h[fresh] = 0
        flat_given = given.reshape(-1, 3 * n)
        xs = np.concatenate([k[0] for k in kept])
        order = np.argsort(xs, kind="stable")
        first = np.flatnonzero(np.r_[True, np.diff(xs[order]) != 0])
        d_inputs[xs[order][first]] = np.add.reduceat(flat_given[order], first, axis=0)
        scale = F32(1.0 / max(len(tokens), 1))
        grads = [d_inputs, d_rec, flat_given.sum(axis=0), *out_grads]
        grads = [g * scale for g in grads]
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        if norm > 1:
            grads = [g * F32(1 / norm) for g in grads]
        adam.step(p, grads)
