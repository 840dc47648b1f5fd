"""A gated recurrent network in numpy with a class-factored softmax.

A token is given by three numbers: its input row, its class, and its place within a head class (-1 in a
tail class, whose words are told apart by counts elsewhere). The network predicts the class, and in head
classes the word within the class. Texts run side by side in lanes; a lane holds texts one after the
other, its state is carried from window to window and cleared where a text begins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

Params = dict[str, np.ndarray]
F32 = np.float32


def start(inputs: int, width: int, classes: int, heads: int, members: int, class_n: np.ndarray, member_n: np.ndarray) -> Params:
    """Small random weights; the biases give the frequencies, so training starts from these."""
    rng = np.random.default_rng(1)

    def small(*shape: int) -> np.ndarray:
        return (rng.standard_normal(shape) * 0.08).astype(F32)

    return {
        "E": small(inputs, width),
        "W": small(width, 3 * width) * F32(3),
        "b": np.zeros(3 * width, F32),
        "U": small(width, 3 * width) * F32(2),
        "C": small(width, classes) * F32(0.5),
        "c": np.log((class_n + 0.5) / (class_n + 0.5).sum()).astype(F32),
        "M": small(heads, members, width) * F32(0.5),
        "m": np.where(member_n > 0, np.log(np.maximum(member_n, 1e-9)), -1e4).astype(F32),
    }


def lanes(lengths: list[int], n: int) -> list[list[int]]:
    """Texts dealt to at most ``n`` lanes of even length, longest first; lanes by falling length."""
    import heapq

    heap = [(0, k) for k in range(min(n, len(lengths)))]
    out: list[list[int]] = [[] for _ in heap]
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        size, k = heapq.heappop(heap)
        out[k].append(i)
        heapq.heappush(heap, (size + lengths[i], k))
    return sorted(out, key=lambda lane: -sum(lengths[i] for i in lane))


def windows(texts: list[np.ndarray], n_lanes: int, steps: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(tokens, text number, keep) in blocks of (steps, active lanes, ...). ``texts`` hold rows of
    (input, class, member) per step; keep is 0 where a text begins. Lanes that ended drop out; in the block
    in which a lane ends, the rest of it belongs to no text: its number is that of the texts."""
    dealt = lanes([len(t) for t in texts], n_lanes)
    if not dealt:
        return
    in_order = [i for lane in dealt for i in lane]
    lengths = np.array([len(texts[i]) for i in in_order])
    stream = np.concatenate([texts[i] for i in in_order])
    owners = np.repeat(in_order, lengths)
    keeps = np.ones(len(stream), F32)
    keeps[np.cumsum(lengths) - lengths] = 0
    sizes = np.array([sum(len(texts[i]) for i in lane) for lane in dealt])
    firsts = np.cumsum(sizes) - sizes
    for at in range(0, int(sizes[0]), steps):  # the first lane is the longest
        active = int((sizes > at).sum())
        step = np.arange(at, min(at + steps, int(sizes[0])))[:, None]
        there = step < sizes[:active]
        place = np.where(there, firsts[:active] + step, 0)
        yield stream[place] * there[..., None], np.where(there, owners[place], len(texts)), keeps[place] * there


# Blocks of states and of gates lie as (units, steps, lanes), so that a step works on long rows and a sum over
# classes adds whole rows.


def run(p: Params, table: np.ndarray, inputs: np.ndarray, keep: np.ndarray, h: np.ndarray, trace: dict | None = None) -> np.ndarray:
    """States (units, steps, lanes) after each step, from the state (units, lanes) before; ``trace`` gets what
    the way back needs. ``table`` holds the gates' input of every input row."""
    width, n_steps, n = len(h), *inputs.shape
    into = table[inputs].transpose(2, 0, 1)
    back = np.ascontiguousarray(p["U"].T)
    out = np.empty((width, n_steps, n), into.dtype)
    if trace is not None:
        trace |= {k: np.empty((rows * width, n_steps, n), into.dtype) for k, rows in (("before", 1), ("zr", 2), ("new", 1), ("gn", 1))}
    for t in range(n_steps):
        h = h * keep[t]
        a, g = into[:, t], back @ h
        zr = g[: 2 * width]
        zr += a[: 2 * width]
        np.negative(zr, out=zr)
        with np.errstate(over="ignore"):  # the reciprocal of infinity is the 0 that is meant
            np.exp(zr, out=zr)
        zr += 1
        np.reciprocal(zr, out=zr)
        new = zr[width:] * g[2 * width :]
        new += a[2 * width :]
        np.tanh(new, out=new)
        if trace is not None:
            trace["before"][:, t], trace["zr"][:, t], trace["new"][:, t], trace["gn"][:, t] = h, zr, new, g[2 * width :]
        h -= new
        h *= zr[:width]
        h += new
        out[:, t] = h
    return out


def _log_softmax(x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log probability of the rows ``own``, one per column; ``x`` becomes the probabilities before they are
    divided by their sums, which are returned too."""
    x -= x.max(axis=0)
    out = x[own, np.arange(x.shape[1])]
    np.exp(x, out=x)
    total = x.sum(axis=0)
    return out - np.log(total), total


class _Heads:
    """The columns of head words, class by class, with the logits of the words of their class."""

    def __init__(self, p: Params, h: np.ndarray, classes: np.ndarray, members: np.ndarray):
        at = np.flatnonzero(members >= 0)
        self.at = at[np.argsort(classes[at].astype(np.uint16), kind="stable")]
        self.members, self.h = members[self.at], h.take(self.at, axis=1)
        ends = np.cumsum(np.bincount(classes[self.at], minlength=1)).tolist()
        self.parts = [(k, slice(a, b)) for k, (a, b) in enumerate(zip([0, *ends], ends)) if b > a]
        self.x = np.empty((p["M"].shape[1], len(self.at)), h.dtype)
        for k, part in self.parts:
            np.add(p["M"][k] @ self.h[:, part], p["m"][k][:, None], out=self.x[:, part])


def log_probs(p: Params, h: np.ndarray, classes: np.ndarray, members: np.ndarray) -> np.ndarray:
    """Natural log of the class's probability, times that of the word in head classes. ``h`` has a row per token."""
    return _log_probs(p, h.T, classes, members)


def _log_probs(p: Params, h: np.ndarray, classes: np.ndarray, members: np.ndarray) -> np.ndarray:
    """The same with a column per token."""
    x = p["C"].T @ h
    x += p["c"][:, None]
    out, _ = _log_softmax(x, classes)
    heads = _Heads(p, h, classes, members)
    out[heads.at] += _log_softmax(heads.x, heads.members)[0]
    return out


def scores(p: Params, texts: list[np.ndarray], n_lanes: int = 256, steps: int = 32) -> np.ndarray:
    """Natural log probability of every text."""
    table = p["E"] @ p["W"] + p["b"]
    total = np.zeros(len(texts))
    h = np.zeros((p["U"].shape[0], n_lanes), F32)
    for tokens, owner, keep in windows(texts, n_lanes, steps):
        states = run(p, table, tokens[..., 0], keep, h[:, : tokens.shape[1]])
        h = states[:, -1]
        flat = _log_probs(p, states.reshape(len(h), -1), tokens[..., 1].ravel(), tokens[..., 2].ravel())
        total += np.bincount(owner.ravel(), flat, minlength=len(texts) + 1)[: len(texts)]
    return total


def gradient(p: Params, tokens: np.ndarray, keep: np.ndarray, h: np.ndarray) -> tuple[float, Params, np.ndarray]:
    """(loss, gradient, state after) of one window; gradients end at the window's first step. States of the
    window's two ends have a row per lane."""
    width, n_steps, n = h.shape[1], *tokens.shape[:2]
    inputs, classes, members = (np.ascontiguousarray(tokens[..., k]) for k in range(3))
    classes, members, trace = classes.ravel(), members.ravel(), {}
    states = run(p, p["E"] @ p["W"] + p["b"], inputs, keep, np.ascontiguousarray(h.T), trace)
    flat, inputs, every = states.reshape(width, -1), inputs.ravel(), np.arange(n_steps * n)
    g = {k: np.zeros_like(p[k]) for k in ("M", "m")}
    x = p["C"].T @ flat
    x += p["c"][:, None]
    logs, sums = _log_softmax(x, classes)
    loss = -float(logs.sum())
    x /= sums
    x[classes, every] -= 1
    g["C"], g["c"] = flat @ x.T, x.sum(axis=1)
    back = p["C"] @ x
    heads = _Heads(p, flat, classes, members)
    if len(heads.at):
        q = heads.x
        logs, sums = _log_softmax(q, heads.members)
        loss -= float(logs.sum())
        q /= sums
        q[heads.members, every[: len(heads.at)]] -= 1
        down = np.empty_like(heads.h)
        for k, part in heads.parts:
            g["M"][k], g["m"][k] = q[:, part] @ heads.h[:, part].T, q[:, part].sum(axis=1)
            down[:, part] = p["M"][k].T @ q[:, part]
        back[:, heads.at] += down
    back = back.reshape(states.shape)
    before, z, r, new = trace["before"], trace["zr"][:width], trace["zr"][width:], trace["new"]
    # what a step's gradient is multiplied by, for all steps at once
    by_new = (1 - z) * (1 - new * new)
    by_z = (before - new) * z * (1 - z)
    by_r = trace["gn"] * r * (1 - r)
    gates, to_new = np.empty((3 * width, n_steps, n), flat.dtype), np.empty_like(states)
    later, here = np.zeros((width, n), flat.dtype), np.empty((3 * width, n), flat.dtype)
    for t in range(n_steps - 1, -1, -1):
        later += back[:, t]
        dn = later * by_new[:, t]
        np.multiply(later, by_z[:, t], out=here[:width])
        np.multiply(dn, by_r[:, t], out=here[width : 2 * width])
        np.multiply(dn, r[:, t], out=here[2 * width :])
        gates[:, t], to_new[:, t] = here, dn
        later *= z[:, t]
        later += p["U"] @ here
        later *= keep[t]
    gates, before = gates.reshape(3 * width, -1), before.reshape(width, -1)
    g["U"] = before @ gates.T
    gates[2 * width :] = to_new.reshape(width, -1)  # from here on the gates' input, which r does not scale
    g["W"], g["b"] = p["E"][inputs].T @ gates.T, gates.sum(axis=1)
    to_inputs = p["W"] @ gates
    g["E"] = np.stack([np.bincount(inputs, row, minlength=len(p["E"])) for row in to_inputs], axis=1).astype(flat.dtype)
    return loss, {k: g[k] for k in p}, states[:, -1].T


def even_windows(texts: list[np.ndarray], n_lanes: int, steps: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(tokens, keep, first) in blocks of (steps, lanes, ...) for training: the texts one after the other,
    cut into lanes of one length, so that every block is full. A text that is cut goes on without its state
    in the next lane; ``first`` tells where all states begin. What is left over is a lane of its own."""
    stream = np.concatenate(texts)
    keep = np.ones(len(stream), F32)
    keep[np.cumsum([0, *(len(t) for t in texts[:-1])])] = 0
    lanes_n = max(1, min(n_lanes, len(stream) // steps))
    length = len(stream) // lanes_n
    whole = lanes_n * length
    for part, width in ((slice(0, whole), lanes_n), (slice(whole, None), 1)):
        tokens, kept = stream[part], keep[part]
        if not len(tokens):
            continue
        tokens = tokens.reshape(width, -1, tokens.shape[1]).swapaxes(0, 1)
        kept = kept.reshape(width, -1).T
        for at in range(0, len(tokens), steps):
            yield np.ascontiguousarray(tokens[at : at + steps]), np.ascontiguousarray(kept[at : at + steps]), at == 0


class Trainer:
    """Truncated backpropagation with Adam, over texts that come in pieces."""

    def __init__(self, p: Params, m: Params | None = None, v: Params | None = None, step: int = 0, n_lanes: int = 128, steps: int = 32):
        def own(x: Params | None) -> Params:
            return {k: np.zeros_like(y) if x is None else x[k].copy() for k, y in p.items()}

        self.p, self.m, self.v = own(p), own(m), own(v)
        self.step, self.seen, self._lanes, self._steps = step, 0, n_lanes, steps

    def feed(self, texts: list[np.ndarray], rate: float) -> None:
        """One pass over the texts."""
        h = None
        for tokens, keep, first in even_windows(texts, self._lanes, self._steps):
            if first:
                h = np.zeros((tokens.shape[1], self.p["U"].shape[0]), F32)
            n = tokens.shape[0] * tokens.shape[1]
            _, g, h = gradient(self.p, tokens, keep, h)
            self.step += 1
            self.seen += n
            norm = np.sqrt(sum(float(np.vdot(x, x)) for x in g.values())) / n
            scale = F32(min(1.0, 1.0 / max(norm, 1e-9)) / n)
            fix = F32(np.sqrt(1 - 0.99**self.step) / (1 - 0.9**self.step))
            for k, x in g.items():
                x *= scale
                self.m[k] += F32(0.1) * (x - self.m[k])
                self.v[k] += F32(0.01) * (x * x - self.v[k])
                self.p[k] -= F32(rate) * fix * self.m[k] / (np.sqrt(self.v[k]) + F32(1e-6))


def train(p: Params, texts: list[np.ndarray], rate: float = 0.01, n_lanes: int = 32, steps: int = 16) -> tuple[Params, int]:
    """One pass from fresh optimiser state; returns the weights and the tokens seen."""
    trainer = Trainer(p, n_lanes=n_lanes, steps=steps)
    trainer.feed(texts, rate)
    return trainer.p, trainer.seen
