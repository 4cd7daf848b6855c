"""A hidden Markov model over symbols: expected counts (Baum-Welch) and exact likelihoods.

Texts are cut into lanes of equal length that advance together. The product of a lane's step
matrices carries the state across its ends, so cutting changes nothing: counts and likelihoods are
those of the whole sequence.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Symbols that one lane holds, and lanes that are worked on together.
LANE, TOGETHER = 512, 1024


@dataclass
class Model:
    """start (K), move (K, K) and emit (symbols, K), each a distribution."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


@dataclass
class Counts:
    """Expected starts, transitions and emissions, and the log likelihood they come from."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray
    log: float = 0.0

    @staticmethod
    def none(states: int, symbols: int) -> Counts:
        return Counts(np.zeros(states), np.zeros((states, states)), np.zeros((symbols, states)))

    def __add__(self, other: Counts) -> Counts:
        return Counts(
            self.start + other.start, self.move + other.move, self.emit + other.emit,
            self.log + other.log,
        )

    def flat(self) -> np.ndarray:
        return np.concatenate((self.start, self.move.ravel(), self.emit.ravel(), [self.log]))

    @staticmethod
    def of_flat(flat: np.ndarray, states: int, symbols: int) -> Counts:
        start, move, emit, log = np.split(flat, np.cumsum([states, states**2, symbols * states]))
        return Counts(start, move.reshape(states, states), emit.reshape(symbols, states), float(log[0]))


def estimate(counts: Counts, smoothing: float = 0.1) -> Model:
    """The model that the counts give. Rare symbols lean on the whole corpus."""
    overall = counts.emit.sum(axis=1) + 1e-3
    overall /= overall.sum()
    emit = counts.emit + smoothing * len(overall) * overall[:, None]
    move = counts.move + 1.0
    start = counts.start + 1.0
    return Model(
        start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0)
    )


class Lanes:
    """The sequences of a batch, cut into lanes; all sequences have at least one symbol."""

    def __init__(self, sequences: list[np.ndarray]):
        sizes = np.array([len(x) for x in sequences], dtype=np.int64)
        self.n = len(sequences)
        per = (sizes + LANE - 1) // LANE
        self.first = np.cumsum(per) - per
        self.per = per
        owner = np.repeat(np.arange(self.n), per)
        self.index = np.arange(per.sum()) - self.first[owner]
        offsets = np.cumsum(sizes) - sizes
        self.begin = offsets[owner] + self.index * LANE
        self.size = np.minimum(LANE, offsets[owner] + sizes[owner] - self.begin)
        self.flat = np.concatenate(sequences) if self.n else np.zeros(0, np.int64)

    def groups(self, lanes: np.ndarray):
        """Lanes in groups, the longest first: (lanes, symbols by step and lane, lanes alive)."""
        lanes = lanes[np.argsort(-self.size[lanes], kind="stable")]
        for k in range(0, len(lanes), TOGETHER):
            own = lanes[k : k + TOGETHER]
            sizes = self.size[own]
            steps = np.arange(sizes[0])
            at = self.begin[own][None, :] + np.minimum(steps[:, None], sizes[None, :] - 1)
            alive = np.searchsorted(-sizes, -steps, side="left")
            yield own, self.flat[at], alive

    def products(self, model: Model) -> tuple[np.ndarray, np.ndarray]:
        """For lanes of sequences with several: the product of their steps, scaled, and its log."""
        states = len(model.start)
        out = np.zeros((len(self.size), states, states))
        logs = np.zeros(len(self.size))
        several = np.flatnonzero(np.repeat(self.per, self.per) > 1)
        for own, symbols, alive in self.groups(several):
            x = np.eye(states)[None] * model.emit[symbols[0]][:, None, :]
            log = np.zeros(len(own))
            for t in range(len(symbols)):
                n = alive[t]
                if t:
                    x[:n] = (x[:n].reshape(-1, states) @ model.move).reshape(n, states, states)
                    x[:n] *= model.emit[symbols[t, :n]][:, None, :]
                if t % 8 == 0 or t == len(symbols) - 1 or alive[t + 1] < n:
                    scale = x[:n].sum(axis=(1, 2))
                    x[:n] /= scale[:, None, None]
                    log[:n] += np.log(scale)
            out[own], logs[own] = x, log
        return out, logs

    def across(self, model: Model):
        """Priors of all lanes (before their first symbol), logs of all sequences with several
        lanes, and the products."""
        products, logs = self.products(model)
        priors = np.tile(model.start, (len(self.size), 1))
        total = np.zeros(self.n)
        for j in range(int(self.per.max(initial=0))):
            docs = np.flatnonzero((self.per > j) & (self.per > 1))
            lanes = self.first[docs] + j
            end = np.einsum("nk,nkl->nl", priors[lanes], products[lanes])
            scale = end.sum(axis=1)
            end /= scale[:, None]
            total[docs] += np.log(scale) + logs[lanes]
            more = self.per[docs] > j + 1
            priors[lanes[more] + 1] = end[more] @ model.move
        return priors, total, products


def log_likelihoods(model: Model, sequences: list[np.ndarray]) -> np.ndarray:
    """The natural log of each sequence's probability, by the scaled forward recursion."""
    lanes = Lanes(sequences)
    _, total, _ = lanes.across(model)
    for own, symbols, alive in lanes.groups(np.flatnonzero(np.repeat(lanes.per, lanes.per) == 1)):
        docs = np.searchsorted(lanes.first, own, side="right") - 1
        log = np.zeros(len(own))
        alpha = np.tile(model.start, (len(own), 1))
        for t in range(len(symbols)):
            n = alive[t]
            now = (alpha[:n] @ model.move if t else alpha[:n]) * model.emit[symbols[t, :n]]
            scale = now.sum(axis=1)
            alpha[:n] = now / scale[:, None]
            log[:n] += np.log(scale)
        total[docs] = log
    return total


def expected_counts(model: Model, sequences: list[np.ndarray]) -> Counts:
    """What the sequences are expected to have used, by the forward-backward recursion."""
    states, symbols_n = len(model.start), len(model.emit)
    out = Counts.none(states, symbols_n)
    lanes = Lanes(sequences)
    priors, total, products = lanes.across(model)
    # What follows a lane's end, from the last lane back.
    ends = np.ones((len(lanes.size), states))
    for j in range(int(lanes.per.max(initial=0)) - 1, 0, -1):
        later = lanes.first[lanes.per > j] + j
        ahead = np.einsum("nkl,nl->nk", products[later], ends[later])
        before = ahead @ model.move.T
        ends[later - 1] = before / before.sum(axis=1, keepdims=True)
    move = np.zeros((states, states))
    for own, symbols, alive in lanes.groups(np.arange(len(lanes.size))):
        alphas = np.zeros((len(symbols), len(own), states))
        log = np.zeros(len(own))
        for t in range(len(symbols)):
            n = alive[t]
            now = (alphas[t - 1, :n] @ model.move if t else priors[own]) * model.emit[symbols[t, :n]]
            scale = now.sum(axis=1)
            alphas[t, :n] = now / scale[:, None]
            log[:n] += np.log(scale)
        single = lanes.per[np.searchsorted(lanes.first, own, side="right") - 1] == 1
        out.log += float(log[single].sum())
        beta = ends[own].copy()
        for t in range(len(symbols) - 1, -1, -1):
            n = alive[t]
            if t == len(symbols) - 1 or alive[t + 1] < n:  # lanes that end here
                fresh = slice(0 if t == len(symbols) - 1 else alive[t + 1], n)
                beta[fresh] /= (alphas[t, fresh] * beta[fresh]).sum(axis=1, keepdims=True)
            if t:
                ahead = model.emit[symbols[t, :n]] * beta[:n]
                before = ahead @ model.move.T
                scale = (alphas[t - 1, :n] * before).sum(axis=1, keepdims=True)
                move += (alphas[t - 1, :n] / scale).T @ ahead
                alphas[t, :n] *= beta[:n]
                beta[:n] = before / scale
            else:
                alphas[0, :n] *= beta[:n]
        live = np.arange(len(own))[None, :] < alive[: len(symbols), None]
        used, weights = symbols[live], alphas[live]
        for k in range(states):
            out.emit[:, k] += np.bincount(used, weights[:, k], minlength=symbols_n)
        out.start += alphas[0][lanes.index[own] == 0].sum(axis=0)
    # Steps from one lane to the next.
    for j in range(1, int(lanes.per.max(initial=0))):
        later = lanes.first[lanes.per > j] + j
        end = np.einsum("nk,nkl->nl", priors[later - 1], products[later - 1])
        end /= end.sum(axis=1, keepdims=True)
        ahead = np.einsum("nkl,nl->nk", products[later], ends[later])
        scale = np.einsum("nk,kl,nl->n", end, model.move, ahead)
        move += (end / scale[:, None]).T @ ahead
    out.move += move * model.move
    out.log += float(total.sum())
    return out


def first_guess(counts: np.ndarray, states: int, seed: int) -> Model:
    """Emissions that differ at random around those of the whole corpus, in states that last."""
    rng = np.random.default_rng(seed)
    emit = (counts[:, None] + 1e-3) * rng.gamma(2.0, size=(len(counts), states))
    move = 1.0 + np.eye(states) * states
    return Model(
        np.full(states, 1 / states), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0)
    )
