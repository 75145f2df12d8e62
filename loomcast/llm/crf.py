"""Linear-chain conditional random fields on hashed features, in batches of chains."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def padded(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Layout of consecutive chains, longest first: token index per (step, chain), active chains
    per step, and the order of the chains. Empty chains are left out."""
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    begins = (np.cumsum(lengths) - lengths)[order]
    steps = int(lengths[order[0]]) if len(order) else 0
    active = len(order) - np.searchsorted(np.sort(lengths[order]), np.arange(steps), side="right")
    return np.arange(steps)[:, None] + begins[None, :], active, order


@dataclass
class ChainField:
    """Weights of features by label, of transitions, and of the first label of a chain.

    ``open_transitions`` marks transitions that may occur at all.
    """

    weights: np.ndarray
    transitions: np.ndarray
    first: np.ndarray
    open_transitions: np.ndarray

    @classmethod
    def blank(cls, features: int, labels: int, open_transitions: np.ndarray | None = None) -> ChainField:
        open_ = np.ones((labels, labels), bool) if open_transitions is None else open_transitions
        return cls(np.zeros((features, labels)), np.zeros((labels, labels)), np.zeros(labels), open_)

    def emissions(self, ids: np.ndarray) -> np.ndarray:
        """Scores by label of rows of feature ids; feature 0 is padding."""
        return self.weights[ids].sum(axis=1)

    def _potentials(self) -> np.ndarray:
        return np.where(self.open_transitions, np.exp(self.transitions), 0.0)

    def marginals(self, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Probability of each label at each token, by forward-backward."""
        return self._forward_backward(scores, lengths)[0]

    def _forward_backward(self, scores: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        index, active, _ = padded(lengths)
        steps, labels = len(active), scores.shape[1]
        link = self._potentials()
        top = scores.max(axis=1, keepdims=True)
        local = np.exp(scores - top)
        alpha, scale = np.empty_like(local), np.empty(len(local))
        for t in range(steps):
            at = index[t, : active[t]]
            a = local[at] * (np.exp(self.first) if t == 0 else alpha[index[t - 1, : active[t]]] @ link)
            c = a.sum(axis=1)
            alpha[at], scale[at] = a / c[:, None], c
        beta = np.ones_like(local)
        pairs = np.zeros((labels, labels))
        for t in range(steps - 1, 0, -1):
            at, before = index[t, : active[t]], index[t - 1, : active[t]]
            message = local[at] * beta[at] / scale[at][:, None]
            beta[before] = message @ link.T
            pairs += alpha[before].T @ message
        first = (alpha[index[0]] * beta[index[0]]).sum(axis=0) if steps else np.zeros(labels)
        return alpha * beta, pairs * link, first, float(np.log(scale).sum() + top.sum())

    def best_path(self, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Most probable labels by Viterbi; ties go to the label with the smaller number."""
        index, active, _ = padded(lengths)
        link = np.where(self.open_transitions, self.transitions, -np.inf)
        best, back = scores.copy(), np.zeros(scores.shape, np.int8)
        for t in range(len(active)):
            at = index[t, : active[t]]
            if t == 0:
                best[at] += self.first
                continue
            through = best[index[t - 1, : active[t]]][:, :, None] + link[None]
            back[at] = through.argmax(axis=1)
            best[at] += through.max(axis=1)
        path = np.zeros(len(scores), np.int8)
        for t in range(len(active) - 1, -1, -1):
            n = active[t]
            ending = active[t + 1] if t + 1 < len(active) else 0
            at = index[t, :n]
            path[at[ending:]] = best[at[ending:]].argmax(axis=1)
            if ending:
                after = index[t + 1, :ending]
                path[at[:ending]] = back[after, path[after]]
        return path

    def fit(
        self, words: np.ndarray, tokens: np.ndarray, labels: np.ndarray, lengths: np.ndarray,
        epochs: int = 60, rate: float = 0.1, ridge: float = 1.0,
    ) -> ChainField:
        """Maximum likelihood with a ridge, by full-batch Adam.

        ``words`` has the feature ids of distinct tokens, ``tokens`` their numbers in the chains
        one after another.
        """
        n_labels = self.weights.shape[1]
        observed = np.zeros((len(tokens), n_labels))
        observed[np.arange(len(tokens)), labels] = 1.0
        begins = np.cumsum(lengths) - lengths
        inner = np.ones(len(tokens), bool)
        inner[begins[lengths > 0]] = False
        seen_pairs = np.zeros((n_labels, n_labels))
        np.add.at(seen_pairs, (labels[np.flatnonzero(inner) - 1], labels[inner]), 1)
        seen_first = observed[begins[lengths > 0]].sum(axis=0)
        flat = words.ravel()
        used = np.unique(flat)
        params = [self.weights, self.transitions, self.first]
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
        for epoch in range(1, epochs + 1):
            probable, pairs, first, _ = self._forward_backward(self.emissions(words)[tokens], lengths)
            off = observed - probable
            by_word = np.stack([np.bincount(tokens, off[:, k], len(words)) for k in range(n_labels)], axis=1)
            spread = np.repeat(by_word, words.shape[1], axis=0)
            grad = np.stack([np.bincount(flat, spread[:, k], len(self.weights)) for k in range(n_labels)], axis=1)
            grads = [grad - ridge * self.weights, seen_pairs - pairs - ridge * self.transitions, seen_first - first - ridge * self.first]
            for p, g, (m, v) in zip(params, grads, moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p += rate * (m / (1 - 0.9**epoch)) / (np.sqrt(v / (1 - 0.99**epoch)) + 1e-8)
            self.weights[0] = 0.0
        keep = np.zeros(len(self.weights), bool)
        keep[used] = True
        self.weights[~keep] = 0.0
        return self
