"""A character-level bidirectional LSTM with CRF transitions, trained and applied in numpy.

Arrays are laid out as (step, unit, row): the rows of a batch are neighbours in memory, and
gates are slices. Two small LSTMs read the characters' classes forwards and backwards; a
linear layer gives a score per label, and the CRF adds one per pair of neighbouring labels.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

UNITS = 8


def _sigmoid_tanh(gates: np.ndarray, units: int) -> None:
    """In place: the logistic function of the first three blocks, tanh of the last."""
    gates[: 3 * units] *= 0.5
    np.tanh(gates, out=gates)
    gates[: 3 * units] *= 0.5
    gates[: 3 * units] += 0.5


@dataclass
class Tagger:
    inputs: list[np.ndarray]  # per direction: (4 units, classes), what a class adds to the gates
    recurrent: list[np.ndarray]  # per direction: (4 units, units)
    output: np.ndarray  # (labels, 2 units)
    bias: np.ndarray  # (labels, 1)
    transitions: np.ndarray  # (from, to)

    @classmethod
    def new(cls, classes: int, labels: int, units: int = UNITS, seed: int = 6) -> Tagger:
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.standard_normal(shape) * 0.4).astype(np.float32)
        inputs = [draw(4 * units, classes), draw(4 * units, classes)]
        for table in inputs:
            table[units : 2 * units] += 1.0  # remember at first
        return cls(
            inputs, [draw(4 * units, units), draw(4 * units, units)], draw(labels, 2 * units),
            np.zeros((labels, 1), np.float32), np.zeros((labels, labels), np.float32),
        )

    def parameters(self) -> list[np.ndarray]:
        return [*self.inputs, *self.recurrent, self.output, self.bias, self.transitions]

    def _run(self, symbols: np.ndarray, way: int, caches: list | None = None) -> np.ndarray:
        """Hidden states (step, unit, row) of one direction; ``symbols`` is (step, row)."""
        steps, rows = symbols.shape
        table, recurrent = self.inputs[way], self.recurrent[way]
        units = recurrent.shape[1]
        hidden = np.zeros((steps, units, rows), np.float32)
        state, cell = np.zeros((units, rows), np.float32), np.zeros((units, rows), np.float32)
        gates, drive = np.empty((4 * units, rows), np.float32), np.empty((4 * units, rows), np.float32)
        for step in range(steps) if way == 0 else range(steps - 1, -1, -1):
            np.matmul(recurrent, state, out=gates)
            np.take(table, symbols[step], axis=1, out=drive, mode="clip")
            gates += drive
            _sigmoid_tanh(gates, units)
            enter, keep, leave, new = gates[:units], gates[units : 2 * units], gates[2 * units : 3 * units], gates[3 * units :]
            if caches is not None:
                caches.append((step, state, cell, gates.copy()))
            cell = keep * cell
            cell += enter * new
            state = hidden[step]
            np.tanh(cell, out=state)
            state *= leave
        return hidden

    def emissions(self, symbols: np.ndarray) -> np.ndarray:
        """Scores (step, label, row)."""
        units = self.recurrent[0].shape[1]
        scores = np.matmul(self.output[:, :units], self._run(symbols, 0))
        scores += np.matmul(self.output[:, units:], self._run(symbols, 1))
        scores += self.bias
        return scores

    def decode(self, symbols: np.ndarray) -> np.ndarray:
        """The best label sequence (step, row) of every row."""
        scores = self.emissions(symbols)
        best = np.zeros(symbols.shape, dtype=np.int8)
        # Label 0 throughout is best wherever no other label gains by itself and two transitions.
        gain = (self.transitions - self.transitions[0, 0]).max()
        lead = scores[:, 1:].max(axis=1) - scores[:, 0]
        open_rows = np.flatnonzero((lead + 2.0 * max(gain, 0.0) > 0).any(axis=0))
        if len(open_rows):
            best[:, open_rows] = self._viterbi(np.ascontiguousarray(scores[:, :, open_rows]))
        return best

    def _viterbi(self, scores: np.ndarray) -> np.ndarray:
        steps, labels, rows = scores.shape
        back = np.zeros((steps, labels, rows), dtype=np.int8)
        total = scores[0]
        for step in range(1, steps):
            ways = total[:, None, :] + self.transitions[:, :, None]
            back[step] = ways.argmax(axis=0)
            total = ways.max(axis=0) + scores[step]
        best = np.zeros((steps, rows), dtype=np.int8)
        best[-1] = total.argmax(axis=0)
        for step in range(steps - 1, 0, -1):
            best[step - 1] = np.take_along_axis(back[step], best[step][None].astype(np.int64), axis=0)[0]
        return best

    def _crf(self, scores: np.ndarray, labels: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Mean loss per row, and its slopes by score and by transition."""
        steps, kinds, rows = scores.shape
        ahead = np.zeros((steps, kinds, rows))
        after = np.zeros((steps, kinds, rows))
        ahead[0] = scores[0]
        for step in range(1, steps):
            ahead[step] = _log_sum(ahead[step - 1][:, None] + self.transitions[:, :, None], 0) + scores[step]
        for step in range(steps - 2, -1, -1):
            after[step] = _log_sum(self.transitions[:, :, None] + (scores[step + 1] + after[step + 1])[None], 1)
        whole = _log_sum(ahead[-1], 0)
        one = np.eye(kinds)[labels].transpose(0, 2, 1)  # (step, label, row)
        slope = np.exp(ahead + after - whole) - one
        pair = np.zeros((kinds, kinds))
        for step in range(1, steps):
            ways = ahead[step - 1][:, None] + self.transitions[:, :, None] + (scores[step] + after[step])[None] - whole
            pair += np.exp(ways).sum(axis=2)
        np.subtract.at(pair, (labels[:-1].ravel(), labels[1:].ravel()), 1.0)
        path = (scores * one).sum(axis=(0, 1)) + self.transitions[labels[:-1], labels[1:]].sum(axis=0)
        return float((whole - path).mean()), slope / rows, pair / rows

    def slopes(self, symbols: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Loss and its slope by every parameter, by back-propagation through time."""
        units, classes = self.recurrent[0].shape[1], self.inputs[0].shape[1]
        caches: list[list] = [[], []]
        hidden = np.concatenate([self._run(symbols, way, caches[way]) for way in (0, 1)], axis=1)
        scores = np.matmul(self.output, hidden) + self.bias
        loss, by_score, by_pair = self._crf(scores.astype(np.float64), labels)
        by_score = by_score.astype(np.float32)
        by_output = np.einsum("slr,sur->lu", by_score, hidden)
        by_hidden = np.matmul(self.output.T, by_score)
        by_input, by_recurrent = [], []
        for way in (0, 1):
            table = np.zeros((4 * units, classes), np.float32)
            recurrent = np.zeros((4 * units, units), np.float32)
            own = by_hidden[:, way * units : (way + 1) * units]
            flow, by_cell = np.zeros_like(own[0]), np.zeros_like(own[0])
            for step, state, cell, gates in reversed(caches[way]):
                enter, keep, leave, new = (gates[k * units : (k + 1) * units] for k in range(4))
                squashed = np.tanh(keep * cell + enter * new)
                flow = flow + own[step]
                by_cell = by_cell + flow * leave * (1 - squashed**2)
                back = np.concatenate(
                    [
                        by_cell * new * enter * (1 - enter),
                        by_cell * cell * keep * (1 - keep),
                        flow * squashed * leave * (1 - leave),
                        by_cell * enter * (1 - new**2),
                    ]
                )
                recurrent += back @ state.T
                table += back @ np.eye(classes, dtype=np.float32)[symbols[step]]
                flow, by_cell = self.recurrent[way].T @ back, by_cell * keep
            by_input.append(table)
            by_recurrent.append(recurrent)
        return loss, [*by_input, *by_recurrent, by_output, by_score.sum(axis=(0, 2))[:, None], by_pair]

    def train(self, symbols: np.ndarray, labels: np.ndarray, rounds: int, rows: int = 128, rate: float = 0.02, seed: int = 7) -> float:
        """Adam over shuffled batches of rows; the loss of the last round."""
        rng, turn, loss = np.random.default_rng(seed), 0, 0.0
        held = self.parameters()
        first, second = [np.zeros_like(p) for p in held], [np.zeros_like(p) for p in held]
        for number in range(rounds):
            order, losses = rng.permutation(symbols.shape[1]), []
            pace = rate * (1 - 0.9 * number / rounds)
            for at in range(0, len(order), rows):
                chosen = order[at : at + rows]
                found, slopes = self.slopes(symbols[:, chosen], labels[:, chosen])
                losses.append(found)
                turn += 1
                for p, m, v, g in zip(held, first, second, slopes, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    p -= pace * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-6)
            loss = float(np.mean(losses))
        return loss


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    most = values.max(axis=axis, keepdims=True)
    return np.log(np.exp(values - most).sum(axis=axis)) + most.squeeze(axis)
