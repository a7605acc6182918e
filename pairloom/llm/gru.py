"""A gated recurrent language model in numpy, with a class-factored output softmax.

Token ids go from the most frequent on and fall into classes of neighbouring ids, about as many as
the square root of their number: few ids to a class where they are frequent. A token's probability is
that of its class times that of the token within the class. Texts run side by side in lanes; a
lane's state goes on from window to window and is zero where a text begins. Only the rows that a
window meets are updated: those of its tokens in, and of its targets' classes out.
"""

from __future__ import annotations

import heapq

import numpy as np

HIDDEN = 16
SIZE = 1024              # ids of a small network; `initial` takes any number
START = -1               # the last input row
LANES = 256             # of scoring
WINDOW = 16              # tokens of a lane between updates
LONGEST = 128            # of them, where few lanes are left
WIDE = 2048              # lanes of training
NARROW = 256             # of them, run in the first windows
WIDEN = 1 << 7           # tokens learnt from for each lane that later ones have
STRETCH = 1 << 10        # tokens of a lane that are laid out at once
BLOCK = 1 << 17          # logits computed at once
LEAST = 1 << 12          # tokens of a window that is learnt from at the full rate
READY = 32               # targets of a class between updates of its rows

PARTS = ("input", "state", "class_w", "class_b", "word_w", "word_b")
#: One step size to a row, by the squares of all its gradients; the others are learnt by Adam.
ROWS = ("input", "word_w", "word_b")

#: Arrays by name: PARTS, and `bounds`, the first id of each class and the number of ids.
Params = dict[str, np.ndarray]


def class_bounds(share: np.ndarray) -> np.ndarray:
    """Classes that grow while their share of the tokens times their number of ids is at most one.

    A class costs every token one logit, and the tokens of the class as many as it has ids.
    """
    upto = np.concatenate([[0], np.cumsum(share)]) / share.sum()
    bounds = [0]
    for i in range(1, len(share)):
        if (upto[i + 1] - upto[bounds[-1]]) * (i + 1 - bounds[-1]) > 1:
            bounds.append(i)
    return np.array([*bounds, len(share)])


def initial(counts: np.ndarray) -> Params:
    """Small random weights; output biases that give each id its share of counts."""
    share = np.asarray(counts, float) + 0.5
    bounds = class_bounds(share)
    size, classes = len(share), len(bounds) - 1
    rng = np.random.default_rng(11)
    shapes = {"input": (size + 1, 3 * HIDDEN),      # for update, reset and new state
              "state": (HIDDEN, 3 * HIDDEN), "class_w": (HIDDEN, classes),
              "word_w": (size, HIDDEN)}
    p = {n: rng.standard_normal(s, np.float32) * np.float32(0.1) for n, s in shapes.items()}
    of_class = np.add.reduceat(share, bounds[:-1])
    p["class_b"] = np.log(of_class).astype(np.float32)
    p["class_b"] -= p["class_b"].max()
    p["word_b"] = np.log(share / np.repeat(of_class, np.diff(bounds))).astype(np.float32)
    return p | {"bounds": bounds}


def flat(p: Params) -> np.ndarray:
    return np.concatenate([p[n].ravel() for n in PARTS])


def unflat(like: Params, values: np.ndarray) -> Params:
    out, at = {"bounds": like["bounds"]}, 0
    for name in PARTS:
        size = like[name].size
        out[name] = values[at:at + size].reshape(like[name].shape).astype(np.float32)
        at += size
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _step(p: Params, tokens: np.ndarray, h: np.ndarray):
    """The next state, and the gates for a backward step."""
    given = p["input"][tokens]
    gates = _sigmoid(given[:, :2 * HIDDEN] + h @ p["state"][:, :2 * HIDDEN])
    update, reset = gates[:, :HIDDEN], gates[:, HIDDEN:]
    kept = reset * h
    new = np.tanh(given[:, 2 * HIDDEN:] + kept @ p["state"][:, 2 * HIDDEN:])
    return h + update * (new - h), (gates, kept, new)


def _exps(states, weights, bias, chosen):
    """exp(logits), a row to a class so that sums run along whole rows; sums; logits chosen."""
    logits = weights @ states.T
    logits += bias[:, None]
    found = logits[chosen, np.arange(len(states))]
    with np.errstate(over="ignore"):
        exps = np.exp(logits, out=logits)
    ones = np.ones(len(weights), exps.dtype)
    sums = ones @ exps                       # many times as fast as sum(0) where tokens are few
    if not (np.isfinite(sums).all() and sums.min() > 0):
        logits = weights @ states.T + bias[:, None]
        top = logits.max(0)
        exps, found = np.exp(logits - top), found - top
        sums = ones @ exps
    return exps, sums, found


def _blocks(begin: int, end: int, classes: int):
    """Slices of few enough tokens for their logits to stay in cache."""
    step = max(16, BLOCK // classes)
    return [slice(i, min(i + step, end)) for i in range(begin, end, step)]


def _by_class(p: Params, targets: np.ndarray):
    """The class of each target, targets' places by class, and (class, first id, last, begin, end
    among those places) of the classes met."""
    bounds = p["bounds"].astype(np.int64)
    group = np.searchsorted(bounds, targets, side="right") - 1
    order = np.argsort(group.astype(np.int16), kind="stable")
    ends = np.searchsorted(group[order], np.arange(len(bounds)))
    met = np.flatnonzero(np.diff(ends))
    return group, order, list(zip(bounds[met].tolist(), bounds[met + 1].tolist(),
                                  ends[met].tolist(), ends[met + 1].tolist()))


def log_probability(p: Params, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Natural logarithm of the probability of each target, given the state before it."""
    group, order, met = _by_class(p, targets)
    out, of_word = np.empty((2, len(targets)), states.dtype)
    weights = np.ascontiguousarray(p["class_w"].T)
    for part in _blocks(0, len(targets), len(weights)):
        _, sums, found = _exps(states[part], weights, p["class_b"], group[part])
        out[part] = found - np.log(sums)
    states, targets = states[order], targets[order]
    for first, last, begin, end in met:
        for part in _blocks(begin, end, last - first):
            _, sums, found = _exps(states[part], p["word_w"][first:last],
                                   p["word_b"][first:last], targets[part] - first)
            of_word[part] = found - np.log(sums)
    out[order] += of_word
    return out


def score(p: Params, tokens: np.ndarray, counts: np.ndarray, lanes: int = LANES) -> np.ndarray:
    """Log-probability of every token of whole texts; counts: tokens of each text, in order.

    Texts go to the lane that is least full, longest first; lanes end one by one, so that a very
    long text does not make the others wait.
    """
    texts = np.flatnonzero(counts)
    out = np.empty(len(tokens))
    if not len(texts):
        return out
    begin = np.cumsum(counts) - counts
    load = [(0, lane) for lane in range(min(lanes, len(texts)))]
    members: list[list[int]] = [[] for _ in load]
    for text in texts[np.argsort(-counts[texts], kind="stable")]:
        size, lane = heapq.heappop(load)
        members[lane].append(text)
        heapq.heappush(load, (size + int(counts[text]), lane))
    members.sort(key=lambda m: -int(counts[m].sum()))
    order = np.array([t for m in members for t in m])
    sizes = counts[order]
    # The place in `tokens` of each token in lane order.
    place = np.repeat(begin[order] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    stream = tokens[place]
    starts = np.zeros(len(stream), bool)
    starts[np.cumsum(sizes) - sizes] = True
    previous = np.where(starts, START, np.concatenate([[START], stream[:-1]]))
    lengths = np.array([int(counts[m].sum()) for m in members])
    lane_begin = np.cumsum(lengths) - lengths
    states = np.empty((len(stream), HIDDEN), np.float32)
    h = np.zeros((len(members), HIDDEN), np.float32)
    live = len(members)
    for t in range(lengths[0]):
        while lengths[live - 1] <= t:
            live -= 1
        at = lane_begin[:live] + t
        h = h[:live] * ~starts[at, None]
        h, _ = _step(p, previous[at], h)
        states[at] = h
    for i in range(0, len(stream), 1 << 16):
        part = slice(i, i + (1 << 16))
        out[place[part]] = log_probability(p, states[part], stream[part])
    return out


def _back(states, weights, bias, chosen):
    """Errors and states, whose product is the gradient of weights and bias (last column), and
    the gradient of the states. Errors are not divided by their sums; the states are."""
    exps, sums, _ = _exps(states, weights, bias, chosen)
    exps[chosen, np.arange(len(states))] -= sums
    own = np.empty((len(states), HIDDEN + 1), states.dtype)
    np.divide(states, sums[:, None], out=own[:, :-1])
    own[:, -1] = 1 / sums
    return exps, own, (weights.T @ exps / sums).T


class Trainer:
    """Truncated backpropagation over a stream of texts, with Adam and, for rows, Adagrad.

    Every text runs in one lane, whose state goes on from window to window and from one stretch of
    the stream to the next. Windows are narrow at first, and wider the more has been learnt; where
    few lanes are left, which hold the longest texts, windows are longer instead. A
    class's rows are updated once `ready` targets of it have been met, so that the many rows of a
    rare class cost no more than its few targets do.
    """

    def __init__(self, p: Params, rate: float = 0.01, row_rate: float = 0.05,
                 ready: int = READY):
        self.p = {n: v.copy() for n, v in p.items()}
        self.rate, self.row_rate, self.updates, self.tokens = rate, row_rate, 0, 0
        dense = [n for n in PARTS if n not in ROWS]
        self.first = {n: np.zeros_like(p[n]) for n in dense}
        self.second = {n: np.zeros_like(p[n]) for n in dense}
        self.squares = {n: np.zeros(len(p[n]), np.float32) for n in ROWS}
        # Gradients; of ROWS only those of `met` hold.
        self.grads = {n: np.zeros_like(p[n]) for n in ROWS}
        self.met: dict[str, list] = {n: [] for n in ROWS}
        # Errors and states of the targets of each class that its rows have not been updated by.
        self.ready = ready
        self.errors: dict[int, list] = {}
        # What waits in each lane: arrays of tokens before, and tokens.
        self.held: list[list] = [[] for _ in range(WIDE)]
        self.waiting = np.zeros(WIDE, np.int64)
        self.states = np.zeros((WIDE, HIDDEN), np.float32)
        self.lane, self.before = 0, START

    def feed(self, tokens: np.ndarray, starts: np.ndarray, last: bool = False) -> None:
        """Learn from a stretch of the stream; what does not fill the lanes waits for the next."""
        if len(tokens):
            pairs = np.empty((2, len(tokens)), np.int32)
            pairs[0, 0], pairs[0, 1:], pairs[1] = self.before, tokens[:-1], tokens
            pairs[0, starts] = START
            self.before = tokens[-1]
            cuts = np.unique(np.concatenate([[0], np.flatnonzero(starts), [len(tokens)]])).tolist()
            free = [(n, lane) for lane, n in enumerate(self.waiting.tolist())]
            heapq.heapify(free)
            for begin, end in zip(cuts, cuts[1:]):
                if starts[begin]:
                    self.lane = free[0][1]
                    heapq.heapreplace(free, (free[0][0] + end - begin, self.lane))
                self.held[self.lane].append(pairs[:, begin:end])
                self.waiting[self.lane] += end - begin
        while True:
            width = min(max(self.tokens // WIDEN, NARROW), WIDE * 3 // 4)
            live = np.argsort(-self.waiting, kind="stable")[:width]
            live = live[self.waiting[live] > 0]
            if not len(live) or not last and self.waiting[live[-1]] < WINDOW:
                break
            self._run(live, self.waiting[live[0 if last else -1]] // WINDOW * WINDOW or WINDOW)
        if last:
            self._flush()

    def _run(self, live: np.ndarray, length: int) -> None:
        """Learn from what waits in some lanes, fullest first."""
        length = min(length, STRETCH)
        sizes = np.minimum(self.waiting[live], length)
        grid = np.full((2, len(live), length), START, np.int32)
        for row, (lane, size) in enumerate(zip(live, sizes)):
            joined = np.concatenate(self.held[lane], axis=1)
            grid[:, row, :size] = joined[:, :size]
            self.held[lane] = [joined[:, size:]] if size < joined.shape[1] else []
        self.waiting[live] -= sizes
        h = self.states[live]
        t = 0
        while t < length:
            n = np.searchsorted(-sizes, -t)            # lanes that go on beyond t
            end = min(t + min(max(LEAST // n, WINDOW), LONGEST), length)
            given, targets = grid[:, :n, t:end]
            valid = np.arange(t, end) < sizes[:n, None]
            h[:n] = self._window(h[:n], given, targets, valid & (given == START), valid)
            t = end
        self.states[live] = h

    def _window(self, h, given, targets, starts, valid=None):
        """The states after a window; what is not valid ends a lane and has no target."""
        p, lanes, length = self.p, *given.shape
        at = slice(None) if valid is None or valid.all() else np.flatnonzero(valid.T)
        states = np.empty((length, lanes, HIDDEN), np.float32)
        trail = []
        for t in range(length):
            before = h * ~starts[:, t, None]
            h, gates = _step(p, given[:, t], before)
            states[t] = h
            trail.append((before, gates))
        targets = targets.T.ravel()[at]
        grads, d_found = self._output(states.reshape(-1, HIDDEN)[at], targets)
        d_states = np.zeros_like(states)
        d_states.reshape(-1, HIDDEN)[at] = d_found
        d_input = np.empty((length, lanes, 3 * HIDDEN), np.float32)
        d_state = np.zeros_like(p["state"])
        to_gates, to_new = p["state"][:, :2 * HIDDEN], p["state"][:, 2 * HIDDEN:]
        d_h = np.zeros((lanes, HIDDEN), np.float32)
        for t in range(length - 1, -1, -1):
            before, (gates, kept, new) = trail[t]
            update, reset = gates[:, :HIDDEN], gates[:, HIDDEN:]
            d_h = d_h + d_states[t]
            d_new = d_h * update * (1 - new * new)
            d_kept = d_new @ to_new.T
            d_gates = np.concatenate([d_h * (new - before), d_kept * before], axis=1)
            d_gates *= gates * (1 - gates)
            d_input[t, :, :2 * HIDDEN], d_input[t, :, 2 * HIDDEN:] = d_gates, d_new
            d_state[:, :2 * HIDDEN] += before.T @ d_gates
            d_state[:, 2 * HIDDEN:] += kept.T @ d_new
            d_h = d_h * (1 - update) + d_kept * reset + d_gates @ to_gates.T
            d_h *= ~starts[:, t, None]
        used = given.T.ravel() % len(p["input"])
        order = np.argsort(used, kind="stable")
        token, first = np.unique(used[order], return_index=True)
        self.grads["input"][token] = np.add.reduceat(
            d_input.reshape(-1, 3 * HIDDEN)[order], first, axis=0)
        self.met["input"] = [token]
        self._update({**grads, **self.grads, "state": d_state}, len(targets))
        return h

    def _output(self, states, targets):
        """Gradients of the output layer, and of the states."""
        p = self.p
        group, order, met = _by_class(p, targets)
        weights = np.ascontiguousarray(p["class_w"].T)
        d_class = np.zeros((len(weights), HIDDEN + 1), states.dtype)
        d_states = np.empty_like(states)
        for part in _blocks(0, len(targets), len(weights)):
            errors, own, d_states[part] = _back(states[part], weights, p["class_b"], group[part])
            d_class += errors @ own
        grads = {"class_w": d_class[:, :-1].T, "class_b": d_class[:, -1]}
        self.met["word_w"] = self.met["word_b"] = rows = []
        states, targets = states[order], targets[order]
        d_sorted = np.empty_like(states)
        for first, last, begin, end in met:
            found = []
            for part in _blocks(begin, end, last - first):
                errors, own, d_sorted[part] = _back(
                    states[part], p["word_w"][first:last], p["word_b"][first:last],
                    targets[part] - first)
                found.append((errors, own))
            number = end - begin
            if first in self.errors or number < self.ready:
                held = self.errors.setdefault(first, [0, last, []])
                held[0] += number
                held[2] += found
                number, _, found = held
            if number >= self.ready:
                self.errors.pop(first, None)
                rows.append(self._row_grads(first, last, found))
        d_states[order] += d_sorted
        return grads, d_states

    def _row_grads(self, first, last, found) -> slice:
        """Gradients of the rows of a class."""
        total = found[0][0] @ found[0][1]
        for errors, own in found[1:]:
            total += errors @ own
        self.grads["word_w"][first:last], self.grads["word_b"][first:last] = (
            total[:, :-1], total[:, -1])
        return slice(first, last)

    def _flush(self) -> None:
        """Update rows by all targets that still wait."""
        self.met = {"input": []}
        self.met["word_w"] = self.met["word_b"] = [
            self._row_grads(first, last, errors)
            for first, (_, last, errors) in self.errors.items()]
        self.errors = {}
        self._update_rows(self.grads)

    def _update(self, grads: Params, tokens: int) -> None:
        self.updates += 1
        self.tokens += tokens
        rate = self.rate * min(1, tokens / LEAST)
        fade1, fade2 = 1 - 0.9 ** self.updates, 1 - 0.99 ** self.updates
        for name in self.first:
            g = grads[name] / tokens
            m, v = self.first[name], self.second[name]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            self.p[name] -= rate * (m / fade1) / (np.sqrt(v / fade2) + 1e-6)
        self._update_rows(grads)

    def _update_rows(self, grads: Params) -> None:
        for name in ROWS:
            p, squares = self.p[name], self.squares[name]
            for rows in self.met[name]:
                g = grads[name][rows]
                if g.ndim > 1:
                    squares[rows] += np.einsum("ij,ij->i", g, g) / g.shape[1]
                else:
                    squares[rows] += g * g
                size = self.row_rate / (np.sqrt(squares[rows]) + 1e-3)
                g *= size[:, None] if g.ndim > 1 else size
                p[rows] -= g
