"""A step of training against a plain one: every pair of a word and a node for itself, sums over sorted numbers."""

from __future__ import annotations

import time

import numpy as np

from converge.llm import lm


def _sums(at, rows):
    found, back = np.unique(at, return_inverse=True)
    return found, np.stack([np.bincount(back, column, len(found)) for column in np.ascontiguousarray(rows.T)], axis=1)


def _plain_gradients(p, context, target):
    n = len(target)
    nodes, turns, begin, subtree = lm.tree(len(p["e"]))
    x = p["e"][context.T].reshape(n, -1)
    h = np.ones((n, lm.HIDDEN + 1), np.float32)
    h[:, :-1] = np.tanh(x @ p["w"] + p["b"])
    logits = h @ p["t"].T
    d = np.exp(logits - logits.max(axis=1, keepdims=True))
    d /= d.sum(axis=1, keepdims=True)
    d[np.arange(n), subtree[target]] -= 1
    d /= n
    length = begin[target + 1] - begin[target]
    rows = np.repeat(np.arange(n), length)
    at = np.repeat(begin[target] - (np.cumsum(length) - length), length) + np.arange(length.sum())
    v = p["v"][nodes[at]]
    below = -turns[at] / (1 + np.exp(np.einsum("ij,ij->i", v, h[rows]) * turns[at])) / np.float32(n)
    dh = d @ p["t"]
    deep = np.flatnonzero(length)
    if len(deep):
        dh[deep] += np.add.reduceat(v * below[:, None], (np.cumsum(length) - length)[deep])
    grads = {"v": _sums(nodes[at], h[rows] * below[:, None]), "t": d.T @ h}
    dh = dh[:, :-1] * (1 - h[:, :-1] ** 2)
    return grads | {"e": _sums(context.T.ravel(), (dh @ p["w"].T).reshape(-1, lm.EMBEDDING)), "w": x.T @ dh, "b": dh.sum(axis=0, keepdims=True)}


def _case(size, n):
    r = np.random.RandomState(8)
    words = np.minimum(r.zipf(1.2, (len(lm.OFFSETS) + 1, n)) - 1, size - 1)
    p = {k: v + r.normal(0, 0.2, v.shape).astype(np.float32) for k, v in lm.start_weights(size=size).items()}
    return p, words[:-1], words[-1]


def test_a_step_moves_all_weights_as_a_plain_one():
    for size, n in ((lm.CLASSES, 50), (5000, 700), (40, 9)):
        p, context, target = _case(size + lm.OTHERS, n)
        trainer = lm._Trainer(p)
        trainer.step(context, target)
        for name, grad in _plain_gradients(p, context, target).items():
            wanted = np.zeros(p[name].shape)
            at, grad = grad if isinstance(grad, tuple) else (slice(None), grad)
            wanted[at] = grad
            assert np.allclose(np.sqrt(trainer.s[name]), np.abs(wanted), rtol=1e-3, atol=1e-6)
            clear = np.abs(wanted) > 1e-5
            assert np.allclose((p[name] - trainer.p[name])[clear], lm.RATE * np.sign(wanted[clear]), rtol=1e-3, atol=1e-5)
            assert np.array_equal(np.delete(trainer.p[name], trainer.moved(name), axis=0), np.delete(p[name], trainer.moved(name), axis=0))


def test_logits_far_apart_do_not_leave_the_range_of_numbers():
    p, context, target = _case(5000, 300)
    p["t"] *= 400
    got = lm.class_log_probabilities(p, context, target)
    assert np.isfinite(got).all() and (got <= 1e-3).all()
    trainer = lm._Trainer(p)
    trainer.step(context, target)
    assert all(np.isfinite(x).all() for x in trainer.p.values())


def test_a_step_takes_less_time_than_the_plain_gradients_alone():
    p, context, target = _case(40_000, lm.BATCH)
    trainer = lm._Trainer(p)
    took = {"step": [], "plain": []}
    for _ in range(15):
        for name, f in (("step", trainer.step), ("plain", lambda c, t: _plain_gradients(p, c, t))):
            start = time.thread_time()
            f(context, target)
            took[name].append(time.thread_time() - start)
    assert min(took["step"]) < 0.9 * min(took["plain"]), took
