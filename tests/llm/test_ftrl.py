"""The training against the definition, one coordinate at a time in plain Python."""

import math
import random

import numpy as np
import pytest

from strideframe.llm import ftrl


def plain(examples, s):
    z, n = {}, {}
    bias = 1 << s.bits

    def weight(i):
        zi = z.get(i, 0.0)
        if abs(zi) <= s.l1:
            return 0.0
        return -(zi - math.copysign(s.l1, zi)) / ((s.beta + math.sqrt(n.get(i, 0.0))) / s.alpha + s.l2)

    for _ in range(s.epochs):
        for indices, values, y in examples:
            x = dict(zip(indices.tolist(), values.tolist())) | {bias: 1.0}
            w = {i: weight(i) for i in x}
            score = max(-35.0, min(35.0, sum(w[i] * x[i] for i in x)))
            p = 1 / (1 + math.exp(-score))
            for i, v in x.items():
                g = (p - y) * v
                old = n.get(i, 0.0)
                n[i] = old + g * g
                z[i] = z.get(i, 0.0) + g - (math.sqrt(n[i]) - math.sqrt(old)) / s.alpha * w[i]
    return [weight(i) for i in range(bias + 1)]


@pytest.mark.parametrize("s", [ftrl.Settings(bits=6), ftrl.Settings(bits=6, alpha=0.1, l1=0.5, l2=0.2, epochs=2),
                               ftrl.Settings(bits=6, l1=0.0, epochs=1)])
def test_training_equals_the_definition(s):
    rnd = random.Random(5)
    examples = []
    for k in range(120):        # examples of several sizes, one without features
        at = rnd.sample(range(1 << s.bits), k % 9)
        y = float(sum(at) % 3 == 0)
        examples.append((np.array(at, dtype=np.int32), np.array([rnd.random() for _ in at], dtype=np.float32), y))
    got = ftrl.train(examples, s)
    assert got.dtype == np.float32 and np.allclose(got, plain(examples, s), rtol=1e-4, atol=1e-5)
    assert np.any(got != 0)


def test_no_examples_and_one_label():
    s = ftrl.Settings(bits=4)
    assert not ftrl.train([], s).any()
    ones = [(np.array([1, 2], dtype=np.int32), np.array([1.0, 1.0], dtype=np.float32), 1.0)] * 30
    w = ftrl.train(ones, s)
    assert w[1] > 0 and w[1] == w[2] and w[-1] > 0 and not w[3:-1].any()
