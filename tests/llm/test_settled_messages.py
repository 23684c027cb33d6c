"""Labels reach every repeat of a token, and messages pass until they settle."""

import numpy as np

from tarmac.llm import common, pii

SF = "/root/testdata/sf0.01"


def test_label_reaches_every_repeat(spark):
    docs = common.table(spark, SF, "documents")
    model = pii.fit(sorted(r.text for r in docs.select("text").collect()))
    for between in (1, 5, 40, 400):
        text = "call +1 (377) 555-0271 now, " + "or later 555-0271 again; " * between
        base = pii.base_spans(text)
        assert len(base) == 1
        added = pii.added_spans([text], [base], model)[0]
        assert [(k, text[s:e]) for k, s, e in added] == [(3, "555-0271")] * between


def test_messages_settle_on_a_long_chain():
    rng = np.random.default_rng(3)
    n = 60
    model = pii.Model(np.zeros((pii._FEATURES, 5)), np.zeros((5, 5)), 6.0 * np.eye(5))
    x = (rng.random((n, pii._FEATURES)) < 0.3).astype(float)
    g = pii.Graph([(0, k, k + 1) for k in range(n)], x, np.array([2] + [-1] * (n - 1)), np.zeros((0, 2), np.int64), np.array([[k, k + 1] for k in range(n - 1)]))
    step = np.exp(model.skip) / np.exp(model.skip).sum(axis=1, keepdims=True)
    want = [np.linalg.matrix_power(step, k)[2] for k in range(n)]
    assert np.allclose(pii.beliefs(g, model), want, atol=1e-4)
