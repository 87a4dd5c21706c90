"""Texts are split into words for counting and for their lines of outputs, not again for training and scoring."""

import numpy as np
import pytest

from starbeam.llm import neural_lm
from tests.llm.test_llm_operators import smoke


def test_training_and_scoring_read_no_text(spark, monkeypatch):
    """What ``train`` and ``scored`` get holds outputs in place of texts."""
    docs, seen = smoke(spark, "documents"), []
    for name in ("train", "scored"):
        def spy(parts, *args, _step=getattr(neural_lm, name)):
            seen.append(parts.columns)
            return _step(parts, *args)

        monkeypatch.setattr(neural_lm, name, spy)
    assert neural_lm.neural_scores(docs).count() == docs.count()
    assert len(seen) == 2 and all("text" not in c and "outputs" in c for c in seen)


def test_long_lines_are_scored_in_pieces(monkeypatch):
    """Lines longer than a piece give the same scores: a piece goes on with the context of the one before."""
    rng = np.random.default_rng(6)
    model = neural_lm.Model(np.full(20, 0.05), 8, 2)
    lines = [rng.integers(0, 20, n) for n in (1, 700, 64, 65, 3)]

    def scores():
        scorer = neural_lm.Scorer(model, 20)
        scorer.begin(len(lines))
        for i, line in enumerate(lines):
            scorer.add(i, line)
        scorer.finish()
        return scorer.score

    want = scores()
    monkeypatch.setattr(neural_lm, "LINE", 64)
    monkeypatch.setattr(neural_lm, "HELD", 100)
    assert np.allclose(scores(), want, rtol=1e-12)


@pytest.mark.parametrize("n", [50, 5000])
def test_a_step_changes_the_touched_rows_only(n):
    """Many more rows than gradients: only those of the minibatch are stepped on, by the same amounts."""
    f = np.full(n, 1 / n)
    rng = np.random.default_rng(4)
    context, target = rng.integers(0, 50, (64, 2)), rng.integers(0, 50, 64)
    model = neural_lm.Model(f, 8, 2)
    before, bias = model.r.copy(), model.q.copy()
    model.learn(context, target, np.random.default_rng(5), 16, 0.1)
    rest = np.setdiff1d(np.arange(n + 1), context)
    assert (model.r[rest] == before[rest]).all() and (model.r[np.unique(context)] != before[np.unique(context)]).any(axis=1).all()
    assert (model.q[np.unique(target)] != bias[np.unique(target)]).any(axis=1).all()
