"""Scoring windows without what only training needs."""

from entiva.llm import toxicity


def test_toxicity_scores_without_traces(monkeypatch):
    p = toxicity.fresh(2)
    texts = [b"", b"one", " ".join(f"w{k % 91}" for k in range(700)).encode(), b"a b c"]
    block = toxicity.read(texts)
    vectors = toxicity.inputs(p, block)
    expected = toxicity.forward(p, vectors, block.windows)

    def traced(*_):
        raise AssertionError("the pass of training")

    monkeypatch.setattr(toxicity, "forward", traced)
    assert (toxicity.window_logits(p, vectors, block.windows) == expected).all()
