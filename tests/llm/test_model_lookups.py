"""Looking keys up in a level of the language model."""

import numpy as np

from entiva.llm.elias_fano import EliasFano, write


def test_language_model_looks_for_one_end_of_a_bucket(tmp_path, monkeypatch):
    draw = np.random.default_rng(5)
    keys = np.unique(draw.integers(0, 1 << 60, 20_000, dtype=np.uint64))
    write(f"{tmp_path}/level", keys, [])
    level = EliasFano(f"{tmp_path}/level")
    asked = []
    zero = EliasFano._zero
    monkeypatch.setattr(EliasFano, "_zero", lambda self, n: asked.append(len(n)) or zero(self, n))
    probes = np.sort(np.concatenate([keys[::2], keys[::3] + np.uint64(1)]))
    places = np.searchsorted(keys, probes)
    there = keys[np.minimum(places, len(keys) - 1)] == probes
    assert (level.find(probes) == np.where(there, places, -1)).all()
    assert sum(asked) <= len(probes)


def test_language_model_buckets_longer_than_a_word(tmp_path):
    clump = np.arange(5_000, dtype=np.uint64) * np.uint64(3)
    powers = np.uint64(1) << np.arange(60, dtype=np.uint64)
    keys = np.unique(np.concatenate([clump + np.uint64(1 << 40), powers]))
    write(f"{tmp_path}/level", keys, [])
    level = EliasFano(f"{tmp_path}/level")
    assert (level.find(keys) == np.arange(len(keys))).all()
    assert (level.find(clump + np.uint64((1 << 40) + 1)) == -1).all()
