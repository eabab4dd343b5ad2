"""Memory of shingling, which two workers of an executor spend at once."""

import tracemalloc

import pyarrow as pa

from entiva.llm import near_dedup


def test_shingles_hold_little_besides_the_texts():
    texts = [" ".join(f"w{k * i % 7919}" for k in range(400)).encode() for i in range(1, 400)]
    tracemalloc.start()
    found = sum(len(s) for s in near_dedup.shingle_sets(texts, 5))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found > 100_000
    assert peak < 32 << 20


def test_texts_are_not_repeated_with_their_shingles():
    text = " ".join(f"word{k}" for k in range(5_000)).encode()
    batch = pa.RecordBatch.from_arrays(
        [pa.array([7, 8]), pa.array([3, 3]), pa.array([b"a b c", text])],
        names=["node", "component", "text"],
    )
    before, held, rows = pa.total_allocated_bytes(), 0, []
    for one in near_dedup.shingle_rows(batch, 5):
        held = max(held, pa.total_allocated_bytes() - before)
        rows.append(one)
    assert [r.num_rows for r in rows] == [1, 4_996]
    assert rows[1].column(0).unique().to_pylist() == [8]
    assert rows[1].column(1).unique().to_pylist() == [3]
    assert len(rows[1].column(2).unique()) == 4_996
    assert held < 8 << 20
