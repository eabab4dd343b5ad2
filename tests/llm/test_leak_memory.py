"""What decontamination holds of whole texts."""

import os

from entiva.llm import decontaminate
from entiva.session import Workspace

ITEM = "Yesterday Anna bought 12 apples for 30 dollars, then Anna gave 5 kg to Bob."


def stored(workspace):
    return sum(
        os.path.getsize(os.path.join(folder, name))
        for folder, _, names in os.walk(workspace.path)
        for name in names
    )


def found_in(spark, texts):
    """The rows found, and the bytes stored for them."""
    questions = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    workspace = Workspace(spark)
    found = decontaminate.contaminated(frame, questions, workspace=workspace).collect()
    return found, stored(workspace)


def test_texts_are_not_stored_as_words(spark):
    long = " ".join(f"{ITEM} {' '.join(f'w{k * j}x' for k in range(10_000))}." for j in (3, 7))
    found, size = found_in(spark, {1: long, 2: long.replace("Anna", "Maria")})
    assert [(r.coverage, r.consistency) for r in found] == [(1, 1)] * 2
    # of 20,000 words in four readings only the windows of the item
    assert size < len(long) // 2


def test_slots_of_two_copies_in_one_text(spark):
    other = ITEM.replace("12", "7").replace("Anna", "Maria").replace("Bob", "John")
    torn = other.replace("Maria gave", "Peter gave")
    texts = {1: f"{ITEM} So it is. {other}", 2: f"Before that. {other}", 3: torn}
    found, _ = found_in(spark, texts)
    slots = {r.doc_id: (r.n_slots, r.changed_slots, r.consistency) for r in found}
    assert set(slots) == {1, 2}
    assert slots[1] == (8, 0, 1) and slots[2] == (8, 4, 1)


def test_a_long_run_of_names(spark):
    names = ", and " + "Xavier " * 60_000
    found, _ = found_in(spark, {1: f"{ITEM} He saw{names}", 2: f"He saw{names}"})
    assert [(r.doc_id, r.coverage) for r in found] == [(1, 1)]
