import pickle

import pytest

from lexitrend.llm import op5_decontaminate as deco
from tests.llm import edge


def held(text: str, *items: str) -> list[str]:
    found = deco.Matcher([(t, deco.normalise(t)) for t in items], deco.ERROR_RATE, word_edges=True).find(deco.normalise(text))
    return sorted(m[0] for m in found)


@pytest.mark.parametrize("text,item,want", [
    ("the train", "ai", False), ("an ai model", "ai", True), ("AI", "ai", True), ("ai", "ai", True), ("(ai)", "ai", True),
    ("aid and rail, then ai", "ai", True), ("maid", "ai", False), ("x42", "42", False), ("42nd", "42", False), ("no. 42!", "42", True),
    ("über", "ber", False), ("東京都に", "京都", True), ("東京ai", "ai", True), ("a", "a", True), ("aa", "a", False), ("", "a", False),
    ("the little cat sat", "little cat", True), ("belittle cats", "little cat", False),
])
def test_short_items_stand_at_word_edges(text, item, want):
    assert held(text, item) == [item] * want


def test_longer_items_are_found_within_their_budget():
    """An item with an error budget may begin or end inside a word, by an edit or by none."""
    item = "quick brown fox jumps over"
    assert held("xquick brown fox jumps overs", item, "fox", "jump") == ["fox", item]


def test_a_worker_keeps_the_automaton_of_its_last_block():
    one, two = (pickle.dumps([(1, t)]) for t in ("first item", "second item"))
    kept = deco.matcher_of(one, 0.08, True)
    assert deco.matcher_of(one, 0.08, True) is kept
    assert deco.matcher_of(two, 0.08, True).find("a second item") and deco.matcher_of(one, 0.08, True).find("a first item")


def test_short_items_leave_documents_alone(spark):
    docs = edge.documents(spark)
    items = spark.createDataFrame([(1, "e"), (2, "id"), (3, "a")], "item_id long, text string")
    words = [(i, set(deco.normalise(t).split()) & {"e", "id", "a"}) for i, t in edge.ROWS]
    got = deco.matches(docs, items, word_edges=True).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(i) for i, w in words for _ in w)
    kept = deco.drop_contaminated(docs, items, word_edges=True).collect()
    assert sorted(str(r["doc_id"]) for r in kept) == sorted(str(i) for i, w in words if not w)
