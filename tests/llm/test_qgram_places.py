"""Where a match belongs that begins or ends beyond its text."""

from breathline.llm import qgram_filter as qf


def test_item_without_its_first_characters_is_found_in_any_place():
    item = "a passage that a document begins with, though it lacks the first few of its characters"
    index = qf.Index([(5, item)], qf.Settings())
    for lost in range(1, 7):
        alone = index.matches([item[lost:] + " and more"])
        behind = index.matches(["clean words", item[lost:] + " and more", "clean words"])
        assert set(alone) == {(0, 0)} and set(behind) == {(1, 0)}
        assert alone[0, 0] == behind[1, 0]
    assert set(index.matches(["clean words", "more and " + item[:-4], "clean words"])) == {(1, 0)}
