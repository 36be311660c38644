"""A window that fails the overlap check does not hide another one."""

from segmint.llm import decontaminate


def _matches(text, item):
    words = item.replace(".", "").split()
    index = decontaminate.ItemIndex([(7, item)], {w: 1 for w in words}, 100, float(len(words)))
    return [(i, round(score, 9), *overlaps) for i, score, *overlaps in index.matches(text, 0.6, 0.6, 0.5)]


def test_a_word_list_does_not_hide_a_copy_further_on():
    words = [f"w{i}" for i in range(16)]
    item = " ".join(words[:12]) + ". " + " ".join(words[12:]) + "."
    gap = " ".join(["x"] * 200)
    assert _matches(" ".join(sorted(words, reverse=True)), item) == []
    hidden = f"{' '.join(sorted(words, reverse=True))} {gap} {item}"
    assert _matches(hidden, item) == [(7, 1.0, 1.0, 1.0)] == _matches(f"{item} {gap}", item)
    edited = item.replace("w0 ", "y ")
    found = _matches(f"{' '.join(sorted(words, reverse=True))} {gap} {edited}", item)
    assert len(found) == 1 and 0.6 <= found[0][1] < 1.0
