from pressloom import vocab
from pressloom.operators.content import (
    _Words, body_text, invalid_scores, pick_list, related_strings,
)

STOP = frozenset(vocab.STOPWORDS_EN)
INVALID = _Words(vocab.CONTENT_INVALID_KEYS)
HEAD = ["storm", "coast"]


def test_scores_reset_on_a_long_string():
    lists = [["storm", "privacy", "one two three four five six"], ["alpha beta gamma delta epsilon zeta", "storm"], ["!"]]
    assert invalid_scores(lists, HEAD, STOP, INVALID) == [0.0, 0.5, 1.0]


def test_unrelated_short_strings_are_negative():
    assert invalid_scores([["banana", "plum"]], HEAD, STOP, INVALID) == [1.0]


def test_scoring_learns_within_the_page():
    # the first list teaches "warning", so the second is not wholly unrelated
    lists = [["storm warning bulletin"], ["plum pear kiwi warning"]]
    assert invalid_scores(lists, HEAD, STOP, INVALID) == [1.0, 0.0]
    assert invalid_scores(lists[1:], HEAD, STOP, INVALID) == [1.0]


def test_pick_prefers_no_more_invalid_and_longer():
    lists = [["aaaa"], ["bbbbbb"], ["cc"], ["dddddddd"]]
    assert pick_list(lists, [0.5, 0.5, 0.0, 0.6]) == ["bbbbbb"]
    assert pick_list(lists, [0.8, 0.9, 0.8, 0.9]) is None


def test_cut_between_79_and_80_characters():
    short, long = "storm " + "x" * 73, "storm " + "x" * 74
    assert (len(short), len(long)) == (79, 80)
    # below the cut a match of over 70 is needed, from 80 on any match will do
    weak = "stor " + "x" * 74, "stor " + "x" * 75
    assert related_strings([short, long], HEAD, STOP, INVALID) == [short, long]
    assert related_strings(list(weak), ["storms"], STOP, INVALID) == [weak[1]]


def test_short_invalid_string_is_dropped():
    assert related_strings(["storm newsletter"], HEAD, STOP, INVALID) == []


def test_kept_strings_widen_the_dictionary():
    first = "storm " + "flooding " * 10
    second = "flooding " * 10
    assert related_strings([first, second], HEAD, STOP, INVALID) == [first, second]
    assert related_strings([second, first], HEAD, STOP, INVALID) == [first]


def test_second_lists_only_when_the_first_give_nothing():
    text = "storm over the coast tonight " * 5
    other = "banana plum cherry apple pear " * 5
    assert body_text([[text]], [[text + "x"]], HEAD, STOP, INVALID) == text
    assert body_text([[other]], [[text * 2]], HEAD, STOP, INVALID) == text * 2
    assert body_text(None, [[text]], HEAD, STOP, INVALID) == text
    assert body_text(None, None, HEAD, STOP, INVALID) is None


def test_lists_without_a_long_string_are_admitted_by_density(values):
    from pyspark.sql import functions as F

    from pressloom.operators.content import _admitted

    a, b = "x" * 63, "y" * 67
    lists = [[["short"] * 12, [a, b]], [["short"] * 12, [a]], [["z" * 100], ["w"]], [["short"] * 3, [a, b, "s", "t", "u"]]]
    got = values([(row,) for row in lists], "l array<array<string>>", _admitted(F.col("l")))
    assert got == [[[f"{a}\n\n{b}"]], None, [["z" * 100], ["w"]], None]
