import pandas as pd

from pressloom.streaming.harvest_stream import ReadState


class _State:
    def __init__(self):
        self.held = {}

    def containsKey(self, key):
        return key in self.held

    def getValue(self, key):
        return self.held.get(key)

    def updateValue(self, key, value):
        self.held[key] = value


def rows(*given):
    return pd.DataFrame(given, columns=["article_url", "link_id", "original_url", "claimed_at"])


def test_one_call_takes_all_urls_of_a_group():
    """Each URL keeps a state of its own, whatever else is in its group; rows may come in parts."""
    state = ReadState()
    state.stored, state.read = _State(), _State()
    state.handleInitialState((3,), pd.DataFrame({"article_url": ["d"], "group": [3]}), None)

    def call(*parts):
        return sorted(t for out in state.handleInputRows((3,), iter(parts), None) for t in out.itertuples(index=False, name=None))

    first = call(rows(("a", 1, "a?1", 5), ("b", 1, "b?1", 6)), rows(("a", 1, "a?2", 4), ("d", 2, "d", 1), ("b", 7, "b", 2)))
    assert first == [(1, "a?1", "a", False), (1, "b?1", "b", False), (2, "d", "d", True), (7, "b", "b", False)]
    # Links before the mark of their URL in the same call, a mark alone, repeated and older claims.
    second = call(rows(("a", 1, "a?1", 5), ("a", 9, "a", 1), ("b", 1, "b?1", 7)), rows(("a", None, None, None), ("c", None, None, None)))
    assert second == [(1, "b?1", "b", False), (9, "a", "a", True)]
    assert call(rows(("b", 1, "b", 7), ("c", 4, "c", 0))) == [(4, "c", "c", True)]
    assert state.read.held[("b", 1)] == (7,) and ("c",) in state.stored.held and ("b",) not in state.stored.held
