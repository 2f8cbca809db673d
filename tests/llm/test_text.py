import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from riskbook.llm import text as T

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB é\n\t.", max_size=30)), max_size=6)


def by_hand(text, size=5):
    words = [w for w in "".join("\n" if c in " \t\n\r\x0b\x0c" else c for c in (text or "").lower()).split("\n") if w]
    return [tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_shingles_equal_those_by_hand(texts):
    found, first = T.shingles(pa.array(texts, pa.string()))
    names = {}
    for i, text in enumerate(texts):
        own, hand = found[first[i] : first[i + 1]].tolist(), by_hand(text)
        assert len(own) == len(hand)
        for code, shingle in zip(own, hand, strict=True):
            assert names.setdefault(shingle, code) == code
    assert len(set(names.values())) == len(names)


def test_slices_hold_every_row_once():
    rows = pa.record_batch({"text": ["x" * 3_000_000, None, "", "y" * 9_000_000, "z"]})
    pieces = list(T.slices(rows))
    assert sum(p.num_rows for p in pieces) == 5 and len(pieces) > 1
    assert list(T.slices(rows.slice(0, 0))) == []
