"""Chunking contract: golden lengths and properties."""

from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.operators.splitter import chunk_spans, frames, pieces, split_text

GOLDEN = [
    ("x" * 499, [499]),
    ("x" * 500, [500]),
    ("x" * 501, [500, 51]),
    ("x" * 951, [500, 500, 51]),
    ("word " * 200, [499, 499, 99]),
    ("line of text\n" * 60, [493, 324]),
    ("p1 " * 100 + "\n\n" + "q2 " * 250, [299, 497, 299]),
    ("  a  ", [1]),
    ("\n\n\n", []),
]


def test_golden_lengths():
    for text, lengths in GOLDEN:
        assert [len(c) for c in split_text(text)] == lengths, repr(text[:20])


def test_sample_article_single_chunk():
    text = ("Artificial intelligence is transforming industries. " * 8)[:392]
    assert [len(c) for c in split_text(text)] == [len(text.strip())]


def test_pieces_keep_separator_in_front():
    assert pieces("a\nb\n\nc", "\n") == ["a", "\nb", "\n", "\nc"]
    assert pieces("\nx", "\n") == ["\nx"]
    assert pieces("ab", "") == ["a", "b"]


def test_frames_fixed_width_level():
    # single characters: width 500, stride 450
    fr = frames(list(range(952)), 500, 50)
    assert fr == [(0, 500), (450, 950), (900, 951)]


WS_TEXT = st.text(alphabet=st.sampled_from(list("ab cd\n\n\t xy") + [" ", "é"]), max_size=2500)


@settings(max_examples=200, deadline=None)
@given(WS_TEXT)
def test_properties(text):
    for c in split_text(text, 120, 20):
        assert 0 < len(c) <= 120
        assert c == c.strip()


@settings(max_examples=50, deadline=None)
@given(WS_TEXT)
def test_deterministic(text):
    assert split_text(text) == split_text(text)


@settings(max_examples=200, deadline=None)
@given(WS_TEXT)
def test_spans_cover_all_text(text):
    from quarry.operators.splitter import chunk_spans
    spans = chunk_spans(text, 120, 20)
    assert [text[a:b] for a, b in spans] == split_text(text, 120, 20)
    starts = [a for a, _ in spans]
    assert starts == sorted(starts)
    covered = set()
    for a, b in spans:
        covered.update(range(a, b))
    assert all(i in covered for i, ch in enumerate(text) if not ch.isspace())


MIXED = st.lists(st.sampled_from(list("ab c\n") + ["\n\n", "  ", "é", "\t", "xyz"]), max_size=1200).map("".join)


@settings(max_examples=300, deadline=None)
@given(MIXED, st.sampled_from([(500, 50), (120, 20), (60, 0), (30, 29), (7, 3)]))
def test_equals_reference_implementation(text, params):
    import reference_splitter as ref
    size, overlap = params
    assert split_text(text, size, overlap) == ref.split_text(text, size, overlap)


def test_long_text_without_separators_in_closed_form():
    from quarry.operators.splitter import frames
    text = "".join(chr(97 + i % 26) for i in range(5003))
    for size, overlap in ((500, 50), (7, 3), (10, 9), (2, 0)):
        bounds = list(range(len(text) + 1))
        assert chunk_spans(text, size, overlap) == frames(bounds, size, overlap)
    assert len(chunk_spans("x" * 5_000_000)) == 11111
