import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexlake.llm.splitting import limits, pieces, split
from lexlake.llm.tokens import encoder, vocabulary

ENC = encoder(vocabulary())


def check(text, limit, overlap):
    cut = pieces(text, ENC, limit, overlap)
    assert cut[0][0] == 0 and cut[-1][1] == len(text)
    for (a, b, n, o), (c, d, _, p) in zip(cut, cut[1:]):
        assert a < c <= b < d
    if len(cut) > 1:
        assert all(len(ENC.encode_ordinary(text[a:b])) == n for a, b, n, _ in cut)
    return cut


@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=400), st.integers(12, 60), st.integers(0, 8))
@settings(max_examples=150, deadline=None)
def test_laws(text, limit, overlap):
    cut = check(text, limit, overlap)
    assert all(n <= limit for *_, n, _ in cut) and (len(cut) > 1) == (len(ENC.encode_ordinary(text)) > limit)


def test_natural_boundaries_and_overlap():
    text = "\n\n".join(" ".join(f"Sentence {i} of {j} stands here." for i in range(6)) for j in range(8))
    cut = check(text, 64, 8)
    assert all(text[:b].rstrip().endswith(".") for _, b, _, _ in cut)
    assert all(8 <= o <= 10 for *_, o in cut[1:])
    assert all(len(ENC.encode_ordinary(text[c:b])) >= 8 for (_, b, _, _), (c, *_) in zip(cut, cut[1:]))
    check("字" * 3000, 50, 5)
    check("a" * 5000, 50, 5)
    check("😀" * 500, 12, 2)


def test_bad_limits():
    for limit, overlap in ((0, 0), (5, 5), (5, -1)):
        with pytest.raises(ValueError):
            pieces("abc", ENC, limit, overlap)


def test_frame(spark):
    df = spark.createDataFrame([(1, "a. " * 100, 3), (2, None, 3), (3, "", 3), (4, "short", 3)], "doc_id long, text string, piece int")
    rows = split(df, "doc_id", "text", 20, 4).collect()
    assert {r.doc_id for r in rows} == {1, 3, 4} and all(r.n_tokens <= 20 for r in rows)
    assert {r.doc_id for r in split(df, "doc_id", "text", 20, 4, only_long=True).collect()} == {1}
    assert split(df.limit(0), "doc_id", "text", 20, 4).count() == 0
    assert limits(spark.createDataFrame([(512, 64)], "max_tokens int, overlap_tokens int")) == (512, 64)
