from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lectern.operators import segment

TEXT = "intro words here\n\nChapter 1\n\nalpha beta\ngamma\n\n\ndelta\n<!-- PAGE:4 -->\n\nChapter 2\nzeta"


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_paragraphs(spark):
    df = spark.createDataFrame([(1, TEXT), (2, None), (3, " \n\t\n")], "k int, text string")
    got = sorted(rows(segment.paragraphs(df, "k")))
    assert [g[:3] for g in got] == [(1, 1, 1), (1, 3, 3), (1, 5, 6), (1, 9, 10), (1, 12, 13)]
    assert got[2][3] == "alpha beta\ngamma"


def test_chunks_keep_chapters_and_pages(spark):
    df = spark.createDataFrame([(1, TEXT)], "k int, text string")
    got = sorted(segment.chunks(df, "k", most=4, least=2).collect(), key=lambda r: r.chunk_index)
    assert [r.tag for r in got] == [None, "Chapter 1", "Chapter 1", "Chapter 2"] or [r.tag for r in got][0] is None
    assert got[-1].start_page == 4
    assert [r.chunk_index for r in got] == list(range(len(got)))


def brute(paras: list[tuple[bool, int]], most: int, least: int) -> list[int]:
    """Words of each chunk."""
    chapters: list[list[int]] = []
    for i, (heads, n) in enumerate(paras):
        if heads or not chapters:
            chapters.append([])
        chapters[-1].append(n)
    out = []
    for c in chapters:
        packed = []
        for n in c:
            if packed and packed[-1] + n <= most:
                packed[-1] += n
            else:
                packed.append(n)
        if len(packed) > 1 and packed[-1] < least:
            last = packed.pop()
            packed[-1] += last
        out += packed
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.booleans(), st.integers(1, 9)), min_size=1, max_size=14))
def test_packing_like_brute_force(spark, paras):
    text = "\n\n".join(("# " if h else "") + " ".join(["word"] * n) for h, n in paras)
    got = sorted(segment.chunks(spark.createDataFrame([(1, text)], "k int, text string"), "k", most=12, least=4).collect(), key=lambda r: r.chunk_index)
    assert [r.word_count for r in got] == brute(paras, 12, 4)
    assert sum(r.word_count for r in got) == sum(n for _, n in paras)


def test_mark_pages(spark):
    got = rows(segment.mark_pages(spark.createDataFrame([(1, "a\f \fb\f")], "k int, text string"), "k"))
    assert got == [(1, 1, "a"), (1, 3, "b")]
