from __future__ import annotations

from lectern.llm import scans

CLEAN = "The committee measured the reliable bridge and published the difference in the second modern index. " * 3
PAGE1 = "The committee measured the reliable bridge and pub-\nlished tbe difference in the second modern index. The\ncommittee measured the bridge and the diff-\n\n12\nTHE TALL BOOK\n\nerence in the second rnodern index. The committee\nmeasured the reliab1e bridge."
PAGE2 = "THE TALL BOOK   14\nThe committee published the difference in the second\nindex. The committee measured the modern bridge and\nthe reliable index in the second difference of the\n- 14 -"
ZH = "　　编者核对了公开的水车，只发现三处错误，熟悉公开\n的收成的读者很快就能理解后半部分，大水到达港口时仍\n然保存在楼上，关于地图的说法主要来自古老的账簿中的\n　　p. 3\n高高的书\n记录。"


def chunks(spark):
    rows = [(1, "the-tall-book", PAGE1, "x"), (2, "the-tall-book", PAGE2, "x"), (3, "clean", CLEAN, "x"), (4, "clean", None, "x"), (5, "clean", "", "x"), (6, "zh", ZH, "x"), (7, None, "1908\n\n  12   34   56\n7   8   9", "x")]
    more = [(100 + i, "clean", CLEAN, "x") for i in range(15)]
    return spark.createDataFrame(rows + more, "chunk_id long, stem string, text string, kind string").repartition(3)


def test_lines(spark):
    got = sorted(tuple(r) for r in scans.noisy_lines(chunks(spark)).collect())
    assert got == [
        (1, 1, "hyphen"), (1, 2, "chars"), (1, 3, "hyphen"), (1, 5, "page_no"), (1, 6, "header"), (1, 8, "chars"), (1, 9, "chars"), (2, 1, "header"), (2, 5, "page_no"), (6, 4, "page_no"), (6, 5, "header"),
    ]


def test_repaired(spark):
    got = {r.chunk_id: r.text for r in scans.repaired(chunks(spark)).collect()}
    assert len(got) == 22 and got[3] == CLEAN and got[4] is None and got[5] == ""
    assert "published the difference in the second modern index" in got[1] and "TALL" not in got[1] and "difference in the second modern index. The committee measured the reliable bridge." in got[1]
    assert got[6].endswith("账簿中的记录。")


def test_empty(spark):
    assert scans.noisy_lines(chunks(spark).limit(0)).count() == 0


def test_skeletons():
    pairs = [("tbe", "the"), ("rnodern", "modern"), ("reliab1e", "reliable"), ("seconcl", "second"), ("vvas", "was"), ("argumerit", "argument"), ("carefiil", "careful"), ("prlvate", "private"), ("ﬁshing", "fishing"), ("mdex", "index"), ("iibertragen", "übertragen"), ("hghthouse", "lighthouse")]
    assert all(scans.skeleton(a) == scans.skeleton(b) for a, b in pairs)
    assert scans.skeleton("bridge") != scans.skeleton("bridges")


def test_page_marks():
    lines = ["12", "- 7 -", "3 / 412", "p. 9", "Page xi", "第12页", "1908.", "word", "12 34", "[4]", "", "civil", "mix", "xlii", "Page 1234 of 5678"]
    got = scans.page_marks(lines)
    assert {i: v for i, (v, _) in got.items()} == {0: 12, 1: 7, 2: 3, 3: 9, 4: 11, 5: 12, 6: 1908, 9: 4, 13: 42, 14: 1234}
    assert {i for i, (_, marked) in got.items() if marked} == {1, 2, 3, 4, 5, 9, 14}


BODY = "The committee measured the reliable bridge and then\npublished the difference in the second modern index of\nthe committee while the bridge was measured in the\n"


def kinds(spark, rows, of=("page_no",)):
    df = spark.createDataFrame(rows, "chunk_id long, stem string, chunk_index int, text string").repartition(3)
    return sorted((r.chunk_id, r.line_no, r.kind) for r in scans.noisy_lines(df).collect() if r.kind in of)


def test_page_sequences(spark):
    """A number is a page's if it rises with the book's pages; a year or a lone figure in the text isn't."""
    rows = [(i, "book", i, f"{BODY}{BODY}{40 + i}\n{BODY}") for i in range(5)]
    rows += [(10, "other", 0, f"{BODY}1908\n{BODY}xc\n{BODY}"), (11, "other", 2, f"{BODY}xci\n{BODY}mix\n{BODY}"), (12, "third", 0, f"{BODY}88\n{BODY}"), (13, "third", 1, f"{BODY}17\n{BODY}")]
    assert kinds(spark, rows) == [(i, 7, "page_no") for i in range(5)] + [(10, 8, "page_no"), (11, 4, "page_no")]


def test_long_books_are_put_in_order_in_parts(spark, monkeypatch):
    monkeypatch.setattr(scans, "BOOK_PART", 4)
    rows = [(i, "book", i, f"{BODY}{7 + i}\n{BODY}") for i in range(11)]
    assert kinds(spark, rows) == [(i, 4, "page_no") for i in range(11)]


def test_headers_alike_but_for_misreadings(spark):
    a, b, c, d = (f"and in the {x} the committee went on with the bridge\nwhich it had measured in the {x} of the year before\nand closed the index of the {x} after it had been\n" for x in ("spring", "summer", "autumn", "winter"))
    head = "An Account of the Harbour Works"
    rows = [(1, "x", 0, f"{a}\f{head}\n{b}"), (2, "x", 1, f"{b}\fAn Acc~unt of tbe Harhour Works\n{c}"), (3, "x", 2, f"{c}\fA Different Heading Altogether\n{d}"), (4, "y", 0, f"{d}\f{head}\n{a}")]
    assert kinds(spark, rows, ("header",)) == [(1, 4, "header"), (2, 4, "header")]


def test_breaks_by_vocabulary(spark):
    clean = "A well-known bridge. The bookshelf was self-made and self-taught; a mother-in-law came. The stone and the wood, pre-war and post-war, and the rest, and more. He made it known by law. "
    text = "The committee measured the well-\nknown bridge and the book-\nshelf in the second index of self-\nmade maps that mother-in-\nlaw had drawn in stone-\nand wood while the Grindol-\nwick bridge was measured"
    rows = [(1, "x", 0, text)] + [(100 + i, "c", i, clean + "The committee measured the difference in the index of maps that had been drawn while it was measured.") for i in range(6)]
    assert kinds(spark, rows, ("hyphen",)) == [(1, i, "hyphen") for i in (1, 2, 3, 4, 6)]
    out = {r.chunk_id: r.text for r in scans.repaired(spark.createDataFrame(rows, "chunk_id long, stem string, chunk_index int, text string")).collect()}
    assert out[1] == "The committee measured the well-known bridge and the bookshelf in the second index of self-made maps that mother-in-law had drawn in stone- and wood while the Grindolwick bridge was measured"


def test_a_long_line_drops_no_scan(spark):
    wide = "and the remarkable committee then went on to measure every bridge of the whole long valley without any pause at all until the winter came and the second index was closed for the year"
    assert len(wide) > 170
    rows = [(1, "x", 0, f"{BODY}{BODY}{wide}\npub-\nlished the index\n{BODY}")]
    assert kinds(spark, rows, ("hyphen",)) == [(1, 8, "hyphen")]
