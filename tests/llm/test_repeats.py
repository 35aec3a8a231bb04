from __future__ import annotations

from lectern.llm.repeats import collapsed_facts, repeated_facts

ROWS = [
    (10, "The figures held, and 57 percent stood.", "[raw/a/x.pdf#p12] [raw/b/y.pdf#p3]"),
    (11, "  “THE figures  held and 57 percent stood”。", "[ RAW/b/y.pdf #p. 3 ]; [raw/a/x.pdf#p12]"),
    (12, "The figures held, and 5.7 percent stood.", "[raw/a/x.pdf#p12] [raw/b/y.pdf#p3]"),
    (13, "and 57 percent stood. The figures held", "[raw/a/x.pdf#p12] [raw/b/y.pdf#p3]"),
    (14, "The figures held, and 57 percent stood.", "[raw/a/x.pdf#p13] [raw/b/y.pdf#p3]"),
    (20, "Year: 1888; Place: Durim Holt; Copies: 12", "[raw/a/x.pdf#p1]"),
    (21, "place：durim holt； copies：12； year：1888", "raw/a/x.pdf#p1"),
    (22, "COPIES: 12, YEAR: 1888, PLACE: DURIM HOLT", "[raw/a/x.pdf#p1]"),
    (23, "Copies  12 Place  Durim Holt Year  1888", "[raw/a/x.pdf#p1]"),
    (24, "Year: 12; Place: Durim Holt; Copies: 1888", "[raw/a/x.pdf#p1]"),
    (25, "Copies 1888 Year 12 Place Holt Durim", "[raw/a/x.pdf#p1]"),
    (30, "Null source", None), (31, "null SOURCE.", None), (32, "Null source", ""), (33, "Null source", "[raw/a/x.pdf#p1]"),
    (40, None, None), (41, None, None), (42, "", None), (50, "只有目录，没有别的。", None), (51, "只有目录 没有别的", None),
]
SCHEMA = "fact_id long, claim string, provenance string"


def test_pairs(spark):
    got = sorted(tuple(r) for r in repeated_facts(spark.createDataFrame(ROWS, SCHEMA).repartition(3)).select("first_fact_id", "fact_id").collect())
    assert got == [(10, 11), (20, 21), (20, 22), (20, 23), (30, 31), (30, 32), (40, 41), (40, 42), (50, 51)]


def test_hot_group_and_clashing_columns(spark):
    rows = [(i, "Same  claim" if i % 2 else "same claim.", "[raw/a/x.pdf#p1]", "c", 7) for i in range(400)] + [(900, "Other", None, "c", 7)]
    df = spark.createDataFrame(rows, SCHEMA + ", code string, copies int")
    assert repeated_facts(df).count() == 399
    got = {(r.fact_id, r.claim, r.copies) for r in collapsed_facts(df.drop("copies")).select("fact_id", "claim", "copies").collect()}
    assert got == {(0, "same claim.", 400), (900, "Other", 1)}


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert repeated_facts(df).count() == 0 and collapsed_facts(df).count() == 0


def test_long_field_names_and_tiling(spark):
    """Fields with names of any length are fields; lost separators count only where the other's fields tile the words."""
    name = "The place at which the second part of the whole ledger was kept in that year"
    rows = [
        (1, f"{name}: Durim Holt; Year: 1888", None), (2, f"Year: 1888; {name}: Durim Holt", None), (3, f"year 1888 {name.lower()} durim holt", None),
        (10, "ab: ba; ba: ab", None), (11, "abba baab", None), (12, "ab ab ba ba", None), (13, "ba ab ab ba", None),
    ]
    got = sorted(tuple(r) for r in repeated_facts(spark.createDataFrame(rows, SCHEMA)).select("first_fact_id", "fact_id").collect())
    assert got == [(1, 2), (1, 3), (10, 13)]
