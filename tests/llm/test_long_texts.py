"""Texts without end, blanks or structure must not take more than about linear time."""

from __future__ import annotations

import time

import pytest

from lectern.llm import langid, leaks, names, pii_rules, scans
from lectern.llm.pii import windows

LONG = {
    "one word": "a" * 60_000 + " / @ dot (at) [x]",
    "figures": "1" * 60_000,
    "dots": "1 . " * 30_000,
    "quotes": "“" * 3_000 + "x" * 3_000,
    "brackets": "[[" * 60_000,
    "hyphens": "a-" * 40_000 + "\n" + "b",
    "lines": "ab\n" * 30_000,
    "blanks": " " * 60_000 + "x",
    "chinese": "中" * 40_000,
    "capitals": "Ab Cd. " * 10_000,
}


@pytest.mark.parametrize("name", sorted(LONG))
def test_no_blow_up(name):
    text = LONG[name]
    start = time.process_time()
    langid.paragraphs(text)
    langid.prose(text)
    leaks.words(text)
    windows(len(text))
    pii_rules.label(text[:20_000])
    if scans.is_scan(text):
        lines = text.split("\n")
        scans.tokens(lines, [i for i, x in enumerate(lines) if x.strip()])
    assert time.process_time() - start < 8


def test_long_names():
    frames = names.Frames(["national", "archive", "nathan", "andrew"], ["archive national", "andrew"])
    start = time.process_time()
    frames.spellings("Nat. " * 2_000 + "Nosiax")
    frames.spellings("N. " * 2_000 + "Nosiax")
    frames.spellings("x" * 40_000)
    assert time.process_time() - start < 10
