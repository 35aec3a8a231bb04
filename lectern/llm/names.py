"""Problem 3: variant spellings of the names of persons and organisations.

A name is cut into its frame (given names and generic words, which the index itself tells by their frequency, whatever
their order or abbreviation) and its own part (surname, place). Where all words are frame words or none is, position
tells. Own parts are joined by the pigeonhole principle: each error harms one of k+1 segments, so with at most k errors
one segment of the entry's own part stands unharmed in the typed one, shifted by at most k. Only a swap of neighbours
across a segment's border harms two; for these the own part with that border swapped is cut again for one error less.
Segments are looked up in an inverted index keyed by frame, length, segment and text, and hits are verified by a banded
edit distance that counts a swap of neighbours as one.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.plans.shared import stage_table

#: A word of so many index names is a frame word.
FRAME_NAMES = 3
#: Distinct frames that are shipped to the workers at once; an index with more takes more passes over the typed names.
BLOCK = 200_000

#: Short forms of given names.
NICKNAMES = {
    "abby": "abigail", "alex": "alexander", "sandy": "alexander", "andy": "andrew", "drew": "andrew", "ben": "benjamin", "benny": "benjamin",
    "chris": "christina christopher christian", "tina": "christina", "chrissie": "christina", "lola": "dolores", "ed": "edward", "eddie": "edward", "ted": "edward theodore", "ned": "edward", "teddy": "edward theodore", "eddy": "edward", "bess": "elizabeth", "betsy": "elizabeth", "libby": "elizabeth", "lisa": "elizabeth", "lily": "elizabeth",
    "beth": "elizabeth", "betty": "elizabeth", "liz": "elizabeth", "lizzie": "elizabeth", "eliza": "elizabeth", "paco": "francisco", "pancho": "francisco", "frank": "francisco francis",
    "fred": "frederick friedrich", "freddy": "frederick friedrich", "fritz": "friedrich", "greg": "gregory", "hettie": "henrietta", "hetty": "henrietta", "etta": "henrietta", "harriet": "henrietta", "gail": "abigail", "dolly": "dolores", "quin": "quentin", "quent": "quentin", "nico": "nicholas", "nik": "nicholas", "al": "alexander", "ozzy": "oswald", "lexi": "alexander", "inge": "ingrid", "hans": "johannes", "jo": "josephine", "josie": "josephine",
    "hannes": "johannes", "jan": "johannes", "kate": "katherine", "kathy": "katherine", "katie": "katherine", "kitty": "katherine", "marc": "marcel", "maggie": "margaret", "meg": "margaret",
    "peggy": "margaret", "greta": "margaret", "nick": "nicholas", "nicky": "nicholas", "ozzie": "oswald", "pip": "philippa", "pippa": "philippa", "phil": "philippa philip", "becky": "rebecca", "becca": "rebecca",
    "bob": "robert", "bobby": "robert", "rob": "robert", "bert": "robert", "sam": "samuel", "sammy": "samuel", "tom": "thomas", "tommy": "thomas", "uli": "ulrich", "vicky": "victoria", "vicki": "victoria", "tori": "victoria",
    "minnie": "wilhelmina", "mina": "wilhelmina", "willa": "wilhelmina", "bill": "william", "billy": "william", "will": "william", "willy": "william", "liam": "william", "joe": "josephine joseph yusuf", "zoli": "zoltan",
    "dick": "richard", "rick": "richard", "jim": "james", "jack": "john", "mike": "michael", "dave": "david", "dan": "daniel", "tony": "anthony", "matt": "matthew", "steve": "stephen", "jenny": "jennifer", "sue": "susan",
}
#: Words that name nobody.
EMPTY = set(
    "dr prof professor sir dame mr mrs ms miss herr frau mme mlle the of and et und de der des du la le ed eds editor author jr sr phd ltd inc co corp gmbh ev ag sa sarl plc est founded at in for hrsg hg".split()
)


def plain(name: str) -> str:
    s = unicodedata.normalize("NFKD", name)
    s = "".join(c for c in s if not unicodedata.combining(c)).lower()
    return s.replace("ß", "ss").replace("ø", "o").replace("æ", "ae").replace("ł", "l")


def words_of(name: str) -> list[tuple[str, bool]]:
    """(word, has a full stop) of a name, without quoted short forms, bracketed years, titles and legal forms."""
    s = plain(re.sub(r"(?<=[^\W\d_A-Z])(?=[A-Z][a-z])", " ", name))
    s = re.sub(r"[“\"„«][^“”\"»]*[”\"»]", " ", s)
    s = re.sub(r"\(\s*(?:est|founded|author|ed|eds|gegr)[^)]*\)", " ", s)
    s = re.sub(r"\b(e)\.\s?(v)\.", " ", s)
    out = []
    for m in re.finditer(r"[^\W_]+(?:['’][^\W_]+)*(\.)?", s):
        w = m.group().rstrip(".").replace("'", "").replace("’", "")
        if w not in EMPTY and not w.isdigit():
            out.append((w, bool(m.group(1))))
    return out


def osa(a: str, b: str, k: int) -> int:
    """Edit distance with swaps of neighbours, within a band of k; k+1 if it is more."""
    if abs(len(a) - len(b)) > k:
        return k + 1
    far = k + 1
    before: list[int] = []
    row = [j if j <= k else far for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        lo, hi = max(1, i - k), min(len(b), i + k)
        new = [far] * (len(b) + 1)
        if i <= k:
            new[0] = i
        for j in range(lo, hi + 1):
            d = min(row[j - 1] + (x != b[j - 1]), row[j] + 1, new[j - 1] + 1)
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == b[j - 1]:
                d = min(d, before[j - 2] + 1)
            new[j] = min(d, far)
        if min(new) >= far:
            return far
        before, row = row, new
    return row[len(b)]


def errors(length: int) -> int:
    """Errors that are allowed in an own part of this length."""
    return 0 if length < 4 else 1 if length < 9 else 2


def segments(s: str, parts: int) -> list[tuple[int, str, int]]:
    """(number, text, start) of segments of nearly equal length, the longer ones last."""
    n = len(s)
    out, at = [], 0
    for i in range(parts):
        size = n // parts + (i >= parts - n % parts)
        out.append((i, s[at : at + size], at))
        at += size
    return out


def entry_segments(own: str, k: int) -> set[tuple[int, int, str]]:
    """(errors left, number, text) under which an own part stands in the index."""
    cut = segments(own, k + 1)
    out = {(k, i, text) for i, text, _ in cut}
    for _, _, b in cut[1:]:
        if k and 0 < b < len(own) and own[b - 1] != own[b]:
            out |= entry_segments(own[: b - 1] + own[b] + own[b - 1] + own[b + 1 :], k - 1)
    return out


def typed_segments(own: str) -> set[tuple[int, int, int, str]]:
    """(size, errors left, number, text) that lead a typed own part to those of ``size`` letters."""
    out = set()
    for size in range(max(1, len(own) - 2), len(own) + 3):
        for k in range(errors(size) + 1):
            if abs(size - len(own)) > k:
                continue
            more = len(own) - size
            for i, cut, at in segments("x" * size, k + 1):
                # some unharmed segment has no more errors before it than segments, and no more after it
                width = len(cut)
                starts = (at + x for x in range(max(-i, more - k + i), min(i, more + k - i) + 1))
                out |= {(size, k, i, own[x : x + width]) for x in starts if 0 <= x <= len(own) - width}
    return out


class Frames:
    """The frame words and frames of an index, and the spellings of typed names that they allow.

    ``frames`` holds sorted frame words, parted by blanks; ``longest`` is the length of the index's longest own part.
    """

    def __init__(self, vocabulary: list[str], frames: list[str], bare: bool = True, longest: int = 64, first: bool = True):
        self.bare = bare  # whether some index name has no frame word
        self.first = first  # whether this block looks up names without a frame
        self.longest = longest
        self.words = set(vocabulary)
        self.widest = max(map(len, vocabulary), default=0)
        self.near: dict[str, set[str]] = defaultdict(set)
        self.by_letter: dict[str, list[str]] = defaultdict(list)
        for w in vocabulary:
            self.by_letter[w[0]].append(w)
            if len(w) >= 5:
                for d in {w} | {w[:i] + w[i + 1 :] for i in range(len(w))}:
                    self.near[d].add(w)
        self.frames = {tuple(sorted(f.split())) for f in frames}
        self.holds: dict[str, set[tuple[str, ...]]] = defaultdict(set)
        for f in self.frames:
            for w in f:
                self.holds[w].add(f)
        self.memo: dict[tuple, object] = {}

    def _remembered(self, key: tuple, make):
        if key not in self.memo:
            if len(self.memo) > 200_000:
                self.memo.clear()
            self.memo[key] = make()
        return self.memo[key]

    def _fits(self, frame: tuple[str, ...]) -> bool:
        """Whether some frame of the index holds all these words, each as often."""

        def look() -> bool:
            sets = sorted((self.holds.get(w, set()) for w in set(frame)), key=len)
            return any(all(f.count(w) >= frame.count(w) for w in set(frame)) for f in sets[0])

        return self._remembered(("fits", frame), look)

    def _with(self, frame: tuple[str, ...], word: str) -> tuple[str, ...] | None:
        new = tuple(sorted((*frame, word)))
        return new if self._fits(new) else None

    def _letter(self, frame: tuple[str, ...], letter: str) -> list[tuple[str, ...]]:
        """The frame with each word that an initial may stand for."""
        return self._remembered(("letter", frame, letter), lambda: [n for v in self.by_letter.get(letter, ()) if (n := self._with(frame, v))])

    def _similar(self, w: str) -> list[str]:
        if not 4 <= len(w) <= self.widest + 1:
            return []
        found = set()
        for d in {w} | {w[:i] + w[i + 1 :] for i in range(len(w))}:
            found |= {v for v in self.near.get(d, ()) if osa(w, v, 1) <= 1}
        return sorted(found)

    def _abbreviated(self, w: str, stop: bool) -> list[str]:
        if not (stop or 2 <= len(w) <= 5) or not 2 <= len(w) < self.widest:
            return []
        out = []
        for v in self.by_letter.get(w[0], ()):
            rest = iter(v)
            if len(w) < len(v) and all(c in rest for c in w) and (stop or v.startswith(w)):
                out.append(v)
        return out if stop or len(out) == 1 else []

    def _options(self, w: str, stop: bool) -> list[tuple[str, str, int]]:
        """(role, word, errors) that a typed word may have: f frame word, o own part, i initial or any frame word with that letter."""
        if w in self.words:
            return [("f", w, 0)]
        if len(w) == 1:
            return [("i", w, 0)]
        own = [] if stop and len(w) <= 5 else [("o", w, 0)]
        known = {v: 1 for v in self._similar(w)} | {v: 0 for v in (*self._abbreviated(w, stop), *NICKNAMES.get(w, "").split()) if v in self.words}
        return [("f", v, e) for v, e in sorted(known.items())] + own or [("o", w, 0)]

    def entry(self, name: str) -> tuple[list[str], str, str]:
        """(frame words, own part, initials) of an index name."""
        frame, own, initials = [], [], []
        for w, _ in words_of(name):
            if w in self.words:
                frame.append(w)
            elif len(w) == 1:
                initials.append(w)
            else:
                own.append(w)
        return sorted(frame), " ".join(own), "".join(initials)

    def cuts(self, name: str) -> list[tuple[str, str, str]]:
        """(frame, own part, initials) under which an index name is looked up.

        Where all words are frame words, as names share them, the last is the own part. A name without frame words stands
        under the empty frame, and its first word is taken for a given name.
        """
        frame, own, initials = self.entry(name)
        words = [w for w, _ in words_of(name) if len(w) > 1]
        if own and frame:
            out = [(" ".join(frame), own, initials)]
            if len(frame) == 1:
                out.append((frame[0][0] + ".", own, initials))
            if len(words) == 2 and words[0] == own:  # a rare given name and a surname that is a frame word
                out.append((own[0] + ".", words[1], initials))
            return out
        if not words:
            return []
        if len(words) == 1:
            return [(initials[0] + ".", words[0], initials[1:])] if initials else [("", words[0], "")]
        out = [] if frame else [("", own, initials)]
        first, last = (words[:-1], words[-1]) if frame else (words[:1], " ".join(words[1:]))
        out.append((" ".join(sorted(first)), last, initials))
        if len(first) == 1:
            out.append((first[0][0] + ".", last, initials))
        return out

    def _keys(self, frame: tuple[str, ...], own: tuple[str, ...], initials: str) -> set[tuple[str, str, str]]:
        """Keys of a reading, as ``cuts`` makes them."""
        keys = set()
        if frame and own:
            keys.add((" ".join(frame), " ".join(own), initials))
            # beside frame words, the short form of a rare given name
            keys |= {(" ".join(frame), g, initials) for g in NICKNAMES.get(" ".join(own), "").split() if g not in self.words}
        elif frame:
            for v in set(frame):
                rest = list(frame)
                rest.remove(v)
                if rest:
                    keys.add((" ".join(rest), v, initials))
                elif initials:
                    keys.add((initials[0] + ".", v, initials[1:]))
                else:
                    keys.add(("", v, ""))
        elif own:
            if initials:
                keys.add((initials[0] + ".", " ".join(own), initials[1:]))
            if self.bare:
                keys |= {("", " ".join(x), initials) for x in (own, own[1:] + own[:1], own[-1:] + own[:-1])}
                for v in set(own) if len(own) > 1 else ():
                    rest = list(own)
                    rest.remove(v)
                    keys |= {(g, " ".join(rest), initials) for g in (v, *NICKNAMES.get(v, "").split()) if g not in self.words}
        return keys

    def spellings(self, name: str) -> list[tuple[str, str, str, int]]:
        """(frame, own part, initials, errors in the frame) that a typed name may stand for.

        Readings are built word by word. One whose frame no index name holds, or whose own part is longer than any, is
        given up at once, which loses nothing; of the initials only the first two are ever compared.
        """
        most = self.longest + 2
        states: dict[tuple[tuple[str, ...], tuple[str, ...], str], int] = {((), (), ""): 0}
        for w, stop in words_of(name):
            new: dict[tuple[tuple[str, ...], tuple[str, ...], str], int] = {}
            for (frame, own, initials), bad in states.items():
                for role, v, e in self._options(w, stop):
                    if role == "f":
                        frames = [f] if (f := self._with(frame, v)) else []
                        got = [(f, own, initials) for f in frames]
                    elif role == "i":
                        got = [(f, own, initials) for f in self._letter(frame, v)] + [(frame, own, (initials + v)[:2])]
                    else:
                        more = (*own, v)
                        # the longest word may yet turn out to be the given name
                        got = [(frame, more, initials)] if sum(map(len, more)) - max(map(len, more)) <= most else []
                    for key in got:
                        new[key] = min(bad + e, new.get(key, bad + e))
            states = new
        out: dict[tuple[str, str, str], int] = {}
        for (frame, own, initials), bad in states.items():
            for key in self._keys(frame, own, initials):
                loose = key[0] == "" or key[0].endswith(".") or not frame
                if len(key[1]) <= most and (self.first if loose else tuple(key[0].split()) in self.frames):
                    out[key] = min(bad, out.get(key, bad))
        return sorted((*k, e) for k, e in out.items())


def _title_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [w for t in b.column(0).to_pylist() if t for w in {w for w, _ in words_of(t)} if len(w) > 1]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["w"])


def _entry_rows(words):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fr = Frames(words.value, [])
        for b in batches:
            rows = []
            for key, title, aliases in zip(*(b.column(i).to_pylist() for i in range(3))):
                seen = set()
                for name in [title, *(aliases or [])]:
                    if not name:
                        continue
                    whole = " ".join(fr.entry(name)[0]) or None
                    for code, own, initials in fr.cuts(name):
                        if (code, own, initials) not in seen:
                            seen.add((code, own, initials))
                            rows += [(key, code, own, initials, len(own), k, i, seg, whole) for k, i, seg in entry_segments(own, errors(len(own)))]
            cols = list(zip(*rows)) or [()] * 9
            kinds = [pa.string()] * 4 + [pa.int32()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["entry_id", "frame", "own", "initials", "size", "level", "part", "text", "whole"])

    return run


def _name_rows(frames):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fr = Frames(*frames.value)
        for b in batches:
            rows = []
            for title in b.column(0).to_pylist():
                for frame, own, initials, bad in fr.spellings(title):
                    rows += [(title, frame, own, initials, bad, *p) for p in typed_segments(own)]
            cols = list(zip(*rows)) or [()] * 9
            kinds = [pa.string()] * 4 + [pa.int32()] * 4 + [pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["title", "frame", "typed", "typed_initials", "bad", "size", "level", "part", "text"])

    return run


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distance of each pair, or nothing beyond the errors allowed; conflicting initials rule a pair out."""
    for b in batches:
        rows = []
        for title, entry, frame, typed, own, ti, ei, bad in zip(*(b.column(i).to_pylist() for i in range(8))):
            k = errors(len(own))
            d = osa(typed, own, k)
            if d > k or (ti and ei and ti[0] != ei[0]):
                continue
            rank = 1000 * (d + bad) + 100 * frame.endswith(".") + 10 * (bool(ti) != bool(ei)) * (2 if ti else 1)
            rows.append((title, entry, rank))
        cols = list(zip(*rows)) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, [pa.string(), pa.string(), pa.int32()])], names=["title", "entry_id", "rank"])


def link_titles(titles: DataFrame, index: DataFrame) -> DataFrame:
    """``title, entry_id`` of the distinct typed names that mean exactly one entry; a tie at the best rank means none.

    The frame words are the index's vocabulary of shared words, whose size grows far slower than the index, and go to
    the workers whole; its frames go there in blocks of ``BLOCK``, with a pass over the typed names each.
    """
    context = titles.sparkSession.sparkContext
    count = index.select("title").mapInArrow(_title_words, "w string").groupBy("w").count().where(F.col("count") >= FRAME_NAMES)
    vocabulary = sorted(r.w for r in count.select("w").collect())
    entries = index.select("id", "title", "aliases").mapInArrow(
        _entry_rows(context.broadcast(vocabulary)),
        "entry_id string, frame string, own string, initials string, size int, level int, part int, text string, whole string",
    )
    entries = stage_table(entries, "name-entries")
    bare, longest, n = entries.agg(F.max(F.isnull("whole")), F.max("size"), F.approx_count_distinct("whole")).first()
    # The work per title is heavy beside its bytes, so that tasks are not merged by size.
    spread = titles.select("title").repartition(int(titles.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    blocks = int((n or 0) * 1.1) // BLOCK + 1
    typed = None
    for i in range(blocks):
        mine = entries.where(F.pmod(F.xxhash64("whole"), F.lit(blocks)) == i)
        frames = sorted({f for r in mine.select("whole", "frame").distinct().collect() for f in (r.whole, r.frame) if f and not f.endswith(".")})
        known = context.broadcast((vocabulary, frames, bool(bare), longest or 0, i == 0))
        part = spread.mapInArrow(_name_rows(known), "title string, frame string, typed string, typed_initials string, bad int, size int, level int, part int, text string")
        typed = part if typed is None else typed.unionByName(part)
    hits = typed.join(entries.select("entry_id", "frame", "own", "initials", "size", "level", "part", "text"), ["frame", "size", "level", "part", "text"])
    pairs = hits.select("title", "entry_id", "frame", "typed", "own", "typed_initials", "initials", "bad").distinct()
    ranked = pairs.mapInArrow(_verify, "title string, entry_id string, rank int").groupBy("title", "entry_id").agg(F.min("rank").alias("rank"))
    tied = ranked.groupBy("title", "rank").agg(F.count("*").alias("n"), F.min("entry_id").alias("entry_id"))
    best = tied.groupBy("title").agg(F.min(F.struct("rank", "n", "entry_id")).alias("b")).where("b.n = 1")
    return best.select("title", F.col("b.entry_id").alias("entry_id"))


def linked(candidate: DataFrame, wiki_index: DataFrame) -> DataFrame:
    """``candidate_id, entry_id``: entity candidates whose title means an entry without being its title or alias.

    Outer blanks and letter case aside. Null and empty titles mean nothing; each row of a repeated title is reported.
    Distinct titles are linked once; rows get their link back by a join that adaptive execution splits at hot titles.
    """
    index = wiki_index.where("id is not null and page_type = 'entity'")
    rows = candidate.where("page_type = 'entity' and title is not null and candidate_id is not null").select("candidate_id", "title")
    key = lambda c: F.lower(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""))
    known = index.select(F.explode(F.concat(F.array("title"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("name"))
    known = known.where("name is not null").select(key(F.col("name")).alias("known")).distinct()
    titles = rows.select("title").distinct().join(known, key(F.col("title")) == F.col("known"), "left_anti")
    return rows.join(link_titles(titles, index), "title").select("candidate_id", "entry_id")
