"""Licence scans by conditional compression.

Text around licence cues is a candidate block, read in overlapping windows, so
that every place a template may take lies whole in one of them, however large the
block. Each window is compressed with each template as a zstandard raw dictionary,
and with a neutral dictionary of the same length (any small dictionary changes how
zstandard packs). What the template saves against the neutral one ranks it: a
template that saves less than ``LEAST_SHARE`` of its own compressed size explains
nothing of the window and is out; the others are winners, the largest saving first.

Winners are confirmed in that order on the exact words: the smallest number of
words to insert, delete or replace between the template and its best place, which
may be at most ``most_differing`` of the template's words, and one in a short
template. The words that name the licence (``NAMES``) and its version must be as
they are, with no word between them; numbers match ``#``. Of confirmed places that
overlap, the one of which its template saves most is taken; of equal savings the
template with fewer differing words, then the earlier in the list. After a
tag that names licences by identifier, the identifiers are read as they stand.

Cues are found over whole texts; a block ends where no further cue stands
within ``_REACH`` characters, and blocks longer than ``_BLOCK`` are cut with an
overlap of a whole template, so no notice falls on a cut. One map, no shuffle:
templates are a fixed list.

Null or empty text has no notice. Each repeated row is scanned for itself. Very
long texts are scanned whole, block by block. An empty table gives an empty
result, and columns beside id and text are not read.
"""

from __future__ import annotations

import re
from typing import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.license_templates import CUES, NAMES, SPELLINGS, TAG, TEMPLATES, VERSIONS

MOST_DIFFERING = 0.1
LEAST_SHARE = 0.1      # of a template's own compressed size; prose saves up to 0.07 of the shortest
_LEVEL = 9
_LEAST_SPAN = 16
_REACH = 250
_BLOCK = 8000
_WORD = re.compile(r"[^\W_]+")
_CUE = re.compile("|".join(map(re.escape, CUES)), re.I)
#: Identifiers behind a tag, joined by operators.
_TAGGED = re.compile(r"\s*:[ \t]*(\(*[\w.+-]*[\w+]\)*(?:[ \t]+(?:AND|OR|WITH)[ \t]+\(*[\w.+-]*[\w+]\)*)*)")
_FOUND = ("array<struct<license:string,template:int,begin:int,end:int,saved_share:double,"
          "n_differing:int,wording:string>>")


def _tokens(text: str) -> list[tuple[str, int, int]]:
    """Lower-cased words with their places; a run of numbers and dots is one ``#`` candidate."""
    out: list[tuple[str, int, int]] = []
    for m in _WORD.finditer(text):
        word = m.group().lower()
        if word.isdigit() and out and out[-1][0].isdigit() and text[out[-1][2]:m.start()] == ".":
            out[-1] = (out[-1][0] + word, out[-1][1], m.end())
        else:
            out.append((SPELLINGS.get(word, word), m.start(), m.end()))
    return out


def _template_words(text: str) -> list[str]:
    return [w for w in re.findall(r"#|[^\W_]+", text.lower())]


class Template:
    def __init__(self, number: int, license_id: str, text: str, most_differing: float = MOST_DIFFERING):
        self.number, self.license, self.words = number, license_id, _template_words(text)
        self.fixed, self.tight = _named(self.words)
        self.named = {w for w, f in zip(self.words, self.fixed) if f}
        self.limit = max(1, int(most_differing * len(self.words)))
        self.longest = len(self.words) + self.limit   # words of a place
        self.span = _LEAST_SPAN                       # windows are two spans long and step by one
        while self.span < self.longest:
            self.span *= 2
        plain = " ".join(self.words).encode()
        self.cost = max(1, len(zstandard.ZstdCompressor(level=_LEVEL).compress(plain)) - _empty_size())
        wording = " ".join(" ".join(self.words).replace("#", v) for v in (VERSIONS if "#" in self.words else ("",)))
        self.dictionary = wording.encode().ljust(8)
        self.compressor = _with_dictionary(self.dictionary)

    def may_hold(self, window: list[str]) -> bool:
        """Whether a stretch has enough of the words, wherever they stand."""
        held = set(window)
        if any(w.isdigit() for w in held):
            held.add("#")
        return self.named <= held and sum(w in held for w in self.words) >= len(self.words) - self.limit

    def align(self, words: list[str]) -> tuple[int, int, int]:
        return align(self.words, words, self.fixed, self.tight)

    def saved(self, window: bytes, neutral: int) -> int:
        """Bytes that the template saves of a window whose size with a neutral dictionary is given."""
        return neutral - len(self.compressor.compress(window))


def _neutral(size: int) -> zstandard.ZstdCompressor:
    """A dictionary of bytes that no UTF-8 text has."""
    return _with_dictionary(bytes(248 + i * i % 7 for i in range(size)))


def _with_dictionary(data: bytes) -> zstandard.ZstdCompressor:
    dictionary = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(level=_LEVEL, dict_data=dictionary)


def _empty_size() -> int:
    return len(zstandard.ZstdCompressor(level=_LEVEL).compress(b""))


def _named(words: list[str]) -> tuple[list[bool], list[bool]]:
    """For each template word: whether it must stand as it is, and whether the next one must follow at once."""
    fixed, tight = [w == "#" for w in words], [False] * len(words)
    for name in map(str.split, NAMES):
        for at in range(len(words) - len(name) + 1):
            if words[at:at + len(name)] == name:
                fixed[at:at + len(name)] = [True] * len(name)
                tight[at:at + len(name) - 1] = [True] * (len(name) - 1)
    return fixed, tight


def align(template: list[str], words: list[str], fixed: list[bool] | None = None,
          tight: list[bool] | None = None) -> tuple[int, int, int]:
    """``(differing words, first, end)`` of the best place of the template among the words.

    A fixed word that differs, or a word after a tight one, counts as more than the whole template.
    """
    m, n = len(template), len(words)
    fixed, tight = fixed or [False] * m, tight or [False] * m
    known = {w: np.array([x == w for x in words], bool) for w in set(template)}
    known["#"] = np.array([x.isdigit() for x in words], bool)
    cost, begin = np.zeros(n + 1, np.int64), np.arange(n + 1)
    for i in range(m):
        weight = m + 1 if fixed[i] else 1
        replace = cost[:-1] + weight * ~known[template[i]]
        new, origin = cost + weight, begin.copy()            # template word missing
        better = replace <= new[1:]
        new[1:][better], origin[1:][better] = replace[better], begin[:-1][better]
        if tight[i]:
            cost, begin = new, origin
            continue
        # An extra word in the text: a running minimum along the row.
        base = new - np.arange(n + 1)
        lowest = np.minimum.accumulate(base)
        source = np.maximum.accumulate(np.where(base == lowest, np.arange(n + 1), 0))
        cost, begin = lowest + np.arange(n + 1), origin[source]
    end = int(cost.argmin())
    return int(cost[end]), int(begin[end]), end


class Scanner:
    def __init__(self, templates=TEMPLATES, most_differing: float = MOST_DIFFERING):
        self.templates = [Template(i, name, text, most_differing) for i, (name, text) in enumerate(templates)]
        self.overlap = 12 * max(len(t.words) for t in self.templates)
        self.by_span: dict[int, list[Template]] = {}
        for t in self.templates:
            self.by_span.setdefault(t.span, []).append(t)
        self.neutral = {len(t.dictionary): _neutral(len(t.dictionary)) for t in self.templates}

    def blocks(self, text: str) -> Iterator[tuple[int, int]]:
        """Candidate stretches of a text."""
        lowered = text.lower()
        if not any(c in lowered for c in CUES):
            return
        lo = hi = -1
        for m in _CUE.finditer(text):
            if lo >= 0 and m.start() - hi > 2 * _REACH:
                yield from self._cut(lo, hi, len(text))
                lo = -1
            lo, hi = (m.start() if lo < 0 else lo), m.end()
        if lo >= 0:
            yield from self._cut(lo, hi, len(text))

    def _cut(self, lo: int, hi: int, n: int) -> Iterator[tuple[int, int]]:
        lo, hi = max(0, lo - _REACH), min(n, hi + _REACH)
        while hi - lo > _BLOCK + self.overlap:
            yield lo, lo + _BLOCK + self.overlap
            lo += _BLOCK
        yield lo, hi

    def ranked(self, words: list[str]) -> list[tuple[int, Template, int]]:
        """``(bytes saved, template, first word of the window)`` of the winners, the best first."""
        out = []
        for span, templates in self.by_span.items():
            for at in range(0, max(1, len(words) - span), span):
                window = " ".join(words[at:at + 2 * span]).encode()
                sizes: dict[int, int] = {}
                for t in templates:
                    n = len(t.dictionary)
                    if n not in sizes:
                        sizes[n] = len(self.neutral[n].compress(window))
                    saved = t.saved(window, sizes[n])
                    if saved >= LEAST_SHARE * t.cost:
                        out.append((saved, t, at))
        return sorted(out, key=lambda x: (-x[0], x[1].number, x[2]))

    def _confirmed(self, block: str) -> Iterator[tuple[int, Template, int, int, int]]:
        """``(bytes saved of the place alone, template, differing words, begin, end)`` of the winners' exact places."""
        tokens = _tokens(block)
        words = [t[0] for t in tokens]
        for _, template, at in self.ranked(words):
            # A place that reaches into the window is whole with a template's length on either side.
            lo, hi = max(0, at - template.longest), at + 2 * template.span + template.longest
            if not template.may_hold(words[lo:hi]):
                continue
            first, last = tokens[at][1], tokens[min(at + 2 * template.span, len(tokens)) - 1][2]
            for differing, a, b in self._places(template, tokens[lo:hi]):
                if a < last and b > first:
                    place = " ".join(t[0] for t in _tokens(block[a:b])).encode()
                    yield self._saved(template, place), template, differing, a, b

    def _saved(self, template: Template, window: bytes) -> int:
        return template.saved(window, len(self.neutral[len(template.dictionary)].compress(window)))

    def _places(self, template: Template, tokens: list) -> Iterator[tuple[int, int, int]]:
        """Every place of the template among the words, the best first."""
        todo = [tokens]
        while todo:
            part = todo.pop()
            differing, first, end = template.align([t[0] for t in part])
            if differing <= template.limit and end > first:
                yield differing, part[first][1], part[end - 1][2]
                todo += [p for p in (part[:first], part[end:]) if len(p) >= len(template.words) - template.limit]

    def scan(self, text: str) -> list[dict]:
        found = []
        for lo, hi in self.blocks(text):
            found += [(-saved, differing, t.number, lo + a, lo + b, t)
                      for saved, t, differing, a, b in self._confirmed(text[lo:hi])]
        out: list[dict] = []
        for saved, differing, _, a, b, t in sorted(found, key=lambda x: x[:5]):
            if all(b <= o["begin"] or a >= o["end"] for o in out):
                name, b = _name(t, text, a, b)
                out.append({"license": name, "template": t.number, "begin": a, "end": b,
                            "saved_share": -saved / t.cost, "n_differing": differing, "wording": text[a:b]})
        return sorted(out, key=lambda o: o["begin"])


def _name(template: Template, text: str, begin: int, end: int) -> tuple[str, int]:
    """The licence's name with its version, or the identifiers behind a tag, and where the notice ends."""
    if template.license == TAG:
        tagged = _TAGGED.match(text, end)
        if not tagged:
            return TAG, end
        name = tagged[1]
        while name.endswith(")") and name.count(")") > name.count("("):   # of a bracket around the whole tag
            name = name[:-1]
        return " ".join(name.split()), tagged.start(1) + len(name)
    return template.license.replace("#", "".join(re.findall(r"\d[\d.]*\d|\d", text[begin:end])[-1:])), end


def scan_column(text: Column) -> Column:
    """Array of the notices found in a text column."""
    @F.pandas_udf(_FOUND)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = Scanner()
        for batch in batches:
            yield pd.Series([scanner.scan(t or "") for t in batch], index=batch.index, dtype=object)

    return scan(text.cast("string"))


def license_notices(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a notice: ``(id, license, template, begin, end, saved_share, n_differing, wording)``."""
    return docs.select(F.col(id_col).alias("id"), F.explode(scan_column(F.col(text_col))).alias("n")).select("id", "n.*")
