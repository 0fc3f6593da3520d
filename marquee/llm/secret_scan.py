r"""Secrets in texts: fixed forms, and strings that compression cannot explain.

Fixed forms (leftmost matches, not overlapping within a kind; a span is the
whole match):

``assign``  a naming word, optional quote and blanks, ``:`` or ``=``, and a value of 12 characters or more
``access``  ``AKIA`` and capitals or digits, 18 characters or more
``hex``     16 or more of ``0-9a-f``

Other candidates are runs of 16 or more characters of ``A-Za-z0-9+/_=-`` that
hold a letter and a digit, have a sensitive word in the 48 characters before
them and touch no span above. Such a run is measured by what it adds to its
surroundings: the zstandard frame of the text around it followed by the run, less
the frame of that text alone, both primed with a dictionary of common
identifiers. Other copies of the run nearby are taken out of the surroundings
first. Names, paths and words are explained by dictionary and surroundings;
a run that costs ``NOVELTY`` times the least size of random characters of its
alphabet, or more, is reported as ``novel``.

Texts are scanned whole, each by itself: no shuffle, nothing gathered, and rows
may be lost and read again. A null text reads as empty and has no spans; repeated
rows and repeated or null ids each get a row. Ties in a span's start are ordered
as the kinds are listed. Very long texts are scanned in place: what is held
beside a text is its spans. An empty table gives an empty result. Only the id and
text columns are read, so other columns may have any name.
"""

from __future__ import annotations

import math
import re
from typing import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import str_rows

KINDS = ("assign", "access", "hex", "novel")
NOVELTY = 1.2        # of the least size of random characters
AROUND = 256         # characters on either side that may explain a candidate
CONTEXT = 48         # characters before a candidate that are searched for a sensitive word
LEVEL = 19

# The three forms.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ASSIGN_VALUE = 12
# A run of such characters is matched whole or not at all, so the least length may stand in the pattern.
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
_NAMING = ("passw", "secret", "token", "api")   # every ASSIGN match holds one, in some case

CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])(?=[0-9+/_=-]*+[A-Za-z])[A-Za-z0-9+/_=-]{16,}")
SENSITIVE = re.compile(r"pass(?:w(?:or)?d|phrase|code)?\b|pwd|secret|token|api[_\x20-]?key|access[_\x20-]?key|bearer"
                       r"|credential|authori[sz]ation|private[_\x20-]?key|client[_\x20-]?id|signature|webhook|cookie"
                       r"|session[_\x20-]?(?:id|key)|://[^\s:/]*:", re.IGNORECASE | re.ASCII)

# Words that names in code and configuration are made of; the compression dictionary.
IDENTIFIERS = """
access account action active address age amount api application args array async auth author authorization base64
batch buffer build button bytes cache callback certificate channel character class client code column command common
component config connection console const content context control cookie count create credential current data database
date debug decode default delete description device directory document domain download element email enable encode
endpoint entity environment error event example export factory false field file filter format function getElementById
global group handler hash header height host html http https image import index init input insert instance integer
interface internal item java json key label language layout length level limit list local location login manager map
max memory message method min model module monitor name network node null number object offset option order output
package page parameter parent parse password path pattern payload person port print private process product profile
project property protocol provider public query queue read record remote request resource response result return role
route sample schema script search secret secure select server service session setting size source state status storage
string style system table target task template text thread time timeout token
""".split()


class Novelty:
    """Marginal compressed bytes of strings, primed with the dictionary of identifiers."""

    def __init__(self, words: list[str] = IDENTIFIERS, level: int = LEVEL):
        import zstandard

        primed = zstandard.ZstdCompressionDict(
            " ".join([*words, *map(str.capitalize, words)]).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        primed.precompute_compress(level=level)
        self.zstd = zstandard.ZstdCompressor(level=level, dict_data=primed, write_content_size=False,
                                             write_checksum=False, write_dict_id=False)

    def marginal_bytes(self, found: str, before: str, after: str) -> int:
        """Bytes that ``found`` adds to the frame of the text around it."""
        around = f"{after} {before}".replace(found, "").encode()
        return len(self.zstd.compress(around + found.encode())) - len(self.zstd.compress(around))

    def score(self, found: str, before: str, after: str) -> float:
        """Marginal bytes against the least size of as many random characters of the same alphabet."""
        return self.marginal_bytes(found, before, after) * 8 / (len(found) * math.log2(alphabet(found)))


def alphabet(found: str) -> int:
    """Size of the smallest usual alphabet that holds the characters of ``found``."""
    if re.fullmatch("[0-9a-f]*|[0-9A-F]*", found):
        return 16
    letters = 26 * (any(c.islower() for c in found) + any(c.isupper() for c in found))
    return letters + 10 * any(c.isdigit() for c in found) + 2 * any(c in "+/_=-" for c in found)


def fixed_forms(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of the three fixed forms, by start, then kind as listed."""
    low = text.lower()
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_VALUE] \
        if any(w in low for w in _NAMING) else []
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return [(lo, hi, KINDS[k]) for lo, k, hi in sorted(found)]


def novel_strings(text: str, taken: list[tuple[int, int, str]], novelty: Novelty,
                  least: float = NOVELTY) -> Iterator[tuple[int, int, str]]:
    """Candidates that touch no span of ``taken`` (sorted by start) and that nothing around them explains."""
    nearest, end = 0, 0
    for m in CANDIDATE.finditer(text):
        lo, hi = m.span()
        while nearest < len(taken) and taken[nearest][0] < hi:
            end = max(end, taken[nearest][1])
            nearest += 1
        if end > lo or not SENSITIVE.search(text, max(0, lo - CONTEXT), lo):
            continue
        if novelty.score(m.group(), text[max(0, lo - AROUND):lo], text[hi:hi + AROUND]) >= least:
            yield lo, hi, KINDS[3]


def find_secrets(text: str, novelty: Novelty, least: float = NOVELTY) -> list[tuple[int, int, str]]:
    """Every span ``(start, end, kind)`` of a text, by start, then kind as listed."""
    base = fixed_forms(text)
    added = list(novel_strings(text, base, novelty, least))
    return sorted([*base, *added], key=lambda s: (s[0], KINDS.index(s[2]))) if added else base


_SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                      T.StructField("end", T.IntegerType())])


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = NOVELTY) -> DataFrame:
    """``id, spans`` for every row: the spans (kind, start, end in code points, end exclusive) in order."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType),
                           T.StructField("spans", T.ArrayType(_SPAN))])
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty()
        for batch in batches:
            spans = [[{"kind": k, "start": lo, "end": hi} for lo, hi, k in find_secrets(text, novelty, least)]
                     for text in str_rows(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, arrow)], ["id", "spans"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def of_kind(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))
