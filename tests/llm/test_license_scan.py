import random
import re
import zlib

import pytest

from conftest import SMALL_SF
from helpers import LONG, awkward, empty
from marquee.llm import license_scan
from marquee.llm.license_templates import TEMPLATES
from marquee.llm.queries import QUERIES

SF = SMALL_SF.replace("0.001", "0.01")
NOTICE = re.compile(r"Licensed under CC BY-NC [\d.]*\d|This work is licensed under the GNU General Public License, version [\d.]*\d"
                    r"|Licensed under the Apache License, Version [\d.]*\d|Released under the MIT License")


def test_whole_table_equals_a_search_for_the_notices_it_holds(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = sorted((r.doc_id, *m.span()) for r in docs for m in NOTICE.finditer(r.text or ""))
    rows = QUERIES["op2_license_scan"](spark, SF).collect()
    assert want and sorted((r.doc_id, r.begin, r.end) for r in rows) == want
    assert all(r.n_differing == 0 for r in rows)


@pytest.fixture(scope="module")
def scanner():
    return license_scan.Scanner()


def plain_distance(template, words):
    """Least word edits between the template and any stretch of the words."""
    row = [0] * (len(words) + 1)
    for i, t in enumerate(template):
        new = [i + 1]
        for j, w in enumerate(words):
            same = w.isdigit() if t == "#" else w == t
            new.append(min(row[j] + (not same), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_alignment_equals_plain_edit_distance():
    rng = random.Random(4)
    for _ in range(300):
        template = [rng.choice(["a", "b", "c", "#"]) for _ in range(rng.randrange(1, 9))]
        words = [rng.choice(["a", "b", "c", "7"]) for _ in range(rng.randrange(1, 15))]
        cost, first, end = license_scan.align(template, words)
        assert cost == plain_distance(template, words) and 0 <= first <= end <= len(words)
        assert plain_distance(template, words[first:end]) == cost


def test_every_template_is_found_with_small_changes(scanner):
    for name, text in TEMPLATES:
        text = text.replace("#", "2.0")
        for wording, differing in ((text, 0), (text.upper(), 0), (text.replace(" ", "\n  * "), 0)):
            found = scanner.scan(f"Foo bar.\n{wording}\nEt cetera, " + "more words. " * 30)
            assert [(f["license"], f["n_differing"]) for f in found] == [(name.replace("#", "2.0"), differing)]
    long = TEMPLATES[0][1].replace("free of charge", "without charge")
    assert [(f["license"], f["n_differing"]) for f in scanner.scan(long)] == [("MIT", 2)]


def test_near_but_other_wordings_are_not_taken(scanner):
    assert [f["license"] for f in scanner.scan("Licensed under CC BY-NC 4.0.")] == ["CC-BY-NC-4.0"]
    for text in ("Licensed under the Acme License, Version 2.0.", "Released under the old License.", "a license to kill",
                 "copyright 2020, all rights reserved"):
        assert scanner.scan(text) == []


def test_repeated_and_far_apart_notices(scanner):
    one, other = "Released under the MIT License. ", "Licensed under CC BY-SA 3.0. "
    text = (one * 3 + "word " * 3000 + other + "licence word " * 2000 + one)
    assert [f["license"] for f in scanner.scan(text)] == ["MIT"] * 3 + ["CC-BY-SA-3.0", "MIT"]


def test_awkward_rows(spark, scanner):
    assert license_scan.license_notices(awkward(spark)).count() == 0
    assert license_scan.license_notices(empty(spark)).count() == 0
    assert [f["begin"] for f in scanner.scan(LONG + "Released under the MIT License")] == [len(LONG)]


def prose(rng, n_chars, notice=""):
    """Varied prose of one candidate block with the notice somewhere inside."""
    words, size = [], 0
    while size < n_chars:
        words.append("licensing" if len(words) % 30 == 0 else "".join(rng.choice("aeioulnrstmd") for _ in range(rng.randrange(2, 11))))
        size += len(words[-1]) + 1
    at = rng.randrange(len(words))
    return " ".join(words[:at] + [notice] + words[at:])


@pytest.mark.parametrize("n_chars", [1000, 2500, 5000, 9000, 30000])
def test_notices_in_blocks_of_any_size(scanner, n_chars):
    rng = random.Random(n_chars)
    for name, text in TEMPLATES:
        notice = text.replace("#", "4.0")
        found = scanner.scan(prose(rng, n_chars, notice))
        assert [(f["license"], f["n_differing"]) for f in found] == [(name.replace("#", "4.0"), 0)]
    assert scanner.scan(prose(rng, n_chars)) == []


def test_changed_notice_before_a_better_one(scanner):
    text = TEMPLATES[0][1]
    changed = text.replace("free of charge, ", "")
    found = scanner.scan(f"{changed} {text}")
    assert [(f["license"], f["n_differing"]) for f in found] == [("MIT", 3), ("MIT", 0)]


def licenses(scanner, text):
    return [f["license"] for f in scanner.scan(text)]


def test_the_name_of_a_licence_is_never_taken_for_another(scanner):
    header = next(text for name, text in TEMPLATES if name == "GPL-#" and text.startswith("This program")).replace("#", "3")
    assert licenses(scanner, header) == ["GPL-3"]
    for word, name in (("Lesser", "LGPL-3"), ("Affero", "AGPL-3"), ("Library", "LGPL-3")):
        changed = header.replace("General", f"{word} General")
        assert licenses(scanner, changed) == [name]
        assert licenses(scanner, changed.replace("program", "library")) == [name]
    short = "This work is licensed under the GNU {}General Public License, version 3."
    assert [licenses(scanner, short.format(x)) for x in ("", "Lesser ", "Affero ", "Other ")] == [
        ["GPL-3"], ["LGPL-3"], ["AGPL-3"], []]
    assert licenses(scanner, "Licensed under CC BY-NC-ND 4.0.") == ["CC-BY-NC-ND-4.0"]
    for text in ("Licensed under CC BY-XY 4.0.", "Licensed under the MIT-0 License.", "Licensed under the European Public License, v. 2.0.",
                 "Creative Commons Attribution-Sampling 1.0 International", "Licensed under the Apache License, Version two."):
        assert licenses(scanner, text) == []


def test_bsd_with_advertising_clause_is_not_the_shorter_one(scanner):
    text = dict(TEMPLATES)["BSD-4-Clause"].replace("developed by the copyright holder", "developed by the University of Nowhere")
    assert licenses(scanner, text) == ["BSD-4-Clause"]
    text = text.replace("copyright holder nor", "University nor")
    assert licenses(scanner, text.replace(" ", "  ")) == ["BSD-4-Clause"]


def test_short_wordings_may_differ_in_one_other_word(scanner):
    for text, name in (("Released under an MIT License", "MIT"), ("Released under the MIT Licence", "MIT"),
                       ("Distributed under the MIT License.", "MIT"), ("Licensed under the Apache License 2.0", "Apache-2.0"),
                       ("License under CC0 1.0", "CC0-1.0"), ("Licensed under a CC BY-SA 3.0 license", "CC-BY-SA-3.0"),
                       ("Creative Commons Attribution-NonCommercial 3.0 Unported", "CC-BY-NC-3.0"),
                       ("Creative Commons\nAttribution 4.0 International", "CC-BY-4.0")):
        assert licenses(scanner, text) == [name], text


def test_alignment_with_fixed_words_equals_plain_edit_distance():
    rng = random.Random(6)

    def plain(template, words, fixed, tight):
        row, far = [0] * (len(words) + 1), len(template) + 1
        for i, t in enumerate(template):
            w = far if fixed[i] else 1
            new = [row[0] + w]
            for j, x in enumerate(words):
                ways = [row[j] + w * (x != t), row[j + 1] + w] + ([] if tight[i] else [new[j] + 1])
                new.append(min(ways))
            row = new
        return min(row)

    for _ in range(300):
        template = [rng.choice("abc") for _ in range(rng.randrange(1, 9))]
        fixed, tight = ([rng.random() < 0.4 for _ in template] for _ in range(2))
        words = [rng.choice("abc") for _ in range(rng.randrange(1, 15))]
        assert license_scan.align(template, words, fixed, tight)[0] == plain(template, words, fixed, tight)


@pytest.mark.parametrize("saving", [lambda *_: 0, lambda *_: 1000, lambda self, window, neutral: zlib.crc32(window) % 40 - 20])
def test_compression_decides(spark, scanner, monkeypatch, saving):
    """With another number in place of the bytes saved, notices are lost or come out under other templates."""
    rng = random.Random(8)
    texts = [prose(rng, 1500, text.replace("#", "3.0")) for _, text in TEMPLATES]
    want = [scanner.scan(t) for t in texts]
    assert all(len(found) == 1 for found in want)
    monkeypatch.setattr(license_scan.Template, "saved", saving)
    assert [scanner.scan(t) for t in texts] != want
    got = [[(f["template"], f["begin"], f["end"]) for f in scanner.scan(t)] for t in texts]
    assert got != [[(f["template"], f["begin"], f["end"]) for f in found] for found in want]


def test_the_right_template_saves_most(scanner):
    """In prose of any length, the template that stands there ranks first or level, changed words or not."""
    rng = random.Random(9)
    for t in scanner.templates:
        for n_chars in (1000, 4000, 9000):
            words = [w.replace("#", "2.0") for w in t.words]
            free = [i for i, f in enumerate(t.fixed) if not f]
            if free and n_chars > 1000:
                words[rng.choice(free)] = "otherwise"
            block = [x[0] for x in license_scan._tokens(prose(rng, n_chars, " ".join(words)))]
            ranked = scanner.ranked(block)
            best = max((saved for saved, other, _ in ranked if other is t), default=None)
            assert best is not None and best >= license_scan.LEAST_SHARE * t.cost
            rivals = [o for saved, o, _ in ranked if saved > best]
            assert all(set(t.words) & set(o.words) for o in rivals)


def test_headings_and_headers_name_the_licence(scanner):
    for text, name in (("Apache License\n   Version 2.0, January 2004\n   http://example.org/", "Apache-2.0"),
                       ("GNU GENERAL PUBLIC LICENSE\n  Version 3, 29 June 2007", "GPL-3"),
                       ("GNU AFFERO GENERAL PUBLIC LICENSE Version 3", "AGPL-3"),
                       ("Eclipse Public License - v 2.0", "EPL-2.0"),
                       ("Licensed under the Eclipse Public License, v. 2.0.", "EPL-2.0"),
                       ("Everyone is permitted to copy and distribute verbatim or modified copies of this license document, "
                        "and changing it is allowed as long as the name is changed.", "WTFPL"),
                       (dict(TEMPLATES)["Zlib"].replace("authors", "author"), "Zlib")):
        assert licenses(scanner, text) == [name], text


def test_identifiers_behind_a_tag(scanner):
    for text, name in (("// SPDX-License-Identifier: MIT", "MIT"), ("# SPDX-License-Identifier: GPL-2.0-or-later\nint x;", "GPL-2.0-or-later"),
                       ("(SPDX-License-Identifier: Apache-2.0).", "Apache-2.0"),
                       ("SPDX-License-Identifier: MIT OR (BSD-3-Clause AND  ISC).", "MIT OR (BSD-3-Clause AND ISC)"),
                       ("the SPDX License Identifier of a file", "SPDX")):
        found = scanner.scan(text)
        assert [f["license"] for f in found] == [name] and text[found[0]["begin"]:found[0]["end"]] == found[0]["wording"]
    assert scanner.scan("SPDX-Identifier: MIT") == []
