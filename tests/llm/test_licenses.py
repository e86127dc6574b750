import random
import textwrap

import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaarlake.llm import licenses

CASES = [
    ("Released under the MIT License.", "MIT-notice", ""),
    ("Some words.\nreleased  under the mit license\nmore words", "MIT-notice", ""),
    ("Licensed under CC BY-NC 4.0.\nText goes on.", "CC-BY-NC-4.0", ""),
    ("Licensed under CC BY 4.0.", "CC-BY-4.0", ""),
    ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0-notice", ""),
    ("This work is licensed under the GNU Public License, version 3.", "GPL-3.0-notice", "-general +"),
    ("Licensed under the Apache License, Version 2.0. All else is prose.", "Apache-2.0-notice", ""),
    ("(c) somebody. All rights reserved.", "All-rights-reserved", ""),
    (licenses.TEMPLATES["MIT"].replace("Software", "Program", 1), "MIT", "-software +program"),
    (licenses.TEMPLATES["ISC"], "ISC", ""),
]


@pytest.mark.parametrize("text, name, differences", CASES)
def test_notice_and_its_differences(text, name, differences):
    scanner = licenses.Scanner(licenses.TEMPLATES)
    assert [(n.license, n.differences) for _, n in scanner.notices(text)] == [(name, differences)]


@pytest.mark.parametrize("text", ["", "A driving licence is a document.", "No copyright here, as is the case.", "plain prose " * 50])
def test_other_texts_are_left_alone(text):
    scanner = licenses.Scanner(licenses.TEMPLATES)
    assert scanner.notices(text) == []


def test_notices_side_by_side_are_told_apart():
    scanner = licenses.Scanner(licenses.TEMPLATES)
    text = "Licensed under CC BY-NC 4.0.\nReleased under the MIT License.\nAll rights reserved.\n" + licenses.TEMPLATES["MIT"]
    found = [n.license for _, n in scanner.notices(text)]
    assert found == ["CC-BY-NC-4.0", "MIT-notice", "All-rights-reserved", "MIT"]


def wrapped(text, mark="", width=72):
    return "\n".join(mark + line for line in textwrap.wrap(text, width - len(mark), break_on_hyphens=False, break_long_words=False))


LAYOUTS = {
    "flat": lambda t: t,
    "wrapped": wrapped,
    "hash": lambda t: wrapped(t, "# "),
    "star": lambda t: "/*\n" + wrapped(t, " * ") + "\n */\nint main;",
    "slashes": lambda t: wrapped(t, "// "),
    "html": lambda t: "<!-- " + wrapped(t) + " -->\n<p>",
    "dos": lambda t: wrapped(t, "  ; ").replace("\n", "\r\n"),
    "prose": lambda t: "Ander thon the ing " * 40 + "\n" + wrapped(t) + "\n" + "erat fomi duma coru " * 40,
    "paragraphs": lambda t: "Title\n\n" + wrapped(t).replace(": ", ":\n\n") + "\n\nCode",
}


@pytest.mark.parametrize("layout", LAYOUTS)
def test_every_template_in_every_layout(layout):
    scanner = licenses.Scanner(licenses.TEMPLATES)
    for name, text in licenses.TEMPLATES.items():
        found = [(n.license, n.matched, n.differences) for _, n in scanner.notices(LAYOUTS[layout](text))]
        assert found == [(name, 1.0, "")], (layout, name)


def altered(rng, text):
    """The text with up to a fifth of its words left out or replaced, and some put in between."""
    words = text.split()
    for at in rng.sample(range(len(words)), int(rng.random() * 0.25 * len(words))):
        words[at] = rng.choice(["", "altered", "the"])
    for _ in range(int(rng.random() * 0.2 * len(words))):
        words.insert(rng.randrange(len(words)), "inserted")
    return " ".join(w for w in words if w)


def test_the_compression_rules_out_no_template_that_fits():
    rng = random.Random(3)
    scanner, all_templates = licenses.Scanner(licenses.TEMPLATES), licenses.Scanner(licenses.TEMPLATES, -10.0)
    prose = lambda: " ".join(rng.choice(["thon", "erat", "work", "license", "the", "of", "copy", "4.0", "under"]) for _ in range(rng.randrange(30)))
    names, n = sorted(licenses.TEMPLATES), 0
    for _ in range(400):
        text = "\n".join(part for name in rng.sample(names, 2) for part in (prose(), wrapped(altered(rng, licenses.TEMPLATES[name]))))
        shown = [(t, f.license, f.matched, f.differences) for t, f in scanner.notices(text)]
        n += len(shown)
        assert shown == [(t, f.license, f.matched, f.differences) for t, f in all_templates.notices(text)]
    assert n > 400


def plain_fit(wanted, words):
    """Least edits of all stretches of words, by difflib's ratio of none: every stretch is compared by an edit table of its own."""
    best = None
    for a in range(len(words) + 1):
        row = list(range(len(wanted) + 1))
        for b in range(a, len(words) + 1):
            if b > a:
                new = [row[0] + 1]
                for i, w in enumerate(wanted):
                    new.append(min(row[i + 1] + 1, new[i] + 1, row[i] if w == words[b - 1] else 10**6))
                row = new
            if best is None or row[-1] < best:
                best = row[-1]
    return best


def test_the_best_stretch_of_words():
    rng = random.Random(4)
    for _ in range(150):
        wanted, words = [rng.randrange(6) for _ in range(rng.randrange(1, 9))], [rng.randrange(-1, 6) for _ in range(rng.randrange(0, 14))]
        start, end, equal, inserted = licenses.fit(wanted, np.array(words, np.int64))
        assert len(wanted) - equal + inserted == plain_fit(wanted, words) and end - start == equal + inserted


def test_rows(spark):
    long = "words without meaning " * 50_000 + "\nReleased under the MIT License.\n" + "more of them " * 50_000 + "\nAll rights reserved."
    rows = [(1, CASES[0][0]), (1, CASES[0][0]), (2, None), (3, ""), (4, long), (None, CASES[3][0]), (5, "nothing")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("license", F.lit("clash"))
    got = sorted(((r.doc_id, r.block, r.license) for r in licenses.scan_licenses(docs).collect()), key=str)
    assert got == sorted([(1, 0, "MIT-notice"), (1, 0, "MIT-notice"), (4, 0, "MIT-notice"), (4, 1, "All-rights-reserved"), (None, 0, "CC-BY-4.0")], key=str)
    assert licenses.scan_licenses(docs.limit(0)).count() == 0
