"""Labels of whole licences, of members of one family, and of passages and phrases of any length."""

import pytest
from inputs import docs

from shelfmark.llm import license_scan
from shelfmark.llm.license_texts import TEMPLATES

WHOLE = license_scan.build(TEMPLATES, license_scan.PHRASES)
GPL_BASE = ["gpl"]  # the base phrase also stands in the names of the other GNU licences


def labels(text, automaton=WHOLE):
    return license_scan.scan(text.encode(), automaton)["labels"]


@pytest.mark.parametrize(
    ("text", "wanted"),
    [
        ("This work is licensed under a Creative Commons Attribution 4.0 International License.", ["cc-by"]),
        ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", ["cc-by-sa"]),
        ("This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.", ["cc-by-nd"]),
        ("Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License", ["cc-by-nc-sa"]),
        ("Creative Commons Attribution-NonCommercial-NoDerivs 3.0 Unported License", ["cc-by-nc-nd"]),
        ("Licensed under CC BY-NC-SA 4.0.", ["cc-by-nc-sa"]),
        ("Licensed under CC BY-NC 4.0.", ["cc-by-nc"]),
        ("see https://creativecommons.org/licenses/by-sa/4.0/", ["cc-by-sa"]),
        ("released with a Creative Commons Zero dedication", ["cc0"]),
        ("This work is licensed under a Creative Commons", []),
        ("the creative commons movement, attribution and all, 4.0 of it, is international", []),
        ("licensed under the GNU Lesser General Public License version 2.1", ["gpl", "lgpl"]),
        ("GNU Affero General Public License v3", ["agpl", "gpl"]),
        ("GNU General Public License version 3", GPL_BASE),
        (TEMPLATES["mit"][2], ["mit"]),
        (TEMPLATES["bsd"][4], ["bsd"]),
        (TEMPLATES["isc"][1], ["isc"]),
        (TEMPLATES["boost"][0], ["boost"]),
    ],
)
def test_named_texts(text, wanted):
    assert labels(text) == wanted
    assert labels("Some words before it. " + text + " And some after it.") == wanted


@pytest.mark.parametrize("label", sorted(TEMPLATES))
def test_every_passage_has_its_own_label_only(label):
    for passage in TEMPLATES[label]:
        found = license_scan.scan(passage.encode(), WHOLE)
        assert label in found["labels"] and set(found["labels"]) <= {label, *found["base_labels"]}, passage


@pytest.mark.parametrize("label", ["mit", "bsd", "isc", "zlib", "unlicense"])
def test_a_whole_licence(label):
    text = "\n\n".join(TEMPLATES[label])
    assert labels("Copyright (c) 2020 Someone\n\n" + text) == [label]
    words = text.split()
    del words[30:33]  # an edited one still chains
    assert labels(" ".join(words)) == [label]


@pytest.mark.parametrize(("name", "wanted"), [("gpl", ["gpl"]), ("lgpl", ["gpl", "lgpl"]), ("agpl", ["agpl", "gpl"])])
def test_notices_that_nearly_cover_each_other(name, wanted):
    notice = next(p for p in TEMPLATES[name] if p.startswith("This program is free"))
    found = license_scan.scan(notice.encode(), WHOLE)
    assert found["labels"] == wanted and {s["label"] for s in found["spans"]} == {name}
    both = " ".join(p for key in ("lgpl", "gpl") for p in TEMPLATES[key] if p.startswith("This program is free"))
    spans = license_scan.scan(both.encode(), WHOLE)["spans"]
    assert {s["label"] for s in spans} == {"gpl", "lgpl"}


def test_short_passages_and_phrases_of_one_word():
    automaton = license_scan.build({"p": ["x"], "q": ["a b c"], "empty": [""]}, {"solo": "s", "": "none"})
    found = license_scan.scan(b"u solo v x w a b c", automaton)
    assert (found["n_base"], found["base_labels"], found["labels"]) == (1, ["s"], ["p", "q", "s"])
    assert [(s["label"], s["a"], s["b"]) for s in found["spans"]] == [("p", 3, 4), ("q", 5, 8)]
    assert labels("a b u c", automaton) == []


def test_long_texts_and_rows(spark):
    filler = "plain words that no licence has got " * 20_000
    rows = [(1, filler + TEMPLATES["mit"][2] + " " + filler), (2, None), (3, ""), (4, "CC BY-ND 4.0 " * 5000)]
    got = {r.doc_id: r for r in license_scan.scan_licenses(docs(spark, rows)).collect()}
    assert got[1].labels == ["mit"] and len(got[1].spans) == 1
    assert got[1].spans[0].a == len(filler.split())
    assert (got[2].labels, got[2].score, got[3].labels, got[3].score) == ([], 0.0, [], 0.0)
    assert got[4].labels == ["cc-by-nd"] and got[4].score == 1.0
