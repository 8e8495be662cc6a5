import re

import pytest

from paperloom.llm import licenses


def _scan(text):
    return licenses.scanner()(text)


def test_base_places_and_positions():
    text = "A. Under the MIT License, under the mit license! CC BY-NC; Apache License, Version 2.0"
    n_words, n_base, first, last, base, labels, score = _scan(text)
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())
    assert (n_words, n_base, first, last) == (len(words), 4, 1, words.index("apache"))
    assert base == "apache-2,cc-by-nc,mit"
    assert set(base.split(",")) <= set(labels.split(",")) and 0 < score <= 1


def test_words_beside_the_phrase_do_not_match():
    assert _scan("under the mit-e license")[1] == 0
    assert _scan("xunder the mit license")[1] == 0
    assert _scan("under the\nMIT\tlicense")[1] == 1
    assert _scan("under the mıt license")[1] == 0  # only A-Z is folded


@pytest.mark.parametrize(
    ("text", "label"),
    [
        ("Released under the terms of the MIT License", "mit-notice"),
        ("GNU Affero General Public License as published by the Free Software Foundation, either version 3", "gpl"),
        ("GNU GENERAL PUBLIC LICENSE, Version 2", "gpl"),
        ("Mozilla Public License, v. 2.0", "mpl"),
        ("Copyright (c) 2020 Some Body. All rights reserved", "rights-reserved"),
    ],
)
def test_optional_and_replaceable_regions(text, label):
    assert label in _scan(text)[5].split(",")


def test_mandatory_wording_must_match_exactly():
    assert "gpl" not in _scan("GNU public license version 2")[5]
    assert _scan("Copyright " + "x " * 9 + "all rights reserved")[5] == ""
    assert "rights-reserved" in _scan("Copyright " + "x " * 8 + "all rights reserved")[5]


def test_a_template_that_begins_with_a_replaceable_region():
    scan = licenses.scanner(templates={"any": "<<var;1;2>> public license", "maybe": "<<beginOptional>> <<var;1;1>> <<endOptional>> open words"})
    for text, labels in (
        ("foo public license", "any"), ("a b foo public license", "any"), ("public license", ""), ("x open words", "maybe"), ("open words", "maybe"),
    ):
        assert scan(text)[5] == labels, text


def _filled(markup, optional=True):
    """A license with its regions filled in, with commas and capitals as a file has them."""
    text = re.sub(r"<<beginOptional>>(.*?)<<endOptional>>", r"\1" if optional else " ", markup)
    return re.sub(r"<<var;\d+;\d+>>", "THE Author, or Holders", text).replace(" the ", ", The ").replace(" software ", "\n SOFTWARE. ")


@pytest.mark.parametrize("label", ["apache-2-header", "bsd-2-clause", "bsd-3-clause", "isc-license", "mit-license"])
def test_whole_licenses(label):
    markup = licenses.TEMPLATES[label]
    assert len(markup.split()) > 80
    for optional in (True, False):
        text = "Copyright (c) 2020 A.\n\n" + _filled(markup, optional) + "\nint main() {}"
        found = _scan(text)
        assert label in found[5].split(",") and found[6] == 1.0
        # One word of the mandatory wording changed, dropped or added: no longer this license.
        words = text.split()
        at = next(i for i, w in enumerate(words) if w in ("notice", "express") and i > 30)
        for changed in ([*words[:at], "other", *words[at + 1 :]], words[:at] + words[at + 1 :], [*words[:at], "very", *words[at:]]):
            assert label not in _scan(" ".join(changed))[5].split(",")
    two, three = (_scan(_filled(licenses.TEMPLATES[f"bsd-{n}-clause"]))[5].split(",") for n in (2, 3))
    assert "bsd-3-clause" not in two and "bsd-2-clause" not in three


def test_markup_is_checked():
    with pytest.raises(ValueError, match="without an end"):
        licenses.Automaton({"t": "a <<beginOptional>> b"})
    with pytest.raises(ValueError, match="unknown markup"):
        licenses.Automaton({"t": "a <<other>> b"})


def test_tables(docs_of, edge_rows):
    got = licenses.scan_documents(docs_of([*edge_rows, (9, "under the mit license")])).collect()
    assert len(got) == len(edge_rows) + 1
    by_id = {r.doc_id: r for r in got}
    assert tuple(by_id[1])[1:] == (0, 0, None, None, "", "", 0.0)
    assert by_id[9].base_labels == "mit"
    assert licenses.scan_documents(docs_of([])).collect() == []
