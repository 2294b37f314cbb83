"""Readers of payloads: rules of each format that the golden payloads do not show."""

import pytest

from gleaner.operators.parsers import parse_payload


def read(text, format=None):
    return parse_payload(text.encode(), format)


def test_markup_of_any_depth():
    depth = 50_000
    for start, format in (("<?xml version='1.0'?>", "xml"), ("", "html")):
        found, value = read(start + "<a>" * depth + "x" + "</a>" * depth)
        assert found == format
        for _ in range(depth - 1):
            value = value["a"]
        assert value == "x"


def test_names_of_the_record_itself():
    assert read('<div tail_text="attribute">own<b>two</b>after</div>') == ("html", {"tail_text": ["attribute", "after"], "b": "two", "text": "own"})
    assert read("<div><tail_text>e</tail_text>after</div>") == ("html", {"tail_text": ["e", "after"]})
    assert read('<a text="attribute">own</a>') == ("html", "own")
    assert read("<p>a</p><p>b</p>c") == ("html", {"p": ["a", "b"], "tail_text": ["c"]})


def test_text_around_comments_and_instructions():
    assert read("<?xml version='1.0'?><r>own<?skip it?>dropped<b/>kept<!-- c -->dropped</r>") == ("xml", {"b": "", "tail_text": ["kept"], "text": "own"})


@pytest.mark.parametrize("text", ["a,b\n1,2,3", "a\n1", "a,a\n1,2", "a,b\n", "a," + "b" * 61 + "\n1,2"])
def test_no_csv(text):
    assert read(text, "csv") == (None, None)


def test_uneven_csv():
    assert read('a,b\n1\n\n"x\ny",2,3,4') == ("csv", [{"a": "1", "b": None}, {"a": "x\ny", "b": "2", None: ["3", "4"]}])


def test_markdown_outline():
    text = "intro\n# A\n### deep\n| h | k |\n|:-|-:|\n| 1 | 2 | 3 |\nwords\n| no table |\nmore\n## A (2)\nB\n---\n# A\n# A\n| x |\n===\nend"
    assert read(text) == ("markdown", {
        "text": "intro",
        "A": {"deep": {"tables": [{"h": "1", "k": "2"}], "text": "words\nmore"}, "A (2)": {}, "B": {}},
        "A (2)": {}, "A (3)": {}, "| x |": {"text": "end"},
    })
    assert read("# A\n# A (2)\n# A\n# A")[1] == {"A": {}, "A (2)": {}, "A (3)": {}, "A (4)": {}}


def test_markdown_heading_must_be_near_the_top():
    assert read("x\n" * 100 + "# late\n", "markdown") == (None, None)
    assert read("x\n" * 99 + "# in time\n", "markdown")[1]["in time"] == {}


def test_many_sections_of_one_title():
    assert len(read("# A\n" * 20_000)[1]) == 20_000
