"""Printed numbers against the fixed cases of the blueprint's fixtures, title-page fields, registry and settings."""

import pytest

from quire import registry
from quire.operators import binding

REGION = "page_key string, region_id int, label string, x double, y double, width double, height double, confidence double, alto_text string, matched boolean"
CASES = [  # candidates (text, confidence, y, x), edge only, chosen
    ([("42", 0.7, 490, 100)], False, "42"), ([("12", 0.6, 20, 100), ("99", 0.99, 490, 100)], False, "12"), ([("12", 0.8, 300, 100), ("13", 0.9, 600, 100)], False, None),
    ([("12", 0.6, 10, 100), ("13", 0.99, 920, 100)], False, "12"), ([("42", 0.9, 490, 100)], True, None), ([("42", 0.9, 20, -1)], False, None), ([("42", 0.9, 981, 100)], False, None), ([("42", 0.9, 20, 751)], False, None),
]


@pytest.mark.parametrize("edge_only", [False, True])
def test_page_numbers(spark, edge_only):
    cases = [(f"p{i}", c, want) for i, (c, e, want) in enumerate(CASES) if e == edge_only]
    rows = [(k, j, "number", float(x), float(y), 50.0, 20.0, conf, t, True) for k, c, _ in cases for j, (t, conf, y, x) in enumerate(c)]
    pages = spark.createDataFrame([(k, 800.0, 1000.0) for k, _, _ in cases], "page_key string, width double, height double")
    got = {r.page_key: r.norm for r in binding.page_numbers(spark.createDataFrame(rows, REGION), pages, "number", edge_only=edge_only).collect()}
    assert got == {k: w for k, _, w in cases if w}


def test_title_page(spark):
    box = (1.0, 1.0, 5.0, 5.0)
    rows = [("a", 0, "Title", *box, 0.5, "first", True), ("a", 1, "Title", *box, 0.9, "best", True), ("a", 2, "Title", *box, 0.9, "late", True), ("a", 3, "Author", *box, 0.2, "x", True), ("a", 4, "Author", *box, 0.9, "y", True), ("a", 5, "PeriodicalIssueDateIssued", *box, 0.9, "1900", True), ("b", 0, "PartNumber", *box, 0.9, "2", True), ("b", 1, "Title", *box, 0.9, "lost", False)]
    r = spark.createDataFrame(rows, REGION)
    f = binding.title_page_fields(r)
    got = {(x.page_key, x.target, x.field): x.texts for x in f.collect()}
    assert got["a", "volume", "title"] == got["a", "issue", "title"] == ["best"] and got["a", "volume", "author"] == ["x", "y"] and ("b", "volume", "title") not in got
    assert {x.page_key: x.hierarchy for x in binding.hierarchy(r).collect()} == {"a": "monograph", "b": "multipart"}  # an issue label alone makes no periodical
    assert {x.page_key: (x.volume, x.issue) for x in binding.emitted(f).collect()} == {"a": (True, True), "b": (False, False)}


def test_registry_and_settings():
    r = registry.Registry()
    r.register("page_number", "edge", "quire.operators.binding", "page_numbers")
    r.register("biblio", "odd", "no_such_module_here", "f")
    assert r.load("page_number", "edge") is binding.page_numbers
    with pytest.raises(ValueError, match="no_such_module_here.*no engine"):
        r.preflight({"biblio": "odd", "chapter": "x"})
    assert registry.merged({"a": {"b": 1, "c": 2}}, {"a": {"b": 3}}) == {"a": {"b": 3, "c": 2}}
    assert registry.assigned({"a": {"b": 1}}, "a:c:d", 2) == {"a": {"b": 1, "c": {"d": 2}}}
