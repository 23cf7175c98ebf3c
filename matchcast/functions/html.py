"""Extraction from markup by column expressions; nested elements by a parser over Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Elements without an end tag: fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


def find_all(html: Column, pattern: str, group: int = 1) -> Column:
    """Every match of a flat element's pattern."""
    return F.regexp_extract_all(html, F.lit(pattern), F.lit(group))


def find_first(html: Column, pattern: str, group: int = 1) -> Column:
    """The first match, or null."""
    return F.get(find_all(html, pattern, group), F.lit(0))


def text_of(html: Column, tag: str) -> Column:
    """Text of the first flat element of a tag, or null."""
    return find_first(html, rf"(?s)<{tag}\b[^>]*>([^<]*)</{tag}>")


def attribute(html: Column, name: str) -> Column:
    """Value of the first such attribute, or null."""
    return find_first(html, rf'\b{name}="([^"]*)"')


def attributes(html: Column, tag: str, name: str) -> Column:
    """Values of an attribute over all elements of a tag."""
    return find_all(html, rf'<{tag}\b[^>]*?\b{name}="([^"]*)"')


def has_classes(value: Column, *wanted: str) -> Column:
    """Whether a class attribute holds all the wanted classes, in any order."""
    tokens = F.split(value, r"\s+")
    out = F.lit(True)
    for w in wanted:
        out = out & F.array_contains(tokens, w)
    return F.coalesce(out, F.lit(False))


def is_class(value: Column, wanted: str) -> Column:
    """Whether a class attribute is exactly this text."""
    return F.coalesce(value == wanted, F.lit(False))


def exists(html: Column, pattern: str) -> Column:
    """1 where the markup has it, else 0."""
    return F.coalesce(F.rlike(html, F.lit(pattern)), F.lit(False)).cast("int")


class _Collector(HTMLParser):
    def __init__(self, tag: str, class_: str):
        super().__init__(convert_charrefs=True)
        self.tag, self.class_, self.open, self.found = tag, class_, [], []

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            return
        mine = tag == self.tag and dict(attrs).get("class", "") == self.class_
        self.open.append((tag, len(self.found) if mine else None))
        if mine:
            self.found.append([])

    def handle_endtag(self, tag):
        if any(t == tag for t, _ in self.open):
            while self.open.pop()[0] != tag:
                pass

    def handle_data(self, data):
        for _, place in self.open:
            if place is not None:
                self.found[place].append(data)


def elements(pages: DataFrame, html: str, tag: str, class_: str, key: str) -> DataFrame:
    """(key, place, text) of all elements with exactly this class attribute, nested ones too. Broken markup gives what it can."""
    kind = pages.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, places, texts = [], [], []
            for k, raw in zip(range(batch.num_rows), batch.column(1).to_pylist(), strict=True):
                parser = _Collector(tag, class_)
                parser.feed(raw or "")
                parser.close()
                for i, parts in enumerate(parser.found):
                    keys.append(k)
                    places.append(i)
                    texts.append("".join(parts))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keys, pa.int64())), pa.array(places, pa.int32()), pa.array(texts, pa.string())], [key, "place", "text"])

    return pages.select(key, html).mapInArrow(run, f"`{key}` {kind}, place int, text string")
