"""Printable HTML forms to field and choice rows."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import literal_frame
from ..sinks import qualified

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FIELD_SCHEMA = ("form string, position int, field string, section string, label string, "
                "choices array<struct<code:string,label:string>>")

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "wbr"}
# An opening tag ends open elements of the first kind unless one of the second is nearer.
_ENDS = {"td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"}),
         "p": ({"p"}, {"td", "th", "li", "div"}), "li": ({"li"}, {"ul", "ol", "td"}),
         "option": ({"option"}, {"select"})}


class _Node:
    """An element with its place in the page: every element below it begins before ``end``."""

    def __init__(self, tag: str, attrs: dict, parent: _Node | None, place: int):
        self.tag, self.attrs, self.parent, self.place, self.end = tag, attrs, parent, place, place + 1
        self.first = self.last = 0  # texts

    def has(self, css: str) -> bool:
        return css in (self.attrs.get("class") or "").split()


class _Page(HTMLParser):
    """All elements and texts of a page in their order, however deep they lie; cells and rows may lack end tags."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.open: list[_Node] = []
        self.nodes: list[_Node] = []
        self.texts: list[str] = []
        self.feed(html)
        self.close()
        self._end(0)

    def _end(self, depth: int) -> None:
        for node in self.open[depth:]:
            node.end = len(self.nodes)
            node.last = len(self.texts)
        del self.open[depth:]

    def handle_starttag(self, tag, attrs):
        ends, barriers = _ENDS.get(tag, ((), ()))
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth].tag in ends:
                self._end(depth)
                break
            if self.open[depth].tag in barriers:
                break
        node = _Node(tag, dict(attrs), self.open[-1] if self.open else None, len(self.nodes))
        node.first = node.last = len(self.texts)
        self.nodes.append(node)
        if tag not in _VOID:
            self.open.append(node)

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth].tag == tag:
                self._end(depth)
                return

    def handle_data(self, data):
        if text := data.strip():
            self.texts.append(text)

    def below(self, node: _Node, tag: str, css: str | None = None) -> list[_Node]:
        return [n for n in self.nodes[node.place + 1:node.end] if n.tag == tag and (css is None or n.has(css))]

    def text(self, node: _Node) -> str:
        return " ".join(self.texts[node.first:node.last])


def _fields(html: str) -> Iterator[tuple]:
    """The entry rows of a form that name a field, with the choices that their last cell lists."""
    page = _Page(html)
    section, position = None, 0
    for row in (n for n in page.nodes if n.tag == "tr" and n.has("entryRow")):
        cells = [n for n in page.below(row, "td") if n.parent is row]
        if len(cells) == 1 and cells[0].attrs.get("colspan"):
            section = page.text(cells[0])
            continue
        name = next(iter(page.below(row, "td", "fieldCell")), None)
        if name is None:
            continue
        question = next(iter(page.below(row, "td", "questionCell")), None)
        inside = page.below(cells[-1], "table") if cells else []
        # A row of a table in a table lies in both, and is one choice.
        lines = {n.place: n for table in inside for n in page.below(table, "tr")}
        listed = ([page.text(td) for td in page.below(line, "td")] for line in lines.values())
        choices = [{"code": texts[1], "label": texts[2]} for texts in listed if len(texts) >= 3 and texts[1]]
        yield (position, " ".join(page.text(name).replace("(required)", "").split()), section,
               page.text(question) if question else "", choices)
        position += 1


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = ["form", "position", "field", "section", "label", "choices"]
    for batch in batches:
        rows = [(form, *field) for form, html in zip(batch["form"], batch["html"])
                if html is not None for field in _fields(html)]
        yield pd.DataFrame(rows, columns=columns)


def parse_forms(documents: DataFrame) -> DataFrame:
    """``documents``: form (a name), html. One row per form field, in form order."""
    return documents.select("form", "html").mapInPandas(_parse, FIELD_SCHEMA)


def _parsed_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The fields of form files; ``form`` is a file's qualified path."""
    files = spark.read.format("binaryFile").load(sorted({qualified(spark, p) for p in paths}))
    # Bytes that are not UTF-8 become replacement marks rather than an error.
    return parse_forms(files.select(F.col("path").alias("form"),
                                    F.decode(F.col("content"), "UTF-8").alias("html")))


def _file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def read_forms(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Parse form files; ``form`` is the file name."""
    return _parsed_files(spark, paths).withColumn("form", _file_name(F.col("form")))


def read_cycle_forms(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """The forms at ``paths``, by survey cycle, with ``survey_cycle``.

    Forms belong to their whole path: files called alike in two folders stay apart, and one that two cycles name
    is parsed once and has its rows in both. Without paths the result is empty.
    """
    schema = f"{FIELD_SCHEMA}, survey_cycle string"
    if not paths:
        return spark.createDataFrame([], schema)
    owners = literal_frame(spark, [(c, qualified(spark, p)) for c, p in paths.items()],
                           "survey_cycle string, form string")
    # One row per cycle; as a hint, since the planner knows no size of parsed rows.
    parsed = _parsed_files(spark, list(paths.values())).join(F.broadcast(owners), "form")
    return parsed.withColumn("form", _file_name(F.col("form")))


def form_fields(parsed: DataFrame) -> DataFrame:
    return parsed.select("survey_cycle", "field", "section", "label",
                         F.size("choices").alias("n_choices"))


def choice_list(parsed: DataFrame) -> DataFrame:
    return parsed.select("survey_cycle", "field", F.inline("choices"))
