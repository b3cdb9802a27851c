"""Word-processing documents (OOXML) as ordered paragraph rows.

Files are read by Spark (``binaryFile``) and taken apart on the executors, one file
at a time.  Paragraphs, table cells (depth first), content controls and text boxes come
in reading order; notes follow at the end.  Deleted text and second choices of
alternate content are passed over.
"""

from __future__ import annotations

import io
import zipfile
from collections import Counter
from collections.abc import Iterator
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.session import ship_package

W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
MC = "{http://schemas.openxmlformats.org/markup-compatibility/2006}"
SCHEMA = (
    "doc string, position int, kind string, text string, style_id string, "
    "numbering struct<num_id:int,ilvl:int,num_fmt:string,lvl_text:string>, "
    "props struct<italic:boolean,bold:boolean,alignment:string,indent_left:int,indent_hanging:int,indent_firstline:int,"
    "lead_italic_text:string,all_caps:boolean,tabs_leading:int,textbox:boolean>, "
    "table_cell struct<table:int,row:int,col:int>, hyperlinks array<struct<text:string,url:string>>, "
    "footnote_ref struct<note_id:int,note_type:string,note_ids:array<int>>"
)


class Reader:
    """One file's parts and the numbering of its tables."""

    def __init__(self, raw: bytes):
        self.zip = zipfile.ZipFile(io.BytesIO(raw))
        self.tables = 0
        self.links = self._links()
        self.levels = self._levels()
        self.rows: list[dict] = []

    def part(self, name: str) -> ET.Element | None:
        return ET.fromstring(self.zip.read(name)) if name in self.zip.namelist() else None

    def _links(self) -> dict[str, str]:
        root = self.part("word/_rels/document.xml.rels")
        return {} if root is None else {e.get("Id"): e.get("Target") for e in root}

    def _levels(self) -> dict[int, dict[int, tuple[str | None, str | None]]]:
        root = self.part("word/numbering.xml")
        if root is None:
            return {}

        def value(e: ET.Element, tag: str) -> str | None:
            found = e.find(W + tag)
            return None if found is None else found.get(W + "val")

        shapes = {
            a.get(W + "abstractNumId"): {int(v.get(W + "ilvl")): (value(v, "numFmt"), value(v, "lvlText")) for v in a.findall(W + "lvl")}
            for a in root.findall(W + "abstractNum")
        }
        return {int(n.get(W + "numId")): shapes.get(value(n, "abstractNumId"), {}) for n in root.findall(W + "num")}

    def read(self) -> list[dict]:
        body = self.part("word/document.xml").find(W + "body")
        self.blocks(body, None, False)
        for kind in ("footnote", "endnote"):
            root = self.part(f"word/{kind}s.xml")
            for note in [] if root is None else root.findall(W + kind):
                if note.get(W + "type") in (None, "normal"):
                    text = "\n".join(self.paragraph(p)["text"] for p in note.iter(W + "p")).strip()
                    self.rows.append({"kind": "footnote", "text": text, "footnote_ref": {"note_id": int(note.get(W + "id")), "note_type": kind, "note_ids": None}})
        return [row | {"position": i} for i, row in enumerate(self.rows)]

    def blocks(self, parent: ET.Element, cell: dict | None, boxed: bool) -> None:
        for e in parent:
            if e.tag == W + "p":
                self.add(e, cell, boxed)
            elif e.tag == W + "tbl":
                self.table(e, boxed)
            elif e.tag == W + "sdt":
                content = e.find(W + "sdtContent")
                if content is not None:
                    self.blocks(content, cell, boxed)
            elif e.tag in (W + "ins", W + "customXml", W + "smartTag"):
                self.blocks(e, cell, boxed)

    def table(self, e: ET.Element, boxed: bool) -> None:
        number = self.tables
        self.tables += 1
        for r, row in enumerate(e.findall(W + "tr")):
            for c, box in enumerate(row.findall(W + "tc")):
                self.blocks(box, {"table": number, "row": r, "col": c}, boxed)

    def add(self, p: ET.Element, cell: dict | None, boxed: bool) -> None:
        row = self.paragraph(p)
        if boxed:
            row["props"] = (row["props"] or {}) | {"textbox": True}
        row["kind"] = "table_cell" if cell else "paragraph" if row["text"].strip() else "empty"
        row["table_cell"] = cell
        self.rows.append(row)
        for box in self.boxes(p):
            self.blocks(box, cell, True)
        if p.find(f"{W}pPr/{W}sectPr") is not None:
            self.rows.append({"kind": "section_break", "text": ""})

    @staticmethod
    def walk(e: ET.Element) -> Iterator[ET.Element]:
        """Elements in order without deleted text, boxes and second choices."""
        for x in e:
            if x.tag in (W + "del", W + "moveFrom", W + "txbxContent", W + "pPr", MC + "Fallback"):
                continue
            yield x
            yield from Reader.walk(x)

    @staticmethod
    def boxes(e: ET.Element) -> Iterator[ET.Element]:
        for x in e:
            if x.tag == W + "txbxContent":
                yield x
            elif x.tag != MC + "Fallback":
                yield from Reader.boxes(x)

    @staticmethod
    def on(run: ET.Element, tag: str) -> bool:
        flag = run.find(f"{W}rPr/{W}{tag}")
        return flag is not None and flag.get(W + "val") not in ("0", "false", "none")

    def paragraph(self, p: ET.Element) -> dict:
        text, links, notes = [], [], []
        runs: list[tuple[str, bool, bool, bool]] = []
        field: list[str] | None = None
        target, shown = "", []
        for e in self.walk(p):
            if e.tag == W + "r":
                piece = "".join(x.text or "" if x.tag == W + "t" else "\t" if x.tag == W + "tab" else "\n" if x.tag in (W + "br", W + "cr") else "-" if x.tag == W + "noBreakHyphen" else "" for x in e)
                text.append(piece)
                runs.append((piece, self.on(e, "i"), self.on(e, "b"), self.on(e, "caps")))
                if target:
                    shown.append(piece)
            elif e.tag == W + "hyperlink":
                url = self.links.get(e.get(R + "id") or "", "")
                label = "".join(t.text or "" for t in e.iter(W + "t"))
                if url and (label, url) not in links:
                    links.append((label, url))
            elif e.tag == W + "instrText":
                field = (field or []) + [e.text or ""]
            elif e.tag == W + "fldChar":
                what = e.get(W + "fldCharType")
                if what == "separate" and field:
                    words = "".join(field).split('"')
                    target, shown = (words[1], []) if "HYPERLINK" in words[0] and len(words) > 1 else ("", [])
                elif what == "end":
                    if target and ("".join(shown), target) not in links:
                        links.append(("".join(shown), target))
                    field, target = None, ""
            elif e.tag in (W + "footnoteReference", W + "endnoteReference"):
                notes.append(int(e.get(W + "id")))
        whole = "".join(text)
        style = p.find(f"{W}pPr/{W}pStyle")
        return {
            "text": whole, "style_id": None if style is None else style.get(W + "val"), "numbering": self.numbering(p),
            "props": self.props(p, whole, runs), "hyperlinks": [{"text": t, "url": u} for t, u in links] or None,
            "footnote_ref": {"note_id": None, "note_type": None, "note_ids": notes} if notes else None,
        }

    def numbering(self, p: ET.Element) -> dict | None:
        num = p.find(f"{W}pPr/{W}numPr/{W}numId")
        if num is None or int(num.get(W + "val")) == 0:
            return None
        level = p.find(f"{W}pPr/{W}numPr/{W}ilvl")
        n, at = int(num.get(W + "val")), 0 if level is None else int(level.get(W + "val"))
        shape, label = self.levels.get(n, {}).get(at, (None, None))
        return {"num_id": n, "ilvl": at, "num_fmt": shape, "lvl_text": label}

    def props(self, p: ET.Element, whole: str, runs: list[tuple[str, bool, bool, bool]]) -> dict | None:
        """Only what is not the default."""
        solid = [r for r in runs if r[0].strip()]
        out: dict = {}
        for name, at in (("italic", 1), ("bold", 2), ("all_caps", 3)):
            if solid and all(r[at] for r in solid):
                out[name] = True
        lead = ""
        for piece, italic, _, _ in runs:
            if piece.strip() and not italic:
                break
            lead += piece
        if lead.strip() and "italic" not in out:
            out["lead_italic_text"] = lead.strip()
        align = p.find(f"{W}pPr/{W}jc")
        if align is not None and align.get(W + "val") not in ("left", "start"):
            out["alignment"] = align.get(W + "val")
        indent = p.find(f"{W}pPr/{W}ind")
        for name, key in (("indent_left", "left"), ("indent_hanging", "hanging"), ("indent_firstline", "firstLine")):
            value = None if indent is None else indent.get(W + key)
            if value and int(float(value)):
                out[name] = int(float(value))
        tabs = len(whole) - len(whole.lstrip("\t"))
        if tabs:
            out["tabs_leading"] = tabs
        return out or None


FIELDS = ("kind", "text", "style_id", "numbering", "props", "table_cell", "hyperlinks", "footnote_ref")
CENSUS = ("p", "tbl", "tc", "sdt", "ins", "del", "hyperlink", "footnoteReference", "endnoteReference", "txbxContent", "numPr",
          "sectPr", "fldChar", "instrText", "drawing", "pict", "br", "tab", "bookmarkStart", "commentReference")


def full(value: dict | None, names: tuple[str, ...]) -> dict | None:
    return None if value is None else {n: value.get(n) for n in names}


SHAPES = {
    "numbering": ("num_id", "ilvl", "num_fmt", "lvl_text"),
    "props": ("italic", "bold", "alignment", "indent_left", "indent_hanging", "indent_firstline", "lead_italic_text", "all_caps", "tabs_leading", "textbox"),
    "table_cell": ("table", "row", "col"),
    "footnote_ref": ("note_id", "note_type", "note_ids"),
}


def extract(files: DataFrame) -> DataFrame:
    """Paragraph rows of (path, content); a file that cannot be read gives one row of kind ``error``."""
    ship_package(files.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, raw in zip(batch["path"], batch["content"], strict=True):
                try:
                    rows = Reader(raw).read()
                except (zipfile.BadZipFile, KeyError, ET.ParseError, AttributeError, ValueError) as e:
                    rows = [{"position": -1, "kind": "error", "text": f"{type(e).__name__}: {e}"}]
                made = [
                    {"doc": path, "position": r["position"]} | {f: full(r.get(f), SHAPES[f]) if f in SHAPES else r.get(f) for f in FIELDS}
                    for r in rows
                ]
                if made:
                    yield pd.DataFrame(made)[["doc", "position", *FIELDS]]

    return files.select("path", "content").mapInPandas(run, SCHEMA)


def census(files: DataFrame) -> DataFrame:
    """(doc, construct, n) of the constructs of every file."""
    ship_package(files.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, raw in zip(batch["path"], batch["content"], strict=True):
                try:
                    found = Counter(e.tag for e in ET.fromstring(zipfile.ZipFile(io.BytesIO(raw)).read("word/document.xml")).iter())
                except (zipfile.BadZipFile, KeyError, ET.ParseError):
                    continue
                rows += [(path, c, found[W + c]) for c in CENSUS]
            yield pd.DataFrame(rows, columns=["doc", "construct", "n"])

    return files.select("path", "content").mapInPandas(run, "doc string, construct string, n int")


def presence(counts: DataFrame) -> DataFrame:
    """(construct, documents, total, pct): in how many files a construct occurs."""
    return counts.groupBy("construct").agg(
        F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("total"),
        F.round(100.0 * F.count_if(F.col("n") > 0) / F.count("*"), 2).alias("pct"),
    )


def main_style(rows: DataFrame) -> DataFrame:
    """(doc, style, pct): the style that carries most characters of a document."""
    sums = rows.groupBy("doc", F.coalesce("style_id", F.lit("-")).alias("style")).agg(F.sum(F.length("text")).alias("chars"))
    return sums.groupBy("doc").agg(
        F.max_by("style", F.struct("chars", "style")).alias("style"), F.round(100.0 * F.max("chars") / F.sum("chars"), 2).alias("pct")
    )
