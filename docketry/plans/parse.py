"""Raw paragraph rows to typed elements: an ordered rule table over one document.

The rules share state (where in the document one is, what was opened, which numbers
are live), so a document is one row with an array of its rows; documents are spread by
their key, and very long volumes are sliced natively before (``ledger.split_volume``).
Every raw row ends in exactly one element or one ledgered drop.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.functions import lexicon as lx
from docketry.operators.documents import over_documents
from docketry.operators.sequences import confirmed_romans, paren_levels, real_numbers

VERSION = "parse-1"
SCHEMA = (
    "record string, position int, type string, subtype string, section string, annex_index int, text_index int, "
    "paragraph_type string, level int, prefix string, text string, raw_positions array<int>, inferred boolean, "
    "vote map<string,array<string>>, note_ids array<int>, reason string"
)

# The line forms the rules look for.
ORGANS = "General Assembly|Security Council|Economic and Social Council|Human Rights Council|Trusteeship Council"
OPENING = re.compile(rf"""^["“”‘’']?\s*The\s+({ORGANS})\s*,?\s*$""")
DECISION = re.compile(r"At\s+(?:its|the)\s+\d{1,4}\s*(?:st|nd|rd|th|d)\s*(?:\([^)]{0,24}\)\s*)?(?:plenary\s+|resumed\s+|informal\s+|formal\s+)?meeting\b", re.I)
TITLES = tuple(re.compile(p, re.I) for p in (r"^\d+/\d+[A-Z]*\.\s+.+$", r"^\d+/\d+[A-Z]*\s+[A-Z].+$", r"^Resolution\s+\d+\s*\(\d{4}\)\s*$", r"^Statement by the President of the ", r"^Decision\s+\d+"))
ANNEX = re.compile(r"^(Annex|Appendix)(?=\s|$)(?:\s+([IVXLCDM]+|[A-Z]|\d{1,3})(?:\s*[-–—:.]\s*(\S.*)|\s+(\S.*))?)?\s*$", re.I)
NUMBERED = re.compile(r"^(\d+)\.\s+(\S.*)$", re.S)
LOOSE = re.compile(r"^(\d{1,3})[.\s]*(\S.*)$", re.S)
PAREN = re.compile(r"^\(([A-Za-z]{1,7}|\d{1,3})\)\s+(\S.*)$", re.S)
DOTTED = re.compile(r"^(\d{1,3})\.(\d{1,2}|[a-z])\s+(\S.*)$", re.S)
VOTE = re.compile(r"^\[?\s*Adopted\b.*(vote|without a vote)", re.I)
TALLY = re.compile(r"^(In favour|Against|Abstaining|Non-Voting|Absent)\s*:\s*(.*)$", re.I)
SIDES = {"in favour": "in_favour", "against": "against", "abstaining": "abstaining", "non-voting": "non_voting", "absent": "absent"}
MEETING = re.compile(r"^\d+\s*(st|nd|rd|th)\s+(plenary\s+)?meeting\b", re.I)
MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"
DATE = re.compile(rf"^\d{{1,2}}\s+({MONTHS})\s+\d{{4}}\s*$")
MASTHEAD = re.compile(r"^(United Nations|Nations Unies|UNITED|NATIONS|Distr\.?|GENERAL|LIMITED|Original\s*:|Security Council|General Assembly|Economic and Social Council|Human Rights Council|Trusteeship Council)\b", re.I)
ARTIFACT = re.compile(r"^(-?\s*\d{1,4}\s*-?|[A-Z]+(/[A-Z0-9()./-]+)+)$")
DIVIDER = re.compile(r"^_{3,}$")
HEADING_STYLE = re.compile(r"^(H\d+[GM]?|HCh[GM]?|Heading\d+|ArtHead|SectionHead|ChapterHead)$", re.I)
BARE = re.compile(r"^\(?([IVXLCM]{1,7}|[A-Z]|\d{1,3})\)?\.?$")

_names = {form: "|".join(re.escape(s) for s in sorted((s for s, (_, f) in lx.surfaces().items() if f == form), key=len, reverse=True)) for form in ("operative", "preambular")}
_mods = "|".join(re.escape(m) for ms in lx.MODIFIERS.values() for m in sorted(ms, key=len, reverse=True))
OPERATIVE = re.compile(rf"^(?:(?:{_mods})[ ,]+)*({_names['operative']})(?![^\W\d_])", re.I)
PREAMBULAR = re.compile(rf"^(?:(?:{_mods})[ ,]+)*({_names['preambular']})(?![^\W\d_])", re.I)


def tidy(text: str | None) -> str:
    return re.sub(r"\s+", " ", (text or "").replace("\xa0", " ")).strip()


def roman(numeral: str) -> int:
    worth = [{"I": 1, "V": 5, "X": 10, "L": 50, "C": 100, "D": 500, "M": 1000}[c] for c in numeral]
    return sum(-v if v < after else v for v, after in zip(worth, [*worth[1:], 0], strict=True))


@dataclass
class Row:
    position: int
    kind: str
    text: str
    style: str
    bold: bool
    notes: list[int]
    number: int | None = None
    confirmed: bool = False
    dotted: bool = False
    tail: bool = False


@dataclass
class Parse:
    """State of one document's parse."""

    rows: list[Row]
    state: str = "front"
    section: str = "main"
    annex: int | None = None
    annexes: int = 0
    texts: int = 0
    scoped: bool = False
    last: int = 0
    at: int = 0
    elements: list[dict] = field(default_factory=list)
    drops: list[dict] = field(default_factory=list)
    issues: list[dict] = field(default_factory=list)
    open_markers: list[str] = field(default_factory=list)

    # -- helpers -----------------------------------------------------------------

    def emit(self, kind: str, text: str, rows: list[Row], **more) -> None:
        labelled = self.section == "main" or self.scoped
        label = more.pop("paragraph_type", None)
        self.elements.append(
            {
                "record": "element", "position": len(self.elements), "type": kind, "section": self.section, "annex_index": self.annex,
                "text_index": self.texts, "paragraph_type": label if labelled else None, "text": text, "raw_positions": [r.position for r in rows],
                "note_ids": [n for r in rows for n in r.notes] or None,
            } | more
        )
        self.at += len(rows)

    def drop(self, row: Row, reason: str) -> None:
        self.drops.append({"record": "dropped", "position": row.position, "reason": reason})
        self.at += 1

    def ahead(self, test: Callable[[Row], bool], reach: int) -> bool:
        seen = 0
        for r in self.rows[self.at + 1 :]:
            if r.text:
                seen += 1
                if test(r):
                    return True
                if seen >= reach:
                    break
        return False

    # -- preparation -------------------------------------------------------------

    def mark_numbers(self) -> None:
        """Which leading numbers are real: confirmed by their sequence (see sequences)."""
        marked, fresh = [], True
        for r in self.rows:
            if OPENING.match(r.text) or ANNEX.match(r.text):
                fresh = True
            m = NUMBERED.match(r.text)
            if m and r.kind == "paragraph":
                r.number = int(m[1])
                marked.append((r, bool(OPERATIVE.match(m[2])), fresh))
                fresh = False
        if marked:
            body = sum(1 for r in self.rows if r.text and r.kind == "paragraph")
            found, verbs, resets = zip(*[(r.number, v, f) for r, v, f in marked], strict=True)
            for (r, _, _), ok in zip(marked, real_numbers(list(found), list(verbs), list(resets), max(sum(verbs), body) + 3), strict=True):
                r.confirmed = ok

    def mark_romans(self) -> None:
        """Upper-case Roman parentheses that no sequence confirms are the tails of torn citations."""
        found = [(r, m[1]) for r in self.rows if r.kind == "paragraph" and (m := PAREN.match(r.text)) and re.fullmatch("[IVXLCDM]+", m[1])]
        for (r, _), ok in zip(found, confirmed_romans([roman(m) for _, m in found]), strict=True):
            r.tail = not ok

    def mark_dotted(self) -> None:
        """Chains of three or more from minor 1 or a."""
        chain: list[tuple[Row, str, int]] = []
        chains = []
        for r in self.rows:
            m = DOTTED.match(r.text) if r.kind == "paragraph" else None
            if m and "..." not in r.text:
                minor = int(m[2]) if m[2].isdigit() else ord(m[2]) - 96
                if not chain or chain[-1][1] != m[1] or minor != chain[-1][2] + 1:
                    chains.append(chain := [])
                chain.append((r, m[1], minor))
        for c in chains:
            if len(c) >= 3 and c[0][2] == 1:
                for r, _, _ in c:
                    r.dotted = True

    def is_heading(self, row: Row) -> bool:
        if HEADING_STYLE.match(row.style):
            return True
        if row.bold and len(row.text) <= 200 and not row.text.endswith((".", ";", ",")):
            return True
        return bool(BARE.match(row.text)) and row.number is None

    # -- the run -----------------------------------------------------------------

    def run(self) -> Parse:
        self.mark_numbers()
        self.mark_dotted()
        self.mark_romans()
        while self.at < len(self.rows):
            row, before = self.rows[self.at], self.at
            for rule in RULES:
                if rule(self, row):
                    break
            assert self.at > before
        self.join_headings()
        return self

    def join_headings(self) -> None:
        """A heading that is only a marker takes the title-like element after it."""
        out: list[dict] = []
        for e in self.elements:
            last = out[-1] if out else None
            if last and last["type"] == "heading" and not last.get("prefix") and BARE.match(last["text"]) and e["type"] == "heading" and e["section"] == last["section"]:
                last["prefix"], last["text"] = last["text"], e["text"]
                last["raw_positions"] = last["raw_positions"] + e["raw_positions"]
            else:
                out.append(e)
        for i, e in enumerate(out):
            e["position"] = i
        self.elements = out


# ---- the rules, first match wins ---------------------------------------------------


def sub_resolution(p: Parse, row: Row) -> bool:
    if p.state == "annextitle" or not re.match(r"^[A-Z]$", row.text) or not p.ahead(lambda r: bool(OPENING.match(r.text)), 6):
        return False
    p.section, p.annex, p.scoped, p.state = "main", None, False, "blockhead"
    p.annexes = 0
    p.texts += any(e["type"] == "opening" for e in p.elements)
    rows, text = [row], ""
    for r in p.rows[p.at + 1 :]:
        if not r.text or OPENING.match(r.text) or r.kind != "paragraph":
            break
        rows.append(r)
        text = tidy(f"{text} {r.text}")
        break
    p.emit("heading", text or row.text, rows, subtype="subres", level=1, prefix=row.text if text else None)
    return True


def empty(p: Parse, row: Row) -> bool:
    if row.kind in ("section_break", "empty") or (not row.text and row.kind not in ("footnote", "table_cell")):
        p.drop(row, "section_break" if row.kind == "section_break" else "empty")
        return True
    return False


def footnote(p: Parse, row: Row) -> bool:
    if row.kind != "footnote":
        return False
    lead = re.match(r"^(\d{1,3})", row.text)
    if not row.notes and lead:
        row.notes = [int(lead[1])]
    p.emit("footnote", re.sub(r"^\d{1,3}[/.]?\s*", "", row.text), [row])
    return True


def table(p: Parse, row: Row) -> bool:
    if row.kind != "table_cell":
        return False
    cells = [row]
    for r in p.rows[p.at + 1 :]:
        if r.kind != "table_cell":
            break
        cells.append(r)
    text = " | ".join(c.text for c in cells if c.text)
    if not text:
        for c in cells:
            p.drop(c, "layout_cell")
    elif p.state == "front" and sum(bool(c.text) for c in cells) <= 12 and not any(e["type"] == "title" for e in p.elements):
        p.emit("frontmatter", text, cells, subtype="masthead")
    else:
        p.emit("table", text, cells)
    return True


def divider(p: Parse, row: Row) -> bool:
    if DIVIDER.match(row.text):
        p.emit("divider", row.text, [row])
        return True
    return False


def opening(p: Parse, row: Row) -> bool:
    if not OPENING.match(row.text):
        return False
    if any(e["type"] == "opening" and e["text_index"] == p.texts for e in p.elements) and p.section == "main":
        p.texts += 1
    if not p.scoped:
        p.section, p.annex = "main", None
    p.state, p.last, p.open_markers = "preamble", 0, []
    p.emit("opening", row.text, [row], paragraph_type="preambular", level=0)
    return True


def annex(p: Parse, row: Row) -> bool:
    m = ANNEX.match(row.text)
    if not m or p.state == "front":
        return False
    p.annexes += 1
    p.section, p.annex, p.state, p.last, p.open_markers = ("annex" if m[1].lower() == "annex" else "appendix"), p.annexes, "annextitle", 0, []
    own = []
    for r in p.rows[p.at + 1 :]:
        if ANNEX.match(r.text):
            break
        own.append(r)
    numbered = sum(r.confirmed for r in own)
    p.scoped = any(OPENING.match(r.text) for r in own) or (numbered >= 2 and any(re.search(r"\b(declaration|statute|convention|rules|terms of reference)\b", r.text, re.I) for r in own[:4]))
    kind = "amendment" if any(re.match(r"^amendments?\b", r.text, re.I) for r in own[:3]) else "instrument" if p.scoped else None
    p.emit("heading", tidy(m[3] or m[4] or row.text), [row], subtype=kind or p.section, level=1, prefix=tidy(f"{m[1]} {m[2] or ''}"))
    return True


def annex_title(p: Parse, row: Row) -> bool:
    if p.state != "annextitle":
        return False
    p.state = "preamble"
    if row.number is None and not PAREN.match(row.text) and len(row.text) <= 200 and not OPENING.match(row.text) and p.elements[-1]["type"] == "heading":
        head = p.elements[-1]
        head["text"] = row.text if head["text"].lower().startswith(("annex", "appendix")) else tidy(f"{head['text']} {row.text}")
        head["raw_positions"] = head["raw_positions"] + [row.position]
        p.at += 1
        return True
    return False


def title(p: Parse, row: Row) -> bool:
    if p.state not in ("front", "blockhead") or not any(t.match(row.text) for t in TITLES):
        return False
    cut = DECISION.search(row.text)
    if cut and cut.start() and len(row.text[cut.start() :].split()) >= 4:
        p.emit("title", row.text[: cut.start()].strip(), [row])
        p.at -= 1
        p.state = "decision"
        p.emit("paragraph", row.text[cut.start() :], [row], level=1)
    else:
        p.emit("title", row.text, [row])
        if row.text.lower().startswith("statement by"):
            p.state = "statement"
    return True


def vote(p: Parse, row: Row) -> bool:
    if not (VOTE.match(row.text) or TALLY.match(row.text)):
        return False
    rows, sides, side = [], {}, None
    for r in p.rows[p.at :]:
        m = TALLY.match(r.text)
        if m:
            side = SIDES[m[1].lower()]
            sides.setdefault(side, [])
            names = m[2]
        elif r is row and VOTE.match(r.text):
            rows.append(r)
            continue
        elif side and r.kind == "paragraph" and r.text and not (MEETING.match(r.text) or DATE.match(r.text) or OPENING.match(r.text) or ANNEX.match(r.text) or r.number is not None):
            names = r.text
        else:
            break
        sides[side] += [n.strip() for n in re.sub(r"[\].\s]+$", "", names).split(",") if n.strip() and n.strip().lower() != "none"]
        rows.append(r)
    p.state = "tail"
    p.emit("vote_record", " ".join(r.text for r in rows), rows, vote=sides or None)
    return True


def signature(p: Parse, row: Row) -> bool:
    if MEETING.match(row.text) or (DATE.match(row.text) and p.state == "tail"):
        p.state = "tail"
        p.emit("signature", row.text, [row])
        return True
    return False


def operative(p: Parse, row: Row) -> bool:
    if not row.confirmed or HEADING_STYLE.match(row.style) or p.state in ("front", "blockhead") and not OPERATIVE.match(NUMBERED.match(row.text)[2]):
        return False
    p.state, p.last, p.open_markers = "operative", row.number, []
    p.emit("paragraph", NUMBERED.match(row.text)[2], [row], paragraph_type="operative", level=1, prefix=f"{row.number}.")
    return True


def loose_operative(p: Parse, row: Row) -> bool:
    m = LOOSE.match(row.text)
    if p.state != "operative" or row.number is not None or not m or not OPERATIVE.match(m[2]):
        return False
    n = int(m[1])
    if n != 1 and not 0 < n - p.last <= 3:
        return False
    p.last, p.open_markers = n, []
    p.emit("paragraph", m[2], [row], paragraph_type="operative", level=1, prefix=f"{n}.")
    return True


def item(p: Parse, row: Row) -> bool:
    m = PAREN.match(row.text)
    if not m or row.tail or p.state not in ("operative", "preamble"):
        return False
    p.open_markers.append(m[1])
    following = next((PAREN.match(r.text)[1] for r in p.rows[p.at + 1 : p.at + 4] if PAREN.match(r.text)), "")
    level = paren_levels([*p.open_markers, following] if following else p.open_markers)[len(p.open_markers) - 1][0]
    p.emit("paragraph", m[2], [row], paragraph_type="operative" if p.state == "operative" else "preambular", level=level, prefix=f"({m[1]})")
    return True


def dotted(p: Parse, row: Row) -> bool:
    if not row.dotted:
        return False
    m = DOTTED.match(row.text)
    p.emit("paragraph", m[3], [row], level=2, prefix=f"{m[1]}.{m[2]}")
    return True


def heading(p: Parse, row: Row) -> bool:
    if p.state in ("front", "blockhead") or not p.is_heading(row):
        return False
    m = re.match(r"^H(?:eading)?(\d+)", row.style, re.I)
    p.emit("heading", row.text, [row], level=min(6, int(m[1])) if m else 2)
    return True


def decision(p: Parse, row: Row) -> bool:
    if p.state not in ("front", "blockhead"):
        return False
    known = OPERATIVE.match(row.text) or PREAMBULAR.match(row.text)
    if DECISION.match(row.text) or (len(row.text.split()) >= 8 and known) or (row.number is not None and any(e["type"] == "title" for e in p.elements)):
        p.state = "decision"
        p.emit("paragraph", row.text, [row], level=1)
        return True
    return False


def front(p: Parse, row: Row) -> bool:
    if p.state not in ("front", "blockhead"):
        return False
    if ARTIFACT.match(row.text):
        p.drop(row, "page_artifact")
    else:
        p.emit("frontmatter", row.text, [row], subtype="masthead" if MASTHEAD.match(row.text) else None)
    return True


def preamble(p: Parse, row: Row) -> bool:
    if p.state != "preamble" or (p.section != "main" and not p.scoped):
        return False
    if OPERATIVE.match(row.text):
        p.state = "operative"
        p.emit("paragraph", row.text, [row], paragraph_type="operative", level=1)
    else:
        p.emit("paragraph", row.text, [row], paragraph_type="preambular", level=0)
    return True


def rescued(p: Parse, row: Row) -> bool:
    """An unnumbered clause where the numbers ahead leave a place for it."""
    if p.state != "operative" or not OPERATIVE.match(row.text):
        return False
    following = next((r.number for r in p.rows[p.at + 1 : p.at + 31] if r.confirmed), None)
    if following is None or following <= p.last + 1:
        return False
    p.last += 1
    p.emit("paragraph", row.text, [row], paragraph_type="operative", level=1, inferred=True)
    return True


def rest(p: Parse, row: Row) -> bool:
    if p.state not in ("operative", "tail", "decision", "statement", "preamble", "annextitle"):
        p.issues.append({"record": "issue", "position": row.position, "reason": "unclassified paragraph"})
    p.emit("paragraph", row.text, [row], level=None if p.state in ("operative", "tail") else 1)
    return True


RULES = (sub_resolution, empty, footnote, table, divider, opening, annex, annex_title, title, vote, signature, operative, loose_operative,
         item, dotted, heading, decision, front, preamble, rescued, rest)


def parse_rows(rows: list[dict]) -> Parse:
    """Parse the rows of one document: dicts with position, kind, text and what else there is."""
    made = []
    for r in sorted(rows, key=lambda r: r["position"]):
        props, ref = dict(r.get("props") or {}), dict(r.get("footnote_ref") or {})
        notes = [n for n in ([ref.get("note_id")] if ref.get("note_id") is not None else list(ref.get("note_ids") if ref.get("note_ids") is not None else []))]
        made.append(Row(int(r["position"]), r.get("kind") or "paragraph", tidy(r.get("text")), r.get("style_id") or "", bool(props.get("bold")), notes))
    return Parse(made).run()


def parse(raw: DataFrame) -> DataFrame:
    """One table of elements, drops and issues (``record`` says which), with the document's key.

    ``raw``: doc, position, kind, text and optionally style_id, props, footnote_ref.
    """
    kind = raw.schema["doc"].dataType.simpleString()
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def run(doc: object, rows: list[dict]) -> Iterator[tuple]:
        p = parse_rows(rows)
        for r in (*p.elements, *p.drops, *p.issues):
            made = {**r, "vote": list(r["vote"].items())} if r.get("vote") else r
            yield doc, *[made.get(n) for n in names]

    wanted = [c for c in ("position", "kind", "text", "style_id", "props", "footnote_ref") if c in raw.columns]
    docs = raw.groupBy("doc").agg(F.collect_list(F.struct(*wanted)).alias("rows"))
    return over_documents(docs, run, f"doc {kind}, {SCHEMA}")


def elements(parsed: DataFrame) -> DataFrame:
    return parsed.where("record = 'element'").drop("record", "reason")


def dropped(parsed: DataFrame) -> DataFrame:
    return parsed.where("record = 'dropped'").select("doc", "position", "reason")


def lines_as_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Raw rows of plain texts: one a line."""
    lines = docs.select(F.col(id_col).alias("doc"), F.posexplode(F.split(F.coalesce(text_col, F.lit("")), "\n")).alias("position", "text"))
    return lines.select("doc", "position", F.when(F.trim("text") == "", "empty").otherwise("paragraph").alias("kind"), "text")
