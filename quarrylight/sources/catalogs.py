"""Small catalogues kept by people: the reference library (CSV, Markdown, manifest) and the literature ledger (XLSX).

A catalogue is a file of at most some thousands of rows that is edited by hand, so this is driver code; its style (line ends, quoting)
survives, and all files of one change are staged before any is replaced.
"""

from __future__ import annotations

import csv
import io
import json
import os
import re
import uuid
import zipfile
from dataclasses import dataclass, field
from pathlib import Path
from xml.sax.saxutils import escape

# Columns of the library, its manifest and the ledger.
LIBRARY = "id title authors year yearStatus doi sourceType primarySection priority batteryChemistry methods targetProperties evidenceNote limitationOrOutlook relativePath alternatePaths".split()
MANIFEST = "number id title doi status source target bytes reason".split()
LEDGER = "分类 标题 作者 年份 期刊或学校 DOI 专利号 文件路径 SHA256 原始路径 文献类型 关联正文".split()
PDF_HEAD, PDF_LEAST = b"%PDF-", 10_000


class Conflict(ValueError):
    """The catalogue has this already, or can't take it."""


def doi_of(text: str | None) -> str:
    """A DOI without prefix, trailing marks and upper case."""
    bare = re.sub(r"^(?:https?://(?:dx\.)?doi\.org/|doi:\s*)", "", (text or "").strip(), flags=re.IGNORECASE)
    return bare.rstrip(".,;:)]}").lower()


@dataclass
class Sheet:
    headers: list[str]
    rows: list[dict[str, str]] = field(default_factory=list)
    newline: str = "\n"
    quote_all: bool = True

    @classmethod
    def load(cls, path: Path, headers: list[str]) -> Sheet:
        """An absent file is an empty sheet; other columns than these are a conflict."""
        if not path.exists():
            return cls(list(headers))
        raw = path.read_bytes()
        text = raw.decode("utf-8-sig")
        lines = list(csv.reader(io.StringIO(text, newline="")))
        if not lines or lines[0] != list(headers):
            raise Conflict(f"{path} has other columns")
        rows = [dict(zip(headers, [*x, *[""] * len(headers)])) for x in lines[1:] if x]
        return cls(list(headers), rows, "\r\n" if b"\r\n" in raw else "\n", text.lstrip()[:1] == '"')

    def encode(self) -> bytes:
        out = io.StringIO(newline="")
        w = csv.writer(out, quoting=csv.QUOTE_ALL if self.quote_all else csv.QUOTE_MINIMAL, lineterminator=self.newline)
        w.writerows([self.headers, *([r.get(h, "") for h in self.headers] for r in self.rows)])
        return out.getvalue().encode()


def commit(files: dict[Path, bytes]) -> None:
    """All files or, if one can't be staged, none."""
    staged: dict[Path, Path] = {}
    try:
        for target, body in files.items():
            target.parent.mkdir(parents=True, exist_ok=True)
            staged[target] = target.with_name(f".{target.name}.{uuid.uuid4().hex}.tmp")
            with staged[target].open("wb") as out:
                out.write(body)
                out.flush()
                os.fsync(out.fileno())
        for target, pending in staged.items():
            os.replace(pending, target)
    finally:
        for pending in staged.values():
            pending.unlink(missing_ok=True)


def markdown(rows: list[dict[str, str]], group: str = "primarySection") -> str:
    """A table for each group, in the order in which groups appear."""
    cell = lambda x: re.sub(r"\s*\n\s*", " ", str(x)).replace("|", "/")
    groups: dict[str, list[dict[str, str]]] = {}
    for r in rows:
        groups.setdefault(r.get(group) or "Unsorted", []).append(r)
    shown = ("id", "title", "authors", "year", "doi", "relativePath")
    parts = ["# Library\n"]
    for name, own in groups.items():
        parts += [f"\n## {name}\n", "\n| " + " | ".join(shown) + " |", "|" + "---|" * len(shown), *("| " + " | ".join(cell(r.get(c, "")) for c in shown) + " |" for r in own), ""]
    return "\n".join(parts)


def register_reference(root: Path, record: dict[str, object], pdf: bytes | None = None, source: str = "", reference_id: str | None = None) -> str:
    """Adds one reference to library.csv, library.md, the manifest and, if there is a PDF, to pdfs. Its id.

    Conflict: an invalid or known DOI, a bad or taken id, a file that is no PDF or is too small, a target that exists.
    """
    home = root / "literature"
    library, manifest = Sheet.load(home / "library.csv", LIBRARY), Sheet.load(home / "manifest.csv", MANIFEST)
    doi = doi_of(str(record.get("doi", "")))
    if not re.fullmatch(r"10\.[^/]+/.+", doi):
        raise Conflict(f"no valid DOI: {doi!r}")
    if any(doi_of(r["doi"]) == doi for r in library.rows):
        raise Conflict(f"{doi} is in the library")
    numbers = [int(m[1]) for r in library.rows if (m := re.fullmatch(r"R(\d+)", r["id"].strip(), re.IGNORECASE))]
    rid = (reference_id or f"R{max(numbers, default=0) + 1:03d}").upper()
    if not re.fullmatch(r"R\d{3,}", rid) or any(r["id"].upper() == rid for r in library.rows):
        raise Conflict(f"{rid} can't be used")
    files, target = {}, ""
    if pdf is not None:
        if not pdf.startswith(PDF_HEAD) or len(pdf) < PDF_LEAST:
            raise Conflict("not a PDF, or too small for one")
        title = re.sub(r"\s+", " ", re.sub(r'[<>:"/\\|?*\x00-\x1f]', " ", str(record.get("title", "")))).strip()[:100].rstrip(". ")
        place = home / "pdfs" / f"{rid} - {title}.pdf"
        if place.exists():
            raise Conflict(f"{place} exists")
        files[place], target = pdf, str(place.relative_to(root))
    authors = record.get("authors", "")
    row = {h: "" for h in LIBRARY} | {k: str(v) for k, v in record.items() if k in LIBRARY and v is not None}
    library.rows.append(row | {"id": rid, "doi": doi, "authors": "; ".join(authors) if isinstance(authors, list) else str(authors), "relativePath": target})
    count = [int(r["number"]) for r in manifest.rows if r["number"].isdigit()]
    manifest.rows.append({"number": str(max(count, default=0) + 1), "id": rid, "title": row["title"], "doi": doi, "status": "copied_local" if pdf else "metadata_only", "source": source, "target": target, "bytes": str(len(pdf or b"")), "reason": ""})
    totals: dict[str, int] = {}
    for r in manifest.rows:
        totals[r["status"]] = totals.get(r["status"], 0) + 1
    files |= {home / "library.csv": library.encode(), home / "library.md": markdown(library.rows).encode(), home / "manifest.csv": manifest.encode(), home / "manifest.json": (json.dumps({"total": len(manifest.rows), **totals, "files": manifest.rows}, ensure_ascii=False, indent=2) + "\n").encode()}
    commit(files)
    return rid


def xlsx(headers: list[str], rows: list[list[object]], sheet: str = "文献总账") -> bytes:
    """A workbook of one sheet with a bold head that stays in view; every cell is text, so that nothing is taken for a formula."""

    def line(n: int, cells: list[object], style: int) -> str:
        return f'<row r="{n}">' + "".join(f'<c t="inlineStr" s="{style}"><is><t xml:space="preserve">{escape("" if c is None else str(c))}</t></is></c>' for c in cells) + "</row>"

    main, rel, office = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/package/2006/relationships", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    body = "".join([line(1, list(headers), 1), *(line(n, list(r), 0) for n, r in enumerate(rows, 2))])
    kind = "application/vnd.openxmlformats-officedocument.spreadsheetml."
    parts = {
        "[Content_Types].xml": f'<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{kind}sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="{kind}worksheet+xml"/><Override PartName="/xl/styles.xml" ContentType="{kind}styles+xml"/></Types>',
        "_rels/.rels": f'<Relationships xmlns="{rel}"><Relationship Id="rId1" Type="{office}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{office}"><sheets><sheet name="{escape(sheet)}" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{rel}"><Relationship Id="rId1" Type="{office}/worksheet" Target="worksheets/sheet1.xml"/><Relationship Id="rId2" Type="{office}/styles" Target="styles.xml"/></Relationships>',
        "xl/styles.xml": f'<styleSheet xmlns="{main}"><fonts count="2"><font/><font><b/></font></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="2"><xf/><xf fontId="1" applyFont="1"/></cellXfs></styleSheet>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{main}"><sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" state="frozen"/></sheetView></sheetViews><sheetData>{body}</sheetData></worksheet>',
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in parts.items():
            z.writestr(name, '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>' + text)
    return out.getvalue()


def write_ledger(path: Path, rows: list[dict[str, object]]) -> None:
    """The ledger, ordered by file path. An older one of ten columns is read with read_ledger() and comes back with twelve."""
    ordered = sorted(rows, key=lambda r: str(r.get("文件路径", "")))
    commit({path: xlsx(LEDGER, [[r.get(h, "") for h in LEDGER] for r in ordered])})


def read_ledger(path: Path) -> list[dict[str, object]]:
    from .files import read_xlsx

    if not path.exists():
        return []
    (_, lines), *_ = read_xlsx(path.read_bytes())
    return [{h: "" for h in LEDGER} | {h: v or "" for h, v in zip(lines[0], r)} for r in lines[1:]]
