import pytest

from quarrylight.sources import catalogs as C
from quarrylight.sources.files import read_xlsx

PDF = b"%PDF-1.4" + bytes(10_000)


def test_register_reference(tmp_path):
    one = {"title": "A: title", "authors": ["A", "B"], "year": 2020, "doi": "https://doi.org/10.1/X.", "primarySection": "s|1"}
    assert C.register_reference(tmp_path, one, PDF, "x.pdf") == "R001"
    assert C.register_reference(tmp_path, {"title": "t", "doi": "10.2/y"}) == "R002"
    assert (tmp_path / "literature/pdfs/R001 - A title.pdf").read_bytes() == PDF
    before = {p: p.read_bytes() for p in (tmp_path / "literature").rglob("*") if p.is_file()}
    for bad, pdf in (({"doi": "doi:10.1/x"}, None), ({"doi": "nonsense"}, None), ({"doi": "10.3/z"}, b"no pdf"), ({"doi": "10.3/z"}, b"%PDF-short")):
        with pytest.raises(C.Conflict):
            C.register_reference(tmp_path, bad, pdf)
    assert before == {p: p.read_bytes() for p in (tmp_path / "literature").rglob("*") if p.is_file()}
    assert "| R001 | A: title | A; B | 2020 | 10.1/x |" in (tmp_path / "literature/library.md").read_text()


def test_style_survives(tmp_path):
    p = tmp_path / "m.csv"
    p.write_bytes((",".join(C.MANIFEST) + "\r\n1,R001,t,,,,,,\r\n").encode("utf-8-sig"))
    s = C.Sheet.load(p, C.MANIFEST)
    assert s.encode().decode() == ",".join(C.MANIFEST) + "\r\n1,R001,t,,,,,,\r\n"
    with pytest.raises(C.Conflict):
        C.Sheet.load(p, C.LIBRARY)


def test_ledger_round_trip_and_older_columns(tmp_path):
    old = tmp_path / "l.xlsx"
    old.write_bytes(C.xlsx(C.LEDGER[:10], [["paper", "=1+1", *[""] * 8]]))
    rows = C.read_ledger(old)
    assert rows[0]["标题"] == "=1+1" and rows[0]["关联正文"] == ""
    C.write_ledger(old, [*rows, {"标题": "b", "文件路径": "a/b"}])
    ((name, lines),) = read_xlsx(old.read_bytes())
    assert name == "文献总账" and lines[0] == C.LEDGER and len(lines) == 3
