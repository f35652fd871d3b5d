from __future__ import annotations

from veritab.operators import reports
from veritab.sources import search, sidecar


def test_search_pages_follow_the_cursor(spark):
    def getter(query, cursor):
        k = int(cursor or 0)
        return [{"pmid": str(k + i), "title": query} for i in range(3)], str(k + 3) if k < 6 else cursor

    assert [h["pmid"] for h in search.pages("q", 100, getter)] == [str(k) for k in range(9)]
    assert len(list(search.pages("q", 4, getter))) == 4
    spark.dataSource.register(search.search_source(getter))
    rows = spark.read.format("veritab_search").option("query", "q").option("limit", 5).load()
    assert rows.count() == 5 and [r["ord"] for r in rows.orderBy("ord").collect()] == list(range(5))


def test_local_copies(spark):
    held = spark.createDataFrame([("a", "1"), ("b", "2")], "source_id string, sha256 string")
    new = spark.createDataFrame([("a", "1"), ("b", "9"), ("c", "3")], "source_id string, sha256 string")
    assert {r["source_id"]: r["outcome"] for r in search.add_local(held, new).collect()} == {"a": "identical", "b": "conflict", "c": "added"}
    found = spark.createDataFrame([("a", "full_text")], "source_id string, route string")
    before = spark.createDataFrame([("a", "local_pdf"), ("z", "local_pdf"), ("y", "full_text")], "source_id string, route string")
    assert sorted(r["source_id"] for r in search.carry_forward(found, before).collect()) == ["a", "z"]


def test_access_and_retractions(spark):
    papers = spark.createDataFrame([("a",), ("b",), ("c",)], "doi string")
    copies = spark.createDataFrame([("a", "u2", "acceptedVersion", "answered"), ("a", "u1", "publishedVersion", "answered"), ("b", "u3", "publishedVersion", "unreachable")], "doi string, url string, version string, state string")
    got = {r["doi"]: (r["url"], r["open"], r["auto_acceptable"]) for r in search.resolve_access(papers, copies).collect()}
    assert got == {"a": ("u1", True, True), "b": (None, False, False), "c": (None, False, False)}
    notices = spark.createDataFrame([("a", ["erratum", "retraction"], "answered"), ("b", [], "answered"), ("c", [], "unreachable")], "doi string, relations array<string>, state string")
    assert {r["doi"]: r["status"] for r in search.check_retractions(papers, notices).collect()} == {"a": "retracted", "b": "active", "c": None}


def test_reports(spark):
    c = spark.createDataFrame([("r1", "s", "allowed", ["x"]), ("r2", "s", "denied", ["x", "y"]), ("r3", "t", "denied", ["y", "y"])], "record_id string, source_id string, decision string, codes array<string>")
    papers = spark.createDataFrame([("s",), ("t",), ("u",)], "source_id string")
    assert {r["source_id"]: (r["n_found"], r["n_accepted"]) for r in reports.source_counts(c, papers).collect()} == {"s": (2, 1), "t": (1, 0), "u": (None, None)}
    assert [(r["code"], r["n"]) for r in reports.denial_totals(c).collect()] == [("x", 2), ("y", 2)]
    assert reports.candidate(c, "r1", "s").count() == 1
    assert "not counted" in reports.flow_text({"searched": 1200, "screened": None}) and "1,200" in reports.flow_text({"searched": 1200})
    claims = spark.createDataFrame([("s", "r1", "one", "t"), ("s", "r2", "two", "odd"), ("u", "r3", "three", None)], "source_id string, record_id string, claim string, theme string")
    out = {r["theme"]: r for r in reports.theme_sections(claims, spark.createDataFrame([("t", "about t")], "theme string, definition string")).collect()}
    assert out["t"]["markdown"] == "## t\nabout t\n\n- one (s)\n" and out["unassigned"]["n_claims"] == 2
    runs = spark.createDataFrame([("a", "done", 3, 1), ("b", "error", 0, 0)], "source_id string, state string, n_records int, n_written int")
    assert reports.run_totals(runs).first()["n_error"] == 1


def test_cell_at(spark):
    xml = '<a><table-wrap><table><tr><td rowspan="2">A</td><td>B</td></tr><tr><td>C</td></tr></table></table-wrap></a>'
    cells = sidecar.table_cells(spark.createDataFrame([("s", xml)], "source_id string, xml string"))
    places = spark.createDataFrame([("s", 0, 0, 0), ("s", 0, 1, 0), ("s", 0, 1, 1), ("s", 0, 5, 5)], "source_id string, table_ix int, row int, col int")
    assert {(r["row"], r["col"]): r["text"] for r in sidecar.cell_at(cells, places).collect()} == {(0, 0): "A", (1, 0): "A", (1, 1): "C", (5, 5): None}
