"""Queries agree with their SQL on rows that the smallest tables lack."""

import os

import pytest
from test_oracle import SF, TABLES, norm

from quirelake.plans.registry import ORACLE_SQL, QUERIES

duckdb = pytest.importorskip("duckdb")

#: Empty and null texts, blank lines at the end and between, spaces at the ends of lines.
BLANK = ["", "A line.\nAnother without an end\n", "\n", "\n\n\n", "First.\n\nSecond, after a blank\n\n", None, "a tail  \n b \n  ", "plain"]


#: Lines that start like numbered notes, headings, sections, lists, boxes or labels; addresses of machines, telephone numbers.
STARTS = [
    "12. ab\nC. D\n3.5 x", "28.68.191.238 Den sch\n75.46.40.211 Est la.\nEnd", "2000 words\nmore\n3021) a line that is long enough to be taken for a note", "Before it.\n28.68.191.238 Den\n(12) of\nIV. Roman",
    "E-5. problem\n문제 (10점)\n답안\n제1장 x\n제3절 y\nab-\ncd", "+1 (287) 555-2847 Er\n- item\n1) x\n☑ box", "  1. in\n\n2. out \n", "# a\n> b\nV. c\n1. d",
]


@pytest.fixture
def agrees(spark, tmp_path):
    def check(name: str, texts: list) -> None:
        for t in TABLES:
            if t != "documents":
                os.symlink(f"{SF}/{t}.parquet", tmp_path / f"{t}.parquet")
        rows = [(k, t, "en", f"s{k % 3}", len(t or "")) for k, t in enumerate(texts)]
        spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
        con = duckdb.connect()
        for t in TABLES:
            con.sql(f"create view {t} as select * from '{tmp_path}/{t}.parquet{'/*.parquet' if t == 'documents' else ''}'")
        df, want = QUERIES[name](spark, str(tmp_path)), con.sql(ORACLE_SQL[name])
        got = sorted(repr([norm(x) for x in r]) for r in df.select(*sorted(df.columns)).collect())
        assert got == sorted(repr([norm(x) for x in r]) for r in want.select(*[f'"{c}"' for c in sorted(want.columns)]).fetchall())

    return check


@pytest.mark.parametrize("name", ["doc_lines", "change_log", "empty_sections", "heading_jumps", "escape_leading", "strip_outer_emphasis", "yaml_and_html", "escape_md", "fingerprint_lines", "normalize_whitespace", "join_hyphens", "list_markers", "title_functions", "footnote_numbers", "footnote_text", "footnotes_of_plain_pages"])
def test_blank_lines(agrees, name):
    agrees(name, BLANK)


@pytest.mark.parametrize("name", ["footnotes_of_plain_pages", "casebook_structure", "textbook_structure", "front_matter", "split_chapters", "part_files"])
def test_starts_of_lines(agrees, name):
    agrees(name, STARTS)


def test_body_size_of_equal_shares(agrees):
    agrees("convert_layout", ["Enverkeitheit.\nChpfzu ertete." for _ in range(20)] + ["Abc.\n\nxyz."])


@pytest.mark.parametrize("name", ["margin_notes", "marked_lines"])
def test_lines_beyond_three_and_four_digits(agrees, name):
    agrees(name, ["\n".join(f"Line {k}." for k in range(1010)), "\n".join("w" for _ in range(10005)), "short"])


def test_bookmarks_meet_lines_by_their_start(spark):
    """A pair is made only of a line and a title whose first seven characters are equal."""
    from quirelake.operators import geometry as G

    texts = ["Abc  def ghi", "abc", "Abc def", "", "other", "Abc def ghi jkl", None]
    lines = spark.createDataFrame([("d", 0, k, t) for k, t in enumerate(texts)], "doc_id string, page_no int, line_no int, text string")
    toc = spark.createDataFrame([("d", 0, 0, 1, "Abc def ghi"), ("d", 0, 1, 2, "abc"), ("d", 0, 2, 3, ""), ("d", 0, 3, 4, None), ("d", 0, 4, 5, "Abc de"), ("d", 1, 0, 1, "other")], "doc_id string, page_no int, seq int, level int, title string")
    levels = G.toc_levels(lines, toc)
    assert sorted((r.line_no, r.level) for r in levels.collect()) == [(0, 1), (1, 2), (5, 1)]
    assert "head" in levels._jdf.queryExecution().optimizedPlan().toString()


def test_footnotes_are_tallied_once(spark):
    """The checks of the tally don't read the files again."""
    from quirelake.operators import validate as V

    files = spark.createDataFrame([("a", "x[^1] y[^2]\n[^2]: n\nno mark\n[^4]: n"), ("b", None)], "name string, text string")
    found = V.check_footnotes(files)
    assert "split(" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r.message for r in found.collect()) == ["definitions without a reference (1): 4", "numbers left out (1): 3", "references without a definition (1): 1"]


def test_noise_is_counted_beyond_ascii(spark):
    from pyspark.sql import functions as F

    from quirelake.operators import normalize as N

    t = spark.createDataFrame([("a\x01b é\té\r\n ※ 가\x7f ¤ \x1c",), ("plain",), ("",)], "t string")
    counts = t.select(N.residual_noise_count(F.col("t")), F.size(N.residual_noise(F.col("t")))).collect()
    assert [tuple(r) for r in counts] == [(6, 6), (0, 0), (0, 0)]


def test_lines_of_latin_letters_skip_the_steps(spark):
    from pyspark.sql import functions as F

    from quirelake.operators import normalize as N

    texts = ["é plain  ü", "é ¤ b", "é 2011.4.6 ü", "é ° ü", "é {x}", "é 91 다 5", "é　Ａ"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert r"[^\x00-\xff]" in df.select(N.repaired(F.col("t")))._jdf.queryExecution().analyzed().toString()
    assert [r.t for r in N.normalize_lines(df, text_col="t", log=False).collect()] == ["é plain ü", "é b", "é 2011. 4. 6. ü", "é ü", "é {x}", "é 91다5", "é A"]
