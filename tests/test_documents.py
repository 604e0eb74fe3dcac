"""Operators against sequential versions and literal cases."""

import random
import zipfile
from io import BytesIO

import pytest
from pyspark.sql import functions as F

from quirelake.functions import patterns as P
from quirelake.functions import text as X
from quirelake.operators import converter as C
from quirelake.operators import footnotes as N
from quirelake.operators import geometry as G
from quirelake.operators import normalize
from quirelake.operators import paragraphs as A
from quirelake.operators import render as R
from quirelake.operators import split as S
from quirelake.operators import structure as B
from quirelake.operators import validate as V
from quirelake.sources import parsers, sinks
from quirelake.sources import text as T

LINE = "doc_id string, page_no int, line_no int, text string"


def test_text_pages(spark):
    docs = spark.createDataFrame([("a", "lost\n<!-- page 3 -->\nx\n<!-- page 7 -->\ny"), ("b", "p\fq"), ("c", ""), ("d", None)], "doc_id string, text string")
    got = sorted((r.doc_id, r.page_no, r.text.strip()) for r in T.text_pages(docs).collect())
    assert got == [("a", 3, "x"), ("a", 7, "y"), ("b", 1, "p"), ("b", 2, "q"), ("c", 1, ""), ("d", 1, "")]
    lines = T.page_lines(spark.createDataFrame([("a", 1, "x \r\ny\x0bz w\n")], "doc_id string, page_no int, text string"))
    assert [r.text for r in lines.orderBy("line_no").collect()] == ["x", "y", "z", "w"]


def test_page_range(spark):
    pages = spark.createDataFrame([("a", k, "") for k in range(1, 9)], "doc_id string, page_no int, text string")
    for spec, want in (("2-4", [2, 3, 4]), ("5", [5]), ("7-", [7, 8]), (None, list(range(1, 9)))):
        assert sorted(r.page_no for r in T.page_range(pages, spec).collect()) == want


def test_json_lines(spark, tmp_path):
    path = f"{tmp_path}/b.jsonl"
    with open(path, "w") as f:
        f.write('{"kind": "para", "text": "x", "level": 0, "page": 1}\n\n')
    assert T.read_blocks(spark, path).first().text == "x"
    with open(path, "a") as f:
        f.write('{"kind": "para", "odd": 1}\n')
    with pytest.raises(ValueError, match="odd"):
        T.read_blocks(spark, path)
    assert sinks.write_json_lines(spark.range(3), f"{tmp_path}/out") == 3


def test_markdown_corpus(spark, tmp_path):
    for name in ("a.md", "README.md", "_reports/b.md", "sub/c.md", "d.txt"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(name)
    assert sorted(r.text for r in T.markdown_corpus(spark, str(tmp_path)).collect()) == ["a.md", "sub/c.md"]


def test_layout_footnotes_equal_a_fold(spark):
    rnd = random.Random(4)
    rows = [(f"d{d}", p, k, rnd.choice([f"{rnd.randint(1, 30)} note", f"{rnd.randint(1, 30)}) a b", "goes on", "5000 no", "   "])) for d in range(25) for p in range(3) for k in range(rnd.randint(0, 6))]
    got = {(r.doc_id, r.number): (r.page_no, r.text) for r in N.layout_footnotes(spark.createDataFrame(rows, LINE)).collect()}
    want = {}
    for d in range(25):
        reader = N.NoteReader(P.TEXTBOOK)
        for p in range(3):
            reader.page(p, [(k, t, "footnote") for dd, pp, k, t in rows if dd == f"d{d}" and pp == p], False)
        want |= {(f"d{d}", n["number"]): (n["page_no"], n["text"]) for n in reader.notes}
    assert got == want


def sequential_chapters(blocks):
    parts, now, lead, chapter = [], None, [], ""
    for seq, kind, level, text in blocks:
        if kind == "heading" and level == 1:
            lead.append(seq)
            chapter = text
            continue
        if kind == "heading" and level == 2:
            now = {"title": text, "chapter": f"{chapter} {text}".strip(), "seqs": [*lead, seq]}
            parts.append(now)
            lead = []
            continue
        if now is None:
            now = {"title": "머리", "chapter": chapter, "seqs": list(lead)}
            parts.append(now)
            lead = []
        now["seqs"].append(seq)
    return parts or [{"title": "전체", "chapter": "", "seqs": [b[0] for b in blocks]}]


def test_chapters_equal_a_fold(spark):
    rnd = random.Random(9)
    rows, want = [], {}
    for d in range(40):
        blocks = [(k, *rnd.choice([("heading", 1, f"P{k}"), ("heading", 2, f"C{k}"), ("heading", 3, f"S{k}"), ("para", 0, f"t{k}")])) for k in range(rnd.randint(1, 9))]
        rows += [(f"d{d}", *b) for b in blocks]
        want[f"d{d}"] = [(p["title"], p["chapter"], p["seqs"]) for p in sequential_chapters(blocks)]
    df = spark.createDataFrame(rows, "doc_id string, seq int, kind string, level int, text string")
    got = {}
    for r in S.split_chapters(df).groupBy("doc_id", "part", "title", "chapter").agg(F.sort_array(F.collect_list("seq")).alias("s")).orderBy("doc_id", "part").collect():
        got.setdefault(r.doc_id, []).append((r.title, r.chapter, r.s))
    assert got == want


def test_groups_and_resplit(spark):
    rows = [("d", k, kind, level, text) for k, (kind, level, text) in enumerate([("para", 0, "x"), ("heading", 2, "E-1. 하나"), ("para", 0, "a" * 50), ("heading", 3, "절"), ("para", 0, "b" * 50), ("heading", 2, "E-2. 둘"), ("heading", 2, "F-1. [주제-원칙]")])]
    df = spark.createDataFrame(rows, "doc_id string, seq int, kind string, level int, text string")
    parts = [(r.part, r.title, r.chapter, r.n) for r in S.split_groups(df).groupBy("part", "title", "chapter").agg(F.count("*").alias("n")).orderBy("part").collect()]
    assert parts == [(1, "머리", "", 1), (2, "하나", "E", 5), (3, "주제", "F", 1)]
    cut = [(r.part, r.title, r.section) for r in S.resplit(S.split_groups(df), 60).select("part", "title", "section").distinct().orderBy("part").collect()]
    assert cut == [(1, "머리", ""), (2, "하나-1", "E-1. 하나"), (3, "하나-2", "절"), (4, "하나-3", "E-2. 둘"), (5, "주제", "")]


def outlined(spark, texts, rules):
    df = spark.createDataFrame([("d", 1, k, t) for k, t in enumerate(texts)], LINE)
    return [(r.kind, r.text) for r in B.outline_documents(df, rules).orderBy("seq").collect()]


def test_long_names_and_glued_scores(spark):
    assert [t for _, t in outlined(spark, ["E-1. 청구 (74다1557)", "1. 쟁점 (2.5)", "2. 큰 수 90"], P.CASEBOOK)] == ["E-1. 청구 (74다1557)", "1. 쟁점 `2.5`", "2. 큰 수 90"]


def test_boxes_end(spark):
    got = outlined(spark, ["Ⅰ. 제목", "1. 하나", "口 상자", "안", "2. 둘", "V 한글", "제3장 다음"], P.TEXTBOOK)
    assert [k for k, _ in got] == ["heading", "bold", "bonus", "bold", "bonus", "heading"]


def test_scores_go_to_their_problem(spark):
    got = outlined(spark, ["E-5. 일부청구", "문제 (40점)", "甲은", "乙에게", "답안 (3점)", "글이다", "문제", "(1) 작은 7점"], P.CASEBOOK)
    assert got == [("heading", "E-5. 일부청구 `40점` `3점`"), ("bold", "**문제**"), ("prompt", "> 甲은 乙에게"), ("bold", "**답안**"), ("para", "글이다"), ("bold", "**문제**"), ("heading", "(1) 작은 `7`")]


def test_blocks_equal_a_walk(spark):
    """Boxes, items and paragraphs of random books, told by what each line is made from."""
    rnd = random.Random(12)
    kinds = {"part": "제1편 총론", "roman": "Ⅰ. 제목", "item": "{}. 하나", "mark": "☑ 상자", "text": "글이", "end": "끝이다.", "list": "- 목록", "blank": " ", "strip": "의의 - 내용 - 예외 - 효과"}
    rows, want = [], {}
    for d in range(60):
        made, roman, last, inside, para = [], False, 0, None, None
        for k in range(rnd.randint(0, 40 if d % 6 else 90)):
            kind, n = rnd.choice(list(kinds)), rnd.randint(1, 3)
            rows.append((f"d{d}", k // 7, k, kinds[kind].format(n)))
            if kind == "blank":
                para = None
            elif inside is not None and inside[1] < 24 and kind not in ("part", "roman") and not (kind == "item" and n == last + 1):
                inside[1] += 1
            else:
                inside = None
                if kind in ("text", "end", "list"):
                    if para is None or kind == "list" or para[2]:
                        para = ["para", 0, False]
                        made.append(para)
                    para[1], para[2] = para[1] + 1, kind == "end"
                    continue
                para = None
                made.append(["bonus", 0] if kind == "mark" else ["para", 1] if kind == "strip" else ["bold" if kind == "item" and roman else "heading", 1])
                if kind == "mark":
                    inside = made[-1]
                elif kind == "item" and roman:
                    last = n
                elif kind in ("part", "roman"):
                    roman, last = kind == "roman", 0
        if made:
            want[f"d{d}"] = [(m[0], m[1]) for m in made]
    got = {}
    for r in B.outline_documents(spark.createDataFrame(rows, LINE).repartition(3)).orderBy("doc_id", "seq").collect():
        n = len(r.text.split("\n")) - 1 if r.kind == "bonus" else r.text.count("글이") + r.text.count("끝이다.") + r.text.count("목록") if r.kind == "para" and not r.meta.outline else 1
        got.setdefault(r.doc_id, []).append((r.kind, n))
    assert got == want


def test_dates_strip(spark):
    import dataclasses

    rules = dataclasses.replace(P.TEXTBOOK, date_hangul="strip")
    df = spark.createDataFrame([("2011. 4. 26로 한다",)], "text string")
    assert normalize.normalize_lines(df, rules, log=False).first().text == "2011. 4. 26. 한다"


def test_pairs_equal_all_pairs(spark):
    rnd = random.Random(6)
    words = ["".join(rnd.choices("abc", k=rnd.randint(1, 9))) for _ in range(60)]
    a, b = set(words[:35]), set(words[25:])

    def distance(x, y):
        row = list(range(len(y) + 1))
        for i, c in enumerate(x, 1):
            row, last = [i], row
            for j, d in enumerate(y, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (c != d)))
        return row[-1]

    want = {(x, y, d) for x in a - b for y in b - a if 0 < (d := distance(x, y)) <= max(1, len(x) // 4) and abs(len(x) - len(y)) <= 1}
    mk = lambda s: spark.createDataFrame([(w, 1) for w in sorted(s)], "term string, n long")
    assert {tuple(r) for r in V.near_misses(mk(a), mk(b)).collect()} == want


def test_markdown_html():
    h = R.markdown_html
    assert h("# A *b*\n\ntext\nmore") == "<h1>A <em>b</em></h1>\n<p>text<br>more</p>"
    assert h("- a\n  - b\n- c\n1. d") == "<ul><li>a<ul><li>b</li></ul></li><li>c</li></ul><ol><li>d</li></ol>"
    assert h("[x](javascript:a) ![y](javascript:b)") == '<p><a href="#" target="_blank" rel="noopener">x</a> <img src="" alt="y"></p>'
    assert h("![y](p.png)", lambda u: "blob:1") == '<p><img src="blob:1" alt="y"></p>'
    assert h("<script>x</script><br>") == "<p>&lt;script&gt;x&lt;/script&gt;<br></p>"
    assert h("```\na<b\n```\n> q\n---") == "<pre><code>a&lt;b</code></pre>\n<blockquote><p>q</p></blockquote>\n<hr>"
    assert h("|a|b|\n|---|---|\n|1\\|2|`x`|") == "<table><thead><tr><th>a</th><th>b</th></tr></thead><tbody><tr><td>1|2</td><td><code>x</code></td></tr></tbody></table>"
    assert h("**b** ***c*** _d_ ``e`f``") == "<p><strong>b</strong> <strong><em>c</em></strong> <em>d</em> <code>e`f</code></p>"
    assert h(None) == "" and h("a\r\nb") == "<p>a<br>b</p>"


def test_blank_lines():
    assert R.tidy_blank_lines("a\n\n\nb\n\n- x\n\n- y\n\nz\n```\n\n\n```\n") == "a\n\nb\n\n- x\n- y\n\nz\n```\n\n\n```\n"


def test_archives():
    a = R.zip_bytes([("a.md", b"x" * 500), ("b", b"y")])
    assert a == R.zip_bytes([("a.md", b"x" * 500), ("b", b"y")])
    assert zipfile.ZipFile(BytesIO(a)).read("a.md") == b"x" * 500
    assert R.unique_names(["a.md", "a.md", "a-2.md", "n"]) == ["a.md", "a-2.md", "a-2-2.md", "n"]


def test_markers_and_inline(spark):
    span = {"x0": 0.0, "x1": 5.0, "size": 10.0, "bold": False, "italic": False, "mono": False, "link": None}

    def of(spans, made):
        return spark.createDataFrame([([{**span, **s} for s in spans],)], f"s {C.SPANS}").select(made(F.col("s"))).first()[0]

    def cut(marker):
        return lambda s: F.transform(C.cut_spans(s, F.lit(marker)), lambda x: x["text"])

    parts = [{"text": t} for t in ("1", ")", " 항목")]
    assert of(parts, cut("1)")) == [" 항목"] and of(parts[:2], cut("1)")) == ["1", ")"] and of(parts, cut("")) == ["1", ")", " 항목"]
    assert of([{"text": "( 1"}, {"text": ") x"}, {"text": " "}], cut("(1)")) == [" x", " "]
    opt = C.ConvertOptions()
    inline = lambda s: C.inline(s, opt)
    assert of([{"text": "a_b", "bold": True}, {"text": "c", "bold": True, "x0": 20.0, "x1": 25.0}], inline) == "**a\\_b c**"
    assert of([{"text": "x`y", "mono": True}], inline) == "``x`y``" and of([{"text": "`", "mono": True}], inline) == "`` ` ``"
    assert of([{"text": "t", "link": "http://e.org/a b("}], inline) == "[t](http://e.org/a%20b%28)"
    assert of([{"text": ""}, {"text": " "}], inline) == "" and of([], inline) == ""
    assert C.options_from({"pageComment": True, "odd": 1}).page_comment


def page_of(lines, width=595.0):
    spans = [dict(block_no=b, line_no=k, span_no=0, text=t, x0=x, y0=y, x1=x + w, y1=y + s, size=s, bold=bold, italic=False, mono=mono, link=None) for b, k, t, x, y, w, s, bold, mono in lines]
    return {"spans": spans, "tables": [], "images": [], "width": width}


def test_page_chunks(spark):
    def chunks(lines, **options):
        headings = [{"level": 1, "size": 20.0}, {"level": 2, "size": 15.0}]
        schema = f"elements {C.ELEMENTS}, toc array<struct<seq: int, level: int, title: string>>, body_size double, headings array<struct<level: int, size: double>>, stops array<double>, spans {C.SPANS}, tables array<struct<text: string>>, images array<struct<text: string>>"
        page = page_of(lines)
        df = spark.createDataFrame([(C.page_elements(page), [], 10.0, headings, [60.0, 80.0], page["spans"], [], [])], schema)
        return df.select(C.page_chunks(C.ConvertOptions(**options))).first()[0]

    lines = [(0, 0, "Title", 50.0, 40.0, 100.0, 20.0, True, False), (1, 0, "1. Part", 50.0, 80.0, 80.0, 15.0, False, False), (2, 0, "• one", 60.0, 120.0, 60.0, 10.0, False, False), (3, 0, "• two", 80.0, 131.0, 60.0, 10.0, False, False), (4, 0, "1. not a list here", 50.0, 300.0, 90.0, 10.0, False, False)]
    assert chunks(lines) == ["# Title", "## 1. Part", "- one", "  - two", "1. not a list here"]
    assert chunks(lines[-1:], detect_lists=False) == ["1\\. not a list here"]
    assert chunks([]) == []
    code = [(0, 0, "def f():", 55.0, 100.0, 48.0, 10.0, False, True), (0, 1, "return 1", 79.0, 114.0, 48.0, 10.0, False, True), (0, 2, "```", 55.0, 142.0, 18.0, 10.0, False, True)]
    assert chunks(code) == ["````\ndef f():\n    return 1\n\n```\n````"]


def test_convert_strips_running_text(spark):
    rows = []
    for p in range(4):
        rows += [("d", p, 0, 0, 0, "Report 2024", 55.0, 20.0, 150.0, 30.0, 9.0), ("d", p, 1, 0, 0, f"Body of page {p} has enough words to be text.", 55.0, 200.0, 400.0, 210.0, 10.0), ("d", p, 2, 0, 0, f"- {p + 1} -", 290.0, 820.0, 310.0, 830.0, 9.0)]
    spans = spark.createDataFrame(rows, "doc_id string, page_no int, block_no int, line_no int, span_no int, text string, x0 double, y0 double, x1 double, y1 double, size double")
    spans = spans.withColumns({c: F.lit(False) for c in ("bold", "italic", "mono")})
    pages = spark.createDataFrame([("d", p, 595.0, 842.0) for p in range(4)] + [("e", 0, 595.0, 842.0)], "doc_id string, page_no int, width double, height double")
    got = {r.doc_id: r for r in C.convert(spans, pages).collect()}
    assert got["d"].markdown == "\n\n".join(f"Body of page {p} has enough words to be text." for p in range(4)) + "\n"
    assert got["e"].warnings == ["no text"] and got["d"].warnings == [] and got["d"].stats.pages == 4
    total = C.summary(C.convert(spans, pages).withColumn("error", F.when(F.col("doc_id") == "e", "open"))).first()
    assert (total.files, total.done, total.failed, total.pages) == (2, 1, 1, 4)
    meta = spark.createDataFrame([("d", 'A "title"', " ")], "doc_id string, title string, author string")
    told = C.convert(spans, pages, meta=meta, options=C.ConvertOptions(front_matter=True)).where("doc_id = 'd'").first().markdown
    assert told.startswith('---\nsource: "d"\ntitle: "A \\"title\\""\npages: 4\n---\n')
    kept = C.convert(spans, pages, options=C.ConvertOptions(strip_header_footer=False, page_separator=True, page_comment=True, front_matter=True)).where("doc_id = 'd'").first().markdown
    assert kept.startswith('---\nsource: "d"\npages: 4\n---\n\n<!-- page 1 -->\n\nReport 2024') and kept.count("\n---\n") == 4


def test_columns_and_merging():
    boxes = [(50.0, 100.0 + 30 * k, 270.0, 120.0 + 30 * k, k) for k in range(3)] + [(320.0, 100.0 + 30 * k, 550.0, 120.0 + 30 * k, 3 + k) for k in range(3)]
    assert [b[4] for b in G.order_boxes(boxes, 0.0, 595.0)] == [0, 1, 2, 3, 4, 5]
    assert [b[4] for b in G.order_boxes(boxes, 0.0, 595.0, columns=False)] == [0, 3, 1, 4, 2, 5]


def test_parsers():
    assert parsers.pick_parser(["nothing", "textfile"]).name == "textfile"
    with pytest.raises(KeyError):
        parsers.get_parser("nothing")
    assert parsers.availability()["textfile"] == (True, "")


def test_columns_functions(spark):
    df = spark.createDataFrame([(0x1F4E9C, "E-5. x"), (0x808080, "y")], "rgb int, t string")
    got = df.select(X.to_hex(F.col("rgb")).alias("h"), X.is_body_colour(F.col("rgb")).alias("b"), X.indent_level(F.lit(71.0), F.array(F.lit(60.0), F.lit(82.0))).alias("i"), X.blockquote(F.lit("a\nb")).alias("q")).collect()
    assert [(r.h, r.b, r.i, r.q) for r in got] == [("#1f4e9c", False, 0, "> a\n> b"), ("#808080", True, 0, "> a\n> b")]


def test_paragraph_modes(spark):
    df = spark.createDataFrame([("d", 0, k, t) for k, t in enumerate(["One line", "goes on.", "New one", "", "After blank", "- item"])], LINE)
    got = [r.text for r in A.paragraphs(df, ["doc_id"]).orderBy("para").collect()]
    assert got == ["One line goes on.", "New one", "After blank", "- item"]


def test_batch_pipeline(spark, tmp_path):
    from quirelake.plans import corpus

    text = "<!-- page 1 -->\n제1장 총칙\n본문이다. 판례＜74다1557) 참조\n<!-- page 2 -->\n제2장 다음\n끝이다."
    docs = spark.createDataFrame([("book", text)], "doc_id string, text string")
    assert corpus.run(spark, docs, str(tmp_path)) in ("PASS", "WARN")
    files = spark.read.parquet(f"{tmp_path}/06_files").orderBy("part").collect()
    assert not any("PENDING" in f.content for f in files) and all("validation: " in f.content for f in files)
    assert [f.name for f in files] == ["01_제1장총칙.md", "02_제2장다음.md"] and "판례(74다1557) 참조" in files[0].content
    assert corpus.run(spark, docs, str(tmp_path), start="split") in ("PASS", "WARN")
    assert spark.read.parquet(f"{tmp_path}/06_files").count() == 2
    corpus.run(spark, docs, str(tmp_path / "b"), pages="2")
    assert [f.name for f in spark.read.parquet(f"{tmp_path}/b/06_files").collect()] == ["01_제2장다음.md"]


def test_command_line(spark, tmp_path, capsys):
    from quirelake import cli

    (tmp_path / "in").mkdir()
    (tmp_path / "in/book.txt").write_text("제1장 총칙\n본문이다. [확객시전] 74다1557\n")
    out = str(tmp_path / "out")
    assert cli.main(["run", str(tmp_path / "in"), "--out", out]) == 2  # no diagnosis
    assert cli.main(["run", str(tmp_path / "in"), "--out", out, "--force"]) == 0
    assert cli.main(["diagnose", str(tmp_path / "in"), "--out", out]) == 0
    assert "book.txt" in (tmp_path / "out/_reports/diagnosis.md").read_text()
    assert cli.main(["run", str(tmp_path / "in"), "--out", out]) == 0
    files = spark.read.parquet(f"{out}/06_files")
    for side, word in (("a", "[확객시전]"), ("b", "[확객시젼]")):
        rows = files.select(F.concat(F.lit("sub/"), "name").alias("name"), F.replace("content", F.lit("[확객시전]"), F.lit(word)).alias("content"))
        assert sinks.write_files(rows, f"{tmp_path}/{side}") == 1
        assert (tmp_path / side / "sub/01_제1장총칙.md").exists()
    assert cli.main(["crosscheck", f"{tmp_path}/a", f"{tmp_path}/b"]) == 1
    assert "| `[확객시전]` | `[확객시젼]` | 1 |" in (tmp_path / "a/_reports/crosscheck.md").read_text()
    assert cli.main(["validate", f"{tmp_path}/a"]) == 0


def test_contexts_have_both_sides(spark):
    files = spark.createDataFrame([("b.md", "x 74다1557 y\n74다1557 z [확객시전]"), ("a.md", "---\nq\n---\n" + "[확객시전] " * 25), ("c.md", None)], "name string, text string")
    got = sorted((r.pos, r.case_id, r.context) for r in V.case_hits(files).collect())
    assert got == [(0, "74다1557", "…x 〖74다1557〗 y⏎74다1557 z [확객시전]…"), (1, "74다1557", "…x 74다1557 y⏎〖74다1557〗 z [확객시전]…")]
    seen = V.mnemonic_contexts(files).collect()
    assert len(seen) == 20 and {r.name for r in seen} == {"a.md"} and all("〖[확객시전]〗" in r.context for r in seen)


def test_change_log_equals_a_scan(spark):
    """Fixes of case numbers, in the order of a scan from left to right."""
    import re

    rnd = random.Random(3)
    bits = ["91 다 43695", "74다1557", "2019다 223723", "＜", "〉", "*", " ＊", " ", "와 ", "]", "(", ")", "가", "{", "7", "x"]
    texts = ["".join(rnd.choices(bits, k=rnd.randint(1, 8))) for _ in range(600)]
    rules = P.TEXTBOOK
    loose = re.compile(rules.case_loose.removeprefix("(?U)"))

    def scan(text):
        out, at, log = "", 0, []
        for m in loose.finditer(text):
            gap, fixed = text[at : m.start()], "".join(m.groups())
            if fixed != m[0]:
                log.append(("space", m[0], fixed))
            head = gap.rstrip(" ")
            if head and head[-1] in P.OPEN_BRACKETS and head[-1] != "(":
                log.append(("bracket", head[-1] + m[0], "(" + fixed))
                gap = head[:-1] + "(" + gap[len(head) :]
            out, at = out + gap + fixed, m.end()
            if star := re.match(rf"\s*[{re.escape(''.join(P.STARS))}]", text[at:]):
                if star[0] != "*":
                    log.append(("star", fixed + star[0], fixed + "*"))
                out, at = out + "*", at + star.end()
            close = re.match(r"\s*(.)", text[at:])
            if close and close[1] in P.CLOSE_BRACKETS and close[1] != ")":
                log.append(("bracket", fixed + close[0], fixed + ")"))
                out, at = out + ")", at + close.end()
        return out + text[at:], log

    one = F.struct(F.col("text").alias("t"), F.array().cast(f"array<{normalize.CHANGE}>").alias("c"))
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select("text", normalize.case_numbers(one, rules).alias("r")).collect()
    for r in rows:
        assert (r.r.t, [(c.kind, c.before, c.after) for c in r.r.c]) == scan(r.text), r.text


def test_profiles_with_other_suffixes(spark):
    import dataclasses

    rules = dataclasses.replace(P.TEXTBOOK, case_suffixes=("Da",), known_suffixes=("Da",))
    df = spark.createDataFrame([("see 91 Da 43695 and 2011.4.6",), ("plain",), ("{확객시전}",)], "text string")
    assert [r.text for r in normalize.normalize_lines(df, rules).collect()] == ["see 91Da43695 and 2011. 4. 6.", "plain", "[확객시전]"]


def test_pdf_parts(spark, monkeypatch):
    """The scans for metadata, bookmarks, links, images and rules, on a stand-in for the library."""
    import sys
    import types

    import pandas as pd

    class Page:
        number = 0

        def get_links(self):
            return [{"from": (1, 2, 3, 4), "uri": "http://e.org"}, {"from": (0, 0, 1, 1)}]

        def get_images(self, full):
            return [(7, 0)]

        def get_image_rects(self, xref):
            return [(5, 6, 7, 8)]

        def get_drawings(self):
            return [{"items": [("l", (10, 50), (110, 50)), ("re", (10, 10, 60, 40)), ("c", 0), ("re", (0, 0, 1, 1))]}]

    class Doc:
        metadata, needs_pass = {"title": "T", "author": ""}, False

        def __enter__(self):
            return self

        def __exit__(self, *a):
            return False

        def __iter__(self):
            return iter([Page()])

        def get_toc(self):
            return [[1, "One", 1]]

        def extract_image(self, xref):
            return {"ext": "png", "image": b"x"}

    def open_(stream, filetype):
        if stream == b"bad":
            raise RuntimeError("broken")
        return Doc()

    monkeypatch.setitem(sys.modules, "pymupdf", types.SimpleNamespace(open=open_))
    got = list(parsers._pdf_parts(iter([pd.DataFrame({"path": ["a", "b"], "content": [b"good", b"bad"]})])))
    assert list(got[0]["kind"]) == ["metadata", "bookmark", "link", "image", "rule", "rule", "rule"] and list(got[1]["error"]) == ["open: broken"]
    rows = [tuple(None if pd.isna(v) else v for v in r) for r in got[0].itertuples(index=False)]
    rows = [(r[0], None if r[1] is None else int(r[1]), r[2], int(r[3]), *(None if v is None else float(v) for v in r[4:8]), r[8], None if r[9] is None else int(r[9]), *r[10:]) for r in rows]
    tables = parsers.part_tables(spark.createDataFrame(rows, parsers.PARTS))
    assert [tuple(r) for r in tables["rules"].orderBy("orient", "pos").collect()] == [("a", 0, "h", 10.0, 10.0, 60.0), ("a", 0, "h", 40.0, 10.0, 60.0), ("a", 0, "h", 50.0, 10.0, 110.0), ("a", 0, "v", 10.0, 10.0, 40.0), ("a", 0, "v", 60.0, 10.0, 40.0)]
    assert tables["links"].first().uri == "http://e.org" and tables["images"].first().ext == "png" and tables["toc"].first().title == "One"


def test_reports(spark):
    from quirelake.operators import spans as W

    rows = [("d", 1, k, 0, t, c) for k, (t, c) in enumerate([("body", 0), ("red", 0xCC0000), ("red too", 0xC80404), ("blue", 0x0000CC), (" ", 0xCC0000)])]
    df = spark.createDataFrame(rows, "doc_id string, page_no int, line_no int, span_no int, text string, rgb int")
    text = sinks.palette_report(W.palette_counts(df), W.palette_samples(df), 5)
    assert "colours after merging: 2" in text and "| `#cc0000` | 2 | 10 | 66.7% |" in text and "- p.1 red too" in text
    assert sinks.index_text(["b.md", "a.md"]) == "# Reports\n\n- [a.md](a.md)\n- [b.md](b.md)\n"
    pages = parsers.element_pages(spark.createDataFrame([("d", 2, 1, "b"), ("d", 2, 0, "a"), ("d", None, 0, "c")], "doc_id string, page int, seq int, markdown string"))
    assert sorted((r.page_no, r.text) for r in pages.collect()) == [(1, "c"), (2, "a\nb")]


def test_streaming(spark, tmp_path):
    from quirelake.streaming import documents

    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text("91 다 43695\n\nx")
    q = documents.normalized_lines(documents.read_texts(spark, f"{tmp_path}/in")).writeStream.format("memory").queryName("lines").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted(r.text for r in spark.table("lines").collect()) == ["91다43695", "x"]


def test_operators_without_the_training_subpackage():
    import pathlib

    root = pathlib.Path(__file__).parent.parent / "quirelake"
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert "quirelake.llm" not in path.read_text()


def test_profiles_from_yaml(tmp_path):
    yaml = pytest.importorskip("yaml")
    from quirelake.functions import config

    path = tmp_path / "c.yaml"
    path.write_text(yaml.safe_dump({"preserve": {"mnemonic": {"max_total_len": 5}, "case_suffixes": ["다"]}, "profiles": {"casebook": {"score_max": 70}, "own": {"headings": [{"level": 1, "pattern": "^# "}]}}}))
    tree = config.load(str(path))
    rules = config.rules_of(tree, "casebook")
    assert (rules.mnemonic_max, rules.score_max, rules.split, rules.case_suffixes) == (5, 70.0, "group", ("다",))
    assert config.rules_of(tree, "own").headings == ((1, "^# "),)
    with pytest.raises(KeyError):
        config.rules_of(tree, "none")


def test_sampled_pages(spark):
    df = spark.createDataFrame([(0,), (3,), (100,)], "n int").select(T.sampled_pages(F.col("n"), 4).alias("p"))
    assert [r.p for r in df.collect()] == [[], [0, 1, 2], [5, 27, 49, 71]]


def test_ties_and_nulls_in_statistics(spark):
    from quirelake.operators import statistics as Q

    rows = [("d", 0, 0, "aaaa", 12.0), ("d", 0, 1, "bbbb", 10.0), ("d", 0, 2, None, 9.0), ("e", 0, 0, "  ", 10.0)]
    tally = Q.size_tally(spark.createDataFrame(rows, "doc_id string, page_no int, line_no int, text string, size double"))
    assert [(r.doc_id, r.body_size) for r in Q.body_size(tally).collect()] == [("d", 12.0)]  # of equals the first met


def test_empty_tables(spark):
    lines = spark.createDataFrame([], LINE)
    assert N.layout_footnotes(lines).count() == N.plain_footnotes(lines).count() == B.outline_documents(lines).count() == 0
    files = spark.createDataFrame([], "name string, text string")
    assert [(r.level, r.check) for r in V.validate(files).collect() if r.level == "FAIL"] == [("FAIL", "input")]


def test_terms_are_whole_words(spark, tmp_path):
    from quirelake.plans.registry import QUERIES

    for name, text in (("documents", "Ab Constitution Constitutional Internationally Jurisdiction"), ("benchmark", "Abc Constitution Internationale Jurisdictiom")):
        spark.createDataFrame([(1, text)], "id int, text string").write.parquet(f"{tmp_path}/{name}.parquet")
    terms = {(r.term, r.side) for r in QUERIES["crosscheck_terms"](spark, str(tmp_path)).collect()}
    assert terms == {("Ab", "a"), ("Abc", "b"), ("Constitution", "both"), ("Constitutional", "a"), ("Internationally", "a"), ("Internationale", "b"), ("Jurisdiction", "a"), ("Jurisdictiom", "b")}
    pairs = {tuple(r) for r in QUERIES["crosscheck_pairs"](spark, str(tmp_path)).collect()}
    assert pairs == {("Ab", "Abc", 1), ("Internationally", "Internationale", 2), ("Jurisdiction", "Jurisdictiom", 1)}


def test_images_are_whole_pages(spark, tmp_path):
    from quirelake.plans.registry import QUERIES

    head = "<!DOCTYPE html><html><head><title>" + "same " * 20
    rows = [(0, head + "a"), (1, head + "b"), (2, head + "a"), (3, head + "a"), (4, head + "c")]
    spark.createDataFrame([(i, f"https://h.example.org/{i}", html) for i, html in rows], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.n: r.path for r in QUERIES["image_dedupe"](spark, str(tmp_path)).collect()}
    assert got[1] == got[5] == got[7] and got[2] == got[4] == got[6] == got[8] == got[10] and len(set(got.values())) == 4
    assert QUERIES["running_images"](spark, str(tmp_path)).count() == 2


def test_pdf_parsers_need_their_libraries(monkeypatch):
    monkeypatch.setattr(parsers.importlib.util, "find_spec", lambda name: None)
    for name in ("marker", "mineru", "pymupdf", "pymupdf4llm", "paddleocr"):
        assert parsers.availability()[name] == (False, f"{name} is not installed")
    with pytest.raises(LookupError):
        parsers.pick_parser(["pymupdf", "marker", "mineru"])


def test_bundles_hold_their_files(spark):
    from quirelake.plans.registry import QUERIES

    sf = "/root/testdata/sf0.001"
    rows = {}
    for r in spark.read.parquet(f"{sf}/conversations.parquet").orderBy("conv_id", "turn").collect():
        rows.setdefault(r.conv_id, []).append((f"{r.role}.md", (r.text or "").encode()))
    want = {str(k): R.zip_bytes(list(zip(R.unique_names([n for n, _ in v]), (d for _, d in v), strict=True))) for k, v in rows.items()}
    got = QUERIES["zip_bundle"](spark, sf).collect()
    assert {r.bundle: r.n_bytes for r in got} == {k: len(v) for k, v in want.items()}
    import hashlib

    assert {r.bundle: r.digest for r in got} == {k: hashlib.sha256(v).hexdigest() for k, v in want.items()}
    z = zipfile.ZipFile(BytesIO(want["0" if "0" in want else min(want)]))
    assert sorted(z.read(n) for n in z.namelist()) == sorted(d for _, d in rows[int("0" if "0" in want else min(want))])


def test_odd_rows(spark):
    """Null texts, null and repeated ids, ties, empty and very long texts, further columns, empty tables."""
    from quirelake.functions.unicode import fingerprint
    from quirelake.operators import diagnose as D
    from quirelake.operators import running as U
    from quirelake.operators import spans as W
    from quirelake.operators import statistics as Q

    layout = LINE + ", size double, x0 double, y0 double, x1 double, y1 double, block_no int, span_no int, bold boolean, rgb int, origin_y double, rn int, n int, zone string"
    box = (10.0, 50.0, 300.0, 200.0, 312.0, 0, 0, False, 0, 308.0, 1, 2, "body")
    top = (10.0, 50.0, 5.0, 200.0, 15.0, 0, 0, False, 0, 12.0, 1, 2, "body")
    long = "word " * 20_000
    rows = [("d", 0, 0, None, *top), ("d", 0, 1, "", *box), ("d", 0, 2, "text.", *box), ("d", 0, 2, "text.", *box), (None, 0, 0, "x", *box), ("d", 1, 0, long, *box), ("d", None, None, "odd", *box)]
    df, none = spark.createDataFrame(rows, layout), spark.createDataFrame([], layout)
    for t in (df, none):
        some = t is df
        tally = Q.size_tally(t)
        bodies = Q.body_size(tally)
        assert {r.doc_id for r in bodies.collect()} == ({"d", None} if some else set())
        assert Q.heading_map(tally).count() == 0 and Q.indent_stops(t, bodies).count() == 0
        assert Q.line_sizes(t, ["doc_id", "page_no"]).count() == (4 if some else 0)
        fp = t.withColumn("fp", fingerprint(F.coalesce("text", F.lit(""))))
        assert U.strip_running(fp, bodies, 842.0).count() == t.count() and U.trim_notice(t).count() == t.count()
        assert sorted(len(r.text) for r in A.paragraphs(t, ["doc_id"]).collect()) == ([1, 3, 11, len(long)] if some else [])  # lines of one place are one paragraph
        kept = normalize.normalize_lines(t)
        assert kept.count() == (5 if some else 0) and {"changes", "rn", "zone"} <= set(kept.columns)
        assert N.layout_footnotes(t).count() == 0 and N.plain_footnotes(t).where("kind = 'body'").count() == len(rows) * some
        marks = N.mark_zones(t.withColumn("body_size", F.lit(10.0)), 842.0)
        assert marks.count() == len(rows) * some
        blocks = B.outline_documents(t)
        assert sorted(len(r.text) for r in blocks.collect()) == ([1, 3, 5, 5, len(long.rstrip())] if some else [])
        files = S.part_files(S.split_parts(blocks), P.TEXTBOOK, "textfile")
        assert files.count() == (2 if some else 0)
        assert V.validate(files.select("name", F.col("content").alias("text"))).where("level = 'FAIL'").count() == (0 if some else 1)
        assert W.palette_counts(t).count() == 0 and W.margin_notes(t, 595.0)[1].count() == 0
        assert G.link_spans(t, t.select("doc_id", "page_no", F.lit(0).alias("link_no"), "x0", "y0", "x1", "y1", F.lit("u").alias("uri"))).count() == t.count()
        pages = t.select("doc_id", F.coalesce("page_no", F.lit(9)).alias("page_no"), "text")
        assert {r.doc_id for r in D.diagnose(pages).collect()} == ({"d", None} if some else set())
    grids = spark.createDataFrame([(None,), ([],), ([[None, "a|b"], [""], ["", "c"]],)], "r array<array<string>>")
    assert [r[0] for r in grids.select(R.table_markdown(F.col("r"))).collect()] == ["", "", "| 열1 | a\\|b |\n| --- | --- |\n|  | c |"]
    htmls = spark.createDataFrame([(None,), ("",), ("*" * 5000,)], "t string").select(R.render_html(F.col("t")).alias("h"), R.tidy_markdown(F.col("t")).alias("m")).collect()
    assert [r.h for r in htmls[:2]] == ["", ""] and htmls[0].m is None


def test_assets_move_with_their_document(spark):
    from quirelake.operators import running as U

    images = spark.createDataFrame([("d", 0, 0, "h", b"x"), ("d", 1, 0, "h", b"x"), ("d", 2, 0, "i", b"y")], "doc_id string, page_no int, img_no int, hash string, data binary")
    assert sorted((r.name, bytes(r.content)) for r in U.asset_files(images, "a").collect()) == [("a.assets/a-p1-1.png", b"x"), ("a.assets/a-p3-3.png", b"y")]
    rows = [("z", d, k, n, c) for d in (0, 1, 2) for k, (n, c) in enumerate([("a.md", b"![i](a.assets/a-p1-1.png)"), ("a.assets/a-p1-1.png", b"x")])] + [("z", 3, 0, "a-2.md", b"")]
    got = [(r.name, bytes(r.content)) for r in R.named_documents(spark.createDataFrame(rows, "bundle string, doc int, seq int, name string, content binary")).orderBy("seq").collect()]
    want = []
    for stem in ("a", "a-2", "a-3"):
        want += [(f"{stem}.md", f"![i]({stem}.assets/a-p1-1.png)".encode()), (f"{stem}.assets/a-p1-1.png", b"x")]
    assert got == [*want, ("a-2-2.md", b"")]
