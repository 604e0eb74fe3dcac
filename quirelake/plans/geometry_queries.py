"""Queries of geometry and rendering."""

from __future__ import annotations

from pyspark.sql import functions as F

from quirelake.operators import geometry as G
from quirelake.operators import render as R
from quirelake.operators import spans as L
from quirelake.plans.base import LAYOUT_SQL, in_turn, layout_lines, query, sql_rows, table


def _layout(spark, sf_dir):
    return layout_lines(table(spark, sf_dir, "documents"))


_RATIO = "greatest(0, least({a}.x1, {b}.x1) - greatest({a}.x0, {b}.x0)) * greatest(0, least({a}.y1, {b}.y1) - greatest({a}.y0, {b}.y0)) / greatest(({a}.x1 - {a}.x0) * ({a}.y1 - {a}.y0), 1e-6)"
_LINKS = """
links AS (SELECT doc_id, page_no, k AS link_no, 50.0 + 120.0 * k AS x0, 30.0 + 250.0 * k AS y0, 350.0 + 120.0 * k AS x1, 60.0 + 250.0 * k AS y1, 'u' || k AS uri
  FROM (SELECT DISTINCT doc_id, page_no FROM layout) CROSS JOIN (SELECT unnest([0, 1, 2]) AS k))
"""


def _links(lines):
    k = F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("k")
    rows = lines.select("doc_id", "page_no").distinct().select("doc_id", "page_no", k)
    return rows.select("doc_id", "page_no", F.col("k").alias("link_no"), (50.0 + 120.0 * F.col("k")).alias("x0"), (30.0 + 250.0 * F.col("k")).alias("y0"), (350.0 + 120.0 * F.col("k")).alias("x1"), (60.0 + 250.0 * F.col("k")).alias("y1"), F.concat(F.lit("u"), F.col("k").cast("string")).alias("uri"))


@query(f"""
WITH {LAYOUT_SQL}, {_LINKS}
SELECT s.doc_id, s.line_no, min_by(k.uri, k.link_no) AS uri FROM layout s LEFT JOIN links k ON s.doc_id = k.doc_id AND s.page_no = k.page_no AND {_RATIO.format(a='s', b='k')} > 0.4 GROUP BY ALL
""")
def link_span_join(spark, sf_dir):
    lines = _layout(spark, sf_dir)
    return G.link_spans(lines, _links(lines)).select("doc_id", "line_no", "uri")


@query(f"WITH {LAYOUT_SQL}, {_LINKS} SELECT s.doc_id, s.line_no FROM layout s WHERE NOT EXISTS (SELECT 1 FROM links k WHERE s.doc_id = k.doc_id AND s.page_no = k.page_no AND {_RATIO.format(a='s', b='k')} > 0.55)")
def overlap_anti_join(spark, sf_dir):
    lines = _layout(spark, sf_dir)
    return G.outside(lines, _links(lines)).select("doc_id", "line_no")


@query(f"""
WITH {LAYOUT_SQL}, h AS (SELECT doc_id, page_no, line_no AS heading_no, y0 AS y FROM layout), n AS (SELECT doc_id, page_no, y0 + (length(text) % 25) - 12 AS y, 's' || line_no AS text FROM layout)
SELECT h.doc_id, h.page_no, h.heading_no, n.text FROM h JOIN n ON h.doc_id = n.doc_id AND h.page_no = n.page_no AND abs(h.y - n.y) <= 12
""")
def nearest_sidenote(spark, sf_dir):
    """Notes that have one heading in reach each: the greedy choice is then the join itself."""
    lines = _layout(spark, sf_dir)
    heads = lines.select("doc_id", "page_no", F.col("line_no").alias("heading_no"), F.col("y0").alias("y"))
    notes = lines.select("doc_id", "page_no", F.col("line_no").alias("note_no"), (F.col("y0") + F.char_length("text") % 25 - 12).alias("y"), F.concat(F.lit("s"), F.col("line_no").cast("string")).alias("text"))
    return G.nearest_notes(heads, notes)


@query(f"WITH {LAYOUT_SQL} SELECT doc_id, page_no, h AS heading_no, t || page_no AS text FROM (SELECT DISTINCT doc_id, page_no FROM layout), (VALUES (1, 'b'), (2, 'a')) AS v(h, t)")
def sidenotes_are_used_once(spark, sf_dir):
    """Three headings and three notes on each page: the first takes the nearest, the second what is left, the third none."""
    pages = _layout(spark, sf_dir).select("doc_id", "page_no").distinct().withColumn("y", (F.col("page_no") * 3).cast("double"))
    heads = pages.select("doc_id", "page_no", "y", F.posexplode(F.array(*map(F.lit, [100.0, 105.0, 107.0]))).alias("k", "at")).select("doc_id", "page_no", (F.col("k") + 1).alias("heading_no"), (F.col("y") + F.col("at")).alias("y"))
    notes = pages.select("doc_id", "page_no", "y", F.posexplode(F.array(*map(F.lit, [94.0, 103.0, 300.0]))).alias("note_no", "at"))
    text = F.concat(F.element_at(F.array(*map(F.lit, "abc")), F.col("note_no") + 1), F.col("page_no").cast("string"))
    return G.nearest_notes(heads, notes.select("doc_id", "page_no", "note_no", (F.col("y") + F.col("at")).alias("y"), text.alias("text")))


@query(f"""
WITH {LAYOUT_SQL}, toc AS (SELECT doc_id, page_no, line_no AS seq, 1 + line_no % 3 AS level, trim(substr(text, 1, 9)) AS title FROM layout)
SELECT l.doc_id, l.page_no, l.line_no, CAST(min_by(t.level, t.seq) AS INT) AS level FROM layout l JOIN toc t ON l.doc_id = t.doc_id AND l.page_no = t.page_no
 AND t.title <> '' AND (trim(regexp_replace(l.text, '\\s+', ' ', 'g')) = t.title OR (length(t.title) > 6 AND starts_with(trim(regexp_replace(l.text, '\\s+', ' ', 'g')), t.title))) GROUP BY ALL
""")
def toc_heading_join(spark, sf_dir):
    lines = _layout(spark, sf_dir)
    toc = lines.select("doc_id", "page_no", F.col("line_no").alias("seq"), (1 + F.col("line_no") % 3).alias("level"), F.trim(F.substring("text", 1, 9)).alias("title"))
    return G.toc_levels(lines, toc)


def _grid(spark, sf_dir):
    """Nations laid out in a grid: a row a region, a column for each fifth of the keys."""
    n = table(spark, sf_dir, "nation")
    r, c = F.col("n_regionkey"), F.floor(F.col("n_nationkey") / 5).cast("int")
    spans = n.select(F.lit("d").alias("doc_id"), F.lit(0).alias("page_no"), F.col("n_name").alias("text"), (60.0 + 100 * c).alias("x0"), (105.0 + 40 * r).alias("y0"), (120.0 + 100 * c).alias("x1"), (115.0 + 40 * r).alias("y1"))
    rules = [("d", 0, "h", 100.0 + 40 * k, 50.0, 550.0) for k in range(6)] + [("d", 0, "v", 50.0 + 100 * k, 100.0, 300.0) for k in range(6)] + [("d", 0, "h", 500.0, 0.0, 10.0), ("d", 0, "h", 101.0, 60.0, 560.0)]
    return spans, spark.createDataFrame(rules, "doc_id string, page_no int, orient string, pos double, lo double, hi double")


@query("""
WITH d AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, 2 + doc_id % 4 AS r, 2 + doc_id % 3 AS c, 50.0 + doc_id % 20 AS x, 100.0 + n_chars % 300 AS y FROM documents)
SELECT doc_id, CAST(0 AS INT) AS grid_no, list_transform(range(0, c + 1), lambda k: x + 100 * k)::DOUBLE[] AS xs, list_transform(range(0, r + 1), lambda k: y + 40 * k)::DOUBLE[] AS ys FROM d
""")
def find_grids(spark, sf_dir):
    """One grid a document, its size and place from the document's number and length, with a doubled and a stray rule."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id"), (2 + F.col("doc_id") % 4).alias("r"), (2 + F.col("doc_id") % 3).alias("c"), (50.0 + F.col("doc_id") % 20).alias("x"), (100.0 + F.col("n_chars") % 300).alias("y"))
    rule = lambda orient, pos, lo, hi: F.struct(F.lit(orient).alias("orient"), pos.cast("double").alias("pos"), lo.cast("double").alias("lo"), hi.cast("double").alias("hi"))
    right, foot = F.col("x") + 100 * F.col("c"), F.col("y") + 40 * F.col("r")
    rows = F.transform(F.sequence(F.lit(0).cast("long"), F.col("r")), lambda k: rule("h", F.col("y") + 40 * k, F.col("x"), right))
    columns = F.transform(F.sequence(F.lit(0).cast("long"), F.col("c")), lambda k: rule("v", F.col("x") + 100 * k, F.col("y"), foot))
    more = F.array(rule("h", F.col("y") + 1, F.col("x") + 10, right), rule("h", F.lit(790.0), F.lit(0.0), F.lit(10.0)))
    rules = d.select("doc_id", F.lit(0).alias("page_no"), F.explode(F.concat(rows, columns, more)).alias("q")).select("doc_id", "page_no", "q.*")
    return G.find_grids(rules).select("doc_id", "grid_no", "xs", "ys")


@query("""
SELECT CAST(n_regionkey AS INT) AS r, CAST(n_nationkey // 5 AS INT) AS c, string_agg(n_name, '' ORDER BY n_name) AS text FROM nation GROUP BY ALL
""")
def grid_cells(spark, sf_dir):
    spans, rules = _grid(spark, sf_dir)
    return G.grid_cells(G.inside(spans, G.find_grids(rules))).select("r", "c", "text")


def _nations(spark, sf_dir):
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    rows = F.array(F.array("r_name", F.lit(""), F.lit("a|b*")), F.array(F.lit(""), F.lit("  "), F.lit("")), F.array("n_name", F.col("n_regionkey").cast("string"), F.lit(" x  y <z> ")))
    return n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", rows.alias("rows"))


@query("""
SELECT n_nationkey, '| ' || replace(r_name, '_', '\\_') || ' | 열2 | a\\|b\\* |' || chr(10) || '| --- | --- | --- |' || chr(10) || '| ' || replace(n_name, '_', '\\_') || ' | ' || n_regionkey || ' | x y \\<z\\> |' AS md
FROM nation JOIN region ON n_regionkey = r_regionkey
""")
def table_markdown(spark, sf_dir):
    return _nations(spark, sf_dir).select("n_nationkey", R.table_markdown(F.col("rows")).alias("md"))


@query("""
SELECT n_nationkey, '<table>' || chr(10) || '  <tr><th>' || r_name || '</th><th></th><th>a|b*</th></tr>' || chr(10) || '  <tr><td>' || n_name || '</td><td>' || n_regionkey || '</td><td>x y &lt;z&gt;</td></tr>' || chr(10) || '</table>' AS html,
 '```' || chr(10) || r_name || chr(9) || chr(9) || 'a|b*' || chr(10) || n_name || chr(9) || n_regionkey || chr(9) || 'x y <z>' || chr(10) || '```' AS txt
FROM nation JOIN region ON n_regionkey = r_regionkey
""")
def table_html(spark, sf_dir):
    return _nations(spark, sf_dir).select("n_nationkey", R.table_html(F.col("rows")).alias("html"), R.table_text(F.col("rows")).alias("txt"))


#: element, box, place: a full-width title, two columns of three, a full-width foot
_BOXES = [(0, 50, 40, 550, 60, 0), (1, 50, 100, 270, 120, 1), (2, 320, 100, 550, 120, 4), (3, 50, 130, 270, 150, 2), (4, 320, 130, 550, 150, 5), (5, 50, 160, 270, 180, 3), (6, 320, 160, 550, 180, 6), (7, 50, 700, 550, 720, 7)]


@query(f"SELECT CAST(doc_id AS VARCHAR) AS doc_id, e AS elem_no, p AS place FROM documents, (VALUES {', '.join(f'({b[0]}, {b[5]})' for b in _BOXES)}) AS v(e, p)")
def gutter_split(spark, sf_dir):
    """Each document as a page of eight boxes, moved and narrowed by its number."""
    d = table(spark, sf_dir, "documents").select("doc_id", (F.col("doc_id") % 17).alias("dy"), (F.col("n_chars") % 9).alias("dx"))
    at = F.explode(F.array(*[F.array(*[F.lit(float(v)) for v in b[:5]]) for b in _BOXES])).alias("b")
    b = lambda k: F.col("b")[k]
    boxes = d.select("doc_id", "dx", "dy", at).select("doc_id", F.lit(0).alias("page_no"), b(0).cast("int").alias("elem_no"), (b(1) + F.col("dx")).alias("x0"), (b(2) + F.col("dy")).alias("y0"), b(3).alias("x1"), (b(4) + F.col("dy")).alias("y1"))
    return G.reading_order(boxes, 595.0).select("doc_id", "elem_no", "place")


@query("""
WITH g AS (SELECT p_partkey, CAST(generate_subscripts(c, 1) - 1 AS INT) AS seq, unnest(c) AS ch FROM (SELECT p_partkey, string_split(p_name, '') AS c FROM part)),
s AS (SELECT *, CASE WHEN regexp_matches(ch, '[aeiou]') THEN 'b' ELSE 'r' END AS style FROM g),
n AS (SELECT *, CASE WHEN seq = 0 OR style <> lag(style) OVER w OR seq % 7 = 0 THEN 1 ELSE 0 END AS new FROM s WINDOW w AS (PARTITION BY p_partkey ORDER BY seq)),
i AS (SELECT *, sum(new) OVER (PARTITION BY p_partkey ORDER BY seq) - 1 AS span_no FROM n)
SELECT CAST(p_partkey AS VARCHAR) AS doc_id, span_no::BIGINT AS span_no, string_agg(ch, '' ORDER BY seq) AS text, any_value(style) AS style FROM i GROUP BY p_partkey, span_no
""")
def glyph_spans(spark, sf_dir):
    """Names of parts as glyphs: vowels in another style, a wide gap after every seventh."""
    g = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("doc_id"), F.posexplode(F.split("p_name", "")).alias("seq", "ch"))
    x = 5.0 * F.col("seq") + 20.0 * F.floor(F.col("seq") / 7)
    style = F.when(F.col("ch").rlike("[aeiou]"), "b").otherwise("r")
    glyphs = g.select("doc_id", F.lit(0).alias("page_no"), F.lit(0).alias("line_no"), "seq", "ch", x.alias("x0"), (x + 5).alias("x1"), F.lit(10.0).alias("size"), style.alias("style"))
    return G.spans_to_lines(glyphs).select("doc_id", "span_no", "text", "style")


def _html_sql(c: str) -> str:
    return f"replace(replace(replace(replace({c}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;')"


_PLAIN = "translate(regexp_replace(url, '[^A-Za-z0-9:/.&?=-]', '', 'g'), '_*', '--')"


@query(f"""
WITH p AS (SELECT page_id, {_PLAIN} AS u FROM pages), e AS (SELECT page_id, u, {_html_sql("u")} AS h FROM p)
SELECT page_id, '<h2>Page ' || page_id || '</h2>' || chr(10) || '<p>see <a href="' || h || '" target="_blank" rel="noopener"><strong>' || h || '</strong></a><br>and <code>' || h || '</code></p>' || chr(10)
  || '<ul><li>' || h || '<ul><li><em>a</em></li></ul></li><li>b</li></ul>' || chr(10) || '<pre><code>' || h || chr(10) || '  **x**</code></pre>' || chr(10) || '<blockquote><p>' || h || '</p></blockquote>' || chr(10) || '<hr>' || chr(10)
  || '<table><thead><tr><th>u</th><th>n</th></tr></thead><tbody><tr><td>' || h || '</td><td>' || page_id || '</td></tr></tbody></table>' AS html FROM e
""")
def render_markdown_html(spark, sf_dir):
    u, n = F.regexp_replace("url", "[^A-Za-z0-9:/.&?=-]", ""), F.col("page_id").cast("string")
    md = F.format_string("## Page %s\n\nsee [**%s**](%s)\nand `%s`\n\n- %s\n  - *a*\n- b\n\n```\n%s\n  **x**\n```\n> %s\n\n---\n\n| u | n |\n|---|---|\n| %s | %s |\n", n, u, u, u, u, u, u, u, n)
    return table(spark, sf_dir, "pages").select("page_id", R.render_html(md).alias("html"))


@query("""
SELECT doc_id, regexp_replace(text, '\\n', chr(10) || chr(10), 'g') || concat_ws(chr(10), '', '', '- a', '- b', '1. c', '', 'd', '```', '', '', '', '- e', '', '- f', '```', '', 'g') AS tidy FROM documents
""")
def tidy_blank_lines(spark, sf_dir):
    """Text with blank lines, a list and a fence after it."""
    tail = F.lit("\n\n\n- a\n\n- b\n\n\n1. c\n\n\nd\n```\n\n\n\n- e\n\n- f\n```\n\n\n\ng")
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", R.tidy_markdown(F.concat(F.regexp_replace("text", "\n", "\n\n\n\n"), tail)).alias("tidy"))


@query()
def zip_bundle(spark, sf_dir):
    """A ZIP of the turns of each conversation."""
    d = table(spark, sf_dir, "conversations")
    files = d.select(F.col("conv_id").alias("bundle"), F.col("turn").alias("seq"), F.concat("role", F.lit(".md")).alias("name"), F.col("text").cast("binary").alias("content"))
    return R.zip_bundles(files).select("bundle", F.octet_length("content").alias("n_bytes"), F.sha2("content", 256).alias("digest"))


#: Colours of lines in turn: two near blues, grey, red, black.
_COLOURS = [0x1F4E9C, 0x2050A0, 0x808080, 0xD02020, 0]


#: Notes and raised numbers are line numbers here, of as many digits as the longest document needs.
_NOTE, _RAISED = "^s[A-Z]-[0-9]+$", "^[0-9]+$"


def _spans(spark, sf_dir):
    """Each line as spans: its text in a colour, a word, a small raised number, and on some lines a margin note."""
    lines = _layout(spark, sf_dir).withColumn("rgb", in_turn(F.col("doc_id") + F.col("line_no"), _COLOURS))
    span = lambda k, t, x, size, bold, rgb, rise: F.struct(F.lit(k).alias("span_no"), t.alias("text"), F.lit(x).alias("x0"), F.lit(size).alias("size"), F.lit(bold).alias("bold"), rgb.alias("rgb"), F.lit(rise).alias("rise"))
    black, n = F.lit(0), (F.col("line_no") + 1).cast("string")
    note = F.when(F.col("line_no") % 4 == 1, span(4, F.concat(F.lit("sE-"), n), 520.0, 10.0, False, black, 0.0))
    parts = F.array(span(0, F.rtrim("text"), 55.0, 10.0, False, F.col("rgb"), 0.0), span(1, F.lit(" 본문"), 60.0, 10.0, False, black, 0.0), span(2, F.lit("굵게 "), 70.0, 10.0, True, black, 0.0), span(3, n, 82.0, 6.5, False, black, 3.0), note)
    rows = lines.select("doc_id", "page_no", "line_no", "y0", F.explode(F.filter(parts, lambda s: s.isNotNull())).alias("s")).select("doc_id", "page_no", "line_no", "y0", "s.*")
    return rows.withColumn("x1", F.col("x0") + 5).withColumn("y1", F.col("y0") + 10).withColumn("origin_y", F.col("y0") + 8 - F.col("rise"))


_COLOURED = f"""
{LAYOUT_SQL}, {sql_rows("colours", "k, rgb", list(enumerate(_COLOURS)))},
c AS (SELECT doc_id, page_no, line_no, y0, rtrim(text) AS t, rgb FROM layout JOIN colours ON k = (doc_id + line_no) % {len(_COLOURS)}),
blue AS (SELECT doc_id, min_by(rgb, line_no) AS rep FROM c WHERE rgb IN ({_COLOURS[0]}, {_COLOURS[1]}) AND trim(t) <> '' GROUP BY doc_id)
"""


@query(f"""
WITH {_COLOURED}
SELECT doc_id, '#' || lpad(lower(to_hex(CASE WHEN rgb = {_COLOURS[3]} THEN rgb ELSE rep END)), 6, '0') AS hex, count(*) AS spans, sum(length(trim(t)))::BIGINT AS chars
FROM c LEFT JOIN blue USING (doc_id) WHERE rgb NOT IN (0, {_COLOURS[2]}) AND trim(t) <> '' GROUP BY ALL
""")
def palette_counts(spark, sf_dir):
    return L.palette_counts(_spans(spark, sf_dir)).select("doc_id", "hex", "spans", "chars")


@query(f"WITH {LAYOUT_SQL} SELECT doc_id, page_no, line_no AS note_no, 'sE-' || (line_no + 1) AS text, y0 AS y FROM layout WHERE line_no % 4 = 1")
def margin_notes(spark, sf_dir):
    return L.margin_notes(_spans(spark, sf_dir), 595.0, pattern=_NOTE)[1].select("doc_id", "page_no", "note_no", "text", "y")


@query(f"""
WITH {_COLOURED}, m AS (SELECT *, CASE WHEN rgb NOT IN (0, {_COLOURS[2]}) AND trim(t) <> '' THEN regexp_extract(t, '^(\\s*)', 1) || '==' || trim(t) || '==' WHEN trim(t) = '' THEN '' ELSE t END AS shown FROM c)
SELECT doc_id, page_no, line_no, shown || ' 본문**굵게** [^' || (line_no + 1) || ']' AS text, [line_no + 1]::INT[] AS sup_numbers, false AS bold FROM m
""")
def marked_lines(spark, sf_dir):
    spans = _spans(spark, sf_dir)
    kept, _ = L.margin_notes(spans, 595.0, pattern=_NOTE)
    return L.marked_lines(kept, spans.select("doc_id").distinct().withColumn("body_size", F.lit(10.0)), superscript=_RAISED).select("doc_id", "page_no", "line_no", "text", "sup_numbers", "bold")


@query(f"""
WITH {LAYOUT_SQL}, z AS (SELECT doc_id, page_no, line_no, x0, y0, CASE WHEN line_no % 4 = 3 AND length(text) % 2 = 0 THEN 'footnote' ELSE 'body' END AS zone FROM layout)
SELECT doc_id, page_no, line_no, CAST(row_number() OVER (PARTITION BY doc_id, page_no ORDER BY zone = 'footnote', y0, x0) - 1 AS INT) AS place FROM z
""")
def ordered_lines(spark, sf_dir):
    lines = _layout(spark, sf_dir).withColumn("zone", F.when((F.col("line_no") % 4 == 3) & (F.char_length("text") % 2 == 0), "footnote").otherwise("body"))
    return L.ordered_lines(lines, 595.0).select("doc_id", "page_no", "line_no", "place")
