"""Queries of document statistics, running text and paragraphs, on text tables with derived geometry."""

from __future__ import annotations

from pyspark.sql import functions as F

from quirelake.functions.text import content_hash
from quirelake.functions.unicode import fingerprint
from quirelake.operators import paragraphs as G
from quirelake.operators import running as R
from quirelake.operators import statistics as T
from quirelake.plans.base import LAYOUT_SQL, LINES_SQL, PAGE_HEIGHT, PAGE_WIDTH, in_turn, layout_lines, query, sql_rows, table
from quirelake.plans.text_queries import _BULLET2, _ORDERED2, _lines


def _layout(spark, sf_dir):
    return layout_lines(table(spark, sf_dir, "documents"))


_TALLY = """
tally AS (SELECT doc_id, floor(size * 10 + 0.5) / 10 AS size, sum(length(trim(text))) AS chars, min(line_no) AS first FROM layout WHERE length(trim(text)) > 0 GROUP BY ALL),
body AS (SELECT doc_id, size AS body_size FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY chars DESC, first) AS rn FROM tally) WHERE rn = 1)
"""


@query(f"WITH {LAYOUT_SQL}, {_TALLY} SELECT doc_id, body_size FROM body")
def weighted_body_size(spark, sf_dir):
    return T.body_size(T.size_tally(_layout(spark, sf_dir)))


@query(f"WITH {LAYOUT_SQL}, {_TALLY} SELECT doc_id, CAST(1 AS INT) AS level, size FROM tally JOIN body USING (doc_id) WHERE size >= body_size * 1.08 AND chars >= 3")
def heading_map(spark, sf_dir):
    return T.heading_map(T.size_tally(_layout(spark, sf_dir)))


@query(f"""
WITH {LAYOUT_SQL}, p AS (SELECT doc_id, page_no, row_number() OVER (PARTITION BY doc_id ORDER BY page_no) - 1 AS r, greatest(1, count(*) OVER (PARTITION BY doc_id) // 2) AS step FROM (SELECT DISTINCT doc_id, page_no FROM layout)),
t AS (SELECT doc_id, round_even((size + line_no % 5 * 0.13) * 2, 0) / 2 AS size, sum(length(trim(text))) AS chars, min(line_no) AS first FROM layout JOIN p USING (doc_id, page_no) WHERE r % step = 0 AND r < 2 * step AND length(trim(text)) > 0 GROUP BY ALL)
SELECT doc_id, size AS body_size FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY chars DESC, first) AS rn FROM t) WHERE rn = 1
""")
def sampled_body_size(spark, sf_dir):
    """By half points, over two pages a document."""
    lines = _layout(spark, sf_dir).withColumn("size", F.col("size") + F.col("line_no") % 5 * 0.13)
    return T.sampled_body_size(lines, 2)


# sizes of heading lines: by line, some so near that they are thinned out, one too rare to count
_SIZES = [20.0, 19.6, 19.4, 15.0, 14.8, 12.0, 10.5]


@query(f"""
WITH {LINES_SQL}, {sql_rows("sizes", "k, s", list(enumerate(_SIZES)))},
z AS (SELECT doc_id, line_no, text, CASE WHEN line_no % 2 = 0 AND line_no < 14 THEN s ELSE 10.0 END AS size FROM lines JOIN sizes ON k = (line_no // 2) % {len(_SIZES)}),
tally AS (SELECT doc_id, size, sum(length(trim(text))) AS chars, min(line_no) AS first FROM z WHERE length(trim(text)) > 0 GROUP BY ALL),
body AS (SELECT doc_id, size AS body_size FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY chars DESC, first) AS rn FROM tally) WHERE rn = 1),
big AS (SELECT doc_id, list(size ORDER BY size DESC) AS sizes FROM tally JOIN body USING (doc_id) WHERE size >= body_size * 1.08 AND chars >= 3 GROUP BY doc_id),
kept AS (SELECT doc_id, list_reduce(list_prepend([]::DOUBLE[], list_transform(sizes, lambda x: [x::DOUBLE])), lambda a, x: CASE WHEN len(a) = 0 OR a[-1] - x[1] >= 0.5 THEN a || x ELSE a END)[1:6] AS sizes FROM big)
SELECT doc_id, CAST(generate_subscripts(sizes, 1) AS INT) AS level, unnest(sizes) AS size FROM kept
""")
def heading_map_thinning(spark, sf_dir):
    k = (F.floor(F.col("line_no") / 2) % len(_SIZES)).cast("long")
    size = F.when((F.col("line_no") % 2 == 0) & (F.col("line_no") < 14), in_turn(k, _SIZES)).otherwise(10.0)
    return T.heading_map(T.size_tally(_lines(spark, sf_dir).withColumn("size", size)))


@query(f"""
WITH {LAYOUT_SQL} SELECT doc_id, page_no, coalesce(sum(length(trim(text)) * size) / nullif(sum(length(trim(text))), 0), 0) AS size FROM layout GROUP BY doc_id, page_no
""")
def line_size(spark, sf_dir):
    return T.line_sizes(_layout(spark, sf_dir), ["doc_id", "page_no"])


@query(f"""
WITH {LAYOUT_SQL}, {_TALLY},
x AS (SELECT doc_id, x0 AS x, count(*) AS n, greatest(4.0, any_value(body_size) * 0.5) AS tol FROM (SELECT doc_id, x0, CASE WHEN length(text) % 2 = 0 THEN '- ' || text ELSE text END AS text FROM layout) JOIN body USING (doc_id)
  WHERE regexp_matches(text, '{_BULLET2}') OR regexp_matches(text, '{_ORDERED2}') OR regexp_matches(text, '^\\s*[①-⑳㉑-㉟㊱-㊿]\\s*\\S') GROUP BY doc_id, x0),
c AS (SELECT *, sum(CASE WHEN coalesce(x - px, 1e9) > tol THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY x) AS c FROM (SELECT *, lag(x) OVER (PARTITION BY doc_id ORDER BY x) AS px FROM x)),
k AS (SELECT doc_id, c, sum(n) AS n, sum(x * n) / sum(n) AS x FROM c GROUP BY doc_id, c)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY c) AS INT) AS stop_no, x FROM k
""")
def indent_stops(spark, sf_dir):
    lines = _layout(spark, sf_dir)
    listed = lines.withColumn("text", F.when(F.char_length("text") % 2 == 0, F.concat(F.lit("- "), "text")).otherwise(F.col("text")))
    return T.indent_stops(listed, T.body_size(T.size_tally(lines)))


@query(f"""
WITH {LAYOUT_SQL} SELECT doc_id, page_no, CAST(CASE WHEN sum((x0 < 261.8 AND x1 > 333.2)::INT) <= count(*) * 0.08 AND sum((x1 <= 333.2)::INT) >= count(*) * 0.25
  AND sum((x0 >= 261.8)::INT) >= count(*) * 0.25 THEN 2 ELSE 1 END AS INT) AS columns
FROM (SELECT doc_id, page_no, x0 + CASE WHEN line_no % 2 = 1 THEN 280 ELSE 0 END AS x0, least(x1, x0 + 200) + CASE WHEN line_no % 2 = 1 THEN 280 ELSE 0 END AS x1 FROM layout) GROUP BY doc_id, page_no
""")
def two_columns(spark, sf_dir):
    shift = F.when(F.col("line_no") % 2 == 1, 280).otherwise(0)
    lines = _layout(spark, sf_dir).withColumn("x1", F.least(F.col("x1"), F.col("x0") + 200) + shift).withColumn("x0", F.col("x0") + shift)
    return T.two_columns(lines, PAGE_WIDTH, ["doc_id", "page_no"])


@query(f"""
WITH {LAYOUT_SQL}, p AS (SELECT doc_id, page_no, CASE WHEN count(*) % 2 = 0 THEN 2 ELSE 1 END AS columns FROM layout GROUP BY doc_id, page_no)
SELECT doc_id, CAST(columns AS INT) AS columns FROM (SELECT doc_id, columns, row_number() OVER (PARTITION BY doc_id ORDER BY count(*) DESC, min(page_no)) AS rn FROM p GROUP BY doc_id, columns) WHERE rn = 1
""")
def column_vote(spark, sf_dir):
    pages = _layout(spark, sf_dir).groupBy("doc_id", "page_no").agg(F.when(F.count(F.lit(1)) % 2 == 0, 2).otherwise(1).alias("columns"))
    return T.column_vote(pages)


@query("""
SELECT conv_id AS doc_id, count(*) AS pages, sum(length(text))::BIGINT AS chars, CASE WHEN sum((trim(text) <> '')::INT) = 0 OR sum(length(text)) / count(*) < 40 THEN 'scanned' ELSE 'text' END AS layer
FROM conversations GROUP BY conv_id
""")
def text_layer_class(spark, sf_dir):
    from quirelake.sources.text import conversation_pages

    return T.text_layer(conversation_pages(table(spark, sf_dir, "conversations")))


@query(f"""
WITH {LAYOUT_SQL} SELECT doc_id, page_no, line_no, CAST(row_number() OVER (PARTITION BY doc_id, page_no ORDER BY floor((842 - y0) * 10 + 0.5), floor(x0 * 10 + 0.5), line_no) AS INT) AS place FROM layout
""")
def reading_order_single(spark, sf_dir):
    lines = _layout(spark, sf_dir).withColumn("y0", 842.0 - F.col("y0"))
    return T.reading_order(lines, ["doc_id", "page_no"]).select("doc_id", "page_no", "line_no", "place")


def _with_fp(spark, sf_dir):
    """Layout lines whose first line in each page of every tenth document carries a running head."""
    lines = _layout(spark, sf_dir)
    head = (F.col("doc_id") % 3 == 0) & (F.col("line_no") % 4 == 0)
    foot = (F.col("doc_id") % 3 == 1) & (F.col("line_no") % 4 == 3)
    lines = lines.withColumn("text", F.when(head, F.concat(F.lit("Annual Report "), F.col("page_no").cast("string"))).when(foot, F.concat(F.lit("- "), F.col("page_no").cast("string"), F.lit(" -"))).otherwise(F.col("text")))
    return lines.withColumn("fp", fingerprint(F.col("text")))


def running_sql(marked: str) -> str:
    """Common tables of running text and of what is left, of lines whose text is what the expression says."""
    return f"""
{LAYOUT_SQL},
marked AS (SELECT * REPLACE ({marked} AS text) FROM layout),
fps AS (SELECT *, lower(regexp_replace(regexp_replace(text, '[0-9]+', '#', 'g'), '\\s+', '', 'g')) AS fp FROM marked),
n AS (SELECT doc_id, max(page_no) + 1 AS pages FROM fps GROUP BY doc_id),
running AS (SELECT doc_id, fp FROM fps JOIN n USING (doc_id) WHERE (y1 <= 84.2 OR y0 >= 757.8) AND length(text) BETWEEN 1 AND 120 AND fp <> '' AND pages >= 3
  GROUP BY doc_id, fp HAVING count(DISTINCT page_no) >= greatest(2, ceil(any_value(pages) / 2.0))),
tally AS (SELECT doc_id, size, sum(length(trim(text))) AS chars, min(line_no) AS first FROM marked WHERE length(trim(text)) > 0 GROUP BY ALL),
body AS (SELECT doc_id, size AS body_size FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY chars DESC, first) AS rn FROM tally) WHERE rn = 1),
near AS (SELECT f.* FROM fps f JOIN running USING (doc_id, fp) JOIN body USING (doc_id) WHERE (y1 <= 84.2 OR y0 >= 757.8) AND size <= body_size + 0.3
  AND NOT (regexp_matches(text, '[.。]$') AND NOT regexp_matches(text, '^[-–—\\s0-9./()]+$'))),
gone AS (SELECT doc_id, line_no FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, page_no, y1 <= 84.2) AS k FROM near) WHERE k <= 2),
left_over AS (SELECT doc_id, page_no, line_no, text, size, x0 FROM fps ANTI JOIN gone USING (doc_id, line_no)
  WHERE NOT ((y1 < 67.36 OR y0 > 774.64) AND regexp_matches(trim(text), '^[-–—\\s]*[0-9]{{1,4}}\\s*(?:/\\s*[0-9]{{1,4}})?[-–—\\s]*$')))
"""


_FP = running_sql("CASE WHEN doc_id % 3 = 0 AND line_no % 4 = 0 THEN 'Annual Report ' || page_no WHEN doc_id % 3 = 1 AND line_no % 4 = 3 THEN '- ' || page_no || ' -' ELSE text END")


@query(f"WITH {_FP} SELECT doc_id, fp FROM running")
def running_text(spark, sf_dir):
    return R.running_text(_with_fp(spark, sf_dir), PAGE_HEIGHT)


@query(f"WITH {_FP} SELECT doc_id, line_no, text FROM left_over")
def strip_running(spark, sf_dir):
    lines = _with_fp(spark, sf_dir)
    return R.strip_running(lines, T.body_size(T.size_tally(lines)), PAGE_HEIGHT).select("doc_id", "line_no", "text")


@query(f"""
WITH {LAYOUT_SQL},
m AS (SELECT * REPLACE (CASE WHEN doc_id % 4 = 0 AND line_no = 5 THEN '<< 안 내 >>' ELSE text END AS text) FROM layout),
cut AS (SELECT doc_id, min(line_no) AS cut_no FROM m WHERE text = '<< 안 내 >>' GROUP BY doc_id)
SELECT doc_id, line_no FROM m LEFT JOIN cut USING (doc_id) WHERE cut_no IS NULL OR line_no < cut_no
""")
def notice_trim(spark, sf_dir):
    lines = _layout(spark, sf_dir).withColumn("text", F.when((F.col("doc_id") % 4 == 0) & (F.col("line_no") == 5), "<< 안 내 >>").otherwise(F.col("text")))
    return R.trim_notice(lines).select("doc_id", "line_no")


def _images(spark, sf_dir):
    """Two images a page of a host, which is the document: the whole page, and the host's logo."""
    p = table(spark, sf_dir, "pages").withColumn("doc_id", F.regexp_extract("url", "//([^/?#]+)", 1))
    data = F.explode(F.array(F.struct(F.lit(0).alias("img_no"), F.col("html").alias("data")), F.struct(F.lit(1).alias("img_no"), F.concat(F.lit("logo of "), "doc_id").alias("data"))))
    p = p.select("doc_id", F.col("page_id").cast("int").alias("page_no"), data.alias("d"))
    return p.select("doc_id", "page_no", "d.img_no", F.lit(10.0).alias("y0"), F.lit(40.0).alias("y1"), content_hash(F.col("d.data").cast("binary")).alias("hash"))


_IMG = """
p AS (SELECT regexp_extract(url, '//([^/?#]+)', 1) AS doc_id, CAST(page_id AS INT) AS page_no, html FROM pages),
data AS (SELECT doc_id, page_no, 0 AS img_no, html AS data FROM p UNION ALL SELECT doc_id, page_no, 1, 'logo of ' || doc_id FROM p),
img AS (SELECT doc_id, page_no, img_no, octet_length(encode(data)) || '-' || sha256(data) AS hash FROM data)
"""


@query(f"""
WITH {_IMG}, n AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY page_no, img_no) AS n FROM img), f AS (SELECT doc_id, hash, min(n) AS k, min(page_no) AS p FROM n GROUP BY doc_id, hash)
SELECT doc_id, hash, page_no, CAST(n AS INT) AS n, 'document.assets/document-p' || (p + 1) || '-' || k || '.png' AS path FROM n JOIN f USING (doc_id, hash)
""")
def image_dedupe(spark, sf_dir):
    return R.dedupe_images(_images(spark, sf_dir)).select("doc_id", "hash", "page_no", "n", "path")


@query(f"""
WITH {_IMG}, c AS (SELECT doc_id, count(DISTINCT page_no) AS pages FROM img GROUP BY doc_id)
SELECT doc_id, hash FROM img JOIN c USING (doc_id) WHERE pages >= 2 GROUP BY doc_id, hash HAVING count(DISTINCT page_no) >= greatest(2, ceil(any_value(pages) / 2.0))
""")
def running_images(spark, sf_dir):
    images = _images(spark, sf_dir)
    counts = images.groupBy("doc_id").agg(F.countDistinct("page_no").alias("pages"))
    return R.running_images(images, counts, PAGE_HEIGHT)


_PARA = f"""
{LINES_SQL},
b AS (SELECT *, lag(text) OVER (PARTITION BY doc_id ORDER BY line_no) AS last FROM lines),
i AS (SELECT *, sum((last IS NULL OR trim(last) = '' OR regexp_matches(last, '([.?!]|[」』’”)])\\s*$'))::INT) OVER (PARTITION BY doc_id ORDER BY line_no) - 1 AS para FROM b),
para AS (SELECT doc_id, CAST(para AS INT) AS para, CAST(count(*) AS INT) AS n_lines, string_agg(rtrim(text), ' ' ORDER BY line_no) AS text FROM i WHERE trim(text) <> '' GROUP BY doc_id, para)
"""


@query(f"WITH {_PARA} SELECT * FROM para")
def doc_paragraphs(spark, sf_dir):
    return G.paragraphs(_lines(spark, sf_dir), ["doc_id"])


@query(f"WITH {_PARA} SELECT doc_id, regexp_replace(string_agg(text, chr(10) || chr(10) ORDER BY para), '\\s+$', '') || chr(10) AS markdown FROM para GROUP BY doc_id")
def rendered_paragraphs(spark, sf_dir):
    return G.render_blocks(doc_paragraphs(spark, sf_dir), ["doc_id"], "para")


@query(f"WITH {_PARA} SELECT doc_id, count(*) AS paragraphs, sum(n_lines)::BIGINT AS n_lines, sum(length(text))::BIGINT AS chars, max(length(text)) AS longest FROM para GROUP BY doc_id")
def doc_stats(spark, sf_dir):
    p = doc_paragraphs(spark, sf_dir)
    return p.groupBy("doc_id").agg(F.count(F.lit(1)).alias("paragraphs"), F.sum("n_lines").alias("n_lines"), F.sum(F.char_length("text")).alias("chars"), F.max(F.char_length("text")).cast("long").alias("longest"))


@query(f"""
WITH {LINES_SQL}, l AS (SELECT doc_id, line_no, rtrim(text) AS t FROM lines)
SELECT doc_id, line_no, mode, CASE mode WHEN 'space' THEN t || 'national 91다43695 漢 字' WHEN 'none' THEN t || 'national 91다43695 漢字' WHEN 'break' THEN concat_ws(chr(10), t || '-', 'national', '91다', '43695', '漢', '字')
  ELSE t || 'national 91다 43695 漢字' END AS text FROM l, (VALUES ('space'), ('none'), ('break'), ('layout')) AS m(mode)
""")
def join_hyphens(spark, sf_dir):
    rest = ["national", "91다", "43695", "漢", "字"]
    lines = _lines(spark, sf_dir).withColumn("l", F.array(F.concat("text", F.lit("-")), *map(F.lit, rest))).withColumn("mode", F.explode(F.array(*map(F.lit, ["space", "none", "break", "layout"]))))
    text = F.when(F.col("mode") == "layout", G.join_layout_lines(F.col("l")))
    for mode in ("space", "none", "break"):
        text = text.when(F.col("mode") == mode, G.join_lines(F.col("l"), mode))
    return lines.select("doc_id", "line_no", "mode", text.alias("text"))
