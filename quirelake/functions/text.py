"""String functions as Column expressions; all stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quirelake.functions import patterns as P

WS = r"[\s\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]"


def collapse_ws(t: Column) -> Column:
    """White space of any kind to one space, trimmed."""
    return F.trim(F.regexp_replace(t, WS + "+", " "))


def escape_md(t: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(t, r"\\", r"\\\\"), r"([*_`\[\]<>])", r"\\$1")


def escape_leading(t: Column) -> Column:
    """Keep a paragraph's start from being read as a list, heading, quote or table."""
    number = r"^(\s*)([0-9]{1,9})([.)]\s)"
    return F.when(t.rlike(number), F.regexp_replace(t, number, r"$1$2\\$3")).otherwise(F.regexp_replace(t, r"^(\s*)([#>|]|[-+*](?=\s))", r"$1\\$2"))


def strip_outer_emphasis(t: Column) -> Column:
    out = t
    for mark in ("*", "**", "***"):
        n = len(mark)
        inner = F.substring(t, F.lit(n + 1), F.greatest(F.char_length(t) - 2 * n, F.lit(0)))
        out = F.when((F.char_length(t) > 2 * n) & t.startswith(mark) & t.endswith(mark) & ~inner.contains(mark), inner).otherwise(out)
    return out


def yaml_string(t: Column) -> Column:
    t = F.replace(F.replace(t, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    return F.concat(F.lit('"'), collapse_ws(F.regexp_replace(t, r"[\x00-\x1f\x7f]", " ")), F.lit('"'))


def quote(t: Column) -> Column:
    """Quoted, with backslash and quote escaped and nothing else."""
    return F.concat(F.lit('"'), F.replace(F.replace(t, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))


def html_escape(t: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        t = F.replace(t, F.lit(a), F.lit(b))
    return t


def _balanced(t: Column) -> Column:
    """Round brackets nest: depth never falls under 0 and ends at 0."""
    signs = F.split(F.regexp_replace(t, r"[^()]", ""), "")
    depth = F.aggregate(signs, F.lit(0), lambda a, c: F.when(a < 0, a).when(c == "(", a + 1).when(c == ")", a - 1).otherwise(a))
    return depth == 0


def md_url(t: Column) -> Column:
    """A link target that Markdown reads as one: control characters and spaces percent-encoded,
    angle brackets too, round brackets if they don't nest."""
    out = t
    for code in [*range(0x21), 0x7F]:
        out = F.replace(out, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    out = F.replace(F.replace(out, F.lit("<"), F.lit("%3C")), F.lit(">"), F.lit("%3E"))
    return F.when(_balanced(out), out).otherwise(F.replace(F.replace(out, F.lit("("), F.lit("%28")), F.lit(")"), F.lit("%29")))


def safe_url(t: Column) -> Column:
    """A link target without a scheme or with one that is harmless; else '#'."""
    u = F.trim(F.coalesce(t, F.lit("")))
    return F.when(u.rlike("(?i)^[a-z][a-z0-9+.-]*:") & ~u.rlike("(?i)^(https?|mailto|tel):"), F.lit("#")).otherwise(u)


def safe_image_url(t: Column) -> Column:
    u = F.trim(F.coalesce(t, F.lit("")))
    bad = u.rlike("(?i)^[a-z][a-z0-9+.-]*:") & ~u.rlike("(?i)^https?:") & ~u.rlike("(?i)^data:image/")
    return F.when(bad, F.lit("")).otherwise(u)


def safe_stem(name: Column) -> Column:
    stem = F.coalesce(F.nullif(F.regexp_replace(name, r"(?i)\.pdf$", ""), F.lit("")), F.lit("document"))
    stem = F.regexp_replace(F.regexp_replace(stem, rf"[^A-Za-z0-9_\-.{P.HANGUL}]+", "_"), r"^_+|_+$", "")
    return F.coalesce(F.nullif(stem, F.lit("")), F.lit("document"))


def part_stem(title: Column) -> Column:
    return F.substring(F.regexp_replace(title, r"(?U)[^\w]+", ""), 1, 40)


def human_size(n: Column) -> Column:
    return (
        F.when(n < 1024, F.concat(n.cast("string"), F.lit(" B")))
        .when(n < 1024 * 1024, F.concat(F.floor(n / 1024 + 0.5).cast("string"), F.lit(" KB")))
        .otherwise(F.concat(F.format_string("%.1f", n / (1024.0 * 1024.0)), F.lit(" MB")))
    )


def list_marker(t: Column) -> Column:
    """struct(bullet, marker, rest) of a list item, null for other text."""
    digits = F.regexp_replace(F.regexp_extract(t, P.ORDERED, 1), "[^0-9]", "")
    return (
        F.when(t.rlike(P.BULLET), F.struct(F.lit("-").alias("bullet"), F.regexp_extract(t, P.BULLET, 1).alias("marker"), F.regexp_replace(t, P.BULLET, "").alias("rest")))
        .when(t.rlike(P.ORDERED), F.struct(F.when(digits == "", "1.").otherwise(F.concat(digits, F.lit("."))).alias("bullet"), F.regexp_extract(t, P.ORDERED, 1).alias("marker"), F.regexp_replace(t, P.ORDERED, "").alias("rest")))
        .when(t.rlike(P.CIRCLED), F.struct(F.lit("-").alias("bullet"), F.lit("").alias("marker"), t.alias("rest")))
    )


def looks_like_list(t: Column) -> Column:
    return t.rlike(P.BULLET) | t.rlike(P.ORDERED) | t.rlike(P.CIRCLED)


def plain_title(t: Column) -> Column:
    t = F.regexp_replace(F.regexp_replace(t, "`[^`]*`", ""), "[*=]{2}", "")
    return F.trim(F.regexp_replace(t, r"(?U)\s{2,}", " "))


def strip_markup(t: Column) -> Column:
    return F.regexp_replace(t, r"`|={2}|\*{2}", "")


def topic(t: Column) -> Column:
    inside = F.regexp_extract(t, r"\[([^\]]+)\]", 1)
    return F.when(inside != "", F.split_part(inside, F.lit("-"), F.lit(1))).otherwise(F.substring(F.regexp_replace(t, r"^[A-Z]-[0-9]+\.\s*", ""), 1, 20))


def exam_years(t: Column, century: int = 50) -> Column:
    two = F.transform(F.regexp_extract_all(t, F.lit(r"\(([0-9]{2})\)"), F.lit(1)), lambda y: y.cast("int"))
    return F.transform(two, lambda y: y + F.when(y >= century, 1900).otherwise(2000))


def without_exam_years(t: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(t, r"\(([0-9]{2})\)", ""), r"(?U)\s{2,}", " "))


def split_score(t: Column, limit: float = 50.0, allow_bare: bool = False, pattern: str = P.SCORE) -> Column:
    """struct(score, head): points at the end of a title; a null score if there are none."""
    rx = "(?U)" + pattern
    score = F.regexp_extract(t, rx, 1)
    head = F.rtrim(F.regexp_replace(F.regexp_replace(t, rx, ""), r"[ .·\-—]+$", ""))
    good = t.rlike(rx) & (F.coalesce(score.try_cast("double"), F.lit(1e9)) <= limit)
    if not allow_bare:
        good = good & (head != "")
    return F.struct(F.when(good, score).alias("score"), F.when(good, head).otherwise(t).alias("head"))


def context_of(t: Column, start: Column, length: Column, width: int = 30) -> Column:
    """…left〖hit〗right… around a hit; start counts from 1."""
    left = F.substring(t, F.greatest(start - width, F.lit(1)), F.least(F.lit(width), start - 1))
    return F.concat(F.lit("…"), left, F.lit("〖"), F.substring(t, start, length), F.lit("〗"), F.substring(t, start + length, F.lit(width)), F.lit("…"))


def placed_matches(t: Column, pattern: str) -> Column:
    """array<struct<at, hit>> of all matches of a pattern with their places, from 1."""
    pieces, hits = F.split(t, pattern, -1), F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
    both = F.array(F.struct(F.transform(pieces, lambda p: F.char_length(p)).alias("p"), hits.alias("h")))

    def placed(x: Column) -> Column:
        add = lambda a, n: a + n
        return F.transform(x["h"], lambda h, i: F.struct((F.aggregate(F.slice(x["p"], F.lit(1), i + 1), F.lit(1), add) + F.char_length(F.array_join(F.slice(x["h"], F.lit(1), i), ""))).alias("at"), h.alias("hit")))

    return F.get(F.transform(both, lambda x: placed(x)), F.lit(0))


def blockquote(t: Column) -> Column:
    return F.regexp_replace(t, "(?m)^", "> ")


def rgb_parts(v: Column) -> Column:
    return F.array(*[F.shiftright(v, s).bitwiseAND(F.lit(255)) for s in (16, 8, 0)])


def to_hex(v: Column) -> Column:
    return F.concat(F.lit("#"), F.lower(F.lpad(F.hex(v.cast("long")), 6, "0")))


def is_body_colour(v: Column, gray_span: int = 24, black_max: int = 90) -> Column:
    parts = rgb_parts(v)
    return (F.array_max(parts) - F.array_min(parts) <= gray_span) | (F.array_max(parts) <= black_max)


def content_hash(data: Column) -> Column:
    """Length and SHA-256: only equality of hashes is ever used."""
    return F.concat(F.octet_length(data).cast("string"), F.lit("-"), F.sha2(data, 256))


def overlap_ratio(a: tuple, b: tuple) -> Column:
    """Share of box a (x0, y0, x1, y1) that box b covers."""
    ix = F.greatest(F.lit(0.0), F.least(a[2], b[2]) - F.greatest(a[0], b[0]))
    iy = F.greatest(F.lit(0.0), F.least(a[3], b[3]) - F.greatest(a[1], b[1]))
    return ix * iy / F.greatest((a[2] - a[0]) * (a[3] - a[1]), F.lit(1e-6))


def indent_level(x0: Column, stops: Column) -> Column:
    """Index of the nearest indent stop, the first of equals, at most 4; 0 without stops."""
    away = F.transform(stops, lambda s: F.abs(s - x0))
    return F.when(F.size(stops) > 0, F.least(F.lit(4), (F.array_position(away, F.array_min(away)) - 1).cast("int"))).otherwise(F.lit(0))
