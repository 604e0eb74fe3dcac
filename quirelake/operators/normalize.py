"""Rule-driven repair of what extraction broke, with a log of changes.

A line goes through fixed steps in the JVM. A step that is to be logged cuts the line at all matches of one pattern, mends
each match, logs what it mended with its place, and puts the line together again, so that each fix is one entry. Lines without
a sign of a step's matches skip it. Steps never change meaning: no spelling, no wording.

Cases: a null text is blank; blank lines, and lines that are left blank, go. The log of a line without changes is an empty array.
An empty table gives no rows. Other columns stay; a column `changes` is replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirelake.functions import patterns as P
from quirelake.functions.patterns import Rules
from quirelake.functions.text import context_of
from quirelake.functions.unicode import nfc

CHANGE = "struct<kind: string, before: string, after: string, context: string>"
_FULL = "".join(chr(c) for c in range(0xFF01, 0xFF5F) if chr(c - 0xFEE0).isalnum())
_HALF = "".join(chr(ord(c) - 0xFEE0) for c in _FULL)


def widths(t: Column) -> Column:
    """Full-width letters and digits to ASCII, ideographic space to space, full-width square brackets."""
    return F.when(t.rlike("[\\x{3000}\\x{ff01}-\\x{ff5e}]"), F.translate(t, _FULL + "　［］", _HALF + " []")).otherwise(t)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once."""
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))


def _entry(kind: str, before: Column, after: Column, context: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), before.alias("before"), after.alias("after"), context.alias("context"))


def _line(text: Column, changes: Column) -> Column:
    return F.struct(text.alias("t"), changes.alias("c"))


def _mended(s: Column, pattern: str, mend: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """The line s (t, c) with every match of pattern mended. mend(match, its place from 1) gives its new text and its entries, of which
    null ones don't count."""
    t = s["t"]

    def joined(pieces: Column, hits: Column) -> Column:
        def one(hit: Column, i: Column) -> Column:
            ahead = F.array_join(F.slice(pieces, F.lit(1), i + 1), "")
            at = F.char_length(ahead) + F.char_length(F.array_join(F.slice(hits, F.lit(1), i), "")) + 1
            text, entries = mend(hit, at)
            return F.struct(text.alias("text"), F.filter(entries, lambda e: e.isNotNull()).alias("entries"))

        def whole(made: Column) -> Column:
            rest = F.transform(made, lambda m, i: F.concat(m["text"], F.get(pieces, i + 1)))
            return _line(F.concat(F.get(pieces, F.lit(0)), F.array_join(rest, "")), F.concat(s["c"], F.flatten(F.transform(made, lambda m: m["entries"]))))

        return _let(F.transform(hits, one), whole)

    return _let(F.split(t, pattern, -1), lambda pieces: _let(F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), lambda hits: joined(pieces, hits)))


def mnemonic_brackets(s: Column, rules: Rules) -> Column:
    """Other brackets around a valid mnemonic to square ones; what is inside stays."""
    pairs = "|".join(f"{P.literal(a)}{rules.valid_body}{P.literal(b)}" for a, b in P.MNEMONIC_PAIRS)

    def mend(hit: Column, at: Column) -> tuple[Column, Column]:
        text = F.concat(F.lit("["), F.substring(hit, F.lit(2), F.char_length(hit) - 2), F.lit("]"))
        return text, F.array(_entry("mnemonic", hit, text, context_of(s["t"], at, F.char_length(hit))))

    return _mended(s, f"(?U)(?:{pairs})(?![(:])", mend)


def noise(s: Column) -> Column:
    """Strings that are never text, then single characters that stand alone between spaces; one entry for each kind, at its first place."""
    strings = [(P.literal(t), t) for t in sorted(P.NOISE_STRINGS, key=lambda t: -len(t))]
    tokens = [(rf"(?U){P.literal(t)}(?<=\s{P.literal(t)})(?=\s)", t) for t in sorted(P.NOISE_TOKENS)]

    def without(s: Column, pattern: str, token: str) -> Column:
        at = F.char_length(F.get(F.split(s["t"], pattern, 2), F.lit(0))) + 1
        entry = _entry("noise", F.lit(token), F.lit(""), context_of(s["t"], at, F.lit(len(token))))
        return F.when(s["t"].rlike(pattern), _line(F.regexp_replace(s["t"], pattern, ""), F.concat(s["c"], F.array(entry)))).otherwise(s)

    def steps(s: Column, left: list[tuple[str, str]]) -> Column:
        return _let(without(s, *left[0]), lambda x: steps(x, left[1:])) if left else s

    return steps(s, strings + tokens)


def case_numbers(s: Column, rules: Rules) -> Column:
    """Case numbers without spaces, in round brackets, with an ASCII star right after them."""
    opens, closes = (P.char_class([c for c in chars if c not in "()"]) for chars in (P.OPEN_BRACKETS, P.CLOSE_BRACKETS))
    number = rules.case_loose.removeprefix("(?U)")
    whole = f"(?U)(?:({opens})( *))?{number}(\\s*{P.char_class(rules.stars)})?(\\s*{closes})?"

    def mend(hit: Column, at: Column) -> tuple[Column, Column]:
        part = lambda k: F.regexp_extract(hit, whole, k)

        def told(g: Column) -> Column:
            bracket, gap, fixed, star, close, raw = (g[k] for k in ("open", "gap", "fixed", "star", "close", "raw"))
            context = context_of(s["t"], at + F.char_length(bracket) + F.char_length(gap), F.char_length(raw))
            opened = F.when(bracket != "", F.lit("(")).otherwise("")
            closed, starred = F.when(close != "", F.lit(")")).otherwise(""), F.when(star != "", F.lit("*")).otherwise("")
            entries = F.array(
                F.when(raw != fixed, _entry("space", raw, fixed, context)), F.when(bracket != "", _entry("bracket", F.concat(bracket, raw), F.concat(F.lit("("), fixed), context)),
                F.when((star != "") & (star != "*"), _entry("star", F.concat(fixed, star), F.concat(fixed, F.lit("*")), context)), F.when(close != "", _entry("bracket", F.concat(fixed, close), F.concat(fixed, F.lit(")")), context)),
            )
            return F.struct(F.concat(opened, gap, fixed, starred, closed).alias("text"), entries.alias("entries"))

        raw = F.regexp_extract(hit, rules.case_loose, 0)
        groups = F.struct(part(1).alias("open"), part(2).alias("gap"), F.concat(part(3), part(4), part(5)).alias("fixed"), part(6).alias("star"), part(7).alias("close"), raw.alias("raw"))
        made = _let(groups, told)
        return made["text"], made["entries"]

    return _mended(s, whole, mend)


def articles(t: Column) -> Column:
    return F.when(t.rlike("제"), F.regexp_replace(t, P.ARTICLE, "제$1$2")).otherwise(t)


def dates(s: Column, rules: Rules) -> Column:
    """YYYY. M. D.; characters that no text has right after a date go, Hangul right after one that has no last dot stays
    unless the rules say strip."""
    junk = f"(?:[{''.join(P.literal(c) for c in P.NOISE_TOKENS)}\\]°｣¤]|{P.NOISE_CLASS})*"
    whole = f"(?U)({P.DATE})({junk})([{P.HANGUL}]*)"
    strip = F.lit(rules.date_hangul == "strip")

    def mend(hit: Column, at: Column) -> tuple[Column, Column]:
        part = lambda k: F.regexp_extract(hit, whole, k)

        def told(g: Column) -> Column:
            date, canon, junk = g["date"], g["canon"], g["junk"]
            tail = F.when(date.endswith("."), "").otherwise(g["hangul"])  # what the log counts to the date
            rest = F.when(strip & (tail != ""), "").otherwise(g["hangul"])
            shown = F.concat(canon, F.when(strip, "").otherwise(tail))
            entry = F.when((junk != "") | (tail != "") | (canon != date), _entry("date", F.concat(date, junk, tail), shown, context_of(s["t"], at, F.char_length(date))))
            return F.struct(F.concat(canon, rest).alias("text"), F.array(entry).alias("entries"))

        dot = lambda k: F.concat(part(k).cast("int").cast("string"), F.lit("."))
        canon = F.concat(part(2), F.lit(". "), dot(3), F.lit(" "), dot(4))
        made = _let(F.struct(part(1).alias("date"), canon.alias("canon"), part(5).alias("junk"), part(6).alias("hangul")), told)
        return made["text"], made["entries"]

    return _mended(s, whole, mend)


def collapse(t: Column) -> Column:
    return F.trim(F.regexp_replace(t, r"[ \t\x{a0}]+", " "))


def repaired(text: Column, rules: Rules = P.TEXTBOOK) -> Column:
    """struct<t, c>: the repaired text of a line, and its changes in order of steps and places."""
    steps = [
        (P.char_class([a for a, _ in P.MNEMONIC_PAIRS]), lambda s: mnemonic_brackets(s, rules)), (P.char_class(sorted({t[0] for t in (*P.NOISE_STRINGS, *P.NOISE_TOKENS)})), noise),
        (f"(?U)[0-9]\\s*(?:{rules.suffixes})\\s*[0-9]", lambda s: case_numbers(s, rules)), ("제", lambda s: _line(articles(s["t"]), s["c"])), ("[0-9]{4}\\.", lambda s: dates(s, rules)),
    ]

    def after(s: Column, left: list) -> Column:
        if not left:
            return _line(collapse(s["t"]), s["c"])
        hint, step = left[0]
        # the hint is a cheap test that most lines fail
        return _let(F.when(s["t"].rlike(hint), step(s)).otherwise(s), lambda x: after(x, left[1:]))

    none = F.array().cast(f"array<{CHANGE}>")
    # a line without any hint is left as it is by all steps
    some = "|".join(f"(?:{hint})" for hint, _ in steps)
    # in ASCII only a brace or a date can be one, and a case number if a suffix is ASCII
    ascii_hints = "[{]|[0-9]{4}\\." + (f"|(?:{steps[2][0]})" if any(x.isascii() for x in rules.case_suffixes) else "")
    # below U+0100 also a noise character, and a case number if a suffix is
    latin = "".join(sorted({t[0] for t in (*P.NOISE_STRINGS, *P.NOISE_TOKENS) if t[0] < "\u0100"}))
    latin_hints = f"[{{{latin}]|[0-9]{{4}}\\." + (f"|(?:{steps[2][0]})" if any(min(x) < "\u0100" for x in rules.case_suffixes) else "")
    hinted = lambda t: F.when(F.octet_length(t) == F.char_length(t), t.rlike(ascii_hints)).when(~t.rlike("[^\\x00-\\xff]"), t.rlike(latin_hints)).otherwise(t.rlike(some))
    text = widths(nfc(F.coalesce(text, F.lit(""))))
    return _let(text, lambda t: F.when(hinted(t), _let(_line(t, none), lambda s: after(s, steps))).otherwise(_line(collapse(t), none)))


def normalize_lines(lines: DataFrame, rules: Rules = P.TEXTBOOK, *, text_col: str = "text", log: bool = True) -> DataFrame:
    """lines with text repaired and, if log, changes: array of struct<kind, before, after, context>, one for each
    fix, in order. Lines that are left blank go."""
    # exploding an array of one line or none drops blank lines without making the text twice, as a filter that is pushed down would
    kept = F.filter(F.array(repaired(F.col(text_col), rules)), lambda s: s["t"] != "")
    out = lines.withColumn("__line", F.explode(kept)).withColumn(text_col, F.col("__line.t"))
    return (out.withColumn("changes", F.col("__line.c")) if log else out).drop("__line")


def change_log(normalized: DataFrame, keys: list[str]) -> DataFrame:
    """One row a change: the keys, seq, kind, before, after, context."""
    return normalized.select(*keys, F.posexplode("changes").alias("seq", "c")).select(*keys, "seq", "c.kind", "c.before", "c.after", "c.context")


# -- entities -------------------------------------------------------------------------


def find_mnemonics(t: Column, rules: Rules = P.TEXTBOOK) -> Column:
    return F.regexp_extract_all(t, F.lit(rules.mnemonic), F.lit(1))


def find_cases(t: Column, rules: Rules = P.TEXTBOOK) -> Column:
    return F.regexp_extract_all(t, F.lit(rules.case), F.lit(0))


def case_problems(case: Column, rules: Rules = P.TEXTBOOK) -> Column:
    """Reasons why a case number is wrong; empty if it is right."""
    year, suffix, serial = (F.regexp_extract(case, f"^([0-9]+?)({rules.suffixes})([0-9]+)$", k) for k in (1, 2, 3))
    year = F.regexp_extract(case, "^([0-9]{2,4})", 1)
    reasons = F.array(
        F.when(~F.length(year).isin(2, 4), F.lit("year digits")),
        F.when((F.length(year) == 4) & ~year.cast("int").between(rules.year_min, rules.year_max), F.lit("year range")),
        F.when(~suffix.isin(*rules.known_suffixes), F.lit("suffix")),
        F.when(serial.startswith("0"), F.lit("serial")),
    )
    return F.filter(reasons, lambda r: r.isNotNull())


def wrap_mnemonics(t: Column, rules: Rules = P.TEXTBOOK) -> Column:
    """Mnemonics in backticks, but for those that have one on either side already."""
    hit = f"(\\[{rules.valid_body}\\])(?![(:])"
    t = F.regexp_replace(t, f"(?U)(?<!`){hit}", "`$1`")
    return F.regexp_replace(t, f"(?U)(?<=`){hit}(?!`)", "`$1`")


def case_entries(t: Column, rules: Rules = P.TEXTBOOK) -> Column:
    """array<struct<id, label, standard>> of the case numbers of a block, line by line: label of the line's heading
    bracket or short head, standard if a star follows."""
    list_head = P.LIST_HEAD

    def of_line(line: Column) -> Column:
        plain = F.trim(F.regexp_replace(line, r"`|={2}|\*{2}", ""))
        bracket = F.trim(F.regexp_extract(plain, "(?U)" + P.CASE_LABEL, 1))
        head = F.trim(F.regexp_extract(F.regexp_replace(plain, list_head, ""), r"^([^\[(（.]*)", 1))
        label = F.when(bracket != "", bracket).when(plain.rlike(list_head) & F.char_length(head).between(1, 12), head).otherwise(F.lit(""))
        hits = F.regexp_extract_all(line, F.lit(rules.case + r"(\*?)"), F.lit(0))
        return F.transform(hits, lambda h: F.struct(F.rtrim(h, F.lit("*")).alias("id"), label.alias("label"), h.endswith("*").alias("standard")))

    return F.flatten(F.transform(F.split(t, "\n"), of_line))


def residual_noise(t: Column) -> Column:
    """Characters outside the allowed ranges."""
    return F.regexp_extract_all(_odd(t), F.lit("(?U)" + P.NOISE_CLASS), F.lit(0))


def residual_noise_count(t: Column) -> Column:
    return F.regexp_count(_odd(t), F.lit("(?U)" + P.NOISE_CLASS))


def _odd(t: Column) -> Column:
    """Without the characters of ASCII that are allowed; each character is judged on its own."""
    return F.regexp_replace(t, r"[\x20-\x7e\t-\r]+", "")
