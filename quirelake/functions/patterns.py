"""Patterns of the legal-book profile, built from a rule set once on the driver.

All are Java regular expressions for the JVM-side functions; `(?U)` gives them Unicode
classes. `re2` holds forms without lookaround, for engines that lack it.
"""

from __future__ import annotations

import copy
import re
from dataclasses import dataclass, field

# -- fixed values ---------------------------------------------------------------------
# These must equal those that the documents' conventions prescribe.
CASE_SUFFIXES = ["재다", "재도", "재후", "재허", "다", "도", "후", "허", "므", "두", "누", "마", "카", "그", "초", "오", "인", "부"]
KNOWN_SUFFIXES = ["다", "도", "후", "허", "므", "두", "누", "마", "카", "그", "재다", "재도", "재후", "재허"]
DENY_WORDS = ["대법원", "전원합의체", "판결", "결정", "각주", "별지", "주석", "이하", "참조", "개정", "신설", "삭제", "미간행", "공보"]
STARS = ["*", "＊", "﹡", "✱", "∗"]
OPEN_BRACKETS = ["＜", "〈", "≪", "《", "｛", "「", "『", "［", "[", "{", "〔", "（"]
CLOSE_BRACKETS = ["＞", "〉", "≫", "》", "｝", "」", "』", "］", "]", "}", "〕", "）"]
MNEMONIC_PAIRS = [("{", "}"), ("｛", "｝"), ("〔", "〕"), ("【", "】")]
ARTICLE_UNITS = ["편", "장", "절", "관", "조", "항", "호", "목", "목차", "심급"]
NOISE_STRINGS = ["¤", "°］", "°]", "￣", "\uFFFD", "\uF0B7", "\uE000"]
NOISE_TOKENS = ["셔", "°", "ﾂ", "「", "」"]
ALLOWED_RANGES = [
    (0x0020, 0x007E), (0xAC00, 0xD7A3), (0x1100, 0x11FF), (0x3130, 0x318F), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x3000, 0x303F),
    (0x2160, 0x217F), (0x2460, 0x24FF), (0x2018, 0x201D), (0x2013, 0x2015),
]
ALLOWED_CHARS = "·※→←↔≪≫「」『』〈〉§¶†‡…‰°∼~№㈜㎡ⓐ*"
OUTLINE_WORDS = ["의의", "내용", "요건", "예외", "효과", "관련논점", "취지", "절차", "범위", "한계"]
BONUS_MARK, BONUS_MISREAD, BONUS_ASCII = "☑", ["口", "囗", "☐", "▣", "■", "ⓥ", "Ⅴ"], ["0", "V", "v", "ㅁ"]
QA_RULES = [
    ("청구", "정구|정\\s*\\+\\s*구|청\\s*\\+\\s*구"), ("결과", "졀과|걸과"), ("구한다", "수한다"), ("로마자", "(?<![가-힣])[ⅰｉ](?=\\s*\\))"), ("判例", "判列|判倒|判例\\s*例"),
]
BULLETS = "•‣▪▫●○◦⁃∙·■□❖➤➔§"
TEXTBOOK_HEADINGS = [
    (1, "^제\\s*(\\d+)\\s*편(?![가-힣])"), (2, "^제\\s*(\\d+)\\s*장(?![가-힣])"), (2, "^CHAPTER\\s+(\\d+)\\b"), (3, "^제\\s*(\\d+)\\s*절(?![가-힣])"),
    (4, "^([ⅠⅡⅢⅣⅤⅥⅦⅧⅨⅩ]|[IVX]{1,5})\\s*[.·]\\s*"),
]
ANSWER_HEADINGS = [(3, "^(\\d+)\\s*\\.\\s*"), (4, "^\\(\\s*(\\d+)\\s*\\)\\s*")]
SCORE = "(?<![\\w가-힣])[\\[(（]?\\s*(\\d+(?:\\.\\d+)?)\\s*(?:점)?\\s*[\\])）]?\\s*$"
CASE_LABEL = "^(?:\\d+\\s*[).]|\\(\\s*\\d+\\s*\\))\\s*\\[([^\\]]{2,40})\\]"
PROBLEM = "^([A-Z])\\s*-\\s*(\\d+)\\s*\\.?\\s*(.*)$"
DATE = "(?<![0-9])([0-9]{4})\\.\\s*([0-9]{1,2})\\.\\s*([0-9]{1,2})\\.?"
NOTE_REF = "\\[\\^([0-9]{1,4})\\]"
NOTE_DEF = "^\\[\\^([0-9]{1,4})\\]:\\s?(.*)$"
NOTE_HEAD = "(?U)^([0-9]{1,4})\\s*[).\\]]?\\s+(\\S.*)$"
SENTENCE_END = "(?U)(?:[.?!]|다\\.|음\\.|함\\.|[」』’”\\)])\\s*$"
LIST_HEAD = "(?U)^(?:[-•‣▪·]|\\(\\s*\\d+\\s*\\)|\\d+\\s*\\)|[가-하]\\s*[.)]|[①-⑳]|[ⅰ-ⅹ]\\s*\\)|\\(\\s*[ⅰ-ⅹ]\\s*\\))\\s*"
SIDE = "s[A-Z]-[0-9]{1,4}"
SIDE_MERGED = "sE-[0-9]{3,}|s[A-Z]-[0-9]+\\s*[0-9]"
PAGE_NUMBER = "^[-–—\\s]*[0-9]{1,4}\\s*(?:/\\s*[0-9]{1,4})?[-–—\\s]*$"
NOTICE = "^\\s*[※*]?\\s*[<〈《【\\[(]{1,2}\\s*안\\s*내\\s*[>〉》】\\])]{1,2}\\s*$"
NUMBERED_HEADING = "^\\s*(?:[0-9]+(?:\\.[0-9]+){0,4}[.)]?\\s+\\S|제\\s*[0-9]+\\s*[장절편관조항]\\s*)"
ORDERED = "^\\s*([0-9]{1,3}[.)]|\\([0-9]{1,3}\\)|[a-zA-Z][.)]|\\([a-zA-Z]\\)|[ivxIVX]{1,5}[.)]|[가-힣][.)]|\\([가-힣]\\))\\s+(?=\\S)"
CIRCLED = "^\\s*([①-⑳㉑-㉟㊱-㊿])\\s*(?=\\S)"
LINE_BREAK = "\\r\\n|[\\n\\r\\x0B\\x0C\\x1C-\\x1E\\x{85}\\x{2028}\\x{2029}]"
# -------------------------------------------------------------------------------------

HANGUL = "가-힣"


def literal(text: str) -> str:
    return re.sub(r"([\\^$.|?*+()\[\]{}\-&#~ ])", r"\\\1", text)


def alternatives(words: list[str]) -> str:
    """Alternation with longer words first."""
    return "|".join(map(literal, sorted(words, key=lambda w: -len(w))))


def char_class(chars) -> str:
    return "[" + "".join(map(literal, chars)) + "]"


@dataclass(frozen=True)
class Rules:
    """All lists, patterns and thresholds; replace fields for another profile."""

    name: str = "textbook"
    label: str = "기본서"
    case_suffixes: tuple = tuple(CASE_SUFFIXES)
    known_suffixes: tuple = tuple(KNOWN_SUFFIXES)
    year_min: int = 1945
    year_max: int = 2099
    token_min: int = 2
    token_max: int = 6
    max_tokens: int = 2
    mnemonic_max: int = 9
    deny_words: tuple = tuple(DENY_WORDS)
    stars: tuple = tuple(STARS)
    star_gap: int = 2
    note_min: int = 1
    note_max: int = 4000
    tail_lines: int = 12
    inline_refs: bool = True
    date_hangul: str = "warn"
    join: str = "space"
    headings: tuple = tuple(TEXTBOOK_HEADINGS)
    section_item: str | None = "^(\\d+)\\s*\\.\\s*"
    section_max: int = 40
    problem: str | None = None
    answer_headings: tuple = ()
    score: str | None = None
    score_max: float = 50.0
    flush_level: int = 4
    split: str = "chapter"
    split_max_bytes: int = 409600
    prompt_words: tuple = ()
    answer_words: tuple = ()
    side_tolerance: float = 12.0
    century: int = 50
    bonus_lines: int = 24
    extra: dict = field(default_factory=dict, compare=False)

    # entities
    @property
    def suffixes(self) -> str:
        return alternatives(list(self.case_suffixes))

    @property
    def case(self) -> str:
        return f"(?<![0-9A-Za-z])([0-9]{{2,4}})({self.suffixes})([0-9]+)(?![0-9])(?!호선|번지)"

    @property
    def case_loose(self) -> str:
        return f"(?U)(?<![0-9A-Za-z])([0-9]{{2,4}})\\s*({self.suffixes})\\s*([0-9]+)(?![0-9])"

    @property
    def case_star(self) -> str:
        return f"(?U)(?<![0-9A-Za-z])[0-9]{{2,4}}(?:{self.suffixes})[0-9]+(?![0-9])\\s{{0,{self.star_gap}}}{char_class(self.stars)}"

    @property
    def body(self) -> str:
        token = f"[{HANGUL}]{{{self.token_min},{self.token_max}}}"
        return f"{token}(?:\\s{token}){{0,{max(0, self.max_tokens - 1)}}}"

    @property
    def valid_body(self) -> str:
        """body, at most mnemonic_max long and without a denied word, told before the closing bracket."""
        deny = f"(?![^\\]}}｝〕】]*(?:{alternatives(list(self.deny_words))}))" if self.deny_words else ""
        return f"{deny}(?=[{HANGUL}\\s]{{1,{self.mnemonic_max}}}[\\]}}｝〕】]){self.body}"

    @property
    def mnemonic(self) -> str:
        return f"(?U)\\[({self.valid_body})\\](?![(:])"


ARTICLE = f"(?U)제\\s+([0-9]+)\\s*({alternatives(ARTICLE_UNITS)})(?![{HANGUL}])"
BULLET = f"^\\s*([{literal(BULLETS)}]|[-*+–—])\\s+(?=\\S)"
NOISE_CLASS = "[^" + "".join(f"\\x{{{lo:x}}}-\\x{{{hi:x}}}" for lo, hi in ALLOWED_RANGES) + "".join(map(literal, ALLOWED_CHARS)) + "\\s]"

TEXTBOOK = Rules()
CASEBOOK = Rules(
    name="casebook", label="사례집", headings=(), section_item=None, problem=PROBLEM, answer_headings=tuple(ANSWER_HEADINGS), score=SCORE, flush_level=2, split="group", split_max_bytes=0,
    prompt_words=("문제", "【문제】", "[문제]", "사례", "설문"), answer_words=("답안", "【답안】", "[답안]", "모범답안", "예시답안"),
)
#: For prose without legal entities: headings are short lines without a sentence end.
GENERIC = Rules(name="generic", label="generic", headings=(), section_item=None)
PROFILES = {r.name: r for r in (TEXTBOOK, CASEBOOK, GENERIC)}


def profile(name: str) -> Rules:
    if name not in PROFILES:
        raise KeyError(f"no profile {name!r}; there are {', '.join(PROFILES)}")
    return copy.deepcopy(PROFILES[name])
