"""Scalar text functions as column expressions: all run inside the JVM."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Unicode has it; Java's plain ``\s`` is ASCII only.
SPACE = r"(?U)\s"
CJK_MAIN = "\\x{4E00}-\\x{9FFF}"
MATH = r"(?s)\${2}.*?\${2}|\$[^\n$]+\$"
LATEX_SPECIALS = {"\\": r"\textbackslash{}"} | {c: f"\\{c}" for c in "#$%&_{}"} | {c: f"\\textascii{name}{{}}" for c, name in (("^", "circum"), ("~", "tilde"))}
CHARS_PER_TOKEN = 1.5
_DIGITS = dict(zip("零一二三四五六七八九", range(10), strict=True)) | dict(zip("〇两", (0, 2), strict=True))
_UNITS = {sign: 10 ** (k + 1) for k, sign in enumerate("十百千")}


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once for a row, however often and inside whatever lambda ``f`` names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def strip(text: Column) -> Column:
    """Without Unicode white space at either end."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def collapse(text: Column) -> Column:
    """Every run of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, SPACE + "+", " "))


def compact(text: Column) -> Column:
    """Without any white space and dollar signs, the form in which passages are searched."""
    return F.regexp_replace(text, r"(?U)[\s$]+", "")


def excerpt(text: Column, limit: int = 120) -> Column:
    """At most ``limit`` characters of the collapsed text, dots where it goes on."""
    flat = collapse(text)
    return F.when(F.length(flat) > limit, F.concat(F.left(flat, F.lit(limit)), F.lit("..."))).otherwise(flat)


def count_of(text: Column, pattern: str) -> Column:
    """Matches of a regular expression, as a long."""
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def display_marks(text: Column) -> Column:
    """Pairs of dollar signs, not overlapping."""
    return count_of(text, r"\$\$")


def inline_marks(text: Column) -> Column:
    """Dollar signs that are neither escaped nor part of a pair."""
    return count_of(F.replace(text, F.lit("$$"), F.lit("")), r"(?<!\\)\$")


def dollar_runs(text: Column) -> Column:
    """Lengths of the runs of dollar signs."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"(\$+)"), 1), F.length)


def without_math(text: Column) -> Column:
    return F.regexp_replace(text, MATH, "")


def residue_counts(text: Column, alphabet: str = CJK_MAIN) -> tuple[Column, Column]:
    """Characters of an alphabet, and all characters, outside math and white space."""
    solid = F.regexp_replace(without_math(text), SPACE + "+", "")
    return F.length(F.regexp_replace(solid, f"[^{alphabet}]+", "")).cast("long"), F.length(solid).cast("long")


def token_estimate(text: Column) -> Column:
    """``ceil(length / 1.5)``."""
    return F.ceil(F.length(text) / F.lit(CHARS_PER_TOKEN)).cast("long")


def escape_latex(text: Column) -> Column:
    """Characters special to TeX, each replaced once."""
    def one(c: Column) -> Column:
        return reduce(lambda done, x: done.when(c == x[0], F.lit(x[1])), list(LATEX_SPECIALS.items())[1:], F.when(c == "\\", F.lit(LATEX_SPECIALS["\\"]))).otherwise(c)

    return F.array_join(F.transform(F.split(text, ""), one), "")


def latin1_only(text: Column) -> Column:
    return F.coalesce(text.rlike(r"^[\x00-\xFF]*\z"), F.lit(False))


def brace_state(text: Column) -> Column:
    """(depth, low) after all braces that no backslash escapes: the net depth and its least value."""
    signs = F.split(F.regexp_replace(F.regexp_replace(text, r"(?s)\\.", ""), r"[^{}]+", ""), "")
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("low"))

    def step(state: Column, sign: Column) -> Column:
        depth = state["depth"] + F.when(sign == "{", 1).when(sign == "}", -1).otherwise(0)
        return F.struct(depth.alias("depth"), F.least(state["low"], depth).alias("low"))

    return F.aggregate(signs, start, step)


def brace_imbalance(text: Column) -> Column:
    """The net depth, or where that is zero its least value on the way."""
    state = brace_state(text)
    return F.when(state["depth"] != 0, state["depth"]).otherwise(state["low"]).cast("long")


def chinese_number(text: Column) -> Column:
    """Positional numerals up to the thousands; null if a character is none or there is none."""
    digits = F.create_map(*[F.lit(x) for pair in _DIGITS.items() for x in pair])
    units = F.create_map(*[F.lit(x) for pair in _UNITS.items() for x in pair])
    start = F.struct(F.lit(0).alias("total"), F.lit(0).alias("digit"), F.lit(True).alias("good"), F.lit(0).alias("n"))

    def step(s: Column, c: Column) -> Column:
        digit, unit = F.try_element_at(digits, c), F.try_element_at(units, c)
        worth = F.when(s["digit"] == 0, F.when(s["n"] == 0, 1).otherwise(0)).otherwise(s["digit"])
        total = F.when(unit.isNotNull(), s["total"] + F.greatest(worth, F.when(s["digit"] == 0, 1).otherwise(s["digit"])) * unit).otherwise(s["total"])
        return F.struct(
            total.alias("total"), F.when(unit.isNotNull(), 0).otherwise(F.coalesce(digit, F.lit(0))).alias("digit"),
            (s["good"] & (digit.isNotNull() | unit.isNotNull())).alias("good"), (s["n"] + 1).alias("n"),
        )

    def done(s: Column) -> Column:
        return F.when(s["good"] & (s["n"] > 0), (s["total"] + s["digit"]).cast("long"))

    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), start, step, done)


def filename(title: Column) -> Column:
    """A title as a file name: no reserved characters, underscores for spaces, 80 characters."""
    plain = F.regexp_replace(F.regexp_replace(title, r'[\\/:*?"<>|]', ""), SPACE + "+", "_")
    return F.substring(F.regexp_replace(plain, r"^[_.]+|[_.]+$", ""), 1, 80)


def image_kind(content: Column) -> Column:
    """The MIME type that the first bytes tell, else null."""
    head = F.hex(F.substring(content, 1, 12))
    return (
        F.when(head.startswith("FFD8FF"), "image/jpeg").when(head.startswith("89504E470D0A1A0A"), "image/png")
        .when(head.startswith("474946383761") | head.startswith("474946383961"), "image/gif")
        .when(head.startswith("52494646") & (F.substring(head, 17, 8) == "57454250"), "image/webp")
    )


def strip_fence(text: Column) -> Column:
    """Without an opening and a closing code fence line, each on its own."""
    return F.regexp_replace(F.regexp_replace(text, r"^\s*```[^\n]*\n", ""), r"\n```[ \t]*(\s*)\z", "$1")


def last_line(text: Column) -> Column:
    """The last line that is not blank, trimmed; empty without one."""
    return F.coalesce(F.try_element_at(F.filter(F.transform(F.split(text, "\n"), strip), lambda x: x != ""), F.lit(-1)), F.lit(""))


def chunk_id(name: Column) -> Column:
    """The first digits of a name, three at least: ``7.md`` is ``007``."""
    return F.lpad(F.regexp_extract(name, r"(\d+)", 1), 3, "0")


def request_id(*parts: Column) -> Column:
    """Content address of a request: 16 hexadecimal digits over its parts."""
    return F.substring(F.sha2(F.concat_ws("\x1f", *parts), 256), 1, 16)


def json_object(reply: Column) -> Column:
    """From the first opening to the last closing brace of a reply, or null without both."""
    first, last = F.instr(reply, "{"), F.length(reply) - F.instr(F.reverse(reply), "}") + 1
    return F.when((first > 0) & F.contains(reply, F.lit("}")) & (last > first), reply.substr(first, last - first + 1))


def repair_variants(text: Column) -> Column:
    """The text, and the one with control characters back as the escapes they were read from."""
    back = reduce(lambda t, x: F.replace(t, F.lit(x[0]), F.lit(x[1])), (("\f", r"\f"), ("\b", r"\b"), ("\r", r"\r"), ("\t", r"\t")), text)
    return F.array_distinct(F.array(text, F.regexp_replace(back, r"\n(?=[a-z])", r"\\n")))
