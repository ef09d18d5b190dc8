"""Text extraction and formatting expressions (code fences, reasoning tags,
doctests, rewards on text, observation and grading strings)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trainloom import config as C

# Python's notion of whitespace (``str.isspace``), derived by rule so trimming
# and ``\s`` agree with Python on Unicode text.
PY_WHITESPACE = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())
# Line boundaries of ``str.splitlines`` (``\r\n`` counts once).
LINE_BREAK_RE = "\\r\\n|[\\n\\r\\x{b}\\x{c}\\x{1c}-\\x{1e}\\x{85}\\x{2028}\\x{2029}]"


def _char_class(chars: str) -> str:
    return "[" + "".join("\\x{%x}" % ord(c) for c in chars) + "]"


WS = _char_class(PY_WHITESPACE)
# Word character as in Python's Unicode ``\w``.
WORD = "[\\p{L}\\p{N}_]"
# A fenced block: optional (case-insensitive) python tag, then a newline.
FENCE_RE = "(?su)```(?i:python)?" + WS + "*\\n(.*?)```"
# A line that starts a (possibly async) function definition.
DEF_LINE_RE = "(?md)^" + WS + "*(?:async" + WS + "+)?def" + WS + "+" + WORD + "+" + WS + "*\\("
THINK_SEGMENT_RE = "(?s)<think>(.*?)(?:</think>|\\z)"
THINK_BLOCK_RE = "(?s)<think>.*?(?:</think>|\\z)"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_py(c) -> Column:
    """``str.strip()``: remove Python whitespace at both ends."""
    return F.trim(col_(c), F.lit(PY_WHITESPACE))


def nonempty(c) -> Column:
    """Empty string -> NULL, so that missing, null and empty behave alike."""
    return F.nullif(col_(c), F.lit(""))


def first_nonempty(*cols, default: str = "") -> Column:
    """``a or b or default`` over string columns."""
    return F.coalesce(*[nonempty(c) for c in cols], F.lit(default))


def fence_blocks(text) -> Column:
    """Bodies of all fenced code blocks, in order (never NULL)."""
    return F.regexp_extract_all(F.coalesce(col_(text), F.lit("")), F.lit(FENCE_RE), 1)


def last_fence_code(text) -> Column:
    """Body of the last fence, trimmed; no fence -> whole text trimmed; NULL -> ''."""
    t = F.coalesce(col_(text), F.lit(""))
    last = F.try_element_at(fence_blocks(t), F.lit(-1))
    return strip_py(F.coalesce(last, t))


def extract_code(text) -> Column:
    """First fence holding a def line, else the first fence, else the text
    after the first closing reasoning tag, else the whole text; trimmed."""
    t = F.coalesce(col_(text), F.lit(""))
    blocks = fence_blocks(t)
    with_def = F.try_element_at(F.filter(blocks, lambda b: b.rlike(DEF_LINE_RE)), F.lit(1))
    first = F.try_element_at(blocks, F.lit(1))
    pos = F.instr(t, C.THINK_CLOSE)
    after_think = F.when(pos > 0, F.substring(t, pos + len(C.THINK_CLOSE), 1 << 30))
    return strip_py(F.coalesce(with_def, first, after_think, t))


def think_text(text) -> Column:
    """X5 reasoning channel: every tagged segment, an unclosed tag running to the end."""
    segs = F.regexp_extract_all(F.coalesce(col_(text), F.lit("")), F.lit(THINK_SEGMENT_RE), 1)
    return F.array_join(segs, "")


def answer_text(text) -> Column:
    """X5 answer channel: the text with every tagged segment removed."""
    return F.regexp_replace(F.coalesce(col_(text), F.lit("")), THINK_BLOCK_RE, "")


def format_reward(text) -> Column:
    """+0.3 if both reasoning tags occur, +0.2 for exactly one python fence."""
    t = F.coalesce(col_(text), F.lit(""))
    both = F.contains(t, F.lit(C.THINK_OPEN)) & F.contains(t, F.lit(C.THINK_CLOSE))
    one_fence = F.regexp_count(t, F.lit(C.FENCE_PYTHON)) == 1
    return (F.when(both, F.lit(C.FORMAT_THINK_BONUS)).otherwise(F.lit(0.0))
            + F.when(one_fence, F.lit(C.FORMAT_FENCE_BONUS)).otherwise(F.lit(0.0)))


def completion_text(messages, text) -> Column:
    """First message's content for conversational completions, else the string."""
    return F.coalesce(F.try_element_at(col_(messages), F.lit(1)).getField("content"), col_(text), F.lit(""))


def approx_tokens(n_chars) -> Column:
    """chars/4 token estimate (float)."""
    return col_(n_chars) / F.lit(4.0)


def is_truncated(n_chars, max_completion_length: int = C.MAX_COMPLETION_LENGTH) -> Column:
    return approx_tokens(n_chars) >= F.lit(max_completion_length * C.TRUNCATION_FRACTION)


def percent(x, digits: int = 1) -> Column:
    """``{:.1%}`` formatting of a rate (not negative): the double's exact value
    is rounded, ties to the even digit.

    The fraction of a double is a multiple of 2**-52 (or smaller: ``rest``), so
    scaled by 2**52 it divides exactly in integers.
    """
    y = col_(x) * F.lit(100.0)
    whole = F.floor(y)
    scaled = (y - whole) * F.lit(2.0 ** 52)
    bits = F.floor(scaled)
    rest = scaled > bits
    tens = bits * F.lit(10 ** digits)
    down = F.shiftright(tens, 52)
    over = tens - F.shiftleft(down, 52)
    half = F.lit(1 << 51)
    up = (over > half) | ((over == half) & (rest | (down % 2 == 1)))
    n = whole * F.lit(10 ** digits) + down + F.when(up, F.lit(1)).otherwise(F.lit(0))
    shown = F.format_string(f"%d.%0{digits}d%%", F.floor(n / F.lit(10 ** digits)), n % F.lit(10 ** digits))
    return F.when(y.isNotNull(), shown)


def raw_lines(text) -> Column:
    """Split at every ``str.splitlines`` boundary, keeping a trailing empty piece."""
    return F.split(F.coalesce(col_(text), F.lit("")), LINE_BREAK_RE, -1)


def drop_trailing_empty(parts) -> Column:
    p = col_(parts)
    return F.when(F.try_element_at(p, F.lit(-1)) == F.lit(""), F.slice(p, 1, F.size(p) - 1)).otherwise(p)


def split_lines(text) -> Column:
    """``str.splitlines()``: split at every line boundary, no trailing empty line.
    (In plans, prefer ``with_lines``, which splits each text once.)"""
    return drop_trailing_empty(raw_lines(text))


def with_lines(df, text: str, out: str = "lines"):
    """Add ``out`` = splitlines(text), staged so the text is split once per row
    (a non-cheap column referenced several times is not re-inlined)."""
    return (df.withColumn("_raw_lines", raw_lines(text))
              .withColumn(out, drop_trailing_empty("_raw_lines")).drop("_raw_lines"))


def doctest_candidates_from_lines(lines) -> Column:
    """X3 over an already split ``lines`` column (see ``doctest_candidates``). Lines
    are paired with the array shifted by one (no lambda refers to the outer array)."""
    lines = col_(lines)
    n = F.size(lines)
    nexts = F.when(n > 1, F.slice(lines, 2, n - 1)).otherwise(F.array().cast("array<string>"))

    def pair(line, nxt):
        stripped = strip_py(line)
        expr = strip_py(F.substring(stripped, 5, 1 << 30))
        expected = strip_py(nxt)
        keep = (nxt.isNotNull() & stripped.startswith(">>> ") & (expected != F.lit(""))
                & ~expected.startswith(">>> ") & ~expr.startswith("print("))
        return F.when(keep, F.concat(F.lit("assert ("), expr, F.lit(") == ("), expected, F.lit(")")))

    return F.filter(F.zip_with(lines, nexts, pair), lambda x: x.isNotNull())


def doctest_candidates(prompt) -> Column:
    """X3 up to the parse check: ``>>> expr`` lines paired with the next line
    (W4) turned into ``assert (expr) == (expected)``; the last line never pairs,
    empty / ``>>> `` expected lines and ``print(`` examples are skipped."""
    return doctest_candidates_from_lines(split_lines(prompt))


def observation(has_tests, stderr, stdout) -> Column:
    """X11: failure report fed back to the model, first 800 characters."""
    detail = F.substring(F.coalesce(nonempty(stderr), col_(stdout), F.lit("")), 1, C.OBS_MAX_CHARS)
    head = F.when(col_(has_tests), F.lit(C.OBS_TESTS_FAILED)).otherwise(F.lit(C.OBS_EXEC_ERROR))
    return F.concat(head, detail, F.lit(C.OBS_FIX_SUFFIX))


def failure_trace(public_test) -> Column:
    """Assertion trace text for a failed public test (nothing is run)."""
    t = F.coalesce(col_(public_test), F.lit(""))
    return F.concat(F.lit(C.FAILURE_TRACE_HEAD), t, F.lit(C.FAILURE_TRACE_MID), t, F.lit(C.FAILURE_TRACE_TAIL))


def grading_script(code, test, entry_point) -> Column:
    """Program text for an outside runner: code, hidden test, check call."""
    return F.concat(F.coalesce(col_(code), F.lit("")), F.lit("\n"), F.coalesce(col_(test), F.lit("")),
                    F.lit("\ncheck("), F.coalesce(col_(entry_point), F.lit("")), F.lit(")\n"))
