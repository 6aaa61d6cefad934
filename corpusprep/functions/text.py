"""Text column expressions with Python string semantics, built from Spark SQL functions.

Everything here returns a ``Column`` made of built-in functions, so it runs on the JVM next to
the scan. Higher-order functions (``transform``) are evaluated interpreted inside the stage, but
they only run on rows that actually contain characters needing an escape (a ``CASE`` guard).

Semantics reproduced:

* ``str.split()`` / ``str.strip()`` - split and trim on Python's whitespace set, which is wider
  than Java's ``\\s`` and than Spark's ``trim`` (space only).
* ``repr(dict)`` of two strings and ``json.dumps(list, ensure_ascii=True)`` - the hash inputs of
  the row id (``content_idx``) and the length-series id (``pair_id``).
* Python round-half-even of a ratio of integers to ``places`` decimals as ``round(float, p)``
  computes it (decided on the exact binary value of the quotient).
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------------------------
# Fixed values (must equal Python's definitions).
# Python str.isspace() characters: TAB LF VT FF CR, the four information separators
# U+001C..U+001F, SPACE, NEL U+0085, NBSP U+00A0, OGHAM SPACE U+1680, U+2000..U+200A,
# LINE SEPARATOR U+2028, PARAGRAPH SEPARATOR U+2029, U+202F, U+205F, IDEOGRAPHIC SPACE U+3000.
WHITESPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as the inside of a regex character class; valid for Java regex and RE2.
WS_CLASS_BODY = (
    r"\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
WS = f"[{WS_CLASS_BODY}]"
NOT_WS = f"[^{WS_CLASS_BODY}]"
# Characters str.isprintable() rejects: categories Cc Cf Co Cn Zl Zp and Zs except SPACE.
# (Cs cannot occur in a Spark string.) Zs is listed explicitly so that the class reads the same
# in RE2, which has no \p{Cn}; the Spark side keeps \p{Cn}.
NONPRINT_CLASS_BODY = (
    r"\p{Cc}\p{Cf}\p{Co}\p{Cn}\p{Zl}\p{Zp}\x{a0}\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}"
)
# The ASCII range json.dumps(ensure_ascii=True) leaves unescaped: SPACE..TILDE.
JSON_PLAIN_BODY = r"\x20-\x7e"
# ---------------------------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def words(c) -> Column:
    """``str.split()``: maximal runs of non-whitespace characters, as ``array<string>``.

    Whitespace becomes SPACE, the text is cut at each SPACE and the empty pieces dropped: a tenth of the time of a
    regular expression over the whitespace class.
    """
    spaced = F.translate(F.coalesce(_c(c), F.lit("")), WHITESPACE_CHARS, " " * len(WHITESPACE_CHARS))
    return F.array_remove(F.split(spaced, " "), "")


def word_count(c) -> Column:
    """``len(s.split())`` as ``int``; a null text counts as empty."""
    return F.size(words(c))


def strip_text(c) -> Column:
    """``s.strip()``: drop Python whitespace from both ends (``btrim`` with the whitespace set)."""
    return F.call_function("btrim", _c(c), F.lit(WHITESPACE_CHARS))


def max_len(src_len, tgt_len) -> Column:
    """Length used for bucketing in the reference's profile: ``max(src, tgt + 1)``."""
    return F.greatest(_c(src_len), _c(tgt_len) + F.lit(1))


def _hex_lower(code: Column, width: int) -> Column:
    return F.lpad(F.lower(F.hex(code)), width, "0")


def py_repr(c) -> Column:
    """Python ``repr(str)``.

    Quote choice: double quotes only when the text holds a single quote and no double quote.
    Backslash and the chosen quote get a backslash; TAB/LF/CR their short escapes; other
    non-printable characters ``\\xhh`` / ``\\uhhhh`` / ``\\Uhhhhhhhh`` by code point.
    """
    s = _c(c)
    dq = (F.instr(s, "'") > 0) & (F.instr(s, '"') == 0)
    quote = F.when(dq, F.lit('"')).otherwise(F.lit("'"))
    body = F.regexp_replace(s, r"\\", r"\\\\")
    body = F.when(dq, body).otherwise(F.regexp_replace(body, "'", r"\\'"))
    np_one = f"[{NONPRINT_CLASS_BODY}]"
    pieces = F.regexp_extract_all(body, F.lit(f"{np_one}|[^{NONPRINT_CLASS_BODY}]+"), 0)

    def esc(tok: Column) -> Column:
        cp = F.ascii(tok)
        return (
            F.when(~tok.rlike(f"^{np_one}$"), tok)
            .when(cp == 9, F.lit("\\t"))
            .when(cp == 10, F.lit("\\n"))
            .when(cp == 13, F.lit("\\r"))
            .when(cp < 256, F.concat(F.lit("\\x"), _hex_lower(cp, 2)))
            .when(cp < 65536, F.concat(F.lit("\\u"), _hex_lower(cp, 4)))
            .otherwise(F.concat(F.lit("\\U"), _hex_lower(cp, 8)))
        )

    escaped = F.when(body.rlike(np_one), F.array_join(F.transform(pieces, esc), "")).otherwise(body)
    return F.concat(quote, escaped, quote)


def content_idx(src, tgt) -> Column:
    """12-hex row id: sha1 of ``repr({'src': src, 'tgt': tgt})`` (texts already stripped)."""
    r = F.concat(F.lit("{'src': "), py_repr(src), F.lit(", 'tgt': "), py_repr(tgt), F.lit("}"))
    return F.substring(F.sha1(F.encode(r, "UTF-8")), 1, 12)


def json_escape_ascii(c) -> Column:
    """Body of ``json.dumps(s, ensure_ascii=True)`` without the surrounding quotes."""
    s = F.regexp_replace(F.regexp_replace(_c(c), r"\\", r"\\\\"), '"', '\\\\"')
    one = f"[^{JSON_PLAIN_BODY}]"
    pieces = F.regexp_extract_all(s, F.lit(f"{one}|[{JSON_PLAIN_BODY}]+"), 0)

    def esc(tok: Column) -> Column:
        cp = F.ascii(tok)
        units = F.regexp_replace(F.lower(F.hex(F.encode(tok, "UTF-16BE"))), "(.{4})", r"\\u$1")
        return (
            F.when(~tok.rlike(f"^{one}$"), tok)
            .when(cp == 8, F.lit("\\b"))
            .when(cp == 9, F.lit("\\t"))
            .when(cp == 10, F.lit("\\n"))
            .when(cp == 12, F.lit("\\f"))
            .when(cp == 13, F.lit("\\r"))
            .otherwise(units)
        )

    return F.when(s.rlike(one), F.array_join(F.transform(pieces, esc), "")).otherwise(s)


def pair_id(src, tgt) -> Column:
    """8-hex series id: sha1 of the compact ASCII JSON list of source words then target words."""
    return id_of_words(F.concat(words(src), words(tgt)))


def id_of_words(ws: Column) -> Column:
    """8 hex digits of the hash of a word list. The list is joined once, as a lambda's argument, however often the text of
    its JSON form is used."""
    # Words hold no whitespace, so one SPACE separates them and marks the '","' boundaries; no word is empty.
    def hashed(joined: Column) -> Column:
        quoted = F.concat(F.lit('["'), F.replace(json_escape_ascii(joined), F.lit(" "), F.lit('","')), F.lit('"]'))
        return F.substring(F.sha1(F.encode(F.when(joined == "", F.lit("[]")).otherwise(quoted), "UTF-8")), 1, 8)

    return F.element_at(F.transform(F.array(F.array_join(ws, " ")), hashed), 1)


def shuffle_key(seed: int, key) -> Column:
    """Deterministic shuffle position: ``md5('<seed>:<key>')`` as 32 lower-case hex chars."""
    return F.md5(F.concat(F.lit(f"{seed}:"), _c(key).cast("string")))


def py_round_ratio(num, den, places: int = 3) -> Column:
    """``round(num / den, places)`` exactly as Python computes it, for integer ``num``, ``den``.

    Python rounds the *binary* value of the quotient half-even. Off a decimal tie the answer is
    the nearest decimal of the exact ratio (integer arithmetic). On an exact tie the quotient is
    either exactly representable (half-even applies) or was rounded up or down when converted to
    a double; the sign of ``tie - double`` is found exactly with a Veltkamp split of the double
    (each partial product is exact), so Spark and DuckDB agree with Python bit for bit.
    Returns null when ``den`` is 0.
    """
    scale = 10**places
    a = _c(num).cast("long") * F.lit(scale)
    b = _c(den).cast("long")
    q = F.call_function("div", a, b)  # exact integral division (a, b >= 0 here)
    r2 = (a - q * b) * 2
    d = _c(num).cast("double") / _c(den).cast("double")
    cc = d * F.lit(134217729.0)
    hi = cc - (cc - d)
    lo = d - hi
    two_scale = float(2 * scale)
    err = ((q * 2 + 1).cast("double") - hi * F.lit(two_scale)) - lo * F.lit(two_scale)
    up = (
        F.when(r2 > b, F.lit(1))
        .when(r2 < b, F.lit(0))
        .when(err < 0, F.lit(1))  # double above the tie
        .when(err > 0, F.lit(0))
        .otherwise(q % 2)  # exactly representable tie: half-even
    )
    return F.when(b == 0, F.lit(None).cast("double")).otherwise((q + up).cast("double") / F.lit(float(scale)))


# ---------------------------------------------------------------------------------------------
# The Unicode word-character class of the vocabulary pre-tokenizer (\w in Unicode
# mode: letters, marks, decimal digits, letter numbers, connector punctuation, ZWNJ/ZWJ, and the
# circled / squared Latin letters that are Alphabetic), and Unicode White_Space (Python's
# whitespace minus U+001C..U+001F).
WORD_CLASS_BODY = (
    r"\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}\x{200c}\x{200d}\x{24b6}-\x{24e9}"
    r"\x{1f130}-\x{1f149}\x{1f150}-\x{1f169}\x{1f170}-\x{1f189}"
)
WHITE_SPACE_BODY = (
    r"\t\n\x0b\x0c\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
# Word runs, or runs of anything that is neither a word character nor white space. Written with
# explicit classes for engines without Unicode \w (RE2); on the JVM, Unicode-mode \w and \s
# denote the same sets (\w = Alphabetic, marks, Nd, Pc, Join_Control; \s = White_Space) and
# match faster, so Spark uses PRETOKEN_JVM.
PRETOKEN = f"[{WORD_CLASS_BODY}]+|[^{WORD_CLASS_BODY}{WHITE_SPACE_BODY}]+"
PRETOKEN_JVM = r"(?U)\w+|[^\w\s]+"
# ---------------------------------------------------------------------------------------------


def pretokens(c) -> Column:
    """Split a text into word runs and punctuation runs (the BPE pre-tokenizer)."""
    return F.regexp_extract_all(F.coalesce(_c(c), F.lit("")), F.lit(PRETOKEN_JVM), 0)


def pretokens_with_specials(c, specials) -> Column:
    """Pre-tokens where special-token strings are cut out first and kept whole.

    A special token is matched before anything else at each position, and a run stops before a
    special token begins, which is what extracting the specials first and pre-tokenizing the
    pieces in between gives.
    """
    if not specials:
        return pretokens(c)
    import re as _re

    alts = "|".join(_re.escape(s) for s in sorted(specials, key=len, reverse=True))
    guard = f"(?!(?:{alts}))"
    word = f"(?:{guard}\\w)+"
    other = f"(?:{guard}[^\\w\\s])+"
    return F.regexp_extract_all(F.coalesce(_c(c), F.lit("")), F.lit(f"(?U){alts}|{word}|{other}"), 0)
