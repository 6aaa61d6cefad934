"""DuckDB SQL for the correctness oracle.

The same semantics as the Spark column functions, written for DuckDB (RE2 regexes, ``lambda``
list functions, ``printf``). These strings are what ``__spark_entry__.oracle_sql`` returns; the
tests run them against DuckDB on the driver's parquet files.

RE2 has no ``\\p{Cn}``: unassigned code points are not treated as non-printable here (the Spark
side follows Python). The driver's tables hold none.
"""
from __future__ import annotations

from corpusprep.functions.text import JSON_PLAIN_BODY, WHITESPACE_CHARS, WS_CLASS_BODY

NP_BODY_RE2 = r"\p{Cc}\p{Cf}\p{Co}\p{Zl}\p{Zp}\x{a0}\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}"
WS_CHARS_SQL = "||".join(f"chr({ord(c)})" for c in WHITESPACE_CHARS)


def words(x: str) -> str:
    return f"regexp_extract_all(coalesce({x}, ''), '[^{WS_CLASS_BODY}]+')"


def word_count(x: str) -> str:
    return f"CAST(len({words(x)}) AS INTEGER)"


def strip(x: str) -> str:
    return f"trim({x}, {WS_CHARS_SQL})"


def shuffle_key(seed: int, key: str) -> str:
    return f"md5('{seed}:' || CAST({key} AS VARCHAR))"


def py_repr(s: str) -> str:
    dq = f"(strpos({s}, '''') > 0 AND strpos({s}, '\"') = 0)"
    body0 = f"replace({s}, '\\', '\\\\')"
    body = f"(CASE WHEN {dq} THEN {body0} ELSE replace({body0}, '''', '\\''') END)"
    np1 = f"[{NP_BODY_RE2}]"
    esc = (
        "CASE WHEN NOT regexp_full_match(tok, '" + np1 + "') THEN tok "
        "WHEN unicode(tok) = 9 THEN '\\t' WHEN unicode(tok) = 10 THEN '\\n' WHEN unicode(tok) = 13 THEN '\\r' "
        "WHEN unicode(tok) < 256 THEN printf('\\x%02x', unicode(tok)) "
        "WHEN unicode(tok) < 65536 THEN printf('\\u%04x', unicode(tok)) "
        "ELSE printf('\\U%08x', unicode(tok)) END"
    )
    escaped = (
        f"(CASE WHEN regexp_matches({body}, '{np1}') THEN array_to_string(list_transform("
        f"regexp_extract_all({body}, '{np1}|[^{NP_BODY_RE2}]+'), lambda tok: {esc}), '') ELSE {body} END)"
    )
    quote = f"(CASE WHEN {dq} THEN '\"' ELSE '''' END)"
    return f"({quote} || {escaped} || {quote})"


def content_idx(src: str, tgt: str) -> str:
    r = f"('{{''src'': ' || {py_repr(src)} || ', ''tgt'': ' || {py_repr(tgt)} || '}}')"
    return f"substr(sha1({r}), 1, 12)"


def json_escape_ascii(s: str) -> str:
    s1 = f"replace(replace({s}, '\\', '\\\\'), '\"', '\\\"')"
    one = f"[^{JSON_PLAIN_BODY}]"
    esc = (
        "CASE WHEN NOT regexp_full_match(tok, '" + one + "') THEN tok "
        "WHEN unicode(tok) = 8 THEN '\\b' WHEN unicode(tok) = 9 THEN '\\t' WHEN unicode(tok) = 10 THEN '\\n' "
        "WHEN unicode(tok) = 12 THEN '\\f' WHEN unicode(tok) = 13 THEN '\\r' "
        "WHEN unicode(tok) < 65536 THEN printf('\\u%04x', unicode(tok)) "
        "ELSE printf('\\u%04x\\u%04x', 55296 + ((unicode(tok) - 65536) >> 10), 56320 + ((unicode(tok) - 65536) & 1023)) END"
    )
    return (
        f"(CASE WHEN regexp_matches({s1}, '{one}') THEN array_to_string(list_transform("
        f"regexp_extract_all({s1}, '{one}|[{JSON_PLAIN_BODY}]+'), lambda tok: {esc}), '') ELSE {s1} END)"
    )


def pair_id(src: str, tgt: str) -> str:
    ws = f"list_concat({words(src)}, {words(tgt)})"
    doc = (
        f"(CASE WHEN len({ws}) = 0 THEN '[]' ELSE '[\"' || replace({json_escape_ascii(f'array_to_string({ws}, chr(32))')}, ' ', '\",\"') || '\"]' END)"
    )
    return f"substr(sha1({doc}), 1, 8)"


def round_ratio(num: str, den: str, places: int = 3) -> str:
    """Python ``round(num / den, places)`` for integers, same arithmetic as the Spark side."""
    scale = 10**places
    a = f"(CAST({num} AS BIGINT) * {scale})"
    b = f"CAST({den} AS BIGINT)"
    q = f"({a} // {b})"
    r2 = f"(({a} - {q} * {b}) * 2)"
    d = f"(CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE))"
    cc = f"({d} * CAST(134217729 AS DOUBLE))"
    hi = f"({cc} - ({cc} - {d}))"
    lo = f"({d} - {hi})"
    two = f"CAST({2 * scale} AS DOUBLE)"
    err = f"((CAST({q} * 2 + 1 AS DOUBLE) - {hi} * {two}) - {lo} * {two})"
    up = f"(CASE WHEN {r2} > {b} THEN 1 WHEN {r2} < {b} THEN 0 WHEN {err} < 0 THEN 1 WHEN {err} > 0 THEN 0 ELSE {q} % 2 END)"
    return f"(CASE WHEN {b} = 0 THEN NULL ELSE CAST({q} + {up} AS DOUBLE) / CAST({scale} AS DOUBLE) END)"


def reason_case(s: str = "src_len", t: str = "tgt_len", tokens_min: int = 4, tokens_max: int = 64,
                ratio_max: float = 2.0) -> str:
    return (
        f"CASE WHEN {s} = 0 OR {t} = 0 THEN 'empty' "
        f"WHEN CAST(greatest({s}, {t}) AS DOUBLE) / CAST(least({s}, {t}) AS DOUBLE) > {float(ratio_max)!r} THEN 'ratio' "
        f"WHEN {s} < {tokens_min} THEN 'src_short' WHEN {s} > {tokens_max} THEN 'src_long' "
        f"WHEN {t} < {tokens_min} THEN 'tgt_short' WHEN {t} > {tokens_max} THEN 'tgt_long' END"
    )


# ---- views -------------------------------------------------------------------------------------

PAIRS = (
    "doc_lines AS (SELECT doc_id, lang, source, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents), "
    "doc_pairs AS (SELECT *, unnest(range((len(ls) + 1) // 2)) AS i FROM doc_lines), "
    "pairs AS (SELECT CAST(doc_id AS VARCHAR) || ':' || CAST(i AS VARCHAR) AS row_key, ls[2 * i + 1] AS src, "
    "coalesce(ls[2 * i + 2], '') AS tgt, lang, source FROM doc_pairs)"
)
TURN_PAIRS = (
    "turn_pairs AS (SELECT CAST(u.conv_id AS VARCHAR) || ':' || CAST(u.turn AS VARCHAR) AS row_key, coalesce(u.text, '') AS src, "
    "coalesce(a.text, '') AS tgt FROM conversations u JOIN conversations a "
    "ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant' WHERE u.role = 'user')"
)


def classified(src_view: str = "pairs", name: str = "classified", seed: int | None = None) -> str:
    sk = f", {shuffle_key(seed, 'row_key')} AS skey" if seed is not None else ""
    return (
        f"{name}_l AS (SELECT *, {word_count('src')} AS src_len, {word_count('tgt')} AS tgt_len FROM {src_view}), "
        f"{name} AS (SELECT *, {reason_case()} AS reason{sk} FROM {name}_l)"
    )


REASONS = ("empty", "ratio", "src_short", "src_long", "tgt_short", "tgt_long")


def first_n_window(n: int, seed: int, src_view: str = "pairs") -> str:
    """CTEs ending in ``win``: the rows seen by the first-n-valid walk."""
    return (
        classified(src_view, "c", seed) + ", "
        "v AS (SELECT skey, row_key, row_number() OVER (ORDER BY skey, row_key) AS rn FROM c WHERE reason IS NULL), "
        f"cut AS (SELECT skey AS cs, row_key AS ck FROM v WHERE rn = {n}), "
        "win AS (SELECT c.* FROM c LEFT JOIN cut ON TRUE WHERE cut.cs IS NULL OR c.skey < cut.cs "
        "OR (c.skey = cut.cs AND c.row_key <= cut.ck))"
    )


def funnel_select() -> str:
    cols = ["count_if(reason IS NULL) AS n", "count(*) AS seen", "count_if(reason IS NOT NULL) AS filtered",
            "count_if(reason IS NULL) AS candidates", "count_if(reason IS NULL) AS selected"]
    cols += [f"count_if(reason = '{r}') AS filtered_{r}" for r in REASONS]
    return "SELECT " + ", ".join(cols) + " FROM win"


def reason_counts_select(src: str = "c") -> str:
    cols = ["count(*) AS seen", "count_if(reason IS NULL) AS ok"] + [f"count_if(reason = '{r}') AS {r}" for r in REASONS]
    return "SELECT " + ", ".join(cols) + f" FROM {src}"


def pretokens(x: str) -> str:
    from corpusprep.functions.text import PRETOKEN

    return f"regexp_extract_all(coalesce({x}, ''), '{PRETOKEN}')"


def char_ids(x: str, offset: int = 5) -> str:
    return f"list_transform(string_split({x}, ''), lambda ch: CAST(unicode(ch) + {offset} AS INTEGER))"


def pad_truncate(ids: str, length: int, pad: int) -> str:
    return f"list_slice(list_concat({ids}, list_resize([{pad}], {length}, {pad})), 1, {length})"


CLEAN = (
    "clean AS (SELECT row_key, " + strip("src") + " AS src, " + strip("tgt") + " AS tgt, src_len, tgt_len "
    "FROM c WHERE reason IS NULL)"
)
