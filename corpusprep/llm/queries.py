"""Registered queries of this folder and, where SQL can express them, their DuckDB SQL."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.llm import contexttree, decontaminate, langid, licenses, lshforest, packing, quality_rules, repair, repeats, resample, variants, warc, wrappers
from corpusprep.session import shared_path, ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Register ``fn`` under its own name; the package is made importable on the executors first."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """A vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pieces(read(spark, sf_dir, "documents"), tokenizer_path())


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.measure(read(spark, sf_dir, "documents"))


def _op4_sql() -> str:
    rules = quality_rules.RepetitionRules()
    lengths = sorted({3, *rules.coverage})
    cover = ", ".join(
        f"max(CASE WHEN d{n} THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) = 1 AS c{n}"
        for n in lengths)
    twice = ", ".join(
        f"i + {n - 1} <= n_words AND count(*) OVER (PARTITION BY doc_id, list_slice(ws, i, i + {n - 1})) > 1 AS d{n}" for n in lengths)
    sums = ", ".join(
        [*(f"coalesce(sum(CASE WHEN c{n} THEN length(w) END), 0) AS dup_chars_{n}" for n in sorted(rules.coverage)),
         "coalesce(sum(CASE WHEN c3 THEN 1 END), 0) AS n_repeat_words"])
    names = [f"dup_chars_{n}" for n in sorted(rules.coverage)]
    ok = " AND ".join([f"100 * dup_line_chars <= {rules.line_coverage} * word_chars",
                       *(f"100 * dup_chars_{n} <= {m} * word_chars" for n, m in rules.coverage.items())])
    base = f"(n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.max_repeat_words} * n_words)"
    word = r"'[^\x20\x09-\x0D]+'"
    return rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
ws AS (SELECT doc_id, text, regexp_extract_all(text, {word}) AS ws FROM t),
a AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
        CAST(coalesce(list_sum([length(x) for x in ws]), 0) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols FROM ws),
lines AS (SELECT doc_id, generate_subscripts(ls, 1) AS k, unnest(ls) AS line
          FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM t)),
lw AS (SELECT doc_id, k, line, list_sum([length(x) for x in regexp_extract_all(line, {word})]) AS chars,
         row_number() OVER (PARTITION BY doc_id, line ORDER BY k) AS nth
       FROM lines WHERE regexp_matches(line, {word})),
l AS (SELECT doc_id, count(*) AS n_dup_lines, sum(chars) AS dup_line_chars FROM lw WHERE nth > 1 GROUP BY doc_id),
w AS (SELECT doc_id, generate_subscripts(ws, 1) AS i, unnest(ws) AS w, ws, len(ws) AS n_words FROM ws),
g AS (SELECT doc_id, i, w, {twice} FROM w),
c AS (SELECT doc_id, i, w, {cover} FROM g),
s AS (SELECT doc_id, {sums} FROM c GROUP BY doc_id),
f AS (SELECT a.doc_id, n_words, word_chars, n_symbols, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
        CAST(coalesce(dup_line_chars, 0) AS BIGINT) AS dup_line_chars,
        {", ".join(f"CAST(coalesce({n}, 0) AS BIGINT) AS {n}" for n in names)}
      FROM a LEFT JOIN l USING (doc_id) LEFT JOIN s USING (doc_id))
SELECT *, {base} AS base_failed, NOT {base} AND {ok} AS kept FROM f
"""


ORACLE["op4_quality_rules"] = _op4_sql()


@query
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.judge(decontaminate.find(documents, read(spark, sf_dir, "benchmark")))
    return found.select(
        F.col("c0").alias("doc_id"), "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


ORACLE["op3_decontaminate"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bw AS (SELECT item_id, unnest(range(1, greatest(len(ws) - 13, 0) + 2)) AS i, ws FROM b WHERE len(ws) > 0),
win AS (SELECT DISTINCT item_id, list_slice(ws, i, i + 12) AS win FROM bw),
lens AS (SELECT DISTINCT len(win) AS m FROM win),
dw AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM d),
occ AS (SELECT doc_id, i, m, item_id FROM dw JOIN lens ON i + m - 1 <= len(ws) JOIN win ON win = list_slice(ws, i, i + m - 1)),
hit AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + m)) FROM occ) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM occ) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""


@query
def op7_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.spans(read(spark, sf_dir, "documents"))


@query
def op10_jaccard_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lshforest.join(read(spark, sf_dir, "documents"))


@query
def op5_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Draws the share that the labels call good, by words and pairs of words; the target model counts every good row."""
    how = resample.Resampling(longest=2, buckets=1 << 18)
    return resample.select(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), F.expr("quality = 1 AND toxic = 0"), how=how)


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read(spark, sf_dir, "pages"), read(spark, sf_dir, "documents"))


@query
def op8_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(read(spark, sf_dir, "pages"))


@query
def op6_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.archive_folder(spark)
    pages = read(spark, sf_dir, "pages")
    index = warc.write(pages, folder)
    key = pages.schema["page_id"].dataType.simpleString()
    return warc.read(index, folder, payloads=False).select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers").cast(key).alias("refers_to"))


@query
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


@query
def op13_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = contexttree.held_out("doc_id")
    scored = contexttree.score(read(spark, sf_dir, "documents"), ~held)
    return scored.select("doc_id", (~F.col("trained")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes")


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_path(spark, "variant-words")
    variants.damaged_words(read(spark, sf_dir, "documents")).write.parquet(folder)
    return variants.variants(spark.read.parquet(folder))


def _crc32_sql(text: str) -> str:
    """Unsigned crc32 of the UTF-8 of a text without code points above U+FFFF."""
    table = []
    for entry in range(256):
        for _ in range(8):
            entry = entry >> 1 ^ (0xEDB88320 if entry & 1 else 0)
        table.append(entry)
    utf8 = ("CASE WHEN c < 128 THEN [c] WHEN c < 2048 THEN [192 | (c >> 6), 128 | (c & 63)] "
            "ELSE [224 | (c >> 12), 128 | ((c >> 6) & 63), 128 | (c & 63)] END")
    data = f"flatten(list_transform([CAST(unicode(x) AS BIGINT) FOR x IN string_split({text}, '') IF x <> ''], lambda c: {utf8}))"
    return (f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {data}), "
            f"lambda a, b: xor(a >> 8, ({table})[1 + (xor(a, b) & 255)])), 4294967295)")


ORACLE["op11_spelling_variants"] = rf"""
WITH RECURSIVE runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[A-Za-z\x{{C0}}-\x{{FF}}]{{7,}}')) AS run FROM documents),
times AS (SELECT doc_id, run, count(*) AS k FROM runs GROUP BY ALL),
hashed AS (SELECT run, k, {_crc32_sql("concat(doc_id, ':', run)")} AS h FROM times),
cut AS (SELECT k, CASE WHEN h % 31 = 0 THEN concat(substr(run, 1, h % length(run)), substr(run, 2 + h % length(run))) ELSE run END AS word FROM hashed),
words AS MATERIALIZED (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
shorter AS (SELECT word, i, concat(substr(word, 1, i - 1), substr(word, i + 1)) AS rest
            FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (SELECT a.word, b.word AS other FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
         UNION SELECT s.word, w.word FROM shorter s JOIN words w ON w.word = s.rest
         UNION SELECT w.word, s.word FROM shorter s JOIN words w ON w.word = s.rest),
ranked AS (SELECT a.word, other, o.n, count(*) OVER (PARTITION BY a.word) AS n_near, row_number() OVER (PARTITION BY a.word ORDER BY o.n DESC, other) AS nth
           FROM near a JOIN words o ON o.word = other),
formed AS MATERIALIZED (SELECT w.word, CASE WHEN r.n >= 10 * w.n THEN r.other END AS form, w.n, CAST(coalesce(r.n_near, 0) AS BIGINT) AS n_near,
             CASE WHEN r.n >= 10 * w.n THEN r.n END AS form_n FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.nth = 1),
chain AS (SELECT word, word AS root FROM formed UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON f.word = c.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM formed f JOIN chain c USING (word)
JOIN formed e ON e.word = c.root AND e.form IS NULL
"""


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(repair.damage(read(spark, sf_dir, "conversations")), gone=F.col("gone"))


ORACLE["op12_conversation_repair"] = rf"""
WITH RECURSIVE hashed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32_sql("concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS h FROM conversations),
hurt AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN h = 1 THEN '' WHEN h = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN h = 3 THEN [1, 2] ELSE [1] END) AS copy FROM hashed WHERE h <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
    right(regexp_replace(text, '[\x20\x09-\x0D]+$', ''), 1) AS ending FROM hurt),
turns AS MATERIALIZED (SELECT conv_id, turn, role, text, i, left(role, 1) AS r, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
    CASE WHEN ending = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN ending NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM placed),
figures AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || r NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM turns GROUP BY conv_id),
inserts(a, b, letters, price, said) AS (VALUES (0, 0, '', 0, []), (1, 1, '', 0, []), (2, 2, '', 0, []), (3, 3, '', 0, []),
    (0, 2, 'I', 5, ['user:']), (1, 2, 'I', 5, ['user:']), (3, 2, 'I', 5, ['user:']), (2, 3, 'I', 5, ['assistant:']),
    (0, 3, 'II', 10, ['user:', 'assistant:']), (1, 3, 'II', 10, ['user:', 'assistant:'])),
edits(a, b, letter, price, needs, as_role) AS (VALUES (0, 0, 'D', 2, '', ''), (1, 1, 'D', 2, '', ''), (2, 2, 'D', 2, '', ''), (3, 3, 'D', 2, '', ''),
    (0, 1, 'K', 0, 's', ''), (0, 2, 'K', 0, 'u', ''), (1, 2, 'K', 0, 'u', ''), (3, 2, 'K', 0, 'u', ''), (2, 3, 'K', 0, 'a', ''),
    (0, 2, 'R', 1, '', 'user'), (1, 2, 'R', 1, '', 'user'), (3, 2, 'R', 1, '', 'user'), (2, 3, 'R', 1, '', 'assistant')),
moves AS MATERIALIZED (SELECT p.a, e.b, p.letters || e.letter AS letters, e.letter, p.price + e.price AS price, p.said, e.needs, e.as_role FROM inserts p JOIN edits e ON p.b = e.a),
step AS (SELECT conv_id, 0 AS i, 0 AS state, 0 AS cost, '' AS audit, CAST([] AS VARCHAR[]) AS said FROM figures
    UNION ALL
    (SELECT s.conv_id, s.i + 1, m.b, s.cost + m.price + CASE WHEN t.fault = 'truncated' AND m.letter <> 'D' THEN 5 ELSE 0 END, s.audit || m.letters,
        list_concat(s.said, m.said, CASE m.letter WHEN 'D' THEN [] WHEN 'K' THEN [t.role || ':' || t.text] ELSE [m.as_role || ':' || t.text] END)
     FROM step s JOIN turns t ON t.conv_id IS NOT DISTINCT FROM s.conv_id AND t.i = s.i + 1
     JOIN moves m ON m.a = s.state AND (m.letter = 'D' OR t.fault NOT IN ('blank', 'duplicate')) AND (m.needs = '' OR m.needs = t.r)
     QUALIFY row_number() OVER (PARTITION BY s.conv_id, m.b ORDER BY s.cost + m.price + CASE WHEN t.fault = 'truncated' AND m.letter <> 'D' THEN 5 ELSE 0 END, s.audit || m.letters) = 1)),
done AS (SELECT s.conv_id, s.cost + p.price AS cost, s.audit || p.letters AS audit, list_concat(s.said, p.said) AS said,
     row_number() OVER (PARTITION BY s.conv_id ORDER BY s.cost + p.price, s.audit || p.letters) AS nth
     FROM step s JOIN figures f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.n = s.i JOIN inserts p ON p.a = s.state AND p.b IN (0, 3))
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
    CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
    coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(said, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN figures f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM c.conv_id AND d.nth = 1
"""


ORACLE["op6_warc_index"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
s AS (SELECT page_id, body, sha1(body) AS h, min(page_id) OVER (PARTITION BY body) AS first FROM p),
b AS (SELECT *, [CAST('0x' || substr(h, 5 * k + 1, 5) AS BIGINT) FOR k IN range(8)] AS parts FROM s)
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes,
    array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((parts[1 + i // 4] >> (15 - 5 * (i % 4))) & 31), 1) FOR i IN range(32)], '') AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM b
"""

ORACLE["op10_jaccard_forest"] = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN [array_to_string(list_slice(ws, i, i + 4), ' ') FOR i IN range(1, len(ws) - 3)]
      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS gram FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 10 * k >= 8 * (x.n + y.n - k)),
edges AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM reach r JOIN edges e ON e.a = r.b),
classes AS (SELECT a AS doc_id, min(b) AS class_id FROM reach GROUP BY a),
counts AS (SELECT a AS doc_id, count(*) AS n_links FROM edges GROUP BY a)
SELECT doc_id, class_id, coalesce(n_links, 0) AS n_links FROM classes LEFT JOIN counts USING (doc_id)
"""
