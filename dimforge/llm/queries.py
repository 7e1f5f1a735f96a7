"""The operators bound to the driver tables, one query each, with DuckDB SQL
where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dimforge.llm import blocks, bytelang, codes, crf, licences, manifest, packing, pieces, quality, ring, simhash, sphere, urlrules
from dimforge.llm.common import table

SHARDS = 40
SITE_RULES = [urlrules.site_rule("net/", "block"), urlrules.site_rule("example.net/en/", "allow"),
              urlrules.site_rule("example.com/de/", "block"), urlrules.site_rule("org/fr/", "allow")]
PATTERN_RULES = [urlrules.Rule(p, p, "block") for p in (
    "||spam-farm.", "||casino-win.", "/ads/", "/adserver/", "/popunder^", "?affid=", "&affid=", "||doubleclick.")]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.line_rules(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                        "kept", "removed_words")


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = urlrules.apply_url_rules(table(spark, sf_dir, "pages"), SITE_RULES + PATTERN_RULES)
    is_site = F.col("rule").isin([r.name for r in SITE_RULES])
    return found.select("page_id", "host", "path", F.when(is_site, F.col("rule")).alias("rule"),
                        F.coalesce("action", F.lit("allow")).alias("verdict"),
                        F.when(~is_site, F.col("rule")).alias("pattern"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan_licences(table(spark, sf_dir, "documents"))
    return found.withColumn("notices", F.array_join("notices", ","))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.extract_main_text(table(spark, sf_dir, "pages"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                        keep_ids=False).drop("ids")


def op7_embedding_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sphere.embedding_components(table(spark, sf_dir, "embeddings"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytelang.identify(table(spark, sf_dir, "documents"))


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    found = pieces.encode_texts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return found.select("doc_id", "n_ids", F.crc32(F.coalesce("ids", F.lit("").cast("binary"))).alias("ids_crc32"),
                        "lossless")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ring.shard(table(spark, sf_dir, "documents"), SHARDS)
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"), "home_shard")


def _tampered(id_col: Column) -> Column:
    """Rows whose text is checked in lower case: 3 divides the crc32 of the id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 0, F.lit(False))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lower = F.translate("text", licences.UPPER, licences.LOWER)
    text = F.when(_tampered(F.col("doc_id")), lower).otherwise(F.col("text"))
    found = manifest.manifest(table(spark, sf_dir, "documents"),
                              claim=manifest.leaf(*map(F.col, ("doc_id", "source", "lang", "n_chars")), text))
    folded = found.select("doc_id", "leaf", "subroot", "root", manifest.proof_digest(F.col("steps")).alias("proof_sha256"),
                          manifest.folded_root(F.col("steps"), F.col("claim")).alias("folded_root"))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crf.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, books = codes.compress(table(spark, sf_dir, "embeddings"))
    return found.withColumn("codebooks_sha256", F.lit(codes.books_digest(books)))


WORDS = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"
FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000')"

OP1_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT r, unnest(regexp_extract_all(t, '{WORDS}')) AS word, generate_subscripts(regexp_extract_all(t, '{WORDS}'), 1) AS i FROM d
), five AS (
  SELECT r, i, word || chr(0) || lead(word, 1) OVER p || chr(0) || lead(word, 2) OVER p || chr(0) || lead(word, 3) OVER p
         || chr(0) || lead(word, 4) OVER p AS x
  FROM w WINDOW p AS (PARTITION BY r ORDER BY i)
), rep AS (
  SELECT r, i, x IS NOT NULL AND count(*) OVER (PARTITION BY r, x) > 1 AS twice FROM five
), cov AS (
  SELECT r, count(*) FILTER (WHERE c) AS n_repeat_words
  FROM (SELECT r, bool_or(twice) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS c FROM rep) GROUP BY r
), allw AS (
  SELECT r, count(*) AS n_words, sum(length(word)) AS word_chars,
         sum(length(regexp_replace(word, '[^#*$%&|<>]', '', 'g'))) AS n_symbols
  FROM w GROUP BY r
), ln AS (
  SELECT r, source, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS place FROM d
), nl AS (
  SELECT r, source, place, line, regexp_extract_all(line, '{WORDS}') AS ws,
         {FOLD.format(f"array_to_string(regexp_extract_all(line, '{WORDS}'), ' ')")} AS norm,
         len(regexp_extract_all(line, '{WORDS}')) AS n FROM ln
), dup AS (
  SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM nl WHERE n > 0 GROUP BY r
), held AS (
  SELECT r, source, norm, sum(n) AS n, arg_min(ws, place) AS ws FROM nl WHERE n > 0 GROUP BY ALL
), many AS (
  SELECT source, norm FROM held GROUP BY ALL HAVING count(*) > {quality.MIN_LINE_DOCS}
), marked AS (
  SELECT held.*, many.norm IS NOT NULL AS candidate
  FROM held LEFT JOIN many ON held.norm = many.norm AND held.source IS NOT DISTINCT FROM many.source
), rests AS (
  SELECT d.r, d.source, coalesce(sum(m.n) FILTER (WHERE NOT candidate), 0) AS rest FROM d LEFT JOIN marked m USING (r) GROUP BY ALL
), windows AS (
  SELECT r, source, md5(array_to_string(ws[i : least(i + {quality.SIGNATURE_WINDOW - 1}, len(ws))], ' ')) AS h
  FROM (SELECT r, source, ws, unnest(range(1, greatest(1, len(ws) - {quality.SIGNATURE_WINDOW - 1}) + 1)) AS i
        FROM marked JOIN (SELECT r, rest FROM rests) USING (r) WHERE NOT candidate AND rest >= {quality.MIN_WORDS})
), lows AS (
  SELECT r, source, k, min(substr(h || h, 4 * k + 1, 16)) AS low
  FROM windows, (SELECT unnest(range({quality.MINIMA})) AS k) GROUP BY ALL
), twins AS (
  SELECT r FROM (SELECT r, count(*) OVER (PARTITION BY source, k, low) AS c FROM lows)
  WHERE c > {quality.MIN_LINE_DOCS} GROUP BY r HAVING count(*) >= {quality.SHARED_MINIMA}
), docs AS (
  SELECT rests.r, rests.source, CASE WHEN rest < {quality.MIN_WORDS} OR twins.r IS NOT NULL THEN '' ELSE sketch END AS doc
  FROM rests LEFT JOIN twins USING (r) LEFT JOIN (SELECT r, string_agg(low, '' ORDER BY k) AS sketch FROM lows GROUP BY r) USING (r)
), hosts AS (
  SELECT source, count(DISTINCT doc) AS host_docs FROM docs GROUP BY source
), above AS (
  SELECT m.source, norm FROM marked m JOIN docs USING (r) JOIN hosts ON m.source IS NOT DISTINCT FROM hosts.source
  WHERE candidate GROUP BY m.source, norm
  HAVING count(DISTINCT doc) > {quality.MIN_LINE_DOCS}
     AND count(DISTINCT doc) > least(any_value(host_docs) * {quality.LINE_SHARE}::DOUBLE, {quality.MAX_LINE_DOCS})
), gone AS (
  SELECT r, sum(n) AS removed FROM held JOIN above ON held.norm = above.norm AND held.source IS NOT DISTINCT FROM above.source GROUP BY r
), f AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars, coalesce(n_symbols, 0) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(removed, 0) AS removed
  FROM d LEFT JOIN allw USING (r) LEFT JOIN cov USING (r) LEFT JOIN dup USING (r) LEFT JOIN gone USING (r)
), b AS (
  SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM f
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND NOT (removed > 0 AND (n_words - removed < {quality.MIN_WORDS_LEFT}
            OR n_words - removed < n_words * {quality.MIN_SHARE_LEFT}::DOUBLE)) AS kept, removed::BIGINT AS removed_words
FROM b
"""

OP2_SQL = r"""
WITH a AS (
  SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS u FROM pages
), h AS (
  SELECT page_id, u, regexp_extract(u, '^[^/?#]*') AS raw FROM a
), p AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(u, length(raw) + 1), '^[^?#]*') AS path, substr(u, length(raw) + 1) AS tail FROM h
), c AS (
  SELECT page_id, host, path, host || tail AS target,
    CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
         WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
         WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
         WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM p
), v AS (
  SELECT *, CASE WHEN contains(target, '&affid=') THEN '&affid='
                 WHEN contains(target, '/ads/') THEN '/ads/'
                 WHEN contains(target, '/adserver/') THEN '/adserver/'
                 WHEN regexp_matches(target, '/popunder([^A-Za-z0-9_.%-]|$)') THEN '/popunder^'
                 WHEN contains(target, '?affid=') THEN '?affid='
                 WHEN starts_with(host, 'casino-win.') OR contains(host, '.casino-win.') THEN '||casino-win.'
                 WHEN starts_with(host, 'doubleclick.') OR contains(host, '.doubleclick.') THEN '||doubleclick.'
                 WHEN starts_with(host, 'spam-farm.') OR contains(host, '.spam-farm.') THEN '||spam-farm.' END AS pat
  FROM c
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN pat IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
       CASE WHEN rule IS NULL THEN pat END AS pattern
FROM v
"""


def _canonical_sql(text: str) -> str:
    """DuckDB expression for the list of canonical lines of ``text``."""
    t = f"translate(coalesce({text}, ''), '{licences.UPPER}', '{licences.LOWER}')"
    t = f"regexp_replace(regexp_replace({t}, '{licences.MARKS}', '  ', 'g'), '\\n', chr(32)||chr(32)||chr(10)||chr(32)||chr(32), 'g')"
    t = f"'  ' || regexp_replace({t}, ' {{2,}}', '  ', 'g') || '  '"
    for old, new in licences.EQUIVALENT:
        t = f"replace({t}, ' {old} ', ' {new} ')"
    t = f"regexp_replace(regexp_replace({t}, ' {{2,}}', ' ', 'g'), ' ?\\n ?', chr(10), 'g')"
    return (f"list_filter(string_split(trim({t}, ' '), chr(10)), lambda x: x <> '' AND (NOT regexp_matches(x, "
            f"'{licences.COPYRIGHT_LINE}') OR regexp_matches(x, '{licences.COPYRIGHT_TERMS}')))")


def _values(rows: tuple) -> str:
    return ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in rows)


OP3_SQL = f"""
WITH known_text AS (
  SELECT array_to_string({_canonical_sql('t')}, ' ') AS c, min(n) AS license FROM (VALUES {_values(licences.TEXTS)}) v(n, t) GROUP BY 1
), known_notice AS (
  SELECT array_to_string({_canonical_sql('t')}, ' ') AS c, min(n) AS notice FROM (VALUES {_values(licences.NOTICES)}) v(n, t) GROUP BY 1
), d AS (
  SELECT row_number() OVER () AS r, doc_id, {_canonical_sql('text')} AS lines FROM documents
), hit AS (
  SELECT r, string_agg(DISTINCT notice, ',' ORDER BY notice) AS notices, count(DISTINCT notice) AS n
  FROM (SELECT r, unnest(lines) AS line FROM d) JOIN known_notice ON line = c GROUP BY r
)
SELECT doc_id, md5(array_to_string(lines, ' ')) AS digest, license, coalesce(notices, '') AS notices,
       coalesce(n, 0)::BIGINT AS n_notices
FROM d LEFT JOIN known_text ON array_to_string(lines, ' ') = c LEFT JOIN hit USING (r)
"""

_FIELDS = ("doc_id", "source", "lang", "n_chars")


def _leaf_sql(text: str) -> str:
    parts = [f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in (*_FIELDS, text)]
    return f"sha256({' || '.join(parts)})"


# crc32 of decimal digits, bit by bit (fixed value: its polynomial).
_CRC32_SQL = """xor(4294967295, list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split({}, ''),
    lambda d: ascii(d)::UBIGINT)), lambda c, b: list_reduce(list_prepend(xor(c, b), list_transform(range(8), lambda i: i::UBIGINT)),
    lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END)))"""

OP11_SQL = f"""
WITH RECURSIVE d AS (
  SELECT *, coalesce({_CRC32_SQL.format('doc_id::VARCHAR')} % 3 = 0, false) AS other FROM documents
), leaves AS (
  SELECT doc_id, lang, {_leaf_sql('text')} AS leaf,
         {_leaf_sql(f"CASE WHEN other THEN translate(text, '{licences.UPPER}', '{licences.LOWER}') ELSE text END")} AS claim FROM d
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY lang) AS n, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS grp FROM leaves
), tree AS (
  SELECT grp, 0 AS level, pos AS i, n, leaf AS digest FROM ranked
  UNION ALL
  SELECT grp, level + 1, i // 8, (any_value(n) + 7) // 8, sha256(string_agg(digest, '' ORDER BY i))
  FROM tree WHERE n > 1 GROUP BY grp, level, i // 8
), top AS (
  SELECT 0 AS level, grp AS i, (SELECT count(DISTINCT grp) FROM ranked) AS n, digest FROM tree WHERE n = 1
  UNION ALL
  SELECT level + 1, i // 8, (any_value(n) + 7) // 8, sha256(string_agg(digest, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY level, i // 8
), above AS (
  SELECT grp, level, i, n, digest FROM tree
  UNION ALL
  SELECT g.grp, 1000 + level, i, n, digest FROM top, (SELECT DISTINCT grp FROM ranked) g
), runs AS (
  SELECT grp, level, i // 8 AS run, list({{'i': i, 'd': digest}} ORDER BY i) AS kids FROM above WHERE n > 1 GROUP BY ALL
), paths AS (
  SELECT r.grp, r.pos, x.level, list_transform(list_filter(kids, lambda k: k.i < p.i), lambda k: k.d) AS b,
         list_transform(list_filter(kids, lambda k: k.i > p.i), lambda k: k.d) AS a
  FROM ranked r JOIN runs x ON x.grp = r.grp
  CROSS JOIN LATERAL (SELECT CASE WHEN x.level < 1000 THEN r.pos // (8::BIGINT ** x.level)::BIGINT
                                  ELSE r.grp // (8::BIGINT ** (x.level - 1000))::BIGINT END AS i) p
  WHERE x.run = p.i // 8
), proofs AS (
  SELECT grp, pos, list({{'b': array_to_string(b, ''), 'a': array_to_string(a, '')}} ORDER BY level) AS steps FROM paths GROUP BY ALL
), out AS (
  SELECT r.doc_id, r.leaf, s.digest AS subroot, (SELECT digest FROM top WHERE n = 1) AS root,
         sha256(coalesce(array_to_string(list_transform(steps, lambda x: x.b || x.a), ''), '')) AS proof_sha256,
         list_reduce(list_prepend({{'b': r.claim, 'a': ''}}, coalesce(steps, [])),
                     lambda x, y: {{'b': sha256(y.b || x.b || y.a), 'a': ''}}).b AS folded_root
  FROM ranked r LEFT JOIN proofs USING (grp, pos) JOIN tree s ON s.grp = r.grp AND s.n = 1
)
SELECT *, folded_root = root AS verified FROM out
"""

def _lloyd_sql() -> str:
    """Every round as a pair of common table expressions."""
    assign = """a{r} AS MATERIALIZED (
  SELECT p, rid, x, arg_min(e, (dist, e)) AS e, min(dist) AS dist FROM (
    SELECT parts.p, rid, x, e, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS dist
    FROM parts JOIN c{r} USING (p)) GROUP BY p, rid, x
)"""
    update = """s{r} AS (
  SELECT p, e, i, sum(x[i])::BIGINT AS s, count(*) AS n FROM (SELECT p, e, x, unnest(range(1, len(x) + 1)) AS i FROM a{r}) GROUP BY p, e, i
), c{next} AS MATERIALIZED (
  SELECT p, e, coalesce(m.c, c{r}.c) AS c FROM c{r}
  LEFT JOIN (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM s{r} GROUP BY p, e) m USING (p, e)
)"""
    steps = [step.format(r=r, next=r + 1) for r in range(codes.ROUNDS) for step in (assign, update)]
    return ", ".join([*steps, assign.format(r=codes.ROUNDS)])


OP13_SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) - 1 AS rid, vec_id, label,
         list_transform(embedding, lambda x: floor({codes.SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT rid, p, v[p * (len(v) // {codes.PARTS}) + 1 : (p + 1) * (len(v) // {codes.PARTS})] AS x
  FROM (SELECT rid, v, unnest(range({codes.PARTS})) AS p FROM kept)
), c0 AS (
  SELECT p, rid AS e, x AS c FROM parts WHERE rid < {codes.ENTRIES}
), {_lloyd_sql()}, books AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c{codes.ROUNDS}
), coded AS (
  SELECT rid, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(dist)::BIGINT AS error FROM a{codes.ROUNDS} GROUP BY rid
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN kept USING (rid), books
"""

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_quality_rules": (op1_quality_rules, OP1_SQL),
    "op2_url_filters": (op2_url_filters, OP2_SQL),
    "op3_license_scan": (op3_license_scan, OP3_SQL),
    "op4_main_text": (op4_main_text, None),
    "op5_simhash": (op5_simhash, None),
    "op6_packing": (op6_packing, None),
    "op7_embedding_dups": (op7_embedding_dups, None),
    "op8_language_id": (op8_language_id, None),
    "op9_pieces": (op9_pieces, None),
    "op10_sharding": (op10_sharding, None),
    "op11_merkle_manifest": (op11_merkle_manifest, OP11_SQL),
    "op12_line_quality": (op12_line_quality, None),
    "op13_vector_codes": (op13_vector_codes, OP13_SQL),
}
