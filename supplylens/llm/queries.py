"""The operators' queries over whole tables, and the same results as DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat,
    exact_dedup,
    language,
    licenses,
    lm_score,
    merkle,
    near_join,
    packing,
    piece_codec,
    quality_rules,
    simhash,
    suffix_dedup,
    whitening,
)
from .vocabularies import vocabulary

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = r"'[^\x20\x09-\x0D]+'"
_LOWER_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), {_WORDS})"


@_query()
def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(
        _documents(spark, folder), vocabulary("word_bpe_49k.json"), give={"ids_crc32": F.crc32("ids")}
    )


_QUOTED, _BLANKS, _BETWEEN = r"'^[ \t]*(>[ \t]*)+'", r"'[ \t\n\x0B\f\r]+'", r"'\n[ \t]*\n'"


def _normal(text: str) -> str:
    return f"trim(regexp_replace(lower({text}), {_BLANKS}, ' ', 'g'), ' ')"


@_query(
    rf"""
    WITH RECURSIVE m AS (
        SELECT row_number() OVER () AS r, conv_id, turn, role,
            string_split_regex(coalesce(text, ''), '\r?\n') AS lines FROM conversations),
    x AS (SELECT r, conv_id, turn, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM m),
    y AS (SELECT *, length(regexp_replace(regexp_extract(line, {_QUOTED}), '[^>]', '', 'g')) AS level FROM x),
    l AS (SELECT *, level IS DISTINCT FROM lag(level) OVER w AS begins,
                 level = 0 AND coalesce(lead(level) OVER w, 0) > 0
                     AND regexp_matches(line, '(?i)^[ \t]*(on\b.*\bwrote|.{{1,80}}\b(wrote|writes)):[ \t]*$') AS announces
          FROM y WINDOW w AS (PARTITION BY r ORDER BY i)),
    own AS (SELECT r, conv_id, turn, trim(coalesce(string_agg(line, chr(10) ORDER BY i)
                FILTER (level = 0 AND NOT announces), ''), ' ') AS own FROM l GROUP BY ALL),
    runs AS (SELECT r, conv_id, turn, level, string_agg(CASE WHEN level > 0 THEN regexp_replace(line, {_QUOTED}, '')
                WHEN announces THEN '' ELSE line END, chr(10) ORDER BY i) AS p
             FROM (SELECT *, sum(begins::int) OVER (PARTITION BY r ORDER BY i) AS part FROM l) GROUP BY r, conv_id, turn, level, part),
    q AS (SELECT * FROM runs WHERE level > 0 AND trim(p, ' ') <> ''),
    said AS (SELECT DISTINCT conv_id, turn, {_normal('u')} AS h FROM (
            SELECT conv_id, turn, unnest([own] || string_split_regex(own, {_BETWEEN}) || string_split(own, chr(10))) AS u FROM own
            UNION ALL SELECT conv_id, turn, unnest([p] || string_split_regex(p, {_BETWEEN})) FROM runs WHERE level = 0)
        WHERE trim(u, ' ') <> ''),
    units AS (SELECT conv_id, turn, level, p, 0 AS kind, [p] AS us FROM q
        UNION ALL SELECT conv_id, turn, level, p, 1, list_filter(string_split_regex(p, {_BETWEEN}), lambda u: trim(u, ' ') <> '') FROM q
        UNION ALL SELECT conv_id, turn, level, p, 2, list_filter(string_split(p, chr(10)), lambda u: trim(u, ' ') <> '') FROM q),
    asked AS (SELECT DISTINCT conv_id, turn, level, {_normal('p')} AS p, kind, {_normal('u')} AS h
              FROM (SELECT *, unnest(us) AS u FROM units WHERE kind = 0 OR len(us) > 1)),
    hits AS (SELECT asked.*, max(said.turn) AS t
        FROM asked JOIN said ON said.conv_id = asked.conv_id AND said.h = asked.h AND said.turn < asked.turn GROUP BY ALL),
    found AS (SELECT conv_id, turn, level, p, arg_max(t, (-kind, n, t)) AS t FROM (
            SELECT conv_id, turn, level, p, kind, t, count(*) AS n FROM hits GROUP BY ALL) GROUP BY conv_id, turn, level, p),
    answers AS (SELECT conv_id, turn, count(*) AS linked, arg_min(t, (level, -t)) AS up FROM found GROUP BY ALL),
    paths AS (SELECT conv_id, turn, [up, turn] AS path, up AS top FROM answers
        UNION ALL SELECT p.conv_id, p.turn, [a.up] || path, a.up FROM paths p JOIN answers a ON a.conv_id = p.conv_id AND a.turn = p.top),
    whole AS (SELECT conv_id, turn, arg_max(path, len(path)) AS path FROM paths GROUP BY ALL),
    nodes AS (SELECT * FROM whole UNION SELECT conv_id, path[1], [path[1]] FROM whole),
    placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id, path[1] ORDER BY path) - 1 AS place FROM nodes)
    SELECT m.conv_id, m.turn, role, up AS reply_to, coalesce(len(path) - 1, 0)::INTEGER AS depth,
        (SELECT count(*) FROM q WHERE q.r = m.r)::INTEGER AS n_quotes, coalesce(linked, 0)::INTEGER AS n_linked,
        coalesce(path[1], m.turn) AS thread, coalesce(place, 0) AS place, own AS text
    FROM m JOIN own USING (r) LEFT JOIN answers a ON a.conv_id = m.conv_id AND a.turn = m.turn
    LEFT JOIN placed ON placed.conv_id = m.conv_id AND placed.turn = m.turn
    """
)
def op2_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    return chat.reply_order(spark.read.parquet(f"{folder}/conversations.parquet"))


@_query(
    f"""
    WITH rows AS (SELECT doc_id, translate(coalesce(text, ''), '{_UP}', '{_LOW}') AS t FROM documents)
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
    FROM rows WINDOW same AS (PARTITION BY t)
    """
)
def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = exact_dedup.exact_duplicates(_documents(spark, folder))
    return found.withColumnRenamed("text_digest", "text_sha256")


@_query(
    f"""
    WITH RECURSIVE d AS (SELECT doc_id, {_LOWER_WORDS} AS w FROM documents),
    s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
            ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS g
          FROM d),
    x AS (SELECT doc_id, len(g) AS n, unnest(g) AS g FROM s),
    links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id
        GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
    reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
    least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
    SELECT doc_id, len(g)::BIGINT AS n_shingles, coalesce(least.b, doc_id) AS component_id FROM s LEFT JOIN least ON a = doc_id
    """
)
def op4_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return near_join.near_components(_documents(spark, folder), size=3, num=9, den=10)


@_query()
def op5_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    coded = piece_codec.encode_and_decode(_documents(spark, folder), vocabulary("piece_bpe_32k.model"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.encode(F.array_join(F.col("ids").cast("array<string>"), ","), "UTF-8"), 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


@_query()
def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder)
    held_out = language.id_remainder("doc_id", 4) == 2
    model = language.train(docs.where(~held_out))
    return model.annotate(docs.select("doc_id", held_out.alias("held_out"), "text")).drop("text")


@_query()
def op7_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    held_out = language.id_remainder("doc_id", 5) == 1
    docs = _documents(spark, folder).select("doc_id", "text", (~held_out).alias("train"))
    return lm_score.score(docs, "train", updates=lm_score.UPDATES).withColumn("held_out", held_out)


@_query(
    f"""
    WITH d AS (SELECT doc_id, {_LOWER_WORDS} AS w FROM documents),
    p AS (SELECT doc_id, w, unnest(range(0, len(w) - 49)) AS pos FROM d),
    x AS (SELECT doc_id, pos, md5(array_to_string(w[pos + 1:pos + 50], ' ')) AS win FROM p),
    many AS (SELECT win, min(doc_id) AS first FROM x GROUP BY win HAVING count(DISTINCT doc_id) > 1),
    hits AS (SELECT doc_id, pos, first, pos - lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) > 50 AS begins FROM x JOIN many USING (win)),
    parts AS (SELECT *, sum(coalesce(begins, true)::INT) OVER (PARTITION BY doc_id ORDER BY pos) AS part FROM hits)
    SELECT doc_id, min(pos)::BIGINT AS start_word, (max(pos) + 50 - min(pos))::BIGINT AS n_words, min(first) AS first_doc_id
    FROM parts GROUP BY doc_id, part
    """
)
def op8_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix_dedup.repeated_passages(_documents(spark, folder))
    rows = found.select("doc_id", F.explode("passages").alias("p"))
    return rows.select(
        "doc_id",
        F.col("p.start").cast("long").alias("start_word"),
        (F.col("p.end") - F.col("p.start")).cast("long").alias("n_words"),
        F.col("p.keeper").alias("first_doc_id"),
    )


@_query()
def op9_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan_licenses(_documents(spark, folder))
    base = F.filter("hits", lambda h: h["kind"] == "base")
    return found.withColumn("base", base).select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.start").alias("first_word"),
        F.array_max("base.start").alias("last_word"),
        F.array_join(F.sort_array(F.array_distinct("base.label")), ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
        F.array_join("expressions", "; ").alias("expressions"),
        "permissive",
    )


@_query(
    rf"""
    WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
    w AS (SELECT *, regexp_extract_all(t, {_WORDS}) AS words,
                 list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, {_WORDS})) AS lines FROM d),
    g AS (SELECT doc_id, i, struct_pack(a := words[i], b := words[i + 1], c := words[i + 2]) AS win
          FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
    again AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM g),
    rep AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM again, range(0, 3) AS r(o) WHERE n > 1 GROUP BY doc_id),
    m AS (SELECT w.doc_id, CASE WHEN regexp_matches(source, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN
                   lower(regexp_extract(source, '^[A-Za-z][A-Za-z0-9+.-]*://([^/@]*@)?([^/:?#]+)', 2))
                 ELSE coalesce(source, '') END AS host,
                 len(words) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
                 length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
                 len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
                 len(lines) AS n_lines
          FROM w LEFT JOIN rep USING (doc_id)),
    f AS (SELECT *, n_words < 50 AS short, 100 * n_repeat_words > 50 * n_words AS repeats,
                 10 * n_symbols > n_words AS symbols, 10 * n_dup_lines > 3 * n_lines AS dup_lines,
                 word_chars < 3 * n_words OR word_chars > 10 * n_words AS word_length FROM m),
    long AS (UNPIVOT (SELECT host, short::int AS short, repeats::int AS repeats, symbols::int AS symbols,
                             dup_lines::int AS dup_lines, word_length::int AS word_length FROM f)
             ON short, repeats, symbols, dup_lines, word_length INTO NAME rule VALUE failed),
    h AS (SELECT host, rule, count(*)::double AS n, sum(failed)::double AS x FROM long GROUP BY ALL),
    p AS (SELECT rule, sum(n) AS n, sum(n * n) AS nn, count(*) AS k, sum(x) / sum(n) AS m, sum(x * x / n) AS xx
          FROM h GROUP BY rule),
    v AS (SELECT rule, m, (xx - n * m * m - m * (1 - m) * (k - 1)) / nullif(n - nn / n, 0) AS var FROM p),
    s AS (SELECT rule, m, greatest(2.0, least(1000.0, CASE WHEN var > 0 THEN m * (1 - m) / var - 1 ELSE 1000.0 END)) AS s
          FROM v),
    ok AS (SELECT host, max((x + m * s) / (n + s)) <= 0.5 AS host_ok FROM h JOIN s USING (rule) GROUP BY host)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, short OR repeats AS base_failed,
           NOT (short OR repeats) AND host_ok AS kept
    FROM f JOIN ok USING (host)
    """
)
def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judge(_documents(spark, folder)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@_query()
def op13_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(_documents(spark, folder))


@_query()
def op11_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    found = whitening.whiten(spark.read.parquet(f"{folder}/embeddings.parquet"))
    both = F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "of")
    return found.select("vec_id", "n", F.expr("try_cast(deviation AS long)").alias("deviation"), "identity_error", both).select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        "n",
        "deviation",
        F.col("of.whitened").alias("whitened"),
        F.col("of.explained").alias("explained"),
        "identity_error",
    )


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"


_FIELDS = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))
_CRC32 = """list_reduce([4294967295] || list_transform(string_split(doc_id::VARCHAR, ''), lambda s: ord(s)),
    lambda c, b: list_reduce([xor(c, b)] || range(8), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))"""


@_query(
    f"""
    WITH RECURSIVE rows AS (SELECT doc_id, source, sha256({_FIELDS} || {_field("text")}) AS leaf,
            CASE WHEN xor({_CRC32}, 4294967295) % 2 = 0 THEN sha256({_FIELDS} || {_field("replace(text, chr(10), '')")}) END AS other
        FROM documents),
    leaves AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
                      count(*) OVER (PARTITION BY source) AS n FROM rows),
    low AS (SELECT 0 AS k, source, pos, n, leaf AS node FROM leaves
        UNION ALL SELECT k + 1, source, pos // 3, (n + 2) // 3, sha256(string_agg(node, '' ORDER BY pos)) FROM low
        WHERE n > 1 GROUP BY k, source, pos // 3, n),
    subroots AS (SELECT source, node, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
                 FROM low WHERE n = 1),
    high AS (SELECT 100 AS k, pos, n, node FROM subroots
        UNION ALL SELECT k + 1, pos // 3, (n + 2) // 3, sha256(string_agg(node, '' ORDER BY pos)) FROM high
        WHERE n > 1 GROUP BY k, pos // 3, n),
    steps AS (SELECT l.source, l.pos, x.k, x.pos AS place, x.node, l.pos // (3 ** x.k)::BIGINT AS own
              FROM leaves l JOIN low x ON x.source IS NOT DISTINCT FROM l.source AND x.n > 1
                   AND x.pos // 3 = l.pos // (3 ** (x.k + 1))::BIGINT
        UNION ALL SELECT l.source, l.pos, x.k, x.pos, x.node, s.pos // (3 ** (x.k - 100))::BIGINT
              FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source
              JOIN high x ON x.n > 1 AND x.pos // 3 = s.pos // (3 ** (x.k - 99))::BIGINT),
    sides AS (SELECT source, pos, k, coalesce(string_agg(node, '' ORDER BY place) FILTER (place < own), '') AS l,
                     coalesce(string_agg(node, '' ORDER BY place) FILTER (place > own), '') AS r
              FROM steps GROUP BY source, pos, k),
    paths AS (SELECT source, pos, sha256(string_agg(l || r, '' ORDER BY k)) AS proof,
                     list({{'l': l, 'h': '', 'r': r}} ORDER BY k) AS path FROM sides GROUP BY source, pos),
    done AS (SELECT doc_id, leaf, s.node AS subroot, (SELECT node FROM high WHERE n = 1) AS root,
                    coalesce(proof, sha256('')) AS proof_sha256,
                    list_reduce([{{'l': '', 'h': coalesce(other, leaf), 'r': ''}}] || coalesce(path, []),
                        lambda x, y: {{'l': '', 'h': sha256(y.l || x.h || y.r), 'r': ''}}).h AS folded_root
             FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source
             LEFT JOIN paths p ON p.source IS NOT DISTINCT FROM l.source AND p.pos = l.pos)
    SELECT *, folded_root = root AS verified FROM done
    """
)
def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    tampered = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 2 == 0
    text = F.when(tampered, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = merkle.manifest(_documents(spark, folder), changed={"text": text})
    proof = merkle.proof_digest(F.col("path")).alias("proof_sha256")
    return found.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", "verified")
