"""One registered query per operator, over the whole of its table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscle.llm import (
    classifier, language, licenses, mixing, packing, pseudonyms, rules, sharding, simhash, spelling, topk, warc, whitening,
)
from corpuscle.llm.common import table
from corpuscle.llm.registry import register

WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"


def op1_warc_archive(spark: SparkSession, folder: str) -> DataFrame:
    path = warc.write_archive(table(spark, folder, "pages"))
    return warc.read_archive(spark, path).select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to", "uri",
        F.octet_length("record").cast("long").alias("record_bytes"), F.sha2("record", 256).alias("record_sha256"),
    )


register("op1_warc_archive", op1_warc_archive, f"""
    WITH p AS (SELECT page_id, url, coalesce(html, '') AS h, chr(13) || chr(10) AS e FROM pages),
    f AS (SELECT h, min(page_id) AS first_id FROM p GROUP BY h),
    r AS (SELECT page_id, h, e, strlen(h) AS payload_bytes,
           array_to_string(list_transform(range(0, 32), lambda i: substr('{warc.BASE32}',
               (1 + ((('0x' || substr(sha1(h), CAST((i // 4) * 5 + 1 AS BIGINT), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31))::BIGINT, 1)), '')
               AS payload_digest,
           CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to, coalesce(url, '') AS uri,
           'HTTP/1.1 200 OK' || e || 'Content-Type: text/html; charset=UTF-8' || e || 'Content-Length: ' || strlen(h) || e || e AS http
          FROM p JOIN f USING (h)),
    whole AS (SELECT *, 'WARC/1.1' || e || 'WARC-Type: ' || record_type
           || e || 'WARC-Target-URI: ' || replace(replace(uri, chr(13), '%0D'), chr(10), '%0A')
           || e || 'WARC-Date: 1970-01-01T00:00:00Z' || e || 'WARC-Record-ID: <urn:page:' || page_id || '>'
           || e || 'Content-Type: application/http; msgtype=response' || e || 'WARC-Payload-Digest: sha1:' || payload_digest
           || CASE WHEN refers_to IS NULL THEN '' ELSE e || 'WARC-Profile: {warc.IDENTICAL}' || e || 'WARC-Refers-To: <urn:page:' || refers_to || '>' END
           || e || 'Content-Length: ' || (strlen(http) + CASE WHEN refers_to IS NULL THEN payload_bytes ELSE 0 END) || e || e || http
           || CASE WHEN refers_to IS NULL THEN h ELSE '' END || e || e AS record FROM r)
    SELECT page_id, payload_bytes, payload_digest, record_type, refers_to, uri,
           strlen(record) AS record_bytes, sha256(record) AS record_sha256 FROM whole
""")


def op9_line_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = rules.line_rules(table(spark, folder, "documents").select("doc_id", "text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "words_lost",
    )


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _matches(pattern: str, value: str = "line") -> str:
    return f"len(regexp_extract_all({value}, {_quoted(pattern)}))"


register("op9_line_rules", op9_line_rules, f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
    words AS (SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS i FROM d),
    windows AS (SELECT doc_id, i, word AS a, lead(word) OVER o AS b, lead(word, 2) OVER o AS c FROM words
                WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
    twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n
              FROM windows WHERE c IS NOT NULL) WHERE n > 1),
    covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) AS s(k) GROUP BY doc_id),
    parts AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
    lines AS (SELECT *, {_matches(rules.WORD)} AS nw, {_matches(rules.SHOUT)} AS shouts,
                     {_matches(rules.SEPARATOR)} AS separators FROM parts),
    judged AS (SELECT doc_id, line, nw, nw > 0 AND (
            (nw < {rules.SHORT_LINE} AND NOT regexp_matches(line, {_quoted(rules.ENDED)})) OR 10 * shouts >= 3 * nw
            OR (separators >= 3 AND 4 * separators >= nw)
            OR (nw <= {rules.BOILERPLATE_LINE} AND regexp_matches(line, {_quoted(rules.BOILERPLATE)}))) AS bad
        FROM lines),
    lost AS (SELECT doc_id, count(*) FILTER (nw > 0) - count(DISTINCT line) FILTER (nw > 0) AS dups,
                    coalesce(sum(nw) FILTER (bad), 0)::BIGINT AS lost FROM judged GROUP BY doc_id),
    facts AS (SELECT d.doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
                     {_matches(rules.SYMBOL, 't')} AS n_symbols, dups AS n_dup_lines,
                     coalesce(covered.n, 0) AS n_repeat_words, lost AS words_lost
              FROM d JOIN lost ON lost.doc_id = d.doc_id LEFT JOIN covered ON covered.doc_id = d.doc_id)
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND words_lost <= 0.5::DOUBLE * n_words AS kept
    FROM facts
""")


def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def _places(phrase: str) -> str:
    words = phrase.split()
    return "list_filter(range(1, len(w) + 1), lambda i: " + " AND ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(words)) + ")"


def _sql_list(values) -> str:
    return "[" + ", ".join("'" + v + "'" for v in values) + "]"


WORD_ONLY = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
TEMPLATE_ROWS = ", ".join(
    f"('{label}', {_sql_list(licenses.words_of(notice))}, {_sql_list(marks)}, {licenses.size_of(notice)})"
    for label, notice, marks in licenses.TEMPLATES
)
BASE_ROWS = " UNION ALL ".join(
    f"SELECT doc_id, '{label}' AS label, {_places(phrase)} AS places FROM w" for phrase, label in licenses.PHRASES
)

register("op2_license_scan", op2_license_scan, f"""
    WITH d AS (SELECT doc_id, {LOWERED} AS t FROM documents),
    w AS (SELECT doc_id, t, regexp_extract_all(t, '{WORD_ONLY}') AS w FROM d),
    base AS ({BASE_ROWS}),
    based AS (SELECT doc_id, sum(len(places))::BIGINT AS n_base, min(places[1] - 1) AS first_word, max(places[-1] - 1) AS last_word,
                     list(label) FILTER (len(places) > 0) AS found FROM base GROUP BY doc_id),
    templates AS (SELECT * FROM (VALUES {TEMPLATE_ROWS}) AS v(label, words, marks, size)),
    starts AS (SELECT doc_id, size, list_slice(w, nth * size + 1, (nth + 2) * size) AS run
               FROM (SELECT doc_id, w, size, unnest(range(0, greatest((len(w) + size - 1) // size - 1, 1))) AS nth
                     FROM w, (SELECT DISTINCT size FROM templates))),
    hits AS (SELECT doc_id, label, len(list_intersect(run, t.words)) / len(t.words)::DOUBLE AS share
             FROM starts l JOIN templates t ON t.size = l.size
             WHERE len(list_intersect(run, t.words)) >= ceil({licenses.THRESHOLD} * len(t.words) - 1e-9)
               AND len(list_filter(t.marks, lambda m: contains(' ' || array_to_string(run, ' ') || ' ', ' ' || m || ' '))) > 0),
    method AS (SELECT doc_id, list(DISTINCT label) AS found, max(share) AS score FROM hits GROUP BY doc_id)
    SELECT w.doc_id, len(w) AS n_words, n_base, first_word, last_word,
           array_to_string(list_sort(list_distinct(coalesce(based.found, []))), ',') AS base_labels,
           array_to_string(list_sort(list_distinct(list_concat(coalesce(based.found, []), coalesce(method.found, [])))), ',') AS labels,
           greatest(coalesce(score, 0), CASE WHEN n_base > 0 THEN 1 ELSE 0 END)::DOUBLE AS score
    FROM w JOIN based ON based.doc_id = w.doc_id LEFT JOIN method ON method.doc_id = w.doc_id
""")


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


# No SQL: DuckDB has no XXH64.
register("op6_simhash", op6_simhash)


PII_KEY = "a key the caller keeps"


def op3_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    return pseudonyms.pseudonymise(table(spark, folder, "documents").select("doc_id", "text"), PII_KEY, whole_iban=True)


# No SQL: DuckDB's patterns have no look-behind.
register("op3_pseudonyms", op3_pseudonyms)


def op5_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents").select("doc_id", "source", "text"))


register("op5_source_mixing", op5_source_mixing, f"""
    WITH RECURSIVE d AS (SELECT doc_id, source, text, md5(concat_ws('|', coalesce(md5(doc_id::VARCHAR), 'null'), coalesce(md5(source), 'null'),
                 coalesce(md5(text), 'null'))) || '|' || (row_number() OVER (PARTITION BY doc_id, source, text) - 1) AS ident FROM documents),
    s AS (SELECT source, sum(length(coalesce(text, '')))::DOUBLE AS n FROM d GROUP BY source),
    m AS (SELECT source, CASE WHEN n > 0 THEN pow(n, {mixing.TEMPERATURE}) / (SELECT sum(pow(n, {mixing.TEMPERATURE})) FROM s)
                 * (SELECT sum(n) FROM s) / n ELSE 0 END AS mean FROM s),
    parts AS (SELECT source, mean / greatest(ceil(mean / {mixing.PART}), 1) AS part, greatest(ceil(mean / {mixing.PART}), 1)::BIGINT AS parts FROM m),
    cdf(source, part, k, p, below) AS (
        SELECT source, part, 0, exp(-part), exp(-part) FROM parts
        UNION ALL SELECT source, part, k + 1, p * part / (k + 1), below + p * part / (k + 1) FROM cdf WHERE k < {mixing.TERMS}),
    steps AS (SELECT source, list(below ORDER BY k) AS below FROM cdf GROUP BY source),
    draws AS (SELECT d.doc_id, d.source, d.text, d.ident, below, unnest(range(1, parts + 1)) AS i
              FROM d JOIN parts ON parts.source IS NOT DISTINCT FROM d.source JOIN steps ON steps.source IS NOT DISTINCT FROM d.source),
    counted AS (SELECT any_value(doc_id) AS doc_id, any_value(source) AS source, any_value(text) AS text, ident,
                       sum(len(list_filter(below, lambda b: b <= ('0x' || left(md5('{mixing.SEED}|' || ident || '|' || i), 13))::BIGINT
                           / 4503599627370496.0::DOUBLE)))::BIGINT AS n FROM draws GROUP BY ident),
    copies AS (SELECT doc_id, source, text, ident, unnest(range(0, n))::INTEGER AS replica FROM counted)
    SELECT doc_id, source, text, replica, md5('{mixing.SEED}|order|' || ident || '|' || replica) AS order_key FROM copies
""")


SHARD_BYTES = 128 * 1024  # small enough that tables of a few megabytes are split too


def op8_extendible_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign_shards(table(spark, folder, "documents"), limit=SHARD_BYTES)


register("op8_extendible_shards", op8_extendible_shards, f"""
    WITH d AS (SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes, array_to_string(list_transform(range(1, 17),
                 lambda i: lpad(bin(('0x' || substr(md5(doc_id::VARCHAR), i::BIGINT, 1))::INTEGER), 4, '0')), '') AS bits FROM documents),
    levels AS (SELECT doc_id, n_bytes, k, left(bits, k) AS prefix FROM (SELECT *, unnest(range(0, 33)) AS k FROM d)),
    fits AS (SELECT *, sum(n_bytes) OVER b <= {SHARD_BYTES} OR count(*) OVER b = 1 AS fit FROM levels
             WINDOW b AS (PARTITION BY k, prefix))
    SELECT doc_id, any_value(n_bytes)::BIGINT AS n_bytes, arg_min(prefix, k) AS shard, min(k)::INTEGER AS depth
    FROM fits WHERE fit GROUP BY doc_id
""")


TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op4_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.token_pieces(table(spark, folder, "documents").select("doc_id", "text"), TOKENIZER)
    # Packing needs lengths only: the ids are digested where they are made and not shuffled.
    digested = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(digested)


# No SQL: it has no tokenizer.
register("op4_best_fit_packing", op4_best_fit_packing)


def op7_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"))


register("op7_top_k", op7_top_k, """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
               WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    pairs AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e::DOUBLE[], c.e::DOUBLE[])::BIGINT AS score
              FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
    SELECT * FROM (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
                   FROM pairs) WHERE rank <= 5
""")


def op10_nb_svm(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = classifier.fit(docs, table(spark, folder, "labels"))
    return classifier.score(docs, model).select("doc_id", classifier.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


# No SQL: the model is trained; its accuracy on held-out rows is tested.
register("op10_nb_svm", op10_nb_svm)


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    found = whitening.whiten(table(spark, folder, "embeddings").select("vec_id", "embedding"))
    return found.withColumn("deviation", F.col("deviation").cast("long"))


# No SQL: it has no eigenvectors.
register("op11_whitening", op11_whitening)


def op12_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    found = language.identify(docs.drop("lang"), language.learn(docs))
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "margin", "rejected")


# No SQL: it has no compression.
register("op12_language_id", op12_language_id)


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, folder, "documents").select("doc_id", "text"))


# No SQL: DuckDB has no CRC-32.
register("op13_spelling_variants", op13_spelling_variants)
