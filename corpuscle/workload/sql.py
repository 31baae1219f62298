"""SQL fragments the check queries are put together from."""

from __future__ import annotations

SPACES = r"[ \t\n\x0b\f\r]+"
HASH_DIM = 64


def sanitized(text: str) -> str:
    return (
        f"trim(regexp_replace(regexp_replace({text}, '[\\x00-\\x08\\x0b-\\x1f\\x7f]', ' ', 'g'), "
        f"'{SPACES}', ' ', 'g'))"
    )


def edge_trimmed(text: str) -> str:
    return f"regexp_replace({text}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"


def normalized(text: str) -> str:
    return edge_trimmed(f"regexp_replace({text}, '{SPACES}', ' ', 'g')")


def fixed(value: str, digits: int = 6) -> str:
    scale = f"1e{digits}::DOUBLE"
    return f"(floor(({value}) * {scale} + 0.5) / {scale})"


def grid(score: str) -> str:
    return f"floor(({score}) * 1e9::DOUBLE + 0.5)"


RAW = "raw AS (SELECT doc_id, source, concat(source, '/', doc_id, '.txt') AS uri, text FROM documents)"


def chunks(source: str, keys: str, max_chars: int, overlap: int, text: str = "text") -> str:
    """CTEs ending in ``chunks(keys, chunk_id, text)``."""
    stride = max(max_chars - overlap, 1)
    return f"""
    cleaned AS (SELECT {keys}, {normalized(text)} AS t FROM {source}),
    placed AS (
        SELECT {keys}, t, unnest(CASE WHEN length(t) = 0 THEN []::BIGINT[]
                                      WHEN length(t) <= {max_chars} THEN [0]::BIGINT[]
                                      ELSE range(0, length(t), {stride}) END) AS pos
        FROM cleaned),
    chunks AS (SELECT {keys}, (pos // {stride})::BIGINT AS chunk_id, substring(t, pos + 1, {max_chars}) AS text FROM placed)
    """


def hash_weights(name: str, source: str, keys: str, text: str = "text") -> str:
    """CTEs ending in ``{name}(keys, d, w)``: the non-zero weights of the hashing embedder."""
    return f"""
    {name}_tokens AS (SELECT {keys}, unnest(regexp_extract_all(lower({text}), '[a-z0-9]+')) AS token FROM {source}),
    {name}_words AS (
        SELECT token, ('0x' || substr(h, 1, 8))::BIGINT % {HASH_DIM} AS d,
               1 - 2 * (('0x' || substr(h, 9, 1))::BIGINT % 2) AS sign
        FROM (SELECT DISTINCT token, md5(token) AS h FROM {name}_tokens)),
    {name} AS (
        SELECT {keys}, d, sum(sign)::DOUBLE AS w FROM {name}_tokens JOIN {name}_words USING (token)
        GROUP BY {keys}, d HAVING sum(sign) <> 0)
    """


def dense(source: str, weights: str, keys: str, keep: str) -> str:
    """Rows of ``source`` with their weights as text, zeros included."""
    on = " AND ".join(f"s.{k.strip()} = x.{k.strip()}" for k in keys.split(","))
    return f"""
    SELECT {keep}, array_to_string(list_transform(range(0, {HASH_DIM}),
               lambda i: coalesce(map_extract_value(x.m, i), 0)::BIGINT), ' ') AS vec
    FROM {source} s LEFT JOIN (
        SELECT {keys}, map(list(d::BIGINT), list(w)) AS m FROM {weights} GROUP BY {keys}) x ON {on}
    """


def java_hash(text: str) -> str:
    return (
        f"list_reduce(list_prepend(0::BIGINT, list_transform(string_split({text}, ''), "
        "lambda c: unicode(c)::BIGINT)), lambda a, u: (a * 31 + u) & 4294967295)"
    )


def shard(doc_id: str, shards: int) -> str:
    return f"(({java_hash(doc_id)} & 2147483647) % {shards})::INTEGER"


CENTROIDS = """
    parts AS (SELECT label, unnest(range(1, len(embedding) + 1)) AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings),
    means AS (SELECT label, pos, avg(x) AS x FROM parts GROUP BY label, pos),
    centroids AS (SELECT label, list(x ORDER BY pos) AS q FROM means GROUP BY label)
"""


def norm(vec: str) -> str:
    return f"sqrt(list_inner_product({vec}, {vec}))"


def cosine(a: str, b: str) -> str:
    return (
        f"CASE WHEN {norm(a)} * {norm(b)} = 0 THEN 0 "
        f"ELSE list_inner_product({a}, {b}) / ({norm(a)} * {norm(b)}) END"
    )


def retrieved(score: str) -> str:
    """CTEs ending in ``hits``: the eight best chunks of every question."""
    return f"""
    {RAW},
    source_docs AS (SELECT sha256(uri) AS doc_id, text FROM raw),
    {chunks('source_docs', 'doc_id', 800, 160)},
    {hash_weights('cw', 'chunks', 'doc_id, chunk_id')},
    {hash_weights('qw', 'benchmark', 'item_id')},
    cn AS (SELECT doc_id, chunk_id, sum(w * w) AS n FROM cw GROUP BY ALL),
    qn AS (SELECT item_id, sum(w * w) AS n FROM qw GROUP BY ALL),
    dots AS (SELECT item_id, doc_id, chunk_id, sum(qw.w * cw.w) AS dot FROM qw JOIN cw USING (d) GROUP BY ALL),
    scored AS (
        SELECT b.item_id AS question_id, c.doc_id, c.chunk_id, c.text,
               {grid(score)} AS g
        FROM benchmark b CROSS JOIN chunks c
        LEFT JOIN dots USING (item_id, doc_id, chunk_id)
        LEFT JOIN qn USING (item_id) LEFT JOIN cn USING (doc_id, chunk_id)),
    hits AS (
        SELECT question_id, doc_id, chunk_id, text, g / 1e9::DOUBLE AS score,
               row_number() OVER (PARTITION BY question_id ORDER BY g DESC, doc_id, chunk_id)::INTEGER AS rank
        FROM scored QUALIFY rank <= 8)
"""


RETRIEVED = retrieved("coalesce(dot / (sqrt(qn.n) * sqrt(cn.n)), 0)")
RETRIEVED_BY_DISTANCE = retrieved("1 / (1 + greatest(coalesce(qn.n, 0) + coalesce(cn.n, 0) - 2 * coalesce(dot, 0), 0))")

# The stop words of the keyword guard.
STOP = (
    "['the','a','an','and','or','of','to','in','on','for','with','by','from',"
    "'what','who','when','where','why','how','is','are','was','were','be','does','do','about']"
)


def content_words(text: str) -> str:
    return f"list_filter(regexp_extract_all(lower({text}), '[a-z0-9]+'), lambda t: NOT list_contains({STOP}, t))"


GUARDED = f"""
    {RETRIEVED},
    grouped AS (
        SELECT question_id, count(*) AS n_hits, max(score) AS top_score,
               list(text ORDER BY rank) AS contexts, list(doc_id || '#' || chunk_id ORDER BY rank) AS labels
        FROM hits GROUP BY question_id),
    guarded AS (
        SELECT b.item_id AS question_id, b.text AS question, coalesce(n_hits, 0)::INTEGER AS n_hits,
               coalesce(top_score, 0) AS top_score, contexts, labels,
               len(list_filter({content_words('b.text')},
                   lambda t: list_contains({content_words("array_to_string(coalesce(contexts, []), ' ')")}, t)))::INTEGER
                   AS overlap
        FROM benchmark b LEFT JOIN grouped g ON g.question_id = b.item_id)
"""
ANSWERED = "n_hits > 0 AND top_score >= 0.35 AND overlap >= 1"
