"""The operators as registered queries, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]):
    QUERIES[run.__name__] = run
    return run


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op3_best_fit_packing(spark, sf_dir):
    from .packing import pack

    return pack(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"), keep_ids=False).drop("ids")


@query
def op7_token_files(spark, sf_dir):
    from .token_files import token_files

    return token_files(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"))


@query
def op8_byte_bpe(spark, sf_dir):
    import public_tokenizers

    from .byte_bpe import encode_documents

    return encode_documents(documents(spark, sf_dir), vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, keep_ids=False).drop("ids")


@query
def op10_token_counts(spark, sf_dir):
    import public_tokenizers

    from .token_counts import token_counts

    return token_counts(documents(spark, sf_dir), vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op6_imatch(spark, sf_dir):
    from .imatch import fingerprints

    return fingerprints(documents(spark, sf_dir))


ORACLES["op6_imatch"] = r"""
WITH every AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
n AS (SELECT count(*) AS n FROM every),
d AS (SELECT doc_id, min(text) AS text FROM every WHERE doc_id IS NOT NULL GROUP BY doc_id),
found AS (SELECT unnest(list_distinct(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'))) AS term FROM every),
words AS (
  SELECT term FROM found WHERE term <> '' GROUP BY term
  HAVING count(*) * 500 >= (SELECT n FROM n) AND count(*) * 5 <= (SELECT n FROM n)
),
member AS (
  SELECT k, term FROM words, range(32) AS r(k)
  WHERE substr(md5(k || ':' || term), 1, 2) < CASE WHEN k % 2 = 0 THEN '04' ELSE '01' END
),
pair AS (
  SELECT doc_id, text, length(text) AS n_chars,
    coalesce(lag(doc_id) OVER (ORDER BY doc_id), max(doc_id) OVER ()) AS next_id,
    coalesce(lag(text) OVER (ORDER BY doc_id), last_value(text) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS next_text
  FROM d
),
e AS (
  SELECT *, substr(text, 1, n_chars - n_chars // 3) || CASE WHEN n_chars < 3 THEN '' ELSE substr(next_text, 1, n_chars // 3) END AS edited FROM pair
),
side AS (SELECT doc_id, 'text' AS side, text AS body FROM e UNION ALL SELECT doc_id, 'edited', edited FROM e),
own AS (SELECT doc_id, side, unnest(list_distinct(regexp_split_to_array(lower(body), '[^\p{L}\p{N}]+'))) AS term FROM side),
hashes AS (
  SELECT doc_id, side, k, substr(md5(string_agg(term, ' ' ORDER BY term)), 1, 8) AS h FROM own JOIN member USING (term) GROUP BY doc_id, side, k
),
written AS (
  SELECT s.doc_id, s.side, s.body, list(h.h ORDER BY r.k) AS list,
    CASE WHEN count(h.h) = 0 THEN '=' || sha256(any_value(s.body)) ELSE string_agg(coalesce(h.h, '--------'), '' ORDER BY r.k) END AS f
  FROM side AS s CROSS JOIN range(32) AS r(k) LEFT JOIN hashes AS h ON h.doc_id = s.doc_id AND h.side = s.side AND h.k = r.k
  GROUP BY s.doc_id, s.side, s.body
),
near AS (
  SELECT a.doc_id, a.side AS a, b.doc_id AS other, b.side AS b,
    sum((a.h = b.h)::INT)::DOUBLE AS equal, count(*) AS both
  FROM hashes AS a JOIN hashes AS b ON a.k = b.k AND a.side = 'text'
    JOIN e ON e.doc_id = a.doc_id AND (b.side = 'edited' AND b.doc_id = a.doc_id OR b.side = 'text' AND b.doc_id = e.next_id)
  GROUP BY ALL
),
size AS (SELECT doc_id, side, count(*) AS m FROM hashes GROUP BY ALL)
SELECT e.doc_id, e.n_chars, sha256(e.edited) AS edited_sha256, t.f AS fingerprint, u.f AS edited_fingerprint,
  CASE WHEN coalesce(st.m, 0) + coalesce(su.m, 0) = 0 THEN (e.text = e.edited)::INT::DOUBLE
    ELSE coalesce(nu.equal, 0) / (coalesce(st.m, 0) + coalesce(su.m, 0) - coalesce(nu.both, 0)) END AS near_edited,
  CASE WHEN coalesce(st.m, 0) + coalesce(sn.m, 0) = 0 THEN (e.text = e.next_text)::INT::DOUBLE
    ELSE coalesce(nn.equal, 0) / (coalesce(st.m, 0) + coalesce(sn.m, 0) - coalesce(nn.both, 0)) END AS near_next
FROM e
JOIN written AS t ON t.doc_id = e.doc_id AND t.side = 'text'
JOIN written AS u ON u.doc_id = e.doc_id AND u.side = 'edited'
LEFT JOIN size AS st ON st.doc_id = e.doc_id AND st.side = 'text'
LEFT JOIN size AS su ON su.doc_id = e.doc_id AND su.side = 'edited'
LEFT JOIN size AS sn ON sn.doc_id = e.next_id AND sn.side = 'text'
LEFT JOIN near AS nu ON nu.doc_id = e.doc_id AND nu.b = 'edited'
LEFT JOIN near AS nn ON nn.doc_id = e.doc_id AND nn.b = 'text'
"""


@query
def op9_secret_scan(spark, sf_dir):
    from .secrets import digests, scan

    return digests(scan(documents(spark, sf_dir)))


@query
def op5_language_id(spark, sf_dir):
    from pyspark.sql import functions as F

    from .language_id import held_out, identify, train

    docs = documents(spark, sf_dir)
    return identify(docs, train(docs)).withColumn("held_out", held_out(F.col("doc_id")))


@query
def op4_ngram_join(spark, sf_dir):
    from .ngram_join import similar

    return similar(documents(spark, sf_dir))


@query
def op1_substring_dedup(spark, sf_dir):
    from .substring_dedup import repeats

    return repeats(documents(spark, sf_dir))


@query
def op2_mtree_search(spark, sf_dir):
    from .mtree import top_k

    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLES["op2_mtree_search"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda x: x[1] * x[2]))::BIGINT AS score
  FROM v AS q, v AS c WHERE q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
) WHERE rank <= 20
"""


@query
def op11_token_alignment(spark, sf_dir):
    from .alignment import alignment

    return alignment(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


@query
def op12_spelling_variants(spark, sf_dir):
    from .spelling import spelling_variants

    return spelling_variants(documents(spark, sf_dir))


# SQL has no CRC-32: the checksum is a sum (without carry) of what each byte adds at its distance from the end.
ORACLES["op12_spelling_variants"] = r"""
WITH RECURSIVE run AS (
  SELECT doc_id, run, count(*) AS times FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM documents
  ) WHERE length(run) >= 7 GROUP BY ALL
),
message AS (SELECT *, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS m FROM run),
size AS (SELECT max(length(m) // 2) AS longest FROM message),
base AS (
  SELECT v, list_reduce(list_prepend(v, range(8)), lambda c, i: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)) AS c FROM range(256) AS r(v)
),
adds AS (
  SELECT 0 AS d, v, c FROM base
  UNION ALL SELECT d + 1, a.v, xor(a.c >> 8, b.c) FROM adds AS a JOIN base AS b ON b.v = a.c & 255 WHERE d < (SELECT longest FROM size)
),
zeros AS (
  SELECT 0 AS len, 4294967295::BIGINT AS state
  UNION ALL SELECT len + 1, xor(z.state >> 8, b.c) FROM zeros AS z JOIN base AS b ON b.v = z.state & 255 WHERE len < (SELECT longest FROM size)
),
byte AS (
  SELECT m, length(m) // 2 AS len, i, ('0x' || substr(m, 2 * i - 1, 2))::BIGINT AS v
  FROM (SELECT DISTINCT m, unnest(range(1, length(m) // 2 + 1)) AS i FROM message)
),
checksum AS (
  SELECT m, xor(xor(bit_xor(c), any_value(state)), 4294967295) AS h
  FROM byte JOIN adds ON adds.d = byte.len - byte.i AND adds.v = byte.v JOIN zeros ON zeros.len = byte.len GROUP BY m
),
word AS (
  SELECT word, sum(times)::BIGINT AS n FROM (
    SELECT times, CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word
    FROM message JOIN checksum USING (m)
  ) WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2
),
cut AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM word)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut AS a JOIN cut AS b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut AS a JOIN word AS b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut AS a JOIN word AS b ON a.rest = b.word
),
best AS (
  SELECT word, count(*) AS n_near, arg_min(other, (-other_n, encode(other))) AS other, max(other_n) AS other_n FROM near GROUP BY word
),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * w.n THEN other END AS form, CASE WHEN other_n >= 10 * w.n THEN other_n END AS form_n
  FROM word AS w LEFT JOIN best USING (word)
),
chain AS (
  SELECT word, word AS place, form AS next FROM formed
  UNION ALL SELECT c.word, f.word, f.form FROM chain AS c JOIN formed AS f ON f.word = c.next
)
SELECT formed.*, chain.place AS root FROM formed JOIN chain ON chain.word = formed.word AND chain.next IS NULL
"""


@query
def op13_line_dedup(spark, sf_dir):
    from .line_dedup import deduplicated, digests

    return digests(deduplicated(documents(spark, sf_dir)))


ORACLES["op13_line_dedup"] = r"""
WITH every AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
line AS (
  SELECT row, doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS place FROM every
),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM line
),
often AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40 AND doc_id IS NOT NULL GROUP BY key HAVING count(DISTINCT doc_id) >= 5
),
told AS (SELECT k.*, coalesce(doc_id < last, false) AS gone FROM keyed AS k LEFT JOIN often USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM told GROUP BY row, doc_id
"""
