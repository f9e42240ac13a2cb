"""The registered queries of this subpackage, one per operator.

Each applies its operator with production parameters to its whole table.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casegrid.llm import (
    collocations,
    cost_packing,
    decontam,
    fit_packing,
    line_dedup,
    pii,
    prefix_trie,
    simhash,
    spotsigs,
    substring_dedup,
    sum_squares,
    tokens,
    toxicity,
    warc,
)
from casegrid.llm.common import small_batches, table

WORD_FILE, RANK_FILE = "word_bpe_49k.json", "byte_bpe_50k.tiktoken"
#: The id after each document in fit packing: the first one the ranks leave free.
FREE_ID = 50256


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; learned without the held-out third."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.learn(docs, labels, only=lambda i: ~toxicity.held_out(i))
    return toxicity.toxicity_scores(docs, model).select(
        F.col("id").alias("doc_id"), toxicity.held_out(F.col("id")).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def _span_list(spans: str) -> F.Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", x["start"].cast("string"), x["stop"].cast("string"))), ",")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its repeated passages, its own repeats among
    them; ``spans`` are the byte ranges that went."""
    out = substring_dedup.dedup_substrings(table(spark, sf_dir, "documents"), within=True)
    return out.select("doc_id", F.size("spans").alias("n_spans"), "removed_words",
                      _span_list("spans").alias("spans"), "text")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC archives and read back by their index."""
    index = warc.archive_pages(table(spark, sf_dir, "pages"))
    return warc.read_records(index).select(
        F.col("record_id").alias("page_id"), "payload_bytes",
        # of a revisit the digest in its header, of a response that of the payload read
        F.coalesce(F.sha2("payload", 256), F.col("payload_digest")).alias("payload_digest"),
        "record_type", "refers_to", "url")


OP3_SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS body, coalesce(url, '') AS url FROM pages
), d AS (
  SELECT page_id, octet_length(body) AS payload_bytes, sha256(body) AS payload_digest, url FROM p
), f AS (
  SELECT payload_digest, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100 GROUP BY 1
)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
       CASE WHEN f.first_id < d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first_id < d.page_id THEN f.first_id END AS refers_to, d.url
FROM d LEFT JOIN f ON d.payload_digest = f.payload_digest AND d.payload_bytes >= 100
"""


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item that a document holds within the edit budget."""
    hits = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.select(F.col("id").alias("doc_id"), "item_id", "edits", "region")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token ids in sequences of balanced cost."""
    ids = tokens.WordIds(public_tokenizers.path(WORD_FILE))
    pieces = cost_packing.cost_packed(table(spark, sf_dir, "documents"), ids)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and of its edited text, and how near it
    is to the edited text's and to the next document's."""
    rows = spotsigs.fingerprinted(table(spark, sf_dir, "documents"), texts=False)
    return rows.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
                       "near_next")


def op7_token_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as rows of padded id matrices."""
    ids = tokens.ByteIds(public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN)
    return fit_packing.fit_packed(table(spark, sf_dir, "documents"), ids, FREE_ID)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["kind_no"] < 4)
    count = lambda n: F.size(F.filter("spans", lambda x: x["kind_no"] == n)).cast("long")
    return found.select(
        F.col("id").alias("doc_id"), count(0).alias("n_email"), count(1).alias("n_ip"), count(2).alias("n_card"),
        count(3).alias("n_phone"), F.sha2(pii.span_text(base).cast("binary"), 256).alias("base_sha256"),
        pii.span_text("spans").alias("spans"), count(4).alias("n_iban"), count(5).alias("n_credential"),
        F.array_join(F.transform("spans", lambda x: x["score"].cast("string")), ",").alias("scores"))


def _op8_sql() -> str:
    """The same in DuckDB: matches and the pieces between them give places."""
    def places(kind_no: int, pattern: str) -> str:
        return f"""
  SELECT doc_id, t, {kind_no} AS kind_no, m[i] AS w, cast(coalesce(list_sum(list_transform(p[1:i], lambda x: length(x))), 0)
      + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) AS bigint) AS s
  FROM (SELECT doc_id, t, regexp_extract_all(t, '{pattern}') AS m, string_split_regex(t, '{pattern}') AS p
        FROM docs) x, unnest(range(1, len(m) + 1)) u(i)"""

    card = r"[0-9](?:[\x20-]?[0-9])+"
    found = " UNION ALL ".join(places(n, x) for n, x in enumerate(
        (pii.EMAIL, pii.IP, card, pii.PHONE, pii.IBAN, pii.CREDENTIAL)))
    near = "lower(substr(t, greatest(s - 40, 0) + 1, s - greatest(s - 40, 0)))"
    prior = " ".join(f"WHEN {n} THEN {pii.PRIOR[k]}" for n, k in enumerate(pii.KINDS))
    words = " ".join(f"WHEN {n} THEN regexp_matches({near}, '{pii.EDGE}(?:{pii.CONTEXT[k]})')"
                     for n, k in enumerate(pii.KINDS))
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({found}),
typed AS (
  SELECT doc_id, t, kind_no, w, s AS s0, s + length(w) AS e, v,
    CASE WHEN kind_no = 5 THEN s + length(w) - length(v) ELSE s END AS s,
    regexp_replace(w, '[^0-9]', '', 'g') AS d, replace(w, ' ', '') AS a
  FROM (SELECT *, regexp_extract(w, '{pii.CREDENTIAL_VALUE}$') AS v FROM found) x
),
sure AS (
  SELECT *, {list(pii.KINDS)}[kind_no + 1] AS kind,
    round((CASE kind_no {prior} END) + CASE WHEN (CASE kind_no {words} END) THEN {pii.STEP_UP} ELSE 0 END
      - CASE WHEN regexp_matches({near}, '{pii.EDGE}(?:{pii.AGAINST})(?:$|[^a-z0-9])') THEN {pii.STEP_DOWN} ELSE 0 END, 2)
      AS score
  FROM typed WHERE CASE kind_no
    WHEN 1 THEN list_bool_and(list_transform(string_split(w, '.'), lambda x: cast(x AS hugeint) <= 255))
    WHEN 2 THEN length(d) BETWEEN 12 AND 19 AND list_sum(list_transform(range(1, length(d) + 1), lambda k:
        CASE WHEN (length(d) - k) % 2 = 0 THEN cast(substr(d, k, 1) AS int)
             WHEN cast(substr(d, k, 1) AS int) > 4 THEN 2 * cast(substr(d, k, 1) AS int) - 9
             ELSE 2 * cast(substr(d, k, 1) AS int) END)) % 10 = 0
    WHEN 3 THEN length(d) BETWEEN 9 AND 15
    WHEN 4 THEN length(a) BETWEEN 15 AND 34
      AND NOT regexp_matches(substr(t, s, CASE WHEN s > 0 THEN 1 ELSE 0 END), '[A-Za-z0-9]')
      AND NOT regexp_matches(substr(t, e + 1, 1), '[A-Za-z0-9]')
      AND list_reduce(list_prepend(0, list_transform(string_split(substr(a, 5) || substr(a, 1, 4), ''),
        lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN ascii(c) - 48 ELSE ascii(c) - 55 END)),
        lambda r, v: CASE WHEN v < 10 THEN (r * 10 + v) % 97 ELSE (r * 100 + v) % 97 END) = 1
    WHEN 5 THEN NOT regexp_matches(substr(t, s0, CASE WHEN s0 > 0 THEN 1 ELSE 0 END), '[A-Za-z0-9]')
      AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]')
      AND list_sum(list_transform(list_distinct(string_split(v, '')), lambda c:
        -(length(v) - length(replace(v, c, ''))) / length(v)::double
        * log2((length(v) - length(replace(v, c, ''))) / length(v)::double))) >= {pii.ENTROPY}
    ELSE true END
),
per AS (
  SELECT doc_id, kind_no, s, kind || ':' || s || ':' || e AS span, score FROM sure
)
SELECT d.doc_id, count(*) FILTER (WHERE kind_no = 0) AS n_email, count(*) FILTER (WHERE kind_no = 1) AS n_ip,
  count(*) FILTER (WHERE kind_no = 2) AS n_card, count(*) FILTER (WHERE kind_no = 3) AS n_phone,
  sha256(coalesce(string_agg(span, ',' ORDER BY s, kind_no) FILTER (WHERE kind_no < 4), '')) AS base_sha256,
  coalesce(string_agg(span, ',' ORDER BY s, kind_no), '') AS spans,
  count(*) FILTER (WHERE kind_no = 4) AS n_iban, count(*) FILTER (WHERE kind_no = 5) AS n_credential,
  coalesce(string_agg(cast(score AS varchar), ',' ORDER BY s, kind_no), '') AS scores
FROM documents d LEFT JOIN per p ON d.doc_id = p.doc_id GROUP BY d.doc_id"""


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its repeated passages of two lines or more;
    ``spans`` are the byte ranges that went."""
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"), every_line=True)
    return out.select(F.col("id").alias("doc_id"), F.size("spans").alias("n_spans"),
                      _span_list("spans").alias("spans"), F.col("row.text").alias("text"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document."""
    groups = simhash.simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                         F.col("component").alias("component_id"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2000 phrases by how firmly their words hold together."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH p AS (
  SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents) q
), g AS (
  SELECT lang, k, array_to_string(w[s:s + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM p, (SELECT unnest([1, 2, 3, 4]) AS k) ks) x
), f AS (
  SELECT lang, k, phrase, count(*) AS n FROM g GROUP BY lang, k, phrase
), total AS (
  SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang
), c AS (
  SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND n >= 30
), cuts AS (
  SELECT lang, k, phrase, a, cut, array_to_string(w[1:cut], ' ') AS first, array_to_string(w[cut + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) x
), s AS (
  SELECT c.lang, c.phrase, c.a, x.n AS l, y.n AS r, (2000000::HUGEINT * a) // (x.n::HUGEINT + y.n) AS score, cut
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = first JOIN f y ON y.lang = c.lang AND y.phrase = rest
), best AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inside AS (
  SELECT lang, array_to_string(w[s:s + j - 1], ' ') AS phrase, max(a) AS around
  FROM (SELECT *, unnest(range(1, k - j + 2)) AS s FROM (SELECT *, unnest(range(2, k)) AS j FROM c WHERE k > 2) x) y
  GROUP BY ALL
)
SELECT b.lang, rank, b.phrase, a, l, r, total.n, score::BIGINT AS score FROM (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, encode(b.phrase)) AS rank
  FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase
  WHERE around IS NULL OR 100::HUGEINT * around < 80::HUGEINT * a
) b JOIN total ON total.lang = b.lang WHERE rank <= 2000"""


def op12_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces in as few sequences of 4096 tokens as can be."""
    ids = tokens.WordIds(public_tokenizers.path(WORD_FILE))
    return sum_squares.sum_of_squares_packed(table(spark, sf_dir, "documents"), ids)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie over the conversations, rebuilt with shared heads."""
    return prefix_trie.trie_nodes(table(spark, sf_dir, "conversations"), 5, prefix_trie.shared_heads)


#: CRC-32 of a decimal number, bit by bit.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}::VARCHAR, ''),
  lambda x: ascii(x)::BIGINT)), lambda r, b: list_reduce(list_prepend(xor(r, b), range(8)), lambda x, i:
  CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""
OP13_SQL = f"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x, turn,
    md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL
), o AS (
  SELECT c, k, strlen(x) AS s, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, k) AS p FROM t
), i AS (
  SELECT c, {_CRC.format("c")} % 9 AS h FROM (SELECT DISTINCT c FROM t) q
), b AS (
  SELECT i.c, p, k, s FROM i JOIN o ON o.c = i.c - i.c % 5 WHERE p <= h
  UNION ALL SELECT i.c, p, k, s FROM i JOIN o ON o.c = i.c WHERE p > h
), m AS (
  SELECT c, row_number() OVER w AS d, s, string_agg(k, '') OVER w AS node FROM b
  WINDOW w AS (PARTITION BY c ORDER BY p ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT c, 0, 0, '' FROM i
), e AS (
  SELECT c, max(d) AS last FROM m GROUP BY c
), n AS (
  SELECT node, d, min(m.c) AS conv_id, count(*) AS n_convs, any_value(s) AS s,
    count(*) FILTER (WHERE last = d) = count(*) AS leaf,
    sha256(coalesce(string_agg(m.c::VARCHAR, ',' ORDER BY m.c) FILTER (WHERE last = d), '')) AS ends_sha256
  FROM m JOIN e ON e.c = m.c GROUP BY node, d
), up AS (
  SELECT n.node, p.node AS parent FROM n JOIN m p ON p.c = n.conv_id AND p.d = n.d - 1
), kids AS (
  SELECT parent, count(*) AS k FROM up GROUP BY parent
), sums AS (
  SELECT a.node, count(*) FILTER (WHERE n.leaf) AS n_leaves, sum((n.n_convs - 1) * n.s) AS saved
  FROM n JOIN m a ON a.c = n.conv_id AND a.d <= n.d GROUP BY a.node
)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.k, 0) AS n_children,
  sums.n_leaves, sums.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM n JOIN sums ON sums.node = n.node LEFT JOIN kids ON kids.parent = n.node
LEFT JOIN up ON up.node = n.node LEFT JOIN n p ON p.node = up.parent"""


def _query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return f(spark, sf_dir)
    return run


QUERIES = {f.__name__: _query(f) for f in (
    op1_toxicity, op2_substring_dedup, op3_warc, op4_decontamination, op5_packing, op6_fingerprints,
    op7_token_matrices, op8_pii, op9_line_dedup, op10_simhash, op11_collocations,
    op12_best_fit, op13_prefix_trie)}
SQL = {"op3_warc": OP3_SQL, "op8_pii": _op8_sql(), "op11_collocations": OP11_SQL,
       "op13_prefix_trie": OP13_SQL}
