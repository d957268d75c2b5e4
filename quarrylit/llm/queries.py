"""The queries of this subpackage: query(spark, sf_dir) applies an operator with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, fingerprints, fst, interactions, jaccard, langid, packing, phrases, quality, repetition, secrets, toxicity, warc
from .shared import documents


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.scan(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write(documents(spark, sf_dir, "pages"))
    out = warc.records(warc.read(manifest, with_data=False))
    return out.select(F.col("record_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(documents(spark, sf_dir))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components(documents(spark, sf_dir))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.score(docs, quality.fit(docs, documents(spark, sf_dir, "labels")))


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return langid.predict(docs, langid.fit(docs))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.fit(docs, documents(spark, sf_dir, "labels")))


def op8_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.score(documents(spark, sf_dir))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer("word_bpe_49k.json"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fst.counts(documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"))


def op11_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions.interactions(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.neighbours(documents(spark, sf_dir))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(documents(spark, sf_dir))


# What SQL can say of the operators whose whole result is beyond it.


def base_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3's base findings."""
    return op3_secrets(spark, sf_dir).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")


def base_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8's base rule."""
    return op8_repetition(spark, sf_dir).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def scored_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which rows op5, op6 and op7 may not learn from, and that each has a score and a prediction by its threshold."""
    q, g, x = op5_quality(spark, sf_dir), op6_langid(spark, sf_dir), op7_toxicity(spark, sf_dir)
    fits = lambda limit: (F.col("score").between(0, 1) & ((F.col("score") >= limit).cast("int") == F.col("predicted")))
    q = q.select("doc_id", F.col("held_out").alias("quality_held_out"), fits(0.3).alias("quality_fits"))
    x = x.select("doc_id", F.col("held_out").alias("toxic_held_out"), fits(0.7).alias("toxic_fits"))
    g = g.select("doc_id", F.col("held_out").alias("lang_held_out"), (F.col("lang_pred") == "und").alias("und"))
    return q.join(g, "doc_id").join(x, "doc_id")


def text_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10's bytes, and that a text has tokens if and only if it has bytes, no more of them, and is over the limit by them."""
    t = op10_token_counts(spark, sf_dir)
    fits = ((F.col("n_tokens") > 0) == (F.col("n_bytes") > 0)) & (F.col("n_tokens") <= F.col("n_bytes")) & (F.col("over_limit") == (F.col("n_tokens") > 512))
    return t.select("doc_id", "n_bytes", fits.alias("fits"))


def packed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9's pieces: each document's add up to its tokens, and each window's to its size but the last."""
    pieces = op9_packing(spark, sf_dir)
    docs = pieces.groupBy("doc_id").agg((F.sum("length") == F.first("doc_tokens")).alias("whole"), F.min("start").alias("first"))
    full = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.count_if(F.col("n") > 4096).alias("over"), F.count_if(F.col("n") < 4096).alias("short"))
    return docs.crossJoin(F.broadcast(full)).select("doc_id", "whole", "first", "over", (F.col("short") <= 1).alias("one_short"))  # one row on the right


def fingerprint_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12's edited texts, and that equal texts have equal fingerprints and likenesses are shares."""
    got = op12_fingerprints(spark, sf_dir)
    fits = F.col("near_edited").between(0, 1) & F.col("near_next").between(0, 1) & ((F.col("fingerprint") != F.col("edited_fingerprint")) | (F.col("near_edited") == 1))
    return got.select("doc_id", "n_chars", "edited_sha256", fits.alias("fits"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    parts = (base_secrets, base_repetition, scored_folds, text_bytes, packed_documents, fingerprint_texts)
    return {k: v for k, v in globals().items() if k.startswith("op") and callable(v)} | {f.__name__: f for f in parts}


_FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SPACED = r"[^\x20\x09-\x0D]+"

#: Windows are joined on their words; hit words are counted once each.
_OP1 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_FOLD.format("coalesce(text, '')")}, '{_ALNUM}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_FOLD.format("coalesce(text, '')")}, '{_ALNUM}') AS w FROM benchmark),
bw AS (SELECT item_id, least(13, len(w)) AS n, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS x FROM bw),
widths AS (SELECT DISTINCT n FROM windows),
dw AS (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, widths WHERE len(w) >= n),
hits AS (SELECT doc_id, item_id, h.n AS n, i FROM (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS x FROM dw) h JOIN windows v ON h.n = v.n AND h.x = v.x),
spread AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS ks FROM (SELECT DISTINCT doc_id, cast(item_id AS VARCHAR) AS k FROM hits) GROUP BY doc_id)
SELECT d.doc_id AS doc_id, cast(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ks, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN spread s ON d.doc_id = s.doc_id LEFT JOIN items t ON d.doc_id = t.doc_id"""

#: Five bits of the digest at a time: from two hexadecimal digits each.
_OP2 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(h)) AS payload_bytes, sha1(h) AS x, max(page_id) OVER (PARTITION BY h) AS m FROM p)
SELECT page_id, cast(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((((strpos('0123456789abcdef', x[5 * i // 4 + 1]) - 1) * 16 + strpos('0123456789abcdef', x[5 * i // 4 + 2]) - 1) >> (3 - 5 * i % 4)) & 31), 1)), '') AS payload_digest,
  CASE WHEN page_id = m THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> m THEN m END AS refers_to
FROM d"""

#: Links by shared shingles, then what they reach.
_OP4 = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_FOLD.format("coalesce(text, '')")}, '{_SPACED}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 2], ' ') END AS x
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 2) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 90 * (x.n + y.n - o)),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id AS doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.b, d.doc_id)) AS component_id
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN (SELECT a, min(b) AS b FROM reach GROUP BY a) m ON d.doc_id = m.a"""


#: Five filters' bits of each document, and every document under every order.
_OP11 = """
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS x FROM documents),
w AS (SELECT *, regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+') AS w, min(doc_id) OVER (PARTITION BY x) AS least FROM t),
m AS (SELECT w.doc_id AS doc_id, part, coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic,
    [len(w) < 100, 100 * len(list_distinct(w)) < 80 * len(w), 100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > 10 * length(x), regexp_matches(x, '[#$%&*|]'), coalesce(least < w.doc_id, false)] AS f
  FROM w LEFT JOIN (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id) l ON l.doc_id = w.doc_id),
c AS (SELECT part, f, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM m GROUP BY ALL),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
orders AS (SELECT concat(a.c, b.c, d.c, e.c, f.c) AS o FROM letter a, letter b, letter d, letter e, letter f WHERE len(list_distinct([a.c, b.c, d.c, e.c, f.c])) = 5),
steps AS (SELECT o, unnest(range(1, 6)) AS k FROM orders),
s AS (SELECT part, o, k, o[k] AS own, n, good, toxic, f[ascii(o[k]) - 64] AS fails, len(list_filter(range(1, 6), lambda i: f[i] AND contains(o[:k - 1], chr(cast(64 + i AS INTEGER))))) > 0 AS gone, len(list_filter(f, lambda y: y)) AS failures FROM c, steps),
r AS (SELECT part, o AS filter_order, cast(k AS INTEGER) AS step, own, coalesce(sum(n) FILTER (WHERE NOT gone AND NOT fails), 0) AS kept, coalesce(sum(n) FILTER (WHERE NOT gone AND fails), 0) AS removed, coalesce(sum(n) FILTER (WHERE gone AND fails), 0) AS redundant,
    coalesce(sum(n) FILTER (WHERE fails AND failures = 1), 0) AS unique_fails, coalesce(sum(good) FILTER (WHERE NOT gone AND fails), 0) AS good_lost, coalesce(sum(toxic) FILTER (WHERE NOT gone AND fails), 0) AS toxic_lost FROM s GROUP BY ALL)
SELECT part, filter_order, step, cast(kept AS BIGINT) AS kept, cast(removed AS BIGINT) AS removed, cast(redundant AS BIGINT) AS redundant, cast(unique_fails AS BIGINT) AS unique_fails, cast(good_lost AS BIGINT) AS good_lost, cast(toxic_lost AS BIGINT) AS toxic_lost,
  cast(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM r"""

#: Every phrase's count, the lowest-scoring cut of each, and what stands in longer ones.
_OP13 = f"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, string_split_regex({_FOLD.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]') AS ps FROM documents),
p AS (SELECT lang, regexp_extract_all(x, '[^\\x20\\x09]+') AS w FROM (SELECT lang, unnest(ps) AS x FROM d)),
totals AS (SELECT lang, cast(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k)),
f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cuts AS (SELECT lang, phrase, a, w, unnest(range(1, k)) AS j FROM c),
s AS (SELECT cuts.lang AS lang, cuts.phrase AS phrase, cuts.a AS a, j, x.a AS l, y.a AS r, cast((2000000::HUGEINT * cuts.a) // (x.a::HUGEINT + y.a) AS BIGINT) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = array_to_string(w[1:j], ' ') JOIN f y ON y.lang = cuts.lang AND y.phrase = array_to_string(w[j + 1:], ' ')),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS o FROM s),
longer AS (SELECT lang, k, a, unnest([array_to_string(w[i:i + m - 1], ' ') FOR i IN range(1, k - m + 2)]) AS phrase FROM c, (SELECT unnest([2, 3]) AS m) WHERE k > m)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT b.lang AS lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score FROM b JOIN totals t ON t.lang = b.lang
  WHERE o = 1 AND NOT EXISTS (SELECT 1 FROM longer z WHERE z.lang = b.lang AND z.phrase = b.phrase AND 100 * z.a >= 80 * b.a)) WHERE rank <= 2000"""


#: A match begins behind the parts of the text between matches and the matches before it.
_FOUND = """{kind}_m AS (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS m, regexp_extract_all(t, '{pattern}', {group}) AS g, list_transform(string_split_regex(t, '{pattern}'), lambda x: length(x)) AS gaps FROM d),
{kind}_at AS (SELECT doc_id, m, g, gaps, unnest(range(1, len(m) + 1)) AS i FROM {kind}_m),
{kind} AS (SELECT doc_id, {order} AS kind_order, '{kind}' AS kind, list_sum(gaps[:i]) + coalesce(list_sum(list_transform(m[:i - 1], lambda x: length(x))), 0) AS start, list_sum(gaps[:i]) + list_sum(list_transform(m[:i], lambda x: length(x))) AS stop FROM {kind}_at WHERE length(g[i]) >= {least})"""
_KINDS = (("assign", "(?i:(password|passwd|secret|token|api_?key))[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)", 2, 8), ("access", "AKIA[A-Z0-9]+", 0, 16), ("hex", "[0-9a-f]+", 0, 32))
_BASE_SECRETS = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
{", ".join(_FOUND.format(kind=k, pattern=p, group=g, least=n, order=i) for i, (k, p, g, n) in enumerate(_KINDS))},
s AS (SELECT * FROM assign UNION ALL SELECT * FROM access UNION ALL SELECT * FROM hex),
c AS (SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access, count(*) FILTER (WHERE kind = 'hex') AS n_hex, string_agg(concat(kind, ':', cast(start AS BIGINT), ':', cast(stop AS BIGINT)), ',' ORDER BY start, kind_order) AS spans FROM s GROUP BY doc_id)
SELECT d.doc_id AS doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(spans, '')) AS base_sha256 FROM d LEFT JOIN c ON d.doc_id = c.doc_id"""

_BASE_REPETITION = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS n FROM win) WHERE n > 1),
words AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM rep) GROUP BY doc_id),
lines AS (SELECT doc_id, cast(sum(n - 1) AS BIGINT) AS n FROM (SELECT doc_id, x, count(*) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d) WHERE regexp_matches(x, '{_SPACED}') GROUP BY ALL) GROUP BY doc_id),
b AS (SELECT d.doc_id AS doc_id, cast(len(w) AS BIGINT) AS n_words, cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars, cast(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(l.n, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
  FROM d LEFT JOIN words r ON r.doc_id = d.doc_id LEFT JOIN lines l ON l.doc_id = d.doc_id)
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM b"""

#: CRC-32 of a document's number, digit by digit: table entries come of eight shifts of a byte.
_FOLDS = """
WITH RECURSIVE shifts AS (SELECT i AS byte, i AS c, 0 AS k FROM range(256) t(i) UNION ALL SELECT byte, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM shifts WHERE k < 8),
tab AS (SELECT list(c ORDER BY byte) AS t FROM shifts WHERE k = 8),
crc AS (SELECT doc_id, cast(doc_id AS VARCHAR) AS s, 4294967295::BIGINT AS c, 0 AS k FROM documents
  UNION ALL SELECT doc_id, s, xor((SELECT t FROM tab)[cast((xor(c, ascii(s[k + 1]))) & 255 AS INTEGER) + 1], c >> 8), k + 1 FROM crc WHERE k < length(s)),
h AS (SELECT doc_id, xor(c, 4294967295::BIGINT) AS h FROM crc WHERE k = length(s))
SELECT d.doc_id AS doc_id, h % 5 = 0 AS quality_held_out, true AS quality_fits, h % 5 = 0 AS lang_held_out, NOT regexp_matches(coalesce(text, ''), '[\\p{L}]') AS und, h % 3 = 1 AS toxic_held_out, true AS toxic_fits FROM documents d JOIN h ON h.doc_id = d.doc_id"""

_FINGERPRINT_TEXTS = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lead(coalesce(text, '')) OVER (ORDER BY doc_id), first_value(coalesce(text, '')) OVER (ORDER BY doc_id)) AS following FROM documents)
SELECT doc_id, cast(length(t) AS BIGINT) AS n_chars, sha256(concat(substring(t, 1, length(t) - length(t) // 2), substring(following, 1, length(t) // 2))) AS edited_sha256, true AS fits FROM d"""


def oracle_sql() -> dict[str, str]:
    """The operators that SQL can express as a whole; the others are tested against brute force."""
    return {"op1_decontaminate": _OP1, "op2_warc": _OP2, "op4_jaccard_join": _OP4, "op11_filter_interactions": _OP11, "op13_collocations": _OP13} | {
        "base_secrets": _BASE_SECRETS,
        "base_repetition": _BASE_REPETITION,
        "scored_folds": _FOLDS,
        "fingerprint_texts": _FINGERPRINT_TEXTS,
        "text_bytes": "SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS n_bytes, true AS fits FROM documents",
        "packed_documents": "SELECT doc_id, true AS whole, 0::BIGINT AS first, 0::BIGINT AS over, true AS one_short FROM documents",
    }
