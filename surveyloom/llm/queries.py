"""The operators on the driver's tables, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from surveyloom.llm.collocations import collocations
from surveyloom.llm.fingerprints import edited_fingerprints
from surveyloom.llm.licenses import license_scan
from surveyloom.llm.line_dedup import LineRule, drop_repeated_lines
from surveyloom.llm.mixing import mix_sources
from surveyloom.llm.near_dups import NearRule, near_duplicates
from surveyloom.llm.packing import pack
from surveyloom.llm.pii import digests, find_personal_data
from surveyloom.llm.prefix_trie import prefix_trie
from surveyloom.llm.quality import quality
from surveyloom.llm.substring_dedup import remove_repeats
from surveyloom.llm.topk import quantised, top_scores
from surveyloom.llm.toxicity import toxicity


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(table(spark, sf, "documents"), NearRule(shingle=2))


def op2_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf, "documents"))


def op3_packing(spark: SparkSession, sf: str) -> DataFrame:
    return pack(table(spark, sf, "documents"))


def op4_licenses(spark: SparkSession, sf: str) -> DataFrame:
    return license_scan(table(spark, sf, "documents"))


def op5_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mix_sources(table(spark, sf, "documents")).drop("text_key")


def op6_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op7_top_scores(spark: SparkSession, sf: str) -> DataFrame:
    vectors = quantised(table(spark, sf, "embeddings"))
    return top_scores(vectors, vectors.where("vec_id % 20 = 0"))


def op8_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    return digests(find_personal_data(table(spark, sf, "documents")))


def op9_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return drop_repeated_lines(table(spark, sf, "documents"), LineRule(short=True)).drop("kept_text", "carried")


def op10_repeated_passages(spark: SparkSession, sf: str) -> DataFrame:
    return remove_repeats(table(spark, sf, "documents")).drop("kept_text")


def op11_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op12_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_trie(table(spark, sf, "conversations"), share=True).drop("turn_key")


def op13_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations(table(spark, sf, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_duplicates": op1_near_duplicates,
    "op2_fingerprints": op2_fingerprints,
    "op3_packing": op3_packing,
    "op4_licenses": op4_licenses,
    "op5_mixing": op5_mixing,
    "op6_toxicity": op6_toxicity,
    "op7_top_scores": op7_top_scores,
    "op8_personal_data": op8_personal_data,
    "op9_line_dedup": op9_line_dedup,
    "op10_repeated_passages": op10_repeated_passages,
    "op11_quality": op11_quality,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_collocations": op13_collocations,
}

_WORDS = r"'[^\x20\x09-\x0D]+'"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: The others have no SQL form, or none that ends in time: see the tests.
SQL: dict[str, str] = {
    "op1_near_duplicates": f"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(coalesce({_LOWER}, ''), {_WORDS}) AS w FROM documents),
 s AS (SELECT doc_id, unnest(CASE WHEN len(w) > 1 THEN list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))
   ELSE w END) AS g FROM d),
 n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
 common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
 link AS (SELECT x, y FROM common JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
 two AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
 reach(doc_id, other) AS (SELECT x, x FROM two UNION SELECT reach.doc_id, two.y FROM reach JOIN two ON two.x = reach.other),
 part AS (SELECT doc_id, min(other) AS low FROM reach GROUP BY 1)
 SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(low, doc_id) AS component_id, coalesce(low, doc_id) = doc_id AS kept
 FROM d LEFT JOIN n USING (doc_id) LEFT JOIN part USING (doc_id)""",
    "op7_top_scores": """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
   WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
 p AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
   FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0),
 r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score FROM p)
 SELECT * FROM r WHERE rank <= 20""",
    "op10_repeated_passages": f"""WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS w FROM documents),
 x AS (SELECT doc_id, w, unnest(range(0, greatest(len(w) - 19, 0))) AS s FROM d),
 g AS (SELECT doc_id, s, array_to_string(w[s + 1:s + 20], ' ') AS k FROM x),
 l AS (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS place FROM g),
 gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM l WHERE place > 1),
 t AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM d),
 k AS (SELECT t.doc_id, count(*) AS n_words, count(gone.i) AS n_removed,
   string_agg(CASE WHEN gone.i IS NULL THEN word END, ' ' ORDER BY t.i) AS kept
   FROM t LEFT JOIN gone ON gone.doc_id = t.doc_id AND gone.i = t.i GROUP BY 1)
 SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
 FROM d LEFT JOIN k USING (doc_id)""",
    "op12_prefix_trie": """WITH t AS (SELECT conv_id AS c, turn, strlen(coalesce(text, '')) AS b,
   sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k FROM conversations WHERE conv_id IS NOT NULL),
 own AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, k) - 1 AS i, k, b FROM t),
 ids AS (SELECT c, c - c % 5 AS g, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: ascii(x))),
   lambda a, x: list_reduce(list_prepend(xor(a, x), [0, 0, 0, 0, 0, 0, 0, 0]), lambda y, z: xor(y >> 1, (y & 1) * 3988292384))), 4294967295) % 9 AS h
   FROM (SELECT DISTINCT c FROM t)),
 whole AS (SELECT ids.c, i, k, b FROM ids JOIN own ON own.c = g AND i < h UNION ALL SELECT c, i, k, b FROM own JOIN ids USING (c) WHERE i >= h),
 seq AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY i) AS d, k, b FROM whole),
 pre AS (SELECT c, d, b, sha256(string_agg(k, '') OVER (PARTITION BY c ORDER BY d)) AS p FROM seq UNION ALL SELECT c, 0, 0, '' FROM ids),
 top AS (SELECT c, max(d) AS last FROM pre GROUP BY 1),
 node AS (SELECT p, min(c) AS conv_id, min(d) AS depth, min(b) AS b, count(*) AS n_convs,
   sha256(coalesce(string_agg(CASE WHEN d = last THEN c END, ',' ORDER BY c), '')) AS ends_sha256 FROM pre JOIN top USING (c) GROUP BY 1),
 up AS (SELECT node.p, pre.p AS q FROM node JOIN pre ON pre.c = conv_id AND d = depth - 1),
 kid AS (SELECT q AS p, count(*) AS n_children FROM up GROUP BY 1),
 below AS (SELECT a.p, count(CASE WHEN n_children IS NULL THEN 1 END) AS n_leaves, sum((n_convs - 1) * n.b) AS saved
   FROM node n LEFT JOIN kid USING (p) JOIN pre a ON a.c = n.conv_id AND a.d <= n.depth GROUP BY 1)
 SELECT n.conv_id, n.depth, o.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
   CAST(saved AS BIGINT) AS saved_tokens, n.ends_sha256
 FROM node n JOIN below USING (p) LEFT JOIN kid USING (p) LEFT JOIN up USING (p) LEFT JOIN node o ON o.p = up.q""",
    "op13_collocations": f"""WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(coalesce({_LOWER}, ''), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
 w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p),
 size AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY 1),
 x AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
   FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(w) >= k),
 f AS (SELECT lang, k, phrase, count(*) AS a FROM x GROUP BY ALL HAVING count(*) >= 100),
 c AS (SELECT lang, k, phrase, a, unnest(range(1, k)) AS cut, string_split(phrase, ' ') AS s FROM f WHERE k > 1),
 s AS (SELECT c.lang, c.k, c.phrase, c.a, cut, l.a AS l, r.a AS r, n,
   (CAST(1000 AS HUGEINT) * c.a * n) // (CAST(l.a AS HUGEINT) * r.a) AS score
   FROM c JOIN size USING (lang) JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.s[1:cut], ' ')
   JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.s[cut + 1:], ' ')),
 best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS o FROM s),
 part AS (SELECT lang, k, a, unnest([array_to_string(s[1:k - 1], ' '), array_to_string(s[2:], ' ')]) AS phrase FROM c WHERE cut = 1),
 gone AS (SELECT DISTINCT f.lang, f.phrase FROM f JOIN part USING (lang, phrase) WHERE 100 * part.a >= 100 * f.a)
 SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM (
   SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
   FROM best ANTI JOIN gone USING (lang, phrase) WHERE o = 1) WHERE rank <= 2000""",
}
