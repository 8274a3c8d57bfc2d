"""The driver queries of this subpackage, and DuckDB twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.llm import (
    collocations, edits, idfiles, jaccard, lines, merkle, minmax, packing, quality_rank, quality_rules, topk,
    toxicity, wordtable,
)
from stationflow.llm.idfiles import Encoding
from stationflow.llm.store import documents, table

# The vocabulary files are parameters of the operators; these are the registered ones.
BYTE_FILE = public_tokenizers.path("byte_bpe_50k.json")
WORD_FILE = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2


def q1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules: word counts and base rules of every whole text, then the trained model's verdict. A
    null or empty text has no word and fails; repeated rows and ties are judged alike."""
    docs = documents(spark, sf_dir)
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return quality_rules.judge(docs, quality_rules.train(docs, labels))


def q2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files: ids of every whole text with the end id, read back from the files. A null text is empty
    (its end id only); repeated rows and rows that share doc_id stay rows of their own, in a fixed
    order."""
    return idfiles.op2_token_files(spark, documents(spark, sf_dir), Encoding(WORD_FILE, "word", END_ID))


def q3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every whole text by pairwise ranking. Null and empty texts get a score too;
    repeated rows get the same score."""
    return quality_rank.op3_scores(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def q4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of three-word shingles agree to 90 %. A null or empty text links
    with nothing; repeated rows are documents of one component."""
    return jaccard.op4_components(documents(spark, sf_dir))


def q5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose key ten documents hold go from all of them. A null or empty text is one empty line;
    repeated rows count as documents of their own."""
    return lines.op5_lines(documents(spark, sf_dir))


def q6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts after two edits of every document, made one after the other on stored trees. A null
    text is empty; repeated rows are counted alike."""
    return edits.op6_counts(documents(spark, sf_dir), Encoding(BYTE_FILE, "byte"))


def q7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents packed into sequences of at most 1024 tokens. A null text is its end id
    only; repeated rows are packed as pieces of their own."""
    return packing.pack_documents(documents(spark, sf_dir), Encoding(BYTE_FILE, "byte", END_ID))[1]


def q8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text through the table of distinct words, and the text decoded from them. A null
    text is empty; repeated rows give repeated rows."""
    return wordtable.op8_digests(documents(spark, sf_dir), Encoding(BYTE_FILE, "byte"))


def q9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five largest inner products of every 50th vector with all others, ties to the smaller id.
    Vectors that are null or hold null or non-finite components take no part."""
    return topk.op9_search(table(spark, sf_dir, "embeddings"))


def q10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every whole text by its maximal segments. Null and empty texts get the score of no
    evidence; repeated rows get the same score."""
    return toxicity.op10_scores(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def q11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle manifest of all documents, and the check of each leaf after half of them were
    tampered with. A null field has a mark of its own; rows that share doc_id are leaves of
    their own, in the order of their digests."""
    return merkle.op11_rows(documents(spark, sf_dir))


def q12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of three-word shingles agree to 85 %, found by min-max
    hashing. A null or empty text links with nothing; repeated rows are of one component."""
    return minmax.op12_rows(documents(spark, sf_dir))


def q13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 collocations of each language, counted over all whole texts. A null text is
    empty, a null language is und; ties end with the phrase; repeated rows count again."""
    return collocations.op13_rows(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": q1,
    "op2_token_files": q2,
    "op3_quality_rank": q3,
    "op4_jaccard_join": q4,
    "op5_line_dedup": q5,
    "op6_edit_counts": q6,
    "op7_packing": q7,
    "op8_word_table": q8,
    "op9_topk": q9,
    "op10_toxicity": q10,
    "op11_merkle": q11,
    "op12_minmax": q12,
    "op13_collocations": q13,
}

# Linked documents by their sets of three-word shingles: classes of equal sets, links
# between classes, and the smallest doc_id that each class reaches.
LINKED_SQL = """WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^ \\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT rid, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                               ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
                          END AS s FROM w),
c AS (SELECT min(rid) AS cid, s, len(s) AS n FROM (SELECT rid, list_sort(s) AS s FROM s) WHERE len(s) > 0 GROUP BY s),
m AS (SELECT rid, cid FROM (SELECT rid, list_sort(s) AS s FROM s) JOIN c USING (s)),
e AS (SELECT cid, n, unnest(s) AS x FROM c),
o AS (SELECT a.cid AS a, b.cid AS b, a.n + b.n AS total, count(*) AS shared FROM e a JOIN e b ON a.x = b.x AND a.cid <> b.cid
      GROUP BY ALL),
l AS (SELECT a, b FROM o WHERE 100 * shared >= PERCENT * (total - shared)),
r(a, b) AS (SELECT cid, cid FROM c UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
g AS (SELECT r.a AS cid, min(doc_id) AS component_id FROM r JOIN m ON m.cid = r.b JOIN s USING (rid) GROUP BY r.a)"""

ORACLE: dict[str, str] = {
    "op5_line_dedup": """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts
           FROM documents),
l AS (SELECT rid, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM d),
k AS (SELECT rid, pos, line,
             translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
common AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT rid) >= 10),
m AS (SELECT k.*, common.key IS NOT NULL AS gone FROM k LEFT JOIN common USING (key)),
g AS (SELECT rid, count(*) AS n_lines, sum(gone::BIGINT)::BIGINT AS n_dropped,
             coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS kept
      FROM m GROUP BY rid)
SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM g JOIN d USING (rid)""",
    "op4_jaccard_join": LINKED_SQL.replace("PERCENT", "90") + """,
d AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, CASE WHEN len(s) > 0 THEN component_id ELSE doc_id END AS component_id,
       coalesce(n_links, 0) AS n_links
FROM s LEFT JOIN m USING (rid) LEFT JOIN g USING (cid) LEFT JOIN d ON d.a = m.cid""",
    "op9_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
             vec_id, score FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op11_merkle": """
WITH RECURSIVE
d AS (SELECT doc_id, source, text, replace(text, chr(10), '') AS cut,
        coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
        || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
        list_reduce(list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT),
          lambda c, b: list_reduce(range(8), lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END,
                                   xor(c, b)), 4294967295) % 2 = 1 AS picked
      FROM documents),
leaves AS (SELECT doc_id, coalesce('=' || source, '') AS g,
             sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS d,
             CASE WHEN picked THEN sha256(head || coalesce(strlen(cut) || ':' || cut, '-')) END AS t FROM d),
numbered AS (SELECT *, row_number() OVER () AS rid, count(*) OVER (PARTITION BY g) AS n,
               row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, d) - 1 AS place FROM leaves),
nodes(g, lvl, place, n, d) AS (
  SELECT g, 0, place, n, d FROM numbered UNION ALL
  SELECT g, lvl + 1, place // 3, (n + 2) // 3, sha256(string_agg(d, '' ORDER BY place)) FROM nodes WHERE n > 1 GROUP BY g, lvl, place // 3, n),
runs AS (SELECT g, lvl, place // 3 AS r, list(d ORDER BY place) AS ds FROM nodes WHERE n > 1 GROUP BY g, lvl, place // 3),
tops AS (SELECT g, d, row_number() OVER (ORDER BY g) - 1 AS place, count(*) OVER () AS n FROM nodes WHERE n = 1),
upper(lvl, place, n, d) AS (
  SELECT 0, place, n, d FROM tops UNION ALL
  SELECT lvl + 1, place // 3, (n + 2) // 3, sha256(string_agg(d, '' ORDER BY place)) FROM upper WHERE n > 1 GROUP BY lvl, place // 3, n),
upper_runs AS (SELECT lvl, place // 3 AS r, list(d ORDER BY place) AS ds FROM upper WHERE n > 1 GROUP BY lvl, place // 3),
fold(rid, g, lvl, place, d, proof) AS (
  SELECT rid, g, 0, place, coalesce(t, d), '' FROM numbered UNION ALL
  SELECT rid, f.g, f.lvl + 1, f.place // 3,
         sha256(array_to_string(ds[1:place % 3], '') || f.d || array_to_string(ds[place % 3 + 2:], '')),
         proof || array_to_string(ds[1:place % 3], '') || array_to_string(ds[place % 3 + 2:], '')
  FROM fold f JOIN runs ON runs.g = f.g AND runs.lvl = f.lvl AND runs.r = f.place // 3),
reached AS (SELECT rid, arg_max(d, lvl) AS d, arg_max(proof, lvl) AS proof FROM fold GROUP BY rid),
above(rid, lvl, place, d, proof) AS (
  SELECT rid, 0, tops.place, reached.d, proof FROM reached JOIN numbered USING (rid) JOIN tops ON tops.g = numbered.g UNION ALL
  SELECT rid, f.lvl + 1, f.place // 3,
         sha256(array_to_string(ds[1:place % 3], '') || f.d || array_to_string(ds[place % 3 + 2:], '')),
         proof || array_to_string(ds[1:place % 3], '') || array_to_string(ds[place % 3 + 2:], '')
  FROM above f JOIN upper_runs u ON u.lvl = f.lvl AND u.r = f.place // 3),
final AS (SELECT rid, arg_max(d, lvl) AS d, arg_max(proof, lvl) AS proof FROM above GROUP BY rid)
SELECT doc_id, numbered.d AS leaf, tops.d AS subroot, (SELECT d FROM upper WHERE n = 1) AS root,
       sha256(proof) AS proof_sha256, final.d AS folded_root, final.d = (SELECT d FROM upper WHERE n = 1) AS verified
FROM numbered JOIN tops USING (g) JOIN final USING (rid)""",
    "op12_minmax": LINKED_SQL.replace("PERCENT", "85") + """
SELECT doc_id, len(s)::BIGINT AS n_shingles, CASE WHEN len(s) > 0 THEN component_id ELSE doc_id END AS component_id,
       doc_id IS NOT DISTINCT FROM (CASE WHEN len(s) > 0 THEN component_id ELSE doc_id END) AS kept
FROM s LEFT JOIN m USING (rid) LEFT JOIN g USING (cid)""",
    "op13_collocations": """
WITH t AS (SELECT coalesce(lang, 'und') AS lang,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM t),
w AS (SELECT lang, regexp_extract_all(piece, '[^ \\x09]+') AS w FROM p),
f AS (SELECT lang, k AS words, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*)::HUGEINT AS f
      FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3]) AS k)) GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f WHERE words = 1 GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE words > 1 AND f >= 10),
cuts AS (SELECT c.lang, c.phrase, c.words, c.f AS a, k, h.f AS l, t.f AS r, (1000000::HUGEINT * c.f * c.f) // (h.f * t.f) AS score
         FROM (SELECT *, unnest(range(1, words)) AS k FROM c) c
         JOIN f h ON h.lang = c.lang AND h.phrase = array_to_string(c.w[1:k], ' ')
         JOIN f t ON t.lang = c.lang AND t.phrase = array_to_string(c.w[k + 1:], ' ')),
b AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
x AS (SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, f FROM c WHERE words = 3),
y AS (SELECT lang, phrase, max(f) AS longer FROM x GROUP BY ALL),
k AS (SELECT b.* FROM b LEFT JOIN y USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM k)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM r JOIN n USING (lang) WHERE rank <= 2000""",
}
