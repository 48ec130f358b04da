"""The numbered operators as queries over the shared tables, with SQL twins where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm import graph_search, phrases, prefix_trie, secret_scan, toxicity
from corpusflow.llm.bpe import encode
from corpusflow.llm.byte_spans import remove_repeats
from corpusflow.llm.fingerprints import with_edits
from corpusflow.llm.lang_id import held_out, identify, train
from corpusflow.llm.line_join import remove_lines
from corpusflow.llm.mixing import mix
from corpusflow.llm.set_join import link_classes
from corpusflow.llm.substrings import deduplicate

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(run: Callable[[SparkSession, str], DataFrame]):
    QUERIES[run.__name__] = run
    return run


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@_query
def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


@_query
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = encode(
        docs, path, public_tokenizers.PATTERN, outputs=("n_tokens", "ids_text", "decoded")
    )
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids_text", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@_query
def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_edits(docs).withColumnRenamed("id", "doc_id")


@_query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(docs, ~held_out("doc_id"))
    texts = docs.select("doc_id", held_out("doc_id").alias("held_out"), "text")
    return identify(texts, model).select("doc_id", "held_out", "lang_pred", "score")


@_query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.train(docs.where(~held_out("doc_id")), labels)
    texts = docs.select("doc_id", held_out("doc_id").alias("held_out"), "text")
    return toxicity.score(texts, model, keep_text=False).select("doc_id", "held_out", "score", "predicted")


@_query
def op3_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    shards = graph_search.shards_for(vectors)
    graphs = graph_search.index(vectors, k=10, shards=shards)
    queries = vectors.where("vec_id % 100 = 0")
    return graph_search.search(graphs, queries, k=10, shards=shards)


@_query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return deduplicate(docs, size=13).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


@_query
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return link_classes(docs).select("doc_id", "n_shingles", "component_id")


@_query
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs, length=200).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@_query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_lines(docs).select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


@_query
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.turns_of(_table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(prefix_trie.with_borrowed_heads(turns))


@_query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(_table(spark, sf_dir, "documents").select("text", "lang"))


@_query
def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs)
    return found.select(
        "doc_id",
        *[secret_scan.of_kind(k).alias(f"n_{k}") for k in secret_scan.BASE],
        F.sha2(secret_scan.listed(kinds=secret_scan.BASE), 256).alias("base_sha256"),
        secret_scan.listed().alias("spans"),
    )


# --- the same in SQL, where SQL can express it ---------------------------------------------

_SPLIT = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_LOWERED = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)

ORACLE["op1_substring_dedup"] = f"""
WITH d AS (SELECT doc_id, {_SPLIT.format("coalesce(text, '')")} AS ws FROM documents),
     runs AS (SELECT doc_id, i, md5(array_to_string(list_slice(ws, i, i + 12), ' ')) AS k
              FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM d)),
     firsts AS (SELECT k, min(doc_id) AS first FROM runs GROUP BY k),
     gone AS (SELECT doc_id, list(DISTINCT place) AS places
              FROM (SELECT doc_id, unnest(range(i, i + 13)) AS place
                    FROM runs JOIN firsts USING (k) WHERE first < doc_id)
              GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(len(places), 0) AS n_removed,
       sha256(array_to_string(list_filter(ws, lambda x, i: places IS NULL
              OR NOT list_contains(places, i)), ' ')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id)
"""

ORACLE["op6_jaccard_join"] = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_SPLIT.format(_LOWERED)} AS ws FROM documents),
     s AS (SELECT DISTINCT doc_id, md5(array_to_string(list_slice(ws, i, i + 4), ' ')) AS k
           FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i
                 FROM d WHERE len(ws) > 0)),
     n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
     links AS (SELECT c.a, c.b
               FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y USING (k)
                     WHERE x.doc_id <> y.doc_id GROUP BY ALL) c
               JOIN n na ON na.doc_id = c.a JOIN n nb ON nb.doc_id = c.b
               WHERE 100 * c.c >= 75 * (na.n + nb.n - c.c)),
     reach AS (SELECT doc_id AS a, doc_id AS b FROM documents
               UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) LEFT JOIN n USING (doc_id)
"""

ORACLE["op2_suffix_dedup"] = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
     starts AS (SELECT doc_id, i, md5(substr(h, 2 * i - 1, 400)) AS k
                FROM (SELECT doc_id, h, unnest(range(1, len(h) // 2 - 198)) AS i FROM d)),
     often AS (SELECT k FROM starts GROUP BY k HAVING count(*) > 1),
     hits AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS prior
              FROM starts SEMI JOIN often USING (k)),
     spans AS (SELECT doc_id, min(i) AS a, max(i) + 200 AS b
               FROM (SELECT doc_id, i, sum(CASE WHEN prior IS NULL OR i > prior + 200 THEN 1 ELSE 0 END)
                            OVER (PARTITION BY doc_id ORDER BY i) AS run FROM hits)
               GROUP BY doc_id, run),
     cut AS (SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, list(a ORDER BY a) AS a,
                    list(b ORDER BY b) AS b FROM spans GROUP BY doc_id)
SELECT doc_id, len(h) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN a IS NULL THEN h ELSE array_to_string(
              list_transform(range(0, len(a) + 1), lambda j: substr(h,
                  CASE WHEN j = 0 THEN 1 ELSE 2 * b[j] - 1 END,
                  CASE WHEN j = len(a) THEN len(h) ELSE 2 * a[j + 1] - 2 END
                  - CASE WHEN j = 0 THEN 0 ELSE 2 * b[j] - 2 END)), '') END)) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""

ORACLE["op12_collocations"] = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang,
                  translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
     pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM d WHERE t IS NOT NULL),
     w AS (SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM pieces),
     f AS (SELECT lang, k, array_to_string(list_slice(ws, i, i + k - 1), ' ') AS phrase, count(*) AS n
           FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
                 FROM w, (VALUES (1), (2), (3)) sizes(k) WHERE len(ws) >= k)
           GROUP BY ALL),
     c AS (SELECT lang, k, phrase, n, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND n >= 10),
     cuts AS (SELECT c.lang, c.phrase, c.k, c.n AS a, cut, lf.n AS l, rf.n AS r,
                     ((1000000::HUGEINT * c.n * c.n) // (lf.n::HUGEINT * rf.n))::BIGINT AS score
              FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) c
              JOIN f lf ON lf.lang = c.lang AND lf.phrase = array_to_string(list_slice(c.ws, 1, cut), ' ')
              JOIN f rf ON rf.lang = c.lang AND rf.phrase = array_to_string(list_slice(c.ws, cut + 1, c.k), ' ')),
     scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
     longer AS (SELECT lang, part AS phrase, max(n) AS most
                FROM (SELECT lang, n, unnest([array_to_string(list_slice(ws, 1, 2), ' '),
                                              array_to_string(list_slice(ws, 2, 3), ' ')]) AS part FROM c WHERE k = 3)
                GROUP BY ALL),
     left_over AS (SELECT scored.* FROM scored LEFT JOIN longer ON scored.k = 2 AND longer.lang = scored.lang
                   AND longer.phrase = scored.phrase WHERE most IS NULL OR 100 * most < 50 * a),
     ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM left_over)
SELECT lang, rank, phrase, a, l, r, (SELECT sum(n)::BIGINT FROM f WHERE f.lang = ranked.lang AND f.k = 1) AS n, score
FROM ranked WHERE rank <= 2000
"""

# Unsigned crc32 of a decimal text, bit by bit; SQL has no function for it.
_CRC32 = """xor(4294967295::BIGINT, list_reduce(list_transform(string_split({}, ''), lambda x: ord(x)::BIGINT),
    lambda crc, byte: list_reduce(range(8), lambda c, i: xor(c >> 1, 3988292384::BIGINT * (c & 1)), xor(crc, byte)),
    4294967295::BIGINT))"""

ORACLE["op11_conversation_trie"] = rf"""
WITH t AS (SELECT conv_id, coalesce(text, '') AS text, turn,
                  md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS token
           FROM conversations WHERE conv_id IS NOT NULL),
     own AS (SELECT conv_id, list({{'token': token, 'words': len(regexp_extract_all(text, '[^ 	-
]+'))}}
                                  ORDER BY turn NULLS FIRST, token) AS ts FROM t GROUP BY conv_id),
     h AS (SELECT conv_id, ts, {_CRC32.format("conv_id::VARCHAR")} % 4 AS h FROM own),
     c AS (SELECT h.conv_id AS c, list_concat(coalesce(list_slice(b.ts, 1, h.h), []), list_slice(h.ts, h.h + 1, len(h.ts))) AS ts
           FROM h LEFT JOIN own b ON b.conv_id = h.conv_id - h.conv_id % 20),
     p AS (SELECT c, len(ts) AS n, d, CASE WHEN d > 0 THEN ts[d].words ELSE 0 END AS words,
                  md5(array_to_string(list_transform(list_slice(ts, 1, d), lambda x: x.token), '')) AS k
           FROM (SELECT c, ts, unnest(range(0, len(ts) + 1)) AS d FROM c)),
     nodes AS (SELECT k, d, min(c) AS conv_id, count(*) AS n_convs, max(words) AS words,
                      sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = d), '')) AS ends_sha256
               FROM p GROUP BY k, d),
     up AS (SELECT nodes.*, pn.conv_id AS parent_conv_id, pn.k AS parent FROM nodes
            LEFT JOIN p ON p.c = nodes.conv_id AND p.d = nodes.d - 1
            LEFT JOIN nodes pn ON pn.k = p.k AND pn.d = p.d),
     kids AS (SELECT parent AS k, d - 1 AS d, count(*) AS n_children FROM up WHERE parent IS NOT NULL GROUP BY ALL),
     full_nodes AS (SELECT up.*, coalesce(n_children, 0) AS n_children FROM up LEFT JOIN kids USING (k, d)),
     sums AS (SELECT a.k, a.d, sum((f.n_convs - 1) * f.words)::BIGINT AS saved_tokens,
                     count(*) FILTER (f.n_children = 0) AS n_leaves
              FROM full_nodes f JOIN p a ON a.c = f.conv_id AND a.d <= f.d GROUP BY ALL)
SELECT conv_id, d::BIGINT AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM full_nodes JOIN sums USING (k, d)
"""
