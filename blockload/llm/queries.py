"""Queries of the operators, one ``opN_<name>`` each, with production
parameters over whole tables, and DuckDB texts for those that SQL expresses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockload.llm import (bpe, chat, collocations, exact_dedup, graph_dedup, mixing, ngram_join, suffix_dedup,
                           token_counts, topk, toxicity, warc, whitening)


def tokenizer_path(name: str) -> str:
    """A public tokenizer's file, from the package that holds them."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.span_report(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        F.col("doc_id").cast("long").alias("doc_id"), "p_unfit", "p_toxic", "rejected")


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "</s>[INST] ok [/INST]"
    extra = spark.range(1).select(F.lit(-1).cast("long").alias("conv_id"), F.to_variant_object(F.struct(
        F.lit(text).alias("prompt"), F.lit(text).alias("response"))).alias("record"))
    records = chat.conversation_records(table(spark, sf_dir, "conversations")).unionByName(extra)
    made = chat.format_turns(chat.canonical_turns(records))
    turns = chat.read_back(F.col("formatted"))
    said = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    masked = chat.masked_text(F.col("formatted"), F.col("loss_spans"))
    return made.select(
        "conv_id", F.size(turns).cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length(masked).cast("long").alias("loss_chars"), F.sha2(masked, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_records(table(spark, sf_dir, "pages"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded_digests(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), columns=["doc_id"]).select(
        F.col("doc_id").cast("long").alias("doc_id"), "size", "source_size", "target", "taken")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_topk": op2_topk,
    "op3_toxicity": op3_toxicity,
    "op4_chat": op4_chat,
    "op5_ngram_join": op5_ngram_join,
    "op6_token_counts": op6_token_counts,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_warc": op8_warc,
    "op9_bpe": op9_bpe,
    "op10_mix": op10_mix,
    "op11_whitening": op11_whitening,
    "op12_collocations": op12_collocations,
    "op13_exact_dedup": op13_exact_dedup,
}

ORACLE_SQL: dict[str, str] = {
    "op2_topk": """
        WITH v AS (
          SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS n,
                 row_number() OVER () AS i
          FROM embeddings
          WHERE embedding IS NOT NULL AND len(embedding) > 0
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
          SELECT q.vec_id AS query_id, c.vec_id AS vec_id, q.i,
                 list_sum(list_transform(list_zip(q.n, c.n), lambda p: p[1] * p[2]))::BIGINT AS score
          FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.i <> q.i AND len(q.n) = len(c.n)),
        r AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, vec_id) AS k FROM s)
        SELECT query_id, CAST(k AS INTEGER) AS rank, vec_id, score FROM r WHERE k <= 20""",
    "op4_chat": """
        WITH t AS (
          SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
          UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
          UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
        e AS (
          SELECT *, regexp_replace(text, '(<|\\[)(\\\\*)(/?(?:s>|INST\\]|SYS\\]))', '\\1\\\\\\2\\3', 'g') AS body FROM t)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
                 AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
                 FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(length('<s>' || role || chr(10) || body || '</s>' || chr(10))) AS BIGINT) AS formatted_chars
        FROM e GROUP BY conv_id""",
    "op8_warc": """
        WITH p AS (
          SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d FROM pages),
        f AS (SELECT d, max(page_id) AS first FROM p WHERE n >= 1000 GROUP BY d)
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, p.d AS payload_digest,
               CASE WHEN page_id < first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id < first THEN first END AS refers_to
        FROM p LEFT JOIN f ON p.d = f.d""",
    "op10_mix": """
        WITH e AS (
          SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
                 md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, ''))) AS o
          FROM documents),
        i AS (SELECT *, row_number() OVER (PARTITION BY source, o) - 1 AS m FROM e),
        d AS (SELECT doc_id, source, size, CASE WHEN m = 0 THEN o ELSE md5(o || ':' || m) END AS o FROM i),
        s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
        r AS (SELECT *, row_number() OVER (ORDER BY source COLLATE "binary" NULLS LAST) AS rank FROM s),
        w AS (SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight,
                     2 * source_size AS cap, sum(source_size) OVER () AS total FROM r),
        c AS (SELECT *, cap::DOUBLE / weight AS ratio,
                     coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, rank
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
                     sum(weight) OVER (ORDER BY cap::DOUBLE / weight, rank
                       ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left FROM w),
        l AS (SELECT ratio, rank, total * 3 - before * 2 AS spare, weight_left FROM c
              WHERE cap * weight_left * 2 > weight * (total * 3 - before * 2) ORDER BY ratio, rank LIMIT 1),
        t AS (SELECT c.source, c.rank, c.source_size, c.total,
                     CASE WHEN l.rank IS NULL OR (c.ratio, c.rank) < (l.ratio, l.rank) THEN c.cap::DOUBLE
                          ELSE (c.weight * l.spare)::DOUBLE / (l.weight_left * 2)::DOUBLE END AS target
              FROM c LEFT JOIN l ON true),
        u AS (SELECT d.*, t.rank, t.source_size, t.target, t.total,
                     sum(size) OVER (PARTITION BY t.rank ORDER BY o) AS cum
              FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
        k AS (SELECT rank, o, size, total, 0 AS copy, cum::DOUBLE / target AS f FROM u WHERE size > 0
              UNION ALL SELECT rank, o, size, total, 1, (cum + source_size)::DOUBLE / target FROM u WHERE size > 0),
        g AS (SELECT *, sum(size) OVER (ORDER BY f, rank, o) AS run FROM k),
        n AS (SELECT rank, o, copy, count(*) AS m FROM g WHERE run * 2 <= total * 3 GROUP BY rank, o, copy),
        taken AS (SELECT rank, o, count(*) AS copies FROM n GROUP BY rank, o)
        SELECT doc_id, size, source_size, target, (size * coalesce(copies, 0))::BIGINT AS taken
        FROM u LEFT JOIN taken USING (rank, o)""",
    "op5_ngram_join": """
        WITH RECURSIVE w AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
        g AS (
          SELECT DISTINCT doc_id, array_to_string(words[i:i + 3], ' ') AS gram
          FROM (SELECT doc_id, words, unnest(generate_series(1, greatest(len(words) - 3, 1))) AS i FROM w
                WHERE len(words) > 0)),
        n AS (SELECT doc_id, count(*) AS size FROM g GROUP BY doc_id),
        o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM g x JOIN g y USING (gram)
              WHERE x.doc_id < y.doc_id GROUP BY ALL),
        l AS (SELECT a, b FROM o JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
              WHERE 100 * common >= 85 * (p.size + q.size - common)),
        e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
        r(node, reach) AS (
          SELECT doc_id, doc_id FROM documents
          UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.reach)
        SELECT d.doc_id, CAST(coalesce(size, 0) AS BIGINT) AS n_shingles, component_id
        FROM documents d LEFT JOIN n USING (doc_id)
        JOIN (SELECT node AS doc_id, min(reach) AS component_id FROM r GROUP BY node) c USING (doc_id)""",
    "op7_embedding_dedup": """
        WITH RECURSIVE v AS (
          SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
          WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
            AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
        e AS (SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q ON p.vec_id <> q.vec_id AND len(p.x) = len(q.x)
              WHERE list_cosine_similarity(p.x, q.x) >= 0.9),
        r(node, reach) AS (
          SELECT vec_id, vec_id FROM embeddings
          UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.reach),
        c AS (SELECT node, min(reach) AS component_id FROM r GROUP BY node),
        n AS (SELECT a, count(*) AS links FROM e GROUP BY a)
        SELECT vec_id, coalesce(links, 0) AS n_links, component_id, vec_id = component_id AS kept
        FROM embeddings JOIN c ON node = vec_id LEFT JOIN n ON a = vec_id""",
    "op12_collocations": """
        WITH p AS (
          SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
          FROM documents),
        w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS t FROM p),
        s AS (SELECT lang, t, unnest(generate_series(1, len(t))) AS i FROM w WHERE len(t) > 0),
        f AS (SELECT lang, m, array_to_string(t[i:i + m - 1], ' ') AS phrase, count(*) AS f
              FROM s, (SELECT unnest([1, 2, 3]) AS m) WHERE i + m - 1 <= len(t) GROUP BY ALL),
        n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
        c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS t FROM f WHERE m > 1 AND f >= 10),
        kept AS (
          SELECT * FROM c WHERE m = 3 OR NOT EXISTS (
            SELECT 1 FROM c x WHERE x.m = 3 AND x.lang = c.lang AND 100 * x.a >= 50 * c.a
              AND (array_to_string(x.t[1:2], ' ') = c.phrase OR array_to_string(x.t[2:3], ' ') = c.phrase))),
        cuts AS (
          SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r,
                 (1000000::HUGEINT * c.a * c.a // (x.f::HUGEINT * y.f))::BIGINT AS score
          FROM (SELECT *, unnest(generate_series(1, m - 1)) AS k FROM kept) c
          JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.t[1:k], ' ')
          JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.t[k + 1:c.m], ' ')),
        best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
        SELECT lang, rank, phrase, a, l, r, n, score FROM r JOIN n USING (lang) WHERE rank <= 2000""",
    "op13_exact_dedup": """
        WITH t AS (
          SELECT doc_id, coalesce(length(text), 0) AS chars,
                 regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm FROM documents)
        SELECT doc_id, first(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
               row_number() OVER w = 1 AS kept, sha256(norm) AS text_sha256
        FROM t WINDOW w AS (PARTITION BY norm ORDER BY chars DESC, doc_id NULLS LAST)""",
}
