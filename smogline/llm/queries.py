"""The registered queries over these operators, with SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smogline.llm import bpe, embeddings, exact, langid, lines, mixing, negatives, phrases, pieces, pii, quality, simhash, warc
from smogline.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages archived and read back."""
    path = scratch_path(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    records = warc.parse_records(warc.read_records(spark, path))
    return records.select(warc.page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                          warc.page_of(F.col("refers_to")).alias("refers_to"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    taken = mixing.copies(mixing.sizes_of(table(spark, sf_dir, "documents")))
    return taken.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts cut into sampled pieces and put together again."""
    done = pieces.round_trip(table(spark, sf_dir, "documents"), pieces.Codec(spark))
    return done.select("doc_id", "ids", F.size("ids").cast("long").alias("n_pieces"), F.sha2("decoded", 256).alias("decoded_sha256"),
                       F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents inserted into an index of lines, then cleaned by it."""
    docs = table(spark, sf_dir, "documents")
    index = lines.LineIndex(spark, scratch_path(spark, "lines"))
    index.insert(docs)
    done = index.dedup(docs)
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts; the largest doc_id stays."""
    return exact.dedup(table(spark, sf_dir, "documents"), keep="largest")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of close fingerprints."""
    found = simhash.groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data by fixed patterns and by what was learnt from all texts."""
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.fit(docs)).withColumn("base_sha256", F.sha2("base", 256)).drop("base")


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages as learnt from the documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs))


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of close vectors with equal labels."""
    return embeddings.dedup(table(spark, sf_dir, "embeddings"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores as learnt from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of every language."""
    return phrases.mine(table(spark, sf_dir, "documents"))


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, labels mixed up where the id is divisible by 7."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), label=label)


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts as token ids, and the ids as text again."""
    codec = bpe.Codec(spark)
    done = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), codec), codec)
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {
    "op1_warc": op1_warc,
    "op2_mixing": op2_mixing,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_line_dedup": op4_line_dedup,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_simhash": op6_simhash,
    "op7_pii": op7_pii,
    "op8_langid": op8_langid,
    "op9_embeddings": op9_embeddings,
    "op10_quality": op10_quality,
    "op11_phrases": op11_phrases,
    "op12_negatives": op12_negatives,
    "op13_bpe": op13_bpe,
}

SQL = {
    "op1_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS body FROM pages
        ), h AS (
            SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes, sha1(body) AS hex,
                   min(page_id) OVER (PARTITION BY body) AS first_id FROM p
        )
        SELECT page_id, payload_bytes,
               list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   CAST(((CAST('0x' || substr(hex, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT) >> CAST(5 * (3 - i % 4) AS INTEGER)) & 31) + 1 AS BIGINT), 1)),
                   'string_agg', '') AS payload_digest,
               CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first_id THEN first_id END AS refers_to
        FROM h""",
    "op2_mixing": r"""
        WITH d AS (
            SELECT doc_id, source, coalesce('s' || source, '') AS key,
                   CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
        ), per AS (
            SELECT source, key, CAST(sum(size) AS BIGINT) AS source_size,
                   [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM d GROUP BY source, key
        ), run AS (
            SELECT *, 3 * source_size / weight AS full_at, row_number() OVER o AS pos,
                   (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER b, 0))
                   / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS share
            FROM per WINDOW o AS (ORDER BY 3 * source_size / weight, source NULLS LAST),
                            b AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ), goal AS (
            SELECT key, source_size, least(CAST(3 * source_size AS DOUBLE),
                       weight * (SELECT share FROM run WHERE full_at >= share ORDER BY pos LIMIT 1)) AS target,
                   CAST('0x' || substr(md5('42|' || key), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS off FROM run
        ), placed AS (
            SELECT doc_id, size, source_size, target, off,
                   CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
                   row_number() OVER (PARTITION BY key ORDER BY size, md5(coalesce(CAST(doc_id AS VARCHAR), '')), doc_id) AS n
            FROM d JOIN goal USING (key)
        )
        SELECT doc_id, size, source_size, target,
               size * CAST(floor(off + n * rate) - floor(off + (n - 1) * rate) AS BIGINT) AS taken FROM placed""",
    "op4_line_dedup": r"""
        WITH l AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents
        ), k AS (
            SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
        ), c AS (
            SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
        ), j AS (
            SELECT doc_id, line, pos, coalesce(doc_id <> top, false) AS dropped FROM k LEFT JOIN c USING (key)
        )
        SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (dropped) AS BIGINT) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
        FROM j GROUP BY doc_id""",
    "op5_exact_dedup": """
        WITH d AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
            FROM documents
        )
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
        FROM d WINDOW g AS (PARTITION BY norm)""",
    "op9_embeddings": """
        WITH RECURSIVE e AS (
            SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
        ), p AS (
            SELECT a.vec_id AS x, b.vec_id AS y FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id
            WHERE list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v) * list_dot_product(b.v, b.v)) >= 0.98
        ), r AS (
            SELECT vec_id, vec_id AS c FROM e UNION SELECT p.y, r.c FROM r JOIN p ON p.x = r.vec_id
        ), c AS (
            SELECT vec_id, min(c) AS component_id FROM r GROUP BY vec_id
        )
        SELECT e.vec_id, (SELECT count(*) FROM p WHERE p.x = e.vec_id) AS n_links, component_id, e.vec_id = component_id AS kept
        FROM e JOIN c USING (vec_id)""",
    "op11_phrases": r"""
        WITH p AS (
            SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(regexp_split_to_array(translate(coalesce(text, ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
        ), s AS (
            SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p
        ), g AS (
            SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i : i + k - 1])) AS words
            FROM s, range(1, 5) AS sizes(k)
        ), f AS (
            SELECT lang, k, words, count(*) AS f FROM g GROUP BY ALL
        ), n AS (
            SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang
        ), c AS (
            SELECT * FROM f WHERE k > 1 AND f >= 30
        ), parts AS (
            SELECT *, words[1 : m] AS head, words[m + 1 : k] AS rest FROM (SELECT *, unnest(range(1, k)) AS m FROM c)
        ), cuts AS (
            SELECT parts.lang, parts.words, parts.f AS a, h.f AS l, t.f AS r, m,
                   CAST(CAST(2000000 AS HUGEINT) * parts.f // (h.f + t.f) AS BIGINT) AS score
            FROM parts JOIN f h ON h.lang = parts.lang AND h.words = head JOIN f t ON t.lang = parts.lang AND t.words = rest
        ), best AS (
            SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, m) = 1
        ), inner_ AS (
            SELECT lang, k, f, unnest([words[1 : k - 1], words[2 : k]]) AS words FROM c WHERE k > 2
            UNION ALL
            SELECT lang, k, f, unnest([words[1 : 2], words[2 : 3], words[3 : 4]]) FROM c WHERE k = 4
        ), most AS (
            SELECT lang, words, max(f) AS f FROM inner_ GROUP BY ALL
        ), kept AS (
            SELECT best.lang, array_to_string(best.words, ' ') AS phrase, a, l, r, score FROM best LEFT JOIN most USING (lang, words)
            WHERE most.f IS NULL OR 100 * most.f < 80 * a
        )
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
        FROM kept JOIN n USING (lang) QUALIFY rank <= 2000""",
    "op12_negatives": """
        WITH e AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
            FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
                   CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
            FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
        ), p AS (
            SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
        )
        SELECT p.anchor_id, p.other AS positive_id,
               CAST(row_number() OVER (PARTITION BY p.anchor_id, p.other ORDER BY n.score DESC, n.other) AS INTEGER) AS rank,
               n.other AS negative_id, p.score AS positive_score, n.score AS negative_score
        FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same
        WHERE 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score QUALIFY rank <= 5""",
}
