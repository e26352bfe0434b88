"""One query per operator of this package over the driver tables, and its SQL where there is one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from insight.llm import (
    audit,
    bpe,
    exact,
    infill,
    language,
    lines,
    near,
    packing,
    quality,
    substrings,
    topk,
    urls,
    warc,
)
from insight.llm.shared import scratch_folder

QUERIES = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None):
    def register(build):
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return register


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query()
def op1_near(spark, folder):
    return near.near_duplicates(_table(spark, folder, "documents"))


@_query()
def op2_bpe(spark, folder):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    docs = _table(spark, folder, "documents")
    decoded = bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2("id_bytes", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


@_query(
    r"""WITH t AS (SELECT doc_id,
        regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
    SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = min(doc_id) OVER w AS kept, sha256(body) AS text_sha256
    FROM t WINDOW w AS (PARTITION BY body)"""
)
def op3_exact(spark, folder):
    return exact.dedup_exact(_table(spark, folder, "documents"))


_BASE32 = " || ".join(
    "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
    f"((('0x' || substr(h, {5 * g + 1}, 5))::INT >> {s}) & 31) + 1, 1)"
    for g in range(8)
    for s in (15, 10, 5, 0)
)


@_query(
    f"""WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
        sha1(coalesce(html, '')) AS h FROM pages),
      f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first_id FROM p)
    SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
           CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> first_id THEN first_id END AS refers_to FROM f"""
)
def op4_warc(spark, folder):
    archives = scratch_folder(spark)
    warc.write_archives(_table(spark, folder, "pages"), archives)
    records = warc.read_archives(spark, archives)
    return warc.resolve_revisits(records).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@_query(
    """WITH v AS (SELECT vec_id,
        list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
        WHERE embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
      s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
        FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
      r AS (SELECT query_id, row_number() OVER
        (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s)
    SELECT * FROM r WHERE rank <= 10"""
)
def op5_topk(spark, folder):
    vectors = topk.integer_vectors(
        _table(spark, folder, "embeddings"), "vec_id", "embedding", 1024
    )
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0), 10)


URL_RULES = {"net/": True, "example.net/en/": False, "example.com/de/": True, "org/fr/": False}


@_query()
def op6_urls(spark, folder):
    return urls.filter_urls(_table(spark, folder, "pages"), URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict"
    )


@_query()
def op7_packing(spark, folder):
    return packing.pack_documents(
        _table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )


@_query(
    r"""WITH d AS (SELECT doc_id,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
      g AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50),
      n AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS k FROM g),
      m AS (SELECT k, min(doc_id) AS low FROM n GROUP BY k),
      s AS (SELECT doc_id, unnest(range(i, i + 50)) AS i FROM n JOIN m USING (k) WHERE low < doc_id),
      x AS (SELECT DISTINCT doc_id, i FROM s),
      p AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
      t AS (SELECT p.doc_id, string_agg(word, ' ' ORDER BY p.i) AS kept
        FROM p ANTI JOIN x ON p.doc_id = x.doc_id AND p.i = x.i GROUP BY p.doc_id),
      c AS (SELECT doc_id, count(*) AS n FROM x GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(c.n, 0)::BIGINT AS n_removed,
           sha256(coalesce(t.kept, '')) AS kept_sha256
    FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)"""
)
def op8_substrings(spark, folder):
    left = substrings.remove_repeated_passages(_table(spark, folder, "documents"))
    stays = F.when(F.col("n_removed") > 0, F.col("text")).otherwise(
        F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "))
    )
    return left.select(
        "doc_id", "n_words", "n_removed", F.sha2(stays, 256).alias("kept_sha256")
    )


@_query()
def op9_language(spark, folder):
    docs = _table(spark, folder, "documents")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1
    docs = docs.withColumn("held_out", F.coalesce(held, F.lit(False)))
    model = language.fit_languages(docs.where(~F.col("held_out")))
    return language.predict_language(docs, model, keep=("doc_id", "held_out"))


@_query()
def op10_lines(spark, folder):
    kept = lines.drop_recurring_lines(_table(spark, folder, "documents"))
    return kept.select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


@_query(
    r"""WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id) AS h,
        regexp_extract_all(coalesce(text, ''),
          '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units FROM documents),
      d AS (SELECT *, len(units)::BIGINT AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(units) + 1) AS a,
        ('0x' || substr(h, 9, 8))::BIGINT % (len(units) + 1) AS b,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
               OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 50 THEN 'plain'
             WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM t),
      c AS (SELECT doc_id, text, n, form, array_to_string(units[1:least(a, b)], '') AS x,
        array_to_string(units[least(a, b) + 1:greatest(a, b)], '') AS y,
        array_to_string(units[greatest(a, b) + 1:], '') AS z FROM d)
    SELECT doc_id, n, form,
           CASE WHEN form <> 'plain' THEN length(x)::BIGINT END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(y)::BIGINT END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text
             WHEN 'psm' THEN '<P>' || x || '<S>' || z || '<M>' || y
             ELSE '<S>' || z || '<P>' || x || '<M>' || y END) AS output_sha256,
           sha256(text) AS restored_sha256 FROM c"""
)
def op11_infill(spark, folder):
    made = infill.fill_in_middle(_table(spark, folder, "documents"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infill.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


@_query(
    r"""WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang,
        coalesce(source, '') AS source,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
        FROM documents),
      t AS (SELECT r, lang, source,
        unnest(regexp_extract_all(body, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
      c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs FROM t GROUP BY ALL),
      k AS (SELECT lang, term, sum(n) AS total FROM c GROUP BY ALL HAVING sum(docs) >= 3),
      l AS (SELECT lang, count(*) AS v, sum(total) AS size FROM k GROUP BY lang),
      g AS (SELECT lang, source, coalesce(max(l.v), 0) AS v, coalesce(sum(c.n), 0) AS size
        FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN l USING (lang)
          LEFT JOIN (SELECT c.* FROM c JOIN k USING (lang, term)) c USING (lang, source) GROUP BY ALL),
      m AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
          1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1)::HUGEINT // (g.size + g.v)::HUGEINT AS p,
          1 + 1000000000::HUGEINT * (k.total + 1)::HUGEINT // (l.size + l.v)::HUGEINT AS q
        FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN c USING (lang, source, term)),
      s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
        FROM m a JOIN m b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL),
      f AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
          FROM g a JOIN g b USING (lang) LEFT JOIN s
            ON s.lang = a.lang AND s.source = a.source AND s.item = b.source WHERE a.source <> b.source
        UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM m WHERE n > 0 AND p > q),
      o AS (SELECT lang, source, part, item, value::BIGINT AS value,
        (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank FROM f)
    SELECT * FROM o WHERE part = 'pair' OR rank <= 200"""
)
def op12_audit(spark, folder):
    return audit.divergence_audit(_table(spark, folder, "documents"))


@_query()
def op13_quality(spark, folder):
    return quality.quality_rules(
        _table(spark, folder, "documents"), _table(spark, folder, "labels")
    )
