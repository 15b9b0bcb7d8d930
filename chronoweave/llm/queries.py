"""The queries over the corpus tables, one for each operator, and their SQL where SQL can say it."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.llm import (
    bpe,
    decontamination,
    html_text,
    language_id,
    pii,
    secret_scan,
    simhash,
    spelling,
    substring_dedup,
    toxicity,
    vector_dedup,
    warc,
    whitening,
)
from chronoweave.llm.common import added, shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def fields(df: DataFrame, *names: str) -> list:
    return [added(df, n).alias(n) for n in names]


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_benchmark(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    n_hit = F.aggregate(added(found, "spans"), F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    items = F.transform(added(found, "matches"), lambda m: m["item_id"])
    return found.select(
        "doc_id",
        added(found, "n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(documents(spark, sf_dir), keep=["doc_id"], with_text=False)
    return found.select("doc_id", *fields(found, "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"))


def op3_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = language_id.remainder(docs.doc_id, 5) == 0
    found = language_id.predict(docs.select("doc_id", "text"), language_id.fit(docs, ~held_out), keep=["doc_id"])
    return found.select(
        "doc_id",
        (language_id.remainder(found.doc_id, 5) == 0).alias("held_out"),
        added(found, "lang").alias("lang_pred"),
        *fields(found, "score", "rejected"),
    )


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe.encode_documents(
        documents(spark, sf_dir),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        keep=["doc_id"],
        with_ids=False,
    )
    return found.select("doc_id", *fields(found, "n_tokens", "ids_sha256", "decoded_sha256"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract(table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), language_id.remainder(docs.doc_id, 3) != 1)
    found = toxicity.score(docs, model, ["doc_id"])
    return found.select(
        "doc_id",
        (language_id.remainder(found.doc_id, 3) == 1).alias("held_out"),
        F.col("found.score").alias("score"),
        (F.col("found.score") >= toxicity.TOXIC).cast("int").alias("predicted"),
    )


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(documents(spark, sf_dir), with_text=False)
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    found = warc.pages_again(warc.read_records(spark, folder, with_payload=False))

    def page(column: str):
        return F.regexp_extract(column, "^<urn:page:(-?[0-9]*):", 1).try_cast("long")

    return found.select(
        page("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        page("refers_to").alias("refers_to"),
    )


def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = secret_scan.fit(secret_scan.labelled_strings(docs))
    found = secret_scan.find_secrets(docs, model, keep=["doc_id"], with_text=False)
    return found.select("doc_id", *fields(found, "n_assign", "n_access", "n_hex", "base_sha256", "spans"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(spelling.run_counts(documents(spark, sf_dir)))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    model = whitening.fit(vectors)
    error, explained, n = None, [], 0
    if model:
        error, n = whitening.identity_error(vectors, model), model.n
        explained = [float(e) / model.trace if model.trace > 0 else None for e in model.values[: whitening.COMPONENTS]]
        found = whitening.whiten(vectors, model, keep=["vec_id"])
    else:
        found = vectors.select("vec_id", F.lit(None).cast("struct<whitened:array<double>,deviation:bigint>").alias("found")).limit(0)
    shares = F.array(*[F.lit(e).cast("double") for e in explained]).cast("array<double>")
    each = found.where(added(found, "whitened").isNotNull()).select(
        "vec_id", added(found, "deviation").alias("deviation"), F.posexplode(added(found, "whitened")).alias("place", "whitened")
    )
    return each.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, "place").alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_decontamination, op2_personal_data, op3_vector_dedup, op4_language, op5_byte_bpe, op6_html_text, op7_toxicity,
        op8_substring_dedup, op9_simhash, op10_warc, op11_secrets, op12_spelling, op13_whitening,
    )
}



def _crc_steps() -> list[int]:
    """The reversed CRC-32 of each half byte."""
    out = list(range(16))
    for _ in range(4):
        out = [c >> 1 ^ (0xEDB88320 if c & 1 else 0) for c in out]
    return out


ORACLE: dict[str, str] = {
    "op12_spelling": f"""
        WITH RECURSIVE r AS (
            SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS w
            FROM documents),
        g AS (SELECT w, count(*) AS n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || w)) AS x FROM r WHERE length(w) >= 7 GROUP BY doc_id, w),
        c AS (
            SELECT w, n, xor(4294967295, list_reduce(
                list_prepend(4294967295::BIGINT, list_transform(generate_series(0, length(x) - 1), lambda k:
                    (instr('0123456789ABCDEF', substr(x, CASE WHEN k % 2 = 0 THEN k + 2 ELSE k END, 1)) - 1)::BIGINT)),
                lambda h, b: xor(list_extract({_crc_steps()}, (xor(h, b) & 15) + 1), h >> 4))) AS h
            FROM g),
        v AS (SELECT CASE WHEN h % 31 = 0 THEN left(w, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM c),
        words AS (SELECT word, sum(n)::BIGINT AS n FROM v WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
        k AS (SELECT word, n, unnest(generate_series(0, length(word) - 1)) AS i FROM words),
        s AS (SELECT word, n, left(word, i) AS a, substr(word, i + 2) AS b FROM k),
        one AS (
            SELECT x.word, y.word AS near, y.n FROM s x JOIN s y ON x.a = y.a AND x.b = y.b AND x.word <> y.word
            UNION SELECT s.word, u.word, u.n FROM s JOIN words u ON u.word = a || b
            UNION SELECT u.word, s.word, s.n FROM s JOIN words u ON u.word = a || b),
        o AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY n DESC, near) AS place, count(*) OVER (PARTITION BY word) AS n_near FROM one),
        f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN o.n >= 10 * w.n THEN near END AS form, CASE WHEN o.n >= 10 * w.n THEN o.n END AS form_n
              FROM words w LEFT JOIN o ON o.word = w.word AND place = 1),
        l AS (SELECT word, word AS last FROM f UNION ALL SELECT l.word, f.form FROM l JOIN f ON l.last = f.word WHERE f.form IS NOT NULL)
        SELECT f.word, f.form, l.last AS root, f.n, f.n_near, f.form_n
        FROM f JOIN l ON f.word = l.word JOIN f AS e ON l.last = e.word WHERE e.form IS NULL
    """,
    "op8_substring_dedup": r"""
        WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda w: w <> '') AS ws FROM documents),
        g AS (SELECT doc_id, unnest(generate_series(1, len(ws) - 19)) AS s, ws FROM d WHERE len(ws) >= 20),
        x AS (SELECT doc_id, s, list_slice(ws, s, s + 19) AS w FROM g),
        r AS (SELECT doc_id, s, row_number() OVER (PARTITION BY w ORDER BY doc_id, s) AS n FROM x),
        c AS (SELECT DISTINCT doc_id, s + unnest(generate_series(0, 19)) AS i FROM r WHERE n > 1),
        l AS (SELECT doc_id, list(i) AS gone FROM c GROUP BY doc_id)
        SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
               sha256(array_to_string(list_filter(ws, lambda w, i: NOT coalesce(list_contains(gone, i), false)), ' ')) AS kept_sha256
        FROM d LEFT JOIN l USING (doc_id)
    """,
    "op3_vector_dedup": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
            WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        l AS (
            SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
            WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
        r AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
        c AS (SELECT x, min(y) AS component_id FROM r GROUP BY x),
        n AS (SELECT x, count(*) AS n_links FROM l GROUP BY x)
        SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
        FROM embeddings JOIN c ON c.x = vec_id LEFT JOIN n ON n.x = vec_id
    """,
    "op10_warc": """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body, sha1(encode(coalesce(html, ''))) AS h FROM pages),
        f AS (SELECT body, min(page_id) AS one FROM p GROUP BY body)
        SELECT page_id, octet_length(body)::BIGINT AS payload_bytes,
               array_to_string(list_transform(generate_series(0, 31), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   ((('0x' || substr(h, (i // 4 * 5 + 1)::BIGINT, 5))::BIGINT >> (15 - 5 * (i % 4))::BIGINT) & 31) + 1, 1)), '') AS payload_digest,
               CASE WHEN page_id = one THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> one THEN one END AS refers_to
        FROM p JOIN f USING (body)
    """,
}
