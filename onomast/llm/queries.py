"""The registered queries of this subpackage: each applies one operator to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from onomast.llm import bpe, decontaminate, langid, merkle, packing, periodic, recompress, secrets, simhash, suffix, topk, url_filter, warc
from onomast.llm.common import ascii_lower, table

URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), url_filter.rules_frame(spark, URL_RULES))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompress.remove_repeats(table(spark, sf_dir, "documents"), with_text=False).drop("kept")


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.fit(docs))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(table(spark, sf_dir, "documents"), with_text=False).drop("kept")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_documents(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.round_trip(table(spark, sf_dir, "pages"))
    return back.select(F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 100 = 0"), k=10)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def with_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text, where a tail of each tenth document (by checksum of its id) repeats its first words again and again."""
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("w")).withColumn("n", F.size("w")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rest = F.col("n") - F.col("a")
    period = (F.lit(1) + F.floor(rest / (3 + F.col("g") % 8))).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("w", (F.col("a") + 1).cast("int"), period), F.ceil(rest / period).cast("int"))), F.lit(1), rest.cast("int"))
    planted = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a").cast("int")), tail), " ")
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(with_periods(table(spark, sf_dir, "documents")))
    longest = F.element_at(F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("shortness"), r["start"].alias("start"), r["period"].alias("period")))), 1)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = found.withColumn("top", F.when(F.size("runs") > 0, longest))
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("top.start").alias("start"), (-F.col("top.shortness")).alias("length"), F.col("top.period").alias("period"), F.floor(-1000 * F.col("top.shortness") / F.col("top.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    tampered = F.when(changed, merkle.leaf(*fields, ascii_lower(F.col("text"))))
    found = merkle.manifest(docs, "doc_id", "source", merkle.leaf(*fields, F.col("text")), tampered)
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    back = bpe.decoded(bpe.encoded(table(spark, sf_dir, "documents"), path), path)
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_langid": op3_langid,
    "op4_decontaminate": op4_decontaminate,
    "op5_simhash": op5_simhash,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_secrets": op7_secrets,
    "op8_warc": op8_warc,
    "op9_topk": op9_topk,
    "op10_packing": op10_packing,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_merkle": op12_merkle,
    "op13_bpe": op13_bpe,
}

#: Digits of base 32, a fixed value (RFC 4648).
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

ORACLE_SQL: dict[str, str] = {
    "op12_merkle": r"""
        WITH RECURSIVE sums AS (
            SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                lambda crc, b: list_reduce(list_concat([xor(crc, b)], list_transform(range(8), lambda z: 0::BIGINT)), lambda a, z: xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295) AS crc FROM documents
        ), head AS (
            SELECT *, list_reduce(list_transform([doc_id::VARCHAR, source, lang, n_chars::VARCHAR], lambda v: coalesce(strlen(v) || ':' || v, '-')), lambda x, y: x || y) AS front,
                CASE WHEN crc % 5 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS other FROM sums
        ), leaves AS (
            SELECT doc_id, source, sha256(front || coalesce(strlen(text) || ':' || text, '-')) AS leaf, sha256(front || coalesce(strlen(other) || ':' || other, '-')) AS changed FROM head
        ), ordered AS (
            SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves
        ), tree(source, k, i, d, n) AS (
            SELECT source, 0, i, leaf, count(*) OVER (PARTITION BY source) FROM ordered
            UNION ALL SELECT source, k + 1, i // 16, sha256(string_agg(d, '' ORDER BY i)), any_value((n + 15) // 16) FROM tree WHERE n > 1 GROUP BY source, k, i // 16
        ), runs AS (
            SELECT source, k, i // 16 AS j, string_agg(d, '' ORDER BY i) AS run FROM tree WHERE n > 1 GROUP BY ALL
        ), roots AS (
            SELECT source, d, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i FROM tree WHERE n = 1
        ), top(k, i, d, n) AS (
            SELECT 0, i, d, count(*) OVER () FROM roots
            UNION ALL SELECT k + 1, i // 16, sha256(string_agg(d, '' ORDER BY i)), any_value((n + 15) // 16) FROM top WHERE n > 1 GROUP BY k, i // 16
        ), topruns AS (
            SELECT k, i // 16 AS j, string_agg(d, '' ORDER BY i) AS run FROM top WHERE n > 1 GROUP BY ALL
        ), steps AS (
            SELECT o.source, o.i, k, run, 64 * (o.i // (1::BIGINT << (4 * k))) % 1024 AS off FROM ordered o JOIN runs r ON r.source IS NOT DISTINCT FROM o.source AND r.j = o.i // (1::BIGINT << (4 * k + 4))
            UNION ALL SELECT o.source, o.i, 1000 + k, run, 64 * (r.i // (1::BIGINT << (4 * k))) % 1024 FROM ordered o JOIN roots r ON r.source IS NOT DISTINCT FROM o.source JOIN topruns t ON t.j = r.i // (1::BIGINT << (4 * k + 4))
        ), paths AS (
            SELECT source, i, list(substr(run, 1, off) || '|' || substr(run, off + 65) ORDER BY k) AS p FROM steps GROUP BY ALL
        ), folded AS (
            SELECT doc_id, leaf, r.d AS subroot, (SELECT d FROM top WHERE n = 1) AS root, sha256(replace(array_to_string(coalesce(p, []), ''), '|', '')) AS proof_sha256,
                list_reduce(list_concat([changed], coalesce(p, [])), lambda x, s: sha256(split_part(s, '|', 1) || x || split_part(s, '|', 2))) AS folded_root
            FROM ordered o JOIN roots r ON r.source IS NOT DISTINCT FROM o.source LEFT JOIN paths q ON q.source IS NOT DISTINCT FROM o.source AND q.i = o.i
        )
        SELECT *, folded_root = root AS verified FROM folded
    """,
    "op2_substring_dedup": r"""
        WITH split AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        windows AS (SELECT doc_id, s, sha256(array_to_string(w[s:s + 19], ' ')) AS key FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM split) u),
        firsts AS (SELECT key, min((doc_id, s)) AS first FROM windows GROUP BY key HAVING count(*) > 1),
        gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM windows JOIN firsts USING (key) WHERE (doc_id, s) <> first),
        marked AS (SELECT doc_id, list(i) AS g FROM gone GROUP BY doc_id),
        kept AS (SELECT doc_id, len(w) AS n, coalesce(len(g), 0) AS k, CASE WHEN g IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(g, i)) END AS rest FROM split LEFT JOIN marked USING (doc_id))
        SELECT doc_id, n::BIGINT AS n_words, k::BIGINT AS n_removed, sha256(array_to_string(rest, ' ')) AS kept_sha256 FROM kept
    """,
    "op8_warc": f"""
        WITH each AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages),
        coded AS (SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, array_to_string([substr('{_BASE32}', ((('0x' || substr(h, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT + 1, 1) for i in range(0, 32)], '') AS payload_digest FROM each),
        kept AS (SELECT payload_digest, max(page_id) AS keeper FROM coded GROUP BY ALL)
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> keeper THEN keeper END AS refers_to FROM coded JOIN kept USING (payload_digest)
    """,
    "op9_topk": """
        WITH v AS (
            SELECT vec_id, [floor(1024 * x::DOUBLE) for x in embedding] AS e FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0
        ), ranked AS (
            SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
    "op1_url_filter": r"""
        WITH rest AS (
            SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages
        ), parts AS (
            SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest
        ), ruled AS (
            SELECT page_id, host, path, CASE
                WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
                WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
                WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
                WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/'
            END AS rule FROM parts
        )
        SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.com/de/', 'net/') THEN 'block' ELSE 'allow' END AS verdict FROM ruled
    """,
}
