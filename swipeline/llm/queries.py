"""The named queries of the corpus operators over the driver's tables, and their SQL where there is any."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swipeline.llm.codes import codes
from swipeline.llm.common import table
from swipeline.llm.exact import exact_dedup, halves
from swipeline.llm.importance import resample
from swipeline.llm.language import fit, identify
from swipeline.llm.mixing import mix
from swipeline.llm.packing import pack
from swipeline.llm.passages import passage_digests
from swipeline.llm.personal import personal_spans, summary
from swipeline.llm.repeats import remove_repeats
from swipeline.llm.simhash import simhash_groups
from swipeline.llm.urls import filter_urls, host_of
from swipeline.llm.vectors import near_vectors
from swipeline.llm.wordpiece import token_counts


def tokenizer_path(name: str) -> str:
    """A public tokenizer's file, by the package that comes with them."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("source")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op4_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary(personal_spans(table(spark, sf_dir, "documents")))


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))


def op7_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures by page, against two lists made from the hosts themselves.

    The table has no fetch times, so a page's day follows from its id. Every host, and what is left
    of it without its first label, is an entry of list 'adult' or 'spam' by its length, added and
    removed again on days that follow from its letters.
    """
    pages = table(spark, sf_dir, "pages").select(
        "page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 365).cast("int")).alias("fetched")
    )
    hosts = pages.select(host_of(F.col("url")).alias("host")).where("host is not null").distinct()
    names = hosts.select("host", F.explode(F.array("host", F.regexp_replace("host", r"^[^.]*\.", ""))).alias("domain"))
    names = names.where(r"domain rlike '[.].*[.]'").select("domain").distinct()
    list_name = F.when(F.length("domain") % 2 == 0, "adult").otherwise("spam").alias("list_name")
    start = (F.ascii("domain") * 31 + F.length("domain") * 17) % 200
    day = lambda n: F.date_add(F.lit("2024-01-01").cast("date"), n)
    dated = F.array(
        F.struct(day(start).alias("day"), F.lit("add").alias("action")),
        F.struct(day(start + 60).alias("day"), F.lit("remove").alias("action")),
        F.struct(day(start + 120).alias("day"), F.lit("add").alias("action")),
    )
    changes = names.select(list_name, "domain", F.explode(dated).alias("c")).select("list_name", "domain", "c.day", "c.action")
    return filter_urls(pages, changes)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The earlier half of the ids is the history, the rest comes in against it."""
    history, incoming = halves(table(spark, sf_dir, "documents"))
    return exact_dedup(incoming, history)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit(docs))


def op11_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passage_digests(table(spark, sf_dir, "documents"))


def op12_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_packing,
        op2_mixing,
        op3_token_counts,
        op4_near_vectors,
        op5_personal_data,
        op6_simhash_dedup,
        op7_repeated_strings,
        op8_url_filters,
        op9_exact_dedup,
        op10_language_id,
        op11_repeated_passages,
        op12_target_resampling,
        op13_vector_codes,
    )
}

def _codes_sql() -> str:
    """Two Lloyd rounds in integers. ``b0`` to ``b2`` are the codebooks, ``n0`` to ``n2`` the nearest entries."""
    nearest = """, n{k} AS MATERIALIZED (
          SELECT vec_id, part, x, min_by(entry, (d, entry)) AS entry, min(d) AS d FROM (
            SELECT vec_id, part, x, entry, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
            FROM parts JOIN b{k} USING (part)
          ) GROUP BY vec_id, part, x
        )"""
    update = """, m{k} AS (
          SELECT part, entry, list(m ORDER BY j) AS c FROM (
            SELECT part, entry, j, CAST(sum(x[j]) // count(*) - (sum(x[j]) % count(*) < 0)::INT AS BIGINT) AS m
            FROM n{k}, (SELECT unnest(range(1, {deep} + 1)) AS j) GROUP BY part, entry, j
          ) GROUP BY part, entry
        ), b{n} AS MATERIALIZED (
          SELECT part, entry, coalesce(m{k}.c, b{k}.c) AS c FROM b{k} LEFT JOIN m{k} USING (part, entry)
        )"""
    steps = nearest.format(k=0) + "".join(update.format(k=k, n=k + 1, deep=4) + nearest.format(k=k + 1) for k in (0, 1))
    return (
        """
        WITH kept AS (
          SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * x::DOUBLE) AS BIGINT)) AS v FROM embeddings
          WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), parts AS MATERIALIZED (
          SELECT vec_id, part, list_slice(v, 4 * part + 1, 4 * part + 4) AS x FROM kept, (SELECT unnest(range(16)) AS part)
        ), b0 AS MATERIALIZED (
          SELECT part, e - 1 AS entry, x AS c
          FROM parts JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS e FROM kept) USING (vec_id) WHERE e <= 64
        )"""
        + steps
        + """, coded AS (
          SELECT vec_id, string_agg(lower(lpad(to_hex(entry), 2, '0')), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
          FROM n2 GROUP BY vec_id
        )
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
               (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM b2) AS codebooks_sha256
        FROM coded JOIN kept USING (vec_id)
    """
    )


ORACLES = {
    "op9_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op8_url_filters": r"""
        WITH authorities AS (
          SELECT page_id, DATE '2024-01-01' + CAST(page_id % 365 AS INTEGER) AS fetched,
                 lower(regexp_extract(regexp_replace(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*:', ''), '^//([^/?#\\]*)', 1)) AS a
          FROM pages
        ), captures AS (
          SELECT page_id, fetched, nullif(regexp_replace(regexp_replace(
                   regexp_replace(regexp_replace(a, '^.*@', ''), ':[0-9]*$', ''), '^www\.', ''), '\.+$', ''), '') AS host
          FROM authorities
        ), hosts AS (
          SELECT DISTINCT host, string_split(host, '.') AS labels FROM captures WHERE host IS NOT NULL
        ), names AS (
          SELECT host AS domain FROM hosts UNION SELECT regexp_replace(host, '^[^.]*\.', '') FROM hosts
        ), starts AS (
          SELECT domain, CASE WHEN length(domain) % 2 = 0 THEN 'adult' ELSE 'spam' END AS list_name,
                 DATE '2024-01-01' + CAST((ascii(domain) * 31 + length(domain) * 17) % 200 AS INTEGER) AS d
          FROM names WHERE regexp_matches(domain, '[.].*[.]')
        ), entries AS (
          SELECT domain, list_name, d AS valid_from, d + 60 AS valid_to FROM starts
          UNION ALL SELECT domain, list_name, d + 120, DATE '9999-12-31' FROM starts
        ), levels AS (
          SELECT host, array_to_string(list_slice(labels, i, len(labels)), '.') AS domain
          FROM (SELECT host, labels, unnest(range(1, greatest(len(labels) - 1, 1) + 1)) AS i FROM hosts)
        ), active AS (
          SELECT c.host, c.fetched, string_agg(DISTINCT list_name, ',' ORDER BY list_name) AS lists,
                 max_by(e.domain, length(e.domain)) AS entry
          FROM (SELECT DISTINCT host, fetched FROM captures) c JOIN levels l ON l.host = c.host
          JOIN entries e ON e.domain = l.domain AND c.fetched >= valid_from AND c.fetched < valid_to
          GROUP BY 1, 2
        )
        SELECT page_id, c.host, c.fetched, lists IS NOT NULL AS blocked, lists, entry
        FROM captures c LEFT JOIN active a ON a.host = c.host AND a.fetched = c.fetched
    """,
    "op11_repeated_passages": r"""
        WITH docs AS MATERIALIZED (
          SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
        ), starts AS (
          SELECT r, words, unnest(range(1, len(words) - 33)) AS i FROM docs WHERE len(words) >= 35
        ), windows AS MATERIALIZED (
          SELECT r, i, sha256(array_to_string(list_slice(words, i, i + 34), ' ')) AS w FROM starts
        ), again AS (
          SELECT w FROM windows GROUP BY w HAVING count(*) > 1
        ), gone AS (
          SELECT DISTINCT r, i + j AS p FROM windows SEMI JOIN again USING (w), (SELECT unnest(range(35)) AS j)
        ), placed AS (
          SELECT r, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM docs
        ), left_over AS (
          SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS kept FROM placed ANTI JOIN gone USING (r, p) GROUP BY r
        )
        SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM docs LEFT JOIN left_over USING (r)
    """,
    "op12_target_resampling": r"""
        WITH table256 AS MATERIALIZED (
          SELECT list(list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
                   lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t
          FROM (SELECT unnest(range(256)) AS b)
        ), texts AS (
          SELECT 'd' AS side, row_number() OVER () AS r, doc_id, text FROM documents
          UNION ALL SELECT 'b', row_number() OVER (), NULL, text FROM benchmark
        ), worded AS MATERIALIZED (
          SELECT side, r, doc_id,
                 regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
          FROM texts
        ), features AS MATERIALIZED (
          SELECT side, r, array_to_string(list_slice(words, i, i + n - 1), ' ') AS f FROM (
            SELECT side, r, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM worded, (SELECT unnest([1, 2, 3]) AS n)
          )
        ), hexed AS (
          SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM features)
        ), bytes AS (
          SELECT f, list_prepend(4294967295, list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)) AS b
          FROM hexed
        ), bucketed AS MATERIALIZED (
          SELECT f, xor(list_reduce(b, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket
          FROM bytes, table256
        ), counts AS (
          SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t
          FROM features JOIN bucketed USING (f) GROUP BY bucket
        ), sums AS (
          SELECT sum(s)::DOUBLE AS s_all, sum(t)::DOUBLE AS t_all FROM counts
        ), gains AS (
          SELECT bucket, floor(1000 * ln((t + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000))))::BIGINT AS gain FROM counts, sums
        ), weights AS (
          SELECT r, count(*) AS n_features, sum(gain)::BIGINT AS weight
          FROM features JOIN bucketed USING (f) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY r
        ), scored AS (
          SELECT r, doc_id, len(words) >= 20 AS able, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
                 coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || left(sha256('42:' || doc_id), 8))::BIGINT + 0.5::DOUBLE)
                                                             / 4294967296::DOUBLE)))::BIGINT AS score
          FROM worded LEFT JOIN weights USING (r) WHERE side = 'd'
        ), ranked AS (
          SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id) AS place, count(*) FILTER (able) OVER () AS n FROM scored
        )
        SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= 5 * n // 100 THEN place END AS rank FROM ranked
    """,
    "op13_vector_codes": _codes_sql(),
}
