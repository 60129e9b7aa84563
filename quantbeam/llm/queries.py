"""The checked queries of this subpackage: ``queries()`` and ``oracle_sql()``.

Each query applies its operator to the whole of ``documents`` and derives the
digest columns from what the operator returns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantbeam.llm import (bpe_codec, decontamination, hard_negatives, language, license_scan, near_duplicates, packing,
                           periodic_runs, quality_rules, sharding, token_counts, token_files, toxicity)
from quantbeam.llm.base import LOWER, NOT_WORD, UPPER, fold
from quantbeam.session import scratch_path
from quantbeam.sources.tables import read_table


def tokenizer() -> str:
    """The tokenizer file of the queries; operators take any such file."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(read_table(spark, sf_dir, "documents"), path, tokenizer())
    return token_files.read_token_files(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    rest = fold(F.col("doc_id"), 5)
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"), keep=rest != 0)
    return toxicity.score(docs, model).select(
        "doc_id", (rest == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "class_id", "text_class")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read_table(spark, sf_dir, "documents"), 24)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read_table(spark, sf_dir, "documents"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    rest = fold(F.col("doc_id"), 3)
    model = language.train(docs, keep=rest != 1)
    return language.predict(docs, model).select("doc_id", (rest == 1).alias("held_out"), "lang_pred", "score")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"),
                                          slop=2)
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256",
                        decontamination.contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"), "n_near")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         "kept", "rule")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), tokenizer()).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), tokenizer()).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


def looped(docs: DataFrame) -> DataFrame:
    """``documents`` of which a tenth, by id, repeat words from some place on."""
    h = F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "utf-8"))
    words = F.array_remove(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), "")
    docs = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("w"))
    n, g = F.size("w").cast("long"), F.col("g")
    docs = docs.withColumn("a", F.when(n > 0, g % n)).withColumn(
        "p", F.when(n > 0, F.expr("1 + (size(w) - a) div (3 + g % 8)")))
    again = F.expr("transform(w, (x, i) -> IF(i < a, x, w[CAST(a + (i - a) % p AS INT)]))")
    return docs.select("doc_id", F.when(F.col("a").isNull(), F.col("text")).otherwise(
        F.array_join(again, " ")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.collapse_runs(looped(read_table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "")
    top = F.col("top")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), top["start"].alias("start"), top["length"].alias("length"),
        top["period"].alias("period"), F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.expr("IF(vec_id % 7 = 0, (label + 1) % 10, label)")
    return hard_negatives.mine(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, moved)


def op13_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    path = public_tokenizers.path("word_bpe_49k.json")
    coded = bpe_codec.decode(bpe_codec.encode(read_table(spark, sf_dir, "documents"), path), path)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_token_files, op2_toxicity, op3_near_duplicates, op4_sharding, op5_license_scan, op6_language,
        op7_decontamination, op8_quality_rules, op9_packing, op10_token_counts, op11_periodic_runs, op12_hard_negatives,
        op13_bpe_codec)}


WORDS_SQL = "regexp_extract_all(translate(coalesce({}, ''), '" + UPPER + "', '" + LOWER + "'), '[^" + NOT_WORD[1:-2] + "]+')"


def _listed(items) -> str:
    return "[" + ", ".join(f"'{x}'" for x in items) + "]"


def op4_sql(shards: int = 24) -> str:
    def best(n: int) -> str:
        u = "(('0x' || md5(coalesce(doc_id::VARCHAR, '') || ':' || s)[1:13])::BIGINT + 0.5) / 4503599627370496.0"
        return (f"list_transform(list_sort(list_transform(range({n}), lambda s: {{'score': 1.0 / -ln({u}), 'shard': s}}), "
                "'DESC'), lambda x: x.shard)[1]")
    return f"""
        WITH crc AS (
          SELECT list(c ORDER BY n) AS steps FROM (
            SELECT n, list_reduce(list_prepend(n, range(8)),
                     lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
            FROM range(256) AS t(n))),
        d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        f AS (
          SELECT doc_id, (strlen(text) + 8)::BIGINT AS size,
                 xor(list_reduce(list_prepend(4294967295::BIGINT,
                       list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: ('0x' || x)::BIGINT)),
                     lambda c, b: xor(c // 256, steps[xor(c, b) % 256 + 1])), 4294967295) AS text_crc32,
                 {best(shards)}::INT AS shard, {best(shards + 1)}::INT AS grown_shard
          FROM d, crc)
        SELECT doc_id, size, text_crc32, 'key' AS law, shard,
               row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, grown_shard
        FROM f"""


def op5_sql(threshold: float = 0.8) -> str:
    templates = []
    for label, text in license_scan.TEMPLATES:
        w = license_scan.template_words(text)
        templates.append(f"('{label}', {len(w)}, {_listed(sorted(set(w)))})")
    places = " || ".join(
        "list_filter(range(len(w)), lambda i: " + " AND ".join(f"w[i + {k + 1}] = '{p}'" for k, p in enumerate(phrase.split()))
        + ")" for phrase in license_scan.PHRASES)
    labels = " || ".join(f"CASE WHEN contains(t, ' {phrase} ') THEN ['{label}'] ELSE []::VARCHAR[] END"
                         for phrase, label in license_scan.PHRASES.items())
    return f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS_SQL.format('text')} AS w FROM documents),
        b AS (SELECT r, label, len(held) AS n, list_max(list_transform(range(1, len(w) + 1),
                     lambda s: len(list_intersect(list_distinct(w[s:s + l - 1]), held)))) AS best
              FROM d, (VALUES {', '.join(templates)}) AS t(label, l, held) WHERE len(list_intersect(w, held)) > 0),
        m AS (SELECT r, label, best / n AS c FROM b WHERE best >= ceil(n * {threshold} - 1e-9)),
        g AS (SELECT r, list_distinct(list(label)) AS more, max(c) AS best FROM m GROUP BY r),
        p AS (SELECT r, doc_id, len(w) AS n_words, {places} AS places, {labels} AS base
              FROM (SELECT *, ' ' || array_to_string(w, ' ') || ' ' AS t FROM d))
        SELECT doc_id, n_words::BIGINT AS n_words, len(places)::BIGINT AS n_base,
               list_min(places)::BIGINT AS first_word, list_max(places)::BIGINT AS last_word,
               array_to_string(list_sort(list_distinct(base)), ',') AS base_labels,
               array_to_string(list_sort(list_distinct(base || coalesce(more, []::VARCHAR[]))), ',') AS labels,
               CASE WHEN len(places) > 0 THEN 1.0 ELSE coalesce(best, 0.0) END::DOUBLE AS score
        FROM p LEFT JOIN g USING (r)"""


def op7_sql(window: int = 13, slop: int = 2, near_share: float = 0.8) -> str:
    return f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS_SQL.format('text')} AS w FROM documents),
        b AS (SELECT DISTINCT coalesce(item_id::VARCHAR, '') AS item_id, {WORDS_SQL.format('text')} AS w FROM benchmark),
        bw AS (SELECT DISTINCT item_id, least({window}, len(w)) AS n, array_to_string(w[i:i + {window} - 1], ' ') AS k
               FROM (SELECT *, unnest(range(1, greatest(len(w) - {window}, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
        dw AS (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS k
               FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
                     FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
        m AS (SELECT DISTINCT r, i, n, item_id FROM dw JOIN bw USING (n, k)),
        h AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM m) GROUP BY r),
        t AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
              FROM (SELECT DISTINCT r, item_id FROM m) GROUP BY r),
        c AS MATERIALIZED (SELECT r, unnest(w) AS term, unnest(range(len(w))) AS i FROM d),
        f AS (SELECT term, count(*) AS n FROM c GROUP BY term),
        x AS (SELECT item_id, split(k, ' ') AS held, n FROM bw),
        y AS (SELECT item_id, held, n, term, min(place) AS place
              FROM (SELECT *, unnest(held) AS term, unnest(range(n)) AS place FROM x) GROUP BY ALL),
        a AS MATERIALIZED (
              SELECT y.item_id, held, y.n, term, place, row_number() OVER (
                PARTITION BY y.item_id, held ORDER BY coalesce(f.n, 0), term) AS rank
              FROM y LEFT JOIN f USING (term) QUALIFY rank <= 2),
        e AS (SELECT c.r, p.item_id, p.held, p.n, c.i - p.place AS start, c.i AS at, q.term AS other, q.place AS other_place
              FROM a p JOIN c ON c.term = p.term LEFT JOIN a q ON q.item_id = p.item_id AND q.held = p.held AND q.rank = 2
              WHERE p.rank = 1),
        g AS (SELECT DISTINCT e.r, e.item_id, e.held, e.n, e.start FROM e LEFT JOIN c ON c.r = e.r AND c.term = e.other
              WHERE e.other IS NULL OR abs(c.i - e.start - e.other_place) <= {slop}),
        z AS (SELECT r, count(DISTINCT item_id) AS n_near FROM (
                SELECT g.*, list_distinct(held) AS words,
                       w[greatest(start - {slop}, 0) + 1:greatest(start + g.n + {slop}, 0)] AS around FROM g JOIN d USING (r))
              WHERE len(list_intersect(words, around)) >= {near_share} * len(words) GROUP BY r)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
               coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated,
               coalesce(n_near, 0)::BIGINT AS n_near
        FROM d LEFT JOIN h USING (r) LEFT JOIN t USING (r) LEFT JOIN z USING (r)"""


def op11_sql() -> str:
    """Runs as stretches of equal 4-grams: pairs of places of one 4-gram in a
    text, by their distance."""
    crc = ("xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(coalesce("
           "doc_id::VARCHAR, ''))), '..'), lambda x: ('0x' || x)::BIGINT)), "
           "lambda c, b: xor(c // 256, steps[xor(c, b) % 256 + 1])), 4294967295)")
    return f"""
        WITH crc AS (
          SELECT list(c ORDER BY n) AS steps FROM (
            SELECT n, list_reduce(list_prepend(n, range(8)),
                     lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
            FROM range(256) AS t(n))),
        s AS (SELECT row_number() OVER () AS r, doc_id, {crc} AS h,
                     regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents, crc),
        t AS (SELECT *, len(w) AS n, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM s),
        u AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM t),
        d AS MATERIALIZED (
              SELECT r, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN
                       list_transform(range(n), lambda i: w[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1])
                       ELSE w END AS w FROM u),
        f AS (SELECT r, n, i, w[i + 1:i + 4] AS gram FROM (SELECT *, unnest(range(n - 3)) AS i FROM d WHERE n >= 6)),
        e AS (SELECT x.r, y.i - x.i AS q, x.i
              FROM f x JOIN f y ON x.r = y.r AND x.gram = y.gram AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
        g AS (SELECT r, q, min(i) AS start, count(*) + 3 + q AS length
              FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM e)
              GROUP BY r, q, island),
        k AS MATERIALIZED (SELECT r, start, length, min(q) AS period FROM g WHERE length >= 6 AND length >= 4 * q
              GROUP BY r, start, length),
        l AS (SELECT r, count(*) AS n_runs,
                     string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs
              FROM k GROUP BY r),
        m AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY r
                ORDER BY length::DOUBLE / period DESC, start, period) = 1),
        x AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM k),
        c AS (SELECT v.r, string_agg(v.word, ' ' ORDER BY v.i) AS kept
              FROM (SELECT r, unnest(w) AS word, unnest(range(n)) AS i FROM d) v ANTI JOIN x ON v.r = x.r AND v.i = x.i
              GROUP BY v.r)
        SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length,
               period::BIGINT AS period, (1000 * length // period)::BIGINT AS exponent_milli,
               sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
        FROM d LEFT JOIN l USING (r) LEFT JOIN m USING (r) LEFT JOIN c USING (r)"""


def op12_sql() -> str:
    return """
        WITH e AS MATERIALIZED (
          SELECT row_number() OVER () AS r, vec_id,
                 CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                 list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
          FROM embeddings
          WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS MATERIALIZED (
          SELECT a.r, a.vec_id AS anchor_id, a.label = b.label AS same, a.r = b.r AS itself, b.vec_id,
                 coalesce(list_sum(list_transform(range(1, least(len(a.v), len(b.v)) + 1),
                                                  lambda i: a.v[i] * b.v[i])), 0)::BIGINT AS score
          FROM e a, e b WHERE a.vec_id % 50 = 0),
        p AS (SELECT r, anchor_id, vec_id, score, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS slot
              FROM s WHERE same AND NOT itself QUALIFY slot <= 5)
        SELECT p.anchor_id, p.vec_id AS positive_id,
               row_number() OVER (PARTITION BY p.r, slot ORDER BY s.score DESC, s.vec_id)::INT AS rank,
               s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
        FROM p JOIN s ON p.r = s.r AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
        QUALIFY rank <= 3"""


def oracle_sql() -> dict[str, str]:
    return {"op4_sharding": op4_sql(), "op5_license_scan": op5_sql(), "op7_decontamination": op7_sql(),
            "op11_periodic_runs": op11_sql(), "op12_hard_negatives": op12_sql()}
