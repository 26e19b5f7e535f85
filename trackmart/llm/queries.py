"""The numbered queries over the driver's tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmart.llm import (bytebpe, exact, html, infill, langid, mixing, nbsvm, periods, pieces,
                           rules, simhash, suffix, tokens)
from trackmart.llm.common import WORD, documents
from trackmart.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

WORDS_SQL = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function
    return register


@query("op1_token_output")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, written as segments and read back."""
    path = scratch_path(spark, "tokens")
    tokens.write_tokens(documents(spark, sf_dir, "doc_id", "text"), path)
    return tokens.read_documents(tokens.read_segments(spark, path))


@query("op2_simhash_near_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir, "doc_id", "text"))


@query("op3_language_id")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict_languages(documents(spark, sf_dir, "doc_id", "text", "lang"))


@query("op4_exact_dedup", """
    WITH folded AS (
        SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz') AS t
        FROM documents)
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
           sha256(t) AS text_sha256
    FROM folded WINDOW same AS (PARTITION BY t)
""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(documents(spark, sf_dir, "doc_id", "text"))


@query("op5_html_extraction")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_texts(
        spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))


@query("op6_suffix_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(documents(spark, sf_dir, "doc_id", "text"))


@query("op7_quality_classifier")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return nbsvm.score_quality(documents(spark, sf_dir, "doc_id", "text"), labels)


@query("op8_source_mixing", f"""
    WITH sized AS (
        SELECT doc_id, source, len({WORDS_SQL}) AS size FROM documents),
    sums AS (
        SELECT source, count(*) AS docs, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
    turns AS (
        SELECT *, ([5.0, 2.0, 1.0])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)]
                  ::DOUBLE AS weight, source_size * 2.0::DOUBLE AS most
        FROM sums),
    levels AS (
        SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
                   - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST
                                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                  / sum(weight) OVER (ORDER BY most / weight, source NULLS LAST
                                      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
        FROM turns),
    targets AS (
        SELECT *, least(most, weight * (SELECT max(level) FROM levels
                                        WHERE most >= level * weight)) AS target
        FROM levels),
    dealt AS (
        SELECT s.*, t.source_size, t.target, t.docs,
               ('0x' || substr(md5(coalesce(s.doc_id::VARCHAR, '')), 1, 8))::BIGINT
               % ceil(t.docs / 4096)::BIGINT AS stretch
        FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY source ORDER BY stretch, size, doc_id) AS nth,
               CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS each,
               ('0x' || substr(md5('mix:' || coalesce(source, '')), 1, 5))::BIGINT / 1048576.0::DOUBLE
               AS shift
        FROM dealt)
    SELECT doc_id, size, source_size, target,
           ((floor(nth * each + shift) - floor((nth - 1) * each + shift)) * size)::BIGINT AS taken
    FROM placed
""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir, "doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query("op9_quality_rules")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return rules.judge(documents(spark, sf_dir, "doc_id", "text"), labels)


@query("op10_sentencepiece")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(documents(spark, sf_dir, "doc_id", "text"))


def with_repeated_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text) where a tenth of the texts, chosen by id, ends in repetitions.

    With h the crc32 of the id as text and g = h // 10: where h % 10 is 0 and the
    text has n > 0 words, word i >= a = g % n becomes word a + (i - a) % p, with
    p = 1 + (n - a) // (3 + g % 8), and the words are joined by a space.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = docs.select(
        "doc_id", "text", F.floor(h / 10).alias("g"),
        F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("words"))
    n = F.size("words")
    placed = chosen.withColumn("a", F.when(n > 0, (F.col("g") % F.greatest(n, F.lit(1)))
                                           .cast("int")))
    a, words = F.col("a"), F.col("words")
    placed = placed.withColumn("p", (1 + F.floor((n - a) / (3 + F.col("g") % 8))).cast("int"))
    tail = F.transform(F.sequence(a, n - 1),
                       lambda i: F.element_at(words, a + (i - a) % F.col("p") + 1))
    repeated = F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")
    return placed.select("doc_id", F.when(a.isNotNull(), repeated).otherwise(F.col("text"))
                         .alias("text"))


@query("op11_periodic_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of runs, the longest one, and digests of all runs and of the collapsed text."""
    found = periods.periodic_runs(with_repeated_tails(documents(spark, sf_dir, "doc_id", "text")))
    runs = F.col("runs")
    # The greatest length, then the smallest start and period.
    best = F.array_max(F.transform(runs, lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"),
        (-r["period"]).alias("period"))))
    lines = F.transform(runs, lambda r: F.concat(
        F.concat_ws(",", *(r[f].cast("string") for f in ("start", "length", "period"))),
        F.lit("\n")))
    rows = found.select("doc_id", F.size(runs).cast("long").alias("n_runs"), best.alias("best"),
                        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"))
    start, length, period = -F.col("best.start"), F.col("best.length"), -F.col("best.period")
    return rows.select(
        "doc_id", "n_runs", start.alias("start"), length.alias("length"), period.alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256")


@query("op12_fill_in_middle", r"""
    WITH cut AS (
        SELECT doc_id, coalesce(text, '') AS text,
               regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units,
               sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h
        FROM documents),
    drawn AS (
        SELECT *, len(units)::BIGINT AS n,
               ('0x' || substr(h, 1, 8))::BIGINT % (len(units) + 1) AS u1,
               ('0x' || substr(h, 9, 8))::BIGINT % (len(units) + 1) AS u2,
               CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>')
                         OR contains(text, '<M>') OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 100
                    THEN 'plain'
                    WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 50 THEN 'spm'
                    ELSE 'psm' END AS form
        FROM cut),
    parts AS (
        SELECT *, coalesce(array_to_string(units[1:least(u1, u2)], ''), '') AS p,
               coalesce(array_to_string(units[least(u1, u2) + 1:greatest(u1, u2)], ''), '') AS m,
               coalesce(array_to_string(units[greatest(u1, u2) + 1:], ''), '') AS s
        FROM drawn)
    SELECT doc_id, n, form,
           CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text
                  WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                  ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
           sha256(text) AS restored_sha256
    FROM parts
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Examples from stored frames, and digests of the outputs and of the texts rebuilt from them."""
    path = scratch_path(spark, "frames")
    infill.write_frames(documents(spark, sf_dir, "doc_id", "text"), path)
    found = infill.fill_in_middle(infill.read_frames(spark, path))
    back = infill.restored(F.col("output"), F.col("form"))
    return found.select("doc_id", F.col("units").alias("n"), "form", "prefix_chars",
                        "middle_chars", "output_sha256",
                        F.sha2(back, 256).alias("restored_sha256"))


@query("op13_byte_bpe")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of ids, and digests of the ids and of the bytes that they spell."""
    encoded = bytebpe.encode_documents(documents(spark, sf_dir, "doc_id", "text"))
    found = bytebpe.decode_documents(encoded)
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("data", 256).alias("decoded_sha256"))


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
