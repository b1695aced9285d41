"""The operators applied to the driver tables, one query each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import decontaminate, langid, mincut, mixing, nearjoin, ngramlm, pii, quality, runs, sharding, substring, tokens, vectorcodes
from tidepool.llm.common import materialize, read, text_of, words_of

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
SHARDS = 24
PII_KEY_CONF = "tidepool.pii.key"

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Place of a public tokenizer file, the same on every machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = tokens.encode(read(spark, sf_dir, "documents"), tokenizer_path(), END_ID)
    return tokens.decode(spark, folder)


def op2_feistel_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = spark.conf.get(PII_KEY_CONF, "key of the example queries")
    return pii.pseudonymise(read(spark, sf_dir, "documents").select("doc_id", "text"), key)


def op3_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies",
                        F.get("positions", F.lit(0)).alias("first_position"))


def op4_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = langid.learn(docs, ~held_out)
    return langid.predict(docs.withColumn("held_out", held_out), model, keep=["doc_id", "held_out"])


def op5_rendezvous(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.assign(read(spark, sf_dir, "documents"), "doc_id", "text", [1.0] * SHARDS, added=1.0)
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op6_min_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mincut.extract(read(spark, sf_dir, "pages"), keep=["page_id", "url"])
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op7_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    scored = quality.score(docs).drop("text")
    scored = materialize(scored, "rules")
    judged = quality.judge(scored, quality.host_rates(scored, "source"), "source")
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "host_failed", "kept")


def op8_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substring.remove_repeats(read(spark, sf_dir, "documents"))
    return rows.select(F.col("key").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearjoin.near_join(read(spark, sf_dir, "documents"))


def op10_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    found = decontaminate.scan(docs, items, keep=["doc_id"])
    return found.select("doc_id", "_found.n_words", "_found.n_hit", F.size("_found.items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("_found.items", ","), 256).alias("items_sha256"),
                        (F.col("_found.n_hit") > 0).alias("contaminated"))


def _repeated(text: Column, key: Column) -> Column:
    """The texts that op11 looks at: of every tenth key (by crc32) the words from some place on are made periodic."""
    h = F.crc32(key.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def periodic(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8)).cast("long")
        # Periods end to end; the last one is cut.
        from_a = F.flatten(F.array_repeat(F.slice(words, (a + 1).cast("int"), p.cast("int")), F.ceil((n - a) / p).cast("int")))
        return F.array_join(F.concat(F.slice(words, F.lit(1), a.cast("int")), F.slice(from_a, F.lit(1), (n - a).cast("int"))), " ")

    words = words_of(text)
    return F.when((h % 10 == 0) & (F.size(words) > 0), periodic(words)).otherwise(text)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = runs.collapse(docs, _repeated(text_of("text"), F.col("doc_id")), keep=["doc_id"])
    best = runs.strongest(F.col("runs"))
    found = found.select("_row.doc_id", "runs", "kept", best.alias("best"))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    length, period = F.col("best.length"), F.col("best.period")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                        F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
                        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("kept", 256).alias("collapsed_sha256"))


def op12_gnat_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vectorcodes.compress(read(spark, sf_dir, "embeddings"))
    coded = vectorcodes.with_label_error(coded, "label")
    return coded.select("_row.vec_id", "code", "error", "label_error",
                        F.lit(vectorcodes.digest(books)).alias("codebooks_sha256"))


def op13_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = lambda key: F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 7 == 2, F.lit(False))
    scored = ngramlm.score(docs, ~held_out("doc_id"))
    return scored.select(F.col("key").alias("doc_id"), held_out("key").alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score")


QUERIES: dict[str, Query] = {
    "op1_simple8b": op1_simple8b,
    "op2_feistel_pii": op2_feistel_pii,
    "op3_curriculum_mix": op3_curriculum_mix,
    "op4_ppm_language": op4_ppm_language,
    "op5_rendezvous": op5_rendezvous,
    "op6_min_cut": op6_min_cut,
    "op7_host_rules": op7_host_rules,
    "op8_doubling": op8_doubling,
    "op9_chosen_path": op9_chosen_path,
    "op10_fm_index": op10_fm_index,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_gnat_codes": op12_gnat_codes,
    "op13_deleted_interpolation": op13_deleted_interpolation,
}
