"""Registered queries of the corpus operators. Each reads whole tables through its operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe_reuse, chat, decontam, fim, jaccard, periodic, ppm, quality, sharding, token_count, token_output, url_filter, warc
from .common import scratch

RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "tokens")
    token_output.write_tokens(_table(spark, sf_dir, "documents"), path, tokenizer_path=tokenizer_path("word_bpe_49k.json"), end_id=2)
    return token_output.token_digests(spark, path)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard_documents(_table(spark, sf_dir, "documents"), shards=40)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), F.col("vslot").alias("virtual_slot"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(_table(spark, sf_dir, "documents"))


def op4_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.resolve_revisits(warc.crawl_log(_table(spark, sf_dir, "pages")))
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return found.withColumn("headers", F.array_join(lines, "|"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.quality_report(docs, quality.train_field(docs, _table(spark, sf_dir, "labels")))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(_table(spark, sf_dir, "documents"), tokenizer_path=tokenizer_path("byte_bpe_50k.json"), limit=512)


def op7_bpe_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe_reuse.encode_documents(_table(spark, sf_dir, "documents"), tokenizer_path=tokenizer_path("word_bpe_49k.json"), decode=True)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score_documents(_table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "contaminated", F.col("matches.item_id").alias("item_ids"), F.size("matches").cast("long").alias("n_items"))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    out = url_filter.filter_urls(pages, url_filter.thin_page_urls(pages), id_col="page_id", url_col="url", rules=RULES)
    return out.select("page_id", "host", "path", "rule", "verdict", "canonical_url")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fim.transform(_table(spark, sf_dir, "documents"))
    restored = fim.restore(F.col("output"), F.col("form"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored, 256).alias("restored_sha256"))


#: What the added conversation says: control strings of other templates.
ODD_TEXT = r"\### Assistant: </turn> ok"


def op12_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    turns = turns.unionByName(spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(ODD_TEXT).alias("text")))
    out = chat.format_chats(turns.withColumn("content", chat.text_parts(F.col("text"))))
    read = out.select("conv_id", "formatted", "attachments", chat.turns_of(F.col("formatted")).alias("turns"), F.array_join(chat.taken(F.col("formatted"), F.col("mask")), "").alias("loss"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["content"], F.lit("\n")))
    tokens = F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"])
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"), F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"), F.size("attachments").cast("long").alias("n_attachments"), tokens.alias("placeholder_tokens"),
    )


def repeated_tails(docs: DataFrame) -> DataFrame:
    """Documents (doc_id, text) of which a tenth, by a hash of the id, go over into a repetition of some of their words."""
    h = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8"))
    text = F.coalesce(F.col("text"), F.lit(""))
    # Texts that stay as they are do not go through the split.
    words = F.when(h % 10 == 0, F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != ""))
    rows = docs.select("doc_id", text.alias("text"), F.floor(h / 10).alias("g"), words.alias("words")).withColumn("n", F.greatest(F.size("words"), F.lit(0)))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    rows = rows.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    rest = F.col("n") - F.col("a")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.ceil(rest / F.col("p")).cast("int"))), F.lit(1), rest)
    changed = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    return rows.select("doc_id", F.when(F.col("n") > 0, changed).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = periodic.collapse_runs(repeated_tails(_table(spark, sf_dir, "documents")))
    best = F.get(F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("a"), r["start"].alias("b"), r["period"].alias("c"), r.alias("run")))), F.lit(0))["run"]
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    out = out.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return out.select("doc_id", "n_runs", "best.start", "best.length", "best.period", F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_token_output": op1_token_output, "op5_quality_rules": op5_quality_rules, "op2_sharding": op2_sharding, "op6_token_counts": op6_token_counts, "op7_bpe_reuse": op7_bpe_reuse, "op8_ppm_scores": op8_ppm_scores, "op9_decontamination": op9_decontamination, "op3_jaccard_join": op3_jaccard_join, "op4_warc_revisits": op4_warc_revisits, "op10_url_filters": op10_url_filters, "op11_fill_in_middle": op11_fill_in_middle, "op12_chat_formatting": op12_chat_formatting, "op13_periodic_runs": op13_periodic_runs}


def oracle_sql() -> dict[str, str]:
    return {"op3_jaccard_join": jaccard.ORACLE_SQL, "op4_warc_revisits": warc.ORACLE_SQL, "op10_url_filters": url_filter.ORACLE_SQL, "op11_fill_in_middle": fim.ORACLE_SQL, "op12_chat_formatting": chat.ORACLE_SQL}
