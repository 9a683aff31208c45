"""Registered queries of this folder, with their SQL where SQL can say it.

Each query applies its operator to the whole table and derives the columns of
its contract from what the operator returns.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, language, merkle, mixing, neardup, periods, quality, rlz, simhash, suffix, topk, urlfilter
from .common import table, union


def held_out(id_col: str, modulus: int, remainder: int) -> Column:
    """Whether the crc32 of the id's text leaves ``remainder`` (false for a null id)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % modulus == remainder, F.lit(False))


def vocabulary() -> bpe.Vocabulary:
    import public_tokenizers

    return bpe.load(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs.where(~held_out("doc_id", 3, 1)))
    return (language.identify(docs, model)
            .select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "lang_pred", "score"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "\\### Assistant: </turn> ok"
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                 F.lit(text).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    made = chat.format_paths(chat.paths(chat.linear_trees(union(turns, more))))
    read = made.select("tree", "formatted", chat.read_turns(F.col("formatted")).alias("turns"),
                       F.array_join(chat.read_loss(F.col("formatted"), F.col("loss_spans")), "").alias("loss"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, vocabulary(), decoded_out="decoded")
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages").select("page_id", "url"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs).select(
        "doc_id", simhash.fingerprint_hex("fp").alias("fingerprint"), "component_id")


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    fold = held_out("doc_id", 4, 2)
    model = quality.fit(docs.where(~fold), labels.where(~fold))
    return quality.score(docs, model).select(
        "doc_id", fold.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (mixing.mix(table(spark, sf_dir, "documents"))
            .select("doc_id", "size", "source_size", "target", "taken"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return suffix.remove_repeats(docs).select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return rlz.remove_repeats(docs).select(
        "doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ("doc_id", "source", "lang", "n_chars", "text")
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    lowered = [F.translate("text", upper, lower) if c == "text" else F.col(c) for c in fields]
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    docs = table(spark, sf_dir, "documents").withColumn("tampered", F.when(tampered, merkle.leaf_digest(*lowered)))
    found = merkle.witnesses(merkle.build(docs, fields, carry=("tampered",)))
    folded = merkle.fold(F.coalesce("carried.tampered", "leaf"), F.col("witness"))
    return found.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", merkle.proof_digest(F.col("witness")).alias("proof_sha256"),
        folded.alias("folded_root"), (folded == F.col("root")).alias("verified"))


def tail_repeated(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words with a planted period: of every tenth id the words from some place on
    repeat the first few of them."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    g = h // 10
    a = g % len(words)
    p = 1 + (len(words) - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, len(words))]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # the first of the runs with the greatest length / period, compared as products
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda b, r: F.when(
        r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b))
    told = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return (periods.find_runs(docs, rewrite=tail_repeated)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                    F.sha2(told, 256).alias("runs_sha256"), F.sha2("kept", 256).alias("collapsed_sha256"))
            .select("doc_id", "n_runs", "best.start", "best.length", "best.period",
                    F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256"))


_QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_language_id": (op1_language_id, None),
    "op2_chat_format": (op2_chat_format, chat.SQL),
    "op6_exact_topk": (op6_exact_topk, topk.SQL),
    "op3_byte_bpe": (op3_byte_bpe, None),
    "op4_url_filter": (op4_url_filter, None),
    "op7_quality": (op7_quality, None),
    "op8_embedding_dedup": (op8_embedding_dedup, neardup.SQL),
    "op5_simhash": (op5_simhash, None),
    "op10_suffix_dedup": (op10_suffix_dedup, None),
    "op9_source_mixing": (op9_source_mixing, mixing.SQL),
    "op11_substring_dedup": (op11_substring_dedup, rlz.SQL),
    "op12_merkle_manifest": (op12_merkle_manifest, merkle.SQL),
    "op13_periodic_runs": (op13_periodic_runs, None),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, (f, _) in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _QUERIES.items() if sql}
