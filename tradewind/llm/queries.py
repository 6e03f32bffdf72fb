"""The registered queries of this folder: each applies its operator, with production parameters, to a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bytebpe, decontam, infill, lines, merkle, mixing, output, quality, secrets, simhash, tokens, toxicity
from .common import table

TOKEN_LIMIT = 2048


def tokenizer(name: str) -> str:
    """Where the host keeps a public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, ledger = table(spark, sf_dir, "documents"), secrets.new_ledger(spark)
    secrets.scan(docs, ledger)
    found = secrets.findings(docs, ledger)
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    counts = [F.coalesce(F.col("counts")[r.kind], F.lit(0)).cast("long").alias(f"n_{r.kind}") for r in secrets.BASE]
    return found.select("doc_id", *counts, F.sha2(F.encode(spans, "UTF-8"), 256).alias("base_sha256"), spans.alias("spans"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, n_lines, n_deleted = lines.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "text", F.col(n_lines).alias("n_lines"), F.col(n_deleted).alias("n_deleted"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = tokens.token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer("word_bpe_49k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def _scored(spark: SparkSession, sf_dir: str, model, label: str, folds: int, held: int) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    known = quality.teaching(table(spark, sf_dir, "labels"), label, folds, held)
    found, score = model.scored(docs, known, keep=["doc_id"])
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds)) == held
    return found.select("doc_id", held_out.alias("held_out"), F.col(score).alias("score"), (F.col(score) >= model.LIMIT).cast("int").alias("predicted"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir, quality, "quality", 5, 0)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir, toxicity, "toxic", 4, 2)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), every=20)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return output.written(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = tokenizer("byte_bpe_50k.tiktoken")
    found, (ids,) = bytebpe.encoded(table(spark, sf_dir, "documents").select("doc_id", "text"), ranks, public_tokenizers.PATTERN, offsets=False, drop=True)
    back, (held,) = bytebpe.decoded(found, ids, ranks, text=False)
    written = F.array_join(F.col(ids).cast("array<string>"), " ")
    return back.select("doc_id", F.size(ids).cast("long").alias("n_tokens"), F.sha2(written, 256).alias("ids_sha256"), F.sha2(held, 256).alias("decoded_sha256"))


def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    made, (n, form, output, prefix_chars, middle_chars) = infill.infilled(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select("doc_id", F.col(n).alias("n"), F.col(form).alias("form"), F.col(prefix_chars).alias("prefix_chars"), F.col(middle_chars).alias("middle_chars"),
                       F.sha2(output, 256).alias("output_sha256"), F.sha2(infill.restored(F.col(output), F.col(form)), 256).alias("restored_sha256"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered = merkle.digest([F.translate("text", letters, letters.lower()) if f == "text" else F.col(f) for f in merkle.FIELDS])
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, lowered)
    return merkle.proofs(merkle.manifest(docs, claim=tampered))


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_line_dedup": op2_line_dedup,
    "op3_token_counts": op3_token_counts,
    "op4_quality": op4_quality,
    "op5_toxicity": op5_toxicity,
    "op6_decontamination": op6_decontamination,
    "op7_mixing": op7_mixing,
    "op8_nearest": op8_nearest,
    "op9_simhash": op9_simhash,
    "op10_token_output": op10_token_output,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_infill": op12_infill,
    "op13_merkle": op13_merkle,
}

ORACLES: dict[str, str] = {"op2_line_dedup": lines.ORACLE, "op12_infill": infill.ORACLE, "op13_merkle": merkle.ORACLE}
