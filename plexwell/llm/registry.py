"""Queries of the training-data operators, with SQL where it can express one."""

from __future__ import annotations

import public_tokenizers

from . import decontaminate, interpolation, license_scan, line_dedup, mpeg, packing, quality, simhash, style_tree, token_store


def op1_token_store(spark, sf_dir: str):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return token_store.read_back(token_store.write_store(spark, docs, public_tokenizers.path("byte_bpe_50k.json")))


def op9_packing(spark, sf_dir: str):
    return packing.pack(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))


QUERIES = {
    "op1_token_store": op1_token_store,
    "op2_license_scan": license_scan.op2_license_scan,
    "op3_quality": quality.op3_quality,
    "op4_style_tree": style_tree.op4_style_tree,
    "op5_decontamination": decontaminate.op5_decontamination,
    "op6_mpeg": mpeg.op6_mpeg,
    "op7_line_dedup": line_dedup.op7_line_dedup,
    "op8_interpolation": interpolation.op8_interpolation,
    "op9_packing": op9_packing,
    "op10_simhash": simhash.op10_simhash,
}

SQL = {
    "op2_license_scan": license_scan.SQL_OP2,
    "op5_decontamination": decontaminate.SQL_OP5,
    "op7_line_dedup": line_dedup.SQL_OP7,
}
