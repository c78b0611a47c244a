"""Registered queries of the operators, with production parameters, over whole tables."""

import public_tokenizers
from pyspark.sql import functions as F

from churnmart.llm import decontaminate, langid, licenses, merkle, packing, pages, quality, secrets, simhash, suffixes, topk, toxicity, whitening
from churnmart.llm.common import read_table


def op1_packing(spark, sf_dir):
    return packing.pack(
        read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    )


def op9_simhash(spark, sf_dir):
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op5_quality(spark, sf_dir):
    return quality.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_toxicity(spark, sf_dir):
    return toxicity.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op8_decontamination(spark, sf_dir):
    return decontaminate.overlaps(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op2_licenses(spark, sf_dir):
    return licenses.scan(read_table(spark, sf_dir, "documents"))


def op4_secrets(spark, sf_dir):
    return secrets.scan(read_table(spark, sf_dir, "documents"))


def op3_topk(spark, sf_dir):
    return topk.search(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op6_pages(spark, sf_dir):
    return pages.extract(read_table(spark, sf_dir, "pages"))


def op7_suffixes(spark, sf_dir):
    return suffixes.digest(read_table(spark, sf_dir, "documents"))


def op11_langid(spark, sf_dir):
    return langid.predict(read_table(spark, sf_dir, "documents"))


def op12_merkle(spark, sf_dir):
    return merkle.drill(read_table(spark, sf_dir, "documents"))


def op13_whitening(spark, sf_dir):
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


def queries():
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}
