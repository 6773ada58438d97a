"""Registered queries of the corpus operators: thin digests of their results."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from sylvan.llm import bpe, chat, lexical, lines, neighbours, packing, pii, quality, simhash, spelling, tokenfile, toxicity, training, urls
from sylvan.llm.common import read
from sylvan.session import Scratch

#: Parameters of the near-duplicate query and the pipeline's stage.
SIMHASH_SHINGLE = 3
SIMHASH_DISTANCE = 2
#: Rules of the url query.
URL_RULES = [
    urls.Rule("allow", "org", "/"),
    urls.Rule("block", "example.org", "/es/"),
    urls.Rule("block", "example.org", "/en/1"),
    urls.Rule("allow", "com", "/fr/"),
    urls.Rule("block", "com", "/de/"),
]


def op1_simhash(spark, sf_dir):
    groups = simhash.simhash_groups(read(spark, sf_dir, "documents"), shingle=SIMHASH_SHINGLE, max_distance=SIMHASH_DISTANCE)
    return groups.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op2_packing(spark, sf_dir):
    pieces = packing.pack_documents(
        read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), capacity=1024, end_id=0
    )
    return pieces.select(
        "doc_id", "start", "length", packing.ids_crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op3_tokenfile(spark, sf_dir):
    path = Scratch(spark, "tokenfile").path("blocks")
    tokenfile.write_tokens(
        read(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2, alphabet=50257
    )
    return tokenfile.read_tokens(spark, path, with_ids=False)


def op4_neighbours(spark, sf_dir):
    return neighbours.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op5_urls(spark, sf_dir):
    return urls.filter_urls(read(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op6_pii(spark, sf_dir):
    found = pii.find_personal_data(read(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "row.doc_id", *[count(k) for k in pii.KINDS], F.sha2(pii.digest(F.col("base")), 256).alias("base_sha256"),
        pii.digest(F.concat("base", "added")).alias("spans"),
    )


def op7_toxicity(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"), "toxic", modulus=3, held_out=1)
    scored = toxicity.score_documents(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", training.is_held_out("doc_id", 3, 1).alias("held_out"), F.col("toxicity").alias("score"),
        F.col("is_toxic").cast("int").alias("predicted"),
    )


def op8_lines(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    model = lines.fit(docs, read(spark, sf_dir, "labels"))
    return lines.judge_lines(docs, model).drop("content_share")


def op9_quality(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    model = quality.fit(docs, read(spark, sf_dir, "labels"), "quality", modulus=5, held_out=0)
    scored = quality.score_documents(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", training.is_held_out("doc_id", 5, 0).alias("held_out"), F.col("quality").alias("score"),
        F.col("is_good").cast("int").alias("predicted"),
    )


def op10_bpe(spark, sf_dir):
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode_documents(read(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    decoded = bpe.decode_documents(encoded, ranks, public_tokenizers.PATTERN)
    return decoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op11_spelling(spark, sf_dir):
    words = spelling.count_words(read(spark, sf_dir, "documents"), noise=97)
    return spelling.spelling_forms(words, Scratch(spark, "spelling"))


def op12_chat(spark, sf_dir):
    marks = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", marks), (-1, 1, "assistant", marks)], "conv_id long, turn long, role string, text string")
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    template = chat.InstTemplate()
    back = chat.join_pieces(chat.format_conversations(rows, template), template)
    return back.drop("rewritten_turn")


def op13_lexical(spark, sf_dir):
    return lexical.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), k=20)


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_packing": op2_packing,
    "op3_tokenfile": op3_tokenfile,
    "op4_neighbours": op4_neighbours,
    "op5_urls": op5_urls,
    "op6_pii": op6_pii,
    "op7_toxicity": op7_toxicity,
    "op8_lines": op8_lines,
    "op9_quality": op9_quality,
    "op10_bpe": op10_bpe,
    "op11_spelling": op11_spelling,
    "op12_chat": op12_chat,
    "op13_lexical": op13_lexical,
}
ORACLE_SQL: dict[str, str] = {"op5_urls": urls.oracle_sql(URL_RULES), "op13_lexical": lexical.oracle_sql(20)}
