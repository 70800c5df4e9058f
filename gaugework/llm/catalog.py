"""Registered queries of the pipeline operators, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gaugework.llm import alignment, chat, html, lines, mixing, neardup, packing, rules, search, sharding, statements, tokens, toxicity, vectors
from gaugework.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return keep


@query("op1_probminhash_near_duplicates")
def _near_duplicates(spark, folder):
    return neardup.near_duplicates(table(spark, folder, "documents"))


@query("op2_hilbert_shards", statements.shards(sharding.DIMENSIONS))
def _hilbert_shards(spark, folder):
    return sharding.hilbert_shards(table(spark, folder, "documents")).drop("curve", *sharding.DIMENSIONS)


@query("op3_rule_ledger", statements.RULES)
def _rule_ledger(spark, folder):
    book = rules.apply_policy(rules.ledger(table(spark, folder, "documents")), "v2")
    return book.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "fail_bits")


@query("op4_certified_packing")
def _certified_packing(spark, folder):
    return packing.pack(packing.token_pieces(table(spark, folder, "documents")))


@query("op7_systematic_mix", statements.MIX)
def _systematic_mix(spark, folder):
    return mixing.systematic_copies(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op8_token_counts")
def _token_counts(spark, folder):
    return tokens.token_counts(table(spark, folder, "documents"))


@query("op5_host_suffix_extraction")
def _host_suffix_extraction(spark, folder):
    return html.extract_main_text(table(spark, folder, "pages"))


@query("op6_counterfactual_toxicity")
def _counterfactual_toxicity(spark, folder):
    return toxicity.score_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op9_int8_near_vectors", statements.VECTORS)
def _int8_near_vectors(spark, folder):
    return vectors.near_vectors(table(spark, folder, "embeddings"))


@query("op10_fuzzy_line_dedup")
def _fuzzy_line_dedup(spark, folder):
    return lines.dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))


@query("op11_chat_loss_masks", statements.CHAT)
def _chat_loss_masks(spark, folder):
    formatted = chat.format_conversations(chat.with_control_strings(table(spark, folder, "conversations")))
    return chat.read_back(formatted).drop("n_tokens", "n_loss_tokens")


@query("op12_presence_mask_search", statements.SEARCH)
def _presence_mask_search(spark, folder):
    return search.rank_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op13_tokenizer_alignment")
def _tokenizer_alignment(spark, folder):
    return alignment.align_documents(table(spark, folder, "documents"))
