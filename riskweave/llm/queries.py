"""One query per operator over its whole table, and DuckDB SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.byte_bpe import decode, encode
from riskweave.llm.chat_format import format_transcripts, learn_from_conversations, transcripts
from riskweave.llm.embedding_dedup import link_vectors
from riskweave.llm.line_dedup import LINES_SQL, drop_frequent_lines
from riskweave.llm.merkle import MERKLE_SQL, document_proofs
from riskweave.llm.mixing import MIX_SELECT, MIX_SQL, mix
from riskweave.llm.neighbours import nearest
from riskweave.llm.ngram_join import similar_documents
from riskweave.llm.packing import pack
from riskweave.llm.prefix_trie import TRIE_SQL, conversation_trie
from riskweave.llm.quality import classify
from riskweave.llm.suffix_dedup import remove_repeats
from riskweave.llm.tables import read_table
from riskweave.llm.url_filter import judge

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(read_table(spark, sf_dir, "documents"), k=3, num=90, den=100)


@query
def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(read_table(spark, sf_dir, "embeddings"), threshold=0.9)


@query
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents"), length=400)


@query
def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judge(read_table(spark, sf_dir, "pages"), read_table(spark, sf_dir, "labels"))
    return out.select("page_id", "host", "path", "rule", "verdict")


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"), tokenizer=word_tokenizer())


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query
def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"), query_every=20, k=20)


@query
def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read_table(spark, sf_dir, "conversations")
    return format_transcripts(transcripts(conversations), learn_from_conversations(conversations))


@query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


ORACLE_SQL["op9_mixing"] = MIX_SQL.format(docs="documents") + MIX_SELECT


@query
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = drop_frequent_lines(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "text", "n_lines", "n_dropped")


ORACLE_SQL["op10_line_dedup"] = (
    LINES_SQL.format(docs="documents")
    + """
SELECT doc_id, CASE WHEN len(kept) < len(lines) THEN array_to_string(kept, chr(10)) ELSE text END AS text,
       CAST(coalesce(len(lines), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(lines) - len(kept), 0) AS BIGINT) AS n_dropped
FROM cl
"""
)


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(read_table(spark, sf_dir, "conversations"))


ORACLE_SQL["op11_prefix_trie"] = TRIE_SQL


@query
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_proofs(read_table(spark, sf_dir, "documents"))


ORACLE_SQL["op12_merkle"] = MERKLE_SQL


@query
def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = encode(read_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    decoded = decode(encoded, ranks)
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
