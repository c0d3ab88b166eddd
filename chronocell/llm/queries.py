"""The thin queries of the thirteen operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronocell.llm.mixing import mix

    m = mix(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return m.select("doc_id", "size", "source_size", "target", "taken", "epochs", "part")


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronocell.llm.licenses import scan

    return scan(_table(spark, sf_dir, "documents"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from chronocell.llm.bpe import digests

    return digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op4_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronocell.llm.neardup import classes

    return classes(_table(spark, sf_dir, "documents"))


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronocell.llm.topk import top_pairs

    return top_pairs(_table(spark, sf_dir, "embeddings"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronocell.llm.warc import archived

    return archived(_table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronocell.llm.media import media_features

    return media_features(_table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronocell.llm.toxicity import judge

    return judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronocell.llm.urls import judge

    return judge(_table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op10_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronocell.llm.suffixes import dedup

    return dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"), ("n_bytes", "n_removed", "n_spans", "kept_sha256"))


def op11_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronocell.llm.clustering import clustered

    return clustered(_table(spark, sf_dir, "embeddings"))


def op12_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronocell.llm.graph import nearest

    return nearest(_table(spark, sf_dir, "embeddings"))


def op13_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronocell.llm.codes import coded

    return coded(_table(spark, sf_dir, "embeddings"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_mixing, op2_licenses, op3_bpe, op4_neardup, op5_topk, op6_warc, op7_media, op8_toxicity, op9_urls, op10_suffixes, op11_clustering, op12_graph, op13_codes)}


def oracle_sql() -> dict[str, str]:
    from chronocell.llm import clustering, codes, licenses, mixing, topk, urls, warc

    return {"op1_mixing": mixing.ORACLE, "op2_licenses": licenses.ORACLE, "op5_topk": topk.ORACLE, "op6_warc": warc.ORACLE, "op9_urls": urls.ORACLE,
            "op11_clustering": clustering.ORACLE, "op13_codes": codes.ORACLE}
