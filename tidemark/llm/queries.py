"""The queries p8 to p10 over documents, and SQL of those that SQL can say: all stretches of 300 characters, met by their hash."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import encode, packing, spans
from tidemark.session import read


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.token_ids(read(spark, sf_dir, "documents"))


def p9_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    packed = packing.pack(encode.token_counts(docs), packing.shards_for(docs.count()))
    return packed.withColumnsRenamed({"first_unit": "first_token", "n_units": "n_tokens"})


def p9_unused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How full the containers are: containers, tokens and the share of room left unused."""
    by_container = p9_containers(spark, sf_dir).groupBy("container_id").agg(F.sum("n_tokens").alias("tokens"))
    total = by_container.agg(F.count("*").alias("containers"), F.sum("tokens").alias("tokens"))
    return total.withColumn("unused_share", F.round(1 - F.col("tokens") / (F.col("containers") * packing.CAPACITY), 6))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.sharing_pairs(read(spark, sf_dir, "documents"))


def p10_shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.shared_share(read(spark, sf_dir, "documents"))


def p10_first_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.without_repeats(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (p8_ids, p9_containers, p9_unused, p10_found, p10_shared, p10_first_only)}

_STRETCHES = """w as (select doc_id, i as pos, hash(substr(text, i, 300)) as h from documents, unnest(range(1, length(text) - 298)) as r(i) where length(text) >= 300),
s as (select h, min(doc_id) as lo from w group by h having min(doc_id) <> max(doc_id)), shared as (select w.* from w join s using (h))"""
SQL: dict[str, str] = {
    "p10_found": f"with {_STRETCHES}, d as (select distinct h, doc_id from shared) select distinct x.doc_id as doc_id_a, y.doc_id as doc_id_b from d x join d y using (h) where x.doc_id < y.doc_id",
    "p10_shared": f"""with {_STRETCHES}, c as (select doc_id, sum(least(300, coalesce(stop_at - pos, 300)))::bigint as chars from (select doc_id, pos, lead(pos) over (partition by doc_id order by pos) as stop_at from shared) group by 1)
select doc_id, coalesce(length(text), 0)::int as n_chars, coalesce(chars, 0)::bigint as shared_chars, case when length(text) > 0 then round(coalesce(chars, 0) / length(text)::double, 6) else 0.0::double end as shared_share
from documents left join c using (doc_id)""",
}
