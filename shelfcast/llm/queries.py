"""One query per operator over the whole documents table, and SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfcast.llm import decontaminate, exact, language, licenses, lines, mixing, nearcopies, negatives, pieces, secrets, shards, spelling, toxicity


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.exact_duplicates(_table(spark, folder, "documents"))


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    left = lines.drop_shared_lines(_table(spark, folder, "documents"))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def _remainder(modulus: int) -> str:
    return f"crc32(cast(cast(doc_id as string) as binary)) % {modulus}"


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    model = toxicity.learn(documents, labels.where(f"{_remainder(5)} <> 0"))
    scored = toxicity.score(documents, model)
    return scored.select("doc_id", F.expr(f"{_remainder(5)} = 0").alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


#: Metadata that the shards are cut along, beside the size of a text.
SHARD_DIMENSIONS = ["source", "lang", "n_chars"]


def op5_sharding(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents").withColumn(
        "text_crc32", F.crc32(F.coalesce("text", F.lit("")).cast("binary")))
    placed = shards.kd_shards(documents, dimensions=SHARD_DIMENSIONS, shards=8).select(
        "doc_id", F.col("shard_size").alias("size"), "text_crc32", F.lit("bytes").alias("law"), "shard")
    slotted = shards.with_slots(placed, ["doc_id", "text_crc32", "size"])
    return slotted.select("doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return nearcopies.near_duplicates(_table(spark, folder, "documents"), words=4, percent=80)


def op7_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan_secrets(_table(spark, folder, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex",
                        F.sha2(secrets.spans_text(F.col("base_spans")), 256).alias("base_sha256"),
                        secrets.spans_text(F.array_sort(F.concat("base_spans", "entropy_spans"))).alias("spans"))


def op8_licenses(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    return licenses.scan_licenses(documents, licenses.train(documents))


def op9_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return language.score_texts(_table(spark, folder, "documents"), held_out=f"{_remainder(7)} = 2")


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix_sources(_table(spark, folder, "documents"))
    return mixed.select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
                        F.col("mix_target").alias("target"), (F.col("mix_size") * F.col("mix_copies")).alias("taken"),
                        F.col("mix_rate").alias("rate"))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    table = _table(spark, folder, "embeddings").where(negatives.usable(F.col("embedding"), F.col("label")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table.select(F.col("vec_id").alias("id"), label.alias("label"), negatives.quantized(F.col("embedding")).alias("vector"))
    return negatives.mine_hard_negatives(rows, F.col("id") % 100 == 0)


def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    words = spelling.count_words(_table(spark, folder, "documents"), damage_modulus=97)
    return spelling.group_variants(words).select("word", "form", "root", "n", "n_near", "form_n")


def op13_sentencepiece(spark: SparkSession, folder: str, model_path: str | None = None) -> DataFrame:
    """``model_path`` names the vocabulary file; by default the public one of 32,000 pieces."""
    if model_path is None:
        import public_tokenizers

        model_path = public_tokenizers.path("piece_bpe_32k.model")
    coded = pieces.encode_texts(_table(spark, folder, "documents").select("doc_id", "text"), model_path)
    numbers = F.array_join(F.col("piece_ids").cast("array<string>"), ",")
    return coded.select("doc_id", F.size("piece_ids").cast("long").alias("n_tokens"), F.sha2(numbers, 256).alias("ids_sha256"),
                        F.sha2("piece_text", 256).alias("decoded_sha256"), F.col("piece_agrees").alias("agrees"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES = {q.__name__: q for q in (
    op1_exact_dedup, op2_line_dedup, op3_decontamination, op4_toxicity, op5_sharding, op6_near_dedup, op7_secrets,
    op8_licenses, op9_language_model, op10_mixing, op11_hard_negatives, op12_spelling, op13_sentencepiece, pipeline)}

_SPACES = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE: dict[str, str] = {
    "op1_exact_dedup": rf"""
        with t as (select doc_id, length(coalesce(text, '')) as n,
                          regexp_replace(coalesce(text, ''), '{_SPACES}', '', 'g') as body from documents),
             g as (select body, count(*) as group_size, first(doc_id order by n desc, doc_id) as keep_id from t group by body)
        select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(body) as text_sha256
        from t join g using (body)""",
    "op2_line_dedup": rf"""
        with l as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
                          generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos from documents),
             k as (select *, translate(regexp_replace(regexp_replace(line, '^{_SPACES}+', ''), '{_SPACES}+$', ''),
                                       '{_UPPER}', '{_LOWER}') as line_key from l),
             s as (select line_key, max(doc_id) as last from k where length(line_key) >= 40
                   group by line_key having count(distinct doc_id) >= 5),
             m as (select doc_id, pos, line, s.line_key is not null and doc_id <> s.last as gone
                   from k left join s on k.line_key = s.line_key)
        select doc_id, count(*) as n_lines, cast(sum(gone::int) as bigint) as n_dropped,
               sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
        from m group by doc_id""",
    "op11_hard_negatives": """
        with r as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                          list_transform(embedding, lambda x: floor(256 * x::double)) as v
                   from embeddings where label is not null and embedding is not null
                   and len(list_filter(embedding, lambda x: coalesce(isfinite(x::double), false))) = len(embedding)),
             s as (select a.vec_id as anchor_id, a.label = r.label as same, r.vec_id,
                          cast(list_inner_product(a.v, r.v) as bigint) as score
                   from r as a, r where a.vec_id % 100 = 0),
             p as (select anchor_id, vec_id as positive_id, score as positive_score from s
                   where same and vec_id <> anchor_id
                   qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
        select p.anchor_id, p.positive_id,
               cast(row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.vec_id) as int) as rank,
               s.vec_id as negative_id, p.positive_score, s.score as negative_score
        from p join s on s.anchor_id = p.anchor_id and not s.same
             and 80 * p.positive_score <= 100 * s.score and s.score <= p.positive_score
        qualify rank <= 5""",
    "op10_mixing": rf"""
        with d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) as size from documents),
             s as (select source, cast(sum(size) as bigint) as source_size from d group by source),
             w as (select *, 1.0::double + (row_number() over (order by source is null, source) - 1) % 3 as weight from s),
             r as (select *, source_size * 3.0::double as cap, source_size * 3.0::double / weight as room from w),
             v as (select *, (sum(source_size) over ()
                              - coalesce(sum(cap) over (order by room, source is null, source
                                                        rows between unbounded preceding and 1 preceding), 0))
                             / sum(weight) over (order by room, source is null, source
                                                 rows between current row and unbounded following) as level from r),
             o as (select min(room) filter (where room >= level) as first_room from v),
             t as (select v.source, v.source_size,
                          case when o.first_room is null then cap
                               else least(cap, weight * (select level from v as x where x.room = o.first_room
                                                         order by source is null, source limit 1)) end as target
                   from v, o),
             u as (select d.*, t.source_size, t.target,
                          case when t.source_size > 0 then t.target / t.source_size else 0.0 end as rate,
                          ('0x' || substr(md5('11:' || coalesce(cast(doc_id as varchar), '')), 1, 13))::bigint
                              / 4503599627370496.0::double as draw
                   from d join t on d.source is not distinct from t.source)
        select doc_id, cast(size as bigint) as size, source_size, target, rate,
               cast(size * (floor(rate) + (draw < rate - floor(rate))::int) as bigint) as taken from u""",
}
