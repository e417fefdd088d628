"""The registered queries of the corpus operators, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import archives, chat, language, lexical, lines, mixing, near, neighbours, packing, quality, token_files, toxicity, whitening
from .tokens import vocabulary


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out() -> "F.Column":
    """The fold that teaches nothing: crc32 of the id as text leaves 2 on division by 4."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language.train(docs.where(~held_out()).select("doc_id", "text", "lang"))
    found = language.identify(docs.select("doc_id", "text"), model)
    # every text with letters gets a learned language here; whether it is rejected stands beside it
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), F.col("lang_rejected").alias("rejected"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), 4096, end_id=2, keeps_blanks=False)


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(_table(spark, sf_dir, "embeddings"), k=20, every=20)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = lines.line_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"), 40, 5)
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op5_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archives.archive_round_trip(_table(spark, sf_dir, "pages"), 100)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sizes(_table(spark, sf_dir, "documents"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_round_trip(_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end_id=0, keeps_blanks=True)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = quality.quality(_table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = near.near_classes(_table(spark, sf_dir, "documents"), words=3, percent=85)
    return done.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    fold = F.crc32(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2
    model = chat.fit(turns.where(~fold))
    done = chat.format_chats(turns.select("conv_id", "turn", "text"), model)
    return done.select("conv_id", "turn", fold.alias("held_out"), "role_pred", "n_lines", "n_turns", F.sha2(F.col("rendered").cast("binary"), 256).alias("rendered_sha256"))


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), 10)


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
    network = toxicity.fit(docs, _table(spark, sf_dir, "labels").where(~held))
    return toxicity.score(docs, network).select("doc_id", held.alias("held_out"), F.col("toxicity").alias("score"), F.col("toxic_pred").alias("predicted"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = whitening.whiten(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), 4)
    # a deviation beyond a long is null here; the operator's own has 38 digits
    return done.withColumn("deviation", F.col("deviation").try_cast("long"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = (op1_language_id, op2_packing, op3_neighbours, op4_line_dedup, op5_archives, op6_mixing, op7_token_files, op8_quality, op9_near_dedup, op10_chat, op11_lexical, op12_toxicity, op13_whitening)
    return {f.__name__: f for f in ops} | {"pipeline": pipeline}


_BLANK_CLASS = r"[\x20\x09-\x0D]"
_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

LINE_SQL = """
with cut as (
  select rowid as r, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as pos
  from (select row_number() over () as rowid, doc_id, text from documents)),
keyed as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from cut),
frequent as (
  select key, max(doc_id) as keeper from keyed where length(key) >= 40
  group by key having count(distinct coalesce(doc_id, -9223372036854775807)) >= 5),
marked as (
  select k.*, f.key is not null and k.doc_id is distinct from f.keeper as lost
  from keyed k left join frequent f on k.key = f.key)
select doc_id, count(*) as n_lines, count(*) filter (where lost) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not lost), '')) as kept_sha256
from marked group by r, doc_id
"""

#: As mixing.mix_draws: the line of words by md5, whole epochs and then its beginning, in blocks of 32 words or wider.
MIX_SQL = rf"""
with recursive sized as (
  select doc_id, source, {_WORDS} as size, md5('17:' || coalesce(cast(doc_id as varchar), 'null')) as mark from documents),
sources as (
  select source, sum(size)::bigint as source_size,
         [3, 1, 2][1 + (row_number() over (order by source is null, encode(source)) - 1) % 3] as weight
  from sized group by source),
fill as (
  select 0 as round, source, source_size, weight, false as capped,
         1.5 * sum(source_size) over () * weight / nullif(sum(weight) filter (where source_size > 0) over (), 0) as share from sources
  union all
  select round + 1, source, source_size, weight, capped or share > 2.0 * source_size or source_size = 0,
         (1.5 * sum(source_size) over () - coalesce(sum(2.0 * source_size) filter (where capped or share > 2.0 * source_size or source_size = 0) over (), 0)) * weight
           / nullif(sum(weight) filter (where not (capped or share > 2.0 * source_size or source_size = 0)) over (), 0)
  from fill where round < 40),
owed as (
  select source, source_size, case when capped then 2.0 * source_size else share end as target from fill where round = 40),
width as (select greatest(32, ceil(1.5 * sum(source_size) / 536870912)) as width from sources),
owed_words as (
  select owed.*, least(round(target / width) * width, 2 * source_size)::bigint as words from owed, width),
placed as (
  select *, coalesce(sum(size) over (partition by source order by mark rows between unbounded preceding and 1 preceding), 0)::bigint as lo from sized)
select p.doc_id, p.size, o.source_size, o.target,
       (greatest(0, least(o.words, p.lo + p.size) - p.lo)
        + greatest(0, least(o.words, p.lo + p.size + o.source_size) - p.lo - o.source_size))::bigint as taken
from placed p join owed_words o on p.source is not distinct from o.source
"""

#: The whole ranking: every document that holds a term of an item is scored.
LEXICAL_SQL = r"""
with term as (
  select r, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from (select row_number() over () as r, doc_id, text from documents)),
document as (select r, doc_id, count(*) as n from term group by r, doc_id),
whole as (select count(*) as documents, sum(n)::bigint as length from document),
item as (
  select item_id, term, count(*) as times
  from (select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark)
  group by item_id, term),
posting as (select r, term, count(*) as tf from term where term in (select term from item) group by r, term),
weight as (
  select term, floor(1000 * ln((2 * any_value(documents) + 2) / (2 * count(*) + 1)))::bigint as w
  from posting, whole group by term),
scored as (
  select item_id, r, doc_id,
         sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * documents) // length))))::bigint as score
  from item join posting using (term) join weight using (term) join document using (r), whole
  group by item_id, r, doc_id),
ranked as (
  select item_id, row_number() over (partition by item_id order by score desc, doc_id nulls last)::int as rank, doc_id, score
  from scored where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_line_dedup": LINE_SQL, "op6_mixing": MIX_SQL, "op11_lexical": LEXICAL_SQL}
