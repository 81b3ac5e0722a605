"""The operators on the sample tables, one query each, with check SQL where SQL can express it."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmart.llm import (
    compression_classifier,
    decontamination,
    lexical_search,
    line_dedup,
    packing,
    periodic_runs,
    pii,
    quality_rules,
    secrets,
    sharding,
    simhash_dedup,
    substring_dedup,
    token_counts,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.group(_table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(_table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(_table(spark, sf_dir, "documents"))


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents"))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_passages(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_compression_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return compression_classifier.score(docs, compression_classifier.fit(docs, _table(spark, sf_dir, "labels")))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"))


def _looped(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """A tenth of the documents run in a loop from some word on; a null id leaves its words."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


def _most_repeats(best: Column, run: Column) -> Column:
    """The run with the greater length / period; the earlier one on ties."""
    more = run["length"] * best["period"] > best["length"] * run["period"]
    return F.when(best.isNull() | more, run).otherwise(best)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(_table(spark, sf_dir, "documents"), rewrite=_looped)
    none = F.lit(None).cast("struct<start: long, length: long, period: long>")
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", F.aggregate("runs", none, _most_repeats)).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_simhash_near_dedup,
        op2_quality_rules,
        op3_personal_data,
        op4_best_fit_packing,
        op5_secret_scan,
        op6_suffix_array_dedup,
        op7_sharding,
        op8_benchmark_decontamination,
        op9_compression_classifier,
        op10_token_counts,
        op11_periodic_runs,
        op12_line_dedup,
        op13_ranked_search,
        pipeline,
    )
}

OP2_SQL = """
with t as (select row_number() over () r, doc_id, coalesce(text, '') text, source from documents),
words as (select r, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') w from t),
wins as (select r, unnest(range(1, len(w) - 3)) i, w from words where len(w) >= 5),
keyed as (select r, i, array_to_string(w[i:i + 4], ' ') k from wins),
twice as (select r, i from (select r, i, count(*) over (partition by r, k) c from keyed) where c > 1),
repeated as (select r, count(distinct i + o) n from twice, (select unnest(range(0, 5)) o) group by r),
lines as (select r, source, text, unnest(string_split(text, chr(10))) l from t),
worded as (select * from lines where regexp_matches(l, '[^\\x20\\x09-\\x0D]')),
dups as (select r, count(*) - count(distinct l) n from worded group by r),
normal as (select r, source, text, regexp_replace(array_to_string(regexp_extract_all(lower(l), '[^\\x20\\x09-\\x0D]+'), ' '), '[0-9]+', '0', 'g') k,
  len(regexp_extract_all(l, '[^\\x20\\x09-\\x0D]+')) n from worded),
hosts as (select source, count(distinct text) host_docs from t group by source),
bad as (select source, k from normal join hosts using (source) group by source, k
  having count(distinct text) >= 10 and count(distinct text) > 0.05 * any_value(host_docs)),
removed as (select r, sum(n) n from normal join bad using (source, k) group by r),
m as (select t.r, doc_id, len(w) n_words, len(array_to_string(w, '')) word_chars,
  len(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) n_symbols, coalesce(dups.n, 0) n_dup_lines, coalesce(repeated.n, 0) n_repeat_words,
  coalesce(removed.n, 0) gone
  from t join words using (r) left join dups using (r) left join repeated using (r) left join removed using (r))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 or 100 * n_repeat_words > 20 * n_words base_failed,
  not (n_words < 10 or 100 * n_repeat_words > 20 * n_words) and n_words - gone >= 10 and n_words - gone >= 0.3 * n_words kept
from m
"""

OP12_SQL = """
with t as (select row_number() over () r, doc_id, coalesce(text, '') text from documents),
l as (select r, doc_id, unnest(string_split(text, chr(10))) line, unnest(range(len(string_split(text, chr(10))))) i from t),
k as (select *, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') key from l),
often as (select key, max(doc_id) last from k where length(key) >= 20 group by key having count(distinct r) >= 3),
marked as (select r, k.doc_id, line, i, coalesce(k.doc_id < last, false) gone from k left join often using (key))
select any_value(doc_id) doc_id, count(*) n_lines, count(*) filter (where gone) n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not gone), '')) kept_sha256
from marked group by r
"""

OP13_SQL = """
with d as (select row_number() over () r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') w from documents),
q as (select row_number() over () item, item_id, regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') w from benchmark),
s as (select count(*) filter (where len(w) > 0) n_docs, sum(len(w))::bigint n_terms from d),
wanted as (select item, item_id, term, count(*) times from (select item, item_id, unnest(w) term from q) group by all),
tfs as (select r, doc_id, term, count(*) tf from (select r, doc_id, unnest(w) term from d) where term in (select term from wanted) group by all),
weights as (select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)::double))::bigint weight from tfs, s group by term, n_docs),
m as (select r, 75 + (25 * len(w) * n_docs) // n_terms m from d, s where len(w) > 0),
scored as (select item, item_id, r, doc_id, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * m)))::bigint score
  from wanted join tfs using (term) join weights using (term) join m using (r) group by all),
ranked as (select *, row_number() over (partition by item order by score desc, doc_id) rank from scored where score > 0)
select item_id, rank::int rank, doc_id, score from ranked where rank <= 20
"""

ORACLES: dict[str, str] = {"op2_quality_rules": OP2_SQL, "op12_line_dedup": OP12_SQL, "op13_ranked_search": OP13_SQL}
